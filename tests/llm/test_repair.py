import hashlib
import heapq
import random
import zlib

import pytest

from eventloom.llm import repair
from eventloom.llm.queries import SQL, op13_repair
from tools.check_queries import compare, connect

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, edit STRING, place BIGINT"
BLANK = " \t\n\x0b\x0c\r"
GRAMMAR = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        if not text.strip(BLANK):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if text.rstrip(BLANK)[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Cost, letters and repaired rows by search in order of cost, then letters."""
    wrong = faults(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, list(out)
        if (i, state) in done:
            continue
        done.add((i, state))
        nexts = {n for (s, n) in GRAMMAR if s == state and n != "s"}
        for n in nexts:
            heapq.heappush(heap, (cost + 2, audit + "I", i, n, (*out, ({"u": "user", "a": "assistant"}[n], ""))))
        if i == len(rows):
            continue
        _, role, text = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
        if wrong[i] in ("blank", "duplicate"):
            continue
        more = cost + (wrong[i] == "truncated")
        if (state, role[:1]) in GRAMMAR:
            heapq.heappush(heap, (more, audit + "K", i + 1, role[:1], (*out, (role, text))))
        for n in nexts:
            heapq.heappush(heap, (more + 2, audit + "R", i + 1, n, (*out, ({"u": "user", "a": "assistant"}[n], text))))
    raise AssertionError


def plain(data, damaged):
    ids, convs = {r[0] for r in data}, {}
    for conv, turn, role, text, *_ in data:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20 if damaged else 9
        if kind == 4:
            role = "user"
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        convs.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1))
    out = set()
    for conv in ids:
        rows = sorted(convs.get(conv, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        wrong, turns = faults(rows), {r[0] for r in rows if r[0] is not None}
        cost, audit, fixed = cheapest(rows)
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
        text = "\n".join(f"{role}:{text}" for role, text in fixed)
        out.add(
            (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, wrong.count("blank"), wrong.count("duplicate"), wrong.count("truncated"),
             sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest())
        )
    return out


def rows():
    rng = random.Random(5)
    texts = ["Well.", "Yes! ", "no end", "", " \t", "So?\n", "é.", ".", "a b c\x0b"]
    roles = ["user", "assistant", "system", "tool", "", "User", "unknown"]
    out = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.6 else rng.choice(roles)
            text = f"{conv} {turn}." if rng.random() < 0.5 else rng.choice(texts)
            out.append((conv, turn + 3 * (rng.random() < 0.1), role, text, "x", 1))
    out += [(None, 1, "user", "hi.", "x", 1), (None, None, "assistant", "Hi.", "x", 1), (70, None, None, None, "x", 1), (70, 2, "user", None, "x", 1)]
    out += [(71, 2, "user", "same.", "x", 1)] * 4 + [(72, -5, "assistant", "a. " * 30_000, "x", 1), (72, 2**40, "user", "b.", "x", 1)]
    out += [(80, t, rng.choice(roles), rng.choice(texts), "x", 1) for t in range(120)]
    return out


def found(spark, data, damaged=True, **options):
    frame = spark.createDataFrame(data, SCHEMA)
    given = repair.damage(frame) if damaged else frame
    return {tuple(r) for r in repair.digest(repair.repair(given, **options), frame.select("conv_id")).collect()}


@pytest.mark.parametrize("damaged", [True, False])
def test_matches_a_search(spark, damaged):
    assert found(spark, rows(), damaged) == plain(rows(), damaged)


def test_long_conversations_in_chunks(spark):
    assert found(spark, rows(), False, chunk_rows=3) == plain(rows(), False)


def test_auction_on_many_lattices():
    rng = random.Random(9)
    for _ in range(300):
        kinds = "".join(rng.choice("suaoSUAO-") for _ in range(rng.randint(0, 60)))
        turns = []
        for i, k in enumerate(kinds):
            text = "" if k == "-" else f"{i}" if k.isupper() else f"{i}."
            turns.append((i, {"s": "system", "u": "user", "a": "assistant", "o": "other", "-": "user"}[k.lower()], text))
        cost, audit, _ = cheapest(turns)
        assert repair.solve(kinds) == (audit, cost)


def test_edits_are_turns_of_the_grammar(spark):
    edits = repair.repair(spark.createDataFrame(rows(), SCHEMA)).collect()
    by_conv = {}
    for r in sorted(edits, key=lambda r: r.place):
        if r.edit != "D":
            by_conv.setdefault(r.conv_id, []).append(r.role[0])
        assert (r.was is None) == (r.edit == "I") and (r.role is None) == (r.edit == "D")
    for roles in by_conv.values():
        turns = roles[roles[0] == "s" :]
        assert turns == ["u", "a"] * (len(turns) // 2)


def test_empty_table(spark):
    assert found(spark, []) == set()


def test_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert compare(op13_repair(spark, sf), connect(sf), SQL["op13_repair"]).startswith("ok")

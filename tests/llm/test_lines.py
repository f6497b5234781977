import hashlib
import random

import pytest

from eventloom.llm import lines
from eventloom.llm.queries import SQL, op12_lines
from tools.check_queries import compare, connect

BLANK = " \t\n\x0b\x0c\r"
LONG = "A line of text that is as long as forty characters"


def plain(rows):
    """What each row keeps, and how many lines it loses."""
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(BLANK))
    held = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            held.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        kept, split = [], (text or "").split("\n")
        for line in split:
            k = key(line)
            last = max(held[k], key=lambda d: (d is not None, d or 0))
            if len(k) < 40 or len(held[k]) < 5 or doc == last:
                kept.append(line)
        out.append((doc, len(split), len(split) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(docs, **options):
    out = lines.drop_shared_lines(docs, **options)
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in out.collect()), key=str)


def rows():
    rng = random.Random(3)
    pool = [LONG, LONG.upper(), f"  {LONG}\t", "short", "", "É" * 40, "é" * 40, "x" * 39, "y" * 40, " " * 50, f"\x0b{LONG}\r", "ſ" * 41, "İ" * 40]
    out = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 6)))) for i in range(40)]
    out += [(40, None), (41, ""), (None, LONG), (None, None), (7, LONG + "\n\n"), (42, "\n".join([LONG] * 4)), (42, "\n".join([LONG] * 4)), (3, out[3][1])]
    out += [(43, "\n".join(f"line {i} of a text that goes on and on and on" for i in range(20_000)))]
    out += [(50 + i, f"line {i * 7} of a text that goes on and on and on\nend") for i in range(4)]
    return out + [(60 + i, "line 8 of a text that goes on and on and on\nown " + "z" * i * 20) for i in range(6)]


def test_matches_the_plain_rule(spark, make_docs):
    docs = make_docs(*rows()).withColumnRenamed("lang", "places").withColumnRenamed("source", "rows")
    assert found(docs) == plain(rows())


def test_many_shared_lines_take_the_shuffled_way(spark, make_docs, monkeypatch):
    monkeypatch.setattr(lines, "SENT_HASHES", 1)
    monkeypatch.setattr("eventloom.llm.common.HOT_KEYS", 3)
    assert found(make_docs(*rows())) == plain(rows())


def test_empty_table_and_no_python(spark, make_docs, capsys):
    assert found(make_docs()) == []
    lines.digest(lines.drop_shared_lines(make_docs(*rows()))).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_sql(spark, sf):
    assert compare(op12_lines(spark, sf), connect(sf), SQL["op12_lines"]).startswith("ok")


def test_digest(spark, make_docs):
    out = lines.digest(lines.drop_shared_lines(make_docs((1, None)))).head()
    assert (out.n_lines, out.n_dropped, out.kept_sha256) == (1, 0, hashlib.sha256(b"").hexdigest())

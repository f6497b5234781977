"""Repair of conversations: the cheapest edits after which the turns follow the grammar ``(system? (user assistant)+)?``.

The edits of a conversation are a path through a lattice: a node is a number of rows read and the state of the grammar, an arc
keeps, reroles or deletes the next row or inserts an empty turn, at a small integer cost. The shortest path is found by
an auction: every node has a price, the path grows by the cheapest arc as long as its end's price is right, and else raises that price and
steps back. Converged prices expose the tight arcs, and the path that reads least in ASCII is traced over these.

Rows of a conversation are sorted and read in a stream, one conversation at a time. One too long for that is cut into chunks of its
sorted rows: the auction gives each chunk's costs between all states at its borders, these add up to prices of the borders, and each
chunk is then solved on its own against the prices behind it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup, materialize, partitions, without

#: White space, what ends a whole text, costs of the edits.
BLANKS = " \t\n\x0b\x0c\r"
ENDINGS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
WHOLE, BLANK, DUPLICATE, CUT_OFF = "", "blank", "duplicate", "truncated"
#: A longer conversation is cut into chunks of at most so many rows and bytes of text.
CHUNK_ROWS, CHUNK_BYTES = 2048, 4_000_000
#: Rows between the borders whose prices are settled one after another, from the end.
STRIDE = 16

#: States of the grammar: nothing read, behind a system turn, behind a user's, behind an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: From each state, by the initial of the next turn, the state behind it.
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: What an inserted or reroled turn is, from each state.
GIVEN = ("u", "u", "a", "u")
ROLES = {"u": "user", "a": "assistant"}
FAR = 1 << 60

#: A row as one letter: its initial, in lower case if whole, in upper case if truncated; '-' if it has to go.
GONE, OTHER = "-", "o"


class Lattice:
    """Nodes are ``row * STATES + state``, then one more, the end. ``exits`` are the prices of the four states behind the last row."""

    def __init__(self, kinds: str, exits: tuple[int | None, ...]):
        self.kinds, self.exits = kinds, exits
        self.end = (len(kinds) + 1) * STATES
        #: No way leads back to START or SYSTEM, so where only these may be left over, the others are dead ends.
        self.dead = () if exits[USER] is not None or exits[ASSISTANT] is not None else (USER, ASSISTANT)

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        """Letter, cost and node behind each arc, by letter."""
        row, state = divmod(node, STATES)
        if state in self.dead:
            return []
        out = []
        if row < len(self.kinds):
            kind = self.kinds[row]
            out.append(("D", DELETE, node + STATES))
        else:
            kind = GONE
            if self.exits[state] is not None:
                out.append(("", self.exits[state], self.end))
        given = GIVEN[state]
        out.append(("I", INSERT, node - state + NEXT[state][given]))
        if kind != GONE:
            extra = TRUNCATED if kind.isupper() else 0
            behind = NEXT[state].get(kind.lower())
            if behind is not None:
                out.append(("K", extra, node - state + STATES + behind))
            out.append(("R", REROLE + extra, node - state + STATES + NEXT[state][given]))
        return out

    def prices(self, origins: list[int]) -> tuple[list[int], list[list[tuple[str, int, int]]]]:
        """Prices at which every origin's is its distance to the end, and the arcs.

        Origins are taken in turn; a path ends at the end or at a node settled by a path before. Along a path found all prices are right, and
        all are at most the distance. A node without a way to the end gets the price FAR.
        """
        arcs = [self.arcs(node) for node in range(self.end)] + [[]]
        price = [0] * (self.end + 1)
        settled = bytearray(self.end + 1)
        settled[self.end] = 1
        for origin in origins:
            path = [origin]
            while not settled[path[-1]]:
                node = path[-1]
                least, to = FAR, -1
                for _, cost, behind in arcs[node]:
                    if cost + price[behind] < least:
                        least, to = cost + price[behind], behind
                if price[node] < least:
                    price[node] = least
                    if least == FAR and len(path) == 1:
                        break
                    if len(path) > 1:
                        path.pop()
                elif to < 0:
                    break
                else:
                    path.append(to)
            for node in path:
                settled[node] = 1
        return price, arcs

    def origins(self, *last: int) -> list[int]:
        """Borders from the end to the beginning, then ``last``."""
        rows = range(len(self.kinds) - len(self.kinds) % STRIDE, 0, -STRIDE)
        return [row * STATES + state for row in rows for state in range(STATES - 1, -1, -1)] + list(last)

    def trace(self, price: list[int], arcs: list[list[tuple[str, int, int]]], origin: int) -> tuple[str, int]:
        """Letters of the least path over tight arcs, and the state behind the last row."""
        dead = set()
        path, letters = [origin], []
        places = [0]
        while path[-1] != self.end:
            node, options = path[-1], arcs[path[-1]]
            while places[-1] < len(options):
                letter, cost, behind = options[places[-1]]
                places[-1] += 1
                if price[node] == cost + price[behind] and behind not in dead:
                    path.append(behind)
                    letters.append(letter)
                    places.append(0)
                    break
            else:
                dead.add(node)
                path.pop(), places.pop()
                if letters:
                    letters.pop()
        return "".join(letters), path[-2] % STATES


ENDS = (0, None, None, 0)


@lru_cache(maxsize=20_000)
def solve(kinds: str) -> tuple[str, int]:
    """Letters and cost of the cheapest edits of a whole conversation, the least in ASCII of several."""
    lattice = Lattice(kinds, ENDS)
    price, arcs = lattice.prices(lattice.origins(START))
    return lattice.trace(price, arcs, START)[0], price[START]


def border_costs(kinds: str) -> list[int]:
    """Least cost from each state before a chunk to each behind it, row by row; FAR where there is no way."""
    out = np.full((STATES, STATES), FAR)
    for last in range(STATES):
        lattice = Lattice(kinds, tuple(0 if s == last else None for s in range(STATES)))
        price, _ = lattice.prices(lattice.origins(*range(STATES)))
        out[:, last] = np.minimum(price[:STATES], FAR)
    return out.ravel().tolist()


def chunk_edits(kinds: str, exits: tuple[int, ...]) -> tuple[list[str], list[int]]:
    """From each state before a chunk the letters of its edits, and the state behind it, given the prices there."""
    lattice = Lattice(kinds, tuple(None if e >= FAR else e for e in exits))
    price, arcs = lattice.prices(lattice.origins(*range(STATES)))
    found = [lattice.trace(price, arcs, state) for state in range(STATES)]
    return [letters for letters, _ in found], [state for _, state in found]


def steps(kinds: str, letters: str, state: int) -> Iterator[tuple[str, int, str | None]]:
    """Each edit's letter, the row it takes (None an inserted turn), and the role it gives (None if the row's own stays)."""
    row = 0
    for letter in letters:
        initial = kinds[row].lower() if letter == "K" else GIVEN[state]
        yield letter, None if letter == "I" else row, ROLES[initial] if letter in "IR" else None
        row += letter != "I"
        if letter != "D":
            state = NEXT[state][initial]


EDITS = "none boolean, conv long, place long, edit string, turn long, fault string, cost long, was string, role string, text string"
_EDIT_TYPES = [pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
_NAMES = [part.split()[0] for part in EDITS.split(", ")]
_COSTS = {"K": 0, "D": DELETE, "I": INSERT, "R": REROLE}


def _kind(role: str, fault: str) -> str:
    if fault in (BLANK, DUPLICATE):
        return GONE
    kind = role[:1] if role[:1] in ("s", "u", "a") else OTHER
    return kind.upper() if fault == CUT_OFF else kind


Turn = tuple[int | None, str, str, str]


def _edit_rows(none: bool, conv: int, first: int, turns: list[Turn], letters: str, state: int) -> Iterator[tuple]:
    kinds = "".join(_kind(role, fault) for _, role, _, fault in turns)
    for place, (letter, row, given) in enumerate(steps(kinds, letters, state), first):
        turn, was, text, fault = turns[row] if row is not None else (None, None, "", None)
        cost = _COSTS[letter] + (TRUNCATED if fault == CUT_OFF and letter != "D" else 0)
        role = None if letter == "D" else given or was
        yield none, conv, place, letter, turn, fault, cost, was, role, text


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Edits in batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or "")
        if len(held) >= 5000 or size > 4_000_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _EDIT_TYPES)], names=_NAMES)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _EDIT_TYPES)], names=_NAMES)


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted; each conversation is held until its last row is read, then solved."""

    def solved() -> Iterator[tuple]:
        key, turns, seen = None, [], set()
        for batch in batches:
            for none, conv, turn, role, text, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if (none, conv) != key:
                    if turns:
                        yield from done(key, turns)
                    key, turns, seen = (none, conv), [], set()
                if fault != BLANK and (role, text) in seen:
                    fault = DUPLICATE
                seen.add((role, text))
                turns.append((turn, role, text, fault))
        if turns:
            yield from done(key, turns)

    def done(key: tuple[bool, int], turns: list[Turn]) -> Iterator[tuple]:
        letters, _ = solve("".join(_kind(role, fault) for _, role, _, fault in turns))
        return _edit_rows(*key, 0, turns, letters, START)

    return _batches(solved())


def _fault(role: Column, text: Column) -> Column:
    """Blank or truncated, or neither; duplicates are found later."""
    whole = F.rtrim(text, F.lit(BLANKS))
    last = F.substr(whole, F.length(whole))
    return F.when(F.length(whole) == 0, BLANK).when(F.instr(F.lit(ENDINGS), last) == 0, CUT_OFF).otherwise(WHOLE)


_KEYS = ["none", "conv"]
#: Edits of a chunk are numbered within this.
_CHUNK_PLACES = 1 << 16


def _long_edits(rows: DataFrame, chunk_rows: int, chunk_bytes: int) -> DataFrame:
    """Edits of conversations that are too long for one task, chunk by chunk."""
    stored = materialize(rows.withColumn("row", F.monotonically_increasing_id()))
    name = [F.xxhash64(F.lit(i), F.length("role"), "role", "text").alias(f"hash_{i}") for i in (1, 2)]
    named = stored.select(*_KEYS, F.col("turn"), "row", *name)
    same = [*_KEYS, "hash_1", "hash_2"]
    first = F.min(F.struct(F.col("turn").isNotNull(), "turn", "row"))["row"].alias("first")
    several = named.groupBy(*same).agg(first, F.count("*").alias("rows")).filter("rows > 1")
    again = lookup(named, several, same, "rows").filter("row <> first").select("row", F.lit(DUPLICATE).alias("again"))
    faults = F.when(F.col("fault") == BLANK, BLANK).otherwise(F.coalesce("again", "fault"))
    initial = F.substr(F.col("role"), F.lit(1), F.lit(1))
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise(OTHER)
    kind = F.when(F.col("fault").isin(BLANK, DUPLICATE), GONE).when(F.col("fault") == CUT_OFF, F.upper(letter)).otherwise(letter)
    marked = stored.join(again, "row", "left").withColumn("fault", faults).drop("again").withColumn("kind", kind)
    order = ["none", "conv", F.asc_nulls_first("turn"), "role", "text", "row"]
    ranges = max(partitions(rows.sparkSession), -(-stored.count() // (64 * chunk_rows)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, key, place, size = TaskContext.get().partitionId() << 32, None, 0, 0
        for batch in batches:
            chunks, places = [], []
            for none, conv, text in zip(*(batch.column(c).to_pylist() for c in ("none", "conv", "text"))):
                if key != (none, conv) or place >= chunk_rows or size >= chunk_bytes:
                    key, place, size = (none, conv), 0, 0
                    chunk += 1
                chunks.append(chunk)
                places.append(place)
                place += 1
                size += len(text)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(chunks, pa.int64()), pa.array(places, pa.int64())], names=[*batch.schema.names, "chunk", "place"]
            )

    placed = marked.select("none", "conv", "turn", "role", "text", "row", "fault", "kind").repartitionByRange(ranges, *order)
    placed = placed.sortWithinPartitions(*order).drop("row")
    fields = "none boolean, conv long, turn long, role string, text string, fault string, kind string, chunk long, place long"
    turns = materialize(placed.mapInArrow(cut, fields))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("place", "kind"))), lambda t: t["kind"])
    chunks = materialize(turns.groupBy(*_KEYS, "chunk").agg(F.array_join(in_order, "").alias("kinds")))

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [border_costs(k) for k in batch.column("kinds").to_pylist()]
            yield pa.record_batch([*batch.columns[:3], pa.array(found, pa.list_(pa.int64()))], names=[*_KEYS, "chunk", "costs"])

    def back(table: pa.Table) -> pa.Table:
        """Prices behind each chunk, from the last to the first."""
        table = table.sort_by("chunk")
        behind = np.array([FAR if e is None else e for e in ENDS])
        exits = []
        for costs in reversed(table["costs"].to_pylist()):
            exits.append(behind.tolist())
            behind = np.minimum((np.array(costs).reshape(STATES, STATES) + behind).min(1), FAR)
        return table.drop(["costs"]).append_column("exits", pa.array(exits[::-1], pa.list_(pa.int64())))

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [chunk_edits(k, tuple(e)) for k, e in zip(batch.column("kinds").to_pylist(), batch.column("exits").to_pylist())]
            letters, states = pa.array([f[0] for f in found], pa.list_(pa.string())), pa.array([f[1] for f in found], pa.list_(pa.int64()))
            yield pa.record_batch([*batch.columns[:3], letters, states], names=[*_KEYS, "chunk", "letters", "states"])

    def forth(table: pa.Table) -> pa.Table:
        """The state before each chunk, and its number in the conversation."""
        table = table.sort_by("chunk")
        state, entries = START, []
        for states in table["states"].to_pylist():
            entries.append(state)
            state = states[state]
        table = table.drop(["states"]).append_column("entry", pa.array(entries, pa.int64()))
        return table.append_column("number", pa.array(range(len(entries)), pa.int64()))

    # One row for each chunk of a conversation: chunk_rows times fewer than its turns.
    key = "none boolean, conv long, chunk long"
    costs = chunks.mapInArrow(cost, f"{key}, costs array<long>")
    exits = costs.groupBy(*_KEYS).applyInArrow(back, f"{key}, exits array<long>")
    edits = chunks.join(exits, [*_KEYS, "chunk"]).select(*_KEYS, "chunk", "kinds", "exits")
    edits = materialize(edits.mapInArrow(edit, f"{key}, letters array<string>, states array<long>"))
    entries = edits.drop("letters").groupBy(*_KEYS).applyInArrow(forth, f"{key}, entry long, number long")
    chosen = edits.join(entries, [*_KEYS, "chunk"]).select(*_KEYS, "chunk", "entry", "number", F.col("letters")[F.col("entry")].alias("letters"))

    def emit(given: pa.Table, path: pa.Table) -> pa.Table:
        given = given.sort_by("place")
        turns_ = list(zip(*(given[c].to_pylist() for c in ("turn", "role", "text", "fault"))))
        [(none, conv, entry, number, letters)] = zip(*(path[c].to_pylist() for c in ("none", "conv", "entry", "number", "letters")))
        out = list(_edit_rows(none, conv, number * _CHUNK_PLACES, turns_, letters, entry))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), _EDIT_TYPES)], names=_NAMES)

    by = [*_KEYS, "chunk"]
    return turns.groupBy(*by).cogroup(chosen.groupBy(*by)).applyInArrow(emit, EDITS)


def repair(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    chunk_rows: int = CHUNK_ROWS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``conv_id, place, edit, turn, fault, cost, was, role, text``: the edits of every conversation, in order of ``place``.

    ``edit`` is K, R, D or I; ``was`` is the row's role, ``role`` the repaired one (null if deleted); ``fault`` is blank, duplicate,
    truncated or empty, null for an inserted turn. Rows are taken by turn, nulls first, ties by role and text. Only the first fault
    counts: no character but white space; role and text of an earlier row; no ``.``, ``!`` or ``?`` at the end. Roles count by
    their first letter. Blank and duplicate rows go; of equally cheap repairs the one with the least letters in ASCII stands.

    A null role or text is one space; rows of a null id are one conversation; other columns are not read; an empty
    table gives no rows. Duplicates in conversations of over ``chunk_rows`` rows or ``chunk_bytes`` bytes are told by 128 bits of hash.
    """
    assert 3 * chunk_rows + 8 < _CHUNK_PLACES
    own = rows.select(
        F.col(conv_id).isNull().alias("none"),
        F.coalesce(F.col(conv_id).cast("long"), F.lit(0)).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    ).withColumn("fault", _fault(F.col("role"), F.col("text")))
    sizes = own.groupBy(*_KEYS).agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes"))
    large = materialize(sizes.filter((F.col("rows") > chunk_rows) | (F.col("bytes") > chunk_bytes)).drop("bytes"))
    has_large = bool(large.head(1))
    short = without(own, large, _KEYS, "rows") if has_large else own
    short = short.select("none", "conv", "turn", "role", "text", "fault").repartition(*_KEYS)
    short = short.sortWithinPartitions("none", "conv", F.asc_nulls_first("turn"), "role", "text")
    edits = short.mapInArrow(_short, EDITS)
    if has_large:
        edits = edits.unionByName(_long_edits(lookup(own, large, _KEYS, "rows"), chunk_rows, chunk_bytes))
    return edits.select(F.when(~F.col("none"), F.col("conv")).alias("conv_id"), *_NAMES[2:])


def damage(rows: DataFrame) -> DataFrame:
    """Rows damaged by a checksum of ``conv_id:turn``, in which a null is one space: some dropped, emptied, cut, repeated or given to the user."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(said[0], F.lit(":"), said[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return (
        rows.withColumn("kind", kind)
        .filter("kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, "user").otherwise(role).alias("role"),
            F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ENDINGS, "")).otherwise(text).alias("text"),
            F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


_DIGEST = (
    "none boolean, conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
_LEGAL = {"su", "ua", "au"}


class _Summary:
    """What is kept of a conversation while its edits pass."""

    def __init__(self, key: tuple[bool, int]):
        self.key, self.audit, self.cost, self.illegal = key, [], 0, 0
        self.faults = dict.fromkeys((BLANK, DUPLICATE, CUT_OFF), 0)
        self.least = self.most = self.before = None
        self.turns, self.repaired, self.gap = 0, hashlib.sha256(), ""

    def add(self, letter: str, turn: int | None, fault: str | None, cost: int, was: str | None, role: str | None, text: str) -> None:
        self.audit.append(letter)
        self.cost += cost
        if letter != "I":
            if fault:
                self.faults[fault] += 1
            self.illegal += self.before is not None and self.before + was[:1] not in _LEGAL
            self.before = was[:1]
            if turn is not None and turn != self.most:
                self.least, self.most, self.turns = turn if self.least is None else self.least, turn, self.turns + 1
        if letter != "D":
            self.repaired.update(f"{self.gap}{role}:{text}".encode())
            self.gap = "\n"

    def row(self) -> tuple:
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return (*self.key, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.repaired.hexdigest())


def digest(edits: DataFrame, ids: DataFrame) -> DataFrame:
    """For each ``conv_id`` of ``ids`` its faults, missing turns, the cost and letters of its edits, and a hash of the repaired rows.

    ``gaps`` counts turn numbers that are missing between the first and the last; ``illegal`` neighbouring rows whose initials don't follow
    one another. Edits are read in a stream, of which the letters and sums are kept.
    """
    key = [F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv")]
    marks = ids.select(*key).distinct().withColumn("place", F.lit(-1).cast("long"))
    rows = edits.select(*key, "place", "edit", "turn", "fault", "cost", "was", "role", "text").unionByName(marks, allowMissingColumns=True)
    names = [part.split()[0] for part in _DIGEST.split(", ")]
    types = [pa.bool_(), *[pa.int64()] * 7, pa.string(), pa.string()]

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now = [], None
        for batch in batches:
            for none, conv, place, *edit in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.key != (none, conv):
                    if now:
                        done.append(now.row())
                    now = _Summary((none, conv))
                if place >= 0:
                    now.add(*edit)
            if len(done) >= 5000:
                yield batch_of(done)
                done = []
        if now:
            yield batch_of([*done, now.row()])

    ordered = rows.repartition("none", "conv").sortWithinPartitions("none", "conv", "place")
    return ordered.mapInArrow(run, _DIGEST).select(F.when(~F.col("none"), F.col("conv")).alias("conv_id"), *names[2:])

"""Secrets in texts: fixed patterns, and a battery of randomness tests over other encoded-looking strings.

For a string the encoding is inferred, and three statistics are formed over the places of its characters in that alphabet:
chi-squared against uniform use of the alphabet, the number of runs above and below its middle, and the serial correlation
at lag one. A string whose statistics fit a random source and whose chi-squared is lower than that of ordinary text of its
length is reported. How much lower is set by the Benjamini-Hochberg rule over all strings of all texts: chi-squared is held
against its distribution for text of the same length, so short strings need no cut-off of their own.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces

# The patterns, and the least length of what they find.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGNED = 12
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}")
#: Alphabets in the order of inference: name, characters in order, and the coincidence index of ordinary text in it.
ALPHABETS = (
    ("hex", "0123456789abcdef", 0.15),
    ("HEX", "0123456789ABCDEF", 0.15),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.08),
    ("upper", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", 0.075),
    ("lower", "0123456789abcdefghijklmnopqrstuvwxyz", 0.075),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 0.065),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 0.065),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", 0.065),
)
#: For strings of letters only.
LETTERS = (
    ("capitals", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", 0.067),
    ("small", "abcdefghijklmnopqrstuvwxyz", 0.067),
    ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 0.065),
)
#: A key may stand beside words or paths in one run: it is taken apart at the marks that either base64 lacks, and at all.
MARKS = (re.compile(r"[^-_]{16,}"), re.compile(r"[^+/]{16,}"), re.compile(r"[^+/_-]{16,}"))
LEAST_LENGTH = 16
#: The share of false discoveries allowed, and the least probability that a random source gives such statistics.
FALSE_DISCOVERIES = 0.05
LEAST_FIT = 0.003
#: Bins per unit of -log10 p in which p-values are counted, and the number of bins.
BINS_PER_UNIT, BINS = 50, 2000

_SETS, _LETTER_SETS = (
    [(frozenset(chars), {c: i for i, c in enumerate(chars)}, len(chars), index) for _, chars, index in alphabets]
    for alphabets in (ALPHABETS, LETTERS + ALPHABETS)
)


def _upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(string: str, mixed: bool = True) -> tuple[float, float] | None:
    """Probabilities of a chi-squared this low in ordinary text, and of statistics this far out from a random source.

    None if no encoding fits; with ``mixed``, also for strings without letters or without digits.
    """
    chars = set(string)
    digits = any(c.isdigit() for c in chars)
    if mixed and not (digits and any(c.isalpha() for c in chars)):
        return None
    for members, places, size, coincidence in _SETS if digits else _LETTER_SETS:
        if chars <= members:
            break
    else:
        return None
    x = np.array([places[c] for c in string])
    n = len(x)
    chi = float((np.bincount(x, minlength=size) ** 2).sum() * size / n - n)
    mean, var = size - 1, 2 * (size - 1) * (n - 1) / n
    shift = (n - 1) * (coincidence * size - 1)
    as_text = _upper_tail((mean + shift - chi) / math.sqrt(var + 4 * shift))
    tests = [_upper_tail((chi - mean) / math.sqrt(var))]
    high = x >= size / 2
    ones = int(high.sum())
    zeros = n - ones
    if ones and zeros:
        expected = 1 + 2 * ones * zeros / n
        spread = (expected - 1) * (expected - 2) / (n - 1)
        runs = 1 + int((high[1:] != high[:-1]).sum())
        tests.append(2 * _upper_tail(abs(runs - expected) / math.sqrt(spread)) if spread > 0 else 1.0)
    else:
        tests.append(2.0 ** (1 - n))
    centred = x - x.mean()
    power = float((centred**2).sum())
    tests.append(2 * _upper_tail(abs(float((centred[1:] * centred[:-1]).sum()) / power + 1 / n) * math.sqrt(n)) if power else 0.0)
    return as_text, min(1.0, 3 * min(tests))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the fixed patterns find, in code points."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED] if ":" in text or "=" in text else []
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, float]]:
    """Start, end and p-value of all strings tested, which touch no span of ``base``: whole runs and parts of them.

    The p-value is 1 where the statistics don't fit a random source: the string counts as tested, and is not found.
    """
    k = 0
    for m in CANDIDATE.finditer(text):
        while k < len(base) and base[k][2] <= m.start():
            k += 1
        at, free = m.start(), []
        j = k
        while j < len(base) and base[j][0] < m.end():
            free.append((at, base[j][0]))
            at = max(at, base[j][2])
            j += 1
        free.append((at, m.end()))
        for start, end in free:
            if end - start < LEAST_LENGTH:
                continue
            found = {(start, end), *(p.span() for marks in MARKS for p in marks.finditer(text, start, end))}
            for x, y in sorted(found):
                tested = battery(text[x:y], mixed=False)
                if tested:
                    yield x, y, tested[0] if tested[1] >= LEAST_FIT else 1.0


def _bin(p: float) -> int:
    return min(BINS - 1, int(-math.log10(max(p, 1e-300)) * BINS_PER_UNIT))


def threshold(docs: DataFrame, text: str = "text") -> int:
    """The least bin of -log10 p that the Benjamini-Hochberg rule accepts over all texts; BINS if none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BINS, np.int64)
        for batch in pieces(batches, "text"):
            for value in batch.column("text").to_pylist():
                if value:
                    for _, _, p in candidates(value, base_spans(value)):
                        counts[_bin(p)] += 1
        used = np.flatnonzero(counts)
        yield pa.record_batch({"bin": pa.array(used, pa.int32()), "n": pa.array(counts[used])})

    rows = docs.select(F.col(text).alias("text")).mapInArrow(run, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    total, seen, least = sum(r["n"] for r in rows), 0, BINS  # all strings tested
    for r in sorted(rows, key=lambda r: -r["bin"]):
        seen += r["n"]
        if 10 ** (-r["bin"] / BINS_PER_UNIT) <= FALSE_DISCOVERIES * seen / total:
            least = r["bin"]
    return least


def spans(text: str | None, least: int) -> list[tuple[int, int, int]]:
    """All spans of a text by start, then kind: fixed patterns, and random strings from bin ``least`` on."""
    if not text:
        return []
    base = base_spans(text)
    out, last = list(base), 0
    # A part of a string that is found itself is not reported again.
    for a, b, _ in sorted(((a, b, p) for a, b, p in candidates(text, base) if _bin(p) >= least), key=lambda c: (c[0], -c[1])):
        if b > last:
            out.append((a, 3, b))
            last = b
    return sorted(out)


def scan(docs: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """Adds ``secrets`` (or ``into``), an array of (kind, start, end) in code points, in place of a column of this name.

    Null and empty texts have an empty array. Repeated rows are found in each. The time a text takes grows with its length and its
    number of spans, not with their product.
    """
    docs = docs.drop(into)
    least = threshold(docs, text)
    kind = T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long"))
    schema = T.StructType([*docs.schema.fields, T.StructField(into, kind)])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            found = [
                [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans(value, least)] for value in batch.column(text).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, arrow)], names=[*batch.schema.names, into])

    return docs.mapInArrow(run, schema)


def joined(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(scanned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts by kind and the spans as text, for each row of ``scan``."""
    found = F.col("secrets")
    count = lambda kind: F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        F.col(doc_id).alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(joined(F.filter(found, lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        joined(found).alias("spans"),
        count(KINDS[3]).alias(f"n_{KINDS[3]}"),
    )


def redact(scanned: DataFrame, text: str = "text", mark: str = "[SECRET]", found: str = "secrets") -> DataFrame:
    """Puts ``mark`` in the text in place of each run of overlapping spans; drops ``found``. Other texts stay as they are."""
    cut = F.aggregate(
        found,
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["end"] <= acc["at"], acc)
        .when((s["start"] < acc["at"]), F.struct(s["end"].alias("at"), acc["out"].alias("out")))
        .otherwise(
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    acc["out"],
                    F.substr(F.col(text), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                    F.lit(mark),
                ).alias("out"),
            )
        ),
        lambda acc: F.concat(acc["out"], F.substr(F.col(text), (acc["at"] + 1).cast("int"))),
    )
    return scanned.withColumn(text, F.when(F.size(found) == 0, F.col(text)).otherwise(cut)).drop(found)

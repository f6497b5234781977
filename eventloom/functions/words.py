"""Which of many words a text holds, and which of its words stand near numbers or given words."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


@cache
def _automaton(words: tuple[str, ...]):
    """The Aho-Corasick automaton of the words, built once a worker."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for place, word in enumerate(words):
        automaton.add_word(word, place)
    automaton.make_automaton()
    return automaton


def places_of_words(words: tuple[str, ...], texts: pa.Array, any_case: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """For all texts in turn the places of the words they hold, in order, and the number of words of each text."""
    search, places, counts = _automaton(words).iter, [], []
    for text in texts.to_pylist():
        held = sorted({place for _, place in search(text.lower() if any_case else text)}) if text else []
        places += held
        counts.append(len(held))
    return np.array(places, np.int64), np.array(counts, np.int32)


def words_in(text: Column, words: Sequence[str], any_case: bool = False) -> Column:
    """Array of those of ``words`` that occur in the text, inside other words too, in the order given; a NULL text holds none.

    Each text is read once, whatever the number of words, where ``contains`` would read it once a word. The
    words are distinct and not empty; letters match as they are, or in ``any_case``, for lower-case ASCII words, as after ``lower``.
    """
    known = tuple(words)
    if not known:
        return F.array().cast("array<string>")

    @F.arrow_udf("array<string>")
    def search(texts: pa.Array) -> pa.Array:
        places, counts = places_of_words(known, texts, any_case)
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(known, pa.string()).take(pa.array(places)))

    return search(text)


#: Bytes of text whose words are looked at at once, so few that they stay in the cache; a longer text is looked at alone.
PIECE_BYTES = 120_000
#: First bytes of digits outside ASCII; other letters of their scripts begin with them too.
DIGIT_BYTES = b"\xd9\xdb\xdf\xe0\xe1\xea\xef\xf0"
#: Characters outside ASCII that Java takes for the other case of an ASCII letter.
ODD_CASES = "ıİſ\u212a"


def _spaces(data: np.ndarray) -> np.ndarray:
    """Which bytes are white space of ASCII. Comparisons run over bytes; a table of 256 would be indexed by 8-byte integers."""
    return (data - np.uint8(9) < 5) | (data - np.uint8(28) < 5)


def _digits(data: np.ndarray) -> np.ndarray:
    found = data - np.uint8(ord("0")) < 10
    for first in DIGIT_BYTES if data.max(initial=0) > 127 else b"":
        found |= data == first
    return np.flatnonzero(found)


def _starts(data: np.ndarray, starts: tuple[str, ...]) -> np.ndarray:
    """Where the first four letters of any of ``starts`` stand, in any case, or a letter of odd case; the end may add places."""
    low = data | np.uint8(32)
    both = low[:-1].astype(np.uint16) << 8 | low[1:]
    pair = np.zeros(len(both), bool)
    for two in {text.encode()[:2] for text in (*starts, *ODD_CASES)}:
        pair |= both == (int.from_bytes(two) | 0x2020)
    at = np.flatnonzero(pair)
    four = np.zeros(len(at), np.uint32)
    for i in range(4):
        four = four << 8 | low.take(at + i, mode="clip")
    found = data[at] >= 128
    for start in {start[:4] for start in starts}:
        found |= four >> 8 * (4 - len(start)) == int.from_bytes(start.encode())
    return at[found]


def _near(
    data: np.ndarray, bounds: np.ndarray, numbers: tuple[int, int], starts: tuple[str, ...], places: tuple[int, int]
) -> tuple[np.ndarray, np.ndarray]:
    """``words_near`` of the texts between ``bounds``: the bytes of all results, and their bounds."""
    space = _spaces(data)
    opens = ~space
    opens[1:] &= space[:-1]
    begin = bounds[:-1][bounds[:-1] < len(data)]
    opens[begin] = ~space[begin]
    at = np.flatnonzero(opens)
    edges = np.searchsorted(at, bounds)
    end = np.append(at[1:], len(data))[: len(at)]
    some = edges[1:] > edges[:-1]
    end[edges[1:][some] - 1] = bounds[1:][some]
    kept = np.zeros(len(at), bool)
    for found, (before, after) in ((_digits(data), numbers), (_starts(data, starts), places)):
        hit = np.zeros(len(at) + before + after, bool)
        hit[np.searchsorted(at, found, "right") - 1 + after] = True
        for shift in range(before + after + 1):
            kept |= hit[shift : shift + len(at)]
    bar = ~kept
    bar[1:] &= kept[:-1]
    bar[edges[:-1][some]] = False
    size = np.where(kept, end - at, bar)
    ends = np.concatenate([[0], np.cumsum(size)])
    chosen = np.flatnonzero(size)
    out = data[np.arange(ends[-1]) + np.repeat(at[chosen] - ends[chosen], size[chosen])]
    out[ends[:-1][bar]] = ord("|")
    return out, ends[edges]


def words_near(text: Column, numbers: tuple[int, int], starts: Sequence[str], places: tuple[int, int]) -> Column:
    """The text without the words that are far from every number and every one of ``starts``; a bar stands for words left out.

    ``numbers`` are how many words before and after a word with a digit stay with it, ``places`` the same of words that hold one of
    ``starts``, in any case that Java's ``(?iu)`` allows. A pattern finds the same in the result as in the text if its matches hold a
    digit or one of ``starts``, take no more words than that, no bar, and do not depend on what stands around them. Some other words
    may stay. Words end at white space of ASCII; ``starts`` have three or more lower-case ASCII letters. A NULL text counts as empty.
    """
    known = tuple(starts)

    @F.arrow_udf("string")
    def near(texts: pa.Array) -> pa.Array:
        texts = texts.cast(pa.string())
        if not len(texts):
            return texts
        bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset :][: len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        parts, ends, first = [], [np.zeros(1, np.int64)], 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + PIECE_BYTES, "right")) - 1)
            a, b = bounds[first], bounds[last]
            out, stops = _near(data[a:b], bounds[first : last + 1] - a, numbers, known, places)
            parts.append(out.tobytes())
            ends.append(stops[1:] + ends[-1][-1])
            first = last
        offsets = np.concatenate(ends).astype(np.int32)
        return pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(b"".join(parts)))

    return near(text)

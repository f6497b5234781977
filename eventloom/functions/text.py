"""String helpers on JVM built-ins only."""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import WHITESPACE

SPACE_RUN = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]+"


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def collapse(col: Column) -> Column:
    """Each run of white space becomes one blank."""
    return F.regexp_replace(col, SPACE_RUN, " ")


def collapse_long(col: Column) -> Column:
    """``collapse`` for long texts: only those with more than single blanks are rewritten, by Arrow in Python workers."""
    uneven = SPACE_RUN.replace(f"\\x{{{ord(' '):x}}}", "")[:-1] + "|  "
    run = SPACE_RUN

    @F.arrow_udf("string")
    def collapsed(texts: pa.Array) -> pa.Array:
        found = pc.match_substring_regex(texts, uneven)
        if not pc.any(found).as_py():
            return texts
        return pc.if_else(found, pc.replace_substring_regex(pc.if_else(found, texts, ""), run, " "), texts)

    return collapsed(col)


def filled(col: Column) -> Column:
    """Neither NULL nor the empty string."""
    return F.coalesce(col != "", F.lit(False))


def contains_ci(col: Column, text: str) -> Column:
    """SQL ``LIKE '%text%'``: case-insensitive, ``%`` and ``_`` in the text stay wildcards."""
    return col.ilike(f"%{text}%")


def any_word(text: Column, words: list[str]) -> Column:
    """Substring match of any word against an already lower-cased text."""
    hit = text.contains(words[0])
    for word in words[1:]:
        hit = hit | text.contains(word)
    return hit


def unicode_pattern(pattern: str) -> str:
    """Digits and white space of a pattern widened to what Python's ``re`` accepts."""
    space = SPACE_RUN[:-1]
    return re.sub(r"\\d", r"\\p{Nd}", pattern).replace(r"\s", space)


def abridge(col: Column, limit: int = 200) -> Column:
    return F.when(F.length(col) > limit, F.concat(F.substring(col, 1, limit - 3), F.lit("..."))).otherwise(col)


def slug(col: Column) -> Column:
    """Lower-case ASCII words joined by '-'."""
    dashed = F.regexp_replace(F.lower(col), "[^a-z0-9]+", "-")
    return F.btrim(dashed, F.lit("-"))


def title_words(col: Column) -> Column:
    return F.initcap(F.replace(col, F.lit("_"), F.lit(" ")))


def let(name: str, value: str, body: str) -> str:
    """SQL that evaluates ``value`` once per row and uses it as ``name`` in ``body``.

    A plain column would be merged into the lambda that uses it and be computed again for every element.
    """
    return f"transform(array({value}), {name} -> {body})[0]"

"""Joins on narrow rows of events before their whole texts are fetched, so that no join shuffles the texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

Step = Callable[[DataFrame], DataFrame]
#: Reads events; a step is done to their rows before texts are fetched, and columns that it adds are passed on.
Reader = Callable[[Step], DataFrame]


def split_by_id(events: Reader) -> tuple[Reader, DataFrame]:
    """Readers' rows whose id no other row has, as a reader, and all others.

    What is made of one of the first rows belongs to it alone, so it may stand beside it and need not be joined by id. A missing id
    is among the others.
    """
    ids = events(lambda rows: rows).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    repeated = cut_lineage(ids.filter("n > 1 OR id IS NULL").select("id"))
    if repeated.isEmpty():
        return events, events(lambda rows: rows).limit(0)
    key = F.expr("id <=> repeated_id")
    repeated = repeated.withColumnRenamed("id", "repeated_id")
    once = lambda step: events(lambda rows: step(rows.join(repeated, key, "left_anti")))
    return once, events(lambda rows: rows.join(repeated, key, "left_semi"))

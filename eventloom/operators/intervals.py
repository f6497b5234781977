"""Event intervals, overlap degrees and overlapping pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import minute_of_day, strict_date, untimed
from ..session import cut_lineage
from ..vocab import DAY_MICROS, EVENT_MINUTES, MINUTE_MICROS
from .pairing import spread_join

DAY_MINUTES = 1440
#: Pairs of rows of one cell that one task compares, about.
TASK_PAIRS = 5_000_000


def with_interval(events: DataFrame) -> DataFrame:
    """Adds ``all_day``, ``day``, ``minute``, ``start_us`` and ``end_us``.

    ``day`` counts days since 1970-01-01, ``minute`` minutes since midnight (0 for an untimed event); the bounds are
    epoch microseconds and are NULL when date or time do not parse.
    """
    time = F.col("time")
    parts = events.withColumns(
        {
            "all_day": untimed(time),
            "day": F.unix_date(strict_date(F.col("date"))).cast("bigint"),
            "minute": F.when(untimed(time), F.lit(0)).otherwise(minute_of_day(time)),
        }
    ).withColumn("start_us", F.expr(f"day * {DAY_MICROS} + minute * {MINUTE_MICROS}L"))
    length = f"IF(all_day, {DAY_MICROS - 1}L, {EVENT_MINUTES * MINUTE_MICROS}L)"
    return parts.withColumn("end_us", F.expr(f"start_us + {length}"))


def _slots(events: DataFrame, keys: list[str]) -> DataFrame:
    """Events counted per (keys, day, minute of day, all_day): at most 1,441 rows per key and day."""
    parsed = events.filter("start_us IS NOT NULL")
    return parsed.groupBy(*keys, "day", "minute", "all_day").agg(F.count(F.lit(1)).alias("events"))


def overlap_degrees(events: DataFrame, keys: list[str], across_midnight: bool = True) -> DataFrame:
    """For each (keys, day, minute, all_day): the number of events and how many others each one overlaps.

    No pair is formed. Rows collapse to minute counts with a partial aggregate before the shuffle; the
    window then sees one key and day, i.e. a bounded number of rows however hot the key. With
    ``across_midnight`` counts near midnight also visit the neighbouring day.
    """
    slots = _slots(events, keys)
    spills = f"NOT all_day AND minute > {DAY_MINUTES - EVENT_MINUTES}"
    reached = f"NOT all_day AND minute < {EVENT_MINUTES - 1}"
    places = ["struct(0 AS shift, IF(all_day, 'all_day', 'timed') AS kind)"]
    if across_midnight:
        places += [
            f"IF({spills}, struct(1 AS shift, 'timed' AS kind), NULL)",
            f"IF({reached}, struct(-1 AS shift, 'timed' AS kind), NULL)",
            "IF(all_day, struct(-1 AS shift, 'next_all_day' AS kind), NULL)",
        ]
    placed = slots.select(
        *keys, "day", "minute", "events", F.expr(f"inline(array_compact(array({', '.join(places)})))")
    ).select(
        *keys, "events", "kind", "shift", F.expr("day + shift AS day"), F.expr(f"minute - shift * {DAY_MINUTES} AS minute")
    )
    day = Window.partitionBy(*keys, "day")
    near = day.orderBy("minute").rangeBetween(-(EVENT_MINUTES - 1), EVENT_MINUTES - 1)
    scored = placed.withColumns(
        {
            "near": F.sum(F.expr("IF(kind = 'timed', events, 0)")).over(near),
            # Timed rows that touch this day: its own, and those spilling in from the day before.
            "touching": F.sum(F.expr(f"IF(kind = 'timed' AND minute < {DAY_MINUTES}, events, 0)")).over(day),
            "whole_day": F.sum(F.expr("IF(kind = 'all_day', events, 0)")).over(day),
            "next_day": F.sum(F.expr("IF(kind = 'next_all_day', events, 0)")).over(day),
        }
    ).filter("shift = 0")
    others = f"""CASE WHEN kind = 'all_day' THEN whole_day - 1 + touching
        ELSE near - 1 + whole_day + IF(minute > {DAY_MINUTES - EVENT_MINUTES}, next_day, 0) END"""
    return scored.select(
        *keys, "day", "minute", F.expr("kind = 'all_day' AS all_day"), "events", F.expr(others).alias("others")
    )


def islands(events: DataFrame, keys: list[str], across_midnight: bool = True) -> DataFrame:
    """For each (keys, day, minute, all_day): ``island``, where the chain of overlapping events begins that the slot belongs to.

    Ordered by start, a slot begins an island if it starts no earlier than all before it have ended. Ends are carried on in two
    steps, so no task sees more of a key than one day's slots or one row for each of its days: inside a day, and from the
    day before, whose events are the only ones that can reach into it. Without ``across_midnight`` days stand alone.
    """
    start = f"day * {DAY_MICROS} + minute * {MINUTE_MICROS}L"
    length = f"IF(all_day, {DAY_MICROS - 1}L, {EVENT_MINUTES * MINUTE_MICROS}L)"
    slots = _slots(events, keys).withColumn("start", F.expr(start)).withColumn("end", F.expr(f"start + {length}"))
    slots = cut_lineage(slots.drop("events"))
    day_before = F.col("last_day") == F.col("day") - 1
    of_key = Window.partitionBy(*keys).orderBy("day")
    reached = slots.groupBy(*keys, "day").agg(F.max("end").alias("reach"))
    reached = reached.withColumns({"last_day": F.lag("day").over(of_key), "last_reach": F.lag("reach").over(of_key)})
    carried = F.when(day_before, F.col("last_reach")) if across_midnight else F.lit(None).cast("bigint")
    in_day = Window.partitionBy(*keys, "day").orderBy("start", "end", "all_day")
    before = F.max("end").over(in_day.rowsBetween(Window.unboundedPreceding, -1))
    opened = slots.join(reached.select(*keys, "day", carried.alias("carried")), [*keys, "day"])
    reach = F.greatest(before, F.col("carried"))
    opened = opened.withColumn("opens", F.when(reach.isNull() | (F.col("start") >= reach), F.col("start")))
    opened = opened.withColumn("island", F.max("opens").over(in_day))
    if across_midnight:
        # An island that reaches into the day began at the last opening of an earlier one.
        last = opened.groupBy(*keys, "day").agg(F.max("opens").alias("opens"))
        earlier = F.max("opens").over(of_key.rowsBetween(Window.unboundedPreceding, -1))
        opened = opened.join(last.select(*keys, "day", earlier.alias("earlier")), [*keys, "day"])
        opened = opened.withColumn("island", F.coalesce("island", "earlier"))
    return opened.select(*keys, "day", "minute", "all_day", "island")


def pair_count(degrees: DataFrame) -> DataFrame:
    """One row ``pairs``: the number of overlapping pairs behind the degrees."""
    total = F.coalesce(F.sum(F.col("events") * F.col("others")), F.lit(0))
    return degrees.agg(F.floor(total / 2).cast("bigint").alias("pairs"))


def overlapping_pairs(
    events: DataFrame, keys: list[str], order: list[str], carry: list[str], extra: DataFrame | None = None
) -> DataFrame:
    """Every overlapping pair of events that agree on ``keys``, as ``<column>_1`` / ``<column>_2``.

    ``events`` comes from ``with_interval`` and holds ``keys``, ``order`` and ``carry``. Event 1 precedes
    event 2 in ``order`` (NULLs first). The join runs on cells, chosen so that nearly every candidate is a result:
    an hour cell for two timed events, a day cell for a timed and an all-day one, another for two all-day ones.
    ``extra`` (one row per values of the columns it shares with ``events``) adds its other columns to each event.
    """
    hour_us = 60 * MINUTE_MICROS
    parsed = events.filter("start_us IS NOT NULL").withColumn("hour", F.expr(f"start_us div {hour_us}"))
    last_day = f"(end_us - 1) div {DAY_MICROS}"

    def cell(kind: str, index: str, left: int, right: int) -> str:
        return f"struct('{kind}' AS cell_kind, {index} AS cell, {left} AS l, {right} AS r)"

    spill = f"IF({last_day} > day, {cell('mixed', last_day, 1, 0)}, NULL)"
    cells = f"""IF(all_day,
        array({cell("days", "day", 1, 1)}, {cell("mixed", "day", 0, 1)}),
        array_compact(array({cell("hours", "hour", 1, 1)}, {cell("hours", "hour + 1", 0, 1)},
            {cell("mixed", "day", 1, 0)}, {spill})))"""
    cell_keys = [*keys, "cell_kind", "cell"]
    sizes = parsed.select(*keys, F.expr(f"inline({cells})"))
    # Stored: one row per cell, read for the number of tasks and for the hot cells.
    sizes = cut_lineage(sizes.groupBy(*cell_keys).agg(F.sum("l").alias("l"), F.sum("r").alias("r")))
    compared = sizes.agg(F.sum(F.col("l") * F.col("r"))).head()[0] or 0
    tasks = max(events.sparkSession.sparkContext.defaultParallelism, -(-compared // TASK_PAIRS))

    if extra is not None:
        shared = [c for c in extra.columns if c in events.columns]
        parsed = parsed.join(extra, shared, "left")
    fields = list(dict.fromkeys([*carry, "start_us", "end_us"]))
    rank = ", ".join(f"{c} IS NOT NULL AS {c}_set, {c}" for c in order)
    body = f"struct(struct({rank}) AS rank, hour, {', '.join(fields)})"
    placed = parsed.select(*keys, F.expr(f"{body} AS body"), F.expr(f"inline({cells})"))
    left = placed.filter("l = 1").select(*cell_keys, F.col("body").alias("a"))
    right = placed.filter("r = 1").select(*cell_keys, F.col("body").alias("b"))
    # Same hour or same day: each pair meets twice, keep one order. Otherwise it meets once.
    wanted = """a.start_us < b.end_us AND b.start_us < a.end_us AND
        (a.rank < b.rank OR a.hour != b.hour OR a.end_us - a.start_us != b.end_us - b.start_us)"""
    pairs = spread_join(left, right, cell_keys, F.expr(wanted), sizes, tasks=tasks)
    pairs = pairs.select(
        *keys,
        F.expr("IF(a.rank < b.rank, a, b) AS e1"),
        F.expr("IF(a.rank < b.rank, b, a) AS e2"),
    )
    return pairs.select(*keys, *[F.col(f"e{n}.{c}").alias(f"{c}_{n}") for n in (1, 2) for c in fields])

"""Purge of past and repeated events together with the rows that depend on them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.integrity import cleanup_events, without_orphans

CHILDREN = ["event_categories", "enhanced_content", "event_tags", "event_recommendations"]


def purge(tables: dict[str, DataFrame], as_of: str) -> dict[str, DataFrame]:
    """The tables after the purge; dependent rows go with their event."""
    events = cleanup_events(tables["events"], as_of)
    cleaned = {name: without_orphans(tables[name], events) for name in CHILDREN if name in tables}
    return {**tables, "events": events, **cleaned}

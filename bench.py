"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from eventloom.catalog.queries import QUERIES
from eventloom.session import local_session

HEADLINE = [
    "upcoming",
    "list_upcoming",
    "top_locations",
    "weekday_dist",
    "by_building",
    "building_util",
    "type_dist",
    "seo_stats",
    "validate_events",
    "validation_stats",
    "dedup_cleanup",
    "dup_link",
    "dup_title_date",
    "dup_verdict",
    "venue_conflicts",
    "building_conflicts",
    "recurring_conflicts",
    "conflict_summary",
    "conflict_groups",
    "free_slots",
    "recommendations",
    "tags",
    "enhance_all",
    "doc_keywords",
    "page_rows",
    "upsert_events",
    "export_enhanced",
    "ical_vevents",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "eventloom-bench")
    QUERIES["totals"](spark, sf_dir).collect()  # starts the session and reads the footers
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()

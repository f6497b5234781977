"""Schemas of the event tables (list columns are real arrays; they are joined to text only on export)."""

from __future__ import annotations

EVENTS = (
    "id BIGINT, title STRING, description STRING, date STRING, time STRING, location STRING, "
    "link STRING, created_at TIMESTAMP, last_updated TIMESTAMP"
)
RAW_EVENTS = "title STRING, description STRING, date STRING, time STRING, location STRING, link STRING"
CATEGORIES = "id BIGINT, name STRING, description STRING"
EVENT_CATEGORIES = "event_id BIGINT, category_id BIGINT"
ENHANCED_CONTENT = (
    "event_id BIGINT, enhanced_description STRING, structured_time STRING, structured_location STRING, "
    "event_type STRING, seo_score INT, missing_details ARRAY<STRING>"
)
EVENT_TAGS = "event_id BIGINT, tag STRING"
EVENT_RECOMMENDATIONS = (
    "event_id BIGINT, has_conflicts BOOLEAN, conflict_type STRING, severity STRING, "
    "recommended_action STRING, alternative_times ARRAY<STRING>, details STRING, generated_at TIMESTAMP"
)
SCRAPING_HISTORY = (
    "id BIGINT, start_time TIMESTAMP, end_time TIMESTAMP, events_scraped BIGINT, status STRING, "
    "error_message STRING"
)
LISTING_PAGES = "page_id BIGINT, url STRING, html STRING"

TABLES = {
    "events": EVENTS,
    "categories": CATEGORIES,
    "event_categories": EVENT_CATEGORIES,
    "scraping_history": SCRAPING_HISTORY,
    "event_recommendations": EVENT_RECOMMENDATIONS,
    "enhanced_content": ENHANCED_CONTENT,
    "event_tags": EVENT_TAGS,
}
REQUIRED_TABLES = ["events", "enhanced_content", "event_tags"]

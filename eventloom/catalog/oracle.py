"""The SQL each query is checked against, for DuckDB over the same tables."""

from __future__ import annotations

from .. import vocab
from ..functions.text import unicode_pattern
from ..operators.keywords import WORD
from ..sources.campus import KIND_TITLES
from ..sources.pages import ENTITIES, LIST_ITEMS
from .views import AS_OF, DIRTY, HISTORY_BEFORE, RELISTED


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_KINDS = " ".join(f"WHEN {text(kind)} THEN {text(title)}" for kind, title in KIND_TITLES.items())

# Views by name; a query lists the ones it needs, in order.
VIEWS = {
    "ce": f"""SELECT e.event_id AS id,
  CASE WHEN e.event_id % 97 = 0 THEN 'Gala'
    WHEN e.event_id % 101 = 0 THEN repeat(CASE e.event_type {_KINDS} ELSE 'Basketball Game' END || ' and ', 6) || 'more'
    ELSE CASE e.event_type {_KINDS} ELSE 'Basketball Game' END
      || CASE WHEN e.event_id % 3 = 0 THEN '' ELSE ' ' || split_part(d.text, ' ', CAST(e.event_id % 5 + 1 AS INT))
        || ' ' || split_part(d.text, ' ', CAST(e.event_id % 7 + 2 AS INT)) END END AS title,
  CASE WHEN e.event_id % 6 = 0 THEN NULL
    ELSE 'Join us on January ' || CAST(day(e.ts) AS STRING) || ' at ' || CAST(1 + e.event_id % 11 AS STRING)
      || ':30 PM in Room ' || CAST(e.user_id AS STRING)
      || CASE WHEN e.event_id % 4 = 0 THEN ' free, rsvp or email us. ' ELSE '. ' END
      || d.text END AS description,
  CAST(CAST(e.ts AS DATE) AS STRING) AS date,
  CASE WHEN e.event_id % 10 = 0 THEN NULL
    ELSE lpad(CAST(hour(e.ts) AS STRING), 2, '0') || ':' || lpad(CAST(minute(e.ts) AS STRING), 2, '0') END AS time,
  CASE e.event_id % 8 WHEN 0 THEN NULL
    WHEN 1 THEN 'Student Center Room ' || CAST(e.user_id % 9 AS STRING)
    WHEN 2 THEN 'Building ' || CAST(10 + e.user_id % 30 AS STRING) || ', Room 1'
    WHEN 3 THEN 'Virtual'
    ELSE 'Bldg ' || CAST(e.user_id % 40 AS STRING) || ', Room ' || CAST(e.user_id % 7 AS STRING) END AS location,
  'https://campus.example.edu/event/'
    || CAST(CASE WHEN e.event_id % 50 = 0 THEN e.event_id + 1 ELSE e.event_id END AS STRING) AS link
FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)""",
    "up": f"SELECT * FROM ce WHERE date >= '{AS_OF}'",
    "stored": f"SELECT * FROM ce WHERE date <= '{HISTORY_BEFORE}'",
    "dirty": DIRTY.format(ce="ce"),
    "relisted": RELISTED.format(ce="ce"),
}

# --- content features ----------------------------------------------------------------------------------------------


def _any(words: list[str], column: str = "txt") -> str:
    return "(" + " OR ".join(f"contains({column}, {text(w)})" for w in words) + ")"


_TYPES = ", ".join(
    f"CASE WHEN {_any(words)} THEN {text(group.replace('_', ' ').title())} END"
    for group, words in vocab.EVENT_KEYWORDS.items()
)
_TAGS = []
for _group, _words in vocab.EVENT_KEYWORDS.items():
    _TAGS.append(f"CASE WHEN {_any(_words)} THEN {text(_group)} END")
    _TAGS += [f"CASE WHEN contains(txt, {text(w)}) THEN {text(w)} END" for w in _words]
_TAGS += [f"CASE WHEN contains(txt, {text(w)}) THEN {text(w)} END" for w in vocab.LOCATION_KEYWORDS + vocab.WEEKDAYS]
_TAGS += [f"CASE WHEN {_any(words)} THEN {text(part)} END" for part, words in vocab.DAYPART_WORDS.items()]
_SPACE = f"'[{vocab.WHITESPACE}]+'"
_TIMES = " || ".join(f"regexp_extract_all(dsc, {text(unicode_pattern(p))})" for p in vocab.TIME_PATTERNS)
_PLACES = text(unicode_pattern("(?i)(?:" + "|".join(vocab.LOCATION_KEYWORDS) + ")" + vocab.LOCATION_TAIL))
_DETAILS = ", ".join(
    f"CASE WHEN NOT regexp_matches(lower(dsc), {text(p)}) THEN {text(s)} END" for p, s in vocab.DETAIL_CHECKS
)
_TITLE_LENGTH = (
    f"CASE WHEN length(title) < 5 THEN {text(vocab.TITLE_SHORT)} WHEN length(title) > 70 THEN {text(vocab.TITLE_LONG)} END"
)
_NO_DIGIT = r"NOT regexp_matches(title, '\p{Nd}')"


def _compact(items: str) -> str:
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


VIEWS["f1"] = f"""SELECT id, title, coalesce(description, '') AS dsc,
  lower(title || ' ' || coalesce(description, '')) AS txt FROM ce"""
VIEWS["f2"] = f"""SELECT *, array_to_string({_TIMES}, ', ') AS structured_time,
  array_to_string(regexp_extract_all(dsc, {_PLACES}), ', ') AS structured_location,
  coalesce(nullif(concat_ws(', ', {_TYPES}), ''), {text(vocab.DEFAULT_EVENT_TYPE)}) AS event_type FROM f1"""
VIEWS["f3"] = f"""SELECT *,
  {_compact(f"{_TITLE_LENGTH}, CASE WHEN {_NO_DIGIT} THEN {text(vocab.TITLE_NO_DATE)} END")} AS title_list,
  {_compact(f"CASE WHEN length(dsc) < 100 THEN {text(vocab.DESCRIPTION_SHORT)} END, "
            f"CASE WHEN structured_time = '' THEN {text(vocab.DESCRIPTION_NO_TIME)} END, "
            f"CASE WHEN structured_location = '' THEN {text(vocab.DESCRIPTION_NO_PLACE)} END, {_DETAILS}")} AS description_list
  FROM f2"""
VIEWS["ec"] = f"""SELECT id AS event_id, trim(dsc, {text(vocab.WHITESPACE)}) || chr(10) || {text(vocab.DETAILS_HEADING)}
    || CASE WHEN structured_time != '' THEN chr(10) || 'When: ' || structured_time ELSE '' END
    || CASE WHEN structured_location != '' THEN chr(10) || 'Where: ' || structured_location ELSE '' END
    || chr(10) || 'Event Type: ' || event_type || chr(10) || {text(vocab.FOOTER)} AS enhanced_description,
  structured_time, structured_location, event_type,
  CAST(least(100, greatest(0, 100
    - CASE WHEN title = '' THEN 30 WHEN length(title) < 5 THEN 20 WHEN length(title) > 70 THEN 10 ELSE 0 END
    - CASE WHEN dsc = '' THEN 30 WHEN length(dsc) < 100 THEN 15 ELSE 0 END
    - 5 * (len(title_list) + len(description_list)))) AS BIGINT) AS seo_score,
  array_to_string(description_list, ', ') AS missing_details FROM f3"""
VIEWS["et"] = f"SELECT id AS event_id, unnest(list_slice(list_sort(list_distinct([{', '.join(_TAGS)}])), 1, 10)) AS tag FROM f1"
VIEWS["tagged"] = "SELECT event_id, string_agg(tag, ', ' ORDER BY tag) AS tags FROM et GROUP BY event_id"
CONTENT = ["ce", "f1", "f2", "f3", "ec"]
TAGGED = ["ce", "f1", "et"]

# --- intervals, conflicts, slots ------------------------------------------------------------------------------------

VIEWS["iv"] = """SELECT *, s + CASE WHEN all_day THEN INTERVAL '86399.999999 seconds' ELSE INTERVAL 1 HOUR END AS e FROM (
  SELECT *, time IS NULL AS all_day, CAST(date || ' ' || coalesce(time, '00:00') || ':00' AS TIMESTAMP) AS s FROM up)"""
VIEWS["placed"] = "SELECT *, lower(trim(location)) AS venue FROM iv WHERE location IS NOT NULL"
_BEFORE = "(a.{0}, a.time IS NOT NULL, coalesce(a.time, ''), a.id) < (b.{0}, b.time IS NOT NULL, coalesce(b.time, ''), b.id)"
VIEWS["vp"] = f"""SELECT a.location AS location, a.id AS id_1, a.title AS title_1, a.date AS date_1, a.time AS time_1,
    b.id AS id_2, b.title AS title_2, b.date AS date_2, b.time AS time_2, a.s AS s_1, b.s AS s_2
  FROM placed a JOIN placed b ON a.venue = b.venue AND {_BEFORE.format("location, a.date").replace("b.location, a.date", "b.location, b.date")}
    AND a.s < b.e AND b.s < a.e"""
VIEWS["bp"] = f"""SELECT a.building, a.date, a.id AS id_1, a.title AS title_1, a.time AS time_1, a.location AS location_1,
    b.id AS id_2, b.title AS title_2, b.time AS time_2, b.location AS location_2
  FROM (SELECT *, trim(split_part(location, ',', 1)) AS building FROM placed WHERE location ILIKE 'Bldg%') a
  JOIN (SELECT *, trim(split_part(location, ',', 1)) AS building FROM placed WHERE location ILIKE 'Bldg%') b
    ON a.building = b.building AND a.date = b.date
    AND (a.time IS NOT NULL, coalesce(a.time, ''), a.id) < (b.time IS NOT NULL, coalesce(b.time, ''), b.id)
    AND a.s < b.e AND b.s < a.e"""
VIEWS["rp"] = """SELECT title, id_1, date_1, time_1, location_1, id_2, date_2, time_2, location_2, gap FROM (
  SELECT title, id AS id_1, date AS date_1, time AS time_1, location AS location_1,
    lead(id) OVER w AS id_2, lead(date) OVER w AS date_2, lead(time) OVER w AS time_2, lead(location) OVER w AS location_2,
    epoch_us(lead(s) OVER w) - epoch_us(e) AS gap
  FROM iv WINDOW w AS (PARTITION BY title ORDER BY date, time NULLS FIRST, id))
  WHERE gap > 0 AND gap < 1800000000"""
VIEWS["slot"] = """SELECT CAST(h AS BIGINT) AS h,
  lpad(CAST(h AS STRING), 2, '0') || ':00 - ' || lpad(CAST(h + 1 AS STRING), 2, '0') || ':00' AS slot FROM range(8, 19) t(h)"""
VIEWS["asked"] = "SELECT DISTINCT lower(location) AS venue, date FROM placed"
VIEWS["vb"] = """SELECT k.venue, k.date, p.id, p.s, p.e FROM asked k
  JOIN placed p ON p.date = k.date AND contains(lower(p.location), k.venue)"""
_SLOT_HIT = "{b}.s < CAST({k}.date AS TIMESTAMP) + to_hours(h + 1) AND CAST({k}.date AS TIMESTAMP) + to_hours(h) < {b}.e"
VIEWS["vfree"] = f"""SELECT k.venue, k.date, h, slot FROM asked k CROSS JOIN slot WHERE NOT EXISTS (
  SELECT 1 FROM vb WHERE vb.venue = k.venue AND vb.date = k.date AND {_SLOT_HIT.format(b="vb", k="k")})"""
VIEWS["vtop"] = """SELECT venue, date, string_agg(slot, ' | ' ORDER BY h) FILTER (n <= 3) AS slots, min(slot) AS first_slot
  FROM (SELECT *, row_number() OVER (PARTITION BY venue, date ORDER BY h) AS n FROM vfree) GROUP BY venue, date"""
VIEWS["vc"] = """SELECT 'venue_conflict' AS type, location, id_1, title_1, date_1, time_1, id_2, title_2, date_2, time_2,
    coalesce(slots, '') AS alternative_slots,
    'Recommend moving ''' || CASE WHEN s_2 > s_1 THEN title_2 ELSE title_1 END || ''' to ' || first_slot AS recommendation
  FROM vp LEFT JOIN vtop ON vtop.venue = lower(location) AND vtop.date = date_1"""
VIEWS["rc"] = """SELECT 'recurring_timing_conflict' AS type,
    'Events only ' || CAST(gap // 60000000 AS STRING) || ' minutes apart' AS warning,
    title, id_1, date_1, time_1, location_1, id_2, date_2, time_2, location_2 FROM rp"""
PAIRS = ["ce", "up", "iv", "placed", "vp", "bp", "rp"]
VENUES = ["ce", "up", "iv", "placed", "vp", "slot", "asked", "vb", "vfree", "vtop", "vc"]

# --- recommendations: every event compared with all bookings of its place or building --------------------------------

VIEWS["flag"] = """SELECT *, id IN (SELECT id_1 FROM vp UNION SELECT id_2 FROM vp) AS at_venue,
    id IN (SELECT id_1 FROM bp UNION SELECT id_2 FROM bp) AS in_building,
    trim(CASE WHEN contains(location, ',') THEN split_part(location, ',', 1) ELSE split_part(location, '-', 1) END) AS building
  FROM iv"""
VIEWS["other"] = """SELECT f.id, p.s, p.e FROM flag f JOIN placed p ON p.date = f.date AND p.id != f.id
    AND contains(lower(p.location), lower(f.location)) WHERE f.at_venue
  UNION ALL SELECT f.id, p.s, p.e FROM flag f JOIN placed p ON p.date = f.date AND p.id != f.id AND NOT p.all_day
    AND (starts_with(lower(p.location), lower(f.building) || ',') OR starts_with(lower(p.location), lower(f.building) || ' '))
    WHERE NOT f.at_venue AND f.in_building"""
VIEWS["busy"] = f"""SELECT DISTINCT o.id, h FROM other o JOIN flag f ON f.id = o.id
  CROSS JOIN slot WHERE {_SLOT_HIT.format(b="o", k="f")}"""
VIEWS["open"] = """SELECT id, min(slot) AS best, string_agg(slot, ', ' ORDER BY h) FILTER (n <= 3) AS top FROM (
    SELECT f.id, h, slot, row_number() OVER (PARTITION BY f.id ORDER BY h) AS n
    FROM flag f CROSS JOIN slot WHERE (f.at_venue OR f.in_building)
      AND NOT EXISTS (SELECT 1 FROM busy WHERE busy.id = f.id AND busy.h = slot.h)) GROUP BY id"""
VIEWS["advice"] = """SELECT f.*, best, top, f.id IN (SELECT id FROM other) AS crowded,
    NOT at_venue AND NOT in_building AND time IS NOT NULL AND CAST(split_part(time, ':', 1) AS INT) BETWEEN 10 AND 13 AS peak
  FROM flag f LEFT JOIN open o ON o.id = f.id"""
VIEWS["rec"] = f"""SELECT id AS event_id, at_venue OR in_building AS has_conflicts,
  CASE WHEN at_venue THEN 'venue_double_booking' WHEN in_building THEN 'building_conflict' END AS conflict_type,
  CASE WHEN at_venue THEN 'high' WHEN in_building THEN 'medium' WHEN peak THEN 'low' ELSE 'none' END AS severity,
  CASE WHEN at_venue THEN coalesce('Move to ' || best, {text(vocab.NO_VENUE_ACTION)})
    WHEN in_building THEN CASE WHEN crowded THEN 'Consider moving to ' || best END
    WHEN peak THEN {text(vocab.PEAK_ACTION)} END AS recommended_action,
  CASE WHEN at_venue OR (in_building AND crowded) THEN coalesce(top, '') ELSE '' END AS alternative_times,
  CASE WHEN at_venue THEN 'Venue ''' || location || ''' is double-booked'
      || coalesce('. Recommend rescheduling to ' || best || '.', ' with no available slots on this date.')
    WHEN in_building THEN CASE WHEN crowded AND best IS NOT NULL
      THEN 'Multiple events scheduled in ' || building || '. Consider spacing out events.' END
    WHEN peak THEN {text(vocab.PEAK_DETAILS)} END AS details
  FROM advice"""
RECS = ["ce", "up", "iv", "placed", "vp", "bp", "slot", "flag", "other", "busy", "open", "advice", "rec"]

# --- duplicates ----------------------------------------------------------------------------------------------------

# DuckDB's levenshtein counts bytes; the accented letters of the test texts are mapped to single bytes first.
_ACCENTED = "äçèéêíñóöúüß"


def _bytes(column: str) -> str:
    single = " || ".join(f"chr({14 + i})" for i in range(len(_ACCENTED)))
    return f"translate(lower({column}), {text(_ACCENTED)}, {single})"


_RATIO = "1 - levenshtein({a}, {b}) / CAST(greatest(length({a}), length({b})) AS DOUBLE)"
VIEWS["old_t"] = f"SELECT date, {_bytes('title')} AS t, min(id) AS id FROM ce GROUP BY ALL"
VIEWS["new_t"] = f"SELECT DISTINCT date, {_bytes('title')} AS t FROM relisted"
VIEWS["best"] = f"""SELECT date, t, min(id) AS id, arg_min(ratio, id) AS ratio FROM (
  SELECT n.date, n.t, o.id, CASE WHEN n.t = o.t THEN 1.0 ELSE {_RATIO.format(a="n.t", b="o.t")} END AS ratio
  FROM new_t n JOIN old_t o ON n.date = o.date) WHERE ratio > {vocab.SIMILARITY_THRESHOLD} GROUP BY date, t"""
VIEWS["fuzzy"] = f"""SELECT r.id, b.id AS existing_id,
  'High similarity match (' || CAST(CAST(round_even(ratio * 100, 0) AS INT) AS STRING) || '%)' AS reason
  FROM relisted r JOIN best b ON b.date = r.date AND b.t = {_bytes('r.title')}"""
VIEWS["by_link"] = "SELECT r.id, min(c.id) AS existing_id FROM relisted r JOIN ce c ON c.link = r.link GROUP BY r.id"
VIEWS["by_title"] = """SELECT r.id, min(c.id) AS existing_id FROM relisted r JOIN ce c
  ON c.title = r.title AND c.date = r.date GROUP BY r.id"""
FUZZY = ["ce", "relisted", "old_t", "new_t", "best", "fuzzy"]

# --- validation ----------------------------------------------------------------------------------------------------

_WS = text(vocab.WHITESPACE)


def _squeeze(column: str) -> str:
    return f"regexp_replace({column}, {_SPACE}, ' ', 'g')"


_URL = text("(?i)" + unicode_pattern(vocab.URL_PATTERN))
_TWELVE = text(unicode_pattern(r"(?i)^(1[0-2]|0?[1-9])(?::([0-5]?[0-9])\s*|\s+)([ap])m$"))
VIEWS["v1"] = f"""SELECT id, title, date, time, location, link, description, trim(title, {_WS}) AS tt, trim(date, {_WS}) AS td,
  trim(time, {_WS}) AS tm, {_squeeze(f"trim(location, {_WS})")} AS tl, trim(link, {_WS}) AS tk,
  {_squeeze(f"trim(description, {_WS})")} AS tx FROM dirty"""
VIEWS["v2"] = f"""SELECT *,
  CASE WHEN regexp_matches(td, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$') THEN try_cast(td AS DATE) END AS d0,
  CASE WHEN regexp_matches(td, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN try_strptime(td, '%m/%d/%Y') END AS d1,
  CASE WHEN regexp_matches(td, '^\\d{{1,2}}-\\d{{1,2}}-\\d{{4}}$') THEN try_strptime(td, '%d-%m-%Y') END AS d2,
  CASE WHEN regexp_matches(td, '^\\d{{4}}/\\d{{1,2}}/\\d{{1,2}}$') THEN try_strptime(td, '%Y/%m/%d') END AS d3,
  CASE WHEN regexp_matches(tm, '^([01]?[0-9]|2[0-3]):[0-5]?[0-9]$')
    THEN CAST(split_part(tm, ':', 1) AS INT) * 60 + CAST(split_part(tm, ':', 2) AS INT) END AS m0,
  CASE WHEN regexp_matches(tm, {_TWELVE}) THEN
    (CAST(regexp_extract(tm, {_TWELVE}, 1) AS INT) % 12
      + CASE WHEN lower(regexp_extract(tm, {_TWELVE}, 3)) = 'p' THEN 12 ELSE 0 END) * 60
    + coalesce(try_cast(nullif(regexp_extract(tm, {_TWELVE}, 2), '') AS INT), 0) END AS m1 FROM v1"""


def _long(column: str, limit: int, field: str) -> str:
    return f"CASE WHEN length({column}) > {limit} THEN '{field} exceeds {limit} characters, truncating' END"


_FIELDS = {
    "title": (
        f"CASE WHEN length(tt) >= 3 THEN {_squeeze('substr(tt, 1, 200)')} END",
        "CASE WHEN title IS NULL OR title = '' THEN 'Title is required' "
        "WHEN length(tt) < 3 THEN 'Title too short: ''' || tt || '''' END",
        _long("tt", 200, "Title"),
    ),
    "date": (
        "strftime(coalesce(d0, d1, d2, d3), '%Y-%m-%d')",
        "CASE WHEN date IS NULL OR date = '' THEN 'Date is required' "
        "WHEN coalesce(d0, d1, d2, d3) IS NULL THEN 'Invalid date format: ''' || date || '''' END",
        "CASE WHEN d0 IS NOT NULL THEN NULL WHEN d1 IS NOT NULL THEN 'Date converted from %m/%d/%Y to YYYY-MM-DD' "
        "WHEN d2 IS NOT NULL THEN 'Date converted from %d-%m-%Y to YYYY-MM-DD' "
        "WHEN d3 IS NOT NULL THEN 'Date converted from %Y/%m/%d to YYYY-MM-DD' END",
    ),
    "link": (
        f"CASE WHEN regexp_matches(tk, {_URL}) THEN tk END",
        "CASE WHEN link IS NULL OR link = '' THEN 'Link is required' "
        f"WHEN NOT regexp_matches(tk, {_URL}) THEN 'Invalid URL format: ''' || tk || '''' END",
        "CAST(NULL AS STRING)",
    ),
    "time": (
        "lpad(CAST(coalesce(m0, m1) // 60 AS STRING), 2, '0') || ':' || lpad(CAST(coalesce(m0, m1) % 60 AS STRING), 2, '0')",
        "CAST(NULL AS STRING)",
        "CASE WHEN time IS NULL OR time = '' OR m0 IS NOT NULL THEN NULL "
        "WHEN m1 IS NOT NULL THEN 'Time converted from 12-hour to 24-hour format' "
        "ELSE 'Invalid time format: ''' || time || ''', skipping' END",
    ),
    "location": ("nullif(substr(tl, 1, 200), '')", "CAST(NULL AS STRING)", _long("tl", 200, "Location")),
    "description": ("nullif(substr(tx, 1, 5000), '')", "CAST(NULL AS STRING)", _long("tx", 5000, "Description")),
}
VIEWS["v3"] = "SELECT id, " + ", ".join(
    f"{value} AS {f}, {error} AS {f}_error, {warning} AS {f}_warning" for f, (value, error, warning) in _FIELDS.items()
) + " FROM v2"
_ERRORS = ", ".join(f"'ERROR: ' || {f}_error" for f in _FIELDS)
_WARNINGS = ", ".join(f"'WARNING: ' || {f}_warning" for f in _FIELDS)
VIEWS["v4"] = f"""SELECT *, {_compact(_ERRORS)} AS errors, {_compact(_WARNINGS)} AS warnings FROM v3"""
VALID = ["ce", "dirty", "v1", "v2", "v3", "v4"]

# --- building labels -----------------------------------------------------------------------------------------------

VIEWS["bl"] = """SELECT building, count(*) AS count FROM (
  SELECT CASE WHEN contains(lower(location), 'bldg')
      THEN split_part(substr(location, strpos(lower(location), 'bldg')), ',', 1)
    WHEN contains(lower(location), 'building') THEN 'Bldg ' || substr(location, strpos(lower(location), 'building') + 9, 2)
    ELSE location END AS building
  FROM ce WHERE location ILIKE '%bldg%' OR location ILIKE '%building%'
    OR (location NOT LIKE '%.%' AND location NOT LIKE '%/%' AND location NOT LIKE '%(%' AND location NOT LIKE '%)%'))
  GROUP BY building"""
_DAYS = "['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday']"
_KEEP = "title, date, coalesce(time, '')"

SQL: dict[str, str] = {}


def check(name: str, views: list[str], body: str) -> None:
    SQL[name] = ("WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in views) + "\n" if views else "") + body


_ITEM_TEXT = "regexp_replace(regexp_extract(block, {0}, 1), '(?s)<[^>]*>', '', 'g')".format(text(LIST_ITEMS["title"]))
for _reference, _char in ENTITIES:
    _ITEM_TEXT = f"replace({_ITEM_TEXT}, {text(_reference)}, {text(_char)})"
_HREF = text(LIST_ITEMS["link"])
check(
    "page_rows",
    [],
    f"""WITH rows AS (SELECT page_id, unnest(regexp_extract_all(html, {text(LIST_ITEMS["row"])}, 1)) AS block,
    generate_subscripts(regexp_extract_all(html, {text(LIST_ITEMS["row"])}, 1), 1) - 1 AS row_no FROM pages)
  SELECT page_id, row_no, trim({_ITEM_TEXT}, {_WS}) AS title,
    CASE WHEN regexp_matches(block, {_HREF}) THEN
      CASE WHEN starts_with(regexp_extract(block, {_HREF}, 1), '/') THEN 'https://campus.example.edu' ELSE '' END
      || regexp_extract(block, {_HREF}, 1) END AS link
  FROM rows WHERE regexp_matches(block, {text(LIST_ITEMS["title"])})""",
)
SQL["listing_blocks"] = """SELECT page_id, CAST(0 AS BIGINT) AS row_no, 'Event & ' || page_id AS title,
    'From ' || url || 'one two end' AS description, CASE WHEN page_id % 3 > 0 THEN '2025-03-0' || (1 + page_id % 9) END AS date,
    CASE WHEN page_id % 3 > 0 THEN '14:30' END AS time, 'Hall ' || (page_id % 7) AS location,
    nullif(regexp_extract(url, '^https?://[^/?#]+'), '') || '/event/' || page_id AS link FROM pages WHERE url IS NOT NULL
  UNION ALL SELECT page_id, 2, 'Second', NULL, NULL, NULL, NULL, 'https://other.example.edu/' || page_id FROM pages
    WHERE url IS NOT NULL AND page_id % 5 > 0"""
check("iso_split", ["ce"], "SELECT id, date AS iso_date, time AS iso_time FROM ce")
check("future_rows", ["ce"], f"SELECT id, title, date FROM ce WHERE CAST(date AS DATE) >= DATE '{AS_OF}'")
check(
    "insert_if_absent",
    ["ce", "stored", "relisted"],
    """SELECT id, title, link FROM stored UNION ALL
  SELECT id, title, link FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY id) AS n FROM relisted)
  WHERE link IS NULL OR (n = 1 AND link NOT IN (SELECT link FROM stored))""",
)
check("upcoming", ["ce", "up"], "SELECT id, title, date, time FROM up")
check("past_events", ["ce"], f"SELECT title, date, time FROM ce WHERE date < '{AS_OF}'")
check("past_count", ["ce"], f"SELECT count(*) AS past_events FROM ce WHERE date < '{AS_OF}'")
check("list_range", ["ce"], "SELECT id, date, time, location FROM ce WHERE date BETWEEN '2024-01-05' AND '2024-01-20'")
check("export_range", ["ce", "up"], "SELECT id, date, time, location FROM up WHERE date BETWEEN '2024-01-05' AND '2024-01-20'")
check("filter_location", ["ce"], "SELECT id, location, date FROM ce WHERE location ILIKE '%center room%'")
check("filter_type", CONTENT, "SELECT event_id, event_type FROM ec WHERE event_type ILIKE '%career%'")
check("event_by_id", ["ce", "up"], "SELECT id, title, description, date FROM ce WHERE id = (SELECT min(id) FROM up)")
check("ids_in", ["ce"], "SELECT id, title, date FROM ce WHERE id IN (3, 14, 159, 265, 358, 979)")
check("enhance_queue", ["ce"], f"SELECT id, title, description FROM ce WHERE date >= '{HISTORY_BEFORE}'")
check(
    "list_upcoming",
    [*CONTENT, "up"],
    """SELECT id, title, date, substr(event_type, 1, 15) AS event_type, seo_score
  FROM up JOIN ec ON event_id = id ORDER BY date, id LIMIT 10""",
)
check(
    "list_all_filtered",
    CONTENT,
    """SELECT id, title, date, substr(event_type, 1, 15) AS event_type, seo_score FROM ce JOIN ec ON event_id = id
  WHERE date BETWEEN '2024-01-10' AND '2024-01-25' AND event_type ILIKE '%Arts%' AND location ILIKE '%bldg%'""",
)
check(
    "view_next",
    ["ce", "up"],
    """SELECT title, date, time, location, CASE WHEN length(description) > 200 THEN substr(description, 1, 197) || '...'
  ELSE description END AS description, link FROM up ORDER BY date, time NULLS FIRST, id LIMIT 10""",
)
check(
    "event_detail",
    [*CONTENT, "et"],
    """SELECT ce.id, ce.title, ce.description, ce.date, ce.time, ce.location, enhanced_description, structured_time,
    structured_location, event_type, seo_score, missing_details, t.tags
  FROM ce LEFT JOIN ec ON ec.event_id = ce.id
  LEFT JOIN (SELECT event_id, string_agg(tag, ',' ORDER BY tag) AS tags FROM et GROUP BY event_id) t ON t.event_id = ce.id""",
)
check(
    "top_locations",
    ["ce"],
    "SELECT location, count(*) AS count FROM ce WHERE location IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
)
check("weekday_dist", ["ce"], f"SELECT ({_DAYS})[dayofweek(CAST(date AS DATE)) + 1] AS day_of_week, count(*) AS count FROM ce GROUP BY 1")
check("month_dist", ["ce"], "SELECT monthname(CAST(date AS DATE)) AS month, count(*) AS count FROM ce WHERE date LIKE '2024%' GROUP BY 1")
_TIMED = "CASE WHEN time IS NULL THEN 'No specific time' ELSE 'Has specific time' END"
check("time_spec", ["ce"], f"SELECT {_TIMED} AS time_status, count(*) AS count FROM ce GROUP BY 1")
check(
    "time_spec_share",
    ["ce"],
    f"""SELECT {_TIMED} AS time_status, count(*) AS count,
  CAST(round_even(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100, 1) AS DOUBLE) AS percentage FROM ce GROUP BY 1""",
)
check("by_building", ["ce", "bl"], "SELECT building, count FROM bl")
check(
    "location_class",
    ["ce"],
    """SELECT CASE WHEN location ILIKE '%center%' THEN 'Various Centers'
    WHEN location ILIKE '%room%' OR location ILIKE '%rm%' THEN 'Various Rooms'
    WHEN location = 'Virtual' THEN 'Virtual Events' WHEN location = 'Online' THEN 'Online Events'
    ELSE location END AS location_type, count(*) AS count
  FROM ce WHERE location != '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
)
check("type_dist", CONTENT, "SELECT event_type, count(*) AS count FROM ec GROUP BY 1")
check(
    "seo_stats",
    CONTENT,
    """SELECT round(avg(seo_score), 6) AS avg_score, min(seo_score) AS min_score, max(seo_score) AS max_score FROM ec""",
)
check("totals", ["ce"], f"SELECT count(*) AS total_events, count(*) FILTER (date >= '{AS_OF}') AS upcoming_events FROM ce")
check(
    "building_util",
    ["ce", "bl"],
    """SELECT building, count, CASE WHEN count >= m * 0.8 THEN 'Morning, Afternoon' WHEN count >= m * 0.7 THEN 'Morning'
    ELSE 'Variable' END AS peak_times, CAST(round_even(count / m * 100, 1) AS DOUBLE) AS utilization
  FROM bl CROSS JOIN (SELECT CAST(max(count) AS DOUBLE) AS m FROM bl)""",
)
check(
    "frequent_types",
    CONTENT,
    """SELECT event_type || ' events occur most frequently (' || CAST(n AS STRING) || ' events)' AS pattern FROM (
    SELECT event_type, count(*) AS n FROM ec GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3) WHERE n > 1""",
)
check(
    "insights",
    [*CONTENT, "bl"],
    """SELECT CAST(1 AS BIGINT) AS line, building || ' is the most utilized building with ' || CAST(count AS STRING) || ' events' AS insight
    FROM (SELECT * FROM bl ORDER BY count DESC, building LIMIT 1)
  UNION ALL SELECT 2, 'Most common event type is ' || event_type || ' with ' || CAST(n AS STRING) || ' events'
    FROM (SELECT event_type, count(*) AS n FROM ec GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1)
  UNION ALL SELECT 3, printf('Average SEO score is %.1f, ranging from %.1f to %.1f', avg(seo_score),
    CAST(min(seo_score) AS DOUBLE), CAST(max(seo_score) AS DOUBLE)) FROM ec""",
)
check("export_by_type", [*CONTENT, "up"], "SELECT event_type, count(*) AS count FROM up JOIN ec ON event_id = id GROUP BY 1")
check("export_by_month", ["ce", "up"], "SELECT substr(date, 1, 7) AS month, count(*) AS count FROM up GROUP BY 1")
check("dup_groups", ["ce"], "SELECT title, date, count(*) AS count FROM ce GROUP BY 1, 2 HAVING count(*) > 1")
check("recurring_titles", ["ce", "up"], "SELECT title, count(*) AS count FROM up GROUP BY 1 HAVING count(*) > 1")

for _f in _FIELDS:
    check(f"v_{_f}", VALID[:-1], f"SELECT id, {_f} AS value, {_f}_error AS error, {_f}_warning AS warning FROM v3")
check(
    "validate_events",
    VALID,
    """SELECT id, len(errors) = 0 AS is_valid, array_to_string(errors || warnings, ' | ') AS messages,
  title, date, time, location, link FROM v4""",
)
check(
    "validation_stats",
    VALID,
    """SELECT count(*) AS total, count(*) FILTER (len(errors) = 0) AS valid, count(*) FILTER (len(errors) > 0) AS invalid,
  CAST(sum(len(warnings)) AS BIGINT) AS warnings,
  CAST(sum(CASE WHEN len(errors) > 0 THEN len(errors) + len(warnings) END) AS BIGINT) AS errors FROM v4""",
)

check("dup_link", ["ce", "relisted", "by_link"], "SELECT id, existing_id FROM by_link")
check("dup_title_date", ["ce", "relisted", "by_title"], "SELECT id, existing_id FROM by_title")
check("dup_fuzzy", FUZZY, "SELECT id, existing_id, reason FROM fuzzy")
check(
    "dup_verdict",
    [*FUZZY, "by_link", "by_title"],
    f"""SELECT r.id, coalesce(l.existing_id, t.existing_id, f.existing_id) IS NOT NULL AS is_duplicate,
    coalesce(l.existing_id, t.existing_id, f.existing_id) AS existing_id,
    CASE WHEN l.id IS NOT NULL THEN '{vocab.REASON_LINK}' WHEN t.id IS NOT NULL THEN '{vocab.REASON_TITLE_DATE}'
      ELSE coalesce(f.reason, '') END AS reason
  FROM relisted r LEFT JOIN by_link l ON l.id = r.id LEFT JOIN by_title t ON t.id = r.id LEFT JOIN fuzzy f ON f.id = r.id""",
)
check(
    "title_similarity",
    ["ce", "relisted"],
    f"""SELECT id, round(CASE WHEN a = b THEN 1.0 ELSE {_RATIO.format(a="a", b="b")} END, 9) AS similarity
  FROM (SELECT r.id, {_bytes('r.title')} AS a, {_bytes('c.title')} AS b FROM relisted r JOIN ce c ON c.id = r.id)""",
)
check(
    "dedup_cleanup",
    ["ce"],
    f"""SELECT id, title, date, time FROM (SELECT *, row_number() OVER (PARTITION BY {_KEEP} ORDER BY id) AS n FROM ce)
  WHERE n = 1""",
)
check(
    "dup_count",
    ["ce"],
    f"SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM ce GROUP BY {_KEEP})",
)

def _in_order(views: list[str], rows: str, body: str) -> str:
    """SQL over ``done``: the ids that a one-by-one ingest of ``rows`` (id, title, date, link) accepts, in order of the id.

    Rounds over the graph of duplicates: state 1 is accepted, 2 refused. Each round carries all rows.
    """
    similar = _RATIO.format(a="x.t", b="y.t")
    return f"""WITH RECURSIVE {", ".join(f"{v} AS ({VIEWS[v]})" for v in views)}, arriving AS MATERIALIZED ({rows}),
titles AS (SELECT DISTINCT date, {_bytes('title')} AS t FROM arriving WHERE title IS NOT NULL AND date IS NOT NULL),
near AS MATERIALIZED (SELECT x.date, x.t, y.t AS o FROM titles x JOIN titles y ON x.date = y.date
  AND (x.t = y.t OR {similar} > {vocab.SIMILARITY_THRESHOLD})),
edge AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM arriving a JOIN arriving b ON a.link = b.link AND a.id < b.id
  UNION SELECT a.id, b.id FROM arriving a JOIN arriving b ON a.date = b.date AND a.id < b.id
    JOIN near n ON n.date = a.date AND n.t = {_bytes('a.title')} AND n.o = {_bytes('b.title')}),
rounds AS (SELECT 0 AS r, id, 0 AS s FROM arriving
  UNION ALL SELECT now.r + 1, now.id, CASE WHEN now.s > 0 THEN now.s WHEN hit.refused THEN 2 WHEN hit.waits THEN 0 ELSE 1 END
  FROM rounds now LEFT JOIN (SELECT d.b, bool_or(o.s = 1) AS refused, bool_or(o.s = 0) AS waits
    FROM edge d JOIN rounds o ON o.id = d.a GROUP BY d.b) hit ON hit.b = now.id
  WHERE EXISTS (SELECT 1 FROM rounds WHERE s = 0)),
done AS (SELECT id FROM rounds WHERE s = 1 AND r = (SELECT max(r) FROM rounds))
{body}"""


SQL["ingest_dedup"] = _in_order(
    ["ce"], "SELECT id, title, date, link FROM ce", "SELECT id, title, date FROM ce WHERE id IN (SELECT id FROM done)"
)
_STORED_RATIO = _RATIO.format(a="n.t", b="o.t")
SQL["ingest_summary"] = _in_order(
    [*VALID, "stored"],
    f"""WITH good AS MATERIALIZED (SELECT id, title, date, link FROM v4 WHERE len(errors) = 0),
    n AS (SELECT DISTINCT date, {_bytes('title')} AS t FROM good), o AS (SELECT DISTINCT date, {_bytes('title')} AS t FROM stored),
    known AS (SELECT DISTINCT n.date, n.t FROM n JOIN o ON n.date = o.date AND (n.t = o.t OR {_STORED_RATIO} > {vocab.SIMILARITY_THRESHOLD}))
  SELECT * FROM good g WHERE link NOT IN (SELECT link FROM stored)
    AND NOT EXISTS (SELECT 1 FROM known k WHERE k.date = g.date AND k.t = {_bytes('g.title')})""",
    """SELECT count(*) AS total, count(*) FILTER (len(errors) = 0) AS valid, count(*) FILTER (len(errors) > 0) AS invalid,
  (SELECT count(*) FROM done) AS added, count(*) FILTER (len(errors) = 0) - (SELECT count(*) FROM done) AS skipped,
  CAST(0 AS BIGINT) AS updated FROM v4""",
)

_STAMP = "'%Y-%m-%d %H:%M:%S.%f'"
check(
    "intervals",
    ["ce"],
    f"""SELECT id, strftime(s, {_STAMP}) AS start_ts, strftime(s + CASE WHEN time IS NULL
    THEN INTERVAL '86399.999999 seconds' ELSE INTERVAL 1 HOUR END, {_STAMP}) AS end_ts
  FROM (SELECT *, CAST(date || ' ' || coalesce(time, '00:00') || ':00' AS TIMESTAMP) AS s FROM ce)""",
)
_GROUPS = f"""WITH RECURSIVE {", ".join(f"{v} AS ({VIEWS[v]})" for v in PAIRS)},
edge AS MATERIALIZED (SELECT 'venue' AS kind, id_1 AS a, id_2 AS b FROM vp UNION ALL SELECT 'venue', id_2, id_1 FROM vp
  UNION ALL SELECT 'building', id_1, id_2 FROM bp UNION ALL SELECT 'building', id_2, id_1 FROM bp),
reach AS (SELECT kind, a, b FROM edge UNION SELECT r.kind, r.a, e.b FROM reach r JOIN edge e ON e.kind = r.kind AND e.a = r.b),
label AS (SELECT kind, a AS id, min(least(a, b)) AS first_id FROM reach GROUP BY 1, 2),
degree AS (SELECT kind, a AS id, count(*) AS others FROM edge GROUP BY 1, 2),
member AS (SELECT l.kind, CASE l.kind WHEN 'venue' THEN p.venue ELSE trim(split_part(location, ',', 1)) END AS place,
    l.id, first_id, others, s, e FROM label l JOIN degree d ON d.kind = l.kind AND d.id = l.id JOIN placed p ON p.id = l.id)
"""
SQL["conflict_groups"] = _GROUPS + f"""SELECT kind, place, first_id, count(*) AS events, CAST(sum(others) // 2 AS BIGINT) AS pairs,
  strftime(min(s), {_STAMP}) AS started, strftime(max(e), {_STAMP}) AS ended FROM member GROUP BY 1, 2, 3"""
SQL["conflict_members"] = _GROUPS + f"""SELECT kind, place, id, others AS "overlaps",
  strftime(min(s) OVER (PARTITION BY kind, first_id), {_STAMP}) AS started FROM member"""
check("venue_conflicts", VENUES, "SELECT * FROM vc")
check("building_conflicts", PAIRS, "SELECT 'building_conflict' AS type, * FROM bp")
check("recurring_conflicts", ["ce", "up", "iv", "rp", "rc"], "SELECT * FROM rc")
check(
    "conflict_summary",
    PAIRS,
    """SELECT 'venue' AS kind, count(*) AS pairs FROM vp UNION ALL SELECT 'building', count(*) FROM bp
  UNION ALL SELECT 'recurring', count(*) FROM rp
  UNION ALL SELECT 'total', (SELECT count(*) FROM vp) + (SELECT count(*) FROM bp) + (SELECT count(*) FROM rp)""",
)
check(
    "event_conflicts",
    PAIRS,
    """SELECT id, CAST(sum(v) AS BIGINT) AS venue_overlaps, CAST(sum(b) AS BIGINT) AS building_overlaps FROM (
    SELECT id_1 AS id, 1 AS v, 0 AS b FROM vp UNION ALL SELECT id_2, 1, 0 FROM vp
    UNION ALL SELECT id_1, 0, 1 FROM bp UNION ALL SELECT id_2, 0, 1 FROM bp) GROUP BY id""",
)
check(
    "conflict_lines",
    [*VENUES, "bp", "rp", "rc"],
    """SELECT type, id_1, id_2, printf('Location: %s | %s (%s at %s) | %s (%s at %s) | %s', location, title_1, date_1,
    coalesce(time_1, 'All Day'), title_2, date_2, coalesce(time_2, 'All Day'),
    coalesce(recommendation, 'No available alternative time slots found for this date')) AS report_line FROM vc
  UNION ALL SELECT 'building_conflict', id_1, id_2, printf('Building: %s on %s | %s (%s, %s) | %s (%s, %s)', building, date,
    title_1, location_1, coalesce(time_1, 'All Day'), title_2, location_2, coalesce(time_2, 'All Day')) FROM bp
  UNION ALL SELECT type, id_1, id_2, printf('Series: %s | %s at %s | %s at %s | %s', title, date_1,
    coalesce(time_1, 'All Day'), date_2, coalesce(time_2, 'All Day'), warning) FROM rc""",
)
check(
    "venue_bookings",
    ["ce", "up", "iv", "placed"],
    """SELECT k.location AS asked_location, k.date, count(*) AS bookings, min(coalesce(p.time, '')) AS first_time,
    max(coalesce(p.time, '')) AS last_time
  FROM (SELECT DISTINCT location, date FROM placed) k
  JOIN placed p ON p.date = k.date AND contains(lower(p.location), lower(k.location)) GROUP BY 1, 2""",
)
check(
    "free_slots",
    ["ce", "up", "iv", "placed", "slot", "asked", "vb", "vfree"],
    """SELECT k.venue, k.date, count(*) AS bookings, coalesce(any_value(f.free), '') AS free
  FROM asked k JOIN vb ON vb.venue = k.venue AND vb.date = k.date
  LEFT JOIN (SELECT venue, date, string_agg(slot, ', ' ORDER BY h) AS free FROM vfree GROUP BY 1, 2) f
    ON f.venue = k.venue AND f.date = k.date
  GROUP BY 1, 2""",
)

check("recommendations", RECS, "SELECT * FROM rec")
check(
    "peak_hours",
    ["ce", "up"],
    f"""SELECT id, {text(vocab.PEAK_ACTION)} AS recommended_action, {text(vocab.PEAK_DETAILS)} AS details
  FROM up WHERE time >= '10:00' AND time < '14:00'""",
)
check(
    "rec_summary",
    RECS,
    """SELECT count(*) AS total, count(*) FILTER (has_conflicts) AS with_conflicts,
  count(*) FILTER (severity = 'high') AS high_severity, count(*) FILTER (severity = 'medium') AS medium_severity,
  count(*) FILTER (severity = 'low') AS low_severity FROM rec""",
)
check(
    "event_with_rec",
    RECS,
    """SELECT id, title, date, coalesce(time, 'Not specified') AS time, coalesce(location, 'Not specified') AS location,
    upper(severity) AS severity, CASE conflict_type WHEN 'venue_double_booking' THEN 'Venue Double Booking'
      WHEN 'building_conflict' THEN 'Building Conflict' END AS conflict_type,
    recommended_action, alternative_times, details FROM ce LEFT JOIN rec ON event_id = id""",
)
check(
    "replace_recs",
    RECS,
    """SELECT event_id, has_conflicts, conflict_type, severity, recommended_action FROM rec
  UNION ALL SELECT id, false, NULL, 'none', 'stored' FROM ce WHERE id NOT IN (SELECT event_id FROM rec)""",
)

check("time_mentions", CONTENT[:3], "SELECT id, structured_time FROM f2")
check("location_mentions", CONTENT[:3], "SELECT id, structured_location FROM f2")
check("event_types", CONTENT[:3], "SELECT id, event_type FROM f2")
check("tags", TAGGED, "SELECT event_id, tag FROM et")
check(
    "replace_tags",
    TAGGED,
    f"""SELECT event_id, tag FROM et WHERE event_id IN (SELECT id FROM ce WHERE date >= '{AS_OF}')
  UNION ALL SELECT id, 'stored' FROM ce WHERE id NOT IN (SELECT event_id FROM et WHERE event_id IN (SELECT id FROM ce WHERE date >= '{AS_OF}'))""",
)
check("missing_details", CONTENT[:2], f"SELECT id, unnest({_compact(_DETAILS)}) AS detail FROM f1")
check(
    "seo_suggestions",
    CONTENT[:4],
    """SELECT id, array_to_string(title_list, ' | ') AS title_suggestions,
  array_to_string(description_list, ' | ') AS description_suggestions FROM f3""",
)
check("seo_scores", CONTENT, "SELECT event_id, seo_score FROM ec")
check("enhanced_text", CONTENT, "SELECT event_id, enhanced_description FROM ec")
check("enhance_all", CONTENT, "SELECT * FROM ec")
_ELEMENTS = ", ".join(
    f"CASE WHEN NOT {_any(words, 'lower(dsc)')} THEN {text(vocab.KEY_ELEMENT_MISSING.format(element=element))} END"
    for element, words in vocab.KEY_ELEMENTS.items()
)
_KEY_LIST = (
    f"{_TITLE_LENGTH}, CASE WHEN {_NO_DIGIT} THEN {text(vocab.TITLE_NO_NUMBER)} END, "
    f"CASE WHEN length(dsc) < 100 THEN {text(vocab.DESCRIPTION_SHORT)} END, {_ELEMENTS}"
)
check("key_elements", CONTENT[:2], f"SELECT id, unnest({_compact(_KEY_LIST)}) AS suggestion FROM f1")
_STOPS = ", ".join(text(w) for w in vocab.STOP_WORDS)
check(
    "doc_keywords",
    [],
    f"""WITH tokens AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), {text(WORD)}),
    lambda w: NOT list_contains([{_STOPS}], w)) AS w FROM documents),
  terms AS (SELECT doc_id, unnest(w) AS term FROM tokens
    UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM tokens),
  tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY 1, 2),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
  scored AS (SELECT doc_id, term, tf, df,
    round(tf * (ln(((SELECT count(*) FROM documents) + 1) / CAST(df + 1 AS DOUBLE)) + 1), 9) AS score FROM tf JOIN df USING (term)),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS rank FROM scored)
  SELECT doc_id AS id, rank, term, tf, df FROM ranked WHERE rank <= 5""",
)


def _slug(column: str) -> str:
    return f"trim(regexp_replace(lower({column}), '[^a-z0-9]+', '-', 'g'), '-')"


check(
    "tag_slugs",
    TAGGED,
    f"""SELECT id, coalesce(t.slugs, '') AS tag_slugs, {_slug('title')} AS title_slug FROM ce LEFT JOIN (
    SELECT event_id, string_agg({_slug('tag')}, ',' ORDER BY tag) AS slugs FROM et GROUP BY event_id) t ON event_id = id""",
)
check(
    "feature_bundle",
    [*CONTENT, "et"],
    f"""SELECT id, array_to_string({_compact(f"{_TITLE_LENGTH}, CASE WHEN {_NO_DIGIT} THEN {text(vocab.TITLE_NO_NUMBER)} END")}, ' | ')
    AS title_suggestions,
  array_to_string({_compact(f"CASE WHEN length(dsc) < 100 THEN {text(vocab.DESCRIPTION_SHORT)} END, {_ELEMENTS}")}, ' | ')
    AS description_suggestions,
  enhanced_description, coalesce(slugs, '') AS tags, keywords,
  coalesce({text(vocab.KEYWORD_HINT)} || replace(keywords, ' | ', ', '), '') AS general_suggestions
  FROM f1 JOIN ec ON ec.event_id = id
  LEFT JOIN (SELECT event_id, string_agg({_slug('tag')}, ' | ' ORDER BY tag) AS slugs FROM et GROUP BY 1) t ON t.event_id = id
  LEFT JOIN (SELECT id AS doc, string_agg(term, ' | ' ORDER BY rank) AS keywords FROM ({SQL["doc_keywords"]}) GROUP BY 1) k
    ON k.doc = f1.id % (SELECT count(*) FROM documents)""",
)

check("orphans", CONTENT, f"SELECT event_id, event_type FROM ec WHERE event_id NOT IN (SELECT id FROM ce WHERE date >= '{AS_OF}')")
check(
    "clean_orphans",
    [*TAGGED, "up"],
    """SELECT 'enhanced_content' AS "table", (SELECT count(*) FROM ce) - (SELECT count(*) FROM up) AS removed
  UNION ALL SELECT 'event_tags', (SELECT count(*) FROM et WHERE event_id NOT IN (SELECT id FROM up))
  UNION ALL SELECT 'total', (SELECT count(*) FROM ce) - (SELECT count(*) FROM up)
    + (SELECT count(*) FROM et WHERE event_id NOT IN (SELECT id FROM up))""",
)
check(
    "cleanup_events",
    ["ce", "up"],
    f"""SELECT id, title, date, time FROM (SELECT *, row_number() OVER (PARTITION BY {_KEEP} ORDER BY id) AS n FROM up)
  WHERE n = 1""",
)
check(
    "cleanup_summary",
    ["ce", "up"],
    f"""SELECT (SELECT count(*) FROM ce WHERE date < '{AS_OF}') AS past_removed,
  (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM up GROUP BY {_KEEP})) AS duplicates_removed""",
)
check(
    "health",
    ["ce"],
    f"""SELECT 'past_events' AS "check", NULL AS title, NULL AS date, count(*) AS count FROM ce WHERE date < '{AS_OF}'
  UNION ALL SELECT 'duplicate', title, date, count(*) FROM ce GROUP BY title, date HAVING count(*) > 1""",
)
check(
    "constraint_report",
    [*TAGGED, "up"],
    """SELECT 'events.unique(id)' AS "constraint", count(id) - count(DISTINCT id) AS violations FROM up
  UNION ALL SELECT 'events.not_null(title)', count(*) - count(title) FROM up
  UNION ALL SELECT 'events.unique(link)', count(link) - count(DISTINCT link) FROM up
  UNION ALL SELECT 'enhanced_content.unique(event_id)', count(id) - count(DISTINCT id) FROM ce
  UNION ALL SELECT 'enhanced_content.foreign(event_id)', count(*) FROM ce WHERE id NOT IN (SELECT id FROM up)
  UNION ALL SELECT 'event_tags.not_null(tag)', count(*) - count(tag) FROM et
  UNION ALL SELECT 'event_tags.unique(event_id,tag)', count(*) - count(DISTINCT (event_id, tag)) FROM et
  UNION ALL SELECT 'event_tags.foreign(event_id)', count(*) FROM et WHERE event_id NOT IN (SELECT id FROM up)""",
)
check(
    "missing_tables",
    ["ce", "up"],
    """SELECT 'events.unique(id)' AS "constraint", count(id) - count(DISTINCT id) AS violations FROM up
  UNION ALL SELECT 'events.not_null(title)', count(*) - count(title) FROM up
  UNION ALL SELECT 'events.unique(link)', count(link) - count(DISTINCT link) FROM up
  UNION ALL SELECT 'enhanced_content.present', 1 UNION ALL SELECT 'event_tags.present', 1""",
)
check(
    "purge_bridges",
    ["ce", "up"],
    f"""SELECT id AS event_id, id % 5 AS category_id
  FROM (SELECT *, row_number() OVER (PARTITION BY {_KEEP} ORDER BY id) AS n FROM up) WHERE n = 1""",
)
check("default_content", ["ce"], f"SELECT id AS event_id, CAST(0 AS BIGINT) AS seo_score FROM ce WHERE date >= '{HISTORY_BEFORE}'")
check(
    "upsert_events",
    ["ce", "stored", "relisted"],
    """, seen AS (SELECT *, 'seen again: ' || title AS text,
    link IS NOT NULL AND (link IN (SELECT link FROM stored) OR row_number() OVER (PARTITION BY link ORDER BY id) > 1) AS known
    FROM relisted),
  fresh AS (SELECT (SELECT max(id) FROM stored) + row_number() OVER (ORDER BY id) AS id, title, text AS description, date, time,
    location, link FROM seen WHERE NOT known),
  change AS (SELECT title, date, time, arg_max(text, id) AS text, arg_max(coalesce(location, chr(1)), id) AS place
    FROM seen WHERE known GROUP BY title, date, time),
  result AS (SELECT id, title, description, date, time, location, link FROM stored UNION ALL SELECT * FROM fresh)
  SELECT r.id, r.title, coalesce(c.text, r.description) AS description, r.date, r.time,
    CASE WHEN c.text IS NOT NULL THEN nullif(c.place, chr(1)) ELSE r.location END AS location, r.link
  FROM result r LEFT JOIN change c ON c.title = r.title AND c.date = r.date AND c.time IS NOT DISTINCT FROM r.time""",
)

check(
    "export_basic",
    [*CONTENT, "up"],
    """SELECT id AS "ID", title AS "Title", date AS "Date", time AS "Time", location AS "Location", description AS "Description",
  link AS "Link" FROM up JOIN ec ON event_id = id WHERE event_type ILIKE '%Academic%'""",
)
check(
    "export_enhanced",
    [*CONTENT, "et", "tagged", "up"],
    """SELECT id AS "ID", title AS "Title", date AS "Date", time AS "Time", location AS "Location", description AS "Description",
    link AS "Link", event_type AS "Event Type", seo_score AS "SEO Score", enhanced_description AS "Enhanced Description",
    tags AS "Tags"
  FROM up JOIN ec ON ec.event_id = id LEFT JOIN tagged t ON t.event_id = id
  WHERE location ILIKE '%room%' AND date BETWEEN '2024-01-16' AND '2024-01-25'""",
)
_ENTRIES = """SELECT id, 'event-' || CAST(id AS STRING) || '@campus.example.edu' AS uid, title AS summary,
  CASE WHEN all_day THEN strftime(s, '%Y%m%d') ELSE strftime(s, '%Y%m%dT%H%M%S') END AS dtstart,
  CASE WHEN all_day THEN strftime(s + INTERVAL 1 DAY, '%Y%m%d') ELSE strftime(e, '%Y%m%dT%H%M%S') END AS dtend, all_day,
  CASE WHEN description != '' THEN '[' || event_type || ']' || chr(10) || chr(10) || description END AS description,
  location, link AS url, event_type AS categories FROM iv JOIN ec ON event_id = id"""
check("ical_vevents", [*CONTENT, "up", "iv"], _ENTRIES)
check("ical_single", [*CONTENT, "up", "iv"], _ENTRIES + " WHERE id = (SELECT min(id) FROM up)")

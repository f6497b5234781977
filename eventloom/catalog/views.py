"""SQL views that Spark and DuckDB share word for word, so both engines see the same derived rows."""

from __future__ import annotations

AS_OF = "2024-01-15"

# Event rows with faults to find: blank, short and padded titles, other date layouts, bad and 12-hour times, blank and
# overlong places, links without a scheme, overlong descriptions.
DIRTY = """SELECT id,
  CASE WHEN id % 7 = 0 THEN '' WHEN id % 19 = 0 THEN '  ab ' WHEN id % 23 = 0 THEN '  ' || title || '    x  '
    WHEN id % 47 = 0 THEN repeat(title || '  ', 20) ELSE title END AS title,
  CASE WHEN id % 11 = 0 THEN CAST(CAST(substr(date, 6, 2) AS INT) AS STRING) || '/'
      || CAST(CAST(substr(date, 9, 2) AS INT) AS STRING) || '/' || substr(date, 1, 4)
    WHEN id % 29 = 0 THEN '2024-13-45'
    WHEN id % 31 = 0 THEN substr(date, 9, 2) || '-' || substr(date, 6, 2) || '-' || substr(date, 1, 4)
    WHEN id % 53 = 0 THEN ' ' || replace(date, '-', '/') || ' ' WHEN id % 59 = 0 THEN NULL ELSE date END AS date,
  CASE WHEN id % 13 = 0 THEN '25:99' WHEN id % 14 = 1 THEN '2:30 PM' WHEN id % 37 = 0 THEN '7pm'
    WHEN id % 38 = 0 THEN '12 am' WHEN id % 39 = 1 THEN ' 9:5 ' ELSE time END AS time,
  CASE WHEN id % 9 = 0 THEN '   ' WHEN id % 41 = 0 THEN repeat('Room 1  ', 40) ELSE location END AS location,
  CASE WHEN id % 17 = 0 THEN substr(link, 9) WHEN id % 61 = 0 THEN '  ' || link || ' ' ELSE link END AS link,
  CASE WHEN id % 43 = 0 THEN repeat(description, 3) ELSE description END AS description
FROM {ce}"""

# The same listing seen again: most links changed, some titles with a slip or another case.
RELISTED = """SELECT id,
  CASE WHEN id % 4 = 1 THEN title || '!' WHEN id % 4 = 2 THEN substr(title, 1, 3) || 'x' || substr(title, 5)
    WHEN id % 16 = 3 THEN upper(replace(title, 'ß', 's')) ELSE title END AS title,
  description, date, time, location,
  CASE WHEN id % 83 = 0 THEN NULL WHEN id % 5 = 0 THEN link ELSE link || '?from=feed' END AS link
FROM {ce}"""

# Stored rows beside which a second table is kept up to date.
HISTORY_BEFORE = "2024-01-22"

# Listing pages around the given ones: two listed events and one without a title link, nested lists and blocks, a tag in a comment.
LISTINGS = """SELECT page_id, url, '<html><!-- <div class="views-row"> --><body><div class="list"><div class="odd views-row first">'
  || '<div class="field-title"><h2><a class="x" href="/event/' || CAST(page_id AS STRING) || '">Event &amp; ' || CAST(page_id AS STRING)
  || '</a></h2></div><div class="field-body"><div><p>From ' || url || '</p><ul><li>one</li><li> two</li></ul></div> end</div>'
  || CASE WHEN page_id % 3 = 0 THEN '' ELSE '<div class="views-field-field-dates-value"><div><time datetime="2025-03-0'
    || CAST(1 + page_id % 9 AS STRING) || 'T14:30:00">then</time></div></div>' END
  || '<DIV class="field-location"><div>Hall ' || CAST(page_id % 7 AS STRING) || '</div></DIV></div><div class="field-body">outside</div>'
  || '<div class="views-row"><div class="field-title">no link</div><div class="field-body">' || url || '</div></div>'
  || CASE WHEN page_id % 5 = 0 THEN '' ELSE '<div class="views-row"><div class="field-title"><a href="https://other.example.edu/'
    || CAST(page_id AS STRING) || '">Second</a></div></div>' END || '</div><div class="field-location">below</div></body></html>' AS html
FROM {pages}"""

"""Event rows out of listing pages, by regular expressions and folds over tags inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import split_iso
from ..functions.text import let, strip

# Row and field patterns of a plain link list; group 1 is the value.
LIST_ITEMS = {
    "row": r"(?is)<li\b[^>]*>(.*?)</li>",
    "title": r"(?is)<a\b[^>]*>(.*?)</a>",
    "link": r"""(?is)<a\b[^>]*\bhref\s*=\s*["']([^"']*)["']""",
}
# Opening tags of listing blocks and of the containers of their fields; each ends at its own closing tag.
LISTING_BLOCKS = {
    "element": "div",
    "row": r"""(?is)^<div\b[^>]*class="[^"]*\bviews-row\b""",
    "title": r"""(?is)^<div\b[^>]*class="[^"]*\bfield-title\b""",
    "description": r"""(?is)^<div\b[^>]*class="[^"]*\bfield-body\b""",
    "datetime": r"""(?is)^<div\b[^>]*class="[^"]*\bviews-field-field-dates-value\b""",
    "location": r"""(?is)^<div\b[^>]*class="[^"]*\bfield-location\b""",
}
TIME_STAMP = r"""(?is)<time\b[^>]*\bdatetime\s*=\s*["']([^"']*)["']"""
#: Comments, tags and texts; a comment is one token, so tags in it open nothing.
TOKEN = r"(?s)<!--.*?-->|<[^>]*>|[^<]+|<"
# Character references decoded in the extracted text (fixed values); the ampersand comes last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def plain_text(markup: Column) -> Column:
    text = F.regexp_replace(markup, "(?s)<[^>]*>", "")
    for reference, char in ENTITIES:
        text = F.replace(text, F.lit(reference), F.lit(char))
    return strip(text)


def _first(block: Column, pattern: str | None) -> Column:
    if pattern is None:
        return F.lit(None).cast("string")
    return F.when(block.rlike(pattern), F.regexp_extract(block, pattern, 1))


def nested_blocks(html: str, opener: str, element: str) -> str:
    """SQL for the array of blocks, in order, that start with a tag like ``opener`` and end at their own closing tag.

    The markup is cut into tokens. A fold over the tags of ``element`` counts how deep they lie and holds the blocks still open; a
    closing tag ends the block that was opened at its depth. Blocks left open run to the end.
    """
    kind = f"""CASE WHEN t RLIKE r'{opener}' THEN 2 WHEN t RLIKE r'(?i)^<{element}\\b' THEN 1
        WHEN t RLIKE r'(?i)^</{element}\\b' THEN -1 ELSE 0 END"""
    marks = f"filter(transform(tokens, (t, i) -> named_struct('i', i, 'kind', {kind})), m -> m.kind != 0)"
    state = """named_struct('depth', 0, 'open', CAST(array() AS ARRAY<STRUCT<i: INT, depth: INT>>),
        'done', CAST(array() AS ARRAY<STRUCT<a: INT, b: INT>>))"""
    opened = """named_struct('depth', s.depth + 1,
        'open', IF(m.kind = 2, concat(s.open, array(named_struct('i', m.i, 'depth', s.depth))), s.open), 'done', s.done)"""
    closed = """named_struct('depth', greatest(s.depth - 1, 0), 'open', slice(s.open, 1, size(s.open) - 1),
        'done', concat(s.done, array(named_struct('a', try_element_at(s.open, -1).i, 'b', m.i))))"""
    ended = "coalesce(try_element_at(s.open, -1).depth = s.depth - 1, false)"
    step = f"""CASE WHEN m.kind > 0 THEN {opened} WHEN {ended} THEN {closed}
        ELSE named_struct('depth', greatest(s.depth - 1, 0), 'open', s.open, 'done', s.done) END"""
    left = "concat(s.done, transform(s.open, o -> named_struct('a', o.i, 'b', size(tokens) - 1)))"
    spans = f"array_sort(aggregate({marks}, {state}, (s, m) -> {step}, s -> {left}))"
    blocks = f"transform({spans}, e -> array_join(slice(tokens, e.a + 1, e.b - e.a + 1), ''))"
    return let("tokens", f"regexp_extract_all({html}, r'{TOKEN}', 0)", blocks)


def site_of(url: Column) -> Column:
    """Scheme and host of an absolute address, else NULL."""
    pattern = r"(?i)^https?://[^/?#]+"
    return F.when(url.rlike(pattern), F.regexp_extract(url, pattern, 0))


def extract_listing_rows(
    pages: DataFrame, patterns: dict[str, str] = LIST_ITEMS, base_url: str | None = "https://campus.example.edu"
) -> DataFrame:
    """One row per listed event: page_id, row_no, title, description, date, time, location, link.

    Rows without a title link are skipped; links starting with '/' are made absolute, with ``base_url`` or, where that is None, with
    the site of the page's ``url``. With an ``element`` in ``patterns``, rows and fields are ``nested_blocks``.
    """
    nested, base = "element" in patterns, F.lit(base_url) if base_url else site_of(F.col("url"))
    found = (
        F.expr(nested_blocks("html", patterns["row"], patterns["element"]))
        if nested
        else F.regexp_extract_all("html", F.lit(patterns["row"]), 1)
    )
    rows = pages.select("page_id", base.alias("base"), F.posexplode(found).alias("row_no", "block"))
    block = F.col("block")

    def field(name: str) -> Column:
        return F.expr(f"get({nested_blocks('block', patterns[name], patterns['element'])}, 0)")

    if nested:
        rows = rows.withColumns({f"in_{name}": field(name) for name in ("title", "description", "datetime", "location")})
        values = {
            "title": plain_text(_first(F.col("in_title"), LIST_ITEMS["title"])),
            "description": plain_text(F.col("in_description")),
            "stamp": _first(F.col("in_datetime"), TIME_STAMP),
            "location": plain_text(F.col("in_location")),
            "href": _first(F.col("in_title"), LIST_ITEMS["link"]),
        }
    else:
        values = {
            "title": plain_text(_first(block, patterns["title"])),
            "description": plain_text(_first(block, patterns.get("description"))),
            "stamp": _first(block, patterns.get("datetime")),
            "location": plain_text(_first(block, patterns.get("location"))),
            "href": _first(block, patterns["link"]),
        }
    fields = rows.select(
        "page_id", F.col("row_no").cast("bigint").alias("row_no"), "base", *[value.alias(name) for name, value in values.items()]
    ).filter(F.col("title").isNotNull())
    date, time = split_iso(F.col("stamp"))
    href = F.col("href")
    absolute = F.when(href.startswith("/"), F.concat(F.col("base"), href)).otherwise(href)
    return fields.select(
        "page_id",
        "row_no",
        "title",
        "description",
        date.alias("date"),
        time.alias("time"),
        "location",
        absolute.alias("link"),
    )

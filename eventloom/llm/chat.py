"""Chat formatting with a round trip through its own grammar, in DataFrame functions only.

A conversation is rendered turn by turn between markers, read back by the pattern of the grammar, and compared with its
source. If it differs, because a text holds what looks like a marker, it is rendered anew with its conflicting characters
escaped, which always reads back; ``escape_level`` says which rendering stands. The first marker tells the reader which it is.

    conversation = ("<s>" | "<s e>") turn*
    turn         = "[SYS]" text "[/SYS]" | "[INST]" text "[/INST]" | "[OUT]" text "</s>" | "[ROLE " role "]" text "[/ROLE]"

In escaped texts and roles ``\\`` stands for itself as ``\\\\``, ``<`` is ``\\l``, ``[`` is ``\\b`` and ``]`` is ``\\r``. A null
role is an empty one, a null text an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Roles with markers of their own: opening and closing. Their order is that of the grammar.
MARKERS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[OUT]", "</s>")}
PLAIN, ESCAPED = "<s>", "<s e>"
#: The role whose texts are learned.
LEARNED = "assistant"

# One turn: the groups are the texts of the three roles, then another role and its text.
TURN = (
    r"(?s)(?:\[SYS\](.*?)\[/SYS\]|\[INST\](.*?)\[/INST\]|\[OUT\](.*?)</s>|\[ROLE ([^\]]*)\](.*?)\[/ROLE\])"
)


def escape(text: Column) -> Column:
    for char, code in (("\\", "\\\\"), ("<", "\\l"), ("[", "\\b"), ("]", "\\r")):
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """Splitting at double backslashes leaves only codes of the other characters."""
    parts = F.split(text, r"\\\\", -1)

    def plain(part: Column) -> Column:
        for char, code in (("<", "\\l"), ("[", "\\b"), ("]", "\\r")):
            part = F.replace(part, F.lit(code), F.lit(char))
        return part

    return F.array_join(F.transform(parts, plain), "\\")


def rendered(turns: Column, escaped: bool) -> Column:
    """Text of an array of (role, text)."""
    form = escape if escaped else (lambda c: c)

    def turn(t: Column) -> Column:
        role, text = t["role"], form(t["text"])
        out = F.concat(F.lit("[ROLE "), form(role), F.lit("]"), text, F.lit("[/ROLE]"))
        for name, (opening, closing) in MARKERS.items():
            out = F.when(role == name, F.concat(F.lit(opening), text, F.lit(closing))).otherwise(out)
        return out

    return F.concat(F.lit(ESCAPED if escaped else PLAIN), F.array_join(F.transform(turns, turn), ""))


def parsed(formatted: Column) -> Column:
    """Array of (role, text, raw, size) of a rendered conversation: ``raw`` is the text as it stands there, ``size`` the turn's length."""
    is_escaped = F.startswith(formatted, F.lit(ESCAPED))
    found = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))

    def turn(t: Column) -> Column:
        def inner(opening: str, closing: str) -> Column:
            return F.substr(t, F.lit(len(opening) + 1), F.length(t) - len(opening) - len(closing))

        end_of_role = F.instr(t, "]")
        role, raw = F.substr(t, F.lit(7), end_of_role - 7), F.substr(t, end_of_role + 1, F.length(t) - end_of_role - len("[/ROLE]"))
        for name, (opening, closing) in MARKERS.items():
            here = F.startswith(t, F.lit(opening))
            role = F.when(here, F.lit(name)).otherwise(role)
            raw = F.when(here, inner(opening, closing)).otherwise(raw)
        return F.struct(
            F.when(is_escaped, unescape(role)).otherwise(role).alias("role"),
            F.when(is_escaped, unescape(raw)).otherwise(raw).alias("text"),
            raw.alias("raw"),
            F.length(t).alias("size"),
        )

    return F.transform(found, turn)


def conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, turns``: the rows of each conversation by turn, ties by role and text; null turns come first."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    gathered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return gathered.withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))


def _same(found: Column, turns: Column) -> Column:
    return F.transform(found, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))) == turns


def format_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, turns, formatted, escape_level, read, identical`` from rows (conv_id, turn, role, text).

    ``read`` is what the grammar finds in ``formatted``, ``identical`` whether that is the source. Rows of a null id are one
    conversation, repeated rows are turns of their own, other columns are not read, an empty table gives no rows. A
    conversation is one value, so its rows meet in one task.
    """
    given = conversations(rows).withColumn("plain", rendered(F.col("turns"), False))
    first = given.withColumn("escape_level", F.when(_same(parsed(F.col("plain")), F.col("turns")), 0).otherwise(1))
    written = first.withColumn(
        "formatted", F.when(F.col("escape_level") == 0, F.col("plain")).otherwise(rendered(F.col("turns"), True))
    ).drop("plain")
    read = written.withColumn("read", parsed(F.col("formatted")))
    return read.withColumn("identical", _same(F.col("read"), F.col("turns")))


def loss_text(read: Column) -> Column:
    """All text under the loss mask, nothing between."""
    return F.array_join(F.transform(F.filter(read, lambda t: t["role"] == LEARNED), lambda t: t["text"]), "")


def loss_spans(read: Column, formatted: Column) -> Column:
    """The loss mask over ``formatted``: an array of (start, end) in code points, end exclusive, one for each learned turn."""
    head = F.when(F.startswith(formatted, F.lit(ESCAPED)), F.lit(len(ESCAPED))).otherwise(F.lit(len(PLAIN)))
    opening, _ = MARKERS[LEARNED]

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + len(opening)
        span = F.struct(start.alias("start"), (start + F.length(t["raw"])).alias("end"))
        spans = F.when(t["role"] == LEARNED, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((acc["at"] + t["size"]).alias("at"), spans.alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    return F.aggregate(read, F.struct(head.alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])


def digest(formatted: DataFrame) -> DataFrame:
    """What the output reads back as: counts, lengths in code points and SHA-256 in hex, for each conversation."""
    read = F.col("read")
    lines = F.array_join(F.transform(read, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.select(
        "conv_id",
        F.size(read).cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length(loss_text(read)).cast("long").alias("loss_chars"),
        F.sha2(loss_text(read), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )

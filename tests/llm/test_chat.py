import hashlib

import pytest
from pyspark.sql import functions as F

from eventloom.llm.chat import digest, escape, format_conversations, loss_spans, unescape
from eventloom.llm.queries import SQL, op5_chat
from tools.check_queries import compare, connect

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, read STRING"
HARD = ["", "\\", "\\\\l", "</s>", "[/INST]", "[INST][/INST]", "<s e>", "[ROLE x]", "[/ROLE]", "\\b[", "<l\\", "\n", "$1\\E", "é😀[", "[SYS]", "a\\r]"]


def rows():
    out = []
    for i, text in enumerate(HARD):
        for j, role in enumerate(("system", "user", "assistant", "tool", "a]b\\", None, "", "user")):
            out.append((i, j, role, text if j % 2 else text + text, "x"))
    out += [(100, None, "user", "first", "x"), (100, 0, "assistant", None, "x"), (100, 0, "assistant", None, "x"), (None, 3, "user", "hi", "x")]
    out += [(101, 0, "assistant", "word " * 30_000, "x"), (102, 5, "assistant", "one", "x"), (102, 5, "user", "</s>", "x")]
    return out


def test_round_trip(spark):
    frame = spark.createDataFrame(rows(), SCHEMA)
    formatted = format_conversations(frame)
    assert formatted.filter("NOT identical OR identical IS NULL").count() == 0
    levels = {r.conv_id: r.escape_level for r in formatted.select("conv_id", "escape_level").collect()}
    assert levels[101] == 0 and levels[102] == 0 and levels[HARD.index("</s>")] == 1
    found = {r.conv_id: r for r in digest(formatted).collect()}
    for conv in {r[0] for r in rows()}:
        turns = sorted((r for r in rows() if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        lines = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        learned = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        r = found[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(learned))
        assert r.turns_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()


def test_loss_mask_covers_learned_texts_only(spark):
    formatted = format_conversations(spark.createDataFrame(rows(), SCHEMA))
    for r in formatted.withColumn("spans", loss_spans(F.col("read"), F.col("formatted"))).collect():
        raw = [t.raw for t in r.read if t.role == "assistant"]
        assert [r.formatted[s.start : s.end] for s in r.spans] == raw


@pytest.mark.parametrize("text", HARD)
def test_escapes(spark, text):
    out = spark.range(1).select(escape(F.lit(text)).alias("e")).withColumn("u", unescape(F.col("e"))).head()
    assert out.u == text and not set("<[]") & set(out.e)


def test_empty_table_and_sql(spark):
    assert format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
    sf = "/root/testdata/sf0.01"
    assert compare(op5_chat(spark, sf), connect(sf), SQL["op5_chat"]).startswith("ok")

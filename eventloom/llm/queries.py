"""The operators' queries over the whole test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, decontaminate, langid, lines, lm, packing, periods, repair, repeats, secrets, simhash, toxicity
from .common import remainder, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op2_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf, "documents")).drop("kept")


def op3_lm(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score(table(spark, sf, "documents"), remainder("doc_id", 10) == 0)


def op4_ann(spark: SparkSession, sf: str) -> DataFrame:
    return ann.search(table(spark, sf, "embeddings"))


def op5_chat(spark: SparkSession, sf: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digest(chat.format_conversations(rows))


def op6_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf, "documents").select("doc_id", "text")))


def op7_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


def op8_langid(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", (remainder("doc_id", 4) == 2).alias("held_out"))
    model = langid.fit(docs.filter("NOT held_out"))
    return langid.identify(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", (remainder("doc_id", 3) == 1).alias("held_out"))
    labels = table(spark, sf, "labels").filter(remainder("doc_id", 3) != 1)
    scorer = toxicity.fit(docs.filter("NOT held_out"), labels)
    return toxicity.score(docs, scorer).drop("text")


def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op11_periods(spark: SparkSession, sf: str) -> DataFrame:
    return periods.digest(periods.find_runs(periods.plant(table(spark, sf, "documents"))))


def op12_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines.digest(lines.drop_shared_lines(table(spark, sf, "documents")))


def op13_repair(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return repair.digest(repair.repair(repair.damage(rows)), rows.select("conv_id"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_repeats,
        op3_lm,
        op4_ann,
        op5_chat,
        op6_secrets,
        op7_packing,
        op8_langid,
        op9_toxicity,
        op10_decontamination,
        op11_periods,
        op12_lines,
        op13_repair,
    )
}


def _replaced(column: str) -> str:
    for char, code in (("\\", "\\\\"), ("<", "\\l"), ("[", "\\b"), ("]", "\\r")):
        column = f"replace({column}, '{char}', '{code}')"
    return column


_BLANKS = " || ".join(f"chr({ord(c)})" for c in lines.BLANKS)

# CRC-32 of an ASCII name, bit by bit.
_CRC = """list_reduce(list_concat([4294967295], list_transform(string_split(name, ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))"""

# A text conflicts if its turn's closing marker is in it, a role of its own if it holds a bracket.
SQL: dict[str, str] = {
    "op5_chat": f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns AS (
  SELECT *, CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 9 ELSE 14 END AS marks,
    CASE WHEN role IN ('system', 'user', 'assistant') THEN '' ELSE role END AS named,
    CASE role WHEN 'system' THEN contains(text, '[/SYS]') WHEN 'user' THEN contains(text, '[/INST]')
      WHEN 'assistant' THEN contains(text, '</s>') ELSE contains(text, '[/ROLE]') OR contains(role, ']') END AS conflicts
  FROM rows),
levels AS (SELECT conv_id, bool_or(conflicts) AS escaped FROM turns GROUP BY conv_id),
sized AS (
  SELECT t.*, escaped, CASE WHEN escaped THEN length({_replaced("text")}) + length({_replaced("named")})
    ELSE length(text) + length(named) END AS written
  FROM turns t JOIN levels l ON t.conv_id IS NOT DISTINCT FROM l.conv_id)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(marks + written) + max(CASE WHEN escaped THEN 5 ELSE 3 END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op12_lines": f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS split FROM documents),
lines AS (SELECT r, doc_id, unnest(split) AS line, generate_subscripts(split, 1) AS place FROM texts),
keyed AS (SELECT *, translate(trim(line, {_BLANKS}), '{lines.UPPER}', '{lines.LOWER}') AS key FROM lines),
shared AS (
  SELECT key AS shared_key, max(doc_id) AS last FROM keyed WHERE length(key) >= {lines.LEAST_CHARS} GROUP BY key
  HAVING count(DISTINCT doc_id) + CAST(bool_or(doc_id IS NULL) AS INT) >= {lines.LEAST_DOCS}),
marked AS (
  SELECT keyed.*, shared_key IS NOT NULL AND doc_id IS DISTINCT FROM last AS gone FROM keyed LEFT JOIN shared ON key = shared_key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id""",
    "op13_repair": f"""
WITH RECURSIVE named AS (
  SELECT dense_rank() OVER (ORDER BY conv_id) AS conv, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
hashed AS (SELECT *, xor({_CRC}, 4294967295) % 20 AS kind FROM named),
damaged AS (
  SELECT conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hashed),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) - 1 AS i,
    row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, copy) AS seen, left(role, 1) AS initial,
    rtrim(text, {_BLANKS}) AS whole FROM damaged),
faults AS (
  SELECT *, CASE WHEN whole = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN right(whole, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS pair FROM numbered),
sums AS (
  SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv),
inserts(state, behind, letters, price, given) AS (VALUES
  (0, 0, '', 0, []), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []),
  (0, 2, 'I', 2, ['user:']), (1, 2, 'I', 2, ['user:']), (2, 3, 'I', 2, ['assistant:']), (3, 2, 'I', 2, ['user:']),
  (0, 3, 'II', 4, ['user:', 'assistant:']), (1, 3, 'II', 4, ['user:', 'assistant:']),
  (2, 2, 'II', 4, ['assistant:', 'user:']), (3, 3, 'II', 4, ['user:', 'assistant:'])),
moves(state, behind, letter, price, initial, given) AS (VALUES
  (0, 0, 'D', 3, NULL, NULL), (1, 1, 'D', 3, NULL, NULL), (2, 2, 'D', 3, NULL, NULL), (3, 3, 'D', 3, NULL, NULL),
  (0, 1, 'K', 0, 's', NULL), (0, 2, 'K', 0, 'u', NULL), (1, 2, 'K', 0, 'u', NULL), (2, 3, 'K', 0, 'a', NULL), (3, 2, 'K', 0, 'u', NULL),
  (0, 2, 'R', 2, NULL, 'user'), (1, 2, 'R', 2, NULL, 'user'), (2, 3, 'R', 2, NULL, 'assistant'), (3, 2, 'R', 2, NULL, 'user')),
steps AS (
  SELECT f.conv, f.i, m.state, m.behind, m.letter, m.price + CASE WHEN m.letter <> 'D' AND fault = 'truncated' THEN 1 ELSE 0 END AS price,
    CASE WHEN m.letter = 'D' THEN [] ELSE [coalesce(given, role) || ':' || text] END AS given
  FROM faults f JOIN moves m ON (m.initial IS NULL OR m.initial = f.initial) AND (m.letter = 'D' OR fault NOT IN ('blank', 'duplicate'))),
paths AS (
  SELECT conv, CAST(0 AS BIGINT) AS i, 0 AS state, '000000' AS way, CAST([] AS VARCHAR[]) AS given FROM sums
  UNION ALL
  SELECT conv, i, state, min(way) AS way, arg_min(given, way) AS given FROM (
    SELECT p.conv, p.i + 1 AS i, s.behind AS state,
      lpad(CAST(CAST(left(way, 6) AS INT) + n.price + s.price AS VARCHAR), 6, '0') || substr(way, 7) || n.letters || s.letter AS way,
      list_concat(list_concat(p.given, n.given), s.given) AS given
    FROM paths p JOIN inserts n ON n.state = p.state JOIN steps s ON s.conv = p.conv AND s.i = p.i AND s.state = n.behind)
  GROUP BY conv, i, state),
ends AS (
  SELECT p.conv, min(lpad(CAST(CAST(left(way, 6) AS INT) + price AS VARCHAR), 6, '0') || substr(way, 7) || letters) AS way,
    arg_min(list_concat(p.given, n.given), lpad(CAST(CAST(left(way, 6) AS INT) + price AS VARCHAR), 6, '0') || substr(way, 7) || letters) AS given
  FROM paths p JOIN sums s ON s.conv = p.conv AND s.n = p.i JOIN inserts n ON n.state = p.state AND n.behind IN (0, 3) GROUP BY p.conv)
SELECT DISTINCT n.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(left(way, 6) AS BIGINT), 0) AS cost,
  coalesce(substr(way, 7), '') AS audit, sha256(coalesce(array_to_string(given, chr(10)), '')) AS repaired_sha256
FROM named n LEFT JOIN sums s ON s.conv = n.conv LEFT JOIN ends e ON e.conv = n.conv""",
}

"""Sources and parsers (S03, S07, S09-S11), text flat-maps (P11) and word
counts (A01, A02)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice import model
from sluice.functions.text import csv_line
from sluice.operators.aggregate import keyed_final, keyed_rolling
from sluice.plans import query
from sluice.plans.sql import SENSOR, with_views
from sluice.sinks.kafka import kafka_keyed_frame
from sluice.sources import kafka_decode, parse_int_line, parse_pair_csv, parse_sensor_csv, parse_triple_csv
from sluice.sources.text import text_lines, tokenize

LINES_SQL = (
    "lines AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '\\n\\z', ''), chr(10))) AS line, "
    "unnest(range(1, len(string_split(regexp_replace(text, '\\n\\z', ''), chr(10))) + 1)) AS line_no "
    "FROM documents)"
)
TOKENS_SQL = (
    "toks AS (SELECT doc_id, line_no, unnest(arr) AS word, unnest(range(0, len(arr))) AS pos FROM "
    "(SELECT doc_id, line_no, CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' "
    "THEN []::VARCHAR[] ELSE string_split(rtrim(line, ' '), ' ') END AS arr FROM lines))"
)
SENSOR_LINES_SQL = (
    "slines AS (SELECT event_id AS seq, concat_ws(',', CAST(user_id AS VARCHAR), "
    "CAST(epoch_us(ts) // 1000000 AS VARCHAR), CASE WHEN event_type = 'error' THEN CAST(value AS VARCHAR) "
    "ELSE CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) END) AS line FROM events)"
)
INT_RE = "'^[+-]?[0-9]+$'"


def _sql_num(expr: str, kind: str) -> str:
    return f"CASE WHEN regexp_matches({expr}, {INT_RE}) THEN TRY_CAST({expr} AS {kind}) END"


def _lines(spark, sf):
    docs = model.table(spark, sf, "documents").select("doc_id", "text")
    return text_lines(docs)


def _tokens(spark, sf):
    return tokenize(_lines(spark, sf))


@query("s03_src_text_lines", with_views(LINES_SQL) + "SELECT doc_id, line_no, line FROM lines")
def s03(spark, sf):
    return _lines(spark, sf)


@query(
    "p11_flatmap_tokenize",
    with_views(LINES_SQL, TOKENS_SQL) + "SELECT doc_id, line_no, pos, word, CAST(1 AS BIGINT) AS one FROM toks",
)
def p11(spark, sf):
    return _tokens(spark, sf)


@query(
    "a01_word_count_batch",
    with_views(LINES_SQL, TOKENS_SQL) + "SELECT word, count(*) AS cnt FROM toks GROUP BY word",
)
def a01(spark, sf):
    return keyed_final(_tokens(spark, sf), ["word"], [F.sum("one").alias("cnt")])


@query(
    "a02_word_count_stream",
    with_views(LINES_SQL, TOKENS_SQL)
    + "SELECT doc_id, line_no, pos, word, count(*) OVER (PARTITION BY word ORDER BY doc_id, line_no, pos "
    "ROWS UNBOUNDED PRECEDING) AS cnt FROM toks",
)
def a02(spark, sf):
    # rolling count: one output per token, in (doc, line, position) order
    return keyed_rolling(
        _tokens(spark, sf), ["word"], "doc_id", [("cnt", "sum", F.col("one"))], tiebreak=["line_no", "pos"]
    ).select("doc_id", "line_no", "pos", "word", "cnt")


@query(
    "s07_src_kafka_decode",
    with_views(SENSOR)
    + "SELECT seq, concat_ws(',', id, ts, vc) AS value, CAST(id AS VARCHAR) AS key FROM sensor",
)
def s07(spark, sf):
    # encode as the Kafka connector delivers records, then decode
    s = model.sensor_view(spark, sf)
    frame = kafka_keyed_frame(s, csv_line("id", "ts", "vc"), "ws", keep=["seq"])
    return kafka_decode(frame, value_only=False, keep=["seq"])


def _sensor_lines(spark, sf):
    return model.sensor_lines(model.table(spark, sf, "events"))


@query(
    "s09_parse_sensor_csv_good",
    with_views(SENSOR_LINES_SQL)
    + "SELECT seq, string_split(line, ',')[1] AS id, "
    + _sql_num("string_split(line, ',')[2]", "BIGINT")
    + " AS ts, "
    + _sql_num("string_split(line, ',')[3]", "INTEGER")
    + " AS vc FROM slines WHERE len(string_split(line, ',')) = 3 AND "
    + _sql_num("string_split(line, ',')[2]", "BIGINT")
    + " IS NOT NULL AND "
    + _sql_num("string_split(line, ',')[3]", "INTEGER")
    + " IS NOT NULL",
)
def s09_good(spark, sf):
    return parse_sensor_csv(_sensor_lines(spark, sf))[0]


@query(
    "s09_parse_sensor_csv_reject",
    with_views(SENSOR_LINES_SQL)
    + "SELECT seq, line FROM slines WHERE NOT (len(string_split(line, ',')) = 3 AND "
    + _sql_num("string_split(line, ',')[2]", "BIGINT")
    + " IS NOT NULL AND "
    + _sql_num("string_split(line, ',')[3]", "INTEGER")
    + " IS NOT NULL)",
)
def s09_bad(spark, sf):
    return parse_sensor_csv(_sensor_lines(spark, sf))[1]


@query(
    "s10_parse_pair_csv",
    with_views(SENSOR) + "SELECT seq, CAST(id AS VARCHAR) AS k, CAST(ts AS INTEGER) AS t FROM sensor",
)
def s10_pair(spark, sf):
    s = model.sensor_view(spark, sf).select("seq", csv_line("id", "ts").alias("line"))
    return parse_pair_csv(s)[0]


@query(
    "s10_parse_triple_csv",
    with_views(SENSOR)
    + "SELECT seq, CAST(id AS VARCHAR) AS k, CAST(ts AS INTEGER) AS t, vc AS v FROM sensor",
)
def s10_triple(spark, sf):
    s = model.sensor_view(spark, sf).select("seq", csv_line("id", "ts", "vc").alias("line"))
    return parse_triple_csv(s)[0]


@query(
    "s11_parse_int_line",
    with_views(SENSOR_LINES_SQL)
    + "SELECT seq, string_split(line, ',')[3] AS line, "
    + _sql_num("string_split(line, ',')[3]", "INTEGER")
    + " AS n FROM slines",
)
def s11(spark, sf):
    lines = _sensor_lines(spark, sf).select("seq", F.split("line", ",").getItem(2).alias("line"))
    return parse_int_line(lines)

"""S03-S06 text sources and the one-space tokenizer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a file, a directory or any Hadoop URI."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """The same lines as a stream of files (one file per trigger
    replays a socket feed in arrival order)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).withColumnRenamed("value", "line")


def text_lines(df: DataFrame, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """A stored text as the lines a file reader would give: split on ``\\n``;
    a final ``\\n`` does not open an extra line.  Emits ``line_no`` (1-based)."""
    body = F.regexp_replace(F.col(text), "\\n\\z", "")
    return df.select(
        *keep, F.posexplode(F.split(body, "\n", -1)).alias("line_no", "line")
    ).withColumn("line_no", F.col("line_no") + 1)


def java_split_space(line: Column) -> Column:
    """Tokens of ``line.split(" ")`` in Java: inner empty tokens are kept,
    trailing ones dropped; an empty line gives one empty token and a line of
    only spaces gives none."""
    trimmed = F.rtrim(line)
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast(T.ArrayType(T.StringType())))
        .otherwise(F.split(trimmed, " ", -1))
    )


def tokenize(lines: DataFrame, line: str = "line", keep=("doc_id", "line_no")) -> DataFrame:
    """P11 flat-map: one ``(word, 1)`` row per token, with its position."""
    return lines.select(
        *keep, F.posexplode(java_split_space(F.col(line))).alias("pos", "word")
    ).withColumn("one", F.lit(1).cast("bigint"))

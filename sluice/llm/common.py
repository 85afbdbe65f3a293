"""Helpers shared by the operators: shared scratch tables, Arrow row access."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import ensure_checkpoint_dir, ship_package

# The word rule of the shingle operators.  A word is a maximal
# run of bytes other than space and 0x09-0x0D; only A-Z change case.
WORD_BREAKS = b" \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the
    session.  Only a session in one process may go without it (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (named or ensure_checkpoint_dir(spark)).rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/sluice-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once,
    lineage cut, and nothing is lost with an executor."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with the package shipped to the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def text_rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """The rows of a batch one by one, so that one Python string lives at a
    time however long the texts are."""
    cols = [batch.column(batch.schema.get_field_index(n)) for n in names]
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in cols)


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` with null equal to null; the right keys are dropped."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])

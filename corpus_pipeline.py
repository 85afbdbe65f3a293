"""The corpus pipeline: language, repeated lines, near copies, secrets, packing.

``STAGES`` lists (name, function); a function takes the documents that the
stage before kept and returns what it keeps, with the columns of
``documents``; the last returns the packed pieces.  ``run`` writes each
stage's result to the shared folder and hands the written table on.

Defined results: each stage's operator states them (``sluice.llm``).  Nulls in
any column, empty texts, repeated rows and empty tables pass: null, empty and
letterless texts are rejected by the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import langid, lines, packing, secrets, simhash
from sluice.llm.common import documents, materialize

TOKENIZER = "byte_bpe_50k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected (operator 6)."""
    return langid.drop_rejected(docs, langid.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines (operator 7)."""
    return lines.dedup(docs, unit="characters")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 9)."""
    return simhash.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, reported secrets masked (operator 4)."""
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, their token ids (little-endian, four bytes
    each) and their place in a sequence (operator 10)."""
    pieces = packing.document_pieces(docs, public_tokenizers.path(TOKENIZER), added=True)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")), carry=("ids",))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: A trained classifier and a tokenizer library are beyond SQL; tests hold the
#: stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

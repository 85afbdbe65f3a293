"""The registered queries of this package: ``opN_<name>`` over whole tables,
with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import bpe, embeddings, hard_negatives, langid, lines, oracles, packing, prefix_trie, secrets, sequence_files, sharding, simhash, sketches, urls
from sluice.llm.common import documents, materialize

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


@query("op3_byte_bpe")
def byte_bpe(spark, sf_dir):
    import public_tokenizers

    return bpe.round_trip_digests(documents(spark, sf_dir), public_tokenizers.path(bpe.RANK_FILE), public_tokenizers.PATTERN)


@query("op10_best_fit_packing")
def best_fit_packing(spark, sf_dir):
    import public_tokenizers

    pieces = packing.document_pieces(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), added=True)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests)


@query("op8_sequence_files")
def token_sequence_files(spark, sf_dir):
    import public_tokenizers

    return sequence_files.read(sequence_files.write(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), added=True))


@query("op9_simhash")
def simhash_components(spark, sf_dir):
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op4_secret_links", oracles.secret_links())
def secret_links(spark, sf_dir):
    return secrets.span_digests(documents(spark, sf_dir))


@query("op5_hilbert_shards")
def hilbert_shards(spark, sf_dir):
    rows = materialize(sharding.text_metadata(documents(spark, sf_dir)), "metadata")
    shards = sharding.hilbert_shards(rows)
    return shards.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


@query("op1_bottom_k_sketch")
def bottom_k_sketch(spark, sf_dir):
    return sketches.compare_with_edit(documents(spark, sf_dir))


@query("op6_language")
def language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return langid.predict(docs, langid.fit(docs))


@query("op7_line_dedup")
def line_dedup(spark, sf_dir):
    return lines.line_digests(documents(spark, sf_dir), unit="characters")


@query("op2_rp_forest")
def rp_forest(spark, sf_dir):
    return embeddings.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op12_url_filter")
def url_filter(spark, sf_dir):
    model = materialize(urls.train(urls.labelled_urls(spark)), "url-model")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return urls.judge(pages, model).select("page_id", "host", "path", "rule", "verdict", "score")


@query("op11_hard_negatives", oracles.hard_negatives())
def mined_negatives(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.whole_vectors(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)
    return hard_negatives.mine(rows)


@query("op13_prefix_trie", oracles.prefix_trie())
def conversation_trie(spark, sf_dir):
    return prefix_trie.nodes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))

"""Operators 8 and 10 against the library's own call, added tokens included."""

import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import pytest

from sluice.llm import packing, queries, sequence_files
from sluice.llm.subwords import ids_of

JSON = P.path("byte_bpe_50k.json")
END = "<|endoftext|>"
TEXTS = [
    f"a{END}b", END, f"{END}{END}", f"  {END}  two  ", f"x \n{END}\n y", f"don{END}'t", f"日本語{END}é \x1c{END} z", "<|endoftext|", f"<|{END}|>", "plain text", f"last {END}", None, "",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_call(library):
    ids = ids_of(JSON, None, True)
    assert library(TEXTS[0]) == [64, 50256, 65]
    for t in TEXTS:
        assert np.frombuffer(ids.encode(t), np.uint32).tolist() == library(t)


def test_queries_equal_the_call(spark, tmp_dir, library):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    digest = lambda ids: (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    at, want = 0, []
    for k, t in enumerate(TEXTS):
        n, crc = digest([*library(t), sequence_files.END_ID])
        want.append((k, at, n, crc))
        at += n
    got = queries.REGISTRY["op8_sequence_files"][0](spark, tmp_dir).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    want = [(k, *digest([*library(t), packing.END_ID])) for k, t in enumerate(TEXTS)]
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    for packed in (queries.REGISTRY["op10_best_fit_packing"][0](spark, tmp_dir), corpus_pipeline.best_fit_packing(spark, docs, tmp_dir)):
        assert sorted((r["doc_id"], r["length"], r["ids_crc32"]) for r in packed.collect()) == want

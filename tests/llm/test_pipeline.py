"""The stages on odd, plain and empty documents; queries; the guard."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as E
import corpus_pipeline
from conftest import ROOT
from odd_documents import empty, odd, plain  # noqa: F401
from sluice.llm.queries import REGISTRY


def test_stages_are_the_five_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "secret_scan", "best_fit_packing"]


def test_queries_are_registered():
    names = set(E.queries())
    assert {n.split("_")[0] for n in REGISTRY} == {f"op{i}" for i in range(1, 14)}
    assert set(REGISTRY) | {"pipeline"} <= names


@pytest.mark.parametrize("which", ["odd", "empty"])
def test_stages_keep_the_columns(spark, which, request, tmp_path):
    docs = request.getfixturevalue(which)
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / str(i))
        stage(spark, docs, "none").write.parquet(out)
        docs = spark.read.parquet(out)
        if i < 4:
            assert docs.columns == columns
    assert docs.columns == ["doc_id", "piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset"]
    assert docs.filter("crc32(ids) <> ids_crc32 or octet_length(ids) <> 4 * length").count() == 0
    if which == "empty":
        assert docs.count() == 0
    else:
        assert docs.filter("doc_id between 0 and 100").count() > 10


def test_run_equals_the_stages_one_by_one(spark, plain, tmp_path):
    plain.write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "sf"))
    ids = {r[0] for r in got.select("doc_id").distinct().collect()}
    assert ids and not ids & set(range(1000, 1008))  # exact copies lose every line
    assert len([i for i in ids if i < 1000]) >= 55  # clean documents stay


def test_library_stands_without_the_package(tmp_path):
    for p in ("sluice", "__spark_entry__.py"):
        src, dst = os.path.join(ROOT, p), tmp_path / p
        shutil.copytree(src, dst, ignore=shutil.ignore_patterns("llm", "__pycache__")) if os.path.isdir(src) else shutil.copy(src, dst)
    code = "import __spark_entry__ as E; q = E.queries(); print(len(q), len(E.oracle_sql()), any(n.startswith('op') or n == 'pipeline' for n in q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    n, m, there = done.stdout.split()
    assert int(n) == int(m) >= 116 and there == "False", done.stderr

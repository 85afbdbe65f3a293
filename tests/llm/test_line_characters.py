"""Operator 7 in characters: lines of any script against brute force."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_near import edits

from sluice.llm import lines, queries

SCRIPTS = ["日本語文字列処理重複行検出", "абвгдежзиклмнопр", "नमसतकगचजटडपबर", "กขคงจฉชซฌญ", "😀😁😂🤣😃😄", "abcdé à"]


def near(a, b):
    return abs(len(a) - len(b)) <= lines.EDITS and edits(a, b) <= lines.EDITS


def changed(rnd, line, script, n):
    out = list(line)
    for _ in range(n):
        k, at = rnd.randrange(3), rnd.randrange(len(out))
        out[at : at + (k != 1)] = [] if k == 0 else [rnd.choice(script)]
    return "".join(out)


def line_rows():
    rnd, rows = random.Random(4), []
    for script in SCRIPTS:
        for _ in range(4):
            line = "".join(rnd.choice(script) for _ in range(rnd.randint(11, 40)))
            rows += ["\n".join(changed(rnd, line, script, rnd.randint(0, 4)) for _ in range(3)) for _ in range(3)]
    return list(enumerate(rows))


@pytest.mark.parametrize("limit", [1, 2, 3])
def test_edit_distance_of_characters(spark, limit):
    rnd, pairs = random.Random(limit), []
    while len(pairs) < 200:
        script = rnd.choice(SCRIPTS)
        a = "".join(rnd.choice(script) for _ in range(rnd.randint(limit + 2, 14)))
        a, b = sorted((a, changed(rnd, a, script, rnd.randint(0, min(limit + 2, len(a) - 1)))), key=len, reverse=True)
        if b and len(a) - len(b) <= limit:
            pairs.append((a, b))
    found = spark.createDataFrame(pairs, "a string, b string").select("a", "b", lines.within_edits(F.col("a"), F.col("b"), limit, "characters").alias("near")).collect()
    assert [r["near"] for r in found] == [edits(r["a"], r["b"]) <= limit for r in found]


def test_query_and_pipeline_equal_brute_force(spark, tmp_dir):
    rows = line_rows()
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    first, fit = {}, {}
    for d, t in rows:
        for n, line in enumerate(t.split("\n")):
            if line.strip():
                first.setdefault(line, (d, n))
    fit = [x for x in first if len(x.encode()) >= lines.LEAST]
    late = {a for a in fit for b in fit if first[b] < first[a] and near(a, b)}
    in_bytes = {a for a in fit for b in fit if first[b] < first[a] and edits(a.encode(), b.encode()) <= lines.EDITS}
    assert in_bytes < late  # nothing that linked by bytes is lost
    gone = {d: [n for n, x in enumerate(t.split("\n")) if x.strip() and (first[x] != (d, n) or x in late)] for d, t in rows}
    got = queries.REGISTRY["op7_line_dedup"][0](spark, tmp_dir).collect()
    assert {r["doc_id"]: r["removed"] for r in got} == {d: ",".join(map(str, x)) for d, x in gone.items()}
    kept = corpus_pipeline.line_dedup(spark, spark.read.parquet(f"{tmp_dir}/documents.parquet"), tmp_dir).collect()
    left = {d: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[d]) for d, t in rows}
    assert {r["doc_id"]: r["text"] for r in kept} == {d: t for d, t in left.items() if t.strip()}

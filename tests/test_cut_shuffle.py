"""What a running aggregate over a large key writes and shuffles: each row
once, with its key once."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from sluice.operators import rolling


def test_a_cut_scan_shuffles_each_row_once(spark, monkeypatch):
    names, keep = [], rolling.written
    monkeypatch.setattr(rolling, "written", lambda df, name: names.append(name) or keep(df, name))
    word = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit("the")).otherwise(F.concat(F.lit("w"), F.col("id") % 701))
    d = spark.range(6_000).select("id", (F.col("id") * 7919 % 6_000).alias("at"), word.alias("word"))
    got = rolling.running_aggregate(d, ["word"], "at", [("cnt", "count", F.lit(1))], 100, ["id"]).select("id", "word", "cnt")
    w = Window.partitionBy("word").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = d.select("id", F.coalesce("word", F.lit("-")).alias("word"), F.count(F.lit(1)).over(w).alias("cnt"))
    assert rows(got.withColumn("word", F.coalesce("word", F.lit("-")))) == rows(want)
    assert sorted(names) == ["bounds", "large-keys"]  # no table of the rows
    dealt = [x for x in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "RepartitionByExpression" in x]
    assert len(dealt) == 1


def test_bounds_hold_whole_keys_together(spark):
    """Rows of keys without a bound have block 0; each bound parts one key."""
    d = spark.range(5_000).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    cut = rolling.find_cut(d, ["k"], "id", (), 200)
    n, key = rolling.null_free_keys(d, ["k"])
    found = rolling._numbered(n, key, "blk", "id", (), cut).groupBy("k").agg(F.min("blk").alias("a"), F.countDistinct("blk").alias("n"), F.max("blk").alias("z")).collect()
    cut_keys = {r["k"] for r in found if r["z"] > 0}
    assert cut_keys == {0} and all(r["n"] == 1 for r in found if r["k"] != 0)
    (whole,) = [r for r in found if r["k"] == 0]
    assert whole["a"] > 0 and 8 <= whole["n"] <= 20

"""Projections, filters, flat-maps, user functions (P01-P15), splits
(SP01-SP03), print labels (K07) and partitioning (R01-R04, R06)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice import model
from sluice.functions.text import as_text
from sluice.operators import basic, partition, split, udf
from sluice.plans import P, query
from sluice.plans.sql import SENSOR, with_views

S = with_views(SENSOR)


def _sensor(spark, sf):
    return model.sensor_view(spark, sf).select("seq", "id", "ts", "vc", "event_type")


def user_map(df):
    """P02 a named, reusable map: record -> its id."""
    return df.select("seq", "id")


@query("p01_map_project", S + "SELECT seq, id FROM sensor")
def p01(spark, sf):
    return basic.map_project(_sensor(spark, sf), "seq", "id")


@query("p02_map_named_fn", S + "SELECT seq, id FROM sensor")
def p02(spark, sf):
    return basic.map_named(_sensor(spark, sf), user_map)


@query("p03_map_add_one", S + "SELECT seq, vc + 1 AS vc FROM sensor")
def p03(spark, sf):
    return _sensor(spark, sf).select("seq", basic.add_one("vc"))


@query("p04_rich_map_lifecycle", S + "SELECT seq, vc + 1 AS vc FROM sensor")
def p04(spark, sf):
    return basic.rich_map(_sensor(spark, sf).select("seq", "vc"), basic.AddOneMap, "seq long, vc int")


@query("p05_filter_equals", S + f"SELECT seq, id, ts, vc FROM sensor WHERE id = {P.SENSOR_1}")
def p05(spark, sf):
    return basic.filter_equals(_sensor(spark, sf), "id", P.SENSOR_1).select("seq", "id", "ts", "vc")


@query(
    "p06_filter_lambda",
    S + f"SELECT seq, CAST(id AS VARCHAR) AS id, ts, vc FROM sensor WHERE CAST(id AS VARCHAR) = '{P.SENSOR_1}'",
)
def p06(spark, sf):
    # constant first: a null id is dropped; the stored type is compared, so
    # the filter reaches the scan
    d = _sensor(spark, sf)
    d = d.filter(lambda_pred(P.SENSOR_1, d.schema["id"].dataType))
    return d.select("seq", F.col("id").cast("string").alias("id"), "ts", "vc")


def lambda_pred(value, kind):
    return F.lit(value).cast(kind) == F.col("id")


@query("p07_filter_param", S + f"SELECT seq, id, ts, vc FROM sensor WHERE id = {P.SENSOR_2}")
def p07(spark, sf):
    return _sensor(spark, sf).select("seq", "id", "ts", "vc").transform(basic.filter_param(P.SENSOR_2))


@query("p08_filter_threshold", S + f"SELECT seq, id, ts, vc FROM sensor WHERE vc > {P.SIDE_ALERT}")
def p08(spark, sf):
    return basic.filter_threshold(_sensor(spark, sf), "vc", P.SIDE_ALERT).select("seq", "id", "ts", "vc")


@query(
    "p09_filter_parity",
    S
    + "SELECT seq, vc, CASE WHEN vc % 2 = 0 THEN 'even' WHEN vc % 2 = 1 THEN 'odd' END AS side FROM sensor "
    "WHERE vc % 2 IN (0, 1)",
)
def p09(spark, sf):
    d = _sensor(spark, sf).select("seq", "vc", basic.parity("vc").alias("side"))
    return d.filter(F.col("side").isNotNull())


_P10_SQL = S + (
    f"SELECT seq, 0 AS pos, CAST(vc AS VARCHAR) AS value FROM sensor WHERE id = {P.SENSOR_1} "
    f"UNION ALL SELECT seq, 0 AS pos, CAST(ts AS VARCHAR) AS value FROM sensor WHERE id = {P.SENSOR_2} "
    f"UNION ALL SELECT seq, 1 AS pos, CAST(vc AS VARCHAR) AS value FROM sensor WHERE id = {P.SENSOR_2}"
)


@query("p10_flatmap_conditional", _P10_SQL)
def p10(spark, sf):
    return basic.flatmap_conditional(_sensor(spark, sf), P.SENSOR_1, P.SENSOR_2)


@query(
    "p13_process_fn",
    S
    + "SELECT seq, 'main' AS route, concat_ws(',', id, ts, vc) AS payload FROM sensor "
    + f"UNION ALL SELECT seq, 'alert' AS route, concat('vc=', vc, ' > {P.SIDE_ALERT}') AS payload FROM sensor "
    + f"WHERE vc > {P.SIDE_ALERT}",
)
def p13(spark, sf):
    d = _sensor(spark, sf)
    main = F.struct(F.lit("main").alias("route"), F.concat_ws(",", as_text("id"), as_text("ts"), as_text("vc")).alias("payload"))
    alert = F.when(
        F.col("vc") > P.SIDE_ALERT,
        F.struct(F.lit("alert").alias("route"), F.concat(F.lit("vc="), as_text("vc"), F.lit(f" > {P.SIDE_ALERT}")).alias("payload")),
    )
    outs = F.filter(F.array(main, alert), lambda x: x.isNotNull())
    return basic.process_rows(d.select("seq", "id", "ts", "vc"), outs).select("seq", "route", "payload")


@query("p14_udtf_expand", _P10_SQL)
def p14(spark, sf):
    return udf.udtf_expand(_sensor(spark, sf), P.SENSOR_1, P.SENSOR_2)


@query("p15_udaf_custom", S + "SELECT id, round(avg(vc), 6) AS result FROM sensor GROUP BY id")
def p15(spark, sf):
    r = udf.custom_aggregate(_sensor(spark, sf), ["id"], "vc")
    return r.select("id", F.round("result", 6).alias("result"))


# ------------------------------------------------------------ splits

@query("sp01_split_filter_even", S + "SELECT seq, vc FROM sensor WHERE vc % 2 = 0")
def sp01_even(spark, sf):
    even, _odd = split.split_filter(_sensor(spark, sf).select("seq", "vc"), F.col("vc") % 2 == 0, F.col("vc") % 2 == 1)
    return even


@query("sp01_split_filter_odd", S + "SELECT seq, vc FROM sensor WHERE vc % 2 = 1")
def sp01_odd(spark, sf):
    _even, odd = split.split_filter(_sensor(spark, sf).select("seq", "vc"), F.col("vc") % 2 == 0, F.col("vc") % 2 == 1)
    return odd


@query(
    "sp02_split_tag",
    S
    + "SELECT seq, CASE WHEN event_type = 'click' THEN 'tag1' WHEN event_type = 'view' THEN 'tag2' "
    "ELSE 'main' END AS route FROM sensor",
)
def sp02(spark, sf):
    d = split.route(
        _sensor(spark, sf),
        [(F.lit("click") == F.col("event_type"), "tag1"), (F.lit("view") == F.col("event_type"), "tag2")],
    )
    return d.select("seq", "route")


def _alert_msg():
    return F.concat(F.lit("vc="), as_text("vc"), F.lit(f" > {P.SIDE_ALERT}"))


@query("sp03_side_alert_main", S + "SELECT seq, id, ts, vc FROM sensor")
def sp03_main(spark, sf):
    main, _side = split.side_alert(_sensor(spark, sf).select("seq", "id", "ts", "vc"), F.col("vc") > P.SIDE_ALERT, _alert_msg())
    return main


@query(
    "sp03_side_alert_side",
    S + f"SELECT seq, concat('vc=', vc, ' > {P.SIDE_ALERT}') AS alert FROM sensor WHERE vc > {P.SIDE_ALERT}",
)
def sp03_side(spark, sf):
    _main, side = split.side_alert(_sensor(spark, sf).select("seq", "id", "ts", "vc"), F.col("vc") > P.SIDE_ALERT, _alert_msg())
    return side


@query("k07_sink_print", S + "SELECT 'main' AS label, seq, id, ts, vc FROM sensor")
def k07(spark, sf):
    return split.labelled(_sensor(spark, sf).select("seq", "id", "ts", "vc"), "main")


# ------------------------------------------------------------ partitioning

@query(
    "r01_part_custom",
    S + f"SELECT seq, id, CAST(((id % {P.PARTITIONS}) + {P.PARTITIONS}) % {P.PARTITIONS} AS INTEGER) AS pid FROM sensor",
)
def r01(spark, sf):
    d = partition.partition_custom(_sensor(spark, sf).select("seq", "id"), "id", P.PARTITIONS)
    return partition.with_partition_id(d)


@query("r02_part_shuffle", S + "SELECT seq, id, vc FROM sensor")
def r02(spark, sf):
    return partition.partition_shuffle(_sensor(spark, sf).select("seq", "id", "vc"), P.PARTITIONS)


@query("r03_part_rebalance", S + "SELECT seq, id, vc FROM sensor")
def r03(spark, sf):
    return partition.partition_rebalance(_sensor(spark, sf).select("seq", "id", "vc"), P.PARTITIONS)


@query(
    "r04_part_broadcast",
    S + f"SELECT seq, CAST(c AS INTEGER) AS copy, CAST(c AS INTEGER) AS pid FROM sensor, unnest(range(0, {P.PARTITIONS})) AS r(c)",
)
def r04(spark, sf):
    d = partition.partition_broadcast(_sensor(spark, sf).select("seq"), P.PARTITIONS)
    return partition.with_partition_id(d)


@query(
    "r06_key_by",
    S + "SELECT id, count(*) AS cnt, CAST(1 AS BIGINT) AS n_partitions FROM sensor GROUP BY id",
)
def r06(spark, sf):
    d = partition.with_partition_id(partition.key_by(_sensor(spark, sf).select("id"), "id", n=P.PARTITIONS))
    return d.groupBy("id").agg(F.count(F.lit(1)).alias("cnt"), F.count_distinct("pid").alias("n_partitions"))

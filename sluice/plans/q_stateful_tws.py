"""The keyed state operators run through ``transformWithStateInPandas``
(the streaming implementation, executed here in one batch pass).  Same
results as the SQL forms; the oracle text is shared."""

from __future__ import annotations

from sluice import model
from sluice.plans import P, REGISTRY, query
from sluice.streaming import processors as PR


def _sql(name: str) -> str:
    return REGISTRY[name][1]


def _sensor(spark, sf):
    return model.sensor_view(spark, sf).select("seq", "id", "vc")


@query("st01_state_value_jump_tws", _sql("st01_state_value_jump"))
def st01_tws(spark, sf):
    return PR.apply_processor(_sensor(spark, sf), "id", PR.ValueJump(P.JUMP))


@query("st02_state_list_top3_tws", _sql("st02_state_list_top3"))
def st02_tws(spark, sf):
    return PR.apply_processor(_sensor(spark, sf), "id", PR.TopK(3))


@query("st03_state_map_counts_tws", _sql("st03_state_map_counts"))
def st03_tws(spark, sf):
    return PR.apply_processor(_sensor(spark, sf), "id", PR.ValueCounts())


@query("st04_state_reducing_sum_tws", _sql("st04_state_reducing_sum"))
def st04_tws(spark, sf):
    return PR.apply_processor(_sensor(spark, sf), "id", PR.RunningSum())


@query("st05_state_aggregating_avg_tws", _sql("st05_state_aggregating_avg"))
def st05_tws(spark, sf):
    return PR.apply_processor(_sensor(spark, sf), "id", PR.RunningAvg())


@query("w07_win_count_tumbling_tws", _sql("w07_win_count_tumbling"))
def w07_tws(spark, sf):
    return PR.apply_processor(_sensor(spark, sf), "id", PR.CountWindow(P.COUNT_SIZE))

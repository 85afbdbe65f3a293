"""Splitting one input into several outputs (SP01-SP03, K07 labels).

Spark has no side-output channel; a split is one *route* column computed in
one pass, and each output a filter on it.  Callers writing several outputs
persist (or ``foreachBatch``) the routed frame once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_filter(df: DataFrame, *predicates: Column) -> tuple[DataFrame, ...]:
    """SP01: one output per predicate (a row may land in several or none)."""
    return tuple(df.filter(p) for p in predicates)


def route(df: DataFrame, rules: list[tuple[Column, str]], default: str = "main", name: str = "route") -> DataFrame:
    """SP02: first matching rule's tag, else ``default``."""
    expr = None
    for cond, tag in rules:
        expr = F.when(cond, tag) if expr is None else expr.when(cond, tag)
    expr = F.lit(default) if expr is None else expr.otherwise(default)
    return df.withColumn(name, expr)


def side_alert(df: DataFrame, cond: Column, message: Column) -> tuple[DataFrame, DataFrame]:
    """SP03: main output = every row; side output = a message per row
    matching ``cond``."""
    return df, df.filter(cond).select(*[c for c in ("seq",) if c in df.columns], message.alias("alert"))


def labelled(df: DataFrame, label: str) -> DataFrame:
    """K07 print sink with a label: the labelled frame (``format('console')``
    only in tests)."""
    return df.select(F.lit(label).alias("label"), *df.columns)

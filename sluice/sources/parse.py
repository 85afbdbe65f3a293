"""Comma-separated text -> typed rows.

The reference throws on a malformed line and kills the job.  Here the
lenient parsers keep going: good rows in one frame, the raw rejected lines in
another.  ``strict=True`` uses the ANSI ``cast`` so a bad line fails the job.
A number is accepted exactly when Java's ``Integer/Long.parseInt`` would:
an optional sign and digits, no blanks, in range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INT_TEXT = r"^[+-]?[0-9]+$"


def parse_number(text: Column, kind: str = "int", strict: bool = False) -> Column:
    """F02 text to number: null when malformed, or a failure when ``strict``.
    Blanks around the digits are malformed (a cast alone would trim them)."""
    if strict:
        number = text.try_cast(kind)
        refused = F.raise_error(F.concat(F.lit("not a number: "), text)).cast(kind)
        return F.when(text.isNull(), F.lit(None).cast(kind)).when(text.rlike(_INT_TEXT) & number.isNotNull(), number).otherwise(refused)
    return F.when(text.rlike(_INT_TEXT), text.try_cast(kind))


def _fields(line: str, n: int) -> tuple[Column, list[Column]]:
    parts = F.split(F.col(line), ",", -1)
    return F.size(parts), [F.get(parts, F.lit(i)) for i in range(n)]


def _split_good_bad(df: DataFrame, line: str, typed: list[tuple[str, Column]], n: int):
    size, _ = _fields(line, n)
    ok = size == n
    for _, c in typed:
        ok = ok & c.isNotNull()
    flagged = df.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    good = flagged.filter("_ok").select(*[c for c in df.columns if c != line], *[c.alias(name) for name, c in typed])
    bad = flagged.filter(~F.col("_ok")).drop("_ok")
    return good, bad


def parse_sensor_csv(df: DataFrame, line: str = "line", strict: bool = False):
    """``id,ts,vc`` -> (id STRING, ts BIGINT, vc INT); returns (good, rejects)."""
    _, (f_id, f_ts, f_vc) = _fields(line, 3)
    typed = [
        ("id", f_id),
        ("ts", parse_number(f_ts, "bigint", strict)),
        ("vc", parse_number(f_vc, "int", strict)),
    ]
    return _split_good_bad(df, line, typed, 3)


def parse_pair_csv(df: DataFrame, line: str = "line", strict: bool = False):
    """``k,t`` -> (k STRING, t INT)."""
    _, (k, t) = _fields(line, 2)
    return _split_good_bad(df, line, [("k", k), ("t", parse_number(t, "int", strict))], 2)


def parse_triple_csv(df: DataFrame, line: str = "line", strict: bool = False):
    """``k,t,v`` -> (k STRING, t INT, v INT)."""
    _, (k, t, v) = _fields(line, 3)
    typed = [("k", k), ("t", parse_number(t, "int", strict)), ("v", parse_number(v, "int", strict))]
    return _split_good_bad(df, line, typed, 3)


def parse_int_line(df: DataFrame, line: str = "line", strict: bool = False) -> DataFrame:
    """One integer per line (null when malformed, or fail when strict)."""
    return df.withColumn("n", parse_number(F.col(line), "int", strict))

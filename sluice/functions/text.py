"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_text(col) -> Column:
    """F03/F04 value -> text the way Java string concatenation prints it
    (``null`` for a missing value)."""
    return F.coalesce(_c(col).cast("string"), F.lit("null"))


def csv_line(*cols) -> Column:
    """``a,b,c`` from columns (every field as text, ``null`` kept as text)."""
    return F.concat_ws(",", *[as_text(c) for c in cols])


def sensor_text(id_col="id", ts_col="ts", vc_col="vc") -> Column:
    """F03 the sensor record's text form."""
    return F.concat(
        F.lit("WaterSensor{id='"), as_text(id_col), F.lit("', ts="), as_text(ts_col),
        F.lit(", vc="), as_text(vc_col), F.lit("}"),
    )


def field(line, i: int) -> Column:
    """F01 the i-th (0-based) comma field; null on a shorter line."""
    return F.get(F.split(_c(line), ",", -1), F.lit(i))


def utf8_hex(col) -> Column:
    """F12 text -> UTF-8 bytes, shown as hex."""
    return F.hex(F.encode(_c(col), "UTF-8"))

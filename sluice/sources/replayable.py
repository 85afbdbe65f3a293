"""S06 a replayable line source over a table: a Python streaming data source
with offsets and admission control.

``write_log`` puts a table's lines into segments in arrival order: the offset
of a line is its place, counted by the skew-safe running count, and a segment
holds ``rows_per_segment`` consecutive offsets.  The source serves offsets
``[start, end)``; a task reads a slice of one segment.  At most
``rowsPerBatch`` lines are admitted to a micro-batch.  Any range can be read
again at any time, so a query resumes at the offset of its checkpoint.

Use: ``spark.dataSource.register(LineLog)``, then
``readStream.format("line_log").option("path", ...).load()``, with
``rowsPerBatch`` and ``checkpoint`` (the query's) for admission control; rows
are ``offset long, line string``.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from sluice.operators.rolling import running_aggregate

SEGMENT = 100_000


def write_log(df: DataFrame, line: Column, order: str, tiebreak: Sequence[str], path: str, rows_per_segment: int = SEGMENT) -> int:
    """Write the log of ``df``'s lines in ``order``; the number of lines."""
    numbered = running_aggregate(df.withColumn("_line", line), [], order, [("_n", "count", F.lit(1))], tiebreak=tiebreak)
    rows = numbered.select((F.col("_n") - 1).alias("offset"), F.col("_line").alias("line"))
    rows = rows.withColumn("segment", F.floor(F.col("offset") / rows_per_segment))
    rows.repartition("segment").sortWithinPartitions("segment", "offset").write.mode("overwrite").partitionBy("segment").parquet(f"{path}/segments")
    total = df.sparkSession.read.parquet(f"{path}/segments").count()
    about = df.sparkSession.createDataFrame([(total, rows_per_segment)], "rows long, rows_per_segment long")
    about.coalesce(1).write.mode("overwrite").json(f"{path}/about")
    return total


def _located(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


def _about(path: str) -> dict:
    from pyarrow import fs

    system, at = _located(path)
    for f in system.get_file_info(fs.FileSelector(f"{at}/about")):
        if f.path.endswith(".json") and f.size:
            with system.open_input_stream(f.path) as s:
                return json.loads(s.read())
    raise FileNotFoundError(f"no log under {path}")


@dataclass
class Slice(InputPartition):
    segment: int
    start: int
    end: int


def last_planned(checkpoint: str, source: int = 0) -> int | None:
    """The end offset of the last batch that a query planned, from its
    checkpoint; none if it has not planned any."""
    from pyarrow import fs

    system, at = _located(checkpoint)
    if system.get_file_info(f"{at}/offsets").type == fs.FileType.NotFound:
        return None
    batches = [int(f.base_name) for f in system.get_file_info(fs.FileSelector(f"{at}/offsets")) if f.base_name.isdigit()]
    if not batches:
        return None
    with system.open_input_stream(f"{at}/offsets/{max(batches)}") as s:
        return json.loads(s.read().decode().split("\n")[2 + source])["offset"]


class LineLogReader(DataSourceStreamReader):
    """``rows_per_batch`` needs the query's ``checkpoint``: a started query
    tells a source where it goes on only when it has asked how far to go.
    Without it, each batch gets all there is."""

    def __init__(self, path: str, rows_per_batch: int | None, checkpoint: str | None):
        self.path, self.rows_per_batch = path, rows_per_batch
        about = _about(path)
        self.total, self.segment = about["rows"], about["rows_per_segment"]
        if rows_per_batch and not checkpoint:
            raise ValueError("rowsPerBatch needs the checkpoint of the query")
        self.admitted = (last_planned(checkpoint) if checkpoint else None) or 0

    def initialOffset(self) -> dict:
        return {"offset": 0}

    def latestOffset(self) -> dict:
        more = self.rows_per_batch or self.total
        return {"offset": max(self.admitted, min(self.total, self.admitted + more))}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        a, z = start["offset"], end["offset"]
        self.admitted = max(self.admitted, z)
        first, last = a // self.segment, (z - 1) // self.segment
        return [Slice(s, max(a, s * self.segment), min(z, (s + 1) * self.segment)) for s in range(first, last + 1)] if z > a else []

    def commit(self, end: dict) -> None:
        self.admitted = max(self.admitted, end["offset"])

    def read(self, partition: Slice):
        import pyarrow.dataset as ds

        system, at = _located(self.path)
        inside = (ds.field("offset") >= partition.start) & (ds.field("offset") < partition.end)
        rows = ds.dataset(f"{at}/segments/segment={partition.segment}", filesystem=system, format="parquet")
        yield from rows.to_batches(columns=["offset", "line"], filter=inside)


class LineLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "line_log"

    def schema(self) -> str:
        return "offset long, line string"

    def streamReader(self, schema) -> LineLogReader:
        rows = self.options.get("rowsPerBatch")
        return LineLogReader(self.options["path"], int(rows) if rows else None, self.options.get("checkpoint"))

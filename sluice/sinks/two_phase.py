"""K06 exactly-once files by a two-phase stream writer.

Tasks write their rows to files that nobody reads yet.  The commit of a batch
is one small file that names them: it is written under another name and then
renamed, so it is there whole or not at all.  A commit for a batch id that has
one already (the batch ran again after it had committed) changes nothing and
drops the new files; an aborted batch drops its files; files of a task that was
killed are named by no commit and never read.

Use: ``spark.dataSource.register(TwoPhaseText)``, then
``writeStream.format("two_phase_text").option("path", ...)``; read with
``committed(spark, path)``.  The frame written has one string column.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage


def _located(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote."""

    files: list[str] = field(default_factory=list)
    rows: int = 0


class TwoPhaseTextWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator) -> Written:
        system, path = _located(self.path)
        out, name, rows = None, f"data/{uuid.uuid4().hex}.txt", 0
        try:
            for batch in iterator:
                if out is None:
                    system.create_dir(f"{path}/data", recursive=True)
                    out = system.open_output_stream(f"{path}/{name}")
                lines = [x or "" for x in batch.column(0).to_pylist()]
                out.write("".join(x + "\n" for x in lines).encode())
                rows += len(lines)
        finally:
            if out is not None:
                out.close()
        return Written([name] if out is not None else [], rows)

    def _drop(self, messages) -> None:
        system, path = _located(self.path)
        for m in messages:
            for f in m.files if m else []:
                system.delete_file(f"{path}/{f}")

    def commit(self, messages, batchId: int) -> None:
        from pyarrow import fs

        system, path = _located(self.path)
        mark = f"{path}/commits/{batchId}.json"
        if system.get_file_info(mark).type != fs.FileType.NotFound:
            self._drop(messages)
            return
        system.create_dir(f"{path}/commits", recursive=True)
        staged = f"{path}/commits/_{batchId}-{uuid.uuid4().hex}"
        with system.open_output_stream(staged) as out:
            done = [m for m in messages if m]
            out.write(json.dumps({"batch_id": batchId, "rows": sum(m.rows for m in done), "files": [f for m in done for f in m.files]}).encode())
        system.move(staged, mark)

    def abort(self, messages, batchId: int) -> None:
        self._drop(messages)


class TwoPhaseText(DataSource):
    @classmethod
    def name(cls) -> str:
        return "two_phase_text"

    def streamWriter(self, schema, overwrite: bool) -> TwoPhaseTextWriter:
        if len(schema.fields) != 1 or schema.fields[0].dataType.typeName() != "string":
            raise ValueError("two_phase_text writes one string column")
        return TwoPhaseTextWriter(self.options["path"])


def committed(spark: SparkSession, path: str) -> DataFrame:
    """``value, batch_id`` of all committed lines.  The commits are a table of
    Spark's, joined to the files' names."""
    system, at = _located(path)
    from pyarrow import fs

    none = spark.createDataFrame([], "value string, batch_id long")
    if system.get_file_info(f"{at}/commits").type == fs.FileType.NotFound:
        return none
    marks = spark.read.option("pathGlobFilter", "*.json").schema("batch_id long, files array<string>").json(f"{path}/commits")
    named = marks.select("batch_id", F.explode("files").alias("file")).select("batch_id", F.substring_index("file", "/", -1).alias("file"))
    if system.get_file_info(f"{at}/data").type == fs.FileType.NotFound:
        return none
    lines = spark.read.text(f"{path}/data").select("value", F.col("_metadata.file_name").alias("file"))
    return lines.join(named, "file").select("value", "batch_id")

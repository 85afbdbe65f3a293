"""Operator 8: token sequences in Arrow files with fixed-size-list batches.

A data set is a folder of Arrow stream files with footers (the IPC file
format).  Documents are in ascending id order within a file and from file to
file; their ids, each closed by the end id, are cut into sequences of equal
length.  Every record batch but a file's last has the same number of
sequences, so sequence ``i`` of a file is row ``i % ROWS`` of batch
``i // ROWS``: with a memory-mapped file its ids (an array) and its mask (a
bitmap, as Arrow keeps booleans) are views, not copies.

Columns: ``ids`` fixed_size_list<uint16 or uint32>, ``mask`` (token or
padding) and ``ends`` (last token of a document) fixed_size_list<bool>,
``docs`` (ids of the documents that end in the sequence).

The frame that ``write`` returns, one row a file, is the data set's manifest.
A file is written under a name of its own and counts only if the manifest
names it, so a repeated or lost task leaves no doubt.

Defined results: null text is the end id alone; null ids come first; repeated
rows are written each; an empty table gives an empty manifest; other columns
are left out.  The ``uint16`` form is taken when the vocabulary allows it.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import fresh_path, map_batches, materialize, text_rows
from sluice.llm.subwords import ids_of

SEQUENCE = 2048
ROWS = 64
END_ID = 2


def file_schema(length: int, wide: bool) -> pa.Schema:
    return pa.schema(
        [
            ("ids", pa.list_(pa.uint32() if wide else pa.uint16(), length)),
            ("mask", pa.list_(pa.bool_(), length)),
            ("ends", pa.list_(pa.bool_(), length)),
            ("docs", pa.list_(pa.int64())),
        ]
    )


def _file_batch(ids: np.ndarray, ends: np.ndarray, docs: list, schema: pa.Schema) -> pa.RecordBatch:
    """One record batch; a last sequence that is not full is padded with 0."""
    length, kind = schema.field("ids").type.list_size, schema.field("ids").type.value_type
    n = -(-len(ids) // length)
    pad = n * length - len(ids)
    mask = np.concatenate([np.ones(len(ids), bool), np.zeros(pad, bool)])
    flat, ends = np.concatenate([ids, np.zeros(pad, ids.dtype)]), np.concatenate([ends, np.zeros(pad, bool)])
    per_row = ends.reshape(n, length).sum(axis=1)
    fixed = lambda values, t: pa.FixedSizeListArray.from_arrays(pa.array(values, t), length)
    offsets = pa.array(np.concatenate([[0], np.cumsum(per_row)]), pa.int32())
    return pa.RecordBatch.from_arrays(
        [fixed(flat, kind), fixed(mask, pa.bool_()), fixed(ends, pa.bool_()), pa.ListArray.from_arrays(offsets, pa.array(docs, pa.int64()))], schema=schema
    )


def _write_file(rows: Iterator[tuple], uri: str, schema: pa.Schema) -> tuple[int, int, int]:
    """Write ``(doc_id, uint32 id bytes)`` rows; documents, tokens, sequences."""
    length = schema.field("ids").type.list_size
    dtype = schema.field("ids").type.value_type.to_pandas_dtype()
    system, path = _located(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    full = length * ROWS
    held, held_ends, held_docs, size = [], [], [], 0  # held_docs: (doc, tokens before its end in what is held)
    n_docs = n_tokens = n_sequences = 0
    with system.open_output_stream(path) as sink, pa.ipc.new_file(sink, schema) as out:

        def flush(last: bool):
            nonlocal held, held_ends, held_docs, size, n_sequences
            ids, ends = np.concatenate(held), np.concatenate(held_ends)
            at = 0
            docs, marks = held_docs, np.flatnonzero(ends)
            while size - at >= full or last and at < size:
                to = min(at + full, size)
                k, m = np.searchsorted(marks, [at, to])
                out.write_batch(_file_batch(ids[at:to], ends[at:to], docs[k:m], schema))
                n_sequences += -(-(to - at) // length)
                at = to
            held, held_ends, held_docs, size = [ids[at:]], [ends[at:]], docs[np.searchsorted(marks, at) :], size - at

        for doc, raw in rows:
            ids = np.frombuffer(raw, np.uint32).astype(dtype)
            ends = np.zeros(len(ids), bool)
            ends[-1] = True
            held.append(ids)
            held_ends.append(ends)
            held_docs.append(doc)
            size += len(ids)
            n_docs, n_tokens = n_docs + 1, n_tokens + len(ids)
            if size >= 8 * full:
                flush(False)
        if size:
            flush(True)
    return n_docs, n_tokens, n_sequences


def write(df: DataFrame, tokenizer_path: str, end_id: int = END_ID, length: int = SEQUENCE, path: str | None = None, added: bool = False) -> DataFrame:
    """Write the data set; its manifest ``file_no, path, n_docs, n_tokens,
    n_sequences, start`` (``start``: tokens of all files before); ``added`` as in
    ``subwords``."""
    path = path or fresh_path(df.sparkSession, "sequences")
    path = path if "://" in path else f"file://{path}" if path.startswith("/") else path

    def run(batches):
        from pyspark import TaskContext

        ids = ids_of(tokenizer_path, end_id, added)
        schema = file_schema(length, ids.size > 1 << 16)
        rows = (row for b in batches for row in zip(b.column("doc_id").to_pylist(), ids.encode_all(b.column("text"))))
        first = next(rows, None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        uri = f"{path}/part-{part:06d}-{uuid.uuid4().hex[:12]}.arrow"
        from itertools import chain

        counts = _write_file(chain([first], rows), uri, schema)
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (part, uri, *counts)], ["file_no", "path", "n_docs", "n_tokens", "n_sequences"])

    ordered = df.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = materialize(map_batches(ordered, run, "file_no long, path string, n_docs long, n_tokens long, n_sequences long"), "manifest")
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _located(uri: str):
    """The Arrow file system of ``uri`` and the path in it.  Spark's names for
    object stores are read as Arrow's (``s3a``, ``s3n``: ``s3``)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def open_file(uri: str) -> pa.RecordBatchFileReader:
    """A reader whose batches are views where the file system can be mapped."""
    from pyarrow import fs

    system, path = _located(uri)
    return pa.ipc.open_file(pa.memory_map(path) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(path))


def sequence_views(reader: pa.RecordBatchFileReader, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
    """Ids and mask of sequence ``i`` of a file (random access), both views of
    the file's bytes."""
    batch, row = reader.get_batch(i // ROWS), i % ROWS
    return batch.column("ids")[row].values.to_numpy(), batch.column("mask")[row].values


def sequence(reader: pa.RecordBatchFileReader, i: int) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`sequence_views`, with the mask's bits unpacked into an array."""
    ids, mask = sequence_views(reader, i)
    return ids, mask.to_numpy(zero_copy_only=False)


def read_documents(reader: pa.RecordBatchFileReader) -> Iterator[tuple]:
    """``(doc_id, tokens, crc32 of the ids as little-endian uint32)`` of each
    document of a file, batch by batch."""
    crc = tokens = 0
    for k in range(reader.num_record_batches):
        batch = reader.get_batch(k)
        ids = batch.column("ids").flatten().to_numpy().astype("<u4")
        mask = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
        ends = np.flatnonzero(batch.column("ends").flatten().to_numpy(zero_copy_only=False))
        at, used = 0, int(mask.sum())
        for doc, end in zip(batch.column("docs").flatten().to_pylist(), ends.tolist()):
            yield doc, tokens + end + 1 - at, zlib.crc32(ids[at : end + 1].data, crc)
            at, crc, tokens = end + 1, 0, 0
        crc, tokens = zlib.crc32(ids[at:used].data, crc), tokens + used - at


def read(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back
    from the files of a manifest, one task a file."""
    n_files = max(1, manifest.count())

    def run(batches):
        for b in batches:
            for uri, start in text_rows(b, "path", "start"):
                docs = list(zip(*read_documents(open_file(uri))))
                n = np.array(docs[1], np.int64)
                starts = start + np.cumsum(n) - n
                yield pa.RecordBatch.from_arrays([pa.array(docs[0], pa.int64()), pa.array(starts), pa.array(n), pa.array(docs[2], pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = manifest.repartitionByRange(n_files, "file_no").select("path", "start")
    return map_batches(spread, run, "doc_id long, start long, n_tokens long, ids_crc32 long")

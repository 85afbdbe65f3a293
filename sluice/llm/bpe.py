"""Operator 3: byte-level BPE encoding and decoding with a local rank file.

``encode_documents`` runs the tiktoken library over whole texts inside Arrow
batches; each executor process loads the rank file once.  Long texts are cut
before single spaces that stand between two ASCII letters or digits.  No
alternative of the split pattern can span such a place (only a leading blank
is ever joined to what follows), so the pieces have exactly the matches of the
whole text.  ``decode`` joins the raw bytes of the ranks.

Defined results: null text is the empty text (no ids); a null id stays null;
repeated rows are encoded again; an empty table gives no rows; columns other
than id and text are left out.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import map_batches, text_rows

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
#: Texts beyond this many characters are encoded in pieces of about this size.
PIECE_CHARS = 100_000

_SAFE_CUT = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut ``text`` at safe places, each piece ``size`` characters or as many
    more as it takes to reach the next safe place."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE_CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class Codec:
    """A rank file with its split pattern."""

    def __init__(self, rank_path: str, pattern: str):
        import tiktoken

        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self._encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        size = max(ranks.values()) + 1
        self._bytes: list[bytes] = [b""] * size
        for token, rank in ranks.items():
            self._bytes[rank] = token
        self._decimal = [str(i) for i in range(size)]

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        for piece in safe_pieces(text or ""):
            ids += self._encoding.encode_ordinary(piece)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self._bytes.__getitem__, ids))

    def decimal(self, ids: list[int]) -> str:
        return ",".join(map(self._decimal.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(rank_path: str, pattern: str) -> Codec:
    return Codec(rank_path, pattern)


def encode_documents(df: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids array<int>)`` for each row; the id column keeps its name."""
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, ids array<int>"
    id_type = df.schema[id_col].dataType

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        c = codec(rank_path, pattern)
        for b in batches:
            for k, t in text_rows(b, "k", "t"):
                yield pa.RecordBatch.from_arrays([pa.array([k], to_arrow_type(id_type)), pa.array([c.encode(t)], pa.list_(pa.int32()))], [id_col, "ids"])

    return map_batches(df.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")), run, schema)


def decode_documents(df: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, bytes binary)``: the raw bytes of each row's ids."""
    id_type = df.schema[id_col].dataType

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        c = codec(rank_path, pattern)
        for b in batches:
            for k, ids in text_rows(b, "k", "i"):
                yield pa.RecordBatch.from_arrays([pa.array([k], to_arrow_type(id_type)), pa.array([c.decode(ids or [])], pa.binary())], [id_col, "bytes"])

    return map_batches(df.select(F.col(id_col).alias("k"), F.col(ids_col).alias("i")), run, f"`{id_col}` {id_type.simpleString()}, bytes binary")


def round_trip_digests(df: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """Encode each document, decode its ids, and return the digests of both
    (the ids never leave the task): ``doc_id, n_tokens, ids_sha256,
    decoded_sha256, exact``."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean"
    fields = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "exact"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]

    def run(batches):
        c = codec(rank_path, pattern)
        sha = hashlib.sha256
        for b in batches:
            rows = []
            for k, t in text_rows(b, "doc_id", "text"):
                ids = c.encode(t)
                raw = c.decode(ids)
                rows.append((k, len(ids), sha(c.decimal(ids).encode()).hexdigest(), sha(raw).hexdigest(), raw == (t or "").encode()))
            cols = list(zip(*rows)) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, types)], fields)

    return map_batches(df.select("doc_id", "text"), run, schema)

"""Operators 3, 8 and 10 against the libraries on whole texts."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from odd_documents import empty, odd, plain  # noqa: F401
from sluice.llm import bpe, packing, sequence_files
from sluice.llm.subwords import SPLIT, ids_of

JSON = P.path("byte_bpe_50k.json")
RANKS = P.path(bpe.RANK_FILE)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_split_pattern_is_the_public_one():
    assert SPLIT == P.PATTERN


def test_ids_equal_whole_text_encoding(odd, plain, library):
    ids = ids_of(JSON, None)
    for _, t in texts(odd) + texts(plain):
        assert np.frombuffer(ids.encode(t), np.uint32).tolist() == library(t)
    for t in ("a\x1cb", "x\x85y", "  two", "a  \n b\n\n", "'s 'S don't''s", "½Ⅷ²", "ɐ beyond", "é" * 300):
        assert np.frombuffer(ids.encode(t), np.uint32).tolist() == library(t)


def test_round_trip(odd):
    import base64

    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted(
        (str(k), len(i := enc.encode_ordinary(t or "")), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), True)
        for k, t in texts(odd)
    )
    got = bpe.round_trip_digests(odd, RANKS, P.PATTERN).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == want


def test_encode_then_decode_frames(odd):
    ids = bpe.encode_documents(odd, RANKS, P.PATTERN)
    back = bpe.decode_documents(ids, RANKS, P.PATTERN)
    assert sorted((str(r[0]), bytes(r[1])) for r in back.collect()) == sorted((str(k), (t or "").encode()) for k, t in texts(odd))


@pytest.mark.parametrize("size", [1, 7, 50])
def test_safe_pieces_change_nothing(plain, size):
    c = bpe.codec(RANKS, P.PATTERN)
    for _, t in texts(plain)[:20]:
        t += "  x 1 2a  \n b 's it's  end"
        pieces = list(bpe.safe_pieces(t, size))
        assert "".join(pieces) == t
        assert [i for p in pieces for i in c.encode(p)] == c._encoding.encode_ordinary(t)
    assert list(bpe.safe_pieces("z" * 100, 10)) == ["z" * 100]


def test_sequence_files_read_back(odd, library):
    manifest = sequence_files.write(odd, JSON, length=32)
    rows = sequence_files.read(manifest).collect()
    want = sorted(((k if k is not None else -(1 << 63), t or "") for k, t in texts(odd)))
    at, expected = 0, []
    for k, t in want:
        ids = library(t) + [sequence_files.END_ID]
        expected.append((k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = sorted(((r["doc_id"] if r["doc_id"] is not None else -(1 << 63)), r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows)
    assert got == sorted(expected)


def test_sequences_are_views_and_padded(plain, library):
    files = sequence_files.write(plain, JSON, length=32).orderBy("file_no").collect()
    stream = []
    for f in files:
        reader, left = sequence_files.open_file(f["path"]), f["n_tokens"]
        assert reader.schema.field("ids").type.list_size == 32
        for i in range(f["n_sequences"]):
            ids, mask = sequence_files.sequence(reader, i)
            seen, bits = sequence_files.sequence_views(reader, i)
            mapped = [b.address for b in (reader.get_batch(i // sequence_files.ROWS).column(c).values.buffers()[1] for c in ("ids", "mask"))]
            assert seen.base is not None and bits.buffers()[1].address == mapped[1] and mapped[0] <= seen.ctypes.data < mapped[0] + (1 << 30)
            assert bits.to_pylist() == mask.tolist()
            assert not ids.flags.owndata and mask.sum() == min(32, left)
            stream += ids[mask].tolist()
            left -= int(mask.sum())
        assert left == 0
    want = [i for _, t in sorted(texts(plain)) for i in [*library(t), sequence_files.END_ID]]
    assert stream == want


def pieces_of(df):
    from pyspark.sql import functions as F

    return packing.document_pieces(df, JSON, capacity=64).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))


@pytest.mark.parametrize("part_rows", [8, 10_000])
def test_packing_is_whole_gapless_and_tight(odd, library, part_rows):
    rows = packing.pack(pieces_of(odd), 64, part_rows).collect()
    want = []
    for k, t in texts(odd):
        ids = library(t) + [packing.END_ID]
        cuts = packing.cuts(len(ids), 64)
        assert all(n == 64 for _, n in cuts[1:]) and (len(cuts) == 1) == (len(ids) <= 64)
        want += [(str(k), i, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for i, (s, n) in enumerate(cuts)]
    assert sorted((str(r[0]), *r[1:5]) for r in rows) == sorted(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 64
    bound = packing.lower_bound(np.array([w[3] for w in want]), 64)
    assert bound <= len(bins) <= bound + 1


def test_lower_bound_never_exceeds_the_optimum():
    rng = np.random.default_rng(4)
    for _ in range(60):
        cap = int(rng.integers(6, 30))
        lengths = np.sort(rng.integers(1, cap + 1, rng.integers(1, 9)))[::-1]

        def best(i, rooms):
            if i == len(lengths):
                return len(rooms)
            n, tried = int(lengths[i]), set()
            options = [best(i + 1, rooms + [cap - n])]
            for j, r in enumerate(rooms):
                if r >= n and r not in tried:
                    tried.add(r)
                    options.append(best(i + 1, rooms[:j] + [r - n] + rooms[j + 1 :]))
            return min(options)

        assert packing.lower_bound(lengths, cap) <= best(0, [])
    assert packing.lower_bound(np.array([40] * 6), 64) == 6  # by large sizes, beyond the sum
    assert packing.lower_bound(np.zeros(0, np.int64), 64) == 0


def test_empty_tables(empty):
    assert packing.pack(pieces_of(empty), 64).count() == 0
    assert sequence_files.read(sequence_files.write(empty, JSON)).count() == 0
    assert bpe.round_trip_digests(empty, RANKS, P.PATTERN).count() == 0

"""Ids of a column of texts: the library's own, at few calls of the library."""

import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest

from sluice.llm import subwords

JSON = P.path("byte_bpe_50k.json")
END = 2
PLAIN = ["a", "s", "t", "re", "ve", "m", "ll", "d", "'", "'", " ", " ", "  ", "\n", "\t", "\r\n", "1", "23", ".", "!!"]
NARROW = [*PLAIN, "é", "ß", "ɏ", "ª", "²", "¼", "×"]
ODD = [*NARROW, "\x85", "\xa0", "\x1c", "ɐ", "日", "’", "😀", "İ", "<|endoftext|>", "<|"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    return lambda texts: [np.array([*e.ids, END], "<u4").tobytes() for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("group, chunk", [(1, 1), (200, 30), (5000, 5000), (1 << 24, 1 << 20)])
@pytest.mark.parametrize("letters", [["'", "s", "l", "r", "e", " ", "\n"], PLAIN, NARROW, ODD], ids=["marks", "plain", "narrow", "odd"])
def test_columns_equal_the_call(library, monkeypatch, letters, group, chunk):
    monkeypatch.setattr(subwords, "GROUP", group)
    monkeypatch.setattr(subwords, "CHUNK", chunk)
    ids, rnd = subwords.Ids(JSON, END, True), random.Random(group)
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.choice((0, 1, 3, 12, 60)))) for _ in range(2000)]
    texts[::50] = [None] * len(texts[::50])
    for kind in (pa.string(), pa.large_string()):
        assert list(ids.encode_all(pa.array(["x", *texts], kind).slice(1))) == library(texts)


def test_columns_of_every_code_point(library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"n{chr(c)}'s {chr(c)}1! " for c in points[i : i + 64]) for i in range(0, len(points), 64)]
    assert list(subwords.Ids(JSON, END, True).encode_all(pa.array(texts))) == library(texts)


def test_empty_columns():
    ids = subwords.Ids(JSON, END, True)
    assert list(ids.encode_all(pa.array([], pa.string()))) == []
    assert list(ids.encode_all(pa.array([None, "", None], pa.string()))) == [np.array([END], "<u4").tobytes()] * 3


class Counted:
    def __init__(self, of):
        self.of, self.calls = of, 0

    def encode_batch_fast(self, texts, **how):
        self.calls += 1
        return self.of.encode_batch_fast(texts, **how)


def test_distinct_matches_share_calls_and_are_not_remembered(library):
    words = [f"{a}{b}{c}" for a in "kvzx" for b in "aeiouy" for c in ("lor", "mi", "nt", "ps", "qu", "rr")]
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(words) + rnd.choice(words) for _ in range(300)) + (" – 日 ’" if i % 3 else "") for i in range(200)]
    ids = subwords.Ids(JSON, END, True)
    ids._bare = Counted(ids._bare)
    assert list(ids.encode_all(pa.array(texts))) == library(texts)
    distinct = len({m for t in texts for m in ids._narrow(t)})
    assert distinct > 10_000 and ids._bare.calls <= distinct // subwords.TOGETHER + 1 and not ids


def test_files_without_a_free_letter_go_match_by_match(library):
    ids = subwords.Ids(JSON, END, True)
    assert ids._between is not None
    ids._between = None
    texts = ["don't  stop", "é 日本 x", "", "a<|endoftext|>b"]
    assert list(ids.encode_all(pa.array(texts))) == library(texts)

"""Token ids against the library's own call, for every code point; and the
bound on remembered matches."""

import random

import numpy as np
import public_tokenizers as P
import pytest

from sluice.llm import subwords

JSON = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(JSON)


def test_every_code_point(library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"n{chr(c)}'s {chr(c)}1! " for c in points[i : i + 256]) for i in range(0, len(points), 256)]
    ids = subwords.Ids(JSON, None, True)
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids.encode(text), np.uint32).tolist() == want.ids, hex(ord(text[1]))


def test_memory_is_bounded_in_bytes(library, monkeypatch):
    monkeypatch.setattr(subwords, "REMEMBERED", 1 << 20)
    ids, rnd = subwords.Ids(JSON, None, True), random.Random(1)
    for _ in range(40):
        text = "".join(chr(rnd.randrange(0x4E00, 0x9F00)) + rnd.choice(["", "。", " "]) for _ in range(2000)) + "z" * 5000
        assert np.frombuffer(ids.encode(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids
        held = [sum(subwords.ENTRY + 2 * len(k) + len(v) for k, v in d.items()) for d in (ids, ids._before)]
        assert max(held) <= (1 << 20) + 1000 and max(map(len, ids), default=0) <= subwords.LONG


def test_other_kinds_of_files_are_refused(tmp_path):
    import json

    with open(JSON) as f:
        kind = json.load(f)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": kind["pre_tokenizer"] | {"add_prefix_space": True}}, {"pre_tokenizer": kind["pre_tokenizer"] | {"use_regex": False}}, {"pre_tokenizer": None}):
        other = tmp_path / "other.json"
        other.write_text(json.dumps(kind | change))
        with pytest.raises(ValueError):
            subwords.Ids(str(other), None)

"""Token ids of the ``tokenizers`` library, one distinct pre-token at a time.

A byte-level BPE encodes every match of its split pattern on its own, so the
ids of a text are those of its matches in a row.  Invented or natural prose
repeats most of its words: the library encodes each distinct match once per
process, and a text is a join of the remembered ids.  The memory is bounded in
bytes, and long matches are not remembered.

Texts whose characters all lie below U+0250 are split here by the pattern, in
ranges on which it is the library's own; other texts are split by the file's
pre-tokenizer, whose letters and numbers follow another Unicode version than
Python's.

``encode_all`` takes a column of texts.  It cuts the bytes of many texts at a
time with array operations on the kinds of their characters and has Arrow
number the distinct matches; the library encodes each of these once, many in a
call, with a letter between them that no merge of the file knows, so none is
merged with its neighbour.  Nothing of this path is remembered.  What is beyond
these ranges goes to the file's pre-tokenizer from the last blank after an ASCII
letter or digit to the next, where every split ends a match.  Texts with added
tokens or of extreme length go one by one.

With ``added`` the text is cut at the file's added tokens first and these give
their own ids, as ``Tokenizer.encode`` of a plain tokenizer does (the queries
and the pipeline); without it they are text like any other, as with its
``encode_special_tokens``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of remembered matches per process and generation; when full, the
#: memory starts afresh and takes back what it meets again from the last one.
REMEMBERED = 72 << 20
#: Bytes of a remembered match besides its text and ids, about.
ENTRY = 180
#: Matches longer than this are not remembered.
LONG = 64
#: Bytes of texts whose distinct matches are encoded together, and of these
#: texts that are cut at a time.
GROUP, CHUNK = 16 << 20, 2 << 20
#: Matches that go to the library in a call.
TOGETHER = 128

# The split pattern of byte-level BPE files of this family.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The letters and numbers below U+0250, as ranges the standard `re` knows.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBERS = "0-9²³¹¼-¾"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in files of this family: printable
    Latin-1 stands for itself, the rest follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


# Kinds of characters; _ODD: not to be cut by kinds of bytes (white space of
# two bytes, what `re` and the library see differently, U+0250 and beyond).
_WHITE, _LETTER, _NUMBER, _OTHER, _ODD = range(5)


def _kinds() -> np.ndarray:
    """The kind of each code point below U+0800."""
    kinds = np.full(0x800, _ODD, np.uint8)
    for c in range(0x250):
        found = [k for k, s in ((_WHITE, r"\s"), (_LETTER, f"[{_LETTERS}]"), (_NUMBER, f"[{_NUMBERS}]")) if re.match(s, chr(c))]
        kinds[c] = found[0] if found else _OTHER
    kinds[[*range(0x1C, 0x20), 0x85, 0xA0]] = _ODD
    return kinds


_KINDS = _kinds()
_BYTE_KINDS = np.where(np.arange(256) < 0x80, _KINDS[:256], _OTHER).astype(np.uint8)


def _kinds_of(data: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte of UTF-8 text belongs to
    (beyond the second byte of longer ones: any)."""
    kinds, lead = _BYTE_KINDS[data], np.flatnonzero(data >= 0xC0)
    two = _KINDS[(data[lead] & 0x1F).astype(np.int64) << 6 | data[lead + 1] & 0x3F]
    kinds[lead] = kinds[lead + 1] = np.where(data[lead] >= 0xE0, _ODD, two)
    return kinds


def _starts(data: np.ndarray, kinds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the matches of the split pattern begin in texts without odd
    characters; text ``i`` is ``data[at[i]:at[i + 1]]``."""
    first, new = np.zeros(len(data) + 1, bool), np.ones(len(data) + 1, bool)
    first[at] = True
    new[1:-1] = kinds[1:] != kinds[:-1]
    new |= first
    # The last of a run of white space before other text is a match of its own
    # or, if a blank, the beginning of the next.
    cut = np.flatnonzero(new[:-1])
    turn = cut[~first[cut] & (kinds[cut] != _WHITE) & (kinds[cut - 1] == _WHITE)]
    new[turn - 1] = True
    new[turn[data[turn - 1] == 32]] = False
    # 's 't 'm 'd 're 've 'll where a match begins
    mark = np.flatnonzero(data == 39)
    mark = mark[new[mark] & ~first[mark + 1]]
    one, two = data[mark + 1], np.where(first[mark + 2], 0, data[np.minimum(mark + 2, len(data) - 1)])
    size = np.isin(one, [*b"stmd"]) * 1 + (((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)) * 2
    mark, size = mark[size > 0], size[size > 0]
    new[mark + 1] = False
    new[mark + 1 + size] = True
    return np.flatnonzero(new[:-1])


class Ids(dict):
    """match -> little-endian uint32 ids, filled by the library on demand."""

    def __init__(self, path: str, end_id: int | None, added: bool = False):
        super().__init__()
        from tokenizers import Tokenizer

        with open(path) as f:
            kind = json.load(f)
        split, after = kind["pre_tokenizer"] or {}, kind.get("post_processor") or {}
        plain = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
        plain = plain and after.get("type", "ByteLevel") == "ByteLevel" and kind["model"].get("type", "BPE") == "BPE" and not kind["model"].get("dropout")
        if not plain or any(kind.get(k) for k in ("normalizer", "truncation", "padding")):
            raise ValueError(f"{path} is no plain byte-level BPE")
        tokens = {t["content"]: t for t in kind.get("added_tokens", [])} if added else {}
        if any(t[k] for t in tokens.values() for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path} has added tokens that depend on what is beside them")
        tokenizer = Tokenizer.from_file(path)
        self._model = tokenizer.model
        self._model._resize_cache(0)  # this memory stands in for the library's
        self._letters = _byte_letters()
        size = max(kind["model"]["vocab"].values()) + 1
        self._four = [i.to_bytes(4, "little") for i in range(size)]
        self._pieces = tokenizer.pre_tokenizer.pre_tokenize_str
        narrow = SPLIT.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{_LETTERS}{_NUMBERS}]")
        narrow = narrow.replace("'s|'t|'re|'ve|'m|'ll|'d", "'(?:s|t|re|ve|m|ll|d)")
        self._narrow = re.compile(narrow.replace(r"\p{L}", f"[{_LETTERS}]").replace(r"\p{N}", f"[{_NUMBERS}]")).findall
        # `re` also counts U+001C-U+001F as white space; the file's own splitter takes those texts.
        self._beyond = re.compile("[ɐ-\U0010ffff\x1c-\x1f]").search
        self._held = 0
        self._before: dict[str, bytes] = {}  # what was remembered before the last fresh start
        self._end = b"" if end_id is None else end_id.to_bytes(4, "little")
        self._added = {c: t["id"].to_bytes(4, "little") for c, t in tokens.items()}
        # The first token that begins, the longest of those that begin there.
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(tokens, key=len, reverse=True))) + ")").split
        self._marks = re.compile(b"|".join(re.escape(c.encode()) for c in tokens)).finditer
        #: Tokens of the file, added ones included.
        self.size = tokenizer.get_vocab_size()
        # A letter of a byte that UTF-8 has not, and that no merge knows.
        model = kind["model"]
        merged = {c for m in model["merges"] for c in (m if isinstance(m, str) else "".join(m))}
        free = [self._letters[b] for b in range(0xF5, 0x100) if self._letters[b] in model["vocab"] and self._letters[b] not in merged]
        whole = any(model.get(k) for k in ("ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        self._between = free[0] if free and not whole else None
        self._bare = Tokenizer(self._model)
        self._codes = np.array([ord(self._letters[b]) for b in range(256)], "<u4")

    def _of_letters(self, letters: str) -> bytes:
        return b"".join([self._four[t.id] for t in self._model.tokenize(letters)])

    def __missing__(self, match: str) -> bytes:
        ids = self._before.get(match)
        if ids is None:
            if match.isascii() and match.isprintable():  # of these bytes only the blank has another letter
                letters = match.replace(" ", self._letters[32])
            else:
                letters = match.encode().decode("latin-1").translate(self._letters)
            ids = self._of_letters(letters)
        if len(match) <= LONG:
            self[match] = ids
            self._held += ENTRY + 2 * len(match) + len(ids)
            if self._held > REMEMBERED:
                self._before = self.copy()
                self.clear()
                self._held = 0
        return ids

    def _encoded(self, matches: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids by the library, and where those of each match begin and end."""
        if self._between is None:  # one by one
            found = [self[m] for m in matches.to_pylist()]
            ends = np.cumsum([0, *map(len, found)]) // 4
            return np.frombuffer(b"".join(found), "<u4"), ends[:-1], ends[1:]
        data, at = _bytes_of(matches.cast(pa.large_string()))
        ends = at + np.arange(len(at))  # with a letter after each match
        letters, of_match = np.full(ends[-1], ord(self._between), "<u4"), np.ones(ends[-1], bool)
        of_match[ends[1:] - 1] = False
        letters[of_match] = self._codes[data]
        ids = []
        for a in range(0, len(matches), TOGETHER):
            some = letters[ends[a] : ends[min(a + TOGETHER, len(matches))]].tobytes().decode("utf-32-le")
            ids.append(np.array(self._bare.encode_batch_fast([some], add_special_tokens=False)[0].ids, "<u4"))
        ids = np.concatenate(ids) if ids else np.zeros(0, "<u4")
        ends = np.flatnonzero(ids == self._model.token_to_id(self._between))
        return ids, np.concatenate([[0], ends + 1])[: len(ends)], ends

    def encode(self, text: str | None) -> bytes:
        """All ids of ``text`` (null: empty) and the end id."""
        if not text:
            return self._end
        if any(c in text for c in self._added):
            # Every second piece is an added token.
            return b"".join([self._added[p] if i % 2 else self._ids(p) for i, p in enumerate(self._cut(text))]) + self._end
        return self._ids(text) + self._end

    def _ids(self, text: str) -> bytes:
        if self._beyond(text):
            # by the place of each piece: the memory's keys are texts
            return b"".join([self[text[a:z]] for _, (a, z) in self._pieces(text)])
        return b"".join(map(self.__getitem__, self._narrow(text)))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """:meth:`encode` of each text in turn."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        for group in _runs(texts, GROUP):
            chunks = [(c, self._single(c)) for c in _runs(group, CHUNK)]
            together = self._together([c.filter(pa.array(~single)) if single.any() else c for c, single in chunks])
            for chunk, single in chunks:
                for i, one in enumerate(single.tolist()):
                    yield self.encode(chunk[i].as_py()) if one else next(together) + self._end

    def _single(self, texts: pa.LargeStringArray) -> np.ndarray:
        """Which texts go one by one."""
        data, at = _bytes_of(texts)
        single = np.full(len(texts), len(data) > GROUP)
        if self._added and not single[0]:
            places = np.array([m.start() for m in self._marks(data.tobytes())], np.int64)
            single[np.searchsorted(at, places, "right") - 1] = True
        return single

    def _all_starts(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the matches of the split pattern begin in any texts."""
        kinds = _kinds_of(data)
        starts, odd = _starts(data, kinds, at), np.flatnonzero(kinds == _ODD)
        if not len(odd):
            return starts
        blank = np.flatnonzero(data[1:] == 32) + 1
        after_word = ((kinds[blank - 1] == _LETTER) | (kinds[blank - 1] == _NUMBER)) & (data[blank - 1] < 0x80)
        bounds = np.union1d(at, blank[after_word])
        parts = np.unique(np.searchsorted(bounds, odd, "right") - 1)
        begin, end = bounds[parts], bounds[parts + 1]
        keep = np.searchsorted(end, starts, "right")  # the first part that ends after the start
        kept = starts[starts < np.append(begin, len(data))[keep]]
        found = []
        for a, z in zip(begin.tolist(), end.tolist()):
            part = data[a:z].tobytes().decode()
            for _, (x, y) in self._pieces(part):
                found.append(a)
                a += len(part[x:y].encode())
        return np.sort(np.concatenate([kept, np.array(found, np.int64)]))

    def _together(self, chunks: list[pa.LargeStringArray]) -> Iterator[bytes]:
        """The ids of each text, none with added tokens."""
        cut, cuts = [], []
        for chunk in chunks:
            data, at = _bytes_of(chunk)
            starts = self._all_starts(data, at) if len(data) else np.zeros(0, np.int64)
            offsets = np.append(starts, len(data)).astype(np.int32)
            cut.append(pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)))
            cuts.append(np.searchsorted(starts, at))
        numbered = pa.chunked_array(cut, pa.string()).dictionary_encode().unify_dictionaries().combine_chunks()
        ids, begin, end = self._encoded(numbered.dictionary)
        sizes, numbers = end - begin, numbered.indices.to_numpy()
        to = 0
        for chunk, of_texts in zip(cut, cuts):
            which, to = numbers[to : to + len(chunk)], to + len(chunk)
            n = sizes[which]
            ends = np.concatenate([[0], np.cumsum(n)])
            raw = ids[np.repeat(begin[which] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
            places = (4 * ends[of_texts]).tolist()
            yield from (raw[a:z] for a, z in zip(places, places[1:]))


def _runs(texts: pa.LargeStringArray, size: int) -> Iterator[pa.LargeStringArray]:
    """The texts in runs of at most ``size`` bytes, or of one text."""
    _, at = _bytes_of(texts)
    done = 0
    while done < len(texts):
        to = max(done + 1, int(np.searchsorted(at, at[done] + size, "right")) - 1)
        yield texts.slice(done, to - done)
        done = to


def _bytes_of(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and where each begins, the end included."""
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]], at - at[0]


@lru_cache(maxsize=4)
def ids_of(path: str, end_id: int | None, added: bool = False) -> Ids:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
    return Ids(path, end_id, added)

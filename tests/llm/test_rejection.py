"""Operator 6: subword counts against a plain loop, rejection of a language
that was never learned, many languages."""

import random

import numpy as np
import pytest

from odd_documents import prose, vocabulary
from sluice.llm import langid

SYLLABLES = {
    "aa": ["ka", "to", "mi", "ren", "sul"],
    "bb": ["bré", "och", "uñ", "gli", "äst"],
    "cc": ["whi", "sto", "ne", "ing", "ers"],
    "dd": ["zy", "prz", "owa", "szcz", "nie"],
}
SCHEMA = "doc_id long, text string, lang string"


def plain_counts(text):
    raw = b" " + text.lower().encode() + b" "
    kept = [b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in raw]
    counts = np.zeros(1 << langid.BITS, np.int64)
    for n, factor in langid._GRAMS.items():
        for at in range(len(kept) - n + 1):
            gram = kept[at : at + n]
            # pairs lie inside a word; longer ones may hold an edge outside
            if 32 in (gram if n == 2 else gram[1:-1]):
                continue
            value = sum(b << 8 * i for i, b in enumerate(gram))
            hashed = (value * int(factor) & 0xFFFFFFFF ^ int(factor)) * 0x27D4EB2F & 0xFFFFFFFF
            counts[hashed >> 32 - langid.BITS] += 1
    return counts


@pytest.mark.parametrize("text", ["", "a", "ab", "Ab cd", "über Ñandú 12 ab3c", "日本語 x", "word " * 50, "it's  done.\n\tx"])
def test_counts_equal_a_plain_loop(text):
    got = langid.subword_counts(text)
    want = plain_counts(text)
    # a gram of edge blanks alone counts in neither
    assert (got == want).all()


def test_counts_do_not_depend_on_blocks(monkeypatch):
    rnd = random.Random(2)
    text = prose(rnd, 400, vocabulary(rnd, SYLLABLES["bb"]))
    want = plain_counts(text)
    for block in (7, 64, 1000):
        monkeypatch.setattr(langid, "BLOCK", block)
        assert (langid.subword_counts(text) == want).all()


@pytest.fixture(scope="module")
def four(spark):
    rnd, rows = random.Random(4), []
    for k, (lang, syllables) in enumerate(SYLLABLES.items()):
        words = vocabulary(rnd, syllables)
        rows += [(10_000 * k + i, prose(rnd, rnd.choice([3, 8, 40, 200]), words), lang) for i in range(300)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


def test_a_language_left_out_is_rejected(four):
    """Reports rejected rows of the language left out against clean rows lost."""
    from pyspark.sql import functions as F

    for out in ("bb", "dd"):
        model = langid.fit(four.withColumn("lang", F.when(F.col("lang") != out, F.col("lang"))))
        assert model.languages == sorted(set(SYLLABLES) - {out}) and model.threshold
        rows = langid.predict(four, model).join(four, "doc_id").collect()
        gone = [r["rejected"] for r in rows if r["lang"] == out and len(r["text"]) > 100]
        lost = [r["rejected"] for r in rows if r["lang"] != out]
        print(out, sum(gone) / len(gone), sum(lost) / len(lost))
        assert sum(gone) / len(gone) > 0.8 and sum(lost) / len(lost) < 0.01


def test_all_languages_are_learned(spark):
    rnd, rows = random.Random(8), []
    for k in range(350):
        a, b = f"{chr(97 + k % 26)}{chr(97 + k // 26)}q", f"{chr(97 + k // 26)}x{chr(97 + k % 26)}"
        rows += [(k * 10 + i, " ".join(rnd.choice([a, b, a + b, b + a]) for _ in range(30)), f"l{k:03d}") for i in range(9)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = langid.fit(df, sample=2000)
    assert len(model.languages) == 350 and model.out is not None and model.table.shape == (1 << langid.BITS, langid.WIDTH)
    assert langid.predict(df, model).count() == len(rows)


def test_ties_go_by_name():
    model = langid.Model(["a", "b"], np.zeros((1 << langid.BITS, 2), np.float32), np.zeros(2, np.float32))
    assert model.predict("any text") == ("a", 0.5, False)
    model.threshold = {3: 0.5, 9: -1.0}
    assert model.bound(7) == -np.inf and model.bound(8) == 0.5 and model.bound(511) == 0.5 and model.bound(1 << 30) == -1.0
    assert model.predict("any text at all")[2]

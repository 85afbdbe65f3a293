"""Small documents with everything that may go wrong in a table."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rnd, words, vocabulary):
    out = []
    for _ in range(words):
        out.append(rnd.choice(vocabulary))
        if rnd.random() < 0.08:
            out[-1] += ".\n" if rnd.random() < 0.5 else ","
    return " ".join(out).replace("\n ", "\n")


def vocabulary(rnd, syllables, n=300):
    return ["".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(n)]


def corpus(seed=3, n=60):
    """Prose in two invented languages with copies and near copies."""
    rnd = random.Random(seed)
    kinds = {"xx": vocabulary(rnd, ["ka", "to", "mi", "ren", "sul"]), "yy": vocabulary(rnd, ["bré", "och", "uñ", "gli", "äst"])}
    rows = []
    for i in range(n):
        lang = "xx" if i % 3 else "yy"
        rows.append((i * 3, prose(rnd, rnd.randint(5, 250), kinds[lang]), lang, f"src{i % 4}"))
    for i in range(8):
        text = rows[i][1]
        rows.append((1000 + i, text, rows[i][2], "copy"))
        words = text.split(" ")
        words[len(words) // 2] = "changed"
        rows.append((2000 + i, " ".join(words), rows[i][2], "near"))
    return [(a, t, b, c, len(t)) for a, t, b, c in rows]


def odd_rows():
    long = "Long words here and there again. " * 6000 + "\n" + "z" * 50_000
    return [
        (None, "text without an id\nanother line of it", "xx", "s", 5),
        (None, None, None, None, None),
        (9001, None, "xx", "s", None),
        (9002, "", "xx", "s", 0),
        (9003, " \n\t \n", None, "s", 5),
        (9004, long, "yy", None, len(long)),
        (9005, "repeated row of the table, with enough words to count as a line", "xx", "s", 10),
        (9005, "repeated row of the table, with enough words to count as a line", "xx", "s", 10),
        (9006, "12345 67890 --- !!!", "xx", "s", 19),
        (9007, "tie\ntie\ntie", "yy", "s", 11),
        (9008, "日本語のテキスト   'tis <|endoftext|> don't", None, "s", 10),
        (-5, "negative id", "xx", "s", 11),
    ]


@pytest.fixture(scope="session")
def plain(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def odd(spark):
    """All odd rows among plain ones, and columns named like the operators' own."""
    from pyspark.sql import functions as F

    d = spark.createDataFrame(corpus(5, 25) + odd_rows(), SCHEMA).repartition(4)
    clash = ["fp", "key", "task", "guard", "piece", "item", "part", "line", "line_no", "length", "ids", "text_hash", "place", "component_id", "shard", "curve", "rejected", "start", "node", "a"]
    return d.select("*", *[F.lit(i).alias(c) for i, c in enumerate(clash)])


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("1 = 0")

"""Operator 7 on lines of one template against brute force."""

import random

import pytest
from test_near import edits

from sluice.llm import lines


def rows_of(seed, n, digits):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        number = "".join(rnd.choice("0123456789") for _ in range(digits))
        out.append(f"request {number[: digits // 2]} was served in {number[digits // 2 :]} milliseconds")
    for line in out[: n // 4]:
        other = list(line)
        for _ in range(rnd.randint(1, 3)):
            at, k = rnd.randrange(len(other)), rnd.randrange(3)
            other[at : at + (k != 1)] = [] if k == 0 else [rnd.choice("0123456789 xyz")]
        out.append("".join(other))
    rnd.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("digits", [4, 7, 14])
def test_lines_of_one_template(spark, digits):
    rows = rows_of(digits, 240, digits)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["removed"] for r in lines.line_digests(df, unit="characters").collect()}
    first: dict = {}
    for d, t in rows:
        first.setdefault(t, d)
    near = lambda a, b: abs(len(a) - len(b)) <= lines.EDITS and edits(a, b) <= lines.EDITS
    gone = {d for d, t in rows if first[t] != d or any(first[o] < d and near(t, o) for o in first if o != t)}
    assert {d for d, x in got.items() if x} == gone and len(gone) > 20

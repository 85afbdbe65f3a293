"""Operator 7: line deduplication by a segment-partition edit join, in
expressions.

A line is a *repeat* if an equal line stands earlier in the corpus, and a
*near repeat* if a line within ``EDITS`` edits first stands earlier than it
does.  Repeats go; the first of its kind stays.  Earlier is by document id,
then text checksum, then line number.  Blank lines are no repeats, and lines
under ``LEAST`` bytes have no near ones.

Equal lines are folded first (map-side combined), so a line that a third of
all documents hold is one class.  For the near ones each class's line is cut
into ``EDITS + 1`` segments.  Two lines within ``EDITS`` edits share a segment
that the edits leave alone, so each line looks its substrings up in the
segments of lines as long or up to ``EDITS`` shorter, only at the few places
where a shared segment can stand given both lengths.  What meets must agree in
its letter counts up to the edits, inside the join, and is then verified by
banded bit-parallel edit distance: the band of ``2 * EDITS + 1`` diagonals is
one word, moved along the line by a fold.  Texts travel only for lines that
met another.

Defined results: null text has no lines and stays null; a null id comes before
all others; rows equal in id and text get equal results; an empty table gives
no rows; ``dedup`` keeps all columns.  A text is cut at ``\\n``.  ``unit`` says
what edits and lengths count: ``characters`` (code points, as the queries and
the pipeline do) or ``bytes`` of UTF-8, where one changed letter beyond ASCII
may count as up to four.  ``LEAST`` is of bytes with either.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import materialize, null_safe

EDITS = 2
LEAST = 30
#: Bytes of a fixed-width text that one of the unit takes.
UNITS = {"bytes": 1, "characters": 4}
#: Classes whose texts are sought by broadcast; beyond it, by a shuffled join.
BROADCAST_CLASSES = 2_000_000

# Letters whose counts two lines are compared by.
LETTERS = "etaoinsrhldc"
_PLACE = ["doc_id", "text_hash"]
#: What tells lines apart: 128 bits of two hashes, and the length.
_CLASS = ["line_hash", "line_hash2", "length"]
#: The letter counts take the bits below it; above stands how much shorter.
_COUNTED = 5 * len(LETTERS)


def _lines(docs: DataFrame, unit: str) -> DataFrame:
    """``doc_id, text_hash, line_no, line, line_hash, length`` of the lines
    that are not blank."""
    length = {"bytes": F.octet_length, "characters": F.length}[unit]
    keyed = docs.filter(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return keyed.filter(F.col("line").rlike(r"\S")).withColumns({"line_hash": F.xxhash64("line"), "line_hash2": F.xxhash64(F.lit(7), "line"), "length": length("line")})


def _segment(length: str, i: int, edits: int) -> tuple[str, str]:
    """Start (from 1) and size of segment ``i`` of a line: sizes differ by at
    most one, the last segments are the longer ones."""
    parts = edits + 1
    size, longer = f"(({length}) div {parts})", f"(({length}) % {parts})"
    start = f"({i} * {size} + greatest(0, {i} - ({parts} - {longer})) + 1)"
    return start, f"({size} + cast({i} >= {parts} - {longer} as int))"


def _probes(edits: int) -> list[tuple[int, int, int]]:
    """(how much shorter, segment, shift) of every substring to look up."""
    out = []
    for less in range(edits + 1):
        for i in range(edits + 1):
            right = edits - i
            out += [(less, i, s) for s in range(max(-i, less - right), min(i, less + right) + 1)]
    return out


def _hashes(edits: int, unit: str) -> Column:
    """Hashes of a line's own segments, then of its substrings to look up: cut
    from a text of fixed width, where a place is found without a scan."""
    cut, width = [], UNITS[unit]
    wide = {"bytes": "cast(line as binary)", "characters": "encode(line, 'UTF-32')"}[unit]
    for less, i, shift in [(0, i, 0) for i in range(edits + 1)] + _probes(edits):
        start, size = _segment(f"length - {less}", i, edits)
        cut.append(F.expr(f"hash(substring({wide}, {width} * ({start} + {shift} - 1) + 1, {width} * {size}))"))
    return F.array(*cut)


def _letter_counts() -> Column:
    """Counts of the twelve letters, five bits each (modulo 32)."""
    size = F.octet_length("line")
    count = [(size - F.octet_length(F.replace(F.col("line"), F.lit(c)))).bitwiseAND(31).cast("long") for c in LETTERS]
    return reduce(lambda a, b: a * 32 + b, count)


def _unlike(a: Column, b: Column) -> Column:
    """By how much two packed counts differ in all, at least."""
    total = F.lit(0).cast("long")
    for k in range(len(LETTERS)):
        d = F.abs(F.shiftright(a, 5 * k).bitwiseAND(31) - F.shiftright(b, 5 * k).bitwiseAND(31))
        total = total + F.least(d, 32 - d)
    return total


def within_edits(a: Column, b: Column, edits: int, unit: str = "bytes") -> Column:
    """Whether two texts, ``a`` no shorter than ``b`` and by at most ``edits``
    of the unit longer, are at most ``edits`` edits apart: Hyyro's banded
    bit-vector recurrence, one word of ``2 * edits + 1`` diagonals."""
    width = 2 * edits + 1
    full, top = (1 << width) - 1, 1 << (2 * edits)
    single = {"bytes": lambda text: F.decode(text.cast("binary"), "ISO-8859-1"), "characters": lambda text: text}[unit]
    points = lambda text: F.transform(F.split(single(text), ""), F.ascii)

    bind = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)  # noqa: E731  f's argument is computed once

    def step(acc: Column, at: Column, long: Column, short: Column) -> Column:
        vp, vn, dist, mask = acc["vp"], acc["vn"], acc["dist"], acc["mask"]
        c = F.get(short, at)
        meets = reduce(lambda x, y: x.bitwiseOR(y), [F.when(F.get(long, at + (k - edits)) == c, 1 << k).otherwise(0) for k in range(width)])

        def moved_on(d0: Column) -> Column:
            hp = vn.bitwiseOR(F.lit(full) - d0.bitwiseOR(vp))
            hn = d0.bitwiseAND(vp)
            before_end = at < F.size(long) - edits
            down = F.when(d0.bitwiseAND(top) == 0, 1).otherwise(0)
            across = F.when(hp.bitwiseAND(mask) != 0, 1).otherwise(0) - F.when(hn.bitwiseAND(mask) != 0, 1).otherwise(0)
            moved = F.shiftright(d0, 1)
            return F.struct(
                hn.bitwiseOR(F.lit(full) - moved.bitwiseOR(hp)).alias("vp"),
                moved.bitwiseAND(hp).alias("vn"),
                (dist + F.when(before_end, down).otherwise(across)).alias("dist"),
                F.when(before_end, mask).otherwise(F.shiftright(mask, 1)).alias("mask"),
            )

        d0 = bind(meets, lambda m: (m.bitwiseAND(vp) + vp).bitwiseAND(full).bitwiseXOR(vp).bitwiseOR(m).bitwiseOR(vn))
        return bind(d0, moved_on)

    start = F.struct(F.lit(full - (1 << edits) + 1).alias("vp"), F.lit(0).alias("vn"), F.lit(edits).alias("dist"), F.lit(top >> 1).alias("mask"))
    both = F.struct(points(a).alias("long"), points(b).alias("short"))
    fold = lambda p: F.aggregate(F.sequence(F.lit(0), F.size(p["short"]) - 1), start, lambda acc, at: step(acc, at, p["long"], p["short"]))["dist"]
    return F.element_at(F.transform(F.array(both), fold), 1) <= edits


def _classes(docs: DataFrame, edits: int, unit: str) -> DataFrame:
    """One row a distinct line: its number, where it first stands, how often,
    and what the near join needs of it.  That is computed of short lines, too:
    behind a condition, Spark would not share the parts of the expressions.
    The number stands for the line wherever lines meet: it is fixed, as the
    table is written with it."""
    rows = _lines(docs, unit).select(
        *_CLASS,
        F.struct(*_PLACE, "line_no").alias("place"),
        F.struct(_hashes(edits, unit).alias("hashes"), _letter_counts().alias("letters"), F.octet_length("line").alias("bytes")).alias("near"),
    )
    classes = rows.groupBy(*_CLASS).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"), F.any_value("near").alias("near"))
    return materialize(classes.withColumn("id", F.monotonically_increasing_id()), "line-classes")


def _met(classes: DataFrame, edits: int, least: int) -> DataFrame:
    """Pairs of class numbers, ``id`` of the longer line and ``s_id``, that
    share a segment and agree in letter counts.

    This join shuffles a row for each segment and each substring to look up,
    so a row holds no more than three words: the key, the class number and the
    letter counts.  The key tells the shorter line's length; how much longer
    the other is stands above its letter counts."""
    base = classes.filter(F.col("near.bytes") >= least).select("id", "length", "near.hashes", "near.letters")
    key = lambda less, i, h: f"shiftleft(cast((length - {less}) * {edits + 1} + {i} as bigint), 32) + (cast({h} as bigint) & 4294967295)"
    own = ", ".join(key(0, i, f"hashes[{i}]") for i in range(edits + 1))
    sought = ", ".join(f"struct({key(less, i, f'hashes[{edits + 1 + k}]')} as key, letters | shiftleft({less}L, {_COUNTED}) as letters)" for k, (less, i, _) in enumerate(_probes(edits)))
    short = base.select(F.expr(f"explode(array({own}))").alias("key"), F.col("id").alias("s_id"), F.col("letters").alias("s_letters"))
    long = base.select(F.expr(f"inline(array({sought}))"), "id")
    pairs = long.join(short, (long["key"] == short["key"]) & _may_be_near(edits))
    return materialize(pairs.select("id", "s_id").distinct(), "line-pairs")


def _may_be_near(edits: int) -> Column:
    """Whether two lines that met are in order, the longer first, and agree in
    letter counts."""
    alike = _unlike(F.col("letters"), F.col("s_letters")) <= 2 * edits
    longer = F.shiftrightunsigned("letters", _COUNTED) > 0
    return (longer | (F.col("id") > F.col("s_id"))) & alike


def _texts(ids: DataFrame, classes: DataFrame, docs: DataFrame, unit: str) -> DataFrame:
    """The line of each of some classes, given by their numbers."""
    ids = materialize(ids, "line-ends")
    small = F.broadcast if ids.count() <= BROADCAST_CLASSES else lambda df: df
    sought = classes.select("id", *_CLASS).join(small(ids), "id")
    found = _lines(docs, unit).select(*_CLASS, "line").join(small(sought), _CLASS)
    return found.groupBy("id").agg(F.min("line").alias("line"))


def near_lines(docs: DataFrame, classes: DataFrame, edits: int = EDITS, least: int = LEAST, unit: str = "bytes") -> DataFrame:
    """Verified pairs of class numbers, the longer line first."""
    pairs = _met(classes, edits, least)
    ends = pairs.select("id").unionByName(pairs.select(F.col("s_id").alias("id"))).distinct()
    texts = materialize(_texts(ends, classes, docs, unit), "line-texts")
    both = pairs.join(texts, "id").join(texts.select(F.col("id").alias("s_id"), F.col("line").alias("s_line")), "s_id")
    return both.filter(within_edits(F.col("line"), F.col("s_line"), edits, unit)).select("id", "s_id")


def repeats(docs: DataFrame, edits: int = EDITS, least: int = LEAST, unit: str = "bytes") -> DataFrame:
    """The documents with repeats: ``doc_id, text_hash, exact, near``, arrays
    of line numbers from 0."""
    classes = _classes(docs, edits, unit)
    links = materialize(near_lines(docs, classes, edits, least, unit), "line-links")
    swapped = links.select(F.col("s_id").alias("id"), F.col("id").alias("s_id"))
    other = classes.select(F.col("id").alias("s_id"), F.col("first").alias("s_first"))
    earliest = links.unionByName(swapped).join(other, "s_id").groupBy("id").agg(F.min("s_first").alias("s_first"))
    marked = classes.join(earliest, "id", "left").select(*_CLASS, "first", "n", F.coalesce(_before("s_first", "first"), F.lit(False)).alias("late"))
    marked = materialize(marked.filter("n > 1 or late"), "line-marks")
    here = _lines(docs, unit).select(*_PLACE, "line_no", *_CLASS).join(marked, _CLASS)
    repeat = ~F.struct(*_PLACE, "line_no").eqNullSafe(F.col("first"))
    gone = here.filter(repeat | F.col("late")).dropDuplicates([*_PLACE, "line_no"])
    listed = lambda keep: F.array_sort(F.collect_list(F.when(keep, F.col("line_no"))))
    return gone.groupBy(*_PLACE).agg(listed(repeat).alias("exact"), listed(~repeat).alias("near"))


def _before(a: str, b: str) -> Column:
    """Whether place ``a`` is before place ``b`` (null ids first)."""
    low = F.array_min(F.array(a, b))
    return F.col(a).isNotNull() & low.eqNullSafe(F.col(a)) & ~F.col(a).eqNullSafe(F.col(b))


def line_digests(docs: DataFrame, edits: int = EDITS, least: int = LEAST, unit: str = "bytes") -> DataFrame:
    """``doc_id, n_lines, n_exact, n_near, removed`` for each row; ``removed``
    lists the numbers of the lines that go."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"))
    rows = rows.withColumn("n_lines", F.greatest("n_lines", F.lit(0)))
    both = null_safe(rows, repeats(docs, edits, least, unit), _PLACE)
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    all_gone = F.array_join(F.array_sort(F.concat("exact", "near")).cast("array<string>"), ",")
    return both.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), size(F.coalesce("exact", F.array().cast("array<int>"))).alias("n_exact"), size(F.coalesce("near", F.array().cast("array<int>"))).alias("n_near"), F.coalesce(all_gone, F.lit("")).alias("removed"))


def dedup(docs: DataFrame, edits: int = EDITS, least: int = LEAST, unit: str = "bytes") -> DataFrame:
    """``docs`` without the lines that go, ``n_chars`` counted anew where there
    is one; rows that have no line left but blank ones go, if one went."""
    keyed = docs.withColumn("text_hash", F.xxhash64("text"))
    both = null_safe(keyed, repeats(docs, edits, least, unit), _PLACE)
    gone = F.col("exact").isNotNull()
    left = F.array_join(F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains(F.concat("exact", "near"), i)), "\n")
    changed = both.withColumn("text", F.when(gone, left).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(gone, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return changed.filter(~gone | F.col("text").rlike(r"\S")).select(*docs.columns)

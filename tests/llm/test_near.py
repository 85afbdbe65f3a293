"""Operators 1, 2, 7 and 9 against brute force."""

import hashlib
import re

import numpy as np
import pytest

from odd_documents import empty, odd, plain  # noqa: F401
from sluice.llm import embeddings, graph, lines, simhash, sketches

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, n):
    w = WORDS.findall(low(text))
    return [" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []


def roots(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


# ---------------------------------------------------------------- sketches


def test_fingerprints_of_edited_texts(odd):
    rows = [(r["doc_id"], r["text"] or "") for r in odd.select("doc_id", "text").collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = {}
    for r in sketches.compare_with_edit(odd).collect():
        got.setdefault((r["doc_id"], r["fingerprint"], r["edited_sha256"]), []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for i, (k, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        e = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        r = got[k, sketches.to_text(sketches.sketch(t)), hashlib.sha256(e.encode()).hexdigest()][0]
        a, b, c = (set(shingles(x, 5)) for x in (t, e, after))
        assert r["n_chars"] == len(t)
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert abs(r["near_edited"] - like(a, b)) < 0.17 and abs(r["near_next"] - like(a, c)) < 0.17


def test_sketches_merge_and_count():
    texts = [" ".join(f"w{i * 7919 % 1000 + j}" for i in range(800)) for j in (0, 300, 5000)]
    a, b, c = (sketches.sketch(t) for t in texts)
    both = sketches.sketch(texts[0] + " " + texts[2])
    assert len(np.setdiff1d(np.union1d(a, c)[: sketches.K], both)) <= 4  # shingles over the seam
    assert abs(sketches.distinct_shingles(a) / len(set(shingles(texts[0], 5))) - 1) < 0.35
    assert sketches.containment(a, a) == 1.0 and sketches.resemblance(a, c) == 0.0
    for block in (64, 500):
        assert (sketches.sketch(texts[1], block=block) == b).all()
    long_word = "x" * 3000 + " a b " + "y" * 500
    assert len(sketches.sketch(long_word, block=100)) == 1


@pytest.mark.parametrize("groups,most", [(2, sketches.HELD), (7, 2)])
def test_merged_groups(odd, groups, most):
    rows = sketches.sketch_documents(odd)
    found = sketches.merge_sketches(rows.selectExpr(f"cast(doc_id % {groups} as string) as g", "fingerprint"), ["g"], most=most).collect()
    got = {r["g"]: r["fingerprint"] for r in found}
    assert len(got) == len(found)
    want = {}
    for r in rows.collect():
        g = None if r["doc_id"] is None else str(int(np.fmod(r["doc_id"], groups)))
        want[g] = np.union1d(want.get(g, np.zeros(0, np.uint64)), sketches.from_text(r["fingerprint"]))[: sketches.K]
    assert got == {k: sketches.to_text(v) for k, v in want.items()}


def test_plan_does_not_grow_with_the_tasks(spark):
    df = spark.range(5000).selectExpr("id as doc_id", "concat('text ', id) as text")
    old, sizes, found = spark.conf.get("spark.sql.shuffle.partitions"), [], []
    try:
        for n in (8, 200):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            d = sketches._followed(df)
            sizes.append(len(d._jdf.queryExecution().optimizedPlan().toString()))
            rows = d.collect()
            assert sum(r["guard"] for r in rows) == len({r["task"] for r in rows})
            assert sorted(r["doc_id"] for r in rows if not r["guard"]) == list(range(5000))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sizes[1] < 1.2 * sizes[0], sizes


# ---------------------------------------------------------------- simhash


def brute_fingerprint(text):
    from xxhash import xxh64_intdigest

    h = [xxh64_intdigest(s.encode(), 42) for s in shingles(text, 4)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_equals_brute_force(odd):
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in odd.select("doc_id", "text").collect()]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (rows[i][1] ^ rows[j][1]).bit_count() <= 4]
    root = roots(len(rows), pairs)
    least = {}
    for (k, _), r in zip(rows, root):
        least[r] = min((x for x in (least.get(r), k) if x is not None), default=None)
    want = sorted((str(k), f, str(least[r])) for (k, f), r in zip(rows, root))
    got = simhash.near_duplicates(odd).collect()
    assert sorted((str(r["doc_id"]), r["fp"] % (1 << 64), str(r["component_id"])) for r in got) == want


def test_anchors_lose_no_pair():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 64, 400, dtype=np.uint64)
    y = x.copy()
    for i in range(len(x)):
        for bit in rng.choice(64, i % 5, replace=False):
            y[i] ^= np.uint64(1) << np.uint64(bit)
    (kx, rx), (ky, ry) = simhash.anchors(x), simhash.anchors(y)
    homes, places = {}, {}
    for k, r in zip(kx.tolist(), rx.tolist()):
        if not k & 1:
            homes.setdefault(r, set()).add(k >> 1)
    for k, r in zip(ky.tolist(), ry.tolist()):
        places.setdefault(r, set()).add(k >> 1)
    assert all(homes[i] & places[i] for i in range(len(x)))
    assert len(kx) / len(x) < 6 * 17


def test_dense_group_is_one_component(spark):
    rng = np.random.default_rng(1)
    fps = {int(c) for c in rng.integers(0, 1 << 63, 5)}
    for c in list(fps):
        for _ in range(300):
            f = c
            for b in rng.choice(64, int(rng.integers(0, 4)), replace=False):
                f ^= 1 << int(b)
            fps.add(f)
    fps = sorted(f - (1 << 64) if f >= 1 << 63 else f for f in fps)
    links = simhash.linked_fingerprints(spark.createDataFrame([(f,) for f in fps], "fp long"))
    got = {r["node"]: r["component"] for r in graph.connected_components(links).collect()}
    mask = (1 << 64) - 1
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if ((fps[i] ^ fps[j]) & mask).bit_count() <= 4]
    assert [got.get(f, f) for f in fps] == [fps[r] for r in roots(len(fps), pairs)]


def test_one_document_of_each_group_stays(odd):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    parts = {(str(r["doc_id"]), r["fp"]): r["component_id"] for r in simhash.near_duplicates(odd).collect()}
    names = {k for (k, _), c in parts.items() if k == "None" or str(c) == k}
    rows = [str(r["doc_id"]) for r in kept.collect()]
    assert set(rows) == names and rows.count("9005") <= 1 and rows.count("None") == 2


# ---------------------------------------------------------------- components


def test_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(2)
    n = 400
    edges = [(i, i + 1) for i in range(0, 120)] + [(200, i) for i in range(201, 260)] + [tuple(map(int, rng.integers(260, n, 2))) for _ in range(90)]
    names = rng.permutation(10 * n)[:n].tolist()
    got = {r["node"]: r["component"] for r in graph.connected_components(spark.createDataFrame([(names[a], names[b]) for a, b in edges], "a long, b long")).collect()}
    root = roots(n, edges)
    for i in range(n):
        group = [names[j] for j in range(n) if root[j] == root[i]]
        assert got.get(names[i], names[i]) == min(group)
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- embeddings


def vectors(seed=0, groups=12, size=8, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        c = rng.standard_normal(dim)
        for _ in range(size):
            rows.append((len(rows), (c + rng.standard_normal(dim) * 0.12).astype(np.float32).tolist(), g % 3))
    rows += [(500 + i, rows[i][1], rows[i][2]) for i in range(5)] + [(510, rows[0][1], 99), (511, rows[0][1], None)]
    odd = [None, [], [0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [float("inf")] * dim, [None] + [1.0] * (dim - 1), [1.0] * 3]
    rows += [(600 + i, v, 0) for i, v in enumerate(odd)]
    return rows + [(None, rows[1][1], 1), (700, [1e-30] * dim, 5), (701, [1e30] * dim, 5)]


@pytest.mark.parametrize("leaf,block,stage", [(4, 4096, 10), (4, 3, 10), (10_000, 4096, 10), (4, 4096, 2), (2, 3, 1)])
def test_forest_links_equal_brute_force(spark, leaf, block, stage):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as key", "2 as unit", "3 as class_id").repartition(4)
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and any(v) and k is not None and y is not None for k, v, y in rows]
    unit = [np.array(np.float32(v), float) / np.abs(v).max() if good else None for (_, v, _), good in zip(rows, ok)]
    like = lambda a, b: float(a @ b / np.sqrt((a @ a) * (b @ b)))
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and like(unit[i], unit[j]) >= 0.98
    ]
    degree = np.bincount(np.array(pairs).ravel(), minlength=len(rows))
    root = roots(len(rows), pairs)
    least = {}
    for (k, _, _), r in zip(rows, root):
        if k is not None:
            least[r] = min(least.get(r, k), k)
    want = sorted((str(k), int(n), str(least.get(r)), k is None or least[r] == k) for (k, _, _), n, r in zip(rows, degree, root))
    got = embeddings.near_duplicates(df, leaf=leaf, block=block, stage=stage).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in got) == want


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embeddings.near_duplicates(df).count() == 0


# ---------------------------------------------------------------- lines


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("limit", [1, 2, 3])
def test_banded_edit_distance(spark, limit):
    import random

    from pyspark.sql import functions as F

    rnd, pairs = random.Random(limit), []
    while len(pairs) < 400:
        a = [rnd.choice("abcé") for _ in range(rnd.randint(limit + 1, 14))]
        b = list(a)
        for _ in range(rnd.randint(0, limit + 2)):
            k = rnd.randrange(3)
            if k == 0 and len(b) > 1:
                b.pop(rnd.randrange(len(b)))
            elif k == 1:
                b.insert(rnd.randint(0, len(b)), rnd.choice("abcé"))
            else:
                b[rnd.randrange(len(b))] = rnd.choice("abcé")
        a, b = sorted(("".join(a).encode(), "".join(b).encode()), key=len, reverse=True)
        if len(a) - len(b) <= limit:
            pairs.append((a.decode(), b.decode()))
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", lines.within_edits(F.col("a"), F.col("b"), limit).alias("near")).collect()
    assert all(r["near"] == (edits(r["a"].encode(), r["b"].encode()) <= limit) for r in got)


def line_rows():
    import random

    rnd, rows = random.Random(9), []
    base = ["".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(30, 60))) for _ in range(25)]
    for d in range(60):
        text = []
        for _ in range(rnd.randint(1, 6)):
            line = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 1, 2, 3])):
                k, at = rnd.randrange(3), rnd.randrange(len(line))
                line[at : at + (k != 1)] = [] if k == 0 else [rnd.choice("xyzé")]
            text.append("".join(line))
        text += rnd.choice([[], [""], ["short"], ["  "]])
        rows.append((d * 2, "\n".join(text)))
    return rows + [(None, rows[3][1]), (7, None), (9, ""), (11, rows[5][1]), (11, rows[5][1])]


def brute_repeats(rows, limit=lines.EDITS, least=lines.LEAST):
    import xxhash

    seen = {}
    for d, t in rows:
        if t is not None:
            h = xxhash.xxh64_intdigest(t.encode(), 42)
            place = (d is not None, d or 0, h - (1 << 64) if h >= 1 << 63 else h)
            seen[d, t] = place
    first, all_lines = {}, []
    for (d, t), place in seen.items():
        for n, line in enumerate(t.split("\n")):
            if line.strip():
                all_lines.append((d, t, n, line, (*place, n)))
                first[line] = min(first.get(line, (*place, n)), (*place, n))
    fit = [x for x in first if len(x.encode()) >= least]
    late = set()
    for a in fit:
        late |= {a for b in fit if a != b and first[b] < first[a] and abs(len(a.encode()) - len(b.encode())) <= limit and edits(a.encode(), b.encode()) <= limit}
    exact, near = {}, {}
    for d, t, n, line, place in all_lines:
        if place != first[line]:
            exact.setdefault((d, t), []).append(n)
        elif line in late:
            near.setdefault((d, t), []).append(n)
    return exact, near


def test_lines_equal_brute_force(spark):
    rows = line_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as line", "2 as length", "3 as n", "4 as first").repartition(3)
    exact, near = brute_repeats(rows)
    assert near and exact
    want = sorted(
        (str(d), 0 if t is None else len(t.split("\n")), len(exact.get((d, t), [])), len(near.get((d, t), [])), ",".join(map(str, sorted(exact.get((d, t), []) + near.get((d, t), [])))))
        for d, t in rows
    )
    got = lines.line_digests(df).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == want
    kept = lines.dedup(df.selectExpr("*", "5 as n_chars"))
    clean = {}
    for d, t in rows:
        gone = exact.get((d, t), []) + near.get((d, t), [])
        left = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone)
        if not gone or left.strip():
            clean.setdefault(str(d), []).append((left, len(left) if gone else 5))
    got = {}
    for r in kept.collect():
        got.setdefault(str(r["doc_id"]), []).append((r["text"], r["n_chars"]))
    key = lambda x: (x[0] is None, x)
    assert {k: sorted(v, key=key) for k, v in got.items()} == {k: sorted(v, key=key) for k, v in clean.items()}


def test_lines_of_odd_and_empty_tables(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    exact, _ = brute_repeats(rows, 0, 10**9)
    got = lines.line_digests(odd).collect()
    assert len(got) == len(rows)
    assert sum(r["n_exact"] for r in got) == sum(len(exact.get(r, [])) for r in rows)
    assert lines.dedup(odd).columns == odd.columns
    assert lines.line_digests(empty).count() == 0 and lines.dedup(empty).count() == 0


def test_nothing_in_empty_tables(empty):
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0
    assert sketches.compare_with_edit(empty).count() == 0

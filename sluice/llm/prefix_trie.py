"""Operator 13: prefix trie of rebuilt conversations by composable fingerprints.

A rebuilt conversation is a head, the first turns of its base conversation, and
a tail, its own turns after the first few.  Its texts are never put together.
Each stored conversation has one prefix product for each turn, and these
compose: over the elements ``(n, s)`` - ``n`` turns with ``s`` the sum of turn
value times ``BASE ** position`` modulo a prime - the product ``(n, s) (m, t) =
(n + m, s + BASE ** n * t)`` is associative, with ``(0, 0)`` neutral, and a part
is the quotient of two prefixes.  So the fingerprint of a rebuilt prefix is the
base's product at the head, and the quotient of two own products moved behind
it: a few multiplications, whatever the texts' lengths.  Four primes of 31 bits
make up a fingerprint.

Rebuilt prefixes of equal depth and fingerprint are one node.  Equality is
verified, not trusted: every turn refers to the stored turn of equal role and
text (texts grouped whole, once for each different one), and the members of a
node must agree in the fingerprint of their parent and in the turn referred to;
by induction over the depth they are then equal.  If any group fails, the work
is done again with other constants.

The trie is cut into one path for each conversation: the nodes of which it is
the smallest member, which are consecutive.  Sums over subtrees are sums over
the paths hanging on a path: pointer doubling over paths (rounds grow with the
logarithm of the nesting), then a running sum up each path, cut where a path is
long (``rolling.running_aggregate``).

The ids of conversations that end at a node are hashed as one sequence: they
are joined in blocks of ``IDS`` ids by Spark, and the blocks of a node streamed
in order through one digest with bounded memory.

Defined results: rows with a null conversation id belong to no conversation;
null roles and texts are empty; turns are ordered by turn (null first), equal
turn numbers by role and text; repeated rows are further turns; a base that
is absent gives no head; an empty table gives no nodes; other columns are left
out.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import map_batches, materialize
from sluice.operators.rolling import running_aggregate, with_blocks

FAMILY = 5
HEADS = 9
IDS = 8192
#: The four largest primes below 2**31.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
#: Trials with other constants before giving up.
TRIALS = 4
S = [f"s{k}" for k in range(4)]
V = [f"v{k}" for k in range(4)]


def _bases(trial: int) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"base {trial} {k}".encode()).digest()[:8], "big") % (p - 1000) + 500 for k, p in enumerate(PRIMES)]


def _powers(at: Column, bases: list[int]) -> Column:
    """``array`` of the bases to the power ``at`` (a count below 2**40)."""
    squares = F.array(*[F.array(*[F.lit(pow(b, 1 << i, p)).cast("long") for b, p in zip(bases, PRIMES)]) for i in range(40)])

    def step(out: Column, i: Column) -> Column:
        times = F.transform(out, lambda x, k: x * F.get(F.get(squares, i), k) % F.get(F.array(*[F.lit(p).cast("long") for p in PRIMES]), k))
        return F.when(F.getbit(at, i) == 1, times).otherwise(out)

    ones = F.array(*[F.lit(1).cast("long")] * 4)
    return F.aggregate(F.sequence(F.lit(0), F.length(F.bin(at)) - 1), ones, step)


def _heads(conv_id: Column) -> Column:
    return F.pmod(F.crc32(conv_id.cast("string")), F.lit(HEADS)).cast("int")


def _turns(df: DataFrame, trial: int) -> DataFrame:
    """One row a turn: its conversation, order, size and two digests."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    d = df.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text("role").alias("role"), text("text").alias("text"))
    digests = [F.xxhash64(F.lit(2 * trial + k), "role", "text").alias(f"d{k}") for k in range(2)]
    return d.select("*", F.octet_length("text").cast("long").alias("bytes"), *digests)


def _ties(turns: DataFrame) -> DataFrame | None:
    """Where turns of one number differ, their order by role and text."""
    own = F.struct("d0", "d1")
    tied = turns.groupBy("conv_id", "turn").agg(F.min(own).alias("a"), F.max(own).alias("z")).filter("a <> z").select("conv_id", F.col("turn").alias("tied"))
    tied = materialize(tied, "tied-turns")
    if tied.isEmpty():
        return None
    same = (turns["conv_id"] == tied["conv_id"]) & turns["turn"].eqNullSafe(tied["tied"])
    texts = turns.join(tied, same, "left_semi").select("conv_id", "turn", "role", "text", "d0", "d1").distinct()
    return running_aggregate(texts, ["conv_id", "turn"], "role", [("tie", "count", F.lit(1))], tiebreak=["text"]).select("conv_id", "turn", "d0", "d1", "tie")


def _one_text_each(turns: DataFrame) -> bool:
    """Whether all turns of equal digests have one role and one text, so that a
    digest names a stored turn."""
    texts = turns.select("d0", "d1", "role", "text").distinct()
    return texts.groupBy("d0", "d1").count().filter("count > 1").isEmpty()


def prefix_products(df: DataFrame, trial: int = 0) -> DataFrame:
    """``conv_id, pos`` (from 1), ``bytes, d0, d1``, the turn's own terms ``v*``
    and the products ``s*`` up to it, for every stored turn."""
    turns = _turns(df, trial)
    ties = _ties(turns)
    turns = turns.select("conv_id", "turn", "bytes", "d0", "d1")
    if ties is None:
        turns = turns.withColumn("tie", F.lit(0).cast("long"))
    else:
        of = ties.select(*[F.col(c).alias(f"t_{c}") for c in ("conv_id", "turn", "d0", "d1")], "tie")
        same = (turns["conv_id"] == of["t_conv_id"]) & turns["turn"].eqNullSafe(of["t_turn"]) & (turns["d0"] == of["t_d0"]) & (turns["d1"] == of["t_d1"])
        turns = turns.join(of, same, "left").select(*turns.columns, F.coalesce("tie", F.lit(0).cast("long")).alias("tie"))
    order = ["tie", "d0", "d1"]
    turns, _, is_cut = with_blocks(turns, ["conv_id"], "_cut", "turn", order)
    block = "_cut" if is_cut else None
    numbered = running_aggregate(turns, ["conv_id"], "turn", [("pos", "count", F.lit(1))], tiebreak=order, block=block)
    powers = numbered.withColumn("_p", _powers(F.col("pos"), _bases(trial)))
    terms = [(F.pmod(F.col(f"d{k // 2}"), F.lit(p)) + 1) % p * F.get("_p", F.lit(k)) % p for k, p in enumerate(PRIMES)]
    valued = powers.withColumns(dict(zip(V, terms))).drop("_p")
    summed = running_aggregate(valued, ["conv_id"], "turn", [(s, "sum", F.col(v)) for s, v in zip(S, V)], tiebreak=order, block=block)
    return materialize(summed.select("conv_id", "pos", "bytes", "d0", "d1", *V, *[(F.col(s) % p).alias(s) for s, p in zip(S, PRIMES)]), "prefix-products")


def _pair(parts: list[Column]) -> list[Column]:
    """Four values of 31 bits in two longs."""
    return [parts[0] * (1 << 31) + parts[1], parts[2] * (1 << 31) + parts[3]]


def rebuilt_prefixes(products: DataFrame, trial: int = 0) -> DataFrame:
    """``conv_id, depth``, fingerprint ``f0, f1``, its parent's ``p0, p1``, the
    last turn's ``bytes, d0, d1`` and whether it ``ends`` the conversation, for
    every prefix of every rebuilt conversation."""
    own = products.groupBy("conv_id").agg(F.max("pos").alias("n"))
    own = own.withColumn("h", _heads(F.col("conv_id"))).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    # A conversation's first turns, at most HEADS - 1, with their products.
    first = products.filter(F.col("pos") < HEADS)
    cells = F.sort_array(F.collect_list(F.struct("pos", "bytes", "d0", "d1", *V, *S)))
    firsts = first.groupBy("conv_id").agg(cells.alias("first"))
    heads = own.join(firsts, "conv_id")
    of_base = heads.select(F.col("conv_id").alias("base"), F.col("first").alias("head"))
    convs = heads.join(of_base, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.array().cast(of_base.schema["head"].dataType)), F.lit(1), F.col("h")))
    before = F.get("first", F.col("h") - 1)  # own product before the tail
    after = F.get("head", F.size("head") - 1)
    convs = convs.select(
        "conv_id", "h", "head", F.size("head").alias("k"), (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long").alias("size"),
        *[F.coalesce(before[s], F.lit(0).cast("long")).alias(f"b_{s}") for s in S], *[F.coalesce(after[s], F.lit(0).cast("long")).alias(f"a_{s}") for s in S],
    )
    convs = materialize(convs, "rebuilt")
    head = convs.select("conv_id", "size", F.explode("head").alias("t")).select("conv_id", "size", F.col("t.pos").alias("depth"), *[f"t.{c}" for c in ("bytes", "d0", "d1", *V, *S)])
    tail = products.join(convs.drop("head"), "conv_id").filter("pos > h")
    # BASE ** (k - h): a tail moves forward by what its head lacks.
    back = [F.array(*[F.lit(pow(b, -i, p)).cast("long") for i in range(HEADS)]) for b, p in zip(_bases(trial), PRIMES)]
    by = [F.get(x, F.col("h") - F.col("k")) for x in back]
    moved = [F.pmod(F.col(f"a_{s}") + F.pmod(F.col(s) - F.col(f"b_{s}"), F.lit(p)) * m, F.lit(p)).alias(s) for s, m, p in zip(S, by, PRIMES)]
    term = [(F.col(v) * m % p).alias(v) for v, m, p in zip(V, by, PRIMES)]
    tail = tail.select("conv_id", "size", (F.col("k") + F.col("pos") - F.col("h")).alias("depth"), "bytes", "d0", "d1", *term, *moved)
    parent = [F.pmod(F.col(s) - F.col(v), F.lit(p)) for s, v, p in zip(S, V, PRIMES)]
    f, p = _pair([F.col(s) for s in S]), _pair(parent)
    turns = head.unionByName(tail).select("conv_id", "size", "depth", f[0].alias("f0"), f[1].alias("f1"), p[0].alias("p0"), p[1].alias("p1"), "bytes", "d0", "d1")
    nothing = F.lit(0).cast("long")
    root = convs.select("conv_id", "size", nothing.alias("depth"), *[nothing.alias(c) for c in ("f0", "f1", "p0", "p1", "bytes", "d0", "d1")])
    return turns.unionByName(root).withColumn("ends", F.col("depth") == F.col("size")).drop("size")


def _ends(prefixes: DataFrame) -> DataFrame:
    """``depth, f0, f1, ends_sha256`` of nodes at which conversations end."""
    at = prefixes.filter("ends")
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))  # at most IDS of them
    blocks = at.groupBy("depth", "f0", "f1", F.floor(F.col("conv_id") / IDS).alias("block")).agg(F.array_join(ids, ",").alias("ids"))

    def run(batches):
        key, digest = None, None
        for b in batches:
            rows = zip(*(b.column(i).to_pylist() for i in range(3)), b.column(4))
            out = []
            for *at, ids in rows:
                if at != key:
                    if key:
                        out.append((*key, digest.hexdigest()))
                    key, digest = at, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.as_py().encode())
            yield _rows(out)
        if key:
            yield _rows([(*key, digest.hexdigest())])

    def _rows(out):
        cols = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.string()])], ["depth", "f0", "f1", "ends_sha256"])

    dealt = blocks.select("depth", "f0", "f1", "block", "ids").repartition("depth", "f0", "f1").sortWithinPartitions("depth", "f0", "f1", "block")
    return map_batches(dealt, run, "depth long, f0 long, f1 long, ends_sha256 string")


def _path_totals(paths: DataFrame) -> DataFrame:
    """``conv_id, leaves, saved`` of whole paths (``conv_id, up, leaves,
    saved``) with all that hangs on them, by pointer doubling: after round k the
    sums reach 2**k paths down."""
    now = materialize(paths, "paths")
    while not now.filter("up IS NOT NULL").isEmpty():
        given = now.filter("up IS NOT NULL").groupBy(F.col("up").alias("conv_id")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        above = now.select(F.col("conv_id").alias("up"), F.col("up").alias("next"))
        more = now.join(given, "conv_id", "left").join(above, "up", "left")
        none = F.lit(0).cast("long")
        now = materialize(more.select("conv_id", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("l", none)).alias("leaves"), (F.col("saved") + F.coalesce("s", none)).alias("saved")), "paths")
    return now.select("conv_id", "leaves", "saved")


def nodes(df: DataFrame) -> DataFrame:
    """The trie over ``df`` (``conv_id, turn, role, text``): a row a node."""
    for trial in range(TRIALS):
        if not _one_text_each(_turns(df, trial)):
            continue
        prefixes = rebuilt_prefixes(prefix_products(df, trial), trial)
        same = ["p0", "p1", "d0", "d1"]
        found = prefixes.groupBy("depth", "f0", "f1").agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("bytes").alias("bytes"), *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"z_{c}") for c in same]
        )
        found = materialize(found, "nodes")
        if found.filter(" OR ".join(f"{c} <> z_{c}" for c in same)).isEmpty():
            return _summed(found.drop(*same[2:], *[f"z_{c}" for c in same]), prefixes)
    raise RuntimeError(f"prefixes of unequal turns had equal fingerprints in {TRIALS} trials")


def _summed(found: DataFrame, prefixes: DataFrame) -> DataFrame:
    own = found.withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes"))
    # One path for each conversation that is the smallest of some node.
    path = own.groupBy("conv_id").agg(F.min(F.struct("depth", "p0", "p1")).alias("top"), F.max("depth").alias("last"), F.sum("saved").alias("saved"))
    path = path.select("conv_id", F.col("top.depth").alias("first"), "last", "saved", (F.col("top.depth") - 1).alias("depth"), F.col("top.p0").alias("f0"), F.col("top.p1").alias("f1"))
    hung = path.filter("first > 0").join(found.select("depth", "f0", "f1", F.col("conv_id").alias("up")), ["depth", "f0", "f1"])
    hung = materialize(hung.select("conv_id", "up", F.col("depth").alias("at")), "hung")
    hangs_last = path.join(hung.select(F.col("up").alias("conv_id"), F.col("at").alias("last")).distinct().withColumn("more", F.lit(True)), ["conv_id", "last"], "left")
    leaf = F.when(F.col("more"), 0).otherwise(1).cast("long")
    paths = hangs_last.select("conv_id", leaf.alias("leaves"), "saved", "first", "last").join(hung, "conv_id", "left")
    paths = materialize(paths, "path-ends")
    totals = _path_totals(paths.select("conv_id", "up", "leaves", "saved"))
    below = hung.join(totals, "conv_id").groupBy(F.col("up").alias("conv_id"), F.col("at").alias("depth"))
    below = below.agg(F.count(F.lit(1)).alias("hanging"), F.sum("leaves").alias("b_leaves"), F.sum("saved").alias("b_saved"))
    d = own.drop("p0", "p1").join(paths.select("conv_id", "first", "last", "up"), "conv_id").join(below, ["conv_id", "depth"], "left")
    none = F.lit(0).cast("long")
    hanging = F.coalesce("hanging", none)
    goes_on = F.col("depth") < F.col("last")
    d = d.select(
        "conv_id", "depth", "f0", "f1", "n_convs", F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("up")).alias("parent_conv_id"),
        (hanging + goes_on.cast("long")).alias("n_children"), (-F.col("depth")).alias("_down"),
        (F.coalesce("b_leaves", none) + F.when(goes_on | (hanging > 0), 0).otherwise(1)).alias("_leaves"), (F.col("saved") + F.coalesce("b_saved", none)).alias("_saved"),
    )
    d = running_aggregate(d, ["conv_id"], "_down", [("n_leaves", "sum", F.col("_leaves")), ("saved_tokens", "sum", F.col("_saved"))])
    ends = _ends(prefixes)
    nobody = hashlib.sha256(b"").hexdigest()
    out = d.join(ends, ["depth", "f0", "f1"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nobody)))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

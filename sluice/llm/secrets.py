"""Operator 4: secret scan with multipart credential linking, in expressions.

``scan`` cuts each text at the matches of every kind (one pass a kind, only
where the kind occurs).  The lengths of what lies between give the positions,
by a running sum within the document.

Base kinds are reported wherever they stand.  Weak kinds - a named user or
client, an opaque value, an address - are too common to report alone.  They
are reported only if a complementary part stands within ``SCOPE`` code points
in the same document, found by an interval join on (document, bucket of the
position): a name needs a secret, an opaque value needs an access identifier
or a name, an address needs an access identifier or an assigned secret.  A weak
span that a base span covers whole is none; one that merely holds or touches a
base span stays, and that span counts as a part.  The later of two spans is in
one bucket, looked up from those that the earlier one reaches, so a document
with many parts is compared only locally.

Defined results: null text is the empty text (no spans); a null id is a
document like any other; rows equal in id and text get equal results; spans
that start together go by kind; an empty table gives no rows; other columns
are left out by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import materialize, null_safe

# Kinds, patterns and the least length of group 1 (`least`).
BASE = {
    "assign": (r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 12),
    "access": (r"(AKIA[A-Z0-9]+)", 18),
    "hex": (r"([0-9a-f]+)", 16),
}
WEAK = {
    "name": (r"(?i)(?:user_?name|user|login|client_?id|account_?id)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9_.@-]+)", 3),
    "opaque": (r"([A-Za-z0-9+/_-]{20,})", 20),
    "address": (r"(?i)([a-z][a-z0-9+.-]*://[^\s\"'<>]+)", 8),
}
KINDS = {**BASE, **WEAK}
# A text without a match of its kind's gate has no span of the kind.
GATES = {
    "assign": r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
    "access": r"AKIA[A-Z0-9]{14}",
    "hex": r"[0-9a-f]{16}",
    "name": r"(?i)(?:user_?name|user|login|client_?id|account_?id)[\"']?\x20*[:=]",
    "opaque": r"[A-Za-z0-9+/_-]{20}",
    "address": r"://",
}
PARTNERS = {"name": ("assign", "hex", "opaque"), "opaque": ("access", "name"), "address": ("access", "assign")}
SCOPE = 300
_DOC = ["doc_id", "text_hash"]


def _cut(text: Column, kind: str) -> Column:
    """Between two matches: ``gap`` code points, then a match of ``size`` code
    points whose value has ``value`` of them; null without a match."""
    pattern, _ = KINDS[kind]
    whole, value = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    gaps = F.split(text, pattern, -1)
    zipped = F.zip_with(whole, value, lambda w, v: F.struct(F.length(w).alias("size"), F.length(v).alias("value"), F.when(F.lit(kind == "opaque"), w).alias("match")))
    rows = F.zip_with(zipped, F.slice(gaps, 1, F.size(zipped)), lambda m, g: F.struct(F.length(g).alias("gap"), m["size"].alias("size"), m["value"].alias("value"), m["match"].alias("match")))
    return F.when(text.rlike(GATES[kind]), rows)


def _cuts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), *[_cut(text, k).alias(k) for k in KINDS])


def _positions(cuts: DataFrame) -> DataFrame:
    """``doc_id, text_hash, kind, rank, start, end, match`` of all matches that
    are long enough."""
    some = cuts.filter(F.coalesce(*KINDS).isNotNull()).dropDuplicates(_DOC)
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(i).alias("rank"), F.lit(KINDS[k][1]).alias("least"), F.col(k).alias("cut")) for i, k in enumerate(KINDS)])
    each = some.select(*_DOC, F.explode(kinds).alias("k")).select(*_DOC, "k.kind", "k.rank", "k.least", F.posexplode("k.cut").alias("i", "c"))
    so_far = Window.partitionBy(*_DOC, "rank").orderBy("i")
    end = F.sum(F.col("c.gap").cast("long") + F.col("c.size")).over(so_far)
    spans = each.select(*_DOC, "kind", "rank", (end - F.col("c.size")).alias("start"), end.alias("end"), F.col("c.match").alias("match"), (F.col("c.value") >= F.col("least")).alias("long"))
    return spans.filter("long").drop("long")


def _candidates(spans: DataFrame) -> DataFrame:
    """Base spans, and weak spans that no base span covers whole; an opaque
    value has letters and digits.  One running maximum in order of the starts:
    time grows with the number of spans of a document, not with its square."""
    base = F.col("rank") < len(BASE)
    order = Window.partitionBy(*_DOC).orderBy("start", "rank")
    before = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    covered = F.coalesce(before, F.lit(-1)) >= F.col("end")
    mixed = (F.col("kind") != "opaque") | F.col("match").rlike("[0-9]") & F.col("match").rlike("[A-Za-z]")
    return spans.withColumn("covered", covered).filter(base | ~F.col("covered") & mixed).drop("covered", "match")


def _links(spans: DataFrame, scope: int) -> DataFrame:
    """Weak spans with each complementary part in scope.  A part stands clear
    of the weak span, or is a base span that overlaps it: the later of the two
    starts within the earlier one or at most ``scope`` behind it, and is looked
    up in the buckets that the earlier one reaches."""
    wanted = F.lit(False)
    for weak, partners in PARTNERS.items():
        wanted = wanted | (F.col("kind") == weak) & F.col("p_kind").isin(*partners)
    weak = spans.filter(F.col("rank") >= len(BASE))
    part = spans.select(*[F.col(c).alias(f"p_{c}") for c in spans.columns])

    def joined(early: str, late: str) -> DataFrame:
        e = F.expr(f"explode(sequence({early}start div {scope}, {early}end div {scope} + 1))").alias("bucket")
        l = F.expr(f"{late}start div {scope}").alias("bucket_of")  # noqa: E741
        w = weak.select("*", e if early == "" else l)
        p = part.select("*", l if early == "" else e)
        clear = F.col(f"{late}start") >= F.col(f"{early}end")
        follows = F.col(f"{late}start") >= F.col(f"{early}start") if early == "" else F.col(f"{late}start") > F.col(f"{early}start")
        near = follows & (F.col(f"{late}start") <= F.col(f"{early}end") + scope) & (clear | (F.col("p_rank") < len(BASE)))
        same = F.col("doc_id").eqNullSafe(F.col("p_doc_id")) & (F.col("text_hash") == F.col("p_text_hash"))
        return w.join(p, same & (F.col("bucket") == F.col("bucket_of")) & near & wanted).drop("bucket", "bucket_of", "p_doc_id", "p_text_hash")

    return joined("", "p_").unionByName(joined("p_", ""))


def scan(docs: DataFrame, scope: int = SCOPE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three frames: one row a document (``doc_id, text_hash``), its reported
    spans (``doc_id, text_hash, kind, rank, start, end``), and the links of the
    weak ones to their parts (``p_kind, p_rank, p_start, p_end``)."""
    cuts = materialize(_cuts(docs), "secret-cuts")
    spans = materialize(_candidates(_positions(cuts)), "secret-spans")
    links = _links(spans, scope)
    reported = links.select(*_DOC, "kind", "rank", "start", "end").distinct()
    return cuts.select(*_DOC), spans.filter(F.col("rank") < len(BASE)).unionByName(reported), links


def span_digests(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``, one row for
    each row of ``docs``."""
    rows, spans, _ = scan(docs, scope)
    text = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    listed = lambda keep: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(keep, F.struct("start", "rank", text.alias("text"))))), lambda s: s["text"]), ",")
    of_doc = spans.groupBy(*_DOC).agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(F.col("rank") < len(BASE)), 256).alias("base_sha256"),
        listed(F.lit(True)).alias("spans"),
    )
    none = {f"n_{k}": F.lit(0).cast("long") for k in BASE} | {"base_sha256": F.sha2(F.lit(""), 256), "spans": F.lit("")}
    return null_safe(rows, of_doc, _DOC).select("doc_id", *[F.coalesce(F.col(c), v).alias(c) for c, v in none.items()])


def redact(docs: DataFrame, mark: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """``docs`` with every reported span replaced by ``mark`` and ``n_chars``,
    where there is one, counted anew; rows without spans stay as they are."""
    _, spans, _ = scan(docs, scope)
    order = Window.partitionBy(*_DOC).orderBy("start", "rank")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = (F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("int")
    runs = spans.withColumn("opens", opens).withColumn("run", F.sum("opens").over(order)).groupBy(*_DOC, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    before = F.coalesce(F.lag("end").over(Window.partitionBy(*_DOC).orderBy("start")), F.lit(0))
    of_doc = runs.withColumn("before", before).groupBy(*_DOC).agg(F.array_sort(F.collect_list(F.struct("start", "end", "before"))).alias("runs"))
    keyed = docs.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    both = null_safe(keyed, of_doc, _DOC)
    kept = F.transform("runs", lambda r: F.concat(F.substr(F.col("text"), (r["before"] + 1).cast("int"), (r["start"] - r["before"]).cast("int")), F.lit(mark)))
    tail = F.substr(F.col("text"), (F.element_at("runs", -1)["end"] + 1).cast("int"))
    both = both.withColumn("text", F.when(F.col("runs").isNotNull(), F.concat(F.array_join(kept, ""), tail)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        both = both.withColumn("n_chars", F.when(F.col("runs").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return both.select(*docs.columns)

"""Operator 12: URL filter by rules and a logistic regression on hashed
character n-grams of host and path.

A url is split into host and path by expressions.  The longest rule that fits
decides.  Where none fits, the model decides: the n-grams of the host and of
the path, each between a mark for its ends, are hashed into ``BUCKETS`` weights
(a polynomial in the code points, so that any SQL engine can repeat it); host
and path weigh alike whatever their lengths.

The model is trained from a small labelled table of urls, of which at most
``LABELLED`` distinct rows (chosen by hash) are used: full-batch gradient
descent with momentum, a fold over the epochs on one row that holds the labelled urls' grams
and, for each bucket, the urls that have it.  Everything is an expression; the
urls judged are never shuffled, grouped or sent to Python.

Defined results: a null url, or one without ``://``, has an empty host and an
empty path, and the model's verdict for these; every row of the table is judged
by itself, so repeated rows and null ids stay as they are; a url of any length is read
whole, in time linear in it; an empty table gives no rows; an empty labelled
table gives a model that allows everything; of two rules of one length the one
with the longer host wins, and a blocking one before an allowing one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 4093
GRAMS = (3, 4)
EPOCHS = 100
RATE = 1.0
MOMENTUM = 0.95
DECAY = 0.0003
LABELLED = 4096
FACTOR = 263

#: The rules of the query (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: The labelled table: names of hosts to block and to allow.
BLOCKED_NAMES = (
    "adult xxx-adult adult-videos adult-cams ads ads-server adserver track-ads bets sport-bets bets-online bet-now casino "
    "casino-royal online-casino jackpot jackpot-win slots free-slots poker poker-win lottery pills diet-pills pills-online "
    "viagra cheap-viagra pharma-cheap spam spam-links spam-blast linkfarm popunder clickbait free-money cash-prize "
    "payday-loan quick-loan keygen warez cracked-apps torrent-free replica-watches phish-login malware-drop hot-dates"
).split()
ALLOWED_NAMES = (
    "news morning-news daily-post blog my-blog travel-blog docs wiki library city-library museum school university "
    "science physics history garden recipes kitchen travel music orchestra weather forum support market bookshop "
    "journal magazine photo gallery family church court bank energy nature river mountain software project research "
    "health clinic hospital farm organic-farm winter window teaching theatre brother other nation station nationality "
    "than rather weather-data thesis worth earth action fiction nothing something shop workshop free-software open-data"
).split()


def _without_upper(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """``df`` with ``host`` and ``path``: what lies between the first ``://``
    and the next ``/``, ``?``, ``#`` or end, A-Z lower-cased; then up to ``?``,
    ``#`` or end."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substr(F.col(url), at + 3))
    host = F.coalesce(_without_upper(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return df.withColumns({"host": host, "path": path})


def rule_that_fits(rules: Sequence[tuple[str, str, str]]) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits ``host`` and
    ``path``, null if none does.  The rules are few, an argument."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block", r))
    fits = [(F.col("host") == h) | F.endswith("host", F.lit("." + h)) for _, h, _ in longest]
    found = [F.when(f & F.startswith("path", F.lit(p)), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for f, (v, h, p) in zip(fits, longest)]
    return F.coalesce(*found, F.lit(None).cast("struct<rule:string,verdict:string>"))


def _buckets(text: Column, mark: int) -> Column:
    """The distinct buckets of the n-grams of ``text`` between two marks; all
    digits count as one."""
    chars = F.filter(F.split(F.translate(text, "123456789", "000000000"), ""), lambda c: c != "")
    codes = F.concat(F.array(F.lit(mark)), F.transform(chars, lambda c: F.ascii(c)), F.array(F.lit(mark)))

    def of(codes: Column, n: int) -> Column:
        starts = F.when(F.size(codes) >= n, F.sequence(F.lit(0), F.size(codes) - n)).otherwise(F.array().cast("array<int>"))

        def gram(i: Column) -> Column:
            h = F.lit(mark * FACTOR + n).cast("long")
            for k in range(n):
                h = (h * FACTOR + F.get(codes, i + k)) % BUCKETS
            return h.cast("int")

        return F.transform(starts, gram)

    return _let(codes, lambda c: F.array_distinct(F.concat(*[of(c, n) for n in GRAMS])))


def with_grams(df: DataFrame) -> DataFrame:
    """``host_grams`` and ``path_grams`` of ``host`` and ``path``."""
    return df.withColumns({"host_grams": _buckets(F.col("host"), 1), "path_grams": _buckets(F.col("path"), 2)})


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _share(grams: str) -> Column:
    return 1 / F.sqrt(F.greatest(F.size(grams), F.lit(1)).cast("double"))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``url, blocked``: a small labelled table, urls of ordinary forms under
    the names above."""
    parts = []
    for names, blocked in ((BLOCKED_NAMES, True), (ALLOWED_NAMES, False)):
        names = F.explode(F.array(*[F.lit(n) for n in names]))
        parts.append(spark.range(1).select(names.alias("name"), F.lit(blocked).alias("blocked")))
    named = parts[0].unionByName(parts[1])
    i = F.pmod(F.xxhash64("name"), F.lit(1 << 20))
    pick = lambda choices, of: F.get(F.array(*[F.lit(x) for x in choices]), F.pmod(of, F.lit(len(choices))).cast("int"))
    host = lambda k: F.concat(pick(["", "www.", "m.", "blog."], i + k), "name", F.lit(".example."), pick(["com", "org", "net"], i + k))
    paths = [
        F.concat(F.lit("/"), pick(["en", "fr", "de", "es"], F.floor(i / 16)), F.lit("/"), i.cast("string")),
        F.concat(F.lit("/"), "name", F.lit("/"), i.cast("string"), F.lit(".html")),
        F.lit("/"),
    ]
    return named.select(F.explode(F.array(*[F.concat(F.lit("https://"), host(k), p) for k, p in enumerate(paths)])).alias("url"), "blocked")


def train(labelled: DataFrame, epochs: int = EPOCHS, rate: float = RATE, decay: float = DECAY) -> DataFrame:
    """One row: ``bias double, weights array<double>``."""
    rows = with_grams(with_parts(labelled.select("url", "blocked").distinct().orderBy(F.xxhash64("url"), "url", "blocked").limit(LABELLED)))
    value = lambda grams: F.transform(grams, lambda g: F.struct(g.alias("g"), _share(grams).alias("v")))
    each = rows.filter("blocked is not null").select(F.concat(value("host_grams"), value("path_grams")).alias("f"), F.col("blocked").cast("double").alias("y"))
    # the labelled urls in one row: bounded by LABELLED
    table = each.agg(F.array_sort(F.collect_list(F.struct("y", "f"))).alias("urls"))
    numbered = table.select(F.posexplode("urls").alias("u", "url")).select("u", F.explode("url.f").alias("f"))
    having = numbered.groupBy("f.g").agg(F.array_sort(F.collect_list(F.struct("u", F.col("f.v").alias("v")))).alias("having"))
    every = labelled.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("g")).join(having, "g", "left")
    none = F.array().cast("array<struct<u:int,v:double>>")
    inverted = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("g", F.coalesce("having", none).alias("having")))), lambda b: b["having"]).alias("inverted"))
    # the two single rows side by side
    both = table.unionByName(inverted, allowMissingColumns=True).agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("urls", "inverted")])
    n = F.greatest(F.size("urls"), F.lit(1))

    def epoch(model: Column, _: Column) -> Column:
        def missed(url: Column) -> Column:
            margin = F.aggregate(url["f"], model["bias"], lambda a, f: a + F.get(model["weights"], f["g"]) * f["v"])
            return (1 / (1 + F.exp(-margin)) - url["y"]) * (rate / n)

        def moved(miss: Column) -> Column:
            to = F.transform(
                F.col("inverted"),
                lambda urls, g: MOMENTUM * F.get(model["speed"], g) - F.get(model["weights"], g) * (rate * decay) - F.aggregate(urls, F.lit(0.0), lambda a, p: a + F.get(miss, p["u"]) * p["v"]),
            )
            of_bias = MOMENTUM * model["bias_speed"] - F.aggregate(miss, F.lit(0.0), lambda a, m: a + m)
            return _let(
                F.struct(of_bias.alias("b"), to.alias("w")),
                lambda s: F.struct((model["bias"] + s["b"]).alias("bias"), s["b"].alias("bias_speed"), F.zip_with(model["weights"], s["w"], lambda w, v: w + v).alias("weights"), s["w"].alias("speed")),
            )

        return _let(F.transform(F.col("urls"), missed), moved)

    zeros = F.array_repeat(F.lit(0.0), BUCKETS)
    start = F.struct(F.lit(0.0).alias("bias"), F.lit(0.0).alias("bias_speed"), zeros.alias("weights"), zeros.alias("speed"))
    return both.select(F.aggregate(F.sequence(F.lit(1), F.lit(epochs)), start, epoch).alias("m")).select("m.bias", "m.weights")


def judge(df: DataFrame, model: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url: str = "url") -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule``, ``verdict`` and the model's
    ``score`` (the probability of a url to block).  ``model`` is one row, read
    as a scalar."""
    d = with_parts(df.drop("host", "path", "rule", "verdict", "score", "host_grams", "path_grams"), url)
    fit = rule_that_fits(rules)
    one = model.select(F.struct("bias", "weights").alias("model")).scalar()

    def score(m: Column) -> Column:
        total = lambda grams: F.aggregate(grams, F.lit(0.0), lambda a, g: a + F.get(m["weights"], g)) * _share(grams)
        return 1 / (1 + F.exp(-(m["bias"] + total("host_grams") + total("path_grams"))))

    d = with_grams(d.withColumns({"_fit": fit, "_model": one}))
    d = d.withColumn("score", score(F.col("_model"))).drop("_model")
    verdict = F.coalesce("_fit.verdict", F.when(F.col("score") > 0.5, "block").otherwise("allow"))
    return d.withColumns({"rule": F.col("_fit.rule"), "verdict": verdict}).drop("_fit", "host_grams", "path_grams")

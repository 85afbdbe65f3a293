"""Operator 6: language identification by averaged hashed subword embeddings.

A text is the mean of the embeddings of its subwords: the byte 2-, 3- and
4-grams of its lower-cased words and word edges, hashed to ``2 ** BITS``
buckets.  A linear softmax on the mean gives the language.  Embeddings and
softmax are trained together by stochastic gradient descent in numpy on a
bounded sample of labelled documents (``SAMPLE`` documents in all, an equal
share for each language, one document at least, chosen by a hash of the id;
each counts by its whole text).  A tenth of the sample is kept from training.
Its texts, and excerpts of them of 1, 2, 4, ... words, set the temperature and
the bounds under which a prediction is rejected: for each length (a power of two
of subwords) the log-odds of the rightly labelled texts have a median and a
hundredth; the bound lies as far below the hundredth as that lies below the
median.  So the bounds come from the spread of clean texts of that length
alone, and hardly any clean text falls under them, however short.

Only text and label of documents outside the held-out fold are learned from.
The model is as large as buckets times languages or ``WIDTH``, whichever is
less; prediction is one pass without a shuffle.

Defined results: null text and text without a letter are ``und`` with score 0
and rejected; documents without an id are held out; without any labelled
document to learn from everything is ``und``; languages that tie go by name;
repeated rows are predicted each; other columns are left out by ``predict``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import map_batches, materialize, text_rows

BITS = 14
WIDTH = 16
SAMPLE = 2400
EPOCHS = 12
BATCH = 16
RATE = 4.0
#: The low quantile of clean log-odds that the bound is set by.
LOW = 0.01
#: Clean texts of a length that make a bound of its own.
ENOUGH = 20
#: Words of the longest excerpts, as a power of two.
EXCERPTS = 7
#: Languages up to which their sizes may be broadcast.
BROADCAST_LANGUAGES = 65_536
UNKNOWN = "und"
FOLDS = 5
BLOCK = 1 << 18

# One multiplier for each n-gram length.
_GRAMS = {2: np.uint32(0x85EBCA6B), 3: np.uint32(0xC2B2AE35), 4: np.uint32(0x9E3779B1)}
_KEEP = np.full(256, 32, np.uint8)
_KEEP[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_KEEP[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_KEEP[128:] = np.arange(128, 256)


def has_letter(text: str | None) -> bool:
    if not text:
        return False
    head = text[:64]  # nearly always enough; else the whole text is searched
    return any(map(str.isalpha, head)) or any(map(str.isalpha, text))


def subword_counts(text: str, bits: int = BITS) -> np.ndarray:
    """How often each bucket's subwords occur in the whole text."""
    raw = _KEEP[np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8)]
    counts = np.zeros(1 << bits, np.int64)
    for at in range(0, max(1, len(raw) - 1), BLOCK):
        a = raw[at : at + BLOCK + 3].astype(np.uint32)
        space = a == 32
        value = a
        for n, factor in _GRAMS.items():
            m = min(len(a) - n + 1, BLOCK)  # windows that begin in this block
            if m < 1:
                break
            value = value[: len(a) - n + 1] | a[n - 1 :] << np.uint32(8 * (n - 1))
            inside = ~space[1:m + 1] if n > 2 else ~(space[:m] | space[1 : m + 1])
            if n == 4:
                inside &= ~space[2 : m + 2]
            hashed = (value[:m][inside] * factor ^ factor) * np.uint32(0x27D4EB2F) >> np.uint32(32 - bits)
            counts += np.bincount(hashed, minlength=1 << bits)
    return counts


def excerpts(text: str) -> list[str]:
    """Two runs of 1, 2, 4, ... words out of a longer text."""
    words, out = text.split(), []
    for k in range(EXCERPTS + 1):
        n = 1 << k
        if len(words) > n:
            out += [" ".join(words[at : at + n]) for at in ((len(words) - n) // 3, 2 * (len(words) - n) // 3)]
    return out


def _level(total: int) -> int:
    return max(0, int(total).bit_length() - 1)


def _log_odds(p: np.ndarray) -> np.ndarray:
    best = np.clip(p.max(axis=-1).astype(np.float64), 1e-12, 1 - 1e-12)
    return np.log(best) - np.log1p(-best)


@dataclass
class Model:
    """Languages by name, weights of the buckets (scores of the languages where
    these are few, else embeddings with ``out``), bias, temperature, and for
    each length the log-odds under which predictions are rejected."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: dict[int, float] = field(default_factory=dict)
    out: np.ndarray | None = None

    def _scores(self, buckets, shares: np.ndarray) -> np.ndarray:
        mean = shares.astype(np.float32) @ self.table[buckets]
        return (mean if self.out is None else mean @ self.out) + self.bias

    def bound(self, total: int) -> float:
        """The bound for a text of ``total`` subwords: of its length, or of the
        next shorter one that has one; shorter texts have none."""
        known = [k for k in self.threshold if k <= _level(total)]
        return self.threshold[max(known)] if known else -np.inf

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether it is rejected."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        counts = subword_counts(text)
        total = int(counts.sum())
        logits = self._scores(slice(None), counts / max(1, total))
        p = _softmax(logits[None].astype(np.float64) / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(len(p) > 1 and _log_odds(p) < self.bound(total))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: list[tuple[str, bool, np.ndarray, np.ndarray]], seed: int = 0) -> Model:
    """``rows``: language, whether kept for calibration, buckets, counts."""
    languages = sorted({r[0] for r in rows if not r[1]})
    label = {name: i for i, name in enumerate(languages)}
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BITS, WIDTH)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (WIDTH, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32)
    learn = [(label[r[0]], r[2].astype(np.int64), (r[3] / r[3].sum()).astype(np.float32)) for r in rows if not r[1] and len(r[2])]
    steps, step = max(1, EPOCHS * -(-len(learn) // BATCH)), 0
    for _ in range(EPOCHS if len(languages) > 1 else 0):
        order = rng.permutation(len(learn))
        for at in range(0, len(order), BATCH):
            batch = [learn[i] for i in order[at : at + BATCH]]
            rate = RATE * (1 - step / steps)
            mean = np.stack([share @ emb[buckets] for _, buckets, share in batch])
            wrong = _softmax(mean @ out + bias)
            wrong[np.arange(len(batch)), [y for y, _, _ in batch]] -= 1
            back = wrong @ out.T
            out -= rate / len(batch) * mean.T @ wrong
            bias -= rate / len(batch) * wrong.sum(axis=0) * 0.1
            for (_, buckets, share), g in zip(batch, back):
                emb[buckets] -= rate * share[:, None] * g  # buckets of a text are distinct
            step += 1
    model = Model(languages, emb @ out, bias) if len(languages) <= WIDTH else Model(languages, emb, bias, out=out)
    kept = [(label[r[0]], int(r[3].sum()), model._scores(r[2].astype(np.int64), r[3] / r[3].sum())) for r in rows if r[1] and r[0] in label and len(r[2])]
    if kept and len(languages) > 1:
        y, levels, z = np.array([k[0] for k in kept]), np.array([_level(k[1]) for k in kept]), np.stack([k[2] for k in kept]).astype(np.float64)
        loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(y)), y] + 1e-9).mean()
        model.temperature = float(min(np.geomspace(0.05, 20, 61), key=loss))
        p = _softmax(z / model.temperature)
        odds, right = _log_odds(p), p.argmax(axis=1) == y
        for level in np.unique(levels):
            clean = odds[right & (levels == level)]
            if len(clean) >= ENOUGH:
                low, middle = np.quantile(clean, [LOW, 0.5])
                model.threshold[int(level)] = float(2 * low - middle)
    return model


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on a bounded sample of the labelled documents outside the
    held-out fold."""
    labelled = docs.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = materialize(labelled.groupBy("lang").count(), "languages")
    n = sizes.count()
    if not n:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0, np.float32))
    want = max(1, sample // n)
    place = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1 << 30))
    rows = labelled.select("doc_id", "lang", "text").join(F.broadcast(sizes) if n <= BROADCAST_LANGUAGES else sizes, "lang")
    share = place < F.lit(1 << 30) * F.least(F.lit(1.0), F.lit(want) / F.col("count"))
    chosen = rows.filter(share).select("lang", (F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(10)) == 0).alias("kept"), F.coalesce("text", F.lit("")).alias("text"))

    def count(batches):
        for b in batches:
            rows = []
            for lang, kept, text in text_rows(b, "lang", "kept", "text"):
                for part in [text, *excerpts(text)] if kept else [text]:
                    if has_letter(part):
                        c = subword_counts(part)
                        at = np.flatnonzero(c)
                        rows.append((lang, kept, at.astype(np.uint32).tobytes(), c[at].astype(np.uint32).tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), (pa.string(), pa.bool_(), pa.binary(), pa.binary()))], ["lang", "kept", "buckets", "counts"])

    rows = map_batches(chosen, count, "lang string, kept boolean, buckets binary, counts binary").collect()
    rows = sorted((r["lang"], r["kept"], bytes(r["buckets"]), bytes(r["counts"])) for r in rows)
    return train([(a, k, np.frombuffer(b, np.uint32), np.frombuffer(c, np.uint32)) for a, k, b, c in rows])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for each row."""

    def run(batches):
        for b in batches:
            rows = [(d, h, *model.predict(t)) for d, h, t in text_rows(b, "doc_id", "held_out", "text")]
            if rows:
                types = (pa.int64(), pa.bool_(), pa.string(), pa.float64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return map_batches(rows, run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def drop_rejected(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose text's language is not
    rejected."""
    ship = docs.schema
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            text = b.column(at)
            good = [not model.predict(text[i].as_py())[2] for i in range(b.num_rows)]
            yield b.filter(pa.array(good, pa.bool_()))

    return map_batches(docs, run, ship)

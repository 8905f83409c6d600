"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

A text's letters, in lower case, with one space for whatever stands between them, are cut into n-grams of
one to three characters, hashed into ``BUCKETS`` columns. A column's value is (1 + ln count) * idf, a row
has length 1. The regression is trained by follow-the-regularised-leader (one adaptive rate a weight)
with an elastic-net penalty, which leaves most weights at exactly 0; then one temperature, fitted on
labelled rows that the weights haven't seen, turns its scores into probabilities.

What is counted covers everything: document frequencies come from all labelled texts (counted in the
tasks, summed by Spark, 65,536 numbers reach the driver). The regression sees a bounded sample:
about ``lang_rows`` rows a language, chosen by hash, for the ``max_langs`` most frequent languages, and
bags (no texts) of at most about ``bag_bytes``. Whole texts are read, in training too, a piece after the
other, so that a long one takes bounded memory.

Results in odd cases: a null text, or one without a letter, is ``und`` with score 0 and teaches nothing; a
row without language or id teaches nothing, and a null id has a null held_out; repeated rows count once in the
sample (the same id and text) and each in the frequencies; ties go to the language that sorts first; without
labelled rows everything is ``und``, with one language everything that has a letter is this, with score
1; extra columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kabuto.llm.common import prepare, written

BUCKETS = 1 << 16
GRAMS = (1, 2, 3)
PIECE = 1 << 20  # characters that are hashed at a time
LANG_ROWS = 1000
MAX_LANGS = 200
BAG_BYTES = 64 << 20
FOLD = 5  # one row of so many is kept for the temperature
UNKNOWN = "und"
_GAPS = re.compile(r"[\W\d_]+")
_MIX = [np.uint32(x) for x in (2654435761, 2246822519, 3266489917)]


def letters(text: str | None) -> str:
    """The text's letters in lower case, a space for all between them and around them; empty if none."""
    kept = _GAPS.sub(" ", text.lower()).strip() if text else ""
    return f" {kept} " if any(map(str.isalpha, kept)) else ""


def _buckets(codes: np.ndarray, n: int) -> np.ndarray:
    """The bucket of every n-gram of a run of code points."""
    size = len(codes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint16)
    h = np.full(size, n * 40503 + 17, np.uint32)
    for k in range(n):
        h = (h ^ codes[k : k + size]) * _MIX[k]
        h ^= h >> np.uint32(15)
    return ((h * _MIX[1]) >> np.uint32(16)).astype(np.uint16)


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text's n-grams, each once and in order, and their counts."""
    kept = letters(text)
    codes = np.frombuffer(kept.encode("utf-32-le"), np.uint32)
    if len(codes) <= PIECE:
        grams = np.sort(np.concatenate([_buckets(codes, n) for n in GRAMS]), kind="stable")
        first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else np.zeros(0, np.int64)
        return grams[first], np.diff(np.append(first, len(grams)))
    counts = np.zeros(BUCKETS, np.int64)
    for n in GRAMS:
        for lo in range(0, len(codes), PIECE):
            counts += np.bincount(_buckets(codes[lo : lo + PIECE + n - 1], n), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found.astype(np.uint16), counts[found]


def weigh(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of a bag, of length 1."""
    x = (1 + np.log(counts)) * idf[buckets]
    return x / max(float(np.sqrt(x @ x)), 1e-12)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # (BUCKETS + 1) x languages; the last row is the bias
    idf: np.ndarray
    temperature: float = 1.0

    def scores(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = weigh(buckets, counts, self.idf).astype(self.weights.dtype)
        return (x @ self.weights[buckets] + self.weights[-1]).astype(np.float64)

    def predict(self, text: str | None) -> tuple[str, float]:
        buckets, counts = bag(text)
        if not len(buckets) or not self.langs:
            return UNKNOWN, 0.0
        z = self.scores(buckets, counts) / self.temperature
        p = np.exp(z - z.max())
        return self.langs[int(z.argmax())], float(p.max() / p.sum())


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, langs: int, epochs: int = 4, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.1, l2: float = 0.1, seed: int = 5) -> np.ndarray:
    """FTRL-proximal over rows of (buckets, values): the weights, the bias (without penalty) last."""
    z, n = np.zeros((BUCKETS + 1, langs)), np.zeros((BUCKETS + 1, langs))

    def weights(zs, ns, one, two):
        return np.where(np.abs(zs) <= one, 0.0, -(zs - np.sign(zs) * one) / ((beta + np.sqrt(ns)) / alpha + two))

    rng = np.random.default_rng(seed)
    one, two = np.full((BUCKETS + 1, 1), l1), np.full((BUCKETS + 1, 1), l2)
    one[-1] = two[-1] = 0.0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            buckets, x = rows[k]
            at = np.append(buckets.astype(np.int64), BUCKETS)
            x = np.append(x, 1.0)
            zs, ns = z[at], n[at]
            w = weights(zs, ns, one[at], two[at])
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[k]] -= 1
            g = x[:, None] * p
            more = ns + g * g
            z[at] = zs + g - (np.sqrt(more) - np.sqrt(ns)) / alpha * w
            n[at] = more
    return weights(z, n, one, two)


def fit_temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least cross entropy, by golden section over its logarithm."""

    def loss(t):
        v = scores / np.exp(t)
        v = v - v.max(axis=1, keepdims=True)
        return float((np.log(np.exp(v).sum(axis=1)) - v[np.arange(len(y)), y]).mean())

    lo, hi, ratio = -4.0, 4.0, (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bags of chosen rows, and at the end of a task how many texts hold each bucket."""
    frequency, n = np.zeros(BUCKETS, np.int64), 0
    for b in batches:
        picked: list[tuple] = []
        for text, lang, h, chosen in zip(b.column("text"), *(b.column(c).to_pylist() for c in ("lang", "h", "chosen")), strict=True):
            buckets, counts = bag(text.as_py())
            if len(buckets):
                frequency[buckets] += 1
                n += 1
                if chosen:
                    picked.append((lang, h, buckets.astype("<u2").tobytes(), counts.astype("<i8").tobytes()))
        if picked:
            yield _rows(picked, [])
    found = np.flatnonzero(frequency)
    yield _rows([], [(-1, n), *zip(found.tolist(), frequency[found].tolist(), strict=True)])


FOUND = "lang string, h long, buckets binary, counts binary, bucket int, n long"


def _rows(bags: list[tuple], numbers: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int64())
    rows = [(*x, None, None) for x in bags] + [(None, None, None, None, *x) for x in numbers]
    names = [c.split()[0] for c in FOUND.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", lang_rows: int = LANG_ROWS, max_langs: int = MAX_LANGS, bag_bytes: int = BAG_BYTES, **training) -> Model:
    """Train on the rows of ``docs`` where ``learn`` holds and text and language are there."""
    spark = prepare(docs.sparkSession)
    known = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = known.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    often = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).collect()
    share = spark.createDataFrame([(r["lang"], min(1.0, lang_rows / r["count"])) for r in often], "lang string, share double")
    h = F.xxhash64("id", "text")
    rows = known.join(F.broadcast(share), "lang", "left").select("lang", "text", h.alias("h"), F.coalesce(F.pmod(h, F.lit(1 << 30)) < F.col("share") * (1 << 30), F.lit(False)).alias("chosen"))
    found = written(rows.mapInArrow(_counted, FOUND), "language-bags")
    frequency = np.zeros(BUCKETS, np.int64)
    total = 0
    for r in found.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row a bucket
        if r["bucket"] < 0:
            total = r["n"]
        else:
            frequency[r["bucket"]] = r["n"]
    idf = np.log((1 + total) / (1 + frequency)) + 1
    bags = found.where("lang IS NOT NULL").groupBy("lang", "h").agg(F.min(F.struct("buckets", "counts")).alias("bag"))
    size = F.octet_length("bag.buckets") + F.octet_length("bag.counts")
    weight = bags.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    if weight > bag_bytes:  # a smaller sample, by another hash
        bags = bags.where(F.pmod(F.xxhash64("h", F.lit(1)), F.lit(1 << 30)) < int(bag_bytes / weight * (1 << 30)))
    sample = bags.orderBy("lang", "h").collect()
    langs = sorted({r["lang"] for r in sample}, key=lambda x: x.encode())
    y = np.array([langs.index(r["lang"]) for r in sample], dtype=np.int64)
    cells = [(np.frombuffer(r["bag"]["buckets"], "<u2"), np.frombuffer(r["bag"]["counts"], "<i8")) for r in sample]
    model = Model(langs, np.zeros((BUCKETS + 1, len(langs))), idf)
    kept = np.array([(r["h"] >> 32) % FOLD == 0 for r in sample], dtype=bool)
    if len(langs) > 1:
        if kept.all() or not kept.any():  # too few rows for a fold of their own
            kept = np.zeros(len(sample), bool)
        rows = np.flatnonzero(~kept)
        model.weights = train([(cells[k][0], weigh(*cells[k], idf)) for k in rows], y[rows], len(langs), **training)
        if kept.any():
            fold = np.flatnonzero(kept)
            model.temperature = fit_temperature(np.array([model.scores(*cells[k]) for k in fold]), y[fold])
    return model


def predictor(spark, model: Model):
    """A column function: text -> struct<lang, score>."""
    sent = prepare(spark).sparkContext.broadcast((model.langs, model.weights.astype(np.float32), model.idf, model.temperature))
    key = uuid.uuid4().hex

    def predict(texts: pa.Array) -> pa.Array:
        if key not in _ready:
            _ready.clear()
            _ready[key] = Model(*sent.value)
        got = [_ready[key].predict(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["lang", "score"])

    return F.arrow_udf(predict, "struct<lang:string,score:double>")


_ready: dict = {}


def held_out(id_column: Column) -> Column:
    """Whether a row is kept from training: the CRC-32 of the id's text, modulo 4, is 2."""
    return F.crc32(id_column.cast("string").cast("binary")) % 4 == 2


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, held_out, lang_pred and score (the calibrated probability)."""
    model = fit(docs, ~held_out(F.col(id_col)), id_col, text_col, lang_col, **options)
    guess = predictor(docs.sparkSession, model)(F.col(text_col))
    out = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), guess.alias("guess"))
    return out.select(id_col, "held_out", F.col("guess")["lang"].alias("lang_pred"), F.col("guess")["score"].alias("score"))

"""Toxicity (operator 5): subword-bag embeddings averaged into a linear softmax.

A text's words (letters, lower case) are written as ``<word>`` and cut into character n-grams, which
are hashed into a table of embeddings; the word itself is one more n-gram. The embeddings of all n-grams
of the whole text are averaged, scaled by the root of their number (an average over more is less
noisy), and go through a linear softmax over the two classes. Table
and softmax are trained jointly in numpy (Adam on mini-batches, weight decay on the table, the
epoch that does best on a fold of the training rows is kept). A misspelt word shares most n-grams
with the right one and so its vector, seen or not.

The model is linear in the average, so that after training each n-gram has one number, its share of
the log odds, and a word's sum of these is kept in a bounded cache while texts are scored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kabuto.llm.common import kept, prepare, written

BUCKETS = 1 << 18
DIMS = 8
GRAMS = (3, 4, 5)
CLASS_ROWS = 4000  # rows of either class that the model is fitted on, at most (those of smallest hash)
BAG_BYTES = 32 << 20  # of their n-gram counts, at most about (bounds what the driver holds)
CACHE_ENTRIES = 300_000
BAG_CACHE = 20_000  # words whose n-grams are kept while bags are made
CACHED_LETTERS = 64  # longer words are not kept in the caches
PIECE = 4096  # letters of a word whose n-grams are held at a time
SCALE = 2.0
MIN_STEPS = 200  # small samples get more epochs, to make so many
_WORDS = re.compile(r"[^\W\d_]+")


def word_grams(word: str) -> list[int]:
    """The buckets of a word's n-grams, its own included."""
    w = f"<{word}>"
    out = [crc32(w[i : i + n].encode()) % BUCKETS for n in GRAMS for i in range(len(w) - n + 1)]
    out.append(crc32(b"=" + w.encode()) % BUCKETS)
    return out


def gram_pieces(word: str) -> Iterator[list[int]]:
    """``word_grams``, a stretch of the word after the other: text written without spaces is one
    word of any length, which is read to its end."""
    w = f"<{word}>"
    yield [crc32(b"=" + w.encode()) % BUCKETS]
    for lo in range(0, len(w), PIECE):
        part = w[lo : lo + PIECE + max(GRAMS) - 1]
        yield [crc32(part[i : i + n].encode()) % BUCKETS for n in GRAMS for i in range(min(PIECE, len(part) - n + 1))]


def strength(n: int) -> float:
    """What the average over ``n`` n-grams is multiplied by: an average over more of them is less
    noisy, so that it counts for more."""
    return SCALE * n**0.5


def text_words(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


@dataclass
class Model:
    """``weights``: each n-gram's share in the log odds, before averaging. ``trained`` keeps what these come
    from: the embeddings of all buckets, the softmax and its offsets."""

    weights: np.ndarray
    bias: float
    trained: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def log_odds(self, words: list[str], cache: dict) -> float:
        total, n = 0.0, 0
        for w in words:
            got = cache.get(w)
            if got is None:
                if len(w) > CACHED_LETTERS:
                    for grams in gram_pieces(w):
                        total += float(self.weights[grams].sum())
                        n += len(grams)
                    continue
                grams = word_grams(w)
                got = float(self.weights[grams].sum()), len(grams)
                if len(cache) >= CACHE_ENTRIES:
                    cache.clear()
                cache[w] = got
            total += got[0]
            n += got[1]
        return self.bias + (strength(n) * total / n if n else 0.0)

    def score(self, text: str | None, cache: dict) -> float:
        """The probability of class 1; a text without words gets that of the bias alone."""
        z = min(60.0, max(-60.0, self.log_odds(text_words(text), cache)))
        return 1.0 / (1.0 + float(np.exp(-z)))


Bag = tuple[np.ndarray, np.ndarray, int]


def bag(text: str | None, known: dict) -> Bag:
    """A text's n-grams: (buckets in order, counts up to 65,535, number of all)."""
    grams: Counter = Counter()
    for w, n in Counter(text_words(text)).items():
        found = known.get(w)
        if found is None:
            if len(w) > CACHED_LETTERS:
                for piece in gram_pieces(w):
                    for g in piece:
                        grams[g] += n
                continue
            if len(known) >= BAG_CACHE:
                known.clear()
            found = known[w] = word_grams(w)
        for g in found:
            grams[g] += n
    buckets = np.fromiter(grams.keys(), np.int32, len(grams))
    counts = np.fromiter(grams.values(), np.int64, len(grams))
    order = np.argsort(buckets)
    return buckets[order], counts[order].clip(max=65_535).astype(np.uint16), int(counts.sum())


def train(texts: list[str | None], labels: list[int], **options) -> Model:
    """``train_bags`` of texts."""
    known: dict = {}
    return train_bags([bag(t, known) for t in texts], labels, **options)


def train_bags(bags: Sequence[Bag], labels: list[int], dims: int = DIMS, epochs: int = 8, batch: int = 200, rate: float = 0.05, decay: float = 1e-5, min_texts: int = 4, positive: float | None = None, seed: int = 3) -> Model:
    """Fit the model. N-grams in fewer than ``min_texts`` texts keep a zero vector. ``positive`` is the
    share of class 1 among all labelled rows, if that differs from the sample's; it moves the bias.
    With few texts, or one class only, the bias alone, from the smoothed share, is the model.

    Bags are asked for again in every batch, so that no more than a batch of them need be held unpacked, and
    the table's steps are made in place: the driver trains beside Spark's JVM."""
    y = np.array(labels, np.float64)
    prior = (y.sum() + 0.5) / (len(y) + 1)
    positive = None if positive is None else min(max(positive, 1e-4), 1 - 1e-4)
    bias = float(np.log(prior / (1 - prior)))
    if len(y) < 20 or y.min() == y.max():
        return Model(np.zeros(BUCKETS), bias if positive is None else float(np.log(positive / (1 - positive))))
    often, totals = np.zeros(BUCKETS, np.int32), []
    for b in bags:
        often[b[0]] += 1
        totals.append(b[2])
    often = np.flatnonzero(often >= min_texts)
    row_of = np.full(BUCKETS, -1, np.int32)
    row_of[often] = np.arange(len(often))
    factor = np.array([strength(t) / max(t, 1) for t in totals])
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (len(often), dims))
    soft = rng.normal(0, 0.5, (dims, 2))
    offset = np.array([-bias / 2, bias / 2])
    params = [table, soft, offset]
    first, second, grads, spare, kept = ([np.zeros_like(p) for p in params] for _ in range(5))
    order = rng.permutation(len(y))
    fold, rows = order[: len(y) // 8], order[len(y) // 8 :]
    target = np.eye(2)[y.astype(int)]

    def forward(at: np.ndarray):
        found = []
        for k in at:
            buckets, counts, _ = bags[k]
            g = row_of[buckets]
            found.append((g[g >= 0], counts[g >= 0]))
        g, counts = (np.concatenate([x[k] for x in found]) for k in (0, 1))
        own = np.repeat(np.arange(len(at)), [len(x[0]) for x in found])
        del found
        share = counts * factor[at][own]
        mean = np.stack([np.bincount(own, share * table[g, d], len(at)) for d in range(dims)], 1)
        z = mean @ soft + offset
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        return g, own, share, mean, p / p.sum(1, keepdims=True)

    best, step = None, 0
    for _ in range(max(epochs, MIN_STEPS // -(-len(rows) // batch))):
        rng.shuffle(rows)
        for lo in range(0, len(rows), batch):
            at = rows[lo : lo + batch]
            g, own, share, mean, p = forward(at)
            error = (p - target[at]) / len(at)
            back = error @ soft.T
            for d in range(dims):
                grads[0][:, d] = np.bincount(g, share * back[own, d], len(often))
            grads[0] += np.multiply(table, decay, out=spare[0])
            grads[1][:], grads[2][:] = mean.T @ error, error.sum(0)
            step += 1
            for p_, m, v, d_, s in zip(params, first, second, grads, spare, strict=True):
                np.subtract(d_, m, out=s)
                m += np.multiply(s, 0.1, out=s)
                d_ *= d_
                d_ -= v
                v += np.multiply(d_, 0.001, out=d_)
                np.divide(m, 1 - 0.9**step, out=d_)
                d_ *= rate
                np.sqrt(np.divide(v, 1 - 0.999**step, out=s), out=s)
                s += 1e-8
                p_ -= np.divide(d_, s, out=d_)
        losses = []
        for lo in range(0, len(fold), batch):
            at = fold[lo : lo + batch]
            losses.append(-np.log(np.clip(forward(at)[-1][np.arange(len(at)), y[at].astype(int)], 1e-12, 1)))
        loss = float(np.concatenate(losses).mean())
        if best is None or loss < best:
            best = loss
            for k_, p_ in zip(kept, params, strict=True):
                k_[:] = p_
    moved = 0.0 if positive is None else float(np.log(positive / (1 - positive))) - bias
    rows, soft, offset = kept
    table = np.zeros((BUCKETS, dims))
    table[often] = rows
    offset = offset + np.array([0.0, moved])
    return Model(table @ (soft[:, 1] - soft[:, 0]), float(offset[1] - offset[0]), (table, soft, offset))


def _bagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict = {}
    for b in batches:
        for h, y, text in zip(b.column("h"), b.column("y"), b.column("text"), strict=True):
            packed, total = pack(bag(text.as_py(), known))
            yield pa.RecordBatch.from_pydict({"h": [h.as_py()], "y": [y.as_py()], "bag": [packed], "total": [total]}, schema=_BAG)


_BAG = pa.schema([("h", pa.int64()), ("y", pa.int32()), ("bag", pa.binary()), ("total", pa.int64())])


def pack(b: Bag) -> tuple[bytes, int]:
    """A bag in about two bytes an n-gram: the gaps between its buckets and its counts, deflated."""
    return zlib.compress(np.diff(b[0], prepend=0).astype("<u4").tobytes() + b[1].astype("<u2").tobytes(), 1), b[2]


def unpack(packed: bytes | memoryview, total: int) -> Bag:
    raw = zlib.decompress(packed)
    n = len(raw) // 6
    return np.cumsum(np.frombuffer(raw, "<u4", n)).astype(np.int32), np.frombuffer(raw, "<u2", n, 4 * n), total


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", class_rows: int = CLASS_ROWS, bag_bytes: int = BAG_BYTES, **training) -> Model:
    """Train on labelled rows of ``docs``: at most ``class_rows`` of each class, the ones whose id has
    the smallest hash, whole texts of any length.

    An id labelled several times counts as class 1 if any label says so; null labels and ids, and
    ids without a document, are left out; repeated rows (id and text) count once. Texts become bags of
    n-gram counts in the tasks; the driver gets bags only, about ``bag_bytes`` of them at most (rows
    are left out by hash beyond that)."""
    prepare(docs.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg((F.max(label) > 0).cast("int").alias("_y"))
    counts = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    picked = None
    for y in (0, 1):
        some = known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(class_rows)
        picked = some if picked is None else picked.union(some)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "_id")
    rows = rows.select(F.xxhash64("_id", "text").alias("h"), F.col("_y").alias("y"), "text").dropDuplicates(["h"])
    bags = written(rows.mapInArrow(_bagged, "h long, y int, bag binary, total long"), "toxicity-bags")
    weight = bags.agg(F.coalesce(F.sum(F.octet_length("bag")), F.lit(0))).first()[0]
    if weight > bag_bytes:
        bags = bags.where(F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < int(bag_bytes / weight * (1 << 30)))
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    sample = PackedBags((r["h"], r["y"], r["bag"], r["total"]) for r in bags.toLocalIterator())
    return train_bags(sample, sample.labels, positive=share, **training)


class PackedBags(Sequence):
    """Bags in the order of their hashes, from rows (hash, label, packed bag, total). They are kept packed, in
    one buffer, and unpacked each time they are asked for."""

    def __init__(self, rows: Iterator[tuple[int, int, bytes, int]]):
        self.buffer, at = bytearray(), []
        for h, y, packed, total in rows:
            at.append((h, y, len(self.buffer), len(packed), total))
            self.buffer += packed
        at.sort()
        self.labels = [y for _, y, *_ in at]
        self.at = [(begin, begin + n, total) for *_, begin, n, total in at]

    def __len__(self) -> int:
        return len(self.at)

    def __getitem__(self, k: int) -> Bag:
        begin, end, total = self.at[k]
        return unpack(memoryview(self.buffer)[begin:end], total)


def scorer(spark, model: Model):
    """A column function: text -> the probability of class 1 (null: as the empty text)."""
    sent = prepare(spark).sparkContext.broadcast((model.weights.astype(np.float32), model.bias))
    key = uuid.uuid4().hex

    def score(texts: pa.Array) -> pa.Array:
        ready = kept("toxicity")
        if key not in ready:
            ready.clear()
            weights, bias = sent.value
            ready[key] = Model(weights.astype(np.float64), bias), {}
        fitted, cache = ready[key]
        return pa.array([fitted.score(t.as_py(), cache) for t in texts], pa.float64())

    return F.arrow_udf(score, "double")


def held_out(id_column, folds: int = 5):
    """Whether a row is kept from training: the CRC-32 of the id's text, modulo ``folds``, is 0."""
    return F.crc32(id_column.cast("string").cast("binary")) % folds == 0


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", **options) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, held_out, score and predicted (1 if score >= 0.5).

    The model sees the labels of rows that are not held out only, and texts only. Empty and null
    texts, and texts without letters, get the score of the bias; a null id is held out as null."""
    model = fit(docs, labels.where(~held_out(F.col(id_col))), label, id_col, text_col, **options)
    score = scorer(docs.sparkSession, model)(F.col(text_col))
    out = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

import random
import tracemalloc
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from kabuto.llm import toxicity as T

BAD = ["idiot", "moron", "worthless", "pathetic", "scum"]


def sample(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    plain = ["".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    rows = []
    for k in range(900):
        words = sample(rng, rng.randrange(5, 120), plain).split()
        toxic = int(rng.random() < 0.3)
        for _ in range(max(1, len(words) // 25) if toxic else 0):
            words.insert(rng.randrange(len(words) + 1), rng.choice(BAD))
        rows.append((k, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def model(corpus):
    return T.train([t for _, t, _ in corpus[:700]], [y for *_, y in corpus[:700]], decay=1e-3)  # few words: more decay


def test_held_out_accuracy(corpus, model):
    cache = {}
    score = np.array([model.score(t, cache) for _, t, _ in corpus[700:]])
    y = np.array([y for *_, y in corpus[700:]])
    assert ((score >= 0.5) == y).mean() > 0.95


def test_misspellings_share_grams(model):
    plain = model.score("abc def gab", {})
    for word in ("idiots", "idiiot", "woorthless", "morron"):
        assert word not in BAD and model.score(f"abc def {word} gab", {}) > plain


def test_runs_without_spaces_are_read_to_their_end(corpus, model):
    for n in (3, 64, 65, T.PIECE - 2, T.PIECE, 2 * T.PIECE + 1):
        w = "<" + ("abcdefghijk" * n)[:n] + ">"
        own = [T.crc32(b"=" + w.encode()) % T.BUCKETS]
        assert sorted(T.word_grams(w[1:-1])) == sorted(g for piece in T.gram_pieces(w[1:-1]) for g in piece) == sorted(own + [T.crc32(w[i : i + k].encode()) % T.BUCKETS for k in T.GRAMS for i in range(len(w) - k + 1)])
    lead = "".join(t for _, t, y in corpus if not y).replace(" ", "")[: T.PIECE + 10]
    bad = "".join(BAD) * 40
    assert model.score(lead + bad, {}) > model.score(lead + "".join(reversed(bad)), {}) + 0.05
    joined = T.train([t.replace(" ", "") for _, t, _ in corpus[:700]], [y for *_, y in corpus[:700]], decay=1e-3)
    score = np.array([joined.score(t.replace(" ", ""), {}) for _, t, _ in corpus[700:]])
    assert ((score >= 0.5) == np.array([y for *_, y in corpus[700:]])).mean() > 0.9


def test_score_is_the_softmax_of_averaged_embeddings(corpus, model):
    """Against a plain version: every n-gram of every word looked up, averaged, put through the softmax."""
    table, soft, offset = model.trained
    cache = {}
    for text in [None, "", "7", *[t for _, t, _ in corpus[700:760]], "x" * 200]:
        grams = []
        for w in T._WORDS.findall((text or "").lower()):
            grams += [T.crc32(f"<{w}>"[i : i + n].encode()) % T.BUCKETS for n in T.GRAMS for i in range(len(w) + 3 - n)]
            grams.append(T.crc32(f"=<{w}>".encode()) % T.BUCKETS)
        mean = sum((table[g] for g in grams), np.zeros(table.shape[1])) / max(1, len(grams))
        z = T.strength(len(grams)) * mean @ soft + offset
        assert model.score(text, cache) == pytest.approx(np.exp(z[1]) / np.exp(z).sum(), rel=1e-9)


def test_the_driver_gets_bounded_bags(spark, corpus):
    docs = spark.createDataFrame([(k, t) for k, t, _ in corpus] + [(0, corpus[0][1])] * 50 + [(1, "word " * 50_000 + "idiot")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in corpus], "doc_id long, toxic int")
    seen = []
    fit, T.train_bags = T.train_bags, lambda bags, y, **k: seen.append((list(bags), y)) or fit(bags, y, epochs=1, **k)
    try:
        T.fit(docs, labels)
        T.fit(docs, labels, bag_bytes=60_000)
        T.fit(docs, labels, class_rows=20)
    finally:
        T.train_bags = fit
    assert [len(b) for b, _ in seen][0] == 901 and len(seen[2][0]) <= 43
    assert max(b[2] for b in seen[0][0]) == T.bag("word " * 50_000 + "idiot", {})[2]
    assert 0 < sum(len(T.pack(b)[0]) for b in seen[1][0]) < 120_000
    for b in seen[0][0][:50]:
        again = T.unpack(*T.pack(b))
        assert b[0].tolist() == again[0].tolist() and b[1].tolist() == again[1].tolist() and b[2] == again[2]


def test_training_holds_a_batch_of_unpacked_bags_at_most():
    """The driver trains beside Spark's JVM: bags stay packed but for a batch (peak 22 MB; 39 if all
    are unpacked)."""
    rng = np.random.default_rng(2)
    rows = []
    for k in range(1000):
        buckets = np.sort(rng.choice(5000, 3000, replace=False)).astype(np.int32)
        rows.append((-k, k % 2, *T.pack((buckets, np.ones(3000, np.uint16), 3000))))

    class Unpacked:
        def __len__(self):
            return len(rows)

        def __getitem__(self, k):
            return T.unpack(*rows[k][2:])

    tracemalloc.start()
    try:
        model = T.train_bags(Unpacked(), [y for _, y, *_ in rows], epochs=1, batch=20)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # The tables of all buckets (embeddings, weights) are made last; the rest must fit in 4 MB beside them.
    assert peak < T.BUCKETS * 8 * (T.DIMS + 2) + (4 << 20)
    held = T.PackedBags(iter(rows))
    assert held.labels == [y for _, y, *_ in reversed(rows)] and len(held) == len(rows)
    assert all(got[0].tolist() == T.unpack(*r[2:])[0].tolist() for got, r in zip(held, reversed(rows), strict=True))
    assert np.array_equal(model.weights, T.train_bags([T.unpack(*r[2:]) for r in rows], [y for _, y, *_ in rows], epochs=1, batch=20).weights)


def test_the_share_moves_the_bias(corpus):
    texts, labels = [t for _, t, _ in corpus[:200]], [y for *_, y in corpus[:200]]
    low, high = (T.train(texts, labels, epochs=2, positive=p) for p in (0.01, 0.9))
    assert low.bias < high.bias and np.allclose(low.weights, high.weights)


@pytest.mark.parametrize("labels", [[], [1], [0] * 30])
def test_without_two_classes(labels):
    got = T.train(["a b"] * len(labels), labels).score(None, {})
    assert 0 < got < 1


def test_rows(spark, corpus, odd):
    docs = spark.createDataFrame([(k, t) for k, t, _ in corpus], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 0, y) for k, _, y in corpus] + [(3, 0, None), (None, 0, 1), (10**6, 1, 1)], "doc_id long, quality int, toxic int")
    out = T.score_documents(docs, labels, epochs=4).collect()
    assert len(out) == len(corpus)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    few = T.score_documents(odd.withColumnRenamed("key", "score"), labels, epochs=1).collect()
    assert len(few) == odd.count() and all(r.score is not None for r in few)
    assert T.score_documents(odd.limit(0), labels.limit(0)).count() == 0


def test_held_out_labels_are_not_read(spark, corpus):
    docs = spark.createDataFrame([(k, t) for k, t, _ in corpus[:200]], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in corpus[:200]], "doc_id long, toxic int")
    wrong = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in T.score_documents(docs, x, epochs=2).collect()} for x in (labels, wrong))
    assert a == b

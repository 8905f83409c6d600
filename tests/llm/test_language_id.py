import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from kabuto.llm import language_id as L
from kabuto.llm.queries import queries

from .conftest import ODD, SF

SF01 = "/root/testdata/sf0.01"


def slow_bag(text):
    kept = L.letters(text)
    found = Counter()
    for n in L.GRAMS:
        for i in range(len(kept) - n + 1):
            found[int(L._buckets(np.array([ord(c) for c in kept[i : i + n]], np.uint32), n)[0])] += 1
    return sorted(found.items())


def pairs(b):
    return list(zip(b[0].tolist(), b[1].tolist(), strict=True))


def test_letters_and_bags(monkeypatch):
    assert L.letters("Él 7 a--B!\n") == " él a b "
    assert [L.letters(t) for t in (None, "", " \n", "12 _ %", "²³ ½")] == [""] * 5
    texts = [None, "", "7", "a", "ab", "Ein Haus, ein Garten.", "\U0001f600 çà et là", "aa " * 50]
    for t in texts:
        assert pairs(L.bag(t)) == slow_bag(t)
    whole = [pairs(L.bag(t)) for t in texts]
    for piece in (1, 2, 7):
        monkeypatch.setattr(L, "PIECE", piece)
        assert [pairs(L.bag(t)) for t in texts] == whole


def test_training_is_ftrl_proximal():
    """Against a plain version: one weight after the other, with the penalties spelled out."""
    rng = np.random.default_rng(2)
    rows = [(np.sort(rng.choice(40, 6, replace=False)).astype(np.uint16), rng.normal(size=6)) for _ in range(60)]
    y = rng.integers(3, size=60)
    got = L.train(rows, y, 3, epochs=2, alpha=0.3, beta=1.5, l1=0.2, l2=0.4, seed=1)
    z, n = Counter(), Counter()

    def weight(b, c):
        l1, l2 = (0, 0) if b == L.BUCKETS else (0.2, 0.4)
        if abs(z[b, c]) <= l1:
            return 0.0
        return -(z[b, c] - math.copysign(l1, z[b, c])) / ((1.5 + math.sqrt(n[b, c])) / 0.3 + l2)

    order = np.random.default_rng(1)
    for _ in range(2):
        for k in order.permutation(60):
            x = {**dict(zip(rows[k][0].tolist(), rows[k][1].tolist(), strict=True)), L.BUCKETS: 1.0}
            w = {(b, c): weight(b, c) for b in x for c in range(3)}
            s = [sum(w[b, c] * v for b, v in x.items()) for c in range(3)]
            p = [math.exp(v) / sum(map(math.exp, s)) for v in s]
            for b, v in x.items():
                for c in range(3):
                    g = (p[c] - (y[k] == c)) * v
                    z[b, c] += g - (math.sqrt(n[b, c] + g * g) - math.sqrt(n[b, c])) / 0.3 * w[b, c]
                    n[b, c] += g * g
    for b in [*range(40), L.BUCKETS]:
        assert got[b] == pytest.approx([weight(b, c) for c in range(3)], abs=1e-9)
    assert (got[:40] == 0).any() and not got[40 : L.BUCKETS].any()


def test_temperature():
    rng = np.random.default_rng(0)
    z = rng.normal(size=(20_000, 3)) * 2
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    y = (rng.random((20_000, 1)) > p.cumsum(1)).sum(1)
    assert L.fit_temperature(z * 3, y) == pytest.approx(3, rel=0.05)


def test_held_out_accuracy_and_calibration(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    out = queries()["op11_language_id"](spark, SF01).collect()
    assert len(out) == len(lang) and all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    held = [r for r in out if r.held_out and r.lang_pred != L.UNKNOWN]
    right = np.mean([r.lang_pred == lang[r.doc_id] for r in held])
    assert len(held) > 200 and right > 0.99
    assert abs(np.mean([r.score for r in held]) - right) < 0.02


def test_document_frequencies_cover_every_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.fit(docs.repartition(5), F.col("doc_id") % 3 != 0, lang_rows=5)
    seen, n = Counter(), 0
    for r in docs.collect():
        if r.doc_id % 3 and r.text and r.lang and L.letters(r.text):
            seen.update(L.bag(r.text)[0].tolist())
            n += 1
    expected = [math.log((1 + n) / (1 + seen[b])) + 1 for b in range(L.BUCKETS)]
    assert np.allclose(model.idf, expected)


def test_labels_of_held_out_rows_and_other_columns_are_not_read(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    wrong = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("z"))
    a, b = (sorted(map(tuple, L.identify(d.repartition(k)).collect())) for d, k in ((docs, 2), (wrong, 3)))
    assert a == b


def test_odd_rows(spark, odd):
    none = L.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(none) == len(ODD) and all(r.lang_pred == "und" and r.score == 0 for r in none)
    one = L.identify(odd.withColumn("lang", F.lit("en")).withColumn("score", F.lit(1))).collect()
    assert sorted((str(r.doc_id), r.lang_pred, r.score) for r in one) == sorted((str(i), *(("en", 1.0) if L.letters(t) else ("und", 0.0))) for i, t in ODD)
    assert all((r.held_out is None) == (r.doc_id is None) for r in one)
    two = L.identify(odd.withColumn("lang", F.when(F.col("text").contains("one"), "en").when(F.col("text").contains("word"), "de"))).collect()
    assert {r.lang_pred for r in two if r.doc_id == 4} == {"en"}
    assert L.identify(odd.withColumn("lang", F.lit("en")).limit(0)).count() == 0


def test_bounds_of_the_sample(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(F.lit("abc def "), F.col("id").cast("string"), F.when(F.col("id") % 2 == 0, "the of").otherwise("der die")).alias("text"), F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"))
    sizes = []
    fit, L.train = L.train, lambda rows, *a, **k: sizes.append(len(rows)) or fit(rows, *a, **k)
    try:
        for options in ({}, {"lang_rows": 50}, {"bag_bytes": 10_000}, {"max_langs": 1}):
            model = L.fit(docs, F.lit(True), **options)
    finally:
        L.train = fit
    assert sizes[0] > 400 and 40 < sizes[1] < 130 and sizes[2] < 100
    assert len(model.langs) == 1

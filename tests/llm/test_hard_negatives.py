import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kabuto.llm import hard_negatives as H
from kabuto.llm.queries import queries

from .conftest import SF


def brute(rows, every=50, positives=5, negatives=3):
    """rows: (vec_id, vector, label), labels as they are to be used."""
    kept = []
    for i, v, label in rows:
        if label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            kept.append((i, [math.floor(256 * float(np.float32(c))) for c in v], label))
    last = 1 << 63
    out = []
    for a, (i, v, label) in enumerate(kept):
        if i is None or i % every:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w, strict=True)), last if j is None else j, m == label, k != a) for k, (j, w, m) in enumerate(kept) if len(w) == len(v)]
        scores.sort()
        for ps, pid, _, _ in [s for s in scores if s[2] and s[3]][:positives]:
            inside = [s for s in scores if not s[2] and 50 * -ps <= 100 * -s[0] <= 95 * -ps]
            out += [(i, pid, k + 1, nid, -ps, -ns) for k, (ns, nid, _, _) in enumerate(inside[:negatives])]
    return sorted(tuple(None if x == last else x for x in r) for r in out)


def seen(df):
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((x is None, x or 0) for x in r))


def relabelled(rows):
    return [(i, v, (m + 1) % 10 if m is not None and i is not None and i % 7 == 0 else m) for i, v, m in rows]


@pytest.mark.parametrize("labels,dims,tree,leaf", [(3, 8, 100, 8), (10, 64, 300, 16), (200, 4, 64, 4)])
def test_many_small_trees_against_brute_force(spark, monkeypatch, labels, dims, tree, leaf):
    """Clusters, copies and a hot label; trees and leaves small enough for several levels."""
    monkeypatch.setattr(H, "TREE", tree)
    monkeypatch.setattr(H, "SAMPLE", 300)
    monkeypatch.setattr(H.build, "__defaults__", (leaf, 3))
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(900, dims)) + rng.integers(-2, 3, size=(900, 1))
    base = np.concatenate([base, base[:60] + rng.normal(size=(60, dims)) * 0.01, np.repeat(base[:1], 240, axis=0)])
    rows = [(k, v.astype(np.float32).tolist(), int(rng.integers(labels)) if k % 3 else 0) for k, v in enumerate(base)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    assert seen(H.hard_negatives(df, F.col("vec_id") % 20 == 0)) == brute(rows, 20)


def test_search_prunes_and_stays_exact():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(400, 6)) * 5 + c for c in rng.normal(size=(8, 6)) * 200]).astype(np.int32)
    labels = np.repeat(np.arange(8), 400)
    tree = H.build(labels, x, np.arange(len(x)), np.zeros(len(x), bool), 16, 4)
    read = 0
    product = H._product

    def counting(a, b):
        nonlocal read
        read += len(a) * len(b)
        return product(a, b)

    H._product = counting
    try:
        i, _, r, s = H.search(tree, tree["x"][5:6], tree["labels"][5:6], True, np.full((1, 1), H.NONE), np.full((1, 1), -H.NONE), 5, np.array([5]))
    finally:
        H._product = product
    whole = tree["x"].astype(np.int64) @ tree["x"][5]
    whole[(tree["labels"] != tree["labels"][5]) | (np.arange(len(x)) == 5)] = H.NONE
    assert s.tolist() == np.sort(whole)[::-1][:5].tolist()
    assert read < len(x) / 2


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (1, [0.9, 0.5], 1), (1, [0.9, 0.5], 1), (2, [0.8, 0.3], 2), (2, [0.8, 0.3], 2), (None, [0.8, 0.3], 2), (None, [0.7, 0.3], 3), (50, [1.0, 0.5], 1), (50, [1.0, 0.5], 1)]
    rows += [(100, None, 1), (150, [1.0, None], 1), (200, [nan, 1.0], 1), (250, [inf, 1.0], 1), (300, [1.0, 1.0], None), (350, [1.0], 1), (351, [1.0], 1), (352, [0.8], 2), (400, [], 1), (401, [], 1), (402, [], 2)]
    rows += [(450, [-1.0, -1.0], 4), (451, [0.1, 0.1], 4), (452, [0.0, 0.0], 5), (500, [0.0, 0.0], 6), (501, [1.0, 1.0], 6)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, id int, q string")
    assert seen(H.hard_negatives(df, F.col("vec_id") % 50 == 0)) == sorted(brute(rows), key=lambda r: tuple((x is None, x or 0) for x in r))
    big = spark.createDataFrame([*rows, (550, [3e38, 1.0], 1)], "vec_id long, embedding array<float>, label int")  # takes no part
    assert seen(H.hard_negatives(big, F.col("vec_id") % 50 == 0)) == seen(H.hard_negatives(df, F.col("vec_id") % 50 == 0))
    assert H.hard_negatives(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert H.hard_negatives(df.where("vec_id = 1"), F.col("vec_id") % 50 == 0).count() == 0
    long = spark.createDataFrame([(k * 50, [0.5] * 5000, k % 2) for k in range(6)], "vec_id long, embedding array<double>, label long")
    assert seen(H.hard_negatives(long, F.col("vec_id") % 50 == 0)) == brute([(k * 50, [0.5] * 5000, k % 2) for k in range(6)])


def test_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert seen(queries()["op13_hard_negatives"](spark, SF)) == brute(relabelled(rows))

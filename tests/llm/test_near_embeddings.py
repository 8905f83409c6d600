import numpy as np
import pytest
from pyspark.sql import functions as F

from kabuto.llm import near_embeddings as N
from kabuto.llm.queries import queries

from .conftest import SF


def brute(rows, cosine=0.9):
    x = []
    for _, v in rows:
        ok = v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)
        x.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if x[i] is not None and x[j] is not None and x[i] @ x[j] >= cosine:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    low = {}
    for k, (i, _) in enumerate(rows):
        low[find(k)] = min(low.get(find(k), (True, 0)), (i is None, i or 0))
    return sorted(((i is None, i or 0), links[k], low[find(k)]) for k, (i, _) in enumerate(rows))


def seen(df):
    rows = df.collect()
    for r in rows:
        assert r.kept == (r.vec_id == r.component_id)
    return sorted(((r.vec_id is None, r.vec_id or 0), r.n_links, (r.component_id is None, r.component_id or 0)) for r in rows)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(500, 32))
    near = [b / np.linalg.norm(b) + rng.normal(size=32) * s for b in base[:120] for s in (0.02, 0.06, 0.08)]
    group = [base[400] / np.linalg.norm(base[400]) + rng.normal(size=32) * 0.02 for _ in range(300)]
    whole = np.concatenate([base, near, group, base[:20]])
    return [(k, v.astype(np.float32).tolist()) for k, v in enumerate(whole)]


def test_recall_and_exactness(spark, vectors):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    expected = brute(vectors)
    got = seen(N.link_vectors(df, leaf=60, block=100))
    found, there = (sum(n for _, n, _ in x) for x in (got, expected))
    assert all(g[1] <= e[1] for g, e in zip(got, expected, strict=True))  # no link below the bound
    assert there > 80_000 and found >= 0.99 * there


def test_odd_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, []), (9, [0.0, 1.0]), (9, [0.0, 3.0]), (None, [0.0, 2.0]), (10, [1e-30, 0.0]), (11, [3e38, 0.0])]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<float>, label int, n_links int")
    assert seen(N.link_vectors(df)) == brute(rows)
    assert N.link_vectors(df.limit(0)).count() == 0
    assert seen(N.link_vectors(df.where("vec_id = 3"))) == [((False, 3), 0, (False, 3))]


def test_lengths_do_not_meet(spark):
    """Each length is compared by itself, whichever is the most frequent; very long ones too."""
    rng = np.random.default_rng(1)
    rows = [(1, [1.0]), (2, [3.0]), (3, [-1.0]), (4, [1.0, 0.0]), (5, [1.0, 0.1]), (6, [1.0, 0.0, 0.0]), (7, [0.0] * 4000), (2**62, [1.0] * 5000), (-(2**62), [2.0] * 4999 + [2.1]), (8, rng.normal(size=3000).tolist())]
    got = seen(N.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    whole = []
    for n in {len(v) for _, v in rows}:
        whole += brute([r for r in rows if len(r[1]) == n])
    assert got == sorted(whole)


@pytest.mark.parametrize("dims", [16, 64, 768])
def test_recall_by_dimension(spark, dims):
    """Pairs that just link, among random vectors: the margin keeps its meaning, leaves stay small."""
    rng = np.random.default_rng(dims)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    base = unit(rng.normal(size=(2500, dims)))
    side = rng.normal(size=(300, dims))
    side = unit(side - (side * base[:300]).sum(1, keepdims=True) * base[:300])
    whole = np.concatenate([base, 0.905 * base[:300] + np.sqrt(1 - 0.905**2) * side])
    margin = N.SPILL * np.sqrt(0.2 / dims)
    tree = N.fit_tree(whole, 100, margin, np.random.default_rng(0))
    rows, leaves = tree.leaves(whole, margin)
    assert np.bincount(leaves).max() < 400 and len(rows) < 4 * len(whole)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(whole)], "vec_id long, embedding array<double>")
    found = N.link_vectors(df, leaf=100).where("n_links > 0").count()
    assert found >= 0.97 * 600


def test_leaves_are_split_again(spark, monkeypatch):
    """The tops of the trees are fitted on a sample far too small for leaves of the wanted size; a dense
    group (a third of all) stays in one leaf, in blocks."""
    monkeypatch.setattr(N, "LEAF_SAMPLE", 200)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(2000, 24))
    group = base[0] / np.linalg.norm(base[0]) + rng.normal(size=(1000, 24)) * 0.02
    whole = np.concatenate([base, group, base[:50] + rng.normal(size=(50, 24)) * 0.05])
    rows = [(k, v.tolist()) for k, v in enumerate(whole)]
    sizes = []
    split = N._split
    monkeypatch.setattr(N, "_split", lambda placed, *a: sizes.append(placed.groupBy("leaf").count().agg(F.min("count"), F.max("count")).first()) or split(placed, *a))
    got = seen(N.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), leaf=40, block=300, sample=120))
    expected = brute(rows)
    assert len(sizes) >= 1 and sizes[0][1] > 300
    assert sum(n for _, n, _ in got) >= 0.99 * sum(n for _, n, _ in expected)
    assert all(g[1] <= e[1] for g, e in zip(got, expected, strict=True))


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert seen(queries()["op8_embedding_near_dedup"](spark, SF)) == brute(rows)

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kabuto.llm import ngram_join as N
from kabuto.llm.common import components
from kabuto.llm.queries import queries

from .conftest import ODD, SF


def brute(rows, num=75, den=100):
    """(id, size, smallest reachable id) of every row, by comparing all pairs."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in holders[x]}:
            both = len(s & sets[j])
            if den * both >= num * (len(s) + len(sets[j]) - both):
                parent[find(i)] = find(j)
        for x in s:
            holders[x].append(i)
    low = {}
    for i, (k, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), (True, 0)), (k is None, k or 0))
    return sorted(((k is None, k or 0), len(s), low[find(i)]) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True)))


def seen(df):
    key = lambda k: (k is None, k or 0)
    return sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in df.collect())


@pytest.fixture(scope="module")
def copies(texts):
    """Texts with copies edited so that their similarities lie on both sides of the bound."""
    rng = random.Random(9)
    rows = list(texts[:60])
    n = 10_000
    for _, t in texts[:60]:
        words = t.split()[:400]
        for edits in (1, 1, 2, 3, 5, 8):
            w = list(words)
            for _ in range(edits):
                if w:
                    k = rng.randrange(len(w))
                    w[k : k + rng.randrange(2)] = [f"new{rng.randrange(9)}"]
            rows.append((n, " ".join(w)))
            n += 1
    for size in range(1, 40):  # short texts, one shingle more each
        rows.append((n + size, " ".join(f"w{k}" for k in range(size))))
    return rows


def test_against_brute_force(spark, copies):
    docs = spark.createDataFrame(copies, "doc_id long, text string")
    expected = brute(copies)
    assert len({c for *_, c in expected}) < len(copies) - 100
    assert seen(N.join_components(docs)) == expected


def test_other_similarity(spark, copies):
    some = copies[::3]
    docs = spark.createDataFrame(some, "doc_id long, text string")
    assert seen(N.join_components(docs, similarity=(85, 100))) == brute(some, 85)
    with pytest.raises(ValueError):
        N.Rule(60, 100)


def test_odd_rows(spark, odd):
    assert seen(N.join_components(odd)) == brute(ODD)
    assert N.join_components(odd.limit(0)).count() == 0
    kept = N.keep_one(odd)
    assert kept.columns == odd.columns
    left = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert left == [(False, 1), (False, 2), (False, 3), (False, 4), (False, 6), (False, 7), (True, 0)]


def test_group_of_near_copies(spark):
    """A third of all rows in one group, no two alike."""
    rng = random.Random(2)
    base = [f"b{k}" for k in range(120)]
    rows = [(k, " ".join([*base, f"x{k}"])) for k in range(400)]
    rows += [(1000 + k, " ".join(f"r{rng.randrange(500)}" for _ in range(60))) for k in range(400)]
    got = seen(N.join_components(spark.createDataFrame(rows, "doc_id long, text string")))
    assert sum(c == (False, 0) for *_, c in got) == 400 and got == brute(rows)


def test_pigeonhole():
    """Linked sets meet in signatures worth looking up, whatever the sizes."""
    rng = np.random.default_rng(0)
    rule = N.Rule()
    for _ in range(400):
        n = int(rng.integers(1, 600))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.r_[rng.permutation(a)[int(rng.integers(0, n // 4 + 1)) :], rng.integers(0, 2**63, int(rng.integers(0, n // 4 + 1))).astype(np.uint64)])
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both):
            continue
        small, large = sorted((a, b), key=len)
        sig, kind, owner, _ = N.signatures(np.r_[small, large], np.array([len(small), len(large)]), rule)
        s, ks, t, kt = sig[owner == 0], kind[owner == 0], sig[owner == 1], kind[owner == 1]
        found = set(s[ks % 2 == 0].tolist()) & set(t[kt < 2].tolist()) | set(s.tolist()) & set(t[kt == 0].tolist())
        assert found


def test_query(spark, texts):
    assert seen(queries()["op10_ngram_jaccard_join"](spark, SF)) == brute(texts)


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(100, 180)] + [(0, k) for k in range(1, 60)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(500, 500)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_linked_against_all_pairs(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(N, "TOKENS", 16)
    rule = N.Rule()
    for turn in range(40):
        base = rng.permutation(200).astype(np.uint64)
        sets = [np.sort(np.unique(np.r_[base[: rng.integers(1, 60)], rng.integers(200, 230, rng.integers(0, 8)).astype(np.uint64)])) for _ in range(rng.integers(2, 30))]
        first = len(sets) if turn % 2 else len(sets) // 2
        parent = list(range(len(sets)))
        find = lambda x: x if parent[x] == x else find(parent[x])
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) and (first == len(sets) or (j < first <= i)):
                    parent[find(i)] = find(j)
        found = N._linked(sets, first, rule)
        assert len(found) == len(sets) - len({find(i) for i in range(len(sets))})
        assert all(find(i) == find(j) for i, j in found)


def test_stars_in_several_blocks(spark, monkeypatch):
    """A large group whose members are edited so far that many link with few others or none; chunks
    much smaller than the group."""
    monkeypatch.setattr(N, "CHUNK", 16)
    rng = random.Random(12)
    base = [f"b{k}" for k in range(150)]
    rows = [(0, " ".join(base))]
    for k in range(1, 260):
        w = list(base)
        for _ in range(rng.randrange(1, 9)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(40)}"
        rows.append((k, " ".join(w)))
    rows += [(900 + k, rows[k][1]) for k in range(30)]
    expected = brute(rows)
    assert 3 < len({c for *_, c in expected}) < 200
    assert seen(N.join_components(spark.createDataFrame(rows, "doc_id long, text string"))) == expected


def test_sketches_bound_the_difference_from_below():
    rng = np.random.default_rng(4)
    for _ in range(50):
        base = rng.integers(0, 2**63, rng.integers(1, 400)).astype(np.uint64)
        a, b = (np.unique(np.r_[base[: rng.integers(0, len(base) + 1)], rng.integers(0, 2**63, rng.integers(0, 200)).astype(np.uint64)]) for _ in range(2))
        x, y, z = N.sketches(np.r_[a, b, a], np.array([len(a), len(b), len(a)]))
        bits = sum(int(v).bit_count() for v in x ^ y)
        assert bits <= len(np.setxor1d(a, b)) and (x == z).all()
        assert bits >= 0.3 * min(len(np.setxor1d(a, b)), 512)

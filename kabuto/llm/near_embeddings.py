"""Embedding near-dedup (operator 8): a forest of random-projection trees with spill overlap.

Each tree splits the vectors by random directions: a node compares the projections with a
threshold near the median, chosen in the sparsest place, and vectors within the spill margin of it
go to both sides. The margin is a share (``SPILL``) of how far two vectors at the wanted cosine lie apart along a
random direction, which is sqrt(2 - 2 cosine) / sqrt(dims): it means the same in any dimension. All vectors
that share a leaf in some tree are compared exactly, in double precision. Every link is counted in
one place only, the first tree in which its two vectors share a leaf, so that no pairs have to be
gathered; a leaf hands on a spanning forest of its links.

Trees are fitted on bounded samples, but every vector is indexed: the top of a tree on a sample of all
(``sample``), and below it every leaf that holds many more vectors than wanted on a sample of its own, in a
task, round after round, so that leaves are of one size however many vectors there are (but for regions so
dense that spill keeps them together). Equal vectors are one class from the start. A leaf of more vectors
than a block goes to several tasks, one for each pair of its blocks, so that no task holds more
than two blocks however dense a region is.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kabuto.llm.common import components, prepare, written

TREES = 6
LEAF = 400  # vectors wanted in a leaf
SPILL = 0.25  # on either side of a threshold, of the distance along a direction of two vectors that just link
SAMPLE = 20_000  # vectors the tops of the trees are fitted on
SAMPLE_BYTES = 64 << 20  # of them, at most
LEAF_SAMPLE = 2000  # vectors of a large leaf that its own tree is fitted on, about
FEWEST = 25  # vectors of a sample that a leaf is fitted on, at least
ROUNDS = 12  # of splitting
LARGE = 4  # leaves with so many times the wanted vectors are split again
BLOCK = 3000  # vectors of a leaf compared at once
MAX_DEPTH = 40


@dataclass
class Tree:
    """Inner nodes by number: direction, threshold, and the numbers of the two children (a negative
    number -k - 1 is leaf k)."""

    directions: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray
    n_leaves: int

    def leaves(self, x: np.ndarray, spill: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that each row of ``x`` falls into."""
        rows, leaves = [], []
        todo = [(0 if len(self.thresholds) else -1, np.arange(len(x)))]
        while todo:
            node, at = todo.pop()
            if node < 0:
                rows.append(at)
                leaves.append(np.full(len(at), -node - 1))
                continue
            off = x[at] @ self.directions[node] - self.thresholds[node]
            for side, inside in enumerate((off < spill, off > -spill)):
                if inside.any():
                    todo.append((int(self.children[node, side]), at[inside]))
        return np.concatenate(rows), np.concatenate(leaves)


def fit_tree(x: np.ndarray, leaf: float, spill: float, rng: np.random.Generator) -> Tree:
    """A tree over the sample ``x`` whose leaves hold about ``leaf`` of its rows. A node that spill
    keeps from getting smaller by a tenth becomes a leaf."""
    directions, thresholds, children, n_leaves = [], [], [], 0

    def grow(rows: np.ndarray, depth: int) -> int:
        nonlocal n_leaves
        best = None
        if len(rows) > max(leaf, FEWEST) and depth < MAX_DEPTH:
            for _ in range(8):
                d = rng.standard_normal(x.shape[1])
                d /= np.linalg.norm(d)
                p = np.sort(x[rows] @ d)
                for t in np.quantile(p, (0.35, 0.42, 0.5, 0.58, 0.65)):
                    left, right = np.searchsorted(p, t + spill), len(p) - np.searchsorted(p, t - spill, "right")
                    cost = left * left + right * right
                    if best is None or cost < best[0]:
                        best = cost, max(left, right), d, t
        if best is None or best[1] > 0.9 * len(rows):
            n_leaves += 1
            return -n_leaves
        _, _, d, t = best
        node = len(thresholds)
        directions.append(d)
        thresholds.append(t)
        children.append([0, 0])
        off = x[rows] @ d - t
        children[node] = [grow(rows[off < spill], depth + 1), grow(rows[off > -spill], depth + 1)]
        return node

    grow(np.arange(len(x)), 0)
    return Tree(np.array(directions).reshape(-1, x.shape[1]), np.array(thresholds), np.array(children).reshape(-1, 2), n_leaves)


def unit_rows(lists: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which vectors can link (not null, not zero, all components finite), and these scaled to
    length 1 in double precision."""
    good, out = np.zeros(len(lists), bool), []
    for k, v in enumerate(lists):
        if v.is_valid and len(v.values) and v.values.null_count == 0:
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            top = np.abs(x).max()
            if np.isfinite(top) and top > 0:
                x = x / top  # neither overflow nor underflow in the length
                good[k] = True
                out.append(x / np.sqrt(x @ x))
    return good, out


def _classes(vectors: DataFrame) -> DataFrame:
    """(id, key, unit): key is a digest of the scaled vector, null for vectors that can't link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, units = unit_rows(batch.column(1))
            it = iter(units)
            kept = [next(it) if g else None for g in good]
            keys = [None if u is None else hashlib.md5((u + 0.0).tobytes(), usedforsecurity=False).digest() for u in kept]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array([None if u is None else u.tobytes() for u in kept], pa.binary())], names=["id", "key", "unit"])

    return vectors.mapInArrow(run, "id long, key binary, unit binary")


def _node(smallest, key):
    """A class by bytes that sort as its smallest id (a null one last), then its key."""
    sortable = F.lpad(F.hex(smallest.bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    return F.concat(F.unhex(F.when(smallest.isNull(), F.lit("01" + "0" * 16)).otherwise(F.concat(F.lit("00"), sortable))), key)


def _smallest(node):
    """The smallest id that a node was made of."""
    high = F.conv(F.hex(F.substring(node, 2, 8)), 16, 10).cast("decimal(20,0)") - F.lit(str(2**63)).cast("decimal(20,0)")
    return F.when(F.hex(F.substring(node, 1, 1)) == "00", high.cast("long"))


PLACED = "leaf long, key binary, copies long, unit binary"


def _routed(rows: pa.RecordBatch, x: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """``rows`` with the leaves of ``found`` (row, leaf code), a bounded number at a time."""
    row, code = (np.concatenate(v) for v in zip(*found, strict=True))
    for part in np.array_split(np.arange(len(row)), max(1, len(row) // 20_000)):
        pick = pa.array(row[part])
        yield pa.RecordBatch.from_arrays([pa.array(code[part].astype(np.int64)), *(rows.column(c).take(pick) for c in ("key", "copies", "unit"))], names=["leaf", "key", "copies", "unit"])


def _placed(classes: DataFrame, forest, spill: float, dims: int) -> DataFrame:
    """(leaf, key, copies, unit): one row for each leaf that a class falls into; the tree is in the
    lowest bits of the leaf's code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("unit").to_pylist()), np.float64).reshape(-1, dims)
            if len(x):
                found = [(rows, (leaf << TREE_BITS) | t) for t, tree in enumerate(forest.value) for rows, leaf in [tree.leaves(x, spill)]]
                yield from _routed(batch, x, found)

    return classes.select("key", "copies", "unit").mapInArrow(run, PLACED)


TREE_BITS = 6  # of a leaf's code


def _split(placed: DataFrame, large: DataFrame, spill: float, dims: int, leaf: int, seed: int) -> DataFrame:
    """``placed`` with its ``large`` leaves (leaf, n) split by trees of their own, each fitted in a task on about
    ``LEAF_SAMPLE`` of the leaf's vectors, chosen by hash. Leaves that spill keeps together stay."""
    some = F.pmod(F.xxhash64("key", "leaf"), F.lit(1 << 30)) * F.col("n") < F.lit(LEAF_SAMPLE << 30)
    sample = placed.join(large, "leaf").where(some)

    def fit(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        x = np.frombuffer(b"".join(part.sort_values("key")["unit"]), np.float64).reshape(-1, dims)
        tree = fit_tree(x, leaf * len(x) / int(part["n"].iloc[0]), spill, np.random.default_rng([seed, int(key[0]) & 0xFFFFFFFF]))
        return pd.DataFrame({"leaf": [key[0]], "tree": [pickle.dumps(tree)]})

    trees = written(sample.groupBy("leaf").applyInPandas(fit, "leaf long, tree binary"), "leaf-trees")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Tree] = {}
        for batch in batches:
            codes = np.asarray(batch.column("leaf"))
            for code in np.unique(codes):
                at = np.flatnonzero(codes == code)
                rows = batch.take(pa.array(at))
                if code not in known:
                    if len(known) > 64:
                        known.clear()
                    known[code] = pickle.loads(rows.column("tree")[0].as_py())
                x = np.frombuffer(b"".join(rows.column("unit").to_pylist()), np.float64).reshape(-1, dims)
                own, leaves = known[code].leaves(x, spill)
                if known[code].n_leaves == 1:
                    yield from _routed(rows, x, [(own, np.full(len(own), code))])
                    continue
                # The new code: a digest of the old one and the leaf in it, and the tree again.
                names = np.array([int.from_bytes(hashlib.md5(f"{code}/{k}".encode(), usedforsecurity=False).digest()[:8], "little") >> TREE_BITS + 1 for k in range(known[code].n_leaves)])
                yield from _routed(rows, x, [(own, (names[leaves] << TREE_BITS) | (code & ((1 << TREE_BITS) - 1)))])

    return placed.join(trees, "leaf").mapInArrow(run, PLACED).unionByName(placed.join(trees, "leaf", "left_anti"))


class _Side:
    """The vectors of one block of a leaf."""

    def __init__(self, part: pd.DataFrame, dims: int):
        self.keys = part["key"].to_numpy()
        self.copies = part["copies"].to_numpy(np.int64)
        self.x = np.frombuffer(b"".join(part["unit"]), np.float64).reshape(-1, dims)
        self.leaves = [np.asarray(v) for v in part["leaves"]]


def _compare(a: _Side, b: _Side, same: bool, leaf: int, cosine: float, links: dict, edges: dict) -> None:
    """Count the links between two sides whose first shared leaf this is, and join their classes in
    the union-find ``edges``."""

    def root(k):
        while edges.setdefault(k, k) != k:
            edges[k] = edges[edges[k]]
            k = edges[k]
        return k

    for lo in range(0, len(a.x), 512):
        i, j = np.nonzero(a.x[lo : lo + 512] @ b.x.T >= cosine)
        i += lo
        if same:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        first = _first_shared(a.leaves, b.leaves, i, j) == leaf
        i, j = i[first], j[first]
        for side, k, other, m in ((a, i, b, j), (b, j, a, i)):
            n = np.bincount(k, weights=other.copies[m], minlength=len(side.keys))
            for q in np.flatnonzero(n):
                links[side.keys[q]] = links.get(side.keys[q], 0) + int(n[q])
        for p, q in zip(i.tolist(), j.tolist(), strict=True):
            x, y = root(a.keys[p]), root(b.keys[q])
            if x != y:
                edges[max(x, y)] = min(x, y)


def _first_shared(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest leaf that both vectors of each pair fall into."""
    width_a, width_b = max(map(len, a)), max(map(len, b))
    pad = lambda v, w, e: np.concatenate([v, np.full(w - len(v), e)])
    left = np.array([pad(v, width_a, -1) for v in a])
    right = np.array([pad(v, width_b, -2) for v in b])
    out = np.full(len(i), np.iinfo(np.int64).max)
    for k in range(0, len(i), 20_000):
        p, q = left[i[k : k + 20_000]], right[j[k : k + 20_000]]
        for c in range(width_a):
            hit = (p[:, c, None] == q).any(1)
            out[k : k + 20_000] = np.where(hit, np.minimum(out[k : k + 20_000], p[:, c]), out[k : k + 20_000])
    return out


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, sample: int = SAMPLE, block: int = BLOCK, seed: int = 7) -> DataFrame:
    """One row per row of ``vectors``: ``id_col``, n_links (rows, besides itself, that it links with),
    component_id (the smallest id reachable over links, its own included) and kept.

    Two rows link when their cosine, in double precision, is at least ``cosine`` and they share a
    leaf. Null, empty and zero vectors, and vectors with null or non-finite components, link with nothing;
    equal vectors always do; vectors of different lengths don't. Repeated rows are each a row. Ids are
    integers; a null id counts as larger than any other. Extra columns are ignored.
    """
    prepare(vectors.sparkSession)
    table = written(_classes(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))), "unit-vectors")
    classes = table.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("copies"), F.min("id").alias("first"), F.min("unit").alias("unit"))
    classes = classes.select(F.col("key").alias("class"), "copies", _node(F.col("first"), F.col("key")).alias("key"), "unit", (F.octet_length("unit") / 8).cast("int").alias("dims"))
    classes = written(classes, "vector-classes")
    found = None
    for r in classes.groupBy("dims").count().where("count > 1").orderBy("dims").collect():  # a row a length
        same = classes.where(F.col("dims") == r["dims"])
        links = _links(same, r["count"], r["dims"], cosine, trees, leaf, spill, sample, block, seed)
        found = links if found is None else found.unionByName(links)
    if found is None:
        found = classes.limit(0).select("key", F.lit(0).cast("long").alias("n"), F.col("key").alias("root"))
    found = written(found, "vector-links")
    # Of a component's nodes the smallest is its root, and holds its smallest id.
    n_links = found.groupBy("key").agg(F.sum("n").alias("n"))
    labels = components(found.select(F.col("key").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("key"), "root")
    per_class = classes.select("class", "key", "copies").join(n_links, "key", "left").join(labels, "key", "left")
    per_class = per_class.select("class", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), _smallest(F.coalesce("root", "key")).alias("smallest"), F.lit(True).alias("found"))
    out = table.select("id", F.col("key").alias("class")).join(per_class, "class", "left")
    component = F.when(F.col("found"), F.col("smallest")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def _links(classes: DataFrame, n: int, dims: int, cosine: float, trees: int, leaf: int, spill: float, sample: int, block: int, seed: int) -> DataFrame:
    """Links among ``n`` classes of one length: (key, n: rows of other classes it links with, root: the smallest
    class that it is connected with in the block)."""
    if not 1 <= trees <= 1 << TREE_BITS:
        raise ValueError(f"between 1 and {1 << TREE_BITS} trees")
    spark = classes.sparkSession
    margin = spill * np.sqrt(max(0.0, 2 - 2 * cosine) / dims)
    wanted = max(2, min(sample, SAMPLE_BYTES // (8 * dims)))
    some = classes if n <= wanted else classes.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(wanted / n * (1 << 30)))
    fit = sorted(bytes(r.unit) for r in some.select("unit").collect())
    x = np.frombuffer(b"".join(fit), np.float64).reshape(-1, dims)
    rng = np.random.default_rng(seed)
    forest = [fit_tree(x, leaf * len(x) / n, margin, rng) for _ in range(trees)]
    placed = written(_placed(classes, spark.sparkContext.broadcast(forest), margin, dims), "leaves")
    counts = written(placed.groupBy("leaf").agg(F.count("*").alias("n")), "leaf-counts")
    tried = counts.limit(0).select("leaf")
    for _ in range(ROUNDS if n > wanted else 0):
        large = counts.where(F.col("n") > LARGE * leaf).join(tried, "leaf", "left_anti")
        if large.isEmpty():
            break
        tried = written(tried.union(large.select("leaf")), "tried-leaves")  # those that spill keeps together keep their code
        placed = written(_split(placed, large, margin, dims, leaf, seed), "leaves")
        counts = written(placed.groupBy("leaf").agg(F.count("*").alias("n")), "leaf-counts")

    # Blocks of a leaf, by key; every pair of blocks is one task's group. All leaves of a class go along.
    leaves = placed.groupBy("key").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))
    counts = counts.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).where("n > 1")
    dealt = placed.join(leaves, "key").join(counts.select("leaf", "blocks"), "leaf").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", other)
    dealt = dealt.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})

    def compare(group: tuple, part: pd.DataFrame) -> pd.DataFrame:
        links: dict = {}
        edges: dict = {}
        leaf_no, lo, hi = int(group[0]), int(group[1]), int(group[2])
        if lo == hi:
            one = _Side(part, dims)
            _compare(one, one, True, leaf_no, cosine, links, edges)
        else:
            inside = part["block"].to_numpy() == lo
            if inside.any() and not inside.all():
                _compare(_Side(part[inside], dims), _Side(part[~inside], dims), False, leaf_no, cosine, links, edges)
        return pd.DataFrame({"key": list(links), "n": list(links.values()), "root": [_root(edges, k) for k in links]}, columns=["key", "n", "root"])

    return written(dealt.groupBy("leaf", "lo", "hi").applyInPandas(compare, "key binary, n long, root binary"), f"links-{dims}")


def _root(edges: dict, k):
    while edges.get(k, k) != k:
        k = edges[k]
    return k

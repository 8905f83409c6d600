"""Hard-negative mining by inner product, with STR-packed R-trees.

Rows become integer vectors. Sort-tile-recursive packing deals them into trees of about ``TREE`` rows:
slabs of labels first, then of the coordinates of largest variance, each slab cut again along the next
coordinate; the cuts between trees come from a bounded sample, those inside a tree are exact. Every
node of a tree holds the bounding box of its rows, its labels' range, and an anchor's inner product
with a box lies in an interval that is the sum of one interval a coordinate.

A search takes a tree's nodes from a queue, best upper bound first, and leaves out every node whose
interval misses the score window or lies strictly below the k-th best so far (equal scores go on: ties are
settled by the smaller id). Anchors are searched together, 256 at a time, so that bounds and scores are
matrix products. Two searches: the first ``positives`` rows of the anchor's label, then, for each of these,
the first ``negatives`` rows of other labels whose score is in the window that its score sets.

Spark's part: rows are grouped by tree; the trees are dealt to partitions that stay in memory while
the packed anchors (a stated set, such as one row in fifty) stream through in blocks; each tree gives its
best for an anchor, and a window over these few rows gives the best of all. A bound on the size of a
tree and the split of crowded tiles by turn keep equal vectors, or a label of a third of all rows, from
growing a task. The fit of the cuts changes no result: the pruning is exact.

Results in odd cases: rows with a null label, null vector, or a null or non-finite component take no part,
nor do rows with a component too large for scores below 2**56 (|floor(scale * x)| > sqrt(2**56 / dims));
vectors of another length don't meet; an empty vector scores 0 with other empty ones; a null id is no
anchor, and comes last among equal scores; a repeated id or row counts as often as it is there (other rows
of an anchor: all but this one row); extra columns are ignored; an empty table or no anchors: no rows.
"""

from __future__ import annotations

import heapq
import itertools
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kabuto.llm.common import prepare, written

TREE = 2048  # rows of a tree, about
LEAF = 128  # rows of a leaf
FANOUT = 8  # children of a node
SAMPLE = 20_000  # rows that the cuts between trees are fitted on, about
SAMPLE_BYTES = 64 << 20
TOGETHER = 256  # anchors searched together
RESIDENT = 16  # trees of a partition, once there are many
NONE = -(1 << 62)  # below every score


# --- packing ---------------------------------------------------------------------------------------


def _slabs(tiles: int, left: int) -> int:
    """Slabs to cut along one coordinate for so many tiles, with so many coordinates left."""
    return math.ceil(tiles ** (1 / max(1, min(left, int(math.log2(tiles))))))


def _coordinates(x: np.ndarray) -> list[int]:
    """Coordinates by falling variance, as many as tiles could ever be cut along."""
    return np.argsort(-x.var(axis=0), kind="stable")[:24].tolist() if x.size else []


def fit_tiles(labels: np.ndarray, x: np.ndarray, tiles: int):
    """Cuts for about ``tiles`` tiles: nested (coordinate or -1 for the label, bounds, children); a
    tile is its number."""
    number = itertools.count()

    def cut(rows, t, coords):
        if t <= 1 or len(rows) < 2 or not coords:
            return next(number)
        slabs = _slabs(t, len(coords))
        bounds = np.unique(np.quantile(x[rows, coords[0]], np.arange(1, slabs) / slabs))
        part = np.searchsorted(bounds, x[rows, coords[0]], side="right")
        return coords[0], bounds, [cut(rows[part == k], t / slabs, coords[1:]) for k in range(len(bounds) + 1)]

    seen = np.unique(labels)
    share = max(1, math.ceil(len(labels) / max(1, tiles)))
    bounds, here = [], 0
    for label, n in zip(seen, np.bincount(np.searchsorted(seen, labels)), strict=True):
        if here and here + n > share:
            bounds.append(label)
            here = 0
        here += n
    bounds = np.array(bounds, dtype=np.int64)
    part = np.searchsorted(bounds, labels, side="right")
    children = []
    for k in range(len(bounds) + 1):
        rows = np.flatnonzero(part == k)
        children.append(cut(rows, tiles * len(rows) / max(1, len(labels)), _coordinates(x[rows])))
    return (-1, bounds, children), next(number)


def tile_of(plan, labels: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(labels), dtype=np.int64)

    def go(node, rows):
        if not isinstance(node, tuple):
            out[rows] = node
        elif len(rows):
            at, bounds, children = node
            part = np.searchsorted(bounds, labels[rows] if at < 0 else x[rows, at], side="right")
            for k, child in enumerate(children):
                go(child, rows[part == k])

    go(plan, np.arange(len(labels)))
    return out


def pack(labels: np.ndarray, x: np.ndarray, leaf: int) -> list[np.ndarray]:
    """The rows of each leaf: labels in order, those with a leaf's worth of rows cut by themselves."""
    leaves: list[np.ndarray] = []

    def cut(rows, coords):
        t = math.ceil(len(rows) / leaf)
        if t == 1 or not coords:
            leaves.extend(np.array_split(rows, t))
            return
        rows = rows[np.argsort(x[rows, coords[0]], kind="stable")]
        size = math.ceil(t / _slabs(t, len(coords))) * leaf
        for k in range(0, len(rows), size):
            cut(rows[k : k + size], coords[1:])

    order = np.argsort(labels, kind="stable")
    small: list[np.ndarray] = []
    for rows in np.split(order, np.flatnonzero(np.diff(labels[order])) + 1):
        if len(rows) < leaf:
            small.append(rows)
        if small and (len(rows) >= leaf or sum(map(len, small)) >= leaf):
            cut(rest := np.concatenate(small), _coordinates(x[rest]))
            small = []
        if len(rows) >= leaf:
            cut(rows, _coordinates(x[rows]))
    if small:
        cut(rest := np.concatenate(small), _coordinates(x[rest]))
    return leaves


def build(labels: np.ndarray, x: np.ndarray, ids: np.ndarray, absent: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT) -> dict:
    """An R-tree: rows in leaf order, and for each level (leaves first) where its nodes' children begin
    and their boxes: per coordinate the least and the largest, and the same for the labels."""
    leaves = pack(labels, x, leaf)
    order = np.concatenate(leaves)
    labels, x = labels[order], x[order]
    starts = np.cumsum([0, *map(len, leaves)])
    level = [np.minimum.reduceat(x, starts[:-1]), np.maximum.reduceat(x, starts[:-1]), np.minimum.reduceat(labels, starts[:-1]), np.maximum.reduceat(labels, starts[:-1])]
    levels = [(starts, *level)]
    while len(levels[-1][0]) > 2:
        n = len(levels[-1][0]) - 1
        starts = np.append(np.arange(0, n, fanout), n)
        f = (np.minimum, np.maximum, np.minimum, np.maximum)
        levels.append((starts, *[g.reduceat(v, starts[:-1]) for g, v in zip(f, levels[-1][1:], strict=True)]))
    return {"labels": labels, "x": x, "ids": ids[order], "absent": absent[order], "levels": levels, "order": order}


# --- searching -------------------------------------------------------------------------------------


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where these hold them, else in integers."""
    if a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The interval of inner products of each row of ``a`` with each box."""
    plus, minus = np.maximum(a, 0), np.minimum(a, 0)
    return _product(plus, low) + _product(minus, high), _product(plus, high) + _product(minus, low)


def search(tree: dict, a: np.ndarray, labels: np.ndarray, same: bool, floor: np.ndarray, cap: np.ndarray, k: int, own: np.ndarray | None = None):
    """The ``k`` best rows of ``tree`` for every anchor and window: (anchor, window, row, score) arrays.

    ``floor`` and ``cap`` (anchors x windows) bound the scores, ``same`` asks for the anchor's label
    or for any other, ``own`` is the anchor's own row in this tree (-1: none). Ties by id, nulls last."""
    n, wide = floor.shape
    best = np.full((n, wide, k), NONE, dtype=np.int64)  # the best scores so far, the least first
    found: list[tuple] = []
    levels = tree["levels"]

    def weighed(level: int, nodes: range) -> Iterator[tuple]:
        _, low, high, first, last = levels[level]
        pick = slice(nodes.start, nodes.stop)
        least, most = bounds(a, low[pick], high[pick])
        first, last = first[pick], last[pick]
        if same:
            fits = (labels[:, None] >= first) & (labels[:, None] <= last)
        else:
            fits = (labels[:, None] != first) | (first != last)
        for j, node in enumerate(nodes):
            some = fits[:, j] & (most[:, j] >= floor.min(axis=1)) & (least[:, j] <= cap.max(axis=1))
            if some.any():
                yield -int(np.minimum(most[some, j], cap[some].max(axis=1)).max()), next(turn), level, node, least[:, j], most[:, j], some

    turn = itertools.count()
    queue = list(weighed(len(levels) - 1, range(len(levels[-1][0]) - 1)))
    heapq.heapify(queue)
    while queue:
        _, _, level, node, least, most, some = heapq.heappop(queue)
        kth = np.maximum(best[:, :, 0], floor)
        open_ = some & ((most[:, None] >= kth) & (least[:, None] <= cap)).any(axis=1)
        if not open_.any():
            continue
        starts = levels[level][0]
        if level:
            for entry in weighed(level - 1, range(starts[node], starts[node + 1])):
                heapq.heappush(queue, entry)
            continue
        who = np.flatnonzero(open_)
        rows = slice(starts[node], starts[node + 1])
        scores = _product(a[who], tree["x"][rows])
        right = (labels[who][:, None] == tree["labels"][rows]) == same
        if own is not None:
            right &= own[who][:, None] != np.arange(rows.start, rows.stop)
        valid = right[:, None, :] & (scores[:, None, :] >= kth[who][:, :, None]) & (scores[:, None, :] <= cap[who][:, :, None])
        hit = valid.any(axis=(1, 2))
        if not hit.any():
            continue
        who, scores, valid = who[hit], scores[hit], valid[hit]
        i, w, r = np.nonzero(valid)
        found.append((who[i], w, r + rows.start, scores[i, r]))
        better = np.concatenate([best[who], np.where(valid, scores[:, None, :], NONE)], axis=2)
        best[who] = np.sort(np.partition(better, better.shape[2] - k, axis=2)[:, :, -k:], axis=2)
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    i, w, r, s = (np.concatenate(v) for v in zip(*found, strict=True))
    keep = s >= best[i, w, 0]
    i, w, r, s = i[keep], w[keep], r[keep], s[keep]
    order = np.lexsort((tree["ids"][r], tree["absent"][r], -s, w, i))
    i, w, r, s = i[order], w[order], r[order], s[order]
    first = np.flatnonzero(np.append(True, (np.diff(i) != 0) | (np.diff(w) != 0)))
    rank = np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i))))
    keep = rank < k
    return i[keep], w[keep], r[keep], s[keep]


# --- Spark -----------------------------------------------------------------------------------------

ROW = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("dims", pa.int32()), ("anchor", pa.bool_()), ("q", pa.binary())])


def _quantised(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, labels, anchor, vectors = (b.column(k) for k in range(4))
            there = ~(np.asarray(labels.is_null()) | np.asarray(vectors.is_null()))
            n = np.where(there, np.asarray(vectors.value_lengths().fill_null(0)), 0)
            x = np.asarray(vectors.filter(pa.array(there)).flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(scale * x)
                limit = np.minimum(np.sqrt(2.0**56 / np.maximum(n, 1)), 2.0**31 - 1)
                good = np.abs(x) <= np.repeat(limit, n)  # false for what isn't a number
            bad = np.concatenate([[0], np.cumsum(~good)])
            ends = np.cumsum(n)
            ok = np.flatnonzero(there & (bad[ends] == bad[ends - n]))
            q = np.where(good, x, 0).astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [ids.take(ok), labels.take(ok).cast(pa.int64()), pa.array(n[ok], pa.int32()), anchor.take(ok).fill_null(False), pa.array([q[ends[k] - n[k] : ends[k]].tobytes() for k in ok], pa.binary())],
                schema=ROW,
            )

    return run


def _matrix(cells, dims: int) -> np.ndarray:
    cells = list(cells)
    return np.frombuffer(b"".join(cells), dtype="<i4").reshape(len(cells), dims)


def _tiles(batch: pa.RecordBatch, plans: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dims, row numbers, tiles) of a batch; a length that the sample missed is one tile."""
    dims, labels = np.asarray(batch.column("dims")), np.asarray(batch.column("label"))
    for d in np.unique(dims):
        rows = np.flatnonzero(dims == d)
        if d in plans:
            cells = batch.column("q").take(pa.array(rows)).to_pylist()
            yield int(d), rows, tile_of(plans[d], labels[rows], _matrix(cells, d))
        else:
            yield int(d), rows, np.zeros(len(rows), dtype=np.int64)


def _counter(plans: dict):
    def run(batches):
        seen: dict[tuple[int, int], int] = {}
        for b in batches:
            for d, _, tiles in _tiles(b, plans):
                for t, n in zip(*np.unique(tiles, return_counts=True), strict=True):
                    seen[d, int(t)] = seen.get((d, int(t)), 0) + int(n)
        yield pa.RecordBatch.from_pydict({"dims": pa.array([d for d, _ in seen], pa.int32()), "tile": pa.array([t for _, t in seen], pa.int64()), "n": pa.array(list(seen.values()), pa.int64())})

    return run


def _dealer(plans: dict, trees: dict):
    """Rows with their tree: a tile of several trees deals its rows to them in turn."""

    def run(batches):
        turn: dict[tuple[int, int], int] = {}
        shift = TaskContext.get().partitionId()
        for b in batches:
            out = np.zeros(b.num_rows, dtype=np.int64)
            for d, rows, tiles in _tiles(b, plans):
                for t in np.unique(tiles):
                    mine = rows[tiles == t]
                    first, n = trees[d, int(t)]
                    at = turn.get((d, int(t)), shift)
                    out[mine] = first + (at + np.arange(len(mine))) % n
                    turn[d, int(t)] = (at + len(mine)) % n
            yield pa.RecordBatch.from_arrays([pa.array(out), *b.columns], names=["tree", *ROW.names])

    return run


def _packed(key, frame: pd.DataFrame) -> pd.DataFrame:
    dims = int(frame["dims"].iloc[0])
    absent = frame["id"].isna().to_numpy()
    ids = frame["id"].fillna(0).astype("int64").to_numpy()
    tree = build(frame["label"].to_numpy(), _matrix(frame["q"], dims), ids, absent)
    tree |= {"tree": int(key[0]), "dims": dims}
    rows = np.flatnonzero(frame["anchor"].to_numpy()[tree.pop("order")])
    anchors = {"tree": int(key[0]), "dims": dims, "rows": rows, "x": tree["x"][rows], "labels": tree["labels"][rows], "ids": tree["ids"][rows]}
    return pd.DataFrame({"tree": [int(key[0])], "packed": [pickle.dumps(tree)], "anchors": [pickle.dumps(anchors) if len(rows) else None]})


BEST = "anchor_tree long, anchor_row int, anchor_id long, window int, id long, score long"


def _searched(k: int, same: bool, window: tuple[int, int, int] | None):
    """Trees of a partition first, then the anchors that stream through it."""

    def run(batches):
        trees: list[dict] = []
        here = None
        for b in batches:
            for part, kind, body, wins in zip(*(b.column(c).to_pylist() for c in ("part", "kind", "body", "windows")), strict=True):
                if part != here:
                    trees, here = [], part
                if kind == 0:
                    trees.append(pickle.loads(body))
                    continue
                anchors = pickle.loads(body)
                for tree in trees:
                    if tree["dims"] == anchors["dims"]:
                        yield from _meet(tree, anchors, wins, k, same, window)

    return run


def _meet(tree: dict, anchors: dict, wins, k: int, same: bool, window) -> Iterator[pa.RecordBatch]:
    n = len(anchors["rows"])
    if window is None:
        floor, cap = np.full((n, 1), NONE), np.full((n, 1), -NONE)
    else:  # a window without a score is empty
        wide = 1 + max((w["window"] for w in wins), default=0)
        floor, cap = np.full((n, wide), -NONE), np.full((n, wide), NONE)
        at = np.searchsorted(anchors["rows"], [w["anchor_row"] for w in wins])
        col = np.array([w["window"] for w in wins], dtype=np.int64)
        score = np.array([w["score"] for w in wins], dtype=np.int64)
        low, high, of = window
        floor[at, col], cap[at, col] = -(-low * score // of), high * score // of
    for s in range(0, n, TOGETHER):
        pick = slice(s, s + TOGETHER)
        own = anchors["rows"][pick] if tree["tree"] == anchors["tree"] else None
        i, w, r, score = search(tree, anchors["x"][pick], anchors["labels"][pick], same, floor[pick], cap[pick], k, own)
        if len(i):
            yield pa.RecordBatch.from_pydict(
                {
                    "anchor_tree": pa.array(np.full(len(i), anchors["tree"])),
                    "anchor_row": pa.array(anchors["rows"][pick][i], pa.int32()),
                    "anchor_id": pa.array(anchors["ids"][pick][i]),
                    "window": pa.array(w, pa.int32()),
                    "id": pa.array(tree["ids"][r], mask=tree["absent"][r]),
                    "score": pa.array(score),
                }
            )


def _best(trees: DataFrame, anchors: DataFrame, parts: int, k: int, same: bool, window) -> DataFrame:
    """The ``k`` best rows of all trees for every anchor and window, ranked from 0."""
    kind = "struct<anchor_row:int,window:int,score:long>"
    resident = trees.select(F.pmod("tree", F.lit(parts)).cast("int").alias("part"), F.lit(0).alias("kind"), F.col("packed").alias("body"), F.array().cast(f"array<{kind}>").alias("windows"))
    asking = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(1).alias("kind"), F.col("anchors").alias("body"), "windows")
    dealt = resident.union(asking).repartition(parts, "part").sortWithinPartitions("part", "kind")
    found = dealt.mapInArrow(_searched(k, same, window), BEST)
    order = Window.partitionBy("anchor_tree", "anchor_row", "window").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < k)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int, int] = (50, 95, 100),
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """For each row where ``anchors`` holds and each of its first ``positives`` rows of its label (by falling
    score), the first ``negatives`` rows of other labels with
    ``window[0] * positive <= window[2] * score <= window[1] * positive``: (anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score). The score is the inner product of floor(scale * x)."""
    spark = prepare(vectors.sparkSession)
    chosen = F.col(id_col).isNotNull() & F.coalesce(anchors, F.lit(False))
    raw = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), chosen.alias("anchor"), F.col(vector_col).alias("v"))
    rows = written(raw.mapInArrow(_quantised(scale), "id long, label long, dims int, anchor boolean, q binary"), "negatives-rows")
    n, widest = rows.agg(F.count(F.lit(1)), F.coalesce(F.max("dims"), F.lit(1))).first()
    wanted = min(SAMPLE, SAMPLE_BYTES // (4 * max(1, widest)))
    sample = rows.select("label", "dims", "q")
    sample = (sample if n <= wanted else sample.sample(wanted / n, seed=7)).collect()
    plans = {}
    for d in {r.dims for r in sample}:
        mine = [r for r in sample if r.dims == d]
        tiles = math.ceil(n / TREE * len(mine) / len(sample))
        plans[d], _ = fit_tiles(np.array([r.label for r in mine]), _matrix([r.q for r in mine], d), min(tiles, max(1, len(mine) // 4)))
    counted = rows.mapInArrow(_counter(plans), "dims int, tile long, n long").groupBy("dims", "tile").agg(F.sum("n").alias("n"))
    trees, total = {}, 0
    for r in counted.orderBy("dims", "tile").collect():  # a row a tile
        trees[r.dims, r.tile] = (total, math.ceil(r.n / TREE))
        total += math.ceil(r.n / TREE)
    dealt = rows.mapInArrow(_dealer(plans, trees), "tree long, id long, label long, dims int, anchor boolean, q binary")
    packed = written(dealt.groupBy("tree").applyInPandas(_packed, "tree long, packed binary, anchors binary"), "negatives-trees")
    parts = max(1, min(total, max(64, math.ceil(total / RESIDENT))))
    asking = packed.where("anchors IS NOT NULL").select("tree", "anchors")
    none = F.array().cast("array<struct<anchor_row:int,window:int,score:long>>")
    near = written(_best(packed, asking.withColumn("windows", none), parts, positives, True, None), "negatives-positives")
    windows = near.groupBy(F.col("anchor_tree").alias("tree")).agg(F.collect_list(F.struct("anchor_row", F.col("rank").alias("window"), "score")).alias("windows"))
    far = _best(packed, asking.join(windows, "tree"), parts, negatives, False, window)
    named = near.select("anchor_tree", "anchor_row", F.col("rank").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(named, ["anchor_tree", "anchor_row", "window"]).select(
        "anchor_id", "positive_id", (F.col("rank") + 1).alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )

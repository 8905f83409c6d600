"""N-gram Jaccard join (operator 10): universe partition, pigeonhole and exact verification.

Every text becomes its set of hashed word shingles. Sets fall into bands by size (band k: 2^k to
2^(k+1) - 1). For a band the universe of shingles is dealt by hash into m segments, m a little
above the largest symmetric difference U that two linked sets of the band can have. A set's subset
in a segment is one signature; segments fit for it also index the subset's one-deletion
neighbourhood. If two linked sets differ in at most U shingles, and one of them looks up segments
worth U + 1 (1 for a subset looked up as it is, 2 if neighbourhoods are looked up as well), they
meet in at least one signature.

Which segments a set looks up is allocated by cost: those that meet nobody cost nothing and are
taken first, then the ones met by the fewest. A set whose free segments are worth U + 1 has no
partner at all, which settles most sets without a single comparison. What is left is verified on
the whole sets. Sets that are equal are one class from the start. The others are first compared with
one set each, their star: of those they meet, the one that meets the most. Sets that are near their stars
form groups; what is still apart inside a group is compared in blocks (products of 0-1 matrices in a
task, no pairs are emitted), and only what meets across groups, and may link by its sketches, becomes rows
of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kabuto.llm.common import components, discard, kept, prepare, row_id, small_enough, without_rows, written

OPERATOR = "ngram_join"  # it keeps nothing in Python workers; its tasks let go of what others keep there
BROADCAST_ROWS = 200_000  # documents to look up again: up to so many ids are broadcast, else shuffled
TOKEN_BANDS = 4  # bands below this one have one segment for each shingle
FINE_BANDS = 8  # bands below this one (sets of up to 255) have more segments, which tell sets apart better
SLACK = 1.08  # segments for each unit of U + 1
FINE_SLACK = 2.0  # the same in the finer bands
_SEED = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_K = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit words."""
    with np.errstate(over="ignore"):
        x = x + _SEED
        x = (x ^ (x >> np.uint64(30))) * _A
        x = (x ^ (x >> np.uint64(27))) * _B
        return x ^ (x >> np.uint64(31))


def shingles(texts: list[str | None], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct 64-bit hashes of every text's ``n``-word shingles, sorted by text and hash, and
    how many each text has.

    Words are runs of other characters than white space (U+0020, U+0009 to U+000D), A-Z in lower
    case. Fewer than ``n`` words make one shingle; none, or a null text, make the empty set."""
    words = [t.encode().lower().split() if t else [] for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(words)), np.uint64, int(sizes.sum()))
    text = np.repeat(np.arange(len(texts)), sizes)
    last = np.cumsum(sizes)[text] - 1 if len(h) else text
    left = last - np.arange(len(h)) + 1  # words from here to the text's end
    width = np.minimum(sizes, n)[text]
    out = width.astype(np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            inside = (width > k) & (left > k)
            at = np.minimum(np.arange(len(h)) + k, max(len(h) - 1, 0))
            out = np.where(inside, out * _K + h[at], out) if k else out * _K + h
    whole = left >= width
    out, text = mix(out[whole]), text[whole]
    ends = np.searchsorted(text, np.arange(len(texts)), "right")
    begin = 0
    for end in ends.tolist():
        out[begin:end].sort()
        begin = end
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:] != out[:-1]) | (text[1:] != text[:-1])
    return out[fresh], np.bincount(text[fresh], minlength=len(texts))


class Rule:
    """Bands, segments and bounds for the similarity ``num / den``."""

    def __init__(self, num: int = 75, den: int = 100):
        if not 70 * den <= 100 * num <= 100 * den:  # partners at most one band apart, and segments enough to look up
            raise ValueError("the similarity must lie between 0.7 and 1")
        self.num, self.den = num, den

    def differ(self, a: int, b: int) -> int:
        """The largest symmetric difference of two linked sets of these sizes."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def segments(self, band: int) -> tuple[int, int]:
        """The number of segments of a band, and how many of them index neighbourhoods."""
        slack = FINE_SLACK if band < FINE_BANDS else SLACK
        m = int(slack * (self.differ((2 << band) - 1, (2 << band) - 1) + 1)) + 1
        return m, m if band < 6 else m // 8 if band < 10 else m // 32

    def bands(self, size: int) -> list[tuple[int, int]]:
        """(band, worth to look up) for partners at least as large: its own band, then the next."""
        own, largest = size.bit_length() - 1, size * self.den // self.num
        out = []
        for band in range(own, largest.bit_length()):
            top = min(largest, (2 << band) - 1)
            if band < TOKEN_BANDS:  # shingles that a partner may lack, and one
                share = -(-2 * size * self.num // (self.den + self.num))
                out.append((band, size - share + 1))
            else:
                out.append((band, self.differ(size, top) + 1))
        return out


def signatures(tokens: np.ndarray, sizes: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The signatures of some sets (``tokens`` one set after the other, of ``sizes``): signature, kind
    and set of each, and the sets' plans.

    Kinds: 0 a subset, 1 a neighbour (both in the set's own band, where it can be found); 2 and 3
    the same in the next band, where it only looks up. Plan: for the own band, then the next one,
    how many subsets and how many neighbourhoods there are, and the worth to look up.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    plan = np.zeros((len(sizes), 6), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bands = [rule.bands(int(k)) if k else [] for k in sizes]
    for turn in (0, 1):
        rows = np.array([i for i, b in enumerate(bands) if len(b) > turn], np.int64)
        if not len(rows):
            continue
        band = np.array([bands[i][turn][0] for i in rows])
        need = np.array([bands[i][turn][1] for i in rows])
        index = np.full(len(sizes), -1)
        index[rows] = np.arange(len(rows))
        mine = index[owner] >= 0
        own, n = index[owner[mine]], sizes[rows]
        segments = np.array([rule.segments(int(b)) if b >= TOKEN_BANDS else (0, 0) for b in band])
        single = band < TOKEN_BANDS
        m = np.where(single, n, segments[:, 0])
        base = np.r_[0, np.cumsum(m)]
        with np.errstate(over="ignore"):
            salt = mix((band + 1).astype(np.uint64))
            values = mix(tokens[mine] + salt[own])
            seg = (((values >> np.uint64(32)) * m[own].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
            first = np.r_[0, np.cumsum(n)][:-1]
            seg = np.where(single[own], np.arange(len(own)) - first[own], seg)  # a segment for each shingle
            at = base[own] + seg
            mixed = mix(values)
            sums, counts = np.zeros(base[-1], np.uint64), np.bincount(at, minlength=base[-1])
            np.add.at(sums, at, mixed)
            of = np.repeat(np.arange(len(rows)), m)
            number = np.where(single[of], 0, np.arange(base[-1]) - base[of])
            salts = mix(number.astype(np.uint64) + salt[of])
            fitting = (number < segments[of, 1]) & (counts > 1)
            keep = counts > 0
            if turn:  # only looks up: what the worth takes, with some slack
                place = np.cumsum(keep) - 1
                place -= np.r_[0, np.cumsum(keep)][base[:-1]][of]
                kept = np.bincount(of[keep], minlength=len(rows))
                fitting &= (kept < need)[of]
                keep &= (place < (need * SLACK).astype(int)[of] + 2) | single[of] | (kept < need)[of]
            subsets, able = mix(sums ^ salts)[keep], np.bincount(of[fitting], minlength=len(rows))
            near = fitting[at]
            neighbours = mix((sums[at] - mixed)[near] ^ salts[at[near]])
        n_subsets = np.bincount(of[keep], minlength=len(rows))
        if (need > n_subsets + able).any():
            raise ValueError("a set's shingles fall into too few segments; choose another seed")
        found.append((subsets, np.full(len(subsets), 2 * turn, np.uint64), rows[of[keep]]))
        found.append((neighbours, np.full(len(neighbours), 2 * turn + 1, np.uint64), rows[own[near]]))
        plan[rows, 3 * turn : 3 * turn + 3] = np.stack([n_subsets, able, need], 1)
    if not found:
        return tokens[:0], tokens[:0], owner[:0], plan
    return *(np.concatenate(x) for x in zip(*found, strict=True)), plan


def chunks(texts: pa.Array, chars: int = 400_000) -> Iterator[list[str | None]]:
    """The texts of an Arrow array, some at a time."""
    out, held = [], 0
    for t in texts:
        out.append(t.as_py())
        held += len(out[-1] or "")
        if held >= chars:
            yield out
            out, held = [], 0
    if out:
        yield out


def short_key(key: bytes) -> int:
    """62 bits of a class key, over the two bits of a kind."""
    return int.from_bytes(key[:8], "little") & ~3


def class_key(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


WORDS = 8  # of 64 bits in a sketch
SKETCH = [f"s{k}" for k in range(WORDS)]


def sketches(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One row of 64-bit words a set: a bit for each of 512 buckets of tokens, set if it holds an odd number
    of the set's. Two sets differ in at least as many tokens as their sketches in bits."""
    out = np.zeros((len(sizes), WORDS), np.uint64)
    bucket = mix(tokens) >> np.uint64(64 - 9)
    at = np.repeat(np.arange(len(sizes)), sizes) * WORDS + (bucket >> np.uint64(6)).astype(np.int64)
    np.bitwise_xor.at(out.reshape(-1), at, np.uint64(1) << (bucket & np.uint64(63)))
    return out


PLAN = ["n0", "able0", "need0", "n1", "able1", "need1"]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def keys_of(tokens: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """The class key of each set; None for the empty set."""
    ends = np.cumsum(sizes).tolist()
    return [class_key(tokens[end - k : end]) if k else None for k, end in zip(sizes.tolist(), ends, strict=True)]


def classes_of(docs: DataFrame, rule: Rule, n: int) -> DataFrame:
    """id, n_shingles, key (null: the empty set) and short key of every row, its plan and its sketch."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(OPERATOR)
        for batch in batches:
            at = 0
            for texts in chunks(batch.column(1)):
                tokens, sizes = shingles(texts, n)
                keys = keys_of(tokens, sizes)
                shorts = [None if k is None else short_key(k) - (short_key(k) >> 63 << 64) for k in keys]
                plan = signatures(tokens, sizes, rule)[3]
                columns = [batch.column(0).slice(at, len(texts)), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(shorts, pa.int64())]
                columns += [pa.array(plan[:, k].astype(np.int32)) for k in range(6)]
                bits = sketches(tokens, sizes)
                columns += [_signed(np.ascontiguousarray(bits[:, k])) for k in range(WORDS)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_shingles", "key", "short", *PLAN, *SKETCH])
                at += len(texts)

    return docs.select("id", "text").mapInArrow(run, f"id {kind}, n_shingles long, key binary, short long, " + ", ".join([*(f"{p} int" for p in PLAN), *(f"{p} long" for p in SKETCH)]))


def _signature_rows(docs: DataFrame, rule: Rule, n: int) -> DataFrame:
    """(sig, who): who is the short key with the kind in its lowest bits. A task gives the rows of a
    set once, as long as it remembers the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(OPERATOR)
        seen: set[bytes] = set()
        for batch in batches:
            for texts in chunks(batch.column(0)):
                tokens, sizes = shingles(texts, n)
                keys = keys_of(tokens, sizes)
                if len(seen) >= 1_000_000:
                    seen.clear()
                new = np.zeros(len(keys), bool)
                for i, key in enumerate(keys):
                    if key is not None and key not in seen:
                        new[i] = True
                        seen.add(key)
                if not new.any():
                    continue
                shorts = np.array([short_key(k) for k, x in zip(keys, new, strict=True) if x], np.uint64)
                sig, kind, owner, _ = signatures(tokens[np.repeat(new, sizes)], sizes[new], rule)
                yield pa.RecordBatch.from_arrays([_signed(sig), _signed(kind | shorts[owner])], names=["sig", "who"])

    return docs.select("text").mapInArrow(run, "sig long, who long")


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (sig, who): those of signatures on which a lookup can meet another set,
    with how many rows there are (a cost). Runs over a million rows are passed on in parts, whose
    cost is what has been seen so far."""
    kept(OPERATOR)
    sig0, who0 = np.zeros(0, np.int64), np.zeros(0, np.int64)
    part = 0  # rows of the open run that have been passed on

    def rows(sig: np.ndarray, who: np.ndarray, done: int) -> pa.RecordBatch | None:
        starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        sizes = np.diff(np.r_[starts, len(sig)])
        kind = who & 3
        count = [np.add.reduceat((kind == k).astype(np.int64), starts) for k in range(4)]
        useful = (count[0] > 0) & (sizes > 1) | (count[1] > 0) & (count[2] > 0)
        cost = sizes.copy()
        if done:
            useful[0], cost[0] = True, sizes[0] + done
        keep = np.repeat(useful, sizes)
        if not keep.any():
            return None
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (sig[keep], who[keep], np.repeat(cost, sizes)[keep])], names=["sig", "who", "cost"])

    for batch in batches:
        sig, who = (np.concatenate([a, batch.column(k).to_numpy(zero_copy_only=False)]) for k, a in enumerate((sig0, who0)))
        if not len(sig):
            continue
        fresh = np.r_[True, (sig[1:] != sig[:-1]) | (who[1:] != who[:-1])]
        sig, who = sig[fresh], who[fresh]
        cut = int(np.searchsorted(sig, sig[-1], "left"))
        if cut:
            if (out := rows(sig[:cut], who[:cut], part)) is not None:
                yield out
            part = 0
        sig0, who0 = sig[cut:], who[cut:]
        if len(sig0) > 1_000_000:
            if (out := rows(sig0[:-1], who0[:-1], part or 1)) is not None:
                yield out
            part += len(sig0) - 1
            sig0, who0 = sig0[-1:], who0[-1:]
    if len(sig0) and (out := rows(sig0, who0, part)) is not None:
        yield out


def _with_tokens(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """The tokens of classes: ``wanted`` (id, key; a row a class) as (key, tokens), from the row of ``docs`` that
    has the id and the key. Up to a checked number of rows, ``wanted`` is broadcast."""
    wanted = wanted.select(F.col("id").alias("_id"), "key").distinct()
    wanted = F.broadcast(wanted) if small_enough(wanted, BROADCAST_ROWS) else wanted
    rows = docs.join(wanted, docs["id"].eqNullSafe(wanted["_id"])).select("text", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(OPERATOR)
        for batch in batches:
            at = 0
            for texts in chunks(batch.column(0)):
                tokens, sizes = shingles(texts, n)
                keys = keys_of(tokens, sizes)
                part = batch.column(1).slice(at, len(texts))
                at += len(texts)
                same = pa.array(np.array([a == b for a, b in zip(keys, part.to_pylist(), strict=True)], bool))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), _signed(tokens))
                yield pa.RecordBatch.from_arrays([part.filter(same), lists.filter(same)], names=["key", "tokens"])

    # Rows that repeat an id and a text give a class more than once.
    return rows.mapInArrow(run, "key binary, tokens array<long>").dropDuplicates(["key"])


def _compared(tokens: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs of short keys (a, center) as pairs of class keys (a, b) with their sizes (na, nb) and the
    number of shingles that they have in common (both)."""
    one = classes.select(F.col("short").alias("a"), F.col("key").alias("ka"), F.col("n_shingles").alias("na"))
    two = classes.select(F.col("short").alias("center"), F.col("key").alias("kb"), F.col("n_shingles").alias("nb"))
    near = pairs.join(one, "a").join(two, "center").select("ka", "kb", "na", "nb")
    out = near.join(tokens.select(F.col("key").alias("ka"), "tokens"), "ka").join(tokens.select(F.col("key").alias("kb"), F.col("tokens").alias("other")), "kb")
    both = F.size(F.array_intersect("tokens", "other")).cast("long")
    return out.select(F.col("ka").alias("a"), F.col("kb").alias("b"), "na", "nb", both.alias("both"))


def _alike(num: int, den: int):
    """Whether compared pairs have a similarity of at least num / den."""
    return F.col("both") * den >= (F.col("na") + F.col("nb") - F.col("both")) * num


NEAR = (40, 100)  # similarity to a star from which on a set is compared with all that is near it, in blocks
CHUNK = 512  # sets of a group that are compared with those of another chunk in a task, about
CHUNK_TOKENS = 400_000  # of these sets together, about (a set may have more): bounds what a task holds
TOKENS = 4096  # columns of a matrix of sets by tokens


def _linked(sets: list[np.ndarray], first: int, rule: Rule) -> list[tuple[int, int]]:
    """Links among ``sets`` that connect all that is linked: between the first ``first`` and the others, or, if
    there are no others, among all. Common tokens are counted by products of 0-1 matrices."""
    n = len(sets)
    sizes = np.array([len(x) for x in sets], np.int64)
    owner, flat = np.repeat(np.arange(n), sizes), np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    number = np.cumsum(np.r_[0, flat[1:] != flat[:-1]])
    shared = np.bincount(number)[number] > 1  # a token of one set is common to no two
    owner, number = owner[shared], number[shared]
    number = np.cumsum(np.r_[0, number[1:] != number[:-1]]) if len(number) else number
    both = np.zeros((n, n), np.float32)
    ends = np.searchsorted(number, np.arange(0, (number[-1] if len(number) else -1) + 1 + TOKENS, TOKENS))
    for lo, hi in zip(ends[:-1], ends[1:], strict=True):
        if hi > lo:
            matrix = np.zeros((n, TOKENS), np.float32)
            matrix[owner[lo:hi], number[lo:hi] % TOKENS] = 1
            both += matrix @ matrix.T
    both = both.astype(np.int64)
    linked = both * rule.den >= (sizes[:, None] + sizes[None, :] - both) * rule.num
    linked = np.triu(linked, 1)
    if first < n:
        linked[:first, :first] = False
        linked[first:, first:] = False
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out: list[tuple[int, int]] = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(linked)), strict=True):
        if (a := find(i)) != (b := find(j)):
            parent[b] = a
            out.append((i, j))
    return out


def _in_groups(members: DataFrame, rule: Rule) -> DataFrame:
    """Links among the sets of a group, as pairs of class keys (a, b), in blocks: ``members`` (star: the
    group, key, odd, tokens) are dealt into chunks of about ``CHUNK``, and a task compares the sets of two
    chunks. Sets that aren't ``odd`` are connected with one another already, so only the odd ones are compared
    with all. What comes out connects what is linked, a tree a block at most."""
    def n(odd: bool):
        mine = F.when(F.col("odd") == odd, F.size("tokens"))
        return F.greatest(F.ceil(F.count(mine) / F.lit(CHUNK)), F.ceil(F.coalesce(F.sum(mine), F.lit(0)) / F.lit(CHUNK_TOKENS))).cast("int")

    dealt = members.groupBy("star").agg(n(True).alias("odds"), n(False).alias("others"))
    mine = F.when(F.col("odd"), F.pmod(F.xxhash64("key"), F.col("odds"))).otherwise(F.col("odds") + F.pmod(F.xxhash64("key"), F.greatest("others", F.lit(1)))).cast("int")
    last = F.when(F.col("odd"), F.col("odds") + F.col("others")).otherwise(F.col("odds")) - 1
    each = members.join(dealt, "star").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    blocks = each.select("star", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine", "key", "tokens")
    blocks = blocks.repartition("star", "x", "y").sortWithinPartitions("star", "x", "y", "mine")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(OPERATOR)
        held: list[tuple[bytes, np.ndarray, bool]] = []
        at = None

        def links() -> pa.RecordBatch:
            found = _linked([t for _, t, _ in held], sum(f for *_, f in held), rule) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([held[k[e]][0] for k in found], pa.binary()) for e in (0, 1)], names=["a", "b"])

        for batch in (part for b in batches for part in (b.slice(k, 256) for k in range(0, b.num_rows, 256))):
            star, x, y, own, key = (batch.column(c).to_pylist() for c in ("star", "x", "y", "mine", "key"))
            lists = batch.column("tokens")
            for k in range(batch.num_rows):
                if (star[k], x[k], y[k]) != at:
                    if held:
                        yield links()
                    held, at = [], (star[k], x[k], y[k])
                held.append((key[k], np.array(lists[k].values).view(np.uint64), own[k] == x[k]))
        if held:
            yield links()

    return blocks.mapInArrow(run, "a binary, b binary")


def _places(classes: DataFrame, groups: DataFrame) -> DataFrame:
    """Size, group (star) and sketch of every short key (a). Short keys that several classes share have
    neither group nor sketch."""
    one = classes.select("short", "key", F.col("n_shingles").alias("size"), *SKETCH).join(groups, "key", "left")
    by = one.groupBy(F.col("short").alias("a")).agg(F.count("*").alias("keys"), F.min("size").alias("size"), F.min(F.coalesce("star", "key")).alias("star"), *[F.min(p).alias(p) for p in SKETCH])
    return by.select("a", "size", *[F.when(F.col("keys") == 1, F.col(c)).alias(c) for c in ("star", *SKETCH)])


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, similarity: tuple[int, int] = (75, 100)) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_shingles, component_id (the smallest id reachable
    over links, its own included) and class_key (equal for equal sets, null for the empty set).

    Two rows link when the Jaccard similarity of their shingle sets is at least ``similarity``.
    Null and empty texts, and texts without words, have the empty set and link with nothing.
    Repeated rows and repeated ids are each a row; rows with a null id take part, and count as
    larger than any id. Sets are compared by 64-bit hashes of shingles, classes by 128 bits.
    """
    rule = Rule(*similarity)
    prepare(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    table = written(classes_of(docs, rule, n), "shingle-classes")
    plan = [F.min(p).alias(p) if p[0] != "p" else F.max(p) for p in ("n0", "able0", "n1", "able1")] + [F.max(p).alias(p) for p in ("need0", "need1")]
    classes = table.where("key IS NOT NULL").groupBy("key", "short").agg(F.min("id").alias("id"), F.min("n_shingles").alias("n_shingles"), *plan, *[F.min(p).alias(p) for p in SKETCH])
    classes = classes.checkpoint()

    dealt = _signature_rows(docs, rule, n).repartition("sig").sortWithinPartitions("sig", "who").mapInArrow(_met, "sig long, who long, cost long")
    signatures_met = met = written(dealt, "met-signatures")
    del dealt
    met = met.withColumns({"a": F.col("who").bitwiseAND(F.lit(~3)), "kind": F.col("who").bitwiseAND(F.lit(3))})

    # Allocation: which signatures each set has to look up.
    by_set = Window.partitionBy("a", "up")
    subset = F.col("kind") % 2 == 0
    plans = classes.groupBy(F.col("short").alias("a")).agg(F.min("n0").alias("n0"), F.min("able0").alias("able0"), F.max("need0").alias("need0"), F.min("n1").alias("n1"), F.min("able1").alias("able1"), F.max("need1").alias("need1"))
    costs = met.withColumn("up", F.col("kind") >= 2).join(plans, "a")
    costs = costs.withColumns({
        "r": F.sum(subset.cast("int")).over(by_set),
        "d": F.sum((~subset).cast("int")).over(by_set),
        "fame": F.sum("cost").over(by_set),
        "place": F.row_number().over(by_set.orderBy(F.col("kind") % 2, "cost", "sig")),
    })
    of = lambda p: F.when(F.col("up"), F.col(p + "1")).otherwise(F.col(p + "0"))
    free = of("n") - F.col("r") + F.greatest(F.lit(0), of("able") - F.col("d") - F.col("r"))
    need = of("need") - free
    looks = ((F.col("place") <= need) & subset) | (need > F.col("r"))
    rows = costs.select("sig", "a", "kind", "fame", looks.alias("looks"), free.alias("free"), (need > 0).alias("open")).where("looks OR kind < 2")
    meeting = rows.groupBy("sig").agg(F.max("looks").alias("l"), F.min("a").alias("x"), F.max("a").alias("y")).where("l AND x < y").select("sig")
    rows = written(rows.join(meeting, "sig", "left_semi"), "lookups")
    del met, costs, meeting
    discard(signatures_met)
    open_ = classes.join(rows.select(F.col("a").alias("short")).distinct(), "short", "left_semi")
    tokens = written(_with_tokens(docs, open_, n), "tokens")

    # Stars: each set against the one, of all it meets, that meets the most others. In a group of copies
    # that is the text that the others were made from, or the nearest to it.
    famous = rows.where("kind < 2").groupBy("sig").agg(F.max(F.struct("fame", "a")).alias("f")).select("sig", F.col("f.fame").alias("of"), F.col("f.a").alias("center"))
    meets = rows.select("sig", "a").join(famous, "sig").where("a <> center").groupBy("a").agg(F.max(F.struct("of", "center")).alias("star"))
    stars = written(_compared(tokens, classes, meets.select("a", "star.center")), "stars")
    linked = _alike(rule.num, rule.den)
    near = stars.where(_alike(*NEAR))
    groups = written(components(near).select(F.col("node").alias("key"), F.col("root").alias("star")), "groups")

    # All sets of a group in blocks: those that don't link with its hub (the star that the most sets link with, or
    # else one of them) against all.
    of_group = near.select("a", "b", linked.alias("linked")).join(groups.withColumnRenamed("key", "a"), "a")
    hubs = of_group.groupBy("star", "b").agg(F.count_if("linked").alias("n")).groupBy("star").agg(F.max(F.struct("n", "b"))["b"].alias("hub"))
    with_hub = of_group.where("linked").join(hubs, "star").where("b = hub").select(F.col("a").alias("key")).union(hubs.select("hub"))
    members = groups.join(with_hub.distinct().withColumn("odd", F.lit(False)), "key", "left").withColumn("odd", F.coalesce("odd", F.lit(True)))
    some = members.where("odd").select("star").distinct()
    blocks = members.join(some, "star", "left_semi").join(tokens, "key")
    links = written(stars.where(linked).select("a", "b").union(_in_groups(blocks, rule)), "group-links")

    # Between groups (no link so far leads from one to another): every lookup against every set it meets, but for
    # pairs that can't link.
    places = _places(classes, groups)
    placed = rows.drop("fame").join(places, "a")
    split = placed.groupBy("sig").agg(F.min("star").alias("x"), F.max("star").alias("y"), F.max(F.col("star").isNull()).alias("odd")).where("odd OR x < y").select("sig")
    placed = written(placed.join(split, "sig", "left_semi"), "placed")
    left = placed.where("looks")
    right = placed.where("kind < 2").select("sig", *[F.col(c).alias(f"_{c}") for c in placed.columns if c not in ("sig", "looks")])
    size = F.col("size") + F.col("_size")
    most = F.floor(size * (rule.den - rule.num) / (rule.den + rule.num))  # the symmetric difference of a linked pair
    own_band = F.col("kind") < 2
    # Sets whose sketches differ in more than ``most`` bits differ too much; so do sets of one band that meet
    # nobody in more than ``most`` segments.
    bits = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"_{p}"))) for p in SKETCH), F.lit(0))
    pairs = left.join(right, "sig").where(
        (F.col("a") != F.col("_a"))
        & F.coalesce(F.col("star") != F.col("_star"), F.lit(True))
        & F.coalesce(bits <= most, F.lit(True))
        & ((F.col("_kind") == 0) | (F.col("kind") % 2 == 0))
        & (F.least("size", "_size") * rule.den >= F.greatest("size", "_size") * rule.num)
        & (~own_band | (F.col("_open") | (F.col("_size") < (1 << TOKEN_BANDS))) & (F.greatest("free", "_free") <= most))
    )
    pairs = pairs.select(F.least("a", "_a").alias("a"), F.greatest("a", "_a").alias("center")).distinct()
    more = written(_compared(tokens, classes, pairs).where(_alike(rule.num, rule.den)).select("a", "b"), "more-links")
    del left, right, pairs
    discard(rows, placed, tokens, stars)

    labels = components(links.union(more)).select(F.col("node").alias("key"), "root")
    joined = classes.select("key").join(labels, "key", "left").select("key", F.coalesce("root", "key").alias("root"))
    rooted = table.join(joined, "key", "left")
    smallest = rooted.where("key IS NOT NULL").groupBy("root").agg(F.min("id").alias("smallest"))
    out = rooted.join(smallest, "root", "left")
    return out.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("smallest", "id").alias("component_id"), F.col("key").alias("class_key"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (then the smallest MD5
    of its text); of rows that agree in id and text, one. Rows with the empty set all stay, but for
    such copies. All columns stay as they are."""
    rows = docs.select(row_id(id_col, text_col).alias("id"), F.col(text_col).alias("text"))
    found = written(join_components(rows, "id", "text", **options).select("id", "component_id"), "kept")
    kept = without_rows(docs, found.where(~F.col("id").eqNullSafe(F.col("component_id"))).select("id"), id_col, text_col)
    copies = found.where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("id").count().where("count > 1").select("id")
    if copies.isEmpty():
        return kept
    mine = row_id(id_col, text_col)
    once = copies.select(F.col("id.id").alias("__id"), F.col("id.md5").alias("__md5"))
    twice = kept.join(once, mine["id"].eqNullSafe(once["__id"]) & mine["md5"].eqNullSafe(once["__md5"]), "left_semi")
    twice = twice.withColumn("__md5", F.md5(F.col(text_col).cast("binary"))).dropDuplicates([id_col, "__md5"]).drop("__md5")
    return without_rows(kept, copies, id_col, text_col).unionByName(twice)

"""Benchmark decontamination (operator 3): a distributed positional inverted index.

The documents are indexed in blocks, each block by itself (a document-partitioned index): for
every term that occurs in the test set, the sorted list of its positions in the block, where the
block's documents are laid out one after another. The index is written as a table, one row per
block. Phrases are found by intersecting the lists of their terms, each shifted by the term's
offset, from the term that is rarest in the corpus on; proximity matches (``find_near``) by looking
for each term near the rarest one. No row is shuffled, unless the test set takes several passes.

The test set is taken in blocks, too, so that the vocabulary sent to the executors is bounded
whatever its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kabuto.llm.common import prepare, written

WINDOW = 13
MAX_WORDS = 2_000_000  # test-set words in one pass over the documents
BLOCK_WORDS = 2_000_000  # document words in one block of the index (and at least one document)
#: Bytes of words: A-Z in lower case, 0-9, a-z and everything beyond ASCII; the others part words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """The words of a text, as UTF-8: runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``, A-Z lower-cased."""
    return text.encode().translate(_FOLD).split() if text else []


class Phrases:
    """Distinct phrases (tuples of term ids), each with the items that hold it."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.terms: dict[bytes, int] = {}
        self.items: list[object] = sorted({i for i, _ in items}, key=str)
        at = {i: k for k, i in enumerate(self.items)}
        found: dict[tuple[int, ...], set[int]] = {}
        for i, ws in items:
            ids = [self.terms.setdefault(w, len(self.terms)) for w in ws]
            size = min(window, len(ids))
            for k in range(len(ids) - size + 1 if size else 0):
                found.setdefault(tuple(ids[k : k + size]), set()).add(at[i])
        self.phrases = list(found)
        self.holders = [sorted(x) for x in found.values()]
        self.order: list[list[int]] = []  # offsets from the rarest term on
        self.by_rarest: dict[int, list[int]] = {}

    def rank(self, counts: np.ndarray) -> None:
        """Order every phrase's offsets by its terms' corpus counts; phrases with a term that the
        corpus doesn't have can't occur."""
        self.by_rarest, self.order = {}, []
        for p, phrase in enumerate(self.phrases):
            offsets = sorted(range(len(phrase)), key=lambda k: (counts[phrase[k]], k))
            self.order.append(offsets)
            if counts[phrase[offsets[0]]]:
                self.by_rarest.setdefault(phrase[offsets[0]], []).append(p)


def intersect(lists: dict[int, np.ndarray], phrase: tuple[int, ...], offsets: list[int]) -> np.ndarray:
    """Where the phrase begins: the positions of its terms, each less its offset, intersected in
    the order of ``offsets``."""
    starts = None
    for k in offsets:
        at = lists.get(phrase[k])
        if at is None:
            return np.zeros(0, np.int64)
        if starts is None:
            starts = at - k
            continue
        i = np.searchsorted(at, starts + k)
        i[i == len(at)] = 0
        starts = starts[at[i] == starts + k]
        if not len(starts):
            break
    return starts


def near(lists: dict[int, np.ndarray], terms: list[int], span: int) -> np.ndarray:
    """The positions of the rarest of ``terms`` (their shortest list) within a stretch of ``span``
    words that holds all of them, in any order. ``terms`` are distinct."""
    if any(t not in lists for t in terms):
        return np.zeros(0, np.int64)
    first, *others = sorted((lists[t] for t in terms), key=len)
    out = []
    for begin in range(span):  # the stretch begins so many words before the rarest term
        inside = np.ones(len(first), bool)
        for at in others:
            lo = np.searchsorted(at, first - begin)
            hi = np.searchsorted(at, first - begin + span)
            inside &= hi > lo
        out.append(first[inside])
    return np.unique(np.concatenate(out))


def _documents(batches: Iterator[pa.RecordBatch], terms: dict[bytes, int]) -> Iterator[tuple[object, np.ndarray]]:
    """(id, term ids with -1 for words outside the vocabulary) of every document."""
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ws = words(t.as_py())
            yield i, np.fromiter(map(terms.get, ws, repeat(-1)), np.int32, len(ws))


def build_index(docs: DataFrame, vocabulary, gap: int = WINDOW) -> DataFrame:
    """The index of ``docs`` (id, text): per block its documents' ids, numbers of words and first
    positions, and the terms with the positions of each. Documents are ``gap`` positions apart."""
    kind = docs.schema["id"].dataType.simpleString()
    names = ["ids", "n_words", "begins", "terms", "ends", "positions"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type = None

        def rows() -> pa.RecordBatch:
            term, at = np.concatenate(found), np.concatenate(where)
            order = np.argsort(term, kind="stable")
            term, at = term[order], at[order]
            ends = np.flatnonzero(np.r_[term[1:] != term[:-1], True]) if len(term) else np.zeros(0, np.int64)
            columns = [pa.array(ids, id_type), pa.array(sizes, pa.int32()), pa.array(begins, pa.int32()), pa.array(term[ends]), pa.array((ends + 1).astype(np.int32)), pa.array(at)]
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns], names=names)

        def typed():
            nonlocal id_type
            for b in batches:
                id_type = b.column(0).type
                yield b

        ids, sizes, begins, found, where, used = [], [], [], [], [], 0
        for i, doc in _documents(typed(), vocabulary.value):
            if ids and used + len(doc) > BLOCK_WORDS:
                yield rows()
                ids, sizes, begins, found, where, used = [], [], [], [], [], 0
            at = np.flatnonzero(doc >= 0)
            ids.append(i)
            sizes.append(len(doc))
            begins.append(used)
            found.append(doc[at])
            where.append((at + used).astype(np.int32))
            used += len(doc) + gap
        if ids:
            yield rows()

    schema = f"ids array<{kind}>, n_words array<int>, begins array<int>, terms array<int>, ends array<int>, positions array<int>"
    return docs.select("id", "text").mapInArrow(run, schema)


class Block:
    """One row of the index."""

    def __init__(self, row: pa.RecordBatch, k: int):
        get = lambda name: row.column(name)[k].values
        self.ids = get("ids").to_pylist()
        self.n_words, self.begins, terms, ends, positions = (get(x).to_numpy(zero_copy_only=False) for x in ("n_words", "begins", "terms", "ends", "positions"))
        parts = np.split(positions.astype(np.int64), ends[:-1]) if len(ends) else []
        self.lists = dict(zip(terms.tolist(), parts, strict=True))

    def document(self, positions: np.ndarray) -> np.ndarray:
        """The document of each position."""
        return np.searchsorted(self.begins, positions, "right") - 1


def exact(block: Block, phrases: Phrases, q: int) -> tuple[np.ndarray, int]:
    """Where phrase ``q`` begins in the block, and how many words from there are hit."""
    return intersect(block.lists, phrases.phrases[q], phrases.order[q]), len(phrases.phrases[q])


def within(span: int):
    """As ``exact``, for the words of a phrase in any order within ``span`` words: where the
    rarest of them stands."""

    def search(block: Block, phrases: Phrases, q: int) -> tuple[np.ndarray, int]:
        terms = list(dict.fromkeys(phrases.phrases[q][k] for k in phrases.order[q]))
        terms.sort(key=lambda t: len(block.lists.get(t, ())))
        first = block.lists.get(terms[0], np.zeros(0, np.int64))
        for t in terms[1:]:  # only where each of the others is near at all
            at = block.lists.get(t, np.zeros(0, np.int64))
            first = first[np.searchsorted(at, first + span) > np.searchsorted(at, first - span + 1)]
        lists = {t: block.lists[t] for t in terms} | {terms[0]: first} if len(first) else {}
        return near(lists, terms, span), 1

    return search


def _matches(index: DataFrame, phrases, kind: str, search) -> DataFrame:
    """Per document of the index: id, n_words, the hit positions and the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Phrases = phrases.value
        for batch in batches:
            for k in range(batch.num_rows):
                block = Block(batch, k)
                hits: list[list[np.ndarray]] = [[] for _ in block.ids]
                items: list[set[int]] = [set() for _ in block.ids]
                for term in block.lists.keys() & p.by_rarest.keys():
                    for q in p.by_rarest[term]:
                        starts, size = search(block, p, q)
                        if len(starts):
                            covered = np.arange(size)
                            for d, s in zip(block.document(starts).tolist(), starts.tolist(), strict=True):
                                hits[d].append(covered + (s - block.begins[d]))
                                items[d].update(p.holders[q])
                spots = [np.unique(np.concatenate(h)).astype(np.int32) if h else np.zeros(0, np.int32) for h in hits]
                columns = [
                    pa.array(block.ids, batch.column("ids").type.value_type),
                    pa.array(block.n_words.astype(np.int64)),
                    pa.array(spots, pa.list_(pa.int32())),
                    pa.array([[str(p.items[i]) if p.items[i] is not None else None for i in sorted(x)] for x in items], pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "hits", "items"])

    return index.mapInArrow(run, f"id {kind}, n_words long, hits array<int>, items array<string>")


def find_phrases(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """Per row of ``docs``: id, n_words, ``hits`` (the sorted positions of words inside an occurrence
    of a test window) and ``items`` (the ids, as text, of the items whose windows occur).

    A window is ``window`` consecutive words of an item, or all words of a shorter one. Null and
    empty texts have no words; repeated rows are each a row; a null item id reads "null", equal
    item ids are one item. Test sets of more than ``max_words`` words are taken in several passes,
    dealt by item and text (long texts in overlapping pieces), whose hits are put together by a key
    that each row of ``docs`` is written with.
    """
    return _find(docs, benchmark, id_col, text_col, item_col, item_text, window, max_words, exact, window)


def find_near(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, span: int | None = None, max_words: int = MAX_WORDS) -> DataFrame:
    """Proximity matches, for items with words reordered or inserted. As ``find_phrases``, but a
    window occurs where a stretch of ``span`` words (twice the window if not given) of a text holds
    all its distinct words, in any order; ``hits`` are the positions in such stretches of the
    window's word that is rarest in the block of documents. Every exact occurrence is one as well,
    if ``span`` is no less than ``window``."""
    span = span or 2 * window
    return _find(docs, benchmark, id_col, text_col, item_col, item_text, window, max_words, within(span), max(window, span))


def _find(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, window: int, max_words: int, search, gap: int) -> DataFrame:
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    tests = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    passes = _passes(tests, max_words)
    several = passes > 1
    if several:
        tests = written(_pieces(tests, window, max_words).distinct(), "windows")
        passes = _passes(tests, max_words)
        docs = written(docs.select(F.struct(F.monotonically_increasing_id().alias("key"), "id").alias("id"), "text"), "keyed")
    kind = docs.schema["id"].dataType.simpleString()
    found = None
    for k in range(passes):
        part = tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == k)
        items = [(r.item, words(r.text)) for r in part.toLocalIterator()]
        phrases = Phrases(items, window)
        vocabulary = spark.sparkContext.broadcast(phrases.terms)
        index = written(build_index(docs, vocabulary, gap), "positions")
        phrases.rank(term_counts_of(index, len(phrases.terms)))
        out = _matches(index, spark.sparkContext.broadcast(phrases), kind, search)
        found = out if found is None else found.union(out)
    if several:
        united = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
        found = found.groupBy("id").agg(F.max("n_words").alias("n_words"), united("hits"), united("items")).withColumn("id", F.col("id.id"))
    items = F.transform("items", lambda x: F.coalesce(x, F.lit("null")))
    return found.select(F.col("id").alias(id_col), "n_words", "hits", items.alias("items"))


def _passes(tests: DataFrame, max_words: int) -> int:
    total = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return total // (2 * max_words) + 1  # a word takes two bytes at least, with the space behind it


def _pieces(tests: DataFrame, window: int, max_words: int) -> DataFrame:
    """``tests`` (item, text) with long texts cut into pieces that hold all windows between them."""
    step = max(window, max_words // 16)  # windows of a piece

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, pieces = [], []
            for k, t in enumerate(batch.column(1)):
                ws = words(t.as_py())
                for lo in range(0, max(1, len(ws) - window + 1), step):
                    at.append(k)
                    pieces.append(b" ".join(ws[lo : lo + step + window - 1]).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), pa.array(pieces, pa.string())], names=["item", "text"])

    return tests.mapInArrow(run, tests.schema)


def term_counts_of(index: DataFrame, n: int) -> np.ndarray:
    """How often each term occurs, summed over the index's lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                terms, ends = (batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in ("terms", "ends"))
                total[terms] += np.diff(np.r_[0, ends])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["term", "n"])

    out = np.zeros(n, np.int64)
    counts = index.select("terms", "ends").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for r in counts.toLocalIterator():
        out[r.term] = r.n
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", window: int = WINDOW, share: tuple[int, int] = (1, 20), **columns: str) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_words, n_hit, n_items, items_sha256 (of the item ids
    sorted as text and joined by commas; of the empty text if there are none) and contaminated (at
    least one word hit, and at least ``share`` of the words). See ``find_phrases``."""
    found = find_phrases(docs, benchmark, id_col, window=window, **columns)
    n_hit = F.size("hits").cast("long")
    items = F.concat_ws(",", F.array_sort("items"))
    out = found.select(id_col, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(items, 256).alias("items_sha256"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (share[1] * F.col("n_hit") >= share[0] * F.col("n_words")))

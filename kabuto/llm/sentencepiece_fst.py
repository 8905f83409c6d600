"""SentencePiece encoding and decoding (operator 1) as a weighted finite-state transducer.

Three transducers are compiled from the model: the normaliser N (spaces to space marks, a mark in
front), the pieces P (a trie over characters whose final states write a piece id) and the byte
fallback B (a character in no piece writes the ids of its UTF-8 bytes). The composition with one
input is a lattice over its positions, expanded only where a path reaches; the tropical-semiring
shortest path (weights add along a path, the smallest sum wins) is found in one pass from left to
right.

For a byte-pair model plain piece weights can't tell the right path, because merging is greedy.
The lattice is therefore also composed with the acceptor A of piece pairs that merging leaves side
by side: a path is the byte-pair encoding if and only if merging each piece, and each pair of
neighbours put together, gives them back. Exactly one path is left per position; the others have
infinite weight. A's arcs are worked out when first asked for and kept in a bounded cache.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kabuto.llm import pieces as P
from kabuto.llm.common import kept, prepare

CACHE_ENTRIES = 1_000_000  # segments kept per Python worker (about 230 bytes each)
CACHED_PAIRS = 300_000
CACHED_LENGTH = 48
NEVER = 1 << 40  # a rank above all
INFINITE = float("inf")


def merge_history(symbols: str, rank: dict[str, int]) -> tuple[list[int], list[str], list[str], int]:
    """Greedy merging of a short string (lowest rank first, leftmost on ties): the ranks of its
    merges in order, the first and the last symbol before each merge and at the end, and the
    number of symbols left."""
    cuts = list(range(len(symbols) + 1))
    ranks, first, last = [], [symbols[:1]], [symbols[-1:]]
    while len(cuts) > 2:
        best, at = None, 0
        for k in range(len(cuts) - 2):
            r = rank.get(symbols[cuts[k] : cuts[k + 2]])
            if r is not None and (best is None or r < best):
                best, at = r, k + 1
        if best is None:
            break
        del cuts[at]
        ranks.append(best)
        first.append(symbols[: cuts[1]])
        last.append(symbols[cuts[-2] :])
    return ranks, first, last, len(cuts) - 1


class Transducer:
    """N ∘ P ∘ A with byte fallback; ``encode`` gives packed 32-bit ids, ``decode`` the text."""

    def __init__(self, model: P.Model):
        self.model = model
        history = {p: merge_history(p, model.rank) for p in model.ids}
        #: The pieces that A accepts alone, with how merging makes them.
        self.whole = {p: ([*h[0], NEVER], h[1], h[2]) for p, h in history.items() if h[3] == 1}
        self.pair_weight: dict[tuple[str, str], float] = {}
        self.known = Known(self)

    def weight(self, left: str, right: str) -> float:
        """The weight of A's arc from piece ``left`` to piece ``right``: 1, or infinite.

        Both pieces' merges are replayed side by side, lowest rank first. The arc is closed if at
        some step the symbols at the border would merge before either piece's next merge (ties go
        to the leftmost)."""
        w = self.pair_weight.get((left, right))
        if w is None:
            rank = self.model.rank
            ranks_a, _, ends = self.whole[left]
            ranks_b, starts, _ = self.whole[right]
            a = b = 0
            w = 1.0
            while True:
                next_a, next_b = ranks_a[a], ranks_b[b]
                across = rank.get(ends[a] + starts[b], NEVER)
                if across < next_a and across <= next_b and across != NEVER:
                    w = INFINITE
                    break
                if next_a == next_b == NEVER:
                    break
                if next_a <= next_b:
                    a += 1
                else:
                    b += 1
            if len(self.pair_weight) >= CACHED_PAIRS:
                self.pair_weight.clear()
            self.pair_weight[left, right] = w
        return w

    def shortest(self, segment: str) -> list[str]:
        """The shortest path through the lattice of one segment, as pieces and single characters
        that fall back to bytes."""
        n, whole, prefixes, longest = len(segment), self.whole, self.model.prefixes, self.model.longest
        best = [INFINITE] * (n + 1)
        last: list[str] = [""] * (n + 1)  # the piece on the best path into each position ("": barrier)
        best[0] = 0.0
        for i in range(n):
            if best[i] == INFINITE:
                continue
            before, base = last[i], best[i]
            if segment[i] not in whole:  # in no piece: byte fallback, nothing merges across it
                best[i + 1], last[i + 1] = base + 1.0, ""
                continue
            for j in range(i + 1, min(n, i + longest) + 1):
                piece = segment[i:j]
                if piece not in prefixes:
                    break
                if piece in whole and base + 1.0 < best[j]:
                    w = base + (self.weight(before, piece) if before else 1.0)
                    if w < best[j]:
                        best[j], last[j] = w, piece
        out, j = [], n
        while j:
            piece = last[j] or segment[j - 1]
            out.append(piece)
            j -= len(piece)
        return out[::-1]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(map(self.known.__getitem__, self.model.split(self.model.normalise(text))))

    def decode(self, ids) -> str:
        """The text of a sequence of ids: pieces and fallback bytes joined, the mark in front
        dropped, bytes that are not UTF-8 replaced."""
        raw = b"".join(map(self.model.surface.__getitem__, ids))
        if self.model.dummy_prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


class Known(dict):
    """The packed ids of each segment; encoded when first asked for."""

    def __init__(self, fst: Transducer):
        super().__init__()
        self.fst = fst

    def __missing__(self, segment: str) -> bytes:
        ids, byte_ids, out = self.fst.model.ids, self.fst.model.byte_ids, array("i")
        for piece in self.fst.shortest(segment):
            if piece in ids:
                out.append(ids[piece])
            else:
                out.extend(byte_ids[b] for b in piece.encode())
        packed = out.tobytes()
        if len(segment) <= CACHED_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[segment] = packed
        return packed


def transducer(data: bytes) -> Transducer:
    """The compiled transducer, once per Python worker."""
    model = P.model_of(data)
    mine = kept("pieces")
    if ("transducer", id(model)) not in mine:
        mine["transducer", id(model)] = Transducer(model)
    return mine["transducer", id(model)]


def encoder(spark, model_path: str | None = None):
    """A column function: text -> array<int> of piece ids. A null text gives an empty array."""
    model = prepare(spark).sparkContext.broadcast(P.read_model(model_path))

    def encode(texts: pa.Array) -> pa.Array:
        fst = transducer(model.value)
        return _lists([fst.encode(t.as_py()) for t in texts])

    return F.arrow_udf(encode, "array<int>")


def _lists(packed: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(packed) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def _round_tripper(spark, model_path: str | None = None):
    """A column function: text -> (ids, the text decoded from them), each text encoded once."""
    model = prepare(spark).sparkContext.broadcast(P.read_model(model_path))

    def run(texts: pa.Array) -> pa.Array:
        fst = transducer(model.value)
        packed = [fst.encode(t.as_py()) for t in texts]
        decoded = pa.array([fst.decode(memoryview(p).cast("i").tolist()) for p in packed], pa.string())
        return pa.StructArray.from_arrays([_lists(packed), decoded], names=["ids", "decoded"])

    return F.arrow_udf(run, "ids array<int>, decoded string")


def decoder(spark, model_path: str | None = None):
    """A column function: array<int> of piece ids -> text. A null array gives the empty text; an
    id outside the vocabulary is an error."""
    model = prepare(spark).sparkContext.broadcast(P.read_model(model_path))

    def decode(ids: pa.Array) -> pa.Array:
        fst = transducer(model.value)
        flat, out, at = ids.flatten().to_numpy(zero_copy_only=False).tolist(), [], 0
        for n in ids.value_lengths().to_pylist():
            out.append(fst.decode(flat[at : at + (n or 0)]))
            at += n or 0
        return pa.array(out, pa.string())

    return F.arrow_udf(decode, "string")


def encode_documents(docs: DataFrame, model_path: str | None = None, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with the column ``ids`` (array<int>, replaced if there) and, if named, the text
    ``decoded`` from those ids.

    Null and empty texts give no ids and decode to the empty text; repeated rows are each encoded;
    texts of any length are encoded whole. Decoding gives the text back except that U+2581, which
    the model reads as a space, comes back as a space. No shuffle.
    """
    spark = docs.sparkSession
    if not decoded:
        return docs.withColumn(ids, encoder(spark, model_path)(F.col(text)))
    both = docs.withColumn("__both", _round_tripper(spark, model_path)(F.col(text)))
    return both.withColumns({ids: F.col("__both.ids"), decoded: F.col("__both.decoded")}).drop("__both")


def round_trip(text: Column, decoded: Column) -> Column:
    """Whether ``decoded`` is the text (null: empty), up to the space mark being a space."""
    return decoded == F.replace(F.coalesce(text, F.lit("")), F.lit(P.SPACE), F.lit(" "))

"""Secret scans (operator 4): rules, and a character convolutional network over every candidate.

Rules find assignments to secret names, access keys and long hex strings. Candidates are runs of
key-like characters that are long or have a digit or mixed case in them. A small network in numpy (character embeddings, one
convolution, maximum over positions, logistic output) reads each candidate with the text around
it, a long one in overlapping stretches, of which the likeliest counts. It is trained on labelled findings, where a rule's finding is a secret and any other candidate
isn't; some examples are shown without their surroundings, so that the shape alone has to do as
well. Its outputs are calibrated on a fold of their own (Platt scaling), and the threshold is the
highest that still finds the wanted share of that fold's secrets without their surroundings. The rules' findings always stay;
the network adds candidates beside them, also what they leave of a run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kabuto.llm.common import prepare

KINDS = ("assign", "access", "hex", "model")  # in the order of ties
SAMPLE_DOCS = 20_000  # documents the network is trained on, at most (those of smallest hash)
SAMPLE_FINDINGS = 4000  # findings, and other candidates, at most
MIN_STEPS = 1200  # small samples get more epochs, to make so many
MIN_LENGTH = 8  # of a candidate
LONG = 16  # of a candidate by its length alone
BEFORE, INSIDE, AFTER = 24, 56, 16  # characters that the network sees at a time
VIEWS = 8192  # views held at a time while texts are scanned
_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_NAMES = ("password", "passwd", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_DIGIT = re.compile(r"[0-9]")
_MIXED = re.compile(r"[a-z][A-Z]")
_RUNS = re.compile(r"[A-Za-z0-9+/_=.-]{8,}")  # of MIN_LENGTH

Span = tuple[int, int, int]  # start, kind, end


def rule_spans(text: str) -> list[Span]:
    """The rules' findings, sorted by start and kind (code points, end exclusive)."""
    out = []
    lower = text.lower()
    if any(name in lower for name in _NAMES):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int]]:
    """Maximal runs of key-like characters that ``may_be_key``."""
    return [m.span() for m in _RUNS.finditer(text) if may_be_key(m[0])]


def may_be_key(run: str) -> bool:
    """Whether the network is to decide on a run: one of ``MIN_LENGTH`` or more with a digit or with
    capitals inside of a word, or of ``LONG`` or more."""
    return len(run) >= LONG or len(run) >= MIN_LENGTH and (_DIGIT.search(run) is not None or _MIXED.search(run) is not None)


def rests(start: int, end: int, spans: list[Span]) -> Iterator[tuple[int, int]]:
    """What ``spans`` (sorted) leave of a run, as far as it is a candidate by its length."""
    for s, _, e in spans:
        if s < end and start < e:
            if s - start >= MIN_LENGTH:
                yield start, s
            start = max(start, e)
    if end - start >= MIN_LENGTH:
        yield start, end


def view(text: str, start: int, end: int) -> bytes:
    """What the network sees of a stretch (``INSIDE`` characters at most): these and those around it."""
    end = min(end, start + INSIDE)
    inside = text[start:end]
    before, after = text[max(0, start - BEFORE) : start], text[end : end + AFTER]
    parts = before.rjust(BEFORE, "\0"), inside.ljust(INSIDE, "\0"), after.ljust(AFTER, "\0")
    return "".join(parts).encode("ascii", "replace")


def stretches(start: int, end: int) -> Iterator[tuple[int, int]]:
    """Stretches of ``INSIDE`` characters at most that cover a candidate, each half over the next."""
    for at in range(start, max(start + 1, end - INSIDE // 2), INSIDE // 2):
        last = at + INSIDE >= end
        yield (max(start, end - INSIDE) if last else at), min(end, at + INSIDE)


def touches(start: int, end: int, spans: list[Span]) -> bool:
    return any(s < end and start < e for s, _, e in spans)


def blinded(seen: bytes) -> bytes:
    """A view without what surrounds the stretch."""
    return b"\0" * BEFORE + seen[BEFORE : BEFORE + INSIDE] + b"\0" * AFTER


def _codes(views: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(views), np.uint8).reshape(len(views), BEFORE + INSIDE + AFTER) & 127


@dataclass
class Network:
    """Embeddings (128 x d), convolution (width * d x filters) and output, with the calibration's
    slope and offset and the threshold on the calibrated probability."""

    table: np.ndarray
    kernel: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 0.5

    def patches(self, codes: np.ndarray) -> np.ndarray:
        x = self.table[codes]
        width = self.kernel.shape[0] // x.shape[2]
        return np.concatenate([x[:, k : x.shape[1] - width + 1 + k] for k in range(width)], 2)

    def logits(self, codes: np.ndarray) -> np.ndarray:
        found = [np.zeros(0)]
        for lo in range(0, len(codes), 1024):
            hidden = (self.patches(codes[lo : lo + 1024]) @ self.kernel).max(1) + self.shift
            found.append(np.maximum(hidden, 0) @ self.out + self.bias)
        return np.concatenate(found)

    def probability(self, views: list[bytes]) -> np.ndarray:
        z = self.slope * self.logits(_codes(views)) + self.offset if views else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def train(views: list[bytes], labels: list[int], dims: int = 6, width: int = 5, filters: int = 24, epochs: int = 12, batch: int = 64, rate: float = 0.01, recall: float = 0.99, blind: float = 0.3, seed: int = 5) -> Network | None:
    """Train, calibrate and set the threshold; None without at least ten examples of both kinds."""
    y, codes = np.array(labels, np.float64), _codes(views) if views else np.zeros((0, 1))
    if min(y.sum(), (1 - y).sum()) < 10:
        return None
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.3, (128, dims)), rng.normal(0, 0.2, (width * dims, filters)), np.zeros(filters), rng.normal(0, 0.3, filters), 0.0)
    fold = np.zeros(len(y), bool)
    for side in (0, 1):
        at = rng.permutation(np.flatnonzero(y == side))
        fold[at[: max(2, len(at) // 5)]] = True
    rows = np.flatnonzero(~fold)
    weight = np.where(y == 1, 0.5 / y[rows].mean(), 0.5 / (1 - y[rows].mean()))
    params = {"table": net.table, "kernel": net.kernel, "shift": net.shift, "out": net.out, "bias": np.zeros(1)}
    first, second = ({k: np.zeros_like(p) for k, p in params.items()} for _ in range(2))
    step = 0
    for _ in range(max(epochs, MIN_STEPS // -(-len(rows) // batch))):
        rng.shuffle(rows)
        for lo in range(0, len(rows), batch):
            at = rows[lo : lo + batch]
            c = codes[at].copy()
            hide = rng.random(len(at)) < blind
            c[hide, :BEFORE] = 0
            c[hide, BEFORE + INSIDE :] = 0
            p = net.patches(c)
            scores = p @ net.kernel
            top = scores.argmax(1)
            hidden = np.take_along_axis(scores, top[:, None], 1)[:, 0] + net.shift
            active = np.maximum(hidden, 0)
            z = active @ net.out + params["bias"][0]
            error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y[at]) * weight[at] / len(at)
            back = error[:, None] * net.out * (hidden > 0)
            best = np.take_along_axis(p, top[:, :, None], 1)  # (examples, filters, patch)
            grads = {"kernel": np.einsum("bfp,bf->pf", best, back), "shift": back.sum(0), "out": active.T @ error, "bias": error.sum(keepdims=True)}
            spread = np.einsum("bf,pf->bfp", back, net.kernel).reshape(-1, dims)
            spots = (top[:, :, None] + np.arange(width)).reshape(len(at), -1)
            letters = np.take_along_axis(c, spots, 1).ravel()
            grads["table"] = np.stack([np.bincount(letters, spread[:, d], 128) for d in range(dims)], 1)
            step += 1
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                params[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            net.bias = float(params["bias"][0])
    # Without their surroundings: the candidates to be found have no name of a secret before them.
    alone = [blinded(views[k]) for k in np.flatnonzero(fold)]
    z, t = net.logits(_codes(alone)), y[fold]
    spread = max(float(np.abs(z).max()), 1e-9)
    a, b = 1.0, 0.0
    for _ in range(500):  # Platt scaling, with smoothed targets
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -60, 60)))
        e = p - np.where(t == 1, (t.sum() + 1) / (t.sum() + 2), 1 / ((1 - t).sum() + 2))
        a, b = a - 2.0 * (e * z).mean() / spread**2, b - 2.0 * e.mean()
    net.slope, net.offset = max(float(a), 1e-3), float(b)
    hit = np.sort(net.probability(alone)[t == 1])
    net.threshold = float(hit[int((1 - recall) * len(hit))])
    return net


def find(text: str | None, net: Network | None) -> list[Span]:
    """All spans of one text, sorted by start and kind."""
    return find_all([text], net)[0]


def find_all(texts: list[str | None], net: Network | None) -> list[list[Span]]:
    found, views, owners = [], [], []

    def score() -> None:
        """A candidate is as likely as the likeliest of its stretches."""
        for (k, start, end), p in zip(owners, net.probability(views).tolist(), strict=True):
            if p >= net.threshold and found[k][-1:] != [(start, 3, end)]:
                found[k].append((start, 3, end))
        views.clear()
        owners.clear()

    for k, text in enumerate(texts):
        spans = rule_spans(text) if text else []
        found.append(list(spans))
        if net is not None and text:
            for run in candidates(text):
                for start, end in rests(*run, spans):
                    if not may_be_key(text[start:end]):
                        continue
                    for s, e in stretches(start, end):
                        views.append(view(text, s, e))
                        owners.append((k, start, end))
                        if len(views) >= VIEWS:
                            score()
    if views:
        score()
    return [sorted(x) for x in found]


def labelled_views(text: str) -> Iterator[tuple[bytes, int]]:
    """The views of a text's candidates, with 1 for a rule's finding and 0 for others. What such a
    finding leaves of a run is neither."""
    spans = rule_spans(text)
    for start, end in candidates(text):
        found = touches(start, end, spans)
        for s, e in stretches(start, end):
            if not found or touches(s, e, spans):
                yield view(text, s, e), int(found)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS, sample_findings: int = SAMPLE_FINDINGS, **training) -> Network | None:
    """Train on the findings in at most about ``sample_docs`` documents (those whose id has the
    smallest hash; repeated ids come together), at most ``sample_findings`` of either kind. Only
    the network's views of these reach the driver."""
    prepare(docs.sparkSession)
    rows = docs.select(F.xxhash64(F.col(id_col)).alias("_h"), F.col(text_col).alias("_t"))
    cut = rows.select("_h").orderBy("_h").limit(sample_docs).agg(F.max("_h")).first()[0]
    if cut is None:
        return None

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, labels = [], []
            for t in batch.column(0):
                text = t.as_py()
                if not text:
                    continue
                for v, y in labelled_views(text):
                    seen.append(v)
                    labels.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.binary()), pa.array(labels, pa.int32())], names=["view", "label"])

    # Equal views add nothing: a passage copied a million times is one example.
    labelled = rows.where(F.col("_h") <= cut).select("_t").mapInArrow(label, "view binary, label int").distinct()
    some = [labelled.where(F.col("label") == y).orderBy(F.xxhash64("view"), "view").limit(sample_findings) for y in (0, 1)]
    sample = some[0].union(some[1]).collect()
    return train([bytes(r["view"]) for r in sample], [r["label"] for r in sample], **training)



def scanner(spark, net: Network | None):
    """A column function: text -> array of (kind, start, end), sorted by start and kind; a null or
    empty text has none."""
    sent = prepare(spark).sparkContext.broadcast(net)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(texts: pa.Array) -> pa.Array:
        found = find_all(texts.to_pylist(), sent.value)
        return pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans] for spans in found], pa.list_(kind))

    return F.arrow_udf(scan, "array<struct<kind:string,start:long,end:long>>")


def masker(spark, net: Network | None, mark: str = "[SECRET]"):
    """A column function: text -> the text with every stretch of spans replaced by ``mark`` (null
    stays null, a text without spans stays as it is)."""
    sent = prepare(spark).sparkContext.broadcast(net)

    def mask(texts: pa.Array) -> pa.Array:
        whole = texts.to_pylist()
        return pa.array([masked(t, spans, mark) for t, spans in zip(whole, find_all(whole, sent.value), strict=True)], pa.string())

    return F.arrow_udf(mask, "string")


def masked(text: str | None, spans: list[Span], mark: str) -> str | None:
    if not text or not spans:
        return text
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def scan_documents(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_assign, n_access, n_hex, base_sha256 (of the rules'
    spans as kind:start:end, joined by commas), spans (all, joined alike) and n_model. Whole texts;
    a null or empty text has no spans; repeated rows are each scanned; no shuffle."""
    found = docs.select(F.col(id_col), scanner(docs.sparkSession, net)(F.col(text_col)).alias("_s"))
    shown = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("_s", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("_s", lambda x: x["kind"] != "model")
    return found.select(
        id_col,
        *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(shown(base), 256).alias("base_sha256"),
        shown(F.col("_s")).alias("spans"),
        count("model").alias("n_model"),
    )

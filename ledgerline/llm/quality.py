"""Quality: a generalised additive model with pairwise interactions, learnt as lookup tables.

Each whole text becomes a few numbers (``FEATURES``). Each feature is cut into at most
``BINS`` bins at quantiles of the training rows. Training boosts the logistic loss in
cycles: one shallow tree per feature and round, whose leaves are added to that
feature's table. Then the ``PAIRS`` pairs of features whose best quadrant split
explains most of what is left get a two-way table each, boosted in cycles by trees
that split on one feature and then on the other. A score is the logistic of the
intercept plus one table entry per feature and pair, looked up by bin for a whole
batch at a time.

The model learns from at most ``SAMPLE_DOCS`` labelled documents (the smallest by a
hash of the id); Spark computes their features and the driver boosts that bounded
matrix. Scoring reads every text whole.

Rows: a null or empty text has all features 0 and a score like any other; null and
repeated ids pass through, one result row per input row; labels without a document or
with a null label are not used; without labels of both kinds every score is the share
of good labels (0.5 without any); an empty table gives no rows; only the named columns
are read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_texts, held_out, slices, text_of, wrapped

#: Labelled documents that the model learns from, at most.
SAMPLE_DOCS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, PENALTY = 150, 60, 0.15, 5.0
#: A text is good from this score on.
THRESHOLD = 0.3

FEATURES = (
    "log_words", "mean_word", "longest_word", "upper", "digit", "mark", "strong_mark", "white", "non_ascii",
    "distinct_words", "top_word", "repeated_next", "distinct_pairs", "log_lines", "distinct_lines",
    "short_words", "ends_in_mark", "byte_entropy",
)

_KIND = np.zeros(256, np.int64)                     # 0 lower case and the rest
_KIND[65:91] = 1                                    # upper case
_KIND[48:58] = 2                                    # digits
for _c in b".,;:'\"()-?":
    _KIND[_c] = 3                                   # common marks
for _c in b"!#$%&*+/<=>@[\\]^_`{|}~":
    _KIND[_c] = 4                                   # strong marks
for _c in b" \t\n\r\x0b\x0c":
    _KIND[_c] = 5                                   # white space
_KIND[128:] = 6


def features(text: str) -> list[float]:
    """The numbers of one whole text, in the order of ``FEATURES``."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    if not len(raw):
        return [0.0] * len(FEATURES)
    by_byte = np.bincount(raw, minlength=256)
    kinds = np.bincount(_KIND, by_byte, 7) / len(raw)
    share = by_byte[by_byte > 0] / len(raw)
    words = text.split()
    n = max(len(words), 1)
    low = text.lower().split()
    lines = text.split("\n")
    lens = list(map(len, words)) or [0]
    counts = Counter(low)
    return [
        np.log1p(len(words)), sum(lens) / n, max(lens), kinds[1], kinds[2], kinds[3], kinds[4], kinds[5], kinds[6],
        len(counts) / n, max(counts.values(), default=0) / n, sum(map(eq, low, low[1:])) / n,
        len(set(zip(low, low[1:]))) / n, np.log1p(len(lines)), len(set(lines)) / len(lines),
        sum(x <= 3 for x in lens) / n, sum(not w[-1].isalnum() for w in words) / n, -float((share * np.log(share)).sum()),
    ]


@dataclass
class Tables:
    """Bin edges per feature, a table per feature and per pair, and the intercept."""

    edges: list[np.ndarray]
    intercept: float
    single: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    double: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for the rows of ``x``: table entries added by bin."""
        total = np.full(len(x), self.intercept)
        for j, (e, t) in enumerate(zip(self.edges, self.single)):
            total += t[np.searchsorted(e, x[:, j], side="right")]
        for (a, b), t in zip(self.pairs, self.double):
            total += t[np.searchsorted(self.pair_edges[a], x[:, a], side="right"),
                       np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -40, 40)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))


def _gain(g, h):
    return g * g / (h + PENALTY)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """The cut (bins before it go left) with the largest gain."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0, 0.0
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    k = int(gains.argmax())
    return k + 1, float(gains[k])


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf value of every bin of a shallow tree over one feature's bins."""
    if depth:
        k, gain = _cut(g, h)
        if gain > 1e-9:
            return np.concatenate([_tree(g[:k], h[:k], depth - 1), _tree(g[k:], h[k:], depth - 1)])
    return np.full(len(g), -RATE * g.sum() / (h.sum() + PENALTY))


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree that splits on the first feature, then each side on the second: leaf values and gain."""
    best, value = 0.0, np.zeros_like(g)
    for k in range(1, len(g)):
        parts, gain = [], -_gain(g.sum(), h.sum())
        for side in (slice(0, k), slice(k, None)):
            sg, sh = g[side].sum(0), h[side].sum(0)
            c, more = _cut(sg, sh)
            gain += more + _gain(sg.sum(), sh.sum())
            parts.append((side, c, sg, sh))
        if gain > best:
            best, value = gain, np.zeros_like(g)
            for side, c, sg, sh in parts:
                for cols in (slice(0, c), slice(c, None)):
                    value[side, cols] = -RATE * sg[cols].sum() / (sh[cols].sum() + PENALTY)
    return value, best


def boost(x: np.ndarray, y: np.ndarray) -> Tables:
    """Fit the tables on rows ``x`` with labels ``y`` (0 or 1)."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    edges = [_edges(x[:, j], BINS) if len(x) else np.zeros(0) for j in range(len(FEATURES))]
    single = [np.zeros(len(e) + 1) for e in edges]
    model = Tables(edges, float(np.log(share / (1 - share))), single)
    if len(set(y.tolist())) < 2:
        return model
    margin = np.full(len(y), model.intercept)

    def slopes():
        p = 1.0 / (1.0 + np.exp(-margin))
        return p - y, p * (1 - p)

    at = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    for _ in range(ROUNDS):
        for j, t in enumerate(single):
            g, h = slopes()
            step = _tree(np.bincount(at[j], g, len(t)), np.bincount(at[j], h, len(t)))
            t += step
            margin += step[at[j]]
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(len(FEATURES))]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.pair_edges)]
    size = [len(e) + 1 for e in model.pair_edges]

    def two_way(a: int, b: int):
        g, h = slopes()
        cell, shape = coarse[a] * size[b] + coarse[b], (size[a], size[b])
        return cell, np.bincount(cell, g, size[a] * size[b]).reshape(shape), np.bincount(cell, h, size[a] * size[b]).reshape(shape)

    gains = []
    for a, b in combinations(range(len(FEATURES)), 2):
        _, g, h = two_way(a, b)
        gains.append((-_quadrants(g, h)[1], a, b))
    model.pairs = [(a, b) for _, a, b in sorted(gains)[:PAIRS]]
    model.double = [np.zeros((size[a], size[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), t in zip(model.pairs, model.double):
            cell, g, h = two_way(a, b)
            step, _ = _quadrants(g, h)
            t += step
            margin += step.ravel()[cell]
    return model


def _matrix(texts: list[str]) -> np.ndarray:
    return np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Tables:
    """Features of the sampled labelled documents that are not held out, and the boosted tables."""
    labels = (labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
              .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(SAMPLE_DOCS))
    sample = doc_texts(docs).join(F.broadcast(labels), "doc_id")
    # one row of a repeated id, the text of the smallest hash: the matrix has SAMPLE_DOCS rows at most
    sample = (sample.groupBy("doc_id").agg(F.first("quality").alias("y"), F.min(F.struct(F.xxhash64("text"), "text")).alias("t"))
              .select("y", F.col("t.text").alias("text")))

    def run(batches):
        for b in slices(batches):
            x = _matrix(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(x), pa.list_(pa.float64()))], ["y", "x"])

    rows = sample.mapInArrow(run, "y int, x array<double>").toArrow()
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    y = rows.column("y").to_numpy().astype(float)
    order = np.lexsort((*x.T, y))                    # the same model whatever order the rows arrive in
    return boost(x[order], y[order])


def score_documents(docs: DataFrame, model: Tables) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text."""
    src = doc_texts(docs)

    def run(batches):
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(_matrix(b.column(1).to_pylist())))],
                                             ["doc_id", "score"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Tables) -> DataFrame:
    """``docs`` without the rows whose text scores below ``THRESHOLD``; all columns kept."""
    src = wrapped(docs, text=text_of())

    def run(batches):
        for b in slices(batches):
            score = model.score(_matrix(b.column(1).to_pylist()))
            yield b.select(["r"]).filter(pa.array(score >= THRESHOLD, pa.bool_()))

    return src.mapInArrow(run, src.select("r").schema).select("r.*")

"""Toxicity: a support vector machine on the gap-weighted subsequence string kernel, with Nystroem landmarks.

Texts are cut into segments (runs of non-space characters without punctuation; three or more single letters in a row are one segment;
segments over ``SEGMENT`` characters are cut into overlapping ones). The kernel of
two segments counts their common subsequences of ``ORDER`` characters within a span
of ``SPAN``, each weighted by ``DECAY`` per character of span, normalised to 1 for
equal segments: inserted or dropped characters cost a factor, not the match. Each segment
is compared with a mark before its first and one after its last character, so a stem that
begins or ends a segment differs from the same letters inside one.

A departure: no sentence is built. The method labels and compares sentences; here every
word is compared alone. So an insult of several words whose single words also stand in
clean texts is missed, and so is one cut by a space, unless in single letters.

Training, on a bounded sample of labelled documents (``SAMPLE_DOCS``, one text of each id;
of their segments ``TOXIC_SEGMENTS`` and ``CLEAN_SEGMENTS`` at most, the most frequent first,
are training rows): every segment in a clean document is clean. In each toxic document its witness is toxic: the segment met in most other toxic documents
and in no clean one, or ``RATIO`` times as often in toxic documents as in clean ones and
not by chance (exact binomial test; a quoting or mislabelled document costs no insult).
Such witnesses are left out of the clean segments. A linear SVM learns on Nystroem features (kernel values to
``LANDMARKS`` landmark segments, whitened by the landmarks' own kernel matrix), finds
the segments that it thinks toxic in toxic documents or wrongly in clean ones, and learns
once more with these as rows and, of the wrong ones, as landmarks. A text scores its most
toxic segment, through a logistic curve fitted on the training documents.

For scoring, the learnt function (a weighted sum of kernels to landmarks) is folded
into one weight per character subsequence: the same value, since the kernel is an
inner product of subsequence counts.

Rows: a null or empty text scores the curve's value for a text without segments, that
is clean; null and repeated ids pass through, one result row per input row; labels
without a document or with a null label are not used; of rows that repeat a labelled id one
text is learnt from; witnesses that tie are taken in their order as text; texts are read
whole, however long; without labels of both kinds every score is 0; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_texts, held_out, slices, text_of, wrapped

#: Labelled documents that the model learns from, at most (the smallest by a hash of the id).
SAMPLE_DOCS = 12_000
#: Segments of the training set: toxic ones, and clean ones (the most frequent, then by hash).
TOXIC_SEGMENTS, CLEAN_SEGMENTS = 2_000, 20_000
#: A segment of clean documents too is a witness if it is so many times as frequent in toxic ones, and that by chance
#: at most so likely.
RATIO, CHANCE = 10, 1e-6
ORDER, SPAN, DECAY = 3, 5, 0.6
LANDMARKS = 512
SEGMENT = 24
#: Stand around each segment where segments are compared.
START, END = "^", "$"
#: Scores kept in a worker's cache of segments; it starts anew beyond that.
CACHE_SEGMENTS = 300_000

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_MARKS = re.compile(r"[\W_]+")
_SPELLED = re.compile(r"(?<!\S)(?:\w[^\w\s]? ){2,}\w(?![^\s.,;:!?])")


def segments(text: str) -> set[str]:
    """Distinct segments of a whole text, in lower case."""
    text = text.lower()
    out = set(text.split())
    for m in _SPELLED.finditer(text):
        out.add(re.sub(r"\W", "", m[0]))
    return out


def trimmed(segment: str) -> list[str]:
    """A raw segment without outer punctuation, in parts of at most ``SEGMENT`` characters that overlap by half."""
    if not segment.isalpha():
        segment = _EDGE.sub("", segment)
        if not segment.isalnum():             # "id-iot": without the marks inside
            segment = _MARKS.sub("", segment)
    if len(segment) <= SEGMENT:
        return [segment] if len(segment) >= ORDER else []
    return [segment[i:i + SEGMENT] for i in range(0, len(segment) - SEGMENT // 2, SEGMENT // 2)]


#: Positions within a span: a first character, then two more, up to SPAN - 1 further on.
_OFFSETS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, key and weight of the subsequences of ``ORDER`` characters within ``SPAN``, of all words at once.

    Once per word and key, their weights summed and scaled to unit length per word.
    """
    joined = np.frombuffer(("\0" + "".join(w + "\0" * (SPAN - 1) for w in words)).encode("utf-32-le"), np.uint32)
    letters, code = np.unique(joined, return_inverse=True)       # the zero between words gets code 0
    letters, code = letters.astype(np.int64), code.astype(np.int64)[1:]
    bits = max(1, int(len(letters) - 1).bit_length())
    n = len(code)
    row = np.repeat(np.arange(len(words)) << 3 * bits, np.fromiter((len(w) + SPAN - 1 for w in words), np.int64, len(words)))
    packed, weights = [], []
    for a, b in _OFFSETS:
        x, y, z = code[:n - b], code[a:n - b + a], code[b:]
        ok = (x > 0) & (y > 0) & (z > 0)
        packed.append((row[:n - b] | x << 2 * bits | y << bits | z)[ok])
        weights.append(np.full(len(packed[-1]), DECAY ** (b + 1)))
    packed, weights = np.concatenate(packed), np.concatenate(weights)
    order = np.argsort(packed)
    packed, weights = packed[order], weights[order]
    if not len(packed):
        return packed, packed, weights
    start = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]]))
    packed, weights = packed[start], np.add.reduceat(weights, start)
    rows, low = packed >> 3 * bits, (1 << bits) - 1
    keys = letters[packed >> 2 * bits & low] << 42 | letters[packed >> bits & low] << 21 | letters[packed & low]
    return rows, keys, weights / np.sqrt(np.bincount(rows, weights ** 2, len(words)))[rows]


def kernel(words: list[str], landmarks: list[str], block: int = 4096) -> np.ndarray:
    """Normalised subsequence kernel between words and landmarks."""
    lr, lk, lv = subsequences(landmarks)
    vocab, at = np.unique(lk, return_inverse=True)
    land = np.zeros((len(vocab) + 1, len(landmarks)), np.float32)
    land[at, lr] = lv
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for k in range(0, len(words), block):
        r, key, v = subsequences(words[k:k + block])
        pos = np.minimum(np.searchsorted(vocab, key), len(vocab) - 1)
        hit = vocab[pos] == key
        r, pos, v = r[hit], pos[hit], v[hit].astype(np.float32)
        for j in range(0, len(r), 1 << 14):
            np.add.at(out, k + r[j:j + (1 << 14)], land[pos[j:j + (1 << 14)]] * v[j:j + (1 << 14), None])
    return out


def _marked(words: list[str]) -> list[str]:
    return [START + w + END for w in words]


@dataclass
class Model:
    """Sorted subsequence keys with their weights, the bias, and the logistic curve's slope and offset."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, words: list[str]) -> np.ndarray:
        """Signed distance of each segment: the SVM's sum of kernels to landmarks."""
        if not len(self.keys):
            return np.full(len(words), self.bias)
        rows, keys, weights = subsequences(_marked(words))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return np.bincount(rows[hit], self.weights[at[hit]] * weights[hit], len(words)) + self.bias

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -40, 40)))


#: Scored for a text without any segment.
_NO_SEGMENT = -4.0


def training_segments(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, toxic, segment`` of the sampled labelled documents that are not held out, once per document."""
    labels = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
              .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(SAMPLE_DOCS))
    sample = doc_texts(docs).join(F.broadcast(labels), "doc_id")
    # one row an id: of its texts the smallest by a hash
    sample = sample.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"),
                                          F.max("toxic").alias("toxic"))

    def run(batches):
        for b in slices(batches):
            ids, tox, seg = [], [], []
            for i, text, y in zip(*(b.column(k).to_pylist() for k in range(3))):
                found = {p for s in segments(text) for p in trimmed(s)}
                ids.extend([i] * len(found))
                tox.extend([y] * len(found))
                seg.extend(sorted(found))
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.column(0).type), pa.array(tox, pa.int32()), pa.array(seg, pa.string())],
                                             ["doc_id", "toxic", "segment"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    return sample.mapInArrow(run, f"doc_id {kind}, toxic int, segment string")


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, seed: int = 7) -> Model:
    """Fit on the sample: Spark counts segments and picks witnesses, the driver solves the bounded SVM."""
    found = training_segments(spark, docs, labels).persist()
    try:
        by = (found.groupBy("segment")
              .agg(F.sum(F.col("toxic").cast("long")).alias("t"), F.sum(1 - F.col("toxic")).alias("c")).persist())
        # witness of a toxic document: its segment in most toxic documents, of those in no clean one or in few
        n = {r["toxic"]: r["n"] for r in found.groupBy("toxic").agg(F.count_distinct("doc_id").alias("n")).collect()}
        often = by.where((F.col("c") > 0) & (F.col("t") > 1) & (F.col("t") * n.get(0, 0) >= RATIO * F.col("c") * n.get(1, 0)))
        often = [r["segment"] for r in often.orderBy(F.desc("t"), "segment").limit(TOXIC_SEGMENTS).collect()
                 if _by_chance(r["t"], r["c"], n.get(1, 0) / max(1, sum(n.values()))) < CHANCE]
        only = by.where((F.col("c") == 0) & (F.col("t") > 0) | F.col("segment").isin(often))
        witness = (found.where("toxic = 1").join(only, "segment")
                   .groupBy("doc_id").agg(F.max(F.struct("t", "segment")).alias("w")))
        toxic = [r["segment"] for r in witness.groupBy("w.segment").agg(F.count("*").alias("n"), F.max("w.t").alias("t"))
                 .where("t > 1").orderBy(F.desc("n"), "segment").limit(TOXIC_SEGMENTS).select("segment").collect()]
        clean = [r["segment"] for r in by.where((F.col("c") > 0) & ~F.col("segment").isin(often)).orderBy(F.desc("c"), F.xxhash64("segment")).limit(CLEAN_SEGMENTS)
                 .select("segment").collect()]
        if not toxic or not clean:
            return Model(np.zeros(0, np.int64), np.zeros(0), -1.0, 40.0, 0.0)
        model = _fit(_gapped(toxic, seed), clean, seed)
        # once more, with the segments that the first machine finds toxic in toxic documents, or wrongly in clean ones
        again = _scored(found.groupBy("segment").agg(F.max("toxic").alias("t"), F.min("toxic").alias("c")), model)
        again = again.where("margin > -0.5")
        more = {r["segment"] for r in again.where("c = 1 and margin > 0").orderBy(F.desc("margin"), "segment")
                .limit(TOXIC_SEGMENTS).select("segment").collect()}
        hard = [r["segment"] for r in again.where((F.col("c") == 0) & ~F.col("segment").isin(often)).orderBy(F.desc("margin"), "segment")
                .limit(CLEAN_SEGMENTS).select("segment").collect()]
        model = _fit(_gapped(sorted({*toxic, *more}), seed), sorted({*clean, *hard}), seed, hard)
        best = _scored(found, model).groupBy("doc_id").agg(F.max("toxic").alias("y"), F.max("margin").alias("m")).collect()
        model.slope, model.offset = _curve(np.array([r["m"] for r in best]), np.array([r["y"] for r in best]))
        by.unpersist()
        return model
    finally:
        found.unpersist()


def _by_chance(t: int, c: int, share: float) -> float:
    """Chance that of ``t + c`` documents ``t`` or more are toxic, where ``share`` of all are (exact binomial tail).

    The terms are added as logarithms: they pass the range of doubles long before the sum does.
    """
    if not 0 < share < 1:
        return float(share >= 1 or t == 0)
    n = t + c
    terms = [lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + (n - k) * log(share) + k * log(1 - share) for k in range(c + 1)]
    most = max(terms)
    return min(1.0, exp(most + log(sum(exp(x - most) for x in terms))))


def _gapped(toxic: list[str], seed: int) -> list[str]:
    """Toxic segments, and each again with one character inserted at a random inner place."""
    rng = np.random.default_rng(seed)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    out = list(toxic)
    for s in toxic:
        at = int(rng.integers(1, len(s)))
        out.append(s[:at] + letters[int(rng.integers(len(letters)))] + s[at:])
    return out


def _scored(df: DataFrame, model: Model) -> DataFrame:
    """``df`` with ``margin`` of its ``segment``."""
    def run(batches):
        for b in batches:
            words = b.column(b.schema.get_field_index("segment")).to_pylist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.margins(words))], [*b.schema.names, "margin"])

    return df.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) + ", margin double")


def _fit(toxic: list[str], clean: list[str], seed: int, hard: list[str] = ()) -> Model:
    """Landmarks, Nystroem features, a squared-hinge SVM by Newton steps, and the folded weights.

    Half of the landmarks at most are toxic; half of the others at most are the first of ``hard`` (clean
    segments that are likeliest mistaken), the rest are drawn from the clean ones.
    """
    rng = np.random.default_rng(seed)
    pick = lambda words, n: [words[i] for i in sorted(rng.permutation(len(words))[:n])]
    landmarks = pick(toxic, LANDMARKS // 2)
    landmarks += hard[:(LANDMARKS - len(landmarks)) // 2]
    landmarks += pick(sorted(set(clean) - set(hard)) or clean, LANDMARKS - len(landmarks))
    words, landmarks = _marked(toxic + clean), _marked(list(dict.fromkeys(landmarks)))
    y = np.concatenate([np.ones(len(toxic)), -np.ones(len(clean))])
    value, vector = np.linalg.eigh(kernel(landmarks, landmarks).astype(float))
    keep = value > 1e-4 * value.max()
    whiten = vector[:, keep] / np.sqrt(value[keep])
    x = kernel(words, landmarks) @ whiten.astype(np.float32)
    weight = np.where(y > 0, len(y) / (2 * len(toxic)), len(y) / (2 * len(clean)))
    w, bias = _svm(x, y, weight)
    beta = whiten @ w
    rows, keys, values = subsequences(landmarks)
    vocab, at = np.unique(keys, return_inverse=True)
    return Model(vocab, np.bincount(at, values * beta[rows], len(vocab)), float(bias), 1.0, 0.0)


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 4.0, steps: int = 30) -> tuple[np.ndarray, float]:
    """Primal SVM with squared hinge loss: Newton steps over the rows inside the margin."""
    n = x.shape[1] + 1
    reg = np.eye(n)
    reg[-1, -1] = 1e-6
    w = np.zeros(n)
    active = np.ones(len(y), bool)
    for _ in range(steps):
        gram, target = reg.copy(), np.zeros(n)
        for k in range(0, len(y), 4096):          # a block of rows at a time in double precision
            at = k + np.flatnonzero(active[k:k + 4096])
            rows = np.concatenate([x[at].astype(float), np.ones((len(at), 1))], axis=1)
            weighted = rows * (c * weight[at])[:, None]
            gram += rows.T @ weighted
            target += weighted.T @ y[at]
        w = np.linalg.solve(gram, target)
        now = y * (x @ w[:-1].astype(np.float32) + w[-1]) < 1
        if (now == active).all():
            break
        active = now
    return w[:-1], w[-1]


def _curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve: 0.5 at the cut with the fewest balanced errors, mid-gap."""
    order = np.argsort(margin)
    m, t = margin[order], y[order].astype(float)
    pos, neg = max(t.sum(), 1.0), max((1 - t).sum(), 1.0)
    # cut k: the first k rows are called clean
    errors = np.concatenate([[neg], neg + np.cumsum(t - (1 - t))]) / (pos + neg)
    best = np.flatnonzero(errors == errors.min())
    k = int(best[len(best) // 2])
    low = m[k - 1] if k else m[0] - 1
    high = m[k] if k < len(m) else m[-1] + 1
    cut = (low + high) / 2
    slope = 8.0 / max(np.median(m[t > 0]) - cut, 0.1) if t.any() else 8.0
    return float(min(slope, 40.0)), float(-min(slope, 40.0) * cut)


class _Scorer:
    """Margins of segments in one worker, with a bounded cache."""

    def __init__(self, model: Model):
        self.model, self.cache = model, {}

    def texts(self, texts: list[str]) -> np.ndarray:
        found = [segments(t) for t in texts]
        cache = self.cache
        if missing := list({s for f in found for s in f if s not in cache}):
            if len(cache) + len(missing) > CACHE_SEGMENTS:
                cache.clear()
                missing = list({s for f in found for s in f})
            parts = [trimmed(s) for s in missing]
            flat = [p for ps in parts for p in ps]
            margins = []
            for k in range(0, len(flat), 1 << 14):
                margins.extend(self.model.margins(flat[k:k + (1 << 14)]).tolist())
            at = 0
            for s, ps in zip(missing, parts):
                cache[s] = max(margins[at:at + len(ps)], default=_NO_SEGMENT)
                at += len(ps)
        return np.array([max(map(cache.__getitem__, f), default=_NO_SEGMENT) for f in found], float)


def score_documents(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text."""
    src = doc_texts(docs)

    def run(batches):
        scorer = _Scorer(model)
        for b in slices(batches):
            p = model.probability(scorer.texts(b.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], ["doc_id", "score"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows whose text is toxic; all columns kept."""
    src = wrapped(docs, text=text_of())

    def run(batches):
        scorer = _Scorer(model)
        for b in slices(batches):
            p = model.probability(scorer.texts(b.column(1).to_pylist()))
            yield b.select(["r"]).filter(pa.array(p < 0.5, pa.bool_()))

    return src.mapInArrow(run, src.select("r").schema).select("r.*")

"""Near-duplicate documents: ProbMinHash signatures of weighted shingles, banding, verification, classes.

A text's elements are its runs of ``SHINGLE`` words (lower case, cut at white space; a
text of fewer words is one element), weighted ``1 + ln(count)``. ProbMinHash lets every
element arrive at random registers as a Poisson process of its weight's rate; a
register keeps its first arrival. Processes run side by side and stop once their
latest arrival is later than every register's first, so the cost is near one arrival
an element. Two texts agree in a register with the probability of their probability
Jaccard similarity, which is the plain Jaccard similarity where weights are even.

Equal texts are one node. Nodes with an equal band of registers share a bucket; of
each bucket its leader is paired with every member (never all pairs). A first round
verifies for each node the pair that shares most bands, a second one lets a class drawn
by lot meet the other classes of its bucket. Then every pair of different classes that
shares a bucket is verified, in the first bucket that it shares: a bucket is cut into
blocks of its nodes, each pair of blocks is a group of its own, and a group compares its
texts by their common elements. No pair is left out, and none is a row. Verification
computes the similarity of two whole texts exactly; links of ``THRESHOLD`` or more make
classes (connected components, by hooking and pointer jumping).

A pair at the threshold shares no bucket with probability (1 - 0.8^ROWS)^BANDS, about
0.00005, and less above it.

Rows: a null text counts as empty; empty texts are equal, so one class; null ids
belong to their text's class (whose ``class_id`` is its smallest id, null if all are
null); repeated rows are copies; an empty table gives none; only ``doc_id`` and
``text`` are read to decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import settled, slices, text_of, wrapped, written

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 25, 5
#: Nodes of a block of a bucket, and characters of their texts, about.
BLOCK, BLOCK_CHARS = 512, 4 << 20
#: Up to so many sets are compared pair by pair.
FEW = 4
#: Word hashes kept in a worker's cache; it starts anew beyond that.
CACHE_WORDS = 500_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _WordHashes()


def elements(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a whole text, sorted, and their weights."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0)
    if len(_WORDS) > CACHE_WORDS:
        _WORDS.clear()
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    k = min(SHINGLE, len(h))
    n = len(h) - k + 1
    s = np.full(n, k, np.uint64)
    for j in range(k):
        s = _mix(s * _GOLDEN + h[j:j + n])
    s, count = np.unique(s, return_counts=True)
    return s, 1.0 + np.log(count)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = BANDS * ROWS) -> np.ndarray:
    """ProbMinHash signature (the element in each register) of every non-empty set."""
    sizes = np.array([len(s) for s, _ in sets], np.int64)
    element = np.concatenate([s for s, _ in sets]) if len(sets) else np.zeros(0, np.uint64)
    rate = np.concatenate([w for _, w in sets]) if len(sets) else np.zeros(0)
    owner = np.repeat(np.arange(len(sets)), sizes)
    first = np.full(len(sets) * registers, np.inf)
    held = np.zeros(len(sets) * registers, np.uint64)
    time = np.zeros(len(element))
    state = element.copy()
    if (single := sizes == 1).any():                 # one element fills every register
        held.reshape(-1, registers)[single] = element[np.isin(owner, np.flatnonzero(single))][:, None]
        keep = ~single[owner]
        element, rate, owner, time, state = element[keep], rate[keep], owner[keep], time[keep], state[keep]
    while len(element):
        state = state + _GOLDEN
        a = _mix(state)
        time = time - np.log(((a >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)) / rate
        slot = owner * registers + (_mix(a ^ _M2) % np.uint64(registers)).astype(np.int64)
        better = np.flatnonzero(time < first[slot])
        better = better[np.argsort(-time[better], kind="stable")]    # the earliest is written last
        first[slot[better]] = time[better]
        held[slot[better]] = element[better]
        last = first.reshape(-1, registers).max(axis=1)
        live = time < last[owner]                    # later arrivals of the others can change nothing
        if not live.all():
            element, rate, owner, time, state = element[live], rate[live], owner[live], time[live], state[live]
    return held.reshape(-1, registers)


def band_keys(sets: list[tuple[np.ndarray, np.ndarray]]) -> list[list[int]]:
    """One signed 64-bit key per band of every set, none for an empty set."""
    sig = signatures([s for s in sets if len(s[0])]).reshape(-1, BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), sig.shape[:2]).copy()
    for r in range(ROWS):
        key = _mix(key * _GOLDEN + sig[:, :, r])
    rows = iter(key.view(np.int64).tolist())
    return [next(rows) if len(s[0]) else [] for s in sets]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard similarity: the sum over common d of 1 / sum over d' of max(a'/a_d, b'/b_d)."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    _, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(at_a):
        return 0.0
    x, y = a[1][at_a], b[1][at_b]
    ratio = x / y
    order = np.argsort(ratio)
    r, x, y = ratio[order], x[order], y[order]
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    # elements of ratio at least r_d count a'/a_d, the others b'/b_d
    cut = np.searchsorted(r, r, side="left")
    above = only_a + x.sum() - np.concatenate([[0.0], np.cumsum(x)])[cut]
    below = only_b + np.concatenate([[0.0], np.cumsum(y)])[cut]
    return float((1.0 / (above / x + below / y)).sum())


def _digest() -> F.Column:
    return F.unhex(F.md5(text_of()))


def _signed(docs: DataFrame) -> DataFrame:
    """``row, doc_id, digest, bands, size`` (characters) of every document."""
    src = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", _digest().alias("digest"),
                      text_of().alias("text"))

    def run(batches):
        for b in slices(batches):
            texts = b.column(3).to_pylist()
            keys = band_keys([elements(t) for t in texts])
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(keys, pa.list_(pa.int64())), pa.array(map(len, texts), pa.int64())],
                                             ["row", "doc_id", "digest", "bands", "size"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"row long, doc_id {kind}, digest binary, bands array<long>, size long")


def _roots(spark: SparkSession, parents: DataFrame) -> DataFrame:
    """``node, label``: the root above each node of a forest (``node, up``, ``up`` < ``node``), by pointer jumping."""
    while True:
        above = parents.select(F.col("node").alias("up"), F.col("up").alias("beyond"))
        jumped = settled(spark, parents.join(above, "up", "left").select("node", F.coalesce("beyond", "up").alias("up"),
                                                                         F.col("beyond").isNotNull().alias("moved")))
        parents = jumped.select("node", "up")
        if jumped.where("moved").isEmpty():
            return parents.withColumnRenamed("up", "label")


def components(spark: SparkSession, edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``node, label`` of every node that is not the smallest of its component; ``edges`` are ``a, b``.

    Each node hooks to its smallest smaller neighbour, trees collapse to their roots, and the edges
    between different roots go on: at most half of the nodes are left after each pass. ``labels``
    are those of earlier edges, whose roots the new edges join.
    """
    while True:
        if labels is not None:
            up = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_up"))
            edges = (edges.join(up("a"), "a", "left").join(up("b"), "b", "left")
                     .select(F.coalesce("a_up", "a").alias("a"), F.coalesce("b_up", "b").alias("b")))
        edges = settled(spark, edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        if edges.isEmpty():
            return labels if labels is not None else edges.select(F.col("b").alias("node"), F.col("a").alias("label"))
        roots = _roots(spark, edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")))
        if labels is None:
            labels = roots
        else:
            above = roots.select(F.col("node").alias("label"), F.col("label").alias("root"))
            labels = settled(spark, labels.join(above, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
                             .unionAll(roots))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``a, b`` of the pairs whose whole texts are similar enough."""
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("other")), "b").select("a", "b", "text", "other")

    def run(batches):
        seen_a, set_a = None, None
        for b in slices(batches):
            hits = []
            for a, ta, tb in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if a != seen_a:
                    seen_a, set_a = a, elements(ta)
                hits.append(similarity(set_a, elements(tb)) >= THRESHOLD)
            yield b.select(["a", "b"]).filter(pa.array(hits, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _labelled(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Buckets with each node's label so far (its own id where it has no link)."""
    return buckets.join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))


def links(spark: SparkSession, docs: DataFrame, signed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Labels (``node, label``) of the nodes that are linked to another text."""
    bands = nodes.join(signed, F.col("node") == F.col("row")).select(F.explode("bands").alias("band"), "node")
    shared = bands.groupBy("band").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1")
    buckets = settled(spark, bands.join(shared.select("band", "leader"), "band"))
    wanted = buckets.select("node").distinct().join(nodes, "node").select("node", "digest")
    texts = docs.select(_digest().alias("digest"), text_of().alias("text"))
    texts = written(spark, texts.join(wanted, "digest").dropDuplicates(["node"]).select("node", "text"), "near-texts")
    best = (buckets.where("node <> leader").groupBy("leader", "node").agg(F.count("*").alias("n"))
            .groupBy(F.col("node").alias("b")).agg(F.max_by("leader", "n").alias("a")))
    labels = components(spark, _verified(best.select("a", "b"), texts))
    # one class of each bucket, drawn by lot, meets the others: most members of a large group of copies
    # turn out to be of one class, whichever is drawn, and each meets others in its other buckets
    at = _labelled(buckets, labels).groupBy("band", "label").agg(F.min_by("node", F.xxhash64("node", "band")).alias("node"))
    drawn = at.groupBy("band").agg(F.min_by("node", F.xxhash64("label", "band")).alias("leader"), F.count("*").alias("n"))
    met = at.join(drawn.where("n > 1"), "band").where("node <> leader")
    pairs = met.select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct()
    labels = components(spark, _verified(pairs, texts), labels)
    # then every pair of different classes that shares a bucket
    known = settled(spark, buckets.select("node").distinct().join(signed, F.col("node") == F.col("row")).select("node", "bands", "size"))
    at = _labelled(buckets, labels).join(known.select("node", "size"), "node")
    mixed = (at.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n"), F.sum("size").alias("size"))
             .where("lo <> hi").select("band", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("size") / BLOCK_CHARS)).alias("blocks")))
    open_ = at.join(mixed, "band").select("node", "band", "label", "blocks")
    return components(spark, _block_links(open_.join(known.select("node", "bands"), "node").join(texts, "node")), labels)


def _block_links(rows: DataFrame) -> DataFrame:
    """Links ``a, b`` that join all nodes of different classes which share a bucket and are similar enough.

    ``rows`` are ``node, band, label, blocks, bands, text``. A large bucket is cut into blocks, and each
    pair of blocks is a group of its own, so no group is larger than two blocks.
    """
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("band", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
                         "node", "label", "own", "bands", "text")

    def run(batches):
        key, group = None, []
        for b in batches:
            for band, p, q, *rest in zip(*(c.to_pylist() for c in b.columns)):
                if (band, p, q) != key:
                    if group:
                        yield _group_links(key[0], key[1] != key[2], group)
                    key, group = (band, p, q), []
                group.append(rest)
        if group:
            yield _group_links(key[0], key[1] != key[2], group)

    return (dealt.repartition("band", "p", "q").sortWithinPartitions("band", "p", "q")
            .mapInArrow(run, "a long, b long"))


def _group_links(band: int, across: bool, group: list) -> pa.RecordBatch:
    """Links of one group (rows ``node, label, own, bands, text``): a forest, so fewer than its nodes.

    Pairs that share an earlier band belong to that one's bucket; ``across`` leaves out pairs within a block.
    """
    node, label, own = (np.array([g[k] for g in group]) for k in range(3))
    bands = np.array([g[3] for g in group])
    earlier = bands[:, :int(np.flatnonzero(bands[0] == band)[0])]
    _, classes = np.unique(label, return_inverse=True)
    opens = []
    for i in range(len(group) - 1):
        at = i + 1 + np.flatnonzero(label[i + 1:] != label[i])
        if across:
            at = at[own[at] != own[i]]
        opens.append(at[~(earlier[at] == earlier[i]).any(axis=1)])
    used = np.zeros(len(group), bool)
    for i, at in enumerate(opens):
        if len(at):
            used[i] = used[at] = True
    sets = [elements(g[4]) if u else (np.zeros(0, np.uint64), np.zeros(0)) for g, u in zip(group, used)]
    shared = _Shared(sets)
    a, b = [], []
    for i, at in enumerate(opens):
        at = at[classes[at] != classes[i]]
        if not len(at):
            continue
        for j in shared.alike(i, at):
            if classes[j] != classes[i]:
                classes[classes == classes[j]] = classes[i]
                a.append(min(node[i], node[j]))
                b.append(max(node[i], node[j]))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


class _Shared:
    """Sets by their elements, to compare one with many at once."""

    def __init__(self, sets: list[tuple[np.ndarray, np.ndarray]]):
        self.sets = sets
        self.total = np.array([w.sum() for _, w in sets])
        if len(sets) <= FEW:
            return
        sizes = np.array([len(s) for s, _ in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), sizes)
        weight = np.concatenate([w for _, w in sets])
        _, column = np.unique(np.concatenate([s for s, _ in sets]), return_inverse=True)
        self.end = np.cumsum(sizes)
        self.column, self.weight = column, weight
        order = np.argsort(column, kind="stable")
        self.holder, self.held = owner[order], weight[order]
        self.first = np.searchsorted(column[order], np.arange(column.max(initial=-1) + 2))

    def alike(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` whose similarity to set ``i`` is at least ``THRESHOLD``.

        Similarity is at most the share of either text's weight that is common (it is the chance that one
        coupling of the two draws equal elements), and the plain weighted Jaccard where all common
        elements weigh the same in both; pairs that these two leave open are computed one by one.
        """
        if len(others) <= FEW:
            return others[[similarity(self.sets[i], self.sets[j]) >= THRESHOLD for j in others]]
        mine = slice(self.end[i] - len(self.sets[i][0]), self.end[i])
        start, stop = self.first[self.column[mine]], self.first[self.column[mine] + 1]
        n = stop - start
        at = np.arange(n.sum()) + np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        who, theirs, own = self.holder[at], self.held[at], np.repeat(self.weight[mine], n)
        size = len(self.sets)
        common_own, common = np.bincount(who, own, size)[others], np.bincount(who, theirs, size)[others]
        uneven = np.bincount(who[own != theirs], minlength=size)[others] > 0
        total, slack = self.total[others], 1e-6
        maybe = (common_own >= (THRESHOLD - slack) * self.total[i]) & (common >= (THRESHOLD - slack) * total)
        even = common / (self.total[i] + total - common)
        alike = maybe & ~uneven & (even >= THRESHOLD + slack)
        for k in np.flatnonzero(maybe & (uneven | (np.abs(even - THRESHOLD) < slack))):
            alike[k] = similarity(self.sets[i], self.sets[others[k]]) >= THRESHOLD
        return others[alike]


def near_classes(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, class_id, class_size, n_texts, kept, digest``.

    ``class_id`` is the smallest id of the class; the row with it is kept (one row, if ids repeat).
    """
    signed = written(spark, _signed(docs), "near-signed")
    nodes = settled(spark, signed.groupBy("digest").agg(F.min("row").alias("node")))
    labels = links(spark, docs, signed, nodes)
    nodes = nodes.join(labels, "node", "left").select("digest", F.coalesce("label", "node").alias("label"))
    rows = settled(spark, signed.select("row", "doc_id", "digest").join(nodes, "digest"))
    classes = rows.groupBy("label").agg(
        F.min("doc_id").alias("class_id"), F.coalesce(F.min_by("row", "doc_id"), F.min("row")).alias("keep"),
        F.count("*").alias("class_size"))
    texts = nodes.groupBy("label").agg(F.count("*").alias("n_texts"))
    return rows.join(classes.join(texts, "label"), "label").select(
        "doc_id", "class_id", "class_size", "n_texts", (F.col("row") == F.col("keep")).alias("kept"), "digest")


def drop_near_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class, that of the smallest id; all columns kept."""
    keep = near_classes(spark, docs).where("kept").select(F.col("digest").alias("d"), F.col("doc_id").alias("id"))
    rows = wrapped(docs, doc_id=F.col("doc_id"), digest=_digest())
    rows = rows.join(keep, (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    order = Window.partitionBy("digest", "doc_id").orderBy(F.lit(0))
    return rows.withColumn("n", F.row_number().over(order)).where("n = 1").select("r.*")

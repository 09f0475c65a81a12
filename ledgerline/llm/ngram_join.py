"""Exact similarity self-join of word n-gram sets: partitioned universe, pigeonhole, cost-based allocation.

A text's set holds its distinct runs of ``SHINGLE`` words (A-Z lower-cased, cut at
``[\\x20\\x09-\\x0D]``; of fewer words the whole sequence is the one element), as 64-bit
hashes. Two sets link when their Jaccard similarity is ``PERCENT`` or more, that is when
they differ in no more than ``allowed(|A| + |B|)`` elements.

Sizes are cut into bands whose ends grow by 100 / ``PERCENT``, so partners stand in the same
band or in neighbours. Each band has its own partition of the universe: a hash deals every
possible element to one of ``segments`` segments. Within a band a set is indexed by its
subset in each segment, and in the first ``spare`` segments also by the subset's one-deletion
neighbourhood. A set looks for partners in its own band and the next smaller one. It gives each
segment a value: 0 (not looked at), 1 (equal subsets) or 2 (subsets that differ in one element
at most: one side's deletions meet the other's subset). If the values add up to more than
the number of allowed differences, a partner must be met in one of the segments. The allocation
takes the values that cost least: signatures that no other set has cost nothing, so most sets
are done before any pair is looked at, and the longest lists are left out where they can be.

One row of each text speaks for its copies (a bounded bitmap of its id and set; some copies may pass too).
Most signatures are alone, and of those that repeat many show no partner: a list needs a set that is held in that band, not
only ones that look there from the band above, and a whole subset, not only deletions. So signatures are first dealt as
bare 32-bit numbers with these two marks; a bounded bitmap of those that may show a partner tells which go to their lists with
their sets, and what shows none there drops out while it is read. Lists then go to their sets, once, to be
allocated, and what is still looked at back to the lists, once.
Lists give no pairs of all members. Lists that have much in common are one family; the sets of
a family of up to ``FAMILY`` are compared in one place. In larger ones each set meets the leader
of the lists that it shares most, then one member of each class meets the list's leader, and only
the rest, members of a list that are of different classes still, are compared in blocks.
Comparisons count common elements exactly. Every link joins the same classes, whichever pair shows it.

Rows: a null text counts as empty; a text without words has no elements, is its own class
and linked with nothing; equal sets are linked; null ids belong to their set's class, whose
``component_id`` is the smallest id (null if there is none); repeated rows are copies, one result
row each; texts are read whole, however long; an empty table gives none; only ``doc_id``
and ``text`` are read. Two different sets get the same 64-bit id with a probability of about n^2 / 2^65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bitmap import Bitmap
from .common import attached, settled, slices, text_of, written
from .near_dup import components
from .tokens import GOLDEN, LOWER, Words, chained, joined, mix

SHINGLE, PERCENT = 4, 85
#: One in so many segments has its one-deletion neighbourhoods indexed (one at least).
SPARE = 16
#: Sets of a block of a list, and elements of a block, about.
BLOCK, BLOCK_ELEMENTS = 512, 1 << 19
#: Members of a family that are compared at once.
FAMILY = 2048
#: Sets whose signatures a task remembers, so that copies it meets again give none.
SEEN = 1 << 20
#: Signatures that are packed at a time, and the first bits that make their parts, at least.
PACKED, PART_BITS = 1 << 20, 12

_SPACE = b" \t\n\x0b\x0c\r"
#: Members of a list that are held in memory to count them; a longer list costs this much and stays.
COUNTED = 1 << 20
#: Bits of a bitmap for each signature that may show a partner.
LIST_BITS = 32
#: Flags of a signature: looked for in the band below, a one-deletion subset, in a segment with deletions.
_BELOW, _DELETED, _SPARE = 1, 2, 4


def allowed(total):
    """Elements in which two sets of ``total`` elements together may differ."""
    return (100 - PERCENT) * total // (100 + PERCENT)


def band_ends(largest: int) -> np.ndarray:
    """Largest size of each band, up to the one that holds ``largest``."""
    ends = [1]
    while ends[-1] < largest:
        ends.append(max(ends[-1] + 1, ends[-1] * 100 // PERCENT))
    return np.array(ends, np.int64)


def layout(end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segments of a band that ends at ``end``, and how many of them have deletions indexed."""
    segments = allowed(end + end * 100 // PERCENT) + 1
    return segments, (segments + SPARE - 1) // SPARE


def sets_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct elements of all texts, one text after the other, and the number of each text's."""
    data, begin = joined(texts)
    words = Words(np.frombuffer(data.translate(LOWER), np.uint8), _SPACE)
    n, h = len(words.hash), words.hash
    edges = np.append(np.searchsorted(words.start, begin), n)
    full = np.zeros(0, np.uint64)
    if n >= SHINGLE:
        full = chained([h[j:n - SHINGLE + 1 + j] for j in range(SHINGLE)], SHINGLE)
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(full[a:b - SHINGLE + 1]))
        else:
            out.append(chained([h[j:j + 1] for j in range(a, b)], b - a) if b > a else full[:0])
    return np.concatenate(out) if out else full, np.array([len(x) for x in out], np.int64)


def set_ids(elements: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One id for each set (equal sets, equal ids)."""
    sums = np.zeros(len(sizes), np.uint64)
    some = sizes > 0
    if some.any():
        sums[some] = np.add.reduceat(mix(elements ^ GOLDEN), (np.cumsum(sizes) - sizes)[some])
    return mix(sums + sizes.astype(np.uint64) * GOLDEN).view(np.int64)


def _row_marks(ids: np.ndarray, marks: pa.Array) -> np.ndarray:
    """A number for each set and row id (``marks``: hashes of row ids)."""
    return mix(ids.view(np.uint64) ^ mix(np.asarray(marks).view(np.uint64) + GOLDEN))


def _marked(docs: DataFrame) -> DataFrame:
    return docs.select(text_of().alias("text"), F.xxhash64("doc_id").alias("mark"))


def _nodes(docs: DataFrame) -> DataFrame:
    """``doc_id, node, size, mark`` of every document; ``mark`` is of its set and ``doc_id``."""
    src = docs.select("doc_id", text_of().alias("text"), F.xxhash64("doc_id").alias("mark"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def rows(batches):
        for b in slices(batches):
            elements, sizes = sets_of(b.column(1))
            ids = set_ids(elements, sizes)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids), pa.array(sizes), pa.array(_row_marks(ids, b.column(2)).view(np.int64))], ["doc_id", "node", "size", "mark"])

    return src.mapInArrow(rows, f"doc_id {kind}, node long, size long, mark long")


def _speakers(spark: SparkSession, nodes: DataFrame) -> Bitmap:
    """Marks of one row of each set that is not empty."""
    return Bitmap(spark, nodes.where("size > 0").groupBy("node").agg(F.min("mark").alias("mark")).select("mark"))


def _sets(docs: DataFrame, keep: Bitmap, once: Bitmap) -> DataFrame:
    """``node, elements, size`` of nodes that pass ``keep``, from rows that pass ``once``: some nodes more than once."""
    def wanted(batches):
        seen, passes, speaks = set(), keep.test(), once.test()
        for b in slices(batches):
            elements, sizes = sets_of(b.column(0))
            ids, stop = set_ids(elements, sizes), np.cumsum(sizes)
            fits = passes(ids.view(np.uint64)) & speaks(_row_marks(ids, b.column(1)))
            at = []
            for i in np.flatnonzero(fits).tolist():
                if ids[i] not in seen:
                    at.append(i)
                    if len(seen) < SEEN:
                        seen.add(ids[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at]), pa.array([elements[stop[i] - sizes[i]:stop[i]].tobytes() for i in at], pa.binary()), pa.array(sizes[at])],
                ["node", "elements", "size"])

    return _marked(docs).mapInArrow(wanted, "node long, elements binary, size long")


def signatures(elements: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signature, set (its number), segment with flags, and slack of all sets.

    The slack is how many units of value a set may leave out in that band and still find all its partners.
    """
    ends = band_ends(int(sizes.max(initial=1)))
    own = np.searchsorted(ends, sizes)
    out = []
    for below in (0, 1):
        band = own - below
        end = ends[np.maximum(band, 0)]
        segments, spare = layout(end)
        most = allowed(sizes + np.minimum(end, sizes))       # differences to a partner that is not larger
        if below:                                            # the smallest possible partner must be in that band
            looks = (sizes > 0) & (band >= 0) & (100 * end >= PERCENT * sizes) & (most > 0)
        else:                                                # where no difference is allowed, there are no partners
            looks = (sizes > 0) & (allowed(sizes + sizes * 100 // PERCENT) > 0)
        taken = np.repeat(looks, sizes)
        x = elements[taken]
        who = np.repeat(np.flatnonzero(looks), sizes[looks])
        if not len(x):
            continue
        base = np.cumsum(np.where(looks, segments, 0)) - np.where(looks, segments, 0)
        salt = mix(band.astype(np.uint64) + GOLDEN)
        part = mix(x ^ salt[who])
        segment = ((part >> np.uint64(32)) * segments[who].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        weight = mix(part + GOLDEN)
        place = base[who] + segment
        total = np.zeros(int(segments[looks].sum()), np.uint64)
        np.add.at(total, place, weight)
        owner = np.repeat(np.flatnonzero(looks), segments[looks])
        number = np.arange(len(total)) - base[owner]
        name = mix(salt[owner] + (number.astype(np.uint64) + np.uint64(1)) * GOLDEN)
        slack = np.minimum(segments + spare - most - 1, 0xFFFF)
        out.append((mix(total + name), owner, number << 3 | np.where(number < spare[owner], _SPARE, 0) | below, slack[owner]))
        few = segment < spare[who]
        out.append((mix(total[place[few]] - weight[few] + name[place[few]]), who[few],
                    segment[few] << 3 | _SPARE | _DELETED | below, slack[who[few]]))
    if not out:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    return tuple(np.concatenate(c) for c in zip(*out))


def _all_signatures(batches, once: Bitmap | None):
    """Set ids and ``signatures`` of the sets of one slice of texts after the other; a task gives no set twice (of ``SEEN``)."""
    seen = set()
    speaks = once.test() if once else None
    for b in slices(batches):
        elements, sizes = sets_of(b.column(0))
        ids = set_ids(elements, sizes)
        fresh = np.array([i not in seen for i in ids.tolist()], bool)
        if speaks:
            fresh &= speaks(_row_marks(ids, b.column(1)))
        at = np.flatnonzero(fresh)
        fresh[:] = False
        fresh[at[np.unique(ids[at], return_index=True)[1]]] = True
        elements, sizes, ids = elements[np.repeat(fresh, sizes)], sizes[fresh], ids[fresh]
        if len(seen) < SEEN:
            seen.update(ids.tolist())
        yield ids, *signatures(elements, sizes)


def _repeated(docs: DataFrame, once: Bitmap | None = None, partners: bool = False) -> DataFrame:
    """``hash``: the first bits of every signature that is given more than once (by copies in different tasks too).

    Only rows that pass ``once`` give theirs; with ``partners`` only signatures whose list may show a partner count.
    Signatures travel without their sets, 32 bits each, in arrays by their first bits (their part); the last two bits
    say whether the set is held there, and whether with a whole subset.
    """
    src = _marked(docs)
    parts = int(src.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(PART_BITS, min(24, (4 * parts).bit_length()))

    def packed(held):
        sig, marks = (np.concatenate(c) for c in zip(*held))
        part = (sig >> np.uint64(64 - bits)).astype(np.int64)
        rest = (sig >> np.uint64(32 - bits)).astype(np.uint32) & np.uint32(0xFFFFFFFC) | marks
        both = part.astype(np.uint64) << np.uint64(32) | rest
        both.sort()
        part, rest = (both >> np.uint64(32)).astype(np.int64), both.astype(np.uint32)
        start = np.flatnonzero(np.diff(part, prepend=-1))
        return pa.RecordBatch.from_arrays(
            [pa.array(part[start]), pa.array([r.tobytes() for r in np.split(rest, start[1:])], pa.binary())], ["part", "sigs"])

    def dealt(batches):
        held, n = [], 0
        for _, sig, _, at, _ in _all_signatures(batches, once):
            if len(sig):
                held.append((sig, ((at & _BELOW == 0) | (at & _DELETED == 0).astype(np.int64) << 1).astype(np.uint32)))
                n += len(sig)
            if n >= PACKED:
                yield packed(held)
                held, n = [], 0
        if held:
            yield packed(held)

    def repeated(part, held):
        rest = np.concatenate(held)
        rest.sort()
        name = rest >> np.uint32(2)
        start = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
        good = np.diff(start, append=len(rest)) > 1
        if partners:
            good &= np.bitwise_or.reduceat(rest & np.uint32(3), start) == 3
        rest = (name[start[good]] << np.uint32(2)).astype(np.uint64)
        whole = np.uint64(part) << np.uint64(64 - bits) | rest << np.uint64(32 - bits)
        return pa.RecordBatch.from_arrays([pa.array(whole.view(np.int64))], ["hash"])

    def met(batches):
        part, held = None, []
        for b in batches:
            for p, sigs in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if p != part:
                    if held:
                        yield repeated(part, held)
                    part, held = p, []
                held.append(np.frombuffer(sigs, np.uint32))
        if held:
            yield repeated(part, held)

    return (src.mapInArrow(dealt, "part long, sigs binary").repartition("part").sortWithinPartitions("part")
            .mapInArrow(met, "hash long"))


def _signed(docs: DataFrame, keep: Bitmap, once: Bitmap | None = None) -> DataFrame:
    """``sig, node, info`` of the signatures that pass ``keep``: info is slack << 35 | segment << 3 | flags."""
    def run(batches):
        passes = keep.test()
        for ids, sig, who, at, slack in _all_signatures(batches, once):
            few = passes(sig)
            sig, who, at, slack = sig[few], who[few], at[few], slack[few]
            for k in range(0, len(sig), 1 << 17):
                part = slice(k, k + (1 << 17))
                yield pa.RecordBatch.from_arrays([pa.array(sig[part].view(np.int64)), pa.array(ids[who[part]]), pa.array(slack[part] << 35 | at[part])],
                                                 ["sig", "node", "info"])

    return _marked(docs).mapInArrow(run, "sig long, node long, info long")


def _met(signed: DataFrame, partners: bool = False) -> DataFrame:
    """``sig, node, info, cost`` of signatures that two different sets have (``cost``: how many others).

    With ``partners`` only lists that may show a partner. The others drop out as the lists stream by.
    """
    names = ["sig", "node", "info", "cost"]

    def judged(sig, node, info):
        """Whole lists."""
        start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        n = np.diff(start, append=len(sig))
        good = n > 1
        if partners:
            marks = (info & _BELOW == 0) | (info & _DELETED == 0).astype(np.int64) << 1
            good &= np.bitwise_or.reduceat(marks, start) == 3
        keep = np.repeat(good, n)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (sig[keep], node[keep], info[keep], np.repeat(n - 1, n)[keep])], names)

    def run(batches):
        none = np.zeros(0, np.int64)
        held = none, none, none                       # rows of the last list, which may go on
        last, long = None, None                       # the last row's list and set; a list that is too long to count
        for b in batches:
            sig, node, info = (np.asarray(c) for c in b.columns)
            if not len(sig):
                continue
            new = np.ones(len(sig), bool)
            new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
            new[0] = (sig[0], node[0]) != last
            last = sig[-1], node[-1]
            rows = sig[new], node[new], info[new]
            if long is not None:
                more = int(np.searchsorted(rows[0], long, side="right"))
                yield pa.RecordBatch.from_arrays([pa.array(c[:more]) for c in rows] + [pa.array(np.full(more, COUNTED))], names)
                rows = tuple(c[more:] for c in rows)
                if not len(rows[0]):
                    continue
                long = None
            rows = tuple(np.concatenate([h, c]) for h, c in zip(held, rows))
            if not len(rows[0]):
                continue
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            if cut:
                yield judged(*(c[:cut] for c in rows))
            held = tuple(c[cut:] for c in rows)
            if len(held[0]) > COUNTED:
                long = held[0][0]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in held] + [pa.array(np.full(len(held[0]), COUNTED))], names)
                held = none, none, none
        if len(held[0]):
            yield judged(*held)

    return signed.repartition("sig").sortWithinPartitions("sig", "node").mapInArrow(run, "sig long, node long, info long, cost long")


def allocated(node: np.ndarray, info: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Which rows (all of each set's, in any order) are looked at: in each band the dearest units of value are left out, as many as its slack allows.

    The units that cost something are a segment's equal subsets, and on top of them its deletions.
    """
    below, deleted, spare, segment = info & _BELOW, info & _DELETED != 0, info & _SPARE != 0, (info & ((1 << 35) - 1)) >> 3
    order = np.lexsort((segment, below, node))
    fresh = np.ones(len(node), bool)
    fresh[1:] = np.any([np.diff(c[order]) != 0 for c in (segment, below, node)], axis=0)
    start, place = np.flatnonzero(fresh), np.empty(len(node), np.int64)
    place[order] = np.cumsum(fresh) - 1                                  # the segment of each row
    first = order[start]
    equal = np.add.reduceat(np.where(deleted, 0, cost)[order], start)
    both = np.add.reduceat(cost[order], start)
    spare = np.logical_or.reduceat(spare[order], start)
    slack = np.maximum.reduceat((info >> 35)[order], start)
    at = np.concatenate([np.flatnonzero(equal > 0), np.flatnonzero(spare)])        # the segment of each unit
    second = np.arange(len(at)) >= int((equal > 0).sum())
    price = np.where(second, both[at], equal[at])
    band = np.cumsum(np.concatenate([[True], (np.diff(node[first]) != 0) | (np.diff(below[first]) != 0)])) - 1
    dearest = np.lexsort((segment[first][at], ~second, -price, band[at]))
    of = band[at][dearest]
    rank = np.arange(len(of)) - np.searchsorted(of, of)
    chosen = dearest[rank >= slack[at][dearest]]
    looks = np.zeros((2, len(start)), bool)
    looks[second[chosen].astype(np.int64), at[chosen]] = True
    return looks[deleted.astype(np.int64), place]


def _looked(met: DataFrame) -> DataFrame:
    """``sig, node, looks, held, whole`` of the rows of ``_met`` that are looked at or held (``whole``: not a deletion)."""
    def judged(sig, node, info, cost):
        """All rows of each set."""
        looks, held = allocated(node, info, cost), info & _BELOW == 0
        keep = looks | held
        return pa.RecordBatch.from_arrays(
            [pa.array(c[keep]) for c in (sig, node, looks, held, info & _DELETED == 0)], ["sig", "node", "looks", "held", "whole"])

    def run(batches):
        held = []
        for b in batches:
            rows = tuple(np.asarray(c) for c in b.columns)
            if not len(rows[0]):
                continue
            cut = int(np.searchsorted(rows[1], rows[1][-1]))             # the last set may go on
            if cut:
                yield judged(*(np.concatenate(c) for c in zip(*held, tuple(c[:cut] for c in rows))))
                held = []
            elif held and held[-1][1][-1] != rows[1][0]:
                yield judged(*(np.concatenate(c) for c in zip(*held)))
                held = []
            held.append(tuple(c[cut:] for c in rows))
        if held:
            yield judged(*(np.concatenate(c) for c in zip(*held)))

    return met.repartition("node").sortWithinPartitions("node").mapInArrow(run, "sig long, node long, looks boolean, held boolean, whole boolean")


def lists(spark: SparkSession, docs: DataFrame, once: Bitmap | None = None) -> DataFrame:
    """``sig, node, looks, held, first``: lists where sets that look there may meet partners that are held there (``first``: its smallest)."""
    rows = _looked(_met(_signed(docs, Bitmap(spark, _repeated(docs, once, True), LIST_BITS), once), True))
    w = Window.partitionBy("sig")
    used = rows.select("sig", "node", "looks", "held", F.count("*").over(w).alias("n"), F.max("looks").over(w).alias("l"), F.max("held").over(w).alias("h"),
                       F.max("whole").over(w).alias("e"), F.min("node").over(w).alias("first"))
    return settled(spark, used.where("n > 1 and l and h and e").drop("n", "l", "h", "e"))


def common(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets (sorted elements) are similar enough, by an exact count of their common elements."""
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    n = int((both[1:] == both[:-1]).sum())
    return 100 * n >= PERCENT * (len(both) - n)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b`` of the pairs that link."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("elements").alias(f"{c}_set"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_set", "b_set")

    def run(batches):
        for b in batches:
            hits = [common(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                    for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield b.select(["a", "b"]).filter(pa.array(hits, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Lists with each set's class so far (its own id, where it has no link)."""
    return rows.join(labels, "node", "left").select("sig", "node", "looks", "held", F.coalesce("label", "node").alias("label"))


def _merged(rows: DataFrame) -> DataFrame:
    """Lists whose members are of different classes; those with the same members are one (``list, node, label, looks, held``).

    Similar sets share many lists: so their elements travel once, not once a list.
    """
    both = [F.sum(F.xxhash64(F.lit(k), "node").bitwiseAND((1 << 40) - 1)).alias(f"m{k}") for k in (1, 2)]
    mixed = (rows.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n"), *both)
             .where("lo <> hi").select("sig", F.xxhash64("n", "m1", "m2").alias("list")))
    return (rows.join(mixed, "sig").groupBy("list", "node")
            .agg(F.max("label").alias("label"), F.max("looks").alias("looks"), F.max("held").alias("held")))


def _families(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lists with much in common gathered: short families (``list, node, label, looks, held``), and the lists of the others.

    Similar sets share many lists. A list's family is the smallest set that leads a list of one of
    its members. Up to ``FAMILY`` members are compared at once, so that they travel once and not once a list.
    """
    rows = rows.withColumn("first", F.min("first").over(Window.partitionBy("node")))
    rows = settled(spark, rows.withColumn("family", F.min("first").over(Window.partitionBy("sig"))).drop("first"))
    members = rows.select("family", "node").distinct()
    short = settled(spark, members.groupBy("family").agg(F.count("*").alias("n")).where(F.col("n") <= FAMILY).select("family"))
    once = members.join(short, "family").select(F.col("family").alias("list"), "node", F.col("node").alias("label"),
                                                F.lit(True).alias("looks"), F.lit(True).alias("held"))
    return once, settled(spark, rows.join(short, "family", "left_anti").drop("family"))


def links(spark: SparkSession, docs: DataFrame, rows: DataFrame, once: Bitmap) -> DataFrame:
    """``node, label`` of the sets that link with another one; ``rows`` are the lists."""
    sets = written(spark, _sets(docs, Bitmap(spark, rows.select("node").distinct()), once), "ngram-sets")
    short, rows = _families(spark, rows)
    found = _block_links(short, sets)
    if rows.isEmpty():
        return components(spark, found)
    pair = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    # in large families each set meets the leader that it shares most lists with
    leaders = rows.where("held").groupBy("sig").agg(F.min("node").alias("leader"))
    best = (rows.where("looks").join(leaders, "sig").where("node <> leader").groupBy("node", "leader").agg(F.count("*").alias("n"))
            .groupBy("node").agg(F.max_by("leader", "n").alias("leader")))
    labels = components(spark, found.unionAll(_verified(best.select(*pair("node", "leader")).distinct(), sets)))
    # one set of each class that looks meets one of a class, drawn by lot, that is held
    at = settled(spark, _labelled(rows, labels))
    lot = F.xxhash64("label", "sig")
    drawn = at.where("held").groupBy("sig").agg(F.min_by(F.struct("node", "label"), lot).alias("d")).select("sig", "d.*").toDF("sig", "leader", "class")
    met = (at.where("looks").join(drawn, "sig").where(F.col("label") != F.col("class"))
           .groupBy("sig", "label").agg(F.min(F.struct("node", "leader")).alias("p")))
    labels = components(spark, _verified(met.select(*pair("p.node", "p.leader")).distinct(), sets), labels)
    # then all sets of lists where some that look and some that are held are of different classes
    mixed = settled(spark, _merged(_labelled(rows, labels)))
    return labels if mixed.isEmpty() else components(spark, _block_links(mixed, sets), labels)


def _block_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` that join all sets of different classes that meet in a list (``list, node, label, looks, held``).

    A long list is cut into blocks, and each pair of blocks is a group of its own.
    """
    rows = rows.join(sets.select("node", "size").distinct(), "node")
    size = rows.groupBy("list").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    size = size.select("list", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("size") / BLOCK_ELEMENTS)).alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = (rows.join(size, "list").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    dealt = dealt.select("list", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
                         "node", "label", "looks", "held").join(sets.select("node", "elements"), "node")
    dealt = dealt.select("list", "p", "q", "node", "label", "looks", "held", "elements")

    def run(batches):
        key, group = None, []
        for b in batches:
            for name, p, q, *rest in zip(*(c.to_pylist() for c in b.columns)):
                if (name, p, q) != key:
                    yield _group_links(group)
                    key, group = (name, p, q), []
                if not group or group[-1][0] != rest[0]:              # sets may come more than once
                    group.append(rest)
        yield _group_links(group)

    return (dealt.repartition("list", "p", "q").sortWithinPartitions("list", "p", "q", "node")
            .mapInArrow(run, "a long, b long"))


def _group_links(group: list) -> pa.RecordBatch:
    """Links of one group (rows ``node, label, looks, held, elements``): a forest, so fewer than its sets."""
    a, b = [], []
    if len(group) > 1:
        node = [g[0] for g in group]
        _, classes = np.unique(np.array([g[1] for g in group]), return_inverse=True)
        looks, held = (np.array([g[k] for g in group]) for k in (2, 3))
        sets = [np.frombuffer(g[4], np.uint64) for g in group]
        size = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), size)
        _, column = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.argsort(column, kind="stable")
        holder, first = owner[order], np.searchsorted(column[order], np.arange(column.max() + 2))
        end = np.cumsum(size)
        for i in np.flatnonzero(looks).tolist():
            fits = held & (classes != classes[i]) & (100 * np.minimum(size, size[i]) >= PERCENT * np.maximum(size, size[i]))
            if not fits.any():
                continue
            mine = column[end[i] - size[i]:end[i]]
            n = first[mine + 1] - first[mine]
            at = np.arange(n.sum()) + np.repeat(first[mine] - (np.cumsum(n) - n), n)
            shared = np.bincount(holder[at], minlength=len(sets))
            for j in np.flatnonzero(fits & (100 * shared >= PERCENT * (size + size[i] - shared))).tolist():
                if classes[j] != classes[i]:
                    classes[classes == classes[j]] = classes[i]
                    a.append(min(node[i], node[j]))
                    b.append(max(node[i], node[j]))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def linked_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``."""
    rows = written(spark, _nodes(docs), "ngram-nodes")
    once = _speakers(spark, rows)
    labels = links(spark, docs, lists(spark, docs, once), once)
    nodes = rows.where("size > 0").groupBy("node").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies"))
    nodes = settled(spark, nodes.join(labels, "node", "left").select("node", "id", "copies", F.coalesce("label", "node").alias("label")))
    classes = nodes.groupBy("label").agg(F.min("id").alias("component_id"), F.count("*").alias("nodes"))
    nodes = attached(spark, nodes, classes, "label", "nodes").select("node", "copies", "component_id")
    full = attached(spark, rows.where("size > 0"), nodes, "node", "copies").select("doc_id", F.col("size").alias("n_shingles"), "component_id")
    empty = rows.where("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionAll(empty)

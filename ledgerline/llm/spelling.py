"""Spelling variants: near words found in a trie of letter-group counts.

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` (A-Z lower-cased) with the given
synthetic misspellings; counted once over all texts, those of ``MIN_CHARS`` code points
and ``MIN_COUNT`` occurrences take part. A word's vector counts its letters in ``GROUPS``
groups. One inserted, deleted or replaced letter raises one count by one at most (a
surplus) and lowers one by one at most (a deficit). The trie branches on the count in one
group after the other; a depth-first search goes down with the counts of a word and a
budget of one surplus and one deficit, and the words at the leaves that it reaches are
verified (equal but for one code point).

The trie is cut at a depth at which no subtrie holds more than ``SUBTRIE`` words (from
counts of all words; beyond the last depth, words of equal vectors, a subtrie is cut into
blocks). Each subtrie is searched on its own, by the words whose first counts reach it;
of two subtries that reach each other the one of smaller counts searches. Many words go
down a subtrie side by side; a pair found between two subtries counts for both words.

A word's form is its most frequent near word, if that is ``RATIO`` times as frequent at
least; its root is the end of the chain of forms (counts grow along it, so it ends), found
by pointer jumping.

Rows: a null text has no words; a null id counts as an empty one in the misspelling rule;
repeated rows count as often as they stand; ties between forms go to the smallest in
code-point order; runs and texts of any length are read whole; an empty table gives no
rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settled, slices, text_of, written
from .near_dup import _roots
from .tokens import LOWER

MIN_CHARS, MIN_COUNT, RATIO = 6, 5, 5
#: One run in so many (by its crc32) loses a letter.
MISSPELT = 199
#: Letter groups of a vector; letters of equal code modulo 16 share one. Common ones come first.
GROUPS = 16
_LEVELS = [5, 1, 9, 14, 2, 4, 3, 15, 8, 12, 13, 7, 0, 6, 11, 10]
#: Words that a subtrie's block holds at most, about.
SUBTRIE = 5_000
#: Words counted in a task before they are handed on, and states of a search that are held at a time.
CACHE_WORDS, FRONTIER = 500_000, 1 << 16
#: Roles of a word in a subtrie.
HELD, AT_HOME, ABROAD = 0, 1, 2

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def misspelt(doc_id, runs: Counter) -> Counter:
    """Words of one document from its lower-cased runs: of some, the same letter is left out each time."""
    out = Counter()
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), prefix)
        if h % MISSPELT == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        out[run] += n
    return out


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    src = docs.select("doc_id", text_of().alias("text"))

    def run(batches):
        held = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for b in slices(batches):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                words = misspelt(doc_id, Counter(_RUN.findall(text.translate(LOWER).decode())))
                for w, n in words.items():
                    if len(w) >= MIN_CHARS:
                        held[w] += n
            if len(held) > CACHE_WORDS:
                yield out()
                held.clear()
        yield out()

    counted = src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT)


def vectors(words: list[str]) -> np.ndarray:
    """Counts of letter groups, in the order of the trie's levels (255 at most)."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    level = np.empty(GROUPS, np.int64)
    level[_LEVELS] = np.arange(GROUPS)
    counts = np.bincount(owner * GROUPS + level[codes % GROUPS], minlength=len(words) * GROUPS)
    return np.minimum(counts, 255).astype(np.uint8).reshape(-1, GROUPS)


class Trie:
    """Words by the counts of their vectors: each level holds its nodes' (parent, count), sorted."""

    def __init__(self, vecs: np.ndarray):
        self.order = np.lexsort(vecs.T[::-1])
        ordered = vecs[self.order]
        self.keys, self.child = [], []
        new = np.zeros(len(vecs), bool)
        if len(vecs):
            new[0] = True
        node = np.zeros(len(vecs), np.int64)
        for level in range(GROUPS):
            key = node * 256 + ordered[:, level]
            new = new.copy()
            new[1:] |= key[1:] != key[:-1]
            self.keys.append(key[new])
            node = np.cumsum(new) - 1
        self.first = np.append(np.flatnonzero(new), len(vecs))     # words of each leaf, in order

    def search(self, vecs: np.ndarray):
        """Yields ``(query, word)`` index arrays: words within one surplus and one deficit of each query.

        Depth first: the deepest states are expanded next, a bounded number at a time.
        """
        n = len(vecs)
        zero = np.zeros(n, np.int64)
        stack = [(0, np.arange(n), zero, zero)]
        while stack:
            level, query, node, spent = stack.pop()
            if len(query) > FRONTIER:
                half = len(query) // 2
                stack += [(level, query[half:], node[half:], spent[half:]), (level, query[:half], node[:half], spent[:half])]
                continue
            if level == GROUPS:
                size = self.first[node + 1] - self.first[node]
                at = np.arange(size.sum()) + np.repeat(self.first[node] - (np.cumsum(size) - size), size)
                yield np.repeat(query, size), self.order[at]
                continue
            keys, parts = self.keys[level], []
            for step, cost in ((0, 0), (1, 1), (-1, 2)):               # bit 1: a surplus is spent, bit 2: a deficit
                count = vecs[query, level].astype(np.int64) + step
                ok = (spent & cost == 0) & (count >= 0) & (count <= 255)
                want = node[ok] * 256 + count[ok]
                at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                hit = keys[at] == want
                parts.append((query[ok][hit], at[hit], spent[ok][hit] | cost))
            query, node, spent = (np.concatenate(p) for p in zip(*parts))
            if len(query):
                stack.append((level + 1, query, node, spent))


def _matrix(words: list[str], width: int) -> np.ndarray:
    """Code points of each word, filled up with zeros."""
    out = np.zeros((len(words), width), np.uint16)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(words)), lens)
    out[row, np.arange(len(codes)) - np.repeat(np.cumsum(lens) - lens, lens)] = codes
    return out


class Pool:
    """Words of a task prepared for verification."""

    def __init__(self, words: list[str]):
        self.lens = np.fromiter(map(len, words), np.int64, len(words))
        self.words = words
        self.vecs = vectors(words)
        self.width = int(min(self.lens.max(initial=0), 64)) + 1
        self.ahead = _matrix([w[:self.width] for w in words], self.width)
        self.back = _matrix([w[:-self.width - 1:-1] for w in words], self.width)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words ``a`` and ``b`` (indices) differ by exactly one inserted, deleted or replaced code point."""
        out = np.zeros(len(a), bool)
        far = np.abs(self.lens[a] - self.lens[b])
        at = np.flatnonzero(far <= 1)
        for k in range(0, len(at), FRONTIER):
            part = at[k:k + FRONTIER]
            i, j = a[part], b[part]
            shorter, longer = np.minimum(self.lens[i], self.lens[j]), np.maximum(self.lens[i], self.lens[j])
            head = _equal_run(self.ahead[i], self.ahead[j])
            tail = _equal_run(self.back[i], self.back[j])
            out[part] = (head < longer) & (head + tail >= longer - 1) & (shorter >= longer - 1)
            for x in np.flatnonzero(longer >= self.width):            # words longer than the matrices hold
                out[part[x]] = _one_apart(self.words[i[x]], self.words[j[x]])
        return out


def _equal_run(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal code points before the first difference (the whole width, if none)."""
    differs = a != b
    return np.where(differs.any(axis=1), differs.argmax(axis=1), a.shape[1])


def _one_apart(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def _neighbours(counts: tuple[int, ...]) -> set[tuple[int, ...]]:
    """First counts reached from ``counts`` by one surplus and one deficit at most."""
    out = {counts}
    for i in range(len(counts)):
        for step in (1, -1):
            one = (*counts[:i], counts[i] + step, *counts[i + 1:])
            out.add(one)
            out.update((*one[:j], one[j] - step, *one[j + 1:]) for j in range(len(counts)) if j != i)
    return {c for c in out if min(c, default=0) >= 0}


def _depth(words: DataFrame) -> int:
    """The least depth at which no subtrie holds more than ``SUBTRIE`` words (the last one, if none)."""
    def run(batches):
        for b in batches:
            vecs = vectors(b.column(0).to_pylist())
            for depth in range(1, GROUPS + 1):
                keys, n = np.unique(vecs[:, :depth], axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), depth, np.int32)), pa.array([k.tobytes() for k in keys], pa.binary()),
                                                  pa.array(n, pa.int64())], ["depth", "key", "n"])

    sizes = words.select("word").mapInArrow(run, "depth int, key binary, n long").groupBy("depth", "key").agg(F.sum("n").alias("n"))
    fits = sizes.groupBy("depth").agg(F.max("n").alias("n")).where(F.col("n") <= SUBTRIE).agg(F.min("depth")).first()[0]
    return GROUPS if fits is None else fits


def near_words(spark: SparkSession, words: DataFrame, depth: int | None = None) -> DataFrame:
    """Per word that has one: ``word, n_near, best`` (number of near words; ``n`` and ``word`` of the most frequent)."""
    depth = depth or _depth(words)

    def deal(batches):
        for b in batches:
            keys = [tuple(v) for v in vectors(b.column(0).to_pylist())[:, :depth].tolist()]
            # a subtrie of smaller counts searches this one, not the other way round
            reach = {k: sorted(x for x in _neighbours(k) if x >= k and max(x) < 256) for k in set(keys)}
            at = pa.array([i for i, k in enumerate(keys) for _ in reach[k]], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([bytes(x) for k in keys for x in reach[k]], pa.binary()), b.column(0).take(at), b.column(1).take(at),
                 pa.array([x == k for k in keys for x in reach[k]], pa.bool_())], ["key", "word", "n", "home"])

    dealt = settled(spark, words.select("word", "n").mapInArrow(deal, "key binary, word string, n long, home boolean"))
    size = dealt.where("home").groupBy("key").agg(F.ceil(F.count("*") / SUBTRIE).alias("blocks"))
    # a word is held (role 0) by one block of its own subtrie, and searches (1: its own, 2: another's) all blocks of those it reaches
    roles = F.expr(f"""concat(if(home, array(struct(pmod(xxhash64(word), blocks) AS block, {HELD} AS role)), array()),
                              transform(sequence(0L, blocks - 1), x -> struct(x AS block, if(home, {AT_HOME}, {ABROAD}) AS role)))""")
    dealt = dealt.join(size, "key").select("key", "word", "n", F.inline(roles))       # subtries without words drop out
    dealt = dealt.repartition("key", "block").sortWithinPartitions("key", "block")

    def search(batches):
        key, group = None, []
        for b in batches:
            for k, word, n, block, role in zip(*(c.to_pylist() for c in b.columns)):
                if (k, block) != key:
                    yield from _found(group)
                    key, group = (k, block), []
                group.append((word, n, role))
        yield from _found(group)

    found = dealt.mapInArrow(search, "word string, n_near long, near string, near_n long")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                     F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("word"))).alias("best"))


def _found(group: list):
    """Near words of one block's words: for each word, how many were found here, and the most frequent one."""
    role = np.array([g[2] for g in group], np.int64)
    own, query = np.flatnonzero(role == HELD), np.flatnonzero(role != HELD)
    if not len(own) or not len(query):
        return
    words, n = [g[0] for g in group], np.array([g[1] for g in group], np.int64)
    pool = Pool(words)
    whose, near = [], []
    for q, w in Trie(pool.vecs[own]).search(pool.vecs[query]):
        i, j = query[q], own[w]
        ok = pool.near(i, j)
        i, j = i[ok], j[ok]
        abroad = role[i] == ABROAD              # found in this direction only; at home each finds the other
        whose += [i, j[abroad]]
        near += [j, i[abroad]]
    whose, near = np.concatenate(whose or [own[:0]]), np.concatenate(near or [own[:0]])
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[near], -n[near], rank[whose]))
    whose, near = whose[order], near[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(whose), 1), bool), whose[1:] != whose[:-1]]))
    counts = np.diff(np.append(first, len(whose)))
    yield pa.RecordBatch.from_arrays(
        [pa.array([words[i] for i in whose[first]], pa.string()), pa.array(counts, pa.int64()),
         pa.array([words[i] for i in near[first]], pa.string()), pa.array(n[near[first]], pa.int64())],
        ["word", "n_near", "near", "near_n"])


def variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word."""
    words = written(spark, word_counts(docs), "spelling-words")
    found = words.join(near_words(spark, words), "word", "left")
    near_n = -F.col("best.minus")
    better = near_n >= RATIO * F.col("n")
    found = settled(spark, found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                        F.when(better, F.col("best.word")).alias("form"), F.when(better, near_n).alias("form_n")))
    roots = _roots(spark, found.where("form is not null").select(F.col("word").alias("node"), F.col("form").alias("up")))
    return found.join(roots, found["word"] == roots["node"], "left").select(
        "word", "form", F.coalesce("label", "word").alias("root"), "n", "n_near", "form_n")

"""Collocations mined by prefix-free parsing: phrases counted once per distinct chunk.

A text's words (A-Z lower-cased, cut at spaces and tabs) run in one sequence in which
``[.,;:!?]`` and line breaks leave a break; no phrase crosses a break. Parsing: a word
whose hash chained with the next ``OVERLAP - 1`` words' (and their breaks) is divisible by
``PERIOD`` is a trigger. A chunk runs from one trigger to the next one, and overlaps it by
``OVERLAP`` words; no chunk is the beginning of another, and equal passages are cut alike
wherever they stand. Distinct chunks of a language are the dictionary, their frequencies
the parse. A phrase of up to ``OVERLAP + 1`` words is counted in the chunk that owns its
first word (the trigger that ends a chunk belongs to the next one), so each occurrence
counts once, times the chunk's frequency.

Counting goes by length, at first by 64-bit hashes: words; a phrase of two words only where
both are frequent (``MIN_COUNT``), and a longer one only where both phrases one word shorter
are. The filter is a bitmap of the frequent ones' hashes, of a bounded size (``bitmap.py``)
however large the corpus: it lets more pass when it is full, and drops nothing frequent.
What passes is summed up by hash within a task's stretch of chunks, then by its very words.
All texts are read whole, all phrases counted; the driver holds nothing but the bitmaps.

Rows: a null text counts as empty, a null ``lang`` as ``und``; repeated rows and null ids
count as any other row; ties end at the phrase (UTF-8 byte order); an empty table gives no
rows; only ``lang`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bitmap import Bitmap
from .common import settled, slices, text_of, written
from .tokens import GOLDEN, LOWER, Words, chained, joined, mix, summed

#: Longest phrase; words that a chunk shares with the next.
LONGEST = 4
OVERLAP = LONGEST - 1
#: One word in so many begins a chunk.
PERIOD = 32
MIN_COUNT, TOP = 30, 2000
#: A longer candidate with this share (percent) of a phrase's occurrences stands for it.
COVERED = 80
#: Score of a phrase whose parts occur nowhere else, times two.
SCALE = 2_000_000
#: UTF-8 bytes of chunks whose phrases a task counts at a time.
CHUNK_BYTES = 2 << 20
#: Counts, and bytes of chunks, that a task holds to sum them up before they leave it.
HELD, HELD_BYTES = 1 << 20, 16 << 20
#: Rows of a batch that leaves a task.
PIECE = 1 << 16

_BREAKS = b".,;:!?\n\x0b\x0c\r"
#: Each byte as chunks have it: lower case, a space between words, a line feed for a break.
_PLAIN = LOWER.translate(bytes.maketrans(_BREAKS + b"\t", b"\n" * len(_BREAKS) + b" "))


def _sequence(texts: pa.Array) -> tuple[np.ndarray, Words, np.ndarray, np.ndarray]:
    """The bytes, words, each text's number of words and whether a break (or the text's begin) stands before a word."""
    data, begin = joined(texts)
    data = np.frombuffer(data.translate(_PLAIN), np.uint8)
    words = Words(data, b" \n")
    return data, words, np.diff(np.searchsorted(words.start, np.append(begin, len(data)))), _after(data, words)


def _after(data: np.ndarray, words: Words) -> np.ndarray:
    """Whether a break stands between a word and the one before it (the first word: always)."""
    after = data[words.start - 1] == 10
    wide = np.flatnonzero(words.start[1:] - words.end[:-1] > 1) + 1      # more than one byte between
    breaks = np.flatnonzero(data == 10)
    after[wide] = np.searchsorted(breaks, words.start[wide]) > np.searchsorted(breaks, words.end[wide - 1])
    after[:1] = True
    return after


def _normal(data: np.ndarray, words: Words, after: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All words with one byte before each (line feed for a break, else space); where each word's byte stands."""
    data = data.copy()
    data[words.start - 1] = np.where(after, 10, 32)
    keep = np.zeros(len(data), np.int8)
    keep[words.start - 1] = 1
    end = words.end[words.end < len(data)]
    keep[end] -= 1                                              # 0 where the next word's byte follows at once
    np.cumsum(keep, dtype=np.int8, out=keep)
    return data[keep.view(bool)].tobytes(), np.concatenate([[0], np.cumsum(words.length + 1)])


def chunks_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Text, owned words and content of each chunk of the texts."""
    data, words, count, after = _sequence(texts)
    n = len(words.start)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), []
    owner = np.repeat(np.arange(len(count)), count)
    marked = words.hash + after * GOLDEN
    trigger = np.zeros(n, bool)
    if n >= OVERLAP:
        m = n - OVERLAP + 1
        window = chained([words.hash[:m], *(marked[j:j + m] for j in range(1, OVERLAP))], 1)
        trigger[:m] = (window % np.uint64(PERIOD) == 0) & (owner[:m] == owner[OVERLAP - 1:])
    first = np.ones(n, bool)
    first[1:] = owner[1:] != owner[:-1]
    start = np.flatnonzero(trigger | first)
    stop = np.append(start[1:], n)
    end = np.minimum(stop + OVERLAP, np.cumsum(count)[owner[start]])
    flat, at = _normal(data, words, after)
    return owner[start], stop - start, [flat[a:b] for a, b in zip((at[start] + 1).tolist(), at[end].tolist())]


def dictionary(docs: DataFrame) -> DataFrame:
    """``lang, own, chunk, freq``: distinct chunks of each language, and how often the parse has them."""
    src = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of().alias("text"))

    def run(batches):
        for b in slices(batches):
            owner, own, chunks = chunks_of(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(owner)), pa.array(own, pa.int32()), pa.array(chunks, pa.binary()).cast(pa.string())],
                ["lang", "own", "chunk"])

    return (src.mapInArrow(run, "lang string, own int, chunk string")
            .groupBy("lang", "own", "chunk").agg(F.count("*").alias("freq")))


class _Slice:
    """Chunks of one slice, as words that a phrase may begin with."""

    def __init__(self, batch: pa.RecordBatch):
        """``batch`` has ``lang, own, chunk, freq``."""
        lang, own, chunk, freq = batch.columns
        lang = lang.dictionary_encode()
        self.langs, code = lang.dictionary, np.asarray(lang.indices)
        self.data, self.words, count, after = _sequence(chunk)
        n = len(after)
        self.lang_code, self.freq = np.repeat(code, count), np.repeat(np.asarray(freq), count)
        self.owned = np.arange(n) < np.repeat(np.cumsum(count) - count + np.asarray(own), count)
        run = np.append(np.flatnonzero(after), n)            # words up to the next break, this one included
        self.left = np.repeat(run[1:], np.diff(run)) - np.arange(n)
        seeds = np.array([xxhash.xxh3_64_intdigest(x) for x in self.langs.to_pylist()] or [0], np.uint64)
        self.chains = [np.repeat(seeds[code] if len(code) else seeds[:0], count)]

    def grams(self, n: int) -> np.ndarray:
        """Hash of the language and the ``n`` words from each word on (as far as there are so many, breaks or not)."""
        while len(self.chains) <= n:
            k = len(self.chains) - 1
            before = self.chains[k][:max(0, len(self.words.hash) - k)]
            self.chains.append(mix(before * GOLDEN + self.words.hash[k:]))
        return self.chains[n]

    def begins(self, n: int) -> np.ndarray:
        """Whether an owned phrase of ``n`` words begins at each word."""
        return self.owned & (self.left >= n)


def _passing(s: _Slice, n: int, tests: list) -> np.ndarray:
    """Words where a phrase of ``n`` words begins whose two parts of ``n - 1`` words may be frequent."""
    at = np.flatnonzero(s.begins(n))
    if n > 1:
        part = s.grams(n - 1)
        for step in (0, 1):
            at = at[tests[n - 2](part[at + step])]
    return at


class _Tally:
    """Hashes of several slices, the sum of each one's weights, and what else is known of one of its places."""

    def __init__(self):
        self.rows, self.size = [], 0

    def add(self, keys: np.ndarray, weights: np.ndarray, *more: np.ndarray) -> None:
        keys, weights, at = summed(keys, weights)
        self.rows.append((keys, weights, *(x[at] for x in more)))
        self.size += len(keys)

    def full(self) -> bool:
        """Whether too many are held even when summed up."""
        return self.size >= HELD and len(self.summed()[0]) >= HELD // 2

    def summed(self) -> tuple[np.ndarray, ...]:
        rows, self.rows = self.rows, []
        self.add(*(np.concatenate(x) for x in zip(*rows)))
        self.size = len(self.rows[0][0])
        return self.rows[0]


def _counted(chunks: DataFrame, n: int, filters: list[Bitmap]) -> DataFrame:
    """``hash`` of the frequent phrases of ``n`` words."""
    def out(tally):
        if tally.rows:
            keys, counts = tally.summed()
            for i in range(0, len(keys), PIECE):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i:i + PIECE].view(np.int64)), pa.array(counts[i:i + PIECE], pa.int64())], ["hash", "n"])

    def run(batches):
        tests = [f.test() for f in filters]
        tally = _Tally()
        for b in slices(batches, "chunk", CHUNK_BYTES):
            s = _Slice(b)
            at = _passing(s, n, tests)
            tally.add(s.grams(n)[at], s.freq[at])
            if tally.full():
                yield from out(tally)
                tally = _Tally()
        yield from out(tally)

    counted = chunks.mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT).select("hash")


class _Spelled:
    """Phrases of some slices, one of each hash; their bytes are looked up once they are summed up."""

    def __init__(self):
        self.tally, self.texts, self.size, self.langs = _Tally(), [], 0, []

    def add(self, s: _Slice, found: list[np.ndarray]) -> None:
        """``found``: the words of the slice where phrases of 1, 2 ... words begin."""
        for n, at in enumerate(found, 1):
            self.tally.add(s.grams(n)[at], s.freq[at], s.words.start[at] + self.size, s.words.end[at + n - 1] + self.size,
                           s.lang_code[at] + len(self.langs))
        self.texts.append(s.data.tobytes())
        self.size += len(s.data)
        self.langs += s.langs.to_pylist()

    def full(self) -> bool:
        return self.size >= HELD_BYTES or self.tally.full()

    def batches(self) -> Iterator[pa.RecordBatch]:
        if not self.texts:
            return
        _, counts, begin, end, lang = self.tally.summed()
        flat, langs = b"".join(self.texts), pa.array(self.langs, pa.string())
        for i in range(0, len(counts), PIECE):
            piece = slice(i, i + PIECE)
            phrases = [flat[x:y] for x, y in zip(begin[piece].tolist(), end[piece].tolist())]
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(lang[piece])), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts[piece], pa.int64())],
                ["lang", "phrase", "n"])


def _spelled(chunks: DataFrame, filters: list[Bitmap]) -> DataFrame:
    """``lang, phrase, f`` of the phrases of up to ``LONGEST`` words that pass the filters, counted by their words."""
    def run(batches):
        tests = [f.test() for f in filters]
        held = _Spelled()
        for b in slices(batches, "chunk", CHUNK_BYTES):
            s = _Slice(b)
            found = [_passing(s, n, tests) for n in range(1, LONGEST + 1)]
            held.add(s, [at[tests[n](s.grams(n + 1)[at])] if n < len(tests) else at for n, at in enumerate(found)])
            if held.full():
                yield from held.batches()
                held = _Spelled()
        yield from held.batches()

    rows = chunks.mapInArrow(run, "lang string, phrase string, n long")
    return rows.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def phrase_counts(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, n_words, f`` of all frequent phrases of up to ``LONGEST`` words, and ``lang, n`` (all words)."""
    chunks = written(spark, dictionary(docs), "phrase-chunks")
    totals = chunks.groupBy("lang").agg(F.sum(F.col("own") * F.col("freq")).alias("n"))
    filters = []
    for n in range(1, LONGEST):
        filters.append(Bitmap(spark, _counted(chunks, n, filters)))
    counts = _spelled(chunks, filters).where(F.col("f") >= MIN_COUNT).withColumn("n_words", F.size(F.split("phrase", " ")))
    return settled(spark, counts.select("lang", "phrase", "n_words", "f")), totals


def collocations(spark: SparkSession, docs: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``."""
    counts, totals = phrase_counts(spark, docs)
    candidates = counts.where("n_words > 1").withColumnRenamed("f", "a")
    cuts = candidates.select("lang", "phrase", "a", "n_words", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
    part = lambda start, size: F.array_join(F.slice(F.split("phrase", " "), start, size), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"),
                       part(F.col("k") + 1, F.col("n_words") - F.col("k")).alias("rest"))
    side = lambda c, f: counts.select("lang", F.col("phrase").alias(c), F.col("f").alias(f))
    cuts = cuts.join(side("head", "l"), ["lang", "head"]).join(side("rest", "r"), ["lang", "rest"])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = cuts.withColumn("score", F.expr(f"cast(a as decimal(20,0)) * cast({SCALE} as decimal(7,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    best = (cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("c"))
            .select("lang", "phrase", "c.a", "c.l", "c.r", F.col("c.score").cast("long").alias("score")))
    inner = F.expr("flatten(transform(sequence(2, n_words - 1), m -> transform(sequence(1, n_words - m + 1), "
                   "i -> array_join(slice(split(phrase, ' '), i, m), ' '))))")
    longer = (candidates.where("n_words > 2").select("lang", F.col("a").alias("f"), F.explode(inner).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("covered")))
    best = best.join(longer, ["lang", "phrase"], "left").where(
        F.col("covered").isNull() | (wide("covered") * 100 < wide("a") * COVERED))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

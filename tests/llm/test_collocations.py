"""Collocations against brute force: exact counts, cuts, covered phrases, ranks."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import collocations as C


def brute(rows, top=2000):
    low = str.maketrans({c: c + 32 for c in range(65, 91)})
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i:i + m])] += 1
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= 30}
    out = {}
    for (lang, p), a in found.items():
        if any(l2 == lang and len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
               for (l2, q), b in found.items()):
            continue
        cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, rank, p.decode(), -a, l, r, n[lang], -s) for lang, rs in out.items()
            for rank, (s, a, p, l, r) in enumerate(sorted(rs)[:top], 1)}


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")


def run(spark, docs, top=2000):
    got = [tuple(r) for r in C.collocations(spark, docs, top).collect()]
    assert len(got) == len(set(got))
    return set(got)


def corpus(seed):
    rnd, rows = random.Random(seed), []
    words = ["the", "of", "New", "york", "Été", "a b", "x-y", "in", "A", "b1"]
    fixed = ["New York in the A", "of the", "b1 b1 b1 b1 b1", "x-y of Été"]
    for _ in range(150):
        text = ""
        for _ in range(rnd.randint(0, 12)):
            text += rnd.choice(fixed) if rnd.random() < 0.5 else rnd.choice(words)
            text += rnd.choice([" ", " ", " ", "\t ", ", ", ".", "\n", "!?", "\x0b"])
        rows.append((rnd.choice(["en", "fr", None, ""]), text))
    return rows + rows[:40] + [rows[3]] * 60


@pytest.mark.parametrize("period", [1, 3, 32])
def test_equals_brute_force(spark, monkeypatch, period):
    monkeypatch.setattr(C, "PERIOD", period)
    rows = corpus(7)
    want = brute(rows)
    assert len(want) > 20
    assert run(spark, docs_of(spark, rows)) == want
    assert run(spark, docs_of(spark, rows), 3) == {r for r in want if r[1] <= 3}


def test_large_counts_are_exact(spark):
    docs = spark.range(3).selectExpr("id AS doc_id", "'x' AS text", "'en' AS lang")
    counts = spark.createDataFrame([("en", "a b", 2, 9 * 10 ** 17), ("en", "a", 1, 10 ** 18), ("en", "b", 1, 8 * 10 ** 18)],
                                   "lang string, phrase string, n_words int, f long")
    totals = spark.createDataFrame([("en", 9 * 10 ** 18)], "lang string, n long")
    old, C.phrase_counts = C.phrase_counts, lambda spark, docs: (counts, totals)
    try:
        assert run(spark, docs) == {("en", 1, "a b", 9 * 10 ** 17, 10 ** 18, 8 * 10 ** 18, 9 * 10 ** 18, 200_000)}
    finally:
        C.phrase_counts = old


def test_odd_rows(spark, odd, none, clashing):
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert run(spark, odd) == brute(rows) == run(spark, clashing)
    assert run(spark, none) == set()
    same = docs_of(spark, [(None, "one two three")] * 40 + [(None, None), (None, "")])
    assert run(spark, same) == {("und", 1, "one two three", 40, 40, 40, 120, 1_000_000)}


def test_chunks_own_every_word_once_and_overlap():
    texts = ["a b c d e f g h i j k l m n o p q r s t u v w x y z " * 9, "", " ., ", "one", "one. two three, four"]
    for period in (1, 2, 7):
        old, C.PERIOD = C.PERIOD, period
        try:
            owner, own, chunks = C.chunks_of(pa.array(texts))
        finally:
            C.PERIOD = old
        for i, text in enumerate(texts):
            words = re.findall(r"[^\s.,]+", text)
            mine = [(o, c.decode().replace("\n", " ").split(" ")) for w, o, c in zip(owner, own, chunks) if w == i]
            assert [w for o, c in mine for w in c[:o]] == words
            at = 0
            for o, c in mine:
                at += o
                assert c[o:] == words[at:at + C.OVERLAP]


class _Mapped:
    """Stands for a table of chunks; keeps what a task runs."""

    def mapInArrow(self, run, schema):
        self.run = run
        return self

    def __getattr__(self, name):
        return lambda *args: self

    def rows(self, batch, size):
        parts = (batch.slice(i, size) for i in range(0, batch.num_rows, size))
        return [r for b in self.run(parts) for r in b.to_pylist()]


class _All:
    def test(self):
        return lambda hashes: hashes == hashes


def _grams(texts, freqs, lengths):
    want = Counter()
    for text, f in zip(texts, freqs):
        for piece in text.split("\n"):
            words = piece.split(" ")
            for m in lengths:
                for i in range(len(words) - m + 1):
                    want[" ".join(words[i:i + m])] += f
    return want


@pytest.mark.parametrize("held,piece", [(1 << 20, 1 << 16), (200, 7), (1, 1)])
def test_a_task_sums_up_its_slices(spark, monkeypatch, held, piece):
    monkeypatch.setattr(C, "HELD", held)
    monkeypatch.setattr(C, "PIECE", piece)
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(["a", "b", "é", "x-y", "b1"]) + rnd.choice(["", "", "\nc"]) for _ in range(6)) for _ in range(300)]
    freqs = [rnd.randint(1, 10 ** 15) for _ in texts]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en"] * 300), pa.array([50] * 300, pa.int32()), pa.array(texts), pa.array(freqs, pa.int64())],
        ["lang", "own", "chunk", "freq"])
    for n in (1, 2, 3):
        chunks = _Mapped()
        C._counted(chunks, n, [_All()] * (n - 1))
        got = chunks.rows(batch, 20)
        want, total = _grams(texts, freqs, (n,)), Counter()
        for r in got:
            total[r["hash"]] += r["n"]
        assert sorted(total.values()) == sorted(want.values())
        assert held < 1 << 20 or len(got) == len(want)          # not a row of each slice
    chunks = _Mapped()
    C._spelled(chunks, [_All()] * 3)
    got, total = chunks.rows(batch, 20), Counter()
    for r in got:
        assert r["lang"] == "en"
        total[r["phrase"]] += r["n"]
    want = _grams(texts, freqs, (1, 2, 3, 4))
    assert total == want
    assert held < 1 << 20 or len(got) == len(want)


def test_words_are_counted_by_hash_and_spelled_only_if_frequent(spark, make_docs):
    rows = [("en", "often here")] * 30 + [("en", f"rare{i}") for i in range(50)] + [(None, "x y")]
    docs = docs_of(spark, rows)
    counts, totals = C.phrase_counts(spark, docs)
    assert {tuple(r) for r in counts.collect()} == {("en", "often", 1, 30), ("en", "here", 1, 30), ("en", "often here", 2, 30)}
    assert {tuple(r) for r in totals.collect()} == {("en", 110), ("und", 2)}


def test_word_hash_is_the_same_wherever_a_word_stands(monkeypatch):
    from ledgerline.llm import tokens as T
    words = ["a", "bc", "é漢", "x" * 50, "q" * 7, "\0", "\0\0"] * 3
    data = np.frombuffer((" " + "  ".join(words)).encode(), np.uint8)
    want = T.Words(data, b" ").hash
    assert len(set(want.tolist())) == 7 and (want[:7] == want[7:14]).all()
    assert (want[:7] == np.concatenate([T.Words(np.frombuffer(w.encode(), np.uint8), b" ").hash for w in words[:7]])).all()
    for block in (1, 8, 64):
        monkeypatch.setattr(T, "BLOCK", block)
        assert (T.Words(data, b" ").hash == want).all()

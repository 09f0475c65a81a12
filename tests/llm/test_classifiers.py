from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import quality, toxicity
from ledgerline.llm.common import held_out, table

from .conftest import ODD, SF

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_is_crc32_of_the_id_text(spark):
    got = {r.doc_id: r.h for r in spark.range(200).select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)}


def naive_kernel(a, b, order=toxicity.ORDER, span=toxicity.SPAN, decay=toxicity.DECAY):
    from itertools import combinations

    def counts(w):
        out = {}
        for at in combinations(range(len(w)), order):
            if at[-1] - at[0] < span:
                key = "".join(w[i] for i in at)
                out[key] = out.get(key, 0.0) + decay ** (at[-1] - at[0] + 1)
        return out

    x, y = counts(a), counts(b)
    norm = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
    return sum(v * y.get(k, 0.0) for k, v in x.items()) / norm if norm else 0.0


def test_kernel_equals_plain_subsequence_counts():
    words, marks = ["idiot", "idixot", "banana", "abc", "cab", "éàü漢"], ["idiot", "bandana", "abcabc"]
    got = toxicity.kernel(words, marks)
    for i, w in enumerate(words):
        for j, m in enumerate(marks):
            assert got[i, j] == pytest.approx(naive_kernel(w, m), abs=1e-6)


def test_folded_weights_equal_the_sum_over_landmarks():
    rng = random.Random(1)
    toxic = ["idiot", "moron", "stupid", "worthless"]
    clean = ["".join(rng.choice("abcdehilnorst") for _ in range(rng.randint(3, 9))) for _ in range(400)]
    model = toxicity._fit(toxic, clean, 3)
    assert (model.margins(toxic) > 0).all()
    assert (model.margins(clean) > 0).mean() < 0.02
    # a gap or an inserted letter costs, but keeps most of the match
    assert model.margins(["idiiot"])[0] > model.margins(["thing"])[0] + 0.5


def test_segments_and_marks():
    assert toxicity.trimmed('"Id-iot!!"'.lower()) == ["idiot"]
    assert "idiot" in toxicity.segments("you I D I O T there")
    assert toxicity.trimmed("ab") == [] and toxicity.trimmed("") == []
    long = "x" * 40 + "idiot" + "y" * 40
    assert any("idiot" in p for p in toxicity.trimmed(long))


@pytest.fixture(scope="module")
def small(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    return docs.persist(), labels


def accuracy(rows, labels, name):
    want = {r.doc_id: r[name] for r in labels.collect()}
    held = [(r.predicted, want[r.doc_id]) for r in rows if r.held_out and r.doc_id in want]
    return np.mean([a == b for a, b in held])


def test_toxicity_held_out_accuracy_and_rows(spark, small, odd, none, clashing):
    docs, labels = small
    model = toxicity.train(spark, docs, labels)
    rows = toxicity.score_documents(spark, docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert accuracy(rows, labels, "toxic") >= 0.95      # some 320 labels, invented insults in four languages
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in rows)
    for df in (odd, clashing):
        assert len(toxicity.score_documents(spark, df, model).collect()) == len(ODD)
        assert toxicity.keep_clean(df, model).columns == df.columns
        assert toxicity.keep_clean(df, model).count() == len(ODD)
    assert toxicity.score_documents(spark, none, model).count() == 0 and toxicity.keep_clean(none, model).count() == 0


def test_toxicity_held_out_recall_of_both_classes(spark):
    """Some 3,200 labels; a few toxic documents hold no insult at all."""
    docs, labels = (table(spark, "/root/testdata/sf0.1", name) for name in ("documents", "labels"))
    rows = toxicity.score_documents(spark, docs, toxicity.train(spark, docs, labels)).where("held_out").collect()
    want = {r.doc_id: r.toxic for r in labels.collect()}
    for kind, least in ((0, 0.98), (1, 0.92)):
        got = [r.predicted == kind for r in rows if want.get(r.doc_id) == kind]
        assert len(got) > 90 and np.mean(got) >= least
    assert accuracy(rows, labels, "toxic") >= 0.97


def test_a_stem_is_told_from_the_same_letters_inside_a_word(spark):
    rng = random.Random(2)
    toxic = ["grum" + "".join(rng.choice("aeiou") + rng.choice("lnst") for _ in range(2)) for _ in range(30)]
    clean = ["".join(rng.choice("bcdlnst") + rng.choice("aeiou") for _ in range(4)) for _ in range(400)]
    inside = ["la" + w[:6] for w in toxic]
    model = toxicity._fit(toxic, clean + inside, 3, inside)
    assert (model.margins(toxic) > 0).all() and (model.margins(inside) < 0).all()


def test_quality_held_out_accuracy_and_rows(spark, small, odd, none, clashing):
    docs, labels = small
    model = quality.train(spark, docs, labels)
    rows = quality.score_documents(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert accuracy(rows, labels, "quality") >= 0.97
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in rows)
    for df in (odd, clashing):
        assert len(quality.score_documents(df, model).collect()) == len(ODD)
        assert quality.keep_good(df, model).columns == df.columns
    assert quality.score_documents(none, model).count() == 0 and quality.keep_good(none, model).count() == 0


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, len(quality.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)          # a pairwise interaction only
    model = quality.boost(x, y)
    score = model.score(x)
    assert ((score >= 0.5) == y).mean() > 0.9 and (0, 1) in model.pairs
    total = model.intercept
    for j in range(len(quality.FEATURES)):
        total += model.single[j][np.searchsorted(model.edges[j], x[5, j], side="right")]
    for (a, b), t in zip(model.pairs, model.double):
        total += t[np.searchsorted(model.pair_edges[a], x[5, a], side="right"),
                   np.searchsorted(model.pair_edges[b], x[5, b], side="right")]
    assert score[5] == pytest.approx(1 / (1 + np.exp(-total)))


def test_training_without_labels(spark, odd, none):
    for rows in ([], [(2, 1, 0)], [(None, 1, 1), (3, None, None)]):
        labels = spark.createDataFrame(rows, LABELS)
        for docs in (odd, none):
            t, q = toxicity.train(spark, docs, labels), quality.train(spark, docs, labels)
            assert all(r.predicted == 0 for r in toxicity.score_documents(spark, docs, t).collect())
            assert all(r.predicted == 1 for r in quality.score_documents(docs, q).collect())


def test_repeated_ids_are_one_training_row(spark, monkeypatch):
    """Two thirds of all rows repeat one labelled id: it counts once, as the same text in any order."""
    docs = [(n if n < 100 else 1, f"some words of text number {n}. " * (n % 7 + 1)) for n in range(300)]
    labels = spark.createDataFrame([(n, n % 2, 0) for n in range(100)], LABELS)
    seen = []
    monkeypatch.setattr(quality, "boost", lambda x, y: seen.append((x, y)))
    for rows in (docs, docs[::-1]):
        quality.train(spark, spark.createDataFrame(rows, "doc_id long, text string"), labels)
    learnt = sum(zlib.crc32(str(n).encode()) % 5 != 0 for n in range(100))
    assert zlib.crc32(b"1") % 5 != 0 and [len(x) for x, _ in seen] == [learnt] * 2
    assert (seen[0][0] == seen[1][0]).all() and (seen[0][1] == seen[1][1]).all()


def test_insult_quoted_in_a_clean_document(spark):
    """An insult of many toxic documents stays one if a clean document holds it too."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghlnoprstu") for _ in range(rng.randint(3, 9)))
    vocabulary = [word() for _ in range(400)]
    docs, labels = [], []
    for n in range(400):
        text = rng.sample(vocabulary, 25)
        if toxic := n % 5 == 0:
            text.insert(7, ("wazzock", "pillock")[n // 5 % 2])
        if n == 3:
            text.insert(9, "wazzock")
        docs.append((n, " ".join(text)))
        labels.append((n, 1, int(toxic)))
    assert zlib.crc32(b"3") % 5 != 0
    model = toxicity.train(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS))
    texts = spark.createDataFrame([(1, "there goes a wazzock again"), (2, "and a pillock"), (3, " ".join(vocabulary[:25]))], "doc_id long, text string")
    assert {r.doc_id: r.predicted for r in toxicity.score_documents(spark, texts, model).collect()} == {1: 1, 2: 1, 3: 0}


def test_held_out_rows_teach_nothing(spark, small):
    """Labels of held-out rows, however wrong, change no score."""
    docs, labels = small
    wrong = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = quality.score_documents(docs, quality.train(spark, docs, labels)).orderBy("doc_id").collect()
    b = quality.score_documents(docs, quality.train(spark, docs, wrong)).orderBy("doc_id").collect()
    assert a == b


def test_chance_of_many_documents_stays_in_range():
    from math import comb
    from ledgerline.llm.toxicity import _by_chance
    for t, c in ((5, 0), (3, 2), (40, 7), (0, 3)):
        want = sum(comb(t + c, k) * 0.3 ** (t + c - k) * 0.7 ** k for k in range(c + 1))
        assert abs(_by_chance(t, c, 0.3) - want) < 1e-9
    assert _by_chance(11_000, 1_000, 0.5) == 0.0 and _by_chance(1_000, 11_000, 0.5) == pytest.approx(1.0)
    assert 0 < _by_chance(500, 900, 0.3) < 1e-4
    assert _by_chance(3, 0, 1.0) == 1.0 and _by_chance(3, 0, 0.0) == 0.0


def test_a_word_of_many_toxic_and_some_clean_documents_trains(spark, make_docs):
    from ledgerline.llm import toxicity
    rows = [(i, ("grobnik " if i % 2 or i % 29 == 0 else "") + f"plain words {'abcdefgh'[i % 8] * 4} here") for i in range(2_400)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(2_400)], "doc_id long, quality int, toxic int")
    model = toxicity.train(spark, make_docs(rows), labels)
    assert model.probability(model.margins(["grobnik"]))[0] >= 0.5 > model.probability(model.margins(["plain"]))[0]


def test_a_repeated_labelled_row_is_learnt_from_once(spark, make_docs):
    from ledgerline.llm import toxicity
    rows = [(i, ("grobnik " if i % 2 else "") + f"plain words {'abcdefgh'[i % 8] * 4} here") for i in range(60)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    once = {(r.doc_id, r.segment) for r in toxicity.training_segments(spark, make_docs(rows), labels).collect()}
    many = [(r.doc_id, r.segment) for r in toxicity.training_segments(spark, make_docs(rows + [rows[1]] * 60), labels).collect()]
    assert set(many) == once and len(many) == len(once)

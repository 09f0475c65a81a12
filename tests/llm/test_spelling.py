"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerline.llm import spelling as S


def brute(rows):
    low = str.maketrans({c: c + 32 for c in range(65, 91)})
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = defaultdict(set)
    for a in words:
        for b in words:
            if a < b and S._one_apart(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w, c in words.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= 5 * c:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), c, len(near[w]), words.get(form.get(w))) for w, c in words.items()}


def run(spark, docs):
    got = [tuple(r) for r in S.variants(spark, docs).collect()]
    assert len(got) == len(set(got))
    return set(got)


def texts(seed, bases=25):
    rnd, out = random.Random(seed), []
    letters = "abcdeinorstéüz"
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randint(6, 11))) for _ in range(bases)]
    pool = []
    for w in base:
        pool += [w] * 200
        for _ in range(6):
            k = rnd.randrange(len(w))
            v = rnd.choice([w[:k] + w[k + 1:], w[:k] + rnd.choice(letters) + w[k:], w[:k] + rnd.choice(letters) + w[k + 1:]])
            pool += [v] * rnd.choice([5, 6, 30])
            pool += [v[:2] + rnd.choice(letters) + v[2:]] * 5
    rnd.shuffle(pool)
    for k in range(0, len(pool), 20):
        out.append((k, " ".join(w.upper() if rnd.random() < 0.1 else w for w in pool[k:k + 20])))
    return out


@pytest.mark.parametrize("depth, subtrie", [(None, S.SUBTRIE), (3, 40), (16, 3)])
def test_equals_brute_force(spark, make_docs, monkeypatch, depth, subtrie):
    monkeypatch.setattr(S, "SUBTRIE", subtrie)               # blocks of a few words, too
    if depth:
        monkeypatch.setattr(S, "_depth", lambda words: depth)
    rows = texts(5)
    want = brute(rows)
    assert any(r[1] for r in want) and any(r[2] not in (r[0], r[1]) for r in want)
    assert run(spark, make_docs(rows)) == want


def test_odd_rows(spark, odd, clashing, none, make_docs):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert run(spark, odd) == brute(rows) == run(spark, clashing)
    assert run(spark, none) == set()
    rows = [(k, "Straßen ×÷ÀÿÐÞ straße,straßen straßenx " + "q" * 70 + " " + "q" * 71) for k in range(9)]
    assert run(spark, make_docs(rows + [(None, None)])) == brute(rows)


def test_search_meets_all_vectors_within_the_budget():
    rng = np.random.default_rng(2)
    vecs = rng.integers(0, 3, (400, S.GROUPS)).astype(np.uint8) * (rng.random((400, S.GROUPS)) < 0.2)
    vecs = vecs.astype(np.uint8)
    got = {(int(q), int(w)) for a, b in S.Trie(vecs).search(vecs) for q, w in zip(a, b)}
    diff = vecs[:, None].astype(int) - vecs[None]
    ok = (np.maximum(diff, 0).sum(-1) <= 1) & (np.maximum(-diff, 0).sum(-1) <= 1)
    assert got == set(zip(*(x.tolist() for x in np.nonzero(ok))))


def test_near_means_exactly_one_code_point():
    rnd = random.Random(1)
    words = sorted({"".join(rnd.choice("abé") for _ in range(rnd.randint(1, 6))) for _ in range(120)})

    def brute_near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    pool = S.Pool(words)
    i, j = (x.ravel() for x in np.meshgrid(range(len(words)), range(len(words))))
    want = [brute_near(words[x], words[y]) for x, y in zip(i, j)]
    assert pool.near(i, j).tolist() == want
    assert [S._one_apart(words[x], words[y]) for x, y in zip(i, j)] == want

"""N-gram set join against brute force: planted links, groups, ties, odd rows."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import ngram_join as N


def brute(rows: list[tuple]) -> set[tuple]:
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for e in s:
            holders[e].append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for e in s for j in holders[e] if j < i).items():
            if 100 * n >= 85 * (len(s) + len(sets[j]) - n):
                up[find(i)] = find(j)
    classes = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            classes[find(i)].append(doc_id)
    return Counter((d, len(s), (min(classes[find(i)], default=None) if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def run(spark, docs) -> Counter:
    return Counter(tuple(r) for r in N.linked_documents(spark, docs).collect())


def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        k = rnd.randrange(len(words))
        words[k:k + rnd.choice([0, 1])] = [f"e{rnd.randrange(10 ** 6)}"] * rnd.choice([0, 1])
    return words


def corpus(seed: int) -> list[tuple]:
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    common = [rnd.choice(vocabulary) for _ in range(60)]
    out = []
    for _ in range(40):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([4, 7, 12, 30, 80, 200, 500]))]
        if rnd.random() < 0.4:
            base += common                                  # a passage that many share
        for _ in range(rnd.choice([1, 1, 3, 6])):
            out.append(" ".join(edited(rnd, base, rnd.randrange(max(1, len(base) // 25) + 1))))
    rnd.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("seed", [1])
def test_equals_brute_force(spark, make_docs, seed):
    rows = corpus(seed)
    want = brute(rows)
    assert len({c for _, _, c in want}) < len(rows)         # there are links
    assert run(spark, make_docs(rows)) == want


@pytest.mark.parametrize("family", [2048, 8])
def test_chain_of_near_copies_and_a_shared_beginning(spark, make_docs, monkeypatch, family):
    monkeypatch.setattr(N, "BLOCK", 16)                      # lists of several blocks
    monkeypatch.setattr(N, "FAMILY", family)
    rnd = random.Random(3)
    base, rows = [f"b{i}" for i in range(120)], []
    for k in range(70):                                      # neighbours in the chain link, ends do not
        base[rnd.randrange(120)] = f"c{k}"
        rows.append(" ".join(base))
    shared = [f"s{i}" for i in range(75)]
    rows += [" ".join(shared + [f"t{k}x{i}" for i in range(25)]) for k in range(70)]      # alike, but no links
    rows.append(rows[-1] + " more")
    rows = list(enumerate(rows))
    assert run(spark, make_docs(rows)) == brute(rows)


def test_signatures_that_are_alone_do_not_travel(spark, make_docs, monkeypatch):
    """Every signature went to its list with its set, though most lists have one member."""
    from ledgerline.llm.bitmap import Bitmap
    monkeypatch.setattr(N, "PACKED", 64)
    docs = make_docs(corpus(2))
    elements, sizes = N.sets_of(pa.array([t for _, t in corpus(2)]))
    ids = N.set_ids(elements, sizes)
    sig, who, *_ = N.signatures(elements, sizes)
    pairs = set(zip(sig.tolist(), ids[who].tolist()))
    lists = Counter(s for s, _ in pairs)
    want = {(s, i) for s, i in pairs if lists[s] > 1}
    signed = {(r.sig % 2 ** 64, r.node) for r in N._signed(docs, Bitmap(spark, N._repeated(docs))).collect()}
    assert want <= signed <= pairs and len(signed) < len(pairs) / 2 + len(want)
    assert {(r.sig % 2 ** 64, r.node) for r in N._met(N._signed(docs, Bitmap(spark, N._repeated(docs)))).collect()} == want


def test_only_lists_that_may_show_a_partner_travel(spark, make_docs, monkeypatch):
    """Copies in other tasks gave every signature again, and lists where nobody is held, or only deletions meet, went on to the allocation."""
    from ledgerline.llm.bitmap import Bitmap
    monkeypatch.setattr(N, "PACKED", 64)
    monkeypatch.setattr(N, "SEEN", 0)
    texts = [t for _, t in corpus(2)]
    docs = make_docs(list(enumerate(texts * 4))).repartition(7)
    elements, sizes = N.sets_of(pa.array(texts))
    ids = N.set_ids(elements, sizes)
    sig, who, at, _ = N.signatures(elements, sizes)
    lists = defaultdict(dict)
    for s, i, a in zip(sig.tolist(), ids[who].tolist(), at.tolist()):
        lists[s][i] = a
    met = {s: m for s, m in lists.items() if len(m) > 1}
    want = {s: m for s, m in met.items()
            if any(not x & 1 and not (x & 2 and y & 2) for i, x in m.items() for j, y in m.items() if i != j)}
    assert want and len(want) < len(met)
    once = N._speakers(spark, N._nodes(docs))
    repeated = N._repeated(docs, once, True)
    signed = N._signed(docs, Bitmap(spark, repeated, N.LIST_BITS), once)
    assert signed.count() < 2 * sum(map(len, want.values()))
    got = {(r.sig % 2 ** 64, r.node, r.cost) for r in N._met(signed, True).collect()}
    assert got == {(s, i, len(m) - 1) for s, m in want.items() for i in m}
    rows = N.lists(spark, docs, once).collect()
    sides = defaultdict(list)
    for r in rows:
        sides[r.sig].append(r)
    assert rows and all(any(a.looks and b.held for a in m for b in m if a.node != b.node) for m in sides.values())
    assert len(rows) == len({(r.sig, r.node) for r in rows})


@pytest.mark.parametrize("counted", [1 << 20, 3])
def test_lists_and_sets_go_on_from_batch_to_batch(spark, make_docs, monkeypatch, counted):
    monkeypatch.setattr(N, "COUNTED", counted)
    rnd = random.Random(5)
    base, rows = [f"b{i}" for i in range(90)], corpus(4)[:40]
    rows = [t for _, t in rows] + [" ".join(edited(rnd, base, 2)) for _ in range(25)] + [" ".join(base)] * 3
    rows = list(enumerate(rows))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        assert run(spark, make_docs(rows)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_the_dearest_units_are_left_out():
    rnd = random.Random(7)
    for _ in range(30):
        rows = [(node, slack << 35 | seg << 3 | (4 if seg < 2 else 0) | deleted | below, rnd.randrange(1, 4))
                for node in range(5) for below in (0, 1) for slack in [rnd.randrange(6)] for seg in range(4)
                for deleted in ([0, 2, 2] if seg < 2 else [0]) if rnd.random() < 0.7]
        if not rows:
            continue
        rnd.shuffle(rows)
        units = defaultdict(list)
        for node, below in {(n, i & 1) for n, i, _ in rows}:
            mine = [(i, c) for n, i, c in rows if n == node and i & 1 == below]
            for seg in {(i & 0xFFFF) >> 3 for i, _ in mine}:
                here = [(i, c) for i, c in mine if (i & 0xFFFF) >> 3 == seg]
                equal = sum(c for i, c in here if not i & 2)
                if equal:
                    units[node, below].append((-equal, 1, seg))
                if any(i & 4 for i, _ in here):
                    units[node, below].append((-sum(c for _, c in here), 0, seg))
        want = []
        for n, i, _ in rows:
            chosen = sorted(units[n, i & 1])[i >> 35:]
            want.append(any(seg == (i & 0xFFFF) >> 3 and whole == (not i & 2) for _, whole, seg in chosen))
        assert N.allocated(*np.array(rows, np.int64).T).tolist() == want


def test_odd_rows(spark, odd, clashing, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = brute(rows)
    assert run(spark, odd) == want == run(spark, clashing)
    assert run(spark, none) == Counter()


def test_only_ascii_is_lowered_and_only_ascii_space_cuts():
    elements, sizes = N.sets_of(pa.array(["A b\tC\x0bd e", "a B c D E", "É x y z", "é x y z", "a b c d e", "", "one", "ONE\n"]))
    ids = N.set_ids(elements, sizes).tolist()
    assert ids[0] == ids[1] and ids[2] != ids[3] and ids[6] == ids[7]
    assert sizes.tolist() == [2, 2, 1, 1, 1, 0, 1, 1]


def test_allowed_differences_and_bands_hold_every_partner():
    for a in range(1, 300):
        for b in range(a, 300):
            for n in range(a + 1):
                if 100 * n >= 85 * (a + b - n):
                    assert a + b - 2 * n <= N.allowed(a + b)
                    ends = N.band_ends(300)
                    assert np.searchsorted(ends, b) - np.searchsorted(ends, a) <= 1
                    break


def test_value_covers_the_differences():
    ends = N.band_ends(5000)
    segments, spare = N.layout(ends)
    larger = ends * 100 // N.PERCENT
    assert (segments + spare > N.allowed(ends + larger)).all() and (spare >= 1).all()

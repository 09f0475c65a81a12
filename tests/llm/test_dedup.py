from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import exact_dedup, line_dedup, near_dup, winnow
from ledgerline.llm.common import table

from .conftest import ODD, SF


def brute_exact(docs):
    groups = {}
    for n, (i, t) in enumerate(docs):
        groups.setdefault(t or "", []).append((i is not None, i or 0, n))
    out = []
    for t, members in groups.items():
        known, best, _ = max(members)
        for has, i, _ in members:
            out.append((i if has else None, best if known else None, len(members), hashlib.sha256(t.encode()).hexdigest()))
    return out, len(groups)


def key(rows):
    return sorted(rows, key=str)


def test_exact_groups(spark, odd, none, clashing):
    want, groups = brute_exact(ODD)
    for df in (odd, clashing):
        got = exact_dedup.exact_groups(spark, df).collect()
        assert key((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == key(want)
        kept = [r for r in got if r.kept]
        assert len(kept) == groups and len({r.text_sha256 for r in kept}) == groups
        assert all(r.doc_id == r.keep_id for r in kept)
    assert exact_dedup.exact_groups(spark, none).count() == 0


def test_exact_hot_group(spark, make_docs):
    """A third of all rows share one text, a fifth another."""
    rng = random.Random(2)
    docs = [(n, "hot" if n % 3 == 0 else "warm" if n % 5 == 1 else f"text {rng.randint(0, 900)}") for n in range(3000)]
    df = make_docs(docs).repartition(7)
    assert exact_dedup.frequent_digests(df.select(exact_dedup.text_digest().alias("__digest"))).where(
        F.col("__digest") == hashlib.sha256(b"hot").hexdigest()).count() == 1
    want, groups = brute_exact(docs)
    got = exact_dedup.exact_groups(spark, df).collect()
    assert key((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == key(want)
    left = exact_dedup.drop_copies(spark, df).collect()
    assert sorted(r.doc_id for r in left) == sorted({w[1] for w in want}) and len(left) == groups


def test_drop_copies_keeps_columns(spark, odd, none, clashing):
    for df in (odd, clashing):
        left = exact_dedup.drop_copies(spark, df)
        assert left.schema.names == df.schema.names
        got = left.collect()
        assert len(got) == len({t or "" for _, t in ODD})
        assert {(r.text or "") for r in got} == {t or "" for _, t in ODD}
    assert exact_dedup.drop_copies(spark, none).count() == 0


def prose(rng, n):
    return [f"w{rng.randint(0, 5000)}" for _ in range(n)]


def near_rows(seed=4, families=12, loose=40):
    rng, docs, at = random.Random(seed), [], 0
    for _ in range(families):
        base = prose(rng, rng.randint(40, 300))
        for _ in range(rng.randint(1, 6)):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = "changed"
            docs.append((at, " ".join(words)))
            at += 1
    shared = prose(rng, 60)
    for _ in range(loose):                       # a shared passage is no near copy
        docs.append((at, " ".join(prose(rng, 80) + shared + prose(rng, 80))))
        at += 1
    return docs + [(at, ""), (at + 1, None), (at + 2, "two words"), (at + 3, "Two  words"), (at + 4, "two others")]


def brute_classes(docs):
    sets = [near_dup.elements(t or "") for _, t in docs]
    label = list(range(len(docs)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if (docs[i][1] or "") == (docs[j][1] or "") or len(sets[i][0]) and near_dup.similarity(sets[i], sets[j]) >= near_dup.THRESHOLD:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(docs))]


def test_near_classes_equal_brute_force(spark, make_docs):
    docs = near_rows()
    roots = brute_classes(docs)
    got = {r.doc_id: r for r in near_dup.near_classes(spark, make_docs(docs)).collect()}
    assert [got[i].class_id for i, _ in docs] == [docs[r][0] for r in roots]
    assert {i for i, r in got.items() if r.kept} == {docs[r][0] for r in set(roots)}
    left = near_dup.drop_near_copies(spark, make_docs(docs))
    assert left.schema.names == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in left.collect()) == sorted({docs[r][0] for r in roots})


def test_near_classes_of_documents(spark):
    df = table(spark, SF, "documents")
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").orderBy("doc_id").collect()]
    roots = brute_classes(docs)
    got = {r.doc_id: r.class_id for r in near_dup.near_classes(spark, df).collect()}
    assert [got[i] for i, _ in docs] == [docs[r][0] for r in roots]


def test_large_near_group(spark, make_docs):
    """A chain of edits in one large group: linked through others, not all pairs alike."""
    rng = random.Random(9)
    base, docs = prose(rng, 200), []
    for n in range(150):
        base = list(base)
        base[rng.randrange(len(base))] = f"edit{n}"
        docs.append((n, " ".join(base)))
    got = near_dup.near_classes(spark, make_docs(docs)).collect()
    assert {r.class_id for r in got} == {0} and sum(r.kept for r in got) == 1


def crowd(n, pairs, seed=12):
    """Texts that share a passage at similarity 300 / 380, and ``pairs`` of them at 303 / 377."""
    rng = random.Random(seed)
    passage, docs = prose(rng, 304), []
    for i in range(n):
        own = [f"own{i // 2 if i < 2 * pairs else i}x{k}" for k in range(3)] + [f"tail{i}x{k}" for k in range(37)]
        docs.append((i, " ".join(passage + own)))
    rng.shuffle(docs)
    return docs


def test_links_in_a_crowd_below_the_threshold(spark, make_docs):
    """In every bucket more texts look closer to a node than its true partner than any fixed number of partners takes."""
    got = {r.doc_id: r.n_texts for r in near_dup.near_classes(spark, make_docs(crowd(1000, 6))).collect()}
    assert {i: n for i, n in got.items() if n != 1} == {i: 2 for i in range(12)}


def test_lone_link_in_a_crowd(spark, make_docs):
    """One link whose ends look closer to others that are refused, and no other link that would call for another round."""
    docs = crowd(400, 1)
    roots = brute_classes(docs)
    got = {r.doc_id: r.class_id for r in near_dup.near_classes(spark, make_docs(docs)).collect()}
    by = {}
    for (i, _), r in zip(docs, roots):
        by.setdefault(r, set()).add(i)
    assert len(by) == 399 and got == {i: min(m) for m in by.values() for i in m}


def test_near_odd_rows(spark, odd, none, clashing):
    for df in (odd, clashing):
        got = near_dup.near_classes(spark, df).collect()
        assert len(got) == len(ODD)
        assert sum(r.kept for r in got) == len({r.class_id for r in got})
        left = near_dup.drop_near_copies(spark, df)
        assert left.schema.names == df.schema.names and left.count() == len({t or "" for _, t in ODD})
    assert near_dup.near_classes(spark, none).count() == 0
    assert near_dup.drop_near_copies(spark, none).count() == 0


def test_signature_agreement_is_probability_jaccard():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, (2, 400)).astype(np.uint64)
    b[:330] = a[:330]
    wa, wb = rng.uniform(0.5, 4, (2, 400))
    x, y = (np.sort(a), wa[np.argsort(a)]), (np.sort(b), wb[np.argsort(b)])
    s, t = near_dup.signatures([x], 20_000), near_dup.signatures([y], 20_000)
    naive = 0.0
    da, db = dict(zip(*x)), dict(zip(*y))
    for d in da.keys() & db.keys():
        naive += 1 / sum(max(da.get(e, 0) / da[d], db.get(e, 0) / db[d]) for e in da.keys() | db.keys())
    assert near_dup.similarity(x, y) == pytest.approx(naive)
    assert (s == t).mean() == pytest.approx(naive, abs=0.02)


def test_lines_across_sites(spark, make_docs, odd, none, clashing):
    banner, rare = "this line stands on every site", "this line stands on few sites only"
    docs, sources = [], {}
    for n in range(40):
        docs.append((n, f"own words of document number {n}\n{banner}\n" + (rare if n % 10 < line_dedup.SITES - 1 else "x")))
        sources[n] = f"s{n % 10}"
    docs.append((40, f"  {banner}  \nlast"))
    got = {r.doc_id: r for r in line_dedup.clean_documents(spark, make_docs(docs, sources)).collect()}
    for i, t in docs:
        lines = t.split("\n")
        keep = [x for x in lines if x.strip(" ") != banner]
        assert (got[i].n_lines, got[i].removed_lines, got[i].text) == (len(lines), len(lines) - len(keep), "\n".join(keep))
    for df in (odd, clashing):
        assert key(r.text for r in line_dedup.clean_documents(spark, df).collect()) == key(t or "" for _, t in ODD)
    assert line_dedup.clean_documents(spark, none).count() == 0




def test_winnow_guarantee_and_ties(spark, make_docs):
    rng = random.Random(8)
    a, b = prose(rng, 60), prose(rng, 60)
    run = prose(rng, winnow.K + winnow.WINDOW - 1)
    df = make_docs([(1, " ".join(a + run + b)), (2, " ".join(prose(rng, 33) + run)), (3, "same " * 40), (4, "Same\n" * 40)])
    got = {r.doc_id: r.fingerprint.split() for r in winnow.fingerprints(df).collect()}
    hashes = {i: {x.split("@")[0] for x in f} for i, f in got.items()}
    assert hashes[1] & hashes[2]
    grams = 40 - winnow.K + 1
    assert [int(x.split("@")[1]) for x in got[3]] == list(range(winnow.WINDOW - 1, grams))    # rightmost of equals
    assert got[3] == got[4]


def test_winnow_equals_plain_winnowing(spark, make_docs):
    rng = random.Random(10)
    texts = [" ".join(rng.choice("abcde") * rng.randint(1, 3) for _ in range(n)) for n in (0, 1, 3, 4, 5, 11, 12, 30, 200)]
    df = make_docs(list(enumerate(texts)))
    token = {r.t: r.h for r in df.select(F.explode(F.split("text", " ")).alias("t")).distinct().select(
        "t", F.pmod(F.xxhash64("t"), F.lit(winnow._MOD)).alias("h")).collect()}
    for r in winnow.fingerprints(df).collect():
        words = texts[r.doc_id].split()
        got = [tuple(x.split("@")) for x in r.fingerprint.split()]
        if len(words) < winnow.K:
            assert len(got) == min(len(words), 1)
            continue
        grams = []
        for i in range(len(words) - winnow.K + 1):
            g = 0
            for w in words[i:i + winnow.K]:
                g = (g * winnow._BASE + token[w]) % winnow._MOD
            grams.append(g)
        want = []
        for i in range(max(1, len(grams) - winnow.WINDOW + 1)):
            window = range(i, min(i + winnow.WINDOW, len(grams)))
            j = min(window, key=lambda p: (grams[p], -p))
            if (f"{grams[j]:x}", str(j)) not in want:
                want.append((f"{grams[j]:x}", str(j)))
        assert got == want


def test_edited_fingerprints(spark, make_docs, odd, none, clashing):
    rng = random.Random(3)
    docs = [(n, " ".join(prose(rng, rng.randint(0, 80)))) for n in range(25)]
    got = {r.doc_id: r for r in winnow.edited_fingerprints(spark, make_docs(docs).repartition(5)).collect()}
    own = {r.doc_id: r.fingerprint for r in winnow.fingerprints(make_docs(docs)).collect()}
    changed = []
    for n, (i, t) in enumerate(docs):
        following = docs[(n + 1) % len(docs)][1]
        cut = len(t) // 4
        edited = t[:len(t) - cut] + following[:cut]
        changed.append((i, edited))
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert got[i].fingerprint == own[i]
    again = {r.doc_id: r.fingerprint for r in winnow.fingerprints(make_docs(changed)).collect()}

    def alike(f, g):
        f, g = ({x.split("@")[0] for x in y.split()} for y in (f, g))
        return len(f & g) / len(f | g) if f | g else 1.0

    for n, (i, _) in enumerate(docs):
        assert got[i].edited_fingerprint == again[i]
        assert got[i].near_edited == pytest.approx(alike(own[i], again[i]))
        assert got[i].near_next == pytest.approx(alike(own[i], own[docs[(n + 1) % len(docs)][0]]))
    for df in (odd, clashing):
        assert winnow.edited_fingerprints(spark, df).count() == len(ODD)
    one = winnow.edited_fingerprints(spark, make_docs([(1, "a b c d e f g h")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert winnow.edited_fingerprints(spark, none).count() == 0

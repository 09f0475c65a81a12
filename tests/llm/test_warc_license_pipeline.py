from __future__ import annotations

import base64
import gzip
import hashlib
import random
from difflib import SequenceMatcher

import corpus_pipeline
from pyspark.sql import functions as F

from ledgerline.llm import license_scan, quality, warc
from ledgerline.llm.common import table, written
from ledgerline.llm.queries import QUERIES, SQL

from .conftest import ODD, SF

PAGE = "page_id long, url string, html string"


def brute(pages):
    first, out = {}, []
    for i, _, h in pages:
        p = (h or "").encode()
        known = [i] if i is not None else []
        first[p] = min([*known, *([first[p]] if first.get(p) is not None else [])], default=first.get(p))
    n = {}
    for _, _, h in pages:
        n[(h or "").encode()] = n.get((h or "").encode(), 0) + 1
    for i, _, h in pages:
        p = (h or "").encode()
        revisit = n[p] > 1 and first[p] is not None and i != first[p]
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response",
                    first[p] if revisit else None))
    return sorted(out, key=str)


def test_warc_round_trip(spark):
    pages = [(1, "http://www.a.org/x", "<p>one</p>"), (2, "https://A.org:443/x#f", "<p>one</p>"), (3, None, None), (4, "", ""),
             (None, "http://b.org", "<p>one</p>"), (5, "http://b.org/é ü?q=1\t2", "two\r\n\r\nWARC/1.1\r\nlong" * 5000),
             (6, "http://b.org/dup", "dup"), (6, "http://b.org/dup", "dup"), (7, "http://b.org/dup", "dup")]
    pages += [(100 + n, f"http://hot.org/{n % 3}", f"page {n % 7}") for n in range(1500)]
    df = spark.createDataFrame(pages, PAGE).withColumn("key", F.lit("clash")).withColumn("file", F.lit("clash"))
    got = sorted((tuple(r) for r in warc.round_trip(spark, df.repartition(5)).collect()), key=str)
    assert got == brute(pages)
    assert warc.round_trip(spark, df.limit(0)).count() == 0


def test_archives_are_gzip_members_of_warc_records(spark, workdir):
    df = spark.createDataFrame([(1, "http://a.org/", "x"), (2, "http://a.org/2", "x")], PAGE)
    captures = warc.write_archives(spark, df, workdir).collect()
    for c in captures:
        with open(f"{workdir}/{c.file}", "rb") as f:
            f.seek(c.offset)
            raw = gzip.decompress(f.read(c.length))
        assert raw.startswith(b"WARC/1.1\r\nWARC-Type: ") and raw.endswith(b"\r\n\r\n")
        assert int(warc.parse(open(f"{workdir}/{c.file}", "rb").read()[c.offset:c.offset + c.length])[0]["Content-Length"]) > 0


def test_index_lookup_reads_single_blocks(spark, workdir, monkeypatch):
    pages = [(n, f"http://h{n % 50}.org/{n}", f"p{n}") for n in range(3000)]
    captures = warc.write_archives(spark, spark.createDataFrame(pages, PAGE), workdir)
    index = warc.build_index(spark, captures, workdir)
    assert index == sorted(index)
    wanted = spark.createDataFrame([(pages[7][1], "7"), ("http://none.org/", "1"), (pages[9][1], "8")], "url string, page string")
    assert [(r.key, r.page) for r in warc.lookup(wanted, index, workdir).collect()] == [(warc.url_key(pages[7][1]), "7")]
    store, folder = warc._filesystem(workdir)
    one = warc.IndexFile(store, f"{folder}/{index[0][1]}")
    assert one.held == -1 and list(one.find(one.first[0])) and one.held >= 0


def test_url_keys():
    assert warc.url_key("https://www.A.org:443/x?q#y") == "org,a,www)/x?q"
    assert warc.url_key("http://u@b.org:8080") == "org,b:8080)/"
    assert warc.url_key(None) == warc.url_key("") == ""


def test_increasing_subsequence():
    rng = random.Random(2)
    for _ in range(100):
        v = rng.sample(range(30), rng.randint(0, 12))
        got = [v[i] for i in license_scan.increasing(v)]
        assert got == sorted(got)
        best = [1] * len(v)
        for i in range(len(v)):
            best[i] = 1 + max((best[j] for j in range(i) if v[j] < v[i]), default=0)
        assert len(got) == max(best, default=0)


def test_alignment_is_a_common_subsequence():
    rng = random.Random(3)
    for _ in range(60):
        a = [rng.choice("abcdefghijklmnop") for _ in range(rng.randint(0, 30))]
        b = [rng.choice("abcdefghijklmnop") for _ in range(rng.randint(0, 30))]
        m = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in m)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(m, m[1:]))
    a = license_scan.words_of(license_scan.TEMPLATES["mit-notice"])
    b = [w for k, w in enumerate(a) if k % 10]                   # a tenth of the words missing
    assert len(license_scan.align(b, a)) >= sum(x.size for x in SequenceMatcher(None, b, a, False).get_matching_blocks())


def test_license_scan(spark, make_docs, odd, none, clashing):
    rng = random.Random(4)
    noise = lambda n: " ".join(f"w{rng.randint(0, 900)}" for _ in range(n))
    mit, apache = license_scan.TEMPLATES["mit-notice"], license_scan.TEMPLATES["apache-2.0"]
    docs = [(1, f"{noise(5000)} {mit} {noise(50)}"), (2, f"{noise(90)}\n{mit}\n{noise(90)}\n{mit}"),
            (3, f"# {apache.upper()}\n{noise(20)}"), (4, noise(400)), (5, "the license under which software"),
            (6, mit.replace("charge", "cost").replace("Software", "Work", 1)), (7, f"{noise(30)} {apache} {noise(30)} {license_scan.TEMPLATES['mit']}")]
    got = {r.doc_id: r for r in license_scan.scan_documents(make_docs(docs)).collect()}
    assert got[1].license == got[2].license == got[6].license == "mit-notice" and got[1].coverage == 1.0
    assert got[1].first_word == 5000 and got[1].end_word == 5000 + len(license_scan.words_of(mit))
    assert got[3].license == "apache-2.0" and got[4].license is None and got[5].license is None
    assert got[7].licenses == ["apache-2.0", "mit"]
    for df in (odd, clashing):
        assert [r.license for r in license_scan.scan_documents(df).collect()] == [None] * len(ODD)
    assert license_scan.scan_documents(none).count() == 0


def test_license_at_every_offset():
    """A tenth of the words replaced, two extra words after every fifth: the same result wherever the license begins."""
    scanner = license_scan.Scanner({"mit-notice": license_scan.TEMPLATES["mit-notice"]})
    template = scanner.words["mit-notice"]
    loose = []
    for k, w in enumerate(template):
        loose.append(f"other{k}" if k % 10 == 4 else w)
        if k % 5 == 2:
            loose += [f"more{k}", f"yet{k}"]
    found = set()
    for offset in range(len(template)):
        (name, coverage, first, end), = scanner.scan(" ".join([*(f"f{i}" for i in range(offset)), *loose, *(f"g{i}" for i in range(400))]))
        found.add((name, coverage, first - offset, end - offset))
    kept = sum(k % 10 != 4 for k in range(len(template)))
    assert found == {("mit-notice", kept / len(template), 0, len(loose))}


def test_license_lines_of_documents(spark):
    df = table(spark, "/root/testdata/sf0.01", "documents")
    want = {r.doc_id for r in df.where(F.col("text").rlike("(?i)licensed under|MIT License")).collect()}
    assert {r.doc_id for r in license_scan.scan_documents(df).where("license is not null").collect()} == want


def test_registered_queries():
    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES)
    assert numbers == list(range(1, 14)) and set(SQL) <= set(QUERIES)


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "exact_dedup", "near_dedup", "packing"]
    good = {r.doc_id for r in quality.score_documents(docs, quality.train(spark, docs, labels)).where("predicted = 1").collect()}
    step = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in step.select("doc_id", "text").collect()}
        step = written(spark, stage(spark, step, SF), f"test-{name}")
        if k < 4:
            assert step.columns == docs.columns
            left = {r.doc_id: r.text for r in step.collect()}
            assert left.items() <= before.items()
        if name == "quality":
            assert set(left) == good
        if name == "exact_dedup":
            assert sorted(left.values()) == sorted(set(before.values()))
            assert set(left) == {max(i for i, t in before.items() if t == text) for text in set(before.values())}
        if name == "packing":
            assert {r.doc_id for r in step.collect()} == set(before)


def test_pipeline_of_odd_rows(spark, odd, none, workdir):
    for frame, n in ((odd, len(ODD)), (none, 0)):
        labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
        folder = f"{workdir}/{n}"
        labels.write.parquet(f"{folder}/labels.parquet")
        docs = frame
        for _, stage in corpus_pipeline.STAGES:
            docs = written(spark, stage(spark, docs, folder), "odd")
        assert docs.count() >= (n > 0)


def _lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_gaps_are_matched_by_a_longest_common_subsequence():
    import random
    import numpy as np
    from ledgerline.llm import license_scan
    rnd = random.Random(1)
    for _ in range(150):
        a, b = ([rnd.randrange(4) for _ in range(rnd.randrange(0, 30))] for _ in range(2))
        found = sorted(license_scan._common(np.array(a, int), np.array(b, int), 0, 0))
        assert len(found) == _lcs(a, b)
        assert all(a[i] == b[j] for i, j in found) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))


def test_large_gap_without_unique_words_is_aligned():
    from ledgerline.llm import license_scan
    words = ["x", "y"] * 41
    text = ["q", *words[1:-1], "z"]
    assert len(license_scan.align(text, words)) == 80
    assert license_scan.Scanner({"two": " ".join(words)}).scan(" ".join(text)) == [("two", 80 / 82, 1, 81)]

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import bpe, packing
from ledgerline.llm.common import table

from .conftest import ODD, SF

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", " ", "a", " a", "a ", "a  b\n\n c\t\td\r\ne\x1cf\xa0g　h", "<|endoftext|>", "x<|endoftext|><|endoftext|> y",
         "don't it's we'll 'tis", "a" * 3000, "\U0001f600\U0001f389 naïve 漢字仮名 ١٢٣ ½ Ⅷ", "​﻿ x", "é" * 300,
         "a\tb  c", "a\x1fb c\x85d e", "one two\nthree four", "..., ,.;", "\n", "x\n", "\nx", " \n "]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def test_equals_tokenizers(reference):
    enc = bpe.SegmentTreeBPE(PATH)
    for got, text in zip(enc.encode(TEXTS), TEXTS):
        assert np.frombuffer(got, "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids
        assert enc.decode(got) == text


def test_random_texts_small_cache_and_segments(reference, monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(bpe, "SEGMENT_CHARS", 50)
    enc = bpe.SegmentTreeBPE(PATH, cache_pieces=20)
    alphabet = ["the", "ing", " ", " ", "\n", "é", "1", "!", "'s", "\t", "Z", "<|endoftext|>", "漢"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(150)]
    for got, text in zip(enc.encode(texts), texts):
        assert np.frombuffer(got, "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids
    for text in texts:
        assert "".join(bpe.segments(text, 20)) == text


def test_long_and_batched_trees_agree():
    m = bpe.Merges(PATH)
    rng = random.Random(1)
    for n in (2, 5, 17, 64, 128):
        raw = bytes(rng.choice(b"aeinrst") for _ in range(n))
        ids = m.byte_id[np.frombuffer(raw, np.uint8)]
        width = max(2, 1 << (n - 1).bit_length())
        batch = bpe.merge_batch(np.pad(ids, (0, width - n), constant_values=-1)[None, :], m)[0]
        assert batch[batch >= 0].tolist() == bpe.merge_long(ids.tolist(), m.rank)


def test_round_trip_rows(odd, none, clashing, reference):
    want = sorted((i or -1, len(ids := reference.encode(t or "", add_special_tokens=False).ids),
                   hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ODD)
    for df in (odd, clashing):
        got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(df, PATH).collect())
        assert got == want
    assert bpe.round_trip(none, PATH).count() == 0
    assert bpe.encode_documents(none, PATH).count() == 0


def check_pieces(rows, docs, reference, limit=packing.LIMIT):
    sequences, documents = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
        documents.setdefault(r.doc_id, []).append(r)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= limit
        padding += 0 if at & (at - 1) == 0 else limit - at
    assert padding == 0
    for i, text in docs:
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for p in sorted(documents[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)


def test_packing_of_documents(spark, make_docs, none, clashing, reference):
    docs = [(i, t) for i, t in ODD if i not in (None, 4)] + [(4, "")]
    check_pieces(packing.pack_documents(make_docs(docs), PATH).collect(), docs, reference)
    real = table(spark, SF, "documents")
    check_pieces(packing.pack_documents(real, PATH, group_docs=30).collect(),
                 [(r.doc_id, r.text) for r in real.select("doc_id", "text").collect()], reference)
    assert packing.pack_documents(none, PATH).count() == 0
    got = packing.pack_documents(clashing, PATH).groupBy().sum("length").first()[0]
    assert got == sum(len(reference.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ODD)


def test_pack_random_sizes():
    rng = random.Random(5)
    for _ in range(200):
        sizes = [rng.choice([rng.randint(1, 3000), rng.randint(1, 200), 1024]) for _ in range(rng.randint(0, 120))]
        seen = {}
        for sequence in packing.pack(sizes):
            n = sum(p[2] for p in sequence)
            assert n == 1024 or n & (n - 1) == 0
            for d, start, length in sequence:
                seen.setdefault(d, []).append((start, length))
        for d, size in enumerate(sizes):
            at = 0
            for start, length in sorted(seen[d]):
                assert start == at
                at += length
            assert at == size


def test_first_fit_by_tree_equals_plain_first_fit():
    rng = random.Random(6)
    sizes = sorted((rng.randint(1, 1024) for _ in range(300)), reverse=True)
    tree, bins, plain = packing.CapacityTree(len(sizes), 1024), [], [1024] * len(sizes)
    for s in sizes:
        k = next(i for i, c in enumerate(plain) if c >= s)
        plain[k] -= s
        bins.append(k)
        assert tree.place(s) == k

"""Packing documents into training sequences: first-fit decreasing with a tournament tree.

Documents are dealt at random (by a hash of id and text) over partitions, and each
partition is packed in groups of at most ``GROUP_DOCS`` documents, independently.
Within a group every whole ``limit`` tokens of a document fill a sequence of their
own. The rests, longest first, each go to the first bin with room: a tournament
tree over bin capacities holds in each node the largest capacity below it, so the
first such bin is found by one walk from the root. What first-fit leaves open is
closed by cutting pieces of the least filled bins, and the one rest below
``limit`` tokens is cut into powers of two, which need no padding.

Rows: a null text counts as empty; every document ends with id 0, so an empty one
has one token; null or repeated ids are kept as they are, each row packed as a
document of its own (their ``start`` is within the row); an empty table gives no
rows; only ``doc_id`` and ``text`` are read; very long texts are tokenised in
segments and cut over as many sequences as they need.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import PRETOKEN, byte_symbols, segments
from .common import doc_texts, slices

#: Tokens of a sequence.
LIMIT = 1024
#: Documents, and tokens, after which a group is closed.
GROUP_DOCS = 2048
GROUP_TOKENS = 1 << 22
#: Ids of the groups of one partition lie below this; of the sequences of a group likewise.
_GROUP_BITS, _SEQUENCE_BITS = 20, 20


class Tokenizer:
    """Ids of a byte-level BPE file whose token ids follow its merge order, by the ``tiktoken`` library.

    They equal those of the ``tokenizers`` library for the same file, which is about three times slower.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, to_byte = spec["model"]["vocab"], byte_symbols()
        ids = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if any(a >= b for a, b in zip(ids, ids[1:])):
            raise ValueError("token ids do not follow the merge order")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(to_byte[c] for c in token): i for token, i in vocab.items() if token not in special}
        self.encoding = tiktoken.Encoding("packing", pat_str=PRETOKEN.pattern, mergeable_ranks=ranks,
                                          special_tokens=special)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in segments(text):
            out.extend(self.encoding.encode(part, allowed_special="all"))
        return out


class CapacityTree:
    """Tournament tree over the capacities of ``bins`` bins; ``place`` puts a size in the first that has room."""

    def __init__(self, bins: int, capacity: int):
        self.width = 1 << max(0, (bins - 1).bit_length())
        self.best = [capacity] * (2 * self.width)

    def place(self, size: int) -> int:
        best, node = self.best, 1
        if best[1] < size:
            raise ValueError("no bin has room")
        while node < self.width:
            node *= 2
            if best[node] < size:
                node += 1
        found = node - self.width
        best[node] -= size
        while node > 1:
            node >>= 1
            best[node] = max(best[2 * node], best[2 * node + 1])
        return found


def pack(sizes: list[int], limit: int = LIMIT) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces ``(document, start, length)`` that hold every token of ``sizes`` once.

    All sequences but those of the last rest hold ``limit`` tokens; the rest's hold powers of two.
    """
    full, rests = [], []
    for d, n in enumerate(sizes):
        whole = n - n % limit
        full.extend([(d, at, limit)] for at in range(0, whole, limit))
        if n > whole:
            rests.append((d, whole, n - whole))
    rests.sort(key=lambda p: (-p[2], p[0]))
    tree = CapacityTree(len(rests), limit)
    bins: dict[int, list] = {}
    for p in rests:
        bins.setdefault(tree.place(p[2]), []).append(p)
    loads = sorted(((sum(p[2] for p in b), k) for k, b in bins.items()), key=lambda x: (-x[0], x[1]))
    open_bins = [[load, bins[k]] for load, k in loads if load < limit]
    full.extend(bins[k] for load, k in loads if load == limit)
    first, last = 0, len(open_bins) - 1
    while first < last:                           # the least filled bins close the others' gaps
        gap, donor = limit - open_bins[first][0], open_bins[last]
        if not donor[0]:
            last -= 1
            continue
        d, start, n = donor[1].pop()
        move = min(gap, n)
        open_bins[first][1].append((d, start + n - move, move))
        open_bins[first][0] += move
        donor[0] -= move
        if move < n:
            donor[1].append((d, start, n - move))
        if open_bins[first][0] == limit:
            first += 1
    full.extend(b for load, b in open_bins if load == limit)
    for load, pieces in open_bins:
        if 0 < load < limit:
            full.extend(_powers_of_two(load, pieces))
    return full


def _powers_of_two(load: int, pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    out, pieces = [], pieces[::-1]
    while load:
        room = 1 << (load.bit_length() - 1)
        load -= room
        out.append([])
        while room:
            d, start, n = pieces.pop()
            take = min(n, room)
            out[-1].append((d, start, take))
            room -= take
            if take < n:
                pieces.append((d, start + take, n - take))
    return out


_TOKENIZERS: dict[str, Tokenizer] = {}


def _tokenizer(path: str) -> Tokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Tokenizer(path)
    return _TOKENIZERS[path]


def pack_documents(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, end_id: int = 0,
                   group_docs: int = GROUP_DOCS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    src = doc_texts(docs)
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tok, task = _tokenizer(tokenizer_path), TaskContext.get().partitionId()
        ids, held, tokens, group = [], [], 0, 0

        def close():
            nonlocal ids, held, tokens, group
            rows = {k: [] for k in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
            owner = []
            sizes = [len(x) // 4 for x in held]
            for s, pieces in enumerate(pack(sizes, limit)):
                offset = 0
                for d, start, n in pieces:
                    owner.append(ids[d])
                    rows["start"].append(start)
                    rows["length"].append(n)
                    rows["ids_crc32"].append(zlib.crc32(memoryview(held[d])[4 * start:4 * (start + n)]))
                    rows["doc_tokens"].append(sizes[d])
                    rows["sequence_id"].append((task << _GROUP_BITS | group) << _SEQUENCE_BITS | s)
                    rows["offset"].append(offset)
                    offset += n
            ids, held, tokens, group = [], [], 0, group + 1
            return pa.RecordBatch.from_arrays([pa.array(owner, id_pa), *(pa.array(v, pa.int64()) for v in rows.values())],
                                              ["doc_id", *rows])

        id_pa = None
        for b in slices(batches):
            id_pa = b.column(0).type
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids.append(doc)
                held.append(np.array([*tok.encode(text), end_id], "<u4").tobytes())
                tokens += len(held[-1]) // 4
                if len(ids) >= group_docs or tokens >= GROUP_TOKENS:
                    yield close()
        if ids:
            yield close()

    dealt = src.withColumn("_h", F.xxhash64("doc_id", "text"))
    dealt = dealt.repartition(F.col("_h")).sortWithinPartitions("_h", "doc_id").select("doc_id", "text")
    return dealt.mapInArrow(run, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
                                 "sequence_id long, offset long")

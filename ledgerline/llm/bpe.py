"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

Each pre-token is a row of byte symbols. The leaves of a min segment tree hold,
for every adjacent pair, ``rank * width + position`` (infinite where the pair is
no merge), so the root is the leftmost pair of the lowest rank. One merge changes
three leaves, each repaired in logarithmic time, until the root is infinite.
Pre-tokens of one width are merged side by side as one numpy array of trees;
very long pre-tokens get a tree of plain lists.

A text is cut at white space into pieces whose tokens do not depend on their
neighbours; pieces seen before come from a bounded cache. Results equal those of
the ``tokenizers`` library for a byte-level BPE file without truncation, padding
or added special tokens (special strings inside a text are matched, as there).

Rows: a null text counts as empty (0 tokens, hash of the empty string); null or
repeated ids pass through, one result row per input row; an empty table gives
none; only ``doc_id`` and ``text`` are read, so extra columns cannot clash; a text
of any length is encoded whole, in segments cut at safe spaces.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import doc_texts, slices

#: The split pattern of the byte-level pre-tokenizer.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The white space of that pattern.
_WS = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
CHUNK = re.compile(rf" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
_SAFE_CUT = re.compile(rf"(?<=[^{_WS}]) (?=[^{_WS}])")
#: Longest text encoded in one go; longer ones are cut before a single space between words.
SEGMENT_CHARS = 1 << 22
#: Pieces kept in a worker's cache; it starts anew beyond that.
CACHE_PIECES = 600_000
#: Widest pre-token merged in the numpy batch; wider ones get a tree of their own.
BATCH_WIDTH = 128
#: Rows merged side by side: their trees stay in a core's cache.
BATCH_ROWS = 2048
_INF = np.int32(np.iinfo(np.int32).max)
NO_RANK = np.int32(1 << 24)
_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_SHIFT = np.uint64(64 - 17)


def byte_symbols() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest for 256 and up."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Vocabulary and merge ranks of a byte-level BPE file, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        to_byte = byte_symbols()
        self.token_bytes = [b""] * self.size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(to_byte[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.byte_id = np.zeros(256, np.int64)
        for c, b in to_byte.items():
            self.byte_id[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.rank = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in reversed(list(enumerate(pairs)))}
        self.new_of_rank = np.zeros(len(pairs), np.int32)
        for r, new in self.rank.values():
            self.new_of_rank[r] = new
        self.tables = _two_tables({a * self.size + b: r for (a, b), (r, _) in self.rank.items()})

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NO_RANK`` where it is no merge (ids below 0: never one)."""
        key = left.astype(np.int64) * self.size + right
        (k0, r0), (k1, r1) = self.tables
        h = key.view(np.uint64) * _MULTIPLIERS[0] >> _SHIFT
        g = key.view(np.uint64) * _MULTIPLIERS[1] >> _SHIFT
        out = np.where(k0.take(h) == key, r0.take(h), np.where(k1.take(g) == key, r1.take(g), NO_RANK))
        return np.where((left < 0) | (right < 0), NO_RANK, out)


def _two_tables(ranks: dict[int, int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each key sits at its slot in one of two hashed tables, so a lookup is two reads."""
    size = 1 << (64 - int(_SHIFT))
    slots = [[-1] * size, [-1] * size]
    mult = [int(m) for m in _MULTIPLIERS]
    for key in ranks:
        which = 0
        for _ in range(500):
            at = (key * mult[which] & (1 << 64) - 1) >> int(_SHIFT)
            key, slots[which][at] = slots[which][at], key
            if key < 0:
                break
            which = 1 - which
        else:
            raise ValueError("more merges than the pair tables hold")
    return [(np.array(s, np.int64), np.array([ranks.get(k, NO_RANK) for k in s], np.int32)) for s in slots]


def merge_long(symbols: list[int], rank: dict) -> list[int]:
    """One pre-token of any length: segment tree in plain lists, O(n log n)."""
    n = len(symbols)
    width = 1 << max(1, (n - 1).bit_length())
    none = (float("inf"), 0)
    ids = symbols
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = [none] * (2 * width)
    for i in range(n - 1):
        if hit := rank.get((ids[i], ids[i + 1])):
            tree[width + i] = (hit[0], i)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, value) -> None:
        node = width + i
        tree[node] = value
        while node > 1:
            node >>= 1
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

    while tree[1] is not none and tree[1][0] != none[0]:
        i = tree[1][1]
        j = after[i]
        ids[i] = rank[ids[i], ids[j]][1]
        ids[j] = -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        put(j, none)
        hit = rank.get((ids[i], ids[after[i]])) if after[i] < n else None
        put(i, (hit[0], i) if hit else none)
        if (p := before[i]) >= 0:
            hit = rank.get((ids[p], ids[i]))
            put(p, (hit[0], p) if hit else none)
    return [x for x in ids if x >= 0]


def merge_batch(ids: np.ndarray, merges: Merges) -> np.ndarray:
    """Merge the rows of ``ids`` (n x width symbols, width a power of two, -1 beyond a row's end) to the end.

    Returns the array with merged-away symbols as -1. All trees advance together, one merge a round;
    rows whose root is infinite drop out.
    """
    n, width = ids.shape
    bits = width.bit_length() - 1
    wide, deep = width + 1, 2 * width
    # column ``width`` is a neighbour that is never part of a pair
    sym = np.concatenate([ids, np.full((n, 1), -1)], axis=1).astype(np.int32)
    after = np.tile(np.minimum(np.arange(1, width + 2, dtype=np.int32), width), n)
    before = np.tile(np.concatenate([[width], np.arange(width)]).astype(np.int32), n)
    tree = np.full((n, deep), _INF, np.int32)
    rank = merges.ranks(sym[:, :width - 1], sym[:, 1:width])
    tree[:, width:-1] = np.where(rank < NO_RANK, (rank << bits) + np.arange(width - 1, dtype=np.int32), _INF)
    level = width
    while level > 1:
        tree[:, level >> 1:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
        level >>= 1
    sym, tree = sym.ravel(), tree.ravel()
    row = np.arange(n)
    while True:
        root = tree.take(row * deep + 1)
        live = root < _INF
        if not live.all():
            row, root = row[live], root[live]
            if not len(row):
                return sym.reshape(n, wide)[:, :-1]
        base, top = row * wide, row * deep
        i = root & (width - 1)
        at_i = base + i
        j = after.take(at_i)
        at_j = base + j
        new = merges.new_of_rank.take(root >> bits)
        sym[at_i] = new
        sym[at_j] = -1
        follow = after.take(at_j)
        after[at_i] = follow
        before[base + follow] = i
        prev = before.take(at_i)
        k = len(row)
        rank = merges.ranks(np.concatenate([new, sym.take(base + prev)]), np.concatenate([sym.take(base + follow), new]))
        leaf = np.concatenate([i, np.where(i == 0, i, prev)])
        value = np.where(rank < NO_RANK, (rank << bits) + leaf, _INF)
        value[k:] = np.where(i == 0, value[:k], value[k:])
        node = np.concatenate([j, leaf]) + width
        tops = np.concatenate([top, top, top])
        tree[top + j + width] = _INF
        tree[tops[k:] + node[k:]] = value
        for _ in range(bits):       # the three leaves' paths to the root, a level at a time
            child = tops + (node & ~1)
            node >>= 1
            tree[tops + node] = np.minimum(tree.take(child), tree.take(child + 1))


def _pretokens(piece: str, prefix: str) -> list[str]:
    """Pre-tokens of a piece, after ``prefix`` unless it begins with a line end."""
    if piece.isalpha():                   # letters only: one pre-token
        return [prefix + piece]
    if piece[-1:] in (".", ",") and piece[:-1].isalpha():
        return [prefix + piece[:-1], piece[-1]]
    return PRETOKEN.findall(piece if piece[:1] == "\n" else prefix + piece)


class _Pieces(dict):
    """Ids by piece. A piece not yet known reads as None and is noted until ``learn``."""

    def __init__(self, prefix: str):
        super().__init__()
        self.prefix = prefix
        self.missing: set[str] = set()

    def __missing__(self, piece: str) -> None:
        self.missing.add(piece)

    def learn(self, encoder: SegmentTreeBPE) -> None:
        pieces = list(self.missing)
        self.missing.clear()
        split = [_pretokens(p, self.prefix) for p in pieces]
        ids = encoder.pretokens(list({t for tokens in split for t in tokens}))
        for p, tokens in zip(pieces, split):
            self[p] = ids[tokens[0]] if len(tokens) == 1 else b"".join(map(ids.__getitem__, tokens))

    def trim(self, limit: int) -> None:
        if len(self) > limit:
            self.clear()


class SegmentTreeBPE:
    """Encoder and decoder of one process; ``encode`` gives ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        self.merges = Merges(path)
        self.limit = cache_pieces
        self.words = _Pieces(" ")     # "x" -> ids of " x"; "\nx" -> ids of "\nx"
        self.chunks = _Pieces("")     # chunk -> its ids
        names = sorted(self.merges.special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.token_bytes = self.merges.token_bytes

    def pretokens(self, tokens: list[str]) -> dict[str, bytes]:
        """Ids of distinct pre-tokens."""
        m, out, by_width = self.merges, {}, {}
        raws = [t.encode() for t in tokens]
        for t, raw in zip(tokens, raws):
            by_width.setdefault(len(raw), []).append((t, raw))
        groups: dict[int, list] = {}
        for n, group in by_width.items():
            if n > BATCH_WIDTH:
                for t, raw in group:
                    ids = merge_long(m.byte_id[np.frombuffer(raw, np.uint8)].tolist(), m.rank)
                    out[t] = np.array(ids, "<u4").tobytes()
            else:
                groups.setdefault(max(2, 1 << (n - 1).bit_length()), []).extend(group)
        by_width = groups
        for width, group in by_width.items():
            for k in range(0, len(group), BATCH_ROWS):
                part = group[k:k + BATCH_ROWS]
                flat = np.frombuffer(b"".join(raw.ljust(width, b"\0") for _, raw in part), np.uint8).reshape(-1, width)
                lens = np.array([len(raw) for _, raw in part])
                ids = np.where(np.arange(width) < lens[:, None], m.byte_id[flat], -1)
                ids = merge_batch(ids, m)
                kept = ids >= 0
                data = ids[kept].astype("<u4").tobytes()
                ends = (4 * np.cumsum(kept.sum(axis=1))).tolist()
                begin = 0
                for (t, _), end in zip(part, ends):
                    out[t] = data[begin:end]
                    begin = end
        return out

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that hold no special string."""
        plans = []
        for t in texts:
            if (t and t[0] not in " \n" and t[-1] not in " \n" and "  " not in t and "\n\n" not in t
                    and " \n" not in t and "\n " not in t):
                pieces = t.replace("\n", " \n").split(" ")
                if len(t.split()) == len(pieces):     # single spaces and line ends are its only white space
                    plans.append((self.words, pieces))
                    pieces[0] = "\n" + pieces[0]      # its ids: those of the line end, then of the piece
                    continue
            plans.append((self.chunks, CHUNK.findall(t)))
        found = [list(map(cache.__getitem__, pieces)) for cache, pieces in plans]
        for cache in (self.words, self.chunks):
            cache.learn(self)
        out = []
        for (cache, pieces), ids in zip(plans, found):
            if None in ids:
                ids = list(map(cache.__getitem__, pieces))
            if cache is self.words:
                ids[0] = ids[0][4:]
            out.append(b"".join(ids))
        for cache in (self.words, self.chunks):
            cache.trim(self.limit)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every whole text."""
        parts, owners, fixed = [], [], {}
        for n, text in enumerate(texts):
            begin = 0
            for m in self.special.finditer(text) if self.special else ():
                parts.extend(s := list(segments(text[begin:m.start()])))
                owners.extend([n] * len(s))
                fixed[len(parts)] = np.array([self.merges.special[m[0]]], "<u4").tobytes()
                parts.append("")
                owners.append(n)
                begin = m.end()
            parts.extend(s := list(segments(text[begin:] if begin else text)))
            owners.extend([n] * len(s))
        out: list[list[bytes]] = [[] for _ in texts]
        begin = total = 0
        for k, part in enumerate([*parts, None]):     # about SLICE_CHARS of pieces are held at a time
            if k > begin and (part is None or total + len(part) > SEGMENT_CHARS):
                for at, ids in enumerate(self._plain(parts[begin:k]), begin):
                    out[owners[at]].append(fixed.get(at, ids))
                begin, total = k, 0
            total += len(part or "")
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def decode(self, ids: bytes) -> str:
        """Text of the ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def segments(text: str, size: int = SEGMENT_CHARS) -> Iterator[str]:
    """``text`` in pieces of about ``size``, each cut before a space that stands alone between words."""
    begin = 0
    while len(text) - begin > size:
        cut = _SAFE_CUT.search(text, begin + size)
        if not cut:
            break
        yield text[begin:cut.start()]
        begin = cut.start()
    yield text[begin:] if begin else text


_ENCODERS: dict[str, SegmentTreeBPE] = {}


def encoder(path: str) -> SegmentTreeBPE:
    """This worker process's encoder for the file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = SegmentTreeBPE(path)
    return _ENCODERS[path]


def ids_digest(ids: np.ndarray) -> str:
    """SHA-256 of the decimal ids joined by commas, a bounded part of them as text at a time."""
    h = hashlib.sha256()
    for k in range(0, len(ids), 1 << 20):
        h.update(((b"," if k else b"") + ",".join(map(str, ids[k:k + (1 << 20)].tolist())).encode()))
    return h.hexdigest()


ENCODED = "doc_id long, n_tokens long, ids binary"


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the ids (little-endian unsigned 32-bit) of every whole text."""
    def run(batches):
        enc = encoder(tokenizer_path)
        for b in slices(batches):
            ids = enc.encode(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                                              pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    src = doc_texts(docs)
    return src.mapInArrow(run, _schema(src, "n_tokens long, ids binary"))


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Encode every text, decode its ids again, and digest both: one row per document."""
    def run(batches):
        enc = encoder(tokenizer_path)
        for b in slices(batches):
            count, of_ids, of_text = [], [], []
            for raw in enc.encode(b.column(1).to_pylist()):
                ids = np.frombuffer(raw, "<u4")
                count.append(len(ids))
                of_ids.append(ids_digest(ids))
                of_text.append(hashlib.sha256(enc.decode(raw).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(count, pa.int64()), pa.array(of_ids, pa.string()),
                                              pa.array(of_text, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    src = doc_texts(docs)
    return src.mapInArrow(run, _schema(src, "n_tokens long, ids_sha256 string, decoded_sha256 string"))


def _schema(src: DataFrame, rest: str) -> str:
    return f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {rest}"

"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

Separators are ASCII, so they never stand inside a character of more bytes. A word's
hash is a polynomial of its bytes (each through a table of random 64-bit values) modulo
2^64, mixed; two different words share one with probability about 2^-64.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Bytes hashed at a time (more only where one word is longer); so many powers stay in a core's cache.
BLOCK = 1 << 16

#: Lower-cases A-Z and nothing else.
LOWER = bytes(range(256)).lower()


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def joined(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """The texts' UTF-8 bytes, a line feed before each, and where each one's line feed stands."""
    if not len(texts):
        return b"", np.zeros(0, np.int64)
    whole = pc.binary_join_element_wise(pa.scalar(b"", pa.large_binary()), texts.cast(pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))
    at = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:whole.offset + len(whole) + 1]
    return whole.buffers()[2][int(at[0]):int(at[-1])].to_pybytes(), at[:-1] - at[0]


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers from 0 on, and their inverses modulo 2^64."""
    power, inverse = np.full(size, _M2, np.uint64), np.full(size, pow(int(_M2), -1, 1 << 64), np.uint64)
    power[0] = inverse[0] = 1
    return np.multiply.accumulate(power), np.multiply.accumulate(inverse)


class Words:
    """Words of a byte string: ``start``, ``length`` and ``hash`` of each, in order."""

    def __init__(self, data: np.ndarray, separators: bytes):
        outside = bytes(c not in separators for c in range(256))
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = np.frombuffer(data.tobytes().translate(outside), bool)
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edge[::2], edge[1::2]
        self.length = self.end - self.start
        self.hash = np.zeros(len(self.start), np.uint64)
        if not len(self.start):
            return
        value = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * GOLDEN)
        k = 0
        while k < len(self.start):
            begin = int(self.start[k])
            stop = max(k + 1, int(np.searchsorted(self.end, begin + BLOCK, side="right")))
            size = int(self.end[stop - 1]) - begin
            power, inverse = _powers(BLOCK) if size <= BLOCK else _powers.__wrapped__(size)
            upto = value[data[begin:begin + size]]
            upto *= power[:size]
            np.cumsum(upto, out=upto)                           # of the block's bytes, separators too
            first = self.start[k:stop] - begin
            terms = upto[self.end[k:stop] - begin - 1]
            terms[1:] -= upto[first[1:] - 1]                    # the word's own, as if it began the block
            self.hash[k:stop] = terms * inverse[first]
            k = stop
        self.hash = mix(self.hash + self.length.astype(np.uint64) * GOLDEN)


def chained(hashes: list[np.ndarray], seed: int) -> np.ndarray:
    """Hash of word sequences: the first words' hashes, the second ones' and so on."""
    out = np.full(len(hashes[0]), seed, np.uint64)
    for h in hashes:
        out = mix(out * GOLDEN + h)
    return out


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sum of each one's weights, and a place where each stands."""
    if not len(keys):
        return keys, weights, np.zeros(0, np.int64)
    order = np.argsort(keys)
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(weights, first), order[first]

"""CRC-32 of many byte spans at once, from a table of contributions by position.

CRC-32 is affine over GF(2): the checksum of a span is a constant of its length, XOR one contribution of each byte, which depends
on the byte and on its distance from the span's end only.  The contributions of ``DEPTH`` distances are computed once; a span's
are combined by ``bitwise_xor.reduceat``.  A span longer than ``DEPTH`` is cut into blocks counted from its end, whose values are
folded pairwise: the block further from the end moves on by the bytes behind it, which is a linear map held as four
tables of 256 entries for each power of two.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

DEPTH_BITS = 6
DEPTH = 1 << DEPTH_BITS
_POLYNOMIAL = 0xEDB88320  # of CRC-32, bits reversed
_SHORT = 1024


@lru_cache(maxsize=1)
def _one_byte() -> np.ndarray:
    """Contribution of a last byte."""
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ np.uint32(_POLYNOMIAL), x >> 1)
    return x


@lru_cache(maxsize=1)
def position_table() -> np.ndarray:
    """[distance from the end, byte] -> contribution."""
    out = np.empty((DEPTH, 256), np.uint32)
    out[0] = _one_byte()
    for d in range(1, DEPTH):
        out[d] = (out[d - 1] >> 8) ^ _one_byte()[out[d - 1] & 255]
    return out


@lru_cache(maxsize=64)
def _advance(k: int) -> np.ndarray:
    """[byte of the state, value] -> state after 2 ** k zero bytes."""
    if k:
        before = _advance(k - 1)
        return np.stack([moved(moved(np.arange(256, dtype=np.uint32) << np.uint32(8 * j), before), before) for j in range(4)])
    state = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)])
    return (state >> np.uint32(8)) ^ _one_byte()[state & 255]


def moved(state: np.ndarray, by: np.ndarray) -> np.ndarray:
    return by[0][state & 255] ^ by[1][(state >> 8) & 255] ^ by[2][(state >> 16) & 255] ^ by[3][state >> 24]


def _zeros(n: np.ndarray) -> np.ndarray:
    """CRC-32 of n zero bytes, for an array of lengths."""
    state = np.full(len(n), 0xFFFFFFFF, np.uint32)
    for k in range(int(n.max()).bit_length() if len(n) else 0):
        some = (n >> k) & 1 == 1
        state[some] = moved(state[some], _advance(k))
    return ~state


@lru_cache(maxsize=1)
def _short_zeros() -> np.ndarray:
    return _zeros(np.arange(_SHORT))


def length_constants(n: np.ndarray) -> np.ndarray:
    out = _short_zeros()[np.minimum(n, _SHORT - 1)]
    long = n >= _SHORT
    if long.any():
        out[long] = _zeros(n[long])
    return out


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 (unsigned) of data[starts[i]:ends[i]] for every i; spans may overlap and be empty."""
    n = ends - starts
    blocks = -(-n // DEPTH)
    span = np.repeat(np.arange(len(n)), blocks)
    behind = np.arange(len(span)) - np.repeat(np.cumsum(blocks) - blocks, blocks)  # blocks between this one and the span's end
    stop = ends[span] - behind * DEPTH
    size = np.minimum(stop - starts[span], DEPTH)
    value = np.zeros(0, np.uint32)
    if len(span):
        offset = np.cumsum(size) - size
        distance = np.arange(int(size.sum())) - np.repeat(offset, size)
        byte = data[np.repeat(stop - 1, size) - distance]
        value = np.bitwise_xor.reduceat(position_table().ravel()[(distance << 8) | byte], offset)
    level = DEPTH_BITS
    count = blocks
    while len(count) and count.max() > 1:
        # the blocks of a span lie side by side, the last one first; each odd one moves over the one behind it
        first = np.cumsum(count) - count
        at = np.arange(len(value)) - np.repeat(first, count)
        odd = at % 2 == 1
        value[np.flatnonzero(odd) - 1] ^= moved(value[odd], _advance(level))
        value, count, level = value[~odd], -(-count // 2), level + 1
    out = length_constants(n)
    out[blocks > 0] ^= value
    return out

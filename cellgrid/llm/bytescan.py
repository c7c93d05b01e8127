"""Vectorised scanning of Arrow string columns: words, lines and their 64-bit hashes.

Works on the UTF-8 bytes of a whole record batch at once (no per-row Python loop):
one lookup table lower-cases A-Z and marks which bytes belong to a word, and a running
polynomial sum gives the hash of every byte range by two gathers.  A null text is
treated as an empty one.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 16


def slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20):
    """Cut a record batch into runs of rows whose ``column`` holds about ``limit`` bytes (at least one row)."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    ends = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column, offsets starting at 0; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    if len(column) == 0 or buffers[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


@lru_cache(maxsize=4)
def _powers(base: int) -> np.ndarray:
    out = np.empty(_BLOCK + 1, np.uint64)
    out[0] = 1
    out[1:] = np.cumprod(np.full(_BLOCK, base, np.uint64))
    return out


def _power_at(base: int, n: np.ndarray) -> np.ndarray:
    """base ** n modulo 2**64 for an array of exponents."""
    low = _powers(base)[n % _BLOCK]
    high = (n // _BLOCK).astype(np.int64)
    if high.any():
        low = low * np.array([pow(base, _BLOCK * k, 1 << 64) for k in range(int(high.max()) + 1)], np.uint64)[high]
    return low


def mix(x: np.ndarray) -> np.ndarray:
    """Final avalanche of a 64-bit value (bijective)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hash of data[starts[i]:ends[i]] for every i."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n, scale, powers = len(data), 1, _powers(_BASE)
    running = np.zeros(n + 1, np.uint64)
    for at in range(0, n, _BLOCK):  # block by block, so that the work stays in cache
        part = data[at:at + _BLOCK].astype(np.uint64)
        part += np.uint64(1 + salt)
        part *= powers[:len(part)]
        part *= np.uint64(scale)
        part[:1] += running[at:at + 1]
        np.cumsum(part, out=running[at + 1:at + 1 + len(part)])
        scale = scale * pow(_BASE, _BLOCK, 1 << 64) % (1 << 64)
    h = (running[ends] - running[starts]) * _power_at(_INVERSE, starts)
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def table(is_word) -> np.ndarray:
    """256 entries: the byte with A-Z lower-cased where ``is_word`` accepts it, else 0."""
    out = np.zeros(256, np.uint8)
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        out[b] = low if is_word(low) else 0
    return out


#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z (digits, letters and every non-ASCII byte)
ALNUM = table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
#: words [^\x20\x09-\x0D]+ after lower-casing A-Z; byte 0 is a word byte and stands in as 0xFF, which UTF-8 never uses
SPACED = table(lambda b: b != 32 and not 9 <= b <= 13)
SPACED[0] = 255


def words(data: np.ndarray, offsets: np.ndarray, lut: np.ndarray):
    """(lower-cased bytes, word starts, word ends, first word of each row): words never cross rows."""
    low = lut[data]
    inside = low != 0
    begin = inside.copy()
    if len(data):
        begin[1:] &= ~inside[:-1]
        rows = offsets[:-1][offsets[:-1] < len(data)]
        begin[rows] |= inside[rows]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cut = offsets[1:][offsets[1:] > 0] - 1
        last[cut] |= inside[cut]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(last) + 1
    else:
        starts = ends = np.zeros(0, np.int64)
    return low, starts, ends, np.searchsorted(starts, offsets)


def lines(data: np.ndarray, offsets: np.ndarray):
    """(line starts, line ends without the newline, first line of each row), split at "\\n".

    An empty text has no lines; a text that ends with a newline has an empty last line.
    """
    breaks = np.flatnonzero(data == 10)
    of_break = np.searchsorted(offsets, breaks, side="right") - 1
    full = np.flatnonzero(offsets[:-1] < offsets[1:])
    row = np.concatenate([full, of_break])
    starts = np.concatenate([offsets[:-1][full], breaks + 1])
    ends = np.concatenate([offsets[1:][full], breaks])
    by_start, by_end = np.lexsort((starts, row)), np.lexsort((ends, row))
    return starts[by_start], ends[by_end], np.searchsorted(row[by_start], np.arange(len(offsets)))

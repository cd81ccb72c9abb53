"""Vectorised tokenisation of Arrow text columns.

The operators that count or look up words do so over whole Arrow batches:
the UTF-8 buffer of a text column is classified byte by byte through a lookup
table, word edges come from one comparison, and each word is named by a
64-bit hash computed from prefix sums. No Python object is made per word.

Batches are cut into slices of about ``SLICE_BYTES`` of text (one row at
least), so the temporaries stay a small multiple of that, or of the longest
single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_P = np.uint64(0x9E3779B97F4A7C55)            # odd, so it has an inverse modulo 2**64
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))

# Byte classes. LOWER maps A-Z to a-z and leaves every other byte alone.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
#: Words of the decontamination contract: a-z, 0-9 and every non-ASCII byte, after LOWER.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[ord("0"):ord("9") + 1] = True
ALNUM[ord("a"):ord("z") + 1] = True
ALNUM[ord("A"):ord("Z") + 1] = True
ALNUM[128:] = True
#: Words between ASCII white space (space and 0x09-0x0D).
NONSPACE = np.ones(256, dtype=bool)
NONSPACE[[32, 9, 10, 11, 12, 13]] = False

_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``n`` of each."""
    if "p" not in _powers or len(_powers["p"]) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        for name, base in (("p", _P), ("q", _P_INV)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            np.multiply.accumulate(table, out=table)
            _powers[name] = table
    return _powers["p"], _powers["q"]


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the ``n + 1`` offsets of its rows; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + n + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(buf: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges holding about ``limit`` bytes each: ``(first, last, bytes, offsets)``."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        b = min(b, n)
        yield a, b, buf[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def word_edges(buf: np.ndarray, offsets: np.ndarray, klass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end (exclusive) of every word; words never cross a row."""
    if len(buf) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mask = klass[buf]
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    inner = offsets[(offsets > 0) & (offsets < len(buf))]
    first[inner] |= mask[inner]
    last[inner - 1] |= mask[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads every bit of a 64-bit hash."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def hash_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each lower-cased word, from prefix sums over the slice."""
    return hash_bytes(LOWER[buf], starts, ends)


def hash_bytes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each range of bytes."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    p, q = _power_table(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * p[:len(buf)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * q[starts]
    return mix64(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words_of(buf: np.ndarray, offsets: np.ndarray, klass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a slice and the word offsets of its rows (``n + 1`` of them)."""
    starts, ends = word_edges(buf, offsets, klass)
    return hash_words(buf, starts, ends), np.searchsorted(starts, offsets).astype(np.int64)


def hash_word(word: str) -> int:
    """The hash of one word, as ``words_of`` computes it."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(hash_words(data, np.array([0]), np.array([len(data)]))[0])


def sorted_counts(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values (sorted) and how often each occurs, or the sum of its weights."""
    if len(values) == 0:
        return values, np.zeros(0, np.int64)
    if weights is None:
        values = np.sort(values)
    else:
        order = np.argsort(values, kind="stable")
        values, weights = values[order], weights[order]
    at = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    if weights is None:
        return values[at], np.diff(np.append(at, len(values)))
    return values[at], np.add.reduceat(weights, at)


def lookup(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``values`` in the sorted ``table`` and whether each is there."""
    if len(table) == 0:
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return at, table[at] == values

"""Whole-text helpers on Arrow buffers: words, word hashes, rolling window hashes.

All of them work on the UTF-8 bytes of a slice of documents at once.  A word is
``[^\\x20\\x09-\\x0D]+``; the separators are single bytes, so byte positions
never split a code point.

Two kinds of hashes.  ``word_hashes`` deals words into features and buckets: a
polynomial modulo 2**64, cheap, with collisions that can be constructed.  Where
equality of hashes stands for equality of text, every word has two values from a
keyed hash (SipHash-2-4).  Long windows are Rabin-Karp polynomials over two of them
modulo the prime 2**61 - 1, which has none of the structure that lets polynomials
modulo a power of two collide; shingles of a few words chain one through the mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a task turns into numpy arrays at a time.
SLICE_BYTES = 2 << 20
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_BASE = 0x9E3779B97F4A7C15
#: The field of the word polynomials, and a base for each of the two values of a word.
PRIME = (1 << 61) - 1
BASES = (0x0F1BBCDCBFA53E0B, 0x05851F42D4C957F3)
#: Words whose windows are hashed at a time; the tables of powers are as long.
CHUNK = 1 << 18
#: Keys of the word hashes.
KEYS = ("gridloom words 0", "gridloom words 1")


def mix(h: np.ndarray) -> np.ndarray:
    """Finish 64-bit hashes so that every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BYTE_BASE))


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer text is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def blank_cuts(data: np.ndarray, limit: int):
    """Byte ranges of about ``limit`` that end behind a blank, so that no word is cut; a longer word is a range of its own."""
    lo = 0
    while lo < len(data):
        hi = lo + limit
        while hi < len(data):
            blank = np.flatnonzero(SEPARATORS[data[hi:hi + limit]])
            if len(blank):
                hi += int(blank[0]) + 1
                break
            hi += limit
        yield lo, min(hi, len(data))
        lo = hi


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each row (one more entry than rows)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~SEPARATORS[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    opens[edges] = inside[edges]  # a row's first byte follows nothing
    closes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _prefix(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, dtype=np.uint64, out=out[1:])
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    n = len(data)
    sums = _prefix(BYTE_VALUES[data] * _powers(BYTE_BASE, n))
    back = _powers(pow(BYTE_BASE, -1, 1 << 64), n + 1)
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, for x < 2**64."""
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - np.uint64(PRIME), x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, for factors below 2**61: 32-bit halves, with 2**61 = 1."""
    half, low = np.uint64(32), np.uint64(0xFFFFFFFF)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    middle, last = a1 * b0 + a0 * b1, a0 * b0
    return _reduced(((a1 * b1) << np.uint64(3)) + (middle >> np.uint64(29)) + ((middle & np.uint64((1 << 29) - 1)) << half)
                    + (last & np.uint64(PRIME)) + (last >> np.uint64(61)))


def _field_sums(x: np.ndarray) -> np.ndarray:
    """Prefix sums modulo PRIME, one more than values: the halves are summed apart, so nothing overflows."""
    out = np.zeros(len(x) + 1, np.uint64)
    low, high = np.cumsum(x & np.uint64(0xFFFFFFFF), dtype=np.uint64), _reduced(np.cumsum(x >> np.uint64(32), dtype=np.uint64))
    out[1:] = _reduced((high >> np.uint64(29)) + ((high & np.uint64((1 << 29) - 1)) << np.uint64(32)) + _reduced(low))
    return out


def _field_powers(base: int, n: int, known: dict = {}) -> np.ndarray:  # noqa: B006 - a cache of the worker
    have = known.get(base, np.ones(1, np.uint64))
    while len(have) < n:
        have = np.concatenate([have, _times(have, np.uint64(pow(base, len(have), PRIME)))])
    known[base] = have
    return have[:n]


def word_digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lanes: int = 2) -> np.ndarray:
    """64-bit values of each word, its SipHash-2-4 under each of the KEYS; ``data`` holds these words and separators only."""
    if not len(starts):
        return np.zeros((lanes, 0), np.uint64)
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data[~SEPARATORS[data]])]).dictionary_encode()
    different = np.array(words.dictionary.to_pylist(), object)
    return np.stack([hash_array(different, hash_key=key, categorize=False) for key in KEYS[:lanes]])[:, words.indices.to_numpy()]


def word_values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two values below 2**61 for each word."""
    return word_digests(data, starts, ends) & np.uint64(PRIME)


def window_values(values: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rabin-Karp values of every window of ``size`` words within one row.

    Returns the two values of each, the first word of each window, and the first
    window of each row (one more entry than rows).
    """
    per_row = np.maximum(np.diff(first) - size + 1, 0)
    row_first = np.concatenate([[0], np.cumsum(per_row)])
    at = np.arange(int(row_first[-1])) + np.repeat(first[:-1] - row_first[:-1], per_row)
    out = np.zeros((2, len(at)), np.uint64)
    for lo in range(0, values.shape[1] if len(at) else 0, CHUNK):
        a, b = np.searchsorted(at, [lo, lo + CHUNK])
        if a == b:
            continue
        own, here = values[:, lo:lo + CHUNK + size - 1], at[a:b] - lo
        for k, base in enumerate(BASES):
            sums = _field_sums(_times(own[k], _field_powers(base, own.shape[1])))
            back = _field_powers(pow(base, -1, PRIME), own.shape[1])
            out[k, a:b] = _times(_reduced(sums[here + size] + np.uint64(PRIME) - sums[here]), back[here])
    return out, at, row_first


def run_values(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The two Rabin-Karp values of runs of words, which follow each other without a gap; the length counts as well."""
    length = ends - starts
    place = np.arange(values.shape[1]) - np.repeat(starts, length)
    out = np.zeros((2, len(starts)), np.uint64)
    for k, base in enumerate(BASES):
        sums = _field_sums(_times(values[k], _field_powers(base, int(length.max(initial=0)) + 1)[place]))
        out[k] = _reduced(sums[ends] + np.uint64(PRIME) - sums[starts] + length.astype(np.uint64))
    return out


def wide(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """96 of the 122 bits of pairs of values: 64 well-mixed ones and 32 more."""
    return mix(values[0] | (values[1] << np.uint64(61))), ((values[1] >> np.uint64(3)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _chained(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from every word on, but the last ones."""
    n = max(len(words) - size + 1, 0)
    h = mix(words[:n])
    for j in range(1, size):
        h = mix(h ^ words[j:j + n])
    return h


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every ``size``-word shingle, by row.

    A row with fewer words has its whole sequence as its only shingle; a row
    without words has none.
    """
    starts, ends, first = split_words(data, offsets)
    words = word_digests(data, starts, ends, 1)[0]
    per_row = np.maximum(np.diff(first) - size + 1, 0)
    row_first = np.concatenate([[0], np.cumsum(per_row)])
    at = np.arange(int(row_first[-1])) + np.repeat(first[:-1] - row_first[:-1], per_row)
    hashes = _chained(words, size)[at] if len(at) else np.zeros(0, np.uint64)
    counts, n_words = np.diff(row_first), np.diff(first)
    rows = np.repeat(np.arange(len(counts)), counts)
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        whole = [_chained(words[first[r]:first[r + 1]], int(n_words[r])) for r in short]
        at = np.searchsorted(rows, short)
        hashes, rows = np.insert(hashes, at, np.concatenate(whole)), np.insert(rows, at, short)
    return hashes, rows


def distinct(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each row, ascending, and where each row begins (one more entry than rows)."""
    order = np.argsort(hashes)
    order = order[np.argsort(rows[order], kind="stable")]
    hashes, rows = hashes[order], rows[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[keep], np.searchsorted(rows[keep], np.arange(n_rows + 1))


def join_words(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, keep: np.ndarray) -> pa.Array:
    """Per row, the kept words joined by one space."""
    n_rows = len(offsets) - 1
    rows = np.repeat(np.arange(n_rows), np.diff(first))[keep]
    opens, closes = starts[keep], ends[keep]
    follows = np.zeros(len(rows), bool)
    follows[1:] = rows[1:] == rows[:-1]
    out = data.copy()
    gaps = opens[follows] - 1
    out[gaps] = 32
    edge = np.zeros(len(data) + 1, np.int8)
    edge[opens - follows] += 1
    edge[closes] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    at = np.zeros(n_rows + 1, np.int64)
    np.cumsum(np.bincount(rows, closes - opens + follows, n_rows), out=at[1:])
    return pa.LargeStringArray.from_buffers(n_rows, pa.py_buffer(at), pa.py_buffer(out[inside])).cast(pa.string())


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts; the size that block and bucket counts follow."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0

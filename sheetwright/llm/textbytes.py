"""Vectorised work on the UTF-8 bytes of an Arrow text column: slices of bounded size, words, fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers = {"pow": np.ones(1, U64), "inv": np.ones(1, U64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the fingerprint base and of its inverse, modulo 2**64."""
    if len(_powers["pow"]) < n:
        size = -(-n // (1 << 18)) << 18  # kept as long as the worker lives, so no larger than needed
        for name, base in (("pow", _BASE), ("inv", _BASE_INV)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["pow"][:n], _powers["inv"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (one to one)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def random_words(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudorandom odd 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and its row offsets; a null counts as empty text."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (a longer row stands alone)."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


def word_table(separators: bytes, seed: int = 7) -> np.ndarray:
    """Byte values for word fingerprints: 0 for separators, one value for both cases of an ASCII letter."""
    lut = random_words(256, seed)
    lut[65:91] = lut[97:123]
    lut[list(separators)] = 0
    return lut


SPACES = bytes([0x20, *range(0x09, 0x0E)])
NOT_WORDS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def words(data: np.ndarray, offsets: np.ndarray, lut: np.ndarray):
    """Words of the texts ``data[offsets[i]:offsets[i+1]]``.

    Returns (start, end, row, fingerprint) arrays; start and end are byte positions
    in ``data``; row numbers count from 0.
    """
    n = len(data)
    if not n:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, np.empty(0, U64)
    code = lut[data]
    inside = code != 0
    before = np.empty(n + 1, bool)
    before[0] = False
    before[1:] = inside
    edges = offsets[:-1][offsets[:-1] < n]
    first = inside & ~before[:-1]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = inside[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    return start, end, row, spans_hash(prefix_hash(code), start, end)


def prefix_hash(code: np.ndarray) -> np.ndarray:
    """Prefix sums of ``code[i] * base**i``; ``spans_hash`` takes the fingerprint of any span from them."""
    out = np.zeros(len(code) + 1, U64)
    np.cumsum(code * powers(len(code))[0], out=out[1:])
    return out


def spans_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of spans: equal for equal contents wherever they stand."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix))[1][start] + (end - start).astype(U64))


_STEP = random_words(64, 11)


def shingles(row: np.ndarray, hashes: np.ndarray, n_rows: int, k: int):
    """Shingles of ``k`` consecutive words: (row, fingerprint), rows ascending.

    A row of 1 to k-1 words has one shingle, the whole sequence; a row without words none.
    """
    total = len(hashes)
    if total >= k:
        value = np.zeros(total - k + 1, U64)
        for j in range(k):
            value += hashes[j : total - k + 1 + j] * _STEP[j]
        whole = row[: total - k + 1] == row[k - 1 :]
        out_row, out = row[: total - k + 1][whole], mix(value[whole])
    else:
        out_row, out = np.empty(0, np.int64), np.empty(0, U64)
    counts = np.bincount(row, minlength=n_rows)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        firsts = np.concatenate(([0], np.cumsum(counts)))[short]
        value = np.zeros(len(short), U64)
        for j in range(k - 1):
            on = counts[short] > j
            value[on] += hashes[firsts[on] + j] * _STEP[j]
        value = mix(value + counts[short].astype(U64))
        out_row, out = np.concatenate((out_row, short)), np.concatenate((out, value))
        order = np.argsort(out_row, kind="stable")
        out_row, out = out_row[order], out[order]
    return out_row, out

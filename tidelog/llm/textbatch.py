"""Words and shingles of whole Arrow batches as 64-bit hashes, by numpy on the text's bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
U = np.uint64

_random = np.random.default_rng(20_240_601)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = U(0x9E3779B97F4A7C15)
_BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACE = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * U(2) + U(1)
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x + U((salt * 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(base: U, n: int) -> np.ndarray:
    """base**0 .. base**n, kept for chunks of usual size."""
    key = str(base)
    have = _powers.get(key)
    if have is None or len(have) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * CHUNK_BYTES:
            _powers[key] = have
    return have[: n + 1]


def chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets in them) of consecutive rows of about CHUNK_BYTES, or of one longer row.

    Null is like empty.
    """
    flat = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = flat.buffers()
    at = np.frombuffer(offsets, np.int64)[flat.offset: flat.offset + len(flat) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    row = 0
    while row < len(flat):
        end = max(row + 1, int(np.searchsorted(at, at[row] + CHUNK_BYTES, "right")) - 1)
        end = min(end, len(flat))
        yield row, raw[at[row]: at[end]], at[row: end + 1] - at[row]
        row = end


def words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each word, in text order. Words are runs without ASCII white space, A-Z in lower case."""
    if not len(raw):
        return np.empty(0, U), np.empty(0, np.int64)
    inside = ~_SPACE[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(raw))]  # a row's end ends its last word
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    total = np.zeros(len(raw) + 1, U)
    np.cumsum(_BYTE[raw] * _power(_BASE, len(raw))[:-1], out=total[1:])
    value = (total[ends] - total[starts]) * _power(_BASE_INVERSE, len(raw))[starts]
    return mixed(value), np.searchsorted(at, starts, "right") - 1


def shingles(raw: np.ndarray, at: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each row's distinct shingles of width words, in order of row and hash.

    A row of fewer words has one shingle, its whole sequence; a row without words has none.
    """
    h, row = words(raw, at)
    n = np.bincount(row, minlength=len(at) - 1)
    parts, rows = [], []
    if len(h) >= width:
        whole = row[width - 1:] == row[: len(row) - width + 1]
        total = np.zeros(len(h) - width + 1, U)
        for k in range(width):
            total += h[k: len(h) - width + 1 + k] * _PLACE[k]
        parts.append(mixed(total[whole], width))
        rows.append(row[: len(whole)][whole])
    begin = np.cumsum(n) - n
    for size in range(1, width):
        short = np.flatnonzero(n == size)
        if len(short):
            total = np.zeros(len(short), U)
            for k in range(size):
                total += h[begin[short] + k] * _PLACE[k]
            parts.append(mixed(total, size))
            rows.append(short)
    if not parts:
        return np.empty(0, U), np.empty(0, np.int64)
    s, r = np.concatenate(parts), np.concatenate(rows)
    order = np.lexsort((s, r))
    s, r = s[order], r[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (r[1:] != r[:-1])
    return s[new], r[new]

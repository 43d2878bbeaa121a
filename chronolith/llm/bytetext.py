"""Words, lines and n-grams of whole Arrow text columns, worked out on their UTF-8 bytes with numpy.

A batch is cut at row ends into slices of about ``LIMIT`` bytes (a longer text is a slice of its own), so
memory follows the longest single text, not the batch. Hashes are 64-bit and the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LIMIT = 1 << 21
U = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Separates runs of ASCII letters, digits and non-ASCII characters.
NOT_ALNUM = np.array([not (chr(b).isalnum() or b >= 128) for b in range(128)] + [False] * 128)
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True
#: Bytes that begin a code point.
LEADS = np.array([b & 0xC0 != 0x80 for b in range(256)])

_P = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.Generator(np.random.PCG64(20240101)).integers(1, 2**64, 256, dtype=np.uint64)
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]
_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        n = max(n, LIMIT + 1024)
        for name, base in (("_pow", _P), ("_inv", pow(_P, -1, 2**64))):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            globals()[name] = np.multiply.accumulate(x)
    return _pow, _inv


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; works on a copy."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as doubles strictly between 0 and 1."""
    return ((x >> U(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def slices(column: pa.Array, limit: int = LIMIT) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of the rows in them); null texts are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(off, off[row] + limit, "right")) - 1)
        yield row, end, data[off[row] : off[end]], off[row : end + 1] - off[row]
        row = end


def spans(data: np.ndarray, off: np.ndarray, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of bytes that ``sep`` doesn't hold; runs end at row ends."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~sep[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    bounds = off[(off > 0) & (off < n)]
    first[bounds] = inside[bounds]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[bounds - 1] = inside[bounds - 1]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each span's bytes (``lower``: of A-Z as a-z), the same wherever the span stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    p, inv = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER if lower else _TABLE)[data] * p[: len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * inv[starts]
    return mix(h + (ends - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def grams(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive spans, and whether these are of one row; k - 1 fewer than spans."""
    n = max(0, len(h) - k + 1)
    g = np.zeros(n, np.uint64)
    for j in range(k):
        g += h[j : j + n]
        g *= U(0x9FB21C651E98DF25)
        g ^= g >> U(29)
    return mix(g), row[:n] == row[k - 1 : k - 1 + n] if n else np.zeros(0, bool)


def runs(row: np.ndarray, n_rows: int) -> np.ndarray:
    """Offsets of each row's spans among all spans."""
    return np.searchsorted(row, np.arange(n_rows + 1))

"""Word positions and hashes of many texts at once, as NumPy arrays.

A block is the concatenated UTF-8 bytes of some rows.  Words are maximal runs
of bytes that a 256-entry table marks; all bytes above 0x7F belong to
multi-byte code points, so a table over ASCII classifies code points too.
Everything is computed with array operations over the bytes of the block;
memory follows ``BLOCK_BYTES`` (or one text, if that is longer).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20

_U = np.uint64


def byte_table(word_bytes) -> np.ndarray:
    """Boolean table of the bytes that belong to words."""
    t = np.zeros(256, dtype=bool)
    t[list(word_bytes)] = True
    return t


# ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` on text with A-Z lower-cased, and
# ``[^\x20\x09-\x0D]+``
ALNUM_BYTES = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
NON_SPACE_BYTES = [b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D]


def lower_table() -> np.ndarray:
    """Byte map that lower-cases A-Z."""
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B] += 32
    return t


def mix64(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift multiply): every input bit reaches every
    output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_values() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


_BASES = (0x5851F42D4C957F2D, 0xD1342543DE82EF95)


def _powers(n: int, base: int = 0) -> np.ndarray:
    p = np.full(n, _BASES[base], dtype=np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def text_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES):
    """Yield ``(first row, row count, bytes, row offsets)`` of a string column
    cut at row borders into blocks of about ``block_bytes``; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    col = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(col)
    if not n:
        return
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset: col.offset + n + 1]
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if col.buffers()[2] else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + block_bytes, side="right")) - 1)
        b = min(b, n)
        yield a, b - a, data[off[a]: off[b]], off[a: b + 1] - off[a]
        a = b


def span_hashes(data: np.ndarray, start: np.ndarray, base: int = 0) -> np.ndarray:
    """64-bit hash of each of the spans that begin at ``start`` and together
    cover the bytes; ``base``: one of two independent hashes."""
    size = np.diff(np.append(start, len(data)))
    at = np.arange(len(data), dtype=np.int32) - np.repeat(start, size).astype(np.int32)
    v = _byte_values()[data] * _powers(int(size.max()), base)[at]
    return mix64(np.add.reduceat(v, start) + size.astype(np.uint64))


class Words:
    """Words of one block: byte ``start`` and ``end`` (exclusive), the first
    word index of every row in ``row_start`` (length rows + 1)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        m = table[data]
        before, after = np.empty_like(m), np.empty_like(m)
        if len(m):
            before[1:], before[0] = m[:-1], False
            after[:-1], after[-1] = m[1:], False
            inner = offsets[1:-1]
            inner = inner[(inner > 0) & (inner < len(m))]
            before[inner] = False
            after[inner - 1] = False
        self.data = data
        self.start = np.flatnonzero(m & ~before)
        self.end = np.flatnonzero(m & ~after) + 1
        self.row_start = np.searchsorted(self.start, offsets)
        self._bytes = data[m]

    def __len__(self):
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word."""
        if not len(self):
            return np.zeros(0, np.uint64)
        size = self.end - self.start
        first = np.cumsum(size) - size
        at = np.arange(len(self._bytes), dtype=np.int64) - np.repeat(first, size)
        v = _byte_values()[self._bytes] * _powers(int(size.max()))[at]
        return mix64(np.add.reduceat(v, first) + size.astype(np.uint64))


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` consecutive words starting at each position (shorter
    by ``k - 1`` than the input; rows are not looked at)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * _U(0x9FB21C651E98DF25) + words[j: j + n]
    return mix64(h ^ _U(k))


def inside_rows(row_start: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of the ``n`` window positions of ``k`` words lie in one row."""
    ok = np.ones(n, dtype=bool)
    for j in range(1, k):  # a window starting j words before a row's first word crosses into it
        p = row_start[1:-1] - j
        ok[p[(p >= 0) & (p < n)]] = False
    return ok

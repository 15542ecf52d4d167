"""Vectorised word and shingle hashing shared by the text operators of this subpackage.

Everything works on raw UTF-8 bytes with NumPy: one pass marks the words of a
whole Arrow batch, one wrapped cumulative sum hashes all of them, and windows
of words are hashed from the word hashes. Words are maximal runs of bytes
outside the six ASCII white-space characters (0x20, 0x09-0x0D).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Lower case, and every ASCII character that is neither letter nor digit becomes a space.
_ALNUM = _LOWER.copy()
_ALNUM[[i for i in range(128) if not chr(i).isalnum()]] = 0x20
#: Bytes whose words are hashed at a time.
_STRETCH = 1 << 17
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("up", _PRIME), ("down", _INVERSE)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return off, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def slices(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most so many bytes each (a longer text stands alone)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


class Words:
    """The words of rows ``i`` to ``j``: their bounds in ``data`` and the row of each."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, i: int, j: int, fold: np.ndarray | None = _LOWER):
        base = int(offsets[i])
        raw = data[base : int(offsets[j])]
        self.data = raw if fold is None else fold[raw]
        at = (offsets[i : j + 1] - base).astype(np.int64)
        n = len(raw)
        inside = ~_SPACE[self.data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[at] = True
        before = np.zeros(n, dtype=bool)
        if n:
            before[1:] = inside[:-1]
            self.start = np.flatnonzero(inside & (~before | edge[:-1]))
            after = np.zeros(n, dtype=bool)
            after[:-1] = inside[1:]
            self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        else:
            self.start = self.end = np.zeros(0, dtype=np.int64)
        #: words of row k are first[k] to first[k + 1]
        self.first = np.searchsorted(self.start, at, side="left")
        self.rows = j - i
        self.at = at

    def hashes(self) -> np.ndarray:
        """A hash of each word, whatever the words around it; made a stretch of words at a time, so that the sums stay small."""
        out, i = np.zeros(len(self.start), dtype=np.uint64), 0
        while i < len(out):
            base = int(self.start[i])
            j = max(i + 1, int(np.searchsorted(self.end, base + _STRETCH, side="right")))
            start, end = self.start[i:j] - base, self.end[i:j] - base
            n = int(end[-1])
            up, down = _power_tables(n + 1)
            total = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum((self.data[base : base + n].astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
            out[i:j] = mix((total[end] - total[start]) * down[start])
            i = j
        return out


_STEP = np.uint64(0xBF58476D1CE4E5B9)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` neighbouring words, by the position of the first."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.full(n, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        h = h * _STEP + words[k : k + n]
    return mix(h)


def shingle_lists(words: Words, size: int) -> Iterator[np.ndarray]:
    """For each row the hashes of its shingles in order, with repeats.

    A row of fewer than ``size`` words has its whole sequence as its one
    shingle; a row without words has none.
    """
    h = words.hashes()
    windows = window_hashes(h, size)
    for k in range(words.rows):
        a, b = int(words.first[k]), int(words.first[k + 1])
        if b - a >= size:
            yield windows[a : b - size + 1]
        else:
            yield window_hashes(h[a:b], b - a) if b > a else h[:0]

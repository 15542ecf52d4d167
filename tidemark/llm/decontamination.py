"""Benchmark decontamination by fingerprints of item-sized windows.

For every number of words that a benchmark item has, each window of so many
words in a document is a candidate. A window gets a 64-bit SimHash of its
five-word shingles, weighted by how often they occur. Multi-index Hamming
blocks find the items near it: with ``BLOCKS`` blocks, two fingerprints within
``RADIUS`` bits differ by at most ``RADIUS // BLOCKS`` bits in some block, so
the inverted lists of all block values within that many bits of the window's hold
every item within the radius. Each candidate is then verified by its exact
weighted Jaccard similarity: the sum of the smaller counts over the sum of the
larger counts of the shingles.

The similarity of a window is bounded by the number of its shingles that any
item has, so only windows with enough of those are fingerprinted; the bound is
exact and leaves nothing out that could reach the threshold.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._hashing import _ALNUM, Words, mix, slices, text_buffers, window_hashes

SIZE = 5
THRESHOLD = 0.8
RADIUS = 20
BLOCKS = 7
#: Items in one broadcast index; a larger benchmark is searched for in several passes.
ITEMS_A_PASS = 20_000
_CELL = 1 << 20


def _bits(h: np.ndarray) -> np.ndarray:
    """One row of 64 times plus or minus one for each hash."""
    return np.unpackbits(mix(h).view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1).view(np.uint64).ravel()


_EDGES = [64 * k // BLOCKS for k in range(BLOCKS + 1)]


def _block(prints: np.ndarray, k: int) -> np.ndarray:
    return ((prints >> np.uint64(_EDGES[k])) & np.uint64((1 << (_EDGES[k + 1] - _EDGES[k])) - 1)).astype(np.int64)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


#: Differences within a block that leave it near: all patterns of RADIUS // BLOCKS bits at most, as (block width) -> values.
_NEAR = {w: np.array([x for x in range(1 << w) if x.bit_count() <= RADIUS // BLOCKS], dtype=np.int64) for w in {_EDGES[k + 1] - _EDGES[k] for k in range(BLOCKS)}}
#: Windows that are fingerprinted at a time, and pairs of a window and an item that are compared at a time.
_WINDOWS, _PAIRS = 1 << 12, 1 << 18


class Items:
    """The items of one number of words: their fingerprints, an inverted index of those by block, and their shingles with counts."""

    def __init__(self, ids: list[int], shingles: list[np.ndarray]):
        self.ids = ids
        own = [np.unique(s, return_counts=True) for s in shingles]
        self.shingles, self.counts = np.concatenate([u for u, _ in own]), np.concatenate([c for _, c in own])
        self.first = np.cumsum([0, *(len(u) for u, _ in own)])
        self.prints = np.concatenate([_pack(_bits(s).sum(axis=0, keepdims=True)) for s in shingles])
        #: by block: the items in the order of their value, and where each value begins
        self.lists = []
        for k in range(BLOCKS):
            value = _block(self.prints, k)
            self.lists.append((np.argsort(value, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(value, minlength=1 << (_EDGES[k + 1] - _EDGES[k])))])))

    def near(self, window: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of a window and an item within the radius, by the lists of each block; each pair once."""
        step = max(1, _PAIRS // max(1, len(self.ids)))
        for at in range(0, len(window), step):
            part, found = window[at : at + step], [np.zeros(0, np.int64)]
            for k, (order, first) in enumerate(self.lists):
                values = (_block(part, k)[:, None] ^ _NEAR[_EDGES[k + 1] - _EDGES[k]][None]).ravel()
                n = first[values + 1] - first[values]
                # the places of all listed items, one list after the other
                place = np.repeat(first[values] - np.cumsum(n) + n, n) + np.arange(n.sum())
                w = np.repeat(np.arange(len(values)) // (len(values) // len(part)), n)
                item = order[place]
                close = _distance(part[w], self.prints[item]) <= RADIUS
                found.append(w[close] * len(self.ids) + item[close])
            pairs = np.unique(np.concatenate(found))
            yield pairs // len(self.ids) + at, pairs % len(self.ids)

    def shared(self, item: int, here: np.ndarray) -> int:
        """The sum of the smaller counts of the item's shingles and of those in ``here``."""
        own = slice(self.first[item], self.first[item + 1])
        known, times = self.shingles[own], self.counts[own]
        place = np.minimum(np.searchsorted(known, here), len(known) - 1)
        met = np.bincount(place[known[place] == here], minlength=len(known))
        return int(np.minimum(met, times).sum())


class Index:
    """The items of a benchmark by their number of words, and all their shingles."""

    def __init__(self, item_ids: list[int], texts: list[str | None]):
        offsets, data = text_buffers(pc.utf8_lower(pa.array(texts, pa.large_string())))
        words = Words(offsets, data, 0, len(texts), fold=_ALNUM)
        h = words.hashes()
        by_size: dict[int, tuple[list[int], list[np.ndarray]]] = {}
        for k, item in enumerate(item_ids):
            own = h[words.first[k] : words.first[k + 1]]
            if len(own) and item is not None:
                ids, shingles = by_size.setdefault(len(own), ([], []))
                ids.append(item)
                shingles.append(window_hashes(own, min(SIZE, len(own))))
        self.items = {n: Items(*x) for n, x in by_size.items()}
        self.sizes = sorted(self.items)
        self.known = np.unique(np.concatenate([np.zeros(0, np.uint64), *(x.shingles for x in self.items.values())]))
        self.cells = np.zeros(_CELL, dtype=bool)
        self.cells[(self.known >> np.uint64(44)).astype(np.int64)] = True

    def has(self, h: np.ndarray) -> np.ndarray:
        """Positions of the hashes that are a shingle of some item."""
        maybe = np.flatnonzero(self.cells[(h >> np.uint64(44)).astype(np.int64)])
        if not len(maybe) or not len(self.known):
            return maybe[:0]
        place = np.minimum(np.searchsorted(self.known, h[maybe]), len(self.known) - 1)
        return maybe[self.known[place] == h[maybe]]

    def _windows(self, words: np.ndarray, n: int, size: int, at: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
        """Shingles of a stretch, a window's number of them, and the windows' first places in the stretch and in the text, for windows that could reach the threshold."""
        width = min(n, len(words)) - size + 1
        if width < THRESHOLD * (n - size + 1) - 1e-9:
            return
        need = THRESHOLD / (1 + THRESHOLD) * (width + n - size + 1) - 1e-9
        known = np.zeros(len(words) - size + 2, dtype=np.int64)
        known[at + 1] = 1
        known = np.cumsum(known)
        starts = np.flatnonzero(known[width:] - known[:-width] >= need)
        for part in np.split(starts, np.flatnonzero(np.diff(starts) > 4 * width) + 1) if len(starts) else []:
            for k in range(0, len(part), _WINDOWS):
                some = part[k : k + _WINDOWS]
                a, b = int(some[0]), int(some[-1]) + width
                yield window_hashes(words[a : b + size - 1], size), width, some - a, some

    def matches(self, words: np.ndarray, hits: dict[int, np.ndarray], short: bool) -> Iterator[tuple[int, int, int, int]]:
        """For the words of one document and the hit positions by shingle size: item, overlap, union and first word of each verified window.

        With ``short``, a document of fewer words than the item is its one window.
        """
        for n in self.sizes:
            size = min(SIZE, n)
            if size not in hits or (len(words) < n and not short):
                continue
            items = self.items[n]
            for s, width, begin, first in self._windows(words, n, size, hits[size]):
                total = np.zeros((len(s) + 1, 64), dtype=np.int32)
                np.cumsum(_bits(s), axis=0, out=total[1:])
                for w, item in items.near(_pack(total[begin + width] - total[begin])):
                    for x, y in zip(w.tolist(), item.tolist(), strict=True):
                        shared = items.shared(y, s[begin[x] : begin[x] + width])
                        union = width + n - size + 1 - shared
                        if shared >= THRESHOLD * union - 1e-9:
                            yield items.ids[y], shared, union, int(first[x])


@functools.lru_cache(maxsize=1)
def _index(shared) -> Index:
    """The index of the broadcast items, made once by each worker."""
    return Index(*shared.value)


def _scan(shared, short: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(shared)
        sizes = sorted({min(SIZE, n) for n in index.sizes})
        for batch in batches:
            lowered = pc.utf8_lower(batch.column("text"))
            offsets, data = text_buffers(lowered)
            ids = batch.column("doc_id").to_pylist()
            rows: list[tuple] = []
            for i, j in slices(offsets):
                words = Words(offsets, data, i, j, fold=_ALNUM)
                h = words.hashes()
                by_doc: dict[int, dict[int, np.ndarray]] = {}
                for size in sizes:
                    at = index.has(window_hashes(h, size))
                    owner = np.searchsorted(words.first, at, side="right") - 1
                    inside = at + size <= words.first[owner + 1]
                    at, owner = at[inside], owner[inside]
                    for d in np.unique(owner).tolist():
                        by_doc.setdefault(d, {})[size] = at[owner == d] - words.first[d]
                for d, hits in by_doc.items():
                    best: dict[int, tuple] = {}
                    for item, overlap, union, first in index.matches(h[words.first[d] : words.first[d + 1]], hits, short):
                        new = (overlap / union, -first, overlap, union)
                        best[item] = max(best.get(item, new), new)
                    rows += [(ids[i + d], item, o, u, -f) for item, (_, f, o, u) in best.items()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "overlap", "union_size", "first_word"])

    return run


def contaminated(documents: DataFrame, benchmark: DataFrame, items_a_pass: int = ITEMS_A_PASS, short: bool = False) -> DataFrame:
    """The documents that hold a passage of the benchmark, with the item.

    Reads ``doc_id, text`` and ``item_id, text``; further columns are not read.
    Returns one row for each document row and item that has a window of the
    item's number of words with a weighted shingle similarity of at least 0.8:
    ``doc_id, item_id, similarity`` of its best window, that window's ``overlap``
    and ``union_size`` in shingles, and ``first_word``, the place of the first
    best window, from 0. Words are maximal runs of letters and digits, lower-cased;
    ASCII punctuation separates them.

    With ``short``, a document of fewer words than the item is compared as a whole,
    its only window; without, it does not match.

    A similar window is found if its fingerprint is within ``RADIUS`` of the item's. At a
    similarity of 0.8 fingerprints differ by 10 bits in the mean with a deviation of 3,
    so about one such window in two thousand is further away; those more similar are nearer.

    Null, empty or wordless documents and items match nothing; an item of fewer
    than five words is one shingle. Repeated document rows give their rows again;
    an item_id that repeats gives a row for each of its texts that matches, a null
    item_id none. An empty table on either side gives an empty result. What is
    broadcast is the texts of ``items_a_pass`` items at most; more are searched for
    in further passes over the documents. A document is compared a few thousand windows at a time.
    """
    spark = documents.sparkSession
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null")
    schema = "doc_id long, item_id long, overlap long, union_size long, first_word long"
    parts = max(1, -(-items.count() // items_a_pass))
    found = []
    for k in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).collect()
        own.sort(key=lambda r: (r.item_id, r.text or ""))
        found.append(documents.mapInArrow(_scan(spark.sparkContext.broadcast(([r.item_id for r in own], [r.text for r in own])), short), schema))
    return reduce(DataFrame.union, found).select("doc_id", "item_id", (F.col("overlap") / F.col("union_size")).alias("similarity"), "overlap", "union_size", "first_word")

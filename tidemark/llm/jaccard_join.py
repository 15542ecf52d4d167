"""N-gram Jaccard join: T-occurrence search over inverted lists of word shingles.

Two documents whose shingle sets have a Jaccard similarity of at least
``threshold`` share at least ``T = ceil(threshold * n)`` of the ``n`` shingles
of either. As in DivideSkip, the inverted lists of a document are divided: its
``T - 1`` longest lists are set aside and only the ``n - T + 1`` shortest are
merged, since every partner occurs on at least one of those. Spark's
sort-merge join plays the part of the heap that merges the short lists; the
long lists are then probed by binary search, in the sorted shingle arrays of
the candidates, until the required overlap is met or out of reach.

How it stays linear when copies are many:

* documents with the same shingle set form one class, found by a 64-bit digest
  of the set (``k`` classes collide with probability ``k ** 2 / 2 ** 65``), and
  only classes are joined;
* lists are ordered by a frequency class from a count sketch over all
  documents, so passages that many documents share are on the lists set aside.
  The order is a function of the shingle alone, hence the search is exact
  whatever the sketch says; the sketch grows with the text up to a fixed size and only saves work;
* within a short list every class is first compared with one pivot (the class
  with the fewest rare shingles, which in a group of edited copies is the
  original). Only pairs that these links leave in different components are
  compared afterwards, so a large group costs links in proportion to its size. They
  meet by list and class of length, as sets of very different sizes cannot be linked.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._hashing import Words, mix, shingle_lists, slices, text_buffers
from ._store import materialise
from .components import components

#: The sketch has a cell for so many words, and two to the power of this many at least and at most.
_WORDS_A_CELL, LEAST_SKETCH_BITS, MOST_SKETCH_BITS = 32, 16, 26
#: A table of ids is broadcast only if it has been counted and has so many rows at most.
BROADCAST_ROWS = 1_000_000
#: The bitmap of shared keys has two to the power of this many bits at most.
MOST_BITS = 28
_CHUNK = 1 << 16
_CELLS = 256
_PAD = np.zeros(0, np.uint64)


def required(n: np.ndarray | int, threshold: float):
    """The least overlap of a set of ``n`` with any partner."""
    return np.ceil(n * threshold - 1e-9).astype(np.int64) if isinstance(n, np.ndarray) else math.ceil(n * threshold - 1e-9)


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    offsets, data = text_buffers(batch.column("text"))
    for i, j in slices(offsets):
        for shingles in shingle_lists(Words(offsets, data, i, j), size):
            yield np.unique(shingles)


def _digest(shingles: np.ndarray) -> int:
    """A 64-bit digest of a set, signed; 0 for the empty set alone."""
    if not len(shingles):
        return 0
    total = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(keepdims=True)
    parity = np.bitwise_xor.reduce(mix(shingles * np.uint64(3)), keepdims=True)
    return int(mix(total ^ (parity * np.uint64(31))).view(np.int64)[0]) or 1


def _profile(shingles: np.ndarray) -> bytes:
    """How many shingles fall into each of 256 cells, at most 255 each.

    The sum of the cells' differences is at most the size of the symmetric difference.
    """
    return np.minimum(np.bincount((shingles & np.uint64(_CELLS - 1)).astype(np.int64), minlength=_CELLS), 255).astype(np.uint8).tobytes()


_PER_DOCUMENT = "doc_id long, n long, cls long, profile binary, chunk int, counts binary"


def _sketch_bits(documents: DataFrame) -> int:
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(LEAST_SKETCH_BITS, min(MOST_SKETCH_BITS, (size // 6 // _WORDS_A_CELL).bit_length()))


def _summarise(size: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << bits, np.uint32)
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("profile", pa.binary()), ("chunk", pa.int32()), ("counts", pa.binary())])
        seen: set[int] = set()
        for batch in batches:
            n, cls, profile = [], [], []
            for s in _sets(batch, size):
                d = _digest(s)
                n.append(len(s))
                cls.append(d)
                first = d not in seen and len(s) > 0
                profile.append(_profile(s) if first else None)
                if first:
                    seen.add(d)
                    np.add.at(sketch, (s >> np.uint64(64 - bits)).astype(np.int64), 1)
            rows = len(n)
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(profile, pa.binary()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], schema=schema)
        chunks = [(k, sketch[k * _CHUNK : (k + 1) * _CHUNK]) for k in range(len(sketch) // _CHUNK)]
        chunks = [(k, zlib.compress(c.tobytes(), 1)) for k, c in chunks if c.any()]
        m = len(chunks)
        yield pa.record_batch([pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.array([k for k, _ in chunks], pa.int32()), pa.array([c for _, c in chunks], pa.binary())], schema=schema)

    return run


def _add_chunks(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_CHUNK, np.uint64)
    for batch in batches:
        for counts in batch.column("counts"):
            total += np.frombuffer(zlib.decompress(counts.as_py()), np.uint32)
    yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([zlib.compress(np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes(), 1)], pa.binary())], names=["chunk", "counts"])


def _frequency_classes(summary: DataFrame, bits: int) -> np.ndarray:
    """A class for each cell of the sketch: 0 for the common run, more for cells far above the mean.

    The sketch has a bounded number of cells, and so has what reaches the driver.
    """
    added = summary.where("chunk is not null").select("chunk", "counts").groupBy("chunk").applyInArrow(_add_chunks, "chunk int, counts binary")
    cells = np.zeros(1 << bits, np.uint32)
    for row in added.toLocalIterator():
        cells[row.chunk * _CHUNK : (row.chunk + 1) * _CHUNK] = np.frombuffer(zlib.decompress(row.counts), np.uint32)
    usual = 8 + cells.mean() + 4 * np.sqrt(cells.mean())
    classes = np.zeros(1 << bits, np.uint8)
    often = np.flatnonzero(cells >= usual)
    classes[often] = 1 + np.floor(np.log2(cells[often] / usual))
    return classes


def _ordered(shingles: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, float]:
    """Keys of the shingles, rarest class first, and the share of rare ones."""
    c = classes[(shingles >> np.uint64(65 - len(classes).bit_length())).astype(np.int64)]
    return np.sort((c.astype(np.uint64) << np.uint64(56)) | (shingles >> np.uint64(8))), float((c == 0).mean())


def _short_lists(size: int, threshold: float, classes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_cell, seen = classes.value, set()
        for batch in batches:
            keys, cls, rare, at = [], [], [], [_PAD.astype(np.int32)]
            for s in _sets(batch, size):
                d = _digest(s)
                if not len(s) or d in seen:
                    continue
                seen.add(d)
                key, share = _ordered(s, by_cell)
                keys.append(key[: len(s) - required(len(s), threshold) + 1])
                cls.append(d)
                rare.append(share)
                at.append(np.arange(len(keys[-1]), dtype=np.int32))
            lengths = [len(k) for k in keys]
            joined = np.concatenate(keys) if keys else _PAD
            yield pa.record_batch([pa.array(joined.view(np.int64)), pa.array(np.repeat(np.array(cls, np.int64), lengths)), pa.array(np.repeat(np.array(rare, np.float32), lengths)), pa.array(np.concatenate(at))], names=["key", "cls", "rare", "at"])

    return run


def _mark_bits(bits: int):
    """A task's bitmap of the keys it sees, in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.zeros(1 << (bits - 3), np.uint8)
        for batch in batches:
            cell = _cell(batch.column("key"), bits)
            np.bitwise_or.at(packed, cell >> 3, (128 >> (cell & 7)).astype(np.uint8))
        chunks = [(k, packed[k * _CHUNK : (k + 1) * _CHUNK]) for k in range(-(-len(packed) // _CHUNK))]
        chunks = [(k, zlib.compress(c.tobytes(), 1)) for k, c in chunks if c.any()]
        yield pa.record_batch([pa.array([k for k, _ in chunks], pa.int32()), pa.array([c for _, c in chunks], pa.binary())], names=["chunk", "counts"])

    return run


def _cell(keys: pa.Array, bits: int) -> np.ndarray:
    return (mix(keys.to_numpy().view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _either(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for counts in batch.column("counts"):
            own = np.frombuffer(zlib.decompress(counts.as_py()), np.uint8)
            total = own if total is None else total | own
    yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["chunk", "counts"])


def _sieve(lists: DataFrame, shared: DataFrame) -> DataFrame:
    """The postings of ``lists`` whose key may be in ``shared``, by a broadcast bitmap of bounded size.

    It spares a shuffle of all postings; keys that pass by chance go in the exact join that follows.
    """
    bits = min(MOST_BITS, max(16, (16 * shared.count()).bit_length()))
    there = np.zeros(1 << (bits - 3), np.uint8)
    for row in shared.mapInArrow(_mark_bits(bits), "chunk int, counts binary").groupBy("chunk").applyInArrow(_either, "chunk int, counts binary").toLocalIterator():
        own = np.frombuffer(zlib.decompress(row.counts), np.uint8)
        there[row.chunk * _CHUNK : row.chunk * _CHUNK + len(own)] = own
    bitmap = lists.sparkSession.sparkContext.broadcast(there)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = bitmap.value
        for batch in batches:
            cell = _cell(batch.column("key"), bits)
            yield batch.filter(pa.array((marks[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1))

    return lists.mapInArrow(run, lists.schema)


def _class_sets(size: int):
    """The sorted shingles of each document of the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, sets = [], []
            for s in _sets(batch, size):
                cls.append(_digest(s))
                sets.append(s.tobytes())
            yield pa.record_batch([pa.array(cls, pa.int64()), pa.array(sets, pa.large_binary())], names=["cls", "shingles"])

    return run


def _far_apart(threshold: float):
    """Keeps pairs whose profiles do not rule the threshold out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = np.frombuffer(b"".join(batch.column("pa").to_pylist()), np.uint8).reshape(-1, _CELLS).astype(np.int16)
            b = np.frombuffer(b"".join(batch.column("pb").to_pylist()), np.uint8).reshape(-1, _CELLS).astype(np.int16)
            apart = np.abs(a - b).sum(axis=1)
            n = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            keep = apart * (1 + threshold) <= (1 - threshold) * n + 1e-6
            yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(keep))

    return run


def _probe(threshold: float):
    """Probes the candidate's shingles in the query's sorted array, a block at a time, while the required overlap is within reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, links = batch.column("a").to_pylist(), batch.column("b").to_pylist(), ([], [])
            for k in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[k].as_buffer(), np.uint64) for c in ("sa", "sb"))
                x, y = (x, y) if len(x) >= len(y) else (y, x)
                need, met = math.ceil(threshold / (1 + threshold) * (len(x) + len(y)) - 1e-9), 0
                for at in range(0, len(y), 256):
                    part = y[at : at + 256]
                    place = np.minimum(np.searchsorted(x, part), len(x) - 1)
                    met += int((x[place] == part).sum())
                    if met >= need or met + len(y) - at - len(part) < need:
                        break
                if met >= need:
                    links[0].append(a[k])
                    links[1].append(b[k])
            yield pa.record_batch([pa.array(links[0], pa.int64()), pa.array(links[1], pa.int64())], names=["a", "b"])

    return run


def _small(frame: DataFrame) -> DataFrame:
    """A written table of ids; broadcast where its counted size allows, else joined by shuffle."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


class _Verifier:
    def __init__(self, documents: DataFrame, members: DataFrame, size: int, threshold: float):
        self.documents, self.size, self.threshold = documents, size, threshold
        self.members = members

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b, na, nb`` that reach the threshold."""
        named = _small(materialise(pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct(), "named"))
        p = self.members.where("profile is not null").join(named, "cls").groupBy("cls").agg(F.first("profile").alias("profile"), F.min("doc_id").alias("doc_id"))
        p = materialise(p, "profiles")
        near = pairs.join(p.select(F.col("cls").alias("a"), F.col("profile").alias("pa")), "a").join(p.select(F.col("cls").alias("b"), F.col("profile").alias("pb")), "b")
        near = materialise(near.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(_far_apart(self.threshold), "a long, b long, na long, nb long"), "near")
        wanted = near.select(F.col("a").alias("cls")).union(near.select("b")).distinct()
        wanted = materialise(p.join(wanted, "cls").select("cls", "doc_id"), "wanted")
        texts = self.documents.join(_small(wanted.where("doc_id is not null").select("doc_id")), "doc_id").select("text")
        sets = texts.mapInArrow(_class_sets(self.size), "cls long, shingles binary")
        lost = wanted.where("doc_id is null").select("cls")
        if not lost.isEmpty():  # no id to fetch by: the class is found again among the rows without one
            nameless = self.documents.where("doc_id is null").select("text").mapInArrow(_class_sets(self.size), "cls long, shingles binary")
            sets = sets.union(nameless.join(_small(lost), "cls", "left_semi"))
        sets = materialise(sets.dropDuplicates(["cls"]), "sets")
        both = near.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb")), "b")
        return both.select("a", "b", "sa", "sb").mapInArrow(_probe(self.threshold), "a long, b long")


def _alike(threshold: float):
    """Whether two postings of one list can belong to a linked pair.

    Both sets are in one order, so if this is the first shingle they share, the
    overlap is at most this one and what follows it in the shorter rest. A linked
    pair passes on the list of its first shared shingle.
    """
    need = F.ceil((F.col("nx") + F.col("ny")) * F.lit(threshold / (1 + threshold)) - 1e-9)
    return (F.least("nx", "ny") >= F.greatest("nx", "ny") * F.lit(threshold) - 1e-9) & (F.least(F.col("nx") - F.col("ax"), F.col("ny") - F.col("ay")) >= need)


def _side(frame: DataFrame, name: str, *more: str) -> DataFrame:
    return frame.select("key", F.col("cls").alias(name), F.col("n").alias(f"n{name}"), F.col("at").alias(f"a{name}"), *more)


def _pairs(ok: DataFrame) -> DataFrame:
    """Distinct pairs ``a < b`` of columns ``x, nx, y, ny``."""
    return ok.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.when(F.col("x") < F.col("y"), F.col("nx")).otherwise(F.col("ny")).alias("na"), F.when(F.col("x") < F.col("y"), F.col("ny")).otherwise(F.col("nx")).alias("nb")).distinct()


def jaccard_components(documents: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """Groups documents linked by a shingle Jaccard similarity of at least ``threshold``.

    Takes ``doc_id, text`` and any further columns, which are not read. Returns
    one row for each input row: ``doc_id``, ``n_shingles`` (distinct shingles of
    ``size`` words, A-Z lower-cased) and ``component_id``, the smallest doc_id of
    the documents reachable by links, itself included.

    A text of fewer than ``size`` words has its whole sequence as one shingle. A
    null, empty or blank text has no shingle and links with nothing, so its
    component is itself. Rows that repeat a doc_id count as documents of their
    own. A row without doc_id keeps its count and has a null component unless a
    linked document has an id. An empty table gives an empty result.
    """
    spark = documents.sparkSession
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bits = _sketch_bits(documents)
    summary = materialise(documents.mapInArrow(_summarise(size, bits), _PER_DOCUMENT), "summary")
    members = summary.where("chunk is null").select("doc_id", "n", "cls", "profile")
    classes = spark.sparkContext.broadcast(_frequency_classes(summary, bits))
    lists = materialise(documents.select("text").mapInArrow(_short_lists(size, threshold, classes), "key long, cls long, rare float, at int"), "lists")
    shared = materialise(lists.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key"), "shared")
    sized = members.where("n > 0").groupBy("cls").agg(F.first("n").alias("n"))
    met = _sieve(lists, shared).join(shared, "key").groupBy("key", "cls").agg(F.first("rare").alias("rare"), F.first("at").alias("at"))
    met = materialise(met.join(sized, "cls").select("key", "cls", "n", "rare", "at"), "met")
    verifier = _Verifier(documents, members, size, threshold)

    pivots = met.groupBy("key").agg(F.min(F.struct("rare", "cls", "n", "at")).alias("p")).select("key", "p.cls", "p.n", "p.at")
    stars = materialise(_pairs(_side(met, "x").join(_side(pivots, "y"), "key").where("x <> y").where(_alike(threshold))), "stars")
    links = materialise(verifier.links(stars), "links")
    roots = components(links)

    placed = materialise(met.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select("key", "cls", "n", "at", F.coalesce("root", "cls").alias("root")), "placed")
    by_root = placed.groupBy("key", "root").agg(F.count("*").alias("k"))
    mixed = by_root.groupBy("key").agg(F.count("*").alias("roots"), F.max(F.struct("k", "root")).getField("root").alias("main")).where("roots > 1").select("key", "main")
    apart = placed.join(mixed, "key")
    # sets whose lengths are more than one class apart cannot be linked
    length = F.floor(F.log(F.col("n")) / -math.log(threshold)).cast("int") if threshold < 1 else F.col("n")
    minor = _side(apart.where("root <> main"), "x", F.col("root").alias("rx"), F.explode(F.array(length - 1, length, length + 1)).alias("length"))
    others = _side(apart, "y", F.col("root").alias("ry"), (F.col("root") == F.col("main")).alias("in_main"), length.alias("length"))
    crossing = minor.join(others, ["key", "length"]).where("rx <> ry and (in_main or x < y)").where(_alike(threshold))
    rest = _pairs(crossing).join(stars.select("a", "b"), ["a", "b"], "left_anti")
    links = links.union(verifier.links(rest))
    roots = components(links)

    first = members.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    grouped = first.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(least, "root").select("cls", "component_id")
    out = members.select("doc_id", F.col("n").alias("n_shingles"), "cls").join(named, "cls", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))

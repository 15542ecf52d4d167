"""Alignment of the tokens of two tokenizers, and how often their ids stand together.

Both encode a space and the text. Byte offsets at which a token of either ends cut the bytes
into groups. The character offsets that the one library gives and the spans of the other
one's proto are coarse cuts; a stretch where a character is split over several tokens, or spelled
out in byte tokens, is refined with the tokens' decoded bytes.

Texts are taken apart at places where both tokenizers have a boundary whatever stands around
(``_units``), and workers keep the tokens of units met of late, so each is encoded once.

Counts of id pairs over the corpus go through Spark: documents lie in batches of bounded
size; a batch sends each of its pairs once, with the number of its documents, to be added up,
and the totals return to the batches that asked.
"""

from __future__ import annotations

import functools
import gc
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ._hashing import slices, text_buffers
from ._store import Carried, materialise
from ._units import LATIN, MARKS, short_units, units
from .bpe import byte_characters
from .lm_scoring import pack_sparse, unpack_sparse

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
#: Bytes of text that a batch holds at least (or what its task has), and those that are worked on at a time.
BATCH_BYTES = 16 << 20
STRETCH = 1 << 20
#: Units after which a worker forgets those that it has not met since so many units before.
KEPT = 300_000
#: Links that are held at a time before equal ones are added up.
_LINKS = 1 << 20
_SPACE = "▁"


class Unit(NamedTuple):
    """A unit's figures: tokens, groups, links, groups as text, distinct linked id pairs (a * size of b + b) and how often each is linked, packed."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: str
    pairs: bytes
    copies: bytes


class Side(NamedTuple):
    """One tokenizer's tokens of several units in a row: ids, coarse bounds in bytes, sizes of the decoded bytes, unit of each."""

    ids: np.ndarray
    start: np.ndarray
    end: np.ndarray
    size: np.ndarray
    unit: np.ndarray


def refine(side: Side) -> np.ndarray:
    """The byte offset at which each token ends.

    Where a token's bytes fill its span, which begins where the one before ended, the span's end is right; other
    tokens (parts of one character, spelled-out bytes) end after their own bytes.
    """
    decoded = np.cumsum(side.size)
    fits = (side.end - side.start == side.size) & (side.start == decoded - side.size)
    return np.where(fits, side.end, decoded)


class Aligner:
    """Both tokenizers, and the units that were met of late."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism; a worker is forked
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        as_byte = byte_characters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, k in self.a.get_vocab().items():
            self.a_bytes[k] = bytes(as_byte[c] for c in token) if all(c in as_byte for c in token) else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any(re.search(rf"[^{_SPACE}]{_SPACE}|[ \n]", p) for p in pieces):
            raise ValueError("a piece goes over the end of a word")
        self.split = units if any(re.search(rf"[{LATIN}][{MARKS}]", p) for p in pieces) else short_units
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(_SPACE, " ").encode() for k, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in tokens], np.int64) for tokens in (self.a_bytes, self.b_bytes))
        self.names = [str(k) for k in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.space = self.b.piece_to_id(_SPACE)
        #: whether the proto counts bytes or, as other versions, characters
        self.in_bytes = self.b.encode("\u00e9", return_type="proto").pieces[-1].end == 2
        self.kept: dict[str, Unit | None] = {}
        self.older: dict[str, Unit | None] = {}

    def _a_side(self, named: list[str], first: np.ndarray, at: np.ndarray) -> Side:
        """Tokens with spans from the character offsets; ``at`` has the place in bytes of each character of all units, which begin at ``first``."""
        got = self.a.encode_batch(named, add_special_tokens=False)
        each = [x.ids for x in got]
        unit = np.repeat(np.arange(len(named)), [len(x) for x in each])
        ids = np.array(list(chain.from_iterable(each)), np.int64)
        span = np.array(list(chain.from_iterable(chain.from_iterable(x.offsets for x in got))), np.int64).reshape(-1, 2) + first[unit][:, None]
        return Side(ids, at[span[:, 0]], at[span[:, 1]], self.a_sizes[ids], unit)

    def _b_side(self, named: list[str], first: np.ndarray, at: np.ndarray) -> Side:
        """Tokens with spans from the protos. The model puts a space in front of what it is given; a unit that does not begin with one follows a line feed, which merges with nothing."""
        given = [u[1:] if u[0] == " " else "\n" + u for u in named]
        each = [[x for p in got.pieces for x in (p.id, p.begin, p.end)] for got in self.b.encode(given, return_type="proto", num_threads=1)]
        unit = np.repeat(np.arange(len(named)), [len(x) // 3 for x in each])
        flat = np.array(list(chain.from_iterable(each)), np.int64).reshape(-1, 3)
        place = np.arange(len(unit)) - np.searchsorted(unit, unit)
        spaced = np.array([u[0] == " " for u in named])[unit]
        if ((flat[:, 0] != self.space) | (flat[:, 2] > 0))[~spaced & (place == 0)].any():
            raise ValueError("a line feed does not stand alone")
        here = spaced | (place > 1)
        flat, unit, place, spaced = flat[here], unit[here], place[here], spaced[here]
        start, end = flat[:, 1] + np.where(spaced, place > 0, -1), flat[:, 2] + np.where(spaced, 1, -1)
        start, end = (at[first[unit]] + x if self.in_bytes else at[first[unit] + x] for x in (start, end))
        return Side(flat[:, 0], start, end, self.b_sizes[flat[:, 0]], unit)

    def _lost(self, side: Side, tokens: list[bytes], named: list[str], sizes: np.ndarray, joined: bytes) -> set[int]:
        """Units whose bytes are not those of their tokens."""
        if np.array_equal(np.bincount(side.unit, weights=side.size, minlength=len(named)), sizes) and b"".join(map(tokens.__getitem__, side.ids.tolist())) == joined:
            return set()
        edge = np.searchsorted(side.unit, np.arange(len(named) + 1)).tolist()
        ids = side.ids.tolist()
        return {n for n, u in enumerate(named) if b"".join([tokens[k] for k in ids[edge[n] : edge[n + 1]]]) != u.encode()}

    def align(self, named: list[str]) -> dict[str, Unit | None]:
        """Aligns units; null where the bytes of either side's tokens are not the unit's."""
        joined = "".join(named)
        code = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        at = np.concatenate([[0], np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))])
        begin = np.cumsum([0, *map(len, named)])
        a, b = self._a_side(named, begin, at), self._b_side(named, begin, at)
        in_bytes, raw = np.diff(at[begin]), joined.encode()
        lost = self._lost(a, self.a_bytes, named, in_bytes, raw) | self._lost(b, self.b_bytes, named, in_bytes, raw)
        if lost:
            left = [u for n, u in enumerate(named) if n not in lost]
            return {**(self.align(left) if left else {}), **{named[n]: None for n in lost}}
        a_end, b_end = refine(a), refine(b)
        cuts = np.intersect1d(a_end, b_end)  # each unit's end is one
        a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        in_a, in_b = np.bincount(a_group, minlength=len(cuts)), np.bincount(b_group, minlength=len(cuts))
        unit_of = np.zeros(len(cuts), np.int64)
        unit_of[a_group] = a.unit
        groups = np.bincount(unit_of, minlength=len(named))
        links = np.bincount(unit_of, weights=in_a * in_b, minlength=len(named)).astype(np.int64)
        parts = self._links(a, b, a_group, in_b, np.cumsum(in_b) - in_b)
        texts = self._texts(a, b, a_group, b_group, unit_of, len(named))
        n_a, n_b = np.bincount(a.unit, minlength=len(named)), np.bincount(b.unit, minlength=len(named))
        return {u: Unit(*x) for u, *x in zip(named, n_a.tolist(), n_b.tolist(), groups.tolist(), links.tolist(), texts, *parts, strict=True)}

    def _links(self, a: Side, b: Side, a_group: np.ndarray, in_b: np.ndarray, b_first: np.ndarray) -> tuple[list[bytes], list[bytes]]:
        """For each unit its distinct pairs and how often each is linked. Long groups are cut at tokens of the first side."""
        times = in_b[a_group]
        keys, copies, n_units = [], [], int(a.unit[-1]) + 1 if len(a.unit) else 0
        i = 0
        rows = []
        while i < len(times):
            j = max(i + 1, int(np.searchsorted(np.cumsum(times[i:]), _LINKS, side="right")) + i)
            t = times[i:j]
            other = np.repeat(b_first[a_group[i:j]] - (np.cumsum(t) - t), t) + np.arange(t.sum())
            pair = np.repeat(a.ids[i:j], t) * len(self.b_bytes) + b.ids[other]
            rows.append(_distinct(np.repeat(a.unit[i:j], t), pair, np.ones(len(pair), np.int64)))
            if len(rows) > 1:
                rows = [_distinct(*(np.concatenate(x) for x in zip(*rows, strict=True)))]
            i = j
        unit, pair, n = rows[0] if rows else (np.zeros(0, np.int64),) * 3
        edge = np.searchsorted(unit, np.arange(n_units + 1)).tolist()
        packed, many = pair.tobytes(), n.tobytes()
        for k in range(n_units):
            keys.append(packed[8 * edge[k] : 8 * edge[k + 1]])
            copies.append(many[8 * edge[k] : 8 * edge[k + 1]])
        return keys, copies

    def _texts(self, a: Side, b: Side, a_group: np.ndarray, b_group: np.ndarray, unit_of: np.ndarray, n: int) -> list[str]:
        """Each unit's groups as text: all tokens in the order of groups, the first side before the other, each with the mark behind it."""
        group, side = np.concatenate([a_group, b_group]), np.repeat([0, 1], [len(a_group), len(b_group)])
        order = np.lexsort((side, group))
        group, side = group[order], side[order]
        ids = np.concatenate([a.ids, b.ids])[order].tolist()
        same = group[1:] == group[:-1]
        mark = np.where(same & (side[1:] == side[:-1]), 0, np.where(same, 1, 2)).tolist() + [2]
        words = [self.names[k] + ",|;"[m] for k, m in zip(ids, mark, strict=True)]
        edge = np.searchsorted(unit_of[group], np.arange(n + 1)).tolist()
        return ["".join(words[edge[k] : edge[k + 1]])[:-1] for k in range(n)]

    def known(self, wanted: set[str]) -> dict[str, Unit | None]:
        kept, older, out, new = self.kept, self.older, {}, []
        for u in wanted:
            if u in kept:
                out[u] = kept[u]
            elif u in older:
                out[u] = kept[u] = older[u]
            else:
                new.append(u)
        i = 0
        while i < len(new):
            j, size = i, 0
            while j < len(new) and size < STRETCH // 4:
                size, j = size + len(new[j]), j + 1
            made = self.align(new[i:j])
            out.update(made)
            kept.update({u: x for u, x in made.items() if len(u) <= 64})
            i = j
        if len(kept) > KEPT:
            self.kept, self.older = {}, kept
        return out

    def texts(self, texts: list[str | None]) -> list[tuple]:
        """For each text the numbers of tokens, groups and links, the groups, and packed id pairs with how often they are linked."""
        split = [[u for u in self.split(" " + t) if u] if t else [] for t in texts]
        for us in split:
            if len(us) > 1 and us[-1] == " ":  # one space at the end belongs to no word of its own
                us[-2:] = [us[-2] + " "]
        known = self.known(set().union(*split))
        lost = {u for u, x in known.items() if x is None}
        if lost:
            split = [us if lost.isdisjoint(us) else [] for us in split]
        names = list(set().union(*split))
        rows, place = [known[u] for u in names], {u: k for k, u in enumerate(names)}
        sizes = np.array([len(r.pairs) // 8 for r in rows], np.int64)
        first = np.cumsum(sizes) - sizes
        all_keys = np.frombuffer(b"".join([r.pairs for r in rows]), np.int64)
        all_copies = np.frombuffer(b"".join([r.copies for r in rows]), np.int64)
        groups = [r.groups for r in rows]
        figures = np.array([r[:4] for r in rows], np.int64).reshape(-1, 4)
        out = []
        for us in split:
            if not us:
                out.append((0, 0, 0, 0, "", b"", b""))
                continue
            here = [*map(place.__getitem__, us)]
            at, times = np.unique(np.array(here, np.int64), return_counts=True)
            n = sizes[at]
            entry = np.repeat(first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            keys, where = np.unique(all_keys[entry], return_inverse=True)
            copies = np.bincount(where, weights=all_copies[entry] * np.repeat(times, n), minlength=len(keys)).astype(np.int64)
            out.append((*(times @ figures[at]).tolist(), ";".join(map(groups.__getitem__, here)), self.pack(keys), pack_sparse(copies - 1)))
        return out

    def pack(self, keys: np.ndarray) -> bytes:
        return keys.astype(key_type(len(self.a_bytes), len(self.b_bytes))).tobytes()


def key_type(a: int, b: int) -> str:
    """Id pairs take four bytes where the vocabularies allow it."""
    return "<u4" if a * b <= 1 << 32 else "<i8"


def _distinct(unit: np.ndarray, pair: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adds up equal rows, in order."""
    order = np.lexsort((pair, unit))
    unit, pair, n = unit[order], pair[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (unit[1:] != unit[:-1]) | (pair[1:] != pair[:-1])]))
    return unit[first], pair[first], np.add.reduceat(n, first)


@functools.lru_cache(2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """Both tokenizers, read once by each worker."""
    return Aligner(a_path, b_path)


@functools.lru_cache(2)
def sizes(a_path: str, b_path: str) -> tuple[int, int]:
    return Tokenizer.from_file(a_path).get_vocab_size(), sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


_ALIGNED = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups": pa.string(), "pairs": pa.binary(), "copies": pa.binary(), "batch": pa.int64()}
_ALIGNED_SCHEMA = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, copies binary, batch long"


def align_documents(documents: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH, carry: list[str] | None = None, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Aligns the tokens of every text.

    Returns the columns of ``carry`` (``doc_id`` unless told otherwise) with the numbers of tokens, groups and links,
    ``groups`` (``a1,a2|b1;a3|b2,b3``: ids in order), and for ``count_links`` the text's distinct linked id pairs
    and how often each is linked, packed, and the ``batch`` the row lies in. Each token of a group is linked with each
    one of the other side. A null or empty text, or one whose tokens' bytes on either side are not those of a space and
    the text, has no tokens: zeros and an empty string. Repeated rows are aligned one by one; an empty table gives an
    empty result. Both paths are read by every worker.
    """
    carried = Carried(documents, carry or ["doc_id"])
    name, inner = carried.text, carried.inner

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, number, size = aligner(a_path, b_path), TaskContext.get().partitionId() << 32, 0
        gc.freeze()  # nothing here goes in circles, and looking through the kept units takes long
        gc.disable()
        for batch in batches:
            offsets, _ = text_buffers(batch.column(name))
            for i, j in slices(offsets, STRETCH):
                part = batch.slice(i, j - i)
                rows = both.texts(part.column(name).to_pylist())
                made = [pa.array([r[k] for r in rows], t) for k, t in enumerate([*_ALIGNED.values()][:-1])]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in inner), *made, pa.array([number] * len(rows), pa.int64())], names=[*inner, *_ALIGNED])
                size += int(offsets[j] - offsets[i])
                if size >= batch_bytes:
                    number, size = number + 1, 0

    return carried.restore(carried.frame.mapInArrow(run, f"{carried.schema}, {_ALIGNED_SCHEMA}"))


def _ask(kind: str):
    """Each batch's distinct pairs, and how many of its documents have them; a batch that several tasks read comes in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(number: int, lists: list[np.ndarray]) -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(lists), return_counts=True)
            return pa.record_batch([pa.array(np.full(len(keys), number)), pa.array(keys.astype(np.int64)), pa.array(n)], names=["batch", "pair", "n"])

        now, lists, held = None, [], 0
        for batch in batches:
            for number, raw in zip(batch.column("batch").to_pylist(), batch.column("pairs").to_pylist(), strict=True):
                if lists and (number != now or held > 4_000_000):
                    yield told(now, lists)
                    lists, held = [], 0
                now = number
                if raw:
                    lists.append(np.frombuffer(raw, kind))
                    held += len(lists[-1])
        if lists:
            yield told(now, lists)

    return run


def _add(kind: str, inner: list[str]):
    """The sums of each document of a batch over its links, from the totals that came back."""

    def run(key: tuple, documents: pa.Table, totals: pa.Table) -> pa.Table:
        known = totals.column("pair").to_numpy()
        order = np.argsort(known, kind="stable")
        known, n, best = known[order], totals.column("total").to_numpy()[order], totals.column("best").to_numpy()[order]
        n_best, count_sum = [], []
        for raw, packed in zip(documents.column("pairs").to_pylist(), documents.column("copies").to_pylist(), strict=True):
            keys = np.frombuffer(raw, kind)
            copies, at = unpack_sparse(packed, len(keys)) + 1, np.searchsorted(known, keys.astype(np.int64))
            n_best.append(int(copies[best[at]].sum()))
            count_sum.append(int(copies @ n[at]))
        return pa.table([*(documents.column(c) for c in inner), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())], names=[*inner, "n_best", "count_sum"])

    return run


def count_links(aligned: DataFrame, carry: list[str], a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """Adds to the columns of ``carry`` how often a document's links are found in the whole table of ``align_documents``.

    A pair's count is the number of rows that link it. ``n_best`` are the links whose count is the highest
    among those of their first id, ties included; ``count_sum`` is the sum of the counts over all links. Rows without
    tokens have zeros; repeated rows count one by one; an empty table gives an empty result.
    """
    a, b = sizes(a_path, b_path)
    kind = key_type(a, b)
    inner = [f"_c{k}" for k in range(len(carry))]
    aligned = materialise(aligned.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(carry, inner, strict=True)), "batch", "pairs", "copies"), "aligned")
    asked = materialise(aligned.select("batch", "pairs").mapInArrow(_ask(kind), "batch long, pair long, n long"), "pairs")
    totals = asked.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("a", F.floor(F.col("pair") / b))
    highest = totals.groupBy("a").agg(F.max("total").alias("highest"))
    totals = totals.join(highest, "a").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    answers = asked.select("batch", "pair").distinct().join(totals, "pair")
    schema = ", ".join(f"{k} {aligned.schema[k].dataType.simpleString()}" for k in inner)
    made = aligned.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_add(kind, inner), f"{schema}, n_best long, count_sum long")
    return made.toDF(*carry, "n_best", "count_sum")

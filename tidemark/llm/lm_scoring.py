"""Stupid-backoff language-model scores, computed relationally.

The corpus' n-grams are exploded, counted in tables partitioned by hash, and
joined back to the n-grams of each document, whose scores are summed. So that no
table has a row for each of the corpus' words, n-grams travel packed: documents
are dealt into batches by a hash, each batch pre-aggregates its n-grams of all
orders and sends the distinct ones to the hash ranges of the count table (one sorted,
gap-coded list a batch and range; counts of one take no space). A range adds up the
counts of all batches and joins the totals back to each list in its order; n-grams that
no other batch has return as one bit. The texts are shuffled once, and there are never
more lists than n-grams, so what travels stays in proportion to the input. Very frequent
n-grams are one entry for each batch, however often they occur.

A document is scored by the rest of the corpus: its own n-grams are taken off the
counts first. With counts c over the other documents and N of their words, a word w
after its history h scores c(hw) / c(h) where c(hw) > 0, else 0.4 times
its score after the history without the first word, and at last c(w) / N, or
1 / (N + 1) for a word that no other document has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._hashing import Words, mix, slices, text_buffers, window_hashes

ORDER = 3
BACKOFF = 0.4
BATCH_BYTES = 16 << 20
#: An n-gram's hash has so many bits more than the logarithm of the corpus' words (64 at most).
_SPARE_BITS = 24
#: A range of the count table adds up about so many n-grams at a time, a batch those of a share for each so many bytes of text; sorting takes little memory beside the lists.
_SHARE = 1 << 18
_SHARE_BYTES = 1 << 20
_NO_GRAM = np.uint64(0)
_BIG = 255


def _pack_small(x: np.ndarray) -> bytes:
    """Numbers as bytes, those from 255 up in full behind them."""
    big = x >= _BIG
    return np.where(big, _BIG, x).astype(np.uint8).tobytes() + x[big].astype(np.uint64).tobytes()


def _unpack_small(raw: bytes, n: int) -> np.ndarray:
    x = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    x[x == _BIG] = np.frombuffer(raw, np.uint64, -1, n)
    return x


def pack_sparse(x: np.ndarray) -> bytes:
    """Numbers of which many are zero: a bit each, and the others."""
    return np.packbits(x > 0).tobytes() + _pack_small(x[x > 0])


def unpack_sparse(raw: bytes, n: int) -> np.ndarray:
    there = np.unpackbits(np.frombuffer(raw, np.uint8, -(-n // 8)), count=n).astype(bool)
    x = np.zeros(n, np.int64)
    x[there] = _unpack_small(raw[-(-n // 8) :], int(there.sum()))
    return x


def pack_sorted(h: np.ndarray) -> bytes:
    """Ascending numbers by their gaps: low bits as they are, the rest of each gap in unary.

    The first bytes are the count and the number of low bits.
    """
    n = len(h)
    gaps = np.diff(h, prepend=np.uint64(0))
    low = max(0, int(h[-1] // np.uint64(n)).bit_length() - 1) if n else 0
    high = (gaps >> np.uint64(low)).astype(np.int64)
    unary = np.zeros(int(high.sum()) + n, dtype=bool)
    unary[np.cumsum(high + 1) - 1] = True
    planes = [((gaps >> np.uint64(8 * k)) & np.uint64(255)).astype(np.uint8).tobytes() for k in range(low // 8)]
    rest = low % 8
    bits = np.unpackbits((gaps >> np.uint64(low - rest)).astype(np.uint8)[:, None], axis=1)[:, 8 - rest :]
    return b"".join([np.array([n, low], np.uint32).tobytes(), *planes, np.packbits(bits).tobytes(), np.packbits(unary).tobytes()])


def unpack_sorted(raw: bytes) -> np.ndarray:
    n, low = (int(x) for x in np.frombuffer(raw, np.uint32, 2))
    gaps, at, rest = np.zeros(n, np.uint64), 8, low % 8
    for k in range(low // 8):
        gaps |= np.frombuffer(raw, np.uint8, n, at).astype(np.uint64) << np.uint64(8 * k)
        at += n
    size = -(-n * rest // 8)
    bits = np.zeros((n, 8), np.uint8)
    bits[:, 8 - rest :] = np.unpackbits(np.frombuffer(raw, np.uint8, size, at), count=n * rest).reshape(n, rest)
    gaps |= np.packbits(bits, axis=1)[:, 0].astype(np.uint64) << np.uint64(low - rest)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, -1, at + size)))[:n]
    gaps += (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(low)
    return np.cumsum(gaps, dtype=np.uint64)


def _add_up(h: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes of some lists in order, the sum of the counts of each, and which of them each entry is, list by list."""
    h, counts = np.concatenate(h), np.concatenate(counts)
    order = np.argsort(h, kind="stable")
    h = h[order]
    new = np.diff(h, prepend=~h[:1]) != 0
    first = np.flatnonzero(new)
    own = np.empty(len(h), np.int64)
    own[order] = np.cumsum(new) - 1
    return h[first], np.add.reduceat(counts[order], first, dtype=np.int64) if len(first) else counts.astype(np.int64), own


class _Batch:
    """The n-grams of a batch of texts: the distinct ones of all with their counts, and on demand those of each slice of documents."""

    def __init__(self, documents: pa.Table, order: int, bits: int):
        self.offsets, self.data = text_buffers(documents.column("text"))
        self.rows, self.order, self.bits = len(self.offsets) - 1, order, bits
        n = int(self.offsets[-1] - self.offsets[0]) // _SHARE_BYTES + 1
        shares, begins = [[] for _ in range(n)], np.array([_begin(k, n, bits) for k in range(n)], np.uint64)
        for _, _, _, grams in self.slices():
            own, k = np.unique(grams, return_counts=True)
            edges = np.append(np.searchsorted(own, np.maximum(begins, np.uint64(1))), len(own))
            for share, i, j in zip(shares, edges[:-1], edges[1:], strict=True):
                share.append((own[i:j].copy(), k[i:j].astype(np.int32)))
        most, at = sum(len(own) for share in shares for own, _ in share), 0
        self.h, self.counts = np.empty(most, np.uint64), np.empty(most, np.int64)
        for k in range(n if most else 0):
            known, total, _ = _add_up(*zip(*shares[k], strict=True))
            shares[k] = None  # copies, so that their memory is free now
            self.h[at : at + len(known)], self.counts[at : at + len(known)] = known, total
            at += len(known)
        self.h, self.counts = self.h[:at], self.counts[:at]

    def slices(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Of each slice: first row, rows, row in it of each word, hash of the n-gram ending at each word by order (0: none).

        They are made again for each use, as those of all slices take more memory than the distinct n-grams.
        """
        for i, j in slices(self.offsets):
            words = Words(self.offsets, self.data, i, j)
            h = words.hashes()
            doc = np.repeat(np.arange(j - i, dtype=np.int32), np.diff(words.first))
            yield i, j - i, doc, np.stack([self._grams(h, doc, n) for n in range(1, self.order + 1)])

    def _grams(self, h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """The hash of the n-gram that ends at each word, 0 where the text has not begun."""
        g = np.zeros(len(h), np.uint64)
        if len(h) >= n:
            w = mix(window_hashes(h, n) ^ np.uint64(n)) >> np.uint64(64 - self.bits)
            w[w == _NO_GRAM] = np.uint64(1)
            g[n - 1 :] = np.where(doc[: len(w)] == doc[n - 1 :], w, _NO_GRAM)
        return g

    def ranges(self, buckets: int) -> np.ndarray:
        """Where each of the hash ranges begins among the n-grams, and the end."""
        return np.append(np.searchsorted(self.h, np.array([_begin(k, buckets, self.bits) for k in range(buckets)], np.uint64)), len(self.h))


def _begin(bucket: int, buckets: int, bits: int) -> int:
    return -(-(bucket << bits) // buckets)


_REQUEST = "batch long, bucket long, grams binary, counts binary"


def _ask(order: int, buckets: int, bits: int):
    """The distinct n-grams of a batch, by range of the count table."""

    def run(key: tuple, documents: pa.Table) -> pa.Table:
        batch = _Batch(documents, order, bits)
        edges, rows = batch.ranges(buckets), []
        for k in np.flatnonzero(np.diff(edges)).tolist():
            own = slice(edges[k], edges[k + 1])
            rows.append((k, pack_sorted(batch.h[own] - np.uint64(_begin(k, buckets, bits))), pack_sparse(batch.counts[own] - 1)))
        return pa.table({"batch": pa.array([key[0].as_py()] * len(rows), pa.int64()), "bucket": pa.array([r[0] for r in rows], pa.int64()), "grams": pa.array([r[1] for r in rows], pa.binary()), "counts": pa.array([r[2] for r in rows], pa.binary())})

    return run


def _count(key: tuple, requests: pa.Table) -> pa.Table:
    """One range of the count table: adds up all lists, and answers each with the counts of the other batches."""
    grams = [unpack_sorted(g.as_py()) for g in requests.column("grams")]
    counts = [unpack_sparse(c.as_py(), len(g)) + 1 for c, g in zip(requests.column("counts"), grams, strict=True)]
    top, n = max(int(g[-1]) for g in grams) + 1, sum(map(len, grams)) // _SHARE + 1
    begins = np.array([k * top // n for k in range(n)], np.uint64)
    cuts = np.array([np.append(np.searchsorted(g, begins), len(g)) for g in grams]).T
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        parts = [slice(i, j) for i, j in zip(a, b, strict=True)]
        _, total, own = _add_up([g[p] for g, p in zip(grams, parts, strict=True)], [c[p] for c, p in zip(counts, parts, strict=True)])
        for c, p, x in zip(counts, parts, np.split(total[own], np.cumsum(b - a)[:-1]), strict=True):
            c[p] = x - c[p]
    answers = [pack_sparse(c) for c in counts]
    return pa.table({"batch": requests.column("batch"), "bucket": requests.column("bucket"), "others": pa.array(answers, pa.binary())})


def _score(order: int, buckets: int, bits: int, words: int):
    """Scores the documents of a batch with the totals that came back."""

    def run(key: tuple, documents: pa.Table, answers: pa.Table) -> pa.Table:
        batch = _Batch(documents, order, bits)
        edges, totals = batch.ranges(buckets), batch.counts
        for k, raw in zip(answers.column("bucket").to_pylist(), answers.column("others").to_pylist(), strict=True):
            totals[edges[k] : edges[k + 1]] += unpack_sparse(raw, int(edges[k + 1] - edges[k]))
        n_words, total = np.zeros(batch.rows, np.int64), np.zeros(batch.rows)
        for first, rows, doc, grams in batch.slices():
            own, place = np.unique(grams, return_inverse=True)
            none = int(len(own) > 0 and own[0] == _NO_GRAM)
            n, place = np.bincount(doc, minlength=rows), place.reshape(grams.shape) - none
            n_words[first : first + rows] = n
            scores = _word_scores(doc, place, totals[np.searchsorted(batch.h, own[none:])], words - n[doc])
            total[first : first + rows] = np.bincount(doc, weights=scores, minlength=rows)
        mean = np.where(n_words > 0, total / np.maximum(n_words, 1), np.nan)
        return pa.table({"row": documents.column("row"), "n_words": pa.array(n_words), "log_score": pa.array(total), "mean_log_score": pa.array(mean, from_pandas=True)})

    return run


def _word_scores(doc: np.ndarray, place: np.ndarray, totals: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The score of each word of a slice, from the counts of its n-grams in the whole corpus."""
    order, less = len(place), np.zeros(place.shape, np.int64)
    for n in range(order):
        there = np.flatnonzero(place[n] >= 0)
        _, own, mine = np.unique(doc[there].astype(np.int64) * max(len(totals), 1) + place[n][there], return_inverse=True, return_counts=True)
        less[n][there] = totals[place[n][there]] - mine[own]
    score, level, done = np.zeros(len(doc)), np.full(len(doc), -1.0), np.zeros(len(doc), dtype=bool)
    for n in range(order - 1, 0, -1):
        has = place[n] >= 0
        level[has & (level < 0)] = 0
        history = np.zeros(len(doc), np.int64)
        history[1:] = less[n - 1][:-1]
        hit = has & ~done & (less[n] > 0)
        score[hit] = np.log(less[n][hit] / history[hit]) + level[hit] * np.log(BACKOFF)
        done |= hit
        level[~done & (level >= 0)] += 1
    rest = ~done
    c, n = less[0][rest], np.maximum(others[rest], 0)
    score[rest] = np.where(c > 0, np.log(np.maximum(c, 1) / np.maximum(n, 1)), -np.log(n + 1.0)) + np.maximum(level[rest], 0) * np.log(BACKOFF)
    return score


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes and words of each batch of texts."""
    for batch in batches:
        offsets, data = text_buffers(batch.column(0))
        words = sum(len(Words(offsets, data, i, j, None).start) for i, j in slices(offsets))
        yield pa.RecordBatch.from_pydict({"b": pa.array([int(offsets[-1] - offsets[0])], pa.int64()), "w": pa.array([words], pa.int64())})


def lm_scores(documents: DataFrame, order: int = ORDER, carry: list[str] | None = None, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Scores every document by the other documents of the table.

    Reads ``text``; returns the columns of ``carry`` (``doc_id`` unless told
    otherwise, any names but those added), ``n_words``, ``log_score`` (the sum of the
    words' natural logarithms) and ``mean_log_score`` (a word's mean, null without words).
    Words are lower-cased in A-Z. A null, empty or blank text has no words and a
    score of 0. Repeated rows score each other; the one document of a table
    scores its words as unseen. An empty table gives an empty result.

    N-grams are compared by hashes whose bits grow with the corpus: an n-gram is taken
    for another one with a chance of about ``order / 2 ** 24`` up to ``2 ** 40`` words, and
    ``order * words / 2 ** 64`` beyond. Batches and hash ranges grow in number with the
    table; a batch holds about ``batch_bytes`` of text, or one longer text. Equal rows
    are dealt apart by the partition that reads them.
    """
    names = carry or ["doc_id"]
    documents = documents.select(F.struct(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names))).alias("row"), "text")
    size = documents.select("text").mapInArrow(_sizes, "b long, w long").agg(F.sum("b").alias("b"), F.sum("w").alias("w")).first()
    parts, words = max(1, -(-(size.b or 0) // batch_bytes)), int(size.w or 0)
    bits = min(64, max(40, words.bit_length() + _SPARE_BITS))
    dealt = documents.withColumn("batch", F.pmod(F.xxhash64("row", "text", F.spark_partition_id()), F.lit(parts).cast("long")))
    asked = dealt.groupBy("batch").applyInArrow(_ask(order, parts, bits), _REQUEST)
    answers = asked.groupBy("bucket").applyInArrow(_count, "batch long, bucket long, others binary")
    kind = documents.schema["row"].dataType.simpleString()
    scored = dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_score(order, parts, bits, words), f"row {kind}, n_words long, log_score double, mean_log_score double")
    return scored.select(*(F.col(f"row.c{k}").alias(c) for k, c in enumerate(names)), "n_words", "log_score", "mean_log_score")

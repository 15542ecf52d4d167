"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence gets a probability from its
words and their character n-grams, a document the noisy-or of its sentences: it is toxic if any
sentence is. Only documents carry labels; the gradient of the document's
likelihood reaches each sentence in proportion to its own share in the
verdict, so training finds the sentences that carry the label and afterwards
locates them in unlabelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._hashing import Words, slices, text_buffers
from ._store import Carried

#: So many labelled documents at most train the model, those of the smallest hash of doc_id.
TRAIN_DOCUMENTS = 6000
BUCKET_BITS = 20
#: Lengths in bytes of the n-grams; letters only, with one space at either side of a word.
GRAMS = (4, 6)
#: An n-gram counts if so many of the training documents have it.
LEAST_DOCUMENTS = 4
#: Features whose documents are toxic so many standard deviations more often than all are trained, these many at most.
LEAST_LEAD = 4.0
MOST_FEATURES = 8192
_ROUNDS = 150
_MASK = np.uint32((1 << BUCKET_BITS) - 1)

_FOLD = np.full(256, 0x20, dtype=np.uint8)
for _c in range(256):
    if chr(_c).isalpha() and _c < 128:
        _FOLD[_c] = ord(chr(_c).lower())
    elif _c >= 128:
        _FOLD[_c] = _c
_FOLD[ord("'")] = 0x20
#: Bytes that end a sentence.
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Sentences:
    """Bucketed n-grams of some texts, ordered by sentence; sentences ordered by text."""

    buckets: list[np.ndarray]
    of: list[np.ndarray]  # the sentence of each n-gram
    document: np.ndarray  # the text of each sentence
    start: np.ndarray
    end: np.ndarray


def cut(offsets: np.ndarray, data: np.ndarray, i: int, j: int) -> Sentences:
    base = int(offsets[i])
    raw = data[base : int(offsets[j])]
    at = (offsets[i : j + 1] - base).astype(np.int64)
    n = len(raw)
    starts = np.union1d(at[:-1], np.flatnonzero(_STOP[raw]) + 1)
    starts = starts[starts < n] if n else starts[:0]
    ends = np.append(starts[1:], n)[: len(starts)]
    document = np.searchsorted(at, starts, side="right") - 1
    folded = _FOLD[raw]
    sentence = np.repeat(np.arange(len(starts)), ends - starts)
    word = folded != 0x20
    buckets, of = [], []
    wide = folded.astype(np.uint32)
    for size in GRAMS:
        m = n - size + 1
        if m <= 0:
            continue
        h = np.full(m, size, dtype=np.uint32)
        inner = np.ones(m, dtype=bool)
        for k in range(size):
            h = h * np.uint32(0x01000193) + wide[k : k + m]
            if 0 < k < size - 1:
                inner &= word[k : k + m]
        inner &= sentence[:m] == sentence[size - 1 :]
        keep = np.flatnonzero(inner)
        x = h[keep]
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x ^= x >> np.uint32(13)
        buckets.append(x & _MASK)
        of.append(sentence[keep])
    whole = Words(offsets, data, i, j, fold=_FOLD)
    if len(whole.start):
        buckets.append((whole.hashes() >> np.uint64(64 - BUCKET_BITS)).astype(np.uint32))
        of.append(sentence[whole.start])
    return Sentences(buckets, of, document, starts + base, ends + base)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    @staticmethod
    def untrained() -> Model:
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), -6.0)

    def sentence_scores(self, s: Sentences) -> np.ndarray:
        """The probability of each sentence; zero without any feature of the model, so length alone is no evidence."""
        z = np.full(len(s.document), self.bias)
        hits = [(of[k], b[k]) for b, of in zip(s.buckets, s.of, strict=True) for k in [np.flatnonzero(self.weights[b])]]
        found = np.unique(np.concatenate([of.astype(np.int64) << BUCKET_BITS | b for of, b in hits])) if hits else np.zeros(0, np.int64)
        of = found >> BUCKET_BITS
        z += np.bincount(of, weights=self.weights[found & int(_MASK)], minlength=len(z))
        known = np.bincount(of, minlength=len(z)) > 0
        return np.where(known, 1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.0)


def noisy_or(p: np.ndarray, document: np.ndarray, n: int) -> np.ndarray:
    """One minus the chance that no sentence of the document is toxic."""
    return -np.expm1(np.bincount(document, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n)) + 0.0


def train_model(texts: list[tuple[np.ndarray, np.ndarray]], labels: list[np.ndarray], rounds: int = _ROUNDS) -> Model:
    """Adagrad on the negative log likelihood of the documents' labels.

    ``texts`` are offsets and bytes of batches. Features are counted a slice at a
    time; only those that tell toxic documents from others are kept for training.
    """
    model = Model.untrained()
    y = np.concatenate([np.zeros(0, np.int64), *labels])
    if not len(y) or y.min() == y.max():
        return model
    rate = y.mean()
    having, toxic = np.zeros(1 << BUCKET_BITS, np.int64), np.zeros(1 << BUCKET_BITS)
    for (offsets, data), own in zip(texts, labels, strict=True):
        for i, j in slices(offsets):
            s = cut(offsets, data, i, j)
            pairs = np.unique(np.concatenate([np.zeros(0, np.int64)] + [x.astype(np.int64) * (j - i) + s.document[z] for x, z in zip(s.buckets, s.of, strict=True)]))
            having += np.bincount(pairs // (j - i), minlength=len(having))
            toxic += np.bincount(pairs // (j - i), weights=own[i:j][pairs % (j - i)], minlength=len(toxic))
    expected = having * rate
    lead = (toxic - expected) / np.sqrt(np.maximum(expected * (1 - rate), 1e-9))
    lead[having < LEAST_DOCUMENTS] = 0
    told = lead >= max(LEAST_LEAD, np.partition(lead, -MOST_FEATURES)[-MOST_FEATURES])
    documents, sentences, b, of, doc = 0, 0, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for offsets, data in texts:
        for i, j in slices(offsets):
            s = cut(offsets, data, i, j)
            for x, z in zip(s.buckets, s.of, strict=True):
                k = np.flatnonzero(told[x])
                b.append(x[k].astype(np.int64))
                of.append(z[k] + sentences)
            doc.append(s.document + documents)
            sentences += len(s.document)
            documents += j - i
    b, of, doc, labels = np.concatenate(b), np.concatenate(of), np.concatenate(doc), y
    used, b = np.unique(b, return_inverse=True)
    if not len(used):
        return model
    once = np.unique(of.astype(np.int64) * len(used) + b)
    of, b = once // len(used), once % len(used)
    there, of = np.unique(of, return_inverse=True)
    doc, sentences = doc[there], len(there)
    bias = float(np.log(labels.sum() / sentences + 1e-6) - 1)
    w, seen, seen_bias = np.zeros(len(used)), np.full(len(used), 1e-6), 1e-6
    for _ in range(rounds):
        z = bias + np.bincount(of, weights=w[b], minlength=sentences)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        whole = np.clip(noisy_or(p, doc, documents), 1e-9, 1 - 1e-9)
        slope = np.where(labels[doc] == 1, -p * (1 - whole[doc]) / whole[doc], p)
        g = np.bincount(b, weights=slope[of], minlength=len(used)) / documents + 2e-5 * w
        seen += g * g
        w -= 0.3 * g / np.sqrt(seen)
        g = slope.sum() / documents
        seen_bias += g * g
        bias -= 0.1 * g / np.sqrt(seen_bias)
    model.weights[used] = w
    model.bias = bias
    return model


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, labels = [], []
    for batch in batches:
        texts.append(text_buffers(batch.column("text")))
        labels.append(batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64))
    model = train_model(texts, labels)
    there = np.flatnonzero(model.weights)
    yield pa.record_batch([pa.array([there.tolist()], pa.list_(pa.int32())), pa.array([model.weights[there].tolist()], pa.list_(pa.float32())), pa.array([model.bias], pa.float64())], names=["places", "weights", "bias"])


def held_out():
    """Rows that training must not see: crc32 of doc_id as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_toxicity(documents: DataFrame, labels: DataFrame, most: int = TRAIN_DOCUMENTS) -> Model:
    """Trains on ``most`` labelled documents at most, none of them held out; the weights are bounded by the buckets."""
    chosen = labels.where("doc_id is not null and toxic is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # `most` rows of two numbers: a bounded broadcast
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id", "text")).limit(most)
    found = sample.select("text", "toxic").mapInArrow(_train, "places array<int>, weights array<float>, bias double").first()
    model = Model.untrained()
    if found:
        model.weights[np.array(found.places, np.int64)] = found.weights
        model.bias = found.bias
    return model


def _score(shared, others: list[str], name: str = "text"):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            offsets, data = text_buffers(batch.column(name))
            scores, worst, from_, to = [np.zeros(0)], [np.zeros(0)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, j in slices(offsets, 1 << 19):
                s = cut(offsets, data, i, j)
                p = model.sentence_scores(s)
                scores.append(noisy_or(p, s.document, j - i))
                order = np.lexsort((-np.arange(len(p)), p, s.document))
                last = np.flatnonzero(np.diff(np.append(s.document[order], j - i)) > 0)
                top, a, b = np.zeros(j - i), np.full(j - i, -1), np.full(j - i, -1)
                pick = order[last] if len(order) else order
                top[s.document[pick]], a[s.document[pick]], b[s.document[pick]] = p[pick], s.start[pick], s.end[pick]
                worst.append(top)
                from_.append(a)
                to.append(b)
            score, top, a, b = (np.concatenate(x) for x in (scores, worst, from_, to))
            flagged = [data[a[k] : b[k]].tobytes().decode("utf-8", "replace").strip() if score[k] >= 0.5 else None for k in range(len(score))]
            made = [pa.array(np.clip(score, 0, 1)), pa.array((score >= 0.5).astype(np.int32)), pa.array(top), pa.array(flagged, pa.string())]
            yield pa.record_batch([batch.column(c) for c in others] + made, names=[*others, "score", "predicted", "sentence_score", "sentence"])

    return run


def score_toxicity(documents: DataFrame, model: Model, keep_columns: list[str] | None = None) -> DataFrame:
    """Scores every whole text and locates the offending sentence.

    Reads ``text`` alone and passes ``keep_columns`` on (``doc_id`` unless told
    otherwise); further columns are not read. Adds ``score`` (noisy-or over the
    sentences), ``predicted`` (1 from a score of 0.5), ``sentence_score`` (of the
    highest sentence, the first of equals) and ``sentence`` (that sentence where
    predicted is 1, else null). A null or empty text scores 0. Repeated rows are
    scored one by one; an empty table gives an empty result.
    """
    carried = Carried(documents, keep_columns or ["doc_id"])
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = carried.schema + ", score double, predicted int, sentence_score double, sentence string"
    return carried.restore(carried.frame.mapInArrow(_score(shared, carried.inner, carried.text), schema))

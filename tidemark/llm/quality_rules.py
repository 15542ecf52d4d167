"""Quality rules: a linear-chain conditional random field labels the lines of a text.

Every line with a word is content or boilerplate. The field scores each line
from its features and each step from one line to the next; Viterbi decoding
gives the best labelling of the whole text, and the share of words on content
lines decides whether the text is kept. The field is trained on a bounded
sample of labelled documents; everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._hashing import Words, _power_tables, mix, slices, text_buffers, window_hashes
from ._store import Carried

#: The rules' own limits.
LEAST_WORDS = 10
MOST_REPEATED = 20  # of 100 words
WINDOW = 5
LEAST_CONTENT = 0.5
#: So many labelled documents at most train the field, those of the smallest hash of doc_id.
TRAIN_DOCUMENTS = 3000
_ROUNDS = 120

FEATURES = ("bias", "log_words", "word_length", "symbols", "upper", "digits", "punctuation", "exclamations", "sentence_end", "repeats_line", "repeated_words", "short")


def _is(chars: str) -> np.ndarray:
    table = np.zeros(256, dtype=np.int64)
    table[[ord(c) for c in chars]] = 1
    return table


_SYMBOL = _is("#*$%&|<>")
_UPPER = _is("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _is("0123456789")
_PUNCT = _is(".,;:?")
_BANG = _is("!")
_POINT = np.ones(256, dtype=np.int64)
_POINT[0x80:0xC0] = 0  # bytes that continue a code point


def _sums(data: np.ndarray, kind: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(kind[data], out=total[1:])
    return total


@dataclass
class Measured:
    """The figures of some documents, and their lines that have a word."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    line_doc: np.ndarray
    line_words: np.ndarray
    features: np.ndarray


def _spread(marks: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a marked window."""
    step = np.zeros(n + 1, dtype=np.int64)
    at = np.flatnonzero(marks)
    np.add.at(step, at, 1)
    np.add.at(step, at + size, -1)
    return np.cumsum(step)[:n] > 0


def measure(offsets: np.ndarray, data: np.ndarray, i: int, j: int) -> Measured:
    w = Words(offsets, data, i, j, fold=None)
    raw, rows, n = w.data, w.rows, len(w.start)
    n_words = np.diff(w.first)
    doc_of = np.repeat(np.arange(rows), n_words)
    points = _sums(raw, _POINT)
    symbols = _sums(raw, _SYMBOL)
    chars_of = points[w.end] - points[w.start]
    chars_to = np.concatenate([[0], np.cumsum(chars_of)])
    word_chars = chars_to[w.first[1:]] - chars_to[w.first[:-1]]
    n_symbols = symbols[w.at[1:]] - symbols[w.at[:-1]]

    repeated = np.zeros(n, dtype=bool)
    if n >= WINDOW:
        h = window_hashes(w.hashes(), WINDOW)
        within = np.flatnonzero(doc_of[: n - WINDOW + 1] == doc_of[WINDOW - 1 :])
        _, inverse, counts = np.unique(mix(h[within] ^ mix(doc_of[within].astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True)
        marks = np.zeros(n - WINDOW + 1, dtype=bool)
        marks[within[counts[inverse] > 1]] = True
        repeated = _spread(marks, WINDOW, n)
    repeats_to = np.concatenate([[0], np.cumsum(repeated)])
    n_repeat = repeats_to[w.first[1:]] - repeats_to[w.first[:-1]]

    breaks = np.flatnonzero(raw == 10)
    start = np.union1d(w.at[:-1], breaks + 1)
    start = start[start < len(raw)]
    owner = np.searchsorted(w.at, start, side="right") - 1
    following = np.concatenate([start[1:], [len(raw)]]) if len(start) else start
    end = following - ((following > start) & (raw[following - 1] == 10)).astype(np.int64) if len(start) else start
    first = np.searchsorted(w.start, start)
    last = np.searchsorted(w.start, end)
    full = last > first
    start, end, owner, first, last = start[full], end[full], owner[full], first[full], last[full]
    words = last - first

    again = np.zeros(len(start), dtype=bool)
    if len(start):
        up, down = _power_tables(len(raw) + 1)
        total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=total[1:])
        h = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
        again[:] = True
        again[np.unique(mix(h ^ mix(owner.astype(np.uint64) + np.uint64(1))), return_index=True)[1]] = False
    n_dup = np.bincount(owner[again], minlength=rows)

    def share(kind: np.ndarray) -> np.ndarray:
        total = _sums(raw, kind)
        return (total[end] - total[start]) / np.maximum(end - start, 1)

    closing = raw[w.end[last - 1] - 1] if len(start) else raw[:0]
    chars = chars_to[last] - chars_to[first]
    features = np.stack([
        np.ones(len(start)),
        np.log1p(words) / 3,
        np.minimum(chars / np.maximum(words, 1), 20) / 10,
        10 * share(_SYMBOL),
        2 * share(_UPPER),
        2 * share(_DIGIT),
        5 * share(_PUNCT),
        5 * share(_BANG),
        np.isin(closing, np.frombuffer(b".!?", np.uint8)).astype(float),
        again.astype(float),
        (repeats_to[last] - repeats_to[first]) / np.maximum(words, 1),
        (words < 3).astype(float),
    ], axis=1) if len(start) else np.zeros((0, len(FEATURES)))
    return Measured(n_words, word_chars, n_symbols, n_dup, n_repeat, owner, words, features)


@dataclass
class Field:
    """Weights for content against boilerplate, and scores of the steps [from, to]."""

    weights: np.ndarray
    steps: np.ndarray

    @staticmethod
    def untrained() -> Field:
        """Every line is content."""
        return Field(np.eye(1, len(FEATURES))[0], np.zeros((2, 2)))


def _grid(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents from the longest to the shortest, and how many have more than t lines, for each t."""
    order = np.argsort(-lengths, kind="stable")
    return order, np.array([np.searchsorted(-lengths[order], -t, side="left") for t in range(int(lengths.max(initial=0)))], dtype=np.int64)


def viterbi(scores: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The best labels of chains that lie one after another; ``scores`` is content's lead on each line."""
    start = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    order, alive = _grid(lengths)
    labels = np.zeros(len(scores), dtype=np.int64)
    if not len(alive):
        return labels
    best = np.zeros((len(lengths), 2))
    best[: alive[0], 1] = scores[start[order[: alive[0]]]]
    back = []
    for t in range(1, len(alive)):
        k = alive[t]
        via = best[:k, :, None] + steps[None]
        came = via.argmax(axis=1)
        best[:k] = np.take_along_axis(via, came[:, None, :], axis=1)[:, 0, :]
        best[:k, 1] += scores[start[order[:k]] + t]
        back.append(came)
    state = best.argmax(axis=1)
    for t in range(len(alive) - 1, -1, -1):
        k = alive[t]
        labels[start[order[:k]] + t] = state[:k]
        if t:
            state[:k] = np.take_along_axis(back[t - 1], state[:k, None], axis=1)[:, 0]
    return labels


def train_field(features: np.ndarray, lengths: np.ndarray, labels: np.ndarray, rounds: int = _ROUNDS, decay: float = 1e-3) -> Field:
    """Maximises the likelihood of the labelled chains by Adam on forward-backward gradients."""
    lengths = lengths[lengths > 0]
    if not len(lengths) or labels.min() == labels.max():
        return Field.untrained()
    start = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    order, alive = _grid(lengths)
    first = np.zeros(len(labels), dtype=bool)
    first[start] = True
    truth = np.zeros((2, 2))
    np.add.at(truth, (labels[:-1][~first[1:]], labels[1:][~first[1:]]), 1)
    size, theta = features.shape[1], np.zeros(features.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    places = [start[order[: alive[t]]] + t for t in range(len(alive))]
    for turn in range(1, rounds + 1):
        w, steps = theta[:size], theta[size:].reshape(2, 2)
        score = np.stack([np.zeros(len(labels)), features @ w], axis=1)
        move = np.exp(steps - steps.max())
        local = np.exp(score - score.max(axis=1, keepdims=True))
        ahead, back = np.zeros_like(local), np.ones_like(local)
        for t, at in enumerate(places):
            x = local[at] if t == 0 else local[at] * (ahead[places[t - 1][: len(at)]] @ move)
            ahead[at] = x / x.sum(axis=1, keepdims=True)
        expected = np.zeros((2, 2))
        for t in range(len(places) - 1, 0, -1):
            at, before = places[t], places[t - 1][: len(places[t])]
            right = local[at] * back[at]
            pair = ahead[before][:, :, None] * move[None] * right[:, None, :]
            expected += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            x = right @ move.T
            back[before] = x / x.sum(axis=1, keepdims=True)
        belief = ahead * back
        belief = belief[:, 1] / belief.sum(axis=1)
        slope = np.concatenate([features.T @ (labels - belief), (truth - expected).ravel()]) / len(labels) - decay * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta = theta + 0.2 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return Field(theta[:size], theta[size:].reshape(2, 2))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features, lengths, labels = [], [], []
    for batch in batches:
        offsets, data = text_buffers(batch.column("text"))
        good = batch.column("quality").to_numpy(zero_copy_only=False).astype(np.int64)
        for i, j in slices(offsets):
            m = measure(offsets, data, i, j)
            features.append(m.features)
            lengths.append(np.bincount(m.line_doc, minlength=j - i))
            labels.append(np.where(m.features[:, FEATURES.index("repeats_line")] > 0, 0, good[i:j][m.line_doc]))
    if features:
        field = train_field(np.concatenate(features), np.concatenate(lengths), np.concatenate(labels))
        yield pa.record_batch([pa.array([field.weights.tolist()], pa.list_(pa.float64())), pa.array([field.steps.ravel().tolist()], pa.list_(pa.float64()))], names=["weights", "steps"])


def fit_field(documents: DataFrame, labels: DataFrame, most: int = TRAIN_DOCUMENTS) -> Field:
    """Trains on ``most`` labelled documents at most; their lines take the document's ``quality``, repeated lines are boilerplate."""
    chosen = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # `most` rows of two numbers: a bounded broadcast
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id", "text")).limit(most)
    found = sample.select("text", "quality").mapInArrow(_train, "weights array<double>, steps array<double>").first()
    return Field(np.array(found.weights), np.array(found.steps).reshape(2, 2)) if found else Field.untrained()


_RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean"


def _judge(field: Field, others: list[str], name: str = "text"):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = text_buffers(batch.column(name))
            parts = [[] for _ in range(8)]
            for i, j in slices(offsets):
                m = measure(offsets, data, i, j)
                labels = viterbi(m.features @ field.weights, np.bincount(m.line_doc, minlength=j - i), field.steps)
                content = np.bincount(m.line_doc, weights=labels * m.line_words, minlength=j - i) / np.maximum(m.n_words, 1)
                failed = (m.n_words < LEAST_WORDS) | (100 * m.n_repeat_words > MOST_REPEATED * m.n_words)
                for part, x in zip(parts, (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, failed, content, ~failed & (content >= LEAST_CONTENT)), strict=True):
                    part.append(x)
            made = [pa.array(np.concatenate(p) if p else []) for p in parts]
            made = [x.cast(t) for x, t in zip(made, [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()], strict=True)]
            yield pa.record_batch([batch.column(c) for c in others] + made, names=others + [c.split()[0] for c in _RESULT.split(", ")])

    return run


def judge_quality(documents: DataFrame, field: Field, keep_columns: list[str] | None = None) -> DataFrame:
    """The rules' figures and verdict for every document.

    Reads ``text`` and passes ``keep_columns`` on (``doc_id`` unless told
    otherwise); other columns, whatever their names, are not read. A null, empty
    or blank text has no words, so it fails the base rules and is not kept.
    Repeated rows are judged one by one; an empty table gives an empty result.
    """
    carried = Carried(documents, keep_columns or ["doc_id"])
    return carried.restore(carried.frame.mapInArrow(_judge(field, carried.inner, carried.text), f"{carried.schema}, {_RESULT}"))

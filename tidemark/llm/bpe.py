"""Byte-level BPE encoding by a walk over a trie of words, and decoding.

The encoding of a word is told by its prefixes: the last token of a prefix is the one
token that ends there and follows, as a pair, the last token of the prefix in front of
it. Two tokens follow each other if merging their joined bytes gives the two back. So one
token for each prefix is the whole state, and words with a common prefix share its states.

Each task collects the distinct words of a stretch of texts, inserts them into a trie in
order and goes through it depth first; every shared prefix is worked out once, and a
word's tokens are read back from its last token to its first. Words met of late stay
encoded from stretch to stretch, so no corpus-wide table and no shuffle is needed.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame

from ._hashing import slices, text_buffers
from ._store import Carried
from ._units import units

DEFAULT_PATH = public_tokenizers.path("byte_bpe_50k.json")
#: Bytes of text whose words share a trie.
STRETCH = 1 << 20
#: Words after which a worker forgets those that it has not met since so many words before.
KEPT = 120_000
#: Pairs of tokens that a worker keeps the answer for.
FOLLOWING = 300_000
#: A longer word is walked alone, so that the trie's size is bounded by its number of words.
LONG = 512
_NEVER = 1 << 60
_ADDED = "\ud800"
_PATTERN = regex.compile(public_tokenizers.PATTERN)
#: Characters beyond Latin script, whose classes may differ between Unicode versions, and rare control characters.
_FOREIGN = re.compile("[^\t-\r\x20-\x7e\xa0-\u024f]")


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class ByteBpe:
    """A byte-level BPE vocabulary: which tokens follow each other, and the tokens of words and texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        model = said["model"]
        if model["type"] != "BPE" or said["normalizer"] or (said["pre_tokenizer"] or {}).get("type") != "ByteLevel" or said["pre_tokenizer"]["add_prefix_space"] or not said["pre_tokenizer"].get("use_regex", True) or model.get("ignore_merges"):
            raise ValueError("not a plain byte-level BPE file")
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"]) for t in said["added_tokens"]):
            raise ValueError("added tokens that touch white space or words are not known")
        as_byte = byte_characters()
        to_bytes = lambda token: bytes(as_byte[c] for c in token)
        vocabulary = model["vocab"]
        self.ids = {to_bytes(token): k for token, k in vocabulary.items() if token not in self.special}
        self.bytes = [b""] * (1 + max([*vocabulary.values(), *self.special.values()]))
        for token, k in self.ids.items():
            self.bytes[k] = token
        for token, k in self.special.items():
            self.bytes[k] = token.encode()
        #: rank of each pair that merges, and for each merged token its rank and parts
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = (self.ids[to_bytes(x)] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.rank.setdefault((a, b), r)
            self.parts.setdefault(self.ids[self.bytes[a] + self.bytes[b]], (r, a, b))
        self.split = tokenizers.Tokenizer.from_file(path).pre_tokenizer
        self.to_bytes = to_bytes
        #: how far the ends of tokens reach back: every end of a token
        self.ends = {token[k:] for token in self.ids for k in range(len(token))}
        self._spines: tuple[dict, dict] = ({}, {})
        self._whole: dict[int, bool] = {}
        self._follows: dict[int, bool] = {}
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at one end of a token while it is merged: each part with the rank at which it goes on into the next."""
        got = self._spines[side].get(token)
        if got is None:
            got, until, x = [], _NEVER, token
            while True:
                got.append((x, until))
                if x not in self.parts:
                    break
                until, x = self.parts[x][0], self.parts[x][1 + side]
            got.reverse()
            self._spines[side][token] = got
        return got

    def _meets(self, a: int, b: int) -> tuple[int, int] | None:
        """The first pair that merges across the border of two tokens; merges of lower rank come first, of equal ones the left one."""
        left, right, i, j = self._spine(a, 1), self._spine(b, 0), 0, 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            r = self.rank.get((x, y), _NEVER)
            if r < x_until and r <= y_until and r != _NEVER:
                return x, y
            if x_until == y_until == _NEVER:
                return None
            if x_until <= y_until:
                i += 1
            if y_until <= x_until:
                j += 1

    def whole(self, token: int) -> bool:
        """Whether the token's own bytes are merged into it."""
        got = self._whole.get(token)
        if got is None:
            if token in self.parts:
                _, a, b = self.parts[token]
                got = self.whole(a) and self.whole(b) and self._meets(a, b) == (a, b)
            else:
                got = len(self.bytes[token]) == 1
            self._whole[token] = got
        return got

    def follows(self, a: int, b: int) -> bool:
        """Whether the joined bytes of two tokens are merged into just these two."""
        key = a << 32 | b
        got = self._follows.get(key)
        if got is None:
            if len(self._follows) > FOLLOWING:
                self._follows.clear()
            got = self._follows[key] = self.whole(b) and self._meets(a, b) is None
        return got

    def _last(self, text: bytearray, depth: int, path: list[int]) -> int:
        """The last token of the prefix of so many bytes, from those of the shorter prefixes."""
        ids, ends, known, start = self.ids, self.ends, self._follows, depth - 1
        while start >= 0:
            end = bytes(text[start:depth])
            token = ids.get(end)
            if token is not None:
                # a token that is not merged from its own bytes follows nothing
                if not start:
                    if self.whole(token):
                        return token
                else:
                    fits = known.get(path[start] << 32 | token)
                    if self.follows(path[start], token) if fits is None else fits:
                        return token
            elif end not in ends:
                break
            start -= 1
        raise ValueError("a byte has no token")

    def _read_back(self, path: list[int], depth: int) -> bytes:
        out = []
        while depth:
            out.append(path[depth])
            depth -= len(self.bytes[path[depth]])
        return np.array(out[::-1], "<u4").tobytes()

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """The tokens of distinct words (of at least a byte), packed."""
        out: dict[bytes, bytes] = {}
        step: dict[int, int] = {}
        byte, depth, word_at = bytearray(1), [0], {}
        for word in sorted(words):
            if len(word) > LONG:
                path, text = [0], bytearray(word)
                for k in range(1, len(word) + 1):
                    path.append(self._last(text, k, path))
                out[word] = self._read_back(path, len(word))
                continue
            node = 0
            for d, b in enumerate(word, 1):
                key = node << 8 | b
                node = step.get(key, 0)
                if not node:
                    node = step[key] = len(depth)
                    byte.append(b)
                    depth.append(d)
            word_at[node] = word
        # words came in order, so nodes are numbered depth first: the path to a node is what was seen last at each depth
        path, text = [0] * (LONG + 1), bytearray(LONG)
        for node in range(1, len(depth)):
            d = depth[node]
            text[d - 1] = byte[node]
            path[d] = self._last(text, d, path)
            word = word_at.get(node)
            if word is not None:
                out[word] = self._read_back(path, d)
        return out

    def _split(self, text: str) -> list[str]:
        """The text's words by the splitting pattern; an added token has ``_ADDED`` in front, which no text holds."""
        rest = [text]
        for name in self.special:
            if name in text:
                rest = [x for part in rest for n, y in enumerate(part.split(name) if part[:1] != _ADDED else [part]) for x in ([_ADDED + name, y] if n else [y])]
        out: list[str] = []
        for x in rest:
            if x[:1] == _ADDED:
                out.append(x)
            elif not _FOREIGN.search(x):
                out += _PATTERN.findall(x)
            else:  # letters and spaces are told by the library's own tables
                out += [self.to_bytes(w).decode() for u in units(x) if u for w, _ in self.split.pre_tokenize_str(u)]
        return out

    def _encoded(self, words: set[str]) -> dict[str, bytes]:
        """The packed tokens of distinct words. Words that were used of late are still known; those of longer ago are forgotten."""
        known, older, out, new = self.kept, self.older, {}, {}
        for w in words:
            got = known.get(w)
            if got is None:
                got = older.get(w)
                if got is not None:
                    known[w] = got
                elif w[:1] == _ADDED:
                    got = np.array([self.special[w[1:]]], "<u4").tobytes()
                else:
                    new[w.encode()] = w
            out[w] = got
        for word, packed in self.encode_words(new).items():
            out[new[word]] = packed
            if len(word) <= LONG:
                known[new[word]] = packed
        if len(known) > KEPT:
            self.kept, self.older = {}, known
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed tokens of each text."""
        split = [self._split(t) for t in texts]
        known = self._encoded(set().union(*split))
        return [b"".join(map(known.__getitem__, ws)) for ws in split]

    def decode(self, packed: bytes) -> str:
        return decode(packed, self.bytes)


def decode(packed: bytes, tokens: list[bytes]) -> str:
    """The text of packed tokens; bytes that are no UTF-8 become U+FFFD."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(packed, "<u4").tolist())).decode("utf-8", "replace")


@functools.lru_cache(2)
def vocabulary(path: str) -> ByteBpe:
    """The vocabulary of a file, read once by each worker."""
    return ByteBpe(path)


@functools.lru_cache(2)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each token of a file, which is all that decoding needs."""
    return ByteBpe(path).bytes


def _by_stretches(batch: pa.RecordBatch, column: pa.Array, stretch: int) -> Iterator[tuple[pa.RecordBatch, int, int]]:
    offsets, _ = text_buffers(column)
    for i, j in slices(offsets, stretch):
        yield batch.slice(i, j - i), i, j


def encode_documents(documents: DataFrame, path: str = DEFAULT_PATH, carry: list[str] | None = None, stretch: int = STRETCH) -> DataFrame:
    """Adds ``ids`` to the columns of ``carry`` (``doc_id`` unless told otherwise): the text's tokens as little-endian unsigned 32-bit integers.

    Strings of the file's added tokens within a text become these tokens; no other tokens are added.
    ``path`` is read by every worker. A null or empty text has no tokens. Rows are encoded one by one, so
    repeated rows and ids stay as they are; an empty table gives an empty result. A task holds the words of
    ``stretch`` bytes of text at a time, or those of one longer text.
    """
    carried = Carried(documents, carry or ["doc_id"])
    name, inner = carried.text, carried.inner

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for part, _, _ in _by_stretches(batch, batch.column(name), stretch):
                ids = bpe.encode([t or "" for t in part.column(name).to_pylist()])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in inner), pa.array(ids, pa.binary())], names=[*inner, "ids"])

    return carried.restore(carried.frame.mapInArrow(run, f"{carried.schema}, ids binary"))


def decode_documents(encoded: DataFrame, path: str = DEFAULT_PATH, carry: list[str] | None = None) -> DataFrame:
    """Adds ``decoded`` to the columns of ``carry`` (``doc_id`` and ``ids`` unless told otherwise): the text of ``ids``, added tokens included.

    Null or empty ids are an empty text; an id that the file does not have is an error.
    """
    names = carry or ["doc_id", "ids"]
    carried = Carried(encoded.withColumn("text", encoded["ids"]), names)
    name, inner = carried.text, carried.inner

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_bytes(path)
        for batch in batches:
            texts = [decode(x or b"", tokens) for x in batch.column(name).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in inner), pa.array(texts, pa.string())], names=[*inner, "decoded"])

    return carried.restore(carried.frame.mapInArrow(run, f"{carried.schema}, decoded string"))

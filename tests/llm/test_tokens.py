"""Encoding, alignment and spelling variants against the tokenizers themselves and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from tidemark.llm import alignment, bpe, catalogue, spelling
from tidemark.llm._units import short_units, units

POOL = ["a", "b", "th", "ing", " ", "  ", "\n", "\n\n", "\t", "\xa0", "\x1c", "\x85", "᠎", "é", "ü", "日本", "語", "😀", "👍🏽", "'s", "'t", "'", "1", "٣", "²", "!", "...", ".", ",", "<|endoftext|>", "<|endo", "<s>", "<0x41>", "▁", "​", "﻿", "ﬁ", "́", "\r\n", "\x00", "_", "　", "abcabc", "aaaa", "\U0001e900", "한국", "Ꙋ"]
RND = random.Random(11)
RANDOM = ["".join(RND.choice(POOL) for _ in range(RND.randint(0, 14))) for _ in range(3000)]
LONG = "".join(RND.choice("abcdefgh") for _ in range(20_000))
ODD = [(1, "The cat sat.\nOn the mat, the cat!", "a"), (1, "The cat sat.\nOn the mat, the cat!", "a"), (2, None, "b"), (3, "", None), (None, "cats sat", "b"), (4, " ", "b"), (5, LONG, "a"), (6, "one▁two", "a"), (7, "tail ", "a")]
SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    clash = ("n", "ids", "decoded", "groups", "pairs", "batch", "copies", "word", "run", "root", "n_a", "_text", "_c0")
    return spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit("clash") for c in clash})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_units_join_to_the_text():
    for t in [*RANDOM, LONG, " a  b ", "x.y, z"]:
        assert "".join(units(t)) == t and "".join(short_units(" " + t)) == " " + t


def test_encoding_equals_the_library():
    one, own = tokenizers.Tokenizer.from_file(bpe.DEFAULT_PATH), bpe.ByteBpe(bpe.DEFAULT_PATH)
    texts = [*RANDOM, LONG, "a" * 3000, "\n" * 99, " " * 77 + "x" + " " * 77, "=-" * 500]
    for t, got in zip(texts, own.encode(texts), strict=True):
        ids = one.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == ids
        assert own.decode(got) == one.decode(ids, skip_special_tokens=False)


def test_words_that_are_forgotten_are_encoded_again(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 5)
    monkeypatch.setattr(bpe, "FOLLOWING", 5)
    own, whole = bpe.ByteBpe(bpe.DEFAULT_PATH), bpe.ByteBpe(bpe.DEFAULT_PATH)
    for t in RANDOM[:200]:
        assert own.encode([t]) == whole.encode([t])


def test_encoding_of_odd_rows(odd, empty):
    one = tokenizers.Tokenizer.from_file(bpe.DEFAULT_PATH)
    rows = bpe.decode_documents(bpe.encode_documents(odd, carry=["doc_id", "ids"]).toDF("doc_id", "clash", "ids"), carry=["doc_id", "clash", "ids"]).collect()
    want = [(d, "clash", tuple(one.encode(t or "", add_special_tokens=False).ids), t or "") for d, t, _ in ODD]
    assert Counter((r.doc_id, r.clash, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.decoded) for r in rows) == Counter(want)
    assert bpe.decode_documents(bpe.encode_documents(empty)).collect() == []


def naive(a, b, a_bytes, b_bytes, text):
    """Ends by decoded bytes, groups between common ends, all pairs of a group."""
    if not text:
        return 0, 0, "", Counter()
    x, y, raw = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), (" " + text).encode()
    if b"".join(a_bytes[k] for k in x) != raw or b"".join(b_bytes[k] for k in y) != raw:
        return 0, 0, "", Counter()
    ends = [np.cumsum([len(t[k]) for k in ids]).tolist() for ids, t in ((x, a_bytes), (y, b_bytes))]
    groups, links, i, j = [], Counter(), 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        i0, j0, i, j = i, j, ends[0].index(cut) + 1, ends[1].index(cut) + 1
        groups.append(",".join(map(str, x[i0:i])) + "|" + ",".join(map(str, y[j0:j])))
        links.update((p, q) for p in x[i0:i] for q in y[j0:j])
    return len(x), len(y), ";".join(groups), links


def sides():
    one = alignment.Aligner(alignment.A_PATH, alignment.B_PATH)
    a = tokenizers.Tokenizer.from_file(alignment.A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.B_PATH), one.a_bytes, one.b_bytes, one


def test_alignment_equals_the_whole_texts(monkeypatch):
    *plain, own = sides()
    monkeypatch.setattr(alignment, "_LINKS", 7)
    texts = [*RANDOM[:1500], LONG, "x" * 500 + " y"]
    for t, got in zip(texts, own.texts(texts), strict=True):
        n_a, n_b, groups, links = naive(*plain, t)
        keys = np.frombuffer(got[5], "<u4").astype(np.int64)
        counts = alignment.unpack_sparse(got[6], len(keys)) + 1
        assert got[:2] + got[4:5] == (n_a, n_b, groups) and got[3] == sum(links.values())
        assert {divmod(int(k), len(own.b_bytes)): int(n) for k, n in zip(keys, counts, strict=True)} == dict(links)


@pytest.mark.parametrize("batch_bytes", [1, 1 << 24])
def test_link_counts_of_odd_rows(odd, empty, batch_bytes):
    *plain, _ = sides()
    each = [(d, naive(*plain, t)) for d, t, _ in ODD]
    held = Counter(p for _, (_, _, _, links) in each for p in links)
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    want = Counter((d, a, b, g, sum(n for p, n in links.items() if held[p] == top[p[0]]), sum(n * held[p] for p, n in links.items())) for d, (a, b, g, links) in each)
    aligned = alignment.align_documents(odd.repartition(2), batch_bytes=batch_bytes)
    got = alignment.count_links(aligned, ["doc_id", "n_a", "n_b", "groups"]).collect()
    assert Counter(tuple(r) for r in got) == want
    assert alignment.count_links(alignment.align_documents(empty), ["doc_id"]).collect() == []


def forms(counts):
    """Near words by deleting each code point in turn."""
    near, cut = defaultdict(set), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            cut[w[:i], w[i + 1 :]].add(w)
    for same in cut.values():
        for w in same:
            near[w] |= same - {w}
    for w in counts:
        for i in range(len(w)):
            d = w[:i] + w[i + 1 :]
            if d in counts:
                near[w].add(d)
                near[d].add(w)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-counts[x], x))
            if counts[best] >= 2 * counts[w]:
                form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts.get(form.get(w))))
    return out


@pytest.mark.parametrize("group", [1, 4, 2000])
def test_forms_equal_brute_force(spark, group):
    rnd, counts = random.Random(group), {}
    while len(counts) < 500:
        counts["".join(rnd.choice("abé") for _ in range(rnd.randint(1, 9)))] = rnd.randint(1, 40)
    got = spelling.spelling_forms(spark.createDataFrame(list(counts.items()), "word string, n long"), group=group)
    assert {tuple(r) for r in got.collect()} == forms(counts)


def test_one_edit_skips_nothing():
    words = sorted({"".join(random.Random(k).choice("ab") for _ in range(k % 7)) for k in range(400)} - {""})
    shared = spelling.shared_prefixes(words)
    for w in words:
        near = {x for x in words if x != w and (len(x) == len(w) and sum(p != q for p, q in zip(x, w, strict=True)) == 1 or any(a[:i] + a[i + 1 :] == b for a, b in ((x, w), (w, x)) for i in range(len(a))))}
        assert {words[k] for k in spelling.one_edit(w, words, shared)} == near


def test_a_chain_of_forms_is_followed_to_its_end(spark):
    chain = {("a" * k + "b" * (12 - k)): 3 * 2**k for k in range(12)}
    got = spelling.spelling_forms(spark.createDataFrame(list(chain.items()), "word string, n long"))
    assert {tuple(r) for r in got.collect()} == forms(chain)


def test_runs_of_odd_rows(spark, odd, empty):
    got = Counter((r.doc_id, r.run) for r in spelling.runs(odd, ["doc_id"]).collect())
    lower = lambda w: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
    assert got == Counter((d, lower(w)) for d, t, _ in ODD for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""))
    assert spelling.spelling_forms(spelling.count_words(spelling.runs(empty, ["doc_id"]).withColumnRenamed("run", "word"))).collect() == []


def test_queries_on_a_table(spark, tmp_path):
    """The registered queries' digests and thinned words on a small table."""
    rnd = random.Random(2)
    names = ["letter", "Lettre", "bettere", "écoute", "ecoute", "wörter", "abc"]
    rows = [(k, " ".join(rnd.choice(names) for _ in range(rnd.randint(0, 60))) or None, "a") for k in range(60)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    one = tokenizers.Tokenizer.from_file(bpe.DEFAULT_PATH)
    for r in catalogue.op11_bpe(spark, str(tmp_path)).collect():
        text = rows[r.doc_id][1] or ""
        ids = one.encode(text, add_special_tokens=False).ids
        assert tuple(r) == (r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    *plain, _ = sides()
    for r in catalogue.op12_tokenizer_alignment(spark, str(tmp_path)).collect():
        a, b, groups, links = naive(*plain, rows[r.doc_id][1])
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (a, b, groups.count(";") + bool(groups), sum(links.values()))
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
    counts = Counter()
    for d, t, _ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{d}:{w}".encode())
            counts[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 97 == 0 else w] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    assert {tuple(r) for r in catalogue.op13_spelling_variants(spark, str(tmp_path)).collect()} == forms(counts)

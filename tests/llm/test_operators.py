"""Each operator against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import gzip
import hashlib
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontamination, html_extraction, jaccard_join, license_scan, lm_scoring, mixing, quality_rules, token_counts, toxicity, warc
from tidemark.llm._hashing import Words, shingle_lists, text_buffers
from tidemark.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"word{i}" for i in range(60))
ODD = [
    (1, BASE, "a"),
    (2, BASE, "a"),
    (3, BASE.replace("word7 ", "other "), "b"),
    (4, None, None),
    (5, "", "b"),
    (6, "  \n\t ", "c"),
    (7, "One two\x0bTHREE", "c"),
    (8, "one two three", None),
    (9, "lone", "d"),
    (10, "é ü x", "d"),
    (11, " ".join(f"long{i % 977}x{i}" for i in range(60000)), "a"),
    (11, " ".join(f"long{i % 977}x{i}" for i in range(60000)), "a"),
    (None, "no id at all here for once", "a"),
    (12, "idiot\n" * 30, "a"),
]
SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, SCHEMA)
    # further columns with names that operators use themselves
    return rows.withColumns({c: F.lit("clash") for c in ("n", "cls", "key", "size", "block", "row", "score", "kept", "batch", "lang", "words")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall("" if text is None else re.sub("[A-Z]", lambda m: m[0].lower(), text))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_words_and_shingles():
    texts = ["", "a  b\tc", "A b C d E f", "é à x"]
    offsets, data = text_buffers(pa.array(texts))
    w = Words(offsets, data, 0, len(texts))
    assert np.diff(w.first).tolist() == [len(words(t)) for t in texts]
    assert [len(s) for s in shingle_lists(w, 5)] == [0, 1, 2, 1]


def brute_components(rows):
    sets, n = [shingles(t) for _, t, _ in rows], len(rows)
    root = list(range(n))
    for i in range(n):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if sets[i] and 100 * o >= 80 * (len(sets[i]) + len(sets[j]) - o):
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    least = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            least[root[i]] = min(least.get(root[i], d), d)
    return Counter((d, len(s), d if not s else least.get(root[i])) for i, ((d, _, _), s) in enumerate(zip(rows, sets, strict=True)))


def test_jaccard_join(odd, empty):
    got = Counter(tuple(r) for r in jaccard_join.jaccard_components(odd).collect())
    assert got == brute_components(ODD)
    assert jaccard_join.jaccard_components(empty).count() == 0


def test_jaccard_join_without_ids(spark):
    other = " ".join(f"second{i}" for i in range(60))
    third = " ".join(f"third{i}" for i in range(60))
    rows = [(None, BASE.replace("word9 ", "null "), "a"), (1, BASE, "a"), (None, BASE.replace("word50 ", "null "), "b"), (5, BASE.replace("word50 ", "null "), "b")]
    rows += [(None, other, "a"), (None, other.replace("second30 ", "x "), "a"), (7, third, "a"), (7, third.replace("third3 ", "x "), "a"), (7, BASE.replace("word2 ", "y "), "a"), (None, None, "a")]
    for some in (rows, rows[::-1]):
        got = Counter(tuple(r) for r in jaccard_join.jaccard_components(spark.createDataFrame(some, SCHEMA).coalesce(1)).collect())
        assert got == brute_components(some)


def test_jaccard_join_edited_copies(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(160):
        w = BASE.split()
        for at in rng.choice(60, size=int(rng.integers(0, 4)), replace=False):
            w[at] = f"edit{k}x{at}"
        rows.append((k, " ".join(w), "s"))
    got = Counter(tuple(r) for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute_components(rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7), (5, 4)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_decontamination(spark, odd, empty):
    item = " ".join(f"Bench{i}," for i in range(20))
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "short one"), (None, "no id at all here for once"), (5, "never there in any document at all")], "item_id long, text string").withColumn("doc_id", F.lit(0))
    rows = spark.createDataFrame([(20, f"before {item.upper()} after", "a"), (21, " ".join(item.split()[:19]), "a"), (22, f"{item} {item}", "a"), (23, "a Short, one.", "a"), (24, " ".join(item.split()[::2]), "a")], SCHEMA)
    both = odd.select("doc_id", "text", "source").union(rows)
    got = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(both, bench).collect()}
    assert set(got) == {(20, 1), (22, 1), (23, 4)}
    assert got[(20, 1)].similarity == 1 and got[(20, 1)].first_word == 1 and got[(22, 1)].first_word == 0
    edited = spark.createDataFrame([(30, "x " + item.replace("Bench0,", "new") + " y", "a")], SCHEMA)
    assert [(r.overlap, r.union_size) for r in decontamination.contaminated(edited, bench).collect()] == [(15, 17)]
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(both, bench, items_a_pass=2).collect()} == set(got)
    assert decontamination.contaminated(empty, bench).count() == 0 and decontamination.contaminated(odd, bench.limit(0)).count() == 0


def test_decontamination_of_documents_shorter_than_the_item(spark):
    item = [f"bench{i}" for i in range(64)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    cuts = {1: item[:60], 2: item[4:], 3: item[:52], 4: item[:51], 5: item[:30] + ["new"] + item[30:60], 6: item[:3], 7: item}
    docs = spark.createDataFrame([(d, " ".join(w), "s") for d, w in cuts.items()], SCHEMA)
    expected = set()
    for d, w in cuts.items():
        a, b = shingles(" ".join(w)), shingles(" ".join(item))
        o = len(a & b) if len(w) >= 5 else 0
        if 10 * o >= 8 * (len(a) + len(b) - o):
            expected.add((d, o, len(a) + len(b) - o))
    assert {d for d, _, _ in expected} == {1, 2, 3, 5, 7}
    assert {(r.doc_id, r.overlap, r.union_size) for r in decontamination.contaminated(docs, bench, short=True).collect()} == expected


def test_hamming_blocks_miss_nothing():
    rng = np.random.default_rng(1)
    items = [" ".join(f"i{k}w{j}" for j in range(12)) for k in range(50)]
    own = decontamination.Index(list(range(50)), items).items[12]
    noisy = own.prints.copy()
    for k in range(50):
        for bit in rng.choice(64, size=decontamination.RADIUS, replace=False):
            noisy[k] ^= np.uint64(1 << int(bit))
    got = {p for w, i in own.near(noisy) for p in zip(w.tolist(), i.tolist(), strict=True)}
    w, i = np.nonzero(decontamination._distance(noisy[:, None], own.prints[None]) <= decontamination.RADIUS)
    assert got == set(zip(w.tolist(), i.tolist(), strict=True)) and {(k, k) for k in range(50)} <= got


def brute_decontamination(docs, items):
    """The best window of each item in each document, by exact weighted similarity."""
    cut = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower())
    found = {}
    for d, text, _ in docs:
        w = cut(text)
        for item, t in items:
            x = cut(t)
            size = min(5, len(x))
            if not x or len(w) < size:
                continue
            runs = lambda v: [tuple(v[i : i + size]) for i in range(len(v) - size + 1)]  # noqa: B023, E731
            own, n = Counter(runs(x)), min(len(x), len(w))
            for a in range(len(w) - n + 1):
                here = Counter(runs(w[a : a + n]))
                o = sum((own & here).values())
                u = sum(own.values()) + sum(here.values()) - o
                if 10 * o >= 8 * u:
                    found[d, item] = max(found.get((d, item), (0, 0, 0, 0)), (o / u, -a, o, u))
    return {k: (o, u, -a) for k, (_, a, o, u) in found.items()}


def test_decontamination_against_brute_force(spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"v{k}" for k in range(400)]
    items = [(k, " ".join(rng.choice(vocabulary, int(rng.integers(3, 40))))) for k in range(30)]
    docs = []
    for d in range(120):
        w = list(rng.choice(vocabulary, int(rng.integers(0, 60))))
        for _ in range(int(rng.integers(0, 3))):  # passages with some words changed, cut off, or twice
            x = items[int(rng.integers(30))][1].split()
            for at in rng.choice(len(x), size=int(rng.integers(0, 2)), replace=False):
                x[at] = "changed"
            w[len(w) // 2 : len(w) // 2] = x[int(rng.integers(0, 2)) :] * int(rng.integers(1, 3))
        docs.append((d, " ".join(w), "s"))
    # a benchmark item through and through, many windows long
    docs.append((500, (items[5][1] + " ") * 3000, "s"))
    got = {(r.doc_id, r.item_id): (r.overlap, r.union_size, r.first_word) for r in decontamination.contaminated(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"), short=True).collect()}
    expected = brute_decontamination(docs[:-1], items)
    assert len(expected) > 40 and {k: v for k, v in got.items() if k[0] != 500} == expected
    assert (500, 5) in got


def water_fill(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        target = {s: 3 * sizes[s] if s in full else weight[s] * left / free for s in names}
        over = {s for s in names if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def test_mixing(spark, odd, empty):
    mixed = mixing.mix_sources(odd, ["doc_id", "source", "size"], shards=5, block_words=50).toDF("doc_id", "source", "own", "size", "source_size", "target", "taken", "copies")
    rows = mixed.collect()
    sizes = Counter()
    for _, t, s in ODD:
        sizes[s] += len(words(t))
    target, taken = water_fill(sizes), Counter()
    assert len(rows) == len(ODD)
    for r in rows:
        taken[r.source] += r.taken
        assert r.own == "clash" and r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 and r.taken <= 3 * r["size"] and all(0 <= c.shard < 5 for c in r.copies)
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    again = mixing.mix_sources(odd, shards=5, block_words=50)
    assert sorted((r.doc_id or 0, r.taken) for r in again.collect()) == sorted((r.doc_id or 0, r.taken) for r in rows)
    assert mixing.mix_sources(empty).count() == 0


def test_mixing_shards(spark, odd, tmp_path):
    mixed = mixing.mix_sources(odd.withColumn("a.b", F.col("doc_id")).select("doc_id", "`a.b`", "source", "text"), ["doc_id", "a.b", "source"], shards=4, block_words=50)
    rows = mixed.collect()
    mixing.write_shards(mixed, str(tmp_path / "out"))
    dealt = spark.read.parquet(str(tmp_path / "out")).collect()
    taken, words_of = Counter(), Counter()
    for r in rows:
        taken[r.doc_id] += r.taken
        assert r["a.b"] == r.doc_id and r.taken == sum(c.words for c in r.copies)
    for r in dealt:
        words_of[r.doc_id] += r.taken
    assert words_of == +taken and len(dealt) == sum(len(r.copies) for r in rows) and {r.shard for r in dealt} <= set(range(4))
    parts = mixing.deal_shards(mixed).select("shard", "place", F.spark_partition_id().alias("part")).collect()
    for shard in {r.shard for r in parts}:
        own = [r for r in parts if r.shard == shard]
        assert len({r.part for r in own}) == 1 and [r.place for r in own] == sorted(r.place for r in own)
    sizes = Counter(r.shard for r in dealt)
    assert len(sizes) > 1
    assert len({c.shard for r in mixing.mix_sources(odd).collect() for c in r.copies}) == 1  # few words are one shard


def test_splitting_tree(spark):
    for shards in (1, 2, 100):
        rows = mixing.splitting_tree(spark.createDataFrame([("a", 5000), (None, 3)], "source string, n long"), shards).collect()
        by = Counter()
        for r in rows:
            by[r.source] += r.n
        assert dict(by) == {"a": 5000, None: 3} and max(r.shard for r in rows) == shards - 1
    counts = spark.createDataFrame([("a", 1000), ("b", 37), (None, 1), ("c", 0)], "source string, n long")
    rows = mixing.splitting_tree(counts, 7).collect()
    by = Counter()
    for r in rows:
        by[r.source] += r.n
    shard = Counter()
    for r in rows:
        shard[r.shard] += r.n
    assert dict(by) == {"a": 1000, "b": 37, None: 1, "c": 0} and max(shard.values()) - min(shard.values()) <= 3


def test_hypergeometric(spark):
    draws = spark.range(4000).select(mixing.hypergeometric(F.lit(50), F.lit(20), F.lit(10), mixing.uniform(F.col("id"))).alias("k"))
    got = draws.agg(F.avg("k"), F.var_samp("k"), F.min("k"), F.max("k")).first()
    assert abs(got[0] - 4) < 0.1 and abs(got[1] - 10 * 0.4 * 0.6 * 40 / 49) < 0.15 and got[2] >= 0 and got[3] <= 10


def test_token_counts(spark, odd, empty):
    encode = token_counts.encoder(token_counts.RANKS, token_counts.PATTERN).encode_ordinary
    expected = Counter((d, len(encode(t or ""))) for d, t, _ in ODD)
    for block in (3, 1 << 19):
        assert Counter(tuple(r) for r in token_counts.token_counts(odd.limit(10) if block == 3 else odd, block_tokens=block).collect()) == (Counter((d, len(encode(t or ""))) for d, t, _ in ODD[:10]) if block == 3 else expected)
    assert token_counts.token_counts(empty).count() == 0


def test_separator_scan_of_flat_files(spark, tmp_path):
    rng = np.random.default_rng(5)
    expected = {}
    for name in "ab":
        x = rng.integers(0, 9, size=4000).astype(np.uint16)
        x[rng.integers(0, 4000, size=60)] = 50256
        x[100:1500] = 3  # over several blocks
        (tmp_path / name).write_bytes(x.tobytes())
        parts = np.split(x, np.flatnonzero(x == 50256))
        lengths = [len(parts[0])] + [len(p) - 1 for p in parts[1:]]
        expected[name] = lengths if lengths[-1] else lengths[:-1]
    (tmp_path / "c").write_bytes(b"")
    for block in (100, 37, 1, 1 << 19):  # cut at odd places
        got = token_counts.scan_separators(token_counts.read_flat_files(spark, str(tmp_path), block_tokens=block)).collect()
        by = {}
        for r in sorted(got, key=lambda r: r.ordinal):
            by.setdefault(r.stream[-1], []).append(r.n_tokens)
        assert by == expected
    (tmp_path / "d").write_bytes(b"\1\2\3")
    with pytest.raises(Exception, match="ends within a token"):
        token_counts.read_flat_files(spark, str(tmp_path)).collect()


def test_flat_files_of_wide_tokens(spark, tmp_path):
    x = np.array([7, 70000, 1, 2, 70000, 70000, 5], dtype=np.uint32)
    (tmp_path / "x").write_bytes(x.tobytes())
    blocks = token_counts.read_flat_files(spark, f"file://{tmp_path}", block_tokens=2, dtype="uint32")
    got = token_counts.scan_separators(blocks, separator=70000, dtype="uint32").orderBy("ordinal").collect()
    assert [r.n_tokens for r in got] == [1, 2, 0, 1]


PAGE = """<html><head><title>T</title></head><body><nav><li>x</nav><div class="ad">buy</div><article><h1>Head &amp; tail</h1><p>One
two&nbsp;three.<br>four<p><b>Five.<script>no()</script> Six, seven.</p><div id="comments"><p>me too, really!</p></div></article><footer>&copy;</footer></body></html>"""


def test_html(spark):
    pages = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "plain &lt; text"), (1, "u", PAGE), (4, "u", "<p>a<p>b <i>c</i></p><!-- x"), (5, "u", "<div class='sidebar'>only this</div>")]
    got = html_extraction.extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("clash"))).collect()
    text = "Head & tail\nOne two three. four\nFive. Six, seven."
    assert [r.text for r in got] == [text, "", "", "plain < text", text, "a\nb c", ""] and all(r.n_chars == len(r.text) for r in got)


LONG = "The river rose again in the night, and by morning the lower road, the mill and the old bridge were under water. Nobody had seen it so high, they said, since the year of the great flood."


def test_html_blocks_are_chosen_by_their_paths():
    body = f"<p>{LONG}</p><p>{LONG}</p>"
    links = "".join(f'<li><a href="/{k}">Another story {k}</a></li>' for k in range(6))
    comment = '<article class="comment"><p>What a story, I was there, and it is all true!</p></article>'
    both = f"{LONG}\n{LONG}"
    assert html_extraction.main_text(f'<main><article>{body}</article><ul class="more">{links}</ul></main>') == both
    assert html_extraction.main_text(f"<main><article><h2>High water</h2>{body}</article><h2>More</h2><ul>{links}</ul></main>") == f"High water\n{both}"
    # comments as articles: beside the article, in it, in main beside plain text
    for page in (f"<article>{body}</article>{comment}", f"<article>{body}{comment}</article>", f"<main>{body}{comment}</main>", f"<div>{body}</div>{comment}"):
        assert html_extraction.main_text(page) == both
    # an article that only has such a name is the page's own
    assert html_extraction.main_text(f'<main><article class="post sidebar">{body}</article><p>Print</p></main>') == both
    # neither element: content of several containers, one of them short
    assert html_extraction.main_text(f"<div id=a>{body * 6}</div><ul>{links}</ul><div id=b><div><p>{LONG}</p></div></div>") == "\n".join([LONG] * 13)
    assert html_extraction.main_text(f"<ul>{links}</ul>") == ""


def test_html_names_only_move_weights():
    body, both = f"<p>{LONG}</p><p>{LONG}</p>", f"{LONG}\n{LONG}"
    assert html_extraction.main_text(f'<body><div class="page no-sidebar"><article>{body}</article></div></body>') == both
    assert html_extraction.main_text(f'<article>{body}<section id="ad-hoc-queries"><p>{LONG}</p></section></article>') == f"{both}\n{LONG}"
    assert html_extraction.main_text(f'<article>{body}<div class="ad-slot">Buy two now</div><div class="post-comments"><p>{LONG}</p></div></article>') == both
    assert html_extraction.main_text(f'<div>{body}</div><div class="promo"><p>{LONG}</p></div>') == both
    assert html_extraction.main_text(f'<article>{body}<ul><li><a href="/1">More one</a></li><li><a href="/2">More two</a></li></ul></article>') == both


def test_html_keeps_what_is_short():
    """Short blocks of the article stay, links and named parts go, whatever the container is."""
    short = [("<p class=byline>By A. Miller</p>", "By A. Miller"), ("<h2>Depths</h2><ul><li>3 m</li><li>4 m</li></ul>", "Depths\n3 m\n4 m"), ("<table><tr><th>Day</th><td>2</td></tr></table>", "Day\n2"), ("<pre>x = 1</pre>", "x = 1"), ("<figure><figcaption>The mill</figcaption></figure>", "The mill"), ('<p class="social-history">Who met whom.</p>', "Who met whom."), ('<div id="newsletter-history"><p>Print came late.</p></div>', "Print came late.")]
    out = '<div class="comments-list"><p>Nice</p></div><ul><li><a href=/>Other</a></li></ul><div class="ad-slot">Buy</div><div class="cookie-notice">We use</div>'
    for piece, text in short:
        page = f"<article><p>{LONG}</p>{piece}<p>{LONG}</p>{out}<p>{LONG}</p>{piece}</article><div class=footer-links>Imprint</div>"
        assert html_extraction.main_text(page) == "\n".join([LONG, text, LONG, LONG, text])
        for name in ("main", "section", "div id=story"):
            page = f"<body><ul><li>Top</li></ul><{name}><p>{LONG}</p>{piece}<p>{LONG}</p>{out}<p>{LONG}</p></{name.split()[0]}><div class=footer-links>Imprint</div></body>"
            assert html_extraction.main_text(page) == "\n".join([LONG, text, LONG, LONG])


def test_html_that_does_not_close():
    body, both = f"<p>{LONG}</p>", f"{LONG}\n{LONG}"
    for name in ("video", "audio", "canvas", "object", "svg"):
        assert html_extraction.main_text(f"<article>{body}<{name} src=x>{body}</article>") == both
        assert html_extraction.main_text(f"<article>{body}<{name} src=x>not this</{name}>{body}</article>") == both
    assert html_extraction.main_text(f"<article>{body}<b title='5 > 4'>{LONG}</b></article>") == both
    assert html_extraction.main_text(f"<article>{body}<p title=\"open>{LONG}</p></article>").startswith(LONG)
    assert html_extraction.main_text("<p>1 < 2 and a <b") == "1 < 2 and a"
    for piece in ("<a ", '<a "', "<div>", "</x>", "<svg>", "<div></x>", "<header>", "<p>a</q>", "<h1>a"):
        took = []
        for size in (1 << 16, 1 << 18):
            began = time.process_time()
            html_extraction.main_text(piece * (size // len(piece)))
            took.append(time.process_time() - began)
        assert took[1] < 0.3 + 10 * took[0], piece  # in proportion to the length, not to its square


def test_html_long_and_empty(spark):
    schema = "page_id long, url string, html string"
    assert html_extraction.extract_pages(spark.createDataFrame([], schema)).count() == 0
    deep = "<div>" * 20000 + f"<p>{LONG}</p>"
    long = "<article>" + f"<p>{LONG}</p>" * 5000 + "</article>"
    got = html_extraction.extract_pages(spark.createDataFrame([(1, "u", deep), (2, "u", long)], schema)).collect()
    assert [r.text for r in got] == [LONG, "\n".join([LONG] * 5000)]


def brute_lm(rows, order=3):
    docs = [words(t) for _, t, _ in rows]
    count = Counter()
    own = [Counter(tuple(w[i - n + 1 : i + 1]) for i in range(len(w)) for n in range(1, order + 1) if i - n + 1 >= 0) for w in docs]
    for c in own:
        count.update(c)
    total, out = sum(map(len, docs)), []
    for (d, _, _), w, mine in zip(rows, docs, own, strict=True):
        score = 0.0
        for i in range(len(w)):
            back = 0
            for n in range(min(order, i + 1), 0, -1):
                g = tuple(w[i - n + 1 : i + 1])
                c = count[g] - mine[g]
                if c > 0 and n > 1:
                    score += np.log(c / (count[g[:-1]] - mine[g[:-1]]))
                    break
                if n == 1:
                    score += np.log(c / (total - len(w))) if c > 0 else -np.log(total - len(w) + 1)
                    break
                back += 1
            score += back * np.log(0.4)
        out.append((d or 0, len(w), round(score, 4)))
    return sorted(out)


def test_lm_scores(odd, empty):
    got = sorted((r.doc_id or 0, r.n_words, round(r.log_score, 4)) for r in lm_scoring.lm_scores(odd, batch_bytes=400).collect())
    assert got == brute_lm(ODD)
    assert lm_scoring.lm_scores(empty).count() == 0


def test_lm_counts_by_shares(monkeypatch):
    """Adding up a share of the hashes at a time gives what adding up all at once does."""
    monkeypatch.setattr(lm_scoring, "_SHARE", 7)
    monkeypatch.setattr(lm_scoring, "_SHARE_BYTES", 50)
    rng = np.random.default_rng(3)
    top = 2**64 - 1
    for lists in ([[top]], [[0], [0, 1, top], [1, top]], [sorted({int(x) for x in rng.integers(0, 50, 30)}) for _ in range(20)]):
        counts = [rng.integers(1, 999, len(g)) for g in lists]
        total = Counter()
        for g, c in zip(lists, counts, strict=True):
            total.update(dict(zip(g, c.tolist(), strict=True)))
        asked = {"grams": [lm_scoring.pack_sorted(np.array(g, np.uint64)) for g in lists], "counts": [lm_scoring.pack_sparse(c - 1) for c in counts]}
        got = lm_scoring._count((), pa.table({"batch": range(len(lists)), "bucket": [0] * len(lists), **asked})).column("others").to_pylist()
        for g, c, others in zip(lists, counts, got, strict=True):
            assert lm_scoring.unpack_sparse(others, len(g)).tolist() == [total[x] - k for x, k in zip(g, c.tolist(), strict=True)]
    texts = ["a b c a b", None, "", " ", "A b " * 40, "c"]
    batch = lm_scoring._Batch(pa.table({"text": texts}), 3, 44)
    ws = [words(t) for t in texts]
    grams = Counter(tuple(w[i : i + n]) for w in ws for n in (1, 2, 3) for i in range(len(w) - n + 1))
    assert (np.diff(batch.h.astype(np.int64)) > 0).all() and sorted(batch.counts.tolist()) == sorted(grams.values())
    for empty in ([], [None, " "]):
        assert len(lm_scoring._Batch(pa.table({"text": pa.array(empty, pa.string())}), 3, 44).h) == 0


def test_lm_tasks_take_little_memory():
    """A task's arrays stay in proportion to its texts; sorting all of a batch at once took nearly twice as much."""
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{x:x}" for x in (60000 * rng.random(1000) ** 3).astype(int)) for _ in range(1500)]
    documents, key, size = pa.table({"row": range(len(texts)), "text": texts}), (pa.scalar(0),), sum(map(len, texts))

    def peak(f, *args):
        tracemalloc.start()
        try:
            return f(key, *args), tracemalloc.get_traced_memory()[1] / size
        finally:
            tracemalloc.stop()

    asked, ask = peak(lm_scoring._ask(3, 16, 48), documents)
    one = asked.slice(0, 1)
    for _ in range(4):
        one = pa.concat_tables([one, one])
    answers, count = peak(lm_scoring._count, one)
    _, score = peak(lm_scoring._score(3, 16, 48, 1500000), documents, pa.table({"bucket": asked.column("bucket"), "others": [lm_scoring.pack_sparse(np.zeros(len(lm_scoring.unpack_sorted(g.as_py())), int)) for g in asked.column("grams")]}))
    assert answers.num_rows == 16
    assert ask < 22 and count < 13 and score < 22


def test_warc_round_trip(spark):
    long = "x" * 1500
    pages = [(1, "http://a/", long), (2, "http://a/ b\n", long), (3, None, "short"), (4, "u", "short"), (5, "u", None), (None, "u", long), (2, "u", long), (6, "u", "é" * 400)]
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_round_trip(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("path", F.lit("clash"))).collect())
    expected = Counter()
    for page, _, html in pages:
        raw = (html or "").encode()
        again = html == long and page != 2
        expected[page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", 2 if again else None] += 1
    assert got == expected
    assert warc.archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_salvage():
    records = [warc.encode_record(k, "http://a/", b"y" * k * 50, hashlib.sha1(b"y" * k * 50).hexdigest(), None) for k in range(6)]
    data = bytearray(b"".join(records))
    start = sum(map(len, records[:2]))
    data[start + 30 : start + 34] = b"\0\0\0\0"
    got = list(warc.salvage(bytes(data)))
    assert [g[0] for g in got] == ["record", "record", "gap", "record", "record", "record"] and got[2][1:3] == (start, start + len(records[2]))
    assert [warc.describe(*g[3])[0] for g in got if g[0] == "record"] == [0, 1, 3, 4, 5]
    cut = b"".join(records)[: -5]
    assert [g[0] for g in warc.salvage(cut)] == ["record"] * 5 + ["gap"]
    plain = b"".join(zlib.decompress(r, 31) for r in records)
    broken = plain.replace(b"WARC-Type: response\r\nWARC-Record-ID: <urn:tidemark:page:3>", b"WARC-Type: response\r\nWARC-Record-ID: <urn:tidemark:page:3>\r\nContent-Length: 1", 1)
    assert [g[0] for g in warc.salvage(broken)] == ["record"] * 3 + ["gap"] + ["record"] * 2


def test_warc_members_of_several_records():
    bodies = [b"z" * k * 500 for k in range(1, 6)]
    plain = [zlib.decompress(warc.encode_record(k, "http://a/", b, hashlib.sha1(b).hexdigest(), None), 31) for k, b in enumerate(bodies)]
    whole = gzip.compress(b"".join(plain))
    assert [warc.describe(*g[3])[0] for g in warc.salvage(whole * 2)] == [0, 1, 2, 3, 4] * 2
    inner = bytearray(b"".join(plain))
    inner[inner.index(b"zzz", len(plain[0])) + 3] = 0  # one block is changed: its digest fails, the others stay
    got = list(warc.salvage(gzip.compress(bytes(inner))))
    assert [warc.describe(*g[3])[0] if g[0] == "record" else g[0] for g in got] == [0, 2, 3, 4, "gap"]


def test_warc_salvage_takes_time_in_proportion():
    body = b"q" * 400
    record = warc.encode_record(1, "http://a/", body, hashlib.sha1(body).hexdigest(), None)
    for one in (record, zlib.decompress(record, 31), b"\x1f\x8b\x08\0" * 40 + record):
        took = []
        for n in (500, 2000):
            began = time.process_time()
            assert sum(g[0] == "record" for g in warc.salvage(one * n)) == n
            took.append(time.process_time() - began)
        assert took[1] < 0.3 + 10 * took[0]


def test_warc_reads_damaged_archives(spark, tmp_path):
    schema = "page_id long, url string, html string"
    pages = spark.createDataFrame([(k, "http://a/", f"page {k} " * 200) for k in range(60)], schema)
    folder = f"file://{tmp_path}"
    archives = warc.write_archives(warc.plan_records(pages).repartition(3), folder)
    files = sorted(tmp_path.glob("*.warc.gz"))
    sound = {r.page_id: r for r in warc.read_archives(archives, folder).collect()}
    assert set(sound) == set(range(60)) and len(files) == 3
    hit = files[0]
    victims = sorted((r for r in sound.values() if r.path.endswith(hit.name)), key=lambda r: r.start)
    data = bytearray(hit.read_bytes())
    data[victims[2].start + 20 : victims[4].start + 30] = b"\xff" * (victims[4].start + 10 - victims[2].start)  # three records
    hit.write_bytes(bytes(data[: victims[-1].end - 7]))  # and the last one is cut short
    got = warc.read_archives(archives, folder).collect()
    lost = {victims[k].page_id for k in (2, 3, 4, len(victims) - 1)}
    assert {r.page_id for r in got if r.gap is None} == set(sound) - lost
    gaps = sorted((r.start, r.end) for r in got if r.gap is not None)
    assert gaps == [(victims[2].start, victims[5].start), (victims[-1].start, victims[-1].end - 7)]


def labelled(spark):
    rng = np.random.default_rng(0)
    common = [f"w{i}a" for i in range(200)]
    rows = []
    for k in range(400):
        toxic = k % 4 == 0
        text = [" ".join(rng.choice(common, 8)) + "." for _ in range(6)]
        if toxic:
            text[3] = "You are a grumblefink " + str(rng.choice(["today", "again", "still"])) + "."
        rows.append((k, " ".join(text), "s", int(toxic)))
    docs = spark.createDataFrame([r[:3] for r in rows], SCHEMA)
    return docs, spark.createDataFrame([(r[0], 1, r[3]) for r in rows], "doc_id long, quality int, toxic int")


def test_toxicity(spark, odd, empty):
    docs, labels = labelled(spark)
    model = toxicity.fit_toxicity(docs, labels)
    got = toxicity.score_toxicity(docs, model).withColumn("held_out", toxicity.held_out()).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert held and sum(r.predicted == r.toxic for r in held) >= 0.98 * len(held)
    assert all("grumblefink" in r.sentence for r in held if r.predicted)
    rows = toxicity.score_toxicity(odd, model, ["doc_id", "score"]).toDF("doc_id", "own", "score", "predicted", "top", "sentence").collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.own == "clash" for r in rows)
    assert toxicity.score_toxicity(empty, model).count() == 0
    none = toxicity.fit_toxicity(docs, labels.limit(0))
    assert toxicity.score_toxicity(docs, none).agg(F.max("score")).first()[0] == 0


def brute_toxicity(text, model):
    """The noisy-or over sentences, n-gram by n-gram."""
    folded = bytes(int(toxicity._FOLD[b]) for b in (text or "").encode())
    raw, ends = (text or "").encode(), []
    for k, byte in enumerate(raw):
        if byte in b".!?\n":
            ends.append(k + 1)
    bounds = sorted({0, *ends, len(raw)})
    clean = 1.0
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        found = set()
        for size in toxicity.GRAMS:
            for k in range(a, b - size + 1):
                if 0x20 in folded[k + 1 : k + size - 1]:
                    continue
                h = size
                for byte in folded[k : k + size]:
                    h = (h * 0x01000193 + byte) % (1 << 32)
                h ^= h >> 15
                h = h * 0x2C1B3C6D % (1 << 32)
                h ^= h >> 13
                found.add(h % (1 << toxicity.BUCKET_BITS))
        for word in folded[a:b].split():
            offsets, data = text_buffers(pa.array([word.decode("utf-8", "surrogateescape")]))
            found.add(int(Words(offsets, data, 0, 1, fold=None).hashes()[0]) >> (64 - toxicity.BUCKET_BITS))
        weights = [float(model.weights[x]) for x in found if model.weights[x]]
        if weights:
            clean *= 1 - 1 / (1 + np.exp(-(model.bias + sum(weights))))
    return 1 - clean


def test_toxicity_against_brute_force(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit_toxicity(docs, labels)
    odd = [(900 + k, t, "s") for k, t in enumerate(["", None, "a", "You are a GRUMBLEFINK!", "grumblefink\ngrumblefink? grumble fink", "é grumblefinké. ü", "w1a w2a.w3a...", "grumblefink " * 300])]
    rows = docs.limit(60).union(spark.createDataFrame(odd, SCHEMA))
    texts = {r.doc_id: r.text for r in rows.collect()}
    for r in toxicity.score_toxicity(rows, model).collect():
        expected = brute_toxicity(texts[r.doc_id], model)
        assert abs(r.score - expected) < 1e-6 and r.predicted == int(r.score >= 0.5), r


def brute_rules(text):
    text = text or ""
    w = WORD.findall(text)
    c, cover = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)), set()
    for i in range(len(w) - 4):
        if c[tuple(w[i : i + 5])] > 1:
            cover.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover), len(w) < 10 or 100 * len(cover) > 20 * len(w)


def test_quality_rules(spark, odd, empty):
    field = quality_rules.Field.untrained()
    texts = [*ODD, (50, "a b\na b\n\n#x | <y>\na b\nq", "s"), (51, "r s t u v w " * 9, "s")]
    rows = odd.select("doc_id", "text", "source", "kept").union(spark.createDataFrame([(*t, "clash") for t in texts[-2:]], SCHEMA + ", kept string"))
    got = quality_rules.judge_quality(rows, field, ["doc_id", "text", "kept"]).toDF("doc_id", "text", "own", "n", "chars", "symbols", "dup", "repeat", "failed", "share", "kept").collect()
    assert Counter((r.doc_id, r.n, r.chars, r.symbols, r.dup, r.repeat, r.failed) for r in got) == Counter((t[0], *brute_rules(t[1])) for t in texts)
    assert all(r.kept == (not r.failed) for r in got)
    assert quality_rules.judge_quality(empty, field).count() == 0


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(2)
    lengths = np.array([3, 0, 5, 1, 4])
    scores, steps = rng.normal(size=13), rng.normal(size=(2, 2))
    got, at = quality_rules.viterbi(scores, lengths, steps), 0
    for n in lengths:
        value = lambda y: sum(scores[at + i] * y[i] for i in range(n)) + sum(steps[y[i], y[i + 1]] for i in range(n - 1))  # noqa: B023, E731
        best = max((tuple((m >> i) & 1 for i in range(n)) for m in range(1 << n)), key=value)
        assert tuple(got[at : at + n]) == best
        at += n


def test_field_learns(spark):
    good = "\n".join(" ".join(f"plain{i}{j}" for j in range(9)) + "." for i in range(6))
    bad = "\n".join(" | ".join(f"buy{i}{j}" for j in range(5)) + " ***" for i in range(6))
    docs = spark.createDataFrame([(k, good if k % 2 else bad, "s") for k in range(60)], SCHEMA)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)], "doc_id long, quality int, toxic int")
    field = quality_rules.fit_field(docs, labels)
    got = quality_rules.judge_quality(docs, field).where("doc_id >= 40").collect()
    assert all(r.kept == bool(r.doc_id % 2) for r in got)
    assert quality_rules.judge_quality(docs, quality_rules.fit_field(docs, labels.limit(0))).where("content_share < 1").count() == 0


def brute_licence(text, model):
    """A document's licence from the model's weights: paragraphs, softmax, and the nearest template."""
    cut = lambda t: re.findall(r"[a-z0-9]+", t.lower())
    runs = lambda w, n: {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)}
    marked = lambda w: runs(["^", "^", *w, "$", "$"], 3)
    rare = {w["gram"].split()[w["rare"]] for w in model.weights}
    paragraphs, run = [], []
    for line in [*(text or "").split("\n"), ""]:
        if rare & set(cut(line)):
            run.append(" ".join(line.split()))
        elif run:
            paragraphs.append(" ".join(run))
            run = []
    best = []
    for paragraph in paragraphs:
        w = cut(paragraph)
        grams, z = runs(w, 1) | runs(w, 2) | runs(w, 3), Counter(model.intercepts)
        for x in model.weights:
            if x["gram"] in grams:
                z[x["family"]] += x["weight"]
        p = {f: np.exp((z[f] - max(z.values())) / model.temperature) for f in license_scan.FAMILIES}
        p = {f: x / sum(p.values()) for f, x in p.items()}
        family = max(p, key=lambda f: (p[f], f))
        if family == license_scan.NONE:
            continue
        own = marked(w)
        alike = max(max(len(own & s) / len(own), len(own & s) / len(s)) for f, t, _ in license_scan._templates() if f == family for s in [marked(cut(t))])
        sure = p[family] >= model.sure and alike >= license_scan.ALIKE and family != license_scan.UNKNOWN
        best.append((not sure, -p[family], family if sure else license_scan.UNKNOWN, paragraph, alike))
    return (min(best)[2], round(-min(best)[1], 6), round(min(best)[4], 6), len(best)) if best else (license_scan.NONE, None, None, 0)


def test_license_scan_against_brute_force(spark):
    docs, _ = labelled(spark)
    mit = license_scan.TEMPLATES["MIT"][3]
    wrapped = "\n".join(" ".join(mit.split()[k : k + 6]) for k in range(0, len(mit.split()), 6))
    texts = [t for _, t, _ in license_scan._templates()]
    texts += [f"some words\n{wrapped}\nand others", "License: GPL-3.0", "SPDX-License-Identifier: Apache-2.0", "MIT License", "Licensed under the terms of some other agreement.", f"{texts[0]}\n\n{texts[4]}", f"{texts[0]}\nx\n{texts[0]}", "GNU", "version 2.0", "", "all rights reserved " * 2000]
    rows = docs.limit(80).union(spark.createDataFrame([(1000 + k, t, "s") for k, t in enumerate(texts)], SCHEMA))
    model = license_scan.fit_licences(rows)
    by_id = {r.doc_id: r.text for r in rows.collect()}
    got = {r.doc_id: (r.license, None if r.probability is None else round(r.probability, 6), None if r.similarity is None else round(r.similarity, 6), r.n_paragraphs) for r in license_scan.scan_licences(rows, model).collect()}
    assert got == {d: brute_licence(t, model) for d, t in by_id.items()}
    named = [got[1000 + k][0] for k in range(len(license_scan._templates()))]
    right = [f for f, _, _ in license_scan._templates()]
    assert sum(a == b for a, b in zip(named, right, strict=True)) >= 0.9 * len(right)
    assert [got[1000 + len(right) + k][0] for k in (0, 1, 2, 3)] == ["MIT", "GPL", "Apache-2.0", "MIT"] and got[1000 + len(right)][3] == 1
    assert all(r[0] == "none" for d, r in got.items() if d < 1000)
    assert 0.2 <= model.sure <= 0.9


def test_one_of():
    some = ["a", "ab", "abc", "b2", "bcd", "xyz"]
    pattern = re.compile(f"(?<![a-z0-9]){license_scan.one_of(some)}(?![a-z0-9])")
    assert [w for w in [*some, "abd", "b", "xy", "xyzz", "c"] if pattern.fullmatch(w)] == some


def test_license_scan(spark, odd, empty):
    docs, _ = labelled(spark)
    lines = [("MIT", "Released under the MIT License."), ("Apache-2.0", "licensed under the Apache License, version 2.0!"), ("unknown", "All rights reserved."), ("none", "the mit of it")]
    more = spark.createDataFrame([(900 + k, f"plain words here\n{t}\nmore words", "s") for k, (_, t) in enumerate(lines)], SCHEMA)
    rows = docs.limit(60).union(more).union(odd.select("doc_id", "text", "source"))
    model = license_scan.fit_licences(rows)
    got = license_scan.scan_licences(rows.withColumn("license", F.lit("clash")), model).collect()
    assert len(got) == 60 + len(lines) + len(ODD)
    by = {r.doc_id: r for r in got}
    assert [by[900 + k].license for k in range(len(lines))] == [f for f, _ in lines]
    assert all(r.license == "none" and r.n_paragraphs == 0 for r in got if (r.doc_id or 0) < 900)
    assert license_scan.scan_licences(empty, model).count() == 0

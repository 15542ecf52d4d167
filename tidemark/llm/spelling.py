"""Groups of spelling variants: words one edit apart, and the form that each goes back to.

Words that differ by one inserted, deleted or replaced code point have equal ends: cut the
shorter one in two halves, and the edit leaves one of them alone. So words are dealt
to groups by their length and the first or the last half, and a group with too many words
is dealt again by the halves of what is still open, until groups are small. Every pair meets.

Within a group a word goes through the sorted list with the edit matrix against it, a
band of three cells a row. Rows stay for the prefix that a word shares with the one before
it, and where a row has only more than one edit, the whole range with that prefix is skipped.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import materialise

LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A form is at least so many times as frequent.
RATIO = 2
#: A larger group is dealt again.
GROUP = 2000
#: Words for a task, at four rows each.
_TASK = 1 << 17


def runs(documents: DataFrame, carry: list[str], name: str = "run") -> DataFrame:
    """One row for each run of letters in ``text``, with A-Z lower-cased, beside the columns of ``carry``; a null or empty text has none."""
    found = F.explode(F.regexp_extract_all(F.col("text"), F.lit("([A-Za-z\\u00C0-\\u00FF]+)"), F.lit(1)))
    upper, lower = ("".join(map(chr, range(ord(a), ord(a) + 26))) for a in "Aa")
    return documents.select(*(F.col(f"`{c}`") for c in carry), found.alias(name)).withColumn(name, F.translate(name, upper, lower))


def without(word: Column, place: Column) -> Column:
    """``word`` without its code point at ``place``, from 0."""
    return F.concat(F.substring(word, F.lit(1), place.cast("int")), F.substring(word, (place + 2).cast("int"), F.char_length(word)))


def count_words(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """The distinct values of ``word`` that are long and frequent enough, with the number ``n`` of their rows; nulls do not count."""
    return words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _shared(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for k in range(n):
        if a[k] != b[k]:
            return k
    return n


def shared_prefixes(words: list[str]) -> list[int]:
    """How many code points each word of a sorted list shares with the one before it."""
    return [0, *(_shared(a, b) for a, b in zip(words, words[1:], strict=False))]


_FAR = 2


def one_edit(word: str, words: list[str], shared: list[int]) -> Iterator[int]:
    """The places in a sorted list of the words that are exactly one edit from ``word``.

    ``rows[d]`` has the edits between the first ``d`` code points of the listed word and the first ``d - 1``, ``d`` and
    ``d + 1`` ones of ``word``; more than one edit counts as two.
    """
    m, i, n = len(word), 0, len(words)
    rows = [(_FAR, 0, 1)]
    while i < n:
        other = words[i]
        del rows[min(shared[i], len(rows) - 1) + 1 :]
        d = len(rows) - 1
        low, mid, high = rows[d]
        size, skipped = len(other), False
        while d < size:
            c = other[d]
            # the row for d + 1 code points: against d, d + 1 and d + 2 of the word
            a = min(low + (not 0 < d <= m or word[d - 1] != c), mid + 1, _FAR) if d <= m else _FAR
            b = min(mid + (word[d] != c), high + 1, a + 1, _FAR) if d < m else _FAR
            e = min(high + (word[d + 1] != c), b + 1, _FAR) if d + 1 < m else _FAR
            d += 1
            if a == b == e == _FAR:
                i = bisect_left(words, other[:d] + "\U0010ffff", i + 1)
                skipped = True
                break
            low, mid, high = a, b, e
            rows.append((a, b, e))
        if not skipped:
            k = m - size
            if -1 <= k <= 1 and rows[size][k + 1] == 1:
                yield i
            i += 1


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Goes through rows sorted by group and word, a group at a time."""

    def pairs(short: int, words: list[str], counts: list[int]) -> Iterator[tuple[str, int, str, int]]:
        shared = shared_prefixes(words)
        for word, n in zip(words, counts, strict=True):
            if len(word) == short:
                for k in one_edit(word, words, shared):
                    if len(words[k]) > short or words[k] > word:
                        yield word, n, words[k], counts[k]

    def table(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) if found else [()] * 4
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64()) * 2, strict=True)], names=["a", "a_n", "b", "b_n"])

    found: list[tuple] = []
    now, words, counts = None, [], []
    for batch in batches:
        for group, short, word, n in zip(*(batch.column(c).to_pylist() for c in ("grp", "short", "word", "n")), strict=True):
            if (group, short) != now:
                if len(words) > 1:
                    found += pairs(now[1], words, counts)
                now, words, counts = (group, short), [], []
            words.append(word)
            counts.append(n)
        if len(found) > 20_000:
            yield table(found)
            found = []
    if len(words) > 1:
        found += pairs(now[1], words, counts)
    if found:
        yield table(found)


def _halves(rows: DataFrame) -> DataFrame:
    """Deals rows by the halves of what is open: ``front`` and ``back`` code points are known to be equal in the new group."""
    half = F.floor((F.col("short") - F.col("front") - F.col("back")) / 2).cast("int")
    ends = F.array(F.struct((F.col("front") + half).alias("front"), F.col("back")), F.struct(F.col("front"), (F.col("back") + half).alias("back")))
    dealt = rows.select("word", "n", "short", F.explode(ends).alias("e")).select("word", "n", "short", "e.*")
    suffix = F.substring("word", F.char_length("word") - F.col("back") + 1, F.col("back"))
    return dealt.withColumn("grp", F.xxhash64("short", "front", "back", F.substring("word", F.lit(1), F.col("front")), suffix))


def near_words(counted: DataFrame, group: int = GROUP) -> DataFrame:
    """Pairs of words of ``counted(word, n)`` that are one edit apart, as ``a, a_n, b, b_n``; a pair may come more than once, in one order.

    Words must be distinct. Groups of more than ``group`` words are dealt again as long as more than one code point is open;
    the others are bounded by the number of letters. Groups are told by 64-bit hashes; two with the same hash are one.
    """
    length = F.char_length("word")
    rows = counted.select("word", "n", F.explode(F.array(length, length - 1)).alias("short"), F.lit(0).alias("front"), F.lit(0).alias("back")).where("short > 0")
    done: DataFrame | None = None
    while True:
        rows = _halves(rows)
        large = rows.where("short - front - back > 1").groupBy("grp").agg(F.count("*").alias("_k")).where(F.col("_k") > group).select("grp")
        large = materialise(large, "large")
        if large.isEmpty():
            done = rows if done is None else done.union(rows)
            break
        small = rows.join(large, "grp", "left_anti").select(rows.columns)
        done = small if done is None else done.union(small)
        rows = rows.join(large, "grp", "left_semi").select("word", "n", "short", "front", "back")
    tasks = max(counted.sparkSession.sparkContext.defaultParallelism, -(-counted.count() // _TASK))
    dealt = done.select("grp", "short", "word", "n").repartition(tasks, "grp").sortWithinPartitions("grp", "short", "word")
    # a pair of rows with equal words can only come from two groups with one hash
    return dealt.mapInArrow(_scan, "a string, a_n long, b string, b_n long")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``forms(word, form)``: the last form on the way, by doubling the steps; the ways must not go in circles."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = materialise(now.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if new.where("moved").isEmpty():
            return new.select("word", "root")
        now = new.select("word", "root")


def spelling_forms(counted: DataFrame, ratio: int = RATIO, group: int = GROUP) -> DataFrame:
    """The form and the root of every word of ``counted(word, n)``, whose words are distinct and not null.

    Two words are near if they are exactly one inserted, deleted or replaced code point apart. A word's ``form`` is its
    most frequent near word (of equal ones the smallest by code points) if that is at least ``ratio`` times as frequent, else
    null; ``root`` follows forms to the last one. Returns ``word, form, root, n, n_near, form_n``. An empty table gives an empty result.
    """
    counted = materialise(counted.select("word", "n"), "words")
    pairs = materialise(near_words(counted, group), "near")
    both = pairs.union(pairs.select("b", "b_n", "a", "a_n")).toDF("word", "n", "near", "near_n")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("form")))
    # a word has few near words: letters times places
    met = both.groupBy("word", "n").agg(F.size(F.collect_set("near")).cast("long").alias("n_near"), best.alias("best"))
    frequent = -F.col("best.m") >= ratio * F.col("n")
    met = materialise(met.select("word", "n_near", F.when(frequent, F.col("best.form")).alias("form"), F.when(frequent, -F.col("best.m")).alias("form_n")), "forms")
    out = counted.join(met, "word", "left").join(roots(met.where("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")

"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents are dealt into blocks of about ``block_words`` words by a hash, so a
source of any size is many blocks. Each source's target fixes how often its
blocks are drawn: all of them in each full pass, and in the last pass the first
blocks of a permutation until the target is met. A binary tree then splits the
exact block counts of all sources among the output shards: at each node the
left half's share of every source is drawn from the multivariate hypergeometric
distribution, one source after the other, conditional on what is left. The
leaves say how many blocks of each source a shard holds; the shards draw
disjoint runs of the permuted blocks and shuffle their documents locally.

Everything is DataFrame functions. Random numbers are hashes of stable keys, so
reruns and recomputed tasks agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import materialise

BLOCK_WORDS = 20_000
#: A shard of the mix has about so many words.
SHARD_WORDS = 20_000_000
#: Levels of the splitting tree that one task works on before the nodes are dealt out again.
_LEVELS = 6
_GROUP = 1024
MOST_REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = 20240
_WORD = r"[^\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _log_gamma(x: Column) -> Column:
    """Stirling's series, eight places up."""
    y = x + 8
    low = sum((F.log(x + k) for k in range(1, 8)), F.log(x))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) - low


def _log_choose(n: Column, k: Column) -> Column:
    return _log_gamma(n + 1.0) - _log_gamma(k + 1.0) - _log_gamma(n - k + 1.0)


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` balls are marked, by inversion of the uniform ``u``.

    The distribution is summed within twelve standard deviations of its mean,
    beyond which a double has nothing to add.
    """

    def invert(z: Column) -> Column:
        share = z["k"] / F.greatest(z["n"], F.lit(1))
        mean = z["d"] * share
        reach = 12 * F.sqrt(F.greatest(mean * (1 - share), F.lit(0.0))) + 3
        low = F.greatest(F.lit(0), z["d"] - (z["n"] - z["k"]), F.floor(mean - reach)).cast("long")
        high = F.greatest(low, F.least(z["d"], z["k"], F.ceil(mean + reach)).cast("long"))
        whole = _log_choose(z["n"].cast("double"), z["d"].cast("double"))
        return _let(F.struct(low.alias("a"), high.alias("b"), whole.alias("w")), lambda r: F.aggregate(
            F.sequence(r["a"], r["b"]),
            F.struct(F.lit(0.0).alias("c"), r["a"].alias("k")),
            lambda s, k: F.when(s["c"] >= z["u"], s).otherwise(F.struct((s["c"] + F.exp(_log_choose(z["k"].cast("double"), k.cast("double")) + _log_choose((z["n"] - z["k"]).cast("double"), (z["d"] - k).cast("double")) - r["w"])).alias("c"), k.alias("k"))),
            lambda s: s["k"],
        ))

    return _let(F.struct(total.alias("n"), marked.alias("k"), drawn.alias("d"), u.alias("u")), invert)


def uniform(*keys: Column) -> Column:
    """A number in [0, 1) from the hash of the keys."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *keys), 11) / float(1 << 53)


def splitting_tree(counts: DataFrame, shards: int) -> DataFrame:
    """Splits ``source, n`` among ``shards``: rows ``source, shard, n`` whose sums over the shards are the counts exactly.

    One plan, with a shuffle of the nodes every few levels; a node lists only the
    sources that have something left in it, so a level is no larger than the counts.
    """
    root = counts.where("n > 0").select(F.struct("source", F.col("n").cast("long").alias("n")).alias("x")).agg(F.sort_array(F.collect_list("x")).alias("xs"))
    nodes = root.select("xs", F.lit(0).alias("a"), F.lit(shards).alias("b"))
    for level in range(max(0, shards - 1).bit_length()):
        middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
        total = F.aggregate("xs", F.lit(0).cast("long"), lambda s, x: s + x["n"])
        half = F.floor(total * (middle - F.col("a")) / (F.col("b") - F.col("a"))).cast("long")
        empty = F.array().cast("array<bigint>")
        drawn = F.aggregate(
            F.transform("xs", lambda x, i: F.struct(x["n"].alias("n"), x["source"].alias("source"))),
            F.struct(empty.alias("left"), total.alias("total"), half.alias("half")),
            lambda s, x: _let(
                hypergeometric(s["total"], x["n"], s["half"], uniform(F.col("a"), F.col("b"), x["source"])),
                lambda k: F.struct(F.concat(s["left"], F.array(k)).alias("left"), (s["total"] - x["n"]).alias("total"), (s["half"] - k).alias("half")),
            ),
            lambda s: s["left"],
        )
        split = nodes.withColumn("left", F.when(F.col("b") - F.col("a") > 1, drawn))
        child = lambda side: F.filter(F.transform("xs", lambda x, i: F.struct(x["source"].alias("source"), (F.col("left")[i] if side else x["n"] - F.col("left")[i]).alias("n"))), lambda x: x["n"] > 0)
        children = F.when(F.col("left").isNull(), F.array(F.struct("xs", "a", "b"))).otherwise(F.array(F.struct(child(True).alias("xs"), F.col("a"), middle.alias("b")), F.struct(child(False).alias("xs"), middle.alias("a"), F.col("b"))))
        nodes = split.select(F.inline(children).alias("xs", "a", "b"))
        if level % _LEVELS == _LEVELS - 1:
            nodes = nodes.repartition("a")
    leaves = nodes.select(F.col("a").alias("shard"), F.inline("xs").alias("source", "n"))
    return leaves.unionByName(counts.where("n = 0").select(F.lit(0).alias("shard"), "source", F.col("n").cast("long").alias("n")))


def source_targets(sizes: DataFrame) -> DataFrame:
    """Adds ``target`` to ``source, source_size``: all words shared by weight, none above three times its source.

    Weights 1, 2, 3 repeat over the sources by code point, null last. Sources
    that reach their limit give the excess back to the others; the level at which
    this ends is found from running sums over the sources by limit per weight.
    """
    first = Window.orderBy(F.col("source").isNull(), "source")
    limit = F.col("source_size") * MOST_REPEATS
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.row_number().over(first) - 1, F.lit(len(WEIGHTS))) + 1)).withColumn("limit", limit)
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    before, after, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    level = (F.sum("source_size").over(all_rows) - F.coalesce(F.sum("limit").over(before), F.lit(0))) / F.sum("weight").over(after)
    full = weighed.withColumn("full", level * F.col("weight") >= F.col("limit"))
    free = F.sum(F.when(~F.col("full"), F.col("weight"))).over(all_rows)
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))).over(all_rows), F.lit(0))
    return full.select("source", "source_size", F.when(F.col("full"), F.col("limit").cast("double")).otherwise(F.col("weight") * left / free).alias("target"))


def mix_sources(documents: DataFrame, carry: list[str] | None = None, shards: int | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Draws the mix and says for each document row how it is taken.

    Reads ``doc_id, source, text``. Returns the columns of ``carry`` (``doc_id``
    unless told otherwise) and ``size`` (words, 0 for a null text),
    ``source_size``, ``target`` (both of its source), ``taken`` (words the mix
    takes, repeats counted) and ``copies``, an array of ``shard, words, place``: in
    each of these shards the document's first ``words`` words stand at the rank
    of ``place``.

    A null source is a source of its own. Documents without words are never
    drawn. A source's taken words are its target, rounded: the document where the
    last pass ends is taken in part. Repeated rows are drawn as documents of
    their own; an empty table gives an empty result. Carried columns may have any
    names but those added, dots included. There is a shard for each ``SHARD_WORDS`` words of
    the mix unless ``shards`` is given. The sources, not the documents, are ranked in one task
    and put in one array; the number of sources must allow that.
    """
    names = carry or ["doc_id"]
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    sized = documents.select(F.struct(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names))).alias("row"), F.col("source"), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(_WORD)).cast("long").alias("size"), F.xxhash64(F.lit(SEED), "doc_id", "text").alias("h"))
    sized = materialise(sized, "sized")
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    quota = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(quota / F.col("source_size"))).otherwise(0).cast("long")
    plan = targets.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long")).withColumn("passes", passes).withColumn("rest", quota - F.col("passes") * F.col("source_size"))
    plan = materialise(plan.withColumnRenamed("source", "s"), "plan")

    dealt = sized.join(plan.select("s", "blocks"), same("source", "s"), "left").select("row", "source", "size", "h", F.pmod("h", "blocks").alias("block"))
    blocks = dealt.groupBy("source", "block").agg(F.sum("size").alias("words")).where("words > 0")
    blocks = materialise(blocks.join(plan, same("source", "s")).select("source", "block", "words", "blocks", "passes", "rest", F.pmod(F.xxhash64(F.lit(SEED + 1), "block", "source"), F.ceil(F.col("blocks") / _GROUP)).alias("part"), F.xxhash64(F.lit(SEED + 2), "block", "source").alias("u")), "blocks")

    # the rank of each block and the words before it, by groups of bounded size
    parts = blocks.groupBy("source", "part").agg(F.count("*").alias("n"), F.sum("words").alias("w"))
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("n0"), F.coalesce(F.sum("w").over(ahead), F.lit(0)).alias("w0"))
    inner = Window.partitionBy("source", "part").orderBy("u", "block")
    ranked = blocks.withColumn("i", F.row_number().over(inner) - 1).withColumn("c", F.sum("words").over(inner.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words"))
    ranked = ranked.join(parts, same("source", "s") & (F.col("part") == F.col("p"))).select("source", "block", "words", "passes", (F.col("n0") + F.col("i")).alias("rank"), F.greatest(F.lit(0), F.least("words", F.col("rest") - F.col("w0") - F.col("c"))).alias("budget"))
    ranked = materialise(ranked, "ranked")

    filled = ranked.groupBy("source").agg(F.count("*").alias("filled"))
    full_pass = F.transform(F.sequence(F.lit(0), F.col("passes").cast("int") - 1), lambda c: F.struct((c * F.col("filled") + F.col("rank")).alias("pos"), F.col("words").alias("budget")))
    none = F.array().cast("array<struct<pos:bigint,budget:bigint>>")
    last_pass = F.when(F.col("budget") > 0, F.array(F.struct((F.col("passes") * F.col("filled") + F.col("rank")).alias("pos"), F.col("budget").alias("budget")))).otherwise(none)
    drawn = F.concat(F.when(F.col("passes") > 0, full_pass).otherwise(none), last_pass)
    instances = ranked.join(filled.withColumnRenamed("source", "s"), same("source", "s")).select("source", "block", F.col("words").alias("block_words"), F.inline(drawn).alias("pos", "budget"))
    instances = materialise(instances, "instances")
    if shards is None:
        shards = max(1, -(-(instances.agg(F.sum("budget")).first()[0] or 0) // SHARD_WORDS))

    leaves = splitting_tree(instances.groupBy("source").agg(F.count("*").alias("n")), shards)
    ends = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    runs = leaves.withColumn("to", F.sum("n").over(ends)).where("n > 0")
    places = runs.select(F.col("source").alias("s"), "shard", F.explode(F.sequence(F.col("to") - F.col("n"), F.col("to") - 1)).alias("p"))
    held = instances.join(places, same("source", "s") & (F.col("pos") == F.col("p"))).groupBy("source", "block").agg(F.first("block_words").alias("block_words"), F.sort_array(F.collect_list(F.struct("pos", "budget", "shard"))).alias("held"))
    held = held.withColumnRenamed("source", "s").withColumnRenamed("block", "b")

    met = dealt.join(held, same("source", "s") & (F.col("block") == F.col("b")), "left")
    met = met.withColumn("before", F.sum("size").over(Window.partitionBy("source", "block").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    copies = F.transform("held", lambda x: F.struct(x["shard"].alias("shard"), F.greatest(F.lit(0), F.least(F.col("size"), x["budget"] - F.col("before"))).cast("long").alias("words"), F.xxhash64(F.lit(SEED + 3), "h", x["pos"]).alias("place")))
    copies = F.filter(F.coalesce(copies, F.array().cast("array<struct<shard:int,words:bigint,place:bigint>>")), lambda x: x["words"] > 0)
    out = met.join(plan.select(F.col("s").alias("s2"), "source_size", "target"), same("source", "s2"), "left")
    out = out.select("row", "size", "source_size", "target", copies.alias("copies"))
    return out.select(*(F.col(f"row.c{k}").alias(c) for k, c in enumerate(names)), "size", "source_size", "target", F.aggregate("copies", F.lit(0).cast("long"), lambda s, x: s + x["words"]).alias("taken"), "copies")


def deal_shards(mixed: DataFrame) -> DataFrame:
    """One row for each copy that the mix draws, in its shard and in the shard's shuffled order.

    Takes the result of ``mix_sources`` with whatever it carries; ``copies`` gives way to ``shard``
    and ``place``, by which the shard is shuffled, and ``taken`` becomes the words of this copy
    (the document's first ones; all but for the document where its source's target is met). A shard
    is in one partition, sorted by ``place``; documents that are not drawn are left out.
    """
    rows = mixed.drop("taken").select("*", F.inline("copies").alias("shard", "taken", "place")).drop("copies")
    return rows.repartition("shard").sortWithinPartitions("shard", "place")


def write_shards(mixed: DataFrame, path: str) -> None:
    """Writes each shard's documents in their shuffled order, one row for each copy."""
    deal_shards(mixed).write.partitionBy("shard").parquet(path)

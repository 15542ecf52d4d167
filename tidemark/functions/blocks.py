"""Windows on blocks of a series, so that one long series is many tasks.

Windows of bounded reach get a halo of rows, for which the series must be numbered. Running sums, numbers, nearest known
values and islands go over the blocks' summaries; their blocks may be stretches of any number or time, with gaps and ties.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 65_536


def blockwise(df: DataFrame, key: list[str], idx: str, reach: int, work: Callable[[DataFrame, list[str]], DataFrame], block: int = BLOCK) -> DataFrame:
    """``work(rows, key)`` for each block of a series numbered by ``idx`` without gaps.

    A block also gets the ``reach`` rows on either side, so a row's window over them is the one it has in the whole series;
    ``work`` must keep its rows. Each row comes out of its own block alone.
    """
    block = max(block, reach)  # a halo reaches into the next block only
    here = F.floor(F.col(idx) / block)
    around = F.array_distinct(F.array(here, F.floor((F.col(idx) - reach) / block), F.floor((F.col(idx) + reach) / block)))
    dealt = df.withColumn("_block", F.explode(around)).withColumn("_own", F.col("_block") == here)
    return work(dealt, [*key, "_block"]).where("_own").drop("_block", "_own")


def _beside(rows: DataFrame, summary: DataFrame, key: list[str]) -> DataFrame:
    """Joins block summaries to the rows of their block; null keys are equal."""
    names = [*key, "_block"]
    other = summary.withColumnsRenamed({n: f"_{n}_" for n in names})
    on = F.lit(True)
    for n in names:
        on = on & F.col(n).eqNullSafe(F.col(f"_{n}_"))
    return rows.join(other, on).drop(*(f"_{n}_" for n in names))


def block_width(df: DataFrame, t: str, rows: int = BLOCK) -> int:
    """The width of blocks in ``t`` that hold about so many of the table's rows each where they lie evenly; whatever it is, results are the same."""
    found = df.agg(F.min(t).cast("double").alias("a"), F.max(t).cast("double").alias("b"), F.count(t).alias("n")).first()
    return max(1, int((found.b - found.a) / -(-found.n // rows)) + 1) if found.n else 1


def running_sum(df: DataFrame, key: list[str], idx: str, value: Column, name: str, block: int = BLOCK, then: tuple[str, ...] = ()) -> DataFrame:
    """Adds the sum of ``value`` up to each row: within its block, and over the sums of the blocks before it. Equal ``idx`` are in the order of ``then``."""
    rows = df.withColumn("_sum_v", value).withColumn("_block", F.floor(F.col(idx) / block))
    sums = rows.groupBy(*key, "_block").agg(F.sum("_sum_v").alias("_sum_t"))
    ahead = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*key, "_block", F.coalesce(F.sum("_sum_t").over(ahead), F.lit(0)).alias("_sum_o"))
    inside = Window.partitionBy(*key, "_block").orderBy(idx, *then).rowsBetween(Window.unboundedPreceding, 0)
    return _beside(rows.withColumn(name, F.sum("_sum_v").over(inside)), before, key).withColumn(name, F.col(name) + F.col("_sum_o")).drop("_sum_v", "_block", "_sum_o")


def around(df: DataFrame, own: list[str], order: list[str], known: str, before: str, after: str, itself: bool = True) -> DataFrame:
    """Adds the last ``known`` value that is not null up to each row of ``own`` (before it unless ``itself``) and the first one from it on.

    Spark goes over all later rows again for every row of a window that ends with the last one, so that way is a window in the turned order of the rows' numbers.
    """
    ahead = Window.partitionBy(*own).orderBy(*order)
    rows = df.withColumn("_around_n", F.row_number().over(ahead)).withColumn(before, F.last(known, ignorenulls=True).over(ahead.rowsBetween(Window.unboundedPreceding, 0 if itself else -1)))
    back = Window.partitionBy(*own).orderBy(F.desc("_around_n")).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(after, F.last(known, ignorenulls=True).over(back)).drop("_around_n")


def nearest_known(df: DataFrame, key: list[str], idx: str, known: Column, before: str, after: str, own: bool = True, block: int = BLOCK, then: tuple[str, ...] = ()) -> DataFrame:
    """Adds the last ``known`` value that is not null up to each row (before it unless ``own``) and the first one from it on, over blocks as ``running_sum``."""
    rows = df.withColumn("_near_k", known).withColumn("_block", F.floor(F.col(idx) / block))
    place = F.when(F.col("_near_k").isNotNull(), F.struct(idx, *then) if then else F.col(idx))
    ends = rows.groupBy(*key, "_block").agg(F.max_by("_near_k", place).alias("_near_l"), F.min_by("_near_k", place).alias("_near_f"))
    w, back = (Window.partitionBy(*key).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in ("_block", F.desc("_block")))
    carried = ends.select(*key, "_block", F.last("_near_l", ignorenulls=True).over(w).alias("_near_cl"), F.last("_near_f", ignorenulls=True).over(back).alias("_near_cf"))
    rows = around(rows, [*key, "_block"], [idx, *then], "_near_k", before, after, own)
    return _beside(rows, carried, key).withColumn(before, F.coalesce(before, "_near_cl")).withColumn(after, F.coalesce(after, "_near_cf")).drop("_near_k", "_block", "_near_cl", "_near_cf")


def numbered(df: DataFrame, key: list[str], order: list[str], name: str, first: int = 0, width: int | None = None) -> DataFrame:
    """Adds the number of each row of its key in the order of ``order``, from ``first`` on.

    The first order column is a number; stretches of ``width`` of it are counted, and a row's number is its place in its stretch
    after all rows of the stretches before. Rows without that number come first.
    """
    t, *then = order
    return running_sum(df, key, t, F.lit(1), name, width or block_width(df, t), tuple(then)).withColumn(name, F.col(name) - 1 + first)


def gap_islands(df: DataFrame, key: list[str], t: str, gap: Column, width: int | None = None) -> DataFrame:
    """Stretches of rows without a distance above ``gap`` (equal within a key) in ``t``, as ``key, start, stop``.

    Each block of ``width`` finds its own stretches; only the first and the last of a block may go on in another one, so a second
    scan joins these, two for each block at most, and the others are done. Rows without ``t`` are left out.
    """
    rows = df.where(F.col(t).isNotNull()).select(*key, F.col(t).alias("_t"), gap.alias("_gap"))
    rows = rows.withColumn("_block", F.floor(F.col("_t") / (width or block_width(df, t))))
    w = Window.partitionBy(*key, "_block").orderBy("_t")
    new = F.coalesce(F.col("_t") - F.lag("_t").over(w) > F.col("_gap"), F.lit(False)).cast("int")
    rows = rows.withColumn("_new", new).withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    found = rows.groupBy(*key, "_block", "_g").agg(F.min("_t").alias("start"), F.max("_t").alias("stop"), F.first("_gap").alias("_gap"))
    last = F.max("_g").over(Window.partitionBy(*key, "_block"))
    found = found.withColumn("_edge", (F.col("_g") == 0) | (F.col("_g") == last))
    seam = Window.partitionBy(*key).orderBy("start", "stop")
    edges = found.where("_edge").withColumn("_apart", F.coalesce(F.col("start") - F.lag("stop").over(seam) > F.col("_gap"), F.lit(False)) | (F.col("_g") > 0))
    edges = edges.withColumn("_n", F.sum(F.col("_apart").cast("int")).over(seam.rowsBetween(Window.unboundedPreceding, 0)))
    joined = edges.groupBy(*key, "_n").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("_n")
    return joined.unionByName(found.where("not _edge").select(*key, "start", "stop"))

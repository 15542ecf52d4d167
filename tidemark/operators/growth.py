"""Growth of storage: what has grown since the last cleanup, how long the space lasts, and a back-test of such forecasts.

Readings are ``key, x, used, available`` with a whole-numbered time ``x``. A reading with a null in one of these is
left out; equal times are in the order of ``used``, then ``available``. Work grows with the readings times the
cutoffs and with the pairs of readings of one segment, so readings are such as daily totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import nearest_known, numbered
from ..functions.ranks import medians
from ..functions.store import materialise

#: A drop is a cleanup above this share of the capacity and this many median deviations of the steps.
DROP_SHARE, DEVIATIONS = 0.03, 20
#: Cells that slopes of a segment are counted in, and readings that meet others in one task.
CELLS, TILE = 1024, 256


def _own(key: list[str]) -> list[str]:
    """Names for the key's columns that clash with none of the columns here."""
    return [f"_key{i}" for i in range(len(key))]


def _readings(df: DataFrame, names: list[str], x: str, used: str, available: str) -> DataFrame:
    """Readings numbered from 0 by key, with what was used at the one before (null for the first)."""
    key = _own(names)
    whole = df.select(*(F.col(a).alias(b) for a, b in zip(names, key, strict=True)), F.col(x).cast("long").alias("x"), F.col(used).cast("double").alias("used"), F.col(available).cast("double").alias("available")).dropna()
    rows = numbered(whole, key, ["x", "used", "available"], "i")
    return materialise(nearest_known(rows, key, "i", F.col("used"), "before", "after", own=False).drop("after"), "readings")


def _segments(readings: DataFrame, cutoffs: DataFrame, key: list[str]) -> DataFrame:
    """For cutoffs ``key, cut, m`` (the last reading known) adds the segment's first reading ``s``, and ``used, available, x`` of the last one."""
    at = [*key, "cut"]
    known = cutoffs.join(readings, key).where("i <= m")
    steps = known.where("before is not null").select(*at, (F.col("used") - F.col("before")).alias("step"))
    usual = medians(steps, at, "step", "usual")
    off = medians(steps.join(usual, at).withColumn("off", F.abs(F.col("step") - F.col("usual"))), at, "off", "off")
    last = known.where("i = m").select(*at, "m", "x", "used", "available")
    limit = last.join(off, at).select(*at, F.greatest(DROP_SHARE * (F.col("used") + F.col("available")), DEVIATIONS * F.col("off")).alias("limit"))
    starts = known.join(limit, at).where("before - used > limit").groupBy(*at).agg(F.max("i").alias("s"))
    return materialise(last.join(starts, at, "left").fillna(0, ["s"]), "segments")


def _slopes(readings: DataFrame, segments: DataFrame, key: list[str], day: int) -> DataFrame:
    """Slopes a day of all pairs of readings of a segment, each with the first cutoff ``cut`` that knows it.

    Cutoffs of one segment share its pairs. Pairs are made in tiles of readings, so a long segment is many tasks.
    """
    seg = [*key, "s"]
    spans = segments.groupBy(*seg).agg(F.max("m").alias("end"))
    inside = spans.join(readings, key).where("i between s and end").select(*seg, "i", "x", "used", F.lit(None).cast("long").alias("cut"))
    ends = segments.select(*seg, F.col("m").alias("i"), F.lit(None).cast("long").alias("x"), F.lit(None).cast("double").alias("used"), "cut")
    later = Window.partitionBy(*seg).orderBy("i").rangeBetween(0, Window.unboundedFollowing)
    rows = inside.unionByName(ends).withColumn("cut", F.min("cut").over(later)).where("x is not null").withColumn("tile", F.floor(F.col("i") / TILE))
    tiles = F.floor(F.col("end") / TILE)
    a = rows.join(spans, seg).select(*seg, F.col("i").alias("ia"), F.col("x").alias("xa"), F.col("used").alias("ua"), F.col("tile").alias("from"), F.explode(F.sequence("tile", tiles)).alias("tile"))
    b = rows.select(*seg, "i", "x", "used", "cut", "tile")
    pairs = a.join(b, [*seg, "tile"]).where("ia < i and xa < x")
    return pairs.select(*seg, "cut", ((F.col("used") - F.col("ua")) / ((F.col("x") - F.col("xa")) / F.lit(float(day)))).alias("slope"))


def _cell(slope: Column) -> Column:
    """Never falls with the slope; even where slopes are dense."""
    y = (slope - F.col("mid")) / F.col("wide")
    return F.least(F.lit(CELLS - 1), F.floor((y / (1 + F.abs(y)) + 1) * (CELLS / 2))).cast("int")


def running_quantiles(slopes: DataFrame, segments: DataFrame, seg: list[str], shares: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles of the slopes known at each cutoff, as ``seg, cut`` and a column for each share.

    A slope is counted once, in its cell and at the cutoff it comes in; sums over the cutoffs before give each cutoff's
    counts, and only slopes of the cells that hold a rank are looked at one by one. A cutoff without slopes has no row.
    """
    q = F.percentile_approx("slope", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000)
    scale = materialise(slopes.groupBy(*seg).agg(q.alias("q")).select(*seg, F.col("q")[1].alias("mid"), F.when(F.col("q")[2] > F.col("q")[0], F.col("q")[2] - F.col("q")[0]).otherwise(1.0).alias("wide")), "scale")
    values = slopes.join(scale, seg).withColumn("cell", _cell(F.col("slope"))).groupBy(*seg, "cell", "cut", "slope").agg(F.count("*").alias("k"))
    values = materialise(values, "slopes")
    counts = values.groupBy(*seg, "cell", "cut").agg(F.sum("k").alias("k"))
    grid = segments.select(*seg, "cut").join(counts.select(*seg, "cell").distinct(), seg).join(counts, [*seg, "cell", "cut"], "left")
    up_to = lambda part, order: Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    grid = grid.withColumn("k", F.sum("k").over(up_to([*seg, "cell"], "cut"))).where("k > 0")
    grid = grid.withColumn("upto", F.sum("k").over(up_to([*seg, "cut"], "cell"))).withColumn("n", F.sum("k").over(Window.partitionBy(*seg, "cut")))
    place = (F.col("n") - 1) * F.element_at(F.create_map(*(F.lit(v) for pair in shares.items() for v in pair)), F.col("share"))
    asked = grid.withColumn("share", F.explode(F.array(*map(F.lit, shares)))).withColumn("part", place - F.floor(place)).withColumn("rank", F.explode(F.array_distinct(F.array(F.floor(place), F.ceil(place)))))
    asked = asked.where("upto - k <= rank and rank < upto").select(*seg, "cut", "cell", "share", "part", "rank", (F.col("upto") - F.col("k")).alias("below"))
    cells = asked.select(*seg, "cell", "cut", "below").distinct()
    near = cells.join(values.withColumnsRenamed({"cut": "came"}), [*seg, "cell"]).where("came <= cut").groupBy(*seg, "cell", "cut", "below", "slope").agg(F.sum("k").alias("k"))
    near = near.withColumn("to", F.col("below") + F.sum("k").over(up_to([*seg, "cell", "cut"], "slope"))).drop("below")
    found = asked.join(near, [*seg, "cell", "cut"]).where("to - k <= rank and rank < to")
    low, high = F.min("slope"), F.max("slope")
    found = found.groupBy(*seg, "cut", "share").agg((low + (high - low) * F.first("part")).alias("slope"))
    return found.groupBy(*seg, "cut").pivot("share", list(shares)).agg(F.first("slope"))


def growth_runway(df: DataFrame, key: list[str], x: str, used: str, available: str, day: int, upper: float = 0.75) -> DataFrame:
    """How long the space of each key lasts: ``key, readings, central, conservative, runway_days, conservative_days, outlook``.

    The segment goes from the last cleanup on, or from the first reading. ``central`` is the median slope a day over all its
    pairs of readings of different times, ``conservative`` the quantile ``upper``. A segment without such a pair has null
    slopes and the outlook ``N/A``; a central slope of 0 or less has no runway and is ``stable``. ``day`` is a day in ``x``.
    """
    readings, names, key = _readings(df, key, x, used, available), key, _own(key)
    cutoffs = readings.groupBy(*key).agg(F.max("i").alias("m")).withColumn("cut", F.lit(0).cast("long"))
    segments = _segments(readings, cutoffs, key)
    seg = [*key, "s"]
    found = running_quantiles(_slopes(readings, segments, key, day), segments, seg, {"central": 0.5, "conservative": upper})
    out = segments.join(found.drop("cut"), seg, "left").withColumn("readings", F.col("m") - F.col("s") + 1)
    runway = F.when(F.col("central") > 0, F.col("available") / F.col("central"))
    careful = F.when((F.col("central") > 0) & (F.col("conservative") > 0), F.col("available") / F.col("conservative"))
    out = out.withColumn("runway_days", runway).withColumn("conservative_days", careful)
    words = F.when(F.col("central").isNull(), "N/A").when(F.col("central") <= 0, "stable").when(F.col("conservative_days").isNull(), _span("runway_days")).otherwise(F.concat(_span("runway_days"), F.lit(" (conservative: "), _span("conservative_days"), F.lit(")")))
    return out.select(*key, "readings", "central", "conservative", "runway_days", "conservative_days", words.alias("outlook")).withColumnsRenamed(dict(zip(key, names, strict=True)))


def _span(days: str) -> Column:
    """Days below 60, months below 730 days, else years."""
    d = F.col(days)
    whole = lambda c: F.bround(c).cast("long").cast("string")
    return F.when(d < 60, F.concat(F.lit("~"), whole(d), F.lit(" days"))).when(d < 730, F.concat(F.lit("~"), whole(d / 30), F.lit(" months"))).otherwise(F.format_string("~%.1f years", d / 365))


def growth_backtest(df: DataFrame, key: list[str], x: str, used: str, available: str, day: int, horizons: tuple[int, ...] = (30, 60, 90), first: int = 14, every: int = 7, least: int = 5, late: int = 3) -> DataFrame:
    """Errors of forecasts made at cutoffs along the history: ``key, horizon, n, mae, rmse`` in the unit of ``used``.

    Cutoffs lie ``every`` so many days from ``first`` days after the first reading to ``horizon`` days before the last one. Each
    knows the readings up to it alone, and forecasts by the median slope of its segment from its last reading; a segment of
    fewer than ``least`` readings makes no forecast. It is held against the first reading at or after the horizon that comes at most
    ``late`` whole days after it. A key without any forecast for a horizon has no row for it.
    """
    readings, names, key = _readings(df, key, x, used, available), key, _own(key)
    ends = readings.groupBy(*key).agg(F.min("x").alias("begin"), F.max("x").alias("end"))
    stepped = readings.join(ends, key).withColumn("cut", F.greatest(F.lit(0), F.expr(f"(x - begin - {first * day} + {every * day - 1}) div {every * day}")))
    last_cut = F.expr(f"(end - begin - {(first + min(horizons)) * day}) div {every * day}")
    grid = ends.where(f"end - begin >= {(first + min(horizons)) * day}").select(*key, F.explode(F.sequence(F.lit(0).cast("long"), last_cut)).alias("cut"))
    came = stepped.groupBy(*key, "cut").agg(F.max("i").alias("m"))
    known = Window.partitionBy(*key).orderBy("cut").rowsBetween(Window.unboundedPreceding, 0)
    cutoffs = grid.join(came, [*key, "cut"], "left").withColumn("m", F.max("m").over(known)).where("m >= 1")
    segments = _segments(readings, cutoffs, key)
    enough = materialise(segments.where(F.col("m") - F.col("s") + 1 >= least), "enough")
    seg = [*key, "s"]
    found = running_quantiles(_slopes(readings, enough, key, day), enough, seg, {"central": 0.5})
    asked = enough.join(found, [*seg, "cut"]).join(ends, key).withColumn("horizon", F.explode(F.array(*map(F.lit, horizons))))
    asked = asked.where(F.col("begin") + (first + every * F.col("cut")) * F.lit(day) <= F.col("end") - F.col("horizon") * F.lit(day))
    asked = asked.select(*key, "cut", "horizon", (F.col("used") + F.col("central") * F.col("horizon")).alias("guess"), (F.col("x") + F.col("horizon") * F.lit(day)).alias("target"))
    width = (late + 1) * day
    later = readings.select(*key, F.col("x").alias("when"), "i", F.col("used").alias("actual"), F.floor(F.col("x") / width).alias("bucket"))
    bucket = F.floor(F.col("target") / width)
    met = asked.withColumn("bucket", F.explode(F.array(bucket, bucket + 1))).join(later, [*key, "bucket"]).where((F.col("when") >= F.col("target")) & (F.col("when") < F.col("target") + width))
    off = met.groupBy(*key, "cut", "horizon", "guess").agg(F.min_by("actual", "i").alias("actual")).withColumn("off", F.col("guess") - F.col("actual"))
    return off.groupBy(*key, "horizon").agg(F.count("*").alias("n"), F.avg(F.abs("off")).alias("mae"), F.sqrt(F.avg(F.col("off") * F.col("off"))).alias("rmse")).withColumnsRenamed(dict(zip(key, names, strict=True)))

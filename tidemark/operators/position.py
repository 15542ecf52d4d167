"""Position, orientation and linear position from tracked points."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import blockwise, gap_islands
from ..functions.columns import no_nan
from ..functions.rangejoin import points_in
from ..functions.ranks import medians
from ..functions.store import materialise
from .signal import gaussian, interpolate, moving_mean, resample, time_grid, unwrap


#: Edges of a track, which is a graph of a few corridors.
MOST_EDGES = 10_000


def speed(df: DataFrame, key: list[str], order: str, x: str, y: str, step: float, block: int | None = None) -> DataFrame:
    """Adds ``speed`` from central differences over ``order`` times ``step``, one-sided at the ends; with ``block``, for an order without gaps, in blocks."""
    if block:
        return blockwise(df, key, order, 1, lambda d, k: speed(d, k, order, x, y, step), block)
    w = Window.partitionBy(*key).orderBy(order)
    ahead, back = (lambda c: F.coalesce(F.lead(c).over(w), F.col(c))), (lambda c: F.coalesce(F.lag(c).over(w), F.col(c)))
    span = F.nullif((ahead(order) - back(order)) * F.lit(step), F.lit(0.0))
    rows = df.withColumn("_vx", (ahead(x) - back(x)) / span).withColumn("_vy", (ahead(y) - back(y)) / span)
    return rows.withColumn("speed", F.sqrt(F.col("_vx") * F.col("_vx") + F.col("_vy") * F.col("_vy"))).drop("_vx", "_vy")


def to_cm(df: DataFrame, names: list[str], metres_a_pixel: float) -> DataFrame:
    return df.withColumns({n: F.col(n) * metres_a_pixel * 100 for n in names})


def low_likelihood(df: DataFrame, key: list[str], likelihood: str, threshold: float) -> DataFrame:
    """Rows below the threshold, and their percentage."""
    found = df.groupBy(*key).agg(F.count(F.when(F.col(likelihood) < threshold, 1)).alias("low"), F.count("*").alias("_n"))
    return found.select(*key, "low", F.round(100 * F.col("low") / F.col("_n"), 6).alias("percent"))


def good_spans(df: DataFrame, key: list[str], idx: str, bad: Column, reach: int) -> DataFrame:
    """Runs of good rows; runs with ``reach`` bad rows or fewer between them are one."""
    return gap_islands(df.where(~F.coalesce(bad, F.lit(True))), key, idx, F.lit(reach + 1))


def _walk(x: np.ndarray, y: np.ndarray, good: np.ndarray, most: float) -> np.ndarray:
    """Which rows of a span jump: walking out from the middle row (the middle good one of all but the last, if some are bad), a good row outside the box around the last one that stayed.

    The box reaches ``most`` either way, its edges cut to whole numbers. The first and the last row of a span are not tested.
    """
    n = len(x)
    inner = np.flatnonzero(good[:-1]) if n > 1 else np.array([0])
    middle = (n - 1) // 2 if good[:-1].all() or not len(inner) else int(inner[len(inner) // 2])
    jumps = np.zeros(n, dtype=bool)
    for way in (range(middle - 1, 0, -1), range(middle + 1, n - 1)):
        last = middle
        for k in way:
            if not good[k]:
                continue
            if any(c[k] < int(c[last] - most) or c[k] > int(c[last] + most) for c in (x, y)):
                jumps[k] = True
            else:
                last = k
    return jumps


def reject_jumps(df: DataFrame, key: list[str], idx: str, x: str, y: str, bad: Column, reach: int, most: float) -> DataFrame:
    """Bad rows, and rows of the good spans that jump (see ``_walk``), without ``x, y``; adds ``rejected``.

    Whether a row stays depends on the one before it in the walk, so a span (of ``good_spans``) is one group.
    """
    names = df.columns
    rows = df.withColumn("_bad", F.coalesce(bad, F.lit(True)) | no_nan(F.col(x).cast("double")).isNull() | no_nan(F.col(y).cast("double")).isNull())
    spans = good_spans(rows, key, idx, F.col("_bad"), reach)
    placed = points_in(rows, spans, key, idx, 4096, how="left")

    def walked(pdf):
        pdf = pdf.sort_values(idx)
        good = ~pdf["_bad"].to_numpy(dtype=bool)
        jumps = _walk(pdf[x].to_numpy(dtype=float), pdf[y].to_numpy(dtype=float), good, most)
        return pdf.assign(_bad=~good | jumps)[[*names, "_bad"]]

    inside = placed.where("start is not null")
    judged = inside.groupBy(*key, "start").applyInPandas(walked, inside.select(*names, "_bad").schema)
    both = judged.unionByName(placed.where("start is null").select(*names, "_bad"))
    return both.withColumns({c: F.when(~F.col("_bad"), F.col(c)) for c in (x, y)}).withColumnRenamed("_bad", "rejected")


def inside_polygon(df: DataFrame, x: str, y: str, corners: list[tuple[float, float]]) -> DataFrame:
    """Adds ``inside`` by the parity of edge crossings of a ray to the right."""
    crossed = F.lit(0)
    for (x1, y1), (x2, y2) in zip(corners, [*corners[1:], corners[0]], strict=True):
        spans = (F.lit(y1) > F.col(y)) != (F.lit(y2) > F.col(y))
        at = (x2 - x1) * (F.col(y) - y1) / (y2 - y1 if y2 != y1 else 1.0) + x1
        crossed = crossed + F.when(spans & (F.col(x) < at), 1).otherwise(0)
    return df.withColumn("inside", crossed % 2 == 1)


def two_point_orientation(df: DataFrame, a: tuple[str, str], b: tuple[str, str]) -> DataFrame:
    """Adds the direction from ``b`` to ``a``."""
    return df.withColumn("orientation", F.atan2(F.col(a[1]) - F.col(b[1]), F.col(a[0]) - F.col(b[0])))


def bisector_orientation(df: DataFrame, one: tuple[str, str], two: tuple[str, str], three: tuple[str, str], close: float = 1e-8) -> DataFrame:
    """Adds the direction across the line from ``two`` to ``one``; where that is level, up or down by the side of ``three``.

    Level is a difference of ``close`` at most. All three at one height have no direction, which fails the job; a missing point gives none.
    """
    dx, dy = F.col(one[0]) - F.col(two[0]), F.col(one[1]) - F.col(two[1])
    above = F.col(three[1]) - F.col(one[1])
    level = F.abs(dy) <= close
    lost = F.raise_error(F.lit("the direction of the head cannot be told")).cast("double")
    up = F.when(F.abs(F.col(three[1]) - F.col(two[1])) <= close, lost).when(above > 0, math.pi / 2).when(above < 0, -math.pi / 2)
    there = no_nan(F.col(one[1])).isNotNull() & no_nan(F.col(two[1])).isNotNull()
    return df.withColumn("orientation", F.when(there & level, up).when(there, F.atan2(dx, -dy)))


def _near(a: tuple[str, str], b: tuple[str, str], limit: float) -> Column:
    return F.sqrt((F.col(a[0]) - F.col(b[0])) ** 2 + (F.col(a[1]) - F.col(b[1])) ** 2) < limit


def _there(p: tuple[str, str]) -> Column:
    return no_nan(F.col(p[0])).isNotNull() & no_nan(F.col(p[1])).isNotNull()


def centroid(df: DataFrame, points: list[tuple[str, str]], limit: float | None = None) -> DataFrame:
    """Adds ``cx, cy`` from one, two or four points (the front, then back centre, left and right).

    One point stands for itself. Of two the mean if both are there and closer than ``limit``, else
    the only one there is. Of four, in this order: front and centre; without a centre the middle of
    left and right with the front, or the only side with the front; without front and centre
    the middle of left and right; without a front the centre. Points of one mean must all be
    closer than ``limit``; nothing that fits is no centroid.
    """
    if len(points) not in (1, 2, 4) or (limit is None and len(points) > 1):
        raise ValueError("one, two or four points, and a limit for more than one")
    mean = lambda *ps: tuple(sum(F.col(p[k]) for p in ps) / len(ps) for k in (0, 1))
    if len(points) == 1:
        cases = [(_there(points[0]), mean(points[0]))]
    elif len(points) == 2:
        a, b = points
        cases = [(_there(a) & _there(b) & _near(a, b, limit), mean(a, b)), (_there(a) & ~_there(b), mean(a)), (_there(b) & ~_there(a), mean(b))]
    else:
        front, centre, left, right = points
        f, c, lt, rt = map(_there, points)
        middle = mean(left, right)
        sides = tuple((m + F.col(front[k])) / 2 for k, m in enumerate(middle))
        cases = [
            (f & c & _near(front, centre, limit), mean(front, centre)),
            (f & ~c & lt & rt & _near(left, right, limit) & _near(left, front, limit) & _near(right, front, limit), sides),
            (~f & ~c & lt & rt & _near(left, right, limit), middle),
            (f & ~c & lt & ~rt & _near(left, front, limit), mean(left, front)),
            (f & ~c & rt & ~lt & _near(right, front, limit), mean(right, front)),
            (~f & c, mean(centre)),
        ]
    for k, name in enumerate(("cx", "cy")):
        out = F.lit(None).cast("double")
        for test, value in reversed(cases):
            out = F.when(F.coalesce(test, F.lit(False)), value[k]).otherwise(out)
        df = df.withColumn(name, out)
    return df


def _with_velocity(rows: DataFrame, key: list[str], t: str, step) -> DataFrame:
    """Adds ``vx, vy, speed`` from the rows before and after, ``step`` seconds apart (a number or a column)."""
    w = Window.partitionBy(*key).orderBy(t)
    n = rows.withColumn("_n", F.row_number().over(w))
    v = F.greatest(F.lit(1), F.coalesce(F.lead("_n").over(w), F.col("_n")) - F.coalesce(F.lag("_n").over(w), F.col("_n"))) * step
    slope = lambda c: (F.coalesce(F.lead(c).over(w), F.col(c)) - F.coalesce(F.lag(c).over(w), F.col(c))) / v
    n = n.withColumn("vx", slope("x")).withColumn("vy", slope("y")).drop("_n")
    return n.withColumn("speed", F.sqrt(F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy")))


def two_point_track(df: DataFrame, key: list[str], t: str, one: tuple[str, str], two: tuple[str, str], cm: float, apart: float, most_speed: float, width: int, step: float) -> DataFrame:
    """Position, orientation and speed from two tracked points: ``x, y, orientation, vx, vy, speed`` by ``key, t``.

    Rows without a time go. Points become centimetres (``cm`` a unit); both are missing where they are ``apart`` or
    more from each other, and each where it is faster than ``most_speed`` from the row before (``step`` is the
    time between rows in seconds); gaps are filled linearly, then a mean of ``width`` rows is taken.
    """
    w = Window.partitionBy(*key).orderBy(t)
    names = [*one, *two]
    rows = df.where(F.col(t).isNotNull()).select(*key, t, *(no_nan(F.col(c) * cm).alias(c) for c in names))
    far = F.coalesce(~_near(one, two, apart), F.lit(False))
    rows = rows.withColumn("_far", far).select(*key, t, *(F.when(~F.col("_far"), F.col(c)).alias(c) for c in names))
    jump = lambda p: F.sqrt((F.col(p[0]) - F.lag(p[0]).over(w)) ** 2 + (F.col(p[1]) - F.lag(p[1]).over(w)) ** 2) / step > most_speed
    rows = rows.withColumn("_fast", F.coalesce(jump(one), F.lit(False)) | F.coalesce(jump(two), F.lit(False)))
    rows = rows.select(*key, t, *(F.when(~F.col("_fast"), F.col(c)).alias(c) for c in names))
    for c in names:
        rows = moving_mean(interpolate(rows, key, t, c, c), key, t, c, width, c)
    rows = two_point_orientation(rows, one, two).select(*key, t, ((F.col(one[0]) + F.col(two[0])) / 2).alias("x"), ((F.col(one[1]) + F.col(two[1])) / 2).alias("y"), "orientation")
    return _with_velocity(rows, key, t, step)


def two_point_position(df: DataFrame, key: list[str], t: str, one: tuple[str, str], two: tuple[str, str], cm: float, apart: float, most_speed: float, seconds: float, upsampled: float | None = None, ticks: int = 1_000_000) -> DataFrame:
    """As ``two_point_track``, with each key's own rate: the median time between its rows (``ticks`` of ``t`` a second).

    The mean covers the rows of ``seconds``, one at least. ``upsampled``, in rows a second, puts the smoothed points on an even
    grid from a key's first time to its last, linear between neighbours. Times are distinct within a key. A key whose points are all too far apart is an error, as that is
    mostly one point tracked by mistake for two. Rows without a key or a time go; a key of one row has no velocity to speak of (0).
    """
    w = Window.partitionBy(*key).orderBy(t)
    names = [*one, *two]
    rows = df.dropna(subset=[*key, t]).select(*key, t, *(no_nan(F.col(c) * cm).alias(c) for c in names))
    rows = materialise(rows.withColumn("_far", F.coalesce(~_near(one, two, apart), F.lit(False))).withColumn("_gap", (F.col(t) - F.lag(t).over(w)) / ticks), "points")
    lost = rows.groupBy(*key).agg(F.bool_and("_far").alias("_all")).where("_all").first()
    if lost:
        raise ValueError(f"all points are {apart} or more apart in {lost[: len(key)]}")
    width = F.greatest(F.lit(1), F.coalesce(F.floor(F.lit(seconds) * (1 / F.col("_step"))), F.lit(1))).cast("int")
    step = materialise(medians(rows, key, "_gap", "_step").withColumn("_w", width), "steps")
    most = step.agg(F.max("_w")).first()[0] or 1
    rows = rows.join(step, key, "left").select(*key, t, "_step", F.coalesce("_w", F.lit(1)).alias("_w"), *(F.when(~F.col("_far"), F.col(c)).alias(c) for c in names))
    jump = lambda p: F.coalesce(F.sqrt((F.col(p[0]) - F.lag(p[0]).over(w)) ** 2 + (F.col(p[1]) - F.lag(p[1]).over(w)) ** 2) / F.col("_step") > most_speed, F.lit(False))
    rows = rows.withColumn("_fast", jump(one) | jump(two)).select(*key, t, "_step", "_w", *(F.when(~F.col("_fast"), F.col(c)).alias(c) for c in names))
    for c in names:
        rows = interpolate(rows, key, t, c, c)
    # keys differ in width, so each row takes the last of its own from the widest window
    last = F.collect_list(F.struct(*names)).over(w.rowsBetween(1 - most, 0))
    rows = rows.withColumn("_l", last).withColumn("_l", F.slice("_l", F.greatest(F.lit(1), F.size("_l") - F.col("_w") + 1), F.col("_w")))
    mean = lambda c: F.when(F.size(_gathered(c)) > 0, F.aggregate(_gathered(c), F.lit(0.0), lambda a, x: a + x) / F.size(_gathered(c)))
    rows = rows.select(*key, t, "_step", *(mean(c).alias(c) for c in names))
    if upsampled:
        rows = materialise(rows, "smoothed")
        ends = rows.groupBy(*key).agg(F.min(t).alias("start"), F.max(t).alias("stop"))
        grid = time_grid(ends, key, round(ticks / upsampled)).select(*key, F.round("t").cast(df.schema[t].dataType).alias(t)).distinct()
        made = grid.withColumn("_step", F.lit(1 / upsampled))
        for c in names:
            made = made.join(resample(rows, grid, key, t, c), [*key, t])
        rows = made
    middle = lambda k: ((F.col(one[k]) + F.col(two[k])) / 2).alias("xy"[k])
    rows = two_point_orientation(rows, one, two).select(*key, t, middle(0), middle(1), "orientation", F.coalesce("_step", F.lit(1.0)).alias("_step"))
    return _with_velocity(rows, key, t, F.col("_step")).drop("_step")


def _gathered(name: str) -> Column:
    return F.filter(F.transform("_l", lambda x: x[name]), lambda v: v.isNotNull())


def orientation_track(df: DataFrame, key: list[str], order: str, angle: str, sigma: float) -> DataFrame:
    """An orientation without turns' jumps, its gaps filled, smoothed and wrapped to half a turn either way, as ``smoothed``."""
    rows = unwrap(df, key, order, angle, "_u")
    rows = gaussian(interpolate(rows, key, order, "_u", "_f"), key, order, "_f", sigma, name="_s")
    return rows.withColumn("smoothed", F.atan2(F.sin("_s"), F.cos("_s"))).drop("_u", "_f", "_s")


def centroid_track(df: DataFrame, key: list[str], order: str, points: list[tuple[str, str]], limit: float, width: int, step: float) -> DataFrame:
    """The centroid with gaps filled and a mean of ``width`` rows, and its speed: ``cx, cy, speed``."""
    rows = centroid(df, points, limit)
    for c in ("cx", "cy"):
        rows = moving_mean(interpolate(rows, key, order, c, c), key, order, c, width, c)
    return speed(rows, key, order, "cx", "cy", step)


def numbered_track(track: DataFrame, key: list[str], t: str) -> DataFrame:
    """A two-point track with the number of each row's video frame, from 0, and its speed's components named as in the later version."""
    frames = F.row_number().over(Window.partitionBy(*key).orderBy(t)) - 1
    return track.withColumn("video_frame", frames).withColumnsRenamed({"vx": "velocity_x", "vy": "velocity_y"})


def behaviour_rows(df: DataFrame, key: list[str], syllable: str, values: list[str], digits: int = 4) -> DataFrame:
    """Behaviour results as rows, their numbers rounded."""
    return df.select(*key, syllable, *(F.round(v, digits).alias(v) for v in values))


def frame_times(poses: DataFrame, video: DataFrame, positions: DataFrame, frame: str, t: str) -> DataFrame:
    """Poses with the time of their video frame, from the first frame at or after the first position; ``video(frame, t)`` lists the frames. Frames without a time go."""
    first = positions.agg(F.min(t).alias("_first"))
    timed = video.crossJoin(F.broadcast(first)).where(F.col(t) >= F.col("_first")).select(frame, t)  # one row
    return poses.join(timed, frame)


def stack_parts(parts: dict[str, DataFrame], key: list[str]) -> DataFrame:
    """The frames of several body parts as one row a key, columns named ``part_column``."""
    out = None
    for name, df in parts.items():
        own = df.select(*key, *(F.col(c).alias(f"{name}_{c}") for c in df.columns if c not in key))
        out = own if out is None else out.join(own, key, "full_outer")
    return out


def with_orientation(position: DataFrame, orientation: DataFrame, key: list[str]) -> DataFrame:
    """Positions with the orientation of their key; either may be missing."""
    return position.join(orientation, key, "full_outer")


def normalise_pose(poses: DataFrame, series: list[str], frame: str, part: str, front: list[str], back: list[str]) -> DataFrame:
    """Points relative to the body's centre over the mean distance of the centres of ``front`` and ``back`` parts, the centre added again.

    Takes ``series, frame, part, x, y``. A series whose mean distance is not above zero fails the job.
    """
    mean = lambda names: tuple(F.avg(F.when(F.col(part).isin(names), F.col(c))) for c in ("x", "y"))
    (fx, fy), (bx, by) = mean(front), mean(back)
    centres = poses.groupBy(*series, frame).agg(F.avg("x").alias("_cx"), F.avg("y").alias("_cy"), F.sqrt((fx - bx) ** 2 + (fy - by) ** 2).alias("_l"))
    length = centres.groupBy(*series).agg(F.avg("_l").alias("_m")).withColumn("_m", F.when(F.col("_m") > 0, F.col("_m")).otherwise(F.raise_error(F.lit("a body without length")).cast("double")))
    rows = poses.join(centres.drop("_l"), [*series, frame]).join(length, series)
    return rows.select(*series, frame, part, *(((F.col(c) - F.col(f"_c{c}")) / F.col("_m") + F.col(f"_c{c}")).alias(c) for c in ("x", "y")))


def keypoints(poses: DataFrame, key: list[str], part: str, parts: list[str], values: list[str]) -> DataFrame:
    """For each key the arrays of ``values`` in the order of ``parts``; a missing part is null. A part that no row has is an error of the caller's list, found by ``missing_parts``."""
    made = [F.array(*(F.max(F.when(F.col(part) == p, F.col(v))) for p in parts)).alias(v) for v in values]
    return poses.where(F.col(part).isin(parts)).groupBy(*key).agg(*made)


def missing_parts(poses: DataFrame, series: list[str], part: str, parts: list[str]) -> DataFrame:
    """Required parts that a series lacks."""
    wanted = poses.select(*series).distinct().select(*series, F.explode(F.array(*map(F.lit, parts))).alias(part))
    return wanted.join(poses.select(*series, part).distinct(), [*series, part], "left_anti")


def edge_layout(edges: DataFrame, spacing: float) -> DataFrame:
    """Adds ``offset``, where each edge starts on the line: lengths and spacings of those before it."""
    length = F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2)
    ahead = Window.orderBy("edge").rowsBetween(Window.unboundedPreceding, -1)
    rows = edges.withColumn("length", length)
    return rows.withColumn("offset", F.coalesce(F.sum(F.col("length") + spacing).over(ahead), F.lit(0.0)))


def linearise(df: DataFrame, track: DataFrame, key: list[str], x: str, y: str) -> DataFrame:
    """The nearest edge of the track for each row of ``key``, and the place on the line; ties go to the first edge.

    Every row is compared with every edge of the track, which is broadcast; a track of more than ``MOST_EDGES`` is an error.
    """
    if track.count() > MOST_EDGES:
        raise ValueError(f"a track has at most {MOST_EDGES} edges")
    met = df.select(*key, x, y).crossJoin(F.broadcast(track))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col(x) - F.col("x1")) * dx + (F.col(y) - F.col("y1")) * dy) / (dx * dx + dy * dy)))
    met = met.withColumn("_s", share).withColumn("_px", F.col("x1") + F.col("_s") * dx).withColumn("_py", F.col("y1") + F.col("_s") * dy)
    far = (F.col(x) - F.col("_px")) ** 2 + (F.col(y) - F.col("_py")) ** 2
    near = met.groupBy(*key).agg(F.min_by(F.struct("edge", "_px", "_py", (F.col("offset") + F.col("_s") * F.col("length")).alias("linear")), F.struct(far, F.col("edge"))).alias("_n"))
    return near.select(*key, F.col("_n.edge").alias("edge"), F.col("_n._px").alias("px"), F.col("_n._py").alias("py"), F.col("_n.linear").alias("linear"))

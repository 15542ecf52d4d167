"""Registered queries of the signal, event and position operators."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.blocks import BLOCK
from ..operators import events as E
from ..operators import position as P
from ..operators import signal as S
from .interval_queries import _SAMPLES, _samples
from .tables import DAY, HOUR, events, order_intervals, read, sql

C = ["event_type"]
TAPS = [0.1, 0.2, 0.4, 0.2, 0.1]


def _holes(s, d):
    """Values with every seventh sample missing."""
    return _samples(s, d).select("event_type", "idx", "t", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"))


_HOLES = f"{_SAMPLES}, ho AS (SELECT event_type, idx, t, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM sm)"


def f1_sampling_rate(s, d):
    fast = events(s, d).withColumn("t", F.floor(F.col("t") / 10000))
    return S.sampling_rate(fast, C, "t")


def f2_valid_intervals(s, d):
    return S.valid_intervals(events(s, d).select("event_type", "t"), C, "t", HOUR, 600_000_000, 1)


def f6_fir(s, d):
    return S.fir_small(_samples(s, d), C, "idx", "value", TAPS, block=BLOCK).select("event_type", "idx", F.round("filtered", 6).alias("filtered"))


def f6_fir_blocks(s, d):
    return S.fir_blocks(_samples(s, d), C, "idx", "value", TAPS, block=512).select("event_type", "idx", F.round("filtered", 6).alias("filtered"))


def f7_decimate(s, d):
    return S.decimate(S.fir_small(_samples(s, d), C, "idx", "value", TAPS, block=BLOCK), C, "idx", 10, numbered=True).select("event_type", "idx", F.round("filtered", 6).alias("filtered"))


def _hourly(s, d):
    return events(s, d).groupBy(F.floor(F.col("t") / HOUR).alias("hour"), "event_type").agg(F.round(F.avg("value"), 6).alias("value"))


_HOURLY = f"hm AS (SELECT t // {HOUR} AS hour, event_type, round(avg(value), 6) AS value FROM ev GROUP BY ALL)"


def f12_re_reference(s, d):
    h = _hourly(s, d)
    refs = h.select("event_type").distinct().withColumn("reference", F.when(F.col("event_type") != "click", "click"))
    return S.re_reference(h, ["hour"], "event_type", "value", refs).select("hour", "event_type", F.round("value", 5).alias("value"))


def f18_gaussian(s, d):
    return S.gaussian(_samples(s, d), C, "idx", "value", 1.5, block=BLOCK).select("event_type", "idx", F.round("smooth", 6).alias("smooth"))


def f19_moving_mean(s, d):
    return S.moving_mean(_holes(s, d), C, "idx", "value", 8, block=BLOCK).select("event_type", "idx", F.round("mean", 6).alias("mean"))


def f20_interpolate(s, d):
    return S.interpolate(_holes(s, d), C, "idx", "value", idx="idx").select("event_type", "idx", F.round("filled", 6).alias("filled"))


def f21_resample(s, d):
    ev = events(s, d).groupBy("event_type", "t").agg(F.max("value").alias("value"))
    grid = ev.select("event_type", (F.floor(F.col("t") / HOUR) * HOUR).alias("t")).distinct()
    return S.resample(ev, grid, C, "t", "value").select("event_type", "t", F.round("value", 5).alias("value"))


def f23_time_grid(s, d):
    return S.time_grid(order_intervals(s, d, 10), ["k"], 7 * DAY).select("k", "i", F.round("t", 0).cast("long").alias("t"))


def f24_align(s, d):
    ev = events(s, d).groupBy("event_type", "t").agg(F.max("value").alias("value"))
    clock = ev.select("event_type", (F.floor(F.col("t") / HOUR) * HOUR).alias("t")).distinct()
    return S.align_to_clock(ev, clock, C, "t", "value")


def f25_unwrap(s, d):
    a = _samples(s, d).withColumn("a", F.col("value") * (2 * math.pi / 100))
    return S.unwrap(a, C, "idx", "a", block=BLOCK).select("event_type", "idx", F.round("unwrapped", 4).alias("unwrapped"))


def f26_zscore(s, d):
    return S.zscore(events(s, d), C, "value").select("event_id", F.round("z", 6).alias("z"))


def f27_difference_artifacts(s, d):
    return S.difference_artifacts(_samples(s, d).withColumn("g", F.lit(0)), ["g"], "event_type", "idx", "value", 60, 80, 0.4, block=BLOCK)


def f28_mad(s, d):
    return S.mad_outliers(events(s, d), C, "value", 1.2).select("event_id", "outlier")


def f29_amplitude_artifacts(s, d):
    x = _samples(s, d).withColumn("g", F.lit(0))
    clock = x.where("event_type = 'click'").select("g", "idx", "t")
    whole = clock.groupBy("g").agg(F.min("t").alias("start"), F.max("t").alias("stop"))
    return S.amplitude_artifacts(x, clock, whole, ["g"], "event_type", "idx", "t", "value", 140, HOUR, 0.6, 1.6)


def f31_zero_out(s, d):
    x = _samples(s, d)
    return S.zero_out(x, x.where("value > 90"), C, "idx", "value").select("event_type", "idx", "value")


def f32_common_reference(s, d):
    return S.common_reference(_hourly(s, d), ["hour"], "value").select("hour", "event_type", F.round("value", 8).alias("value"))


def f36_growth(s, d):
    days = events(s, d).groupBy("event_type", F.floor(F.col("t") / DAY).alias("day")).agg(F.count("*").alias("n"))
    return S.growth_slope(days, C, "day", "n").select("event_type", F.round("median_slope", 6).alias("median_slope"), F.round("upper_slope", 6).alias("upper_slope"))


def e4_threshold_events(s, d):
    return E.threshold_events(_samples(s, d), C, "idx", "t", "value", 40, 80, 2, BLOCK)


def e8_peaks(s, d):
    return E.peaks(_samples(s, d), C, "idx", "value", 85, 3, BLOCK).select("event_type", "idx", "value")


def _xy(s, d):
    """A walk for each user: x is the value, y the event's number by type."""
    ev = events(s, d)
    return ev.select("user_id", "t", (F.row_number().over(Window.partitionBy("user_id").orderBy("t", "event_id"))).cast("long").alias("idx"), F.col("value").alias("x"), (F.col("event_id") % 100).cast("double").alias("y"))


_XY = "xy AS (SELECT user_id, t, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS idx, value AS x, (event_id % 100)::DOUBLE AS y FROM ev)"


def p3_speed(s, d):
    return P.speed(_xy(s, d), ["user_id"], "idx", "x", "y", 1.0, BLOCK).select("user_id", "idx", F.round("speed", 5).alias("speed"))


def p5_to_cm(s, d):
    return P.to_cm(_xy(s, d), ["x", "y"], 0.01).select("user_id", "idx", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def p7_low_likelihood(s, d):
    return P.low_likelihood(events(s, d).withColumn("likelihood", F.col("value") / 100), C, "likelihood", 0.5)


def p8_good_spans(s, d):
    return P.good_spans(_samples(s, d), C, "idx", F.col("value") < 30, 2)


def p10_inside(s, d):
    square = [(10.0, 10.0), (80.0, 20.0), (60.0, 90.0), (20.0, 70.0)]
    return P.inside_polygon(_xy(s, d), "x", "y", square).select("user_id", "idx", "inside")


def p13_orientation(s, d):
    w = Window.partitionBy("user_id").orderBy("idx")
    two = _xy(s, d).withColumn("x2", F.lag("x").over(w)).withColumn("y2", F.lag("y").over(w))
    return P.two_point_orientation(two, ("x", "y"), ("x2", "y2")).select("user_id", "idx", F.round("orientation", 6).alias("orientation"))


def p17_centroid(s, d):
    w = Window.partitionBy("user_id").orderBy("idx")
    two = _xy(s, d).withColumn("x2", F.lag("x").over(w)).withColumn("y2", F.lag("y").over(w))
    return P.centroid(two, [("x", "y"), ("x2", "y2")], 50.0).select("user_id", "idx", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))


EDGES = [(0, 0.0, 0.0, 100.0, 0.0), (1, 100.0, 0.0, 100.0, 100.0), (2, 100.0, 100.0, 0.0, 100.0)]


def l1_linearise(s, d):
    track = P.edge_layout(s.createDataFrame(EDGES, "edge int, x1 double, y1 double, x2 double, y2 double"), 15.0)
    return P.linearise(_xy(s, d), track, ["user_id", "idx"], "x", "y").select("user_id", "idx", "edge", F.round("linear", 5).alias("linear"))


QUERIES = {f.__name__: f for f in (f1_sampling_rate, f2_valid_intervals, f6_fir, f6_fir_blocks, f7_decimate, f12_re_reference, f18_gaussian, f19_moving_mean, f20_interpolate, f21_resample, f23_time_grid, f24_align, f25_unwrap, f26_zscore, f27_difference_artifacts, f28_mad, f29_amplitude_artifacts, f31_zero_out, f32_common_reference, f36_growth, e4_threshold_events, e8_peaks, p3_speed, p5_to_cm, p7_low_likelihood, p8_good_spans, p10_inside, p13_orientation, p17_centroid, l1_linearise)}

_FIR = f"{_SAMPLES}, fi AS (SELECT event_type, idx, " + " + ".join(f"coalesce({'lag' if k >= 2 else 'lead'}(value, {abs(k - 2)}) OVER w, 0) * {h}" for k, h in enumerate(TAPS)) + " AS y FROM sm WINDOW w AS (PARTITION BY event_type ORDER BY idx))"
_G = [math.exp(-0.5 * (k / 1.5) ** 2) for k in range(-6, 7)]
_SHIFTED = lambda k: f"{'lag' if k <= 0 else 'lead'}(value, {abs(k)}) OVER w"

ORACLES = {
    "f1_sampling_rate": sql("""
d0 AS (SELECT event_type, (t // 10000 - lag(t // 10000) OVER w) / 1e6 AS d, row_number() OVER w AS i FROM ev WINDOW w AS (PARTITION BY event_type ORDER BY t)),
d1 AS (SELECT event_type, d, i, sum(d) OVER (PARTITION BY event_type ORDER BY i ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING) / 10 AS s FROM d0 WHERE d IS NOT NULL),
e AS (SELECT event_type, log10(3 * avg(s)) AS top FROM d1 GROUP BY event_type HAVING count(*) >= 10),
b AS (SELECT event_type, top, least(99, floor((log10(s) + 5) / ((top + 5) / 100)))::INT AS b, count(*) AS k FROM d1 JOIN e USING (event_type) WHERE s > 0 AND log10(s) >= -5 AND log10(s) <= top GROUP BY ALL),
m AS (SELECT event_type, pow(10.0, -5 + arg_max(b, (k, -b)) * (any_value(top) + 5) / 100) AS usual FROM b GROUP BY event_type)
SELECT event_type, round(1 / avg(d)) AS rate FROM d1 JOIN m USING (event_type) WHERE d < 1.75 * usual GROUP BY event_type"""),
    "f2_valid_intervals": sql(f"""g0 AS (SELECT event_type, t, t - lag(t) OVER w > {HOUR} AS far FROM ev WINDOW w AS (PARTITION BY event_type ORDER BY t)),
g1 AS (SELECT *, sum(coalesce(far, false)::INT) OVER (PARTITION BY event_type ORDER BY t RANGE UNBOUNDED PRECEDING) AS g FROM g0), h AS (SELECT event_type, (max(t) - min(t)) / 2 AS half FROM ev GROUP BY event_type),
x AS (SELECT event_type, min(t) - 1 AS start, max(t) + 1 AS stop FROM g1 GROUP BY event_type, g) SELECT x.* FROM x JOIN h USING (event_type) WHERE stop - start > CASE WHEN 2 * half < 600000000 THEN half ELSE 600000000 END"""),
    "f6_fir": sql(f"{_FIR} SELECT event_type, idx, round(y, 6) AS filtered FROM fi"),
    "f6_fir_blocks": sql(f"{_FIR} SELECT event_type, idx, round(y, 6) AS filtered FROM fi"),
    "f7_decimate": sql(f"{_FIR} SELECT event_type, idx, round(y, 6) AS filtered FROM fi WHERE idx % 10 = 0"),
    "f12_re_reference": sql(f"{_HOURLY} SELECT a.hour, a.event_type, round(a.value - CASE WHEN a.event_type = 'click' THEN 0 ELSE coalesce(b.value, 0) END, 5) AS value FROM hm a LEFT JOIN hm b ON a.hour = b.hour AND b.event_type = 'click'"),
    "f18_gaussian": sql(f"{_SAMPLES} SELECT event_type, idx, round((" + " + ".join(f"coalesce({_SHIFTED(k)}, 0) * {_G[k + 6]!r}" for k in range(-6, 7)) + ") / (" + " + ".join(f"CASE WHEN {_SHIFTED(k)} IS NULL THEN 0 ELSE {_G[k + 6]!r} END" for k in range(-6, 7)) + "), 6) AS smooth FROM sm WINDOW w AS (PARTITION BY event_type ORDER BY idx)"),
    "f19_moving_mean": sql(f"{_HOLES} SELECT event_type, idx, round(avg(value) OVER (PARTITION BY event_type ORDER BY idx ROWS BETWEEN 7 PRECEDING AND CURRENT ROW), 6) AS mean FROM ho"),
    "f20_interpolate": sql(f"""{_HOLES}, z AS (SELECT *, last_value(value IGNORE NULLS) OVER a AS av, last_value(CASE WHEN value IS NOT NULL THEN idx END IGNORE NULLS) OVER a AS ai, first_value(value IGNORE NULLS) OVER b AS bv, first_value(CASE WHEN value IS NOT NULL THEN idx END IGNORE NULLS) OVER b AS bi FROM ho
WINDOW a AS (PARTITION BY event_type ORDER BY idx ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY event_type ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) SELECT event_type, idx, round(coalesce(value, av + (bv - av) * ((idx - ai) / (bi - ai))), 6) AS filled FROM z"""),
    "f21_resample": sql(f"""e0 AS (SELECT event_type, t, max(value) AS value FROM ev GROUP BY ALL), gr AS (SELECT DISTINCT event_type, t // {HOUR} * {HOUR} AS t FROM ev),
u AS (SELECT event_type, t, max(value) AS value, max(g) AS g FROM (SELECT event_type, t, value, 0 AS g FROM e0 UNION ALL SELECT event_type, t, NULL, 1 FROM gr) GROUP BY ALL),
z AS (SELECT *, last_value(value IGNORE NULLS) OVER a AS av, last_value(CASE WHEN value IS NOT NULL THEN t END IGNORE NULLS) OVER a AS ta, first_value(value IGNORE NULLS) OVER b AS bv, first_value(CASE WHEN value IS NOT NULL THEN t END IGNORE NULLS) OVER b AS tb FROM u
WINDOW a AS (PARTITION BY event_type ORDER BY t ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY event_type ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_type, t, round(coalesce(value, av + (bv - av) * ((t - ta) / (tb - ta)), av), 5) AS value FROM z WHERE g = 1"""),
    "f23_time_grid": sql(f"h AS (SELECT k, min(start) AS a, max(stop) AS b FROM oi GROUP BY k), n AS (SELECT *, greatest(1, ceil((b - a) / {7 * DAY}))::BIGINT AS n FROM h), i AS (SELECT *, unnest(range(0, n + 1)) AS i FROM n) SELECT k, i, round(a + (b - a) * i / n, 0)::BIGINT AS t FROM i", 10),
    "f24_align": sql(f"gr AS (SELECT DISTINCT event_type, t // {HOUR} * {HOUR} AS t FROM ev), p AS (SELECT event_type, t // {HOUR} * {HOUR} AS c, max(value) AS value, t FROM ev GROUP BY event_type, t), m AS (SELECT event_type, c, arg_max(value, t) AS value FROM p GROUP BY ALL) SELECT gr.event_type, gr.t, m.value FROM gr LEFT JOIN m ON m.event_type = gr.event_type AND m.c = gr.t"),
    "f25_unwrap": sql(f"{_SAMPLES}, a AS (SELECT event_type, idx, value * {2 * math.pi / 100!r} AS a FROM sm), j AS (SELECT *, coalesce(round((a - lag(a) OVER (PARTITION BY event_type ORDER BY idx)) / {2 * math.pi!r}), 0) AS j FROM a) SELECT event_type, idx, round(a - {2 * math.pi!r} * sum(j) OVER (PARTITION BY event_type ORDER BY idx ROWS UNBOUNDED PRECEDING), 4) AS unwrapped FROM j"),
    "f26_zscore": sql("z AS (SELECT event_id, (value - avg(value) OVER w) / stddev_pop(value) OVER w AS z FROM ev WINDOW w AS (PARTITION BY event_type)) SELECT event_id, round(z, 6) AS z FROM z"),
    "f27_difference_artifacts": sql(f"""{_SAMPLES}, a AS (SELECT *, coalesce(value - lag(value) OVER (PARTITION BY event_type ORDER BY idx), 0) AS d FROM sm),
b AS (SELECT event_type, idx, abs(sum(d) OVER (PARTITION BY event_type ORDER BY idx ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING)) AS s, max(value) OVER r - min(value) OVER r AS r FROM a WINDOW r AS (PARTITION BY event_type ORDER BY idx ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING))
SELECT 0 AS g, idx FROM b GROUP BY idx HAVING count(*) FILTER (s > 60 AND r > 80) >= ceil(count(*) * 0.4) AND idx > 3"""),
    "f28_mad": sql("m AS (SELECT event_type, median(value) AS med FROM ev GROUP BY 1), v AS (SELECT event_id, event_type, abs(value - med) AS dev FROM ev JOIN m USING (event_type)), a AS (SELECT event_type, median(dev) * 1.4826 AS mad FROM v GROUP BY 1) SELECT event_id, dev / CASE WHEN mad > 0 THEN mad ELSE 1 END > 1.2 AS outlier FROM v JOIN a USING (event_type)"),
    "f31_zero_out": sql(f"{_SAMPLES} SELECT event_type, idx, CASE WHEN value > 90 THEN 0.0 ELSE value END AS value FROM sm"),
    "f32_common_reference": sql(f"{_HOURLY} SELECT hour, event_type, round(value - median(value) OVER (PARTITION BY hour), 8) AS value FROM hm"),
    "f36_growth": sql(f"y AS (SELECT event_type, t // {DAY} AS day, count(*) AS n FROM ev GROUP BY ALL), p AS (SELECT a.event_type, (b.n - a.n) / (b.day - a.day) AS s FROM y a JOIN y b ON a.event_type = b.event_type AND a.day < b.day) SELECT event_type, round(quantile_cont(s, 0.5), 6) AS median_slope, round(quantile_cont(s, 0.75), 6) AS upper_slope FROM p GROUP BY event_type"),
    "e4_threshold_events": sql(f"""{_SAMPLES}, r AS (SELECT event_type, idx, t, value, idx - row_number() OVER (PARTITION BY event_type ORDER BY idx) AS g FROM sm WHERE value >= 40)
SELECT event_type, min(t) AS start, max(t) AS stop, count(*) AS samples, max(value) AS peak FROM r GROUP BY event_type, g HAVING max(value) >= 80 AND count(*) >= 2"""),
    "e8_peaks": sql(f"{_SAMPLES}, w AS (SELECT event_type, idx, value, max(value) OVER (PARTITION BY event_type ORDER BY idx ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS m FROM sm) SELECT event_type, idx, value FROM w WHERE value >= 85 AND value = m"),
    "p3_speed": sql(f"""{_XY}, v AS (SELECT user_id, idx, (coalesce(lead(x) OVER w, x) - coalesce(lag(x) OVER w, x)) / nullif(coalesce(lead(idx) OVER w, idx) - coalesce(lag(idx) OVER w, idx), 0) AS vx, (coalesce(lead(y) OVER w, y) - coalesce(lag(y) OVER w, y)) / nullif(coalesce(lead(idx) OVER w, idx) - coalesce(lag(idx) OVER w, idx), 0) AS vy FROM xy WINDOW w AS (PARTITION BY user_id ORDER BY idx))
SELECT user_id, idx, round(sqrt(vx * vx + vy * vy), 5) AS speed FROM v"""),
    "p5_to_cm": sql(f"{_XY} SELECT user_id, idx, round(x * 0.01 * 100, 6) AS x, round(y * 0.01 * 100, 6) AS y FROM xy"),
    "p7_low_likelihood": sql("x AS (SELECT event_type, count(*) FILTER (value / 100 < 0.5) AS low, count(*) AS n FROM ev GROUP BY 1) SELECT event_type, low, round(100 * low / n, 6) AS percent FROM x"),
    "p8_good_spans": sql(f"""{_SAMPLES}, g AS (SELECT event_type, idx, CASE WHEN idx - lag(idx) OVER (PARTITION BY event_type ORDER BY idx) - 1 > 2 THEN 1 ELSE 0 END AS b FROM sm WHERE value >= 30), r AS (SELECT *, sum(b) OVER (PARTITION BY event_type ORDER BY idx ROWS UNBOUNDED PRECEDING) AS r FROM g) SELECT event_type, min(idx) AS start, max(idx) AS stop FROM r GROUP BY event_type, r"""),
    "p13_orientation": sql(f"{_XY} SELECT user_id, idx, round(atan2(y - lag(y) OVER w, x - lag(x) OVER w), 6) AS orientation FROM xy WINDOW w AS (PARTITION BY user_id ORDER BY idx)"),
    "p17_centroid": sql(f"""{_XY}, z AS (SELECT user_id, idx, x, y, lag(x) OVER w AS x2, lag(y) OVER w AS y2 FROM xy WINDOW w AS (PARTITION BY user_id ORDER BY idx)), q AS (SELECT *, sqrt((x - x2) * (x - x2) + (y - y2) * (y - y2)) AS far FROM z)
SELECT user_id, idx, round(CASE WHEN x2 IS NULL THEN x WHEN far < 50 THEN (x + x2) / 2 END, 6) AS cx, round(CASE WHEN x2 IS NULL THEN y WHEN far < 50 THEN (y + y2) / 2 END, 6) AS cy FROM q"""),
    "l1_linearise": sql(f"""{_XY}, e AS (SELECT * FROM (VALUES (0, 0.0, 0.0, 100.0, 0.0, 0.0), (1, 100.0, 0.0, 100.0, 100.0, 115.0), (2, 100.0, 100.0, 0.0, 100.0, 230.0)) v(edge, x1, y1, x2, y2, o)),
p AS (SELECT user_id, idx, x, y, edge, x1, y1, x2, y2, o, greatest(0.0, least(1.0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) AS s FROM xy, e),
m AS (SELECT *, (x - x1 - s * (x2 - x1)) * (x - x1 - s * (x2 - x1)) + (y - y1 - s * (y2 - y1)) * (y - y1 - s * (y2 - y1)) AS far, o + s * 100 AS lin FROM p)
SELECT user_id, idx, arg_min(edge, (far, edge))::INT AS edge, round(arg_min(lin, (far, edge)), 5) AS linear FROM m GROUP BY user_id, idx"""),
}

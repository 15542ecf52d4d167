"""Registered queries of compositions and of smaller operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.blocks import BLOCK
from ..operators import components as C
from ..operators import events as E
from ..operators import intervals as I
from ..operators import position as P
from ..operators import provenance as V
from ..operators import quality as Q
from ..operators import session as A
from ..operators import signal as S
from ..operators import spikes as K
from .interval_queries import _SAMPLES, _samples
from .signal_queries import _XY, TAPS, _xy
from .tables import DAY, HOUR, above_mean, events, read, smoothed, sql


def a9_regular_time(s, d):
    return A.with_regular_time(_samples(s, d), "idx", 1000, 33333).select("event_type", "idx", "t")


def a12_join_on_time(s, d):
    hours = events(s, d).groupBy("event_type", F.floor(F.col("t") / HOUR).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    one = lambda name: hours.where(F.col("event_type") == name).select("hour", F.col("n").alias(name))
    return A.join_on_time({"click": one("click"), "purchase": one("purchase")}, "hour")


def a13_import_bounds(s, d):
    return A.import_bounds(events(s, d), ["event_type"], "t")


def a18_task_epochs(s, d):
    own = F.col("o_custkey").cast("string")
    # the second camera is one that no customer has, however many there are
    o = read(s, d, "orders").select("o_orderkey", F.array(F.lit(1)).alias("epochs"), F.array(own, F.concat(own, F.lit("x"))).alias("cameras"))
    intervals = o.select("o_orderkey", F.lit(1).alias("epoch"), F.lit("01").alias("interval_name"))
    known = read(s, d, "customer").select(F.col("c_custkey").cast("string").alias("camera"))
    return A.task_epochs(o, "o_orderkey", "epochs", "cameras", intervals, known).select("o_orderkey", "cameras")


def f10_lfp_pipeline(s, d):
    """Intersect with valid times, filter, decimate and censor."""
    x = _samples(s, d)
    valid = S.valid_intervals(x, ["event_type"], "t", HOUR, HOUR)
    days = x.select("event_type", (F.floor(F.col("t") / DAY) * DAY).alias("start")).distinct().withColumn("stop", F.col("start") + DAY // 2)
    used = I.intersect(valid, days, ["event_type"], 0, DAY)
    inside = I.contains(x, used, ["event_type"], "t").select("event_type", "start", "idx", "t", "value")
    low = S.decimate(S.fir_small(inside, ["event_type", "start"], "idx", "value", TAPS), ["event_type", "start"], "idx", 4)
    return low.select("event_type", "start", "idx", F.round("filtered", 6).alias("filtered"))


def f17_power(s, d):
    return S.phase_and_power(S.analytic(_samples(s, d), ["event_type"], "idx", "value", 16, 512)).select("event_type", "idx", F.round("power", 4).alias("power"))


def e1_consensus(s, d):
    days = events(s, d).groupBy(F.floor(F.col("t") / DAY).alias("idx"), "event_type").agg(F.round(F.avg("value"), 6).alias("value")).withColumn("g", F.lit(0))
    return E.consensus_trace(days, ["g"], "event_type", "idx", "value", 1.5, BLOCK).select("idx", F.round("trace", 5).alias("trace"))


def _hours(s, d):
    """Counts and mean values of each event type's hours that have events, numbered."""
    hours = events(s, d).groupBy("event_type", F.floor(F.col("t") / HOUR).alias("hour")).agg(F.count("*").cast("double").alias("n"), F.round(F.avg("value"), 6).alias("speed"))
    return hours.withColumn("idx", F.row_number().over(Window.partitionBy("event_type").orderBy("hour")))


def e5_high_synchrony(s, d):
    h = _hours(s, d)
    return E.high_synchrony(h, ["event_type"], "idx", "hour", "n", 0.5, 1, 1.0, h, "speed", 120.0, block=BLOCK).select("event_type", "start", "stop", "samples")


def p11_interpolate_spans(s, d):
    bad = _xy(s, d).withColumn("x", F.when(F.col("x") >= 20, F.col("x")))
    return S.interpolate(bad, ["user_id"], "t", "x", idx="idx").select("user_id", "idx", F.round("filled", 5).alias("filled"))


def p12_smooth_interp(s, d):
    bad = _xy(s, d).withColumn("x", F.when(F.col("x") >= 20, F.col("x")))
    filled = S.interpolate(bad, ["user_id"], "t", "x", idx="idx")
    return S.moving_mean(filled, ["user_id"], "idx", "filled", 5, block=BLOCK).select("user_id", "idx", F.round("mean", 4).alias("mean"))


def p21_pose_quality(s, d):
    return P.low_likelihood(events(s, d).withColumn("likelihood", F.col("value") / 100), ["event_type", "user_id"], "likelihood", 0.95)


def p26_position_group(s, d):
    ev = events(s, d).where("value > 10").select("event_id", "t", "value", "event_type")
    return A.position_group([ev.where(F.col("event_type") == c).select("event_id", "t", "value") for c in ("click", "view", "purchase")], "t", 0)


def k9_merge_groups(s, d):
    ev = events(s, d)  # a user and the hour of an event
    pairs = ev.select(F.col("user_id").alias("x"), (F.floor(F.col("t") / HOUR) + 1_000_000_000).alias("y"))
    return C.merge_groups(pairs, "x", "y")


def k10_apply_merges(s, d):
    ev = events(s, d).where("user_id is not null")
    pairs = ev.select("user_id").distinct().where("user_id % 4 = 0").select(F.col("user_id").alias("x"), (F.col("user_id") + 1).alias("y"))
    return C.apply_merges(ev.select("event_id", "user_id"), "user_id", C.merge_groups(pairs, "x", "y"))


def k31_accepted_units(s, d):
    li = read(s, d, "lineitem")
    metrics = li.groupBy(F.col("l_suppkey").alias("unit"), F.lower("l_returnflag").alias("metric")).agg(F.sum("l_quantity").cast("double").alias("value")).where("value > 600 or metric <> 'r'")
    labels = read(s, d, "supplier").select(F.col("s_suppkey").alias("unit"), F.when(F.col("s_acctbal") < 0, F.array(F.lit("mua"), F.lit("reject"))).otherwise(F.array(F.lit("accept"), F.lit("near"))).alias("labels"))
    return K.accepted_units(labels, metrics, "unit", ["a", "n", "r"], -1.0)


def w1_waveforms(s, d):
    x = _samples(s, d)
    return K.waveforms(x, x.where("value > 97"), ["event_type"], "idx", "value", 4, 6)


def v8_content_hash(s, d):
    e = read(s, d, "supplier")
    return e.select("s_suppkey", Q.row_digest(e, ["s_name", "s_nationkey"], 2).alias("digest"))


def v13_redundant(s, d):
    return V.redundant(read(s, d, "orders"), ["o_custkey"], F.col("o_orderstatus") == "F").select("o_orderkey")


def v16_validation(s, d):
    return Q.severity(read(s, d, "documents"), "n_chars", 1000, 3000, "text").select("doc_id", "severity", "message")


def v22_nan_default(s, d):
    x = events(s, d).select("event_id", F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("v"))
    return x.select("event_id", Q.nan_default(F.col("v")).alias("v"))


def j1_curation_json(s, d):
    return Q.labels_from_json(events(s, d), "props").select("event_id", "label", "value")


def l4_edge_layout(s, d):
    n = read(s, d, "nation").select(F.col("n_nationkey").alias("edge"), F.lit(0.0).alias("x1"), F.lit(0.0).alias("y1"), (F.col("n_regionkey") + 1).cast("double").alias("x2"), F.lit(0.0).alias("y2"))
    return P.edge_layout(n, 15.0).select("edge", "offset")


QUERIES = {f.__name__: f for f in (a9_regular_time, a12_join_on_time, a13_import_bounds, a18_task_epochs, f10_lfp_pipeline, f17_power, e1_consensus, e5_high_synchrony, p11_interpolate_spans, p12_smooth_interp, p21_pose_quality, p26_position_group, k9_merge_groups, k10_apply_merges, k31_accepted_units, w1_waveforms, v8_content_hash, v13_redundant, v16_validation, v22_nan_default, j1_curation_json, l4_edge_layout)}

_FILL = f"""{_XY}, ho AS (SELECT user_id, idx, t, CASE WHEN x >= 20 THEN x END AS x FROM xy),
z AS (SELECT *, last_value(x IGNORE NULLS) OVER a AS av, last_value(CASE WHEN x IS NOT NULL THEN t END IGNORE NULLS) OVER a AS ta, first_value(x IGNORE NULLS) OVER b AS bv, first_value(CASE WHEN x IS NOT NULL THEN t END IGNORE NULLS) OVER b AS tb FROM ho
WINDOW a AS (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY user_id ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), fi AS (SELECT user_id, idx, coalesce(x, av + (bv - av) * ((t - ta) / (tb - ta))) AS f FROM z)"""

ORACLES = {
    "a9_regular_time": sql(f"{_SAMPLES} SELECT event_type, idx, 1000 + idx * 33333 AS t FROM sm"),
    "a12_join_on_time": sql(f"x AS (SELECT t // {HOUR} AS hour, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'purchase') AS purchase FROM ev GROUP BY 1) SELECT * FROM x WHERE click > 0 AND purchase > 0"),
    "a13_import_bounds": sql("x AS (SELECT event_type, min(t) AS start, max(t) AS stop, count(*) AS n FROM ev GROUP BY 1) SELECT * FROM x"),
    "a18_task_epochs": "SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer) THEN o_custkey::VARCHAR END AS cameras FROM orders",
    "p11_interpolate_spans": sql(f"{_FILL} SELECT user_id, idx, round(f, 5) AS filled FROM fi"),
    "p12_smooth_interp": sql(f"{_FILL} SELECT user_id, idx, round(avg(f) OVER (PARTITION BY user_id ORDER BY idx ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 4) AS mean FROM fi"),
    "p21_pose_quality": sql("x AS (SELECT event_type, user_id, count(*) FILTER (value / 100 < 0.95) AS low, count(*) AS n FROM ev GROUP BY ALL) SELECT event_type, user_id, low, round(100 * low / n, 6) AS percent FROM x"),
    "p26_position_group": sql("x AS (SELECT event_id, t, value FROM ev WHERE event_type IN ('click', 'view', 'purchase') AND value > 10) SELECT * FROM x"),
    "k9_merge_groups": f"""WITH RECURSIVE p AS (SELECT DISTINCT user_id AS x, epoch_us(ts::TIMESTAMP) // {HOUR} + 1000000000 AS y FROM events WHERE user_id IS NOT NULL), e AS (SELECT x, y FROM p UNION SELECT y, x FROM p),
r(member, c) AS (SELECT x, x FROM e UNION SELECT r.member, e.y FROM r JOIN e ON e.x = r.c) SELECT member, min(c) AS root FROM r GROUP BY member""",
    "k10_apply_merges": sql("m AS (SELECT max(user_id) AS m FROM ev), g AS (SELECT user_id AS u, row_number() OVER (ORDER BY user_id) AS k FROM (SELECT DISTINCT user_id FROM ev WHERE user_id % 4 = 0)) SELECT event_id, coalesce(m + k, user_id) AS user_id FROM ev CROSS JOIN m LEFT JOIN g ON user_id IN (u, u + 1)"),
    "k31_accepted_units": """WITH m AS (SELECT l_suppkey AS unit, lower(l_returnflag) AS metric, sum(l_quantity)::DOUBLE AS value FROM lineitem GROUP BY ALL HAVING value > 600 OR metric <> 'r')
SELECT s_suppkey AS unit, 'accept,near' AS labels, coalesce(max(value) FILTER (metric = 'a'), -1.0) AS a, coalesce(max(value) FILTER (metric = 'n'), -1.0) AS n, coalesce(max(value) FILTER (metric = 'r'), -1.0) AS r FROM supplier LEFT JOIN m ON unit = s_suppkey WHERE s_acctbal >= 0 GROUP BY s_suppkey""",
    "w1_waveforms": sql(f'{_SAMPLES} SELECT a.event_type, a.idx AS spike, (b.idx - a.idx)::INT AS "offset", b.value FROM sm a JOIN sm b ON a.event_type = b.event_type AND b.idx BETWEEN a.idx - 4 AND a.idx + 5 WHERE a.value > 97'),
    "v8_content_hash": "SELECT s_suppkey, sha256(concat_ws('|', s_name, s_nationkey::VARCHAR)) AS digest FROM supplier",
    "v13_redundant": "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
    "v16_validation": "SELECT doc_id, CASE WHEN n_chars > 3000 THEN 'violation' WHEN n_chars > 1000 THEN 'warning' ELSE 'ok' END AS severity, substring(regexp_replace(text, '[^\\x20-\\x7E]', '', 'g'), 1, 255) AS message FROM documents",
    "v22_nan_default": "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN -1.0 ELSE value END AS v FROM events",
    "j1_curation_json": "SELECT event_id, 'k' AS label, (props::JSON ->> 'k')::BIGINT AS value FROM events",
    "l4_edge_layout": 'SELECT n_nationkey AS edge, coalesce(sum(n_regionkey + 1 + 15.0) OVER (ORDER BY n_nationkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS "offset" FROM nation',
    "f10_lfp_pipeline": sql(f"""{_SAMPLES}, g0 AS (SELECT *, t - lag(t) OVER (PARTITION BY event_type ORDER BY t) > {HOUR} AS far FROM sm), g1 AS (SELECT *, sum(coalesce(far, false)::INT) OVER (PARTITION BY event_type ORDER BY t RANGE UNBOUNDED PRECEDING) AS g FROM g0),
w AS (SELECT event_type, max(t) - min(t) AS whole FROM sm GROUP BY 1), va AS (SELECT event_type, min(t) AS a, max(t) AS b FROM g1 GROUP BY event_type, g), vb AS (SELECT va.* FROM va JOIN w USING (event_type) WHERE b - a > CASE WHEN whole < {HOUR} THEN whole / 2 ELSE {HOUR} END),
dy AS (SELECT DISTINCT event_type, t // {DAY} * {DAY} AS c FROM sm), us AS (SELECT event_type, greatest(a, c) AS start, least(b, c + {DAY // 2}) AS stop FROM vb JOIN dy USING (event_type) WHERE least(b, c + {DAY // 2}) > greatest(a, c)),
i AS (SELECT sm.event_type, us.start, sm.idx, sm.value FROM sm JOIN us ON sm.event_type = us.event_type AND sm.t BETWEEN us.start AND us.stop),
fi AS (SELECT event_type, start, idx, row_number() OVER w - 1 AS n, {" + ".join(f"coalesce({'lag' if k >= 2 else 'lead'}(value, {abs(k - 2)}) OVER w, 0) * {h}" for k, h in enumerate(TAPS))} AS y FROM i WINDOW w AS (PARTITION BY event_type, start ORDER BY idx))
SELECT event_type, start, idx, round(y, 6) AS filtered FROM fi WHERE n % 4 = 0"""),
    "e1_consensus": sql(f"""dm AS (SELECT t // {DAY} AS idx, event_type, round(avg(value), 6) AS value FROM ev GROUP BY ALL), c AS (SELECT count(DISTINCT event_type) AS c FROM dm), p AS (SELECT idx, sum(value * value) AS x FROM dm GROUP BY idx HAVING count(*) = (SELECT c FROM c)),
{smoothed("p", "sg", "x", "idx", 1.5)} SELECT idx, round(sqrt(y), 5) AS trace FROM sg"""),
    "e5_high_synchrony": sql(f"""h AS (SELECT event_type, t // {HOUR} AS hour, count(*)::DOUBLE AS x, round(avg(value), 6) AS speed FROM ev GROUP BY ALL), {smoothed("h", "sg", "x", "hour", 1.0, "event_type")},
z AS (SELECT *, (y - avg(y) OVER (PARTITION BY event_type)) / stddev_pop(y) OVER (PARTITION BY event_type) AS z, row_number() OVER (PARTITION BY event_type ORDER BY hour) AS i FROM sg),
{above_mean("z", "am", "event_type", "i", "hour", 0.5, 1)},
sp AS (SELECT event_type, t // {HOUR} AS hour FROM ev GROUP BY ALL HAVING round(avg(value), 6) <= 120)
SELECT am.* EXCLUDE (peak) FROM am WHERE EXISTS (SELECT 1 FROM sp WHERE sp.event_type = am.event_type AND sp.hour = am.start) AND EXISTS (SELECT 1 FROM sp WHERE sp.event_type = am.event_type AND sp.hour = am.stop)"""),
    "f29_amplitude_artifacts": sql(f"""{_SAMPLES}, z AS (SELECT idx, abs(value) > 140 OR abs(value - avg(value) OVER (PARTITION BY idx)) > 1.6 * stddev_pop(value) OVER (PARTITION BY idx) AS hit FROM sm), h AS (SELECT idx FROM z GROUP BY idx HAVING count(*) FILTER (hit) >= ceil(count(*) * 0.6)),
r0 AS (SELECT idx, idx - row_number() OVER (ORDER BY idx) AS g FROM h), r AS (SELECT min(idx) AS i, max(idx) AS j FROM r0 GROUP BY g), c AS (SELECT idx, t FROM sm WHERE event_type = 'click'), w AS (SELECT min(t) AS lo, max(t) AS hi FROM c),
m AS (SELECT s.t - {HOUR // 2} AS a, least(e.t + {HOUR // 2}, hi) AS b FROM r JOIN c s ON s.idx = i JOIN c e ON e.idx = j, w), f AS (SELECT *, max(b) OVER (ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM m),
k AS (SELECT *, sum((far IS NULL OR a > far)::INT) OVER (ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM f), o AS (SELECT min(a) AS a, max(b) AS b FROM k GROUP BY g),
p AS (SELECT greatest(lo, coalesce(lag(b) OVER (ORDER BY a), lo)) AS start, least(hi, a) AS stop FROM o, w UNION ALL SELECT greatest(lo, (SELECT max(b) FROM o)), hi FROM w WHERE EXISTS (SELECT 1 FROM o))
SELECT 0 AS g, start, stop FROM p WHERE stop - start > 1000000 UNION ALL SELECT 0, lo, hi FROM w WHERE NOT EXISTS (SELECT 1 FROM h)"""),
    "p10_inside": sql(f"""{_XY}, e AS (SELECT * FROM (VALUES (10.0, 10.0, 80.0, 20.0), (80.0, 20.0, 60.0, 90.0), (60.0, 90.0, 20.0, 70.0), (20.0, 70.0, 10.0, 10.0)) v(x1, y1, x2, y2))
SELECT user_id, idx, count(*) FILTER ((y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1) % 2 = 1 AS inside FROM xy, e GROUP BY user_id, idx"""),
    "flagship": sql(f"""m AS (SELECT event_type, t, max(t + {2 * HOUR}) OVER (PARTITION BY event_type ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM ev), g AS (SELECT *, sum((far IS NULL OR t > far)::INT) OVER (PARTITION BY event_type ORDER BY t ROWS UNBOUNDED PRECEDING) AS g FROM m),
va AS (SELECT event_type, min(t) AS a, max(t) + {2 * HOUR} AS b FROM g GROUP BY event_type, g), dy AS (SELECT DISTINCT event_type, t // {DAY} * {DAY} AS c FROM ev), p AS (SELECT event_type, greatest(a, c) AS start, least(b, c + {DAY // 2}) AS stop FROM va JOIN dy USING (event_type) WHERE least(b, c + {DAY // 2}) > greatest(a, c))
SELECT p.event_type, start, stop, count(*) AS n, round(avg(value), 10) AS mean_value, round(count(*) * {HOUR} / (stop - start), 6) AS per_hour FROM p JOIN ev ON ev.event_type = p.event_type AND t BETWEEN start AND stop GROUP BY p.event_type, start, stop"""),
    "f17_power": sql(f"{_SAMPLES} SELECT event_type, idx, round(value * value + im * im, 4) AS power FROM (SELECT event_type, idx, value, " + " + ".join(f"coalesce({'lag' if k >= 16 else 'lead'}(value, {abs(k - 16)}) OVER w, 0) * {h!r}" for k, h in enumerate(S.hilbert_taps(16)) if h) + " AS im FROM sm WINDOW w AS (PARTITION BY event_type ORDER BY idx))"),
}

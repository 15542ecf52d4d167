"""Registered queries of the interval algebra."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.blocks import BLOCK, numbered
from ..operators import intervals as I
from .tables import DAY, HOUR, events, order_intervals, read, sql

K = ["k"]


def _parity_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each event type an interval of half a day on each day that has events."""
    ev = events(spark, sf_dir)
    day = F.floor(F.col("t") / DAY) * DAY
    return ev.select("event_type", day.alias("start")).distinct().select("event_type", F.col("start"), (F.col("start") + DAY // 2).alias("stop"))


_DAYS = f"pd AS (SELECT DISTINCT event_type, t // {DAY} * {DAY} AS start, t // {DAY} * {DAY} + {DAY // 2} AS stop FROM ev)"
_ISLANDS = """{src}_n AS (SELECT DISTINCT k, start, stop FROM {src} WHERE start <= stop),
{src}_m AS (SELECT *, max(stop) OVER (PARTITION BY k ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM {src}_n),
{src}_g AS (SELECT *, sum(CASE WHEN far IS NULL OR start {op} far THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS g FROM {src}_m),
{out} AS (SELECT k, min(start) AS start, max(stop) AS stop FROM {src}_g GROUP BY k, g)"""


def _islands(src: str, op: str, out: str) -> str:
    return _ISLANDS.format(src=src, op=op, out=out)


def i1_normalise(spark, d):
    return I.normalise(order_intervals(spark, d), K)


def i2_from_indices(spark, d):
    return I.from_indices(read(spark, d, "lineitem"), ["l_suppkey"], "l_partkey")


def i3_by_length(spark, d):
    c = I.consolidate(order_intervals(spark, d), K)
    return I.by_length(c, 60 * DAY, 200 * DAY)


def i4_contains(spark, d):
    return I.contains(events(spark, d).select("event_id", "event_type", "t"), _parity_days(spark, d), ["event_type"], "t")


def i5_excludes(spark, d):
    return I.excludes(events(spark, d).select("event_type", "t"), _parity_days(spark, d), ["event_type"], "t")


def i6_consolidate(spark, d):
    return I.consolidate(order_intervals(spark, d), K)


def i7_union(spark, d):
    return I.union(order_intervals(spark, d), order_intervals(spark, d, 60, 60), K)


def i8_intersect(spark, d):
    return I.intersect(order_intervals(spark, d), order_intervals(spark, d, 60, 45), K, DAY)


def i9_subtract(spark, d):
    return I.subtract(order_intervals(spark, d), order_intervals(spark, d, 30, 45), K)


def i10_censor(spark, d):
    points = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    mine = order_intervals(spark, d).join(points.where("n > 3"), "k").select("k", F.col("start").alias("t"))
    return I.censor(order_intervals(spark, d), mine, K, "t")


def i11_adjacent(spark, d):
    lines = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_linenumber") * 2).cast("long").alias("start"), (F.col("l_linenumber") * 2 + F.col("l_quantity").cast("int") % 2).cast("long").alias("stop"))
    return I.union_adjacent_index(lines, K)


def _samples(spark, d):
    """Events of a type numbered by time."""
    return numbered(events(spark, d).select("event_type", "event_id", "t", "value"), ["event_type"], ["t", "event_id"], "idx")


_SAMPLES = "sm AS (SELECT event_type, event_id, t, value, row_number() OVER (PARTITION BY event_type ORDER BY t, event_id) - 1 AS idx FROM ev)"


def i12_removal_window(spark, d):
    s = _samples(spark, d)
    ranges = I.from_indices(s.where("value > 80"), ["event_type"], "idx")
    return I.add_removal_window(ranges, s, ["event_type"], "idx", "t", HOUR)


def i13_to_indices(spark, d):
    bounds = _parity_days(spark, d).select("event_type", F.explode(F.array("start", "stop")).alias("x")).distinct()
    return I.to_indices(bounds, events(spark, d), ["event_type"], "t")


def i14_to_seconds(spark, d):
    s = _samples(spark, d)
    return I.to_times(I.from_indices(s.where("value > 50"), ["event_type"], "idx"), s, ["event_type"], "idx", "t")


def i15_sample_ranges(spark, d):
    return I.sample_ranges(_parity_days(spark, d), events(spark, d), ["event_type"], "t")


def i16_merge_closed(spark, d):
    return I.merge_touching(order_intervals(spark, d, 30), K)


def i17_mask_runs(spark, d):
    return I.runs_of(_samples(spark, d), ["event_type"], "idx", F.col("value") > 50, "idx", BLOCK)


def i18_dilate(spark, d):
    s = _samples(spark, d).select("event_type", "idx", (F.col("value") > 90).alias("flag"))
    return I.dilate(s, ["event_type"], "idx", "flag", 3, BLOCK)


def i19_points_mask(spark, d):
    ev = events(spark, d).select("event_id", "event_type", "t")
    inside = I.points_in(ev, _parity_days(spark, d), ["event_type"], "t", DAY, how="left_semi").select("event_id", F.lit(True).alias("inside"))
    return ev.join(inside, "event_id", "left").select("event_id", F.coalesce("inside", F.lit(False)).alias("inside"))


def i20_labels(spark, d):
    return I.interval_labels(_samples(spark, d).select("event_type", "idx", "value"), ["event_type"], "idx", F.col("value") <= 30, BLOCK).select("event_type", "idx", "label")


def i21_concatenate(spark, d):
    met = I.label_by_interval(events(spark, d).select("event_id", "event_type", "t"), _parity_days(spark, d), ["event_type"], "t")
    return met.select("event_id", "event_type", "label")


def i22_hull(spark, d):
    return I.hull(order_intervals(spark, d), K)


def i23_intersect_all(spark, d):
    return I.intersect_all([order_intervals(spark, d, 90), order_intervals(spark, d, 90, 20), order_intervals(spark, d, 90, 40)], K)


def i24_containing_match(spark, d):
    return I.containing_match(I.consolidate(order_intervals(spark, d), K), order_intervals(spark, d, 10), K, DAY)


def i25_overlap_share(spark, d):
    return I.overlap_share(events(spark, d), _parity_days(spark, d), ["event_type"], "t", 0.4)


def i26_epoch_name(spark, d):
    li = read(spark, d, "lineitem")
    names = li.select("l_orderkey", F.col("l_linenumber").alias("epoch"), F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0").alias("name"))
    return I.epoch_name(names, ["l_orderkey"], "epoch", "name")


def i28_on_off(spark, d):
    ev = events(spark, d)
    return I.on_off_pairs(ev.select("user_id", "t", "event_id", "value"), ["user_id"], "t", F.col("value") > 50, F.col("value") <= 50)


def i29_slice(spark, d):
    return I.slice_series(events(spark, d).select("event_id", "event_type", "t"), _parity_days(spark, d), ["event_type"], "t").select("event_id", "event_type", "start")


def i30_orphans(spark, d):
    lists = read(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    return I.orphan_lists(lists, ["k"], order_intervals(spark, d))


QUERIES = {f.__name__: f for f in (i1_normalise, i2_from_indices, i3_by_length, i4_contains, i5_excludes, i6_consolidate, i7_union, i8_intersect, i9_subtract, i10_censor, i11_adjacent, i12_removal_window, i13_to_indices, i14_to_seconds, i15_sample_ranges, i16_merge_closed, i17_mask_runs, i18_dilate, i19_points_mask, i20_labels, i21_concatenate, i22_hull, i23_intersect_all, i24_containing_match, i25_overlap_share, i26_epoch_name, i28_on_off, i29_slice, i30_orphans)}

_CON = _islands("oi", ">=", "c")
_SHIFT = "ob AS (SELECT k, start + {s} * %d AS start, start + ({s} + {n}) * %d AS stop FROM oi)" % (DAY, DAY)
_RUNS = "r AS (SELECT event_type, idx - row_number() OVER (PARTITION BY event_type ORDER BY idx) AS g, idx FROM sm WHERE {w}), x AS (SELECT event_type, min(idx) AS a, max(idx) AS b FROM r GROUP BY event_type, g)"
_PIECES = "SELECT c.k, greatest(c.start, e.start) AS start, least(c.stop, e.stop) AS stop FROM c JOIN e ON c.k = e.k AND c.start < e.stop AND e.start < c.stop"

ORACLES = {
    "i1_normalise": sql("x AS (SELECT DISTINCT k, start, stop FROM oi WHERE start <= stop) SELECT * FROM x"),
    "i2_from_indices": sql("p AS (SELECT DISTINCT l_suppkey, l_partkey AS i FROM lineitem), r AS (SELECT *, i - row_number() OVER (PARTITION BY l_suppkey ORDER BY i) AS g FROM p) SELECT l_suppkey, min(i) AS start, max(i) AS stop FROM r GROUP BY l_suppkey, g"),
    "i3_by_length": sql(f"{_CON} SELECT * FROM c WHERE stop - start > {60 * DAY} AND stop - start < {200 * DAY}"),
    "i4_contains": sql(f"{_DAYS} SELECT e.event_id, e.event_type, e.t, p.start, p.stop FROM ev e JOIN pd p ON e.event_type = p.event_type AND e.t BETWEEN p.start AND p.stop"),
    "i5_excludes": sql(f"{_DAYS} SELECT DISTINCT event_type, t FROM ev e WHERE NOT EXISTS (SELECT 1 FROM pd p WHERE p.event_type = e.event_type AND e.t BETWEEN p.start AND p.stop)"),
    "i6_consolidate": sql(f"{_CON} SELECT * FROM c"),
    "i7_union": sql(f"{_SHIFT.format(s=60, n=60)}, u AS (SELECT * FROM oi UNION ALL SELECT * FROM ob), {_islands('u', '>', 'c')} SELECT * FROM c WHERE stop - start < 10000000000000000"),
    "i8_intersect": sql(f"{_SHIFT.format(s=45, n=60)}, {_CON}, {_islands('ob', '>=', 'e')}, x AS ({_PIECES}) SELECT * FROM x WHERE stop - start > {DAY}"),
    "i9_subtract": sql(f"""{_SHIFT.format(s=45, n=30)}, {_CON}, {_islands('ob', '>', 'h')},
z AS (SELECT k, lag(stop) OVER w AS a, start AS b FROM h WINDOW w AS (PARTITION BY k ORDER BY start) UNION ALL SELECT k, max(stop), NULL FROM h GROUP BY k UNION ALL SELECT DISTINCT k, NULL, NULL FROM c WHERE k NOT IN (SELECT k FROM h)),
e AS (SELECT k, coalesce(a, -4000000000000000000) AS start, coalesce(b, 4000000000000000000) AS stop FROM z), x AS ({_PIECES}) SELECT * FROM x WHERE stop > start"""),
    "i10_censor": sql("p AS (SELECT k, min(start) AS lo, max(start) AS hi FROM oi GROUP BY k HAVING count(*) > 3), x AS (SELECT k, greatest(start, lo) AS start, least(stop, hi) AS stop FROM oi JOIN p USING (k)) SELECT * FROM x WHERE stop > start"),
    "i11_adjacent": sql("""l AS (SELECT DISTINCT l_orderkey AS k, (l_linenumber * 2)::BIGINT AS start, (l_linenumber * 2 + l_quantity::INT % 2)::BIGINT AS stop FROM lineitem),
m AS (SELECT *, lag(stop) OVER (PARTITION BY k ORDER BY start, stop) AS p FROM l), g AS (SELECT *, sum(CASE WHEN p IS NULL OR start <> p + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS g FROM m)
SELECT k, min(start) AS start, max(stop) AS stop FROM g GROUP BY k, g"""),
    "i12_removal_window": sql(f"""{_SAMPLES}, {_RUNS.format(w='value > 80')}, y AS (SELECT x.event_type AS k, s.t - {HOUR // 2} AS start, least(e.t + {HOUR // 2}, (SELECT max(t) FROM sm m WHERE m.event_type = x.event_type)) AS stop
FROM x JOIN sm s ON s.event_type = x.event_type AND s.idx = x.a JOIN sm e ON e.event_type = x.event_type AND e.idx = x.b), {_islands('y', '>=', 'c')} SELECT k AS event_type, start, stop FROM c"""),
    "i13_to_indices": sql(f"{_DAYS}, b AS (SELECT event_type, start AS x FROM pd UNION SELECT event_type, stop FROM pd) SELECT event_type, x, (SELECT count(*) FROM ev e WHERE e.event_type = b.event_type AND e.t < b.x) AS position FROM b"),
    "i14_to_seconds": sql(f"{_SAMPLES}, {_RUNS.format(w='value > 50')} SELECT x.event_type, s.t AS start, e.t AS stop FROM x JOIN sm s ON s.event_type = x.event_type AND s.idx = x.a JOIN sm e ON e.event_type = x.event_type AND e.idx = x.b"),
    "i15_sample_ranges": sql(f"""{_DAYS}, q AS (SELECT event_type AS k, (SELECT count(*) FROM ev e WHERE e.event_type = b.event_type AND e.t < b.start) AS start, (SELECT count(*) FROM ev e WHERE e.event_type = b.event_type AND e.t <= b.stop) - 1 AS stop FROM pd b),
{_islands('q', '> 1 +', 'c')} SELECT k AS event_type, start, stop FROM c"""),
    "i16_merge_closed": sql(f"{_islands('oi', '>', 'c')} SELECT * FROM c", 30),
    "i17_mask_runs": sql(f"{_SAMPLES}, {_RUNS.format(w='value > 50')} SELECT event_type, a AS start, b AS stop FROM x"),
    "i18_dilate": sql(f"{_SAMPLES} SELECT event_type, idx, max((value > 90)::INT) OVER (PARTITION BY event_type ORDER BY idx ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) = 1 AS flag FROM sm"),
    "i19_points_mask": sql(f"{_DAYS} SELECT event_id, EXISTS (SELECT 1 FROM pd p WHERE p.event_type = e.event_type AND e.t BETWEEN p.start AND p.stop) AS inside FROM ev e"),
    "i20_labels": sql(f"{_SAMPLES}, a AS (SELECT *, value > 30 AND NOT coalesce(lag(value > 30) OVER w, false) AS b FROM sm WINDOW w AS (PARTITION BY event_type ORDER BY idx)), n AS (SELECT *, sum(b::INT) OVER (PARTITION BY event_type ORDER BY idx ROWS UNBOUNDED PRECEDING) AS n FROM a) SELECT event_type, idx, CASE WHEN value > 30 THEN n - 1 ELSE -1 END AS label FROM n"),
    "i21_concatenate": sql(f"{_DAYS} SELECT e.event_id, e.event_type, dense_rank() OVER (PARTITION BY e.event_type ORDER BY p.start, p.stop) - 1 AS label FROM ev e JOIN pd p ON e.event_type = p.event_type AND e.t BETWEEN p.start AND p.stop"),
    "i22_hull": sql("x AS (SELECT k, min(start) AS start, max(stop) AS stop FROM oi GROUP BY k) SELECT * FROM x"),
    "i23_intersect_all": sql(f"""{_islands('oi', '>=', 'c0')}, o2 AS (SELECT k, start + 20 * {DAY} AS start, stop + 20 * {DAY} AS stop FROM oi), o3 AS (SELECT k, start + 40 * {DAY} AS start, stop + 40 * {DAY} AS stop FROM oi), {_islands('o2', '>=', 'c2')}, {_islands('o3', '>=', 'e')},
x0 AS (SELECT c0.k, greatest(c0.start, c2.start) AS start, least(c0.stop, c2.stop) AS stop FROM c0 JOIN c2 ON c0.k = c2.k AND c0.start < c2.stop AND c2.start < c0.stop), {_islands('x0', '>=', 'c')} {_PIECES}""", 90),
    "i24_containing_match": sql(f"""{_CON}, n AS (SELECT DISTINCT k, start, start + 10 * {DAY} AS stop FROM oi), m AS (SELECT c.k, c.start AS outer_start, c.stop AS outer_stop, count(n.start) AS matches, min(n.start) AS s, min(n.stop) AS e FROM c LEFT JOIN n ON n.k = c.k AND n.start >= c.start - {DAY} AND n.stop <= c.stop + {DAY} GROUP BY ALL)
SELECT k, outer_start, outer_stop, matches, CASE WHEN matches = 1 THEN s END AS start, CASE WHEN matches = 1 THEN e END AS stop FROM m"""),
    "i25_overlap_share": sql(f"{_DAYS}, x AS (SELECT event_type, EXISTS (SELECT 1 FROM pd p WHERE p.event_type = e.event_type AND e.t BETWEEN p.start AND p.stop) AS i FROM ev e) SELECT event_type, count(*) AS n, count(*) FILTER (i) AS inside, count(*) FILTER (i) / count(*) >= 0.4 AS accepted FROM x GROUP BY event_type"),
    "i26_epoch_name": "WITH n AS (SELECT l_orderkey, l_linenumber AS epoch, lpad(l_quantity::INT::VARCHAR, 2, '0') AS name FROM lineitem) SELECT l_orderkey, epoch, min(name) AS interval_name FROM n WHERE name IN (epoch::VARCHAR, lpad(epoch::VARCHAR, 2, '0'), lpad(epoch::VARCHAR, 3, '0')) GROUP BY ALL HAVING count(DISTINCT name) = 1",
    "i28_on_off": sql("s AS (SELECT user_id, t, value > 50 AS s, lead(value > 50) OVER w AS ns, lead(t) OVER w AS nt, max(t) OVER (PARTITION BY user_id) AS z FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY t)) SELECT user_id, t AS start, CASE WHEN ns = false THEN nt ELSE z END AS stop FROM s WHERE s AND (ns IS NULL OR NOT ns)"),
    "i29_slice": sql(f"{_DAYS} SELECT e.event_id, e.event_type, p.start FROM ev e JOIN pd p ON e.event_type = p.event_type AND e.t >= p.start AND e.t < p.stop"),
    "i30_orphans": "SELECT c_custkey AS k, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
}

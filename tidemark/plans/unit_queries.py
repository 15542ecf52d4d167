"""Registered queries of spike trains, waveforms, decoding, ingestion and data quality."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import spikes as K
from .tables import DAY, HOUR, events, read, sql

RULES = [("s_acctbal", ">", 8000.0, ["rich", "accept"]), ("s_acctbal", "<", 0.0, ["reject"]), ("s_nationkey", "<=", 4.0, ["near", "accept"])]


def k2_indicator(s, d):
    ev = events(s, d)
    a, bins = _grid(ev, DAY)
    return K.indicator(ev, "event_type", "t", a, DAY, bins)


def _grid(ev, step):
    """The first time, and the number of grid times from there until one lies after the last event."""
    a, b = ev.agg(F.min("t"), F.max("t")).first()
    return (0, 1) if a is None else (a, (b - a) // step + 2)


def k2_indicator_whole(s, d):
    ev = events(s, d)
    a, bins = _grid(ev, HOUR)
    return K.indicator(ev, "event_type", "t", a, HOUR, bins)


def _units(s, d):
    return read(s, d, "part").select(F.col("p_partkey").alias("unit"), F.col("p_retailprice").alias("snr"), "p_size", F.split("p_type", " ").alias("labels"), "p_brand")


def k4_filter_by_label(s, d):
    return K.filter_by_label(_units(s, d), "labels", ["STEEL", "BRASS"], ["SMALL"]).select("unit")


def k5_filter_by_criteria(s, d):
    units = _units(s, d).withColumn("snr", F.when(F.col("unit") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("snr")))
    return K.filter_by_criteria(units, {"snr": [(">", 950.0), ("!=", 1000.0)], "p_size": [("between", (5, 40)), ("notin", [7, 8])]}).select("unit")


def k6_group_spikes(s, d):
    ev = events(s, d)
    units = ev.where("user_id is not null").select("event_type", "user_id").distinct().withColumn("labels", F.array().cast("array<string>"))
    return K.group_spikes(ev, units, "event_type", "user_id", "t", "labels", [], [], {})


def k6_group_spikes_whole(s, d):
    ev = events(s, d)
    a, b = ev.agg(F.min("t"), F.max("t")).first()
    units = ev.groupBy("event_type", "user_id").agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
    units = units.withColumn("labels", F.array_compact(F.array(F.when(F.col("most") > 90, "high"), F.when(F.col("n") >= 20, "active"), F.when(F.col("least") < 0.1, "low"))))
    return K.group_spikes(ev, units, "event_type", "user_id", "t", "labels", ["high", "active"], ["low"], {"n": [(">", 1)], "most": [("between", (50, 99.99))]}, None if a is None else (a + DAY, b - DAY))


def k12_labels(s, d):
    return K.labels_from_metrics(read(s, d, "supplier"), "s_suppkey", RULES)


def k14_num_spikes(s, d):
    return K.counts(events(s, d), "user_id")


def k15_isi(s, d):
    return K.isi_violations(events(s, d), "user_id", "t", 2 * HOUR).select("user_id", "n", "violations", F.round("fraction", 9).alias("fraction"))


def k17_peak(s, d):
    waves = read(s, d, "embeddings").select("label", F.transform("embedding", lambda x: F.round(x * 1000).cast("long")).alias("w"))
    return K.peak_place(K.mean_template(waves, "label", "w"), "label", 4)


def k20_sort_groups(s, d):
    return K.sort_groups(read(s, d, "supplier"), "s_nationkey", "s_nationkey", "s_suppkey").select("s_nationkey", "n", "first_electrode", "sort_group")


def _pairs(s, d):
    u = events(s, d).select("event_type").distinct()
    return u.select(F.col("event_type").alias("a")).crossJoin(u.select(F.col("event_type").alias("b"))).where("a < b")  # five event types


def k22_pooled_isi(s, d):
    return K.pooled_isi(events(s, d), "event_type", "t", _pairs(s, d), HOUR // 12).select("a", "b", "n", "close", F.round("fraction", 9).alias("fraction"))


def k23_correlogram(s, d):
    return K.correlogram(events(s, d), "event_type", "t", HOUR, HOUR // 10)


def k24_asymmetry(s, d):
    return K.asymmetry(K.correlogram(events(s, d), "event_type", "t", HOUR, HOUR // 10)).select("a", "b", F.round("asymmetry", 9).alias("asymmetry"))


def k23_correlogram_by_session(s, d):
    return K.correlogram(events(s, d).withColumn("session", F.col("event_id") % 4), "event_type", "t", HOUR, HOUR // 10, ("session",))


def w7_mark_threshold(s, d):
    return K.mark_threshold(read(s, d, "embeddings"), "embedding", 0.3, "both").select("vec_id")


def w8_marks_per_bin(s, d):
    ev = events(s, d)
    a, bins = _grid(ev, DAY)
    return K.marks_per_bin(ev, "event_type", "t", "value", a, DAY, bins).select("event_type", "bin", F.round("mean", 6).alias("mean"))


def _decode(s, d):
    ev = events(s, d).select("event_type", F.floor(F.col("t") / HOUR).alias("hour"), F.least(F.lit(9), F.floor(F.col("value") / 10)).alias("bin"))
    return ev, K.place_fields(ev, ev, "event_type", "bin")


def b2_place_fields(s, d):
    return _decode(s, d)[1].select("event_type", "bin", F.round("rate", 6).alias("rate"))


def b3_posterior(s, d):
    ev, fields = _decode(s, d)
    counts = ev.groupBy("hour", "event_type").agg(F.count("*").alias("n"))
    return K.poisson_posterior(counts, fields, "hour", "event_type", "bin").select("hour", "bin", F.round("p", 6).alias("p"))


def b3_posterior_by_session(s, d):
    ev = events(s, d).select((F.col("event_id") % 4).alias("session"), "event_type", F.floor(F.col("t") / HOUR).alias("hour"), F.least(F.lit(9), F.floor(F.col("value") / 10)).alias("bin"))
    counts, key = ev.groupBy("session", "hour", "event_type").agg(F.count("*").alias("n")), ("session",)
    post = K.poisson_posterior(counts, K.place_fields(ev, ev, "event_type", "bin", key), "hour", "event_type", "bin", key)
    return post.select("session", "hour", "bin", F.round("p", 6).alias("p"))


def b4_map(s, d):
    ev, fields = _decode(s, d)
    counts = ev.groupBy("hour", "event_type").agg(F.count("*").alias("n"))
    p = K.poisson_posterior(counts, fields, "hour", "event_type", "bin").withColumn("p", F.round("p", 9))
    return K.map_bin(p, "hour", "bin")


def b11_quantise(s, d):
    return K.quantised(events(s, d), F.col("value") / 100).select("event_id", "q")


def a1_ingest(s, d):
    props = F.from_json("props", "k long")
    return Q.ingest(events(s, d).withColumn("p", props), {"id": "event_id", "kind": ("event_type", "none"), "k": F.col("p.k"), "high": F.col("value") > 50})


def a2_select_objects(s, d):
    return Q.select_objects(events(s, d), "event_type", ["Click", "PURCH ase"]).select("event_id", "event_type")


def a3_overlay(s, d):
    c = read(s, d, "supplier").where("s_nationkey < 5").select("s_suppkey", F.lit(1.5).alias("s_acctbal"))
    return Q.overlay(read(s, d, "supplier").select("s_suppkey", "s_name", "s_acctbal"), c, ["s_suppkey"])


def a4_require(s, d):
    rows = events(s, d).select("event_id", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"))
    return Q.require(rows, ["value"]).select("event_id")


def _changed(s, d):
    o = read(s, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    new = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 10 == 0, F.lower("o_orderstatus")).when(F.col("o_orderkey") % 10 == 1, F.lit("X")).otherwise(F.col("o_orderstatus")))
    return o, new.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 10 == 2, -F.col("o_orderkey")).otherwise(F.col("o_orderkey")))


def a5_validate(s, d):
    old, new = _changed(s, d)
    return Q.validate_upsert(new, old, ["o_orderkey"]).select("o_orderkey", "status")


def a6_upsert(s, d):
    old, new = _changed(s, d)
    return Q.upsert(new, old, ["o_orderkey"])


def a10_epochs(s, d):
    return Q.epoch_groups(events(s, d), "user_id", "t", HOUR)


def v7_storage(s, d):
    return Q.storage(read(s, d, "documents"), ["source"], "n_chars")


def v9_content(s, d):
    o = read(s, d, "orders").select("o_orderkey", "o_totalprice")
    new = o.withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderkey") % 7 == 0, 1.0).otherwise(0.0)).where("o_orderkey % 5 <> 0")
    return Q.content_matches(o, new, ["o_orderkey"], ["o_totalprice"], 2)


def v10_diff(s, d):
    return Q.frame_diff(*_changed(s, d), ["o_orderkey"])


def v11_tag(s, d):
    docs = read(s, d, "documents")
    return docs.select("doc_id", Q.tag_by_pattern(docs, "text", [("%icens%", "licence"), ("%@%", "address"), ("%|%", "table")]).alias("reason"))


def v12_eligible(s, d):
    return Q.delete_eligible(read(s, d, "orders"), F.col("o_orderstatus") == "F", "o_orderdate", F.lit("1998-01-01").cast("timestamp"), "o_totalprice")


def v19_sanitise(s, d):
    return read(s, d, "part").select("p_partkey", Q.sanitise(F.col("p_name")).alias("name"))


def v20_unique(s, d):
    return Q.unique_ids(read(s, d, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey"), "id", "o_orderkey")


QUERIES = {f.__name__: f for f in (k23_correlogram_by_session, b3_posterior_by_session, k2_indicator, k2_indicator_whole, k4_filter_by_label, k5_filter_by_criteria, k6_group_spikes, k6_group_spikes_whole, k12_labels, k14_num_spikes, k15_isi, k17_peak, k20_sort_groups, k22_pooled_isi, k23_correlogram, k24_asymmetry, w7_mark_threshold, w8_marks_per_bin, b2_place_fields, b3_posterior, b4_map, b11_quantise, a1_ingest, a2_select_objects, a3_overlay, a4_require, a5_validate, a6_upsert, a10_epochs, v7_storage, v9_content, v10_diff, v11_tag, v12_eligible, v19_sanitise, v20_unique)}

_COR = f"co AS (SELECT a.event_type AS a, b.event_type AS b, floor((b.t - a.t) / {HOUR // 10})::BIGINT AS bin, count(*) AS n FROM ev a JOIN ev b ON a.event_type <> b.event_type AND b.t - a.t >= {-HOUR // 2} AND b.t - a.t < {HOUR // 2} GROUP BY ALL)"
_DEC = f"""de AS (SELECT event_type, t // {HOUR} AS hour, least(9, floor(value / 10))::BIGINT AS bin FROM ev), oc AS (SELECT bin, count(*) AS o FROM de GROUP BY bin), ct AS (SELECT event_type, bin, count(*) AS n FROM de GROUP BY ALL),
fd AS (SELECT u.event_type, oc.bin, (coalesce(n, 0) + 1e-3) / o AS rate FROM (SELECT DISTINCT event_type FROM de) u CROSS JOIN oc LEFT JOIN ct ON ct.event_type = u.event_type AND ct.bin = oc.bin)"""
_POST = f"""{_DEC}, cn AS (SELECT hour, event_type, count(*) AS n FROM de GROUP BY ALL), li AS (SELECT hour, bin, sum(n * ln(rate)) AS l FROM cn JOIN fd USING (event_type) GROUP BY ALL), si AS (SELECT bin, sum(rate) AS r FROM fd GROUP BY bin),
ll AS (SELECT hour, bin, l - r AS x FROM li JOIN si USING (bin)), ex AS (SELECT hour, bin, exp(x - max(x) OVER (PARTITION BY hour)) AS e FROM ll), po AS (SELECT hour, bin, e / sum(e) OVER (PARTITION BY hour) AS p FROM ex)"""
_CH = """o AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders), nw AS (SELECT CASE WHEN o_orderkey % 10 = 2 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN lower(o_orderstatus) WHEN o_orderkey % 10 = 1 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders)"""

ORACLES = {
    "k2_indicator": sql(f"""a AS (SELECT min(t) AS a, max(t) AS b FROM ev), c AS (SELECT event_type, (t - a) // {DAY} AS bin, count(*) AS n FROM ev, a GROUP BY ALL),
g AS (SELECT event_type, unnest(range(0, (b - a) // {DAY} + 2)) AS bin FROM (SELECT DISTINCT event_type FROM ev), a) SELECT g.event_type, g.bin, coalesce(n, 0) AS n FROM g LEFT JOIN c ON c.event_type = g.event_type AND c.bin = g.bin"""),
    "k2_indicator_whole": sql(f"""a AS (SELECT min(t) AS a, max(t) AS b FROM ev), c AS (SELECT event_type, (t - a) // {HOUR} AS bin, count(*) AS n FROM ev, a GROUP BY ALL),
g AS (SELECT event_type, unnest(range(0, (b - a) // {HOUR} + 2)) AS bin FROM (SELECT DISTINCT event_type FROM ev), a) SELECT g.event_type, g.bin, coalesce(n, 0) AS n FROM g LEFT JOIN c ON c.event_type = g.event_type AND c.bin = g.bin"""),
    "k4_filter_by_label": "WITH u AS (SELECT p_partkey AS unit, string_split(p_type, ' ') AS l FROM part) SELECT unit FROM u WHERE list_has_any(l, ['STEEL', 'BRASS']) AND NOT list_has_any(l, ['SMALL'])",
    "k5_filter_by_criteria": "SELECT p_partkey AS unit FROM part WHERE p_partkey % 11 <> 0 AND p_retailprice > 950 AND p_retailprice <> 1000 AND p_size BETWEEN 5 AND 40 AND p_size NOT IN (7, 8)",
    "k6_group_spikes": sql("x AS (SELECT event_type, dense_rank() OVER (PARTITION BY event_type ORDER BY user_id) - 1 AS unit, t FROM ev WHERE user_id IS NOT NULL) SELECT * FROM x"),
    "k6_group_spikes_whole": sql(f"""a AS (SELECT min(t) + {DAY} AS a, max(t) - {DAY} AS b FROM ev), u AS (SELECT event_type, user_id FROM ev GROUP BY ALL HAVING (max(value) > 90 OR count(*) >= 20) AND NOT min(value) < 0.1 AND count(*) > 1 AND max(value) BETWEEN 50 AND 99.99),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY user_id) - 1 AS unit FROM u) SELECT r.event_type, r.unit, ev.t FROM r JOIN ev USING (event_type, user_id), a WHERE ev.t BETWEEN a AND b"""),
    "k12_labels": """WITH l AS (SELECT s_suppkey, list_concat(CASE WHEN s_acctbal > 8000 THEN ['rich', 'accept'] ELSE [] END, CASE WHEN s_acctbal < 0 THEN ['reject'] ELSE [] END, CASE WHEN s_nationkey <= 4 THEN ['near', 'accept'] ELSE [] END) AS l FROM supplier)
SELECT s_suppkey, coalesce(array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ','), '') AS labels FROM l""",
    "k14_num_spikes": "SELECT user_id, count(*) AS n FROM events GROUP BY user_id",
    "k15_isi": sql(f"d AS (SELECT user_id, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) AS d FROM ev) SELECT user_id, count(*) AS n, count(*) FILTER (d < {2 * HOUR}) AS violations, round(count(*) FILTER (d < {2 * HOUR}) / (count(*) - 1), 9) AS fraction FROM d GROUP BY user_id HAVING count(*) > 1"),
    "k17_peak": "WITH w AS (SELECT label, unnest(range(0, len(embedding))) AS place, unnest(list_transform(embedding, lambda x: round(x::DOUBLE * 1000)::BIGINT)) AS x FROM embeddings), m AS (SELECT label, place, avg(x) AS mean FROM w GROUP BY ALL), p AS (SELECT label, arg_min(place, (mean, place)) AS place FROM m GROUP BY label) SELECT label, place // 4 AS sample, place % 4 AS channel FROM p",
    "k20_sort_groups": "SELECT s_nationkey, count(*) AS n, min(s_suppkey) AS first_electrode, row_number() OVER (ORDER BY s_nationkey) - 1 AS sort_group FROM supplier GROUP BY s_nationkey HAVING count(*) > 1",
    "k22_pooled_isi": sql(f"u AS (SELECT DISTINCT event_type FROM ev), p AS (SELECT a.event_type AS a, b.event_type AS b FROM u a, u b WHERE a.event_type < b.event_type), x AS (SELECT a, b, t - lag(t) OVER (PARTITION BY a, b ORDER BY t) AS d FROM p JOIN ev ON event_type IN (a, b)) SELECT a, b, count(*) AS n, count(*) FILTER (d < {HOUR // 12}) AS close, round(count(*) FILTER (d < {HOUR // 12}) / count(*), 9) AS fraction FROM x GROUP BY a, b"),
    "k23_correlogram": sql(f"{_COR} SELECT * FROM co"),
    "k23_correlogram_by_session": sql(f"co AS (SELECT a.event_id % 4 AS session, a.event_type AS a, b.event_type AS b, floor((b.t - a.t) / {HOUR // 10})::BIGINT AS bin, count(*) AS n FROM ev a JOIN ev b ON a.event_id % 4 = b.event_id % 4 AND a.event_type <> b.event_type AND b.t - a.t >= {-HOUR // 2} AND b.t - a.t < {HOUR // 2} GROUP BY ALL) SELECT * FROM co"),
    "b3_posterior_by_session": sql(f"""de AS (SELECT event_id % 4 AS session, event_type, t // {HOUR} AS hour, least(9, floor(value / 10))::BIGINT AS bin FROM ev), oc AS (SELECT session, bin, count(*) AS o FROM de GROUP BY ALL), ct AS (SELECT session, event_type, bin, count(*) AS n FROM de GROUP BY ALL),
fd AS (SELECT u.session, u.event_type, oc.bin, (coalesce(n, 0) + 1e-3) / o AS rate FROM (SELECT DISTINCT session, event_type FROM de) u JOIN oc USING (session) LEFT JOIN ct ON ct.session = u.session AND ct.event_type = u.event_type AND ct.bin = oc.bin),
cn AS (SELECT session, hour, event_type, count(*) AS n FROM de GROUP BY ALL), li AS (SELECT session, hour, bin, sum(n * ln(rate)) AS l FROM cn JOIN fd USING (session, event_type) GROUP BY ALL), si AS (SELECT session, bin, sum(rate) AS r FROM fd GROUP BY ALL),
ll AS (SELECT session, hour, bin, l - r AS x FROM li JOIN si USING (session, bin)), ex AS (SELECT session, hour, bin, exp(x - max(x) OVER (PARTITION BY session, hour)) AS e FROM ll) SELECT session, hour, bin, round(e / sum(e) OVER (PARTITION BY session, hour), 6) AS p FROM ex"""),
    "k24_asymmetry": sql(f"{_COR} SELECT a, b, round((sum(n) FILTER (bin >= 0) - sum(n) FILTER (bin < 0)) / sum(n), 9) AS asymmetry FROM co GROUP BY a, b"),
    "w7_mark_threshold": "SELECT vec_id FROM embeddings WHERE list_max(list_transform(embedding, lambda x: abs(x)))::DOUBLE >= 0.3",
    "w8_marks_per_bin": sql(f"a AS (SELECT min(t) AS a FROM ev), m AS (SELECT event_type, (t - a) // {DAY} AS bin, avg(value) AS mean FROM ev, a GROUP BY ALL), g AS (SELECT event_type, unnest(range(0, (SELECT (max(t) - min(t)) // {DAY} + 2 FROM ev))) AS bin FROM (SELECT DISTINCT event_type FROM ev)) SELECT g.event_type, g.bin, round(mean, 6) AS mean FROM g LEFT JOIN m ON m.event_type = g.event_type AND m.bin = g.bin"),
    "b2_place_fields": sql(f"{_DEC} SELECT event_type, bin, round(rate, 6) AS rate FROM fd"),
    "b3_posterior": sql(f"{_POST} SELECT hour, bin, round(p, 6) AS p FROM po"),
    "b4_map": sql(f"{_POST} SELECT hour, arg_max(bin, (round(p, 9), -bin)) AS map_bin FROM po GROUP BY hour"),
    "b11_quantise": "SELECT event_id, floor(value / 100 * 255)::INT AS q FROM events WHERE floor(value / 100 * 255) > 0",
    "a1_ingest": "SELECT event_id AS id, coalesce(event_type, 'none') AS kind, (props::JSON ->> 'k')::BIGINT AS k, value > 50 AS high FROM events",
    "a2_select_objects": "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')",
    "a3_overlay": "SELECT s_suppkey, s_name, CASE WHEN s_nationkey < 5 THEN 1.5 ELSE s_acctbal END AS s_acctbal FROM supplier",
    "a4_require": "SELECT event_id FROM events WHERE event_id % 3 <> 0 AND value IS NOT NULL",
    "a5_validate": f"WITH {_CH} SELECT nw.o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'insert' WHEN lower(o.o_orderstatus) = lower(nw.o_orderstatus) THEN 'same' ELSE 'conflict' END AS status FROM nw LEFT JOIN o USING (o_orderkey)",
    "a6_upsert": f"WITH {_CH} SELECT * FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM nw) UNION ALL SELECT * FROM nw",
    "a10_epochs": sql(f"s AS (SELECT user_id, min(t) AS start FROM ev GROUP BY user_id) SELECT user_id, start, dense_rank() OVER (ORDER BY start // {HOUR}) - 1 AS epoch FROM s"),
    "v7_storage": "WITH t AS (SELECT source, sum(n_chars)::BIGINT AS bytes FROM documents GROUP BY source), p AS (SELECT *, greatest(0, least(5, floor(log2(greatest(bytes, 1)) / 10)))::INT AS p FROM t) SELECT source, bytes, ['B', 'KiB', 'MiB', 'GiB', 'TiB', 'PiB'][p + 1] AS unit, round(bytes / pow(1024.0, p), 2) AS amount FROM p",
    "v9_content": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'missing in new' WHEN o_orderkey % 7 = 0 THEN 'different' ELSE 'same' END AS status FROM orders",
    "v10_diff": f"WITH {_CH} SELECT o_orderkey, 'only new' AS side, NULL AS \"column\", NULL AS old, NULL AS new FROM nw WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o) UNION ALL SELECT o_orderkey, 'only old', NULL, NULL, NULL FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM nw) UNION ALL SELECT o.o_orderkey, 'both', 'o_orderstatus', o.o_orderstatus, nw.o_orderstatus FROM o JOIN nw USING (o_orderkey) WHERE o.o_orderstatus <> nw.o_orderstatus",
    "v11_tag": "SELECT doc_id, CASE WHEN text LIKE '%icens%' THEN 'licence' WHEN text LIKE '%@%' THEN 'address' WHEN text LIKE '%|%' THEN 'table' END AS reason FROM documents",
    "v12_eligible": "SELECT count(*) AS files, coalesce(round(sum(o_totalprice), 2), 0.0) AS total FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1998-01-01'",
    "v19_sanitise": "SELECT p_partkey, regexp_replace(p_name, '[^A-Za-z0-9.-]+', '_', 'g') AS name FROM part",
    "v20_unique": "WITH n AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) SELECT CASE WHEN n > 1 THEN md5(concat_ws('|', o_custkey::VARCHAR, n::VARCHAR)) ELSE o_custkey::VARCHAR END AS id, o_orderkey FROM n",
}

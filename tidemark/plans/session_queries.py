"""Registered queries of sessions, provenance and metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.store import own_folder
from ..operators import intervals as I
from ..operators import lineage as L
from ..operators import provenance as V
from ..operators import quality as Q
from ..operators import session as A
from ..operators import signal as S
from ..sources import manifest as M
from .interval_queries import _SAMPLES, _samples
from .tables import DAY, HOUR, events, order_intervals, read, sql

C = ["event_type"]


def _loaded(s, d):
    """Nations of three regions, and all customers and orders: some have no parent."""
    frames = {"nation": read(s, d, "nation").where("n_regionkey < 3"), "customer": read(s, d, "customer").where("c_acctbal > -500"), "orders": read(s, d, "orders")}
    return L.Catalogue([L.TableSpec("nation", ["n_nationkey"]), L.TableSpec("customer", ["c_custkey"], {"nation": {"c_nationkey": "n_nationkey"}}), L.TableSpec("orders", ["o_orderkey"], {"customer": {"o_custkey": "c_custkey"}})], frames.get)


def a7_load_session(s, d):
    loaded, rejects = A.load_in_order(_loaded(s, d))
    return rejects.unionByName(loaded["orders"].select(F.lit("orders").alias("table_name"), F.col("o_orderkey").cast("string").alias("key"), F.lit(None).cast("string").alias("missing")))


def _series(s, d):
    fast = events(s, d).select("event_type", F.floor(F.col("t") / 10000).alias("t"))
    rates = fast.select("event_type").distinct().withColumn("rate", F.when(F.col("event_type") == "click", 50.0))
    return A.import_series(fast, rates, C, "t")


def a8_import_rate(s, d):
    return _series(s, d)[0]


def a8_import_times(s, d):
    return _series(s, d)[1].select("event_type", F.round("start", 3).alias("start"), F.round("stop", 3).alias("stop"))


def a11_position_sources(s, d):
    ev = events(s, d)
    return A.position_sources(ev, Q.epoch_groups(ev.where("user_id is not null"), "user_id", "t", DAY), "user_id", "t", 3 * DAY)


def a14_fetch(s, d):
    manifest = s.createDataFrame([(n, f"{d}/{n}.parquet") for n in ("nation", "region")], "name string, path string")
    return M.fetch(s, manifest, {"name": "nation"})


def a15_register(s, d):
    made = M.write_result(read(s, d, "orders"), own_folder(s, "result"), "all_orders")
    return made.select("table_name", "rows")


def _graph(s, d):
    frames = {"nation": read(s, d, "nation"), "customer": read(s, d, "customer"), "orders": read(s, d, "orders"), "supplier": read(s, d, "supplier")}
    cat = L.Catalogue([L.TableSpec("nation", ["n_nationkey"]), L.TableSpec("supplier", ["s_suppkey"], {"nation": {"s_nationkey": "n_nationkey"}}), L.TableSpec("customer", ["c_custkey"], {"nation": {"c_nationkey": "n_nationkey"}}), L.TableSpec("orders", ["o_orderkey"], {"customer": {"o_custkey": "c_custkey"}})], frames.get)
    return cat, L.cascade(cat, {"orders": read(s, d, "orders").where("o_totalprice > 200000")})


def a16_export(s, d):
    cat, graph = _graph(s, d)
    return M.export(A.export_rows(cat, graph), own_folder(s, "export")).select("table_name", "rows")


def a17_split_parts(s, d):
    ev = events(s, d)
    parts = A.split_parts(ev, ["event_id"], ["t"], {"clicks": (F.col("event_type") == "click", ["value"]), "high": (F.col("value") > 90, ["value"])})
    tagged = [df.select(F.lit(n).alias("part"), "event_id", (F.col("value") if n != "master" else F.lit(None).cast("double")).alias("value")) for n, df in parts.items()]
    return tagged[0].union(tagged[1]).union(tagged[2])


def g10_tables_with_rows(s, d):
    return L.counts(_graph(s, d)[1])


def f11_band_pipeline(s, d):
    """References off, then band-passed and every fourth sample kept."""
    hours = events(s, d).groupBy(F.floor(F.col("t") / HOUR).alias("hour"), "event_type").agg(F.round(F.avg("value"), 6).alias("value"))
    refs = hours.select("event_type").distinct().withColumn("reference", F.when(F.col("event_type") != "click", "click"))
    plain = S.re_reference(hours, ["hour"], "event_type", "value", refs)
    low = S.decimate(S.fir_small(plain, C, "hour", "value", [0.2, 0.6, 0.2]), C, "hour", 4)
    return low.select("event_type", "hour", F.round("filtered", 5).alias("filtered"))


def f13_electrodes(s, d):
    known = read(s, d, "supplier").select(F.col("s_suppkey").alias("electrode"))
    wanted = read(s, d, "supplier").select(F.col("s_suppkey").alias("electrode"), F.when(F.col("s_suppkey") % 3 == 0, F.col("s_suppkey")).alias("reference"))
    return A.select_electrodes(known, wanted.union(wanted), "electrode", "reference")


def f14_electrode_index(s, d):
    region = read(s, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("ids"))
    wanted = read(s, d, "orders").select("o_custkey", (F.col("o_orderkey") + F.when(F.col("o_orderkey") % 5 == 0, 10**9).otherwise(0)).alias("electrode"))
    return A.electrode_index(region, ["o_custkey"], "ids", wanted, "electrode")


def f34_sort_interval(s, d):
    return I.intersect(order_intervals(s, d, 90), order_intervals(s, d, 60, 45), ["k"], 20 * DAY)


def b10_epoch_inputs(s, d):
    ev = events(s, d)
    days = lambda a, b: ev.select("event_type", (F.floor(F.col("t") / DAY) * DAY + a * HOUR).alias("start")).distinct().withColumn("stop", F.col("start") + (b - a) * HOUR)
    return A.epochs_slices([days(0, 16), days(4, 20)], ev.select("event_id", "event_type", "t"), C, "t", DAY).select("event_id", "event_type", "epoch")


def k29_concatenated(s, d):
    x = _samples(s, d)
    days = x.select("event_type", (F.floor(F.col("t") / DAY) * DAY).alias("start")).distinct().withColumn("stop", F.col("start") + DAY // 3)
    from ..operators import spikes as K

    return K.concatenated(x, days, C, "t", DAY).select("event_type", "idx", "place")


def v1_access_log(s, d):
    docs = read(s, d, "documents")
    return V.access_log(docs.union(docs), "source", "lang", "text").select("source", "lang", "piece", F.md5("text").alias("digest"))


def v2_export_set(s, d):
    o = read(s, d, "orders")
    exports = o.select(F.col("o_custkey").alias("paper"), F.col("o_orderkey").alias("export"))
    log = read(s, d, "lineitem").select(F.col("l_orderkey").alias("export"), F.col("l_partkey").alias("file"))
    up = read(s, d, "lineitem").select(F.col("l_partkey").alias("file"), (F.col("l_suppkey") + 10**9).alias("source")).distinct()
    return V.export_set(exports, log, up, "paper", "export", "file")


def v2_export_cascade(s, d):
    """Three steps up: parts come from suppliers, these from nations, these from regions; only what comes from one region is exported."""
    o = read(s, d, "orders")
    exports = o.select(F.col("o_custkey").alias("paper"), F.col("o_orderkey").alias("export"))
    log = read(s, d, "lineitem").select(F.col("l_orderkey").alias("export"), F.col("l_partkey").alias("file"))
    edge = lambda t, a, x, b, y: read(s, d, t).select((F.col(a) + x).alias("file"), (F.col(b) + y).alias("source"))
    up = edge("lineitem", "l_partkey", 0, "l_suppkey", 10**9).union(edge("supplier", "s_suppkey", 10**9, "s_nationkey", 2 * 10**9)).union(edge("nation", "n_nationkey", 2 * 10**9, "n_regionkey", 3 * 10**9))
    return V.export_set(exports, log, up, "paper", "export", "file", s.createDataFrame([(3 * 10**9 + 1,)], "file long"))


def v3_linked_files(s, d):
    files = read(s, d, "part").select(F.col("p_partkey").alias("file"))
    links = read(s, d, "lineitem").where("l_partkey % 7 = 0").select(F.col("l_partkey").alias("file"), (F.col("l_suppkey") + 10**9).alias("target"))
    return V.replace_linked(files, links, "file")


def _files(s, d):
    docs = read(s, d, "documents").select(F.col("doc_id").alias("file"), F.md5("text").alias("checksum"))
    found = docs.where("file % 10 <> 1").select("file", F.when(F.col("file") % 10 == 2, None).when(F.col("file") % 10 == 3, F.lit("x")).otherwise(F.col("checksum")).alias("checksum"))
    return docs, found


def _issues(s, d):
    docs, found = _files(s, d)
    return V.file_issues(docs, found, "file", docs.where("file % 50 = 3"), docs.where("file % 50 = 1"))


def v4_file_issues(s, d):
    return _issues(s, d)


def v5_tables_with_issues(s, d):
    return V.tables_with(_issues(s, d), {"labels": (read(s, d, "labels"), "doc_id"), "orders": (read(s, d, "orders"), "o_custkey")}, "file")


def v6_untracked(s, d):
    disk = read(s, d, "documents").where("doc_id % 4 <> 0").select(F.col("doc_id").alias("file"))
    return V.untracked(disk, [read(s, d, "labels").select(F.col("doc_id").alias("file")), read(s, d, "documents").where("doc_id % 5 = 0").select(F.col("doc_id").alias("file"))], "file")


def v14_environments(s, d):
    part = read(s, d, "part")
    lines = lambda n: part.groupBy(F.col("p_size").alias("env")).agg(F.array_join(F.array_sort(F.collect_list(F.format_string(n, F.col("p_partkey"), F.col("p_partkey") % 7))), "\n").alias("text"))
    new = part.where("p_partkey % 5 <> 0").groupBy(F.col("p_size").alias("env")).agg(F.array_join(F.array_sort(F.collect_list(F.format_string("lib-%d=%d.0", F.col("p_partkey"), F.col("p_partkey") % 7 + F.when(F.col("p_partkey") % 3 == 0, 1).otherwise(0)))), "\nnot a package\n").alias("text"))
    return V.environment_diff(V.dependencies(lines("lib-%d==%d.0"), ["env"], "text"), V.dependencies(new, ["env"], "text"), ["env"])


def v17_subjects(s, d):
    c = read(s, d, "customer").select("c_custkey", F.element_at(F.array(F.lit("Male"), F.lit("f"), F.lit("?")), (F.col("c_custkey") % 3 + 1).cast("int")).alias("sex"), F.when(F.col("c_custkey") % 2 == 0, "Rat").otherwise("Lemur").alias("species"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_custkey").cast("string")).otherwise("10 kg").alias("weight"), F.when(F.col("c_custkey") % 5 == 0, "P1Y").alias("age"))
    return V.standard_subject(c, "sex", "species", "weight", "age")


def v18_names(s, d):
    c = read(s, d, "customer")
    n = F.when(F.col("c_custkey") % 3 == 0, F.concat_ws(", ", "c_mktsegment", F.lit("Ann B"))).when(F.col("c_custkey") % 3 == 1, F.concat_ws(" ", F.lit(" Ann"), "c_mktsegment")).otherwise(F.col("c_name"))
    return c.select("c_custkey", Q.name_parts(n).alias("p")).select("c_custkey", F.col("p.first").alias("first"), F.col("p.last").alias("last"))


def v24_regions(s, d):
    known = read(s, d, "nation").where("n_regionkey < 3").select(F.col("n_name").alias("region_name"), F.when(F.col("n_nationkey") % 2 == 0, F.lit("sub")).alias("subregion_name"), F.col("n_nationkey").cast("long").alias("region_id"))
    new = read(s, d, "nation").select(F.col("n_name").alias("region_name"), F.when(F.col("n_nationkey") % 2 == 0, F.lit("sub")).alias("subregion_name"))
    return V.look_up_or_add(new.union(new), known, ["region_name", "subregion_name"], "region_id")


QUERIES = {f.__name__: f for f in (a7_load_session, a8_import_rate, a8_import_times, a11_position_sources, a14_fetch, a15_register, a16_export, a17_split_parts, g10_tables_with_rows, f11_band_pipeline, f13_electrodes, f14_electrode_index, f34_sort_interval, b10_epoch_inputs, k29_concatenated, v1_access_log, v2_export_set, v2_export_cascade, v3_linked_files, v4_file_issues, v5_tables_with_issues, v6_untracked, v14_environments, v17_subjects, v18_names, v24_regions)}

_RATES = """d0 AS (SELECT event_type, t // 10000 AS t, (t // 10000 - lag(t // 10000) OVER w) / 1e6 AS d, row_number() OVER w AS i FROM ev WHERE event_type <> 'click' WINDOW w AS (PARTITION BY event_type ORDER BY t)),
d1 AS (SELECT event_type, d, i, sum(d) OVER (PARTITION BY event_type ORDER BY i ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING) / 10 AS s FROM d0 WHERE d IS NOT NULL),
e AS (SELECT event_type, log10(3 * avg(s)) AS top FROM d1 GROUP BY event_type HAVING count(*) >= 10),
b AS (SELECT event_type, top, least(99, floor((log10(s) + 5) / ((top + 5) / 100)))::INT AS b, count(*) AS k FROM d1 JOIN e USING (event_type) WHERE s > 0 AND log10(s) >= -5 AND log10(s) <= top GROUP BY ALL),
m AS (SELECT event_type, pow(10.0, -5 + arg_max(b, (k, -b)) * (any_value(top) + 5) / 100) AS usual FROM b GROUP BY event_type),
ra AS (SELECT event_type, round(1 / avg(d)) AS rate FROM d1 JOIN m USING (event_type) WHERE d < 1.5 * usual GROUP BY event_type)"""
_REJECTS = """n AS (SELECT * FROM nation WHERE n_regionkey < 3), c0 AS (SELECT * FROM customer WHERE c_acctbal > -500), c AS (SELECT * FROM c0 WHERE c_nationkey IN (SELECT n_nationkey FROM n))"""
_GRAPH = "o AS (SELECT * FROM orders WHERE o_totalprice > 200000), c AS (SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM o)), n AS (SELECT * FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM c))"
_ISSUES = "f AS (SELECT doc_id AS file, CASE WHEN doc_id % 10 = 1 THEN 'missing' WHEN doc_id % 10 = 2 THEN 'unreadable' WHEN doc_id % 10 = 3 AND text IS NOT NULL THEN 'checksum' END AS issue FROM documents WHERE doc_id % 50 NOT IN (1, 3)), i AS (SELECT * FROM f WHERE issue IS NOT NULL)"

ORACLES = {
    "a7_load_session": f"WITH {_REJECTS} SELECT 'customer' AS table_name, c_custkey::VARCHAR AS key, 'nation' AS missing FROM c0 WHERE c_nationkey NOT IN (SELECT n_nationkey FROM n) UNION ALL SELECT 'orders', o_orderkey::VARCHAR, CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM c) THEN 'customer' END FROM orders",
    "a8_import_rate": sql(f"{_RATES} SELECT event_type, rate, true AS estimated FROM ra UNION ALL SELECT 'click', 50.0, false"),
    "a8_import_times": sql(f"""{_RATES}, g0 AS (SELECT d0.event_type, t, t - lag(t) OVER (PARTITION BY d0.event_type ORDER BY t) > 1.75 * 1e6 / rate AS far FROM d0 JOIN ra ON ra.event_type = d0.event_type), g1 AS (SELECT *, sum(coalesce(far, false)::INT) OVER (PARTITION BY event_type ORDER BY t RANGE UNBOUNDED PRECEDING) AS g FROM g0)
SELECT event_type, min(t)::DOUBLE AS start, max(t)::DOUBLE AS stop FROM g1 GROUP BY event_type, g HAVING max(t) > min(t) UNION ALL SELECT 'click', 0.0, round(count(*) * 1e6 / 50.0, 3) FROM ev WHERE event_type = 'click'"""),
    "a11_position_sources": sql(f"""f AS (SELECT user_id, t, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) > {3 * DAY} AS far FROM ev WHERE user_id IS NOT NULL), g AS (SELECT *, sum(coalesce(far, false)::INT) OVER (PARTITION BY user_id ORDER BY t RANGE UNBOUNDED PRECEDING) AS g FROM f),
s AS (SELECT user_id, min(t) AS start FROM ev WHERE user_id IS NOT NULL GROUP BY 1), e AS (SELECT user_id, dense_rank() OVER (ORDER BY start // {DAY}) - 1 AS epoch FROM s), i AS (SELECT user_id, min(t) AS start, max(t) AS stop FROM g GROUP BY user_id, g HAVING max(t) > min(t))
SELECT i.*, 'pos ' || epoch || ' valid times' AS interval_name FROM i JOIN e USING (user_id)"""),
    "a14_fetch": "SELECT * FROM nation",
    "a15_register": "SELECT 'all_orders' AS table_name, count(*) AS rows FROM orders",
    "a16_export": f"WITH {_GRAPH} SELECT 'orders' AS table_name, count(*) AS rows FROM o UNION ALL SELECT 'customer', count(*) FROM c UNION ALL SELECT 'nation', count(*) FROM n",
    "a17_split_parts": "SELECT 'master' AS part, event_id, NULL::DOUBLE AS value FROM events UNION ALL SELECT 'clicks', event_id, value FROM events WHERE event_type = 'click' UNION ALL SELECT 'high', event_id, value FROM events WHERE value > 90",
    "g10_tables_with_rows": f"WITH {_GRAPH}, t AS (SELECT 'orders' AS table_name, count(*) AS rows FROM o UNION ALL SELECT 'customer', count(*) FROM c UNION ALL SELECT 'nation', count(*) FROM n) SELECT * FROM t WHERE rows > 0",
    "f11_band_pipeline": sql(f"""hm AS (SELECT t // {HOUR} AS hour, event_type, round(avg(value), 6) AS value FROM ev GROUP BY ALL), r AS (SELECT a.hour, a.event_type, a.value - CASE WHEN a.event_type = 'click' THEN 0 ELSE coalesce(b.value, 0) END AS v FROM hm a LEFT JOIN hm b ON a.hour = b.hour AND b.event_type = 'click'),
y AS (SELECT event_type, hour, coalesce(lag(v) OVER w, 0) * 0.2 + v * 0.6 + coalesce(lead(v) OVER w, 0) * 0.2 AS y, row_number() OVER w - 1 AS n FROM r WINDOW w AS (PARTITION BY event_type ORDER BY hour)) SELECT event_type, hour, round(y, 5) AS filtered FROM y WHERE n % 4 = 0"""),
    "f13_electrodes": "SELECT s_suppkey AS electrode, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey ELSE -1 END AS reference FROM supplier",
    "f14_electrode_index": "SELECT o_custkey, o_orderkey + CASE WHEN o_orderkey % 5 = 0 THEN 1000000000 ELSE 0 END AS electrode, CASE WHEN o_orderkey % 5 <> 0 THEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 END AS position FROM orders",
    "f34_sort_interval": sql(f"""b0 AS (SELECT o_custkey AS k, epoch_us(o_orderdate::TIMESTAMP) + 45 * {DAY} AS start, epoch_us(o_orderdate::TIMESTAMP) + 105 * {DAY} AS stop FROM orders),
m1 AS (SELECT *, max(stop) OVER (PARTITION BY k ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM (SELECT DISTINCT * FROM oi)), g1 AS (SELECT *, sum((far IS NULL OR start >= far)::INT) OVER (PARTITION BY k ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS g FROM m1), a AS (SELECT k, min(start) AS a, max(stop) AS b FROM g1 GROUP BY k, g),
m2 AS (SELECT *, max(stop) OVER (PARTITION BY k ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM (SELECT DISTINCT * FROM b0)), g2 AS (SELECT *, sum((far IS NULL OR start >= far)::INT) OVER (PARTITION BY k ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS g FROM m2), b AS (SELECT k, min(start) AS c, max(stop) AS d FROM g2 GROUP BY k, g)
SELECT k, greatest(a, c) AS start, least(b, d) AS stop FROM a JOIN b USING (k) WHERE least(b, d) - greatest(a, c) > {20 * DAY}""", 90),
    "b10_epoch_inputs": sql(f"p AS (SELECT DISTINCT event_type, t // {DAY} * {DAY} + {4 * HOUR} AS a, t // {DAY} * {DAY} + {16 * HOUR} AS b FROM ev) SELECT event_id, p.event_type, dense_rank() OVER (PARTITION BY p.event_type ORDER BY a) - 1 AS epoch FROM p JOIN ev ON ev.event_type = p.event_type AND t BETWEEN a AND b"),
    "k29_concatenated": sql(f"{_SAMPLES} SELECT event_type, idx, row_number() OVER (PARTITION BY event_type ORDER BY t) - 1 AS place FROM sm WHERE t % {DAY} <= {DAY // 3}"),
    "v1_access_log": f"WITH r AS (SELECT DISTINCT source, lang, coalesce(text, '') AS text FROM documents), p AS (SELECT *, unnest(range(0, greatest(0, (length(text) - 1) // {V.CHUNK}) + 1)) AS piece FROM r) SELECT source, lang, piece::INT AS piece, md5(substring(text, piece * {V.CHUNK} + 1, {V.CHUNK})) AS digest FROM p",
    "v2_export_cascade": """WITH RECURSIVE ed AS (SELECT DISTINCT l_partkey AS file, l_suppkey + 1000000000 AS source FROM lineitem UNION SELECT s_suppkey + 1000000000, s_nationkey + 2000000000 FROM supplier UNION SELECT n_nationkey + 2000000000, n_regionkey + 3000000000 FROM nation),
dn(file) AS (SELECT 3000000001 UNION SELECT ed.file FROM ed JOIN dn ON ed.source = dn.file), e AS (SELECT o_custkey AS paper, max(o_orderkey) AS x FROM orders GROUP BY 1),
up(paper, file) AS (SELECT DISTINCT paper, l_partkey FROM e JOIN lineitem ON l_orderkey = x WHERE l_partkey IN (SELECT file FROM dn) UNION SELECT paper, ed.source FROM up JOIN ed USING (file)) SELECT paper, file FROM up""",
    "v2_export_set": "WITH e AS (SELECT o_custkey AS paper, max(o_orderkey) AS x FROM orders GROUP BY 1), f AS (SELECT DISTINCT paper, l_partkey AS file FROM e JOIN lineitem ON l_orderkey = x) SELECT * FROM f UNION SELECT paper, l_suppkey + 1000000000 FROM f JOIN lineitem ON l_partkey = file",
    "v3_linked_files": "SELECT DISTINCT CASE WHEN l_suppkey IS NULL THEN p_partkey ELSE l_suppkey + 1000000000 END AS file FROM part LEFT JOIN lineitem ON l_partkey = p_partkey AND l_partkey % 7 = 0",
    "v4_file_issues": f"WITH {_ISSUES} SELECT * FROM i",
    "v5_tables_with_issues": f"WITH {_ISSUES} SELECT file, 'labels' AS table_name, count(*) AS rows FROM i JOIN labels ON doc_id = file GROUP BY 1 UNION ALL SELECT file, 'orders', count(*) FROM i JOIN orders ON o_custkey = file GROUP BY 1",
    "v6_untracked": "WITH d AS (SELECT DISTINCT doc_id AS f FROM documents WHERE doc_id % 4 <> 0), l AS (SELECT doc_id AS f FROM labels UNION SELECT doc_id FROM documents WHERE doc_id % 5 = 0) SELECT f AS file, 'untracked' AS kind FROM d WHERE f NOT IN (SELECT f FROM l) UNION ALL SELECT f, 'orphan' FROM l WHERE f NOT IN (SELECT f FROM d)",
    "v14_environments": "SELECT p_size AS env, 'lib-' || p_partkey AS name, p_partkey % 7 || '.0' AS old, CASE WHEN p_partkey % 5 <> 0 THEN p_partkey % 7 + 1 || '.0' END AS new, CASE WHEN p_partkey % 5 = 0 THEN 'missing' ELSE 'changed' END AS change FROM part WHERE p_partkey % 5 = 0 OR p_partkey % 3 = 0",
    "v17_subjects": "SELECT c_custkey, ['M', 'F', 'U'][c_custkey % 3 + 1] AS sex, CASE WHEN c_custkey % 2 = 0 THEN 'Rattus norvegicus' ELSE 'Lemur' END AS species, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey || ' g' ELSE '10 kg' END AS weight, CASE WHEN c_custkey % 5 = 0 THEN 'P1Y' ELSE 'P4M/P8M' END AS age FROM customer",
    "v18_names": "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Ann B' WHEN c_custkey % 3 = 1 THEN 'Ann' END AS first, CASE WHEN c_custkey % 3 < 2 THEN c_mktsegment END AS last FROM customer",
    "v24_regions": "WITH a AS (SELECT n_name AS region_name, CASE WHEN n_nationkey % 2 = 0 THEN 'sub' END AS subregion_name, n_nationkey::BIGINT AS i, n_regionkey < 3 AS k FROM nation), m AS (SELECT max(i) AS m FROM a WHERE k) SELECT region_name, subregion_name, CASE WHEN k THEN i ELSE m + row_number() OVER (PARTITION BY k ORDER BY region_name, subregion_name) END AS region_id FROM a, m",
}

"""Registered queries of the relational, lineage and merge operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lineage as L
from ..operators import merge as M
from ..operators import relational as R
from .tables import read

SPECS = [
    L.TableSpec("region", ["r_regionkey"]),
    L.TableSpec("nation", ["n_nationkey"], {"region": {"n_regionkey": "r_regionkey"}}),
    L.TableSpec("customer", ["c_custkey"], {"nation": {"c_nationkey": "n_nationkey"}}),
    L.TableSpec("supplier", ["s_suppkey"], {"nation": {"s_nationkey": "n_nationkey"}}),
    L.TableSpec("part", ["p_partkey"]),
    L.TableSpec("orders", ["o_orderkey"], {"customer": {"o_custkey": "c_custkey"}}),
    L.TableSpec("lineitem", ["l_orderkey", "l_linenumber"], {"orders": {"l_orderkey": "o_orderkey"}, "part": {"l_partkey": "p_partkey"}, "supplier": {"l_suppkey": "s_suppkey"}}),
]


def star(spark, d) -> L.Catalogue:
    return L.Catalogue(SPECS, lambda name: read(spark, d, name))


def r1_predicate(s, d):
    return R.restrict(read(s, d, "orders"), "o_orderpriority LIKE '%URGENT' AND o_totalprice > 1000 AND o_orderstatus IN ('F', 'O')").select("o_orderkey", "o_totalprice")


def r2_mapping(s, d):
    return R.restrict(read(s, d, "orders"), {"o_orderstatus": "F", "no_such": 1}).select("o_orderkey")


def r3_list(s, d):
    return R.restrict(read(s, d, "orders"), [{"o_orderstatus": "F"}, "o_totalprice > 300000"]).select("o_orderkey")


def r5_semijoin(s, d):
    big = read(s, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.restrict(read(s, d, "orders"), big).select("o_orderkey", "o_custkey")


def r6_antirestrict(s, d):
    had = read(s, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return R.antirestrict(read(s, d, "customer"), had).select("c_custkey", "c_name")


def r7_natural_join(s, d):
    n = read(s, d, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    return R.natural_join(n, read(s, d, "region").select("r_regionkey", "r_name"))


def r8_project(s, d):
    return R.project(read(s, d, "lineitem"), "l_orderkey", "l_linenumber", revenue="l_extendedprice * (1 - l_discount)", quantity="l_quantity", nothing="'0'")


def r9_union(s, d):
    a = read(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return R.union(a, read(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation")))


def r10_intersect(s, d):
    c = star(s, d)
    a = {"orders": read(s, d, "orders").where("o_orderstatus = 'F'")}
    b = {"orders": read(s, d, "orders").where("o_totalprice > 100000")}
    return L.merge_graphs(c, a, b, "and")["orders"].select("o_orderkey")


def r11_distinct(s, d):
    return R.distinct_keys(read(s, d, "lineitem"), "l_returnflag", "l_linestatus")


def r12_aggregate(s, d):
    return R.aggregate(read(s, d, "lineitem"), ["l_returnflag", "l_linestatus"], n=F.count("*"), most=F.max("l_quantity"), total=F.round(F.sum("l_extendedprice"), 2))


def r13_signature(s, d):
    return R.set_signature(read(s, d, "lineitem"), ["l_orderkey"], "l_suppkey")


def r14_top(s, d):
    return R.top(read(s, d, "orders").select("o_orderkey", "o_totalprice"), 50, F.desc("o_totalprice"), F.asc("o_orderkey"), offset=10)


def r16_value_list(s, d):
    return R.restrict_by_list(read(s, d, "lineitem"), "l_returnflag", ["A", "R"]).select("l_orderkey", "l_linenumber")


def r17_todo(s, d):
    c = read(s, d, "customer")
    return R.todo_keys([read(s, d, "nation").select("n_nationkey"), c.select("c_mktsegment")], ["n_nationkey", "c_mktsegment"], c.where("c_acctbal > 0").select(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment"))


def r18_missing_parents(s, d):
    li = read(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return R.missing_parents(li, {"part": (read(s, d, "part").where("p_size > 5"), {"l_partkey": "p_partkey"}), "supplier": (read(s, d, "supplier").where("s_acctbal > 0"), {"l_suppkey": "s_suppkey"})}).select("l_orderkey", "l_linenumber", "has_part", "has_supplier")


def r19_orphans(s, d):
    return R.orphans(read(s, d, "part").select("p_partkey"), ["p_partkey"], [(read(s, d, "lineitem").where("l_quantity > 49"), ["l_partkey"])])


def r20_replace(s, d):
    new = read(s, d, "supplier").where("s_acctbal < 0").select("s_suppkey", F.lit(0.0).alias("s_acctbal"))
    return R.replace_by_key(read(s, d, "supplier"), ["s_suppkey"], "s_acctbal", new).select("s_suppkey", "s_acctbal")


def r21_dedupe(s, d):
    return R.dedupe(read(s, d, "orders"), ["o_custkey"], F.asc("o_orderdate"), F.asc("o_orderkey")).select("o_custkey", "o_orderkey")


def r22_assign_ids(s, d):
    o = read(s, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("id"), "o_orderstatus")
    return R.assign_ids(o.where("o_orderstatus = 'O'").select("k", F.col("id").alias("old")), o.where("o_orderstatus = 'F'"), ["k"], "id", F.asc("old"))


def r23_cascade_rows(s, d):
    return L.counts(L.cascade(star(s, d), {"customer": read(s, d, "customer").where("c_acctbal < 0")}, "down"))


def g1_upstream(s, d):
    return L.restrict_by(star(s, d), "lineitem", "r_name = 'ASIA'", {"r_name"}, ban=("supplier", "part")).select("l_orderkey", "l_linenumber")


def g2_downstream(s, d):
    return L.restrict_by(star(s, d), "region", "l_quantity > 49", {"l_quantity"}, "down", ban=("supplier",)).select("r_regionkey", "r_name")


def g5_bridge(s, d):
    return L.bridge(read(s, d, "orders"), read(s, d, "customer").where("c_mktsegment = 'BUILDING'"), {"o_custkey": "c_custkey"}).select("o_orderkey")


def g6_cascade(s, d):
    return L.counts(L.cascade(star(s, d), {"lineitem": read(s, d, "lineitem").where("l_quantity > 49 AND l_discount > 0.08")}, "up"))


def g7_union(s, d):
    c = star(s, d)
    a = L.cascade(c, {"orders": read(s, d, "orders").where("o_totalprice > 200000")}, "up")
    b = L.cascade(c, {"customer": read(s, d, "customer").where("c_acctbal < 0")}, "up")
    return L.counts(L.merge_graphs(c, a, b, "or"))


def g11_content_hash(s, d):
    return L.content_hash(read(s, d, "nation")).select("rows")


def g12_files(s, d):
    c = L.cascade(star(s, d), {"lineitem": read(s, d, "lineitem").where("l_quantity > 49")}, "up")
    return c["orders"].select(F.concat(F.lit("order-"), F.col("o_orderkey"), F.lit(".nwb")).alias("file")).union(c["customer"].select(F.concat(F.lit("customer-"), F.col("c_custkey"), F.lit(".nwb")))).distinct()


def g13_permission(s, d):
    members = read(s, d, "customer").select(F.col("c_nationkey").alias("team"), F.col("c_custkey").alias("person"))
    rows = read(s, d, "orders").select(F.col("o_orderkey").alias("session"), F.col("o_custkey").alias("person"))
    return L.delete_permission(rows, members, 1)


def v21_fellows(s, d):
    return L.fellows(read(s, d, "customer").select(F.col("c_nationkey").alias("team"), F.col("c_custkey").alias("person")), 1)


def _parts(s, d):
    return {"customer": (read(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")), ["id"]), "supplier": (read(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")), ["id"])}


def m1_merge_view(s, d):
    return M.merge_view(_parts(s, d))


def m2_merge_insert(s, d):
    p = _parts(s, d)["supplier"][0]
    master = M.with_ids(p.where("balance > 0"), "supplier", ["id"])
    return M.merge_insert(master, p, "supplier", ["id"], p.where("id % 2 = 0"))


def m3_restrict_parts(s, d):
    return M.merge_view(M.restrict_parts(_parts(s, d), ["segment"], "balance > 5000")).select("id", "source", "segment")


def m4_get_part(s, d):
    found = M.restrict_parts(_parts(s, d), ["balance"], "balance > 9000", "supplier")
    return found["supplier"][0].select("id", "balance")


def m5_merge_fetch(s, d):
    return M.merge_fetch(_parts(s, d), ["id", "balance"])


def m6_merge_delete(s, d):
    parts = {n: M.with_ids(df, n, key) for n, (df, key) in _parts(s, d).items()}
    master = parts["customer"].select("merge_id", "source").unionByName(parts["supplier"].select("merge_id", "source"))
    left, _ = M.merge_delete(master, parts, "customer", "balance < 0")
    return left.groupBy("source").agg(F.count("*").alias("rows"))


def m8_ids_by_upstream(s, d):
    c = star(s, d)
    kept = L.restrict_by(c, "lineitem", "r_name = 'EUROPE'", {"r_name"}, ban=("supplier", "part"))
    return M.with_ids(kept.select("l_orderkey", "l_linenumber"), "lineitem", ["l_orderkey", "l_linenumber"]).select("merge_id")


QUERIES = {f.__name__: f for f in (r1_predicate, r2_mapping, r3_list, r5_semijoin, r6_antirestrict, r7_natural_join, r8_project, r9_union, r10_intersect, r11_distinct, r12_aggregate, r13_signature, r14_top, r16_value_list, r17_todo, r18_missing_parents, r19_orphans, r20_replace, r21_dedupe, r22_assign_ids, r23_cascade_rows, g1_upstream, g2_downstream, g5_bridge, g6_cascade, g7_union, g11_content_hash, g12_files, g13_permission, v21_fellows, m1_merge_view, m2_merge_insert, m3_restrict_parts, m4_get_part, m5_merge_fetch, m6_merge_delete, m8_ids_by_upstream)}

_ID = "md5(concat_ws('|', '{n}', {k}::VARCHAR))"
_CHAIN = "orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"
_MV = f"SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, 'customer' AS source, {_ID.format(n='customer', k='c_custkey')} AS merge_id FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL, 'supplier', {_ID.format(n='supplier', k='s_suppkey')} FROM supplier"

ORACLES = {
    "r1_predicate": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority LIKE '%URGENT' AND o_totalprice > 1000 AND o_orderstatus IN ('F', 'O')",
    "r2_mapping": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'",
    "r3_list": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' OR o_totalprice > 300000",
    "r5_semijoin": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)",
    "r6_antirestrict": "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
    "r7_natural_join": "SELECT n_nationkey, n_name, r_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    "r8_project": "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue, l_quantity AS quantity, '0' AS nothing FROM lineitem",
    "r9_union": "SELECT c_custkey AS id, c_name AS name, NULL AS nation FROM customer UNION ALL SELECT s_suppkey, NULL, s_nationkey FROM supplier",
    "r10_intersect": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000",
    "r11_distinct": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
    "r12_aggregate": "SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_quantity) AS most, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY ALL",
    "r13_signature": "SELECT l_orderkey, string_agg(l_suppkey::VARCHAR, ',' ORDER BY l_suppkey) AS signature FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) GROUP BY l_orderkey",
    "r14_top": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 10",
    "r16_value_list": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag IN ('A', 'R')",
    "r17_todo": "SELECT n_nationkey, c_mktsegment FROM nation, (SELECT DISTINCT c_mktsegment FROM customer) WHERE (n_nationkey, c_mktsegment) NOT IN (SELECT (c_nationkey, c_mktsegment) FROM customer WHERE c_acctbal > 0)",
    "r18_missing_parents": "SELECT l_orderkey, l_linenumber, l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 5) AS has_part, l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AS has_supplier FROM lineitem",
    "r19_orphans": "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)",
    "r20_replace": "SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 0.0 ELSE s_acctbal END AS s_acctbal FROM supplier",
    "r21_dedupe": "SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY o_custkey",
    "r22_assign_ids": "SELECT o_custkey AS k, o_orderkey AS old, coalesce((SELECT max(o_orderkey) FROM orders x WHERE x.o_orderstatus = 'F' AND x.o_custkey = o.o_custkey) + 1, 0) + row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS id FROM orders o WHERE o_orderstatus = 'O'",
    "r23_cascade_rows": "WITH c AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0), o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (FROM c)) SELECT 'customer' AS table_name, count(*) AS rows FROM c UNION ALL SELECT 'orders', count(*) FROM o UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey IN (FROM o)",
    "g1_upstream": f"SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM {_CHAIN} WHERE r_name = 'ASIA')",
    "g2_downstream": f"SELECT r_regionkey, r_name FROM region WHERE r_regionkey IN (SELECT r.r_regionkey FROM {_CHAIN} JOIN lineitem ON l_orderkey = o_orderkey WHERE l_quantity > 49)",
    "g5_bridge": "SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'",
    "g6_cascade": """WITH l AS (SELECT * FROM lineitem WHERE l_quantity > 49 AND l_discount > 0.08), o AS (SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM l)), p AS (SELECT * FROM part WHERE p_partkey IN (SELECT l_partkey FROM l)), s AS (SELECT * FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM l)),
c AS (SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM o)), n AS (SELECT * FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM c) OR n_nationkey IN (SELECT s_nationkey FROM s)), r AS (SELECT * FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM n)),
x AS (SELECT 'lineitem' AS table_name, count(*) AS rows FROM l UNION ALL SELECT 'orders', count(*) FROM o UNION ALL SELECT 'part', count(*) FROM p UNION ALL SELECT 'supplier', count(*) FROM s UNION ALL SELECT 'customer', count(*) FROM c UNION ALL SELECT 'nation', count(*) FROM n UNION ALL SELECT 'region', count(*) FROM r) SELECT * FROM x WHERE rows > 0""",
    "g7_union": """WITH o AS (SELECT * FROM orders WHERE o_totalprice > 200000), c AS (SELECT * FROM customer WHERE c_acctbal < 0 OR c_custkey IN (SELECT o_custkey FROM o)), n AS (SELECT * FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM c)), r AS (SELECT * FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM n)),
x AS (SELECT 'orders' AS table_name, count(*) AS rows FROM o UNION ALL SELECT 'customer', count(*) FROM c UNION ALL SELECT 'nation', count(*) FROM n UNION ALL SELECT 'region', count(*) FROM r) SELECT * FROM x WHERE rows > 0""",
    "g11_content_hash": "SELECT count(*) AS rows FROM nation",
    "g12_files": "WITH o AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)) SELECT 'order-' || o_orderkey || '.nwb' AS file FROM o UNION SELECT 'customer-' || o_custkey || '.nwb' FROM o",
    "g13_permission": "SELECT o_orderkey AS session, coalesce(c_nationkey = (SELECT c_nationkey FROM customer WHERE c_custkey = 1), false) AS allowed FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
    "v21_fellows": "SELECT c_custkey AS person FROM customer WHERE c_nationkey = (SELECT c_nationkey FROM customer WHERE c_custkey = 1)",
    "m1_merge_view": _MV,
    "m2_merge_insert": f"SELECT merge_id, source FROM ({_MV}) WHERE source = 'supplier' AND id % 2 = 0 AND NOT balance > 0",
    "m3_restrict_parts": "SELECT c_custkey AS id, 'customer' AS source, c_mktsegment AS segment FROM customer WHERE c_acctbal > 5000",
    "m4_get_part": "SELECT s_suppkey AS id, s_acctbal AS balance FROM supplier WHERE s_acctbal > 9000",
    "m5_merge_fetch": f"SELECT source, id, balance FROM ({_MV})",
    "m6_merge_delete": "SELECT 'customer' AS source, count(*) AS rows FROM customer WHERE NOT c_acctbal < 0 UNION ALL SELECT 'supplier', count(*) FROM supplier",
    "m8_ids_by_upstream": f"SELECT md5(concat_ws('|', 'lineitem', l_orderkey::VARCHAR, l_linenumber::VARCHAR)) AS merge_id FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM {_CHAIN} WHERE r_name = 'EUROPE')",
}

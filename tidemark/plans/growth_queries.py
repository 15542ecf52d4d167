"""Registered queries of storage growth: orders fill a store that is cleared at each year's end."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.blocks import running_sum
from ..operators import growth as G
from .tables import DAY, read

P = ["o_orderpriority"]


def _store(s, d):
    """What each priority's store holds after each day with orders; its capacity is what all its orders come to in half of the time."""
    days = read(s, d, "orders").groupBy(*P, F.unix_micros(F.date_trunc("day", "o_orderdate").cast("timestamp")).alias("x"), F.year("o_orderdate").alias("year")).agg(F.sum(F.floor("o_totalprice")).alias("v"))
    used = running_sum(days, [*P, "year"], "x", F.col("v"), "used", 65536 * DAY)
    return used.join(days.groupBy(*P).agg(F.expr("sum(v) div 2").alias("capacity")), P).select(*P, "x", "used", (F.col("capacity") - F.col("used")).alias("available"))


def f36_runway(s, d):
    out = G.growth_runway(_store(s, d), P, "x", "used", "available", DAY)
    return out.select(*P, "readings", *(F.round(c, 4).alias(c) for c in ("central", "conservative", "runway_days", "conservative_days")), "outlook")


def f37_backtest(s, d):
    out = G.growth_backtest(_store(s, d), P, "x", "used", "available", DAY)
    return out.select(*P, "horizon", "n", F.round("mae", 3).alias("mae"), F.round("rmse", 3).alias("rmse"))


QUERIES = {f.__name__: f for f in (f36_runway, f37_backtest)}

_STORE = """dy AS (SELECT o_orderpriority, date_diff('day', TIMESTAMP '1970-01-01', date_trunc('day', o_orderdate)) AS x, year(o_orderdate) AS y, sum(floor(o_totalprice)::BIGINT)::BIGINT AS v FROM orders GROUP BY ALL),
us AS (SELECT o_orderpriority, x, (sum(v) OVER (PARTITION BY o_orderpriority, y ORDER BY x))::DOUBLE AS used, ((sum(v) OVER (PARTITION BY o_orderpriority))::BIGINT // 2)::DOUBLE AS cap FROM dy),
rd AS (SELECT o_orderpriority, x, used, cap, row_number() OVER w AS i, lag(used) OVER w AS before FROM us WINDOW w AS (PARTITION BY o_orderpriority ORDER BY x))"""
_SEGMENTS = """kn AS (SELECT cu.t, rd.* FROM cu JOIN rd ON rd.o_orderpriority = cu.o_orderpriority AND rd.x <= cu.t),
la AS (SELECT o_orderpriority, t, max(i) AS m, arg_max(used, i) AS used, arg_max(x, i) AS x, any_value(cap) AS cap FROM kn GROUP BY ALL HAVING count(*) > 1),
ud AS (SELECT o_orderpriority, t, quantile_cont(used - before, 0.5) AS usual FROM kn WHERE before IS NOT NULL GROUP BY ALL),
ma AS (SELECT o_orderpriority, t, quantile_cont(abs(used - before - usual), 0.5) AS off FROM kn JOIN ud USING (o_orderpriority, t) WHERE before IS NOT NULL GROUP BY ALL),
be AS (SELECT kn.o_orderpriority, kn.t, max(i) AS s FROM kn JOIN ma USING (o_orderpriority, t) WHERE before - used > greatest(0.03 * cap, 20 * off) GROUP BY ALL),
sg AS (SELECT la.*, coalesce(s, 1) AS s FROM la LEFT JOIN be USING (o_orderpriority, t)),
sl AS (SELECT g.o_orderpriority, g.t, (b.used - a.used) / (b.x - a.x) AS v FROM sg g JOIN rd a ON a.o_orderpriority = g.o_orderpriority AND a.i BETWEEN g.s AND g.m JOIN rd b ON b.o_orderpriority = g.o_orderpriority AND b.i > a.i AND b.i <= g.m),
es AS (SELECT o_orderpriority, t, quantile_cont(v, 0.5) AS central, quantile_cont(v, 0.75) AS conservative FROM sl GROUP BY ALL)"""
_SPAN = "CASE WHEN {0} < 60 THEN '~' || round_even({0}, 0)::BIGINT || ' days' WHEN {0} < 730 THEN '~' || round_even({0} / 30, 0)::BIGINT || ' months' ELSE printf('~%.1f years', {0} / 365) END"

ORACLES = {
    "f36_runway": f"""WITH {_STORE},
cu AS (SELECT o_orderpriority, max(x) AS t FROM rd GROUP BY ALL),
{_SEGMENTS},
ru AS (SELECT sg.o_orderpriority, m - s + 1 AS readings, central, conservative, CASE WHEN central > 0 THEN (cap - used) / central END AS a, CASE WHEN central > 0 AND conservative > 0 THEN (cap - used) / conservative END AS b FROM sg LEFT JOIN es USING (o_orderpriority, t))
SELECT o_orderpriority, readings, round(central, 4) AS central, round(conservative, 4) AS conservative, round(a, 4) AS runway_days, round(b, 4) AS conservative_days,
CASE WHEN central IS NULL THEN 'N/A' WHEN central <= 0 THEN 'stable' ELSE {_SPAN.format("a")} || CASE WHEN b IS NULL THEN '' ELSE ' (conservative: ' || {_SPAN.format("b")} || ')' END END AS outlook FROM ru""",
    "f37_backtest": f"""WITH {_STORE},
en AS (SELECT o_orderpriority, min(x) AS a, max(x) AS b FROM rd GROUP BY ALL),
cu AS (SELECT o_orderpriority, unnest(range(a + 14, b - 30 + 1, 7)) AS t FROM en),
{_SEGMENTS},
fo AS (SELECT o_orderpriority, t, h AS horizon, used + central * h AS guess, x + h AS target FROM sg JOIN es USING (o_orderpriority, t) JOIN en USING (o_orderpriority) CROSS JOIN (VALUES (30), (60), (90)) v(h) WHERE m - s + 1 >= 5 AND t <= b - h),
er AS (SELECT fo.o_orderpriority, fo.t, horizon, guess - arg_min(rd.used, rd.i) AS e FROM fo JOIN rd ON rd.o_orderpriority = fo.o_orderpriority AND rd.x BETWEEN target AND target + 3 GROUP BY fo.o_orderpriority, fo.t, horizon, guess)
SELECT o_orderpriority, horizon, count(*) AS n, round(avg(abs(e)), 3) AS mae, round(sqrt(avg(e * e)), 3) AS rmse FROM er GROUP BY ALL""",
}

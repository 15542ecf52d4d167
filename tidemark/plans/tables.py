"""The supplied tables as intervals, series and trains."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import micros

DAY = 86_400_000_000
HOUR = 3_600_000_000
#: The views that the SQL below starts from, in DuckDB's dialect.
SQL = f"""ev AS (SELECT event_id, epoch_us(ts::TIMESTAMP) AS t, user_id, event_type, value, props FROM events),
oi AS (SELECT o_custkey AS k, epoch_us(o_orderdate::TIMESTAMP) AS start, epoch_us(o_orderdate::TIMESTAMP) + {{days}} * {DAY} AS stop FROM orders)"""


def sql(body: str, days: int = 60) -> str:
    return f"WITH {SQL.format(days=days)},\n{body.strip()}"


def smoothed(src: str, out: str, column: str, order: str, sigma: float, key: str | None = None) -> str:
    """SQL of the view ``out``: ``src`` with ``y``, a Gaussian mean of a column over neighbouring rows."""
    reach = int(4 * sigma + 0.5)
    near = [(f"{'lag' if k <= 0 else 'lead'}({column}, {abs(k)}) OVER w", math.exp(-0.5 * (k / sigma) ** 2)) for k in range(-reach, reach + 1)]
    top, low = " + ".join(f"coalesce({x}, 0) * {h!r}" for x, h in near), " + ".join(f"CASE WHEN {x} IS NULL THEN 0 ELSE {h!r} END" for x, h in near)
    return f"{out} AS (SELECT *, ({top}) / ({low}) AS y FROM {src} WINDOW w AS ({f'PARTITION BY {key} ' if key else ''}ORDER BY {order}))"


def above_mean(src: str, out: str, key: str, i: str, t: str, threshold: float, least: int) -> str:
    """SQL of the view ``out(key, start, stop, samples, peak)``: runs of ``z >= 0`` with one of ``z >= threshold`` of at least ``least``, by row number ``i``."""
    return f"""{out}_a AS (SELECT *, {i} - row_number() OVER (PARTITION BY {key} ORDER BY {i}) AS m FROM {src} WHERE z >= 0), {out}_b AS (SELECT *, {i} - row_number() OVER (PARTITION BY {key}, m ORDER BY {i}) AS r FROM {out}_a WHERE z >= {threshold}),
{out}_c AS (SELECT DISTINCT {key}, m FROM (SELECT {key}, m, r FROM {out}_b GROUP BY ALL HAVING max({t}) - min({t}) >= {least})), {out} AS (SELECT {key}, min({t}) AS start, max({t}) AS stop, count(*) AS samples, max(z) AS peak FROM {out}_a JOIN {out}_c USING ({key}, m) GROUP BY {key}, m)"""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", micros("ts").alias("t"), "user_id", "event_type", "value", "props")


def order_intervals(spark: SparkSession, sf_dir: str, days: int = 60, shift: int = 0) -> DataFrame:
    """An interval of so many days from each order, by customer."""
    start = micros("o_orderdate") + F.lit(shift * DAY)
    return read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), start.alias("start"), (start + days * DAY).alias("stop"))

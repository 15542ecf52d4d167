"""One query end to end: events within valid parts of order periods, counted and rated per part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import intervals as I
from .tables import DAY, HOUR, events

GAP = 2 * HOUR


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid stretches of each event type, cut by day halves, with the events in them and their rate."""
    ev = events(spark, sf_dir)
    key = ["event_type"]
    valid = I.merge_touching(ev.select("event_type", F.col("t").alias("start"), (F.col("t") + GAP).alias("stop")), key)
    days = ev.select("event_type", (F.floor(F.col("t") / DAY) * DAY).alias("start")).distinct().withColumn("stop", F.col("start") + DAY // 2)
    parts = I.intersect(valid, days, key, 0, DAY)
    met = I.contains(ev.select("event_id", "event_type", "t", "value"), parts, key, "t", DAY)
    counted = met.groupBy("event_type", "start", "stop").agg(F.count("*").alias("n"), F.round(F.avg("value"), 10).alias("mean_value"))
    return counted.withColumn("per_hour", F.round(F.col("n") * HOUR / (F.col("stop") - F.col("start")), 6))

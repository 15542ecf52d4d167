"""Registered queries of the streaming operators, over the events as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import micros
from ..functions.store import own_folder
from ..streaming import ordered
from ..streaming import stateful as T
from .tables import HOUR, read, sql

#: A stream ends with the files that are there when it starts; this is the time it may take.
_SECONDS = 1800


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = read(spark, sf_dir, "events").schema
    # as a pattern, since a stream takes the path of a single file for that of a folder
    rows = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return rows.select("event_id", "user_id", "event_type", "value", micros("ts").alias("t")).withColumn("ts", F.timestamp_micros("t"))


def _run(stream: DataFrame) -> DataFrame:
    """What the stream appends, written to a folder and read again."""
    spark = stream.sparkSession
    folder = own_folder(spark, "stream")
    query = stream.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    if not query.awaitTermination(_SECONDS):
        query.stop()
        raise TimeoutError("the stream did not end")
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def _t(name: str):
    return F.unix_micros(name).alias(name)


def s1_valid_stretches(s, d):
    return _run(T.valid_stretches(_events(s, d), "event_type", "ts", "2 hours", "1 hour")).select("event_type", _t("first"), _t("last"), "n")


def s2_tumbling_counts(s, d):
    return _run(T.tumbling_counts(_events(s, d), "event_type", "ts", "6 hours", "1 hour")).select("event_type", _t("start"), "n")


def s3_triggers(s, d):
    return _run(T.triggers(_events(s, d), "event_type", "t", "event_id", "value", 80.0, 6 * HOUR)).select("key", "t")


def s4_on_off_pairs(s, d):
    edges = _events(s, d).where("value > 80 or value < 10")
    return _run(T.on_off_pairs(edges, "event_type", "t", F.col("value") > 80))


def s5_speed_gate(s, d):
    return _run(T.speed_gate(_events(s, d), "value", 25.0).select("event_id"))


def s3_late_triggers(s, d):
    with ordered.state_store(s):
        return _run(ordered.triggers(_events(s, d), "event_type", "t", "event_id", "value", 80.0, 6 * HOUR, "12 hours")).withColumnRenamed("key", "event_type")


def s4_late_pairs(s, d):
    edges = _events(s, d).where("value > 80 or value < 10")
    with ordered.state_store(s):
        return _run(ordered.on_off_pairs(edges, "event_type", "t", F.col("value") > 80, 2 * HOUR, "12 hours")).withColumnRenamed("key", "event_type")


QUERIES = {f.__name__: f for f in (s3_late_triggers, s4_late_pairs, s1_valid_stretches, s2_tumbling_counts, s3_triggers, s4_on_off_pairs, s5_speed_gate)}

ORACLES = {
    # a window is out once the watermark, an hour before the last event, has passed its end
    "s1_valid_stretches": sql(f"""f AS (SELECT event_type, t, t - lag(t) OVER (PARTITION BY event_type ORDER BY t) >= {2 * HOUR} AS far FROM ev), g AS (SELECT *, sum(coalesce(far, false)::INT) OVER (PARTITION BY event_type ORDER BY t RANGE UNBOUNDED PRECEDING) AS g FROM f)
SELECT event_type, min(t) AS first, max(t) AS last, count(*) AS n FROM g GROUP BY event_type, g HAVING max(t) + {2 * HOUR} <= (SELECT max(t) - {HOUR} FROM ev)"""),
    "s2_tumbling_counts": sql(f"w AS (SELECT event_type, t // {6 * HOUR} * {6 * HOUR} AS start, count(*) AS n FROM ev GROUP BY ALL) SELECT * FROM w WHERE start + {6 * HOUR} <= (SELECT max(t) - {HOUR} FROM ev)"),
    "s3_triggers": f"""WITH RECURSIVE o AS (SELECT event_type AS key, epoch_us(ts::TIMESTAMP) AS t FROM events WHERE value >= 80), r AS (SELECT key, min(t) AS t FROM o GROUP BY key UNION ALL SELECT r.key, min(o.t) FROM r JOIN o ON o.key = r.key AND o.t >= r.t + {6 * HOUR} GROUP BY r.key) SELECT key, t FROM r""",
    "s4_on_off_pairs": sql("e AS (SELECT event_type, t, value > 80 AS o FROM ev WHERE value > 80 OR value < 10), p AS (SELECT *, lag(o) OVER w AS po, lag(t) OVER w AS pt FROM e WINDOW w AS (PARTITION BY event_type ORDER BY t)) SELECT event_type AS key, pt AS start, t AS stop FROM p WHERE po AND NOT o"),
    # rows up to the watermark, half a day before the last of the stream's rows; ids break ties
    "s3_late_triggers": f"""WITH RECURSIVE a AS (SELECT event_type, epoch_us(ts::TIMESTAMP) AS t, event_id AS id FROM events WHERE value >= 80), o AS (SELECT event_type, t, min(id) AS id FROM a WHERE t <= (SELECT max(t) // 1000 * 1000 - {12 * HOUR} FROM a) GROUP BY ALL),
r AS (SELECT event_type, min(t) AS t FROM o GROUP BY event_type UNION ALL SELECT r.event_type, min(o.t) FROM r JOIN o ON o.event_type = r.event_type AND o.t >= r.t + {6 * HOUR} GROUP BY r.event_type) SELECT event_type, t, id FROM r JOIN o USING (event_type, t)""",
    "s4_late_pairs": sql(f"""e AS (SELECT event_type, t, value > 80 AS o FROM ev WHERE value > 80 OR value < 10), p AS (SELECT *, lag(o) OVER w AS po, lag(t) OVER w AS pt FROM e WHERE t <= (SELECT max(t) // 1000 * 1000 - {12 * HOUR} FROM e) WINDOW w AS (PARTITION BY event_type ORDER BY t, o))
SELECT event_type, pt AS start, t AS stop FROM p WHERE po AND NOT o AND t - pt <= {2 * HOUR}"""),
    "s5_speed_gate": "SELECT event_id FROM events WHERE value <= 25",
}

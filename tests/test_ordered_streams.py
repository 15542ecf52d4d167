"""Streams whose files come out of order, against the plain walk through all rows that the watermark has passed."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.streaming import ordered as O

S = 1_000_000
SCHEMA = "key string, t long, id long, value double"


def _run(df, tmp_path, name):
    with O.state_store(df.sparkSession):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
    return [tuple(r) for r in df.sparkSession.table(name).collect()]


@pytest.fixture
def rows():
    rng = np.random.default_rng(8)
    made = [("ab"[k % 2], int((k * 10 + 7) * S), k, float(rng.integers(0, 100))) for k in range(80)]
    made += [("a", int((k * 10 + 7) * S), 500 + k, 99.0) for k in range(0, 80, 20)]  # ties of a time
    return made


def _stream(spark, tmp_path, rows, files=4):
    """Rows shuffled by up to 100 seconds, over files that are read one by one."""
    rng = np.random.default_rng(2)
    late = [rows[k] for k in np.argsort([r[1] + rng.integers(0, 100 * S) for r in rows])]
    late += [(None, 5 * S, 900, 99.0), ("a", None, 901, 99.0)]
    for k in range(files):
        spark.createDataFrame(late[k * len(late) // files : (k + 1) * len(late) // files], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def test_late_triggers(spark, tmp_path, rows):
    got = _run(O.triggers(_stream(spark, tmp_path, rows), "key", "t", "id", "value", 60, 45 * S, "100 seconds"), tmp_path, "late_triggers")
    passed = max(r[1] for r in rows if r[3] >= 60) - 100 * S
    want, until = set(), {}
    for k, t, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        if v >= 60 and t <= passed and t >= until.get(k, -1):
            want.add((k, t, i))
            until[k] = t + 45 * S
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("longest", [15 * S, 10_000 * S])
def test_late_pairs(spark, tmp_path, rows, longest):
    stream = _stream(spark, tmp_path, rows)
    got = _run(O.on_off_pairs(stream, "key", "t", F.col("value") > 50, longest, "100 seconds"), tmp_path, f"late_pairs_{longest}")
    passed = max(r[1] for r in rows) - 100 * S
    want, on = set(), {}
    for k, t, _, v in sorted(rows, key=lambda r: (r[1], r[3] > 50)):
        if t > passed:
            continue
        if v > 50:
            on[k] = t
        elif k in on:
            start = on.pop(k)
            if t - start <= longest:
                want.add((k, start, t))
    assert len(got) == len(set(got)) and set(got) == want

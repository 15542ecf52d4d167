"""Results and exports as Parquet, with a manifest of what has been written, and fetching by it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_result(df: DataFrame, path: str, table: str, partition_by: list[str] | None = None) -> DataFrame:
    """Writes a result as Parquet and returns its manifest row: path, table, rows and a hash free of order."""
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    back = df.sparkSession.read.parquet(path)
    digest = F.bit_xor(F.xxhash64(*[F.col(c) for c in sorted(back.columns)]))
    return back.agg(F.lit(path).alias("path"), F.lit(table).alias("table_name"), F.count("*").alias("rows"), digest.alias("contents_hash"))


def fetch(spark: SparkSession, manifest: DataFrame, key: dict[str, object]) -> DataFrame:
    """The frame of the one manifest row that has the key's values; none or several are an error."""
    rows = manifest
    for name, value in key.items():
        rows = rows.where(F.col(name) == F.lit(value))
    found = rows.select("path").limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{'no' if not found else 'more than one'} entry for {key}")
    return spark.read.parquet(found[0].path)


def export(frames: dict[str, DataFrame], path: str) -> DataFrame:
    """Writes each restricted table below ``path`` and returns the manifest of what was written; empty tables are written too."""
    return reduce(DataFrame.union, (write_result(df, f"{path}/{name}", name) for name, df in sorted(frames.items())))

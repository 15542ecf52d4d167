"""Tagged unions: a master of ids and sources over parts of different shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_ids(part: DataFrame, source: str, key: list[str]) -> DataFrame:
    """Adds ``source`` and ``merge_id``, a hash of the key and the source."""
    values = F.concat_ws("|", F.lit(source), *[F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in key])
    return part.withColumn("source", F.lit(source)).withColumn("merge_id", F.md5(values))


def merge_view(parts: dict[str, tuple[DataFrame, list[str]]], numeric_fill: float | None = None) -> DataFrame:
    """All parts with their id and source; columns that a part lacks are null, or ``numeric_fill`` where numeric."""
    frames = [with_ids(df, name, key) for name, (df, key) in parts.items()]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out if numeric_fill is None else out.fillna(numeric_fill)


def restrict_parts(parts: dict[str, tuple[DataFrame, list[str]]], columns: list[str], predicate: str, source: str | None = None) -> dict[str, tuple[DataFrame, list[str]]]:
    """Parts that have the columns, restricted; those of another source go."""
    return {n: (df.where(predicate), key) for n, (df, key) in parts.items() if (source is None or n == source) and set(columns) <= set(df.columns)}


def merge_fetch(parts: dict[str, tuple[DataFrame, list[str]]], columns: list[str]) -> DataFrame:
    """The columns from every part that has them all."""
    frames = [df.select(F.lit(n).alias("source"), *columns) for n, (df, _) in parts.items() if set(columns) <= set(df.columns)]
    return reduce(lambda a, b: a.unionByName(b), frames)


def merge_insert(master: DataFrame, rows: DataFrame, source: str, key: list[str], parent: DataFrame) -> DataFrame:
    """New master rows for rows that the parent has and the master has not."""
    found = with_ids(rows.join(parent.select(*key).distinct(), key, "left_semi"), source, key)
    return found.join(master.select("merge_id"), "merge_id", "left_anti").select("merge_id", "source").distinct()


def merge_delete(master: DataFrame, parts: dict[str, DataFrame], source: str, predicate: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Deletes rows of a part, and master rows that no part has any more."""
    gone = parts[source].where(predicate).select("merge_id")
    left = {n: df.join(gone, "merge_id", "left_anti") if n == source else df for n, df in parts.items()}
    ids = reduce(lambda a, b: a.union(b), [df.select("merge_id") for df in left.values()])
    return master.join(ids, "merge_id", "left_semi"), left

"""Restriction, natural joins, aggregates and work lists over keyed tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shared(a: DataFrame, b: DataFrame) -> list[str]:
    return [c for c in a.columns if c in b.columns]


def restrict(df: DataFrame, by) -> DataFrame:
    """Rows that satisfy ``by``: a predicate (text or Column), a mapping, a list, or a table.

    A mapping is a conjunction of equalities over the columns that ``df`` has; keys
    that it does not have are ignored, and null matches null. A list is a disjunction
    of its members, none keeps nothing. A table keeps rows that match it on the
    columns both have; without such columns it keeps all if it has any row.
    """
    if isinstance(by, str | Column):
        return df.where(by)
    if isinstance(by, Mapping):
        return reduce(lambda d, kv: d.where(F.col(kv[0]).eqNullSafe(F.lit(kv[1]))), [(k, v) for k, v in by.items() if k in df.columns], df)
    if isinstance(by, DataFrame):
        on = shared(df, by)
        return df.join(by.select(*on).distinct(), on, "left_semi") if on else df.join(by.limit(1), F.lit(True), "left_semi")
    tests = [_as_column(df, member) for member in by]
    return df.where(reduce(lambda x, y: x | y, tests, F.lit(False)))


def _as_column(df: DataFrame, by) -> Column:
    if isinstance(by, Mapping):
        return reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.lit(v)) for k, v in by.items() if k in df.columns], F.lit(True))
    return F.expr(by) if isinstance(by, str) else by


def antirestrict(df: DataFrame, other: DataFrame) -> DataFrame:
    """Rows without a match on the columns both have."""
    return df.join(other, shared(df, other), "left_anti")


def natural_join(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b, shared(a, b))


def project(df: DataFrame, *names: str, **made: str | Column) -> DataFrame:
    """Chosen columns (``...`` for all), and new ones from an expression or by renaming."""
    kept = [c for n in names for c in (df.columns if n == "..." else [n])]
    renamed = {v for v in made.values() if isinstance(v, str) and v in df.columns}
    kept = [c for c in dict.fromkeys(kept) if c not in renamed and c not in made]
    return df.select(*kept, *((F.expr(v) if isinstance(v, str) else v).alias(k) for k, v in made.items()))


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def distinct_keys(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names).distinct()


def aggregate(df: DataFrame, by: list[str], **made: Column) -> DataFrame:
    return df.groupBy(*by).agg(*(c.alias(k) for k, c in made.items()))


def set_signature(df: DataFrame, by: list[str], item: str, name: str = "signature") -> DataFrame:
    """The distinct items of each group in order, as one text."""
    return df.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_set(item)), lambda x: x.cast("string")), ",").alias(name))


def top(df: DataFrame, n: int, *order: Column, offset: int = 0) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(n)


def todo_keys(parents: list[DataFrame], key: list[str], done: DataFrame) -> DataFrame:
    """Keys that the parents' join allows and ``done`` does not have."""
    possible = reduce(lambda a, b: a.join(b, shared(a, b)) if shared(a, b) else a.crossJoin(b), [p.select(*[k for k in key if k in p.columns]).distinct() for p in parents])
    return possible.join(done.select(*key).distinct(), key, "left_anti")


def missing_parents(df: DataFrame, parents: dict[str, tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """For each row and parent whether the parent has its key; ``parents`` maps names to (table, {column of df: column of parent})."""
    for name, (table, keys) in parents.items():
        found = table.select(*[F.col(v).alias(k) for k, v in keys.items()], F.lit(True).alias(f"has_{name}")).distinct()
        df = df.join(found, list(keys), "left").withColumn(f"has_{name}", F.coalesce(f"has_{name}", F.lit(False)))
    return df


def orphans(df: DataFrame, key: list[str], children: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Rows that no child table refers to."""
    for child, names in children:
        df = df.join(child.select(*[F.col(c).alias(k) for k, c in zip(key, names, strict=True)]).distinct(), key, "left_anti")
    return df


def replace_by_key(df: DataFrame, key: list[str], column: str, new: DataFrame) -> DataFrame:
    """Takes ``column`` from ``new`` where it has the key."""
    fresh = new.select(*key, F.col(column).alias("_new"))
    return df.join(fresh, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def dedupe(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """One row for each key, the first in ``order``."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def assign_ids(new: DataFrame, old: DataFrame, by: list[str], id_: str, *order: Column) -> DataFrame:
    """Numbers new rows of a group from its largest id on; groups without rows start at 0."""
    last = old.groupBy(*by).agg(F.max(id_).alias("_last"))
    w = Window.partitionBy(*by).orderBy(*order)
    return new.join(last, by, "left").withColumn(id_, F.coalesce(F.col("_last") + 1, F.lit(0)) + F.row_number().over(w) - 1).drop("_last")


def restrict_by_list(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows with one of the values; a column that is not there is an error."""
    if column not in df.columns:
        raise KeyError(column)
    return df.where(F.col(column).isin(values))

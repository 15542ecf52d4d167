"""Hashes, differences, upserts and other checks of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.manifest import write_result  # noqa: F401

#: Steps of the unit of storage.
UNITS = ("B", "KiB", "MiB", "GiB", "TiB", "PiB")


def same(a: Column, b: Column) -> Column:
    """Equal without case; null and the empty text are the same."""
    plain = lambda c: F.lower(F.coalesce(c.cast("string"), F.lit("")))
    return plain(a) == plain(b)


def validate_upsert(new: DataFrame, old: DataFrame, key: list[str]) -> DataFrame:
    """New rows with ``status``: insert (no such key), same, or conflict."""
    values = [c for c in new.columns if c not in key]
    had = old.select(*key, *[F.col(c).alias(f"_old_{c}") for c in values], F.lit(True).alias("_had"))
    equal = F.lit(True)
    for c in values:
        equal = equal & same(F.col(c), F.col(f"_old_{c}"))
    return new.join(had, key, "left").withColumn("status", F.when(F.col("_had").isNull(), "insert").when(equal, "same").otherwise("conflict")).select(*new.columns, "status")


def upsert(new: DataFrame, old: DataFrame, key: list[str], update: bool = True) -> DataFrame:
    """Old rows overwritten by new ones of their key, and the new keys.

    Without ``update``, new rows that differ from the old ones of their key are an error that tells their number;
    it is counted when this is called.
    """
    if not update:
        n = validate_upsert(new, old, key).where("status = 'conflict'").count()
        if n:
            raise ValueError(f"{n} rows with keys that are there, but other values")
    return old.join(new.select(*key), key, "left_anti").unionByName(new.select(*old.columns))


def overlay(df: DataFrame, config: DataFrame, on: list[str]) -> DataFrame:
    """Takes the config's values where it has a row for the key and a value."""
    names = [c for c in config.columns if c not in on]
    fresh = config.select(*on, *[F.col(c).alias(f"_new_{c}") for c in names])
    out = df.join(fresh, on, "left")
    for c in names:
        out = out.withColumn(c, F.coalesce(F.col(f"_new_{c}"), F.col(c)))
    return out.select(*df.columns)


def require(df: DataFrame, names: list[str]) -> DataFrame:
    return df.dropna(subset=names)


def ingest(df: DataFrame, mapping: dict[str, str | tuple[str, object] | Column]) -> DataFrame:
    """Columns by name, by (name, default) or by expression."""
    def made(v) -> Column:
        if isinstance(v, tuple):
            return F.coalesce(F.col(v[0]), F.lit(v[1]))
        return F.col(v) if isinstance(v, str) else v

    return df.select(*[made(v).alias(k) for k, v in mapping.items()])


def select_objects(df: DataFrame, kind: str, names: list[str]) -> DataFrame:
    """Rows whose name is one of ``names``, regardless of case and spaces."""
    plain = lambda c: F.lower(F.regexp_replace(c, " ", ""))
    return df.where(plain(F.col(kind)).isin([n.replace(" ", "").lower() for n in names]))


def epoch_groups(df: DataFrame, series: str, t: str, width: int) -> DataFrame:
    """Numbers the epochs that series belong to: those that start in the same stretch of ``width``, in order."""
    start = df.groupBy(series).agg(F.min(t).alias("start"))
    slots = start.select(F.floor(F.col("start") / width).alias("slot")).distinct().withColumn("epoch", F.row_number().over(Window.orderBy("slot")) - 1)
    return start.withColumn("slot", F.floor(F.col("start") / width)).join(slots, "slot").select(series, "start", "epoch")


def storage(df: DataFrame, by: list[str], size: str) -> DataFrame:
    """Total size of each group, also in the largest unit of 1024 steps that leaves at least one."""
    total = df.groupBy(*by).agg(F.sum(size).cast("long").alias("bytes"))
    power = F.greatest(F.lit(0), F.least(F.lit(len(UNITS) - 1), F.floor(F.log2(F.greatest("bytes", F.lit(1))) / 10).cast("int")))
    return total.withColumn("unit", F.element_at(F.array(*map(F.lit, UNITS)), power + 1)).withColumn("amount", F.round(F.col("bytes") / F.pow(F.lit(1024.0), power), 2))


def row_digest(df: DataFrame, values: list[str], digits: int) -> Column:
    """SHA-256 of a row's values, numbers rounded."""
    kinds = dict(df.dtypes)
    parts = [F.format_string(f"%.{digits}f", F.round(c, digits)) if kinds[c] in ("double", "float") else F.col(c).cast("string") for c in values]
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("\\N")) for p in parts]), 256)


def content_matches(old: DataFrame, new: DataFrame, key: list[str], values: list[str], digits: int) -> DataFrame:
    """Each key with ``status``: same or different at that rounding, or missing on one side."""
    a = old.select(*key, row_digest(old, values, digits).alias("_a"))
    b = new.select(*key, row_digest(new, values, digits).alias("_b"))
    status = F.when(F.col("_a").isNull(), "missing in old").when(F.col("_b").isNull(), "missing in new").when(F.col("_a") == F.col("_b"), "same").otherwise("different")
    return a.join(b, key, "full_outer").select(*key, status.alias("status"))


def frame_diff(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """One row for each changed value, ``column, old, new``, and for rows on one side only (column null)."""
    names = [c for c in old.columns if c not in key]
    a = old.select(*key, *[F.col(c).cast("string").alias(f"_a_{c}") for c in names], F.lit(True).alias("_ina"))
    b = new.select(*key, *[F.col(c).cast("string").alias(f"_b_{c}") for c in names], F.lit(True).alias("_inb"))
    both = a.join(b, key, "full_outer")
    changes = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_a_{c}").alias("old"), F.col(f"_b_{c}").alias("new")) for c in names])
    one = F.when(F.col("_ina").isNull(), "only new").when(F.col("_inb").isNull(), "only old")
    rows = both.withColumn("side", one)
    sided = rows.where("side is not null").select(*key, "side", F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("old"), F.lit(None).cast("string").alias("new"))
    changed = rows.where("side is null").select(*key, F.lit("both").alias("side"), F.inline(changes)).where("NOT (old <=> new)")
    return sided.unionByName(changed)


def tag_by_pattern(df: DataFrame, text: str, patterns: list[tuple[str, str]]) -> Column:
    """The reason of the first pattern that the text is like; null for none."""
    out = None
    for like, reason in patterns:
        test = F.col(text).like(like)
        out = F.when(test, reason) if out is None else out.when(test, reason)
    return out


def sanitise(c: Column) -> Column:
    """A safe name: what is no letter, digit, dot or hyphen becomes one underscore."""
    return F.regexp_replace(c, "[^A-Za-z0-9.-]+", "_")


def name_parts(c: Column) -> Column:
    """``first, last`` of a trimmed "Last, First" (one comma and space) or, without that, "First Last" (one space); null for anything else."""
    c = F.trim(F.coalesce(c, F.lit("")))
    comma, space = F.split(c, ", "), F.split(c, " ")
    made = lambda first, last: F.struct(first.alias("first"), last.alias("last"))
    return F.when(F.size(comma) == 2, made(comma[1], comma[0])).when(F.size(space) == 2, made(space[0], space[1]))


def nan_default(c: Column, default: float = -1.0) -> Column:
    """The default for NaN and null."""
    return F.coalesce(F.when(~F.isnan(c), c), F.lit(default))


def severity(df: DataFrame, level: str, warning: float, violation: float, message: str, most: int = 255) -> DataFrame:
    """Adds ``severity`` by the level, and cuts the message to ``most`` printable ASCII characters."""
    kind = F.when(F.col(level) > violation, "violation").when(F.col(level) > warning, "warning").otherwise("ok")
    return df.withColumn("severity", kind).withColumn("message", F.substring(F.regexp_replace(message, "[^\\x20-\\x7E]", ""), 1, most))


def labels_from_json(df: DataFrame, json: str) -> DataFrame:
    """A row for each entry of a JSON object of numbers, ``label, value``."""
    rows = df.withColumn("_e", F.explode(F.map_entries(F.from_json(json, "map<string,long>"))))
    return rows.withColumn("label", F.col("_e.key")).withColumn("value", F.col("_e.value")).drop("_e")


def unique_ids(df: DataFrame, id_: str, *order: str) -> DataFrame:
    """Repeated ids get a new one, from a hash of the old and their number."""
    n = F.row_number().over(Window.partitionBy(id_).orderBy(*order))
    return df.withColumn("_n", n).withColumn(id_, F.when(F.col("_n") > 1, F.md5(F.concat_ws("|", F.col(id_).cast("string"), F.col("_n").cast("string")))).otherwise(F.col(id_).cast("string"))).drop("_n")


def delete_eligible(df: DataFrame, matched: Column, created: str, before: Column, size: str) -> DataFrame:
    """Number and total size of matched files created before a time."""
    return df.where(matched & (F.col(created) < before)).agg(F.count("*").alias("files"), F.coalesce(F.round(F.sum(size), 2), F.lit(0.0)).alias("total"))

"""Provenance: access logs, export sets, files, environments and metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.store import materialise

CHUNK = 2048


def access_log(reads: DataFrame, export: str, table: str, restriction: str, chunk: int = CHUNK) -> DataFrame:
    """Each restriction of a table in an export once, cut into pieces of ``chunk`` characters: ``export, table, piece, restriction``."""
    rows = reads.select(export, table, F.coalesce(restriction, F.lit("")).alias(restriction)).distinct()
    cut = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length(restriction) - 1) / chunk)).cast("int"))))
    return cut.withColumn(restriction, F.substring(restriction, F.col("piece") * chunk + 1, F.lit(chunk)))


def last_exports(exports: DataFrame, paper: str, export: str) -> DataFrame:
    """The last export of each paper."""
    return exports.groupBy(paper).agg(F.max(export).alias(export))


#: Written steps that are read side by side before they become one table.
_STEPS = 8


def reached(start: DataFrame, edges: DataFrame, key: list[str], node: str, source: str) -> DataFrame:
    """All that the nodes of ``start(key, node)`` come from by any number of ``edges(node, source)``, with themselves, as ``key, node``.

    Each step joins only what the last one found for the first time and writes what is new; it ends when nothing is, so
    circles end too. Rows with a null in ``key`` or ``node`` lead nowhere.
    """
    names = [*key, node]
    edges = materialise(edges.select(node, F.col(source).alias("_s")).where(F.col("_s").isNotNull()).distinct(), "edges")
    new = materialise(start.select(*names).distinct(), "reached")
    steps = [new]
    while True:
        found = reduce(DataFrame.union, steps)
        further = new.join(edges, node).select(*key, F.col("_s").alias(node)).distinct()
        new = materialise(further.join(found, names, "left_anti").select(*names), "reached")
        if new.isEmpty():
            return found
        steps = [*steps, new] if len(steps) < _STEPS else [materialise(found, "reached"), new]


def export_set(exports: DataFrame, log: DataFrame, upstream: DataFrame, paper: str, export: str, file: str, included: DataFrame | None = None) -> DataFrame:
    """The files of each paper's last export: those logged, and all that they come from by any number of steps of ``upstream(file, source)``.

    With ``included(file)`` only logged files count that are among these or come from them.
    """
    logged = last_exports(exports, paper, export).join(log.select(export, file).distinct(), export).select(paper, file)
    if included is not None:
        down = upstream.select(F.col("source").alias(file), F.col(file).alias("_made"))
        logged = logged.join(reached(included.select(file), down, [], file, "_made"), file, "left_semi").select(paper, file)
    return reached(logged, upstream, [paper], file, "source")


def replace_linked(files: DataFrame, links: DataFrame, file: str) -> DataFrame:
    """Files that hold links are replaced by the links' targets (``file, target``); others stay. Each file once."""
    return files.join(links, file, "left").select(F.coalesce("target", file).alias(file)).distinct()


def file_issues(manifest: DataFrame, found: DataFrame, file: str, known: DataFrame, removed: DataFrame) -> DataFrame:
    """Files of the manifest that are missing, unreadable (a null checksum) or have another checksum; known issues and files removed on purpose are left out."""
    rows = manifest.select(file, F.col("checksum").alias("_want")).join(removed.select(file), file, "left_anti").join(known.select(file), file, "left_anti")
    rows = rows.join(found.select(file, F.lit(True).alias("_there"), F.col("checksum").alias("_have")), file, "left")
    issue = F.when(F.col("_there").isNull(), "missing").when(F.col("_have").isNull(), "unreadable").when(F.col("_have") != F.col("_want"), "checksum")
    return rows.select(file, issue.alias("issue")).where("issue is not null")


def tables_with(files: DataFrame, children: dict[str, tuple[DataFrame, str]], file: str) -> DataFrame:
    """The rows of child tables that refer to the files, counted by file and table."""
    parts = [files.select(file).distinct().join(df.select(F.col(c).alias(file)), file).groupBy(file).agg(F.count("*").alias("rows")).select(file, F.lit(n).alias("table_name"), "rows") for n, (df, c) in sorted(children.items())]
    return reduce(DataFrame.unionByName, parts)


def untracked(disk: DataFrame, manifests: list[DataFrame], file: str) -> DataFrame:
    """Files on disk that no manifest has (``untracked``), and files of manifests that are not on disk (``orphan``)."""
    listed = reduce(DataFrame.unionByName, (m.select(file) for m in manifests)).distinct()
    there = disk.select(file).distinct()
    return there.join(listed, file, "left_anti").withColumn("kind", F.lit("untracked")).unionByName(listed.join(there, file, "left_anti").withColumn("kind", F.lit("orphan")))


def redundant(attempts: DataFrame, key: list[str], matched: Column) -> DataFrame:
    """Attempts that did not match, of keys that have a matching one."""
    done = attempts.where(matched).select(*key).distinct()
    return attempts.where(~F.coalesce(matched, F.lit(False))).join(done, key, "left_semi")


def dependencies(environments: DataFrame, key: list[str], text: str) -> DataFrame:
    """``name, version`` of each line ``name=version`` (or ``name==version``); other lines are left out."""
    lines = environments.select(*key, F.explode(F.split(text, "\n")).alias("_l"))
    parts = lines.select(*key, F.regexp_extract("_l", r"^\s*([A-Za-z0-9_.-]+)\s*={1,2}\s*([^=\s]+)", 1).alias("name"), F.regexp_extract("_l", r"^\s*([A-Za-z0-9_.-]+)\s*={1,2}\s*([^=\s]+)", 2).alias("version"))
    return parts.where("name <> ''")


def environment_diff(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Packages of ``key, name, version`` that the new environment lacks, has besides, or has in another version."""
    a, b = old.select(*key, "name", F.col("version").alias("old")), new.select(*key, "name", F.col("version").alias("new"))
    both = a.join(b, [*key, "name"], "full_outer")
    return both.withColumn("change", F.when(F.col("new").isNull(), "missing").when(F.col("old").isNull(), "added").when(F.col("old") != F.col("new"), "changed")).where("change is not null")


# The codes of the archive's metadata standard.
SEX = {"m": "M", "male": "M", "f": "F", "female": "F", "u": "U", "unknown": "U", "o": "O", "other": "O"}
SPECIES = {"rat": "Rattus norvegicus", "mouse": "Mus musculus", "human": "Homo sapiens"}


def standard_subject(df: DataFrame, sex: str, species: str, weight: str, age: str, default_age: str = "P4M/P8M", unit: str = "g") -> DataFrame:
    """Sex as a code (U if not known), species in Latin, weight with its unit, and a default age."""
    coded = lambda c, codes: F.element_at(F.create_map(*(F.lit(x) for kv in codes.items() for x in kv)), F.lower(F.trim(F.col(c))))
    heavy = F.when(F.col(weight).cast("string").rlike(r"^[0-9.]+$"), F.concat(F.col(weight).cast("string"), F.lit(f" {unit}"))).otherwise(F.col(weight).cast("string"))
    return df.withColumns({sex: F.coalesce(coded(sex, SEX), F.lit("U")), species: F.coalesce(coded(species, SPECIES), F.col(species)), weight: heavy, age: F.coalesce(age, F.lit(default_age))})


def look_up_or_add(new: DataFrame, known: DataFrame, names: list[str], id_: str) -> DataFrame:
    """The id of each distinct combination of names (nulls are equal): the known one, or one after the largest, in the order of the names."""
    from .session import numbered

    wanted = new.select(*names).distinct()
    k = known.select(*(F.col(n).alias(f"_{n}") for n in names), id_)
    same = reduce(lambda a, n: a & F.col(n).eqNullSafe(F.col(f"_{n}")), names, F.lit(True))
    met = wanted.join(k, same, "left").drop(*(f"_{n}" for n in names))
    last = known.agg(F.coalesce(F.max(id_), F.lit(-1)).alias("_last"))
    added = numbered(met.where(F.col(id_).isNull()).drop(id_), names, "_k").crossJoin(last)  # one row
    return met.where(F.col(id_).isNotNull()).unionByName(added.select(*names, (F.col("_last") + F.col("_k") + 1).alias(id_)))

"""Restriction along foreign keys.

The catalogue of tables and keys is a small driver-side graph; all data moves as
semi-joins on key columns.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class TableSpec:
    name: str
    key: list[str]
    #: parent name -> {own column: parent column}
    parents: dict[str, dict[str, str]] = field(default_factory=dict)


class Catalogue:
    """Tables by name, with foreign keys between them."""

    def __init__(self, specs: list[TableSpec], read: Callable[[str], DataFrame]):
        self.specs = {s.name: s for s in specs}
        self.read = read

    def children(self, name: str) -> dict[str, dict[str, str]]:
        return {s.name: {v: k for k, v in s.parents[name].items()} for s in self.specs.values() if name in s.parents}

    def steps(self, name: str, direction: str) -> dict[str, dict[str, str]]:
        return self.specs[name].parents if direction == "up" else self.children(name)

    def route(self, start: str, wanted: set[str], direction: str, ban: tuple[str, ...] = ()) -> list[str] | None:
        """The shortest way from ``start`` to a table that has all the wanted columns."""
        queue, came = deque([start]), {start: None}
        while queue:
            at = queue.popleft()
            if wanted <= set(self.read(at).columns):
                path = []
                while at is not None:
                    path.append(at)
                    at = came[at]
                return path[::-1]
            for step in self.steps(at, direction):
                if step not in came and step not in ban:
                    came[step] = at
                    queue.append(step)
        return None

    def order(self) -> list[str]:
        """Parents before children."""
        done: list[str] = []
        while len(done) < len(self.specs):
            done += [n for n, s in self.specs.items() if n not in done and all(p in done for p in s.parents)]
        return done


def bridge(near: DataFrame, far: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Rows of ``near`` whose key is in ``far``; ``keys`` maps near columns to far ones."""
    there = far.select(*[F.col(v).alias(k) for k, v in keys.items()]).distinct()
    return near.join(there, list(keys), "left_semi")


def restrict_by(catalogue: Catalogue, name: str, predicate: str, columns: set[str], direction: str = "up", ban: tuple[str, ...] = ()) -> DataFrame | None:
    """Restricts a table by a predicate on an ancestor (``up``) or a descendant (``down``); None if no table owns the columns."""
    path = catalogue.route(name, columns, direction, ban)
    if path is None:
        return None
    kept = catalogue.read(path[-1]).where(predicate)
    for far, near in zip(path[::-1], path[-2::-1], strict=False):
        kept = bridge(catalogue.read(near), kept, catalogue.steps(near, direction)[far])
    return kept


def cascade(catalogue: Catalogue, leaves: dict[str, DataFrame], direction: str = "up") -> dict[str, DataFrame]:
    """Carries restrictions to all ancestors or descendants; several that reach a table are joined by OR."""
    keys: dict[str, DataFrame] = {n: df.select(*catalogue.specs[n].key) for n, df in leaves.items()}
    exact = dict(leaves)  # rows of a leaf that no other restriction reaches stay as given
    rows_of = lambda n: exact[n] if n in exact else bridge(catalogue.read(n), keys[n], {k: k for k in catalogue.specs[n].key})
    names = catalogue.order()
    for name in names[::-1] if direction == "up" else names:
        if name not in keys:
            continue
        rows = rows_of(name)
        for other, on in catalogue.steps(name, direction).items():
            found = bridge(catalogue.read(other), rows, {v: k for k, v in on.items()}).select(*catalogue.specs[other].key)
            keys[other] = keys[other].unionByName(found).distinct() if other in keys else found
            exact.pop(other, None)
    return {n: rows_of(n) for n in keys}


def merge_graphs(catalogue: Catalogue, a: dict[str, DataFrame], b: dict[str, DataFrame], how: str) -> dict[str, DataFrame]:
    """Union (``or``) or intersection (``and``) of two restricted graphs, table by table."""
    out = {}
    for name in a.keys() | b.keys() if how == "or" else a.keys() & b.keys():
        key = catalogue.specs[name].key
        if how == "and":
            out[name] = a[name].join(b[name].select(*key), key, "left_semi")
        else:
            frames = [g[name].select(*key) for g in (a, b) if name in g]
            both = frames[0].unionByName(frames[-1]).distinct()
            out[name] = catalogue.read(name).join(both, key, "left_semi")
    return out


def counts(graph: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table of a graph."""
    frames = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in sorted(graph.items())]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.where("rows > 0")


def content_hash(df: DataFrame) -> DataFrame:
    """A hash of a table that does not depend on the order of rows: their number, and exclusive or and sum of row hashes."""
    h = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return df.agg(F.count("*").alias("rows"), F.bit_xor(h).alias("parity"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("total"))


def delete_permission(rows: DataFrame, members: DataFrame, user) -> DataFrame:
    """Rows ``session, person`` of experimenters: a session may be deleted if every experimenter shares a team with the user.

    ``members`` holds ``team, person``. A null experimenter, and a session without any, denies.
    """
    mine = members.where(F.col("person") == F.lit(user)).select("team").distinct()
    fellows = members.join(mine, "team", "left_semi").select("person").distinct().withColumn("_ok", F.lit(True))
    return rows.join(fellows, "person", "left").groupBy("session").agg(F.min(F.coalesce("_ok", F.lit(False))).alias("allowed"))


def fellows(members: DataFrame, person: int) -> DataFrame:
    """All who share a team with a person."""
    mine = members.where(F.col("person") == person).select("team").distinct()
    return members.join(mine, "team", "left_semi").select("person").distinct()

"""Exact nearest neighbours by pivots, and how well units are apart by them.

A few rows are taken as pivots, and every row belongs to the cell of its nearest one. A query looks at its own
cell first; the distance of its last neighbour there, or another bound, then tells which other cells can hold a nearer row:
those that the plane between two pivots and the cell's radius do not rule out. Small cells are put together and large
ones cut, on both sides, to slices of bounded size; a query goes once to each slice that it has to see, so copies of its
vector do not grow with the number of cells, and no task holds a cell.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.store import materialise

#: Rows for each pivot, and the most pivots (their distances from each other are known to every task).
PER_PIVOT, PIVOTS = 1000, 2048
#: Cells of a key that bound a query which finds too few rows in its own cell.
BOUNDS = 64
#: Rows, and queries, of a cell that one task compares at a time.
SLICE = 8192
#: Rows of a summary that may be broadcast.
MOST_BROADCAST = 100_000
#: Room for rounding in bounds, as a share of them.
_ROOM = 1e-9


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` and ``b``, a coordinate at a time (exact for whole numbers)."""
    out = np.zeros((len(a), len(b)))
    for x, y in zip(a.T, b.T, strict=True):
        out += (x[:, None] - y) ** 2
    return out


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else df


def _kinds(df: DataFrame, names: list[str]) -> str:
    return "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in names)


def _whole(df: DataFrame, names: list[str], vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    return df.select(*names, v.alias("_v")).where(v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x)))


def _pivots(rows: DataFrame, count: int) -> np.ndarray:
    """Different rows with the smallest hashes; they say how the work is cut, not what is found."""
    found = rows.groupBy(F.xxhash64("_v").alias("_h")).agg(F.any_value("_v").alias("_v")).orderBy("_h").limit(count).collect()
    return np.array([r._v for r in found], float)


def _pieces(batches):
    """Batches in pieces of 1024 rows, as each row is compared with all pivots."""
    for batch in batches:
        for start in range(0, len(batch), 1024):
            yield batch.iloc[start : start + 1024].reset_index(drop=True)


def _in_cells(rows: DataFrame, names: list[str], pivots: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in _pieces(batches):
            far = _squares(np.stack(batch["_v"].tolist()), pivots)
            yield batch.assign(_cell=far.argmin(axis=1), _d=np.sqrt(far.min(axis=1)))

    return rows.mapInPandas(run, f"{_kinds(rows, names)}_v array<double>, _cell long, _d double")


def _candidates(a: np.ndarray, x: np.ndarray, k: int, never: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that may be among the ``k`` nearest, ties with the last included, as places in ``a`` and ``x`` with the squared distance.

    A matrix product tells them, with room for its rounding; their distances are then made a coordinate at a time.
    """
    size_a, size_x = (a * a).sum(axis=1), (x * x).sum(axis=1)
    if np.isfinite(size_a).all() and np.isfinite(size_x).all():
        far = size_a[:, None] + size_x - 2 * (a @ x.T)
        room = 16 * (a.shape[1] + 8) * np.finfo(float).eps * (size_a + size_x.max())
    else:
        far, room = _squares(a, x), np.zeros(len(a))
    far[never] = np.inf
    least = np.partition(far, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1]
    q, r = np.nonzero((far <= (least + room)[:, None]) & np.isfinite(far))
    exact = np.zeros(len(q))
    for c, y in zip(a.T, x.T, strict=True):
        exact += (c[q] - y[r]) ** 2
    return q, r, exact


def _compare(key: list[str], query: str, row: str, k: int, itself: bool, away: bool = False) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """``away``: rows of a query's own cell do not count."""
    columns = [*key, query, "_row", "_q"]

    def run(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(known):
            return pd.DataFrame(columns=columns)
        known = known.sort_values(row, kind="stable")
        ids, x, cells = known[row].to_numpy(), np.stack(known["_v"].tolist()), known["_cell"].to_numpy()
        made = []
        for start in range(0, len(asked), 256):
            some = asked.iloc[start : start + 256]
            never = np.zeros((len(some), len(ids)), bool) if itself else some[query].to_numpy()[:, None] == ids
            if away:
                never |= some["_cell"].to_numpy()[:, None] == cells
            # all that are no further than the k-th, then the first of these by distance and row
            q, r, far = _candidates(np.stack(some["_v"].tolist()), x, k, never)
            order = np.lexsort((r, far, q))
            q, r, far = q[order], r[order], far[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            q, r, far = q[rank < k], r[rank < k], far[rank < k]
            made.append(some[[*key, query]].iloc[q].assign(_row=ids[r], _q=far))
        return pd.concat(made)[columns]

    return run


def _packed(df: DataFrame, key: list[str], size: int) -> DataFrame:
    """Cells of a key in packs of neighbouring ones, of about ``size`` rows each; the rows of a larger cell are dealt over ``_parts`` parts."""
    before = Window.partitionBy(*key).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = df.groupBy(*key, "_cell").agg(F.count("*").alias("_n"))
    ahead = F.coalesce(F.sum("_n").over(before), F.lit(0))
    return materialise(cells.select(*key, "_cell", F.floor(ahead / size).alias("_pack"), F.ceil(F.col("_n") / size).alias("_parts")), "packs")


def _slices(packs: DataFrame, key: list[str]) -> DataFrame:
    """For each key its slices (a part of a pack), each with the cells that have rows in it, as one array."""
    each = packs.select(*key, "_cell", "_pack", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("_part"))
    held = each.groupBy(*key, "_pack", "_part").agg(F.collect_list("_cell").alias("_in"))
    return held.groupBy(*key).agg(F.collect_list(F.struct("_pack", "_part", "_in")).alias("_slices"))


def _dealt(df: DataFrame, packs: DataFrame, key: list[str], name: str) -> DataFrame:
    """Rows with the pack and the part of their cell that they are in."""
    return df.join(_small(packs), [*key, "_cell"]).withColumn("_part", F.pmod(F.xxhash64(name), "_parts")).drop("_parts")


def _visit_slices(more: DataFrame, known: DataFrame, key: list[str], query: str, row: str, k: int, itself: bool, size: int) -> DataFrame:
    """The ``k`` nearest rows outside of its own cell for each query and slice that has a cell of its ``_cells``."""
    packs = _packed(known, key, size)
    slices = _slices(packs, key)
    if not key or packs.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST:
        slices = F.broadcast(slices)
    met = more.join(slices, key) if key else more.crossJoin(slices)
    to = F.transform(F.filter("_slices", lambda s: F.arrays_overlap("_cells", s["_in"])), lambda s: F.struct(s["_pack"].alias("_pack"), s["_part"].alias("_part")))
    # written with each vector once; what is dealt out from here on is read again from it
    away = materialise(met.select(*key, query, "_v", "_cell", "_qpack", "_qpart", to.alias("_to")).where(F.size("_to") > 0), "away")
    each = away.withColumn("_to", F.explode("_to")).select(*key, "_qpack", "_qpart", "_to._pack", "_to._part", "_cell", query, "_v")
    by = [*key, "_qpack", "_qpart", "_pack", "_part"]
    pairs = _small(materialise(each.select(*by).distinct(), "pairs"))
    rows = _dealt(known, packs, key, row).join(pairs, [*key, "_pack", "_part"]).select(*by, "_cell", row, "_v")
    kinds = f"{_kinds(each, [*key, query])}_row {known.schema[row].dataType.simpleString()}, _q double"
    return each.groupBy(*by).cogroup(rows.groupBy(*by)).applyInPandas(_compare(key, query, row, k, itself, away=True), kinds)


def _visit(asked: DataFrame, known: DataFrame, key: list[str], query: str, row: str, k: int, itself: bool, size: int) -> DataFrame:
    """The ``k`` nearest rows for each query and slice of a cell that it visits."""
    cell = [*key, "_cell"]
    slices = lambda df, name: df.groupBy(*cell).agg(F.ceil(F.count("*") / size).alias(name))
    cut = _small(materialise(slices(asked, "_qs").join(slices(known, "_rs"), cell), "cells"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    asked = asked.join(cut, cell).select(*cell, query, "_v", F.pmod(F.xxhash64(query), "_qs").alias("_a"), each(F.col("_rs")).alias("_b"))
    known = known.join(cut, cell).select(*cell, row, "_v", F.pmod(F.xxhash64(row), "_rs").alias("_b"), each(F.col("_qs")).alias("_a"))
    by = [*cell, "_a", "_b"]
    kinds = f"{_kinds(asked, [*key, query])}_row {known.schema[row].dataType.simpleString()}, _q double"
    return asked.groupBy(*by).cogroup(known.groupBy(*by)).applyInPandas(_compare(key, query, row, k, itself), kinds)


def nearest(queries: DataFrame, rows: DataFrame, key: list[str], query: str, row: str, vector: str, k: int, itself: bool = False, pivots: int | None = None, size: int = SLICE) -> DataFrame:
    """The ``k`` rows of the query's key nearest to it, exactly, as ``key, query, row, rank, square`` (the squared distance).

    ``vector`` is an array of as many numbers in every row. Ties go to the smaller ``row``. Unless ``itself``, the row whose
    id is the query's does not count. ``query`` and ``row`` name their rows within a key. A query with fewer than
    ``k`` rows in its key gets these. Null keys, and null vectors or ones with a missing number, are
    left out on both sides. Where distances are all alike (many dimensions without structure) few cells are ruled out,
    and work grows with queries times rows; results do not depend on ``pivots`` and ``size``.
    """
    known = _whole(rows, [*key, row], vector)
    at = _pivots(known, pivots or max(1, min(PIVOTS, known.count() // PER_PIVOT)))
    kind = known.schema[row].dataType.simpleString()
    if not len(at):
        empty = queries.select(*key, query).limit(0)
        return empty.select(*key, query, F.lit(None).cast(kind).alias(row), F.lit(0).alias("rank"), F.lit(0.0).alias("square"))
    known = materialise(_in_cells(known, [*key, row], at), "known")
    asked = materialise(_in_cells(_whole(queries, [*key, query], vector), [*key, query], at), "asked")
    radius = np.full(len(at), -1.0)
    for r in known.groupBy("_cell").agg(F.max("_d").alias("d")).collect():  # one for each pivot
        radius[r._cell] = r.d
    best = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy(*key, query).orderBy("_q", "_row"))).where(F.col("rank") <= k)
    home = materialise(best(_visit(asked, known, key, query, row, k, itself, size)), "home")

    # a key's pivot with k rows (and one for the query) in its cell bounds every query's distance
    need = k if itself else k + 1
    order = F.row_number().over(Window.partitionBy(*key, "_cell").orderBy("_d"))
    full = known.select(*key, "_cell", "_d").withColumn("_n", order).where(F.col("_n") <= need).where(F.col("_n") == need)
    full = full.groupBy(*key).agg(F.slice(F.array_sort(F.collect_list(F.struct("_cell", "_d"))), 1, BOUNDS).alias("_full"))
    last = home.where(F.col("rank") == k).select(*key, query, F.sqrt("_q").alias("_last"))
    bound = asked.join(last, [*key, query], "left")
    bound = bound.join(_small(full), key, "left") if key else bound.crossJoin(F.broadcast(full.select(F.coalesce("_full", F.array()).alias("_full"))))
    bound = bound.withColumn("_full", F.when(F.col("_last").isNull(), F.col("_full")))
    gap = np.sqrt(_squares(at, at))

    def others(batches):
        for batch in _pieces(batches):
            far = np.sqrt(_squares(np.stack(batch["_v"].tolist()), at))
            most = batch["_last"].fillna(np.inf).to_numpy(float)
            for i, cells in enumerate(batch["_full"]):
                for c in cells if cells is not None and not np.isfinite(most[i]) else []:
                    most[i] = min(most[i], far[i, c["_cell"]] + c["_d"])
            own = batch["_cell"].to_numpy()
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = (far**2 - far[np.arange(len(own)), own][:, None] ** 2) / (2 * gap[own])
            room = (most * (1 + _ROOM) + _ROOM * (1 + far.max(axis=1)))[:, None]
            go = (far - radius <= room) & (np.nan_to_num(plane, nan=0.0) <= room) & (radius >= 0)
            go[np.arange(len(own)), own] = False
            yield batch[kept].assign(_cells=[np.flatnonzero(g) for g in go])

    bound = _dealt(bound, _packed(asked, key, size), key, query).withColumnsRenamed({"_pack": "_qpack", "_part": "_qpart"})
    kept = [*key, query, "_v", "_cell", "_qpack", "_qpart"]
    more = bound.mapInPandas(others, f"{_kinds(bound, [*key, query])}_v array<double>, _cell long, _qpack long, _qpart long, _cells array<long>")
    found = home.drop("rank").unionByName(_visit_slices(more, known, key, query, row, k, itself, size))
    return best(found).select(*key, query, F.col("_row").alias(row), "rank", F.col("_q").alias("square"))


def pair_isolation(spikes: DataFrame, key: list[str], unit: str, spike: str, vector: str, k: int, pairs: DataFrame | None = None, pivots: int | None = None, size: int = SLICE) -> DataFrame:
    """For pairs of units the share of own spikes among the ``k`` nearest of both, as ``key, a, b, share`` with ``a < b``.

    Each spike of either unit is asked for its neighbours among the spikes of both but itself; the share is averaged over the spikes of each unit,
    then over the two units, so that a large unit does not outweigh a small one. All spikes count; none is sampled.
    ``pairs`` (``key, a, b``) says which units meet; without it all of a key do. ``spike`` names a spike within
    its key. Spikes that have no neighbour at all are left out.
    """
    rows = spikes.select(*key, unit, spike, vector).where(F.col(unit).isNotNull())
    # written, as it feeds both the units and the search
    if pairs is None:
        units = materialise(rows.select(*key, unit).distinct(), "units")
        left, right = (units.select(*key, F.col(unit).alias(c)) for c in "ab")
        pairs = (left.join(right, key) if key else left.crossJoin(right)).where("a < b")
    pairs = materialise(pairs.select(*key, "a", "b").distinct(), "pairs")
    ways = pairs.select(*key, F.explode(F.array(F.struct(F.col("a").alias("_own"), F.col("b").alias("_in")), F.struct(F.col("b").alias("_own"), F.col("a").alias("_in")))).alias("_w")).select(*key, "_w.*")
    ways = ways.unionByName(ways.select(*key, "_own", F.col("_own").alias("_in"))).distinct()
    asked = rows.withColumnRenamed(unit, "_own").join(_small(ways), [*key, "_own"]).withColumnRenamed(spike, "_s")
    found = nearest(asked.select(*key, F.col("_in").alias(unit), "_s", vector), rows, [*key, unit], "_s", spike, vector, k, pivots=pivots, size=size)
    lists = found.groupBy(*key, "_s", unit).agg(F.collect_list(F.struct("square", spike)).alias("_l"))
    # the list of the spike's own unit, which may be empty, beside each of the others
    mine = asked.select(*key, "_s", "_own", F.col("_in").alias(unit))
    mine = materialise(mine.join(lists, [*key, "_s", unit], "left").withColumn("_l", F.coalesce("_l", F.array())), "lists")
    own = mine.where(F.col(unit) == F.col("_own")).select(*key, "_s", F.col("_l").alias("_m"))
    both = mine.where(F.col(unit) != F.col("_own")).join(own, [*key, "_s"])
    tagged = lambda c, is_own: F.transform(c, lambda x: F.struct(x["square"], x[spike], F.lit(is_own).alias("own")))
    top = F.slice(F.array_sort(F.concat(tagged("_m", True), tagged("_l", False))), 1, k)
    shares = both.withColumn("_t", top).where(F.size("_t") > 0).withColumn("_share", F.size(F.filter("_t", lambda x: x["own"])) / F.size("_t"))
    one = shares.groupBy(*key, "_own", F.least("_own", unit).alias("a"), F.greatest("_own", unit).alias("b")).agg(F.avg("_share").alias("_share"))
    return one.groupBy(*key, "a", "b").agg(F.avg("_share").alias("share"))


def isolation(spikes: DataFrame, key: list[str], unit: str, spike: str, vector: str, k: int, noise=None, pivots: int | None = None, size: int = SLICE) -> DataFrame:
    """Each unit's share of own neighbours beside the unit that it mixes with most, as ``key, unit, isolation``.

    With ``noise``, the name of a unit of random snippets, ``noise_overlap`` is one less the share beside that one, and
    it is no unit itself. A unit alone in its key has null.
    """
    found = pair_isolation(spikes, key, unit, spike, vector, k, pivots=pivots, size=size)
    ends = found.select(*key, F.explode(F.array(F.struct(F.col("a").alias(unit), F.col("b").alias("_o")), F.struct(F.col("b").alias(unit), F.col("a").alias("_o")))).alias("_e"), "share").select(*key, "_e.*", "share")
    units = spikes.where(F.col(unit).isNotNull()).select(*key, unit).distinct()
    if noise is None:
        return units.join(ends.groupBy(*key, unit).agg(F.min("share").alias("isolation")), [*key, unit], "left")
    beside = F.col("_o") == F.lit(noise)
    made = ends.groupBy(*key, unit).agg(F.min(F.when(~beside, F.col("share"))).alias("isolation"), (1 - F.min(F.when(beside, F.col("share")))).alias("noise_overlap"))
    return units.where(F.col(unit) != F.lit(noise)).join(made, [*key, unit], "left")

"""Hidden Markov chains over long series: smoothing and the most probable path, block by block.

What a stretch of a series does to any state before it is one square matrix, and matrices of neighbouring
stretches multiply. So every block makes its own, a scan over the blocks' matrices (in groups of groups where
they are many) tells with what each block is entered, and then each block is done alone.
Probabilities use sums and products, best paths the greatest and sums of logarithms. No task holds a series.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blocks import nearest_known
from ..functions.rangejoin import points_in
from ..functions.store import materialise

BLOCK = 4096
#: Blocks, or groups of them, that one task goes through in a row.
FANOUT = 64
#: Nodes of a track, whose distances are known to every task.
MOST_NODES = 1000
_NEVER = -np.inf


def _unit(x: np.ndarray) -> np.ndarray:
    total = x.sum()
    return x / total if total > 0 else np.full(x.shape, 1 / x.size)


def _best(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product with sums for products and the greatest for sums."""
    return np.stack([(row[:, None] + b).max(axis=0) for row in a])


def _logs(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(x)


class _Product:
    """A product of steps: each line sums to one and has its logarithm in the last column, so that none gets lost beside likelier ones."""

    @staticmethod
    def of(lines: np.ndarray, logs: np.ndarray) -> np.ndarray:
        total = lines.sum(axis=1)
        lines = np.where(total[:, None] > 0, lines / np.where(total > 0, total, 1)[:, None], 1 / len(lines))
        return np.column_stack([lines, logs + _logs(total)])

    @staticmethod
    def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        weight = _logs(a[:, :-1]) + b[:, -1]
        most = weight.max(axis=1)
        safe = np.where(most > _NEVER, most, 0.0)
        return _Product.of(np.exp(weight - safe[:, None]) @ b[:, :-1], a[:, -1] + safe)

    @staticmethod
    def ahead(v: np.ndarray, m: np.ndarray) -> np.ndarray:
        weight = _logs(v) + m[:, -1]
        return _unit((np.exp(weight - weight.max()) if weight.max() > _NEVER else v) @ m[:, :-1])

    @staticmethod
    def behind(u: np.ndarray, m: np.ndarray) -> np.ndarray:
        weight = _logs(m[:, :-1] @ u) + m[:, -1]
        return _unit(np.exp(weight - weight.max()) if weight.max() > _NEVER else np.ones(len(u)))


class _Scan:
    """How items of a kind join, and how what is carried goes through one."""

    def __init__(self, states: int, join: Callable, step: Callable, kind: str, carried: str, backward: bool = False):
        self.states, self.join, self.step, self.kind, self.carried, self.backward = states, join, step, kind, carried, backward

    def item(self, raw: bytes) -> np.ndarray:
        x = np.frombuffer(raw, self.kind)
        return x.reshape(self.states, -1) if len(x) > self.states else x

    def walk(self, rows: pd.DataFrame, entry: bytes) -> pd.DataFrame:
        rows = rows.sort_values("_block", ascending=not self.backward)
        now, out = np.frombuffer(entry, self.carried), []
        for raw in rows["_item"]:
            out.append(now.tobytes())
            now = self.step(now, self.item(raw)).astype(self.carried)
        return rows.assign(_entry=out)

    def fold(self, rows: pd.DataFrame) -> bytes:
        items = [self.item(x) for x in rows.sort_values("_block")["_item"]]
        now = items[0]
        for x in items[1:]:
            now = self.join(now, x)
        return now.astype(self.kind).tobytes()


def _kinds(df: DataFrame, names: list[str]) -> str:
    return "".join(f"{n} {df.schema[n].dataType.simpleString()}, " for n in names)


def _entries(items: DataFrame, key: list[str], scan: _Scan, fanout: int) -> DataFrame:
    """With what each block is entered, as ``key, _block, _entry``, from ``key, _block, _item, _start``."""
    schema, names = f"{_kinds(items, key)}_block long, _entry binary", [*key, "_block", "_entry"]
    most = items.groupBy(*key).count().agg(F.max("count")).first()[0] or 0
    if most <= fanout:
        return items.groupBy(*key).applyInPandas(lambda rows: scan.walk(rows, rows["_start"].iloc[0])[names], schema)
    items = items.withColumn("_up", F.floor(F.col("_block") / fanout))

    def folded(rows: pd.DataFrame) -> pd.DataFrame:
        one = rows.iloc[:1]
        return one.assign(_block=one["_up"], _item=[scan.fold(rows)])[[*key, "_block", "_item", "_start"]]

    def down(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        return scan.walk(rows, above["_entry"].iloc[0])[names]

    above = materialise(items.groupBy(*key, "_up").applyInPandas(folded, f"{_kinds(items, key)}_block long, _item binary, _start binary"), "scan")
    above = _entries(above, key, scan, fanout).withColumnRenamed("_block", "_up")
    return items.groupBy(*key, "_up").cogroup(above.groupBy(*key, "_up")).applyInPandas(down, schema)


def _dealt(df: DataFrame, key: list[str], idx: str, columns: list[Column], block: int) -> DataFrame:
    """A written table with each row's block and whether it is the first of its key."""
    first = df.groupBy(*key).agg(F.min(idx).alias("_least"))
    on = F.lit(True)
    for k in key:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}_"))
    rows = df.select(*key, F.col(idx).alias("_i"), *columns, F.floor(F.col(idx) / block).alias("_block"))
    return materialise(rows.join(first.withColumnsRenamed({k: f"_{k}_" for k in key}), on).select(*rows.columns, (F.col("_i") == F.col("_least")).alias("_first")), "chain")


def _by_block(rows: DataFrame, key: list[str], scan_item: Callable[[pd.DataFrame], bytes], start: bytes) -> DataFrame:
    def run(part: pd.DataFrame) -> pd.DataFrame:
        return part.iloc[:1].assign(_item=[scan_item(part.sort_values("_i"))], _start=[start])[[*key, "_block", "_item", "_start"]]

    return materialise(rows.groupBy(*key, "_block").applyInPandas(run, f"{_kinds(rows, key)}_block long, _item binary, _start binary"), "items")


def smooth(df: DataFrame, key: list[str], idx: str, log_likelihood: str, transition: np.ndarray, initial: np.ndarray | None = None, block: int = BLOCK, fanout: int = FANOUT) -> DataFrame:
    """The probability of each state at each row, given the rows up to it and given all rows of its key.

    ``log_likelihood`` is an array with a number for each state; rows of a key follow one another in the order of ``idx``,
    which is distinct within a key and may have gaps. ``transition[i, j]`` is the chance to go from state i to j, ``initial`` the
    chance of each at the first row (equal unless given). Returns ``key, idx, causal, acausal`` with arrays. Where no state is
    possible, all are equally so. A null array tells nothing.
    """
    n = len(transition)
    moves = np.asarray(transition, float)
    begin = np.full(n, 1 / n) if initial is None else np.asarray(initial, float)

    def likelihood(x) -> np.ndarray:
        if x is None:
            return np.ones(n)
        x = np.asarray(x, float)
        return np.exp(x - x.max()) if x.max() > _NEVER else np.zeros(n)

    def product(part: pd.DataFrame) -> bytes:
        m = np.column_stack([np.eye(n), np.zeros(n)])
        for x, first in zip(part["_x"], part["_first"], strict=True):
            lines = m[:, :-1]
            m = _Product.of((lines if first else lines @ moves) * likelihood(x), m[:, -1])
        return m.tobytes()

    ahead = _Scan(n, _Product.join, _Product.ahead, "f8", "f8")
    behind = _Scan(n, _Product.join, _Product.behind, "f8", "f8", backward=True)

    def finish(part: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_i")
        like, first = [likelihood(x) for x in part["_x"]], part["_first"].to_numpy()
        a, causal = np.frombuffer(entries["_entry"].iloc[0]), []
        for x, f in zip(like, first, strict=True):
            a = _unit((a if f else a @ moves) * x)
            causal.append(a)
        b, acausal = np.frombuffer(entries["_after"].iloc[0]), []
        for a, x in zip(causal[::-1], like[::-1], strict=True):
            acausal.append(_unit(a * b))
            b = _unit(moves @ (x * b))
        return part.assign(causal=[x.tolist() for x in causal], acausal=[x.tolist() for x in acausal[::-1]])[[*key, "_i", "causal", "acausal"]]

    rows = _dealt(df, key, idx, [F.col(log_likelihood).alias("_x")], block)
    items = _by_block(rows, key, product, begin.tobytes())
    entered = _entries(items, key, ahead, fanout)
    left = _entries(items.withColumn("_start", F.lit(bytearray(np.ones(n).tobytes()))), key, behind, fanout).withColumnRenamed("_entry", "_after")
    both = materialise(entered.join(left, [*key, "_block"]) if key else entered.join(left, "_block"), "entries")
    done = rows.groupBy(*key, "_block").cogroup(both.groupBy(*key, "_block")).applyInPandas(finish, f"{_kinds(rows, key)}_i {rows.schema['_i'].dataType.simpleString()}, causal array<double>, acausal array<double>")
    return done.withColumnRenamed("_i", idx)


def decode_intervals(df: DataFrame, intervals: DataFrame, key: list[str], idx: str, log_likelihood: str, transition: np.ndarray, width: int, whole: bool = False, initial: np.ndarray | None = None, block: int = BLOCK, fanout: int = FANOUT) -> DataFrame:
    """The probability of each state at the rows within ``intervals`` (``key, start, stop``, both ends in), as ``smooth`` gives it, with the interval.

    Each interval is a sequence of its own. With ``whole`` a key's rows are one sequence, in which those outside
    of all intervals tell nothing about the state; only rows inside come back. A row in several intervals comes
    back for each. Intervals without rows have none; repeated ones count once. ``width`` is that of time buckets for the join.
    """
    own = intervals.select(*key, "start", "stop").where(F.col("start") <= F.col("stop")).distinct()
    rows = df.select(*key, idx, log_likelihood)
    if not whole:
        inside = points_in(rows, own, key, idx, width).select(*key, "start", "stop", idx, log_likelihood)
        return smooth(inside, [*key, "start", "stop"], idx, log_likelihood, transition, initial, block, fanout)
    met = points_in(rows.select(*key, idx), own, key, idx, width, how="left_semi").select(*key, idx).withColumn("_in", F.lit(True))
    seen = rows.join(met, [*key, idx], "left").withColumn(log_likelihood, F.when(F.col("_in"), F.col(log_likelihood))).drop("_in")
    made = smooth(seen, key, idx, log_likelihood, transition, initial, block, fanout)
    return points_in(made, own, key, idx, width).select(*key, "start", "stop", idx, "causal", "acausal")


def best_path(df: DataFrame, key: list[str], idx: str, columns: list[str], states: int, moves: Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray]], initial: np.ndarray | None = None, block: int = BLOCK, fanout: int = FANOUT) -> DataFrame:
    """The most probable state of each row, as ``key, idx, state``.

    ``moves`` gets some rows with ``columns`` in order and returns two arrays of logarithms: for each row the chance to come
    from state i to j (one array for all rows will do), and the chance of what was seen at each row in each state.
    Of equally good ways the one over the smaller states, from the end, is taken (as far as sums in another order are equal).
    """
    begin = np.zeros(states) if initial is None else np.log(np.asarray(initial, float))

    def steps(part: pd.DataFrame) -> np.ndarray:
        chance, seen = moves(part)
        stay = np.where(np.eye(states, dtype=bool), 0.0, _NEVER)
        first = part["_first"].to_numpy()[:, None, None]  # nothing goes before a first row
        return np.where(first, stay, chance) + np.asarray(seen, float)[:, None, :]

    def product(part: pd.DataFrame) -> bytes:
        m = np.where(np.eye(states, dtype=bool), 0.0, _NEVER)
        for x in steps(part):
            m = _best(m, x)
        return m.tobytes()

    ahead = _Scan(states, _best, lambda v, m: (v[:, None] + m).max(axis=0), "f8", "f8")
    #: exits are carried back through the blocks' tables from exit to entry
    back = _Scan(states, lambda a, b: a[b], lambda v, f: f[v], "i8", "i8", backward=True)

    def pointers(part: pd.DataFrame, entry: bytes) -> tuple[np.ndarray, list[np.ndarray]]:
        v, out = np.frombuffer(entry), []
        for x in steps(part):
            total = v[:, None] + x
            out.append(total.argmax(axis=0))
            v = total.max(axis=0)
        return v, out

    def tables(part: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        end, steps_back = pointers(part.sort_values("_i"), entries["_entry"].iloc[0])
        table = np.arange(states)
        for p in reversed(steps_back):
            table = p[table]
        return part.iloc[:1].assign(_item=[table.astype("i8").tobytes()], _start=[np.array([end.argmax()], "i8").tobytes()])[[*key, "_block", "_item", "_start"]]

    def finish(part: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_i")
        _, steps_back = pointers(part, entries["_entry"].iloc[0])
        now, out = int(np.frombuffer(entries["_exit"].iloc[0], "i8")[0]), []
        for p in reversed(steps_back):
            out.append(now)
            now = int(p[now])
        return part.assign(state=out[::-1])[[*key, "_i", "state"]]

    def whole(part: pd.DataFrame) -> pd.DataFrame:
        """Series of one block each, side by side: a step of all of them at a time."""
        part = part.sort_values([*key, "_i"]).reset_index(drop=True)
        starts = np.flatnonzero(part["_first"].to_numpy(bool))
        long, out = np.diff(np.append(starts, len(part))), np.zeros(len(part), np.int64)
        most = max(BLOCK, (1 << 22) // states**2)  # rows whose steps are there at once; a series has no more than a block
        for some in np.split(np.arange(len(starts)), np.flatnonzero(np.diff((np.cumsum(long) - 1) // most)) + 1):
            some = some[np.argsort(-long[some], kind="stable")]
            low, high = starts[some].min(), (starts[some] + long[some]).max()
            step = steps(part.iloc[low:high])
            back = np.zeros((high - low, states), np.int64)
            v, now = np.tile(begin, (len(some), 1)), np.zeros(len(some), np.int64)
            for n in range(long[some[0]]):
                going = int((long[some] > n).sum())
                at = starts[some[:going]] - low + n
                total = v[:going, :, None] + step[at]
                back[at], v[:going] = total.argmax(axis=1), total.max(axis=1)
            now[:] = v.argmax(axis=1)
            for n in range(long[some[0]] - 1, -1, -1):
                going = int((long[some] > n).sum())
                at = starts[some[:going]] - low + n
                out[at + low] = now[:going]
                now[:going] = back[at, now[:going]]
        return part.assign(state=out)[[*key, "_i", "state"]]

    rows = _dealt(df, key, idx, [F.col(c) for c in columns], block)
    kinds = f"{_kinds(rows, key)}_i {rows.schema['_i'].dataType.simpleString()}, state long"
    short = None
    if key:
        ends = rows.groupBy(*key).agg(F.min("_block").alias("_low"), F.max("_block").alias("_high")).where("_low = _high").select(*key)
        ends = materialise(ends, "short")
        parts = -(-rows.count() // (16 * BLOCK))
        short = rows.join(ends, key, "left_semi").withColumn("_part", F.pmod(F.xxhash64(*key), F.lit(parts))).groupBy("_part").applyInPandas(whole, kinds) if parts else None
        rows = rows.join(ends, key, "left_anti")
        if short is not None and rows.isEmpty():
            return short.withColumnRenamed("_i", idx)
    entered = materialise(_entries(_by_block(rows, key, product, begin.tobytes()), key, ahead, fanout), "entries")
    cut = rows.groupBy(*key, "_block").cogroup(entered.groupBy(*key, "_block"))
    found = materialise(cut.applyInPandas(tables, f"{_kinds(rows, key)}_block long, _item binary, _start binary"), "tables")
    # the last block's end is where a key's way ends; blocks before it get theirs from there
    last = found.groupBy(*key).agg(F.max_by("_start", "_block").alias("_start")) if key else found.agg(F.max_by("_start", "_block").alias("_start"))
    ended = found.drop("_start").join(last, key) if key else found.drop("_start").crossJoin(last)  # one row
    exits = _entries(materialise(ended, "ended"), key, back, fanout).withColumnRenamed("_entry", "_exit")
    both = materialise(entered.join(exits, [*key, "_block"]), "exits")
    done = rows.groupBy(*key, "_block").cogroup(both.groupBy(*key, "_block")).applyInPandas(finish, kinds)
    done = done if short is None else done.unionByName(short)
    return done.withColumnRenamed("_i", idx)


class Track:
    """A track's edges, and the length of the shortest way between any two of its nodes (those with equal places are one)."""

    def __init__(self, edges: list[tuple[float, float, float, float]]):
        self.ends = np.array(edges, float).reshape(-1, 2, 2)
        nodes, at = np.unique(self.ends.reshape(-1, 2), axis=0, return_inverse=True)
        if len(nodes) > MOST_NODES:
            raise ValueError(f"a track has at most {MOST_NODES} nodes")
        self.at = at.reshape(-1, 2)
        self.length = np.hypot(*(self.ends[:, 1] - self.ends[:, 0]).T)
        far = np.full((len(nodes), len(nodes)), np.inf)
        np.fill_diagonal(far, 0)
        for (u, v), d in zip(self.at, self.length, strict=True):
            far[u, v] = far[v, u] = min(far[u, v], d)
        for k in range(len(nodes)):
            far = np.minimum(far, far[:, k, None] + far[k])
        self.far = far

    def project(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each point and edge the nearest place on the edge, as a share of its length, and the distance to it."""
        start, way = self.ends[:, 0], self.ends[:, 1] - self.ends[:, 0]
        p = np.stack([x, y], axis=1)[:, None, :] - start
        share = np.clip((p * way).sum(axis=2) / np.maximum((way**2).sum(axis=1), 1e-300), 0, 1)
        return share, np.hypot(*np.moveaxis(p - share[:, :, None] * way, 2, 0))

    def routes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The way along the track from places ``a`` to places ``b`` (shares for each edge), for every pair of edges."""
        to = lambda share: np.stack([share * self.length, (1 - share) * self.length], axis=2)
        da, db, n = to(a), to(b), len(self.length)
        best = np.full((len(a), n, n), np.inf)
        for u in (0, 1):
            for v in (0, 1):
                best = np.minimum(best, da[:, :, None, u] + self.far[self.at[:, u][:, None], self.at[:, v]] + db[:, None, :, v])
        same = np.arange(n)
        best[:, same, same] = np.abs(a - b) * self.length
        return best


def edges_by_chain(df: DataFrame, edges: list[tuple[float, float, float, float]], key: list[str], idx: str, x: str, y: str, sensor: float = 5.0, scaling: float = 1.0, bias: float = 0.5, block: int = BLOCK, fanout: int = FANOUT) -> DataFrame:
    """The edge of the track that each position is on, from the whole series, as ``key, idx, edge`` (the number of the edge).

    A position is off its edge by a normal error of ``sensor``. Going from an edge to another is the likelier the closer the way along
    the track between the projections is to the straight distance of the positions (exponential with ``scaling``); the chances of an
    edge sum to one, ``bias`` is added to that of staying, and they sum to one again. Where no edge can be reached all are alike.
    Rows without a position stay where they fit best.
    """
    track = Track(edges)

    def moves(part: pd.DataFrame) -> np.ndarray:
        now, before = part[["_x", "_y"]].to_numpy(float), part[["_px", "_py"]].to_numpy(float)
        n = len(track.length)
        here, off = track.project(*now.T)
        seen = np.where(np.isnan(off), 0.0, -0.5 * (off / sensor) ** 2)
        there, _ = track.project(*before.T)
        straight = np.hypot(*(now - before).T)
        chance = np.exp(-np.abs(track.routes(there, here) - straight[:, None, None]) / scaling)
        chance = np.where(np.isnan(chance), 1.0, chance)
        for extra in (0.0, bias):
            chance = chance + extra * np.eye(n)
            total = chance.sum(axis=2, keepdims=True)
            chance = np.where(total > 0, chance / np.where(total > 0, total, 1), 1 / n)
        with np.errstate(divide="ignore"):
            return np.log(chance), seen

    rows = df.select(*key, idx, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    rows = nearest_known(rows, key, idx, F.struct("_x", "_y"), "_before", "_after", own=False)
    rows = rows.withColumn("_px", F.col("_before._x")).withColumn("_py", F.col("_before._y"))
    return best_path(rows, key, idx, ["_x", "_y", "_px", "_py"], len(track.length), moves, block=block, fanout=fanout).withColumnRenamed("state", "edge")


def ahead_on_track(df: DataFrame, edges: list[tuple[float, float, float, float]], x: str, y: str, decoded_x: str, decoded_y: str, heading: str) -> DataFrame:
    """Adds ``ahead``: how far along the track the decoded place is from the actual one, row by row, so nothing is shuffled.

    Both places are taken to the nearest edge (ties: the first), and the distance is the shortest way between them. The animal
    faces the end of its edge that its ``heading`` (radians) points to, the second where it points across. The distance is
    negative (behind) if the shortest way from the end faced to the decoded place leads back over the animal. A missing
    place or heading gives null. ``edges`` are known to every task; a track of more than ``MOST_NODES`` nodes is an error.
    """
    track = Track(edges)
    way = track.ends[:, 1] - track.ends[:, 0]

    def to_ends(share: np.ndarray, edge: np.ndarray) -> np.ndarray:
        return np.stack([share, 1 - share], axis=1) * track.length[edge][:, None]

    def told(part: pd.DataFrame) -> np.ndarray:
        at, to, look = part[["_x", "_y"]].to_numpy(float), part[["_dx", "_dy"]].to_numpy(float), part["_h"].to_numpy(float)
        out, there = np.full(len(part), np.nan), ~np.isnan(np.column_stack([at, to, look])).any(axis=1)
        line = np.arange(there.sum())
        (share, off), (goal, goal_off) = track.project(*at[there].T), track.project(*to[there].T)
        edge, target = off.argmin(axis=1), goal_off.argmin(axis=1)
        share, goal = share[line, edge], goal[line, target]
        here, end = to_ends(share, edge), to_ends(goal, target)
        # the shortest way from each end of the animal's edge
        from_end = (track.far[track.at[edge][:, :, None], track.at[target][:, None, :]] + end[:, None, :]).min(axis=2)
        faced = (np.cos(look[there]) * way[edge, 0] + np.sin(look[there]) * way[edge, 1] >= -1e-9 * track.length[edge]).astype(int)
        leaving, same = here + from_end, edge == target
        direct, side = np.abs(goal - share) * track.length[edge], (goal > share).astype(int)
        on = np.flatnonzero(same)
        leaving[on, side[on]] = np.minimum(leaving[on, side[on]], direct[on])
        far = leaving.min(axis=1)
        over = here[line, faced] + leaving[line, 1 - faced]
        behind = over <= from_end[line, faced] + 1e-9 * (1 + over)
        out[there] = np.where(behind, -far, far) + 0.0
        return out

    def run(batches):
        for batch in batches:
            yield batch.drop(columns=["_x", "_y", "_dx", "_dy", "_h"]).assign(ahead=told(batch))

    places = {"_x": x, "_y": y, "_dx": decoded_x, "_dy": decoded_y, "_h": heading}
    rows = df.withColumns({c: F.col(f"`{of}`").cast("double") for c, of in places.items()})
    made = rows.mapInPandas(run, f"{_kinds(df, df.columns)}ahead double")
    return made.withColumn("ahead", F.when(~F.isnan("ahead"), F.col("ahead")))

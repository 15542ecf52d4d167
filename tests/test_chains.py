"""Smoothing and best paths by blocks against the plain recursions over the whole series."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import chains as C

RNG = np.random.default_rng(4)
N = 5
MOVES = RNG.random((N, N)) ** 3
MOVES /= MOVES.sum(axis=1, keepdims=True)
BLOCKS = [(1, 4), (7, 3), (1000, 64)]


@pytest.fixture(scope="module")
def seen():
    """Two series of one key each, one with gaps in its numbers."""
    return {"a": (list(range(-3, 57)), RNG.normal(0, 4, (60, N))), "b": ([0, 5, 9, 10], RNG.normal(0, 4, (4, N)))}


def recursion(like):
    a, fore = None, []
    for x in np.exp(like):
        a = (np.full(N, 1 / N) if a is None else a @ MOVES) * x
        a = a / a.sum()
        fore.append(a)
    b, both = np.ones(N), []
    for a, x in zip(fore[::-1], np.exp(like)[::-1], strict=True):
        both.append(a * b / (a * b).sum())
        b = MOVES @ (x * b)
        b = b / b.sum()
    return fore, both[::-1]


def viterbi(steps, first):
    v, back = first, []
    for m in steps:
        total = v[:, None] + m
        back.append(total.argmax(axis=0))
        v = total.max(axis=0)
    path = [int(v.argmax())]
    for p in back[::-1]:
        path.append(int(p[path[-1]]))
    return path[::-1]


@pytest.mark.parametrize(("block", "fanout"), BLOCKS)
def test_smoothing_equals_the_recursion(spark, seen, block, fanout):
    rows = [(k, i, x.tolist()) for k, (at, like) in seen.items() for i, x in zip(at, like, strict=True)]
    df = spark.createDataFrame(rows, "k string, i long, x array<double>").repartition(3)
    got = {(r.k, r.i): r for r in C.smooth(df, ["k"], "i", "x", MOVES, block=block, fanout=fanout).collect()}
    for k, (at, like) in seen.items():
        fore, both = recursion(like)
        for i, a, b in zip(at, fore, both, strict=True):
            assert np.allclose(got[k, i].causal, a, atol=1e-9) and np.allclose(got[k, i].acausal, b, atol=1e-9)


def test_smoothing_of_nothing_seen(spark):
    df = spark.createDataFrame([("a", 0, None), ("a", 1, [0.0, float("-inf")]), (None, 0, [float("-inf")] * 2)], "k string, i long, x array<double>")
    got = {(r.k, r.i): r.acausal for r in C.smooth(df.where("k is not null"), ["k"], "i", "x", np.eye(2)).collect()}
    assert got == {("a", 0): [1.0, 0.0], ("a", 1): [1.0, 0.0]}
    assert C.smooth(df.where("false"), ["k"], "i", "x", np.eye(2)).collect() == []


@pytest.mark.parametrize(("block", "fanout"), BLOCKS)
def test_best_path_equals_viterbi(spark, seen, block, fanout):
    rows = [(k, i, x.tolist()) for k, (at, like) in seen.items() for i, x in zip(at, like, strict=True)]
    df = spark.createDataFrame(rows, "k string, i long, x array<double>")
    moves = lambda part: (np.log(MOVES), np.stack(part["x"].tolist()))
    got = {(r.k, r.i): r.state for r in C.best_path(df, ["k"], "i", ["x"], N, moves, block=block, fanout=fanout).collect()}
    for k, (at, like) in seen.items():
        assert [got[k, i] for i in at] == viterbi([np.log(MOVES) + x for x in like[1:]], like[0])


def test_ways_along_a_track():
    track = C.Track([(0, 0, 10, 0), (10, 0, 10, 10), (0, 20, 10, 10)])
    share, off = track.project(np.array([4.0]), np.array([3.0]))
    assert share[0, :2].tolist() == [0.4, 0.3] and off[0, :2].tolist() == [3.0, 6.0]
    ways = track.routes(np.array([[0.5, 0.2, 0.0]]), np.array([[0.1, 1.0, 1.0]]))[0]
    assert np.allclose(ways, [[4, 15, 15], [11, 8, 8], [10 + 200**0.5 + 9, 200**0.5, 200**0.5]])


@pytest.mark.parametrize(("block", "fanout"), BLOCKS)
def test_the_chain_keeps_to_an_arm(spark, block, fanout):
    """Two parallel arms close to each other: near the end of the one, single positions fall nearer to the other."""
    arms = [(0.0, 0.0, 100.0, 0.0), (0.0, 6.0, 100.0, 6.0), (0.0, 0.0, 0.0, 6.0)]
    y = [0.0, 0.5, 4.0, 0.2, 3.5, 0.0, 0.1]
    df = spark.createDataFrame([("a", n, 60.0 + 5 * n, v) for n, v in enumerate(y)], "k string, i long, x double, y double")
    found = C.edges_by_chain(df, arms, ["k"], "i", "x", "y", block=block, fanout=fanout).orderBy("i").collect()
    assert [r.edge for r in found] == [0] * len(y)


def test_ahead_on_a_track_with_a_loop(spark):
    """A triangle with a tail, against a graph of small steps with the animal taken out of it."""
    edges = [(0, 0, 30, 0), (30, 0, 30, 40), (30, 40, 0, 0), (0, 0, -20, 0)]
    steps = [np.linspace(0, 1, int(n) + 1) for n in (30, 40, 50, 20)]
    dots = [tuple(np.round(np.array(e[:2]) + s * (np.array(e[2:]) - e[:2]), 9) + 0.0) for e, line in zip(edges, steps, strict=True) for s in line]
    links = {}
    for e, line in zip(edges, steps, strict=True):
        on = [tuple(np.round(np.array(e[:2]) + s * (np.array(e[2:]) - e[:2]), 9) + 0.0) for s in line]
        for a, b in zip(on, on[1:], strict=False):
            links.setdefault(a, set()).add(b)
            links.setdefault(b, set()).add(a)

    def ways(start, without=None):
        far, now = {start: 0}, [start]
        while now:
            now = [b for a in now for b in links[a] if b not in far and b != without and not far.update({b: far[a] + 1})]
        return far

    rows, want = [], []
    for k in range(150):
        e = k % 4
        s = steps[e][1 + int(RNG.integers(len(steps[e]) - 2))]
        at = tuple(np.round(np.array(edges[e][:2]) + s * (np.array(edges[e][2:]) - edges[e][:2]), 9) + 0.0)
        to = dots[int(RNG.integers(len(dots)))]
        forward = bool(RNG.integers(2))
        head = edges[e][2:] if forward else edges[e][:2]
        angle = np.arctan2(head[1] - at[1], head[0] - at[0]) + RNG.uniform(-1.5, 1.5)
        rows.append((k, *map(float, at), *map(float, to), float(angle)))
        head = tuple(np.array(head, float) + 0.0)
        back = ways(head).get(to)
        around = ways(head, at).get(to)
        tie = around is not None and around == ways(head)[at] + ways(at).get(to, 0)
        want.append((ways(at)[to], None if tie else (1 if around is not None and around == back else -1)))
    rows += [(900, None, 0.0, 1.0, 1.0, 0.0), (901, 1.0, 0.0, 1.0, 1.0, None)]
    made = {r.id: r.ahead for r in C.ahead_on_track(spark.createDataFrame(rows, "id long, x double, y double, mx double, my double, h double"), edges, "x", "y", "mx", "my", "h").collect()}
    assert made.pop(900) is None and made.pop(901) is None
    for k, (far, sign) in enumerate(want):
        assert abs(made[k]) == pytest.approx(far, abs=1e-6)
        assert sign is None or far == 0 or np.sign(made[k]) == sign


@pytest.mark.parametrize("whole", [False, True])
def test_decoding_by_interval(spark, seen, whole):
    times, like = seen["a"]
    rows = spark.createDataFrame([("a", t, x.tolist()) for t, x in zip(times, like, strict=True)] + [("b", 1, [0.0] * N)], "k string, i long, x array<double>")
    spans = [(-3, 9), (5, 12), (30, 30), (50, 400), (20, 10), (900, 950), (-3, 9)]
    iv = spark.createDataFrame([("a", *s) for s in spans] + [(None, 0, 9)], "k string, start long, stop long")
    made = {(r.start, r.stop, r.i): r.acausal for r in C.decode_intervals(rows, iv, ["k"], "i", "x", MOVES, 16, whole, block=7, fanout=3).collect()}
    inside = {t for a, b in spans for t in times if a <= t <= b}
    every = dict(zip(times, recursion(np.array([x if t in inside else np.zeros(N) for t, x in zip(times, like, strict=True)]))[1], strict=True)) if whole else {}
    want = {}
    for a, b in set(spans):
        own = [k for k, t in enumerate(times) if a <= t <= b]
        if own:
            found = [every[times[k]] for k in own] if whole else recursion(like[own])[1]
            want |= {(a, b, times[k]): p for k, p in zip(own, found, strict=True)}
    assert made.keys() == want.keys()
    for k, p in want.items():
        assert made[k] == pytest.approx(list(p), abs=1e-9)


def test_short_series_go_side_by_side(spark, monkeypatch):
    """Many series of one block, one of several: all as one by one, and the short ones make no products."""
    rng = np.random.default_rng(9)
    rows = [(k, i, *(float(v) for v in rng.uniform(0, 100, 2))) for k, many in [*((f"s{j}", 1 + j) for j in range(12)), ("long", 45)] for i in range(many)]
    df = spark.createDataFrame(rows, "k string, i long, x double, y double")
    edges = [(0.0, 0.0, 100.0, 0.0), (100.0, 0.0, 100.0, 100.0), (100.0, 100.0, 0.0, 100.0)]
    asked = []
    monkeypatch.setattr(C, "_by_block", lambda rows, *rest, f=C._by_block: (asked.append({r.k for r in rows.collect()}), f(rows, *rest))[1])
    many = {(r.k, r.i): r.edge for r in C.edges_by_chain(df, edges, ["k"], "i", "x", "y", sensor=20.0, scaling=30.0, block=20, fanout=2).collect()}
    assert asked == [{"long"}]
    assert len(many) == len(rows)
    monkeypatch.undo()
    blocks = C.edges_by_chain(df, edges, ["k"], "i", "x", "y", sensor=20.0, scaling=30.0, block=3, fanout=2)
    assert {(r.k, r.i): r.edge for r in blocks.collect()} == many

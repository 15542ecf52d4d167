"""Runway and its back-test against plain recomputation at every cutoff."""

import math
import random
import statistics

import numpy as np
import pytest

from tidemark.operators import growth as G

DAY = 10


def segment(rows):
    """Rows from the last drop on that is large beside the capacity and the usual steps."""
    steps = [b[1] - a[1] for a, b in zip(rows, rows[1:], strict=False)]
    usual = statistics.median(steps)
    limit = max(G.DROP_SHARE * (rows[-1][1] + rows[-1][2]), G.DEVIATIONS * statistics.median(abs(s - usual) for s in steps))
    return rows[max([0, *(i + 1 for i, s in enumerate(steps) if -s > limit)]) :]


def slopes(rows):
    return [(b[1] - a[1]) / ((b[0] - a[0]) / DAY) for i, a in enumerate(rows) for b in rows[i + 1 :] if b[0] > a[0]]


@pytest.fixture(scope="module")
def readings(spark):
    """Noisy growth with cleanups, times that repeat, gaps, steady growth, and keys of one and two readings."""
    rnd, rows = random.Random(11), []
    for k, n in [("noisy", 150), ("steady", 60), ("sparse", 40), ("two", 2), ("one", 1), ("same", 3)]:
        x, used = 5, 1000.0
        for i in range(n):
            rows.append((k, x, used, 9000.0 - used))
            x += 0 if k == "same" else DAY if k == "steady" else rnd.choice([0, 7, DAY, 13, 60 if k == "sparse" else 11])
            used += 20.0 if k == "steady" else round(rnd.gauss(25, 20), 1)
            if k == "noisy" and i in (50, 110):
                used -= 1500.0
    rows.append((None, 3, 1.0, 1.0))
    rows.append(("noisy", None, 1.0, 1.0))
    rnd.shuffle(rows)
    by_key = {}
    for k, x, u, a in rows:
        if k and x is not None:
            by_key.setdefault(k, []).append((x, u, a))
    return {k: sorted(v) for k, v in by_key.items()}, spark.createDataFrame(rows, "k string, x long, used double, free double").cache()


@pytest.mark.parametrize("tile", [3, 256])
def test_runway(readings, tile, monkeypatch):
    monkeypatch.setattr(G, "TILE", tile)
    by_key, df = readings
    got = {r.k: r for r in G.growth_runway(df, ["k"], "x", "used", "free", DAY).collect()}
    assert set(got) == set(by_key)
    for k, rows in by_key.items():
        own = segment(rows) if len(rows) > 1 else rows
        found, r = slopes(own), got[k]
        assert r.readings == len(own)
        if not found:
            assert (r.central, r.outlook) == (None, "N/A")
            continue
        central, upper = np.quantile(found, [0.5, 0.75])
        assert math.isclose(r.central, central, rel_tol=1e-12) and math.isclose(r.conservative, upper, rel_tol=1e-12)
        assert (r.runway_days is None) == (central <= 0)
        assert central <= 0 or math.isclose(r.runway_days, rows[-1][2] / central, rel_tol=1e-12)
    assert got["steady"].readings == 60 and got["steady"].outlook == "~11 months (conservative: ~11 months)"
    assert got["noisy"].readings < 50


@pytest.mark.parametrize("cells", [1, 1024])
def test_backtest(readings, cells, monkeypatch):
    monkeypatch.setattr(G, "CELLS", cells)
    by_key, df = readings
    want = {}
    for k, rows in by_key.items():
        for h in (10, 25):
            off = []
            for t in range(rows[0][0] + 14 * DAY, rows[-1][0] - h * DAY + 1, 7 * DAY):
                past = [r for r in rows if r[0] <= t]
                own = segment(past) if len(past) > 1 else []
                target = past[-1][0] + h * DAY
                later = [r for r in rows if r[0] >= target]
                if len(own) >= 5 and slopes(own) and later and (later[0][0] - target) // DAY <= 3:
                    off.append(past[-1][1] + statistics.median(slopes(own)) * h - later[0][1])
            if off:
                want[k, h] = (len(off), statistics.fmean(map(abs, off)), math.sqrt(statistics.fmean(e * e for e in off)))
    got = {(r.k, r.horizon): (r.n, r.mae, r.rmse) for r in G.growth_backtest(df, ["k"], "x", "used", "free", DAY, (10, 25)).collect()}
    assert {k[0] for k in want} >= {"noisy", "steady"} and set(got) == set(want)
    for k, (n, mae, rmse) in want.items():
        assert got[k][0] == n and math.isclose(got[k][1], mae, rel_tol=1e-9, abs_tol=1e-9) and math.isclose(got[k][2], rmse, rel_tol=1e-9, abs_tol=1e-9)


def test_empty(spark):
    none = spark.createDataFrame([], "k string, x long, used double, free double")
    assert G.growth_runway(none, ["k"], "x", "used", "free", DAY).collect() == []
    assert G.growth_backtest(none, ["k"], "x", "used", "free", DAY).collect() == []

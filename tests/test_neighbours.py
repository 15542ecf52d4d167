"""Nearest neighbours and isolation against the plain comparison of all rows."""

import numpy as np
import pytest

from tidemark.operators import neighbours as N

RNG = np.random.default_rng(11)


def _rows(spark):
    rows = []
    for key, many in (("hot", 90), ("few", 3)):
        x = RNG.integers(-4, 5, (many, 3)).astype(float)
        rows += [(key, i, i % 3, [float(v) for v in p]) for i, p in enumerate(x)]
    rows += [("hot", 900 + i, 1, [2.0, 2.0, 2.0]) for i in range(7)]  # copies
    rows += [("hot", 990, 1, None), ("hot", 991, 1, [1.0, None, 0.0]), (None, 992, 1, [0.0, 0.0, 0.0]), ("hot", 993, None, [50.0, 50.0, 50.0])]
    return spark.createDataFrame(rows, "g string, id long, unit int, v array<double>")


def _plain(rows, k, itself):
    good = [r for r in rows if r.g is not None and r.v is not None and None not in r.v]
    out = set()
    for q in good:
        far = sorted((sum((a - b) ** 2 for a, b in zip(q.v, r.v, strict=True)), r.id) for r in good if r.g == q.g and (itself or r.id != q.id))
        out |= {(q.g, q.id, r, n + 1, d) for n, (d, r) in enumerate(far[:k])}
    return out


@pytest.mark.parametrize(("pivots", "size", "itself"), [(1, 1000, False), (9, 10, False), (9, 1000, True)])
def test_nearest(spark, pivots, size, itself):
    rows = _rows(spark)
    made = N.nearest(rows.withColumnRenamed("id", "q"), rows, ["g"], "q", "id", "v", 4, itself, pivots, size).collect()
    assert {tuple(r) for r in made} == _plain(rows.collect(), 4, itself) and len(made) == len(set(made))


def test_isolation(spark):
    rows = _rows(spark)
    good = [r for r in rows.collect() if r.unit is not None and r.g is not None and r.v is not None and None not in r.v]
    share = {}
    for g in ("hot", "few"):
        for a, b in ((0, 1), (0, 2), (1, 2)):
            each = []
            for own in (a, b):
                own_share = []
                for q in (r for r in good if r.g == g and r.unit == own):
                    near = sorted((sum((x - y) ** 2 for x, y in zip(q.v, r.v, strict=True)), r.id, r.unit) for r in good if r.g == g and r.unit in (a, b) and r.id != q.id)[:4]
                    own_share.append(sum(u == own for _, _, u in near) / len(near))
                each.append(np.mean(own_share))
            share[g, a, b] = np.mean(each)
    made = N.pair_isolation(rows, ["g"], "unit", "id", "v", 4, pivots=5, size=20).collect()
    assert {(r.g, r.a, r.b): pytest.approx(r.share) for r in made} == share
    worst = {(r.g, r.unit): (r.isolation, r.noise_overlap) for r in N.isolation(rows, ["g"], "unit", "id", "v", 4, noise=2).collect()}
    assert worst["hot", 0] == (pytest.approx(share["hot", 0, 1]), pytest.approx(1 - share["hot", 0, 2]))
    assert ("hot", 2) not in worst


def test_empty_and_alone(spark):
    rows = _rows(spark)
    none = rows.limit(0)
    assert N.nearest(rows.withColumnRenamed("id", "q"), none, ["g"], "q", "id", "v", 4).count() == 0
    assert N.nearest(none.withColumnRenamed("id", "q"), rows, ["g"], "q", "id", "v", 4).count() == 0
    assert [tuple(r) for r in N.isolation(rows.where("unit = 1 and g = 'hot'"), [], "unit", "id", "v", 4).collect()] == [(1, None)]


def test_vectors_are_written_once_however_many_cells_are_visited(spark, monkeypatch):
    written = {}

    def kept(df, label, write=N.materialise):
        out = write(df, label)
        written[label] = out.count()
        return out

    monkeypatch.setattr(N, "materialise", kept)
    x = np.random.default_rng(3).normal(size=(300, 12))  # without structure: nearly all cells are visited
    rows = spark.createDataFrame([("one", i, [float(v) for v in p]) for i, p in enumerate(x)], "g string, id long, v array<double>")
    made = N.nearest(rows.withColumnRenamed("id", "q"), rows, ["g"], "q", "id", "v", 3, False, 25, 100).collect()
    assert written["away"] <= 300
    square = ((x[:, None] - x) ** 2).sum(axis=2)
    np.fill_diagonal(square, np.inf)
    assert {(r.q, r["rank"]): r.id for r in made} == {(q, n + 1): i for q in range(300) for n, i in enumerate(np.argsort(square[q])[:3])}

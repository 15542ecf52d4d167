"""Literal cases and small oracles of the other operators, and streams against their batch twins."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import events as E
from tidemark.operators import intervals as I
from tidemark.operators import lineage as L
from tidemark.operators import position as P
from tidemark.operators import provenance as V
from tidemark.operators import quality as Q
from tidemark.operators import relational as R
from tidemark.operators import signal as S
from tidemark.operators import spikes as K
from tidemark.streaming import stateful as T


def test_restrict(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "x int, y string")
    assert R.restrict(df, {"zzz": 1}).count() == 3 and R.restrict(df, {"y": None}).count() == 1
    assert R.restrict(df, []).count() == 0 and R.restrict(df, [{"x": 1}, "x = 3"]).count() == 2
    assert R.restrict(df, df.where("x < 3").select("x")).count() == 2
    assert R.project(df, "...", z="x").columns == ["y", "z"]


def test_criteria(spark):
    """Every test against plain Python on made-up values, of which some are missing."""
    values = [-2.5, 0.0, None, 7.25, float("nan"), 7.25, 12.0, -40.0]
    frame = spark.createDataFrame([(k, v, k % 3) for k, v in enumerate(values)], "u int, depth double, layer int")
    plain = {
        ">": (0.0, lambda v: v > 0), ">=": (7.25, lambda v: v >= 7.25), "<": (0.0, lambda v: v < 0), "<=": (-2.5, lambda v: v <= -2.5), "==": (7.25, lambda v: v == 7.25), "!=": (7.25, lambda v: v != 7.25),
        "between": ((-2.5, 7.25), lambda v: -2.5 <= v <= 7.25), "outside": ((-2.5, 7.25), lambda v: v < -2.5 or v > 7.25), "isin": ([12.0, 0.0], lambda v: v in (12, 0)), "notin": ([12.0, 0.0], lambda v: v not in (12, 0)),
    }
    got = lambda **c: [r.u for r in K.filter_by_criteria(frame, c).orderBy("u").collect()]
    for op, (value, test) in plain.items():
        assert got(depth=[(op, value)]) == [k for k, v in enumerate(values) if v is not None and v == v and test(v)], op
    assert got(depth=[(">", -10), ("<", 10)], layer=[("==", 0)]) == [0, 3]
    for wrong, said in ((("nothing", [(">", 1)]), "no such columns"), (("depth", [("=~", 1)]), "unknown operator")):
        with pytest.raises(ValueError, match=said):
            got(**dict([wrong]))


def test_fir_blocks_equal_convolution(spark):
    rng = np.random.default_rng(0)
    x, taps = rng.normal(size=2000), rng.normal(size=41)
    df = spark.createDataFrame([(c, i, float(v)) for c in (0, 1) for i, v in enumerate(x * (c + 1))], "c int, i long, x double")
    expected = np.convolve(x, taps)[20 : 20 + len(x)]
    got = np.array([r.filtered for r in S.fir_blocks(df, ["c"], "i", "x", taps.tolist(), block=128).where("c = 1").orderBy("i").collect()])
    assert np.abs(got - 2 * expected).max() < 1e-9
    few = S.fir_blocks(df, ["c"], "i", "x", taps.tolist(), block=128, every=10).where("c = 0").orderBy("i").collect()
    assert [r.i for r in few] == list(range(0, 2000, 10)) and abs(few[7].filtered - expected[70]) < 1e-9


def test_signal_small_cases(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 0, 0.0), (1, 1, nan), (1, 100, 10.0)], "k int, t long, x double")
    grid = df.select("k", "t")
    assert [r.x for r in S.resample(df.where("not isnan(x)"), grid, ["k"], "t", "x", by="row").orderBy("t").collect()] == [0, 5, 10]
    assert [round(r.x, 3) for r in S.resample(df.where("not isnan(x)"), grid, ["k"], "t", "x").orderBy("t").collect()] == [0, 0.1, 10]
    turn = spark.createDataFrame([(1, i, float(np.angle(np.exp(1j * i)))) for i in range(30)], "k int, i long, a double")
    assert np.allclose([r.unwrapped for r in S.unwrap(turn, ["k"], "i", "a").orderBy("i").collect()], np.arange(30))
    beat = spark.createDataFrame([(1, i * 33_333) for i in range(100)], "k int, t long")
    assert S.sampling_rate(beat, ["k"], "t").first().rate == 30
    assert S.valid_intervals(beat, ["k"], "t", 80_000, 0, 1).first()[1:] == (-1, 99 * 33_333 + 1)
    wave = spark.createDataFrame([(1, i, float(np.cos(2 * np.pi * i / 20))) for i in range(200)], "k int, i long, x double")
    z = S.phase_and_power(S.hilbert(wave, ["k"], "i", "x")).collect()
    assert max(abs(r.power - 1) for r in z) < 1e-9


def test_good_spans_and_polygon(spark):
    """Bridged spans against a walk over random rows; points by the corners of an L."""
    rng = np.random.default_rng(8)
    bad = rng.random(120) < 0.4
    rows = spark.createDataFrame([(1, k, bool(b)) for k, b in enumerate(bad)], "k int, i long, bad boolean")
    for reach in (0, 1, 3):
        spans = []
        for k in np.flatnonzero(~bad).tolist():
            if spans and k - spans[-1][1] - 1 <= reach:
                spans[-1][1] = k
            else:
                spans.append([k, k])
        assert [[r.start, r.stop] for r in P.good_spans(rows, ["k"], "i", F.col("bad"), reach).orderBy("start").collect()] == spans
    corner = [(0, 0), (4, 0), (4, 1), (1, 1), (1, 3), (0, 3)]
    places = {(0.5, 2.5): True, (3.5, 0.5): True, (2.0, 2.0): False, (-0.1, 1.0): False}
    xy = spark.createDataFrame(list(places), "x double, y double")
    assert {(r.x, r.y): r.inside for r in P.inside_polygon(xy, "x", "y", corner).collect()} == places


def test_lineage(spark):
    """Shelves hold boxes, labels name a box by another column: three levels, with known contents."""
    frames = {
        "shelf": spark.createDataFrame([("top", 2.1), ("mid", 1.2), ("low", 0.3)], "shelf string, height double"),
        "box": spark.createDataFrame([(7, "top", "red"), (8, "low", "red"), (9, "low", "blue")], "box int, shelf string, colour string"),
        "label": spark.createDataFrame([("x", 7, 1), ("y", 7, 2), ("z", 9, 3)], "label string, on_box int, size int"),
    }
    cat = L.Catalogue([L.TableSpec("shelf", ["shelf"]), L.TableSpec("box", ["box"], {"shelf": {"shelf": "shelf"}}), L.TableSpec("label", ["label"], {"box": {"on_box": "box"}})], frames.get)
    names = lambda df, c: sorted(r[c] for r in df.select(c).collect())
    assert names(L.restrict_by(cat, "label", "height > 1", {"height"}), "label") == ["x", "y"]
    assert names(L.restrict_by(cat, "shelf", "size > 2", {"size"}, "down"), "shelf") == ["low"]
    assert L.restrict_by(cat, "label", "height > 1", {"height"}, ban=("box",)) is None
    up = L.cascade(cat, {"label": frames["label"].where("label = 'z'")})
    assert names(up["box"], "box") == [9] and names(up["shelf"], "shelf") == ["low"]
    both = L.merge_graphs(cat, up, L.cascade(cat, {"box": frames["box"].where("colour = 'red'")}), "or")
    assert names(both["shelf"], "shelf") == ["low", "top"] and names(both["box"], "box") == [7, 8, 9]
    assert L.content_hash(frames["box"]).first() == L.content_hash(frames["box"].orderBy(F.desc("box"))).first()


def test_quality_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([("Doe, Jane",), ("Jane Doe",), ("Jane",)], "n string")
    assert [tuple(r.p) if r.p else None for r in df.select(Q.name_parts(F.col("n")).alias("p")).collect()] == [("Jane", "Doe"), ("Jane", "Doe"), None]
    made = Q.write_result(df, str(tmp_path / "x"), "people").first()
    assert made.rows == 3 and made.table_name == "people"


def test_least_length_of_valid_intervals(spark):
    beat = spark.createDataFrame([(1, t) for t in (0, 1, 2, 3, 6, 7, 8, 9, 10)], "k int, t long")
    spans = lambda least: sorted((r.start, r.stop) for r in S.valid_intervals(beat, ["k"], "t", 2, least).collect())
    assert spans(0) == [(0, 3), (6, 10)] and spans(3) == [(6, 10)]
    assert spans(8) == []  # the whole is 10 long, so the minimum holds
    assert spans(11) == []  # the whole is shorter: half of it counts
    assert sorted((r.start, r.stop) for r in S.valid_intervals(beat, ["k"], "t", 4, 11).collect()) == [(0, 10)]


def test_upsert_without_update(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert Q.upsert(spark.createDataFrame([(2, "B"), (3, "c")], old.schema), old, ["id"], update=False).count() == 3
    with pytest.raises(ValueError, match="1 rows"):
        Q.upsert(spark.createDataFrame([(2, "x"), (3, "c")], old.schema), old, ["id"], update=False)


def test_artifacts_by_deviation(spark):
    rows = [(0, c, i, i * 10, 50.0 if i == 7 and c == 2 else float(c)) for c in range(4) for i in range(20)]
    df = spark.createDataFrame(rows, "g int, c int, i long, t long, x double")
    clock = df.where("c = 0").select("g", "i", "t")
    whole = spark.createDataFrame([(0, 0, 190)], "g int, start long, stop long")
    found = lambda **more: sorted((r.start, r.stop) for r in S.amplitude_artifacts(df, clock, whole, ["g"], "c", "i", "t", "x", None, 20, least=0, **more).collect())
    assert found(z=1.7, share=0.25) == [(0, 60), (80, 190)] and found(z=1.7, share=0.5) == [(0, 190)]


def test_events_above_the_mean(spark):
    z = [-1, 0.5, 2, 2, 0.1, -1, 3, -1, 1, 1, 0]
    df = spark.createDataFrame([(1, i, i * 10, float(v)) for i, v in enumerate(z)], "k int, i long, t long, z double")
    got = lambda *a: sorted((r.start, r.stop) for r in E.above_mean(df, ["k"], "i", "t", "z", *a).collect())
    assert got(2.0) == [(10, 40), (60, 60)] and got(2.0, 10) == [(10, 40)] and got(1.0) == [(10, 40), (60, 60), (80, 100)]
    events = spark.createDataFrame([(1, 0, 10), (1, 12, 20), (1, 26, 30), (1, 29, 40)], "k int, start long, stop long")
    assert sorted(r.start for r in E.apart(events, ["k"], 5).collect()) == [0, 26]
    slow = spark.createDataFrame([(1, t, 9.0 if t == 20 else 1.0) for t in (0, 10, 12, 20, 26, 30)], "k int, t long, v double")
    assert sorted(r.start for r in E.at_rest(events, slow, ["k"], "t", "v", 4.0).collect()) == [0, 26]


def test_points_and_directions(spark):
    nan = float("nan")
    four = spark.createDataFrame([(0.0, 0.0, 2.0, 0.0, 9.0, 9.0, 9.0, 9.0), (0.0, 0.0, nan, nan, 2.0, 2.0, 2.0, -2.0), (nan, nan, nan, nan, 2.0, 2.0, 2.0, -2.0), (0.0, 0.0, nan, nan, 4.0, 0.0, nan, nan), (nan, nan, 3.0, 1.0, 4.0, 0.0, nan, nan), (0.0, 0.0, 50.0, 0.0, nan, nan, nan, nan)], ", ".join(f"{c}{k} double" for k in range(4) for c in "xy"))
    got = [(r.cx, r.cy) for r in P.centroid(four, [(f"x{k}", f"y{k}") for k in range(4)], 10.0).collect()]
    assert got == [(1, 0), (1, 0), (2, 0), (2, 0), (3, 1), (None, None)]
    assert [(r.cx, r.cy) for r in P.centroid(four, [("x1", "y1")]).collect()][1] == (None, None)
    with pytest.raises(ValueError, match="limit"):
        P.centroid(four, [("x0", "y0"), ("x1", "y1")])
    three = spark.createDataFrame([(1.0, 0.0, 0.0, 0.0, 0.5, 1.0), (1.0, 0.0, 0.0, 0.0, 0.5, -1.0), (0.0, 1.0, 0.0, 0.0, 0.0, 0.0)], "a double, b double, c double, d double, e double, f double")
    turned = [r.orientation for r in P.bisector_orientation(three, ("a", "b"), ("c", "d"), ("e", "f")).collect()]
    assert np.allclose(turned, [np.pi / 2, -np.pi / 2, np.pi])
    level = three.withColumn("f", F.lit(0.0)).limit(1)
    with pytest.raises(Exception, match="cannot be told"):
        P.bisector_orientation(level, ("a", "b"), ("c", "d"), ("e", "f")).collect()


def test_analytic_signal_of_a_wave(spark):
    wave = spark.createDataFrame([(1, i, float(np.cos(2 * np.pi * i / 8))) for i in range(400)], "k int, i long, x double")
    inner = [r.power for r in S.phase_and_power(S.analytic(wave, ["k"], "i", "x", 32, 64)).where("i between 40 and 360").collect()]
    assert len(inner) == 321 and max(abs(p - 1) for p in inner) < 0.02


def test_blocks_agree_with_whole_series(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(k, i, float(v), float(i % 7)) for k in (0, 1) for i, v in enumerate(rng.integers(0, 30, 300))], "k int, i long, x double, y double")
    cases = [
        lambda b: S.fir_small(df, ["k"], "i", "x", [0.2, 0.5, 0.2, 0.1, 0.3], block=b),
        lambda b: S.gaussian(df, ["k"], "i", "x", 2.0, block=b),
        lambda b: S.moving_mean(df, ["k"], "i", "x", 9, block=b),
        lambda b: E.peaks(df, ["k"], "i", "x", 20, 4, b),
        lambda b: P.speed(df, ["k"], "i", "x", "y", 0.5, b),
        lambda b: E.threshold_events(df, ["k"], "i", "i", "x", 8, 20, 2, b),
        lambda b: I.interval_labels(df, ["k"], "i", F.col("x") < 9, b).select("k", "i", "label"),
        lambda b: S.unwrap(df.withColumn("a", F.when(F.col("x") > 3, F.col("x"))), ["k"], "i", "a", block=b).where("a is not null").select("k", "i", "unwrapped"),
        lambda b: S.interpolate(df.withColumn("x", F.when(F.col("x") > 22, F.col("x"))), ["k"], "i", "x", ends=True, idx="i" if b else None, block=b or 1).select("k", "i", "filled"),
        lambda b: S.difference_artifacts(df.withColumn("g", F.lit(0)), ["g"], "k", "i", "x", 9, 20, 0.5, block=b),
    ]
    plain = lambda d: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in d.collect())
    for make in cases:
        whole = plain(make(None))
        assert whole and all(plain(make(b)) == whole for b in (1, 32, 65_536))


def test_jump_rejection(spark):
    rng = np.random.default_rng(8)
    x, y = np.cumsum(rng.normal(0, 2, 400)) + 100.3, np.cumsum(rng.normal(0, 2, 400)) + 50.6
    x[rng.choice(400, 40, replace=False)] += 30
    bad = rng.random(400) < 0.15
    bad[200:230] = True  # two spans
    df = spark.createDataFrame([(1, i, float(x[i]), float(y[i]), bool(bad[i])) for i in range(400)], "k int, i long, x double, y double, bad boolean")
    got = {r.i: r.rejected for r in P.reject_jumps(df, ["k"], "i", "x", "y", F.col("bad"), 10, 8.0).collect()}
    good = [i for i in range(400) if not bad[i]]
    spans, begin = [], good[0]
    for a, b in zip(good, good[1:] + [10**6], strict=True):
        if b - a - 1 > 10:
            spans.append((begin, a))
            begin = b
    assert len(spans) == 2
    rejected = {i for i in range(400) if bad[i]}
    far = lambda k, m: any(c[k] < int(c[m] - 8) or c[k] > int(c[m] + 8) for c in (x, y))
    for a, b in spans:
        some = [i for i in range(a, b) if not bad[i]]
        start = some[len(some) // 2] if len(some) < b - a else a + (b - a) // 2
        for side in ([i for i in range(start - 1, a, -1)], [i for i in range(start + 1, b)]):
            stayed = [start]
            for i in side:
                if not bad[i] and far(i, stayed[-1]):
                    rejected.add(i)
                elif not bad[i]:
                    stayed.append(i)
    assert {i for i, r in got.items() if r} == rejected and len(rejected) > sum(bad) + 20


def test_whitening(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3)) @ np.array([[1, 2, 0], [0, 1, 1], [0, 0, 3]])
    df = spark.createDataFrame([(i, "abc"[c], float(x[i, c])) for i in range(300) for c in range(3)] + [(400, "a", 1.0)], "i int, c string, x double")
    wide = K.whiten(df, "i", "c", "x", ["a", "b", "c"]).groupBy("i").pivot("c", ["a", "b", "c"]).agg(F.first("x")).toPandas()[["a", "b", "c"]].to_numpy()
    assert wide.shape == (300, 3) and np.allclose(np.cov(wide.T, bias=True), np.eye(3), atol=1e-6)


def test_whitening_of_many_channels(spark, monkeypatch):
    """More channels than a plan could spell out, moments joined in a tree."""
    monkeypatch.setattr(K, "_MERGED", 2)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 150)) @ rng.normal(size=(150, 150)) + 5
    df = spark.createDataFrame([(i, c, float(x[i, c])) for i in range(400) for c in range(150)], "i int, c int, x double")
    out = K.whiten(df.repartition(7), "i", "c", "x", list(range(150))).groupBy("i").agg(F.array_sort(F.collect_list(F.struct("c", "x"))).x.alias("x")).toPandas()
    assert np.allclose(np.cov(np.stack(out["x"].tolist()).T, bias=True), np.eye(150), atol=1e-6)
    assert K.whiten(df.where("c < 3"), "i", "c", "x", [0, 1, 2, 3]).count() == 0


def test_clusterless_marks_stay_on_their_electrode(spark):
    rng = np.random.default_rng(6)
    spikes = [(k, int(rng.integers(2)), [float(v) for v in rng.normal(0, 6, 3)], int(rng.integers(4))) for k in range(150)] + [(900, 0, None, 1), (901, 0, [1.0, float("nan"), 2.0], 1)]
    df = spark.createDataFrame(spikes, "spike int, electrode int, mark array<double>, bin int")
    got = {(r.spike, r.bin): r.likelihood for r in K.clusterless_likelihood(df, df, ["spike"], ["electrode"], "mark", "bin", 3.0, fine=2, reach=2).collect()}
    want, whole = {}, [(k, e, np.floor(np.array(m) * 2 / 3.0), b) for k, e, m, b in spikes[:150]]
    for k, e, m, _ in whole:
        for _, e2, m2, b2 in whole:
            q = ((m - m2) ** 2).sum()
            if e == e2 and q <= 16:
                want[k, b2] = want.get((k, b2), 0) + np.exp(-q / 8)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_export_follows_all_steps(spark):
    """A long way up, a circle, a file that nothing came from, and a list of what may be exported."""
    edges = [(k, k + 1) for k in range(12)] + [(12, 10), (50, 51), (51, None), (60, 60)]
    up = spark.createDataFrame(edges, "file int, source int")
    exports = spark.createDataFrame([("p", 1), ("p", 2), ("q", 3)], "paper string, export int")
    log = spark.createDataFrame([(1, 60), (2, 0), (2, 50), (3, 11), (3, 99), (3, 99), (3, None)], "export int, file int")
    got = lambda **x: sorted((r.paper, r.file) for r in V.export_set(exports, log, up, "paper", "export", "file", **x).collect() if r.file is not None)
    assert got() == sorted([("p", k) for k in [*range(13), 50, 51]] + [("q", k) for k in (10, 11, 12, 99)])
    assert got(included=spark.createDataFrame([(51,), (99,)], "file int")) == [("p", 50), ("p", 51), ("q", 99)]


def test_names_are_taken_apart(spark):
    names = spark.createDataFrame([(" Ann Lee ",), ("Lee, Ann B",), ("Ann B Lee",), ("Lee,Ann",), (None,), ("a, b, c",)], "n string")
    got = [tuple(r.p) if r.p else None for r in names.select(Q.name_parts(F.col("n")).alias("p")).collect()]
    assert got == [("Ann", "Lee"), ("Ann B", "Lee"), None, None, None, None]


def stream(spark, tmp_path, rows, schema):
    for k in range(3):
        spark.createDataFrame(rows[k::3] if k > 2 else rows[k * len(rows) // 3 : (k + 1) * len(rows) // 3], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def run(df, tmp_path, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name).collect()


def test_streams(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [("ab"[i % 2], int(i * 10), i, float(rng.integers(0, 100))) for i in range(90)]
    src = stream(spark, tmp_path, rows, "key string, t long, id long, value double")
    got = {(r.key, r.t) for r in run(T.triggers(src, "key", "t", "id", "value", 60, 45), tmp_path, "triggers")}
    want, until = set(), {}
    for k, t, _, v in rows:
        if v >= 60 and t >= until.get(k, -1):
            want.add((k, t))
            until[k] = t + 45
    assert got == want
    pairs = {(r.key, r.start, r.stop) for r in run(T.on_off_pairs(src, "key", "t", F.col("value") > 50), tmp_path, "pairs")}
    want, on = set(), {}
    for k, t, _, v in rows:
        if v > 50:
            on[k] = t
        elif k in on:
            want.add((k, on.pop(k), t))
    assert pairs == want
    timed = src.withColumn("ts", F.timestamp_seconds(F.col("t")))
    counts = {(r.key, r.start.timestamp(), r.n) for r in run(T.tumbling_counts(timed, "key", "ts", "100 seconds", "0 seconds"), tmp_path, "counts")}
    batch = spark.createDataFrame(rows, "key string, t long, id long, value double").withColumn("ts", F.timestamp_seconds(F.col("t")))
    whole = {(r.key, r.start.timestamp(), r.n) for r in batch.groupBy("key", F.window("ts", "100 seconds")).agg(F.count("*").alias("n")).select("key", F.col("window.start").alias("start"), "n").collect()}
    assert counts <= whole and len(counts) >= len(whole) - 4  # the last windows stay open
    assert len(run(T.speed_gate(src, "value", 50.0), tmp_path, "gate")) == sum(v <= 50 for *_, v in rows)

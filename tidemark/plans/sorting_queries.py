"""Registered queries of sorting, waveforms, decoding inputs, detected events, poses and streams."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.blocks import BLOCK, numbered
from ..operators import chains, neighbours
from ..operators import events as E
from ..operators import position as P
from ..operators import signal as S
from ..operators import spikes as K
from .interval_queries import _DAYS, _SAMPLES, _parity_days, _samples
from .more_queries import _hours
from .signal_queries import _XY, EDGES, _xy
from .signal_queries import ORACLES as SIGNAL
from .tables import DAY, HOUR, above_mean, events, read, smoothed, sql
from .unit_queries import _POST, _decode

C = ["event_type"]


def k1_spike_samples(s, d):
    ev = events(s, d)
    return K.spike_samples(ev.select("event_type", (F.col("t") + HOUR).alias("t")), ev, C, "t")


def k3_firing_rate(s, d):
    ev = events(s, d)
    a, b = ev.agg(F.min("t"), F.max("t")).first()
    bins = (b - a) // DAY + 2 if a is not None else 1
    return K.firing_rate(K.indicator(ev, "event_type", "t", a or 0, DAY, bins), C, "bin", "n", 86400.0, 1.5).select("event_type", "bin", F.round(F.col("rate") * 1000, 6).alias("rate"))


def k7_model_range(s, d):
    ev = events(s, d)
    return K.within_range(ev.select("event_id", "event_type", "t"), ev.where("value > 60"), C, "t")


def k8_annotations(s, d):
    notes = read(s, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("unit"), F.lit("return").alias("annotation"), F.col("l_linestatus").alias("label"), F.col("l_linenumber").alias("quantity"))
    return K.annotate(read(s, d, "supplier").select(F.col("s_suppkey").alias("unit")), notes, ["unit"])


def k11_curations(s, d):
    o = read(s, d, "orders")
    old = o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("sorting"), (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1).alias("curation_id"))
    old = old.withColumn("parent", F.col("curation_id") - 1)
    roots = old.select("sorting").distinct().withColumn("_had", F.lit(True))
    new = o.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("sorting"), "o_orderkey").join(roots, "sorting", "left")
    new = new.select("sorting", "o_orderkey", F.when(F.col("_had") | (F.row_number().over(Window.partitionBy("sorting").orderBy("o_orderkey")) > 1), 0).otherwise(-1).alias("parent"))
    return K.next_curations(old, new, "sorting", "o_orderkey")


def _close(s, d):
    u = read(s, d, "supplier").select(F.col("s_suppkey").alias("u"), "s_acctbal", "s_nationkey")
    v = u.select(F.col("u").alias("v"), F.col("s_acctbal").alias("b2"), "s_nationkey")
    return u.join(v, "s_nationkey").select("u", "v", F.abs(F.col("s_acctbal") - F.col("b2")).alias("apart"))


def k13_merge_candidates(s, d):
    return K.merge_partners(_close(s, d), "u", "v", [("apart", "<", 800.0)])


def _waves(s, d):
    return read(s, d, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: F.round(x * 1000).cast("long")).alias("w"))


def k16_snr(s, d):
    return K.snr(_waves(s, d), "label", "w", 4).select("label", "channel", F.round("snr", 6).alias("snr"))


def _label_trains(s, d):
    return events(s, d).select((F.col("user_id") % 10).cast("int").alias("label"), "t").where("label is not null")


def k21_burst_pairs(s, d):
    pairs = K.burst_pairs(K.mean_template(_waves(s, d), "label", "w"), _label_trains(s, d), "label", "t", HOUR, HOUR, HOUR // 10)
    return pairs.select("a", "b", *(F.round(c, 6).alias(c) for c in ("similarity", "isi_violation", "asymmetry")))


def k21_burst_pairs_by_session(s, d):
    waves = _waves(s, d).withColumn("session", F.col("vec_id") % 3)
    template = waves.select("session", "label", F.posexplode("w").alias("place", "x")).groupBy("session", "label", "place").agg(F.avg("x").alias("mean"))
    trains = events(s, d).where("user_id is not null").select((F.col("user_id") % 10).cast("int").alias("label"), "t", (F.col("event_id") % 3).alias("session"))
    pairs = K.burst_pairs(template, trains, "label", "t", HOUR, HOUR, HOUR // 10, ("session",))
    return pairs.select("session", "a", "b", *(F.round(c, 6).alias(c) for c in ("similarity", "isi_violation", "asymmetry")))


def w2_peak_amplitude(s, d):
    return K.peak_amplitude(_waves(s, d), "vec_id", "label", "w", 4, "neg", True).select("vec_id", F.array_join("amplitude", ",").alias("amplitude"))


def w2_middle_amplitude(s, d):
    return K.peak_amplitude(_waves(s, d), "vec_id", "label", "w", 4).select("vec_id", F.array_join("amplitude", ",").alias("amplitude"))


def k26_amplitudes(s, d):
    peaks = K.peak_amplitude(_waves(s, d), "vec_id", "label", "w", 4, "neg", True).select("label", "vec_id", F.array_min("amplitude").alias("amplitude"))
    return K.amplitudes_over_time(_label_trains(s, d), peaks, "label", "t", "vec_id")


def w4_location(s, d):
    return K.spike_location(_waves(s, d), "vec_id", "w", 4, [(0, 0), (10, 0), (0, 20), (10, 20)]).select("vec_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def w6_features(s, d):
    w = _waves(s, d)
    spikes = w.select("vec_id", (F.col("vec_id") * 1000).alias("t"))
    amplitude = K.peak_amplitude(w, "vec_id", "label", "w", 4).select("vec_id", F.col("amplitude").alias("feature"))
    whole = w.select("vec_id", F.slice("w", 1, 2).alias("feature"))
    return K.features(spikes, [amplitude, whole], ["vec_id"], "t", 20_000, 300_000).select("vec_id", "t", F.array_join(F.transform("features", lambda x: x.cast("long")), ",").alias("features"))


def w9_electrode_marks(s, d):
    ev = events(s, d).groupBy("event_type", F.floor(F.col("t") / DAY).alias("bin")).agg(F.round(F.max("value"), 6).alias("value"))
    return P.keypoints(ev, ["bin"], "event_type", ["click", "purchase", "view"], ["value"]).select("bin", F.array_join(F.transform("value", lambda x: F.when(x.isNotNull(), F.format_string("%.2f", x))), ",", "-").alias("marks"))


def _fields(s, d):
    ev = events(s, d).select("event_type", "t", F.least(F.lit(9), F.floor(F.col("value") / 10)).alias("bin"))
    return ev, K.place_fields(ev, ev, "event_type", "bin")


def k27_field_order(s, d):
    return K.units_by_field_peak(_fields(s, d)[1].withColumn("rate", F.round("rate", 9)), "event_type", "bin")


def k28_sort_group_info(s, d):
    e = read(s, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return K.sort_group_info(K.sort_groups(e, "s_nationkey", "s_nationkey", "s_suppkey"), e, "s_nationkey", "s_suppkey")


def k30_reviews(s, d):
    return K.review_counts(read(s, d, "orders"), "o_custkey", F.col("o_orderstatus") == "F")


def b1_training_mask(s, d):
    ev = events(s, d).select("event_id", "event_type", "t", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"))
    return K.training_mask(ev, _parity_days(s, d), C, "t", ["value"], DAY).select("event_id", "is_training")


def b5_interval_decode(s, d):
    from ..operators.intervals import label_by_interval

    ev, fields = _fields(s, d)
    labelled = label_by_interval(ev.withColumn("g", F.lit(0)), _parity_days(s, d).where("event_type = 'click'").select(F.lit(0).alias("g"), "start", "stop"), ["g"], "t", DAY)
    counts = labelled.groupBy("label", "event_type").agg(F.count("*").alias("n"))
    post = K.poisson_posterior(counts, fields, "label", "event_type", "bin").withColumn("p", F.round("p", 9))
    return K.map_bin(post, "label", "bin")


def b7_ahead(s, d):
    xy = _xy(s, d)
    w = Window.partitionBy("user_id").orderBy("idx")
    rows = xy.select("user_id", "idx", F.col("x").alias("at"), F.col("y").alias("place"), (F.lead("x").over(w) - F.col("x")).alias("heading"))
    return K.signed_distance(rows, "place", "at", "heading").select("user_id", "idx", F.round("ahead", 6).alias("ahead"))


def b7_ahead_on_track(s, d):
    w = Window.partitionBy("user_id").orderBy("idx")
    step = lambda c: F.lead(c).over(w) - F.col(c)
    rows = _xy(s, d).select("user_id", "idx", "x", "y", F.col("y").alias("mx"), F.col("x").alias("my"), F.atan2(step("y"), step("x")).alias("heading"))
    made = chains.ahead_on_track(rows, [e[1:] for e in EDGES], "x", "y", "mx", "my", "heading")
    return made.select("user_id", "idx", F.round("ahead", 6).alias("ahead"))


def _envelopes(s, d):
    x = _samples(s, d).select(F.lit(0).alias("g"), "event_type", "idx", "t", "value")
    clock = x.where("event_type = 'click'").select("idx", F.col("t").alias("clock"))
    return x.join(clock, "idx").select("g", "event_type", "idx", F.col("clock").alias("t"), F.round("value", 2).alias("value"))


def _speed(s, d):
    return _samples(s, d).where("event_type = 'click'").select(F.lit(0).alias("g"), "t", (F.col("event_id") % 10).alias("speed"))


def e2_consensus_ripples(s, d):
    found = E.consensus_events(_envelopes(s, d), _speed(s, d), ["g"], "event_type", "idx", "t", "value", "speed", 1.5, 1.0, 1, 6, block=BLOCK)
    return found.select("start", "stop", "samples", F.round("peak", 5).alias("peak"))


def e3_channel_ripples(s, d):
    return E.channel_events(_envelopes(s, d), _speed(s, d), ["g"], "event_type", "idx", "t", "value", "speed", 1.5, 1.5, 0, 6, block=BLOCK).select("start", "stop")


def e6_ripple_inputs(s, d):
    ev = events(s, d).select("event_type", "t", "value").groupBy("event_type", "t").agg(F.max("value").alias("value"))
    days = _parity_days(s, d)
    lfp = ev.withColumn("t", F.col("t") + HOUR // 4)
    return E.ripple_inputs(lfp, ev, days, C, "t", "value")[1].select("event_type", "t", F.round("value", 5).alias("speed"))


def f15_analytic(s, d):
    x = S.analytic(_samples(s, d), C, "idx", "value", 8, 256)
    return x.select("event_type", "idx", F.round("im", 6).alias("im"))


def f16_phase(s, d):
    z = S.phase_and_power(S.analytic(_samples(s, d), C, "idx", "value", 8, 256))
    return z.select("event_type", "idx", F.round("phase", 5).alias("phase"), F.round("power", 4).alias("power"))


def f22_upsample(s, d):
    ev = events(s, d).groupBy("event_type", "t").agg(F.max("value").alias("value"))
    grid = S.time_grid(ev.groupBy("event_type").agg(F.min("t").alias("start"), F.max("t").alias("stop")), C, HOUR)
    both = S.resample(ev.withColumn("t", F.col("t").cast("double")), grid.select("event_type", F.col("t").cast("double").alias("t")), C, "t", "value")
    return both.select("event_type", F.round("t", 0).cast("long").alias("t"), F.round("value", 4).alias("value"))


BAND = S.band_taps(0.05, 0.2, 1.0, 8)


def f33_band_pass(s, d):
    return S.fir_blocks(_samples(s, d), C, "idx", "value", BAND, block=512).select("event_type", "idx", F.round("filtered", 6).alias("filtered"))


def p6_frame_times(s, d):
    poses = read(s, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_orderkey") % 2000).alias("frame"))
    video = read(s, d, "orders").select(F.col("o_orderkey").alias("frame"), (F.col("o_orderkey") * 33).alias("t"))
    positions = s.createDataFrame([(9_900,), (12_000,)], "t long")
    return P.frame_times(poses, video, positions, "frame", "t").select("l_orderkey", "l_linenumber", "frame", "t")


def p9_reject_jumps(s, d):
    return P.reject_jumps(_xy(s, d), ["user_id"], "idx", "x", "y", F.col("x") < 5, 3, 40.0).select("user_id", "idx", "rejected")


def _three(s, d):
    w = Window.partitionBy("user_id").orderBy("idx")
    x = _xy(s, d).withColumn("y", F.floor(F.col("y") / 10))
    return x.select("user_id", "idx", *(F.lag(c, k).over(w).alias(f"{c}{k}") if k else F.col(c).alias(f"{c}0") for k in range(4) for c in ("x", "y")))


def p14_bisector(s, d):
    rows = _three(s, d).withColumn("y2", F.col("y2") + 0.5)
    return P.bisector_orientation(rows, ("x0", "y0"), ("x1", "y1"), ("x2", "y2")).select("user_id", "idx", F.round("orientation", 6).alias("orientation"))


def p17_four_points(s, d):
    rows = _three(s, d)
    for k in range(4):
        rows = rows.withColumns({f"{c}{k}": F.when((F.col("idx") * 7 + k * 3) % (k + 3) != 0, F.col(f"{c}{k}")) for c in ("x", "y")})
    return P.centroid(rows, [(f"x{k}", f"y{k}") for k in range(4)], 60.0).select("user_id", "idx", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))


def p1_two_point_position(s, d):
    w = Window.partitionBy("user_id").orderBy("idx")
    two = _xy(s, d).withColumn("x2", F.lag("x").over(w)).withColumn("y2", F.lag("y").over(w))
    made = P.two_point_position(two, ["user_id"], "t", ("x", "y"), ("x2", "y2"), 0.5, 60.0, 3.0, 24.0, ticks=HOUR)
    return made.select("user_id", "t", *(F.round(c, 7).alias(c) for c in ("x", "y", "speed")))


def p1_two_point_track(s, d):
    w = Window.partitionBy("user_id").orderBy("idx")
    two = _xy(s, d).withColumn("x2", F.lag("x").over(w)).withColumn("y2", F.lag("y").over(w))
    track = P.two_point_track(two, ["user_id"], "idx", ("x", "y"), ("x2", "y2"), 0.5, 60.0, 40.0, 3, 1.0)
    return track.select("user_id", "idx", *(F.round(c, 10).alias(c) for c in ("x", "y", "speed")))


def p19_cohort(s, d):
    ev = events(s, d).groupBy(F.floor(F.col("t") / HOUR).alias("hour"), "event_type").agg(F.max("value").alias("x"), F.count("*").alias("n"))
    parts = {name: ev.where(F.col("event_type") == name).select("hour", "x", "n") for name in ("click", "view")}
    return P.stack_parts(parts, ["hour"])


def p20_with_orientation(s, d):
    xy = _xy(s, d)
    return P.with_orientation(xy.where("idx % 3 <> 0").select("user_id", "idx", "x", "y"), xy.where("idx % 2 = 0").select("user_id", "idx", (F.col("x") / 100).alias("orientation")), ["user_id", "idx"])


def _poses(s, d):
    return _samples(s, d).select(F.lit(0).alias("series"), F.col("idx").alias("frame"), F.col("event_type").alias("part"), F.col("value").alias("x"), (F.col("event_id") % 50).cast("double").alias("y"))


def p23_normalise(s, d):
    n = P.normalise_pose(_poses(s, d), ["series"], "frame", "part", ["click", "view"], ["purchase"])
    return n.select("frame", "part", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def p24_keypoints(s, d):
    k = P.keypoints(_poses(s, d), ["series", "frame"], "part", ["click", "error", "view"], ["x", "y"])
    return k.select("frame", *(F.array_join(F.transform(c, lambda v: F.when(v.isNotNull(), F.format_string("%.2f", v))), ",", "-").alias(c) for c in ("x", "y")))


def p27_pose_group(s, d):
    return P.missing_parts(events(s, d).where("user_id is not null"), ["user_id"], "event_type", ["click", "purchase", "error"])


def l3_linear_slice(s, d):
    track = P.edge_layout(s.createDataFrame(EDGES, "edge int, x1 double, y1 double, x2 double, y2 double"), 15.0)
    xy = _xy(s, d)
    linear = P.linearise(xy, track, ["user_id", "idx"], "x", "y")
    a, b = xy.agg(F.min("t"), F.max("t")).first()
    part = xy.where(F.col("t").between((a or 0) + 5 * DAY, (b or 0) - 5 * DAY))
    return part.select("user_id", "idx", "x").join(linear.select("user_id", "idx", "edge", F.round("linear", 5).alias("linear")), ["user_id", "idx"])


def p16_orientation(s, d):
    a = _xy(s, d).select("user_id", "idx", F.when(F.col("idx") % 6 != 0, (F.col("x") % 100) * (2 * math.pi / 100) - math.pi).alias("a"))
    track = P.orientation_track(a, ["user_id"], "idx", "a", 1.0)  # compared by its sine, as half a turn has two names
    return track.select("user_id", "idx", F.round(F.sin("smoothed"), 4).alias("sine"))


def p18_centroid_track(s, d):
    w = Window.partitionBy("user_id").orderBy("idx")
    two = _xy(s, d).withColumn("x2", F.lag("x").over(w)).withColumn("y2", F.lag("y").over(w))
    return P.centroid_track(two, ["user_id"], "idx", [("x", "y"), ("x2", "y2")], 50.0, 3, 1.0).select("user_id", "idx", *(F.round(c, 10).alias(c) for c in ("cx", "cy", "speed")))


def p22_numbered_track(s, d):
    w = Window.partitionBy("user_id").orderBy("idx")
    two = _xy(s, d).withColumn("x2", F.lag("x").over(w)).withColumn("y2", F.lag("y").over(w))
    track = P.numbered_track(P.two_point_track(two, ["user_id"], "idx", ("x", "y"), ("x2", "y2"), 0.5, 60.0, 40.0, 3, 1.0), ["user_id"], "idx")
    return track.select("user_id", "video_frame", F.round("velocity_x", 10).alias("velocity_x"))


def p25_behaviour_rows(s, d):
    ev = events(s, d).withColumn("heading", F.col("value") / 7).withColumn("state", F.col("value") / 3)
    return P.behaviour_rows(ev, ["event_id"], "event_type", ["heading", "state"])


def w3_full_waveform(s, d):
    return K.full_waveform(_waves(s, d), "vec_id", "w", 4).select("vec_id", F.array_join("feature", ",").alias("feature"))


def b8_clusterless(s, d):
    ev = events(s, d).where("user_id is not null").select("event_id", "event_type", (F.col("user_id") % 10).alias("bin"), F.array("value", (F.col("event_id") % 100).cast("double")).alias("mark"))
    found = K.clusterless_likelihood(ev, ev, ["event_id"], C, "mark", "bin", 4.0)
    return found.select("event_id", "bin", F.round("likelihood", 6).alias("likelihood"))


def f35_whitening(s, d):
    days = events(s, d).groupBy(F.floor(F.col("t") / DAY).alias("day"), "event_type").agg(F.avg("value").alias("value"))
    kinds = [r[0] for r in days.select("event_type").distinct().orderBy("event_type").collect()]
    return K.whiten(days, "day", "event_type", "value", kinds)


def _walk_chances(places, share):
    """Chances to step between places: near ones more often, and ``share`` of the steps go anywhere."""
    x = np.asarray(places, float)
    near = np.exp(-0.5 * (x[:, None] - x) ** 2)
    return (1 - share) * near / near.sum(axis=1, keepdims=True) + share / len(x)


def _hours_seen(s, d):
    """The position bins, and each hour's chances of them as logarithms."""
    ev, fields = _decode(s, d)
    post = K.poisson_posterior(ev.groupBy("hour", "event_type").agg(F.count("*").alias("n")), fields, "hour", "event_type", "bin")
    bins = [r.bin for r in fields.select("bin").distinct().orderBy("bin").collect()]  # ten at most
    seen = post.groupBy("hour").agg(F.transform(F.array_sort(F.collect_list(F.struct("bin", "p"))), lambda x: F.log(x.p)).alias("seen")).withColumn("g", F.lit(0))
    return bins, seen


def b5_sequences(s, d):
    bins, seen = _hours_seen(s, d)
    start = F.floor(F.col("hour") / 24) * 24
    halves = seen.select("g", start.alias("start"), (start + 11).alias("stop")).distinct()
    found = chains.decode_intervals(seen, halves, ["g"], "hour", "seen", _walk_chances(bins, 0.1), 24)
    both = found.select("hour", F.posexplode(F.arrays_zip("causal", "acausal")).alias("k", "p"))
    return both.select("hour", F.element_at(F.array(*map(F.lit, bins)), F.col("k") + 1).cast("long").alias("bin"), F.round("p.causal", 6).alias("causal"), F.round("p.acausal", 6).alias("acausal"))


def b6_smoother(s, d):
    bins, seen = _hours_seen(s, d)
    found = chains.smooth(numbered(seen, ["g"], ["hour"], "idx"), ["g"], "idx", "seen", _walk_chances(bins, 0.1))
    named = found.join(numbered(seen, ["g"], ["hour"], "idx").select("idx", "hour"), "idx")
    both = named.select("hour", F.posexplode(F.arrays_zip("causal", "acausal")).alias("k", "p"))
    return both.select("hour", F.element_at(F.array(*map(F.lit, bins)), F.col("k") + 1).cast("long").alias("bin"), F.round("p.causal", 6).alias("causal"), F.round("p.acausal", 6).alias("acausal"))


def l2_chain(s, d):
    ends = [(x1, y1, x2, y2) for _, x1, y1, x2, y2 in EDGES]
    return chains.edges_by_chain(_xy(s, d), ends, ["user_id"], "idx", "x", "y", sensor=20.0, scaling=30.0)


def k18_isolation(s, d):
    v = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000))
    spikes = read(s, d, "embeddings").select("vec_id", "label", v.alias("v"))
    return neighbours.isolation(spikes, [], "label", "vec_id", "v", 5, noise=9).select("label", *(F.round(c, 9).alias(c) for c in ("isolation", "noise_overlap")))


QUERIES = {f.__name__: f for f in (k18_isolation, b5_sequences, b7_ahead_on_track, b6_smoother, l2_chain, p9_reject_jumps, p16_orientation, p18_centroid_track, p22_numbered_track, p25_behaviour_rows, w3_full_waveform, b8_clusterless, f35_whitening, k1_spike_samples, k3_firing_rate, k7_model_range, k8_annotations, k11_curations, k13_merge_candidates, k16_snr, k21_burst_pairs, k21_burst_pairs_by_session, w2_peak_amplitude, w2_middle_amplitude, k26_amplitudes, w4_location, w6_features, w9_electrode_marks, k27_field_order, k28_sort_group_info, k30_reviews, b1_training_mask, b5_interval_decode, b7_ahead, e2_consensus_ripples, e3_channel_ripples, e6_ripple_inputs, f15_analytic, f16_phase, f22_upsample, f33_band_pass, p6_frame_times, p14_bisector, p17_four_points, p1_two_point_track, p1_two_point_position, p19_cohort, p20_with_orientation, p23_normalise, p24_keypoints, p27_pose_group, l3_linear_slice)}


def _fir(taps: list[float], name: str) -> str:
    """SQL of a column: the weighted sum of neighbours in the window ``w``."""
    half = len(taps) // 2
    return " + ".join(f"coalesce({'lag' if k >= half else 'lead'}(value, {abs(k - half)}) OVER w, 0) * {h!r}" for k, h in enumerate(taps) if h) + f" AS {name}"


_W = "w AS (SELECT vec_id, label, unnest(range(0, len(embedding))) AS place, unnest(list_transform(embedding, lambda x: round(x::DOUBLE * 1000)::BIGINT)) AS x FROM embeddings)"
_MODAL = f"{_W}, p AS (SELECT vec_id, label, arg_min(place, (x, place)) // 4 AS p FROM w GROUP BY ALL), c AS (SELECT label, p, count(*) AS n FROM p GROUP BY ALL), m AS (SELECT label, arg_max(p, (n, -p)) AS m FROM c GROUP BY label), am AS (SELECT vec_id, w.label, place, x FROM w JOIN m ON w.label = m.label AND place // 4 = m)"
_TR = "tr AS (SELECT (user_id % 10)::INT AS label, t FROM ev WHERE user_id IS NOT NULL)"
_ENV = f"{_SAMPLES}, ck AS (SELECT idx, t, event_id % 10 AS speed FROM sm WHERE event_type = 'click'), en AS (SELECT event_type, sm.idx, ck.t, round(value, 2) AS value FROM sm JOIN ck USING (idx))"
_3 = f"{_XY}, tp AS (SELECT user_id, idx, " + ", ".join(f"lag(x, {k}) OVER w AS x{k}, lag(floor(y / 10), {k}) OVER w AS y{k}" for k in range(4)) + " FROM xy WINDOW w AS (PARTITION BY user_id ORDER BY idx))"
_DIST = lambda a, b: f"sqrt((x{a} - x{b}) * (x{a} - x{b}) + (y{a} - y{b}) * (y{a} - y{b})) < 60"


def _four(c: str) -> str:
    return f"""CASE WHEN f AND c AND {_DIST(0, 1)} THEN ({c}0 + {c}1) / 2 WHEN f AND NOT c AND l AND r AND {_DIST(2, 3)} AND {_DIST(2, 0)} AND {_DIST(3, 0)} THEN (({c}2 + {c}3) / 2 + {c}0) / 2
WHEN NOT f AND NOT c AND l AND r AND {_DIST(2, 3)} THEN ({c}2 + {c}3) / 2 WHEN f AND NOT c AND l AND NOT r AND {_DIST(2, 0)} THEN ({c}2 + {c}0) / 2 WHEN f AND NOT c AND r AND NOT l AND {_DIST(3, 0)} THEN ({c}3 + {c}0) / 2 WHEN NOT f AND c THEN {c}1 END"""


ORACLES = {
    # as b6, but the first half of each day begins anew
    "b5_sequences": sql(f"""{_POST}, pv AS (SELECT hour, list(p ORDER BY bin) AS l, row_number() OVER (ORDER BY hour) AS i, lag(hour // 24) OVER (ORDER BY hour) IS DISTINCT FROM hour // 24 AS f FROM po WHERE hour % 24 < 12 GROUP BY hour), bn AS (SELECT list(bin ORDER BY bin) AS b FROM (SELECT DISTINCT bin FROM fd)),
tm AS (SELECT b, list_transform(b, lambda x: list_transform(b, lambda y: 0.9 * exp(-0.5 * (x - y) * (x - y)) / list_sum(list_transform(b, lambda z: exp(-0.5 * (x - z) * (x - z)))) + 0.1 / len(b))) AS m FROM bn),
fw(i, a) AS (SELECT i, list_transform(l, lambda x: x / list_sum(l)) FROM pv WHERE i = 1
  UNION ALL SELECT i, list_transform(u, lambda x: x / list_sum(u)) FROM (SELECT pv.i, list_transform(range(1, len(b) + 1), lambda j: l[j] * CASE WHEN f THEN 1.0 ELSE list_sum(list_transform(range(1, len(b) + 1), lambda k: a[k] * m[k][j])) END) AS u FROM fw JOIN pv ON pv.i = fw.i + 1, tm)),
bw(i, a) AS (SELECT max(i), list_transform(any_value(b), lambda x: 1.0::DOUBLE) FROM pv, tm
  UNION ALL SELECT i, list_transform(u, lambda x: x / list_sum(u)) FROM (SELECT pv.i - 1 AS i, list_transform(range(1, len(b) + 1), lambda k: CASE WHEN f THEN 1.0 ELSE list_sum(list_transform(range(1, len(b) + 1), lambda j: m[k][j] * l[j] * a[j])) END) AS u FROM bw JOIN pv ON pv.i = bw.i, tm WHERE pv.i > 1)),
z AS (SELECT hour, b, fw.a AS f, list_transform(range(1, len(b) + 1), lambda k: fw.a[k] * bw.a[k]) AS g FROM pv JOIN fw USING (i) JOIN bw USING (i), tm)
SELECT hour, b[k] AS bin, round(f[k], 6) AS causal, round(g[k] / list_sum(g), 6) AS acausal FROM (SELECT *, unnest(range(1, len(b) + 1)) AS k FROM z)""").replace("WITH ", "WITH RECURSIVE ", 1),
    "b6_smoother": sql(f"""{_POST}, pv AS (SELECT hour, list(p ORDER BY bin) AS l, row_number() OVER (ORDER BY hour) AS i FROM po GROUP BY hour), bn AS (SELECT list(bin ORDER BY bin) AS b FROM (SELECT DISTINCT bin FROM fd)),
tm AS (SELECT b, list_transform(b, lambda x: list_transform(b, lambda y: 0.9 * exp(-0.5 * (x - y) * (x - y)) / list_sum(list_transform(b, lambda z: exp(-0.5 * (x - z) * (x - z)))) + 0.1 / len(b))) AS m FROM bn),
fw(i, a) AS (SELECT i, list_transform(l, lambda x: x / list_sum(l)) FROM pv WHERE i = 1
  UNION ALL SELECT i, list_transform(u, lambda x: x / list_sum(u)) FROM (SELECT pv.i, list_transform(range(1, len(b) + 1), lambda j: l[j] * list_sum(list_transform(range(1, len(b) + 1), lambda k: a[k] * m[k][j]))) AS u FROM fw JOIN pv ON pv.i = fw.i + 1, tm)),
bw(i, a) AS (SELECT max(i), list_transform(any_value(b), lambda x: 1.0::DOUBLE) FROM pv, tm
  UNION ALL SELECT i, list_transform(u, lambda x: x / list_sum(u)) FROM (SELECT pv.i - 1 AS i, list_transform(range(1, len(b) + 1), lambda k: list_sum(list_transform(range(1, len(b) + 1), lambda j: m[k][j] * l[j] * a[j]))) AS u FROM bw JOIN pv ON pv.i = bw.i, tm WHERE pv.i > 1)),
z AS (SELECT hour, b, fw.a AS f, list_transform(range(1, len(b) + 1), lambda k: fw.a[k] * bw.a[k]) AS g FROM pv JOIN fw USING (i) JOIN bw USING (i), tm)
SELECT hour, b[k] AS bin, round(f[k], 6) AS causal, round(g[k] / list_sum(g), 6) AS acausal FROM (SELECT *, unnest(range(1, len(b) + 1)) AS k FROM z)""").replace("WITH ", "WITH RECURSIVE ", 1),
    "k1_spike_samples": sql(f"""s AS (SELECT event_type, t FROM ev), n AS (SELECT event_type, count(*) AS n FROM s GROUP BY 1), u AS (SELECT event_type, t + {HOUR} AS x, 0 AS k FROM ev UNION ALL SELECT event_type, t, 1 FROM s),
c AS (SELECT *, sum(k) OVER (PARTITION BY event_type ORDER BY x, k RANGE UNBOUNDED PRECEDING) AS p FROM u) SELECT c.event_type, x AS t, p::BIGINT AS position FROM c JOIN n USING (event_type) WHERE k = 0 AND p < n"""),
    "k3_firing_rate": sql(f"""a AS (SELECT min(t) AS a, max(t) AS b FROM ev), c AS (SELECT event_type, (t - a) // {DAY} AS bin, count(*) AS n FROM ev, a GROUP BY ALL), g AS (SELECT event_type, unnest(range(0, (b - a) // {DAY} + 2)) AS bin FROM (SELECT DISTINCT event_type FROM ev), a),
i AS (SELECT g.event_type, g.bin, coalesce(n, 0)::DOUBLE AS x FROM g LEFT JOIN c ON c.event_type = g.event_type AND c.bin = g.bin), {smoothed("i", "sg", "x", "bin", 1.5, "event_type")} SELECT event_type, bin, round(y / 86400 * 1000, 6) AS rate FROM sg"""),
    "k7_model_range": sql("r AS (SELECT event_type, min(t) AS a, max(t) AS b FROM ev WHERE value > 60 GROUP BY 1) SELECT event_id, event_type, t FROM ev JOIN r USING (event_type) WHERE t BETWEEN a AND b"),
    "k8_annotations": "SELECT DISTINCT l_suppkey AS unit, 'return' AS annotation, l_linestatus AS label, l_linenumber AS quantity FROM lineitem WHERE l_returnflag = 'R'",
    "k11_curations": """WITH o AS (SELECT o_custkey AS sorting, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), p AS (SELECT o_custkey AS sorting, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders WHERE o_orderstatus = 'P')
SELECT p.sorting, o_orderkey, CASE WHEN n IS NOT NULL OR k > 1 THEN 0 ELSE -1 END AS parent, (coalesce(n, 0) + k - 1)::INT AS curation_id FROM p LEFT JOIN o USING (sorting)""",
    "k13_merge_candidates": "WITH h AS (SELECT a.s_suppkey AS unit, b.s_suppkey AS o FROM supplier a JOIN supplier b USING (s_nationkey) WHERE a.s_suppkey <> b.s_suppkey AND abs(a.s_acctbal - b.s_acctbal) < 800) SELECT s_suppkey AS unit, coalesce(string_agg(o::VARCHAR, ',' ORDER BY o), '') AS partners FROM supplier LEFT JOIN h ON unit = s_suppkey GROUP BY s_suppkey",
    "k16_snr": f"WITH {_W}, m AS (SELECT label, place, avg(x) AS m FROM w GROUP BY ALL), p AS (SELECT label, arg_min(place, (m, place)) AS place, min(m) AS peak FROM m GROUP BY label), md AS (SELECT place % 4 AS channel, median(x) AS md FROM w GROUP BY 1), no AS (SELECT place % 4 AS channel, median(abs(x - md)) * 1.4826 AS no FROM w JOIN md ON md.channel = place % 4 GROUP BY 1) SELECT label, channel, round(abs(peak) / no, 6) AS snr FROM p JOIN no ON channel = place % 4",
    "k21_burst_pairs": sql(f"""{_W}, m AS (SELECT label, place, avg(x) AS m FROM w GROUP BY ALL), si AS (SELECT a.label AS a, b.label AS b, corr(a.m, b.m) AS s FROM m a JOIN m b ON a.place = b.place AND a.label <> b.label GROUP BY ALL), {_TR},
d AS (SELECT a, b, t - lag(t) OVER (PARTITION BY a, b ORDER BY t) AS d FROM si JOIN tr ON label IN (a, b)), i AS (SELECT a, b, count(*) FILTER (d < {HOUR}) / count(*) AS f FROM d GROUP BY ALL),
c AS (SELECT a.label AS a, b.label AS b, (count(*) FILTER (b.t >= a.t) - count(*) FILTER (b.t < a.t)) / count(*) AS s FROM tr a JOIN tr b ON a.label <> b.label AND b.t - a.t >= {-HOUR // 2} AND b.t - a.t < {HOUR // 2} GROUP BY ALL)
SELECT si.a, si.b, round(si.s, 6) AS similarity, round(f, 6) AS isi_violation, round(coalesce(c.s, 0), 6) AS asymmetry FROM si JOIN i ON i.a = si.a AND i.b = si.b LEFT JOIN c ON c.a = si.a AND c.b = si.b"""),
    "k21_burst_pairs_by_session": sql(f"""{_W}, m AS (SELECT vec_id % 3 AS session, label, place, avg(x) AS m FROM w GROUP BY ALL), si AS (SELECT a.session, a.label AS a, b.label AS b, corr(a.m, b.m) AS s FROM m a JOIN m b ON a.session = b.session AND a.place = b.place AND a.label <> b.label GROUP BY ALL),
tr AS (SELECT event_id % 3 AS session, (user_id % 10)::INT AS label, t FROM ev WHERE user_id IS NOT NULL), d AS (SELECT si.session, a, b, t - lag(t) OVER (PARTITION BY si.session, a, b ORDER BY t) AS d FROM si JOIN tr ON tr.session = si.session AND label IN (a, b)), i AS (SELECT session, a, b, count(*) FILTER (d < {HOUR}) / count(*) AS f FROM d GROUP BY ALL),
c AS (SELECT a.session, a.label AS a, b.label AS b, (count(*) FILTER (b.t >= a.t) - count(*) FILTER (b.t < a.t)) / count(*) AS s FROM tr a JOIN tr b ON a.session = b.session AND a.label <> b.label AND b.t - a.t >= {-HOUR // 2} AND b.t - a.t < {HOUR // 2} GROUP BY ALL)
SELECT session, a, b, round(si.s, 6) AS similarity, round(f, 6) AS isi_violation, round(coalesce(c.s, 0), 6) AS asymmetry FROM si JOIN i USING (session, a, b) LEFT JOIN c USING (session, a, b)"""),
    "w2_peak_amplitude": f"WITH {_MODAL} SELECT vec_id, string_agg(x::VARCHAR, ',' ORDER BY place) AS amplitude FROM am GROUP BY vec_id",
    "w2_middle_amplitude": f"WITH {_W} SELECT vec_id, string_agg(x::VARCHAR, ',' ORDER BY place) AS amplitude FROM w WHERE place // 4 = 8 GROUP BY vec_id",
    "k26_amplitudes": sql(f"{_MODAL}, a0 AS (SELECT vec_id, label, min(x) AS amplitude FROM am GROUP BY ALL), a AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS k FROM a0), {_TR}, n AS (SELECT label, t, row_number() OVER (PARTITION BY label ORDER BY t) AS k FROM tr) SELECT n.label, k::INT AS k, t, amplitude FROM n JOIN a USING (label, k)"),
    "w4_location": f"WITH {_W} SELECT vec_id, round(sum(abs(x) * (place % 2) * 10.0) / sum(abs(x)), 6) AS x, round(sum(abs(x) * (place % 4 // 2) * 20.0) / sum(abs(x)), 6) AS y FROM w WHERE place // 4 = 8 GROUP BY vec_id HAVING sum(abs(x)) > 0",
    "w6_features": f"WITH {_W} SELECT vec_id, vec_id * 1000 AS t, string_agg(x::VARCHAR, ',' ORDER BY place < 32, place) AS features FROM w WHERE (place // 4 = 8 OR place < 2) AND vec_id BETWEEN 20 AND 300 GROUP BY vec_id",
    "w9_electrode_marks": sql(f"m AS (SELECT t // {DAY} AS bin, event_type, round(max(value), 6) AS v FROM ev WHERE event_type IN ('click', 'purchase', 'view') GROUP BY ALL), f AS (SELECT bin, max(v) FILTER (event_type = 'click') AS a, max(v) FILTER (event_type = 'purchase') AS b, max(v) FILTER (event_type = 'view') AS c FROM m GROUP BY bin) SELECT bin, " + " || ',' || ".join(f"coalesce(printf('%.2f', {c}), '-')" for c in "abc") + " AS marks FROM f"),
    "k27_field_order": sql("de AS (SELECT event_type, least(9, floor(value / 10))::BIGINT AS bin FROM ev), oc AS (SELECT bin, count(*) AS o FROM de GROUP BY bin), ct AS (SELECT event_type, bin, count(*) AS n FROM de GROUP BY ALL), fd AS (SELECT u.event_type, oc.bin, round((coalesce(n, 0) + 1e-3) / o, 9) AS rate FROM (SELECT DISTINCT event_type FROM de) u CROSS JOIN oc LEFT JOIN ct ON ct.event_type = u.event_type AND ct.bin = oc.bin), p AS (SELECT event_type, arg_max(bin, (rate, -bin)) AS peak FROM fd GROUP BY 1) SELECT event_type, peak, (row_number() OVER (ORDER BY peak, event_type) - 1)::INT AS rank FROM p"),
    "k28_sort_group_info": "WITH g AS (SELECT s_nationkey AS n, min(s_suppkey) AS s_suppkey, (row_number() OVER (ORDER BY s_nationkey) - 1)::INT AS sort_group FROM supplier GROUP BY 1 HAVING count(*) > 1) SELECT s_suppkey, sort_group, s_name, s_nationkey FROM g JOIN supplier USING (s_suppkey)",
    "k30_reviews": "SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS reviewed, count(*) FILTER (o_orderstatus <> 'F') AS unreviewed FROM orders GROUP BY 1",
    "b1_training_mask": sql(f"SELECT event_id, t % {DAY} <= {DAY // 2} AND event_id % 7 <> 0 AND value IS NOT NULL AS is_training FROM ev".replace("SELECT", "z AS (SELECT 1) SELECT", 1)),
    "b5_interval_decode": sql(f"""{_DAYS}, cl AS (SELECT DISTINCT start, stop FROM pd WHERE event_type = 'click'), de AS (SELECT event_type, t, least(9, floor(value / 10))::BIGINT AS bin FROM ev), oc AS (SELECT bin, count(*) AS o FROM de GROUP BY bin), ct AS (SELECT event_type, bin, count(*) AS n FROM de GROUP BY ALL),
fd AS (SELECT u.event_type, oc.bin, (coalesce(n, 0) + 1e-3) / o AS rate FROM (SELECT DISTINCT event_type FROM de) u CROSS JOIN oc LEFT JOIN ct ON ct.event_type = u.event_type AND ct.bin = oc.bin), la AS (SELECT dense_rank() OVER (ORDER BY start) - 1 AS label, event_type FROM de JOIN cl ON t BETWEEN start AND stop),
cn AS (SELECT label, event_type, count(*) AS n FROM la GROUP BY ALL), li AS (SELECT label, bin, sum(n * ln(rate)) AS l FROM cn JOIN fd USING (event_type) GROUP BY ALL), si AS (SELECT bin, sum(rate) AS r FROM fd GROUP BY bin), ll AS (SELECT label, bin, l - r AS x FROM li JOIN si USING (bin)),
ex AS (SELECT label, bin, exp(x - max(x) OVER (PARTITION BY label)) AS e FROM ll), po AS (SELECT label, bin, round(e / sum(e) OVER (PARTITION BY label), 9) AS p FROM ex) SELECT label::INT AS label, arg_max(bin, (p, -bin)) AS map_bin FROM po GROUP BY label"""),
    # the track is one line of three edges, so a place on it is a number and the way is a difference
    "b7_ahead_on_track": sql(f"""{_XY}, h AS (SELECT *, atan2(lead(y) OVER w - y, lead(x) OVER w - x) AS h FROM xy WINDOW w AS (PARTITION BY user_id ORDER BY idx)), e(e, x1, y1, ex, ey) AS (VALUES (0, 0, 0, 100, 0), (1, 100, 0, 0, 100), (2, 100, 100, -100, 0)),
p AS (SELECT user_id, idx, h, x, y, 'at' AS what FROM h UNION ALL SELECT user_id, idx, h, y, x, 'to' FROM h), s AS (SELECT *, greatest(0, least(1, ((x - x1) * ex + (y - y1) * ey) / 10000)) AS s FROM p, e),
n AS (SELECT *, sqrt(pow(x - x1 - s * ex, 2) + pow(y - y1 - s * ey, 2)) AS far FROM s QUALIFY row_number() OVER (PARTITION BY user_id, idx, what ORDER BY far, e) = 1),
b AS (SELECT user_id, idx, max(100 * (e + s)) FILTER (what = 'to') - max(100 * (e + s)) FILTER (what = 'at') AS gone, max(cos(h) * ex + sin(h) * ey) FILTER (what = 'at') AS ahead FROM n GROUP BY ALL)
SELECT user_id, idx, round(CASE WHEN ahead >= -1e-7 THEN gone WHEN ahead < -1e-7 THEN -gone END, 6) + 0.0 AS ahead FROM b"""),
    # neighbours of each vector in each label, then among its own label and one other
    "k18_isolation": """WITH v AS (SELECT vec_id AS i, label AS l, list_transform(embedding, lambda x: round(x::DOUBLE * 1000)) AS v FROM embeddings),
d AS (SELECT a.i, a.l AS own, b.l, b.i AS j, round(pow(list_distance(a.v, b.v), 2)) AS d FROM v a JOIN v b ON a.i <> b.i), n AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY i, l ORDER BY d, j) <= 5),
p AS (SELECT n.*, o.l AS other FROM n JOIN (SELECT DISTINCT l FROM v) o ON o.l <> n.own AND n.l IN (n.own, o.l)), t AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY i, other ORDER BY d, j) <= 5),
s AS (SELECT i, own, other, avg((l = own)::INT) AS s FROM t GROUP BY ALL), m AS (SELECT own, least(own, other) AS a, greatest(own, other) AS b, avg(s) AS s FROM s GROUP BY ALL), q AS (SELECT a, b, avg(s) AS s FROM m GROUP BY ALL),
e AS (SELECT a AS label, b AS o, s FROM q UNION ALL SELECT b, a, s FROM q) SELECT label, round(min(s) FILTER (o <> 9), 9) AS isolation, round(1 - min(s) FILTER (o = 9), 9) AS noise_overlap FROM e WHERE label <> 9 GROUP BY label""",
    "b7_ahead": sql(f"{_XY} SELECT user_id, idx, round((y - x) * sign(lead(x) OVER w - x), 6) AS ahead FROM xy WINDOW w AS (PARTITION BY user_id ORDER BY idx)"),
    "e2_consensus_ripples": sql(f"""{_ENV}, nc AS (SELECT count(DISTINCT event_type) AS n FROM en), p AS (SELECT 0 AS g, idx, t, sum(value * value) AS x FROM en GROUP BY ALL HAVING count(*) = (SELECT n FROM nc)), {smoothed("p", "sg", "x", "idx", 1.5)},
z AS (SELECT *, (sqrt(y) - avg(sqrt(y)) OVER ()) / stddev_pop(sqrt(y)) OVER () AS z FROM sg), {above_mean("z", "am", "g", "idx", "t", 1.0, 1)}, sl AS (SELECT t FROM ck WHERE speed <= 6)
SELECT start, stop, samples, round(peak, 5) AS peak FROM am WHERE start IN (SELECT t FROM sl) AND stop IN (SELECT t FROM sl)"""),
    "e3_channel_ripples": sql(f"""{_ENV}, {smoothed("en", "sg", "value", "idx", 1.5, "event_type")}, z AS (SELECT *, (y - avg(y) OVER (PARTITION BY event_type)) / stddev_pop(y) OVER (PARTITION BY event_type) AS z FROM sg), {above_mean("z", "am", "event_type", "idx", "t", 1.5, 0)},
f AS (SELECT start, stop, max(stop) OVER (ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM (SELECT DISTINCT start, stop FROM am)), k AS (SELECT *, sum((far IS NULL OR start > far)::INT) OVER (ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS m FROM f), o AS (SELECT min(start) AS start, max(stop) AS stop FROM k GROUP BY m), sl AS (SELECT t FROM ck WHERE speed <= 6)
SELECT start, stop FROM o WHERE start IN (SELECT t FROM sl) AND stop IN (SELECT t FROM sl)"""),
    "e6_ripple_inputs": sql(f"""e0 AS (SELECT event_type, t, max(value) AS value FROM ev GROUP BY ALL), {_DAYS}, po AS (SELECT * FROM e0 WHERE t % {DAY} <= {DAY // 2}), gr AS (SELECT DISTINCT e.event_type, e.t + {HOUR // 4} AS t FROM e0 e JOIN pd ON pd.event_type = e.event_type AND e.t + {HOUR // 4} BETWEEN start AND stop),
u AS (SELECT event_type, t, max(value) AS value, max(g) AS g FROM (SELECT event_type, t, value, 0 AS g FROM po UNION ALL SELECT event_type, t, NULL, 1 FROM gr) GROUP BY ALL),
z AS (SELECT *, last_value(value IGNORE NULLS) OVER a AS av, last_value(CASE WHEN value IS NOT NULL THEN t END IGNORE NULLS) OVER a AS ta, first_value(value IGNORE NULLS) OVER b AS bv, first_value(CASE WHEN value IS NOT NULL THEN t END IGNORE NULLS) OVER b AS tb FROM u
WINDOW a AS (PARTITION BY event_type ORDER BY t ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY event_type ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) SELECT event_type, t, round(coalesce(value, av + (bv - av) * ((t - ta) / (tb - ta)), av), 5) AS speed FROM z WHERE g = 1"""),
    "f15_analytic": sql(f"{_SAMPLES} SELECT event_type, idx, round(im, 6) AS im FROM (SELECT event_type, idx, {_fir(S.hilbert_taps(8), 'im')} FROM sm WINDOW w AS (PARTITION BY event_type ORDER BY idx))"),
    "f16_phase": sql(f"{_SAMPLES} SELECT event_type, idx, round(atan2(im, value) + {math.pi!r}, 5) AS phase, round(value * value + im * im, 4) AS power FROM (SELECT event_type, idx, value, {_fir(S.hilbert_taps(8), 'im')} FROM sm WINDOW w AS (PARTITION BY event_type ORDER BY idx))"),
    "f22_upsample": sql(f"""e0 AS (SELECT event_type, t::DOUBLE AS t, max(value) AS value FROM ev GROUP BY ALL), h AS (SELECT event_type, min(t) AS a, max(t) AS b, greatest(1, ceil((max(t) - min(t)) / {HOUR}))::BIGINT AS n FROM e0 GROUP BY 1), gi AS (SELECT event_type, a, b, n, unnest(range(0, n + 1)) AS i FROM h), gr AS (SELECT event_type, a + (b - a) * i / n AS t FROM gi),
u AS (SELECT event_type, t, max(value) AS value, max(g) AS g FROM (SELECT event_type, t, value, 0 AS g FROM e0 UNION ALL SELECT event_type, t, NULL, 1 FROM gr) GROUP BY ALL),
z AS (SELECT *, last_value(value IGNORE NULLS) OVER a AS av, last_value(CASE WHEN value IS NOT NULL THEN t END IGNORE NULLS) OVER a AS ta, first_value(value IGNORE NULLS) OVER b AS bv, first_value(CASE WHEN value IS NOT NULL THEN t END IGNORE NULLS) OVER b AS tb FROM u
WINDOW a AS (PARTITION BY event_type ORDER BY t ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY event_type ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) SELECT event_type, round(t, 0)::BIGINT AS t, round(coalesce(value, av + (bv - av) * ((t - ta) / (tb - ta)), av), 4) AS value FROM z WHERE g = 1"""),
    "f33_band_pass": sql(f"{_SAMPLES} SELECT event_type, idx, round(y, 6) AS filtered FROM (SELECT event_type, idx, {_fir(BAND, 'y')} FROM sm WINDOW w AS (PARTITION BY event_type ORDER BY idx))"),
    "p6_frame_times": "SELECT l_orderkey, l_linenumber, l_orderkey % 2000 AS frame, o_orderkey * 33 AS t FROM lineitem JOIN orders ON o_orderkey = l_orderkey % 2000 WHERE o_orderkey * 33 >= 9900",
    "p14_bisector": sql(f"{_3} SELECT user_id, idx, round(CASE WHEN y0 = y1 THEN CASE WHEN y2 + 0.5 > y0 THEN {math.pi / 2!r} WHEN y2 + 0.5 < y0 THEN {-math.pi / 2!r} END ELSE atan2(x0 - x1, -(y0 - y1)) END, 6) AS orientation FROM tp"),
    "p17_four_points": sql(f"{_3}, q AS (SELECT user_id, idx, " + ", ".join(f"CASE WHEN (idx * 7 + {k * 3}) % {k + 3} <> 0 THEN {c}{k} END AS {c}{k}" for k in range(4) for c in "xy") + f" FROM tp), b AS (SELECT *, x0 IS NOT NULL AS f, x1 IS NOT NULL AS c, x2 IS NOT NULL AS l, x3 IS NOT NULL AS r FROM q) SELECT user_id, idx, round({_four('x')}, 6) AS cx, round({_four('y')}, 6) AS cy FROM b"),
    "p19_cohort": sql(f"m AS (SELECT t // {HOUR} AS hour, event_type, max(value) AS x, count(*) AS n FROM ev WHERE event_type IN ('click', 'view') GROUP BY ALL) SELECT hour, max(x) FILTER (event_type = 'click') AS click_x, max(n) FILTER (event_type = 'click') AS click_n, max(x) FILTER (event_type = 'view') AS view_x, max(n) FILTER (event_type = 'view') AS view_n FROM m GROUP BY hour"),
    "p20_with_orientation": sql(f"{_XY} SELECT user_id, idx, CASE WHEN idx % 3 <> 0 THEN x END AS x, CASE WHEN idx % 3 <> 0 THEN y END AS y, CASE WHEN idx % 2 = 0 THEN x / 100 END AS orientation FROM xy WHERE idx % 3 <> 0 OR idx % 2 = 0"),
    "p23_normalise": sql(f"""{_SAMPLES}, p AS (SELECT idx AS frame, event_type AS part, value AS x, (event_id % 50)::DOUBLE AS y FROM sm), c AS (SELECT frame, avg(x) AS cx, avg(y) AS cy, sqrt(pow(avg(x) FILTER (part IN ('click', 'view')) - avg(x) FILTER (part = 'purchase'), 2) + pow(avg(y) FILTER (part IN ('click', 'view')) - avg(y) FILTER (part = 'purchase'), 2)) AS l FROM p GROUP BY frame), m AS (SELECT avg(l) AS m FROM c)
SELECT frame, part, round((x - cx) / m + cx, 6) AS x, round((y - cy) / m + cy, 6) AS y FROM p JOIN c USING (frame), m"""),
    "p24_keypoints": sql(f"{_SAMPLES}, p AS (SELECT idx AS frame, event_type AS part, value AS x, (event_id % 50)::DOUBLE AS y FROM sm WHERE event_type IN ('click', 'error', 'view')) SELECT frame, " + ", ".join(" || ',' || ".join(f"coalesce(printf('%.2f', max({c}) FILTER (part = '{n}')), '-')" for n in ("click", "error", "view")) + f" AS {c}" for c in "xy") + " FROM p GROUP BY frame"),
    "p27_pose_group": "WITH u AS (SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL), w AS (SELECT user_id, unnest(['click', 'purchase', 'error']) AS event_type FROM u) SELECT * FROM w EXCEPT SELECT user_id, event_type FROM events",
    "p1_two_point_track": sql(f"""{_XY}, a0 AS (SELECT user_id, idx, x * 0.5 AS a, y * 0.5 AS b, lag(x * 0.5) OVER w AS c, lag(y * 0.5) OVER w AS d FROM xy WINDOW w AS (PARTITION BY user_id ORDER BY idx)),
a1 AS (SELECT user_id, idx, {", ".join(f"CASE WHEN NOT coalesce(sqrt((a - c) * (a - c) + (b - d) * (b - d)) >= 60, false) THEN {v} END AS {v}" for v in "abcd")} FROM a0),
a2 AS (SELECT *, {" OR ".join(f"coalesce(sqrt(pow({u} - lag({u}) OVER w, 2) + pow({v} - lag({v}) OVER w, 2)) > 40, false)" for u, v in ("ab", "cd"))} AS fast FROM a1 WINDOW w AS (PARTITION BY user_id ORDER BY idx)), a3 AS (SELECT user_id, idx, {", ".join(f"CASE WHEN NOT fast THEN {v} END AS {v}" for v in "abcd")} FROM a2),
a4 AS (SELECT *, {", ".join(f"last_value({v} IGNORE NULLS) OVER p AS {v}l, last_value(CASE WHEN {v} IS NOT NULL THEN idx END IGNORE NULLS) OVER p AS {v}i, first_value({v} IGNORE NULLS) OVER n AS {v}r, first_value(CASE WHEN {v} IS NOT NULL THEN idx END IGNORE NULLS) OVER n AS {v}j" for v in "abcd")} FROM a3
WINDOW p AS (PARTITION BY user_id ORDER BY idx ROWS UNBOUNDED PRECEDING), n AS (PARTITION BY user_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), a5 AS (SELECT user_id, idx, {", ".join(f"coalesce({v}, {v}l + ({v}r - {v}l) * ((idx - {v}i) / ({v}j - {v}i))) AS {v}" for v in "abcd")} FROM a4),
a6 AS (SELECT user_id, idx, {", ".join(f"avg({v}) OVER m AS {v}" for v in "abcd")} FROM a5 WINDOW m AS (PARTITION BY user_id ORDER BY idx ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)), a7 AS (SELECT user_id, idx, (a + c) / 2 AS x, (b + d) / 2 AS y, row_number() OVER (PARTITION BY user_id ORDER BY idx) AS n FROM a6),
a8 AS (SELECT *, greatest(1, coalesce(lead(n) OVER w, n) - coalesce(lag(n) OVER w, n)) AS s, coalesce(lead(x) OVER w, x) - coalesce(lag(x) OVER w, x) AS dx, coalesce(lead(y) OVER w, y) - coalesce(lag(y) OVER w, y) AS dy FROM a7 WINDOW w AS (PARTITION BY user_id ORDER BY idx))
SELECT user_id, idx, round(x, 10) AS x, round(y, 10) AS y, round(sqrt(dx / s * (dx / s) + dy / s * (dy / s)), 10) AS speed FROM a8"""),
    "l3_linear_slice": SIGNAL["l1_linearise"].replace("SELECT user_id, idx, arg_min", f", q AS (SELECT min(t) + {5 * DAY} AS a, max(t) - {5 * DAY} AS b FROM ev), l AS (SELECT user_id, idx, arg_min").replace("AS linear FROM m GROUP BY user_id, idx", "AS linear FROM m GROUP BY user_id, idx) SELECT l.user_id, l.idx, xy.x, l.edge, l.linear FROM l JOIN xy ON xy.user_id = l.user_id AND xy.idx = l.idx, q WHERE t BETWEEN a AND b"),
    "p16_orientation": sql(f"""{_XY}, a AS (SELECT user_id, idx, CASE WHEN idx % 6 <> 0 THEN (x % 100) * {2 * math.pi / 100!r} - {math.pi!r} END AS a FROM xy), l AS (SELECT *, last_value(a IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM a),
u AS (SELECT user_id, idx, a - {2 * math.pi!r} * sum(coalesce(round((a - p) / {2 * math.pi!r}), 0)) OVER (PARTITION BY user_id ORDER BY idx ROWS UNBOUNDED PRECEDING) AS u FROM l),
z AS (SELECT *, last_value(u IGNORE NULLS) OVER q AS ul, last_value(CASE WHEN u IS NOT NULL THEN idx END IGNORE NULLS) OVER q AS ui, first_value(u IGNORE NULLS) OVER n AS ur, first_value(CASE WHEN u IS NOT NULL THEN idx END IGNORE NULLS) OVER n AS uj FROM u
WINDOW q AS (PARTITION BY user_id ORDER BY idx ROWS UNBOUNDED PRECEDING), n AS (PARTITION BY user_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), f AS (SELECT user_id, idx, coalesce(u, ul + (ur - ul) * ((idx - ui) / (uj - ui))) AS f FROM z), {smoothed("f", "sg", "f", "idx", 1.0, "user_id")} SELECT user_id, idx, round(sin(y), 4) AS sine FROM sg"""),
    "p18_centroid_track": sql(f"""{_XY}, z AS (SELECT user_id, idx, x, y, lag(x) OVER w AS x2, lag(y) OVER w AS y2 FROM xy WINDOW w AS (PARTITION BY user_id ORDER BY idx)), q AS (SELECT *, sqrt((x - x2) * (x - x2) + (y - y2) * (y - y2)) AS far FROM z),
c AS (SELECT user_id, idx, CASE WHEN x2 IS NULL THEN x WHEN far < 50 THEN (x + x2) / 2 END AS a, CASE WHEN x2 IS NULL THEN y WHEN far < 50 THEN (y + y2) / 2 END AS b FROM q),
i AS (SELECT *, {", ".join(f"last_value({v} IGNORE NULLS) OVER p AS {v}l, last_value(CASE WHEN {v} IS NOT NULL THEN idx END IGNORE NULLS) OVER p AS {v}i, first_value({v} IGNORE NULLS) OVER n AS {v}r, first_value(CASE WHEN {v} IS NOT NULL THEN idx END IGNORE NULLS) OVER n AS {v}j" for v in "ab")} FROM c
WINDOW p AS (PARTITION BY user_id ORDER BY idx ROWS UNBOUNDED PRECEDING), n AS (PARTITION BY user_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), f AS (SELECT user_id, idx, {", ".join(f"coalesce({v}, {v}l + ({v}r - {v}l) * ((idx - {v}i) / ({v}j - {v}i))) AS {v}" for v in "ab")} FROM i),
m AS (SELECT user_id, idx, avg(a) OVER w AS x, avg(b) OVER w AS y FROM f WINDOW w AS (PARTITION BY user_id ORDER BY idx ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
v AS (SELECT *, nullif(coalesce(lead(idx) OVER w, idx) - coalesce(lag(idx) OVER w, idx), 0) AS s, coalesce(lead(x) OVER w, x) - coalesce(lag(x) OVER w, x) AS dx, coalesce(lead(y) OVER w, y) - coalesce(lag(y) OVER w, y) AS dy FROM m WINDOW w AS (PARTITION BY user_id ORDER BY idx))
SELECT user_id, idx, round(x, 10) AS cx, round(y, 10) AS cy, round(sqrt(dx / s * (dx / s) + dy / s * (dy / s)), 10) AS speed FROM v"""),
    "p25_behaviour_rows": "SELECT event_id, event_type, round(value / 7, 4) AS heading, round(value / 3, 4) AS state FROM events",
    "w3_full_waveform": f"WITH {_W} SELECT vec_id, string_agg(x::VARCHAR, ',' ORDER BY place % 4, place) AS feature FROM w GROUP BY vec_id",
    "b8_clusterless": """WITH e AS (SELECT event_id, event_type, user_id % 10 AS bin, floor(value / 2)::BIGINT AS x, floor((event_id % 100) / 2)::BIGINT AS y FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL),
h AS (SELECT event_type, x, y, bin, count(*) AS n FROM e GROUP BY ALL), c AS (SELECT DISTINCT event_type, x, y FROM e),
q AS (SELECT c.event_type, c.x, c.y, h.bin, sum(n * exp(-((c.x - h.x) * (c.x - h.x) + (c.y - h.y) * (c.y - h.y)) / 8.0)) AS likelihood FROM c JOIN h ON c.event_type = h.event_type AND h.x BETWEEN c.x - 6 AND c.x + 6
WHERE (c.x - h.x) * (c.x - h.x) + (c.y - h.y) * (c.y - h.y) <= 36 GROUP BY ALL) SELECT event_id, q.bin, round(likelihood, 6) AS likelihood FROM e JOIN q USING (event_type, x, y)""",
}
ORACLES["p22_numbered_track"] = ORACLES["p1_two_point_track"].replace("SELECT user_id, idx, round(x, 10) AS x, round(y, 10) AS y, round(sqrt(dx / s * (dx / s) + dy / s * (dy / s)), 10) AS speed FROM a8", "SELECT user_id, (n - 1)::INT AS video_frame, round(dx / s, 10) AS velocity_x FROM a8")

# as p1 above, with each user's median step in hours, time in place of row numbers, and a mean of as many rows as a day has steps
_OWN = ORACLES["p1_two_point_track"]
for _old, _new in (
    ("a0 AS (SELECT user_id, idx,", "st AS (SELECT user_id, median(g) AS step, greatest(1, floor(24.0 * (1 / median(g))))::BIGINT AS wide FROM (SELECT user_id, (t - lag(t) OVER (PARTITION BY user_id ORDER BY idx)) / %d AS g FROM xy WHERE user_id IS NOT NULL) GROUP BY user_id HAVING median(g) IS NOT NULL), a0 AS (SELECT user_id, t AS idx," % HOUR),
    ("a2 AS (SELECT *,", "a2 AS (SELECT a1.*,"),
    ("pow(a - lag(a) OVER w, 2) + pow(b - lag(b) OVER w, 2)) > 40", "pow(a - lag(a) OVER w, 2) + pow(b - lag(b) OVER w, 2)) / step > 3"),
    ("pow(c - lag(c) OVER w, 2) + pow(d - lag(d) OVER w, 2)) > 40", "pow(c - lag(c) OVER w, 2) + pow(d - lag(d) OVER w, 2)) / step > 3"),
    ("FROM a1 WINDOW w AS (PARTITION BY user_id ORDER BY idx))", "FROM a1 LEFT JOIN st USING (user_id) WHERE user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY idx))"),
    *((f"avg({v}) OVER m AS {v}", f"list_avg((list({v}) OVER m)[-coalesce(wide, 1):]) AS {v}") for v in "abcd"),
    ("FROM a5 WINDOW m AS (PARTITION BY user_id ORDER BY idx ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)", "FROM a5 LEFT JOIN st USING (user_id) WINDOW m AS (PARTITION BY user_id ORDER BY idx ROWS UNBOUNDED PRECEDING)"),
    ("SELECT user_id, idx, round(x, 10) AS x, round(y, 10) AS y, round(sqrt(dx / s * (dx / s) + dy / s * (dy / s)), 10) AS speed FROM a8", "SELECT user_id, idx AS t, round(x, 7) AS x, round(y, 7) AS y, round(sqrt(pow(dx / (s * coalesce(step, 1)), 2) + pow(dy / (s * coalesce(step, 1)), 2)), 7) AS speed FROM a8 LEFT JOIN st USING (user_id)"),
):
    assert _old in _OWN, _old
    _OWN = _OWN.replace(_old, _new)
ORACLES["p1_two_point_position"] = _OWN

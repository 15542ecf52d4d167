"""Spike trains, unit curation and pairwise metrics, in long form ``train, t``."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import BLOCK, block_width, numbered
from ..functions.columns import no_nan
from ..functions.rangejoin import points_in
from ..functions.ranks import medians
from ..functions.store import materialise
from .intervals import to_indices
from .signal import gaussian


def indicator(trains: DataFrame, train: str, t: str, start: int, step: int, bins: int) -> DataFrame:
    """Counts of each train on a regular grid of ``bins`` times; zeros are there too, and the last time holds no count."""
    last = start + step * (bins - 1)
    inside = trains.where((F.col(t) >= start) & (F.col(t) <= last))
    at = F.least(F.lit(bins - 2), F.floor((F.col(t) - start) / step))
    counts = inside.groupBy(train, at.alias("bin")).agg(F.count("*").alias("n"))
    grid = trains.select(train).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))))
    return grid.join(counts, [train, "bin"], "left").select(train, "bin", F.coalesce("n", F.lit(0)).alias("n"))


def filter_by_label(units: DataFrame, labels: str, include: list[str], exclude: list[str]) -> DataFrame:
    """Units with any of ``include`` and none of ``exclude``; empty lists do not restrict."""
    has = lambda names: F.coalesce(F.arrays_overlap(labels, F.array(*map(F.lit, names))), F.lit(False))
    out = units.where(has(include)) if include else units
    return out.where(~has(exclude)) if exclude else out


def criterion(column: str, op: str, value) -> Column:
    """A test that NaN and null always fail."""
    c = F.col(column)
    tests = {">": lambda: c > value, ">=": lambda: c >= value, "<": lambda: c < value, "<=": lambda: c <= value, "==": lambda: c == value, "!=": lambda: c != value, "between": lambda: c.between(*value), "outside": lambda: (c < value[0]) | (c > value[1]), "isin": lambda: c.isin(*value), "notin": lambda: ~c.isin(*value)}
    if op not in tests:
        raise ValueError(f"unknown operator {op}")
    return F.coalesce(tests[op](), F.lit(False))


def filter_by_criteria(units: DataFrame, criteria: dict[str, list[tuple[str, object]]]) -> DataFrame:
    """Units that pass all criteria; missing values fail every one. Unknown columns are an error."""
    missing = [c for c in criteria if c not in units.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    kinds = dict(units.dtypes)
    for column, tests in criteria.items():
        for op, value in tests:
            test = criterion(column, op, value)
            units = units.where(test & ~F.isnan(column)) if kinds[column] in ("double", "float") else units.where(test)
    return units


def group_spikes(trains: DataFrame, units: DataFrame, sorting: str, unit: str, t: str, labels: str, include: list[str], exclude: list[str], criteria: dict[str, list[tuple[str, object]]], time_slice: tuple[int, int] | None = None) -> DataFrame:
    """Spikes of the units that pass labels and criteria, in the closed slice if there is one; ``unit`` counts from 0 in each sorting."""
    kept = filter_by_criteria(filter_by_label(units, labels, include, exclude), criteria).select(sorting, unit)
    number = F.row_number().over(Window.partitionBy(sorting).orderBy(unit)) - 1
    kept = kept.select(sorting, F.col(unit).alias("_id"), number.cast("long").alias("unit"))
    inside = trains if time_slice is None else trains.where(F.col(t).between(*time_slice))
    return inside.select(sorting, F.col(unit).alias("_id"), t).join(kept, [sorting, "_id"]).select(sorting, "unit", t)


def labels_from_metrics(metrics: DataFrame, unit: str, rules: list[tuple[str, str, float, list[str]]]) -> DataFrame:
    """Labels of each unit by rules ``(metric, op, value, labels)``, in the order of the rules, each once."""
    parts = [F.when(criterion(m, op, v), F.array(*map(F.lit, names))).otherwise(F.array().cast("array<string>")) for m, op, v, names in rules]
    return metrics.select(unit, F.array_join(F.array_distinct(F.concat(*parts)), ",").alias("labels"))


def isi_violations(trains: DataFrame, train: str, t: str, threshold: int) -> DataFrame:
    """Share of the intervals between neighbours of a train that are below ``threshold``."""
    d = F.col(t) - F.lag(t).over(Window.partitionBy(train).orderBy(t))
    rows = trains.withColumn("_d", d)
    return rows.groupBy(train).agg(F.count("*").alias("n"), F.count(F.when(F.col("_d") < threshold, 1)).alias("violations")).where("n > 1").withColumn("fraction", F.col("violations") / (F.col("n") - 1))


def _moments_of(trains: DataFrame, train: str, t: str, key: tuple[str, ...]) -> DataFrame:
    """The times of each train of a key, each once with its number of spikes, as ``key, _u, _t, _n``; nulls are left out."""
    rows = trains.select(*key, F.col(train).alias("_u"), F.col(t).alias("_t")).where(F.col("_t").isNotNull() & F.col("_u").isNotNull())
    return rows.groupBy(*key, "_u", "_t").agg(F.count("*").alias("_n"))


def _in_stretches(moments: DataFrame, back: int, ahead: int, width: int) -> DataFrame:
    """Times with each stretch of ``width`` that needs them: their own, and those that begin less than ``ahead`` later or ended less than ``back`` before."""
    at = lambda shift: F.floor((F.col("_t") + shift) / width)
    dealt = moments.withColumn("_b", F.explode(F.array_distinct(F.array(at(0), at(-back), at(ahead)))))
    return dealt.withColumn("_own", F.col("_b") == at(0))


def _kinds_of(df: DataFrame, names: dict[str, str]) -> str:
    return "".join(f"`{to}` {df.schema[of].dataType.simpleString()}, " for of, to in names.items())


def pooled_isi(trains: DataFrame, train: str, t: str, pairs: DataFrame, threshold: int, key: tuple[str, ...] = (), stretch: int | None = None) -> DataFrame:
    """For pairs ``a, b`` of a key the share of neighbours of both trains together that are closer than ``threshold``.

    Both trains are merged in each stretch of time, which also gets the times up to ``threshold`` before it; a pair is done once, whichever way round.
    """
    found = _close_neighbours(_moments_of(trains, train, t, key), pairs, threshold, key, stretch or block_width(trains, t))
    total = trains.groupBy(*key, train).agg(F.count("*").alias("_k"))
    of = lambda c: total.select(*key, F.col(train).alias(c), F.col("_k").alias(f"_{c}"))
    each = pairs.select(*key, "a", "b").distinct().join(of("a"), [*key, "a"], "left").join(of("b"), [*key, "b"], "left")
    each = each.withColumn("n", F.coalesce("_a", F.lit(0)) + F.coalesce("_b", F.lit(0))).where("n > 0").withColumn("_lo", F.least("a", "b")).withColumn("_hi", F.greatest("a", "b"))
    rows = each.join(found, [*key, "_lo", "_hi"], "left").select(*key, "a", "b", "n", F.coalesce("close", F.lit(0)).cast("long").alias("close"))
    return rows.withColumn("fraction", F.col("close") / F.col("n"))


def _close_neighbours(moments: DataFrame, pairs: DataFrame, threshold: int, key: tuple[str, ...], width: int) -> DataFrame:
    """How many spikes of both trains of a pair come less than ``threshold`` after the one before, as ``key, _lo, _hi, close``."""
    rows = _in_stretches(moments, 0, max(threshold, 0), max(width, threshold, 1))
    wanted = pairs.select(*key, F.least("a", "b").alias("_lo"), F.greatest("a", "b").alias("_hi")).distinct()
    stretches = materialise(rows.select(*key, "_b").distinct(), "stretches")
    wanted = wanted.join(stretches, list(key)) if key else wanted.crossJoin(stretches)  # pairs in each stretch, which are its results
    names = [*key, "_lo", "_hi", "close"]

    def merged(times: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        of, none, made = {}, (np.array([], times["_t"].dtype), np.array([], bool), 0), []
        for unit, part in times.sort_values("_t").groupby("_u", sort=False):
            of[unit] = part["_t"].to_numpy(), part["_own"].to_numpy(bool), int(part["_n"][part["_own"]].sum())
        for lo, hi in zip(asked["_lo"], asked["_hi"], strict=True):
            (x, own_x, n_x), (y, own_y, n_y) = of.get(lo, none), of.get(hi, none)
            if not n_x + n_y:
                continue
            at, own = np.concatenate([x, y]), np.concatenate([own_x, own_y])
            order = np.argsort(at, kind="stable")  # two sorted runs
            at, own = at[order], own[order]
            gap = np.diff(at)
            apart = np.append(True, gap > 0)  # the first spike of its moment
            near = own[1:] & (gap > 0) & (gap < threshold)
            again = n_x + n_y - int((own & apart).sum()) if threshold > 0 else 0
            made.append((lo, hi, again + int(near.sum())))
        out = pd.DataFrame(made, columns=["_lo", "_hi", "close"])
        for k in key:
            out[k] = asked[k].iloc[0] if len(asked) else None
        return out[names]

    by = [*key, "_b"]
    kinds = _kinds_of(wanted, {k: k for k in [*key, "_lo", "_hi"]}) + "close long"
    counted = rows.groupBy(*by).cogroup(wanted.groupBy(*by)).applyInPandas(merged, kinds)
    return counted.groupBy(*key, "_lo", "_hi").agg(F.sum("close").alias("close"))


#: Pairs of times that are looked at together where trains are sparse.
_PAIRS = 1 << 21


def _differences(unit: np.ndarray, at: np.ndarray, n: np.ndarray, own: np.ndarray, units: int, half: int, width: int) -> np.ndarray:
    """Counts of differences by ``unit, other unit, bin``, from own times to all times (sorted) of the stretch.

    Where trains are dense, spikes are counted between the bins' edges by their running numbers; where they are sparse,
    pairs are listed, some at a time. Neither makes an array of all pairs.
    """
    low = -half // width
    bins = (half - 1) // width - low + 1
    edges = np.clip(np.arange(low, low + bins + 1) * width, -half, half)
    out = np.zeros((units, units, bins), np.int64)
    mine = np.flatnonzero(own)
    first, last = np.searchsorted(at, at[mine] - half), np.searchsorted(at, at[mine] + half)
    if (last - first).sum() <= len(mine) * len(edges) * units:
        ends = np.cumsum(last - first)
        for cut in np.split(np.arange(len(mine)), np.searchsorted(ends, np.arange(_PAIRS, ends[-1], _PAIRS))) if len(mine) else []:
            many = last[cut] - first[cut]
            a = np.repeat(mine[cut], many)
            b = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[cut], many)
            place = (unit[a] * units + unit[b]) * bins + (at[b] - at[a]) // width - low
            np.add.at(out.reshape(-1), place, n[a] * n[b])
    else:
        for other in range(units):
            there = unit == other
            x, upto = at[there], np.append(0, np.cumsum(n[there]))
            for cut in np.array_split(mine, len(mine) // BLOCK + 1):
                counts = np.diff(upto[np.searchsorted(x, at[cut, None] + edges)], axis=1) * n[cut, None]
                for k in range(bins):
                    np.add.at(out[:, other, k], unit[cut], counts[:, k])
    return out


def correlogram(trains: DataFrame, train: str, t: str, window: int, width: int, key: tuple[str, ...] = (), stretch: int | None = None) -> DataFrame:
    """Histogram of time differences within half of ``window`` between each ordered pair of trains of a key, by bins of ``width``.

    Times are whole numbers. They are counted in stretches of time, which also get the times up to half of ``window`` on either side;
    spikes at one time are one row with their number.
    """
    half = window // 2
    moments = _moments_of(trains, train, t, key)
    rows = _in_stretches(moments, half, half, max(stretch or block_width(trains, t), half, 1))

    def counted(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_t")
        unit, names = pd.factorize(part["_u"])
        at, n = part["_t"].to_numpy(np.int64), part["_n"].to_numpy(np.int64)
        found = _differences(unit, at, n, part["_own"].to_numpy(bool), len(names), half, width)
        found[np.arange(len(names)), np.arange(len(names))] = 0
        a, b, k = np.nonzero(found)
        out = pd.DataFrame({"a": names[a], "b": names[b], "bin": k + (-half // width), "n": found[a, b, k]})
        for c in key:
            out[c] = part[c].iloc[0]
        return out[[*key, "a", "b", "bin", "n"]]

    kinds = _kinds_of(moments, {k: k for k in key}) + _kinds_of(moments, {"_u": "a"}) + _kinds_of(moments, {"_u": "b"}) + "bin long, n long"
    return rows.groupBy(*key, "_b").applyInPandas(counted, kinds).groupBy(*key, "a", "b", "bin").agg(F.sum("n").alias("n"))


def asymmetry(correl: DataFrame, key: tuple[str, ...] = ()) -> DataFrame:
    """(right - left) / (right + left) of a correlogram; 0 where empty."""
    right, left = F.sum(F.when(F.col("bin") >= 0, F.col("n")).otherwise(0)), F.sum(F.when(F.col("bin") < 0, F.col("n")).otherwise(0))
    return correl.groupBy(*key, "a", "b").agg(right.alias("_r"), left.alias("_l")).select(*key, "a", "b", F.when(F.col("_r") + F.col("_l") > 0, (F.col("_r") - F.col("_l")) / (F.col("_r") + F.col("_l"))).otherwise(0.0).alias("asymmetry"))


def sort_groups(electrodes: DataFrame, group: str, shank: str, electrode: str) -> DataFrame:
    """Numbers the groups by shank in numeric order, without groups of one electrode."""
    n = electrodes.groupBy(group, shank).agg(F.count("*").alias("n"), F.min(electrode).alias("first_electrode")).where("n > 1")
    return n.withColumn("sort_group", F.dense_rank().over(Window.orderBy(F.col(group).cast("double"), group, shank)) - 1)


def mean_template(waves: DataFrame, unit: str, samples: str) -> DataFrame:
    """Mean waveform of each unit, as ``unit, place, mean``."""
    return waves.select(unit, F.posexplode(samples).alias("place", "x")).groupBy(unit, "place").agg(F.avg("x").alias("mean"))


def peak_place(template: DataFrame, unit: str, channels: int, sign: str = "neg") -> DataFrame:
    """Sample and channel of the template's extremum; ties go to the first."""
    size = {"neg": -F.col("mean"), "pos": F.col("mean"), "both": F.abs("mean")}[sign]
    best = template.groupBy(unit).agg(F.max_by(F.struct("place", "mean"), F.struct(size, -F.col("place"))).alias("_p"))
    return best.select(unit, F.floor(F.col("_p.place") / channels).alias("sample"), (F.col("_p.place") % channels).alias("channel"))


def mark_threshold(waves: DataFrame, marks: str, threshold: float, sign: str) -> DataFrame:
    """Waves whose marks reach the threshold in the given direction."""
    low, high = F.array_min(marks), F.array_max(marks)
    return waves.where({"neg": low <= -threshold, "pos": high >= threshold, "both": F.greatest(F.abs(low), F.abs(high)) >= threshold}[sign])


def marks_per_bin(df: DataFrame, key: str, t: str, value: str, start: int, step: int, bins: int) -> DataFrame:
    """Mean of the values in each bin of the grid; bins without values are null."""
    means = df.withColumn("bin", F.floor((F.col(t) - start) / step)).groupBy(key, "bin").agg(F.avg(value).alias("mean"))
    grid = df.select(key).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))))
    return grid.join(means, [key, "bin"], "left")


def _each(left: DataFrame, right: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """All pairs of rows within a key, which are the size of the result."""
    return left.join(right, list(key)) if key else left.crossJoin(right)


def place_fields(df: DataFrame, spikes: DataFrame, unit: str, bin_: str, key: tuple[str, ...] = ()) -> DataFrame:
    """Spikes of each unit in a position bin over the samples of that bin, by ``key``."""
    occupancy = df.groupBy(*key, bin_).agg(F.count("*").alias("occupancy"))
    grid = _each(spikes.select(*key, unit).distinct(), occupancy, key)
    counts = spikes.groupBy(*key, unit, bin_).agg(F.count("*").alias("n"))
    return grid.join(counts, [*key, unit, bin_], "left").withColumn("rate", (F.coalesce("n", F.lit(0)) + 1e-3) / F.col("occupancy")).select(*key, unit, bin_, "rate")


def poisson_posterior(counts: DataFrame, fields: DataFrame, time: str, unit: str, bin_: str, key: tuple[str, ...] = ()) -> DataFrame:
    """Posterior over the position bins at each time of a key, uniform prior, from ``key, time, unit, n``."""
    silent = fields.groupBy(*key, bin_).agg(F.sum("rate").alias("_sum"))
    fired = counts.where("n > 0").join(fields, [*key, unit]).groupBy(*key, time, bin_).agg(F.sum(F.col("n") * F.log("rate")).alias("_l"))
    grid = _each(counts.select(*key, time).distinct(), silent, key)
    ll = grid.join(fired, [*key, time, bin_], "left").withColumn("_ll", F.coalesce("_l", F.lit(0.0)) - F.col("_sum"))
    w = Window.partitionBy(*key, time)
    p = ll.withColumn("_e", F.exp(F.col("_ll") - F.max("_ll").over(w)))
    return p.withColumn("p", F.col("_e") / F.sum("_e").over(w)).select(*key, time, bin_, "p")


def map_bin(posterior: DataFrame, time: str, bin_: str, key: tuple[str, ...] = ()) -> DataFrame:
    """The most probable bin, the first of equals."""
    return posterior.groupBy(*key, time).agg(F.max_by(bin_, F.struct("p", -F.col(bin_))).alias("map_bin"))


def counts(trains: DataFrame, train: str) -> DataFrame:
    """Spikes of each train."""
    return trains.groupBy(train).agg(F.count("*").alias("n"))


def spike_samples(spikes: DataFrame, samples: DataFrame, key: list[str], t: str) -> DataFrame:
    """The number of samples before each spike, which is its sample; spikes after the last sample go."""
    n = samples.groupBy(*key).agg(F.count("*").alias("_n"))
    placed = to_indices(spikes.select(*key, F.col(t).alias("x")), samples, key, t)
    return placed.join(n, key).where(F.col("position") < F.col("_n")).select(*key, F.col("x").alias(t), "position")


def firing_rate(counted: DataFrame, key: list[str], bin_: str, n: str, seconds: float, sigma: float) -> DataFrame:
    """Smoothed counts of a grid of bins as spikes a second; for a population give counts summed over its units."""
    rows = counted.withColumn("_x", F.col(n).cast("double"))
    return gaussian(rows, key, bin_, "_x", sigma, name="rate").withColumn("rate", F.col("rate") / seconds).drop("_x")


def within_range(spikes: DataFrame, model: DataFrame, key: list[str], t: str) -> DataFrame:
    """Spikes from the first to the last time of the model, both included."""
    ends = model.groupBy(*key).agg(F.min(t).alias("_a"), F.max(t).alias("_b"))
    return spikes.join(ends, key).where(F.col(t).between(F.col("_a"), F.col("_b"))).drop("_a", "_b")


def annotate(units: DataFrame, notes: DataFrame, key: list[str]) -> DataFrame:
    """Notes (``key, annotation, label, quantity``) of units that exist, each once; a note on no unit fails the job."""
    known = units.select(*key).distinct().withColumn("_there", F.lit(True))
    there = F.when(F.col("_there"), F.lit(True)).otherwise(F.raise_error(F.lit("a note on a unit that does not exist")).cast("boolean"))
    return notes.distinct().join(known, key, "left").withColumn("_there", there).where("_there").drop("_there")


def next_curations(old: DataFrame, new: DataFrame, sorting: str, order: str) -> DataFrame:
    """Numbers new curations of a sorting after its largest ``curation_id``, in the given order, from 0; ``parent`` -1 is a root.

    A sorting has one root: a further one fails the job.
    """
    last = old.groupBy(sorting).agg(F.max("curation_id").alias("_last"), F.count(F.when(F.col("parent") < 0, 1)).alias("_roots"))
    n = F.row_number().over(Window.partitionBy(sorting).orderBy(order))
    roots = F.sum(F.when(F.col("parent") < 0, 1).otherwise(0)).over(Window.partitionBy(sorting))
    rows = new.join(last, sorting, "left").withColumn("curation_id", F.coalesce("_last", F.lit(-1)) + n).withColumn("_all", F.coalesce("_roots", F.lit(0)) + roots)
    only = F.when(F.col("_all") <= 1, F.col("parent")).otherwise(F.raise_error(F.lit("a second root curation")).cast("int"))
    return rows.withColumn("parent", only).drop("_last", "_roots", "_all")


def merge_partners(pairs: DataFrame, a: str, b: str, tests: list[tuple[str, str, float]]) -> DataFrame:
    """For each unit of ``pairs`` the units that pass any of the tests ``(metric, op, value)`` with it, in order, each once."""
    passed = F.lit(False)
    for metric, op, value in tests:
        passed = passed | criterion(metric, op, value)
    units = pairs.select(F.col(a).alias("unit")).union(pairs.select(b)).distinct()
    hits = pairs.where((F.col(a) != F.col(b)) & passed).select(F.col(a).alias("unit"), F.col(b).alias("_o")).distinct()
    return units.join(hits.groupBy("unit").agg(F.array_join(F.array_sort(F.collect_list("_o")), ",").alias("partners")), "unit", "left").select("unit", F.coalesce("partners", F.lit("")).alias("partners"))


def snr(waves: DataFrame, unit: str, samples: str, channels: int, sign: str = "neg") -> DataFrame:
    """The mean waveform's extremum over the noise of its channel: 1.4826 times the median deviation from the median of all values there."""
    template = mean_template(waves, unit, samples)
    peak = peak_place(template, unit, channels, sign).withColumn("place", F.col("sample") * channels + F.col("channel"))
    at = template.join(peak.select(unit, "channel", "place"), [unit, "place"]).select(unit, F.abs("mean").alias("_peak"), "channel")
    values = waves.select(F.posexplode(samples).alias("_p", "_x")).select((F.col("_p") % channels).alias("channel"), "_x")
    away = values.join(medians(values, ["channel"], "_x", "_med"), "channel").select("channel", F.abs(F.col("_x") - F.col("_med")).alias("_dev"))
    noise = medians(away, ["channel"], "_dev", "_noise").withColumn("_noise", F.col("_noise") * 1.4826)
    return at.join(noise, "channel").select(unit, "channel", (F.col("_peak") / F.col("_noise")).alias("snr"))


def waveform_similarity(template: DataFrame, unit: str, key: tuple[str, ...] = ()) -> DataFrame:
    """Pearson's correlation of the mean waveforms of each ordered pair of units of a key."""
    other = template.select(*key, F.col(unit).alias("b"), "place", F.col("mean").alias("_y"))
    both = template.select(*key, F.col(unit).alias("a"), "place", F.col("mean").alias("_x")).join(other, [*key, "place"]).where("a <> b")
    return both.groupBy(*key, "a", "b").agg(F.corr("_x", "_y").alias("similarity"))


def burst_pairs(template: DataFrame, trains: DataFrame, unit: str, t: str, threshold: int, window: int, width: int, key: tuple[str, ...] = ()) -> DataFrame:
    """For each ordered pair of units of a key (a sorting): similarity of waveforms, pooled share of short intervals, asymmetry of the correlogram.

    ``template`` has ``key, unit, place, mean``. Units of different keys never meet.
    """
    pair = [*key, "a", "b"]
    alike = waveform_similarity(template, unit, key)
    stretch = block_width(trains, t)
    isi = pooled_isi(trains, unit, t, alike.select(*pair), threshold, key, stretch).select(*pair, F.col("fraction").alias("isi_violation"))
    skew = asymmetry(correlogram(trains, unit, t, window, width, key, stretch), key)
    return alike.join(isi, pair).join(skew, pair, "left").withColumn("asymmetry", F.coalesce("asymmetry", F.lit(0.0)))


def peak_amplitude(waves: DataFrame, spike: str, unit: str, samples: str, channels: int, sign: str = "neg", estimate: bool = False) -> DataFrame:
    """The values of all channels at one sample: the middle one, or with ``estimate`` the one at which most of the unit's spikes have their extremum (the first of equals)."""
    if not estimate:
        peak = F.floor(F.size(samples) / channels / 2)
        return waves.select(spike, unit, F.slice(samples, peak.cast("int") * channels + 1, channels).alias("amplitude"))
    size = {"neg": lambda x: -x, "pos": lambda x: x, "both": F.abs}[sign]
    best = F.array_max(F.transform(samples, lambda x, i: F.struct(size(x).alias("v"), (-i).alias("i"))))
    peaks = waves.select(spike, unit, samples, F.floor(-best["i"] / channels).cast("int").alias("_p"))
    modal = peaks.groupBy(unit, "_p").agg(F.count("*").alias("_n")).groupBy(unit).agg(F.max_by("_p", F.struct("_n", -F.col("_p"))).alias("_m"))
    return peaks.join(modal, unit).select(spike, unit, F.slice(samples, F.col("_m") * channels + 1, channels).alias("amplitude"))


def spike_location(waves: DataFrame, spike: str, samples: str, channels: int, places: list[tuple[float, float]]) -> DataFrame:
    """Centre of mass of the channels' places, weighted by the size of the values at the middle sample."""
    own = F.transform(F.slice(samples, (F.floor(F.size(samples) / channels / 2)).cast("int") * channels + 1, channels), lambda x: F.abs(x))
    total = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
    mean = lambda k: F.aggregate(F.zip_with(own, F.array(*(F.lit(float(p[k])) for p in places)), lambda w, p: w * p), F.lit(0.0), lambda a, x: a + x) / total
    return waves.select(spike, mean(0).alias("x"), mean(1).alias("y"))


def features(spikes: DataFrame, parts: list[DataFrame], key: list[str], t: str, start: int | None = None, stop: int | None = None) -> DataFrame:
    """Times of spikes with the arrays ``feature`` of all parts one after the other, within the closed range."""
    out = spikes if start is None else spikes.where(F.col(t).between(start, stop))
    out = out.withColumn("features", F.array().cast("array<double>"))
    for part in parts:
        out = out.join(part.select(*key, F.col("feature").cast("array<double>").alias("_f")), key).withColumn("features", F.concat("features", "_f")).drop("_f")
    return out


def amplitudes_over_time(spikes: DataFrame, amplitudes: DataFrame, unit: str, t: str, order: str) -> DataFrame:
    """The k-th time of a unit with its k-th amplitude; what the longer list has more goes."""
    a = spikes.select(unit, t, F.row_number().over(Window.partitionBy(unit).orderBy(t)).alias("k"))
    b = amplitudes.withColumn("k", F.row_number().over(Window.partitionBy(unit).orderBy(order)))
    return a.join(b.drop(order), [unit, "k"])


def units_by_field_peak(fields: DataFrame, unit: str, bin_: str) -> DataFrame:
    """Units numbered by the bin of their highest rate (the first of equals), then by themselves; ``rank`` from 0."""
    peak = fields.groupBy(unit).agg(F.max_by(bin_, F.struct("rate", -F.col(bin_))).alias("peak"))
    return peak.withColumn("rank", F.row_number().over(Window.orderBy("peak", unit)) - 1)  # units, not spikes, in one task


def sort_group_info(groups: DataFrame, electrodes: DataFrame, group: str, electrode: str) -> DataFrame:
    """Each sort group with the columns of its first electrode."""
    first = groups.select("sort_group", F.col("first_electrode").alias(electrode))
    return first.join(electrodes, electrode)


def concatenated(samples: DataFrame, iv: DataFrame, key: list[str], t: str, width: int) -> DataFrame:
    """Samples in any of the disjoint intervals, numbered from 0 in the order of time, their times kept."""
    inside = points_in(samples, iv, key, t, width, how="left_semi")
    return numbered(inside, key, [t], "place")


def review_counts(units: DataFrame, by: str, reviewed: Column) -> DataFrame:
    """Reviewed and other units of each member."""
    return units.groupBy(by).agg(F.count(F.when(reviewed, 1)).alias("reviewed"), F.count(F.when(~F.coalesce(reviewed, F.lit(False)), 1)).alias("unreviewed"))


def accepted_units(labels: DataFrame, metrics: DataFrame, unit: str, names: list[str], default: float, reject: str = "reject") -> DataFrame:
    """Units without the label ``reject``: their labels joined by commas, and a column for each metric, ``default`` where it is missing.

    Takes ``unit, labels`` (an array) and ``unit, metric, value``.
    """
    kept = labels.where(~F.array_contains("labels", reject)).select(unit, F.array_join("labels", ",").alias("labels"))
    wide = metrics.groupBy(unit).pivot("metric", names).agg(F.first("value"))
    return kept.join(wide, unit, "left").select(unit, "labels", *(F.coalesce(n, F.lit(default)).alias(n) for n in names))


def waveforms(samples: DataFrame, spikes: DataFrame, key: list[str], idx: str, value: str, before: int, after: int) -> DataFrame:
    """The samples from ``before`` ahead of each spike to ``after`` behind it (not included), by an equi-join on the sample number."""
    places = spikes.select(*key, F.col(idx).alias("spike"), F.explode(F.sequence(F.lit(-before), F.lit(after - 1))).alias("offset")).withColumn(idx, F.col("spike") + F.col("offset"))
    return places.join(samples.select(*key, idx, value), [*key, idx]).select(*key, "spike", "offset", value)


def quantised(posterior: DataFrame, p: Column, steps: int = 255) -> DataFrame:
    """Probabilities as whole steps, those of zero left out."""
    return posterior.withColumn("q", F.floor(p * steps).cast("int")).where("q > 0")


def training_mask(position: DataFrame, encoding: DataFrame, key: list[str], t: str, values: list[str], width: int) -> DataFrame:
    """Adds ``is_training``: in any encoding interval, and no value missing."""
    inside = points_in(position, encoding, key, t, width, how="left_semi").select(*key, t).distinct().withColumn("_in", F.lit(True))
    there = F.lit(True)
    for c in values:
        there = there & no_nan(F.col(c).cast("double")).isNotNull()
    return position.join(inside, [*key, t], "left").withColumn("is_training", F.coalesce("_in", F.lit(False)) & there).drop("_in")


def signed_distance(decoded: DataFrame, place: str, at: str, heading: str) -> DataFrame:
    """Adds ``ahead``: how far the decoded place is from the actual one, positive in the direction of the heading (its sign)."""
    return decoded.withColumn("ahead", (F.col(place) - F.col(at)) * F.signum(heading))


def full_waveform(waves: DataFrame, spike: str, samples: str, channels: int) -> DataFrame:
    """Each spike's samples of all channels in one array, channel by channel."""
    places = F.sequence(F.lit(0), (F.size(samples) / channels).cast("int") - 1)
    one = lambda k: F.transform(places, lambda i: F.col(samples)[i * channels + k])
    return waves.select(spike, F.flatten(F.array(*(one(k) for k in range(channels)))).alias("feature"))


def _coarse(cell: Column, reach: int) -> Column:
    return F.transform(cell, lambda c: F.floor(c / reach))


def clusterless_likelihood(decode: DataFrame, encode: DataFrame, key: list[str], electrode: list[str], mark: str, bin_: str, spread: float, fine: int = 2, reach: int = 3) -> DataFrame:
    """For each spike of ``decode`` and position bin the sum of Gaussian kernels of the marks of ``encode`` on the same electrode.

    ``mark`` is an array of as many numbers as the electrode has features. Marks are counted in cells of a ``fine``-th of ``spread`` and
    stand at their cell's centre; cells further apart than ``reach`` spreads do not count. Only occupied cells meet, by an
    equi-join on blocks of cells, so the work grows with these and not with pairs of spikes. A bin without a mark nearby has no row;
    nor have spikes whose mark or electrode is null.
    """
    far = fine * reach
    cell = F.transform(mark, lambda x: F.floor(x.cast("double") * fine / spread))
    whole = lambda df: df.where(F.col(mark).isNotNull() & ~F.exists(mark, lambda x: x.isNull() | F.isnan(x)))
    known = whole(encode).groupBy(*electrode, cell.alias("_e"), bin_).agg(F.count("*").alias("_n")).withColumn("_b", _coarse(F.col("_e"), far))
    asked = whole(decode).select(*key, *electrode, cell.alias("_d"))
    around = F.transform("_b0", lambda b: F.array(b - 1, b, b + 1))
    # all blocks next to the cell's own, a feature at a time
    grown = F.aggregate(around, F.array(F.array().cast("array<bigint>")), lambda made, three: F.flatten(F.transform(made, lambda m: F.transform(three, lambda x: F.concat(m, F.array(x))))))
    cells = asked.select(*electrode, "_d").distinct().withColumn("_b0", _coarse(F.col("_d"), far))
    met = cells.select(*electrode, "_d", F.explode(grown).alias("_b")).join(known, [*electrode, "_b"])
    square = F.aggregate(F.zip_with("_d", "_e", lambda x, y: (x - y) * (x - y)), F.lit(0).cast("bigint"), lambda a, x: a + x)
    near = met.withColumn("_q", square).where(F.col("_q") <= far * far)
    weight = F.exp(F.col("_q") / (-2.0 * fine * fine)) * F.col("_n")
    fields = near.groupBy(*electrode, "_d", bin_).agg(F.sum(weight).alias("likelihood"))
    return asked.join(fields, [*electrode, "_d"]).select(*key, bin_, "likelihood")


def _add_moments(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Joins numbers of rows, means and sums of outer products about the mean."""
    n, mean, outer = parts[0]
    for m, other, more in parts[1:]:
        gap = other - mean
        outer = outer + more + np.outer(gap, gap) * (n * m / (n + m))
        mean, n = mean + gap * (m / (n + m)), n + m
    return n, mean, outer


_MOMENTS = "part long, n long, mean binary, outer binary"
_MERGED = 16


def moments(rows: DataFrame, values: str, size: int) -> tuple[int, np.ndarray, np.ndarray] | None:
    """Number of rows, mean and covariance (by the number) of an array column of ``size`` numbers; none without rows.

    Each task adds up one array of ``size`` by ``size``; these are joined in a tree, so that the driver gets a few.
    """

    def told(part: int, found: tuple[int, np.ndarray, np.ndarray]) -> pd.DataFrame:
        return pd.DataFrame({"part": [part], "n": [found[0]], "mean": [found[1].tobytes()], "outer": [found[2].tobytes()]})

    def read(rows: pd.DataFrame) -> list[tuple[int, np.ndarray, np.ndarray]]:
        return [(int(n), np.frombuffer(m), np.frombuffer(o).reshape(size, size)) for n, m, o in zip(rows["n"], rows["mean"], rows["outer"], strict=True)]

    def of_task(batches):
        now = []
        for batch in batches:
            if len(batch):
                x = np.stack(batch[values].tolist()).astype(float)
                mean = x.mean(axis=0)
                now = [_add_moments([*now, (len(x), mean, (x - mean).T @ (x - mean))])]
        if now:
            yield told(TaskContext.get().partitionId(), now[0])

    parts = materialise(rows.select(values).mapInPandas(of_task, _MOMENTS), "moments")
    while parts.count() > _MERGED:
        parts = parts.withColumn("part", F.floor(F.col("part") / _MERGED))
        parts = materialise(parts.groupBy("part").applyInPandas(lambda x: told(int(x["part"].iloc[0]), _add_moments(read(x))), _MOMENTS), "moments")
    found = read(parts.toPandas())  # a few
    if not found:
        return None
    n, mean, outer = _add_moments(found)
    return n, mean, outer / n


def whiten(df: DataFrame, idx: str, channel: str, value: str, channels: list, floor: float = 1e-9) -> DataFrame:
    """Decorrelates the channels by the root of the inverse covariance over all samples; only that (channels by channels) is made on the driver.

    Samples that lack a channel, or have one twice, are left out; so are other channels. Returns ``idx, channel, value``.
    """
    n = len(channels)
    names = F.array(*map(F.lit, channels))
    rows = df.where(F.col(value).isNotNull()).select(idx, (F.array_position(names, F.col(channel)) - 1).alias("_c"), F.col(value).cast("double").alias("_v")).where("_c >= 0")
    wide = rows.groupBy(idx).agg(F.array_sort(F.collect_list(F.struct("_c", "_v"))).alias("_x"), F.countDistinct("_c").alias("_k"))
    wide = materialise(wide.where((F.col("_k") == n) & (F.size("_x") == n)).select(idx, F.col("_x._v").alias("_x")), "wide")
    found = moments(wide, "_x", n)
    kind = df.schema[channel].dataType.simpleString()
    if found is None:
        return wide.select(idx, F.lit(None).cast(kind).alias(channel), F.lit(0.0).alias(value)).limit(0)
    _, mean, covariance = found
    values, vectors = np.linalg.eigh(covariance)
    root = (vectors / np.sqrt(np.maximum(values, floor))) @ vectors.T

    def turned(batches):
        for batch in batches:
            x = (np.stack(batch["_x"].tolist()) - mean) @ root if len(batch) else np.zeros((0, n))
            yield batch[[idx]].assign(_x=list(x))

    made = wide.mapInPandas(turned, f"{idx} {wide.schema[idx].dataType.simpleString()}, _x array<double>")
    return made.select(idx, F.posexplode("_x").alias("_c", value)).select(idx, F.element_at(names, F.col("_c") + 1).cast(kind).alias(channel), value)

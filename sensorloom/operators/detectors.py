"""Outlier channels, segments and epochs.

Kernels see bounded groups only: one window of one recording, or one value per
channel/segment after the samples have been aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.expr import IQR_TO_SD, MAD_TO_SD, finite, matlab_quantile
from ..plans.blocks import BLOCK, neighbours, with_blocks
from ..plans.gram import correlation, pair_sums
from ..plans.intervals import islands, merge_overlaps
from ..plans.quantiles import exact_quantiles, median_and_mad
from ..session import cut_lineage
from .deviates import gesd

CHANNEL = ["recording_id", "ch_name"]


def _schema(df: DataFrame, columns: list[str], extra: str) -> str:
    types = dict(df.dtypes)
    return ", ".join(f"{c} {types[c]}" for c in columns) + ", " + extra


# --------------------------------------------------------------- noisy channels

def bad_nan_flat(samples: DataFrame, flat: float = 1e-15) -> DataFrame:
    """Channels with missing values, or a spread that is practically zero."""
    base = samples.groupBy(*CHANNEL).agg(
        F.bool_or(F.col("value").isNull() | F.isnan("value")).alias("has_nan"), F.stddev_pop(finite("value")).alias("std"))
    spread = base.join(median_and_mad(samples.select(*CHANNEL, finite("value").alias("value")), CHANNEL, "value"), CHANNEL, "left")
    is_flat = F.coalesce((F.col("mad") < flat) | (F.col("std") < flat), F.lit(False))
    return spread.select(*CHANNEL, "has_nan", is_flat.alias("is_flat"), "mad", "std")


def bad_by_deviation(samples: DataFrame, threshold: float = 5.0) -> DataFrame:
    """Robust amplitude per channel against the other channels of the recording."""
    q = exact_quantiles(samples, CHANNEL, "value", {"_lo": 0.25, "_hi": 0.75}, method="matlab")
    amp = q.select(*CHANNEL, ((F.col("_hi") - F.col("_lo")) * IQR_TO_SD).alias("amplitude"))
    w = Window.partitionBy("recording_id")  # channels of one recording
    every = F.array_sort(F.collect_list("amplitude").over(w))
    z = amp.withColumn("_s", every).withColumn("_sd", (matlab_quantile(F.col("_s"), 0.75) - matlab_quantile(F.col("_s"), 0.25)) * IQR_TO_SD)
    z = z.withColumn("z", F.when(F.col("_sd") > 0, (F.col("amplitude") - F.percentile("amplitude", F.lit(0.5)).over(w)) / F.col("_sd")))
    return z.select(*CHANNEL, "amplitude", "z", (F.col("z").isNull() | (F.abs("z") > threshold)).alias("is_bad"))


def bad_by_hfnoise(samples: DataFrame, sfreq: float, threshold: float = 5.0, cutoff: float = 50.0, taps: int = 101,
                   size: int = BLOCK) -> DataFrame:
    """Spread above the cutoff relative to the spread below it, one-sided robust z over channels."""
    if sfreq <= 100:
        return samples.select(*CHANNEL).distinct().select(*CHANNEL, F.lit(None).cast("double").alias("noisiness"),
                                                          F.lit(0e0).alias("z"), F.lit(False).alias("is_bad"))
    low = filtered(samples, kernels.lowpass_taps(cutoff, sfreq, taps), "low", size)
    # four passes of the exact medians read the filtered signal: filter once
    low = cut_lineage(low.select(*CHANNEL, F.inline(F.array(
        F.struct(F.lit("low").alias("part"), F.col("low").alias("v")),
        F.struct(F.lit("rest").alias("part"), (F.col("value") - F.col("low")).alias("v"))))))
    spread = median_and_mad(low, [*CHANNEL, "part"], "v").groupBy(*CHANNEL).agg(
        F.max(F.when(F.col("part") == "low", F.col("mad"))).alias("_low"), F.max(F.when(F.col("part") == "rest", F.col("mad"))).alias("_rest"))
    noise = spread.select(*CHANNEL, F.when(F.col("_low") > 0, F.col("_rest") / F.col("_low")).alias("noisiness"))
    w = Window.partitionBy("recording_id")
    med = noise.withColumn("_m", F.percentile("noisiness", F.lit(0.5)).over(w))
    sd = med.withColumn("_sd", F.percentile(F.abs(F.col("noisiness") - F.col("_m")), F.lit(0.5)).over(w) * MAD_TO_SD)
    z = sd.withColumn("z", F.when(F.col("_sd") > 0, (F.col("noisiness") - F.col("_m")) / F.col("_sd")))
    return z.select(*CHANNEL, "noisiness", "z", (F.col("z").isNull() | (F.col("z") > threshold)).alias("is_bad"))


def filtered(samples: DataFrame, taps, name: str, size: int = BLOCK, keys: list[str] | None = None) -> DataFrame:
    """Zero-phase FIR per channel in blocks with a halo of half the filter length."""
    keys = keys or CHANNEL
    half = len(taps) // 2
    cols = samples.select(*keys, "t", F.col("value").cast("double").alias("value"))
    blocked = with_blocks(cols, size=size, before=half, after=half, wide=True)
    # blocks that hold halo rows only do not exist in the recording
    schema = _schema(samples, keys, f"t bigint, value double, {name} double")
    return blocked.groupBy(*keys, "_block").applyInPandas(kernels.fir_block(keys, taps, name), schema)


def windowed(samples: DataFrame, win: int, skip_last: bool = False) -> DataFrame:
    """Complete correlation windows of each channel; `skip_last` leaves out the last one where the length is a multiple of the window."""
    per = samples.groupBy(*CHANNEL).agg((F.max("t") + 1).alias("_n"))
    count = F.ceil((F.col("_n") - win - 1) / F.lit(win)) if skip_last else F.floor(F.col("_n") / F.lit(win))
    return samples.join(per, CHANNEL).withColumn("win", F.floor(F.col("t") / win).cast("bigint")).where(
        F.col("win") < count).select(*CHANNEL, "win", "t", "value")


def _chunks(samples: DataFrame, win: int, size: int) -> DataFrame:
    """Group several windows per task call; the group stays at about `size` samples of each channel."""
    return windowed(samples, win).withColumn("_chunk", F.floor(F.col("win") / max(1, size // win)).cast("bigint"))


CHUNK = 1 << 13


def window_consistency(samples: DataFrame, win: int, size: int = CHUNK) -> DataFrame:
    """Per window and channel: high quantile of |correlation| with the others, and dropout."""
    schema = _schema(samples, ["recording_id"], "win bigint, ch_name string, max_corr double, dropout boolean")
    return _chunks(samples, win, size).groupBy("recording_id", "_chunk").applyInPandas(
        kernels.window_correlation("recording_id", win), schema)


def bad_by_correlation(consistency: DataFrame, threshold: float = 0.4, fraction: float = 0.01) -> DataFrame:
    share = F.avg((F.col("max_corr") < threshold).cast("double"))
    return consistency.groupBy(*CHANNEL).agg(share.alias("bad_fraction")).withColumn("is_bad", F.col("bad_fraction") > fraction)


def bad_by_dropout(consistency: DataFrame, fraction: float = 0.01) -> DataFrame:
    share = F.avg(F.col("dropout").cast("double"))
    return consistency.groupBy(*CHANNEL).agg(share.alias("bad_fraction")).withColumn("is_bad", F.col("bad_fraction") > fraction)


def bad_by_snr(hf_noise: DataFrame, low_correlation: DataFrame) -> DataFrame:
    """Channels that are bad by both rules."""
    return hf_noise.where("is_bad").select(*CHANNEL).intersect(low_correlation.where("is_bad").select(*CHANNEL))


def random_subsets(channels: DataFrame, count: int, size: int, array: str = "array", seed: int = 0) -> DataFrame:
    """(array, subset, predictor): `count` reproducible draws of `size` channels of each array (fewer where it has fewer), by an md5 of names and seed."""
    drawn = channels.select(array, "ch_name").distinct().withColumn("subset", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    code = F.md5(F.concat_ws(":", F.col(array).cast("string"), F.col("subset").cast("string"), F.col("ch_name").cast("string"), F.lit(str(seed))).cast("binary"))
    first = Window.partitionBy(array, "subset").orderBy("_code", "ch_name")  # channels of one array
    return drawn.withColumn("_code", code).withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= size).select(
        array, "subset", F.col("ch_name").alias("predictor"))


def interpolation_weights(positions: DataFrame, subsets: DataFrame, array: str = "array", ridge: float = 1e-5, piece: int = 1 << 12) -> DataFrame:
    """(array, subset, ch_name, predictor, weight): spherical spline weights that give every channel of an array from each subset of its channels.

    `positions(array, ch_name, x, y, z)` are taken as directions; channels without one (missing, or the origin) are neither predicted nor predictors.
    A task holds the predictors of an array and about `piece` of its channels.
    """
    types = dict(positions.dtypes)
    schema = f"{array} {types[array]}, subset int, ch_name {types['ch_name']}, predictor {types['ch_name']}, weight double"
    size = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    usable = positions.select(array, "ch_name", *[F.col(c).cast("double").alias(c) for c in "xyz"]).where((size > 0) & (size < float("inf")))
    at = usable.groupBy(array, "ch_name").agg(F.min(F.struct("x", "y", "z")).alias("p")).select(F.col(array).alias("_array"), "ch_name", "p.*")
    # the channels of an array are dealt to as many tasks as they need; the predictors, which are few, go to each
    pieces = at.groupBy("_array").agg(F.ceil(F.count("*") / F.lit(piece)).alias("_pieces"))
    pieces = pieces.select(F.col("_array").alias("_of"), "_pieces")
    targets = at.join(pieces, F.col("_array").eqNullSafe(F.col("_of"))).select(
        "_array", F.pmod(F.xxhash64("ch_name"), F.col("_pieces")).alias("_piece"), "ch_name", "x", "y", "z")
    chosen = subsets.select(F.col(array).alias("_for"), F.col("subset").cast("int").alias("subset"), "predictor").distinct()
    chosen = at.join(chosen, F.col("_array").eqNullSafe(F.col("_for")) & (F.col("ch_name") == F.col("predictor"))).join(pieces, F.col("_array").eqNullSafe(F.col("_of")))
    chosen = chosen.select("_array", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pieces") - 1)).alias("_piece"), "subset", "predictor", "x", "y", "z").toDF(
        "_to", "_in", "subset", "predictor", "x", "y", "z")
    return targets.groupBy("_array", "_piece").cogroup(chosen.groupBy("_to", "_in")).applyInPandas(kernels.spline_weights(array, ridge), schema)


def bad_by_ransac(samples: DataFrame, weights: DataFrame, win: int, corr_threshold: float = 0.75, fraction: float = 0.4, array: str | None = None,
                  size: int = CHUNK) -> DataFrame:
    """Correlation with the median of predictions from channel subsets, per window.

    `weights(subset, ch_name, predictor, weight)` hold for all recordings, or with `array` (a column of both tables) for those of one sensor array. They
    meet the chunks of windows by a join, in tasks that hold one chunk and the weights of one array. Every complete window of a channel is judged, from
    the channels that have it.
    """
    array = array or "_array"
    if array not in samples.columns:
        samples, weights = samples.withColumn(array, F.lit(0)), weights.withColumn(array, F.lit(0))
    kept = samples.select("recording_id", array, "ch_name", "t", "value")
    arrays = kept.groupBy("recording_id").agg(F.first(array).alias(array))
    rows = _chunks(kept, win, size)
    keys = ["recording_id", "_chunk"]
    needed = rows.select(*keys).distinct().join(arrays, "recording_id").join(weights.select(array, "subset", "ch_name", "predictor", "weight"), array)
    needed = needed.select(*keys, "subset", "ch_name", "predictor", "weight").toDF("_of", "_in", "subset", "ch_name", "predictor", "weight")
    per = rows.groupBy(*keys).cogroup(needed.groupBy("_of", "_in")).applyInPandas(
        kernels.ransac_windows("recording_id", win), _schema(samples, ["recording_id"], "win bigint, ch_name string, corr double"))
    share = F.avg((F.col("corr") < corr_threshold).cast("double"))
    return per.groupBy(*CHANNEL).agg(share.alias("bad_fraction"), F.avg("corr").alias("mean_corr")).withColumn(
        "is_bad", F.col("bad_fraction") > fraction)


def spectrum_blocks(samples: DataFrame, nperseg: int, keys: list[str], size: int = BLOCK) -> tuple[DataFrame, int]:
    """Blocks of whole hops with the samples that windows starting in the block still need."""
    hop = nperseg // 2
    length = max(2, size // hop) * hop
    blocked = with_blocks(samples.select(*keys, "t", F.col("value").cast("double").alias("value")), size=length, after=hop)
    return blocked.drop("_core").where("_block >= 0"), length


def welch_psd(samples: DataFrame, sfreq: float, nperseg: int, keys: list[str] | None = None, size: int = BLOCK) -> DataFrame:
    """Power spectrum averaged over half-overlapping windows of `nperseg` (even) samples; summed per block first."""
    keys = keys or CHANNEL
    blocked, length = spectrum_blocks(samples, nperseg, keys, size)
    sums = blocked.groupBy(*keys, "_block").applyInPandas(
        kernels.welch_sums(keys, length, nperseg, sfreq), _schema(samples, keys, "freq double, total double, n bigint"))
    return sums.groupBy(*keys, "freq").agg(F.try_divide(F.sum("total"), F.sum("n")).alias("power")).where("power is not null")


def bad_by_psd(psd: DataFrame, multiplier: float = 6.0) -> DataFrame:
    """Mean power above the mean over channels by `multiplier` deviations."""
    per = psd.groupBy(*CHANNEL).agg(F.avg("power").alias("mean_power"))
    w = Window.partitionBy("recording_id")
    limit = F.avg("mean_power").over(w) + multiplier * F.stddev_pop("mean_power").over(w)
    return per.withColumn("threshold", limit).withColumn("is_bad", F.col("mean_power") > F.col("threshold"))


def bad_channels_lof(samples: DataFrame, k: int = 20, threshold: float = 1.5) -> DataFrame:
    """Local outlier factor of channels, from distances given by blocked cross-products.

    The pair table has one row per channel pair of a recording, whatever its length.
    """
    s = pair_sums(samples, "recording_id").where("ci <> cj")
    d = s.select("recording_id", "ci", "cj", F.sqrt(F.greatest(F.col("sxx") + F.col("syy") - 2 * F.col("sxy"), F.lit(0e0))).alias("d"))
    both = d.unionByName(d.select("recording_id", F.col("cj").alias("ci"), F.col("ci").alias("cj"), "d"))
    w = Window.partitionBy("recording_id", "ci").orderBy("d", "cj")
    near = both.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    kd = near.groupBy("recording_id", "ci").agg(F.max("d").alias("_kd"))
    reach = near.join(kd.withColumnRenamed("ci", "cj"), ["recording_id", "cj"]).withColumn("_reach", F.greatest("d", "_kd"))
    density = reach.groupBy("recording_id", "ci").agg((1 / (F.avg("_reach") + 1e-10)).alias("lrd"))
    pairs = near.join(density.select("recording_id", F.col("ci").alias("cj"), F.col("lrd").alias("_other")), ["recording_id", "cj"])
    mean = pairs.groupBy("recording_id", "ci").agg(F.avg("_other").alias("_mean"))
    return mean.join(density, ["recording_id", "ci"]).select(
        "recording_id", F.col("ci").alias("ch_name"), (F.col("_mean") / F.col("lrd")).alias("lof")).withColumn(
        "is_bad", F.col("lof") >= threshold)


def channel_correlation_matrix(samples: DataFrame) -> DataFrame:
    """Pearson correlation of all channel pairs, zero on the diagonal, both directions."""
    c = correlation(pair_sums(samples, "recording_id")).select("recording_id", "ci", "cj", "corr")
    off = c.where("ci <> cj")
    return off.unionByName(off.select("recording_id", F.col("cj").alias("ci"), F.col("ci").alias("cj"), "corr")).unionByName(
        c.where("ci = cj").withColumn("corr", F.lit(0e0)))


def merge_detectors(detections: list[tuple[str, DataFrame]], bads: DataFrame) -> DataFrame:
    """Bad channels with the detectors that found them, in detector order."""
    found = None
    for i, (source, df) in enumerate(detections):
        part = df.select(*CHANNEL).distinct().withColumn("_s", F.struct(F.lit(i).alias("i"), F.lit(source).alias("source")))
        found = part if found is None else found.unionByName(part)
    listed = found.groupBy(*CHANNEL).agg(F.transform(F.array_sort(F.collect_set("_s")), lambda s: s["source"]).alias("sources"))
    every = bads.select(*CHANNEL).unionByName(found.select(*CHANNEL)).distinct()
    manual = F.array(F.lit("Manual or pre-existing"))
    return every.join(listed, CHANNEL, "left").select(*CHANNEL, F.coalesce("sources", manual).alias("sources"))


# ------------------------------------------------------- extreme studentized deviate

def bad_channels_gesd(samples: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Standard deviation per channel, tested within its type."""
    std = samples.groupBy("recording_id", "ch_type", "ch_name").agg(F.stddev_pop("value").alias("metric"))
    return gesd(std, ["recording_id", "ch_type"], "ch_name", "metric", alpha)


def segment_metric(metric: str) -> Column:
    v = finite("value")
    agg = {"std": F.stddev_pop, "var": F.var_pop, "kurtosis": F.kurtosis}[metric](v)
    return F.coalesce(finite(agg), F.lit(0e0))


def _series(samples: DataFrame, mode: str | None, size: int) -> tuple[DataFrame, int]:
    """The tested series and the shift of its clock against the recording's."""
    if mode != "diff":
        return samples, 0
    d = neighbours(samples, ["recording_id", "ch_name"], {"_prev": ("value", -1)}, size=size).where("_prev is not null")
    return d.withColumn("value", F.col("value") - F.col("_prev")).withColumn("t", F.col("t") - 1).drop("_prev"), 1


def _flag_intervals(flags: DataFrame, lengths: DataFrame, keys: list[str], segment_len: int, shift: int, sfreq: float) -> DataFrame:
    """Bad segment numbers -> annotations. The onset is the last good sample before the run (or 0)."""
    runs = islands(flags.where("is_outlier"), keys, "segment").join(lengths, keys)
    onset = F.greatest(F.col("start") * segment_len - 1, F.lit(0))
    offset = F.least(F.col("stop") * segment_len, F.col("_n")) - 1
    return runs.select(*keys, ((onset + shift) / F.lit(sfreq)).alias("onset"), ((offset - onset) / F.lit(sfreq)).alias("duration"))


def bad_segments_gesd(samples: DataFrame, sfreq: float, segment_len: int = 1000, metric: str = "std", mode: str | None = None,
                      alpha: float = 0.05, size: int = BLOCK) -> DataFrame:
    """Segments whose metric over all channels is an outlier, as intervals."""
    series, shift = _series(samples.select("recording_id", "ch_type", "ch_name", "t", "value"), mode, size)
    keys = ["recording_id", "ch_type"]
    seg = series.withColumn("segment", F.floor(F.col("t") / segment_len).cast("bigint"))
    flags = gesd(seg.groupBy(*keys, "segment").agg(segment_metric(metric).alias("metric")), keys, "segment", "metric", alpha)
    lengths = series.groupBy(*keys).agg((F.max("t") + 1).alias("_n"))
    return _flag_intervals(flags, lengths, keys, segment_len, shift, sfreq)


def bad_segments_channelwise(samples: DataFrame, sfreq: float, segment_len: int, metric: str = "std", threshold: float | str = 0.05,
                             alpha: float = 0.05) -> DataFrame:
    """Outlier segments per channel; a segment is bad if enough (or any) channels call it bad."""
    keys = ["recording_id", "ch_type"]
    seg = samples.withColumn("segment", F.floor(F.col("t") / segment_len).cast("bigint"))
    per = seg.groupBy(*keys, "ch_name", "segment").agg(segment_metric(metric).alias("metric"))
    flags = gesd(per, [*keys, "ch_name"], "segment", "metric", alpha)
    n_channels = samples.groupBy(*keys).agg(F.count_distinct("ch_name").alias("_ch"), (F.max("t") + 1).alias("_n"))
    votes = flags.groupBy(*keys, "segment").agg(F.count_if("is_outlier").alias("_bad")).join(n_channels, keys)
    rule = F.col("_bad") > 0 if threshold == "any" else F.col("_bad") >= F.lit(float(threshold)) * F.col("_ch")
    return _flag_intervals(votes.withColumn("is_outlier", rule).drop("_n"), n_channels.drop("_ch"), keys, segment_len, 0, sfreq)


def bad_epochs_gesd(epochs: DataFrame, metric: str = "std", alpha: float = 0.05, p_out: float = 0.1, side: int = 0) -> DataFrame:
    """Mean over channels of the per-epoch metric, tested over the epochs of a recording."""
    keys = ["recording_id", "ch_type"]
    per_channel = epochs.groupBy(*keys, "epoch", "ch_name").agg(segment_metric(metric).alias("m"))
    per_epoch = per_channel.groupBy(*keys, "epoch").agg(F.avg("m").alias("metric"))
    return gesd(per_epoch, keys, "epoch", "metric", alpha, p_out, side)


# ----------------------------------------------------------- amplitude and muscle

def annotate_amplitude(samples: DataFrame, sfreq: float, peak: float | None, flat: float | None, bad_percent: float = 5.0,
                       min_samples: int = 1, size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Spans with too large (`BAD_peak`) or too small (`BAD_flat`) steps, and channels that are bad too often.

    Channels above `bad_percent` are reported as bad channels and do not mark time spans.
    """
    d = neighbours(samples.select("recording_id", "ch_name", "t", "value"), CHANNEL, {"_next": ("value", 1)}, size=size)
    step = F.abs(F.col("_next") - F.col("value"))
    flags = d.where("_next is not null").select(
        *CHANNEL, "t", F.inline(F.array(
            F.struct(F.lit("BAD_peak").alias("description"), (step >= peak if peak is not None else F.lit(False)).alias("hit")),
            F.struct(F.lit("BAD_flat").alias("description"), (step <= flat if flat is not None else F.lit(False)).alias("hit")))))
    share = flags.groupBy(*CHANNEL, "description").agg((F.avg(F.col("hit").cast("double")) * 100).alias("percent"))
    bad_channels = share.where(F.col("percent") > bad_percent)
    good = flags.where("hit").join(bad_channels, [*CHANNEL, "description"], "left_anti")
    marked = good.select("recording_id", "description", "t").distinct()
    runs = islands(marked, ["recording_id", "description"], size=size).where(F.col("stop") - F.col("start") >= min_samples)
    spans = runs.select("recording_id", (F.col("start") / F.lit(sfreq)).alias("onset"),
                        ((F.col("stop") - F.col("start")) / F.lit(sfreq)).alias("duration"), "description")
    return spans, bad_channels


def muscle_zscore(samples: DataFrame, sfreq: float, band: tuple[float, float] = (110.0, 140.0), threshold: float = 4.0,
                  min_good: float = 0.1, taps: int = 129, cutoff: float = 4.0, smooth_taps: int | None = None, size: int = BLOCK) -> DataFrame:
    """Spans where the summed z-score of the band envelope is high.

    Envelope by a pair of filters a quarter apart, z over each whole channel, sum over channels / sqrt(count), zero-phase low-pass at `cutoff` Hz
    (`smooth_taps` long, by default for a transition of 2 Hz); good gaps shorter than `min_good` seconds are swallowed. All filters have their whole
    halo, so the result does not depend on the block size.
    """
    pair = kernels.analytic_taps(band[0], band[1], sfreq, taps)
    halo = len(pair[0]) // 2
    smooth_taps = smooth_taps or int(1.65 * sfreq) // 2 * 2 + 1
    cols = samples.select(*CHANNEL, "t", F.col("value").cast("double").alias("value"))
    env = with_blocks(cols, size=size, before=halo, after=halo, wide=True).groupBy(*CHANNEL, "_block").applyInPandas(
        kernels.envelope_block(CHANNEL, *pair), _schema(samples, CHANNEL, "t bigint, envelope double"))
    stats = env.groupBy(*CHANNEL).agg(F.avg("envelope").alias("_m"), F.stddev_pop("envelope").alias("_s"))
    z = env.join(stats, CHANNEL).withColumn("z", F.when(F.col("_s") > 0, (F.col("envelope") - F.col("_m")) / F.col("_s")).otherwise(0e0))
    total = z.groupBy("recording_id", "t").agg((F.sum("z") / F.sqrt(F.count("*"))).alias("score"))
    smoothed = filtered(total.withColumnRenamed("score", "value"), kernels.lowpass_taps(cutoff, sfreq, smooth_taps), "smoothed", size, ["recording_id"])
    runs = islands(smoothed.where(F.col("smoothed") > threshold), ["recording_id"], extra={"peak": "smoothed"}, size=size)
    merged = merge_overlaps(runs, ["recording_id"], float(size), gap=int(min_good * sfreq), extra={"peak": "peak"})
    return merged.select("recording_id", (F.col("start") / F.lit(sfreq)).alias("onset"),
                         ((F.col("stop") - F.col("start")) / F.lit(sfreq)).alias("duration"), "peak", F.lit("BAD_muscle").alias("description"))


# -------------------------------------------------------------- epoch z-scores

def _zscored(df: DataFrame, keys: list[str], metrics: list[str], threshold: float) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])
    items = [c for c in df.columns if c not in metrics]
    long = df.select(*items, F.inline(rows))
    stats = long.groupBy(*keys, "metric").agg(F.avg("value").alias("_m"), F.stddev_pop("value").alias("_s"))
    z = long.join(stats, [*keys, "metric"])
    return z.select(*items, "metric", "value", F.when(F.col("_s") > 0, (F.col("value") - F.col("_m")) / F.col("_s")).otherwise(0e0)
                    .alias("z")).withColumn("is_outlier", F.abs("z") > threshold)


def _line_power(k: Column, value: Column, sfreq: float, freqs: list[float]) -> Column:
    """Power at the line frequencies relative to the variance (one DFT coefficient each)."""
    power = F.lit(0e0)
    for f in freqs:
        phase = k * F.lit(2 * 3.141592653589793 * f / sfreq)
        c, s = F.sum(value * F.cos(phase)), F.sum(value * F.sin(phase))
        power = power + (c * c + s * s) / (F.count(value) * F.count(value))
    return F.when(F.var_pop(value) > 0, power / F.var_pop(value)).otherwise(0e0)


def epoch_zscore_outliers(epochs: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Epochs with an outlying mean peak-to-peak, deviation from the channel means, or variance."""
    per = epochs.groupBy("recording_id", "epoch", "ch_name").agg(
        (F.max("value") - F.min("value")).alias("ptp"), F.avg("value").alias("mean"), F.var_pop("value").alias("var"))
    overall = epochs.groupBy(*CHANNEL).agg(F.avg("value").alias("overall"))
    one = per.join(overall, CHANNEL).groupBy("recording_id", "epoch").agg(
        F.avg("ptp").alias("amplitude"), F.avg(F.abs(F.col("mean") - F.col("overall"))).alias("deviation"), F.avg("var").alias("variance"))
    return _zscored(one, ["recording_id"], ["amplitude", "deviation", "variance"], threshold)


def channel_zscore_outliers(epochs: DataFrame, sfreq: float, before: int, after: int, line_freqs: list[float] | None = None,
                            threshold: float = 3.0) -> DataFrame:
    """Channels with an outlying variance, correlation with the others, kurtosis or line noise.

    `before` and `after` are the epoch bounds: they lay the epochs out on one clock.
    """
    flat = epochs.withColumn("t", F.col("epoch") * (before + after + 1) + F.col("k") + before)
    line = _line_power(F.col("k"), F.col("value"), sfreq, line_freqs or [50.0, 60.0])
    per_epoch = epochs.groupBy(*CHANNEL, "epoch").agg(line.alias("line"))
    base = epochs.groupBy(*CHANNEL).agg(F.var_pop("value").alias("variance"), F.kurtosis("value").alias("kurtosis"))
    base = base.join(per_epoch.groupBy(*CHANNEL).agg(F.avg("line").alias("line_noise")), CHANNEL)
    pairs = correlation(pair_sums(flat, "recording_id")).where("ci <> cj").select("recording_id", "ci", "cj", F.abs("corr").alias("corr"))
    corr = pairs.select("recording_id", F.explode(F.array("ci", "cj")).alias("ch_name"), "corr").groupBy(*CHANNEL).agg(
        F.avg("corr").alias("correlation"))
    full = base.join(corr, CHANNEL, "left")
    return _zscored(full, ["recording_id"], ["variance", "correlation", "kurtosis", "line_noise"], threshold)


def channel_epoch_zscore_outliers(epochs: DataFrame, sfreq: float, line_freqs: list[float] | None = None, threshold: float = 3.0) -> DataFrame:
    """Channels of single epochs: variance, deviation, amplitude, median gradient, line noise; z over the epoch's channels."""
    w = Window.partitionBy("recording_id", "epoch", "ch_name").orderBy("k")  # one epoch long
    d = epochs.withColumn("_g", F.abs(F.col("value") - F.lag("value").over(w)))
    per = d.groupBy("recording_id", "epoch", "ch_name").agg(
        F.var_pop("value").alias("variance"), F.avg("value").alias("_mean"), (F.max("value") - F.min("value")).alias("amplitude"),
        F.percentile("_g", F.lit(0.5)).alias("median_gradient"),
        _line_power(F.col("k"), F.col("value"), sfreq, line_freqs or [50.0, 60.0]).alias("line_noise"))
    overall = epochs.groupBy(*CHANNEL).agg(F.avg("value").alias("_overall"))
    one = per.join(overall, CHANNEL).withColumn("deviation", F.abs(F.col("_mean") - F.col("_overall"))).drop("_mean", "_overall")
    return _zscored(one, ["recording_id", "epoch"], ["variance", "deviation", "amplitude", "median_gradient", "line_noise"], threshold)

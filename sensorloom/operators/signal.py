"""Per-channel and per-recording signal metrics.

Input: `samples(dataset, recording_id, ch_name, ch_type, t, value)` with a dense clock `t`
per channel. Channels of one recording are few (hundreds), samples are not: statistics over
samples use hash aggregates, blocks or exact two-pass quantiles; statistics over the channels
of a recording use the built-in percentile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.expr import MAD_TO_SD, finite, half_even
from ..plans.blocks import BLOCK, neighbours, rolling, with_blocks
from ..plans.fourier import LINE, fourier
from ..plans.intervals import range_join
from ..plans.quantiles import median_and_mad
from ..session import materialize

CHANNEL = ["recording_id", "ch_type", "ch_name"]
TINY = 2.2250738585072014e-308


def sample_counts(samples: DataFrame) -> DataFrame:
    return samples.groupBy(*CHANNEL).agg((F.max("t") + 1).alias("n_times"))


def channel_max_abs_diff(samples: DataFrame, size: int = BLOCK) -> DataFrame:
    """Largest absolute first difference per channel."""
    d = neighbours(samples.select(*CHANNEL, "t", "value"), CHANNEL, {"prev": ("value", -1)}, size=size)
    return d.groupBy(*CHANNEL).agg(F.max(finite(F.abs(F.col("value") - F.col("prev")))).alias("max_abs_diff"))


def channel_metrics(samples: DataFrame, size: int = BLOCK) -> DataFrame:
    """`max_abs_diff` and `ptp` of each channel in a single pass."""
    d = neighbours(samples.select(*CHANNEL, "t", "value"), CHANNEL, {"prev": ("value", -1)}, size=size)
    v = finite("value")
    return d.groupBy(*CHANNEL).agg(F.max(finite(F.abs(F.col("value") - F.col("prev")))).alias("max_abs_diff"),
                                   (F.max(v) - F.min(v)).alias("ptp"))


def channel_ptp(samples: DataFrame) -> DataFrame:
    v = finite("value")
    return samples.groupBy(*CHANNEL).agg((F.max(v) - F.min(v)).alias("ptp"))


def summarize_vector(values: DataFrame, keys: list[str], value: str, prefix: str) -> DataFrame:
    """Thirteen statistics over the channels of a group, as long (metric, value) rows."""
    v = finite(value)
    stats = values.groupBy(*keys).agg(
        F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.percentile(v, [0.05, 0.25, 0.5, 0.75, 0.95]).alias("q"), F.avg(F.abs(v)).alias("abs_mean"),
        F.percentile(F.abs(v), F.lit(0.95)).alias("abs_q95"), F.max(F.abs(v)).alias("abs_max"),
    )
    named = {"mean": F.col("mean"), "std": F.col("std"), "min": F.col("min"), "max": F.col("max"),
             "abs_mean": F.col("abs_mean"), "abs_q95": F.col("abs_q95"), "abs_max": F.col("abs_max"),
             "q05": F.col("q")[0], "q25": F.col("q")[1], "median": F.col("q")[2], "q75": F.col("q")[3],
             "q95": F.col("q")[4], "iqr": F.col("q")[3] - F.col("q")[1]}
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("stat"), c.alias("value")) for n, c in named.items()]))
    return stats.select(*keys, rows.alias("s")).where("s.value is not null").select(
        *keys, F.concat(F.lit(prefix + "."), F.col("ch_type"), F.lit("."), F.col("s.stat")).alias("metric"), "s.value")


def uniform_subsample(samples: DataFrame, n: int) -> DataFrame:
    """Keep samples at the truncated positions of `n` evenly spaced points; all if fewer."""
    counted = samples.join(sample_counts(samples), CHANNEL)
    step = (F.col("n_times") - 1) / F.lit(n - 1)
    k = F.floor(F.try_divide(F.col("t"), step))
    hit = F.lit(False)
    for j in (0, 1, 2):
        c = k + j
        hit = hit | ((c <= n - 1) & (F.floor(F.when(c == n - 1, F.col("n_times") - 1).otherwise(c * step)) == F.col("t")))
    return counted.where((F.col("n_times") <= n) | hit).drop("n_times")


def spectral_shape(samples: DataFrame, line: int = LINE) -> DataFrame:
    """Mean skewness and kurtosis of the amplitude spectrum of whole channels per recording and channel type.

    Channels of up to `line` samples are transformed by one task each, longer ones by rows and columns; the length of the longest
    one is read first, as the plan for long ones has many stages.
    """
    longest = samples.agg(F.max("t")).first()[0]
    counted = samples.join(sample_counts(samples), CHANNEL).select(*CHANNEL, "t", "value", F.col("n_times").alias("n"))
    types = dict(samples.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in CHANNEL) + ", skewness double, kurtosis double"
    short = counted.where(F.col("n") <= line).drop("n").groupBy(*CHANNEL).applyInPandas(kernels.spectral_shape(CHANNEL), schema)
    if longest is None or longest < line:
        return _mean_shape(short)
    long = fourier(counted.where(F.col("n") > line), CHANNEL, "value", line).where(F.col("k") < F.floor(F.col("n") / 2))
    size = F.when(F.col("k") > 0, F.hypot("re", "im") / F.col("n")).otherwise(0e0)
    level = F.sum(size) > 2.220446049250313e-16
    long = long.groupBy(*CHANNEL).agg(F.when(level, F.coalesce(F.skewness(size), F.lit(0e0))).otherwise(0e0).alias("skewness"),
                                      F.when(level, F.coalesce(F.kurtosis(size) + 3, F.lit(0e0))).otherwise(0e0).alias("kurtosis"))
    return _mean_shape(short.unionByName(long))


def _mean_shape(channels: DataFrame) -> DataFrame:
    return channels.groupBy("recording_id", "ch_type").agg(
        F.avg(finite("skewness")).alias("skewness_amplitude"), F.avg(finite("kurtosis")).alias("kurtosis_amplitude"))


def segment_bounds(recordings: DataFrame, seconds: float) -> DataFrame:
    """(recording, segment, start, stop): the last partial segment is kept; neighbours share a sample."""
    duration = F.col("n_times") / F.col("sfreq")
    whole = (F.lit(seconds) <= 0) | (F.lit(seconds) >= duration)
    length = F.lit(float(seconds)) if seconds > 0 else duration
    many = F.sequence(F.lit(0), (F.ceil(duration / length) - 1).cast("int"))
    seg = recordings.where("n_times > 0").withColumn(
        "segment", F.explode(F.when(whole, F.array(F.lit(0))).otherwise(many)))
    start = half_even(F.col("segment") * F.lit(float(seconds)) * F.col("sfreq"))
    stop_s = F.least((F.col("segment") + 1) * F.lit(float(seconds)), duration)
    stop = F.least(half_even(stop_s * F.col("sfreq")) + 1, F.col("n_times"))
    return seg.select("recording_id", "segment", F.when(whole, 0).otherwise(start).cast("bigint").alias("start"),
                      F.when(whole, F.col("n_times")).otherwise(stop).cast("bigint").alias("stop")).where("stop > start")


def segmented_dfa(samples: DataFrame, segment_samples: int, size: int = BLOCK) -> DataFrame:
    """DFA exponent per segment and channel, averaged over segments, then over channels.

    A task works on a chunk of whole segments; each segment includes its right end point.
    """
    chunk = max(1, size // segment_samples) * segment_samples
    blocked = with_blocks(samples.select(*CHANNEL, "t", "value"), size=chunk, after=1).where("_block >= 0")
    types = dict(samples.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in CHANNEL) + ", segment bigint, dfa double"
    per_segment = blocked.groupBy(*CHANNEL, "_block").applyInPandas(kernels.dfa_segments(CHANNEL, segment_samples), schema)
    per_channel = per_segment.groupBy(*CHANNEL).agg(F.avg(finite("dfa")).alias("dfa"))
    return per_channel.groupBy("recording_id", "ch_type").agg(F.avg("dfa").alias("dfa"))


def flat_ratio(samples: DataFrame, threshold: float, size: int = BLOCK) -> DataFrame:
    """Share of samples whose step from the previous sample is at most `threshold` (denominator: all samples)."""
    d = neighbours(samples.select(*CHANNEL, "t", "value"), CHANNEL, {"prev": ("value", -1)}, size=size)
    return d.groupBy(*CHANNEL).agg(
        (F.count_if(F.abs(F.col("value") - F.col("prev")) <= threshold) / F.count("*")).alias("flat_ratio"))


def _bins(samples: DataFrame, n_bins: int) -> DataFrame:
    counted = samples.join(sample_counts(samples), CHANNEL)
    bins = F.least(F.lit(n_bins), F.col("n_times"))
    return counted.withColumn(
        "bin", F.floor((((F.col("t") + 1) * bins) - 1) / F.col("n_times")).cast("bigint"))


def envelope_bins(samples: DataFrame, sfreq: float, n_bins: int = 1600, with_median: bool = True) -> DataFrame:
    """Minimum, maximum and median per channel and time bin, with the bin's centre time."""
    binned = _bins(samples.select(*CHANNEL, "t", "value"), n_bins)
    keys = [*CHANNEL, "bin"]
    v = finite("value")
    # a bin holds a fixed share of a channel, so its values are counted in one group
    median = [F.percentile(v, F.lit(0.5)).alias("vmedian")] if with_median else []
    return binned.groupBy(*keys).agg(
        F.min(v).alias("vmin"), F.max(v).alias("vmax"),
        (F.lit(0.5) * (F.min("t") + F.max("t")) / F.lit(float(sfreq))).alias("time"), *median)


def robust_peak_score(samples: DataFrame, sfreq: float, n_bins: int = 1600) -> DataFrame:
    """Largest excursion per channel and bin, in robust deviations of all samples of the channel."""
    keys = CHANNEL
    finite_only = samples.select(*keys, finite("value").alias("value"))
    scale = median_and_mad(finite_only, keys, "value").withColumn("scale", F.col("mad") * F.lit(MAD_TO_SD)).drop("mad")
    usable = F.when(F.col("scale") > TINY, F.col("scale"))
    rec, typ = Window.partitionBy("recording_id"), Window.partitionBy("recording_id", "ch_type")
    scales = (
        scale.withColumn("global_scale", F.coalesce(F.percentile(usable, F.lit(0.5)).over(rec), F.lit(1e0)))
        .withColumn("shared_scale", F.coalesce(F.percentile(usable, F.lit(0.5)).over(typ), F.col("global_scale")))
        .withColumn("channel_scale", F.coalesce(usable, F.col("shared_scale")))
    )
    env = envelope_bins(samples, sfreq, n_bins, with_median=False).join(scales, keys)
    excursion = F.greatest(F.abs(F.col("vmin") - F.col("center")), F.abs(F.col("vmax") - F.col("center")))
    score = F.coalesce(finite(F.greatest(excursion / F.col("channel_scale"), excursion / F.col("shared_scale"))), F.lit(0e0))
    return env.select(*keys, "bin", "time", score.alias("peak_score"))


def affected_fraction(scores: DataFrame, bad_spans: DataFrame, threshold: float = 6.0) -> DataFrame:
    """Percent of channels at or above the threshold and the largest score per bin; bins touching a BAD span."""
    # written once, as three branches read it and `scores` would be derived in each of them
    per_bin = materialize(scores.groupBy("recording_id", "bin").agg(
        (F.avg((F.col("peak_score") >= threshold).cast("double")) * 100).alias("affected_pct"),
        F.max("peak_score").alias("max_score"), F.avg("time").alias("time")))
    # one row per bin (at most the display resolution), so this window is bounded per recording
    w = Window.partitionBy("recording_id").orderBy("bin")
    rec = Window.partitionBy("recording_id")
    stepped = per_bin.withColumn("_step", F.col("time") - F.lag("time").over(w)).withColumn(
        "_half", F.coalesce(F.percentile("_step", F.lit(0.5)).over(rec) * 0.5, F.lit(0e0)))
    limits = stepped.groupBy("recording_id").agg(
        F.min("time").alias("_first"), F.max("time").alias("_last"), F.first("_half").alias("_pad"))
    spans = bad_spans.join(limits, "recording_id").select(
        "recording_id", F.greatest(F.col("onset"), F.col("_first")).alias("s"),
        F.least(F.col("onset") + F.greatest(F.col("duration"), F.lit(0e0)), F.col("_last")).alias("e"), "_pad",
    ).where("e > s")
    # spans are padded by half a step, so in bins of a step a short one meets two or three, however long the recording is
    points = per_bin.select("recording_id", "bin", "time").join(limits.select("recording_id", "_pad"), "recording_id")
    hit = range_join(points, spans, ["recording_id"], F.col("time"), F.col("s") - F.col("_pad"), F.col("e") + F.col("_pad"),
                     F.greatest(F.lit(60e0), F.col("_pad") * 2), "left_semi", closed=True)
    return per_bin.join(hit.select("recording_id", "bin").withColumn("_bad", F.lit(True)), ["recording_id", "bin"], "left") \
        .select("recording_id", "bin", "affected_pct", "max_score", F.coalesce("_bad", F.lit(False)).alias("is_bad"))


def sum_square_trace(samples: DataFrame, bad_spans: DataFrame, sfreq: float, size: int = BLOCK) -> DataFrame:
    """Sum of squares over channels per sample, BAD samples set to the good mean, one-second moving mean."""
    power = samples.groupBy("recording_id", "ch_type", "t").agg(F.sum(F.col("value") * F.col("value")).alias("ss"))
    bad = range_join(power.select("recording_id", "t").distinct(), bad_spans, ["recording_id"],
                     F.col("t") / F.lit(float(sfreq)), F.col("onset"), F.col("onset") + F.col("duration"), 60.0, "left_semi")
    flagged = power.join(bad.withColumn("_bad", F.lit(True)), ["recording_id", "t"], "left")
    good = flagged.where("_bad is null").groupBy("recording_id", "ch_type").agg(F.avg("ss").alias("_good"))
    filled = flagged.join(good, ["recording_id", "ch_type"], "left").withColumn(
        "ss", F.when(F.col("_bad"), F.col("_good")).otherwise(F.col("ss"))).drop("_good", "_bad")
    half = int(sfreq) // 2
    return rolling(filled, ["recording_id", "ch_type"], "trace", F.avg("ss"), half, int(sfreq) - 1 - half, size=size)


def channel_std_histogram(samples: DataFrame, bins: int = 24) -> DataFrame:
    """Equal-width histogram, per recording and type, of the channels' standard deviations."""
    std = samples.groupBy(*CHANNEL).agg(F.stddev_pop(finite("value")).alias("std"))
    w = Window.partitionBy("recording_id", "ch_type")
    span = std.withColumn("lo", F.min("std").over(w)).withColumn("hi", F.max("std").over(w))
    # a single value gets the unit-width range around it
    lo = F.when(F.col("hi") > F.col("lo"), F.col("lo")).otherwise(F.col("lo") - 0.5)
    width = F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")).otherwise(F.lit(1e0))
    b = F.least(F.floor((F.col("std") - lo) / width * bins), F.lit(bins - 1)).cast("bigint")
    return span.groupBy("recording_id", "ch_type", b.alias("bin")).agg(
        F.count("*").alias("n"), F.first(lo + b * width / bins).alias("left_edge"))

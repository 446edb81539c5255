"""Interval algebra on annotations and model windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import half_even
from ..plans.intervals import islands, merge_overlaps, overlap_filter
from ..plans.scans import prefix_scan
from .events import annotation_to_samples

DAY = 86_400.0


def runs_to_intervals(windows: DataFrame, keys: list[str], duration: float, window: str = "win",
                      flag: str = "flag") -> DataFrame:
    """Consecutive flagged windows -> [onset, end) in seconds."""
    runs = islands(windows.where(F.col(flag)), keys, window)
    return runs.select(*keys, (F.col("start") * duration).alias("onset"), (F.col("stop") * duration).alias("end"))


def hysteresis_intervals(windows: DataFrame, keys: list[str], high: float, low: float, duration: float,
                         merge_gap: float = 0.0, min_duration: float = 0.0, keep: float | None = None,
                         window: str = "win", prob: str = "prob") -> DataFrame:
    """Runs at or above `low` that reach `high`; near runs merged; short ones dropped unless strong."""
    if low > high:
        raise ValueError("low threshold above high threshold")
    runs = islands(windows.where(F.col(prob) >= low), keys, window, {"max_prob": prob}).where(F.col("max_prob") >= high)
    gap = math.floor(merge_gap / duration + 1e-9)
    if gap > 0:
        runs = merge_overlaps(runs, keys, 4096, gap=gap, extra={"max_prob": "max_prob"})
    length = (F.col("stop") - F.col("start")) * duration
    short = (length < min_duration) & (F.lit(True) if keep is None else F.col("max_prob") < keep)
    return runs.where(~short & (length > 0)).select(
        *keys, (F.col("start") * duration).alias("onset"), (F.col("stop") * duration).alias("end"), "max_prob")


def merge_intervals(spans: DataFrame, recordings: DataFrame, keys: list[str], bucket_width: float) -> DataFrame:
    """Union of overlapping or touching sample spans, clipped to the recording."""
    clipped = spans.join(recordings.select("recording_id", "n_times"), "recording_id").select(
        *keys, F.greatest(F.col("start"), F.lit(0)).alias("start"), F.least(F.col("stop"), F.col("n_times")).alias("stop")
    ).where("stop > start")
    return merge_overlaps(clipped, keys, bucket_width)


def bad_coverage(spans: DataFrame, recordings: DataFrame, bucket_width: float) -> DataFrame:
    """Bad, usable samples and bad fraction per recording, overlaps counted once."""
    merged = merge_intervals(spans, recordings, ["recording_id"], bucket_width)
    bad = merged.groupBy("recording_id").agg(F.sum(F.col("stop") - F.col("start")).alias("bad_samples"))
    return recordings.join(bad, "recording_id", "left").select(
        "recording_id", "n_times", F.coalesce("bad_samples", F.lit(0)).alias("bad_samples"),
        (F.col("n_times") - F.coalesce("bad_samples", F.lit(0))).alias("usable_samples"),
        F.when(F.col("n_times") > 0, F.coalesce("bad_samples", F.lit(0)) / F.col("n_times")).otherwise(0e0).alias("bad_fraction"))


def bad_segment_stats(annotations: DataFrame, recordings: DataFrame) -> DataFrame:
    """Number, summed duration (overlaps not merged) and share of the recording."""
    stats = annotations.groupBy("recording_id").agg(
        F.count("*").alias("n_segments"), F.sum("duration").alias("bad_seconds"))
    return recordings.join(stats, "recording_id", "left").select(
        "recording_id", F.coalesce("n_segments", F.lit(0)).alias("n_segments"),
        F.coalesce("bad_seconds", F.lit(0e0)).alias("bad_seconds"),
        (F.coalesce("bad_seconds", F.lit(0e0)) / (F.col("n_times") / F.col("sfreq"))).alias("bad_ratio"))


def bad_time_by_modality(annotations: DataFrame, recordings: DataFrame) -> DataFrame:
    """Samples, seconds and percent covered by the bad segments of each modality, overlaps counted once."""
    first = F.greatest(F.ceil(F.col("onset") * F.col("sfreq")), F.lit(0))
    last = F.least(F.floor((F.col("onset") + F.col("duration")) * F.col("sfreq")), F.col("n_times") - 1)
    spans = annotations.join(recordings, "recording_id").select(
        "recording_id", "modality", first.alias("start"), (last + 1).alias("stop")).where("stop > start")
    merged = merge_overlaps(spans, ["recording_id", "modality"], DAY)
    covered = merged.groupBy("recording_id", "modality").agg(F.sum(F.col("stop") - F.col("start")).alias("bad_samples"))
    return covered.join(recordings, "recording_id").select(
        "recording_id", "modality", "bad_samples", (F.col("bad_samples") / F.col("sfreq")).alias("bad_seconds"),
        (F.col("bad_samples") * 100 / F.col("n_times")).alias("bad_percent"))


def annotate_break(annotations: DataFrame, min_break: float, bucket_width: float = DAY, lead_in: float = 0.0, lead_out: float = 0.0,
                   ignore: tuple[str, ...] = (), recordings: DataFrame | None = None) -> DataFrame:
    """Gaps between the end of everything so far and the next annotation that last at least `min_break`.

    A break starts `lead_in` after the last annotation and ends `lead_out` before the next one. Annotations whose text starts with one of
    `ignore` (in any case) do not count. With `recordings(recording_id, start, stop)`, gaps at both ends of a recording count too, without
    a lead at the recording's own end.
    """
    if lead_in + lead_out > min_break:
        raise ValueError("the leads of a break exceed its least length")
    named = F.lower("description")
    counted = annotations.where(~F.coalesce(F.array_contains(F.array(*[named.startswith(w.lower()) for w in ignore]), True), F.lit(False))) if ignore else annotations
    ends = counted.select("recording_id", F.col("onset").cast("double").alias("onset"), (F.col("onset") + F.col("duration")).cast("double").alias("end"), F.lit(0).alias("edge"))
    if recordings is not None:
        for edge, at in ((-1, "start"), (1, "stop")):
            moment = F.col(at).cast("double")
            ends = ends.unionByName(recordings.select("recording_id", moment.alias("onset"), moment.alias("end"), F.lit(edge).alias("edge")))
    # whether the furthest end so far is that of an annotation rather than the recording's start
    ends = ends.withColumn("last", F.struct("end", (F.col("edge") == 0).alias("inner")))
    bucket = F.floor(F.col("onset") / F.lit(bucket_width)).cast("bigint")
    seen = prefix_scan(ends, ["recording_id"], bucket, ["onset", "end", "edge"], {"reach": ("max", "last")}, inclusive=False)
    gap = F.col("onset") - F.col("reach.end")
    start = F.col("reach.end") + F.when(F.col("reach.inner"), lead_in).otherwise(0.0)
    stop = F.col("onset") - F.when(F.col("edge") == 1, 0.0).otherwise(lead_out)
    return seen.where((gap >= min_break) & (stop > start)).select(
        "recording_id", start.alias("onset"), (stop - start).alias("duration"), F.lit("BAD_break").alias("description")).distinct()


def artifact_mask_bins(channels: DataFrame, annotations: DataFrame, recordings: DataFrame, max_bins: int = 2400,
                       min_bins: int = 240) -> DataFrame:
    """Mask code per channel and time bin: 0 good, 1 bad segment, 2 bad channel, 3 both.

    The grid has at most `max_bins` columns per channel whatever the recording length.
    """
    sized = channels.groupBy("recording_id").agg(F.count("*").alias("n_channels")).join(recordings, "recording_id")
    n_bins = F.least(F.lit(max_bins), F.greatest(F.lit(min_bins), F.least(F.col("n_times"), F.col("n_channels") * 10)))
    sized = sized.withColumn("n_bins", n_bins.cast("bigint"))
    spans = annotation_to_samples(annotations, recordings).where("stop > start").join(
        sized.select("recording_id", "n_bins"), "recording_id")
    first = F.least(F.floor(F.col("start") / F.col("n_times") * F.col("n_bins")).cast("bigint"), F.col("n_bins") - 1)
    last = F.greatest(first + 1, F.least(F.ceil(F.col("stop") / F.col("n_times") * F.col("n_bins")).cast("bigint"), F.col("n_bins")))
    marked = spans.select("recording_id", F.explode(F.sequence(first, last - 1)).alias("bin")).distinct()
    grid = channels.join(sized.select("recording_id", "n_bins"), "recording_id").withColumn(
        "bin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_bins") - 1)))
    return grid.join(marked.withColumn("_seg", F.lit(1)), ["recording_id", "bin"], "left").select(
        "recording_id", "ch_name", "bin", (F.coalesce("_seg", F.lit(0)) + F.when(F.col("is_bad"), 2).otherwise(0)).alias("code"))


def fixed_length_events(recordings: DataFrame, duration: float, overlap: float = 0.0, event_id: int = 1) -> DataFrame:
    """Tumbling or sliding windows that fit the recording, as events."""
    room = F.col("n_times") - half_even(F.lit(duration) * F.col("sfreq"))
    step = F.lit(duration - overlap) * F.col("sfreq")
    turns = F.sequence(F.lit(0).cast("bigint"), F.floor(room / step))
    return recordings.where(room >= 0).select("recording_id", "sfreq", F.explode(turns).alias("i")).select(
        "recording_id", (F.col("i") * step).cast("bigint").alias("sample"), F.lit(event_id).alias("event_id"))


def _starts(total: Column, length: int, overlap: int) -> Column:
    """Sliding starts plus the final full window."""
    last = total - F.lit(length)
    sliding = F.sequence(F.lit(0).cast("bigint"), last, F.lit(length - overlap).cast("bigint"))
    return F.when(total >= length, F.array_distinct(F.concat(sliding, F.array(last)))).otherwise(
        F.array().cast("array<bigint>"))


def window_plan(recordings: DataFrame, length: int, overlap: int, max_windows: int | None = None) -> DataFrame:
    """Window starts per recording: all of them, or evenly spaced ones where a model takes at most `max_windows`."""
    s = recordings.withColumn("_s", _starts(F.col("n_times"), length, overlap))
    if max_windows is None:
        return s.select("recording_id", "n_times", F.explode("_s").alias("start"))
    n = F.size("_s")
    thin = F.transform(F.sequence(F.lit(0), F.lit(max_windows - 1)), lambda i: F.get(
        F.col("_s"), F.bround(i * ((n - 1) / F.lit(max_windows - 1)), 0).cast("int")))
    return s.select("recording_id", "n_times", F.explode(F.when(n > max_windows, F.array_distinct(thin)).otherwise(F.col("_s"))).alias("start"))


def window_vote_weights(plan: DataFrame, length: int) -> DataFrame:
    """Share of the timeline each window speaks for: covered time split equally among covering windows.

    A sweep over window edges accumulates time / coverage; a window's weight is the
    difference of that running total between its two edges, so windows are never paired.
    """
    edges = plan.select("recording_id", F.col("start").alias("at"), F.lit(1).alias("d")).unionByName(
        plan.select("recording_id", (F.col("start") + length).alias("at"), F.lit(-1).alias("d")))
    edges = edges.groupBy("recording_id", "at").agg(F.sum("d").alias("d"))
    w = Window.partitionBy("recording_id").orderBy("at")  # at most two edges per planned window
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    swept = edges.withColumn("cover", F.sum("d").over(upto)).withColumn("gap", F.lead("at").over(w) - F.col("at"))
    swept = swept.withColumn("share", F.when(F.col("cover") > 0, F.col("gap") / F.col("cover")).otherwise(0e0))
    total = swept.select("recording_id", "at", F.coalesce(
        F.sum("share").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0e0)).alias("cum"))
    opened = total.withColumnsRenamed({"at": "start", "cum": "_before"})
    closed = total.select("recording_id", (F.col("at") - length).alias("start"), F.col("cum").alias("_after"))
    return plan.select("recording_id", "start").join(opened, ["recording_id", "start"]).join(
        closed, ["recording_id", "start"]).select("recording_id", "start", (F.col("_after") - F.col("_before")).alias("weight"))


def chunk_spans(items: DataFrame, keys: list[str], chunk: int, stride: int, min_chunk: int, total: str = "n") -> DataFrame:
    """Chunks of at least `min_chunk` windows, a final full chunk, no duplicates."""
    n = F.col(total)
    big = F.lit(0).cast("bigint")
    # strides stop at the first chunk that reaches the end
    last = F.greatest(F.ceil((n - chunk) / F.lit(stride)), big) * stride
    strided = F.transform(F.sequence(big, last.cast("bigint"), F.lit(stride).cast("bigint")), lambda s: F.struct(
        s.alias("start"), F.least(s + chunk, n).alias("stop")))
    strided = F.filter(strided, lambda s: (s["stop"] - s["start"] >= min_chunk) & (s["start"] < n))
    final = F.struct(F.greatest(n - chunk, big).alias("start"), n.alias("stop"))
    whole = F.array(F.struct(big.alias("start"), n.alias("stop")))
    many = F.when(F.size(strided) == 0, whole).when(F.lit(chunk >= min_chunk), F.array_distinct(F.concat(strided, F.array(final)))) \
        .otherwise(strided)
    spans = F.when(n <= chunk, whole).otherwise(many)
    return items.where(n > 0).select(*keys, F.inline(spans))


def reject_by_annotation(epochs: DataFrame, bad_spans: DataFrame, bin_width: float) -> DataFrame:
    """Drop epochs [start, stop] that overlap a BAD span of their recording."""
    return overlap_filter(
        epochs, bad_spans, ["recording_id"], ["recording_id", "epoch"], (F.col("start"), F.col("stop")),
        (F.col("onset"), F.col("onset") + F.col("duration")), bin_width, "left_anti")


def ica_input_checks(recordings: DataFrame, channels: DataFrame, bad_spans: DataFrame, bucket_width: float) -> DataFrame:
    """Error code per recording, first failing rule wins: channels, samples, request, size.

    `recordings` carries `component_request` as text: NULL, an integer, or a variance share.
    """
    eligible = channels.where(~F.col("is_bad")).groupBy("recording_id").agg(F.count("*").alias("n_eligible"))
    cover = bad_coverage(bad_spans, recordings.select("recording_id", "n_times"), bucket_width)
    full = recordings.join(eligible, "recording_id", "left").join(
        cover.select("recording_id", "usable_samples"), "recording_id", "left").withColumn(
        "n_eligible", F.coalesce("n_eligible", F.lit(0)))
    ask = F.col("component_request")
    whole = ask.rlike(r"^-?\d+$")
    count, share = F.expr("try_cast(component_request AS bigint)"), F.expr("try_cast(component_request AS double)")
    valid = ask.isNull() | (whole & (count >= 2)) | (~whole & (share > 0) & (share < 1))
    too_many = F.when(whole, count > F.least("n_eligible", "usable_samples")).otherwise(F.col("usable_samples") < 2)
    code = (F.when(F.col("n_eligible") == 0, "NO_ELIGIBLE_ICA_CHANNELS").when(F.col("usable_samples") == 0, "ICA_INPUT_ALL_BAD")
            .when(~F.coalesce(valid, F.lit(False)), "INVALID_COMPONENT_REQUEST")
            .when(too_many, "REQUESTED_COMPONENTS_EXCEED_AVAILABLE_INPUT").otherwise("passed"))
    return full.select("recording_id", "n_eligible", "usable_samples", code.alias("code"))

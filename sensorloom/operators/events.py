"""Events and epochs: row rules, event construction, epoch cutting and rejection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import half_even, to_int
from ..plans.blocks import BLOCK, with_blocks
from ..plans.intervals import range_join

# Shift keys by precedence, seconds before milliseconds.
SHIFT_SECOND_KEYS = [
    "event_time_shift_sec", "event_time_shift", "stimulus_delay_sec",
    "event_timing.event_time_shift_sec", "event_timing.shift_sec", "event_timing.stimulus_delay_sec",
]
SHIFT_MILLISECOND_KEYS = [
    "event_time_shift_ms", "stimulus_delay_ms",
    "event_timing.event_time_shift_ms", "event_timing.shift_ms", "event_timing.stimulus_delay_ms",
]
# Segment-model threshold presets.
THRESHOLD_PRESETS = {
    "default": {"high": None, "low": None, "merge_gap": None, "min_duration": None, "short_keep": None},
    "strict": {"high": 0.85, "low": 0.15, "merge_gap": 10.0, "min_duration": 0.0, "short_keep": 0.95},
    "lenient": {"high": 0.99, "low": 0.95, "merge_gap": 0.0, "min_duration": 0.0, "short_keep": 1.0},
}


# ------------------------------------------------------------------- scalar rules

def infer_category(name: Column, requested: Column) -> Column:
    """An explicit category wins; resting or empty-room file names are `rest`, others `task`."""
    asked = F.lower(F.trim(requested))
    given = F.when((asked != "") & (asked != "auto"), asked)
    return F.coalesce(given, F.when(F.lower(name).rlike("rest|resting|emptyroom|empty-room"), "rest").otherwise("task"))


def channel_type_from_name(name: Column) -> Column:
    s = F.regexp_replace(name, " ", "")
    last = F.substring(s, -1, 1)
    return F.when(s.startswith("MEG") & (F.length(s) >= 4) & last.isin("1", "2", "3"),
                  F.when(last == "1", "mag").otherwise("grad")).otherwise("x")


def filter_events_text(column: Column, contains: list[str] | None = None, regexes: list[str] | None = None) -> Column:
    """Any of the fragments and any of the patterns; an empty list does not restrict."""
    keep = F.lit(True)
    if contains:
        keep = keep & F.exists(F.array(*[F.lit(c) for c in contains]), lambda c: F.contains(column, c))
    if regexes:
        any_match = F.lit(False)
        for pattern in regexes:
            any_match = any_match | column.rlike(pattern)
        keep = keep & any_match
    return keep


def filter_events_fields(column: Column, expected: dict[str, list[str]]) -> Column:
    """A mapping-valued cell must hold one of the expected values for every field."""
    cell = F.from_json(column, "map<string,string>")
    keep = cell.isNotNull()
    for field, values in expected.items():
        keep = keep & F.coalesce(cell[field].isin([str(v) for v in values]), F.lit("None" in values))
    return F.coalesce(keep, F.lit(False))


def map_event_value(kind: Column, mapping: dict[str, int] | None = None, fixed: int | None = None,
                    value: Column | None = None) -> Column:
    """Exact mapping, else fixed id, else the value column, else 1; NULL where unusable (0 and -1 too)."""
    if mapping:
        pairs = [x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))]
        out = F.try_element_at(F.create_map(*pairs), kind)
    elif fixed is not None:
        out = F.lit(fixed)
    else:
        out = F.lit(1) if value is None else value.try_cast("int")
    return F.when(~out.isin(0, -1), out)


def exclude_event_ids(events: DataFrame, ids: list[int]) -> DataFrame:
    """Drop the listed ids; a recording left without events is an error."""
    kept = F.count_if(~F.col("event_id").isin(ids))
    audit = events.groupBy("recording_id").agg(kept.alias("_kept"))
    checked = audit.where(F.assert_true(
        F.col("_kept") > 0, F.concat(F.lit("no events left for recording "), F.col("recording_id"))).isNull())
    return events.where(~F.col("event_id").isin(ids)).join(checked, "recording_id").drop("_kept")


def onset_to_sample(onset: Column, sfreq: float, first_samp: int = 0) -> Column:
    return to_int(onset * F.lit(float(sfreq))) + F.lit(first_samp)


def shift_events(events: DataFrame, settings: Column, sfreq: float) -> DataFrame:
    """Shift samples by the configured delay; `settings` is a map of text values per row."""
    seconds = F.coalesce(*[F.try_element_at(settings, F.lit(k)).try_cast("double") for k in SHIFT_SECOND_KEYS])
    millis = F.coalesce(*[F.try_element_at(settings, F.lit(k)).try_cast("double") for k in SHIFT_MILLISECOND_KEYS])
    shift = half_even(F.coalesce(seconds, millis / 1000, F.lit(0e0)) * F.lit(float(sfreq)))
    return events.withColumn("sample", F.col("sample") + shift)


def remap_events_on_resample(sample: Column, old: float, new: float) -> Column:
    return half_even(sample * F.lit(new / old))


def annotation_to_samples(annotations: DataFrame, recordings: DataFrame) -> DataFrame:
    """[start, stop) samples: absolute onsets made relative, rounded, clamped, one sample at least."""
    j = annotations.join(recordings.select("recording_id", "n_times", "sfreq", *[
        c for c in ("first_time",) if c in recordings.columns]), "recording_id")
    first = F.col("first_time") if "first_time" in recordings.columns else F.lit(0e0)
    moved = F.col("onset") - first
    inside = (first != 0) & (F.col("onset") >= first) & moved.between(-1e-6, F.col("n_times") / F.col("sfreq") + 1e-6)
    onset = F.when(inside, moved).otherwise(F.col("onset"))

    def clamp(c: Column) -> Column:
        return F.greatest(F.lit(0), F.least(half_even(c * F.col("sfreq")), F.col("n_times")))

    start, stop = clamp(onset), clamp(onset + F.col("duration"))
    widened = F.when((stop <= start) & (F.col("duration") > 0), F.least(F.col("n_times"), start + 1)).otherwise(stop)
    return j.withColumn("start", start.cast("bigint")).withColumn("stop", widened.cast("bigint")).drop("first_time", "sfreq")


def is_bad_annotation(description: Column, variant: str = "contains") -> Column:
    """`contains`: mentions bad anywhere; `prefix`: starts with BAD after upper-casing."""
    if variant == "contains":
        return F.contains(F.lower(description), F.lit("bad"))
    return F.startswith(F.upper(description), F.lit("BAD"))


def threshold_preset(settings: DataFrame) -> DataFrame:
    """Resolve `mode` to its preset and let user values override; unknown modes are errors."""
    mode = F.lower(F.trim(F.coalesce("mode", F.lit("default"))))
    mode = F.when(mode.isin("", "none", "null"), "default").otherwise(mode)
    out = settings.withColumn("mode", mode).where(
        F.assert_true(F.col("mode").isin(list(THRESHOLD_PRESETS)), F.concat(F.lit("unknown mode "), F.col("mode"))).isNull())
    for name in next(iter(THRESHOLD_PRESETS.values())):
        preset = F.lit(None).cast("double")
        for label, values in THRESHOLD_PRESETS.items():
            preset = F.when(F.col("mode") == label, F.lit(values[name])).otherwise(preset)
        out = out.withColumn(name, F.coalesce(F.col(name), preset) if name in settings.columns else preset)
    return out


def scale_by_type(samples: DataFrame, factors: dict[str, float]) -> DataFrame:
    """Multiply by the factor of the channel type, non-finite values to 0; adds the sensor code."""
    factor = F.lit(1e0)
    for ty, f in factors.items():
        factor = F.when(F.col("ch_type") == ty, F.lit(float(f))).otherwise(factor)
    v = F.col("value") * factor
    ok = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    return samples.withColumn("value", F.when(ok, v).otherwise(0e0)).withColumn(
        "sensor_code", F.when(F.col("ch_type") == "mag", 1).when(F.col("ch_type") == "grad", 2).otherwise(0))


# ------------------------------------------------------------- event construction

def events_from_rows(rows: DataFrame, sfreq: float, first_samp: int = 0, contains=None, regexes=None, fields=None,
                     mapping=None, fixed=None, value: Column | None = None, exclude: list[int] | None = None,
                     kind: str = "trial_type", field_column: str | None = None) -> DataFrame:
    """Event table from sidecar rows: text and field filters, value mapping, onset to sample."""
    keep = filter_events_text(F.col(kind), contains, regexes)
    if fields:
        keep = keep & filter_events_fields(F.col(field_column or kind), fields)
    if mapping:
        keep = keep & F.col(kind).isin(list(mapping))
    out = rows.where(keep).withColumn("event_value", map_event_value(F.col(kind), mapping, fixed, value))
    out = out.where("event_value is not null")
    if exclude:
        out = out.where(~F.col("event_value").isin(exclude))
    return out.withColumn("sample", onset_to_sample(F.col("onset"), sfreq, first_samp))


def events_from_annotations(annotations: DataFrame, sfreq: float, mapping: dict[str, int] | None = None,
                            fixed: int | None = None) -> DataFrame:
    """Fixed id, explicit map, or ids 1.. in description order within the recording."""
    if fixed is not None:
        coded = annotations.withColumn("event_id", F.lit(fixed))
    elif mapping:
        coded = annotations.withColumn("event_id", map_event_value(F.col("description"), mapping)).where("event_id is not null")
    else:
        names = annotations.select("recording_id", "description").distinct()
        w = Window.partitionBy("recording_id").orderBy("description")  # one row per distinct description
        coded = annotations.join(names.withColumn("event_id", F.row_number().over(w)), ["recording_id", "description"])
    return coded.withColumn("sample", onset_to_sample(F.col("onset"), sfreq))


def find_events(stim: DataFrame, min_samples: int = 1, size: int = BLOCK) -> DataFrame:
    """Rising steps of the trigger channel whose level holds for `min_samples`."""
    keep = max(min_samples, 1)
    blocked = with_blocks(stim.select("recording_id", "t", "value"), size=size, before=1, after=keep - 1)
    w = Window.partitionBy("recording_id", "_block").orderBy("t")
    held = w.rowsBetween(0, keep - 1)
    out = (blocked.withColumn("prev", F.lag("value").over(w)).withColumn("lo", F.min("value").over(held))
           .withColumn("hi", F.max("value").over(held)).withColumn("len", F.count("value").over(held)))
    return out.where("_core and value > prev and lo = hi and len = " + str(keep)).select(
        "recording_id", F.col("t").alias("sample"), F.col("value").alias("event_id"))


def resolve_events(routes: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """Events of each recording from the source its route names; unknown names are errors."""
    known = routes.where(F.assert_true(F.col("source").isin(list(sources)),
                                       F.concat(F.lit("unknown event source "), F.col("source"))).isNull())
    out = None
    for name, events in sources.items():
        part = events.join(known.where(F.col("source") == name).select("recording_id"), "recording_id", "left_semi").select(
            "recording_id", F.col("sample").cast("bigint"), F.col("event_id").cast("int"), F.lit(name).alias("source"))
        out = part if out is None else out.unionByName(part)
    return out


# -------------------------------------------------------------------------- epochs

EPOCH = ["recording_id", "epoch", "event_id"]


def cut_epochs(events: DataFrame, samples: DataFrame, before: int, after: int) -> DataFrame:
    """Samples k in [-before, after] around each event; binned range join, no per-event loop."""
    spans = events.select("recording_id", "epoch", "event_id", "sample")
    joined = range_join(samples, spans, ["recording_id"], F.col("t"), F.col("sample") - before, F.col("sample") + after,
                        float(before + after + 1), closed=True)
    return joined.select("recording_id", "epoch", "event_id", "ch_type", "ch_name", (F.col("t") - F.col("sample")).alias("k"), "value")


def baseline_correct(epochs: DataFrame, a: int | None, b: int | None) -> DataFrame:
    """Subtract the mean over k in [a, b] per epoch and channel; an open end means the epoch edge."""
    inside = F.lit(True)
    if a is not None:
        inside = inside & (F.col("k") >= a)
    if b is not None:
        inside = inside & (F.col("k") <= b)
    w = Window.partitionBy("recording_id", "epoch", "ch_name")  # one epoch long
    return epochs.withColumn("value", F.col("value") - F.avg(F.when(inside, F.col("value"))).over(w))


def reject_ptp(epochs: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Epoch log: rejected when any channel of a type exceeds its peak-to-peak limit, with the channels."""
    ptp = epochs.groupBy(*EPOCH, "ch_type", "ch_name").agg((F.max("value") - F.min("value")).alias("ptp"))
    over = F.lit(False)
    for ty, limit in limits.items():
        over = over | ((F.col("ch_type") == ty) & (F.col("ptp") > limit))
    return ptp.groupBy(*EPOCH).agg(F.array_sort(F.collect_set(F.when(over, F.col("ch_name")))).alias("reason")).withColumn(
        "rejected", F.size("reason") > 0)


def drop_bad_channels(epochs: DataFrame, bads: DataFrame) -> DataFrame:
    return epochs.join(bads.select("recording_id", "ch_name"), ["recording_id", "ch_name"], "left_anti")


def evoked(epochs: DataFrame, log: DataFrame) -> DataFrame:
    """Mean over the kept epochs per event id, channel and k."""
    kept = epochs.join(log.where("not rejected").select(*EPOCH), EPOCH, "left_semi")
    return kept.groupBy("recording_id", "event_id", "ch_name", "k").agg(
        F.avg("value").alias("value"), F.count("*").alias("n_epochs"))


def epoch_reject_histogram(counts: DataFrame, column: str = "n_rejected") -> DataFrame:
    """How many recordings rejected 0, 1, .. epochs; empty counts filled with 0."""
    seen = counts.groupBy(F.col(column).alias("n_rejected")).agg(F.count("*").alias("n_recordings"))
    axis = seen.agg(F.max("n_rejected").alias("m")).select(F.explode(F.sequence(F.lit(0).cast("bigint"), "m")).alias("n_rejected"))
    return axis.join(seen, "n_rejected", "left").select("n_rejected", F.coalesce("n_recordings", F.lit(0)).alias("n_recordings"))

"""Component labelling: similarity to templates, votes, spectral and regional rules, final labels.

A topography is a short vector over the channels of one device (`topo ARRAY<DOUBLE>`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.expr import mean_above
from ..plans.quantiles import exact_quantiles
from ..plans.scans import prefix_scan

METHODS = ["pearson", "spearman", "cosine", "mean"]
# Category switches.
CATEGORY_DEFAULTS = {"ecg": True, "eog": True, "outlier": False}


# -------------------------------------------------------------------- templates

def align_channels(weights: DataFrame, template_channels: DataFrame) -> DataFrame:
    """Keep the channels known to the template, in template order; a recording without any is an error.

    `weights(recording_id, component, ch_name, weight)`, `template_channels(ch_name, position)`.
    """
    common = weights.join(template_channels.select("ch_name", "position"), "ch_name")
    audit = weights.select("recording_id").distinct().join(
        common.groupBy("recording_id").agg(F.count("*").alias("_n")), "recording_id", "left").where(
        F.assert_true(F.col("_n").isNotNull(), F.concat(F.lit("no common channels in "), F.col("recording_id"))).isNull())
    return common.join(audit.select("recording_id"), "recording_id", "left_semi")


def dense_topographies(aligned: DataFrame, keys: list[str]) -> DataFrame:
    """One array per component over its channels (bounded by the device), in template order."""
    pairs = F.array_sort(F.collect_list(F.struct("position", F.col("weight").cast("double").alias("w"))))
    return aligned.groupBy(*keys).agg(F.transform(pairs, lambda p: p["w"]).alias("topo"))


def build_template_library(labelled: DataFrame, keys: list[str]) -> DataFrame:
    """Mean topography per device, kind and template name, from labelled components (long rows)."""
    cells = labelled.groupBy(*keys, "position").agg(F.avg("weight").alias("weight"))
    return dense_topographies(cells, keys)


def write_template_library(templates: DataFrame, path: str, mode: str) -> None:
    """`new` fails on an existing library, `append` adds to it, `overwrite` replaces it."""
    how = {"new": "errorifexists", "append": "append", "overwrite": "overwrite"}[mode]
    templates.write.mode(how).partitionBy("device_type").parquet(path)


def template_inventory(labelled: DataFrame) -> DataFrame:
    """Per device: templates by kind and the datasets they came from."""
    return labelled.groupBy("device_type").agg(
        F.count_if(F.col("kind") == "ECG").alias("n_ecg"), F.count_if(F.col("kind") == "EOG").alias("n_eog"),
        F.array_sort(F.collect_set("dataset")).alias("datasets"))


# ------------------------------------------------------------------- similarity

def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0e0), lambda s, v: s + v)


FORMS = "unit array<double>, centred array<double>, ranked array<double>, scaled array<double>"


def prepare(df: DataFrame, topo: str = "topo", prefix: str = "") -> DataFrame:
    """Normalised forms, computed once per vector (Arrow batches), so that a pair costs four dot products."""
    forms = F.pandas_udf(kernels.topography_forms, FORMS)
    out = df.withColumn("_f", forms(F.col(topo)))
    return out.select(*df.columns, *[F.col("_f." + c).alias(prefix + c) for c in ("unit", "centred", "ranked", "scaled")])


def topo_similarity(components: DataFrame, templates: DataFrame, device: str = "device_type") -> DataFrame:
    """Five similarities of each component to each template of its device (short library per device)."""
    c = prepare(components)
    t = prepare(templates.select(device, "kind", "template", F.col("topo").alias("t_topo")), "t_topo", "t_")
    gap = F.zip_with("scaled", "t_scaled", lambda x, y: (x - y) * (x - y))
    dist = F.sqrt(F.aggregate(gap, F.lit(0e0), lambda s, v: s + v))
    j = c.join(t, device).select(
        *components.columns, "kind", "template", F.abs(_dot(F.col("centred"), F.col("t_centred"))).alias("pearson"),
        F.abs(_dot(F.col("ranked"), F.col("t_ranked"))).alias("spearman"), _dot(F.col("unit"), F.col("t_unit")).alias("cosine"),
        (1 - dist / F.sqrt(F.size("topo"))).alias("euclidean"))
    return j.withColumn("mean", (F.col("pearson") + F.col("spearman") + F.col("cosine") + F.col("euclidean")) / 4).drop("topo")


def classify_by_template(similarity: DataFrame, keys: list[str], method: str = "pearson", threshold: float = 0.7) -> DataFrame:
    """ECG if its best similarity passes and beats EOG, else EOG if it passes, else Brain."""
    best = similarity.groupBy(*keys).agg(*[
        F.greatest(F.coalesce(F.max(F.when(F.col("kind") == k, F.col(method))), F.lit(0e0)), F.lit(0e0)).alias(k.lower() + "_max")
        for k in ("ECG", "EOG")])
    ecg, eog = F.col("ecg_max"), F.col("eog_max")
    label = F.when(mean_above(ecg, threshold) & mean_above(ecg - eog, 0), "ECG").when(mean_above(eog, threshold), "EOG").otherwise("Brain")
    return best.select("*", label.alias("label"), F.when(label == "ECG", ecg).when(label == "EOG", eog)
                       .otherwise(F.greatest(ecg, eog)).alias("similarity"))


def vote(similarity: DataFrame, keys: list[str], threshold: float = 0.6, min_votes: int = 2) -> DataFrame:
    """Components called an artifact by enough methods; ECG wins over EOG. One pass over the similarities."""
    aggs = [F.max(F.when(F.col("kind") == k, F.col(m))).alias(f"{k}_{m}") for k in ("ECG", "EOG") for m in METHODS]
    best = similarity.groupBy(*keys).agg(*aggs)

    def top(kind: str, m: str) -> Column:
        return F.greatest(F.coalesce(f"{kind}_{m}", F.lit(0e0)), F.lit(0e0))

    # correlations of ranks are often equal to the threshold or to each other but for their last bits
    ecg = {m: mean_above(top("ECG", m), threshold) & mean_above(top("ECG", m) - top("EOG", m), 0) for m in METHODS}
    eog = {m: ~ecg[m] & mean_above(top("EOG", m), threshold) for m in METHODS}
    n_ecg = sum([ecg[m].cast("int") for m in METHODS[1:]], ecg[METHODS[0]].cast("int"))
    n_eog = sum([eog[m].cast("int") for m in METHODS[1:]], eog[METHODS[0]].cast("int"))
    return best.select(*keys, (n_ecg + n_eog).alias("votes"), F.when(n_ecg > 0, "ecg").otherwise("eog").alias("kind")).where(
        F.col("votes") >= min_votes)


# -------------------------------------------------------------- scores and labels

def merge_scores_max(scores: DataFrame, n_components: DataFrame | None = None) -> DataFrame:
    """Largest score per (recording, kind, component); missing scores are 0.5; out-of-range indices dropped."""
    s = scores.where(F.col("component") >= 0)
    if n_components is not None:
        s = s.join(n_components.select("recording_id", "n_components"), "recording_id").where("component < n_components")
    return s.groupBy("recording_id", "kind", "component").agg(F.max(F.coalesce("score", F.lit(0.5))).alias("score"))


def category_gate(labels: DataFrame, switches: dict[str, bool] | None = None) -> DataFrame:
    """Keep the categories that are switched on."""
    on = [k for k, v in {**CATEGORY_DEFAULTS, **(switches or {})}.items() if v]
    return labels.where(F.col("kind").isin(on))


def finalize_labels(labels: DataFrame, written: DataFrame, scores: DataFrame, mode: str = "auto") -> DataFrame:
    """Nested payload per recording: indices and scores by category, automatic and written components."""
    scored = labels.join(merge_scores_max(scores), ["recording_id", "kind", "component"], "left").select(
        "recording_id", "kind", "component", F.coalesce("score", F.lit(0.5)).alias("score")).distinct()

    def listed(kind: str) -> Column:  # components of one recording: bounded by its channels
        return F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.struct("component", "score"))))

    auto = scored.groupBy("recording_id").agg(
        listed("ecg").alias("ecg"), listed("eog").alias("eog"), listed("outlier").alias("outlier"),
        F.array_sort(F.collect_set("component")).alias("auto_indices"))
    hand = written.groupBy("recording_id").agg(F.array_sort(F.collect_set("component")).alias("written_indices"))
    return auto.join(hand, "recording_id", "full_outer").select(
        "recording_id", "ecg", "eog", "outlier", F.struct(
            F.lit(mode).alias("mode"), F.coalesce("auto_indices", F.array().cast("array<bigint>")).alias("auto_indices"),
            F.coalesce("written_indices", F.array().cast("array<bigint>")).alias("written_indices")).alias("marked_components"))


def explained_variance_outliers(components: DataFrame, threshold: float = 0.1) -> DataFrame:
    return components.where(F.col("explained_var") > threshold)


# ---------------------------------------------------------------- spectral rules

def low_high_band_ratio(psd: DataFrame, keys: list[str], low: float, high: float, threshold: float = 0.5) -> DataFrame:
    """Share of power below `low` and above `high`; flagged when the low share is large."""
    total = F.sum("power")
    low_r = F.try_divide(F.sum(F.when(F.col("freq") < low, F.col("power"))), total)
    high_r = F.try_divide(F.sum(F.when(F.col("freq") > high, F.col("power"))), total)
    return psd.groupBy(*keys).agg(F.coalesce(low_r, F.lit(0e0)).alias("low_ratio"), F.coalesce(high_r, F.lit(0e0)).alias("high_ratio")
                                  ).withColumn("is_low_freq", F.col("low_ratio") >= threshold)


def psd_shape_flags(psd: DataFrame, keys: list[str], attention: tuple[float, float] = (0.0, 5.0), overall: bool = False) -> DataFrame:
    """Slopes of the spectrum and its thirds, and frequencies above the attention band's maximum.

    The overall slope counts towards `is_abnormal` only with `overall`. The bins of one
    component's spectrum are a short list.
    """
    w = Window.partitionBy(*keys)
    idx = psd.withColumn("_i", F.row_number().over(w.orderBy("freq")) - 1).withColumn("_n", F.count("*").over(w))
    size = F.greatest(F.lit(2), F.floor(F.col("_n") / 3)).cast("int")
    seg = F.floor(F.col("_i") / size).cast("int")
    inside = F.col("freq").between(*attention)
    idx = idx.withColumn("_seg", F.when(seg * size < F.col("_n") - size, seg)).withColumn(
        "_top", F.coalesce(F.max(F.when(inside, F.col("power"))).over(w), F.lit(0e0)))
    slopes = idx.where("_seg is not null").groupBy(*keys, "_seg").agg(F.regr_slope("power", "freq").alias("s"))
    rising = slopes.groupBy(*keys).agg(F.count_if(F.col("s") > 0).alias("n_rising_segments"))
    whole = idx.groupBy(*keys).agg(F.regr_slope("power", "freq").alias("slope"),
                                   F.count_if(F.col("power") > F.col("_top")).alias("n_exceeding"))
    flag = (F.col("n_rising_segments") > 0) | (F.col("n_exceeding") > 0)
    if overall:
        flag = flag | (F.col("slope") >= 0)
    return whole.join(rising, keys, "left").withColumn("n_rising_segments", F.coalesce("n_rising_segments", F.lit(0))).withColumn(
        "is_abnormal", flag)


# ---------------------------------------------------------------- regional rules

def region_energy(weights: DataFrame, regions: DataFrame, keys: list[str]) -> DataFrame:
    """Energy per region and in `Remaining` (channels of no region). `regions(ch, region)`, energy in `energy`."""
    j = weights.join(regions, "ch", "left").withColumn("region", F.coalesce("region", F.lit("Remaining")))
    return j.groupBy(*keys, "region").agg(F.sum("energy").alias("energy"))


def _regions(*names: str) -> Column:
    hit = F.lit(False)
    for n in names:
        hit = hit | F.lower(F.col("region")).endswith(n)
    return F.sum(F.when(hit, F.col("energy")).otherwise(0e0))


def ecg_region_rule(energies: DataFrame, keys: list[str]) -> DataFrame:
    """Temporal + occipital, or occipital + frontal, above the remaining energy."""
    return energies.groupBy(*keys).agg(
        _regions("temporal", "occipital").alias("to"), _regions("occipital", "frontal").alias("of"),
        _regions("remaining").alias("rest")).where("to > rest or of > rest").select(*keys)


def eog_region_rule(energies: DataFrame, low_freq: DataFrame, keys: list[str]) -> DataFrame:
    """Frontal + temporal above everything else, for low-frequency components."""
    won = energies.groupBy(*keys).agg(_regions("frontal", "temporal").alias("front"),
                                      _regions("occipital", "parietal", "remaining").alias("rest")).where("front > rest")
    return won.join(low_freq, keys, "left_semi").select(*keys)


# -------------------------------------------------------------- peaks and outliers

def heart_rate(peaks: DataFrame, keys: list[str], sfreq: float, decimals: int = 2) -> DataFrame:
    """Beats per minute from the mean peak distance (which telescopes); 0 with fewer than two peaks."""
    span = F.try_divide((F.max("sample") - F.min("sample")) / F.lit(float(sfreq)), F.count("*") - 1)
    return peaks.groupBy(*keys).agg(
        F.count("*").alias("n_peaks"), F.round(F.coalesce(F.try_divide(F.lit(60e0), span), F.lit(0e0)), decimals).alias("bpm"))


def outlier_removal(values: DataFrame, keys: list[str], value: str, method: str = "iqr", z: float = 1.0) -> DataFrame:
    """Keep values inside the 1.5 IQR fence, or closer than `z` deviations to the mean."""
    if method == "iqr":
        q = exact_quantiles(values, keys, value, {"_q1": 0.25, "_q3": 0.75})
        fence = 1.5 * (F.col("_q3") - F.col("_q1"))
        keep = F.col(value).between(F.col("_q1") - fence, F.col("_q3") + fence)
        return values.join(q, keys).where(keep).drop("_q1", "_q3")
    stats = values.groupBy(*keys).agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    return values.join(stats, keys).where(F.abs(F.col(value) - F.col("_m")) < z * F.col("_s")).drop("_m", "_s")


def replace_outliers(values: DataFrame, keys: list[str], value: str, order: str, bucket: Column, z: float = 1.0,
                     fill: str = "zero") -> DataFrame:
    """Outliers become 0, or the mean of the averages of all good values before and after them."""
    stats = values.groupBy(*keys).agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    v = values.join(stats, keys).withColumn("_bad", F.abs(F.col(value) - F.col("_m")) >= z * F.col("_s"))
    if fill == "zero":
        return v.withColumn(value, F.when(F.col("_bad"), 0e0).otherwise(F.col(value))).drop("_m", "_s", "_bad")
    v = v.withColumn("_g", F.when(~F.col("_bad"), F.col(value)).otherwise(0e0)).withColumn("_k", (~F.col("_bad")).cast("bigint"))
    totals = v.groupBy(*keys).agg(F.sum("_g").alias("_tg"), F.sum("_k").alias("_tk"))
    run = prefix_scan(v, keys, bucket, [order], {"_cg": ("sum", "_g"), "_ck": ("sum", "_k")}).join(totals, keys)
    left = F.when(F.col("_ck") > 0, F.col("_cg") / F.col("_ck"))
    after = F.col("_tk") - F.col("_ck")
    right = F.when(after > 0, (F.col("_tg") - F.col("_cg")) / after)
    filled = F.coalesce((left + right) / 2, left, right)
    return run.withColumn(value, F.when(F.col("_bad"), filled).otherwise(F.col(value))).select(*values.columns)


def ecg_periodicity_rule(peaks: DataFrame, corr_peaks: DataFrame, keys: list[str], sfreq: float, seconds: float,
                         max_peaks: float, ratio: float = 0.9, gap_coef: float = 0.4, std_coef: float = 0.05) -> DataFrame:
    """Enough and not too many peaks, with long enough and regular intervals, in signal and correlation."""

    def intervals(df: DataFrame, p: str) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy("sample")  # peaks of one component
        gaps = df.withColumn("_d", (F.col("sample") - F.lag("sample").over(w)).cast("double"))
        kept = outlier_removal(gaps.where("_d is not null"), keys, "_d")
        return df.groupBy(*keys).agg(F.count("*").alias(p + "_n")).join(
            kept.groupBy(*keys).agg(F.avg("_d").alias(p + "_mean"), F.stddev_pop("_d").alias(p + "_std")), keys, "left")

    j = intervals(peaks, "sig").join(intervals(corr_peaks, "cor"), keys)
    single = (F.col("sig_n") == 1) | (F.col("cor_n") == 1)
    for c in ("sig_mean", "sig_std", "cor_mean", "cor_std"):
        j = j.withColumn(c, F.when(single, 0e0).otherwise(F.col(c)))
    enough = (F.col("sig_n") >= ratio * seconds) & (F.col("sig_n") <= max_peaks) & (F.col("cor_n") >= ratio * seconds)
    wide = (F.col("sig_mean") >= gap_coef * sfreq) & (F.col("cor_mean") >= gap_coef * sfreq)
    steady = (F.col("cor_std") <= std_coef * sfreq) | (F.col("sig_std") <= std_coef * sfreq)
    return j.withColumn("is_periodic", F.coalesce(enough & wide & steady, F.lit(False)))

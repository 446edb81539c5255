"""Normative scoring against hierarchical reference intervals, and the quality gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import clip01
from ..plans.quantiles import exact_quantiles

# Fixed values of the default scoring profile: rank, family, domain, metric stem, statistic.
# A component metric is "<stem>.<mag|grad>[.<statistic>]"; every mode is lower_is_better.
DEFAULT_FAMILIES = [
    (1, "max_abs_diff.abs_q95", "Temporal"),
    (2, "max_abs_diff.q75", "Temporal"),
    (3, "max_abs_diff.iqr", "Temporal"),
    (4, "max_abs_diff.mean", "Temporal"),
    (5, "freq_domain.skewness_amplitude", "Spectral"),
    (6, "freq_domain.kurtosis_amplitude", "Spectral"),
    (7, "ptp_amp.abs_q95", "Statistical"),
    (8, "fractal_domain.DFA", "Fractal"),
]
# The second profile adds this family.
EXTRA_FAMILIES = [(9, "max_abs_diff.median", "Temporal")]
DOMAINS = ["Temporal", "Statistical", "Spectral", "Fractal"]
SCOPES = ["device_category", "device", "category", "global"]


def family_rows(families=None, mode: str = "lower_is_better", types=("mag", "grad")) -> Column:
    """The profile as an array literal of (rank, family, domain, metric, mode); a fixed handful of entries."""
    rows = []
    for rank, family, domain in families or DEFAULT_FAMILIES:
        stem, _, stat = family.partition(".")
        for ty in types:
            metric = f"{stem}.{ty}.{stat}" if stem in ("max_abs_diff", "ptp_amp") else f"{family}.{ty}"
            named = {"rank": rank, "family": family, "domain": domain, "metric": metric, "mode": mode}
            rows.append(F.struct(*[F.lit(v).alias(k) for k, v in named.items()]))
    return F.array(*rows)


def build_reference_intervals(metrics: DataFrame) -> DataFrame:
    """n, q05, q50, q95 per metric at four scopes.

    Every value feeds all four scopes (like grouping sets); quantiles are selected in two
    passes because the global scope holds the whole population.
    """
    device, cat, every = F.col("device_type"), F.col("category"), F.lit("ALL")

    def scope(name: str, d: Column, c: Column) -> Column:
        return F.struct(F.lit(name).alias("scope"), d.alias("device_type"), c.alias("category"))

    expanded = metrics.where("value is not null and not isnan(value)").select(
        F.explode(F.array(scope("device_category", device, cat), scope("device", device, every),
                          scope("category", every, cat), scope("global", every, every))).alias("s"),
        "metric", "value").select("s.*", "metric", "value")
    keys = ["scope", "device_type", "category", "metric"]
    counts = expanded.groupBy(*keys).agg(F.count("value").alias("n"))
    return counts.join(exact_quantiles(expanded, keys, "value", {"q05": 0.05, "q50": 0.5, "q95": 0.95}), keys)


def lookup_reference(components: DataFrame, reference: DataFrame, scope: str = "device_category", min_n: int = 20) -> DataFrame:
    """Best reference row per component: first scope with enough rows, else the first present, else none.

    Candidates are matched by equality, so each component meets at most four rows.
    """
    device, cat, every = F.col("device_type"), F.col("category"), F.lit("ALL")
    all_candidates = {
        "device_category": (device, cat), "device": (device, every), "category": (every, cat), "global": (every, every)}
    order = {"device_category": SCOPES, "category": ["category", "global"]}.get(scope, ["global"])
    candidates = F.array(*[
        F.struct(F.lit(i).alias("priority"), F.lit(s).alias("scope"), all_candidates[s][0].alias("device_type"),
                 all_candidates[s][1].alias("category")) for i, s in enumerate(order)])
    # equal component rows are looked up once and given back as often as they came
    distinct = components.groupBy(*components.columns).agg(F.count("*").cast("int").alias("_times"))
    exploded = distinct.withColumn("_c", F.explode(candidates))
    ref = reference.select(F.col("scope").alias("reference_scope"), F.col("device_type").alias("reference_device"),
                           F.col("category").alias("reference_category"), F.col("metric").alias("_metric"),
                           F.col("n").alias("reference_n"), "q05", "q50", "q95")
    joined = exploded.join(
        ref, (F.col("_c.scope") == ref["reference_scope"]) & (F.col("_c.device_type") == ref["reference_device"])
        & (F.col("_c.category") == ref["reference_category"]) & (F.col("metric") == ref["_metric"]), "left")
    found = F.col("reference_n").isNotNull()
    best = F.when(found, F.struct(
        (F.col("reference_n") < min_n).cast("int").alias("thin"), F.col("_c.priority").alias("priority"),
        "reference_scope", "reference_device", "reference_category", "reference_n", "q05", "q50", "q95"))
    return joined.groupBy(*components.columns, "_times").agg(F.min(best).alias("_ref")).withColumn(
        "_copy", F.explode(F.array_repeat(F.lit(0), F.col("_times")))).select(
        *components.columns, *[F.col("_ref." + c).alias(c) for c in (
            "reference_scope", "reference_device", "reference_category", "reference_n", "q05", "q50", "q95")])


def component_score() -> Column:
    """0..1 score of `value` against q05/q50/q95 by `mode`; NULL without a usable interval."""
    x, q05, q50, q95, mode = (F.col(c) for c in ("value", "q05", "q50", "q95", "mode"))
    z = clip01(F.try_divide(x - q05, q95 - q05))
    low = F.when(q50 > q05, F.try_divide(q50 - x, q50 - q05))
    high = F.when(q95 > q50, F.try_divide(x - q50, q95 - q50))
    near = F.when(x <= q50, low).otherwise(high)
    score = F.when(mode == "lower_is_better", 1 - z).when(mode == "higher_is_better", z).otherwise(
        F.when(near.isNotNull(), 1 - clip01(near)))
    return F.when(x.isNotNull() & ~F.isnan(x) & (q95 > q05), score)


def reference_position() -> Column:
    return F.when(F.col("q95") > F.col("q05"), (F.col("value") - F.col("q05")) / (F.col("q95") - F.col("q05")))


def component_status() -> Column:
    x = F.col("value")
    return (F.when(F.col("q05").isNull(), "no_reference").when(x.isNull() | F.isnan(x), "missing")
            .when(x < F.col("q05"), "below_q05").when(x > F.col("q95"), "above_q95").otherwise("within_q05_q95"))


def direction_label(mode: Column) -> Column:
    return (F.when(mode == "lower_is_better", "lower is better").when(mode == "higher_is_better", "higher is better")
            .otherwise("near q50 is better"))


def component_type(metric: Column) -> Column:
    return (F.when(metric.contains(".mag.") | metric.endswith(".mag"), "MAG")
            .when(metric.contains(".grad.") | metric.endswith(".grad"), "GRAD").otherwise(""))


def component_scores(metrics: DataFrame, recordings: DataFrame, families: Column, reference: DataFrame,
                     scope: str = "device_category", min_n: int = 20) -> DataFrame:
    """One row per recording and profile metric, present or not, with its score and labels."""
    expected = recordings.select("recording_id", "device_type", "category", F.inline(families))
    present = expected.join(metrics.select("recording_id", "metric", "value"), ["recording_id", "metric"], "left")
    return lookup_reference(present, reference, scope, min_n).select(
        "*", component_score().alias("score"), reference_position().alias("position"),
        component_status().alias("status"), direction_label(F.col("mode")).alias("direction"),
        component_type(F.col("metric")).alias("component_type"))


def family_scores(components: DataFrame) -> DataFrame:
    """Mean of the available component scores, x100, with count and component types."""
    return components.groupBy("recording_id", "rank", "family", "domain").agg(
        (F.avg("score") * 100).alias("family_score"), F.count("score").alias("n_components"),
        F.array_sort(F.collect_set(F.when(F.col("score").isNotNull() & (F.col("component_type") != ""),
                                          F.col("component_type")))).alias("components"))


def recording_scores(families: DataFrame) -> DataFrame:
    return families.groupBy("recording_id").agg(
        F.avg("family_score").alias("score"), F.count("family_score").alias("n_available"),
        F.count("*").alias("n_expected"))


def quality_gate(scores: DataFrame, minimum: float, alarm: float) -> DataFrame:
    """passed: scored and at or above the minimum; alarm: not scored or below the alarm level."""
    s = F.col("score")
    return scores.withColumn("passed", s.isNotNull() & (s >= minimum)).withColumn(
        "alarm", s.isNull() | (s < alarm))


def route_by_gate(recordings: DataFrame, gated: DataFrame, keys: list[str]) -> DataFrame:
    """Recordings without quality control bypass the gate; the others need a pass."""
    bypass = recordings.where(~F.col("qc_enabled"))
    passed = recordings.where("qc_enabled").join(gated.where("passed").select(*keys), keys, "left_semi")
    return bypass.withColumn("route", F.lit("bypass")).unionByName(passed.withColumn("route", F.lit("passed")))


def families_in_domain_order(families: DataFrame) -> DataFrame:
    """Order of display within each recording: domain, rank, name."""
    place = F.coalesce(F.when(F.col("domain").isin(DOMAINS), F.array_position(
        F.array(*[F.lit(d) for d in DOMAINS]), F.col("domain"))), F.lit(len(DOMAINS) + 1))
    w = Window.partitionBy("recording_id").orderBy(place, "rank", "family")
    return families.withColumn("position", F.row_number().over(w))

"""Post-processing of model probabilities and comparison of labelings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import MAD_TO_SD

# Class order of the canonical outputs and of the other model's outputs.
CLASSES = ["brain_or_other", "heart_beat", "eye_blink", "eye_movement"]
NATIVE_CLASSES = ["brain_or_other", "eye_movement", "heart_beat", "eye_blink"]


def ensemble_mean(probs: DataFrame, keys: list[str], item: str, fold: str | None = None, across: str = "mean") -> DataFrame:
    """Mean over folds per item. With `fold`, the chunks of a fold are first reduced by mean or max."""
    if fold is not None:
        reduce_chunks = F.max if across == "max" else F.avg
        probs = probs.groupBy(*keys, fold, item).agg(reduce_chunks("prob").alias("prob"))
    return probs.groupBy(*keys, item).agg(F.avg("prob").alias("prob"), F.count("*").alias("n"))


def lcb_mad_bad_channels(probs: DataFrame, item: str = "ch_name", lam: float = 1.0, floor: float = 0.56, z: float = 3.0,
                         min_type_channels: int = 8) -> DataFrame:
    """Lower confidence bound per channel against a robust threshold of its type.

    Types with too few channels use the whole recording's threshold. Windows hold one row per
    channel of one recording.
    """
    score = probs.groupBy("recording_id", "ch_type", item).agg(
        F.avg("prob").alias("mean_prob"), F.stddev_pop("prob").alias("fold_std"))
    score = score.withColumn("lcb", F.col("mean_prob") - lam * F.col("fold_std"))

    def threshold(df: DataFrame, w, name: str) -> DataFrame:
        med = df.withColumn("_med", F.percentile("lcb", F.lit(0.5)).over(w))
        mad = med.withColumn("_mad", F.percentile(F.abs(F.col("lcb") - F.col("_med")), F.lit(0.5)).over(w))
        return mad.withColumn(name, F.greatest(F.lit(floor), F.col("_med") + z * MAD_TO_SD * F.col("_mad"))).drop("_med", "_mad")

    by_type = Window.partitionBy("recording_id", "ch_type")
    score = threshold(score, Window.partitionBy("recording_id"), "_all")
    score = threshold(score, by_type, "_type").withColumn("_n", F.count("*").over(by_type))
    limit = F.when(F.col("_n") >= min_type_channels, F.col("_type")).otherwise(F.col("_all"))
    return score.withColumn("threshold", limit).withColumn("is_bad", F.col("lcb") >= limit).drop("_all", "_type", "_n")


def mask_channels(channels: DataFrame, bads: DataFrame) -> DataFrame:
    """Bad channels of the first model become invalid for the second."""
    flagged = channels.join(bads.select("recording_id", "ch_name").distinct().withColumn("_bad", F.lit(1)),
                            ["recording_id", "ch_name"], "left")
    bad = F.coalesce("_bad", F.lit(0))
    return flagged.withColumn("node_valid", F.col("node_valid") * (1 - bad)).withColumn("is_masked", bad == 1).drop("_bad")


def argmax_label(probs: Column, classes: list[str] | None = None) -> Column:
    """First class with the largest probability; non-finite probabilities are an error."""
    names = F.array(*[F.lit(c) for c in classes or CLASSES])
    label = F.get(names, (F.array_position(probs, F.array_max(probs)) - 1).cast("int"))
    ok = F.forall(probs, lambda p: p.isNotNull() & ~F.isnan(p) & (F.abs(p) != float("inf")))
    return F.when(F.assert_true(ok, F.lit("non-finite class probabilities")).isNull(), label)


def label_group(label: Column) -> Column:
    return (F.when(label == "heart_beat", "ecg").when(label.isin("eye_blink", "eye_movement"), "eog").otherwise("brain"))


def reorder_classes(probs: Column, source: list[str] | None = None, target: list[str] | None = None) -> Column:
    source = source or NATIVE_CLASSES
    return F.array(*[F.get(probs, F.lit(source.index(c))) for c in target or CLASSES])


def compare_labelings(a: DataFrame, b: DataFrame, keys: list[str], item: str = "component", other: str = "brain_or_other") -> DataFrame:
    """Per-item rows of two labelings with agreement and artifact flags."""
    j = a.select(*keys, item, F.col("label").alias("a_label")).join(
        b.select(*keys, item, F.col("label").alias("b_label")), [*keys, item], "full_outer")
    return j.withColumn("agree", F.col("a_label").eqNullSafe(F.col("b_label"))).withColumn(
        "a_artifact", F.coalesce(F.col("a_label") != other, F.lit(False))).withColumn(
        "b_artifact", F.coalesce(F.col("b_label") != other, F.lit(False)))


def labeling_agreement(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Agreement and artifact Jaccard index per group; empty sets count as full agreement."""
    both, either = F.col("a_artifact") & F.col("b_artifact"), F.col("a_artifact") | F.col("b_artifact")
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n_items"), F.count_if("agree").alias("n_matching"), F.count_if(both).alias("n_intersection"),
        F.count_if(either).alias("n_union")).select(
        "*", F.when(F.col("n_items") > 0, F.col("n_matching") / F.col("n_items")).otherwise(1e0).alias("agreement"),
        F.when(F.col("n_union") > 0, F.col("n_intersection") / F.col("n_union")).otherwise(1e0).alias("artifact_jaccard"))


def labeling_sets(rows: DataFrame, item: str = "component") -> DataFrame:
    """Long (set_name, item): disagreements, intersection and union, as rows rather than driver-side lists."""
    both, either = F.col("a_artifact") & F.col("b_artifact"), F.col("a_artifact") | F.col("b_artifact")
    names = F.array_compact(F.array(F.when(~F.col("agree"), "disagreement"), F.when(both, "artifact_intersection"),
                                    F.when(either, "artifact_union")))
    return rows.select(F.explode(names).alias("set_name"), item)

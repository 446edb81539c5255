"""Joins between the outputs of different stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.catalogue import output_id


def pair_noise_recording(targets: DataFrame, noise: DataFrame, task: str) -> DataFrame:
    """Join each target to the recording of the same dataset whose task entity is `task`."""
    key = output_id(F.regexp_replace(F.col("path"), r"task-[^_/.]+", f"task-{task}"))
    n = noise.select("dataset", output_id(F.col("path")).alias("noise_id"), F.col("path").alias("noise_path"))
    return targets.withColumn("noise_id", key).join(n, ["dataset", "noise_id"])


def _unique(df: DataFrame, keys: list[str], side: str) -> DataFrame:
    n = F.count("*").over(Window.partitionBy(*keys))
    return df.withColumn("_n", n).where(F.assert_true(F.col("_n") == 1, F.lit(f"duplicate key on the {side}")).isNull()).drop("_n")


def strict_join(left: DataFrame, right: DataFrame, keys: list[str], mode: str = "strict") -> DataFrame:
    """Inner join on unique keys. `strict`: unmatched rows are errors; `lenient`: they are dropped."""
    a, b = _unique(left, keys, "left"), _unique(right, keys, "right")
    if mode == "lenient":
        return a.join(b, keys)
    j = a.withColumn("_l", F.lit(True)).join(b.withColumn("_r", F.lit(True)), keys, "full_outer")
    both = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    return j.where(F.assert_true(both, F.lit("unmatched key in a strict join")).isNull()).drop("_l", "_r")


def assert_lineage_equal(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Joined rows must agree on each pair of columns (paths, settings, input hash)."""
    for a, b in pairs:
        df = df.where(F.assert_true(F.col(a).eqNullSafe(F.col(b)), F.lit(f"{a} and {b} differ")).isNull())
    return df


def common_channels(target: DataFrame, noise: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(kept channels in target order, dropped channels with the side that lacks them); none in common is an error."""
    t, n = target.where("not is_bad"), noise.where("not is_bad")
    kept = t.join(n.select(*keys, "ch_name"), [*keys, "ch_name"], "left_semi")
    counts = t.select(*keys).distinct().join(kept.groupBy(*keys).agg(F.count("*").alias("_n")), keys, "left")
    ok = counts.where(F.assert_true(F.col("_n") > 0, F.lit("no common good channels")).isNull() & F.col("_n").isNotNull())
    only_t = t.join(n.select(*keys, "ch_name"), [*keys, "ch_name"], "left_anti").select(*keys, "ch_name", F.lit("noise").alias("missing_in"))
    only_n = n.join(t.select(*keys, "ch_name"), [*keys, "ch_name"], "left_anti").select(*keys, "ch_name", F.lit("target").alias("missing_in"))
    return kept.join(ok.select(*keys), keys, "left_semi"), only_t.unionByName(only_n)


def row_code(columns: list[str]) -> Column:
    """60 bits of an md5 over the columns as text, with marks between them and for NULL."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def hash_text(n: Column, xor: Column, total: Column) -> Column:
    return F.sha2(F.concat_ws(":", n.cast("string"), xor.cast("string"), total.cast("string")).cast("binary"), 256)


def content_hash(df: DataFrame, keys: list[str], columns: list[str], name: str = "content_hash") -> DataFrame:
    """Order-free hash of the rows of a key: row count, xor and sum of row codes, so no sort is needed and parts can be merged."""
    h = row_code(columns)
    parts = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.bit_xor(h).alias("_x"), F.sum(h.cast("decimal(38,0)")).alias("_y"))
    return parts.select(*keys, hash_text(F.col("_n"), F.col("_x"), F.col("_y")).alias(name))


def stale_recordings(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Recordings that are new, changed in input or settings, lack their output, or are gone.

    `old(keys, input_hash, config_hash, has_output)`, `new(keys, input_hash, config_hash)`.
    """
    o = old.select(*keys, F.col("input_hash").alias("_oi"), F.col("config_hash").alias("_oc"), "has_output", F.lit(1).alias("_o"))
    n = new.select(*keys, "input_hash", "config_hash", F.lit(1).alias("_n"))
    reason = (F.when(F.col("_n").isNull(), "removed").when(F.col("_o").isNull(), "new")
              .when(~F.col("input_hash").eqNullSafe(F.col("_oi")), "input changed")
              .when(~F.col("config_hash").eqNullSafe(F.col("_oc")), "settings changed")
              .when(~F.coalesce("has_output", F.lit(False)), "output missing"))
    return n.join(o, keys, "full_outer").withColumn("reason", reason).where("reason is not null").select(*keys, "reason")

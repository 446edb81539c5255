"""Blocked Gram sums: pairwise channel products without emitting pairs per sample.

One task sees one block of one recording (bounded: block length x channels), multiplies the
block matrix with its transpose and emits one row per channel pair. The pair sums are added
natively, so the size of a recording never reaches a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from .blocks import with_blocks

GRAM_BLOCK = 1 << 14


def pair_sums(df: DataFrame, key: str, channel: str = "ch_name", t: str = "t", value: str = "value",
              size: int = GRAM_BLOCK) -> DataFrame:
    """(key, ci, cj, n, sx, sy, sxx, syy, sxy) over the samples both channels have, ci <= cj."""
    types = dict(df.dtypes)
    blocked = with_blocks(df.select(F.col(key), F.col(channel).alias("c"), F.col(t).alias("t"),
                                    F.col(value).cast("double").alias("v")), "t", size)
    schema = (f"{key} {types[key]}, ci {types[channel]}, cj {types[channel]}, n double, sx double, sy double, "
              "sxx double, syy double, sxy double")
    partial = blocked.drop("_core").groupBy(key, "_block").applyInPandas(kernels.gram_block(key), schema)
    return partial.groupBy(key, "ci", "cj").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])


def covariance(sums: DataFrame, ddof: int = 1) -> DataFrame:
    return sums.withColumn("cov", F.try_divide(F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n"), F.col("n") - ddof))


def correlation(sums: DataFrame) -> DataFrame:
    num = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    den = F.sqrt(F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")) * F.sqrt(
        F.col("n") * F.col("syy") - F.col("sy") * F.col("sy"))
    return sums.withColumn("corr", F.when(den > 0, num / den))

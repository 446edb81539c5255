"""Exact quantiles of groups of any size.

`percentile` keeps every distinct value of a group in one task, which is fine for bounded
groups (channels of a recording, folds of a model) but not for the samples of a long
recording. Here values are selected by rank from the order-preserving bits of a double, a few bits at a time: a histogram
over the first bits (hash aggregation with map-side combine) locates the bucket that holds each wanted rank, the values of those buckets
are counted, a histogram over their next bits locates the part, and only the values of that part are ranked. Nothing is approximated, and no
window ever holds more rows than there are digits, wherever the values lie: an offset, a single low value or a wide spread change nothing.

Keys are compared as one struct, in which NULL equals NULL. Nothing runs before the result is asked for; the
wanted buckets are a few rows per group, and Spark decides from their size whether the values are shuffled again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Bits below the first digit (sign, exponent and 8 bits of the fraction), and below the second one.
FIRST, SECOND = 44, 22


def ordered_bits(v: Column) -> Column:
    """The 64 bits of a double as a long in the order of the doubles (both zeros are 0; NaN has none): exponent and fraction by exact scaling with powers of two."""
    a = F.abs(v)
    guess = F.floor(F.log2(a))
    two = lambda e: F.pow(F.lit(2e0), e.cast("double"))
    # log2 may be off by one beside a power of two
    exponent = guess + F.when(a < two(guess), -1).when(a / 2 >= two(guess), 1).otherwise(0)
    fraction = (a * two(-exponent) - 1) * F.lit(2.0**52)
    tiny = a * F.lit(2.0**537) * F.lit(2.0**537)
    bits = F.when(F.isnan(v), None).when(a == 0, F.lit(0).cast("bigint")).when(a == float("inf"), F.lit(2047 << 52)).when(a < F.lit(2.0**-1022), tiny.cast("bigint")).otherwise(
        (exponent + 1023).cast("bigint") * F.lit(1 << 52) + fraction.cast("bigint"))
    return F.when(v < 0, -bits).otherwise(bits)


def _position(p: float, n: Column, method: str) -> Column:
    if method == "matlab":
        adjusted = F.when(n > 1, (F.lit(p) - 0.5) * n / (n - 1) + 0.5).otherwise(F.lit(p))
        return (n - 1) * F.greatest(F.lit(0e0), F.least(F.lit(1e0), adjusted))
    return (n - 1) * F.lit(float(p))


def select_ranks(df: DataFrame, keys: list[str], value: str, ranks: Callable[[Column], list[Column]]) -> DataFrame:
    """(_key, _n, _at) per key, as one struct: number of values (NULL and NaN are skipped) and a map from each wanted rank (from 0, as `ranks` gives them for
    the number of values) to its value. Ranks outside are left out."""
    x = df.select(F.struct(*keys).alias("_key"), F.col(value).cast("double").alias("_v")).where("_v is not null and not isnan(_v)")
    x = x.withColumn("_b", F.shiftright(ordered_bits(F.col("_v")), FIRST))

    def located(hist: DataFrame, group: list[str], digit: str, before: Column) -> DataFrame:
        """Rows of `hist` that hold a rank, with the number of values before them."""
        so_far = F.sum("_c").over(Window.partitionBy(*group).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1))
        start = hist.withColumn("_start", before + F.coalesce(so_far, F.lit(0)))
        held = F.filter("_ranks", lambda r: (r >= F.col("_start")) & (r < F.col("_start") + F.col("_c")))
        return start.withColumn("_ranks", held).where(F.size("_ranks") > 0)

    hist = x.groupBy("_key", "_b").agg(F.count("*").alias("_c")).withColumn("_n", F.sum("_c").over(Window.partitionBy("_key")))
    hist = hist.withColumn("_ranks", F.array_distinct(F.transform(F.array(*ranks(F.col("_n"))), lambda r: r.cast("bigint"))))
    buckets = located(hist, ["_key"], "_b", F.lit(0)).select("_key", "_b", "_n", "_start", "_ranks")
    values = x.join(buckets, ["_key", "_b"]).groupBy("_key", "_b", "_v").agg(
        F.count("*").alias("_c"), F.first("_n").alias("_n"), F.first("_start").alias("_start"), F.first("_ranks").alias("_ranks"))
    values = values.withColumn("_part", F.shiftright(ordered_bits(F.col("_v")), SECOND))
    parts = values.groupBy("_key", "_b", "_part").agg(F.sum("_c").alias("_c"), F.first("_n").alias("_n"), F.first("_start").alias("_start"), F.first("_ranks").alias("_ranks"))
    parts = located(parts.withColumnRenamed("_start", "_first"), ["_key", "_b"], "_part", F.col("_first")).select("_key", "_b", "_part", "_n", "_start", "_ranks")
    fine = values.select("_key", "_b", "_part", "_v", "_c").join(parts.withColumnRenamed("_start", "_first"), ["_key", "_b", "_part"])
    hits = located(fine, ["_key", "_b", "_part"], "_v", F.col("_first")).select("_key", "_n", "_v", F.explode("_ranks").alias("_r"))
    return hits.groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("_r", "_v"))).alias("_at"), F.first("_n").alias("_n"))


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], method: str = "linear"
) -> DataFrame:
    """One row per key with a column per entry of `probs`; NULL and NaN are skipped.

    `method`: `linear` (interpolate between the two ranks), `matlab` (interpolate at the
    sample-population position) or `midpoint` (mean of the two ranks).
    """
    found = select_ranks(df, keys, value, lambda n: [f(_position(p, n, method)) for p in probs.values() for f in (F.floor, F.ceil)])
    out = []
    for name, p in probs.items():
        pos = _position(p, F.col("_n"), method)
        lo, hi = F.col("_at")[F.floor(pos).cast("bigint")], F.col("_at")[F.ceil(pos).cast("bigint")]
        share = F.lit(0.5) if method == "midpoint" else pos - F.floor(pos)
        out.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * share).alias(name))
    return found.select(*[F.col("_key")[k].alias(k) for k in keys], *out)


def exact_median(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    return exact_quantiles(df, keys, value, {name: 0.5})


def median_and_mad(df: DataFrame, keys: list[str], value: str, center: str = "center", mad: str = "mad") -> DataFrame:
    """Median and unscaled median absolute deviation per key.

    The medians, a row per key, are written once: each pass over the deviations would select them again.
    """
    grouped = df.select(*keys, value, F.struct(*keys).alias("_group"))
    centers = materialize(exact_median(grouped, ["_group"], value, center))
    deviations = grouped.join(centers, "_group").withColumn("_dev", F.abs(F.col(value) - F.col(center)))
    both = centers.join(exact_median(deviations, ["_group"], "_dev", mad), "_group")
    return both.select(*[F.col("_group")[k].alias(k) for k in keys], center, mad)

"""Two-level prefix scans.

Running totals over a long ordered group: a window per (key, bucket), plus a carry from the
earlier buckets. Only the bucket summary (one row per bucket) is ever ordered per key. The
summary is a map-side combined aggregate, so the rows themselves are shuffled once, for the
window; the carry joins on the same (key, bucket) partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def prefix_scan(
    df: DataFrame,
    keys: list[str],
    bucket: Column,
    order: list,
    outputs: dict[str, tuple[str, str]],
    inclusive: bool = True,
) -> DataFrame:
    """Running `sum`, `max` or `last` (non-null) of columns: `outputs[name] = (kind, column)`.

    `bucket` must be non-decreasing in `order`. Keys are compared as one struct, in which NULL equals NULL, so rows with NULL keys make
    groups like any others and the join below keeps the window's partitioning.
    """
    parted = df.withColumns({"_bucket": bucket, "_group": F.struct(*keys, bucket.alias("_bucket"))})
    local = Window.partitionBy("_group").orderBy(*order)
    frame = local.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    totals, carries, locals_, finals = [], {}, {}, {}
    over_buckets = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    for name, (kind, column) in outputs.items():
        c = F.col(column)
        if kind == "sum":
            totals.append(F.sum(c).alias(name + "_total"))
            carries[name + "_carry"] = F.sum(name + "_total").over(over_buckets)
            locals_[name] = F.sum(c).over(frame)
            finals[name] = F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(name + "_carry"), F.lit(0))
        elif kind == "max":
            totals.append(F.max(c).alias(name + "_total"))
            carries[name + "_carry"] = F.max(name + "_total").over(over_buckets)
            locals_[name] = F.max(c).over(frame)
            finals[name] = F.greatest(F.col(name), F.col(name + "_carry"))
        elif kind == "last":
            totals.append(F.max_by(c, F.when(c.isNotNull(), rank)).alias(name + "_total"))
            carries[name + "_carry"] = F.last(name + "_total", ignorenulls=True).over(over_buckets)
            locals_[name] = F.last(c, ignorenulls=True).over(frame)
            finals[name] = F.coalesce(F.col(name), F.col(name + "_carry"))
        else:
            raise ValueError(f"unknown scan kind {kind!r}")
    carry = parted.groupBy("_group").agg(*totals).select("_group", "_group.*", *[n + "_total" for n in outputs]).select(
        "_group", *[c.alias(n) for n, c in carries.items()])
    out = parted
    for name, column in locals_.items():
        out = out.withColumn(name, column)
    out = out.join(carry, "_group", "left")
    for name, column in finals.items():
        out = out.withColumn(name, column)
    return out.drop("_bucket", "_group", *carries)


def dense_index(df: DataFrame, keys: list[str], bucket: Column, order: list, name: str = "t") -> DataFrame:
    """0-based position of each row within its key, in `order` (row_number without a hot window)."""
    out = prefix_scan(df.withColumn("_one", F.lit(1)), keys, bucket, order, {name: ("sum", "_one")})
    return out.withColumn(name, F.col(name) - 1).drop("_one")

"""Interval plans: islands of a dense clock, merging, and binned range joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import BLOCK
from .scans import prefix_scan


def islands(df: DataFrame, keys: list[str], t: str = "t", extra: dict[str, str] | None = None,
            size: int = BLOCK) -> DataFrame:
    """Runs of consecutive `t` among the rows of `df` -> (keys, start, stop) with exclusive stop.

    `extra[name] = column` carries the maximum of a column over the run. Runs are found per
    block; only runs that touch a block edge (at most two per block) are stitched per key.
    """
    extra = extra or {}
    block = F.floor(F.col(t) / F.lit(size)).cast("bigint")
    w = Window.partitionBy(*keys, "_block").orderBy(t)
    local = (
        df.withColumn("_block", block)
        .withColumn("_run", F.col(t) - F.row_number().over(w))
        .groupBy(*keys, "_block", "_run")
        .agg(F.min(t).alias("start"), (F.max(t) + 1).alias("stop"), *[F.max(c).alias(n) for n, c in extra.items()])
        .withColumn("_edge", (F.col("start") % size == 0) | (F.col("stop") % size == 0))
    )
    columns = [*keys, "start", "stop", *extra]
    along = Window.partitionBy(*keys).orderBy("start")
    stitched = (
        local.where("_edge")
        .withColumn("_new", F.coalesce((F.lag("stop").over(along) != F.col("start")).cast("int"), F.lit(1)))
        .withColumn("_chain", F.sum("_new").over(along))
        .groupBy(*keys, "_chain")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"), *[F.max(n).alias(n) for n in extra])
    )
    return local.where(~F.col("_edge")).select(*columns).unionByName(stitched.select(*columns))


def merge_overlaps(df: DataFrame, keys: list[str], bucket_width: float, start: str = "start", stop: str = "stop",
                   gap: float = 0, extra: dict[str, str] | None = None) -> DataFrame:
    """Union of intervals that overlap, touch or lie at most `gap` apart.

    `bucket_width` slices the time axis for the two-level scans, so one recording with most
    of the annotations is still spread over many tasks.
    """
    extra = extra or {}
    slices = F.floor(F.col(start) / F.lit(bucket_width)).cast("bigint")
    seen = prefix_scan(df, keys, slices, [start, stop], {"_reach": ("max", stop)}, inclusive=False)
    opened = seen.withColumn(
        "_open", F.when(F.col("_reach").isNull() | (F.col(start) > F.col("_reach") + F.lit(gap)), F.col(start))
    )
    grouped = prefix_scan(opened, keys, slices, [start, stop], {"_island": ("max", "_open")})
    return grouped.groupBy(*keys, F.col("_island").alias("start")).agg(
        F.max(stop).alias("stop"), *[F.max(c).alias(n) for n, c in extra.items()]
    )


def range_join(points: DataFrame, spans: DataFrame, keys: list[str], at: Column, start: Column, stop: Column,
               bin_width: float | Column, how: str = "inner", closed: bool = False) -> DataFrame:
    """Join points to the spans that cover them, through an equi-join on a time bin.

    Half-open spans unless `closed`. `how`: inner, left_semi or left_anti. `bin_width` may be an expression over columns
    of both sides, with one value for each combination of `keys`.
    """
    p = points.withColumn("_at", at).withColumn("_bin", F.floor(F.col("_at") / F.lit(bin_width)).cast("bigint"))
    s = spans.withColumn("_from", start).withColumn("_to", stop)
    bins = F.sequence(
        F.floor(F.col("_from") / F.lit(bin_width)).cast("bigint"),
        F.greatest(F.floor(F.col("_to") / F.lit(bin_width)), F.floor(F.col("_from") / F.lit(bin_width))).cast("bigint"),
    )
    s = s.withColumn("_bin", F.explode(bins))
    s = s.select(*[F.col(c).alias("_k_" + c) for c in keys], *[c for c in s.columns if c not in keys])
    cond = p["_bin"] == s["_bin"]
    for k in keys:
        cond = cond & (p[k] == s["_k_" + k])
    cond = cond & (p["_at"] >= s["_from"]) & ((p["_at"] <= s["_to"]) if closed else (p["_at"] < s["_to"]))
    out = p.join(s, cond, how)
    drop = ["_at", "_from", "_to", *["_k_" + k for k in keys]]
    return out.drop(*drop).drop(p["_bin"]).drop(s["_bin"]) if how == "inner" else out.drop("_at", "_bin")


def overlap_filter(items: DataFrame, spans: DataFrame, keys: list[str], ident: list[str], item: tuple[Column, Column],
                   span: tuple[Column, Column], bin_width: float, how: str, closed: bool = False) -> DataFrame:
    """Keep (`left_semi`) or drop (`left_anti`) the `items` intervals that overlap any span.

    `ident` names the columns that identify an item (they include `keys`).
    """

    def bins(a: Column, b: Column) -> Column:
        lo = F.floor(a / F.lit(bin_width)).cast("bigint")
        return F.explode(F.sequence(lo, F.greatest(lo, F.floor(b / F.lit(bin_width)).cast("bigint"))))

    i = items.select(*ident, item[0].alias("_a"), item[1].alias("_b"), bins(*item).alias("_bin"))
    s = spans.select(*[F.col(k).alias("_k_" + k) for k in keys], span[0].alias("_s"), span[1].alias("_e"),
                     bins(*span).alias("_sbin"))
    cond = i["_bin"] == s["_sbin"]
    for k in keys:
        cond = cond & (i[k] == s["_k_" + k])
    touch = (i["_a"] <= s["_e"]) & (s["_s"] <= i["_b"]) if closed else (i["_a"] < s["_e"]) & (s["_s"] < i["_b"])
    hit = i.join(s, cond & touch, "left_semi").select(*ident).distinct()
    return items.join(hit, ident, how)

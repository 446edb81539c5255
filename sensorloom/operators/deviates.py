"""Iterative extreme-studentized-deviate test over both tails of groups of any size.

The test removes, up to a share of a group, the value farthest from the mean of what is left, and marks it if its deviation exceeds the critical
value for the number left. Values are removed from the two ends only, and most of a group can never be marked. What is left keeps, at each
step, the core between the ranks k and n - k, so its spread is at least that of the core over all n values, and its mean lies between the means
without the k highest and without the k lowest values. That bounds the deviation a mark needs: rows within the bound are left out by a filter, and the
steps end when both ends lie within it. The few rows beyond it stream through a task in order of distance, with running count, sum and square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.expr import finite
from ..plans.quantiles import select_ranks


def _stats(x: DataFrame, p_out: float, level: float) -> DataFrame:
    """Per key with anything to test: n (finite), k (most removals), mean, square (about the mean) and the least critical value."""
    v = finite("_x")
    per = x.groupBy("_key").agg(F.count("*").alias("_all"), F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_pop(v).alias("_var"))
    k = F.least(F.ceil(F.col("_all") * F.lit(p_out)), F.col("n") - 2).cast("bigint")
    per = per.withColumn("k", k).where("k >= 1").select("_key", "n", "k", "mean", (F.col("_var") * F.col("n")).alias("square"))
    key = per.schema["_key"].dataType.simpleString()
    return per.mapInArrow(kernels.esd_least(level), f"_key {key}, n bigint, k bigint, mean double, square double, least double")


def _bounds(rows: DataFrame) -> DataFrame:
    """Per key: the values at the ranks k and n - 1 - k (about the mean), the deviation that a mark needs, and the bounds of the mean."""
    cuts = select_ranks(rows, ["_key", "k"], "z", lambda n: [F.col("_key")["k"], n - 1 - F.col("_key")["k"]]).select(
        F.col("_key")["_key"].alias("_key"), F.col("_at")[F.col("_key")["k"]].alias("low"), F.col("_at")[F.col("_n") - 1 - F.col("_key")["k"]].alias("high"))
    z, n, k = F.col("z"), F.col("n"), F.col("k")

    def side(below: Column, cut: str, name: str) -> list[Column]:
        return [F.count_if(below).alias(f"{name}_n"), F.sum(F.when(below, z).otherwise(0e0)).alias(f"{name}_s"), F.sum(F.when(below, z * z).otherwise(0e0)).alias(f"{name}_q")]

    per = rows.join(cuts, "_key").groupBy("_key", "n", "k", "square", "least", "low", "high").agg(
        F.sum("z").alias("s"), F.sum(z * z).alias("q"), *side(z < F.col("low"), "low", "l"), *side(z > F.col("high"), "high", "h"))
    for name, cut in (("l", "low"), ("h", "high")):  # the k outermost values of each side; ties at the cut make up the number
        more = k - F.col(f"{name}_n")
        per = per.withColumns({f"{name}_s": F.col(f"{name}_s") + more * F.col(cut), f"{name}_q": F.col(f"{name}_q") + more * F.col(cut) * F.col(cut)})
    core, total = n - 2 * k, F.col("s") - F.col("l_s") - F.col("h_s")
    spread = F.greatest(F.col("q") - F.col("l_q") - F.col("h_q") - F.try_divide(total * total, core), F.lit(0e0)) / n
    # one removal moves the mean by a share of the deviation removed: over k steps by (n / (n - k)) at most
    limit = F.when(core >= 2, F.col("least") * F.sqrt(spread) * (n - k) / n * F.lit(1 - 1e-9)).otherwise(F.lit(-1e0))
    return per.select("_key", "n", "k", "square", "low", "high", limit.alias("limit"), ((F.col("s") - F.col("h_s")) / (n - k)).alias("least_mean"),
                      ((F.col("s") - F.col("l_s")) / (n - k)).alias("most_mean"))


def gesd(values: DataFrame, keys: list[str], item: str, value: str, alpha: float = 0.05, p_out: float = 0.1, side: int = 0) -> DataFrame:
    """(keys, item, value, is_outlier) for every row: outlier marks over one value per item and group.

    `side`: 0 tests both tails, 1 high values, -1 low ones. At most `p_out` of a group is removed; every removal beyond its own critical value at level
    `alpha` is marked. Missing and infinite values count in the size of the group and are never marked. Among equal values the first item goes
    first from the low end and the last one from the high end. NULL keys are a group.
    """
    level = alpha / 2 if side == 0 else alpha
    x = values.select(F.struct(*keys).alias("_key"), F.col(item).alias("_item"), F.col(value).cast("double").alias("_x"), F.col(value).alias("_value"))
    stats = _stats(x, p_out, level)
    rows = x.where(finite("_x").isNotNull()).join(stats, "_key").select("_key", "_item", (F.col("_x") - F.col("mean")).alias("z"), "n", "k", "square", "least")
    bounds = _bounds(rows)
    z, limit = F.col("z"), F.col("limit")
    low = (z < F.col("most_mean") - limit) & (z <= F.col("low"))
    high = (z > F.col("least_mean") + limit) & (z >= F.col("high"))
    low, high = (F.lit(side <= 0) & low), (F.lit(side >= 0) & high)
    # where the core is one value, rows of that value are never marked
    tails = rows.select("_key", "_item", "z").join(bounds, "_key").where((low | high) & ((F.col("low") != F.col("high")) | (z != F.col("low")) | (limit < 0)))
    out = F.when(low, -z).otherwise(z)
    tails = tails.select("_key", "_item", "z", "n", "k", "square", "limit", low.alias("is_low"), out.alias("_out")).repartition("_key").sortWithinPartitions(
        "_key", F.desc("_out"), F.when(F.col("is_low"), F.col("_item")), F.when(~F.col("is_low"), F.col("_item")).desc()).drop("_out")
    types = dict(x.dtypes)
    marked = tails.mapInArrow(kernels.esd_tails(level, side), f"_key {types['_key']}, _item {types['_item']}").withColumn("_hit", F.lit(True))
    found = x.select("_key", "_item", "_value").join(marked, (x["_key"] == marked["_key"]) & x["_item"].eqNullSafe(marked["_item"]), "left")
    return found.select(*[x["_key"][k].alias(k) for k in keys], x["_item"].alias(item), F.col("_value").alias(value), F.coalesce("_hit", F.lit(False)).alias("is_outlier"))

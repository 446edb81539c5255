"""Sensor, vertex and parcel geometry without all-pairs joins.

Points are hashed to grid cells and meet only the points of neighbouring cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.quantiles import exact_quantiles
from ..plans.scans import dense_index
from ..session import cut_lineage

AXES = ("x", "y", "z")


def _cell(axis: str, width) -> Column:
    return F.floor(F.col(axis) / width).cast("bigint")


def _around(axis: str) -> Column:
    c = F.col("_c" + axis)
    return F.explode(F.array(c - 1, c, c + 1))


def _celled(df: DataFrame, width, spread: bool) -> DataFrame:
    """Add the grid cell; with `spread` one row per neighbouring cell."""
    for a in AXES:
        df = df.withColumn("_c" + a, _cell(a, width))
        if spread:
            df = df.withColumn("_c" + a, _around(a))
    return df


def _distance(p: str, q: str) -> Column:
    return F.sqrt(sum(((F.col(f"{p}.{a}") - F.col(f"{q}.{a}")) * (F.col(f"{p}.{a}") - F.col(f"{q}.{a}")) for a in AXES[1:]),
                      (F.col(f"{p}.x") - F.col(f"{q}.x")) * (F.col(f"{p}.x") - F.col(f"{q}.x"))))


def near_pairs(points: DataFrame, keys: list[str], ident: str, limit: float, strict: bool) -> DataFrame:
    """Ordered pairs (src, dst) of different points of a key closer than `limit` (or at most, if not `strict`)."""
    p = points.select(*keys, ident, *AXES)
    cells = [*keys, *["_c" + a for a in AXES]]
    a = _celled(p, F.lit(limit), True).withColumnRenamed(ident, "src").alias("a")
    b = _celled(p, F.lit(limit), False).withColumnRenamed(ident, "dst").alias("b")
    cond = F.lit(True)
    for c in cells:
        cond = cond & (F.col("a." + c) == F.col("b." + c))
    d = _distance("a", "b")
    near = (d < limit) if strict else (d <= limit)
    return a.join(b, cond & (F.col("a.src") != F.col("b.dst")) & near).select(
        *[F.col("a." + k).alias(k) for k in keys], "a.src", "b.dst", d.alias("distance"))


def distance_adjacency(centroids: DataFrame, keys: list[str], ident: str, limit: float) -> DataFrame:
    """Parcels closer than `limit`, plus each with itself."""
    own = centroids.select(*keys, F.col(ident).alias("src"), F.col(ident).alias("dst"))
    return near_pairs(centroids, keys, ident, limit, True).select(*keys, "src", "dst").unionByName(own)


def threshold_edges(sensors: DataFrame, keys: list[str], ident: str, limit: float) -> DataFrame:
    """Edges in both directions between sensors at most `limit` apart."""
    return near_pairs(sensors, keys, ident, limit, False).select(*keys, "src", "dst")


def nearest(points: DataFrame, targets: DataFrame, keys: list[str], k: int, exclude_self: bool = False) -> DataFrame:
    """Exact k nearest targets per point: (keys, src, dst, distance, rank).

    Rounds over a grid whose cells double in width. A point is settled when its k-th distance
    is within one cell width, because everything that close lies in the searched cells;
    otherwise it goes to the next round. When the cell covers the whole extent the round is
    complete by construction. Each round is a reliable checkpoint, so its result is used
    without recomputing earlier rounds. `points`/`targets` have `ident, x, y, z`.
    """
    p, q = points.select(*keys, "ident", *AXES), targets.select(*keys, "ident", *AXES)
    box = q.unionByName(p).agg(F.count("*").alias("n"), *[f(a).alias(f"{n}_{a}") for a in AXES for n, f in (("lo", F.min), ("hi", F.max))]).first()
    if not box["n"]:
        return _ranked(p.join(q.limit(0).withColumnRenamed("ident", "dst").drop(*AXES), keys), keys)
    spans = [max(box["hi_" + a] - box["lo_" + a], 0.0) for a in AXES]
    extent = max(max(spans), 1e-12)
    volume = 1.0
    for s in spans:
        volume *= max(s, extent * 1e-3)
    width = max((volume * 2 * (k + 1) / box["n"]) ** (1 / 3), extent * 1e-6)
    cells = [*keys, *["_c" + a for a in AXES]]
    # start where even the densest cell is small, so that clusters settle before cells grow
    while width > extent * 1e-6:
        fullest = _celled(q, F.lit(width), False).groupBy(*cells).agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 0
        if fullest <= 32 * (k + 1):
            break
        width /= 2
    open_points, settled = p, []
    while True:
        final = width > extent
        a = _celled(open_points, F.lit(width), True).alias("a")
        b = _celled(q, F.lit(width), False).alias("b")
        cond = F.lit(True)
        for c in cells:
            cond = cond & (F.col("a." + c) == F.col("b." + c))
        if exclude_self:
            cond = cond & (F.col("a.ident") != F.col("b.ident"))
        found = a.join(b, cond).select(*[F.col("a." + c).alias(c) for c in keys], F.col("a.ident").alias("src"),
                                       F.col("b.ident").alias("dst"), _distance("a", "b").alias("distance"))
        ranked = _ranked(found, keys).where(F.col("rank") <= k)
        if final:
            settled.append(ranked)
            break
        reach = F.max(F.when(F.col("rank") == k, F.col("distance")))
        done = ranked.groupBy(*keys, "src").agg(reach.alias("_d")).where(F.col("_d") <= width).select(*keys, "src")
        ranked = cut_lineage(ranked.join(done, [*keys, "src"], "left_semi"))
        settled.append(ranked)
        open_points = cut_lineage(open_points.join(
            ranked.where("rank = 1").select(*keys, F.col("src").alias("ident")), [*keys, "ident"], "left_anti").select(*keys, "ident", *AXES))
        if open_points.isEmpty():
            break
        width *= 2
    out = settled[0]
    for s in settled[1:]:
        out = out.unionByName(s)
    return out


def _ranked(found: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys, "src").orderBy("distance", "dst")
    return found.withColumn("rank", F.row_number().over(w))


def knn_edges(sensors: DataFrame, keys: list[str], ident: str, k: int = 6) -> DataFrame:
    """k nearest sensors, symmetrised, distinct."""
    s = sensors.withColumnRenamed(ident, "ident")
    near = nearest(s, s, keys, k, exclude_self=True).select(*keys, "src", "dst")
    return near.unionByName(near.select(*keys, F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def nearest_point_distance(points: DataFrame, surface: DataFrame, keys: list[str]) -> DataFrame:
    """Distance from each head point to its closest surface vertex."""
    return nearest(points, surface, keys, 1).select(*keys, F.col("src").alias("ident"), F.col("dst").alias("vertex"), "distance")


def distance_summary(distances: DataFrame, keys: list[str], scale: float = 1000.0) -> DataFrame:
    """Mean, minimum and maximum distance, scaled to millimetres."""
    d = F.col("distance") * scale
    return distances.groupBy(*keys).agg(F.avg(d).alias("dist_mean"), F.min(d).alias("dist_min"), F.max(d).alias("dist_max"))


def reject_far_points(points: DataFrame, keys: list[str], ident: str, min_percent: float = 2, max_percent: float = 10,
                      close_enough: float = 20.0) -> DataFrame:
    """Points to leave out by distance fences (1.5 and 3 interquartile ranges, midpoint quartiles), within bounds on their number.

    `points(keys, ident, distance, outward)`. Nothing is rejected when no point lies outward and all are close.
    """
    q = exact_quantiles(points, keys, "distance", {"_q1": 0.25, "_q3": 0.75}, method="midpoint")
    totals = points.groupBy(*keys).agg(F.count("*").alias("_n"), F.count_if("outward").alias("_out"), F.max("distance").alias("_far"))
    j = points.join(q, keys).join(totals, keys).withColumn("_iqr", F.col("_q3") - F.col("_q1"))
    j = j.withColumn("_outlier", F.col("distance") > F.col("_q3") + 1.5 * F.col("_iqr")).withColumn(
        "_extreme", F.col("distance") > F.col("_q3") + 3.0 * F.col("_iqr"))
    counts = j.groupBy(*keys).agg(F.count_if("_extreme").alias("_ext"), F.count_if("_outlier").alias("_outl"))
    slices = -F.floor(F.col("distance") / F.greatest(F.col("_iqr") / 16, F.lit(1e-12)))
    placed = dense_index(j, keys, slices.cast("bigint"), [F.desc("distance"), F.col(ident)], "_place").join(counts, keys)
    least, most = F.ceil(F.col("_n") * min_percent / 100), F.ceil(F.col("_n") * max_percent / 100)
    listed = F.col("_ext") + F.col("_outl")  # extremes are counted with the outliers too
    top = F.col("_place") < least
    rule = (F.when((F.col("_out") == 0) & (F.col("_far") < close_enough), F.lit(False)).when(listed == 0, top)
            .when(listed < least, F.col("_outlier") | top).when(F.col("_ext") >= most, F.col("_extreme"))
            .when(listed >= most, F.col("_outlier")).otherwise(top))
    return placed.select(*points.columns, rule.alias("rejected"))


def winner_takes_all(weights: DataFrame, voxel: str = "voxel", parcel: str = "parcel") -> DataFrame:
    """Parcel of the largest weight per voxel; the lower parcel on ties."""
    best = F.max_by(F.col(parcel), F.struct("weight", -F.col(parcel)))
    return weights.groupBy(voxel).agg(best.alias(parcel))


def source_peak(estimates: DataFrame, selections: DataFrame, roi: DataFrame) -> DataFrame:
    """Vertex and time of the largest absolute value per selection.

    `selections(selection, recording_id, hemi, mode, time, roi)`: mode `peak` looks everywhere;
    otherwise the nearest sampled time and, for mode `label`, the vertices of the region (all if
    it has none). `roi(roi, hemi, vertex)`.
    """
    e, s = estimates, selections
    times = e.select("recording_id", "hemi", "time").distinct().join(
        s.where("mode <> 'peak' and time is not null").select("selection", "recording_id", "hemi", F.col("time").alias("_want")), ["recording_id", "hemi"])
    chosen = times.groupBy("selection").agg(F.min_by("time", F.struct(F.abs(F.col("time") - F.col("_want")), "time")).alias("_at"))
    j = e.join(s.withColumnRenamed("time", "_want"), ["recording_id", "hemi"]).join(chosen, "selection", "left")
    j = j.where(F.col("_at").isNull() | (F.col("time") == F.col("_at")))
    inside = roi.select("roi", "hemi", "vertex", F.lit(1).alias("_in"))
    j = j.join(inside, ["roi", "hemi", "vertex"], "left")
    best = F.struct(F.abs("value").alias("a"), (-F.col("vertex")).alias("v"), (-F.col("time")).alias("t"))
    use_roi = (F.col("mode") == "label") & F.col("_in").isNotNull()
    both = j.groupBy("selection", "recording_id", "hemi").agg(F.max(best).alias("_all"), F.max(F.when(use_roi, best)).alias("_roi"))
    top = both.withColumn("_b", F.coalesce("_roi", "_all"))
    return top.select("selection", "recording_id", "hemi", (-F.col("_b.v")).alias("vertex"), (-F.col("_b.t")).alias("time"), F.col("_b.a").alias("peak"))

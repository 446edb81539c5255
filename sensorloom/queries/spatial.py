"""Geometry on the points view (two surfaces by `side`) and source peaks."""

from pyspark.sql import functions as F

from ..functions.expr import r6, r6_off_ties
from ..operators import spatial as op
from ..sources.bindings import with_views
from . import query

DIST = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z))"


@query("distance_adjacency", with_views(f"SELECT a.side, a.vec_id AS src, b.vec_id AS dst FROM points a JOIN points b ON a.side = b.side AND (a.vec_id = b.vec_id OR {DIST} < 0.06e0)", "points"))
def _(t):
    return op.distance_adjacency(t.points(), ["side"], "vec_id", 0.06)


@query("threshold_edges", with_views(f"SELECT a.side, a.vec_id AS src, b.vec_id AS dst FROM points a JOIN points b ON a.side = b.side AND a.vec_id <> b.vec_id AND {DIST} <= 0.05e0", "points"))
def _(t):
    return op.threshold_edges(t.points(), ["side"], "vec_id", 0.05)


@query("knn_edges", with_views(f""", n AS (SELECT a.side, a.vec_id AS src, b.vec_id AS dst FROM points a JOIN points b ON a.side = b.side AND a.vec_id <> b.vec_id
 QUALIFY row_number() OVER (PARTITION BY a.side, a.vec_id ORDER BY {DIST}, b.vec_id) <= 6) SELECT side, src, dst FROM n UNION SELECT side, dst, src FROM n""", "points"))
def _(t):
    return op.knn_edges(t.points(), ["side"], "vec_id", 6)


NEAR = f""", nd AS (SELECT a.vec_id AS ident, b.vec_id AS vertex, {DIST} AS distance FROM points a JOIN points b ON a.side = 0 AND b.side = 1
 QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY {DIST}, b.vec_id) = 1) """


def head_distances(t):
    p = t.points().withColumn("head", F.lit(1)).withColumnRenamed("vec_id", "ident")
    return op.nearest_point_distance(p.where("side = 0"), p.where("side = 1"), ["head"])


@query("nearest_point_distance", with_views(NEAR + "SELECT ident, vertex, round(distance, 6) AS distance FROM nd", "points"))
def _(t):
    return head_distances(t).select("ident", "vertex", r6("distance").alias("distance"))


@query("distance_summary", with_views(NEAR + "SELECT 1 AS head, round(avg(distance * 1000), 6) AS dist_mean, round(min(distance * 1000), 6) AS dist_min, round(max(distance * 1000), 6) AS dist_max FROM nd", "points"))
def _(t):
    return op.distance_summary(head_distances(t), ["head"]).withColumns({c: r6(c) for c in ("dist_mean", "dist_min", "dist_max")})


FAR = """WITH p AS (SELECT label % 3 AS head, vec_id, abs(CAST(embedding[1] AS DOUBLE)) * CASE WHEN label % 3 = 0 THEN 10 ELSE 100 END * CASE WHEN label = 2 AND embedding[2] > 0 THEN 6 ELSE 1 END AS distance, label <> 0 AND label <> 3 AND label <> 6 AND label <> 9 AND embedding[3] > 0 AS outward FROM embeddings),
o AS (SELECT head, list(distance ORDER BY distance) AS d, count(*) AS n FROM p GROUP BY 1),
q AS (SELECT head, n, (d[floor(0.25e0 * (n - 1))::BIGINT + 1] + d[ceil(0.25e0 * (n - 1))::BIGINT + 1]) / 2 AS q1, (d[floor(0.75e0 * (n - 1))::BIGINT + 1] + d[ceil(0.75e0 * (n - 1))::BIGINT + 1]) / 2 AS q3 FROM o),
f AS (SELECT p.*, n, distance > q3 + 1.5e0 * (q3 - q1) AS ou, distance > q3 + 3e0 * (q3 - q1) AS ex, row_number() OVER (PARTITION BY p.head ORDER BY distance DESC, vec_id) - 1 AS pl FROM p JOIN q USING (head)),
c AS (SELECT head, count(*) FILTER (ex) AS ne, count(*) FILTER (ou) AS no, count(*) FILTER (outward) AS nout, max(distance) AS far, ceil(any_value(n) * 2 / 100) AS mn, ceil(any_value(n) * 10 / 100) AS mx FROM f GROUP BY 1)
SELECT head, vec_id, CASE WHEN nout = 0 AND far < 20 THEN false WHEN ne + no = 0 THEN pl < mn WHEN ne + no < mn THEN ou OR pl < mn WHEN ne >= mx THEN ex WHEN ne + no >= mx THEN ou ELSE pl < mn END AS rejected FROM f JOIN c USING (head)"""


@query("reject_far_points", FAR)
def _(t):
    e, lab = F.col("embedding"), F.col("label")
    head = lab % 3
    d = F.abs(e[0].cast("double")) * F.when(head == 0, 10).otherwise(100) * F.when((lab == 2) & (e[1] > 0), 6).otherwise(1)
    p = t.table("embeddings").select(head.alias("head"), "vec_id", d.alias("distance"), ((head != 0) & (e[2] > 0)).alias("outward"))
    return op.reject_far_points(p, ["head"], "vec_id").select("head", "vec_id", "rejected")


@query("winner_takes_all", """
SELECT vec_id AS voxel, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS parcel FROM embeddings""")
def _(t):
    w = t.table("embeddings").select(F.col("vec_id").alias("voxel"), F.posexplode("embedding").alias("parcel", "weight"))
    return op.winner_takes_all(w)


EST = """WITH e AS (SELECT label % 2 AS recording_id, CASE WHEN vec_id % 2 = 0 THEN 'lh' ELSE 'rh' END AS hemi, vec_id AS vertex, i / 4e0 AS time, CAST(embedding[i] AS DOUBLE) AS value FROM embeddings, range(1, 65) r(i)),
s AS (SELECT recording_id || hemi || m AS selection, recording_id, hemi, m AS mode FROM (SELECT DISTINCT recording_id, hemi FROM e), (VALUES ('peak'), ('time'), ('label')) v(m)),
x AS (SELECT selection, s.recording_id, s.hemi, mode, vertex, time, abs(value) AS a FROM e JOIN s USING (recording_id, hemi)
 WHERE mode = 'peak' OR (mode = 'time' AND time = 7.5e0) OR (mode = 'label' AND (hemi = 'rh' OR (SELECT any_value(label) < 5 FROM embeddings m WHERE m.vec_id = e.vertex))))
SELECT selection, recording_id, hemi, vertex, time, round(a, 6) AS peak FROM x QUALIFY row_number() OVER (PARTITION BY selection ORDER BY a DESC, vertex, time) = 1"""


@query("source_peak", EST)
def _(t):
    emb = t.table("embeddings").select("*", F.when(F.col("vec_id") % 2 == 0, "lh").otherwise("rh").alias("hemi"))
    e = emb.select((F.col("label") % 2).alias("recording_id"), "hemi", F.col("vec_id").alias("vertex"), F.posexplode("embedding").alias("i", "v")).select(
        "recording_id", "hemi", "vertex", ((F.col("i") + 1) / 4e0).alias("time"), F.col("v").cast("double").alias("value"))
    modes = F.array(*[F.struct(F.lit(m).alias("mode"), F.lit(w).cast("double").alias("time"), F.lit(r).alias("roi"))
                      for m, w, r in (("peak", None, None), ("time", 7.4, None), ("label", None, "low"))])
    s = e.select("recording_id", "hemi").distinct().select("*", F.inline(modes)).withColumn(
        "selection", F.concat(F.col("recording_id").cast("string"), "hemi", "mode"))
    # the region is defined on the left side only, so right-side selections fall back to all vertices
    roi = emb.where("label < 5 and hemi = 'lh'").select(F.lit("low").alias("roi"), "hemi", F.col("vec_id").alias("vertex"))
    return op.source_peak(e, s, roi).withColumn("peak", r6("peak"))

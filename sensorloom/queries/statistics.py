"""Covariance, sign alignment, parcels and linear models."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.expr import r6
from ..operators import statistics as op
from ..sources.bindings import with_views
from . import query
from .events import EP, epochs

NAMES = ["click", "error", "purchase", "signup", "view"]
COV = """, cv AS (SELECT a.recording_id, a.ch_name AS ci, b.ch_name AS cj, covar_samp(a.value, b.value) AS cov, count(*)::DOUBLE AS n FROM samples a JOIN samples b
 ON a.recording_id = b.recording_id AND a.t = b.t AND a.ch_name <= b.ch_name GROUP BY 1, 2, 3),
ix AS (SELECT recording_id, list_position(['click', 'error', 'purchase', 'signup', 'view'], ci) AS i, list_position(['click', 'error', 'purchase', 'signup', 'view'], cj) AS j, cov FROM cv) """


def indexed(t):
    names = F.array(*[F.lit(n) for n in NAMES])
    return op.empirical_covariance(t.samples()).select(
        "recording_id", F.array_position(names, F.col("ci")).alias("i"), F.array_position(names, F.col("cj")).alias("j"), "ci", "cj", "cov")


@query("empirical_covariance", with_views(COV + "SELECT recording_id, ci, cj, round(cov, 6) AS cov, n FROM cv", "samples"))
def _(t):
    return op.empirical_covariance(t.samples()).withColumn("cov", r6("cov"))


@query("time_embed", with_views(""",
x AS (SELECT recording_id, ch_name, t, lag(value) OVER w AS a, value AS b, lead(value) OVER w AS c FROM samples WINDOW w AS (PARTITION BY recording_id, ch_name ORDER BY t))
SELECT recording_id, ch_name, t, CAST(l AS INTEGER) AS lag, CASE l WHEN -1 THEN a WHEN 0 THEN b ELSE c END AS value FROM x, range(-1, 2) r(l) WHERE a IS NOT NULL AND c IS NOT NULL""", "samples"))
def _(t):
    return op.time_embed(t.samples(), 3)


@query("standardize", with_views("""SELECT recording_id, ch_name, t, round((value - avg(value) OVER w) / stddev_pop(value) OVER w, 6) + 0e0 AS value FROM samples WINDOW w AS (PARTITION BY recording_id, ch_name)""", "samples"))
def _(t):
    return op.standardize(t.samples()).select("recording_id", "ch_name", "t", r6("value").alias("value"))


@query("covariance_similarity", with_views(COV + """, tm AS (SELECT i, j, avg(cov) AS c FROM ix GROUP BY 1, 2)
SELECT recording_id, round(corr(abs(cov), abs(c)), 6) AS similarity FROM ix JOIN tm USING (i, j) WHERE j - i >= 1 GROUP BY 1""", "samples"))
def _(t):
    c = indexed(t)
    template = c.groupBy("i", "j").agg(F.avg("cov").alias("cov"))
    return op.covariance_similarity(c, template, 1, "abs").withColumn("similarity", r6("similarity"))


SUMS = COV + """, pr AS (SELECT a.recording_id, b.recording_id AS other, corr(abs(a.cov), abs(b.cov)) AS c FROM ix a JOIN ix b ON a.i = b.i AND a.j = b.j AND a.recording_id <> b.recording_id GROUP BY 1, 2),
sm AS (SELECT recording_id, sum(c) AS s FROM pr GROUP BY 1) """


@query("summed_similarity", with_views(SUMS + "SELECT recording_id, round(s, 6) AS similarity_sum FROM sm", "samples"))
def _(t):
    return op.summed_similarity(indexed(t)).withColumn("similarity_sum", r6("similarity_sum"))


@query("template_subject", with_views(SUMS + "SELECT recording_id, round(s, 6) AS similarity_sum FROM sm QUALIFY row_number() OVER (ORDER BY s, recording_id) = count(*) OVER () // 2 + 1", "samples"))
def _(t):
    return op.template_subject(indexed(t)).withColumn("similarity_sum", r6("similarity_sum"))


def flips(t):
    c = indexed(t)
    template = c.groupBy("ci", "cj").agg(F.avg("cov").alias("cov"))
    return op.find_flips(c, template)


# All sign vectors whose first sign is +1 stand against the search; a vector and its opposite score alike.
FLIPS = COV + """, tm AS (SELECT ci, cj, avg(cov) AS c FROM cv GROUP BY 1, 2),
nm AS (SELECT recording_id, ci AS ch_name, row_number() OVER (PARTITION BY recording_id ORDER BY ci) - 1 AS pos, count(*) OVER (PARTITION BY recording_id) AS k FROM cv WHERE ci = cj),
vs AS (SELECT recording_id, unnest(range(0, CAST(pow(2, k - 1) AS BIGINT))) AS v FROM (SELECT DISTINCT recording_id, k FROM nm)),
sg AS (SELECT recording_id, v, ch_name, CASE WHEN pos = 0 OR (v >> (pos - 1)) % 2 = 0 THEN 1 ELSE -1 END AS s FROM vs JOIN nm USING (recording_id)),
sr AS (SELECT c.recording_id, a.v, coalesce(CASE WHEN isfinite(corr(c.cov * a.s * b.s, tm.c)) THEN corr(c.cov * a.s * b.s, tm.c) END, 0e0) AS score
  FROM cv c JOIN tm USING (ci, cj) JOIN sg a ON a.recording_id = c.recording_id AND a.ch_name = c.ci JOIN sg b ON b.recording_id = c.recording_id AND b.ch_name = c.cj AND b.v = a.v
  WHERE c.ci < c.cj GROUP BY 1, 2),
bs AS (SELECT recording_id, arg_max(v, score) AS v, max(score) AS after, max(score) FILTER (v = 0) AS before FROM sr GROUP BY 1)
SELECT recording_id, ch_name, CAST(s AS INTEGER) AS flip, round(before, 6) + 0e0 AS metric_before, round(after, 6) + 0e0 AS metric_after FROM bs JOIN sg USING (recording_id, v)"""


@query("find_flips", with_views(FLIPS, "samples"))
def _(t):
    first = F.min_by("flip", "ch_name").over(Window.partitionBy("recording_id"))  # channels of a recording
    return flips(t).withColumn("flip", F.col("flip") * first).withColumns({"metric_before": r6("metric_before"), "metric_after": r6("metric_after")})


@query("apply_flips", with_views("""
SELECT recording_id, ch_name, t, round(value * CASE WHEN ch_name = 'click' AND recording_id % 2 = 0 THEN -1 ELSE 1 END, 6) + 0e0 AS value FROM samples""", "samples"))
def _(t):
    s = t.samples()
    flip = s.select("recording_id", "ch_name").distinct().withColumn(
        "flip", F.when((F.col("ch_name") == "click") & (F.col("recording_id") % 2 == 0), -1).otherwise(1))
    return op.apply_flips(s, flip).select("recording_id", "ch_name", "t", r6("value").alias("value"))


def squared(name: str, source: str) -> str:
    """The square of a symmetric matrix (a list of rows), scaled by its trace."""
    return (f", {name} AS (SELECT recording_id, parcel, names, g, [[list_dot_product(r, c) / list_sum([list_dot_product(x, x) FOR x IN m]) FOR c IN m] FOR r IN m] AS m FROM {source})")


# The leading direction of a parcel is a column of a high power of its cross-products: twelve squarings are power 4,096.
PARCEL = """, vx AS (SELECT recording_id, ch_type AS parcel, ch_name AS voxel, t, value FROM samples),
cr AS (SELECT recording_id, parcel, a.voxel AS ci, b.voxel AS cj, sum(a.value * b.value) - sum(a.value) * sum(b.value) / count(*) AS g FROM vx a JOIN vx b USING (recording_id, parcel, t) GROUP BY 1, 2, 3, 4),
rw AS (SELECT recording_id, parcel, ci, list(g ORDER BY cj) AS r FROM cr GROUP BY 1, 2, 3),
m0 AS (SELECT recording_id, parcel, list(ci ORDER BY ci) AS names, list(r ORDER BY ci) AS g, list(r ORDER BY ci) AS m FROM rw GROUP BY 1, 2)""" + "".join(
    squared(f"m{k + 1}", f"m{k}") for k in range(12)) + """,
dg AS (SELECT *, [m[i][i] FOR i IN range(1, len(m) + 1)] AS d FROM m12),
u0 AS (SELECT recording_id, parcel, names, g, m[list_position(d, list_max(d))] AS u FROM dg),
u1 AS (SELECT recording_id, parcel, names, g, [x / sqrt(list_dot_product(u, u)) FOR x IN u] AS u FROM u0),
ev AS (SELECT recording_id, parcel, names, u, list_dot_product(u, [list_dot_product(r, u) FOR r IN g]) AS eigenvalue FROM u1),
ld AS (SELECT recording_id, parcel, eigenvalue, unnest(names) AS voxel, unnest(u) AS loading FROM ev),
st AS (SELECT recording_id, parcel, voxel, avg(value) AS m, stddev_pop(value) AS s, count(*) AS n FROM vx GROUP BY 1, 2, 3),
gn AS (SELECT recording_id, parcel, sign(avg(loading)) * (sum(abs(loading) * s) / sum(abs(loading))) / greatest(max(sqrt(greatest(eigenvalue, 0e0) / n)), 2.220446049250313e-16) AS gain
  FROM ld JOIN st USING (recording_id, parcel, voxel) GROUP BY 1, 2)
SELECT recording_id, parcel, t, round(sum(loading * (value - m)) * any_value(gain), 3) + 0e0 AS value
FROM vx JOIN ld USING (recording_id, parcel, voxel) JOIN st USING (recording_id, parcel, voxel) JOIN gn USING (recording_id, parcel) GROUP BY recording_id, parcel, t"""


@query("parcel_timecourse", with_views(PARCEL, "samples"))
def _(t):
    s = t.samples()
    voxels = s.select("recording_id", F.col("ch_name").alias("voxel"), "t", "value")
    parcels = s.select(F.col("ch_name").alias("voxel"), F.col("ch_type").alias("parcel")).distinct()
    return op.parcel_timecourse(voxels, parcels).withColumn("value", F.round("value", 3) + F.lit(0e0))


GLM = EP + """, g AS (SELECT recording_id, ch_name, k, CAST(event_id AS DOUBLE) AS x, value AS y FROM ep),
r AS (SELECT recording_id, ch_name, k, count(*) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, avg(x) AS mx FROM g GROUP BY 1, 2, 3),
q AS (SELECT *, greatest(syy - b * sxy, 0) / (n - 2) AS s2 FROM r WHERE n > 3 AND sxx > 0) """


def trials(t):
    e = epochs(t)
    enough = e.groupBy("recording_id", "ch_name", "k").agg(F.count("*").alias("n"), F.var_pop("event_id").alias("v")).where("n > 3 and v > 0")
    return e.join(enough.drop("n", "v"), ["recording_id", "ch_name", "k"], "left_semi")


@query("glm_epochs", with_views(GLM + """
SELECT recording_id, ch_name, k, 'slope' AS contrast, round(b, 6) + 0e0 AS cope, round(b / sqrt(s2 / sxx), 6) + 0e0 AS t FROM q
UNION ALL SELECT recording_id, ch_name, k, 'mean1', round(a + b, 6) + 0e0, round((a + b) / sqrt(s2 * (1e0 / n + (1 - mx) * (1 - mx) / sxx)), 6) + 0e0 FROM q""", "triggers", "samples"))
def _(t):
    out = op.glm_epochs(trials(t), [F.lit(1e0), F.col("event_id")], {"slope": [0, 1], "mean1": [1, 1]})
    return out.withColumns({"cope": r6("cope"), "t": r6("t")})


FIRST = EP + ", fl AS (SELECT recording_id AS subject, ch_name, k, avg(value) AS cope FROM ep GROUP BY 1, 2, 3) "


def first_level(t):
    return epochs(t).groupBy(F.col("recording_id").alias("subject"), "ch_name", "k").agg(F.avg("value").alias("cope"))


@query("group_glm", with_views(FIRST + """
SELECT ch_name, k, round(avg(cope), 6) AS cope, count(*) AS n, round(avg(cope) / (stddev_samp(cope) / sqrt(count(*))), 6) AS t FROM fl GROUP BY 1, 2""", "triggers", "samples"))
def _(t):
    return op.group_glm(first_level(t), ["ch_name", "k"]).withColumns({"cope": r6("cope"), "t": r6("t")})


@query("glm_spectrum", with_views(""",
n0 AS (SELECT recording_id, ch_name, max(t) + 1 AS n FROM samples GROUP BY 1, 2),
w0 AS (SELECT recording_id, ch_name, unnest(range(0, (n - 16) // 8 + 1)) AS win FROM n0 WHERE n >= 16),
w1 AS (SELECT w0.recording_id, w0.ch_name, win, t - win * 8 AS i, value - avg(value) OVER (PARTITION BY w0.recording_id, w0.ch_name, win) AS v
  FROM w0 JOIN samples s ON s.recording_id = w0.recording_id AND s.ch_name = w0.ch_name AND t >= win * 8 AND t < win * 8 + 16),
w2 AS (SELECT *, v * (0.5e0 - 0.5e0 * cos(2 * pi() * i / 16)) AS x FROM w1),
p AS (SELECT recording_id, ch_name, win, k, (pow(sum(x * cos(2 * pi() * ((k * i) % 16) / 16)), 2) + pow(sum(x * sin(2 * pi() * ((k * i) % 16) / 16)), 2)) / (16e0 * 6e0)
  * CASE WHEN k BETWEEN 1 AND 7 THEN 2 ELSE 1 END AS y FROM w2, range(0, 9) r(k) GROUP BY 1, 2, 3, 4),
ld AS (SELECT recording_id, t // 8 AS win, stddev_pop(value) AS x FROM samples GROUP BY 1, 2),
r AS (SELECT recording_id, ch_name, CAST(k AS DOUBLE) AS freq, count(*) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, avg(x) AS mx
  FROM p JOIN ld USING (recording_id, win) GROUP BY 1, 2, 3),
q AS (SELECT *, greatest(syy - b * sxy, 0) / (n - 2) AS s2 FROM r)
SELECT recording_id, ch_name, freq, 'load' AS contrast, round(b, 6) + 0e0 AS cope, round(b / sqrt(s2 / sxx), 6) + 0e0 AS t FROM q
UNION ALL SELECT recording_id, ch_name, freq, 'mean', round(a, 6) + 0e0, round(a / sqrt(s2 * (1e0 / n + mx * mx / sxx)), 6) + 0e0 FROM q""", "samples"))
def _(t):
    windows = t.samples().groupBy("recording_id", F.floor(F.col("t") / 8).cast("bigint").alias("win")).agg(F.stddev_pop("value").alias("load"))
    out = op.glm_spectrum(t.samples(), windows, 16.0, 16, {"mean": [1, 0], "load": [0, 1]}, ["load"])
    return out.withColumns({"cope": r6("cope"), "t": r6("t")})


@query("max_stat_permutation", with_views(FIRST + """,
x AS (SELECT ch_name, k, p AS perm, cope, md5(subject || ':' || p || ':11') AS d FROM fl, range(0, 51) r(p)),
z AS (SELECT ch_name, k, perm, cope * CASE WHEN perm = 0 OR d < '8' THEN 1 ELSE -1 END AS v FROM x),
g AS (SELECT ch_name, k, perm, abs(avg(v) / (stddev_samp(v) / sqrt(count(*)))) AS t FROM z GROUP BY 1, 2, 3)
SELECT CAST(perm AS INTEGER) AS perm, round(max(t), 6) AS max_stat FROM g GROUP BY 1""", "triggers", "samples"))
def _(t):
    return op.max_stat_permutation(first_level(t), ["ch_name", "k"], 50, 11).withColumn("max_stat", r6("max_stat"))


@query("permutation_threshold", with_views(FIRST + """,
x AS (SELECT ch_name, k, p AS perm, cope, md5(subject || ':' || p || ':11') AS d FROM fl, range(0, 51) r(p)),
z AS (SELECT ch_name, k, perm, cope * CASE WHEN perm = 0 OR d < '8' THEN 1 ELSE -1 END AS v FROM x),
g AS (SELECT ch_name, k, perm, abs(avg(v) / (stddev_samp(v) / sqrt(count(*)))) AS t FROM z GROUP BY 1, 2, 3), m AS (SELECT perm, max(t) AS m FROM g GROUP BY 1)
SELECT round(quantile_cont(m, 0.95), 6) AS threshold FROM m""", "triggers", "samples"))
def _(t):
    null = op.max_stat_permutation(first_level(t), ["ch_name", "k"], 50, 11)
    return op.permutation_threshold(null).withColumn("threshold", r6("threshold"))

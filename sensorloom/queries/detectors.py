"""Outlier detectors on the samples view."""

from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.expr import r6, r6_off_ties
from ..operators import detectors as op
from ..sources.bindings import fir_sql, with_views
from . import query
from .events import EP, epochs

SFREQ = 250.0
WIN = 16


@query("bad_nan_flat", with_views(""",
c AS (SELECT recording_id, ch_name, quantile_cont(value, 0.5) AS m FROM samples GROUP BY 1, 2)
SELECT recording_id, ch_name, false AS has_nan, quantile_cont(abs(value - m), 0.5) < 1e-15 OR stddev_pop(value) < 1e-15 AS is_flat,
 round(quantile_cont(abs(value - m), 0.5) + 1e-9, 6) AS mad, round(stddev_pop(value), 6) AS std FROM samples JOIN c USING (recording_id, ch_name) GROUP BY 1, 2""", "samples"))
def _(t):
    return op.bad_nan_flat(t.samples_once()).withColumns({"mad": r6_off_ties("mad"), "std": r6("std")})


@query("bad_by_deviation", with_views(""",
o AS (SELECT recording_id, ch_name, list(value ORDER BY value) AS v, count(*) AS n FROM samples GROUP BY 1, 2),
p AS (SELECT *, (n - 1) * greatest(0e0, least(1e0, (0.25e0 - 0.5e0) * n / (n - 1) + 0.5e0)) AS a, (n - 1) * greatest(0e0, least(1e0, (0.75e0 - 0.5e0) * n / (n - 1) + 0.5e0)) AS b FROM o),
am AS (SELECT recording_id, ch_name, 0.7413e0 * ((v[floor(b)::BIGINT + 1] + (v[ceil(b)::BIGINT + 1] - v[floor(b)::BIGINT + 1]) * (b - floor(b)))
  - (v[floor(a)::BIGINT + 1] + (v[ceil(a)::BIGINT + 1] - v[floor(a)::BIGINT + 1]) * (a - floor(a)))) AS amp FROM p),
r AS (SELECT recording_id, list(amp ORDER BY amp) AS v, count(*) AS n, quantile_cont(amp, 0.5) AS med FROM am GROUP BY 1),
rp AS (SELECT *, (n - 1) * greatest(0e0, least(1e0, (0.25e0 - 0.5e0) * n / (n - 1) + 0.5e0)) AS a, (n - 1) * greatest(0e0, least(1e0, (0.75e0 - 0.5e0) * n / (n - 1) + 0.5e0)) AS b FROM r),
sd AS (SELECT recording_id, med, 0.7413e0 * ((v[floor(b)::BIGINT + 1] + (v[ceil(b)::BIGINT + 1] - v[floor(b)::BIGINT + 1]) * (b - floor(b)))
  - (v[floor(a)::BIGINT + 1] + (v[ceil(a)::BIGINT + 1] - v[floor(a)::BIGINT + 1]) * (a - floor(a)))) AS s FROM rp)
SELECT recording_id, ch_name, round(amp + 1e-9, 6) AS amplitude, round((amp - med) / s + 1e-9, 6) AS z, abs((amp - med) / s) > 1e0 AS is_bad FROM am JOIN sd USING (recording_id)""", "samples"))
def _(t):
    return op.bad_by_deviation(t.samples_once(), 1.0).withColumns({"amplitude": r6_off_ties("amplitude"), "z": r6_off_ties("z")})


HF = fir_sql(kernels.lowpass_taps(50.0, SFREQ, 31)) + """, lo AS (SELECT recording_id, ch_name, y AS a, value - y AS b FROM fx),
md AS (SELECT recording_id, ch_name, quantile_cont(a, 0.5) AS ma, quantile_cont(b, 0.5) AS mb FROM lo GROUP BY 1, 2),
nz AS (SELECT recording_id, ch_name, quantile_cont(abs(b - mb), 0.5) / quantile_cont(abs(a - ma), 0.5) AS noisiness FROM lo JOIN md USING (recording_id, ch_name) GROUP BY 1, 2),
m0 AS (SELECT recording_id, quantile_cont(noisiness, 0.5) AS m FROM nz GROUP BY 1),
sd AS (SELECT recording_id, any_value(m) AS m, 1.4826e0 * quantile_cont(abs(noisiness - m), 0.5) AS s FROM nz JOIN m0 USING (recording_id) GROUP BY 1),
hf AS (SELECT recording_id, ch_name, noisiness, (noisiness - m) / s AS z, (noisiness - m) / s > 1e0 AS is_bad FROM nz JOIN sd USING (recording_id)) """


def hf(t):
    return op.bad_by_hfnoise(t.samples(), SFREQ, 1.0, taps=31)


@query("bad_by_hfnoise", with_views(HF + "SELECT recording_id, ch_name, round(noisiness, 6) AS noisiness, round(z, 6) + 0e0 AS z, is_bad FROM hf", "samples"))
def _(t):
    return hf(t).withColumns({"noisiness": r6("noisiness"), "z": r6("z")})


CW = f""", n0 AS (SELECT recording_id, ch_name, max(t) + 1 AS n FROM samples GROUP BY 1, 2),
wn AS (SELECT s.recording_id, ch_name, t // {WIN} AS win, t, value FROM samples s JOIN n0 USING (recording_id, ch_name) WHERE t // {WIN} < n // {WIN}),
md AS (SELECT recording_id, win, ch_name, quantile_cont(value, 0.5) AS m FROM wn GROUP BY 1, 2, 3),
fl AS (SELECT recording_id, win, ch_name, quantile_cont(abs(value - m), 0.5) = 0 AS dropout FROM wn JOIN md USING (recording_id, win, ch_name) GROUP BY 1, 2, 3),
pc AS (SELECT a.recording_id, a.win, a.ch_name, b.ch_name AS other, abs(corr(a.value, b.value)) AS c FROM wn a JOIN wn b ON a.recording_id = b.recording_id AND a.t = b.t AND a.ch_name <> b.ch_name GROUP BY 1, 2, 3, 4),
cc AS (SELECT recording_id, win, ch_name, CASE WHEN dropout THEN 0e0 ELSE max(c) END AS max_corr, dropout FROM fl LEFT JOIN pc USING (recording_id, win, ch_name) GROUP BY recording_id, win, ch_name, dropout) """


def consistency(t):
    return op.window_consistency(t.samples(), WIN)


@query("window_consistency", with_views(CW + "SELECT recording_id, win, ch_name, round(max_corr, 6) AS max_corr, dropout FROM cc", "samples"))
def _(t):
    return consistency(t).withColumn("max_corr", r6("max_corr"))


@query("bad_by_correlation", with_views(CW + """
SELECT recording_id, ch_name, round(avg(CASE WHEN max_corr < 0.3e0 THEN 1e0 WHEN max_corr IS NOT NULL THEN 0e0 END), 6) AS bad_fraction, avg(CASE WHEN max_corr < 0.3e0 THEN 1e0 WHEN max_corr IS NOT NULL THEN 0e0 END) > 0.2e0 AS is_bad FROM cc GROUP BY 1, 2""", "samples"))
def _(t):
    return op.bad_by_correlation(consistency(t), 0.3, 0.2).withColumn("bad_fraction", r6("bad_fraction"))


@query("bad_by_dropout", with_views(CW + """
SELECT recording_id, ch_name, round(avg(CASE WHEN dropout THEN 1e0 ELSE 0e0 END), 6) AS bad_fraction, avg(CASE WHEN dropout THEN 1e0 ELSE 0e0 END) > 0.01e0 AS is_bad FROM cc GROUP BY 1, 2""", "samples"))
def _(t):
    return op.bad_by_dropout(consistency(t)).withColumn("bad_fraction", r6("bad_fraction"))


@query("bad_by_snr", with_views(HF + CW.replace("md AS", "wm AS").replace("JOIN md USING", "JOIN wm USING") + """
SELECT recording_id, ch_name FROM hf WHERE is_bad INTERSECT SELECT recording_id, ch_name FROM cc GROUP BY 1, 2 HAVING avg(CASE WHEN max_corr < 0.45e0 THEN 1e0 WHEN max_corr IS NOT NULL THEN 0e0 END) > 0.1e0""", "samples"))
def _(t):
    return op.bad_by_snr(hf(t), op.bad_by_correlation(consistency(t), 0.45, 0.1))


@query("bad_by_ransac", with_views(f""", n0 AS (SELECT recording_id, ch_name, max(t) + 1 AS n FROM samples GROUP BY 1, 2),
wn AS (SELECT s.dataset, s.recording_id, ch_name, t // {WIN} AS win, t, value FROM samples s JOIN n0 USING (recording_id, ch_name) WHERE t // {WIN} < n // {WIN})""" + """,
ch AS (SELECT DISTINCT dataset, ch_name FROM samples),
ot AS (SELECT a.recording_id, a.win, a.ch_name, a.t, a.value AS own, l.ch_name AS left_out, avg(b.value) AS est, count(b.value) AS m
  FROM wn a JOIN ch l ON l.dataset = a.dataset AND l.ch_name <> a.ch_name
  JOIN wn b ON b.recording_id = a.recording_id AND b.t = a.t AND b.ch_name <> a.ch_name AND b.ch_name <> l.ch_name GROUP BY ALL),
nc AS (SELECT dataset, count(*) - 2 AS predictors FROM ch GROUP BY 1),
pr AS (SELECT recording_id, win, ch_name, t, any_value(own) AS own, quantile_cont(est, 0.5) AS est FROM ot
  JOIN (SELECT DISTINCT dataset, recording_id FROM samples) USING (recording_id) JOIN nc USING (dataset) WHERE 2 * m >= predictors GROUP BY 1, 2, 3, 4),
rc AS (SELECT recording_id, win, ch_name, corr(own, est) AS c FROM pr GROUP BY 1, 2, 3)
SELECT recording_id, ch_name, round(avg(CASE WHEN c < 0.2e0 THEN 1e0 ELSE 0e0 END), 6) AS bad_fraction, round(avg(c), 6) + 0e0 AS mean_corr,
  avg(CASE WHEN c < 0.2e0 THEN 1e0 ELSE 0e0 END) > 0.4e0 AS is_bad FROM rc GROUP BY 1, 2""", "samples"))
def _(t):
    pool = t.samples().groupBy("dataset").agg(F.array_sort(F.collect_set("ch_name")).alias("pool"))
    # every subset leaves one other channel out and averages the rest
    pairs = pool.select("dataset", "pool", F.explode("pool").alias("ch_name")).select("dataset", "ch_name", F.explode(F.array_remove("pool", F.col("ch_name"))).alias("left_out"), "pool")
    rest = F.array_remove(F.array_remove("pool", F.col("ch_name")), F.col("left_out"))
    weights = pairs.select("dataset", F.col("left_out").alias("subset"), "ch_name", F.explode(rest).alias("predictor"), (1 / F.size(rest)).alias("weight"))
    return op.bad_by_ransac(t.samples(), weights, WIN, 0.2, array="dataset").withColumns({"bad_fraction": r6("bad_fraction"), "mean_corr": r6("mean_corr")})


@query("interpolation_weights", with_views(""", dir AS (SELECT label AS arr, vec_id AS ch_name, e[1] / r AS x, e[2] / r AS y, e[3] / r AS z FROM (
  SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS e, sqrt(CAST(embedding[1] AS DOUBLE) ** 2 + CAST(embedding[2] AS DOUBLE) ** 2 + CAST(embedding[3] AS DOUBLE) ** 2) AS r FROM embeddings)),
dr AS (SELECT d.arr, s AS subset, d.ch_name, row_number() OVER (PARTITION BY d.arr, s ORDER BY md5(d.arr || ':' || s || ':' || d.ch_name || ':0'), d.ch_name) AS r FROM dir d, range(0, 3) u(s)),
pr AS (SELECT p.arr, p.subset, p.ch_name AS p, q.ch_name AS q FROM dr p JOIN dr q ON p.arr = q.arr AND p.subset = q.subset AND p.r = 1 AND q.r = 2),
cs AS (SELECT pr.*, d.ch_name, least(d.x * a.x + d.y * a.y + d.z * a.z, 1e0) AS ca, least(d.x * b.x + d.y * b.y + d.z * b.z, 1e0) AS cb, a.x * b.x + a.y * b.y + a.z * b.z AS cc
  FROM pr JOIN dir a ON a.arr = pr.arr AND a.ch_name = pr.p JOIN dir b ON b.arr = pr.arr AND b.ch_name = pr.q JOIN dir d ON d.arr = pr.arr),
lg AS (SELECT arr, subset, ch_name, p, q, u.k, u.c, 1 AS n, 1e0 AS before, u.c AS now, 3e0 / 16 * u.c AS total FROM cs, LATERAL (SELECT unnest([0, 1, 2, 3]) AS k, unnest([ca, cb, cc, 1e0]) AS c) u
  UNION ALL SELECT arr, subset, ch_name, p, q, k, c, n + 1, now, ((2 * n + 1) * c * now - n * before) / (n + 1),
    total + (2 * n + 3) / pow((n + 1) * (n + 2)::DOUBLE, 4) * ((2 * n + 1) * c * now - n * before) / (n + 1) FROM lg WHERE n < 50),
g AS (SELECT arr, subset, ch_name, p, q, max(total) FILTER (k = 0) / (4 * pi()) AS ga, max(total) FILTER (k = 1) / (4 * pi()) AS gb, max(total) FILTER (k = 2) / (4 * pi()) AS gc,
  max(total) FILTER (k = 3) / (4 * pi()) AS g0 FROM lg WHERE n = 50 GROUP BY 1, 2, 3, 4, 5),
w AS (SELECT *, 0.5e0 + (ga - gb) / (2 * (g0 + 1e-5 - gc)) AS wp FROM g)
SELECT arr AS "array", CAST(subset AS INTEGER) AS subset, ch_name, p AS predictor, round(wp, 6) + 0e0 AS weight FROM w UNION ALL SELECT arr, CAST(subset AS INTEGER), ch_name, q, round(1 - wp, 6) + 0e0 FROM w""",
                                                 "points").replace("WITH ", "WITH RECURSIVE ", 1))
def _(t):
    at = F.col("embedding")
    places = t.table("embeddings").select(F.col("label").alias("array"), F.col("vec_id").alias("ch_name"), *[at[i].cast("double").alias(c) for i, c in enumerate("xyz")])
    return op.interpolation_weights(places, op.random_subsets(places, 3, 2)).withColumn("weight", r6("weight"))


@query("bad_by_psd", with_views(""",
n0 AS (SELECT recording_id, ch_name, max(t) + 1 AS n FROM samples GROUP BY 1, 2),
w0 AS (SELECT recording_id, ch_name, unnest(range(0, (n - 32) // 16 + 1)) AS win FROM n0 WHERE n >= 32),
w1 AS (SELECT w0.recording_id, w0.ch_name, win, t - win * 16 AS i, value - avg(value) OVER (PARTITION BY w0.recording_id, w0.ch_name, win) AS v
  FROM w0 JOIN samples s ON s.recording_id = w0.recording_id AND s.ch_name = w0.ch_name AND t >= win * 16 AND t < win * 16 + 32),
w2 AS (SELECT *, v * (0.5e0 - 0.5e0 * cos(2 * pi() * i / 32)) AS x FROM w1),
p AS (SELECT recording_id, ch_name, win, k, (pow(sum(x * cos(2 * pi() * ((k * i) % 32) / 32)), 2) + pow(sum(x * sin(2 * pi() * ((k * i) % 32) / 32)), 2)) / (250e0 * 12e0)
  * CASE WHEN k BETWEEN 1 AND 15 THEN 2 ELSE 1 END AS power FROM w2, range(0, 17) r(k) GROUP BY 1, 2, 3, 4),
c AS (SELECT recording_id, ch_name, avg(power) AS mean_power FROM p GROUP BY 1, 2),
l AS (SELECT *, avg(mean_power) OVER r + stddev_pop(mean_power) OVER r AS threshold FROM c WINDOW r AS (PARTITION BY recording_id))
SELECT recording_id, ch_name, round(mean_power, 6) AS mean_power, round(threshold, 6) AS threshold, mean_power > threshold AS is_bad FROM l""", "samples"))
def _(t):
    out = op.bad_by_psd(op.welch_psd(t.samples(), SFREQ, 32), 1.0)
    return out.withColumns({"mean_power": r6("mean_power"), "threshold": r6("threshold")})


def esd_sql(name: str, source: str, keys: str, item: str, value: str, alpha: float, p_out: float = 0.1, side: int = 0, most: int = 600) -> str:
    """Twin of the iterative test as recursive expressions ending in `name` (keys, item, value, is_outlier), for groups of up to `most` values: two ends move
    over the sorted values of a group, one removal a row. Critical values stand in a table by the number of values left."""
    critical = kernels.CriticalValues(alpha / 2 if side == 0 else alpha)
    table = ", ".join(f"({m}, {critical[m]!r}::DOUBLE)" for m in range(3, most + 1))
    low = {0: "mean - z[lo] > z[hi] - mean", 1: "false", -1: "true"}[side]
    return f""", {name}_v AS ({source}), {name}_c AS (SELECT * FROM (VALUES {table}) v(m, c)),
{name}_g AS (SELECT {keys}, count(*) AS n_all, count(*) FILTER (isfinite({value})) AS n, avg({value}) FILTER (isfinite({value})) AS mean0,
  list({item} ORDER BY {value}, {item}) FILTER (isfinite({value})) AS items, list({value} ORDER BY {value}, {item}) FILTER (isfinite({value})) AS x FROM {name}_v GROUP BY {keys}),
{name}_z AS (SELECT *, least(ceil(n_all * {p_out}e0), n - 2) AS k, [v - mean0 FOR v IN x] AS z FROM {name}_g),
{name}_r AS (
  SELECT {keys}, 0 AS j, CAST(1 AS BIGINT) AS lo, n AS hi, list_sum(z) AS total, list_sum([v * v FOR v IN z]) AS square, CAST(NULL AS BIGINT) AS removed, 0e0 AS stat FROM {name}_z WHERE k >= 1
  UNION ALL
  SELECT {keys}, j + 1, CASE WHEN low THEN lo + 1 ELSE lo END, CASE WHEN low THEN hi ELSE hi - 1 END, total - z[pos], square - z[pos] * z[pos], pos,
    CASE WHEN square / (n - j) > mean * mean THEN abs(z[pos] - mean) / sqrt(square / (n - j) - mean * mean) ELSE 0e0 END
  FROM (SELECT *, CASE WHEN low THEN lo ELSE hi END AS pos FROM (SELECT *, {low} AS low FROM (
    SELECT *, total / (n - j) AS mean FROM {name}_r JOIN {name}_z USING ({keys}) WHERE j < k)))),
{name}_m AS (SELECT {keys}, items[removed] AS {item}, true AS hit FROM {name}_r JOIN {name}_z USING ({keys}) JOIN {name}_c ON m = n - j + 1 WHERE j > 0 AND stat > c),
{name} AS (SELECT {keys}, {item}, {value}, coalesce(hit, false) AS is_outlier FROM {name}_v LEFT JOIN {name}_m USING ({keys}, {item})) """


def with_esd(body: str, *views: str) -> str:
    return with_views(body, *views).replace("WITH ", "WITH RECURSIVE ", 1)


def spans_sql(flags: str, lengths: str, length: int, shift: int = 0) -> str:
    """Intervals of runs of marked segments."""
    return f"""SELECT recording_id, ch_type, (greatest(a * {length} - 1, 0) + {shift}) / 250e0 AS onset, (least(b * {length} + {length}, n) - 1 - greatest(a * {length} - 1, 0)) / 250e0 AS duration
FROM (SELECT recording_id, ch_type, min(segment) AS a, max(segment) AS b FROM (SELECT recording_id, ch_type, segment,
  segment - row_number() OVER (PARTITION BY recording_id, ch_type ORDER BY segment) AS run FROM {flags} WHERE is_outlier) GROUP BY recording_id, ch_type, run) JOIN {lengths} USING (recording_id, ch_type)"""


@query("gesd", with_esd(esd_sql("ot", "SELECT device_type, category, recording_id, value FROM metrics", "device_type, category", "recording_id", "value", 0.05)
                        + "SELECT device_type, category, recording_id, round(value, 6) AS value, is_outlier FROM ot", "metrics"))
def _(t):
    m = t.metrics()
    return op.gesd(m, ["device_type", "category"], "recording_id", "value").withColumn("value", r6("value"))


@query("bad_channels_gesd", with_esd(esd_sql("ot", "SELECT recording_id, ch_type, ch_name, stddev_pop(value) AS metric FROM samples GROUP BY 1, 2, 3", "recording_id, ch_type",
                                             "ch_name", "metric", 0.2)
                                     + "SELECT recording_id, ch_type, ch_name, round(metric, 6) AS metric, is_outlier FROM ot", "samples"))
def _(t):
    return op.bad_channels_gesd(t.samples(), 0.2).withColumn("metric", r6("metric"))


SEGMENTS = "recording_id, ch_type"


@query("bad_segments_gesd", with_esd(""", ns AS (SELECT recording_id, ch_type, max(t) + 1 AS n FROM samples GROUP BY 1, 2),
df AS (SELECT recording_id, ch_type, ch_name, t - 1 AS t, value - prev AS value FROM (SELECT *, lag(value) OVER (PARTITION BY recording_id, ch_name ORDER BY t) AS prev FROM samples) WHERE prev IS NOT NULL),
nd AS (SELECT recording_id, ch_type, max(t) + 1 AS n FROM df GROUP BY 1, 2)"""
    + esd_sql("oa", "SELECT recording_id, ch_type, t // 10 AS segment, stddev_pop(value) AS metric FROM samples GROUP BY 1, 2, 3", SEGMENTS, "segment", "metric", 0.2)
    + esd_sql("ob", "SELECT recording_id, ch_type, t // 10 AS segment, CASE WHEN var_pop(value) > 0 THEN coalesce(kurtosis_pop(value), 0e0) ELSE 0e0 END AS metric FROM df GROUP BY 1, 2, 3", SEGMENTS, "segment", "metric", 0.2)
    + f"SELECT *, 'std' AS mode FROM ({spans_sql('oa', 'ns', 10)}) UNION ALL SELECT *, 'diff' FROM ({spans_sql('ob', 'nd', 10, 1)})", "samples"))
def _(t):
    samples = t.samples_once()
    a = op.bad_segments_gesd(samples, SFREQ, 10, alpha=0.2).withColumn("mode", F.lit("std"))
    b = op.bad_segments_gesd(samples, SFREQ, 10, "kurtosis", "diff", alpha=0.2).withColumn("mode", F.lit("diff"))
    return a.unionByName(b)


@query("bad_segments_channelwise", with_esd(
    esd_sql("oc", "SELECT recording_id, ch_type, ch_name, t // 10 AS segment, stddev_pop(value) AS metric FROM samples GROUP BY 1, 2, 3, 4", "recording_id, ch_type, ch_name", "segment", "metric", 0.2)
    + f""", ns AS (SELECT recording_id, ch_type, max(t) + 1 AS n FROM samples GROUP BY 1, 2),
vt AS (SELECT recording_id, ch_type, segment, bool_or(is_outlier) AS is_outlier FROM oc GROUP BY 1, 2, 3)
{spans_sql('vt', 'ns', 10)}""", "samples"))
def _(t):
    return op.bad_segments_channelwise(t.samples(), SFREQ, 10, threshold="any", alpha=0.2)


@query("bad_epochs_gesd", with_esd(EP + esd_sql("oe", """SELECT recording_id, ch_type, epoch, avg(m) AS metric FROM (SELECT recording_id, ch_type, epoch, ch_name, stddev_pop(value) AS m FROM ep
  GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3""", SEGMENTS, "epoch", "metric", 0.05) + "SELECT recording_id, ch_type, epoch, round(metric, 6) AS metric, is_outlier FROM oe", "triggers", "samples"))
def _(t):
    return op.bad_epochs_gesd(epochs(t)).withColumn("metric", r6("metric"))


@query("bad_channels_lof", with_views(""",
d AS (SELECT a.recording_id, a.ch_name AS ci, b.ch_name AS cj, sqrt(sum((a.value - b.value) * (a.value - b.value))) AS d FROM samples a JOIN samples b ON a.recording_id = b.recording_id AND a.t = b.t AND a.ch_name <> b.ch_name GROUP BY 1, 2, 3),
nr AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY recording_id, ci ORDER BY d, cj) <= 2),
kd AS (SELECT recording_id, ci AS cj, max(d) AS kd FROM nr GROUP BY 1, 2),
ld AS (SELECT recording_id, ci, 1 / (avg(greatest(d, kd)) + 1e-10) AS lrd FROM nr JOIN kd USING (recording_id, cj) GROUP BY 1, 2),
mn AS (SELECT nr.recording_id, nr.ci, avg(lrd) AS m FROM nr JOIN ld ON ld.recording_id = nr.recording_id AND ld.ci = nr.cj GROUP BY 1, 2)
SELECT recording_id, ci AS ch_name, round(m / lrd, 6) AS lof, m / lrd >= 1.1e0 AS is_bad FROM mn JOIN ld USING (recording_id, ci)""", "samples"))
def _(t):
    return op.bad_channels_lof(t.samples(), 2, 1.1).withColumn("lof", r6("lof"))


@query("channel_correlation_matrix", with_views("""
SELECT a.recording_id, a.ch_name AS ci, b.ch_name AS cj, CASE WHEN a.ch_name = b.ch_name THEN 0e0 ELSE round(corr(a.value, b.value), 6) + 0e0 END AS corr
FROM samples a JOIN samples b ON a.recording_id = b.recording_id AND a.t = b.t GROUP BY a.recording_id, a.ch_name, b.ch_name""", "samples"))
def _(t):
    return op.channel_correlation_matrix(t.samples()).withColumn("corr", r6("corr"))


AMP = """, nx AS (SELECT recording_id, ch_name, t, abs(lead(value) OVER (PARTITION BY recording_id, ch_name ORDER BY t) - value) AS step FROM samples),
fl AS (SELECT recording_id, ch_name, t, 'BAD_peak' AS description, step >= 100e0 AS hit FROM nx WHERE step IS NOT NULL
 UNION ALL SELECT recording_id, ch_name, t, 'BAD_flat', step <= 0.5e0 FROM nx WHERE step IS NOT NULL),
sh AS (SELECT recording_id, ch_name, description, avg(CASE WHEN hit THEN 1e0 ELSE 0e0 END) * 100 AS pct FROM fl GROUP BY 1, 2, 3) """


@query("annotate_amplitude", with_views(AMP + """,
mk AS (SELECT DISTINCT recording_id, description, t FROM fl JOIN sh USING (recording_id, ch_name, description) WHERE hit AND pct <= 4e0),
g AS (SELECT *, t - row_number() OVER (PARTITION BY recording_id, description ORDER BY t) AS k FROM mk)
SELECT recording_id, min(t) / 250e0 AS onset, count(*) / 250e0 AS duration, description FROM g GROUP BY recording_id, description, k""", "samples"))
def _(t):
    return op.annotate_amplitude(t.samples(), SFREQ, 100.0, 0.5, 4.0)[0]


@query("annotate_amplitude_channels", with_views(AMP + "SELECT recording_id, ch_name, description, round(pct, 6) AS percent FROM sh WHERE pct > 4e0", "samples"))
def _(t):
    return op.annotate_amplitude(t.samples(), SFREQ, 100.0, 0.5, 4.0)[1].withColumn("percent", r6("percent"))


MUSCLE = kernels.analytic_taps(60.0, 100.0, SFREQ, 33)


@query("muscle_zscore", with_views(fir_sql(MUSCLE[0], "fa") + fir_sql(MUSCLE[1], "fb") + """,
en AS (SELECT recording_id, ch_name, t, sqrt(fa.y * fa.y + fb.y * fb.y) AS e FROM fa JOIN fb USING (recording_id, ch_name, t)),
mo AS (SELECT recording_id, ch_name, avg(e) AS m, stddev_pop(e) AS s FROM en GROUP BY 1, 2),
sc AS (SELECT recording_id, 'all' AS ch_name, t, sum(CASE WHEN s > 0 THEN (e - m) / s ELSE 0e0 END) / sqrt(count(*)) AS value FROM en JOIN mo USING (recording_id, ch_name) GROUP BY 1, 3)"""
    + fir_sql(kernels.lowpass_taps(12.0, SFREQ, 15), "lp", "sc") + """,
hi AS (SELECT recording_id, t, y, lag(t) OVER (PARTITION BY recording_id ORDER BY t) AS prev FROM lp WHERE y > 0.7e0),
ru AS (SELECT *, count(*) FILTER (prev IS NULL OR t - prev - 1 > 2) OVER (PARTITION BY recording_id ORDER BY t) AS run FROM hi)
SELECT recording_id, min(t) / 250e0 AS onset, (max(t) + 1 - min(t)) / 250e0 AS duration, round(max(y), 6) AS peak, 'BAD_muscle' AS description FROM ru GROUP BY recording_id, run""", "samples"))
def _(t):
    out = op.muscle_zscore(t.samples(), SFREQ, (60.0, 100.0), 0.7, 0.01, taps=33, cutoff=12.0, smooth_taps=15)
    return out.withColumn("peak", r6("peak"))


@query("merge_detectors", with_views("""
, a AS (SELECT DISTINCT recording_id, ch_name FROM samples WHERE value > 190e0), b AS (SELECT recording_id, ch_name FROM samples GROUP BY 1, 2 HAVING stddev_pop(value) > 22e0),
m AS (SELECT recording_id, ch_name FROM samples GROUP BY 1, 2 HAVING avg(value) > 21e0), e AS (SELECT * FROM a UNION SELECT * FROM b UNION SELECT * FROM m)
SELECT recording_id, ch_name, CASE WHEN pa AND pb THEN 'peak;spread' WHEN pa THEN 'peak' WHEN pb THEN 'spread' ELSE 'Manual or pre-existing' END AS sources FROM (
 SELECT recording_id, ch_name, (recording_id, ch_name) IN (SELECT (recording_id, ch_name) FROM a) AS pa, (recording_id, ch_name) IN (SELECT (recording_id, ch_name) FROM b) AS pb FROM e)""", "samples"))
def _(t):
    s = t.samples()
    per = s.groupBy("recording_id", "ch_name").agg(F.stddev_pop("value").alias("sd"), F.avg("value").alias("m"))
    out = op.merge_detectors([("peak", s.where("value > 190")), ("spread", per.where("sd > 22"))], per.where("m > 21"))
    return out.withColumn("sources", F.array_join("sources", ";"))


@query("epoch_zscore_outliers", with_views(EP + """,
pe AS (SELECT recording_id, epoch, ch_name, max(value) - min(value) AS ptp, avg(value) AS m, var_pop(value) AS v FROM ep GROUP BY 1, 2, 3),
ov AS (SELECT recording_id, ch_name, avg(value) AS o FROM ep GROUP BY 1, 2),
o1 AS (SELECT recording_id, epoch, avg(ptp) AS amplitude, avg(abs(m - o)) AS deviation, avg(v) AS variance FROM pe JOIN ov USING (recording_id, ch_name) GROUP BY 1, 2),
lg2 AS (UNPIVOT o1 ON amplitude, deviation, variance INTO NAME metric VALUE value),
z AS (SELECT *, CASE WHEN stddev_pop(value) OVER w > 0 THEN (value - avg(value) OVER w) / stddev_pop(value) OVER w ELSE 0e0 END AS z FROM lg2 WINDOW w AS (PARTITION BY recording_id, metric))
SELECT recording_id, epoch, metric, round(value + 1e-9, 6) AS value, round(z, 6) + 0e0 AS z, abs(z) > 2e0 AS is_outlier FROM z""", "triggers", "samples"))
def _(t):
    return op.epoch_zscore_outliers(epochs(t), 2.0).withColumns({"value": r6_off_ties("value"), "z": r6("z")})


ZED = """z AS (SELECT *, CASE WHEN stddev_pop(value) OVER w > 0 THEN (value - avg(value) OVER w) / stddev_pop(value) OVER w ELSE 0e0 END AS z FROM lg2 WINDOW w AS (PARTITION BY {keys}, metric)) """
LINE = "(pow(sum(value * cos(k * 2 * pi() * 50 / 250)), 2) + pow(sum(value * sin(k * 2 * pi() * 50 / 250)), 2)) / (count(*) * count(*))"


@query("channel_zscore_outliers", with_views(EP + f""",
ln AS (SELECT recording_id, ch_name, epoch, CASE WHEN var_pop(value) > 0 THEN {LINE} / var_pop(value) ELSE 0e0 END AS line FROM ep GROUP BY 1, 2, 3),
l2 AS (SELECT recording_id, ch_name, avg(line) AS line_noise FROM ln GROUP BY 1, 2),
b AS (SELECT recording_id, ch_name, var_pop(value) AS variance, kurtosis_pop(value) AS kurtosis FROM ep GROUP BY 1, 2),
pc AS (SELECT x.recording_id, x.ch_name, y.ch_name AS other, abs(corr(x.value, y.value)) AS c FROM ep x JOIN ep y ON x.recording_id = y.recording_id AND x.epoch = y.epoch AND x.k = y.k AND x.ch_name <> y.ch_name GROUP BY 1, 2, 3),
co AS (SELECT recording_id, ch_name, avg(c) AS correlation FROM pc GROUP BY 1, 2),
one AS (SELECT recording_id, ch_name, variance, correlation, kurtosis, line_noise FROM b JOIN l2 USING (recording_id, ch_name) JOIN co USING (recording_id, ch_name)),
lg2 AS (UNPIVOT one ON variance, correlation, kurtosis, line_noise INTO NAME metric VALUE value), """ + ZED.format(keys="recording_id") + """
SELECT recording_id, ch_name, metric, round(value, 6) + 0e0 AS value, round(z, 6) + 0e0 AS z, abs(z) > 1.5e0 AS is_outlier FROM z""", "triggers", "samples"))
def _(t):
    return op.channel_zscore_outliers(epochs(t), SFREQ, 4, 8, [50.0], 1.5).withColumns({"value": r6("value"), "z": r6("z")})


@query("channel_epoch_zscore_outliers", with_views(EP + f""",
gr AS (SELECT *, abs(value - lag(value) OVER (PARTITION BY recording_id, epoch, ch_name ORDER BY k)) AS g FROM ep),
pe AS (SELECT recording_id, epoch, ch_name, var_pop(value) AS variance, avg(value) AS m, max(value) - min(value) AS amplitude, quantile_cont(g, 0.5) AS median_gradient,
  CASE WHEN var_pop(value) > 0 THEN {LINE} / var_pop(value) ELSE 0e0 END AS line_noise FROM gr GROUP BY 1, 2, 3),
ov AS (SELECT recording_id, ch_name, avg(value) AS o FROM ep GROUP BY 1, 2),
one AS (SELECT recording_id, epoch, ch_name, variance, abs(m - o) AS deviation, amplitude, median_gradient, line_noise FROM pe JOIN ov USING (recording_id, ch_name)),
lg2 AS (FROM one UNPIVOT INCLUDE NULLS (value FOR metric IN (variance, deviation, amplitude, median_gradient, line_noise))), """ + ZED.format(keys="recording_id, epoch") + """
SELECT recording_id, epoch, ch_name, metric, round(value + 1e-9, 6) AS value, round(z + 1e-9, 6) AS z, abs(z) > 1.5e0 AS is_outlier FROM z""", "triggers", "samples"))
def _(t):
    return op.channel_epoch_zscore_outliers(epochs(t), SFREQ, [50.0], 1.5).withColumns({"value": r6_off_ties("value"), "z": r6_off_ties("z")})

"""Signal metrics per channel and recording, on the `samples` view (10 samples per second)."""

from pyspark.sql import functions as F

from ..functions.expr import r6, r6_off_ties
from ..operators import signal as op
from ..sources.bindings import with_views
from . import query

SFREQ = 10.0
DIFF = ("d AS (SELECT *, abs(value - lag(value) OVER (PARTITION BY recording_id, ch_name ORDER BY t)) AS d FROM samples) ")
COUNTED = "n AS (SELECT *, max(t) OVER (PARTITION BY recording_id, ch_name) + 1 AS n_times FROM samples) "


def views(cte: str, body: str, *names: str) -> str:
    return with_views(", " + cte + body, *names)


@query("channel_max_abs_diff", views(DIFF, """
SELECT recording_id, ch_type, ch_name, round(max(d), 6) AS max_abs_diff FROM d GROUP BY ALL""", "samples"))
def _(t):
    return op.channel_max_abs_diff(t.samples()).withColumn("max_abs_diff", r6("max_abs_diff"))


@query("channel_ptp", with_views("""
SELECT recording_id, ch_type, ch_name, round(max(value) - min(value), 6) AS ptp FROM samples GROUP BY ALL""", "samples"))
def _(t):
    return op.channel_ptp(t.samples()).withColumn("ptp", r6("ptp"))


STATS_SQL = """
SELECT recording_id, 'max_abs_diff.' || ch_type || '.' || stat AS metric, round(value, 6) AS value FROM (
  UNPIVOT (SELECT recording_id, ch_type, avg(m) AS mean, stddev_pop(m) AS std, min(m) AS min, max(m) AS max,
    avg(abs(m)) AS abs_mean, quantile_cont(abs(m), 0.95) AS abs_q95, max(abs(m)) AS abs_max,
    quantile_cont(m, 0.05) AS q05, quantile_cont(m, 0.25) AS q25, quantile_cont(m, 0.5) AS median,
    quantile_cont(m, 0.75) AS q75, quantile_cont(m, 0.95) AS q95,
    quantile_cont(m, 0.75) - quantile_cont(m, 0.25) AS iqr
    FROM m GROUP BY recording_id, ch_type)
  ON COLUMNS(* EXCLUDE (recording_id, ch_type)) INTO NAME stat VALUE value)"""


@query("summarize_vector", views(
    DIFF + ", m AS (SELECT recording_id, ch_type, ch_name, max(d) AS m FROM d GROUP BY ALL) ", STATS_SQL, "samples"))
def _(t):
    d = op.channel_max_abs_diff(t.samples())
    return op.summarize_vector(d, ["recording_id", "ch_type"], "max_abs_diff", "max_abs_diff").select(
        "recording_id", "metric", r6("value").alias("value"))


@query("uniform_subsample", views(COUNTED, """
SELECT recording_id, ch_name, t, value FROM n
WHERE n_times <= 40 OR list_contains(list_transform(range(0, 40),
  lambda k: CASE WHEN k = 39 THEN n_times - 1 ELSE CAST(floor(k * ((n_times - 1) / 39e0)) AS BIGINT) END), t)""", "samples"))
def _(t):
    return op.uniform_subsample(t.samples(), 40).select("recording_id", "ch_name", "t", "value")


SPECTRUM = COUNTED + """,
f AS (SELECT recording_id, ch_type, ch_name, n_times, k, CASE WHEN k = 0 THEN 0e0 ELSE sqrt(pow(sum(value * cos(2 * pi() * ((k * t) % n_times) / n_times)), 2)
  + pow(sum(value * sin(2 * pi() * ((k * t) % n_times) / n_times)), 2)) / n_times END AS y FROM (SELECT *, unnest(range(0, n_times // 2)) AS k FROM n) GROUP BY 1, 2, 3, 4, 5),
m AS (SELECT *, avg(y) OVER w AS m, stddev_pop(y) OVER w AS s FROM f WINDOW w AS (PARTITION BY recording_id, ch_name)),
c AS (SELECT recording_id, ch_type, ch_name, avg(pow((y - m) / s, 3)) AS sk, avg(pow((y - m) / s, 4)) AS ku FROM m GROUP BY 1, 2, 3) """


@query("spectral_shape", views(SPECTRUM, """
SELECT recording_id, ch_type, round(avg(sk), 6) AS skewness, round(avg(ku), 6) AS kurtosis FROM c GROUP BY 1, 2""", "samples"))
def _(t):
    return op.spectral_shape(t.samples()).select(
        "recording_id", "ch_type", r6("skewness_amplitude").alias("skewness"), r6("kurtosis_amplitude").alias("kurtosis"))


RECS = "rec AS (SELECT recording_id, max(t) + 1 AS n_times, 10e0 AS sfreq FROM samples GROUP BY 1) "


def recordings(t):
    return t.samples().groupBy("recording_id").agg((F.max("t") + 1).alias("n_times"), F.lit(SFREQ).alias("sfreq"))


@query("segment_bounds", views(RECS, """
SELECT recording_id, CAST(i AS INTEGER) AS segment, CAST(round_even(i * 3e0 * sfreq, 0) AS BIGINT) AS start,
  least(CAST(round_even(least((i + 1) * 3e0, n_times / sfreq) * sfreq, 0) AS BIGINT) + 1, n_times) AS stop
FROM (SELECT *, unnest(range(0, CAST(ceil(n_times / sfreq / 3e0) AS BIGINT))) AS i FROM rec)
WHERE n_times / sfreq > 3e0
UNION ALL SELECT recording_id, 0, 0, n_times FROM rec WHERE n_times / sfreq <= 3e0""", "samples"))
def _(t):
    return op.segment_bounds(recordings(t), 3.0)


def dfa_sql(length: int, longest: int = 1000) -> str:
    """Common table expressions that end in `dfa (recording_id, ch_type, dfa)`: window sizes grow by a fifth from 4 to a tenth of a segment."""
    sizes, last = ["(4, 0)"], 4
    while last < longest:
        need = int(last * 1.2)
        last = max(need, last + 1)
        sizes.append(f"({last}, {need})")
    where = f"CASE WHEN t % {length} = 0 AND t > 0 THEN [t // {length} - 1, t // {length}] ELSE [t // {length}] END"
    return f"""d0 AS (SELECT recording_id, ch_type, ch_name, t, unnest({where}) AS segment, coalesce(value, 0) AS x FROM samples),
d1 AS (SELECT *, t - segment * {length} AS i, x - avg(x) OVER g AS d, count(*) OVER g AS n FROM d0 WINDOW g AS (PARTITION BY recording_id, ch_name, segment)),
d2 AS (SELECT *, sum(d) OVER (PARTITION BY recording_id, ch_name, segment ORDER BY i) AS w FROM d1 WHERE n >= 12),
d3 AS (SELECT recording_id, ch_type, ch_name, segment, z, sqrt(greatest(0e0, regr_syy(w, i) - regr_slope(w, i) * regr_sxy(w, i)) / z) AS f
  FROM d2 JOIN (VALUES {', '.join(sizes)}) v(z, need) ON need <= floor(0.1e0 * n) WHERE i // z < n // z GROUP BY recording_id, ch_type, ch_name, segment, z, i // z),
d4 AS (SELECT recording_id, ch_type, ch_name, segment, z, avg(f) AS f FROM d3 GROUP BY ALL),
d5 AS (SELECT recording_id, ch_type, ch_name, segment, regr_slope(ln(f), ln(z)) AS a FROM d4 WHERE f > 0 GROUP BY ALL HAVING count(*) >= 2),
d6 AS (SELECT recording_id, ch_type, ch_name, avg(a) AS a FROM d5 GROUP BY ALL),
d7 AS (SELECT DISTINCT recording_id, ch_type FROM samples),
dfa AS (SELECT recording_id, ch_type, avg(a) AS dfa FROM d7 LEFT JOIN d6 USING (recording_id, ch_type) GROUP BY ALL) """


@query("segmented_dfa", views(dfa_sql(50), "SELECT recording_id, ch_type, round(dfa, 6) AS dfa FROM dfa", "samples"))
def _(t):
    return op.segmented_dfa(t.samples(), 50).withColumn("dfa", r6("dfa"))


@query("flat_ratio", views(DIFF, """
SELECT recording_id, ch_type, ch_name, round(count(*) FILTER (d <= 5e0) / count(*), 6) AS flat_ratio
FROM d GROUP BY ALL""", "samples"))
def _(t):
    return op.flat_ratio(t.samples(), 5.0).withColumn("flat_ratio", r6("flat_ratio"))


BINNED = (COUNTED + ", b AS (SELECT *, ((t + 1) * least(32, n_times) - 1) // n_times AS bin FROM n), "
          "env AS (SELECT recording_id, ch_type, ch_name, bin, min(value) AS vmin, max(value) AS vmax, "
          "quantile_cont(value, 0.5) AS vmedian, 0.5e0 * (min(t) + max(t)) / 10e0 AS time FROM b GROUP BY ALL) ")


@query("envelope_bins", views(BINNED, """
SELECT recording_id, ch_type, ch_name, bin, round(vmin, 6) AS vmin, round(vmax, 6) AS vmax,
  round(vmedian, 6) AS vmedian, round(time, 6) AS time FROM env""", "samples"))
def _(t):
    e = op.envelope_bins(t.samples(), SFREQ, 32)
    return e.select("recording_id", "ch_type", "ch_name", "bin", *[r6(c).alias(c) for c in ("vmin", "vmax", "vmedian", "time")])


SCORED = BINNED + """, st AS (SELECT * FROM n),
c AS (SELECT recording_id, ch_type, ch_name, quantile_cont(value, 0.5) AS center FROM st GROUP BY ALL),
s AS (SELECT recording_id, ch_type, ch_name, any_value(center) AS center,
      1.4826e0 * quantile_cont(abs(value - center), 0.5) AS scale
      FROM st JOIN c USING (recording_id, ch_type, ch_name) GROUP BY ALL),
g AS (SELECT recording_id, coalesce(quantile_cont(scale, 0.5) FILTER (scale > 2.2250738585072014e-308), 1e0) AS gs FROM s GROUP BY 1),
ty AS (SELECT recording_id, ch_type, quantile_cont(scale, 0.5) FILTER (scale > 2.2250738585072014e-308) AS ts FROM s GROUP BY 1, 2),
sc AS (SELECT recording_id, ch_name, center, coalesce(ts, gs) AS shared,
       CASE WHEN scale > 2.2250738585072014e-308 THEN scale ELSE coalesce(ts, gs) END AS own
       FROM s JOIN g USING (recording_id) JOIN ty USING (recording_id, ch_type)),
p AS (SELECT env.*, greatest(abs(vmin - center), abs(vmax - center)) AS ex, shared, own FROM env JOIN sc USING (recording_id, ch_name)),
peak AS (SELECT recording_id, ch_type, ch_name, bin, time, greatest(ex / own, ex / shared) AS peak_score FROM p) """


@query("robust_peak_score", views(SCORED, """
SELECT recording_id, ch_type, ch_name, bin, round(peak_score, 6) AS peak_score FROM peak""", "samples"))
def _(t):
    return op.robust_peak_score(t.samples_once(), SFREQ, 32).select(
        "recording_id", "ch_type", "ch_name", "bin", r6("peak_score").alias("peak_score"))


# annotation clock in hours lines up with the short test recordings
HOURLY = "a AS (SELECT recording_id, onset / 3600 AS onset, duration / 3600 AS duration FROM annotations WHERE contains(lower(description), 'bad')) "


def hourly_bads(t):
    return t.annotations().where(F.lower("description").contains("bad")).select(
        "recording_id", (F.col("onset") / 3600).alias("onset"), (F.col("duration") / 3600).alias("duration"))


@query("affected_fraction", views(SCORED + ", " + HOURLY, """,
pb AS (SELECT recording_id, bin, avg(CASE WHEN peak_score >= 3e0 THEN 1e0 ELSE 0e0 END) * 100 AS pct,
       max(peak_score) AS mx, avg(time) AS time FROM peak GROUP BY 1, 2),
dt AS (SELECT *, time - lag(time) OVER (PARTITION BY recording_id ORDER BY bin) AS step FROM pb),
lim AS (SELECT recording_id, min(time) AS f, max(time) AS l, coalesce(quantile_cont(step, 0.5) * 0.5e0, 0e0) AS pad FROM dt GROUP BY 1),
sp AS (SELECT recording_id, greatest(onset, f) AS s, least(onset + greatest(duration, 0e0), l) AS e, pad FROM a JOIN lim USING (recording_id))
SELECT recording_id, bin, round(pct, 6) AS affected_pct, round(mx, 6) AS max_score,
  EXISTS (SELECT 1 FROM sp WHERE sp.recording_id = pb.recording_id AND sp.e > sp.s AND pb.time >= sp.s - sp.pad AND pb.time <= sp.e + sp.pad) AS is_bad
FROM pb""", "samples", "annotations"))
def _(t):
    out = op.affected_fraction(op.robust_peak_score(t.samples_once(), SFREQ, 32), hourly_bads(t), 3.0)
    return out.select("recording_id", "bin", r6("affected_pct").alias("affected_pct"), r6("max_score").alias("max_score"), "is_bad")


@query("sum_square_trace", views(HOURLY, """,
pw AS (SELECT recording_id, ch_type, t, sum(value * value) AS ss FROM samples GROUP BY ALL),
fl AS (SELECT *, EXISTS (SELECT 1 FROM a WHERE a.recording_id = pw.recording_id AND t / 5e0 >= onset AND t / 5e0 < onset + duration) AS bad FROM pw),
gd AS (SELECT recording_id, ch_type, avg(ss) FILTER (NOT bad) AS good FROM fl GROUP BY 1, 2),
f2 AS (SELECT recording_id, ch_type, t, CASE WHEN bad THEN good ELSE ss END AS ss FROM fl JOIN gd USING (recording_id, ch_type))
SELECT recording_id, ch_type, t, round(ss, 6) AS ss,
  round(avg(ss) OVER (PARTITION BY recording_id, ch_type ORDER BY t ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) + 1e-9, 6) AS trace FROM f2""",
       "samples", "annotations"))
def _(t):
    return op.sum_square_trace(t.samples(), hourly_bads(t), 5.0).select(
        "recording_id", "ch_type", "t", r6("ss").alias("ss"), r6_off_ties("trace").alias("trace"))


@query("channel_std_histogram", with_views("""
, st AS (SELECT recording_id, ch_type, ch_name, stddev_pop(value) AS std FROM samples GROUP BY ALL),
w AS (SELECT *, min(std) OVER p AS lo0, max(std) OVER p AS hi0 FROM st WINDOW p AS (PARTITION BY recording_id, ch_type)),
x AS (SELECT *, CASE WHEN hi0 > lo0 THEN lo0 ELSE lo0 - 0.5e0 END AS lo, CASE WHEN hi0 > lo0 THEN hi0 - lo0 ELSE 1e0 END AS width FROM w),
y AS (SELECT *, CAST(least(floor((std - lo) / width * 24), 23) AS BIGINT) AS bin FROM x)
SELECT recording_id, ch_type, bin, count(*) AS n, round(any_value(lo + bin * width / 24), 6) AS left_edge FROM y GROUP BY 1, 2, 3""", "samples"))
def _(t):
    return op.channel_std_histogram(t.samples()).withColumn("left_edge", r6("left_edge"))

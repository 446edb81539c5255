"""Interval algebra on annotations (seconds, one sample per second) and on hourly model windows."""

from pyspark.sql import functions as F

from ..functions.expr import r6
from ..operators import intervals as op
from ..sources.bindings import with_views
from . import query
from .signal import SFREQ

DAY = 86_400.0
N_TIMES = 2_592_000  # thirty days at one sample per second
WINDOWS = ", w AS (SELECT recording_id, win, avg(prob) AS prob FROM probs GROUP BY 1, 2) "


def windows(t):
    return t.probs().groupBy("recording_id", "win").agg(F.avg("prob").alias("prob"))


def recordings(t):
    return t.table("events").select((F.col("user_id") % 20).alias("recording_id")).distinct().select(
        "recording_id", F.lit(N_TIMES).cast("bigint").alias("n_times"), F.lit(1e0).alias("sfreq"))


def sample_spans(t):
    return t.annotations().select("recording_id", F.floor("onset").cast("bigint").alias("start"),
                                  F.floor(F.col("onset") + F.col("duration")).cast("bigint").alias("stop"))


@query("runs_to_intervals", with_views(WINDOWS + """,
f AS (SELECT *, win - row_number() OVER (PARTITION BY recording_id ORDER BY win) AS g FROM w WHERE prob >= 0.6e0)
SELECT recording_id, min(win) * 3600e0 AS onset, (max(win) + 1) * 3600e0 AS "end" FROM f GROUP BY recording_id, g""", "probs"))
def _(t):
    return op.runs_to_intervals(windows(t).withColumn("flag", F.col("prob") >= 0.6), ["recording_id"], 3600.0)


@query("hysteresis_intervals", with_views(WINDOWS + """,
f AS (SELECT *, win - row_number() OVER (PARTITION BY recording_id ORDER BY win) AS g FROM w WHERE prob >= 0.45e0),
r AS (SELECT recording_id, min(win) AS s, max(win) + 1 AS e, max(prob) AS m FROM f GROUP BY recording_id, g HAVING max(prob) >= 0.7e0),
n AS (SELECT *, CASE WHEN s - lag(e) OVER (PARTITION BY recording_id ORDER BY s) <= 3 THEN 0 ELSE 1 END AS o FROM r),
i AS (SELECT *, sum(o) OVER (PARTITION BY recording_id ORDER BY s) AS k FROM n),
q AS (SELECT recording_id, min(s) AS s, max(e) AS e, max(m) AS m FROM i GROUP BY recording_id, k)
SELECT recording_id, s * 3600e0 AS onset, e * 3600e0 AS "end", round(m, 6) AS max_prob FROM q
WHERE NOT ((e - s) * 3600e0 < 7200e0 AND m < 0.9e0)""", "probs"))
def _(t):
    out = op.hysteresis_intervals(windows(t), ["recording_id"], 0.7, 0.45, 3600.0, 10800.0, 7200.0, 0.9)
    return out.withColumn("max_prob", r6("max_prob"))


MERGED = """, sp AS (SELECT recording_id, CAST(floor(onset) AS BIGINT) AS start, least(CAST(floor(onset + duration) AS BIGINT), 2592000) AS stop FROM annotations),
n AS (SELECT *, max(stop) OVER (PARTITION BY recording_id ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM sp WHERE stop > start),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS k FROM n),
m AS (SELECT recording_id, min(start) AS start, max(stop) AS stop FROM i GROUP BY recording_id, k),
rec AS (SELECT DISTINCT user_id % 20 AS recording_id FROM events) """


@query("merge_intervals", with_views(MERGED + "SELECT recording_id, start, stop FROM m", "annotations"))
def _(t):
    return op.merge_intervals(sample_spans(t), recordings(t), ["recording_id"], DAY)


@query("bad_coverage", with_views(MERGED + """, c AS (SELECT recording_id, CAST(sum(stop - start) AS BIGINT) AS b FROM m GROUP BY 1)
SELECT recording_id, CAST(2592000 AS BIGINT) AS n_times, coalesce(b, 0) AS bad_samples, 2592000 - coalesce(b, 0) AS usable_samples,
  round(coalesce(b, 0) / 2592000, 6) AS bad_fraction FROM rec LEFT JOIN c USING (recording_id)""", "annotations"))
def _(t):
    return op.bad_coverage(sample_spans(t), recordings(t), DAY).withColumn("bad_fraction", r6("bad_fraction"))


@query("bad_segment_stats", with_views("""
SELECT r.recording_id, count(a.recording_id) AS n_segments, round(coalesce(sum(duration), 0e0), 6) AS bad_seconds,
  round(coalesce(sum(duration), 0e0) / 2592000e0, 6) AS bad_ratio
FROM (SELECT DISTINCT user_id % 20 AS recording_id FROM events) r LEFT JOIN annotations a ON a.recording_id = r.recording_id GROUP BY 1""", "annotations"))
def _(t):
    return op.bad_segment_stats(t.annotations(), recordings(t)).select(
        "recording_id", "n_segments", r6("bad_seconds").alias("bad_seconds"), r6("bad_ratio").alias("bad_ratio"))


@query("bad_time_by_modality", with_views(""",
sp AS (SELECT recording_id, description AS modality, CAST(greatest(ceil(onset), 0) AS BIGINT) AS s,
  CAST(least(floor(onset + duration), 2591999) AS BIGINT) + 1 AS e FROM annotations),
n AS (SELECT *, max(e) OVER (PARTITION BY recording_id, modality ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM sp WHERE e > s)
SELECT recording_id, modality, CAST(sum(greatest(e - greatest(s, coalesce(reach, s)), 0)) AS BIGINT) AS bad_samples,
  round(CAST(sum(greatest(e - greatest(s, coalesce(reach, s)), 0)) AS DOUBLE), 6) AS bad_seconds,
  round(sum(greatest(e - greatest(s, coalesce(reach, s)), 0)) * 100 / 2592000, 6) AS bad_percent FROM n GROUP BY 1, 2""", "annotations"))
def _(t):
    out = op.bad_time_by_modality(t.annotations().withColumnRenamed("description", "modality"), recordings(t))
    return out.select("recording_id", "modality", "bad_samples", r6("bad_seconds").alias("bad_seconds"),
                      r6("bad_percent").alias("bad_percent"))


@query("annotate_break", with_views(""",
n AS (SELECT *, max(onset + duration) OVER (PARTITION BY recording_id ORDER BY onset, onset + duration ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM annotations)
SELECT DISTINCT recording_id, round(reach, 6) AS onset, round(onset - reach, 6) AS duration, 'BAD_break' AS description
FROM n WHERE onset - reach >= 20000e0""", "annotations"))
def _(t):
    return op.annotate_break(t.annotations(), 20000.0).select(
        "recording_id", r6("onset").alias("onset"), r6("duration").alias("duration"), "description")


@query("annotate_break_padded", with_views(""",
r AS (SELECT DISTINCT recording_id, 0e0 AS s, 2592000e0 AS e FROM annotations),
x AS (SELECT recording_id, onset, onset + duration AS fin, 0 AS edge FROM annotations WHERE NOT starts_with(lower(description), 'bad')
  UNION ALL SELECT recording_id, s, s, -1 FROM r UNION ALL SELECT recording_id, e, e, 1 FROM r),
n AS (SELECT *, max(fin) OVER (PARTITION BY recording_id ORDER BY onset, fin, edge ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM x),
b AS (SELECT recording_id, reach + CASE WHEN reach > 0 THEN 500e0 ELSE 0e0 END AS st, onset - CASE WHEN edge = 1 THEN 0e0 ELSE 300e0 END AS en
  FROM n WHERE onset - reach >= 20000e0)
SELECT DISTINCT recording_id, round(st, 6) AS onset, round(en - st, 6) AS duration, 'BAD_break' AS description FROM b""", "annotations"))
def _(t):
    recs = t.annotations().select("recording_id", F.lit(0e0).alias("start"), F.lit(2592000e0).alias("stop")).distinct()
    return op.annotate_break(t.annotations(), 20000.0, lead_in=500.0, lead_out=300.0, ignore=("BAD", "EDGE"), recordings=recs).select(
        "recording_id", r6("onset").alias("onset"), r6("duration").alias("duration"), "description")


MASK_REC = """, rec AS (SELECT recording_id, count(DISTINCT ch_name) AS nc, 2592000 AS n_times FROM samples GROUP BY 1),
nb AS (SELECT *, least(2400, greatest(240, least(n_times, nc * 10))) AS n_bins FROM rec),
ch AS (SELECT recording_id, ch_name, max(value) > 190e0 AS is_bad FROM samples GROUP BY 1, 2),
sp AS (SELECT recording_id, CAST(round_even(onset, 0) AS BIGINT) AS s, least(CAST(round_even(onset + duration, 0) AS BIGINT), 2592000) AS e
  FROM annotations WHERE description = 'BAD_amp'),
mk AS (SELECT DISTINCT recording_id, unnest(range(least(CAST(floor(s / 2592000 * n_bins) AS BIGINT), n_bins - 1),
  greatest(least(CAST(floor(s / 2592000 * n_bins) AS BIGINT), n_bins - 1) + 1, least(CAST(ceil(e / 2592000 * n_bins) AS BIGINT), n_bins)))) AS bin
  FROM sp JOIN nb USING (recording_id) WHERE e > s),
gr AS (SELECT recording_id, ch_name, is_bad, unnest(range(0, n_bins)) AS bin FROM ch JOIN nb USING (recording_id)) """


def channels(t, limit=190.0):
    return t.samples().groupBy("recording_id", "ch_name").agg((F.max("value") > limit).alias("is_bad"))


@query("artifact_mask_bins", with_views(MASK_REC + """
SELECT recording_id, ch_name, gr.bin, CAST(CASE WHEN mk.bin IS NULL THEN 0 ELSE 1 END + CASE WHEN is_bad THEN 2 ELSE 0 END AS INTEGER) AS code
FROM gr LEFT JOIN mk USING (recording_id, bin)""", "samples", "annotations"))
def _(t):
    return op.artifact_mask_bins(channels(t), t.annotations().where("description = 'BAD_amp'"), recordings(t))


RECS = ", rec AS (SELECT recording_id, max(t) + 1 AS n_times FROM samples GROUP BY 1) "


def short_recordings(t):
    return t.samples().groupBy("recording_id").agg((F.max("t") + 1).alias("n_times")).withColumn("sfreq", F.lit(SFREQ))


@query("fixed_length_events", with_views(RECS + """
SELECT recording_id, CAST(i * 15 AS BIGINT) AS sample, 1 AS event_id FROM (
  SELECT recording_id, unnest(range(0, (n_times - 20) // 15 + 1)) AS i FROM rec WHERE n_times >= 20)""", "samples"))
def _(t):
    return op.fixed_length_events(short_recordings(t), 2.0, 0.5)


PLAN = RECS + """, st AS (SELECT recording_id, n_times, list_sort(list_distinct(list_concat(range(0, n_times - 20 + 1, 15), [n_times - 20]))) AS s FROM rec WHERE n_times >= 20),
pl AS (SELECT recording_id, n_times, unnest(s) AS start FROM st) """
THINNED = PLAN.replace("unnest(s)", """unnest(CASE WHEN len(s) > 5 THEN list_distinct(list_transform(range(0, 5), lambda i: s[CAST(round_even(i * ((len(s) - 1) / 4e0), 0) AS BIGINT) + 1])) ELSE s END)""")


@query("window_plan", with_views(PLAN + "SELECT recording_id, start FROM pl", "samples"))
def _(t):
    return op.window_plan(short_recordings(t), 20, 5).select("recording_id", "start")


@query("window_plan_thinned", with_views(THINNED + "SELECT recording_id, start FROM pl", "samples"))
def _(t):
    return op.window_plan(short_recordings(t), 20, 5, 5).select("recording_id", "start")


@query("window_vote_weights", with_views(PLAN + """,
ed AS (SELECT DISTINCT recording_id, unnest([start, start + 20]) AS edge FROM pl),
el AS (SELECT recording_id, edge AS l, lead(edge) OVER (PARTITION BY recording_id ORDER BY edge) AS r FROM ed),
cv AS (SELECT el.recording_id, l, r, count(*) AS k FROM el JOIN pl ON el.recording_id = pl.recording_id AND pl.start <= l AND r <= pl.start + 20 GROUP BY 1, 2, 3)
SELECT pl.recording_id, pl.start, round(sum((r - l) / k), 6) AS weight FROM pl JOIN cv ON cv.recording_id = pl.recording_id AND pl.start <= l AND r <= pl.start + 20 GROUP BY 1, 2""", "samples"))
def _(t):
    return op.window_vote_weights(op.window_plan(short_recordings(t), 20, 5), 20).withColumn("weight", r6("weight"))


@query("chunk_spans", with_views(RECS + """,
c AS (SELECT recording_id, n_times AS n, unnest(range(0, n_times, 12)) AS s FROM rec WHERE n_times > 30),
k AS (SELECT recording_id, n, s, least(s + 30, n) AS e FROM c WHERE s = 0 OR s - 12 + 30 < n)
SELECT recording_id, s AS start, e AS stop FROM k WHERE e - s >= 8
UNION SELECT recording_id, n_times - 30, n_times FROM rec WHERE n_times > 30
UNION SELECT recording_id, 0, n_times FROM rec WHERE n_times <= 30""", "samples"))
def _(t):
    return op.chunk_spans(short_recordings(t).withColumnRenamed("n_times", "n"), ["recording_id"], 30, 12, 8)


@query("reject_by_annotation", with_views("""
SELECT recording_id, source_id AS epoch FROM triggers tr WHERE NOT EXISTS (SELECT 1 FROM annotations a
  WHERE a.recording_id = tr.recording_id AND a.onset < tr.sample * 60 + 600 AND tr.sample * 60 - 600 < a.onset + a.duration AND a.description <> tr.event_id::VARCHAR
  AND a.description = 'BAD_amp')""", "triggers", "annotations"))
def _(t):
    epochs = t.triggers().select("recording_id", F.col("source_id").alias("epoch"),
                                 (F.col("sample") * 60 - 600).alias("start"), (F.col("sample") * 60 + 600).alias("stop"))
    return op.reject_by_annotation(epochs, t.annotations().where("description = 'BAD_amp'"), 3600.0).select("recording_id", "epoch")


@query("ica_input_checks", with_views(MERGED + """, c AS (SELECT recording_id, CAST(sum(stop - start) AS BIGINT) AS b FROM m GROUP BY 1),
ch AS (SELECT recording_id, ch_name, max(value) > 150e0 AS is_bad FROM samples GROUP BY 1, 2),
el AS (SELECT recording_id, count(*) FILTER (NOT is_bad) AS ne FROM ch GROUP BY 1),
rq AS (SELECT recording_id, ne, 2592000 - coalesce(b, 0) AS us,
  CASE recording_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '2' WHEN 2 THEN '0.95' WHEN 3 THEN '1' ELSE '400' END AS q
  FROM rec JOIN el USING (recording_id) LEFT JOIN c USING (recording_id))
SELECT recording_id, ne AS n_eligible, us AS usable_samples, CASE WHEN ne = 0 THEN 'NO_ELIGIBLE_ICA_CHANNELS'
  WHEN us = 0 THEN 'ICA_INPUT_ALL_BAD' WHEN q = '1' THEN 'INVALID_COMPONENT_REQUEST'
  WHEN q IN ('2', '400') AND q::BIGINT > least(ne, us) THEN 'REQUESTED_COMPONENTS_EXCEED_AVAILABLE_INPUT'
  WHEN (q IS NULL OR q = '0.95') AND us < 2 THEN 'REQUESTED_COMPONENTS_EXCEED_AVAILABLE_INPUT' ELSE 'passed' END AS code FROM rq""",
       "annotations", "samples"))
def _(t):
    part = F.col("recording_id") % 5
    ask = F.when(part == 1, "2").when(part == 2, "0.95").when(part == 3, "1").when(part == 4, "400")
    return op.ica_input_checks(recordings(t).withColumn("component_request", ask), channels(t, 150.0), sample_spans(t), DAY)

"""Normative scoring and the quality gate."""

from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.expr import r6
from ..operators import scoring as op
from ..operators import signal
from ..operators.transforms import preprocess
from ..session import cut_lineage, materialize
from ..sources.bindings import SQL, fir_sql, resample_sql, with_views
from . import query
from .signal import SPECTRUM, dfa_sql

REF = """, x AS (SELECT unnest([
    {'scope': 'device_category', 'device_type': device_type, 'category': category},
    {'scope': 'device', 'device_type': device_type, 'category': 'ALL'},
    {'scope': 'category', 'device_type': 'ALL', 'category': category},
    {'scope': 'global', 'device_type': 'ALL', 'category': 'ALL'}]) AS s, metric, value FROM metrics),
ref AS (SELECT s.scope AS scope, s.device_type AS device_type, s.category AS category, metric, count(value) AS n,
    quantile_cont(value, 0.05) AS q05, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.95) AS q95
    FROM x GROUP BY ALL) """
CAND = """, cd AS (SELECT m.*, r.scope AS reference_scope, r.n AS reference_n, q05, q50, q95,
    row_number() OVER (PARTITION BY m.recording_id, m.metric ORDER BY CASE WHEN r.n < 20 THEN 1 ELSE 0 END,
      list_position(['device_category', 'device', 'category', 'global'], r.scope)) AS rn
  FROM metrics m JOIN ref r ON m.metric = r.metric AND (r.device_type = m.device_type OR r.device_type = 'ALL')
    AND (r.category = m.category OR r.category = 'ALL')),
lk AS (SELECT * EXCLUDE (rn) FROM cd WHERE rn = 1) """


@query("build_reference_intervals", with_views(REF + """
SELECT scope, device_type, category, metric, n, round(q05, 6) AS q05, round(q50, 6) AS q50, round(q95, 6) AS q95 FROM ref""", "metrics"))
def _(t):
    return op.build_reference_intervals(t.metrics()).select(
        "scope", "device_type", "category", "metric", "n", *[r6(q).alias(q) for q in ("q05", "q50", "q95")])


def looked_up(t):
    return op.lookup_reference(t.metrics(), op.build_reference_intervals(t.metrics()))


@query("lookup_reference", with_views(REF + CAND + """
SELECT recording_id, metric, reference_scope, reference_n, round(q05, 6) AS q05, round(q50, 6) AS q50, round(q95, 6) AS q95 FROM lk""", "metrics"))
def _(t):
    return looked_up(t).select("recording_id", "metric", "reference_scope", "reference_n",
                               *[r6(q).alias(q) for q in ("q05", "q50", "q95")])


MODES = "CASE recording_id % 3 WHEN 0 THEN 'lower_is_better' WHEN 1 THEN 'higher_is_better' ELSE 'near_q50' END"


@query("component_score", with_views(REF + CAND + f""", m3 AS (SELECT *, {MODES} AS mode FROM lk)
SELECT recording_id, mode, round(CASE WHEN q95 <= q05 THEN NULL
  WHEN mode = 'lower_is_better' THEN 1e0 - least(1e0, greatest(0e0, (value - q05) / (q95 - q05)))
  WHEN mode = 'higher_is_better' THEN least(1e0, greatest(0e0, (value - q05) / (q95 - q05)))
  WHEN value <= q50 THEN 1e0 - least(1e0, greatest(0e0, (q50 - value) / (q50 - q05)))
  ELSE 1e0 - least(1e0, greatest(0e0, (value - q50) / (q95 - q50))) END, 6) AS score FROM m3""", "metrics"))
def _(t):
    third = F.col("recording_id") % 3
    mode = F.when(third == 0, "lower_is_better").when(third == 1, "higher_is_better").otherwise("near_q50")
    return looked_up(t).withColumn("mode", mode).select("recording_id", "mode", r6(op.component_score()).alias("score"))


@query("component_labels", with_views(REF + CAND + f""", m3 AS (SELECT *, {MODES} AS mode FROM lk)
SELECT recording_id, round((value - q05) / (q95 - q05), 6) AS position,
  CASE WHEN value < q05 THEN 'below_q05' WHEN value > q95 THEN 'above_q95' ELSE 'within_q05_q95' END AS status,
  CASE mode WHEN 'lower_is_better' THEN 'lower is better' WHEN 'higher_is_better' THEN 'higher is better' ELSE 'near q50 is better' END AS direction,
  '' AS component_type FROM m3""", "metrics"))
def _(t):
    third = F.col("recording_id") % 3
    mode = F.when(third == 0, "lower_is_better").when(third == 1, "higher_is_better").otherwise("near_q50")
    return looked_up(t).withColumn("mode", mode).select(
        "recording_id", r6(op.reference_position()).alias("position"), op.component_status().alias("status"),
        op.direction_label(F.col("mode")).alias("direction"), op.component_type(F.col("metric")).alias("component_type"))


# ---- recordings of the samples view scored against their own population (the flagship query)

FLAG = f", {dfa_sql(50)}, " + SPECTRUM.replace("c AS (SELECT", "spc AS (SELECT") + """, d AS (SELECT *, abs(value - lag(value) OVER (PARTITION BY recording_id, ch_name ORDER BY t)) AS d FROM samples),
ch AS (SELECT recording_id, ch_type, ch_name, max(d) AS m, max(value) - min(value) AS p FROM d GROUP BY ALL),
w AS (SELECT recording_id, ch_type, quantile_cont(m, 0.95) AS a1, quantile_cont(m, 0.75) AS a2,
  quantile_cont(m, 0.75) - quantile_cont(m, 0.25) AS a3, avg(m) AS a4, quantile_cont(p, 0.95) AS a5 FROM ch GROUP BY 1, 2),
sp AS (SELECT recording_id, ch_type, avg(sk) AS a6, avg(ku) AS a7 FROM spc GROUP BY 1, 2),
metrics AS (SELECT recording_id, 'dev' || (recording_id % 2) AS device_type, CASE WHEN recording_id % 3 = 0 THEN 'rest' ELSE 'task' END AS category,
  u.family AS family, u.dom AS dom, u.rank AS rank, u.value AS value, CASE WHEN u.stem IN ('max_abs_diff', 'ptp_amp') THEN u.stem || '.' || ch_type || '.' || u.stat ELSE u.family || '.' || ch_type END AS metric
  FROM (SELECT * FROM w JOIN sp USING (recording_id, ch_type) JOIN dfa USING (recording_id, ch_type)) q, unnest([
    {'rank': 1, 'family': 'max_abs_diff.abs_q95', 'dom': 'Temporal', 'stem': 'max_abs_diff', 'stat': 'abs_q95', 'value': a1},
    {'rank': 2, 'family': 'max_abs_diff.q75', 'dom': 'Temporal', 'stem': 'max_abs_diff', 'stat': 'q75', 'value': a2},
    {'rank': 3, 'family': 'max_abs_diff.iqr', 'dom': 'Temporal', 'stem': 'max_abs_diff', 'stat': 'iqr', 'value': a3},
    {'rank': 4, 'family': 'max_abs_diff.mean', 'dom': 'Temporal', 'stem': 'max_abs_diff', 'stat': 'mean', 'value': a4},
    {'rank': 5, 'family': 'freq_domain.skewness_amplitude', 'dom': 'Spectral', 'stem': 'freq_domain', 'stat': 'skewness_amplitude', 'value': a6},
    {'rank': 6, 'family': 'freq_domain.kurtosis_amplitude', 'dom': 'Spectral', 'stem': 'freq_domain', 'stat': 'kurtosis_amplitude', 'value': a7},
    {'rank': 8, 'family': 'fractal_domain.DFA', 'dom': 'Fractal', 'stem': 'fractal_domain', 'stat': 'DFA', 'value': dfa},
    {'rank': 7, 'family': 'ptp_amp.abs_q95', 'dom': 'Statistical', 'stem': 'ptp_amp', 'stat': 'abs_q95', 'value': a5}]) z(u))""" + REF + CAND + """,
sc AS (SELECT *, CASE WHEN q95 > q05 THEN 1e0 - least(1e0, greatest(0e0, (value - q05) / (q95 - q05))) END AS score FROM lk),
fam AS (SELECT recording_id, rank, family, dom, avg(score) * 100 AS family_score, count(score) AS n_components FROM sc GROUP BY 1, 2, 3, 4) """

#: Rate of the recordings, and length of the filters for them.
SFREQ, TAPS, LOBES = 300.0, 63, 8


def with_clean(body: str) -> str:
    """The samples view after band-pass, notch and resampling, in front of a SELECT."""
    steps = (fir_sql(kernels.bandpass_taps(1.0, 100.0, SFREQ, TAPS), "bp", "raw") + ", b1 AS (SELECT recording_id, ch_name, t, y AS value FROM bp) "
             + fir_sql(kernels.notch_taps([50.0], 2.0, SFREQ, TAPS), "nt", "b1") + ", b2 AS (SELECT recording_id, ch_name, t, y AS value FROM nt) " + resample_sql(5, 6, LOBES, source="b2"))
    clean = (f"WITH raw AS ({SQL['samples']}) {steps}, ct AS (SELECT DISTINCT recording_id, ch_name, ch_type FROM raw) "
             "SELECT recording_id, ch_type, ch_name, t, y AS value FROM rs JOIN ct USING (recording_id, ch_name)")
    return f"WITH samples AS ({clean}) {body.strip()}"


def clean_samples(t):
    """Samples after the default preprocessing, written once for all metrics."""
    keys = ["recording_id", "ch_type", "ch_name"]
    out, _, _ = preprocess(t.samples(), SFREQ, taps=TAPS, half=LOBES, keys=keys)
    return materialize(out)


def sample_metrics(t):
    """Metric rows of all recordings after preprocessing. The small result is kept for the later steps."""
    samples = clean_samples(t)
    channels = signal.channel_metrics(samples)
    keys = ["recording_id", "ch_type"]
    diff = signal.summarize_vector(channels, keys, "max_abs_diff", "max_abs_diff")
    shape = signal.spectral_shape(samples).join(signal.segmented_dfa(samples, 50), keys, "full")
    named = {"freq_domain.skewness_amplitude.": "skewness_amplitude", "freq_domain.kurtosis_amplitude.": "kurtosis_amplitude", "fractal_domain.DFA.": "dfa"}
    shape = shape.select("recording_id", F.inline(F.array(*[
        F.struct(F.concat(F.lit(n), F.col("ch_type")).alias("metric"), F.col(c).alias("value")) for n, c in named.items()])))
    columns = ["recording_id", "metric", "value"]
    both = diff.unionByName(signal.summarize_vector(channels, keys, "ptp", "ptp_amp")).select(*columns).unionByName(shape.select(*columns))
    return cut_lineage(both.select("recording_id", device(), category(), "metric", "value"))


def device():
    return F.concat(F.lit("dev"), F.col("recording_id") % 2).alias("device_type")


def category():
    return F.when(F.col("recording_id") % 3 == 0, "rest").otherwise("task").alias("category")


def scored_components(t):
    metrics = sample_metrics(t)
    profile = op.family_rows()
    wanted = metrics.where(F.exists(F.transform(profile, lambda f: f["metric"]), lambda m: m == F.col("metric")))
    recordings = metrics.select("recording_id", "device_type", "category").distinct()
    return op.component_scores(metrics, recordings, profile, op.build_reference_intervals(wanted))


def scored_families(t):
    return op.family_scores(scored_components(t))


@query("family_scores", with_clean(FLAG + """
SELECT recording_id, rank, family, dom AS domain, round(family_score, 6) AS family_score, n_components,
  CASE WHEN n_components = 2 THEN 'GRAD,MAG' ELSE '' END AS components FROM fam"""))
def _(t):
    return scored_families(t).select("recording_id", "rank", "family", "domain", r6("family_score").alias("family_score"),
                                     "n_components", F.array_join("components", ",").alias("components"))


@query("recording_score", with_clean(FLAG + """
SELECT recording_id, round(avg(family_score), 6) AS score, count(family_score) AS n_available, count(*) AS n_expected
FROM fam GROUP BY 1"""))
def _(t):
    return op.recording_scores(scored_families(t)).withColumn("score", r6("score"))


def gated_recordings(t):
    return op.quality_gate(op.recording_scores(scored_families(t)), 40.0, 55.0)


@query("recording_quality", with_clean(FLAG + """
SELECT recording_id, round(avg(family_score), 6) AS score, count(family_score) AS n_available, count(*) AS n_expected,
  coalesce(avg(family_score) >= 40e0, false) AS passed, coalesce(avg(family_score) < 55e0, true) AS alarm
FROM fam GROUP BY 1"""))
def _(t):
    return gated_recordings(t).withColumn("score", r6("score"))


@query("families_in_domain_order", with_clean(FLAG + """
SELECT recording_id, family, dom AS domain, row_number() OVER (PARTITION BY recording_id
  ORDER BY list_position(['Temporal', 'Statistical', 'Spectral', 'Fractal'], dom), rank, family)::INTEGER AS position FROM fam"""))
def _(t):
    return op.families_in_domain_order(scored_families(t)).select("recording_id", "family", "domain", "position")


@query("quality_gate", with_views("""
SELECT dataset, subject, round(score, 6) AS score, coalesce(score >= 68e0, false) AS passed, coalesce(score < 70e0, true) AS alarm
FROM subjects""", "subjects"))
def _(t):
    return op.quality_gate(t.subjects(), 68.0, 70.0).select("dataset", "subject", r6("score").alias("score"), "passed", "alarm")


@query("route_by_gate", with_views("""
SELECT dataset, subject, CASE WHEN dataset % 5 = 0 THEN 'bypass' ELSE 'passed' END AS route FROM subjects
WHERE dataset % 5 = 0 OR score >= 68e0""", "subjects"))
def _(t):
    s = t.subjects()
    recs = s.select("dataset", "subject", (F.col("dataset") % 5 != 0).alias("qc_enabled"))
    return op.route_by_gate(recs, op.quality_gate(s, 68.0, 70.0), ["dataset", "subject"]).select("dataset", "subject", "route")

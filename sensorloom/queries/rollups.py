"""Quality rules and roll-ups on the `subjects` and `trace` views."""

from pyspark.sql import functions as F

from ..functions.expr import r6, r6_off_ties
from ..operators import rollups as op
from ..session import materialize, scratch_folder
from ..sources import readers
from ..sources.bindings import with_views
from . import query

#: So many tags with their subjects, some 100 bytes each, go to all tasks; more are joined by a shuffle.
BROADCAST_TAGS = 50_000
# subjects with flags, steps and scope; failures: rare lineitem combinations stand for failed tasks
SV = """, sv AS (SELECT *, subject % 11 <> 0 AS has_artifacts, subject % 9 <> 0 AS has_ica, subject % 3 <> 0 AS has_ecg,
  subject % 4 <> 0 AS has_eog, subject % 5 AS marked_count, subject % 13 <> 0 AS has_coregistration, subject % 6 <> 0 AS has_epochs,
  subject % 23 <> 0 AS has_quality, dataset % 4 AS meg_stage, dataset % 12 = 2 AS skip_ica,
  CASE WHEN dataset % 2 = 0 THEN 'epochs' ELSE 'raw' END AS source_type, score >= 64e0 AS passed,
  subject % 17 <> 0 AS has_headmodel, subject % 4 <> 1 AS has_covariance, subject % 8 <> 3 AS has_source FROM subjects),
fl AS (SELECT DISTINCT s_nationkey AS dataset, l_suppkey AS subject, l_returnflag AS process,
  CASE l_returnflag WHEN 'A' THEN 'ica' WHEN 'N' THEN 'epochs' ELSE 'source' END AS step
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_quantity >= 49 AND l_tax = 0.08e0 AND l_discount >= 0.09e0),
fs AS (SELECT dataset, subject, list(step) AS failed FROM fl GROUP BY 1, 2),
st AS (SELECT sv.*, coalesce(failed, []) AS failed, coalesce(NOT passed, false) AS gated FROM sv LEFT JOIN fs USING (dataset, subject)),
sc AS (SELECT *, has_quality AS step_quality_score, true AS step_basic_preproc, has_artifacts AS step_artifacts,
  has_ica AND NOT list_contains(failed, 'ica') AS step_ica, has_epochs AND NOT list_contains(failed, 'epochs') AS step_epochs,
  has_covariance AS step_covariance, has_coregistration AS step_coregistration, has_headmodel AS step_headmodel,
  has_source AND NOT list_contains(failed, 'source') AS step_source,
  true AS expected_quality_score, NOT gated AS expected_basic_preproc, NOT gated AS expected_artifacts,
  NOT gated AND meg_stage >= 1 AND NOT skip_ica AS expected_ica,
  NOT gated AND (meg_stage = 2 OR (meg_stage = 3 AND source_type = 'epochs')) AS expected_epochs,
  NOT gated AND meg_stage >= 3 AS expected_covariance, NOT gated AND meg_stage >= 3 AS expected_coregistration,
  NOT gated AND meg_stage >= 3 AS expected_headmodel, NOT gated AND meg_stage >= 3 AS expected_source FROM st) """
AL = SV + """, al AS (
SELECT dataset, subject, u.c AS category, u.s AS severity, u.m AS message, u.v AS value, u.t AS threshold FROM sc, unnest(list_filter([
 CASE WHEN expected_quality_score AND NOT has_quality THEN {'c': 'Quality score', 's': 'warn', 'm': 'missing', 'v': NULL::DOUBLE, 't': NULL::DOUBLE} END,
 CASE WHEN expected_quality_score AND has_quality AND score IS NULL THEN {'c': 'Quality score', 's': 'danger', 'm': 'failed', 'v': NULL, 't': NULL} END,
 CASE WHEN expected_quality_score AND has_quality AND score < 70e0 THEN {'c': 'Quality score', 's': 'warn', 'm': 'below threshold', 'v': score, 't': 70e0} END,
 CASE WHEN NOT passed THEN {'c': 'QC gate', 's': 'danger', 'm': 'processing skipped', 'v': score, 't': NULL} END,
 CASE WHEN expected_artifacts AND NOT has_artifacts THEN {'c': 'Completeness', 's': 'warn', 'm': 'artifact outputs missing', 'v': NULL, 't': NULL} END,
 CASE WHEN NOT (expected_artifacts AND NOT has_artifacts) AND bad_channels > 30 THEN {'c': 'Artifacts', 's': 'warn', 'm': 'excessive bad channels', 'v': bad_channels, 't': 30} END,
 CASE WHEN NOT (expected_artifacts AND NOT has_artifacts) AND bad_segments > 50 THEN {'c': 'Artifacts', 's': 'warn', 'm': 'excessive bad segments', 'v': bad_segments, 't': 50} END,
 CASE WHEN expected_ica AND NOT has_ica THEN {'c': 'Completeness', 's': 'warn', 'm': 'component outputs missing', 'v': NULL, 't': NULL} END,
 CASE WHEN has_ica AND NOT has_ecg THEN {'c': 'ICA', 's': 'warn', 'm': 'no ECG components', 'v': NULL, 't': NULL} END,
 CASE WHEN has_ica AND has_ecg AND marked_count = 0 THEN {'c': 'ICA', 's': 'warn', 'm': 'ECG components unmarked', 'v': NULL, 't': NULL} END,
 CASE WHEN has_ica AND NOT has_eog THEN {'c': 'ICA', 's': 'warn', 'm': 'no EOG components', 'v': NULL, 't': NULL} END,
 CASE WHEN has_ica AND has_eog AND marked_count = 0 THEN {'c': 'ICA', 's': 'warn', 'm': 'EOG components unmarked', 'v': NULL, 't': NULL} END,
 CASE WHEN expected_coregistration AND NOT has_coregistration THEN {'c': 'Completeness', 's': 'warn', 'm': 'coregistration outputs missing', 'v': NULL, 't': NULL} END,
 CASE WHEN has_coregistration AND coreg_mean > 5e0 THEN {'c': 'Coregistration', 's': 'danger', 'm': 'mean distance above threshold', 'v': coreg_mean, 't': 5e0} END,
 CASE WHEN has_coregistration AND coreg_max > 10e0 THEN {'c': 'Coregistration', 's': 'danger', 'm': 'maximum distance above threshold', 'v': coreg_max, 't': 10e0} END,
 CASE WHEN has_epochs AND reject_rate > 0.3e0 THEN {'c': 'Epochs', 's': 'warn', 'm': 'rejection rate above threshold', 'v': reject_rate, 't': 0.3e0} END],
 lambda x: x IS NOT NULL)) z(u)
UNION ALL SELECT dataset, subject, 'Task: ' || process, 'danger', 'task failed or was ignored', 1e0, NULL FROM fl) """
SS = AL + """, ct AS (SELECT dataset, subject, count(*) AS alarm_count, count(*) FILTER (severity = 'danger') AS danger_count FROM al GROUP BY 1, 2),
ss AS (SELECT sc.*, coalesce(alarm_count, 0) AS alarm_count, coalesce(danger_count, 0) AS danger_count,
 CASE WHEN coalesce(alarm_count, 0) >= 3 OR coalesce(danger_count, 0) > 0 THEN 'FAIL' WHEN alarm_count >= 1 THEN 'WARN' ELSE 'PASS' END AS status
 FROM sc LEFT JOIN ct USING (dataset, subject)) """
MISSING = "list_filter([" + ", ".join(
    f"CASE WHEN expected_{s} AND NOT step_{s} THEN '{s}' END" for s in op.STEPS) + "], lambda x: x IS NOT NULL)"
RS = SS + f""", rs AS (SELECT *, {MISSING} AS missing_steps FROM ss),
rk AS (SELECT *, alarm_count * 100 + bad_channels + bad_segments
 + CASE WHEN score IS NULL THEN 75 ELSE greatest(0, CAST(trunc((70e0 - score) * 2) AS BIGINT)) END + CAST(trunc(reject_rate * 100) AS BIGINT)
 + len(missing_steps) * 25 + CAST(trunc(coreg_mean * 10) AS BIGINT) AS risk FROM rs),
pr AS (SELECT *, row_number() OVER (ORDER BY CASE status WHEN 'FAIL' THEN 0 WHEN 'WARN' THEN 1 ELSE 2 END, danger_count DESC, risk DESC,
 subject::VARCHAR, dataset) AS place FROM rk WHERE status <> 'PASS' OR alarm_count > 0 QUALIFY place <= 12) """


def scoped(t):
    s = F.col("subject")
    base = t.subjects().select(
        "*", (s % 11 != 0).alias("has_artifacts"), (s % 9 != 0).alias("has_ica"), (s % 3 != 0).alias("has_ecg"),
        (s % 4 != 0).alias("has_eog"), (s % 5).alias("marked_count"), (s % 13 != 0).alias("has_coregistration"),
        (s % 6 != 0).alias("has_epochs"), (s % 23 != 0).alias("has_quality"), (F.col("dataset") % 4).alias("meg_stage"),
        (F.col("dataset") % 12 == 2).alias("skip_ica"),
        F.when(F.col("dataset") % 2 == 0, "epochs").otherwise("raw").alias("source_type"),
        (F.col("score") >= 64).alias("passed"), F.lit(64e0).alias("min_score"), F.lit(True).alias("run_meg"),
        F.lit(True).alias("qc_enabled"), F.lit(True).alias("ecg_enabled"), F.lit(True).alias("eog_enabled"))
    steps = {"quality_score": F.col("has_quality"), "basic_preproc": F.lit(True), "artifacts": F.col("has_artifacts"),
             "ica": F.col("has_ica"), "epochs": F.col("has_epochs"), "covariance": s % 4 != 1,
             "coregistration": F.col("has_coregistration"), "headmodel": s % 17 != 0, "source": s % 8 != 3}
    return op.expected_steps(base.withColumns({f"step_{k}": v for k, v in steps.items()}))


def failures(t):
    li = t.table("lineitem").where("l_quantity >= 49 and l_tax = 0.08e0 and l_discount >= 0.09e0")
    return li.join(t.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_nationkey").alias("dataset"), F.col("l_suppkey").alias("subject"), F.col("l_returnflag").alias("process"),
        op.process_step(F.col("l_returnflag"), {"A": "ica", "N": "epochs", "R": "source"}).alias("step"),
        F.lit("1").alias("exit")).distinct()


def completed(t):
    return op.step_completion(scoped(t), failures(t))


def alarm_rows(t):
    return op.alarms(completed(t), failures(t))


def judged(t):
    return op.subject_status(completed(t), alarm_rows(t))


@query("find_subjects", "SELECT DISTINCT s_nationkey AS dataset, s_suppkey AS subject FROM supplier UNION SELECT DISTINCT c_nationkey, c_custkey FROM customer")
def _(t):
    a = t.table("supplier").select(F.col("s_nationkey").alias("dataset"), F.col("s_suppkey").alias("subject"))
    b = t.table("customer").select(F.col("c_nationkey").alias("dataset"), F.col("c_custkey").alias("subject"))
    return op.find_subjects([a, b])


TR = """, tf AS (SELECT *, exit NOT IN ('', '-', '0') OR status NOT IN ('COMPLETED', 'CACHED', 'SUBMITTED', 'RUNNING') AS failed FROM trace) """


def traced(t):
    return t.trace().withColumn("failed", op.trace_failed(F.col("status"), F.col("exit")))


@query("read_trace", with_views(
    "SELECT task_id, process, tag, split_part(tag, ':', 1) AS tag_dataset, split_part(tag, ':', 2) AS tag_subject FROM trace", "trace"))
def _(t):
    path = scratch_folder(t.spark) + "/trace"
    t.trace().select("task_id", F.concat("process", F.lit("  ("), "tag", F.lit(")")).alias("name")).write.csv(path, sep="\t", header=True)
    return readers.read_trace(t.spark, path).withColumn("task_id", F.col("task_id").cast("bigint")).drop("name")


@query("trace_failed", with_views(TR + "SELECT task_id, failed FROM tf", "trace"))
def _(t):
    return traced(t).select("task_id", "failed")


@query("drop_retried_failures", with_views(TR + """
SELECT task_id, failed FROM tf WHERE NOT failed OR NOT EXISTS (SELECT 1 FROM tf g WHERE g.tag = tf.tag AND g.process = tf.process AND NOT g.failed)""", "trace"))
def _(t):
    return op.drop_retried_failures(traced(t), ["tag", "process"]).select("task_id", "failed")


@query("match_task_subject", with_views(""",
tg AS (SELECT DISTINCT split_part(tag, ':', 1) AS dataset, split_part(tag, ':', 2) AS tag_subject FROM trace),
hit AS (SELECT a.dataset, a.tag_subject, min(b.tag_subject) AS subject FROM tg a JOIN tg b ON a.dataset = b.dataset AND contains(a.tag_subject, b.tag_subject) GROUP BY 1, 2)
SELECT task_id, subject FROM trace JOIN hit ON dataset = split_part(tag, ':', 1) AND tag_subject = split_part(tag, ':', 2)""", "trace"))
def _(t):
    parts = op.parse_task_name(F.concat(F.lit("p ("), F.col("tag"), F.lit(")")))
    # many tasks share a tag: names are parsed and matched once for each tag
    tags = materialize(t.trace().select("tag").distinct().select("tag", parts["tag_dataset"].alias("dataset"), parts["tag_subject"].alias("tag_subject")))
    subjects = tags.select("dataset", F.col("tag_subject").alias("subject"), F.col("tag_subject").alias("position")).distinct()
    found = materialize(tags.join(op.match_task_subject(tags, subjects), ["dataset", "tag_subject"]).select("tag", "subject"))
    return t.trace().select("task_id", "tag").join(F.broadcast(found) if found.count() <= BROADCAST_TAGS else found, "tag").select("task_id", "subject")


@query("infer_stage", with_views("""
SELECT tag, max(CASE process WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 3 END) AS meg_stage
FROM trace GROUP BY 1 HAVING meg_stage IS NOT NULL""", "trace"))
def _(t):
    names = {"1-URGENT": "artifacts", "2-HIGH": "ica", "3-MEDIUM": "epochs", "4-NOT SPECIFIED": "covariance", "5-LOW": "report"}
    return op.infer_stage(t.trace().withColumn("step", op.process_step(F.col("process"), names)), ["tag"])


@query("parse_steps", """
WITH r AS (SELECT c_custkey, CASE c_custkey % 12 WHEN 0 THEN 'all' WHEN 1 THEN ' MEG ' WHEN 2 THEN 'epochs,skip_ica' WHEN 3 THEN 'ica,with_anatomy'
  WHEN 4 THEN 'anatomy' WHEN 5 THEN 'report' WHEN 6 THEN 'meg_all,with_anatomy' WHEN 7 THEN 'ica,skip_ica' WHEN 8 THEN 'ica,fast' WHEN 9 THEN 'mri'
  WHEN 10 THEN ' , ' ELSE 'artifacts' END AS steps FROM customer)
SELECT c_custkey, CASE c_custkey % 12 WHEN 0 THEN 'all' WHEN 1 THEN 'meg_all' WHEN 2 THEN 'meg_epochs' WHEN 3 THEN 'meg_ica' WHEN 4 THEN 'anatomy'
  WHEN 5 THEN 'report' WHEN 6 THEN 'meg_all' WHEN 7 THEN 'meg_ica' WHEN 8 THEN 'meg_ica' WHEN 9 THEN 'mri' WHEN 10 THEN NULL ELSE 'meg_artifacts' END AS "primary",
  CASE c_custkey % 12 WHEN 0 THEN 3 WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 1 WHEN 4 THEN -1 WHEN 5 THEN -1 WHEN 6 THEN 3 WHEN 7 THEN 1 WHEN 8 THEN 1
  WHEN 9 THEN NULL WHEN 10 THEN NULL ELSE 0 END AS meg_stage,
  CASE c_custkey % 12 WHEN 6 THEN 'meg_all excludes with_anatomy' WHEN 7 THEN 'skip_ica needs epochs' WHEN 8 THEN 'unknown modifier'
  WHEN 9 THEN 'unknown steps' WHEN 10 THEN 'empty' END AS error FROM r""")
def _(t):
    texts = ["all", " MEG ", "epochs,skip_ica", "ica,with_anatomy", "anatomy", "report", "meg_all,with_anatomy", "ica,skip_ica",
             "ica,fast", "mri", " , ", "artifacts"]
    pick = F.array(*[F.lit(x) for x in texts])[(F.col("c_custkey") % 12).cast("int")]
    out = op.parse_steps(t.table("customer").select("c_custkey", pick.alias("steps")), strict=False)
    return out.select("c_custkey", "primary", "meg_stage", "error")


EXPECTED = ", ".join(f"expected_{s}" for s in op.STEPS)
STEPCOLS = ", ".join(f"step_{s}" for s in op.STEPS)


@query("expected_steps", with_views(SV.replace("coalesce(NOT passed, false) AS gated", "false AS gated") + f"SELECT dataset, subject, {EXPECTED} FROM sc", "subjects"))
def _(t):
    return scoped(t).select("dataset", "subject", *[f"expected_{s}" for s in op.STEPS])


@query("step_completion", with_views(SV + f"SELECT dataset, subject, len(failed) AS n_task_errors, {STEPCOLS}, {EXPECTED} FROM sc", "subjects"))
def _(t):
    return completed(t).select("dataset", "subject", "n_task_errors", *[f"step_{s}" for s in op.STEPS], *[f"expected_{s}" for s in op.STEPS])


@query("alarms", with_views(AL + "SELECT dataset, subject, category, severity, message, round(value, 6) AS value, threshold FROM al", "subjects"))
def _(t):
    return alarm_rows(t).withColumn("value", r6_off_ties("value", 1e-12))


@query("subject_status", with_views(SS + "SELECT dataset, subject, alarm_count, danger_count, status FROM ss", "subjects"))
def _(t):
    return judged(t).select("dataset", "subject", "alarm_count", "danger_count", "status")


@query("viewer_alarms", with_views(SV + """,
v AS (SELECT dataset, subject, list_filter([CASE WHEN NOT has_ecg THEN '[ICA] no ECG components' END,
 CASE WHEN has_ecg AND marked_count = 0 THEN '[ICA] ECG components unmarked' END, CASE WHEN bad_channels > 10 THEN '[Artifacts] excessive bad channels' END,
 CASE WHEN bad_segments > 50 THEN '[Artifacts] excessive bad segments' END, CASE WHEN NOT has_coregistration THEN '[Coregistration] missing' END,
 CASE WHEN has_coregistration AND coreg_mean > 5e0 THEN '[Coregistration] mean distance' END,
 CASE WHEN has_coregistration AND coreg_max > 10e0 THEN '[Coregistration] maximum distance' END], lambda x: x IS NOT NULL) AS a FROM sv)
SELECT dataset, subject, CASE WHEN len(a) = 0 THEN 'Passed' ELSE 'Failed' END AS status, len(a) AS alarm_count, array_to_string(a, '; ') AS details FROM v""", "subjects"))
def _(t):
    return op.viewer_alarms(scoped(t), {"ica_eog": False}, {"bad_channel_threshold": 10})


DS = SS + """, ds AS (SELECT dataset, count(*) AS total_subjects, count(*) FILTER (status = 'PASS') AS pass_count, count(*) FILTER (status = 'WARN') AS warn_count,
 count(*) FILTER (status = 'FAIL') AS fail_count, CAST(sum(alarm_count) AS BIGINT) AS alarm_count, avg(score) AS avg_score, avg(bad_channels) AS avg_bad_channels,
 avg(bad_segments) AS avg_bad_segments, avg(coreg_mean) AS avg_coreg_mean, avg(coreg_max) AS avg_coreg_max, avg(reject_rate) AS avg_reject_rate,
 count(score) AS scored_count, sum(score) AS score_sum, count(*) FILTER (score < 70e0) AS warning_count, """ + ", ".join(
    f"count(*) FILTER (step_{s}) AS done_{s}, bool_or(expected_{s}) AS expected_{s}" for s in op.STEPS) + " FROM ss GROUP BY 1) "


def datasets(t):
    return op.dataset_summary(judged(t))


ROUNDED = ["avg_" + c for c in op.AVERAGED] + ["score_sum"]


@query("dataset_summary", with_views(DS + "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in ROUNDED) + ") FROM ds", "subjects"))
def _(t):
    return datasets(t).withColumns({c: r6(c) for c in ROUNDED})


SUMMED = ["total_subjects", "pass_count", "warn_count", "fail_count", "alarm_count", "scored_count", "warning_count"]


@query("corpus_summary", with_views(DS + "SELECT dataset, CASE WHEN grouping(dataset) = 1 THEN 'corpus' ELSE 'dataset' END AS level, count(*) AS dataset_count, "
       + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in SUMMED)
       + ", CAST(sum(greatest(total_subjects - scored_count, 0)) AS BIGINT) AS missing_count, round(sum(score_sum) / sum(scored_count), 6) AS avg_score, "
       + ", ".join(f"CAST(sum(done_{s}) AS BIGINT) AS done_{s}, CAST(sum(CASE WHEN expected_{s} THEN total_subjects ELSE 0 END) AS BIGINT) AS expected_{s}" for s in op.STEPS)
       + ", CASE WHEN sum(fail_count) > 0 THEN 'FAIL' WHEN sum(warn_count) > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM ds GROUP BY ROLLUP (dataset)", "subjects"))
def _(t):
    return op.corpus_summary(datasets(t)).withColumn("avg_score", r6("avg_score"))


DONE = " + ".join(f"CASE WHEN expected_{s} THEN least(done_{s}, total_subjects) ELSE 0 END" for s in op.STEPS)
NSTAGE = " + ".join(f"CASE WHEN expected_{s} THEN 1 ELSE 0 END" for s in op.STEPS)
FULL = " + ".join(f"CASE WHEN expected_{s} AND done_{s} >= total_subjects THEN 1 ELSE 0 END" for s in op.STEPS)


@query("step_progress", with_views(DS + f", g AS (SELECT dataset, total_subjects, {DONE} AS d, {NSTAGE} AS n, {FULL} AS f FROM ds) " + """
SELECT dataset, d AS completed_steps, n * total_subjects AS expected_steps, round(d * 100e0 / (n * total_subjects), 6) AS percent,
 n AS n_stages, f AS complete_stages, CASE WHEN n = f THEN 'complete' ELSE 'partial' END AS state FROM g""", "subjects"))
def _(t):
    return op.step_progress(datasets(t)).withColumn("percent", r6("percent"))


def risky(t):
    return op.risk_score(judged(t))


@query("risk_score", with_views(RS + "SELECT dataset, subject, array_to_string(missing_steps, ',') AS missing_steps, CAST(risk AS BIGINT) AS risk FROM rk", "subjects"))
def _(t):
    return risky(t).select("dataset", "subject", F.array_join("missing_steps", ",").alias("missing_steps"), "risk")


@query("threshold_counts", with_views(RS + """
SELECT dataset, count(*) FILTER (score IS NULL OR score < 70e0) AS over_score, count(*) FILTER (bad_channels > 12) AS over_bad_channels,
 count(*) FILTER (bad_segments > 50) AS over_bad_segments, count(*) FILTER (coreg_mean > 5e0) AS over_coreg_mean,
 count(*) FILTER (reject_rate > 0.3e0) AS over_epoch_reject, count(*) FILTER (len(missing_steps) > 0) AS with_missing_steps FROM rk GROUP BY 1""", "subjects"))
def _(t):
    return op.threshold_counts(judged(t), ["dataset"], {"bad_channel_threshold": 12})


@query("priority_subjects", with_views(RS + "SELECT dataset, subject, status, danger_count, CAST(risk AS BIGINT) AS risk, CAST(place AS INTEGER) AS place FROM pr", "subjects"))
def _(t):
    return op.priority_subjects(risky(t)).select("dataset", "subject", "status", "danger_count", "risk", "place")


@query("alarm_board", with_views(RS + """
SELECT dataset, subject, category, severity, message, CAST(row_number() OVER (ORDER BY CASE severity WHEN 'danger' THEN 0 ELSE 1 END, place, category, message, value) AS INTEGER) AS position
FROM al JOIN (SELECT dataset, subject, place FROM pr) USING (dataset, subject)""", "subjects"))
def _(t):
    return op.alarm_board(op.priority_subjects(risky(t)), alarm_rows(t)).select("dataset", "subject", "category", "severity", "message", "position")


@query("subjects_table", with_views(SS + """
SELECT subject, status, alarm_count, round(score, 6) AS score, bad_channels, bad_segments, marked_count AS marked_ica, round(coreg_mean, 6) AS coreg_mean_mm,
 round(coreg_max, 6) AS coreg_max_mm, round(reject_rate, 6) AS epoch_reject_rate, step_quality_score AS quality_score, step_artifacts AS artifacts, step_ica AS ica,
 step_coregistration AS coregistration, step_headmodel AS headmodel, step_epochs AS epochs, step_covariance AS covariance, step_source AS source FROM ss""", "subjects"))
def _(t):
    exact = {c: r6(c) for c in ("score", "coreg_max_mm", "epoch_reject_rate")}
    return op.subjects_table(judged(t)).withColumns(exact | {"coreg_mean_mm": r6_off_ties("coreg_mean_mm", 1e-12)})


@query("workflow_node_status", with_views(SS + "SELECT dataset, step, CASE WHEN d = 0 THEN 'missing' WHEN d = n THEN 'done' ELSE 'partial' END AS state FROM (" + " UNION ALL ".join(
    f"SELECT dataset, '{s}' AS step, count(*) AS n, count(*) FILTER (step_{s}) AS d FROM ss GROUP BY 1" for s in op.STEPS) + ")", "subjects"))
def _(t):
    return op.workflow_node_status(judged(t))


@query("pick_evenly_spaced", """
WITH d AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM documents)
SELECT doc_id, source FROM d WHERE n <= 8 OR list_contains(list_transform(range(0, 8), lambda k: CAST(round_even(k * (n - 1) / 7e0, 0) AS BIGINT)), i)""")
def _(t):
    docs = t.table("documents").select("doc_id", "source")
    return op.pick_evenly_spaced(docs, ["source"], "doc_id", F.floor(F.col("doc_id") / 100_000).cast("bigint"), 8)


@query("select_topographies", """
WITH c AS (SELECT label AS recording_id, vec_id AS component, embedding[1] > 0.25e0 AS marked, CASE WHEN embedding[2] > 0 THEN CAST(embedding[3] AS DOUBLE) END AS ev FROM embeddings)
SELECT recording_id, component, marked, CAST(row_number() OVER (PARTITION BY recording_id ORDER BY marked DESC, CASE WHEN NOT marked THEN ev END DESC NULLS LAST, component) AS INTEGER) AS position
FROM c QUALIFY position <= 6""")
def _(t):
    e = F.col("embedding")
    c = t.table("embeddings").select(F.col("label").alias("recording_id"), F.col("vec_id").alias("component"),
                                     (e[0] > 0.25).alias("marked"), F.when(e[1] > 0, e[2].cast("double")).alias("explained_var"))
    return op.select_topographies(c).select("recording_id", "component", "marked", "position")


@query("drop_all_null_columns", with_views("SELECT dataset, subject, bad_channels, round(score, 6) AS score FROM subjects", "subjects"))
def _(t):
    s = t.subjects().select("dataset", "subject", "bad_channels", r6("score").alias("score"), F.lit(None).cast("double").alias("coreg_err"))
    return op.drop_all_null_columns(s)


@query("search_and_page", """
SELECT doc_id, source FROM documents WHERE contains(lower(source || ' ' || lang || ' ' || text), 'license') ORDER BY n_chars DESC, doc_id LIMIT 20 OFFSET 20""")
def _(t):
    docs = t.table("documents")
    return op.search_and_page(docs, ["source", "lang", "text"], "License", [F.desc("n_chars"), "doc_id"], 2, 20).select("doc_id", "source")


@query("recording_inventory", with_views("""
SELECT recording_id, 'duration_s' AS item, round((max(t) + 1) / 10e0, 6) AS value FROM samples GROUP BY 1
UNION ALL SELECT recording_id, 'n_channels', CAST(count(DISTINCT ch_name) AS DOUBLE) FROM samples GROUP BY 1
UNION ALL SELECT recording_id, 'channels:' || ch_type, CAST(count(DISTINCT ch_name) AS DOUBLE) FROM samples GROUP BY recording_id, ch_type
UNION ALL SELECT recording_id, 'events:' || event_id, CAST(count(*) AS DOUBLE) FROM triggers GROUP BY recording_id, event_id""", "samples", "triggers"))
def _(t):
    return op.recording_inventory(t.samples(), t.triggers(), 10.0).withColumn("value", r6("value"))


@query("dataset_ranking", with_views(DS + "SELECT dataset, alarm_count, CAST(row_number() OVER (ORDER BY alarm_count DESC, dataset) AS INTEGER) AS place FROM ds", "subjects"))
def _(t):
    return op.dataset_ranking(datasets(t).select("dataset", "alarm_count"))


@query("flip_gain_table", with_views("""
SELECT recording_id, round_even(b, 3) AS before, round_even(a, 3) AS after, round_even(round_even(a, 3) - round_even(b, 3), 3) AS gain FROM (
 SELECT recording_id, max(prob) FILTER (fold = 0) AS b, max(prob) FILTER (fold > 0) AS a FROM probs GROUP BY 1)""", "probs"))
def _(t):
    return op.flip_gain_table(t.probs().select("recording_id", F.col("fold").alias("step"), F.col("prob").alias("metric")))


@query("covariance_completeness", """
SELECT p_partkey, coalesce(CASE WHEN p_size > 5 THEN CASE WHEN p_type = 'ECONOMY' THEN p_size % 2 = 0 ELSE p_size % 2 = 1 AND p_size % 3 > 0 END
  AND (p_size % 5 > 0 OR p_size % 7 > 0) AND p_size % 11 > 0 ELSE p_size % 3 > 0 AND p_size % 11 > 0 END, false) AS complete FROM part""")
def _(t):
    s = F.col("p_size")
    outputs = t.table("part").select(
        "p_partkey", (s > 5).alias("has_metadata"), F.when(F.col("p_type") == "ECONOMY", "none").otherwise("raw").alias("mode"),
        F.when(s % 2 == 1, "noise-cov").alias("noise_name"), (s % 3 > 0).alias("noise_present"),
        F.when(s % 5 == 0, "data-cov").alias("data_name"), (s % 7 > 0).alias("data_present"), (s % 11 > 0).alias("rank_present"))
    return op.covariance_completeness(outputs).select("p_partkey", "complete")

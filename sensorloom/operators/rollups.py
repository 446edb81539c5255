"""Quality rules per subject and roll-ups to dataset and corpus.

Input is one wide row per subject: metrics (`score`, `bad_channels`, `bad_segments`,
`coreg_mean`, `coreg_max`, `reject_rate`, `marked_count`), flags (`has_ecg`, `has_eog`,
`ecg_enabled`, `eog_enabled`, `passed`) and `step_<name>` / `expected_<name>` booleans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import mean_above, slug
from ..plans.scans import dense_index

# Processing steps in order, alert thresholds, and what a trace process belongs to.
STEPS = ["quality_score", "basic_preproc", "artifacts", "ica", "epochs", "covariance", "coregistration", "headmodel", "source"]
THRESHOLDS = {
    "bad_channel_threshold": 30, "bad_segment_threshold": 50, "coreg_mean_threshold": 5.0,
    "coreg_max_threshold": 10.0, "epoch_reject_rate_threshold": 0.30, "alarm_score": 70.0,
}
PROCESS_STEPS = {
    "import_mri_dataset": "anatomy import", "dcm2niix": "anatomy import", "run_freesurfer": "anatomy",
    "run_deepprep": "anatomy", "run_mkheadsurf": "headmodel", "generate_bem": "headmodel",
    "import_meg_dataset": "meg import", "score_meg_quality": "quality_score", "meg_basic_preproc": "basic_preproc",
    "detect_artifacts": "artifacts", "run_ica": "ica", "run_ic_label": "ica", "apply_ica": "ica",
    "prepare_source_raw": "source", "coregistration": "coregistration", "forward_solution": "headmodel",
    "epochs": "epochs", "compute_covariance": "covariance", "compute_covariances": "covariance",
    "source_imaging": "source", "generate_static_html_report": "report", "generate_corpus_static_html_report": "report",
}
GOOD_STATUSES = ["COMPLETED", "CACHED", "SUBMITTED", "RUNNING"]
SUBJECT = ["dataset", "subject"]


# ------------------------------------------------------------------- task trace

def find_subjects(outputs: list[DataFrame]) -> DataFrame:
    """Distinct subjects over the outputs of all stages."""
    return reduce(DataFrame.unionByName, [o.select(*SUBJECT) for o in outputs]).distinct()


def parse_task_name(name: Column) -> dict[str, Column]:
    """`process (dataset:subject)` -> process, tag, dataset and subject parts."""
    pattern = r"^(.+?)\s+\((.+)\)$"
    n = F.trim(name)
    tagged = n.rlike(pattern)
    tag = F.when(tagged, F.trim(F.regexp_extract(n, pattern, 2)))
    pair = F.contains(tag, F.lit(":"))
    head, rest = F.trim(F.substring_index(tag, ":", 1)), F.trim(F.regexp_replace(tag, r"^[^:]*:", ""))
    return {"process": F.when(tagged, F.trim(F.regexp_extract(n, pattern, 1))).otherwise(n), "tag": tag,
            "tag_dataset": F.when(pair & (head != ""), head),
            "tag_subject": F.when(pair, F.when(rest != "", rest)).otherwise(tag)}


def trace_failed(status: Column, exit_code: Column) -> Column:
    """A non-zero exit, or a status outside the good ones."""
    code, state = F.trim(F.coalesce(exit_code, F.lit(""))), F.upper(F.trim(F.coalesce(status, F.lit(""))))
    return ~code.isin("", "-", "0") | ((state != "") & ~state.isin(GOOD_STATUSES))


def drop_retried_failures(tasks: DataFrame, keys: list[str]) -> DataFrame:
    """Hide failed attempts of tasks that also succeeded.

    Successes are reduced to one row per identity before the join, so retries never multiply.
    """
    fixed = tasks.where("not failed").select(*keys).distinct()
    hidden = tasks.where("failed").join(fixed, keys, "left_anti")
    return tasks.where("not failed").unionByName(hidden)


def match_task_subject(tags: DataFrame, subjects: DataFrame) -> DataFrame:
    """First subject, in list order, whose sanitized name occurs in the sanitized tag of the same dataset.

    Names are indexed by their length: a tag gives its fragments of the lengths that names of its dataset have, which meet the names by equality, so tags
    and subjects are never crossed and a tag of L letters gives L fragments for each such length. `tags(dataset, tag_subject)`,
    `subjects(dataset, subject, position)`.
    """
    named = subjects.withColumn("_name", slug(F.col("subject"))).where(F.length("_name") > 0)
    lengths = named.groupBy("dataset").agg(F.collect_set(F.length("_name")).alias("_lengths"))
    t = tags.select("dataset", "tag_subject").where("tag_subject is not null").distinct().withColumn("_n", slug(F.col("tag_subject"))).join(lengths, "dataset")
    t = t.withColumn("_len", F.explode("_lengths")).where(F.col("_len") <= F.length("_n"))
    starts = F.transform(F.sequence(F.lit(1), F.length("_n") - F.col("_len") + 1), lambda at: F.substring(F.col("_n"), at, F.col("_len")))
    pieces = t.select("dataset", "tag_subject", F.explode(F.array_distinct(starts)).alias("_name"))
    hits = pieces.join(named, ["dataset", "_name"])
    return hits.groupBy("dataset", "tag_subject").agg(F.min_by("subject", "position").alias("subject"))


def process_step(process: Column, steps: dict[str, str] | None = None) -> Column:
    pairs = [F.lit(x) for kv in (steps or PROCESS_STEPS).items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), process)


def infer_stage(tasks: DataFrame, keys: list[str]) -> DataFrame:
    """Highest stage implied by the steps seen."""
    step = F.col("step")
    stage = (F.when(step.isin("source", "headmodel", "coregistration", "covariance"), 3).when(step == "epochs", 2)
             .when(step == "ica", 1).when(step.isin("artifacts", "basic_preproc", "meg import"), 0))
    return tasks.groupBy(*keys).agg(F.max(stage).alias("meg_stage")).where("meg_stage is not null")


# --------------------------------------------------------------- scope and steps

STEP_ALIASES = {"meg": "meg_all", "artifacts": "meg_artifacts", "ica": "meg_ica", "epochs": "meg_epochs"}
STAGES = {"report": -1, "anatomy": -1, "all": 3, "meg_all": 3, "meg_artifacts": 0, "meg_ica": 1, "meg_epochs": 2}


def parse_steps(requests: DataFrame, column: str = "steps", strict: bool = True) -> DataFrame:
    """Requested steps with modifiers -> stage and flags; illegal requests raise, or get an `error` text."""
    parts = F.filter(F.transform(F.split(F.col(column), ","), lambda p: F.lower(F.trim(p))), lambda p: p != "")
    pairs = [F.lit(x) for kv in STEP_ALIASES.items() for x in kv]
    head = F.get(F.col("_parts"), F.lit(0))
    out = requests.withColumn("_parts", parts).withColumn(
        "primary", F.coalesce(F.try_element_at(F.create_map(*pairs), head), head))
    mods = F.slice("_parts", 2, F.greatest(F.size("_parts"), F.lit(1)))
    out = out.withColumn("_mods", F.when(F.size("_parts") > 0, mods).otherwise(F.array().cast("array<string>")))
    skip, anatomy = F.array_contains("_mods", "skip_ica"), F.array_contains("_mods", "with_anatomy")
    known = [F.lit(x) for kv in STAGES.items() for x in kv]
    stage = F.try_element_at(F.create_map(*known), F.col("primary"))
    partial = F.col("primary").isin("meg_artifacts", "meg_ica", "meg_epochs")
    error = (F.when(F.size("_parts") == 0, "empty").when(
        F.exists("_mods", lambda m: ~m.isin("skip_ica", "with_anatomy")), "unknown modifier")
        .when((F.col("primary") == "meg_all") & anatomy, "meg_all excludes with_anatomy").when(stage.isNull(), "unknown steps")
        .when(anatomy & ~partial, "with_anatomy needs a partial run").when(skip & (stage != 2), "skip_ica needs epochs"))
    out = out.withColumn("error", error)
    if strict:
        out = out.where(F.assert_true(F.col("error").isNull(), F.concat(F.lit("steps: "), F.coalesce("error", F.lit("")))).isNull())
    return out.select(
        *requests.columns, "primary", stage.alias("meg_stage"),
        (F.col("primary").isin("anatomy", "all") | (partial & anatomy)).alias("run_anatomy"),
        (partial | F.col("primary").isin("all", "meg_all")).alias("run_meg"), skip.alias("skip_ica"), "error")


def expected_steps(scope: DataFrame) -> DataFrame:
    """`expected_<step>` flags from run_meg, meg_stage, skip_ica, source_type and qc_enabled."""
    run, stage = F.coalesce("run_meg", F.lit(False)), F.coalesce("meg_stage", F.lit(3))
    rules = {
        "quality_score": F.coalesce("qc_enabled", F.lit(True)), "basic_preproc": F.lit(True), "artifacts": F.lit(True),
        "ica": (stage >= 1) & ~F.col("skip_ica"),
        "epochs": (stage == 2) | ((stage >= 3) & (F.lower(F.coalesce("source_type", F.lit("epochs"))) == "epochs")),
        **{s: stage >= 3 for s in ("covariance", "coregistration", "headmodel", "source")},
    }
    return scope.select("*", *[(run & rules[s]).alias(f"expected_{s}") for s in STEPS])


def step_completion(subjects: DataFrame, failures: DataFrame) -> DataFrame:
    """Failed tasks force their step to false; a failed gate clears every later expectation.

    Adds `failed_steps` (array) and `n_task_errors`.
    """
    failed = failures.groupBy(*SUBJECT).agg(F.collect_set("step").alias("failed_steps"), F.count("*").alias("n_task_errors"))
    j = subjects.join(failed, SUBJECT, "left").withColumn(
        "failed_steps", F.coalesce("failed_steps", F.array().cast("array<string>"))).withColumn(
        "n_task_errors", F.coalesce("n_task_errors", F.lit(0)))
    gated = F.coalesce(~F.col("passed"), F.lit(False))
    for s in STEPS:
        j = j.withColumn(f"step_{s}", F.col(f"step_{s}") & ~F.array_contains("failed_steps", s))
        if s != "quality_score":
            j = j.withColumn(f"expected_{s}", F.col(f"expected_{s}") & ~gated)
    return j


def covariance_completeness(outputs: DataFrame) -> DataFrame:
    """Complete when every declared output is present; without metadata, noise covariance and rank are required.

    `has_metadata, mode, noise_name, noise_present, data_name, data_present, rank_present`.
    """
    noise = F.when(F.col("mode") == "none", F.col("noise_name").isNull()).otherwise(
        F.col("noise_name").isNotNull() & F.col("noise_present"))
    data = F.col("data_name").isNull() | F.col("data_present")
    rule = F.when(F.col("has_metadata"), noise & data & F.col("rank_present")).otherwise(
        F.col("noise_present") & F.col("rank_present"))
    return outputs.withColumn("complete", F.coalesce(rule, F.lit(False)))


# ------------------------------------------------------------------------ alarms

def _alarm(cond: Column, category: str, severity: str, message: str, value: Column | None = None, limit=None) -> Column:
    body = F.struct(F.lit(category).alias("category"), F.lit(severity).alias("severity"), F.lit(message).alias("message"),
                    (F.lit(None) if value is None else value).cast("double").alias("value"),
                    F.lit(limit).cast("double").alias("threshold"))
    return F.when(F.coalesce(cond, F.lit(False)), body)


def alarm_column(thresholds: dict | None = None, missing_ecg: bool = True, missing_eog: bool = True) -> Column:
    """All rule-based alarms of a subject as one array; missing outputs suppress the finer rules."""
    th = {**THRESHOLDS, **(thresholds or {})}
    exp, done = lambda s: F.col(f"expected_{s}"), lambda s: F.col(f"step_{s}")
    score = F.col("score")
    no_artifacts = exp("artifacts") & ~F.col("has_artifacts")
    ecg, eog = F.col("has_ica") & F.col("ecg_enabled"), F.col("has_ica") & F.col("eog_enabled")
    unmarked = F.col("marked_count") == 0
    wants_quality = exp("quality_score")
    rules = [
        _alarm(wants_quality & ~F.col("has_quality"), "Quality score", "warn", "missing"),
        _alarm(wants_quality & F.col("has_quality") & score.isNull(), "Quality score", "danger", "failed"),
        _alarm(wants_quality & F.col("has_quality") & (score < th["alarm_score"]), "Quality score", "warn",
               "below threshold", score, th["alarm_score"]),
        _alarm(~F.col("passed") & F.col("min_score").isNotNull(), "QC gate", "danger", "processing skipped", score),
        _alarm(no_artifacts, "Completeness", "warn", "artifact outputs missing"),
        _alarm(~no_artifacts & (F.col("bad_channels") > th["bad_channel_threshold"]), "Artifacts", "warn",
               "excessive bad channels", F.col("bad_channels"), th["bad_channel_threshold"]),
        _alarm(~no_artifacts & (F.col("bad_segments") > th["bad_segment_threshold"]), "Artifacts", "warn",
               "excessive bad segments", F.col("bad_segments"), th["bad_segment_threshold"]),
        _alarm(exp("ica") & ~F.col("has_ica"), "Completeness", "warn", "component outputs missing"),
        _alarm(F.lit(missing_ecg) & ecg & ~F.col("has_ecg"), "ICA", "warn", "no ECG components"),
        _alarm(ecg & F.col("has_ecg") & unmarked, "ICA", "warn", "ECG components unmarked"),
        _alarm(F.lit(missing_eog) & eog & ~F.col("has_eog"), "ICA", "warn", "no EOG components"),
        _alarm(eog & F.col("has_eog") & unmarked, "ICA", "warn", "EOG components unmarked"),
        _alarm(exp("coregistration") & ~F.col("has_coregistration"), "Completeness", "warn", "coregistration outputs missing"),
        _alarm(F.col("has_coregistration") & mean_above("coreg_mean", th["coreg_mean_threshold"]), "Coregistration", "danger",
               "mean distance above threshold", F.col("coreg_mean"), th["coreg_mean_threshold"]),
        _alarm(F.col("has_coregistration") & (F.col("coreg_max") > th["coreg_max_threshold"]), "Coregistration", "danger",
               "maximum distance above threshold", F.col("coreg_max"), th["coreg_max_threshold"]),
        _alarm(F.col("has_epochs") & (F.col("reject_rate") > th["epoch_reject_rate_threshold"]), "Epochs", "warn",
               "rejection rate above threshold", F.col("reject_rate"), th["epoch_reject_rate_threshold"]),
    ]
    return F.array_compact(F.array(*rules))


def alarms(subjects: DataFrame, failures: DataFrame | None = None, **options) -> DataFrame:
    """Long (dataset, subject, category, severity, message, value, threshold)."""
    out = subjects.select(*SUBJECT, F.inline(alarm_column(**options)))
    if failures is None:
        return out
    tasks = failures.select(*SUBJECT, F.concat(F.lit("Task: "), F.coalesce("process", F.lit("task"))).alias("category"),
                            F.lit("danger").alias("severity"), F.lit("task failed or was ignored").alias("message"),
                            F.col("exit").try_cast("double").alias("value"), F.lit(None).cast("double").alias("threshold"))
    return out.unionByName(tasks)


def subject_status(subjects: DataFrame, alarm_rows: DataFrame) -> DataFrame:
    """FAIL with three alarms or any danger, WARN with one, else PASS; adds counts."""
    counts = alarm_rows.groupBy(*SUBJECT).agg(
        F.count("*").alias("alarm_count"), F.count_if(F.col("severity") == "danger").alias("danger_count"))
    j = subjects.join(counts, SUBJECT, "left").withColumns({
        "alarm_count": F.coalesce("alarm_count", F.lit(0)), "danger_count": F.coalesce("danger_count", F.lit(0))})
    return j.withColumn("status", F.when((F.col("alarm_count") >= 3) | (F.col("danger_count") > 0), "FAIL")
                        .when(F.col("alarm_count") >= 1, "WARN").otherwise("PASS"))


def viewer_alarms(subjects: DataFrame, checks: dict[str, bool] | None = None, thresholds: dict | None = None) -> DataFrame:
    """Smaller rule set with switches; any alarm means Failed. Adds counts and the joined details."""
    on = {"ica_ecg": True, "ica_eog": True, "bad_channels": True, "bad_segments": True, "coregistration": True, **(checks or {})}
    th = {**THRESHOLDS, **(thresholds or {})}

    def text(switch: str, cond: Column, message: str) -> Column:
        return F.when(F.lit(on[switch]) & F.coalesce(cond, F.lit(False)), message)

    unmarked, coreg = F.col("marked_count") == 0, F.col("has_coregistration")
    rules = [
        text("ica_ecg", ~F.col("has_ecg"), "[ICA] no ECG components"),
        text("ica_ecg", F.col("has_ecg") & unmarked, "[ICA] ECG components unmarked"),
        text("ica_eog", ~F.col("has_eog"), "[ICA] no EOG components"),
        text("ica_eog", F.col("has_eog") & unmarked, "[ICA] EOG components unmarked"),
        text("bad_channels", F.col("bad_channels") > th["bad_channel_threshold"], "[Artifacts] excessive bad channels"),
        text("bad_segments", F.col("bad_segments") > th["bad_segment_threshold"], "[Artifacts] excessive bad segments"),
        text("coregistration", ~coreg, "[Coregistration] missing"),
        text("coregistration", coreg & mean_above("coreg_mean", th["coreg_mean_threshold"]), "[Coregistration] mean distance"),
        text("coregistration", coreg & (F.col("coreg_max") > th["coreg_max_threshold"]), "[Coregistration] maximum distance"),
    ]
    found = subjects.withColumn("_a", F.array_compact(F.array(*rules)))
    return found.select(*SUBJECT, F.when(F.size("_a") == 0, "Passed").otherwise("Failed").alias("status"),
                        F.size("_a").cast("bigint").alias("alarm_count"), F.array_join("_a", "; ").alias("details"))


# ---------------------------------------------------------------------- roll-ups

AVERAGED = ["score", "bad_channels", "bad_segments", "coreg_mean", "coreg_max", "reject_rate"]


def dataset_summary(subjects: DataFrame) -> DataFrame:
    """Totals, status counts, alarm sum, null-skipping averages, scored counts and completed steps per dataset."""
    return subjects.groupBy("dataset").agg(
        F.count("*").alias("total_subjects"),
        *[F.count_if(F.col("status") == s).alias(s.lower() + "_count") for s in ("PASS", "WARN", "FAIL")],
        F.sum("alarm_count").alias("alarm_count"), *[F.avg(c).alias("avg_" + c) for c in AVERAGED],
        F.count("score").alias("scored_count"), F.sum("score").alias("score_sum"),
        F.count_if(F.col("score") < THRESHOLDS["alarm_score"]).alias("warning_count"),
        *[F.count_if(f"step_{s}").alias("done_" + s) for s in STEPS],
        *[F.bool_or(f"expected_{s}").alias("expected_" + s) for s in STEPS])


def corpus_summary(datasets: DataFrame) -> DataFrame:
    """Sums over datasets and the mean over all scored subjects, plus one row per dataset with its status.

    A rollup of the dataset summary; subjects are not read again.
    """
    total = F.col("total_subjects")
    sums = datasets.rollup("dataset").agg(
        F.grouping("dataset").alias("_all"), F.count("*").alias("dataset_count"), F.sum(total).alias("total_subjects"),
        *[F.sum(c).alias(c) for c in ("pass_count", "warn_count", "fail_count", "alarm_count", "scored_count", "warning_count")],
        F.sum(F.greatest(total - F.col("scored_count"), F.lit(0))).alias("missing_count"),
        F.try_divide(F.sum("score_sum"), F.sum("scored_count")).alias("avg_score"),
        *[F.sum("done_" + s).alias("done_" + s) for s in STEPS],
        *[F.sum(F.when(F.col("expected_" + s), total).otherwise(0)).alias("expected_" + s) for s in STEPS])
    status = F.when(F.col("fail_count") > 0, "FAIL").when(F.col("warn_count") > 0, "WARN").otherwise("PASS")
    return sums.withColumn("level", F.when(F.col("_all") == 1, "corpus").otherwise("dataset")).withColumn("status", status).drop("_all")


def step_progress(datasets: DataFrame) -> DataFrame:
    """Completed subject-steps (capped), expected ones, percent and complete stages per dataset."""
    total = F.col("total_subjects")

    def over(f):
        return reduce(lambda a, b: a + b, [F.when(F.col("expected_" + s), f(s)).otherwise(0) for s in STEPS])

    done = over(lambda s: F.least(F.col("done_" + s), total))
    stages = over(lambda s: F.lit(1))
    full = over(lambda s: ((total > 0) & (F.col("done_" + s) >= total)).cast("int"))
    return datasets.select("dataset", done.alias("completed_steps"), (stages * total).alias("expected_steps"),
                           F.when(stages * total > 0, done * F.lit(100e0) / (stages * total)).otherwise(0e0).alias("percent"),
                           stages.alias("n_stages"), full.alias("complete_stages"),
                           F.when((stages > 0) & (full == stages), "complete").otherwise("partial").alias("state"))


def missing_steps() -> Column:
    return F.array_compact(F.array(*[
        F.when(F.coalesce(f"expected_{s}", F.lit(True)) & ~F.coalesce(f"step_{s}", F.lit(False)), F.lit(s)) for s in STEPS]))


def risk_score(subjects: DataFrame, alarm_score: float = THRESHOLDS["alarm_score"]) -> DataFrame:
    score = F.when(F.col("score").isNull(), 75).otherwise(
        F.greatest(F.lit(0), ((F.lit(alarm_score) - F.col("score")) * 2).cast("bigint")))
    return subjects.withColumn("missing_steps", missing_steps()).withColumn(
        "risk", F.col("alarm_count") * 100 + F.col("bad_channels") + F.col("bad_segments") + score
        + (F.coalesce("reject_rate", F.lit(0e0)) * 100).cast("bigint") + F.size("missing_steps") * 25
        + F.coalesce((F.col("coreg_mean") * 10).cast("bigint"), F.lit(0)))


def threshold_counts(subjects: DataFrame, keys: list[str], thresholds: dict | None = None) -> DataFrame:
    th = {**THRESHOLDS, **(thresholds or {})}
    return subjects.groupBy(*keys).agg(
        F.count_if(F.col("score").isNull() | (F.col("score") < th["alarm_score"])).alias("over_score"),
        F.count_if(F.col("bad_channels") > th["bad_channel_threshold"]).alias("over_bad_channels"),
        F.count_if(F.col("bad_segments") > th["bad_segment_threshold"]).alias("over_bad_segments"),
        F.count_if(mean_above("coreg_mean", th["coreg_mean_threshold"])).alias("over_coreg_mean"),
        F.count_if(F.col("reject_rate") > th["epoch_reject_rate_threshold"]).alias("over_epoch_reject"),
        F.count_if(F.size(missing_steps()) > 0).alias("with_missing_steps"))


def _priority() -> list:
    rank = F.when(F.col("status") == "FAIL", 0).when(F.col("status") == "WARN", 1).otherwise(2)
    return [rank, F.desc("danger_count"), F.desc("risk"), F.col("subject").cast("string"), F.col("dataset")]


def priority_subjects(subjects: DataFrame, top: int = 12) -> DataFrame:
    """The `top` subjects to look at first (a top-k report), with their place."""
    best = subjects.where((F.col("status") != "PASS") | (F.col("alarm_count") > 0)).orderBy(*_priority()).limit(top)
    return best.withColumn("place", F.row_number().over(Window.orderBy(*_priority())))


def alarm_board(priority: DataFrame, alarm_rows: DataFrame) -> DataFrame:
    """Alarms of the priority subjects: danger first, then subject priority, then category."""
    j = alarm_rows.join(priority.select(*SUBJECT, "place"), SUBJECT)
    order = Window.orderBy(F.when(F.col("severity") == "danger", 0).otherwise(1), "place", "category", "message", "value")
    return j.withColumn("position", F.row_number().over(order))


def subjects_table(subjects: DataFrame) -> DataFrame:
    """The exported columns, in order."""
    return subjects.select(
        "subject", "status", "alarm_count", "score", "bad_channels", "bad_segments", F.col("marked_count").alias("marked_ica"),
        F.col("coreg_mean").alias("coreg_mean_mm"), F.col("coreg_max").alias("coreg_max_mm"),
        F.col("reject_rate").alias("epoch_reject_rate"),
        *[F.col(f"step_{s}").alias(s) for s in ("quality_score", "artifacts", "ica", "coregistration", "headmodel", "epochs",
                                                "covariance", "source")])


def workflow_node_status(subjects: DataFrame) -> DataFrame:
    """done / partial / missing per dataset and step."""
    n = F.count("*")
    per = subjects.groupBy("dataset").agg(n.alias("n"), *[F.count_if(f"step_{s}").alias(s) for s in STEPS])
    rows = F.array(*[F.struct(F.lit(s).alias("step"), F.col(s).alias("n_done")) for s in STEPS])
    state = F.when(F.col("n_done") == 0, "missing").when(F.col("n_done") == F.col("n"), "done").otherwise("partial")
    return per.select("dataset", "n", F.inline(rows)).select("dataset", "step", state.alias("state"))


def pick_evenly_spaced(items: DataFrame, keys: list[str], order: str, bucket: Column, k: int) -> DataFrame:
    """`k` items per group at rounded even positions; all when the group has no more."""
    indexed = dense_index(items, keys, bucket, [order], "_i").join(items.groupBy(*keys).agg(F.count("*").alias("_n")), keys)
    if k <= 1:
        return indexed.where((F.col("_i") == 0) | (F.col("_n") <= k)).drop("_i", "_n")
    # the only slots that can round to position i are those next to i * (k - 1) / (n - 1)
    near = F.floor(F.try_divide(F.col("_i") * F.lit(k - 1), F.col("_n") - 1))
    hit = F.lit(False)
    for j in (-1, 0, 1, 2):
        s = near + j
        hit = hit | (s.between(0, k - 1) & (F.bround(s * (F.col("_n") - 1) / F.lit(k - 1), 0) == F.col("_i")))
    return indexed.where((F.col("_n") <= k) | hit).drop("_i", "_n")


def select_topographies(components: DataFrame, keep: int = 6) -> DataFrame:
    """Marked components first, then by explained variance (unknown last), then by number."""
    w = Window.partitionBy("recording_id").orderBy(
        F.desc("marked"), F.when(~F.col("marked"), F.col("explained_var")).desc_nulls_last(), "component")
    return components.withColumn("position", F.row_number().over(w)).where(F.col("position") <= keep)


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns without any value: one aggregate, one row of counts to the driver."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c] > 0])


def search_and_page(df: DataFrame, columns: list[str], keyword: str, order: list, page: int, size: int) -> DataFrame:
    """Case-insensitive keyword filter over the text columns, sorted, one page."""
    blob = F.lower(F.concat_ws(" ", *columns))
    return df.where(F.contains(blob, F.lit(keyword.lower()))).orderBy(*order).offset((page - 1) * size).limit(size)


def recording_inventory(samples: DataFrame, events: DataFrame, sfreq: float) -> DataFrame:
    """Duration, channel counts by type and event counts by code, long (recording, item, value)."""
    base = samples.groupBy("recording_id").agg(
        ((F.max("t") + 1) / F.lit(sfreq)).alias("duration_s"), F.count_distinct("ch_name").cast("double").alias("n_channels"))
    base = base.select("recording_id", F.inline(F.array(
        F.struct(F.lit("duration_s").alias("item"), F.col("duration_s").alias("value")),
        F.struct(F.lit("n_channels").alias("item"), F.col("n_channels").alias("value")))))
    by_type = samples.groupBy("recording_id", F.concat(F.lit("channels:"), F.col("ch_type")).alias("item")).agg(
        F.count_distinct("ch_name").cast("double").alias("value"))
    by_code = events.groupBy("recording_id", F.concat(F.lit("events:"), F.col("event_id")).alias("item")).agg(
        F.count("*").cast("double").alias("value"))
    return base.unionByName(by_type).unionByName(by_code)


def dataset_ranking(datasets: DataFrame, name: str = "dataset") -> DataFrame:
    """Datasets by alarm count, most first, then by name (one row per dataset)."""
    return datasets.withColumn("place", F.row_number().over(Window.orderBy(F.desc("alarm_count"), name)))


def flip_gain_table(metrics: DataFrame) -> DataFrame:
    """Similarity before flipping, best after, and the gain, to three decimals. `step` 0 is the unflipped value."""
    m = metrics.groupBy("recording_id").agg(
        F.bround(F.max(F.when(F.col("step") == 0, F.col("metric"))), 3).alias("before"),
        F.bround(F.max(F.when(F.col("step") > 0, F.col("metric"))), 3).alias("after"))
    return m.withColumn("gain", F.bround(F.col("after") - F.col("before"), 3))

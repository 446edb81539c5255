"""Readers and writers on files that Spark derives from the given tables."""

from pyspark.sql import functions as F

from ..functions.expr import r6
from ..operators import components
from ..plans.blocks import pack_blocks, unpack_blocks
from ..session import scratch_folder
from ..sources import readers
from ..sources.bindings import with_views
from . import query
from .components import KIND, library
from .rollups import DS, SS, datasets, judged
from .scoring import CAND, REF, looked_up


@query("read_events_tsv", "SELECT event_type AS trial_type, value AS onset, CAST(floor(value) AS BIGINT)::VARCHAR AS code FROM events")
def _(t):
    path = scratch_folder(t.spark) + "/events"
    t.table("events").select(F.col("value").alias("onset"), F.col("event_type").alias("trial_type"), F.floor("value").cast("bigint").alias("code")) \
        .write.mode("overwrite").csv(path, sep="\t", header=True)
    return readers.read_events_tsv(t.spark, path, ("onset", "trial_type"))


@query("read_annotations_txt", with_views("SELECT onset, duration, description FROM annotations", "annotations"))
def _(t):
    path = scratch_folder(t.spark) + "/annotations"
    a = t.annotations().select(F.concat_ws(",", "onset", "duration", "description").alias("line"), F.monotonically_increasing_id().alias("i"))
    a.withColumn("line", F.explode(F.array(F.lit("# onset, duration, description"), "line"))).select("line").write.mode("overwrite").text(path)
    return readers.read_annotations_txt(t.spark, path)


@query("read_bad_channels_txt", "SELECT DISTINCT event_type || '_' || user_id AS ch_name FROM events WHERE value > 100")
def _(t):
    path = scratch_folder(t.spark) + "/bads"
    names = t.table("events").where("value > 100").select(F.concat("event_type", F.lit("_"), "user_id").alias("n")).distinct()
    names.select(F.explode(F.array(F.concat(F.lit("  "), "n"), F.lit(" "))).alias("line")).write.mode("overwrite").text(path)
    return readers.read_bad_channels_txt(t.spark, path)


@query("sample_blocks", with_views("SELECT recording_id, ch_name, t, value FROM samples", "samples"))
def _(t):
    keys = ["recording_id", "ch_name"]
    return unpack_blocks(pack_blocks(t.samples(), keys), keys)


@query("write_component_scores", with_views(REF + CAND + """
SELECT recording_id::VARCHAR AS recording_id, reference_scope, round(least(1e0, greatest(0e0, (value - q05) / (q95 - q05))), 6) AS score FROM lk""", "metrics"))
def _(t):
    from ..operators import scoring

    path = scratch_folder(t.spark) + "/components"
    empty = [F.lit("").alias(c) for c in ("family", "domain")]
    scored = looked_up(t).withColumn("mode", F.lit("higher_is_better")).select(
        "*", *empty, scoring.component_score().alias("score"), scoring.reference_position().alias("position"),
        scoring.component_status().alias("status"), scoring.direction_label(F.col("mode")).alias("direction"),
        scoring.component_type(F.col("metric")).alias("component_type"))
    readers.write_component_scores(scored, path)
    back = t.spark.read.csv(path, header=True)
    return back.select("recording_id", "reference_scope", r6(F.col("score").cast("double")).alias("score"))


@query("write_subjects", with_views(SS + "SELECT dataset, subject::VARCHAR AS subject, status, alarm_count::VARCHAR AS alarm_count FROM ss", "subjects"))
def _(t):
    path = scratch_folder(t.spark) + "/subjects"
    readers.write_subjects(judged(t).select("dataset", "subject", "status", "alarm_count"), path)
    return t.spark.read.csv(path, header=True).withColumn("dataset", F.col("dataset").cast("int"))


@query("write_datasets", with_views(DS + "SELECT dataset, total_subjects, fail_count, round(avg_score, 6) AS avg_score FROM ds", "subjects"))
def _(t):
    path = scratch_folder(t.spark) + "/datasets"
    readers.write_datasets(datasets(t), path)
    back = t.spark.read.schema("dataset int, total_subjects bigint, fail_count bigint, avg_score double").json(path)
    return back.withColumn("avg_score", r6("avg_score"))


@query("write_prob_tables", with_views("SELECT recording_id, win::VARCHAR AS win, fold::VARCHAR AS fold, round(prob, 6) AS prob FROM probs", "probs"))
def _(t):
    path = scratch_folder(t.spark) + "/probs"
    readers.write_prob_tables(t.probs(), path)
    return t.spark.read.csv(path, header=True, sep="\t").withColumn("prob", r6(F.col("prob").cast("double")))


@query("write_template_library", with_views(f"SELECT 'dev' || (label % 2) AS device_type, {KIND} AS kind, count(DISTINCT label) * 2 AS n FROM topo GROUP BY 1, 2", "topo"))
def _(t):
    path = scratch_folder(t.spark) + "/templates"
    components.write_template_library(library(t), path, "new")
    components.write_template_library(library(t), path, "append")
    return t.spark.read.parquet(path).groupBy("device_type", "kind").agg(F.count("*").alias("n"))

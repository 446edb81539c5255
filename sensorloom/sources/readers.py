"""Readers for sidecars, traces, quality outputs and sensor matrices; writers with fixed column orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.scans import prefix_scan

ANNOTATION_SCHEMA = "onset double, duration double, description string"


def read_events_tsv(spark: SparkSession, path: str, required: tuple[str, ...] = ("onset",)) -> DataFrame:
    """Event sidecar: header-driven text columns, byte-order mark stripped, required columns checked."""
    df = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    df = df.withColumnsRenamed({c: c.lstrip("﻿").strip() for c in df.columns})
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    return df.withColumn("onset", F.col("onset").try_cast("double"))


def read_annotations_txt(spark: SparkSession, path: str) -> DataFrame:
    """Comment-headed onset, duration, description rows."""
    return spark.read.schema(ANNOTATION_SCHEMA).csv(path, comment="#", ignoreLeadingWhiteSpace=True)


def read_bad_channels_txt(spark: SparkSession, path: str) -> DataFrame:
    """One channel per line; blank lines dropped."""
    return spark.read.text(path).select(F.trim("value").alias("ch_name")).where("ch_name <> ''")


def read_trace(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated task trace with NUL bytes removed; `name` split into process, tag, dataset and subject."""
    from ..operators.rollups import parse_task_name

    df = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    df = df.select(*[F.translate(F.col(f"`{c}`"), "\0", "").alias(c.replace("\0", "").strip()) for c in df.columns])
    return df.select("*", *[c.alias(n) for n, c in parse_task_name(F.col("name")).items()])


def list_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Names and modification times below a folder, without reading file contents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("modificationTime").alias("mtime"), F.col("length").alias("size"))


def pick_quality_outputs(files: DataFrame, key: str = "recording_id") -> DataFrame:
    """Per recording the newest summary with its complete triplet, else the newest summary.

    `files(recording_id, name, mtime)`. One aggregation per prefix, then the best per recording by maximum.
    """
    suffixes = {"summary": ".summary.json", "components": ".component_scores.csv", "plot": ".normative_quality_score.png"}
    kind, prefix = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, s in suffixes.items():
        hit = F.endswith(F.col("name"), F.lit(s))
        kind = F.when(hit, k).otherwise(kind)
        prefix = F.when(hit, F.expr(f"substring(name, 1, length(name) - {len(s)})")).otherwise(prefix)
    f = files.withColumn("_kind", kind).withColumn("prefix", prefix).where("_kind is not null")
    sets = f.groupBy(key, "prefix").agg(
        F.max(F.when(F.col("_kind") == "summary", F.col("mtime"))).alias("mtime"),
        *[F.bool_or(F.col("_kind") == k).alias("has_" + k) for k in suffixes]).where("has_summary")
    complete = F.col("has_components") & F.col("has_plot")
    best = F.max(F.struct(complete.alias("complete"), "mtime", "prefix", "has_components", "has_plot"))
    return sets.groupBy(key).agg(best.alias("b")).select(key, "b.*")


def read_quality_summaries(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Summary JSON documents with a declared schema."""
    return spark.read.schema(schema).json(path, multiLine=True, recursiveFileLookup=True, pathGlobFilter="*.summary.json")


def parse_epoch_reject_log(text: Column) -> dict[str, Column]:
    """Rejected ids on the first line, `name:count` of remaining epochs on the second."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda v: F.trim(v)), lambda v: v != "")
    ids = F.from_json(F.get(lines, F.lit(0)), "array<bigint>")
    remaining = F.trim(F.substring_index(F.get(lines, F.lit(1)), ":", -1)).try_cast("bigint")
    remaining = F.when(F.contains(F.get(lines, F.lit(1)), F.lit(":")), remaining)
    n = F.when(F.size(lines) > 0, F.coalesce(F.size(ids), F.lit(0)))
    total = remaining + n
    return {"rejected": ids, "n_rejected": n, "remaining": remaining, "total": total, "reject_rate": F.when(total > 0, n / total)}


# ---------------------------------------------------------------- sensor matrices

def matrix_to_samples(matrix: DataFrame, sensors: DataFrame) -> DataFrame:
    """Wide rows (recording, row, values) + sensor table -> long samples; counts must agree.

    `sensors(recording_id, row, ch_name, ch_type)`.
    """
    missing = [c for c in ("recording_id", "row", "ch_name", "ch_type") if c not in sensors.columns]
    if missing:
        raise ValueError(f"sensor table: missing columns {missing}")
    rows = matrix.groupBy("recording_id").agg(F.count("*").alias("_m"))
    names = sensors.groupBy("recording_id").agg(F.count("*").alias("_s"))
    audit = rows.join(names, "recording_id", "left").where(F.assert_true(
        F.coalesce(F.col("_m") == F.col("_s"), F.lit(False)), F.lit("matrix rows and sensors differ")).isNull())
    j = matrix.join(sensors, ["recording_id", "row"]).join(audit.select("recording_id"), "recording_id", "left_semi")
    return j.select("recording_id", "ch_name", "ch_type", F.posexplode("values").alias("t", "value")).withColumn("t", F.col("t").cast("bigint"))


def clock(recordings: DataFrame, chunk: int = 1 << 16) -> DataFrame:
    """Every sample index of each recording, in chunks so that no long array is ever built."""
    blocks = recordings.select("recording_id", "n_times", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n_times") - 1) / chunk).cast("bigint"))).alias("_b"))
    start = F.col("_b") * chunk
    return blocks.select("recording_id", F.explode(F.sequence(start, F.least(start + chunk, F.col("n_times")) - 1)).alias("t"))


def events_to_stim(events: DataFrame, recordings: DataFrame, width: int, bucket: int = 1 << 16) -> DataFrame:
    """Trigger channel with each event held for `width` samples; bad event tables are errors."""
    j = events.join(recordings.select("recording_id", "n_times"), "recording_id")
    ok = (F.col("sample") >= 0) & (F.col("sample") + width <= F.col("n_times")) & (F.col("event_id") > 0)
    j = j.where(F.assert_true(ok, F.lit("event outside the recording or with a non-positive id")).isNull())
    seen = prefix_scan(j, ["recording_id"], F.floor(F.col("sample") / bucket).cast("bigint"), ["sample"],
                       {"_prev": ("max", "sample")}, inclusive=False)
    spaced = F.col("_prev").isNull() | (F.col("sample") - F.col("_prev") > width)
    checked = seen.where(F.assert_true(spaced, F.lit("events must leave a zero sample between pulses")).isNull())
    pulses = checked.select("recording_id", F.explode(F.sequence(F.col("sample"), F.col("sample") + width - 1)).alias("t"), "event_id")
    return clock(recordings).join(pulses, ["recording_id", "t"], "left").select(
        "recording_id", "t", F.coalesce("event_id", F.lit(0)).alias("value"))


def triggers_to_stim(triggers: DataFrame, recordings: DataFrame, bucket: int = 1 << 16) -> DataFrame:
    """Step function: a trigger value holds until the next one; 0 before the first."""
    marks = triggers.select("recording_id", F.col("sample").alias("t"), F.col("value").alias("_v"))
    axis = clock(recordings).join(marks, ["recording_id", "t"], "left")
    held = prefix_scan(axis, ["recording_id"], F.floor(F.col("t") / bucket).cast("bigint"), ["t"], {"value": ("last", "_v")})
    return held.select("recording_id", "t", F.coalesce("value", F.lit(0)).alias("value"))


# ------------------------------------------------------------------------- sinks

COMPONENT_COLUMNS = [
    "recording_id", "family", "domain", "metric", "component_type", "value", "mode", "direction", "reference_scope",
    "reference_device", "reference_category", "q05", "q50", "q95", "position", "score", "status",
]


def write_component_scores(scores: DataFrame, path: str) -> None:
    scores.select(*COMPONENT_COLUMNS).write.mode("overwrite").csv(path, header=True)


def write_subjects(table: DataFrame, path: str) -> None:
    """Subject table as CSV, one folder per dataset."""
    table.write.mode("overwrite").partitionBy("dataset").csv(path, header=True)


def write_datasets(summary: DataFrame, path: str) -> None:
    summary.write.mode("overwrite").json(path, ignoreNullFields=False)


def write_prob_tables(probs: DataFrame, path: str) -> None:
    """Per-item fold probabilities as tab-separated text, one folder per recording group."""
    flat = [F.col(f.name) for f in probs.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    probs.select(*flat).write.mode("overwrite").csv(path, header=True, sep="\t")

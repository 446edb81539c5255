"""Readers, sinks and the incremental stream on real files."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.sources import catalogue, readers
from sensorloom.streaming.incremental import bucket_of, incremental_metrics, latest, rows_of


def test_events_tsv_with_bom(spark, tmp_path):
    p = tmp_path / "events.tsv"
    p.write_bytes("﻿onset\tduration\ttrial_type\tvalue\n1.5\t0\tgo\t3\nn/a\t0\tstop\t4\n".encode())
    rows = readers.read_events_tsv(spark, str(p), ("onset", "trial_type")).collect()
    assert [r["onset"] for r in rows] == [1.5, None] and rows[0]["trial_type"] == "go"
    with pytest.raises(ValueError):
        readers.read_events_tsv(spark, str(p), ("sample",))


def test_annotation_and_bad_channel_text(spark, tmp_path):
    a = tmp_path / "a.txt"
    a.write_text("# annotations\n# onset, duration, description\n1.25, 0.5, BAD_x\n7.0, 1.0, edge\n")
    assert [tuple(r) for r in readers.read_annotations_txt(spark, str(a)).collect()] == [(1.25, 0.5, "BAD_x"), (7.0, 1.0, "edge")]
    b = tmp_path / "b.txt"
    b.write_text("MEG0111\n\n  MEG0122 \n")
    assert [r[0] for r in readers.read_bad_channels_txt(spark, str(b)).collect()] == ["MEG0111", "MEG0122"]


def test_trace(spark, tmp_path):
    p = tmp_path / "trace.txt"
    p.write_text("name\tstatus\texit\nrun_ica (ds1:sub-01)\tCOMPLETED\t0\nreport\0\tFAILED\t1\nepochs (sub-02)\tCACHED\t-\n")
    rows = {r["process"]: r for r in readers.read_trace(spark, str(p)).collect()}
    assert rows["run_ica"]["tag_dataset"] == "ds1" and rows["run_ica"]["tag_subject"] == "sub-01"
    assert rows["report"]["tag"] is None and rows["epochs"]["tag_subject"] == "sub-02" and rows["epochs"]["tag_dataset"] is None


def test_quality_outputs_prefer_complete(spark, tmp_path):
    for name in ("a.summary.json", "a.component_scores.csv", "a.normative_quality_score.png", "b.summary.json"):
        (tmp_path / name).write_text('{"score_0_100": 81.5}')
    files = readers.list_files(spark, str(tmp_path), "*").select(F.lit(1).alias("recording_id"), F.element_at(F.split("path", "/"), -1).alias("name"), "mtime")
    assert readers.pick_quality_outputs(files).first()["prefix"] == "a"
    scores = readers.read_quality_summaries(spark, str(tmp_path), "score_0_100 double")
    assert [r[0] for r in scores.collect()] == [81.5, 81.5]


def test_reject_log_forms(spark):
    df = spark.createDataFrame([("[1, 4]\nnum_epochs:6\n",), ("[]\n",), ("",), ("oops\nnum_epochs:3",)], "text string")
    c = readers.parse_epoch_reject_log(F.col("text"))
    rows = df.select(c["n_rejected"].alias("n"), c["remaining"].alias("m"), c["reject_rate"].alias("r")).collect()
    assert [tuple(r) for r in rows] == [(2, 6, 0.25), (0, None, None), (None, None, None), (0, 3, 0.0)]


def test_sinks(spark, tmp_path):
    subjects = spark.createDataFrame([("d1", "s1", "PASS"), ("d2", "s2", "FAIL")], "dataset string, subject string, status string")
    readers.write_subjects(subjects, str(tmp_path / "s"))
    assert spark.read.csv(str(tmp_path / "s"), header=True).where("dataset = 'd2'").first()["subject"] == "s2"
    readers.write_datasets(subjects.groupBy("dataset").agg(F.max(F.lit(None).cast("double")).alias("avg_score")), str(tmp_path / "d"))
    assert "avg_score" in spark.read.schema("dataset string, avg_score double").json(str(tmp_path / "d")).columns
    probs = spark.createDataFrame([("r", 1, 0.5, [0.1])], "recording_id string, item int, prob double, raw array<double>")
    readers.write_prob_tables(probs, str(tmp_path / "p"))
    assert spark.read.csv(str(tmp_path / "p"), header=True, sep="\t").columns == ["recording_id", "item", "prob"]
    scores = spark.range(1).select(*[F.lit("x").alias(c) for c in reversed(readers.COMPONENT_COLUMNS)])
    readers.write_component_scores(scores, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).columns == readers.COMPONENT_COLUMNS


def test_matrix_needs_matching_sensors(spark):
    m = spark.createDataFrame([(1, 0, [1.0, 2.0]), (1, 1, [3.0, 4.0])], "recording_id int, row int, values array<double>")
    s = spark.createDataFrame([(1, 0, "A", "mag"), (1, 1, "B", "mag")], "recording_id int, row int, ch_name string, ch_type string")
    assert {(r["ch_name"], r["t"], r["value"]) for r in readers.matrix_to_samples(m, s).collect()} == {("A", 0, 1.0), ("A", 1, 2.0), ("B", 0, 3.0), ("B", 1, 4.0)}
    with pytest.raises(Exception, match="differ"):
        readers.matrix_to_samples(m, s.limit(1)).collect()
    with pytest.raises(ValueError):
        readers.matrix_to_samples(m, s.drop("ch_type"))


def test_clock_in_chunks(spark):
    recs = spark.createDataFrame([(1, 10), (2, 7)], "recording_id int, n_times long")
    assert readers.clock(recs, chunk=3).groupBy("recording_id").agg(F.count("*"), F.max("t")).orderBy("recording_id").collect() == [(1, 10, 9), (2, 7, 6)]


def test_fallback_t1(spark):
    f = spark.createDataFrame([("a", "/a/sub-1/anat/sub-1_T1w.nii.gz"), ("a", "/a/sub-2/anat/sub-2_T1.nii"), ("b", "/b/sub-1/anat/sub-1_T1_defaced.nii"),
                               ("b", "/b/derivatives/sub-9/sub-9_T1w.nii"), ("b", "/b/sub-2/x_T2w.nii")], "dataset string, path string")
    got = {(r["dataset"], r["subject"]): r["files"] for r in catalogue.select_t1_files(f).collect()}
    assert set(got) == {("a", "sub-1"), ("b", "sub-1")}


SCHEMA = T.StructType([T.StructField("recording_id", T.LongType()), T.StructField("t", T.LongType()), T.StructField("value", T.DoubleType())])


def metrics(df):
    return df.groupBy("recording_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def test_incremental_only_touches_what_changed(spark, tmp_path):
    src, store, ckpt = (str(tmp_path / d) for d in ("src", "store", "ckpt"))

    def add(name, rows):
        pd.DataFrame(rows, columns=["recording_id", "t", "value"]).astype({"value": float}).to_parquet(f"{src}/{name}.parquet")

    def run():
        incremental_metrics(spark, src, SCHEMA, store, ckpt, lambda d: d, metrics).awaitTermination()
        batches = {}
        for r in spark.read.parquet(store).collect():
            batches.setdefault(r["batch"], set()).add(r["recording_id"])
        return batches, {r["recording_id"]: (r["n"], r["total"]) for r in latest(spark, store).collect()}

    (tmp_path / "src").mkdir()
    add("one", [(1, 0, 1), (1, 1, 2), (2, 0, 5)])
    batches, now = run()
    assert batches == {0: {1, 2}} and now == {1: (2, 3.0), 2: (1, 5.0)}
    add("two", [(3, 0, 7), (2, 1, 6)])
    batches, now = run()
    assert batches[1] == {2, 3} and now == {1: (2, 3.0), 2: (2, 11.0), 3: (1, 7.0)}
    batches, _ = run()
    assert set(batches) == {0, 1}
    by_id = {r["id"]: r["b"] for r in spark.range(4).select("id", bucket_of("id", 256).alias("b")).collect()}
    read = rows_of(spark, store + "-rows", SCHEMA, [by_id[3]], 1)
    assert {r["recording_id"] for r in read.collect()} == {i for i in (1, 2, 3) if by_id[i] == by_id[3]}
    files = {r["f"] for r in read.select(F.input_file_name().alias("f")).collect()}
    assert files and all(f"/batch=1/bucket={by_id[3]}/" in f for f in files)


def test_states_merge_and_read_the_touched_buckets_only(spark, tmp_path, monkeypatch):
    """States after many small batches equal those of all rows at once, and a batch opens no more state files than it touches buckets."""
    from sensorloom.streaming import incremental

    rng = np.random.default_rng(5)
    store, batches = str(tmp_path / "store"), []
    for i in range(6):
        ids = rng.choice(12, 3, replace=False)
        batches.append([(int(r), 100 * i + t, None if t == 7 else float(1e6 + rng.normal())) for r in ids for t in range(10)])
    opened = []
    plain = incremental.read_states
    monkeypatch.setattr(incremental, "read_states", lambda spark, store, newest, schema: opened.append(len(newest)) or plain(spark, store, newest, schema))
    for i, rows in enumerate([*batches, batches[-1]]):  # the last one runs twice
        df = spark.createDataFrame(rows, SCHEMA)
        incremental.merge_batch(df, min(i, 5), store, "recording_id", "t", "value", 16)
    assert max(opened) <= 3
    every = spark.createDataFrame([r for b in batches for r in b], SCHEMA)
    key = "recording_id"
    got = incremental.summary(incremental.newest_states(spark, store), key).toPandas().sort_values(key).reset_index(drop=True)
    want = incremental.summary(incremental.partial_states(every, key, "t", "value"), key).toPandas().sort_values(key).reset_index(drop=True)
    assert (got["content_hash"] == want["content_hash"]).all() and (got["n_samples"] == want["n_samples"]).all()
    for c in ("mean", "std", "ptp", "first", "last"):
        np.testing.assert_allclose(got[c], want[c], rtol=1e-9)


def test_folders_without_a_scheme_lie_in_the_default_file_system(spark, tmp_path):
    from sensorloom.session import qualified

    assert qualified(spark, "hdfs://host/a") == "hdfs://host/a" and qualified(spark, f"file://{tmp_path}") == f"file://{tmp_path}"
    assert qualified(spark, str(tmp_path)) == f"file://{tmp_path}"
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    try:
        conf.set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_path}")
        conf.set("fs.defaultFS", "viewfs://store/")
        assert qualified(spark, "/in/x") == "viewfs://store/in/x"
    finally:
        conf.set("fs.defaultFS", before)

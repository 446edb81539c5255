"""Incremental metrics: the events file as the first state of a growing folder."""

from pyspark.sql import functions as F

from ..functions.expr import r6
from ..operators.lineage import content_hash
from ..session import scratch_folder
from ..streaming.incremental import incremental_metrics, incremental_states, latest, newest_states, summary
from . import query


def derive(events):
    return events.select((F.col("user_id") % 20).alias("recording_id"), F.col("event_type").alias("ch_name"), "event_id", "value")


def metrics(samples):
    return samples.groupBy("recording_id").agg(
        F.count("*").alias("n_samples"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        (F.max("value") - F.min("value")).alias("ptp"))


@query("incremental_metrics", """
SELECT user_id % 20 AS recording_id, count(*) AS n_samples, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(max(value) - min(value), 6) AS ptp FROM events GROUP BY 1""")
def _(t):
    spark, base = t.spark, scratch_folder(t.spark)
    events = t.table("events")
    run = incremental_metrics(spark, t.dir, events.schema, base + "/store", base + "/checkpoint", derive, metrics,
                              pathGlobFilter="events.parquet")
    run.awaitTermination()
    return latest(spark, base + "/store").select("recording_id", "n_samples", *[r6(c).alias(c) for c in ("mean", "std", "ptp")])


HASH = """SELECT recording_id, count(*) AS n, bit_xor(h) AS x, sum(CAST(h AS HUGEINT)) AS y FROM (SELECT recording_id, CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT) AS h FROM {source}) GROUP BY 1"""


@query("content_hash", "SELECT recording_id, sha256(n || ':' || x || ':' || y) AS content_hash FROM ("
       + HASH.format(text="ch_name || chr(31) || event_id || chr(31) || value", source="(SELECT user_id % 20 AS recording_id, event_type AS ch_name, event_id, value FROM events)") + ")")
def _(t):
    return content_hash(derive(t.table("events")), ["recording_id"], ["ch_name", "event_id", "value"])


@query("incremental_states", f"""WITH s AS (SELECT user_id % 20 AS recording_id, event_id AS t, value FROM events), h AS ({HASH.format(text="t || chr(31) || value", source="s")}),
m AS (SELECT recording_id, count(*) AS n_samples, avg(value) AS mean, stddev_pop(value) AS std, max(value) - min(value) AS ptp, arg_min(value, t) AS first, arg_max(value, t) AS last FROM s GROUP BY 1)
SELECT recording_id, n_samples, round(mean, 6) AS mean, round(std, 6) AS std, round(ptp, 6) AS ptp, first, last, sha256(n || ':' || x || ':' || y) AS content_hash FROM m JOIN h USING (recording_id)""")
def _(t):
    spark, base = t.spark, scratch_folder(t.spark)
    events = t.table("events")
    run = incremental_states(spark, t.dir, events.schema, base + "/store", base + "/checkpoint",
                             lambda e: e.select((F.col("user_id") % 20).alias("recording_id"), F.col("event_id").alias("t"), "value"), pathGlobFilter="events.parquet")
    run.awaitTermination()
    out = summary(newest_states(spark, base + "/store"), "recording_id")
    return out.withColumns({c: r6(c) for c in ("mean", "std", "ptp")})

"""Views of the given tables in the engine's data model, with their SQL definitions.

`Tables` builds each view lazily with the DataFrame API; `SQL` holds the equivalent common
table expressions that the SQL twins of the queries are prefixed with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels
from ..plans.scans import dense_index
from ..session import configure, materialize

EPOCH_US = 1704067200000000  # 2024-01-01 UTC

SQL = {
    "samples": "SELECT 'ds' || (user_id % 4) AS dataset, user_id % 20 AS recording_id, event_type AS ch_name, CASE WHEN event_type IN ('click','view','error') THEN 'mag' ELSE 'grad' END AS ch_type, row_number() OVER (PARTITION BY user_id % 20, event_type ORDER BY ts, event_id) - 1 AS t, value FROM events",
    "annotations": "SELECT user_id % 20 AS recording_id, (epoch_us(ts) - 1704067200000000) / 1e6 AS onset, value * 10 AS duration, CASE WHEN value > 150 THEN 'BAD_amp' ELSE event_type END AS description, event_id AS source_id FROM events WHERE value > 120",
    "triggers": "SELECT user_id % 20 AS recording_id, (epoch_us(ts) - 1704067200000000) // 60000000 AS sample, CASE event_type WHEN 'purchase' THEN 1 ELSE 2 END AS event_id, event_id AS source_id FROM events WHERE event_type IN ('purchase','signup') AND value > 100",
    "probs": "SELECT event_type AS recording_id, CAST((epoch_us(ts) - 1704067200000000) // 3600000000 AS BIGINT) AS win, user_id % 5 AS fold, least(1e0, avg(value) / 100) AS prob FROM events GROUP BY 1,2,3",
    "topo": "SELECT vec_id AS component, label, i - 1 AS ch, embedding[i] AS weight FROM embeddings, range(1, 65) r(i)",
    "metrics": "SELECT p_type AS device_type, CASE WHEN p_size % 2 = 0 THEN 'rest' ELSE 'task' END AS category, p_partkey AS recording_id, 'retailprice' AS metric, p_retailprice AS value FROM part",
    "trace": "SELECT o_orderkey AS task_id, o_orderpriority AS process, 'ds' || (o_custkey % 4) || ':sub-' || (o_custkey % 50) AS tag, CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'COMPLETED' ELSE 'CACHED' END AS status, CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END AS exit, o_totalprice AS duration FROM orders",
    "subjects": "SELECT s_nationkey AS dataset, s_suppkey AS subject, count(*) FILTER (l_returnflag = 'R' AND l_discount > 0.085) AS bad_channels, count(*) FILTER (l_linestatus = 'F' AND l_tax > 0.07) AS bad_segments, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE avg(l_quantity) * 2.75e0 END AS score, avg(l_discount) * 100 AS coreg_mean, count(*) / 32e0 AS coreg_max, least(1e0, 2.7e0 * avg(CASE WHEN l_returnflag = 'A' THEN 1e0 ELSE 0e0 END)) AS reject_rate FROM supplier JOIN lineitem ON s_suppkey = l_suppkey GROUP BY 1, 2",
    "labelings": "SELECT doc_id AS component, quality AS a_label, toxic AS b_label FROM labels",
    "paths": "SELECT page_id, url AS path FROM pages",
    "event_rows": "SELECT event_id, event_type AS trial_type, value, props FROM events",
    "points": "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z, label % 2 AS side FROM embeddings",
}


def with_views(body: str, *names: str) -> str:
    """Prefix a SELECT with the named views; a body may start with `,` to add its own expressions."""
    return "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in names) + " " + body.strip()


def fir_sql(taps, name: str = "fx", source: str = "samples") -> str:
    """SQL twin of a zero-phase FIR with mirrored edges over `source` (recording_id, ch_name, t, value), as expressions to append to a view."""
    values = ", ".join(f"({j}, {float(h)!r}::DOUBLE)" for j, h in enumerate(taps))
    half = len(taps) // 2
    at = (f"CASE WHEN s.t + j - {half} < 0 THEN least({half} - j - s.t, n - 1) "
          f"WHEN s.t + j - {half} > n - 1 THEN greatest(2 * (n - 1) - (s.t + j - {half}), 0) ELSE s.t + j - {half} END")
    return (f", {name}_t AS (SELECT * FROM (VALUES {values}) v(j, h)), "
            f"{name}_s AS (SELECT s.recording_id, s.ch_name, s.t, s.value, j, h, {at} AS k FROM (SELECT *, count(*) OVER "
            f"(PARTITION BY recording_id, ch_name) AS n FROM {source}) s, {name}_t), "
            f"{name} AS (SELECT a.recording_id, a.ch_name, a.t, any_value(a.value) AS value, sum(h * b.value) AS y FROM {name}_s a "
            f"JOIN {source} b ON b.recording_id = a.recording_id AND b.ch_name = a.ch_name AND b.t = a.k GROUP BY 1, 2, 3) ")


def resample_sql(up: int, down: int, half: int, name: str = "rs", source: str = "samples") -> str:
    """SQL twin of the polyphase resampling: the weights of every phase as a table, joined to the outputs."""
    weights = kernels.phase_weights(range(up), up, down, half)
    reach = weights.shape[1] // 2
    values = ", ".join(f"({p}, {j - reach + 1}, {float(w)!r}::DOUBLE)" for p, row in enumerate(weights) for j, w in enumerate(row))
    return (f", {name}_w AS (SELECT * FROM (VALUES {values}) v(phase, j, w)), "
            f"{name}_n AS (SELECT recording_id, ch_name, max(t) AS last FROM {source} GROUP BY 1, 2), "
            f"{name}_k AS (SELECT recording_id, ch_name, last, unnest(range(0, last * {up} // {down} + 1)) AS k FROM {name}_n), "
            f"{name} AS (SELECT a.recording_id, a.ch_name, k AS t, sum(w * b.value) AS y FROM {name}_k a JOIN {name}_w ON phase = k * {down} % {up} "
            f"JOIN {source} b ON b.recording_id = a.recording_id AND b.ch_name = a.ch_name AND b.t = least(greatest(k * {down} // {up} + j, 0), last) GROUP BY 1, 2, 3) ")


def micros(column: str = "ts") -> Column:
    return F.unix_micros(F.col(column).cast("timestamp")) - F.lit(EPOCH_US)


class Tables:
    """The given tables under one directory, and the views derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.dir = str(sf_dir).rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def samples(self) -> DataFrame:
        e = self.table("events").select(
            F.concat(F.lit("ds"), F.col("user_id") % 4).alias("dataset"),
            (F.col("user_id") % 20).alias("recording_id"),
            F.col("event_type").alias("ch_name"),
            F.when(F.col("event_type").isin("click", "view", "error"), "mag").otherwise("grad").alias("ch_type"),
            "ts", "event_id", "value",
        )
        day = F.floor(micros() / F.lit(86_400_000_000)).cast("bigint")
        return dense_index(e, ["recording_id", "ch_name"], day, ["ts", "event_id"]).select(
            "dataset", "recording_id", "ch_name", "ch_type", "t", "value"
        )

    def samples_once(self) -> DataFrame:
        """The samples view as a written table, for operators that read it in several passes: the view is derived once."""
        return materialize(self.samples())

    def annotations(self) -> DataFrame:
        return self.table("events").where("value > 120").select(
            (F.col("user_id") % 20).alias("recording_id"),
            (micros() / F.lit(1e6)).alias("onset"),
            (F.col("value") * 10).alias("duration"),
            F.when(F.col("value") > 150, "BAD_amp").otherwise(F.col("event_type")).alias("description"),
            F.col("event_id").alias("source_id"),
        )

    def triggers(self) -> DataFrame:
        return self.table("events").where("event_type in ('purchase', 'signup') and value > 100").select(
            (F.col("user_id") % 20).alias("recording_id"),
            F.floor(micros() / F.lit(60_000_000)).cast("bigint").alias("sample"),
            F.when(F.col("event_type") == "purchase", 1).otherwise(2).alias("event_id"),
            F.col("event_id").alias("source_id"),
        )

    def probs(self) -> DataFrame:
        return self.table("events").groupBy(
            F.col("event_type").alias("recording_id"),
            F.floor(micros() / F.lit(3_600_000_000)).cast("bigint").alias("win"),
            (F.col("user_id") % 5).alias("fold"),
        ).agg(F.least(F.lit(1e0), F.avg("value") / 100).alias("prob"))

    def topo(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("component"), "label", F.posexplode("embedding").alias("ch", "weight"))

    def metrics(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_type").alias("device_type"),
            F.when(F.col("p_size") % 2 == 0, "rest").otherwise("task").alias("category"),
            F.col("p_partkey").alias("recording_id"), F.lit("retailprice").alias("metric"),
            F.col("p_retailprice").alias("value"))

    def trace(self) -> DataFrame:
        failed = F.col("o_orderstatus") == "F"
        return self.table("orders").select(
            F.col("o_orderkey").alias("task_id"), F.col("o_orderpriority").alias("process"),
            F.concat(F.lit("ds"), F.col("o_custkey") % 4, F.lit(":sub-"), F.col("o_custkey") % 50).alias("tag"),
            F.when(failed, "FAILED").when(F.col("o_orderstatus") == "O", "COMPLETED").otherwise("CACHED").alias("status"),
            F.when(failed, "1").otherwise("0").alias("exit"), F.col("o_totalprice").alias("duration"))

    def subjects(self) -> DataFrame:
        line = self.table("lineitem").groupBy("l_suppkey").agg(
            F.count_if((F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.085)).alias("bad_channels"),
            F.count_if((F.col("l_linestatus") == "F") & (F.col("l_tax") > 0.07)).alias("bad_segments"),
            F.avg("l_quantity").alias("q"), (F.avg("l_discount") * 100).alias("coreg_mean"),
            (F.count("*") / F.lit(32e0)).alias("coreg_max"),
            F.least(F.lit(1e0), F.lit(2.7e0) * F.avg(F.when(F.col("l_returnflag") == "A", 1e0).otherwise(0e0)))
            .alias("reject_rate"))
        return line.join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(
            F.col("s_nationkey").alias("dataset"), F.col("s_suppkey").alias("subject"), "bad_channels", "bad_segments",
            F.when(F.col("s_suppkey") % 7 != 0, F.col("q") * 2.75e0).alias("score"), "coreg_mean", "coreg_max",
            "reject_rate")

    def labelings(self) -> DataFrame:
        return self.table("labels").select(
            F.col("doc_id").alias("component"), F.col("quality").alias("a_label"), F.col("toxic").alias("b_label"))

    def paths(self) -> DataFrame:
        return self.table("pages").select("page_id", F.col("url").alias("path"))

    def event_rows(self) -> DataFrame:
        return self.table("events").select("event_id", F.col("event_type").alias("trial_type"), "value", "props")

    def points(self) -> DataFrame:
        e = F.col("embedding")
        return self.table("embeddings").select(
            "vec_id", e[0].cast("double").alias("x"), e[1].cast("double").alias("y"), e[2].cast("double").alias("z"),
            (F.col("label") % 2).alias("side"))

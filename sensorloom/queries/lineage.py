"""Joins between stages."""

from pyspark.sql import functions as F

from ..operators import lineage as op
from ..sources.bindings import with_views
from . import query

PAIRS = """WITH p AS (SELECT page_id, 'ds' || (page_id % 2) AS dataset, page_id // 12 AS sub, CASE page_id % 12 WHEN 0 THEN 'emptr' WHEN 1 THEN 'emptr' ELSE 't' || (page_id % 12) END AS task FROM pages),
r AS (SELECT *, '/d/' || dataset || '/sub-' || sub || '_task-' || task || '_meg.fif' AS path FROM p) """


def paths(t):
    p = F.col("page_id")
    task = F.when(p % 12 < 2, "emptr").otherwise(F.concat(F.lit("t"), p % 12))
    ds = F.concat(F.lit("ds"), p % 2)
    return t.table("pages").select("page_id", ds.alias("dataset"), task.alias("task"), F.concat(
        F.lit("/d/"), ds, F.lit("/sub-"), F.floor(p / 12).cast("bigint"), F.lit("_task-"), task, F.lit("_meg.fif")).alias("path"))


@query("pair_noise_recording", PAIRS + """SELECT a.page_id, b.path AS noise_path FROM r a JOIN r b ON a.dataset = b.dataset AND a.sub = b.sub AND b.task = 'emptr' WHERE a.task <> 'emptr'""")
def _(t):
    r = paths(t)
    return op.pair_noise_recording(r.where("task <> 'emptr'"), r.where("task = 'emptr'"), "emptr").select("page_id", "noise_path")


@query("strict_join", """
SELECT 'lenient' AS mode, o_orderkey AS k, n FROM orders JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
UNION ALL SELECT 'strict', c_custkey, 1 FROM customer""")
def _(t):
    lines = t.table("lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n"))
    orders = t.table("orders").select(F.col("o_orderkey").alias("k"))
    cust = t.table("customer").select(F.col("c_custkey").alias("k"))
    a = op.strict_join(orders, lines, ["k"], "lenient").select(F.lit("lenient").alias("mode"), "k", "n")
    b = op.strict_join(cust, cust.withColumn("n", F.lit(1).cast("bigint")), ["k"]).select(F.lit("strict").alias("mode"), "k", "n")
    return a.unionByName(b)


@query("assert_lineage_equal", "SELECT o_orderkey, o_custkey FROM orders")
def _(t):
    o = t.table("orders").select("o_orderkey", "o_custkey", F.sha2(F.col("o_custkey").cast("string"), 256).alias("hash"))
    j = op.strict_join(o, o.select("o_orderkey", F.col("o_custkey").alias("cust2"), F.col("hash").alias("hash2")), ["o_orderkey"])
    return op.assert_lineage_equal(j, [("o_custkey", "cust2"), ("hash", "hash2")]).select("o_orderkey", "o_custkey")


CH = """, c AS (SELECT recording_id, ch_name, max(value) > 220e0 AS tb, avg(value) > 41e0 AS nb FROM samples GROUP BY 1, 2) """


def channel_sides(t):
    c = t.samples().groupBy("recording_id", "ch_name").agg((F.max("value") > 220).alias("tb"), (F.avg("value") > 41).alias("nb"))
    return (c.select("recording_id", "ch_name", F.col("tb").alias("is_bad")), c.select("recording_id", "ch_name", F.col("nb").alias("is_bad")))


@query("common_channels", with_views(CH + "SELECT recording_id, ch_name FROM c WHERE NOT tb AND NOT nb", "samples"))
def _(t):
    return op.common_channels(*channel_sides(t), ["recording_id"])[0].select("recording_id", "ch_name")


@query("common_channels_dropped", with_views(CH + "SELECT recording_id, ch_name, CASE WHEN nb THEN 'noise' ELSE 'target' END AS missing_in FROM c WHERE tb <> nb", "samples"))
def _(t):
    return op.common_channels(*channel_sides(t), ["recording_id"])[1]


@query("stale_recordings", """
WITH x AS (SELECT o_orderkey AS recording_id, o_orderkey % 11 AS k FROM orders)
SELECT recording_id, CASE k WHEN 0 THEN 'new' WHEN 1 THEN 'input changed' WHEN 2 THEN 'settings changed' WHEN 3 THEN 'output missing' WHEN 4 THEN 'removed' END AS reason FROM x WHERE k < 5""")
def _(t):
    k = F.col("o_orderkey") % 11
    base = t.table("orders").select(F.col("o_orderkey").alias("recording_id"), k.alias("k"), F.sha2(F.col("o_totalprice").cast("string"), 256).alias("h"))
    old = base.where("k <> 0").select("recording_id", F.col("h").alias("input_hash"), F.lit("c1").alias("config_hash"), (F.col("k") != 3).alias("has_output"))
    new = base.where("k <> 4").select("recording_id", F.when(F.col("k") == 1, "other").otherwise(F.col("h")).alias("input_hash"),
                                      F.when(F.col("k") == 2, "c2").otherwise("c1").alias("config_hash"))
    return op.stale_recordings(old, new, ["recording_id"])

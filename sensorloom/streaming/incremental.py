"""Per-recording metrics kept up to date from a growing folder of sample files.

A file stream finds new files. The rows of every micro-batch are kept once more, dealt into buckets of recordings, so that a
batch reads again only the buckets of the recordings it touches, and of these only recordings whose content hash changed are
recomputed. Rows and results go to one folder per batch id, written in overwrite mode, so a replayed batch after a failure
replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.lineage import content_hash, hash_text, row_code


def _history(spark: SparkSession, store: str) -> DataFrame | None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(store)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop) or not fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(store + "/batch=*")):
        return None
    return spark.read.parquet(store)


def latest(spark: SparkSession, store: str, key: str = "recording_id") -> DataFrame:
    """Newest result per recording."""
    h = _history(spark, store)
    if h is None:
        raise FileNotFoundError(f"no results in {store}")
    columns = [c for c in h.columns if c not in (key, "batch")]
    return h.groupBy(key).agg(F.max_by(F.struct(*columns), "batch").alias("_r")).select(key, "_r.*")


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def rows_of(spark: SparkSession, rows: str, schema: T.StructType, numbers: list[int], before: int) -> DataFrame:
    """Rows of the given buckets from all batches up to `before`; folders of other buckets are not opened."""
    kept = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType()), T.StructField("bucket", T.IntegerType())])).parquet(rows)
    return kept.where(F.col("bucket").isin(numbers) & (F.col("batch") <= before)).drop("batch", "bucket")


def incremental_metrics(spark: SparkSession, source: str, schema: T.StructType, store: str, checkpoint: str,
                        derive: Callable[[DataFrame], DataFrame], metrics: Callable[[DataFrame], DataFrame],
                        key: str = "recording_id", available_now: bool = True, buckets: int = 256, **options: str) -> StreamingQuery:
    """Start the stream. `derive` maps source rows to sample rows, `metrics` samples to one row per recording. The dealt rows lie beside
    `store`, in `<store>-rows`; a recording is read with the others of its bucket, so `buckets` should grow with their number."""
    kept = f"{store.rstrip('/')}-rows"

    def upsert(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        fresh = derive(batch)
        dealt = fresh.withColumn("bucket", bucket_of(key, buckets))
        dealt.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{kept}/batch={batch_id}")
        written = session.read.schema(dealt.schema).parquet(f"{kept}/batch={batch_id}")
        numbers = [r[0] for r in written.select("bucket").distinct().collect()]  # at most `buckets`
        every = rows_of(session, kept, fresh.schema, numbers, batch_id).join(written.select(key).distinct(), key, "left_semi")
        hashes = content_hash(every, [key], [c for c in every.columns if c != key])
        known = _history(session, store)
        if known is not None:
            # results of this very batch belong to an interrupted attempt
            seen = known.where(F.col("batch") < batch_id).groupBy(key).agg(F.max_by("content_hash", "batch").alias("content_hash"))
            hashes = hashes.join(seen, [key, "content_hash"], "left_anti")
        changed = every.join(hashes.select(key), key, "left_semi")
        metrics(changed).join(hashes, key).write.mode("overwrite").parquet(f"{store}/batch={batch_id}")

    stream = spark.readStream.schema(schema).options(**options).parquet(source)
    writer = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


# ------------------------------------------------------------- states that merge

def partial_states(samples: DataFrame, key: str, t: str, value: str) -> DataFrame:
    """One state per key: rows, mean and summed squares about it, extremes, values at both ends of the clock, and the parts of the content hash.
    Missing values count as rows of the hash only."""
    v = F.col(value).cast("double")
    code = row_code([t, value])
    at = F.struct(F.col(t), v)
    return samples.groupBy(key).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"), F.min(v).alias("least"), F.max(v).alias("most"),
        F.min(t).alias("first_t"), F.min_by(v, at).alias("first"), F.max(t).alias("last_t"), F.max_by(v, at).alias("last"),
        F.bit_xor(code).alias("code_xor"), F.sum(code.cast("decimal(38,0)")).alias("code_sum"), F.count("*").alias("rows"))


def merged_states(states: DataFrame, key: str) -> DataFrame:
    """States of the same key, from unlike rows, as one: means and squares by the parallel formula, pair by pair, the rest by its own fold. A key has two
    states at most where a batch meets the store."""
    def join(a: Column, b: Column) -> Column:
        n, gap = a.n + b.n, b.mean - a.mean
        both = F.struct(n.alias("n"), (a.mean + gap * b.n / n).alias("mean"), (a.m2 + b.m2 + gap * gap * a.n * b.n / n).alias("m2"))
        return F.when(b.n == 0, a).when(a.n == 0, b).otherwise(both)

    parts = F.collect_list(F.struct("n", F.coalesce("mean", F.lit(0e0)).alias("mean"), F.coalesce("m2", F.lit(0e0)).alias("m2")))
    merged = states.groupBy(key).agg(
        parts.alias("_parts"), F.min("least").alias("least"), F.max("most").alias("most"), F.min("first_t").alias("first_t"),
        F.min_by("first", F.struct("first_t", "first")).alias("first"), F.max("last_t").alias("last_t"), F.max_by("last", F.struct("last_t", "last")).alias("last"),
        F.bit_xor("code_xor").alias("code_xor"), F.sum("code_sum").cast("decimal(38,0)").alias("code_sum"), F.sum("rows").alias("rows"))
    folded = merged.withColumn("_s", F.reduce(F.slice("_parts", 2, F.size("_parts")), F.col("_parts")[0], join))
    some = F.col("_s.n") > 0
    return folded.select(key, F.col("_s.n").alias("n"), F.when(some, F.col("_s.mean")).alias("mean"), F.when(some, F.col("_s.m2")).alias("m2"), "least", "most", "first_t", "first",
                         "last_t", "last", "code_xor", "code_sum", "rows")


def summary(states: DataFrame, key: str) -> DataFrame:
    """Metrics of each state: number, mean, deviation, range, the values at both ends and the content hash."""
    return states.select(key, F.col("n").alias("n_samples"), "mean", F.sqrt(F.try_divide(F.col("m2"), F.col("n"))).alias("std"), (F.col("most") - F.col("least")).alias("ptp"),
                         "first", "last", hash_text(F.col("rows"), F.col("code_xor"), F.col("code_sum")).alias("content_hash"))


def _map_at(spark: SparkSession, store: str, batch_id: int) -> DataFrame | None:
    """Which batch wrote the newest state of each bucket, as of a batch."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/newest/batch={batch_id}/_SUCCESS")
    if batch_id < 0 or not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    return spark.read.schema("bucket int, batch long").parquet(f"{store}/newest/batch={batch_id}")


def read_states(spark: SparkSession, store: str, newest: dict[int, int], schema: T.StructType) -> DataFrame:
    """States of the given buckets, each from the folder of the batch that wrote it last; nothing else is opened."""
    paths = [f"{store}/states/batch={b}/bucket={k}" for k, b in sorted(newest.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge_batch(batch: DataFrame, batch_id: int, store: str, key: str, t: str, value: str, buckets: int) -> None:
    """Fold one batch into the store: states of the touched buckets are read from where they were last written, merged with those of the batch, and written
    to the folder of this batch. A batch that runs again writes the same."""
    spark = batch.sparkSession
    fresh = partial_states(batch, key, t, value).withColumn("bucket", bucket_of(key, buckets))
    path = f"{store}/fresh/batch={batch_id}"
    fresh.write.mode("overwrite").parquet(path)
    fresh = spark.read.schema(fresh.schema).parquet(path)
    before = _map_at(spark, store, batch_id - 1)
    newest = {r.bucket: r.batch for r in before.collect()} if before is not None else {}  # at most `buckets`
    touched = [r[0] for r in fresh.select("bucket").distinct().collect()]
    state = T.StructType([f for f in fresh.schema.fields if f.name != "bucket"])
    old = read_states(spark, store, {k: newest[k] for k in touched if k in newest}, state)
    merged = merged_states(old.unionByName(fresh.drop("bucket")), key).withColumn("bucket", bucket_of(key, buckets))
    merged.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{store}/states/batch={batch_id}")
    rows = [(k, b) for k, b in (newest | {k: batch_id for k in touched}).items()]
    spark.createDataFrame(rows, "bucket int, batch long").coalesce(1).write.mode("overwrite").parquet(f"{store}/newest/batch={batch_id}")


def incremental_states(spark: SparkSession, source: str, schema: T.StructType, store: str, checkpoint: str, derive: Callable[[DataFrame], DataFrame],
                       key: str = "recording_id", t: str = "t", value: str = "value", available_now: bool = True, buckets: int = 256, **options: str) -> StreamingQuery:
    """Start a stream that keeps a state per recording. What a batch reads is its own rows and the states of the buckets it touches, however long the
    history is; `newest_states` gives the result."""
    stream = spark.readStream.schema(schema).options(**options).parquet(source)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        merge_batch(derive(batch), batch_id, store, key, t, value, buckets)

    writer = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def newest_states(spark: SparkSession, store: str) -> DataFrame:
    """The states of all recordings after the last batch."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(store + "/newest/batch=*/_SUCCESS")
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    if not found:
        raise FileNotFoundError(f"no states in {store}")
    last = max(int(f.getPath().getParent().getName().removeprefix("batch=")) for f in found)
    newest = {r.bucket: r.batch for r in _map_at(spark, store, last).collect()}
    paths = [f"{store}/states/batch={b}/bucket={k}" for k, b in sorted(newest.items())]
    return spark.read.parquet(*paths)

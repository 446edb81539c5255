"""Session helpers: the few runtime settings the operators rely on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on; leave sizing to the cluster.

    Times are UTC so that sample clocks do not depend on the machine. AQE (with its
    skew-join handling) stays on: it sizes shuffle partitions and picks broadcast joins
    from measured sizes, so no operator has to force one. The threshold for broadcasts holds
    for measured sizes only: before a query runs, Spark only knows the size of compressed files, from
    which exploded or repetitive rows seem small enough to go through the driver whole.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    planned, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    if spark.conf.get(measured, None) is None:
        spark.conf.set(measured, spark.conf.get(planned))
    spark.conf.set(planned, "-1")
    return spark


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme. One without a scheme lies in the default file system of the cluster, which Spark's writers take but other readers do not know."""
    if ":/" in path:
        return path
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    return found.replace("file:/", "file:///", 1) if found.startswith("file:/") and not found.startswith("file://") else found


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (`spark.checkpoint.dir`). Only a local session may go without: it gets a folder of its own, once, which is
    removed when Python ends. On a cluster a missing setting is refused."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return qualified(spark, named.rstrip("/"))
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    global _own
    if _own is None:
        _own = tempfile.mkdtemp(prefix="sensorloom-")
        atexit.register(shutil.rmtree, _own, ignore_errors=True)
    return f"file://{_own}"


_own: str | None = None


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder name in the shared folder; all of a session's scratch lies under one folder, which `release` removes."""
    return f"{shared_folder(spark)}/sensorloom-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Remove the session's scratch folder, once no result that reads from it is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/sensorloom-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write a small intermediate result once and read it back.

    Its input is not computed again. Joins broadcast it when its measured size is below the
    configured threshold and shuffle otherwise.
    """
    path = scratch_folder(df.sparkSession) + "/part"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the cluster's shared folder (`spark.checkpoint.dir`).

    A local session that names none uses its own folder.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()

"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or the context's checkpoint folder. Where both
    are unset, a temporary one if all runs on this machine; on a cluster that is an error, as executors couldn't see it."""
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        held = sc._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        where = "file://" + tempfile.mkdtemp(prefix="duskfield-")
        sc.setCheckpointDir(where)
    return where


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``shared_dir`` and read back: the lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    top = shared_dir(spark)
    path = f"{top.rstrip('/')}/duskfield-{uuid.uuid4().hex}/{name}"
    df.write.mode("overwrite").parquet(path)
    fs, at = _file_system(spark, path)
    fs.deleteOnExit(at.getParent())
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


#: Bytes that pass to Python at a time, where the session doesn't say otherwise: rows that hold arrays differ in length.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by bytes, unless it has a bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(BATCH_BYTES))


def spread(df: DataFrame, *by: str) -> DataFrame:
    """``df`` dealt by columns to ``spark.sql.shuffle.partitions`` tasks. Spark joins partitions of few bytes into one task,
    however much is computed or sorted there; a number that is asked for stays."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` gave and that nothing will read again: all that came of them is written itself."""
    for t in tables:
        fs, at = _file_system(t.sparkSession, t._written_at)
        fs.delete(at.getParent(), True)

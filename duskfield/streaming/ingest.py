"""The incremental front door: bursts of arrivals per observation, once each, into written tables."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..functions.tables import written
from ..sources.tables import single_writer


def debounced(arrivals: DataFrame, key: str, time: str, gap: str = "30 seconds", watermark: str | None = None) -> DataFrame:
    """(key, first, last, n): a burst ends ``gap`` after its last arrival. Works on tables and streams; the watermark only
    bounds a stream's state."""
    x = arrivals.withWatermark(time, watermark) if watermark else arrivals
    out = x.groupBy(key, F.session_window(time, gap)).agg(F.min(time).alias("first"), F.max(time).alias("last"), F.count(F.lit(1)).alias("n"))
    return out.select(key, "first", "last", "n")


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which state by processors needs; the session's own setting comes back."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


MESSAGE = "ecsv_path string, fits_path string, _bad string"


def arrival_messages(lines: DataFrame, column: str = "value") -> DataFrame:
    """(ecsv_path, fits_path, problem) from lines of JSON, one message each, as a socket or a folder of text files gives them;
    works on tables and streams. ``problem`` says why a line is no message: it can't be parsed, or names no table."""
    m = F.from_json(column, MESSAGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    x = lines.select(m.alias("m"))
    named = F.length(F.trim(F.coalesce("m.ecsv_path", F.lit("")))) > 0
    problem = F.when(F.col("m._bad").isNotNull(), "not a JSON object").when(~named, "names no table")
    return x.select("m.ecsv_path", "m.fits_path", problem.alias("problem"))


def land(messages: DataFrame, read: Callable[[SparkSession, list[str]], DataFrame], path: str, checkpoint: str, once_only: bool = True) -> StreamingQuery:
    """Reads the tables that each micro-batch's messages name, by ``read``, and writes their rows to ``path``/batch=number; messages
    with a problem go to ``path``.problems. A batch that runs again overwrites its own rows; a table named twice in a batch
    is read once. The list of a batch's paths comes to the driver, as Spark's readers need it there."""

    def batch(df: DataFrame, number: int) -> None:
        df = df.persist()
        paths = [r[0] for r in df.where("problem is null").select("ecsv_path").distinct().orderBy("ecsv_path").collect()]
        if paths:
            read(df.sparkSession, paths).write.mode("overwrite").parquet(f"{path}/batch={number}")
        df.where("problem is not null").write.mode("overwrite").parquet(f"{path}.problems/batch={number}")
        df.unpersist()

    writer = messages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once_only else writer).start()


def unseen(rows: DataFrame, registry: DataFrame, digest: str) -> DataFrame:
    """Rows whose content the registry doesn't have."""
    return rows.join(registry.select(digest).distinct(), digest, "left_anti")


def once(arrivals: DataFrame, digest: str, time: str, horizon: str = "30 days") -> DataFrame:
    """A stream's rows without repeats of content within the horizon."""
    return arrivals.withWatermark(time, horizon).dropDuplicatesWithinWatermark([digest])


def run_bursts(arrivals: DataFrame, key: str, checkpoint: str, handle: Callable[[DataFrame, int], None], once_only: bool = True) -> StreamingQuery:
    """Hands each micro-batch's touched keys to ``handle`` (rows of (key, n), batch id): one writer for a key at a time, and
    late exposures simply make their observation's tables anew."""

    def batch(df: DataFrame, number: int) -> None:
        handle(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")), number)

    writer = arrivals.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once_only else writer).start()


def replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Writes the partitions that ``df`` has anew and leaves the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def run_keys(spark: SparkSession, keys: Iterable, work: Callable[[object], None], workers: int = 4, timeout: float | None = 900.0) -> dict:
    """``work`` for each key, up to ``workers`` at once, each as a Spark job group that is cancelled when it runs over
    ``timeout`` seconds; keys that come twice are done once. Gives each key's outcome: ``done``, ``timeout`` or the error.

    The work itself is distributed; this only starts it. A key that fails doesn't keep the others.
    """
    sc = spark.sparkContext

    def one(key: object) -> None:
        sc.setJobGroup(f"key-{key}", f"observation {key}", interruptOnCancel=True)
        work(key)

    out: dict = {}
    with ThreadPoolExecutor(workers) as pool:
        begun: dict = {}

        def timed(key: object) -> None:
            begun[key] = time.monotonic()
            inheritable_thread_target(spark)(one)(key)

        waiting = {pool.submit(timed, k): k for k in dict.fromkeys(keys)}
        late: set = set()
        while waiting:
            done, _ = wait(waiting, timeout=0.2, return_when=FIRST_COMPLETED)
            for f in done:
                k, e = waiting.pop(f), f.exception()
                out[k] = "timeout" if k in late else "done" if e is None else f"{type(e).__name__}: {e}"
            for k in waiting.values():
                if timeout is not None and k in begun and k not in late and time.monotonic() - begun[k] > timeout:
                    late.add(k)
                    sc.cancelJobGroup(f"key-{k}")
    return out


def publish_changed(rows: DataFrame, path: str, key: str) -> DataFrame:
    """Writes the rows whose content differs from what ``path`` has last published for their key, as a new version, and gives
    these rows. ``path``: a Parquet table of key, version, digest and the columns."""
    spark = rows.sparkSession
    rest = sorted(c for c in rows.columns if c != key)
    x = rows.withColumn("digest", F.sha2(F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}), 256))
    with single_writer(spark, path):
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            last = spark.read.parquet(path).groupBy(key).agg(F.max("version").alias("_v"), F.max_by("digest", "version").alias("_d"))
            x = x.join(last, key, "left").where(F.col("_d").isNull() | (F.col("_d") != F.col("digest")))
            x = x.withColumn("version", F.coalesce(F.col("_v") + 1, F.lit(1))).drop("_v", "_d")
        else:
            x = x.withColumn("version", F.lit(1))
        new = written(x, "changed")
        new.write.mode("append").parquet(path)
    return new


class Counters(StreamingQueryListener):
    """Counts of what the streams have done since the start: batches, rows, failures, and rows by stream."""

    def __init__(self) -> None:
        self.batches = self.rows = self.failures = self.running = 0
        self.by_query: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.running += 1

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.batches += 1
        self.rows += p.numInputRows
        name = p.name or str(p.id)
        self.by_query[name] = self.by_query.get(name, 0) + p.numInputRows

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.running -= 1
        self.failures += event.exception is not None

    def line(self) -> str:
        return f"running {self.running}, batches {self.batches}, rows {self.rows}, failures {self.failures}"

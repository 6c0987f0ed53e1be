"""What the corpus operators share: character classes, the shared folder, written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words and is stripped from lines.
WS = " \t\n\x0b\x0c\r"
WS_CLASS = r"\x20\x09-\x0D"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is.

    ``lower`` has a quick path for ASCII but changes other letters too, so it only serves texts
    whose byte count equals their character count.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or the context's checkpoint folder. Where both
    are unset, a temporary one if all runs on this machine; on a cluster that is an error, as executors couldn't see it."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        where = "file://" + tempfile.mkdtemp(prefix="duskfield-")
        spark.sparkContext.setCheckpointDir(where)
    return where


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read back.

    Cuts the lineage, survives a lost executor, lets readers prune columns and gives the optimiser true sizes.
    The files go by ``dropped``, or when the application's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/duskfield-{uuid.uuid4().hex}/{name}"
    df.write.mode("overwrite").parquet(path)
    fs, at = _file_system(spark, path)
    fs.deleteOnExit(at.getParent())
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` gave and that nothing will read again: all that came of them is written itself."""
    for t in tables:
        fs, at = _file_system(t.sparkSession, t._written_at)
        fs.delete(at.getParent(), True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside pass batches of ``rows`` to Python, so that texts in flight take little memory on either side."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Bytes of a table, as Spark estimates them, up to which ``small_broadcasts`` lets it be broadcast.
SMALL_TABLE = 256 << 10


@contextmanager
def small_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside broadcast tables of SMALL_TABLE bytes at most unasked, or fewer if the session says so.

    Spark goes by the bytes of files or shuffled rows. In the driver a table of ids takes twenty times that of its files.
    """
    before = {key: spark.conf.get(key, None) for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    held = {key: v for key, v in before.items() if v and not v.startswith("-") and spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(v) > SMALL_TABLE}
    try:
        for key in held:
            spark.conf.set(key, str(SMALL_TABLE))
        yield
    finally:
        for key, v in held.items():
            spark.conf.set(key, v)


_shipped: set[str] = set()
#: Bytes that pass to Python at a time, where the session doesn't say otherwise: texts differ in length a thousandfold.
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, which they then import as modules, so that workers keep what they cache; and bounds
    the session's Arrow batches by bytes, unless it has a bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(BATCH_BYTES))
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    top = Path(__file__).resolve().parent.parent
    at = Path(tempfile.mkdtemp(prefix="duskfield-")) / "duskfield_package.zip"
    with zipfile.ZipFile(at, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(str(at))

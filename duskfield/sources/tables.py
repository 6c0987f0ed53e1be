"""Reading and writing exposures' tables: text with a YAML header, Parquet by exposure, states and registries."""

from __future__ import annotations

import csv
import io
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
import yaml
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_text_table(text: str) -> tuple[dict, list[dict[str, str]]]:
    """Header and rows of a table: ``# `` lines are YAML, the first other line names the columns; space, comma or tab."""
    head, body = [], []
    for line in text.splitlines():
        if line.startswith("#"):
            head.append(line[2:] if line.startswith("# ") else line[1:])
        elif line.strip():
            body.append(line)
    if head and head[0].startswith("%"):
        head = head[1:]
    meta = yaml.safe_load("\n".join(x for x in head if x != "---") or "{}")
    meta = meta if isinstance(meta, dict) else {}
    delimiter = meta.get("delimiter") or ("," if body and "," in body[0] else "\t" if body and "\t" in body[0] else " ")
    rows = list(csv.DictReader(io.StringIO("\n".join(body)), delimiter=delimiter, skipinitialspace=True)) if body else []
    inner = meta.get("meta", meta)
    if isinstance(inner, list):  # an ordered map is a list of pairs
        inner = {k: v for pair in inner for k, v in (pair.items() if isinstance(pair, dict) else [pair])}
    return inner or {}, rows


def read_text_tables(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every row of the tables at ``path`` with the columns of ``schema`` (null where a table lacks one), ``filename``,
    ``meta`` (strings) and ``problem``. Tables are parsed where they are read, one file to a task; one that can't be parsed
    gives one row that has only its name and the problem."""
    out = T.StructType([*schema.fields, T.StructField("filename", T.StringType()), T.StructField("meta", T.MapType(T.StringType(), T.StringType())), T.StructField("problem", T.StringType())])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, text in zip(b["filename"], b["value"], strict=True):
                try:
                    meta, rows = parse_text_table(text)
                except (yaml.YAMLError, csv.Error) as e:
                    yield pd.DataFrame([{f.name: None for f in schema.fields} | {"filename": name, "meta": {}, "problem": f"{type(e).__name__}: {e}"[:500]}], dtype=object)
                    continue
                x = pd.DataFrame(rows, dtype=object)
                cols = {}
                for f in schema.fields:
                    v = x[f.name] if f.name in x else pd.Series([None] * len(x), dtype=object)
                    if isinstance(f.dataType, T.NumericType):
                        v = pd.to_numeric(v.replace({"": None, '""': None}), errors="coerce")
                        v = v.astype("Int64") if isinstance(f.dataType, T.IntegralType) else v.astype(float)
                    cols[f.name] = v
                y = pd.DataFrame(cols, index=x.index)
                y["filename"], y["problem"] = name, None
                y["meta"] = [{str(k): str(v) for k, v in meta.items()}] * len(y)
                yield y

    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("filename"), "value")
    return files.mapInPandas(parse, out)


def read_either(spark: SparkSession, folder: str, stems: list[str], schema: T.StructType, endings: tuple[str, ...] = (".ecsv", ".cat")) -> DataFrame:
    """The tables named ``stems`` in ``folder``, each from the first of ``endings`` under which it is there and can be parsed."""
    names = F.array(*[F.lit(e) for e in endings])
    x = read_text_tables(spark, f"{folder}/*{{{','.join(endings)}}}", schema)
    x = x.withColumns({"_base": F.regexp_extract("filename", r"([^/]*)$", 1)})
    x = x.withColumns({"_end": F.regexp_extract("_base", r"(\.[^.]*)$", 1)}).withColumn("stem", F.expr("substring(_base, 1, length(_base) - length(_end))"))
    x = x.where(F.col("stem").isin(stems)).withColumn("_rank", F.array_position(names, F.col("_end")))
    first = x.where("problem is null").groupBy("stem").agg(F.min("_rank").alias("_first"))
    out = x.join(first, "stem", "left").where((F.col("_rank") == F.col("_first")) | (F.col("_first").isNull() & (F.col("_rank") == 1)))
    return out.drop("_base", "_end", "_rank", "_first")


def registered(epochs: DataFrame, registry: DataFrame, key: str = "epoch_id") -> DataFrame:
    """The rows of registered exposures only."""
    return epochs.join(registry.select(key).distinct(), key, "left_semi")


#: What stands for a column that a detection table lacks: no flags, no error, a size of 3 pixels.
DEFAULTS = {"flags": 0, "err": 0.0, "fwhm": 3.0}


def conform(df: DataFrame, schema: T.StructType, defaults: dict[str, float] | None = None) -> DataFrame:
    """The columns of ``schema`` with its types; ``defaults`` or null where ``df`` lacks one or a row has none."""
    value = defaults or {}
    own = lambda c: F.col(c) if c in df.columns else F.lit(None)
    return df.select(*[F.coalesce(own(f.name).cast(f.dataType), F.lit(value.get(f.name)).cast(f.dataType)).alias(f.name) for f in schema.fields])


@contextmanager
def single_writer(spark: SparkSession, path: str, wait: float = 900.0, pause: float = 0.5, stale: float = 21_600.0) -> Iterator[None]:
    """One writer of ``path`` at a time, on any file system that creates files exclusively: who makes the lock file beside it
    goes on, others wait up to ``wait`` seconds. What was read before has to be read again inside. The file names its owner;
    one older than ``stale`` seconds is that of a run that was killed, and is broken."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + ".lock")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    until = time.monotonic() + wait
    owner = f"{spark.sparkContext.applicationId} {uuid.uuid4().hex}"
    while True:
        try:
            out = fs.create(at, False)
            out.writeUTF(owner)
            out.close()
            break
        except Py4JJavaError:
            if not fs.exists(at):
                raise
            if time.time() - fs.getFileStatus(at).getModificationTime() / 1000 > stale:
                # Whoever renames it breaks it: two that wait can't both delete the same lock.
                if fs.rename(at, jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.lock.{uuid.uuid4().hex}")):
                    continue
            if time.monotonic() > until:
                raise TimeoutError(f"{path} is being written by another run") from None
            time.sleep(pause)
    try:
        yield
    finally:
        fs.delete(at, False)


def add_epochs(df: DataFrame, path: str, key: str = "epoch_id") -> None:
    """Appends the exposures that ``path`` doesn't have yet; one writer at a time looks and appends."""
    spark = df.sparkSession
    with single_writer(spark, path):
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            df = df.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti")
        df.write.mode("append").partitionBy(key).parquet(path)


def add_missing(rows: DataFrame, path: str, make: Callable[[DataFrame], DataFrame], key: str = "epoch_id") -> None:
    """Computes and appends the exposures that ``path`` lacks: ``make`` gets only the rows of those, so that what is there
    already isn't computed again."""
    spark = rows.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        rows = rows.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti")
    add_epochs(make(rows), path, key)


def latest(state: DataFrame, key: str, version: str) -> DataFrame:
    """The last state of each key."""
    rest = [c for c in state.columns if c != key]
    return state.groupBy(key).agg(F.max_by(F.struct(*rest), version).alias("s")).select(key, "s.*")


def fresh(cache: DataFrame, at: str, days: float) -> DataFrame:
    """Cached rows that aren't older than ``days``."""
    return cache.where(F.col(at) >= F.current_timestamp() - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(days * 86400)))


def read_light_curves(spark: SparkSession, path: str) -> DataFrame:
    """(gid, mjd, mag, mag_err, band, survey, ulim) from JSON files that map candidates to their points: ``{id: [point, ...]}``.

    The schema is given, so that nothing is inferred; a file is one row until it is exploded."""
    point = "array<struct<mjd:double,mag:double,mag_err:double,band:string,survey:string,ulim:boolean>>"
    x = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string,{point}>")).alias("gid", "points"))
    return x.select("gid", F.explode("points").alias("p")).select("gid", "p.*")

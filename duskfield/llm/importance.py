"""Importance resampling towards a target distribution over hashed n-grams.

DuckDB does each partition's part inside its task: SQL splits texts into words, windows them into n-grams and counts
buckets by a registered CRC-32 of zlib. The counts are spilled to Parquet in the shared folder; Spark merges them into two
distributions, scores every document by their ratio, and draws by Gumbel noise that the document's id seeds.
"""

from __future__ import annotations

import json
import tempfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ship, written

#: Fixed value: what no word has, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TWO_32 = 4294967296
#: What DuckDB may hold in a task before it spills to the task's temporary folder.
MEMORY = "384MB"


def bucket_query(low: int, high: int, buckets: int) -> str:
    """SQL over ``batch`` (row, text): per row its words, its n-grams of ``low`` to ``high`` words and their count by bucket."""
    lead = lambda k: f"lead(word, {k}) over (partition by row order by place)"
    grams = [f"select row, {'word' if n == 1 else f'word || {chr(39)} {chr(39)} || ' + f' || {chr(39)} {chr(39)} || '.join(map(lead, range(1, n)))} as gram from words" for n in range(low, high + 1)]
    return f"""
    with split as materialized (select row, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}') as w from batch),
    words as (select row, unnest(w) as word{', generate_subscripts(w, 1) as place' if high > 1 else ''} from split),
    grams as ({' union all '.join(grams)}),
    counted as (select row, gram, count(*) as n from grams where gram is not null group by row, gram),
    hashed as (select gram, zlib_crc32(gram) % {buckets} as bucket from (select distinct gram from counted)),
    found as (select row, cast(bucket as integer) as bucket, cast(sum(n) as bigint) as n from counted join hashed using (gram) group by all),
    listed as (select row, cast(sum(n) as bigint) as n_features, list(bucket order by bucket) as buckets, list(n order by bucket) as counts from found group by row)
    select row, cast(len(w) as bigint) as n_words, coalesce(n_features, 0) as n_features, buckets, counts from split left join listed using (row) order by row
    """


def bucket_counts(docs: DataFrame, low: int, high: int, buckets: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, n_features, buckets, counts) per row of ``docs``, counted by DuckDB inside the tasks, batch by batch."""
    query = bucket_query(low, high, buckets)

    def crc(grams):
        return pa.array([zlib.crc32(g.encode()) for g in grams.to_pylist()], pa.int64())

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = None
        for b in batches:
            if con is None:
                con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": tempfile.mkdtemp(prefix="duskfield-"), "preserve_insertion_order": False})
                con.create_function("zlib_crc32", crc, ["VARCHAR"], "BIGINT", type="arrow")
            con.register("batch", pa.table({"row": pa.array(range(b.num_rows), pa.int64()), "text": b["text"].cast(pa.string()).fill_null("")}))
            got = con.sql(query).to_arrow_table().combine_chunks()
            con.unregister("batch")
            for r in got.to_batches():
                first = r["row"][0].as_py()
                yield pa.RecordBatch.from_arrays([b["id"].slice(first, r.num_rows), *[r[c] for c in ("n_words", "n_features", "buckets", "counts")]], names=["id", "n_words", "n_features", "buckets", "counts"])
        if con:
            con.close()

    x = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return x.mapInArrow(counted, f"id {x.schema['id'].dataType.simpleString()}, n_words long, n_features long, buckets array<int>, counts array<long>")


def merged(counts: DataFrame) -> DataFrame:
    """(bucket, n): the sums over all rows, partial in every task."""
    return counts.where("n_features > 0").select(F.explode(F.arrays_zip("buckets", "counts")).alias("b")).groupBy(F.col("b.buckets").alias("bucket")).agg(F.sum("b.counts").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gain) of every bucket: floor(1000 ln of how much likelier the target has it), with one added to each count."""
    every = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    x = every.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0, ["s", "t"])
    size = x.agg(F.sum("s").alias("S"), F.sum("t").alias("T")).first()  # two numbers
    up = ((F.col("t") + 1) * F.lit(size["S"] + buckets)).cast("double")
    down = ((F.col("s") + 1) * F.lit(size["T"] + buckets)).cast("double")
    return x.select("bucket", F.floor(F.lit(1000.0) * F.log(up / down)).alias("gain"))


def resample(docs: DataFrame, target: DataFrame, low: int = 1, high: int = 1, buckets: int = 10_000, percent: int = 10, least: int = 20, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_features, weight, score and rank; undrawn rows have a null rank.

    Features are the runs of ``low`` to ``high`` words; a weight is the floored mean of its features' gains, 0 without any. The
    score adds Gumbel noise from the id, so that the highest scores are a draw without replacement by weight. Of the rows
    with ``least`` words ``percent`` in a hundred are drawn, ranked from 1. Defined cases: null and empty texts have no
    words; a null id draws noise as an empty one; rows of one id share their noise, and if all they have is equal, which
    of them gets which rank doesn't show; an empty table of documents gives an empty table, and without a target the
    gains follow from the ones added; other columns aren't read.

    Scale: texts are read once, by tasks that hold one batch; the counts (some bytes a bucket and document) are spilled and
    read twice. Sums by bucket are partial, ``buckets`` rows a task; the gains come to the driver as ``buckets`` numbers.
    Ranks are places in a sort by range, whose partitions pass on only their sizes.
    """
    spark = docs.sparkSession
    ship(spark)
    x = written(bucket_counts(docs, low, high, buckets, id_col, text_col), "bucket_counts")
    goal = merged(bucket_counts(target, low, high, buckets, target.columns[0], text_col))
    gain = [r["gain"] for r in gains(merged(x), goal, buckets).orderBy("bucket").collect()]
    table = F.from_json(F.lit(json.dumps(gain)), "array<long>")  # a constant of ``buckets`` numbers
    total = F.aggregate(F.zip_with("buckets", "counts", lambda b, n: F.get(table, b) * n), F.lit(0).cast("long"), lambda a, v: a + v)
    n = F.col("n_features")
    weight = F.when(n > 0, ((total - F.pmod(total, n)) / n).cast("long")).otherwise(F.lit(0).cast("long"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(float(TWO_32)))))
    scored = written(x.select("id", "n_words", "n_features", weight.alias("weight")).withColumn("score", F.col("weight") + noise), "scored")
    return ranked(scored, percent, least).withColumnRenamed("id", id_col)


def ranked(scored: DataFrame, percent: int, least: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... by falling score, then id, for ``percent`` in a hundred of the rows of ``least`` words."""
    fit = F.col("n_words") >= least
    n = scored.agg(F.count(F.when(fit, 1)).alias("n")).first()["n"]
    drawn = percent * n // 100
    if not drawn:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    # A bound from partial sums of rounded scores: only rows at or above it are sorted.
    step = scored.where(fit).groupBy(F.floor(F.col("score") / 100).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per hundred points
    bound, have = None, 0
    for b, k in sorted(((r["b"], r["n"]) for r in step), reverse=True):
        bound, have = b * 100, have + k
        if have >= drawn:
            break
    order = [F.desc("score"), F.asc("id"), F.asc("weight"), F.asc("n_features"), F.asc("n_words")]
    top = scored.where(fit & (F.col("score") >= bound))
    top = top.repartitionByRange(*order).sortWithinPartitions(*order)
    top = written(top.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")), "top")
    offset, sizes = 0, {}
    for r in sorted(top.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["part"]):  # one number a partition
        sizes[r["part"]], offset = offset, offset + r["n"]
    begin = F.get(F.from_json(F.lit(json.dumps([sizes.get(p, 0) for p in range(max(sizes) + 1)])), "array<long>"), F.col("part"))
    top = top.withColumn("rank", begin + F.col("at") + 1)
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    return scored.where(~(fit & (F.col("score") >= bound))).withColumn("rank", F.lit(None).cast("long")).unionByName(top.drop("part", "at").withColumn("rank", rank))

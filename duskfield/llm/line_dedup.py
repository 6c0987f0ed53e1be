"""Line dedup: lines that several documents hold stay in one of them only.

Lines are exploded, normalised and hashed; distinct documents are counted per hash; the lines over the
threshold are dropped by position and the rest reassembled. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, ascii_lower, written


def line_key(line: Column) -> Column:
    """What makes two lines the same: white space stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.trim(line, F.lit(WS)))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` rewritten, plus ``n_lines`` (before) and ``n_dropped``, both long.

    A key of at least ``min_chars`` code points that at least ``min_docs`` different ids hold loses all its lines,
    except in the largest id that holds it. Extra columns pass through; an input column called ``n_lines`` or
    ``n_dropped`` is replaced. Defined cases: a null or empty text is one empty line, and null becomes the empty
    text; repeated rows of one id count as one document and are each rewritten; a null id counts as one document
    and is the largest only when no other id holds the line; an empty table gives an empty table.

    Scale: two 64-bit hashes stand for a line, so what is counted is narrow; counting is by (hash, id) first, so that
    a line that a third of all documents hold is spread over the ids, and then by hash with partial sums. Whole texts
    move once, for the rewriting join, whose keys (id and text hash) are as even as the documents.
    """
    carried = [c for c in docs.columns if c not in (id_col, text_col, "n_lines", "n_dropped")]
    doc = F.struct(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.struct(*[F.col(c) for c in carried] or [F.lit(0).alias("none")]).alias("rest"))
    base = docs.select(doc.alias("d")).select("d.id", "d.text", "d.rest")
    keyed = base.select("id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = keyed.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    lines = keyed.select("id", "t1", "t2", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    per_doc = lines.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one"))
    common = per_doc.groupBy("h1", "h2").agg(F.count("one").alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= min_docs).select("h1", "h2", "keeper")
    common = written(common, "common")  # so that Spark sees its size and can split the lines of a hot one in the join
    drops = lines.join(common, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("keeper"))).groupBy("id", "t1", "t2").agg(F.collect_set("pos").alias("gone"))
    drops = drops.select(F.col("id").alias("_id"), F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "gone")
    whole = base.withColumn("t1", F.xxhash64("text")).withColumn("t2", F.xxhash64(F.lit(1), "text"))
    joined = whole.join(drops, F.col("id").eqNullSafe(F.col("_id")) & (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2")), "left")
    n_lines = F.char_length("text") - F.char_length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    split = joined.select("id", "text", "rest", "gone", n_lines.cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), F.when(F.col("gone").isNotNull(), F.split("text", "\n", -1)).alias("parts"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("parts", i)), "\n"))
    out = {id_col: F.col("id"), text_col: text, **{c: F.col("rest").getField(c) for c in carried}}
    return split.select(*[out[c].alias(c) for c in docs.columns if c in out], "n_lines", "n_dropped")

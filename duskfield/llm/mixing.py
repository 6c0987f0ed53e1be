"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length; what whole copies leave of a source's budget is filled first in proportion,
then from the longest lengths down, and the last words by a bounded-knapsack dynamic programme, which takes over more
of them as long as the budget isn't hit; seeded documents are then selected by the count each length got.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WS_CLASS, ship, written

#: The last words of a budget go to the dynamic programme: so many at first, or what LONGEST of the longest documents
#: hold, and MORE times as many as long as the budget is missed.
DP_WORDS, LONGEST, MORE = 1 << 16, 4, 8
#: Rates tried in a round of sharing.
TRIED = 16


def reach(lengths: np.ndarray, counts: np.ndarray, goal: int, most: int) -> dict[int, int]:
    """Counts by length, each at most its bound, whose words come nearest to ``goal`` without passing ``most``.

    Bounded knapsack: counts are split into powers of two, and the sums that the first items reach are the bits of a
    number, in units of the lengths' common divisor. Ends early when no sum could be nearer. Going back, an item is in a
    sum if the items before don't reach it; their bits are made anew by halves, so that few such numbers are held.
    """
    unit = math.gcd(*lengths.tolist()) or 1
    near, top, items, bits = goal // unit + (2 * (goal % unit) > unit), most // unit, [], 1
    for length, k in _split(lengths, counts, most):
        if bits >> near & 1:
            break
        items.append((length, k))
        bits = _add(bits, length * k // unit, top)
    below = (bits & ((2 << goal // unit) - 1)).bit_length() - 1
    above = bits >> goal // unit + 1
    above = (above & -above).bit_length() + goal // unit if above else below
    out: dict[int, int] = {}

    def back(bits: int, lo: int, hi: int, at: int) -> int:
        if hi - lo > 1:
            mid, later = (lo + hi) // 2, bits
            for length, k in items[lo:mid]:
                later = _add(later, length * k // unit, at)
            return back(bits, lo, mid, back(later, mid, hi, at))
        if hi == lo or bits >> at & 1:
            return at
        length, k = items[lo]
        out[length] = out.get(length, 0) + k
        return at - length * k // unit

    back(1, 0, len(items), above if 0 < above * unit - goal < goal - below * unit else below)
    return out


def _add(bits: int, w: int, top: int) -> int:
    """The sums with one more item of ``w``, up to ``top``."""
    return bits | (bits & ((1 << max(top - w + 1, 0)) - 1)) << w


def _split(lengths: np.ndarray, counts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(length, k): each count, as far as it fits, in powers of two and a rest."""
    for length, count in zip(lengths.tolist(), counts.tolist(), strict=True):
        left, k = min(count, most // length), 1
        while left > 0:
            k = min(k, left)
            yield length, k
            left -= k
            k *= 2


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come near ``budget``.

    Of the documents that the proportional part leaves, those whose words come nearest to what is missing, above or below:
    a plan that hits it is one, and without such a plan the dynamic programme goes over all of them in the end.
    """
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    part = np.array([c * budget // total for c in counts.tolist()], np.int64)
    order = np.argsort(-lengths, kind="stable")
    missing = budget - int((lengths * part).sum())
    last = max(DP_WORDS, LONGEST * int(lengths.max()))
    best, miss = part, missing
    while miss:
        take, rest = part.copy(), missing
        for j in order:
            if rest < last:
                break
            k = min(int(counts[j] - take[j]), (rest - last // 2) // int(lengths[j]))
            if k > 0:
                take[j] += k
                rest -= k * int(lengths[j])
        spare = counts - take
        use = np.array([j for j in order if spare[j] > 0], np.int64)
        most = rest + min(rest, int(lengths[use[0]]))  # of more words, one document could go
        by = {int(lengths[j]): j for j in use}
        for length, k in reach(lengths[use], spare[use], rest, most).items():
            take[by[length]] += k
        left = abs(budget - int((lengths * take).sum()))
        if left < miss:
            best, miss = take, left
        if last > missing:
            break
        last *= MORE
    return best


def _plan(x: pd.DataFrame) -> pd.DataFrame:
    x = x.sort_values("size").reset_index(drop=True)
    whole, target = int(x["source_size"].iloc[0]), float(x["target"].iloc[0])
    copies = min(int(target // whole), 2) if whole else 0
    budget = max(0, min(whole, round(target - copies * whole))) if copies < 2 else 0
    lengths, counts = x["size"].to_numpy(np.int64), x["n"].to_numpy(np.int64)
    return pd.DataFrame({"k": x["k"], "size": lengths, "copies": copies, "extra": fit_budget(lengths, counts, budget)})


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``sources`` (source, source_size) with ``k``, its rank by code point with null last, and ``target``.

    Targets are in proportion to the weights, which repeat by rank; a target stops at ``cap`` times its source's size
    and the excess is shared anew by weight until none is above. Ranking is by range partition with the partitions'
    row counts added up, and each of a few rounds of sharing sums over all sources and brings one row to the driver.
    """
    spark = sources.sparkSession
    sorted_ = sources.select("source", "source_size", F.col("source").isNull().alias("last")).orderBy("last", "source")
    ranked = written(sorted_.withColumn("p", F.spark_partition_id()).withColumn("i", F.monotonically_increasing_id()), "ranked")
    sizes = {r["p"]: (r["n"], r["least"]) for r in ranked.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("least")).collect()}  # a row per partition
    rows, before = [], 0
    for p in sorted(sizes):
        rows.append((p, before - sizes[p][1]))
        before += sizes[p][0]
    shift = spark.createDataFrame(rows, "p int, shift long")
    w = F.get(F.array(*[F.lit(float(v)) for v in weights]), F.pmod("k", F.lit(len(weights))).cast("int"))
    x = written(ranked.join(shift, "p").select("source", "source_size", (F.col("i") + F.col("shift")).alias("k")).withColumn("w", w), "weights")
    limit = cap * F.col("source_size")
    got = x.agg(F.sum("source_size").alias("all"), F.sum("w").alias("w"), F.max(limit / F.col("w")).alias("most")).first()
    total = share * (got["all"] or 0)
    rate, most = (total / got["w"] if got["w"] else 0.0), got["most"] or 0.0
    while True:
        # What is shared grows with the rate, ever more slowly as sources reach their limits. Of TRIED rates between a low and
        # a high one, the last that shares too little is the next low one, and what its free sources would have to take
        # is still too low or right; so a round leaves a TRIED-th of the range, whatever the number of sources.
        tried = [rate + (most - rate) * k / TRIED for k in range(TRIED)] if most > rate else [rate]
        over = [F.col("w") * F.lit(v) > limit for v in tried]
        got = x.agg(*[F.sum(F.when(o, limit).otherwise(0.0)).alias(f"capped{k}") for k, o in enumerate(over)], *[F.sum(F.when(o, 0.0).otherwise(F.col("w"))).alias(f"free{k}") for k, o in enumerate(over)]).first()
        new = rate
        for k, v in enumerate(tried):
            capped, free = got[f"capped{k}"] or 0.0, got[f"free{k}"] or 0.0
            if capped + free * v > total:
                most = v
                break
            new = max(v, (total - capped) / free if free else v)
        if not new > rate * (1 + 1e-12):
            break
        rate = new
    return x.select("source", "source_size", "k", F.least(F.col("w") * rate, cap * F.col("source_size")).alias("target"))


def mix_sources(docs: DataFrame, seed: int = 17, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, carry: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, ``source_size``, ``target``, ``copies`` (0, 1 or 2),
    ``taken`` (``copies * size``), and the columns of ``carry``.

    Every document of a source is taken as often as the target holds the whole source, and seeded documents once more
    until the source's words are as near the target as the lengths allow. Defined cases: null and empty texts have
    size 0 and are not taken; null sources are one source, last; rows of one id are documents of their own, and equal
    rows share a hash, so that which of them is taken doesn't show; rows of one id and size that differ in what is carried
    are ordered by it (by columns that can be ordered); an empty table gives an empty table.

    Scale: texts are read once for their sizes. Lengths are counted with partial sums; a task plans one source, whose
    rows are its distinct lengths and not its documents. Selection splits every (source, length) group, however hot,
    into hash buckets; buckets wholly in or out need a join only, and rows are ranked in the one bucket on the edge.
    """
    ship(docs.sparkSession)
    held = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(f"[^{WS_CLASS}]+")).cast("long")
    x = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), *held)
    x = written(x.withColumn("h", F.xxhash64(F.lit(seed), "doc_id")), "sizes")
    total = x.count()
    bits = min(max(math.ceil(math.log2(max(total, 2)) / 2), 4), 20)
    x = x.withColumn("bucket", F.shiftrightunsigned("h", 64 - bits))
    buckets = written(x.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("n")), "buckets")
    lengths = buckets.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sources = source_targets(buckets.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share)
    sources = sources.select(F.col("source").alias("s"), "source_size", "k", "target")
    by = lambda a: a.join(sources, F.col("source").eqNullSafe(F.col("s"))).drop("source", "s")
    plan = by(lengths.where("size > 0")).groupBy("k").applyInPandas(_plan, "k long, size long, copies int, extra long")
    edge = Window.partitionBy("k", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    dealt = by(buckets).join(plan, ["k", "size"], "left").na.fill(0, ["copies", "extra"])
    dealt = dealt.withColumn("before", F.coalesce(F.sum("n").over(edge), F.lit(0)))
    dealt = dealt.select("k", "size", "bucket", "source_size", "target", "copies", F.greatest(F.lit(0), F.least("n", F.col("extra") - F.col("before"))).alias("more"), "n")
    names = sources.select("s", "k")
    dealt = written(dealt.join(names, "k"), "dealt").withColumnsRenamed({"size": "z", "bucket": "b"})
    joined = x.join(dealt, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("bucket") == F.col("b")))
    edges = (F.col("more") > 0) & (F.col("more") < F.col("n"))
    out = lambda d, extra: d.select("doc_id", "size", "source_size", "target", (F.col("copies") + extra).alias("copies"), ((F.col("copies") + extra) * F.col("size")).cast("long").alias("taken"), *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)])
    rank = F.row_number().over(Window.partitionBy("k", "size", "bucket").orderBy("h", "doc_id", *[f"c{i}" for i in range(len(carry))]))
    inner = out(joined.where(~edges), F.when(F.col("more") > 0, 1).otherwise(0))
    on_edge = out(joined.where(edges).withColumn("r", rank), F.when(F.col("r") <= F.col("more"), 1).otherwise(0))
    return inner.unionByName(on_edge)

"""Quality rules by host: each document's rule failures, failure rates by host shrunk by an empirical beta prior,
and host verdicts joined back. DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WS, WS_CLASS, written

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
WINDOW = 5
#: A host is bad beyond so high a failure rate, or so many deviations above the others.
MAX_RATE, SIGMAS = 0.5, 2.0
#: Bad hosts are broadcast up to so many (some 10 MB), where nothing is stored.
BROADCAST_HOSTS = 100_000


def text_counts(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the five counts of FEATURES, long, over the whole of column ``text``.

    Counting stays inside the row, so nothing is shuffled. Windows of five words are compared by a 64-bit hash; only
    texts in which a hash repeats go on to the sorted pass that finds the words covered.
    """
    kept = docs.columns
    whole = F.coalesce(F.col(text), F.lit(""))
    bare = F.trim(whole, F.lit(WS))
    x = docs.select(*kept, F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{WS_CLASS}]+", -1)).alias("_w"), F.filter(F.split(whole, "\n", -1), lambda v: F.trim(v, F.lit(WS)) != "").alias("_l"), F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).alias("_s"))
    hashes = F.transform(F.sequence(F.lit(0), F.size("_w") - WINDOW), lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(WINDOW)]))
    x = x.select(*kept, F.size("_w").cast("long").alias("n_words"), F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"), F.col("_s").cast("long").alias("n_symbols"), (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"), F.when(F.size("_w") >= WINDOW, hashes).alias("_h"))
    x = x.withColumn("_o", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda v, k: (F.get("_o", k - 1)["h"] == v["h"]) | (F.get("_o", k + 1)["h"] == v["h"])
    x = x.withColumn("_p", F.when(F.col("_o").isNotNull(), F.sort_array(F.filter(F.transform("_o", lambda v, k: F.when(same(v, k), v["i"])), lambda v: v.isNotNull()))))
    covered = F.aggregate(F.transform("_p", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", k + 1) - p, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, b: a + b)
    return x.select(*kept, *FEATURES[:4], F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def rule_failures() -> dict[str, F.Column]:
    """The rules that a host is judged by, as predicates over FEATURES."""
    n = F.col("n_words")
    return {
        "short": n < 10,
        "repeats": 100 * F.col("n_repeat_words") > 20 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n),
        "dup_lines": F.col("n_dup_lines") >= 5,
    }


def host_rates(scored: DataFrame, host: str = "host", max_rate: float = MAX_RATE, sigmas: float = SIGMAS) -> DataFrame:
    """Per host: documents, per rule the failure rate shrunk towards all hosts' rate, and whether the host is ``bad``.

    The beta prior of each rule is fitted by moments over the hosts' raw rates; where the hosts differ no more than
    chance has it, the prior's strength is 1000 documents. A host is bad if for some rule its shrunk rate, less ``sigmas``
    of its own deviations, is above the prior's mean and ``sigmas`` of the prior's deviations, or above ``max_rate`` if
    that is less. One row of moments comes to the driver.
    """
    rules = list(rule_failures())
    hosts = written(scored.groupBy(host).agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(f"fail_{r}").cast("long")).alias(r) for r in rules]), "hosts")
    many = F.sum("n")
    got = hosts.agg(many.alias("n"), F.count(F.lit(1)).alias("hosts"), *[F.sum(r).alias(r) for r in rules], *[F.sum(F.col(r) * F.col(r) / F.col("n")).alias(f"{r}_sq") for r in rules]).first()
    out, bad = hosts, F.lit(False)
    for r in rules:
        total, k = got["n"] or 0, got["hosts"]
        mean = (got[r] or 0) / total if total else 0.0
        between = max(((got[f"{r}_sq"] or 0) / total - mean * mean) if total else 0.0, 0.0)
        chance = mean * (1 - mean) * k / total if total else 0.0
        spread = between - chance
        strength = min(max(mean * (1 - mean) / spread - 1, 1.0), 1000.0) if spread > 1e-12 else 1000.0
        limit = min(max_rate, mean + sigmas * math.sqrt(mean * (1 - mean) / (strength + 1)))
        rate = F.col(f"rate_{r}")
        out = out.withColumn(f"rate_{r}", (F.col(r) + F.lit(mean * strength)) / (F.col("n") + F.lit(strength)))
        bad = bad | (rate - sigmas * F.sqrt(rate * (1 - rate) / (F.col("n") + F.lit(strength + 1))) > F.lit(limit))
    return out.select(host, F.col("n").alias("host_docs"), *[f"rate_{r}" for r in rules], bad.alias("host_bad"))


def host_quality(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), text_col: str = "text", host_col: str = "source", max_rate: float = MAX_RATE, sigmas: float = SIGMAS, rates: bool = False, stored: bool = True) -> DataFrame:
    """One row per row of ``docs``: the columns of ``carry``, FEATURES (long), ``base_failed`` and ``kept`` (boolean); with
    ``rates`` also ``host_docs``, the shrunk rates of its host and ``host_bad``.

    A document is dropped if it has under 10 words or over 20 % of them in repeated windows (``base_failed``), or if
    its host is bad (see ``host_rates``) and the document itself fails a rule: a bad host gets no benefit of the doubt,
    a clean document on it stays. Defined cases: null text has no words; null hosts form one host; repeated rows are
    judged each; an empty table gives an empty table; carried columns may have any name.

    Scale: texts are read once and not shuffled: the counts are written, with what is carried, and summed by host with
    partial sums. Only documents that fail a rule without failing the base meet the bad hosts, which are the few rows that
    Spark broadcasts if their measured size allows. With ``rates``, all documents meet all hosts. Where whole texts are
    carried, writing them would take as much disk as the input: without ``stored`` nothing is written but sums by host,
    and the counts are made a second time for the verdicts (of more than BROADCAST_HOSTS bad hosts, they are written then).
    """
    held = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    names = [f"c{i}" for i in range(len(carry))]
    x = text_counts(docs.select(F.col(host_col).alias("host"), F.col(text_col).alias("t"), *held), "t").drop("t")
    rules = rule_failures()
    failed = F.lit(False)
    for v in rules.values():
        failed = failed | v
    x = x.select("host", *names, *FEATURES, *[v.alias(f"fail_{r}") for r, v in rules.items()], (rules["short"] | rules["repeats"]).alias("base_failed"), failed.alias("failed"))
    if stored:
        x = written(x, "counts")
    else:  # a filter is not moved below a row number, where each of its parts would count anew
        x = x.withColumn("at", F.monotonically_increasing_id())
    hosts = written(host_rates(x, "host", max_rate, sigmas), "rates")
    out = [*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], *FEATURES, "base_failed"]
    if rates:
        more = ["host_docs", *[f"rate_{r}" for r in rules], "host_bad"]
        y = x.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h")))
        return y.select(*out, (~F.col("base_failed") & ~(F.col("host_bad") & F.col("failed"))).alias("kept"), *more)
    suspect = F.col("failed") & ~F.col("base_failed")
    bad = hosts.where("host_bad").select(F.col("host").alias("h"), "host_bad")
    if not stored and bad.count() > BROADCAST_HOSTS:
        x = written(x.drop("at"), "counts")
    elif not stored:
        judged = x.join(F.broadcast(bad), F.col("host").eqNullSafe(F.col("h")), "left")
        good = ~F.col("base_failed") & ~(F.col("failed") & F.col("host_bad").isNotNull())
        return judged.select(*out, (good & (F.col("at") >= 0)).alias("kept"))
    judged = x.where(suspect).join(bad, F.col("host").eqNullSafe(F.col("h")), "left").select(*out, F.col("host_bad").isNull().alias("kept"))
    return x.where(~suspect).select(*out, (~F.col("base_failed")).alias("kept")).unionByName(judged)

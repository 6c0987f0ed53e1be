"""Personal data: base patterns, and identifiers that bootstrapped contexts discover.

Seeds (the base entities, and long runs of hexadecimal digits) induce lexical patterns: the sign and word that lead up to
them, the two words before, a word on either side. Spark scores the graph of patterns and instances in rounds, against all
that a pattern leads to anywhere in the texts, and what stands in a pattern of high confidence and has an identifier's shape
becomes a span of kind ``secret``.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, written

#: Kinds in the order in which spans are listed; the last is the method's own.
KINDS = ["email", "ip", "card", "phone", "secret"]
ROUNDS = 3
#: A pattern counts once it has led to so many different positive instances; instances from this confidence on are spans.
SUPPORT, CONFIDENCE = 2, 0.8
PATTERN_SALTS = 16

# The base patterns. Where a run could be entered in the middle, the entry is held to its start, and
# repeats that can't give back are possessive: the same matches, in a time that grows with the text only.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NON_DIGIT = re.compile(r"[^0-9]+")
_CANDIDATE = re.compile(r"[A-Za-z0-9_-]++(?:(?<=[0-9])\x20[0-9][A-Za-z0-9_-]*+)*+")
_HEX = re.compile(r"(?:[0-9a-f]{32,}|[0-9A-F]{32,})\Z")
_ANCHOR = re.compile(r"[=:#\"'][\x20\t]?[\"']?\Z")
#: Signs that name what follows, with the blanks around them; what ends the word before them; what may stand around a word.
_SIGNS, _ENDS, _OUTER = frozenset(" \t=:#\"'"), frozenset("=:#\"'|,;({["), "!\"'(),.;?[]{}:=#*$%&|<>"
_LED = re.compile(r"[=:#\"'][\x20\t]?[\"']?(?=[^\s=:#\"'])")
_TOKEN, _DIGITS = re.compile(r"\S+"), re.compile("[0-9]+")
_MIX, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
#: Bits of the filter that holds back patterns of words that aren't asked for (2 MB), and hashes of words that a worker keeps.
BLOOM, _CACHED = 1 << 24, 500_000
#: Patterns are counted in every 64th text, those not yet ruled out in every 8th, and what is left in all.
SHARES = (64, 8, 1)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    for d in digits[-2::-2]:
        x = 2 * int(d)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """The spans of the e-mail pattern: from each @ the local part is followed back, so that long runs cost no more."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and (not part or int(part) <= 255)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base kinds, by kind and then start."""
    out = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NON_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NON_DIGIT.sub("", m[0])) <= 15]
    return out


def signed_context(text: str, start: int) -> str | None:
    """The sign that directly leads up to ``start`` with the word before it, lower-cased, digits as 0; None without a sign."""
    if not _ANCHOR.search(text[max(0, start - 3) : start]):
        return None
    j = start
    while j and text[j - 1] in _SIGNS:
        j -= 1
    k = j
    while k and not text[k - 1].isspace() and text[k - 1] not in _ENDS:
        k -= 1
    return _DIGITS.sub("0", text[k:start].lower())


def word_hash(token: str) -> int:
    """64 bits of a token without its outer signs, lower-cased, digits as 0; 0 if it has no letter."""
    word = _DIGITS.sub("0", token.strip(_OUTER).lower())
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) | 1 if any(map(str.isalpha, word)) else 0


def paired(first: int, second: int, side: int) -> int | None:
    """The pattern of two words: both before (side 0), or one on either side (1); None unless both have letters."""
    if not first or not second:
        return None
    v = (first * _MIX + second + side * 2) & _MASK
    return v - (1 << 64) if v >> 63 else v


def identifier(word: str) -> bool:
    """The shape of an unseen identifier: at least three digits."""
    return sum(map(word.count, "0123456789")) >= 3


def patterns(text: str, tokens: list[tuple[int, int]], starts: list[int], s: int, e: int) -> list[int]:
    """The contexts of text[s:e] as 64-bit numbers: of signs, of the two words before, of a word on either side."""
    out = []
    sign = signed_context(text, s)
    if sign is not None:
        out.append(xxhash.xxh64_intdigest(sign.encode("utf-8", "surrogatepass")) - (1 << 63))
    i = bisect_right(starts, s) - 1
    head, tail = text[tokens[i][0] : s], text[e : tokens[i][1]]
    if len(head) > 8 or head.strip(_OUTER):
        return out
    word = lambda k: word_hash(text[slice(*tokens[k])]) if 0 <= k < len(tokens) else 0
    near = [paired(word(i - 2), word(i - 1), 0)]
    if e <= tokens[i][1] and len(tail) <= 8 and not tail.strip(_OUTER):
        near.append(paired(word(i - 1), word(i + 1), 1))
    return out + [p for p in near if p is not None]


def candidates(text: str, base: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int, bool, int, int]], list[int]]:
    """What stands in contexts, as (pattern, instance hash, seed, start, end), base entities as seeds without a span of their own;
    and the patterns of signs that lead to anything else."""
    taken = sorted((s, e) for _, s, e in base)
    starts, ends = [s for s, _ in taken], list(accumulate((e for _, e in taken), max, initial=-1))
    spans = [(s, e, True, -1, -1) for _, s, e in base]
    for m in _CANDIDATE.finditer(text):
        s, e = m.span()
        if identifier(m[0]) and ends[bisect_left(starts, e)] <= s:
            spans.append((s, e, bool(_HEX.match(m[0])), s, e))
    known = {s for s, *_ in spans}
    others = [xxhash.xxh64_intdigest(signed_context(text, m.end()).encode("utf-8", "surrogatepass")) - (1 << 63) for m in _LED.finditer(text) if m.end() not in known]
    if not spans:
        return [], others
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    at = [s for s, _ in tokens]
    out = []
    for s, e, seed, first, last in spans:
        instance = xxhash.xxh64_intdigest(text[s:e].encode("utf-8", "surrogatepass")) - (1 << 63)
        out += [(p, instance, seed, first, last) for p in patterns(text, tokens, at, s, e)]
    return out, others


_SPAN = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
_FOUND = pa.list_(pa.struct([("pattern", pa.int64()), ("instance", pa.int64()), ("seed", pa.bool_()), ("start", pa.int64()), ("end", pa.int64())]))


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 40
    for b in batches:
        spans, found, others = [], [], []
        for t in b["text"]:
            text = t.as_py() or ""
            base = base_spans(text)
            spans.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
            at, rest = candidates(text, base)
            found.append([dict(zip(("pattern", "instance", "seed", "start", "end"), c, strict=True)) for c in at])
            others.append(rest)
        yield pa.RecordBatch.from_arrays([b["id"], pa.array(range(row, row + len(spans)), pa.int64()), pa.array(spans, _SPAN), pa.array(found, _FOUND), pa.array(others, pa.list_(pa.int64()))], names=["id", "row", "base", "found", "others"])
        row += len(spans)


_hashes: dict[str, int] = {}


def word_contexts(text: str) -> np.ndarray:
    """The patterns of two words around every token of a text, both kinds, as ``paired`` has them."""
    tokens = text.split()
    if len(_hashes) > _CACHED:
        _hashes.clear()
    for t in set(tokens).difference(_hashes):
        _hashes[t] = word_hash(t)
    h = np.array([_hashes[t] for t in tokens] or [0], np.uint64)
    out = []
    for side, (first, second) in enumerate(((h[:-1], h[1:]), (h[:-2], h[2:]))):
        if side == 0:  # a pair just before the text's end leads to nothing
            first, second = first[:-1], second[:-1]
        ok = (first != 0) & (second != 0)
        out.append((first * np.uint64(_MIX) + second + np.uint64(side * 2))[ok])
    return np.concatenate(out).view(np.int64)


def _counts(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """(pattern, n): how often each pattern of ``asked`` occurs around any token of ``texts``.

    A Bloom filter of BLOOM bits, as large for any corpus, keeps others back in the tasks; the join on patterns does the rest.
    """
    bits = F.array(*[F.pmod(c, F.lit(BLOOM)) for c in (F.col("pattern"), F.shiftrightunsigned("pattern", 24))])
    x = asked.select(F.explode(bits).alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("set"))
    words = np.zeros(BLOOM >> 6, np.int64)
    for r in x.collect():
        words[r["word"]] = r["set"]
    words = words.view(np.uint64)

    def has(bit: np.ndarray) -> np.ndarray:
        bit = bit & np.uint64(BLOOM - 1)
        return (words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = [word_contexts(t.as_py() or "").view(np.uint64) for t in b["text"]]
            p = np.concatenate([p[has(p) & has(p >> np.uint64(24))] for p in every])
            p, n = np.unique(p.view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(n)], names=["pattern", "n"])

    return texts.mapInArrow(counted, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).join(asked.select("pattern"), "pattern", "left_semi")


def word_totals(docs: DataFrame, asked: DataFrame, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The patterns of ``asked`` (pattern, have, times) that may still be sure of something, and for those of words
    (pattern, n): how often they lead to anything else.

    What a pattern leads to in a share of the texts can be enough to rule it out, however the rest may be; the shares
    of SHARES do so for common pairs of words. What is left is counted over all texts.
    """
    texts = docs.select(F.col(text_col).alias("text"))
    for share in SHARES:
        part = texts if share == 1 else texts.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0)
        rest = asked.select("pattern", "have", "times").join(_counts(part, asked), "pattern", "left").withColumn("n", F.greatest(F.coalesce("n", F.lit(0)) - F.col("times"), F.lit(0)))
        asked = written(rest.where(F.col("have") / (F.col("have") + F.col("n") + 0.5) >= CONFIDENCE), "patterns")
    return asked.select("pattern"), asked.where("n > 0").select("pattern", "n")


def score_graph(edges: DataFrame, rounds: int = ROUNDS, others: DataFrame | None = None) -> DataFrame:
    """(pattern, instance, confidence) from edges (pattern, instance, seed), one row per pair.

    A pattern's confidence is the sum of its instances' scores over their number, that of its ``others`` (pattern, n: how
    often it leads to something else) and a half; an instance scores 1 as a seed, else the best confidence of its patterns
    with enough positive instances. Each round is written. Without edges there is no row.
    """
    scored = written(edges.withColumn("score", F.col("seed").cast("double")), "round")
    for _ in range(rounds):
        positive = F.count(F.when(F.col("score") >= CONFIDENCE, 1))
        sums = scored.groupBy("pattern").agg(F.sum("score").alias("sum"), F.count(F.lit(1)).alias("have"), positive.alias("positive")).where(F.col("positive") >= SUPPORT)
        rest = F.lit(0)
        if others is not None:
            sums, rest = sums.join(others, "pattern", "left"), F.coalesce("n", F.lit(0))
        patterns = sums.select("pattern", (F.col("sum") / (F.col("have") + rest + 0.5)).alias("c"))
        # A pattern of very many instances is dealt to PATTERN_SALTS tasks.
        salted = scored.select("pattern", "instance", "seed", "score", F.pmod(F.xxhash64("instance"), F.lit(PATTERN_SALTS)).cast("int").alias("salt"))
        patterns = patterns.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(PATTERN_SALTS - 1))))
        led = salted.join(patterns, ["pattern", "salt"], "left").drop("salt").withColumn("c", F.coalesce("c", F.lit(0.0)))
        best = led.groupBy("instance").agg(F.max("c").alias("best"), F.max("seed").alias("known"))
        scored = written(led.join(best, "instance").select("pattern", "instance", "seed", "c", F.when(F.col("known"), 1.0).otherwise(F.col("best")).alias("score")), "round")
    return scored.select("pattern", "instance", F.col("c").alias("confidence"))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``base`` and ``more``, arrays of (kind, start, end) over code points, end exclusive.

    ``base`` has the base kinds (0 to 3 of KINDS), leftmost and not overlapping within a kind; ``more`` what contexts add
    (kind 4), apart from all base spans. Defined cases: null and empty texts have no spans; rows of one id are searched
    each; null ids stay; an empty table gives an empty table; extra columns are not read.

    Scale: one pass over the texts writes the spans and candidates, a second one counts the patterns that several instances
    share; only those, as hashes, are grouped, and a filter of fixed size keeps all other pairs of words in their tasks.
    Edges are one per pattern and instance before anything is joined, and sums by pattern are partial first.
    """
    ship(docs.sparkSession)
    x = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = x.schema["id"].dataType.simpleString()
    x = written(x.mapInArrow(_searched, f"id {kind}, row long, base array<struct<kind:int,start:long,end:long>>, found array<struct<pattern:long,instance:long,seed:boolean,start:long,end:long>>, others array<long>"), "found")
    each = x.where(F.size("found") > 0).select("row", F.explode("found").alias("f")).select("row", "f.*")
    # Only patterns of enough instances, and of some that may become spans, can count; what else they lead to is counted.
    edges = written(each.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.count(F.lit(1)).alias("times"), F.max(F.col("start") >= 0).alias("spans")), "edges")
    asked = written(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("have"), F.sum("times").alias("times"), F.max("spans").alias("spans")).where((F.col("have") >= SUPPORT) & F.col("spans")), "patterns")
    asked, words = word_totals(docs, asked.select("pattern", "have", "times"), text_col)
    signs = x.select(F.explode("others").alias("pattern")).groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).join(asked, "pattern", "left_semi")
    others = written(signs.unionByName(words).groupBy("pattern").agg(F.sum("n").alias("n")), "others")
    edges = edges.join(asked, "pattern", "left_semi").select("pattern", "instance", "seed")
    sure = score_graph(edges, others=others).where(F.col("confidence") >= CONFIDENCE).select("pattern", "instance")
    spans = each.where("start >= 0").join(sure, ["pattern", "instance"], "left_semi")
    more = spans.groupBy("row").agg(F.sort_array(F.collect_set(F.struct(F.lit(KINDS.index("secret")).alias("kind"), "start", "end"))).alias("more"))
    return x.join(more, "row", "left").select("id", "base", F.coalesce("more", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")).alias("more"))


def listed(spans: F.Column) -> F.Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

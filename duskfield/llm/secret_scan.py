"""Secret scans: base patterns, and strings that a Markov model of random characters explains better than one of words.

Two first-order models over characters are trained from labelled samples: random strings (what the hex and access patterns
match, and seeded uniform draws over common alphabets) and ordinary ones (all text but for base spans and candidates, and
seeded decimal numbers). A long run of identifier characters is a span if the log-likelihood ratio of the two says so.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, written

#: Kinds in the order in which spans of one start are listed; the last is the method's own.
KINDS = ["assign", "access", "hex", "random"]

# The base patterns. Runs are held to their starts, and a run that is too short holds no match that isn't.
_ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

#: Characters a random string may have; all others are one state, which also begins and ends a string.
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_-"
#: Seeded samples of random strings: alphabets, and how many strings of how many characters each.
ALPHABETS = {"hex": ALPHABET[:10] + "abcdef", "base32": ALPHABET[10:36] + "234567", "base62": ALPHABET[:62], "base64": ALPHABET[:64], "base64url": ALPHABET[:62] + "_-"}
DRAWS, DRAWN_LENGTH, SEED = 2000, 40, 11
ORDINARY = 1_000_000
#: Candidates are runs of so many characters or more; they are spans from this log-likelihood ratio (nats) on.
LEAST, MARGIN = 16, 16.0
_CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST},}}")

_STATES = len(ALPHABET) + 1
_STATE = np.zeros(256, np.int64)
_STATE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, _STATES)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base kinds, by start and then kind."""
    out = [(0, m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        out += [(1, m.start(), m.end()) for m in _ACCESS.finditer(text)]
    out += [(2, m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], s[0]))


def transitions(text: str) -> np.ndarray:
    """Counts of pairs of states over the text, which other characters surround."""
    s = _STATE[np.frombuffer(f" {text} ".encode("utf-8", "surrogatepass"), np.uint8)]
    return np.bincount(s[:-1] * _STATES + s[1:], minlength=_STATES * _STATES)


def drawn_strings(alphabets: list[str], draws: int = DRAWS, length: int = DRAWN_LENGTH, seed: int = SEED) -> list[str]:
    """The seeded samples: uniform strings over each alphabet."""
    rng = np.random.default_rng(seed)
    return ["".join(row) for a in alphabets for row in np.array(list(a))[rng.integers(0, len(a), (draws, length))]]


def ratios(found: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """ln P(b | a) under the random model less that under the ordinary one. What was ``found`` weighs as much as the draws from
    one alphabet and ordinary text as ORDINARY pairs, whatever the corpus has of either; each pair counts one more."""
    drawn, numbers = (sum(map(transitions, drawn_strings(a))) for a in (list(ALPHABETS.values()), [ALPHABET[:10]]))

    def logs(n):
        n = n.reshape(_STATES, _STATES) + 1.0
        return np.log(n / n.sum(1, keepdims=True))

    share = lambda n, size: n * (size / max(n.sum(), 1))
    return logs(drawn + share(found, DRAWS * DRAWN_LENGTH)) - logs(numbers + share(ordinary, ORDINARY))


def evidence(value: str, table: np.ndarray) -> float:
    """The log-likelihood ratio of a whole string, its first character given a boundary before it."""
    s = _STATE[np.frombuffer(f" {value}".encode(), np.uint8)]
    return float(table[s[:-1], s[1:]].sum())


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The runs of identifier characters apart from base spans."""
    by_start = sorted((s, e) for _, s, e in base)
    starts, ends = [s for s, _ in by_start], list(accumulate((e for _, e in by_start), max, initial=-1))
    return [m.span() for m in _CANDIDATE.finditer(text) if ends[bisect_left(starts, m.end())] <= m.start()]


_SPAN = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
_FOUND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))
_NAMES = ["id", "base", "found", "random", "ordinary"]


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans and candidates of each text; at the end one row with the partition's transition counts for both models."""
    counts = [np.zeros(_STATES * _STATES, np.int64) for _ in range(2)]
    kind = None
    empty = pa.list_(pa.int64())
    for b in batches:
        kind, spans, found = b["id"].type, [], []
        for t in b["text"]:
            text = t.as_py() or ""
            base = base_spans(text)
            spans.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
            more = candidates(text, base)
            found.append([{"start": s, "end": e, "value": text[s:e]} for s, e in more])
            rest, at = [], 0
            for s, e in sorted([*((s, e) for _, s, e in base), *more]):
                rest.append(text[at:s])
                at = max(at, e)
            for _, s, e in (x for x in base if x[0]):
                counts[0] += transitions(text[s:e])
            counts[1] += transitions(" ".join([*rest, text[at:]]))
        yield pa.RecordBatch.from_arrays([b["id"], pa.array(spans, _SPAN), pa.array(found, _FOUND), *[pa.nulls(len(spans), empty)] * 2], names=_NAMES)
    if kind is not None:
        yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.nulls(1, _SPAN), pa.nulls(1, _FOUND), *[pa.array([c], empty) for c in counts]], names=_NAMES)


def models(found: DataFrame) -> np.ndarray:
    """The table of log-likelihood ratios from the partitions' counts: two small matrices come to the driver."""
    sums = found.where("random is not null").select(F.posexplode(F.arrays_zip("random", "ordinary")).alias("pair", "n")).groupBy("pair").agg(F.sum("n.random").alias("r"), F.sum("n.ordinary").alias("o"))
    both = np.zeros((2, _STATES * _STATES))
    for r in sums.collect():
        both[:, r["pair"]] = r["r"], r["o"]
    return ratios(*both)


def find_secrets(docs: DataFrame, margin: float = MARGIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``base`` and ``more``, arrays of (kind, start, end) over code points, end exclusive.

    ``base`` has the base kinds (0 to 2 of KINDS), ``more`` the runs of LEAST characters or more, apart from base spans, whose
    log-likelihood ratio is ``margin`` or more (kind 3). Defined cases: null and empty texts have no spans; rows of one id
    are searched each; null ids stay; an empty table gives an empty table; other columns are not read.

    Scale: one pass over the texts writes spans, candidates and a partition's counts (two matrices of 67 by 67); the models
    are their sums over all texts. The second pass reads candidates only; no text and no row is shuffled.
    """
    spark = docs.sparkSession
    ship(spark)
    x = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = x.schema["id"].dataType.simpleString()
    span = "array<struct<kind:int,start:long,end:long>>"
    x = written(x.mapInArrow(_searched, f"id {kind}, base {span}, found array<struct<start:long,end:long,value:string>>, random array<long>, ordinary array<long>"), "secrets")
    table = models(x)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            more = [[{"kind": 3, "start": c["start"], "end": c["end"]} for c in row if evidence(c["value"], table) >= margin] for row in b["found"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["id"], b["base"], pa.array(more, _SPAN)], names=["id", "base", "more"])

    return x.where("base is not null").select("id", "base", "found").mapInArrow(judged, f"id {kind}, base {span}, more {span}")


def listed(spans: F.Column) -> F.Column:
    """kind:start:end by start and then kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

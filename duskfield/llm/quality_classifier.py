"""Quality classifier: random Fourier features of document statistics, ridge by partition-summed normal equations,
isotonic calibration.

Statistics of whole texts are standardised and mapped by random cosines, whose inner products approximate a Gaussian
kernel. Partitions sum their parts of the normal equations, the sums are added up and solved once, and raw scores are
made probabilities by isotonic regression on labelled documents that the equations left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, written

#: Names of the statistics, in the order that ``statistics`` gives them.
STATISTICS = ["log_bytes", "log_words", "word_bytes", "upper", "digits", "other_bytes", "spaces", "line_ends", "symbols", "pipes", "marks", "ends", "brackets", "word_variety", "pair_variety", "line_variety", "longest_word", "upper_words", "byte_entropy"]
FEATURES = 256
#: The kernel's width in standard deviations of a statistic, times the square root of their number.
WIDTH = 0.7
RIDGE = 1e-3
#: So many tasks at most send partial sums of the normal equations.
SUMMING_TASKS = 1024
#: Calibration sees raw scores by bins of this width.
BIN = 1e-3


def _mask(chars: str) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars.encode())] = 1
    return out


_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_MASKS = np.stack([_mask(_LETTERS.upper()), _mask("0123456789"), np.r_[np.zeros(128), np.ones(128)], _mask(" \t\r\x0b\x0c"), _mask("\n"), _mask("#*$%&<>~^=_"), _mask("|"), _mask("!?"), _mask(".,;:"), _mask("()[]{}\"'@/\\+")])


def statistics(text: bytes) -> list[float]:
    """The statistics of one text; all of them are finite, those of an empty text are 0."""
    n = len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = (_MASKS @ counts) / n
    p = counts[counts > 0] / n
    words = text.split()
    k = max(len(words), 1)
    lines = text.split(b"\n")
    pairs = len(set(zip(words, words[1:], strict=False)))
    upper = sum(map(bytes.isupper, words)) / k
    return [np.log1p(n), np.log1p(len(words)), min(n / k, 50.0), *shares.tolist(), len(set(words)) / k, pairs / max(k - 1, 1), len(set(lines)) / len(lines), np.log1p(max(map(len, words), default=0)), upper, float(-(p * np.log(p)).sum())]


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [statistics(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in b["text"]]
        yield pa.RecordBatch.from_arrays([b["id"], pa.array(rows, pa.list_(pa.float64()))], names=["id", "stats"])


class Fourier:
    """z(x) = sqrt(2 / D) cos(W (x - mean) / std + b), with a constant and the standardised statistics beside it."""

    def __init__(self, mean: np.ndarray, std: np.ndarray, features: int = FEATURES, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.std = mean, np.where(std > 1e-9, std, 1.0)
        self.w = rng.standard_normal((len(mean), features)) / (WIDTH * np.sqrt(len(mean)))
        self.b = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.std, -8, 8)
        return np.hstack([np.ones((len(x), 1)), x / 8, np.sqrt(2 / len(self.b)) * np.cos(x @ self.w + self.b)])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), len(STATISTICS))


def _normal(fourier: Fourier):
    """stats, y -> this partition's sums: row i of (Z'Z | Z'y)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            z = fourier(_matrix(b["stats"]))
            part = z.T @ np.hstack([z, b["y"].to_numpy()[:, None]])
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    return run


def _added(table: pa.Table) -> pa.Table:
    rows = table["row"].combine_chunks()
    total = rows.flatten().to_numpy().reshape(len(rows), -1).sum(axis=0)
    return pa.table({"i": table["i"].slice(0, 1), "row": pa.array([total], pa.list_(pa.float64()))})


def isotonic(x: np.ndarray, total: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing means of ``total / weight`` over sorted ``x`` (pool adjacent violators): block centres and values."""
    blocks: list[list[float]] = []  # sum of y, weight, sum of weight * x
    for a, s, w in zip(x, total, weight, strict=True):
        blocks.append([s, w, w * a])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            top = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], top, strict=True)]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


def _scored(fourier: Fourier, beta: np.ndarray, at: np.ndarray | None, values: np.ndarray | None):
    """id, stats -> id, score: raw without a calibration, else calibrated; a little of the raw score keeps its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = fourier(_matrix(b["stats"])) @ beta
            if at is not None:
                steady = 1 / (1 + np.exp(-4 * np.clip(raw - 0.5, -5, 5)))
                raw = np.clip(0.995 * np.interp(raw, at, values) + 0.005 * steady, 0, 1)
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(raw, pa.float64())], names=["id", "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Learns from the rows of ``labels`` whose crc32(id as text) mod 3 is not 1; labels, language, source and id are no
    inputs of a score. A tenth of the learning rows, by another hash, calibrates. Defined cases: null or empty texts
    have statistics of 0 and a score like any; null ids are held out; a document with two labels counts with each; rows
    of one id are scored each; without labels to learn from, every score is 0.5; an empty table gives an empty table.

    Scale: texts are read once, for the statistics, which are written; labels meet those by id. A partition sends its
    sums, whose size is fixed by ``FEATURES``, and the driver gets one matrix and the calibration's bins.
    """
    ship(docs.sparkSession)
    x = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = x.schema["id"].dataType.simpleString()
    stats = written(x.mapInArrow(_described, f"id {kind}, stats array<double>"), "statistics")
    fold = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(3))
    marked = labels.select(F.col(id_col).alias("lid"), F.col(label_col).cast("double").alias("y")).where("y is not null")
    known = stats.where(fold != 1).join(marked, F.col("id") == F.col("lid")).select("id", "stats", "y", (F.pmod(F.xxhash64("id"), F.lit(10)) == 0).alias("calibrates"))
    known = written(known, "labelled")
    k = len(STATISTICS)
    moments = known.select(F.posexplode("stats")).groupBy("pos").agg(F.avg("col").alias("m"), F.stddev_pop("col").alias("s")).collect()  # a row per statistic
    held_out = F.coalesce(fold == 1, F.lit(True))
    if not moments:
        return stats.select(F.col("id").alias("doc_id"), held_out.alias("held_out"), F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))
    mean, std = np.zeros(k), np.ones(k)
    for r in moments:
        mean[r["pos"]], std[r["pos"]] = r["m"], r["s"]
    fourier = Fourier(mean, std)
    sums = known.where("not calibrates").select("stats", "y").coalesce(SUMMING_TASKS).mapInArrow(_normal(fourier), "i int, row array<double>").groupBy("i").applyInArrow(_added, "i int, row array<double>").collect()  # one matrix
    if not sums:  # too few labels to leave any out
        sums = known.select("stats", "y").coalesce(SUMMING_TASKS).mapInArrow(_normal(fourier), "i int, row array<double>").groupBy("i").applyInArrow(_added, "i int, row array<double>").collect()
    both = np.array([r["row"] for r in sorted(sums, key=lambda r: r["i"])])
    gram, right = both[:, :-1], both[:, -1]
    ridge = RIDGE * np.eye(len(gram)) * gram[0, 0]
    ridge[0, 0] = 1e-9
    beta = np.linalg.solve(gram + ridge, right)
    rows = known.select("y", "calibrates", F.monotonically_increasing_id().alias("id"), "stats")
    left_out = rows.where("calibrates")
    if not left_out.limit(1).count():
        left_out = rows
    raw = left_out.select(F.struct("id", "y").alias("id"), "stats").mapInArrow(_scored(fourier, beta, None, None), "id struct<id:long,y:double>, score double")
    bins = raw.groupBy(F.floor(F.col("score") / BIN).alias("bin")).agg(F.sum("id.y").alias("t"), F.count(F.lit(1)).alias("w"), F.avg("score").alias("x")).orderBy("bin").collect()  # bins of clipped scores
    at, values = isotonic(*[np.array([r[c] for r in bins], float) for c in ("x", "t", "w")])
    got = stats.mapInArrow(_scored(fourier, beta, at, values), f"id {kind}, score double")
    return got.select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

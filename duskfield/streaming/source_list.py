"""The growing source list as state: every exposure's detections meet the sources that earlier exposures opened.

``graph.source_list`` computes the list from all exposures; here it grows as they arrive. State is keyed by cell of the sky. A
cell decides its own detections; a source that it opens near its border is announced to the cells across it, through a
folder that the same stream reads, and is part of their state before the next exposure is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.geometry import unit_vector
from .ingest import rocksdb

_BITS = 21
#: What goes in and comes out; no column is ever null, as pandas would make numbers of it that aren't whole.
ROWS = "kind int, cell long, epoch_id long, det_id long, source long, x double, y double, z double"
DETECTION, ANNOUNCEMENT, DECISION = 0, 1, 2
_COLUMNS = ["kind", "cell", "epoch_id", "det_id", "source", "x", "y", "z"]
_KNOWN = ["epoch_id", "source", "x", "y", "z"]
#: Cells are so many radii wide: few announcements, and few cells, as each costs some milliseconds an exposure.
WIDTH = 256
#: Pairs of a detection and a source that are held at a time.
PAIRS = 1 << 20


def reach(radius: float) -> float:
    """The chord of an angle in arcsec."""
    return 2 * math.sin(math.radians(radius / 3600) / 2)


def cell_of(x: float, y: float, z: float, size: float) -> int:
    a, b, c = (math.floor(v / size) + (1 << (_BITS - 1)) for v in (x, y, z))
    return (a << 2 * _BITS) + (b << _BITS) + c


def first_near(at: np.ndarray, sources: np.ndarray, reach: float) -> np.ndarray:
    """Of each position (rows of x, y, z) the place of the first of ``sources`` within ``reach``, or len(sources) without any.

    Sources are sorted by boxes as wide as the reach; a position meets those of the 27 boxes around it, PAIRS at a time."""
    none = len(sources)
    first = np.full(len(at), none)
    if not none or not len(at):
        return first
    boxes = np.floor(np.concatenate([sources, at]) / reach).astype(np.int64)
    boxes -= boxes.min(axis=0) - 1
    wide = boxes.max(axis=0) + 2  # of one cell: a few hundred a side
    code = (boxes[:, 0] * wide[1] + boxes[:, 1]) * wide[2] + boxes[:, 2]
    order = np.argsort(code[:none], kind="stable")
    held, mine = code[:none][order], code[none:]
    for step in ((a * wide[1] + b) * wide[2] + c for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)):
        low, high = (np.searchsorted(held, mine + step, side) for side in ("left", "right"))
        some = np.flatnonzero(high > low)
        ends = np.cumsum(high[some] - low[some])
        for pairs in np.split(np.arange(len(some)), np.flatnonzero(np.diff(ends // PAIRS)) + 1):
            who = some[pairs]
            n = high[who] - low[who]
            i = np.repeat(who, n)
            j = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[who], n)]
            near = np.sqrt(((sources[j] - at[i]) ** 2).sum(axis=1)) <= reach
            np.minimum.at(first, i[near], j[near])
    return first


class Sources(StatefulProcessor):
    """One cell's sources: those that it opened, and those announced by the cells around it. Of several at one position only
    the first, by exposure and key, can ever be found, so that no other is kept or announced. An element of the state is
    what one trigger has added, as arrays."""

    def __init__(self, radius: float):
        self.reach = reach(radius)
        self.size = max(WIDTH * self.reach, 2.0 ** (2 - _BITS))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getListState("known", "epoch_id array<long>, source array<long>, x array<double>, y array<double>, z array<double>")

    def _held(self) -> pd.DataFrame:
        parts = [pd.DataFrame({c: np.asarray(v) for c, v in zip(_KNOWN, p, strict=True)}) for p in self.known.get()]
        return pd.concat(parts) if parts else pd.DataFrame({c: np.empty(0, np.int64 if k < 2 else float) for k, c in enumerate(_KNOWN)})

    def _announced(self, new: pd.DataFrame, own: int) -> list[tuple]:
        """(cell, place in ``new``): the other cells within reach of positions."""
        at = new[["x", "y", "z"]].to_numpy()
        low, high = (np.floor((at + d) / self.size) for d in (-self.reach, self.reach))
        out = []
        for i in np.flatnonzero((low != high).any(axis=1)):
            near = [[v - self.reach, v, v + self.reach] for v in at[i]]
            out += [(c, i) for c in {cell_of(a, b, c, self.size) for a in near[0] for b in near[1] for c in near[2]} - {own}]
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        cell = key[0]
        known = self._held()
        new = pd.concat(list(rows))
        told = new["kind"] == ANNOUNCEMENT
        before, out = len(known), []
        # an announcement that comes again changes nothing
        known = pd.concat([known, new.loc[told, _KNOWN]]).drop_duplicates(["x", "y", "z", "source"])
        for epoch, now in new[~told].sort_values(["epoch_id", "det_id"]).groupby("epoch_id", sort=True):
            listed = known[known["epoch_id"] < epoch].sort_values(["epoch_id", "source"])
            at = first_near(now[["x", "y", "z"]].to_numpy(), listed[["x", "y", "z"]].to_numpy(), self.reach)
            opens = at == len(listed)
            source = np.append(listed["source"].to_numpy(), 0)[at]
            now = now.assign(kind=DECISION, cell=cell, source=np.where(opens, now["det_id"], source))
            out.append(now)
            opened = now[opens].drop_duplicates(["x", "y", "z"])
            known = pd.concat([known, opened[_KNOWN]])
            if border := self._announced(opened, cell):
                cells, places = zip(*border, strict=True)
                out.append(opened.iloc[list(places)].assign(kind=ANNOUNCEMENT, cell=list(cells)))
        if len(known) > before:
            self.known.appendList([tuple(known[c].iloc[before:].tolist() for c in _KNOWN)])
        if out:
            yield pd.concat(out)[_COLUMNS]

    def close(self) -> None:
        pass


def positioned(det: DataFrame, radius: float) -> DataFrame:
    """Detections (det_id, epoch_id, ra, dec) as rows of the stream; those without a finite position are left out."""
    size = Sources(radius).size
    x = det.where("ra is not null and dec is not null and not isnan(ra) and not isnan(dec)")
    x = x.select(F.col("epoch_id").cast("long").alias("epoch_id"), "det_id", *[v.alias(n) for n, v in zip("xyz", unit_vector(F.col("ra"), F.col("dec")), strict=True)])
    a, b, c = (F.floor(F.col(n) / F.lit(size)) + (1 << (_BITS - 1)) for n in "xyz")
    cell = (a * (1 << 2 * _BITS) + b * (1 << _BITS) + c).cast("long")
    return x.select(F.lit(DETECTION).alias("kind"), cell.alias("cell"), "epoch_id", "det_id", F.col("det_id").alias("source"), "x", "y", "z")


def grow(spark: SparkSession, arrivals: str, top: str, radius: float, exposures_at_once: int = 1) -> StreamingQuery:
    """A stream that decides the detections of the Parquet files in ``arrivals`` (det_id, epoch_id, ra, dec; one exposure each, in
    the order of their arrival) into ``top``/decided (epoch_id, det_id, source); ``top`` also has its checkpoint and announcements.

    A detection belongs to the source first opened, by exposure and key, of those within ``radius`` arcsec that earlier
    exposures opened, else it opens one, named by its key. A trigger takes one exposure, as announcements have to arrive
    before the next. Defined cases: detections without a position have no row; an exposure without detections changes
    nothing; a batch that runs again after a failure overwrites its own output. Needs the RocksDB state store.

    Scale: rows are shuffled by cell; a cell holds the sources of WIDTH radii of the sky, so no key is hot beyond what the
    sky has there, and the state grows with the positions of sources, not with the detections or their copies.
    """
    announced = f"{top}/announced"
    spark.createDataFrame([], ROWS).write.mode("append").parquet(f"{announced}/batch=-1")
    det = spark.readStream.schema("det_id long, epoch_id long, ra double, dec double").option("maxFilesPerTrigger", exposures_at_once).parquet(arrivals)
    told = spark.readStream.schema(ROWS).option("recursiveFileLookup", "true").parquet(announced)
    rows = positioned(det, radius).unionByName(told)
    decided = rows.groupBy("cell").transformWithStateInPandas(Sources(radius), ROWS, "Append", "None")

    def out(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        batch.where(F.col("kind") == DECISION).select("epoch_id", "det_id", "source").write.mode("overwrite").parquet(f"{top}/decided/batch={number}")
        border = batch.where(F.col("kind") == ANNOUNCEMENT)
        if border.limit(1).count():
            border.write.mode("overwrite").parquet(f"{announced}/batch={number}")
        batch.unpersist()

    with rocksdb(spark):
        return decided.writeStream.outputMode("append").foreachBatch(out).option("checkpointLocation", f"{top}/checkpoint").start()


def decisions(spark: SparkSession, top: str) -> DataFrame:
    return spark.read.option("basePath", f"{top}/decided").parquet(f"{top}/decided").select("epoch_id", "det_id", "source")

"""Catalogues kept by cell: written once in buckets of their cells, so that repeated matches shuffle the detections only."""

from __future__ import annotations

import hashlib
import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.geometry import unit_vector

def _axes(on: tuple[str, str], sky: bool) -> tuple[Column, ...]:
    return unit_vector(F.col(on[0]), F.col(on[1])) if sky else (F.col(on[0]).cast("double"), F.col(on[1]).cast("double"))


def _valid(on: tuple[str, str]) -> Column:
    """Positions that are finite numbers; others lie in no cell."""
    return (F.abs(on[0]) < float("inf")) & (F.abs(on[1]) < float("inf")) & ~F.isnan(on[0]) & ~F.isnan(on[1])


def _key(level: Column, cells: list[Column]) -> Column:
    return F.xxhash64(level, *cells)


class CellCatalog:
    """A catalogue under ``path``, one row a star, in buckets of ``cell``; what it was made with is in ``path``.made.

    A cell is a level and a place. Level 0 is ``size`` wide, each further one half of the one before; where more than
    ``most`` stars share a cell, they lie in cells of the next level, so that a crowded field is many keys and not one. The
    finest level should be no narrower than the radii asked for, as a row is sent to each cell that its circle touches.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.made = json.loads(spark.read.text(f"{self.path}.made").first()[0])
        self.name = "cells_" + hashlib.md5(self.path.encode()).hexdigest()
        if not spark.catalog.tableExists(self.name):  # another session wrote it
            buckets = f"CLUSTERED BY (cell) SORTED BY (cell) INTO {self.made['buckets']} BUCKETS"
            spark.sql(f"CREATE TABLE {self.name} ({self.made['columns']}) USING parquet {buckets} LOCATION '{self.path}'")

    @classmethod
    def save(cls, stars: DataFrame, path: str, size: float, system: str = "sky", on: tuple[str, str] = ("ra", "dec"), levels: int = 4, most: int = 1000, buckets: int = 64) -> CellCatalog:
        """Writes ``stars`` under ``path``, over what was there. ``size``: the widest cell, in arcsec on the sky, else pixels.

        Stars without a finite position are kept in no cell and so match nothing; an empty table is an empty catalogue.
        The columns ``cell``, ``_s0`` ... are its own. Counts are made for the finest cells, and what a wider cell holds
        is summed over at most 8 ** (levels - 1) of these.
        """
        if system not in ("pixel", "sky"):
            raise ValueError(f"system {system!r}")
        sky = system == "sky"
        n = 3 if sky else 2
        width = 2 * math.sin(math.radians(min(size, 180 * 3600.0) / 3600) / 2) if sky else float(size)
        names = [f"_c{k}" for k in range(n)]
        placed = stars.where(_valid(on)).withColumns({f"_s{k}": v for k, v in enumerate(_axes(on, sky))})
        placed = placed.withColumns({c: F.floor(F.col(f"_s{k}") / (width / 2 ** (levels - 1))) for k, c in enumerate(names)})
        fine = placed.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
        level = F.lit(levels - 1)
        for v in reversed(range(levels - 1)):
            wide = Window.partitionBy(*[F.shiftright(c, levels - 1 - v) for c in names])
            fine = fine.withColumn(f"_n{v}", F.sum("_n").over(wide))
            level = F.when(F.col(f"_n{v}") <= most, v).otherwise(level)
        fine = fine.select(*names, level.alias("_level"))
        cell = _key(F.col("_level"), [F.expr(f"shiftright({c}, {levels - 1} - _level)") for c in names])
        made = {"system": system, "on": list(on), "width": width, "levels": levels, "buckets": buckets}
        out = placed.join(fine, names).withColumn("cell", cell).drop(*names, "_level")
        made["columns"] = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
        name = "cells_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()
        # One file a bucket: rows are dealt as buckets are, so that a task holds whole buckets.
        out.repartition(buckets, "cell").write.mode("overwrite").option("path", path.rstrip("/")).bucketBy(buckets, "cell").sortBy("cell").saveAsTable(name)
        stars.sparkSession.createDataFrame([(json.dumps(made),)], "made string").coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}.made")
        return cls(stars.sparkSession, path)

    def stars(self) -> DataFrame:
        """All of the catalogue, with its own columns."""
        return self.spark.table(self.name)

    def match(self, rows: DataFrame, radius: float, on: tuple[str, str] | None = None, strict: bool = False) -> DataFrame:
        """Pairs of ``rows`` and stars within ``radius`` (arcsec or pixels) with ``dist``: what ``spatial.radius_join`` gives.

        Each row goes to the cells that its circle touches at each level, eight a level on the sky where cells are
        wide; the catalogue is read in its buckets and not exchanged. Column names must differ between the two.
        """
        sky = self.made["system"] == "sky"
        on = on or (("ra", "dec") if sky else ("x", "y"))
        n, levels = (3 if sky else 2), self.made["levels"]
        reach = (2 * math.sin(math.radians(min(radius, 180 * 3600.0) / 3600) / 2) if sky else radius) * (1 + 1e-9) + 1e-15
        x = rows.where(_valid(on)).withColumns({f"_r{k}": v for k, v in enumerate(_axes(on, sky))})

        def touched(level: int, have: tuple[Column, ...] = ()) -> Column:
            if len(have) == n:
                return F.array(_key(F.lit(level), list(have)))
            at, wide = F.col(f"_r{len(have)}"), self.made["width"] / 2**level
            along = F.sequence(F.floor((at - reach) / wide), F.floor((at + reach) / wide))
            return F.flatten(F.transform(along, lambda c: touched(level, (*have, c))))

        cells = F.array_distinct(F.concat(*[touched(v) for v in range(levels)]))
        pairs = x.withColumn("cell", F.explode(cells)).join(self.stars(), "cell")
        square = sum(((F.col(f"_r{k}") - F.col(f"_s{k}")) * (F.col(f"_r{k}") - F.col(f"_s{k}")) for k in range(n)), F.lit(0.0))
        dist = F.degrees(2 * F.asin(F.least(F.lit(1.0), F.sqrt(square) / 2))) * 3600 if sky else F.sqrt(square)
        pairs = pairs.withColumn("dist", dist).where(F.col("dist") < radius if strict else F.col("dist") <= radius)
        return pairs.drop("cell", *[f"_{s}{k}" for s in "rs" for k in range(n)])

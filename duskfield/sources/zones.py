"""A data source for catalogues that have landed as files by sky zone: ranges of position pick the zones that are read."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector, FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from ..operators.spatial import field_ranges

NAME = "skyzones"
#: Rows of one batch that a task hands over.
BATCH = 65536
_ZONE = re.compile(r"/dec_zone=([^/]+)/ra_zone=([^/]+)/")


def land(stars: DataFrame, path: str, zone: float = 5.0, on: tuple[str, str] = ("ra", "dec")) -> None:
    """Writes a catalogue under ``path``, a folder for each zone of ``zone`` degrees. Stars without a finite position have a
    folder of their own, which every reading reads."""
    finite = lambda c: F.when((F.abs(c) < float("inf")) & ~F.isnan(c), F.floor(F.col(c) / zone))
    x = stars.withColumns({"dec_zone": finite(on[1]), "ra_zone": finite(on[0])})
    # Few files a zone, and more where a zone is crowded.
    x.hint("rebalance", "dec_zone", "ra_zone").write.mode("overwrite").partitionBy("dec_zone", "ra_zone").parquet(path)


class ZoneFile(InputPartition):
    """One file of one zone."""

    def __init__(self, path: str):
        self.path = path


class ZoneReader(DataSourceReader):
    """Files of the zones that the pushed ranges of position leave; ranges also drop rows, and row groups by their statistics.

    Filters stay with Spark too: what is pushed only makes less to read. A NaN is above everything in Spark, so that a
    lower bound keeps it.
    """

    def __init__(self, path: str, zone: float, on: tuple[str, str]):
        self.path, self.zone, self.on = path, zone, on
        self.ranges = {c: [-math.inf, math.inf] for c in on}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and len(f.attribute) == 1 else None
            if column in self.ranges and isinstance(f.value, (int, float)) and not math.isnan(f.value):
                held = self.ranges[column]
                if not isinstance(f, (LessThan, LessThanOrEqual)):
                    held[0] = max(held[0], float(f.value))
                if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    held[1] = min(held[1], float(f.value))
            yield f

    def _reached(self, path: str) -> bool:
        got = _ZONE.search(path)
        if not got or not all(v.lstrip("-").isdigit() for v in got.groups()):
            return True  # no finite position
        for column, v in zip(reversed(self.on), map(int, got.groups()), strict=True):
            low, high = self.ranges[column]
            if (v + 1) * self.zone < low or v * self.zone > high:
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        fs, top = FileSystem.from_uri(self.path)
        found = fs.get_file_info(FileSelector(top, recursive=True))
        files = [f.path for f in found if f.is_file and f.path.endswith(".parquet") and f.size]
        return [ZoneFile(p) for p in sorted(files) if self._reached(p)] or [ZoneFile("")]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not partition.path:  # no zone is left
            return
        fs, _ = FileSystem.from_uri(self.path)
        keep = None
        for column, (low, high) in self.ranges.items():
            at = pc.field(column)
            for bound, ok in ((low, (at >= low) | pc.is_nan(at)), (high, at <= high)):
                if not math.isinf(bound):
                    keep = ok if keep is None else keep & ok
        yield from pads.dataset(partition.path, format="parquet", filesystem=fs, partitioning=None).to_batches(filter=keep, batch_size=BATCH)


class SkyZones(DataSource):
    """``format("skyzones")`` with the options ``path`` (a URI), ``zone``, ``ra`` and ``dec`` as they were landed with."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        fs, top = FileSystem.from_uri(self.options["path"])
        first = next((f.path for f in fs.get_file_info(FileSelector(top, recursive=True)) if f.is_file and f.path.endswith(".parquet") and f.size), None)
        if first is None:
            raise ValueError(f"no catalogue under {self.options['path']}")
        return from_arrow_schema(pq.read_schema(first, filesystem=fs))

    def reader(self, schema: StructType) -> ZoneReader:
        o = self.options
        return ZoneReader(o["path"], float(o.get("zone", 5.0)), (o.get("ra", "ra"), o.get("dec", "dec")))


def zoned(spark: SparkSession, path: str, zone: float = 5.0, on: tuple[str, str] = ("ra", "dec")) -> DataFrame:
    """The landed catalogue; comparisons of its positions with numbers pick zones."""
    spark.dataSource.register(SkyZones)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(NAME).options(path=path, zone=str(zone), ra=on[0], dec=on[1]).load()


def zoned_region(spark: SparkSession, path: str, ra: float, dec: float, width: float, height: float, zone: float = 5.0, on: tuple[str, str] = ("ra", "dec")) -> DataFrame:
    """The rows of a field: ``spatial.region`` over the landed catalogue, as one read for each range of right ascension, since
    alternatives aren't pushed."""
    ranges, (bottom, top) = field_ranges(ra, dec, width, height)
    out = None
    for low, high in ranges:
        x = zoned(spark, path, zone, on).where((F.col(on[0]) >= low) & (F.col(on[0]) <= high) & (F.col(on[1]) >= bottom) & (F.col(on[1]) <= top))
        out = x if out is None else out.unionByName(x)
    return out

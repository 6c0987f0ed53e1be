"""Reference catalogues as tables: a registry of their columns, and the region that an exposure needs."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import photometry as phot
from ..functions.geometry import tan_pixel
from ..operators.spatial import radius_join, region


@dataclass(frozen=True)
class Catalog:
    """Where a catalogue's columns are. ``mags``: our name -> magnitude column; ``fluxes``: our name -> (flux, inverse
    variance) in nanomaggies; ``motions``: proper motion columns in mas a year; ``where``: what a usable row fulfils."""

    ra: str
    dec: str
    mags: dict[str, str] = field(default_factory=dict)
    fluxes: dict[str, tuple[str, str]] = field(default_factory=dict)
    motions: tuple[str, str] | None = None
    limit_band: str | None = None
    where: str | None = None


# The columns that the public catalogues have.
KNOWN: dict[str, Catalog] = {
    "gaia": Catalog("ra", "dec", {"G": "phot_g_mean_mag", "BP": "phot_bp_mean_mag", "RP": "phot_rp_mean_mag"}, motions=("pmra", "pmdec"), limit_band="G"),
    "legacysurvey": Catalog("ra", "dec", fluxes={f"Sloan_{b}": (f"flux_{b}", f"flux_ivar_{b}") for b in "grz"}, limit_band="Sloan_r", where="nobs_r > 0"),
    "panstarrs": Catalog("raMean", "decMean", {f"Sloan_{b}": f"{b}MeanPSFMag" for b in "griz"}, limit_band="Sloan_r"),
    "usno": Catalog("RAJ2000", "DEJ2000", {"B2": "B2mag", "R2": "R2mag", "I": "Imag"}, limit_band="R2"),
    "atlas": Catalog("radeg", "decdeg", {f"Sloan_{b}": f"Sloan_{b}" for b in "griz"} | {"J": "J"}, motions=("pmra", "pmdec"), limit_band="Sloan_r"),
}


def catalog(name: str) -> Catalog:
    """By the part before an @, which names a place to get it from."""
    key = name.split("@")[0].lower()
    if key not in KNOWN:
        raise ValueError(f"catalogue {name!r}; known: {', '.join(sorted(KNOWN))}")
    return KNOWN[key]


def reference_stars(table: DataFrame, spec: Catalog, ra: float, dec: float, width: float, height: float, limit: float) -> DataFrame:
    """radeg, decdeg, pmra, pmdec and a magnitude and error per band of the stars of a field (degrees) down to ``limit``.

    Position, flux and magnitude limits are plain comparisons of stored columns, which a Parquet scan prunes by. Errors are
    null where there is no inverse variance; motions are 0 where the catalogue has none.
    """
    x = region(table, ra, dec, width, height, (spec.ra, spec.dec))
    if spec.where:
        x = x.where(spec.where)
    if spec.limit_band in spec.fluxes:
        x = x.where(F.col(spec.fluxes[spec.limit_band][0]) > 10 ** ((22.5 - limit) / 2.5))
    elif spec.limit_band:
        x = x.where(F.col(spec.mags[spec.limit_band]) < limit)
    motion = [F.col(c) if spec.motions else F.lit(0.0) for c in spec.motions or ("", "")]
    cols = [F.col(spec.ra).alias("radeg"), F.col(spec.dec).alias("decdeg"), motion[0].alias("pmra"), motion[1].alias("pmdec")]
    for name, c in spec.mags.items():
        cols.append(F.col(c).alias(name))
    for name, (flux, ivar) in spec.fluxes.items():
        cols += [phot.nanomaggy_mag(F.col(flux)).alias(name), phot.ivar_error(F.col(flux), F.col(ivar)).alias(f"{name}_err")]
    return x.select(*cols)


#: Pointings that snap to one point of a grid of so many degrees share a stored region, which is that much wider.
GRID = 1.0


def region_key(name: str, ra: float, dec: float, width: float, height: float, limit: float) -> str:
    """The stored region that serves a field."""
    snapped = [round(round(v / GRID) * GRID, 4) for v in (ra, dec)]
    text = "|".join([name, *(f"{v:.4f}" for v in snapped), *(f"{v + GRID:.1f}" for v in (width, height)), f"{limit:.1f}"])
    return hashlib.md5(text.encode()).hexdigest()


class CatalogStore:
    """Regions of catalogues under ``path``, fetched when there is none younger than ``days``, and kept for a run.

    ``fetch`` gets a name and a region (ra, dec, width, height, limit) and gives a table; it may read a table that has
    landed or a data source. A stored region is ``GRID`` wider than the field, so that all fields of its key lie within.
    """

    def __init__(self, spark: SparkSession, path: str, fetch: Callable[..., DataFrame], days: float = 30.0):
        self.spark, self.path, self.fetch, self.days = spark, path.rstrip("/"), fetch, days
        self.held: dict[str, DataFrame] = {}

    def _fresh(self, at: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(p) and time.time() - fs.getFileStatus(p).getModificationTime() / 1000 < self.days * 86400

    def get(self, name: str, ra: float, dec: float, width: float, height: float, limit: float) -> DataFrame:
        key = region_key(name, ra, dec, width, height, limit)
        if key not in self.held:
            at = f"{self.path}/{name}/{key}"
            if not self._fresh(at):
                centre = [round(v / GRID) * GRID for v in (ra, dec)]
                self.fetch(name, *centre, width + GRID, height + GRID, limit).write.mode("overwrite").parquet(at)
            self.held[key] = self.spark.read.parquet(at)
        return self.held[key]


def frame_stars(stars: DataFrame, exposures: DataFrame, margin: float = 20.0) -> DataFrame:
    """(epoch_id, star_id if there is one, sx, sy, star_mag): the catalogue as each exposure sees it.

    ``stars``: radeg, decdeg and bands as of ``reference_stars``. ``exposures``: epoch_id, ra0, dec0, scale (arcsec per
    pixel), px0, py0, width, height, response. A star is placed by a gnomonic projection and kept within ``margin`` pixels
    of the frame; its magnitude is the red one in the exposure's own system (``response_model`` of its filled colours),
    null where fewer than two bands are known, and without a response the red one itself. Exposures without a position or
    a size see nothing.

    Stars meet exposures by sky cells as wide as the widest frame's reach, one number that comes to the driver; the
    result is as large as the sum of all exposures' stars.
    """
    ids = ["star_id"] if "star_id" in stars.columns else []
    x = phot.with_colours(stars).select(*ids, "radeg", "decdeg", "base_mag", *[f"c{k}" for k in range(1, 5)])
    e = exposures.select("epoch_id", "ra0", "dec0", "scale", "px0", "py0", "width", "height", "response").where("ra0 is not null and dec0 is not null and width > 0 and height > 0")
    far = lambda at, size: F.greatest(F.abs(F.col(at)), F.abs(F.col(size) - F.col(at))) + margin
    reach = e.agg(F.max(F.hypot(far("px0", "width"), far("py0", "height")) * F.abs("scale"))).first()[0] or 0.0
    x = radius_join(x, e, reach * (1 + 1e-9), "sky", left_on=("radeg", "decdeg"), right_on=("ra0", "dec0"))
    sx, sy = tan_pixel(F.col("radeg"), F.col("decdeg"), F.col("ra0"), F.col("dec0"), F.col("scale"), F.col("px0"), F.col("py0"))
    mag = F.col("base_mag") + phot.response_model(phot.response_terms(F.col("response")), [F.col(f"c{k}") for k in range(1, 5)])
    x = x.withColumns({"sx": sx, "sy": sy}).where(F.col("sx").between(-margin, F.col("width") + margin) & F.col("sy").between(-margin, F.col("height") + margin))
    return x.select("epoch_id", *ids, "sx", "sy", mag.alias("star_mag"))

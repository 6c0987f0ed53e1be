"""Angles, projections and times as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MJD_UNIX_EPOCH = 40587.0
MJD_JD = 2400000.5
DEFAULT_SCALE = 0.33  # arcsec per pixel where nothing says otherwise


def unit_vector(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    a, d = F.radians(ra), F.radians(dec)
    return F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)


def separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle separation in degrees, by haversine."""
    h = F.pow(F.sin(F.radians(dec2 - dec1) / 2), 2) + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * F.pow(F.sin(F.radians(ra2 - ra1) / 2), 2)
    return F.degrees(2 * F.asin(F.least(F.lit(1.0), F.sqrt(h))))


def flat_separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Small-field separation in degrees: cos(dec) scales the first axis and 0/360 isn't wrapped."""
    return F.sqrt(F.pow((ra1 - ra2) * F.cos(F.radians(dec2)), 2) + F.pow(dec1 - dec2, 2))


def tan_pixel(ra: Column, dec: Column, ra0: float, dec0: float, scale: float, px0: float, py0: float) -> tuple[Column, Column]:
    """Gnomonic projection to pixels, 1-indexed; ``scale`` in arcsec per pixel, the first axis runs against right ascension."""
    a, d, d0 = F.radians(ra - F.lit(ra0)), F.radians(dec), F.radians(F.lit(dec0))
    w = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(a)
    xi = F.cos(d) * F.sin(a) / w
    eta = (F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(a)) / w
    step = scale / 3600
    return F.lit(px0) - F.degrees(xi) / step, F.lit(py0) + F.degrees(eta) / step


def tan_sky(x: Column, y: Column, ra0: float, dec0: float, scale: float, px0: float, py0: float) -> tuple[Column, Column]:
    """The inverse of ``tan_pixel``."""
    step = scale / 3600
    xi, eta, d0 = F.radians((F.lit(px0) - x) * step), F.radians((y - F.lit(py0)) * step), F.radians(F.lit(dec0))
    down = F.cos(d0) - eta * F.sin(d0)
    ra = F.lit(ra0) + F.degrees(F.atan2(xi, down))
    dec = F.degrees(F.atan2(F.sin(d0) + eta * F.cos(d0), F.sqrt(xi * xi + down * down)))
    return F.pmod(ra, F.lit(360.0)), dec


def plate_scale(cd11: Column, cd22: Column, cdelt: Column) -> Column:
    """Arcsec per pixel from the CD matrix, else CDELT1, else the default."""
    by_cd = F.when((F.abs(cd11 * cd22) > 0), 3600 * F.sqrt(F.abs(cd11 * cd22)))
    return F.coalesce(by_cd, F.when(cdelt != 0, 3600 * F.abs(cdelt)), F.lit(DEFAULT_SCALE))


def mjd(unix: Column) -> Column:
    return unix / 86400 + MJD_UNIX_EPOCH


def julian_date(jd: Column, mjd_obs: Column) -> Column:
    """A header's Julian date: JD if it has one, else from MJD-OBS, else null."""
    return F.coalesce(jd, mjd_obs + MJD_JD)


def exposure_middle(start: Column, exposure: Column) -> Column:
    """The middle of an exposure in seconds; an unknown length is none."""
    return start + F.coalesce(exposure, F.lit(0.0)) / 2


def moved(ra: Column, dec: Column, pmra_mas: Column, pmdec_mas: Column, years: Column | float) -> tuple[Column, Column]:
    """Position after ``years`` of proper motion; an unknown motion is none."""
    a, d = F.coalesce(F.nanvl(pmra_mas, F.lit(0.0)), F.lit(0.0)), F.coalesce(F.nanvl(pmdec_mas, F.lit(0.0)), F.lit(0.0))
    return ra + a / 3.6e6 / F.cos(F.radians(dec)) * years, dec + d / 3.6e6 * years


def clip(v: Column, low: float, high: float) -> Column:
    """Bounded value; NaN stays NaN and null stays null."""
    return F.when(F.isnan(v), v).when(v.isNotNull(), F.least(F.greatest(v, F.lit(float(low))), F.lit(float(high))))

"""Magnitudes, colours and the response mini-language."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Typical colours between neighbouring bands, the colour transformation of the Sloan bands and its range,
# systematic floors by catalogue name, and the floor of a detection.
TYPICAL_COLOURS = [0.6, 0.3, 0.2, 0.8]
SLOAN_G = [0.1942, 1.0448, 0.0635]
SLOAN_R = [-0.1313, -0.2085]
COLOUR_RANGE = (-0.5, 3.5)
SYSTEMATICS = [("gaia", 0.01), ("panstarrs", 0.02), ("legacysurvey", 0.02), ("atlas", 0.03), ("usno", 0.10)]
OTHER_SYSTEMATIC = 0.02
DETECTION_FLOOR = 0.01


def nanomaggy_mag(flux: Column) -> Column:
    """22.5 - 2.5 log10(flux); null unless the flux is positive."""
    return F.when(flux > 0, 22.5 - 2.5 * F.log10(flux))


def ivar_error(flux: Column, ivar: Column) -> Column:
    return F.when((flux > 0) & (ivar > 0), 2.5 / (F.log(F.lit(10.0)) * flux * F.sqrt(ivar)))


def flux_mag(flux: Column, flux_error: Column, zero: Column | float, zero_error: Column | float = 0.0) -> tuple[Column, Column]:
    """Calibrated magnitude, and its error with the zero point's in quadrature."""
    own = 1.0857 * flux_error / flux
    return F.when(flux > 0, F.lit(zero) - 2.5 * F.log10(flux)), F.when(flux > 0, F.sqrt(own * own + F.lit(zero_error) * F.lit(zero_error)))


def _polynomial(x: Column, terms: list[float]) -> Column:
    out = F.lit(terms[-1])
    for v in reversed(terms[:-1]):
        out = out * x + F.lit(v)
    return out


def sloan_from_gaia(g: Column, bp: Column, rp: Column) -> dict[str, Column]:
    """Sloan g and r from broad-band magnitudes, null outside the colour range."""
    x = bp - rp
    ok = (x > COLOUR_RANGE[0]) & (x < COLOUR_RANGE[1])
    return {f"sloan_{b}": F.when(ok, g + _polynomial(x, t)) for b, t in (("g", SLOAN_G), ("r", SLOAN_R))}


def known(m: Column) -> Column:
    """A magnitude, or null where it is NaN, infinite or a filler of 99 and more."""
    return F.when(m.isNotNull() & ~F.isnan(m) & (F.abs(m) < 99), m)


def fill_bands(mags: list[Column]) -> list[Column]:
    """Missing magnitudes of neighbouring bands from typical colours: onwards, then backwards; nulls throughout where
    fewer than two bands are known."""
    m = [known(v) for v in mags]
    enough = sum((F.when(v.isNotNull(), 1).otherwise(0) for v in m), F.lit(0)) >= 2
    for i in range(len(m) - 1):
        m[i + 1] = F.coalesce(m[i + 1], m[i] + TYPICAL_COLOURS[i])
    for i in range(len(m) - 2, -1, -1):
        m[i] = F.coalesce(m[i], m[i + 1] - TYPICAL_COLOURS[i])
    return [F.when(enough, v) for v in m]


def systematic_error(catalog: Column) -> Column:
    """The floor of the first name that the catalogue's name contains."""
    out = F.lit(OTHER_SYSTEMATIC)
    for name, v in reversed(SYSTEMATICS):
        out = F.when(F.lower(catalog).contains(name), F.lit(v)).otherwise(out)
    return out


def response_terms(response: Column) -> Column:
    """``Z=25.0,PX=0.1`` as a map to doubles; what is no number is null."""
    pairs = F.str_to_map(response, F.lit(","), F.lit("="))
    return F.map_from_entries(F.transform(F.map_entries(pairs), lambda e: F.struct(F.trim(e["key"]).alias("key"), e["value"].try_cast("double").alias("value"))))


def _colour_product(name: Column, colours: dict[str, Column]) -> Column:
    """The product that a P term's name stands for at the frame's centre and airmass 1: a digit is the power of the letter
    after it, and letters without a meaning are skipped."""
    at = {"A": 1.0, "R": 0.0, "X": 0.0, "Y": 0.0, "N": NEUTRAL_LEVEL}
    steps = F.regexp_extract_all(F.regexp_replace(F.substr(name, F.lit(2)), "[^0-9ACDEFNRXY]", ""), F.lit("[0-9]?[A-Z]"), F.lit(0))

    def power(v: Column) -> Column:
        letter, base = F.right(v, F.lit(1)), F.lit(1.0)
        for k, c in (at | colours).items():
            base = F.when(letter == k, c).otherwise(base)
        return F.pow(base, F.when(F.length(v) > 1, F.left(v, F.lit(1)).try_cast("double")).otherwise(1.0))

    return F.aggregate(steps, F.lit(1.0), lambda acc, v: acc * power(v))


def response_model(terms: Column, colours: list[Column]) -> Column:
    """What a response adds for a star's four colours against none, at the frame's centre: what makes its magnitude one of the
    exposure's own system. ``terms``: a map as of ``response_terms``; the zero point, whatever holds no colour, terms of other
    images than the first and values that are no numbers add nothing. Null colours give null, no terms 0.

    The names are those of ``fitted_model``, here as data, so that each exposure has its own.
    """
    c1, c2, c3, _ = colours
    actual, none = dict(zip("CDEF", colours, strict=True)), dict.fromkeys("CDEF", F.lit(0.0))
    lean = lambda v: v * c1
    far = lambda v: (v - 1) * c3 + c2

    def part(e: Column) -> Column:
        name, v = F.regexp_replace(e["key"], ":1$", ""), e["value"]
        rise = (1 + F.sin(v * math.pi)) / 2
        sharp = F.when(v < 0, lean(v)).when(v <= 1, v * c2).otherwise(far(v))
        inner = F.when(v < 0.5, v * ((1 - rise) * c1 + rise * c2)).otherwise(c2 + (v - 1) * (rise * c2 + (1 - rise) * c3))
        smooth = F.when(v < -0.5, lean(v)).when(v <= 1.5, inner).otherwise(far(v))
        powers = v * (_colour_product(name, actual) - _colour_product(name, none))
        return F.when(name == "XC", sharp).when(name == "SC", smooth).when(name.startswith("P"), powers).otherwise(0.0)

    used = F.filter(F.map_entries(terms), lambda e: e["value"].isNotNull() & ~e["key"].rlike(":(?!1$)[0-9]+$"))
    known_all = c1.isNotNull() & c2.isNotNull() & c3.isNotNull() & colours[3].isNotNull()
    return F.when(known_all, F.coalesce(F.aggregate(used, F.lit(0.0), lambda acc, e: acc + part(e)), F.lit(0.0)))


#: Bands that colours are made of, in order, and the one that detections are compared in.
COLOUR_BANDS, COMPARED = ("Sloan_g", "Sloan_r", "Sloan_i", "Sloan_z", "J"), 1


def with_colours(stars: DataFrame) -> DataFrame:
    """Catalogue rows with ``base_mag`` (red) and ``c1`` to ``c4`` (neighbouring bands' differences), all null where fewer than
    two of COLOUR_BANDS are known. Broad-band G, BP and RP give the Sloan g and r that a catalogue lacks."""
    if {"G", "BP", "RP"} <= set(stars.columns):
        made = sloan_from_gaia(F.col("G"), F.col("BP"), F.col("RP"))
        stars = stars.withColumns({b: made[b.lower()] for b in COLOUR_BANDS[:2] if b not in stars.columns})
    bands = fill_bands([F.col(b).cast("double") if b in stars.columns else F.lit(None).cast("double") for b in COLOUR_BANDS])
    return stars.withColumns({"base_mag": bands[COMPARED]} | {f"c{k + 1}": bands[k] - bands[k + 1] for k in range(4)})


# Fixed values of the fitted model: the counts that magnitudes are relative to, what is added to counts before their
# logarithm, the zero point's shift, and the scales of the radial terms.
MODEL_COUNTS, MODEL_OFFSET, MODEL_ZERO, GAUSS_SCALE = 10000.0, 0.01, 10.0, 25.0
#: The relative magnitude of one count, where colours are compared.
NEUTRAL_LEVEL = -2.5 * math.log10((1 + MODEL_OFFSET) / MODEL_COUNTS)


def relative_magnitude(mag: Column) -> Column:
    """An instrumental magnitude relative to the model's reference counts."""
    return -2.5 * F.log10((F.pow(F.lit(10.0), -0.4 * mag) + MODEL_OFFSET) / MODEL_COUNTS)


def _blend(value: float, c1: Column, c2: Column, c3: Column, smooth: bool) -> Column:
    """The colour term that runs through three colours as its parameter grows, with or without smooth seams."""
    low, high = (-0.5, 1.5) if smooth else (0.0, 1.0)
    if value < low:
        return value * c1
    if value > high:
        return c2 + (value - 1) * c3
    if not smooth:
        return value * c2
    rise = (1 + math.sin(value * math.pi)) / 2
    if value < 0.5:
        return value * ((1 - rise) * c1 + rise * c2)
    return c2 + (value - 1) * (rise * c2 + (1 - rise) * c3)


def _product(name: str, factors: dict[str, Column]) -> Column:
    """``P2XY``: x squared times y. A digit is the power of the letter after it; letters without a meaning are 1."""
    out = F.lit(1.0)
    for power, letter in re.findall(r"(\d?)([A-Z])", name[1:]):
        if letter in factors:
            out = out * F.pow(factors[letter], F.lit(float(power or 1)))
    return out


def fitted_model(terms: dict[str, float], mag: Column, airmass: Column, x: Column, y: Column, colours: list[Column], cat_x: Column, cat_y: Column, image: Column) -> Column:
    """Magnitude by a fitted response: the sum of its terms over the columns. ``image`` counts from 0; a term that ends in
    ``:n`` holds for the n-th image only. ``colours``: four of them.

    Z: zero point. P...: products of powers of airmass (A), colours (C to F), place (X, Y, R for the squared radius) and
    relative magnitude (N). SX, SY, SXY: sines of the place within a pixel. XC, SC: a blend of three colours. GA with GW
    (a Gaussian of the radius) and EA with EW (an exponential of it) come in pairs. RS, RO, RC: a rational function of
    the relative magnitude.
    """
    rel, radius = relative_magnitude(mag), x * x + y * y
    factors = {"A": airmass, "R": radius, "X": x, "Y": y, "N": rel} | dict(zip("CDEF", colours, strict=True))
    wave = lambda v: F.sin(F.pi() * (v - F.floor(v)))
    sines = {"SX": wave(cat_x), "SY": wave(cat_y), "SXY": wave(cat_x) * wave(cat_y)}
    out, whole = rel, {}
    for term, value in terms.items():
        name, _, number = term.partition(":")
        if name == "Z":
            part = F.lit(value - MODEL_ZERO)
        elif name in sines:
            part = value * sines[name]
        elif name in ("XC", "SC"):
            part = _blend(value, *colours[:3], smooth=name == "SC")
        elif name.startswith("P"):
            part = value * _product(name, factors)
        else:  # parameters of what follows hold for all images
            whole[name] = value
            continue
        out = out + (F.when(image == int(number) - 1, part).otherwise(0.0) if number else part)
    if {"GA", "GW"} <= whole.keys():
        out = out + whole["GA"] * F.exp(-GAUSS_SCALE * radius * F.pow(F.lit(10.0), -F.lit(whole["GW"])))
    if {"EA", "EW"} <= whole.keys():
        z = F.sqrt(F.try_divide(radius, F.lit(whole["EW"])))
        out = out + whole["EA"] * (F.exp(z) / (z + 1) - 1)
    if whole.keys() & {"RS", "RO", "RC"}:
        z = -rel - whole.get("RO", 0.0)
        out = out + whole.get("RS", 0.0) * z / (1 + whole.get("RC", 0.0) * z * z + 1e-10)
    return out


def flat_mesh(frames: DataFrame, key: str, terms: dict[str, float], step: int, unit: float) -> DataFrame:
    """(key, px, py, flat): what the terms of place add on a mesh of each frame's pixels, without zero point, colours and magnitude.

    ``frames``: key, width, height in pixels. Coordinates of the model are pixels from a frame's centre in units of ``unit``.
    """
    along = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c).cast("long") - 1, F.lit(step).cast("long")))
    mesh = frames.where("width > 0 and height > 0").select(key, "width", "height", along("width").alias("px")).withColumn("py", along("height"))
    centre = (F.col("width") / 2, F.col("height") / 2)
    x, y, none = (F.col("px") - centre[0]) / unit, (F.col("py") - centre[1]) / unit, F.lit(0.0)
    place = {k: v for k, v in terms.items() if re.match(r"^(P[\dXYR]+|GA|GW|EA|EW|S[XY]{1,2})(:\d+)?$", k)}
    return mesh.select(key, "px", "py", (fitted_model(place, none, none, x, y, [none] * 4, F.col("px").cast("double"), F.col("py").cast("double"), F.lit(0)) - NEUTRAL_LEVEL).alias("flat"))


def calibrated(mag_calib: Column, err_calib: Column, mag_auto: Column, err_auto: Column, zero: Column) -> tuple[Column, Column]:
    """A difference image's magnitude and error: its own where it has them, else the instrumental ones with the zero point."""
    return F.coalesce(mag_calib, mag_auto + zero), F.when(mag_calib.isNotNull(), err_calib).otherwise(F.when((mag_auto + zero).isNotNull(), err_auto))


def zero_point(matched: DataFrame, group: str, clip: float = 3.0) -> DataFrame:
    """(group, n_good, zero_point, zero_error) from matched stars (star_mag, mag): the median difference, stars within
    ``clip`` robust deviations of it are good, and the error is their deviation over the root of their number less one
    (null for fewer than two)."""
    x = matched.withColumn("_z", F.col("star_mag") - F.col("mag")).where("_z is not null and not isnan(_z)")
    mid = x.groupBy(group).agg(F.percentile("_z", F.lit(0.5)).alias("_m"))
    x = x.join(mid, group)
    mad = x.groupBy(group).agg((F.percentile(F.abs(F.col("_z") - F.col("_m")), F.lit(0.5)) / 0.67).alias("_s"))
    good = x.join(mad, group).where(F.abs(F.col("_z") - F.col("_m")) <= clip * F.col("_s"))
    n = F.count(F.lit(1))
    return good.groupBy(group).agg(n.alias("n_good"), F.percentile("_z", F.lit(0.5)).alias("zero_point"), F.when(n > 1, F.stddev_pop("_z") / F.sqrt(n - 1)).alias("zero_error"))


TERM = re.compile(r"^(P(\d?[A-FNRXY])+|Z|S[XY]|SXY|SC|XC|GA|GW|EA|EW|R[SOC])(:\d+)?$")


def parse_response(text: str) -> dict[str, float]:
    """The same on the driver, refusing names outside the grammar."""
    out = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        name, _, value = part.partition("=")
        if not TERM.match(name):
            raise ValueError(f"term {name!r}")
        out[name] = float(value)
    return out


def format_response(terms: dict[str, float]) -> str:
    return ",".join(f"{k}={v:g}" for k, v in terms.items())


def model_table(spark: SparkSession, terms: dict[str, tuple[float, float]]) -> DataFrame:
    """(term, val, err): a fitted model as a table, which any writer saves."""
    return spark.createDataFrame([(k, float(v), float(e)) for k, (v, e) in terms.items()], "term string, val double, err double")


def model_terms(table: DataFrame) -> dict[str, tuple[float, float]]:
    """The same read back; a model has a few dozen terms. Names outside the grammar are refused."""
    out = {}
    for r in table.select("term", "val", "err").collect():  # a row per term
        if not TERM.match(r["term"]):
            raise ValueError(f"term {r['term']!r}")
        out[r["term"]] = (r["val"], r["err"])
    return out


class TermList:
    """The terms of a fit: each free or held at a value."""

    def __init__(self, free: dict[str, float] | None = None, held: dict[str, float] | None = None):
        self.free, self.held = dict(free or {}), dict(held or {})

    def _known(self, name: str) -> None:
        if not TERM.match(name):
            raise ValueError(f"term {name!r}")

    def fit(self, name: str, value: float = 0.0) -> None:
        """``name`` is free, from its present value on if it has one."""
        self._known(name)
        self.free[name] = self.held.pop(name, self.free.get(name, value))

    def hold(self, name: str, value: float | None = None) -> None:
        self._known(name)
        now = self.free.pop(name, self.held.get(name, 0.0))
        self.held[name] = now if value is None else value

    def hold_all(self) -> None:
        for name in list(self.free):
            self.hold(name)

    def remove(self, name: str) -> None:
        self.free.pop(name, None)
        self.held.pop(name, None)

    def value(self, name: str) -> float:
        return (self.free | self.held)[name]

    def line(self) -> str:
        return format_response(self.free | self.held)

"""Per-detection features, gates, radii, neighbours and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import clip, flat_separation
from ..functions.tables import written
from .spatial import nearest_any, radius_join

SATURATED, BLENDED, NEAR_BRIGHT = 4, 2, 8
#: Pixels from which on a detection counts as isolated.
ISOLATED = 10
#: Magnitude error times signal to noise.
POGSON = 1.0857
#: The same as the gates have it.
GATE = 1.091
#: Weights of the base score: magnitude, significance, consistency, isolation, light curve, trail.
WEIGHTS = {"mag": 1.0, "sig": 2.0, "cons": 1.5, "iso": 1.0, "lc": 1.0, "trail": 3.0}
TYPE_PRIORITY = {"brightening": 3, "fading": 3, "trail": 2, "new": 1, "unknown": 0}


def detection_features(df: DataFrame, by: tuple[str, ...] = ("epoch_id",)) -> DataFrame:
    """Axis ratio, size over the exposure's median, signal to noise and flag bits. Medians are aggregated and joined back,
    so that an exposure is no one task's window."""
    med = df.groupBy(*by).agg(F.percentile("fwhm", F.lit(0.5)).alias("_med"))
    out = df.join(med, list(by))
    flag = lambda bit: F.col("flags").bitwiseAND(F.lit(bit)) != 0
    return out.withColumns({"axis_ratio": F.try_divide(F.col("b"), F.col("a")), "fwhm_ratio": F.try_divide(F.col("fwhm"), F.col("_med")), "snr_auto": F.try_divide(F.lit(POGSON), F.col("err")), "saturated": flag(SATURATED), "blended": flag(BLENDED), "near_bright": flag(NEAR_BRIGHT)}).drop("_med")


def difference_features(df: DataFrame, by: tuple[str, ...] = ("epoch_id",)) -> DataFrame:
    """The same for difference images: 1 - ellipticity, and signal to noise from a floored error."""
    med = df.groupBy(*by).agg(F.percentile("fwhm", F.lit(0.5)).alias("_med"))
    return df.join(med, list(by)).withColumns({"axis_ratio": 1 - F.col("ellipticity"), "fwhm_ratio": F.try_divide(F.col("fwhm"), F.col("_med")), "snr_auto": F.lit(POGSON) / F.greatest("err", F.lit(1e-6))}).drop("_med")


def passes(error: Column, sigma: float) -> Column:
    """Significance gate; an unknown (NaN) error passes, as it does where NaN compares as false."""
    return F.isnan(error) | (error < GATE / sigma)


def inside_frame(x: Column, y: Column, width: Column | float, height: Column | float, margin: float = 10) -> Column:
    return ~((x < margin) | (y < margin) | (x > F.lit(width) - margin) | (y > F.lit(height) - margin))


def bright_enough(mag: Column, limit: Column, factor: float = 1.1, fallback: Column | None = None) -> Column:
    ok = mag <= factor * limit
    return ok if fallback is None else ok | fallback


def good_shape(ellipticity: Column, fwhm_ratio: Column, most: float = 0.4, low: float = 0.5, high: float = 2.0) -> Column:
    return (ellipticity < most) & fwhm_ratio.between(low, high)


def good_magnitude(mag: Column, limit: Column, brightest: float = 14, margin: float = 0) -> Column:
    return (mag > brightest) & ((mag <= limit - margin) if margin > 0 else F.lit(True))


def pixel_radius(ex2: Column, ey2: Column, sigma: float, ast_var: Column) -> Column:
    """Match radius in pixels from position errors, 1 to 8."""
    var = F.when((ast_var > 0) & ~F.isnan(ast_var), ast_var).otherwise(1.0)
    ok = (ex2 >= 0) & (ey2 >= 0) & ~F.isnan(ex2) & ~F.isnan(ey2)
    return clip(F.when(ok, sigma * F.sqrt(ex2 + ey2) * F.sqrt(var)), 1, 8)


def snr_pixel_radius(fwhm: Column, snr: Column, sigma: float, ast_var: Column) -> Column:
    """The same from size and signal to noise, where there are no position errors."""
    var = F.when((ast_var > 0) & ~F.isnan(ast_var), ast_var).otherwise(1.0)
    size = F.when((fwhm > 0) & ~F.isnan(fwhm), fwhm).otherwise(1.2)
    return clip(sigma * (size / 2.35) / F.greatest(snr, F.lit(1e-6)) * F.sqrt(var), 1, 8)


def cluster_radius(fwhm: Column, a: Column, snr: Column, sigma: float, scale: Column | float) -> Column:
    """Clustering radius in arcsec: sizes and signal to noise with fallbacks, 1 to 8 pixels."""
    size = F.coalesce(F.when(fwhm > 0, fwhm / 2.35), F.when(a > 0, a / 2), F.lit(2.0))
    s = F.coalesce(F.when(~F.isnan(snr), F.greatest(snr, F.lit(3.0))), F.lit(5.0))
    return clip(sigma * size * F.sqrt(10 / s), 1, 8) * F.lit(scale)


def capped_radius(df: DataFrame, radius: str, by: tuple[str, ...] = ("epoch_id",), share: float = 0.95, default: float | None = None) -> DataFrame:
    """``radius`` held to its 95th percentile per exposure: neighbours are only sought that far. An unknown radius counts as
    ``default``, if there is one. Percentiles are taken over counts of distinct radii, which are partial sums."""
    if default is not None:
        df = df.withColumn(radius, F.when((F.col(radius) > 0) & ~F.isnan(radius), F.col(radius)).otherwise(F.lit(float(default))))
    cap = df.groupBy(*by).agg(F.percentile(radius, F.lit(share)).alias("_cap"))
    return df.join(cap, list(by)).withColumn(radius, F.least(radius, "_cap")).drop("_cap")


def neighbour_stats(det: DataFrame, stars: DataFrame, radius: float, key: str = "det_id") -> DataFrame:
    """(key, nearby_sources, source_density, nearest_source_dist): stars within ``radius``, and the distance to the nearest
    however far; infinite without a star. Rows with a star in reach are settled by the count's own pairs."""
    at = stars.select(F.col("x").alias("sx"), F.col("y").alias("sy"))
    pairs = radius_join(det.select(key, "x", "y"), at, radius, right_on=("sx", "sy"))
    got = written(pairs.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("dist").alias("d")), "near")
    lone = det.select(key, "x", "y").join(got.select(key), key, "left_anti")
    far = nearest_any(lone, at.withColumn("_at", F.struct("sx", "sy")), 2 * radius, key, "_at", right_on=("sx", "sy")).select(key, F.lit(0).cast("long").alias("n"), F.col("dist").alias("d"))
    n = F.coalesce("n", F.lit(0))
    return det.select(key).join(got.unionByName(far), key, "left").select(key, n.cast("long").alias("nearby_sources"), (n / (F.pi() * radius * radius)).alias("source_density"), F.coalesce("d", F.lit(float("inf"))).alias("nearest_source_dist"))


def base_score(cols: set[str], weights: dict[str, float] = WEIGHTS, fallback: Column | None = None) -> Column:
    """The product of the factors whose columns are there: an absent column is neutral, and so is a null."""
    out = F.lit(1.0)
    c = F.col
    neutral = lambda v: F.coalesce(v, F.lit(1.0))
    if "fwhm_ratio" in cols:
        out = out * neutral(F.exp(-F.pow(c("fwhm_ratio") - 1, 2) / 0.5) * weights["cons"])
    if "axis_ratio" in cols:
        out = out * neutral(clip(c("axis_ratio"), 0, 1) * weights["cons"])
    if "snr_auto" in cols:
        out = out * neutral(clip(c("snr_auto") / 20, 0, 1) * weights["sig"])
    if "flags" in cols:
        out = out * F.when(c("flags") > 0, 0.5).otherwise(1.0)
    if "nearest_source_dist" in cols:
        out = out * neutral(clip(c("nearest_source_dist") / ISOLATED, 0, 1) * weights["iso"])
    if "mag" in cols:
        bare = clip(F.exp(-(c("mag") - 15) / 3) * weights["mag"], 0.1, 3)
        value = F.coalesce(clip(1 + 0.2 * (c("maglim") - c("mag")), 0.5, 2) * weights["mag"], bare) if "maglim" in cols else bare
        value = neutral(value)
        out = out * (value if fallback is None else F.when(fallback, 1.0).otherwise(value))
    if "candidate_type" in cols:
        out = out * F.when(c("candidate_type") == "trail", 1 / weights["trail"]).otherwise(1.0)
    return out


def light_curve_factor(wmean: Column, spread: Column, n: Column, least: float, weights: dict[str, float] = WEIGHTS) -> Column:
    """The magnitude range counts twice, capped beside the brightness and once as it is."""
    both = F.exp(-(wmean - 15) / 3) * F.least(spread / 0.5, F.lit(3.0)) * weights["lc"]
    return F.coalesce(both, F.lit(1.0)) * F.coalesce(spread, F.lit(1.0)) * F.sqrt(F.greatest(n, F.lit(1)) / max(least, 1))


def sn_score(quality: Column, kind: Column, galaxy: Column, axis_ratio: Column, separation: Column) -> Column:
    """Composite score by type, host and closeness to a target (degrees; null without), to four digits half-even."""
    tw = F.when(kind == "new", 1.0).when(kind == "brightening", 0.8).when(kind == "fading", 0.2).when(kind == "trail", 0.0).otherwise(0.3)
    gal = F.when(galaxy == "in_galaxy", 0.4).when(galaxy == "nuclear", 0.1).otherwise(0.0)
    prox = F.coalesce(0.5 * clip(1 - separation / 4, 0, 1), F.lit(0.0))
    return F.bround(quality * tw + gal + 0.2 * clip(axis_ratio, 0, 1) + prox, 4)


def band_stats(det: DataFrame, stars: DataFrame, radius: float, bands: list[str], key: str = "det_id") -> DataFrame:
    """(key, mean_<band>, std_<band>) over the stars within ``radius``; population deviations, null without a star."""
    pairs = radius_join(det.select(key, "x", "y"), stars.select(F.col("x").alias("sx"), F.col("y").alias("sy"), *bands), radius, right_on=("sx", "sy"))
    got = pairs.groupBy(key).agg(*[f(b).alias(f"{n}_{b}") for b in bands for n, f in (("mean", F.avg), ("std", F.stddev_pop))])
    return det.select(key).join(got, key, "left")


def in_reference_frame(x: Column, y: Column, width: Column | float, height: Column | float, margin: float = 10) -> Column:
    """Whether a position lies in the reference image or at most ``margin`` outside: low edges count, high ones don't."""
    inside = lambda v, size: (v >= -margin) & (v < F.lit(size) + margin)
    return inside(x, width) & inside(y, height)


def early_enough(start: Column, exposure: Column, trigger: Column | float, limit: float = 43200.0) -> Column:
    """Whether the middle of an exposure is within ``limit`` seconds of the trigger (or before it)."""
    return start + exposure / 2 - F.lit(trigger) <= limit


def fwhm_or_default(fwhm: Column, default: float = 3.0) -> Column:
    """A header's size in pixels; the default where it is absent, not finite or not positive."""
    return F.when((fwhm > 0) & (fwhm < float("inf")), fwhm).otherwise(F.lit(default))


def legacy_candidates(det: DataFrame, stars: DataFrame, radius: float, siglim: float, width: float, height: float, frame: float = 10, key: str = "det_id") -> DataFrame:
    """The detections that the early per-row rule calls candidates: off the edges, significant, and without a star in reach
    whose model magnitude agrees within ``siglim`` errors. ``stars``: sx, sy, star_mag; a null magnitude agrees with nothing."""
    x = det.where(inside_frame(F.col("x"), F.col("y"), width, height, frame) & (F.col("err") < GATE / siglim))
    near = radius_join(x.select(key, "x", "y", "mag", "err"), stars.select("sx", "sy", "star_mag").where("star_mag is not null"), radius, right_on=("sx", "sy"))
    known = near.where(F.abs(F.col("star_mag") - F.col("mag")) <= siglim * F.col("err")).select(key).distinct()
    return x.join(known, key, "left_anti")


def target_epochs(det: DataFrame, ra: float, dec: float, radius: float = 5.0) -> DataFrame:
    """(epoch_id, present): whether anything is within ``radius`` arcsec of the target, on the flat sky."""
    near = flat_separation(F.col("ra"), F.col("dec"), F.lit(ra), F.lit(dec)) * 3600 <= radius
    return det.groupBy("epoch_id").agg(F.max(near).alias("present"))

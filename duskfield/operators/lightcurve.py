"""Light curves: nearest detection per exposure, statistics, motion and trails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import clip
from ..functions.tables import spread, written
from .spatial import radius_join

VARIABLE_CHI2 = 2.0
TYPICAL_MAG = 16.0
#: Residuals (arcsec) below this are rounding.
ROUNDING = 1e-7


def build(groups: DataFrame, det: DataFrame, radius: float, system: str = "pixel") -> DataFrame:
    """Each group's nearest detection of every exposure within ``radius`` of the group's mean position.

    ``groups``: gid and gx, gy (gra, gdec on the sky); ``det``: det_id, epoch_id and positions. Distances count to seven
    digits; of two as near, the smaller det_id counts. Minima are partial, so that a hot group's pairs aren't shuffled.
    """
    on = ("gra", "gdec") if system == "sky" else ("gx", "gy")
    pairs = radius_join(det, groups, radius, system, right_on=on).withColumn("dist", F.round("dist", 7))
    rest = [c for c in pairs.columns if c not in ("gid", "epoch_id", "dist", "det_id")]
    best = pairs.groupBy("gid", "epoch_id").agg(F.min(F.struct("dist", "det_id", *rest)).alias("_best"))
    return best.select("gid", "epoch_id", "_best.*")


def statistics(points: DataFrame, group: str = "gid") -> DataFrame:
    """Span, counts, scatter, variation and reduced chi squared per group. ``points``: obs_time, epoch_id, mag, err, ra, dec.

    All but the steps between neighbours are partial sums; squares are of magnitudes less a typical one, so that they keep
    their digits.
    """
    order = Window.partitionBy(group).orderBy("obs_time", "det_id")
    w, off = 1 / (F.col("err") * F.col("err")), F.col("mag") - TYPICAL_MAG
    x = points.withColumn("_step", F.abs(F.col("mag") - F.lag("mag").over(order)))
    x = x.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_detections"),
        F.count_distinct("epoch_id").alias("n_epochs"),
        ((F.max("obs_time") - F.min("obs_time")) / 3600).alias("time_span_hours"),
        (F.sqrt(F.pow(F.stddev_pop("ra"), 2) + F.pow(F.stddev_pop("dec"), 2)) * 3600).alias("position_scatter_arcsec"),
        F.coalesce(F.sum("_step"), F.lit(0.0)).alias("mag_schizo"),
        (F.sum(F.col("mag") * w) / F.sum(w)).alias("mag_weighted_mean"),
        (F.max("mag") - F.min("mag")).alias("mag_range"),
        F.stddev_pop("mag").alias("mag_std"),
        F.sum(w).alias("_w"),
        F.sum(w * off).alias("_wm"),
        F.sum(w * off * off).alias("_wmm"),
    )
    chi2 = F.greatest(F.col("_wmm") - F.col("_wm") * F.col("_wm") / F.col("_w"), F.lit(0.0))
    x = x.withColumn("mag_chi2_reduced", F.when(F.col("n_detections") > 1, chi2 / (F.col("n_detections") - 1)).otherwise(0.0))
    return x.withColumn("is_variable", F.col("mag_chi2_reduced") > VARIABLE_CHI2).drop("_w", "_wm", "_wmm")


def reference_points(points: DataFrame, group: str = "gid", by: str = "snr") -> DataFrame:
    """(group, r: ra, dec, obs_time) of the point that motion is counted from: the one of the best signal to noise (``snr``),
    the one nearest to the median time (``time``), or the middle one in order of time (``middle``). Of several, the one of
    smaller det_id."""
    at = ("ra", "dec", "obs_time")
    if by == "snr":
        return points.groupBy(group).agg(F.max(F.struct((1 / F.col("err")).alias("s"), (-F.col("det_id")).alias("k"), *at)).alias("r"))
    if by == "time":
        mid = points.groupBy(group).agg(F.percentile("obs_time", F.lit(0.5)).alias("_mid"))
        return points.join(mid, group).groupBy(group).agg(F.min(F.struct(F.abs(F.col("obs_time") - F.col("_mid")).alias("s"), F.col("det_id").alias("k"), *at)).alias("r"))
    if by != "middle":
        raise ValueError(f"reference by {by!r}")
    n = points.groupBy(group).agg(F.count(F.lit(1)).alias("_all"))
    place = F.row_number().over(Window.partitionBy(group).orderBy("obs_time", "det_id")) - 1
    return points.withColumn("_at", place).join(n, group).where("_at = _all div 2").select(group, F.struct(*at).alias("r"))


def motion(points: DataFrame, group: str = "gid", by: str = "snr") -> DataFrame:
    """Linear motion per group: rates in arcsec an hour, robust residual scatter, significance, consistent exposures.

    Positions count from ``reference_points``. Fits are aggregates; the medians of the residuals take a second pass.
    Without a spread in time all is 0. What a pass finds by group is written, so that the next one does not repeat it: all in
    one plan, the passes before are computed anew for each pass, and one task holds the sorts of all.
    """
    x = points.join(written(reference_points(points, group, by), "references"), group)
    x = x.select(group, "det_id", ((F.col("obs_time") - F.col("r.obs_time")) / 3600).alias("t"), ((F.col("ra") - F.col("r.ra")) * F.cos(F.radians("r.dec")) * 3600).alias("da"), ((F.col("dec") - F.col("r.dec")) * 3600).alias("dd"))
    fit = x.groupBy(group).agg(*[f("d" + c, "t").alias(n + c) for c in "ad" for f, n in ((F.regr_slope, "s"), (F.regr_intercept, "i"))], F.count(F.lit(1)).alias("n"))
    x = x.join(written(fit, "fits"), group)
    x = x.withColumns({f"r{c}": F.col(f"d{c}") - F.col(f"s{c}") * F.col("t") - F.col(f"i{c}") for c in "ad"})
    mid = x.groupBy(group).agg(*[F.percentile(f"r{c}", F.lit(0.5)).alias(f"m{c}") for c in "ad"])
    x = x.join(written(mid, "middles"), group)
    mad = x.groupBy(group).agg(*[(F.percentile(F.abs(F.col(f"r{c}") - F.col(f"m{c}")), F.lit(0.5)) / 0.67).alias(f"v{c}") for c in "ad"])
    sigma = F.sqrt(F.pow("va", 2) + F.pow("vd", 2))
    off = F.sqrt(F.pow("ra", 2) + F.pow("rd", 2))
    got = x.join(written(mad, "scatters"), group).groupBy(group).agg(F.first("sa").alias("ma"), F.first("sd").alias("md"), F.first(sigma).alias("sigma"), F.count(F.when(off <= 2 * sigma + ROUNDING, 1)).alias("moving"))
    zero = lambda v: F.coalesce(v, F.lit(0.0))
    rate = F.sqrt(F.pow(zero(F.col("ma")), 2) + F.pow(zero(F.col("md")), 2))
    return got.select(group, zero(F.col("ma")).alias("motion_ra_as_per_hr"), zero(F.col("md")).alias("motion_dec_as_per_hr"), rate.alias("motion_total_as_per_hr"), zero(F.col("sigma")).alias("motion_sigma_as"), F.when(F.col("ma").isNotNull(), rate / F.greatest(zero(F.col("sigma")), F.lit(1e-6))).otherwise(0.0).alias("motion_significance"), F.when(F.col("ma").isNotNull(), F.col("moving")).otherwise(0).alias("n_epochs_moving"))


def motion_angle(ra_rate: Column, dec_rate: Column) -> Column:
    """The direction of motion, east of north, in [0, 180); null without motion."""
    angle = F.degrees(F.atan2(ra_rate, dec_rate))
    return F.when((ra_rate != 0) | (dec_rate != 0), F.when(angle < 0, angle + 180).when(angle >= 180, angle - 180).otherwise(angle))


def trail_shape(points: DataFrame, pa: DataFrame, group: str = "gid") -> DataFrame:
    """Mean elongation, mean size over the group's median size, and how well the detections' angles agree with the direction
    of motion (``pa``: group, pa in degrees, null without motion). What isn't finite or positive is left out; without any
    valid value these are 0, 1 and 0."""
    x = points.join(pa, group)
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    d = F.abs(F.col("pa") - F.col("theta"))
    d = F.when(d > 90, 180 - d).otherwise(d)
    size = F.when((F.col("fwhm") > 0) & finite(F.col("fwhm")), F.col("fwhm"))
    shape = F.when((F.col("a") > 0) & (F.col("b") > 0) & finite(F.col("a")) & finite(F.col("b")), clip(1 - F.col("b") / F.col("a"), 0, 1))
    got = x.groupBy(group).agg(F.avg(shape).alias("e"), F.avg(size).alias("s"), F.percentile(size, F.lit(0.5)).alias("m"), F.avg(F.when(finite(F.col("theta")), 1 - d / 90)).alias("al"))
    return got.select(group, F.coalesce("e", F.lit(0.0)).alias("elongation_mean"), F.coalesce(F.col("s") / F.col("m"), F.lit(1.0)).alias("fwhm_ratio_mean"), F.coalesce("al", F.lit(0.0)).alias("align_mean"))


#: What makes a trail: exposures that follow the motion, scatter (arcsec), significance, score, and displacement in
#: astrometric errors.
TRAIL = {"epochs": 3, "sigma": 0.5, "significance": 3.0, "score": 0.7, "displacement": 3.0}


def trail_score(elongation: Column, significance: Column, alignment: Column, displacement: Column) -> Column:
    return 0.35 * clip(elongation, 0, 1) + 0.30 * clip(significance / 10, 0, 1) + 0.15 * clip(alignment, 0, 1) + 0.20 * clip(displacement / 5, 0, 1)


def is_trail(moving: Column, sigma: Column, significance: Column, score: Column, ast_sigma: Column, displacement: Column, least: dict[str, float] = TRAIL) -> Column:
    enough = moving >= least["epochs"]
    by_score = enough & (sigma >= least["sigma"]) & (significance >= least["significance"]) & (score >= least["score"])
    return by_score | (enough & (ast_sigma > 0) & (displacement >= least["displacement"]))


def trails(points: DataFrame, ast_sigma: Column | float = 0.0, group: str = "gid", least: dict[str, float] = TRAIL) -> DataFrame:
    """Per group its motion, its shape, ``trail_score`` and ``is_trail``. ``ast_sigma``: the frames' astrometric error in
    arcsec, over the columns of ``points``, of which the group's least is taken; 0 where it isn't known.

    Points are dealt by group once: all passes sort them there, and Spark would join tasks of few, well packed bytes."""
    points = spread(points, group)
    m = written(motion(points, group), "motions")
    angle = m.select(group, motion_angle(F.col("motion_ra_as_per_hr"), F.col("motion_dec_as_per_hr")).alias("pa"))
    span = points.groupBy(group).agg(((F.max("obs_time") - F.min("obs_time")) / 3600).alias("_hours"), F.coalesce(F.min(F.lit(ast_sigma)), F.lit(0.0)).alias("ast_sigma"))
    x = m.join(trail_shape(points, angle, group), group).join(span, group)
    far = F.when((F.col("ast_sigma") > 0) & (F.col("_hours") > 0), F.col("motion_total_as_per_hr") * F.col("_hours") / F.col("ast_sigma")).otherwise(0.0)
    x = x.withColumn("displacement", far)
    x = x.withColumn("trail_score", trail_score(F.col("elongation_mean"), F.col("motion_significance"), F.col("align_mean"), F.col("displacement")))
    decided = is_trail(F.col("n_epochs_moving"), F.col("motion_sigma_as"), F.col("motion_significance"), F.col("trail_score"), F.col("ast_sigma"), F.col("displacement"), least)
    return x.withColumn("is_trail", decided).drop("_hours")


def trail_summary(rows: DataFrame) -> DataFrame:
    """One row: how many of the candidates are trails, and the least, greatest and middle rate and significance of these."""
    trail = F.col("candidate_type") == "trail"
    own = lambda c: F.when(trail, F.col(c))
    stats = [("min", F.min), ("max", F.max), ("median", lambda v: F.percentile(v, F.lit(0.5)))]
    named = (("rate", "motion_total_as_per_hr"), ("significance", "motion_significance"))
    return rows.agg(F.count(F.when(trail, 1)).alias("n_trails"), F.count(F.lit(1)).alias("n_total"), *[f(own(c)).alias(f"{label}_{n}") for label, c in named for n, f in stats])


def hours_since_first(points: DataFrame, group: str = "gid") -> DataFrame:
    """``points`` with ``hours`` since the group's first. The first is an aggregate joined back, so no group is one task's."""
    first = points.groupBy(group).agg(F.min("obs_time").alias("_first"))
    return points.join(first, group).withColumn("hours", (F.col("obs_time") - F.col("_first")) / 3600).drop("_first")


def source_fit(points: DataFrame, pixel: float = 1.0, group: str = "gid") -> DataFrame:
    """The early per-source fit: position at the middle of the span, speeds in arcsec an hour, scatter of the residuals
    (median over 0.67, arcsec), displacement over the span, weighted magnitude, its variation in errors, and the status:
    ``*`` for a displacement over ``pixel`` arcsec, ``-`` for a variation under 3."""
    w = 1 / (F.col("err") * F.col("err"))
    span = points.groupBy(group).agg(((F.min("obs_time") + F.max("obs_time")) / 2).alias("_mid"), (F.max("obs_time") - F.min("obs_time")).alias("_dt"), (F.sum(F.col("mag") * w) / F.sum(w)).alias("mag_weighted"))
    x = points.join(span, group).withColumn("_t", (F.col("obs_time") - F.col("_mid")) / 3600)
    fit = x.groupBy(group).agg(*[F.coalesce(F.regr_slope(c, "_t"), F.lit(0.0)).alias(f"_s{c}") for c in ("ra", "dec")], *[F.coalesce(F.regr_intercept(c, "_t"), F.avg(c)).alias(f"_i{c}") for c in ("ra", "dec")])
    x = x.join(fit, group)
    off = lambda c: F.percentile(F.abs(F.col(c) - F.col(f"_s{c}") * F.col("_t") - F.col(f"_i{c}")), F.lit(0.5)) / 0.67 * 3600
    got = x.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.first(f"_i{c}").alias(c) for c in ("ra", "dec")],
        *[(F.first(f"_s{c}") * 3600).alias(f"{c}_speed") for c in ("ra", "dec")],
        *[off(c).alias(f"{c}_scatter") for c in ("ra", "dec")],
        (F.first("_dt") / 3600).alias("_hours"),
        F.first("mag_weighted").alias("mag_weighted"),
        F.sqrt(F.avg(F.pow((F.col("mag") - F.col("mag_weighted")) / F.col("err"), 2))).alias("mag_var"),
    )
    moved = F.sqrt(F.pow("dec_speed", 2) + F.pow(F.col("ra_speed") * F.cos(F.radians("dec")), 2)) * F.col("_hours")
    got = got.withColumns({"dpos": moved, "scatter": F.sqrt(F.pow("ra_scatter", 2) + F.pow("dec_scatter", 2))})
    steady, moving = F.col("mag_var") < 3, F.col("dpos") > pixel
    status = F.when(steady & moving, "*- ").when(steady, " - ").when(moving, "*  ").otherwise("!!!")
    return got.withColumn("status", status).drop("_hours")

"""The two end-to-end plans: catalogue votes over exposures, and the supernova chain of filters and scores."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import identity as ident
from ..functions.tables import written
from ..operators import cluster, features, lightcurve, spatial
from ..sources.catalogs import frame_stars
from ..sources.config import Settings


class Strategy(Protocol):
    """Detections to (candidates, light-curve points)."""

    def run(self, det: DataFrame) -> tuple[DataFrame, DataFrame]: ...


class CatalogVotes:
    """Each catalogue proposes candidates per exposure, votes settle them, and clusters over exposures get light curves.

    ``catalogs``: name -> stars (sx, sy, star_mag; with an epoch_id, in all of them, those of each exposure). With
    ``exposures`` (see ``catalogs.frame_stars``) they are catalogue rows, which are placed in each exposure and compared in
    its own system. ``movers``: epoch_id, mra, mdec, the solar system's bodies in each
    exposure; ``variables``: vra, vdec, catalogued variable stars. ``frame``: width and height in pixels. ``scale``: arcsec
    per pixel, over the detections' columns. ``ast_sigma``: the exposures' astrometric error in arcsec, likewise. Tables
    are written in between: proposals, the exposures' candidates, the clusters and the points. ``extend`` may add columns
    to the candidates.
    """

    def __init__(self, catalogs: dict[str, DataFrame], settings: Settings | None = None, extend: Callable[[DataFrame, DataFrame], DataFrame] | None = None, movers: DataFrame | None = None, variables: DataFrame | None = None, frame: tuple[float, float] | None = None, edge: float = 10.0, scale: Column | None = None, ast_sigma: Column | float = 0.0, exposures: DataFrame | None = None):
        self.exposures = exposures
        self.catalogs, self.settings, self.extend = catalogs, settings or Settings(), extend
        self.movers, self.variables, self.frame, self.edge, self.ast_sigma = movers, variables, frame, edge, ast_sigma
        self.scale = F.lit(self.settings.default_plate_scale_arcsec_per_px) if scale is None else scale

    def match_radii(self, det: DataFrame) -> DataFrame:
        """``det`` with ``match_px``, the radius within which it meets catalogue stars: from position errors in an exposure that has
        any valid ones, else from size and signal to noise, held to a percentile of its exposure."""
        s = self.settings
        if not s.enable_adaptive_idlimit:
            return det.withColumn("match_px", F.lit(float(s.idlimit_px)))
        var = F.col("ast_var") if s.use_astvar and "ast_var" in det.columns else F.lit(1.0)
        own = features.snr_pixel_radius(F.col("fwhm"), features.GATE / F.col("err"), s.adaptive_nsigma, var)
        if {"ex2", "ey2"} <= set(det.columns):
            measured = features.pixel_radius(F.col("ex2"), F.col("ey2"), s.adaptive_nsigma, var)
            det = det.join(det.groupBy("epoch_id").agg(F.max(measured.isNotNull()).alias("_measured")), "epoch_id")
            own = F.when(F.col("_measured"), measured).otherwise(own)
        own = geo.clip(own, s.idlimit_min_px, s.idlimit_max_px)
        return features.capped_radius(det.withColumn("match_px", own).drop("_measured"), "match_px", ("epoch_id",), s.adaptive_percentile / 100, s.idlimit_px)

    def proposals(self, det: DataFrame) -> DataFrame:
        """What each catalogue calls new or changed, scored and gated, with the clustering radius ``r`` in arcsec."""
        s = self.settings
        x = self.match_radii(det)
        if self.frame:
            x = x.where(features.inside_frame(F.col("x"), F.col("y"), *self.frame, self.edge))
        base = written(x, "matched")
        most = max(s.idlimit_px, s.idlimit_max_px) if s.enable_adaptive_idlimit else s.idlimit_px
        out = stars = None
        by: tuple[str, ...] = ("catalog",)
        for k, (name, known) in enumerate(self.catalogs.items()):
            if self.exposures is not None:
                known = written(frame_stars(known, self.exposures), "stars")
            by = ("catalog", "epoch_id") if "epoch_id" in known.columns else by
            kinds = cluster.classify(base, known, most, s.siglim, s.new_source_siglim or s.siglim, s.mag_change_threshold, name, own_radius="match_px")
            y = base.join(kinds, "det_id").where(features.bright_enough(F.col("mag"), F.col("maglim"), s.maglim_filter_multiplier))
            y = y.withColumns({"catalog": F.lit(name), "cand_id": F.col("det_id") * len(self.catalogs) + k})
            at = known.select(F.lit(name).alias("catalog"), "sx", "sy", *by[1:])
            out, stars = (y, at) if out is None else (out.unionByName(y), stars.unionByName(at))
        # Sizes are over the median of an exposure's candidates of one catalogue; stars beyond ISOLATED pixels count as none.
        out = features.detection_features(written(out, "classified"), ("epoch_id", "catalog"))
        near = spatial.radius_join(stars, out.select("cand_id", *by, "x", "y"), features.ISOLATED, left_on=("sx", "sy"), right_on=("x", "y"), by=by)
        near = near.groupBy("cand_id").agg(F.min("dist").alias("_near"))
        out = out.join(near, "cand_id", "left").withColumn("nearest_source_dist", F.coalesce("_near", F.lit(float("inf")))).drop("_near")
        score = features.base_score({"fwhm_ratio", "axis_ratio", "snr_auto", "flags", "mag", "maglim", "candidate_type", "nearest_source_dist"}, s.weights)
        out = out.withColumn("quality", score).where(~F.isnan("quality") & (F.col("quality") >= s.min_quality))
        if self.movers is not None and s.vsx_filter_enabled:
            out = spatial.radius_anti(out, self.movers, s.vsx_match_radius_arcsec, system="sky", right_on=("mra", "mdec"), by=("epoch_id",), strict=True)
        r = features.cluster_radius(F.col("fwhm"), F.col("a"), F.col("snr_auto"), s.adaptive_nsigma, self.scale)
        return written(out.withColumn("r", r), "proposed")

    def epoch_candidates(self, det: DataFrame) -> DataFrame:
        """One row for each source of an exposure that enough catalogues agree on."""
        s = self.settings
        proposed = self.proposals(det)
        most = proposed.agg(F.max("r")).first()[0] or 1.0  # one number
        return written(cluster.vote_candidates(proposed, most, len(self.catalogs), s.min_catalogs_fraction), "epoch_candidates")

    def run(self, det: DataFrame) -> tuple[DataFrame, DataFrame]:
        s = self.settings
        cands = self.epoch_candidates(det)
        groups = written(cluster.cross_epoch(cands, s.position_match_radius_arcsec, s.min_n_detections), "groups")
        members = cands.join(groups, "det_id").withColumn("gid", F.xxhash64("component", "sub"))
        rep = cluster.representatives(members, "gid").withColumnRenamed("n_members", "n_candidates").drop("n_epochs")
        mean = members.groupBy("gid").agg(F.avg("ra").alias("gra"), F.avg("dec").alias("gdec"))
        points = lightcurve.build(mean, det, s.position_match_radius_arcsec, "sky")
        long = points.groupBy("gid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= s.min_n_detections).select("gid")
        points = written(points.join(long, "gid", "left_semi"), "points")
        best = members.select("det_id", "gid", "ra", "dec")
        rows = rep.join(best, ["det_id", "gid"]).join(lightcurve.statistics(points), "gid").join(lightcurve.trails(points, self.ast_sigma, least=s.trail), "gid")
        moving = F.col("is_trail") & ~F.col("candidate_type").isin("brightening", "fading")
        rows = rows.withColumn("candidate_type", F.when(moving, "trail").otherwise(F.col("candidate_type")))
        factor = features.light_curve_factor(F.col("mag_weighted_mean"), F.col("mag_range"), F.col("n_detections"), s.min_n_detections, s.weights)
        rows = rows.withColumns({"quality_score": F.col("quality") * factor, "transient_id": ident.position_id(F.col("ra"), F.col("dec"))})
        rows = cluster.best_per_id(rows, "transient_id", "quality_score", "gid")
        if self.variables is not None and s.vsx_filter_enabled:
            rows = spatial.radius_anti(rows, self.variables, s.vsx_match_radius_arcsec, system="sky", right_on=("vra", "vdec"), strict=True)
        rows = written(rows.where(F.col("quality_score") >= s.min_quality), "final")
        points = points.join(rows.select("gid"), "gid", "left_semi")
        if self.extend:
            rows = self.extend(rows, points)
        return rows.orderBy(F.desc("quality_score"), "transient_id"), points


class DifferenceCandidates(CatalogVotes):
    """The same over difference images: what is significant there is new, whatever catalogues have, and one table votes.

    ``det``: difference detections with calibrated mag and err, ellipticity and fwhm; rows with a true ``dipole`` column are
    residuals of bad subtraction and go. ``provenance`` names the template and stands for the catalogue.
    """

    def __init__(self, settings: Settings | None = None, provenance: str = "unknown", **how):
        super().__init__({provenance: None}, settings, **how)

    def proposals(self, det: DataFrame) -> DataFrame:
        s = self.settings
        x = det.where(~F.coalesce("dipole", F.lit(False))) if "dipole" in det.columns else det
        if self.frame:
            x = x.where(features.inside_frame(F.col("x"), F.col("y"), *self.frame, self.edge))
        x = features.difference_features(x.where(features.passes(F.col("err"), s.new_source_siglim or s.siglim)))
        x = x.withColumns({"candidate_type": F.lit("new"), "magnitude_difference": F.lit(None).cast("double")})
        score = features.base_score({"fwhm_ratio", "axis_ratio", "snr_auto", "flags", "mag", "maglim", "candidate_type"} & set(x.columns), s.weights)
        (name,) = self.catalogs
        x = x.withColumns({"quality": score, "catalog": F.lit(name), "cand_id": F.col("det_id")})
        x = x.where(~F.isnan("quality") & (F.col("quality") >= s.min_quality))
        if self.movers is not None and s.vsx_filter_enabled:
            x = spatial.radius_anti(x, self.movers, s.vsx_match_radius_arcsec, system="sky", right_on=("mra", "mdec"), by=("epoch_id",), strict=True)
        size = F.col("a") if "a" in x.columns else F.lit(None).cast("double")
        r = features.cluster_radius(F.col("fwhm"), size, F.col("snr_auto"), s.adaptive_nsigma, self.scale)
        return written(x.withColumn("r", r), "proposed")


#: The strategies by their names in the settings.
STRATEGIES: dict[str, type[CatalogVotes]] = {"blind_multicatalog": CatalogVotes, "subtraction": DifferenceCandidates}


def stack_plan(frames: DataFrame, scores: DataFrame, done: DataFrame, settings: Settings | None = None, group: str = "field") -> DataFrame:
    """(group, epoch_id) of the frames to be stacked now: of each group that has enough exposures, enough new ones since its
    last stack, and no candidate that is good already, the latest of one filter and exposure time.

    ``frames``: group, epoch_id, filter, exptime, obs_time; ``scores``: group, score; ``done``: group, n (exposures in the
    last stack).
    """
    s = settings or Settings()
    if not s.stacking_enabled:
        return frames.select(group, "epoch_id").where("false")
    x = frames.where("filter is not null and exptime is not null").withColumn("secs", F.bround("exptime", 1))
    n = frames.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    best = scores.groupBy(group).agg(F.max("score").alias("_best"))
    due = n.join(best, group, "left").join(done.select(group, F.col("n").alias("_done")), group, "left")
    fresh = F.col("_done").isNull() | (F.col("_n") - F.col("_done") >= s.stacking_rebuild_interval)
    due = due.where((F.col("_n") >= s.stacking_min_epochs) & fresh & ~(F.coalesce("_best", F.lit(0.0)) >= s.stacking_score_threshold)).select(group)
    sets = x.join(due, group, "left_semi").groupBy(group, "filter", "secs").agg(F.count(F.lit(1)).alias("_k"))
    top = sets.groupBy(group).agg(F.min(F.struct((-F.col("_k")).alias("k"), "filter", "secs")).alias("t")).select(group, "t.filter", "t.secs")
    latest = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("obs_time"), "epoch_id"))
    return x.join(top, [group, "filter", "secs"]).withColumn("_r", latest).where(F.col("_r") <= s.stacking_max_epochs).select(group, "epoch_id")


def supernova_chain(cands: DataFrame, movers: DataFrame, stars: DataFrame, galaxies: DataFrame, known: DataFrame, targets: list[tuple[float, float]], years: float, cut_degrees: float = 4.0, settings: Settings | None = None) -> DataFrame:
    """Shape and magnitude filters, then movers, fast stars, host galaxies, known transients, targets and the score.

    ``cands``: key det_id, epoch_id, ra, dec, mag, maglim, ellipticity, fwhm_ratio, axis_ratio, candidate_type, quality;
    ``movers``: epoch_id, mra, mdec; ``stars``: sra, sdec, pmra, pmdec; ``galaxies``: gal_id, gra, gdec; ``known``: name, kra, kdec.
    """
    s = settings or Settings()
    shape = features.good_shape(F.col("ellipticity"), F.col("fwhm_ratio"), s.morphology_max_ellipticity, s.morphology_fwhm_ratio_min, s.morphology_fwhm_ratio_max)
    x = cands.where(shape & features.good_magnitude(F.col("mag"), F.col("maglim")))
    x = spatial.radius_anti(x, movers, 10.0, system="sky", right_on=("mra", "mdec"), by=("epoch_id",))
    fast = stars.where(F.sqrt(F.pow("pmra", 2) + F.pow("pmdec", 2)) >= 20)
    ra, dec = geo.moved(F.col("sra"), F.col("sdec"), F.col("pmra"), F.col("pmdec"), years)
    x = spatial.radius_anti(x, fast.select(ra.alias("fra"), dec.alias("fdec")), 2.0, system="sky", right_on=("fra", "fdec"))
    host = spatial.nearest_any(x.select("det_id", "ra", "dec"), galaxies, 4.0, "det_id", "gal_id", system="sky", right_on=("gra", "gdec"))
    x = x.join(host.select("det_id", F.col("dist").alias("galaxy_sep_arcsec")), "det_id", "left")
    sep = F.col("galaxy_sep_arcsec")
    x = x.withColumn("galaxy_flag", F.when(sep <= 2, "nuclear").when(sep <= 30, "in_galaxy").otherwise("isolated"))
    named = spatial.nearest(x.select("det_id", "ra", "dec"), known, 5.0, "det_id", "name", system="sky", right_on=("kra", "kdec"))
    x = x.join(named.select("det_id", F.col("name").alias("tns_name")), "det_id", "left")
    apart = F.least(*[geo.flat_separation(F.col("ra"), F.col("dec"), F.lit(a), F.lit(d)) for a, d in targets], F.lit(float("inf"))) if targets else F.lit(None).cast("double")
    if targets:
        x = x.where(apart <= cut_degrees)
    score = features.sn_score(F.col("quality"), F.col("candidate_type"), F.col("galaxy_flag"), F.col("axis_ratio"), apart)
    return x.withColumn("sn_score", score).orderBy(F.desc("sn_score"), "det_id")

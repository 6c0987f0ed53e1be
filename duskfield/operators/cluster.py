"""Classification against a catalogue, votes of catalogues, clusters over exposures."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.photometry import DETECTION_FLOOR, systematic_error
from .features import TYPE_PRIORITY, passes
from ..functions.tables import written
from .graph import connected_components, greedy_split, near_components
from .spatial import radius_anti, radius_join, self_pairs


def new_sources(det: DataFrame, stars: DataFrame, radius: float, siglim: float) -> DataFrame:
    """Significant detections without a star in reach."""
    return radius_anti(det.where(passes(F.col("err"), siglim)), stars, radius, right_on=("sx", "sy"))


def classify(det: DataFrame, stars: DataFrame, radius: float, siglim: float, new_siglim: float, least_change: float, catalog: str, key: str = "det_id", own_radius: str | None = None) -> DataFrame:
    """(key, candidate_type, magnitude_difference): new sources and significant changes against one catalogue.

    ``stars``: sx, sy, star_mag (null where the star can't be used); with an epoch_id, stars as an exposure sees them, which
    meet its detections only. ``own_radius`` names a column with each detection's
    match radius, to which ``radius`` is a bound. A detection without a match is new at ``new_siglim``; one with usable
    matches is a candidate if some change is significant, and the largest counts; one whose matches are all unusable is
    new with an unknown (NaN) difference.
    """
    own = {} if own_radius is None else {"row_radius": F.col(own_radius)}
    by = ("epoch_id",) if "epoch_id" in stars.columns else ()
    near = radius_join(det.select(key, "x", "y", "mag", "err", *by, *([own_radius] if own_radius else [])), stars, radius, right_on=("sx", "sy"), by=by, **own)
    change = F.col("mag") - F.col("star_mag")
    sigma = F.sqrt(F.col("err") * F.col("err") + F.lit(DETECTION_FLOOR**2) + F.pow(systematic_error(F.lit(catalog)), 2))
    big = (F.abs(change) >= least_change) & (F.abs(change) / sigma > siglim)
    got = near.groupBy(key).agg(F.count("star_mag").alias("usable"), F.max(F.when(big, F.struct(F.abs(change).alias("size"), change.alias("change")))).alias("best"))
    x = det.select(key, "err").join(got, key, "left")
    unmatched = F.col("usable").isNull()
    kept = (unmatched & passes(F.col("err"), new_siglim)) | (~unmatched & passes(F.col("err"), siglim) & ((F.col("usable") == 0) | F.col("best").isNotNull()))
    kind = F.when(unmatched | (F.col("usable") == 0), "new").when(F.col("best.change") < 0, "brightening").otherwise("fading")
    size = F.when(unmatched, 0.0).when(F.col("usable") == 0, F.lit(float("nan"))).otherwise(F.col("best.change"))
    return x.where(kept).select(key, kind.alias("candidate_type"), size.alias("magnitude_difference"))


def type_priority(kind: Column) -> Column:
    out = F.lit(0)
    for name, v in TYPE_PRIORITY.items():
        out = F.when(kind == name, v).otherwise(out)
    return out


def representatives(members: DataFrame, group: str = "component", key: str = "det_id") -> DataFrame:
    """Per group: the member of best quality, the type of highest priority, and that type's largest change.

    Ties go to the smaller key, by structs whose order says so; maxima are partial sums, not sorted groups.
    """
    known = F.when(~F.isnan("quality"), F.col("quality"))
    best = F.max(F.struct(F.coalesce(known, F.lit(float("-inf"))).alias("q"), (-F.col(key)).alias("k")))
    rank = type_priority(F.col("candidate_type"))
    kinds = F.max(F.struct(rank.alias("p"), known.alias("q"), (-F.col(key)).alias("k"), F.col("candidate_type").alias("type")))
    x = members.groupBy(group).agg(F.count(F.lit(1)).alias("n_members"), F.count_distinct("epoch_id").alias("n_epochs"), best.alias("best"), kinds.alias("kind"))
    x = x.select(group, "n_members", "n_epochs", (-F.col("best.k")).alias(key), F.col("best.q").alias("quality"), F.col("kind.type").alias("candidate_type"))
    change = members.select(group, "magnitude_difference", F.col("candidate_type").alias("t"), F.col(key).alias("_k")).where(~F.isnan("magnitude_difference"))
    own = change.join(x.select(F.col(group).alias("_g"), "candidate_type"), (F.col(group) == F.col("_g")) & (F.col("t") == F.col("candidate_type")))
    size = own.groupBy(group).agg(F.max(F.struct(F.abs("magnitude_difference").alias("s"), (-F.col("_k")).alias("k"), F.col("magnitude_difference").alias("v"))).alias("m"))
    return x.join(size.select(group, F.col("m.v").alias("magnitude_difference")), group, "left")


def vote(candidates: DataFrame, radius: float, n_catalogs: int, share: float, key: str = "cand_id") -> DataFrame:
    """Clusters of one exposure's candidates that enough catalogues agree on, one row each with its members.

    ``candidates``: key, epoch_id, x, y, r (own radius), catalog. Two are joined within the smaller of their radii. The
    number of catalogues is the configured one, so that a failed catalogue counts against.
    """
    x = candidates.join(vote_groups(candidates, radius, key), key)
    return _voted(x, "component", n_catalogs, share)


def vote_groups(candidates: DataFrame, radius: float, key: str = "cand_id", system: str = "pixel") -> DataFrame:
    """(key, component) of each exposure's candidates, joined within the smaller of their radii ``r``, up to ``radius``."""
    return near_components(candidates, radius, key, "r", ("epoch_id",), system)


def _voted(members: DataFrame, group: str, n_catalogs: int, share: float) -> DataFrame:
    need = max(1, math.ceil(share * n_catalogs))
    votes = members.groupBy(group).agg(F.count_distinct("catalog").alias("votes"), F.count(F.lit(1)).alias("n_members"), F.min("epoch_id").alias("epoch_id"))
    return votes.where(F.col("votes") >= need)


def vote_candidates(candidates: DataFrame, radius: float, n_catalogs: int, share: float, key: str = "cand_id") -> DataFrame:
    """One row for each source of an exposure that enough catalogues agree on: its best candidate's row with ``votes``, the
    type of highest priority and that type's largest change.

    ``candidates``: key, epoch_id, ra, dec, r (own radius, arcsec, up to ``radius``), catalog, quality, candidate_type,
    magnitude_difference.
    """
    x = written(candidates.join(vote_groups(candidates, radius, key, "sky"), key), "members")
    votes = _voted(x, "component", n_catalogs, share).select("component", "votes")
    best = representatives(x, "component", key).join(votes, "component").select(key, "votes", "candidate_type", "magnitude_difference")
    return candidates.drop("candidate_type", "magnitude_difference").join(best, key)


def valid_positions(rows: DataFrame) -> DataFrame:
    """The rows with a finite position on the sky."""
    return rows.where("ra >= 0 and ra <= 360 and dec >= -90 and dec <= 90 and not isnan(ra) and not isnan(dec)")


def cross_epoch(candidates: DataFrame, radius: float, least: int, key: str = "det_id") -> DataFrame:
    """(key, component, sub): clusters over exposures. ``candidates``: key, epoch_id, ra, dec, r, quality.

    Members join within min(r, r', 0.6 radius); components whose centroids are within ``radius`` and whose exposures don't
    meet are merged; components are split into groups of one member per exposure; groups under ``least`` go.
    """
    valid = valid_positions(candidates)
    x = valid.join(near_components(valid, 0.6 * radius, key, "r", system="sky"), key)
    mid = x.groupBy("component").agg(F.avg("ra").alias("ra"), F.avg("dec").alias("dec"), F.collect_set("epoch_id").alias("epochs"))
    x = x.join(merged_components(mid, radius), "component").drop("component").withColumnRenamed("root", "component")
    return split_components(x, radius, least, key)


def merged_components(mid: DataFrame, radius: float) -> DataFrame:
    """(component, root): components (component, ra, dec, epochs) whose centroids are within ``radius`` and whose exposures don't
    meet are joined."""
    near = self_pairs(mid, radius, "component", carry=("epochs",), system="sky").where(~F.arrays_overlap("epochs", "epochs2"))
    roots = connected_components(mid.select(F.col("component").alias("c")), near.select(F.col("component").alias("a"), F.col("component2").alias("b")), "c")
    return roots.select(F.col("c").alias("component"), F.col("component").alias("root"))


def split_components(members: DataFrame, radius: float, least: int, key: str = "det_id") -> DataFrame:
    """(key, component, sub) of the groups of at least ``least`` members that the greedy split gives."""
    big = members.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("component")
    split = written(greedy_split(members.join(big, "component", "left_semi"), radius, key), "split")
    enough = split.groupBy("component", "sub").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("component", "sub")
    return split.join(enough, ["component", "sub"], "left_semi").select(key, "component", "sub")


def best_per_id(rows: DataFrame, ident: str, score: str, key: str) -> DataFrame:
    """One row per id: the best score, the smaller key where two are as good."""
    order = Window.partitionBy(ident).orderBy(F.col(score).desc(), key)
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")

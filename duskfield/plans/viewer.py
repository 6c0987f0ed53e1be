"""What a viewer asks of the candidate table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.identity import stem


def facets(df: DataFrame, *columns: str) -> DataFrame:
    """Counts by columns, what is missing as ``unknown``."""
    return df.groupBy(*[F.coalesce(c, F.lit("unknown")).alias(c) for c in columns]).agg(F.count(F.lit(1)).alias("n"))


def chosen(df: DataFrame, **equal: str | None) -> DataFrame:
    """The rows whose columns have the given values; None asks nothing."""
    for c, v in equal.items():
        if v is not None:
            df = df.where(F.coalesce(c, F.lit("unknown")) == v)
    return df


def ranked(df: DataFrame, most: int, scores: list[str], key: str = "det_id") -> DataFrame:
    """The best rows by the first score that each has; none counts as 0."""
    return df.orderBy(F.coalesce(*scores, F.lit(0.0)).desc(), key).limit(most)


def point_list(points: DataFrame, group: str = "gid") -> DataFrame:
    """Per light curve its valid points in order of time, as an array of structs."""
    valid = points.where("not isnan(mag) and not isnan(err) and mag > 0 and err > 0")
    p = F.struct("obs_time", "det_id", "epoch_id", "mag", "err")
    return valid.groupBy(group).agg(F.count(F.lit(1)).alias("n_points"), F.sort_array(F.collect_list(p)).alias("points"))


def axis_range(points: DataFrame, group: str = "gid", groups: DataFrame | None = None) -> DataFrame:
    """The magnitudes that a plot spans: half above, one below; 14 to 22 for those of ``groups`` that have no points."""
    got = points.groupBy(group).agg(F.min("mag").alias("_a"), F.max("mag").alias("_b"))
    if groups is not None:
        got = groups.select(group).distinct().join(got, group, "left")
    return got.select(group, F.coalesce(F.col("_a") - 0.5, F.lit(14.0)).alias("top"), F.coalesce(F.col("_b") + 1.0, F.lit(22.0)).alias("bottom"))


def band_series(points: DataFrame, group: str = "gid") -> DataFrame:
    """(group, band, survey, detections, limits): each light curve's points by band and survey, detections and upper limits
    apart, in order of time. ``points``: mjd, mag, mag_err, ulim, band, survey."""
    point = F.struct("mjd", "mag", "mag_err")
    limit = F.coalesce("ulim", F.lit(False))
    part = lambda keep: F.sort_array(F.collect_list(F.when(keep, point)))
    return points.groupBy(group, "band", "survey").agg(part(~limit).alias("detections"), part(limit).alias("limits"))


def curve_summary(points: DataFrame, group: str = "transient_id") -> DataFrame:
    """(group, n_detections, n_epochs, time_span_hours) of each light curve."""
    return points.groupBy(group).agg(F.count(F.lit(1)).alias("n_detections"), F.count_distinct("epoch_id").alias("n_epochs"), ((F.max("obs_time") - F.min("obs_time")) / 3600).alias("time_span_hours"))


def save_results(cands: DataFrame, points: DataFrame, path: str, most: int, group: str = "transient_id", scores: tuple[str, ...] = ("quality_score",)) -> None:
    """Writes the candidates, the summary of their light curves, and the light curves of the best ``most``, by candidate."""
    cands.write.mode("overwrite").parquet(f"{path}/candidates")
    curve_summary(points, group).write.mode("overwrite").json(f"{path}/lightcurve_summary")
    best_curves(cands, points, most, group, scores).write.mode("overwrite").partitionBy(group).parquet(f"{path}/lightcurves")


def best_curves(cands: DataFrame, points: DataFrame, most: int, group: str = "transient_id", scores: tuple[str, ...] = ("quality_score",)) -> DataFrame:
    """The light curves of the ``most`` best candidates, which is a feature's bound."""
    top = ranked(cands, most, list(scores), group).select(group)
    return points.join(F.broadcast(top), group, "left_semi")  # at most ``most`` rows


#: The columns of the report, in order, by their names in the report.
REPORT = ["ALPHA_J2000", "DELTA_J2000", "MAG_CALIB", "MAGERR_CALIB", "candidate_type", "quality_score", "sn_score", "galaxy_sep_arcsec", "galaxy_name", "galaxy_flag", "tns_name", "tns_type", "tns_z", "reference_catalog", "ELLIPTICITY", "FLAGS"]
#: Our names for some of them.
REPORT_NAMES = {"ALPHA_J2000": "ra", "DELTA_J2000": "dec", "MAG_CALIB": "mag", "MAGERR_CALIB": "err", "reference_catalog": "catalog", "ELLIPTICITY": "ellipticity", "FLAGS": "flags"}


def report_rows(cands: DataFrame, key: str = "det_id") -> DataFrame:
    """(key, report): a candidate's line of the report as JSON: the report's columns that the table has, numbers as doubles,
    NaN and what is absent from a row as null."""
    cols = []
    for name in REPORT:
        c = REPORT_NAMES.get(name, name)
        c = name if name in cands.columns else c
        if c in cands.columns:
            number = isinstance(cands.schema[c].dataType, T.NumericType)
            v = F.col(c).cast("double") if number else F.col(c).cast("string")
            cols.append((F.when(~F.isnan(v), v) if number else v).alias(name))
    return cands.select(key, F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("report"))


def report(cands: DataFrame, observation: str, key: str = "det_id") -> DataFrame:
    """One row: the observation, when it was made, the number of candidates; the lines themselves are ``report_rows``."""
    return cands.agg(F.count(F.lit(1)).alias("n_candidates")).select(F.lit(observation).alias("observation_id"), F.current_timestamp().alias("generated"), "n_candidates")


def nested_json(cands: DataFrame, points: DataFrame, most: int, group: str = "gid", scores: tuple[str, ...] = ("sn_score", "quality_score")) -> DataFrame:
    """(group, value): the best ``most`` candidates, each with its light curve inside, as JSON; without points an empty one."""
    own = [c for c in scores if c in cands.columns]
    top = ranked(cands, most, own, group)
    curves = point_list(points.join(F.broadcast(top.select(group)), group, "left_semi"), group)  # at most ``most`` rows
    x = top.join(curves, group, "left")
    curve = F.struct(F.coalesce("n_points", F.lit(0)).alias("n_points"), F.coalesce("points", F.array().cast(curves.schema["points"].dataType)).alias("points"))
    return x.select(group, F.to_json(F.struct(*cands.columns, curve.alias("lightcurve")), {"ignoreNullFields": "false"}).alias("value"))


def candidate_json(df: DataFrame) -> DataFrame:
    """A line of JSON for each row."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def region_lines(df: DataFrame, radius: float = 5.0) -> DataFrame:
    """Circles around candidates, as lines of a region file."""
    return df.select(F.format_string('circle(%.6f,%.6f,%.1f") # text={%s}', "ra", "dec", F.lit(radius), "transient_id").alias("value"))


def variable_rows(df: DataFrame, kind: str | None = None, only_variable: bool = False) -> DataFrame:
    """The candidates of a type, and only those whose light curves vary if that is asked."""
    out = chosen(df, candidate_type=kind)
    return out.where(F.coalesce("is_variable", F.lit(False))) if only_variable else out


def plot_table(cands: DataFrame, points: DataFrame, most: int = 32, group: str = "gid", scores: tuple[str, ...] = ("quality_score",)) -> DataFrame:
    """What a summary plot draws: the points of the ``most`` best candidates with the candidate's place and type, to be drawn
    in order of place and time."""
    top = ranked(cands, most, list(scores), group)
    place = F.row_number().over(Window.orderBy(F.coalesce(*scores, F.lit(0.0)).desc(), group))
    top = top.select(group, "candidate_type", place.alias("place"))  # at most ``most`` rows
    return points.join(F.broadcast(top), group).select("place", group, F.coalesce("candidate_type", F.lit("unknown")).alias("candidate_type"), "obs_time", "det_id", "mag", "err")


def frame_positions(points: DataFrame, frames: DataFrame, group: str = "gid") -> DataFrame:
    """(group, stem, x, y): where a light curve's detection lies in each frame, by the stem of the file it came from."""
    own = points.select(group, stem(F.col("source_file")).alias("stem"), "x", "y")
    return frames.select(stem(F.col("path")).alias("stem")).distinct().join(own, "stem").select(group, "stem", "x", "y")

"""Operators on stamps: pixels as a flat array of doubles with a width."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tables import written
from .graph import connected_components


def pixels(stamps: DataFrame, key: str, column: str, width: int) -> DataFrame:
    """(key, py, px, v): the long form, rows and columns from 0."""
    x = stamps.select(key, F.posexplode(column).alias("i", "v"))
    return x.select(key, F.floor(F.col("i") / width).cast("int").alias("py"), (F.col("i") % width).alias("px"), F.col("v").cast("double").alias("v"))


def difference(science: Column, template: Column) -> Column:
    """Pixel by pixel, both aligned; null where the sizes differ."""
    return F.when(F.size(science) == F.size(template), F.zip_with(science, template, lambda a, b: a.cast("double") - b))


def coadd(pix: DataFrame, group: str) -> DataFrame:
    """Mean of each pixel over a group of stamps."""
    return pix.groupBy(group, "py", "px").agg(F.avg("v").alias("v"), F.count("v").alias("n"))


#: Overlaps of less of a pixel than this are rounding.
TOUCH = 1e-12


def _overlap(edges: Column, gx: Column, gy: Column) -> Column:
    """The area of a polygon within a grid pixel, by the areas between its edges (x1, y1 to x2, y2) and the pixel's lower side:
    each edge is held to the pixel's columns, and its mean height there to the pixel's rows."""
    bound = lambda v: F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0))
    local = F.transform(edges, lambda e: F.struct((e["x1"] - gx + 0.5).alias("x1"), (e["y1"] - gy + 0.5).alias("y1"), (e["x2"] - gx + 0.5).alias("x2"), (e["y2"] - gy + 0.5).alias("y2")))
    at = lambda e, x: e["y1"] + (e["y2"] - e["y1"]) * (bound(e[x]) - e["x1"]) / (e["x2"] - e["x1"])
    ends = F.transform(F.filter(local, lambda e: e["x1"] != e["x2"]), lambda e: F.struct((bound(e["x2"]) - bound(e["x1"])).alias("w"), at(e, "x1").alias("a"), at(e, "x2").alias("b")))
    held = F.transform(ends, lambda e: F.struct(e["w"].alias("w"), F.least(e["a"], e["b"]).alias("low"), F.greatest(e["a"], e["b"]).alias("high")))
    rise = lambda e: (bound(e["high"]) - bound(e["low"])) * (bound(e["high"]) + bound(e["low"])) / 2 + F.greatest(e["high"] - F.greatest(e["low"], F.lit(1.0)), F.lit(0.0))
    mean = lambda e: F.when(e["high"] > e["low"], rise(e) / (e["high"] - e["low"])).otherwise(bound(e["low"]))
    return F.abs(F.aggregate(held, F.lit(0.0), lambda acc, e: acc + e["w"] * mean(e)))


def resampled(pix: DataFrame, frames: DataFrame, key: str) -> DataFrame:
    """(key, py, px, v, area): stamps on a common grid; each pixel's flux is dealt by the areas in which it, projected,
    overlaps the grid's pixels, so that the sum of fluxes is kept. ``area`` is how much of a grid pixel is covered.

    ``pix``: key, py, px, v as of ``pixels``. ``frames``: key and a to f, doubles, which place (px, py) at
    (a px + b py + c, d px + e py + f): shift, turn, scale, shear or mirror image. Unknown pixels (null, NaN) give nothing;
    stamps without a frame, or whose frame has no area, have no rows; equal keys in ``frames`` give each its own share.

    A pixel becomes a row for each grid pixel in its bounds, and these are summed with partial sums.
    """
    x = pix.where("v is not null and not isnan(v)").join(frames.select(key, *"abcdef").where("abs(a * e - b * d) > 0"), key)
    at = lambda dx, dy: (F.col("a") * (F.col("px") + dx) + F.col("b") * (F.col("py") + dy) + F.col("c"), F.col("d") * (F.col("px") + dx) + F.col("e") * (F.col("py") + dy) + F.col("f"))
    corners = [at(*c) for c in ((-0.5, -0.5), (0.5, -0.5), (0.5, 0.5), (-0.5, 0.5))]
    edges = [F.struct(p[0].alias("x1"), p[1].alias("y1"), q[0].alias("x2"), q[1].alias("y2")) for p, q in zip(corners, corners[1:] + corners[:1], strict=True)]
    x = x.select(key, "v", F.abs(F.col("a") * F.col("e") - F.col("b") * F.col("d")).alias("whole"), F.array(*edges).alias("edges"))
    along = lambda c: F.explode(F.sequence(F.floor(F.array_min(F.col("edges")[c]) + 0.5), F.floor(F.array_max(F.col("edges")[c]) + 0.5)))
    x = x.withColumn("gx", along("x1")).withColumn("gy", along("y1"))
    x = x.withColumn("area", _overlap(F.col("edges"), F.col("gx"), F.col("gy"))).where(F.col("area") > TOUCH)
    return x.groupBy(key, F.col("gy").alias("py"), F.col("gx").alias("px")).agg(F.sum(F.col("v") * F.col("area") / F.col("whole")).alias("v"), F.sum("area").alias("area"))


def resampled_coadd(pix: DataFrame, frames: DataFrame, key: str, group: str) -> DataFrame:
    """(group, py, px, v, n): the mean of stamps on a common grid (see ``resampled``), weighted by how much of a grid pixel each
    covers; ``n`` stamps reach it. ``frames`` also has the group of each stamp."""
    x = resampled(pix, frames, key).join(frames.select(key, group), key)
    return x.groupBy(group, "py", "px").agg((F.sum("v") / F.sum("area")).alias("v"), F.count(F.lit(1)).alias("n"))


def is_dipole(stamp: Column, width: int, cx: Column, cy: Column, half: int, flux: Column, ratio: float = 0.5) -> Column:
    """Whether the box around (cx, cy) has a trough of ``ratio`` of the source's flux; no trough or no flux: no."""
    rows = F.sequence(F.greatest(cy - half, F.lit(0)), F.least(cy + half, F.lit(width - 1)))
    low, high = F.greatest(cx - half, F.lit(0)), F.least(cx + half, F.lit(width - 1))
    least = F.array_min(F.transform(rows, lambda r: F.array_min(F.slice(stamp, r * width + low + 1, high - low + 1))))
    return F.when((flux <= 0) | (least >= 0), False).otherwise(F.abs(least) / flux >= ratio)


def stretched(stamp: Column, low: Column, high: Column, gamma: float = 1.0) -> Column:
    """Pixels as 0 to 255 between two levels; all 0 where these are equal."""
    span = high - low
    return F.transform(stamp, lambda v: F.when(span > 0, F.bround(255 * F.pow(F.least(F.greatest((v - low) / span, F.lit(0.0)), F.lit(1.0)), F.lit(gamma)))).otherwise(0).cast("int"))


def psf_stamp(sigma: Column | float, half: int) -> Column:
    """A Gaussian of sum 1 as a flat array; ``sigma`` in pixels."""
    side = 2 * half + 1
    raw = F.transform(F.sequence(F.lit(0), F.lit(side * side - 1)), lambda i: F.exp(-(F.pow(F.floor(i / side) - half, 2) + F.pow(i % side - half, 2)) / (2 * sigma * sigma)))
    return F.transform(raw, lambda v: v / F.aggregate(raw, F.lit(0.0), lambda a, b: a + b))


def masked_difference(science: Column, template: Column) -> Column:
    """Pixel by pixel, NaN where either is NaN or null; null where the sizes differ."""
    nan = F.lit(float("nan"))
    one = lambda a, b: F.when(a.isNull() | b.isNull() | F.isnan(a) | F.isnan(b), nan).otherwise(a.cast("double") - b)
    return F.when(F.size(science) == F.size(template), F.zip_with(science, template, one))


#: How differences of aligned stamps are made, by name: (science, template) -> pixels. ``matching.ENGINES`` has those that
#: match point spreads, over tables of pixels.
ENGINES: dict[str, Callable[[Column, Column], Column]] = {"aligned": difference, "masked": masked_difference}


def subtract(engine: str, science: Column, template: Column) -> Column:
    """The difference by the named engine; an unknown name is an error."""
    if engine not in ENGINES:
        raise ValueError(f"engine {engine!r}; known: {', '.join(sorted(ENGINES))}")
    return ENGINES[engine](science, template)


def section(stamp: Column, width: int, x0: Column | int, y0: Column | int, wide: int, high: int) -> Column:
    """The sub-rectangle from (x0, y0) on, ``wide`` by ``high``, as a flat array. Pixels beyond the image are null."""
    x0, y0 = F.lit(x0), F.lit(y0)
    place = F.sequence(F.lit(0), F.lit(wide * high - 1))

    def at(i: Column) -> Column:
        px, py = x0 + i % wide, y0 + F.floor(i / wide).cast("int")
        return F.when((px >= 0) & (px < width) & (py >= 0), F.get(stamp, py * width + px))

    return F.transform(place, at)


def levels(pix: DataFrame, key: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """(key, low, high): the levels to stretch each image between: two percentiles of its finite pixels, or their extremes
    where these are equal. ``pix``: key and v, a row per pixel."""
    v = F.when(~F.isnan("v") & (F.abs("v") < float("inf")), F.col("v"))
    got = pix.groupBy(key).agg(F.percentile(v, F.lit(low)).alias("l"), F.percentile(v, F.lit(high)).alias("h"), F.min(v).alias("a"), F.max(v).alias("b"))
    flat = F.col("l") == F.col("h")
    return got.select(key, F.when(flat, F.col("a")).otherwise(F.col("l")).alias("low"), F.when(flat, F.col("b")).otherwise(F.col("h")).alias("high"))


def merged_header(science: Column, sibling: Column, template: Column, keys: list[str]) -> Column:
    """A difference's header: the science image's, with the named values of the sibling's table where it has them, and TEMPLATE."""
    extra = F.map_filter(sibling, lambda k, v: k.isin(keys) & v.isNotNull())
    named = F.create_map(F.lit("TEMPLATE"), template)
    keep = F.map_filter(science, lambda k, v: ~F.map_contains_key(extra, k) & (k != "TEMPLATE"))
    return F.map_concat(keep, F.map_filter(extra, lambda k, v: k != "TEMPLATE"), named)


def sources(pix: DataFrame, key: str, sigma: float = 5.0, least: int = 5) -> DataFrame:
    """(key, source, n_pixels, flux, peak, x, y, a, b, theta): sources of images given as pixels (key, py, px, v).

    The background is an image's median, its noise 1.4826 times the median deviation; pixels more than ``sigma`` above it
    that touch, also at corners, are a source if there are ``least`` of them. Position and shape are moments weighted
    with what is above the background (pixels from 0; theta in degrees from x to y). Pixels that aren't finite don't
    count. ``source`` is the first pixel, row by row.
    """
    v = F.when(~F.isnan("v") & (F.abs("v") < float("inf")), F.col("v"))
    good = pix.select(key, "py", "px", v.alias("v")).where("v is not null")
    mid = good.groupBy(key).agg(F.percentile("v", F.lit(0.5)).alias("_m"))
    x = good.join(mid, key).withColumn("f", F.col("v") - F.col("_m"))
    noise = x.groupBy(key).agg((1.4826 * F.percentile(F.abs("f"), F.lit(0.5))).alias("_s"))
    bright = written(x.join(noise, key).where(F.col("f") > sigma * F.col("_s")).select(key, "py", "px", "f", F.struct(key, "py", "px").alias("node")), "bright")
    step = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if (dy, dx) > (0, 0)])
    ahead = bright.select(key, F.col("node").alias("a"), "py", "px", F.explode(step).alias("d")).select(key, "a", (F.col("py") + F.col("d.dy")).alias("py"), (F.col("px") + F.col("d.dx")).alias("px"))
    edges = ahead.join(bright.select(key, "py", "px", F.col("node").alias("b")), [key, "py", "px"]).select("a", "b")
    own = bright.join(connected_components(bright.select("node"), edges, "node"), "node")
    total = F.sum("f")
    mean = lambda v: F.sum(F.col("f") * v) / total
    px, py = F.col("px"), F.col("py")
    got = own.groupBy(key, "component").agg(F.count(F.lit(1)).alias("n_pixels"), total.alias("flux"), F.max("f").alias("peak"), mean(px).alias("x"), mean(py).alias("y"), mean(px * px).alias("_xx"), mean(py * py).alias("_yy"), mean(px * py).alias("_xy"))
    xx, yy, xy = F.col("_xx") - F.col("x") * F.col("x"), F.col("_yy") - F.col("y") * F.col("y"), F.col("_xy") - F.col("x") * F.col("y")
    spread = F.sqrt(F.pow((xx - yy) / 2, 2) + xy * xy)
    size = lambda sign: F.sqrt(F.greatest((xx + yy) / 2 + sign * spread, F.lit(0.0)))
    out = got.where(F.col("n_pixels") >= least)
    return out.select(key, F.struct("component.py", "component.px").alias("source"), "n_pixels", "flux", "peak", "x", "y", size(1).alias("a"), size(-1).alias("b"), (F.degrees(F.atan2(2 * xy, xx - yy)) / 2).alias("theta"))


def zscale(values: np.ndarray, contrast: float = 0.25, samples: int = 1000, reject: float = 0.5, least: int = 5, clip: float = 2.5, rounds: int = 5) -> tuple[float, float] | None:
    """The display levels of the z-scale method: a line is fitted through the sorted sample of pixels, outliers and their
    neighbours are left out in rounds, and its slope over ``contrast`` gives the levels around the median. None without
    finite pixels or where too few are left."""
    v = values[np.isfinite(values)]
    if not len(v):
        return None
    v = np.sort(v[:: max(1, len(v) // samples)][:samples])
    n = len(v)
    place, good, enough = np.arange(n), np.ones(n, bool), max(least, int(n * reject))
    grow, before, slope = max(1, int(n * 0.01)), n + 1, 0.0
    for _ in range(rounds):
        if not enough <= good.sum() < before:
            break
        before = good.sum()
        slope, level = np.polyfit(place[good], v[good], 1)
        off = v - level - slope * place
        bad = ~good | (np.abs(off) > clip * off[good].std())
        good = np.convolve(bad, np.ones(grow), "same") < 0.5
    if good.sum() < enough:
        return None
    centre, step, mid = (n - 1) // 2, slope / contrast, float(np.median(v))
    return max(float(v[0]), mid - (centre - 1) * step), min(float(v[-1]), mid + (n - centre) * step)


def display_levels(stamps: DataFrame, key: str, column: str) -> DataFrame:
    """(key, low, high) to stretch each image between: by z-scale, else the 1st and 99th percentile of its finite pixels, else
    their extremes; null without any. An image is one row of one task."""
    kind = stamps.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, p in zip(b[key], b["p"], strict=True):
                v = np.array([], float) if p is None else np.asarray(p, float)
                v = v[np.isfinite(v)]
                pair = zscale(v)
                if pair is None or not pair[0] < pair[1]:
                    pair = tuple(np.percentile(v, (1, 99))) if len(v) else (None, None)
                if len(v) and not pair[0] < pair[1]:
                    pair = (float(v.min()), float(v.max()))
                rows.append((k, *pair))
            yield pd.DataFrame(rows, columns=[key, "low", "high"])

    return stamps.select(key, F.col(column).alias("p")).mapInPandas(run, f"{key} {kind}, low double, high double")

"""Joins by distance, planned as equi-joins on cells.

A plain distance predicate plans as a nested loop. Here one side carries the cell that it lies in, the other is exploded
over the cells that its reach touches, and the exact predicate follows the equi-join. Cells are wider than twice the
largest radius, so that a row touches two along each axis at most, and a pair meets exactly once. Spark sizes an exploded
table as if it weren't; the joins are marked to be sorted, so that it isn't broadcast through the driver. On the sky, cells
cut unit vectors, so neither the 0/360 seam nor the poles need care.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import unit_vector
from ..functions.tables import written

PIXEL, SKY = ("x", "y"), ("ra", "dec")
#: Width of a cell in radii. Wider cells mean fewer copies of the exploded side and more pairs to look at.
WIDTH = 2.5


def _keyed(df: DataFrame, on: tuple[str, str], cell: float, sky: bool, reach: float | None, prefix: str) -> DataFrame:
    axes = unit_vector(F.col(on[0]), F.col(on[1])) if sky else (F.col(on[0]), F.col(on[1]))
    names = [f"{prefix}{k}" for k in range(len(axes))]
    out = df.withColumns(dict(zip(names, axes, strict=True)))
    at = lambda v: F.floor(v / F.lit(cell))
    if reach is None:
        return out.withColumns({f"cell{k}": at(F.col(n)) for k, n in enumerate(names)})
    for k, n in enumerate(names):
        v = F.col(n)
        pad = F.lit(reach * (1 + 1e-9)) + F.abs(v) * 1e-15  # more than rounding takes off a distance
        out = out.withColumn(f"cell{k}", F.explode(F.sequence(at(v - pad), at(v + pad))))
    return out


def _cells(left: DataFrame, right: DataFrame, radius: float, system: str, left_on: tuple[str, str] | None, right_on: tuple[str, str] | None) -> tuple[DataFrame, DataFrame, list[str], Column]:
    """Both sides with their cells, the cells' names, and the distance over the joined columns."""
    if system not in ("pixel", "sky"):
        raise ValueError(f"system {system!r}")
    sky = system == "sky"
    left_on, right_on = left_on or (SKY if sky else PIXEL), right_on or (SKY if sky else PIXEL)
    reach = 2 * math.sin(math.radians(radius / 3600) / 2) if sky else radius
    cell = max(reach * WIDTH, 1e-9 if sky else 1e-3)
    a, b = _keyed(left, left_on, cell, sky, None, "_l"), _keyed(right, right_on, cell, sky, reach, "_r")
    n = 3 if sky else 2
    square = sum(((F.col(f"_l{k}") - F.col(f"_r{k}")) * (F.col(f"_l{k}") - F.col(f"_r{k}")) for k in range(n)), F.lit(0.0))
    dist = F.degrees(2 * F.asin(F.least(F.lit(1.0), F.sqrt(square) / 2))) * 3600 if sky else F.sqrt(square)
    return a, b.hint("merge"), [f"cell{k}" for k in range(n)], dist


def _bare(df: DataFrame) -> DataFrame:
    return df.drop(*[f"cell{k}" for k in range(3)], *[f"_{s}{k}" for s in "lr" for k in range(3)])


def radius_join(left: DataFrame, right: DataFrame, radius: float, system: str = "pixel", left_on: tuple[str, str] | None = None, right_on: tuple[str, str] | None = None, by: tuple[str, ...] = (), row_radius: Column | None = None, strict: bool = False) -> DataFrame:
    """Pairs within ``radius`` (pixels, or arcsec on the sky) with ``dist`` in the same unit.

    ``by``: further equal columns. ``row_radius``: a narrower radius over the joined columns. Columns of both sides must
    have different names, but for ``by``. Pass the smaller side as ``right``: it is the one exploded.
    """
    a, b, cells, dist = _cells(left, right, radius, system, left_on, right_on)
    limit = F.lit(float(radius)) if row_radius is None else F.least(F.lit(float(radius)), row_radius)
    joined = a.join(b, [*by, *cells]).withColumn("dist", dist)
    return _bare(joined.where(F.col("dist") < limit if strict else F.col("dist") <= limit))


def radius_anti(left: DataFrame, right: DataFrame, radius: float, system: str = "pixel", left_on: tuple[str, str] | None = None, right_on: tuple[str, str] | None = None, by: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """The rows of ``left`` with nothing of ``right`` within the radius: one anti-join on cells, with the distance as its
    further condition, so that pairs are never made. Only positions and ``by`` of ``right`` are read."""
    on = right_on or (SKY if system == "sky" else PIXEL)
    other = right.select(*[F.col(c).alias(f"_p{k}") for k, c in enumerate(on)], *[F.col(c).alias(f"_b{k}") for k, c in enumerate(by)])
    a, b, cells, dist = _cells(left, other, radius, system, left_on, ("_p0", "_p1"))
    b = b.withColumnsRenamed({c: f"_{c}" for c in cells})
    same = [F.col(c) == F.col(f"_{c}") for c in cells] + [F.col(c) == F.col(f"_b{k}") for k, c in enumerate(by)]
    return _bare(a.join(b, [*same, dist < radius if strict else dist <= radius], "left_anti"))


def self_pairs(df: DataFrame, radius: float, key: str, carry: tuple[str, ...] = (), system: str = "pixel", on: tuple[str, str] | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Pairs (key, key2) of one table, key < key2, with ``dist`` and the columns of ``carry`` of both (the second's end in 2)."""
    on = on or (SKY if system == "sky" else PIXEL)
    a = df.select(key, *on, *by, *carry)
    b = df.select(F.col(key).alias(f"{key}2"), *[F.col(c).alias(f"{c}2") for c in (*on, *carry)], *by)
    out = radius_join(a, b, radius, system, on, (f"{on[0]}2", f"{on[1]}2"), by)
    return out.where(F.col(key) < F.col(f"{key}2")).select(*by, key, f"{key}2", *carry, *[f"{c}2" for c in carry], "dist")


def nearest(left: DataFrame, right: DataFrame, radius: float, key: str, right_key: str, **how) -> DataFrame:
    """Each left row's nearest right row within the radius; the smaller right key where two are as near. Minima are partial,
    so that the pairs of a dense field aren't shuffled."""
    pairs = radius_join(left, right, radius, **how)
    rest = [c for c in pairs.columns if c not in (key, "dist", right_key)]
    best = pairs.groupBy(key).agg(F.min(F.struct("dist", right_key, *rest)).alias("_best"))
    return best.select(key, *[F.col("_best").getField(c).alias(c) for c in ("dist", right_key, *rest)])


def _extent(left: DataFrame, right: DataFrame, system: str, left_on: tuple[str, str] | None, right_on: tuple[str, str] | None) -> float:
    """A radius that no pair is beyond: half the sky, or the diagonal of what both sides cover. One row comes to the driver."""
    if system == "sky":
        return 180 * 3600.0
    both = left.select(*[F.col(c).cast("double").alias(f"v{k}") for k, c in enumerate(left_on or PIXEL)]).union(right.select(*[F.col(c).cast("double") for c in right_on or PIXEL]))
    finite = lambda c: F.abs(c) < float("inf")
    got = both.where(finite("v0") & finite("v1")).agg(*[f(f"v{k}").alias(f"{n}{k}") for k in (0, 1) for n, f in (("a", F.min), ("b", F.max))]).first()
    return math.hypot(got["b0"] - got["a0"], got["b1"] - got["a1"]) * (1 + 1e-9) + 1e-9 if got["a0"] is not None else 0.0


def nearest_any(left: DataFrame, right: DataFrame, first_radius: float, key: str, right_key: str, system: str = "pixel", left_on: tuple[str, str] | None = None, right_on: tuple[str, str] | None = None) -> DataFrame:
    """Each left row's nearest right row, however far, with ``dist``; the smaller right key where two are as near.

    Right cells form a pyramid, each level twice as wide as the one before. A left cell starts a level above the first that
    holds something where it lies, which bounds its distance, and goes down two levels at a time: of the cells below those
    that it holds, it keeps the ones that may be as near as the nearest surely is, judged by the bounds of the rows in both. So a left cell far from all of the right
    side keeps a few cells of the near edge, not all within its distance, and the number of jobs grows with the logarithm
    of the distances. Rows meet at the end, by left cell. Rows without a finite position aren't found and find nothing;
    without any right row there is no row.
    """
    sky = system == "sky"
    n = 3 if sky else 2
    left_on, right_on = left_on or (SKY if sky else PIXEL), right_on or (SKY if sky else PIXEL)
    size = 2 * math.sin(math.radians(min(first_radius, 180 * 3600.0) / 3600) / 2) if sky else first_radius
    most = 2.0 if sky else _extent(left, right, system, left_on, right_on)
    top = max(0, math.ceil(math.log2(max(most / size, 1.0)))) + 1  # here the cells beside a cell hold all
    own, names = [f"o{k}" for k in range(n)], [f"c{k}" for k in range(n)]

    def placed(df: DataFrame, on: tuple[str, str], prefix: str, cells: list[str]) -> DataFrame:
        finite = [~F.isnan(c) & (F.abs(c) < float("inf")) for c in on]
        axes = unit_vector(F.col(on[0]), F.col(on[1])) if sky else (F.col(on[0]).cast("double"), F.col(on[1]).cast("double"))
        out = df.where(finite[0] & finite[1]).withColumns({f"{prefix}{k}": v for k, v in enumerate(axes)})
        return out.withColumns({c: F.floor(F.col(f"{prefix}{k}") / F.lit(size)) for k, c in enumerate(cells)})

    def bounded(df: DataFrame, cells: list[str], low: list[Column], high: list[Column], prefix: str) -> DataFrame:
        """The bounds, in cells of level 0, of the rows of each cell."""
        ends = [F.min(v).alias(f"{prefix}low{k}") for k, v in enumerate(low)] + [F.max(v).alias(f"{prefix}high{k}") for k, v in enumerate(high)]
        return df.groupBy(*cells).agg(*ends)

    def nearer(df: DataFrame, low: list[Column], high: list[Column]) -> DataFrame:
        """Per left cell, the boxes (bounds in cells of level 0) that may be as near to one of its rows as another surely is.

        That other is the box whose far end is nearest. A box goes if for all rows in the left bounds all of it is farther off:
        the least difference of the squared distances is a sum over the axes, and on an axis it is at one of five places."""
        ours = [(F.col(f"_llow{k}"), F.col(f"_lhigh{k}")) for k in range(n)]
        far = [F.greatest(b - p, q - a) for (p, q), a, b in zip(ours, low, high, strict=True)]
        box = [v.alias(f"{c}{k}") for c, vs in (("low", low), ("high", high)) for k, v in enumerate(vs)]
        best = F.struct(F.sqrt(sum((v * v for v in far), F.lit(0.0))).alias("most"), *box)
        x = df.withColumn("_best", F.min(best).over(Window.partitionBy(*own)))
        least = F.lit(0.0)
        for k, ((p, q), a, b) in enumerate(zip(ours, low, high, strict=True)):
            c, d = F.col(f"_best.low{k}"), F.col(f"_best.high{k}")
            at = [p, q, *[F.least(F.greatest(v, p), q) for v in (a, b, (c + d) / 2)]]
            near, most = [F.greatest(F.lit(0.0), a - v, v - b) for v in at], [F.greatest(v - c, d - v) for v in at]
            least = least + F.least(*[v * v - w * w for v, w in zip(near, most, strict=True)])
        most = F.col("_best.most")
        return x.where(least <= most * most * 1e-12 + (most + 1) * 2e-6).drop("_best")

    higher = lambda cells, by: [F.expr(f"shiftright({c}, {by})").alias(f"c{k}") for k, c in enumerate(cells)]
    every = F.explode(F.sequence(F.lit(0), F.lit(top))).alias("level")
    a, b = placed(left, left_on, "_l", own), placed(right, right_on, "_r", names)
    inside = lambda side: [F.col(f"_{side}{k}") / F.lit(size) for k in range(n)]
    ends = lambda side: [f"_{side}{e}{k}" for e in ("low", "high") for k in range(n)]
    leaves = bounded(b, names, inside("r"), inside("r"), "_r").select(*ends("r"), *names, every).select("level", *higher(names, "level"), *ends("r"))
    low, high = ([F.col(c) for c in ends("r")[i : i + n]] for i in (0, n))
    tree = written(bounded(leaves, ["level", *names], low, high, "_r"), "tree")
    asked = written(bounded(a, own, inside("l"), inside("l"), "_l"), "asked")
    met = asked.select(*own, every).select(*own, "level", *higher(own, "level")).join(tree.hint("merge"), ["level", *names], "left_semi")
    first = met.groupBy(*own).agg(F.min("level").alias("level"))
    begin = asked.join(first.hint("merge"), own, "left").select(*own, *ends("l"), F.least(F.coalesce("level", F.lit(top)) + 1, F.lit(top)).alias("level"))
    begin = begin.select(*own, *ends("l"), "level", *higher(own, "level"))
    for c in names:
        begin = begin.withColumn(c, F.explode(F.array(*[F.col(c) + d for d in (-1, 0, 1)])))
    held = written(begin.join(tree.hint("merge"), ["level", *names]).select(*own, *ends("l"), "level", *names), "held")

    below = [tree.select((F.col("level") + 2).alias("_up"), *[F.expr(f"shiftright({c}, 2)").alias(f"_{c}") for c in names], "level", *names, *ends("r"))]
    below.append(tree.where("level = 0").select(F.lit(1).alias("_up"), *[F.expr(f"shiftright({c}, 1)").alias(f"_{c}") for c in names], "level", *names, *ends("r")))
    below = below[0].unionByName(below[1]).hint("merge")
    settled = held.where("level = 0")
    for _ in range((held.agg(F.max("level")).first()[0] or 0) + 1 >> 1):  # one number
        up = held.where("level > 0").select(*own, *ends("l"), F.col("level").alias("_up"), *[F.col(c).alias(f"_{c}") for c in names])
        x = up.join(below, ["_up", *[f"_{c}" for c in names]])
        held = written(nearer(x, low, high).select(*own, *ends("l"), "level", *names), "held")
        settled = settled.unionByName(held.where("level = 0"))

    y = nearer(settled.drop("level").join(b.hint("merge"), names), inside("r"), inside("r")).drop(*names, *ends("l"))
    square = sum(((F.col(f"_l{k}") - F.col(f"_r{k}")) * (F.col(f"_l{k}") - F.col(f"_r{k}")) for k in range(n)), F.lit(0.0))
    dist = F.degrees(2 * F.asin(F.least(F.lit(1.0), F.sqrt(square) / 2))) * 3600 if sky else F.sqrt(square)
    pairs = a.join(y.hint("merge"), own).withColumn("dist", dist).drop(*own, *[f"_{s}{k}" for s in "lr" for k in range(n)])
    rest = [c for c in pairs.columns if c not in (key, "dist", right_key)]
    best = pairs.groupBy(key).agg(F.min(F.struct("dist", right_key, *rest)).alias("_best"))
    return best.select(key, *[F.col("_best").getField(c).alias(c) for c in ("dist", right_key, *rest)])


def image_matches(cands: DataFrame, det: DataFrame, radius: float = 5.0, key: str = "cand_id") -> DataFrame:
    """(key, epoch_id, det_ids): the detections of every exposure within ``radius`` pixels of a candidate, sorted; exposures
    without one have no row. ``cands``: key, cx, cy; ``det``: det_id, epoch_id, x, y."""
    pairs = radius_join(det.select("det_id", "epoch_id", "x", "y"), cands.select(key, "cx", "cy"), radius, right_on=("cx", "cy"))
    return pairs.groupBy(key, "epoch_id").agg(F.sort_array(F.collect_list("det_id")).alias("det_ids"))


def field_ranges(ra: float, dec: float, width: float, height: float) -> tuple[list[tuple[float, float]], tuple[float, float]]:
    """Ranges of right ascension and the range of declination of the box around the circle through a field's corners
    (degrees): two of the former where it crosses 0/360, all of the circle where it is wider than that."""
    reach = math.hypot(width, height) / 2
    across = reach / max(math.cos(math.radians(dec)), 0.01)
    low, high = ra - across, ra + across
    if across >= 180:
        ranges = [(-math.inf, math.inf)]
    elif low < 0:
        ranges = [(low + 360, math.inf), (-math.inf, high)]
    elif high > 360:
        ranges = [(low, math.inf), (-math.inf, high - 360)]
    else:
        ranges = [(low, high)]
    return ranges, (dec - reach, dec + reach)


def region(df: DataFrame, ra: float, dec: float, width: float, height: float, on: tuple[str, str] = SKY) -> DataFrame:
    """The rows in a field's box (see ``field_ranges``). Plain comparisons, so that they reach a Parquet scan."""
    ranges, (bottom, top) = field_ranges(ra, dec, width, height)
    inside = F.lit(False)
    for low, high in ranges:
        own = [F.col(on[0]) >= low] * (low > -math.inf) + [F.col(on[0]) <= high] * (high < math.inf)
        inside = inside | (own[0] & own[1] if len(own) == 2 else own[0] if own else F.col(on[0]).isNotNull())
    return df.where(inside & F.col(on[1]).between(bottom, top))

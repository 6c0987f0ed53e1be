"""Detection on images given as pixels (key, py, px, v): background mesh, deblending by flux contrast, apertures.

``images.sources`` takes one background and one threshold for an image and leaves blends whole; here the background follows a
mesh, touching sources are split where enough of their flux stands apart at a higher threshold, and fluxes are measured in
circles that cut pixels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tables import bounded_batches, spread, written
from .graph import connected_components

STEP = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if (dy, dx) > (0, 0)]


def background_mesh(pix: DataFrame, key: str, cell: int = 64, clip: float = 3.0, rounds: int = 5) -> DataFrame:
    """(key, cy, cx, level, noise): per mesh cell the median and deviation of its finite pixels, those off by more than ``clip``
    deviations left out in rounds. A cell without any has no row. One shuffle; a group is one cell's pixels."""
    kind = pix.schema[key].dataType.simpleString()
    good = pix.where(~F.isnan("v") & (F.abs("v") < float("inf")))
    at = lambda c: F.floor(F.col(c) / cell).cast("int")
    cells = good.groupBy(key, at("py").alias("cy"), at("px").alias("cx")).agg(F.collect_list(F.col("v").cast("double")).alias("p"))

    def clipped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for name, cy, cx, p in b.itertuples(index=False):
                v = np.asarray(p)
                for _ in range(rounds):
                    near = v[np.abs(v - np.median(v)) <= clip * v.std()]
                    if len(near) in (0, len(v)):
                        break
                    v = near
                rows.append((name, cy, cx, float(np.median(v)), float(v.std())))
            yield pd.DataFrame(rows, columns=[key, "cy", "cx", "level", "noise"])

    return cells.mapInPandas(clipped, f"{key} {kind}, cy int, cx int, level double, noise double")


def without_background(pix: DataFrame, mesh: DataFrame, key: str, cell: int = 64) -> DataFrame:
    """(key, py, px, f, noise): pixels less the mesh's levels, by bicubic convolution between cell centres, the outer cells
    repeated beyond the edges. Cells that are missing take the median of the image's. An image's mesh is one row of a task;
    images are dealt to all tasks, and a batch of them leaves as one."""
    bounded_batches(pix.sparkSession)
    kind = mesh.schema[key].dataType.simpleString()
    whole = mesh.groupBy(key).agg(F.collect_list(F.struct("cy", "cx", "level", "noise")).alias("m"))
    size = pix.groupBy(key).agg((F.floor(F.max("py") / cell) + 1).cast("int").alias("ny"), (F.floor(F.max("px") / cell) + 1).cast("int").alias("nx"))

    def corners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = []
            for row in b.itertuples(index=False):
                values = np.array([(p["level"], p["noise"]) for p in row.m])
                grid = np.tile(np.median(values, axis=0), (row.ny, row.nx, 1))
                for p, v in zip(row.m, values, strict=True):
                    grid[p["cy"], p["cx"]] = v
                i, j = (a.ravel() for a in np.mgrid[-1 : row.ny, -1 : row.nx])
                near = np.arange(-1, 3)
                block = grid[np.clip(i[:, None] + near, 0, row.ny - 1)[:, :, None], np.clip(j[:, None] + near, 0, row.nx - 1)[:, None, :]]
                parts.append(([row[0]] * len(i), i, j, block[..., 0].reshape(len(i), 16), block[..., 1].reshape(len(i), 16)))
            if parts:
                names, *held = zip(*parts, strict=True)
                i, j, level, noise = (np.concatenate(p) for p in held)
                yield pd.DataFrame({key: [k for n in names for k in n], "_i": i, "_j": j, "_l": list(level), "_n": list(noise)})

    table = spread(whole.join(size, key)).mapInPandas(corners, f"{key} {kind}, _i int, _j int, _l array<double>, _n array<double>")
    u = lambda c: (F.col(c) + 0.5) / cell - 0.5
    x = pix.withColumns({"_i": F.floor(u("py")).cast("int"), "_j": F.floor(u("px")).cast("int")})
    x = spread(x, key, "_i", "_j").join(spread(table, key, "_i", "_j"), [key, "_i", "_j"])

    def weights(t: Column) -> list[Column]:
        return [((-0.5 * t + 1) * t - 0.5) * t, (1.5 * t - 2.5) * t * t + 1, ((-1.5 * t + 2) * t + 0.5) * t, (0.5 * t - 0.5) * t * t]

    wy, wx = weights(u("py") - F.col("_i")), weights(u("px") - F.col("_j"))
    blend = lambda c: sum((wy[a] * wx[b] * F.get(c, F.lit(4 * a + b)) for a in range(4) for b in range(4)), F.lit(0.0))
    return x.select(key, "py", "px", (F.col("v").cast("double") - blend("_l")).alias("f"), F.greatest(blend("_n"), F.lit(0.0)).alias("noise"))


def split_tree(nodes: list[tuple], contrast: float) -> list:
    """The objects of one source from its components at all levels (component, parent, flux above the own level), the root's
    parent being None: a node whose flux parts into two children or more, each with over ``contrast`` of the root's, is
    parted; what isn't parted anywhere above is one object, its lowest node."""
    kids: dict = {}
    for c, parent, flux in nodes:
        kids.setdefault(parent, []).append((c, flux))
    ((root, total),) = kids[None]
    out, todo = [], [(root, root)]
    while todo:  # (lowest node of what may be one object, how far it was followed)
        low, at = todo.pop()
        big = [c for c, flux in kids.get(at, []) if flux > contrast * total]
        if len(big) > 1:
            todo += [(c, c) for c in big]
        elif big:
            todo.append((low, big[0]))
        else:
            out.append(low)
    return out


def deblended(pix: DataFrame, key: str, sigma: float = 3.0, least: int = 5, levels: int = 16, contrast: float = 0.005) -> DataFrame:
    """(key, source, object, n_pixels, flux, peak, x, y, a, b, theta) from pixels (key, py, px, f, noise) without background.

    Pixels over ``sigma`` noises that touch, also at corners, are a source if there are ``least`` of them. Its thresholds are
    ``levels`` steps, even in the logarithm, from its lowest pixel to its peak; the components above each make a tree,
    which ``split_tree`` parts. A parted source's pixels go to the object whose node has them, the others to the object
    whose Gaussian, by its node's peak and moments, is highest there. ``source`` is the source's first pixel, row by row,
    ``object`` the first of the object's node; a source that isn't parted is one object. An image without sources has no rows.

    Scale: components of all levels are found at once; the tree of a source, a row for each component, is one group. Tables
    of pixels take few bytes on disk and many in memory, so their joins are sorted, never broadcast.
    """
    good = F.abs("f") < float("inf")
    bright = written(pix.where(good & (F.col("f") > sigma * F.col("noise")) & (F.col("f") > 0)).select(key, "py", "px", "f", F.struct(key, "py", "px").alias("node")), "bright")
    step = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in STEP])
    ahead = bright.select(key, F.col("node").alias("a"), F.col("f").alias("fa"), "py", "px", F.explode(step).alias("d")).select(key, "a", "fa", (F.col("py") + F.col("d.dy")).alias("py"), (F.col("px") + F.col("d.dx")).alias("px"))
    edges = written(ahead.join(bright.select(key, "py", "px", F.col("node").alias("b"), F.col("f").alias("fb")).hint("merge"), [key, "py", "px"]).select("a", "b", F.least("fa", "fb").alias("f")), "touching")
    own = bright.join(connected_components(bright.select("node"), edges, "node").hint("merge"), "node").withColumnRenamed("component", "root")
    size = own.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.min("f").alias("low"), F.max("f").alias("high")).where(F.col("n") >= least)
    own = written(own.join(size.select("root", "low", "high").hint("merge"), "root"), "sources")

    threshold = F.col("low") * F.pow(F.col("high") / F.col("low"), F.col("level") / F.lit(float(levels)))
    ladder = F.explode(F.sequence(F.lit(1), F.lit(levels - 1))).alias("level")
    at = lambda c: F.struct("level", f"{c}.{key}", f"{c}.py", f"{c}.px")
    above = own.select("*", ladder).withColumn("t", threshold).where(F.col("f") > F.col("t")).withColumn("at", at("node"))
    joint = edges.join(own.select(F.col("node").alias("a"), "low", "high").hint("merge"), "a").select("a", "b", "f", "low", "high", ladder).where(F.col("f") > threshold)
    comp = connected_components(above.select("at"), joint.select(at("a").alias("a"), at("b").alias("b")), "at")
    above = written(above.join(comp.hint("merge"), "at").select("root", "node", "level", "component", (F.col("f") - F.col("t")).alias("over"), "f"), "above")
    under = above.select("node", (F.col("level") + 1).alias("level"), F.col("component").alias("parent"))
    nodes = above.join(under.hint("merge"), ["node", "level"], "left").groupBy("root", "component").agg(F.first("parent").alias("parent"), F.sum("over").alias("flux"))
    base = own.groupBy("root").agg(F.sum(F.col("f") - F.col("low")).alias("flux"))
    name = lambda c: F.when(F.col(c).isNotNull(), F.concat_ws(":", *[F.col(f"{c}.{k}").cast("string") for k in ("level", "py", "px")]))
    start = F.lit("0")
    tree = nodes.select("root", name("component").alias("c"), F.coalesce(name("parent"), start).alias("parent"), "flux").unionByName(base.select("root", start.alias("c"), F.lit(None).cast("string").alias("parent"), "flux"))
    trees = tree.groupBy("root").agg(F.collect_list(F.struct("c", "parent", "flux")).alias("nodes"))
    kind = trees.schema["root"].dataType.simpleString()

    def parted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [split_tree([(n["c"], n["parent"], n["flux"]) for n in row], contrast) for row in b["nodes"]]
            yield pd.DataFrame({"root": b["root"], "objects": out})

    parts = written(trees.mapInPandas(parted, f"root {kind}, objects array<string>"), "objects")
    several = parts.where(F.size("objects") > 1).select("root", F.explode("objects").alias("c"))
    held = written(above.withColumn("c", name("component")).join(several.hint("merge"), ["root", "c"]).select("root", "c", "node", "f"), "held")
    f, py, px = F.col("f"), F.col("node.py"), F.col("node.px")
    mean = lambda v: F.sum(f * v) / F.sum(f)
    shape = held.groupBy("root", "c").agg(F.min("node").alias("object"), F.max("f").alias("top"), mean(px).alias("ox"), mean(py).alias("oy"), mean(px * px + py * py).alias("q"))
    spread = F.greatest((F.col("q") - F.col("ox") * F.col("ox") - F.col("oy") * F.col("oy")) / 2, F.lit(0.5))
    shape = written(shape.withColumn("s", spread), "shapes")
    rest = own.join(shape.hint("merge"), "root").join(held.select("node").hint("merge"), "node", "left_anti")
    far = F.pow(F.col("px") - F.col("ox"), 2) + F.pow(F.col("py") - F.col("oy"), 2)
    taken = rest.groupBy("node").agg(F.max(F.struct((F.log("top") - far / (2 * F.col("s"))).alias("w"), "object")).alias("m")).select("node", F.col("m.object").alias("object"))
    owner = taken.unionByName(held.join(shape.select("root", "c", "object").hint("merge"), ["root", "c"]).select("node", "object"))
    x = own.join(owner.hint("merge"), "node", "left").withColumn("object", F.coalesce("object", "root"))

    got = x.groupBy(key, "root", "object").agg(F.count(F.lit(1)).alias("n_pixels"), F.sum("f").alias("flux"), F.max("f").alias("peak"), mean(F.col("px")).alias("x"), mean(F.col("py")).alias("y"), mean(F.col("px") * F.col("px")).alias("_xx"), mean(F.col("py") * F.col("py")).alias("_yy"), mean(F.col("px") * F.col("py")).alias("_xy"))
    xx, yy, xy = F.col("_xx") - F.col("x") * F.col("x"), F.col("_yy") - F.col("y") * F.col("y"), F.col("_xy") - F.col("x") * F.col("y")
    wide = F.sqrt(F.pow((xx - yy) / 2, 2) + xy * xy)
    axis = lambda sign: F.sqrt(F.greatest((xx + yy) / 2 + sign * wide, F.lit(0.0)))
    place = lambda c: F.struct(f"{c}.py", f"{c}.px").alias("source" if c == "root" else c)
    return got.select(key, place("root"), place("object"), "n_pixels", "flux", "peak", "x", "y", axis(1).alias("a"), axis(-1).alias("b"), (F.degrees(F.atan2(2 * xy, xx - yy)) / 2).alias("theta"))


def apertures(objects: DataFrame, pix: DataFrame, key: str, object_key: str, radius: float, grid: int = 5) -> DataFrame:
    """(key, object_key, aperture_flux, area): the sum of pixels (key, py, px, f) in the circle around each object (x, y), each by
    the share of its ``grid`` x ``grid`` sub-pixels whose centres lie inside. An equi-join on blocks as wide as the circle."""
    wide = 2 * radius + 1
    block = lambda c: F.floor(F.col(c) / wide)
    o = objects.select(key, object_key, "x", "y").withColumns({"_by": F.explode(F.array(*[block("y") + d for d in (-1, 0, 1)]))})
    o = o.withColumn("_bx", F.explode(F.array(*[block("x") + d for d in (-1, 0, 1)])))
    p = pix.select(key, "py", "px", "f").withColumns({"_by": block("py"), "_bx": block("px")})
    near = spread(o, key, "_by", "_bx").join(spread(p, key, "_by", "_bx"), [key, "_by", "_bx"]).where((F.abs(F.col("px") - F.col("x")) <= radius + 0.5) & (F.abs(F.col("py") - F.col("y")) <= radius + 0.5))
    offsets = [(k + 0.5) / grid - 0.5 for k in range(grid)]
    inside = [F.when(F.pow(F.col("px") + dx - F.col("x"), 2) + F.pow(F.col("py") + dy - F.col("y"), 2) <= radius * radius, 1.0).otherwise(0.0) for dy in offsets for dx in offsets]
    share = sum(inside, F.lit(0.0)) / (grid * grid)
    return near.withColumn("_w", share).where("_w > 0").groupBy(key, object_key).agg(F.sum(F.col("_w") * F.col("f")).alias("aperture_flux"), F.sum("_w").alias("area"))

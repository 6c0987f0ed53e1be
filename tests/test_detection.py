"""Background, blends and apertures against planted images and plain loops."""

import math

import numpy as np
import pytest

from duskfield.operators import detection


def rows(key, image):
    return [(key, int(y), int(x), float(v)) for (y, x), v in np.ndenumerate(image)]


def star(shape, x, y, flux, s):
    py, px = np.mgrid[: shape[0], : shape[1]]
    return flux / (2 * math.pi * s * s) * np.exp(-((px - x) ** 2 + (py - y) ** 2) / (2 * s * s))


def test_background_follows_the_image(spark):
    """A tilted, curved sky with stars on it is taken off to a part of the noise; a cell without pixels is filled."""
    rng = np.random.default_rng(1)
    y, x = np.mgrid[:96, :128]
    sky = 100 + 0.2 * x + 0.1 * y + 0.001 * (x - 60) ** 2
    image = sky + rng.normal(0, 1.5, sky.shape) + star(sky.shape, 40, 30, 4000, 2) + star(sky.shape, 90, 70, 9000, 2)
    image[64:80, 112:128] = np.nan
    pix = spark.createDataFrame(rows(1, image) + rows(2, np.full((20, 20), 7.0)), "img long, py int, px int, v double")
    mesh = detection.background_mesh(pix, "img", 16)
    assert mesh.count() == 48 - 1 + 4
    got = detection.without_background(pix, mesh, "img", 16).toPandas()
    one = got[got["img"] == 1].sort_values(["py", "px"])
    assert len(got) == 96 * 128 + 400 and np.abs(got[got["img"] == 2]["f"]).max() == 0
    off = (image - one["f"].to_numpy().reshape(image.shape) - sky)[8:48, 8:-16]
    assert np.nanmax(np.abs(off)) < 2 and abs(np.nanmedian(one["noise"]) - 1.5) < 0.4


def brute_blends(image, thr, least, levels, contrast):
    """Objects by flood fill at every threshold, and pixels by the highest Gaussian."""

    def components(pixels):
        pixels, out = set(pixels), []
        while pixels:
            todo, own = [min(pixels)], set()
            while todo:
                p = todo.pop()
                if p in pixels:
                    pixels.discard(p)
                    own.add(p)
                    todo += [(p[0] + dy, p[1] + dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]
            out.append(own)
        return out

    found = {}
    for src in components(p for p, v in np.ndenumerate(image) if v > thr):
        if len(src) < least:
            continue
        low, high = min(image[p] for p in src), max(image[p] for p in src)
        t = [low * (high / low) ** (k / levels) for k in range(levels)]
        total = sum(image[p] - low for p in src)

        def objects(own, k, bottom):
            kids = [c for c in components(p for p in own if image[p] > t[k + 1])] if k + 1 < levels else []  # noqa: B023
            big = [c for c in kids if sum(image[p] - t[k + 1] for p in c) > contrast * total]  # noqa: B023
            if len(big) > 1:
                return [o for c in big for o in objects(c, k + 1, c)]  # noqa: B023
            return objects(big[0], k + 1, bottom) if big else [bottom]  # noqa: B023

        parts = objects(src, 0, src)
        if len(parts) == 1:
            found[min(src), min(src)] = (len(src), sum(image[p] for p in src))
            continue
        shapes = []
        for o in parts:
            f = sum(image[p] for p in o)
            cy, cx = (sum(image[p] * p[k] for p in o) / f for k in (0, 1))
            q = sum(image[p] * (p[0] ** 2 + p[1] ** 2) for p in o) / f
            shapes.append((min(o), o, max(image[p] for p in o), cy, cx, max((q - cx * cx - cy * cy) / 2, 0.5)))
        owner = {p: next((s[0] for s in shapes if p in s[1]), None) or max(shapes, key=lambda s: (math.log(s[2]) - ((p[0] - s[3]) ** 2 + (p[1] - s[4]) ** 2) / (2 * s[5]), s[0]))[0] for p in src}  # noqa: B023
        for s in shapes:
            own = [p for p in src if owner[p] == s[0]]
            found[min(src), s[0]] = (len(own), sum(image[p] for p in own))
    return found


@pytest.mark.parametrize("contrast", [0.005, 0.3])
def test_blends_are_brute_force(spark, contrast):
    rng = np.random.default_rng(7)
    images, pix = {}, []
    for k in range(2):
        image = np.abs(rng.normal(0, 0.3, (34, 44)))
        for cx, cy in ((10, 10), (30, 12), (20, 25)):
            image += star(image.shape, cx + rng.uniform(-1, 1), cy, 900, 1.6) + star(image.shape, cx + rng.uniform(4.5, 6), cy + 1, rng.uniform(120, 700), 1.4)
        images[k] = image
        pix += [(*r, 1.0) for r in rows(k, image)]
    x = spark.createDataFrame([*pix, (5, 0, 0, float("nan"), 1.0)], "img long, py int, px int, f double, noise double")
    got = {(r["img"], tuple(r["source"]), tuple(r["object"])): (r["n_pixels"], r["flux"]) for r in detection.deblended(x, "img", 3.0, 5, 16, contrast).collect()}
    want = {(k, *o): v for k, image in images.items() for o, v in brute_blends(image, 3.0, 5, 16, contrast).items()}
    assert got.keys() == want.keys() and all(got[k] == (want[k][0], pytest.approx(want[k][1])) for k in want)
    if contrast < 0.1:
        assert len({k[:2] for k in want}) < len(want)
    assert detection.deblended(x.limit(0), "img").collect() == []


def test_apertures(spark):
    image = star((30, 30), 14.3, 15.6, 1000, 1.2)
    pix = spark.createDataFrame(rows(1, image), "img long, py int, px int, f double")
    at = spark.createDataFrame([(1, 7, 14.3, 15.6), (1, 8, 0.0, 0.0), (1, 9, 500.0, 5.0)], "img long, obj long, x double, y double")
    got = {r["obj"]: r for r in detection.apertures(at, pix, "img", "obj", 5.0).collect()}
    assert got[7]["aperture_flux"] == pytest.approx(1000, rel=2e-3) and got[7]["area"] == pytest.approx(math.pi * 25, rel=0.01)
    assert set(got) == {7, 8} and got[8]["area"] < math.pi * 25 / 3


def test_meshes_of_many_images_are_no_single_task(spark):
    pix = spark.createDataFrame([r for k in range(40) for r in rows(k, np.ones((8, 8)))], "img long, py int, px int, v double")
    flat = detection.without_background(pix, detection.background_mesh(pix, "img", 8), "img", 8)
    assert flat.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert flat.where("f <> 0").count() == 0 and flat.count() == 40 * 64

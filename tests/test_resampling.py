"""Co-addition on a common grid: flux kept, exact where pixels fall on pixels, areas as a fine raster has them."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from duskfield.operators import images

FRAME = "k int, g int, a double, b double, c double, d double, e double, f double"


def turned(k, degrees, scale, cx, cy, mirror=1):
    s, c = scale * math.sin(math.radians(degrees)), scale * math.cos(math.radians(degrees))
    return (k, 0, *map(float, (c * mirror, -s, cx, s * mirror, c, cy)))


def stamps(spark, n, side=7):
    rng = np.random.default_rng(3)
    return spark.createDataFrame([(k, y, x, float(v)) for k in range(n) for (y, x), v in np.ndenumerate(rng.normal(5, 2, (side, side)))], "k int, py int, px int, v double")


def test_flux_is_kept(spark):
    pix = stamps(spark, 6)
    frames = spark.createDataFrame([turned(0, 0, 1, 0.3, -0.7), turned(1, 33, 1, 1000.2, 50000.1), turned(2, -71, 2.3, 4, 4), turned(3, 12, 0.4, 0, 0), turned(4, 45, 1, 0, 0, -1), (5, 0, 1.1, 0.6, 0.0, 0.1, 0.9, 0.0)], FRAME)
    before = {r["k"]: r["s"] for r in pix.groupBy("k").agg({"v": "sum"}).toDF("k", "s").collect()}
    got = {r["k"]: r for r in images.resampled(pix, frames, "k").groupBy("k").agg(F.sum("v").alias("v"), F.sum("area").alias("area")).collect()}
    assert set(got) == set(range(6))
    for k, r in got.items():
        assert r["v"] == pytest.approx(before[k], rel=1e-9)
        frame = next(f for f in frames.collect() if f["k"] == k)
        assert r["area"] == pytest.approx(49 * abs(frame["a"] * frame["e"] - frame["b"] * frame["d"]), rel=1e-9)


def test_whole_pixels_stay_and_quarter_turns_move(spark):
    pix = stamps(spark, 2)
    frames = spark.createDataFrame([(0, 0, 1.0, 0.0, 3.0, 0.0, 1.0, -2.0), (1, 0, 0.0, -1.0, 0.0, 1.0, 0.0, 0.0)], FRAME)
    old = {(r["k"], r["py"], r["px"]): r["v"] for r in pix.collect()}
    got = {(r["k"], r["py"], r["px"]): (r["v"], r["area"]) for r in images.resampled(pix, frames, "k").collect()}
    assert len(got) == 98
    for (k, y, x), v in old.items():
        assert got[(0, y - 2, x + 3) if k == 0 else (1, x, -y)] == pytest.approx((v, 1.0), abs=1e-9)


def test_areas_are_those_of_a_raster(spark):
    pix = spark.createDataFrame([(0, 0, 0, 1.0), (0, 1, 2, 10.0)], "k int, py int, px int, v double")
    frame = turned(0, 27, 1.4, 0.2, -0.3)
    got = {(r["py"], r["px"]): r["v"] for r in images.resampled(pix, spark.createDataFrame([frame], FRAME), "k").collect()}
    fine = (np.arange(800) + 0.5) / 800 - 0.5
    want = {}
    for y, x, v in ((0, 0, 1.0), (1, 2, 10.0)):
        px, py = np.meshgrid(x + fine, y + fine)
        gx, gy = (np.floor(p + 0.5).astype(int) for p in (frame[2] * px + frame[3] * py + frame[4], frame[5] * px + frame[6] * py + frame[7]))
        places, counts = np.unique(np.stack([gy.ravel(), gx.ravel()], 1), axis=0, return_counts=True)
        for at, n in zip(map(tuple, places.tolist()), counts, strict=True):
            want[at] = want.get(at, 0.0) + v * n / fine.size**2
    for at in set(got) | set(want):
        assert got.get(at, 0.0) == pytest.approx(want.get(at, 0.0), abs=2e-2)


def test_coadd_weighs_by_cover_and_leaves_gaps(spark):
    pix = spark.createDataFrame([(0, 0, 0, 2.0), (1, 0, 0, 6.0), (2, 0, 0, None), (3, 0, 0, float("nan")), (9, 0, 0, 1.0)], "k int, py int, px int, v double")
    frames = spark.createDataFrame([(k, 0, 1.0, 0.0, 0.25 if k == 1 else 0.0, 0.0, 1.0, 0.0) for k in range(5)] + [(9, 1, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)], FRAME)
    got = {r["px"]: (r["v"], r["n"]) for r in images.resampled_coadd(pix, frames, "k", "g").collect()}
    assert got == {0: (pytest.approx((2 + 6 * 0.75) / 1.75), 2), 1: (pytest.approx(6.0), 1)}
    assert images.resampled_coadd(pix.limit(0), frames, "k", "g").count() == 0 and images.resampled_coadd(pix, frames.limit(0), "k", "g").count() == 0

"""Matched differences and fits against planted answers and plain numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from duskfield.functions import photometry as phot
from duskfield.operators import epochs, matching


def pixel_rows(key, image):
    return [(key, int(y), int(x), float(v)) for (y, x), v in np.ndenumerate(image)]


def convolved(image, kernel):
    half = kernel.shape[0] // 2
    padded = np.pad(image, half)
    return sum(kernel[dy + half, dx + half] * padded[half - dy : half - dy + image.shape[0], half - dx : half - dx + image.shape[1]] for dy in range(-half, half + 1) for dx in range(-half, half + 1))


PIX = "key long, py int, px int, v double"


@pytest.mark.parametrize("size", [256, 7])
def test_planted_kernels_are_recovered(spark, size):
    """Whole images and tiles smaller than they are find each image's kernel, constant and new source; bad pixels are left out."""
    rng = np.random.default_rng(2)
    science, template, planted = [], [], {}
    for k in range(3):
        sky, kernel = rng.gamma(1.0, 10.0, (24, 31)), rng.uniform(-0.1, 1, (3, 3))
        s = convolved(sky, kernel) + 5 + k
        planted[k] = [*kernel.ravel(), 5 + k]
        s[12, 9] += 300
        s[5, 5], sky[18, 20] = np.nan, np.nan
        science += pixel_rows(k, s)
        template += pixel_rows(k, sky)
    science += [(9, 0, 0, 1.0)]
    s, t = spark.createDataFrame(science, PIX), spark.createDataFrame(template, PIX)
    got, kernels = matching.matched_difference(s, t, "key", size=size, rounds=4)
    coef = {r["key"]: list(r["coef"]) for r in kernels.collect()}
    assert coef.keys() == planted.keys() and all(coef[k] == pytest.approx(planted[k], abs=1e-6) for k in planted)
    d = {(r["key"], r["py"], r["px"]): r["v"] for r in got.collect()}
    assert len(d) == 3 * 24 * 31
    for (_, y, x), v in d.items():
        bad = y in (0, 23) or x in (0, 30) or (y, x) == (5, 5) or (abs(y - 18) <= 1 and abs(x - 20) <= 1)
        assert v is None if bad else v == pytest.approx(300 if (y, x) == (12, 9) else 0, abs=1e-6)


def test_gaussian_basis_and_no_pixels(spark):
    rng = np.random.default_rng(3)
    sky = rng.gamma(1.0, 10.0, (40, 40))
    basis = matching.gaussian_basis(3, (0.8, 1.6), (2, 0))
    kernel = np.tensordot(rng.uniform(0.1, 1, len(basis)), basis, 1)
    s, t = (spark.createDataFrame(pixel_rows(1, i), PIX) for i in (convolved(sky, kernel), sky))
    got, _ = matching.matched_difference(s, t, "key", basis, size=16)
    assert got.agg(F.max(F.abs("v")), F.count("v")).first() == (pytest.approx(0, abs=1e-6), 34 * 34)
    empty = spark.createDataFrame([], PIX)
    assert matching.matched_difference(empty, empty, "key")[0].collect() == []
    assert set(matching.ENGINES) == {"matched", "matched_gaussian"} and matching.ENGINES["matched"](s, t, "key").count() == 1600


def test_proper_difference(spark):
    """Two views of one sky through different spreads leave nothing; what is new stands out where it is."""
    rng = np.random.default_rng(4)
    y, x = np.mgrid[:32, :32]
    spread = lambda w: np.exp(-((y - 16) ** 2 + (x - 16) ** 2) / (2 * w * w)) / np.exp(-((y - 16) ** 2 + (x - 16) ** 2) / (2 * w * w)).sum()
    seen = lambda sky, p: np.real(np.fft.ifft2(np.fft.fft2(sky) * np.fft.fft2(np.fft.ifftshift(p))))
    sky = rng.gamma(1.0, 10.0, (32, 32))
    new = sky.copy()
    new[10, 21] += 500
    a, b = spread(0.8), spread(1.1)
    row = lambda k, s: (k, seen(s, a).ravel().tolist(), seen(sky, b).ravel().tolist(), a.ravel().tolist(), b.ravel().tolist(), 1.0, 1.0, 1.0, 1.0)
    kind = "key long, science array<double>, template array<double>, science_psf array<double>, template_psf array<double>, science_noise double, template_noise double, science_flux double, template_flux double"
    rows = [row(0, sky), row(1, new), (2, None, *row(2, sky)[2:]), (3, [1.0], *row(3, sky)[2:])]
    got = {r["key"]: r["d"] for r in matching.proper_difference(spark.createDataFrame(rows, kind), "key", 32).collect()}
    assert np.abs(got[0]).max() < 1e-6 and np.unravel_index(np.argmax(got[1]), (32, 32)) == (10, 21) and got[2] is None and got[3] is None


def simulated(spark, n, noise, seed):
    """Rows of three exposures whose magnitudes follow the model with terms of their own."""
    rng = np.random.default_rng(seed)
    truth = {e: {"Z": 25.0 + 0.1 * e, "PX": 0.05 - 0.01 * e, "GA": 0.2 + 0.05 * e, "GW": -0.4 - 0.1 * e, "EA": 0.03, "EW": 0.8 + 0.1 * e, "RS": 0.02 + 0.01 * e, "RC": 0.5} for e in range(3)}
    x = spark.createDataFrame([(e, float(-12 + 3 * rng.random()), *map(float, rng.uniform(-1, 1, 2)), float(rng.normal(0, noise)), bool(rng.random() < 0.03)) for e in truth for _ in range(n)], "epoch_id int, mag double, x double, y double, noise double, wild boolean")
    value = F.lit(None).cast("double")
    for e, t in truth.items():
        value = F.when(F.col("epoch_id") == e, model_of(t)).otherwise(value)
    return truth, x.select("*", (value + F.col("noise") + F.when(F.col("wild") & (F.lit(noise) > 0), 3.0).otherwise(0.0)).alias("star"), F.lit(max(noise, 0.01)).alias("err"))


def model_of(terms):
    zero = F.lit(0.0)
    return phot.fitted_model(terms, F.col("mag"), zero, F.col("x"), F.col("y"), [zero] * 4, zero, zero, F.lit(0))


@pytest.mark.parametrize("noise,robust", [(0.0, False), (0.01, True)])
def test_terms_that_are_not_linear(spark, noise, robust):
    """Widths, scales and the rational terms are recovered for each exposure, with wild rows and without."""
    truth, rows = simulated(spark, 400, noise, 5)
    start = {"Z": 25.0, "PX": 0.0, "GA": 0.15, "GW": -0.3} | ({} if noise else {"EW": 1.0})
    e = F.col("epoch_id")
    fixed = {"EA": F.lit(0.03), "RS": 0.02 + 0.01 * e, "RC": F.lit(0.5)} | ({"EW": 0.8 + 0.1 * e} if noise else {})
    model = lambda p: model_of(p | fixed)
    got = epochs.fit_model(rows, "epoch_id", "star", "err", model, start, robust=robust).collect()
    assert len(got) == 3 * len(start) and all(r["n_rows"] == 400 for r in got)
    for r in got:
        want = truth[r["epoch_id"]][r["term"]]
        assert r["value"] == pytest.approx(want, abs=1e-5) if not noise else abs(r["value"] - want) < 6 * r["error"] + 1e-4, (r, want)
        assert math.isfinite(r["error"]) and (not noise or 0 < r["error"])


def test_terms_without_effect_and_hard_rows(spark):
    """A term that nothing depends on stays; singular equations, unknown rows and empty tables have defined results."""
    rows = [(0, 1.0 + 2 * k, 0.1, float(k)) for k in range(9)] + [(0, None, 0.1, 1.0), (0, 3.0, 0.0, 1.0), (0, float("nan"), 0.1, 1.0), (1, 5.0, 0.1, 2.0), (2, None, 0.1, 1.0)]
    x = spark.createDataFrame(rows, "g int, v double, e double, t double")
    model = lambda p: p["a"] + p["b"] * F.col("t") + 0 * p["c"]
    got = {(r["g"], r["term"]): r for r in epochs.fit_model(x, "g", "v", "e", model, {"a": 0.0, "b": 1.0, "c": 7.0}).collect()}
    assert {g for g, _ in got} == {0, 1}
    assert got[0, "a"]["value"] == pytest.approx(1, abs=1e-6) and got[0, "b"]["value"] == pytest.approx(2, abs=1e-6)
    assert got[0, "c"]["value"] == 7 and got[0, "c"]["error"] == 0
    assert got[1, "a"]["value"] + 2 * got[1, "b"]["value"] == pytest.approx(5, abs=1e-6)
    assert epochs.fit_model(x.limit(0), "g", "v", "e", model, {"a": 0.0, "b": 1.0, "c": 7.0}).collect() == []


def test_pixels_come_to_python_as_numbers_in_bounded_batches(spark):
    pix = spark.createDataFrame(pixel_rows(1, np.ones((4, 4))), PIX)
    matching.matched_difference(pix, pix, "key")
    assert "spark.sql.execution.arrow.maxBytesPerBatch" in spark.conf.getAll
    cut = matching._arrays(matching.tiles(pix, pix, "key", 256, 1))
    assert [t for c, t in cut.dtypes if c in ("t", "py", "px", "v")] == ["array<int>", "array<int>", "array<int>", "array<double>"]
    assert "pix" not in cut.columns

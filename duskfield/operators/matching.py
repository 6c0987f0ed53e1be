"""Differences of images whose point spreads differ: the template is convolved to the science image before it is subtracted.

Images come as pixels (key, py, px, v), rows and columns from 0, science and template aligned. Spark cuts them into tiles
with a rim as wide as the kernel, so that a tile's part of the normal equations needs no other; their sums by image are small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tables import bounded_batches, spread, written

#: Images whose solutions are sent to all tasks, at some hundred bytes each; beyond it they are joined.
BROADCAST_IMAGES = 10_000


def delta_basis(half: int) -> np.ndarray:
    """A kernel of free pixels: one basis image for each."""
    side = 2 * half + 1
    return np.eye(side * side).reshape(-1, side, side)


def gaussian_basis(half: int, widths: tuple[float, ...] = (0.7, 1.5, 3.0), degrees: tuple[int, ...] = (6, 4, 2)) -> np.ndarray:
    """Gaussians times polynomials of the place, up to a degree for each width."""
    y, x = np.mgrid[-half : half + 1, -half : half + 1].astype(float)
    return np.array([np.exp(-(x * x + y * y) / (2 * w * w)) * (x / half) ** i * (y / half) ** j for w, d in zip(widths, degrees, strict=True) for i in range(d + 1) for j in range(d + 1 - i)])


def tiles(science: DataFrame, template: DataFrame, key: str, size: int, half: int) -> DataFrame:
    """(key, ty, tx, pix): the pixels of each tile, ``pix`` being an array of (t, py, px, v) with t 1 for the template, which
    has a rim of ``half`` pixels around the tile. One shuffle; a group is one tile; tiles without science pixels have no row."""
    low, high = (lambda c: F.floor((F.col(c) - half) / size)), (lambda c: F.floor((F.col(c) + half) / size))
    near = lambda c: F.explode(F.array_distinct(F.array(low(c), F.floor(F.col(c) / size), high(c))))
    s = science.select(key, F.lit(0).alias("t"), "py", "px", "v", F.floor(F.col("py") / size).alias("ty"), F.floor(F.col("px") / size).alias("tx"))
    t = template.select(key, F.lit(1).alias("t"), "py", "px", "v", near("py").alias("ty")).withColumn("tx", near("px"))
    both = s.unionByName(t).select(key, "ty", "tx", F.struct("t", "py", "px", F.col("v").cast("double").alias("v")).alias("p"))
    return both.groupBy(key, "ty", "tx").agg(F.collect_list("p").alias("pix")).where(F.exists("pix", lambda p: p["t"] == 0))


def _arrays(cut: DataFrame) -> DataFrame:
    """Tiles with their pixels as four arrays, which come to Python as numbers; an array of structs comes as a dict for each."""
    return cut.select("*", *[F.col(f"pix.{c}").alias(c) for c in ("t", "py", "px", "v")]).drop("ty", "tx", "pix")


def _design(row, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one tile: the places of its science pixels, the convolved template by basis image with a constant, and the values."""
    t, py, px = (np.asarray(getattr(row, c)) for c in ("t", "py", "px"))
    v = np.asarray(row.v, float)
    sci = t == 0
    half = basis.shape[1] // 2
    y0, x0 = py.min() - half, px.min() - half
    canvas = np.full((py.max() - y0 + half + 1, px.max() - x0 + half + 1), np.nan)
    canvas[py[~sci] - y0, px[~sci] - x0] = v[~sci]
    windows = np.lib.stride_tricks.sliding_window_view(canvas, basis.shape[1:])
    near = windows[py[sci] - y0 - half, px[sci] - x0 - half][:, ::-1, ::-1].reshape(sci.sum(), basis[0].size)
    design = np.column_stack([near @ basis.reshape(len(basis), -1).T, np.ones(sci.sum())])
    return np.column_stack([py[sci], px[sci]]), design, v[sci]


def _with_solution(cut: DataFrame, solved: DataFrame, key: str) -> DataFrame:
    return cut.join(F.broadcast(solved) if solved.count() <= BROADCAST_IMAGES else solved, key)


def fitted_kernels(cut: DataFrame, key: str, basis: np.ndarray, rounds: int = 1, clip: float = 4.0) -> DataFrame:
    """(key, coef, rms, n_pixels): per image the coefficients of the basis images and a constant that fit the science pixels best.

    A tile adds its part of the normal equations; sums by image are partial. Later rounds leave out pixels off by more than
    ``clip`` times the last round's rms. Pixels that aren't finite, or whose window of the template isn't, are left out;
    where the equations are singular the solution of least norm is taken; an image without usable pixels has none.
    """
    k = len(basis) + 1
    upper = np.triu_indices(k)
    kind = cut.schema[key].dataType.simpleString()

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for row in b.itertuples(index=False):
                _, a, v = _design(row, basis)
                ok = np.isfinite(a).all(1) & np.isfinite(v)
                if hasattr(row, "coef"):
                    ok[ok] = np.abs(v[ok] - a[ok] @ row.coef) <= clip * row.rms
                a, v = a[ok], v[ok]
                if len(v):
                    rows.append((row[0], np.concatenate([(a.T @ a)[upper], a.T @ v, [v @ v, len(v)]])))
            yield pd.DataFrame(rows, columns=[key, "part"])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for name, s in zip(b[key], b["sums"], strict=True):
                s = np.asarray(s)
                gram = np.zeros((k, k))
                gram[upper] = s[: len(upper[0])]
                gram += np.triu(gram, 1).T
                side, (vv, n) = s[len(upper[0]) : -2], s[-2:]
                coef = np.linalg.pinv(gram, rcond=1e-13, hermitian=True) @ side
                rows.append((name, coef, np.sqrt(max(vv - coef @ side, 1e-16 * vv) / n), int(n)))  # rounding leaves no less
            yield pd.DataFrame(rows, columns=[key, "coef", "rms", "n_pixels"])

    solved = None
    for _ in range(rounds):
        x = cut if solved is None else _with_solution(cut, solved.select(key, "coef", "rms"), key)
        x = spread(_arrays(x), key).mapInPandas(parts, f"{key} {kind}, part array<double>").select(key, F.posexplode("part").alias("i", "v"))
        sums = x.groupBy(key, "i").agg(F.sum("v").alias("v")).groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda p: p["v"]).alias("sums"))
        solved = written(sums.mapInPandas(solve, f"{key} {kind}, coef array<double>, rms double, n_pixels long"), "kernels")
    return solved


def matched_difference(science: DataFrame, template: DataFrame, key: str, basis: np.ndarray | None = None, size: int = 256, rounds: int = 1, clip: float = 4.0) -> tuple[DataFrame, DataFrame]:
    """(key, py, px, v): science less the template convolved with the kernel that fits it best; and the kernels.

    Pixels whose window of the template reaches beyond it, or holds a pixel that isn't finite, are null. Images without a
    template have no rows; extra columns aren't read; of a pixel that comes twice the last one read counts.
    """
    basis = delta_basis(1) if basis is None else basis
    bounded_batches(science.sparkSession)
    cut = written(tiles(science, template, key, size, basis.shape[1] // 2), "tiles")
    solved = fitted_kernels(cut, key, basis, rounds, clip)
    kind = cut.schema[key].dataType.simpleString()

    def less(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            names, places, values = [], [], []
            for row in b.itertuples(index=False):
                at, a, v = _design(row, basis)
                names += [row[0]] * len(v)
                places.append(at)
                values.append(v - a @ row.coef)
            if values:
                at = np.concatenate(places)
                yield pd.DataFrame({key: names, "py": at[:, 0], "px": at[:, 1], "v": np.concatenate(values)})

    out = _arrays(_with_solution(cut, solved.select(key, "coef"), key)).mapInPandas(less, f"{key} {kind}, py int, px int, v double")
    return out.withColumn("v", F.when(~F.isnan("v"), F.col("v"))), solved


def proper_difference(stamps: DataFrame, key: str, width: int) -> DataFrame:
    """(key, d): the proper difference in Fourier space of aligned stamps with known point spreads.

    ``stamps``: key, science, template, science_psf, template_psf (flat arrays of one size, the spreads centred on pixel
    (height // 2, width // 2)), science_noise, template_noise (deviations), science_flux, template_flux (scales). Edges
    wrap; pixels that aren't finite count as 0; a stamp whose arrays differ in size or are null is null.
    """
    kind = stamps.schema[key].dataType.simpleString()
    images = ["science", "template", "science_psf", "template_psf"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row in b.itertuples(index=False):
                arrays = [getattr(row, c) for c in images]
                if any(a is None for a in arrays) or len({len(a) for a in arrays}) > 1 or not len(arrays[0]):
                    out.append(None)
                    continue
                n, r, pn, pr = (np.nan_to_num(np.asarray(a, float).reshape(-1, width), posinf=0.0, neginf=0.0) for a in arrays)
                n, r = np.fft.fft2(n), np.fft.fft2(r)
                pn, pr = (np.fft.fft2(np.fft.ifftshift(p)) for p in (pn, pr))
                fn, fr = row.science_flux, row.template_flux
                spread = row.science_noise**2 * fr**2 * np.abs(pr) ** 2 + row.template_noise**2 * fn**2 * np.abs(pn) ** 2
                d = (fr * pr * n - fn * pn * r) / np.sqrt(np.maximum(spread, 1e-300))
                out.append(np.real(np.fft.ifft2(d)).ravel())
            yield pd.DataFrame({key: b[key], "d": out})

    columns = [*images, "science_noise", "template_noise", "science_flux", "template_flux"]
    return stamps.select(key, *columns).mapInPandas(run, f"{key} {kind}, d array<double>")


#: Engines that match point spreads, by name: (science pixels, template pixels, key) -> difference pixels.
ENGINES: dict[str, Callable[[DataFrame, DataFrame, str], DataFrame]] = {
    "matched": lambda s, t, key: matched_difference(s, t, key)[0],
    "matched_gaussian": lambda s, t, key: matched_difference(s, t, key, gaussian_basis(5), rounds=3)[0],
}

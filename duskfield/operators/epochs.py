"""Exposures: quality, reference choice, stack groups, depth, cadence; and small fits."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import exposure_middle, mjd
from ..functions.identity import exposure_from_name, grid_key
from ..functions.tables import written


def depth(mag: Column, error: Column, most_error: float = 0.2) -> Column:
    """Limiting magnitude: the 90th percentile of the well measured."""
    return F.percentile(F.when(error < most_error, mag), F.lit(0.9))


def epoch_quality(det: DataFrame, centre: DataFrame | None = None) -> DataFrame:
    """Per exposure: count, seeing, depth and the weighted score. ``centre``: epoch_id, offset (degrees from the field's centre)."""
    x = det.groupBy("epoch_id").agg(F.count(F.lit(1)).alias("n"), F.percentile("fwhm", F.lit(0.5)).alias("seeing"), depth(F.col("mag"), F.col("err")).alias("maglim"))
    off = F.lit(0.0)
    if centre is not None:
        x, off = x.join(centre, "epoch_id"), F.col("offset")
    return x.withColumn("score", 0.4 / F.col("seeing") + 0.2 * F.col("maglim") / 20 + 0.1 * F.col("n") / 1000 + 0.1 / (1 + off))


def choose_reference(quality: DataFrame, with_target: DataFrame | None = None) -> DataFrame:
    """The best exposure, of those without the target if there are any; the earlier of two as good."""
    if with_target is not None:
        free = quality.join(with_target, "epoch_id", "left_anti").withColumn("contaminated", F.lit(False))
        rest = quality.join(with_target, "epoch_id", "left_semi").withColumn("contaminated", F.lit(True))
        quality = free.unionByName(rest)
        return quality.orderBy("contaminated", F.desc("score"), "epoch_id").limit(1)
    return quality.orderBy(F.desc("score"), "epoch_id").limit(1)


def stack_inputs(epochs: DataFrame, most: int = 20) -> DataFrame:
    """The latest exposures of the largest group of one filter and exposure time; incomplete headers are left out."""
    x = epochs.where("filter is not null and exptime is not null").withColumn("secs", F.bround("exptime", 1))
    top = x.groupBy("filter", "secs").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "filter", "secs").limit(1)
    own = x.join(F.broadcast(top.select("filter", "secs")), ["filter", "secs"], "left_semi")  # one row
    return own.orderBy(F.desc("obs_time"), "epoch_id").limit(most)


def cadence(epochs: DataFrame, group: str) -> DataFrame:
    """Median time between neighbouring rows, in seconds."""
    gap = F.col("obs_time") - F.lag("obs_time").over(Window.partitionBy(group).orderBy("obs_time", "det_id"))
    return epochs.withColumn("gap", gap).groupBy(group).agg(F.percentile("gap", F.lit(0.5)).alias("cadence_s"))


def needs_stack(n_epochs: int, stacked: int | None, best_score: float | None, first: int = 10, interval: int = 5, good: float = 1.0) -> bool:
    """Whether a stack is due: enough exposures, enough new ones since, and no candidate that is good already."""
    if n_epochs < first or (best_score is not None and best_score >= good):
        return False
    return stacked is None or n_epochs - stacked >= interval


def fit_terms(rows: DataFrame, group: str, y: str, err: str, terms: dict[str, Column], rounds: int = 8) -> DataFrame:
    """(group, term, value, error): robust weighted linear fit per group, Cauchy weights in rounds.

    Each round adds up the normal equations by partial sums and solves a small matrix per group, so that no group's rows
    come to one task. Where the equations are singular, the solution of least norm is taken and its errors are those of
    the pseudo-inverse. A row with an unknown value or error is left out.
    """
    names = list(terms)
    k = len(names)
    x = rows.select(group, F.col(y).alias("_y"), F.col(err).alias("_e"), *[c.cast("double").alias(f"_t{i}") for i, c in enumerate(terms.values())])
    known = lambda c: F.col(c).isNotNull() & ~F.isnan(c)
    x = x.where(known("_y") & known("_e") & (F.col("_e") > 0))
    for i in range(k):
        x = x.where(known(f"_t{i}"))
    x = written(x, "fit_rows")
    kind = x.schema[group].dataType.simpleString()

    def solved(batches):
        for p in batches:
            for row in p.itertuples(index=False):
                gram = np.zeros((k, k))
                gram[np.triu_indices(k)] = row.gram
                gram = gram + np.triu(gram, 1).T
                cov = np.linalg.pinv(gram, rcond=1e-12, hermitian=True)
                yield pd.DataFrame({group: [row[0]], "beta": [cov @ np.asarray(row.side)], "error": [np.sqrt(np.clip(np.diag(cov), 0, None))]})

    now = None
    for _ in range(rounds):
        z = x if now is None else x.join(now.select(group, "beta"), group)
        w = 1 / F.pow("_e", 2)
        if now is not None:
            model = sum((F.get("beta", F.lit(i)) * F.col(f"_t{i}") for i in range(k)), F.lit(0.0))
            w = w / (1 + F.pow((F.col("_y") - model) / F.col("_e"), 2))
        z = z.withColumn("_w", w)
        gram = [F.sum(F.col("_w") * F.col(f"_t{a}") * F.col(f"_t{b}")) for a in range(k) for b in range(a, k)]
        side = [F.sum(F.col("_w") * F.col(f"_t{a}") * F.col("_y")) for a in range(k)]
        sums = z.groupBy(group).agg(F.array(*gram).alias("gram"), F.array(*side).alias("side"))
        now = written(sums.mapInPandas(solved, f"{group} {kind}, beta array<double>, error array<double>"), "fit")
    each = F.explode(F.arrays_zip(F.array(*map(F.lit, names)).alias("term"), F.col("beta").alias("value"), F.col("error").alias("error")))
    return now.select(group, each.alias("t")).select(group, "t.term", "t.value", "t.error")


def fit_model(rows: DataFrame, group: str, y: str, err: str, model: Callable[[dict[str, Column]], Column], start: dict[str, float], rounds: int = 40, robust: bool = True, tolerance: float = 1e-10) -> DataFrame:
    """(group, term, value, error, rms, n_rows): a model that isn't linear in its terms, fitted per group by Levenberg-Marquardt.

    ``model`` gives the value of a row from columns of the terms, which begin at ``start``. Its derivatives are central
    differences of the same expression, so that a round is one pass of partial sums: normal equations, and the sum of
    squares or of Cauchy's ln(1 + z^2). Each group has its own damping; a step that doesn't lower its sum is taken back and
    damped more. Groups that stand still have no part in further rounds; the last round is the latest after ``rounds``.

    A group stands still when a step lowers its sum by less than ``tolerance`` of it.

    Errors are roots of the inverse normal equations, of their pseudo-inverse where these are singular, and scaled by the
    rms of the weighted residuals; a term that nothing depends on keeps its start and has an error of 0. Rows with an
    unknown value or an error that isn't positive are left out; a group without rows, or whose model isn't finite at the
    start, has no result; an empty table gives none.
    """
    names, k = list(start), len(start)
    known = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    x = written(rows.where(known(y) & known(err) & (F.col(err) > 0)), "fit_rows")
    kind = x.schema[group].dataType.simpleString()
    term = lambda i: F.get("trial", F.lit(i))
    at = {n: term(i) for i, n in enumerate(names)}
    step = lambda i: F.greatest(F.abs(term(i)), F.lit(1e-3)) * 6e-6
    slope = lambda i: (model(at | {names[i]: term(i) + step(i)}) - model(at | {names[i]: term(i) - step(i)})) / (2 * step(i))
    upper = np.triu_indices(k)
    state = f"{group} {kind}, trial array<double>, best array<double>, gram array<double>, side array<double>, cost double, damp double, n_rows long, still boolean"

    def stepped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                best, gram, side, cost, damp, still = r.best, r.gram, r.side, r.cost, r.damp, False
                better = np.isfinite(r.new_cost) and np.isfinite(r.new_gram).all() and (best is None or r.new_cost <= cost)
                if best is None and not better:
                    continue
                if better:
                    still = best is not None and cost - r.new_cost <= tolerance * cost + 1e-15 * r.n_rows
                    best, gram, side, cost, damp = r.trial, r.new_gram, r.new_side, r.new_cost, damp / 10
                else:
                    damp *= 10
                    still = damp > 1e12
                full = np.zeros((k, k))
                full[upper] = gram
                full += np.triu(full, 1).T
                d = np.where(np.diag(full) > 0, np.diag(full), 1.0)
                move = np.linalg.lstsq(full + damp * np.diag(d), np.asarray(side), rcond=None)[0]
                out.append((r[0], np.asarray(best) + move, best, gram, side, cost, damp, r.n_rows, still))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in state.split(", ")])

    groups = x.select(group).distinct()
    empty = F.lit(None).cast("array<double>")
    now = groups.select(group, F.array(*[F.lit(float(v)) for v in start.values()]).alias("trial"), empty.alias("best"), empty.alias("gram"), empty.alias("side"), F.lit(0.0).alias("cost"), F.lit(1e-3).alias("damp"))
    done = None
    for turn in range(rounds):
        z = x.join(now.select(group, "trial"), group).withColumn("_r", (F.col(y) - model(at)) / F.col(err))
        w = 1 / (1 + F.col("_r") * F.col("_r")) if robust else F.lit(1.0)
        z = z.withColumns({"_w": w} | {f"_d{i}": slope(i) / F.col(err) for i in range(k)})
        gram = F.array(*[F.sum(F.col("_w") * F.col(f"_d{a}") * F.col(f"_d{b}")) for a, b in zip(*upper, strict=True)])
        side = F.array(*[F.sum(F.col("_w") * F.col(f"_d{i}") * F.col("_r")) for i in range(k)])
        cost = F.sum(F.log1p(F.col("_r") * F.col("_r")) if robust else F.col("_r") * F.col("_r"))
        sums = z.groupBy(group).agg(gram.alias("new_gram"), side.alias("new_side"), cost.alias("new_cost"), F.count(F.lit(1)).alias("n_rows"))
        moved = written(now.join(sums, group).mapInPandas(stepped, state), "fit_state")
        ended = moved if turn == rounds - 1 else moved.where("still")
        done = ended if done is None else done.unionByName(ended)
        now = moved.where("not still").drop("n_rows", "still")
        if not now.limit(1).count():
            break

    def errors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                full = np.zeros((k, k))
                full[upper] = r.gram
                full += np.triu(full, 1).T
                try:
                    cov = np.linalg.inv(full)
                    if not (np.diag(cov) >= 0).all():
                        raise np.linalg.LinAlgError
                except np.linalg.LinAlgError:
                    cov = np.linalg.pinv(full, rcond=1e-12, hermitian=True)
                rms = math.sqrt(r.spread / max(r.n_rows - k, 1))
                yield pd.DataFrame({group: [r[0]] * k, "term": names, "value": r.best, "error": np.sqrt(np.clip(np.diag(cov), 0, None)) * rms, "rms": rms, "n_rows": r.n_rows})

    # The spread of the residuals at the end: weighted as the fit has them.
    done = done.withColumn("trial", F.col("best"))
    z = x.join(done.select(group, "trial"), group).withColumn("_r", (F.col(y) - model(at)) / F.col(err))
    w = 1 / (1 + F.col("_r") * F.col("_r")) if robust else F.lit(1.0)
    spread = z.groupBy(group).agg(F.sum(w * F.col("_r") * F.col("_r")).alias("spread"))
    return done.join(spread, group).mapInPandas(errors, f"{group} {kind}, term string, value double, error double, rms double, n_rows long")


def sample_frames(frames: DataFrame, group: str, most: int) -> DataFrame:
    """At most ``most`` frames of each group: the first, the last, the one likely to be brightest, and an even stride of the
    rest, in order of ``position``. ``frames``: group, position, name, size (bytes). All are taken where they are few.

    Likely brightest: by the exposure in the name (a hundredth a second), the size (1 for 100 MiB), closeness to the middle
    (up to a half), and 10 less for calibration frames; none if all are below -1.
    """
    all_of = Window.partitionBy(group)
    order = all_of.orderBy("position", "name")
    x = frames.withColumns({"_i": F.row_number().over(order) - 1, "_n": F.count(F.lit(1)).over(all_of)})
    lower = F.lower("name")
    calibration = lower.contains("bias") | lower.contains("dark") | lower.contains("flat")
    middle = 1 - F.abs(F.col("_i") - F.col("_n") / 2) / (F.col("_n") / 2)
    score = F.coalesce(exposure_from_name(lower) / 100, F.lit(0.0)) + F.coalesce(F.col("size") / float(100 << 20), F.lit(0.0)) - F.when(calibration, 10.0).otherwise(0.0) + 0.5 * middle
    x = x.withColumn("_score", score)
    best = F.first(F.when(F.col("_score") > -1, F.col("_i")), ignorenulls=True).over(all_of.orderBy(F.desc("_score"), "_i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    x = x.withColumn("_best", best)
    fixed = (F.col("_i") == 0) | (F.col("_i") == F.col("_n") - 1) | (F.col("_i") == F.coalesce("_best", F.lit(0)))
    x = x.withColumn("_fixed", fixed)
    x = x.withColumns({"_held": F.sum(F.col("_fixed").cast("int")).over(all_of), "_r": F.row_number().over(all_of.orderBy("_fixed", "_i")) - 1})
    slots = F.lit(most) - F.col("_held")
    step = F.greatest(F.lit(1), F.floor((F.col("_n") - F.col("_held")) / F.greatest(slots, F.lit(1))))
    even = ~F.col("_fixed") & (slots > 0) & (F.col("_r") % step == 0) & (F.col("_r") / step < slots)
    few = F.col("_n") <= most
    taken = x.where(few | F.col("_fixed") | even)
    place = F.row_number().over(all_of.orderBy("name", "position"))
    return taken.withColumn("_p", place).where((F.col("_n") <= most) | (F.col("_p") <= most)).drop("_i", "_n", "_score", "_best", "_fixed", "_held", "_r", "_p")


def missing_differences(science: DataFrame, done: DataFrame, template: DataFrame | None = None) -> DataFrame:
    """(epoch_id, template_id) of the science exposures that have no difference yet, each with its field's template; an
    exposure isn't its own template. ``template``: field, template_id (none: survey templates, by field)."""
    x = science.join(done.select("epoch_id").distinct(), "epoch_id", "left_anti")
    if template is None:
        return x.select("epoch_id", F.concat(F.lit("survey:"), F.col("field")).alias("template_id"))
    x = x.join(template, "field")
    return x.where(F.col("epoch_id").cast("string") != F.col("template_id").cast("string")).select("epoch_id", F.col("template_id").cast("string").alias("template_id"))


def templates_by_cell(fields: DataFrame, templates: DataFrame, cell: float = 0.02) -> DataFrame:
    """``fields`` (ra, dec, band, ...) with the survey template of the same grid cell and band (``tile``), null without one;
    the newest of several."""
    key = lambda ra, dec, band: grid_key([(ra, cell), (dec, cell)], band)
    own = templates.select(key(F.col("ra"), F.col("dec"), F.col("band")).alias("_key"), "tile", "made")
    last = own.groupBy("_key").agg(F.max_by("tile", F.struct("made", "tile")).alias("tile"))
    return fields.withColumn("_key", key(F.col("ra"), F.col("dec"), F.col("band"))).join(last, "_key", "left").drop("_key")


def borrow_headers(diff: DataFrame, science: DataFrame, keys: list[str]) -> DataFrame:
    """``diff`` with the header values that it lacks from its science sibling. ``stem`` names each; a difference's ends in h."""
    other = science.select(F.col("stem").alias("_stem"), *[F.col(k).alias(f"_{k}") for k in keys])
    out = diff.join(other, F.regexp_replace("stem", "h$", "") == F.col("_stem"), "left")
    return out.withColumns({k: F.coalesce(k, f"_{k}") for k in keys}).drop("_stem", *[f"_{k}" for k in keys])


def stack_due(epochs: DataFrame, group: str, first: int = 10, interval: int = 5, good: float = 1.0) -> DataFrame:
    """Per group and arrival whether a stack is due then: counts so far against the first and the interval, and no good
    candidate yet. ``epochs``: group, obs_time, score."""
    so_far = Window.partitionBy(group).orderBy("obs_time", "epoch_id").rowsBetween(Window.unboundedPreceding, 0)
    x = epochs.withColumns({"n": F.count(F.lit(1)).over(so_far), "best": F.max("score").over(so_far)})
    return x.withColumn("due", (F.col("n") >= first) & ((F.col("n") - first) % interval == 0) & ~(F.col("best") >= good))


def replay(epochs: DataFrame, number: str = "number") -> DataFrame:
    """(step, epoch): the exposures that each step of a replay has seen; ``number`` counts from 0. Each exposure is spread over
    the steps from its own on, so nothing is joined."""
    total = epochs.agg(F.max(number)).first()[0]  # one number
    if total is None:
        return epochs.select(F.lit(0).alias("step"), "*").where("false")
    return epochs.select(F.explode(F.sequence(F.col(number) + 1, F.lit(total + 1))).alias("step"), "*")


def annotate(det: DataFrame, headers: DataFrame) -> DataFrame:
    """Detections with their exposure's middle ``obs_time``, ``mjd`` and ``source_file``. ``headers``: epoch_id, ctime, exptime,
    filename."""
    mid = exposure_middle(F.col("ctime"), F.col("exptime"))
    own = headers.select("epoch_id", mid.alias("obs_time"), mjd(mid).alias("mjd"), F.coalesce("filename", F.lit("unknown")).alias("source_file"))
    return det.join(own, "epoch_id")


def template_provenance(chosen: DataFrame, names: DataFrame) -> DataFrame:
    """(epoch_id, provenance) of chosen reference exposures (epoch_id, and contaminated if a target was asked for); ``names``:
    epoch_id, stem."""
    spoilt = F.coalesce("contaminated", F.lit(False)) if "contaminated" in chosen.columns else F.lit(False)
    return chosen.join(names, "epoch_id").select("epoch_id", F.concat(F.lit("own_epoch:"), F.col("stem"), F.when(spoilt, ":target-contaminated").otherwise("")).alias("provenance"))

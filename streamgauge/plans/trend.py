"""Weekly trends that bend: slopes with sparse change points, yearly waves and an interval.

A series is a line whose slope may change at evenly spaced places of its first four
fifths, plus yearly waves. Spark adds up each platform's normal equations, which are
one small matrix however many rows a platform has; coordinate descent under an
absolute penalty on the changes solves them, so most changes are exactly zero.
"""

from __future__ import annotations

from collections.abc import Callable
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

YEAR_DAYS = 365.25
#: Share of the known range in which the slope may change; what follows has too few weeks to tell.
BENDING = 0.8
#: Platforms whose sums a task holds before it passes them on.
HELD = 1000


def knots(changes: int) -> np.ndarray:
    """Places of the change points, in parts of the known range."""
    return BENDING * np.arange(1, changes + 1) / (changes + 1)


def features(day: np.ndarray, origin: np.ndarray, span: np.ndarray, changes: int, order: int) -> np.ndarray:
    """A constant, the line, its bends and the waves, a column each."""
    at = (day - origin) / span
    bends = np.maximum(at[:, None] - knots(changes), 0)
    waves = [f(2 * np.pi * k * day / YEAR_DAYS) for k in range(1, order + 1) for f in (np.sin, np.cos)]
    return np.column_stack([np.ones_like(at), at, bends, *waves])


def sparse_solution(gram: np.ndarray, cross: np.ndarray, penalty: np.ndarray, ridge: np.ndarray, rounds: int = 20_000) -> np.ndarray:
    """The coefficients b that make b'Gb/2 - c'b + sum(penalty*|b|) + sum(ridge*b^2)/2 least.

    Coordinate descent finds the signs; whenever they stand still, the equations
    of the coefficients that aren't zero are solved at once, and that solution is taken if no condition
    of the optimum is broken.
    """
    gram = gram + np.diag(ridge)
    size = np.maximum(np.diag(gram), 1e-12)
    found = np.zeros(len(cross))
    for turn in range(rounds):
        before = found.copy()
        for j in range(len(found)):
            rest = cross[j] - gram[j] @ found + gram[j, j] * found[j]
            found[j] = np.sign(rest) * max(abs(rest) - penalty[j], 0) / size[j]
        if turn % 20 == 19 or np.abs(found - before).max() <= 1e-12 * max(1.0, np.abs(found).max()):
            used = found != 0
            exact = np.zeros(len(found))
            exact[used] = np.linalg.lstsq(gram[np.ix_(used, used)], (cross - penalty * np.sign(found))[used], rcond=None)[0]
            slack = np.abs(cross - gram @ exact) - penalty
            same = np.array_equal(np.sign(exact[used & (penalty > 0)]), np.sign(found[used & (penalty > 0)]))
            if same and (slack <= 1e-7 * max(1.0, np.abs(cross).max())).all():
                return exact
            if turn % 20 != 19:
                break
    return found


def _sums(rows: DataFrame, changes: int, order: int) -> DataFrame:
    """``platform``, ``place`` and ``value``: each platform's products of features and values, added up."""
    width = 3 + changes + 2 * order

    def run(batches):
        held: dict = {}

        def given():
            names, totals = list(held), [t.ravel() for t in held.values()]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(names, object), width * width).tolist(), pa.string()), pa.array(np.tile(np.arange(width * width, dtype=np.int32), len(names))), pa.array(np.concatenate(totals) if totals else np.zeros(0))],
                ["platform", "place", "value"],
            )

        for batch in batches:
            day, origin, span, y = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("day", "origin", "span", "y"))
            x = np.column_stack([features(day, origin, span, changes, order), y])
            names = batch.column("platform").to_numpy(zero_copy_only=False)
            for name in pd.unique(names):
                mine = x[names == name] if name is not None else x[pd.isna(names)]
                held[name] = held.get(name, 0) + mine.T @ mine
            if len(held) >= HELD:
                yield given()
        yield given()

    parts = rows.mapInArrow(run, "platform string, place int, value double")
    return parts.groupBy("platform", "place").agg(F.sum("value").alias("value"))


MODEL = "platform string, origin double, span double, scale double, rows long, coef array<double>, sigma double, drift double"


def fit_trends(frame: DataFrame, changes: int = 25, order: int = 3, prior: float = 0.05, ridge: float = 1.0) -> DataFrame:
    """One model per platform of the weeks with a value: ``platform``, ``origin``, ``span``, ``scale``, ``coef``, ``sigma``, ``drift``.

    ``prior`` is the size of a change of slope, in the series' largest value per known
    range, that costs as much as one deviation of the noise. ``sigma`` is the spread of
    the values around the fit, ``drift`` the mean size of all changes. Rows without date or value don't count.
    """
    known = frame.filter("y is not null and ds is not null").select("platform", F.unix_date("ds").alias("day"), F.col("y").cast("double").alias("y"))
    ranges = known.groupBy(F.col("platform").alias("of")).agg(
        F.min("day").cast("double").alias("origin"), F.greatest(F.max("day") - F.min("day"), F.lit(1)).cast("double").alias("span"), F.greatest(F.max(F.abs("y")), F.lit(1e-12)).alias("scale"), F.count("*").alias("rows")
    )
    same = F.col("platform").eqNullSafe(F.col("of"))
    rows = known.join(ranges, same).select("platform", "day", "origin", "span", (F.col("y") / F.col("scale")).alias("y"))
    sums = _sums(rows, changes, order).groupBy("platform").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("sums"))
    per = sums.join(ranges, same).select("platform", "origin", "span", "scale", "rows", F.transform("sums", lambda s: s["value"]).alias("sums"))

    def solve(batches):
        width = 3 + changes + 2 * order
        bends = np.arange(2, 2 + changes)
        light = np.zeros(width - 1)
        light[2 + changes :] = ridge
        for batch in batches:
            coefs, sigmas, drifts = [], [], []
            for sums, n in zip(batch.column("sums").to_pylist(), batch.column("rows").to_pylist()):
                total = np.array(sums).reshape(width, width)
                gram, cross, square = total[:-1, :-1], total[:-1, -1], total[-1, -1]

                def spread(coef, free):
                    left = max(square - 2 * cross @ coef + coef @ gram @ coef, 0.0)
                    return left / max(n - free, 1)

                # The noise decides what a change costs; bends as cheap as waves show it first.
                loose = np.linalg.lstsq(gram + np.diag(light) + np.diag(np.where(np.isin(np.arange(width - 1), bends), 1e-3, 0)), cross, rcond=None)[0]
                penalty = np.zeros(width - 1)
                penalty[bends] = spread(loose, min(2 + changes + 2 * order, n // 2)) / prior
                coef = sparse_solution(gram, cross, penalty, light)
                coefs.append(coef.tolist())
                sigmas.append(float(np.sqrt(spread(coef, 2 + int((coef[bends] != 0).sum()) + 2 * order))))
                drifts.append(float(np.abs(coef[bends]).mean()) if changes else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("platform", "origin", "span", "scale", "rows")), pa.array(coefs, pa.list_(pa.float64())), pa.array(sigmas, pa.float64()), pa.array(drifts, pa.float64())],
                ["platform", "origin", "span", "scale", "rows", "coef", "sigma", "drift"],
            )

    return per.mapInArrow(solve, MODEL)


def trend_changes(models: DataFrame, changes: int = 25) -> DataFrame:
    """``platform``, ``ds`` and ``change`` of every bend that isn't zero: the change of slope in units per week."""
    bends = F.arrays_zip(F.array(*[F.lit(float(k)) for k in knots(changes)]).alias("at"), F.slice("coef", 3, changes).alias("size"))
    rows = models.select("platform", "origin", "span", "scale", F.inline(bends).alias("at", "size")).filter("size <> 0")
    day = F.round(F.col("origin") + F.col("at") * F.col("span")).cast("int")
    return rows.select("platform", F.date_from_unix_date(day).alias("ds"), (F.col("size") * F.col("scale") / F.col("span") * 7).alias("change"))


def predicted(frame: DataFrame, models: DataFrame, changes: int = 25, order: int = 3, width: float = 0.8) -> DataFrame:
    """``frame`` with ``yhat`` and the bounds ``yhat_lower`` and ``yhat_upper`` between which ``width`` of the values should lie.

    Beyond the known weeks the slope may go on changing as often as before, by the
    same mean size, so the interval widens with the third power of the distance. A platform
    without any value has no prediction.
    """
    z = NormalDist().inv_cdf(0.5 + width / 2)
    own = models.select(F.col("platform").alias("_of"), "origin", "span", "scale", "coef", "sigma", "drift")
    rows = frame.withColumn("_day", F.unix_date("ds").cast("double")).join(own, F.col("platform").eqNullSafe(F.col("_of")), "left")

    @F.arrow_udf("double")
    def fitted(day: pa.Array, origin: pa.Array, span: pa.Array, coef: pa.Array) -> pa.Array:
        some = np.flatnonzero(coef.is_valid().to_numpy(zero_copy_only=False) & day.is_valid().to_numpy(zero_copy_only=False))
        out = np.zeros(len(coef))
        if len(some):
            take = pa.array(some)
            x = features(*(c.take(take).to_numpy(zero_copy_only=False) for c in (day, origin, span)), changes, order)
            out[some] = (x * coef.take(take).flatten().to_numpy(zero_copy_only=False).reshape(x.shape)).sum(1)
        mask = np.ones(len(coef), bool)
        mask[some] = False
        return pa.array(out, mask=mask)

    beyond = F.greatest((F.col("_day") - F.col("origin")) / F.col("span") - 1, F.lit(0.0))
    wander = 2 * F.col("drift") * F.col("drift") * (changes / BENDING) * F.pow(beyond, F.lit(3)) / 3
    half = z * F.col("scale") * F.sqrt(F.col("sigma") * F.col("sigma") + wander)
    yhat = fitted("_day", "origin", "span", "coef") * F.col("scale")
    return rows.withColumn("yhat", yhat).withColumns({"yhat_lower": F.col("yhat") - half, "yhat_upper": F.col("yhat") + half}).drop("_day", "_of", "origin", "span", "scale", "coef", "sigma", "drift")


def changepoint_fit(changes: int = 25, order: int = 3, prior: float = 0.05, width: float = 0.8) -> Callable[[DataFrame], DataFrame]:
    """Fitter for ``long_forecast``: a bending trend per platform, with an interval."""

    def run(frame: DataFrame) -> DataFrame:
        weeks = frame.select("ds", "platform", "y")
        return predicted(weeks, fit_trends(weeks, changes, order, prior), changes, order, width)

    return run

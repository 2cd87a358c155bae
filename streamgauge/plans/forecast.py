"""Long weekly forecast with running totals, goals and chart frame."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamgauge.functions.numbers import truncated_percent_text
from streamgauge.functions.times import weekly_mondays, weekly_sundays
from streamgauge.plans.kpi import week_rollup, with_net_subscribers
from streamgauge.plans.trend import YEAR_DAYS, changepoint_fit


def seasonal_fit(order: int = 3, ridge: float = 1.0) -> Callable[[DataFrame], DataFrame]:
    """Fitter: straight trend plus yearly waves by penalised least squares.

    One call sees the weeks of one platform, which the calendar bounds.
    """

    def features(days: np.ndarray, origin: float, span: float) -> np.ndarray:
        trend = (days - origin) / span
        waves = [f(2 * np.pi * k * days / YEAR_DAYS) for k in range(1, order + 1) for f in (np.sin, np.cos)]
        return np.column_stack([np.ones_like(trend), trend, *waves])

    def fit_predict(weeks: pd.DataFrame) -> pd.DataFrame:
        weeks = weeks.sort_values("ds")
        days = pd.to_datetime(weeks["ds"]).to_numpy().astype("datetime64[D]").astype(float)
        y = weeks["y"].to_numpy(dtype=float)
        known = ~np.isnan(y)
        if not known.any():
            return weeks.assign(yhat=np.nan)
        origin, span = days[known].min(), max(np.ptp(days[known]), 1.0)
        x = features(days, origin, span)
        penalty = np.diag([0.0, 0.0] + [ridge] * (2 * order))
        seen = x[known]
        coef = np.linalg.lstsq(seen.T @ seen + penalty, seen.T @ y[known], rcond=None)[0]
        return weeks.assign(yhat=x @ coef)

    def run(frame: DataFrame) -> DataFrame:
        schema = "ds date, platform string, y double, yhat double"
        return frame.select("ds", "platform", "y").groupBy("platform").applyInPandas(fit_predict, schema)

    return run


def line_fit() -> Callable[[DataFrame], DataFrame]:
    """Fitter: least-squares line per platform on built-in aggregates."""

    def run(frame: DataFrame) -> DataFrame:
        platform = Window.partitionBy("platform")
        day = F.unix_date("ds")
        slope, intercept = F.regr_slope("y", day).over(platform), F.regr_intercept("y", day).over(platform)
        return frame.withColumn("yhat", slope * day + intercept)

    return run


def future_weeks(weekly: DataFrame, until, align: str = "sunday") -> DataFrame:
    """Weekly dates after the newest week up to ``until``; Sundays by default."""
    dates = {"sunday": weekly_sundays, "monday": weekly_mondays}[align]
    newest = weekly.groupBy("platform").agg(F.max("ds").alias("_newest"))
    return newest.select(
        "platform", F.explode(dates(F.col("_newest"), F.lit(until).cast("date"))).alias("ds")
    )


def running_totals(points: DataFrame) -> DataFrame:
    """Running sums of actual and predicted values; NULL actuals stay NULL."""
    w = Window.partitionBy("platform").orderBy("ds").rowsBetween(Window.unboundedPreceding, 0)
    return points.withColumn(
        "actual_running_sub", F.when(F.col("y").isNotNull(), F.sum("y").over(w))
    ).withColumn("predicted_running_sub", F.sum("yhat").over(w))


def long_forecast(
    daily: DataFrame,
    until,
    fitter: Callable[[DataFrame], DataFrame] | None = None,
    align: str = "sunday",
) -> DataFrame:
    """Net subscribers per week, predicted up to ``until``, with running totals; a bending trend unless a fitter is given."""
    weekly = week_rollup(with_net_subscribers(daily), ["net_subscribers"]).select(
        F.col("week_commencing_dt").alias("ds"), "platform", F.col("net_subscribers").cast("double").alias("y")
    )
    frame = weekly.unionByName(future_weeks(weekly, until, align), allowMissingColumns=True)
    return running_totals((fitter or changepoint_fit())(frame))


def goal_deviation(forecast: DataFrame, goals: Mapping[str, float]) -> DataFrame:
    """Whole percent by which the running prediction misses each goal, as one text per platform."""
    goal = F.create_map(*[x for d, g in goals.items() for x in (F.lit(d).cast("date"), F.lit(float(g)))])
    reached = forecast.filter(F.col("ds").isin([F.lit(d).cast("date") for d in goals]))
    share = F.col("predicted_running_sub") / goal[F.col("ds")] - 1
    texts = F.collect_list(F.struct("ds", truncated_percent_text(share).alias("text")))
    joined = F.array_join(F.transform(F.array_sort(texts), lambda t: t["text"]), " ")
    return reached.groupBy("platform").agg(joined.alias("deviation"))


def current_total(forecast: DataFrame) -> DataFrame:
    """Sum of the actual weekly values, fraction cut off."""
    return forecast.groupBy("platform").agg(F.sum("y").cast("long").alias("current_subs"))


def forecast_chart(forecast: DataFrame, start) -> DataFrame:
    """Line values from ``start`` on, with the label points repeated on each row.

    ``predicted_line`` is set only where no actual total exists. The first
    actual total is the lowest and the last predicted total the highest value,
    as each side is ordered by itself.
    """
    rows = forecast.filter(F.col("ds") >= F.lit(start).cast("date"))
    missing = F.col("actual_running_sub").isNull()
    platform = Window.partitionBy("platform")
    back = F.row_number().over(platform.orderBy(F.col("ds").desc()))
    rows = rows.withColumn("predicted_line", F.when(missing, F.col("predicted_running_sub"))).withColumn("_back", back)
    return rows.select(
        "platform",
        "ds",
        "actual_running_sub",
        "predicted_line",
        F.min("ds").over(platform).alias("first_ds"),
        F.min("actual_running_sub").over(platform).alias("first_total"),
        F.max("ds").over(platform).alias("last_ds"),
        F.max(F.when(F.col("_back") == 7, F.col("ds"))).over(platform).alias("label_ds"),
        F.max("predicted_running_sub").over(platform).alias("last_total"),
        F.min(F.when(missing, F.col("ds"))).over(platform).alias("forecast_ds"),
    )

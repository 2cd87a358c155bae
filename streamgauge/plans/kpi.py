"""Weekly performance against a fitted line, monthly trends, KPI cards.

Everything after the weekly or monthly sums works on calendar rows (at most
53 weeks a year per platform), so the windows over them stay small whatever
the size of the daily table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamgauge.functions.numbers import grouped_2dp, grouped_int, percent_text, ratio, relative_change, whole
from streamgauge.functions.times import month_start, week_start
from streamgauge.operators.latest import newest_n

# Kinds of points in a weekly comparison.
ACTUAL = "ACTUAL"
COMPARED = "COMPARISON - ACTUAL"
PREDICTED = "COMPARISON - PREDICTED"

# The cards and their metric, or two metrics for a ratio.
CARDS = {
    "Subscribers": ["net_subscribers"],
    "Comments": ["comments_count"],
    "Views": ["views_count"],
    "Shares": ["shares_count"],
    "Likes": ["likes_count"],
    "Dislikes": ["dislikes_count"],
    "Watch Time (min)": ["estimated_watch_minutes"],
    "Avg. View Duration (min)": ["estimated_watch_minutes", "views_count"],
}


def with_net_subscribers(daily: DataFrame) -> DataFrame:
    return daily.withColumn("net_subscribers", F.col("subscribers_gained") - F.col("subscribers_lost"))


def _period_sums(daily: DataFrame, period: Column, name: str, metrics: Sequence[str]) -> DataFrame:
    return daily.groupBy(period.alias(name), "platform").agg(*[F.sum(m).alias(m) for m in metrics])


def week_rollup(daily: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Sums per Monday week and platform."""
    return _period_sums(daily, week_start(F.col("metric_date")), "week_commencing_dt", metrics)


def month_rollup(daily: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Sums per calendar month and platform."""
    return _period_sums(daily, month_start(F.col("metric_date")), "month_start_dt", metrics)


def recent_weeks(weekly: DataFrame, keys: Sequence[str], n: int = 12) -> DataFrame:
    """The ``n + 1`` weeks before the newest: ``n`` to fit and one to compare."""
    rows = newest_n(weekly, keys, "week_commencing_dt", 2, n + 2)
    kind = F.when(F.col("rank") == 2, COMPARED).otherwise(ACTUAL)
    return rows.withColumn("point_type", kind).drop("rank")


def line_forecast(points: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Least-squares line per metric over the fitted weeks, read off one week later."""
    day = F.unix_date("week_commencing_dt")
    fit = [f(F.col(m), day).alias(f"{tag}_{m}") for m in metrics for f, tag in ((F.regr_slope, "_a"), (F.regr_intercept, "_b"))]
    lines = (
        points.filter(F.col("point_type") == ACTUAL)
        .groupBy(*keys)
        .agg(F.date_add(F.max("week_commencing_dt"), 7).alias("week_commencing_dt"), *fit)
    )
    return lines.select(
        *keys,
        "week_commencing_dt",
        F.lit(PREDICTED).alias("point_type"),
        *[(F.col(f"_a_{m}") * day + F.col(f"_b_{m}")).alias(m) for m in metrics],
    )


def weekly_deviation(daily: DataFrame, metrics: Sequence[str] | str, n: int = 12) -> DataFrame:
    """Recent weeks plus the prediction for the compared week, rounded to whole numbers.

    Two metrics also give ``derived_metric``, the first divided by the second.
    """
    metrics = [metrics] if isinstance(metrics, str) else list(metrics)
    points = recent_weeks(week_rollup(daily, metrics), ["platform"], n)
    predicted = line_forecast(points, ["platform"], metrics)
    predicted = predicted.withColumns({m: whole(F.col(m)) for m in metrics})
    rows = points.withColumns({m: F.col(m).cast("double") for m in metrics}).unionByName(predicted)
    if len(metrics) == 2:
        rows = rows.withColumn("derived_metric", ratio(F.col(metrics[0]), F.col(metrics[1])))
    return rows


def kpi_cards(daily: DataFrame, cards: Mapping[str, Sequence[str]] = CARDS, n: int = 12) -> DataFrame:
    """Total and last-week deviation of every card as text, from one scan of the daily table."""
    needed = sorted({m for ms in cards.values() for m in ms})
    weekly = week_rollup(daily, needed)
    entries = [
        F.struct(
            F.lit(name).alias("card"),
            F.lit(len(ms) == 2).alias("is_ratio"),
            F.col(ms[0]).cast("double").alias("top"),
            (F.col(ms[1]) if len(ms) == 2 else F.lit(None)).cast("double").alias("bottom"),
        )
        for name, ms in cards.items()
    ]
    long = weekly.select("week_commencing_dt", "platform", F.inline(F.array(*entries)))
    keys = ["platform", "card", "is_ratio"]
    totals = long.groupBy(*keys).agg(F.sum("top").alias("top"), F.sum("bottom").alias("bottom"))
    value = F.when(F.col("is_ratio"), ratio(F.col("top"), F.col("bottom"))).otherwise(F.col("top"))
    text = F.when(F.col("is_ratio"), grouped_2dp(value)).otherwise(grouped_int(value))
    totals = totals.select("platform", "card", text.alias("total"))

    points = recent_weeks(long, keys, n)
    predicted = line_forecast(points, keys, ["top", "bottom"])
    predicted = predicted.withColumns({m: whole(F.col(m)) for m in ("top", "bottom")})
    last = (
        points.filter(F.col("point_type") == COMPARED)
        .unionByName(predicted)
        .withColumn("value", value)
        .groupBy("platform", "card")
        .agg(
            F.max("week_commencing_dt").alias("week"),
            F.max(F.when(F.col("point_type") == COMPARED, F.col("value"))).alias("actual"),
            F.max(F.when(F.col("point_type") == PREDICTED, F.col("value"))).alias("predicted"),
        )
    )
    deviation = F.concat(
        F.lit("WC "),
        F.date_format("week", "dd MMM yyyy"),
        F.lit(": "),
        percent_text(relative_change(F.col("predicted"), F.col("actual"))),
        F.lit(" vs forecast"),
    )
    return totals.join(last.select("platform", "card", deviation.alias("deviation")), ["platform", "card"], "left")


def kpi_summary(daily: DataFrame, metrics: Sequence[str] | str, n: int = 12) -> DataFrame:
    """Total and deviation text of one card."""
    metrics = [metrics] if isinstance(metrics, str) else list(metrics)
    return kpi_cards(daily, {" / ".join(metrics): metrics}, n)


def monthly_trend(daily: DataFrame, metrics: Sequence[str] | str, n: int = 12) -> DataFrame:
    """The ``n`` months before the newest; first and last carry a rounded ``end_label``."""
    metrics = [metrics] if isinstance(metrics, str) else list(metrics)
    months = newest_n(month_rollup(daily, metrics), ["platform"], "month_start_dt", 2, n + 1)
    shown = metrics[0]
    if len(metrics) == 2:
        months = months.withColumn("derived_metric", ratio(F.col(metrics[0]), F.col(metrics[1])))
        shown = "derived_metric"
    oldest = F.max("rank").over(Window.partitionBy("platform"))
    label = F.when((F.col("rank") == 2) | (F.col("rank") == oldest), whole(F.col(shown).cast("double")))
    return months.withColumn("end_label", label).drop("rank")


def total_and_ratio(daily: DataFrame, top: str, bottom: str) -> DataFrame:
    """Totals of two metrics and their ratio."""
    return daily.agg(
        F.sum(top).alias("total"), F.try_divide(F.sum(top), F.sum(bottom)).alias("ratio")
    )

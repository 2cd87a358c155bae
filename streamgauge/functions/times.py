"""Durations, calendar periods and minute buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: the grammar of durations without years and months.
DURATION = r"^P(?=[\dT])(\d+W)?(\d+D)?(T(?=\d)(\d+H)?(\d+M)?(\d+(\.\d+)?S)?)?$"


def iso_duration_seconds(text: Column) -> Column:
    """Seconds of an ISO-8601 duration made of weeks, days, hours, minutes, seconds; other text is an error."""

    def part(pattern: str, seconds: int) -> Column:
        found = F.regexp_extract(text, pattern, 1).try_cast("double")
        return F.coalesce(found, F.lit(0.0)) * seconds

    total = (
        part(r"^P(\d+)W", 604800)
        + part(r"^P(?:\d+W)?(\d+)D", 86400)
        + part(r"T(\d+)H", 3600)
        + part(r"T(?:\d+H)?(\d+)M", 60)
        + part(r"T(?:\d+[HM])*([\d.]+)S", 1)
    )
    wrong = F.raise_error(F.concat(F.lit("not a duration: "), text)).cast("double")
    return F.when(text.rlike(DURATION), total).when(text.isNotNull(), wrong)


def week_start(day: Column) -> Column:
    """Monday of the week of ``day``."""
    return F.date_trunc("week", day).cast("date")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def bucket_start(seconds: Column, width: int = 60) -> Column:
    """Lower bound of the ``width``-second bucket, as a whole number."""
    return (F.floor(seconds / width) * width).cast("long")


def weekly_sundays(after: Column, until: Column) -> Column:
    """Sundays from one week after ``after`` up to ``until``; empty if there are none."""
    first = F.next_day(F.date_add(after, 6), "SUN")
    return F.when(
        first <= until, F.sequence(first, until, F.expr("interval 7 days"))
    ).otherwise(F.array().cast("array<date>"))


def weekly_mondays(after: Column, until: Column) -> Column:
    first = F.next_day(F.date_add(after, 6), "MON")
    return F.when(
        first <= until, F.sequence(first, until, F.expr("interval 7 days"))
    ).otherwise(F.array().cast("array<date>"))

"""Ratios, rounding and number text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """``a / b``; NULL where ``b`` is 0."""
    return F.try_divide(a, b)


def relative_change(predicted: Column, actual: Column) -> Column:
    """``actual / predicted - 1``; 0 where it is not defined."""
    return F.coalesce(F.try_divide(actual, predicted) - 1, F.lit(0.0))


def whole(x: Column) -> Column:
    """Whole number, ties to even; noise of float arithmetic does not decide a tie."""
    return F.bround(F.round(x, 6), 0)


def grouped_int(x: Column) -> Column:
    """Whole number with thousands separators, fraction cut off."""
    return F.format_number(x.cast("long"), 0)


def grouped_2dp(x: Column) -> Column:
    return F.format_number(x, 2)


def percent_text(share: Column) -> Column:
    """Share as whole percent, ties to even."""
    return F.concat(whole(share * 100).cast("long").cast("string"), F.lit("%"))


def truncated_percent_text(share: Column) -> Column:
    """Share as whole percent, fraction cut off."""
    return F.concat((share * 100).cast("long").cast("string"), F.lit("%"))


def percent_bucket(position: Column, longest: Column) -> Column:
    """Whole percent of the stream at ``position`` (both in seconds).

    Divides minutes by minutes before scaling, so borders fall as they do for
    per-minute positions.
    """
    share = F.try_divide(position / 60, longest / 60)
    return F.floor(share * 100).cast("long")

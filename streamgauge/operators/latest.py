"""Newest row per key.

``row_number() = 1`` lets Catalyst place a group limit before the shuffle, so
each map task sends at most one row per key and a key that holds a large part
of the table costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def latest_per(df: DataFrame, keys: Sequence[str | Column], ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """The newest row per ``keys``; ``tie`` columns decide between equal times."""
    order = [F.col(c).desc() for c in (ts, *tie)]
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def latest_per_day(df: DataFrame, key: str, ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """The newest row per key and load day."""
    return latest_per(df, [key, F.to_date(ts)], ts, tie)


def newest_n(df: DataFrame, keys: Sequence[str], order: str, first: int, last: int, rank: str = "rank") -> DataFrame:
    """Rows ranked ``first``..``last`` from the newest, per ``keys``."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return (
        df.withColumn(rank, F.row_number().over(w))
        .filter(F.col(rank) <= last)
        .filter(F.col(rank) >= first)
    )

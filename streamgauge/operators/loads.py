"""Load patterns: version detection and incremental loads.

Every function takes the batch and the current target as DataFrames and
returns the rows to write; ``sources.tables`` does the writing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamgauge.functions.hashing import version_hash
from streamgauge.operators.joins import keep_unseen
from streamgauge.operators.latest import latest_per, latest_per_day

HASH = "hashdiff"


def hash_versions(
    df: DataFrame,
    key: str,
    attributes: Sequence[str],
    ts: str = "load_ts",
    tie: Sequence[str] = (),
    daily: bool = True,
    null_token: str | None = None,
) -> DataFrame:
    """One row per distinct version of a key: newest per day, hash, newest per hash."""
    rows = latest_per_day(df, key, ts, tie) if daily else df
    hashed = rows.withColumn(HASH, version_hash(rows, attributes, null_token))
    return latest_per(hashed, [key, HASH], ts, tie)


def changed_versions(versions: DataFrame, key: str, ts: str = "load_ts", tie: Sequence[str] = ()) -> DataFrame:
    """Rows whose hash differs from the row before, so a return to an old value counts.

    Expects one row per key and load day, as ``latest_per_day`` leaves them.
    """
    w = Window.partitionBy(key).orderBy(ts, *tie)
    before = F.lag(HASH).over(w)
    return (
        versions.withColumn("_before", before)
        .filter(F.col("_before").isNull() | (F.col("_before") != F.col(HASH)))
        .drop("_before")
    )


def new_keys(batch: DataFrame, target: DataFrame | None, keys: Sequence[str], spread_by: Sequence[str] | None = None) -> DataFrame:
    """Rows of the batch whose keys the target does not hold; all rows on a first run."""
    return batch if target is None else keep_unseen(batch, target, keys, spread_by)


def new_versions(batch: DataFrame, target: DataFrame | None, key: str) -> DataFrame:
    """Versions of the batch, unique by (key, hash), that the target does not hold."""
    if target is None:
        return batch
    return batch.join(target.select(key, HASH), [key, HASH], "left_anti")


def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target without all keys of the batch, plus the batch."""
    return keep_unseen(target, batch, keys).unionByName(batch, allowMissingColumns=True)


def lookback(rows: DataFrame, loaded: DataFrame | None, date: str, today, days: int = 7, origin=None) -> DataFrame:
    """Rows from ``days`` before the newest loaded date up to ``today``.

    Without loaded rows, or on a full reload, the window starts at ``origin``;
    without an origin either it has no start.
    """
    start, end = F.lit(origin).cast("date"), F.lit(today).cast("date")
    if loaded is not None:
        start = F.coalesce(loaded.select(F.date_sub(F.max(date), days)).scalar(), start)
    return rows.filter((start.isNull() | (F.col(date) >= start)) & (F.col(date) <= end))

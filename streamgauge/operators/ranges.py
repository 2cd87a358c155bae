"""Ranks and running sums by ranges of the sorted rows.

Rows are sorted once into ranges that lie one after the other, whatever their
keys: a key with a third of all rows fills a third of the ranges. Windows run
inside ``(range, key)``, and a summary with one row per range and key carries
what the ranges before add up to. Keys and order columns may be NULL and of any
type that sorts; NULL comes first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamgauge.session import materialize

RANGE = "_range"


def in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "ranges") -> DataFrame:
    """The rows with the number of their range, stored: ranges are drawn from a sample, so they must not be drawn again."""
    return materialize(df.repartitionByRange(*keys, *order).withColumn(RANGE, F.spark_partition_id()), name)


def _with_carry(rows: DataFrame, keys: Sequence[str], totals: Mapping[str, Column]) -> DataFrame:
    """``rows`` with the sums of ``totals`` over all earlier ranges of the same key; NULL where there is none."""
    parts = rows.groupBy(*keys, RANGE).agg(*[total.alias(name) for name, total in totals.items()])
    earlier = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    renamed = [F.col(k).alias(f"_of_{i}") for i, k in enumerate(keys)]
    carried = parts.select(*renamed, F.col(RANGE).alias("_in"), *[F.sum(name).over(earlier).alias(name) for name in totals])
    carried = carried.filter(F.coalesce(*[F.col(name) for name in totals]).isNotNull())
    same = F.col(RANGE) == F.col("_in")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{i}"))
    return rows.join(carried, same, "left").drop("_in", *[f"_of_{i}" for i in range(len(keys))])


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Place of each row among those of its key, from 0, in rising order.

    Rows that agree in ``order``, too, get places one after the other, which ones is open.
    """
    rows = _with_carry(in_ranges(df, keys, order), keys, {"_before": F.count("*")})
    inside = Window.partitionBy(RANGE, *keys).orderBy(*order)
    place = F.row_number().over(inside) - 1 + F.coalesce("_before", F.lit(0))
    return rows.withColumn(out, place.cast("long")).drop("_before", RANGE)


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Running sums within each key: ``sums`` maps an output name to the column that is added up.

    A NULL adds nothing, and before the first value the sum is NULL. ``order`` is unique within a key.
    """
    names = {f"_before_{i}": (out, value) for i, (out, value) in enumerate(sums.items())}
    rows = _with_carry(in_ranges(df, keys, order), keys, {b: F.sum(value) for b, (_, value) in names.items()})
    inside = Window.partitionBy(RANGE, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    for before, (out, value) in names.items():
        near = F.sum(value).over(inside)
        rows = rows.withColumn(out, F.coalesce(near + F.col(before), near, F.col(before)))
    return rows.drop(RANGE, *names)

"""Exact medians of groups of any size, by counting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamgauge.session import materialize

#: Bits of a value that one pass counts by; four passes see all 64.
DIGIT = 16


def ordered_bits(x: Column) -> Column:
    """A whole number for each double that sorts like it; both zeros are one, NaN is the largest.

    The bits of a double sort like the number itself once the bits below the sign
    of negative ones are turned round.
    """
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), x + F.lit(0.0)).cast("long")
    return F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit((1 << 63) - 1)))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str, store: bool = True) -> DataFrame:
    """Interpolated median of ``value`` per ``keys``; NULLs are left out.

    Selection by counting. A first pass counts the rows of all groups by the top 16
    of 64 order-preserving bits; the counts tell under which digit the one or two
    middle ranks lie, and how many ranks are left below it. Each further pass counts the rows that share
    the digits found so far by their next 16 bits. Counts add up before the
    shuffle, so a task ships at most 65,536 rows a group however many rows it has; no pass sorts, gathers or
    samples rows. Every pass reads all values, so they are stored once, while the plan is
    built; ``store=False`` leaves that out where ``df`` is a scan itself. Without ``keys``
    the result is one row.
    """
    group = list(keys) or ["_all"]
    rows = df.filter(F.col(value).isNotNull()).withColumn("_x", F.col(value).cast("double"))
    if not keys:
        rows = rows.withColumn("_all", F.lit(0))
    rows = rows.select(*group, "_x", ordered_bits(F.col("_x")).alias("_bits"))
    if store:
        rows = materialize(rows, "median_values")

    def counted(live: DataFrame, shift: int, *carried: Column) -> DataFrame:
        return live.withColumn("_next", F.shiftright("_bits", shift)).groupBy(*group, "_next").agg(F.count("*").alias("_n"), *carried)

    def held(counts: DataFrame) -> DataFrame:
        """The digits under which a middle rank lies, with the ranks left inside."""
        place = Window.partitionBy(*group, "_digits").orderBy("_next")
        before = counts.withColumn("_before", F.sum("_n").over(place) - F.col("_n"))
        inside = {r: F.when((F.col("_before") < F.col(r)) & (F.col(r) <= F.col("_before") + F.col("_n")), F.col(r) - F.col("_before")) for r in ("_low", "_high")}
        found = before.withColumns(inside).filter("_low is not null or _high is not null")
        return found.drop("_before", "_digits").withColumnRenamed("_next", "_digits")

    first = counted(rows, 64 - DIGIT)
    total = F.sum("_n").over(Window.partitionBy(*group))
    targets = held(first.withColumns({"_low": F.floor((total + 1) / 2), "_high": F.floor(total / 2) + 1, "_digits": F.lit(0)}))
    for shift in range(64 - 2 * DIGIT, -1, -DIGIT):
        known = targets.select(*[F.col(g).alias(f"_of_{g}") for g in group], "_digits", "_low", "_high")
        same = F.shiftright("_bits", shift + DIGIT) == F.col("_digits")
        for g in group:
            same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
        # What a group carries is the same on all rows of one prefix.
        carried = [F.max(c).alias(c) for c in ("_digits", "_low", "_high")]
        targets = held(counted(rows.join(known, same), shift, *carried, F.max("_x").alias("_x")))
    middle = targets.groupBy(*group).agg(F.max(F.when(F.col("_low").isNotNull(), F.col("_x"))).alias("_a"), F.max(F.when(F.col("_high").isNotNull(), F.col("_x"))).alias("_b"))
    return middle.select(*keys, F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise((F.col("_a") + F.col("_b")) / 2).alias(out))

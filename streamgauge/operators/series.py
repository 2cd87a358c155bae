"""Window operators over long ordered series.

A series (one video's minutes, say) may hold a third of a table, so no window
here is partitioned by the series key alone. A series is cut into chunks of
the order column; rows are windowed inside ``(key, chunk)``, and what a chunk
needs from earlier or later chunks comes from a summary with one row per
chunk. A chunk without a neighbour has no summary row to join, so for short
series the carried side is empty and AQE drops the join.

The order column is numeric and, with the keys, unique. A chunk therefore
holds at most ``span`` rows of a whole-numbered order column.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamgauge.operators.joins import spread_join

CHUNK = "_chunk"
SPAN = 60 * 4096  # seconds; 4096 minute rows


def with_chunk(df: DataFrame, order: str, span: float = SPAN) -> DataFrame:
    return df.withColumn(CHUNK, F.floor(F.col(order) / F.lit(span)).cast("long"))


def _inside(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys, CHUNK).orderBy(order)


def _across(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(CHUNK)


def _neighbour(df, keys, order, value, out, span, step) -> DataFrame:
    chunked = with_chunk(df, order, span)
    edge = F.max_by if step > 0 else F.min_by
    shift = F.lag if step > 0 else F.lead
    edges = chunked.groupBy(*keys, CHUNK).agg(edge(value, order).alias("_edge"))
    carried = (
        edges.select(
            *keys,
            CHUNK,
            shift("_edge").over(_across(keys)).alias("_carry"),
            shift(F.lit(True)).over(_across(keys)).alias("_has_carry"),
        )
        .filter("_has_carry")
        .drop("_has_carry")
    )
    near = shift(value).over(_inside(keys, order))
    is_edge = shift(F.lit(True)).over(_inside(keys, order)).isNull()
    return (
        chunked.join(carried, [*keys, CHUNK], "left")
        .withColumn(out, F.when(is_edge, F.col("_carry")).otherwise(near))
        .drop("_carry", CHUNK)
    )


def previous_value(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, span: float = SPAN) -> DataFrame:
    """``value`` of the row before; NULL on the first row of a series."""
    return _neighbour(df, keys, order, value, out, span, 1)


def next_value(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, span: float = SPAN) -> DataFrame:
    """``value`` of the row after; NULL on the last row of a series."""
    return _neighbour(df, keys, order, value, out, span, -1)


def change(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, span: float = SPAN) -> DataFrame:
    """``value`` minus the value before; NULL on the first row."""
    before = previous_value(df, keys, order, value, "_before", span)
    return before.withColumn(out, F.col(value) - F.col("_before")).drop("_before")


def run_length(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    hit: Column | Callable[[Column], Column],
    out: str,
    value: str | None = None,
    before: str = "_before",
    span: float = SPAN,
) -> DataFrame:
    """Length of the unbroken run of ``hit`` rows that ends on each row; 0 on a miss.

    With ``value``, ``hit`` is a function of the previous row's value, which is
    kept as ``before``: both come from the same pass.
    """
    chunked = with_chunk(df, order, span)
    inside, across = _inside(keys, order), _across(keys)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    first = F.col("_at") == 1

    def is_hit(previous: Column) -> Column:
        return F.coalesce(hit if value is None else hit(previous), F.lit(False))

    def placed(rows: DataFrame) -> DataFrame:
        at = rows.withColumn("_at", F.row_number().over(inside))
        return at if value is None else at.withColumn("_near", F.lag(value).over(inside))

    def runs(rows: DataFrame, condition: Column) -> DataFrame:
        missed = F.max(F.when(~condition, F.col("_at"))).over(upto)
        return rows.withColumn("_missed", missed).withColumn("_run", F.col("_at") - F.coalesce("_missed", F.lit(0)))

    # Per chunk: the run that reaches its end, and whether a miss precedes it.
    # When conditions look back, the first row is judged once the previous
    # chunk's last value is known, and counts as a hit until then.
    near = is_hit(F.col("_near")) if value else is_hit(F.lit(None))
    ends = (
        runs(placed(chunked), first | near if value else near)
        .groupBy(*keys, CHUNK)
        .agg(
            F.max_by("_run", order).alias("_tail"),
            F.max("_missed").isNotNull().alias("_broken"),
            *([F.min_by(value, order).alias(value), F.max_by(value, order).alias("_last")] if value else []),
        )
    )
    if value:
        ends = ends.withColumn("_seen", F.lag("_last").over(across))
        opens = is_hit(F.col("_seen"))
        ends = ends.withColumn("_tail", F.col("_tail") - (~F.col("_broken") & ~opens).cast("int"))
        ends = ends.withColumn("_broken", F.col("_broken") | ~opens)
    since_break = Window.partitionBy(*keys, "_breaks").orderBy(CHUNK)
    carried = (
        ends.withColumn("_breaks", F.count_if("_broken").over(across))
        .withColumn("_open", F.sum("_tail").over(since_break))
        .select(
            *keys,
            CHUNK,
            F.lag("_open").over(across).alias("_carry"),
            *([F.col("_seen")] if value else []),
        )
        .filter(F.col("_carry").isNotNull())
    )
    rows = placed(chunked.join(carried, [*keys, CHUNK], "left"))
    if value:
        rows = rows.withColumn(before, F.when(first, F.col("_seen")).otherwise(F.col("_near")))
    rows = runs(rows, is_hit(F.col(before)) if value else is_hit(F.lit(None)))
    run = F.col("_run") + F.when(F.col("_missed").isNull(), F.coalesce("_carry", F.lit(0))).otherwise(0)
    return rows.withColumn(out, run.cast("long")).drop("_at", "_near", "_seen", "_missed", "_run", "_carry", CHUNK)


def fill_linear(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, span: float = SPAN) -> DataFrame:
    """``value`` with gaps filled on the straight line between the known rows on both sides.

    A gap at the end takes the last known value, one at the start stays NULL. Both
    neighbours of a gap may lie any number of chunks away: a chunk's summary has
    its first and last known row, and each chunk gets the nearest ones before and after it.
    """
    chunked = with_chunk(df, order, span).withColumn("_known", F.when(F.col(value).isNotNull(), F.struct(F.col(order).cast("double").alias("at"), F.col(value).cast("double").alias("v"))))
    at = F.col("_known.at")
    ends = chunked.groupBy(*keys, CHUNK).agg(F.min_by("_known", at).alias("_first"), F.max_by("_known", at).alias("_last"))
    across, inside = _across(keys), _inside(keys, order)
    carried = ends.select(
        *keys,
        CHUNK,
        F.last("_last", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.first("_first", ignorenulls=True).over(across.rowsBetween(1, Window.unboundedFollowing)).alias("_after"),
    ).filter("_before is not null or _after is not null")
    rows = chunked.join(carried, [*keys, CHUNK], "left").withColumns(
        {
            "_low": F.coalesce(F.last("_known", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)), F.col("_before")),
            "_high": F.coalesce(F.first("_known", ignorenulls=True).over(inside.rowsBetween(0, Window.unboundedFollowing)), F.col("_after")),
        }
    )
    step = F.try_divide(F.col("_high.v") - F.col("_low.v"), F.col("_high.at") - F.col("_low.at"))
    line = F.col("_low.v") + step * (F.col(order) - F.col("_low.at"))
    filled = F.coalesce(F.col(value).cast("double"), line, F.col("_low.v"))
    return rows.withColumn(out, filled).drop("_known", "_before", "_after", "_low", "_high", CHUNK)


def attach_group(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    aggregates: Mapping[str, tuple[str, str]],
    source: DataFrame | None = None,
    span: float = SPAN,
    salts: int = 1,
) -> DataFrame:
    """Put whole-series ``max``/``min``/``sum``/``count`` values on every row.

    ``aggregates`` maps an output name to ``(function, column)``. Values are
    combined per chunk before the shuffle and joined back per chunk, so a long
    series is neither gathered nor joined in one place. ``source`` may name a
    cheaper table with the same keys and order values to aggregate instead.
    Where order values repeat, so that a chunk has no size limit, ``salts``
    above 1 divides each chunk for the join.
    """
    merge = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.sum}
    partial = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.count}
    chunked = with_chunk(df, order, span)
    parts = (chunked if source is None else with_chunk(source, order, span)).groupBy(*keys, CHUNK).agg(
        *[partial[fn](col).alias(name) for name, (fn, col) in aggregates.items()]
    )
    series = Window.partitionBy(*keys)
    totals = parts.select(
        *keys, CHUNK, *[merge[fn](name).over(series).alias(name) for name, (fn, _) in aggregates.items()]
    )
    if salts > 1:
        return spread_join(chunked, totals, [*keys, CHUNK], "left", salts=salts).drop(CHUNK)
    return chunked.join(totals, [*keys, CHUNK], "left").drop(CHUNK)

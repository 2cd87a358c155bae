"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamgauge.llm.common import WORD, stored

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The words that each source contributes.

    ``totals`` has one row per source (``source``, ``source_size``). Sources in
    code point order, null last, take ``weights`` in turn. All targets together
    are ``share`` of all words; a target stops at ``most`` times its source, and
    what it leaves is shared by the others in the same proportions. The level at
    which that ends is found without iteration: sources fill up in the order of
    their words per weight. The windows run over sources, not over documents.
    """
    ranked = totals.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    by_need = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    after = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        ranked.withColumn("weight", weight)
        .withColumn("level", (share * F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(after))
        .withColumn("open", most * F.col("source_size") >= F.col("level") * F.col("weight"))
    )
    level = F.min_by("level", F.when(F.col("open"), F.struct(F.col("source_size") / F.col("weight"), F.col("place")))).over(everything)
    return levels.withColumn("at", level).select(
        "source", "source_size", F.coalesce(F.least((most * F.col("source_size")).cast("double"), F.col("at") * F.col("weight")), (most * F.col("source_size")).cast("double")).alias("target")
    )


def systematic_sample(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """How often each document enters a mix of its sources in given weights.

    Every document of a source is expected ``target / source_size`` times. In
    the order of size the expectations are added up, one offset per source (from
    its name, so reruns agree) is added, and a document is taken once for each
    whole number that its own step crosses. Neighbours in that order have about
    the same size, so the words taken lie within about one document of the
    target. Returns ``doc_id``, ``source``, ``size``, ``source_size``,
    ``target``, ``copies`` and ``taken``, a row for each row of ``docs``.

    Ranks within a source are counted over ranges of the sorted rows, so a source
    with a third of all rows is spread over tasks like any other. Null or empty
    texts have size 0 and are numbered like others; a null source is a source of
    its own; repeated rows count each; an empty table gives an empty table; other
    columns are ignored.
    """
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    order = ["source", "size", "scatter", "doc_id"]
    ranges = stored(
        sized.withColumn("scatter", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
        .repartitionByRange(*order)
        .select(*order, F.spark_partition_id().alias("range")),
        "mix_ranges",
    )
    pieces = ranges.groupBy("source", "range").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    targets = source_targets(pieces.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    pieces = pieces.withColumn("before", F.sum("rows").over(Window.partitionBy("source").orderBy("range")) - F.col("rows"))
    carried = (
        pieces.alias("p").join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")))
        .select(F.col("p.source").alias("of"), F.col("range").alias("in"), "before", "source_size", "target")
    )
    rank = F.row_number().over(Window.partitionBy("range", "source").orderBy("size", "scatter", "doc_id"))
    offset = (F.conv(F.substring(F.md5(key), 1, 4), 16, 10).cast("double") + 0.5) / 65536
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (
        ranges.withColumn("rank", rank)
        .join(carried, (F.col("range") == F.col("in")) & F.col("source").eqNullSafe(F.col("of")))
        .withColumn("rank", F.col("rank") + F.col("before"))
        .withColumn("copies", F.floor(offset + rate * F.col("rank")) - F.floor(offset + rate * (F.col("rank") - 1)))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )

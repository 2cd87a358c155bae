"""Benchmark passages in training text: spaced seeds, then an overlap that tolerates substitutions.

DataFrame functions only.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamgauge.llm.common import stored

#: Fixed masks: the positions they look at; the first ignores position 3, the second 1 and 2. By enumeration no quarter
#: of substituted tokens in 9 to 20 spoils all places of both, and no single spaced mask of four tokens does as well.
MASKS = ((0, 1, 2, 4), (0, 3, 4, 5))
#: Items of fewer tokens than this have no place for a mask under every allowed substitution; they must stand verbatim.
MASKED = 9
#: An overlap counts if SHARE of the tokens of some stretch of WINDOW of an item stand in the document in step.
WINDOW, SHARE = 20, 0.75
#: Most rows of a side that is sent to all tasks, some 10 MB; a larger one is joined by shuffles.
MOST_BROADCAST = 200_000


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


Mask = tuple[int, tuple[int, ...]]


def _masks(runs: list[int]) -> list[Mask]:
    """The fixed masks, and one for each length of a verbatim item that looks at all its tokens, with their numbers."""
    return [*enumerate(MASKS), *[(1000 + n, tuple(range(n))) for n in runs]]


def _seed(mask: Mask, at: Column) -> Column:
    """Hash of the tokens that a mask looks at from position ``at`` (from 0) of the token hashes ``codes``; null beyond their end."""
    number, looks = mask
    return F.when(at + looks[-1] < F.size("codes"), F.xxhash64(F.lit(number), *[F.get("codes", at + i) for i in looks]))


def _places() -> Column:
    return F.when(F.size("codes") > 0, F.sequence(F.lit(0), F.greatest(F.size("codes") - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _seeds(df: DataFrame, keep: list[str], places: Column, masks: list[Mask]) -> DataFrame:
    """A row for each of ``places`` (``at``) and mask, with the ``seed`` there.

    Outer explodes: the others would have Spark test the arrays for emptiness in a
    filter below, which computes all that leads to them anew for each position.
    """
    placed = df.select(*keep, "codes", F.explode_outer(places).alias("at")).filter(F.col("at").isNotNull())
    return placed.select(*keep, "at", F.explode_outer(F.array(*[_seed(m, F.col("at")) for m in masks])).alias("seed")).filter("seed is not null")


#: A table of 64 * 2 ** SLOT_BITS bits tells most seeds apart that no item has; beyond some million seeds it lets all pass.
SLOT_BITS = 14


def _slot(seed: Column) -> Column:
    return F.shiftrightunsigned(seed, 64 - SLOT_BITS).cast("int")


def _bit(seed: Column) -> Column:
    return F.shiftrightunsigned(seed, 58 - SLOT_BITS).bitwiseAND(63).cast("int")


def _bit_table(seeds: DataFrame) -> DataFrame:
    """One row with the bits of all seeds, as an array of fixed size."""
    set_bits = seeds.select(_slot(F.col("seed")).alias("slot"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(seed, {58 - SLOT_BITS}) & 63 as int))").alias("bit"))
    every = seeds.sparkSession.range(1 << SLOT_BITS).select(F.col("id").cast("int").alias("slot"))
    full = every.join(set_bits.groupBy("slot").agg(F.bit_or("bit").alias("bits")), "slot", "left").select("slot", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return full.agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "bits"))), lambda x: x["bits"]).alias("table"))


def _small(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if its counted rows are few."""
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """Documents that hold passages of ``benchmark`` (``item_id``, ``text``), also with some tokens substituted.

    Spaced seeds of both sides are joined; a table of bits of fixed size first drops most
    positions of a document that no item's seed can meet. Each joined pair names a
    document, an item and the offset between them. Along an offset, document and item are compared
    token by token. A pair is a leak if in some stretch of ``window`` tokens of the
    item (of a shorter item, all) at least ``share`` are equal. For the default ``window``
    and ``share`` the masks miss none. Returns ``doc_id``,
    ``item_id``, ``offset`` and ``matched`` (equal tokens of the best stretch), a row
    for each leak at its best offset, the smallest of equally good ones.

    An item of fewer than ``MASKED`` tokens is a leak where all its tokens stand in a row;
    its seed is the whole item. Null
    and empty texts match nothing. Rows without an id are not compared. Rows of one id are
    compared each and reported together. Empty tables give an empty table; other
    columns are ignored. Seeds are dealt over tasks by document, so one that a third
    of all documents share gathers nowhere; only pairs with the benchmark arise.
    """
    items = benchmark.filter("item_id is not null").select("item_id", tokens(F.col("text")).alias("tokens")).filter(F.size("tokens") > 0)
    codes = F.transform("tokens", lambda t: F.xxhash64(t)).alias("codes")
    coded = items.select("item_id", codes)
    runs = sorted(r[0] for r in coded.filter(F.size("codes") < MASKED).select(F.size("codes")).distinct().collect())
    masks = _masks(runs)
    wanted = _seeds(coded.filter(F.size("codes") >= MASKED), ["item_id"], _places(), _masks([]))
    for n in runs:
        wanted = wanted.union(_seeds(coded.filter(F.size("codes") == n), ["item_id"], F.array(F.lit(0)), [(1000 + n, tuple(range(n)))]))
    wanted = stored(wanted.select("seed", "item_id", F.col("at").alias("item_at")).distinct(), "leak_seeds")
    words = docs.filter("doc_id is not null").select("doc_id", tokens(F.col("text")).alias("tokens"))
    bits = stored(_bit_table(wanted), "leak_bits")

    def may_hit(at: Column) -> Column:
        seeds = [_seed(m, at) for m in masks]
        return functools.reduce(Column.__or__, [F.getbit(F.get("bits", _slot(x)), _bit(x)) == 1 for x in seeds])

    coded = words.select("doc_id", codes, bits.select("table").scalar().alias("bits"))
    placed = coded.select("doc_id", "codes", F.filter(_places(), may_hit).alias("places"))
    hits = _seeds(placed, ["doc_id"], F.col("places"), masks).join(_small(wanted), "seed").select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("offset"))
    hits = stored(hits.distinct(), "leak_hits")
    near = hits.groupBy("doc_id", "item_id").agg(F.collect_set("offset").alias("offsets"))
    near = stored(near.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "offsets")).alias("near")), "leak_places")

    pairs = (
        words.join(_small(near), "doc_id").select("doc_id", "tokens", F.inline("near")).select("doc_id", "tokens", "item_id", F.explode("offsets").alias("offset"))
        .join(_small(items.select("item_id", F.col("tokens").alias("item"))), "item_id")
    )
    start = F.greatest(-F.col("offset"), F.lit(0))
    length = F.least(F.size("item"), F.size("tokens") - F.col("offset")) - start
    equal = F.zip_with(F.slice("tokens", start + F.col("offset") + 1, length), F.slice("item", start + 1, length), lambda a, b: (a == b).cast("int"))
    stretch = F.least(F.lit(window), F.size("item"))
    sums = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("equal") - F.col("stretch") + 1, F.lit(1))),
        lambda i: F.aggregate(F.slice("equal", i, F.col("stretch")), F.lit(0), lambda x, y: x + y),
    )
    found = (
        pairs.filter(length > 0).select("doc_id", "item_id", "offset", stretch.alias("stretch"), equal.alias("equal"))
        .withColumn("matched", F.array_max(sums)).filter(F.col("matched") >= F.col("stretch") * F.when(F.col("stretch") < MASKED, F.lit(1.0)).otherwise(F.lit(share)))
    )
    return found.groupBy("doc_id", "item_id").agg(
        F.min_by("offset", F.struct(-F.col("matched"), "offset")).cast("long").alias("offset"), F.max("matched").cast("long").alias("matched")
    )


def leak_report(docs: DataFrame, leaks: DataFrame) -> DataFrame:
    """A row per row of ``docs``: ``doc_id``, ``contaminated``, ``n_items``, ``item_id`` (the smallest) and ``matched`` (the most)."""
    by_doc = leaks.groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("n"), F.min("item_id").alias("item_id"), F.max("matched").alias("matched"))
    return docs.select("doc_id").join(by_doc, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", F.col("id").isNotNull().alias("contaminated"), F.coalesce("n", F.lit(0)).cast("long").alias("n_items"), "item_id", F.coalesce("matched", F.lit(0)).cast("long").alias("matched")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id has no leak, all columns as they are."""
    leaked = stored(find_leaks(docs, benchmark).select("doc_id").distinct(), "leaked")
    return docs.join(_small(leaked), "doc_id", "left_anti").select(docs.columns)

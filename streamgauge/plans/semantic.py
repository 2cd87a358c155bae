"""Topic shift between minutes and its relation to viewers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import HashingTF, IDF, Normalizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamgauge.functions.text import blank_if_null
from streamgauge.functions.vectors import text_if_covered, unless_blank
from streamgauge.operators.trailing import trailing_vectors
from streamgauge.session import materialize
from streamgauge.plans.retention import NO_LABEL, POSITION, VIDEO, viewer_shift_label

# Non-blank minutes a context of N minutes needs.
MIN_VALID = {1: 1, 2: 1, 3: 1, 4: 2, 5: 3}

# Bands from the lowest scores to the highest.
BANDS = ["Very Low Change", "Low Change", "Moderate Change", "High Change", "Very High Change"]


def embed_text(df: DataFrame, text: str = "text", dims: int = 256) -> DataFrame:
    """Add a unit-length ``embedding`` of word weights, computed without a pretrained model.

    A pretrained encoder is a drop-in replacement: any column of equally long
    arrays named ``embedding`` will do.
    """
    words = Tokenizer(inputCol="_text", outputCol="_words").transform(
        df.withColumn("_text", F.coalesce(text, F.lit("")))
    )
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dims).transform(words)
    weights = IDF(inputCol="_counts", outputCol="_weights").fit(counts).transform(counts)
    unit = Normalizer(inputCol="_weights", outputCol="_unit").transform(weights)
    return unit.withColumn("embedding", vector_to_array("_unit")).drop("_text", "_words", "_counts", "_weights", "_unit")


def blank_uncovered(minutes: DataFrame, min_cov: float = 0.5) -> DataFrame:
    """Blank the text of barely covered minutes and the vectors of blank minutes."""
    cov = F.col("duration_text_coverage_pct")
    if "text" in minutes.columns:
        kept = minutes.withColumn("text", text_if_covered(F.col("text"), cov, min_cov))
        return kept.withColumn("embedding", unless_blank(F.col("text"), F.col("embedding")))
    return minutes.withColumn("embedding", F.when(~F.coalesce(cov < min_cov, F.lit(False)), F.col("embedding")))


def semantic_shift(
    minutes: DataFrame,
    n: int | Sequence[int],
    min_valid: int | None = None,
    min_cov: float = 0.5,
    keep_embedding: bool = False,
) -> DataFrame:
    """1 - cosine of each minute's vector and the mean of the ``n`` minutes before.

    The first ``n`` minutes of a video score 0. A blank minute, or too few
    non-blank ones before it, gives NULL. Several ``n`` share one pass.
    """
    sizes = [n] if isinstance(n, int) else list(n)
    masked = blank_uncovered(minutes, min_cov)
    rows = trailing_vectors(masked, VIDEO, POSITION, "embedding", sizes, "cosine")
    for size in sizes:
        needed = min_valid if min_valid is not None else MIN_VALID.get(size)
        rows = rows.withColumn(f"semantic_shift_{size}m", _shift(size, needed))
    rows = rows.drop("rows_before", *[f"{c}_{size}" for size in sizes for c in ("valid", "cosine")])
    return rows if keep_embedding else rows.drop("embedding")


def _shift(size: int, needed: int | None):
    early = F.col("rows_before") < size
    if needed is None:
        return F.when(early, F.lit(0.0))
    enough = F.col(f"valid_{size}") >= needed
    return F.when(early, F.lit(0.0)).when(enough, 1 - F.col(f"cosine_{size}"))


def sd_bands(df: DataFrame, col: str = "semantic_shift_5m", out: str | None = None) -> DataFrame:
    """Five bands at one and two standard deviations around the mean of non-zero scores."""
    stats = df.filter(F.col(col) != 0).agg(
        F.struct(F.avg(col).alias("mean"), F.stddev_samp(col).alias("sd"))
    ).scalar()
    mean, sd, x = F.col("_s.mean"), F.col("_s.sd"), F.col(col)
    label = (
        F.when(x < mean - 2 * sd, BANDS[0])
        .when((x >= mean - 2 * sd) & (x < mean - sd), BANDS[1])
        .when((x >= mean - sd) & (x <= mean + sd), BANDS[2])
        .when((x > mean + sd) & (x <= mean + 2 * sd), BANDS[3])
        .when(x > mean + 2 * sd, BANDS[4])
        .otherwise(NO_LABEL)
    )
    return df.withColumn("_s", stats).withColumn(out or f"{col}_seg", label).drop("_s")


def shift_bands(scored: DataFrame, col: str = "semantic_shift_5m") -> DataFrame:
    """``sd_bands`` over scores that are stored first.

    The statistics and the labels both read every score, and the vector
    arithmetic behind a score costs far more than writing and reading it.
    """
    return sd_bands(materialize(scored, "scores"), col)


def minute_text(minutes: DataFrame, coverage: DataFrame) -> DataFrame:
    """Minute viewers with the transcript bucket that starts at their position."""
    text = coverage.withColumnRenamed("minute_boundaries_lb", POSITION).drop("minute_boundaries_ub", "minute_boundaries")
    return minutes.join(text, [*VIDEO, POSITION], "left")


def minute_content_report(
    minutes: DataFrame,
    coverage: DataFrame,
    embed: Callable[[DataFrame], DataFrame] = embed_text,
    windows: Sequence[int] = (5, 1),
) -> DataFrame:
    """Viewers, text, coverage, topic shifts, viewer shift and bands per minute.

    ``minutes`` are the current minute viewers, ``coverage`` the transcript
    minutes. When ``coverage`` already brings an ``embedding`` it is used.
    """
    joined = minute_text(viewer_shift_label(minutes), coverage)
    if "text" in joined.columns:
        joined = joined.withColumn("text", blank_if_null(F.col("text")))
    if "embedding" not in joined.columns:
        joined = embed(joined)
    return shift_bands(semantic_shift(joined, windows), f"semantic_shift_{windows[0]}m")

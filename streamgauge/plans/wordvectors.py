"""Word vectors trained on the given text, and texts as their weighted means.

Words that stand in the same company get near vectors: counts of word pairs
within a window, positive pointwise mutual information, and the leading
eigenvectors of that matrix by randomised subspace iteration. Pairs, sums and
products are Spark aggregates; what reaches the driver is one square matrix of
``dims`` columns a step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamgauge.session import materialize


#: Most words, and most vectors of 64 dimensions (some 70 MB), that are sent to all tasks at once.
MOST_WORDS, MOST_VECTORS = 1 << 20, 1 << 17


def _words(text: Column) -> Column:
    """Lower-case words of letters and digits, in order."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def pair_counts(df: DataFrame, text: str = "text", window: int = 4, min_count: int = 5) -> DataFrame:
    """``a``, ``b`` and ``n``: how often b stands within ``window`` words of a, both ways; words seen under ``min_count`` times don't count as company.

    Pairs are counted before they are shuffled, so a frequent pair costs a row per task; they are
    shuffled once, in one order of a and b, and turned into both afterwards. Up to ``MOST_WORDS``
    known words are sent to the tasks and rare ones go before the shuffle, more are joined after it.
    """
    words = materialize(df.select(_words(F.col(text)).alias("words")), "words")
    common = materialize(words.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count).select("word"), "common_words")
    few = common.count() <= MOST_WORDS
    size = F.size("words")
    apart = words.select("words", F.explode(F.sequence(F.lit(1), F.lit(window))).alias("apart")).filter(size > F.col("apart"))
    left, right = F.slice("words", F.lit(1), size - F.col("apart")), F.slice("words", F.col("apart") + 1, size - F.col("apart"))
    near = apart.select(F.inline(F.arrays_zip(left.alias("a"), right.alias("b")))).toDF("a", "b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    def known(pairs):
        for end in ("a", "b"):
            names = common.withColumnRenamed("word", end)
            pairs = pairs.join(F.broadcast(names) if few else names, end, "left_semi")
        return pairs.select("a", "b", *pairs.columns[2:])

    once = (known(near) if few else near).groupBy("a", "b").agg(F.count("*").alias("n"))
    once = once if few else known(once)
    a, b, n = F.col("a"), F.col("b"), F.col("n")
    same = F.array(F.struct(a, b, (2 * n).alias("n")))
    both = F.array(F.struct(a, b, n), F.struct(b.alias("a"), a.alias("b"), n))
    return once.select(F.inline(F.when(a == b, same).otherwise(both)))


def positive_information(counts: DataFrame) -> DataFrame:
    """``a``, ``b`` and ``value``: the log of how much oftener they meet than by chance, where that is positive."""
    margins = materialize(counts.groupBy("a").agg(F.sum("n").alias("of_a")), "margins")
    total = margins.agg(F.sum("of_a")).scalar()
    sent = F.broadcast(margins) if margins.count() <= MOST_WORDS else margins
    joined = counts.join(sent, "a").join(sent.select(F.col("a").alias("b"), F.col("of_a").alias("of_b")), "b")
    value = F.log(F.col("n") * F.col("total") / (F.col("of_a") * F.col("of_b").cast("double")))
    return joined.withColumn("total", total.cast("double")).select("a", "b", value.alias("value")).filter("value > 0")


def _signs(word: Column, dims: int, seed: int) -> Column:
    """``dims`` random signs of a word, the same in every run."""
    return F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: (F.pmod(F.xxhash64(word, i, F.lit(seed)), F.lit(2)) * 2 - 1).cast("double"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _sums(rows: DataFrame, on: str, by: str, value: Column, vectors: DataFrame, count: int, dims: int) -> DataFrame:
    """For each ``by``, as ``v``: the sum of its rows' ``value`` times the vector (``word``, ``v``) of the word ``on``.

    Vectors go to the rows, which are never shuffled: rows that lie together by ``by`` leave a row per task
    and ``by``. Of ``count`` vectors ``MOST_VECTORS`` are sent at a time, and what each such part adds is stored.
    """
    slices = max(1, -(-count // MOST_VECTORS))
    cells = [F.sum(value * F.get("v", F.lit(j))).alias(f"s{j}") for j in range(dims)]
    vector = F.array(*[f"s{j}" for j in range(dims)]).alias("v")

    def part(some):
        return rows.join(F.broadcast(some.select(F.col("word").alias("_word"), *[c for c in some.columns if c != "word"])), F.col(on) == F.col("_word")).groupBy(by).agg(*cells)

    if slices == 1:
        return part(vectors).select(by, vector)
    slot = F.pmod(F.xxhash64("word"), F.lit(slices))
    done = [materialize(part(vectors.filter(slot == k)), "word_sums") for k in range(slices)]
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy(by).agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(dims)]).select(by, vector)


def _product(matrix: DataFrame, vectors: DataFrame, count: int, dims: int) -> DataFrame:
    """The matrix times ``vectors`` (``word``, ``v``): a row per word, added up before the shuffle."""
    return _sums(matrix, "b", "a", F.col("value"), vectors, count, dims).withColumnRenamed("a", "word")


def _cross(rows: DataFrame, left: str, right: str, dims: int) -> np.ndarray:
    """Sum over all rows of the products of two vectors' elements; tasks add up their own rows."""

    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros((dims, dims))
        for batch in batches:
            total += _matrix(batch.column(0), dims).T @ _matrix(batch.column(1), dims)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims, dtype=np.int32)), pa.array(total.ravel())], ["place", "value"])

    found = rows.select(F.col(left).alias("x"), F.col(right).alias("y")).mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(dims * dims)
    out[found.column("place").to_numpy()] = found.column("value").to_numpy()
    return out.reshape(dims, dims)


def _turned(rows: DataFrame, column: str, by: np.ndarray) -> DataFrame:
    """``rows`` with a vector multiplied by a small matrix."""

    @F.arrow_udf("array<double>")
    def turn(v: pa.Array) -> pa.Array:
        x = _matrix(v, by.shape[0]) @ by
        return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, by.shape[1], dtype=np.int32)), pa.array(x.ravel()))

    return rows.withColumn(column, turn(column))


def _orthonormal(rows: DataFrame, dims: int) -> DataFrame:
    """Vectors whose columns are orthonormal and span the same space; lost directions become zero."""
    size, axes = np.linalg.eigh(_cross(rows, "v", "v", dims))
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.where(size > 1e-10 * max(size.max(), 1e-300), 1 / np.sqrt(np.maximum(size, 1e-300)), 0.0)
    return _turned(rows, "v", axes * scale)


def subspace(matrix: DataFrame, dims: int, rounds: int = 3, seed: int = 42) -> DataFrame:
    """``word`` and ``vector``: rows of the best approximation of a symmetric matrix in ``dims`` dimensions.

    Every round multiplies the matrix with an orthonormal base and stores the product, so
    lineage stays short; the last one turns the base into the matrix's own
    axes, each scaled by the root of its strength.
    """
    matrix = materialize(matrix.repartition("a"), "word_matrix")
    words = materialize(matrix.select(F.col("a").alias("word")).distinct(), "matrix_words")
    count = words.count()
    base = words.withColumn("v", _signs(F.col("word"), dims, seed))
    for _ in range(rounds):
        base = _orthonormal(materialize(_product(matrix, base, count, dims), "word_base"), dims)
    base = materialize(base, "word_base")
    product = _product(matrix, base, count, dims).withColumnRenamed("v", "z")
    strength, axes = np.linalg.eigh(_cross(base.join(product, "word"), "v", "z", dims))
    order = np.argsort(-np.abs(strength), kind="stable")
    return _turned(base, "v", axes[:, order] * np.sqrt(np.abs(strength[order]))).withColumnRenamed("v", "vector")


def word_vectors(df: DataFrame, text: str = "text", dims: int = 64, window: int = 4, min_count: int = 5, rounds: int = 3, seed: int = 42) -> DataFrame:
    """``word`` and ``vector`` for every word with positive information about another one."""
    return subspace(positive_information(materialize(pair_counts(df, text, window, min_count), "word_pairs")), dims, rounds, seed)


def embed_by_words(df: DataFrame, vectors: DataFrame, text: str = "text", dims: int = 64) -> DataFrame:
    """``df`` with a unit-length ``embedding``: the mean of its words' vectors, rare words weighing more.

    A word's weight is the log of the number of different texts over those that hold it.
    Equal texts are embedded once. A text without a known word gets zeros.
    """
    keyed = df.withColumn("_text", F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256))
    texts = keyed.select("_text", _words(F.col(text)).alias("words")).dropDuplicates(["_text"])
    # Every text's words lie together, so sums of vectors are added up where the text is.
    counts = materialize(texts.select("_text", F.explode("words").alias("word")).groupBy("_text", "word").agg(F.count("*").alias("n")), "text_words")
    seen = counts.groupBy("word").agg(F.count("*").alias("texts"))
    total = counts.agg(F.count_distinct("_text")).scalar()
    weighted = vectors.join(seen, "word").withColumn("weight", F.log((total + 1) / (F.col("texts") + 1)) + 1).select("word", "weight", F.col("vector").alias("v"))
    weighted = materialize(weighted, "word_weights")
    mean = _sums(counts, "word", "_text", F.col("n") * F.col("weight"), weighted, weighted.count(), dims)
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda t, x: t + x * x))
    unit = mean.withColumn("size", size).select("_text", F.transform("v", lambda x: F.coalesce(F.try_divide(x, F.col("size")), F.lit(0.0))).alias("embedding"))
    zeros = F.array_repeat(F.lit(0.0), dims)
    return keyed.join(unit, "_text", "left").withColumn("embedding", F.coalesce("embedding", zeros)).drop("_text")

"""Dense vectors held as arrays.

Higher-order functions, right for a few vectors or few dimensions. Whole contexts
of long vectors slide through Arrow batches in ``operators.trailing``.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when one of the vectors is all zeros."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(
        a.isNotNull() & b.isNotNull(), F.coalesce(F.try_divide(dot(a, b), norms), F.lit(0.0))
    )


def vector_sum(vectors: Column) -> Column:
    """Element-wise sum of a non-empty array of equally long vectors."""
    first = F.transform(F.get(vectors, F.lit(0)), lambda x: x.cast("double"))
    rest = F.slice(vectors, F.lit(2), F.greatest(F.size(vectors) - 1, F.lit(0)))
    return F.aggregate(
        rest, first, lambda acc, v: F.zip_with(acc, v, lambda x, y: x + y.cast("double"))
    )


def vector_mean(vectors: Column) -> Column:
    """Element-wise mean; NULL for an empty array."""
    total = vector_sum(vectors)
    return F.when(
        F.size(vectors) > 0, F.transform(total, lambda x: F.try_divide(x, F.size(vectors)))
    )


def unless_blank(text: Column, vector: Column) -> Column:
    return F.when(text != "", vector)


def text_if_covered(text: Column, coverage: Column, minimum: float = 0.5) -> Column:
    """Blank text where less than ``minimum`` of the minute is covered."""
    return F.when(coverage < minimum, F.lit("")).otherwise(text)

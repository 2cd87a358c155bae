"""Change hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def canonical_text(df: DataFrame, name: str) -> Column:
    """Text of a column that does not depend on an engine's float printing."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return col.cast("decimal(20,6)").cast("string")
    return col.cast("string")


def version_hash(df: DataFrame, names: Sequence[str], null_token: str | None = None) -> Column:
    """md5 of the bar-joined texts.

    NULLs are skipped, so (NULL, 1) and (1, NULL) hash alike; give
    ``null_token`` to tell them apart.
    """
    texts = [canonical_text(df, n) for n in names]
    if null_token is not None:
        texts = [F.coalesce(t, F.lit(null_token)) for t in texts]
    return F.md5(F.concat_ws("|", *texts))

"""Equi-joins that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "_salt"


def spread_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    spread_by: Sequence[str] | None = None,
    salts: int = 1,
) -> DataFrame:
    """Join ``big`` to ``small`` on ``keys``; a hot key is split at run time, or into ``salts`` parts.

    With one part this is a plain join: AQE broadcasts ``small`` when it proves
    small and splits skewed partitions of ``big``. With more, the rows of ``big``
    that share a key are divided by a hash of ``spread_by`` (all other columns when
    not given) and ``small`` is repeated once per part; that is for keys known to
    be hot and a ``small`` with few rows per key. ``how`` is any kind that keeps or
    drops rows of ``big`` only: inner, left, left_semi, left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported kind of join: {how}")
    if salts & (salts - 1):
        raise ValueError("salts must be a power of two")
    if salts == 1:
        return big.join(small, list(keys), how)
    by = list(spread_by or [c for c in big.columns if c not in keys])
    salted = big.withColumn(_SALT, F.xxhash64(*by).bitwiseAND(F.lit(salts - 1)))
    parts = F.explode(F.array(*[F.lit(i).cast("long") for i in range(salts)]))
    repeated = small.withColumn(_SALT, parts)
    return salted.join(repeated, [*keys, _SALT], how).drop(_SALT)


def keep_unseen(
    rows: DataFrame, seen: DataFrame, keys: Sequence[str], spread_by: Sequence[str] | None = None
) -> DataFrame:
    """Rows whose keys do not occur in ``seen`` (keys must not be NULL)."""
    return spread_join(rows, seen.select(*keys).distinct(), keys, "left_anti", spread_by)

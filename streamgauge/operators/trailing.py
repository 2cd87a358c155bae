"""Trailing vectors: sums over the rows before each row of a long series.

Vectors are wide, so they move once: rows are dealt by series and chunk, sorted,
and slide through Arrow batches. A chunk's first rows look back into earlier
chunks; they and each chunk's last rows, a small share, meet once more in chunks
a thousand times as wide, and what is left of these in whole series.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamgauge.operators.series import CHUNK, with_chunk

ROWS = 2048


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column as a matrix, NULL as zeros, and which rows are known."""
    known = column.is_valid().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    dims = len(flat) // max(int(known.sum()), 1)
    matrix = np.zeros((len(column), dims))
    matrix[known] = flat.reshape(int(known.sum()), dims)
    return matrix, known


def _wider(matrix: np.ndarray, dims: int) -> np.ndarray:
    return matrix if matrix.shape[1] == dims else np.zeros((len(matrix), dims))


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)
    return np.divide(np.einsum("ij,ij->i", a, b), norms, out=np.zeros(len(a)), where=norms > 0)


def _slide(rows: DataFrame, vector: str, sizes: Sequence[int], kind: str) -> DataFrame:
    """Sums over the rows before, for rows that come in order; ``_rank`` counts a group's rows from 1."""
    most = max(sizes)
    names = rows.columns
    added = [T.StructField("rows_before", T.IntegerType())]
    for size in sizes:
        added.append(T.StructField(f"valid_{size}", T.IntegerType()))
        added.append(T.StructField(f"{kind}_{size}", T.DoubleType() if kind == "cosine" else T.ArrayType(T.DoubleType())))
    schema = T.StructType([*rows.schema.fields, *added])

    def run(batches):
        tail, tail_known = np.zeros((0, 0)), np.zeros(0, bool)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                now, known = _vectors(batch.column(vector))
                dims = max(now.shape[1], tail.shape[1])
                everything = np.concatenate([_wider(tail, dims), _wider(now, dims)])
                all_known = np.concatenate([tail_known, known])
                here = np.arange(len(tail), len(everything))
                before = np.minimum(batch.column("_rank").to_numpy() - 1, most)
                total, valid = np.zeros((len(here), dims)), np.zeros(len(here), np.int32)
                out = {}
                for back in range(1, most + 1):
                    reach = np.flatnonzero(before >= back)
                    total[reach] += everything[here[reach] - back]
                    valid[reach] += all_known[here[reach] - back]
                    if back in sizes:
                        some = valid > 0
                        if kind == "cosine":
                            values = pa.array(_cosines(everything[here], total), mask=~(some & known))
                        else:
                            flat = total[some] / valid[some][:, None]
                            offsets = np.append(0, np.cumsum(np.where(some, dims, 0))).astype(np.int32)
                            values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel()), mask=pa.array(~some))
                        out[back] = [pa.array(valid.copy()), values]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(before.astype(np.int32)), *[a for size in sizes for a in out[size]]],
                    [*names, *[f.name for f in added]],
                )
                tail, tail_known = everything[-most:], all_known[-most:]

    return rows.mapInArrow(run, schema)


def trailing_vectors(
    df: DataFrame, keys: Sequence[str], order: str, vector: str, sizes: Sequence[int], kind: str = "mean", span: float = 60 * 1024
) -> DataFrame:
    """What the ``n`` rows before each row hold in ``vector``, for every ``n`` of ``sizes``.

    Adds ``rows_before`` (up to the largest ``n``) and, for each ``n``, ``valid_n``
    (how many of these rows have a vector) and ``mean_n``, the mean of those vectors, or
    with ``kind`` "cosine" ``cosine_n``, the cosine of that mean and the row's own vector.
    Both are NULL without vectors, the cosine also without an own one; it
    is 0 where a side is all zeros. All vectors have one length.

    ``order`` is numeric and unique within ``keys``.
    """
    if kind not in ("mean", "cosine"):
        raise ValueError("kind must be mean or cosine")
    most = max(sizes)
    rows, parts = df.withColumn("_wanted", F.lit(True)), []
    for level in (span, span * 1024, None):
        # The last level takes series whole: of each 1,024 * 1,024 chunk spans only the first and last rows are left.
        rows = with_chunk(rows, order, level) if level else rows.withColumn(CHUNK, F.lit(0).cast("long"))
        inside = Window.partitionBy(*keys, CHUNK).orderBy(order)
        whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        rows = rows.withColumn("_rank", F.row_number().over(inside)).withColumn("_left", F.count("*").over(whole) - F.col("_rank"))
        head = F.col("_rank") <= most if level else F.lit(False)
        parts.append(_slide(rows, vector, sizes, kind).filter(F.col("_wanted") & ~head))
        rows = rows.filter(head | (F.col("_left") < most)).withColumn("_wanted", F.col("_wanted") & head)
    done = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return done.drop("_wanted", "_rank", "_left", CHUNK)

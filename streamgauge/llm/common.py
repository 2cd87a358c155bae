"""Shared storage, text buffers and hashes of the operators in this package."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: A run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: The C library of this process; only some have ``malloc_trim``.
_LIBRARY = ctypes.CDLL(None)

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is ``spark.checkpoint.dir``; only where that is unset, as in tests, a
    folder under the warehouse takes its place.
    """
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/llm_scratch"


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffle_files_dropped(spark: SparkSession):
    """Within this block, a finished job's shuffle files are removed: its result is stored."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder, and a scan of it.

    What follows reads files instead of repeating the work, also after executors
    are lost.
    """
    spark = df.sparkSession
    path = path or scratch(spark, name)
    with shuffle_files_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows on end and the rows' borders in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, borders, data = column.buffers()
    borders = np.frombuffer(borders, np.int64 if wide else np.int32, len(column) + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    if data is None or borders[-1] == borders[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[borders[0] : borders[-1]], borders - borders[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of ``column``; a longer row stays whole, alone."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, borders = text_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(borders, borders[start] + size, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def give_back() -> None:
    """Return memory that freed arrays have left with the allocators, so that workers kept for the next task hold little."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBRARY, "malloc_trim"):
        _LIBRARY.malloc_trim(0)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values, another one for each seed."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x += np.uint64(((2 * seed + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


_BASE = 0xD6E8FEB86659FD93
_UNBASE = pow(_BASE, -1, 1 << 64)
_CODES = mixed(np.arange(256, dtype=np.uint64), 7) | np.uint64(1)
_FOLDED = np.concatenate([_CODES[:65], _CODES[97:123], _CODES[91:]])
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept between calls up to a few MB."""
    if len(_powers[0]) >= n:
        return _powers[0], _powers[1]
    out = []
    for base in (_BASE, _UNBASE):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    if n <= 1 << 22:
        _powers[:] = out
    return out[0], out[1]


class Rolling:
    """64-bit hashes of any byte ranges of a text in constant time each (polynomial, then scrambled)."""

    def __init__(self, data: np.ndarray, folded: bool = False):
        power, self.down = _powers_to(len(data) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((_FOLDED if folded else _CODES)[data] * power[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts], 1)


def words_of(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the words of all rows."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = np.zeros(len(data) + 1, bool)
    first[borders] = True
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    stops[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(borders, starts, "right") - 1


def binary_rows(values: np.ndarray, borders: np.ndarray) -> pa.Array:
    """Rows of binary from one array and its borders, in elements."""
    raw = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(borders) - 1, [None, pa.py_buffer((borders * raw.itemsize).astype(np.int32)), pa.py_buffer(raw.tobytes())])

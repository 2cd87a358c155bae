"""Load targets in folders by a hash of their key, so a load touches the folders of its keys only.

``path/of=64/_bucket=7`` holds the rows of one bucket. A load asks which buckets
its batch touches (at most as many numbers as there are buckets), reads these
by partition pruning, and replaces them by dynamic partition overwrite; all
other folders are neither read nor written. Spark swaps folders one by one when all
rows are written, so a load that dies before leaves the table as it was; let
readers start after a load, not during its swap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamgauge.operators.loads import delete_insert, new_versions

BUCKET = "_bucket"
BUCKETS = 64


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _folder(spark: SparkSession, path: str) -> tuple[str, int] | None:
    """The folder of all buckets and their number, which its name keeps."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(top):
        for status in fs.listStatus(top):
            name = status.getPath().getName()
            if name.startswith("of="):
                return f"{path}/{name}", int(name[3:])
    return None


def _write(df: DataFrame, folder: str, keys: Sequence[str], buckets: int) -> None:
    """Replace the buckets that ``df`` has rows in. A large bucket is spread over tasks, small ones share one."""
    placed = df.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", BUCKET)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(folder)


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """Start a table. ``buckets`` should give folders of some hundred MB."""
    if _folder(df.sparkSession, path):
        raise ValueError(f"{path} has been started")
    _write(df, f"{path}/of={buckets}", keys, buckets)


def touched_buckets(batch: DataFrame, keys: Sequence[str], buckets: int) -> list[int]:
    return sorted(r[0] for r in batch.select(bucket_of(keys, buckets)).distinct().collect())


def read_buckets(spark: SparkSession, path: str, only: Sequence[int] | None = None) -> DataFrame | None:
    """All rows, or those of some buckets; None before the first load."""
    if (found := _folder(spark, path)) is None:
        return None
    rows = spark.read.parquet(found[0])
    return (rows if only is None else rows.filter(F.col(BUCKET).isin(list(only)))).drop(BUCKET)


def _load(batch: DataFrame, path: str, keys: Sequence[str], merged, buckets: int) -> list[int]:
    spark = batch.sparkSession
    if (found := _folder(spark, path)) is None:
        write_buckets(batch, path, keys, buckets)
        return touched_buckets(batch, keys, buckets)
    folder, buckets = found
    only = touched_buckets(batch, keys, buckets)
    if only:
        _write(merged(read_buckets(spark, path, only)), folder, keys, buckets)
    return only


def add_new_versions(batch: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> list[int]:
    """Add versions of the batch, unique by (key, hash), that the table lacks; returns the buckets touched.

    ``batch`` is read twice; store it first if it is dear.
    """
    return _load(batch, path, [key], lambda held: held.unionByName(new_versions(batch, held, key), allowMissingColumns=True), buckets)


def replace_keys(batch: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """Delete all rows of the batch's keys and insert the batch; returns the buckets touched."""
    return _load(batch, path, keys, lambda held: delete_insert(held, batch, keys), buckets)

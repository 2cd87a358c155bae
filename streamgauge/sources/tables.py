"""Staging and warehouse tables as versioned Parquet folders.

``path/v=N`` holds one full version of a table in folders ``part=0`` (the load
that made the version), ``part=1`` (its first append) and so on. Rows are written to a
folder of their own and moved to their place once they are complete, so a reader
sees a whole load or none of it, and a load that died leaves nothing but a folder
that nobody lists. A move never replaces anything: of two writers that have
read the same state the second one gets ``ConcurrentLoad``. This rests on a file system that
moves a folder in one step, as HDFS and local ones do.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamgauge.schemas import STAGE_TABLES

ACTIONS = ("append", "truncate")

#: Newest version of a table and the number of its loads; None before the first one.
State = tuple[int, int] | None
#: Stands for the state at the time of the call.
NOW: State = (-1, -1)


class ConcurrentLoad(RuntimeError):
    """Another load came first; the rows of this one are not in the table."""


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the complete folders ``prefix=N`` below ``path``."""
    folder = _path(spark, path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    marker = "part=0/_SUCCESS" if prefix == "v" else "_SUCCESS"
    return sorted(int(n[len(prefix) + 1 :]) for n in names if n.startswith(prefix + "=") and fs.exists(_path(spark, f"{path}/{n}/{marker}")))


def table_state(spark: SparkSession, path: str) -> State:
    versions = _numbered(spark, path, "v")
    return (versions[-1], len(_numbered(spark, f"{path}/v={versions[-1]}", "part"))) if versions else None


def has_snapshot(spark: SparkSession, path: str) -> bool:
    return table_state(spark, path) is not None


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder in one step to a name that nobody has."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = hadoop.FileContext.getFileContext(_path(spark, target).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        files.rename(files.makeQualified(_path(spark, source)), files.makeQualified(_path(spark, target)), options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception.getClass()):
            raise ConcurrentLoad(f"{target} has been written meanwhile; {source} is left") from None
        raise


def read_table(spark: SparkSession, path: str, schema: StructType | None = None, at: State = NOW) -> DataFrame | None:
    """The newest version of a table, or its state ``at``; None before the first load."""
    state = table_state(spark, path) if at == NOW else at
    if state is None:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*parts_of(path, state))


def parts_of(path: str, state: tuple[int, int]) -> list[str]:
    return [f"{path}/v={state[0]}/part={k}" for k in range(state[1])]


def write_snapshot(df: DataFrame, path: str, since: State = NOW) -> None:
    """Replace the whole table by a new version."""
    spark = df.sparkSession
    state = table_state(spark, path) if since == NOW else since
    fresh = f"{path}/_load-{uuid.uuid4().hex}"
    df.write.parquet(f"{fresh}/part=0")
    _move(spark, fresh, f"{path}/v={0 if state is None else state[0] + 1}")


def append_rows(df: DataFrame, path: str, since: State = NOW) -> None:
    """Add rows to the newest version, or start the first one.

    ``since`` is the state that ``df`` was built from, the present one if not
    given. A load that another one has overtaken raises ``ConcurrentLoad``.
    """
    spark = df.sparkSession
    state = table_state(spark, path) if since == NOW else since
    if state is None:
        return write_snapshot(df, path, state)
    version, loads = state
    fresh = f"{path}/v={version}/_load-{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    _move(spark, fresh, f"{path}/v={version}/part={loads}")
    if table_state(spark, path)[0] != version:
        raise ConcurrentLoad(f"{path} has been reloaded while rows were added to version {version}")


def read_stage(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A named staging table with its declared schema; empty before its first load."""
    schema = STAGE_TABLES[table]
    found = read_table(spark, f"{root}/stage/{table}", schema)
    return empty_table(spark, schema) if found is None else found


def align(df: DataFrame, schema: StructType, defaults: Mapping[str, Column]) -> DataFrame:
    """Columns of ``schema`` in order; absent ones take their default or NULL."""
    present = {c.lower(): c for c in df.columns}
    unknown = set(present) - {f.name.lower() for f in schema}
    if unknown:
        raise ValueError(f"columns not in the table: {sorted(unknown)}")

    def value(field):
        if field.name.lower() in present:
            return F.col(present[field.name.lower()])
        return defaults.get(field.name, F.lit(None))

    return df.select(*[value(f).cast(f.dataType).alias(f.name) for f in schema])


def load_stage(df: DataFrame, root: str, table: str, action: str, defaults: Mapping[str, Column] | None = None) -> None:
    """Load a frame into a staging table, by append or after emptying it."""
    if action not in ACTIONS:
        raise ValueError("action must be truncate or append")
    standard = {"load_ts": F.current_timestamp(), "record_source": F.lit("YOUTUBE")}
    rows = align(df, STAGE_TABLES[table], standard | dict(defaults or {}))
    path = f"{root}/stage/{table}"
    (write_snapshot if action == "truncate" else append_rows)(rows, path)


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def run_query(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Result of SQL text; ``{name}`` in it stands for the table of that name."""
    return spark.sql(query, **tables)


def publish_layer(spark: SparkSession, layer: str, tables: Mapping[str, str]) -> None:
    """Make table folders queryable as ``layer.table``; appends show at once, a reload once it is published."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    for name, path in tables.items():
        version, _ = table_state(spark, path)
        spark.sql(f"CREATE OR REPLACE VIEW {layer}.{name} AS SELECT * FROM parquet.`{path}/v={version}/part=*`")


def max_date(df: DataFrame, column: str = "date") -> DataFrame:
    """The newest date a table holds, as one row."""
    return df.agg(F.max(column).alias("max_date"))


_V1_SOURCES, _PUSH_AGGREGATES = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"


def newest_loaded(spark: SparkSession, root: str, table: str, column: str = "date") -> DataFrame:
    """``max_date`` of a staging table from the statistics in its files' footers; no rows are read.

    The newer Parquet reader answers the maximum of a column itself, if that is
    switched on; the session keeps that switch. Footers are read by a column's place,
    so the table's declared schema is given, which all its files follow. Dates and
    numbers have such statistics, timestamps and text don't. A file whose rows have no value at
    all has none either; where there is one, which asking once shows, the column is read.
    """
    schema, path = STAGE_TABLES[table], f"{root}/stage/{table}"
    state = table_state(spark, path)
    if state is None:
        return max_date(empty_table(spark, schema), column)
    spark.conf.set(_PUSH_AGGREGATES, "true")
    before = spark.conf.get(_V1_SOURCES)
    spark.conf.set(_V1_SOURCES, ",".join(s for s in before.split(",") if s != "parquet"))
    try:
        newest = max_date(spark.read.schema(schema).parquet(*parts_of(path, state)), column)
    finally:
        spark.conf.set(_V1_SOURCES, before)
    try:
        newest.first()
    except Py4JJavaError as error:
        if "No min/max found" not in str(error):
            raise
        return max_date(read_table(spark, path, schema, state), column)
    return newest

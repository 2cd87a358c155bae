"""Small reference files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamgauge.schemas import FORECAST_CSV, SPEAKER_NAMES


def read_speaker_names(spark: SparkSession, path: str) -> DataFrame:
    """Name variants with their canonical form: trimmed, one row per variant."""
    raw = spark.read.schema(SPEAKER_NAMES).option("header", True).csv(path)
    return tidy_names(raw)


def tidy_names(raw: DataFrame) -> DataFrame:
    trimmed = raw.select(F.trim("original_name").alias("original_name"), F.trim("canonical_name").alias("canonical_name"))
    return trimmed.groupBy("original_name").agg(F.min("canonical_name").alias("canonical_name"))


def canonical_names(df: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """Replace known variants in ``column``; other names stay."""
    known = names.select(F.col("original_name").alias(column), F.col("canonical_name").alias("_canonical"))
    return df.join(known, column, "left").withColumn(column, F.coalesce("_canonical", column)).drop("_canonical")


def read_forecast(spark: SparkSession, path: str) -> DataFrame:
    """A saved forecast table with its index column."""
    return spark.read.schema(FORECAST_CSV).option("header", True).csv(path)

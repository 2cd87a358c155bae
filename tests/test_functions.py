"""Column functions on hand-written values."""

import pytest
from pyspark.sql import functions as F

from streamgauge.functions import numbers, text, times, vectors
from streamgauge.functions.hashing import version_hash


def values(spark, rows, schema, column):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(column).collect()]


def test_iso_durations(spark):
    texts = ["PT1H2M3S", "PT45S", "P1DT2H", "P0D", "PT5M", "PT1H5S", "P1W", "PT1.5S", None]
    got = values(spark, [(t,) for t in texts], "d string", times.iso_duration_seconds(F.col("d")))
    assert got == [3723, 45, 93600, 0, 300, 3605, 604800, 1.5, None]


@pytest.mark.parametrize("bad", ["garbage", "P1Y", "1:02:03", "PT", "P", "PT5", ""])
def test_other_durations_are_errors(spark, bad):
    with pytest.raises(Exception, match="not a duration"):
        values(spark, [(bad,)], "d string", times.iso_duration_seconds(F.col("d")))


def test_clean_title(spark):
    raw = ["SESSION 3 | Topic | x", "Series A", "[Luton] T - live", "T | x", "session 9|  a ", "plain", None]
    got = values(spark, [(t,) for t in raw], "t string", text.clean_title(F.col("t")))
    assert got == ["Topic", "", "[Luton] T", "T", "a", "plain", None]


def test_rounding_ties(spark):
    rows = [(2.5,), (3.5,), (118.50000000000045,), (-0.5,)]
    assert values(spark, rows, "x double", numbers.whole(F.col("x"))) == [2, 4, 118, 0]


def test_relative_change(spark):
    rows = [(0.0, 3.0), (4.0, 5.0), (4.0, None), (None, 1.0)]
    got = values(spark, rows, "p double, a double", numbers.relative_change(F.col("p"), F.col("a")))
    assert got == [0, 0.25, 0, 0]


def test_number_text(spark):
    rows = [(1234567.89,), (-1234.5,)]
    assert values(spark, rows, "x double", numbers.grouped_int(F.col("x"))) == ["1,234,567", "-1,234"]
    assert values(spark, rows, "x double", numbers.grouped_2dp(F.col("x"))) == ["1,234,567.89", "-1,234.50"]
    assert values(spark, [(-0.0873,), (0.129,)], "x double", numbers.truncated_percent_text(F.col("x"))) == ["-8%", "12%"]


def test_hash_skips_nulls_unless_told(spark):
    df = spark.createDataFrame([(None, "1"), ("1", None)], "a string, b string")
    plain = [r[0] for r in df.select(version_hash(df, ["a", "b"])).collect()]
    marked = [r[0] for r in df.select(version_hash(df, ["a", "b"], null_token="~")).collect()]
    assert plain[0] == plain[1] and marked[0] != marked[1]


def test_hash_ignores_float_printing(spark):
    df = spark.createDataFrame([(12345678.5, "12345678.500000")], "x double, t string")
    row = df.select(version_hash(df, ["x"]), F.md5("t")).first()
    assert row[0] == row[1]


def test_week_and_future_dates(spark):
    df = spark.sql("select date'2025-11-17' as d, date'2025-12-21' as e, date'2025-11-18' as early")
    row = df.select(
        times.week_start(F.col("early")), times.weekly_sundays(F.col("d"), F.col("e")), times.weekly_sundays(F.col("d"), F.col("early"))
    ).first()
    assert str(row[0]) == "2025-11-17"
    assert [str(x) for x in row[1]] == ["2025-11-30", "2025-12-07", "2025-12-14", "2025-12-21"]
    assert row[2] == []


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])], "a array<double>, b array<double>, z array<double>")
    row = df.select(
        vectors.cosine(F.col("a"), F.col("b")),
        vectors.cosine(F.col("a"), F.col("z")),
        vectors.vector_mean(F.array("a", "b")),
        vectors.vector_mean(F.slice(F.array("a", "b"), 1, 0)),
    ).first()
    assert row[0] == pytest.approx(0.96) and row[1] == 0 and row[2] == [3.5, 3.5] and row[3] is None

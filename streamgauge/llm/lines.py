"""Removal of lines that many documents share, by levelled sorted runs of line hashes."""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamgauge.llm.common import scratch, shuffle_files_dropped, slices, stored, text_bytes

#: Batches into which a whole table is cut; their number doesn't depend on its size.
BATCHES = 4


class _Lines:
    """Lines of all rows of a column: raw borders, row, and the borders of the stripped key."""

    def __init__(self, column: pa.Array):
        data, borders = text_bytes(column)
        self.raw = data.tobytes()
        breaks = np.flatnonzero(data == 10)
        # A row without its last line feed ends its last line, so both lists pair up in order.
        self.starts = np.sort(np.concatenate([borders[:-1], breaks + 1]), kind="stable")
        self.ends = np.sort(np.concatenate([breaks, borders[1:]]), kind="stable")
        self.count = np.searchsorted(breaks, borders[1:]) - np.searchsorted(breaks, borders[:-1]) + 1
        self.row = np.repeat(np.arange(len(borders) - 1), self.count)
        solid = np.flatnonzero(~((data == 32) | ((data >= 9) & (data <= 13))))
        first, last = np.searchsorted(solid, self.starts), np.searchsorted(solid, self.ends)
        padded = np.append(solid, 0)
        some = last > first
        self.left = np.where(some, padded[first], self.starts)
        self.right = np.where(some, padded[last - 1] + 1, self.starts)
        points = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=points[1:])
        self.points = points[self.right] - points[self.left]
        self.folded = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8).tobytes()

    def digest(self, line: int) -> bytes:
        return hashlib.sha256(self.folded[self.left[line] : self.right[line]]).digest()


def line_keys(docs: DataFrame, least: int) -> DataFrame:
    """``doc_id`` and ``key``, the SHA-256 of every different line of a row with ``least`` code points or more.

    The key is taken of the line without white space at its ends, A-Z as lower case.
    """

    def run(batches):
        for batch in slices(batches, "text"):
            lines = _Lines(batch.column("text"))
            long = np.flatnonzero(lines.points >= least)
            found = dict.fromkeys((int(lines.row[i]), lines.digest(i)) for i in long)
            ids = batch.column("doc_id").take(pa.array([r for r, _ in found], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array([k for _, k in found], pa.binary())], ["doc_id", "key"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("key", T.BinaryType())])
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


class LineRuns:
    """Levelled runs of line keys, each a table sorted and bucketed by key in the shared folder.

    Batches come in falling order of doc_id. Each new batch is anti-joined with
    the runs: a key that no run holds is new, and the largest doc_id of the batch
    is its holder for good; of a key that a run holds only further documents are
    counted. Both make the batch's own run. Two runs of a level are compacted
    into one of the next, so a batch meets no more runs than the logarithm of the
    batches before it. All runs have the same buckets: neither joins nor
    compaction shuffle a run, and a batch is shuffled once, a row per key and task.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.folder = folder or scratch(spark, "line_runs")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[str | None] = []
        self.written: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        with shuffle_files_dropped(self.spark):
            rows.select("key", "docs", "holder").write.bucketBy(self.buckets, "key").sortBy("key").option("path", f"{self.folder}/{name}").saveAsTable(name)
        self.written.append(name)
        return name

    def _live(self) -> list[DataFrame]:
        return [self.spark.table(name) for name in self.levels if name]

    def add(self, lines: DataFrame) -> None:
        """One batch (``doc_id``, ``key``), a row for each document and key."""
        batch = lines.groupBy("key").agg(F.count("*").alias("docs"), F.max("doc_id").alias("largest"))
        known = F.lit(False)
        for i, run in enumerate(self._live()):
            batch = batch.join(run.select("key", F.lit(True).alias(f"in_{i}")), "key", "left")
            known = known | F.col(f"in_{i}").isNotNull()
        level, name = 0, self._write(batch.withColumn("holder", F.when(~known, F.struct(F.col("largest").alias("id")))))
        while level < len(self.levels) and self.levels[level]:
            name = self._write(self._compacted(self.spark.table(self.levels[level]), self.spark.table(name)))
            self.levels[level] = None
            level += 1
        self.levels += [None] * (level + 1 - len(self.levels))
        self.levels[level] = name

    @staticmethod
    def _compacted(older: DataFrame, newer: DataFrame) -> DataFrame:
        """One run of two: documents are added up, and the older run's holder stays."""
        both = older.alias("a").join(newer.alias("b"), "key", "full_outer")
        return both.select(
            "key",
            (F.coalesce("a.docs", F.lit(0)) + F.coalesce("b.docs", F.lit(0))).alias("docs"),
            F.coalesce("a.holder", "b.holder").alias("holder"),
        )

    def totals(self) -> DataFrame:
        """``key``, ``docs`` and ``holder`` (a struct with the doc_id) over all batches so far."""
        live = self._live()[::-1]
        if not live:
            raise ValueError("no batch has been added")
        for run in live[1:]:
            live[0] = self._compacted(live[0], run)
        return live[0]

    def forget(self) -> None:
        """Take the runs out of the catalog; their files stay for the owner of the folder to expire."""
        for name in self.written:
            self.spark.sql(f"drop table if exists {name}")


def remove_shared_lines(docs: DataFrame, least: int = 40, documents: int = 5, batches: int = BATCHES) -> DataFrame:
    """Every document without the lines that ``documents`` or more hold, except in the largest doc_id of them.

    A row is a document. Its lines end at line feeds; a line's key is the line
    without white space (space, tab, line feed, vertical tab, form feed, carriage
    return) at both ends and with A-Z as lower case. A key of ``least`` code points
    or more that ``documents`` or more rows hold loses all its lines but those of the
    largest doc_id that holds it. Returns ``doc_id``, ``n_lines`` (before),
    ``n_dropped`` and ``kept``, the other lines with one line feed between them, a row for
    each row of ``docs``.

    A null or empty text is one empty line. Rows that share a doc_id are documents of their own,
    and where that doc_id is the largest all of them keep the line. A null doc_id
    is smaller than any. An empty table gives an empty table; other columns are
    ignored. A document that loses all its lines keeps an empty text.

    The table is cut by doc_id into ``batches`` that are added one by one, as
    they would arrive; the result doesn't depend on their number.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    cuts = docs.select(F.percentile_approx("doc_id", [i / batches for i in range(batches - 1, 0, -1)], 1000)).first()[0] or []
    after = sum((F.coalesce(F.col("doc_id") < F.lit(c), F.lit(True)).cast("int") for c in sorted(set(cuts), reverse=True)), F.lit(0))
    lines = stored(line_keys(docs, least).withColumn("batch", after), "line_keys")
    runs = LineRuns(spark)
    for b in range(len(set(cuts)) + 1):
        runs.add(lines.filter(F.col("batch") == b).select("doc_id", "key"))
    shared = stored(runs.totals().filter(F.col("docs") >= documents).select("key", "holder"), "shared_lines")
    runs.forget()
    lost = (
        lines.join(shared, "key")
        .filter(~F.col("doc_id").eqNullSafe(F.col("holder.id")))
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.collect_set("key").alias("lost"))
    )
    rows = docs.join(lost, F.col("doc_id").eqNullSafe(F.col("id")), "left").select("doc_id", "text", "lost")

    def run(batches):
        for batch in slices(batches, "text"):
            lines = _Lines(batch.column("text"))
            lost = batch.column("lost").to_pylist()
            kept, dropped, start = [], [], 0
            for text, gone, n in zip(batch.column("text").to_pylist(), lost, lines.count.tolist()):
                stays = None
                if gone:
                    gone = set(gone)
                    stays = [i for i in range(start, start + n) if lines.points[i] < least or lines.digest(i) not in gone]
                    text = b"\n".join(lines.raw[lines.starts[i] : lines.ends[i]] for i in stays).decode()
                kept.append(text or "")
                dropped.append(0 if stays is None else n - len(stays))
                start += n
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lines.count, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept"]
            )

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept", T.StringType())])
    return rows.mapInArrow(run, schema)

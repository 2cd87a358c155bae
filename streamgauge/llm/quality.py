"""Quality from compression: how much better good text's dictionary fits than bad text's."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most bytes that are compressed at once: a dictionary helps mainly what follows it directly.
BLOCK = 2048


@dataclass
class QualityModel:
    """Two dictionaries and the calibration of the size difference."""

    good: bytes
    bad: bytes
    level: int
    slope: float
    offset: float


def size_differences(texts: list[bytes], good: bytes, bad: bytes, level: int) -> np.ndarray:
    """(bad - good) / (bad + good) of the compressed sizes; 0 for an empty text or without dictionaries.

    Blocks of at most ``BLOCK`` bytes, equally long within a text, are compressed
    each on its own and their sizes summed, so every part of a text counts alike
    however long it is.
    """
    if not good or not bad:
        return np.zeros(len(texts))
    packers = []
    for content in (good, bad):
        dictionary = zstandard.ZstdCompressionDict(content)
        dictionary.precompute_compress(level=level)
        packers.append(zstandard.ZstdCompressor(dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False))
    out = np.zeros(len(texts))
    for i, text in enumerate(texts):
        if text:
            n = -(-len(text) // BLOCK)
            blocks = [text[len(text) * j // n : len(text) * (j + 1) // n] for j in range(n)]
            a, b = (sum(len(p.compress(block)) for block in blocks) for p in packers)
            out[i] = (b - a) / (a + b)
    return out


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary; the texts themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[-size:]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the likeliest logistic curve, slightly held back towards 0."""
    design = np.column_stack([x, np.ones_like(x)])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-4, 1e-4]), design.T @ (y - p) - 1e-4 * beta)
        beta += step
        if abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def fit_quality(
    docs: DataFrame, labels: DataFrame, train, per_class: int = 1500, longest: int = 32768, share: float = 0.6, size: int = 65536, level: int = 3
) -> QualityModel:
    """Fit dictionaries and calibration on a bounded sample of labelled rows.

    ``train`` is a condition on ``doc_id``. Of each class up to ``per_class``
    documents of up to ``longest`` bytes are taken, in the order of a hash of
    their ids: at most ``2 * per_class * longest`` bytes. ``share`` of them trains
    the dictionaries and the rest the calibration, weighted so that each class
    counts as often as among all labelled rows. Rows without quality 0 or 1 are
    ignored; a document with several labels takes the smallest. With a class
    missing, the score is the share of good labels everywhere.
    """
    labelled = labels.select("doc_id", "quality").filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & train).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = {r["quality"]: r["count"] for r in labelled.groupBy("quality").count().collect()}
    short = docs.filter(F.octet_length("text").between(1, longest)).select(F.col("doc_id").alias("id")).distinct()
    usable = labelled.join(short, F.col("doc_id") == F.col("id")).select("doc_id", "quality", F.md5(F.col("doc_id").cast("string")).alias("place"))
    chosen = [r for q in (0, 1) for r in usable.filter(F.col("quality") == q).orderBy("place", "doc_id").limit(per_class).collect()]
    spark = docs.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(r["doc_id"],) for r in chosen], "id long"))
    texts = {r["doc_id"]: r["text"].encode() for r in docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("id")).groupBy("doc_id").agg(F.min("text").alias("text")).collect()}
    split: dict[int, tuple[list, list]] = {}
    for q in (0, 1):
        own = [texts[r["doc_id"]] for r in chosen if r["quality"] == q]
        cut = math.ceil(len(own) * share)
        split[q] = own[:cut], own[cut:] or own[:cut]
    total = sum(counts.values())
    prior = (counts.get(1, 0) + 0.5) / (total + 1)
    if not split[0][0] or not split[1][0]:
        return QualityModel(b"", b"", level, 0.0, math.log(prior / (1 - prior)))
    good, bad = _dictionary(split[1][0], size), _dictionary(split[0][0], size)
    x0, x1 = (size_differences(split[q][1], good, bad, level) for q in (0, 1))
    slope, offset = _logistic(np.concatenate([x0, x1]), np.concatenate([np.zeros(len(x0)), np.ones(len(x1))]))
    offset += math.log(prior / (1 - prior)) - math.log(len(x1) / len(x0))
    return QualityModel(good, bad, level, slope, offset)


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1, higher: likelier good) of every whole text.

    Both dictionaries compress all blocks of the text; the difference of the summed
    sizes over their sum goes through the calibration. Null and empty texts have difference 0;
    repeated rows are scored each; other columns are ignored; an empty table
    gives an empty table.
    """

    def run(batches):
        for batch in batches:
            column = batch.column("text").cast(pa.binary())
            x = size_differences([v or b"" for v in column.to_pylist()], model.good, model.bad, model.level)
            p = 1 / (1 + np.exp(-np.clip(model.slope * x + model.offset, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")



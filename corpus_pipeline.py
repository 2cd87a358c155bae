"""A training corpus from documents: known languages, no copies, no repeats, no benchmark passages, mixed by source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamgauge.llm import langid, leaks, mixing, near, spans
from streamgauge.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a known language; those without any letter, and rows without doc_id, go.

    The model learns from all rows that name their language.
    """
    docs = docs.filter("doc_id is not null")
    return langid.known_language(docs, langid.fit_languages(docs, F.lit(True)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; of rows with one id, the smallest row."""
    kept = near.near_duplicates(docs, words=5, percent=80).filter("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    rest = [c for c in docs.columns if c != "doc_id"]
    one = docs.join(kept, F.col("doc_id") == F.col("_kept_id"), "left_semi").groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("row"))
    return one.select("doc_id", "row.*").select(docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the passages of 100 bytes and more that stand earlier; characters are never cut in two.

    ``n_chars`` follows the text. A document of nothing but repeats stays, with an
    empty text.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    rows = docs.select("doc_id", "text", F.struct(*rest).alias("_rest"))
    cut = spans.remove_repeats(rows, length=100, carried=("_rest",), whole_characters=True)
    text = F.col("kept").cast("string")
    return cut.select("doc_id", text.alias("text"), F.length(text).cast(docs.schema["n_chars"].dataType).alias("n_chars"), "_rest.*").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, numbered by ``mix_copy``."""
    taken = mixing.systematic_sample(docs).filter("copies > 0").select(F.col("doc_id").alias("_taken_id"), F.sequence(F.lit(1), F.col("copies").cast("int")).alias("_copies"))
    return docs.join(taken, F.col("doc_id") == F.col("_taken_id")).select(*docs.columns, F.explode("_copies").alias("mix_copy"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

#: The language model and its path have no SQL form; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again by the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"corpus_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Small tables with every odd row, and plain versions of shared steps."""

import re
import zlib

from pyspark.sql import types as T

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Names that operators use inside; as extra columns they must not matter.
CLASHES = ["id", "row", "key", "marks", "kept", "component", "size", "h", "d", "n", "start", "run", "copies", "rank", "rep", "word", "c", "seed", "copy", "blocks", "host", "v", "x"]

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in CLASHES]
)


def docs_of(spark, rows):
    """Rows (doc_id, text[, lang[, source]]) as a documents table with clashing extra columns, over a few partitions."""
    full = []
    for r in rows:
        doc_id, text, lang, source = (*r, *(None,) * (4 - len(r)))
        full.append((doc_id, text, lang, source, None if text is None else len(text), *(["?"] * len(CLASHES))))
    return spark.createDataFrame(full, DOCS).repartition(3)


def words(text):
    return [w.lower() for w in WORD.findall((text or "").encode())]


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())

import random

import pytest
from helpers import docs_of
from pyspark.sql import functions as F

from streamgauge.llm.quality import fit_quality, score_quality


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    good = [f"{a}{b}" for a in ("the", "of", "wor", "ther") for b in ("ing", "ed", "ly", "es", "ation")]
    rows, labels = [], []
    for i in range(240):
        bad = i % 3 == 0
        words = [rng.choice(good) + (rng.choice(("###", "$$$", "%%%")) if bad else "") for _ in range(rng.randint(30, 200))]
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if bad else 1))
    rows += [(1000, None), (1001, ""), (1002, "x"), (3, rows[3][1]), (None, "some text")]
    labels += [(1000, 1), (3, 1), (None, 1), (5, 7), (6, None), (1001, 0)]
    return docs_of(spark, rows), spark.createDataFrame([(*r, 0, "?") for r in labels], "doc_id long, quality int, toxic int, text string")


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    model = fit_quality(docs, labels, F.col("doc_id") % 2 == 0)
    got = score_quality(docs, model).collect()
    assert len(got) == 245 and all(0 <= r.score <= 1 for r in got)
    held = [(r.score >= 0.5) == (r.doc_id % 3 != 0) for r in got if r.doc_id is not None and r.doc_id < 240 and r.doc_id % 2]
    assert sum(held) / len(held) > 0.95
    empty = {r.score for r in got if r.doc_id in (1000, 1001)}
    assert len(empty) == 1


def test_long_texts_count_to_their_end(spark):
    rng = random.Random(6)
    syllables = ["".join(rng.choices("bcdfghklmnprstvw", k=2)) + v for v in "aeiou" for _ in range(12)]
    kinds = {q: ["".join(rng.choices(syllables, k=rng.randint(2, 3))) for _ in range(1500)] for q in (0, 1)}
    text = lambda q, n: " ".join(rng.choices(kinds[q], k=n))
    rows = [(i, text(int(i % 5 > 0), rng.randint(60, 300))) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i, _ in rows], "doc_id long, quality int")
    model = fit_quality(docs_of(spark, rows), labels, F.lit(True))
    long = [(q, text(q, 60000)) for q in (0, 1)] + [(2, text(1, 600) + " " + text(0, 60000))]
    got = {r.doc_id: r.score for r in score_quality(docs_of(spark, long), model).collect()}
    assert got[0] < 0.1 and got[1] > 0.9 and got[2] < 0.1


def test_one_class_only_gives_its_share(spark, tables):
    docs, labels = tables
    model = fit_quality(docs, labels, F.col("doc_id") % 3 == 1)
    assert {r.score > 0.9 for r in score_quality(docs, model).collect()} == {True}


def test_empty(spark, tables):
    docs, labels = tables
    model = fit_quality(docs.limit(0), labels.limit(0), F.lit(True))
    assert score_quality(docs.limit(0), model).count() == 0
    assert {r.score for r in score_quality(docs, model).collect()} == {0.5}

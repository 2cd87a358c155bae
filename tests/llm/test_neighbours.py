import numpy as np
import pytest
from pyspark.sql import functions as F

from streamgauge.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, x string, query string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if a is None else float(a) for a in v], 0, *"????") for i, v in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(900, 24)).astype(np.float32)
    x[600:800] = x[0] + 0.01 * rng.normal(size=(200, 24)).astype(np.float32)
    x[800:850] = x[1]
    return x


def test_recall_scores_and_ties(spark, vectors, monkeypatch):
    monkeypatch.setattr(neighbours, "BEAM", 96)
    odd = [(2000, None), (2001, [0.0] * 24), (2002, [float("nan")] + [1.0] * 23), (2003, [float("inf")] + [1.0] * 23), (2004, [None] + [1.0] * 23), (2005, [1.0] * 3), (None, [1.0] * 24), (3, vectors[3])]
    got = neighbours.nearest_neighbours(table(spark, list(enumerate(vectors)) + odd), F.col("id") % 20 == 0).collect()
    exact = vectors.astype(np.float64)
    by, hits, total = {}, 0, 0
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == set(range(0, 900, 20))
    for q, rows in by.items():
        rows.sort(key=lambda r: r["rank"])
        d = np.sqrt(((exact - exact[q]) ** 2).sum(axis=1))
        assert [r["rank"] for r in rows] == list(range(1, 11)) and q not in [r.vec_id for r in rows]
        assert [(r.score, r.vec_id) for r in rows] == sorted((r.score, r.vec_id) for r in rows)
        assert all(r.score == pytest.approx(d[r.vec_id], abs=1e-12) for r in rows)
        limit = np.sort(np.delete(d, q))[9]
        hits += sum(r.score <= limit + 1e-12 for r in rows)
        total += 10
    assert hits / total >= 0.9


def test_few_and_no_vectors(spark):
    few = [(10, [1.0, 0.0]), (11, [0.0, 1.0]), (12, [0.0, 2.0]), (20, [0.0, 0.0])]
    got = neighbours.nearest_neighbours(table(spark, few), F.col("id") == 10).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 11), (2, 12)]
    assert neighbours.nearest_neighbours(table(spark, []), F.lit(True)).count() == 0
    assert neighbours.nearest_neighbours(table(spark, few[:1]), F.lit(True)).count() == 0


def test_smallest_ids_of_equal_vectors(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(2000, 8)).astype(np.float32)
    x[100:1700] = x[100]
    x[1750:1755] = x[1750]
    rows = list(enumerate(x[np.argsort(rng.permutation(2000))]))
    got = neighbours.nearest_neighbours(table(spark, rows), F.col("id") % 100 == 0).collect()
    all_x = np.array([v for _, v in rows], np.float64)
    for q in range(0, 2000, 100):
        d = np.sqrt(((all_x - all_x[q]) ** 2).sum(axis=1))
        want = [i for i in np.lexsort((np.arange(2000), d)) if i != q][:10]
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == want

"""Trained word vectors against numpy, and on a corpus with planted company."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamgauge.plans import wordvectors as wv

CITIES, FOODS = ["paris", "london", "rome"], ["bread", "cheese", "soup"]


@pytest.fixture(scope="module")
def corpus(spark):
    dice = random.Random(1)
    texts = []
    for _ in range(400):
        words, around = (CITIES, ["travel", "train", "hotel", "street"]) if dice.random() < 0.5 else (FOODS, ["eat", "kitchen", "plate", "cook"])
        texts.append(" ".join(dice.choice(around + ["the", "a"]) if i % 2 else dice.choice(words) for i in range(12)) + ".")
    return texts, spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(3)


def counted(texts, window, least):
    seen, n = {}, {}
    split = [t.lower().replace(".", "").split() for t in texts]
    for words in split:
        for w in words:
            seen[w] = seen.get(w, 0) + 1
    for words in split:
        for i, a in enumerate(words):
            for b in words[i + 1 : i + 1 + window]:
                if seen[a] >= least and seen[b] >= least:
                    n[a, b] = n.get((a, b), 0) + 1
                    n[b, a] = n.get((b, a), 0) + 1
    return n


def dense(n):
    words = sorted({a for a, _ in n})
    place = {w: i for i, w in enumerate(words)}
    c = np.zeros((len(words), len(words)))
    for (a, b), k in n.items():
        c[place[a], place[b]] = k
    with np.errstate(divide="ignore", invalid="ignore"):
        m = np.log(c * c.sum() / np.outer(c.sum(1), c.sum(1)))
    return words, np.where(np.isfinite(m) & (m > 0), m, 0.0)


@pytest.mark.parametrize("window,least", [(4, 5), (1, 1), (30, 200)])
def test_pair_counts(corpus, window, least):
    texts, df = corpus
    assert {(r.a, r.b): r.n for r in wv.pair_counts(df, "text", window, least).collect()} == counted(texts, window, least)


def test_positive_information(corpus):
    texts, df = corpus
    words, want = dense(counted(texts, 4, 5))
    got = np.zeros(want.shape)
    for r in wv.positive_information(wv.pair_counts(df)).collect():
        got[words.index(r.a), words.index(r.b)] = r.value
    assert np.allclose(got, want)


def test_subspace_equals_numpy(spark, corpus):
    """The same signs, the same rounds, on the whole matrix at once."""
    dims = 5
    words, m = dense(counted(corpus[0], 4, 5))
    rows = [(words[i], words[j], float(m[i, j])) for i, j in zip(*np.nonzero(m))]
    matrix = spark.createDataFrame(rows, "a string, b string, value double").repartition(4)
    signs = {r.word: r.v for r in spark.createDataFrame([(w,) for w in words], "word string").withColumn("v", wv._signs(F.col("word"), dims, 42)).collect()}
    y = np.array([signs[w] for w in words])
    for _ in range(3):
        y = m @ y
        size, axes = np.linalg.eigh(y.T @ y)
        y = y @ (axes / np.sqrt(size))
    strength, axes = np.linalg.eigh(y.T @ m @ y)
    want = y @ (axes * np.sqrt(np.abs(strength)))
    got = {r.word: np.array(r.vector) for r in wv.subspace(matrix, dims).collect()}
    have = np.array([got[w] for w in words])
    assert np.allclose(have @ have.T, want @ want.T, atol=1e-8)
    best = np.linalg.eigh(m)
    top = np.argsort(-np.abs(best[0]))[:2]
    near = (best[1][:, top] * np.abs(best[0][top])) @ best[1][:, top].T
    mine = have[:, :2] @ have[:, :2].T
    assert np.linalg.norm(mine - near) < 0.2 * np.linalg.norm(near)


def unit(v):
    return v / np.linalg.norm(v)


def test_company_makes_words_near_and_runs_agree(corpus):
    _, df = corpus
    a = {r.word: unit(np.array(r.vector)) for r in wv.word_vectors(df, dims=6).collect()}
    b = {r.word: unit(np.array(r.vector)) for r in wv.word_vectors(df.repartition(2), dims=6).collect()}
    inside = [a[x] @ a[y] for group in (CITIES, FOODS) for x in group for y in group if x < y]
    across = [a[x] @ a[y] for x in CITIES for y in FOODS]
    assert min(inside) > max(across) + 0.3
    assert all(abs(a[x] @ a[y] - b[x] @ b[y]) < 1e-6 for x in a for y in a)


def test_texts_by_their_words(spark, corpus):
    _, df = corpus
    vectors = wv.word_vectors(df, dims=6).cache()
    texts = ["London, Rome", "the soup and the BREAD", "rome", "unknown words", "", None, "rome"]
    got = wv.embed_by_words(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), vectors, dims=6).orderBy("id").collect()
    v = [np.array(r.embedding) for r in got]
    assert [round(float(np.linalg.norm(x)), 6) for x in v] == [1, 1, 1, 0, 0, 0, 1]
    assert v[0] @ v[2] > v[1] @ v[2] + 0.3 and np.allclose(v[2], v[6])
    assert [r.text for r in got] == texts


def test_no_text(spark):
    df = spark.createDataFrame([(1, None), (2, "one two")], "id long, text string")
    vectors = wv.word_vectors(df, dims=4)
    assert vectors.collect() == []
    assert [r.embedding for r in wv.embed_by_words(df, vectors, dims=4).collect()] == [[0.0] * 4] * 2


def test_pairs_are_shuffled_once(corpus):
    plan = wv.pair_counts(corpus[1])._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("BroadcastHashJoin") == 2 and "Union" not in plan


def test_many_words_give_the_same(corpus, monkeypatch):
    texts, df = corpus
    want = {r.id: r.embedding for r in wv.embed_by_words(df, wv.word_vectors(df, dims=4), dims=4).collect()}
    monkeypatch.setattr(wv, "MOST_WORDS", 3)
    monkeypatch.setattr(wv, "MOST_VECTORS", 4)
    assert {(r.a, r.b): r.n for r in wv.pair_counts(df).collect()} == counted(texts, 4, 5)
    got = {r.id: r.embedding for r in wv.embed_by_words(df, wv.word_vectors(df, dims=4), dims=4).collect()}
    assert all(np.allclose(np.abs(got[i]), np.abs(want[i]), atol=1e-6) for i in want)

import math
import os
from collections import Counter

import numpy as np
import pytest
from helpers import crc, docs_of, words
from pyspark.sql import functions as F

from streamgauge.llm import lattice

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
needs_file = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="needs a public vocabulary file")


def all_segmentations(word, weights):
    if not word:
        return 1.0
    return sum(p * all_segmentations(word[len(piece) :], weights) for piece, p in weights.items() if word.startswith(piece))


def test_marginal_is_the_sum_over_segmentations():
    weights = {b" ": 0.2, b" a": 0.3, b" ab": 0.1, b"a": 0.2, b"b": 0.1, b"ab": 0.15, b"ba": 0.05, b"aba": 0.02}
    pieces = lattice.Pieces(list(weights))
    scores = np.log(np.array([*weights.values(), 0.5]))
    given = [b"a", b"abab", b"b" * 7, b"abba", b"aba" * 5, b"ab" * 50]
    got = lattice.word_log_probs(given, pieces, scores)
    for word, g in list(zip(given, got))[:5]:
        assert g == pytest.approx(math.log(all_segmentations(b" " + word, weights) * 0.5))
    expected = np.zeros(len(weights))
    lattice.word_log_probs([b"abab"], pieces, scores, np.array([2.0]), expected)
    covered = sum(e * len(p) for e, p in zip(expected, weights))
    assert covered == pytest.approx(2 * 5)
    assert lattice.word_log_probs([b"c"], pieces, scores)[0] == -math.inf


@needs_file
@pytest.mark.parametrize("head", [1 << 18, 2])
def test_counts_and_base_score(spark, head, monkeypatch):
    monkeypatch.setattr(lattice, "HEAD_WORDS", head)
    monkeypatch.setattr(lattice, "FLUSH_WORDS", 3)
    texts = ["The cat the CAT a\x0bdog", "a dog and a cat", "unseen über wörter here", "the the the and", "", None, "x" * 3000, "the\tcat", "only once more"] * 3
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, "the cat")]
    train = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 != 2
    got = lattice.score_texts(docs_of(spark, rows), train, VOCABULARY).collect()
    count = Counter()
    for i, t in rows:
        if crc(i) % 7 != 2:
            count.update([*words(t), None])
    n, v = sum(count.values()), len(count)
    want = []
    for i, t in rows:
        w = [*words(t), None]
        want.append((i, len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6)))
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str) == sorted(want, key=str)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    score = {r.doc_id: r.score for r in got}
    assert score[7] > score[6] and score[0] > score[2]


@needs_file
def test_probabilities_of_words_and_end_sum_to_at_most_one(spark):
    rows = [(i, t) for i, t in enumerate(["ab ab ba", "ab a", "b ab ba ba", "a"] * 5)]
    import itertools

    asked = ["".join(p) for n in range(1, 5) for p in itertools.product("ab", repeat=n)]
    docs = docs_of(spark, rows + [(100 + i, a) for i, a in enumerate(asked)] + [(99, "")])
    got = {r.doc_id: r.score for r in lattice.score_texts(docs, F.col("doc_id") < 50, VOCABULARY).collect()}
    end = 10 ** got[99]
    total = end + sum(10 ** got[100 + i] / end for i in range(len(asked)))
    assert 0.8 < total <= 1


@needs_file
def test_nothing_to_learn_from(spark):
    got = lattice.score_texts(docs_of(spark, [(1, "a b"), (2, None)]), F.lit(False), VOCABULARY).collect()
    assert {(r.doc_id, r.n_known, r.train_tokens, r.base_score) for r in got} == {(1, 0, 0, 0.0), (2, 0, 0, 0.0)}
    assert lattice.score_texts(docs_of(spark, []), F.lit(True), VOCABULARY).count() == 0

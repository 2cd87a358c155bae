import itertools
import random

import numpy as np
import pytest
from helpers import docs_of
from pyspark.sql import functions as F

from streamgauge.llm.langid import best_path, fit_languages, known_language, label_languages

EN = "the cat sat on the mat with that thing and the other things were there".split()
DE = "der hund und die katze sind nicht auf dem dach aber unter einem großen baum".split()
RU = "кот сидел на окне и смотрел на птиц за стеклом".split()


def text(rng, vocabulary, n=40):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(2)
    rows = [(i, text(rng, (EN, DE, RU)[i % 3]), ("en", "de", "ru")[i % 3]) for i in range(90)] + [(900, None, "en"), (901, "", "de"), (902, "the und кот", None)]
    return fit_languages(docs_of(spark, rows), F.col("doc_id") != 5)


def test_documents_and_spans(spark, model):
    rng = random.Random(3)
    mixed = text(rng, EN, 30) + " " + text(rng, DE, 50) + " 123 --- " + text(rng, RU, 8)
    rows = [(1, text(rng, EN)), (2, text(rng, DE)), (3, mixed), (4, None), (5, ""), (6, "12 + 3 = %"), (7, "Кот"), (8, "über"), (1, text(rng, RU)), (None, text(rng, DE)), (9, "the " * 40000), (10, "中文")]
    got = label_languages(docs_of(spark, rows), model).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        assert 0 <= r.score <= 1
    assert sorted(r.lang_pred for r in by[1]) == ["en", "ru"]
    assert {k: by[k][0].lang_pred for k in (2, 3, 4, 5, 6, 7, None, 9)} == {2: "de", 3: "de", 4: "und", 5: "und", 6: "und", 7: "ru", None: "de", 9: "en"}
    assert by[8][0].lang_pred in ("en", "de") and by[10][0].lang_pred != "und"
    spans = by[3][0].spans
    assert [s.lang for s in spans] == ["en", "de", "ru"]
    raw = mixed.encode()
    assert abs(len(raw[spans[0].start : spans[0].end].split()) - 30) <= 2
    assert raw[spans[2].start : spans[2].end].decode().split()[-1] in RU and spans[2].end == len(raw)
    assert by[4][0].spans == [] and by[6][0].score == 0


def test_stage_keeps_rows_whole(spark, model):
    rows = [(1, "the cat", None, "s"), (2, "???", "en", "s"), (3, None, "en", "s"), (4, "der hund", "xx", None)]
    docs = docs_of(spark, rows)
    got = known_language(docs, model)
    assert got.schema == docs.schema
    assert sorted((r.doc_id, r.lang) for r in got.collect()) == [(1, "en"), (4, "xx")]


def test_no_languages(spark):
    empty = fit_languages(docs_of(spark, [(1, "text", None)]), F.lit(True))
    assert [r.lang_pred for r in label_languages(docs_of(spark, [(1, "text")]), empty).collect()] == ["und"]
    assert label_languages(docs_of(spark, []), empty).count() == 0


def test_best_path_equals_enumeration():
    rng = np.random.default_rng(4)
    count = np.array([5, 0, 1, 6, 4, 6])
    scores = rng.normal(0, 3, size=(count.sum(), 3)).astype(np.float32)
    for switch in (0.5, 3.0, 8.0):
        path = best_path(scores, count, switch)
        at = 0
        for n in count:
            own = scores[at : at + n]

            def worth(p):
                return sum(own[i, x] for i, x in enumerate(p)) - switch * sum(a != b for a, b in zip(p, p[1:]))

            best = max((worth(p) for p in itertools.product(range(3), repeat=int(n))), default=0)
            assert worth(path[at : at + n].tolist()) == pytest.approx(best, abs=1e-4)
            at += n


def test_best_path_with_other_languages_side_by_side():
    two = [[0, 7, -20], [0, -20, 7]]
    assert best_path(np.array(two, np.float32), np.array([2]), 8.0).tolist() == [1, 2]
    inner = [[9, -20, -20]] * 3 + [[0, 14, -20], [0, -20, 14]] + [[9, -20, -20]] * 3
    assert best_path(np.array(inner, np.float32), np.array([8]), 8.0).tolist() == [0, 0, 0, 1, 2, 0, 0, 0]
    rng = np.random.default_rng(5)
    count = rng.integers(1, 6, 300)
    scores = rng.normal(0, 4, size=(count.sum(), 4)).astype(np.float32)
    path, at = best_path(scores, count, 6.0), 0
    for n in count:
        own = scores[at : at + n]
        worth = lambda p: sum(own[i, x] for i, x in enumerate(p)) - 6 * sum(a != b for a, b in zip(p, p[1:]))
        assert worth(path[at : at + n].tolist()) == pytest.approx(max(worth(p) for p in itertools.product(range(4), repeat=int(n))), abs=1e-4)
        at += n

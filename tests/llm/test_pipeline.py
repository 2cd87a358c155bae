import os
import random

import pytest
from helpers import DOCS, docs_of, words
from test_near import groups
from test_spans import brute

import __spark_entry__ as contract
import corpus_pipeline
from check import compare, connect
from streamgauge.llm import queries

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder of small tables with odd rows and planted copies, repeats and passages."""
    rng = random.Random(11)
    vocabulary = {k: [f"{k}{a}{b}" for a in "aeiou" for b in "bcdfgh"] for k in ("th", "sch")}
    text = lambda k, n: " ".join(rng.choices(vocabulary[k], k=n))
    rows = [(i, text("th" if i % 3 else "sch", rng.randint(20, 90)), "en" if i % 3 else "de", f"s{i % 4}") for i in range(60)]
    items = [(i, text("th", 25)) for i in range(3)]
    passage = "a passage é that several documents hold, word for word, which is far longer than one hundred bytes in any count of it"
    rows[7] = (7, f"{rows[7][1]} {passage} tail", "en", "s3")
    rows[9] = (9, f"start {passage} {rows[9][1]}", "de", "s1")
    rows += [(70, rows[1][1], "en", "s1"), (71, rows[2][1] + " more", "en", None), (72, f"{text('th', 9)} {items[1][1]} {text('th', 9)}", "en", "s2"), (73, None, "en", "s1"), (74, "", "en", "s1"), (75, "123 ...", "en", "s1")]
    rows += [(None, text("th", 20), "en", "s1"), (5, rows[5][1], "en", "s1"), (76, text("sch", 3000), None, "s0")]
    path = tmp_path_factory.mktemp("tables")
    docs_of(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, items


def test_stages_against_plain_versions(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, path), name)
        assert docs.columns[: len(DOCS.names)] == DOCS.names
        seen.append([(r.doc_id, r.text) for r in docs.collect()])
    known, single, cut, clean, mix = seen
    assert sorted(known) == sorted((r[0], r[1]) for r in rows if r[0] is not None and r[0] not in (73, 74, 75))
    heads = {d for d, _, c in groups(known, 5, 80) if d == c}
    assert sorted(single) == sorted({r for r in known if r[0] in heads})
    want = {d: k.decode() for d, _, _, _, k in brute(single, 100)}
    assert {d: t for d, t in cut if want[d] != t} == {}
    assert want[9] != dict(single)[9] and len(cut) == len(single)
    assert sorted(clean) == sorted(r for r in cut if r[0] != 72)
    sizes = dict(clean)
    copies = {d: sum(1 for x, _ in mix if x == d) for d, _ in clean}
    assert max(copies.values()) <= 2 and all(sizes[d] == t for d, t in mix)
    taken, total = sum(len(words(t)) for _, t in mix), sum(len(words(t)) for _, t in clean)
    assert abs(taken - 1.5 * total) < 0.1 * total


def test_run_gives_the_last_stage(spark, folder):
    path, _, _ = folder
    got = corpus_pipeline.run(spark, path)
    assert got.columns == [*DOCS.names, "mix_copy"] and got.count() > 60


def test_all_operators_are_registered_once():
    keys = [k for k in contract.queries() if k[:2] == "op"]
    assert sorted(int(k[2:].split("_")[0]) for k in keys) == list(range(1, 14))
    assert "pipeline" in contract.queries()


@needs_tables
@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_against_sql(spark, key):
    got = queries.QUERIES[key](spark, SF).toArrow()
    wanted = connect(SF).sql(queries.ORACLES[key]).arrow()
    wanted = wanted.read_all() if hasattr(wanted, "read_all") else wanted
    assert compare(got, wanted) is None


@needs_tables
@pytest.mark.parametrize("key", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_rows_and_columns(spark, key):
    got = queries.QUERIES[key](spark, SF)
    rows = got.collect()
    table = {"op1": "embeddings", "op9": "pages"}.get(key.split("_")[0], "documents")
    whole = spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert len(rows) == (50 if key.startswith("op1_") else whole)

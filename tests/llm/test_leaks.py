import random

import duckdb
import pytest
from helpers import docs_of

from streamgauge.llm import queries
from streamgauge.llm.leaks import MASKED, MASKS, find_leaks, leak_report, without_leaks

VOCABULARY = [f"word{i}" for i in range(300)]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(6)
    items = [(i, " ".join(rng.choices(VOCABULARY, k=30))) for i in range(5)] + [(10, "too short an item"), (11, None), (12, ""), (None, "a b c d e f g h i j k l"), (0, None)]
    noise = lambda n: " ".join(rng.choices(VOCABULARY, k=n))
    changed = items[1][1].split()
    for at in (4, 11, 18, 25):
        changed[at] = "other"
    torn = items[2][1].split()[:9]
    rows = [
        (1, f"{noise(40)} {items[0][1].upper()}! {noise(10)}"), (2, f"{noise(5)} {' '.join(changed)}"), (3, f"{noise(50)} {' '.join(torn)} {noise(50)}"), (4, noise(200)), (5, None), (6, ""),
        (7, "Too short an item"), (8, f"{items[3][1]}\n{items[4][1]}"), (8, noise(20)), (None, items[0][1]), (9, " ".join(items[3][1].split()[12:])), (10, noise(20000)),
    ]
    return docs_of(spark, rows), spark.createDataFrame([(*r, "?") for r in items], "item_id long, text string, doc_id string")


def test_exact_substituted_and_torn_passages(tables):
    docs, benchmark = tables
    got = {(r.doc_id, r.item_id): r.matched for r in find_leaks(docs, benchmark).collect()}
    assert set(got) == {(1, 0), (2, 1), (7, 10), (8, 3), (8, 4), (9, 3)}
    assert got[1, 0] == 20 and got[2, 1] == 18 and got[9, 3] == 18


def test_report_and_filter(tables):
    docs, benchmark = tables
    leaks = find_leaks(docs, benchmark)
    report = leak_report(docs, leaks).collect()
    assert len(report) == 12
    assert sorted(((r.doc_id, r.n_items, r.item_id) for r in report if r.contaminated)) == [(1, 1, 0), (2, 1, 1), (7, 1, 10), (8, 2, 3), (8, 2, 3), (9, 1, 3)]
    kept = without_leaks(docs, benchmark)
    assert kept.schema == docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [3, 4, 5, 6, None, 10]))


def test_no_python_in_the_plan(tables, monkeypatch):
    docs, benchmark = tables
    plan = leak_report(docs, find_leaks(docs, benchmark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "MapInArrow" not in plan


def test_joins_by_shuffle_beyond_the_bound(tables, monkeypatch):
    from streamgauge.llm import leaks as module

    monkeypatch.setattr(module, "MOST_BROADCAST", 0)
    docs, benchmark = tables
    assert find_leaks(docs, benchmark).count() == 6


def test_masks_ignore_positions_and_no_allowed_pattern_spoils_them():
    assert all(len(m) < m[-1] + 1 for m in MASKS)
    for w in range(MASKED, 21):
        places = [sum(1 << (at + i) for i in m) for m in MASKS for at in range(w - m[-1])]

        def spoiled(left, errors):
            if not left or not errors:
                return not left
            first = [1 << i for i in range(w) if left[0] >> i & 1]
            return any(spoiled([p for p in left if not p & bit], errors - 1) for bit in first)

        assert not spoiled(places, w // 4), w


@pytest.fixture(scope="module")
def substituted(spark):
    rng = random.Random(8)
    rows, items, want = [], [], set()
    for n in (1, 3, 5, 8, 9, 12, 15, 16, 19, 20, 23, 40):
        items.append((n, " ".join(f"i{n}t{j}" for j in range(n))))
        window = min(n, 20)
        for k in range(60):
            spoiled = rng.sample(range(window), window // 4 + k % 2)
            if k < 4:
                spoiled = range(k, n, 4)
            got = [f"x{j}" if j in spoiled else t for j, t in enumerate(items[-1][1].split())]
            rows.append((len(rows), " ".join(["before", "it", *got, "after", "it"])))
            best = max(sum(j not in spoiled for j in range(a, a + window)) for a in range(n - window + 1))
            if best >= (0.75 if n >= 9 else 1) * window:
                want.add((rows[-1][0], n, best))
    rows += [(9000, " ".join(["i20t1 i20t2 i20t3 y"] * 40)), (9001, "i20t1 i20t2 i20t3"), (9002, "i8t0 " * 8), (9003, "i20t0 i20t1 i20t2 i20t3 i20t4")]
    return rows, items, want


def test_every_allowed_substitution_is_found(spark, substituted):
    rows, items, want = substituted
    found = find_leaks(docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.matched) for r in found.collect()} == want and len(want) > 350


def test_query_and_twin_agree_on_substitutions(spark, substituted, tmp_path):
    rows, items, want = substituted
    docs_of(spark, rows).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r.doc_id, r.contaminated, r.n_items, r.item_id, r.matched) for r in queries.op8_decontaminate(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"create view {name} as select * from read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    rows = con.sql("select doc_id, contaminated, n_items, item_id, matched from (" + queries.ORACLES["op8_decontaminate"] + ")").fetchall()
    assert got == set(rows) and sum(r[1] for r in rows) == len({w[0] for w in want})


def test_empty(spark, tables):
    docs, benchmark = tables
    assert find_leaks(docs.limit(0), benchmark).count() == 0
    assert find_leaks(docs, benchmark.limit(0)).count() == 0
    assert without_leaks(docs, benchmark.limit(0)).count() == 12

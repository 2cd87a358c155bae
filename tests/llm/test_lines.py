import random

import pytest
from helpers import docs_of

from streamgauge.llm.lines import LineRuns, line_keys, remove_shared_lines

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\f\r").translate(FOLD)


def by_hand(rows, least, documents):
    """Every row's lines, held against the sets of all rows."""
    holders = {}
    for doc_id, text, *_ in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= least:
                holders.setdefault(k, []).append(-1 if doc_id is None else doc_id)
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        mine = -1 if doc_id is None else doc_id
        kept = [x for x in lines if len(holders.get(key(x), [])) < documents or max(holders[key(x)]) == mine]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in df.collect()), key=str)


LINES = ["Übergrößen überall hier", "überGRÖSSEN x", "  A shared line of words \t", "a SHARED line of words", "\x0b\x0ca shared line of words\r", "short", "", " \t ", "É" * 20, "é" * 20, " separator is no line end"]


@pytest.fixture(scope="module")
def rows():
    dice = random.Random(3)
    docs = [(i * 3 % 90, "\n".join(dice.choice(LINES) for _ in range(dice.randint(1, 8))), None, "s") for i in range(60)]
    odd = [(1000, None), (1001, ""), (1002, "\n"), (1003, "\n\n" + LINES[2] + "\n"), (None, LINES[2] + "\n" + "only here, where no doc_id is"), (None, LINES[8])]
    again = [(5000, LINES[3] + "\nend"), (5000, LINES[3] + "\nend"), (5000, "other text of one id")]
    return docs + odd + again + [(2000 + i, "\n".join([LINES[2]] * 500)) for i in range(3)]


@pytest.mark.parametrize("least,documents,batches", [(10, 5, 4), (10, 2, 3), (1, 3, 1), (24, 5, 7)])
def test_equals_all_lines_by_hand(spark, rows, least, documents, batches):
    assert rows_of(remove_shared_lines(docs_of(spark, rows), least, documents, batches)) == by_hand(rows, least, documents)


def test_nobody_holds_more_than_null(spark):
    rows = [(None, "a line without any id")] * 6
    assert [r.n_dropped for r in remove_shared_lines(docs_of(spark, rows), 10, 5).collect()] == [0] * 6


def test_empty(spark):
    assert remove_shared_lines(docs_of(spark, [])).collect() == []


def test_a_document_may_lose_everything(spark):
    rows = [(i, "every document has this line") for i in range(5)]
    assert rows_of(remove_shared_lines(docs_of(spark, rows), 10, 5)) == [(i, 1, 1, "") for i in range(4)] + [(4, 1, 0, rows[0][1])]


def test_runs_are_compacted_and_not_shuffled(spark):
    runs = LineRuns(spark, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    expected = {}
    for b in range(6):
        docs = [(100 - b, "\n".join(f"line number {i}" for i in range(b, b + 3)))]
        for i in range(b, b + 3):
            expected.setdefault(f"line number {i}", []).append(100 - b)
        runs.add(line_keys(docs_of(spark, docs), 1))
    assert [name is not None for name in runs.levels] == [False, True, True]
    got = sorted((r.docs, r.holder.id) for r in runs.totals().collect())
    assert got == sorted((len(v), max(v)) for v in expected.values())
    plan = runs.totals()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan or "Exchange" not in plan.replace("BroadcastExchange", "")
    runs.forget()
    assert not any(spark.catalog.tableExists(name) for name in runs.written)

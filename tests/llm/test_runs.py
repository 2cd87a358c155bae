import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from helpers import docs_of

from streamgauge.llm import queries
from streamgauge.llm.runs import find_runs, word_runs

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(words, least=6, times=4):
    """Every period of every stretch."""
    out, n = [], len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            stretch = words[s : s + length]
            smaller = any(all(stretch[k] == stretch[k + p] for k in range(length - p)) for p in range(1, q))
            if length >= max(least, times * q) and not smaller:
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def texts():
    dice = random.Random(11)
    out = [["a"] * 5, ["a"] * 6, ["a"] * 100, ["a", "b"] * 4, ["a", "b"] * 3 + ["a"], list("abcabcabcab"), list("abc" * 4), list("aabaabaabaab" * 4), fibonacci(300), (["a"] * 12 + ["b"]) * 9, (["a"] * 8 + ["b"]) * 4 + ["a"] * 30]
    for _ in range(120):
        letters = "ab" if dice.random() < 0.5 else "abcd"
        words = []
        while len(words) < dice.randint(1, 150):
            root = [dice.choice(letters) for _ in range(dice.choice([1, 1, 2, 3, 5, 8, 13]))]
            words += root * dice.choice([1, 1, 2, 4, 5, 9]) + root[: dice.randint(0, len(root))]
        out.append(words)
    for p in (1, 7, 31, 32, 33, 63, 64, 65, 100):
        root = [f"w{dice.randint(0, 10**6)}" for _ in range(p)]
        out.append([f"x{i}" for i in range(dice.randint(0, 90))] + root * 4 + root[: p // 2] + ["end"])
        out.append(root * 4)
        out.append((root * 4)[:-1])
    return out


def test_equals_every_period_by_hand():
    rows = texts()
    number = {w: i for i, w in enumerate(sorted({w for r in rows for w in r}))}
    for some in (rows, rows[::-1], *[[r] for r in rows[:20]]):
        counts = np.array([len(r) for r in some])
        got = word_runs(np.array([number[w] for r in some for w in r]), counts, 6, 4)
        begins = np.cumsum(counts) - counts
        want = sorted((s + b, n, q) for r, b in zip(some, begins.tolist()) for s, n, q in by_hand(r))
        assert sorted(zip(*(x.tolist() for x in got))) == want


@pytest.mark.parametrize("least,times", [(1, 4), (12, 4), (6, 6)])
def test_other_limits(least, times):
    for words in texts():
        number = {w: i for i, w in enumerate(sorted(set(words)))}
        got = word_runs(np.array([number[w] for w in words]), np.array([len(words)]), least, times)
        assert sorted(zip(*(x.tolist() for x in got))) == sorted(by_hand(words, least, times))


def test_fewer_repetitions_are_refused():
    with pytest.raises(ValueError):
        word_runs(np.zeros(9, np.int64), np.array([9]), 6, 3)


def test_long_runs_end_soon():
    a = word_runs(np.zeros(300_000, np.int64), np.array([300_000]), 6, 4)
    assert [x.tolist() for x in a] == [[0], [300_000], [1]]
    b = word_runs(np.tile(np.arange(1000), 300), np.array([300_000]), 6, 4)
    assert [x.tolist() for x in b] == [[0], [300_000], [1000]]


def test_table(spark):
    dice = random.Random(5)
    rows = [(i, "".join(w + dice.choice([" ", "\n", " \t", "\x0b", "\r\n"]) for w in words)) for i, words in enumerate(texts())]
    rows += [(500, None), (501, ""), (502, " \n "), (None, "a a a a a a a"), (7, "é é é é é é é"), (7, "é é é é é é é"), (503, "É x " * 6), (504, "no run here " * 2)]
    got = find_runs(docs_of(spark, rows)).collect()
    want = []
    for doc_id, text in rows:
        words = SPLIT.findall(text or "")
        runs = by_hand(words)
        want.append((doc_id, len(words), runs, collapsed(words, runs)))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept) for r in got), key=str) == sorted(want, key=str)


def test_empty(spark):
    assert find_runs(docs_of(spark, [])).collect() == []


def test_query_equals_its_contract_by_hand(spark, tmp_path):
    dice = random.Random(9)
    rows = [(i, " ".join(dice.choice("abcdefghij") * dice.randint(1, 2) for _ in range(dice.randint(0, 90)))) for i in range(150)]
    rows += [(900, None), (901, "")]
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op12_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    looped = 0
    for doc_id, text in rows:
        words = SPLIT.findall(text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            looped += 1
        runs = by_hand(words)
        r = got[doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (best[1] * 1000 // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert looped > 5

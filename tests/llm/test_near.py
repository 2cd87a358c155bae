import random

import numpy as np
import pytest
from helpers import docs_of, words

from streamgauge.llm import near
from streamgauge.llm.graph import components


def groups(rows, n, percent):
    """Sizes and components from all pairs of rows."""
    sets, least = [], {}
    for doc_id, text in rows:
        w = words(text)
        sets.append((doc_id, {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())))
        least.setdefault(doc_id, doc_id)

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                if x != y:
                    least[max(x, y)] = min(x, y)
    return sorted(((d, len(s), find(d)) for d, s in sets), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rng.choices(vocabulary, k=60) for _ in range(6)]
    out = []
    for i in range(150):
        w = list(base[i % 6])
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(60)] = rng.choice(vocabulary)
        out.append((i, " ".join(w)))
    out += [(200, None), (201, ""), (202, " \t"), (203, "Solo"), (204, "sOLO"), (205, "one two"), (206, "ONE  two"), (207, "é É"), (208, "É é"), (None, out[0][1]), (3, out[3][1]), (209, out[7][1].upper())]
    return out + [(300, " ".join(rng.choices(vocabulary, k=30000)))]


@pytest.mark.parametrize("n", [2, 5])
def test_equals_all_pairs(spark, rows, n):
    got = near.near_duplicates(docs_of(spark, rows), words=n).collect()
    want = groups(rows, n, 80)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_empty(spark):
    assert near.near_duplicates(docs_of(spark, [])).count() == 0


def test_signatures_within_the_radius_share_a_key():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = rng.integers(0, 256, near.INDEXED)
        b = a.copy()
        b[rng.choice(near.INDEXED, near.RADIUS, replace=False)] += 1
        assert (near.chunk_keys(a[None]) == near.chunk_keys(b[None])).any()


def joined(pairs):
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    return {x: top(x) for x in list(parent)}


def test_tiles_join_a_large_bucket_with_few_pairs(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 4)
    sig = bytes(near.SYMBOLS)
    far = bytes([9]) * near.SYMBOLS
    rows = [(key, i, 30, i % 7, sig, 10) for i in range(30) for key in (64, 65)] + [(128, 100 + i, 3, i, sig, 10 + i * 3) for i in range(2)] + [(128, 110, 3, 9, far, 10)]
    got = [(r.a, r.b) for r in near._across(spark.createDataFrame(rows, "key long, rep long, n_members long, component long, sig binary, n long"), 80).collect()]
    assert all(a % 7 != b % 7 for a, b in got if a < 100)
    assert joined(got) == {i: 0 for i in range(30)}
    tiles = 8 * 9 / 2
    assert len(got) < 30 + 8 * tiles


def test_reduced_pairs_join_the_same_rows(spark):
    dice = random.Random(4)
    pairs = [(g * 100 + dice.randrange(20), g * 100 + dice.randrange(20)) for g in (0, 1, 2) for _ in range(400)]
    got = [(r.a, r.b) for r in near._reduced(spark.createDataFrame(pairs, "a long, b long").repartition(5)).collect()]
    assert set(got) <= set(pairs) and joined(got) == joined(pairs) and len(got) == 57


def test_shared_sizes(monkeypatch):
    monkeypatch.setattr(near, "COLUMNS", 3)
    dice = random.Random(2)
    sets = [sorted(dice.sample(range(40), dice.randint(0, 30))) for _ in range(12)]
    got = near.shared_sizes([np.array(x, np.uint64) for x in sets])
    assert [[got[i, j] for j in range(12) if j != i] for i in range(12)] == [[len(set(a) & set(b)) for j, b in enumerate(sets) if j != i] for i, a in enumerate(sets)]


@pytest.mark.parametrize("block,size", [(512, 4 << 20), (3, 4 << 20), (512, 500)])
def test_links_of_a_group_in_tiles(spark, monkeypatch, block, size):
    monkeypatch.setattr(near, "BLOCK", block)
    monkeypatch.setattr(near, "BLOCK_BYTES", size)
    dice = random.Random(6)
    sets = [frozenset(dice.sample(range(30), 24)) if i % 3 else frozenset(range(24)) - {dice.randrange(24)} for i in range(40)]
    rows = [(i % 2, i, i % 11, np.array(sorted(x), np.uint64).tobytes()) for i, x in enumerate(sets)]
    links = [(a, b) for a in range(40) for b in range(a + 1, 40) if a % 2 == b % 2 and a % 11 != b % 11 and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    got = [(r.a, r.b) for r in near._linked(spark.createDataFrame(rows, "group long, rep long, component long, held binary"), 80).collect()]
    assert {(min(p), max(p)) for p in got} <= set(links) and joined(got) == joined(links)


def test_decoys_below_the_threshold(spark):
    """Two hundred copies that are close to each other, few of them close enough: the hard case for signatures."""
    dice = random.Random(12)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(200):
        w = list(base)
        for p in dice.sample(range(80), dice.randint(4, 12)):
            w[p] = f"x{dice.randrange(12) if dice.random() < 0.6 else i * 100 + p}"
        rows.append((i, " ".join(w)))
    got = near.near_duplicates(docs_of(spark, rows), words=2).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == groups(rows, 2, 80)


def test_first_slot_names_the_first_equal_key():
    rng = np.random.default_rng(5)
    for _ in range(300):
        a = rng.integers(0, 256, near.INDEXED).astype(np.uint8)
        b = a.copy()
        b[rng.choice(near.INDEXED, rng.integers(0, near.RADIUS + 1), replace=False)] += 1
        equal = np.flatnonzero(near.chunk_keys(a[None])[0] == near.chunk_keys(b[None])[0])
        assert near.first_slot(a[None], b[None])[0] == equal[0]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 120)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

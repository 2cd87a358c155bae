import pytest
from helpers import docs_of, words

from streamgauge.llm.mixing import systematic_sample


def level(sizes, weights, share=1.5, most=2):
    """Targets by sharing out again and again."""
    target, left, room = {}, set(sizes), share * sum(sizes.values())
    while left:
        total = sum(weights[s] for s in left)
        over = {s for s in left if room * weights[s] / total > most * sizes[s]}
        if not over:
            return target | {s: room * weights[s] / total for s in left}
        for s in over:
            target[s] = most * sizes[s]
            room -= target[s]
        left -= over
    return target


@pytest.fixture(scope="module")
def rows():
    docs = [(i, "w " * (1 + i * 7 % 40), None, f"s{i % 5 if i % 3 else 0}") for i in range(300)]
    return docs + [(400, None, None, "s1"), (401, "", None, "s9"), (402, "a b", None, None), (402, "a b", None, None), (None, "q q q", None, "é"), (403, "x", None, None)]


def test_targets_and_copies(spark, rows):
    got = systematic_sample(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = level(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)})
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 40, s


def test_reruns_agree_on_other_partitions(spark, rows):
    docs = docs_of(spark, rows)
    a = sorted(systematic_sample(docs).collect(), key=str)
    b = sorted(systematic_sample(docs.repartition(7, "text")).collect(), key=str)
    assert a == b


def test_empty(spark):
    assert systematic_sample(docs_of(spark, [])).count() == 0
    assert [r.taken for r in systematic_sample(docs_of(spark, [(1, None, None, "a")])).collect()] == [0]

"""k-means of many starts against plain loops from the same starts."""

import numpy as np
import pytest

from streamgauge.operators.clusters import assign_clusters, best_centers, first_centers, lloyd_step


@pytest.fixture(scope="module")
def points(spark):
    dice = np.random.default_rng(4)
    x = np.concatenate([dice.normal(c, 0.6, (60, 7)) for c in (0.0, 2.0, 3.0, 9.0)])
    return x, spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, v array<double>").repartition(5).cache()


def by_hand(x, centers, steps):
    centers, costs = centers.copy(), []
    for _ in range(steps):
        apart = ((x[:, None, :] - centers[None]) ** 2).sum(2)
        place = apart.argmin(1)
        costs.append(apart.min(1).sum())
        moved = np.array([x[place == i].mean(0) if (place == i).any() else centers[i] for i in range(len(centers))])
        if ((moved - centers) ** 2).sum(1).max() <= 1e-8:
            centers = moved
            break
        centers = moved
    return centers, costs[-1]


def test_starts_are_points_of_the_table_and_repeat(points):
    x, df = points
    a = first_centers(df, "id", "v", 4, 6, 42)
    assert a.shape == (6, 4, 7) and np.array_equal(a, first_centers(df.repartition(2), "id", "v", 4, 6, 42))
    known = {tuple(r) for r in x}
    assert all(tuple(c) in known for c in a.reshape(-1, 7)) and len({tuple(c) for c in a[0]}) == 4


def test_one_scan_moves_all_starts(points):
    x, df = points
    starts = first_centers(df, "id", "v", 4, 6, 1)
    moved, cost = lloyd_step(df, "v", starts)
    for i, start in enumerate(starts):
        want, first_cost = by_hand(x, start, 1)
        assert np.allclose(moved[i], want) and cost[i] == pytest.approx(first_cost)


def test_best_start_equals_loops(points):
    x, df = points
    starts = first_centers(df, "id", "v", 4, 8, 42)
    runs = [by_hand(x, s, 20) for s in starts]
    want = min(runs, key=lambda r: r[1])
    centers = best_centers(df, "id", "v", 4, 8, 42, 20)
    assert np.allclose(centers, want[0], atol=1e-6)
    got = {r.id: r.c for r in assign_clusters(df, "v", centers, "c").collect()}
    assert [got[i] for i in range(len(x))] == ((x[:, None, :] - want[0][None]) ** 2).sum(2).argmin(1).tolist()


def test_few_equal_and_no_points(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3)], "id long, v array<double>")
    centers = best_centers(df, "id", "v", 4, 3)
    assert centers.tolist() == [[1.0, 2.0]] * 3
    assert {r.c for r in assign_clusters(df, "v", centers, "c").collect()} == {0}
    none = best_centers(df.filter("false"), "id", "v", 4, 3)
    assert none.shape[0] == 0

"""k-means with many starts, against plain Lloyd steps in numpy."""

import numpy as np
import pytest

from locusframe.operators import clusters

COLS = ["x", "y"]


def frame(spark, x):
    return spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(x)], "id long, x double, y double").repartition(3)


def lloyd(x, centres, steps=300):
    centres = centres.copy()
    for _ in range(steps):
        near = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        centres = np.array([x[near == c].mean(0) if (near == c).any() else centres[c] for c in range(len(centres))])
    return centres, ((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum()


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(5)
    return np.concatenate([rng.normal(at, 0.6, (40, 2)) for at in ((0, 0), (3, 0), (0, 4), (6, 6), (7, 4))])


def test_starts_are_fixed_points_and_the_best_is_as_good_as_many_lloyd_runs(spark, blobs):
    fits = clusters.k_means_starts(frame(spark, blobs), COLS, 5, starts=20, tol=1e-9)
    assert len(fits) == 20 and all(f["converged"] for f in fits)
    for f in fits:
        centres, cost = lloyd(blobs, np.array(f["centres"]), 1)
        assert np.allclose(sorted(centres.tolist()), f["centres"]) and cost == pytest.approx(f["cost"])
    assert [f["cost"] for f in fits] == sorted(f["cost"] for f in fits)
    rng = np.random.default_rng(1)
    runs = [lloyd(blobs, blobs[rng.choice(len(blobs), 5, replace=False)], 60)[1] for _ in range(50)]
    assert fits[0]["cost"] <= min(runs) * (1 + 1e-9)
    again = clusters.k_means_starts(frame(spark, blobs).coalesce(1), COLS, 5, starts=20, tol=1e-9)
    assert np.allclose(again[0]["centres"], fits[0]["centres"])


def test_labels_missing_values_and_extra_columns(spark, blobs):
    rows = [(i, *map(float, r)) for i, r in enumerate(blobs)] + [(1000, None, 1.0), (1001, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    out = clusters.with_clusters(df, COLS, 5, "c", starts=10)
    assert out.columns == ["id", "x", "y", "c"]
    got = {r["id"]: r["c"] for r in out.collect()}
    assert len(got) == len(rows) and got[1000] == got[1001] == -1
    best = np.array(clusters.k_means_starts(frame(spark, blobs), COLS, 5, starts=10)[0]["centres"])
    near = ((blobs[:, None] - best[None]) ** 2).sum(2).argmin(1)
    assert [got[i] for i in range(len(blobs))] == near.tolist()


def test_few_rows_and_no_rows(spark):
    twice = spark.createDataFrame([(1.0, 2.0)] * 5 + [(3.0, 4.0)], "x double, y double")
    assert sorted(r["c"] for r in clusters.with_clusters(twice, COLS, 2, "c", starts=3).collect()) == [0, 0, 0, 0, 0, 1]
    assert clusters.k_means_starts(twice, COLS, 4, starts=3)[0]["cost"] == 0
    none = twice.where("x > 5")
    assert clusters.k_means_starts(none, COLS, 2) == [] and clusters.with_clusters(none, COLS, 2, "c").count() == 0
    missing = spark.createDataFrame([(None, 1.0)], "x double, y double")
    assert [r["c"] for r in clusters.with_clusters(missing, COLS, 2, "c").collect()] == [-1]


def test_a_fit_that_did_not_converge_is_reported(spark, blobs):
    with pytest.warns(UserWarning, match="stopped after 1 steps"):
        clusters.with_clusters(frame(spark, blobs), COLS, 5, "c", starts=2, most_steps=1)

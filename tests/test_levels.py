"""Overlap pairs of rows of very different lengths, against a scan of all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from locusframe.operators import overlap

COLS = "chrom string, start_pos long, end_pos long, name string"
SIZE = 150_000_000


def mixed_rows(seed, n, lengths):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        length = min(SIZE, max(1, int(rnd.choice(lengths) * rnd.uniform(0.5, 1.5))))
        start = rnd.randrange(SIZE - length + 1)
        rows.append((f"chr{rnd.randrange(2)}", start, start + length, f"{seed}.{i}"))
    # starts and ends on the borders of bins of every level
    for i, at in enumerate((1 << 14, 1 << 20, 1 << 26)):
        rows += [("chr0", at - 5, at, f"{seed}.l{i}"), ("chr0", at, at + 5, f"{seed}.r{i}"), ("chr0", at - 5, at + 5, f"{seed}.m{i}")]
    return rows


def all_pairs(a, b):
    bp = lambda x, y: min(x[2], y[2]) - max(x[1], y[1])
    return sorted((x[3], y[3], bp(x, y)) for x in a for y in b if x[0] == y[0] and bp(x, y) > 0)


EVERY = [10, 1_000, 20_000, 300_000, 5_000_000, 30_000_000, 100_000_000, SIZE]


@pytest.mark.parametrize("one, two", [(EVERY, EVERY), ([10, 1_000], EVERY), (EVERY, [10]), ([SIZE], [10, 1_000]), ([10], [10, 1_000])])
def test_rows_of_any_length(spark, one, two):
    a, b = mixed_rows(1, 150, one), mixed_rows(2, 150, two)
    out = overlap.overlap_join(spark.createDataFrame(a, COLS), spark.createDataFrame(b, COLS))
    assert sorted((r["name"], r["name_b"], r["bp"]) for r in out.collect()) == all_pairs(a, b)


@pytest.mark.parametrize("width", [1, 7, 1 << 10])
def test_narrow_bins(spark, width):
    rnd = random.Random(3)
    rows = lambda mark: [("chr0", s, s + rnd.choice([1, 3, 20, 200, 9_000, 90_000]), f"{mark}{i}") for i, s in enumerate(rnd.randrange(100_000) for _ in range(60))]
    a, b = rows("a"), rows("b")
    out = overlap.overlap_join(spark.createDataFrame(a, COLS), spark.createDataFrame(b, COLS), width=width)
    assert sorted((r["name"], r["name_b"], r["bp"]) for r in out.collect()) == all_pairs(a, b)


def test_rows_listed_do_not_grow_with_length(spark):
    rows = [("chr0", i, i + SIZE, f"w{i}") for i in range(20)] + [("chr0", i * 1000, i * 1000 + 100, f"s{i}") for i in range(500)]
    df = spark.createDataFrame(rows, COLS)
    short = df.where("name like 's%'")
    listed = lambda x, y, mark: overlap._binned(x, overlap.levels_of(y), overlap.WIDTH, mark).count()
    assert listed(short, short, "") <= 1.1 * 500  # once, and again where a border is crossed
    assert listed(df, short, "") <= 20 * (overlap.TILES + 1) + 1.1 * 500
    assert listed(short, df, "_r") <= 2 * 1.1 * 500  # its own level and that of the long rows
    pairs = overlap.overlap_join(df, short)
    assert pairs.count() == 20 * 500 - sum(i >= 100 for i in range(20)) + 500


def test_empty_and_null_sides(spark):
    df = spark.createDataFrame([("chr0", 0, SIZE, "a"), (None, 0, 5, "b")], COLS)
    none = df.limit(0)
    assert overlap.overlap_join(df, none).count() == 0 and overlap.overlap_join(none, df).count() == 0
    assert [r["name"] for r in overlap.overlap_join(df, df).collect()] == ["a"]
    assert {r["name"]: r["bp"] for r in overlap.overlap_join(df, none, how="left").collect()} == {"a": 0, "b": 0}
    assert overlap.overlap_join(df, df, suffix="_r").where(F.col("name_r") == "a").count() == 1


def test_a_known_length_spares_the_lookup(spark):
    a, b = mixed_rows(6, 60, [10, 20_000]), mixed_rows(7, 60, [1_000, 100_000])
    frames = [spark.createDataFrame(rows, COLS) for rows in (a, b)]
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    known, asked = overlap.overlap_join(*frames, longest=150_000), overlap.overlap_join(*frames, longest=10**9)
    assert "scalar-subquery" not in plan(known) and "scalar-subquery" in plan(asked)
    for out in (known, asked):
        assert sorted((r["name"], r["name_b"], r["bp"]) for r in out.collect()) == all_pairs(a, b)

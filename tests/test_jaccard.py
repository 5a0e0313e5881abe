"""Pairwise overlap of many sets by one sweep, against per-base sets."""

import itertools
import random

import pytest

from locusframe.operators import overlap


def islands(bases):
    out = []
    for b in sorted(bases):
        if out and out[-1][1] == b:
            out[-1][1] = b + 1
        else:
            out.append([b, b + 1])
    return out


@pytest.mark.parametrize(("n_sets", "n_rows"), [(3, 40), (70, 6), (130, 3)])
def test_against_bases(spark, n_sets, n_rows):
    r = random.Random(n_sets)
    rows = [(f"S{i:03}", f"chr{r.randint(1, 2)}", (a := r.randint(0, 300)), a + r.randint(1, 60)) for i in range(n_sets) for _ in range(n_rows)]
    rows += [("S000", "chr1", 100, 110), ("S000", "chr1", 110, 120), ("S001", "chr1", 105, 118)]
    df = spark.createDataFrame(rows, "sample string, chrom string, start_pos long, end_pos long")
    got = {(x["set_a"], x["set_b"]): tuple(x)[2:] for x in overlap.interval_jaccard(df, "sample", block=64).collect()}
    bases, merged = {}, {}
    for s in sorted({x[0] for x in rows}):
        bases[s] = {(c, b) for t, c, a, e in rows if t == s for b in range(a, e)}
        merged[s] = [(c, *i) for c in ("chr1", "chr2") for i in islands(b for d, b in bases[s] if d == c)]
    assert len(got) == n_sets * (n_sets - 1) // 2
    for a, b in itertools.combinations(sorted(bases), 2):
        shared, union = len(bases[a] & bases[b]), len(bases[a] | bases[b])
        n = sum(x[0] == y[0] and x[1] < y[2] and y[1] < x[2] for x in merged[a] for y in merged[b])
        assert got[a, b] == (shared, union, shared / union, n)


def test_no_join_of_the_rows_with_themselves(spark):
    df = spark.createDataFrame([("a", "c", 1, 5), ("b", "c", 3, 9)], "sample string, chrom string, start_pos long, end_pos long")
    names = df.select("sample").distinct().selectExpr("sample", "cast(ascii(sample) - 97 as bigint) AS number")
    plan = overlap.membership_runs(df, "sample", names, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "_bin" not in plan and "sequence" not in plan.split("Aggregate")[-1]

"""Every interval operator against a per-base mask on small random chromosomes."""

import random

import numpy as np
import pytest

from locusframe.operators import assemblies, graph, lineage, overlap, scaffolds, sweep

SIZE = {"chr1": 200, "chr2": 130}
BLOCKS = [7, 1 << 18]


def random_rows(seed, n=25, chroms=("chr1", "chr2"), extra=()):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        chrom = rnd.choice(chroms)
        start = rnd.randrange(SIZE[chrom] - 1)
        end = min(SIZE[chrom], start + rnd.choice([1, 2, 5, 10, 40]))
        rows.append((chrom, start, end, f"n{i}", rnd.randrange(0, 100), f"s{rnd.randrange(4)}"))
    rows += [("chr1", 10, 20, "t1", 5, "s0"), ("chr1", 20, 30, "t2", 6, "s0"), ("chr1", 10, 20, "t1", 5, "s0")]
    return rows + list(extra)


COLS = "chrom string, start_pos long, end_pos long, name string, score long, grp string"


def frame(spark, rows):
    return spark.createDataFrame(rows, COLS)


def sizes(spark):
    return spark.createDataFrame(list(SIZE.items()), "chrom string, size long")


def depth(rows, chrom):
    d = np.zeros(SIZE[chrom], dtype=int)
    for r in rows:
        if r[0] == chrom:
            d[r[1]:r[2]] += 1
    return d


def runs(mask, chrom):
    padded = np.concatenate([[0], mask.astype(int), [0]])
    step = np.diff(padded)
    return {(chrom, int(s), int(e)) for s, e in zip(np.where(step == 1)[0], np.where(step == -1)[0])}


def got(df, *cols):
    cols = cols or ("chrom", "start_pos", "end_pos")
    rows = [tuple(r) for r in df.select(*cols).collect()]
    return rows


def regions_equal(df, expected):
    rows = got(df)
    assert len(rows) == len(set(rows))
    assert set(rows) == expected


def ovl(x, y):
    return max(0, min(x[2], y[2]) - max(x[1], y[1])) if x[0] == y[0] else 0


@pytest.mark.parametrize("block", BLOCKS)
def test_merge_complement_subtract(spark, block):
    a, b = random_rows(1), random_rows(2, 12, chroms=("chr1",))
    da, db = frame(spark, a), frame(spark, b)
    regions_equal(sweep.merge_intervals(da, block=block), set().union(*[runs(depth(a, c) > 0, c) for c in SIZE]))
    regions_equal(sweep.complement(db, sizes(spark), block=block), runs(depth(b, "chr1") == 0, "chr1"))
    regions_equal(
        sweep.complement(db, sizes(spark), only_hit=False, block=block),
        set().union(*[runs(depth(b, c) == 0, c) for c in SIZE]),
    )
    expected = []
    for r in a:
        mask = np.zeros(SIZE[r[0]], dtype=bool)
        mask[r[1]:r[2]] = True
        mask &= depth(b, r[0]) == 0
        expected += sorted(runs(mask, r[0]))
    assert sorted(got(sweep.subtract(da, db, block=block))) == sorted(expected)


def test_merge_gap_and_names(spark):
    a = [("chr1", 0, 5, "b", 0, "x"), ("chr1", 7, 9, "a", 0, "x"), ("chr1", 12, 15, "a", 0, "x")]
    out = sweep.merge_intervals(frame(spark, a), gap=2, names="name", sep="@")
    assert sorted(got(out, "start_pos", "end_pos", "names")) == [(0, 9, "a@b"), (12, 15, "a")]


@pytest.mark.parametrize("block", BLOCKS)
def test_sets_disjoin_depth(spark, block):
    a = random_rows(3, 40)
    da = frame(spark, a)
    for chrom in SIZE:
        d = depth(a, chrom)
        runs_out = {r[1:] for r in got(sweep.depth_runs(da, block=block), "chrom", "start_pos", "end_pos", "depth") if r[0] == chrom}
        back = np.zeros(SIZE[chrom], dtype=int)
        for s, e, v in runs_out:
            back[s:e] = v
            assert s == 0 or d[s - 1] != v
        assert (back == d).all()
    per_base = {(r[0], r[1]): r[2] for r in got(sweep.depth_per_base(da, sizes(spark), block=block), "chrom", "pos", "depth")}
    assert per_base == {(c, i + 1): int(v) for c in SIZE for i, v in enumerate(depth(a, c))}
    k = {c: sum((depth([r for r in a if r[5] == g], c) > 0).astype(int) for g in ["s0", "s1", "s2", "s3"]) for c in SIZE}
    regions_equal(sweep.multi_intersect(da, "grp", ["s0", "s1", "s2", "s3"], block=block), set().union(*[runs(k[c] == 4, c) for c in SIZE]))
    regions_equal(sweep.set_count_regions(da, ["grp"], lambda n: n >= 2, block=block), set().union(*[runs(k[c] >= 2, c) for c in SIZE]))
    cuts = {c: sorted({p for r in a if r[0] == c for p in r[1:3]}) for c in SIZE}
    regions_equal(
        sweep.disjoin(da, block=block),
        {(c, s, e) for c in SIZE for s, e in zip(cuts[c], cuts[c][1:]) if depth(a, c)[s] > 0},
    )


@pytest.mark.parametrize("width", [3, 1 << 14])
def test_overlap_family(spark, width):
    a, b = random_rows(4), random_rows(5, 18, chroms=("chr1",))
    da, db = frame(spark, a), frame(spark, b)
    cols = ("start_pos", "end_pos", "name", "start_pos_b", "end_pos_b", "name_b", "bp")
    key = lambda x, y: (x[1], x[2], x[3], y[1], y[2], y[3], ovl(x, y))
    expected = sorted(key(x, y) for x in a for y in b if ovl(x, y) > 0)
    assert sorted(got(overlap.overlap_join(da, db, width=width), *cols)) == expected
    left = sorted(got(overlap.overlap_join(da, db, "left", width=width), "name", "bp"))
    lone = [(x[3], 0) for x in a if not any(ovl(x, y) for y in b)]
    assert left == sorted([(x[3], ovl(x, y)) for x in a for y in b if ovl(x, y)] + lone)
    half = [(x, y) for x in a for y in b if ovl(x, y) >= 0.5 * (x[2] - x[1]) and ovl(x, y) >= 0.5 * (y[2] - y[1])]
    assert sorted(got(overlap.overlap_join(da, db, min_frac=0.5, reciprocal=True, width=width), *cols)) == sorted(key(x, y) for x, y in half)


@pytest.mark.parametrize("block", BLOCKS)
def test_coverage_family(spark, block):
    a, b, c = random_rows(6), random_rows(7, 10, chroms=("chr1",)), random_rows(8, 4, chroms=("chr2",))
    da, db, dc = frame(spark, a), frame(spark, b), frame(spark, c)
    hit = lambda x, *sets: any(ovl(x, y) for s in sets for y in s)
    assert sorted(got(overlap.overlap_semi(da, db, block=block), "name")) == sorted((x[3],) for x in a if hit(x, b))
    assert sorted(got(overlap.overlap_anti(da, db, dc, block=block), "name")) == sorted((x[3],) for x in a if not hit(x, b, c))
    expected = sorted(
        (x[3], sum(ovl(x, y) > 0 for y in b), int((depth(b, x[0])[x[1]:x[2]] > 0).sum()), x[2] - x[1]) for x in a
    )
    assert sorted(got(overlap.coverage(da, db, block=block), "name", "num_overlaps", "covered_bp", "length")) == expected
    track = sweep.depth_runs(db, block=block)
    expected = sorted((x[3], int(depth(b, x[0])[x[1]:x[2]].sum()), int((depth(b, x[0])[x[1]:x[2]] > 0).sum())) for x in a)
    assert sorted(got(overlap.region_average(da, track, block=block), "name", "total", "covered")) == expected
    near = {r[0]: r[1] for r in got(overlap.nearest(da, db, block=block), "name", "distance")}
    for x in a:
        same = [max(0, y[1] - x[2], x[1] - y[2]) for y in b if y[0] == x[0]]
        assert near[x[3]] == (min(same) if same else None)


def test_jaccard_and_empty(spark):
    a = random_rows(9, 30)
    out = {(r[0], r[1]): r[2:] for r in got(overlap.interval_jaccard(frame(spark, a), "grp"), "set_a", "set_b", "intersection", "union_bp")}
    for x, y in [("s0", "s1"), ("s1", "s3")]:
        m = {g: [depth([r for r in a if r[5] == g], c) > 0 for c in SIZE] for g in (x, y)}
        assert out[(x, y)] == (sum(int((p & q).sum()) for p, q in zip(m[x], m[y])), sum(int((p | q).sum()) for p, q in zip(m[x], m[y])))
    empty = frame(spark, [])
    assert got(sweep.merge_intervals(empty)) == []
    assert len(got(overlap.overlap_anti(frame(spark, a), empty))) == len(a)
    assert got(sweep.complement(empty, sizes(spark))) == []
    assert sorted(got(sweep.make_windows(sizes(spark), 100))) == [("chr1", 0, 100), ("chr1", 100, 200), ("chr2", 0, 100), ("chr2", 100, 130)]


def test_rows_do_not_go_through_the_driver(spark):
    """Only the small carries between blocks and lists that rows are crossed with may be broadcast."""
    a = spark.range(10).selectExpr("'c' as chrom", "id * 10 as start_pos", "id * 10 + 5 as end_pos", "id as name")
    plan = overlap.coverage_counts(a, a)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") <= 1 and plan.count("SortMergeJoin") >= 2
    every = assemblies.with_each(a, a.select("name"))._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in every and "BuildLeft" not in every


def test_clusters_do_not_go_through_the_driver(spark, monkeypatch):
    a = spark.range(10).selectExpr("'c' as chrom", "id * 10 as start_pos", "id * 10 + 15 as end_pos", "cast(id as string) as name")
    plan = scaffolds.cluster_edges(a)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    written = []
    monkeypatch.setattr(graph, "written_once", lambda df: written.append(df) or lineage.written_once(df))
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 6)], "src long, dst long")
    assert sorted(map(tuple, graph.connected_components(edges).collect())) == [(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)]
    assert not any("BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString() for df in written)

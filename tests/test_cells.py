"""Sweeps over packed rows: the same as base by base, no row of regions shuffled as it is, equal vectors stored once."""

import random

import pytest
from pyspark.sql import functions as F

from locusframe.operators import clusters, enrichment, lineage, overlap, sweep

BY = ["sample", "chrom"]


def aln(n=120, seed=3):
    r = random.Random(seed)
    return [(r.choice(["S1", "S2", None]), r.choice(["chr1", "chr2"]), s, s + r.randrange(1, 90), r.randrange(0, 4)) for s in (r.randrange(0, 400) for _ in range(n))]


def depth(rows, sample, chrom, at):
    return sum(w for s, c, a, b, w in rows if (s, c) == (sample, chrom) and a <= at < b)


@pytest.mark.parametrize("block", [16, 1 << 18])
def test_runs_and_averages_base_by_base(spark, block):
    rows = aln()
    df = spark.createDataFrame(rows, "sample string, chrom string, start_pos long, end_pos long, w int").repartition(3)
    track = sweep.depth_runs(df, by=BY, weight="w", block=block)
    found = {}
    for r in track.collect():
        for p in range(r["start_pos"], r["end_pos"]):
            assert (r["sample"], r["chrom"], p) not in found
            found[r["sample"], r["chrom"], p] = r["depth"]
        assert depth(rows, r["sample"], r["chrom"], r["end_pos"]) != r["depth"] != depth(rows, r["sample"], r["chrom"], r["start_pos"] - 1)
    wanted = {(s, c, p): d for s in ("S1", "S2") for c in ("chr1", "chr2") for p in range(600) if (d := depth(rows, s, c, p))}
    assert found == wanted
    spots = [(s, c, a, a + n, f"{a}_{n}") for s in ("S1", "S2", "S3", None) for c in ("chr1", "chr2", "chr3") for a, n in ((0, 5), (100, 3), (101, 250), (101, 250), (480, 40), (900, 7))]
    regions = spark.createDataFrame([*spots, ("S1", "chr1", 5, None, "open")], "sample string, chrom string, start_pos long, end_pos int, name string").repartition(2)
    got = sorted((str(r["sample"]), r["chrom"], r["name"], r["covered"] or 0, r["total"] or 0) for r in overlap.region_average(regions, track, by=BY, block=block).collect())
    on = lambda s, c, a, b: [found.get((s, c, p), 0) if s else 0 for p in range(a, b)]
    assert got == sorted([(str(s), c, n, sum(d > 0 for d in on(s, c, a, b)), sum(on(s, c, a, b))) for s, c, a, b, n in spots] + [("S1", "chr1", "open", 0, 0)])


def test_rows_travel_packed(spark):
    df = spark.createDataFrame(aln(), "sample string, chrom string, start_pos long, end_pos long, w int")
    out = overlap.region_average(df.withColumn("name", F.lit("x")), sweep.depth_runs(df, by=BY), by=BY)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [bucket" in plan and "Join" not in plan


def test_equal_vectors_are_stored_once(spark, monkeypatch):
    sizes = []

    def stored(df):
        out = lineage.written_once(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(clusters, "written_once", stored)
    df = spark.createDataFrame([(float(i % 4), float(i % 2) * 9) for i in range(400)], "x double, y double")
    best = clusters.k_means_starts(df, ["x", "y"], 2, starts=5)[0]
    assert sizes == [4] and best["cost"] == pytest.approx(400.0)


def test_coverages_without_regions_stay(spark):
    """A full join with the coverages, none of it by sample and technology alone."""
    depth = spark.createDataFrame([("S1", "A", "r1", h, 2.0, 0.5) for h in ("h1", "h2", "un")], "sample string, tech string, region_id string, hap string, coverage_mean double, coverage_pct double")
    dups = spark.createDataFrame([("r1", 0.1, 0.2), ("r2", 0.3, 0.4)], "region_id string, avg_sd_pct_id double, avg_sd_pct_ovl double")
    cov = spark.createDataFrame([("S1", "A", 4.0), ("S2", "A", 8.0), (None, "A", 1.0)], "sample string, tech string, input_cov double")
    out = enrichment.loh_features(depth, dups, cov)
    rows = sorted((str(r["sample"]), str(r["region_id"]), r["input_cov"], r["feat_h1_cov"], r["avg_sd_pct_id"]) for r in out.collect())
    assert rows == [("None", "None", 1.0, None, None), ("None", "r2", None, None, 0.3), ("S1", "r1", 4.0, 0.5, 0.1), ("S2", "None", 8.0, None, None)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("FullOuter") == 1

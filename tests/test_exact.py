"""Exact fractions, NULL groups, plans without keyless joins, and the shared folder."""

import os
import sys
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from locusframe.operators import assemblies, distribution, lineage, overlap, reads, sweep, variants  # noqa: E402, variants
from locusframe.plans import QUERIES  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def track(spark, rows):
    return spark.createDataFrame(rows, "chrom string, start_pos long, end_pos long, depth double")


def test_region_average_of_fractional_depth(spark):
    regions = spark.createDataFrame([("c", 0, 100, "r"), ("c", 100, 103, "thirds")], "chrom string, start_pos long, end_pos long, name string")
    depth = track(spark, [("c", 0, 50, 0.9), ("c", 50, 100, 2.7), ("c", 100, 103, 1 / 3)])
    got = {r["name"]: r for r in overlap.region_average(regions, depth).collect()}
    assert (got["r"]["total"], got["r"]["mean0"], got["r"]["mean"]) == (180.0, 1.8, 1.8)
    assert got["thirds"]["total"] == pytest.approx(1, abs=1e-5)


def test_merged_tracks_leave_no_residue(spark):
    parts = [track(spark, [("c", 0, 10, d)]) for d in (0.1, 0.2, 0.3)] + [track(spark, [("c", 5, 20, 0.5)])]
    got = sorted((r["start_pos"], r["end_pos"], r["depth"]) for r in sweep.merge_tracks(*parts).collect())
    assert got == [(0, 5, 0.6), (5, 10, 1.1), (10, 20, 0.5)]


def test_depth_per_base_of_fractional_tracks(spark):
    rows = [("c", i * 3 % 40, i * 3 % 40 + 1 + i % 7, round(0.1 * (i % 9 + 1), 1)) for i in range(60)]
    want = [0] * 60
    for _, a, b, d in rows:
        for p in range(a, b):
            want[p] += round(d * 10)
    got = [0] * 60
    for r in sweep.merge_tracks(track(spark, rows)).collect():
        for p in range(r["start_pos"], r["end_pos"]):
            got[p] = round(r["depth"] * 10)
    assert got == want


def test_null_groups_stay(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5), (None, 7), (None, 9)], "g string, v long")
    assert {r["g"]: (r["count"], r["q50"]) for r in distribution.describe_by(df, ["g"], "v").collect()} == {"a": (2, 2.0), None: (3, 7.0)}
    assert {r["g"]: r["n50"] for r in distribution.n50(df, ["g"], "v").collect()} == {"a": 3, None: 7}
    assert {(r["g"], r["v"]): round(r["pct_rank"], 3) for r in distribution.pct_rank_desc(df, ["g"], "v").collect()}[None, 5] == 1.0
    assert {r["g"] for r in distribution.running_total(df, ["g"], "v").collect()} == {"a", None}


def test_quantiles_of_fractions_use_many_blocks(spark):
    df = spark.range(200_000).select((F.rand(1) / 7).alias("v"))
    want = df.agg(F.percentile("v", 0.25).alias("q"), F.percentile("v", 0.5).alias("m")).first()
    got = distribution.quantiles(df, [], "v", {"q": 0.25, "m": 0.5}).first()
    assert (got["q"], got["m"]) == (pytest.approx(want["q"], abs=1e-15), pytest.approx(want["m"], abs=1e-15))


def test_genomic_sort_orders_rows(spark):
    rows = [("chrX", 5, 9), ("chr10", 1, 2), ("chr2", 7, 8), ("chr2", 3, 9), ("chr2", 3, 4)]
    df = spark.createDataFrame(rows, "chrom string, start_pos long, end_pos long").repartition(3)
    assert [tuple(r) for r in assemblies.genomic_sort(df).collect()] == sorted(rows)
    assert [r["chrom"] for r in assemblies.genomic_sort(df, numeric=True).collect()] == ["chr2", "chr2", "chr2", "chr10", "chrX"]


def test_pairs_of_rows(spark):
    df = spark.createDataFrame([(f"k{i:02}", i) for i in range(30)], "key string, v long")
    got = sorted((r["key_a"], r["key_b"], r["v_a"], r["v_b"]) for r in overlap.pair_combinations(df, "key", ["v"]).collect())
    assert got == sorted((f"k{i:02}", f"k{j:02}", i, j) for i in range(30) for j in range(i + 1, 30))


def test_pairs_of_rows_are_spread_over_the_cells(spark):
    """as many tasks as cells, none with much more than its share."""
    df = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    pairs = overlap.pair_combinations(df, "key", ["id"], parts=8)
    tasks = [r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert len(tasks) == 8 * 9 // 2 and sum(tasks) == 2000 * 1999 // 2
    assert max(tasks) < 2.5 * sum(tasks) / len(tasks)


@pytest.mark.parametrize("parts", [1, 2, 8, None])
@pytest.mark.parametrize("known", [False, True])
def test_pairs_of_repeated_and_missing_keys(spark, parts, known):
    nan = float("nan")
    keys = [3.0, None, 1.0, 3.0, nan, -0.0, 0.0, nan, None, 1.0, 3.0, -2.5]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key double, v long")
    few = df.where("v < 3") if known else None
    got = sorted((r["v_a"], r["v_b"]) for r in overlap.pair_combinations(df, "key", ["v"], parts, few).collect())
    rank = lambda k: (k != k, 0.0 if k != k else k)
    assert got == sorted((i, j) for i, a in enumerate(keys) for j, b in enumerate(keys) if None not in (a, b) and rank(a) < rank(b))
    assert overlap.pair_combinations(df.where("v < 0"), "key", ["v"], parts).count() == 0


@pytest.mark.parametrize("entries", [0, 1, 3, 50])
def test_every_row_meets_a_list_of_any_length(spark, monkeypatch, entries):
    monkeypatch.setattr(assemblies, "CHUNK", 3)
    few = spark.range(entries).select(F.expr("case when id > 0 then id end").alias("x"), F.lit("y").alias("y"))
    got = assemblies.with_each(spark.range(2), few.unionByName(few)).collect()
    want = [(i, x or None, "y") for i in range(2) for x in range(entries)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_one_outlier_leaves_fractions_in_many_blocks(spark):
    values = [i * 0.25 for i in range(20_000)] + [1e12, -1e12]
    df = spark.createDataFrame([("a", v) for v in values], "g string, x double")
    hist = distribution._in_blocks(distribution.histogram(df, ["g"], "x"), "value", 1)
    sizes = [r["count"] for r in hist.groupBy("_part").count().collect()]
    assert len(sizes) >= 60 and max(sizes) < 4 * len(values) / len(sizes)
    out = distribution.describe_by(df, ["g"], "x").first()
    assert (out["q25"], out["q50"], out["q75"], out["max"]) == tuple(float(v) for v in (*np.percentile(values, [25, 50, 75]), 1e12))
    ranks = {r["x"]: r["pct_rank"] for r in distribution.pct_rank_desc(df, ["g"], "x").collect()}
    assert ranks[1e12] == 1 / len(values) and ranks[0.0] == (len(values) - 1) / len(values) and ranks[-1e12] == 1


def test_fractions_plan_without_running(spark):
    df = spark.createDataFrame([("a", 0.5)], "g string, x double")
    df = df.withColumn("x", F.when(F.col("x") < 1, F.raise_error(F.lit("ran"))).otherwise(F.col("x")))
    distribution.describe_by(df, ["g"], "x")
    distribution.pct_rank_desc(df, ["g"], "x")


def test_digits_of_a_fractional_depth(spark):
    regions = spark.createDataFrame([("c", 0, 10, "r")], "chrom string, start_pos long, end_pos long, name string")
    depth = track(spark, [("c", 0, 10, 0.00000012)])
    total = lambda digits: overlap.region_average(regions, depth, digits=digits).first()["total"]
    assert total(6) == 0 and total(9) == pytest.approx(1.2e-6, rel=1e-9)
    assert [r["depth"] for r in sweep.merge_tracks(depth, depth, digits=9).collect()] == [2.4e-7]


def test_steps_and_limits_that_can_be_left_out(spark):
    hist = spark.createDataFrame([(700, 2), (250_000, 1)], "length long, n long")
    keys = [r["key"] for r in reads.read_summary(hist, 1000, long_from=None).collect()]
    assert {f"cov_geq_{s}" for s in (*reads.LONG_READ_STEPS, *reads.SHORT_READ_STEPS)} <= set(keys) and len(keys) == len(set(keys))
    capped = {r["min_length"]: r["bp"] for r in reads.bases_at_least(hist).collect()}
    whole = {r["min_length"]: r["bp"] for r in reads.bases_at_least(hist, last=None).collect()}
    assert max(capped) == 100_000 and max(whole) == 250_000 and whole[200_000] == 250_000 and whole[0] == 251_400
    limit = lambda n: spark.range(1).select(reads.caller_depth_limit(F.lit(500.0), F.lit(1.0), limit=n).alias("d")).first()["d"]
    assert (limit(200), limit(None)) == (200, 503)


KEYLESS = ["region_set_enrichment", "roi_hit_classes", "alt_contig_coverage", "region_set_coverage", "pseudo_read_density", "sv_support_summary", "loh_features", "region_length_remainders", "match_seq_names", "gff_to_regions", "read_sizes", "pair_combinations", "pairwise_class", "interval_jaccard"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", KEYLESS)
def test_no_keyless_join(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_a_cluster_needs_a_shared_folder():
    def session(master, folder=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: folder), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        lineage.scratch_path(session("spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        lineage.scratch_path(session("local-cluster[2,1,1024]"))
    assert lineage.scratch_path(session("yarn", "hdfs:///shared/")).startswith("hdfs:///shared/")
    assert os.path.isdir(os.path.dirname(lineage.scratch_path(session("local[2]"))))


def test_running_sums_in_order_split_a_large_group(spark):
    rows = [("a", i * 7919 % 5000, i % 5) for i in range(5000)] + [(None, 3, 4), ("b", 1, 2), (None, 1, 1)]
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = distribution.running_in_order(spark.createDataFrame(rows, "g string, k long, m long").repartition(4), ["g"], ["k"], "m", "upto").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    total, want = {}, {}
    for g, k, m in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        total[g] = total.get(g, 0) + m
        want[g, k] = total[g]
    assert {(r["g"], r["k"]): r["upto"] for r in out} == want


def test_regression_rows(spark):
    from locusframe.operators.enrichment import regression_rows

    df = spark.createDataFrame([(1000, 0.0, None), (999, 0.0, 0.0), (2000, 1.0, 0.0), (2000, 0.0, 0.5)], "length long, n double, sd double")
    assert [r["length"] for r in regression_rows(df, "length", "n", "sd").collect()] == [1000]


def test_rows_without_a_chromosome_stay(spark):
    a = spark.createDataFrame([("c", 0, 5, "x"), (None, 0, 5, "y"), ("c", 50, 60, "z")], "chrom string, start_pos long, end_pos long, name string")
    b = spark.createDataFrame([("c", 3, 9), (None, 0, 5)], "chrom string, start_pos long, end_pos long")
    assert {r["name"]: r["num_overlaps"] for r in overlap.coverage_counts(a, b).collect()} == {"x": 1, "y": 0, "z": 0}
    assert sorted(r["name"] for r in overlap.overlap_anti(a, b).collect()) == ["y", "z"]
    assert {r["name"]: (r["num_overlaps"], r["covered_bp"]) for r in overlap.coverage(a, b).collect()} == {"x": (1, 2), "y": (0, 0), "z": (0, 0)}


def test_bed_files_are_sorted(spark, tmp_path):
    from locusframe.sources import writers

    rows = [("chr2", 5, 9), ("chr1", 7, 8), ("chr1", 3, 9), ("chr1", 3, 4)]
    writers.write_bed(spark.createDataFrame(rows, "chrom string, start_pos long, end_pos long").repartition(3), str(tmp_path / "x"))
    lines = [x.split("\t") for f in sorted((tmp_path / "x").glob("part-*")) for x in f.read_text().split("\n") if x and not x.startswith("#")]
    assert [(c, int(a), int(b)) for c, a, b in lines] == sorted(rows)


def test_isec_tasks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(variants, "MEET", 4)
    side = lambda rows: spark.createDataFrame(rows, "chrom string, pos long")
    a, b = [("c", i) for i in range(30)] + [("c", 1), (None, 1)], [("c", i) for i in range(20, 50)] + [(None, 1)]
    parts = variants.isec(side(a), side(b), ["chrom", "pos"])
    assert all(p.rdd.getNumPartitions() == 16 for p in parts.values())
    got = {k: sorted(map(tuple, p.collect()), key=str) for k, p in parts.items()}
    hit = [("c", i) for i in range(20, 30)]
    assert got == {"only_a": sorted([x for x in a if x not in hit], key=str), "only_b": sorted([x for x in b if x not in hit], key=str), "shared_a": hit, "shared_b": hit}

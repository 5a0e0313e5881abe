"""Scaffolds, components, placement, enrichment, variants, masks and hot groups against plain Python."""

import itertools
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from locusframe.operators import assemblies, enrichment, graph, masks, overlap, scaffolds, sweep, variants
from locusframe.plans import QUERIES
from test_intervals import depth, frame, got, random_rows, runs, sizes, SIZE

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_masks_thresholds(spark):
    a = random_rows(11, 60)
    names = ["s0", "s1", "s2", "s3"]
    member = {c: sum((depth([r for r in a if r[5] == g], c) > 0).astype(int) for g in names) for c in SIZE}
    cases = {
        ("any", -1, "absolute", False): lambda m: m >= 1,
        ("all", -1, "absolute", False): lambda m: m == 4,
        ("geq", 0.6, "fraction", False): lambda m: m >= 2,
        ("lt", 0.6, "fraction", False): lambda m: (m > 0) & (m < 3),
        ("geq", 3, "absolute", True): lambda m: ~(m >= 3),
    }
    for (q, n, kind, inverse), test in cases.items():
        out = masks.consensus_regions(frame(spark, a), 4, q, n, kind, ["grp"], sizes(spark), inverse, block=16)
        assert set(got(out)) == set().union(*[runs(test(member[c]), c) for c in SIZE]), q
    with pytest.raises(ValueError):
        masks.assembly_threshold(4, "geq", 5)
    with pytest.raises(ValueError):
        masks.assembly_threshold(4, "geq", 0)


def test_all_needs_rows_of_every_assembly(spark):
    rows = [("chr1", 0, 50, "n", 1, "s0"), ("chr2", 0, 50, "n", 1, "s1")]
    assert got(masks.consensus_regions(frame(spark, rows), 2, "all", assembly=["grp"])) == []


def test_hot_position_keeps_every_row(spark):
    """A third of the rows are copies of one interval, and one bin holds nearly all rows."""
    rows = [("chr1", 5, 9, "hot", 1, "s0")] * 400 + random_rows(12, 300, chroms=("chr1",))
    df = frame(spark, rows)
    counted = overlap.coverage_counts(df, df)
    assert counted.count() == len(rows)
    assert counted.where("name = 'hot'").select("num_overlaps").distinct().collect()[0][0] == sum(r[1] < 9 and r[2] > 5 for r in rows)
    one = frame(spark, [("chr1", 6, 7, "q", 0, "x")])
    assert overlap.overlap_join(one, df).count() == sum(r[1] < 7 and r[2] > 6 for r in rows)
    assert max(r[3] for r in got(sweep.depth_runs(df), "chrom", "start_pos", "end_pos", "depth")) == depth(rows, "chr1").max()


def test_uniform_regions(spark):
    track = spark.createDataFrame([("chr1", 0, 100, 2), ("chr1", 150, 200, 4)], "chrom string, start_pos long, end_pos long, depth long")
    out = sorted(got(masks.uniform_regions(track, sizes(spark).where("chrom = 'chr1'"), 4)))
    assert out == [("chr1", 0, 50), ("chr1", 50, 150), ("chr1", 150, 175), ("chr1", 175, 200)]


def test_components_of_a_chain_and_a_star(spark):
    chain = [(f"a{i:03d}", f"a{i + 1:03d}") for i in range(40)]
    star = [("hub", f"z{i}") for i in range(60)]
    edges = spark.createDataFrame(chain + star, "src string, dst string")
    out = {r["node"]: r["component"] for r in graph.connected_components(edges).collect()}
    assert {out[f"a{i:03d}"] for i in range(41)} == {"a000"}
    assert {out[n] for n in ["hub", "z0", "z59"]} == {"hub"} and len(out) == 41 + 61


def expected_breaks(pieces, chrom):
    """The break classes of one contig, pair by pair."""
    inside = [(p, s) for p, s, x in pieces if x]
    outside = [p for p, s, x in pieces if not x]
    breaks = len(pieces) - 1 if inside else 0
    support = 1 if inside and outside else 0
    local = glob = chim = 0
    if breaks > 0 and breaks != support:
        names = [s for _, s in sorted(inside)]
        if len(names) == 1:
            local = 1
        else:
            local = len(names) - len(set(names))
            left, seen = breaks - support - local, set()
            for a, b in itertools.combinations(names, 2):
                if left == 0:
                    break
                if a == b or frozenset((a, b)) in seen:
                    continue
                seen.add(frozenset((a, b)))
                left -= 1
                if chrom[a] == chrom[b]:
                    glob += 1
                else:
                    chim += 1
    return breaks, local, glob, chim, support


def test_classify_breaks(spark):
    rnd = random.Random(5)
    chrom = {f"Super-Scaffold_{i}": f"chr{i % 3}" for i in range(8)}
    rows, expected = [], {}
    for c in range(60):
        pieces = []
        for i in range(rnd.randrange(1, 8)):
            inside = rnd.random() < 0.85
            pieces.append((i, rnd.choice(list(chrom)) if inside else f"ctg{c}_obj", inside))
        want = expected_breaks(pieces, chrom)
        if want[0] != sum(want[1:]):
            continue  # the classes cannot account for these breaks
        expected[f"ctg{c}"] = want
        rows += [(s, f"ctg{c}", "W", 10, i) for i, s, _ in pieces]
    agp = spark.createDataFrame(rows, "object string, comp_name string, comp_type string, comp_length long, ord long")
    pieces = scaffolds.sequence_pieces(agp)
    chroms = spark.createDataFrame(list(chrom.items()), "scaffold string, chrom string")
    out = scaffolds.classify_breaks(scaffolds.contig_support(pieces), pieces, chroms).collect()
    assert len(expected) > 30
    assert {r["contig"]: tuple(r[c] for c in ("contig_breaks", "local_breaks", "global_breaks", "chimeric_breaks", "support_breaks")) for r in out} == expected


def test_breaks_beyond_the_pairs(spark):
    """Four pieces outside scaffolds and two scaffolds: one pair for four breaks, an error unless told otherwise."""
    rows = [("Super-Scaffold_1", "c", "W", 10, 0), ("Super-Scaffold_2", "c", "W", 10, 1), *[("c_obj", "c", "W", 10, i) for i in range(2, 6)]]
    agp = spark.createDataFrame(rows, "object string, comp_name string, comp_type string, comp_length long, ord long")
    pieces = scaffolds.sequence_pieces(agp)
    chroms = spark.createDataFrame([("Super-Scaffold_1", "chr1"), ("Super-Scaffold_2", "chr1")], "scaffold string, chrom string")
    support = scaffolds.contig_support(pieces)
    out = scaffolds.classify_breaks(support, pieces, chroms, strict=False).first()
    assert tuple(out[c] for c in ("contig_breaks", "local_breaks", "global_breaks", "chimeric_breaks", "support_breaks")) == (5, 0, 1, 0, 1)
    with pytest.raises(Exception, match="unaccounted breaks"):
        scaffolds.classify_breaks(support, pieces, chroms).collect()


def test_first_pairs(spark):
    """Counts over the first pairs of scaffolds, against the pairs themselves, NULL chromosomes included."""
    rnd = random.Random(9)
    rows, expected = [], {}
    for c in range(40):
        m = rnd.randrange(2, 9)
        left = rnd.randrange(1, m * (m - 1) // 2 + 3)
        chroms = [rnd.choice(["chr1", "chr2", None]) for _ in range(m)]
        firsts = [rnd.randrange(4) for _ in range(m)]  # ties are ordered by the scaffold
        rows += [(f"c{c}", f"s{i}", firsts[i], chroms[i], left, m) for i in range(m)]
        listed = [chroms[i] for i in sorted(range(m), key=lambda i: (firsts[i], f"s{i}"))]
        pairs = [(a, b) for i, a in enumerate(listed) for b in listed[i + 1 :]][:left]
        expected[f"c{c}"] = (sum(a == b for a, b in pairs), sum(a != b for a, b in pairs))
    groups = spark.createDataFrame(rows, "contig string, scaffold string, first long, chrom string, _left long, _m long")
    assert {r["contig"]: (r["_g"], r["_c"]) for r in scaffolds._first_pairs(groups).collect()} == expected


def test_contig_size_check(spark):
    view = spark.createDataFrame([("a", 5, 1), ("b", 2, 2)], "contig string, supported long, unsupported long")
    scaffolds.assert_contig_sizes(view, spark.createDataFrame([("a", 6), ("b", 4)], "contig string, size long"))
    with pytest.raises(ValueError, match="differ"):
        scaffolds.assert_contig_sizes(view, spark.createDataFrame([("a", 6), ("c", 4)], "contig string, size long"))


def test_placement_orders_and_outlier(spark):
    layout, aln = [], []
    for name, order in (("fwd", [0, 1, 2]), ("rev", [2, 1, 0]), ("mix", [1, 0, 2])):
        for i in range(3):
            layout.append((name, f"{name}{i}", i + 1, i * 1000, 1000, 3000))
            aln.append((name, f"{name}{i}", i + 1, "chr1", 10_000 + order[i] * 1000, 11_000 + order[i] * 1000, 60, "+"))
    layout += [("far", f"far{i}", i + 1, i * 1000, 1000, 3000) for i in range(3)]
    aln += [("far", f"far{i}", i + 1, "chr1", 10_000 + i * 1000 + (900_000 if i == 2 else 0), 11_000 + i * 1000 + (900_000 if i == 2 else 0), 60, "-") for i in range(3)]
    layout += [("two", "two0", 1, 0, 500, 500)]
    aln += [("two", "two0", 1, "chr1", 0, 250, 60, "+"), ("two", "two0", 1, "chr2", 0, 250, 60, "+")]
    la = spark.createDataFrame(layout, "scaffold string, contig string, order int, start_pos long, length long, scaffold_length long")
    al = spark.createDataFrame(aln, "scaffold string, contig string, order_number int, chrom string, start_pos long, end_pos long, mapq int, strand string")
    out = {(r["scaffold"], r["contig"]): r for r in scaffolds.scaffold_placement(al, la).collect()}
    state = lambda s, c: (out[(s, c)]["loc_confidence"], out[(s, c)]["scaffold_strand"])
    assert state("fwd", "fwd0") == ("high", "+") and state("rev", "rev1") == ("high", "-") and state("mix", "mix2") == ("medium", "+")
    assert state("far", "far0") == ("medium", "-") and state("far", "far2") == ("low", ".")
    assert state("two", "two0") == ("low", ".")
    assert (out[("fwd", "fwd0")]["scaffold_start"], out[("fwd", "fwd0")]["scaffold_end"]) == (10_000, 13_000)


def test_placement_of_long_scaffolds(spark):
    """Scaffolds of 20,000 blocks, in order, reversed and with two blocks swapped; none is one task's list."""
    n = 20_000
    base = spark.range(n).select(F.lit("x").alias("scaffold"), F.concat(F.lit("c"), "id").alias("contig"), (F.col("id") + 1).cast("int").alias("order"), (F.col("id") * 10).alias("start_pos"), F.lit(10).cast("long").alias("length"), F.lit(n * 10).cast("long").alias("scaffold_length"))
    layout = base.drop("scaffold").crossJoin(spark.createDataFrame([("fwd",), ("rev",), ("swap",)], "scaffold string"))
    at = F.when(F.col("scaffold") == "rev", n - F.col("order")).when(F.col("scaffold") != "swap", F.col("order") - 1)
    at = F.coalesce(at, F.when(F.col("order") == 7000, 7000).when(F.col("order") == 7001, 6999).otherwise(F.col("order") - 1)).cast("long")
    aln = layout.select("scaffold", "contig", F.col("order").alias("order_number"), F.lit("chr1").alias("chrom"), (at * 10 + 1_000_000).alias("start_pos"), (at * 10 + 1_000_010).alias("end_pos"), F.lit(60).alias("mapq"), F.lit("+").alias("strand"))
    placed = scaffolds.scaffold_placement(aln, layout)
    assert "collect_list" not in placed._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["scaffold"], r["loc_confidence"], r["scaffold_strand"]): r["count"] for r in placed.groupBy("scaffold", "loc_confidence", "scaffold_strand").count().collect()}
    assert got == {("fwd", "high", "+"): n, ("rev", "high", "-"): n, ("swap", "medium", "+"): n}


def test_placement_by_one_shuffle(spark, monkeypatch):
    """Scaffolds placed by windows and those dealt into ranges get the same verdicts; nothing is written for the former."""
    rnd = random.Random(11)
    layout, aln = [], []
    for k in range(60):
        name, n = f"s{k}", rnd.randrange(1, 9)
        for i in range(n):
            layout.append((name, f"{name}_{i}", i + 1, i * 150, 100, n * 150))
        order = list(range(n)) if k % 3 else list(range(n))[::-1]
        if k % 5 == 0:
            rnd.shuffle(order)
        for i in range(n):
            if rnd.random() < 0.9:
                spot = 1000 * k + order[i] * 150 + (rnd.choice([90_000, 200_000, 7_000_000]) + i if rnd.random() < 0.15 else 0)
                aln.append((name, f"{name}_{0 if k % 7 == 0 else i}", i + 1 + (k % 11 == 0), f"chr{1 + (k % 13 == 0) * (i % 2)}", spot, spot + rnd.randrange(3, 100), rnd.randrange(1, 60), rnd.choice("+-")))
    layout += layout[5:8]
    aln += aln[20:26] + [("none", "none0", 1, "chr1", 5, 9, 3, "+"), (None, "x", 1, "chr1", 5, 9, 3, "+")]
    la = spark.createDataFrame(layout, "scaffold string, contig string, order int, start_pos long, length long, scaffold_length long")
    al = spark.createDataFrame(aln, "scaffold string, contig string, order_number int, chrom string, start_pos long, end_pos long, mapq int, strand string")
    written, once = [], scaffolds.written_once
    monkeypatch.setattr(scaffolds, "written_once", lambda df: written.append(df.columns) or once(df))
    got = {}
    for most in (10_000, 9, 0):
        monkeypatch.setattr(scaffolds, "LISTED", most)
        got[most] = sorted(map(str, scaffolds.scaffold_placement(al, la).collect()))
        if most == 10_000:
            assert not written
    assert len(got[0]) == len(aln) and got[0] == got[9] == got[10_000]
    assert {c for c in ("high", "medium", "low") if any(f"'{c}'" in row for row in got[0])} == {"high", "medium", "low"}


def test_farthest_block(spark):
    """The distance of each block to all others, by brute force, decides which block a moved midpoint leaves out."""
    rnd = random.Random(3)
    layout, aln, expected = [], [], {}
    for k in range(12):
        name = f"s{k}"
        for i in range(4):
            layout.append((name, f"{name}_{i}", i + 1, i * 100, 100, 400))
        spots = [1000 + i * 100 for i in range(3)] + [rnd.choice([100_000, 200_000])]
        aln += [(name, f"{name}_{i}", i + 1, "chr1", p, p + 100, 60, "+") for i, p in enumerate(spots)]
        far = [sum(abs(a - b) for b in spots) for a in spots]
        for i in range(4):
            expected[f"{name}_{i}"] = "low" if far[i] == max(far) else "medium"
    la = spark.createDataFrame(layout, "scaffold string, contig string, order int, start_pos long, length long, scaffold_length long")
    al = spark.createDataFrame(aln, "scaffold string, contig string, order_number int, chrom string, start_pos long, end_pos long, mapq int, strand string")
    assert {r["contig"]: r["loc_confidence"] for r in scaffolds.scaffold_placement(al, la).collect()} == expected


def test_enrichment_p_value(spark):
    total, row, col = 30, 12, 9
    pmf = lambda x: math.comb(row, x) * math.comb(total - row, col - x) / math.comb(total, col)
    table = spark.createDataFrame([(str(a), a, row - a, col - a, total - row - col + a) for a in range(0, 10)], "region_set string, support long, b long, c long, d long")
    got = {r["region_set"]: r["p_value"] for r in enrichment.with_tail_probability(table, "region_set").collect()}
    for a in range(0, 10):
        assert got[str(a)] == pytest.approx(sum(pmf(x) for x in range(a, 10)), rel=1e-11)


def test_log_gamma(spark):
    x = [0.5, 1.0, 2.0, 3.5, 10.0, 1e3, 1e7, 1e12]
    got = spark.createDataFrame([(v,) for v in x], "x double").select("x", enrichment.log_gamma(F.col("x")).alias("g")).collect()
    for r in got:
        assert r["g"] == pytest.approx(math.lgamma(r["x"]), rel=1e-13, abs=1e-12)


def test_test_p_values(spark):
    # tail areas from printed tables of the t and chi-square distributions
    rows = [(2.228139, 10.0, 0.05), (2.0, 10.0, 0.0733880), (12.706205, 1.0, 0.05), (0.5, 30.5, 0.6206), (-2.0, 10.0, 0.0733880)]
    df = spark.createDataFrame(rows, "t double, df double, p double")
    for r in df.select("p", enrichment.student_p(F.col("t"), F.col("df")).alias("got")).collect():
        assert r["got"] == pytest.approx(r["p"], abs=2e-4)
    chi = spark.createDataFrame([(v,) for v in (0.0, 0.1, 1.0, 3.841459, 60.0)], "x double").select("x", enrichment.chi_square_p(F.col("x")).alias("p")).collect()
    for r in chi:
        assert r["p"] == pytest.approx(math.erfc(math.sqrt(r["x"] / 2)), rel=1e-9)
    row = spark.createDataFrame([(2.0, 10.0, 3.841459)], "welch_t double, welch_df double, bartlett double")
    out = enrichment.with_test_p_values(row).first()
    assert out["welch_p"] == pytest.approx(0.07338803, abs=1e-6) and out["bartlett_p"] == pytest.approx(0.05, abs=1e-6)


def test_clean_enrichment(spark):
    table = spark.createDataFrame([("x", 5, 0, 0, 5, float("inf"), 1e-5), ("y", 1, 2, 3, 4, 0.7, 1e-9), ("z", 1, 2, 3, 4, 3.0, 0.5)], "region_set string, support long, b long, c long, d long, odds_ratio double, q_value double")
    assert [(r[0], r[1]) for r in enrichment.clean_enrichment(table, {"x": "X sets"}).collect()] == [("X sets", 1000.0)]


def test_concordance_without_parents(spark):
    df = spark.createDataFrame([("0/0", "0|0", "0/1"), ("0/1", "1/0", "1|0"), ("0/0", "0/1", "1/1")], "a string, b string, c string")
    out = {(r["metric"], r["sample"]): r["n"] for r in variants.concordance(df, ["a", "b", "c"]).collect()}
    assert out[("all_concordant", "*")] == 1 and out[("fully_discordant", "*")] == 1
    assert out[("minority", "a")] == 0 and out[("minority", "c")] == 1
    assert not any(k[0].startswith("mendel") for k in out)


def test_trio_classes_without_length(spark):
    df = spark.createDataFrame([("0/1", "0/0", "1/1", 5, "r", "snp"), ("0/1", "0/0", "0/0", 7, "r", "snp"), ("./.", "0/0", "1/1", 2, "r", "snp"), ("0/1", "0/0", "0/0", None, "r", "snp")], "child string, mother string, father string, vlen long, region_type string, vtype string")
    out = {r["call_class"]: r["bp"] for r in variants.trio_classes(df).where("vtype = 'any' and region_type = 'any'").collect()}
    assert out == {"OK": 5, "ERROR": 7, "AMBIG": 2, "SKIP": 0}


def test_sample_lookup_errors(spark):
    samples = spark.createDataFrame([("S1", "F"), ("S2", "M"), ("S2", "F")], "sample string, sex string")
    rows = lambda name: spark.createDataFrame([(name,)], "sample string")
    assert assemblies.with_sample(rows("S1"), samples).collect()[0]["sex"] == "F"
    for name in ("S2", "S9"):
        with pytest.raises(Exception, match="exactly one"):
            assemblies.with_sample(rows(name), samples).collect()


def test_break_regions_two_assemblies(spark):
    aln = [("chr1", 0, 100, "n", 1, "s0"), ("chr1", 120, 200, "n", 1, "s0"), ("chr1", 0, 90, "n", 1, "s1"), ("chr1", 110, 200, "n", 1, "s1")]
    out = assemblies.break_regions(frame(spark, aln), sizes(spark), 10, ["grp"])
    # gaps 100-120 and 90-110; windows hit by one assembly only are stable
    assert got(out, "chrom", "start_pos", "end_pos", "name") == [("chr1", 100, 110, "chr1-100-10-H64")]


def test_roi_blocks_touching_and_nested(spark):
    roi = frame(spark, [("chr1", 10, 50, "roi", 0, "x")])
    aln = spark.createDataFrame([("chr1", 0, 20, "c1", "a"), ("chr1", 20, 30, "c2", "a"), ("chr1", 25, 28, "c3", "a"), ("chr1", 22, 27, "c3", "a")], "chrom string, start_pos long, end_pos long, contig string, sample string")
    out = sorted(got(assemblies.roi_blocks(roi, aln, ["sample"]), "block_start", "block_length", "block_type"))
    assert out == [(10, 12, "align"), (22, 6, "multi"), (28, 2, "align"), (30, 20, "gap")]
    stats = assemblies.roi_stats(roi, aln, ["sample"]).first()
    assert (stats["coverage_bp"], stats["delta"], stats["num_gaps"], stats["contigs_count"], stats["coverage_pct"]) == (20, 20, 1, 3, 50.0)




@pytest.mark.parametrize("operator", ["coverage_counts", "overlap_join", "map_mean"])
def test_copies_of_one_row_are_split_over_tasks(spark, operator):
    """With the size limits lowered, the join that meets a hot key is planned as a skew join."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in limits}
    rows = [("chr1", 5, 9, f"hot{i % 3}", 1, "s0") for i in range(20_000)] + random_rows(13, 2000)
    few = random_rows(14, 20)
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        df = frame(spark, rows).repartition(8)
        out = getattr(overlap, operator)(df, frame(spark, few))
        n = out.count() if operator == "overlap_join" else len(out.collect())
        out._jdf.queryExecution().toRdd().count()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert n == (sum(sum(x[0] == y[0] and x[1] < y[2] and y[1] < x[2] for y in few) for x in rows) if operator == "overlap_join" else len(rows))
    assert "skew=true" in plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_break_regression_is_fitted_with_the_operator_defaults(spark, monkeypatch):
    import inspect

    from locusframe.plans import scaffold_queries

    default, seen = enrichment.break_regression, {}

    def fit(*args, **kwargs):
        bound = inspect.signature(default).bind(*args, **kwargs)
        bound.apply_defaults()
        seen.update(bound.arguments)
        return spark.createDataFrame([(seen["features"][0], 1.0)], "feature string, importance double")

    monkeypatch.setattr(scaffold_queries.enr, "break_regression", fit)
    QUERIES["break_regression"](spark, SF).collect()
    assert (tuple(seen["depths"]), seen["iterations"], seen["folds"]) == ((2, 4), 25, 5)


def test_break_windows_count_assemblies_once_and_stay_off_the_driver(spark):
    """Gaps that overlap, lie in one window or come twice count once for an assembly; listed windows are never broadcast."""
    rnd = random.Random(4)
    gaps = [("chr1", a, a + rnd.randrange(1, 40), rnd.choice(["x", "y", None])) for a in (rnd.randrange(300) for _ in range(60))]
    gaps += gaps[:20]
    windows = [("chr1", a, a + n) for a, n in [*((i * 25, 25) for i in range(14)), (3, 200), (3, 200), (50, 1)]]
    listed = spark.sql("SELECT 'chr1' AS chrom").select("chrom", F.explode(F.array(*[F.struct(F.lit(a).cast("long").alias("start_pos"), F.lit(b).cast("long").alias("end_pos")) for _, a, b in windows])).alias("w")).select("chrom", "w.*")
    df = spark.createDataFrame(gaps, "chrom string, start_pos long, end_pos long, asm string")
    out = assemblies.break_windows(listed, df, ["asm"])
    want = sorted((c, a, b, len({x for _, s, e, x in gaps if s < b and a < e})) for c, a, b in windows)
    assert sorted(got(out, "chrom", "start_pos", "end_pos", "break_cov")) == want
    assert "Broadcast" not in out._jdf.queryExecution().sparkPlan().toString()

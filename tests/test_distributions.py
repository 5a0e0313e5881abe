"""Order statistics, reads, haplotags and k-mers on small data."""

import collections
import random

import numpy as np
import pytest

from locusframe.operators import distribution, kmers, reads


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("block", [3, 50, 1 << 18])
def test_quantiles_describe_rank(spark, block):
    rnd = random.Random(1)
    data = [(rnd.choice("ab"), rnd.choice([0, 1, 5, 7, 30, 200])) for _ in range(80)] + [("c", 4)]
    df = spark.createDataFrame(data, "g string, x long")
    out = {r["g"]: r for r in distribution.describe_by(df, ["g"], "x", block).collect()}
    ranks = {(r["g"], r["x"]): r["pct_rank"] for r in distribution.pct_rank_desc(df, ["g"], "x", block).collect()}
    for g in "abc":
        v = np.array([x for k, x in data if k == g])
        for name, q in (("q25", 25), ("q50", 50), ("q75", 75)):
            assert out[g][name] == pytest.approx(np.percentile(v, q))
        assert out[g]["std"] is None if len(v) == 1 else out[g]["std"] == pytest.approx(v.std(ddof=1))
        for x in set(v.tolist()):
            assert ranks[(g, x)] == pytest.approx((v >= x).mean())


def test_n50_definitions(spark):
    df = spark.createDataFrame([(10,), (5,), (5,), (3,), (2,)], "x long")
    assert rows_of(distribution.n50(df, [], "x")) == [(5,)]
    assert rows_of(distribution.n50(df, [], "x", "below_half")) == [(10,)]
    one = spark.createDataFrame([(10,), (1,)], "x long")
    assert rows_of(distribution.n50(one, [], "x")) == [(10,)]
    assert rows_of(distribution.n50(one, [], "x", "below_half")) == [(None,)]


def test_read_summary(spark):
    lengths = [100, 200, 200, 1500, 30]
    hist = spark.createDataFrame([(k, v) for k, v in collections.Counter(lengths).items()], "length long, n long")
    out = dict(rows_of(reads.read_summary(hist, 1000)))
    assert out["num_reads"] == 5 and out["total_seq_bp"] == 2030 and out["read_length_mean"] == 406
    assert out["cov_total"] == 2.03 and out["cov_geq_200"] == 1.9 and out["cov_geq_0"] == 2.03
    assert out["read_length_N50"] is None  # the longest read holds more than half
    assert "cov_geq_1000" not in out
    assert rows_of(reads.pick_min_length(reads.read_summary(hist, 1000), 1.9)) == [(125,)]
    assert reads.read_summary(hist.limit(0), 1000).count() == 0


def test_gc_bins_and_empty_read(spark):
    df = spark.createDataFrame([("a", "GC"), ("b", "AT"), ("c", "GGGA"), ("d", "")], "name string, seq string")
    out = {(k, key): n for k, key, n in rows_of(reads.read_statistics(df))}
    assert out[("gc_bin", "100")] == 1 and out[("gc_bin", "1")] == 1 and out[("gc_bin", "76")] == 1 and out[("gc_bin", "none")] == 1
    assert out[("reads", "all")] == 4 and out[("base", "G")] == 4


def test_haplotags(spark):
    tags = spark.createDataFrame(
        [("r1", "H1", 1, "c"), ("r2", "H2", 1, "c"), ("r3", "H1", 2, "c"), ("r4", "none", 0, "c"), ("r1", "none", 0, "c")],
        "name string, haplotype string, phaseset int, chrom string",
    )
    one = reads.haplotag_summary(tags).first()
    assert (one["num_hap1"], one["percent_hap1"], one["percent_tagged"]) == (2, 40.0, 60.0)
    assert rows_of(reads.label_overlaps(tags)) == [(0, 1, 0)]
    seqs = spark.createDataFrame([("r2", "AC"), ("r3", "A"), ("zz", "A")], "name string, seq string")
    split = {r["name"]: r["haplotype"] for r in reads.split_by_haplotag(seqs, tags).collect()}
    assert split == {"r2": "H2", "r3": "none"}
    bad = tags.limit(1).selectExpr("name", "'H3' haplotype", "phaseset", "chrom")
    with pytest.raises(Exception, match="unexpected haplotype"):
        reads.haplotag_summary(bad).collect()


def test_kmers_against_python(spark):
    rnd = random.Random(2)
    seqs = ["".join(rnd.choice("ACGTN") for _ in range(n)) for n in (0, 2, 5, 40, 300)]
    df = spark.createDataFrame([(s, i % 3) for i, s in enumerate(seqs)], "seq string, colour int")
    expected = collections.Counter(s[i:i + 4] for s in seqs for i in range(len(s) - 3))
    assert dict(rows_of(kmers.kmer_count(df, 4))) == expected
    flip = str.maketrans("ACGT", "TGCA")
    canon = collections.Counter(min(k, k.translate(flip)[::-1]) for k in expected.elements() if "N" not in k)
    assert dict(rows_of(kmers.kmer_count(df, 4, canonical_form=True, alphabet="ACGT"))) == canon
    masks = collections.defaultdict(set)
    for i, s in enumerate(seqs):
        for j in range(len(s) - 3):
            masks[s[j:j + 4]].add(i % 3)
    combos = collections.Counter("-".join(map(str, sorted(v))) for v in masks.values())
    assert dict(rows_of(kmers.kmer_colours(df, 4, 3))) == combos


def test_sequence_chunks_overlap(spark):
    df = spark.createDataFrame([("x", "abcdefghij")], "name string, seq string")
    out = sorted((r["chunk_no"], r["seq"]) for r in kmers.sequence_chunks(df, overlap=2, chunk=4).collect())
    assert out == [(0, "abcdef"), (1, "efghij"), (2, "ij")]


def test_fold_and_region_names(spark):
    counts = spark.createDataFrame([("0-2-3", 5), ("2-5", 7), ("0-1-2-4", 3), ("4", 2), ("1", 1)], "combination string, n long")
    assert dict(rows_of(kmers.fold_colours(counts))) == {"Hap_Illumina": 5, "GRCh38_shared": 3, "GRCh38": 2, "Illumina_only": 1}
    bad = spark.createDataFrame([("PROM:1", True, False)], "query string, GRCh38 boolean, chrM boolean")
    with pytest.raises(Exception, match="malformed region"):
        kmers.parse_query_regions(bad).collect()

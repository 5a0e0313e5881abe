"""Readers, writers and cleaning on tiny files."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from locusframe.operators import cleaning
from locusframe.sources import readers, writers


def put(path, text):
    path.write_text(text)
    return str(path)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_sizes(spark, tmp_path):
    path = put(tmp_path / "a.fai", "chr1\t200\t5\n#x\nchr2 130\n")
    sizes = readers.read_sizes(spark, path)
    assert rows_of(sizes) == [("chr1", 200), ("chr2", 130)] and rows_of(readers.total_length(sizes)) == [(330,)]
    with pytest.raises(Exception, match="malformed sequence length"):
        readers.read_sizes(spark, put(tmp_path / "b.fai", "chr1\tx\n")).collect()


def test_bed_and_table(spark, tmp_path):
    bed = put(tmp_path / "a.bed", "#chrom\tstart\nchr1\t0\t10\tc\t60\t+\nchr1\t10\t20\tc\t0\t.\n")
    assert rows_of(readers.read_bed(spark, bed))[1] == ("chr1", 10, 20, "c", 0, ".")
    with pytest.raises(Exception):
        readers.read_bed(spark, put(tmp_path / "b.bed", "chr1\tx\t10\tc\t60\t+\n")).collect()
    with gzip.open(tmp_path / "t.tsv.gz", "wt") as out:
        out.write('#name\tn\tnote\na\t007\t"q\n')
    assert rows_of(readers.read_table(spark, str(tmp_path / "t.tsv.gz"), ["name", "n"])) == [("a", "007")]


def test_fasta_round_trip(spark, tmp_path):
    path = put(tmp_path / "a.fa", ">s1 first > second\nACGT\nAC\n\n>s2\nGG\n>s3\n")
    out = {r["name"]: (r["header"], r["seq"]) for r in readers.read_fasta(spark, path).collect()}
    assert out == {"s1": ("s1 first > second", "ACGTAC"), "s2": ("s2", "GG"), "s3": ("s3", "")}
    df = spark.createDataFrame([("x", "A" * 240), ("y", "C" * 121), ("z", "")], "name string, seq string")
    writers.write_fasta(df, str(tmp_path / "out"), 120)
    back = {r["name"]: r["seq"] for r in readers.read_fasta(spark, str(tmp_path / "out")).collect()}
    assert back == {"x": "A" * 240, "y": "C" * 121, "z": ""}


def test_fastq_over_many_splits_and_files(spark, tmp_path):
    want = {}
    for f in range(2):
        text = ""
        for i in range(200):
            name, seq = f"r{f}_{i}", "ACGT"[: i % 4 + 1]
            want[name] = (seq, "@" * len(seq))
            text += f"@{name} extra\n{seq}\n+\n{'@' * len(seq)}\n"
        put(tmp_path / f"f{f}.fastq", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        out = {r["name"]: (r["seq"], r["qual"]) for r in readers.read_fastq(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert out == want


def test_vcf(spark, tmp_path):
    text = "##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\nchr1\t5\t.\tA\tT\t12.5\tPASS\tDP=3;DB\tGT:DP:GQ\t0/1:3\t1/1:4:9\nchr1\t6\t.\tA\tT\t.\tdn\t.\tGT\t./.\t0/0\n"
    path = put(tmp_path / "a.vcf", text)
    assert [r["samples"] for r in readers.vcf_samples(spark, path).collect()] == [["S1", "S2"]]
    one = readers.read_vcf(spark, path).orderBy("pos").collect()
    assert one[0]["info_map"] == {"DP": "3", "DB": "true"} and one[0]["call_map"] == {"GT": "0/1", "DP": "3"} and one[1]["qual"] is None
    assert readers.read_vcf(spark, path, "S2").orderBy("pos").first()["call_map"]["GQ"] == "9"
    with pytest.raises(ValueError):
        readers.read_vcf(spark, path, "S3")


def test_vcf_bed_and_lifted(spark, tmp_path):
    head = "chr1\t4\t5\tv\t30.0\tA\tT\tPASS\t"
    good = readers.read_vcf_bed(spark, put(tmp_path / "a.bed", head + "LEN=1;X=2\tGT:DP\t0/1:7\n"))
    assert rows_of(good) == [("chr1", 4, 5, 30.0, 7, 1, "A", "T")]
    for bad, why in (("X=2\tGT:DP\t0/1:7\n", "no variant length"), ("LEN=1;\tGT:AD\t0/1:7\n", "DP not second")):
        with pytest.raises(Exception, match=why):
            readers.read_vcf_bed(spark, put(tmp_path / f"{why[:2]}.bed", head + bad)).collect()
    lifted = put(tmp_path / "l.bed", "chr1\t4\t5\ta_b_10_20\t0\t+\nchr1\t6\t9\ta_b_30_40_t3\t0\t+\n")
    assert rows_of(readers.read_lifted_bed(spark, lifted)) == [("a_b", 10, 20, "chr1", 4, 5), ("a_b", 30, 40, "chr1", 6, 9)]


def test_sam_and_agp(spark, tmp_path):
    sam = put(tmp_path / "a.sam", "@HD\nr1\t16\tchr1\t11\t60\t5S10M2D3I4=1X2N6H\t*\t0\t0\tAC\tII\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n")
    out = {r["name"]: (r["chrom"], r["start_pos"], r["end_pos"], r["strand"]) for r in readers.read_sam(spark, sam).collect()}
    assert out == {"r1": ("chr1", 10, 29, "-"), "r2": (None, None, None, "+")}
    agp = "## x\nSuper-Scaffold_1\t1\t10\t1\tW\tc_subseq_1:10\t1\t10\t+\nSuper-Scaffold_1\t11\t15\t2\tN\t5\tscaffold\tyes\tmap\n"
    assert [r["comp_length"] for r in readers.read_agp(spark, put(tmp_path / "a.agp", agp)).collect()] == [10, None]
    with pytest.raises(Exception, match="unexpected layout"):
        readers.read_agp(spark, put(tmp_path / "b.agp", agp.replace("\tN\t", "\tU\t"))).collect()


def test_merge_fasta_errors(spark):
    df = lambda *names: spark.createDataFrame([(n, "A", "cluster1") for n in names], "name string, seq string, cluster string")
    assert sorted(r["name"] for r in readers.merge_fasta(df("a|arrow", "cluster1_b x")).collect()) == ["cluster1_a", "cluster1_b"]
    with pytest.raises(Exception, match="duplicate FASTA header"):
        readers.merge_fasta(df("a", "cluster1_a")).collect()
    with pytest.raises(Exception, match="malformed FASTA header"):
        readers.merge_fasta(df("a-b")).collect()


def test_file_names(spark):
    names = ["HG1_x_pbsq2-ccs_1000-pereg.h1-un.arrow-p1_map-to_ref.bed", "dir/HG2_x_pbsq2-clr_1000.h2.bed"]
    out = rows_of(readers.with_file_metadata(spark.createDataFrame([(n,) for n in names], "file string")))
    assert [r[1:] for r in out] == [("HG1", "HiFi", 10), ("HG2", "CLR", 2)]
    with pytest.raises(Exception, match="no sample"):
        readers.with_file_metadata(spark.createDataFrame([("x.bed",)], "file string")).collect()


def test_cleaning_edges(spark):
    reps = spark.createDataFrame([("chr1", "a", "LINE", "L1"), ("chr1", "b", "Odd", "x")], "chrom string, name string, rep_class string, rep_family string")
    assert cleaning.clean_repeats(reps.limit(1)).count() == 1
    with pytest.raises(Exception, match="unhandled repeat class"):
        cleaning.clean_repeats(reps).collect()
    fracs = spark.createDataFrame([(f,) for f in (0.8999, 0.9, 0.98, 0.99, 1.0)], "f double")
    assert [r[0] for r in fracs.select(cleaning.segdup_colour(F.col("f"))["color_name"]).collect()] == ["purple", "gray", "yellow", "orange", "orange"]
    issue = spark.createDataFrame([("chr1:1,001-2,000", None)], "location string, fix_version string").selectExpr("*", "'Gap' issue_type", "'HG-1' issue_id", "'a b' status", "'2' placements", "'s' summary")
    assert cleaning.clean_issues(issue).first()[:4] == ("chr1", 1000, 2000, "Gap_HG-1")
    assert cleaning.clean_issues(issue, compat=True).first()[:3] == ("chr1", 1001, 2001)


def test_names_matched_twice(spark):
    chroms = spark.createDataFrame([("chr1",), ("chrUn_KI270302v1",)], "chrom string")
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "name string")
    out = {r["name"]: r["target"] for r in cleaning.match_names(names("1", "chr1", "KI270302.1", "zzz"), chroms).collect()}
    assert out == {"1": "chr1", "chr1": "chr1", "KI270302.1": "chrUn_KI270302v1", "zzz": None}
    with pytest.raises(Exception, match="two names match"):
        cleaning.match_names(names("KI270302.1", "KI270302.2"), chroms).collect()


def test_chop_and_blocks(spark):
    seqs = spark.createDataFrame([("a", "x" * 499), ("b", "x" * 1000), ("c", "x" * 1601)], "name string, seq string")
    lengths = sorted((r["name"], len(r["seq"])) for r in cleaning.chop_sequences(seqs).collect())
    assert lengths == [("b_read0", 500), ("b_read1", 500), ("c_read0", 500), ("c_read1", 500), ("c_read2", 500)]
    blocks = spark.createDataFrame([("k", "A" * 5 + "NN" + "A" * 6 + "NN" + "A" * 3)], "name string, seq string")
    assert [tuple(r)[1:] for r in cleaning.split_blocks(blocks, 10, "NN").orderBy("contig_no").collect()] == [(0, 0, 5), (0, 1, 6), (1, 2, 3)]


def test_alignment_table_prunes(spark, tmp_path):
    """Filters reach the stored table: technology as a partition, mapq as a pushed filter, and only the columns used are read."""
    from locusframe.operators import assemblies

    bed = spark.createDataFrame([("chr1", 0, 10, "c", 60, "+", "S1", "HiFi", 10), ("chr9", 0, 9, "c", 60, ".", "S1", "CLR", 10)],
                                "chrom string, start_pos long, end_pos long, contig string, mapq int, strand string, sample string, tech string, hap int")
    samples = spark.createDataFrame([("S1", "F", "EUR")], "sample string, sex string, super_pop string")
    chroms = spark.createDataFrame([("chr1", 100)], "chrom string, size long")
    table = assemblies.build_alignment_table(bed, samples, chroms)
    assert [r["strand"] for r in table.collect()] == [1]
    assemblies.write_alignment_table(table, str(tmp_path / "store"))
    out = assemblies.filter_mapq(spark.read.parquet(str(tmp_path / "store")).where("tech = 'HiFi'"), 50).select("chrom", "start_pos", "end_pos")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(mapq,50)" in plan and "PartitionFilters: [isnotnull(tech" in plan and "contig" not in plan
    assert out.count() == 1


def test_same_file_name_in_two_folders(spark, tmp_path):
    for folder, n in (("a", 3), ("b", 5)):
        (tmp_path / folder).mkdir()
        put(tmp_path / folder / "stats.tsv", f"num_reads\t{n}\ncov_total\t1.5\n")
    out = readers.read_key_value(spark, str(tmp_path / "*"), ["num_reads", "cov_total"])
    assert sorted((r["num_reads"], r["cov_total"]) for r in out.collect()) == [(3, 1.5), (5, 1.5)]


def test_vcf_files_with_their_own_sample_order(spark, tmp_path):
    fixed = "chr1\t{}\t.\tA\tT\t9\tPASS\tDP=1\tGT\t"
    for name, order, calls in (("a", "S1\tS2", "0/1\t1/1"), ("b", "S2\tS1", "0/0\t0/1")):
        head = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t" + order
        (tmp_path / f"{name}.vcf").write_text("##x\n" + head + "\n" + fixed.format(1 if name == "a" else 2) + calls + "\n")
    got = readers.read_vcf(spark, str(tmp_path / "*.vcf"), "S1").orderBy("pos").collect()
    assert [(r["pos"], r["call"]) for r in got] == [(1, "0/1"), (2, "0/1")]
    (tmp_path / "c.vcf").write_text("##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS3\n" + fixed.format(3) + "0/1\n")
    with pytest.raises(Exception, match="no sample S1 in"):
        readers.read_vcf(spark, str(tmp_path / "*.vcf"), "S1").collect()


def test_a_run_must_fit_its_study(spark):
    cols = "study string, individual string, sample_alias string, library_name string, library_layout string, run string, fastq_ftp string, submitted_ftp string, instrument_platform string, instrument_model string"
    good = ("PRJEB12849", "S1", "xS1", "S1_7_021_mono", "PAIRED", "R1", "ftp.ebi.ac.uk/R1_1.fastq.gz", "a", "ILLUMINA", "Illumina HiSeq 2500")
    assert cleaning.annotate_runs(spark.createDataFrame([good], cols)).count() == 1
    for at, value in ((3, "S2_7_021_mono"), (3, "S1_7_21_mono"), (4, "SINGLE"), (8, "PACBIO"), (9, None)):
        bad = list(good)
        bad[at] = value
        with pytest.raises(Exception, match="does not fit"):
            cleaning.annotate_runs(spark.createDataFrame([tuple(bad)], cols)).collect()
    # a study that leaves unpaired runs out
    other = ("PRJEB14185", "S1", "xS1", "l", "SINGLE", "R1", "ftp.ebi.ac.uk/R1_1.fastq.gz", "a", "ILLUMINA", "HiSeq 2500")
    assert cleaning.annotate_runs(spark.createDataFrame([other], cols)).count() == 0


def test_json_records(spark, tmp_path):
    lines = ['{"a": 1, "b": "x"}', "", '{"a": "one", "b": "y"}', '{"a": 2', "[3]", '{"c": 0}']
    (tmp_path / "r.json").write_text("\n".join(lines))
    got = sorted(map(tuple, readers.read_json(spark, str(tmp_path / "r.json"), "a long, b string").collect()), key=str)
    want = [(1, "x", None), (None, "y", lines[2]), (None, None, None)]
    assert [r for r in got if r[2] != lines[3] and r[2] != lines[4]] == sorted(want, key=str)
    assert {r[2] for r in got} >= {lines[2], lines[3]}
    (tmp_path / "w.json").write_text('{\n  "a": 5,\n  "b": null\n}\n')
    assert [tuple(r) for r in readers.read_json(spark, str(tmp_path / "w.json"), "a long, b string", whole=True).collect()] == [(5, None, None)]


def test_json_entries(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"s/1": {"md5": "q", "local_path": "p"},\n "s/2": {"local_path": "r"}}')
    (tmp_path / "two.json").write_text('{"t/1": {"md5": "z"}}')
    read = lambda: sorted(map(tuple, readers.read_json_entries(spark, str(tmp_path), "md5 string, local_path string").collect()))
    assert read() == [("s/1", "q", "p"), ("s/2", None, "r"), ("t/1", "z", None)]
    (tmp_path / "three.json").write_text('{"s/1": {"md5": "again"}}')
    with pytest.raises(Exception, match="name occurs twice"):
        read()
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.json").write_text('["no object"')
    with pytest.raises(Exception, match="not an object"):
        readers.read_json_entries(spark, str(tmp_path / "bad"), "md5 string").collect()


@pytest.mark.parametrize("split", [64, 1000, 1 << 27])
def test_fasta_chunks_across_splits(spark, tmp_path, split):
    rnd = random.Random(4)
    want, total = {}, 0
    for number in range(2):
        text = []
        for i, length in enumerate((0, 1, 7, 20, 5_000, 60, 61, 0)):
            seq = "".join(rnd.choice("ACGTN") for _ in range(length))
            name, width = f"s{number}.{i}", rnd.choice([1, 7, 60])
            text += [f"> {name} some words"] + [seq[j:j + width] for j in range(0, length, width)] + [""] * rnd.randrange(2)
            want.update({(name, j // 20): seq[j:j + 20] for j in range(0, length, 20)})
        put(tmp_path / f"{number}.fa", "\n".join(text) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        out = readers.read_fasta_chunks(spark, str(tmp_path), 20)
        got = [((r["name"], r["chunk_no"]), r["seq"]) for r in out.collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == len(want) and dict(got) == want


def test_fasta_chunks_without_header_or_rows(spark, tmp_path):
    assert readers.read_fasta_chunks(spark, put(tmp_path / "none.fa", "")).count() == 0
    with pytest.raises(Exception, match="before the first header"):
        readers.read_fasta_chunks(spark, put(tmp_path / "bad.fa", "ACGT\n>a\nA\n")).collect()
    twice = readers.read_fasta_chunks(spark, put(tmp_path / "twice.fa", ">a\nAC\n>a\nGT\n"))
    assert sorted(rows_of(twice)) == [("a", 0, "AC"), ("a", 0, "GT")]

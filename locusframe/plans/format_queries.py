"""Queries that write the given tables as text formats and read them back, and queries on cleaned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning
from ..operators.lineage import scratch_path
from ..operators.sweep import union_all
from ..sources import readers, writers
from .registry import query


def stored(s, df, write=writers.write_lines, **options) -> str:
    path = scratch_path(s.spark)
    write(df, path, **options)
    return path


def line(*cols, sep="\t"):
    return F.concat_ws(sep, *[c.cast("string") if not isinstance(c, str) else F.col(c).cast("string") for c in cols]).alias("value")


BED = "chrom, start_pos, end_pos, contig, mapq, strand"
CLEAN = "regexp_replace(seq, '\\s', '', 'g')"  # FASTA and FASTQ hold no white space inside a sequence


def flat_reads(s):
    return s.reads.select("name", F.regexp_replace("seq", r"\s", "").alias("seq"))


@query("read_bed", f"SELECT {BED} FROM aln")
def _(s):
    return readers.read_bed(s.spark, stored(s, s.aln.select(line(*readers.BED6))))


@query("write_bed", f"SELECT {BED} FROM aln")
def _(s):
    return readers.read_bed(s.spark, stored(s, s.aln.select(*readers.BED6), writers.write_bed))


@query("read_table", "SELECT name, CAST(score AS BIGINT) AS score, CAST(start_pos AS VARCHAR) AS start_pos FROM regions")
def _(s):
    def write(df, path):
        df.write.option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)

    path = stored(s, s.regions.withColumnRenamed("chrom", "#chrom"), write)
    return readers.read_table(s.spark, path, ["name", "score", "start_pos"], {"score": "long"})


@query("read_sizes", "SELECT chrom, size, (SELECT CAST(sum(size) AS BIGINT) FROM chroms) AS genome_size FROM chroms")
def _(s):
    sizes = readers.read_sizes(s.spark, stored(s, s.chroms.select(line("chrom", "size", F.lit(7), F.lit(60)))))
    total = readers.total_length(sizes)
    return sizes.withColumn(total.columns[0], total.scalar())


@query("read_fasta", f"SELECT name, md5({CLEAN}) AS digest, length({CLEAN}) AS len FROM reads")
def _(s):
    back = readers.read_fasta(s.spark, stored(s, flat_reads(s), writers.write_fasta, width=120))
    return back.select("name", F.md5("seq").alias("digest"), F.length("seq").cast("long").alias("len"))


@query("write_fasta", f"SELECT CAST(ceil(length({CLEAN}) / 80.0) AS BIGINT) AS lines, count(*) AS n FROM reads GROUP BY ALL")
def _(s):
    path = stored(s, flat_reads(s), writers.write_fasta, width=80)
    lines = s.spark.read.option("lineSep", "\n>").text(path).select((F.size(F.split(F.regexp_replace("value", "\n$", ""), "\n")) - 1).cast("long").alias("lines"))
    return lines.groupBy("lines").agg(F.count(F.lit(1)).alias("n"))


@query("read_fastq", f"SELECT name, md5({CLEAN}) AS digest, md5(CASE WHEN {CLEAN} = '' THEN '' ELSE '@' || substr({CLEAN}, 2) END) AS qual FROM reads")
def _(s):
    rows = flat_reads(s).withColumn("qual", F.when(F.col("seq") == "", "").otherwise(F.concat(F.lit("@"), F.expr("substring(seq, 2)"))))  # a quality line may start like a header
    back = readers.read_fastq(s.spark, stored(s, rows, writers.write_fastq))
    return back.select("name", F.md5("seq").alias("digest"), F.md5("qual").alias("qual"))


@query("fastq_to_fasta", f"SELECT name, md5({CLEAN}) AS digest FROM reads")
def _(s):
    fastq = readers.read_fastq(s.spark, stored(s, flat_reads(s).withColumn("qual", F.col("seq")), writers.write_fastq))
    back = readers.read_fasta(s.spark, stored(s, fastq, writers.fastq_to_fasta))
    return back.select("name", F.md5("seq").alias("digest"))


@query(
    "read_sam",
    """SELECT contig AS name, CASE strand WHEN '-' THEN 16 ELSE 0 END + CASE WHEN mapq = 0 THEN 4 ELSE 0 END AS flag, CASE WHEN mapq > 0 THEN chrom END AS chrom,
      CASE WHEN mapq > 0 THEN start_pos END AS start_pos, CASE WHEN mapq > 0 THEN end_pos + 3 END AS end_pos, mapq, strand FROM aln""",
)
def _(s):
    flag = F.when(F.col("strand") == "-", 16).otherwise(0) + F.when(F.col("mapq") == 0, 4).otherwise(0)
    cigar = F.concat(F.lit("5S"), (F.col("end_pos") - F.col("start_pos")).cast("string"), F.lit("M2I3D4H"))
    rows = s.aln.select(line("contig", flag, "chrom", F.col("start_pos") + 1, "mapq", cigar, F.lit("*"), F.lit(0), F.lit(0), F.lit("ACGT"), F.lit("IIII")))
    head = s.chroms.select(F.concat(F.lit("@SQ\tSN:"), "chrom").alias("value"))
    return readers.read_sam(s.spark, stored(s, head.unionByName(rows))).select("name", "flag", "chrom", "start_pos", "end_pos", "mapq", "strand")


def vcf_lines(s):
    head = s.spark.range(1).select(F.lit("##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1").alias("value"))
    return head.unionByName(s.vcf.select(line("chrom", "pos", "id", "ref", "alt", "qual", "filter", F.concat("info", F.lit(";PASSED")), "format", "call")))


@query(
    "read_vcf",
    """SELECT chrom, pos, id, ref, alt, qual, filter, regexp_extract(info, 'DP=([0-9]+)', 1) AS info_dp, regexp_extract(info, 'TYPE=([a-z]+)', 1) AS info_type, 'true' AS passed,
      split_part(call, ':', 1) AS gt, split_part(call, ':', 3) AS dp FROM vcf""",
)
def _(s):
    v = readers.read_vcf(s.spark, stored(s, vcf_lines(s)), "S1")
    m, c = F.col("info_map"), F.col("call_map")
    return v.select("chrom", "pos", "id", "ref", "alt", "qual", "filter", m["DP"].alias("info_dp"), m["TYPE"].alias("info_type"), m["PASSED"].alias("passed"), c["GT"].alias("gt"), c["DP"].alias("dp"))


@query(
    "read_vcf_bed",
    """SELECT chrom, pos - 1 AS start_pos, pos - 1 + length(ref) AS end_pos, qual AS quality, CAST(regexp_extract(info, 'DP=([0-9]+)', 1) AS BIGINT) AS depth,
      CAST(regexp_extract(info, 'LEN=([0-9]+)', 1) AS BIGINT) AS variant_length, ref AS ref_allele, alt AS alt_allele FROM vcf""",
)
def _(s):
    gt_dp = F.concat_ws(":", F.element_at(F.split("call", ":"), 1), F.element_at(F.split("call", ":"), 3))
    rows = s.vcf.select(line("chrom", F.col("pos") - 1, F.col("pos") - 1 + F.length("ref"), "id", "qual", "ref", "alt", "filter", "info", F.lit("GT:DP"), gt_dp))
    return readers.read_vcf_bed(s.spark, stored(s, rows))


@query(
    "read_lifted_bed",
    "SELECT contig AS seq, start_pos, end_pos, chrom AS ref_seq, start_pos + 7 AS ref_start, end_pos + 7 AS ref_end FROM aln",
)
def _(s):
    suffix = F.when(F.col("mapq") == 0, "_t5").when(F.col("mapq") == 10, "_t3").otherwise("")
    name = F.concat(F.concat_ws("_", "contig", F.col("start_pos").cast("string"), F.col("end_pos").cast("string")), suffix)
    rows = s.aln.select(line("chrom", F.col("start_pos") + 7, F.col("end_pos") + 7, name, F.lit(0), "strand"))
    return readers.read_lifted_bed(s.spark, stored(s, rows))


def gff_lines(s):
    kind = F.element_at(F.array(*[F.lit(k) for k in [*cleaning.REGION_TYPES, "other_region"]]), (F.col("score") % 7 + 1).cast("int"))
    seqid = F.when(F.col("score") % 5 == 0, F.replace("chrom", F.lit("chr"), F.lit(""))).when(F.col("score") % 5 == 1, "unplaced").otherwise(F.col("chrom"))
    stop = F.when(F.col("score") % 4 == 0, F.col("start_pos") + 30).otherwise(F.col("end_pos"))
    return s.regions.select(line(seqid, F.lit("src"), kind, F.col("start_pos") + 1, stop, F.lit("."), F.lit("."), F.lit("."), F.concat(F.lit("ID=ENSR"), F.replace("name", F.lit("R"), F.lit("")), F.lit(";x=1"))))


GFF = """gf AS (SELECT name, CASE WHEN score % 5 = 0 THEN replace(chrom, 'chr', '') WHEN score % 5 = 1 THEN 'unplaced' ELSE chrom END AS seqid,
    ['CTCF_binding_site', 'enhancer', 'open_chromatin_region', 'promoter', 'promoter_flanking_region', 'TF_binding_site', 'other_region'][score % 7 + 1] AS type,
    ['CTCF', 'ENH', 'OPEN', 'PROM', 'PRFL', 'TFBS', 'other_region'][score % 7 + 1] AS rt,
    start_pos, CASE WHEN score % 4 = 0 THEN start_pos + 30 ELSE end_pos END AS end_pos, CASE WHEN score % 5 <> 1 THEN chrom END AS target FROM regions),
  gr AS (SELECT *, CASE WHEN end_pos - start_pos < 31 THEN 'short' WHEN target IS NULL THEN 'unmatched' END AS skip FROM gf)"""


@query("read_gff3", f"WITH {GFF} SELECT seqid, type, start_pos, end_pos, concat('ID=ENSR', replace(name, 'R', ''), ';x=1') AS attributes FROM gf")
def _(s):
    return readers.read_gff3(s.spark, stored(s, gff_lines(s))).select("seqid", "type", "start_pos", "end_pos", "attributes")


@query("gff_to_regions", f"WITH {GFF} SELECT CASE WHEN skip IS NULL THEN target END AS chrom, start_pos, end_pos, concat(rt, '_ENSR', replace(name, 'R', '')) AS name, skip FROM gr")
def _(s):
    out = cleaning.gff_to_regions(readers.read_gff3(s.spark, stored(s, gff_lines(s))), s.chroms)
    return out.select(F.when(F.col("skip").isNull(), F.col("chrom")).alias("chrom"), "start_pos", "end_pos", "name", "skip")


@query(
    "gff_counts",
    f"""WITH {GFF}, k AS (SELECT skip IS NULL AS kept, unnest([rt, CASE WHEN skip IS NULL THEN target WHEN skip = 'unmatched' THEN seqid END, CASE WHEN skip IS NULL THEN 'TOTAL' END]) AS key, end_pos - start_pos AS l FROM gr)
      SELECT kept, key, count(*) AS n, CAST(sum(l) AS BIGINT) AS bp FROM k WHERE key IS NOT NULL GROUP BY ALL""",
)
def _(s):
    return cleaning.gff_counts(cleaning.gff_to_regions(readers.read_gff3(s.spark, stored(s, gff_lines(s))), s.chroms))


@query(
    "read_agp",
    """SELECT scaffold AS object, start_pos + 1 AS object_start, start_pos + length AS object_end, ord * 2 - 1 AS comp_number, 'W' AS comp_type, contig AS comp_name, length AS comp_length FROM layout
      UNION ALL SELECT scaffold, start_pos + length + 1, start_pos + length + 50, ord * 2, 'N', '50', NULL FROM layout""",
)
def _(s):
    w = s.layout.select(line("scaffold", F.col("start_pos") + 1, F.col("start_pos") + F.col("length"), F.col("ord") * 2 - 1, F.lit("W"), "contig", F.lit(1), "length", F.lit("+")))
    stop = F.col("start_pos") + F.col("length")
    n = s.layout.select(line("scaffold", stop + 1, stop + 50, F.col("ord") * 2, F.lit("N"), F.lit(50), F.lit("scaffold"), F.lit("yes"), F.lit("map")))
    agp = readers.read_agp(s.spark, stored(s, w.unionByName(n)))
    return agp.select("object", "object_start", "object_end", F.col("comp_number").cast("int").alias("comp_number"), "comp_type", "comp_name", "comp_length")


@query("read_bedgraph", "SELECT chrom, start_pos, end_pos, CAST(depth AS DOUBLE) AS depth FROM track")
def _(s):
    return readers.read_bedgraph(s.spark, stored(s, s.track.select(line("chrom", "start_pos", "end_pos", "depth"))))


def of_sample(df):
    """Sample from the folder of the file."""
    return df.withColumn("sample", F.regexp_extract("file", "sample=(S[0-9]+)", 1)).drop("file")


@query("read_key_value", "SELECT sample, count(*) AS num_rows, CAST(sum(end_pos - start_pos) AS BIGINT) AS total_bp, round(avg(mapq), 3) AS pct_mapq FROM aln GROUP BY sample")
def _(s):
    sums = s.aln.groupBy("sample").agg(F.count(F.lit(1)).alias("num_rows"), F.sum(F.col("end_pos") - F.col("start_pos")).alias("total_bp"), F.round(F.avg("mapq"), 3).alias("pct_mapq"))
    rows = sums.select("sample", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.concat_ws("\t", F.lit(c), F.col(c).cast("string")).alias("value")) for i, c in enumerate(["num_rows", "total_bp", "pct_mapq"])])).alias("x")).select("sample", "x.*")
    path = scratch_path(s.spark)
    rows.repartition("sample").select("sample", "value").write.partitionBy("sample").text(path)
    return of_sample(readers.read_key_value(s.spark, path, ["num_rows", "total_bp", "pct_mapq"]))


def report_files(s):
    """One report per sample: head lines, a section with counts, a section with shares."""
    sums = s.aln.groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("strand") == "+", 1).otherwise(0)).alias("p"), F.max("mapq").alias("m"))
    pct = F.round(F.col("p") / F.col("n") * 100, 2).cast("string")
    text = F.concat_ws(
        "\n", F.lit("first head"), F.lit("second head"), F.lit("                 [REF]   [QRY]"), F.lit("[Bases]"),
        F.concat(F.lit("Total-Bases   "), F.col("n").cast("string"), F.lit("   "), F.col("p").cast("string")),
        F.concat(F.lit("Aligned.Bases   "), F.col("n").cast("string"), F.lit("(100.00%)   "), F.col("p").cast("string"), F.lit("("), pct, F.lit("%)")),
        F.lit("[Alignments]"), F.concat(F.lit("AvgIdentity   "), pct, F.lit("   "), F.col("m").cast("string")), F.concat(F.lit("genes   "), F.col("n").cast("string"), F.lit(" + "), F.col("p").cast("string"), F.lit(" part")),
    )
    path = scratch_path(s.spark)
    sums.repartition("sample").select("sample", text.alias("value")).write.partitionBy("sample").text(path)
    return path


REPORT = "rp AS (SELECT sample, count(*) AS n, count(*) FILTER (strand = '+') AS p, max(mapq) AS m FROM aln GROUP BY sample)"


@query("read_numbered_report", f"WITH {REPORT} SELECT sample, p AS aligned, CAST(m AS DOUBLE) AS best_pct FROM rp")
def _(s):
    return of_sample(readers.read_numbered_report(s.spark, report_files(s), {5: "aligned", 8: "best_pct"}))


@query("read_gene_counts", f"WITH {REPORT} SELECT sample, n AS complete, p AS partial FROM rp")
def _(s):
    return of_sample(readers.read_gene_counts(s.spark, report_files(s), 9))


@query(
    "read_sectioned_report",
    f"""WITH {REPORT} SELECT sample, 'REF_Bases_Total_Bases' AS metric, n AS "count", CAST(NULL AS DOUBLE) AS pct FROM rp UNION ALL SELECT sample, 'QRY_Bases_Total_Bases', p, NULL FROM rp
      UNION ALL SELECT sample, 'REF_Bases_AlignedgapBases', n, 100 FROM rp UNION ALL SELECT sample, 'QRY_Bases_AlignedgapBases', p, round(p / n * 100, 2) FROM rp
      UNION ALL SELECT sample, 'REF_Alignments_AvgIdentity', NULL, round(p / n * 100, 2) FROM rp UNION ALL SELECT sample, 'QRY_Alignments_AvgIdentity', m, NULL FROM rp""",
)
def _(s):
    return of_sample(readers.read_sectioned_report(s.spark, report_files(s))).where("metric not like '%genes'")


@query(
    "file_metadata",
    "SELECT DISTINCT concat(sample, '_x_pbsq2-', CASE tech WHEN 'HiFi' THEN 'ccs' ELSE 'clr' END, '_1000.', CASE hap WHEN 10 THEN 'h1-un' ELSE 'h2-un' END, '.bed') AS file, sample, tech AS platform, hap AS haplotype FROM aln",
)
def _(s):
    tech = F.when(F.col("tech") == "HiFi", "ccs").otherwise("clr")
    hap = F.when(F.col("hap") == 10, "h1-un").otherwise("h2-un")
    files = s.aln.select(F.concat("sample", F.lit("_x_pbsq2-"), tech, F.lit("_1000."), hap, F.lit(".bed")).alias("file")).distinct()
    return readers.with_file_metadata(files)


@query(
    "read_json",
    """SELECT CASE WHEN score % 50 > 0 THEN name END AS name, CASE WHEN score % 50 > 0 THEN start_pos END AS start_pos, CASE WHEN score % 50 > 1 THEN score END AS score,
      CASE WHEN score % 50 > 0 AND score % 3 > 0 THEN cls END AS cls, score % 50 < 2 AS bad FROM regions""",
)
def _(s):
    """Records with every field, without one, with a field of another type and cut short."""
    record = "to_json(named_struct('name', name, 'start_pos', start_pos, 'cls', CASE WHEN score % 3 > 0 THEN cls END, 'score', score))"
    text = F.expr(f"CASE score % 50 WHEN 0 THEN concat('{{\"name\": \"', name) WHEN 1 THEN replace({record}, concat('\"score\":', score), '\"score\":\"none\"') ELSE {record} END")
    rows = readers.read_json(s.spark, stored(s, s.regions.select(text.alias("value"))), "name string, start_pos long, score long, cls string")
    return rows.withColumn("bad", F.col("bad_record").isNotNull()).drop("bad_record")


@query(
    "read_fasta_chunks",
    f"""SELECT name, chunk_no, md5(substr(seq, CAST(chunk_no * 500 + 1 AS INTEGER), 500)) AS digest FROM (SELECT name, {CLEAN} AS seq, unnest(range((length({CLEAN}) + 499) // 500)) AS chunk_no FROM reads) x""",
)
def _(s):
    chunks = readers.read_fasta_chunks(s.spark, stored(s, flat_reads(s), writers.write_fasta, width=120), 500)
    return chunks.select("name", "chunk_no", F.md5("seq").alias("digest"))


@query("read_json_entries", "SELECT sample, sex, population, CASE WHEN sex = 'male' THEN family END AS family FROM samples")
def _(s):
    entry = F.expr("to_json(map(sample, named_struct('sex', sex, 'population', population, 'family', CASE WHEN sex = 'male' THEN family END)))")
    path = stored(s, s.samples.select(entry.alias("value")))
    return readers.read_json_entries(s.spark, path, "sex string, population string, family string", name="sample", whole=False)


@query("write_by_class", "SELECT chrom, start_pos, end_pos, name, cls FROM regions UNION ALL SELECT chrom, start_pos, end_pos, name, 'all' FROM regions")
def _(s):
    path = stored(s, s.regions.select("chrom", "start_pos", "end_pos", "name", "cls"), lambda df, p: writers.write_by_class(df, "cls", p))
    kinds = {"start_pos": "long", "end_pos": "long"}
    each = [readers.read_table(s.spark, f"{path}/by_class/_class={c}", types=kinds) for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")]
    return union_all(each).unionByName(readers.read_table(s.spark, f"{path}/all", types=kinds).withColumn("cls", F.lit("all")))


@query("concat_parts", f"SELECT {BED} FROM aln")
def _(s):
    paths = [stored(s, s.aln.where(F.col("tech") == t).select(line(*readers.BED6))) for t in ("HiFi", "CLR")]
    return readers.concat_parts(readers.read_bed, s.spark, paths)


@query("merge_fasta_prefix", f"SELECT concat('cluster', colour, '_', name) AS name, md5({CLEAN}) AS digest FROM reads")
def _(s):
    name = F.when(F.col("colour") % 2 == 0, F.concat(F.lit("cluster"), F.col("colour").cast("string"), F.lit("_"), "name")).otherwise(F.concat("name", F.lit("|arrow")))
    rows = s.reads.select("colour", name.alias("name"), F.regexp_replace("seq", r"\s", "").alias("seq"))
    parts = []
    for c in range(6):
        path = stored(s, rows.where(f"colour = {c}"), writers.write_fasta, width=120)
        parts.append(readers.read_fasta(s.spark, path).withColumn("cluster", F.lit(f"cluster{c}")))
    return readers.merge_fasta(union_all(parts)).select("name", F.md5("seq").alias("digest"))


# --- cleaned tables ---------------------------------------------------------

REP_CLASS = ["LINE", "SINE", "LTR?", "tRNA", "Simple_repeat", "Unknown", "Low_complexity", "DNA", "Satellite", "rRNA"]
REP_FAMILY = ["L1", "Alu", "ERV", "tRNA", "Simple_repeat", "Unknown", "Low_complexity", "hAT?", "centr", "RNA"]


def repeats(s):
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("score") % 10 + 1).cast("int"))
    return s.regions.withColumns({"rep_class": pick(REP_CLASS), "rep_family": pick(REP_FAMILY), "strand": F.lit("+")})


REPS = f"rp AS (SELECT *, {REP_CLASS}[score % 10 + 1] AS rep_class, {REP_FAMILY}[score % 10 + 1] AS rep_family FROM regions)"


@query(
    "clean_repeats",
    f"""WITH {REPS} SELECT name, rep_class, CASE WHEN rep_class LIKE '%RNA%' THEN 'RNA' WHEN rep_class = 'Simple_repeat' THEN 'SimpleRep' WHEN rep_class = 'Low_complexity' THEN 'LowComplex' ELSE rep_class END AS out_class
      FROM rp WHERE chrom <> 'chr5' AND rep_class NOT LIKE '%?%' AND rep_family NOT LIKE '%?%' AND rep_class <> 'Unknown'""",
)
def _(s):
    return cleaning.clean_repeats(repeats(s), [f"chr{i}" for i in range(1, 5)]).select("name", "rep_class", "out_class")


@query(
    "repeats_by_family",
    f"""WITH {REPS} SELECT name, CASE rep_class WHEN 'Simple_repeat' THEN 'SimpleRepeat' WHEN 'Low_complexity' THEN 'LowComplexity' WHEN 'Satellite' THEN 'Satellite' WHEN 'LINE' THEN 'Line' WHEN 'SINE' THEN 'Sine' END AS group_class,
      CASE rep_family WHEN 'Simple_repeat' THEN 'SimpleRepeat' WHEN 'Low_complexity' THEN 'LowComplexity' WHEN 'centr' THEN 'Centr' WHEN 'L1' THEN 'L1' WHEN 'Alu' THEN 'Alu' END AS group_family
      FROM rp WHERE rep_class IN ('LINE', 'SINE', 'Simple_repeat', 'Low_complexity', 'Satellite')""",
)
def _(s):
    return cleaning.repeats_by_family(repeats(s)).select("name", "group_class", "group_family")


@query(
    "clean_simple_repeats",
    """SELECT concat_ws('_', 'TRF', chrom, start_pos, end_pos - start_pos) AS name, repeat('A', CAST(score % 6 + 1 AS INTEGER)) AS motif,
      CASE score % 6 WHEN 0 THEN 'homopolymer' WHEN 1 THEN 'dinucleotide' WHEN 2 THEN 'trinucleotide' ELSE 'other' END AS out_class FROM regions""",
)
def _(s):
    rows = s.regions.withColumn("motif", F.repeat(F.lit("A"), (F.col("score") % 6 + 1).cast("int")))
    return cleaning.clean_simple_repeats(rows).select("name", "motif", "out_class")


@query(
    "score_segdups",
    """WITH x AS (SELECT name, score AS uid, 0.85 + (score % 31) * 0.005 AS f FROM regions), y AS (SELECT *, CAST(least(round_even(CAST(f AS DOUBLE) * 1000, 0), 1000) AS INTEGER) AS score FROM x)
      SELECT concat_ws('@', uid, score, name) AS label, score, CASE WHEN f < 0.9 THEN 'purple' WHEN f < 0.98 THEN 'gray' WHEN f < 0.99 THEN 'yellow' ELSE 'orange' END AS color_name FROM y""",
)
def _(s):
    frac = F.expr("0.85 + (score % 31) * 0.005")
    rows = s.regions.withColumns({"uid": F.col("score"), "frac_match": frac})
    return cleaning.score_segdups(rows).select("label", "score", "color_name")


@query(
    "clean_issues",
    """SELECT chrom, start_pos, end_pos, concat('Gap_', name) AS name, 'Under_Review' AS status, '[' || cls || ']' AS summary FROM regions WHERE score % 4 <> 0 AND score % 5 <> 0""",
)
def _(s):
    place = F.concat("chrom", F.lit(":"), F.format_number(F.col("start_pos") + 1, 0), F.lit("-"), F.format_number("end_pos", 0))
    rows = s.regions.select(
        F.when(F.col("score") % 4 != 0, place).alias("location"), F.when(F.col("score") % 5 == 0, "GRCh39").alias("fix_version"), F.lit("Gap").alias("issue_type"), F.col("name").alias("issue_id"),
        F.lit("Under Review").alias("status"), F.lit("1").alias("placements"), F.col("cls").alias("summary"),
    )
    return cleaning.clean_issues(rows).select("chrom", "start_pos", "end_pos", "name", "status", "summary")


@query(
    "clean_regions",
    """SELECT chrom, start_pos, end_pos, CASE score % 3 WHEN 0 THEN 'CEN' || score WHEN 1 THEN 'HET' || score ELSE 'PAR1' || replace(chrom, 'chr', '') END AS name, CASE score % 3 WHEN 0 THEN 1000 WHEN 1 THEN 750 ELSE 500 END AS score
      FROM regions UNION ALL SELECT chrom, start_pos, end_pos, chrom || 'p' || name, CASE WHEN score % 2 = 0 THEN 0 ELSE CAST(score % 100 * 10 AS INTEGER) END FROM regions WHERE score % 7 <> 0 AND chrom <> 'chr9'""",
)
def _(s):
    name = F.when(F.col("score") % 3 == 0, F.concat(F.lit("CEN"), F.col("score").cast("string"))).when(F.col("score") % 3 == 1, F.concat(F.lit("HET"), F.col("score").cast("string"))).otherwise("PAR#1")
    modeled = s.regions.select(name.alias("name"), F.replace("chrom", F.lit("chr"), F.lit("")).alias("chrom"), (F.col("start_pos") + 1).alias("start_pos"), "end_pos")
    stain = F.when(F.col("score") % 2 == 0, "gneg").otherwise(F.concat(F.lit("gpos"), (F.col("score") % 100).cast("string")))
    bands = s.regions.select("chrom", "start_pos", "end_pos", F.when(F.col("score") % 7 != 0, F.concat(F.lit("p"), "name")).alias("name"), stain.alias("stain"))
    return cleaning.clean_regions(modeled).unionByName(cleaning.clean_cytobands(bands, s.chroms))


@query("unsupported_svs", "SELECT chrom, start_pos, start_pos + num_samples * 100 AS end_pos, name, svtype, cls AS svclass FROM (SELECT *, 'C' || num_samples AS cls FROM sv) WHERE num_samples % 2 = 0 AND svtype = 'DEL'")
def _(s):
    rows = s.sv.select(
        "chrom", F.col("start_pos").alias("pos"), F.col("name").alias("id"), "svtype", (F.col("num_samples") * 100).alias("svlen"),
        F.concat(F.lit("C"), F.col("num_samples").cast("string")).alias("disc_class"), F.when(F.col("num_samples") % 2 == 1, "yes").alias("bionano"),
    )
    return cleaning.unsupported_svs(rows, ["DEL"])


@query(
    "clean_sv_clusters",
    """SELECT name, chrom, start_pos, CASE WHEN num_samples = 3 THEN start_pos + 9 ELSE end_pos END AS end_pos, svtype, CASE WHEN num_samples = 3 THEN 'rejected' ELSE 'ok' END AS state FROM sv""",
)
def _(s):
    raw = s.sv.select(
        F.replace("name", F.lit("BNG"), F.lit("")).alias("name"), F.replace("chrom", F.lit("chr"), F.lit("")).alias("chrom"), "start_pos",
        F.when(F.col("num_samples") == 3, F.col("start_pos") + 9).otherwise(F.col("end_pos")).alias("end_pos"), F.when(F.col("svtype") == "DEL", "deletion").otherwise("insertion").alias("svtype"),
    )
    good, bad = cleaning.clean_sv_clusters(raw)
    return good.withColumn("state", F.lit("ok")).unionByName(bad.withColumn("state", F.lit("rejected")))


@query(
    "match_seq_names",
    """SELECT DISTINCT concat('contig_', cls, '_x') AS name, CASE cls WHEN 'PROMO' THEN 'ref_PROMO_1' WHEN 'SMALL' THEN 'ref_SMALL_1' WHEN 'ECONOMY' THEN 'ref_ECONOMY_1' WHEN 'LARGE' THEN 'ref_LARGE_1'
        WHEN 'MEDIUM' THEN 'ref_MEDIUM_1' WHEN 'STANDARD' THEN 'ref_STANDARD_1' END AS target, true AS by_substring FROM regions
      UNION ALL SELECT DISTINCT replace(chrom, 'chr', ''), chrom, false FROM regions UNION ALL SELECT DISTINCT chrom, chrom, false FROM regions""",
)
def _(s):
    names = s.regions.select(F.explode(F.array(F.concat(F.lit("contig_"), "cls", F.lit("_x")), F.replace("chrom", F.lit("chr"), F.lit("")), F.col("chrom"))).alias("name"))
    known = s.chroms.select("chrom").unionByName(s.regions.select(F.concat(F.lit("ref_"), "cls", F.lit("_1")).alias("chrom")).distinct())
    return cleaning.match_names(names, known)


HEADS = [
    ("{c}", "{p}"), ("CM{k}.2 Homo sapiens chromosome {n}, GRCh38 reference primary assembly", "chr{n}"), ("KI{k}.1 Homo sapiens unplaced genomic contig, X", "chrUn_KI{k}"),
    ("KI{k}.1 Homo sapiens chromosome {n} unlocalized genomic contig, X", "chr{n}_KI{k}_random"), ("KI{k}.1 Homo sapiens chromosome {n} genomic contig, alternate locus group X", "chr{n}_KI{k}_alt"),
    ("KN{k}.1 Homo sapiens chromosome {n} genomic contig HG{k}_PATCH, GRCh38", "chr{n}_KN{k}_G{k}"), ("J01415.2 Homo sapiens mitochondrion, complete genome", "chrM"), ("HLA:A*{k} 3503 bp", "HLA_A_{k}"),
]


def _fill(text: str, join: str) -> str:
    out = "'" + text + "'"
    for mark, expr in (("{n}", "(l % 22 + 1)"), ("{k}", "k"), ("{c}", "(l % 22 + 1)"), ("{p}", "concat('chr', l % 22 + 1)")):
        out = out.replace(mark, f"', CAST({expr} AS {join}), '")
    return f"concat({out})"


def _heads_sql(i: int, text: str) -> str:
    return " ".join(f"WHEN {j} THEN {_fill(h[i], text)}" for j, h in enumerate(HEADS))


@query("normalize_seq_names", f"SELECT k, CASE k % 8 {_heads_sql(1, 'VARCHAR')} END AS name FROM (SELECT p_partkey AS k, p_size AS l FROM part)")
def _(s):
    rows = s.sql("SELECT p_partkey AS k, p_size AS l FROM part").selectExpr("k", f"CASE k % 8 {_heads_sql(0, 'STRING')} END AS header")
    return cleaning.normalize_seq_names(rows).select("k", "name")


@query(
    "subset_sequences",
    """WITH x AS (SELECT *, CASE colour WHEN 0 THEN 'chr1' WHEN 1 THEN 'chrM' WHEN 2 THEN 'chr2_' || name || '_alt' WHEN 3 THEN 'chrUn_' || name WHEN 4 THEN 'chr4_' || name || '_random' ELSE 'decoy' || name END AS nm FROM reads)
      SELECT 'main' AS rule, nm AS name, CAST(sum(len) AS BIGINT) AS size FROM x WHERE colour = 0 GROUP BY nm UNION ALL SELECT 'no_mito', nm, CAST(sum(len) AS BIGINT) FROM x WHERE colour <> 1 GROUP BY nm
      UNION ALL SELECT 'with_alt', nm, CAST(sum(len) AS BIGINT) FROM x WHERE colour IN (0, 2, 3, 4) GROUP BY nm UNION ALL SELECT 'regex', nm, CAST(sum(len) AS BIGINT) FROM x WHERE nm LIKE 'decoy%7' GROUP BY nm""",
)
def _(s):
    n = F.col("name")
    c = F.col("colour")
    name = F.when(c == 0, "chr1").when(c == 1, "chrM").when(c == 2, F.concat(F.lit("chr2_"), n, F.lit("_alt"))).when(c == 3, F.concat(F.lit("chrUn_"), n)).when(c == 4, F.concat(F.lit("chr4_"), n, F.lit("_random"))).otherwise(F.concat(F.lit("decoy"), n))
    seqs = s.reads.select(name.alias("name"), "seq")
    parts = [cleaning.sequence_sizes(cleaning.subset_sequences(seqs, r, regex="^decoy.*7$")).withColumn("rule", F.lit(r)) for r in ("main", "no_mito", "with_alt", "regex")]
    return union_all(parts)


def cohort(s):
    k = F.col("o_orderkey")
    two = lambda a, b: F.concat_ws(";", a, b)
    t = lambda x: F.concat(F.lit(x), k.cast("string"))
    return s.table("orders").select(
        k.alias("run_accession"), F.concat(F.lit("S"), (k % 8).cast("string"), F.lit(" ")).alias("sample_alias"), two(t("aa"), t("bb")).alias("fastq_md5"),
        F.when(k % 5 == 0, F.lit("17")).otherwise(two(t("1"), t("2"))).alias("fastq_bytes"), two(F.concat(F.lit("ftp.x/a/"), t("r"), F.lit("_1.fastq.gz")), F.concat(F.lit("ftp.x/a/"), t("r"), F.lit("_2.fastq.gz"))).alias("fastq_ftp"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.when(k % 3 == 0, t("x.bam")).otherwise(F.concat(t("x"), F.lit(".cram ")))).alias("submitted_ftp"),
    )


@query(
    "cohort_metadata",
    """SELECT o_orderkey AS run_accession, CASE WHEN k THEN concat('S', o_orderkey % 8, '_r', o_orderkey, '_2.fastq.gz') END AS fastq2_name, CASE WHEN k THEN concat('1', o_orderkey) END AS fastq1_bytes, CASE WHEN k THEN 'ready' ELSE 'dropped' END AS state
      FROM (SELECT o_orderkey, o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 3 <> 0 AS k FROM orders)""",
)
def _(s):
    ready, dropped = cleaning.split_cohort(cohort(s))
    none = F.lit(None).cast("string")
    return ready.select("run_accession", "fastq2_name", "fastq1_bytes", F.lit("ready").alias("state")).unionByName(
        dropped.select("run_accession", none.alias("fastq2_name"), none.alias("fastq1_bytes"), F.lit("dropped").alias("state"))
    )


def runs(s):
    k = F.col("o_orderkey")
    study = F.element_at(F.array(*[F.lit(x) for x in ["PRJEB12849", "PRJEB14185", "PRJNA540705", "PRJEB36890"]]), (k % 4 + 1).cast("int"))
    who = F.concat(F.lit("S"), (k % 8).cast("string"))
    run = F.concat(F.lit("ERR"), F.lpad(k.cast("string"), 9, "0"))
    ends = F.when(k % 4 == 2, F.lit(".fastq.gz")).otherwise(F.lit("_1.fastq.gz"))
    first = F.concat(F.lit("ftp.ebi.ac.uk/"), run, ends)
    urls = F.when(k % 4 == 2, first).otherwise(F.concat_ws(";", F.concat(F.lit("ftp.ebi.ac.uk/"), run, F.lit(".fastq.gz")), first, F.concat(F.lit("ftp.ebi.ac.uk/"), run, F.lit(".R2.fastq.gz"))))
    return s.table("orders").select(
        study.alias("study"), who.alias("individual"), F.when(k % 9 == 0, "other").otherwise(F.concat(F.lit("x"), who)).alias("sample_alias"),
        F.concat(who, F.lit("_7_021_"), F.when(k % 8 < 4, "mono").otherwise("di")).alias("library_name"), F.lit("PAIRED").alias("library_layout"), run.alias("run"),
        F.when(k % 4 == 2, "PACBIO_SMRT").otherwise("ILLUMINA").alias("instrument_platform"), F.element_at(F.array(*[F.lit(x) for x in ["Illumina HiSeq 2500", "HiSeq 2500", "Sequel II", "NovaSeq 6000"]]), (k % 4 + 1).cast("int")).alias("instrument_model"),
        urls.alias("fastq_ftp"), F.when(k % 11 == 0, "a.bam").otherwise("a.cram").alias("submitted_ftp"),
    )


RUNS = """ru AS (SELECT o_orderkey AS k, concat('S', o_orderkey % 8) AS who, concat('ERR', lpad(CAST(o_orderkey AS VARCHAR), 9, '0')) AS run FROM orders WHERE o_orderkey % 9 <> 0 AND NOT (o_orderkey % 4 = 3 AND o_orderkey % 11 = 0)),
  lb AS (SELECT *, who || CASE k % 4 WHEN 0 THEN '_1kg_il25k-' || CASE WHEN k % 8 < 4 THEN '075mo' ELSE '150di' END || '_P007L021' WHEN 1 THEN '_eriba_il25k-100pe_' || who || '-7-021-' || CASE WHEN k % 8 < 4 THEN 'mono' ELSE 'di' END
    WHEN 2 THEN '_giab_pbsq2-ccs' ELSE '_1kg_ilnvs-150pe' END AS label, CASE WHEN k % 4 = 2 THEN row_number() OVER (PARTITION BY who, k % 4 = 2 ORDER BY run) END AS part FROM ru),
  fi AS (SELECT *, unnest(CASE WHEN k % 4 = 2 THEN [0] ELSE [1, 2] END) AS mate FROM lb),
  an AS (SELECT run, label, mate, 'ftp://ftp.ebi.ac.uk/' || run || CASE mate WHEN 0 THEN '.fastq.gz' WHEN 1 THEN '_1.fastq.gz' ELSE '.R2.fastq.gz' END AS url,
    CASE WHEN mate = 0 THEN label || '.part' || part || '.fastq.gz' ELSE label || '_' || run || '_' || mate || '.fastq.gz' END AS local_name FROM fi)"""


@query("annotate_run_table", f"WITH {RUNS} SELECT * FROM an")
def _(s):
    return cleaning.annotate_runs(runs(s)).select("run", "label", "mate", "url", "local_name")


@query("blacklist_anti", f"WITH {RUNS} SELECT run, url FROM an WHERE url NOT LIKE '%77%' AND url NOT LIKE '%5.R2%'")
def _(s):
    return cleaning.drop_blacklisted(cleaning.annotate_runs(runs(s)).select("run", "url"), ["77", "5.R2"])


def segment_rows(s):
    n = F.col("p_partkey")
    t = lambda c: c.cast("string")
    chain = F.concat(F.lit("Red:"), F.format_number(n * 50, 0), F.lit("-"), t(n * 50 + 100), F.lit("; blue (partial) : "), t(n), F.lit("-"), t(n + 9), F.lit(";green(single label):"), t(n * 3), F.lit(";oops"))
    text = F.when(n % 5 == 0, "single label").when(n % 5 == 1, "notenoughresolution").when(n % 5 == 2, None).otherwise(chain)
    svs = F.when(n % 3 != 0, F.concat(F.lit("inversion(a + b):"), t(n), F.lit("-"), t(n + 5)))
    return s.table("part").select(
        n.alias("row_id"), F.concat(F.lit("GM"), t(n + 10000)).alias("sample_id"), F.lit("AFR").alias("population"), F.lit("CCS-x").alias("assembly_type"), F.concat(F.lit("h1-"), t(n)).alias("contig_id"),
        F.when(n % 4 == 0, "n/a").otherwise(t(n)).alias("start"), F.when(n % 4 < 2, "x").otherwise(t(n + 77)).alias("end"), F.lit("direct").alias("orientation"), t(n * 2).alias("component_length"), text.alias("segments"), svs.alias("svs"),
    )


@query(
    "sample_normalize_explode",
    """WITH b AS (SELECT p_partkey AS n, concat('NA', p_partkey + 10000) AS sample, CASE WHEN p_partkey % 4 = 0 THEN -1 ELSE p_partkey END AS component_start,
        CASE WHEN p_partkey % 4 = 0 THEN -1 WHEN p_partkey % 4 = 1 THEN p_partkey + 6 ELSE p_partkey + 77 END AS component_end, CASE WHEN p_partkey % 3 = 0 THEN 'no_variant' ELSE 'inversion' END AS variant_type,
        CASE WHEN p_partkey % 3 = 0 THEN 'no_segment_chain' ELSE 'a|b' END AS variant_segment_chain, CASE WHEN p_partkey % 3 = 0 THEN -1 ELSE p_partkey + 5 END AS variant_end FROM part),
      g AS (SELECT n, unnest(CASE n % 5 WHEN 0 THEN ['single_label'] WHEN 1 THEN ['no_resolution'] WHEN 2 THEN ['no_value'] ELSE ['red', 'blue()', 'green', 'parse_error'] END) AS c FROM b)
      SELECT b.*, c AS segment_color, CASE c WHEN 'red' THEN b.n * 50 WHEN 'blue()' THEN b.n WHEN 'green' THEN b.n * 3 ELSE -1 END AS segment_start,
        CASE c WHEN 'red' THEN b.n * 50 + 100 WHEN 'blue()' THEN b.n + 9 WHEN 'green' THEN b.n * 3 + 6 ELSE -1 END AS segment_end, CASE c WHEN 'red' THEN 2 WHEN 'blue()' THEN 1 WHEN 'green' THEN 0 ELSE -1 END AS segment_support
      FROM b JOIN g ON b.n = g.n""",
)
def _(s):
    out = cleaning.flatten_segment_table(segment_rows(s))
    return out.select(
        F.col("row_id").alias("n"), "sample", "component_start", "component_end", "variant_type", "variant_segment_chain", "variant_end", "segment_color", "segment_start", "segment_end", "segment_support"
    )


@query(
    "contigs_to_reads",
    """WITH r AS (SELECT name, seq, len, unnest(CASE WHEN len < 1001 THEN range(2) ELSE range(len // 500) END) AS i FROM reads WHERE len >= 500)
      SELECT concat(name, '_read', i) AS name, md5(CASE WHEN len >= 1001 THEN substring(seq, i * 500 + 1, 500) WHEN i = 0 THEN substring(seq, 1, len // 2) ELSE substring(seq, len // 2 + 1) END) AS digest FROM r""",
)
def _(s):
    return cleaning.chop_sequences(s.reads.select("name", "seq")).select("name", F.md5("seq").alias("digest"))


@query(
    "split_on_gap_runs",
    """WITH RECURSIVE p AS (SELECT name, string_split(seq, '. ') AS parts FROM reads), c AS (SELECT name, generate_subscripts(parts, 1) - 1 AS i, CAST(length(unnest(parts)) AS BIGINT) AS l FROM p),
      w AS (SELECT name, i, l, l AS run, 0 AS block FROM c WHERE i = 0 UNION ALL
        SELECT c.name, c.i, c.l, CASE WHEN w.run > 300 THEN c.l ELSE w.run + c.l END, CASE WHEN w.run > 300 THEN w.block + 1 ELSE w.block END FROM w JOIN c ON c.name = w.name AND c.i = w.i + 1)
      SELECT name, block, CAST(i AS INTEGER) AS contig_no, l AS length FROM w""",
)
def _(s):
    return cleaning.split_blocks(s.reads.select("name", "seq"), 300, gap=r"\. ")


@query("merge_sorted_unique", "SELECT DISTINCT chrom, start_pos FROM (SELECT chrom, start_pos FROM aln UNION ALL SELECT chrom, start_pos FROM sv)")
def _(s):
    cols = ["chrom", "start_pos"]
    return cleaning.merge_unique([s.aln.select(*cols), s.sv.select(*cols)], cols)


@query(
    "symmetric_difference",
    """WITH a AS (SELECT DISTINCT chrom, start_pos FROM aln), b AS (SELECT DISTINCT chrom, start_pos FROM sv)
      SELECT *, 'a' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'b' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def _(s):
    return cleaning.symmetric_difference(s.aln, s.sv, ["chrom", "start_pos"])


@query("union_all", "SELECT chrom, start_pos, end_pos FROM aln UNION ALL SELECT chrom, start_pos, end_pos FROM regions")
def _(s):
    cols = ["chrom", "start_pos", "end_pos"]
    return union_all([s.aln.select(*cols), s.regions.select(*cols)])


@query("set_difference", "SELECT chrom, start_pos FROM aln EXCEPT SELECT chrom, start_pos FROM sv")
def _(s):
    return cleaning.set_difference(s.aln, s.sv, ["chrom", "start_pos"])


@query("intersect", "SELECT chrom, start_pos FROM aln INTERSECT SELECT chrom, start_pos FROM sv")
def _(s):
    return cleaning.shared_keys(s.aln, s.sv, ["chrom", "start_pos"])


@query("multi_key_sort", "SELECT cls, score, name FROM regions")
def _(s):
    return cleaning.multi_key_sort(s.regions.select("cls", "score", "name"), {"cls": True, "score": False, "name": True})

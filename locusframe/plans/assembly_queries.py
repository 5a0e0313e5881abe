"""Queries on assemblies: samples, breaks, regions of interest, completeness, annotation matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import strand_code
from ..operators import assemblies as asm
from ..operators import overlap, sweep
from ..operators.lineage import written_once
from .interval_queries import ASSEMBLY, ONE_SET, PER_ASSEMBLY, confident, islands_sql
from .registry import query

OVERLAPS = "a.chrom = b.chrom AND a.start_pos < b.end_pos AND b.start_pos < a.end_pos"
BP = "least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos)"


def skips(s):
    return s.samples.withColumn("skip", F.when(F.col("sample") == "S3", 1).otherwise(0))


# --- filters and samples ----------------------------------------------------


@query("filter_mapq", "SELECT * FROM aln WHERE mapq >= 20 AND mapq < 50")
def _(s):
    return asm.filter_mapq(s.aln, 20, 50)


@query("filter_chroms", "SELECT chrom, start_pos, end_pos, name FROM regions WHERE regexp_full_match(chrom, 'chr[1-3]')")
def _(s):
    return asm.filter_chroms(s.regions.select("chrom", "start_pos", "end_pos", "name"), "chr[1-3]$")


@query(
    "filter_flags",
    """SELECT * FROM (SELECT chrom, start_pos, contig, mapq, CASE WHEN strand = '-' THEN 16 ELSE 0 END + CASE WHEN tech = 'CLR' THEN 4 ELSE 0 END + CASE WHEN hap = 20 THEN 256 ELSE 0 END AS flag FROM aln)
      WHERE flag & 260 = 0 AND flag & 16 = 16 AND mapq >= 10""",
)
def _(s):
    bit = lambda test, n: F.when(F.expr(test), n).otherwise(0)
    flags = bit("strand = '-'", 16) + bit("tech = 'CLR'", 4) + bit("hap = 20", 256)
    rows = s.aln.select("chrom", "start_pos", "contig", "mapq", flags.alias("flag"))
    return asm.filter_flags(rows, 260, 16, 10)


@query("filter_length", "SELECT chrom, start_pos, end_pos, contig FROM aln WHERE end_pos - start_pos >= 400")
def _(s):
    return asm.filter_length(s.aln.select("chrom", "start_pos", "end_pos", "contig"), 400)


@query(
    "select_store_keys",
    """SELECT a.chrom, a.start_pos, a.end_pos, a.sample, a.tech, super_pop, sex FROM aln a JOIN samples s ON a.sample = s.sample
      WHERE s.sample <> 'S3' AND s.sample <> 'S6' AND sex = 'female' AND tech = 'HiFi'""",
)
def _(s):
    rows = s.aln.select("chrom", "start_pos", "end_pos", "sample", "tech")
    return asm.select_assemblies(rows, skips(s), sexes=["female"], techs=["HiFi"], exclude=["S6"])


@query(
    "prefer_tech",
    """WITH t AS (SELECT chrom, start_pos, sample, CASE WHEN sample IN ('S1', 'S2') THEN 'CLR' ELSE tech END AS tech FROM aln),
      k AS (SELECT sample, count(DISTINCT tech) AS n FROM t GROUP BY sample) SELECT t.* FROM t JOIN k ON t.sample = k.sample WHERE n = 1 OR tech = 'HiFi'""",
)
def _(s):
    rows = s.aln.withColumn("tech", F.when(F.col("sample").isin("S1", "S2"), "CLR").otherwise(F.col("tech"))).select("chrom", "start_pos", "sample", "tech")
    return asm.prefer_tech(rows, "HiFi")


@query(
    "build_alignment_table",
    """SELECT a.chrom, a.start_pos, a.end_pos, a.contig, a.mapq, CASE strand WHEN '+' THEN 1 ELSE -1 END AS strand, a.sample, a.tech, a.hap, super_pop, sex
      FROM aln a JOIN samples s ON a.sample = s.sample""",
)
def _(s):
    return asm.build_alignment_table(s.aln, s.samples, s.chroms)


@query("strand_code", "SELECT strand, CASE strand WHEN '+' THEN 1 WHEN '-' THEN -1 ELSE 0 END AS code, count(*) AS n FROM aln GROUP BY ALL")
def _(s):
    return s.aln.groupBy("strand", strand_code(F.col("strand")).alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query("sample_lookup", "SELECT c.chrom, c.pos, c.sample, sex, super_pop, population, family FROM calls c JOIN samples s ON c.sample = s.sample")
def _(s):
    return asm.with_sample(s.calls.select("chrom", "pos", "sample"), s.samples)


@query(
    "missing_samples",
    """WITH p AS (SELECT DISTINCT sample, CASE WHEN sample = 'S1' THEN 'HiFi' ELSE tech END AS platform FROM aln),
      w AS (SELECT sample, platform FROM samples JOIN (SELECT 'HiFi' AS platform UNION ALL SELECT 'CLR') ON platform = 'CLR' OR sex = 'female')
      SELECT sample, platform, 'missing' AS problem FROM w WHERE sample <> 'S3' AND (sample, platform) NOT IN (SELECT (sample, platform) FROM p)
      UNION ALL SELECT sample, platform, 'skipped' FROM w WHERE sample = 'S3' AND (sample, platform) IN (SELECT (sample, platform) FROM p)""",
)
def _(s):
    present = s.aln.withColumn("platform", F.when(F.col("sample") == "S1", "HiFi").otherwise(F.col("tech")))
    table = skips(s).withColumn("HiFi", (F.col("sex") == "female").cast("int")).withColumn("CLR", F.lit(1))
    return asm.consistency(present, table, ["HiFi", "CLR"])


@query("genomic_sort", "SELECT chrom, start_pos, end_pos, name FROM regions")
def _(s):
    return asm.genomic_sort(s.regions.select("chrom", "start_pos", "end_pos", "name"), numeric=True)


# --- breaks -----------------------------------------------------------------

GAPS = f"""{PER_ASSEMBLY}, gx AS (SELECT sample, tech, hap, chrom, end_pos AS start_pos, lead(start_pos) OVER (PARTITION BY sample, tech, hap, chrom ORDER BY start_pos) AS end_pos FROM pa
    UNION ALL SELECT sample, tech, hap, chrom, 0, min(start_pos) FROM pa GROUP BY ALL),
  gaps AS (SELECT sample, tech, hap, gx.chrom, start_pos, coalesce(end_pos, size) AS end_pos FROM gx JOIN chroms c ON gx.chrom = c.chrom WHERE coalesce(end_pos, size) > start_pos),
  win AS (SELECT chrom, w * 100 AS start_pos, least(w * 100 + 100, size) AS end_pos FROM (SELECT chrom, size, unnest(range(CAST(ceil(size / 100.0) AS BIGINT))) AS w FROM chroms)),
  bw AS (SELECT a.chrom, a.start_pos, a.end_pos, count(DISTINCT (sample, tech, hap)) FILTER (b.chrom IS NOT NULL) AS break_cov FROM win a LEFT JOIN gaps b ON {OVERLAPS} GROUP BY ALL)"""


@query("break_windows", f"WITH {GAPS} SELECT *, break_cov >= 26 AS is_break FROM bw")
def _(s):
    gaps = sweep.complement(confident(s), s.chroms, by=ASSEMBLY)
    return asm.break_windows(sweep.make_windows(s.chroms, 100), gaps, min_breaks=26)


@query(
    "break_regions",
    """WITH c AS (SELECT hap, chrom, start_pos, start_pos + CASE WHEN mapq < 40 AND end_pos - start_pos > 60 THEN 50 ELSE 10 END AS end_pos FROM aln), """
    + islands_sql("c", "hap, chrom", "pa").replace("'", "''")
    + f""", gx AS (SELECT hap, chrom, end_pos AS start_pos, lead(start_pos) OVER (PARTITION BY hap, chrom ORDER BY start_pos) AS end_pos FROM pa
        UNION ALL SELECT hap, chrom, 0, min(start_pos) FROM pa GROUP BY ALL),
      gaps AS (SELECT hap, gx.chrom, start_pos, coalesce(end_pos, size) AS end_pos FROM gx JOIN chroms c ON gx.chrom = c.chrom WHERE coalesce(end_pos, size) > start_pos),
      win AS (SELECT chrom, w * 50 AS start_pos, least(w * 50 + 50, size) AS end_pos FROM (SELECT chrom, size, unnest(range(CAST(ceil(size / 50.0) AS BIGINT))) AS w FROM chroms)),
      stable AS (SELECT a.chrom, a.start_pos, a.end_pos FROM win a LEFT JOIN gaps b ON {OVERLAPS} GROUP BY ALL HAVING count(DISTINCT hap) <= 1),
      cut AS (SELECT DISTINCT b.chrom, greatest(a.start_pos, b.start_pos) AS start_pos, least(a.end_pos, b.end_pos) AS end_pos FROM gaps b
        JOIN (SELECT * FROM win ANTI JOIN stable USING (chrom, start_pos)) a ON {OVERLAPS}),
      {islands_sql("cut", "chrom", "m")}
      SELECT chrom, start_pos, end_pos, concat(chrom, '-', start_pos, '-', end_pos - start_pos, '-H64') AS name FROM m""",
)
def _(s):
    rows = s.aln.withColumn("end_pos", F.expr("start_pos + CASE WHEN mapq < 40 AND end_pos - start_pos > 60 THEN 50 ELSE 10 END"))
    return asm.break_regions(rows, s.chroms, 50, ["hap"])


# --- regions of interest ----------------------------------------------------

ROI = f"""k AS (SELECT sample, tech, hap, a.name AS roi, a.start_pos AS rs, a.end_pos AS re, greatest(a.start_pos, b.start_pos) AS start_pos, least(a.end_pos, b.end_pos) AS end_pos, contig
    FROM roi a JOIN (SELECT * FROM aln WHERE mapq = 60) b ON {OVERLAPS}),
  base AS (SELECT DISTINCT sample, tech, hap, roi, rs, re FROM k),
  every AS (SELECT sample, tech, hap, roi, unnest(range(rs, re)) AS p, rs FROM base),
  per AS (SELECT sample, tech, hap, roi, p, count(*) AS n FROM (SELECT sample, tech, hap, roi, unnest(range(start_pos, end_pos)) AS p FROM k) GROUP BY ALL),
  lab AS (SELECT e.*, least(coalesce(n, 0), 2) AS kind FROM every e LEFT JOIN per USING (sample, tech, hap, roi, p)),
  runs AS (SELECT sample, tech, hap, roi, kind, min(p) AS block_start, count(*) AS block_length FROM
    (SELECT *, p - row_number() OVER (PARTITION BY sample, tech, hap, roi, kind ORDER BY p) AS grp FROM lab) GROUP BY sample, tech, hap, roi, kind, grp)"""


@query("roi_blocks", f"WITH {ROI} SELECT sample, tech, hap, roi, CASE kind WHEN 0 THEN 'gap' WHEN 1 THEN 'align' ELSE 'multi' END AS block_type, block_start, block_length FROM runs")
def _(s):
    return asm.roi_blocks(s.roi, s.aln.where("mapq = 60"))


ROI_STATS = f"""{ROI}, st AS (SELECT sample, tech, hap, roi, CAST(coalesce(sum(block_length) FILTER (kind > 0), 0) AS BIGINT) AS coverage_bp, CAST(coalesce(sum(block_length) FILTER (kind = 0), 0) AS BIGINT) AS delta,
    count(*) FILTER (kind = 0) AS num_gaps, coalesce(min(block_length) FILTER (kind = 0), 0) AS min_gap, coalesce(max(block_length) FILTER (kind = 0), 0) AS max_gap,
    CAST(coalesce(floor(avg(block_length) FILTER (kind = 0)), 0) AS BIGINT) AS avg_gap FROM runs GROUP BY ALL),
  ct AS (SELECT sample, tech, hap, roi, count(DISTINCT contig) AS contigs_count FROM k GROUP BY ALL),
  rs AS (SELECT st.*, contigs_count, round_even(coverage_bp / (coverage_bp + delta) * 100, 2) AS coverage_pct FROM st JOIN ct USING (sample, tech, hap, roi))"""


@query("roi_stats", f"WITH {ROI_STATS} SELECT * FROM rs")
def _(s):
    return asm.roi_stats(s.roi, s.aln.where("mapq = 60"))


@query(
    "roi_hit_classes",
    f"""WITH {ROI_STATS} SELECT roi, count(*) FILTER (coverage_pct > 99.999) AS complete, count(*) FILTER (coverage_pct > 0 AND coverage_pct < 99.999) AS partial,
      (SELECT count(*) FROM (SELECT DISTINCT sample, tech, hap FROM rs)) - count(*) + count(*) FILTER (coverage_pct < 0.0001) AS missing FROM rs GROUP BY roi""",
)
def _(s):
    return asm.roi_hit_classes(asm.roi_stats(s.roi, s.aln.where("mapq = 60")))


# --- alternative contigs and region sets ------------------------------------

ALT = f"""{ONE_SET.replace('mapq >= 50 AND mapq < 61', 'mapq >= 60')}, {islands_sql('c', 'sample, tech, hap, chrom', 'pa')},
  asms AS (SELECT DISTINCT sample, tech, hap FROM aln), bpc AS (SELECT sample, tech, hap, chrom, CAST(sum(end_pos - start_pos) AS BIGINT) AS bp FROM pa GROUP BY ALL),
  cc AS (SELECT sample, tech, hap, chrom, count(DISTINCT contig) AS contigs FROM aln WHERE mapq >= 60 GROUP BY ALL),
  alt AS (SELECT ch.chrom, size, asms.*, coalesce(bp, 0) AS bp, coalesce(contigs, 0) AS contigs, round_even(coalesce(bp, 0) / size * 100, 2) AS pct
    FROM chroms ch CROSS JOIN asms LEFT JOIN bpc USING (sample, tech, hap, chrom) LEFT JOIN cc USING (sample, tech, hap, chrom))"""


@query("alt_contig_coverage", f"WITH {ALT} SELECT * FROM alt")
def _(s):
    return asm.alt_coverage(s.aln, s.chroms, suffix="")


@query(
    "alt_coverage_thresholds",
    f"""WITH {ALT}, t AS (SELECT unnest([5, 6, 7]) AS threshold), x AS (SELECT threshold, chrom, size, count(*) AS n FROM t JOIN alt ON pct > threshold GROUP BY ALL)
      SELECT threshold, count(*) AS contigs, CAST(sum(size) AS BIGINT) AS bp, max(n) AS max_assemblies, quantile_cont(n, 0.5) AS median_assemblies FROM x GROUP BY threshold""",
)
def _(s):
    return asm.alt_thresholds(asm.alt_coverage(s.aln, s.chroms, suffix=""), (5, 6, 7))


@query(
    "alt_coverage_totals",
    f"""WITH {ALT} SELECT sample, tech, hap, CAST(sum(bp) AS BIGINT) AS total_alt_cov, round_even(sum(bp) / sum(size) * 100, 2) AS total_pct_cov, count(*) FILTER (pct > 50) AS num_alt_above50 FROM alt GROUP BY ALL""",
)
def _(s):
    return asm.alt_totals(asm.alt_coverage(s.aln, s.chroms, suffix=""))


@query(
    "concatenated_offsets",
    """WITH z AS (SELECT concat('chr', p_size % 22 + 1, '_', p_partkey, '_alt') AS chrom, p_partkey % 700 + 100 AS size, p_size % 22 + 1 AS rank FROM part)
      SELECT chrom, size, CAST(rank AS INTEGER) AS rank, CAST(sum(size) OVER w - size AS BIGINT) AS concat_start, CAST(sum(size) OVER w AS BIGINT) AS concat_end FROM z
      WINDOW w AS (ORDER BY rank, size DESC, chrom ROWS UNBOUNDED PRECEDING)""",
)
def _(s):
    sizes = s.sql("SELECT concat('chr', p_size % 22 + 1, '_', p_partkey, '_alt') AS chrom, p_partkey % 700 + 100 AS size FROM part")
    return asm.concat_offsets(sizes)


CLASSES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def region_cover(s):
    """Coverage of every region by each technology's alignments, the region class as the set."""
    rows = s.regions.select("chrom", "start_pos", "end_pos", "name", F.col("cls").alias("region_set"))
    both = asm.with_each(rows, s.aln.select("tech"))
    return overlap.coverage(both, s.aln, by=["tech", "chrom"])


COVER = f"""t60 AS (SELECT tech, chrom, start_pos, end_pos FROM aln), {islands_sql('t60', 'tech, chrom', 'm6')},
  cov AS (SELECT tech, name, cls, a.end_pos - a.start_pos AS length, CAST(coalesce((SELECT sum({BP}) FROM m6 b WHERE b.tech = t.tech AND {OVERLAPS}), 0) AS BIGINT) AS covered_bp, a.chrom, a.start_pos, a.end_pos
    FROM regions a CROSS JOIN (SELECT DISTINCT tech FROM aln) t)"""


@query(
    "region_set_coverage",
    f"""WITH {COVER} SELECT tech, {', '.join(f'''CAST(sum(covered_bp) FILTER (cls = '{c}') AS BIGINT) AS "{c}_bp_covered", round_even(sum(covered_bp) FILTER (cls = '{c}') / sum(length) FILTER (cls = '{c}') * 100, 2) AS "{c}_pct_covered"''' for c in CLASSES)}
      FROM cov GROUP BY tech""",
)
def _(s):
    return asm.region_set_coverage(region_cover(s), CLASSES, ["tech"])


LENGTHS = """len AS (SELECT cls, chrom, end_pos - start_pos AS l FROM regions),
  n5 AS (SELECT cls, max(l) FILTER (2 * c >= t) AS n50_length FROM (SELECT cls, l, sum(l) OVER (PARTITION BY cls ORDER BY l DESC) AS c, sum(l) OVER (PARTITION BY cls) AS t FROM len) GROUP BY cls),
  ls AS (SELECT len.cls, count(*) AS region_count, CAST(floor(avg(l)) AS BIGINT) AS mean_length, CAST(sum(l) AS BIGINT) AS total_length, '1-22' AS chroms,
    CAST(floor(quantile_cont(l, 0.5)) AS BIGINT) AS median_length, any_value(n50_length) AS n50_length FROM len JOIN n5 ON len.cls = n5.cls GROUP BY len.cls)"""


@query("region_length_summary", f"WITH {LENGTHS} SELECT * FROM ls")
def _(s):
    return asm.length_summary(s.regions, ["cls"])


@query(
    "region_length_remainders",
    f"""WITH {LENGTHS}, b AS (SELECT total_length AS t FROM ls WHERE cls = 'PROMO')
      SELECT cls, t - total_length AS remaining, round_even(t / total_length, 2) AS ratio FROM ls JOIN b ON cls <> 'PROMO'""",
)
def _(s):
    return asm.length_remainders(asm.length_summary(s.regions, ["cls"]), "cls", "PROMO")


FRACTIONS = f"""{PER_ASSEMBLY}, win AS (SELECT chrom, w * 2000 AS start_pos, least(w * 2000 + 2000, size) AS end_pos FROM (SELECT chrom, size, unnest(range(CAST(ceil(size / 2000.0) AS BIGINT))) AS w FROM chroms)),
  ov AS (SELECT sample, tech, hap, a.chrom, a.start_pos, a.end_pos, sum({BP}) AS bp FROM win a JOIN pa b ON {OVERLAPS} GROUP BY ALL),
  fr AS (SELECT sample, tech, hap, win.chrom, win.start_pos, win.end_pos, coalesce(bp, 0) AS cbp FROM win CROSS JOIN (SELECT DISTINCT sample, tech, hap FROM c) x
    LEFT JOIN ov USING (sample, tech, hap, chrom, start_pos, end_pos))"""


@query(
    "pseudo_read_density",
    f"""WITH {FRACTIONS}, g AS (SELECT chrom, start_pos, end_pos, tech, round_even(sum(cbp) / (count(*) * (end_pos - start_pos)), 3) AS mean_fraction, round(quantile_cont(cbp, 0.5) / (end_pos - start_pos), 6) AS median_fraction FROM fr GROUP BY chrom, start_pos, end_pos, tech)
      SELECT * FROM g WHERE mean_fraction > 0""",
)
def _(s):
    windows = asm.with_each(sweep.make_windows(s.chroms, 2000), confident(s).select(*ASSEMBLY))
    cov = overlap.covered_bp(windows, confident(s), by=[*ASSEMBLY, "chrom"])
    return asm.window_mean(cov).withColumn("median_fraction", F.round("median_fraction", 6))


# --- sequences and completeness ---------------------------------------------


def _n(b: str) -> str:
    return f"(length(seq) - length(replace(upper(seq), '{b}', '')))"


@query(
    "nucleotide_profile",
    f"""WITH p AS (SELECT name, {', '.join(f'{_n(b)} AS "bp_nuc{b}"' for b in 'ACGTN')}, length(seq) AS bp_length, (length(seq) - length(replace(seq, 'the', ''))) // 3 AS motif_count FROM reads)
      SELECT *, bp_length - "bp_nucA" - "bp_nucC" - "bp_nucG" - "bp_nucT" - "bp_nucN" AS "bp_nucX", round(("bp_nucA" + "bp_nucT") / bp_length, 9) AS "pct_nucAT",
        round(("bp_nucC" + "bp_nucG") / bp_length, 9) AS "pct_nucGC", round_even((("bp_nucC" + "bp_nucG") / bp_length + ("bp_nucA" + "bp_nucT") / bp_length) * 100, 2) AS accessible_pct FROM p""",
)
def _(s):
    out = asm.nuc_profile(s.reads.select("name", "seq"), motif="the").drop("seq")
    return out.withColumns({c: F.round(c, 9) for c in ("pct_nucAT", "pct_nucGC")})


@query(
    "region_sequences",
    """SELECT name AS chrom, start_pos, end_pos, md5(substring(seq, start_pos + 1, end_pos - start_pos)) AS digest
      FROM (SELECT name, seq, len // 5 AS start_pos, CAST(ceil(len * 0.9) AS BIGINT) AS end_pos FROM reads) WHERE end_pos > start_pos""",
)
def _(s):
    from ..operators.kmers import sequence_chunks

    length = F.length("seq").cast("long")
    regions = s.reads.select(F.col("name").alias("chrom"), F.floor(length / 5).alias("start_pos"), F.ceil(length * F.expr("0.9")).cast("long").alias("end_pos")).where("end_pos > start_pos")
    chunks = sequence_chunks(s.reads.select(F.col("name").alias("chrom"), "seq"), chunk=256)
    return asm.region_sequences(regions, chunks, 256).select("chrom", "start_pos", "end_pos", F.md5("seq").alias("digest"))


@query(
    "completeness",
    f"""WITH o AS (SELECT tech, a.chrom, a.start_pos, a.end_pos, a.name, sum({BP}) AS bp, any_value(score) / 10 AS acc FROM regions a JOIN aln b ON {OVERLAPS} GROUP BY ALL),
      f AS (SELECT *, round_even(bp / (end_pos - start_pos) * 100, 2) AS frac FROM o)
      SELECT tech, chrom, start_pos, end_pos, name, 'count' AS stat_type, CAST(bp AS DOUBLE) AS coverage FROM f UNION ALL SELECT tech, chrom, start_pos, end_pos, name, 'fraction', frac FROM f
      UNION ALL SELECT tech, chrom, start_pos, end_pos, name, 'accessible', round(100 - round_even(abs(acc - frac), 2), 6) FROM f""",
)
def _(s):
    pairs = overlap.overlap_join(s.regions.select("chrom", "start_pos", "end_pos", "name"), s.aln.select("chrom", "start_pos", "end_pos", "tech"))
    ovl = pairs.select("chrom", "start_pos", "end_pos", "name", F.col("tech_b").alias("tech"), F.col("bp").alias("coverage"))
    profile = s.regions.select("name", (F.col("score") / 10).alias("accessible_pct"))
    return asm.completeness(ovl, profile, ["tech"]).withColumn("coverage", F.round("coverage", 6))


@query(
    "read_completeness",
    """WITH o AS (SELECT r.name, sum(least(r.end_pos, t.end_pos) - greatest(r.start_pos, t.start_pos)) AS covered, CAST(sum((least(r.end_pos, t.end_pos) - greatest(r.start_pos, t.start_pos)) * CAST(depth AS DECIMAL(19, 2))) AS DOUBLE) AS total
        FROM roi r JOIN track t ON r.chrom = t.chrom AND r.start_pos < t.end_pos AND t.start_pos < r.end_pos WHERE depth <> 0 GROUP BY r.name),
      f AS (SELECT r.name, coalesce(covered, 0) AS c, round_even(coalesce(covered, 0) / (r.end_pos - r.start_pos) * 100, 2) AS frac, coalesce(total, 0) / (r.end_pos - r.start_pos) AS m0, coalesce(total / covered, 0) AS m FROM roi r LEFT JOIN o ON r.name = o.name)
      SELECT name, 'count' AS stat_type, CAST(c AS DOUBLE) AS coverage FROM f UNION ALL SELECT name, 'fraction', frac FROM f UNION ALL SELECT name, 'accessible', round(100 - round_even(abs(95.5 - frac), 2), 6) FROM f
      UNION ALL SELECT name, 'average', round(m0, 6) FROM f UNION ALL SELECT name, 'nz_avg', round(m, 6) FROM f""",
)
def _(s):
    profile = s.roi.select("name", F.lit(95.5).alias("accessible_pct"))
    out = asm.read_completeness(overlap.region_average(s.roi, s.track), profile)
    return out.select("name", "stat_type", F.round("coverage", 6).alias("coverage"))


SV = f"""q AS (SELECT * FROM aln), asms AS (SELECT DISTINCT tech, hap FROM aln),
  o AS (SELECT a.name, b.tech, b.hap, sum({BP}) AS bp FROM sv a JOIN q b ON {OVERLAPS} GROUP BY ALL),
  x AS (SELECT s.name, svtype, asms.tech, asms.hap, coalesce(bp, 0) AS bp, end_pos - start_pos AS svlen FROM sv s CROSS JOIN asms LEFT JOIN o ON o.name = s.name AND o.tech = asms.tech AND o.hap = asms.hap),
  r AS (SELECT *, CASE WHEN svtype = 'INS' THEN CASE WHEN bp > 0 THEN 100.0 ELSE 0.0 END ELSE round_even(bp / svlen * 100, 2) END AS ratio FROM x)"""


def sv_ratios(s):
    pairs = overlap.overlap_join(s.sv.select("chrom", "start_pos", "end_pos", "name"), s.aln.select("chrom", "start_pos", "end_pos", "tech", "hap"))
    bp = pairs.groupBy("name", F.col("tech_b").alias("platform"), F.col("hap_b").alias("hap")).agg(F.sum("bp").alias("bp_aln"))
    svs = s.sv.select("name", "svtype", (F.col("end_pos") - F.col("start_pos")).alias("svlen"))
    dense = asm.with_each(svs, s.aln.select(F.col("tech").alias("platform"), "hap"))
    return asm.sv_alignment_ratio(dense.join(bp, ["name", "platform", "hap"], "left").fillna(0, ["bp_aln"])).withColumnRenamed("name", "sv_id")


@query(
    "sv_support_summary",
    f"""WITH {SV}, p AS (SELECT name, svtype, tech, bool_and(ratio = 0) AS a, bool_or(ratio = 0) AS b, bool_and(ratio < 50) AS l FROM r GROUP BY ALL)
      SELECT svtype, coalesce(tech, 'any') AS platform, count(*) FILTER (a) AS missing, count(*) FILTER (b AND NOT a) AS partial, count(*) FILTER (l AND NOT a AND svtype = 'DEL') AS low_cov
      FROM p GROUP BY GROUPING SETS ((svtype, tech), (svtype))""",
)
def _(s):
    return asm.sv_support(sv_ratios(s))


@query(
    "sv_read_support",
    f"""WITH {SV}, p AS (SELECT name, svtype, tech, bool_or(CASE WHEN svtype = 'INS' THEN bp < CASE tech WHEN 'HiFi' THEN 10 ELSE 30 END ELSE ratio < 50 END) AS low FROM r GROUP BY ALL)
      SELECT svtype, tech AS platform, count(*) FILTER (low) AS low_cov FROM p GROUP BY ALL""",
)
def _(s):
    return asm.sv_read_support(sv_ratios(s).withColumn("depth", F.col("bp_aln")))


@query(
    "best_overlap_shift",
    """WITH seg AS (SELECT name AS segment, chrom, start_pos, start_pos + 1 + score % 30 AS end_pos FROM regions),
      al AS (SELECT chrom, start_pos, start_pos + 1 + (end_pos - start_pos) // 20 AS end_pos, mapq FROM aln),
      t AS (SELECT segment, chrom, 0 AS k, start_pos, end_pos FROM seg UNION ALL SELECT segment, chrom, 1, start_pos - (end_pos - start_pos) // 2, end_pos - (end_pos - start_pos) // 2 FROM seg
        UNION ALL SELECT segment, chrom, 2, start_pos + (end_pos - start_pos) // 2, end_pos + (end_pos - start_pos) // 2 FROM seg),
      o AS (SELECT segment, k, least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) AS bp, mapq, b.start_pos AS s, b.end_pos AS e FROM t a JOIN al b ON a.chrom = b.chrom AND a.start_pos < b.end_pos AND b.start_pos < a.end_pos),
      f AS (SELECT *, row_number() OVER (PARTITION BY segment, k ORDER BY bp DESC, s, e, mapq DESC) AS i FROM o), w AS (SELECT * FROM f WHERE i = 1),
      d AS (SELECT seg.segment, coalesce(x.mapq, CASE WHEN coalesce(y.bp, 0) > coalesce(z.bp, 0) THEN y.mapq ELSE z.mapq END) AS mapq, x.mapq AS direct
        FROM seg LEFT JOIN w x ON x.segment = seg.segment AND x.k = 0 LEFT JOIN w y ON y.segment = seg.segment AND y.k = 1 LEFT JOIN w z ON z.segment = seg.segment AND z.k = 2)
      SELECT segment, CASE WHEN direct IS NOT NULL THEN 1 WHEN mapq IS NOT NULL THEN 0 ELSE -1 END AS support, coalesce(mapq, -1) AS mapq FROM d""",
)
def _(s):
    """Short segments against the first bases of every alignment, so that some are hit only when moved and some never."""
    segments = s.regions.select(F.col("name").alias("segment"), "chrom", "start_pos", F.expr("start_pos + 1 + score % 30").alias("end_pos"))
    aln = s.aln.withColumn("end_pos", F.expr("start_pos + 1 + (end_pos - start_pos) div 20"))
    return asm.segment_concordance(segments, aln, by=["chrom"]).select("segment", "support", "mapq")


# --- alignment tables -------------------------------------------------------

CAS = """g AS (SELECT chrom, regexp_extract(contig, '(cluster[0-9]+)', 1) AS grp, end_pos - start_pos AS l, mapq FROM aln), refs AS (SELECT CASE WHEN chrom IN ('chr4', 'chr5') THEN 'chr4chr5' ELSE chrom END AS ref, chrom, size FROM chroms),
  rz AS (SELECT chrom AS ref, size AS ref_length FROM chroms UNION ALL SELECT 'chr4chr5', sum(size) FROM chroms WHERE chrom IN ('chr4', 'chr5') UNION ALL SELECT 'genome', sum(size) FROM chroms),
  gz AS (SELECT coalesce(grp, 'genome') AS grp, sum(l) * 3 AS gsize FROM g GROUP BY ROLLUP (grp)),
  b AS (SELECT ref, grp, sum(l) AS bp FROM g JOIN refs ON g.chrom = refs.chrom WHERE mapq >= 20 GROUP BY ALL),
  rows AS (SELECT * FROM b UNION ALL SELECT 'genome', coalesce(grp, 'genome'), sum(bp) FROM b GROUP BY ROLLUP (grp)),
  cells AS (SELECT rows.ref, ref_length, rows.grp, bp, concat(CAST(bp AS BIGINT), '|', round_even(bp / gsize * 100, 2), '|', round_even(bp / ref_length * 100, 2)) AS cell,
    row_number() OVER (PARTITION BY rows.ref ORDER BY bp DESC, rows.grp <> 'genome', rows.grp) AS k FROM rows JOIN rz ON rows.ref = rz.ref JOIN gz ON rows.grp = gz.grp)"""
GROUPS = [f"cluster{i}" for i in range(10)]


def alignment_table(s):
    contigs = s.aln.groupBy("contig").agg((F.sum(F.col("end_pos") - F.col("start_pos")) * 3).alias("size"))
    return asm.contig_alignment_table(asm.contig_alignment_stats(s.aln, s.chroms, contigs, combine=["chr4", "chr5"], min_mapq=20), GROUPS)


def _cas_sql() -> str:
    tops = ", ".join(f"coalesce(max(grp || '|' || cell) FILTER (k = {i} AND (cells.ref <> 'genome' OR k = 1)), 'NA') AS top{i}_alignment" for i in (1, 2, 3))
    per = ", ".join(f"coalesce(max(cell) FILTER (grp = '{g}'), 'NA') AS {g}" for g in GROUPS)
    return f"tab AS (SELECT rz.ref, CAST(rz.ref_length AS BIGINT) AS ref_length, {tops}, {per} FROM rz LEFT JOIN cells ON rz.ref = cells.ref GROUP BY ALL)"


@query("contig_alignment_stats", f"WITH {CAS}, {_cas_sql()} SELECT * FROM tab")
def _(s):
    return alignment_table(s)


@query(
    "split_packed_fields",
    f"""WITH {CAS}, {_cas_sql()} SELECT ref, CASE WHEN top2_alignment = 'NA' THEN 'no_align' ELSE split_part(top2_alignment, '|', 1) END AS "group",
      CASE WHEN top2_alignment = 'NA' THEN 0 ELSE CAST(split_part(top2_alignment, '|', 2) AS BIGINT) END AS aligned_bp,
      CASE WHEN top2_alignment = 'NA' THEN 0.0 ELSE CAST(split_part(top2_alignment, '|', 3) AS DOUBLE) END AS group_pct,
      CASE WHEN top2_alignment = 'NA' THEN 0.0 ELSE CAST(split_part(top2_alignment, '|', 4) AS DOUBLE) END AS ref_pct FROM tab""",
)
def _(s):
    return asm.unpack_top(alignment_table(s), "top2_alignment").select("ref", "group", "aligned_bp", "group_pct", "ref_pct")


# --- matrices ---------------------------------------------------------------


def matrix_parts(s):
    region = s.regions.select("chrom", "start_pos", "end_pos", "name")
    marks = s.sv.withColumn("end_pos", F.col("start_pos") + 10 + F.col("num_samples") * 10)
    read, depth = overlap.track_events(s.track)
    # one sweep for all coverages, read by each group of features
    swept = written_once(overlap.areas(region, {"aligned": overlap.island_events(s.aln), "marked": overlap.island_events(marks), "covered": read, "total": depth}))
    size = F.col("end_pos") - F.col("start_pos")
    cover = lambda c: swept.select(*region.columns, F.col(c).alias("covered_bp"), (F.col(c) / size).alias("fraction"))
    total = F.col("total").cast("double")
    avg = swept.select(*region.columns, "covered", (total / size).alias("mean0"), F.coalesce(F.try_divide(total, F.col("covered")), F.lit(0.0)).alias("mean"))
    scores = overlap.map_mean(region, s.sv.withColumn("score", F.col("num_samples") * 100), min_frac=0.25)
    profile = asm.nuc_profile(region.withColumn("seq", F.col("name")))
    lit = F.lit
    return [
        asm.coverage_features(cover("aligned"), lit("S1"), lit("HiFi"), lit(10), lit("contig")),
        asm.coverage_features(cover("marked"), lit("REF1"), lit("REF"), lit(0), lit("DEL")),
        asm.score_features(scores, lit("REF1"), lit("segdups")),
        asm.read_features(avg, lit("S1"), lit("HiFi"), lit(1)),
        asm.nuc_features(profile, lit("REF1")).where("statistic in ('nucN', 'length')"),
    ]


LABELS = {
    "S1_HiFi_10_contig_bp_coverage": "coalesce(h.bp, 0)",
    "S1_HiFi_10_contig_pct_coverage": "coalesce(h.bp, 0) / (a.end_pos - a.start_pos)",
    "REF1_REF_0_DEL_bp_coverage": "coalesce(d.bp, 0)",
    "REF1_REF_0_DEL_pct_coverage": "coalesce(d.bp, 0) / (a.end_pos - a.start_pos)",
    "REF1_REF_0_segdups_pct_seqid": "coalesce(round(sc.m, 3), 0) / 1000",
    "S1_HiFi_1_read_cov_bp_coverage": "coalesce(t.c, 0)",
    "S1_HiFi_1_read_cov_avg_depth": "coalesce(t.tot, 0) / (a.end_pos - a.start_pos)",
    "S1_HiFi_1_read_cov_avg_nzdepth": "coalesce(t.tot / t.c, 0)",
    "REF1_REF_0_nucprof_bp_length": "length(a.name)",
    "REF1_REF_0_nucprof_bp_nucN": "0",
    "REF1_REF_0_nucprof_pct_nucN": "0",
}
MATRIX = f"""hs AS (SELECT chrom, start_pos, end_pos FROM aln), {islands_sql('hs', 'chrom', 'hm')}, ds AS (SELECT chrom, start_pos, start_pos + 10 + num_samples * 10 AS end_pos FROM sv), {islands_sql('ds', 'chrom', 'dm')},
  h AS (SELECT a.name, sum({BP}) AS bp FROM regions a JOIN hm b ON {OVERLAPS} GROUP BY a.name), d AS (SELECT a.name, sum({BP}) AS bp FROM regions a JOIN dm b ON {OVERLAPS} GROUP BY a.name),
  sc AS (SELECT a.name, avg(num_samples * 100) AS m FROM regions a JOIN sv b ON {OVERLAPS} WHERE {BP} >= 0.25 * (a.end_pos - a.start_pos) GROUP BY a.name),
  t AS (SELECT a.name, sum({BP}) AS c, CAST(sum(({BP}) * CAST(depth AS DECIMAL(19, 2))) AS DOUBLE) AS tot FROM regions a JOIN track b ON {OVERLAPS} WHERE depth <> 0 GROUP BY a.name),
  mx AS (SELECT a.chrom, a.start_pos, a.end_pos, a.name, {', '.join(f'round(CAST({e} AS DOUBLE), 6) AS "{n}"' for n, e in LABELS.items())}
    FROM regions a LEFT JOIN h ON a.name = h.name LEFT JOIN d ON a.name = d.name LEFT JOIN sc ON a.name = sc.name LEFT JOIN t ON a.name = t.name)"""


def matrix(s):
    out = asm.annotation_matrix(matrix_parts(s), list(LABELS))
    return out.withColumns({c: F.round(c, 6) for c in LABELS})


@query("annotation_matrix", f"WITH {MATRIX} SELECT * FROM mx")
def _(s):
    return matrix(s)


H, D, R = "S1_HiFi_10_contig_pct_coverage", "REF1_REF_0_DEL_pct_coverage", "REF1_REF_0_segdups_pct_seqid"


@query("membership_counts", f'WITH {MATRIX} SELECT "{H}" > 0.2 AS covered, "{D}" > 0.2 AS deleted, "{R}" > 0.2 AS segdup, count(*) AS n FROM mx GROUP BY ALL')
def _(s):
    return asm.membership_counts(matrix(s), {"covered": F.col(H) > 0.2, "deleted": F.col(D) > 0.2, "segdup": F.col(R) > 0.2})


@query(
    "priority_filter",
    f"""WITH {MATRIX}, f AS (SELECT *, CASE WHEN "{R}" > 0.1 THEN 1 WHEN "{D}" > 0.1 THEN 2 WHEN "{H}" > 0.1 THEN 3 END AS k FROM mx)
      {' UNION ALL '.join(f'''SELECT '{c}' AS selector, count(*) FILTER ("{c}" > 0.1) AS raw, count(*) FILTER (k = {i}) AS prio_filtered, round_even(count(*) FILTER (k = {i}) / count(*) * 100, 2) AS pct FROM f''' for i, c in ((1, R), (2, D), (3, H)))}""",
)
def _(s):
    return asm.priority_filter(matrix(s), [R, D, H])


@query(
    "pairwise_class",
    """WITH x AS (SELECT DISTINCT sample, tech, hap FROM aln), p AS (SELECT a.sample AS sample_a, a.tech AS tech_a, a.hap AS hap_a, b.sample AS sample_b, b.tech AS tech_b, b.hap AS hap_b FROM x a JOIN x b
        ON concat(a.sample, a.tech, a.hap) < concat(b.sample, b.tech, b.hap))
      SELECT p.*, f.family AS family_a, g.family AS family_b, CASE WHEN sample_a = sample_b AND hap_a <> hap_b THEN 4 WHEN sample_a <> sample_b AND f.family = g.family THEN 2 WHEN sample_a = sample_b AND tech_a <> tech_b THEN 1 ELSE 3 END AS comparison
      FROM p JOIN samples f ON f.sample = sample_a JOIN samples g ON g.sample = sample_b""",
)
def _(s):
    keyed = s.aln.select(*ASSEMBLY).distinct().withColumn("key", F.concat("sample", "tech", F.col("hap").cast("string")))
    return asm.label_pairs(overlap.pair_combinations(keyed, "key", ASSEMBLY).drop("key_a", "key_b"), s.samples)


REPORT = "rep AS (SELECT tech, sample, hap, CAST(sum(end_pos - start_pos) AS BIGINT) AS total, max(end_pos - start_pos) * 100 + count(*) AS n50 FROM aln WHERE l_ok GROUP BY ALL)".replace(" WHERE l_ok", "")


def report(s):
    length = F.col("end_pos") - F.col("start_pos")
    return s.aln.groupBy("tech", "sample", "hap").agg(F.sum(length).alias("total"), (F.max(length) * 100 + F.count(F.lit(1))).alias("n50"))


@query(
    "assembly_report_summary",
    f"""WITH {REPORT} SELECT tech, round_even(avg(total), 1) AS mean_total, round_even(avg(n50), 1) AS mean_n50, round_even(quantile_cont(total, 0.5), 1) AS median_total, round_even(quantile_cont(n50, 0.5), 1) AS median_n50,
      round_even(avg(CASE WHEN n50 > 51300 THEN 1 ELSE 0 END) * 100, 1) AS pct_n50_above_51300, round_even(avg(CASE WHEN n50 > 52500 THEN 1 ELSE 0 END) * 100, 1) AS pct_n50_above_52500 FROM rep GROUP BY tech""",
)
def _(s):
    return asm.report_summary(report(s), "tech", ["total", "n50"], limits=(51300, 52500))


@query(
    "assembly_report_tests",
    f"""WITH {REPORT}, m AS (SELECT count(*) FILTER (tech = 'HiFi') AS na, count(*) FILTER (tech = 'CLR') AS nb, avg(n50) FILTER (tech = 'HiFi') AS ma, avg(n50) FILTER (tech = 'CLR') AS mb,
        var_samp(n50) FILTER (tech = 'HiFi') AS va, var_samp(n50) FILTER (tech = 'CLR') AS vb FROM rep)
      SELECT round((ma - mb) / sqrt(va / na + vb / nb), 6) AS welch_t, round(pow(va / na + vb / nb, 2) / (pow(va / na, 2) / (na - 1) + pow(vb / nb, 2) / (nb - 1)), 6) AS welch_df,
        round(((na + nb - 2) * ln(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)) - (na - 1) * ln(va) - (nb - 1) * ln(vb)) / (1 + (1 / (na - 1) + 1 / (nb - 1) - 1 / (na + nb - 2)) / 3), 6) AS bartlett FROM m""",
)
def _(s):
    out = asm.two_sample_tests(report(s), "tech", "HiFi", "CLR", "n50")
    return out.select(*[F.round(c, 6).alias(c) for c in ("welch_t", "welch_df", "bartlett")])


@query(
    "completeness_means",
    f"""WITH o AS (SELECT tech, a.chrom, a.start_pos, a.end_pos, a.name, a.cls, sum({BP}) AS bp, any_value(score) / 10 AS acc FROM regions a JOIN aln b ON {OVERLAPS} GROUP BY ALL),
      f AS (SELECT *, round_even(bp / (end_pos - start_pos) * 100, 2) AS frac FROM o)
      SELECT cls AS region_type, tech, 'count' AS stat_type, round(avg(bp), 4) AS mean_coverage, count(*) AS regions FROM f GROUP BY ALL
      UNION ALL SELECT cls, tech, 'fraction', round(avg(frac), 4), count(*) FROM f GROUP BY ALL
      UNION ALL SELECT cls, tech, 'accessible', round(avg(100 - round_even(abs(acc - frac), 2)), 4), count(*) FROM f GROUP BY ALL""",
)
def _(s):
    pairs = overlap.overlap_join(s.regions.select("chrom", "start_pos", "end_pos", "name"), s.aln.select("chrom", "start_pos", "end_pos", "tech"))
    ovl = pairs.select("chrom", "start_pos", "end_pos", "name", F.col("tech_b").alias("tech"), F.col("bp").alias("coverage"))
    profile = s.regions.select("name", (F.col("score") / 10).alias("accessible_pct"))
    stats = asm.completeness(ovl, profile, ["tech"]).join(s.regions.select("name", "cls"), "name")
    return asm.completeness_means(stats, F.col("cls"), ["tech"]).withColumn("mean_coverage", F.round("mean_coverage", 4))

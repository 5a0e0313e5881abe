"""Queries on reads, haplotags, k-mers and length distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import distribution, kmers, reads
from ..operators.lineage import written_once
from ..operators.sweep import union_all
from .registry import query

HIST = "h AS (SELECT CAST(length(seq) AS BIGINT) AS length, count(*) AS n FROM reads GROUP BY 1)"
LETTERS = ["A", "C", "G", "T", "a", "c", "g", "t", "N", "n"]


def _letter(b: str) -> str:
    return f"(length(seq) - length(replace(seq, '{b}', '')))"


def _label(b: str) -> str:
    return f"lower_{b}" if b.islower() else b


@query(
    "read_statistics",
    f"""WITH p AS (SELECT length(seq) AS len, {', '.join(f'{_letter(b)} AS "x{_label(b)}"' for b in LETTERS)}, round_even(({_letter('G')} + {_letter('C')}) / length(seq), 3) AS gc FROM reads)
      SELECT 'length' AS kind, CAST(len AS VARCHAR) AS key, count(*) AS n FROM p GROUP BY len
      UNION ALL SELECT 'gc_bin', CAST(CAST(least(floor(gc * 100 + 1e-9), 99) + 1 AS BIGINT) AS VARCHAR), count(*) FROM p GROUP BY ALL
      UNION ALL SELECT 'reads', 'all', count(*) FROM p
      {' '.join(f'''UNION ALL SELECT 'base', '{_label(b)}', CAST(sum("x{_label(b)}") AS BIGINT) FROM p''' for b in LETTERS)}
      UNION ALL SELECT 'base', 'other', CAST(sum(len - {' - '.join(f'"x{_label(b)}"' for b in LETTERS)}) AS BIGINT) FROM p""",
)
def _(s):
    return reads.read_statistics(s.reads)


def _summary_sql(genome: int) -> str:
    steps = lambda numbers: " ".join(
        f"UNION ALL SELECT 'cov_geq_{x}', round_even(coalesce((SELECT sum(length * n) FROM h WHERE length >= {x}), 0) / {genome}.0, 2) FROM t" for x in numbers
    )
    return f"""{HIST}, t AS (SELECT sum(n) AS reads, sum(length * n) AS bp, min(length) AS lo, max(length) AS hi FROM h),
      c AS (SELECT length, sum(n) OVER (ORDER BY length DESC) AS cn, sum(length * n) OVER (ORDER BY length DESC) AS cb FROM h),
      summary AS (SELECT 'num_reads' AS key, CAST(reads AS DOUBLE) AS value FROM t
      UNION ALL SELECT 'total_seq_bp', bp FROM t UNION ALL SELECT 'total_seq_Gbp', round_even(bp / 1e9, 2) FROM t
      UNION ALL SELECT 'genome_size_bp', {genome} UNION ALL SELECT 'genome_size_Gbp', round_even({genome} / 1e9, 2)
      UNION ALL SELECT 'read_length_min', lo FROM t UNION ALL SELECT 'read_length_max', hi FROM t
      UNION ALL SELECT 'read_length_mean', floor(bp / reads) FROM t
      UNION ALL SELECT 'read_length_median', min(length) FROM c JOIN t ON 2 * cn <= reads
      UNION ALL SELECT 'read_length_N50', min(length) FROM c JOIN t ON 2 * cb <= bp
      UNION ALL SELECT 'cov_total', round_even(bp / {genome}.0, 2) FROM t {steps(reads.LONG_READ_STEPS)})"""


@query("read_summary", f"WITH {_summary_sql(100000)} SELECT * FROM summary")
def _(s):
    return reads.read_summary(reads.length_histogram(s.reads), 100_000)


@query(
    "pick_min_length",
    f"""WITH {_summary_sql(100000)}, g AS (SELECT CAST(replace(key, 'cov_geq_', '') AS BIGINT) AS len, value FROM summary WHERE key LIKE 'cov_geq_%')
      SELECT arg_min(len, abs(round_even(value - 15, 1)) * 1000000 + len) AS min_read_length FROM g""",
)
def _(s):
    return reads.pick_min_length(reads.read_summary(reads.length_histogram(s.reads), 100_000), 15)


@query(
    "cumulative_bases",
    """WITH h AS (SELECT lib, least(CAST(len AS BIGINT), 100000) AS pooled, sum(CAST(len AS BIGINT)) AS bp FROM reads GROUP BY ALL),
      k AS (SELECT DISTINCT lib, unnest(range(0, 100500, 500)) AS min_length FROM reads)
      SELECT k.lib, k.min_length, CAST(coalesce(sum(bp), 0) AS BIGINT) AS bp FROM k LEFT JOIN h ON k.lib = h.lib AND h.pooled >= k.min_length GROUP BY ALL""",
)
def _(s):
    return reads.bases_at_least(reads.length_histogram(s.reads, ["lib"]), ["lib"])


@query(
    "read_length_bins",
    f"""WITH {HIST}, b AS (SELECT unnest([0, 500, 1500, 2500, 3500, 4500, 5500]) AS lower, unnest([500, 1500, 2500, 3500, 4500, 5500, 1000000000]) AS upper),
      q AS (SELECT length, sum(n) OVER (ORDER BY length) / (SELECT sum(n) FROM h) AS share FROM h)
      SELECT CAST(lower AS VARCHAR) AS item, CAST(coalesce(sum(length * n), 0) AS BIGINT) AS bp, CAST(coalesce(sum(n), 0) AS BIGINT) AS reads
      FROM b LEFT JOIN h ON length >= lower AND length < upper GROUP BY lower
      UNION ALL SELECT 'p25', min(length), 0 FROM q WHERE share > 0.25 UNION ALL SELECT 'p50', min(length), 0 FROM q WHERE share > 0.5
      UNION ALL SELECT 'p75', min(length), 0 FROM q WHERE share > 0.75 UNION ALL SELECT 'p95', min(length), 0 FROM q WHERE share > 0.95""",
)
def _(s):
    hist = reads.length_histogram(s.reads)
    bins = reads.read_length_bins(hist, 500, 5500, 1000).select(F.col("lower").cast("string").alias("item"), "bp", "reads")
    marks = reads.length_percentiles(hist)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).alias("bp")) for c in marks.columns])).alias("r")
    return bins.unionByName(marks.select(pairs).select("r.item", "r.bp", F.lit(0).cast("long").alias("reads")))


@query(
    "mark_duplicates",
    """SELECT chrom, start_pos, strand, count(*) AS n_rows, CAST(sum(CASE WHEN rk > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_duplicates
      FROM (SELECT *, rank() OVER (PARTITION BY chrom, start_pos, strand ORDER BY mapq DESC, contig, end_pos) AS rk
            FROM (SELECT DISTINCT chrom, start_pos, end_pos, strand, mapq, contig FROM aln)) GROUP BY ALL""",
)
def _(s):
    rows = s.aln.select("chrom", "start_pos", "end_pos", "strand", "mapq", "contig").distinct()
    rows = rows.withColumn("ident", F.struct("contig", "end_pos"))
    marked = reads.mark_duplicates(rows, ["chrom", "start_pos", "strand"], "mapq", "ident")
    return marked.groupBy("chrom", "start_pos", "strand").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("duplicate").cast("int")).alias("n_duplicates")
    )


@query(
    "coverage_histogram_stats",
    """WITH hist AS (SELECT tech AS seq, d AS depth, bp FROM (SELECT tech, mapq + 1 AS d, sum(end_pos - start_pos) AS bp FROM aln GROUP BY ALL)),
      len AS (SELECT seq, sum(bp) * 2 AS length FROM hist GROUP BY seq),
      x AS (SELECT len.seq, any_value(length) AS length, sum(depth * bp) / any_value(length) AS m, sum(depth * depth * bp) / any_value(length) AS m2, sum(bp) AS covered
            FROM len JOIN hist ON len.seq = hist.seq GROUP BY len.seq),
      per AS (SELECT seq, CAST(length AS BIGINT) AS length, round_even(m, 2) AS cov_mean, round_even(sqrt(m2 - m * m), 2) AS cov_std,
        CAST(covered AS BIGINT) AS bp_nonzero, CAST(length - covered AS BIGINT) AS bp_zero FROM x),
      g AS (SELECT sum(length) AS length, sum(length * cov_mean) / sum(length) AS m, sum(length * cov_mean * cov_mean) / sum(length) AS m2, sum(bp_nonzero) AS nz, sum(bp_zero) AS z FROM per)
      SELECT *, CAST(least(greatest(round_even(cov_mean + 3 * cov_std, 0), 1), 200) AS BIGINT) AS depth_limit FROM per
      UNION ALL SELECT 'genome', CAST(length AS BIGINT), round_even(m, 2), round_even(sqrt(greatest(m2 - m * m, 0)), 2), CAST(nz AS BIGINT), CAST(NULL AS BIGINT),
        CAST(least(greatest(round_even(round_even(m, 2) + 3 * round_even(sqrt(greatest(m2 - m * m, 0)), 2), 0), 1), 200) AS BIGINT) FROM g""",
)
def _(s):
    hist = s.aln.groupBy(F.col("tech").alias("seq"), (F.col("mapq") + 1).alias("depth")).agg(F.sum(F.col("end_pos") - F.col("start_pos")).alias("count"))
    lengths = hist.groupBy("seq").agg((F.sum("count") * 2).alias("length"))
    per = reads.coverage_stats(hist, lengths)
    whole = reads.genome_wide_coverage(per).select(F.lit("genome").alias("seq"), "*", F.lit(None).cast("long").alias("bp_zero"))
    return per.unionByName(whole).withColumn("depth_limit", reads.caller_depth_limit(F.col("cov_mean"), F.col("cov_std")))


@query(
    "haplotag_summary",
    """WITH t AS (SELECT count(*) AS n, count(*) FILTER (haplotype = 'H1') AS a, count(*) FILTER (haplotype = 'H2') AS b, count(*) FILTER (haplotype = 'none') AS c FROM tags),
      twice AS (SELECT name, max(CASE haplotype WHEN 'H1' THEN 1 ELSE 0 END) AS h1, max(CASE haplotype WHEN 'H2' THEN 1 ELSE 0 END) AS h2,
                max(CASE haplotype WHEN 'none' THEN 1 ELSE 0 END) AS h0 FROM tags GROUP BY name)
      SELECT n AS num_reads, a AS num_hap1, b AS num_hap2, c AS num_untagged, round_even(a / n * 100, 2) AS percent_hap1, round_even(b / n * 100, 2) AS percent_hap2,
        round_even(c / n * 100, 2) AS percent_untagged, round_even(round_even(a / n * 100, 2) + round_even(b / n * 100, 2), 2) AS percent_tagged,
        (SELECT CAST(sum(h1 * h2) AS BIGINT) FROM twice) AS h1_h2, (SELECT CAST(sum(h1 * h0) AS BIGINT) FROM twice) AS h1_h0, (SELECT CAST(sum(h2 * h0) AS BIGINT) FROM twice) AS h2_h0 FROM t""",
)
def _(s):
    keyed = lambda df: df.withColumn("_k", F.lit(0))  # two one-row tables side by side
    return keyed(reads.haplotag_summary(s.tags)).join(keyed(reads.label_overlaps(s.tags)), "_k").drop("_k")


@query(
    "split_by_haplotag",
    """WITH z AS (SELECT chrom, phaseset, count(*) AS n FROM tags WHERE haplotype <> 'none' GROUP BY ALL),
      best AS (SELECT chrom, arg_max(phaseset, n * 1000 - phaseset) AS largest FROM z GROUP BY chrom),
      l AS (SELECT t.name, t.chrom, CASE WHEN phaseset = largest THEN haplotype ELSE 'none' END AS haplotype FROM tags t LEFT JOIN best b ON t.chrom = b.chrom)
      SELECT haplotype, CAST(len AS BIGINT) AS length, count(*) AS n FROM reads r JOIN l ON r.name = l.name GROUP BY ALL""",
)
def _(s):
    return reads.length_histogram(reads.split_by_haplotag(s.reads, s.tags), ["haplotype"])


@query(
    "sequence_duplicates",
    """WITH x AS (SELECT CASE WHEN colour < 3 THEN 'a' ELSE 'b' END AS side, sha256(seq) AS h, CAST(len AS BIGINT) AS len FROM reads),
      p AS (SELECT side, h, len, count(*) AS n FROM x GROUP BY ALL),
      m AS (SELECT p.*, EXISTS (SELECT 1 FROM p q WHERE q.h = p.h AND q.side <> p.side) AS shared FROM p)
      SELECT side, CAST(sum(n) AS BIGINT) AS sequences, count(*) AS distinct_sequences, CAST(sum(n) - count(*) AS BIGINT) AS duplicates,
        round_even(count(*) FILTER (shared) / count(*) * 100, 2) AS shared_pct, round_even(coalesce(sum(len) FILTER (shared), 0) / sum(len) * 100, 2) AS shared_bp_pct FROM m GROUP BY side""",
)
def _(s):
    return reads.sequence_overlap(s.reads.where("colour < 3"), s.reads.where("colour >= 3"))


@query(
    "sequence_copies",
    "SELECT name, copies FROM (SELECT name, count(*) OVER (PARTITION BY md5(seq)) AS copies FROM reads) WHERE copies > 1",
)
def _(s):
    return reads.duplicate_sequences(s.reads)


@query(
    "read_name_checks",
    """WITH a AS (SELECT contig AS name, count(*) AS n FROM aln WHERE tech = 'HiFi' GROUP BY 1), b AS (SELECT contig AS name, count(*) AS n FROM aln WHERE tech = 'CLR' GROUP BY 1)
      SELECT (SELECT CAST(sum(n) AS BIGINT) FROM a) AS reads_a, (SELECT CAST(sum(n) AS BIGINT) FROM b) AS reads_b, (SELECT CAST(sum(n - 1) AS BIGINT) FROM a) AS repeated_a,
        (SELECT CAST(sum(n - 1) AS BIGINT) FROM b) AS repeated_b, (SELECT count(*) FROM a JOIN b ON a.name = b.name) AS shared""",
)
def _(s):
    named = s.aln.withColumnRenamed("contig", "name")
    return reads.read_name_checks(named.where("tech = 'HiFi'"), named.where("tech = 'CLR'"))


@query("weighted_insert_mean", "SELECT sample, tech, round(sum((end_pos - start_pos) * mapq) / sum(mapq), 6) AS mean_insert FROM aln GROUP BY ALL")
def _(s):
    rows = s.aln.withColumn("size", F.col("end_pos") - F.col("start_pos"))
    return reads.weighted_mean(rows, ["sample", "tech"], "size", "mapq", "mean_insert").withColumn("mean_insert", F.round("mean_insert", 6))


def _geq(n: int) -> str:
    return f"""UNION ALL SELECT 'sequence_bp_geq_{n}', coalesce(sum(len) FILTER (len >= {n}), 0) FROM p
      UNION ALL SELECT 'sequence_fraction_geq_{n}', round_even(coalesce(sum(len) FILTER (len >= {n}), 0) / sum(len), 3) FROM p"""


@query(
    "squashed_assembly_stats",
    f"""WITH p AS (SELECT len, {', '.join(f'{_letter(b)} AS "{b}"' for b in 'ACGTN')} FROM reads)
      SELECT 'sequence_bp_total' AS key, CAST(sum(len) AS DOUBLE) AS value FROM p
      {' '.join(f'''UNION ALL SELECT 'nucleotide_fraction_{b}', round_even(sum("{b}") / sum("A" + "C" + "G" + "T" + "N"), 3) FROM p''' for b in 'ACGT')}
      {_geq(1500)} {_geq(3000)} {_geq(6000)}""",
)
def _(s):
    return reads.assembly_size_stats(s.reads, 3000)


@query(
    "squashed_assembly_regions",
    """WITH c AS (SELECT name, CAST(len AS BIGINT) AS size, CAST(len // 700 AS BIGINT) AS q, CAST(len % 700 AS BIGINT) AS r FROM reads WHERE len >= 700),
      e AS (SELECT *, CASE WHEN r < 350 THEN q - 1 ELSE q END AS last, unnest(range(0, CASE WHEN r < 350 THEN q ELSE q + 1 END)) AS i FROM c)
      SELECT name AS chrom, i * 700 AS start_pos, CASE WHEN i = last THEN size ELSE (i + 1) * 700 END AS end_pos FROM e""",
)
def _(s):
    return reads.size_regions(s.reads.select(F.col("name").alias("chrom"), F.length("seq").cast("long").alias("size")), 700)


# --- distributions ----------------------------------------------------------


@query(
    "describe_by",
    """SELECT sample, tech, count(*) AS "count", round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, min(x) AS "min", max(x) AS "max",
      quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS q50, quantile_cont(x, 0.75) AS q75
      FROM (SELECT sample, tech, end_pos - start_pos AS x FROM aln) GROUP BY ALL""",
)
def _(s):
    rows = s.aln.withColumn("x", F.col("end_pos") - F.col("start_pos"))
    out = distribution.describe_by(rows, ["sample", "tech"], "x")
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


N50_SQL = """SELECT lib, {pick} AS n50 FROM (SELECT lib, length, sum(length * n) OVER (PARTITION BY lib ORDER BY length DESC) AS c, sum(length * n) OVER (PARTITION BY lib) AS t
  FROM (SELECT lib, CAST(len AS BIGINT) AS length, count(*) AS n FROM reads GROUP BY ALL)) GROUP BY lib"""


@query("n50", N50_SQL.format(pick="max(length) FILTER (2 * c >= t)"))
def _(s):
    return distribution.n50(s.reads.withColumn("length", F.length("seq").cast("long")), ["lib"], "length")


@query("n50_below_half", N50_SQL.format(pick="min(length) FILTER (2 * c <= t)"))
def _(s):
    return distribution.n50(s.reads.withColumn("length", F.length("seq").cast("long")), ["lib"], "length", "below_half")


@query(
    "running_total",
    """SELECT tech, length, n, CAST(sum(n) OVER w AS BIGINT) AS cum_n, CAST(sum(length * n) OVER w AS BIGINT) AS cum_bp
      FROM (SELECT tech, end_pos - start_pos AS length, count(*) AS n FROM aln GROUP BY ALL) WINDOW w AS (PARTITION BY tech ORDER BY length DESC)""",
)
def _(s):
    rows = s.aln.withColumn("length", F.col("end_pos") - F.col("start_pos"))
    return distribution.running_total(rows, ["tech"], "length")


@query(
    "pct_rank_desc",
    "SELECT name, cls, score, cume_dist() OVER (PARTITION BY cls ORDER BY score DESC) AS pct_rank FROM regions",
)
def _(s):
    return distribution.pct_rank_desc(s.regions.select("name", "cls", "score"), ["cls"], "score")


@query(
    "first_per_key",
    "SELECT contig, chrom, start_pos, end_pos, mapq FROM (SELECT *, row_number() OVER (PARTITION BY contig ORDER BY mapq DESC, chrom, start_pos, end_pos) AS rn FROM aln) WHERE rn = 1",
)
def _(s):
    order = [F.desc("mapq"), F.asc("chrom"), F.asc("start_pos"), F.asc("end_pos")]
    rows = s.aln.select("contig", "chrom", "start_pos", "end_pos", "mapq")
    return distribution.first_per_key(rows, ["contig"], order)


@query(
    "top_n_per_group",
    """SELECT chrom, contig, bp, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY bp DESC, contig) AS rank
      FROM (SELECT chrom, contig, CAST(sum(end_pos - start_pos) AS BIGINT) AS bp FROM aln GROUP BY ALL)) WHERE rank <= 3""",
)
def _(s):
    sums = s.aln.groupBy("chrom", "contig").agg(F.sum(F.col("end_pos") - F.col("start_pos")).alias("bp"))
    return distribution.top_n_per_group(sums, ["chrom"], [F.desc("bp"), F.asc("contig")], 3)


# --- k-mers -----------------------------------------------------------------


def kmer_rows(k: int, cols: str = "colour", source: str = "reads") -> str:
    """CTE ``km`` with every k-mer of every text."""
    return f"""chars AS (SELECT {cols}, name AS nm, unnest(string_split(seq, '')) AS ch, generate_subscripts(string_split(seq, ''), 1) AS i FROM {source}),
      km AS (SELECT * FROM (SELECT {cols}, string_agg(ch, '') OVER w AS kmer, count(*) OVER w AS filled FROM chars
        WINDOW w AS (PARTITION BY nm ORDER BY i ROWS BETWEEN CURRENT ROW AND {k - 1} FOLLOWING)) WHERE filled = {k})"""


@query("kmer_count", f"WITH {kmer_rows(21)} SELECT n, count(*) AS kmers FROM (SELECT kmer, count(*) AS n FROM km GROUP BY kmer) GROUP BY n")
def _(s):
    return kmers.kmer_count(s.reads, 21).groupBy("n").agg(F.count(F.lit(1)).alias("kmers"))


@query(
    "kmer_union_sum",
    f"""WITH {kmer_rows(5)} SELECT kmer, count(*) AS n FROM km GROUP BY kmer""",
)
def _(s):
    a, b = (kmers.kmer_count(s.reads.where(f"colour % 2 = {c}"), 5) for c in (0, 1))
    return kmers.kmer_union_sum(a, b)


@query(
    "kmer_count_canonical",
    f"""WITH {kmer_rows(3)}, f AS (SELECT kmer, reverse(translate(kmer, 'ACGTacgt', 'TGCAtgca')) AS rc FROM km WHERE regexp_full_match(kmer, '[a-z]+'))
      SELECT least(kmer, rc) AS kmer, count(*) AS n FROM f GROUP BY 1""",
)
def _(s):
    return kmers.kmer_count(s.reads, 3, canonical_form=True, alphabet="a-z")


MASKS = f"""{kmer_rows(13)}, masks AS (SELECT kmer, bit_or(CAST(1 AS BIGINT) << CAST(colour AS BIGINT)) AS mask FROM km GROUP BY kmer),
  combos AS (SELECT array_to_string(list_filter(range(0, 6), lambda c: (mask >> c) & 1 = 1), '-') AS combination, count(*) AS n FROM masks GROUP BY 1)"""


@query("kmer_colours", f"WITH {MASKS} SELECT combination, n FROM combos")
def _(s):
    return kmers.kmer_colours(s.reads, 13)


FOLDED = "classes AS (SELECT CASE " + " ".join(
    f"WHEN combination IN ({', '.join(repr(x) for x in sets)}) THEN '{label}'" for label, sets in kmers.COLOUR_CLASSES.items()
) + f" ELSE '{kmers.OTHER_CLASS}' END AS kmer_class, CAST(sum(n) AS BIGINT) AS n FROM combos WHERE combination NOT LIKE '%5%' GROUP BY 1)"


@query("kmer_colour_classes", f"WITH {MASKS}, {FOLDED} SELECT * FROM classes")
def _(s):
    return kmers.fold_colours(kmers.kmer_colours(s.reads, 13))


@query(
    "kmer_qv",
    f"""WITH {MASKS}, {FOLDED}, x AS (SELECT sum(n) FILTER (kmer_class IN ('Hap1_only', 'Hap_only')) AS o,
        sum(n) FILTER (kmer_class IN ('Hap1_only', 'Hap_only', 'Illumina_only', 'Hap1_Illumina', 'Hap_Illumina', 'Hap1_GRCh38', 'Hap_GRCh38', 'GRCh38_Illumina', 'GRCh38_shared')) AS t FROM classes)
      SELECT CAST(o AS BIGINT) AS assembly_only, CAST(t AS BIGINT) AS total, round(1 - pow(1 - o / t, 1.0 / 13), 9) AS error_rate,
        round(-10 * log10(1 - pow(1 - o / t, 1.0 / 13)), 6) AS qv FROM x""",
)
def _(s):
    out = kmers.kmer_qv(kmers.fold_colours(kmers.kmer_colours(s.reads, 13)), 1, k=13)
    return out.withColumns({"error_rate": F.round("error_rate", 9), "qv": F.round("qv", 6)})


def _region_queries(s):
    """Reads posing as regions: their k-mers against the colours of all reads."""
    flags = kmers.kmer_query(s.reads, s.reads, 13, 0.2, kmers.COLOURS)
    kind = F.element_at(F.array(F.lit("PROM"), F.lit("ENH"), F.lit("CTCF")), (F.col("i") % 3 + 1).cast("int"))
    i = F.regexp_extract("name", "([0-9]+)$", 1).cast("long")
    flags = flags.withColumn("i", i)
    label = F.concat(kind, F.lit("_ENSR"), "i", F.lit("::chr"), (F.col("i") % 5 + 1).cast("string"), F.lit(":"), (F.col("i") * 100).cast("string"), F.lit("-"), (F.col("i") * 101 + 31).cast("string"))
    return flags.withColumn("query", label).drop("i", "name")


REGION_SQL = f"""{MASKS}, {kmer_rows(13, 'name').replace('chars', 'rchars').replace('km AS', 'rkm AS')},
  q AS (SELECT name, {', '.join(f'avg((coalesce(mask, 0) >> {c}) & 1) >= 0.2 AS "{n}"' for n, c in kmers.COLOURS.items())} FROM rkm LEFT JOIN masks ON rkm.kmer = masks.kmer GROUP BY name),
  f AS (SELECT r.name, CAST(replace(r.name, 'read', '') AS BIGINT) AS i, {', '.join(f'coalesce("{n}", false) AS "{n}"' for n in kmers.COLOURS)} FROM reads r LEFT JOIN q ON r.name = q.name)"""


@query("kmer_region_query", f"WITH {REGION_SQL} SELECT name, {', '.join(chr(34) + n + chr(34) for n in kmers.COLOURS)} FROM f")
def _(s):
    return kmers.kmer_query(s.reads, s.reads, 13, 0.2, kmers.COLOURS)


def _region_stats_sql() -> str:
    cols, pct = [], []
    for label, test in {"total": "true", **kmers.REGION_SELECTORS}.items():
        cols += [f"CAST(coalesce(sum(length) FILTER ({test}), 0) AS BIGINT) AS \"{label}_bp\"", f"count(*) FILTER ({test}) AS \"{label}_count\""]
        if label != "total":
            pct += [f"round_even(\"{label}_{u}\" / \"total_{u}\" * 100, 2) AS \"{label}_{u}_pct\"" for u in ("bp", "count")]
    return f"""WITH {REGION_SQL}, g AS (SELECT CASE i % 3 WHEN 0 THEN 'PROM' WHEN 1 THEN 'ENH' ELSE 'CTCF' END AS region_type, i + 31 AS length, * FROM f WHERE "GRCh38" AND NOT "chrM"),
      a AS (SELECT coalesce(region_type, 'total') AS region_type, {', '.join(cols)} FROM g GROUP BY ROLLUP (region_type))
      SELECT *, {', '.join(pct)} FROM a"""


@query("kmer_region_stats", _region_stats_sql())
def _(s):
    return kmers.kmer_region_stats(_region_queries(s))


@query(
    "attach_sequences",
    f"""WITH {REGION_SQL} SELECT CASE f.i % 3 WHEN 0 THEN 'PROM' WHEN 1 THEN 'ENH' ELSE 'CTCF' END || '_ENSR' || f.i AS name, concat('chr', f.i % 5 + 1) AS chrom,
      f.i * 100 AS start_pos, f.i * 101 + 31 AS end_pos, CASE WHEN f.i % 2 = 0 THEN md5(r.seq) END AS seq_md5
      FROM f JOIN reads r ON f.name = r.name WHERE "GRCh38" AND NOT "chrM" AND "hap1" AND "hap2" """,
)
def _(s):
    hits = kmers.selected_regions(_region_queries(s), "HapBoth")
    i = F.regexp_extract("name", "([0-9]+)$", 1).cast("long")
    seqs = s.reads.withColumn("i", i).select(
        F.element_at(F.array(F.lit("PROM"), F.lit("ENH"), F.lit("CTCF")), (F.col("i") % 3 + 1).cast("int")).alias("region_type"),
        F.concat(F.when(F.col("i") % 2 == 0, "ENSR").otherwise("OTHER"), F.col("i").cast("string")).alias("region_id"), F.concat(F.lit("chr"), (F.col("i") % 5 + 1).cast("string")).alias("chrom"),
        (F.col("i") * 100).alias("start_pos"), (F.col("i") * 101 + 31).alias("end_pos"), "seq",
    )
    return kmers.attach_sequences(hits, seqs).select("name", "chrom", "start_pos", "end_pos", F.md5("seq").alias("seq_md5"))


@query(
    "kmer_drop_counts",
    f"""WITH {REGION_SQL} SELECT count(*) AS raw_regions, count(*) FILTER ("chrM") AS "drop_chrM", count(*) FILTER (NOT "GRCh38") AS drop_ref_missing FROM f""",
)
def _(s):
    return kmers.kmer_drop_counts(_region_queries(s))


@query(
    "kmer_selected_regions",
    f"""WITH {REGION_SQL} """ + " UNION ALL ".join(f"""SELECT '{n}' AS selector, name FROM f WHERE "GRCh38" AND NOT "chrM" AND ({t})""" for n, t in kmers.REGION_SELECTORS.items()),
)
def _(s):
    """The regions of every selector."""
    flags = written_once(_region_queries(s))
    name = F.concat(F.lit("read"), F.regexp_extract("query", "ENSR([0-9]+)", 1))
    return union_all([kmers.selected_regions(flags, n).select(F.lit(n).alias("selector"), name.alias("name")) for n in kmers.REGION_SELECTORS])

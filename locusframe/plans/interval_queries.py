"""Queries on interval joins, sweeps, coverage and masks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import masks, overlap, sweep
from ..operators.lineage import written_once
from .registry import query

ASSEMBLY = ["sample", "tech", "hap"]


def islands_sql(source: str, keys: str = "chrom", name: str = "m", gap: int = 0, extra: str = "") -> str:
    """CTEs that merge overlapping or touching rows of ``source`` into ``name``."""
    return f"""{name}_e AS (SELECT *, max(end_pos) OVER (PARTITION BY {keys} ORDER BY start_pos, end_pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM {source}),
      {name}_g AS (SELECT *, sum(CASE WHEN prev IS NULL OR start_pos > prev + {gap} THEN 1 ELSE 0 END)
        OVER (PARTITION BY {keys} ORDER BY start_pos, end_pos ROWS UNBOUNDED PRECEDING) AS island FROM {name}_e),
      {name} AS (SELECT {keys}, min(start_pos) AS start_pos, max(end_pos) AS end_pos{extra} FROM {name}_g GROUP BY {keys}, island)"""


def depth_sql(source: str, keys: str = "chrom", name: str = "r", weight: str = "1", zero_steps: str = "WHERE d <> 0") -> str:
    """CTEs with runs (start, end, depth) of ``source``; the run after the last edge has a NULL end."""
    return f"""{name}_ev AS (SELECT {keys}, start_pos AS pos, {weight} AS d FROM {source}
        UNION ALL SELECT {keys}, end_pos, -({weight}) FROM {source}),
      {name}_s AS (SELECT {keys}, pos, sum(d) AS d FROM {name}_ev GROUP BY {keys}, pos),
      {name} AS (SELECT {keys}, pos AS start_pos, lead(pos) OVER (PARTITION BY {keys} ORDER BY pos) AS end_pos,
        CAST(sum(d) OVER (PARTITION BY {keys} ORDER BY pos) AS BIGINT) AS depth FROM {name}_s {zero_steps})"""


CONFIDENT = "SELECT sample, tech, hap, chrom, start_pos, end_pos FROM aln WHERE mapq >= 50 AND mapq < 61"
ONE_SET = f"c AS ({CONFIDENT})"
PER_ASSEMBLY = f"{ONE_SET}, {islands_sql('c', 'sample, tech, hap, chrom', 'pa')}"


def confident(s):
    return s.aln.where("mapq >= 50 and mapq < 61").select(*ASSEMBLY, "chrom", sweep.START, sweep.END)


# --- joins ------------------------------------------------------------------


@query(
    "overlap_join",
    """SELECT a.chrom, a.start_pos, a.end_pos, a.name, b.start_pos AS start_pos_b, b.end_pos AS end_pos_b, b.contig AS contig_b,
       least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) AS bp
       FROM regions a JOIN aln b ON a.chrom = b.chrom AND a.start_pos < b.end_pos AND b.start_pos < a.end_pos""",
)
def _(s):
    a = s.regions.select("chrom", "start_pos", "end_pos", "name")
    return overlap.overlap_join(a, s.aln.select("chrom", "start_pos", "end_pos", "contig"), width=1024)


@query(
    "overlap_left",
    """SELECT a.chrom, a.start_pos, a.end_pos, a.name, b.start_pos AS start_pos_b, b.end_pos AS end_pos_b, b.tech AS tech_b,
       CASE WHEN b.chrom IS NULL THEN 0 ELSE least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) END AS bp
       FROM regions a LEFT JOIN aln b
       ON a.chrom = b.chrom AND a.start_pos < b.end_pos AND b.start_pos < a.end_pos""",
)
def _(s):
    b = s.aln.select("chrom", "start_pos", "end_pos", "tech")
    return overlap.overlap_join(s.regions.select("chrom", "start_pos", "end_pos", "name"), b, how="left", width=1024)


@query(
    "overlap_reciprocal",
    """SELECT a.name AS name, b.name AS name_b, least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) AS bp
       FROM sv a JOIN regions b ON a.chrom = b.chrom AND a.start_pos < b.end_pos AND b.start_pos < a.end_pos
       WHERE least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) >= 0.25 * (a.end_pos - a.start_pos)
       AND least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) >= 0.25 * (b.end_pos - b.start_pos)""",
)
def _(s):
    cols = ["chrom", "start_pos", "end_pos", "name"]
    pairs = overlap.overlap_join(s.sv.select(*cols), s.regions.select(*cols), min_frac=0.25, reciprocal=True, width=1024)
    return pairs.select("name", "name_b", "bp")


@query(
    "overlap_semi",
    """SELECT * FROM aln a WHERE EXISTS (SELECT 1 FROM roi b WHERE a.chrom = b.chrom AND a.start_pos < b.end_pos AND b.start_pos < a.end_pos)""",
)
def _(s):
    return overlap.overlap_semi(s.aln, s.roi)


@query(
    "overlap_anti",
    """SELECT chrom, start_pos, end_pos, contig FROM aln a
       WHERE NOT EXISTS (SELECT 1 FROM roi b WHERE a.chrom = b.chrom AND a.start_pos < b.end_pos AND b.start_pos < a.end_pos)
       AND NOT EXISTS (SELECT 1 FROM sv b WHERE a.chrom = b.chrom AND a.start_pos < b.start_pos + 10 + num_samples * 10 AND b.start_pos < a.end_pos)""",
)
def _(s):
    a = s.aln.select("chrom", "start_pos", "end_pos", "contig")
    return overlap.overlap_anti(a, s.roi, s.sv.withColumn("end_pos", F.col("start_pos") + 10 + F.col("num_samples") * 10))


@query(
    "overlap_padded",
    """SELECT r.chrom, r.start_pos, r.end_pos, r.name, coalesce(string_agg(b.name, ',' ORDER BY b.name), 'none') AS near_ids,
       coalesce(string_agg(CAST(b.end_pos - b.start_pos AS VARCHAR), ',' ORDER BY b.name), 'none') AS near_sizes
       FROM roi r LEFT JOIN sv b
       ON r.chrom = b.chrom AND r.start_pos - 1000 < b.end_pos AND b.start_pos - 1000 < r.end_pos GROUP BY ALL""",
)
def _(s):
    return overlap.padded_lookup(s.roi, s.sv, pad=1000)


@query(
    "nearest_distance",
    """WITH d AS (SELECT a.name, a.cls, a.chrom, min(greatest(b.start_pos - a.end_pos, a.start_pos - b.end_pos, 0)) AS distance
         FROM regions a LEFT JOIN (SELECT chrom, start_pos, start_pos + 10 AS end_pos FROM sv) b ON a.chrom = b.chrom GROUP BY ALL)
       SELECT cls, quantile_cont(distance, 0.5) AS median_distance, round(avg(distance), 6) AS mean_distance, count(distance) AS n
       FROM d GROUP BY cls""",
)
def _(s):
    from ..operators.distribution import describe_by

    near = overlap.nearest(s.regions, s.sv.withColumn("end_pos", F.col("start_pos") + 10))
    out = describe_by(near, ["cls"], "distance")
    return out.select("cls", F.col("q50").alias("median_distance"), F.round("mean", 6).alias("mean_distance"), F.col("count").alias("n"))


# --- region algebra ---------------------------------------------------------


@query("merge_intervals", f"WITH {islands_sql('aln', 'sample, chrom', 'm')} SELECT * FROM m")
def _(s):
    return sweep.merge_intervals(s.aln, by=["sample", "chrom"])


@query(
    "merge_intervals_names",
    f"""WITH {islands_sql('sv', 'chrom', 'm', 40)}, g AS (SELECT DISTINCT m.chrom, m.start_pos, m.end_pos, s.svtype || s.num_samples AS label
          FROM m JOIN sv s ON m.chrom = s.chrom AND s.start_pos >= m.start_pos AND s.start_pos < m.end_pos)
        SELECT chrom, start_pos, end_pos, string_agg(label, '@' ORDER BY label) AS names FROM g GROUP BY chrom, start_pos, end_pos""",
)
def _(s):
    sv = s.sv.withColumn("label", F.concat("svtype", F.col("num_samples").cast("string")))
    return sweep.merge_intervals(sv, gap=40, names="label", sep="@")


@query(
    "complement",
    f"""WITH {PER_ASSEMBLY},
      x AS (SELECT sample, tech, hap, chrom, end_pos AS start_pos, lead(start_pos) OVER w AS end_pos FROM pa
            WINDOW w AS (PARTITION BY sample, tech, hap, chrom ORDER BY start_pos)
            UNION ALL SELECT sample, tech, hap, chrom, 0, min(start_pos) FROM pa GROUP BY ALL)
      SELECT sample, tech, hap, x.chrom, start_pos, coalesce(end_pos, size) AS end_pos FROM x JOIN chroms c ON x.chrom = c.chrom
      WHERE coalesce(end_pos, size) > start_pos""",
)
def _(s):
    return sweep.complement(confident(s), s.chroms, by=ASSEMBLY)


@query(
    "subtract",
    f"""WITH {ONE_SET}, {islands_sql('c', 'chrom', 'm')}, b AS (SELECT chrom, start_pos, end_pos FROM m),
      edges AS (SELECT chrom, end_pos AS start_pos, coalesce(lead(start_pos) OVER (PARTITION BY chrom ORDER BY start_pos), 1000000000) AS end_pos FROM b
                UNION ALL SELECT chrom, -1, min(start_pos) FROM b GROUP BY chrom)
      SELECT a.chrom, a.name, greatest(a.start_pos, e.start_pos) AS start_pos, least(a.end_pos, e.end_pos) AS end_pos
      FROM regions a JOIN edges e ON a.chrom = e.chrom AND a.start_pos < e.end_pos AND e.start_pos < a.end_pos""",
)
def _(s):
    return sweep.subtract(s.regions.select("chrom", "start_pos", "end_pos", "name"), confident(s))


@query(
    "multi_intersect",
    f"""WITH t AS (SELECT tech, chrom, start_pos, end_pos FROM aln), {islands_sql('t', 'tech, chrom', 'm')}, {depth_sql('m')}
      SELECT chrom, start_pos, end_pos, 'CLR,HiFi' AS set_names FROM r WHERE depth = 2""",
)
def _(s):
    return sweep.multi_intersect(s.aln, "tech", ["HiFi", "CLR"])


@query("disjoin", f"WITH {depth_sql('sv', zero_steps='')} SELECT chrom, start_pos, end_pos FROM r WHERE depth > 0")
def _(s):
    return sweep.disjoin(s.sv)


@query(
    "make_windows",
    """SELECT chrom, w * 500 AS start_pos, least(w * 500 + 500, size) AS end_pos
       FROM (SELECT chrom, size, unnest(range(CAST(ceil(size / 500.0) AS BIGINT))) AS w FROM chroms)""",
)
def _(s):
    return sweep.make_windows(s.chroms, 500)


# --- coverage ---------------------------------------------------------------

@query(
    "coverage",
    f"""WITH q AS (SELECT chrom, start_pos, end_pos FROM aln), {islands_sql('q', 'chrom', 'm')},
      h AS (SELECT a.name, count(b.chrom) AS num_overlaps FROM regions a LEFT JOIN q b
            ON a.chrom = b.chrom AND a.start_pos < b.end_pos AND b.start_pos < a.end_pos GROUP BY a.name),
      c AS (SELECT a.name, sum(least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos)) AS bp FROM regions a JOIN m b
            ON a.chrom = b.chrom AND a.start_pos < b.end_pos AND b.start_pos < a.end_pos GROUP BY a.name)
      SELECT a.chrom, a.start_pos, a.end_pos, a.name, num_overlaps, CAST(coalesce(bp, 0) AS BIGINT) AS covered_bp,
        a.end_pos - a.start_pos AS length, round(coalesce(bp, 0) / (a.end_pos - a.start_pos), 6) AS fraction
      FROM regions a JOIN h ON a.name = h.name LEFT JOIN c ON a.name = c.name""",
)
def _(s):
    out = overlap.coverage(s.regions.select("chrom", "start_pos", "end_pos", "name"), s.aln)
    return out.withColumn("fraction", F.round("fraction", 6))


@query(
    "coverage_counts",
    """SELECT a.chrom, a.start_pos, a.end_pos, count(b.chrom) AS num_overlaps
       FROM (SELECT chrom, w * 1000 AS start_pos, least(w * 1000 + 1000, size) AS end_pos
             FROM (SELECT chrom, size, unnest(range(CAST(ceil(size / 1000.0) AS BIGINT))) AS w FROM chroms)) a
       LEFT JOIN (SELECT chrom, start_pos, end_pos FROM aln) b ON a.chrom = b.chrom AND a.start_pos < b.end_pos AND b.start_pos < a.end_pos
       GROUP BY ALL""",
)
def _(s):
    return overlap.coverage_counts(sweep.make_windows(s.chroms, 1000), s.aln)


@query(
    "map_mean",
    """SELECT r.chrom, r.start_pos, r.end_pos, r.name, round(avg(b.score), 3) AS mean_score FROM roi r LEFT JOIN regions b
       ON r.chrom = b.chrom AND r.start_pos < b.end_pos AND b.start_pos < r.end_pos
       AND least(r.end_pos, b.end_pos) - greatest(r.start_pos, b.start_pos) >= 0.05 * (r.end_pos - r.start_pos) GROUP BY ALL""",
)
def _(s):
    return overlap.map_mean(s.roi, s.regions, min_frac=0.05)


@query("depth_runs", f"WITH {depth_sql('aln', 'tech, chrom')} SELECT * FROM r WHERE depth > 0")
def _(s):
    return sweep.depth_runs(s.aln, by=["tech", "chrom"])


@query(
    "depth_per_base",
    f"""WITH {depth_sql('sv')}, p AS (SELECT chrom, unnest(range(start_pos, least(end_pos, 1000000000))) + 1 AS pos, depth FROM r WHERE depth > 0),
      every AS (SELECT chrom, unnest(range(size)) + 1 AS pos FROM chroms)
      SELECT every.chrom, every.pos, coalesce(depth, 0) AS depth FROM every LEFT JOIN p ON every.chrom = p.chrom AND every.pos = p.pos""",
)
def _(s):
    return sweep.depth_per_base(s.sv, s.chroms)


@query(
    "region_average",
    """WITH o AS (SELECT r.name, least(r.end_pos, t.end_pos) - greatest(r.start_pos, t.start_pos) AS bp, depth
         FROM roi r JOIN track t ON r.chrom = t.chrom AND r.start_pos < t.end_pos AND t.start_pos < r.end_pos WHERE depth <> 0),
       a AS (SELECT name, sum(bp) AS covered, CAST(sum(bp * CAST(depth AS DECIMAL(19, 2))) AS DOUBLE) AS total FROM o GROUP BY name)
       SELECT r.name, r.end_pos - r.start_pos AS size, CAST(coalesce(covered, 0) AS BIGINT) AS covered, round(coalesce(total, 0), 6) AS total,
         round(coalesce(total, 0) / (r.end_pos - r.start_pos), 6) AS mean0, round(coalesce(total / covered, 0), 6) AS mean
       FROM roi r LEFT JOIN a ON r.name = a.name""",
)
def _(s):
    out = overlap.region_average(s.roi, s.track)
    return out.select("name", "size", "covered", F.round("total", 6).alias("total"), F.round("mean0", 6).alias("mean0"), F.round("mean", 6).alias("mean"))


@query(
    "merge_tracks",
    """WITH t AS (SELECT chrom, start_pos, end_pos, CAST(round(depth * 100) AS BIGINT) AS depth FROM track UNION ALL SELECT chrom, start_pos, end_pos, score * 100 FROM regions),
      """ + depth_sql("t", weight="depth") + """ SELECT chrom, start_pos, end_pos, depth / 100 AS depth FROM r WHERE depth <> 0""",
)
def _(s):
    return sweep.merge_tracks(s.track, s.regions.withColumnRenamed("score", "depth"))


@query(
    "interval_jaccard",
    f"""WITH {ONE_SET}, d AS (SELECT sample, chrom, start_pos, end_pos FROM c), {islands_sql('d', 'sample, chrom', 'm')},
      z AS (SELECT sample, sum(end_pos - start_pos) AS bp FROM m GROUP BY sample),
      i AS (SELECT a.sample AS set_a, b.sample AS set_b, sum(least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos)) AS bp, count(*) AS n
            FROM m a JOIN m b ON a.chrom = b.chrom AND a.sample < b.sample AND a.start_pos < b.end_pos AND b.start_pos < a.end_pos GROUP BY ALL)
      SELECT x.sample AS set_a, y.sample AS set_b, CAST(coalesce(i.bp, 0) AS BIGINT) AS intersection,
        CAST(x.bp + y.bp - coalesce(i.bp, 0) AS BIGINT) AS union_bp, round(coalesce(i.bp, 0) / (x.bp + y.bp - coalesce(i.bp, 0)), 6) AS jaccard,
        coalesce(n, 0) AS n_intersections
      FROM z x JOIN z y ON x.sample < y.sample LEFT JOIN i ON i.set_a = x.sample AND i.set_b = y.sample""",
)
def _(s):
    return overlap.interval_jaccard(confident(s), "sample").withColumn("jaccard", F.round("jaccard", 6))


@query("pair_combinations", "SELECT a.sample AS sample_a, b.sample AS sample_b, a.sex AS sex_a, b.sex AS sex_b FROM samples a JOIN samples b ON a.sample < b.sample")
def _(s):
    return overlap.pair_combinations(s.samples, "sample", ["sex"])


# --- masks ------------------------------------------------------------------

HALF = f"""WITH {PER_ASSEMBLY}, {depth_sql('pa')}, k AS (SELECT CAST(floor(count(*) * 0.5) AS BIGINT) AS t
  FROM (SELECT DISTINCT sample, tech, hap FROM aln))"""


def assembly_count(s) -> int:
    return s.aln.select(*ASSEMBLY).distinct().count()


@query(
    "consensus_mask_flow",
    f"""{HALF}, x AS (SELECT chrom, start_pos, end_pos FROM r JOIN k ON depth >= t), {islands_sql('x', 'chrom', 'f')}
      SELECT chrom, start_pos, end_pos, concat('regions_geq_half_', chrom) AS name FROM f WHERE end_pos - start_pos >= 20""",
)
def _(s):
    """Flow: confident alignments, merged per assembly, covered by at least half of the assemblies, sorted."""
    regions = masks.consensus_regions(confident(s), assembly_count(s), "geq", 0.5, "fraction", min_size=20)
    return regions.withColumn("name", F.concat(F.lit("regions_geq_half_"), "chrom")).orderBy("chrom", "start_pos", "end_pos")


@query(
    "consensus_mask",
    f"""WITH {PER_ASSEMBLY}, {depth_sql('pa')}, x AS (SELECT chrom, start_pos, end_pos FROM r WHERE depth >= 1), {islands_sql('x', 'chrom', 'f')},
      k AS (SELECT count(*) AS n FROM (SELECT DISTINCT sample, tech, hap FROM aln)),
      gaps AS (SELECT chrom, end_pos AS start_pos, lead(start_pos) OVER (PARTITION BY chrom ORDER BY start_pos) AS end_pos FROM f
               UNION ALL SELECT chrom, 0, min(start_pos) FROM f GROUP BY chrom),
      inv AS (SELECT g.chrom, start_pos, coalesce(end_pos, size) AS end_pos FROM gaps g JOIN chroms c ON g.chrom = c.chrom),
      everyone AS (SELECT chrom, start_pos, end_pos FROM r JOIN k ON depth = n)
      SELECT 'any' AS mask, chrom, start_pos, end_pos FROM f
      UNION ALL SELECT 'any_inverse', chrom, start_pos, end_pos FROM inv WHERE end_pos > start_pos
      UNION ALL SELECT 'all', chrom, start_pos, end_pos FROM everyone""",
)
def _(s):
    k = assembly_count(s)
    runs = written_once(masks.haplotype_depth(confident(s)))  # one sweep for all masks
    parts = [
        masks.depth_regions(runs, k, "any").withColumn("mask", F.lit("any")),
        masks.depth_regions(runs, k, "any", sizes=s.chroms, inverse=True).withColumn("mask", F.lit("any_inverse")),
        masks.depth_regions(runs, k, "all").withColumn("mask", F.lit("all")),
    ]
    return sweep.union_all(parts)


@query(
    "threshold_mask",
    f"""WITH {PER_ASSEMBLY}, {depth_sql('pa')}, k AS (SELECT count(*) AS n FROM (SELECT DISTINCT sample, tech, hap FROM aln)),
      lt AS (SELECT chrom, start_pos, end_pos FROM r JOIN k ON depth > 0 AND depth < ceil(n * 0.3)), {islands_sql('lt', 'chrom', 'flt')},
      geq AS (SELECT chrom, start_pos, end_pos FROM r WHERE depth >= 12), {islands_sql('geq', 'chrom', 'fgeq')}
      SELECT 'lt' AS mask, * FROM flt UNION ALL SELECT 'geq', * FROM fgeq""",
)
def _(s):
    k = assembly_count(s)
    runs = written_once(masks.haplotype_depth(confident(s)))
    low = masks.depth_regions(runs, k, "lt", 0.3, "fraction").withColumn("mask", F.lit("lt"))
    high = masks.depth_regions(runs, k, "geq", 12).withColumn("mask", F.lit("geq"))
    return low.unionByName(high)


@query(
    "haplotype_depth_bp",
    f"""WITH {PER_ASSEMBLY}, {depth_sql('pa')} SELECT depth, CAST(sum(end_pos - start_pos) AS BIGINT) AS bp FROM r WHERE depth > 0
      GROUP BY ROLLUP (depth)""",
)
def _(s):
    return masks.bp_by_depth(masks.haplotype_depth(confident(s)))


@query(
    "uniform_coverage_regions",
    f"""WITH {depth_sql('aln')}, base AS (SELECT chrom, unnest(range(start_pos, least(end_pos, 1000000000))) AS p, depth FROM r WHERE depth > 0),
      c AS (SELECT chrom, p, sum(depth) OVER (PARTITION BY chrom ORDER BY p) AS cum, sum(depth) OVER (PARTITION BY chrom ORDER BY p) - depth AS before FROM base),
      t AS (SELECT chrom, CAST(round_even(sum(depth) / 16.0, 0) AS BIGINT) AS share FROM base GROUP BY chrom),
      j AS (SELECT chrom, share, unnest(range(1, 40)) AS j FROM t),
      cut AS (SELECT DISTINCT c.chrom, p AS pos FROM c JOIN j ON c.chrom = j.chrom AND before <= j * share AND cum > j * share WHERE p > 0),
      e AS (SELECT chrom, pos FROM cut UNION SELECT chrom, 0 FROM chroms UNION SELECT chrom, size FROM chroms)
      SELECT chrom, start_pos, end_pos FROM (SELECT chrom, pos AS start_pos, lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS end_pos FROM e)
      WHERE end_pos IS NOT NULL""",
)
def _(s):
    return masks.uniform_regions(sweep.depth_runs(s.aln), s.chroms, 16)

"""Queries on variant calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import genotype_class
from ..operators import overlap, variants
from .registry import query

GT = "split_part(call, ':', 1)"


def vcf(s):
    return s.vcf.withColumn("gt", F.element_at(F.split("call", ":"), 1))


@query("vcf_filter", "SELECT chrom, pos, qual, depth, gq, sample FROM (SELECT *, depth + 3 AS gq FROM calls) WHERE qual >= 40 AND depth < 25 AND gq >= 10")
def _(s):
    rows = s.calls.withColumn("gq", F.col("depth") + 3).select("chrom", "pos", "qual", "depth", "gq", "sample")
    return variants.filter_calls(rows, 40, 25, 10)


@query(
    "vcf_split_type",
    f"""SELECT 'snp' AS kind, chrom, pos, alt FROM vcf WHERE length(ref) = 1 AND alt = 'T' AND {GT} IN ('0/1', '1/1')
      UNION ALL SELECT 'snp4', chrom, pos, alt FROM vcf WHERE length(ref) = 1 AND alt IN ('T', 'T,G') AND {GT} = '1/1' AND qual > 90
      UNION ALL SELECT 'indel', chrom, pos, alt FROM vcf WHERE length(ref) <> length(alt) AND alt <> 'T,G'""",
)
def _(s):
    v = vcf(s)
    parts = {
        "snp": variants.split_by_type(v, "snp", min_alt_count=1),
        "snp4": variants.split_by_type(v.where("gt = '1/1' and qual > 90"), "snp", max_alleles=4),
        "indel": variants.split_by_type(v, "indel"),
    }
    out = [d.select(F.lit(k).alias("kind"), "chrom", "pos", "alt") for k, d in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("vcf_split_genotype", f"SELECT {GT} AS gt, sample, count(*) AS n FROM vcf WHERE {GT} <> './.' GROUP BY ALL")
def _(s):
    both = variants.split_by_genotype(vcf(s), "hom").unionByName(variants.split_by_genotype(vcf(s), "het"))
    return both.groupBy("gt", "sample").agg(F.count(F.lit(1)).alias("n"))


@query(
    "vcf_to_bed",
    """SELECT CASE WHEN vtype = 'snv' THEN 'snvs' WHEN vtype = 'ins' THEN 'ins' ELSE 'dels' END AS cls, chrom, pos - 1 AS start_pos,
      pos + CASE WHEN vtype = 'del' THEN vlen ELSE 0 END AS end_pos FROM calls""",
)
def _(s):
    parts = [variants.calls_to_intervals(s.vcf, c).select(F.lit(c).alias("cls"), "chrom", "start_pos", "end_pos") for c in ("snvs", "ins", "dels")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "normalize_caller_vcf",
    """SELECT chrom, pos, concat(split_part(call, ':', 1), ':', CAST(round_even(CAST(split_part(call, ':', 2) AS DOUBLE), 0) AS BIGINT), ':', split_part(call, ':', 3)) AS call
      FROM vcf WHERE filter = 'PASS'""",
)
def _(s):
    return variants.normalize_calls(s.vcf).select("chrom", "pos", "call")


@query(
    "normalize_caller_counts",
    """SELECT count(*) AS records, count(*) FILTER (filter LIKE '%dn%') AS dense, count(*) FILTER (filter LIKE '%dp%' AND filter NOT LIKE '%dn%') AS depth,
      count(*) FILTER (filter = 'PASS') AS kept FROM vcf""",
)
def _(s):
    return variants.normalize_counts(s.vcf)


@query(
    "flatten_calls",
    f"""SELECT chrom AS sequence, pos, pos - 1 AS start_pos, pos - 1 + length(ref) AS end_pos, CAST(qual AS BIGINT) AS qual, ref AS ref_allele,
      split_part(alt, ',', 1) AS alt_allele, CAST(split_part(call, ':', 3) AS BIGINT) AS depth, length(ref) AS region_length,
      CAST(regexp_extract(info, 'LEN=([0-9]+)', 1) AS BIGINT) AS variant_length, sample,
      CASE WHEN info LIKE '%TYPE=snp' THEN 'SNV' WHEN info LIKE '%TYPE=ins' THEN 'INS' ELSE 'DEL' END AS var_type,
      CASE {GT} WHEN '1/1' THEN 'HOM' WHEN '0/1' THEN 'HET' END AS genotype FROM vcf""",
)
def _(s):
    return variants.flatten_calls(s.vcf)


@query(
    "genotype_cleanup",
    f"""SELECT chrom, pos, CASE WHEN {GT} = './.' THEN 'N/A' ELSE replace({GT}, '/', '') END AS genotype, regexp_extract(info, 'TYPE=([a-z]+)', 1) AS var_type,
      CASE WHEN pos % 9 = 0 THEN -1 ELSE CAST(regexp_extract(info, 'LEN=([0-9]+)', 1) AS BIGINT) END AS length FROM vcf""",
)
def _(s):
    dirty = s.vcf.withColumn("info", F.when(F.col("pos") % 9 == 0, F.regexp_replace("info", "LEN=[0-9]+", "LEN=?")).otherwise(F.col("info")))
    return variants.genotypes(dirty).select("chrom", "pos", "genotype", "var_type", "length")


@query(
    "isec",
    """WITH a AS (SELECT DISTINCT chrom, pos FROM calls), b AS (SELECT DISTINCT chrom, pos FROM calls_b)
      SELECT 'only_a' AS part, chrom, pos FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'only_b', chrom, pos FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
      UNION ALL SELECT 'shared_a', chrom, pos FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'shared_b', chrom, pos FROM (SELECT * FROM a INTERSECT SELECT * FROM b)""",
)
def _(s):
    parts = variants.isec(s.calls.select("chrom", "pos"), s.calls_b.select("chrom", "pos"), ["chrom", "pos"])
    from ..operators.sweep import union_all

    return union_all([d.withColumn("part", F.lit(k)) for k, d in parts.items()])


FULL = """full_set AS (SELECT vtype AS variant, CASE gt WHEN '1/1' THEN 'hom' ELSE 'het' END AS genotype, chrom, pos, depth, vlen AS variant_length FROM calls WHERE gt <> './.'),
  lifted AS (SELECT chrom, pos, concat('ref_', chrom) AS ref_seq, pos + 100 AS ref_start, pos + 200 AS ref_end, 1 AS is_lifted, is_highconf FROM calls_b),
  merged AS (SELECT variant, genotype, coalesce(f.chrom, l.chrom) AS chrom, coalesce(f.pos, l.pos) AS pos, depth, variant_length, coalesce(ref_seq, 'none') AS ref_seq,
    coalesce(ref_start, 0) AS ref_start, coalesce(ref_end, 0) AS ref_end, coalesce(is_lifted, 0) = 1 AS is_lifted, coalesce(is_highconf, 0) = 1 AS is_highconf
    FROM full_set f FULL JOIN lifted l ON f.chrom = l.chrom AND f.pos = l.pos)"""


def merged(s):
    full = s.calls.where("gt <> './.'").select(
        F.col("vtype").alias("variant"), F.lower(genotype_class(F.col("gt"))).alias("genotype"), "chrom", "pos", "depth", F.col("vlen").alias("variant_length")
    )
    lifted = s.calls_b.select(
        "chrom", "pos", F.concat(F.lit("ref_"), "chrom").alias("ref_seq"), (F.col("pos") + 100).alias("ref_start"), (F.col("pos") + 200).alias("ref_end"),
        F.lit(1).alias("is_lifted"), "is_highconf",
    )
    return variants.merge_lifted(full, lifted, ["chrom", "pos"])


@query("merge_lifted", f"WITH {FULL} SELECT * FROM merged")
def _(s):
    return merged(s)


def _qv_sql() -> str:
    parts = ["SELECT 'variants_total_count' AS key, CAST(count(*) AS DOUBLE) AS value FROM v UNION ALL SELECT 'variants_total_length', sum(variant_length) FROM v",
             "SELECT 'variants_total_DPgeq3_count', count(*) FROM d UNION ALL SELECT 'variants_total_DPgeq3_length', sum(variant_length) FROM d"]
    n = lambda where: f"SELECT count(*) FROM d WHERE {where}"
    bp = lambda where: f"SELECT coalesce(sum(variant_length), 0) FROM d WHERE {where}"
    for v in ("snv", "ins", "del"):
        for g in (None, "hom", "het"):
            where = f"variant = '{v}'" + (f" AND genotype = '{g}'" if g else "")
            label = f"{v}_{g}" if g else v
            plain = label if g else f"{v}_total"
            parts += [f"SELECT '{plain}_count', ({n(where)})", f"SELECT '{plain}_length', ({bp(where)})"]
            for name, test in (("lifted", "is_lifted"), ("unlifted", "NOT is_lifted"), ("highconf", "is_highconf")):
                parts += [f"SELECT '{label}_{name}_count', ({n(where + ' AND ' + test)})", f"SELECT '{label}_{name}_length', ({bp(where + ' AND ' + test)})"]
            lifted = n(where + " AND is_lifted")
            parts += [f"SELECT '{label}_lifted_pct', round_even(({lifted}) / ({n(where)}) * 100, 2)",
                      f"SELECT '{label}_highconf_pct', round_even(({n(where + ' AND is_highconf')}) / ({lifted}) * 100, 2)"]
    for name, test in (("highconf", "is_highconf"), ("unlifted", "NOT is_lifted")):
        parts += [f"SELECT 'hom_{name}_count', ({n(f'genotype = {chr(39)}hom{chr(39)} AND {test}')})", f"SELECT 'hom_{name}_length', ({bp(f'genotype = {chr(39)}hom{chr(39)} AND {test}')})"]
    for g, test in (("all", "true"), ("snv", "variant = 'snv'"), ("indels", "variant IN ('ins', 'del')")):
        for suffix, regions in (("hom_highconf", "is_highconf"), ("hom_highconf|unlifted", "(is_highconf OR NOT is_lifted)")):
            b = bp(f"genotype = 'hom' AND {test} AND {regions}")
            parts += [f"SELECT 'QV_{g}_{suffix}', CASE WHEN ({b}) = 0 THEN 100 ELSE round_even(-10 * log10(({b}) / 6.2e9), 0) END", f"SELECT 'QV_{g}_{suffix}_bp', ({b})"]
    return f"WITH {FULL}, v AS (SELECT * FROM merged WHERE variant IS NOT NULL), d AS (SELECT * FROM v WHERE depth >= 3) " + " UNION ALL ".join(parts)


@query("variant_qv_table", _qv_sql())
def _(s):
    return variants.variant_qv(merged(s).where("variant is not null"))


TRIO = """g AS (SELECT CASE WHEN child LIKE '%.%' THEN 'NA' ELSE replace(child, '/', '') END AS c, CASE WHEN mother LIKE '%.%' THEN 'NA' ELSE replace(mother, '/', '') END AS m,
    CASE WHEN father LIKE '%.%' THEN 'NA' ELSE replace(father, '/', '') END AS f, vlen, vtype, region_type FROM trio),
  cl AS (SELECT *, CASE WHEN c IN ('00', '11') THEN 'ERROR' WHEN c = 'NA' AND m <> 'NA' AND f <> 'NA' THEN 'AMBIG' WHEN c = 'NA' THEN 'SKIP' WHEN m = 'NA' OR f = 'NA' THEN 'OK'
    WHEN (m LIKE '%0%' AND f LIKE '%1%') OR (m LIKE '%1%' AND f LIKE '%0%') THEN 'OK' ELSE 'ERROR' END AS call_class FROM g)"""


@query(
    "trio_classes",
    f"""WITH {TRIO} SELECT call_class, c || '-' || m || '-' || f AS genotypes, coalesce(vtype, 'any') AS vtype, coalesce(region_type, 'any') AS region_type,
      CAST(sum(vlen) AS BIGINT) AS bp, count(*) AS n FROM cl GROUP BY call_class, c, m, f, CUBE (vtype, region_type)""",
)
def _(s):
    return variants.trio_classes(s.trio)


def _trio_sql() -> str:
    parts = []
    for kind, t in (("snp", "vtype = 'O'"), ("all", "true")):
        for calls, names in (("error", "('ERROR')"), ("error_ambig", "('ERROR', 'AMBIG')")):
            for where, r in (("high-conf", "('A')"), ("hc-or-not-lifted", "('A', 'N')")):
                parts.append(f"SELECT 'QV..{kind}..{calls}..{where}' AS label, CAST(sum(vlen) AS BIGINT) AS bp FROM cl WHERE {t} AND call_class IN {names} AND region_type IN {r}")
    return f"WITH {TRIO}, x AS ({' UNION ALL '.join(parts)}) SELECT *, CAST(round_even(-10 * log10(bp / 6.4e9), 0) AS BIGINT) AS qv FROM x"


@query("trio_qv", _trio_sql())
def _(s):
    return variants.trio_qv(s.trio, snp="O", high="A", unlifted="N")


def _concordance_sql() -> str:
    names = ["child", "mother", "father"]
    fits = lambda g: f"((mother LIKE '%' || left({g}, 1) || '%' AND father LIKE '%' || right({g}, 1) || '%') OR (mother LIKE '%' || right({g}, 1) || '%' AND father LIKE '%' || left({g}, 1) || '%'))"
    per = " UNION ALL ".join(
        f"SELECT '{c}' AS sample, {fits(c)} AS mendel_ok, CASE WHEN k = 1 THEN false WHEN k > 2 THEN NULL ELSE {c} <> major END AS minority, k FROM z" for c in names
    )
    return f"""WITH y AS (SELECT child, mother, father, len(list_distinct([child, mother, father])) AS k FROM trio),
      z AS (SELECT *, CASE WHEN mother = father THEN mother ELSE child END AS major FROM y), p AS ({per})
      SELECT 'all_concordant' AS metric, '*' AS sample, count(*) FILTER (k = 1) AS n, round(count(*) FILTER (k = 1) / count(*) * 100, 2) AS pct FROM z
      UNION ALL SELECT 'fully_discordant', '*', count(*) FILTER (k > 2), round(count(*) FILTER (k > 2) / count(*) * 100, 2) FROM z
      UNION ALL SELECT 'mendel_majority', '*', count(*) FILTER (NOT {fits('major')}), round(count(*) FILTER (NOT {fits('major')}) / count(*) * 100, 2) FROM z
      UNION ALL SELECT 'minority', sample, count(*) FILTER (minority), round(count(*) FILTER (minority) / count(*) * 100, 2) FROM p GROUP BY sample
      UNION ALL SELECT 'mendel_error', sample, count(*) FILTER (NOT mendel_ok), round(count(*) FILTER (NOT mendel_ok) / count(*) * 100, 2) FROM p GROUP BY sample
      UNION ALL SELECT 'report:' || CAST(mendel_ok AS VARCHAR) || ':' || coalesce(CAST(minority AS VARCHAR), 'none') || ':' || CAST(k = 1 AS VARCHAR) || ':' || CAST(k > 2 AS VARCHAR),
        sample, count(*), CAST(NULL AS DOUBLE) FROM p GROUP BY ALL"""


@query("genotype_concordance", _concordance_sql())
def _(s):
    return variants.concordance(s.trio, ["child", "mother", "father"], ("mother", "father"))


@query(
    "snv_cluster_stats",
    """WITH v AS (SELECT chrom, qual, depth, depth + 3 AS gq FROM calls)
      SELECT c.chrom, size, count(v.chrom) AS num, round_even(count(v.chrom) / (size / 1000.0), 3) AS per_kbp, round_even(avg(qual), 3) AS qual_mean, round_even(stddev_samp(qual), 3) AS qual_stddev,
        round_even(avg(depth), 3) AS depth_mean, round_even(stddev_samp(depth), 3) AS depth_stddev, round_even(avg(gq), 3) AS gq_mean, round_even(stddev_samp(gq), 3) AS gq_stddev
      FROM chroms c LEFT JOIN v ON c.chrom = v.chrom GROUP BY c.chrom, size""",
)
def _(s):
    return variants.snv_stats(s.calls.withColumn("gq", F.col("depth") + 3), s.chroms)


@query(
    "call_set_stats",
    f"""SELECT sample, count(*) AS records, count(*) FILTER (length(ref) = 1 AND alt IN ('T', 'T,G')) AS snps, count(*) FILTER (length(ref) <> length(split_part(alt, ',', 1))) AS indels,
      count(*) FILTER (alt IN ('T', 'T,G') AND {GT} = '0/1') AS het, count(*) FILTER (alt IN ('T', 'T,G') AND {GT} = '1/1') AS hom_alt FROM vcf GROUP BY sample""",
)
def _(s):
    return variants.call_set_stats(vcf(s), ["sample"])


@query(
    "phasing_stats",
    """SELECT sample, count(*) AS heterozygous, count(*) FILTER (depth % 3 = 0) AS phased, round_even(count(*) FILTER (depth % 3 = 0) / count(*) * 100, 2) AS pct_phased
      FROM calls WHERE gt = '0/1' AND vtype = 'snv' GROUP BY sample""",
)
def _(s):
    het = s.calls.where("gt = '0/1' and vtype = 'snv'")
    table = het.groupBy("sample").agg(F.count(F.lit(1)).alias("heterozygous"), F.sum(F.when(F.col("depth") % 3 == 0, 1).otherwise(0)).alias("phased"))
    return variants.phasing_pct(table.withColumn("chrom", F.lit("ALL")))


@query(
    "match_sv_calls",
    """WITH c AS (SELECT concat('c', pos) AS call_id, chrom, pos - 1 AS s, pos - 1 + vlen AS e, sample, CASE vtype WHEN 'ins' THEN 'INS' ELSE 'DEL' END AS var_type, vlen FROM calls WHERE vtype <> 'snv')
      SELECT v.name AS sv_id, call_id, sample, var_type, least(e, end_pos) - greatest(s, start_pos) AS overlap, vlen AS variant_length, end_pos - start_pos AS svlen,
        CASE WHEN sample IN (concat('S', num_samples), 'S7') THEN 'match' ELSE 'miss' END AS sample_match, CASE WHEN vlen = end_pos - start_pos THEN 'full' ELSE 'partial' END AS length_match,
        CASE WHEN least(e, end_pos) - greatest(s, start_pos) = end_pos - start_pos THEN 'full' ELSE 'partial' END AS overlap_match
      FROM sv v JOIN c ON v.chrom = c.chrom AND v.start_pos < e AND s < v.end_pos AND v.svtype = var_type""",
)
def _(s):
    calls = s.calls.where("vtype <> 'snv'").select(
        F.concat(F.lit("c"), F.col("pos").cast("string")).alias("call_id"), "chrom", (F.col("pos") - 1).alias("start_pos"), (F.col("pos") - 1 + F.col("vlen")).alias("end_pos"),
        "sample", F.when(F.col("vtype") == "ins", "INS").otherwise("DEL").alias("var_type"), F.col("vlen").alias("variant_length"),
    )
    pairs = overlap.overlap_join(s.sv.select("chrom", "start_pos", "end_pos", "name"), calls.select("chrom", "start_pos", "end_pos", "call_id"))
    svs = s.sv.select(
        F.col("name").alias("sv_id"), "svtype", (F.col("end_pos") - F.col("start_pos")).alias("svlen"),
        F.array(F.concat(F.lit("S"), F.col("num_samples").cast("string")), F.lit("S7")).alias("carriers"),
    )
    overlaps = pairs.select(F.col("name").alias("sv_id"), F.col("call_id_b").alias("call_id"), F.col("bp").alias("overlap"))
    return variants.match_sv_calls(overlaps, calls.drop("chrom", "start_pos", "end_pos"), svs)


@query(
    "label_good_bad_union",
    "SELECT chrom, start_pos, end_pos, name, CASE WHEN num_samples > 2 THEN 1 ELSE 0 END AS quality FROM sv",
)
def _(s):
    cols = ["chrom", "start_pos", "end_pos", "name"]
    out = variants.union_with_quality(s.sv.where("num_samples > 2").select(*cols), s.sv.where("num_samples <= 2").select(*cols))
    return out.orderBy("chrom", "start_pos", "end_pos")


@query(
    "venn_counts",
    """WITH a AS (SELECT chrom, pos FROM calls), b AS (SELECT chrom, pos FROM calls_b)
      SELECT (SELECT count(*) FROM a SEMI JOIN b USING (chrom, pos)) AS shared, (SELECT count(*) FROM a ANTI JOIN b USING (chrom, pos)) AS only_a,
        (SELECT count(*) FROM b ANTI JOIN a USING (chrom, pos)) AS only_b""",
)
def _(s):
    return variants.venn_counts(s.calls, s.calls_b, ["chrom", "pos"])


@query(
    "single_qv",
    """WITH c AS (SELECT replace(replace(child, '/', ''), '|', '') AS g, CASE region_type WHEN 'A' THEN 'high-confidence' WHEN 'N' THEN 'not-lifted' ELSE 'lifted-not-hc' END AS w, vtype, vlen FROM trio),
      e AS (SELECT * FROM c WHERE g IN ('00', '11')),
      q AS (SELECT 'QV..snp..error..high-conf' AS label, sum(vlen) FILTER (vtype = 'O' AND w = 'high-confidence') AS bp FROM e UNION ALL SELECT 'QV..snp..error..hc-or-not-lifted', sum(vlen) FILTER (vtype = 'O' AND w <> 'lifted-not-hc') FROM e
        UNION ALL SELECT 'QV..all..error..high-conf', sum(vlen) FILTER (w = 'high-confidence') FROM e UNION ALL SELECT 'QV..all..error..hc-or-not-lifted', sum(vlen) FILTER (w <> 'lifted-not-hc') FROM e)
      SELECT label, CAST(bp AS BIGINT) AS bp, CAST(round_even(-10 * log10(bp / 6.4e9), 0) AS BIGINT) AS qv FROM q""",
)
def _(s):
    region = F.when(F.col("region_type") == "A", "high-confidence").when(F.col("region_type") == "N", "not-lifted").otherwise("lifted-not-hc")
    return variants.single_qv(s.trio.withColumn("region_type", region), gt="child", snp="O")

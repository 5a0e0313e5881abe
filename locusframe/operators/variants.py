"""Variant calls: filters, splits, set comparison, quality values and concordance."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import genotype_class, quality_value

# Genome sizes the two quality-value tables refer to.
GENOME_SIZE = 3_100_000_000
TRIO_GENOME_SIZE = 3_200_000_000


def filter_calls(df: DataFrame, qual: float, dp_lt: int | None = None, gq: float | None = None) -> DataFrame:
    """QUAL at least ``qual``; optionally depth below ``dp_lt`` and genotype quality at least ``gq``."""
    out = df.where(F.col("qual") >= qual)
    if dp_lt is not None:
        out = out.where(F.col("depth") < dp_lt)
    return out if gq is None else out.where(F.col("gq") >= gq)


def _alts() -> Column:
    return F.split("alt", ",")


def split_by_type(df: DataFrame, kind: str, min_alleles: int = 2, max_alleles: int = 2, min_alt_count: int = 0, gt: str = "gt") -> DataFrame:
    """Records with an allele of the type (``snp`` or ``indel``) and an allele number within the bounds."""
    tests = {
        "snp": F.exists(_alts(), lambda a: (F.length(a) == 1) & (F.length("ref") == 1)),
        "indel": F.exists(_alts(), lambda a: F.length(a) != F.length("ref")),
    }
    n_alleles = F.size(_alts()) + 1
    out = df.where(tests[kind] & (n_alleles >= min_alleles) & (n_alleles <= max_alleles))
    if min_alt_count:
        alleles = F.split(F.replace(F.col(gt), F.lit("|"), F.lit("/")), "/")
        out = out.where(F.size(F.filter(alleles, lambda a: ~a.isin("0", "."))) >= min_alt_count)
    return out


def split_by_genotype(df: DataFrame, genotype: str, gt: str = "gt") -> DataFrame:
    """Records with a ``hom`` or ``het`` genotype; missing genotypes are neither."""
    return df.where(genotype_class(F.col(gt)) == genotype.upper())


def calls_to_intervals(df: DataFrame, cls: str) -> DataFrame:
    """Half-open interval of the reference allele for class ``snvs``, ``ins`` or ``dels``."""
    tests = {
        "snvs": (F.length("ref") == 1) & F.forall(_alts(), lambda a: F.length(a) == 1),
        "ins": F.exists(_alts(), lambda a: F.length(a) > F.length("ref")),
        "dels": F.exists(_alts(), lambda a: F.length(a) < F.length("ref")),
    }
    start = (F.col("pos") - 1).cast("long")
    return df.where(tests[cls]).select("*", start.alias("start_pos"), (start + F.length("ref")).cast("long").alias("end_pos"))


def normalize_calls(df: DataFrame) -> DataFrame:
    """Drop calls with dn or dp in FILTER and round GQ, the second call field, to a whole number.

    A FORMAT whose second field is not GQ is an error.
    """
    fields = F.split("call", ":")
    named = F.split("format", ":")
    gq = F.when(F.try_element_at(named, F.lit(2)) == "GQ", F.bround(F.try_element_at(fields, F.lit(2)).cast("double")).cast("long").cast("string")).otherwise(
        F.raise_error(F.concat(F.lit("GQ not second in "), F.coalesce("format", F.lit("NULL"))))
    )
    call = F.concat_ws(":", F.concat(F.slice(fields, 1, 1), F.array(gq), F.expr("slice(split(call, ':'), 3, size(split(call, ':')))")))
    return df.where(~F.col("filter").contains("dn") & ~F.col("filter").contains("dp")).withColumn("call", call)


def normalize_counts(df: DataFrame) -> DataFrame:
    """Records read, dropped as dense cluster, dropped for depth, and kept."""
    dense = F.col("filter").contains("dn")
    deep = ~dense & F.col("filter").contains("dp")
    n = lambda test: F.coalesce(F.sum(F.when(test, 1)), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("records"), n(dense).alias("dense"), n(deep).alias("depth"), n(~dense & ~deep).alias("kept"))


def info_map(info: Column) -> Column:
    return F.str_to_map(info, F.lit(";"), F.lit("="))


def call_map(fmt: Column, call: Column) -> Column:
    return F.map_from_arrays(F.split(fmt, ":"), F.split(call, ":"))


def flatten_calls(df: DataFrame) -> DataFrame:
    """One typed row per call: sequence, interval, alleles, depth, lengths, variant type and genotype."""
    info = info_map(F.col("info"))
    kind = F.upper(info["TYPE"])
    start = (F.col("pos") - 1).cast("long")
    return df.select(
        F.col("chrom").alias("sequence"), "pos", start.alias("start_pos"), (start + F.length("ref")).cast("long").alias("end_pos"),
        F.bround("qual").cast("long").alias("qual"), F.col("ref").alias("ref_allele"), F.element_at(_alts(), 1).alias("alt_allele"),
        info["DP"].cast("long").alias("depth"), F.length("ref").cast("long").alias("region_length"), info["LEN"].cast("long").alias("variant_length"),
        "sample", F.when(kind == "SNP", "SNV").otherwise(kind).alias("var_type"),
        genotype_class(call_map(F.col("format"), F.col("call"))["GT"]).alias("genotype"),
    )


def genotypes(df: DataFrame, call: str = "call") -> DataFrame:
    """Genotype without separator (``N/A`` when missing), variant type and length; an unreadable length is -1."""
    gt = F.element_at(F.split(call, ":"), 1)
    clean = F.when(gt.contains("."), "N/A").otherwise(F.replace(F.replace(gt, F.lit("/"), F.lit("")), F.lit("|"), F.lit("")))
    info = info_map(F.col("info"))
    return df.select("*", clean.alias("genotype"), info["TYPE"].alias("var_type"), F.coalesce(info["LEN"].try_cast("long"), F.lit(-1)).cast("long").alias("length"))


#: Rows that meet in one task of ``isec`` on average.
MEET = 1 << 20


def isec(a: DataFrame, b: DataFrame, on: Sequence[str] = ("chrom", "pos", "ref", "alt")) -> dict[str, DataFrame]:
    """only_a, only_b, shared_a and shared_b by the key columns; shared rows come from the named side.

    Both sides are dealt out once by their keys, into tasks of about MEET rows whatever the size, and all four
    parts are joined there; the sides are counted for that.
    """
    on = list(on)
    tasks = max(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(a.count() + b.count()) // MEET))
    a, b = (df.repartition(tasks, *on) for df in (a, b))
    keys_a, keys_b = (df.select(*on).hint("merge") for df in (a, b))
    return {
        "only_a": a.join(keys_b, on, "left_anti"),
        "only_b": b.join(keys_a, on, "left_anti"),
        "shared_a": a.join(keys_b, on, "left_semi"),
        "shared_b": b.join(keys_a, on, "left_semi"),
    }


def merge_lifted(full: DataFrame, lifted: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join of all calls with the lifted ones; unlifted calls get ref_seq ``none``, 0 coordinates and false flags."""
    out = full.join(lifted, list(on), "full")
    filled = {"ref_seq": F.lit("none"), "ref_start": F.lit(0).cast("long"), "ref_end": F.lit(0).cast("long")}
    for c, v in filled.items():
        out = out.withColumn(c, F.coalesce(c, v))
    return out.withColumns({c: F.coalesce(F.col(c).cast("boolean"), F.lit(False)) for c in ("is_lifted", "is_highconf")})


_UNITS = {"": "true", "lifted_": "is_lifted", "unlifted_": "NOT is_lifted", "highconf_": "is_highconf"}


def variant_qv(df: DataFrame, min_depth: int = 3, genome_size: int = GENOME_SIZE) -> DataFrame:
    """Rows (key, value): counts, bases and percentages by variant and genotype, and six quality values.

    ``df`` has variant (snv, ins, del), genotype (hom, het), depth, variant_length, is_lifted, is_highconf.
    """
    deep = F.col("depth") >= min_depth
    aggs = [F.count(F.lit(1)).alias("raw_count"), F.coalesce(F.sum("variant_length"), F.lit(0)).alias("raw_length")]
    for name, test in _UNITS.items():
        hit = deep & F.expr(test)
        aggs += [
            F.coalesce(F.sum(F.when(hit, 1)), F.lit(0)).alias(f"{name}count"),
            F.coalesce(F.sum(F.when(hit, F.col("variant_length"))), F.lit(0)).alias(f"{name}length"),
        ]
    small = df.groupBy("variant", "genotype").agg(*aggs)
    names = [c for c in small.columns if c not in ("variant", "genotype")]
    cube = small.cube("variant", "genotype").agg(*[F.sum(c).alias(c) for c in names])
    pct = lambda a, b: F.bround(F.try_divide(a, b) * 100, 2)
    row = lambda key, value: F.struct(key.alias("key"), value.cast("double").alias("value"))
    label = F.concat_ws("_", "variant", "genotype")
    units = ["count", "length"]
    totals = F.array(
        *[row(F.lit(f"variants_total_{u}"), F.col(f"raw_{u}")) for u in units],
        *[row(F.lit(f"variants_total_DPgeq{min_depth}_{u}"), F.col(u)) for u in units],
    )
    both = F.array(*[row(F.concat(F.col("genotype"), F.lit(f"_{n}_{u}")), F.col(f"{n}_{u}")) for n in ("highconf", "unlifted") for u in units])
    plain = F.when(F.col("genotype").isNull(), F.lit("_total_")).otherwise(F.lit("_"))
    detail = F.array(
        *[row(F.concat(label, plain, F.lit(u)), F.col(u)) for u in units],
        *[row(F.concat(label, F.lit(f"_{n}_{u}")), F.col(f"{n}_{u}")) for n in ("lifted", "unlifted", "highconf") for u in units],
        row(F.concat(label, F.lit("_lifted_pct")), pct("lifted_count", "count")),
        row(F.concat(label, F.lit("_highconf_pct")), pct("highconf_count", "lifted_count")),
    )
    rows = F.when(F.col("variant").isNull() & F.col("genotype").isNull(), totals).when(F.col("variant").isNull(), both).otherwise(detail)
    table = cube.where("variant is not null or genotype is null or genotype = 'hom'").select(F.explode(rows).alias("r")).select("r.*")

    bases = lambda col, test: F.coalesce(F.sum(F.when((F.col("genotype") == "hom") & F.expr(test), F.col(col))), F.lit(0))
    groups = {"all": "true", "snv": "variant = 'snv'", "indels": "variant in ('ins', 'del')"}
    errors = small.agg(
        *[bases("highconf_length", t).alias(f"{g}_hom_highconf") for g, t in groups.items()],
        *[(bases("highconf_length", t) + bases("unlifted_length", t)).alias(f"{g}_hom_highconf|unlifted") for g, t in groups.items()],
    )
    items = []
    for c in errors.columns:
        bp = F.col(f"`{c}`")
        items += [row(F.lit(f"QV_{c}"), quality_value(bp, genome_size)), row(F.lit(f"QV_{c}_bp"), bp)]
    return table.unionByName(errors.select(F.explode(F.array(*items)).alias("r")).select("r.*"))


def _clean_gt(gt: str) -> Column:
    return F.when(F.col(gt).isNull() | F.col(gt).contains("."), "NA").otherwise(F.regexp_replace(gt, "[/|]", ""))


def trio_class(child: Column, mother: Column, father: Column) -> Column:
    """OK, ERROR, AMBIG or SKIP for genotypes such as ``01`` or ``NA``; a homozygous child is an error of the haploid assembly."""
    has = lambda a, parent: F.contains(parent, a)
    first, second = F.substring(child, 1, 1), F.substring(child, 2, 1)
    mendel = (has(first, mother) & has(second, father)) | (has(first, father) & has(second, mother))
    parents = (mother != "NA") & (father != "NA")
    return (
        F.when(child.isin("00", "11"), "ERROR")
        .when((child == "NA") & parents, "AMBIG")
        .when(child == "NA", "SKIP")
        .when(~parents | mendel, "OK")
        .otherwise("ERROR")
    )


def trio_classes(df: DataFrame) -> DataFrame:
    """Bases and records per class, genotype trio, variant type and region type, with ``any`` totals.

    Records without a length are SKIP and counted with 0 bases.
    """
    gts = [_clean_gt(c) for c in ("child", "mother", "father")]
    cls = F.when(F.coalesce("vlen", F.lit(-1)) < 0, "SKIP").otherwise(trio_class(*gts))
    rows = df.select(cls.alias("call_class"), F.concat_ws("-", *gts).alias("genotypes"), "vtype", "region_type", F.greatest(F.coalesce("vlen", F.lit(0)), F.lit(0)).alias("bp"))
    small = rows.groupBy("call_class", "genotypes", "vtype", "region_type").agg(F.sum("bp").alias("bp"), F.count(F.lit(1)).alias("n"))
    any_of = lambda c: F.explode(F.array(F.col(c), F.lit("any"))).alias(c)
    out = small.select("call_class", "genotypes", any_of("vtype"), "region_type", "bp", "n")
    out = out.select("call_class", "genotypes", "vtype", any_of("region_type"), "bp", "n")
    return out.groupBy("call_class", "genotypes", "vtype", "region_type").agg(F.sum("bp").alias("bp"), F.sum("n").alias("n"))


def trio_qv(df: DataFrame, snp: str = "snp", high: str = "high-confidence", unlifted: str = "not-lifted", genome_size: int = TRIO_GENOME_SIZE) -> DataFrame:
    """Rows (label, bp, qv): errors, optionally with ambiguous calls, of SNPs or all variants in two region selections."""
    classes = trio_classes(df).where("vtype <> 'any' and region_type <> 'any'")
    items = []
    for kind, is_kind in (("snp", F.col("vtype") == snp), ("all", F.lit(True))):
        for calls, names in (("error", ["ERROR"]), ("error_ambig", ["ERROR", "AMBIG"])):
            for where, regions in (("high-conf", [high]), ("hc-or-not-lifted", [high, unlifted])):
                hit = is_kind & F.col("call_class").isin(*names) & F.col("region_type").isin(*regions)
                items.append((f"QV..{kind}..{calls}..{where}", F.coalesce(F.sum(F.when(hit, F.col("bp"))), F.lit(0))))
    one = classes.agg(*[bp.alias(label) for label, bp in items])
    rows = F.array(*[F.struct(F.lit(c).alias("label"), F.col(f"`{c}`").alias("bp")) for c in one.columns])
    return one.select(F.explode(rows).alias("r")).select("r.*").withColumn("qv", quality_value(F.col("bp"), genome_size))


def single_qv(df: DataFrame, gt: str = "gt", snp: str = "snp", high: str = "high-confidence", unlifted: str = "not-lifted", genome_size: int = TRIO_GENOME_SIZE) -> DataFrame:
    """Rows (label, bp, qv) of one call set: a homozygous call is an error of the haploid assembly; no call is ambiguous.

    ``df`` has the genotype, vtype, region_type and vlen; records without a length are skipped.
    """
    clean = _clean_gt(gt)
    wrong = clean.isin("00", "11") & (F.col("vlen") >= 0)
    items = []
    for kind, is_kind in (("snp", F.col("vtype") == snp), ("all", F.lit(True))):
        for where, regions in (("high-conf", [high]), ("hc-or-not-lifted", [high, unlifted])):
            hit = wrong & is_kind & F.col("region_type").isin(*regions)
            items.append((f"QV..{kind}..error..{where}", F.coalesce(F.sum(F.when(hit, F.col("vlen"))), F.lit(0).cast("long"))))
    one = df.agg(*[bp.alias(label) for label, bp in items])
    rows = F.array(*[F.struct(F.lit(c).alias("label"), F.col(f"`{c}`").alias("bp")) for c in one.columns])
    return one.select(F.explode(rows).alias("r")).select("r.*").withColumn("qv", quality_value(F.col("bp"), genome_size))


def concordance(df: DataFrame, samples: Sequence[str], parents: tuple[str, str] | None = None) -> DataFrame:
    """Rows (metric, sample, n, pct) of how far genotype columns agree, and one row per call report.

    A genotype other than the majority (the first sample's without a majority) is a
    minority call unless more than two genotypes occur. Mendelian checks need parents.
    """
    needed = list(dict.fromkeys([*samples, *(parents or ())]))
    combos = df.groupBy(*needed).agg(F.count(F.lit(1)).alias("n"))
    alleles = lambda c: F.split(F.replace(F.col(c), F.lit("|"), F.lit("/")), "/")
    gts = F.array(*[F.array_sort(alleles(c)) for c in samples])
    rows = combos.withColumn("_gts", gts).withColumn("_kinds", F.array_distinct("_gts"))
    ranked = F.array_max(F.transform("_kinds", lambda d: F.struct(F.size(F.filter("_gts", lambda g: g == d)).alias("c"), d.alias("gt"))))
    rows = rows.withColumn("_top", ranked)
    rows = rows.withColumn("_major", F.when(F.col("_top.c") > len(samples) / 2, F.col("_top.gt")).otherwise(F.col("_gts")[0]))
    several = len(samples) > 1
    concordant = (F.size("_kinds") == 1) if several else F.lit(None).cast("boolean")
    discordant = (F.size("_kinds") > 2) if several else F.lit(None).cast("boolean")

    def mendel(gt: Column) -> Column:
        if parents is None:
            return F.lit(None).cast("boolean")
        mother, father = (alleles(p) for p in parents)
        fits = lambda x, y: F.array_contains(mother, x) & F.array_contains(father, y)
        return fits(gt[0], gt[1]) | fits(gt[1], gt[0])

    minority = lambda i: F.when(concordant, F.lit(False)).when(discordant, F.lit(None).cast("boolean")).otherwise(F.col("_gts")[i] != F.col("_major"))
    reports = [
        F.struct(F.lit(s).alias("sample"), mendel(alleles(s)).alias("mendel_ok"), (minority(i) if several else F.lit(None).cast("boolean")).alias("minority"))
        for i, s in enumerate(samples)
    ]
    rows = rows.select("n", concordant.alias("concordant"), discordant.alias("discordant"), mendel(F.col("_major")).alias("major_ok"), F.array(*reports).alias("reports"))
    long = rows.select("n", "concordant", "discordant", F.explode("reports").alias("r")).select("n", "concordant", "discordant", "r.*")
    total = F.coalesce(F.sum("n"), F.lit(0))
    count = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    part = lambda hits, of: F.round(F.try_divide(hits, of) * 100, 2)
    sites = rows.agg(
        total.alias("t"), count(F.col("concordant")).alias("all_concordant"), count(F.col("discordant")).alias("fully_discordant"), count(~F.col("major_ok")).alias("mendel_majority")
    )
    per_set = ["all_concordant", "fully_discordant"] + (["mendel_majority"] if parents and several else [])
    whole = sites.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("n"), part(F.col(c), F.col("t")).alias("pct")) for c in per_set])).alias("x")).select(
        "x.metric", F.lit("*").alias("sample"), "x.n", "x.pct"
    )
    by_sample = long.groupBy("sample").agg(total.alias("t"), count(F.col("minority")).alias("minority"), count(~F.col("mendel_ok")).alias("mendel_error"))
    per = ["minority"] + (["mendel_error"] if parents else [])
    single = by_sample.select("sample", F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("n"), part(F.col(c), F.col("t")).alias("pct")) for c in per])).alias("x")).select(
        "x.metric", "sample", "x.n", "x.pct"
    )
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    name = F.concat_ws(":", F.lit("report"), text("mendel_ok"), text("minority"), text("concordant"), text("discordant"))
    listed = long.groupBy("sample", name.alias("metric")).agg(F.sum("n").alias("n")).select("metric", "sample", "n", F.lit(None).cast("double").alias("pct"))
    return whole.unionByName(single).unionByName(listed)


def snv_stats(calls: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per sequence of the index: calls, calls per kb, mean and sample std of QUAL, depth and GQ, to 3 digits."""
    aggs = [F.count(F.lit(1)).alias("num")]
    for c in ("qual", "depth", "gq"):
        aggs += [F.bround(F.avg(c), 3).alias(f"{c}_mean"), F.bround(F.stddev_samp(c), 3).alias(f"{c}_stddev")]
    out = sizes.select("chrom", "size").join(calls.groupBy("chrom").agg(*aggs), "chrom", "left").fillna(0, ["num"])
    return out.withColumn("per_kbp", F.bround(F.try_divide(F.col("num"), F.col("size") / 1000), 3))


def call_set_stats(df: DataFrame, by: Sequence[str] = (), gt: str = "gt") -> DataFrame:
    """Records, SNPs, indels, and heterozygous and homozygous-alternative SNP calls."""
    snp = (F.length("ref") == 1) & F.exists(_alts(), lambda a: F.length(a) == 1)
    indel = F.exists(_alts(), lambda a: F.length(a) != F.length("ref"))
    cls = genotype_class(F.col(gt))
    n = lambda test: F.coalesce(F.sum(F.when(test, 1)), F.lit(0))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("records"), n(snp).alias("snps"), n(indel).alias("indels"),
        n(snp & (cls == "HET")).alias("het"), n(snp & (cls == "HOM") & ~F.col(gt).startswith("0")).alias("hom_alt"),
    )


def phasing_pct(df: DataFrame) -> DataFrame:
    """Share of phased among heterozygous SNVs, from the ALL row of each sample."""
    rows = df.where(F.col("chrom") == "ALL")
    return rows.withColumn("pct_phased", F.bround(F.try_divide("phased", "heterozygous") * 100, 2)).drop("chrom")


def match_sv_calls(overlaps: DataFrame, calls: DataFrame, svs: DataFrame) -> DataFrame:
    """Per overlapping call of the SV's type: is the sample a carrier, is the length equal, is the overlap the whole SV.

    ``overlaps`` has sv_id, call_id, overlap; ``calls`` call_id, sample, var_type, variant_length;
    ``svs`` sv_id, svtype, svlen, carriers (array).
    """
    rows = overlaps.where("overlap > 0").join(calls, "call_id").join(svs, "sv_id").where("svtype = var_type")
    full = lambda test: F.when(test, "full").otherwise("partial")
    return rows.select(
        "sv_id", "call_id", "sample", "var_type", "overlap", "variant_length", "svlen",
        F.when(F.array_contains("carriers", F.col("sample")), "match").otherwise("miss").alias("sample_match"),
        full(F.col("variant_length") == F.col("svlen")).alias("length_match"),
        full(F.col("overlap") == F.col("svlen")).alias("overlap_match"),
    )


def union_with_quality(good: DataFrame, bad: DataFrame) -> DataFrame:
    """Both call sets with quality 1 and 0."""
    return good.withColumn("quality", F.lit(1)).unionByName(bad.withColumn("quality", F.lit(0)))


def venn_counts(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``a`` shared with ``b``, rows only in ``a`` and rows only in ``b``."""
    both = a.select(*on, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(b.select(*on, F.lit(0).alias("a"), F.lit(1).alias("b")))
    keys = both.groupBy(*on).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    n = lambda col, test: F.coalesce(F.sum(F.when(F.expr(test), F.col(col))), F.lit(0))
    return keys.agg(n("a", "a > 0 and b > 0").alias("shared"), n("a", "b = 0").alias("only_a"), n("b", "a = 0").alias("only_b"))

"""Assembly evaluation: samples, breaks, regions of interest, completeness and annotation matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.columns import base_count, chromosome_rank, strand_code
from .distribution import n50, quantiles, running_in_order, top_n_per_group
from .lineage import written_once
from .overlap import overlap_join
from .sweep import (
    BLOCK, END, START, complement, interval_events, make_windows, merge_intervals, next_in_order, own_shuffle,
    running_sums, sum_by_position, uncovered, union_all,
)

ASSEMBLY = ["sample", "tech", "hap"]


#: Entries of a list that go out as one array.
CHUNK = 10_000


def with_each(df: DataFrame, few: DataFrame) -> DataFrame:
    """Every row of ``df`` beside every distinct row of ``few``, for results that list all combinations.

    ``few`` goes out as arrays of about CHUNK entries, one for a short list such as the assemblies;
    every row meets each array in an equi-join on its number. The list may have any length. It is the list that is
    broadcast, never the rows.
    """
    rows = few.distinct()
    n = F.greatest(F.lit(1), F.ceil(rows.agg(F.count(F.lit(1)) / CHUNK).scalar()))
    chunks = rows.groupBy(F.pmod(F.xxhash64(*few.columns), n).alias("_chunk")).agg(F.collect_list(F.struct(*few.columns)).alias("_all"))
    listed = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    return listed.join(F.broadcast(chunks), "_chunk").select(*df.columns, F.explode("_all").alias("_x")).select(*df.columns, "_x.*")


# --- samples and selections -------------------------------------------------


def with_sample(df: DataFrame, samples: DataFrame, key: str = "sample") -> DataFrame:
    """Attach the sample attributes; a sample without exactly one entry is an error."""
    attrs = [c for c in samples.columns if c != key]
    entries = samples.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(c) for c in attrs])
    out = df.join(entries, key, "left")
    wrong = F.concat(F.lit("sample without exactly one entry: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    checked = F.when(F.col("_n") == 1, F.col(key)).otherwise(F.raise_error(wrong))
    return out.withColumn(key, checked).drop("_n")


def consistency(df: DataFrame, samples: DataFrame, platforms: Sequence[str]) -> DataFrame:
    """Expected (sample, platform) pairs that are absent, and pairs present although the sample is skipped.

    ``samples`` has sample, skip and one 0/1 column per platform.
    """
    flags = F.explode(F.array(*[F.struct(F.lit(p).alias("platform"), F.col(p).alias("has")) for p in platforms])).alias("p")
    wanted = samples.select("sample", "skip", flags).select("sample", "skip", "p.platform", "p.has").where("has = 1")
    present = df.select("sample", "platform").distinct()
    missing = wanted.where("skip <> 1").join(present, ["sample", "platform"], "left_anti").select("sample", "platform", F.lit("missing").alias("problem"))
    extra = wanted.where("skip = 1").join(present, ["sample", "platform"], "left_semi").select("sample", "platform", F.lit("skipped").alias("problem"))
    return missing.unionByName(extra)


def filter_mapq(df: DataFrame, low: int = 0, high: int = 61) -> DataFrame:
    return df.where((F.col("mapq") >= low) & (F.col("mapq") < high))


def filter_chroms(df: DataFrame, regex: str = "chr[0-9X]+$") -> DataFrame:
    """Rows whose chromosome matches the pattern from its start."""
    return df.where(F.col("chrom").rlike(f"^(?:{regex})"))


def filter_flags(df: DataFrame, exclude: int, require: int = 0, min_mapq: int = 0) -> DataFrame:
    """No bit of ``exclude`` set, every bit of ``require`` set, mapq high enough."""
    flag = F.col("flag")
    return df.where((flag.bitwiseAND(F.lit(exclude)) == 0) & (flag.bitwiseAND(F.lit(require)) == require) & (F.col("mapq") >= min_mapq))


def filter_length(df: DataFrame, n: int, length: Column | None = None) -> DataFrame:
    return df.where((F.col(END) - F.col(START) if length is None else length) >= n)


def select_assemblies(
    df: DataFrame,
    samples: DataFrame,
    super_pops: Sequence[str] | None = None,
    sexes: Sequence[str] | None = None,
    techs: Sequence[str] | None = None,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
) -> DataFrame:
    """Alignments of the wanted populations, sexes, technologies and samples; skipped samples are left out.

    ``include`` and ``exclude`` are alternatives; an included sample that does not exist is an error.
    """
    if include is not None and exclude is not None:
        raise ValueError("include and exclude are alternatives")
    usable = samples.where("skip <> 1")
    if include is not None:
        known = {r[0] for r in usable.where(F.col("sample").isin(*include)).select("sample").distinct().collect()}
        if set(include) - known:
            raise ValueError(f"no such samples: {sorted(set(include) - known)}")
        usable = usable.where(F.col("sample").isin(*include))
    if exclude:
        usable = usable.where(~F.col("sample").isin(*exclude))
    for col, wanted in (("super_pop", super_pops), ("sex", sexes)):
        if wanted is not None:
            usable = usable.where(F.col(col).isin(*wanted))
    out = df if techs is None else df.where(F.col("tech").isin(*techs))
    return out.join(usable.select("sample", "super_pop", "sex"), "sample")


def prefer_tech(df: DataFrame, tech: str) -> DataFrame:
    """Of samples assembled with two technologies keep the preferred one."""
    per = df.groupBy("sample").agg((F.size(F.collect_set("tech")) > 1).alias("_two"))
    return df.join(per, "sample").where(~F.col("_two") | (F.col("tech") == tech)).drop("_two")


def build_alignment_table(bed: DataFrame, samples: DataFrame, chroms: DataFrame) -> DataFrame:
    """Alignments of all assemblies with population and sex, on known chromosomes, strand as a code."""
    known = bed.join(chroms.select("chrom"), "chrom", "left_semi")
    return with_sample(known, samples.select("sample", "super_pop", "sex")).withColumn("strand", strand_code(F.col("strand")))


def write_alignment_table(table: DataFrame, path: str) -> None:
    table.write.mode("errorifexists").partitionBy("super_pop", "tech").parquet(path)


def genomic_sort(df: DataFrame, numeric: bool = False) -> DataFrame:
    """By chromosome bytes, start and end; ``numeric`` puts chromosomes in number order, X and Y after them."""
    first = [F.asc_nulls_last(chromosome_rank(F.col("chrom"))), F.col("chrom")] if numeric else [F.col("chrom")]
    return df.orderBy(*first, START, END)


# --- breaks -----------------------------------------------------------------


def break_windows(windows: DataFrame, gaps: DataFrame, assembly: Sequence[str] = ASSEMBLY, min_breaks: int = 2) -> DataFrame:
    """Windows with the number of assemblies that have a gap in them, and whether that makes a break window."""
    key = ["chrom", START, END]
    # a gap counts where none before it of its assembly reaches into the window, so hits need not be made distinct
    before = W.partitionBy(*assembly, "chrom").orderBy(START, END).rowsBetween(W.unboundedPreceding, -1)
    first = gaps.select("chrom", START, END, F.max(END).over(before).alias("_reach"))
    # windows are listed from few rows, so their size is underrated: they must not go through the driver
    hits = overlap_join(windows.select(*key).distinct().hint("merge"), first, width=1 << 17).where(F.col("_reach_b").isNull() | (F.col("_reach_b") <= F.col(START)))
    per = hits.groupBy(*key).agg(F.count(F.lit(1)).alias("break_cov")).hint("merge")
    out = windows.join(per, key, "left").fillna(0, ["break_cov"])
    return out.withColumn("is_break", F.col("break_cov") >= min_breaks)


def break_regions(aln: DataFrame, sizes: DataFrame, width: int = 100_000, assembly: Sequence[str] = ASSEMBLY, label: str = "H64", chroms: str = "chr[0-9XY]+$") -> DataFrame:
    """Regions without alignment in some assembly, outside the windows where at most one assembly breaks.

    Taking the stable windows off every assembly's gaps and merging the rest over
    assemblies leaves the bases in any gap and in no stable window.
    """
    gaps = written_once(complement(aln, sizes, by=assembly))  # read for the windows and for the regions
    windows = break_windows(make_windows(sizes, width), gaps, assembly)
    regions = filter_chroms(uncovered(gaps, windows.where(~F.col("is_break"))), chroms)
    length = (F.col(END) - F.col(START)).cast("string")
    return regions.withColumn("name", F.concat_ws("-", "chrom", F.col(START).cast("string"), length, F.lit(label)))


# --- regions of interest ----------------------------------------------------


def _clipped(roi: DataFrame, aln: DataFrame, assembly: Sequence[str]) -> DataFrame:
    pairs = overlap_join(roi.select("chrom", START, END, F.col("name").alias("roi")), aln.select("chrom", START, END, "contig", *assembly))
    return pairs.select(
        *[F.col(f"{c}_b").alias(c) for c in assembly], "roi", F.col(START).alias("roi_start"), F.col(END).alias("roi_end"),
        F.col("contig_b").alias("contig"), F.greatest(START, f"{START}_b").alias(START), F.least(END, f"{END}_b").alias(END),
    )


def roi_blocks(roi: DataFrame, aln: DataFrame, assembly: Sequence[str] = ASSEMBLY, block: int = BLOCK) -> DataFrame:
    """Stretches of each region with no (gap), one (align) or several (multi) alignments, per assembly that hits the region."""
    key = [*assembly, "roi"]
    rows = _clipped(roi, aln, assembly)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    frame = rows.select(*key, F.col("roi_start").alias(START), F.col("roi_end").alias(END)).distinct()
    events = interval_events(rows, key).select(*key, "pos", "step", zero.alias("frame")).unionByName(
        interval_events(frame, key).select(*key, "pos", zero.alias("step"), one.alias("frame"))
    )
    run = running_sums(sum_by_position(events, key, ["step", "frame"]), key, ["step"], block=block)
    kind = lambda d: F.least(d, F.lit(2))
    edges = run.withColumn("kind", kind(F.col("cum_step"))).where((F.col("kind") != kind(F.col("cum_step") - F.col("step"))) | (F.col("frame") > 0))
    edges = next_in_order(edges.select(*key, "pos", "kind"), key, block=block).where("next_pos is not null")
    label = F.element_at(F.array(F.lit("gap"), F.lit("align"), F.lit("multi")), (F.col("kind") + 1).cast("int"))
    return edges.select(*key, label.alias("block_type"), F.col("pos").alias("block_start"), (F.col("next_pos") - F.col("pos")).alias("block_length"))


def roi_stats(roi: DataFrame, aln: DataFrame, assembly: Sequence[str] = ASSEMBLY, block: int = BLOCK) -> DataFrame:
    """Per assembly and region hit: covered and missing bases, share, contigs, and number, least, greatest and mean gap."""
    key = [*assembly, "roi"]
    contigs = _clipped(roi, aln, assembly).groupBy(*key).agg(F.countDistinct("contig").alias("contigs_count"))
    gap = F.col("block_type") == "gap"
    size = F.col("block_length")
    sums = roi_blocks(roi, aln, assembly, block).groupBy(*key).agg(
        F.coalesce(F.sum(F.when(~gap, size)), F.lit(0)).alias("coverage_bp"), F.coalesce(F.sum(F.when(gap, size)), F.lit(0)).alias("delta"),
        F.sum(F.when(gap, 1).otherwise(0)).alias("num_gaps"), F.coalesce(F.min(F.when(gap, size)), F.lit(0)).alias("min_gap"),
        F.coalesce(F.max(F.when(gap, size)), F.lit(0)).alias("max_gap"), F.coalesce(F.floor(F.avg(F.when(gap, size))), F.lit(0)).alias("avg_gap"),
    )
    pct = F.bround(F.col("coverage_bp") / (F.col("coverage_bp") + F.col("delta")) * 100, 2)
    return sums.join(contigs, key).withColumn("coverage_pct", pct)


def roi_hit_classes(stats: DataFrame, assembly: Sequence[str] = ASSEMBLY) -> DataFrame:
    """Assemblies that cover each region completely, in part or not at all; an assembly without a row misses it."""
    pct = F.col("coverage_pct")
    n = lambda test: F.coalesce(F.sum(F.when(test, 1)), F.lit(0))
    per = stats.groupBy("roi").agg(
        n(pct > 99.999).alias("complete"), n((pct > 0) & (pct < 99.999)).alias("partial"), n(pct < 0.0001).alias("zero"), F.count(F.lit(1)).alias("rows")
    )
    total = stats.select(*assembly).distinct().agg(F.count(F.lit(1))).scalar()
    return per.select("roi", "complete", "partial", (F.col("zero") + total - F.col("rows")).alias("missing"))


def alt_coverage(aln: DataFrame, sizes: DataFrame, min_mapq: int = 60, assembly: Sequence[str] = ASSEMBLY, suffix: str = "_alt") -> DataFrame:
    """Aligned contigs, merged bases and share per alternative contig and assembly; zeros where nothing aligns."""
    alt = sizes.where(F.col("chrom").endswith(suffix)).select("chrom", "size")
    rows = aln.where(F.col("mapq") >= min_mapq).join(alt.select("chrom"), "chrom", "left_semi")
    key = [*assembly, "chrom"]
    bp = merge_intervals(rows, by=key).groupBy(*key).agg(F.sum(F.col(END) - F.col(START)).alias("bp"))
    contigs = rows.groupBy(*key).agg(F.countDistinct("contig").alias("contigs"))
    out = with_each(alt, aln.select(*assembly)).join(bp, key, "left").join(contigs, key, "left").fillna(0, ["bp", "contigs"])
    return out.withColumn("pct", F.bround(F.col("bp") / F.col("size") * 100, 2))


def alt_thresholds(cov: DataFrame, thresholds: Sequence[int] = (50, 75, 90)) -> DataFrame:
    """Per threshold: contigs above it in any assembly, their bases, and median and greatest number of assemblies above."""
    t = F.explode(F.array(*[F.lit(x) for x in thresholds])).alias("threshold")
    per = cov.where(F.col("pct") > min(thresholds)).select("chrom", "size", "pct", t).where("pct > threshold")
    per = per.groupBy("threshold", "chrom", "size").agg(F.count(F.lit(1)).alias("assemblies"))
    out = per.groupBy("threshold").agg(F.count(F.lit(1)).alias("contigs"), F.sum("size").alias("bp"), F.max("assemblies").alias("max_assemblies"))
    median = quantiles(per, ["threshold"], "assemblies", {"median_assemblies": 0.5})
    return out.join(median, "threshold")


def alt_totals(cov: DataFrame, assembly: Sequence[str] = ASSEMBLY) -> DataFrame:
    """Per assembly: covered bases, share of all alternative contigs, and contigs covered to more than half."""
    out = cov.groupBy(*assembly).agg(
        F.sum("bp").alias("total_alt_cov"), F.sum("size").alias("_size"), F.sum(F.when(F.col("pct") > 50, 1).otherwise(0)).alias("num_alt_above50")
    )
    return out.withColumn("total_pct_cov", F.bround(F.col("total_alt_cov") / F.col("_size") * 100, 2)).drop("_size")


def concat_offsets(sizes: DataFrame) -> DataFrame:
    """Start and end of each contig when contigs are laid end to end by chromosome, size (longest first) and name.

    Offsets inside a chromosome, summed in ranges of the order, plus the total of the chromosomes before it.
    """
    rows = sizes.withColumn("rank", chromosome_rank(F.element_at(F.split("chrom", "_"), 1))).where("rank is not null")
    # one row for each of the few chromosomes
    before = W.partitionBy(F.lit(0)).orderBy("rank").rowsBetween(W.unboundedPreceding, -1)
    base = rows.groupBy("rank").agg(F.sum("size").alias("t")).select("rank", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("base"))
    out = running_in_order(rows.withColumn("_down", -F.col("size")), ["rank"], ["_down", "chrom"], "size", "stop").join(base, "rank")
    return out.select("chrom", "size", "rank", (F.col("base") + F.col("stop") - F.col("size")).alias("concat_start"), (F.col("base") + F.col("stop")).alias("concat_end"))


def region_set_coverage(cov: DataFrame, sets: Sequence[str], assembly: Sequence[str] = ASSEMBLY) -> DataFrame:
    """Covered bases and share of the set length per assembly, one column pair per region set."""
    sums = cov.groupBy(*assembly, "region_set").agg(F.sum("covered_bp").alias("bp"), F.sum("length").alias("length"))
    sums = sums.withColumn("pct", F.bround(F.try_divide("bp", "length") * 100, 2))
    return sums.groupBy(*assembly).pivot("region_set", list(sets)).agg(F.first("bp").alias("bp_covered"), F.first("pct").alias("pct_covered"))


def chromosome_classes(chrom: Column) -> Column:
    """``1-22``, ``X`` or ``Y``; any other chromosome is an error."""
    rank = chromosome_rank(chrom)
    return F.when(rank.between(1, 22), "1-22").when(rank == 23, "X").when(rank == 24, "Y").otherwise(
        F.raise_error(F.concat(F.lit("unexpected chromosome "), F.coalesce(chrom, F.lit("NULL"))))
    )


def length_summary(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per region set: regions, median, mean and total length, N50 and the chromosome classes."""
    rows = df.withColumn("length", (F.col(END) - F.col(START)).cast("long"))
    out = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("region_count"), F.floor(F.avg("length")).alias("mean_length"), F.sum("length").alias("total_length"),
        F.array_join(F.array_sort(F.collect_set(chromosome_classes(F.col("chrom")))), "").alias("chroms"),
    )
    median = quantiles(rows, by, "length", {"m": 0.5}).select(*by, F.floor("m").alias("median_length"))
    return out.join(median, list(by)).join(n50(rows, by, "length").withColumnRenamed("n50", "n50_length"), list(by))


def length_remainders(summary: DataFrame, key: str, base: str) -> DataFrame:
    """Total length of the ``base`` set minus that of every other set, and their ratio."""
    whole = summary.where(F.col(key) == base).select("total_length").scalar()
    rest = summary.where(F.col(key) != base).withColumn("_base", whole)
    return rest.select(key, (F.col("_base") - F.col("total_length")).alias("remaining"), F.bround(F.col("_base") / F.col("total_length"), 2).alias("ratio"))


def window_mean(cov: DataFrame, assembly: Sequence[str] = ASSEMBLY, platform: str = "tech") -> DataFrame:
    """Mean (over all assemblies of the platform, 3 digits, above 0) and median covered fraction per window and platform."""
    key = ["chrom", START, END, platform]
    length = F.col(END) - F.col(START)
    n = cov.select(*assembly).distinct().groupBy(platform).agg(F.count(F.lit(1)).alias("_n"))
    # one row per assembly in each group
    sums = cov.groupBy(*key).agg(F.sum("covered_bp").alias("_bp"), (F.percentile("covered_bp", 0.5)).alias("_median"))
    sums = sums.join(n, platform).withColumn("mean_fraction", F.bround(F.col("_bp") / (F.col("_n") * length), 3))
    return sums.withColumn("median_fraction", F.col("_median") / length).drop("_bp", "_n", "_median").where("mean_fraction > 0")


# --- sequences --------------------------------------------------------------


def nuc_profile(df: DataFrame, motif: str | None = None) -> DataFrame:
    """Per sequence: AT and GC share, counts of A, C, G, T, N and others, length and accessible percentage."""
    upper = F.upper("seq")
    n = {b: base_count(upper, b) for b in "ACGTN"}
    length = F.length("seq").cast("long")
    out = df.select("*", *[c.alias(f"bp_nuc{b}") for b, c in n.items()], length.alias("bp_length"))
    known = sum((F.col(f"bp_nuc{b}") for b in "CGTN"), F.col("bp_nucA"))
    share = lambda a, b: F.try_divide(F.col(f"bp_nuc{a}") + F.col(f"bp_nuc{b}"), F.col("bp_length"))
    out = out.withColumns({"bp_nucX": F.col("bp_length") - known, "pct_nucAT": share("A", "T"), "pct_nucGC": share("C", "G")})
    out = out.withColumn("accessible_pct", F.bround((F.col("pct_nucGC") + F.col("pct_nucAT")) * 100, 2))
    if motif is not None:
        out = out.withColumn("motif_count", F.try_divide(F.length("seq") - F.length(F.replace("seq", F.lit(motif), F.lit(""))), F.lit(len(motif))).cast("long"))
    return out


def region_sequences(regions: DataFrame, chunks: DataFrame, chunk: int) -> DataFrame:
    """Cut the sequence of each region out of a chunked reference (chrom, chunk_no, seq), ``chunk`` bases per row.

    Copies of a region share one sequence; no task holds more than one region.
    """
    key = ["chrom", START, END]
    start = F.col("chunk_no").cast("long") * chunk
    spans = chunks.select("chrom", start.alias(START), (start + F.length("seq")).alias(END), "seq")
    hits = overlap_join(regions.select(*key).distinct(), spans, width=chunk)
    lo = F.greatest(START, f"{START}_b")
    piece = F.substring("seq_b", (lo - F.col(f"{START}_b") + 1).cast("int"), F.col("bp").cast("int"))
    pieces = hits.groupBy(*own_shuffle(key)).agg(F.array_sort(F.collect_list(F.struct(lo.alias("at"), piece.alias("s")))).alias("p"))
    return regions.join(pieces.select(*key, F.array_join(F.transform("p", lambda x: x["s"]), "").alias("seq")), key, "left")


def region_type(name: Column) -> Column:
    """Gap, Variation, Unknown (before the first ``_``) or CEN, PAR, HET (first letters); anything else is an error."""
    word, letters = F.element_at(F.split(name, "_"), 1), F.substring(name, 1, 3)
    return F.when(word.isin("Gap", "Variation", "Unknown"), word).when(letters.isin("CEN", "PAR", "HET"), letters).otherwise(
        F.raise_error(F.concat(F.lit("no region type in "), F.coalesce(name, F.lit("NULL"))))
    )


def completeness(ovl: DataFrame, profile: DataFrame, assembly: Sequence[str] = ASSEMBLY) -> DataFrame:
    """Per region and assembly three rows: covered bases (count), share of the region (fraction), and how close
    the share is to the accessible one (accessible: 100 - |accessible - fraction|).

    ``ovl`` has one row per region and alignment with ``coverage`` bases; ``profile`` name and accessible_pct.
    """
    key = [*assembly, "chrom", START, END, "name"]
    sums = ovl.groupBy(*key).agg(F.sum("coverage").alias("bp")).join(profile.select("name", "accessible_pct"), "name", "left")
    frac = F.bround(F.col("bp") / (F.col(END) - F.col(START)) * 100, 2)
    access = 100 - F.bround(F.abs(F.col("accessible_pct") - frac), 2)
    stats = F.array(*[F.struct(F.lit(n).alias("stat_type"), v.cast("double").alias("coverage")) for n, v in (("count", F.col("bp")), ("fraction", frac), ("accessible", access))])
    return sums.select(*key, F.explode(stats).alias("s")).select(*key, "s.*")


def completeness_means(stats: DataFrame, kind: Column, assembly: Sequence[str] = ASSEMBLY) -> DataFrame:
    """Mean of every statistic of ``completeness`` by region type and assembly; ``kind`` gives the type of a region."""
    return stats.groupBy(kind.alias("region_type"), *assembly, "stat_type").agg(F.avg("coverage").alias("mean_coverage"), F.count(F.lit(1)).alias("regions"))


def read_completeness(avg: DataFrame, profile: DataFrame) -> DataFrame:
    """The same from region averages of a read depth track, with the mean depth over the region and over its covered bases."""
    rows = avg.join(profile.select("name", "accessible_pct"), "name", "left")
    frac = F.bround(F.col("covered") / F.col("size") * 100, 2)
    access = 100 - F.bround(F.abs(F.col("accessible_pct") - frac), 2)
    values = {"count": F.col("covered"), "fraction": frac, "accessible": access, "average": F.col("mean0"), "nz_avg": F.col("mean")}
    stats = F.array(*[F.struct(F.lit(n).alias("stat_type"), v.cast("double").alias("coverage")) for n, v in values.items()])
    keep = [c for c in avg.columns if c not in ("covered", "size", "mean0", "mean", "total")]
    return rows.select(*keep, F.explode(stats).alias("s")).select(*keep, "s.*")


# --- structural variants in assemblies --------------------------------------


def sv_alignment_ratio(df: DataFrame) -> DataFrame:
    """Add ``ratio``: 100 for an insertion with any aligned base, aligned share of the length for a deletion."""
    ins = F.when(F.col("bp_aln") > 0, 100.0).otherwise(0.0)
    return df.withColumn("ratio", F.when(F.col("svtype") == "INS", ins).otherwise(F.bround(F.try_divide("bp_aln", "svlen") * 100, 2)))


def sv_support(df: DataFrame) -> DataFrame:
    """Per SV type and platform, and over platforms (``any``): SVs missing in all haplotypes, in some, and poorly covered in all.

    Rows are (sv_id, svtype, platform, hap, ratio) of the carriers.
    """
    per = df.groupBy("sv_id", "svtype", "platform").agg(
        F.bool_and(F.col("ratio") == 0).alias("none"), F.bool_or(F.col("ratio") == 0).alias("some"), F.bool_and(F.col("ratio") < 50).alias("low")
    )
    n = lambda test: F.coalesce(F.sum(F.when(test, 1)), F.lit(0))
    low = n(F.col("low") & ~F.col("none") & (F.col("svtype") == "DEL"))
    aggs = [n(F.col("none")).alias("missing"), n(F.col("some") & ~F.col("none")).alias("partial"), low.alias("low_cov")]
    out = per.rollup("svtype", "platform").agg(*aggs).where("svtype is not null")
    return out.withColumn("platform", F.coalesce("platform", F.lit("any")))


def sv_read_support(df: DataFrame, depths: dict[str, int] | None = None) -> DataFrame:
    """SVs with low read support in any haplotype: insertions by depth (per platform), deletions below half covered."""
    limits = depths or {"HiFi": 10, "CLR": 30}
    limit = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])[F.col("platform")]
    low = F.when(F.col("svtype") == "INS", F.col("depth") < limit).otherwise(F.col("ratio") < 50)
    per = df.groupBy("sv_id", "svtype", "platform").agg(F.bool_or(low).alias("low"))
    return per.groupBy("svtype", "platform").agg(F.sum(F.col("low").cast("int")).alias("low_cov"))


def segment_concordance(segments: DataFrame, aln: DataFrame, by: Sequence[str] = ("chrom", "color"), ident: str = "segment") -> DataFrame:
    """Best-overlapping alignment of each segment; without one, the segment moved half its length left or right.

    support is 1 for a direct hit, 0 for a shifted one, -1 for none (mapq -1, strand 0).
    """
    half = F.floor((F.col(END) - F.col(START)) / 2)
    moved = segments.select(ident, *by, START, END, F.posexplode(F.array(F.lit(0).cast("long"), -half, half)).alias("_try", "_shift"))
    moved = moved.select(ident, *by, "_try", (F.col(START) + F.col("_shift")).alias(START), (F.col(END) + F.col("_shift")).alias(END))
    hits = overlap_join(moved, aln.select(*by, START, END, "mapq", "strand"), by=by)
    rank = F.struct("bp", (-F.col(f"{START}_b")).alias("s"), (-F.col(f"{END}_b")).alias("e"), "mapq_b")
    best = hits.groupBy(ident).agg(
        *[F.max(F.when(F.col("_try") == t, F.col("bp"))).alias(f"_bp{t}") for t in (0, 1, 2)],
        *[F.max_by(F.struct("mapq_b", "strand_b"), F.when(F.col("_try") == t, rank)).alias(f"_hit{t}") for t in (0, 1, 2)],
    )
    left = F.coalesce("_bp1", F.lit(0)) > F.coalesce("_bp2", F.lit(0))
    hit = F.when(F.col("_bp0").isNotNull(), F.col("_hit0")).when(left, F.col("_hit1")).otherwise(F.col("_hit2"))
    out = segments.join(best.withColumn("_hit", hit), ident, "left")
    support = F.when(F.col("_bp0").isNotNull(), 1).when(F.col("_hit").isNotNull(), 0).otherwise(-1)
    return out.select(
        *segments.columns, support.alias("support"), F.coalesce("_hit.mapq_b", F.lit(-1)).alias("mapq"),
        F.coalesce(strand_code(F.col("_hit.strand_b")), F.lit(0)).alias("strand"),
    )


# --- alignment tables -------------------------------------------------------


def contig_alignment_stats(
    aln: DataFrame, refs: DataFrame, contigs: DataFrame, group: str = "(cluster[0-9]+)", combine: Sequence[str] = (), min_mapq: int = 0, top: int = 3
) -> DataFrame:
    """Long table of aligned bases per reference sequence and contig group, with the rank of the ``top`` groups.

    The group is the first match of ``group`` in the contig name (the name itself
    without one); sequences in ``combine`` are also reported as one. Row
    ``genome`` sums all references and its group ``genome`` all contigs. ``cell``
    is ``bp|share of group|share of reference``.
    """
    named = lambda c: F.when(F.regexp_extract(c, group, 1) == "", F.col(c)).otherwise(F.regexp_extract(c, group, 1))
    joint = "".join(sorted(combine))
    ref_of = F.when(F.col("chrom").isin(*combine), joint).otherwise(F.col("chrom")) if combine else F.col("chrom")
    genome = lambda df, key: df.groupBy(F.lit("genome").alias(key)).agg(F.sum("size").alias("size"))
    ref_sizes = union_all(
        [refs.select(F.col("chrom").alias("ref"), "size")]
        + ([refs.where(F.col("chrom").isin(*combine)).groupBy(F.lit(joint).alias("ref")).agg(F.sum("size").alias("size"))] if combine else [])
        + [genome(refs, "ref")]
    )
    group_sizes = contigs.groupBy(named("contig").alias("grp")).agg(F.sum("size").alias("size"))
    group_sizes = group_sizes.unionByName(genome(contigs, "grp"))
    bp = aln.where(F.col("mapq") >= min_mapq).groupBy(ref_of.alias("ref"), named("contig").alias("grp")).agg(F.sum(F.col(END) - F.col(START)).alias("bp"))
    per_group = bp.groupBy(F.lit("genome").alias("ref"), "grp").agg(F.sum("bp").alias("bp"))
    whole = bp.groupBy(F.lit("genome").alias("ref"), F.lit("genome").alias("grp")).agg(F.sum("bp").alias("bp"))
    rows = union_all([bp, per_group, whole]).join(group_sizes.withColumnRenamed("size", "grp_size"), "grp").join(ref_sizes.withColumnRenamed("size", "ref_length"), "ref")
    pct = lambda of: F.bround(F.col("bp") / F.col(of) * 100, 2).cast("string")
    rows = rows.withColumn("cell", F.concat_ws("|", F.col("bp").cast("string"), pct("grp_size"), pct("ref_length")))
    best = top_n_per_group(rows.select("ref", "grp", "bp"), ["ref"], [F.desc("bp"), (F.col("grp") != "genome").cast("int"), F.col("grp")], top)
    rows = rows.join(best.drop("bp"), ["ref", "grp"], "left")
    shown = F.when(F.col("ref") == "genome", 1).otherwise(top)
    rows = rows.withColumn("top", F.when(F.col("rank") <= shown, F.concat_ws("|", "grp", "cell")))
    return ref_sizes.withColumnRenamed("size", "ref_length").join(rows.drop("ref_length"), "ref", "left").select("ref", "ref_length", "grp", "bp", "rank", "cell", "top")


def contig_alignment_table(stats: DataFrame, groups: Sequence[str], top: int = 3) -> DataFrame:
    """The same with one row per reference: best groups, then one cell per group, ``NA`` where empty."""
    tops = [F.max(F.when(F.col("rank") == i, F.col("top"))).alias(f"top{i}_alignment") for i in range(1, top + 1)]
    cells = [F.max(F.when(F.col("grp") == g, F.col("cell"))).alias(g) for g in groups]
    return stats.groupBy("ref", "ref_length").agg(*tops, *cells).fillna("NA")


def unpack_top(df: DataFrame, col: str = "top1_alignment") -> DataFrame:
    """Split ``name|bp|share|share``; nothing aligned gives ``no_align`` and zeros."""
    parts = F.split(F.when(F.col(col) == "NA", None).otherwise(F.col(col)), r"\|")
    at = lambda i: F.try_element_at(parts, F.lit(i))
    return df.select(
        "*", F.coalesce(at(1), F.lit("no_align")).alias("group"), F.coalesce(at(2).cast("long"), F.lit(0)).alias("aligned_bp"),
        F.coalesce(at(3).cast("double"), F.lit(0.0)).alias("group_pct"), F.coalesce(at(4).cast("double"), F.lit(0.0)).alias("ref_pct"),
    )


# --- annotation matrix ------------------------------------------------------

REGION = ["chrom", START, END, "name"]


def _features(df: DataFrame, sample: Column, platform: Column, hap: Column, name: Column, values: dict[str, Column]) -> DataFrame:
    items = F.array(*[F.struct(F.lit(k.split("_")[0]).alias("unit"), F.lit(k.split("_")[1]).alias("statistic"), v.cast("double").alias("value")) for k, v in values.items()])
    head = [sample.alias("sample"), platform.alias("platform"), hap.cast("string").alias("haplotype"), name.alias("feature")]
    return df.select(*REGION, *head, F.explode(items).alias("f")).select(*REGION, "sample", "platform", "haplotype", "feature", "f.*")


def coverage_features(cov: DataFrame, sample: Column, platform: Column, hap: Column, name: Column) -> DataFrame:
    """Covered bases and share of ``coverage`` output."""
    return _features(cov, sample, platform, hap, name, {"bp_coverage": F.col("covered_bp"), "pct_coverage": F.col("fraction")})


def score_features(scores: DataFrame, sample: Column, name: Column) -> DataFrame:
    """Identity share of a mean score in thousandths, 0 without one."""
    return _features(scores, sample, F.lit("REF"), F.lit(0), name, {"pct_seqid": F.coalesce("mean_score", F.lit(0.0)) / 1000})


def nuc_features(profile: DataFrame, sample: Column) -> DataFrame:
    """Base counts, their shares to 3 digits, and AT and GC shares of ``nuc_profile`` output."""
    values = {"pct_nucAT": F.col("pct_nucAT"), "pct_nucGC": F.col("pct_nucGC"), "bp_length": F.col("bp_length")}
    for b in "ACGTNX":
        values[f"bp_nuc{b}"] = F.col(f"bp_nuc{b}")
        values[f"pct_nuc{b}"] = F.bround(F.try_divide(f"bp_nuc{b}", "bp_length"), 3)
    return _features(profile, sample, F.lit("REF"), F.lit(0), F.lit("nucprof"), values)


def read_features(avg: DataFrame, sample: Column, platform: Column, hap: Column) -> DataFrame:
    """Covered bases and both mean depths of ``region_average`` output."""
    return _features(avg, sample, platform, hap, F.lit("read_cov"), {"bp_coverage": F.col("covered"), "avg_depth": F.col("mean0"), "avg_nzdepth": F.col("mean")})


def annotation_matrix(features: Sequence[DataFrame], labels: Sequence[str] | None = None) -> DataFrame:
    """One row per region, one column per (sample, platform, haplotype, feature, unit, statistic), joined by ``_``.

    The parts are stacked and pivoted once, so the cost does not depend on the number of parts joined.
    """
    long = union_all(list(features)).withColumn("label", F.concat_ws("_", "sample", "platform", "haplotype", "feature", "unit", "statistic"))
    grouped = long.groupBy(*REGION)
    pivoted = grouped.pivot("label", list(labels)) if labels is not None else grouped.pivot("label")
    return pivoted.agg(F.first("value"))


def membership_counts(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Rows per combination of boolean memberships."""
    return df.select(*[F.coalesce(c, F.lit(False)).alias(n) for n, c in flags.items()]).groupBy(*flags).agg(F.count(F.lit(1)).alias("n"))


def priority_filter(df: DataFrame, selectors: Sequence[str], threshold: float = 0.1) -> DataFrame:
    """Per selector column: rows above the threshold, rows for which it is the first such selector, and their share."""
    hit = {s: F.coalesce(F.col(s) > threshold, F.lit(False)) for s in selectors}
    first = F.coalesce(*[F.when(hit[s], F.lit(s)) for s in selectors])
    one = df.withColumn("_first", first).agg(
        F.count(F.lit(1)).alias("total"), *[F.sum(hit[s].cast("int")).alias(f"raw_{s}") for s in selectors],
        *[F.sum(F.when(F.col("_first") == s, 1).otherwise(0)).alias(f"first_{s}") for s in selectors],
    )
    rows = F.array(*[F.struct(F.lit(s).alias("selector"), F.col(f"raw_{s}").alias("raw"), F.col(f"first_{s}").alias("prio_filtered")) for s in selectors])
    out = one.select("total", F.explode(rows).alias("r")).select("r.*", "total")
    return out.withColumn("pct", F.bround(F.try_divide("prio_filtered", "total") * 100, 2)).drop("total")


def label_pairs(pairs: DataFrame, samples: DataFrame) -> DataFrame:
    """Kind of each pair of assemblies: 4 other haplotype of a sample, 2 same family, 1 other technology of a sample, else 3."""
    family = lambda s: samples.select(F.col("sample").alias(f"sample_{s}"), F.col("family").alias(f"family_{s}"))
    rows = pairs.join(family("a"), "sample_a", "left").join(family("b"), "sample_b", "left")
    same = F.col("sample_a") == F.col("sample_b")
    kind = (
        F.when(same & (F.col("hap_a") != F.col("hap_b")), 4)
        .when(~same & (F.col("family_a") == F.col("family_b")), 2)
        .when(same & (F.col("tech_a") != F.col("tech_b")), 1)
        .otherwise(3)
    )
    return rows.withColumn("comparison", kind)


# --- report summaries -------------------------------------------------------

# Fixed value: genes in the annotation the gene shares refer to.
TOTAL_GENES = 60603


def report_summary(df: DataFrame, platform: str, values: Sequence[str], n50_col: str = "n50", limits: Sequence[int] = (30_000_000, 35_000_000)) -> DataFrame:
    """Per platform: mean and median of each value (1 digit) and the share of assemblies with an N50 above each limit."""
    out = df.groupBy(platform).agg(
        *[F.bround(F.avg(v), 1).alias(f"mean_{v}") for v in values],
        *[F.bround(F.avg((F.col(n50_col) > x).cast("int")) * 100, 1).alias(f"pct_n50_above_{x}") for x in limits],
    )
    for v in values:
        out = out.join(quantiles(df, [platform], v, {f"median_{v}": 0.5}).withColumn(f"median_{v}", F.bround(f"median_{v}", 1)), platform)
    return out


def gene_pct(col: Column, total: int = TOTAL_GENES) -> Column:
    return F.bround(col / total * 100, 2)


def two_sample_tests(df: DataFrame, group: str, a, b, value: str) -> DataFrame:
    """Welch's t with its degrees of freedom, and Bartlett's statistic for equal variances of two groups.

    Everything follows from the count, mean and variance of each group.
    """
    part = lambda label, fn, name: fn(F.when(F.col(group) == label, F.col(value).cast("double"))).alias(name)
    one = df.agg(
        part(a, F.count, "n_a"), part(b, F.count, "n_b"), part(a, F.avg, "mean_a"), part(b, F.avg, "mean_b"),
        part(a, F.var_samp, "var_a"), part(b, F.var_samp, "var_b"),
    )
    sa, sb = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    da, db = F.col("n_a") - 1, F.col("n_b") - 1
    pooled = (da * F.col("var_a") + db * F.col("var_b")) / (da + db)
    top = (da + db) * F.log(pooled) - (da * F.log("var_a") + db * F.log("var_b"))
    below = 1 + (1 / da + 1 / db - 1 / (da + db)) / 3
    return one.withColumns({
        "welch_t": (F.col("mean_a") - F.col("mean_b")) / F.sqrt(sa + sb),
        "welch_df": (sa + sb) * (sa + sb) / (sa * sa / da + sb * sb / db),
        "bartlett": top / below,
    })

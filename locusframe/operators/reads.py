"""Statistics of reads, haplotag lists and read sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.columns import base_count
from .distribution import same_keys
from .sweep import BLOCK, own_shuffle, running_sums

# The coverage thresholds reported for long and for short reads.
LONG_READ_STEPS = [0, 1000, *range(5000, 55000, 5000)]
SHORT_READ_STEPS = list(range(0, 325, 25))
BASES = ["A", "C", "G", "T", "a", "c", "g", "t", "N", "n"]


def read_profile(reads: DataFrame) -> DataFrame:
    """Per read: length, count of every base letter, of anything else, and the GC share to 3 digits."""
    length = F.length("seq").cast("long")
    counts = {b: base_count(F.col("seq"), b) for b in BASES}
    other = length - sum(counts.values(), F.lit(0))
    gc = F.bround(F.try_divide(counts["G"] + counts["C"], length), 3)
    return reads.select(
        "*", length.alias("length"), *[c.alias(f"n_{'lower_' if b.islower() else ''}{b}") for b, c in counts.items()],
        other.cast("long").alias("n_other"), gc.alias("gc"),
    )


def read_statistics(reads: DataFrame) -> DataFrame:
    """Histograms (kind, key, n): read lengths, bases, GC in 1 % bins (the last one includes 1), and the read count."""
    profile = read_profile(reads)
    base_cols = [c for c in profile.columns if c.startswith("n_")]
    gc_bin = F.when(F.col("gc").isNotNull(), (F.least(F.floor(F.col("gc") * 100 + 1e-9), F.lit(99)) + 1).cast("string"))
    once = F.lit(1).cast("long")
    items = [F.struct(F.lit("length").alias("kind"), F.col("length").cast("string").alias("key"), once.alias("n"))]
    items += [F.struct(F.lit("gc_bin").alias("kind"), F.coalesce(gc_bin, F.lit("none")).alias("key"), once.alias("n"))]
    items += [F.struct(F.lit("reads").alias("kind"), F.lit("all").alias("key"), once.alias("n"))]
    items += [F.struct(F.lit("base").alias("kind"), F.lit(c[2:]).alias("key"), F.col(c).alias("n")) for c in base_cols]
    long = profile.select(F.explode(F.array(*items)).alias("i")).select("i.*").where("n > 0")
    return long.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def length_histogram(reads: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return reads.groupBy(*by, F.length("seq").cast("long").alias("length")).agg(F.count(F.lit(1)).alias("n"))


def read_summary(hist: DataFrame, genome_size: int, block: int = BLOCK, long_from: int | None = 1000) -> DataFrame:
    """Rows (key, value) from a length histogram (length, n): counts, bases, length statistics and coverage.

    Median and N50 are the smallest length whose share of reads (of bases), longest
    first, is at most one half; NULL when the longest length already exceeds it. Coverage is
    listed at the steps for long reads where the mean length is at least ``long_from``, else at
    those for short reads; at the steps of both where it is None.
    """
    hist = hist.select(F.lit(0).alias("_k"), "length", "n", (F.col("length") * F.col("n")).alias("bp"), (-F.col("length")).alias("down"))
    run = running_sums(hist, ["_k"], ["n", "bp"], pos="down", block=block)
    total = hist.groupBy("_k").agg(F.sum("n").alias("reads"), F.sum("bp").alias("total_bp"))
    run = run.join(total, "_k")
    at_least = [
        F.coalesce(F.sum(F.when(F.col("length") >= s, F.col("bp"))), F.lit(0)).alias(f"geq_{s}")
        for s in sorted({*LONG_READ_STEPS, *SHORT_READ_STEPS})
    ]
    one = run.agg(
        F.max("reads").alias("reads"),
        F.max("total_bp").alias("total_bp"),
        F.min("length").alias("shortest"),
        F.max("length").alias("longest"),
        F.min(F.when(2 * F.col("cum_n") <= F.col("reads"), F.col("length"))).alias("median"),
        F.min(F.when(2 * F.col("cum_bp") <= F.col("total_bp"), F.col("length"))).alias("n50"),
        *at_least,
    )
    mean = F.col("total_bp") / F.col("reads")
    cover = lambda bp: F.bround(bp / F.lit(float(genome_size)), 2)
    row = lambda key, value: F.struct(F.lit(key).alias("key"), value.cast("double").alias("value"))
    basic = F.array(
        row("num_reads", F.col("reads")),
        row("total_seq_bp", F.col("total_bp")),
        row("total_seq_Gbp", F.bround(F.col("total_bp") / 1e9, 2)),
        row("genome_size_bp", F.lit(genome_size)),
        row("genome_size_Gbp", F.bround(F.lit(genome_size / 1e9), 2)),
        row("read_length_min", F.col("shortest")),
        row("read_length_median", F.col("median")),
        row("read_length_mean", F.floor(mean)),
        row("read_length_max", F.col("longest")),
        row("read_length_N50", F.col("n50")),
        row("cov_total", cover(F.col("total_bp"))),
    )
    steps = lambda numbers: F.array(*[row(f"cov_geq_{s}", cover(F.col(f"geq_{s}"))) for s in numbers])
    if long_from is None:
        coverage = steps(sorted({*SHORT_READ_STEPS, *LONG_READ_STEPS}))
    else:
        coverage = F.when(mean < long_from, steps(SHORT_READ_STEPS)).otherwise(steps(LONG_READ_STEPS))
    return one.where("reads is not null").select(F.explode(F.concat(basic, coverage)).alias("r")).select("r.*")


def pick_min_length(summary: DataFrame, target: float) -> DataFrame:
    """Length threshold whose coverage is nearest the target, the smaller on ties."""
    geq = summary.where(F.col("key").startswith("cov_geq_"))
    length = F.regexp_extract("key", "([0-9]+)$", 1).cast("long")
    rank = F.struct(F.abs(F.bround(F.col("value") - target, 1)).alias("delta"), length.alias("length"))
    return geq.agg(F.min_by(length, rank).alias("min_read_length"))


def bases_at_least(hist: DataFrame, by: Sequence[str] = (), step: int = 500, last: int | None = 100_000) -> DataFrame:
    """Bases in reads of at least each multiple of ``step`` up to ``last``; a threshold with no bases is 0.

    Without ``last`` the multiples go up to the longest read of the table.
    """
    top = hist.agg(F.max("length")).scalar() if last is None else F.lit(last)
    floor_bin = F.floor(F.least(F.col("length"), top) / step).cast("long")
    bins = hist.groupBy(*by, floor_bin.alias("bin")).agg(F.sum(F.col("length") * F.col("n")).alias("bp"))
    # last / step + 1 bins per group, made dense before the running sum
    dense = bins.select(*by).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(top / step).cast("long"))))
    bins = dense.join(bins, [*by, "bin"], "left").fillna(0, ["bp"])
    window = W.partitionBy(*by, *([] if by else [F.lit(0)])).orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, 0)
    return bins.select(*by, (F.col("bin") * step).alias("min_length"), F.sum("bp").over(window).alias("bp"))


def read_length_bins(hist: DataFrame, lowest: int, highest: int, step: int, by: Sequence[str] = ()) -> DataFrame:
    """Bases and reads per length bin: below ``lowest``, steps up to ``highest``, and one open bin; empty bins included."""
    bounds = [0, lowest, *range(lowest + step, highest + step, step)]
    index = F.when(F.col("length") < lowest, F.lit(0)).otherwise(
        F.least(F.floor((F.col("length") - lowest) / step) + 1, F.lit(len(bounds) - 1))
    )
    counts = hist.groupBy(*by, index.cast("int").alias("bin")).agg(F.sum(F.col("length") * F.col("n")).alias("bp"), F.sum("n").alias("reads"))
    listed = hist.select(*by).distinct().select(*by, F.posexplode(F.array(*[F.lit(b).cast("long") for b in bounds])).alias("bin", "lower"))
    out = listed.join(counts, [*by, "bin"], "left").fillna(0, ["bp", "reads"])
    return out.select(*by, "lower", "bp", "reads")


def length_percentiles(hist: DataFrame, by: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """Smallest length with a cumulative read share above 25, 50, 75 and 95 %."""
    keys = list(by) or ["_all"]
    rows = hist if by else hist.withColumn("_all", F.lit(0))
    run = running_sums(rows, keys, ["n"], pos="length", block=block)
    run = run.join(rows.groupBy(*keys).agg(F.sum("n").alias("total")), keys)
    found = [F.min(F.when(F.col("cum_n") / F.col("total") > p / 100, F.col("length"))).alias(f"p{p}") for p in (25, 50, 75, 95)]
    return run.groupBy(*keys).agg(*found).drop("_all")


def mark_duplicates(rows: DataFrame, key: Sequence[str], score: str, ident: str) -> DataFrame:
    """Add ``duplicate``: not the best-scoring row of its key (ties: the smaller ``ident`` is kept).

    The best of a key is an aggregate, so a key with very many rows is reduced before the shuffle.
    """
    rank = F.struct((-F.col(score)).alias("s"), F.col(ident).alias("i"))
    best = rows.groupBy(*key).agg(F.min(rank).alias("_best"))
    return same_keys(rows, best, key).withColumn("duplicate", rank > F.col("_best")).drop("_best")


def haplotag_summary(tags: DataFrame) -> DataFrame:
    """One row: reads, counts and shares of H1, H2 and untagged; any other label is an error."""
    known = F.col("haplotype").isin("H1", "H2", "none")
    checked = tags.withColumn("haplotype", F.when(known, F.col("haplotype")).otherwise(
        F.raise_error(F.concat(F.lit("unexpected haplotype "), F.coalesce(F.col("haplotype").cast("string"), F.lit("NULL"))))
    ))
    n = lambda label: F.coalesce(F.sum(F.when(F.col("haplotype") == label, 1)), F.lit(0))
    one = checked.agg(F.count("haplotype").alias("num_reads"), n("H1").alias("num_hap1"), n("H2").alias("num_hap2"), n("none").alias("num_untagged"))
    pct = lambda c: F.bround(F.try_divide(c, "num_reads") * 100, 2)
    one = one.withColumns({"percent_hap1": pct("num_hap1"), "percent_hap2": pct("num_hap2"), "percent_untagged": pct("num_untagged")})
    return one.withColumn("percent_tagged", F.bround(F.col("percent_hap1") + F.col("percent_hap2"), 2))


def label_overlaps(tags: DataFrame) -> DataFrame:
    """Read names listed under two labels: H1 and H2, H1 and none, H2 and none."""
    has = lambda label: F.max((F.col("haplotype") == label).cast("int"))
    names = tags.groupBy("name").agg(has("H1").alias("h1"), has("H2").alias("h2"), has("none").alias("h0"))
    both = lambda a, b: F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0)).cast("long")
    return names.agg(both("h1", "h2").alias("h1_h2"), both("h1", "h0").alias("h1_h0"), both("h2", "h0").alias("h2_h0"))


def split_by_haplotag(reads: DataFrame, tags: DataFrame) -> DataFrame:
    """Reads with a tag, labelled H1, H2 or none; labels outside the largest phase set of a chromosome become none.

    Reads absent from the tag list are dropped.
    """
    sizes = tags.where("haplotype <> 'none'").groupBy("chrom", "phaseset").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("chrom").agg(F.min_by("phaseset", F.struct(-F.col("n"), F.col("phaseset"))).alias("largest"))
    labels = tags.join(largest, "chrom", "left").select(
        "name", "chrom", F.when(F.col("phaseset") == F.col("largest"), F.col("haplotype")).otherwise("none").alias("haplotype")
    )
    return reads.join(labels, "name")


def sequence_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per set: sequences, distinct ones, repeated ones, and the share of distinct sequences and bases found in the other set."""
    hashed = a.select(F.lit("a").alias("side"), "seq").unionByName(b.select(F.lit("b").alias("side"), "seq"))
    hashed = hashed.select("side", F.sha2("seq", 256).alias("hash"), F.length("seq").cast("long").alias("len"))
    n = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, 1)), F.lit(0))
    per_hash = hashed.groupBy("hash", "len").agg(n("a").alias("n_a"), n("b").alias("n_b"))
    shared = (F.col("n_a") > 0) & (F.col("n_b") > 0)
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"n_{s}").alias("n")) for s in "ab"])).alias("x")
    rows = per_hash.select("len", shared.alias("shared"), sides).where("x.n > 0")
    out = rows.groupBy("x.side").agg(
        F.sum("x.n").alias("sequences"),
        F.count(F.lit(1)).alias("distinct_sequences"),
        F.sum("len").alias("bp"),
        F.coalesce(F.sum(F.when(F.col("shared"), 1)), F.lit(0)).alias("shared"),
        F.coalesce(F.sum(F.when(F.col("shared"), F.col("len"))), F.lit(0)).alias("shared_bp"),
    )
    return out.select(
        "side", "sequences", "distinct_sequences", (F.col("sequences") - F.col("distinct_sequences")).alias("duplicates"),
        F.bround(F.col("shared") / F.col("distinct_sequences") * 100, 2).alias("shared_pct"),
        F.bround(F.try_divide("shared_bp", "bp") * 100, 2).alias("shared_bp_pct"),
    )


def duplicate_sequences(seqs: DataFrame) -> DataFrame:
    """Names of the sequences whose content also appears under another name, with the number of copies."""
    hashed = seqs.select("name", F.sha2("seq", 256).alias("hash"))
    copies = hashed.groupBy(*own_shuffle(["hash"])).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    return hashed.join(copies.drop("_own"), "hash").select("name", "copies")


def read_name_checks(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: reads and repeated names of two sets, and names in both (0 when disjoint)."""
    names = a.select("name", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(b.select("name", F.lit(0).alias("a"), F.lit(1).alias("b")))
    per = names.groupBy("name").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return per.agg(
        F.sum("a").alias("reads_a"), F.sum("b").alias("reads_b"),
        F.sum(F.greatest(F.col("a") - 1, F.lit(0))).alias("repeated_a"), F.sum(F.greatest(F.col("b") - 1, F.lit(0))).alias("repeated_b"),
        F.sum(F.when((F.col("a") > 0) & (F.col("b") > 0), 1).otherwise(0)).cast("long").alias("shared"),
    )


def coverage_stats(hist: DataFrame, lengths: DataFrame, cap: int | None = None, n_inputs: int = 1) -> DataFrame:
    """Mean, population std, covered and uncovered bases per sequence of a depth histogram (seq, depth, count).

    With ``cap``, depths above it count as ``cap``; bases without depth come from the length.
    """
    depth = (F.col("depth") if cap is None else F.least("depth", F.lit(cap))).cast("double")
    sums = hist.where("depth > 0").groupBy("seq").agg(
        F.sum("count").alias("covered"), F.sum(depth * F.col("count")).alias("s1"), F.sum(depth * depth * F.col("count")).alias("s2")
    )
    out = lengths.select("seq", "length").join(sums, "seq", "left").fillna(0, ["covered", "s1", "s2"])
    n = F.col("length") * n_inputs
    mean = F.try_divide("s1", n)
    std = F.sqrt(F.greatest(F.try_divide("s2", n) - mean * mean, F.lit(0.0)))
    return out.select(
        "seq", "length", F.bround(mean, 2).alias("cov_mean"), F.bround(std, 2).alias("cov_std"),
        F.bround(F.col("covered") / n_inputs).cast("long").alias("bp_nonzero"), (n - F.col("covered")).alias("bp_zero"),
    )


def genome_wide_coverage(stats: DataFrame) -> DataFrame:
    """Length-weighted mean and std of the per-sequence means."""
    w = F.col("length").cast("double")
    one = stats.agg(
        F.sum("length").alias("length"), F.sum("bp_nonzero").alias("bp_nonzero"),
        F.sum(w * F.col("cov_mean")).alias("s1"), F.sum(w * F.col("cov_mean") * F.col("cov_mean")).alias("s2"),
    )
    mean = F.col("s1") / F.col("length")
    std = F.sqrt(F.greatest(F.col("s2") / F.col("length") - mean * mean, F.lit(0.0)))
    return one.select("length", F.bround(mean, 2).alias("cov_mean"), F.bround(std, 2).alias("cov_std"), "bp_nonzero")


def caller_depth_limit(mean: Column, std: Column, sd: float = 3, limit: int | None = 200) -> Column:
    """mean + sd * std as a whole number of at least 1, and at most ``limit`` where one is given."""
    depth = F.greatest(F.bround(mean + sd * std), F.lit(1))
    return (depth if limit is None else F.least(depth, F.lit(limit))).cast("long")


def weighted_mean(df: DataFrame, keys: Sequence[str], value: str, weight: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight)).alias(name))


def assembly_size_stats(seqs: DataFrame, min_size: int) -> DataFrame:
    """Rows (key, value): share of A, C, G, T among ACGTN and bases, with share, in contigs of half, one and two times ``min_size``."""
    length = F.length("seq").cast("long")
    rows = seqs.select(length.alias("len"), *[base_count(F.col("seq"), b).alias(b) for b in "ACGTN"])
    bounds = [min_size // 2, min_size, 2 * min_size]
    one = rows.agg(
        F.sum("len").alias("total"), *[F.sum(b).alias(b) for b in "ACGTN"],
        *[F.coalesce(F.sum(F.when(F.col("len") >= b, F.col("len"))), F.lit(0)).alias(f"geq_{b}") for b in bounds],
    )
    known = sum((F.col(b) for b in "CGTN"), F.col("A"))
    row = lambda key, value: F.struct(F.lit(key).alias("key"), value.cast("double").alias("value"))
    items = [row(f"nucleotide_fraction_{b}", F.bround(F.try_divide(F.col(b), known), 3)) for b in "ACGT"]
    items += [row("sequence_bp_total", F.col("total"))]
    for b in bounds:
        items += [row(f"sequence_bp_geq_{b}", F.col(f"geq_{b}")), row(f"sequence_fraction_geq_{b}", F.bround(F.try_divide(f"geq_{b}", "total"), 3))]
    return one.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def size_regions(sizes: DataFrame, min_size: int) -> DataFrame:
    """Regions of ``min_size`` per sequence; a remainder below half of it is merged into the last full region.

    Sequences shorter than ``min_size`` give none.
    """
    full = F.floor(F.col("size") / min_size).cast("long")
    rest = F.col("size") - full * min_size
    merged = rest < min_size / 2
    last = F.when(merged, full - 1).otherwise(full)
    rows = sizes.where(F.col("size") >= min_size).select("chrom", "size", last.alias("last"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("i"))
    return rows.select(
        "chrom", (F.col("i") * min_size).alias("start_pos"),
        F.when(F.col("i") == F.col("last"), F.col("size")).otherwise((F.col("i") + 1) * min_size).cast("long").alias("end_pos"),
    )

"""Column functions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strand_code(strand: Column) -> Column:
    """+, -, . as 1, -1, 0."""
    return F.when(strand == "+", 1).when(strand == "-", -1).when(strand == ".", 0).cast("int")


def chromosome_rank(chrom: Column) -> Column:
    """Number of the chromosome, X 23 and Y 24; NULL for other names."""
    name = F.regexp_extract(chrom, r"^chr([0-9]+|X|Y)$", 1)
    return F.when(name == "X", 23).when(name == "Y", 24).otherwise(name.try_cast("int"))


def base_count(seq: Column, base: str) -> Column:
    """Occurrences of one character."""
    return (F.length(seq) - F.length(F.replace(seq, F.lit(base), F.lit("")))).cast("long")


def quality_value(bp: Column, genome_size: float) -> Column:
    """Phred score of bp errors in a diploid genome, half-even rounded; 100 without errors."""
    rate = bp / F.lit(2.0 * genome_size)
    return F.when(bp == 0, F.lit(100).cast("long")).otherwise(F.bround(-10 * F.log10(rate)).cast("long"))


def genotype_class(gt: Column) -> Column:
    """HOM, HET or NULL for a missing or half-missing genotype such as ``0/1`` or ``1|1``."""
    alleles = F.split(F.replace(gt, F.lit("|"), F.lit("/")), "/")
    missing = gt.isNull() | gt.contains(".")
    return F.when(missing, None).when(F.size(F.array_distinct(alleles)) == 1, "HOM").otherwise("HET")


def fix_sample_id(col: Column) -> Column:
    """GM accessions as NA, with the one sample that belongs to the HG series."""
    return F.when(col == "GM00864", "HG00864").otherwise(F.regexp_replace(col, "^GM", "NA"))

"""Consensus masks over many assemblies."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from .sweep import BLOCK, END, START, complement, interval_events, merge_intervals, running_sums, state_edges, sum_by_position


def assembly_threshold(k: int, quantifier: str, select: float = -1, select_value: str = "absolute") -> int:
    """Number of assemblies the quantifier compares with, out of ``k``; ``select`` -1 means all of them."""
    if quantifier in ("any", "all"):
        return 1 if quantifier == "any" else k
    if select == -1:
        return k
    if select_value == "fraction" and 0 < select <= 1:
        n = math.ceil(k * select) if quantifier == "lt" else math.floor(k * select)
    elif select_value == "absolute" and select >= 1:
        n = int(select)
        if n > k:
            raise ValueError(f"{n} assemblies selected but only {k} given")
    else:
        raise ValueError(f"cannot select {select} assemblies as {select_value}")
    if n < 1:
        raise ValueError(f"{select} of {k} assemblies selects none")
    return n


def _predicate(quantifier: str, n: int):
    tests = {
        "any": lambda d: d >= 1,
        "all": lambda d: d >= n,
        "geq": lambda d: d >= n,
        "lt": lambda d: (d > 0) & (d < n),
    }
    if quantifier not in tests:
        raise ValueError(f"unknown quantifier {quantifier!r}")
    return tests[quantifier]


def consensus_regions(
    aln: DataFrame,
    n_assemblies: int,
    quantifier: str = "geq",
    select: float = -1,
    select_value: str = "absolute",
    assembly: Sequence[str] = ("sample", "tech", "hap"),
    sizes: DataFrame | None = None,
    inverse: bool = False,
    min_size: int = 0,
    block: int = BLOCK,
) -> DataFrame:
    """Regions selected by how many of ``n_assemblies`` assemblies cover each base.

    any: at least one; all: every one; geq: at least the threshold; lt: some but
    fewer than the threshold. ``inverse`` reports the rest of every sequence in
    ``sizes``.
    """
    runs = haplotype_depth(aln, assembly, block)
    return depth_regions(runs, n_assemblies, quantifier, select, select_value, sizes, inverse, min_size, block)


def depth_regions(
    runs: DataFrame,
    n_assemblies: int,
    quantifier: str = "geq",
    select: float = -1,
    select_value: str = "absolute",
    sizes: DataFrame | None = None,
    inverse: bool = False,
    min_size: int = 0,
    block: int = BLOCK,
) -> DataFrame:
    """``consensus_regions`` from the runs of ``haplotype_depth``, which serve any number of quantifiers."""
    keep = _predicate(quantifier, assembly_threshold(n_assemblies, quantifier, select, select_value))
    regions = merge_intervals(runs.where(keep(F.col("depth"))), block=block)
    if inverse:
        if sizes is None:
            raise ValueError("the inverse needs the sequence sizes")
        regions = complement(regions, sizes, only_hit=False, block=block)
    return regions.where(F.col(END) - F.col(START) >= min_size)


def haplotype_depth(aln: DataFrame, assembly: Sequence[str] = ("sample", "tech", "hap"), block: int = BLOCK) -> DataFrame:
    """Runs of the number of assemblies covering each base."""
    member = [*assembly, "chrom"]
    covered = state_edges(interval_events(aln, member), member, lambda d: d > 0, block=block)
    rows = sum_by_position(covered, ["chrom"], ["step"]).where("step <> 0")
    run = running_sums(rows, ["chrom"], ["step"], block=block)
    return run.where("cum_step > 0").select(
        "chrom", F.col("pos").alias(START), F.col("next_pos").alias(END), F.col("cum_step").alias("depth")
    )


def bp_by_depth(runs: DataFrame) -> DataFrame:
    """Bases per depth, and the total on the row with NULL depth."""
    return runs.withColumn("bp", F.col(END) - F.col(START)).rollup("depth").agg(F.sum("bp").alias("bp"))


def uniform_regions(runs: DataFrame, sizes: DataFrame, n: int = 128, block: int = BLOCK) -> DataFrame:
    """Cut every sequence into regions of about total depth / n each; the last ends at the sequence end.

    A boundary lies before the first base whose running depth exceeds a multiple of the share.
    """
    runs = runs.withColumn("mass", F.col("depth") * (F.col(END) - F.col(START)))
    share = runs.groupBy("chrom").agg(F.bround(F.sum("mass") / n).cast("long").alias("share")).where("share > 0")
    run = running_sums(runs, ["chrom"], ["mass"], pos=START, block=block).join(share, "chrom")
    before = F.col("cum_mass") - F.col("mass")
    # the multiples j * share with before <= j * share < cum_mass are first exceeded inside this run
    first = F.greatest(F.ceil(before / F.col("share")).cast("long"), F.lit(1).cast("long"))
    last = F.floor((F.col("cum_mass") - 1) / F.col("share")).cast("long")
    cuts = (
        run.where(first <= last)
        .select("*", F.explode(F.sequence(first, last)).alias("j"))
        .select("chrom", (F.col(START) + F.floor((F.col("j") * F.col("share") - before) / F.col("depth"))).cast("long").alias("cut"))
        .where("cut > 0")
        .distinct()
    )
    ends = cuts.select("chrom", F.col("cut").alias("pos")).unionByName(sizes.select("chrom", F.col("size").cast("long").alias("pos")))
    starts = sizes.select("chrom", F.lit(0).cast("long").alias("pos")).unionByName(cuts.select("chrom", F.col("cut").alias("pos")))
    # n cuts per sequence at most, so one small window each
    edges = starts.unionByName(ends).distinct()
    following = F.lead("pos").over(W.partitionBy("chrom").orderBy("pos"))
    return edges.withColumn("next", following).where("next is not null").select(
        "chrom", F.col("pos").alias(START), F.col("next").alias(END)
    )

"""Scaffold layouts, contig support, break classes, SV clusters and scaffold placement."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.columns import base_count, strand_code
from .distribution import running_in_order
from .graph import connected_components
from .lineage import written_once
from .overlap import overlap_join
from .sweep import END, START, own_shuffle, running_sums, union_all

SUBSEQ = "_subseq_"
BASES = ["A", "C", "G", "T", "a", "c", "g", "t", "N", "n"]


def _base_col(b: str) -> str:
    return f"n_{'lower_' if b.islower() else ''}{b}"


def parse_contig_name(df: DataFrame, col: str = "name") -> DataFrame:
    """``contig_subseq_a:b`` as contig, a - 1, b; a plain name has NULL coordinates."""
    parts = F.split(F.col(col), SUBSEQ)
    span = F.split(F.try_element_at(parts, F.lit(2)), ":")
    return df.select(
        "*", F.element_at(parts, 1).alias("contig_name"),
        (F.try_element_at(span, F.lit(1)).cast("long") - 1).alias("contig_start"), F.try_element_at(span, F.lit(2)).cast("long").alias("contig_end"),
    )


def parse_scaffold_contig(df: DataFrame, col: str = "name") -> DataFrame:
    """``scaffold@chrom@order@orient@contig@ctg:a-b`` as columns."""
    parts = F.split(F.col(col), "@")
    span = F.split(F.element_at(F.split(F.element_at(parts, -1), ":"), -1), "-")
    return df.select(
        "*", F.element_at(parts, 1).alias("scaffold"), F.element_at(parts, 2).alias("scaffold_chrom"), F.element_at(parts, 3).cast("int").alias("order_number"),
        F.element_at(parts, 4).alias("contig_orient"), F.element_at(parts, 5).alias("contig_name"),
        (F.element_at(span, 2).cast("long") - F.element_at(span, 1).cast("long")).alias("contig_length"),
    )


def scaffold_layout(agp: DataFrame, chunks: DataFrame, chunk: int, contig_sizes: DataFrame) -> DataFrame:
    """Components of each scaffold with coordinates, contig span, completeness and base counts, and one row per scaffold.

    ``agp`` has object, object_start (1-based), object_end, comp_number, comp_type,
    comp_name, orientation; ``chunks`` the scaffold sequences (chrom, chunk_no, seq).
    A component whose sequence, span and layout lengths differ is an error.
    """
    comps = agp.where(F.col("object").startswith("Super-Scaffold"))
    is_gap = F.col("comp_type") == "N"
    parts = parse_contig_name(comps, "comp_name").withColumns({START: (F.col("object_start") - 1).cast("long"), END: F.col("object_end").cast("long")})
    parts = parts.withColumnRenamed("object", "chrom")
    offset = F.col("chunk_no").cast("long") * chunk
    spans = chunks.select("chrom", offset.alias(START), (offset + F.length("seq")).alias(END), "seq")
    hits = overlap_join(parts.select("chrom", START, END, "comp_number"), spans, width=chunk)
    lo = F.greatest(START, f"{START}_b") - F.col(f"{START}_b") + 1
    piece = F.substring("seq_b", lo.cast("int"), F.col("bp").cast("int"))
    counts = hits.withColumn("_s", piece).groupBy("chrom", "comp_number").agg(F.sum("bp").alias("_bp"), *[F.sum(base_count(F.col("_s"), b)).alias(_base_col(b)) for b in BASES])
    rows = parts.join(counts, ["chrom", "comp_number"], "left").join(contig_sizes.select(F.col("contig").alias("contig_name"), F.col("size").alias("_full")), "contig_name", "left")
    length = (F.col(END) - F.col(START)).cast("long")
    span = F.when(is_gap, F.col("comp_name").try_cast("long")).otherwise(F.coalesce(F.col("contig_end") - F.col("contig_start"), length))
    agree = (F.coalesce("_bp", F.lit(0)) == length) & (span == length)
    checked = F.when(agree, length).otherwise(F.raise_error(F.concat(F.lit("length mismatch in "), "chrom", F.lit(" component "), F.col("comp_number").cast("string"))))
    none = F.lit(-1).cast("long")
    lead = F.coalesce("contig_start", F.lit(0).cast("long"))
    comp = rows.select(
        F.col("chrom").alias("object"), F.when(is_gap, "gap").otherwise("sequence").alias("component"), F.col("comp_number").cast("int").alias("order"),
        START, END, checked.alias("length"), F.when(is_gap, 0).otherwise(strand_code(F.col("orientation"))).alias("orientation"),
        F.when(is_gap, "gap").otherwise(F.col("contig_name")).alias("name"), F.when(is_gap, none).otherwise(lead).alias("component_start"),
        F.when(is_gap, none).otherwise(lead + length).alias("component_end"),
        F.when(is_gap, -1).otherwise((F.col("_full") == length).cast("int")).alias("component_complete"), *[_base_col(b) for b in BASES],
    )
    wanted = comps.select(F.col("object").alias("chrom")).distinct()
    whole = chunks.join(wanted, "chrom", "left_semi").groupBy("chrom").agg(F.sum(F.length("seq")).alias("length"), *[F.sum(base_count(F.col("seq"), b)).alias(_base_col(b)) for b in BASES])
    zero = F.lit(0).cast("long")
    scaffolds = whole.select(
        F.lit("scaffold").alias("object"), F.lit("self").alias("component"), F.lit(0).alias("order"), zero.alias(START), F.col("length").alias(END), "length",
        F.lit(0).alias("orientation"), F.col("chrom").alias("name"), zero.alias("component_start"), F.col("length").alias("component_end"),
        F.lit(1).alias("component_complete"), *[_base_col(b) for b in BASES],
    )
    return comp.unionByName(scaffolds)


def neighbour_fill(df: DataFrame, by: Sequence[str] = ("object",), order: str = "order", block: float = 1 << 18) -> DataFrame:
    """Give gap rows (component ``gap``) the end of the component before and the start of the one after.

    Coordinates grow with the order, so these are the greatest end so far and the least start to come.
    """
    gap = F.col("component") == "gap"
    rows = df.withColumns({"_end": F.when(~gap, F.col(END)), "_start": F.when(~gap, F.col(START))})
    run = running_sums(rows, by, [], pos=order, block=block, lasts=["_end"], nexts=["_start"])
    return run.withColumns({START: F.when(gap, F.col("last__end")).otherwise(F.col(START)), END: F.when(gap, F.col("first__start")).otherwise(F.col(END))}).select(*df.columns)


def sequence_pieces(agp: DataFrame) -> DataFrame:
    """Sequence rows of a layout: object, contig (before ``_subseq_``), is_part, in_scaffold, length, ord."""
    return agp.where("comp_type <> 'N'").select(
        "object", F.element_at(F.split("comp_name", SUBSEQ), 1).alias("contig"), F.col("comp_name").contains("subseq").alias("is_part"),
        F.col("object").contains("Super-Scaffold").alias("in_scaffold"), F.col("comp_length").cast("long").alias("length"), "ord",
    )


def contig_support(pieces: DataFrame) -> DataFrame:
    """Per contig: bases inside and outside scaffolds, and breaks.

    Breaks are pieces - 1, 0 for a contig in no scaffold; several unscaffolded parts of one contig count once.
    """
    inside = F.col("in_scaffold")
    per = pieces.groupBy("contig").agg(
        F.coalesce(F.sum(F.when(inside, F.col("length"))), F.lit(0)).alias("supported"),
        F.coalesce(F.sum(F.when(~inside, F.col("length"))), F.lit(0)).alias("unsupported"),
        F.count(F.lit(1)).alias("_n"), F.sum((~inside & F.col("is_part")).cast("int")).alias("_parts"),
    )
    breaks = F.when(F.col("supported") == 0, 0).otherwise(F.col("_n") - 1)
    once = F.when((F.col("_parts") >= 2) & (breaks > 0), F.col("_parts") - 1).otherwise(0)
    return per.select("contig", "supported", "unsupported", (breaks - once).cast("long").alias("contig_breaks"))


def scaffold_chrom(pieces: DataFrame, aln: DataFrame) -> DataFrame:
    """Per scaffold the chromosome with most length x mapq of its contigs' alignments, and its share to 3 digits.

    X and Y count as one, unplaced chromosomes and mapq 0 do not; without anything left the chromosome is ``random``.
    """
    chrom = F.element_at(F.split("chrom", "_"), 1)
    chrom = F.when(chrom.isin("chrX", "chrY"), "chrXY").otherwise(chrom)
    mass = (F.col(END) - F.col(START)) * F.col("mapq")
    per_contig = aln.where("mapq > 0").select("contig", chrom.alias("chrom"), mass.alias("m")).where("chrom <> 'chrUn'").groupBy("contig", "chrom").agg(F.sum("m").alias("m"))
    parts = pieces.where("in_scaffold").groupBy(F.col("object").alias("scaffold"), "contig").agg(F.count(F.lit(1)).alias("k"))
    sums = parts.join(per_contig, "contig").groupBy("scaffold", "chrom").agg(F.sum(F.col("k") * F.col("m")).alias("m"))
    best = sums.groupBy("scaffold").agg(F.min_by("chrom", F.struct(-F.col("m"), F.col("chrom"))).alias("chrom"), F.max("m").alias("_best"), F.sum("m").alias("_all"))
    out = parts.select("scaffold").distinct().join(best, "scaffold", "left")
    return out.select(
        "scaffold", F.coalesce("chrom", F.lit("random")).alias("chrom"), F.coalesce(F.bround(F.col("_best") / F.col("_all"), 3), F.lit(0.0)).alias("confidence")
    )


def usable_chrom(chrom: Column, confidence: Column) -> Column:
    """Chromosome a scaffold is filed under: ``chrUn`` below a confidence of one half."""
    return F.when(confidence < 0.5, "chrUn").otherwise(chrom)


def _first_pairs(groups: DataFrame) -> DataFrame:
    """Per contig, of the first ``_left`` pairs of its ``_m`` scaffolds: those on one chromosome (_g) and the others (_c).

    Pairs (0, 1), (0, 2), ... follow the rank of the scaffolds by first appearance. Scaffold i leads the pairs
    with the ``_took`` scaffolds behind it, which are all of them but for the last leader, so running counts
    per chromosome give the sums; no pair and no list of a contig is made.
    """
    ranked = running_in_order(groups.withColumn("_one", F.lit(1)), ["contig"], ["first", "scaffold"], "_one", "_rank")
    i = F.col("_rank") - 1
    before = (i * (2 * F.col("_m") - i - 1) / 2).cast("long")
    took = F.greatest(F.lit(0), F.least(F.col("_left") - before, F.col("_m") - F.col("_rank")))
    ranked = written_once(ranked.withColumns({"_took": took.cast("long"), "_on": F.struct("chrom")}))
    same = running_sums(ranked, ["contig", "_on"], ["_one"], pos="_rank", block=1 << 18).select("contig", "_on", "_rank", "_took", "_m", "cum__one")
    same = same.join(ranked.groupBy("contig", "_on").agg(F.count("*").alias("_all")), ["contig", "_on"])
    whole = F.col("_took") == F.col("_m") - F.col("_rank")
    full = same.groupBy("contig").agg(F.sum("_took").alias("_t"), F.sum(F.when(whole, F.col("_all") - F.col("cum__one")).otherwise(0)).alias("_f"))
    last = same.where(~whole & (F.col("_took") > 0)).select("contig", "_on", F.col("_rank").alias("_from"), (F.col("_rank") + F.col("_took")).alias("_to"))
    partly = ranked.join(last, ["contig", "_on"]).where("_rank > _from AND _rank <= _to").groupBy("contig").agg(F.count("*").alias("_p"))
    equal = F.col("_f") + F.coalesce("_p", F.lit(0))
    return full.join(partly, "contig", "left").select("contig", equal.alias("_g"), (F.col("_t") - equal).alias("_c"))


def classify_breaks(view: DataFrame, pieces: DataFrame, chroms: DataFrame, strict: bool = True) -> DataFrame:
    """Split the breaks of every contig into local (same scaffold), global (same chromosome), chimeric and support.

    A contig partly outside scaffolds has one support break; local breaks are the
    further pieces in each scaffold; what remains goes to pairs of different
    scaffolds in order of first appearance. Counts that do not add up, as when more
    breaks remain than a contig has pairs of scaffolds, are an error; unless ``strict`` they are given as they are.
    """
    groups = pieces.where("in_scaffold").groupBy("contig", F.col("object").alias("scaffold")).agg(F.min("ord").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = written_once(groups.join(chroms.select("scaffold", "chrom"), "scaffold", "left"))  # counted in three ways below
    head = F.struct("first", "scaffold")
    # the usual case, one remaining break per further scaffold, pairs the first scaffold with each other one
    per = groups.groupBy("contig").agg(F.sum("n").alias("_p"), F.count(F.lit(1)).alias("_m"), F.min_by("chrom", head).alias("_chrom"))
    same = groups.groupBy("contig", "chrom").agg(F.count(F.lit(1)).alias("_same"))
    on = (per["contig"] == same["contig"]) & per["_chrom"].eqNullSafe(same["chrom"])
    per = per.join(same, on).select(per["contig"], "_p", "_m", "_same")
    support = F.when((F.col("supported") > 0) & (F.col("unsupported") > 0), 1).otherwise(0)
    rows = view.join(per, "contig", "left").fillna(0, ["_p", "_m", "_same"]).withColumn("support_breaks", support.cast("long"))
    open_ = (F.col("contig_breaks") > 0) & (F.col("contig_breaks") != F.col("support_breaks"))
    local = F.when(~open_, 0).when(F.col("_p") == 1, 1).otherwise(F.col("_p") - F.col("_m"))
    rows = rows.withColumn("local_breaks", local.cast("long"))
    left = F.when(open_ & (F.col("_m") > 1), F.col("contig_breaks") - F.col("support_breaks") - F.col("local_breaks")).otherwise(0)
    rows = rows.withColumn("_left", F.greatest(left, F.lit(0)))
    # any other number takes the first pairs in order, as many as breaks remain
    odd = rows.where((F.col("_left") > 0) & (F.col("_left") != F.col("_m") - 1)).select("contig", "_left", "_m")
    counted = _first_pairs(groups.join(odd, "contig"))
    rows = rows.join(counted, "contig", "left")
    usual = F.col("_left") == F.col("_m") - 1
    rows = rows.withColumns({
        "global_breaks": F.when(F.col("_left") == 0, 0).when(usual, F.col("_same") - 1).otherwise(F.coalesce("_g", F.lit(0))).cast("long"),
        "chimeric_breaks": F.when(F.col("_left") == 0, 0).when(usual, F.col("_m") - F.col("_same")).otherwise(F.coalesce("_c", F.lit(0))).cast("long"),
    })
    total = F.col("local_breaks") + F.col("global_breaks") + F.col("chimeric_breaks") + F.col("support_breaks")
    checked = F.when(total == F.col("contig_breaks"), F.col("contig_breaks")).otherwise(F.raise_error(F.concat(F.lit("unaccounted breaks of contig "), "contig")))
    return (rows.withColumn("contig_breaks", checked) if strict else rows).select(
        "contig", "supported", "unsupported", "contig_breaks", "local_breaks", "global_breaks", "chimeric_breaks", "support_breaks"
    )


def check_contig_sizes(view: DataFrame, index: DataFrame) -> DataFrame:
    """Contigs missing on one side, or whose scaffolded and unscaffolded bases do not add up to the size."""
    both = view.select("contig", (F.col("supported") + F.col("unsupported")).alias("seen")).join(index.select("contig", "size"), "contig", "full")
    return both.where("seen is null or size is null or seen <> size")


def assert_contig_sizes(view: DataFrame, index: DataFrame) -> None:
    wrong = check_contig_sizes(view, index).take(5)
    if wrong:
        raise ValueError(f"contig sizes differ from the index: {wrong}")


def hybrid_summary(view: DataFrame) -> DataFrame:
    """One row: contigs, those fully or partly in scaffolds, their bases, and shares of the assembly."""
    full = F.col("unsupported") == 0
    breaks = [c for c in view.columns if c.endswith("breaks")]
    one = view.agg(
        F.count(F.lit(1)).alias("num_contigs"), F.sum(full.cast("int")).alias("num_ctg_full_support"), F.sum((F.col("supported") > 0).cast("int")).alias("num_ctg_any_support"),
        F.coalesce(F.sum(F.when(full, F.col("supported"))), F.lit(0)).alias("bp_ctg_full_support"), F.max(F.when(full, F.col("supported"))).alias("bp_largest_ctg_full_support"),
        F.sum("supported").alias("bp_scaffolded"), F.sum("unsupported").alias("bp_discarded"), *[F.sum(c).alias(c) for c in breaks],
    )
    one = one.withColumn("bp_assembly_length", F.col("bp_scaffolded") + F.col("bp_discarded"))
    pct = lambda c: F.bround(F.col(c) / F.col("bp_assembly_length") * 100, 2)
    return one.withColumns({"pct_scaffolded": pct("bp_scaffolded"), "pct_scaffolded_full_support": pct("bp_ctg_full_support")})


# --- SV clusters ------------------------------------------------------------


def cluster_edges(svs: DataFrame, frac: float = 0.5) -> DataFrame:
    """Pairs of clusters that overlap each other by at least ``frac``."""
    rows = svs.select("chrom", START, END, "name")
    pairs = overlap_join(rows, rows.hint("merge"), min_frac=frac, reciprocal=True)
    return pairs.where("name < name_b").select(F.col("name").alias("src"), F.col("name_b").alias("dst"))


def merge_sv_clusters(svs: DataFrame, frac: float = 0.5, counts: Sequence[str] = ("num_samples",), sep: str = "|") -> DataFrame:
    """Clusters linked by reciprocal overlap become one: outer coordinates, summed counts, sorted joined ids, common or joined type."""
    comps = connected_components(cluster_edges(svs, frac))
    rows = svs.join(comps.withColumnRenamed("node", "name").hint("merge"), "name", "left").withColumn("component", F.coalesce("component", "name"))
    item = F.array_sort(F.collect_list(F.struct("name", "svtype")))
    out = rows.groupBy("component").agg(
        F.min("chrom").alias("chrom"), F.min(START).alias(START), F.max(END).alias(END), *[F.sum(c).alias(c) for c in counts],
        F.count(F.lit(1)).alias("members"), F.min("svtype").alias("_t1"), F.max("svtype").alias("_t2"), item.alias("_i"),
    )
    types = F.when(F.col("_t1") == F.col("_t2"), F.col("_t1")).otherwise(F.array_join(F.transform("_i", lambda x: x["svtype"]), sep))
    return out.select(
        "chrom", START, END, F.array_join(F.transform("_i", lambda x: x["name"]), sep).alias("name"), types.alias("svtype"), *counts, "members"
    )


def merge_stats(svs: DataFrame, merged: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows (key, value): clusters before and after, overlapping pairs, merged clusters, and clusters per member number."""
    n = F.count(F.lit(1))
    parts = [
        svs.agg(n.alias("value")).select(F.lit("num_clusters").alias("key"), "value"),
        edges.agg(n.alias("value")).select(F.lit("num_overlap_pairs").alias("key"), "value"),
        merged.agg(F.coalesce(F.sum((F.col("members") > 1).cast("long")), F.lit(0)).alias("value")).select(F.lit("num_overlap_merged").alias("key"), "value"),
        merged.agg(n.alias("value")).select(F.lit("num_clusters_final").alias("key"), "value"),
        merged.where("members > 1").groupBy("members").agg(n.alias("value")).select(F.concat(F.lit("members_"), F.col("members").cast("string")).alias("key"), "value"),
        merged.where("members > 1").groupBy("num_samples").agg(n.alias("value")).select(F.concat(F.lit("samples_"), F.col("num_samples").cast("string")).alias("key"), "value"),
    ]
    return union_all(parts)


# --- placement --------------------------------------------------------------


def _window_sums(rows: DataFrame, key: Sequence[str], mid: str, name: str) -> DataFrame:
    """Per scaffold the aligned bases inside the window around ``mid``, margins as given and swapped."""
    def inside(left: str, right: str) -> Column:
        shared = F.least(F.col(mid) + F.col(right), F.col(END)) - F.greatest(F.col(mid) - F.col(left), F.col(START))
        return F.coalesce(F.sum(F.when(shared > 0, shared)), F.lit(0))

    return rows.groupBy(*key).agg(inside("left5", "right5").alias(f"f{name}"), inside("right5", "left5").alias(f"r{name}"))


#: Blocks and components of a scaffold that one window and list hold; longer scaffolds are dealt into ranges.
LISTED = 10_000


def scaffold_placement(aln: DataFrame, layout: DataFrame, key: Sequence[str] = ("scaffold",)) -> DataFrame:
    """Confidence, strand and extent of every scaffold's alignments to a reference.

    ``aln`` has chrom, start, end, contig, order_number, mapq, strand; ``layout`` the
    sequence components: contig, order, start, length, scaffold_length.

    Scaffolds on several chromosomes are low. Otherwise the alignments inside the
    window (scaffold extent + 5 % around the weighted alignment midpoint, forward or
    reverse, whichever holds more) are used; if a window is empty the midpoint moves
    once: to the best block of a single contig, or to the midpoint without the most
    distant block. At least half of the scaffold must be aligned. Contigs in layout
    order (or reversed) give high, any other order medium; unused alignments are low.
    Scaffolds of up to LISTED blocks and components get their verdict by windows over one shuffle of the alignments.
    Of longer ones orders are compared by the ranks of blocks, dealt into ranges, so a scaffold may have any number.
    """
    key = list(key)
    named = reduce(Column.__and__, [F.col(k).isNotNull() for k in key])
    sizes = union_all([aln.select(*key), layout.select(*key)]).where(named).groupBy(*key).agg((F.count(F.lit(1)) > LISTED).alias("_long"))
    some, every = sizes.agg(F.max("_long"), F.min("_long")).first()
    if not some or every:
        return _placed(aln, (_place_ranged if some else _place_listed)(aln, layout, key), key)
    long_ones = written_once(sizes.where("_long").drop("_long"))
    split = lambda df, how: df.join(F.broadcast(long_ones), key, how).select(*df.columns)  # at most one key for each LISTED rows
    short = _placed(split(aln, "left_anti"), _place_listed(split(aln, "left_anti"), split(layout, "left_anti"), key), key)
    return short.unionByName(_placed(split(aln, "left_semi"), _place_ranged(split(aln, "left_semi"), split(layout, "left_semi"), key), key))


def _layout_facts(layout: DataFrame, key: Sequence[str], *more: Column) -> DataFrame:
    """Per scaffold its weighted centre, the reach to both sides, with and without margins, and its components."""
    centre = F.col(START) + F.floor(F.col("length") / 2)
    plan = layout.groupBy(*key).agg(
        F.floor(F.sum(centre * F.col("length")) / F.sum("length")).alias("centre"), F.max("scaffold_length").alias("full"), F.sum("length").alias("nogap"),
        F.count("*").alias("components"), *more,
    )
    plan = plan.withColumns({"left": F.col("centre") - 1, "right": F.col("full") - F.col("centre")})
    return plan.withColumns({"left5": F.floor(F.col("left") * 1.05), "right5": F.floor(F.col("right") * 1.05)})


def _measured(aln: DataFrame) -> DataFrame:
    return aln.withColumns({"len": (F.col(END) - F.col(START)).cast("long"), "mid": (F.col(START) + F.floor((F.col(END) - F.col(START)) / 2)).cast("long")})


def _swap(a: str, b: str) -> Column:
    return F.when(F.col("reverse"), F.col(b)).otherwise(F.col(a))


def _used() -> Column:
    return F.coalesce((F.col(END) > F.col("centre_at") - _swap("left5", "right5")) & (F.col(START) < F.col("centre_at") + _swap("right5", "left5")), F.lit(False))


def _verdict(key: Sequence[str], forward: Column, backward: Column) -> list[Column]:
    """Confidence, strand and extent of a scaffold whose order agrees from either end or not, and its window."""
    return [
        *[F.col(k) for k in key], "centre_at", "reverse", "left5", "right5", F.when(F.col("bp") >= F.col("nogap") * 0.5, F.when(forward | backward, "high").otherwise("medium")).alias("_conf"),
        F.when(forward, "+").when(backward, "-").when(F.col("plus") >= F.col("minus"), "+").otherwise("-").alias("_strand"),
        F.least(F.col("lo"), F.col("centre_at") - _swap("left", "right")).alias("_lo"), F.greatest(F.col("hi"), F.col("centre_at") + _swap("right", "left")).alias("_hi"),
    ]


def _placed(aln: DataFrame, result: DataFrame, key: Sequence[str]) -> DataFrame:
    """The alignments with the verdict of their scaffold."""
    placed = _used() & F.col("_conf").isNotNull()
    return aln.join(result.hint("merge"), key, "left").select(
        *[aln[c] if c in key else c for c in aln.columns], F.when(placed, F.col("_conf")).otherwise("low").alias("loc_confidence"), F.when(placed, F.col("_strand")).otherwise(".").alias("scaffold_strand"),
        F.when(placed, F.col("_lo")).otherwise(-1).cast("long").alias("scaffold_start"), F.when(placed, F.col("_hi")).otherwise(-1).cast("long").alias("scaffold_end"),
    )


def _place_listed(aln: DataFrame, layout: DataFrame, key: Sequence[str]) -> DataFrame:
    """Verdicts of scaffolds whose rows one window holds: the alignments are shuffled by scaffold once."""
    w, upto = W.partitionBy(*key), W.partitionBy(*key).orderBy("mid")
    rows = _measured(aln).select(*key, "chrom", START, END, "contig", "order_number", "mapq", "strand", "len", "mid")
    weighted = lambda kept: F.floor(F.sum(F.when(kept, F.col("mid") * F.col("len"))).over(w) / F.sum(F.when(kept, F.col("len"))).over(w))
    # rows are sorted once, by scaffold and midpoint, which serves all windows
    rows = rows.select("*", F.count("mid").over(upto).alias("cum_k"), F.sum("mid").over(upto).alias("cum_sum"))
    rows = rows.select(
        "*", weighted(F.lit(True)).alias("mid1"), F.count(F.lit(1)).over(w).alias("n"), F.sum("mid").over(w).alias("st"),
        (F.min("contig").over(w) == F.max("contig").over(w)).alias("one_contig"), (F.min("chrom").over(w) == F.max("chrom").over(w)).alias("one_chrom"),
        F.max_by("mid", F.struct(F.col("len") * F.col("mapq"), -F.col(START))).over(w).alias("best_mid"),
    )
    rows = rows.where("one_chrom").drop("one_chrom").join(_layout_facts(layout, key).hint("merge"), key)

    def inside(mid: str, left: str, right: str) -> Column:
        shared = F.least(F.col(mid) + F.col(right), F.col(END)) - F.greatest(F.col(mid) - F.col(left), F.col(START))
        return F.coalesce(F.sum(F.when(shared > 0, shared)).over(w), F.lit(0))

    # distance of each block to all others: blocks up to it, and those behind
    far = F.when(F.col("n") >= 3, F.col("mid") * (2 * F.col("cum_k") - F.col("n")) + F.col("st") - 2 * F.col("cum_sum"))
    rows = rows.withColumn("far", far).drop("cum_k", "cum_sum", "st")
    place = F.struct("chrom", START, END, "contig")
    rows = rows.select(
        "*", inside("mid1", "left5", "right5").alias("f1"), inside("mid1", "right5", "left5").alias("r1"),
        F.max("far").over(w).alias("top"), F.min("far").over(w).alias("low"), F.min(F.when(F.col("far").isNotNull(), place)).over(w).alias("least"),
    )
    rows = rows.withColumn("ok1", (F.col("f1") > 0) & (F.col("r1") > 0))
    apart = ~F.col("ok1") & ~F.col("one_contig")
    kept = apart & ((F.col("far") < F.col("top")) | ((F.col("low") == F.col("top")) & (place == F.col("least"))))
    rows = rows.withColumn("mid2", F.when(~F.col("ok1"), F.when(F.col("one_contig"), F.col("best_mid")).otherwise(weighted(kept)))).drop("far", "top", "low", "least")
    rows = rows.select("*", inside("mid2", "left5", "right5").alias("f2"), inside("mid2", "right5", "left5").alias("r2"))
    rows = rows.withColumns({
        "centre_at": F.when(F.col("ok1"), F.col("mid1")).when((F.col("f2") > 0) & (F.col("r2") > 0), F.col("mid2")),
        "reverse": F.when(F.col("ok1"), F.col("r1") > F.col("f1")).otherwise(F.col("r2") > F.col("f2")),
    })
    facts = ["centre_at", "reverse", "left", "right", "left5", "right5", "nogap", "components"]
    per_order = rows.where(_used()).groupBy(*key, "order_number").agg(
        F.min(F.struct("chrom", START, END)).alias("at"), F.min(START).alias("lo"), F.max(END).alias("hi"), F.sum("len").alias("bp"),
        F.sum(F.when(F.col("strand") == "+", 1).otherwise(0)).alias("plus"), F.sum(F.when(F.col("strand") == "-", 1).otherwise(0)).alias("minus"), *[F.max(c).alias(c) for c in facts],
    )
    result = per_order.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("at", "order_number"))).alias("seen"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("bp").alias("bp"),
        F.sum("plus").alias("plus"), F.sum("minus").alias("minus"), *[F.max(c).alias(c) for c in facts],
    )
    planned = layout.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col(START), F.col("order")))).alias("planned"))
    result = result.join(planned.hint("merge"), key)
    seen, planned = F.transform("seen", lambda x: x["order_number"].cast("long")), F.transform("planned", lambda x: x["order"].cast("long"))
    known = F.forall(seen, lambda x: x.isNotNull())
    return result.select(*_verdict(key, known & (seen == planned), known & (seen == F.reverse(planned))))


def _place_ranged(aln: DataFrame, layout: DataFrame, key: Sequence[str]) -> DataFrame:
    """Verdicts of scaffolds of any length, each spread over the tasks."""
    rows, plan = _measured(aln), _layout_facts(layout, key)
    weighted = F.floor(F.sum(F.col("mid") * F.col("len")) / F.sum("len"))
    seen = rows.groupBy(*key).agg(
        weighted.alias("mid1"), F.count(F.lit(1)).alias("n"), (F.min("contig") == F.max("contig")).alias("one_contig"), (F.min("chrom") == F.max("chrom")).alias("one_chrom"),
        F.max_by("mid", F.struct(F.col("len") * F.col("mapq"), -F.col(START))).alias("best_mid"),
    )
    facts = written_once(seen.join(plan, key))  # one row per scaffold
    work = rows.join(facts.where("one_chrom").drop("components"), key)
    first = written_once(_window_sums(work, key, "mid1", "1").withColumn("ok1", (F.col("f1") > 0) & (F.col("r1") > 0)))

    # distance of each block to all others of its scaffold, only where the first window failed
    again = work.join(first.where(~F.col("ok1")).select(*key), key)
    apart = again.where("not one_contig and n >= 3")
    # equal midpoints are equally far, so running sums over the distinct ones do
    mids = apart.groupBy(*key, "mid").agg(F.count("*").alias("k")).withColumn("sum", F.col("k") * F.col("mid"))
    run = running_sums(mids, key, ["k", "sum"], pos="mid", block=1 << 18)
    run = run.join(mids.groupBy(*key).agg(F.sum("k").alias("nk"), F.sum("sum").alias("st")), key)
    far = F.col("mid") * (2 * F.col("cum_k") - F.col("nk")) + F.col("st") - 2 * F.col("cum_sum")
    apart = apart.join(run.select(*key, "mid", far.alias("far")), [*key, "mid"])
    place = F.struct("chrom", START, END, "contig")
    ends = apart.groupBy(*own_shuffle(key)).agg(F.max("far").alias("top"), F.min("far").alias("low"), F.min(place).alias("least")).drop("_own")
    apart = apart.join(ends, key)
    moved = apart.where((F.col("far") < F.col("top")) | ((F.col("low") == F.col("top")) & (place == F.col("least")))).groupBy(*key).agg(weighted.alias("mid_moved"))
    second = again.join(moved, key, "left").withColumn("mid2", F.when(F.col("one_contig"), F.col("best_mid")).otherwise(F.col("mid_moved")))
    mid2 = second.groupBy(*key).agg(F.max("mid2").alias("mid2"))
    second = _window_sums(second.where("mid2 is not null"), key, "mid2", "2")

    found = first.join(mid2, key, "left").join(second, key, "left").join(facts.select(*key, "mid1"), key)
    ok2 = (F.col("f2") > 0) & (F.col("r2") > 0)
    found = found.select(
        *key, F.when(F.col("ok1"), F.col("mid1")).when(ok2, F.col("mid2")).alias("centre_at"),
        F.when(F.col("ok1"), F.col("r1") > F.col("f1")).otherwise(F.col("r2") > F.col("f2")).alias("reverse"),
    )
    found = written_once(found.join(facts.drop("mid1", "n", "one_contig", "one_chrom", "best_mid"), key))
    marked = rows.join(found.select(*key, "centre_at", "reverse", "left5", "right5"), key, "left").withColumn("used", _used())
    per_order = marked.where("used").groupBy(*key, "order_number").agg(
        F.min(F.struct("chrom", START, END)).alias("at"), F.min(START).alias("lo"), F.max(END).alias("hi"), F.sum("len").alias("bp"),
        F.sum(F.when(F.col("strand") == "+", 1).otherwise(0)).alias("plus"), F.sum(F.when(F.col("strand") == "-", 1).otherwise(0)).alias("minus"),
    )
    per_order = written_once(per_order.select(*key, "order_number", "at.*", "lo", "hi", "bp", "plus", "minus").withColumn("_one", F.lit(1)))
    result = per_order.groupBy(*key).agg(
        F.count("*").alias("_seen"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("bp").alias("bp"), F.sum("plus").alias("plus"), F.sum("minus").alias("minus"),
    )
    result = result.join(found, key)
    # orders agree if every order has the same rank on both sides, from either end
    seen = running_in_order(per_order, key, ["chrom", START, END, "order_number"], "_one", "_rank")
    planned = running_in_order(layout.withColumn("_one", F.lit(1)), key, [START, "order"], "_one", "_place")
    spots = seen.join(planned.select(*key, F.col("order").alias("order_number"), "_place"), [*key, "order_number"]).join(facts.select(*key, "components"), key)
    up, down = F.col("_rank") == F.col("_place"), F.col("_rank") == F.col("components") + 1 - F.col("_place")
    spots = spots.groupBy(*key).agg(F.sum(up.cast("int")).alias("_up"), F.sum(down.cast("int")).alias("_down"))
    result = result.join(spots, key, "left")
    whole = F.col("_seen") == F.col("components")
    forward = F.coalesce(whole & (F.col("_up") == F.col("components")), F.lit(False))
    backward = F.coalesce(whole & (F.col("_down") == F.col("components")), F.lit(False))
    return result.select(*_verdict(key, forward, backward))


def confidence_score(confidence: Column) -> Column:
    return F.when(confidence == "high", 1000).when(confidence == "medium", 500).otherwise(0)


def placement_summary(placed: DataFrame, assembly: Sequence[str], platform: str = "tech") -> DataFrame:
    """Median over assemblies of the share of aligned bases per confidence, per platform and for ``any``."""
    length = (F.col(END) - F.col(START)).cast("long")
    per = placed.groupBy(*assembly, "loc_confidence").agg(F.sum(length).alias("bp"))
    total = per.groupBy(*assembly).agg(F.sum("bp").alias("total"))
    pct = per.join(total, list(assembly)).withColumn("pct", F.bround(F.col("bp") / F.col("total") * 100, 2))
    both = pct.select("loc_confidence", "pct", F.explode(F.array(F.col(platform), F.lit("any"))).alias("platform"))
    # one row per assembly and confidence
    return both.groupBy("platform", "loc_confidence").agg(F.bround(F.percentile("pct", 0.5), 2).alias("median_pct"))

"""Position sweeps over half-open intervals.

Every interval set is turned into (keys, pos, measures) rows, summed per
position before anything is ordered. Ordering then happens inside coordinate
blocks of ``BLOCK`` bases, so one window partition holds at most ``BLOCK``
positions whatever the depth, and the carry between blocks comes from one small
row per block (a 250 Mb chromosome has about a thousand).

Intervals need ``end_pos > start_pos`` and non-null keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from . import cells

BLOCK = 1 << 18
START, END = "start_pos", "end_pos"


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def position_block(pos: str, block: int) -> Column:
    return F.floor(F.col(pos) / F.lit(block)).cast("long")


def sum_by_position(
    events: DataFrame, by: Sequence[str], measures: Sequence[str], pos: str = "pos", lasts: Sequence[str] = (), nexts: Sequence[str] = ()
) -> DataFrame:
    """One row per (keys, position): hot positions are combined map-side."""
    aggs = [F.sum(m).alias(m) for m in measures] + [F.max(m).alias(m) for m in lasts] + [F.min(m).alias(m) for m in nexts]
    return events.groupBy(*by, pos).agg(*aggs)


def own_shuffle(keys: Sequence[str]) -> list[Column]:
    """Grouping columns for a table that is joined back on ``keys`` to rows with many copies of a key.

    The extra column ``_own``, a hash of the keys, changes no group but gives the join a
    shuffle of its own, and only then can Spark split the copies of a hot key over tasks.
    """
    return [F.col(k) for k in keys] + [F.xxhash64(*keys).alias("_own")]


def fractional(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))


def whole(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.IntegralType)


def exact(df: DataFrame, c: str, digits: int = 6) -> Column:
    """A measure whose sums and differences are exact: whole numbers as they are, fractions as decimals of ``digits`` digits."""
    return F.col(c).cast(f"decimal({13 + digits},{digits})") if fractional(df, c) else F.col(c)


def interval_events(df: DataFrame, by: Sequence[str], weight: Column | None = None, gap: int = 0) -> DataFrame:
    """+weight at the start, -weight at the end (moved right by ``gap``), as column ``step``."""
    w = F.lit(1).cast("long") if weight is None else weight
    points = F.array(
        F.struct(F.col(START).cast("long").alias("pos"), w.alias("step")),
        F.struct((F.col(END) + gap).cast("long").alias("pos"), (-w).alias("step")),
    )
    return df.select(*by, F.explode(points).alias("p")).select(*by, "p.pos", "p.step")


def running_sums(
    rows: DataFrame,
    by: Sequence[str],
    measures: Sequence[str],
    pos: str = "pos",
    block: float | Column = BLOCK,
    lasts: Sequence[str] = (),
    nexts: Sequence[str] = (),
) -> DataFrame:
    """Add ``cum_<measure>`` (sum up to and including the row) and ``next_pos`` per key.

    ``block`` is the width of a block of positions, or a column with the number of the
    block, which does not fall with the position.

    Columns in ``lasts`` get the greatest value so far in ``last_<c>``, columns in
    ``nexts`` the least value from the row on in ``first_<c>``. ``rows`` holds one
    row per (keys, position).
    """
    by = list(by)
    rows = rows.withColumn("_block", block if isinstance(block, Column) else position_block(pos, block))
    # stated here, where the two uses below share it; the join would add it to one of them only
    # and Spark would run the shuffle twice
    rows = rows.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in [*by, "_block"]]))
    rows = rows.repartition(*by, "_block")
    inside, across = W.partitionBy(*by, "_block").orderBy(pos), W.partitionBy(*by).orderBy("_block")
    upto, onward = inside.rowsBetween(W.unboundedPreceding, W.currentRow), inside.rowsBetween(W.currentRow, W.unboundedFollowing)
    before, after = across.rowsBetween(W.unboundedPreceding, -1), across.rowsBetween(1, W.unboundedFollowing)
    # Spark would round the sum of two decimals of 38 digits to 6 places
    wide = {f.name: T.DecimalType(32, f.dataType.scale) for f in rows.schema.fields if isinstance(f.dataType, T.DecimalType)}
    exactly = lambda c, m: F.col(c).cast(wide[m]) if m in wide else F.col(c)
    detail = rows.select(
        "*",
        *[F.sum(m).over(upto).alias(f"_in_{m}") for m in measures],
        *[F.max(m).over(upto).alias(f"_in_{m}") for m in lasts],
        *[F.min(m).over(onward).alias(f"_in_{m}") for m in nexts],
        F.lead(pos).over(inside).alias("_next_in"),
    )
    totals = [F.sum(m).alias(f"_t_{m}") for m in measures] + [F.max(m).alias(f"_t_{m}") for m in lasts] + [F.min(m).alias(f"_t_{m}") for m in nexts]
    carry = (
        rows.groupBy(*by, "_block")
        .agg(*totals, F.min(pos).alias("_first"))
        .select(
            *by,
            "_block",
            *[F.coalesce(F.sum(f"_t_{m}").over(before), F.lit(0)).alias(f"_c_{m}") for m in measures],
            *[F.max(f"_t_{m}").over(before).alias(f"_c_{m}") for m in lasts],
            *[F.min(f"_t_{m}").over(after).alias(f"_c_{m}") for m in nexts],
            F.lead("_first").over(across).alias("_next_block"),
        )
    )
    return detail.join(carry, [*by, "_block"]).select(
        *[c for c in rows.columns if c != "_block"],
        *[(exactly(f"_in_{m}", m) + exactly(f"_c_{m}", m)).alias(f"cum_{m}") for m in measures],
        *[F.coalesce(f"_in_{m}", f"_c_{m}").alias(f"last_{m}") for m in lasts],
        *[F.coalesce(f"_in_{m}", f"_c_{m}").alias(f"first_{m}") for m in nexts],
        F.coalesce("_next_in", "_next_block").alias("next_pos"),
    )


def next_in_order(rows: DataFrame, by: Sequence[str], pos: str = "pos", block: int = BLOCK) -> DataFrame:
    """Add ``next_pos``, the following position of the same key."""
    return running_sums(rows, by, [], pos, block)


def state_edges(
    events: DataFrame,
    by: Sequence[str],
    inside: Callable[..., Column],
    measures: Sequence[str] = ("step",),
    block: int = BLOCK,
) -> DataFrame:
    """Positions where ``inside(*running sums)`` flips: step +1 on entry, -1 on exit."""
    rows = sum_by_position(events, by, measures)
    rows = rows.where(reduce(Column.__or__, [F.col(m) != 0 for m in measures]))
    run = running_sums(rows, by, measures, block=block)
    now = inside(*[F.col(f"cum_{m}") for m in measures])
    was = inside(*[F.col(f"cum_{m}") - F.col(m) for m in measures])
    return run.where(now != was).select(*by, "pos", F.when(now, 1).otherwise(-1).cast("long").alias("step"))


def edges_to_regions(edges: DataFrame, by: Sequence[str], block: int = BLOCK) -> DataFrame:
    """Pair every entry with the exit that follows it."""
    return (
        next_in_order(edges, by, block=block)
        .where("step = 1")
        .select(*by, F.col("pos").alias(START), F.col("next_pos").alias(END))
    )


def at_both_ends(
    a: DataFrame,
    events: DataFrame,
    by: Sequence[str],
    at_start: Sequence[str],
    at_end: Sequence[str],
    lasts: Sequence[str] = (),
    nexts: Sequence[str] = (),
    block: int = BLOCK,
) -> DataFrame:
    """Attach running sums of ``events`` at the start and the end of each row of ``a``, events at the point included; rows with a NULL key get 0.

    ``at_start`` columns come back as ``s_<m>`` and ``at_end`` as ``e_<m>``; the
    greatest ``lasts`` up to the start as ``s_<m>``, the least ``nexts`` from the
    end on as ``e_<m>``. Only distinct positions are swept, so neither a pile-up of
    events nor copies of a row of ``a`` meet in one task before the join back.
    """
    by = list(by)
    sums = sorted(set(at_start) | set(at_end))
    every = [*sums, *lasts, *nexts]
    where = [*by, START, END]
    ends = F.array(*[F.struct(F.lit(side).alias("side"), F.col(c).cast("long").alias("pos")) for side, c in (("s", START), ("e", END))])
    points = a.select(*where).distinct().select(*where, F.explode(ends).alias("p")).select(*where, "p.*")
    kinds = {m: events.schema[m].dataType for m in every}
    asked = points.select(*by, "pos", *[F.lit(None).cast(kinds[m]).alias(m) for m in every], F.lit(1).alias("_asked"))
    rows = events.select(*by, "pos", *every, F.lit(0).alias("_asked")).unionByName(asked)
    rows = sum_by_position(rows, by, sums, lasts=[*lasts, "_asked"], nexts=nexts)
    rows = rows.withColumns({m: F.coalesce(m, F.lit(0).cast(kinds[m])) for m in sums})
    run = running_sums(rows, by, sums, block=block, lasts=lasts, nexts=nexts).where("_asked = 1")
    wanted = [("s", f"cum_{m}", m) for m in at_start] + [("s", f"last_{m}", m) for m in lasts]
    wanted += [("e", f"cum_{m}", m) for m in at_end] + [("e", f"first_{m}", m) for m in nexts]
    run = run.select(*by, "pos", *sorted({c for _, c, _ in wanted}))
    # sizes of listed points are underrated from those of the files, so neither side may go through the driver
    values = points.join(run.hint("merge"), [*by, "pos"]).groupBy(*own_shuffle(where)).agg(
        *[F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{side}_{m}") for side, c, m in wanted]
    )
    # a row with a NULL key meets no event
    out = a.join(values.drop("_own").hint("merge"), where, "left")
    sums = [(f"s_{m}", m) for m in at_start] + [(f"e_{m}", m) for m in at_end]
    return out.withColumns({c: F.coalesce(c, F.lit(0).cast(values.schema[c].dataType)) for c, _ in sums})


# --- region algebra ---------------------------------------------------------


def merge_intervals(
    df: DataFrame,
    gap: int = 0,
    by: Sequence[str] = ("chrom",),
    names: str | None = None,
    sep: str = ",",
    block: int = BLOCK,
) -> DataFrame:
    """Union of rows that overlap, touch or lie at most ``gap`` apart; optionally their distinct names joined."""
    by = list(by)
    events = interval_events(df, by, gap=gap)
    merged = edges_to_regions(state_edges(events, by, lambda d: d > 0, block=block), by, block)
    merged = merged.withColumn(END, F.col(END) - gap)
    if names is None:
        return merged
    from .overlap import overlap_join

    # a row lies in exactly one island, so its first base finds it
    first_base = df.select(*by, START, (F.col(START) + 1).alias(END), names).distinct()
    hits = overlap_join(merged, first_base, by=by, suffix="_m")
    joined = hits.groupBy(*by, START, END).agg(F.array_join(F.array_sort(F.collect_set(f"{names}_m")), sep).alias("names"))
    return joined


def whole_sequences(sizes: DataFrame, size: str = "size") -> DataFrame:
    return sizes.select("chrom", F.lit(0).cast("long").alias(START), F.col(size).cast("long").alias(END))


def complement(df: DataFrame, sizes: DataFrame, by: Sequence[str] = (), only_hit: bool = True, block: int = BLOCK) -> DataFrame:
    """Gaps of each (keys, chrom) inside [0, size).

    With ``only_hit`` chromosomes without rows are left out, else they are
    reported whole.
    """
    keys = [*by, "chrom"]
    if only_hit:
        wanted = df.select(*keys).distinct()
    elif by:
        raise ValueError("complements of several sets cover the sequences each set has rows on")
    else:
        wanted = sizes.select("chrom")
    frame = wanted.join(whole_sequences(sizes), "chrom")
    zero = F.lit(0).cast("long")
    events = interval_events(df, keys).select(*keys, "pos", "step", zero.alias("frame")).unionByName(
        interval_events(frame, keys).select(*keys, "pos", zero.alias("step"), F.col("step").alias("frame"))
    )
    edges = state_edges(events, keys, lambda d, f: (d <= 0) & (f > 0), ("step", "frame"), block)
    return edges_to_regions(edges, keys, block)


def uncovered(a: DataFrame, b: DataFrame, by: Sequence[str] = ("chrom",), block: int = BLOCK) -> DataFrame:
    """Maximal regions covered by ``a`` and by no row of ``b``."""
    zero = F.lit(0).cast("long")
    events = interval_events(a, by).select(*by, "pos", "step", zero.alias("minus")).unionByName(
        interval_events(b, by).select(*by, "pos", zero.alias("step"), F.col("step").alias("minus"))
    )
    edges = state_edges(events, by, lambda x, y: (x > 0) & (y <= 0), ("step", "minus"), block)
    return edges_to_regions(edges, by, block)


def subtract(a: DataFrame, b: DataFrame, by: Sequence[str] = ("chrom",), block: int = BLOCK) -> DataFrame:
    """Each row of ``a`` minus the union of ``b``; every remaining piece is a row with ``a``'s other columns."""
    from .overlap import overlap_join

    pieces = overlap_join(a, uncovered(a, b, by, block), by=by, suffix="_p")
    return pieces.select(
        *[c for c in a.columns if c not in (START, END)],
        F.greatest(START, f"{START}_p").alias(START),
        F.least(END, f"{END}_p").alias(END),
    )


def set_count_regions(
    df: DataFrame,
    member: Sequence[str],
    keep: Callable[[Column], Column],
    by: Sequence[str] = ("chrom",),
    block: int = BLOCK,
) -> DataFrame:
    """Regions where ``keep(number of members covering the base)`` holds; a member counts once per base."""
    per_member = state_edges(interval_events(df, [*member, *by]), [*member, *by], lambda d: d > 0, block=block)
    return edges_to_regions(state_edges(per_member.select(*by, "pos", "step"), by, keep, block=block), by, block)


def multi_intersect(df: DataFrame, set_col: str, sets: Sequence[str], by: Sequence[str] = ("chrom",), block: int = BLOCK) -> DataFrame:
    """Pieces present in all of ``sets``, with the sets listed in ``set_names``."""
    wanted = df.where(F.col(set_col).isin(*sets))
    regions = set_count_regions(wanted, [set_col], lambda d: d >= len(set(sets)), by, block)
    return regions.withColumn("set_names", F.lit(",".join(sorted(set(sets)))))


def disjoin(df: DataFrame, by: Sequence[str] = ("chrom",), block: int = BLOCK) -> DataFrame:
    """Cut at every start and end; keep the covered pieces, equal depths left apart."""
    rows = sum_by_position(interval_events(df, by), by, ["step"])
    run = running_sums(rows, by, ["step"], block=block)
    return run.where("cum_step > 0").select(*by, F.col("pos").alias(START), F.col("next_pos").alias(END))


def make_windows(sizes: DataFrame, width: int) -> DataFrame:
    """Fixed tiles over every sequence, the last one clipped."""
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size").cast("long") - 1, F.lit(width).cast("long")))
    return (
        sizes.where("size > 0")
        .select("chrom", "size", start.alias(START))
        .select("chrom", START, F.least(F.col(START) + width, F.col("size").cast("long")).alias(END))
    )


def depth_runs(df: DataFrame, by: Sequence[str] = ("chrom",), weight: str | None = None, block: int = BLOCK, digits: int = 6) -> DataFrame:
    """Maximal runs of equal non-zero depth, or of the summed ``weight``; fractional weights count to ``digits`` digits."""
    if weight is None or whole(df, weight):
        step = F.lit(1) if weight is None else F.col(weight)
        rows = df.select(*by, F.col(START).cast("long").alias("_s"), F.col(END).cast("long").alias("_e"), step.cast("long").alias("step"))
        return cells.runs(rows, by, block).withColumnsRenamed({"pos": START, "next_pos": END})
    w = exact(df, weight, digits)
    rows = sum_by_position(interval_events(df, by, w), by, ["step"]).where("step <> 0")
    run = running_sums(rows, by, ["step"], block=block)
    depth = F.col("cum_step").cast("double") if fractional(df, weight) else F.col("cum_step")
    return run.where("cum_step <> 0").select(*by, F.col("pos").alias(START), F.col("next_pos").alias(END), depth.alias("depth"))


def merge_tracks(*tracks: DataFrame, block: int = BLOCK, digits: int = 6) -> DataFrame:
    """Sum of depth tracks; fractional depths count to ``digits`` digits."""
    cols = ["chrom", START, END, "depth"]
    return depth_runs(union_all([t.select(*cols) for t in tracks]), weight="depth", block=block, digits=digits)


def depth_per_base(df: DataFrame, sizes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every position, 1-based, zeros included."""
    zero_rows = whole_sequences(sizes).withColumn("depth", F.lit(0).cast("long"))
    rows = sum_by_position(
        interval_events(df, ["chrom"]).unionByName(
            interval_events(zero_rows, ["chrom"], F.lit(0).cast("long"))
        ),
        ["chrom"],
        ["step"],
    )
    run = running_sums(rows, ["chrom"], ["step"], block=block).where("next_pos is not null")
    run = run.join(sizes.select("chrom", F.col("size").cast("long").alias("size")), "chrom").where("pos < size")
    # long runs are cut to at most ``block`` positions before they are listed
    cuts = F.explode(F.sequence(F.col("pos"), F.least("next_pos", "size") - 1, F.lit(block).cast("long")))
    run = run.select("chrom", "cum_step", F.least("next_pos", "size").alias("stop"), cuts.alias("lo"))
    spot = F.explode(F.sequence(F.col("lo") + 1, F.least(F.col("lo") + block, F.col("stop"))))
    return run.select("chrom", spot.alias("pos"), F.col("cum_step").alias("depth"))

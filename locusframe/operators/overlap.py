"""Joins on overlapping half-open intervals.

Spark has no range join, so pairs are found with an equi-join on (keys, level,
bin). A row has the lowest level whose bins it fills at most ``TILES`` of, and is
listed in those; bins of a level are ``STEP`` times as wide as those below. Two
rows meet at the higher of their levels, so the lower one is also listed there, in
the bin or two that hold it, provided the other side has rows of that level. A row
is thus listed a bounded number of times whatever its length, and two long rows
meet in a few wide bins instead of thousands of narrow ones.

A pair is kept only in the first bin the two share, which needs no ``distinct``.
Bins spread one chromosome over many partitions; a bin that is still hot is split
by the adaptive skew join, which the output of a bin join always allows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from . import cells
from .lineage import written_once
from .sweep import BLOCK, END, START, at_both_ends, exact, fractional, interval_events, own_shuffle, running_sums, state_edges, whole

# Width of the lowest bins; choose one near the typical length of the longer side.
WIDTH = 1 << 14
#: Bins of its level that a row touches at most, less one.
TILES = 16
#: Bins of one level in a bin of the next. More than twice TILES, so a lower row lies in two bins at most.
STEP = 64
#: Levels above the lowest; the last takes rows of any length.
TOP = 3


def _level(width: int) -> Column:
    """The lowest level whose bins a row fills at most TILES of."""
    length = F.col(END) - F.col(START)
    found = F.when(length <= width * TILES, 0)
    for level in range(1, TOP):
        found = found.when(length <= width * STEP**level * TILES, level)
    return found.otherwise(TOP)


def levels_of(df: DataFrame, width: int = WIDTH) -> Column:
    """The levels that rows of ``df`` have, as bits, in a scalar subquery over start and end."""
    return F.coalesce(df.select(_level(width).alias("l")).agg(F.bit_or(F.expr("shiftleft(1, l)"))).scalar(), F.lit(0))


def _binned(df: DataFrame, others: Column, width: int, mark: str) -> DataFrame:
    """Rows listed in the bins where they can meet rows of the levels ``others``.

    ``_at`` is twice the level of the bins, plus one where rows of ``a`` are the higher ones.
    """
    own, high = F.col("_own"), int(mark == "")
    # the higher row is listed at its level; of equal levels the row of ``b`` counts as the higher
    lower = F.col("_others").bitwiseAND(F.expr("shiftleft(1, _own) - 1" if high else "shiftleft(2, _own) - 1")) != 0
    meets = [F.when(lower, own * 2 + high)]
    for level in range(TOP + 1):
        there = F.col("_others").bitwiseAND(F.lit(1 << level)) != 0
        meets.append(F.when(there & (own <= level if high else own < level), level * 2 + 1 - high))
    rows = df.withColumn("_own", _level(width)).withColumn("_others", others).withColumn("_at", F.explode(F.array(*meets)))
    rows = rows.where("_at is not null").drop("_own", "_others")
    wide = F.lit(width) * F.expr(f"shiftleft(1L, {STEP.bit_length() - 1} * shiftright(_at, 1))")
    first = F.floor(F.col(START) / wide).cast("long")
    last = F.floor((F.col(END) - 1) / wide).cast("long")
    rows = rows.withColumn(f"_first{mark}", first).withColumn(f"_bin{mark}", F.explode(F.sequence(first, F.greatest(first, last))))
    return rows.withColumnRenamed("_at", f"_at{mark}")


def _suffixed(df: DataFrame, suffix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c + suffix) for c in df.columns])


def _pairs(a: DataFrame, b: DataFrame, by: Sequence[str], suffix: str, width: int, short: bool) -> DataFrame:
    levels = lambda df: F.lit(1) if short else levels_of(df, width)
    left = _binned(a, levels(b), width, "")
    right = _binned(b, levels(a), width, "_r")
    right = right.withColumnsRenamed({c: c + suffix for c in b.columns})
    on = [F.col(k) == F.col(k + suffix) for k in by]
    on += [
        F.col("_at") == F.col("_at_r"),
        F.col("_bin") == F.col("_bin_r"),
        F.col("_bin") == F.greatest("_first", "_first_r"),
        F.col(START) < F.col(END + suffix),
        F.col(START + suffix) < F.col(END),
    ]
    return left.join(right, on).drop("_at", "_bin", "_first", "_at_r", "_bin_r", "_first_r")


def overlap_join(
    a: DataFrame,
    b: DataFrame,
    how: str = "inner",
    by: Sequence[str] = ("chrom",),
    suffix: str = "_b",
    min_frac: float | None = None,
    reciprocal: bool = False,
    width: int = WIDTH,
    longest: int | None = None,
) -> DataFrame:
    """All overlapping pairs with the shared bases in ``bp``; columns of ``b`` get ``suffix``.

    ``how='left'`` keeps rows of ``a`` without any accepted partner, with ``bp`` 0. ``longest`` is a length
    that no row of ``a`` and ``b`` exceeds, where the caller knows one: up to TILES widths the
    levels of the sides, else one more pass over start and end of each, need not be looked up.
    """
    by = list(by)
    pairs = _pairs(a, b, by, suffix, width, longest is not None and longest <= width * TILES)
    bp = F.least(END, END + suffix) - F.greatest(START, START + suffix)
    pairs = pairs.withColumn("bp", bp.cast("long"))
    if min_frac is not None:
        keep = F.col("bp") >= min_frac * (F.col(END) - F.col(START))
        if reciprocal:
            keep = keep & (F.col("bp") >= min_frac * (F.col(END + suffix) - F.col(START + suffix)))
        pairs = pairs.where(keep)
    pairs = pairs.drop(*[k + suffix for k in by])
    if how == "inner":
        return pairs
    if how != "left":
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    added = [f for f in pairs.schema.fields if f.name not in a.columns and f.name != "bp"]
    if min_frac is None:
        alone = overlap_anti(a, b, by=by)
    else:
        # a fraction test is decided pair by pair, so the rows themselves are compared
        hit = pairs.select(*a.columns).distinct()
        same = reduce(Column.__and__, [a[c].eqNullSafe(hit[c]) for c in a.columns])
        alone = a.join(hit, same, "left_anti")
    alone = alone.select(*a.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in added], F.lit(0).cast("long").alias("bp"))
    return pairs.unionByName(alone)


def _hit_events(b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Events whose sums give ``opened`` starts before a point and ``closed`` ends at or before it."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    points = F.array(
        F.struct((F.col(START) + 1).cast("long").alias("pos"), one.alias("opened"), none.alias("closed")),
        F.struct(F.col(END).cast("long").alias("pos"), none.alias("opened"), one.alias("closed")),
    )
    return b.select(*by, F.explode(points).alias("p")).select(*by, "p.*")


def _area_events(track: DataFrame, by: Sequence[str], value: Column, slope: str, moment: str) -> DataFrame:
    """Events for the integral of ``value``: up to x it is x * (sum of slopes) - (sum of moments)."""
    events = interval_events(track, by, value)
    # a decimal step keeps its digits in the product
    pos = F.col("pos").cast("decimal(12,0)") if isinstance(events.schema["step"].dataType, T.DecimalType) else F.col("pos")
    return events.select(*by, "pos", F.col("step").alias(slope), (F.col("step") * pos).alias(moment))


def _digits(kind: T.DataType) -> int | None:
    return kind.scale if isinstance(kind, T.DecimalType) else None


def _area(slope: str, moment: str, digits: int | None = None) -> Column:
    """The integral between both ends; with ``digits`` of decimals, in types whose product keeps them."""
    def upto(end: str, side: str) -> Column:
        if digits is None:
            return F.col(end).cast("long") * F.col(f"{side}_{slope}") - F.col(f"{side}_{moment}")
        product = F.col(end).cast("decimal(12,0)") * F.col(f"{side}_{slope}").cast(f"decimal(22,{digits})")
        return product - F.col(f"{side}_{moment}").cast(f"decimal(35,{digits})")

    return upto(END, "e") - upto(START, "s")


def _stacked(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def _hits() -> Column:
    return F.col("e_opened") - F.col("s_closed")


def coverage_counts(a: DataFrame, b: DataFrame, by: Sequence[str] = ("chrom",), block: int = BLOCK) -> DataFrame:
    """Rows of ``a`` with the number of overlapping rows of ``b`` in ``num_overlaps``.

    It is the rows of ``b`` that start before the end minus those that end by the
    start. No pair is built, so a pile-up of ``b`` costs no more than its distinct
    positions.
    """
    out = at_both_ends(a, _hit_events(b, by), by, ["closed"], ["opened"], block=block)
    return out.withColumn("num_overlaps", _hits()).select(*a.columns, "num_overlaps")


def overlap_semi(a: DataFrame, b: DataFrame, by: Sequence[str] = ("chrom",), block: int = BLOCK) -> DataFrame:
    """Rows of ``a`` with any overlap in ``b``."""
    return coverage_counts(a, b, by, block).where("num_overlaps > 0").drop("num_overlaps")


def overlap_anti(a: DataFrame, *others: DataFrame, by: Sequence[str] = ("chrom",), block: int = BLOCK) -> DataFrame:
    """Rows of ``a`` that overlap nothing in any of the other sets."""
    cols = [*by, START, END]
    b = reduce(DataFrame.unionByName, [o.select(*cols) for o in others])
    return coverage_counts(a, b, by, block).where("num_overlaps = 0").drop("num_overlaps")


def coverage(a: DataFrame, b: DataFrame, by: Sequence[str] = ("chrom",), block: int = BLOCK) -> DataFrame:
    """Per row of ``a``: hit count, bases covered by the union of ``b``, length, covered fraction."""
    edges = state_edges(interval_events(b, by), by, lambda d: d > 0, block=block)
    islands = edges.select(*by, "pos", F.col("step").alias("slope"), (F.col("step") * F.col("pos")).alias("moment"))
    events = _stacked([_hit_events(b, by), islands])
    out = at_both_ends(a, events, by, ["closed", "slope", "moment"], ["opened", "slope", "moment"], block=block)
    length = (F.col(END) - F.col(START)).cast("long")
    area = _area("slope", "moment")
    return out.select(
        *a.columns, _hits().alias("num_overlaps"), area.alias("covered_bp"), length.alias("length"), (area / length).alias("fraction")
    )


def island_events(b: DataFrame, by: Sequence[str] = ("chrom",), block: int = BLOCK) -> DataFrame:
    """Events (slope, moment) of the bases that the union of ``b`` covers, for ``areas``."""
    edges = state_edges(interval_events(b, by), by, lambda d: d > 0, block=block)
    return edges.select(*by, "pos", F.col("step").alias("slope"), (F.col("step") * F.col("pos")).alias("moment"))


def areas(a: DataFrame, events: dict[str, DataFrame], by: Sequence[str] = ("chrom",), block: int = BLOCK) -> DataFrame:
    """Rows of ``a`` with the integral of every event set, one column each, from a single sweep."""
    frames = [e.select(*by, "pos", F.col("slope").alias(f"slope_{n}"), F.col("moment").alias(f"moment_{n}")) for n, e in events.items()]
    cols = [f"{c}_{n}" for n in events for c in ("slope", "moment")]
    out = at_both_ends(a, _stacked(frames), by, cols, cols, block=block)
    return out.select(*a.columns, *[_area(f"slope_{n}", f"moment_{n}", _digits(e.schema["moment"].dataType)).alias(n) for n, e in events.items()])


def track_events(track: DataFrame, value: str = "depth", by: Sequence[str] = ("chrom",), digits: int = 6) -> tuple[DataFrame, DataFrame]:
    """Events of the covered bases and of the depth sum of a track, for ``areas``."""
    amount = exact(track, value, digits) if fractional(track, value) else F.col(value).cast("long")
    covered = _area_events(track.where(F.col(value) != 0), by, F.lit(1).cast("long"), "slope", "moment")
    return covered, _area_events(track, by, amount, "slope", "moment")


def covered_bp(a: DataFrame, b: DataFrame, by: Sequence[str] = ("chrom",), name: str = "covered_bp", block: int = BLOCK) -> DataFrame:
    """Rows of ``a`` with the bases covered by the union of ``b``."""
    edges = state_edges(interval_events(b, by), by, lambda d: d > 0, block=block)
    islands = edges.select(*by, "pos", F.col("step").alias("slope"), (F.col("step") * F.col("pos")).alias("moment"))
    out = at_both_ends(a, islands, by, ["slope", "moment"], ["slope", "moment"], block=block)
    return out.select(*a.columns, _area("slope", "moment").alias(name))


def map_mean(a: DataFrame, b: DataFrame, score: str = "score", min_frac: float = 0.25, digits: int = 3) -> DataFrame:
    """Mean of ``b.score`` over rows that cover at least ``min_frac`` of ``a``; NULL without any."""
    key = ["chrom", START, END]
    hits = overlap_join(a.select(*key).distinct(), b.select(*key, score), min_frac=min_frac)
    means = hits.groupBy(*own_shuffle(key)).agg(F.round(F.avg(f"{score}_b"), digits).alias("mean_score"))
    return a.join(means.drop("_own"), key, "left")


def region_average(
    regions: DataFrame, track: DataFrame, value: str = "depth", by: Sequence[str] = ("chrom",), block: int = BLOCK, digits: int = 6
) -> DataFrame:
    """Per region: size, covered bases, depth sum, mean over the size (mean0) and over the covered bases.

    ``track`` is a depth track: its rows do not overlap. A fractional depth counts
    to ``digits`` digits and gives a fractional sum.
    """
    size = (F.col(END) - F.col(START)).cast("long")
    if whole(track, value):
        amount = F.col(value).cast("long")
        runs = track.select(*by, F.col(START).cast("long").alias("_s"), F.col(END).cast("long").alias("_e"), amount.alias("_total"), (amount != 0).cast("long").alias("_covered"))
        out = cells.areas_between(regions, runs, by, ["_total", "_covered"], START, END, block)
        out = out.select(*regions.columns, size.alias("size"), F.col("_covered").alias("covered"), F.col("_total").alias("total"))
    else:
        depth = _area_events(track, by, exact(track, value, digits) if fractional(track, value) else F.col(value).cast("long"), "slope", "moment")
        events = _stacked([depth, _area_events(track.where(F.col(value) != 0), by, F.lit(1).cast("long"), "one", "spot")])
        cols = ["slope", "moment", "one", "spot"]
        out = at_both_ends(regions, events, by, cols, cols, block=block)
        total = _area("slope", "moment", digits).cast("double") if fractional(track, value) else _area("slope", "moment")
        out = out.select(*regions.columns, size.alias("size"), _area("one", "spot").alias("covered"), total.alias("total"))
    return out.withColumn("mean0", F.col("total") / F.col("size")).withColumn(
        "mean", F.coalesce(F.try_divide("total", "covered"), F.lit(0.0))
    )


def nearest(a: DataFrame, b: DataFrame, by: Sequence[str] = ("chrom",), block: int = BLOCK) -> DataFrame:
    """Add ``distance``: bases between the row and the nearest row of ``b``, 0 when they overlap or touch.

    NULL when the chromosome has no row of ``b``.
    """
    ends = b.select(*by, F.col(END).cast("long").alias("pos"), F.col(END).cast("long").alias("stop"))
    starts = b.select(*by, F.col(START).cast("long").alias("pos"), F.col(START).cast("long").alias("begin"))
    events = _stacked([_hit_events(b, by), ends, starts])
    out = at_both_ends(a, events, by, ["closed"], ["opened"], lasts=["stop"], nexts=["begin"], block=block)
    gap = F.least(F.col(START) - F.col("s_stop"), F.col("e_begin") - F.col(END)).cast("long")
    return out.select(*a.columns, F.when(_hits() > 0, F.lit(0).cast("long")).otherwise(gap).alias("distance"))


def padded_lookup(a: DataFrame, b: DataFrame, pad: int = 100_000, ident: str = "name", empty: str = "none") -> DataFrame:
    """Ids and sizes of ``b`` rows within ``pad`` bases of each row of ``a``, string-joined."""
    wide = a.withColumn("_s", F.col(START)).withColumn("_e", F.col(END))
    wide = wide.withColumn(START, F.greatest(F.col(START) - pad, F.lit(0))).withColumn(END, F.col(END) + pad)
    hits = overlap_join(wide.select("chrom", START, END, "_s", "_e").distinct(), b.select("chrom", START, END, ident))
    hits = hits.select("chrom", F.col("_s").alias("_1"), F.col("_e").alias("_2"), f"{ident}_b", f"{START}_b", f"{END}_b")
    found = hits.groupBy(*own_shuffle(["chrom", "_1", "_2"])).agg(
        F.array_sort(F.collect_list(F.struct(F.col(f"{ident}_b").alias("id"), (F.col(END + "_b") - F.col(START + "_b")).alias("size")))).alias("found")
    )
    found = found.select("chrom", F.col("_1").alias(START), F.col("_2").alias(END), "found")
    out = a.join(found.hint("merge"), ["chrom", START, END], "left")
    joined = lambda field: F.when(F.col("found").isNull(), F.lit(empty)).otherwise(F.array_join(F.transform("found", lambda x: x[field].cast("string")), ","))
    return out.withColumn("near_ids", joined("id")).withColumn("near_sizes", joined("size")).drop("found")


#: Keys behind each bound between the ranges of ``pair_combinations``.
KEYS_PER_BOUND = 64


def pair_combinations(df: DataFrame, key: str, carry: Sequence[str] = (), parts: int | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Unordered pairs of rows, keys ascending.

    The result has as many rows as there are pairs. Rows are dealt into ``parts`` ranges of their key, and
    each two ranges meet in a cell of their own, an equi-join with one task a cell: rows of
    different ranges are pairs without a comparison, and no pair is met twice. By default there are
    about as many cells as shuffle partitions, at least 136. The bounds of the ranges are keys with the smallest hashes,
    so they depend on the keys alone; ``keys`` has all keys where ``df`` is dear to compute.
    """
    if parts is None:
        parts = max(16, int((2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))) ** 0.5) + 1)
    rows = df.select(key, *carry).where(F.col(key).isNotNull())
    known = (rows if keys is None else keys).select(F.col(key).alias("_key")).where(F.col("_key").isNotNull()).distinct()
    some = known.orderBy(F.xxhash64("_key"), "_key").limit(KEYS_PER_BOUND * parts).agg(F.array_sort(F.collect_list("_key")).alias("_keys"))
    at = lambda i: F.get("_keys", F.floor(i * F.size("_keys") / parts).cast("int"))
    bounds = some.select(F.transform(F.sequence(F.lit(1), F.lit(parts - 1)), at)).scalar() if parts > 1 else F.array()
    rows = rows.withColumn("_bounds", bounds).withColumn("_part", F.size(F.filter("_bounds", lambda x: x <= F.col(key)))).drop("_bounds")
    cell = lambda low, high: F.shiftright(high * (high + 1), 1) + low
    others = lambda first, last: F.explode(F.sequence(first, last))
    a = rows.withColumn("_with", others(F.col("_part"), F.lit(parts - 1))).withColumn("_cell", cell(F.col("_part"), F.col("_with")))
    b = rows.withColumn("_with", others(F.lit(0), F.col("_part"))).withColumn("_cell", cell(F.col("_with"), F.col("_part")))
    a = a.withColumn("_apart", F.col("_part") < F.col("_with"))
    dealt = lambda side, s: _suffixed(side.drop("_part", "_with"), s).repartitionById(parts * (parts + 1) // 2, F.col(f"_cell{s}"))
    met = F.col("_apart_a") | (F.col(f"{key}_a") < F.col(f"{key}_b"))
    pairs = dealt(a, "_a").join(dealt(b, "_b").hint("merge"), (F.col("_cell_a") == F.col("_cell_b")) & met)
    return pairs.select(*[F.col(f"{c}_{s}") for c in [key, *carry] for s in "ab"])


#: Sets whose membership one long holds.
SETS_IN_A_WORD = 62


def membership_runs(df: DataFrame, set_col: str, numbers: DataFrame, n_sets: int, block: int = BLOCK) -> DataFrame:
    """Rows (sets, bp, n), one for each combination of at least two sets: bases that exactly these cover, and beginnings.

    ``numbers`` has the sets with their ``number`` from 0. A sweep carries the active sets as bits, in
    words of 62, and runs are summed by their bits. n counts the runs at which a
    combination stands, less those at which it stood before; summed over the combinations that hold
    two sets it counts the intersections of their merged rows.
    """
    by = [set_col, "chrom"]
    words = [f"w{i}" for i in range(max(1, -(-n_sets // SETS_IN_A_WORD)))]
    edges = state_edges(interval_events(df, by), by, lambda d: d > 0, block=block).join(numbers, set_col)
    bit = F.col("step") * F.expr(f"shiftleft(cast(1 as bigint), cast(number % {SETS_IN_A_WORD} as int))")
    place = F.floor(F.col("number") / SETS_IN_A_WORD)
    steps = edges.groupBy("chrom", "pos").agg(*[F.sum(F.when(place == i, bit).otherwise(F.lit(0).cast("long"))).alias(w) for i, w in enumerate(words)])
    run = running_sums(steps, ["chrom"], words, block=block)
    now = [F.col(f"cum_{w}") for w in words]
    both = [c.bitwiseAND(c - F.col(w)) for c, w in zip(now, words)]
    struct = lambda bits, bp, n: F.struct(*[b.alias(w) for b, w in zip(bits, words)], bp.alias("bp"), F.lit(n).cast("long").alias("n"))
    runs = run.select(F.explode(F.array(struct(now, F.coalesce(F.col("next_pos") - F.col("pos"), F.lit(0).cast("long")), 1), struct(both, F.lit(0).cast("long"), -1))).alias("r")).select("r.*")
    members = sum((F.bit_count(w) for w in words[1:]), F.bit_count(words[0]))
    sums = runs.where(members > 1).groupBy(*words).agg(F.sum("bp").alias("bp"), F.sum("n").alias("n"))
    places = F.sequence(F.lit(0), F.lit(SETS_IN_A_WORD - 1))
    on = lambda w: F.filter(places, lambda x: F.getbit(F.col(w), x) == 1)
    numbered = lambda xs, first: F.transform(xs, lambda x: (x + first).cast("long"))
    held = [numbered(on(w), i * SETS_IN_A_WORD) for i, w in enumerate(words)]
    return sums.select(F.concat(*held).alias("sets"), "bp", "n")


def interval_jaccard(df: DataFrame, set_col: str, block: int = BLOCK) -> DataFrame:
    """Per unordered pair of sets: shared bases, union bases, ratio and number of intersections.

    One sweep for all sets: pairs are made from the sums of each combination of sets, not from rows that overlap.
    """
    names = df.select(set_col).where(F.col(set_col).isNotNull()).distinct()
    numbers = written_once(names.withColumn("number", (F.row_number().over(W.orderBy(set_col)) - 1).cast("long")))  # one row for each set
    runs = membership_runs(df, set_col, numbers, numbers.count(), block)
    pairs = runs.withColumn("a", F.explode("sets")).withColumn("b", F.explode(F.filter("sets", lambda x: x > F.col("a"))))
    shared = pairs.groupBy("a", "b").agg(F.sum("bp").alias("intersection"), F.sum("n").alias("n_intersections"))
    by = [set_col, "chrom"]
    edges = state_edges(interval_events(df, by), by, lambda d: d > 0, block=block)
    sizes = edges.groupBy(set_col).agg(F.sum(-F.col("step") * F.col("pos")).alias("size")).join(numbers, set_col)
    every = pair_combinations(sizes, set_col, ["size", "number"], keys=numbers)
    every = every.withColumnsRenamed({f"{set_col}_a": "set_a", f"{set_col}_b": "set_b", "number_a": "a", "number_b": "b"})
    out = every.join(shared, ["a", "b"], "left").fillna(0, ["intersection", "n_intersections"])
    union = F.col("size_a") + F.col("size_b") - F.col("intersection")
    return out.select(
        "set_a", "set_b", "intersection", union.alias("union_bp"),
        F.try_divide("intersection", union).alias("jaccard"), "n_intersections",
    )

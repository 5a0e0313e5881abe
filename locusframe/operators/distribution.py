"""Exact order statistics from histograms.

Values are counted first, so what gets ordered is one row per distinct value,
and ``running_sums`` orders it in blocks of the value range. Whole numbers have
blocks of equal width, fractions blocks of about equal numbers of rows, so that an
outlier does not put all other values in one block.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from .lineage import written_once
from .sweep import BLOCK, position_block, running_sums


def same_keys(a: DataFrame, b: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be NULL; without keys ``b`` is the one-row total."""
    by = list(by)
    renamed = b.withColumnsRenamed({k: f"_r_{k}" for k in by})
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in by]) if by else F.lit(True)
    return a.join(renamed, on, how).drop(*[f"_r_{k}" for k in by])


def histogram(df: DataFrame, by: Sequence[str], value: str, weight: Column | None = None) -> DataFrame:
    """Rows (keys, value, n)."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("value")).agg(n.alias("n"))


def _keyed(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Keys as one-field structs, which are never NULL themselves, so a NULL group is a group like others."""
    return (df.withColumns({k: F.struct(F.col(k).alias("key")) for k in by}), list(by)) if by else (df.withColumn("_all", F.lit(0)), ["_all"])


def _plain(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.withColumns({k: F.col(f"{k}.key") for k in by}).drop("_all")


def _in_blocks(hist: DataFrame, pos: str, block: float) -> DataFrame:
    """Add ``_part``, the block of ``pos``: of width ``block`` for whole numbers, else one of about as many rows as the others.

    The borders between blocks of fractions are approximate quantiles in a scalar subquery, so
    nothing runs before the result is asked for. Any borders give the same sums.
    """
    if not isinstance(hist.schema[pos].dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
        return hist.withColumn("_part", position_block(pos, block))
    parts = min(1024, max(64, 2 * int(hist.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    borders = hist.agg(F.percentile_approx(pos, [i / parts for i in range(1, parts)], 10 * parts)).scalar()
    hist = hist.withColumn("_borders", borders)
    return hist.withColumn("_part", F.size(F.filter("_borders", lambda x: x <= F.col(pos))).cast("long")).drop("_borders")


def quantiles(df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float], block: float = BLOCK, weight: Column | None = None) -> DataFrame:
    """Linearly interpolated quantiles per group, one column per entry of ``probs``."""
    hist = histogram(df, by, value, weight)
    hist, keys = _keyed(hist, by)
    run = running_sums(_in_blocks(hist, "value", block), keys, ["n"], pos="value", block=F.col("_part")).drop("_part")
    run = run.join(hist.groupBy(*keys).agg(F.sum("n").alias("total")), keys)
    aggs = []
    for name, p in probs.items():
        rank = (F.col("total") - 1) * F.lit(float(p))
        low = F.floor(rank)
        high = F.least(low + 1, F.col("total") - 1)
        aggs += [
            F.min(F.when(F.col("cum_n") > low, F.col("value"))).alias(f"_lo_{name}"),
            F.min(F.when(F.col("cum_n") > high, F.col("value"))).alias(f"_hi_{name}"),
            F.max(rank - low).alias(f"_f_{name}"),
        ]
    out = _plain(run.groupBy(*keys).agg(*aggs), by)
    return out.select(
        *by,
        *[(F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}")).cast("double").alias(n) for n in probs],
    )


def describe_by(df: DataFrame, keys: Sequence[str], value: str, block: float = BLOCK) -> DataFrame:
    """count, mean, std (sample), min, quartiles and max per group."""
    basic = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    parts = quantiles(df, keys, value, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, block)
    return same_keys(basic, parts, keys)


def n50(df: DataFrame, by: Sequence[str], length: str, method: str = "standard", block: int = BLOCK) -> DataFrame:
    """First length, longest first, at which half of the bases are reached.

    ``below_half``: smallest length whose share, longest first, is still at most
    one half; NULL when the longest already exceeds it.
    """
    hist = histogram(df, by, length)
    hist, keys = _keyed(hist, by)
    hist = hist.withColumn("down", -F.col("value")).withColumn("bp", F.col("value") * F.col("n"))
    run = running_sums(hist, keys, ["bp"], pos="down", block=block)
    run = run.join(hist.groupBy(*keys).agg(F.sum("bp").alias("total")), keys)
    if method == "standard":
        found = F.max(F.when(2 * F.col("cum_bp") >= F.col("total"), F.col("value")))
    elif method == "below_half":
        found = F.min(F.when(2 * F.col("cum_bp") <= F.col("total"), F.col("value")))
    else:
        raise ValueError(f"unknown method {method!r}")
    return _plain(run.groupBy(*keys).agg(found.alias("n50")), by)


def running_total(df: DataFrame, by: Sequence[str], length: str, block: int = BLOCK) -> DataFrame:
    """Per distinct length, longest first: rows and bases so far."""
    hist = histogram(df, by, length)
    hist, keys = _keyed(hist, by)
    hist = hist.withColumn("down", -F.col("value")).withColumn("bp", F.col("value") * F.col("n"))
    run = running_sums(hist, keys, ["n", "bp"], pos="down", block=block)
    return _plain(run, by).select(*by, F.col("value").alias("length"), "n", "cum_n", "cum_bp")


def pct_rank_desc(df: DataFrame, by: Sequence[str], value: str, block: float = BLOCK) -> DataFrame:
    """Add ``pct_rank``: share of the group's rows with a value at least as great."""
    hist = histogram(df, by, value)
    hist, keys = _keyed(hist, by)
    down = _in_blocks(hist.withColumn("down", -F.col("value")), "down", block)
    run = running_sums(down, keys, ["n"], pos="down", block=F.col("_part")).drop("_part")
    run = _plain(run.join(hist.groupBy(*keys).agg(F.sum("n").alias("total")), keys), by)
    ranks = run.select(*by, F.col("value").alias("_v"), (F.col("cum_n") / F.col("total")).alias("pct_rank"))
    on = [F.col(value) == F.col("_v")] + [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in by]
    return df.join(ranks.withColumnsRenamed({k: f"_k_{k}" for k in by}), on, "left").drop("_v", *[f"_k_{k}" for k in by])


def running_in_order(df: DataFrame, by: Sequence[str], order: Sequence[str], measure: str, name: str) -> DataFrame:
    """Add ``name``, the sum of ``measure`` over the rows of the group up to and including the row, in ascending order.

    Rows are dealt into ranges of (keys, order), so a large group is spread over many tasks; the carry
    is one row for each group and range. Rows that tie are in any order.
    """
    by = list(by)
    rows = written_once(df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    inner = W.partitionBy(*by, "_range").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carry = rows.groupBy(*by, "_range").agg(F.sum(measure).alias("_held")).withColumn("_before", F.coalesce(F.sum("_held").over(before), F.lit(0))).drop("_held")
    out = same_keys(rows.withColumn(name, F.sum(measure).over(inner)), carry, [*by, "_range"])
    return out.withColumn(name, F.col(name) + F.col("_before")).select(*df.columns, name)


def top_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per group.

    Spark ranks inside every input partition before the shuffle when the rank is
    limited, so a hot group sends at most ``n`` rows per task.
    """
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_n_per_group(df, key, order, 1).drop("rank")

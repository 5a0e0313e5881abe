"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

A document's expected copies are its source's target over its source's size. Whole
copies are certain; the rest is an inclusion probability p. Documents are ranked by
random odds over inclusion odds, (u / (1 - u)) / (p / (1 - p)), and taken in that
order up to a fixed size in words. Where a long document ends the taking, the rest of
the order fills what is missing; the last place goes to the document whose size comes
nearest to the words still missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.lineage import written_once
from . import common

#: Documents in a bucket of the running sums.
BUCKET_ROWS = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Rows (source, n, source_size, target) from rows (source, n, source_size), one for each source.

    Sources in code point order, null last, weigh as `weights` says, over and over.
    They share all sizes by weight. A target stops at `most` times the source's size;
    what is over goes to the others by weight until none is above. Sources with the
    least size for their weight reach the stop first, so running sums in that order
    find them without a loop. One row for each source is ordered in one task.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("long"))
    rows = rows.withColumn("_total", F.sum("source_size").over(every)).withColumn("_weights", F.sum("_w").over(every))
    earlier = Window.orderBy(F.col("source_size") / F.col("_w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    full = F.col("source_size") * most
    rows = rows.withColumn("_size_before", F.coalesce(F.sum(full).over(earlier), F.lit(0))).withColumn("_w_before", F.coalesce(F.sum("_w").over(earlier), F.lit(0)))
    rows = rows.withColumn("_full", full * (F.col("_weights") - F.col("_w_before")) <= F.col("_w") * (F.col("_total") - F.col("_size_before")))
    rows = rows.withColumn("_rest", F.col("_total") - F.sum(F.when(F.col("_full"), full).otherwise(0)).over(every)).withColumn("_w_rest", F.col("_weights") - F.sum(F.when(F.col("_full"), F.col("_w")).otherwise(0)).over(every))
    target = F.when(F.col("_full"), full.cast("double")).otherwise(F.col("_w") * F.col("_rest") / F.col("_w_rest"))
    return rows.select("source", "n", "source_size", target.alias("target"))


def uniform(key: Column) -> Column:
    """A number between 0 and 1 from the first 13 digits of a checksum."""
    return (F.conv(F.substring(key, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def document_key(seed: int, id_col: str, text_col: str) -> Column:
    """A checksum of the seed, the id and the text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("null")), F.md5(text)))


def pareto_odds(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds; null where nothing is left to chance."""
    return F.when(p > 0, (u / (1 - u)) * ((1 - p) / p))


def expected(weight: Column | None, most: int, target: Column, source_size: Column, weighted: Column) -> Column:
    """Expected copies of a document: its source's target over its size, or in proportion to a weight, at most `most`."""
    if weight is None:
        return F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    return F.when(weighted > 0, F.least(target * weight / weighted, F.lit(float(most)))).otherwise(F.lit(0.0))


def weight_of(weight_col: str | None) -> Column:
    return F.lit(1.0) if weight_col is None else F.greatest(F.coalesce(F.nanvl(F.col(weight_col).cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(0.0))


def filling(fills: Column, size: Column, order: list[Column]) -> Column:
    """Whether one of the passes (limit, stop) takes a document: not above its limit and before its stop in the order."""
    before = lambda f: f["stop"].isNull() | (F.struct(*order) < F.struct(*[f["stop"][c] for c in ("_odds", "_key", "_row")[: len(order)]]))
    limit = F.array_max(F.transform(F.filter(fills, before), lambda f: f["limit"]))
    return F.coalesce(size <= limit, F.lit(False))


def passes(rows: DataFrame) -> DataFrame:
    """Rows (_s, _fills), one for each source: the passes that fill what the first documents leave missing.

    A pass takes documents in order up to the words missing, of those of at most half of
    them where there are any, so it halves what is missing or takes all of these; else the
    first that fits. There are no more passes than the words missing have binary digits,
    and they end when nothing fits. Empty documents bring no words and stay out. Only
    sums of buckets and, for each source, the bucket in which a pass stops are ordered.
    """
    order = ["_odds", "_key", "_row"]
    rest = rows.where(~F.col("_first") & F.col("_odds").isNotNull() & (F.col("size") > 0)).select("source", "size", "_bucket", *order)
    missing = F.col("_wanted") - F.sum(F.when(F.col("_first"), F.col("size")).otherwise(0))
    fills = F.array().cast("array<struct<limit:double,stop:struct<_odds:double,_key:string,_row:bigint>>>")
    facts = written_once(rows.groupBy("source", "_wanted").agg(missing.cast("double").alias("_missing")).select(F.col("source").alias("_s"), "_missing", fills.alias("_fills"), F.lit(True).alias("_open")))
    while not (now := facts.where("_open AND _missing >= 1")).isEmpty():
        fit = rest.join(now, rest["source"].eqNullSafe(now["_s"])).where(F.col("size") <= F.col("_missing")).where(~filling(F.col("_fills"), F.col("size"), [F.col(c) for c in order]))
        fit = fit.select("source", "size", "_bucket", *order, "_missing")
        small = F.col("size") <= F.col("_missing") / 2
        sums = fit.groupBy("source", "_bucket", "_missing").agg(F.sum("size").alias("_all"), F.sum(F.when(small, F.col("size")).otherwise(0)).alias("_small"))
        every = Window.partitionBy("source")
        earlier = every.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("_any", F.sum("_small").over(every) > 0).withColumn("_held", F.when(F.col("_any"), F.col("_small")).otherwise(F.col("_all")))
        sums = sums.withColumn("_start", F.coalesce(F.sum("_held").over(earlier), F.lit(0)))
        sums = written_once(sums.select(F.col("source").alias("_s"), F.col("_bucket").alias("_b"), "_missing", F.when(F.col("_any"), F.col("_missing") / 2).otherwise(F.col("_missing")).alias("_limit"), "_start", "_held"))
        stops = sums.where((F.col("_start") <= F.col("_missing")) & (F.col("_start") + F.col("_held") > F.col("_missing"))).drop("_missing")
        inside = fit.join(stops, fit["source"].eqNullSafe(stops["_s"]) & (fit["_bucket"] == stops["_b"])).where("size <= _limit")
        inside = inside.withColumn("_sum", F.col("_start") + F.sum("size").over(every.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
        over = F.col("_sum") > F.col("_missing")
        stopped = inside.groupBy("source").agg(F.min(F.when(over, F.struct(*order))).alias("_stop"), F.max("_start").alias("_before"), F.sum(F.when(~over, F.col("size")).otherwise(0)).alias("_in")).withColumnRenamed("source", "_t")
        found = sums.groupBy("_s").agg(F.first("_limit").alias("_limit"), F.sum("_held").alias("_total")).withColumnRenamed("_s", "_f")
        found = found.join(stopped, found["_f"].eqNullSafe(stopped["_t"]), "left")
        found = found.select("_f", F.coalesce(F.col("_before") + F.col("_in"), F.col("_total")).alias("_got"), F.struct(F.col("_limit").alias("limit"), F.col("_stop").alias("stop")).alias("_fill"))
        facts = facts.join(found, facts["_s"].eqNullSafe(found["_f"]), "left")
        went = F.col("_got").isNotNull()
        facts = written_once(facts.select("_s", (F.col("_missing") - F.coalesce("_got", F.lit(0))).alias("_missing"), F.when(went, F.concat("_fills", F.array("_fill"))).otherwise(F.col("_fills")).alias("_fills"), went.alias("_open")))
    return facts.select("_s", "_fills")


def draw(docs: DataFrame, weights: tuple[int, ...], most: int, seed: int, id_col: str, text_col: str, source_col: str, weight_col: str | None, fill: bool) -> tuple[DataFrame, DataFrame | None]:
    """Rows (doc_id, source, size, source_size, target, _weighted, _key, _odds, _whole, _first, _fill, _last), one for each row of docs, and the passes that fill."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.regexp_count(text, F.lit(common.WORD)).cast("long").alias("size"), document_key(seed, id_col, text_col).alias("_key"), weight_of(weight_col).alias("_weight"))
    rows = written_once(rows.withColumn("_row", F.monotonically_increasing_id()))
    sizes = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"), F.sum(F.col("_weight") * F.col("size")).alias("_weighted"))
    sizes = written_once(sizes)
    targets = source_targets(sizes.drop("_weighted"), weights, most)
    targets = written_once(targets.join(sizes.select(F.col("source").alias("_s"), "_weighted"), targets["source"].eqNullSafe(F.col("_s"))).drop("_s"))

    u, p = uniform(F.col("_key")), F.col("_rate") - F.floor("_rate")
    facts = targets.select(F.col("source").alias("_source"), "n", "source_size", "target", "_weighted")
    rows = rows.join(facts, rows["source"].eqNullSafe(facts["_source"])).drop("_source")
    rows = rows.withColumn("_rate", expected(None if weight_col is None else F.col("_weight"), most, F.col("target"), F.col("source_size"), F.col("_weighted")))
    rows = rows.withColumn("_p", p).withColumn("_u", u).withColumn("_odds", pareto_odds(F.col("_u"), F.col("_p")))
    if weight_col is None:
        wanted, level = F.col("target") - F.floor("_rate") * F.col("source_size"), F.col("_p")
    else:
        # whole copies and the middle of the inclusion probabilities differ between documents
        whole = rows.groupBy("source").agg(F.sum(F.floor("_rate") * F.col("size")).alias("_sure"), F.avg(F.when(F.col("_p") > 0, F.col("_p"))).alias("_level")).withColumnRenamed("source", "_source")
        whole = written_once(whole)
        rows = rows.join(whole, rows["source"].eqNullSafe(whole["_source"])).drop("_source")
        wanted, level = F.col("target") - F.col("_sure"), F.col("_level")

    # buckets in order of the odds; the source's own inclusion odds spread them evenly;
    # documents without chance are only dealt out
    even = F.col("_odds") * (level / (1 - level))
    parts = 1 + F.floor(F.col("n") / BUCKET_ROWS)
    rows = rows.withColumn("_bucket", F.when(F.col("_odds").isNotNull(), F.least(F.floor(even / (1 + even) * parts), parts - 1)).otherwise(-1 - F.pmod("_row", parts)))
    by = ["source", "_bucket"]
    running = Window.partitionBy(*by).orderBy("_odds", "_key", "_row").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_in_bucket", F.sum("size").over(running))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.where("_bucket >= 0").groupBy(*by).agg(F.sum("size").alias("_held")).select(F.col("source").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_start"))
    rows = rows.join(starts, rows["source"].eqNullSafe(starts["_s"]) & (rows["_bucket"] == starts["_b"]), "left")
    first = F.coalesce(F.col("_start") + F.col("_in_bucket") <= wanted, F.lit(False))
    rows = written_once(rows.select("doc_id", "source", "size", "source_size", "target", "_weighted", "_key", "_row", "_odds", "_bucket", F.floor("_rate").alias("_whole"), wanted.alias("_wanted"), first.alias("_first")))

    fills = passes(rows) if fill else None
    if fill:
        more = ~F.col("_first") & F.col("_odds").isNotNull() & (F.col("size") > 0) & filling(F.col("_fills"), F.col("size"), [F.col(c) for c in ("_odds", "_key", "_row")])
        rows = written_once(rows.join(fills, rows["source"].eqNullSafe(fills["_s"])).withColumn("_fill", more).drop("_s", "_fills"))
    else:
        rows = rows.withColumn("_fill", F.lit(False))

    # the last place of each source
    in_order = F.col("_first") | F.col("_fill")
    missing = rows.groupBy("source", "_wanted").agg(F.sum(F.when(in_order, F.col("size")).otherwise(0)).alias("_got")).select(F.col("source").alias("_s"), (F.col("_wanted") - F.col("_got")).alias("_missing"))
    left = rows.where(~in_order & F.col("_odds").isNotNull())
    left = left.join(missing, left["source"].eqNullSafe(missing["_s"])).withColumn("_off", F.abs(F.col("_missing") - F.col("size"))).where(F.col("_off") < F.col("_missing"))
    last = left.groupBy("source").agg(F.min(F.struct("_off", "_odds", "_key", "_row")).alias("_best")).select(F.col("_best._row").alias("_row"), F.lit(1).alias("_last"))
    return rows.join(last, "_row", "left").withColumn("_last", F.col("_last").isNotNull()), fills


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight_col: str | None = None, fill: bool = True) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, copies, taken), one for each row of docs.

    size: words of the text, 0 for a null or empty one; taken: copies times size.
    The random number of a document depends on the seed, its id and text, so reruns
    agree; rows that repeat have equal numbers and are taken one by one. Null ids and
    a null source are values like others. Other columns are left out.

    With weight_col, expected copies follow that column inside a source, so inclusion
    probabilities differ between its documents; null and negative weights count as 0.
    What a document would take beyond `most` copies is then missing from the target.

    With fill, documents longer than the words missing are passed over until none fits;
    without it, the first that is too long ends the taking, which is the rule of mix_sql.
    """
    rows, _ = draw(docs, weights, most, seed, id_col, text_col, source_col, weight_col, fill)
    copies = F.col("_whole") + F.when(F.col("_first") | F.col("_fill") | F.col("_last"), 1).otherwise(0)
    return rows.withColumn("copies", copies.cast("long")).select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight_col: str | None = None, fill: bool = True) -> DataFrame:
    """The rows of docs, all columns, each as often as the mix takes it.

    A source's extra documents are those up to a place in its order, those that a pass
    takes by its size and place, and one more, so one row for each source decides for
    every document; texts are not moved. Rows that repeat an id and a text are decided
    together.
    """
    rows, fills = draw(docs, weights, most, seed, id_col, text_col, source_col, weight_col, fill)
    last = F.when(F.col("_last"), F.col("_key"))
    facts = written_once(rows.groupBy("source").agg(F.first("target").alias("_target"), F.first("source_size").alias("_size"), F.first("_weighted").alias("_weighted"), F.max(F.when(F.col("_first"), F.struct("_odds", "_key"))).alias("_upto"), F.max(last).alias("_one")))
    facts = facts.withColumnRenamed("source", "_source")
    held = common.whole_rows(docs).withColumn("_mix_key", document_key(seed, f"doc.`{id_col}`", f"doc.`{text_col}`"))
    if fill:
        facts = facts.join(fills, facts["_source"].eqNullSafe(fills["_s"])).drop("_s")
        held = held.withColumn("_words", F.regexp_count(F.coalesce(F.col(f"doc.`{text_col}`").cast("string"), F.lit("")), F.lit(common.WORD)).cast("long"))
    held = held.join(facts, F.col(f"doc.`{source_col}`").cast("string").eqNullSafe(facts["_source"]))
    held = held.withColumn("_rate", expected(None if weight_col is None else weight_of(f"doc.`{weight_col}`"), most, F.col("_target"), F.col("_size"), F.col("_weighted")))
    odds = pareto_odds(uniform(F.col("_mix_key")), F.col("_rate") - F.floor("_rate"))
    extra = F.coalesce(F.struct(odds.alias("_odds"), F.col("_mix_key").alias("_key")) <= F.col("_upto"), F.lit(False)) & odds.isNotNull()
    if fill:
        extra = extra | (odds.isNotNull() & (F.col("_words") > 0) & filling(F.col("_fills"), F.col("_words"), [odds.alias("_odds"), F.col("_mix_key").alias("_key")]))
    extra = extra | F.coalesce(F.col("_mix_key") == F.col("_one"), F.lit(False))
    copies = F.floor("_rate").cast("int") + F.when(extra, 1).otherwise(0)
    return held.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies))).select("doc.*")


def mix_sql(seed: int = 0) -> str:
    """The same for the table documents with weights 1, 2, 3 and at most 3 copies, for DuckDB."""
    return f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS w FROM s),
t AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS weights,
    coalesce(sum(3 * source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sb,
    coalesce(sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wb FROM w),
f AS (SELECT *, 3 * source_size * (weights - wb) <= w * (total - sb) AS full_ FROM t),
g AS (SELECT source, source_size, CASE WHEN full_ THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(w * (total - sum(CASE WHEN full_ THEN 3 * source_size ELSE 0 END) OVER ()) AS DOUBLE)
    / CAST(weights - sum(CASE WHEN full_ THEN w ELSE 0 END) OVER () AS DOUBLE) END AS target FROM f),
r AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate, (CAST(('0x' || substr(k, 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0 AS u
    FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
o AS (SELECT *, target - floor(rate) * source_size AS wanted, CASE WHEN rate - floor(rate) > 0 THEN (u / (1 - u)) * ((1 - (rate - floor(rate))) / (rate - floor(rate))) END AS odds FROM r),
c AS (SELECT *, odds IS NOT NULL AND sum(size) OVER (PARTITION BY source, odds IS NULL ORDER BY odds, k ROWS UNBOUNDED PRECEDING) <= wanted AS first_ FROM o),
m AS (SELECT *, wanted - sum(CASE WHEN first_ THEN size ELSE 0 END) OVER (PARTITION BY source) AS missing FROM c),
l AS (SELECT *, CASE WHEN NOT first_ AND odds IS NOT NULL AND abs(missing - size) < missing
    THEN row_number() OVER (PARTITION BY source, NOT first_ AND odds IS NOT NULL AND abs(missing - size) < missing ORDER BY abs(missing - size), odds, k) END AS place FROM m)
SELECT doc_id, source, size, source_size, target, CAST(floor(rate) + CASE WHEN first_ OR place = 1 THEN 1 ELSE 0 END AS BIGINT) AS copies,
    CAST((floor(rate) + CASE WHEN first_ OR place = 1 THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM l"""

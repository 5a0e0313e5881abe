"""Line dedup: repeated runs of lines across documents lose their later copies.

Lines are numbered over all documents in order of the document id. Prefix doubling
sorts the suffixes of this sequence: the rank of a position at level j orders the
suffixes by their first 2**j lines, and comes from the pair of ranks of its two
halves at the level below. A position whose run is not repeated has no rank and takes
no further part, so the levels shrink.

A run counts from `min_words` words. Its lines are covered by windows that just reach
min_words, from their first line on or from their last line back, so the runs are
deleted exactly if such windows are. Windows of m lines that agree are a
longest-common-prefix interval of depth m: equal ranks at the level below m, at the
window's start and where that many lines end with it. The first window of an interval
stays, all its lines included; of the others go the lines behind it, so a run that
overlaps its own copy keeps as much as one window. Ranks are doubled up to the depth
of the longest window and no further.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.lineage import written_once
from . import common, tokens

#: Documents in a block when positions are numbered.
BLOCK_ROWS = 2048
#: Documents with deletions that are broadcast to the scan of the texts; more are joined by a shuffle.
BROADCAST_DOCUMENTS = 1_000_000


def windows(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths, distinct, of the windows that just reach `least` words from a first line on or a last line back."""
    ends = np.cumsum(words)
    n = len(words)
    before = ends - words
    # the first line at which the words from s on reach the least
    stop = np.searchsorted(ends, before + least)
    first = np.flatnonzero(stop < n)
    pairs = [np.stack([first, stop[first] - first + 1], axis=1)]
    # the last line from which the words up to e reach it
    start = np.searchsorted(before, ends - least, side="right") - 1
    last = np.flatnonzero(ends >= least)
    pairs.append(np.stack([start[last], last - start[last] + 1], axis=1))
    found = np.unique(np.concatenate(pairs), axis=0)
    return found[:, 0], found[:, 1]


def document_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (doc_id, tie, n_lines, hashes, sizes, words, at), one for each distinct document; at: the number of its first line."""
    from xxhash import xxh64_intdigest

    common.ship(docs.sparkSession)

    def cut(batches):
        import pyarrow as pa

        tokens.forget()
        for batch in batches:
            for a, b in common.slices(batch.column("text")):
                part = batch.slice(a, b - a)
                out = []
                for text in part.column("text").cast(pa.binary()).to_pylist():
                    lines = text.split(b"\n") if text else []
                    h = np.fromiter(map(xxh64_intdigest, lines), np.uint64, len(lines))
                    out.append((len(lines), h.tobytes(), np.fromiter(map(len, lines), np.int32, len(lines)).tobytes(), np.fromiter((len(x.split()) for x in lines), np.int32, len(lines)).tobytes()))
                kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.record_batch([part.column("doc_id"), part.column("tie"), *[pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)]], names=["doc_id", "tie", "n_lines", "hashes", "sizes", "words"])

    rows = common.texts(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("tie"), "text")
    rows = rows.mapInArrow(cut, "doc_id long, tie long, n_lines long, hashes binary, sizes binary, words binary")
    rows = written_once(rows.where("n_lines > 0").dropDuplicates(["doc_id", "tie"]))
    ids = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).first()
    low = ids["low"] or 0
    width = max(1, ((ids["high"] or 0) - low + 1) * BLOCK_ROWS // max(1, ids["n"]))
    wide = "decimal(20,0)"
    # rows without an id come last, in a block of their own
    rows = rows.withColumn("_block", F.coalesce(F.floor((F.col("doc_id").cast(wide) - F.lit(low).cast(wide)) / width).cast("long"), F.lit((1 << 63) - 1)))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("_block").agg(F.sum("n_lines").alias("_n")).select("_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inner = Window.partitionBy("_block").orderBy("doc_id", "tie").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_upto", F.sum("n_lines").over(inner)).join(blocks, "_block")
    return rows.select("doc_id", "tie", "n_lines", "hashes", "sizes", "words", (F.col("_before") + F.col("_upto") - F.col("n_lines")).alias("at"))


def ordered_numbers(keys: DataFrame, by: list[str], name: str) -> DataFrame:
    """The distinct keys with a number that ascends with them; written, as the number depends on the tasks."""
    return written_once(keys.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(name, F.monotonically_increasing_id()))


def line_ranks(lines: DataFrame) -> DataFrame:
    """Level 0: rows (doc, at, rank) with rank the order of a line's (hash, size) among the lines that repeat."""
    repeated = lines.groupBy("hash", "size").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    numbers = ordered_numbers(repeated, ["hash", "size"], "rank")
    return written_once(lines.join(numbers, ["hash", "size"]).drop("hash", "size"))


def next_ranks(ranks: DataFrame, level: int) -> DataFrame:
    """Rows (doc, at, rank) of level + 1 from those of a level: positions whose first 2 ** (level + 1) lines repeat."""
    k = 1 << level
    second = ranks.select("doc", (F.col("at") - k).alias("at"), F.col("rank").alias("second"))
    pairs = ranks.select("doc", "at", F.col("rank").alias("first")).join(second, ["doc", "at"])
    pairs = written_once(pairs)
    repeated = pairs.groupBy("first", "second").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    numbers = ordered_numbers(repeated, ["first", "second"], "rank")
    return written_once(pairs.join(numbers, ["first", "second"]).select("doc", "at", "rank"))


def later_windows(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The documents' lines, and rows (doc, at, length): of all windows that have an earlier copy, the lines behind the first copy."""
    held = written_once(document_lines(docs, id_col, text_col))

    def each(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                h = [np.frombuffer(x, np.int64) for x in part.column("hashes").to_pylist()]
                sizes = [np.frombuffer(x, np.int32) for x in part.column("sizes").to_pylist()]
                n, docs_ = np.array([len(x) for x in h]), part.column("at").to_numpy()
                at, ends, lengths, base = [], [], [], 0
                for x, first in zip(part.column("words").to_pylist(), docs_):
                    words = np.frombuffer(x, np.int32).astype(np.int64)
                    start, length = windows(words, min_words)
                    ends.append(base + np.searchsorted(start, np.arange(1, len(words) + 1)))
                    lengths.append(length)
                    at.append(first + np.arange(len(words)))
                    base += len(start)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], *ends]).astype(np.int32)), pa.array(np.concatenate(lengths).astype(np.int64)))
                yield pa.record_batch([pa.array(np.repeat(docs_, n)), pa.array(np.concatenate(at)), pa.array(np.concatenate(h)), pa.array(np.concatenate(sizes)), lists], names=["doc", "at", "hash", "size", "lengths"])

    lines = held.select("hashes", "sizes", "words", "at").mapInArrow(each, "doc long, at long, hash long, size int, lengths array<long>")
    ranks = line_ranks(lines)
    wanted = written_once(ranks.select("doc", "at", F.explode("lengths").alias("length")))
    longest = wanted.agg(F.max("length")).first()[0] or 0
    level, found, ranks = 0, [], ranks.select("doc", "at", "rank")
    while longest >= 1 << level:
        k = 1 << level
        here = wanted.where((F.col("length") >= k) & (F.col("length") < 2 * k))
        a, b = ranks.select("doc", "at", F.col("rank").alias("a")), ranks.select("doc", F.col("at").alias("_last"), F.col("rank").alias("b"))
        keyed = here.join(a, ["doc", "at"]).withColumn("_last", F.col("at") + F.col("length") - k).join(b, ["doc", "_last"])
        keyed = written_once(keyed.select("doc", "at", "length", "a", "b"))
        firsts = written_once(keyed.groupBy("length", "a", "b").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
        found.append(keyed.join(firsts, ["length", "a", "b"]).where(F.col("at") > F.col("first")).select("doc", F.greatest("at", F.col("first") + F.col("length")).alias("begin"), (F.col("at") + F.col("length")).alias("stop")))
        if ranks.isEmpty():
            break
        if longest >= 2 * k:
            ranks = next_ranks(ranks, level)
        level += 1
    out = found[0] if found else wanted.select("doc", F.col("at").alias("begin"), F.col("at").alias("stop"))
    for more in found[1:]:
        out = out.unionByName(more)
    return held, out.select("doc", F.col("begin").alias("at"), (F.col("stop") - F.col("begin")).alias("length"))


def deletions(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, tie, lines): numbers, from 0, of the lines to delete in each document that has any; tie is a hash of its text."""
    held, later = later_windows(docs, min_words, id_col, text_col)
    gone = later.withColumn("line", F.explode(F.sequence(F.col("at") - F.col("doc"), F.col("at") - F.col("doc") + F.col("length") - 1)))
    gone = gone.groupBy("doc").agg(F.sort_array(F.collect_set("line")).alias("lines"))
    return gone.join(held.select("doc_id", "tie", F.col("at").alias("doc")), "doc").select("doc_id", "tie", "lines")


def drop_repeated_lines(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the lines deleted that belong to a later copy of a repeated run of at least min_words words.

    Added columns: _n_lines, and _deleted (numbers of the deleted lines, from 0); columns
    of these two names are replaced.
    Order is by id, then by a hash of the text; rows without an id come last. The
    first copy of a run stays, also where a later one overlaps it. Rows that repeat both id and text are
    one document and get one result. Null and empty texts have no lines and stay as
    they are; a text all of whose lines go becomes empty. A line is compared as a
    whole, whatever its length.
    """
    gone = written_once(deletions(docs, min_words, id_col, text_col))
    small = gone.count() <= BROADCAST_DOCUMENTS
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), F.col("lines").alias("_deleted"))
    key = common.whole_rows(docs.drop("_n_lines", "_deleted")).withColumn("_key", F.col(f"doc.`{id_col}`").cast("long")).withColumn("_text", F.col(f"doc.`{text_col}`").cast("string"))
    key = key.withColumn("_hash", F.xxhash64(F.coalesce("_text", F.lit(""))))
    rows = key.join(F.broadcast(gone) if small else gone, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_tie")), "left")
    lines = F.split("_text", "\n", -1)
    kept = F.filter(F.transform(lines, lambda x, i: F.when(~F.array_contains(F.col("_deleted"), i.cast("long")), x)), lambda x: x.isNotNull())
    count = F.when(F.coalesce(F.length("_text"), F.lit(0)) == 0, 0).otherwise(F.length("_text") - F.length(F.replace("_text", F.lit("\n"), F.lit(""))) + 1)
    text = F.when(F.col("_deleted").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col(f"doc.`{text_col}`"))
    rows = rows.select(F.col("doc").withField(f"`{text_col}`", text).alias("doc"), count.cast("long").alias("_n_lines"), F.coalesce("_deleted", F.array().cast("array<long>")).alias("_deleted"))
    return rows.select("doc.*", "_n_lines", "_deleted")


def line_report(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_lines, n_deleted, deleted, kept_sha256), one for each row: counts, the deleted lines' numbers, a hash of the text left."""
    rows = drop_repeated_lines(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), min_words)
    return rows.select("doc_id", F.col("_n_lines").alias("n_lines"), F.size("_deleted").cast("long").alias("n_deleted"), F.array_join(F.transform("_deleted", lambda x: x.cast("string")), ",").alias("deleted"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def line_report_sql(min_words: int = 50) -> str:
    """line_report for the table documents with distinct ids, for DuckDB: the windows' texts are compared as they are."""
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS ls FROM documents),
l AS (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d),
w AS (SELECT doc_id, i, len(regexp_extract_all(ls[i], '[^\x20\x09-\x0D]+')) AS n FROM l),
c AS (SELECT doc_id, i, n, CAST(sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS upto FROM w),
v AS (SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.n >= {min_words} GROUP BY ALL
    UNION SELECT b.doc_id, max(a.i), b.i FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.n >= {min_words} GROUP BY b.doc_id, b.i),
k AS (SELECT v.doc_id, s, e, list_slice(ls, s, e) AS run FROM v JOIN d ON v.doc_id = d.doc_id),
f AS (SELECT *, row_number() OVER o AS copy, CASE WHEN first_value(doc_id) OVER o = doc_id THEN first_value(e) OVER o ELSE 0 END AS spared FROM k WINDOW o AS (PARTITION BY run ORDER BY doc_id, s)),
g AS (SELECT doc_id, list_sort(list_distinct(flatten(list(range(greatest(s - 1, spared), e))))) AS gone FROM f WHERE copy > 1 GROUP BY doc_id),
r AS (SELECT d.doc_id, ls, text, coalesce(gone, []) AS gone FROM d LEFT JOIN g ON d.doc_id = g.doc_id)
SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(gone) AS BIGINT) AS n_deleted, coalesce(array_to_string(gone, ','), '') AS deleted,
    sha256(CASE WHEN len(gone) = 0 THEN text ELSE coalesce(array_to_string(list_filter(ls, lambda x, i: NOT list_contains(gone, i - 1)), chr(10)), '') END) AS kept_sha256 FROM r"""

"""Benchmark decontamination: Wu-Manber search for the word windows of benchmark items.

Texts and items become lists of words (A-Z in lower case; an ASCII character that is no
letter or digit ends a word), written with one space around every word. A window is a
run of consecutive words of an item, so it is a plain string to find.

Windows of one number of words form a group with tables of its own. m is the length in
bytes of its shortest window. A shift table says, for the hash of a block of bytes, how
far the search may move on when that block ends the m bytes under it: as far as no
window has the block further left. Where it may not move, the hash of the block, which
then is the suffix of some window's first m bytes, selects a bucket; the first bytes are
checked, and the text up to the end of the window's last word is compared with the
bucket's strings. Lanes of a buffer of many texts move at the same time, as arrays.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.lineage import written_once
from . import common, tokens
from .linededup import ordered_numbers

#: Bytes of windows (with 64 for each) that one pass over the documents looks for; more windows take more passes.
PART_BYTES = 16 << 20
#: Bytes of a buffer that one lane of the search covers.
LANE = 1024

_K = np.uint64(0x9E3779B97F4A7C15)
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


class Group:
    """Shift table and buckets for windows of one number of words, each with a space before and behind."""

    def __init__(self, words: int, strings: list[bytes], numbers: list[int]):
        self.words, self.m = words, min(map(len, strings))
        self.block = min(8, self.m)
        self.mask = np.uint64((1 << 8 * self.block) - 1)
        moves = self.m - self.block + 1
        self.drop = np.uint64(64 - min(22, max(10, (4 * moves * len(strings)).bit_length())))
        self.shift = np.full(1 << int(64 - self.drop), moves, np.int32)
        heads = np.zeros((len(strings), self.m + 8), np.uint8)
        heads[:, : self.m] = np.frombuffer(b"".join(s[: self.m] for s in strings), np.uint8).reshape(len(strings), self.m)
        at = lambda j: self.hashed(np.ascontiguousarray(heads[:, j : j + 8]).view("<u8")[:, 0])
        for j in range(moves):
            np.minimum.at(self.shift, at(j), moves - 1 - j)
        self.first = np.zeros(len(self.shift), bool)
        self.first[at(0)] = True
        self.buckets: dict[int, dict[bytes, int]] = {}
        for h, s, n in zip(at(moves - 1).tolist(), strings, numbers):
            self.buckets.setdefault(h, {})[s] = n

    def hashed(self, block: np.ndarray) -> np.ndarray:
        return ((block & self.mask) * _K >> self.drop).astype(np.int64)

    def candidates(self, text: np.ndarray, eights: np.ndarray) -> np.ndarray:
        """Positions, ascending, of the spaces of a buffer at which a window may begin; eights: the 8 bytes from each byte on."""
        last = len(text) - self.m
        at = np.arange(0, last + 1, LANE)
        stop = np.minimum(at + LANE, last + 1)
        tail, found = self.m - self.block, []
        while len(at):
            move = self.shift[self.hashed(eights[at + tail])]
            here = move == 0
            if here.any():
                found.append(at[here])
                move = move + here
            at = at + move
            on = at < stop
            if not on.all():
                at, stop = at[on], stop[on]
        if not found:
            return np.zeros(0, np.int64)
        at = np.concatenate(found)
        at = at[text[at] == 32]
        return np.sort(at[self.first[self.hashed(eights[at])]])


class Search:
    """Groups for a list of (words, window, number)."""

    def __init__(self, windows: list[tuple[int, str, int]]):
        by: dict[int, tuple[list, list]] = {}
        for words, window, number in windows:
            strings, numbers = by.setdefault(words, ([], []))
            strings.append(b" " + window.encode() + b" ")
            numbers.append(number)
        self.groups = [Group(k, *v) for k, v in sorted(by.items())]

    def __call__(self, texts: list[bytes]) -> list[tuple[int, set[int], set[int]]]:
        """For each text the number of its words, the places of those hit and the numbers of the windows found."""
        found = [x.translate(_LETTERS).split() for x in texts]
        out = [(len(x), set(), set()) for x in found]
        # no window holds two spaces in a row, so none crosses from one text to the next
        spaced = [b" " + b" ".join(x) + b" " if x else b"" for x in found]
        del found
        starts = np.cumsum([0, *map(len, spaced)])
        buffer = b"".join(spaced)
        del spaced
        padded = np.frombuffer(buffer + bytes(8), np.uint8)
        text, eights = padded[:-8], np.ndarray((max(0, len(padded) - 7),), "<u8", padded, strides=(1,))
        spaces = first = None
        for group in self.groups:
            at = group.candidates(text, eights)
            if not len(at):
                continue
            if spaces is None:
                spaces = np.flatnonzero(text == 32)
                first = np.searchsorted(spaces, starts)
            k = np.searchsorted(spaces, at)
            at, k = at[k + group.words < len(spaces)], k[k + group.words < len(spaces)]
            ends = spaces[k + group.words] + 1
            blocks = group.hashed(eights[at + group.m - group.block])
            docs = np.searchsorted(starts, at, side="right") - 1
            for s, e, h, d, i in zip(at.tolist(), ends.tolist(), blocks.tolist(), docs.tolist(), (k - first[docs]).tolist()):
                number = group.buckets[h].get(buffer[s:e])
                if number is not None:
                    out[d][1].update(range(i, i + group.words))
                    out[d][2].add(number)
        return out


def item_words(text: Column) -> Column:
    """The words of a text; none for null."""
    plain = F.trim(F.regexp_replace(common.ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", " "))
    return F.filter(F.split(plain, " ", -1), lambda x: x != "")


def item_windows(benchmark: DataFrame, words: int, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct rows (item string, words int, window string): runs of so many words, or the whole of a shorter item."""
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), item_words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    rows = rows.withColumn("words", F.least(F.size("w"), F.lit(words))).withColumn("s", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("words") + 1)))
    return rows.select("item", "words", F.array_join(F.slice("w", F.col("s"), F.col("words")), " ").alias("window")).distinct()


_searches: dict[str, Search] = {}


def _searched(rows: DataFrame, windows: list[tuple[int, str, int]]) -> DataFrame:
    """Rows (doc_id, key, n_words, hit, found) from rows (doc_id, key, text)."""
    shared, name = rows.sparkSession.sparkContext.broadcast(windows), uuid.uuid4().hex  # at most PART_BYTES, by the caller

    def search(batches):
        import pyarrow as pa

        tokens.forget()
        if name not in _searches:
            _searches.clear()
            _searches[name] = Search(shared.value)
        for batch in batches:
            for a, b in common.slices(batch.column("text")):
                part = batch.slice(a, b - a)
                got = _searches[name](part.column("text").cast(pa.binary()).to_pylist())
                arrays = [pa.array([x[0] for x in got], pa.int64()), pa.array([sorted(x[1]) for x in got], pa.list_(pa.int32())), pa.array([sorted(x[2]) for x in got], pa.list_(pa.int64()))]
                yield pa.record_batch([part.column("doc_id"), part.column("key"), *arrays], names=["doc_id", "key", "n_words", "hit", "found"])

    return rows.mapInArrow(search, "doc_id long, key string, n_words long, hit array<int>, found array<long>")


def contamination(docs: DataFrame, benchmark: DataFrame, words: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows (doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one for each row of docs.

    n_hit counts the words inside any occurrence of a window of `words` words of an item,
    n_items the items with such a window; items_sha256 is the hash of their ids, sorted as
    strings and joined by commas. A null or empty text has no words and no hits, an item
    without words no windows. A null item id is written as an empty string; items that repeat an id are
    one item; repeated documents each get their row, a null doc_id stays null. A very
    long text is one row of work, a long item many windows. Without items nothing is
    hit. Other columns, whatever their names, are left out.

    Windows go to the workers in parts of at most part_bytes, each searched in a pass of
    its own; the first pass carries all documents, the later ones only texts with hits.
    """
    spark = docs.sparkSession
    common.ship(spark)
    windows = written_once(item_windows(benchmark, words, item_col))
    numbers = ordered_numbers(windows.select("window", "words").distinct(), ["window", "words"], "number")
    total = numbers.agg(F.sum(F.octet_length("window") + 64)).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    texts = common.texts(docs, id_col, text_col).select("doc_id", (F.md5("text") if parts > 1 else F.lit(None).cast("string")).alias("key"), "text")
    some = lambda p: [(r["words"], r["window"], r["number"]) for r in numbers.where(F.pmod(F.xxhash64("window"), F.lit(parts)) == p).collect()]
    rows = _searched(texts, some(0))
    if parts > 1:
        later = [written_once(_searched(texts, some(p)).where(F.size("found") > 0).select("key", "hit", "found").dropDuplicates(["key"])) for p in range(1, parts)]
        later = reduce(DataFrame.unionByName, later).groupBy("key").agg(F.flatten(F.collect_list("hit")).alias("_hit"), F.flatten(F.collect_list("found")).alias("_found"))
        both = lambda c: F.concat(F.col(c), F.coalesce(F.col(f"_{c}"), F.array().cast(f"array<{'int' if c == 'hit' else 'long'}>")))
        rows = rows.join(later, "key", "left").select("doc_id", "n_words", F.array_distinct(both("hit")).alias("hit"), F.sort_array(both("found")).alias("found"))
    # documents with the same windows share their list of items
    rows = written_once(rows.select("doc_id", "n_words", F.size("hit").cast("long").alias("n_hit"), F.when(F.size("found") > 0, F.sha2(F.array_join(F.transform("found", lambda x: x.cast("string")), ","), 256)).alias("windows"), "found"))
    links = windows.join(numbers, ["window", "words"]).select("number", "item")
    sets = rows.where("windows IS NOT NULL").select("windows", "found").dropDuplicates(["windows"])
    items = sets.select("windows", F.explode("found").alias("number")).join(links, "number").groupBy("windows").agg(F.sort_array(F.collect_set("item")).alias("items"))
    items = items.select("windows", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    hit = rows.where("windows IS NOT NULL").join(items, "windows").select("doc_id", "n_words", "n_hit", "n_items", "items_sha256")
    clean = rows.where("windows IS NULL").select("doc_id", "n_words", "n_hit", F.lit(0).cast("long").alias("n_items"), F.sha2(F.lit(""), 256).alias("items_sha256"))
    return clean.unionByName(hit).withColumn("contaminated", F.col("n_hit") > 0)


def contamination_sql(words: int = 10) -> str:
    """contamination for the tables documents and benchmark, for DuckDB: every run of words is joined with the windows."""
    cut = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, {cut} AS ws FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {cut} AS ws FROM benchmark),
v AS (SELECT item, ws, least(len(ws), {words}) AS k, unnest(range(1, greatest(len(ws) - {words - 1}, 1) + 1)) AS s FROM b WHERE len(ws) > 0),
w AS (SELECT DISTINCT item, k, list_slice(ws, s, s + k - 1) AS win FROM v),
ks AS (SELECT DISTINCT k FROM w),
x AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d),
y AS (SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {words - 1} FOLLOWING) AS l FROM x),
p AS (SELECT doc_id, i, k, list_slice(l, 1, k) AS win FROM y, ks WHERE len(l) >= k),
h AS (SELECT p.doc_id, p.i, p.k, w.item FROM p JOIN w ON p.k = w.k AND p.win = w.win),
n AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN t ON d.doc_id = t.doc_id"""

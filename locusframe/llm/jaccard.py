"""N-gram Jaccard join: documents whose sets of word shingles are alike.

Texts of one word sequence are one class. A first pass keeps the classes that can
have a partner at all; among these, shingles are counted and ordered from the rarest,
and classes meet on the shingles of their prefixes. Pairs pass length and
positional filters and a suffix filter: what follows the matched shingle in both sets
is split at probe shingles of the global order, and the smaller of both counts of
every part bounds what can be shared there. The probes are the same for all sets, so a
class needs its counts up to each probe only, and no set travels before the
filter. The pairs left are verified once each, on the whole sets. In a group of near
copies a class is first verified against one leader of its shingles; only classes
that are not yet in one component meet pairwise after that, so a group of m copies
costs about m verifications and no link between components is lost.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.graph import connected_components
from ..operators.lineage import written_once
from . import common, shingles

#: Candidate ids that are broadcast to the scan of the texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Parts of the global order of shingles that the suffix filter compares.
PARTS = 16
#: Classes that one task compares with all others of a shingle, where pairs have to be formed.
SALT_ROWS = 4096
#: Text of one slice of the first pass, whose equal shingles are counted before the shuffle.
SLICE_BYTES = 8 << 20


def needed(n: Column, percent: int) -> Column:
    """Shingles that a partner must share with a set of n: at least percent of n, rounded up."""
    return F.floor((n * percent + 99) / 100)


def _surplus(n: int) -> int:
    return max(1, n // 5)


def classes(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, text_hash, class, class2, n_shingles), one for each row of docs; class and class2 are null without words."""
    common.ship(docs.sparkSession)

    def take(batches):
        import pyarrow as pa

        shingles.begin()
        for batch in batches:
            for a, b in common.slices(batch.column("text")):
                part = batch.slice(a, b - a)
                found = [shingles.words(t) for t in part.column("text").cast(pa.binary()).to_pylist()]
                keys = [shingles.sequence_class(f) if f else (None, None) for f in found]
                n = [len(shingles.shingle_set(f, words)) for f in found]
                yield pa.record_batch([part.column("doc_id"), part.column("text_hash"), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "text_hash", "class", "class2", "n_shingles"])

    return common.texts(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text")).mapInArrow(take, "doc_id long, text_hash long, class long, class2 long, n_shingles long")


def shared_counts(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (class, hits): an upper bound of the shingles that other classes share with the start of a class's set.

    Sets are ordered by hash. With overlap o >= a = needed(n), the i-th shared shingle
    stands within the first i + n - a of either set, so within the first n - a + s(n)
    linked sets share at least s(a) shingles, where s grows with n. Classes
    with fewer hits have no partner. Hashes are cut to 32 bits in a range, and hits of
    copies in several slices add up: both only add hits. A slice sends a shingle once,
    however many of its texts have it, so no range gets all copies of a shingle.
    """
    ranges = 1 << max(3, (common.input_partitions(docs) // 2).bit_length())
    schema = "part int, hashes binary, owners binary, classes binary, hit_classes binary, hits binary"

    def send(batches):
        import pyarrow as pa

        turn = 0
        shingles.begin()
        for batch in batches:
            for a, b in common.slices(batch.column("text"), SLICE_BYTES):
                ids, sets = [], []
                for text in batch.column("text").slice(a, b - a):
                    found = shingles.words(text.as_py().encode())
                    if not found:
                        continue
                    key = shingles.sequence_class(found)[0]
                    h = shingles.shingle_set(found, words)
                    ids.append(key)
                    sets.append(h[: len(h) - (len(h) * percent + 99) // 100 + _surplus(len(h))])
                if not sets:
                    continue
                ids, place = np.unique(np.array(ids, dtype=np.int64), return_index=True)  # copies in the slice count once
                sets = [sets[i] for i in place]
                h, owner = np.concatenate(sets), np.repeat(np.arange(len(ids), dtype=np.uint32), [len(s) for s in sets])
                order = np.argsort(h, kind="stable")
                h, owner = h[order], owner[order]
                start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                n = np.diff(np.append(start, len(h)))
                many = np.repeat(n > 1, n)
                hits = np.bincount(owner[many], minlength=len(ids))
                h, owner = h[start], np.where(n > 1, np.uint32(len(ids)), owner[start])
                part = (h & np.uint64(ranges - 1)).astype(np.int32)
                order = np.argsort(part, kind="stable")
                cut = np.searchsorted(part[order], np.arange(ranges + 1))
                turn = (turn + 1) % ranges
                rows = []
                for r in range(ranges):
                    at = order[cut[r] : cut[r + 1]]
                    if not len(at) and r != turn:
                        continue
                    used, local = np.unique(owner[at], return_inverse=True)
                    keys = np.where(used < len(ids), ids[np.minimum(used, len(ids) - 1)], 0)
                    local = np.where(owner[at] < len(ids), local, 65535 if len(used) < 65535 else len(used)).astype(np.uint16 if len(used) < 65535 else np.uint32)
                    mine = np.flatnonzero(hits) if r == turn else np.zeros(0, np.int64)
                    rows.append((r, (h[at] >> np.uint64(24)).astype(np.uint32).tobytes(), local.tobytes(), keys.astype(np.int64).tobytes(), ids[mine].tobytes(), hits[mine].astype(np.int64).tobytes()))
                kinds = (pa.int32(), *[pa.binary()] * 5)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["part", "hashes", "owners", "classes", "hit_classes", "hits"])

    def meet(pdf):
        import pandas as pd

        hs, ks, multi = [], [], []
        for hashes, owners, keys in zip(pdf["hashes"], pdf["owners"], pdf["classes"]):
            h, keys = np.frombuffer(hashes, np.uint32), np.frombuffer(keys, np.int64)
            if not len(h):
                continue
            kind = np.uint16 if len(owners) == 2 * len(h) else np.uint32
            o = np.frombuffer(owners, kind).astype(np.int64)
            # the mark of shingles that several classes of the slice have
            shared = o >= (65535 if kind is np.uint16 else len(keys))
            hs.append(h)
            ks.append(np.where(shared, 0, keys[np.minimum(o, len(keys) - 1)]))
            multi.append(shared)
        out_class = [np.frombuffer(x, np.int64) for x in pdf["hit_classes"]]
        out_hits = [np.frombuffer(x, np.int64) for x in pdf["hits"]]
        if hs:
            h, k, multi = np.concatenate(hs), np.concatenate(ks), np.concatenate(multi)
            order = np.lexsort((k, multi, h))
            h, k, multi = h[order], k[order], multi[order]
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (k[1:] != k[:-1]) | (multi[1:] != multi[:-1])])
            h, k, multi = h[new], k[new], multi[new]
            start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            size = np.add.reduceat(1 + multi.astype(np.int64), start)
            full = np.repeat(size > 1, np.diff(np.append(start, len(h)))) & ~multi
            key, n = np.unique(k[full], return_counts=True)
            out_class.append(key)
            out_hits.append(n)
        return pd.DataFrame({"class": np.concatenate(out_class), "hits": np.concatenate(out_hits)})

    sent = common.texts(docs, id_col, text_col).select("text").mapInArrow(send, schema)
    return sent.groupBy("part").applyInPandas(meet, "class long, hits long").groupBy("class").agg(F.sum("hits").alias("hits"))


def class_sets(docs: DataFrame, wanted: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (class, n, hashes) of the classes in wanted (doc_id, class), whose text is looked up by id; a text that repeats with its id repeats."""
    n = wanted.count()
    small = wanted.select("doc_id", "class")
    rows = common.texts(docs, id_col, text_col).join(F.broadcast(small) if n <= BROADCAST_IDS else small, "doc_id").select("class", "text")

    def take(batches):
        import pyarrow as pa

        for batch in batches:
            for a, b in common.slices(batch.column("text")):
                out = []
                for key, text in zip(batch.column("class").slice(a, b - a).to_pylist(), batch.column("text").slice(a, b - a).to_pylist()):
                    found = shingles.words(text.encode())
                    if found and shingles.sequence_class(found)[0] == key:  # an id may have rows of other texts
                        h = shingles.shingle_set(found, words)
                        out.append((key, len(h), h.tobytes()))
                kinds = (pa.int64(), pa.int64(), pa.binary())
                yield pa.record_batch([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names=["class", "n", "hashes"])

    return rows.mapInArrow(take, "class long, n long, hashes binary")


def probes(counts: DataFrame) -> list[tuple[int, int]]:
    """PARTS - 1 probes (df, gram) of the global order that leave about equal numbers of shingles of all sets between them.

    Counts decide, and probes that fall on one count are spread over its hashes. Any probes give valid bounds.
    """
    shares = [i / PARTS for i in range(1, PARTS)]
    found = counts.agg(F.percentile("df", shares, F.col("df")).alias("p")).first()["p"]
    if found is None:
        return []
    whole = [int(x) for x in found]
    out = []
    for df in sorted(set(whole)):
        many = whole.count(df)
        out += [(df, -(1 << 63) + ((1 << 64) * (i + 1)) // (many + 1)) for i in range(many)]
    return out


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Rows (class, n, lonely, held, upto), one for each class whose prefix has a shingle of another class.

    held: the prefix behind its lonely shingles, rarest first, with the part of the order each lies in; upto:
    how many shingles of the whole set, lonely ones aside, lie in each part or before it.
    """

    def each(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                h = [np.frombuffer(x, np.int64) for x in part.column("hashes").to_pylist()]
                n = [len(x) for x in h]
                yield pa.record_batch([pa.array(np.concatenate(h)), pa.array(np.repeat(part.column("class").to_numpy(), n)), pa.array(np.repeat(part.column("n").to_numpy(), n))], names=["gram", "class", "n"])

    tokens = sets.select("class", "n", "hashes").mapInArrow(each, "gram long, class long, n long")
    counts = written_once(tokens.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1"))
    part = F.lit(0)
    for df, gram in probes(counts):
        part = part + ((F.col("df") > df) | ((F.col("df") == df) & (F.col("gram") >= gram))).cast("int")
    seen = tokens.join(counts.withColumn("part", part), "gram")
    upto = F.array(*[F.sum((F.col("part") <= i).cast("int")) for i in range(PARTS)])
    held = seen.groupBy("class", "n").agg(F.sort_array(F.collect_list(F.struct("df", "gram", "part"))).alias("held"), upto.alias("upto"))
    # shingles of one class alone come first in its order and meet nothing
    lonely = F.col("n") - F.size("held")
    length = F.col("n") - needed(F.col("n"), percent) + 1
    return held.where(lonely < length).select("class", "n", lonely.alias("lonely"), F.slice("held", F.lit(1), (length - lonely).cast("int")).alias("held"), "upto")


def behind(upto: Column, at: Column) -> Column:
    """The shingles in each part that follow the one at place `at` (from 0) among those that other classes have."""
    reached = F.transform(upto, lambda c: F.greatest(c.cast("long"), at + 1))
    return F.zip_with(reached, F.concat(F.array((at + 1).cast("long")), F.slice(reached, 1, PARTS - 1)), lambda a, b: a - b)


def shared_behind(x: Column, y: Column) -> Column:
    """The most that two sets can share behind a matched shingle: the smaller of both counts of each part, summed."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.least(a, b)), F.lit(0).cast("long"), lambda a, b: a + b)


def alike(nx: Column, ny: Column, most: Column, percent: int) -> Column:
    """Whether an overlap of `most` could do: 100 * most >= percent * union."""
    return (100 + percent) * most >= percent * (nx + ny)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs (x, y) whose whole sets are alike."""
    side = lambda s: sets.select(F.col("class").alias(s), F.col("hashes").alias(f"h{s}"))

    def check(batches):
        import pyarrow as pa

        for batch in batches:
            keep = []
            for a, b in zip(batch.column("hx"), batch.column("hy")):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                at = np.searchsorted(a, b)
                both = int((a[np.minimum(at, len(a) - 1)] == b).sum())
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("x", "y").join(side("x"), "x").join(side("y"), "y").select("x", "y", "hx", "hy").mapInArrow(check, "x long, y long")


def links(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Verified links (x, y) that join all classes of a component, and the components (node, component) of classes with a link."""
    starts = written_once(prefixes(sets, percent))
    ladder = starts.select("class", "upto")
    grams = starts.select("class", "n", "lonely", F.posexplode("held").alias("at", "item")).select(F.col("item.gram").alias("gram"), "class", "n", (F.col("lonely") + F.col("at")).alias("pos"), F.col("at").cast("long").alias("at"))
    # sizes that a partner first met at this place can have; places without any meet nothing
    high = F.least(F.floor(F.col("n") * 100 / percent), F.floor(((100 + percent) * (F.col("n") - F.col("pos")) - percent * F.col("n")) / percent))
    grams = grams.withColumns({"low": needed(F.col("n"), percent), "high": high}).where("low <= high")
    band = lambda n: F.floor(F.log(F.col(n).cast("double")) / F.log(F.lit(1.25)))
    banded = grams.withColumn("band", band("n"))
    heads = written_once(banded.groupBy("gram", "band").agg(F.min(F.struct("pos", "class", "n", "at")).alias("head"), F.count("*").alias("k")).where("k > 1").select("gram", "band", F.col("head.class").alias("y"), F.col("head.n").alias("ny"), F.col("head.pos").alias("py"), F.col("head.at").alias("ay")))
    met = banded.join(heads, ["gram", "band"]).where(F.col("class") != F.col("y"))
    fit = lambda nx, px, ny, py: alike(nx, ny, F.least(nx - px, ny - py), percent) & (100 * F.least(nx, ny) >= percent * F.greatest(nx, ny))
    met = met.where(fit(F.col("n"), F.col("pos"), F.col("ny"), F.col("py"))).groupBy("class", "y").agg(F.count("*").alias("k"), F.min(F.struct("at", "n", "ay", "ny")).alias("m"))
    first = met.groupBy("class").agg(F.max_by(F.struct("y", "m"), F.struct("k", F.negative("y"))).alias("b")).select(F.col("class").alias("x"), "b.y", "b.m.*")
    first = first.join(ladder.select(F.col("class").alias("x"), F.col("upto").alias("ux")), "x").join(ladder.select(F.col("class").alias("y"), F.col("upto").alias("uy")), "y")
    # a leader leads some of its shingles only, so others may be shared before the matched one
    most = F.least("at", "ay") + 1 + shared_behind(behind(F.col("ux"), F.col("at")), behind(F.col("uy"), F.col("ay")))
    first = first.where(alike(F.col("n"), F.col("ny"), most, percent))
    found = written_once(verified(first, sets, percent))
    parts = connected_components(found, "x", "y")

    # classes that share a prefix shingle and are in different components so far
    placed = grams.join(parts.select(F.col("node").alias("class"), "component"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    placed = written_once(placed)
    open_ = placed.groupBy("gram").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.ceil(F.count("*") / SALT_ROWS).alias("salts")).where("a <> b").select("gram", "salts")
    rest = written_once(placed.join(open_, "gram").join(ladder, "class").withColumn("behind", behind(F.col("upto"), F.col("at"))).drop("upto", "at"))
    bands = F.explode(F.sequence(band("low"), band("high"))).alias("band")
    x = rest.select("gram", "salts", bands, F.col("class").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"), F.col("component").alias("cx"), F.col("behind").alias("bx")).withColumn("salt", F.pmod(F.xxhash64("x"), "salts")).drop("salts")
    # the other side goes to every part of a frequent shingle, so one part holds about SALT_ROWS classes to compare with all
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")
    y = rest.select("gram", band("n").alias("band"), salts, F.col("class").alias("y"), F.col("n").alias("ny"), F.col("pos").alias("py"), F.col("component").alias("cy"), F.col("behind").alias("by"))
    # the first shingle that two classes share is matched too, and nothing is shared before it
    suffix = alike(F.col("nx"), F.col("ny"), 1 + shared_behind(F.col("bx"), F.col("by")), percent)
    cross = x.join(y, ["gram", "band", "salt"]).where((F.col("x") < F.col("y")) & (F.col("cx") != F.col("cy")) & fit(F.col("nx"), F.col("px"), F.col("ny"), F.col("py")) & suffix)
    more = written_once(verified(cross.select("x", "y").distinct(), sets, percent))
    every = written_once(found.unionByName(more))
    if more.isEmpty():
        return every, parts
    return every, connected_components(every, "x", "y")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, text_hash), one for each row of docs.

    A set is the distinct `words`-word shingles of a whole text (the whole sequence
    where it is shorter); two documents link when 100 * intersection >= percent *
    union. component_id is the smallest id reachable by links, itself included.
    Texts without words and null texts have 0 shingles and link with nothing. Rows
    without an id link with nothing and have a null component. Rows that repeat an id
    are documents of their own. Other columns are left out.
    """
    return grouped(docs, words, percent, id_col, text_col).drop("group", "group2")


def grouped(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """near_duplicates with (group, group2), which tell components apart where ids repeat; null without words or without an id."""
    facts = written_once(classes(docs, words, id_col, text_col))
    known = facts.where("doc_id IS NOT NULL AND class IS NOT NULL")
    heads = written_once(known.groupBy("class", "class2").agg(F.min("doc_id").alias("head"), F.max("n_shingles").alias("n")))
    hits = shared_counts(docs.where(F.col(id_col).isNotNull()), words, percent, id_col, text_col)
    least = F.greatest(F.lit(1), F.floor(needed(F.col("n"), percent) / 5))
    wanted = written_once(hits.join(heads, "class").where(F.col("hits") >= least).select(F.col("head").alias("doc_id"), "class"))
    sets = written_once(class_sets(docs, wanted, words, id_col, text_col))
    if not sets.groupBy("class").count().where("count > 1").isEmpty():
        sets = written_once(sets.dropDuplicates(["class"]))  # rows that repeat id and text
    _, parts = links(sets, percent)
    parts = parts.select(F.col("node").alias("class"), "component")
    groups = written_once(heads.join(parts, "class").groupBy("component").agg(F.min("head").alias("least")))
    named = parts.join(groups, "component").select("class", "component", "least")
    group = [F.coalesce("component", "class").alias("group"), F.when(F.col("component").isNull(), F.col("class2")).otherwise(0).alias("group2")]
    heads = written_once(heads.join(named, "class", "left").select("class", "class2", F.coalesce("least", "head").alias("component_id"), *group))
    linked = facts.join(heads, ["class", "class2"], "left")
    of_id = [F.when(F.col("doc_id").isNotNull(), F.col(c)).alias(c) for c in ("group", "group2")]
    return linked.select("doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"), "text_hash", *of_id)


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, with one document of each component: that of the smallest id.

    Where near copies repeat that id, the one with the smallest hash of its text stays.
    Of rows that repeat id and text one stays. Texts without words and rows without an
    id stay. What goes is looked up by id and a hash of the text.
    """
    near = written_once(grouped(docs, words, percent, id_col, text_col).select("doc_id", "component_id", "text_hash", "group", "group2"))
    known = near.where("doc_id IS NOT NULL")
    first = known.where("doc_id = component_id AND group IS NOT NULL")
    least = first.groupBy("group", "group2").agg(F.min("text_hash").alias("_least"), F.max("text_hash").alias("_most")).where("_least < _most")
    others = first.join(least, ["group", "group2"]).where("text_hash > _least")
    gone = written_once(known.where("doc_id <> component_id").select("doc_id", "text_hash").union(others.select("doc_id", "text_hash")).distinct())
    again = written_once(known.where("doc_id = component_id").groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "text_hash"))
    text = F.coalesce(F.col(f"doc.`{text_col}`").cast("string"), F.lit(""))
    rows = common.whole_rows(docs).withColumn("_id", F.col(f"doc.`{id_col}`").cast("long")).withColumn("_hash", F.xxhash64(text))

    def matched(rows, ids, how):
        ids = ids.select(F.col("doc_id").alias("_i"), F.col("text_hash").alias("_h"))
        small = ids.count() <= BROADCAST_IDS
        return rows.join(F.broadcast(ids) if small else ids, (F.col("_id") == F.col("_i")) & (F.col("_hash") == F.col("_h")), how)

    rows = matched(rows, gone, "left_anti")
    if not again.isEmpty():
        rows = matched(rows, again, "left_anti").unionByName(matched(rows, again, "left_semi").dropDuplicates(["_id", "_hash"]))
    return rows.select("doc.*")


def near_duplicates_sql(words: int = 5, percent: int = 80) -> str:
    """near_duplicates for the table documents with distinct ids, for DuckDB: shingles as texts, every pair that shares one."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(ws) - {words - 1}, 1) + 1), lambda i: array_to_string(list_slice(ws, i, i + {words - 1}), ' '))) END AS grams FROM w),
n AS (SELECT doc_id, CAST(len(grams) AS BIGINT) AS n FROM s), g AS (SELECT doc_id, unnest(grams) AS gram FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_ FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
k AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * both_ >= {percent} * (a.n + b.n - both_)),
r AS (SELECT x, y FROM k UNION SELECT r.x, k.y FROM r JOIN k ON r.y = k.x)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(min(y), n.doc_id)) AS component_id FROM n LEFT JOIN r ON n.doc_id = r.x GROUP BY n.doc_id, n.n"""

"""Phrase collocation mining with weighted acyclic automata.

Every shard (some million words of one task) counts its n-grams, sorts them and builds
an automaton; it goes out in parts by prefix range: ranges of a hash of the first
word, from two words on of the first two. The automata of a range are united and their weights summed. Parts
of a phrase are looked up by composing the automaton of the parts wanted in a range with
the range's counts.

The orders are counted one after the other. A phrase can only be frequent if both its
parts without the last and without the first word are, so a filter of fixed size, made
from the frequent n-grams of the order before, keeps the rest out of the shards. The
filter only spares work: what counts is the sum in the united automata.

A word is known by a hash of its language and itself. That no two words that matter
share one is checked; if some do, all is counted again with another seed.
"""

from __future__ import annotations

from functools import partial, reduce

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.lineage import written_once
from . import common, tokens
from .automata import Automaton, union
from .shingles import _D, _K, mixed

#: Words of a shard, and sequences that a task unites at a time.
SHARD_WORDS = 2 << 20
#: Bits of the filter of frequent n-grams; more frequent n-grams only let more pass.
FILTER_BITS = 27

_BREAK = b"\xff"  # no byte of UTF-8
_CUT = bytes(255 if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))


def prints(columns: list[np.ndarray]) -> np.ndarray:
    """A hash of each sequence of labels."""
    h = columns[0]
    for c in columns[1:]:
        h = mixed((h ^ c * _D) * _K + c)
    return h


class Ranges:
    """2 ** bits prefix ranges; pairs that hold much are told apart by their third word too."""

    def __init__(self, bits: int, heavy: np.ndarray):
        self.bits, self.heavy = bits, heavy

    def of(self, columns: list[np.ndarray]) -> np.ndarray:
        h = prints(columns[:2])
        if len(columns) > 2 and len(self.heavy):
            h = np.where(np.isin(h, self.heavy), prints(columns[:3]), h)
        return (mixed(h) >> np.uint64(64 - self.bits)).astype(np.int64)

    def places(self, columns: list[np.ndarray], slot: np.ndarray) -> list[np.ndarray]:
        """Two places of each sequence in the filter, both in the part of its range."""
        h, inner = prints(columns), FILTER_BITS - self.bits
        within = np.uint64((1 << inner) - 1)
        return [(slot << inner) + (x & within).astype(np.int64) for x in (h, h >> np.uint64(32))]


def passes(bits: np.ndarray, ranges: Ranges, columns: list[np.ndarray]) -> np.ndarray:
    ok = np.ones(len(columns[0]), bool)
    for place in ranges.places(columns, ranges.of(columns)):
        ok &= (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
    return ok


def labels_of(text: bytes, lang: str, seed: int) -> tuple[list[bytes], np.ndarray]:
    """The words of a text and their labels; a break between pieces, and at the end, has the label 0."""
    from xxhash import xxh64_intdigest

    found = text.translate(_CUT).replace(_BREAK, b" \xff ").split()
    found.append(_BREAK)
    digest = partial(xxh64_intdigest, seed=seed) if seed else xxh64_intdigest
    h = np.fromiter(map(digest, found), np.uint64, len(found))
    own = np.maximum(mixed(h ^ np.uint64(xxh64_intdigest(lang.encode(), 1 + seed))), np.uint64(1))
    own[h == np.uint64(digest(_BREAK))] = 0
    return found, own


def counted(labels: np.ndarray, at: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct sequences of so many labels that begin at some places, in ascending order, and their counts."""
    values, dense = np.unique(labels, return_inverse=True)
    key, heads = dense[at].astype(np.uint64), []
    for j in range(1, order):
        if j > 1:
            head, key = np.unique(key, return_inverse=True)
            heads.append(head)
        key = key.astype(np.uint64) << np.uint64(32) | dense[at + j].astype(np.uint64)
    key, counts = np.unique(key, return_counts=True)
    columns = []
    low = np.uint64((1 << 32) - 1)
    for j in range(order - 1):
        columns.append(values[key & low])
        key = key >> np.uint64(32)
        if heads and j < order - 2:
            key = heads[-1 - j][key]
    columns.append(values[key])
    return columns[::-1], counts.astype(np.int64)


def shard_automata(docs: DataFrame, order: int, ranges: Ranges, before: Ranges, bits, seed: int, ask_words: bool) -> DataFrame:
    """Rows (slot, blob, lang, n, label, word): automata of the shards by range; at order 1 also the number of words of each lang, and when asked the words that pass the filter."""
    filter_ = docs.sparkSession.sparkContext.broadcast(bits) if bits is not None else None  # 2 ** FILTER_BITS bits

    def build(batches):
        import pyarrow as pa

        tokens.forget()
        held, size, totals, seen = [], 0, {}, np.zeros(0, np.uint64)
        names, kinds = ["slot", "blob", "lang", "n", "label", "word"], [pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.string()]

        def batch(rows, **columns):
            return pa.record_batch([pa.array(columns[c], k) if c in columns else pa.nulls(rows, k) for c, k in zip(names, kinds)], names=names)

        def flush():
            labels = np.concatenate(held)
            ok = labels != 0
            if order > 1:
                starts = np.flatnonzero(reduce(np.logical_and, [ok[j : len(ok) - order + 2 + j] for j in range(order - 1)]))
                good = np.zeros(len(labels) + 1, bool)
                for i in range(0, len(starts), 1 << 18):
                    some = starts[i : i + (1 << 18)]
                    good[some] = passes(filter_.value, before, [labels[some + j] for j in range(order - 1)])
                at = np.flatnonzero(good[:-1] & good[1:])
            else:
                at = np.flatnonzero(ok)
            if not len(at):
                return
            columns, counts = counted(labels, at, order)
            slot = ranges.of(columns)
            by = np.argsort(slot, kind="stable")
            slots, first = np.unique(slot[by], return_index=True)
            blobs = [Automaton.build([c[x] for c in columns], counts[x]).pack() for x in np.split(by, first[1:])]
            for i in range(0, len(blobs), 64):
                yield batch(len(slots[i : i + 64]), slot=slots[i : i + 64], blob=blobs[i : i + 64])

        for part in batches:
            for a, b in common.slices(part.column("text")):
                some = part.slice(a, b - a)
                langs, cut = some.column("lang").to_pylist(), []
                for text, lang in zip(some.column("text").cast(pa.binary()).to_pylist(), langs):
                    cut.append(labels_of(text, lang, seed))
                    if order == 1 and len(cut[-1][1]) > 1:
                        totals[lang] = totals.get(lang, 0) + int(np.count_nonzero(cut[-1][1]))
                if ask_words:
                    starts = np.cumsum([0, *(len(x[1]) for x in cut)])
                    own, where = np.unique(np.concatenate([x[1] for x in cut]), return_index=True)
                    fresh = passes(filter_.value, before, [own]) & (own != 0) & ~np.isin(own, seen)
                    docs_ = np.searchsorted(starts, where[fresh], side="right") - 1
                    if fresh.any():
                        seen = np.concatenate([seen, own[fresh]])
                        yield batch(len(docs_), slot=(own[fresh] % np.uint64(1 << ranges.bits)).astype(np.int64), lang=[langs[d] for d in docs_], label=own[fresh].view(np.int64), word=[cut[d][0][i].decode() for d, i in zip(docs_, where[fresh] - starts[docs_])])
                        if len(seen) > SHARD_WORDS:
                            seen = np.zeros(0, np.uint64)
                for found, labels in cut:
                    held.append(labels)
                    size += len(labels)
                    found.clear()
                    if size >= SHARD_WORDS:
                        yield from flush()
                        held, size = [], 0
                        common.settle()
        if held:
            yield from flush()
        if totals:
            yield batch(len(totals), slot=[0] * len(totals), lang=list(totals), n=list(totals.values()))

    return docs.mapInArrow(build, "slot long, blob binary, lang string, n long, label long, word string")


def united(shards: DataFrame, order: int, ranges: Ranges, least: int) -> DataFrame:
    """Rows (slot, order, blob, bits): for each range the automaton of the sequences with at least so many, and its part of the filter.

    Rows (lang, n) and (lang, label, word) of the shards pass through.
    """
    more = ["lang", "n", "label", "word"]

    def unite(batches):
        import pyarrow as pa

        now, held, size = None, [], 0

        def finish():
            columns, counts = union(held)
            keep = counts >= least
            columns, counts = [c[keep] for c in columns], counts[keep]
            inner = FILTER_BITS - ranges.bits
            part = np.zeros(1 << inner, bool)
            for place in ranges.places(columns, np.zeros(len(counts), np.int64)):
                part[place] = True
            blob = Automaton.build(columns, counts).pack()
            own = [pa.array([now], pa.int64()), pa.array([order], pa.int32()), pa.array([blob], pa.binary()), pa.array([np.packbits(part, bitorder="little").tobytes()], pa.binary())]
            return pa.record_batch([*own, *[pa.nulls(1, k) for k in (pa.string(), pa.int64(), pa.int64(), pa.string())]], names=["slot", "order", "blob", "bits", *more])

        for part in batches:
            plain = part.filter(part.column("blob").is_null())
            if len(plain):
                none = [pa.nulls(len(plain), k) for k in (pa.int64(), pa.int32(), pa.binary(), pa.binary())]
                yield pa.record_batch([*none, *[plain.column(c) for c in more]], names=["slot", "order", "blob", "bits", *more])
            part = part.filter(part.column("blob").is_valid())
            for slot, blob in zip(part.column("slot").to_pylist(), part.column("blob")):
                if slot != now:
                    if held:
                        yield finish()
                    now, held, size = slot, [], 0
                one = Automaton.unpack(blob.as_py())
                held.append(one)
                size += len(one.final)
                if size > SHARD_WORDS and len(held) > 1:
                    held = [Automaton.build(*union(held))]
                    size = len(held[0].final) >> 1  # the next union pays off after as many again
        if held:
            yield finish()

    rows = shards.repartition(1 << ranges.bits, "slot").sortWithinPartitions("slot")
    return rows.mapInArrow(unite, "slot long, order int, blob binary, bits binary, lang string, n long, label long, word string")


def filter_bits(rows: DataFrame, ranges: Ranges) -> np.ndarray:
    """The filter of an order: 2 ** FILTER_BITS bits whatever the input."""
    bits = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    width = len(bits) >> ranges.bits
    for r in rows.select("slot", "bits").toLocalIterator():
        bits[r["slot"] * width : (r["slot"] + 1) * width] = np.frombuffer(r["bits"], np.uint8)
    return bits


def sequences_of(rows: DataFrame, longest: int) -> DataFrame:
    """Rows (order, w1 to w<longest>, a), one for each sequence of the automata; labels that are not there are 0."""
    names = [f"w{j + 1}" for j in range(longest)]

    def expand(batches):
        import pyarrow as pa

        for part in batches:
            for blob in part.column("blob"):
                columns, counts = Automaton.unpack(blob.as_py()).sequences()
                zeros = [np.zeros(len(counts), np.uint64)] * (longest - len(columns))
                yield pa.record_batch([pa.array(np.full(len(counts), len(columns), np.int32)), *[pa.array(np.ascontiguousarray(c).view(np.int64)) for c in [*columns, *zeros]], pa.array(counts)], names=["order", *names, "a"])

    return rows.select("blob").mapInArrow(expand, f"order int, {', '.join(f'{n} long' for n in names)}, a long")


def parts_counted(phrases: DataFrame, automata: DataFrame, ranges: dict[int, Ranges], longest: int, salts: int = 8) -> DataFrame:
    """Rows (order, w.., a, cut, l, r): for every cut of a phrase the counts of both parts.

    The parts go to their ranges and are composed with the automata there; a range has
    `salts` places, so one word that many phrases begin with is not one task's work.
    """
    names = [f"w{j + 1}" for j in range(longest)]
    parts = [f"p{j + 1}" for j in range(longest - 1)]
    whole = ["order", *names, "a"]

    def ask(batches):
        import pyarrow as pa

        for part in batches:
            orders = part.column("order").to_numpy()
            for k in np.unique(orders).tolist():
                rows = pa.RecordBatch.from_arrays([part.column(c) for c in whole], names=whole).filter(pa.array(orders == k))
                words = [rows.column(c).to_numpy().view(np.uint64) for c in names]
                salt = (prints(words[:k]) % np.uint64(salts)).astype(np.int64)
                for cut in range(1, k):
                    for side, columns in enumerate((words[:cut], words[cut:k])):
                        zeros = [np.zeros(len(salt), np.uint64)] * (longest - 1 - len(columns))
                        key = [pa.array(ranges[len(columns)].of(columns) * salts + salt), pa.array(np.ones(len(salt), np.int32)), pa.array(np.full(len(salt), len(columns), np.int32)), pa.nulls(len(salt), pa.binary())]
                        more = [pa.array(np.full(len(salt), x, np.int32)) for x in (cut, side)]
                        yield pa.record_batch([*key, *rows.columns, *more, *[pa.array(np.ascontiguousarray(c).view(np.int64)) for c in [*columns, *zeros]]], names=["place", "kind", "length", "blob", *whole, "cut", "side", *parts])

    def answer(batches):
        import pyarrow as pa

        place, known = None, {}
        for batch in batches:
            places, kinds = batch.column("place").to_numpy(), batch.column("kind").to_numpy()
            lengths = batch.column("length").to_numpy()
            ends = np.append(np.flatnonzero(np.diff(places)) + 1, len(places))
            for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
                if places[a] != place:
                    place, known = places[a], {}
                for i in range(a, b):
                    if kinds[i]:
                        break
                    known[int(lengths[i])] = Automaton.unpack(batch.column("blob")[i].as_py())
                for k in np.unique(lengths[a:b][kinds[a:b] == 1]).tolist():
                    here = a + np.flatnonzero((lengths[a:b] == k) & (kinds[a:b] == 1))
                    rows = batch.take(pa.array(here))
                    n = known[k].compose([rows.column(c).to_numpy().view(np.uint64) for c in parts[:k]])
                    yield pa.record_batch([*[rows.column(c) for c in [*whole, "cut", "side"]], pa.array(n)], names=[*whole, "cut", "side", "f"])

    own = f"order int, {', '.join(f'{n} long' for n in names)}, a long"
    out = f"place long, kind int, length int, blob binary, {own}, cut int, side int, {', '.join(f'{n} long' for n in parts)}"
    asked = phrases.select(*whole).mapInArrow(ask, out)
    salted = automata.select("slot", F.col("order").alias("length"), "blob").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    known = salted.select((F.col("slot") * salts + F.col("salt")).alias("place"), F.lit(0).alias("kind"), "length", "blob")
    both = known.unionByName(asked, allowMissingColumns=True).repartition("place").sortWithinPartitions("place", "kind")
    found = both.mapInArrow(answer, f"{own}, cut int, side int, f long")
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("f")))
    return found.groupBy(*whole, "cut").agg(side(0).alias("l"), side(1).alias("r"))


def not_inside_longer(phrases: DataFrame, longest: int, percent: int) -> DataFrame:
    """Phrases whose words do not stand in a longer one that has at least so many percent of their count."""
    names = [f"w{j + 1}" for j in range(longest)]
    shorter = []
    for order in range(3, longest + 1):
        rows = phrases.where(F.col("order") == order)
        for size in range(2, order):
            for start in range(order - size + 1):
                shorter.append(rows.select(*[F.col(names[start + j]).alias(names[j]) if j < size else F.lit(0).cast("long").alias(names[j]) for j in range(longest)], F.col("a").alias("_longer")))
    if not shorter:
        return phrases
    most = reduce(DataFrame.unionByName, shorter).groupBy(*names).agg(F.max("_longer").alias("_longer"))
    wide = lambda c: F.col(c).cast("decimal(30,0)")
    return phrases.join(most, names, "left").where(F.col("_longer").isNull() | (100 * wide("_longer") < percent * wide("a"))).drop("_longer")


def count_all(docs: DataFrame, longest: int, least: int, seed: int) -> tuple[DataFrame, DataFrame, dict[int, DataFrame], dict[int, Ranges]]:
    """Rows (lang, n) and (label, lang, word), and for each order the automata and their ranges."""
    none = np.zeros(0, np.uint64)
    bits = lambda n: min(12, max(4, int(n - 1).bit_length()))
    ranges = {1: Ranges(bits(docs.rdd.getNumPartitions()), none)}
    found = written_once(united(shard_automata(docs, 1, ranges[1], ranges[1], None, seed, False), 1, ranges[1], least))
    totals = found.where("n IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    size = totals.agg(F.sum("n")).first()[0] or 0
    automata, words = {1: found.where("blob IS NOT NULL")}, None
    for order in range(2, longest + 1):
        heavy = none
        if order == 3:
            # pairs that a range is filled with; at most four for each range
            share = max(least, size // (4 << ranges[2].bits))
            heavy = sequences_of(automata[2], 2).where(F.col("a") >= share).select("w1", "w2").collect()
            heavy = prints([np.array([r[i] for r in heavy], np.int64).view(np.uint64) for i in (0, 1)]) if heavy else none
        ranges[order] = Ranges(bits(size / SHARD_WORDS + 1), heavy if order == 3 else ranges[order - 1].heavy)
        bits_before = filter_bits(automata[order - 1], ranges[order - 1])
        found = written_once(united(shard_automata(docs, order, ranges[order], ranges[order - 1], bits_before, seed, order == 2), order, ranges[order], least))
        if order == 2:
            words = written_once(found.where("word IS NOT NULL").select("label", "lang", "word").distinct())
        automata[order] = found.where("blob IS NOT NULL")
    return totals, words, automata, ranges


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, percent: int = 80, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the first `top` phrases of each language.

    Texts, with A-Z in lower case, are cut into pieces at `[.,;:!?\\x0A-\\x0D]` and those into words at spaces
    and tabs. A phrase has 2 to `longest` words and a >= least occurrences in pieces; l and r are the
    counts of the parts of its worst cut (smallest score, then the first), score is
    floor(2000000 a / (l + r)), n the words of the language. Phrases inside a longer one that has
    at least `percent` percent of their count are left out. Order: score, a (both descending), phrase.

    Null texts have no words; a null language is `und`; repeated rows count again; a very long text is one row
    of work, whatever its shard; an empty table gives no rows. Other columns are not read.
    """
    common.ship(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    seed = 0
    while True:
        totals, words, automata, ranges = count_all(docs, longest, least, seed)
        if words.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            break
        seed += 1
    names = [f"w{j + 1}" for j in range(longest)]
    phrases = written_once(sequences_of(reduce(DataFrame.unionByName, [automata[k] for k in range(2, longest + 1)]), longest))
    own = not_inside_longer(phrases, longest, percent)
    cuts = parts_counted(own, reduce(DataFrame.unionByName, [automata[k] for k in range(1, longest)]), ranges, longest)
    wide = "cast({} as decimal(38,0))"
    cuts = cuts.withColumn("score", F.expr(f"{wide.format('2000000')} * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    worst = cuts.groupBy("order", *names, "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("x")).select("order", *names, "a", "x.score", "x.l", "x.r")
    spoken = worst.join(words.select(F.col("label").alias("w1"), "lang"), "w1")
    order = [F.col("score").desc(), F.col("a").desc()]
    first = written_once(spoken.withColumn("_r", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("_r") <= top).drop("_r"))
    texts = first
    for w in names:
        texts = texts.join(words.select(F.col("label").alias(w), F.col("word").alias(f"t{w}")), w, "left")
    texts = texts.select("lang", F.concat_ws(" ", *[f"t{w}" for w in names]).alias("phrase"), "a", "l", "r", "score")
    ranked = texts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, F.col("phrase"))).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(longest: int = 4, least: int = 30, percent: int = 80, top: int = 2000) -> str:
    """collocations for the table documents, for DuckDB: all n-grams are listed as strings and counted."""
    grams = " UNION ALL ".join(f"SELECT lang, {k} AS k, array_to_string(list_slice(ws, 1, {k}), ' ') AS phrase FROM g WHERE len(ws) >= {k}" for k in range(1, longest + 1))
    return f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
x AS (SELECT lang, id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w),
g AS (SELECT lang, list(word) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN CURRENT ROW AND {longest - 1} FOLLOWING) AS ws FROM x),
f AS (SELECT lang, k, phrase, count(*) AS a FROM ({grams}) GROUP BY lang, k, phrase),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND a >= {least}),
cuts AS (SELECT *, array_to_string(list_slice(ws, 1, j), ' ') AS lp, array_to_string(list_slice(ws, j + 1, k), ' ') AS rp FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
s AS (SELECT cuts.lang, cuts.phrase, cuts.a, l.a AS l, r.a AS r, (2000000::HUGEINT * cuts.a) // (l.a + r.a) AS score, cuts.j
    FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = cuts.lp JOIN f r ON r.lang = cuts.lang AND r.phrase = cuts.rp),
worst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM s) WHERE o = 1),
subs AS (SELECT lang, a, array_to_string(list_slice(ws, b, b + z - 1), ' ') AS phrase FROM (SELECT *, unnest(range(1, k - z + 2)) AS b FROM (SELECT *, unnest(range(2, k)) AS z FROM c WHERE k > 2))),
long AS (SELECT lang, phrase, max(a) AS m FROM subs GROUP BY lang, phrase),
kept AS (SELECT worst.* FROM worst LEFT JOIN long ON worst.lang = long.lang AND worst.phrase = long.phrase WHERE m IS NULL OR 100::HUGEINT * m < {percent} * worst.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n.n, CAST(score AS BIGINT) AS score FROM ranked JOIN n ON ranked.lang = n.lang WHERE rank <= {top}"""

"""Counts and colour sets of k-mers.

Neighbouring k-mers share most of their characters, so they are not shuffled one by one.
A text is cut into super-k-mers: runs of k-mers with the same minimizer, the least hash
of the m-mers inside a k-mer. A super-k-mer goes out as one string, to the place of its
minimizer; as equal k-mers have equal minimizers, the k-mers listed there need no shuffle
of their own: each group of places tells its k-mers apart by sorting them as numbers.
They travel packed, a compressed row for the groups of a bucket out of many texts, and none is stored.
Groups that hold too much for a task are the exception: their
k-mers are combined by task and shuffled as they are. Short k-mers, of which there are
few different ones, are combined batch by batch instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .lineage import shuffles_dropped, written_once
from .sweep import union_all

CHUNK = 1 << 16
#: Places that minimizers are dealt to.
BUCKET_BITS = 18
#: K-mers that a group of places holds on average, and in one place at most.
GROUP, FULL = 1 << 20, 1 << 22
#: Characters whose super-k-mers are packed together.
PACKED = 1 << 24
#: Buckets that groups travel in, and the most groups of one.
BUCKETS, IN_A_BUCKET = 512, 64
#: Most rounds of a query, and the characters that each has at least.
ROUNDS, ROUND = 4, 1 << 25
#: Below this length k-mers are combined where they are read.
SHORT = 7

# Colours of a sample graph and the classes its colour sets fold to.
COLOURS = {"short_1": 0, "short_2": 1, "hap1": 2, "hap2": 3, "GRCh38": 4, "chrM": 5}
COLOUR_CLASSES = {
    "Illumina_only": ["0", "1", "0-1"],
    "Hap1_only": ["2"],
    "Hap2_only": ["3"],
    "Hap_only": ["2-3"],
    "Hap_Illumina": ["0-2-3", "1-2-3", "0-1-2-3"],
    "Hap1_Illumina": ["0-2", "1-2", "0-1-2"],
    "Hap2_Illumina": ["0-3", "1-3", "0-1-3"],
    "Hap1_GRCh38": ["2-4"],
    "Hap2_GRCh38": ["3-4"],
    "GRCh38": ["4"],
    "Hap_GRCh38": ["2-3-4"],
    "GRCh38_Illumina": ["0-4", "1-4", "0-1-4"],
}
OTHER_CLASS = "GRCh38_shared"


def sequence_chunks(seqs: DataFrame, overlap: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Cut ``seq`` into pieces of ``chunk`` characters, each with ``overlap`` characters of the next.

    Adds ``chunk_no``. One scan of the sequence makes all pieces, so a chromosome in a
    single row costs no more than its length.
    """
    pieces = seqs.withColumn("_pieces", F.regexp_extract_all("seq", F.lit(f"(?s)(.{{1,{chunk}}})"), F.lit(1)))
    pieces = pieces.select(*[c for c in seqs.columns if c != "seq"], "_pieces", F.posexplode("_pieces").alias("chunk_no", "_piece"))
    tail = F.coalesce(F.substring(F.try_element_at("_pieces", F.col("chunk_no") + 2), 1, overlap), F.lit("")) if overlap else F.lit("")
    return pieces.select(*[c for c in seqs.columns if c != "seq"], "chunk_no", F.concat("_piece", tail).alias("seq"))


def canonical(kmer: Column) -> Column:
    """The smaller of a k-mer and its reverse complement."""
    return F.least(kmer, F.reverse(F.translate(kmer, "ACGTacgt", "TGCAtgca")))


def kmers(seqs: DataFrame, k: int, canonical_form: bool = False, alphabet: str | None = None) -> DataFrame:
    """One row per k-mer occurrence, in column ``kmer`` beside the other columns of ``seqs``.

    A look-ahead match lists all k-mers of a piece in one pass. With ``alphabet``
    only k-mers made of its characters count.
    """
    unit = f"[{alphabet}]" if alphabet else "."
    # k-mers are k times the text, so the text is spread first, into tasks sized by its bytes:
    # one file or one long sequence must not hold them all
    pieces = sequence_chunks(seqs, overlap=k - 1).hint("rebalance")
    found = F.explode(F.regexp_extract_all("seq", F.lit(f"(?s)(?=({unit}{{{k}}}))"), F.lit(1)))
    out = pieces.select(*[c for c in seqs.columns if c != "seq"], found.alias("kmer"))
    return out.withColumn("kmer", canonical(F.col("kmer"))) if canonical_form else out


def _runs(k: int, m: int | None, canonical_form: bool, alphabet: str | None):
    """A function that finds the runs of k-mers with one minimizer in some texts: their joined text, and of each run the text's number, the place and where it begins and ends."""
    m, mask = min(k, m or (11 if alphabet == "ACGT" else max(4, min(10, k // 2)))), (1 << BUCKET_BITS) - 1
    longest = 4096

    def runs(texts):
        import re

        import numpy as np

        factor, spread = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
        strands = str.maketrans("ACGTacgt", "TGCAtgca")
        ordinary = re.compile(f"[{alphabet}]") if alphabet else None

        def hashes(codes, order):
            h = np.zeros(len(codes) - m + 1, np.uint64)
            for j in order:
                h = h * factor + codes[j : len(codes) - m + 1 + j]
            h = (h ^ (h >> np.uint64(32))) * spread
            return h ^ (h >> np.uint64(29))

        whole = "".join(texts)
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32).astype(np.uint64)
        ends = np.cumsum([len(t) for t in texts])
        if len(codes) < k:
            return whole, *(np.zeros(0, np.int64) for _ in range(4))
        least = hashes(codes, range(m))
        if canonical_form:
            other = np.frombuffer(whole.translate(strands).encode("utf-32-le"), np.uint32).astype(np.uint64)
            least = np.minimum(least, hashes(other, reversed(range(m))))
        width, have = k - m + 1, 1
        while have < width:
            step = min(have, width - have)
            least, have = np.minimum(least[:-step], least[step:]), have + step
        row = np.searchsorted(ends, np.arange(len(least)), side="right")
        valid = np.arange(len(least)) + k <= ends[row]
        if ordinary is not None:
            values, at = np.unique(codes, return_inverse=True)
            odd = np.array([not ordinary.match(chr(int(v))) for v in values])[at]
            before = np.concatenate([[0], np.cumsum(odd)])
            valid &= before[k : k + len(least)] == before[: len(least)]
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (least[1:] != least[:-1]) | (row[1:] != row[:-1])
        start = np.flatnonzero(new)
        stop = np.append(start[1:], len(least))
        last = np.maximum.accumulate(np.where(valid, np.arange(len(least)), -1))
        stop = np.minimum(stop, last[stop - 1] + 1)
        parts = -(-(stop - start) // longest)
        which = np.repeat(np.arange(len(start)), parts)
        begin = start[which] + longest * (np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts))
        end = np.minimum(begin + longest, stop[which]) + k - 1
        return whole, row[begin], (least[begin] & np.uint64(mask)).astype(np.int32), begin, end

    return runs


def _in_bounds(texts: Sequence[str | None]):
    """Pairs of the first text's number and texts, of about a million characters at a time."""
    held, size, first = [], 0, 0
    for i, text in enumerate(texts):
        held.append(text or "")
        size += len(held[-1])
        if size > 1 << 20 or i + 1 == len(texts):
            yield first, held
            held, size, first = [], 0, i + 1


def _dealt_chunks(seqs: DataFrame, k: int) -> DataFrame:
    # pieces of a text are dealt out first, as one file or one long sequence must not be one task's work
    tasks = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sequence_chunks(seqs, overlap=k - 1).drop("chunk_no").repartition(tasks, F.xxhash64("seq"))


def super_kmers(seqs: DataFrame, k: int, m: int | None = None, canonical_form: bool = False, alphabet: str | None = None) -> DataFrame:
    """Rows (other columns, bucket, piece): runs of k-mers with one minimizer, whose hash has ``bucket`` as its last bits.

    ``m`` is the length of the minimizer; unless given, 11 bases or half a k-mer of other characters, from 4 to 10: those
    of the common words of a text are too frequent if shorter. In canonical form a
    minimizer is that of both strands. With ``alphabet`` no k-mer holds another character.
    Rows come in bounded pieces, so neither a long text nor a long run is held by one.
    """
    others = [c for c in seqs.columns if c != "seq"]
    runs = _runs(k, m, canonical_form, alphabet)

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            for first, texts in _in_bounds(batch.column("seq").to_pylist()):
                whole, row, bucket, begin, end = runs(texts)
                found = [whole[a:b] for a, b in zip(begin.tolist(), end.tolist())]
                place = pa.array(first + row)
                yield pa.record_batch([*[batch.column(c).take(place) for c in others], pa.array(bucket, pa.int32()), pa.array(found, pa.string())], names=[*others, "bucket", "piece"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in seqs.schema.fields if f.name != "seq")
    return _dealt_chunks(seqs, k).mapInArrow(cut, f"{kinds}{', ' if kinds else ''}bucket int, piece string")


def _part_loads(seqs: DataFrame, k: int, parts: int, m: int | None = None, canonical_form: bool = False, alphabet: str | None = None) -> DataFrame:
    """K-mers in each of ``parts`` groups of places, counted batch by batch; nothing is spelled."""
    runs = _runs(k, m, canonical_form, alphabet)

    def count(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            load = np.zeros(parts, np.int64)
            for _, texts in _in_bounds(batch.column("seq").to_pylist()):
                _, _, bucket, begin, end = runs(texts)
                load += np.bincount(bucket % parts, end - begin - k + 1, parts).astype(np.int64)
            at = np.flatnonzero(load)
            yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(load[at])], names=["bucket", "load"])

    return _dealt_chunks(seqs.select("seq"), k).mapInArrow(count, "bucket int, load long")


def _packed_pieces(
    seqs: DataFrame, k: int, parts: int, without: Sequence[int] = (), subs: int = 1, rounds: int = 1, turn: int = 0,
    m: int | None = None, canonical_form: bool = False, alphabet: str | None = None,
) -> DataFrame:
    """Rows (bucket, rows, size, body): super-k-mers of ``subs`` groups of places beside the other columns, packed for the shuffle.

    One holds the ``rows`` super-k-mers of its groups out of several million characters as a compressed Arrow
    stream of ``size`` bytes, so neighbours share their overhead; ``sub`` tells its groups apart. Groups in ``without`` are
    left out, and of ``rounds`` rounds, which buckets take in turns, all but one.
    """
    others = [c for c in seqs.columns if c != "seq"]
    runs = _runs(k, m, canonical_form, alphabet)

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        codec = pa.Codec("zstd")

        def packed(held):
            part = np.concatenate([p for p, _ in held])
            order = np.argsort(part, kind="stable")
            rows = pa.Table.from_batches([b for _, b in held]).combine_chunks().take(pa.array(order))
            edges = np.flatnonzero(np.diff(part[order] // subs, prepend=-1, append=-1))
            sizes, bodies = [], []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema) as out:
                    out.write_table(rows.slice(a, b - a))
                raw = sink.getvalue()
                sizes.append(raw.size)
                bodies.append(codec.compress(raw, asbytes=True))
            at, many = (part[order][edges[:-1]] // subs).astype(np.int32), np.diff(edges)
            return pa.record_batch([pa.array(at), pa.array(many), pa.array(sizes, pa.int64()), pa.array(bodies, pa.binary())], names=["bucket", "rows", "size", "body"])

        held, size = [], 0
        for batch in batches:
            for first, texts in _in_bounds(batch.column("seq").to_pylist()):
                whole, row, bucket, begin, end = runs(texts)
                part = bucket % parts
                if without or rounds > 1:
                    keep = ~np.isin(part, without) & (part // subs % rounds == turn)
                    row, part, begin, end = row[keep], part[keep], begin[keep], end[keep]
                found = pa.array([whole[a:b] for a, b in zip(begin.tolist(), end.tolist())], pa.string())
                place = pa.array(first + row)
                held.append((part, pa.record_batch([*[batch.column(c).take(place) for c in others], pa.array((part % subs).astype(np.int16)), found], names=[*others, "sub", "piece"])))
                size += len(whole)
                if size > PACKED:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    return _dealt_chunks(seqs, k).mapInArrow(pack, "bucket int, rows long, size long, body binary")


def _dealing(texts: DataFrame, k: int, **form) -> tuple[int, int, list[int], int]:
    """The number of groups of places of about GROUP k-mers, of those that travel in one bucket, the groups with more than FULL, and the characters."""
    with shuffles_dropped(texts.sparkSession):
        size = int(texts.agg(F.sum(F.length("seq"))).first()[0] or 0)
        groups = min(1 << BUCKET_BITS, max(1, -(-size // GROUP)))
        load = _part_loads(texts, k, groups, **form).groupBy("bucket").agg(F.sum("load").alias("load"))
        full = sorted(r["bucket"] for r in load.where(F.col("load") > FULL).collect())  # one for each FULL k-mers at most
    return groups, min(IN_A_BUCKET, -(-groups // BUCKETS)), full, size


def _by_sub(rows):
    """The tables of each group of a bucket."""
    import numpy as np
    import pyarrow as pa

    sub = rows.column("sub").to_numpy()
    order = np.argsort(sub, kind="stable")
    edges = np.flatnonzero(np.diff(sub[order], prepend=-1, append=-1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield rows.take(pa.array(order[a:b])) if len(edges) > 2 else rows


def _crowded(seqs: DataFrame, k: int, groups: int, full: Sequence[int], keys: Sequence[str], aggregate: Column, m: int | None = None, canonical_form: bool = False, alphabet: str | None = None, packed: bool = False) -> DataFrame:
    """Rows (keys, bucket, kmer, result) of the k-mers of full groups, by a shuffle of their own."""
    places = seqs.sparkSession.createDataFrame([(b,) for b in full], "bucket int")
    pieces = super_kmers(seqs, k, m, canonical_form, alphabet).withColumn("bucket", F.pmod("bucket", F.lit(groups)))
    return _by_bucket(pieces, places, k, keys, aggregate, canonical_form, packed)[1]


def _unpacked_pieces(sizes, bodies):
    """The table of some packed rows."""
    import pyarrow as pa

    codec = pa.Codec("zstd")
    return pa.concat_tables([pa.ipc.open_stream(codec.decompress(b, n)).read_all() for n, b in zip(sizes, bodies)]).combine_chunks()


def _listed(pieces: DataFrame, k: int, canonical_form: bool, packed: bool) -> DataFrame:
    """The k-mers of super-k-mers, in column ``kmer``; packed ones are longs of two bits a base."""
    rows = pieces.withColumn("_at", F.explode(F.sequence(F.lit(1), F.length("piece") - k + 1)))
    rows = rows.withColumn("kmer", F.substring("piece", F.col("_at"), F.lit(k))).drop("piece", "_at")
    rows = rows.withColumn("kmer", canonical(F.col("kmer"))) if canonical_form else rows
    return rows.withColumn("kmer", F.conv(F.translate("kmer", "ACGT", "0123"), 4, 10).cast("long")) if packed else rows


def _unpacked(df: DataFrame, k: int) -> DataFrame:
    return df.withColumn("kmer", F.translate(F.lpad(F.conv(F.col("kmer").cast("string"), 10, 4), k, "0"), "0123", "ACGT"))


def can_pack(k: int, alphabet: str | None) -> bool:
    return alphabet == "ACGT" and k <= 31


def full_buckets(pieces: Sequence[DataFrame], k: int) -> DataFrame:
    """Places with more than a quarter of a task's share of all k-mers of some super-k-mers, or than FULL: at most four for each task, and one for each FULL k-mers."""
    return _full(_loads(pieces, k))


def _loads(pieces: Sequence[DataFrame], k: int) -> DataFrame:
    """K-mers in each place."""
    load = union_all([p.select("bucket", (F.length("piece") - k + 1).alias("load")) for p in pieces])
    return written_once(load.groupBy("bucket").agg(F.sum("load").alias("load")))


def _full(load: DataFrame) -> DataFrame:
    tasks = int(load.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = load.agg(F.least(F.sum("load") / (4 * tasks), F.lit(float(FULL))).alias("_share")).hint("broadcast")
    return load.join(share, F.col("load") > F.col("_share")).select("bucket")


def _told_apart(texts: Sequence[str], k: int, canonical_form: bool = False):
    """The k-mers of some texts, ordered so that equal ones are neighbours: the text of each, where the distinct ones begin, and a function that spells them.

    K-mers are compared as numbers of a few bits a character, never by a hash alone.
    """
    import numpy as np

    whole = "".join(texts)
    codes = lambda t: np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    many = np.maximum(sizes - k + 1, 0)
    owner = np.repeat(np.arange(len(texts)), many)
    start = np.arange(len(owner)) + np.repeat(np.cumsum(sizes) - sizes - np.cumsum(many) + many, many)
    strands = whole.translate(str.maketrans("ACGTacgt", "TGCAtgca")) if canonical_form else whole
    letters = np.unique(np.concatenate([np.unique(codes(t)) for t in {whole, strands}]))
    bits = max(1, int(len(letters) - 1).bit_length())

    def numbers(text, order):
        rank, out, span = np.searchsorted(letters, codes(text)).astype(np.uint64), [], 64 // bits
        for i in range(0, k, span):
            word = np.zeros(max(len(rank) - k + 1, 0), np.uint64)
            for j in order[i : i + span]:
                word = (word << np.uint64(bits)) | rank[j : j + len(word)]
            out.append(word[start])
        return out

    words, back = numbers(whole, range(k)), np.zeros(len(start), bool)
    if canonical_form:
        other, open_ = numbers(strands, range(k)[::-1]), np.ones(len(start), bool)
        for a, b in zip(words, other):
            back |= open_ & (b < a)
            open_ &= a == b
        words = [np.where(back, b, a) for a, b in zip(words, other)]
    mixed = np.zeros(len(start), np.uint64)
    for w in words:
        mixed = (mixed ^ w) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed)
    differ = lambda x: np.concatenate([[True], x[order][1:] != x[order][:-1]]) if len(order) else np.zeros(0, bool)
    new = np.logical_or.reduce([differ(w) for w in words])
    if (new & ~differ(mixed)).any():  # two k-mers with one hash
        order = np.lexsort(words[::-1])
        new = np.logical_or.reduce([differ(w) for w in words])
    first = np.flatnonzero(new)

    def spelled():
        at = order[first]
        return [strands[a : a + k][::-1] if r else whole[a : a + k] for a, r in zip(start[at].tolist(), back[at].tolist())]

    return owner[order], first, spelled


def _tallied(kind: str, k: int, canonical_form: bool = False, keys: Sequence[str] = ()):
    """What a group of places gives: ``n`` per k-mer, ``mask`` per k-mer, or the number of k-mers of each mask (``masks``); keys go first."""

    def tally(group):
        import numpy as np
        import pyarrow as pa

        owner, first, spelled = _told_apart(group.column("piece").to_pylist(), k, canonical_form)
        if not len(owner):
            return pa.table({**{c: group.column(c).slice(0, 0) for c in keys}, **_empty(kind)})
        if kind == "n":
            out = {"kmer": pa.array(spelled(), pa.string()), "n": pa.array(np.diff(np.append(first, len(owner))), pa.int64())}
        else:
            mask, seen = _bits(group.column("colour"), owner, first)
            if kind == "mask":
                out = {"kmer": pa.array(spelled(), pa.string()), "mask": pa.array(mask, pa.int64(), mask=~seen)}
            else:
                found, n = np.unique(np.stack([mask, seen.astype(np.int64)]), axis=1, return_counts=True)
                out = {"mask": pa.array(found[0], pa.int64(), mask=found[1] == 0), "n": pa.array(n, pa.int64())}
        rows = len(next(iter(out.values())))
        return pa.table({**{c: group.column(c).take(pa.array(np.zeros(rows, np.int64))) for c in keys}, **out})

    return tally


def _empty(kind: str) -> dict:
    import pyarrow as pa

    kinds = {"kmer": pa.string(), "mask": pa.int64(), "n": pa.int64()}
    return {c: pa.array([], kinds[c]) for c in {"n": ("kmer", "n"), "mask": ("kmer", "mask"), "masks": ("mask", "n")}[kind]}


def _bits(colours, owner, first):
    """Per distinct k-mer the bits of the colours it occurs in, and whether any is known."""
    import numpy as np

    known = np.array([c is not None for c in colours.to_pylist()])
    bit = np.where(known, np.int64(1) << (np.array(colours.fill_null(0).to_pylist(), np.int64) & 63), np.int64(0))
    return np.bitwise_or.reduceat(bit[owner], first), np.logical_or.reduceat(known[owner], first)


def _bucket_tally(kind: str, k: int, canonical_form: bool, keys: Sequence[str]):
    """What a bucket of packed super-k-mers gives: the tallies of its groups, for each combination of the keys."""

    def tally(bucket):
        import numpy as np
        import pyarrow as pa

        rows, of = _unpacked_pieces(bucket.column("size").to_pylist(), bucket.column("body").to_pylist()), _tallied(kind, k, canonical_form, keys)
        out = []
        for group in _by_sub(rows):
            code = np.zeros(group.num_rows, np.int64)
            for c in keys:
                values = group.column(c).combine_chunks()
                index = values.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
                code = np.unique(code * (int(index.max(initial=0)) + 1) + index, return_inverse=True)[1]
            order = np.argsort(code, kind="stable")
            edges = np.flatnonzero(np.diff(code[order], prepend=-1, append=-1))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                out.append(of(group.take(pa.array(order[a:b])) if keys else group))
        return pa.concat_tables(out).combine_chunks()

    return tally


def _near(seqs: DataFrame, k: int, kind: str, keys: Sequence[str], groups: int, subs: int, full: Sequence[int], **form) -> DataFrame:
    """The tallies of all groups that are not full."""
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in seqs.schema.fields if f.name in keys)
    kinds += {"n": "kmer string, n long", "mask": "kmer string, mask long", "masks": "mask long, n long"}[kind]
    packed = _packed_pieces(seqs, k, groups, full, subs, **form)
    return packed.groupBy("bucket").applyInArrow(_bucket_tally(kind, k, form.get("canonical_form", False), keys), kinds)


def _per_kmer(seqs: DataFrame, k: int, kind: str, result: Column, keys: Sequence[str], m: int | None, canonical_form: bool, alphabet: str | None) -> DataFrame:
    """Rows (keys, kmer, result) of all k-mers: group by group of places, and those of full groups by their own shuffle."""
    form = {"m": m, "canonical_form": canonical_form, "alphabet": alphabet}
    groups, subs, full, _ = _dealing(seqs.select("seq"), k, **form)
    near = _near(seqs, k, kind, keys, groups, subs, full, **form)
    if not full:
        return near
    packed = can_pack(k, alphabet)
    far = _crowded(seqs, k, groups, full, keys, result, **form, packed=packed).drop("bucket")
    return near.unionByName(_unpacked(far, k) if packed else far)


def _short_counts(seqs: DataFrame, k: int, canonical_form: bool, alphabet: str | None) -> DataFrame:
    """Occurrences of short k-mers, counted in each batch of texts and then summed."""

    def count(batches):
        import re

        import pyarrow as pa

        tally = _tallied("n", k, canonical_form)
        wanted = re.compile(f"[{alphabet}]{{{k},}}") if alphabet else None

        def counted(texts):
            return tally(pa.table({"piece": pa.array(texts, pa.string())})).combine_chunks().to_batches()

        for batch in batches:
            held, size = [], 0
            for text in batch.column("seq").to_pylist():
                held += wanted.findall(text or "") if wanted else [text or ""]
                size += len(text or "")
                if size > 1 << 20:
                    yield from counted(held)
                    held, size = [], 0
            yield from counted(held)

    tasks = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = sequence_chunks(seqs.select("seq"), overlap=k - 1).select("seq").repartition(tasks, F.xxhash64("seq"))
    return chunks.mapInArrow(count, "kmer string, n long").groupBy("kmer").agg(F.sum("n").alias("n"))


def _by_bucket(pieces: DataFrame, full: DataFrame, k: int, keys: Sequence[str], aggregate: Column, canonical_form: bool, packed: bool) -> tuple[DataFrame, DataFrame]:
    """Rows (keys, bucket, kmer, result) of k-mers aggregated in the places of their minimizers, and those of full minimizers by their own shuffle."""
    keys, full = [*keys, "bucket", "kmer"], F.broadcast(full)  # at most 4 rows for each task
    spread = pieces.join(full, "bucket", "left_anti").repartition("bucket")
    return tuple(_listed(p, k, canonical_form, packed).groupBy(*keys).agg(aggregate) for p in (spread, pieces.join(full, "bucket", "left_semi")))


def kmer_count(seqs: DataFrame, k: int, by: Sequence[str] = (), canonical_form: bool = False, alphabet: str | None = None, m: int | None = None) -> DataFrame:
    """Occurrences per k-mer, per set when ``by`` names one."""
    if k < SHORT and not by:
        return _short_counts(seqs, k, canonical_form, alphabet)
    return _per_kmer(seqs.select(*by, "seq"), k, "n", F.count(F.lit(1)).alias("n"), by, m, canonical_form, alphabet)


def kmer_union_sum(*counts: DataFrame) -> DataFrame:
    """Sum of the counts of several sets."""
    return union_all([c.select("kmer", "n") for c in counts]).groupBy("kmer").agg(F.sum("n").alias("n"))


def _mask(colour: str) -> Column:
    return F.bit_or(F.expr(f"shiftleft(cast(1 as bigint), cast({colour} as int))")).alias("mask")


def kmer_masks(seqs: DataFrame, k: int, colour: str = "colour", canonical_form: bool = False, alphabet: str | None = None, m: int | None = None) -> DataFrame:
    """Bit mask of the colours each k-mer occurs in."""
    return _per_kmer(_coloured(seqs, colour), k, "mask", _mask("colour"), [], m, canonical_form, alphabet)


def _coloured(seqs: DataFrame, colour: str) -> DataFrame:
    return seqs.select(F.col(colour).cast("int").alias("colour"), "seq")


def combination_name(mask: Column, n_colours: int) -> Column:
    """``0-2-3`` for the mask with bits 0, 2 and 3."""
    bits = [F.when(F.shiftright(mask, c).bitwiseAND(F.lit(1)) == 1, F.lit(str(c))) for c in range(n_colours)]
    return F.array_join(F.array(*bits), "-")


def kmer_colours(
    seqs: DataFrame, k: int, n_colours: int = 6, colour: str = "colour", canonical_form: bool = False, alphabet: str | None = None, m: int | None = None
) -> DataFrame:
    """Number of distinct k-mers per colour combination; a group of places counts its own."""
    form = {"m": m, "canonical_form": canonical_form, "alphabet": alphabet}
    seqs = _coloured(seqs, colour)
    groups, subs, full, _ = _dealing(seqs.select("seq"), k, **form)
    masks = _near(seqs, k, "masks", [], groups, subs, full, **form)
    if full:
        far = _crowded(seqs, k, groups, full, [], _mask("colour"), **form, packed=can_pack(k, alphabet))
        masks = masks.unionByName(far.groupBy("mask").agg(F.count(F.lit(1)).alias("n")))
    masks = masks.groupBy("mask").agg(F.sum("n").alias("n"))
    return masks.select(combination_name(F.col("mask"), n_colours).alias("combination"), "n")


def fold_colours(counts: DataFrame) -> DataFrame:
    """Colour combinations folded to named classes; sets with the mitochondrial colour are dropped."""
    name = F.lit(OTHER_CLASS)
    for label, sets in COLOUR_CLASSES.items():
        name = F.when(F.col("combination").isin(*sets), label).otherwise(name)
    kept = counts.where(~F.col("combination").contains(str(COLOURS["chrM"])))
    return kept.groupBy(name.alias("kmer_class")).agg(F.sum("n").alias("n"))


def _asked_masks(k: int, ident: str):
    """Per bucket the k-mers of each region by the colours of the same k-mers on the other side."""

    def count(bucket):
        import numpy as np
        import pyarrow as pa

        rows = _unpacked_pieces(bucket.column("size").to_pylist(), bucket.column("body").to_pylist())
        asks = np.repeat(np.array(bucket.column("asks").to_pylist(), bool), bucket.column("rows").to_pylist())
        rows = rows.append_column("asks", pa.array(asks))
        if not asks.any():
            return pa.table({ident: rows.column(ident).slice(0, 0), "mask": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        named = rows.column(ident).combine_chunks().dictionary_encode()
        named = named.chunk(0) if isinstance(named, pa.ChunkedArray) else named
        rows = rows.append_column("named", named.indices.fill_null(len(named.dictionary)))
        found = {}
        for group in _by_sub(rows.select(["sub", "asks", "named", "colour", "piece"])):
            asks, names = group.column("asks").to_numpy(), group.column("named").to_numpy().astype(np.int64)
            if not asks.any():
                continue
            owner, first, _ = _told_apart(group.column("piece").to_pylist(), k)
            if not len(owner):
                continue
            mask = np.repeat(_bits(group.column("colour"), owner, first)[0], np.diff(np.append(first, len(owner))))
            asks = asks[owner]
            kinds, which = np.unique(mask[asks], return_inverse=True)
            pairs, n = np.unique(names[owner[asks]] * len(kinds) + which, return_counts=True)
            place, which = np.divmod(pairs, len(kinds))
            for kind in np.unique(which).tolist():
                found.setdefault(int(kinds[kind]), []).append((place[which == kind], n[which == kind]))
        out = []
        for mask, parts in found.items():
            place, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([n for _, n in parts])).astype(np.int64)
            out.append(pa.table({ident: named.dictionary.take(pa.array(place, mask=place == len(named.dictionary))), "mask": pa.array(np.full(len(place), mask, np.int64)), "n": pa.array(n)}))
        return pa.concat_tables(out) if out else pa.table({ident: rows.column(ident).slice(0, 0), "mask": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})

    return count


def kmer_query(regions: DataFrame, seqs: DataFrame, k: int, ratio: float, colours: dict[str, int], ident: str = "name", colour: str = "colour") -> DataFrame:
    """Per region, whether at least ``ratio`` of its k-mers occur in each colour of ``seqs``.

    Super-k-mers of both sides meet in groups of places of about GROUP k-mers, which give the number of k-mers of each
    region and colour set. They travel packed and are not stored: a first pass counts what each group holds, and k-mers of groups
    with more than FULL are joined by a shuffle of their own, which Spark can split. With much text the buckets take turns, in
    rounds: each cuts the texts anew, stores the sums of the regions and leaves no shuffle to the next.
    """
    kind = regions.schema[ident].dataType.simpleString()
    asked, known = regions.select(ident, "seq"), seqs.select(F.col(colour).cast("int").alias("colour"), "seq")
    groups, subs, full, size = _dealing(asked.select("seq").unionByName(known.select("seq")), k)
    sides = {True: asked.withColumn("colour", F.lit(None).cast("int")), False: known.withColumn(ident, F.lit(None).cast(kind))}
    rounds = max(1, min(ROUNDS, size // ROUND))
    has = lambda c: F.sum(F.when(F.shiftright(F.col("mask"), c).bitwiseAND(F.lit(1)) == 1, F.col("n")).otherwise(0))
    places = sorted(set(colours.values()))
    summed = lambda hits: hits.groupBy(ident).agg(F.sum("n").alias("n"), *[has(c).alias(f"_{c}") for c in places])
    sums = []
    for turn in range(rounds):
        both = [_packed_pieces(side.select(ident, "colour", "seq"), k, groups, full, subs, rounds, turn).withColumn("asks", F.lit(asks)) for asks, side in sides.items()]
        hits = summed(union_all(both).groupBy("bucket").applyInArrow(_asked_masks(k, ident), f"`{ident}` {kind}, mask long, n long"))
        sums.append(written_once(hits) if rounds > 1 else hits)
    if full:
        near, far = (_crowded(p, k, groups, full, keys, agg) for p, keys, agg in ((asked, [ident], F.count(F.lit(1)).alias("n")), (known, [], _mask("colour"))))
        sums.append(summed(written_once(near).join(far, ["bucket", "kmer"], "left").select(ident, "mask", "n")))
    every = union_all(sums)
    found = every.groupBy(ident).agg(F.sum("n").alias("n"), *[F.sum(f"_{c}").alias(f"_{c}") for c in places]) if len(sums) > 1 else every
    found = found.select(ident, *[(F.col(f"_{c}") / F.col("n") >= ratio).alias(name) for name, c in colours.items()])
    out = regions.select(ident).join(found, ident, "left")
    return out.fillna(False, list(colours))


QUERY_NAME = r"^([A-Z]+)_(ENSR[0-9]+)::([A-Za-z0-9_]+):([0-9]+)-([0-9]+)"


def parse_query_regions(df: DataFrame) -> DataFrame:
    """Split ``TYPE_ENSR…::chr:a-b`` in ``query``; a malformed name is an error."""
    part = lambda i: F.regexp_extract("query", QUERY_NAME, i)
    ok = F.when(F.col("query").rlike(QUERY_NAME), part(1)).otherwise(F.raise_error(F.concat(F.lit("malformed region "), F.col("query"))))
    out = df.select(
        "*", ok.alias("region_type"), part(2).alias("region_id"), part(3).alias("chrom"),
        part(4).try_cast("long").alias("start_pos"), part(5).try_cast("long").alias("end_pos"),
    )
    return out.withColumn("name", F.concat_ws("_", "region_type", "region_id"))


# Selectors over the colour flags of one region.
_SHORT = "(short_1 OR short_2)"
REGION_SELECTORS = {
    "RefOnly": f"GRCh38 AND NOT ({_SHORT} OR hap1 OR hap2)",
    "NonIllumina": f"NOT {_SHORT}",
    "Hap1": "hap1 AND NOT hap2",
    "Hap2": "hap2 AND NOT hap1",
    "HapBoth": "hap1 AND hap2",
}


def usable_regions(df: DataFrame) -> DataFrame:
    """Parsed regions on the reference and off the mitochondrion."""
    return parse_query_regions(df).where("GRCh38 AND NOT chrM")


def selected_regions(df: DataFrame, selector: str) -> DataFrame:
    return usable_regions(df).where(REGION_SELECTORS[selector])


def kmer_region_stats(df: DataFrame) -> DataFrame:
    """Per region type and in total (``total``): bases and count of all kept regions and of every selector, with percentages."""
    rows = usable_regions(df).withColumn("length", F.col("end_pos") - F.col("start_pos"))
    tests = {"total": "true", **REGION_SELECTORS}
    aggs = []
    for label, test in tests.items():
        hit = F.expr(test)
        aggs += [
            F.coalesce(F.sum(F.when(hit, F.col("length"))), F.lit(0)).alias(f"{label}_bp"),
            F.coalesce(F.sum(F.when(hit, 1)), F.lit(0)).alias(f"{label}_count"),
        ]
    sums = rows.rollup("region_type").agg(*aggs)
    pct = [
        F.bround(F.try_divide(f"{label}_{unit}", f"total_{unit}") * 100, 2).alias(f"{label}_{unit}_pct")
        for label in REGION_SELECTORS for unit in ("bp", "count")
    ]
    return sums.select(F.coalesce("region_type", F.lit("total")).alias("region_type"), *sums.columns[1:], *pct)


def kmer_drop_counts(df: DataFrame) -> DataFrame:
    """Regions read, dropped for the mitochondrion, and missing from the reference."""
    n = lambda test: F.coalesce(F.sum(F.expr(f"int({test})")), F.lit(0)).cast("long")
    return df.agg(F.count(F.lit(1)).alias("raw_regions"), n("chrM").alias("drop_chrM"), n("NOT GRCh38").alias("drop_ref_missing"))


def attach_sequences(df: DataFrame, seqs: DataFrame) -> DataFrame:
    """Reference sequence of every hit, NULL where there is none."""
    return df.join(seqs, ["region_type", "region_id", "chrom", "start_pos", "end_pos"], "left")


def kmer_qv(classes: DataFrame, hap: int, by: Sequence[str] = (), k: int = 31) -> DataFrame:
    """Error rate and quality value from the k-mers found in the assembly only."""
    only = [f"Hap{hap}_only", "Hap_only"]
    rest = ["Illumina_only", f"Hap{hap}_Illumina", "Hap_Illumina", f"Hap{hap}_GRCh38", "Hap_GRCh38", "GRCh38_Illumina", OTHER_CLASS]
    n = lambda names: F.coalesce(F.sum(F.when(F.col("kmer_class").isin(*names), F.col("n"))), F.lit(0))
    sums = classes.groupBy(*by).agg(n(only).alias("assembly_only"), n(only + rest).alias("total"))
    error = 1 - F.pow(1 - F.try_divide("assembly_only", "total"), F.lit(1.0 / k))
    return sums.withColumn("error_rate", error).withColumn("qv", -10 * F.log10("error_rate"))

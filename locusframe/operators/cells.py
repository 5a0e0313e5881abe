"""Sweeps of whole numbers in cells of a coordinate block, over rows that travel packed.

An event (keys, pos, measures) goes to the cell of its keys and its block of positions. Before the
shuffle the events of about a million rows are summed per position and packed: one compressed body
for each bucket of cells, positions as differences. Cells of one place (the chromosome, where there is one) and
block share a bucket, so copies of a row for many keys lie side by side and cost next to nothing. What
came before a block reaches its cell as one more event, ahead of the others.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: Rows that are packed together.
ROWS = 1 << 20
#: Buckets that cells are dealt to, and at least so many for each shuffle partition.
BUCKETS, PER_TASK = 512, 4
EVENTS, WHOLE, HALF = 0, 1, 2
PACKED = "bucket int, kind int, size long, body binary"


def _buckets(df: DataFrame) -> int:
    return max(BUCKETS, PER_TASK * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _placed(by: Sequence[str]) -> Column:
    return F.xxhash64(*(["chrom"] if "chrom" in by else by)).alias("_place")


def _bucket(place: np.ndarray, block: np.ndarray, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = place.astype(np.uint64) + block.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ (h >> np.uint64(29))) % np.uint64(buckets)).astype(np.int64)


def carries(rows: DataFrame, by: Sequence[str], measures: Sequence[str], block: int, moments: bool, asked: DataFrame | None = None) -> DataFrame:
    """Rows (keys, _block, measures): for cells of the ends of ``rows`` and of ``asked`` (keys, _block), the sums of all events before the block.

    With ``moments`` also the sums of position times measure, as ``_m_<measure>``.
    """
    zero = F.lit(0).cast("long")
    point = lambda c, sign: F.struct(F.col(c).cast("long").alias("pos"), *[(sign * F.col(m)).cast("long").alias(m) for m in measures])
    ends = rows.select(*by, F.explode(F.array(point("_s", 1), point("_e", -1))).alias("_p")).select(*by, "_p.*").where("pos is not null")
    of = [f"_m_{m}" for m in measures] if moments else []
    ends = ends.select(*by, F.floor(F.col("pos") / F.lit(block)).cast("long").alias("_block"), *measures, *[(F.col(m) * F.col("pos")).alias(f"_m_{m}") for m in measures if moments])
    if asked is not None:
        ends = ends.unionByName(asked.select(*by, "_block", *[zero.alias(m) for m in [*measures, *of]]))
    before = W.partitionBy(*by).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    sums = ends.groupBy(*by, "_block").agg(*[F.sum(m).alias(m) for m in [*measures, *of]])
    sums = sums.select(*by, "_block", *[F.sum(m).over(before).alias(m) for m in [*measures, *of]])
    return sums.where(reduce(Column.__or__, [F.col(m) != 0 for m in [*measures, *of]]))


def _dense(code: np.ndarray, most: int) -> np.ndarray:
    """The ranks of some numbers from 0 to ``most``."""
    if most > 8 * len(code) + 1024:
        return np.unique(code, return_inverse=True)[1]
    there = np.zeros(most + 1, np.int64)
    there[code] = 1
    return (np.cumsum(there) - 1)[code]


def _codes(tables: Sequence[pa.Table], columns: Sequence[str]) -> list[np.ndarray]:
    """Numbers of the combinations of values in ``columns``, the same in all tables; nulls are a value."""
    sizes = [t.num_rows for t in tables]
    code = np.zeros(sum(sizes), np.int64)
    for c in columns:
        values = pa.chunked_array([x for t in tables for x in t.column(c).chunks], tables[0].schema.field(c).type).combine_chunks()
        if isinstance(values, pa.ChunkedArray):
            values = pa.concat_arrays(values.chunks)
        index = values.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
        wide = int(index.max(initial=0)) + 1
        code = _dense(code * wide + index, (int(code.max(initial=0)) + 1) * wide - 1)
    return np.split(code, np.cumsum(sizes)[:-1])


def _body(table: pa.Table) -> tuple[int, bytes]:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    raw = sink.getvalue()
    return raw.size, pa.Codec("zstd").compress(raw, asbytes=True)


def _opened(size: int, body: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.Codec("zstd").decompress(body, size)).read_all()


def _bodies(bucket: np.ndarray, table: pa.Table, kind: int) -> pa.RecordBatch:
    """One packed row for each bucket of a table whose rows are in order of their buckets."""
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    found = [_body(table.slice(a, b - a)) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
    n = len(found)
    return pa.record_batch(
        [pa.array(bucket[edges[:-1]].astype(np.int32)), pa.array(np.full(n, kind, np.int32)), pa.array([s for s, _ in found], pa.int64()), pa.array([b for _, b in found], pa.binary())],
        names=["bucket", "kind", "size", "body"],
    )


def _in_bulk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= ROWS:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _summed(key: np.ndarray, values: Sequence[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys in order and the sums of the values of each."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=key[0] - 1 if len(key) else 0))
    return key[first], [np.add.reduceat(v[order], first) if len(first) else v for v in values]


def _packed_cells(table: pa.Table, row: np.ndarray, block_no: np.ndarray, off: np.ndarray, values: dict[str, np.ndarray], by: Sequence[str], block: int, buckets: int) -> pa.RecordBatch:
    """Events of the keys in some rows of a table, summed and packed: a row of a body is a cell with lists of its positions and measures."""
    wide = block + 1
    (code,) = _codes([table], by)
    low = int(block_no.min())
    span = int(block_no.max()) - low + 1
    cell = _dense(code[row] * span + block_no - low, (int(code.max()) + 1) * span - 1)
    at = np.zeros(int(cell.max()) + 1, np.int64)
    at[cell] = np.arange(len(cell))  # some event of each cell
    bucket = _bucket(table.column("_place").to_numpy()[row[at]], block_no[at], buckets)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    key, sums = _summed(rank[cell] * wide + off + 1, list(values.values()))
    held, place = np.divmod(key, wide)
    first = np.flatnonzero(np.diff(held, prepend=-1))
    step = np.diff(place, prepend=0)
    step[first] = place[first]
    edges, at = pa.array(np.append(first, len(held)).astype(np.int32)), at[order]
    lists = {c: pa.ListArray.from_arrays(edges, pa.array(v)) for c, v in [("_off", step.astype(np.int32)), *zip(values, sums)]}
    rows = pa.table({**{c: table.column(c).take(pa.array(row[at])) for c in by}, "_block": pa.array(block_no[at]), **lists})
    return _bodies(bucket[order], rows, EVENTS)


def packed_events(rows: DataFrame, carry: DataFrame, by: Sequence[str], measures: Sequence[str], block: int) -> DataFrame:
    """Both ends of ``rows`` (keys, _s, _e, measures) as events, +measure and -measure, and ahead of those of a cell its carry."""
    by, buckets, kept = list(by), _buckets(rows), [c for c in carry.columns if c not in by and c != "_block"]

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _in_bulk(batches):
            found = []
            for c, sign in (("_s", 1), ("_e", -1)):
                there = np.flatnonzero(table.column(c).is_valid().to_numpy())
                found.append((there, table.column(c).fill_null(0).to_numpy()[there], *[sign * table.column(m).to_numpy()[there] for m in measures]))
            row, pos, *values = (np.concatenate(x) for x in zip(*found))
            if len(row):
                number = pos // block
                moments = {c: np.zeros(len(row), np.int64) for c in kept if c not in measures}
                yield _packed_cells(table, row, number, pos - number * block, dict(zip(measures, values)) | moments, by, block, buckets)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _in_bulk(batches):
            row = np.arange(table.num_rows)
            yield _packed_cells(table, row, table.column("_block").to_numpy(), np.full(len(row), -1), {c: table.column(c).to_numpy() for c in kept}, by, block, buckets)

    events = rows.select(*by, "_s", "_e", *measures, _placed(by)).mapInArrow(ends, PACKED)
    return events.unionByName(carry.select(*by, "_block", *kept, _placed(by)).mapInArrow(sums, PACKED))


def packed_rows(df: DataFrame, by: Sequence[str], kind: int) -> DataFrame:
    """Rows with a ``_block``, packed as they are."""
    buckets = _buckets(df)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _in_bulk(batches):
            bucket = _bucket(table.column("_place").to_numpy(), table.column("_block").to_numpy(), buckets)
            order = np.argsort(bucket, kind="stable")
            yield _bodies(bucket[order], table.drop_columns(["_place"]).combine_chunks().take(pa.array(order)), kind)

    return df.select("*", _placed(by)).mapInArrow(pack, PACKED)


def dealt(packed: DataFrame) -> DataFrame:
    """Packed rows in the tasks of their buckets; the number is stated, as their few bytes would ask for few tasks."""
    return packed.repartition(int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions")), "bucket")


class Cells:
    """The cells of a bucket: running sums of the measures at any position of any cell."""

    def __init__(self, bodies: Sequence[tuple[int, bytes]], by: Sequence[str], measures: Sequence[str], block: int, moments: bool = False):
        self.columns, self.wide = [*by, "_block"], block + 1
        tables = [_opened(*b) for b in bodies]
        self.named = pa.concat_tables([t.select(self.columns) for t in tables]).combine_chunks() if tables else None
        keys, values = [], [[] for _ in measures]
        codes = _codes(tables, self.columns) if tables else []
        for code, t in zip(codes, tables):
            many = t.column("_off").combine_chunks()
            many = pa.concat_arrays(many.chunks) if isinstance(many, pa.ChunkedArray) else many
            n = np.diff(many.offsets.to_numpy())
            off = np.cumsum(many.values.to_numpy().astype(np.int64))
            off -= np.repeat(off[np.cumsum(n) - n] - many.values.to_numpy()[np.cumsum(n) - n], n)
            keys.append(np.repeat(code, n) * self.wide + off)
            for held, m in zip(values, measures):
                listed = t.column(m).combine_chunks()
                listed = pa.concat_arrays(listed.chunks) if isinstance(listed, pa.ChunkedArray) else listed
                held.append(listed.values.to_numpy())
        whole = lambda xs: np.concatenate(xs) if xs else np.zeros(0, np.int64)
        self.keys, self.sums = _summed(whole(keys), [whole(v) for v in values])
        self.measures = list(measures)
        if moments:
            cell, off = np.divmod(self.keys, self.wide)
            (code,) = _codes([self.named], self.columns) if tables else (np.zeros(0, np.int64),)
            number = np.zeros(int(code.max(initial=0)) + 1, np.int64)
            number[code] = self.named.column("_block").to_numpy() if tables else 0
            pos = np.where(off > 0, number[cell] * block + off - 1, 0)
            half = len(measures) // 2
            self.sums[half:] = [m + s * pos for m, s in zip(self.sums[half:], self.sums[:half])]
        self.upto = [np.concatenate([[0], np.cumsum(v)]) for v in self.sums]

    def codes(self, rows: pa.Table) -> np.ndarray:
        """The numbers of the cells of some rows; those of cells without events are new."""
        if self.named is None:
            return np.zeros(rows.num_rows, np.int64)
        mine, theirs = _codes([self.named, rows.select(self.columns)], self.columns)
        # numbers of the cells as they were given first, others beyond
        (own,) = _codes([self.named], self.columns)
        number = np.full(int(max(mine.max(initial=0), theirs.max(initial=0))) + 1, int(own.max(initial=0)) + 1, np.int64)
        number[mine] = own
        return number[theirs]

    def at(self, code: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        """Sums of the measures up to and including each place."""
        last = np.searchsorted(self.keys, code * self.wide + off + 1, side="right")
        first = np.searchsorted(self.keys, code * self.wide, side="left")
        return [c[last] - c[first] for c in self.upto]


def _parted(batches: Iterator[pa.RecordBatch], kind: int) -> tuple[list, list]:
    """The bodies of events and of rows of one kind."""
    found: dict[int, list] = {EVENTS: [], kind: []}
    for batch in batches:
        for k, size, body in zip(batch.column("kind").to_pylist(), batch.column("size").to_pylist(), batch.column("body").to_pylist()):
            if k in found:
                found[k].append((size, body))
    return found[EVENTS], found[kind]


def kinds_of(df: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def runs(rows: DataFrame, by: Sequence[str], block: int) -> DataFrame:
    """Rows (keys, pos, next_pos, depth) of the stretches where the summed ``step`` of the intervals (_s, _e) stays the same and is not 0."""
    by = list(by)

    def of(edge: bool):
        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = Cells(_parted(batches, EVENTS)[0], by, ["step"], block)
            changes = (cells.sums[0] != 0) & (cells.keys % cells.wide > 0)
            key = cells.keys[changes]
            depth = cells.at(*_place(key, cells.wide))[0]
            cell, off = np.divmod(key, cells.wide)
            (code,) = _codes([cells.named], cells.columns)
            named = np.zeros(int(code.max(initial=0)) + 1, np.int64)
            named[code] = np.arange(len(code))
            pos = cells.named.column("_block").to_numpy()[named[cell]] * block + off - 1
            new = np.diff(cell, prepend=-1) != 0
            last = np.append(new[1:], True)[: len(cell)]
            # the last stretch of a cell ends in another: it goes with the first position of its own
            keep = last if edge else ~last & (depth != 0)
            following = pos[new][np.cumsum(new) - 1] if edge else np.append(pos[1:], 0)[: len(cell)]
            at = pa.array(named[cell[keep]])
            yield pa.record_batch([*[cells.named.column(c).take(at).combine_chunks() for c in by], *(pa.array(x[keep]) for x in (pos, following, depth))], names=[*by, "pos", "next_pos", "depth"])

        return cut

    known = rows.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in [*by, "step"]]))
    packed = dealt(packed_events(known, carries(known, by, ["step"], block, False), by, ["step"], block))
    kinds = f"{kinds_of(rows, by)}, pos long, next_pos long, depth long"
    inner, edges = (packed.groupBy("bucket").applyInArrow(of(edge), kinds) for edge in (False, True))
    edges = edges.withColumn("next_pos", F.lead("next_pos").over(W.partitionBy(*by).orderBy("pos"))).where("depth <> 0")
    return inner.unionByName(edges)


def _place(key: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
    code, off = np.divmod(key, wide)
    return code, off - 1


def areas_between(a: DataFrame, track: DataFrame, by: Sequence[str], measures: Sequence[str], start: str, end: str, block: int) -> DataFrame:
    """Rows of ``a`` with the integral of each measure of the intervals (_s, _e) of ``track`` between both ends, 0 where a key is NULL.

    Rows of ``a`` travel once, with both ends if one block holds them; the others go as two halves that are added.
    """
    by, names = list(by), list(measures)
    every = [*names, *[f"_m_{n}" for n in names]]
    track = track.withColumns({c: F.col(c).cast(a.schema[c].dataType) for c in by}).where(reduce(Column.__and__, [F.col(c).isNotNull() for c in [*by, *names]]))
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in [*by, start, end]])
    at = lambda c: F.floor(F.col(c) / F.lit(block)).cast("long")
    rows, none = a.where(known), F.lit(None).cast("long")
    whole = rows.where(at(start) == at(end)).select("*", at(start).alias("_block"), F.col(start).cast("long").alias("_s"), F.col(end).cast("long").alias("_e"))
    ends = F.array(F.struct(at(start).alias("_block"), F.col(start).cast("long").alias("_s"), none.alias("_e")), F.struct(at(end).alias("_block"), none.alias("_s"), F.col(end).cast("long").alias("_e")))
    halves = rows.where(at(start) != at(end)).select("*", F.explode(ends).alias("_h")).select(*a.columns, "_h.*")
    asked = rows.select(*by, F.explode(F.array_distinct(F.array(at(start), at(end)))).alias("_block"))
    events = packed_events(track, carries(track, by, names, block, True, asked), by, names, block)
    packed = dealt(reduce(DataFrame.unionByName, [events, packed_rows(whole, by, WHOLE), packed_rows(halves, by, HALF)]))
    a_columns = a.columns

    def of(kind: int):
        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            events, asked = _parted(batches, kind)
            cells = Cells(events, by, every, block, moments=True) if asked else None
            for body in asked:
                rows = _opened(*body)
                code, first = cells.codes(rows), rows.column("_block").to_numpy() * block
                total = {n: np.zeros(rows.num_rows, np.int64) for n in names}
                for c, sign in (("_e", 1), ("_s", -1)):
                    there = rows.column(c).is_valid().to_numpy()
                    x = rows.column(c).fill_null(0).to_numpy()[there]
                    sums = dict(zip(every, cells.at(code[there], x - first[there])))
                    for n in names:
                        total[n][there] += sign * (x * sums[n] - sums[f"_m_{n}"])
                out = [*[rows.column(c) for c in a_columns], *(pa.array(total[n]) for n in names)]
                yield from pa.table(out, names=[*a_columns, *names]).combine_chunks().to_batches(max_chunksize=1 << 16)

        return measure

    kinds = f"{kinds_of(a, a.columns)}, {', '.join(f'`{n}` long' for n in names)}"
    near, far = (packed.groupBy("bucket").applyInArrow(of(kind), kinds) for kind in (WHOLE, HALF))
    # equal rows have equal halves, so each of n is the nth part of the sum
    far = far.groupBy(*a.columns).agg(*[F.sum(n).alias(n) for n in names], (F.count(F.lit(1)) / 2).cast("int").alias("_n"))
    far = far.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_n"))).select(*a.columns, *[F.expr(f"`{n}` div _n").alias(n) for n in names])
    odd = a.where(~known).select("*", *[((F.col(end) - F.col(start)) * 0).cast("long").alias(n) for n in names])
    return reduce(DataFrame.unionByName, [near, far, odd])

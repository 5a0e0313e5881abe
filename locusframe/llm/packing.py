"""Best-two-fit packing of token pieces into sequences.

Which lengths share a sequence depends on how many pieces of each length there
are, so the plan is made from a histogram of at most `size` rows: fill a sequence
greedily from the longest length that fits, then replace its smallest piece by two
unpacked ones that fit the wider gap more tightly. A sequence made this way is
repeated while its lengths last. Pieces find their place by their rank among the
pieces of their length, which Spark computes in buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..operators.lineage import written_once
from . import common, tokens

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Rows in a bucket of the ranking.
BUCKET_ROWS = 4096


def two_fit_plan(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, last rank + 1, sequence of the first rank, offset) that hold every piece.

    Ties between equally tight pairs go to the pair with the longest piece. Each
    turn uses up at least one length as far as its pattern can, so the number of
    turns depends on the lengths, not on the number of pieces.
    """
    import numpy as np

    left = np.zeros(size + 1, dtype=np.int64)
    for length, n in histogram.items():
        left[length] = n
    used, slots, sequence = np.zeros(size + 1, dtype=np.int64), [], 0
    index = np.arange(size + 1)
    while left.any():
        held, room, have = [], size, left.copy()
        while room:
            fits = np.flatnonzero(have[: room + 1])
            if not len(fits):
                break
            length = int(fits[-1])
            n = min(room // length, int(have[length]))
            held += [length] * n
            have[length] -= n
            room -= length * n
        needed = np.bincount(held, minlength=size + 1)
        if room and len(held) > 1:
            smallest = held[-1]
            gap = room + smallest
            longest = np.maximum.accumulate(np.where(have > 0, index, 0))  # longest piece left of at most this length
            first = np.flatnonzero(have[:gap])
            second = np.where(gap - first >= first, longest[np.minimum(gap - first, first)], longest[gap - first])
            # a length takes both places only where two pieces of it are left
            alone = (second == first) & (have[first] < 2)
            second = np.where(alone, longest[np.maximum(first - 1, 0)], second)
            total = np.where(second > 0, first + second, 0)
            if len(total) and total.max() > smallest:
                best = int(np.flatnonzero(total == total.max())[-1])
                pair = [int(first[best]), int(second[best])]
                needed = np.maximum(needed, needed + np.bincount(pair, minlength=size + 1))
                held = held[:-1] + sorted(pair, reverse=True)
        times = max(1, int((left[needed > 0] // needed[needed > 0]).min()))
        offset = 0
        for length in held:
            slots.append((length, int(used[length]), int(used[length]) + times, sequence, offset))
            used[length] += times
            left[length] -= times
            offset += length
        sequence += times
    return slots


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32). Only documents over `size` are cut; their first piece takes the rest."""
    common.ship(docs.sparkSession)

    def cut(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        t, end = tokens.pieces(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for a, b in common.slices(batch.column("text")):
                part = batch.slice(a, b - a)
                rows = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = t.ids(text) + end
                    stop = (len(ids) >> 2) % size or size
                    begin, k = 0, 0
                    while begin < len(ids) >> 2:
                        stop = min(stop, len(ids) >> 2)
                        rows.append((doc_id, k, begin, stop - begin, zlib.crc32(ids[4 * begin : 4 * stop])))
                        begin, stop, k = stop, stop + size, k + 1
                t.memory.trim()
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return common.texts(docs, id_col, text_col).mapInArrow(cut, PIECE_SCHEMA)


def pack(pieces: DataFrame, size: int = 1024) -> DataFrame:
    """The pieces with sequence_id and offset: gapless in each sequence, at most `size` tokens together.

    pieces has PIECE_SCHEMA, lengths from 1 to size. Repeated rows are pieces of
    their own. An empty table gives an empty table.
    """
    spark = pieces.sparkSession
    held = written_once(pieces.withColumn("_row", F.monotonically_increasing_id()))
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    slots = spark.sparkContext.broadcast(sorted(two_fit_plan(counts, size)))  # by lengths only, not by pieces
    buckets = 1 + sum(counts.values()) // BUCKET_ROWS
    keyed = held.withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)))
    inner = Window.partitionBy("length", "_bucket").orderBy("_row")
    ranked = keyed.withColumn("_rank", F.row_number().over(inner))
    outer = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = keyed.groupBy("length", "_bucket").agg(F.count("*").alias("_n")).select("length", "_bucket", F.coalesce(F.sum("_n").over(outer), F.lit(0)).alias("_before"))
    ranked = ranked.join(before, ["length", "_bucket"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("_rank") - 1).alias("rank"))

    def place(batches):
        import numpy as np
        import pyarrow as pa

        table = np.array(slots.value, dtype=np.int64).reshape(-1, 5)
        width = np.int64(1 << 50)
        keys = table[:, 0] * width + table[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, length * width + rank, side="right") - 1
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.record_batch([*columns, pa.array(table[at, 3] + rank - table[at, 1]), pa.array(table[at, 4])], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, PIECE_SCHEMA + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, size: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize, cut and pack: rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    Null and empty texts are one piece, the end id. A null id stays null, and
    rows that repeat are packed each. Columns besides id and text are left out.
    """
    return pack(cut_pieces(docs, tokenizer, end_id, size, id_col, text_col), size)

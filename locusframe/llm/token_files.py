"""Token ids as ORC files in document order.

The file format is ORC: ids and counts are integer run-length encoded columns,
stripes can be read in parallel, and row indexes and Bloom filters on the document
id let a reader skip stripes and row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from . import common, tokens

SCHEMA = "doc_id long, start_in_file long, n_ids long, ids array<int>"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, stripe_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write every document's ids and the end id, in ascending order of the document id over the files' numbers.

    Null ids come first; rows of one id are ordered by a hash of the text and the
    text. Null and empty texts have the end id alone. Each task writes one file, so
    a lost task is simply run again; an empty table writes no rows.
    """
    common.ship(docs.sparkSession)

    def encode(batches):
        import numpy as np
        import pyarrow as pa

        t, start = tokens.pieces(tokenizer), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for a, b in common.slices(batch.column("text")):
                part = batch.slice(a, b - a)
                ids = [t.ids(x) + end for x in part.column("text").to_pylist()]
                t.memory.trim()
                n = np.array([len(x) >> 2 for x in ids], dtype=np.int64)
                ends = np.cumsum(n)
                values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), values)
                yield pa.record_batch([part.column("doc_id"), pa.array(start + ends - n), pa.array(n), lists], names=["doc_id", "start_in_file", "n_ids", "ids"])
                start += int(ends[-1])

    plain = common.texts(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    ordered = plain.repartitionByRange(common.input_partitions(plain), "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    (
        ordered.select("doc_id", "text").mapInArrow(encode, SCHEMA).write.option("compression", "zstd").option("orc.stripe.size", stripe_bytes)
        .option("orc.create.index", "true").option("orc.row.index.stride", 1000).option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01).orc(path)
    )


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Rows (file, doc_id, start_in_file, n_ids, ids). With doc_ids, stripes and row groups without them are skipped."""
    df = spark.read.schema(SCHEMA).orc(path)
    if doc_ids is not None:
        df = df.where(F.col("doc_id").isin(doc_ids))
    return df.withColumn("file", F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long"))


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, before): ids in all files before it. One row for each file; only the counts are read."""
    totals = read_token_files(spark, path).groupBy("file").agg(F.sum("n_ids").alias("held"))
    return totals.select("file", (F.sum("held").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, 0)) - F.col("held")).alias("before"))


def token_file_digest(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) from the files: place in the whole sequence, count and checksum of the ids."""

    def digest(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            ids = batch.column("ids")
            at = ids.offsets.to_numpy()
            flat = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), dtype="<u4")
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.record_batch([batch.column("file"), batch.column("doc_id"), batch.column("start_in_file"), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())], names=["file", "doc_id", "start_in_file", "n_tokens", "ids_crc32"])

    rows = read_token_files(spark, path).select("file", "doc_id", "start_in_file", "ids")
    rows = rows.mapInArrow(digest, "file long, doc_id long, start_in_file long, n_tokens long, ids_crc32 long")
    return rows.join(file_starts(spark, path), "file").select("doc_id", (F.col("before") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32")

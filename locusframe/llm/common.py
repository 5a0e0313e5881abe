"""Helpers that the operators of this package share."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"
#: Bytes of text that a worker holds as Python objects at one time.
SLICE_BYTES = 2 << 20

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of a cluster, once a session; local workers have it already."""
    sc = spark.sparkContext
    if sc.master.startswith("local[") or sc.master == "local" or sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(top)
    path = os.path.join(tempfile.mkdtemp(prefix="code-"), f"{name}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    out.write(full, os.path.join(name, os.path.relpath(full, top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def input_partitions(df: DataFrame) -> int:
    """A number of tasks that follows the input: one for each scan task, or the session's setting if that is more."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())


def ascii_lower(c: Column) -> Column:
    """A-Z to lower case and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id long, text string); a null text is an empty one. Other columns, whatever their names, are left."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def whole_rows(df: DataFrame) -> DataFrame:
    """Every row as one struct, ``doc``, so that no name of its columns meets those an operator adds; doc.* gives them back."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc"))


def slices(column, most: int = SLICE_BYTES):
    """Ranges (start, stop) of an Arrow string column with at most so many bytes, or one row."""
    import pyarrow as pa
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0)
    sizes = (sizes.combine_chunks() if isinstance(sizes, pa.ChunkedArray) else sizes).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += int(n)
    if start < len(sizes):
        yield start, len(sizes)
    settle()


def settle() -> None:
    """Give the system back what a finished batch held; workers live on between tasks."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass

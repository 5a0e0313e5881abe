"""Writers for text genomics formats. Every writer makes a folder of part files, which the readers take as one path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _tsv(df: DataFrame):
    # a comment mark other than # keeps the writer from quoting a header that starts with it
    return df.write.option("sep", "\t").option("quote", "").option("escapeQuotes", False).option("emptyValue", "").option("comment", "\u0001").mode("errorifexists")


def write_bed(df: DataFrame, path: str, null: str = "") -> None:
    """Sorted intervals under a ``#`` header line per part file."""
    first = df.columns[0]
    _tsv(df.orderBy("chrom", "start_pos", "end_pos").withColumnRenamed(first, f"#{first}")).option("header", True).option("nullValue", null).csv(path)


def write_by_class(df: DataFrame, col: str, path: str) -> None:
    """One folder per class, and all rows in ``all``. Rows are dealt by class first, large classes over several files."""
    _tsv(df.withColumn("_class", F.col(col)).hint("rebalance", "_class")).option("header", True).partitionBy("_class").csv(f"{path}/by_class")
    _tsv(df).option("header", True).csv(f"{path}/all")


def wrap(seq: Column, width: int) -> Column:
    """Lines of ``width`` characters; a lost character is an error."""
    lines = F.regexp_replace(seq, f"(?s)(.{{{width}}})(?!$)", "$1\n")
    return F.when(F.length(F.replace(lines, F.lit("\n"), F.lit(""))) == F.length(F.replace(seq, F.lit("\n"), F.lit(""))), lines).otherwise(F.raise_error(F.lit("sequence lost while wrapping")))


def write_fasta(df: DataFrame, path: str, width: int = 120) -> None:
    df.select(F.concat(F.lit(">"), "name", F.lit("\n"), wrap(F.col("seq"), width)).alias("value")).write.mode("errorifexists").text(path)


def fastq_to_fasta(df: DataFrame, path: str) -> None:
    """Name and sequence, the sequence on one line."""
    df.select(F.concat(F.lit(">"), "name", F.lit("\n"), "seq").alias("value")).write.mode("errorifexists").text(path)


def write_fastq(df: DataFrame, path: str) -> None:
    df.select(F.concat_ws("\n", F.concat(F.lit("@"), "name"), "seq", F.lit("+"), "qual").alias("value")).write.mode("errorifexists").text(path)


def write_lines(df: DataFrame, path: str) -> None:
    """The ``value`` column as text lines."""
    df.select("value").write.mode("errorifexists").text(path)

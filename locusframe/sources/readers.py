"""Readers for text genomics formats; every reader takes a path, a list of paths or a glob."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BED_TYPES = {
    "chrom": "string", "start_pos": "bigint", "end_pos": "bigint", "name": "string", "score": "string", "mapq": "int", "strand": "string",
    "depth": "double", "contig": "string",
}
BED6 = ["chrom", "start_pos", "end_pos", "contig", "mapq", "strand"]


def _error(*parts) -> Column:
    return F.raise_error(F.concat(*[F.coalesce(p.cast("string"), F.lit("NULL")) if isinstance(p, Column) else F.lit(p) for p in parts]))


def _csv(spark: SparkSession, path, schema: str, comment: str | None = "#") -> DataFrame:
    reader = spark.read.schema(schema).option("sep", "\t").option("quote", "").option("mode", "FAILFAST")
    if comment:
        reader = reader.option("comment", comment)
    return reader.csv(path)


def read_bed(spark: SparkSession, path, columns: Sequence[str] = BED6, types: dict[str, str] | None = None) -> DataFrame:
    """Tab-separated intervals with 3 to 12 columns; ``#`` lines are skipped and a value of the wrong type is an error."""
    known = {**BED_TYPES, **(types or {})}
    return _csv(spark, path, ", ".join(f"`{c}` {known.get(c, 'string')}" for c in columns))


def read_table(spark: SparkSession, path, columns: Sequence[str] | None = None, types: dict[str, str] | None = None) -> DataFrame:
    """Table with a header line, gzipped or not: the wanted columns, as text unless a type is given; a leading ``#`` of the header is dropped."""
    raw = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("inferSchema", False).csv(path)
    raw = raw.withColumnsRenamed({c: c.lstrip("#") for c in raw.columns if c.startswith("#")})
    wanted = list(columns) if columns is not None else raw.columns
    return raw.select(*[F.col(f"`{c}`").cast((types or {}).get(c, "string")).alias(c) for c in wanted])


def read_sizes(spark: SparkSession, path) -> DataFrame:
    """Sequence names and sizes, the first two columns of an index; a size that is no whole number is an error."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    parts = F.split(F.trim("value"), r"\s+")
    size = F.try_element_at(parts, F.lit(2))
    checked = F.when(F.coalesce(size.rlike("^[0-9]+$"), F.lit(False)), size.try_cast("long")).otherwise(_error("malformed sequence length in: ", F.col("value")))
    return lines.select(F.element_at(parts, 1).alias("chrom"), checked.alias("size"))


def total_length(sizes: DataFrame) -> DataFrame:
    return sizes.agg(F.sum("size").alias("genome_size"))


def read_fasta(spark: SparkSession, path) -> DataFrame:
    """(name, header, seq) per record: the first word of the header, the whole header, and its lines joined."""
    records = spark.read.option("lineSep", "\n>").text(path).where(F.trim("value") != "")
    text = F.regexp_replace("value", "^>", "")
    header = F.trim(F.element_at(F.split(text, "\n", 2), 1))
    body = F.coalesce(F.try_element_at(F.split(text, "\n", 2), F.lit(2)), F.lit(""))
    return records.select(F.element_at(F.split(header, r"\s+"), 1).alias("name"), header.alias("header"), F.regexp_replace(body, r"\s", "").alias("seq"))


def read_fasta_chunks(spark: SparkSession, path, chunk: int = 1 << 16) -> DataFrame:
    """(name, chunk_no, seq) of all records, ``chunk`` bases a row and the rest in the last; no row holds a whole record.

    Lines are read in the splits of the files. Inside a split a line knows the header above it and its
    offset behind that; one small row per split, ordered by byte offset, hands the open record on to the
    splits that follow. A record of any length is thus read by many tasks. Its longest line is what a task
    must hold. Names are told apart by where their records start, so a name that occurs twice is two records.
    A record without bases has no row, and bases before the first header are an error.
    """
    from pyspark.sql import Window as W

    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_id"), "value"
    )
    is_head = F.col("value").startswith(">")
    name = F.element_at(F.split(F.trim(F.substring("value", 2, 1 << 30)), r"\s+"), 1)
    seq = F.when(is_head, "").otherwise(F.regexp_replace("value", r"\s", ""))
    lines = lines.select("file", "_at", "_id", F.when(is_head, F.struct("_at", "_id", name.alias("name"))).alias("_head"), seq.alias("seq"))
    split = W.partitionBy("file", "_at").orderBy("_id").rowsBetween(W.unboundedPreceding, 0)
    lines = lines.withColumn("_head", F.last("_head", ignorenulls=True).over(split))
    record = W.partitionBy("file", "_at", "_head").orderBy("_id").rowsBetween(W.unboundedPreceding, 0)
    lines = lines.withColumn("_stop", F.sum(F.length("seq").cast("long")).over(record))
    # the record open at the end of a split, and its bases since its header or the start of the split
    splits = lines.groupBy("file", "_at").agg(F.max_by("_head", "_id").alias("_open"), F.max_by("_stop", "_id").alias("_tail"))
    order = W.partitionBy("file").orderBy("_at")
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    splits = splits.withColumn("_run", F.count("_open").over(upto)).withColumn("_open", F.last("_open", ignorenulls=True).over(upto))
    splits = splits.withColumn("_tail", F.sum("_tail").over(W.partitionBy("file", "_run").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)))
    splits = splits.select("file", "_at", F.lag("_open").over(order).alias("_open"), F.lag("_tail").over(order).alias("_before"))
    bases = lines.where("seq <> ''").join(splits, ["file", "_at"])
    head = F.coalesce("_head", "_open")
    head = F.when(head.isNotNull(), head).otherwise(_error("bases before the first header of ", F.col("file")))
    stop = F.col("_stop") + F.when(F.col("_head").isNull(), F.coalesce("_before", F.lit(0))).otherwise(0)
    bases = bases.select("file", head.alias("_head"), (stop - F.length("seq")).alias("_from"), "seq")
    last = F.col("_from") + F.length("seq") - 1
    bases = bases.withColumn("chunk_no", F.explode(F.sequence(F.floor(F.col("_from") / chunk), F.floor(last / chunk))))
    first = F.greatest(F.col("chunk_no") * chunk, F.col("_from"))
    piece = F.substr("seq", (first - F.col("_from") + 1).cast("int"), F.least((F.col("chunk_no") + 1) * chunk - first, F.lit(1 << 30)).cast("int"))
    parts = bases.select("file", "_head", "chunk_no", F.struct(first.alias("at"), piece.alias("s")).alias("p"))
    whole = parts.groupBy("file", "_head", "chunk_no").agg(F.array_sort(F.collect_list("p")).alias("p"))  # at most ``chunk`` pieces
    return whole.select(F.col("_head.name").alias("name"), "chunk_no", F.array_join(F.transform("p", lambda x: x["s"]), "").alias("seq"))


def numbered_lines(spark: SparkSession, path) -> DataFrame:
    """(file, line_no from 0, value): line numbers per file.

    Lines are counted per file split; the splits of a file, ordered by their byte
    offset, give each its first line number. Only one small row per split is ordered.
    """
    from pyspark.sql import Window as W

    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_id"), "value"
    )
    splits = lines.groupBy("file", "_at").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = W.partitionBy("file").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return lines.join(splits, ["file", "_at"]).select("file", (F.col("_base") + F.col("_id") - F.col("_first")).alias("line_no"), "value")


def read_fastq(spark: SparkSession, path) -> DataFrame:
    """(name, seq, qual) from 4-line records."""
    lines = numbered_lines(spark, path).where("value <> '' or line_no % 4 in (1, 3)")
    at = lambda i: F.max(F.when(F.col("line_no") % 4 == i, F.col("value")))
    records = lines.groupBy("file", F.floor(F.col("line_no") / 4).alias("record")).agg(at(0).alias("header"), at(1).alias("seq"), at(3).alias("qual"))
    header = F.when(F.col("header").startswith("@"), F.col("header")).otherwise(_error("no FASTQ header: ", F.col("header")))
    return records.where("header is not null").select(F.element_at(F.split(F.expr("substring(header, 2)"), r"\s+"), 1).alias("name"), "seq", "qual", header.alias("header")).drop("header")


def read_sam(spark: SparkSession, path) -> DataFrame:
    """Alignments of a text SAM file with their half-open reference interval; unmapped reads have NULL coordinates."""
    lines = spark.read.text(path).where(~F.col("value").startswith("@") & (F.col("value") != ""))
    f = F.split("value", "\t")
    at = lambda i: F.element_at(f, i)
    ops = F.regexp_extract_all(at(6), F.lit("([0-9]+)[MDN=X]"), F.lit(1))
    span = F.aggregate(F.transform(ops, lambda x: x.cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    flag, pos = at(2).cast("int"), at(4).cast("long")
    mapped = (flag.bitwiseAND(F.lit(4)) == 0) & (at(3) != "*")
    return lines.select(
        at(1).alias("name"), flag.alias("flag"), F.when(mapped, at(3)).alias("chrom"), F.when(mapped, pos - 1).alias("start_pos"),
        F.when(mapped, pos - 1 + span).alias("end_pos"), at(5).cast("int").alias("mapq"), at(6).alias("cigar"),
        F.when(flag.bitwiseAND(F.lit(16)) == 16, "-").otherwise("+").alias("strand"), at(10).alias("seq"), at(11).alias("qual"),
    )


def vcf_samples(spark: SparkSession, path) -> DataFrame:
    """Rows (file, samples): the sample names in order, from the ``#CHROM`` line of every file."""
    head = spark.read.text(path).where(F.col("value").startswith("#CHROM"))
    return head.select(F.col("_metadata.file_path").alias("file"), F.slice(F.split("value", "\t"), 10, 1 << 20).alias("samples"))


def read_vcf(spark: SparkSession, path, sample: str | None = None) -> DataFrame:
    """Variant records with INFO as a map and the FORMAT fields of one sample (default: the first) as another.

    Files may have their samples in orders of their own. Where headers differ, every file
    needs one; a header without the sample is an error. Files that share one header may be
    parts of which only the first has it.
    """
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & (F.col("value") != ""))
    index = F.lit(10)
    if sample is not None:
        files = vcf_samples(spark, path)
        orders = [r["samples"] for r in files.select("samples").distinct().limit(2).collect()]
        if len(orders) < 2:
            if not orders or sample not in orders[0]:
                raise ValueError(f"no sample {sample} among {orders[0] if orders else []}")
            index = F.lit(10 + orders[0].index(sample))
        else:
            place = F.array_position("samples", F.lit(sample)).cast("int")
            wrong = F.raise_error(F.concat(F.lit(f"no sample {sample} in "), F.col("file")))
            files = files.select("file", "samples")
            lines = lines.withColumn("file", F.col("_metadata.file_path")).join(files, "file", "left").withColumn("_index", F.when(place > 0, place).otherwise(wrong) + 9)
            index = F.col("_index")
    f = F.split("value", "\t")
    at = lambda i: F.element_at(f, i)
    call = F.try_element_at(f, index)
    flags = F.transform(F.split(at(8), ";"), lambda x: F.when(x.contains("="), x).otherwise(F.concat(x, F.lit("=true"))))
    return lines.select(
        at(1).alias("chrom"), at(2).cast("long").alias("pos"), at(3).alias("id"), at(4).alias("ref"), at(5).alias("alt"), at(6).try_cast("double").alias("qual"), at(7).alias("filter"),
        at(8).alias("info"), F.str_to_map(F.array_join(flags, ";"), F.lit(";"), F.lit("=")).alias("info_map"), F.try_element_at(f, F.lit(9)).alias("format"), call.alias("call"),
        F.when(call.isNotNull(), F.map_from_arrays(F.slice(F.split(at(9), ":"), F.lit(1), F.size(F.split(call, ":"))), F.split(call, ":"))).alias("call_map"),
    )


def read_vcf_bed(spark: SparkSession, path) -> DataFrame:
    """Records of an 11-column variant BED: interval, quality, alleles, depth (second FORMAT field) and length (``LEN=n;``).

    Another second field or a missing length is an error.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    f = F.split(F.trim("value"), r"\s+")
    at = lambda i: F.element_at(f, i)
    second = F.try_element_at(F.split(at(10), ":"), F.lit(2))
    depth = F.when(second == "DP", F.try_element_at(F.split(at(11), ":"), F.lit(2)).cast("long")).otherwise(_error("DP not second in: ", F.col("value")))
    length = F.regexp_extract(at(9), "LEN=([0-9]+);", 1)
    length = F.when(length != "", length.try_cast("long")).otherwise(_error("no variant length in: ", F.col("value")))
    return lines.select(
        at(1).alias("chrom"), at(2).cast("long").alias("start_pos"), at(3).cast("long").alias("end_pos"), at(5).cast("double").alias("quality"),
        depth.alias("depth"), length.alias("variant_length"), at(6).alias("ref_allele"), at(7).alias("alt_allele"),
    )


def parse_lifted(df: DataFrame) -> DataFrame:
    """Lifted intervals (chrom, start, end, name ``contig_start_end[_t3|_t5]``) with their source location; another name is an error."""
    place = r"^(.+)_([0-9]+)_([0-9]+)(?:_t[35])?$"
    part = lambda i: F.regexp_extract("name", place, i)
    seq = F.when(F.col("name").rlike(place), part(1)).otherwise(_error("unreadable source location ", F.col("name")))
    return df.select(
        seq.alias("seq"), part(2).try_cast("long").alias("start_pos"), part(3).try_cast("long").alias("end_pos"), F.col("chrom").alias("ref_seq"),
        F.col("start_pos").alias("ref_start"), F.col("end_pos").alias("ref_end"),
    )


def read_lifted_bed(spark: SparkSession, path) -> DataFrame:
    return parse_lifted(read_bed(spark, path, ["chrom", "start_pos", "end_pos", "name", "score", "strand"]))


def read_gff3(spark: SparkSession, path) -> DataFrame:
    """Nine columns, 1-based closed ``start`` and ``end`` as in the file, and the half-open interval."""
    df = _csv(spark, path, "seqid string, source string, type string, start bigint, end bigint, score string, strand string, phase string, attributes string")
    return df.withColumns({"start_pos": F.col("start") - 1, "end_pos": F.col("end")})


AGP_COLUMNS = ["object", "object_start", "object_end", "comp_number", "comp_type", "comp_name", "comp_start", "comp_end", "orientation"]


def read_agp(spark: SparkSession, path) -> DataFrame:
    """Scaffold layout; component types other than W and N, or unexpected gap and linkage fields, are errors.

    ``comp_name`` is the gap length, ``comp_start`` the gap type and ``comp_end`` the linkage of N rows.
    """
    numbers = {"object_start", "object_end", "comp_number"}
    df = _csv(spark, path, ", ".join(f"{c} {'bigint' if c in numbers else 'string'}" for c in AGP_COLUMNS))
    ok = F.col("comp_type").isin("W", "N") & F.col("comp_end").rlike("^([0-9]+|yes)") & F.col("comp_start").rlike("^([0-9]+|scaffold)")
    kind = F.when(ok, F.col("comp_type")).otherwise(_error("unexpected layout row of ", F.col("object"), " component ", F.col("comp_number")))
    return df.withColumn("comp_type", kind).withColumn("comp_length", F.when(F.col("comp_type") == "W", F.col("comp_end").try_cast("long")))


def read_bedgraph(spark: SparkSession, path) -> DataFrame:
    lines = _csv(spark, path, "chrom string, start_pos bigint, end_pos bigint, depth double")
    return lines.where(~F.col("chrom").startswith("track") & ~F.col("chrom").startswith("browser"))


def read_key_value(spark: SparkSession, path, keys: Sequence[str], numeric: dict[str, str] | None = None) -> DataFrame:
    """One row per file of ``key<tab>value`` lines, wide over ``keys``.

    Keys naming a share, a coverage or Gbp (``pct``, ``percent``, ``cov``, ``Gbp``) become double, others bigint, unless typed in ``numeric``.
    """
    rows = _csv(spark, path, "key string, value string").select("key", "value", F.col("_metadata.file_path").alias("file"))
    kind = lambda k: (numeric or {}).get(k) or ("double" if any(x in k for x in ("pct", "percent", "cov", "Gbp")) else "bigint")
    return rows.groupBy("file").agg(*[F.max(F.when(F.col("key") == k, F.col("value"))).cast(kind(k)).alias(k) for k in keys])


def read_json(spark: SparkSession, path, schema: str, whole: bool = False, bad: str = "bad_record") -> DataFrame:
    """One row per JSON record, a line or with ``whole`` a file, with the columns of ``schema``.

    A record that is no JSON object or holds a value of another type is kept in the column ``bad``;
    its columns are NULL where they could not be read. Blank lines are no records.
    """
    text = spark.read.text(path, wholetext=whole).where("trim(value) <> ''")
    record = F.from_json("value", f"{schema}, {bad} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    return text.select(record.alias("r")).select("r.*")


def read_json_entries(spark: SparkSession, path, schema: str, name: str = "name", whole: bool = True) -> DataFrame:
    """One row per entry of JSON objects that map names to objects, with the columns of ``schema``.

    All files of ``path`` are one table: a name that occurs twice is an error, and so is a record that is no such object.
    """
    text = spark.read.text(path, wholetext=whole).where("trim(value) <> ''")
    record = F.from_json("value", f"map<string, struct<{schema}>>")
    entries = F.when(record.isNotNull(), record).otherwise(_error("not an object of named entries: ", F.substring("value", 1, 80)))
    rows = text.select(F.explode(entries).alias(name, "_e")).select(name, "_e.*")
    times = rows.groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    once = F.when(F.col("_n") == 1, F.col(name)).otherwise(_error("name occurs twice: ", F.col(name)))
    return rows.join(times, name).withColumn(name, once).drop("_n")


def report_lines(spark: SparkSession, path) -> DataFrame:
    """(file path, line from 1, text) of small report files, each read whole."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\n")).alias("line", "text")).withColumn("line", F.col("line") + 1)


def read_numbered_report(spark: SparkSession, path, metrics: dict[int, str]) -> DataFrame:
    """One row per report: the last word of each named line; names ending in pct or ratio are double, others bigint."""
    value = F.element_at(F.split(F.trim("text"), r"\s+"), -1)
    kind = lambda name: "double" if name.endswith(("pct", "ratio")) else "bigint"
    rows = report_lines(spark, path).where(F.col("line").isin(*metrics))
    return rows.groupBy("file").agg(*[F.max(F.when(F.col("line") == n, value)).cast(kind(name)).alias(name) for n, name in metrics.items()])


def read_gene_counts(spark: SparkSession, path, line: int) -> DataFrame:
    """Complete and partial genes of a report line ``… N + M part``."""
    words = F.split(F.trim("text"), r"\s+")
    rows = report_lines(spark, path).where(F.col("line") == line)
    return rows.select("file", F.element_at(words, -4).cast("long").alias("complete"), F.element_at(words, -2).cast("long").alias("partial"))


def read_sectioned_report(spark: SparkSession, path) -> DataFrame:
    """Rows (file, metric, count, pct) of a report with ``[Section]`` blocks and a REF and a QRY column of ``n``, ``n(p%)`` or ``p`` cells.

    The metric is ``REF|QRY_section_name`` with ``-`` as ``_`` and ``.`` as ``gap``; the two head lines and the ``[REF]`` line are skipped.
    """
    from pyspark.sql import Window as W

    words = F.split(F.trim("text"), r"\s+")
    lines = report_lines(spark, path).where("line > 2 and trim(text) <> ''").withColumn("w", words)
    lines = lines.where(F.element_at("w", 1) != "[REF]")
    is_head = F.element_at("w", 1).startswith("[")
    section = F.last(F.when(is_head, F.regexp_replace(F.element_at("w", 1), r"[\[\]]", "")), ignorenulls=True)
    # one report per partition, each a short text
    lines = lines.withColumn("section", section.over(W.partitionBy("file").orderBy("line").rowsBetween(W.unboundedPreceding, 0))).where(~is_head)
    name = F.replace(F.replace(F.element_at("w", 1), F.lit("-"), F.lit("_")), F.lit("."), F.lit("gap"))
    cells = F.filter(F.array(*[F.struct(F.lit(p).alias("side"), F.try_element_at("w", F.lit(i)).alias("cell")) for i, p in ((2, "REF"), (3, "QRY"))]), lambda x: x["cell"].isNotNull())
    rows = lines.select("file", "section", name.alias("name"), F.explode(cells).alias("c"))
    cell = F.col("c.cell")
    count = F.when(cell.contains("%"), F.regexp_extract(cell, r"^(-?[0-9]+)\(", 1)).when(~cell.contains("."), cell).try_cast("long")
    pct = F.when(cell.contains("%"), F.regexp_extract(cell, r"\(([0-9.]+)%\)", 1)).when(cell.contains("."), cell).try_cast("double")
    return rows.select("file", F.concat_ws("_", "c.side", "section", "name").alias("metric"), count.alias("count"), pct.alias("pct"))


# Labels in assembly file names.
PLATFORMS = {"ccs": "HiFi", "clr": "CLR"}
HAPLOTYPES = {"h1-un": 10, "h2-un": 20, "h1": 1, "h2": 2, "un": 0}
FILE_PATTERN = r"^([A-Za-z0-9]+)_.*?-(ccs|clr)(?:_[^.]*)?\.(?:.*\.)?(h1-un|h2-un|h1|h2|un)(?:\.|$)"


def with_file_metadata(df: DataFrame, col: str = "file", pattern: str = FILE_PATTERN) -> DataFrame:
    """Sample, platform and haplotype from a file name; a name without them is an error."""
    name = F.element_at(F.split(F.col(col), "/"), -1)
    part = lambda i: F.regexp_extract(name, pattern, i)
    pick = lambda mapping, key: F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[key]
    sample = F.when(name.rlike(pattern), part(1)).otherwise(_error("no sample, platform and haplotype in ", name))
    return df.select("*", sample.alias("sample"), pick(PLATFORMS, part(2)).alias("platform"), pick(HAPLOTYPES, part(3)).alias("haplotype"))


def concat_parts(read, spark: SparkSession, paths: Sequence[str], **options) -> DataFrame:
    """One table of all part files of a set, in one scan."""
    return read(spark, list(paths), **options)


def merge_fasta(seqs: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Cluster sequences under one header each: the cluster id in front where it is missing, ``|arrow`` and descriptions dropped.

    Other characters than letters, digits and ``_``, or a header that appears twice, are errors.
    """
    name = F.when(F.contains(F.col("name"), F.col(cluster)), F.col("name")).otherwise(F.concat_ws("_", cluster, "name"))
    name = F.element_at(F.split(F.replace(name, F.lit("|arrow"), F.lit("")), r"\s+"), 1)
    checked = F.when(name.rlike("^[A-Za-z_0-9]+$"), name).otherwise(_error("malformed FASTA header ", name))
    rows = seqs.select(checked.alias("name"), "seq")
    twice = rows.groupBy("name").agg(F.count(F.lit(1)).alias("_n"))
    once = F.when(F.col("_n") == 1, F.col("name")).otherwise(_error("duplicate FASTA header ", F.col("name")))
    return rows.join(twice, "name").select(once.alias("name"), "seq")

"""Cleaning and renaming of annotation tables, sequence names, sample tables and sequences."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.columns import fix_sample_id
from .distribution import running_in_order
from .sweep import END, START, union_all

# Chromosomes, classes, abbreviations and colours of the annotation sources.
CHROMOSOMES = [f"chr{i}" for i in range(1, 23)] + ["chrX", "chrY"]
REPEAT_CLASSES = ["SimpleRep", "Satellite", "LTR", "LINE", "SINE", "DNA", "LowComplex", "RNA", "Retroposon", "RC"]
REPEAT_FAMILIES = ["SVA", "Low_complexity", "Simple_repeat", "centr", "acro", "telo", "Satellite", "Alu"]
REPEAT_FAMILY_CLASSES = ["DNA", "RNA", "LTR", "LINE", "SINE"]
SEGDUP_COLOURS = [(0.9, "147,112,219", "purple"), (0.98, "128,128,128", "gray"), (0.99, "204,204,0", "yellow")]
SEGDUP_TOP_COLOUR = ("255,103,0", "orange")
REGION_TYPES = {
    "CTCF_binding_site": "CTCF",
    "enhancer": "ENH",
    "open_chromatin_region": "OPEN",
    "promoter": "PROM",
    "promoter_flanking_region": "PRFL",
    "TF_binding_site": "TFBS",
}
SV_TYPES = {"deletion": "DEL", "insertion": "INS"}


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[key]


def _error(*parts) -> Column:
    return F.raise_error(F.concat(*[F.coalesce(p.cast("string"), F.lit("NULL")) if isinstance(p, Column) else F.lit(p) for p in parts]))


# --- repeats and duplications -----------------------------------------------


def clean_repeats(df: DataFrame, chromosomes: Sequence[str] = CHROMOSOMES) -> DataFrame:
    """Repeats on main chromosomes with a certain class and family, and the class in ``out_class``.

    ``df`` has chrom, start, end, name, score, strand, rep_class, rep_family. A class outside the known ones is an error.
    """
    cls, family = F.col("rep_class"), F.col("rep_family")
    keep = F.col("chrom").isin(*chromosomes) & ~cls.contains("?") & ~family.contains("?") & ~cls.contains("Unknown") & ~cls.contains("Unspecified")
    label = F.when(cls.contains("Low_complexity"), "LowComplex").when(cls.contains("Simple_repeat"), "SimpleRep").when(cls.contains("RNA"), "RNA").otherwise(cls)
    known = F.when(label.isin(*REPEAT_CLASSES), label).otherwise(_error("unhandled repeat class ", cls))
    return df.where(keep).withColumn("out_class", known)


def repeats_by_family(df: DataFrame) -> DataFrame:
    """Certain repeats on main chromosomes, each in the first group it fits: eight families, then five classes; others are left out.

    A class group is named by its family when the rows left for it have only one, else ``various``.
    """
    cls, family = F.col("rep_class"), F.col("rep_family")
    rows = df.where(~cls.contains("?") & ~family.contains("?") & F.col("chrom").rlike("^chr[0-9XY]+$"))
    by_family = family.isin(*REPEAT_FAMILIES)
    rows = rows.withColumn("_fam", by_family).where(by_family | cls.isin(*REPEAT_FAMILY_CLASSES))
    others = rows.where(~F.col("_fam")).groupBy("rep_class").agg(F.when(F.min("rep_family") == F.max("rep_family"), F.min("rep_family")).otherwise("various").alias("_name"))
    rows = rows.join(others, "rep_class", "left")
    camel = lambda c: F.array_join(F.transform(F.split(c, "_"), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(w.substr(F.lit(2), F.length(w))))), "")
    group_family = F.when(F.col("_fam"), F.col("rep_family")).otherwise(F.col("_name"))
    return rows.withColumns({"group_class": camel(F.col("rep_class")), "group_family": camel(group_family)}).drop("_fam", "_name")


def clean_simple_repeats(df: DataFrame, chromosomes: Sequence[str] = CHROMOSOMES) -> DataFrame:
    """Simple repeats on main chromosomes with a built name and a class by motif length."""
    n = F.length("motif")
    label = F.when(n == 1, "homopolymer").when(n == 2, "dinucleotide").when(n == 3, "trinucleotide").otherwise("other")
    name = F.concat_ws("_", F.lit("TRF"), "chrom", F.col(START).cast("string"), (F.col(END) - F.col(START)).cast("string"))
    return df.where(F.col("chrom").isin(*chromosomes)).withColumns({"name": name, "strand": F.lit("."), "out_class": label})


def segdup_colour(frac: Column) -> Column:
    out = F.struct(F.lit(SEGDUP_TOP_COLOUR[0]).alias("color_rgb"), F.lit(SEGDUP_TOP_COLOUR[1]).alias("color_name"))
    for limit, rgb, name in reversed(SEGDUP_COLOURS):
        out = F.when(frac < limit, F.struct(F.lit(rgb).alias("color_rgb"), F.lit(name).alias("color_name"))).otherwise(out)
    return out


def score_segdups(df: DataFrame, chromosomes: Sequence[str] = CHROMOSOMES) -> DataFrame:
    """Score in thousandths of the matching fraction, colour band, and ``uid@score@name`` as label."""
    score = F.least(F.bround(F.col("frac_match") * 1000), F.lit(1000)).cast("int")
    out = df.where(F.col("chrom").isin(*chromosomes)).withColumns({"score": score, "_c": segdup_colour(F.col("frac_match"))})
    label = F.concat_ws("@", F.col("uid").cast("string"), F.col("score").cast("string"), "name")
    return out.select("*", "_c.*", label.alias("label")).drop("_c")


# --- region tables ----------------------------------------------------------


def _one_based(start: Column, end: Column, compat: bool) -> tuple[Column, Column]:
    """1-based closed to half-open; ``compat`` keeps the start and moves the end instead."""
    return (start, end + 1) if compat else (start - 1, end)


def clean_issues(df: DataFrame, compat: bool = False) -> DataFrame:
    """Assembly issues that have a location ``chr:1,234-5,678`` and no fix version, as scored regions named type_id."""
    place = r"^([^:]+):([0-9,]+)-([0-9,]+)$"
    number = lambda i: F.regexp_replace(F.regexp_extract("location", place, i), ",", "").try_cast("long")
    start, end = _one_based(number(2), number(3), compat)
    rows = df.where(F.col("location").isNotNull() & F.col("fix_version").isNull())
    return rows.select(
        F.when(F.col("location").rlike(place), F.regexp_extract("location", place, 1)).otherwise(_error("unreadable location ", F.col("location"))).alias("chrom"),
        start.alias(START), end.alias(END), F.concat_ws("_", "issue_type", "issue_id").alias("name"), F.lit(1000).alias("score"), F.lit(".").alias("strand"),
        "issue_id", "issue_type", F.replace("status", F.lit(" "), F.lit("_")).alias("status"), F.lit("not_indicated").alias("fix_version"),
        F.col("placements").cast("long").alias("placements"), F.concat(F.lit("["), "summary", F.lit("]")).alias("summary"),
    )


def clean_regions(df: DataFrame, compat: bool = False) -> DataFrame:
    """Modeled regions: ``chr`` before the chromosome, ``#`` dropped, score 750 for HET, 500 for PAR (named by chromosome), else 1000."""
    start, end = _one_based(F.col(START).cast("long"), F.col(END).cast("long"), compat)
    name = F.replace("name", F.lit("#"), F.lit(""))
    par = name.startswith("PAR")
    return df.select(
        F.concat(F.lit("chr"), "chrom").alias("chrom"), start.alias(START), end.alias(END), F.when(par, F.concat(name, "chrom")).otherwise(name).alias("name"),
        F.when(par, 500).when(name.startswith("HET"), 750).otherwise(1000).alias("score"),
    )


def clean_cytobands(df: DataFrame, chroms: DataFrame) -> DataFrame:
    """Named bands on known chromosomes, the number of the stain x 10 as score."""
    stain = F.coalesce(F.regexp_extract("stain", "([0-9]+)", 1).try_cast("int"), F.lit(0)) * 10
    rows = df.where(F.col("name").isNotNull() & (F.col("name") != "")).join(chroms.select("chrom"), "chrom", "left_semi")
    return rows.select("chrom", START, END, F.concat("chrom", "name").alias("name"), stain.alias("score"))


def unsupported_svs(df: DataFrame, types: Sequence[str] = ("DEL", "INS")) -> DataFrame:
    """SV calls without optical-map support as intervals of their length."""
    start = F.col("pos").cast("long")
    return df.where(F.col("bionano").isNull() & F.col("svtype").isin(*types)).select(
        "chrom", start.alias(START), (start + F.col("svlen").cast("long")).alias(END), F.col("id").alias("name"), "svtype", F.col("disc_class").alias("svclass")
    )


def clean_sv_clusters(df: DataFrame, min_length: int = 10) -> tuple[DataFrame, DataFrame]:
    """Clusters with prefixed names and short type names; those shorter than ``min_length`` are the second result."""
    rows = df.withColumns({
        "name": F.concat(F.lit("BNG"), F.col("name").cast("string")), "chrom": F.concat(F.lit("chr"), F.col("chrom").cast("string")), "svtype": _lookup(SV_TYPES, F.col("svtype")),
    })
    short = F.col(END) - F.col(START) < min_length
    return rows.where(~short), rows.where(short)


# --- regulatory regions and sequence names ----------------------------------


def _substrings(c: str, least: int = 4) -> Column:
    """All distinct substrings of at least ``least`` characters, one to a row."""
    length = F.length(c)
    starts = lambda n: F.transform(F.sequence(F.lit(1), length - n + 1), lambda i: F.substring(F.col(c), i, n))
    every = F.flatten(F.transform(F.sequence(F.lit(least), length), starts))
    return F.explode(F.array_distinct(F.when(length >= least, every)))


def match_names(names: DataFrame, chroms: DataFrame) -> DataFrame:
    """Reference name of every distinct sequence name: itself, ``chr`` before it, or the name sharing the longest
    substring of more than 3 characters (ties: the smaller); NULL without any. Two names matched to one
    reference by substring are an error.

    Works on distinct names; a name meets the reference names by the substrings both have.
    """
    known = chroms.select("chrom").distinct()
    rows = names.select("name").distinct()
    same = rows.join(known, F.col("name") == F.col("chrom"), "left").withColumnRenamed("chrom", "_same")
    rows = same.join(known, F.concat(F.lit("chr"), "name") == F.col("chrom"), "left").select("name", F.coalesce("_same", "chrom").alias("direct"))
    exact = rows.where("direct is not null").select("name", F.col("direct").alias("target"), F.lit(False).alias("by_substring"))
    rest = rows.where("direct is null").select("name")
    shared = rest.select("name", _substrings("name").alias("part")).join(known.select("chrom", _substrings("chrom").alias("part")), "part")
    best = shared.groupBy("name").agg(F.min(F.struct((-F.length("part")).alias("n"), F.col("chrom").alias("target"))).alias("_best"))
    loose = rest.join(best, "name", "left").select("name", F.col("_best.target").alias("target"), F.lit(True).alias("by_substring"))
    uses = loose.where("target is not null").groupBy("target").agg(F.count(F.lit(1)).alias("_n"))
    loose = loose.join(uses, "target", "left")
    checked = F.when(F.coalesce("_n", F.lit(1)) > 1, _error("two names match ", F.col("target"))).otherwise(F.col("target"))
    return exact.unionByName(loose.select("name", checked.alias("target"), "by_substring"))


def gff_to_regions(gff: DataFrame, chroms: DataFrame, min_length: int = 31) -> DataFrame:
    """Regulatory features as named regions, with ``kept`` and, when not, no chromosome (``skip`` short or unmatched).

    ``gff`` has seqid, type, start (1-based), end, score, strand, attributes.
    """
    usable = gff.where(F.col("end") - F.col("start") + 1 >= min_length)
    matched = match_names(usable.select(F.col("seqid").alias("name")), chroms).select(F.col("name").alias("seqid"), "target")
    short_type = F.coalesce(_lookup(REGION_TYPES, F.col("type")), F.col("type"))
    start = (F.col("start") - 1).cast("long")
    ident = F.regexp_extract("attributes", "ENS[A-Z0-9]+", 0)
    gff = gff.select("seqid", "type", "start", "end", "score", "strand", "attributes")
    rows = gff.join(matched, "seqid", "left").select("*", start.alias(START), F.col("end").cast("long").alias(END), short_type.alias("region_type"))
    long_enough = F.col(END) - F.col(START) >= min_length
    skip = F.when(~long_enough, "short").when(F.col("target").isNull(), "unmatched")
    name = F.when(F.length(ident) > 3, F.concat_ws("_", "region_type", ident)).otherwise(F.col("region_type"))
    return rows.select(F.col("target").alias("chrom"), START, END, name.alias("name"), "score", "strand", "region_type", "seqid", skip.alias("skip"))


def gff_counts(regions: DataFrame) -> DataFrame:
    """Number and bases of kept and skipped features per type, chromosome (unmatched: as named in the file) and, for kept, in TOTAL."""
    kept = F.col("skip").isNull()
    keys = F.array_compact(F.array(F.col("region_type"), F.when(kept, F.col("chrom")).when(F.col("skip") == "unmatched", F.col("seqid")), F.when(kept, F.lit("TOTAL"))))
    rows = regions.select(kept.alias("kept"), F.explode(keys).alias("key"), (F.col(END) - F.col(START)).alias("bp"))
    return rows.groupBy("kept", "key").agg(F.count(F.lit(1)).alias("n"), F.sum("bp").alias("bp"))


def normalize_seq_names(df: DataFrame, header: str = "header") -> DataFrame:
    """Consistent sequence names from FASTA headers: chrN, chrM, chrUn_, _random, _alt and patch names."""
    line = F.col(header)
    low = F.lower(line)
    first = F.element_at(F.split(line, r"\s+"), 1)
    first = F.when(first.rlike("^[0-9]+$") | first.isin("X", "Y", "M", "MT"), F.concat(F.lit("chr"), first)).otherwise(first)
    plain = F.element_at(F.split(first, r"\."), 1)
    number = F.regexp_extract(line, r"chromosome\s([0-9XY]+)(\s|,)", 1)
    patch = F.regexp_replace(F.regexp_extract(line, r"contig\s([A-Z0-9_\-]+),", 1), "^[_PATCH]+|[_PATCH]+$", "")
    on_chrom = lambda tail: F.when(number != "", F.concat(F.lit("chr"), number, F.lit("_"), plain, tail)).otherwise(plain)
    name = (
        F.when(low.contains("mitochondrion") & low.contains("complete"), "chrM")
        .when(low.contains("unplaced genomic contig"), F.concat(F.lit("chrUn_"), plain))
        .when(low.contains("unlocalized genomic contig"), on_chrom(F.lit("_random")))
        .when(low.contains("alternate locus"), on_chrom(F.lit("_alt")))
        .when(line.contains("PATCH"), F.when(patch != "", on_chrom(F.concat(F.lit("_"), patch))).otherwise(plain))
        .when(low.contains("primary"), F.when(number != "", F.concat(F.lit("chr"), number)).otherwise(plain))
        .otherwise(plain)
    )
    return df.withColumn("name", F.regexp_replace(name, r"[*:\-|]", "_"))


def subset_sequences(seqs: DataFrame, rule: str, names: Sequence[str] | None = None, regex: str | None = None) -> DataFrame:
    """Sequences of the rule: ``main`` (the names given, default the main chromosomes), ``no_mito``, ``mito``,
    ``with_alt`` (names plus alternative, random and unplaced ones), ``listed`` or ``regex``."""
    name = F.col("name")
    listed = name.isin(*(names if names is not None else CHROMOSOMES))
    tests = {
        "main": listed,
        "listed": listed,
        "no_mito": ~name.startswith("chrM"),
        "mito": name.startswith("chrM"),
        "with_alt": listed | name.endswith("_alt") | name.endswith("_random") | name.startswith("chrUn"),
    }
    return seqs.where(name.rlike(regex) if rule == "regex" else tests[rule])


def sequence_sizes(seqs: DataFrame) -> DataFrame:
    """Total length per name, also when a sequence is stored in pieces."""
    return seqs.groupBy("name").agg(F.sum(F.length("seq")).cast("long").alias("size"))


# --- sample and run tables --------------------------------------------------


def split_cohort(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs with both mates and every column filled, dumped from CRAM files, with the pairs split; and the dropped rows."""
    pair = lambda col, unit: [F.regexp_extract(col, f"({unit});({unit})", i) for i in (1, 2)]
    parts = {"md5": pair("fastq_md5", "[a-z0-9]+"), "bytes": pair("fastq_bytes", "[0-9]+"), "path": pair("fastq_ftp", r"[A-Za-z0-9/\._]+")}
    cols = {f"fastq{i}_{k}": F.when(v[i - 1] != "", v[i - 1]) for k, v in parts.items() for i in (1, 2)}
    rows = df.withColumns(cols)
    complete = F.lit(True)
    for c in rows.columns:
        complete = complete & F.col(c).isNotNull()
    keep = complete & F.coalesce(F.trim("submitted_ftp").endswith(".cram"), F.lit(False))
    base = lambda i: F.concat_ws("_", F.trim("sample_alias"), F.element_at(F.split(F.trim(f"fastq{i}_path"), "/"), -1))
    dropped = [c for c in ("fastq_md5", "fastq_bytes", "fastq_ftp", "submitted_ftp") if c in df.columns]
    return rows.where(keep).withColumns({"fastq1_name": base(1), "fastq2_name": base(2)}).drop(*dropped), rows.where(~keep)


# Readset part of the label per study; the library name follows where ``True``.
STUDIES = {
    "PRJEB14185": ("eriba_il25k-100pe", True),
    "PRJNA540705": ("giab_pbsq2-ccs", False),
    "PRJEB9396": ("1kg_il25k-125pe", False),
    "PRJEB36890": ("1kg_ilnvs-150pe", False),
    "PRJEB31736": ("1kg_ilnvs-150pe", False),
}
LONG_STUDIES = ["PRJNA540705"]
# What the platform and the instrument model of a study must contain, and the studies of paired reads.
INSTRUMENTS = {
    "PRJEB12849": ("illumina", "hiseq 2500"),
    "PRJEB14185": ("illumina", "hiseq 2500"),
    "PRJNA540705": ("pacbio", "sequel ii"),
    "PRJEB9396": ("illumina", "hiseq 2500"),
    "PRJEB36890": ("illumina", "novaseq 6000"),
    "PRJEB31736": ("illumina", "novaseq 6000"),
}
PAIRED = ["PRJEB12849", "PRJEB9396", "PRJEB36890", "PRJEB31736"]
MATES = {1: r"([._]R1|_1)\.fastq\.gz$", 2: r"([._]R2|_2)\.fastq\.gz$"}


def check_runs(df: DataFrame) -> DataFrame:
    """The rows, where platform, instrument model and layout fit the study and, in the study whose library names
    hold them, individual and a library number of 3 characters; any other row is an error.

    Checked where the columns instrument_platform and instrument_model are there. Libraries of the study that
    leaves unpaired runs out may have any layout.
    """
    study, lib = F.col("study"), F.split("library_name", "_")
    wrong = F.lit(False)
    for name, (platform, model) in INSTRUMENTS.items():
        fits = F.lower("instrument_platform").contains(platform) & F.lower("instrument_model").contains(model) if {"instrument_platform", "instrument_model"} <= set(df.columns) else F.lit(True)
        if name in PAIRED:
            fits = fits & F.lower("library_layout").contains("paired")
        if name == "PRJEB12849":
            fits = fits & (F.size(lib) == 4) & (F.try_element_at(lib, F.lit(1)) == F.col("individual")) & (F.length(F.try_element_at(lib, F.lit(3))) == 3)
        wrong = wrong | ((study == name) & ~F.coalesce(fits, F.lit(False)))
    return df.withColumn("study", F.when(wrong, _error("the run does not fit its study: ", F.col("run"))).otherwise(study))


def annotate_runs(df: DataFrame) -> DataFrame:
    """One row per file of each run: label of the readset by study, mate number (short reads) or part number (long reads).

    ``df`` has study, individual, sample_alias, library_name, library_layout, run, fastq_ftp and submitted_ftp
    (URLs joined by ``;``). Runs of other samples and short-read files without a mate mark are left out; an unknown study is an error.
    """
    df = check_runs(df)
    study, lib = F.col("study"), F.col("library_name")
    fields = F.split(lib, "_")
    kind = F.when(F.lower(lib).contains("_mono"), "075mo").when(F.lower(lib).contains("_di"), "150di").otherwise(_error("unexpected library ", lib))
    label = F.when(study == "PRJEB12849", F.concat(F.lit("1kg_il25k-"), kind, F.lit("_P"), F.lpad(F.element_at(fields, 2), 3, "0"), F.lit("L"), F.element_at(fields, 3)))
    for name, (text, with_lib) in STUDIES.items():
        tail = F.concat(F.lit(f"{text}_"), F.replace(lib, F.lit("_"), F.lit("-"))) if with_lib else F.lit(text)
        label = label.when(study == name, tail)
    label = label.otherwise(_error("unknown study ", study))
    sub = F.coalesce(F.col("submitted_ftp"), F.lit(""))
    usable = F.col("sample_alias").contains(F.col("individual"))
    usable = usable & ~((study == "PRJEB14185") & (F.lower("library_layout") != "paired")) & ~((study == "PRJEB9396") & ~sub.contains("NoIndex"))
    usable = usable & ~(study.isin("PRJEB36890", "PRJEB31736") & ~F.lower(sub).endswith(".cram"))
    rows = df.where(usable).withColumn("label", F.concat_ws("_", "individual", label)).withColumn("is_long", study.isin(*LONG_STUDIES))
    urls = F.when(F.col("fastq_ftp").contains("ebi.ac.uk"), F.col("fastq_ftp")).otherwise(F.col("submitted_ftp"))
    files = rows.select("*", F.explode(F.split(urls, ";")).alias("url"))
    files = files.withColumn("url", F.when(F.col("url").startswith("ftp://"), F.col("url")).otherwise(F.concat(F.lit("ftp://"), "url")))
    mate = F.when(F.col("url").rlike(MATES[1]), 1).when(F.col("url").rlike(MATES[2]), 2).otherwise(0)
    files = files.withColumn("mate", F.when(F.col("is_long"), 0).otherwise(mate)).where("is_long or mate > 0")
    runs = part_numbers(rows.where("is_long").select("individual", "run").distinct(), ["individual"], ["run"])
    files = files.join(runs, ["individual", "run"], "left")
    name = F.when(F.col("is_long"), F.concat("label", F.lit(".part"), F.col("part").cast("string"), F.lit(".fastq.gz"))).otherwise(
        F.concat_ws("_", "label", "run", F.concat(F.col("mate").cast("string"), F.lit(".fastq.gz")))
    )
    return files.select("individual", "study", "run", "label", "mate", "part", "url", name.alias("local_name"))


def part_numbers(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Number the members of each group, such as the files of one sample; a large group is numbered in ranges of its order."""
    return running_in_order(df.withColumn("_n", F.lit(1)), by, order, "_n", "part").drop("_n").withColumn("part", F.col("part").cast("int"))


def drop_blacklisted(df: DataFrame, hints: Sequence[str], col: str = "url") -> DataFrame:
    """Rows whose path contains none of the hints, which become one pattern."""
    if not hints:
        return df
    return df.where(~F.col(col).rlike("|".join(re.escape(h) for h in hints)))


# Entries of the segment column that are not chains, and the width given to a single label.
NO_CHAIN = {"single label": "single_label", "singlelabel": "single_label", "notenoughresolution": "no_resolution"}
LABEL_WIDTH = 6


def flatten_segments(df: DataFrame) -> DataFrame:
    """One row per segment of ``color:start-end;…``: color, start, end, support (0 single label, 1 partial, 2 full).

    Rows without a chain keep one row (``single_label``, ``no_resolution``, ``no_value``) with -1; unreadable parts are ``parse_error``.
    """
    text = F.col("segments")
    special = F.when(text.isNull(), "no_value")
    for k, v in NO_CHAIN.items():
        special = special.when(text == k, v)
    rows = df.withColumn("_special", special)
    rows = rows.withColumn("_part", F.explode_outer(F.when(F.col("_special").isNull(), F.split(text, ";"))))
    halves = F.split("_part", ":")
    raw = F.replace(F.lower(F.trim(F.try_element_at(halves, F.lit(1)))), F.lit(" "), F.lit(""))
    single = raw.contains("singlelabel")
    color = F.when(single, F.element_at(F.split(raw, r"\("), 1)).otherwise(raw)
    partial = color.contains("partial")
    color = F.trim(F.replace(color, F.lit("partial"), F.lit("")))
    span = F.split(F.replace(F.try_element_at(halves, F.lit(2)), F.lit(","), F.lit("")), "-")
    start = F.trim(F.try_element_at(span, F.lit(1))).try_cast("long")
    stop = F.trim(F.try_element_at(span, F.lit(2))).try_cast("long")
    point = F.size(span) == 1
    bad = (F.size(halves) != 2) | start.isNull() | (~point & stop.isNull()) | (F.size(span) > 2)
    none = F.lit(-1).cast("long")
    out = lambda ok, error, other: F.when(F.col("_special").isNotNull(), other).when(bad, error).otherwise(ok)
    return rows.select(
        *df.columns, out(color, F.lit("parse_error"), F.col("_special")).alias("segment_color"), out(start, none, none).alias("segment_start"),
        out(F.when(point, start + LABEL_WIDTH).otherwise(stop), none, none).alias("segment_end"),
        out(F.when(point, 0).when(partial, 1).otherwise(2), F.lit(-1), F.lit(-1)).alias("segment_support"),
    )


def split_variants(df: DataFrame) -> DataFrame:
    """``type(a+b):start-end`` as type, ``a|b`` and coordinates; NULL gives ``no_variant``."""
    text = F.col("svs")
    chain = F.array_join(F.transform(F.split(F.regexp_extract(text, r"\(([^)]*)\)", 1), r"\+"), lambda x: F.trim(x)), "|")
    number = lambda i: F.coalesce(F.regexp_extract(text, r":([0-9]+)-([0-9]+)", i).try_cast("long"), F.lit(-1))
    return df.select(
        "*", F.when(text.isNull(), "no_variant").otherwise(F.regexp_extract(text, r"^([^(:]+)", 1)).alias("variant_type"),
        F.when(text.isNull(), "no_segment_chain").otherwise(chain).alias("variant_segment_chain"), number(1).alias("variant_start"), number(2).alias("variant_end"),
    )


def normalize_segment_samples(df: DataFrame) -> DataFrame:
    """Typed sample columns of a segment table: accession, platform, haplotype, and component coordinates (a single label is 6 wide, else -1)."""
    start = F.col("start").try_cast("long")
    end = F.col("end").try_cast("long")
    sample = F.col("sample_id")
    sample = F.when(sample.isin("GM00864", "NA00864"), "HG00864").otherwise(fix_sample_id(sample))
    pop = F.coalesce("population", F.when(F.col("sample_id") == "NA24385", "ASK").otherwise(_error("no population for ", F.col("sample_id"))))
    return df.select(
        "row_id", sample.alias("sample"), pop.alias("population"), F.element_at(F.split("assembly_type", "-"), 1).alias("platform"),
        F.upper(F.element_at(F.split("contig_id", "-"), 1)).alias("haplotype"), F.col("contig_id").alias("bng_contig_id"),
        F.coalesce(start, F.lit(-1)).alias("component_start"), F.coalesce(end, F.when(start.isNotNull(), start + LABEL_WIDTH), F.lit(-1)).alias("component_end"),
        "orientation", F.col("component_length").cast("long").alias("component_length"),
    )


def flatten_segment_table(df: DataFrame) -> DataFrame:
    """Sample, variant and segment columns of every row joined; ``df`` has row_id and the raw columns."""
    samples = normalize_segment_samples(df)
    svs = split_variants(df.select("row_id", "svs")).drop("svs")
    segments = flatten_segments(df.select("row_id", "segments")).drop("segments")
    return samples.join(svs, "row_id", "full").join(segments, "row_id", "full")


# --- sequences --------------------------------------------------------------


def chop_sequences(seqs: DataFrame, width: int = 500) -> DataFrame:
    """Pseudo reads: below ``width`` none, up to 2 x ``width`` two halves, else whole pieces of ``width`` (the rest is dropped).

    One scan of the sequence makes all its pieces.
    """
    n = F.length("seq")
    half = F.floor(n / 2).cast("int")
    halves = F.array(F.substring("seq", 1, half), F.col("seq").substr(half + 1, n))
    pieces = F.when(n < 2 * width + 1, halves).otherwise(F.regexp_extract_all("seq", F.lit(f"(?s)(.{{{width}}})"), F.lit(1)))
    rows = seqs.where(n >= width).select("name", F.posexplode(pieces).alias("i", "seq"))
    return rows.select(F.concat("name", F.lit("_read"), F.col("i").cast("string")).alias("name"), "seq")


def split_blocks(seqs: DataFrame, limit: int, gap: str = "N" * 100) -> DataFrame:
    """Contigs of a cluster sequence (between gap runs) grouped in blocks; a block closes once it is longer than ``limit``.

    Gives name, block number, contig number and length; the running length is reset along the
    contig sizes of one sequence, not along the sequence.
    """
    sizes = F.transform(F.split("seq", gap, -1), lambda x: F.length(x).cast("long"))
    step = lambda acc, x: F.struct(
        F.when(acc["run"] > limit, x).otherwise(acc["run"] + x).alias("run"),
        F.when(acc["run"] > limit, acc["block"] + 1).otherwise(acc["block"]).alias("block"),
        F.concat(acc["blocks"], F.array(F.when(acc["run"] > limit, acc["block"] + 1).otherwise(acc["block"]))).alias("blocks"),
    )
    start = F.struct(F.lit(0).cast("long").alias("run"), F.lit(0).alias("block"), F.expr("cast(array() as array<int>)").alias("blocks"))
    rows = seqs.select("name", sizes.alias("s")).withColumn("b", F.aggregate("s", start, step, lambda acc: acc["blocks"]))
    return rows.select("name", F.posexplode(F.arrays_zip("s", "b")).alias("contig_no", "x")).select("name", F.col("x.b").alias("block"), "contig_no", F.col("x.s").alias("length"))


# --- set operations ---------------------------------------------------------


def merge_unique(frames: Sequence[DataFrame], order: Sequence[str]) -> DataFrame:
    """Rows of all parts without repeats, sorted."""
    return union_all(list(frames)).distinct().orderBy(*order)


def symmetric_difference(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys in exactly one of two tables, with the side."""
    left, right = a.select(*on).distinct(), b.select(*on).distinct()
    return left.join(right, list(on), "left_anti").withColumn("side", F.lit("a")).unionByName(right.join(left, list(on), "left_anti").withColumn("side", F.lit("b")))


def set_difference(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys of ``a`` that ``b`` lacks."""
    return a.select(*on).distinct().join(b.select(*on), list(on), "left_anti")


def shared_keys(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys in both tables."""
    return a.select(*on).intersect(b.select(*on))


def multi_key_sort(df: DataFrame, ascending: dict[str, bool]) -> DataFrame:
    """Rows ordered by several columns, each in its own direction."""
    return df.orderBy(*[F.asc(c) if up else F.desc(c) for c, up in ascending.items()])

"""Document fingerprints: Merkle trees, in DataFrame operations only.

A leaf is a sentence (up to ". ", "! ", "? " or a line end), a paragraph is a line,
and a section is a run of paragraphs that ends where a paragraph's own hash says so,
so an edit moves no section borders but its own. Nodes hash their children's full
hashes. A fingerprint lists the tree from the root down: r, s, p and l mark root,
section, paragraph and leaf; nodes below the root show 12 digits. Equal roots mean
equal texts; nodes that only one of two fingerprints has are where the texts differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import common

#: Documents in a block of neighbours.
BLOCK_ROWS = 2048


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; that of an empty text has one empty leaf. Null for null."""
    leaves = F.split(F.regexp_replace(text, "([.!?] |\n)", "$1\u0001"), "\u0001", -1)
    marked = F.array_join(F.transform(leaves, lambda x: F.concat(F.lit(" l"), F.md5(x), F.when(x.endswith("\n"), F.lit(";")).otherwise(F.lit("")))), "")
    # a paragraph: its hash, then its leaves; a section ends after a hash of 0 to 3
    paragraphs = F.filter(F.split(marked, ";"), lambda x: x != "")
    hashed = F.transform(paragraphs, lambda x: F.concat(F.lit(" p"), F.md5(x), x, F.when(F.substring(F.md5(x), 1, 1) < "4", F.lit(";")).otherwise(F.lit(""))))
    sections = F.filter(F.split(F.array_join(hashed, ""), ";"), lambda x: x != "")
    tree = F.array_join(F.transform(sections, lambda x: F.concat(F.lit(" s"), F.md5(x), x)), "")
    # the listing keeps 12 digits of the nodes below the root
    short = F.regexp_replace(tree, "( [spl][0-9a-f]{12})[0-9a-f]{20}", "$1")
    return F.concat(F.lit("r"), F.sha2(tree, 256), short)


def nodes(print_: Column, kind: str = "l") -> Column:
    """The distinct nodes of a kind (s, p or l) in a fingerprint."""
    return F.array_distinct(F.filter(F.split(print_, " "), lambda x: x.startswith(kind)))


def likeness(a: Column, b: Column) -> Column:
    """Shared leaves of two fingerprints over their mean number of leaves: 1 for equal texts, 0 with none in common."""
    x, y = nodes(a), nodes(b)
    shared = 2 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y))
    return F.when(a == b, F.lit(1.0)).otherwise(shared)


def changed_branches(a: Column, b: Column) -> Column:
    """Nodes of a that b lacks, from sections down to leaves; empty where the roots agree."""
    return F.when(F.substring(a, 1, 65) == F.substring(b, 1, 65), F.array().cast("array<string>")).otherwise(F.array_except(F.slice(F.split(a, " "), 2, 1 << 30), F.split(b, " ")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_chars, fingerprint), one for each row of docs; a null text is an empty one."""
    return common.texts(docs, id_col, text_col).select("doc_id", F.length("text").cast("long").alias("n_chars"), fingerprint(F.col("text")).alias("fingerprint"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, text, next_text): the next document in descending id order; the first follows the last.

    Null ids come last; rows of one id are ordered by a hash of the text and the
    text. A table of one row is its own next. Ids are cut into blocks of equal width,
    about BLOCK_ROWS documents each, so no order over all rows is needed: a row's
    next is in its block, or it is the first row of the next block with rows.
    """
    rows = common.texts(docs, id_col, text_col)
    ids = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).first()
    low = ids["low"] or 0
    width = max(1, ((ids["high"] or 0) - low + 1) * BLOCK_ROWS // max(1, ids["n"]))
    rows = rows.withColumn("_block", F.coalesce(F.floor((F.col("doc_id").cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")) / width).cast("long"), F.lit(-1))).withColumn("_tie", F.xxhash64("text"))
    inner = Window.partitionBy("_block").orderBy(F.col("doc_id").desc(), "_tie", "text")
    firsts = rows.withColumn("_n", F.row_number().over(inner)).where("_n = 1").select(F.col("_block").alias("_next"), F.col("text").alias("_first"))
    blocks = rows.groupBy("_block").agg(F.lit(1).alias("_one"))
    order = Window.orderBy(F.col("_block").desc())
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    links = blocks.select("_block", F.coalesce(F.lead("_block").over(order), F.first("_block").over(whole)).alias("_next"))
    nexts = links.join(firsts, "_next").select("_block", "_first")
    led = rows.withColumn("_lead", F.lead("text").over(inner))
    return led.join(nexts, "_block").select("doc_id", "text", F.coalesce("_lead", "_first").alias("next_text"))


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one for each row.

    The edited text has its last floor(n_chars / 2) code points replaced by the first
    as many (or all) of the next document. Null texts are empty; an empty text stays
    so. Fingerprints are linear in the text, however long it is.
    """
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = with_next(docs, id_col, text_col).withColumn("_edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half)))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"), fingerprint(F.col("text")).alias("fingerprint"), fingerprint(F.col("_edited")).alias("edited_fingerprint"), fingerprint(F.col("next_text")).alias("_next"))
    near = likeness(F.col("fingerprint"), F.col("edited_fingerprint"))
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near.alias("near_edited"), likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"))


def _fingerprint_sql(text: str) -> str:
    leaves = f"string_split(regexp_replace({text}, '([.!?] |\\n)', '\\1' || chr(1), 'g'), chr(1))"
    marked = f"array_to_string(list_transform({leaves}, lambda x: ' l' || md5(x) || CASE WHEN suffix(x, chr(10)) THEN ';' ELSE '' END), '')"
    hashed = f"list_transform(list_filter(string_split({marked}, ';'), lambda x: x <> ''), lambda x: ' p' || md5(x) || x || CASE WHEN md5(x)[1] < '4' THEN ';' ELSE '' END)"
    return f"array_to_string(list_transform(list_filter(string_split(array_to_string({hashed}, ''), ';'), lambda x: x <> ''), lambda x: ' s' || md5(x) || x), '')"


def edit_report_sql() -> str:
    """edit_report for the table documents, for DuckDB."""
    short = lambda t: f"'r' || sha256({t}) || regexp_replace({t}, '( [spl][0-9a-f]{{12}})[0-9a-f]{{20}}', '\\1', 'g')"
    leaves = lambda f: f"list_distinct(list_filter(string_split({f}, ' '), lambda x: prefix(x, 'l')))"
    near = lambda a, b: f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE ELSE 2 * len(list_intersect({leaves(a)}, {leaves(b)}))::DOUBLE / (len({leaves(a)}) + len({leaves(b)})) END"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
x AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS nt FROM d),
e AS (SELECT *, substr(text, 1, n - n // 2) || substr(nt, 1, n // 2) AS et FROM x),
t AS (SELECT doc_id, n, sha256(et) AS h, {_fingerprint_sql('text')} AS a, {_fingerprint_sql('et')} AS b, {_fingerprint_sql('nt')} AS c FROM e),
f AS (SELECT doc_id, n, h, {short('a')} AS a, {short('b')} AS b, {short('c')} AS c FROM t)
SELECT doc_id, CAST(n AS BIGINT) AS n_chars, h AS edited_sha256, a AS fingerprint, b AS edited_fingerprint, {near('a', 'b')} AS near_edited, {near('a', 'c')} AS near_next FROM f"""

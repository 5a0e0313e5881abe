"""Registered queries: a Spark plan over the given tables, and the SQL that must agree with it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# The given tables seen as genomics tables; each is one SELECT that both engines run.
VIEWS = {
    "aln": """SELECT concat('chr', l_suppkey % 5 + 1) AS chrom, CAST(l_partkey AS BIGINT)*50 AS start_pos,
        CAST(l_partkey AS BIGINT)*50 + CAST(l_quantity AS BIGINT)*10 AS end_pos,
        concat('cluster', l_orderkey % 10, '_contig_', l_orderkey % 97) AS contig, (l_linenumber-1)*10 AS mapq,
        CASE WHEN l_linestatus='O' THEN '+' ELSE '-' END AS strand, concat('S', l_orderkey % 8) AS sample,
        CASE WHEN l_returnflag='A' THEN 'HiFi' ELSE 'CLR' END AS tech,
        CASE WHEN l_orderkey % 16 < 8 THEN 10 ELSE 20 END AS hap FROM lineitem""",
    "regions": """SELECT concat('chr', p_partkey % 5 + 1) AS chrom, p_partkey*50 + p_size AS start_pos,
        p_partkey*50 + p_size*5 + 101 AS end_pos, concat('R', p_partkey) AS name,
        CAST(floor(p_retailprice) AS BIGINT) % 1000 AS score, p_type AS cls FROM part""",
    "roi": """SELECT concat('chr', p_partkey % 5 + 1) AS chrom, p_partkey*50 AS start_pos, p_partkey*50 + 61 + p_size*2 AS end_pos,
        concat('ROI', p_partkey) AS name FROM part""",
    "chroms": """SELECT concat('chr', r_regionkey + 1) AS chrom, (SELECT count(*) FROM part)*50 + 2000 AS size FROM region""",
    "samples": """SELECT concat('S', s_suppkey) AS sample, CASE WHEN s_suppkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex,
        r_name AS super_pop, n_name AS population, concat('F', s_suppkey % 3) AS family
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "calls": """SELECT concat('chr', o_custkey % 5 + 1) AS chrom, o_orderkey*7 + 1 AS pos,
        CAST(floor(o_totalprice/5000) AS BIGINT) AS qual,
        CASE WHEN o_orderpriority LIKE '1%' THEN 'ins' WHEN o_orderpriority LIKE '2%' THEN 'del' ELSE 'snv' END AS vtype,
        CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN o_orderkey % 50 + 1 ELSE 1 END AS vlen,
        CASE o_orderstatus WHEN 'F' THEN '1/1' WHEN 'O' THEN '0/1' ELSE './.' END AS gt, o_custkey % 30 AS depth,
        concat('S', o_custkey % 8) AS sample FROM orders""",
    "calls_b": """SELECT concat('chr', o_custkey % 5 + 1) AS chrom,
        o_orderkey*7 + 1 + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS pos, o_orderkey % 2 AS is_highconf
        FROM orders""",
    "trio": """SELECT l_orderkey, l_linenumber, l_partkey,
        CASE l_partkey % 4 WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' WHEN 2 THEN '1/1' ELSE './.' END AS child,
        CASE l_suppkey % 4 WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' WHEN 2 THEN '1/1' ELSE './.' END AS mother,
        CASE l_orderkey % 4 WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' WHEN 2 THEN '1/1' ELSE './.' END AS father,
        CAST(l_quantity AS BIGINT) AS vlen, l_returnflag AS region_type, l_linestatus AS vtype FROM lineitem""",
    "reads": """SELECT concat('read', doc_id) AS name, text AS seq, length(text) AS len, source AS lib, doc_id % 6 AS colour FROM documents""",
    "tags": """SELECT concat('read', doc_id) AS name, CASE WHEN toxic = 1 THEN 'none' WHEN quality = 1 THEN 'H1' ELSE 'H2' END AS haplotype,
        doc_id % 7 AS phaseset, concat('chr', doc_id % 5 + 1) AS chrom FROM labels""",
    "track": """SELECT concat('chr', user_id % 5 + 1) AS chrom, event_id*10 AS start_pos, event_id*10 + 10 AS end_pos,
        value AS depth FROM events""",
    "agp": """SELECT CASE WHEN l_linenumber <= 5 THEN concat('Super-Scaffold_', l_suppkey) ELSE concat('ctg', l_partkey, '_obj') END AS object,
        concat('ctg', l_partkey) AS contig, CAST(l_quantity AS BIGINT)*1000 AS comp_length, l_orderkey AS ord FROM lineitem""",
    "sv": """SELECT concat('chr', p_partkey % 5 + 1) AS chrom, p_partkey*50 AS start_pos, p_partkey*50 + 100 + p_size*20 AS end_pos,
        concat('BNG', p_partkey) AS name, CASE WHEN p_partkey % 3 = 0 THEN 'DEL' ELSE 'INS' END AS svtype, p_size % 7 AS num_samples FROM part""",
    "vcf": """SELECT chrom, pos, concat('v', pos) AS id,
        CASE vtype WHEN 'del' THEN concat('A', repeat('G', CAST(vlen AS INTEGER))) ELSE 'A' END AS ref,
        CASE WHEN vtype = 'ins' THEN concat('A', repeat('C', CAST(vlen AS INTEGER))) WHEN vtype = 'del' THEN 'A' WHEN depth % 7 = 0 THEN 'T,G' ELSE 'T' END AS alt,
        CAST(qual AS DOUBLE) AS qual, CASE WHEN depth % 11 = 1 THEN 'PASS;dn' WHEN depth % 13 = 2 THEN 'dp' ELSE 'PASS' END AS filter,
        concat('DP=', depth, ';LEN=', vlen, ';TYPE=', CASE vtype WHEN 'snv' THEN 'snp' ELSE vtype END) AS info, 'GT:GQ:DP' AS format,
        concat(gt, ':', depth, '.5:', depth) AS call, sample FROM calls""",
    "pieces": """SELECT object, CASE WHEN l_partkey % 2 = 0 THEN concat(contig, '_subseq_', ord, ':', ord + comp_length) ELSE contig END AS comp_name, 'W' AS comp_type,
        comp_length, ord FROM (SELECT *, CAST(replace(contig, 'ctg', '') AS BIGINT) AS l_partkey FROM agp) x""",
    "contig_aln": """SELECT concat('ctg', CAST(start_pos / 50 AS BIGINT)) AS contig, CASE chrom WHEN 'chr3' THEN 'chrUn_x' WHEN 'chr4' THEN 'chrX' WHEN 'chr5' THEN 'chrY_r' ELSE chrom END AS chrom,
        start_pos, end_pos, mapq FROM aln""",
    "layout": """SELECT concat('Super-Scaffold_', ok) AS scaffold, concat('ctg', ok, '_', ln) AS contig, ln AS ord, len AS length, ok,
        CAST(coalesce(sum(len + 50) OVER (PARTITION BY ok ORDER BY ln ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_pos,
        CAST(sum(len + 50) OVER (PARTITION BY ok) AS BIGINT) AS scaffold_length
        FROM (SELECT l_orderkey AS ok, l_linenumber AS ln, CAST(max(l_quantity) AS BIGINT)*20 AS len FROM lineitem GROUP BY l_orderkey, l_linenumber) x""",
    "scf_aln": """SELECT scaffold, contig, ord AS order_number, concat('chr', (ok + CASE WHEN ok % 17 = 0 THEN ord % 2 ELSE 0 END) % 5 + 1) AS chrom, spot AS start_pos,
        spot + CASE WHEN ok % 13 = 0 THEN 10 ELSE length END AS end_pos, CAST(ok % 7 * 10 AS INTEGER) AS mapq, CASE WHEN (ok + ord) % 4 < 2 THEN '+' ELSE '-' END AS strand,
        CASE WHEN ok % 2 = 0 THEN 'HiFi' ELSE 'CLR' END AS tech, concat('S', ok % 8) AS sample
        FROM (SELECT *, ok * 100 + CASE WHEN ok % 3 = 0 THEN scaffold_length - start_pos - length ELSE start_pos END + CASE WHEN ok % 7 = 0 AND ord = 2 THEN 50000 ELSE 0 END
          + CASE WHEN ok % 11 = 0 THEN ord * 4000 ELSE 0 END AS spot FROM layout) y""",
}
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
_TABLE = re.compile(r"\b(FROM|JOIN) (" + "|".join(TABLES) + r")\b")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Source:
    """The given tables and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Run a SELECT in which tables and views are named plainly."""
        names = [v for v in VIEWS if re.search(rf"\b(?:FROM|JOIN) {v}\b", text)]
        frames = {v: getattr(self, v) for v in names}
        frames.update({t: self.table(t) for _, t in _TABLE.findall(text)})
        for name in frames:
            text = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", text)
        return self.spark.sql(text, **frames)

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.sql(VIEWS[name])
        raise AttributeError(name)


def oracle_text(sql: str) -> str:
    """Put the views the text names in front of it as common table expressions."""
    named = lambda text: [v for v in VIEWS if re.search(rf"\b(?:FROM|JOIN) {v}\b", text)]
    wanted, todo = set(), named(sql)
    while todo:
        v = todo.pop()
        if v not in wanted:
            wanted.add(v)
            todo += named(VIEWS[v])
    used = [f"{v} AS ({VIEWS[v]})" for v in VIEWS if v in wanted]
    if not used:
        return sql
    head = sql.lstrip()
    for word in ("WITH RECURSIVE ", "WITH "):
        if head.startswith(word):
            return f"{word}{', '.join(used)}, {head[len(word):]}"
    return f"WITH {', '.join(used)} {head}"


def query(name: str, sql: str | None = None):
    """Register ``plan(Source) -> DataFrame`` under ``name``."""

    def add(plan: Callable[[Source], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: plan(Source(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle_text(sql)
        return plan

    return add

"""Stand-in relations over the driver's tables, in SQL that Spark and DuckDB both read.

The driver has no repeat loci; these derive some. Measures are whole numbers (``_c`` hundredths, ``_d`` tenths), so that sums are
exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LOCI = """
SELECT concat('ent', CAST(l_suppkey % 4 AS STRING)) AS entry_id,
 concat('ctg', CAST(l_suppkey % 10 AS STRING)) AS source_seq,
 CAST(l_orderkey * 1000 + l_linenumber * 10 AS BIGINT) AS start_pos,
 CAST(l_orderkey * 1000 + l_linenumber * 10 + (140 + (l_partkey * l_partkey) % 211) * CAST(l_quantity AS BIGINT) AS BIGINT) AS end_pos,
 CAST(140 + (l_partkey * l_partkey) % 211 AS INT) AS period,
 CAST(CAST(l_quantity AS BIGINT) * CAST(l_quantity AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT) AS BIGINT) AS copy_number_c,
 CAST(100 - CAST(round(l_discount * 100) AS BIGINT) AS BIGINT) AS percent_match,
 CAST(round(l_tax * 100) AS BIGINT) AS entropy_c,
 substr(translate(md5(CAST(l_partkey % 97 AS STRING)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 32) AS consensus
FROM lineitem
"""

HITS = """
SELECT concat('ctg', CAST(o_custkey % 10 AS STRING)) AS seqname,
 CAST(o_orderkey * 1000 + o_custkey % 700 AS BIGINT) AS start0,
 CAST(o_orderkey * 1000 + o_custkey % 700 + 200 + (o_custkey % 1900) * 10 AS BIGINT) AS end0,
 concat('SAT', CAST(150 + o_custkey % 50 AS STRING), '_a#', CASE WHEN o_orderpriority LIKE '1%' THEN 'Simple_repeat' ELSE 'Satellite' END) AS name,
 CAST(round(o_totalprice) AS BIGINT) AS sw_score,
 CASE WHEN o_orderstatus = 'F' THEN 'C' ELSE '+' END AS rm_strand
FROM orders
"""

CLUSTERS = """
SELECT concat('ent', CAST(p_partkey % 4 AS STRING)) AS entry_id,
 concat('ind', CAST(p_partkey % 2 AS STRING)) AS individual,
 CASE WHEN p_partkey % 4 < 2 THEN 'asmA' ELSE 'asmB' END AS assembly_method,
 concat('ent', CAST(p_partkey % 4 AS STRING), '__cand', CAST(150 + p_size AS STRING), '_p', CAST(p_partkey AS STRING)) AS cluster_uid,
 p_brand AS brand, CAST(150 + p_size AS INT) AS consensus_length,
 CAST(round(p_retailprice * 10) AS BIGINT) AS total_copy_number_d
FROM part
"""

EDGES = """
SELECT a.cluster_uid AS label_a, b.cluster_uid AS label_b FROM clusters a JOIN clusters b
 ON a.brand = b.brand AND abs(a.consensus_length - b.consensus_length) <= 3 AND a.cluster_uid < b.cluster_uid
"""
#: The same pairs by kind: clusters of one brand and length are linked with each other and with the same others. (A cluster without either is a kind of its own.)
KINDS = "SELECT *, coalesce(concat(brand, ':', CAST(consensus_length AS STRING)), cluster_uid) AS kind FROM {c}"
KIND_EDGES = """
SELECT a.kind AS label_a, b.kind AS label_b FROM (SELECT DISTINCT brand, consensus_length, kind FROM {k}) a JOIN (SELECT DISTINCT brand, consensus_length, kind FROM {k}) b
 ON a.brand = b.brand AND abs(a.consensus_length - b.consensus_length) <= 3 AND a.kind < b.kind
"""


#: Hits of a search with labels as queries. (order, line) pairs repeat, so the number of a line also holds its part and supplier.
HIT_ROWS = """
SELECT CAST(((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 1000 + l_suppkey % 1000 AS BIGINT) AS line_no, CAST(round(l_extendedprice) AS INT) AS sw_score,
 concat('SAT', CAST(l_partkey AS STRING)) AS query_label, CAST(1 + l_orderkey % 40 AS BIGINT) AS query_start,
 CAST(1 + l_orderkey % 40 + 10 * CAST(l_quantity AS BIGINT) AS BIGINT) AS query_end, CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS strand,
 concat('REP', CAST(l_suppkey % 7 AS STRING)) AS repeat_name, 'Satellite' AS repeat_class_family, CAST(1 + l_suppkey % 20 AS BIGINT) AS repeat_begin,
 CAST(1 + l_suppkey % 20 + 5 * CAST(l_quantity AS BIGINT) AS BIGINT) AS repeat_end, CAST(l_partkey % 90 AS BIGINT) AS repeat_left,
 '1.0' AS pct_divergence, '0.0' AS pct_deleted, '0.0' AS pct_inserted
FROM lineitem
"""

TABLES = {"loci": ("lineitem", LOCI), "hits": ("orders", HITS), "clusters": ("part", CLUSTERS)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``loci``, ``hits``, ``clusters`` or ``edges``; ``kinds``: the clusters with their kind, ``kind_edges``: the edges between kinds."""
    if name == "kinds":
        return spark.sql(KINDS, c=view(spark, sf_dir, "clusters"))
    if name == "kind_edges":
        return spark.sql(KIND_EDGES, k=view(spark, sf_dir, "kinds"))
    if name == "edges":
        return spark.sql(EDGES.replace("clusters a", "{c} a").replace("clusters b", "{c} b"), c=view(spark, sf_dir, "clusters"))
    source, text = TABLES[name]
    return spark.sql(text.replace(f"FROM {source}", "FROM {t}"), t=table(spark, sf_dir, source))


def ctes(*names: str) -> str:
    """The views as common table expressions, for a WITH clause."""
    texts = {"loci": LOCI, "hits": HITS, "clusters": CLUSTERS, "edges": EDGES}
    return ", ".join(f"{n} AS ({texts[n].strip()})" for n in names)

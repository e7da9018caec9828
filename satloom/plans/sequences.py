"""Queries that compare and cluster sequences of real length: units of 150 to 210 letters, turned, on either strand and doubled, in numbers that grow with the tables.

What is planted is exact, so that SQL can say what must come out without aligning anything.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satloom.operators import pairs, peeling
from satloom.params import Comparing, Peeling
from satloom.plans.views import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def registered(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return registered


def _letters(key: str, n: str) -> str:
    """SQL of ``n`` letters (at most 224) that follow from ``key``."""
    parts = ", ".join(f"md5(concat(CAST({key} AS STRING), ':{i}'))" for i in range(7))
    return f"substr(translate(concat({parts}), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, {n})"


#: Four benchmark items have one unit: as it is, turned by 40 letters, on the other strand, and twice.
UNITS = f"""
SELECT g, v, concat('u', CAST(item_id AS STRING)) AS label, CASE v WHEN 0 THEN unit WHEN 1 THEN concat(substr(unit, 41, 300), substr(unit, 1, 40))
  WHEN 2 THEN translate(reverse(unit), 'ACGT', 'TGCA') ELSE concat(unit, unit) END AS seq
FROM (SELECT item_id, g, v, {_letters("g", "CAST(150 + g * 37 % 61 AS INT)")} AS unit
  FROM (SELECT item_id, CAST(floor(item_id / 4) AS BIGINT) AS g, item_id % 4 AS v FROM benchmark))
"""
#: Orders as loci of four entries: half of an entry's are turned copies of one unit, three tenths of a second and a fifth of a third, on both strands.
COPIES = f"""
SELECT entry_id, row_id, k, CASE WHEN row_id % 3 = 0 THEN translate(reverse(ring), 'ACGT', 'TGCA') ELSE ring END AS seq, unit
FROM (SELECT entry_id, row_id, k, unit, concat(substr(unit, CAST(1 + row_id % 171 AS INT), 200), substr(unit, 1, CAST(row_id % 171 AS INT))) AS ring
  FROM (SELECT entry_id, row_id, k, {_letters("concat(entry_id, 'k', CAST(k AS STRING))", "171")} AS unit
    FROM (SELECT concat('ent', CAST(o_custkey % 4 AS STRING)) AS entry_id, CAST(o_orderkey AS BIGINT) AS row_id, CASE WHEN o_orderkey % 10 < 5 THEN 0 WHEN o_orderkey % 10 < 8 THEN 1 ELSE 2 END AS k FROM orders)))
"""


@query(f"""WITH u AS ({UNITS}) SELECT a.label AS label_a, b.label AS label_b, length(a.seq)::INT AS len_a, length(b.seq)::INT AS len_b, CASE WHEN a.g = b.g THEN 1.0 ELSE 0.0 END AS coverage,
 CASE WHEN a.g = b.g THEN 1.0 END AS mean_copy_identity, CASE WHEN a.g <> b.g THEN 0 WHEN b.v = 3 THEN 2 ELSE 1 END::INT AS n_copies_found
 FROM u a JOIN u b ON length(a.seq) < length(b.seq) OR (length(a.seq) = length(b.seq) AND a.label < b.label)""")
def tile_units(spark, d):
    """All pairs of the benchmark's units: copies of one unit tile each other wholly, whatever their turn, strand and number, and no others do."""
    units = spark.sql(UNITS.replace("FROM benchmark", "FROM {t}"), t=table(spark, d, "benchmark"))
    found = pairs.compare(units.select(F.col("label").alias("ord"), "label", "seq"), Comparing(n_shuffles=0))
    return found.select("label_a", "label_b", "len_a", "len_b", "coverage", "mean_copy_identity", "n_copies_found")


@query(f"""WITH u AS ({UNITS}) SELECT a.label AS label_a, b.label AS label_b, 0 AS null_passes, 'tested' AS null_status, b.v <> 3 AS flag_similar, b.v = 3 AS flag_multiple_of
 FROM u a JOIN u b ON a.g = b.g AND (length(a.seq) < length(b.seq) OR (length(a.seq) = length(b.seq) AND a.label < b.label))""")
def flagged_units(spark, d):
    """The pairs that pass, with the default twenty shuffles, none of which tiles a unit's copy."""
    units = spark.sql(UNITS.replace("FROM benchmark", "FROM {t}"), t=table(spark, d, "benchmark"))
    found = pairs.compare(units.select(F.col("label").alias("ord"), "label", "seq"))
    return found.where("flag_similar OR flag_multiple_of").select("label_a", "label_b", "null_passes", "null_status", "flag_similar", "flag_multiple_of")


@query(f"""WITH c AS ({COPIES}), n AS (SELECT entry_id, k, count(*) AS n, min(row_id) AS f FROM c GROUP BY ALL)
 SELECT entry_id, CAST(row_number() OVER (PARTITION BY entry_id ORDER BY n DESC, f) AS INT) AS rank, n AS n_input_sequences, 171 AS consensus_length, true AS is_unit FROM n WHERE n >= 3""")
def peel_copies(spark, d):
    """Clusters of thousands of loci of 171 letters, each turned its own way, with the default rounds; is_unit: the consensus is the planted unit, turned or not."""
    copies = spark.sql(COPIES.replace("FROM orders", "FROM {t}"), t=table(spark, d, "orders"))
    loci = copies.select("entry_id", F.lit("cand171").alias("motif"), F.lit(171).alias("target_period"), F.lit(5).alias("window"), "row_id", F.col("seq").alias("consensus"), F.lit(10.0).alias("copy_number"), F.lit(99.0).alias("percent_match"), F.lit(1.9).alias("entropy"))
    found = peeling.clusters(loci, Peeling())
    units = copies.select("entry_id", "unit").distinct()
    ring = F.concat("unit", "unit")
    inside = F.contains(ring, F.col("consensus")) | F.contains(F.translate(F.reverse(ring), "ACGT", "TGCA"), F.col("consensus"))
    same = found.join(units, "entry_id").groupBy("entry_id", "rank", "n_input_sequences", "consensus_length").agg(F.bool_or(inside).alias("is_unit"))
    return same.select("entry_id", "rank", "n_input_sequences", "consensus_length", "is_unit")

"""Tables of a row a cluster are merged, not sent to every task; families are still those of the plain rules."""

import random

from pyspark.sql import functions as F

from satloom import shared
from satloom.operators import families, mis


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_few_rows_are_sent(spark, monkeypatch):
    rows = spark.range(100).toDF("k")
    assert "BroadcastHashJoin" in _plan(rows.join(shared.sent(rows.where("k < 5")), "k"))
    monkeypatch.setattr(shared, "MAX_SENT", 4)
    assert "BroadcastHashJoin" not in _plan(rows.join(shared.sent(rows.where("k < 5")), "k"))


def test_clusters_are_merged_with_their_names(spark):
    """This holds for the code before shared.sent as well: what it guards are the rows."""
    own = spark.range(2000).select(
        F.concat(F.lit("c"), "id").alias("cluster_uid"), F.concat(F.lit("e"), F.col("id") % 3).alias("entry_id"), (F.col("id") * 7 % 50).alias("n"),
        F.concat(F.lit("k"), F.col("id") % 40).alias("kind"), F.lit(171).alias("consensus_length"), F.lit("i").alias("individual"), F.lit("m").alias("assembly_method"),
        F.lit("u").alias("phasing_status"), F.lit(0.5).alias("gc_content"), F.col("id").cast("double").alias("total_copy_number"), F.concat(F.lit("l"), "id").alias("label"),
    )
    names = shared.checkpointed(families.named(families.resolve(own, mis.empty_edges(spark).toDF("label_a", "label_b"), "n", ["cluster_uid"], "kind"), own))
    found = families.summary(names, own)
    plan = _plan(found)
    assert "SortMergeJoin" in plan and found.count() == 2000
    clusters = {r["cluster_uid"]: r for r in own.collect()}
    best = {}
    for r in sorted(clusters.values(), key=lambda r: (-r["n"], r["entry_id"], r["cluster_uid"])):
        best.setdefault(r["kind"], r["cluster_uid"])
    assert {r["cluster_uid"]: r["winner"] for r in names.collect()} == {u: best[r["kind"]] for u, r in clusters.items()}


def test_leading_takes_the_least_of_all_parts_and_what_is_unknown_first(spark):
    rng = random.Random(3)
    rows = [(f"i{i}", (rng.choice([None, -1.0, 2.0]) if i % 4 else 5.0, f"t{rng.randrange(9)}{i}"), f"k{i % 7}") for i in range(90)]
    nodes = spark.createDataFrame(rows, "id string, prio struct<n: double, t: string>, kind string")
    want = nodes.groupBy("kind").agg(F.min(F.struct("prio", "id")).alias("n"))
    assert sorted(map(str, mis.leading(nodes).collect())) == sorted(map(str, want.select("kind", "n").collect()))

"""Global shuffle into shards by a two-pass external shuffle.

Pass one scatters whole records by seeded hashes into buckets sized for memory, one to a task; pass two permutes each bucket by
Fisher-Yates (Spark's ``shuffle`` of an array, which is that) and writes it. A shard is made of buckets one after another, so
a slot is the bucket's offset in its shard plus the position in the bucket. What enters the hashes is a record's content and, where
copies of a record are large beside a bucket, the number of the copy: never its place in the input, so that slots do not depend on the cluster.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from satloom.llm import common as C

#: Offsets (24 bytes each) that are sent to every task at most; more of them are joined by a shuffle.
MAX_SENT = 500_000
#: A record whose copies together fill more than this share of a bucket is frequent.
FREQUENT = 1 / 16
#: Copies of a frequent record, and bytes of them, that are made in one go.
COPIES, COPIED_BYTES = 10_000, 8 << 20


def rendezvous(key: Column, shards: int, seed: int) -> tuple[Column, Column]:
    """The shard of ``key`` among ``shards``, and among one more; both as columns.

    A key goes where its hash with the shard's number is highest, so one more shard takes keys only into itself.
    """
    tickets = [F.struct(F.xxhash64(F.lit(seed), key, F.lit(s)).alias("h"), F.lit(s).alias("s")) for s in range(shards + 1)]
    best = F.greatest(*tickets[:-1]) if shards > 1 else tickets[0]
    return best["s"], F.greatest(best, tickets[-1])["s"]


def _records(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id, text and hash of each row; and how many rows there are of each doc_id and hash, with their bytes."""
    rows = C.pick(docs, "doc_id", "text").withColumn("hash", F.xxhash64("text"))
    size = (F.octet_length(C.whole()) + 16).cast("long")
    keys = rows.groupBy("doc_id", "hash").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes"))
    return rows, C.stored(keys, f"{C.shared_dir(docs.sparkSession)}/keys")


def _copied(rows: DataFrame, keys: DataFrame, most: float) -> DataFrame:
    """``rows`` with ``copy``: 0, but for rows of frequent keys (more than ``most`` bytes of equal rows) 0 to n - 1 among equal ones.

    Equal rows may stand for each other. So those of a frequent key are first brought down to one (in partial aggregates) and then
    made again with their numbers, in many tasks. Other rows stay where they are.
    """
    often = keys.where((F.col("n") > 1) & (F.col("bytes") > most)).select(F.col("doc_id").alias("k"), F.col("hash").alias("h"))
    plain = rows.withColumn("copy", F.lit(0).cast("long"))
    n = often.count()
    if not n:
        return plain
    often = F.broadcast(often) if n <= MAX_SENT else often
    same = F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("hash") == F.col("h"))
    texts = rows.join(often, same, "left_semi").groupBy("doc_id", "hash", "text").agg(F.count(F.lit(1)).alias("n"))
    texts = texts.withColumn("step", F.greatest(F.lit(1), F.least(F.lit(COPIES), F.floor(COPIED_BYTES / (F.octet_length(C.whole()) + 16)))).cast("long"))
    begun = texts.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.col("step"))))
    begun = begun.repartition("doc_id", "hash", "from")
    made = begun.withColumn("copy", F.explode(F.sequence(F.col("from"), F.least(F.col("n"), F.col("from") + F.col("step")) - 1)))
    return plain.join(often, same, "left_anti").unionByName(made.select(*plain.columns))


def shuffled_shards(docs: DataFrame, shards: int = 40, seed: int = 11, bucket_mb: float = 16, path: str | None = None) -> DataFrame:
    """``docs`` written to ``path`` in shards, and read again: doc_id, text, shard, slot, grown_shard.

    Law ``key``: doc_id and the number of shards decide a row's shard; grown_shard is its shard if there were one more. A null
    doc_id is a key like any other, and rows of one doc_id share a shard. Repeated rows each get a slot of their
    own; null texts stay null; an empty table gives no rows. A bucket holds about ``bucket_mb`` MB of text (one row may exceed it), whatever
    share of the rows its shard has. The same rows give the same slots, however they lie and wherever they are run.
    """
    spark = docs.sparkSession
    path = path or f"{C.shared_dir(spark)}/shards"
    rows, keys = _records(docs)
    shard, grown = rendezvous(F.col("doc_id"), shards, seed)
    sizes = {r["shard"]: r["bytes"] for r in keys.groupBy(shard.alias("shard")).agg(F.sum("bytes").alias("bytes")).collect()}  # a row a shard
    counts = [max(1, math.ceil(sizes.get(s, 0) / (bucket_mb * (1 << 20)))) for s in range(shards)]
    first = list(itertools.accumulate(counts, initial=0))
    rows = _copied(rows, keys, FREQUENT * bucket_mb * (1 << 20)).withColumns({"shard": shard, "grown_shard": grown})
    draw = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "hash", "copy"), F.get(F.lit(counts), F.col("shard"))).cast("int")
    rows = rows.withColumn("bucket", F.get(F.lit(first), F.col("shard")) + draw).select("shard", "bucket", "doc_id", "text", "grown_shard")
    # One bucket a task: its number and its sorted rows make the draws of Fisher-Yates the same in every run and every retry.
    scattered = rows.repartitionById(first[-1], F.col("bucket")).sortWithinPartitions("bucket", "doc_id", "text")
    permuted = scattered.groupBy("shard", "bucket").agg(F.shuffle(F.collect_list(F.struct("doc_id", "text", "grown_shard")), F.lit(seed)).alias("r"))
    written = permuted.select("shard", "bucket", F.posexplode("r").alias("pos", "row"))
    written = written.select("shard", "bucket", "pos", "row.doc_id", "row.text", "row.grown_shard")
    kept = C.stored(written, path)
    upto = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = kept.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    ahead = ahead.select("bucket", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    ahead = F.broadcast(ahead) if first[-1] <= MAX_SENT else ahead
    return kept.join(ahead, "bucket").select("doc_id", "text", "shard", (F.col("before") + F.col("pos")).alias("slot"), "grown_shard")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffled_shards(C.documents(spark, sf_dir)).select(
        "doc_id",
        (F.octet_length(C.whole()) + 16).cast("long").alias("size"),
        F.crc32(C.whole().cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )

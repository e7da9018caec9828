"""Exact de-duplication against a persistent digest index.

The index is a table bucketed and sorted by the digest of the normalised text. A batch is first reduced to one row
for each digest (map-side partial aggregation, so that a text with a third of all rows costs one row a task). Those rows meet
the index in a sort-merge anti-join that does not move the index; what is new is appended, and the verdict on every digest is
read back from the index by a second sort-merge join.

Each row of the index knows the batch that brought it. A batch that is given again under its id (after a lost job, say) does not
meet itself as known, and appends only what it had not appended yet: its result is the same however often it runs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satloom.llm import common as C


class DigestIndex:
    """Digests seen so far, in the table ``name`` (bucketed and sorted by digest).

    digest: SHA-256 of the normalised text; keep_id: the row that stands for it; n: rows of the batch that brought it; batch: that
    batch. A table that the session's catalog lacks is created empty; give ``path`` to keep it in a folder of one's own and to open that again from
    another session. ``buckets`` should be such that one is sorted within a task's memory (32 bytes a digest).
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int = 12, path: str | None = None) -> None:
        self.spark, self.name, self.buckets = spark, name, buckets
        at = f" LOCATION '{path}'" if path else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT, n BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS{at}"
        )

    @property
    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, groups: DataFrame, batch: str | None = None) -> DataFrame:
        """Those of ``groups`` (a row for each digest) whose digest no other batch has brought."""
        known = self.table if batch is None else self.table.where(F.col("batch") != batch)
        return groups.join(known.select("digest").hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame, batch: str) -> None:
        """Adds ``groups`` (digest, keep_id, n) as brought by ``batch``; what it has brought already is passed over."""
        own = self.table.where(F.col("batch") == batch).select("digest")
        rows = groups.join(own.hint("merge"), "digest", "left_anti").select("digest", "keep_id", "n", F.lit(batch).alias("batch"))
        rows.repartition(self.buckets, "digest").write.insertInto(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def digests(docs: DataFrame, rid: str | None = None) -> DataFrame:
    """rid, doc_id and the SHA-256 of the text with A-Z lower-cased; null texts count as empty."""
    digest = F.unhex(F.sha2(C.lower_ascii(C.whole()).cast("binary"), 256))
    return C.keyed(docs, "doc_id", "text", rid=rid).select("rid", F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest"))


def exact_dedup(docs: DataFrame, index: DigestIndex, batch: str | None = None, rid: str | None = None) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, digest, keep_id, group_size, kept.

    Of rows with equal texts that of the largest doc_id stays (a null doc_id is the smallest; of fully repeated rows the last
    read). group_size counts the rows of the batch. A text that another batch brought before is kept in no row, and its keep_id
    is that of the index. Give ``batch``, an id, to be able to run a batch again; without one each call is a batch of its own. An
    empty table gives an empty result and leaves the index as it is. doc_id must be of an integer type (else TypeError); null
    texts count as empty; other columns of ``docs`` are not looked at. rid: see common.keyed. The result is stored
    before it is returned and outlives the index.
    """
    C.whole_number(docs, "doc_id")
    batch = batch or uuid.uuid4().hex
    at = C.shared_dir(docs.sparkSession)
    rows = C.stored(digests(docs, rid), f"{at}/digests").withColumn("place", C.place(F.col("doc_id"), F.col("rid"), -1))
    groups = rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.max("place").alias("last"), F.count(F.lit(1)).alias("n"))
    groups = C.stored(groups, f"{at}/groups")
    index.append(index.unseen(groups, batch), batch)
    known = index.table.select("digest", "keep_id", "batch").hint("merge")
    decided = groups.select("digest", "last", F.col("n").alias("group_size")).join(known, "digest")
    decided = decided.select("digest", "keep_id", "group_size", F.when(F.col("batch") == batch, F.col("last")).alias("last"))
    decided = C.stored(decided, f"{at}/decided")
    kept = F.coalesce(F.col("place") == F.col("last"), F.lit(False))
    return rows.join(decided, "digest").select("rid", "doc_id", "digest", "keep_id", "group_size", kept.alias("kept"))


def fresh_index(spark: SparkSession) -> DigestIndex:
    """An empty index in the shared folder, with as many buckets as the session's shuffles have partitions."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return DigestIndex(spark, f"satloom_digests_{uuid.uuid4().hex}", buckets, f"{C.shared_dir(spark)}/index")


def alone(docs: DataFrame, rid: str | None = None) -> DataFrame:
    """exact_dedup of ``docs`` as the only batch of an index, which is dropped again."""
    index = fresh_index(docs.sparkSession)
    try:
        return exact_dedup(docs, index, rid=rid)
    finally:
        index.drop()


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alone(C.documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP7_SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    rows = C.numbered(docs)
    return C.only(rows, alone(rows, C.ROW).where("kept"))

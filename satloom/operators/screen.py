"""The screens against known repeats and of genomes with the library."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from satloom.functions import exprs as X
from satloom.shared import checkpointed


def screen_queries(library: DataFrame, double: bool = True) -> DataFrame:
    """label and sequence that go to the search: what stands before ``#``, the consensus doubled if asked."""
    seq = F.col("consensus")
    return library.select(X.before_hash(F.col("header")).alias("label"), (X.doubled(seq) if double else seq).alias("seq"))


def best_hits(hits: DataFrame) -> DataFrame:
    """Of the hits of a label on a repeat, the one of highest score, the first of equals."""
    best = F.max_by(F.struct(*hits.columns), F.struct("sw_score", (-F.col("line_no")).alias("n"))).alias("h")
    return hits.groupBy("query_label", "repeat_name").agg(best).select("h.*")


def shares(true_length: Column) -> tuple[Column, Column]:
    """How much of a label of ``true_length`` a hit covers, and how much of its repeat's model."""
    span, model = F.col("query_end") - F.col("query_start") + 1, F.col("repeat_end") + F.col("repeat_left")
    query = F.when(true_length > 0, F.least(span, true_length) / true_length).otherwise(0.0)
    return query, F.when(model != 0, (F.col("repeat_end") - F.col("repeat_begin") + 1) / model).otherwise(0.0)


def known_hits(labels: DataFrame, hits: DataFrame, doubled: bool = True) -> DataFrame:
    """Every label (label, length) with its best hit on each repeat, or one row of nulls; overlaps as shares of both sides."""
    true = F.when(F.lit(doubled), F.floor(F.col("length") / 2)).otherwise(F.col("length"))
    rows = labels.withColumn("true_length", true).join(best_hits(hits), F.col("label") == F.col("query_label"), "left")
    query, known = shares(F.col("true_length"))
    hit = F.col("query_label").isNotNull()
    return rows.select(
        "label", hit.alias("has_known_hit"), "repeat_name", "repeat_class_family", "sw_score", "pct_divergence", "pct_deleted", "pct_inserted",
        "query_start", "query_end", "strand", F.when(hit, query).alias("pct_query_covered"), F.when(hit, known).alias("pct_known_repeat_covered"),
        F.when(hit, F.least(query, known)).alias("reciprocal_overlap"),
    )


def ranked_hits(found: DataFrame) -> DataFrame:
    """``found`` (known_hits) with ``place``: a label's hits by falling score, of equal scores by name."""
    order = Window.partitionBy("label").orderBy(F.desc("sw_score"), "repeat_name")
    return found.withColumn("place", F.row_number().over(order))


def pending(samples: DataFrame, done: DataFrame, library_sha256: str) -> DataFrame:
    """Samples that were not screened with this very library yet."""
    wanted = samples.withColumn("lib_sha256", F.lit(library_sha256))
    return wanted.join(done.select("sample", "lib_sha256"), ["sample", "lib_sha256"], "left_anti")


def snapshot(library: DataFrame, folder: str) -> str:
    """The digest of ``library`` (header, consensus), which is kept under it in ``folder``; one that is there already stays."""
    digest = library_digest(library).first()["lib_sha256"]
    library.select("header", "consensus").write.mode("ignore").parquet(f"{folder}/library/{digest}")
    return digest


DONE = "sample string, lib_sha256 string"


def completed(spark: SparkSession, folder: str) -> DataFrame:
    """(sample, lib_sha256) of the screens that are done; reading writes nothing."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/completed")
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], DONE)
    return spark.read.schema(DONE).parquet(f"{folder}/completed")


def complete(samples: DataFrame, library_sha256: str, folder: str) -> None:
    """Notes that ``samples`` are screened with this library; those noted before are passed over."""
    new = pending(samples, completed(samples.sparkSession, folder), library_sha256)
    checkpointed(new.select("sample", "lib_sha256")).write.mode("append").parquet(f"{folder}/completed")


def library_digest(library: DataFrame) -> DataFrame:
    """lib_sha256 over all records in order of their headers: it changes if and only if the library does.

    Records are hashed each for itself first; only 64 characters a family meet in the last step.
    """
    each = library.select("header", F.sha2(F.concat_ws("\n", "header", "consensus"), 256).alias("h"))
    return each.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("header", "h"))), lambda x: x["h"]), ""), 256).alias("lib_sha256"))


def colliding_samples(samples: DataFrame) -> DataFrame:
    """Samples that stand for more than one assembly; must be empty."""
    return samples.groupBy("sample").agg(F.countDistinct("fasta").alias("n")).where("n > 1")

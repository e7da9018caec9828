"""From loci to candidate periods: windows of periods, rules, and suppression of neighbouring ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satloom.operators.mis import priority_mis
from satloom.params import Scan


def centres(loci: DataFrame, how: Scan) -> DataFrame:
    """The periods of each entry that may become bins."""
    return loci.where(F.col("period") >= how.min_period_length).select("entry_id", "period").distinct()


def spread(bins: DataFrame, width: Column | int) -> DataFrame:
    """``bins`` with a row for each period within ``width`` of theirs, in ``locus_period``: so that band joins are equi-joins."""
    w = F.lit(width) if isinstance(width, int) else width
    return bins.withColumn("locus_period", F.explode(F.sequence(F.col("period") - w, F.col("period") + w)))


def window_scan(loci: DataFrame, how: Scan = Scan(), copies: str = "copy_number") -> DataFrame:
    """Counts and sums over all loci within the window of each centre, loci of short periods included; and the rules.

    Loci are first brought down to one row for each entry, period and sequence, in partial aggregates that need no
    shuffle of loci by window; only those sums meet the centres.
    """
    near = loci.groupBy("entry_id", "period", "source_seq").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(copies).alias("max_cn"),
        F.sum(F.when(F.col(copies) >= how.min_copy_number, 1).otherwise(0)).alias("n_ge"),
        F.sum(F.col("end_pos") - F.col("start_pos")).alias("bp"),
        F.sum("percent_match").alias("match"),
        F.sum("entropy").alias("entropy"),
    )
    near = near.withColumnRenamed("period", "locus_period")
    joined = spread(centres(loci, how), how.window).join(near, ["entry_id", "locus_period"])
    per = joined.groupBy("entry_id", "period").agg(
        F.sum("n").alias("n_blocks"), F.max("max_cn").alias("max_copy_number"), F.sum("n_ge").alias("n_loci_ge_min_copy_number"),
        F.countDistinct("source_seq").alias("n_distinct_source_seqs"), F.sum("bp").alias("total_array_bp"),
        F.sum("match").alias("match"), F.sum("entropy").alias("entropy"),
    )
    spread_rule = (F.col("max_copy_number") >= how.min_copy_number) & (F.col("n_blocks") >= how.min_blocks)
    single = F.col("max_copy_number") >= how.min_single_block_copy_number
    return per.select(
        "entry_id", "period", F.lit(how.window).alias("window"), "n_blocks", "max_copy_number", "n_loci_ge_min_copy_number", "n_distinct_source_seqs",
        (F.col("total_array_bp") / F.col("n_blocks")).alias("mean_array_length_bp"), "total_array_bp",
        (F.col("match") / F.col("n_blocks")).alias("mean_percent_match"), (F.col("entropy") / F.col("n_blocks")).alias("mean_entropy"),
        spread_rule.alias("passes_distributed"), single.alias("passes_single_block"), (spread_rule | single).alias("passes_filters"),
    )


def ranked(scan: DataFrame) -> DataFrame:
    """``rk`` by entry: the order in which suppression takes periods, best first."""
    order = Window.partitionBy("entry_id").orderBy(
        F.desc("passes_single_block"), F.desc("n_loci_ge_min_copy_number"), F.desc("total_array_bp"), F.desc("max_copy_number"), "period"
    )
    return scan.withColumn("rk", F.row_number().over(order))


def suppressed(scan: DataFrame, radius: int) -> DataFrame:
    """The surviving periods of ``scan`` (filters not applied) with the range of periods that each stands for."""
    nodes = ranked(scan).withColumn("id", F.struct("entry_id", "period"))
    own = nodes.select("entry_id", "period")
    pairs = spread(own, radius).where("locus_period > period").join(own.withColumnRenamed("period", "locus_period"), ["entry_id", "locus_period"])
    edges = pairs.select(F.struct("entry_id", "period").alias("a"), F.struct("entry_id", F.col("locus_period").alias("period")).alias("b"))
    outcome = priority_mis(nodes.select("id", F.col("rk").alias("prio")), edges)
    groups = outcome.groupBy("winner_id").agg(
        F.min("id.period").alias("low"), F.max("id.period").alias("high"), (F.count(F.lit(1)) - 1).alias("n_periods_suppressed")
    )
    found = groups.select(
        F.col("winner_id.entry_id").alias("entry_id"), F.col("winner_id.period").alias("period"),
        F.concat(F.col("low").cast("string"), F.lit("-"), F.col("high").cast("string")).alias("suppressed_period_range"), "n_periods_suppressed",
    )
    return scan.join(found, ["entry_id", "period"])


def candidate_bins(loci: DataFrame, how: Scan = Scan(), copies: str = "copy_number") -> DataFrame:
    """entry_id, motif, period and window of the bins: survivors that pass a rule."""
    kept = suppressed(window_scan(loci, how, copies), how.radius).where("passes_filters")
    motif = F.concat(F.lit(how.name_prefix), F.col("period").cast("string"))
    return kept.select("entry_id", motif.alias("motif"), "period", F.lit(how.window).alias("window"))


def extract(loci: DataFrame, bins: DataFrame) -> DataFrame:
    """Each locus with each bin of its entry whose window holds its period; one pass for all bins."""
    at = spread(bins, F.col("window")).withColumnRenamed("period", "target_period")
    return loci.withColumn("locus_period", F.col("period")).join(at, ["entry_id", "locus_period"]).drop("locus_period")

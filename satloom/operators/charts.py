"""The data of the charts: histograms, scatters, ranked bars. Drawing them is left to the reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def log_histogram(df: DataFrame, value: str, bins: int, *by: str) -> DataFrame:
    """bin (0 to bins - 1), its edges and how many values are in it, on a logarithmic scale between least and largest.

    The last bin holds its upper edge. Values that are not positive are an error; without values there are no bins.
    """
    x = F.when(F.col(value) > 0, F.log10(value)).otherwise(F.raise_error(F.lit("a logarithmic scale needs positive values")))
    rows = df.select(*by, x.alias("x")).where("x IS NOT NULL")
    ends = rows.agg(F.min("x").alias("low"), F.max("x").alias("high"))
    low, high = ends.first()
    if low is None:
        low = high = 0.0
    width = (high - low) / bins or 1.0
    place = F.least(F.lit(bins - 1), F.floor((F.col("x") - low) / width).cast("int"))
    counts = rows.groupBy(place.alias("bin"), *by).agg(F.count(F.lit(1)).alias("n"))
    edge = lambda k: F.pow(F.lit(10.0), F.lit(low) + k * width)
    return counts.select("bin", *by, edge(F.col("bin")).alias("from_value"), edge(F.col("bin") + 1).alias("to_value"), "n")


def top_families(rows: DataFrame, n: int, *by: str) -> DataFrame:
    """The ``n`` families of highest copy number, for each group in ``by`` if any: final_name, copy number, place."""
    best = rows.groupBy(*by, "final_name").agg(F.max("source_copy_number").alias("max_copy_number"))
    order = Window.partitionBy(*by).orderBy(F.desc("max_copy_number"), "final_name")
    if not by:
        best = best.orderBy(F.desc("max_copy_number"), "final_name").limit(n)
    return best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def recurrence_points(summary: DataFrame) -> DataFrame:
    """One point a family: copy number against the individuals and entries that have it."""
    return summary.where("is_representative").select("final_name", "motif_length", "source_copy_number", "n_individuals_present", "n_entries_found")


def quality_points(clusters: DataFrame, min_total_copy_number: float) -> DataFrame:
    """One point a cluster: copy number against match, entropy and GC, and whether it passes the filter."""
    return clusters.select(
        "entry_id", "label", "total_copy_number", "mean_percent_match", "mean_entropy", "gc_content",
        (F.col("total_copy_number") >= min_total_copy_number).alias("passes"),
    )


def below(clusters: DataFrame, min_total_copy_number: float) -> DataFrame:
    return clusters.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("total_copy_number") < min_total_copy_number).alias("n_below"))

"""The workflows end to end: discovery of families, the screen against known repeats, and the screen of genomes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from satloom.functions.exprs import shard_index
from satloom.operators import bins, families, intervals, pairs, peeling, screen
from satloom.params import Params
from satloom.shared import checkpointed
from satloom.sources import text_formats as T

TIES = ("neg_n", "target_period", "rank")


@dataclass(frozen=True)
class Discovery:
    bins: DataFrame
    clusters: DataFrame
    pooled: DataFrame
    pairs: DataFrame
    summary: DataFrame
    library: DataFrame


def loci_of(spark: SparkSession, entries: DataFrame) -> DataFrame:
    """All loci of all entries, with their entry; the manifest is small and its paths are listed on the driver."""
    files = [(r["entry_id"], p) for r in entries.orderBy("entry_id").collect() for p in r["trf_dat_paths"]]
    lines = T.numbered_lines(spark, [p for _, p in files])
    owner = spark.createDataFrame([(i, e) for i, (e, _) in enumerate(files)], "file_idx int, entry_id string")
    return T.trf_loci(lines).join(owner, "file_idx")


def discover(loci: DataFrame, entries: DataFrame, params: Params = Params()) -> Discovery:
    """Families of ``loci`` (schemas.LOCI and entry_id). No loci give empty relations everywhere."""
    loci = checkpointed(loci.withColumn("row_id", (F.col("file_idx").cast("long") * (1 << 40)) + F.col("line_no")))
    found_bins = checkpointed(bins.candidate_bins(loci, params.scan))
    binned = bins.extract(loci, found_bins).where("consensus IS NOT NULL")
    found = checkpointed(peeling.clusters(checkpointed(binned), params.peeling))
    pool = peeling.pooled(found, entries, params.min_total_copy_number)
    pool = checkpointed(pool.withColumn("neg_n", -F.col("n_input_sequences")))
    order = F.struct("entry_id", *TIES)
    compared = checkpointed(pairs.compare(pool.select(order.alias("ord"), F.col("cluster_uid").alias("label"), F.upper("consensus").alias("seq")), params.comparing))
    resolved = families.resolve(pool, pairs.flagged(compared), "total_copy_number", TIES)
    names = checkpointed(families.named(resolved, pool))
    return Discovery(found_bins, found, pool, compared, families.summary(names, pool), families.library(names, pool, params.classification))


def known_screen(library: DataFrame, hits: DataFrame, double: bool = True) -> DataFrame:
    queries = screen.screen_queries(library, double)
    return screen.known_hits(queries.select("label", F.length("seq").alias("length")), hits, double)


@dataclass(frozen=True)
class GenomeScreen:
    regions: DataFrame
    missing: DataFrame
    recall: DataFrame


def genome_screen(loci: DataFrame, hits: DataFrame, params: Params = Params()) -> GenomeScreen:
    """Coverage of likely satellite regions by library hits; both have sample and seqname (loci 1-based, hits as BED)."""
    how = params.screening
    keys = ("sample", "seqname")
    regions = checkpointed(intervals.likely_regions(loci, how, keys))
    if how.family is not None:
        hits = hits.where(F.element_at(F.split("name", "#"), -1) == how.family)
    covered = checkpointed(intervals.region_coverage(regions, hits, keys, how.min_coverage_fraction))
    return GenomeScreen(covered, intervals.missing(covered), intervals.recall(covered))


def sharded(records: DataFrame, shards: int, keys: Sequence[str] = ("file_idx",)) -> DataFrame:
    """Records dealt forth and back over shards, in the order of their files. Records that know their place (text_formats.fasta_heads) are dealt where they
    lie; others are numbered by ``keys`` first."""
    if "place" not in records.columns:
        records = records.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("rec_no")))
        return records.withColumn("shard", shard_index(F.col("place"), shards)).drop("place")
    return records.withColumn("shard", shard_index(F.col("place"), shards))

"""The files that the workflows end in, and running them from a manifest.

    python -m satloom.plans.outputs manifest.tsv OUT [known_hits.out ...]

writes the families that the repeat tables of the manifest give: the library, the summary, all clusters, the pairs that were compared and, from hit tables of a
search of the library against known repeats, known_repeat_hits. Each is a folder of text parts in order (see sinks).
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satloom.functions import exprs as X
from satloom.operators import screen
from satloom.params import Params
from satloom.plans import workflows
from satloom.sources import sinks
from satloom.sources import text_formats as T

#: Columns of the exported tables; fixed, for other programs read them.
SUMMARY = (
    "final_name", "motif_length", "is_representative", "within_entry_consolidated_into", "source_entry_id", "source_cluster_label", "source_individual",
    "source_assembly_method", "source_phasing_status", "source_copy_number", "source_consensus_length", "source_gc_content", "n_entries_found", "entries_found",
    "n_individuals_present", "individuals_found", "n_methods_confirming", "methods_found",
)
PAIRS = ("label_a", "label_b", "len_a", "len_b", "length_ratio", "coverage", "mean_copy_identity", "n_copies_found", "null_passes", "flag_similar", "flag_multiple_of")


def write_discovery(found: workflows.Discovery, folder: str) -> None:
    """The library as FASTA in the order of its families; summary, clusters and pairs as tables."""
    sinks.write_fasta(found.library, f"{folder}/library.fasta", F.col("header"), "consensus", "g")
    sinks.write_tsv(found.summary.select(*SUMMARY, "g", "cluster_uid").select(*SUMMARY), f"{folder}/summary_table.tsv", "final_name", F.desc("is_representative"), "source_entry_id", "source_cluster_label")
    sinks.write_tsv(found.clusters.drop("consensus"), f"{folder}/all_clusters.tsv", "entry_id", "target_period", "rank")
    tested = F.coalesce(F.col("null_passes").cast("string"), F.when(F.col("null_status") == "skipped_high_confidence", F.col("null_status")))
    sinks.write_tsv(found.pairs.withColumn("null_passes", tested).select(*PAIRS), f"{folder}/cross_cluster_comparison.tsv", "label_a", "label_b")


def write_known(library: DataFrame, hits: DataFrame, folder: str, params: Params = Params()) -> None:
    """Every family with its known repeats, by falling score."""
    found = screen.ranked_hits(workflows.known_screen(library, hits, params.double_sequences))
    four = {c: X.fixed(F.col(c), 4) for c in ("pct_query_covered", "pct_known_repeat_covered", "reciprocal_overlap")}
    sinks.write_tsv(found.withColumns(four).drop("place"), f"{folder}/known_repeat_hits.tsv", "label", F.desc("sw_score"), "repeat_name")


def write_screen(found: workflows.GenomeScreen, screens: DataFrame, folder: str) -> None:
    """Coverage of all regions, those that the library misses, recall by sample and over all, and what the next pipeline takes."""
    four = lambda df, *names: df.withColumns({c: X.fixed(F.col(c), 4) for c in names})
    sinks.write_tsv(four(found.regions, "coverage_fraction"), f"{folder}/regions_with_coverage.tsv", "sample", "seqname", "start0")
    sinks.write_tsv(four(found.missing, "coverage_fraction"), f"{folder}/missing_regions.tsv", "sample", "seqname", "start0")
    sinks.write_tsv(four(found.recall, "overall_bp_recall", "region_recall"), f"{folder}/overall_coverage_summary.tsv", (F.col("sample") == "ALL").cast("int"), "sample")
    sinks.write_tsv(sinks.handoff(screens), f"{folder}/satellite_arrays_manifest.tsv", "sample")


def main(arguments: Sequence[str]) -> None:
    path, folder, *tables = arguments
    spark = SparkSession.builder.getOrCreate()
    entries = T.manifest(spark, path)
    found = workflows.discover(workflows.loci_of(spark, entries), entries)
    write_discovery(found, folder)
    if tables:
        write_known(found.library, T.rm_hits(T.numbered_lines(spark, T.existing(tables))), folder)


if __name__ == "__main__":
    main(sys.argv[1:])

"""From raw documents to packed training sequences: each stage works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from satloom.llm import common, dedup, mixing, packing, quality, simhash

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Folders that the last stage made for itself.
_last: list[str] = []


def _tidied(stage: Stage) -> Stage:
    """``stage``, which first deletes what the stage before it made for itself.

    What a stage returns still reads its tables, so they stay until it has been written; and a stage is called with what was written. Tables that ``docs`` reads
    all the same (a result that was not written) are left alone.
    """

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles()
        for folder in [f for f in _last if not any(f.rsplit("/", 1)[-1] in path for path in read)]:
            common.removed(spark, folder)
            _last.remove(folder)
        before = len(common.MADE)
        out = stage(spark, docs, sf_dir)
        _last.extend(common.MADE[before:])
        return out

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", _tidied(quality.stage)),
    ("exact dedup", _tidied(dedup.stage)),
    ("simhash near-dedup", _tidied(simhash.stage)),
    ("source mixing", _tidied(mixing.stage)),
    ("best-fit packing", _tidied(packing.stage)),
]

#: Models, links and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents in ``sf_dir``; what each stage keeps is a Parquet table in the shared folder."""
    at = common.shared_dir(spark)
    docs = common.documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = common.stored(stage(spark, docs, sf_dir), f"{at}/{i}")
    return docs

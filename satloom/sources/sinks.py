"""Exports. Tables stay Parquet inside the engine; these give the text files that people and other programs read.

An export is a folder of parts in order: rows are ranged over tasks by the order asked for, each task writes its range, and the parts' names rise with it. So
the parts one after another (``cat part-*``) are the file, and no task writes all of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ordered(df: DataFrame, order: tuple[str | Column, ...]) -> DataFrame:
    """``df`` sorted over all its parts. (Spark's global sort ranges rows over tasks by a sample; small results become one part.)"""
    return df.orderBy(*order) if order else df


def write_lines(df: DataFrame, path: str, line: Column, *order: str | Column, header: str | None = None) -> None:
    """``line`` of each row, sorted by ``order``; a header is a line of its own before all others."""
    keys = [(F.col(o) if isinstance(o, str) else o) for o in order]
    rows = df.withColumn("_line", line).withColumn("_kind", F.lit(1))
    if header is not None:
        first = df.sparkSession.range(1).select(F.lit(header).alias("_line"), F.lit(0).alias("_kind"))
        rows = rows.unionByName(first, allowMissingColumns=True)
    rows = _ordered(rows, ("_kind", *keys)) if order or header is not None else rows
    rows.select(F.col("_line").alias("value")).write.mode("overwrite").text(path)


def cells(df: DataFrame) -> Column:
    """A row as tab-separated fields: null as ``NA``, booleans as True and False, lists by semicolons."""
    text = lambda n, t: F.initcap(F.col(n).cast("string")) if t == "boolean" else F.concat_ws(";", F.col(n)) if t.startswith("array") else F.col(n).cast("string")
    return F.concat_ws("\t", *(F.coalesce(text(n, t), F.lit("NA")) for n, t in df.dtypes))


def write_tsv(df: DataFrame, path: str, *order: str | Column, header: bool = True) -> None:
    """Tab-separated lines (see cells), sorted by ``order``."""
    write_lines(df, path, cells(df), *order, header="\t".join(df.columns) if header else None)


def write_bed(df: DataFrame, path: str) -> None:
    write_tsv(df, path, "seqname", "start0", "end0", header=False)


def write_fasta(df: DataFrame, path: str, header: Column, seq: str, *order: str) -> None:
    """FASTA records of ``df``'s rows in order."""
    write_lines(df, path, F.concat(F.lit(">"), header, F.lit("\n"), F.col(seq)), *order)


def handoff(screens: DataFrame) -> DataFrame:
    """What the next pipeline takes: sample, its hit table and its assembly."""
    return screens.select("sample", "rm_out", F.col("fasta").alias("assembly_fasta"))

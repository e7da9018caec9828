"""Lines of text files, read in splits: every split is a task's work, and what goes on from split to split is carried by a small table.

Spark's own text source reads the files, so that it cuts them into splits of its own (a gzip file is one), opens whatever file system it knows, and hands a
split's lines to one task in order. What a line has to know of those before it comes in two parts. Within its split, tasks number and fill forward whole
Arrow batches as they stream. Across splits, each gives one row (its count of lines, its last header), and those rows are added up or carried on
in the order of the splits: a file of any size is never one task, one group or one window.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from satloom.shared import kept

LINES = "file_idx int, line_no long, line string, split string"
#: Rows of a small table (one a split) that are sent to every task at most; more are joined by a shuffle.
MAX_SENT = 50_000
#: What the parts of one file lie apart in line_no: more than any part has bytes.
PART = 1 << 40


def _same(path: str) -> str:
    """A path as all its spellings are compared: file:/x and file:///x are one."""
    return re.sub(r"^(\w+):/*(?=/)", r"\1:", path)


def _qualified(spark: SparkSession, path: str) -> str:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return _same(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toUri().toString())


def parts(spark: SparkSession, path: str) -> list[str]:
    """The files of a folder in the order of their names; a file is its own only part."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(spark.read.text(path).inputFiles()) if files.exists(where) and files.getFileStatus(where).isDirectory() else [path]


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """The stretches of rows in which all columns stay the same."""
    n = len(columns[0])
    new = np.zeros(max(n - 1, 0), bool)
    for c in columns:
        new |= c[1:] != c[:-1]
    edges = [0, *(np.flatnonzero(new) + 1).tolist(), n]
    return list(zip(edges, edges[1:], strict=False)) if n else []


def numbered_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """LINES of the files in ``paths``: file_idx is a path's place, line_no rises along a file from 0 on. A folder is one file, its parts one after another.

    line_no is where the line's split starts plus its place in the split: no two lines of a file share it, since each has a byte at least, but numbers are left
    out where a split begins (``counted`` closes them). A part starts PART above the one before. split names the split, by its start and length.
    """
    if not paths:
        return spark.createDataFrame([], LINES)
    files = [(i, n, f) for i, p in enumerate(paths) for n, f in enumerate(parts(spark, p))]
    place = {_qualified(spark, f): (i, n * PART) for i, n, f in files}
    raw = spark.read.option("lineSep", "\n").text(list(dict.fromkeys(f for _, _, f in files)))
    at = F.col("_metadata")
    raw = raw.select(at["file_path"].alias("path"), at["file_block_start"].alias("start"), at["file_block_length"].alias("size"), F.regexp_replace("value", "\r+$", "").alias("line"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, seen = None, 0
        for batch in batches:
            codes = pc.dictionary_encode(batch.column("path"))
            names, own = [place[_same(p)] for p in codes.dictionary.to_pylist()], codes.indices.to_numpy()
            file_idx, above = np.array([i for i, _ in names], np.int32)[own], np.array([n for _, n in names], np.int64)[own]
            start, size = batch.column("start").to_numpy() + above, batch.column("size").to_numpy()
            number = np.empty(len(start), np.int64)
            split: list[str] = []
            for a, b in _runs(file_idx, start):
                if (own := (file_idx[a], start[a])) != of:
                    of, seen = own, 0
                number[a:b] = start[a] + seen + np.arange(b - a)
                seen += b - a
                split += [f"{start[a]:016x}-{size[a]:x}"] * (b - a)
            yield pa.RecordBatch.from_arrays([pa.array(file_idx), pa.array(number), batch.column("line"), pa.array(split, pa.string())], ["file_idx", "line_no", "line", "split"])

    return raw.mapInArrow(placed, LINES)


def by_split(rows: DataFrame, small: DataFrame) -> DataFrame:
    """``rows`` with what ``small`` knows of their split (a row for each file_idx and split, all of them)."""
    small, n = kept(small)
    found = rows.join(F.broadcast(small) if n <= MAX_SENT else small, ["file_idx", "split"], "left")
    # A file that is cut otherwise the second time it is read would lose its numbers: that is an error, not another result.
    return found.withColumn("_known", F.when(F.col("_known").isNull(), F.raise_error(F.lit("a file was cut into other splits when it was read again"))).otherwise(True)).where("_known").drop("_known")


def prefix(rows: DataFrame, count: Column, through: bool = False) -> DataFrame:
    """file_idx, split and ``before``: the sum of ``count`` over the rows of all earlier splits of the file, or (``through``) of all files in their order."""
    sums = rows.groupBy("file_idx", "split").agg(F.sum(count).alias("own"))
    order = Window.orderBy("file_idx", "split") if through else Window.partitionBy("file_idx").orderBy("split")
    before = F.coalesce(F.sum("own").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return sums.select("file_idx", "split", before.cast("long").alias("before"), F.lit(True).alias("_known"))


def ordinals(lines: DataFrame, counts: Column, name: str, through: bool = False) -> DataFrame:
    """Those of ``lines`` that ``counts`` is true of, with ``name``: 1, 2 and so on along their file, or (``through``) along all files."""
    place = F.row_number().over(Window.partitionBy("file_idx", "split").orderBy("line_no"))
    own = by_split(lines.where(counts).withColumn("_place", place), prefix(lines, F.when(counts, 1).otherwise(0), through))
    return own.withColumn(name, F.col("before") + F.col("_place")).drop("_place", "before")


def counted(lines: DataFrame, through: bool = False) -> DataFrame:
    """``lines`` with line_no counting 0, 1, 2 and so on along each file, or (``through``) along all, wherever they were cut."""
    start = F.conv(F.substring("split", 1, 16), 16, 10).cast("long")
    found = by_split(lines, prefix(lines, F.lit(1), through))
    return found.withColumn("line_no", F.col("before") + F.col("line_no") - start).select(*lines.columns)


def running(lines: DataFrame, amount: Column, name: str) -> DataFrame:
    """``lines`` with ``name``: the sum of ``amount`` over the lines of their file before each."""
    earlier = Window.partitionBy("file_idx", "split").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    own = lines.withColumn("_own", F.coalesce(F.sum(amount).over(earlier), F.lit(0)))
    return by_split(own, prefix(lines, amount)).withColumn(name, (F.col("before") + F.col("_own")).cast("long")).drop("_own", "before")


def _filling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Headers carried on to the lines below them, within their split; rows of a split come together and in order."""
    of, last = None, None
    for batch in batches:
        own = batch.column("header")
        file_idx, split = batch.column("file_idx").to_numpy(), pc.dictionary_encode(batch.column("split")).indices.to_numpy()
        names, filled = batch.column("split"), []
        for a, b in _runs(file_idx, split):
            if (here := (file_idx[a], names[a].as_py())) != of:
                of, last = here, None
            part = pc.fill_null_forward(own.slice(a, b - a))
            part = part if last is None else pc.fill_null(part, last)
            last = part[-1].as_py()
            filled.append(part)
        columns = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "header"]
        header = pa.concat_arrays(filled) if filled else own
        yield pa.RecordBatch.from_arrays([*columns, header], [*(n for n in batch.schema.names if n != "header"), "header"])


def headed(lines: DataFrame, header: Column) -> DataFrame:
    """``lines`` (of numbered_lines, not shuffled since) with ``header`` (null on lines that are none) of the last header line at or above each."""
    marked = lines.withColumn("header", header.cast("string"))
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema)
    last = marked.where("header IS NOT NULL").groupBy("file_idx", "split").agg(F.max_by("header", "line_no").alias("own"))
    every = lines.groupBy("file_idx", "split").agg(F.lit(True).alias("_known"))
    earlier = Window.partitionBy("file_idx").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.join(last, ["file_idx", "split"], "left").select("file_idx", "split", "_known", F.last("own", ignorenulls=True).over(earlier).alias("_above"))
    found = by_split(marked.mapInArrow(_filling, own), carried)
    return found.select(*lines.columns, F.coalesce("header", "_above").alias("header"))

"""Small pieces that the text operators share: column picking, tokens, shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that separate words: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def positional(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns named by position, and where each of its names (the first, if repeated) went.

    Names that clash with an operator's own, or with each other, cannot be confused afterwards.
    """
    names = [f"_c{i}" for i in range(len(df.columns))]
    at: dict[str, str] = {}
    for name, own in zip(df.columns, names, strict=True):
        at.setdefault(name, own)
    return df.toDF(*names), at


def pick(df: DataFrame, *wanted: str) -> DataFrame:
    """Only the columns ``wanted``, whatever else ``df`` holds."""
    safe, at = positional(df)
    return safe.select(*(F.col(at[name]).alias(name) for name in wanted))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, also where lambdas in ``body`` refer to it often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole(text: str | Column = "text") -> Column:
    """The text; a null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z alone lower-cased; ``lower`` does just that to texts that hold ASCII only."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def root_of(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where the session names none, a session in one process (as in tests) gets a temporary one; on a cluster that is an error,
    since each machine would write to a disk of its own.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    kept = context._jsc.sc().getCheckpointDir()
    if not root and kept.isDefined():
        return kept.get()
    if not root and not context._jsc.sc().isLocal():
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    root = root or f"file://{tempfile.mkdtemp(prefix='satloom-')}"
    if not kept.isDefined():
        context.setCheckpointDir(root)
    return root


#: Folders of shared_dir, in the order in which they were made, for callers that know when what is in them has been used (corpus_pipeline).
MADE: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """A new folder in the shared one (root_of); it goes when the session's JVM ends."""
    folder = f"{root_of(spark).rstrip('/')}/satloom-{uuid.uuid4().hex}"
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    MADE.append(folder)
    return folder


def stored(df: DataFrame, path: str, **options: str) -> DataFrame:
    """``df`` written to ``path`` as Parquet and read again, so that nothing of it is computed twice.

    Rows read are counted (from the files' footers) against rows written: files that got lost are an error, not fewer rows.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.options(**options).parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    written, found = seen.get["n"], kept.count()
    if written != found:
        raise OSError(f"{path}: {written} rows were written, {found} are there")
    return kept


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a table of ``stored`` that nothing needs any more: what was made of it is stored itself."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut: a table in a folder of its own, computed once (a checkpoint would compute it twice)."""
    return stored(df, f"{shared_dir(df.sparkSession)}/rows")


def keyed(docs: DataFrame, *wanted: str, rid: str | None = None) -> DataFrame:
    """``rid`` and the columns ``wanted``. rid is the column so named, or a number given to each row in this very scan."""
    safe, at = positional(docs)
    own = F.col(at[rid]) if rid else F.monotonically_increasing_id()
    return safe.select(own.alias("rid"), *(F.col(at[name]).alias(name) for name in wanted))


#: The column of ``numbered``; no table is likely to have one of that name.
ROW = "_satloom_row"


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` stored once, with a number for each row in ROW, so that all who read it agree on which row is which."""
    safe, _ = positional(docs)
    rows = safe.withColumn("rid", F.monotonically_increasing_id())
    return stored(rows, f"{shared_dir(docs.sparkSession)}/rows").toDF(*docs.columns, ROW)


def only(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """Those of ``rows`` (numbered) whose number is in ``chosen`` (rid), without it."""
    safe, at = positional(rows)
    kept = safe.withColumnRenamed(at[ROW], "rid").join(chosen.select("rid"), "rid", "left_semi")
    return kept.select(*(c for c in safe.columns if c != at[ROW])).toDF(*(c for c in rows.columns if c != ROW))


def whole_number(docs: DataFrame, column: str) -> None:
    """An error unless ``column`` is of an integer type: numbers in text would lose their order."""
    kind = docs.schema[column].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{column} must be of an integer type, not {kind.simpleString()}")


def place(number: Column, rid: Column, missing: int) -> Column:
    """``number`` and, among equal ones, ``rid`` as one decimal, which aggregates by hash as no struct does.

    A missing number ranks as -2^63 - 1 (``missing`` = -1) or as 2^63 (``missing`` = 1). rid is not negative.
    """
    high = F.coalesce(number.cast("decimal(20,0)"), F.lit(Decimal(1 << 63 if missing > 0 else -(1 << 63) - 1)).cast("decimal(20,0)"))
    return (high * F.lit(Decimal(1 << 63)).cast("decimal(19,0)") + rid.cast("decimal(20,0)")).cast("decimal(38,0)")


def place_rid(placed: Column, number: Column, missing: int) -> Column:
    """rid of ``place(number, rid, missing)``."""
    return (placed - place(number, F.lit(0), missing)).cast("long")


def copies(rows: DataFrame, *key: str) -> DataFrame:
    """``rows`` (with rid) and ``copy``: 0 to n - 1 among the n rows that are equal in ``key``.

    Equal rows are numbered within their partition of the scan that gave rid, from where the partitions before it end; so the numbers
    of a key with a third of all rows are found in as many tasks as there are partitions.
    """
    held = rows.withColumns({"_key": F.struct(*key), "_part": F.shiftright("rid", 33)})
    counts = held.groupBy("_key", "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("_key", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_ahead"))
    own = F.row_number().over(Window.partitionBy("_key", "_part").orderBy("rid")) - 1
    numbered_ = held.withColumn("_own", own).join(ahead, ["_key", "_part"])
    return numbered_.select(*rows.columns, (F.col("_ahead") + F.col("_own")).alias("copy"))


def joined(parts: Sequence[Column], sep: str) -> Column:
    return F.concat_ws(sep, *parts)

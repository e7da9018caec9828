"""Compressing vectors to codes: each is cut into parts, and each part is replaced by the number of its nearest codebook entry.

Codebooks come from Lloyd's rounds over all vectors, kept up by differences. What every part was assigned to is stored beside its vector, and for each
entry the running sum and count of its parts. A round assigns all parts anew where they lie and shuffles only what moved: of a part whose entry
changed, its components less for the old entry and more for the new, added up within the task first. All sums are of whole numbers, so
that they are exact in any order and however often a task runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satloom.llm import common as C

#: Vectors that are held against a codebook at once.
TOGETHER = 1 << 13


@dataclass(frozen=True)
class Coding:
    """parts: of a vector; entries: of each part's codebook (256 at most, a byte of the code); rounds: of Lloyd's; scale: of components before they are
    rounded down to whole numbers."""

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256


@dataclass(frozen=True)
class Coded:
    """``rows``: vec_id, label, code (a byte a part) and error. ``codebooks``: an array (part, entry, place)."""

    rows: DataFrame
    codebooks: np.ndarray


def whole_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and comps (whole numbers) of the rows of ``vectors`` that hold a vector of finite numbers."""
    own = C.pick(vectors, "vec_id", "embedding", "label")
    x = F.transform("embedding", lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = own.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(fine)
    return rows.select("vec_id", "label", F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("comps"))


def _matrix(batch: pa.RecordBatch, column: str = "comps") -> np.ndarray:
    lists = batch.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1) if len(lists) else np.zeros((0, 1), np.int64)


def nearest(comps: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entry that each part of each row is nearest to, the first of equals, and the row's squared distances, summed.

    Products are taken in floating point where every intermediate result is a whole number below 2^53, and so exact.
    """
    parts, _, width = books.shape
    peak = max(int(np.abs(comps).max(initial=0)), int(np.abs(books).max(initial=0)))
    kind = np.float64 if 4 * peak * peak * width < 1 << 53 else np.int64
    codes, error = np.empty((len(comps), parts), np.uint8), np.zeros(len(comps), np.int64)
    for k in range(0, len(comps), TOGETHER):
        some = slice(k, k + TOGETHER)
        for p in range(parts):
            own, book = comps[some, p * width : (p + 1) * width].astype(kind), books[p].astype(kind)
            far = (own * own).sum(1)[:, None] - 2 * (own @ book.T) + (book * book).sum(1)
            codes[some, p] = at = far.argmin(1)
            error[some] += far[np.arange(len(at)), at].astype(np.int64)
    return codes, error


def _assigning(books: np.ndarray, label: pa.DataType, final: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, error = nearest(_matrix(batch), books)
            code = pa.array([c.tobytes() for c in codes], pa.binary())
            own = [batch.column("vec_id"), batch.column("label")]
            if final:
                yield pa.RecordBatch.from_arrays([*own, code, pa.array(error)], ["vec_id", "label", "code", "error"])
            else:
                yield pa.RecordBatch.from_arrays([*own, batch.column("comps"), batch.column("code"), code], ["vec_id", "label", "comps", "was", "code"])

    return assign


def _moving(parts: int, entries: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the rows' changed parts add to each entry (place 0: their number), added up over the task: a bounded table."""
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            comps = _matrix(batch).reshape(-1, parts, width)
            code, was = batch.column("code").to_pylist(), batch.column("was").to_pylist()
            new = np.array([list(c) for c in code], np.int64).reshape(-1, parts)
            old = np.array([list(c) if c is not None else [-1] * parts for c in was], np.int64).reshape(-1, parts)
            for p in range(parts):
                changed = np.flatnonzero(new[:, p] != old[:, p])
                ones = np.column_stack([np.ones(len(changed), np.int64), comps[changed, p]])
                np.add.at(total[p], new[changed, p], ones)
                left = old[changed, p] >= 0
                np.subtract.at(total[p], old[changed, p][left], ones[left])
        part, entry, place = np.nonzero(total)
        columns = [pa.array(x.astype(np.int32)) for x in (part, entry, place)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(total[part, entry, place])], ["part", "entry", "place", "delta"])

    return moves


def renewed(books: np.ndarray, sums: DataFrame) -> np.ndarray:
    """``books`` with each entry that has parts at their mean, rounded down. ``sums`` has a row an entry and place: as many as a codebook has numbers."""
    total = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
    for part, entry, place, value in sums.collect():
        total[part, entry, place] = value
    count = total[:, :, :1]
    return np.where(count > 0, total[:, :, 1:] // np.maximum(count, 1), books)


def coded(vectors: DataFrame, how: Coding = Coding()) -> Coded:
    """Codes of all ``vectors`` (vec_id, embedding, label) after ``how.rounds`` rounds.

    Rows whose vector is null, is empty or holds a null, a NaN or an infinity are left out. The codebooks start as the parts of the ``how.entries`` rows of least
    vec_id (a null ranks last; rows of one vec_id rank by components), so repeated rows may start two equal entries, of which the second gets nothing.
    With fewer rows there are fewer entries; an empty table gives no codes. Vectors of different lengths, a length that parts do not divide and
    components so large that a vector's error could pass 2^63 are a ValueError. Other columns are not looked at.
    """
    if not 0 < how.entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    spark = vectors.sparkSession
    at = C.shared_dir(spark)
    rows = C.stored(whole_vectors(vectors, how.scale).withColumn("code", F.lit(None).cast("binary")), f"{at}/0")
    seeds = [r["comps"] for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "comps").limit(how.entries).select("comps").collect()]
    size = F.size("comps")
    least, most, peak = rows.agg(F.min(size), F.max(size), F.max(F.array_max(F.transform("comps", F.abs)))).first()
    if not seeds:
        return Coded(rows.select("vec_id", "label", "code", F.lit(0).cast("long").alias("error")), np.zeros((how.parts, 0, 0), np.int64))
    if least != most or most % how.parts:
        raise ValueError(f"vectors of {least} to {most} components cannot be cut into {how.parts} equal parts")
    if peak >= 1 << 62 or 4 * peak * peak * most >= 1 << 63:
        raise ValueError(f"components of {peak} are too large")
    width = most // how.parts
    books = np.array(seeds, np.int64).reshape(len(seeds), how.parts, width).transpose(1, 0, 2)
    kind = rows.schema["label"].dataType.simpleString()
    sums: DataFrame | None = None
    for i in range(1, how.rounds + 1):
        assigned = rows.mapInArrow(_assigning(books, None, False), f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, label {kind}, comps array<bigint>, was binary, code binary")
        before, rows = f"{at}/{i - 1}", C.stored(assigned, f"{at}/{i}")
        C.removed(spark, before)
        moved = rows.where("was IS NULL OR was <> code").select("comps", "was", "code")
        deltas = moved.mapInArrow(_moving(how.parts, len(seeds), width), "part int, entry int, place int, delta long")
        added = deltas if sums is None else deltas.unionByName(sums.withColumnRenamed("total", "delta"))
        sums = C.stored(added.groupBy("part", "entry", "place").agg(F.sum("delta").alias("total")), f"{at}/sums{i}")
        books = renewed(books, sums)
    final = rows.mapInArrow(_assigning(books, None, True), f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, label {kind}, code binary, error long")
    found = C.stored(final, f"{at}/codes")
    C.removed(spark, f"{at}/{how.rounds}")
    return Coded(found, books)


def digest(books: np.ndarray) -> str:
    """SHA-256 of all numbers by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` with label_error, the errors of all rows of the same label (nulls are one), summed within tasks first."""
    sums = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return rows.join(sums, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = coded(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    rows = label_errors(found.rows)
    return rows.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(found.codebooks)).alias("codebooks_sha256"))


def _assigned(i: int) -> str:
    """SQL of round i: the entry of each part (a{i}), then the entries after it (b{i}); integer division rounds down by hand."""
    return f""", d{i} AS (SELECT v.id, v.part, b.entry, sum((v.x - b.x) * (v.x - b.x)) AS far FROM x v JOIN b{i - 1} b ON b.part = v.part AND b.place = v.place GROUP BY v.id, v.part, b.entry),
 a{i} AS (SELECT id, part, arg_min(entry, (far, entry)) AS entry, min(far) AS far FROM d{i} GROUP BY id, part),
 m{i} AS (SELECT a.part, a.entry, v.place, (sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*) AS x FROM a{i} a JOIN x v ON v.id = a.id AND v.part = a.part GROUP BY a.part, a.entry, v.place),
 b{i} AS (SELECT b.part, b.entry, b.place, coalesce(m.x, b.x) AS x FROM b{i - 1} b LEFT JOIN m{i} m ON m.part = b.part AND m.entry = b.entry AND m.place = b.place)"""


OP13_SQL = f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(floor(CAST(v AS DOUBLE) * 256) AS BIGINT)) AS comps FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR isnan(v) OR isinf(v))) = 0),
 n AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, comps) AS id, len(comps) // 16 AS width FROM k),
 x AS (SELECT id, (i - 1) // width AS part, (i - 1) % width AS place, comps[i] AS x FROM (SELECT *, unnest(range(1, len(comps) + 1)) AS i FROM n)),
 b0 AS (SELECT part, id - 1 AS entry, place, x FROM x WHERE id <= 64){_assigned(1)}{_assigned(2)}{_assigned(3)},
 c AS (SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM a3 GROUP BY id),
 h AS (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM n JOIN c ON c.id = n.id, h
"""

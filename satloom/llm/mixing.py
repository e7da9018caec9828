"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sizes are words. Each source is dealt by seeded hashes into cells of bounded size; a cell is a ring of its documents in a seeded
order, read in blocks of equal word counts. Sainte-Laguë's highest quotients give whole numbers of blocks to sources by their
targets, and then to the cells of a source by their sizes. A cell reads its quota of blocks one after another, from a
seeded block on and round the ring as often as it takes; only documents at the ends of that run are taken in part. A source
whose target is all that it may give is taken whole.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from satloom.llm import common as C


@dataclass(frozen=True)
class Mix:
    """share: words of the mix by words there are; repeats: most passes over a source; block: words.

    cell_words: words aimed at in a cell; a source has at most max_cells of them, so that the cells of one source (not its documents) fit a
    task, and cells grow beyond that only with sources of more than cell_words * max_cells words. max_sources bounds the table of sources, which alone goes to the driver; more of them is an error.
    """

    weights: tuple[int, ...] = (3, 1, 2)
    share: Fraction = Fraction(3, 2)
    repeats: int = 2
    block: int = 64
    cell_words: int = 50_000
    max_cells: int = 20_000
    seed: int = 23
    max_sources: int = 100_000


def targets(sizes: Sequence[int], mix: Mix) -> list[Fraction]:
    """Each source's target: by weight, at most ``repeats`` times its size, what exceeds that shared anew by weight."""
    weigh = [mix.weights[i % len(mix.weights)] for i in range(len(sizes))]
    found, left, open_ = [Fraction(0)] * len(sizes), mix.share * sum(sizes), set(range(len(sizes)))
    while open_:
        unit = left / sum(weigh[i] for i in open_)
        full = {i for i in open_ if unit * weigh[i] >= mix.repeats * sizes[i]}
        if not full:
            for i in open_:
                found[i] = unit * weigh[i]
            break
        for i in full:
            found[i] = Fraction(mix.repeats * sizes[i])
            left -= found[i]
        open_ -= full
    return found


def sainte_lague(votes: Sequence[Fraction | int], seats: int, caps: Sequence[int]) -> list[int]:
    """Seats by the highest quotients votes / (2 * seats + 1); the first of equals wins; none gets more than its cap.

    A start safely below the outcome is dealt at once: with divisor d each party has at least votes / d - 1/2 seats, rounded up.
    """
    got, total = [0] * len(votes), sum(votes)
    seats = min(seats, sum(caps))
    if total <= 0 or seats <= 0:
        return got
    divisor = Fraction(total) / max(seats - len(votes), 1)
    start = [min(cap, max(0, math.floor(Fraction(v) / divisor - 1))) for v, cap in zip(votes, caps, strict=True)]
    if seats > len(votes) and sum(start) <= seats:
        got = start
    queue = [(-Fraction(v, 2 * g + 1), i) for i, (v, g, c) in enumerate(zip(votes, got, caps, strict=True)) if g < c]
    heapq.heapify(queue)
    for _ in range(seats - sum(got)):
        _, i = heapq.heappop(queue)
        got[i] += 1
        if got[i] < caps[i]:
            heapq.heappush(queue, (-Fraction(votes[i], 2 * got[i] + 1), i))
    return got


def _cell_quotas(block: int, repeats: int):
    def quotas(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("cell")
        sizes = [int(x) for x in cells["words"]]
        cells["quota"] = sainte_lague(sizes, int(cells["seats"].iloc[0]), [repeats * x // block for x in sizes])
        return cells[["source_no", "cell", "quota", "words"]]

    return quotas


def mixed(docs: DataFrame, mix: Mix = Mix(), rid: str | None = None) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, size, source_size, target, taken, cell, and what of it is taken.

    ``passes`` whole copies are taken and the words [from_word, to_word) and [from_word2, to_word2) once more (half open, both may
    be empty). Sources rank by code point, the null source last. Empty or null texts have size 0 and nothing is taken of them;
    a source or table without words has target 0. Repeated rows count each for itself; which cell a row meets follows from doc_id,
    size and the number of the copy among rows equal in those, so that the same rows give the same mix however they lie.
    rid: see common.keyed.
    """
    spark = docs.sparkSession
    rows = C.keyed(docs, "doc_id", "source", "text", rid=rid).select("rid", "doc_id", "source", C.word_count(C.whole()).alias("size"))
    rows = C.stored(rows, f"{C.shared_dir(spark)}/sizes")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("words"))
    known = [(r["source"], int(r["words"])) for r in per_source.limit(mix.max_sources + 1).collect()]
    if len(known) > mix.max_sources:
        raise ValueError(f"more than {mix.max_sources} sources; raise Mix.max_sources if the driver can hold them")
    known.sort(key=lambda x: (x[0] is None, x[0] or ""))
    sizes = [n for _, n in known]
    goal = targets(sizes, mix)
    block = max(1, min(mix.block, min([n for n in sizes if n] or [1]) // 200))
    seats = sainte_lague(goal, round(sum(goal) / block), [mix.repeats * n // block for n in sizes])
    table = spark.createDataFrame(
        [(i, s, n, float(g), q, g == mix.repeats * n, min(mix.max_cells, max(1, math.ceil(n / mix.cell_words)))) for i, ((s, n), g, q) in enumerate(zip(known, goal, seats, strict=True))],
        "source_no int, source string, source_size long, target double, seats long, whole boolean, cells int",
    )
    # Bounded by max_sources rows, and so sent whole to each task.
    rows = rows.join(F.broadcast(table), rows["source"].eqNullSafe(table["source"])).drop("source")
    rows = C.copies(rows, "source_no", "doc_id", "size")
    rows = rows.withColumn("draw", F.xxhash64(F.lit(mix.seed), "doc_id", "size", "copy"))
    rows = rows.withColumn("cell", F.pmod(F.xxhash64(F.lit(mix.seed + 1), "doc_id", "size", "copy"), "cells").cast("int"))
    cells = rows.groupBy("source_no", "cell").agg(F.sum("size").alias("words"), F.first("seats").alias("seats"))
    quotas = cells.groupBy("source_no").applyInPandas(
        _cell_quotas(block, mix.repeats), "source_no int, cell int, quota long, words long"
    )
    order = Window.partitionBy("source_no", "cell").orderBy("draw", "doc_id", "size", "copy").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("size").over(order)).join(quotas, ["source_no", "cell"])
    run = F.col("quota") * block
    some = ~F.col("whole") & (F.col("words") > 0)
    rows = rows.select(
        "rid", "doc_id", "size", "source_size", "target", "cell", "words", (F.col("upto") - F.col("size")).alias("ahead"),
        F.when(F.col("whole"), mix.repeats).when(some, F.floor(run / F.col("words"))).otherwise(0).cast("long").alias("passes"),
        F.when(some, run % F.col("words")).otherwise(0).alias("extra"),
        F.when(some, block * F.pmod(F.xxhash64(F.lit(mix.seed + 2), "source_no", "cell"), F.ceil(F.col("words") / block))).otherwise(0).alias("start"),
    )

    def within(word: Column) -> Column:
        """A word's place in the cell, as one in the document."""
        return F.greatest(F.lit(0), F.least(F.col("size"), word - F.col("ahead"))).cast("long")

    end = F.col("start") + F.col("extra")
    rows = rows.select(
        "*",
        within(F.col("start")).alias("from_word"),
        within(F.least(end, F.col("words"))).alias("to_word"),
        F.lit(0).cast("long").alias("from_word2"),
        within(F.greatest(end - F.col("words"), F.lit(0))).alias("to_word2"),
    )
    taken = F.col("passes") * F.col("size") + F.col("to_word") - F.col("from_word") + F.col("to_word2")
    return rows.select(
        "rid", "doc_id", "size", "source_size", "target", taken.alias("taken"), "cell", "passes", "from_word", "to_word", "from_word2", "to_word2"
    )


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(C.documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def words_between(text: Column, start: Column, end: Column) -> Column:
    """The part of ``text`` that holds its words start to end (half open), with what stands between them."""
    whole = (start == 0) & (end >= C.word_count(text))
    cut = F.array_join(F.slice(C.words_of(text), (start + 1).cast("int"), (end - start).cast("int")), " ")
    return F.when(whole, text).otherwise(cut)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` as mixed, with their own columns: a row for each whole pass, and one for each part taken besides.

    A part is the words taken, joined by single spaces; n_chars, if there, counts what the row holds.
    """
    stored = C.numbered(docs)
    plan = mixed(stored, rid=C.ROW).where("taken > 0").select("rid", "size", "passes", "from_word", "to_word", "from_word2", "to_word2")
    safe, at = C.positional(stored)
    rows = safe.withColumnRenamed(at.pop(C.ROW), "rid").join(plan, "rid")
    span = lambda a, b: F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    parts = F.concat(
        F.array_repeat(span(F.lit(0), F.col("size")), F.col("passes").cast("int")),
        F.array(span(F.col("from_word"), F.col("to_word")), span(F.col("from_word2"), F.col("to_word2"))),
    )
    rows = rows.withColumn("part", F.explode(F.filter(parts, lambda x: x["b"] > x["a"])))
    text = F.when((F.col("part.a") == 0) & (F.col("part.b") == F.col("size")), F.col(at["text"])).otherwise(
        words_between(C.whole(at["text"]), F.col("part.a"), F.col("part.b"))
    )
    rows = rows.withColumn(at["text"], text)
    if "n_chars" in at:
        rows = rows.withColumn(at["n_chars"], F.char_length(at["text"]).cast(docs.schema["n_chars"].dataType))
    return rows.select(*safe.columns[: len(docs.columns)]).toDF(*docs.columns)

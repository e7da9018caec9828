"""Best-fit packing into several permitted sequence lengths.

Documents (or their pieces, where one is longer than the longest sequence) are dealt by seeded hashes into packing groups of bounded
size, and each group is packed by itself: longest first, each piece into the open bin that it fills best. Where none has
room, a bin of the permitted length is opened whose expected cost is least: a fixed cost a bin and the padding that would stay if
the pieces still to come filled it. At the end every bin shrinks to the shortest permitted length that holds it.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satloom.llm import common as C


@dataclass(frozen=True)
class Packing:
    """lengths: permitted, in words; bin_cost: words that one more bin costs; group_rows: pieces aimed at in a group."""

    lengths: tuple[int, ...] = (256, 512, 1024, 2048)
    bin_cost: int = 4
    group_rows: int = 20_000
    seed: int = 31


class Remaining:
    """How many pieces of each length are still to come, with the longest of at most a given length at hand."""

    def __init__(self, sizes: Iterable[int], longest: int) -> None:
        self.count = [0] * (longest + 1)
        for n in sizes:
            self.count[n] += 1
        self.present = sorted({n for n in range(longest + 1) if self.count[n]})

    def take(self, n: int) -> None:
        self.count[n] -= 1
        if not self.count[n]:
            self.present.pop(bisect.bisect_left(self.present, n))

    def fill(self, room: int) -> int:
        """Room left when the longest pieces that fit are put in, one after another."""
        at = bisect.bisect_right(self.present, room) - 1
        while at >= 0 and room > 0:
            n = self.present[at]
            if n <= 0:
                break
            room -= n * min(self.count[n], room // n)
            at = min(at - 1, bisect.bisect_right(self.present, room) - 1)
        return room


def pack(sizes: Sequence[int], lengths: Sequence[int], bin_cost: int = 4) -> tuple[list[int], list[int], list[int]]:
    """For sizes in falling order, none above the longest length: the bin and offset of each, and the length of each bin.

    Ties go to the bin opened first. Sizes of 0 go into bin 0 of the group (or a new one) at its end, and take no room.
    """
    lengths = sorted(lengths)
    left = Remaining(sizes, lengths[-1])
    bins: list[int] = []
    offsets: list[int] = []
    used: list[int] = []
    open_: list[tuple[int, int]] = []  # (room, bin), in order
    room_of: list[int] = []
    for n in sizes:
        left.take(n)
        at = bisect.bisect_left(open_, (n, -1))
        if at < len(open_):
            room, b = open_.pop(at)
        else:
            best = None
            for length in lengths:
                if length >= n:
                    rest = left.fill(length - n)
                    filled = length - rest
                    # Downsizing will give back what stays empty beyond the next permitted length.
                    final = lengths[bisect.bisect_left(lengths, max(filled, 1))]
                    cost = (bin_cost + final - filled) / max(filled, 1)
                    if best is None or cost < best[0]:
                        best = (cost, length)
            room, b = best[1], len(used)
            used.append(0)
            room_of.append(best[1])
        bins.append(b)
        offsets.append(used[b])
        used[b] += n
        if room - n > 0 or n == 0:
            bisect.insort(open_, (room - n, b))
    final = [lengths[bisect.bisect_left(lengths, max(u, 1))] for u in used]
    return bins, offsets, final


SCHEMA = (
    "rid long, doc_id long, text_hash long, copy long, piece int, first_word long, n_words long, pack_group long, bin long, bin_offset long, "
    "bin_length long, bin_used long"
)


def _packer(how: Packing):
    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_words", "draw", "text_hash", "copy", "piece"], ascending=[False, True, True, True, True])
        bins, offsets, final = pack(rows["n_words"].tolist(), how.lengths, how.bin_cost)
        at = np.array(bins)
        rows["bin"], rows["bin_offset"], rows["bin_length"] = bins, offsets, np.array(final)[at]
        rows["bin_used"] = np.bincount(at, weights=rows["n_words"]).astype("int64")[at]
        return rows[[x.split()[0] for x in SCHEMA.split(", ")]]

    return packed


def best_fit(docs: DataFrame, how: Packing = Packing(), rid: str | None = None) -> DataFrame:
    """A row for each piece of each row of ``docs``: where it stands in which bin (SCHEMA).

    A row of ``docs`` is known by doc_id, text_hash and copy (its number among rows equal in both), a piece by that and ``piece``: these
    are a key of the result and do not depend on how the rows lie. A bin is known by pack_group and bin; it has length
    bin_length, of which bin_used words are taken, and holds its pieces one after another from bin_offset on. A document longer than
    the longest length is cut into pieces of that length and a rest; a shorter one is a single piece. Documents without words
    (null or empty texts) are a piece of 0 words that takes no room. Repeated rows are packed each for itself; an empty
    table gives no rows. No document is dropped or cut short. doc_id must be of an integer type (else TypeError). rid: see common.keyed.
    """
    C.whole_number(docs, "doc_id")
    longest = max(how.lengths)
    rows = C.keyed(docs, "doc_id", "text", rid=rid).select(
        "rid", F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), C.word_count(C.whole()).alias("size")
    )
    rows = C.stored(rows, f"{C.shared_dir(docs.sparkSession)}/sizes")
    total = rows.agg(F.sum(F.greatest(F.lit(1), F.ceil(F.col("size") / longest)))).first()[0] or 0
    groups = max(1, math.ceil(total / how.group_rows))
    last = F.greatest(F.lit(0), F.ceil(F.col("size") / longest) - 1).cast("int")
    pieces = C.copies(rows, "doc_id", "text_hash").withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
    own = ("doc_id", "text_hash", "copy", "piece")
    pieces = pieces.select(
        "rid",
        *own,
        (F.col("piece").cast("long") * longest).alias("first_word"),
        F.least(F.lit(longest).cast("long"), F.col("size") - F.col("piece").cast("long") * longest).alias("n_words"),
        F.xxhash64(F.lit(how.seed), *own).alias("draw"),
    )
    key = F.pmod(F.xxhash64(F.lit(how.seed + 1), *own), F.lit(groups))
    return pieces.withColumn("pack_group", key).groupBy("pack_group").applyInPandas(_packer(how), SCHEMA)


def packed_texts(docs: DataFrame, how: Packing = Packing()) -> DataFrame:
    """best_fit of ``docs`` with the ``text`` of each piece, so that a bin's pieces in the order of bin_offset are a sequence.

    A document that is one piece keeps its text as it is (null stays null); the words of cut ones are joined by single spaces.
    """
    longest, stored = max(how.lengths), C.numbered(docs)
    rows = C.keyed(stored, "text", rid=C.ROW)

    def cut(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(words), F.lit(longest))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, longest), " "))

    long = C.word_count(C.whole()) > longest
    texts = F.when(long, C.let(C.words_of(C.whole()), cut)).otherwise(F.array("text"))
    pieces = rows.select("rid", F.posexplode(texts).alias("piece", "text"))
    return best_fit(stored, how, C.ROW).join(pieces, ["rid", "piece"]).drop("rid")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit(C.documents(spark, sf_dir)).drop("rid")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed bins' pieces of ``docs``, with their texts."""
    return packed_texts(docs)

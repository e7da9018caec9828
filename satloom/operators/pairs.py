"""Comparing consensus sequences pair by pair: length bound, tiling, and a null test of those that pass."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satloom.functions import exprs as X
from satloom.functions import kernels as K
from satloom.params import Comparing
from satloom.shared import checkpointed


def candidate_pairs(pool: DataFrame, how: Comparing = Comparing(), parts: int | None = None, blocks: int | None = None) -> DataFrame:
    """Pairs of ``pool`` (ord, label, seq) that the length bound leaves: label_a, label_b, len_a, len_b, length_ratio.

    A is the shorter, of equal lengths the one of lower ord. Lengths are put into classes that grow by the bound's factor, so a pair
    can only join a class with itself or the next two: an equality join on the class, not a product of all with all. Units of one
    organism share a class or two, so that both sides are dealt into ``blocks`` by a hash besides: a pair of blocks is a task's work. The
    sequences are joined to the pairs that are left.
    """
    most = how.max_copies / how.min_coverage
    blocks = blocks or math.ceil(math.sqrt(4 * pool.sparkSession.sparkContext.defaultParallelism))
    rows = pool.where("length(seq) > 0").select("ord", "label", F.length("seq").alias("len"))
    rows = rows.withColumn("cls", F.floor(F.log(F.col("len").cast("double")) / math.log(most)).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("ord"), F.lit(blocks)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("ord", "label", "len", "block")]
    a = rows.select(*side("a"), F.explode(F.array("cls", F.col("cls") + 1, F.col("cls") + 2)).alias("cls")).withColumn("block_b", every)
    b = rows.select(*side("b"), "cls").withColumn("block_a", every)
    shorter = (F.col("len_a") < F.col("len_b")) | ((F.col("len_a") == F.col("len_b")) & (F.col("ord_a") < F.col("ord_b")))
    ratio = F.col("len_b") / F.col("len_a")
    pairs = a.join(b, ["cls", "block_a", "block_b"]).where(shorter & (ratio <= most)).withColumn("length_ratio", ratio)
    pairs = pairs.drop("cls", "block_a", "block_b")
    return pairs if parts is None else pairs.repartition(parts, "ord_a", "ord_b")


def _copies(ratio: float, how: Comparing) -> int:
    return min(how.max_copies, int(ratio) + 2)


def compare(pool: DataFrame, how: Comparing = Comparing(), parts: int | None = None) -> DataFrame:
    """Each candidate pair with its tiling, its null test and its flags.

    null_passes is null where no test was needed; null_status tells why: tested, skipped_high_confidence or null. Pairs are
    dealt anew before the tiling and the candidates before the (much dearer) null test, since both are work in Python.
    """
    parts = parts or pool.sparkSession.sparkContext.defaultParallelism * 4
    one = pool.select("ord", "seq")
    rows = candidate_pairs(pool, how).join(one.toDF("ord_a", "seq_a"), "ord_a").join(one.toDF("ord_b", "seq_b"), "ord_b")
    own = "label_a string, label_b string, len_a int, len_b int, length_ratio double, seq_a string, seq_b string, coverage double, mean_copy_identity double, n_copies_found int"

    def tiles(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            found = K.tiles(df["seq_a"].tolist(), df["seq_b"].tolist(), how.min_identity, [_copies(r, how) for r in df["length_ratio"]])
            df["coverage"] = [t.coverage for t in found]
            df["mean_copy_identity"] = [t.mean_identity if t.n_copies else None for t in found]
            df["n_copies_found"] = [t.n_copies for t in found]
            yield df

    kept = ["label_a", "label_b", "len_a", "len_b", "length_ratio", "seq_a", "seq_b"]
    tiled = checkpointed(rows.select(*kept).repartition(parts, "label_a", "label_b").mapInPandas(tiles, own))
    passes = (F.col("coverage") >= how.min_coverage) & (F.col("mean_copy_identity") >= how.min_identity) & (F.col("n_copies_found") >= 1)
    sure = F.lit(how.skip_margin > 0) & (F.col("coverage") >= how.min_coverage + how.skip_margin) & (F.col("mean_copy_identity") >= how.min_identity + how.skip_margin)
    tiled = tiled.withColumn("candidate", F.coalesce(passes, F.lit(False))).withColumn("sure", F.coalesce(passes & sure, F.lit(False)))

    def nulls(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            most, seeds = [_copies(r, how) for r in df["length_ratio"]], [int(s) for s in df["seed"]]
            n = K.null_passes(df["seq_a"].tolist(), df["seq_b"].tolist(), how.min_identity, most, how.min_coverage, how.n_shuffles, seeds, how.shuffle_mode)
            yield pd.DataFrame({"label_a": df["label_a"], "label_b": df["label_b"], "null_passes": n})

    tests = tiled.where("candidate AND NOT sure").withColumn("seed", X.pair_seed(how.shuffle_seed, F.col("label_a"), F.col("label_b")))
    tests = tests.repartition(parts, "label_a", "label_b").mapInPandas(nulls, "label_a string, label_b string, null_passes int")
    rows = tiled.drop("seq_a", "seq_b").join(tests, ["label_a", "label_b"], "left")
    confirmed = F.col("sure") | F.coalesce(F.col("null_passes") <= how.max_null_passes, F.lit(False))
    return rows.select(
        "label_a", "label_b", "len_a", "len_b", "length_ratio", "coverage", "mean_copy_identity", "n_copies_found", "null_passes",
        F.when(F.col("sure"), "skipped_high_confidence").when(F.col("candidate"), "tested").alias("null_status"),
        (confirmed & (F.col("n_copies_found") == 1)).alias("flag_similar"), (confirmed & (F.col("n_copies_found") >= 2)).alias("flag_multiple_of"),
    )


def flagged(pairs: DataFrame) -> DataFrame:
    return pairs.where("flag_similar OR flag_multiple_of").select("label_a", "label_b")

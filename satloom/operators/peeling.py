"""From the loci of a bin to ranked clusters with consensus sequences."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from satloom.functions import exprs as X
from satloom.functions import kernels as K
from satloom.params import Peeling
from satloom.shared import MAX_SENT, checkpointed, kept

KEY = ["entry_id", "motif"]
#: Of seq.
DIGEST = "unhex(sha2(seq, 256))"
MEASURES = ["copy_number", "percent_match", "entropy"]


def references(rows: DataFrame, keys: list[str], length: str, order: list[str], least: int = 1, copies: str | None = None) -> DataFrame:
    """The reference of each group of ``rows`` with ``least`` rows or more: keys, ``length`` (the upper median of the group's) and r, the first of its rows of that
    length by ``order``. Lengths are counted first, so that what a window sees of a group is a row a length. A row counts as often as ``copies``, a column, says."""
    lengths = rows.groupBy(*keys, length).agg((F.sum(copies) if copies else F.count(F.lit(1))).alias("_n"))
    own = Window.partitionBy(*keys)
    upto = F.sum("_n").over(own.orderBy(length).rowsBetween(Window.unboundedPreceding, 0))
    middle = lengths.select(*keys, length, upto.alias("_upto"), F.sum("_n").over(own).alias("_size"))
    middle = middle.where((F.col("_size") >= least) & (F.col("_upto") > F.floor(F.col("_size") / 2))).groupBy(*keys).agg(F.min(length).alias(length))
    return rows.join(middle, [*keys, length]).groupBy(*keys, length).agg(F.min(F.struct(*order)).alias("r"))


@dataclass(frozen=True)
class Peeled:
    """What peeling by kinds (the equal sequences of a bin) found.

    ``rows``: the loci with ``of``, the digest of their sequence. ``members``: KEY, of, row_id, round, is_reference, seq (turned) and n, the loci that it stands
    for: one for a reference (row_id), else all of its kind that are not ``taken`` (KEY, row_id: the references of all rounds)."""

    rows: DataFrame
    members: DataFrame
    taken: DataFrame

    def loci(self) -> DataFrame:
        """Each clustered locus: the columns of ``rows`` with round, is_reference and turned."""
        kinds = self.members.where("NOT is_reference").select(*KEY, "of", "round", "is_reference", F.col("seq").alias("turned"))
        single = self.members.where("is_reference").select(*KEY, "row_id", "round", "is_reference", F.col("seq").alias("turned"))
        others = self.rows.join(self.taken, [*KEY, "row_id"], "left_anti").join(kinds, [*KEY, "of"])
        return others.unionByName(self.rows.join(single, [*KEY, "row_id"]))


def by_kinds(loci: DataFrame, how: Peeling = Peeling(), parts: int | None = None) -> Peeled:
    """Peels ``loci`` (entry_id, motif, row_id: file order, a number of its own in its bin; seq; further columns stay).

    A round picks the reference of every bin that is still open (the first locus whose length is the upper median) and matches all
    other loci of those bins with it. What becomes of a locus depends on its sequence alone, so that equal ones are matched once and count as many. Bins are
    open at once and a bin's kinds are spread over tasks by hash: the references,
    one row a bin, are sent to them where they are MAX_SENT at most. (More bins are joined by a shuffle; then a bin's kinds of one round
    meet in one partition, which the adaptive planner may split.) So a bin of any size is work for the whole cluster.
    """
    parts = parts or loci.sparkSession.sparkContext.defaultParallelism * 2
    # Filters and digests read what is stored: before, they would compute the sequences again, each for itself.
    stored = checkpointed(loci).where("length(seq) > 0")
    rows = stored.withColumn("of", F.expr(DIGEST))
    kinds = stored.groupBy(*KEY, "seq").agg(F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("n")).withColumn("of", F.expr(DIGEST))
    pool = checkpointed(kinds.repartition(parts, *KEY, "row_id"))
    done = taken = None
    own = "entry_id string, motif string, of binary, row_id long, n long, seq string, is_own boolean, turned string"

    def match(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, list[tuple[int, str]]] = {}
        for df in batches:
            seqs = df["seq"].tolist()
            turned: list[str | None] = [None] * len(seqs)
            for ref, at in K.grouped(df["ref"]).items():
                if ref not in known:
                    known[ref] = K.anchors(ref, how.anchor_length, how.anchor_offsets, how.require_unique_anchor)
                for i, own in zip(at, K.anchored([seqs[i] for i in at], known[ref], how.min_identity), strict=True):
                    turned[i] = own
            df["turned"] = turned
            yield df[["entry_id", "motif", "of", "row_id", "n", "seq", "is_own", "turned"]]

    for number in range(1, how.max_rounds + 1):
        sized = pool.withColumn("len", F.length("seq"))
        picked = references(sized, KEY, "len", ["row_id", "seq", "of"], how.min_cluster_size, "n")
        refs, n_refs = kept(picked.select(*KEY, F.col("r.row_id").alias("ref_id"), F.col("r.seq").alias("ref"), F.col("r.of").alias("of")))
        if not n_refs:
            break
        # The reference is one locus: the others of its kind are matched as all are.
        sent = refs.drop("of")
        others = pool.join(F.broadcast(sent) if n_refs <= MAX_SENT else sent, KEY).withColumn("is_own", F.col("row_id") == F.col("ref_id"))
        others = others.withColumn("n", F.col("n") - F.col("is_own").cast("long")).where("n > 0")
        matched = checkpointed(others.select(*KEY, "of", "row_id", "n", "seq", "is_own", "ref").mapInPandas(match, own))
        joined = matched.where("turned IS NOT NULL").select(*KEY, "of", "row_id", F.lit(False).alias("is_reference"), F.col("turned").alias("seq"), "n")
        single = refs.select(*KEY, "of", F.col("ref_id").alias("row_id"), F.lit(True).alias("is_reference"), F.col("ref").alias("seq"), F.lit(1).cast("long").alias("n"))
        joined = joined.unionByName(single)
        big = joined.groupBy(*KEY).agg(F.sum("n").alias("size")).where(F.col("size") >= how.min_cluster_size)
        found = checkpointed(joined.join(big.select(*KEY), KEY, "left_semi").withColumn("round", F.lit(number)))
        ids = refs.select(*KEY, F.col("ref_id").alias("row_id"))
        done, taken = (found, ids) if done is None else (done.unionByName(found), taken.unionByName(ids))
        pool = matched.where("turned IS NULL").select(*KEY, "of", "row_id", "n", "seq", "is_own")
        left = pool.where("is_own").select(*KEY, "of", F.col("row_id").alias("gone"))
        if not left.isEmpty():
            # A reference without anchors does not even match its copies: the first of those left now stands for them.
            first = rows.join(left, [*KEY, "of"]).where("row_id > gone").groupBy(*KEY, "of").agg(F.min("row_id").alias("first"))
            pool = checkpointed(pool.join(first, [*KEY, "of"], "left").withColumn("row_id", F.coalesce("first", "row_id")))
        pool = pool.select(*KEY, "of", "row_id", "n", "seq")
    if done is None:
        done = rows.sparkSession.createDataFrame([], "entry_id string, motif string, of binary, row_id long, is_reference boolean, seq string, n long, round int")
        taken = done.select(*KEY, "row_id")
    return Peeled(rows, done, taken)


def peeled(loci: DataFrame, how: Peeling = Peeling(), parts: int | None = None) -> DataFrame:
    """entry_id, motif, row_id, round, is_reference and seq of each clustered locus (see by_kinds), turned. ``loci``: entry_id, motif, row_id (file order), seq."""
    found = by_kinds(loci.select(*KEY, "row_id", "seq"), how, parts).loci()
    return found.select(*KEY, "row_id", "round", "is_reference", F.col("turned").alias("seq"))


def consensus(members: DataFrame, how: Peeling = Peeling(), parts: int | None = None) -> DataFrame:
    """entry_id, motif, round and consensus: all members aligned to the reference, and a vote in each column. A member counts n times (without that column, once).

    Equal members are aligned once. They are aligned in parallel and vote as counts a column, added up in their task first: no task holds a cluster, and what is
    shuffled are columns, not letters. Columns are those of the reference,
    and between them those that insertions open: the k-th inserted base is the k-th such column.
    """
    parts = parts or members.sparkSession.sparkContext.defaultParallelism * 2
    refs = members.where("is_reference").select(*KEY, "round", F.col("seq").alias("ref"))
    rows = members.groupBy(*KEY, "round", "seq").agg((F.sum("n") if "n" in members.columns else F.count(F.lit(1))).alias("n"))
    own = "entry_id string, motif string, round int, place int, slot int, base string, v long"

    def columns(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = np.array([chr(b) for b in range(256)])
        for df in batches:
            seqs, n = df["seq"].tolist(), df["n"].to_numpy()
            for (*key, ref), at in K.grouped(zip(*(df[k] for k in (*KEY, "round", "ref")), strict=True)).items():
                for cells in K.aligned(ref, [seqs[i] for i in at]):
                    place, slot, base, v = K.counted(cells, n[at])
                    yield pd.DataFrame(dict(zip((*KEY, "round"), key, strict=True)) | {"place": place.astype("int32"), "slot": slot.astype("int32"), "base": letters[base], "v": v})

    spread = rows.join(refs, [*KEY, "round"]).repartition(parts, *KEY, "round", "seq")
    cells = spread.select(*KEY, "round", "seq", "n", "ref").mapInPandas(columns, own)
    return vote(cells, rows.groupBy(*KEY, "round").agg(F.sum("n").alias("n")), [*KEY, "round"], how.max_gap_fraction, how.tie_seed, "v")


def vote(cells: DataFrame, sizes: DataFrame, keys: list[str], max_gap_fraction: float, seed: int = 1, counts: str | None = None) -> DataFrame:
    """The consensus of each group from its cells (place, slot, base) and its size n; rows without a cell have a gap there. A cell counts once, or as ``counts``, a
    column, says.

    Columns whose share of gaps is ``max_gap_fraction`` or more are dropped, and so are those without A, C, G or T; ties fall by a hash
    of the group and the column. An inserted column stands before its place (slot 1 and on), the place itself after it.
    """
    base = F.upper("base")
    votes = cells.where("base <> '-'").groupBy(*keys, "place", "slot", base.alias("base")).agg((F.sum(counts) if counts else F.count(F.lit(1))).alias("v"))
    per = votes.groupBy(*keys, "place", "slot").agg(
        F.sum("v").alias("filled"),
        F.max(F.when(F.col("base").isin(*"ACGT"), F.struct(F.col("v"), F.md5(F.concat_ws(":", F.lit(seed), *keys, "place", "slot", "base")).alias("h"), F.col("base").alias("b")))).alias("top"),
    )
    per = per.join(sizes, keys).where(((F.col("n") - F.col("filled")) / F.col("n") < max_gap_fraction) & F.col("top").isNotNull())
    order = F.struct("place", F.when(F.col("slot") == 0, 1 << 30).otherwise(F.col("slot")).alias("slot"), F.col("top.b").alias("b"))
    found = per.groupBy(*keys).agg(F.array_sort(F.collect_list(order)).alias("c"))
    return found.select(*keys, F.array_join(F.transform("c", lambda x: x["b"]), "").alias("consensus"))


def weighted(value: str, weight: str = "copy_number"):
    """Mean by weight, 0 where all weights are 0."""
    return F.coalesce(F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight)), F.lit(0.0))


def clusters(loci: DataFrame, how: Peeling = Peeling()) -> DataFrame:
    """Ranked clusters (schemas.CLUSTERS) of binned loci: entry_id, motif, target_period, window, row_id, consensus and measures."""
    own = loci.select(*KEY, "row_id", F.col("consensus").alias("seq"), *MEASURES)
    found = by_kinds(own, how)
    return _ranked(found.loci(), loci, consensus(found.members, how))


def summarised(members: DataFrame, loci: DataFrame, found: DataFrame) -> DataFrame:
    """Ranked clusters of ``members`` (entry_id, motif, round, row_id) with their consensus (``found``).

    Clusters rank by size, then by the round they were found in; one without a consensus keeps its rank and is left out. Copy numbers are
    rounded here to one place, as later thresholds and orders take them.
    """
    return _ranked(members.join(loci.select(*KEY, "row_id", *MEASURES), [*KEY, "row_id"]), loci, found)


def _ranked(rows: DataFrame, loci: DataFrame, found: DataFrame) -> DataFrame:
    """summarised, of members with their measures (``rows``)."""
    bins = loci.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_bin"), F.first("target_period").alias("target_period"), F.first("window").alias("window"))
    per = rows.groupBy(*KEY, "round").agg(
        F.count(F.lit(1)).alias("n_input_sequences"), F.sum("copy_number").alias("cn"),
        weighted("percent_match").alias("match"), weighted("entropy").alias("entropy"),
    )
    rank = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("n_input_sequences"), "round"))
    per = per.withColumn("rank", rank).join(bins, KEY).join(found, [*KEY, "round"]).where("length(consensus) > 0")
    return per.select(
        "entry_id", "motif", "target_period", "window", "rank", X.cluster_label(F.col("motif"), F.col("rank"), F.col("n_input_sequences")).alias("label"),
        "n_input_sequences", X.fixed(100 * F.col("n_input_sequences") / F.col("n_bin"), 2).alias("pct_of_bin"),
        F.length("consensus").alias("consensus_length"), X.fixed(X.gc_content(F.col("consensus")), 4).alias("gc_content"),
        X.fixed(F.col("cn"), 1).alias("total_copy_number"), X.fixed(F.col("match"), 2).alias("mean_percent_match"),
        X.fixed(F.col("entropy"), 4).alias("mean_entropy"), "consensus",
    )


def pooled(found: DataFrame, entries: DataFrame, min_total_copy_number: float) -> DataFrame:
    """Clusters of enough copies with their entry's data and the key cluster_uid."""
    meta = entries.select("entry_id", "individual", "assembly_method", "phasing_status")
    rows = found.where(F.col("total_copy_number") >= min_total_copy_number).join(meta, "entry_id")
    return rows.withColumn("cluster_uid", X.cluster_uid(F.col("entry_id"), F.col("label")))

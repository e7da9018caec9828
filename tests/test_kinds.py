"""Peeling over the different sequences of a bin: copies are matched and aligned once, and count as many."""

import random

import numpy as np
import plain
from pyspark.sql import functions as F

from satloom.functions import kernels as K
from satloom.operators import peeling
from satloom.params import Peeling


def _loci(spark, seqs):
    return spark.createDataFrame([("e", "cand", i, s) for i, s in enumerate(seqs)], "entry_id string, motif string, row_id long, seq string")


def _by_round(rows):
    got = {}
    for r in rows:
        got.setdefault(r["round"], []).append((r["row_id"], r["seq"]))
    return [sorted(x) for _, x in sorted(got.items())]


def test_copies_are_one_row_of_the_rounds_and_all_are_members(spark):
    rng = random.Random(5)
    units = ["".join(rng.choices("ACGT", k=n)) for n in (60, 63)]
    kinds = [K.rotate(u, 7 * i, 0) for u in units for i in range(4)]
    seqs = rng.choices(kinds, k=60)
    found = peeling.by_kinds(_loci(spark, seqs), parts=3)
    members = found.members.collect()
    assert len(members) <= len(kinds) + 2 and sum(r["n"] for r in members) == len(seqs)
    want = [sorted(c.items()) for c in plain.families(seqs)]
    assert _by_round(peeling.peeled(_loci(spark, seqs), parts=3).collect()) == want
    each = found.loci().select("entry_id", "motif", "row_id", "round", "is_reference", F.col("turned").alias("seq"))
    assert sorted(map(tuple, peeling.consensus(found.members).collect())) == sorted(map(tuple, peeling.consensus(each).collect()))


def test_references_without_anchors_leave_their_copies_in_the_bin(spark):
    """Sequences shorter than an anchor match nothing, so that a round takes the first copy alone and the next round the second."""
    rng = random.Random(6)
    unit = "".join(rng.choices("ACGT", k=40))
    seqs = ["ACGTACGTAC"] * 5 + ["TTGTACGTAC"] + [K.rotate(unit, 3 * (i % 2), 0) for i in range(4)]
    rng.shuffle(seqs)
    for size in (1, 3):
        got = _by_round(peeling.peeled(_loci(spark, seqs), Peeling(min_cluster_size=size), parts=3).collect())
        assert got == [sorted(c.items()) for c in plain.families(seqs, size=size)]


def test_cells_are_counted_by_the_rows_that_have_them():
    seqs, n = ["ACGT", "ACTGT", "AGT"], np.array([5, 2, 1])
    (cells,) = K.aligned("ACGT", seqs)
    want = {}
    for row, *cell in zip(cells.row, cells.place, cells.slot, cells.base, strict=True):
        want[tuple(map(int, cell))] = want.get(tuple(map(int, cell)), 0) + int(n[row])
    assert {(int(p), int(s), int(b)): int(v) for p, s, b, v in zip(*K.counted(cells, n), strict=True)} == want

"""Codes against plain Lloyd rounds in Python's own integers."""

import hashlib
import math
import random
from collections import defaultdict

import pytest

from satloom.llm import lloyd as L

SCHEMA = "vec_id long, embedding array<double>, label int, comps string, code int, error string, was int"


def plain(rows, how):
    kept = [(v, [math.floor(256 * x) for x in e], lab) for v, e, lab in rows if e and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], ""
    w = len(kept[0][1]) // how.parts
    cut = lambda c: [tuple(c[p * w : p * w + w]) for p in range(how.parts)]
    books = [[cut(c)[p] for _, c, _ in kept[: how.entries]] for p in range(how.parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))
    for _ in range(how.rounds):
        for p in range(how.parts):
            of = defaultdict(list)
            for _, c, _ in kept:
                of[near(cut(c)[p], books[p])[1]].append(cut(c)[p])
            books[p] = [tuple(sum(x) // len(of[i]) for x in zip(*of[i], strict=True)) if of[i] else e for i, e in enumerate(books[p])]
    out, sums = [], defaultdict(int)
    for v, c, lab in kept:
        best = [near(x, book) for x, book in zip(cut(c), books, strict=True)]
        out.append((v, "".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best), lab))
        sums[lab] += out[-1][2]
    text = ",".join(str(x) for book in books for e in book for x in e)
    return sorted(((v, code, err, sums[lab]) for v, code, err, lab in out), key=str), hashlib.sha256(text.encode()).hexdigest()


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).repartition(4)


def test_against_plain_rounds(spark):
    rng = random.Random(4)
    rows = [(i if i % 50 else None, [rng.gauss(i % 5, 1) for _ in range(8)], i % 3 if i % 7 else None) for i in range(400)]
    rows += [(500, None, 1), (501, [1.0, None] * 4, 1), (502, [float("nan")] * 8, 1), (503, [float("inf")] * 8, None), (504, [float("-inf")] + [0.0] * 7, None), (505, [], 1)]
    rows += [(1, rows[1][1], 1)] * 3 + [(7, [-0.001] * 8, 2), (8, [-3.5] * 8, 2)] + [(600 + i, [2.0] * 8, 5) for i in range(300)]
    for how in (L.Coding(4, 16, 2), L.Coding(8, 64, 3), L.Coding(2, 1, 1), L.Coding(4, 256, 1)):
        got = L.coded(table(spark, rows), how)
        want, books = plain(rows, how)
        assert L.digest(got.codebooks) == books
        labelled = L.label_errors(got.rows).collect()
        assert sorted(((r["vec_id"], r["code"].hex(), r["error"], r["label_error"]) for r in labelled), key=str) == want


def test_large_components_stay_exact(spark):
    rows = [(i, [float(1 << 20) * (i % 3), float(i)], 0) for i in range(9)]
    got = L.coded(table(spark, rows), L.Coding(1, 2, 2))
    assert sorted((r["vec_id"], r["code"].hex(), r["error"]) for r in got.rows.collect()) == sorted((v, c, e) for v, c, e, _ in plain(rows, L.Coding(1, 2, 2))[0])


def test_tables_that_cannot_be_coded(spark):
    assert L.coded(table(spark, [])).rows.collect() == []
    assert L.coded(table(spark, [(1, None, 1)])).rows.collect() == []
    for rows in ([(1, [1.0, 2.0], 0), (2, [1.0], 0)], [(1, [1.0, 2.0, 3.0], 0)], [(1, [1e15, 1e15], 0)]):
        with pytest.raises(ValueError):
            L.coded(table(spark, rows), L.Coding(2, 4, 1))
    with pytest.raises(ValueError):
        L.coded(table(spark, []), L.Coding(2, 257, 1))


def test_later_rounds_shuffle_what_moved_only(spark):
    rows = [(i, [float(i % 2), float(i % 2)], 0) for i in range(50)]
    batches = table(spark, rows)
    whole = L.whole_vectors(batches, 256).toArrow().to_batches()
    import numpy as np
    import pyarrow as pa

    same = [pa.RecordBatch.from_arrays([b.column("comps"), pa.array([b"\0\0"] * len(b)), pa.array([b"\0\0"] * len(b))], ["comps", "was", "code"]) for b in whole]
    assert sum(b.num_rows for b in L._moving(2, 4, 1)(iter(same))) == 0
    moved = [pa.RecordBatch.from_arrays([b.column("comps"), pa.array([b"\0\1"] * len(b)), pa.array([b"\0\2"] * len(b))], ["comps", "was", "code"]) for b in whole]
    got = {(p, e, k): d for b in L._moving(2, 4, 1)(iter(moved)) for p, e, k, d in zip(*(c.to_pylist() for c in b.columns), strict=True)}
    assert got == {(1, 1, 0): -50, (1, 1, 1): -25 * 256, (1, 2, 0): 50, (1, 2, 1): 25 * 256} and np.all([p == 1 for p, _, _ in got])

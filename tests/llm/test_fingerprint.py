"""Fingerprints against sets of paragraphs in Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from satloom.llm import fingerprint as P


def paragraphs(text):
    return {int(hashlib.md5(p.encode()).hexdigest()[:15], 16) for p in re.findall(r"[^\n]{128,}?[.!?]+|[^\n]+", text)}


def cells(digests, third=6):
    out = []
    for j in range(3):
        for r in range(third):
            own, k, x = [d for d in digests if (d >> 16 * j) % third == r], 0, 0
            for d in own:
                k, x = k ^ d, x ^ ((d % 2147483647) * ((d >> 29) + 1) % 2147483629)
            out.append(f"{len(own)}:{k:x}:{x:x}")
    return " ".join(out)


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    """Rows in their order: doc_id falling, nulls last. (Of one doc_id, the caller gives equal texts.)"""
    rows = [(i, t or "") for i, t in sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))]
    out = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        other = text[: len(text) - half] + after[:half]
        a, b, c = paragraphs(text), paragraphs(other), paragraphs(after)
        out.append((i, len(text), hashlib.sha256(other.encode()).hexdigest(), cells(a), cells(b), alike(a, b), alike(a, c)))
    return sorted(out, key=str)


def test_against_sets(spark, tmp_path):
    rng = random.Random(2)
    words = ["alpha", "béta", "gamma", "délta", "eta"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", " ", ". ", "\n", "!? ", "\n\n"]) for _ in range(n))
    rows = [(3 * i, text(rng.choice([0, 1, 5, 50, 400]))) for i in range(60)]
    rows += [(1000 + i, rows[7][1]) for i in range(5)] + [(-4, None), (-5, ""), (-6, "\n\n"), (2000, text(20_000)), (2001, "x" * 60_000), (2002, "𝒳 astral. " * 40), (-(1 << 62), "low"), (2003, "same line\n" * 3000)]
    rows += [(7, "twice")] * 2 + [(None, "no id")] * 3
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, rank int, paras string, block int").repartition(5)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, P.op12(spark, str(tmp_path)).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, "only one. " * 30)], [(1, None)], [(None, None)] * 3])
def test_small_tables(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, P.op12(spark, str(tmp_path)).collect()), key=str) == brute(rows)


def test_texts_of_one_doc_id_form_one_order(spark):
    rows = [(5, f"text {i % 40}") for i in range(200)] + [(None, f"none {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = P.beside(df).collect()
    assert len(got) == 400
    after = sorted((r["text"], r["next_text"]) for r in got)
    # Each text is followed as often as it follows; the order is one ring.
    assert sorted(a for a, _ in after) == sorted(b for _, b in after)
    ring, seen, at = {a: b for a, b in after if a != b}, [], "text 0"
    while at not in seen:
        seen.append(at)
        at = ring[at]
    assert len(seen) == 240


def test_differences_are_recovered_whatever_the_first_size(spark):
    rng = random.Random(8)
    sets = [(k, sorted(rng.sample(range(1 << 59), n)), m) for k, (n, m) in enumerate([(0, 0), (1, 1), (2, 0), (5, 5), (40, 3), (3, 40), (600, 600), (3000, 10)])]
    sets = [(k, a, sorted(set(a[: len(a) // 2]) | set(rng.sample(range(1 << 59), m)))) for k, a, m in sets]
    df = spark.createDataFrame(sets, "key long, a array<long>, b array<long>")
    for how in (P.Sketching(), P.Sketching(third=1, share=0.05, least=1, sweeps=1), P.Sketching(third=1000)):
        got = {r["key"]: (set(r["gone_digests"]), set(r["new_digests"]), r["gone"], r["new"]) for r in P.differences(df, how, listed=True).collect()}
        assert got == {k: (set(a) - set(b), set(b) - set(a), len(set(a) - set(b)), len(set(b) - set(a))) for k, a, b in sets}
    assert P.differences(df).agg(F.sum("gone"), F.sum("new")).first() == (sum(len(set(a) - set(b)) for _, a, b in sets), sum(len(set(b) - set(a)) for _, a, b in sets))


def test_no_python_on_the_main_path(spark):
    sets = spark.createDataFrame([(1, [1], [2])], "key long, a array<long>, b array<long>")
    plan = P._swept(P._sketched(sets, F.lit(6)), False)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

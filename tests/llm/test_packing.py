import random
from collections import Counter, defaultdict

from conftest import WORD  # type: ignore[import-not-found]

from satloom.llm import common as C
from satloom.llm import packing as P
from test_pipeline import sequences_hold  # type: ignore[import-not-found]

AT = "/root/testdata/sf0.01"


def sound(rows, sizes, longest):
    """Every word of every document is in one place, and no two share one."""
    bins, words = defaultdict(list), Counter()
    for r in rows:
        bins[r["pack_group"], r["bin"]].append(r)
        words[r["doc_id"]] += r["n_words"]
        assert r["first_word"] == r["piece"] * longest and 0 <= r["n_words"] <= longest
    assert {d: n for d, n in words.items() if n} == {d: n for d, n in sizes.items() if n} and set(words) == set(sizes)
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: (r["bin_offset"], r["n_words"])):
            assert r["bin_offset"] == at
            at += r["n_words"]
        assert all(r["bin_used"] == at <= r["bin_length"] for r in own)
        fits = min(n for n in P.Packing().lengths if n >= max(at, 1))
        assert all(r["bin_length"] == fits for r in own)
    return sum(own[0]["bin_length"] for own in bins.values())


def test_query_packs_every_word_once_and_tightly(spark):
    sizes = {r["doc_id"]: len(WORD.findall(r["text"])) for r in C.documents(spark, AT).collect()}
    room = sound(P.op5(spark, AT).collect(), sizes, 2048)
    assert room < 1.02 * sum(sizes.values())
    assert sorted(map(tuple, P.op5(spark, AT).collect())) == sorted(map(tuple, P.op5(spark, AT).collect()))


def test_groups_pack_by_themselves(spark):
    sizes = {r["doc_id"]: len(WORD.findall(r["text"])) for r in C.documents(spark, AT).collect()}
    rows = P.best_fit(C.documents(spark, AT), P.Packing(group_rows=150)).collect()
    assert len({r["pack_group"] for r in rows}) > 3
    assert sound(rows, sizes, 2048) < 1.1 * sum(sizes.values())


def test_best_fit_takes_the_fullest_bin_and_the_cheapest_length():
    bins, offsets, lengths = P.pack([6, 5, 4, 3, 2], [4, 8, 16], bin_cost=0)
    assert sum(lengths) == 20 and len(set(zip(bins, offsets, strict=True))) == 5
    assert P.pack([3], [4, 8], 0) == ([0], [0], [4])
    assert P.pack([], [4], 0) == ([], [], [])
    assert P.pack([0, 0], [4], 0) == ([0, 0], [0, 0], [4])
    rng = random.Random(5)
    for _ in range(50):
        sizes = sorted((rng.randint(0, 64) for _ in range(rng.randint(1, 200))), reverse=True)
        bins, _, lengths = P.pack(sizes, [16, 32, 64])
        used = Counter()
        for b, n in zip(bins, sizes, strict=True):
            used[b] += n
        assert all(used[b] <= lengths[b] for b in used) and sum(lengths) <= 1.25 * sum(sizes) + 64


def test_odd_and_empty_tables(odd, empty):
    rows = P.best_fit(odd, P.Packing(lengths=(16, 64))).collect()
    words = Counter()
    for r in odd.collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"] or ""))
    got = Counter()
    for r in rows:
        got[r["doc_id"]] += r["n_words"]
    assert got == words
    assert P.best_fit(empty).count() == 0


def test_texts_of_pieces_and_their_key(spark, odd, empty, tmp_path):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    rows = P.packed_texts(odd, P.Packing(lengths=(16, 64))).collect()
    sequences_hold(rows, docs)
    assert {(r["doc_id"], r["text"]) for r in rows if r["n_words"] < 64 and not r["piece"]} == {(d, t) for d, t in docs if len(WORD.findall(t or "")) < 64}
    assert P.packed_texts(empty).count() == 0
    odd.repartition(5).write.parquet(f"{tmp_path}/again")
    other = P.packed_texts(spark.read.parquet(f"{tmp_path}/again"), P.Packing(lengths=(16, 64))).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, other), key=str)

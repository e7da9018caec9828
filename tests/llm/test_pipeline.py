from collections import defaultdict

from conftest import WORD  # type: ignore[import-not-found]

import corpus_pipeline as P
from satloom.llm import common as C
from satloom.llm import quality
from test_dedup import key
from test_simhash import brute_groups

AT = "/root/testdata/sf0.01"


def sequences_hold(packed, docs):
    """The key is one; bins are their pieces one after another; and the pieces of a row are its words."""
    assert len({(r["doc_id"], r["text_hash"], r["copy"], r["piece"]) for r in packed}) == len(packed)
    bins, rows = defaultdict(list), defaultdict(list)
    for r in packed:
        bins[r["pack_group"], r["bin"]].append(r)
        rows[r["doc_id"], r["text_hash"], r["copy"]].append(r)
    for own in bins.values():
        sequence = []
        for r in sorted(own, key=lambda r: (r["bin_offset"], r["n_words"])):
            assert len(sequence) == r["bin_offset"]
            sequence += WORD.findall(r["text"] or "")
        assert len(sequence) == own[0]["bin_used"] <= own[0]["bin_length"]
    built = [(k[0], [w for r in sorted(own, key=lambda r: r["piece"]) for w in WORD.findall(r["text"] or "")]) for k, own in rows.items()]
    assert sorted(built, key=str) == sorted(((d, WORD.findall(t or "")) for d, t in docs), key=str)


def test_odd_and_empty_tables_run_through(spark, odd, empty, tmp_path):
    labels = spark.createDataFrame([(4, 1, 0), (None, 1, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")
    filler = spark.range(40).selectExpr("id + 100 AS doc_id", "array_join(transform(sequence(1, 30 + id), i -> concat('w', i * (id + 1) % 97)), ' ') AS text")
    for name, docs in (("odd", odd.unionByName(filler, allowMissingColumns=True)), ("empty", empty)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        found = P.run(spark, f"{tmp_path}/{name}").collect()
        assert bool(found) == (name == "odd")
        assert len({(r["doc_id"], r["text_hash"], r["copy"], r["piece"]) for r in found}) == len(found)


def test_stages_against_brute_force(spark, tmp_path):
    docs = C.documents(spark, AT)
    rows = [docs]
    for i, (_, stage) in enumerate(P.STAGES):
        rows.append(C.stored(stage(spark, rows[-1], AT), f"file://{tmp_path}/{i}"))
    start, kept, exact, near, mixed, packed = rows
    assert all(r.columns == docs.columns for r in rows[:-1])
    verdict = {r["doc_id"] for r in quality.op3(spark, AT).where("kept").collect()}
    text = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert set(text) == verdict
    last = {}
    for d in sorted(text):
        last[key(text[d])] = d
    assert {r["doc_id"] for r in exact.collect()} == set(last.values())
    groups = brute_groups([(d, text[d]) for d in sorted(last.values())])
    assert {r["doc_id"] for r in near.collect()} == {c for _, _, c in groups}
    words = lambda df: sum(len(WORD.findall(r["text"])) for r in df.collect())
    assert abs(words(mixed) - 1.5 * words(near)) < 0.02 * words(near)
    assert packed.agg({"n_words": "sum"}).first()[0] == words(mixed)
    sequences_hold(packed.collect(), [(r["doc_id"], r["text"]) for r in mixed.collect()])


def test_run_gives_the_last_stage(spark):
    assert P.run(spark, "/root/testdata/sf0.001").count() > 0
    assert [name for name, _ in P.STAGES] == ["quality rules", "exact dedup", "simhash near-dedup", "source mixing", "best-fit packing"]

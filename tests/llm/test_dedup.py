import hashlib
import random
import uuid

import duckdb
import pytest

from satloom.llm import common as C
from satloom.llm import dedup as D

LOW = str.maketrans(C.UPPER, C.LOWER)


def key(text):
    return hashlib.sha256((text or "").translate(LOW).encode()).hexdigest()


def test_query_equals_its_sql(spark):
    at = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{at}/documents.parquet'")
    order = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    got = sorted(tuple(r[c] for c in order) for r in D.op7(spark, at).collect())
    assert got == sorted(con.sql(f"SELECT {', '.join(order)} FROM ({D.OP7_SQL})").fetchall())


def test_odd_rows(spark, odd, empty):
    rows = D.exact_dedup(odd, D.fresh_index(spark)).collect()
    texts = [(r["doc_id"], key(r["text"])) for r in odd.collect()]
    assert len(rows) == len(texts)
    for k in {k for _, k in texts}:
        own = [r for r in rows if r["digest"].hex() == k]
        ids = [d for d, x in texts if x == k]
        assert sorted(map(str, (r["doc_id"] for r in own))) == sorted(map(str, ids))
        best = max((d for d in ids if d is not None), default=None)
        assert all(r["keep_id"] == best and r["group_size"] == len(ids) for r in own)
        assert [r["doc_id"] for r in own if r["kept"]] == [best]
    assert D.exact_dedup(empty, D.fresh_index(spark)).count() == 0


def test_index_keeps_what_it_has_seen(spark, tmp_path):
    name, docs = f"digests_{uuid.uuid4().hex}", "doc_id long, text string"
    first, second, third = (str(tmp_path / x) for x in "abc")
    spark.createDataFrame([(1, "a"), (2, "A"), (3, "b")], docs).write.parquet(first)
    spark.createDataFrame([(9, "a"), (8, "c"), (7, "C")], docs).write.parquet(second)
    spark.createDataFrame([(5, "c"), (6, "d")], docs).write.parquet(third)
    index = D.DigestIndex(spark, name, buckets=3, path=str(tmp_path / "index"))
    kept = lambda at, ix: sorted(r["doc_id"] for r in D.exact_dedup(spark.read.parquet(at), ix).where("kept").collect())
    assert kept(first, index) == [2, 3]
    rows = {r["doc_id"]: r["keep_id"] for r in D.exact_dedup(spark.read.parquet(second), index).collect()}
    assert rows == {9: 2, 8: 8, 7: 8} and index.table.count() == 3
    plan = index.unseen(D.digests(spark.read.parquet(third)))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    # Another session (here: another name) finds the table in its folder again.
    spark.sql(f"DROP TABLE {name}")
    again = D.DigestIndex(spark, f"{name}_again", buckets=3, path=str(tmp_path / "index"))
    assert kept(third, again) == [6] and again.table.count() == 4


def test_stage_keeps_columns(spark, odd):
    kept = D.stage(spark, odd, "")
    assert kept.columns == odd.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(["10", "2", "3", "5", "6", "7", "8", "9", "None"])


def test_a_batch_given_again_loses_nothing(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a"), (2, "A"), (None, "b"), (4, None)], "doc_id long, text string")
    index = D.DigestIndex(spark, f"digests_{uuid.uuid4().hex}", buckets=3, path=str(tmp_path / "index"))
    rows = lambda found: sorted(map(tuple, found.drop("rid").collect()), key=str)
    first = rows(D.exact_dedup(docs, index, "monday"))
    assert sum(r[-1] for r in first) == 3 and index.table.count() == 3
    # Neither the whole batch again nor one of which a part had been appended changes result or index.
    assert rows(D.exact_dedup(docs, index, "monday")) == first and index.table.count() == 3
    index.drop()
    part = D.DigestIndex(spark, f"digests_{uuid.uuid4().hex}", buckets=3, path=str(tmp_path / "part"))
    part.append(D.digests(docs.where("doc_id = 4")).selectExpr("digest", "doc_id AS keep_id", "1L AS n"), "monday")
    assert rows(D.exact_dedup(docs, part, "monday")) == first and part.table.count() == 3
    assert not any(r[-1] for r in rows(D.exact_dedup(docs, part, "tuesday"))) and part.table.count() == 3
    part.drop()


def test_batches_against_brute_force(spark, tmp_path):
    rng = random.Random(4)
    index = D.DigestIndex(spark, f"digests_{uuid.uuid4().hex}", buckets=4, path=str(tmp_path / "index"))
    known = {}
    for batch in range(3):
        rows = [(i, rng.choice("abcdefghijkl") * rng.randint(1, 3)) for i in range(batch * 30, batch * 30 + 30)]
        groups = {}
        for i, t in rows:
            groups.setdefault(key(t), []).append(i)
        want = [(i, key(t), known.get(key(t), max(groups[key(t)])), len(groups[key(t)]), key(t) not in known and i == max(groups[key(t)])) for i, t in rows]
        got = D.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), index, str(batch))
        assert sorted((r["doc_id"], r["digest"].hex(), r["keep_id"], r["group_size"], r["kept"]) for r in got.collect()) == sorted(want)
        known = {k: max(ids) for k, ids in groups.items()} | known
    index.drop()


def test_no_table_is_left_and_ids_must_be_whole_numbers(spark):
    before = {t.name for t in spark.catalog.listTables()}
    assert D.op7(spark, "/root/testdata/sf0.001").count() > 0
    assert {t.name for t in spark.catalog.listTables()} == before
    with pytest.raises(TypeError, match="doc_id"):
        D.exact_dedup(spark.createDataFrame([("x", "a")], "doc_id string, text string"), D.fresh_index(spark))

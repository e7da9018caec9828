import zlib
from collections import Counter

from conftest import int_, long_, spark_hash  # type: ignore[import-not-found]

from pyspark.sql import functions as F

from satloom.llm import common as C
from satloom.llm import sharding as S

AT = "/root/testdata/sf0.01"


def test_query_obeys_the_law(spark):
    docs = {r["doc_id"]: r["text"] for r in C.documents(spark, AT).collect()}
    rows = S.op6(spark, AT).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        data = docs[r["doc_id"]].encode()
        assert r["size"] == len(data) + 16 and r["text_crc32"] == zlib.crc32(data) and r["law"] == "key"
        assert 0 <= r["shard"] < 40 and r["grown_shard"] in (r["shard"], 40)
    for shard in range(40):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert 10 <= sum(r["grown_shard"] == 40 for r in rows) <= 45
    assert sorted(map(tuple, rows)) == sorted(map(tuple, S.op6(spark, AT).collect()))


def test_one_more_shard_is_where_rows_go(spark):
    docs = C.documents(spark, AT)
    grown = {r["doc_id"]: r["grown_shard"] for r in S.shuffled_shards(docs, shards=5).collect()}
    assert grown == {r["doc_id"]: r["shard"] for r in S.shuffled_shards(docs, shards=6).collect()}


def test_many_buckets_make_one_gapless_permutation(spark):
    rows = S.shuffled_shards(C.documents(spark, AT), shards=3, bucket_mb=0.1).collect()
    for shard in range(3):
        own = sorted((r["slot"], r["doc_id"]) for r in rows if r["shard"] == shard)
        assert [s for s, _ in own] == list(range(len(own)))
        ids = [d for _, d in own]
        rising = sum(a < b for a, b in zip(ids, ids[1:]))
        assert 0.4 < rising / len(ids) < 0.6


def test_odd_and_empty_tables(odd, empty):
    rows = S.shuffled_shards(odd, shards=2).collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in odd.collect())
    assert S.shuffled_shards(empty, shards=2).count() == 0


def test_shards_are_those_of_the_highest_ticket(spark):
    rows = S.op6(spark, AT).collect()
    for r in rows[::7]:
        tickets = [(spark_hash(int_(11), long_(r["doc_id"]), int_(s)), s) for s in range(41)]
        assert r["shard"] == max(tickets[:-1])[1] and r["grown_shard"] == max(tickets)[1]


def test_slots_do_not_depend_on_how_rows_lie(spark, tmp_path):
    """Nor on frequent copies: a third of the rows is one record without doc_id."""
    some = C.documents(spark, AT).select("doc_id", "text").limit(900)
    docs = some.unionByName(spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same").alias("text")))
    docs = docs.unionByName(docs.where("doc_id % 7 = 0"))
    found, partitions = [], spark.conf.get("spark.sql.shuffle.partitions")
    for files in (1, 5):
        docs.repartition(files, F.rand(files)).write.parquet(f"{tmp_path}/{files}")
        spark.conf.set("spark.sql.shuffle.partitions", str(files + 1))
        got = S.shuffled_shards(spark.read.parquet(f"{tmp_path}/{files}"), shards=3, bucket_mb=0.02)
        found.append(sorted(((r["shard"], r["slot"], r["doc_id"], r["text"]) for r in got.collect()), key=str))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert found[0] == found[1] and Counter(x[2:] for x in found[0]) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    for shard in range(3):
        own = sorted(x[1:3] for x in found[0] if x[0] == shard)
        assert [s for s, _ in own] == list(range(len(own)))


def test_copies_spread_over_the_buckets_of_their_shard(spark, tmp_path):
    spark.range(60_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("x" * 84).alias("text")).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    assert S.shuffled_shards(docs, shards=4, bucket_mb=0.5, path=f"{tmp_path}/out").select("slot").distinct().count() == 60_000
    sizes = [r["count"] for r in spark.read.parquet(f"{tmp_path}/out").groupBy("bucket").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 1.1 * 60_000 / 12


def test_copies_that_are_few_but_large_spread_too(spark, tmp_path, monkeypatch):
    """A hundred copies of 20 kB are fewer than one in ten thousand rows, and yet several buckets of text."""
    small = spark.range(1_100_000).select(F.col("id").alias("doc_id"), F.lit("tiny").alias("text"))
    large = spark.range(100).select(F.lit(-1).cast("long").alias("doc_id"), F.repeat(F.lit("long"), 5000).alias("text"))
    found = []
    for sent in (S.MAX_SENT, 0):
        monkeypatch.setattr(S, "MAX_SENT", sent)
        at = f"{tmp_path}/{sent}"
        S.shuffled_shards(small.unionByName(large), shards=2, bucket_mb=0.5, path=at)
        own = spark.read.parquet(at).where("doc_id = -1")
        assert own.count() == 100 and own.where("length(text) = 20000").count() == 100
        buckets = {r["bucket"]: r["count"] for r in own.groupBy("bucket").count().collect()}
        assert len(buckets) > 10 and max(buckets.values()) < 25
        found.append(buckets)
    assert found[0] == found[1]


def test_copies_of_texts_beyond_what_is_made_in_one_go(spark, monkeypatch):
    monkeypatch.setattr(S, "COPIED_BYTES", 1000)
    docs = spark.range(50).select(F.lit(7).cast("long").alias("doc_id"), F.repeat(F.lit("x"), 900).alias("text"))
    docs = docs.unionByName(spark.range(70).select(F.lit(8).cast("long").alias("doc_id"), F.lit("y" * 300).alias("text")))
    rows = S.shuffled_shards(docs, shards=2, bucket_mb=0.005).collect()
    assert Counter((r["doc_id"], len(r["text"])) for r in rows) == {(7, 900): 50, (8, 300): 70}
    for shard in {r["shard"] for r in rows}:
        own = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert own == list(range(len(own)))

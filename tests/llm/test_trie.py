"""Tries against a brute-force one of whole (role, text) sequences."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from satloom.llm import trie as T

SCHEMA = "conv_id long, turn long, role string, text string, digest string, n_convs int, parent string"


def item(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, item(role or "", text or ""), role or "", text or ""))
    turns = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(turns.get(c - int(c - 100 * int(c / 100)), [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = {n: [m for m in members if len(m) == len(n) + 1 and m[: len(n)] == n] for n in members}
    out = []
    for n, cs in members.items():
        below = [m for m in members if m[: len(n)] == n]
        saved = sum((len(members[m]) - 1) * len(m[-1][1]) for m in below if m)
        ends = ",".join(map(str, sorted(c for c in cs if len(built[c]) == len(n))))
        up = min(members[n[:-1]]) if n else None
        out.append((min(cs), len(n), up, len(cs), len(kids[n]), sum(not kids[m] for m in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, tmp_path, rows):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    return sorted(map(tuple, T.op11(spark, str(tmp_path)).collect()), key=str)


def test_against_brute_force(spark, tmp_path):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"said {(c * 7 + t) % 3} é" * (1 + t)) for c in (*range(40), *range(100, 130), 200, 305, 99_999_999_999, -5, -300) for t in range(c % 8)]
    rows += [(0, None, "system", "first"), (1, None, None, None), (2, 9, None, "x"), (2, 9, "x", None), (2, 9, "x", None), (None, 0, "user", "nobody"), (None, None, None, None), (17, 3, "u", "word " * 20_000)]
    assert found(spark, tmp_path, rows) == brute(rows)


def test_many_copies_of_one_conversation(spark, tmp_path):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 500_000, 100) for t in range(3)] + [(7, 0, "user", "else")]
    assert found(spark, tmp_path, rows) == brute(rows)


@pytest.fixture
def cut_small(spark):
    """Tables of a few KB meet as those of many MB do: a table is sent to the tasks where it turns out small, and small parts are read together."""
    own = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "5k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_turns_of_a_conversation_meet_whatever_the_planner_sends_or_merges(spark, tmp_path, cut_small):
    rows = [(c, t, "user", f"said {c % 7} {t}") for c in range(600) for t in range(5)]
    assert found(spark, tmp_path, rows) == brute(rows)


def test_no_conversations(spark, tmp_path):
    assert found(spark, tmp_path, []) == []
    with pytest.raises(TypeError):
        T.turns_of(spark.createDataFrame([("a", 1, "b", "c")], "conv_id string, turn int, role string, text string"))


def test_turnless_conversations_are_members_of_the_root(spark):
    turns = T.turns_of(spark.createDataFrame([(1, 0, "u", "a")], "conv_id long, turn long, role string, text string"))
    convs = spark.createDataFrame([(1,), (2,)], "conv_id long")
    got = T.trie(convs, turns.withColumn("part", F.lit(1)))
    assert sorted((r["depth"], r["conv_id"], r["n_convs"], r["n_children"]) for r in got.nodes.collect()) == [(0, 1, 2, 1), (1, 1, 1, 0)]
    assert sorted((r["conv_id"], r["depth"]) for r in got.prefixes.where("last").collect()) == [(1, 1), (2, 0)]


def test_a_long_conversation(spark):
    turns = spark.range(3000).select(F.lit(5).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"), F.col("id").cast("string").alias("text"))
    own = T.turns_of(turns)
    nodes = T.trie(own.select("conv_id").distinct(), own.withColumn("part", F.lit(1))).nodes
    assert nodes.agg(F.count("*"), F.max("depth"), F.max("n_leaves"), F.sum("saved_tokens")).first() == (3001, 3000, 1, 0)

"""A trie of conversations: what they share from their first turn on.

Each conversation is turned into a chain of digests, one for each of its prefixes: a prefix's digest is the SHA-256 of the digest before it and of
its last turn. A node of the trie is a (depth, digest) group of such prefixes. Texts are digested in the scan that reads them; what is
shuffled is a few numbers and 32 bytes a turn.

Sums over subtrees come from sending each node's figures to all its ancestors. A node is named after its smallest conversation, and if a
conversation names a node it names all below it on its own path: so the figures of a conversation's nodes are first summed
along its path, and each of its prefixes gets one row, not one for each node below. The rows are as many as turns, however deep the trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from satloom.llm import common as C

ROOT = hashlib.sha256(b"").digest()
PREFIX = "conv_id long, depth long, digest binary, parent binary, chars long, last boolean"
#: Conversations whose ids agree but for so many bits are listed together.
LISTED = 12


@dataclass(frozen=True)
class Trie:
    """``prefixes``: conv_id, depth, digest, parent, chars (of the last turn) and last (whether the conversation ends there), the empty prefix
    included. ``nodes``: depth, digest, parent, conv_id (the smallest member), n_convs, n_children, n_leaves, saved_tokens."""

    prefixes: DataFrame
    nodes: DataFrame


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1 on), item (a digest of role and text) and chars of each turn, by ``turn``, a missing one first.

    A missing role or text is empty. Turns of one conversation and number are ordered by item. Rows without a conv_id belong to no
    conversation and are left out; conv_id must be of an integer type (else TypeError); other columns are not looked at.
    """
    C.whole_number(conversations, "conv_id")
    own = C.pick(conversations, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    role, text = C.whole("role"), C.whole("text")
    item = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = own.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", item.alias("item"), F.char_length(text).cast("long").alias("chars"))
    pos = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "item"))
    return rows.select("conv_id", pos.cast("long").alias("pos"), "item", "chars")


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes of conversations whose turns come in order, each after a row without item. A row waits for the next to tell if it was the last."""
    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("digest", pa.binary()), ("parent", pa.binary()), ("chars", pa.int64()), ("last", pa.bool_())])
    held: tuple | None = None
    depth, digest, parent = 0, ROOT, None
    for batch in batches:
        out = []
        for conv, item, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "item", "chars")), strict=True):
            if item is None:
                depth, digest, parent = 0, ROOT, None
            else:
                depth, parent = depth + 1, digest
                digest = hashlib.sha256(parent + item).digest()
            if held is not None:
                out.append((*held, item is None))
            held = (conv, depth, digest, parent, chars)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*held, True), schema, strict=True)], schema=schema)


def prefixes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """PREFIX of every conversation in ``convs`` (conv_id, once each). ``turns``: conv_id, part and pos (their order), item, chars.

    A conversation's turns stream through one task in order; of all it has read the task holds one row. They are dealt by a hash of conv_id: dealing by conv_id
    itself is left out where the parts of the union turn out to lie by it already, and then each part is cut into tasks for itself.
    """
    heads = convs.select("conv_id", F.lit(0).alias("part"), F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("item"), F.lit(0).cast("long").alias("chars"))
    rows = heads.unionByName(turns.select("conv_id", "part", "pos", "item", "chars"))
    rows = rows.repartition(F.xxhash64("conv_id")).sortWithinPartitions("conv_id", "part", "pos")
    return rows.select("conv_id", "item", "chars").mapInArrow(_chained, PREFIX)


def trie(convs: DataFrame, turns: DataFrame) -> Trie:
    """The trie of ``convs`` and ``turns`` (see prefixes). Conversations without turns are members of the root; without any there are no nodes.

    saved_tokens counts, in a node's subtree, the letters of its last turn for each member but one: what storing it once saves.
    """
    at = C.shared_dir(convs.sparkSession)
    paths = C.stored(prefixes(convs, turns), f"{at}/paths")
    groups = paths.groupBy("depth", "digest").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    # The smallest member's own prefix tells the parent and the letters: no bytes in aggregates, which stay on hashes.
    nodes = groups.join(paths.select("conv_id", "depth", "parent", "chars"), ["conv_id", "depth"])
    nodes = C.stored(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")).drop("chars"), f"{at}/nodes")
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("digest")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = C.stored(nodes.join(kids, "digest", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), f"{at}/tree")
    named = nodes.select("conv_id", "depth", "saved", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaf"))
    below = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    owed = paths.join(named, ["conv_id", "depth"], "left").select("digest", F.sum("saved").over(below).alias("saved"), F.sum("leaf").over(below).alias("leaves"))
    sums = owed.where("leaves IS NOT NULL").groupBy("digest").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    nodes = nodes.join(sums, "digest").select("depth", "digest", "parent", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    return Trie(paths, C.stored(nodes, f"{at}/sums"))


def with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` with parent_conv_id, null for the root. A node with many children is one row beside them, and the planner splits the many."""
    up = nodes.select(F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(up, "parent", "left")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each digest's lists, which come in order, joined by commas."""
    schema = pa.schema([("digest", pa.binary()), ("ends_sha256", pa.string())])
    of, so_far = None, hashlib.sha256()
    for batch in batches:
        out = []
        for digest, ids in zip(batch.column("digest").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if digest != of:
                if of is not None:
                    out.append((of, so_far.hexdigest()))
                of, so_far = digest, hashlib.sha256(ids.encode())
            else:
                so_far.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
    if of is not None:
        yield pa.RecordBatch.from_arrays([pa.array([of], pa.binary()), pa.array([so_far.hexdigest()], pa.string())], schema=schema)


def ends(paths: DataFrame) -> DataFrame:
    """digest and ends_sha256, the SHA-256 of the ids of conversations that end there (ascending, by commas), of nodes with such.

    Ids are first listed by runs of 2^LISTED numbers, wherever they lie; the runs of a node then stream through one task in order.
    """
    runs = paths.where("last").groupBy("digest", F.shiftright("conv_id", LISTED).alias("run")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    lists = runs.select("digest", "run", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    return lists.repartition("digest").sortWithinPartitions("digest", "run").select("digest", "ids").mapInArrow(_hashed, "digest binary, ends_sha256 string")


def rebuilt(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations and turns (see prefixes) in which conversation c begins with the first h turns of conversation c - c % group.

    h is the CRC-32 of c's decimal digits modulo ``most``; c's own turns follow from number h + 1 on. % is SQL's, so that it has c's sign.
    """
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    how = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"))
    fronts = turns.where((F.col("conv_id") % group == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "base")
    front = how.join(fronts, "base").where("pos <= h").select("conv_id", F.lit(1).alias("part"), "pos", "item", "chars")
    own = turns.join(how, "conv_id").where("pos > h").select("conv_id", F.lit(2).alias("part"), "pos", "item", "chars")
    return convs.select("conv_id"), front.unionByName(own)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = C.checkpointed(turns_of(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    found = trie(*rebuilt(turns))
    rows = with_parents(found.nodes).join(ends(found.prefixes), "digest", "left")
    ending = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    return rows.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", ending)


OP11_SQL = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
 i AS (SELECT conv_id, turn, sha256(strlen(role) || ':' || role || text) AS item, length(text) AS chars FROM t),
 o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, item) AS pos, item, chars FROM i),
 c AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
   lambda crc, b: list_reduce(list_prepend(xor(crc, b), CAST(range(8) AS BIGINT[])), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 6 AS h FROM (SELECT DISTINCT conv_id FROM o)),
 r AS (SELECT c.conv_id, 1 AS part, pos, item, chars FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 100 AND pos <= h
  UNION ALL SELECT c.conv_id, 2, pos, item, chars FROM c JOIN o ON o.conv_id = c.conv_id AND pos > h),
 l AS (SELECT conv_id, list(item ORDER BY part, pos) AS items, list(chars ORDER BY part, pos) AS sizes FROM r GROUP BY conv_id),
 a AS (SELECT c.conv_id, coalesce(items, []) AS items, sizes FROM c LEFT JOIN l ON l.conv_id = c.conv_id),
 p AS (SELECT conv_id, depth, array_to_string(items[1:depth], '') AS key, CASE WHEN depth = 0 THEN 0 ELSE sizes[depth] END AS chars, depth = len(items) AS last
  FROM (SELECT *, unnest(range(0, len(items) + 1)) AS depth FROM a)),
 n AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256 FROM p GROUP BY depth, key),
 k AS (SELECT substr(key, 1, 64 * (depth - 1)) AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
 m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.key = n.key),
 s AS (SELECT substr(key, 1, 64 * up) AS key, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM m) GROUP BY 1)
SELECT m.conv_id, m.depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN s ON s.key = m.key LEFT JOIN m q ON m.depth > 0 AND q.depth = m.depth - 1 AND q.key = substr(m.key, 1, 64 * (m.depth - 1))
"""

"""SimHash fingerprints, links between near ones, and the groups that links make.

Fingerprints are embedded as counts of set bits in short segments. The Manhattan distance of two embeddings never exceeds
the fingerprints' Hamming distance, so a grid on the embeddings finds every link: with the segments in ``blocks`` runs, two
points within ``radius`` agree wholly on at least ``blocks - radius`` runs, and each choice of so many runs is a grid whose
cells are joined. In a cell the embeddings' distance is tested first, the fingerprints' own distance after it. Cells give
spanning forests, not pairs, so that a group of near copies costs a row for each fingerprint and cell.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satloom.llm import common as C

SHINGLE, RADIUS, SEED = 4, 4, 42
ODD = 0x5555555555555555
#: Hashes that are made and counted at once.
CHUNK = 1 << 16
#: Bytes of text that are taken apart at once; longer texts come in pieces.
SLICE = 2 << 20
#: Fingerprints of a cell that are compared with one another; larger cells are split anew.
CELL = 1 << 14
#: Rows of cells that a task holds at once.
HELD = 1 << 17

#: The primes of XXH64; fixed values.
P1, P2, P3, P4, P5 = (
    np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
#: What each byte is turned into: A-Z lower-cased, all that separates words a space.
FOLD = bytes(32 if b == 32 or 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Each byte as eight bytes that hold its bits.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _mixed(state: np.ndarray | np.uint64, lane: np.ndarray) -> np.ndarray:
    return _turned(state + lane * P2, 31) * P1


def xxh64(buffer: bytes, begin: np.ndarray, length: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of each span of ``buffer`` (its last 8 bytes are padding), all spans step by step together."""
    eight = np.ascontiguousarray(np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,)))
    own = lambda *more: np.uint64((seed + sum(more)) % (1 << 64))
    h = np.full(len(begin), own(int(P5)), np.uint64)
    at, stripes = begin.copy(), length >> 5
    long = np.flatnonzero(stripes)
    if len(long):
        lanes = [np.full(len(long), x, np.uint64) for x in (own(int(P1), int(P2)), own(int(P2)), own(), own(-int(P1)))]
        left, where, live = stripes[long], at[long], np.arange(len(long))
        while len(live):
            for i in range(4):
                lanes[i][live] = _mixed(lanes[i][live], eight[where[live] + 8 * i])
            where[live] += 32
            left[live] -= 1
            live = live[left[live] > 0]
        merged = _turned(lanes[0], 1) + _turned(lanes[1], 7) + _turned(lanes[2], 12) + _turned(lanes[3], 18)
        for lane in lanes:
            merged = (merged ^ _mixed(np.uint64(0), lane)) * P1 + P4
        h[long], at[long] = merged, where
    h += length.astype(np.uint64)
    rest = length & 31
    for k in range(3):
        i = np.flatnonzero(rest >= 8 * (k + 1))
        h[i] = _turned(h[i] ^ _mixed(np.uint64(0), eight[at[i]]), 27) * P1 + P4
        at[i] += 8
    i = np.flatnonzero(rest & 4)
    h[i] = _turned(h[i] ^ ((eight[at[i]] & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
    at[i] += 4
    for k in range(3):
        i = np.flatnonzero((rest & 3) > k)
        h[i] = _turned(h[i] ^ ((eight[at[i]] & np.uint64(0xFF)) * P5), 11) * P1
        at[i] += 1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def segments(text: bytes, size: int, shingle: int = SHINGLE) -> Iterator[bytes]:
    """``text`` in pieces of about ``size`` bytes whose shingles, together, are its own: each starts with the last words before it."""
    at, tail, some = 0, b"", False
    while len(text) - at > size:
        space = re.compile(rb"[\x20\x09-\x0D]").search(text, at + size)
        cut = space.start() if space else len(text)
        piece = tail + b" " + text[at:cut] if at else text[:cut]
        words = piece.rsplit(None, shingle - 1)
        at, tail = cut, piece
        if len(words) == shingle:
            yield piece
            tail, some = b" ".join(words[1:]), True
    piece = tail + b" " + text[at:] if at else text
    if not some or len(piece.split(None, shingle - 1)) == shingle:
        yield piece


def _words(joined: bytes, starts: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Texts joined by spaces (one at the end), A-Z lower-cased, one space after each word: bytes, words' starts and ends, words of each text."""
    raw = np.frombuffer(joined.translate(FOLD), np.uint8)
    word = raw != 32
    edges = np.flatnonzero(np.diff(word, prepend=False))
    first, stop = edges[::2], edges[1::2]
    counts = np.diff(np.searchsorted(first, np.append(starts, len(raw))))
    room = stop - first + 1
    begin = np.cumsum(room) - room
    word[stop] = True
    return raw[word].tobytes(), begin, begin + room - 1, counts


def _tallied(hashes: np.ndarray, own: np.ndarray, counts: np.ndarray) -> None:
    """Adds to ``counts`` (64 a text) how often each bit is set in the hashes of the texts ``own`` (in order).

    Eight counters share a number, and none of them sees more than 255 hashes before it goes to a column of its own.
    """
    n = np.arange(len(own))
    fresh = np.append(True, own[1:] != own[:-1])
    run = n - np.maximum.accumulate(np.where(fresh, n, 0))
    cut = np.flatnonzero(run % 255 == 0)
    text = own[cut]
    first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    parts = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    for k in range(8):
        sums = np.add.reduceat(SPREAD[parts[:, k]], cut).view(np.uint8).reshape(-1, 8)
        counts[text[first], 8 * k : 8 * k + 8] += np.add.reduceat(sums, first, axis=0, dtype=np.int64)


def _count(pieces: list[bytes], owner: list[int], counts: np.ndarray, total: np.ndarray, shingle: int, seed: int) -> None:
    lengths = np.array([len(t) + 1 for t in pieces], np.int64)
    buffer, begin, end, words = _words(b" ".join(pieces) + b" ", np.cumsum(lengths) - lengths)
    shingles = np.where(words >= shingle, words - shingle + 1, (words > 0).astype(np.int64))
    first_word = np.cumsum(words) - words
    piece = np.repeat(np.arange(len(pieces)), shingles)
    at = np.arange(len(piece)) - np.repeat(np.cumsum(shingles) - shingles, shingles) + first_word[piece]
    stop = end[at + np.minimum(words[piece], shingle) - 1]
    text, buffer = np.array(owner)[piece], buffer + bytes(8)
    np.add.at(total, np.array(owner), shingles)
    for i in range(0, len(piece), CHUNK):
        start = begin[at[i : i + CHUNK]]
        low = int(start[0])
        # Spans are in order, so that a chunk needs a stretch of the bytes only.
        stretch = buffer[low : int(stop[min(i + CHUNK, len(stop)) - 1]) + 8]
        _tallied(xxh64(stretch, start - low, stop[i : i + CHUNK] - start, seed), text[i : i + CHUNK], counts)


def fingerprints(texts: list[bytes], shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The fingerprint of each text, as uint64; 0 for a text without words."""
    counts, total = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    pieces: list[bytes] = []
    owner: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        for piece in segments(text, SLICE, shingle):
            if pieces and size + len(piece) > SLICE:
                _count(pieces, owner, counts, total, shingle, seed)
                pieces, owner, size = [], [], 0
            pieces.append(piece)
            owner.append(i)
            size += len(piece)
    if pieces:
        _count(pieces, owner, counts, total, shingle, seed)
    set_ = (2 * counts > total[:, None]).astype(np.uint8)
    return np.packbits(set_, axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = fingerprints(batch.column("text").cast(pa.binary()).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), pa.array(fp.view(np.int64))], ["rid", "doc_id", "fp"])


def fingerprinted(docs: DataFrame, rid: str | None = None) -> DataFrame:
    """rid, doc_id and fp (64 bits as a long) of each row; null and empty texts have fingerprint 0."""
    rows = C.keyed(docs, "doc_id", "text", rid=rid).select("rid", F.col("doc_id").cast("long").alias("doc_id"), C.whole().alias("text"))
    return rows.mapInArrow(_fingerprint_batches, "rid long, doc_id long, fp long")


def embedding(fp: np.ndarray) -> np.ndarray:
    """Counts of set bits in segments of two bits, a count of n as n ones: so equal counts are equal bits, and the
    Manhattan distance of two embeddings is the number of bits in which they differ."""
    pair = np.uint64(ODD)
    one, two = (fp | (fp >> np.uint64(1))) & pair, (fp & (fp >> np.uint64(1))) & pair
    return one | (two << np.uint64(1))


def grids(n: int, radius: int = RADIUS) -> list[int]:
    """A mask of the embedding for each grid, with so many blocks that ``n`` fingerprints cost least.

    A row costs about what 200 comparisons cost; two random segments agree with probability 3/8.
    """
    best: tuple[float, list[int]] = (float("inf"), [])
    for blocks in range(radius + 1, radius + 7):
        edges = [round(32 * i / blocks) for i in range(blocks + 1)]
        runs = [sum(3 << (2 * s) for s in range(a, b)) for a, b in itertools.pairwise(edges)]
        chosen = list(itertools.combinations(runs, blocks - radius))
        kept = 32 * (blocks - radius) / blocks
        cost = n * len(chosen) * (200 + n / 2 * 0.375**kept)
        if cost < best[0]:
            best = (cost, [sum(c) for c in chosen])
    return best[1]


class Forest:
    """Union-find over positions 0 to n-1, with whole arrays of links at a time; the root of a set is its least position."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def flatten(self) -> None:
        while True:
            up = self.root[self.root]
            if np.array_equal(up, self.root):
                return
            self.root = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            self.flatten()


def linked(cell: np.ndarray, fp: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints (distinct) that link to another in one of the sorted cells, and the least fingerprint they reach so.

    Each row meets the d-th after it in its cell, for every d that the cell has, unless both are already in one set; a cell
    that has become one set is done with. So all links are found or implied, and a group of near copies ends soon.
    """
    nodes, node = np.unique(fp, return_inverse=True)
    sets, flat = Forest(len(nodes)), embedding(fp)
    start = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, int)
    size = np.diff(np.append(start, len(cell)))
    last = np.repeat(start + size, size)
    live, d = np.arange(len(cell)), 1
    while len(live):
        live = live[live + d < last[live]]
        a, b = live, live + d
        apart = sets.root[node[a]] != sets.root[node[b]]
        a, b = a[apart], b[apart]
        near = np.bitwise_count(flat[a] ^ flat[b]) <= radius
        a, b = a[near], b[near]
        near = np.bitwise_count(fp[a] ^ fp[b]) <= radius
        sets.link(node[a[near]], node[b[near]])
        if d & (d - 1) == 0 and len(live):
            root = sets.root[node]
            low, high = np.minimum.reduceat(root, start), np.maximum.reduceat(root, start)
            live = live[~np.repeat(low == high, size)[live]]
        d += 1
    moved = sets.root != np.arange(len(nodes))
    return nodes[moved], nodes[sets.root[moved]]


FOUND = "u long, v long, again boolean"


def _found(u: np.ndarray, v: np.ndarray, again: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(np.full(len(u), again))], ["u", "v", "again"])


def _cell_batches(radius: int, most: int | None):
    """Links of the cells of ``most`` rows or less; the rows (fp, cell) of larger ones are given back to be split ``again``.

    Cells come sorted. A task holds HELD rows and the cell it is in; of a cell that is too large it holds no more than that.
    """

    def done(cell: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        start = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        size = np.diff(np.append(start, len(cell)))
        large = np.repeat(size > (most or len(cell)), size)
        if large.any():
            yield _found(fp[large], cell[large], True)
            cell, fp = cell[~large], fp[~large]
        if len(cell):
            u, v = linked(cell, fp.view(np.uint64), radius)
            yield _found(u.view(np.int64), v.view(np.int64), False)

    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, fp, passed = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = np.concatenate([cell, batch.column("cell").to_numpy()])
            fp = np.concatenate([fp, batch.column("fp").to_numpy()])
            if passed is not None:
                more = int(np.searchsorted(cell, passed, side="right"))
                yield _found(fp[:more], cell[:more], True)
                cell, fp = cell[more:], fp[more:]
                passed = passed if not len(cell) else None
            if len(cell) >= HELD:
                last = int(np.searchsorted(cell, cell[-1]))
                if last:
                    yield from done(cell[:last], fp[:last])
                    cell, fp = cell[last:], fp[last:]
                if most and len(cell) > most:
                    yield _found(fp, cell, True)
                    cell, fp, passed = cell[:0], fp[:0], cell[-1]
        if len(cell):
            yield from done(cell, fp)

    return forests


def _links(rows: DataFrame, radius: int, most: int | None) -> DataFrame:
    dealt = rows.repartition("cell").sortWithinPartitions("cell", "fp")
    return dealt.mapInArrow(_cell_batches(radius, most), FOUND)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def finer(radius: int = RADIUS) -> list[int]:
    """Masks of the fingerprint's own bits: two within ``radius`` agree wholly on one of the masks at least.

    Of radius + 1 runs of bits one is the same in both, and so is one of radius + 1 runs of the other bits.
    """
    found = []
    cut = lambda bits: [bits[round(len(bits) * i / (radius + 1)) : round(len(bits) * (i + 1) / (radius + 1))] for i in range(radius + 1)]
    for run in cut(list(range(64))):
        rest = [b for b in range(64) if b not in run]
        found += [sum(1 << b for b in run + second) for second in cut(rest)]
    return found


def forest(points: DataFrame, n: int, radius: int = RADIUS, most: int = CELL) -> DataFrame:
    """Edges (u, v) between distinct fingerprints ``fp`` whose connected sets are those of all links within ``radius``.

    A cell of more than ``most`` fingerprints is split by masks of their own bits (finer), which loses no link either.
    """
    x = F.col("fp")
    one = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(ODD))
    two = x.bitwiseAND(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(ODD))
    flat = one.bitwiseOR(F.shiftleft(two, 1))

    def parts(bits: str, masks: list[int]):
        return F.posexplode(F.array(*(F.col(bits).bitwiseAND(F.lit(_signed(m)).cast("long")) for m in masks))).alias("grid", "part")

    rows = points.select("fp", flat.alias("flat")).select("fp", parts("flat", grids(n, radius)))
    # Two cells that hash alike (about one pair in 2^64) would only be compared for nothing.
    rows = rows.select("fp", F.xxhash64("grid", "part").alias("cell"))
    found = C.stored(_links(rows, radius, most), f"{C.shared_dir(points.sparkSession)}/links")
    edges, large = found.where("NOT again").select("u", "v"), found.where("again")
    if large.isEmpty():
        return edges
    large = large.select(F.col("u").alias("fp"), F.col("v").alias("of")).select("fp", "of", parts("fp", finer(radius)))
    large = large.select("fp", F.xxhash64("of", "grid", "part").alias("cell"))
    return edges.unionByName(_links(large, radius, None).select("u", "v"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` that are not the least of their connected set; root is that least node.

    Large-star and small-star steps in turn until nothing changes; each step is checkpointed in the shared folder. A node
    with very many neighbours meets them as a minimum (partial aggregation) and in a join that can be split: the minima are
    checkpointed, so that both sides of the join are plain shuffles.
    """

    def stars(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        least = C.checkpointed(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        return least, pairs.join(least, "u")

    now, before = C.checkpointed(edges.where("u <> v").distinct()), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        _, met = stars(both)
        large = C.checkpointed(met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        least, met = stars(large)
        small = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now = C.checkpointed(small.where("u <> v").distinct())
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark


def near_groups(docs: DataFrame, radius: int = RADIUS, rid: str | None = None) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, fp, component_id, stays.

    component_id is the least doc_id among all rows whose fingerprints are reached by links (null only if all those doc_ids are
    null); in each group the row of least doc_id (of repeated rows the first read) ``stays``. Texts without words, null ones
    included, have fingerprint 0 and link like any others. An empty table gives an empty result. doc_id must be of an
    integer type (else TypeError). rid: see common.keyed.
    """
    C.whole_number(docs, "doc_id")
    at = C.shared_dir(docs.sparkSession)
    rows = C.stored(fingerprinted(docs, rid), f"{at}/fingerprints").withColumn("place", C.place(F.col("doc_id"), F.col("rid"), 1))
    points = C.stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.min("place").alias("first")), f"{at}/points")
    stars = components(forest(points, points.count(), radius))
    named = points.join(stars.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least", "first")
    # Both stored: the join on a root with very many fingerprints can be split then.
    named = C.stored(named, f"{at}/rooted")
    best = C.stored(named.groupBy("root").agg(F.min("least").alias("least"), F.min("first").alias("first")), f"{at}/least")
    named = named.select("fp", "root").join(best, "root").select("fp", F.col("least").alias("component_id"), "first")
    found = rows.join(C.stored(named, f"{at}/named"), "fp")
    return found.select("rid", "doc_id", "fp", "component_id", (F.col("place") == F.col("first")).alias("stays"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_groups(C.documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    rows = C.numbered(docs)
    return C.only(rows, near_groups(rows, rid=C.ROW).where("stays"))

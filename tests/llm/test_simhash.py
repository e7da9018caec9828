import numpy as np
import pyarrow as pa
import xxhash
from conftest import WORD  # type: ignore[import-not-found]

from satloom.llm import common as C
from satloom.llm import simhash as S

LOW = str.maketrans(C.UPPER, C.LOWER)


def brute_fingerprint(text):
    words = WORD.findall((text or "").translate(LOW))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(rows):
    """(doc_id, fingerprint, component) of (doc_id, text) rows, all pairs compared."""
    fps = np.array([brute_fingerprint(t) for _, t in rows], np.uint64)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= 4) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted([(d, f"{int(fps[i]):016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)], key=str)


def compare(docs):
    got = S.near_groups(docs).collect()
    want = brute_groups([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted([(r["doc_id"], f"{r['fp'] & (1 << 64) - 1:016x}", r["component_id"]) for r in got], key=str) == want
    assert sum(r["stays"] for r in got) == len({find for _, _, find in want})


def test_all_documents_against_brute_force(spark):
    compare(C.documents(spark, "/root/testdata/sf0.01"))


def test_odd_and_empty_tables(odd, empty):
    compare(odd)
    assert S.near_groups(empty).count() == 0


def test_grids_lose_no_link():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 64, 300, np.uint64)
    near = base.copy()
    for _ in range(4):
        near ^= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
    fp = np.unique(np.concatenate([base, near]))
    a, b = np.triu_indices(len(fp), 1)
    close = np.bitwise_count(fp[a] ^ fp[b]) <= 4
    whole = S.Forest(len(fp))
    whole.link(a[close], b[close])
    for n in (100, 10**6, 10**9, 10**11):
        masks = np.array(S.grids(n), np.uint64)
        flat = S.embedding(fp)
        found = S.Forest(len(fp))
        for m in masks:
            cell = flat & m
            order = np.lexsort((fp, cell))
            u, v = S.linked(cell[order], fp[order])
            found.link(np.searchsorted(fp, u), np.searchsorted(fp, v))
        assert np.array_equal(found.root, whole.root)


def test_embedding_bounds_distance():
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 1 << 64, (2, 2000), np.uint64)
    assert (np.bitwise_count(S.embedding(a) ^ S.embedding(b)) <= np.bitwise_count(a ^ b)).all()


def test_stage_keeps_columns_and_one_of_each_group(spark, odd):
    kept = S.stage(spark, odd, "")
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 1 in ids and 2 not in ids and 5 not in ids


def test_hashes_of_spans_are_xxh64():
    rng = np.random.default_rng(7)
    spans = [rng.bytes(n) for n in [*range(1, 140), *range(1, 40), 1000, 4999]]
    length = np.array([len(x) for x in spans])
    got = S.xxh64(b"".join(spans) + bytes(8), np.cumsum(length) - length, length)
    assert got.tolist() == [xxhash.xxh64_intdigest(x, 42) for x in spans]


def test_long_texts_in_pieces(monkeypatch):
    texts = ["a b c", " " * 200, "x" * 300, "x" * 300 + " y", "a " * 200, "aa bb " + "z" * 100 + " q   r" + " " * 99, "", "One\ttwo\n" * 300, "é ü " * 90, "w " * 600]
    for size in (1, 7, 50, 1000):
        monkeypatch.setattr(S, "SLICE", size)
        assert S.fingerprints([t.encode() for t in texts]).tolist() == [brute_fingerprint(t) for t in texts], size


def sets_of(fp, u, v):
    whole = S.Forest(len(fp))
    whole.link(np.searchsorted(fp, u), np.searchsorted(fp, v))
    return whole.root


def test_finer_masks_lose_no_link():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 64, 4000, np.uint64)
    near = base.copy()
    for _ in range(4):
        near ^= np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64)
    masks = np.array(S.finer(), np.uint64)
    assert len(masks) == 25 and (((base ^ near)[:, None] & masks) == 0).any(axis=1).all()


def test_large_cells_are_split_and_lose_no_link(spark):
    rng = np.random.default_rng(9)
    # All in a few cells of every grid: counts of bits are alike, bits are not.
    pairs = rng.integers(0, 2, (1500, 32), np.uint64)
    base = (np.uint64(1) << (pairs + 2 * np.arange(32, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64))
    fp = np.unique(np.concatenate([base, near]))
    points = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    edges = S.forest(points, len(fp), most=100).toPandas()
    got = sets_of(fp, edges["u"].to_numpy().view(np.uint64), edges["v"].to_numpy().view(np.uint64))
    a, b = np.triu_indices(len(fp), 1)
    close = np.bitwise_count(fp[a] ^ fp[b]) <= 4
    assert np.array_equal(got, sets_of(fp, fp[a[close]], fp[b[close]]))


def test_a_cell_of_any_size_is_passed_on_in_bounded_memory():
    fp = np.sort(np.random.default_rng(10).integers(-(1 << 63), 1 << 63, 50_000, np.int64))
    most_held = 0

    def batches():
        for i in range(0, 40 * len(fp), 10_000):
            own = fp[i % len(fp) : i % len(fp) + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.full(len(own), 5 if i else 4))], ["fp", "cell"])

    seen = again = 0
    for out in S._cell_batches(4, S.CELL)(batches()):
        most_held = max(most_held, out.num_rows)
        again += sum(out.column("again").to_pylist())
        seen += out.num_rows
    assert again == 40 * len(fp) - 10_000 and most_held <= 2 * S.HELD

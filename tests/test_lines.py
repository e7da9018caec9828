"""Readers at any size of split: what a file gives must not depend on where it is cut."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from satloom.sources import lines as L
from satloom.sources import sinks
from satloom.sources import text_formats as T
from satloom.plans import workflows



@pytest.fixture(params=[150, 1 << 20])
def cut(spark, request):
    """Splits of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, str(request.param))
    yield request.param
    for n, v in before.items():
        spark.conf.set(n, v)


def repeat_text(seed, n):
    rng, out, at = random.Random(seed), [], "unknown"
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.06:
            at = f"seq{rng.randrange(99)} more"
            out.append(f"Sequence: {at}")
        elif kind < 0.1:
            at = f"é{rng.randrange(99)}"
            out.append(f"@{at} word")
        elif kind < 0.2:
            out.append(rng.choice(["", "Parameters: 2 7", "1 2", "x" * 90]))
        else:
            rows.append((at, i, 171))
            out.append(f"{i} {i + 99} 171 2.5 171 90 2 800 25 25 25 25 1.5 ACGT ACGTACGT" + "\r" * rng.randrange(2))
    return "\n".join(out) + "\n" * rng.randrange(2), rows


def test_repeat_tables(spark, tmp_path, cut):
    want, paths = [], []
    for k, n in enumerate((120, 0, 1, 57)):
        text, rows = repeat_text(k, n)
        path = tmp_path / f"a b+{k}%.dat{'.gz' if k == 3 else ''}"
        path.write_bytes(gzip.compress(text.encode()) if k == 3 else text.encode())
        paths.append(str(path))
        want += [(k, *r) for r in rows]
    lines = T.numbered_lines(spark, paths)
    if cut < 200:
        assert lines.select("file_idx", "split").distinct().count() > 20
    own = T.trf_loci(lines).select("file_idx", "source_seq", "start_pos", "period", "line_no").collect()
    assert sorted((r["file_idx"], r["source_seq"], r["start_pos"], r["period"]) for r in own) == sorted(want)
    assert [r["start_pos"] for r in sorted(own, key=lambda r: r["line_no"]) if r["file_idx"] == 0] == [r[2] for r in want if r[0] == 0]
    full = T.counted(lines).where("file_idx = 0").orderBy("line_no").collect()
    text = repeat_text(0, 120)[0]
    assert [r["line"] for r in full] == [x.rstrip("\r") for x in text.removesuffix("\n").split("\n")] and [r["line_no"] for r in full] == list(range(len(full)))
    through = sorted(r["line_no"] for r in T.counted(lines, through=True).collect())
    assert through == list(range(len(through)))


def test_fasta(spark, tmp_path, cut):
    rng = random.Random(1)
    records = [(f"r{i % 7} no {i}", "".join(rng.choice("ACGTn") for _ in range(rng.choice([0, 1, 60, 700])))) for i in range(20)]
    body = lambda s, w: "".join(s[k : k + w] + "\n" for k in range(0, len(s), w))
    for name, own in (("a", records[:9]), ("b", records[9:])):
        (tmp_path / name).write_text("junk\n\n" + "".join(f">{h}\n{body(s, 7 + len(h))}\n" for h, s in own))
    lines = T.numbered_lines(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    got = T.fasta_records(lines).orderBy("file_idx", "rec_no").collect()
    assert [(r["header"], r["seq"]) for r in got] == records
    assert [r["length"] for r in T.fasta_lengths(lines).orderBy("file_idx", "rec_no").collect()] == [len(s) for _, s in records]
    heads = T.fasta_heads(lines, through=True).orderBy("place").collect()
    assert [(r["header"], r["place"]) for r in heads] == [(h, i) for i, (h, _) in enumerate(records, 1)]
    shards = workflows.sharded(T.fasta_heads(lines), 3).orderBy("file_idx", "rec_no").collect()
    assert [r["shard"] for r in shards] == [(0, 1, 2, 2, 1, 0)[(i if i < 9 else i - 9) % 6] for i in range(20)]
    for letters in (1, 1 << 16):
        whole = {}
        for r in sorted(T.fasta_chunks(lines, letters).collect(), key=lambda r: (r["file_idx"], r["rec_no"], r["start"])):
            key = (r["file_idx"], r["rec_no"])
            assert len(whole.get(key, "")) == r["start"] and len(r["seq"]) < letters + 30
            whole[key] = whole.get(key, "") + r["seq"]
        assert [whole[k] for k in sorted(whole)] == [s for _, s in records if s]


def test_files_that_are_cut_otherwise_are_an_error(spark):
    rows = spark.createDataFrame([(0, 1, "x", "s1"), (0, 2, "y", "s2")], L.LINES)
    small = spark.createDataFrame([(0, "s1", 5, True)], "file_idx int, split string, before long, _known boolean")
    with pytest.raises(Exception, match="other splits"):
        L.by_split(rows, small).collect()


def test_exports_in_many_parts(spark, tmp_path):
    """Without the planner's joining of small parts, an export is parts in order, the header in the first."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
        sinks.write_tsv(df, str(tmp_path / "t"), F.desc("k"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    parts = [p for p in sorted((tmp_path / "t").glob("part-*")) if p.stat().st_size]
    text = [x for p in parts for x in p.read_text().splitlines()]
    assert len(parts) >= 8 and text[0] == "k\tv" and [int(x.split("\t")[0]) for x in text[1:]] == list(range(999, -1, -1))
    lines = T.counted(T.numbered_lines(spark, [str(p) for p in parts]), through=True).orderBy("line_no").collect()
    assert [r["line"] for r in lines] == text


def test_many_faults_of_a_manifest(spark, tmp_path, cut):
    head = "entry_id\tindividual\tassembly_method\tphasing_status\tfasta_paths\ttrf_dat_paths"
    rows = ["", head, "# c\tomment", "a\ti\tm\tunphased\tx\ty", "b\ti\tm\tunphased\tx", "a\ti\tm\tphased_pooled\tx;\ty;z", " c \ti\tm\tphased_pooled\tx;w\ty; z", "d\ti\tm\tother\tx\ty", "a\ti\tm\tunphased\tx\ty"]
    (tmp_path / "m").write_text("\n".join(rows))
    found = T.violations(T.manifest_rows(spark, str(tmp_path / "m"))).orderBy("line_no", "rule").collect()
    assert [r["rule"] for r in found] == ["5 fields, not 6", "entry a again", "phased_pooled takes 2 path(s) in each column", "phasing_status other", "entry a again"]
    (tmp_path / "m").write_text("\n".join(rows[:4] + rows[6:7]))
    got = T.manifest(spark, str(tmp_path / "m")).orderBy("entry_id").collect()
    assert [(r["entry_id"], r["fasta_paths"], r["trf_dat_paths"]) for r in got] == [("a", ["x"], ["y"]), ("c", ["x", "w"], ["y", "z"])]

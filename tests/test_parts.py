"""Files that are folders of parts in order."""

from pyspark.sql import functions as F

from satloom.plans import files
from satloom.sources import sinks
from satloom.sources import text_formats as T


def test_a_table_in_many_parts_keeps_all_rows(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").alias("key"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("s "), "id")).alias("s"))
    sinks.write_tsv(rows.repartition(5), str(tmp_path / "t"), "key")
    for n, name in ((1, "one"), (3, "three")):
        head = spark.range(1).select(F.lit(-1).cast("long").alias("key"), F.lit("key\ts").alias("value"))
        text = head.unionByName(rows.select("key", F.concat_ws("\t", "key", F.coalesce("s", F.lit("NA"))).alias("value")))
        text.repartitionByRange(n, "key").sortWithinPartitions("key").select("value").write.text(str(tmp_path / name))
    assert len(list((tmp_path / "three").glob("part-*"))) == 3
    for name in ("t", "one", "three"):
        assert sorted(map(tuple, T.tsv(spark, str(tmp_path / name), "key long, s string").collect())) == [(i, f"s {i}" if i % 7 else None) for i in range(1000)]


def test_headers_carry_from_part_to_part_and_not_from_file_to_file(spark, tmp_path):
    for at, text in (("a/part-0", "Sequence: x\n1 2 3 4\n"), ("a/part-1", "5 6 7 8\n9 9 9 9\n"), ("a/part-2", "3 3 3 3\n@y\n4 4 4 4\n"), ("b/part-0", "@z\n8 8 8 8\n")):
        (tmp_path / at).parent.mkdir(exist_ok=True)
        (tmp_path / at).write_text(text)
    lines = T.numbered_lines(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    got = sorted((r["file_idx"], r["line_no"], r["source_seq"], r["start_pos"]) for r in T.trf_spans(lines).collect())
    assert [(i, s, p) for i, _, s, p in got] == [(0, "x", 1), (0, "x", 5), (0, "x", 9), (0, "x", 3), (0, "y", 4), (1, "z", 8)]
    assert [r["line_no"] for r in T.counted(lines).where("file_idx = 0").orderBy("line_no").collect()] == list(range(7))


def test_no_file_is_one_task(spark, monkeypatch):
    monkeypatch.setattr(files, "LINES_A_PART", 40)
    rows = spark.range(400).select(F.when(F.col("id") % 4 == 0, "f").otherwise("g").alias("file"), "id", F.concat(F.lit("l"), "id").alias("line"))
    names, paths = files.rendered(rows, "id")
    assert names == ["f", "g"] and all(len(T.L.parts(spark, p)) > 1 for p in paths)
    got = T.counted(T.numbered_lines(spark, paths)).orderBy("file_idx", "line_no").collect()
    assert [r["line"] for r in got] == [f"l{i}" for i in range(0, 400, 4)] + [f"l{i}" for i in range(400) if i % 4]

import pytest
from pyspark.sql import functions as F

from satloom.plans import workflows
from satloom.sources import sinks
from satloom.sources import text_formats as T

DAT = """Sequence: ctgA extra words
Parameters: 2 7 7 80 10 50 500
1 1710 171 10.0 171 98 1 3000 30 20 20 30 1.95 ACGT ACGTACGT
bad line
5 9 3 1.0
@ctgB more
100 600 171.5 2.9 172 90 2 800 25 25 25 25 2.00 GGCC GGCCGGCC
"""


def lines(spark, tmp_path, text, name="x"):
    (tmp_path / name).write_text(text)
    return T.numbered_lines(spark, [str(tmp_path / name)])


def test_strict_loci(spark, tmp_path):
    rows = T.trf_loci(lines(spark, tmp_path, DAT)).orderBy("line_no").collect()
    assert [(r["source_seq"], r["start_pos"], r["end_pos"], r["period"]) for r in rows] == [("ctgA extra words", 1, 1710, 171), ("ctgB", 100, 600, 172)]
    assert (rows[0]["consensus"], rows[0]["entropy"], rows[0]["percent_match"]) == ("ACGT", 1.95, 98.0)


def test_lenient_spans(spark, tmp_path):
    good = DAT.replace("171.5", "172")
    rows = T.trf_spans(lines(spark, tmp_path, good)).orderBy("line_no").collect()
    assert [(r["source_seq"], r["start_pos"], r["period"]) for r in rows] == [("ctgA", 1, 171), ("ctgA", 5, 3), ("ctgB", 100, 172)]
    with pytest.raises(Exception, match="171.5|CAST_INVALID"):
        T.trf_spans(lines(spark, tmp_path, DAT)).collect()
    with pytest.raises(Exception, match="no sequence above line"):
        T.trf_spans(lines(spark, tmp_path, "1 2 3 4\n")).collect()


def test_headers_end_with_their_file(spark, tmp_path):
    (tmp_path / "a").write_text(DAT)
    (tmp_path / "b").write_text("1 1710 171 10.0 171 98 1 3000 30 20 20 30 1.95 ACGT ACGTACGT")
    rows = T.trf_loci(T.numbered_lines(spark, [str(tmp_path / "a"), str(tmp_path / "b")])).where("file_idx = 1").collect()
    assert [(r["source_seq"], r["line_no"]) for r in rows] == [("unknown", 0)]


def test_fasta(spark, tmp_path):
    read = lines(spark, tmp_path, "junk\n>a one\nacg\n\nT\n>b\n>a two\r\nGG\r\n")
    own = T.fasta_records(read)
    assert [(r["header"], r["label"], r["seq"]) for r in own.orderBy("rec_no").collect()] == [("a one", "a", "acgT"), ("b", "b", ""), ("a two", "a", "GG")]
    assert {(r["label"], r["seq"]) for r in T.fasta_by_label(own).collect()} == {("a", "GG"), ("b", "")}
    assert {r["seq"] for r in T.fasta_pool(own).collect()} == {"ACGT", "GG"}
    assert [r["length"] for r in T.fasta_lengths(read).orderBy("rec_no").collect()] == [4, 0, 2]
    shards = workflows.sharded(own, 2).orderBy("rec_no").collect()
    assert [r["shard"] for r in shards] == [0, 1, 1]


OUT = """   SW   perc perc perc  query
score   div. del. ins.  sequence

  463   1.3  0.6  1.7  q1  1 150 (50) + R1 Simple_repeat 1 463 (0) 1
  300   2.0  0.0  0.0  q2  5 60 (0) C R2 Sat (10) 90 21 2
  12    short row q3 1 2 (0) + R3 Sat 1
  x     2.0  0.0  0.0  q2  5 60 (0) C R2 Sat (10) 90 21 2
"""


def test_hit_tables(spark, tmp_path):
    own = lines(spark, tmp_path, OUT)
    rows = T.rm_hits(own).orderBy("line_no").collect()
    assert [(r["query_label"], r["strand"], r["repeat_begin"], r["repeat_end"], r["repeat_left"]) for r in rows] == [("q1", "+", 1, 463, 0), ("q2", "-", 21, 90, 10)]
    beds = T.hit_bed(own).where("seqname LIKE 'q%'").orderBy("seqname").collect()
    assert [(r["start0"], r["end0"], r["name"], r["strand"]) for r in beds[:2]] == [(0, 150, "R1#Simple_repeat", "+"), (4, 60, "R2#Sat", "-")]
    assert T.rm_hits(T.numbered_lines(spark, T.existing([str(tmp_path / "none")]))).count() == 0


def test_bed_filter(spark, tmp_path):
    (tmp_path / "b").write_text("c\t0\t5\tx#y#Satellite\t1\t+\nc\t1\t5\t(A)n#Simple_repeat\t1\t+\nshort\t1\n")
    assert [r["name"] for r in T.bed(spark, [str(tmp_path / "b")], "Satellite").collect()] == ["x#y#Satellite"]
    assert T.bed(spark, [str(tmp_path / "b")]).count() == 2


HEAD = "entry_id\tindividual\tassembly_method\tphasing_status\tfasta_paths\ttrf_dat_paths\n"


@pytest.mark.parametrize(
    ("body", "reason"),
    [
        ("a\tb\tc\tunphased\tx\n", "5 fields"),
        ("a\tb\tc\tunphased\tx\ty\na\tb\tc\tunphased\tx\ty\n", "again"),
        ("a\tb\tc\tother\tx\ty\n", "phasing_status"),
        ("a\tb\tc\tphased_pooled\tx\ty\n", "takes 2"),
        ("", "no entries"),
    ],
)
def test_bad_manifests(spark, tmp_path, body, reason):
    (tmp_path / "m").write_text(HEAD + body)
    with pytest.raises(T.ManifestError, match=reason):
        T.manifest(spark, str(tmp_path / "m"))


def test_samples(spark, tmp_path):
    (tmp_path / "m").write_text(HEAD + "a\ti\tm\tphased_pooled\t/x/hap1.fa;/x/hap2.fa\t1;2\nb\ti\tm\tunphased\t/y/hap1.fa\t3\n")
    entries = T.manifest(spark, str(tmp_path / "m"))
    assert {(r["sample"], r["dat"]) for r in T.samples(entries).collect()} == {("a_hap1", "1"), ("a_hap2", "2"), ("b", "3")}
    (tmp_path / "m").write_text(HEAD + "a\ti\tm\tphased_pooled\t/x/hap1.fa;/z/hap1.fa\t1;2\n")
    with pytest.raises(Exception, match="two genomes"):
        T.samples(T.manifest(spark, str(tmp_path / "m"))).collect()


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(2, True, None, ["a", "b"]), (1, False, "x", [])], "k int, ok boolean, s string, l array<string>")
    sinks.write_tsv(df, str(tmp_path / "t"), "k")
    (part,) = (tmp_path / "t").glob("part-*")
    assert part.read_text().splitlines() == ["k\tok\ts\tl", "1\tFalse\tx\t", "2\tTrue\tNA\ta;b"]
    sinks.write_fasta(df.where("s IS NOT NULL"), str(tmp_path / "f"), F.col("s"), "s", "k")
    (part,) = (tmp_path / "f").glob("part-*")
    assert part.read_text() == ">x\nx\n"

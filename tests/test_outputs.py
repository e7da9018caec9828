"""A run from repeat tables on disk to the files that the workflows end in."""

import random


from satloom.functions import kernels as K
from satloom.plans import outputs, workflows

HEAD = "entry_id\tindividual\tassembly_method\tphasing_status\tfasta_paths\ttrf_dat_paths"


def text(folder, name):
    return "".join(p.read_text() for p in sorted((folder / name).glob("part-*")))


def table(folder, name):
    head, *rows = (x.split("\t") for x in text(folder, name).splitlines())
    return [dict(zip(head, r, strict=True)) for r in rows]


def test_from_repeat_tables_to_files(spark, tmp_path):
    rng = random.Random(3)
    unit = "".join(rng.choices("ACGT", k=160))
    for e in (1, 2):
        lines = []
        for i in range(9):
            if i % 3 == 0:
                lines.append(f"Sequence: ctg{i // 3} of {e}")
            own = K.rotate("".join(rng.choice("ACGT") if rng.random() < 0.02 else c for c in unit), rng.randrange(160), 0)
            lines.append(f"{1000 * i + 1} {1000 * i + 900} 160 120.0 160 97 1 900 25 25 25 25 1.99 {own} {own}")
        (tmp_path / f"d{e}.dat").write_text("\n".join(lines))
    (tmp_path / "m.tsv").write_text("\n".join([HEAD] + [f"e{e}\ti{e}\thifi\tunphased\t/x/{e}.fa\t{tmp_path}/d{e}.dat" for e in (1, 2)]))
    (tmp_path / "hits.out").write_text("head\n\n 463 1.3 0.6 1.7 SAT160_a 1 150 (170) + R1 Satellite 1 160 (0) 1\n 500 1.3 0.6 1.7 SAT160_a 1 150 (170) C R2 Satellite (0) 160 1 1\n")
    out = tmp_path / "out"
    outputs.main([str(tmp_path / "m.tsv"), str(out), str(tmp_path / "hits.out"), str(tmp_path / "none.out")])
    head, seq = text(out, "library.fasta").splitlines()
    assert head == ">SAT160_a#Satellite" and K.tile(seq, unit, 0.95, 1).coverage >= 0.98
    rows = table(out, "summary_table.tsv")
    assert [(r["final_name"], r["source_entry_id"], r["is_representative"], r["entries_found"], r["n_individuals_present"]) for r in rows] == [("SAT160_a", "e1", "True", "e1;e2", "2"), ("SAT160_a", "e2", "False", "e1;e2", "2")]
    assert [(r["entry_id"], r["n_input_sequences"]) for r in table(out, "all_clusters.tsv")] == [("e1", "9"), ("e2", "9")]
    (pair,) = table(out, "cross_cluster_comparison.tsv")
    assert pair["flag_similar"] == "True" and pair["null_passes"] == "0"
    assert [(r["repeat_name"], r["strand"], r["has_known_hit"], r["sw_score"]) for r in table(out, "known_repeat_hits.tsv")] == [("R2", "-", "True", "500"), ("R1", "+", "True", "463")]


def test_screen_files(spark, tmp_path):
    loci = spark.createDataFrame([("s1", "c", 1, 1000, 200, 500.0), ("s1", "c", 9000, 9500, 200, 500.0), ("s2", "c", 5, 900, 200, 500.0)], "sample string, seqname string, start_pos long, end_pos long, period int, copy_number double")
    hits = spark.createDataFrame([("s1", "c", 0, 1000, "SAT200_a#Satellite"), ("s2", "c", 0, 100, "SAT200_a#Satellite")], "sample string, seqname string, start0 long, end0 long, name string")
    screens = spark.createDataFrame([("s2", "s2.out", "/x/2.fa"), ("s1", "s1.out", "/x/1.fa")], "sample string, rm_out string, fasta string")
    outputs.write_screen(workflows.genome_screen(loci, hits), screens, str(tmp_path))
    assert [(r["sample"], r["start0"]) for r in table(tmp_path, "missing_regions.tsv")] == [("s1", "8999"), ("s2", "4")]
    assert [(r["sample"], r["region_recall"]) for r in table(tmp_path, "overall_coverage_summary.tsv")] == [("s1", "0.5"), ("s2", "0.0"), ("ALL", "0.3333")]
    assert text(tmp_path, "satellite_arrays_manifest.tsv").splitlines() == ["sample\trm_out\tassembly_fasta", "s1\ts1.out\t/x/1.fa", "s2\ts2.out\t/x/2.fa"]
    assert len(table(tmp_path, "regions_with_coverage.tsv")) == 3

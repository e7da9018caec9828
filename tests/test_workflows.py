import random

import duckdb
import plain
import pytest
from pyspark.sql import functions as F

from satloom import schemas
from satloom.functions import exprs as X
from satloom.functions import kernels as K
from satloom.params import Comparing, Params, Peeling, Scan
from satloom.plans import queries, workflows
from satloom.plans.oracles import ORACLES
from satloom.plans.queries import QUERIES

PARAMS = Params(
    scan=Scan(min_copy_number=5, min_blocks=3, min_single_block_copy_number=1000, min_period_length=50),
    peeling=Peeling(),
    comparing=Comparing(n_shuffles=3),
    min_total_copy_number=20,
)
ENTRIES = [("e1", "i1", "m1", "unphased", ["f1"], ["d1"]), ("e2", "i2", "m1", "unphased", ["f2"], ["d2"])]


def planted(seed=1):
    """Two entries that share a 60-letter family; the first has one of 90 letters besides."""
    rng = random.Random(seed)
    units = {n: "".join(rng.choices("ACGT", k=n)) for n in (60, 90)}
    rows = []
    for f, (entry, lengths) in enumerate((("e1", (60, 90)), ("e2", (60,)))):
        for n in lengths:
            for i in range(12):
                s = "".join(rng.choice("ACGT") if rng.random() < 0.02 else c for c in units[n])
                s = K.rotate(s, rng.randrange(n), 0)
                start = 1000 * i + n
                rows.append((f, n * 100 + i, f"ctg{i % 3}", start, start + 500, n, 6.0, n, 97.0, 1.9, K.revcomp(s) if i % 2 else s, entry))
    return rows, units


def test_discovery_finds_the_planted_families(spark):
    rows, units = planted()
    loci = spark.createDataFrame(rows, schemas.LOCI + ", entry_id string")
    found = workflows.discover(loci, spark.createDataFrame(ENTRIES, schemas.ENTRIES), PARAMS)
    assert {(r["entry_id"], r["period"]) for r in found.bins.collect()} == {("e1", 60), ("e1", 90), ("e2", 60)}
    library = {r["final_name"]: r["consensus"] for r in found.library.collect()}
    assert set(library) == {"SAT60_a", "SAT90_a"}
    for name, seq in library.items():
        assert K.tile(seq, units[int(name[3:5])], 0.95, 1).coverage >= 0.98
    shared = {r["source_entry_id"]: r for r in found.summary.where("final_name = 'SAT60_a'").collect()}
    assert set(shared) == {"e1", "e2"} and shared["e1"]["is_representative"] and shared["e2"]["individuals_found"] == "i1;i2"
    again = workflows.discover(loci.repartition(7), spark.createDataFrame(ENTRIES, schemas.ENTRIES), PARAMS)
    assert {r["final_name"]: r["consensus"] for r in again.library.collect()} == library


def test_nothing_in_nothing_out(spark):
    loci = spark.createDataFrame([], schemas.LOCI + ", entry_id string")
    found = workflows.discover(loci, spark.createDataFrame(ENTRIES, schemas.ENTRIES), PARAMS)
    for relation in (found.bins, found.clusters, found.pairs, found.summary, found.library):
        assert relation.count() == 0


def test_genome_screen(spark):
    rows, _ = planted()
    loci = spark.createDataFrame(rows, schemas.LOCI + ", entry_id string").withColumnsRenamed({"entry_id": "sample", "source_seq": "seqname"})
    hits = spark.createDataFrame([("e1", "ctg0", 0, 10**6, "a#Satellite"), ("e2", "ctg1", 0, 10**6, "a#Simple")], "sample string, seqname string, start0 long, end0 long, name string")
    screen = workflows.genome_screen(loci.withColumn("copy_number", F.lit(500.0)).withColumn("period", F.lit(200)), hits)
    recall = {r["sample"]: r for r in screen.recall.collect()}
    assert set(recall) == {"e1", "e2", "ALL"} and recall["e2"]["covered_bp"] == 0 and recall["e1"]["n_covered_regions"] == 4
    assert screen.missing.count() == recall["ALL"]["n_regions"] - recall["ALL"]["n_covered_regions"]


def test_loci_of_a_manifest(spark, tmp_path):
    line = "1 1710 171 10.0 171 98 1 3000 30 20 20 30 1.95 ACGT ACGTACGT\n"
    (tmp_path / "d1").write_text("@a\n" + line)
    (tmp_path / "d2").write_text("@b\n" + line * 2)
    entries = spark.createDataFrame([(e, i, m, p, f, [str(tmp_path / d) for d in dat]) for e, i, m, p, f, dat in ENTRIES], schemas.ENTRIES)
    got = workflows.loci_of(spark, entries).groupBy("entry_id", "source_seq").count().collect()
    assert {tuple(r) for r in got} == {("e1", "a", 1), ("e2", "b", 2)}


def rounded(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_against_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = rounded(tuple(r[c] for c in columns) for r in df.collect())
    if name not in ORACLES:
        assert got
        return
    con = duckdb.connect()
    for t in ("lineitem", "orders", "part", "customer", "documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    quoted = ", ".join(f'"{c}"' for c in columns)
    assert got == rounded(con.sql(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall())


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_queries_run_all_shuffles_and_rounds(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(queries.pairs, "compare", lambda rows, how: seen.append(how.n_shuffles))
    monkeypatch.setattr(queries.peeling, "clusters", lambda rows, how: seen.append(how.max_rounds))
    for name in ("null_test_pairs", "peel_clusters"):
        QUERIES[name](spark, sf_dir)
    assert seen == [Comparing().n_shuffles, Peeling().max_rounds]


def test_peel_clusters_against_the_definition(spark, sf_dir):
    """Size, rank, copies and means of every cluster, from all loci of the stand-in, one sequence at a time."""
    rows = queries.loci(spark, sf_dir).groupBy("entry_id", "consensus").agg(F.min("start_pos").alias("s"), F.max("copy_number_c").alias("n"), F.avg("percent_match").alias("m"))
    want = []
    for entry in sorted({r["entry_id"] for r in rows.collect()}):
        own = sorted((r for r in rows.collect() if r["entry_id"] == entry), key=lambda r: (r["s"], r["consensus"]))
        found = plain.families([r["consensus"] * 2 for r in own], least=0.6)
        for rank, i in enumerate(sorted(range(len(found)), key=lambda i: (-len(found[i]), i)), 1):
            mine = [own[k] for k in found[i]]
            match = sum(r["m"] * r["n"] for r in mine) / (sum(r["n"] for r in mine) or 1)
            want.append((entry, rank, len(mine), float(sum(r["n"] for r in mine)), round(match, 1)))
    got = [(r["entry_id"], r["rank"], r["n_input_sequences"], r["total_copy_number"], round(r["mean_percent_match"], 1)) for r in QUERIES["peel_clusters"](spark, sf_dir).collect()]
    assert sorted(got) == sorted(want) and got


def test_null_tests_against_the_definition(spark, sf_dir):
    seqs = {r["label"]: r["seq"] for r in queries.pool(spark, sf_dir).collect()}
    seeds = spark.createDataFrame([(a, b) for a in seqs for b in seqs if a != b], "a string, b string")
    seeds = {(r["a"], r["b"]): int(r["seed"]) for r in seeds.select("a", "b", X.pair_seed(1, F.col("a"), F.col("b")).alias("seed")).collect()}
    rows = [r for r in QUERIES["null_test_pairs"](spark, sf_dir).collect() if r["null_status"] == "tested"]
    assert len(rows) > 50
    for r in rows[:40]:
        u, t = seqs[r["label_a"]], seqs[r["label_b"]]
        most = min(6, len(t) // len(u) + 2)
        assert (r["coverage"], r["n_copies_found"]) == plain.tile(u, t, 0.5, most)[::2]
        made = K.shuffles(u, 20, seeds[r["label_a"], r["label_b"]])
        assert r["null_passes"] == sum(plain.tile(s, t, 0.5, most)[0] >= 0.6 for s in made)

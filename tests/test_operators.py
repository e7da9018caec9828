import random

import plain
import pytest
from pyspark.sql import functions as F

from satloom.functions import exprs as X
from satloom.functions import kernels as K
from satloom.operators import bins, charts, families, intervals, mis, pairs, peeling, screen
from satloom.params import Comparing, Peeling, Scan, Screening

LOCI = "entry_id string, source_seq string, start_pos long, end_pos long, period int, copy_number double, percent_match double, entropy double"


def loci(spark, *groups):
    rows = [("e", f"c{i}", 1, 101, p, float(cn), 90.0, 1.0) for p, cn, n in groups for i in range(n)]
    return spark.createDataFrame(rows, LOCI)


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_window_counts_loci_below_the_floor(spark):
    rows = bins.window_scan(loci(spark, (149, 10, 4), (150, 120, 1))).collect()
    assert [(r["period"], r["n_blocks"], r["passes_distributed"]) for r in rows] == [(150, 5, True)]
    assert rows[0]["n_distinct_source_seqs"] == 4


def test_a_failing_period_still_suppresses(spark):
    own = loci(spark, (200, 100, 2), (200, 1, 1), (212, 100, 1), (212, 1, 5))
    how = Scan(window=5, nms_radius=12)
    left = bins.suppressed(bins.window_scan(own, how), how.radius).collect()
    assert [(r["period"], r["n_blocks"], r["passes_filters"], r["suppressed_period_range"]) for r in left] == [(200, 3, False, "200-212")]
    assert bins.candidate_bins(own, how).count() == 0


def test_suppressed_range_spans_the_group(spark):
    scan = bins.window_scan(loci(spark, (408, 100, 5), (411, 500, 6), (415, 100, 5)), Scan(window=0, nms_radius=5))
    rows = bins.suppressed(scan, 5).collect()
    assert [(r["period"], r["suppressed_period_range"], r["n_periods_suppressed"]) for r in rows] == [(411, "408-415", 2)]


def test_one_locus_in_two_bins(spark):
    chosen = spark.createDataFrame([("e", "cand171", 171, 5), ("e", "cand177", 177, 5)], "entry_id string, motif string, period int, window int")
    rows = bins.extract(loci(spark, (174, 9, 1), (165, 9, 1)), chosen).collect()
    assert sorted(r["motif"] for r in rows) == ["cand171", "cand177"]


def greedy(prio, edges):
    near = {n: set() for n in prio}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    won, out = set(), {}
    for n in sorted(prio, key=prio.get):
        best = min((w for w in near[n] & won), key=prio.get, default=None)
        out[n] = n if best is None else best
        if best is None:
            won.add(n)
    return out


def test_independent_set_is_that_of_the_greedy(spark):
    rng = random.Random(4)
    ids = list(range(120))
    rng.shuffle(ids)
    prio = {n: i for i, n in enumerate(ids)}
    edges = [tuple(rng.sample(range(120), 2)) for _ in range(260)]
    nodes = spark.createDataFrame(list(prio.items()), "id long, prio long")
    found = mis.priority_mis(nodes, spark.createDataFrame([*edges, (1, 1), (5, 999)], "a long, b long"))
    assert {r["id"]: r["winner_id"] for r in found.collect()} == greedy(prio, edges)
    assert mis.priority_mis(nodes.where("false"), mis.empty_edges(spark, "long")).count() == 0


@pytest.mark.parametrize("kind", ["path", "two ends", "comb", "tree"])
def test_long_chains_take_few_rounds(spark, kind, monkeypatch):
    n = 4000
    rng = random.Random(n)
    prio = {i: i for i in range(n)}
    edges = [(i, i + 1) for i in range(n - 1)]
    if kind == "two ends":
        prio = {i: abs(2 * i - n) * 2 + (i > n // 2) for i in range(n)}
    if kind == "comb":
        edges = [(i, i + 2) for i in range(0, n - 2, 2)] + [(i, i + 1) for i in range(0, n, 2)]
    if kind == "tree":
        edges = [(rng.randrange(max(0, i - 3), i), i) for i in range(1, n)]
    rounds = []
    held = mis._without
    monkeypatch.setattr(mis, "_without", lambda *a: rounds.append(1) or held(*a))
    found = mis.priority_mis(spark.createDataFrame(list(prio.items()), "id long, prio long"), spark.createDataFrame(edges, "a long, b long"))
    assert {r["id"]: r["winner_id"] for r in found.collect()} == greedy(prio, edges) and len(rounds) <= 6


def test_merge_closes_gaps_up_to_the_distance(spark):
    own = spark.createDataFrame([("s", 10, 20, 200, 500.0), ("s", 2020, 2030, 200, 500.0), ("s", 4031, 4040, 200, 500.0), ("s", 1, 9, 100, 500.0)],
                                "seqname string, start_pos long, end_pos long, period int, copy_number double")
    rows = intervals.likely_regions(own, Screening()).orderBy("start0").collect()
    assert [tuple(r)[1:] for r in rows] == [(9, 2030), (4030, 4040)]
    again = intervals.merge(intervals.likely_regions(own, Screening()), ["seqname"], "start0", "end0", 0)
    assert again.count() == 2


def test_union_length_counts_each_base_once(spark):
    kind = "sample string, seqname string, start0 long, end0 long"
    regions = spark.createDataFrame([("a", "s", 0, 100), ("a", "s", 500, 600), ("b", "s", 0, 300), ("b", "t", 10**6, 10**6 + 400_000)], kind)
    hits = spark.createDataFrame([("a", "s", -10, 30), ("a", "s", 20, 50), ("a", "s", 25, 40), ("a", "s", 90, 200), ("b", "s", 0, 30), ("b", "t", 0, 2 * 10**6)], kind)
    rows = intervals.region_coverage(regions, hits, ("sample", "seqname")).collect()
    got = {(r["sample"], r["seqname"], r["start0"]): (r["covered_bp"], r["covered"]) for r in rows}
    assert got == {("a", "s", 0): (60, True), ("a", "s", 500): (0, False), ("b", "s", 0): (30, False), ("b", "t", 10**6): (400_000, True)}
    whole = {r["sample"]: r for r in intervals.recall(intervals.region_coverage(regions, hits, ("sample", "seqname"))).collect()}
    assert whole["ALL"]["overall_bp_recall"] == pytest.approx(400_090 / 400_500) and whole["a"]["region_recall"] == 0.5
    assert intervals.missing(intervals.region_coverage(regions, hits, ("sample", "seqname"))).count() == 2


CLUSTER = "cluster_uid string, entry_id string, label string, individual string, assembly_method string, phasing_status string, consensus_length int, gc_content double, total_copy_number double, consensus string"


def pool(spark, *rows):
    made = [(u, e, u.split("__")[1], f"i_{e}", {"e1": "z", "e2": "a", "e3": "z"}.get(e, "m"), "unphased", 171, 0.5, float(cn), "ACGT") for u, e, cn in rows]
    return spark.createDataFrame(made, CLUSTER)


def resolved(spark, own, *edges):
    links = spark.createDataFrame(list(edges), "label_a string, label_b string")
    names = families.named(families.resolve(own, links, "total_copy_number", ["label"]), own)
    return names, {r["cluster_uid"]: r for r in names.collect()}


def test_redundancy_is_not_transitive(spark):
    own = pool(spark, ("x__A", "x", 3), ("y__B", "y", 2), ("z__C", "z", 1))
    _, got = resolved(spark, own, ("x__A", "y__B"), ("y__B", "z__C"))
    assert [got[u]["winner"] for u in ("x__A", "y__B", "z__C")] == ["x__A", "x__A", "z__C"]
    assert {got["x__A"]["final_name"], got["z__C"]["final_name"]} == {"SAT171_a", "SAT171_b"}


def test_ties_fall_by_entry_and_losers_join_the_best(spark):
    own = pool(spark, ("b__1", "b", 5), ("a__1", "a", 5))
    assert resolved(spark, own, ("b__1", "a__1"))[1]["b__1"]["winner"] == "a__1"
    own = pool(spark, ("a__1", "a", 9), ("b__1", "b", 8), ("c__1", "c", 1))
    assert resolved(spark, own, ("c__1", "b__1"), ("c__1", "a__1"))[1]["c__1"]["winner"] == "a__1"


def test_same_entry_clusters_of_a_family_are_put_together(spark):
    own = pool(spark, ("e__s1", "e", 50), ("e__s2", "e", 40), ("e__m", "e", 30), ("w__W", "w", 90))
    names, got = resolved(spark, own, ("e__s1", "w__W"), ("e__s2", "w__W"), ("e__m", "e__s2"))
    assert {r["winner"] for r in got.values()} == {"w__W"}
    rows = {r["cluster_uid"]: r["within_entry_consolidated_into"] for r in families.summary(names, own).collect()}
    assert rows == {"e__s1": None, "e__s2": "s1", "e__m": "s1", "w__W": None}
    assert [r["header"] for r in families.library(names, own).collect()] == ["SAT171_a#Satellite"]


def test_provenance_follows_sorted_entries(spark):
    own = pool(spark, ("e1__1", "e1", 3), ("e2__1", "e2", 2), ("e3__1", "e3", 1))
    names, _ = resolved(spark, own, ("e1__1", "e2__1"), ("e1__1", "e3__1"))
    r = families.provenance(names, own).first()
    assert (r["entries_found"], r["methods_found"], r["n_methods_confirming"]) == ("e1;e2;e3", "z;a", 2)


def test_scalar_functions(spark):
    lit = F.lit
    assert one(spark, *(X.letters(lit(i)) for i in (0, 25, 26, 51, 52, 701, 702))) == ("a", "z", "aa", "az", "ba", "zz", "aaa")
    assert one(spark, X.revcomp(lit("ACGTRYacgn")), X.rotated(lit("ABCDE"), lit(3), lit(1)), X.rotated(lit(""), lit(3), lit(1))) == ("ncgtRYACGT", "CDEAB", "")
    assert one(spark, *(X.fixed(lit(v), 1) for v in (0.15, 0.25, 499.95, 499.96, 499.94))) == (0.1, 0.2, 499.9, 500.0, 499.9)
    assert one(spark, X.nearest_int(lit("2.5")), X.nearest_int(lit("171.5"))) == (2, 172)
    assert one(spark, X.before_hash(lit("SAT1_a#Satellite")), X.after_last_hash(lit("x#y#Satellite"))) == ("SAT1_a", "Satellite")
    assert one(spark, X.locus_id(lit(2), lit("c"), lit(1), lit(9)), X.locus_id(lit(None).cast("int"), lit("c"), lit(1), lit(9))) == ("h2:c:1-9", "c:1-9")
    import hashlib

    assert one(spark, X.pair_seed(1, lit("a"), lit("b")))[0] == str(int.from_bytes(hashlib.sha256(b"1\0a\0b").digest()[:8], "big"))
    assert [r[0] for r in spark.range(1, 10).select(X.shard_index(F.col("id"), 3)).collect()] == [0, 1, 2, 2, 1, 0, 0, 1, 2]
    assert one(spark, X.haplotype(lit("/x/a.hap2.fa")), X.hit_strand(lit("C")), X.bed_strand(lit("x"))) == ("hap2", "-", "+")
    with pytest.raises(Exception, match="neither hap1 nor hap2"):
        one(spark, X.haplotype(lit("/x/a.fa")))


def test_length_bound_and_orientation(spark):
    own = spark.createDataFrame([(0, "x", "A" * 171), (1, "y", "C" * 171), (2, "long", "G" * 1300), (3, "mid", "T" * 1207)], "ord int, label string, seq string")
    got = {(r["label_a"], r["label_b"]) for r in pairs.candidate_pairs(own).collect()}
    assert got == {("x", "y"), ("x", "mid"), ("y", "mid"), ("mid", "long")}


def test_compared_pairs(spark):
    rng = random.Random(3)
    unit, other = ("".join(rng.choices("ACGT", k=60)) for _ in range(2))
    own = spark.createDataFrame([(0, "u", unit), (1, "r", K.revcomp(K.rotate(unit, 17, 0))), (2, "d", unit * 2), (3, "o", other)], "ord int, label string, seq string")
    how = Comparing(n_shuffles=4)
    rows = {(r["label_a"], r["label_b"]): r for r in pairs.compare(own, how).collect()}
    assert rows["u", "r"]["flag_similar"] and rows["u", "d"]["flag_multiple_of"] and not rows["u", "d"]["flag_similar"]
    assert rows["u", "o"]["null_passes"] is None and rows["u", "r"]["null_status"] == "tested"
    again = {(r["label_a"], r["label_b"]): r for r in pairs.compare(own, how, parts=3).collect()}
    assert rows == again
    assert pairs.compare(own, Comparing(skip_margin=0.1)).where("null_status = 'skipped_high_confidence'").count() == 3


def test_clusters_equal_those_of_the_plain_definition(spark):
    rng = random.Random(8)
    units = ["".join(rng.choices("ACGT", k=n)) for n in (80, 84)]

    def copy(u):
        s = [rng.choice("ACGT") if rng.random() < 0.03 else c for c in u]
        turned = K.rotate("".join(s), rng.randrange(len(s)), 0)
        return K.revcomp(turned) if rng.random() < 0.5 else turned

    seqs = [copy(units[i % 3 == 0]) for i in range(40)] + ["".join(rng.choices("ACGT", k=82)) for _ in range(2)]
    rows = [("e", "cand", i, s) for i, s in enumerate(seqs)]
    own = spark.createDataFrame(rows, "entry_id string, motif string, row_id long, seq string")
    got = {}
    for r in peeling.peeled(own, Peeling(), parts=5).collect():
        got.setdefault(r["round"], []).append((r["row_id"], r["seq"]))
    assert [sorted(x) for _, x in sorted(got.items())] == [sorted(c.items()) for c in plain.families(seqs)]
    binned = own.select("entry_id", "motif", F.lit(80).alias("target_period"), F.lit(5).alias("window"), "row_id", F.col("seq").alias("consensus"),
                        F.lit(10.0).alias("copy_number"), F.lit(98.0).alias("percent_match"), F.lit(1.9).alias("entropy"))
    found = peeling.clusters(binned).orderBy("rank").collect()
    assert [r["n_input_sequences"] for r in found] == sorted((len(c) for c in got.values()), reverse=True)
    for r, u in zip(found, units, strict=False):
        assert K.tile(r["consensus"], u, 0.9, 1).coverage >= 0.98
    assert peeling.clusters(binned.where("false")).count() == 0


def test_weighted_means(spark):
    df = spark.createDataFrame([("a", 98.0, 10.0), ("a", 80.0, 30.0), ("b", 5.0, 0.0)], "k string, v double, copy_number double")
    assert dict(tuple(r) for r in df.groupBy("k").agg(peeling.weighted("v")).collect()) == {"a": 84.5, "b": 0.0}


HITS = "line_no long, sw_score int, pct_divergence string, pct_deleted string, pct_inserted string, query_label string, query_start long, query_end long, strand string, repeat_name string, repeat_class_family string, repeat_begin long, repeat_end long, repeat_left long"


def test_known_hits(spark):
    hits = spark.createDataFrame([(1, 9, "1", "0", "0", "q", 1, 150, "-", "R", "Sat", 21, 90, 10), (2, 9, "2", "0", "0", "q", 1, 10, "+", "R", "Sat", 1, 9, 0),
                                  (3, 7, "3", "0", "0", "other", 1, 10, "+", "R", "Sat", 1, 9, 0)], HITS)
    labels = spark.createDataFrame([("q", 200), ("none", 100)], "label string, length int")
    rows = {r["label"]: r for r in screen.known_hits(labels, hits).collect()}
    assert set(rows) == {"q", "none"} and not rows["none"]["has_known_hit"] and rows["none"]["reciprocal_overlap"] is None
    assert (rows["q"]["pct_divergence"], rows["q"]["pct_query_covered"], rows["q"]["pct_known_repeat_covered"], rows["q"]["reciprocal_overlap"]) == ("1", 1.0, 0.7, 0.7)


def test_only_changed_libraries_are_screened_again(spark):
    lib = spark.createDataFrame([("a#S", "ACGT"), ("b#S", "GG")], "header string, consensus string")
    digest = screen.library_digest(lib).first()[0]
    assert digest == screen.library_digest(lib.orderBy(F.desc("header")).repartition(3)).first()[0]
    assert digest != screen.library_digest(lib.where("header = 'a#S'")).first()[0]
    samples = spark.createDataFrame([("s1",), ("s2",)], "sample string")
    done = spark.createDataFrame([("s1", digest), ("s2", "old")], "sample string, lib_sha256 string")
    assert [r["sample"] for r in screen.pending(samples, done, digest).collect()] == ["s2"]


def test_charts(spark):
    df = spark.createDataFrame([(1.0,), (10.0,), (100.0,), (1000.0,)], "v double")
    assert sorted((r["bin"], r["n"]) for r in charts.log_histogram(df, "v", 3).collect()) == [(0, 1), (1, 1), (2, 2)]
    assert charts.log_histogram(df.where("false"), "v", 3).count() == 0
    with pytest.raises(Exception, match="positive"):
        charts.log_histogram(spark.createDataFrame([(0.0,)], "v double"), "v", 3).collect()


def test_counters_ride_along(spark):
    from satloom.operators.counters import counted

    df, seen = counted(spark.range(10), "numbers", even=F.count_if(F.col("id") % 2 == 0))
    df.where("id > 3").collect()
    assert seen.get == {"rows": 10, "even": 5}


def test_parameters_from_a_configuration():
    from satloom.params import Params, from_mapping

    assert from_mapping({}) == Params()
    made = from_mapping({"candidate_scan": {"window": 3}, "cluster_ranking": {"min_cluster_identity": 0.9, "threads": 4},
                         "cross_cluster_comparison": {"null_test_skip_margin": 0.1, "num_shards": 4}, "visualization": {"top_n": 5}})
    assert (made.scan.window, made.scan.radius, made.peeling.min_identity, made.comparing.skip_margin, made.top_n) == (3, 3, 0.9, 0.1, 5)
    with pytest.raises(ValueError, match="must be a number"):
        from_mapping({"candidate_scan": {"window": "wide"}})

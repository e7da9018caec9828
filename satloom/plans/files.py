"""Queries that go through files: relations rendered in the formats around the engine, read again by its readers, and its exports.

Each has SQL that gives the same rows from the tables alone, so that a reader or a sink that loses, changes or misorders a row shows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from satloom.functions import exprs as X
from satloom.operators import charts, counters, families, peeling, screen, search
from satloom.plans import queries as Q
from satloom.plans.views import HIT_ROWS, ctes, table, view
from satloom.plans.workflows import sharded
from satloom.shared import checkpointed, folder
from satloom.sources import sinks
from satloom.sources import text_formats as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def registered(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return registered


#: Lines that one task sorts and writes.
LINES_A_PART = 500_000


def rendered(lines: DataFrame, *order: str | Column) -> tuple[list[str], list[str]]:
    """A folder of parts in order for each ``file`` of ``lines`` (file, line and what ``order`` says): the files' names and paths, in order.

    Lines are ranged over tasks, so that no file is one task's sort; their number says how many.
    """
    spark, at = lines.sparkSession, folder(lines.sparkSession)
    n = -(-lines.count() // LINES_A_PART)
    ranged = lines.repartitionByRange(max(n, 1), "file", *order).sortWithinPartitions("file", *order)
    ranged.select("file", F.col("line").alias("value")).write.mode("append").partitionBy("file").text(at)
    paths = sorted({p.rsplit("/", 1)[0] for p in spark.read.text(at).inputFiles()})
    return [p.split("/file=")[1] for p in paths], paths


def exported(spark: SparkSession, write: Callable[[str], None]) -> list[str]:
    """Paths of what ``write`` puts into a new folder."""
    at = f"{folder(spark)}/export"
    write(at)
    return sorted(spark.read.text(at).inputFiles())


def named_files(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumn("file", F.get(F.lit(list(names)), F.col("file_idx")))


def hundredths(c: str) -> Column:
    n = F.col(c)
    return F.concat(F.floor(n / 100).cast("string"), F.lit("."), F.lpad((n % 100).cast("string"), 2, "0"))


def repeat_files(spark: SparkSession, d: str, half: bool) -> tuple[list[str], list[str]]:
    """Repeat tables of the loci, two a haplotype, with headers of both kinds, parameters, blank lines and lines that are too short."""
    own = view(spark, d, "loci").withColumn("file", F.concat_ws("_", "entry_id", F.concat(F.lit("hap"), F.col("start_pos") % 2 + 1)))
    period = F.concat(F.col("period").cast("string"), F.lit(".5" if half else ""))
    data = F.concat_ws(
        " ", "start_pos", "end_pos", period, hundredths("copy_number_c"), "period", "percent_match", F.lit("2 900 20 30 30 20"), hundredths("entropy_c"), "consensus", "consensus"
    )
    rows = own.select("file", "source_seq", F.lit(2).alias("kind"), "start_pos", data.alias("line"))
    heads = own.select("file", "source_seq").distinct()
    even = F.substring("source_seq", 4, 9).cast("int") % 2 == 0
    head = F.when(even, F.concat(F.lit("Sequence: "), "source_seq", F.lit(" and more words"))).otherwise(F.concat(F.lit("@"), "source_seq", F.lit(" more")))
    extra = F.explode(F.array(F.struct(F.lit(0).alias("kind"), head.alias("line")), *(F.struct(F.lit(1).alias("kind"), F.lit(x).alias("line")) for x in ("Parameters: 2 7 7 80 10 50 500", "", "no data"))))
    heads = heads.select("file", "source_seq", extra.alias("x")).select("file", "source_seq", "x.kind", F.lit(0).cast("long").alias("start_pos"), "x.line")
    return rendered(rows.unionByName(heads), "source_seq", "kind", "start_pos", "line")


_file = "concat(entry_id, '_hap', CAST(start_pos % 2 + 1 AS VARCHAR)) AS file"


@query(f"""WITH {ctes("loci")} SELECT {_file}, source_seq || CASE WHEN CAST(substr(source_seq, 4) AS INT) % 2 = 0 THEN ' and more words' ELSE '' END AS source_seq, start_pos, end_pos,
 CAST(period + period % 2 AS INT) AS period, CAST(copy_number_c AS DOUBLE) / 100 AS copy_number, CAST(percent_match AS DOUBLE) AS percent_match, CAST(entropy_c AS DOUBLE) / 100 AS entropy, consensus,
 concat('h', CAST(start_pos % 2 + 1 AS VARCHAR), ':', source_seq, ':', CAST(start_pos AS VARCHAR), '-', CAST(end_pos AS VARCHAR)) AS locus_id FROM loci""")
def repeat_tables(spark, d):
    """Strict loci: whole headers, periods that end in .5 rounded to even."""
    names, paths = repeat_files(spark, d, half=True)
    rows = named_files(T.trf_loci(T.numbered_lines(spark, paths)), names)
    hap, first = F.substring_index("file", "_hap", -1).cast("int"), F.substring_index("source_seq", " ", 1)
    return rows.select(
        "file", "source_seq", "start_pos", "end_pos", "period", "copy_number", "percent_match", "entropy", "consensus",
        X.locus_id(hap, first, F.col("start_pos"), F.col("end_pos")).alias("locus_id"),
    )


@query(f"WITH {ctes('loci')} SELECT {_file}, source_seq, start_pos, end_pos, period, CAST(copy_number_c AS DOUBLE) / 100 AS copy_number FROM loci")
def repeat_spans(spark, d):
    """Lenient spans: the first word of a header, whole periods."""
    names, paths = repeat_files(spark, d, half=False)
    rows = named_files(T.trf_spans(T.numbered_lines(spark, paths)), names)
    return rows.select("file", "source_seq", "start_pos", "end_pos", "period", "copy_number")


_RECORDS = """r AS (SELECT row_number() OVER (ORDER BY p_partkey) AS place, 'p' || p_partkey % 150 AS label, 'p' || p_partkey % 150 || ' ' || p_name AS header,
 CASE WHEN p_partkey % 11 = 0 THEN '' ELSE repeat(translate(md5(CAST(p_partkey AS VARCHAR)), '0123456789abcdef', 'ACGTacgtACGTNNac'), CAST(1 + p_partkey % 3 AS INT)) END AS seq FROM part)"""


def fasta_lines(spark, d) -> DataFrame:
    """Lines of a FASTA file that the sink wrote: lines of ten letters, labels that repeat, empty records."""
    key = F.col("p_partkey")
    seq = F.expr("repeat(translate(md5(CAST(p_partkey AS STRING)), '0123456789abcdef', 'ACGTacgtACGTNNac'), CAST(1 + p_partkey % 3 AS INT))")
    seq = F.when(key % 11 == 0, "").otherwise(F.regexp_replace(seq, "(.{10})(?=.)", "$1\n"))
    rows = table(spark, d, "part").select(key, F.concat(F.lit("p"), (key % 150).cast("string"), F.lit(" "), "p_name").alias("header"), seq.alias("seq"))
    return T.numbered_lines(spark, exported(spark, lambda at: sinks.write_fasta(rows, at, F.col("header"), "seq", "p_partkey")))


def fasta(spark, d) -> DataFrame:
    """The records with their place, counted through all parts of the export."""
    lines = fasta_lines(spark, d)
    return T.fasta_records(lines).join(T.fasta_heads(lines, through=True).select("file_idx", "rec_no", "place"), ["file_idx", "rec_no"])


@query(f"WITH {_RECORDS} SELECT place, header, label, seq FROM r")
def fasta_records(spark, d):
    return fasta(spark, d).select("place", "header", "label", "seq")


@query(f"WITH {_RECORDS} SELECT place, label, upper(seq) AS seq FROM r WHERE seq <> ''")
def fasta_pool(spark, d):
    return T.fasta_pool(fasta(spark, d)).select("place", "label", "seq")


@query(f"WITH {_RECORDS} SELECT label, arg_max(seq, place) AS seq FROM r GROUP BY label")
def fasta_by_label(spark, d):
    return T.fasta_by_label(fasta(spark, d))


@query(f"WITH {_RECORDS} SELECT place, label, CAST(length(seq) AS INT) AS length FROM r")
def fasta_lengths(spark, d):
    lines = fasta_lines(spark, d)
    return T.fasta_lengths(lines).join(T.fasta_heads(lines, through=True).select("file_idx", "rec_no", "place"), ["file_idx", "rec_no"]).select("place", "label", "length")


@query(f"WITH {_RECORDS} SELECT place, label, CAST(CASE WHEN (place - 1) % 8 < 4 THEN (place - 1) % 8 ELSE 7 - (place - 1) % 8 END AS INT) AS shard FROM r")
def fasta_shards(spark, d):
    return sharded(T.fasta_heads(fasta_lines(spark, d), through=True), 4).select("place", "label", "shard")


@query(f"""WITH {_RECORDS} SELECT place, upper(md5(seq)) AS md5, length(seq) AS letters FROM r WHERE seq <> ''""")
def fasta_pieces(spark, d):
    """Sequences put together again from pieces of 20 letters at least, each of which says where in its record it starts."""
    lines = fasta_lines(spark, d)
    pieces = T.fasta_chunks(lines, 20)
    whole = pieces.groupBy("file_idx", "rec_no").agg(F.array_sort(F.collect_list(F.struct("start", "seq"))).alias("p"), F.sum(F.length("seq")).alias("letters"))
    ends = F.forall(F.sequence(F.lit(1), F.size("p")), lambda i: F.when(i == 1, F.get("p", i - 1)["start"] == 0).otherwise(F.get("p", i - 1)["start"] == F.get("p", i - 2)["start"] + F.length(F.get("p", i - 2)["seq"])))
    seq = F.when(ends, F.array_join(F.transform("p", lambda x: x["seq"]), ""))
    heads = T.fasta_heads(lines, through=True).select("file_idx", "rec_no", "place")
    return whole.join(heads, ["file_idx", "rec_no"]).select("place", F.upper(F.md5(seq.cast("binary"))).alias("md5"), "letters")


def hit_files(spark, d) -> list[str]:
    """Hit tables in three parts, each with the headers that the search puts above them."""
    own = Q.hit_rows(spark, d).withColumn("file", F.concat(F.lit("part"), (F.col("line_no") % 3).cast("string")))
    back = F.col("strand") == "-"
    left = F.concat(F.lit("("), "repeat_left", F.lit(")"))
    line = F.concat_ws(
        " ", F.lit("  "), "sw_score", "pct_divergence", "pct_deleted", "pct_inserted", "query_label", "query_start", "query_end", F.lit("(0)"), F.when(back, "C").otherwise("+"), "repeat_name", "repeat_class_family",
        F.when(back, left).otherwise(F.col("repeat_begin").cast("string")), "repeat_end", F.when(back, F.col("repeat_begin").cast("string")).otherwise(left), "line_no",
    )
    rows = own.select("file", F.lit(1).alias("kind"), line.alias("line"))
    heads = own.select("file").distinct().select("file", F.lit(0).alias("kind"), F.explode(F.array(F.lit("   SW  perc perc"), F.lit("score  div. del."), F.lit(""))).alias("line"))
    return rendered(rows.unionByName(heads), "kind", "line")[1]


@query(f"""WITH h AS ({HIT_ROWS.strip()}) SELECT sw_score, pct_divergence, pct_deleted, pct_inserted, query_label, query_start, query_end, strand, repeat_name, repeat_class_family,
 repeat_begin, repeat_end, repeat_left FROM h""")
def hit_tables(spark, d):
    return T.rm_hits(T.numbered_lines(spark, T.existing(hit_files(spark, d)))).drop("file_idx", "line_no")


@query(f"""WITH h AS ({HIT_ROWS.strip()}) SELECT query_label AS seqname, query_start - 1 AS start0, query_end AS end0, repeat_name || '#' || repeat_class_family AS name, CAST(sw_score AS VARCHAR) AS score,
 CASE WHEN strand = '-' THEN '-' ELSE '+' END AS strand FROM h""")
def hits_as_bed(spark, d):
    return T.hit_bed(T.numbered_lines(spark, hit_files(spark, d)))


def bed_file(spark, d) -> list[str]:
    rows = view(spark, d, "hits").select("seqname", "start0", "end0", "name", "sw_score", "rm_strand")
    return exported(spark, lambda at: sinks.write_bed(rows, at))


@query(f"WITH {ctes('hits')} SELECT seqname, start0, end0, name, CAST(sw_score AS VARCHAR) AS score, rm_strand AS strand FROM hits WHERE name LIKE '%#Satellite'")
def bed_of_family(spark, d):
    return T.bed(spark, bed_file(spark, d), "Satellite")


@query(f"WITH {ctes('hits')} SELECT row_number() OVER (ORDER BY seqname, start0, end0) - 1 AS line_no, concat_ws('\t', seqname, start0, end0) AS place FROM hits")
def bed_in_order(spark, d):
    """Lines of the BED export in the order of the file."""
    lines = T.counted(T.numbered_lines(spark, bed_file(spark, d)), through=True)
    return lines.select("line_no", F.substring_index("line", "\t", 3).alias("place"))


@query("")
def scan_table(spark, d):
    """Lines of the table of all periods, by entry and period; booleans as True and False."""
    rows = Q.scan(spark, d).select("entry_id", "period", "n_blocks", "max_copy_number", "passes_filters")
    paths = exported(spark, lambda at: sinks.write_tsv(rows, at, "entry_id", "period"))
    return T.counted(T.numbered_lines(spark, paths), through=True).select("line_no", "line")


@query(f"""WITH {ctes("clusters")}, o AS (SELECT row_number() OVER (ORDER BY total_copy_number_d DESC, consensus_length, cluster_uid) AS line_no,
  concat_ws('\t', cluster_uid, consensus_length, total_copy_number_d) AS line FROM clusters)
 SELECT * FROM o UNION ALL SELECT 0, concat_ws('\t', 'cluster_uid', 'consensus_length', 'total_copy_number_d')""")
def cluster_table(spark, d):
    """Lines of the table of clusters: the largest first, then by length and key."""
    rows = view(spark, d, "clusters").select("cluster_uid", "consensus_length", "total_copy_number_d")
    paths = exported(spark, lambda at: sinks.write_tsv(rows, at, F.desc("total_copy_number_d"), "consensus_length", "cluster_uid"))
    return T.counted(T.numbered_lines(spark, paths), through=True).select("line_no", "line")


@query("""SELECT c_custkey AS key, nullif(c_mktsegment, 'BUILDING') AS segment, CASE WHEN c_custkey % 3 = 0 THEN 'True' ELSE 'False' END AS third, CAST(c_custkey AS VARCHAR) || ';' || c_nationkey AS pair FROM customer""")
def table_round_trip(spark, d):
    """A table with nulls, booleans and lists, written as lines and read as text again."""
    rows = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"), (F.col("c_custkey") % 3 == 0).alias("third"),
        F.array(F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")).alias("pair"),
    )
    parts = exported(spark, lambda at: sinks.write_tsv(rows, at, "key"))
    return T.tsv(spark, parts[0].rsplit("/", 1)[0], "key long, segment string, third string, pair string")


def entries(spark, d) -> DataFrame:
    """Entries of a manifest of suppliers: every other one with two haplotypes."""
    key = F.col("s_suppkey").cast("string")
    two = F.col("s_suppkey") % 2 == 0
    both = lambda kind: F.when(two, F.concat(F.lit("/x/hap1_"), key, F.lit(f".{kind};/x/hap2_"), key, F.lit(f".{kind}"))).otherwise(F.concat(F.lit("/x/"), key, F.lit(f".{kind}")))
    line = F.concat_ws("\t", F.concat(F.lit("e"), key), F.concat(F.lit("i"), F.col("s_nationkey").cast("string")), F.lit("asm"), F.when(two, "phased_pooled").otherwise("unphased"), both("fa"), both("dat"))
    rows = table(spark, d, "supplier").select(F.lit("m").alias("file"), F.lit(1).alias("kind"), "s_suppkey", line.alias("line"))
    rows = rows.unionByName(rows.where("s_suppkey % 5 = 0").select("file", "kind", "s_suppkey", F.concat(F.lit("#"), "line").alias("line")))
    head = spark.range(1).select(F.lit("m").alias("file"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("s_suppkey"), F.lit("entry_id\tindividual\tassembly_method\tphasing_status\tfasta_paths\ttrf_dat_paths").alias("line"))
    return T.manifest(spark, rendered(head.unionByName(rows.withColumn("s_suppkey", F.col("s_suppkey").cast("long"))), "kind", "s_suppkey", "line")[1][0])


_SAMPLES = """s AS (SELECT 'e' || s_suppkey AS entry_id, 'i' || s_nationkey AS individual, h, s_suppkey % 2 = 0 AS two, s_suppkey AS k FROM supplier, (VALUES (1), (2)) AS v(h) WHERE h = 1 OR s_suppkey % 2 = 0),
 t AS (SELECT *, CASE WHEN two THEN entry_id || '_hap' || h ELSE entry_id END AS sample, CASE WHEN two THEN '/x/hap' || h || '_' || k ELSE '/x/' || k END AS stem FROM s)"""


@query(f"WITH {_SAMPLES} SELECT sample, entry_id, stem || '.fa' AS fasta, stem || '.dat' AS dat FROM t")
def manifest_samples(spark, d):
    return T.samples(entries(spark, d))


@query(f"WITH {_SAMPLES} SELECT sample, sample || '.out' AS rm_out, stem || '.fa' AS assembly_fasta FROM t")
def handoff_manifest(spark, d):
    return sinks.handoff(T.samples(entries(spark, d)).withColumn("rm_out", F.concat("sample", F.lit(".out"))))


@query(f"WITH {_SAMPLES} SELECT sample, 2 AS n FROM t WHERE k % 10 = 0")
def colliding_samples(spark, d):
    """Samples of every tenth supplier, given a second assembly."""
    own = T.samples(entries(spark, d)).select("sample", "entry_id", "fasta")
    more = own.where("substr(entry_id, 2) % 10 = 0").withColumn("fasta", F.concat("fasta", F.lit(".gz")))
    return screen.colliding_samples(own.unionByName(more))


def cluster_rows(spark, d) -> DataFrame:
    """The stand-in clusters with all columns that pooling and the summary carry; every thirteenth lacks a consensus."""
    own = view(spark, d, "clusters")
    label = F.substring_index("cluster_uid", "__", -1)
    key = F.substring_index("cluster_uid", "_p", -1).cast("int")
    return own.select(
        "cluster_uid", "entry_id", "individual", "assembly_method", "consensus_length", label.alias("label"), F.lit("unphased").alias("phasing_status"),
        (F.col("total_copy_number_d") / 10).alias("total_copy_number"), "total_copy_number_d", (key % 100 / 100).alias("gc_content"),
        F.when(key % 13 != 0, F.translate(F.md5("cluster_uid"), "0123456789abcdef", "ACGTACGTACGTACGT")).otherwise("").alias("consensus"),
    )


@query(f"""WITH {ctes("clusters")} SELECT cluster_uid, entry_id, individual, assembly_method, CAST(total_copy_number_d AS DOUBLE) / 10 AS total_copy_number FROM clusters WHERE total_copy_number_d >= 9100""")
def pooled_clusters(spark, d):
    """Clusters of enough copies, with what the manifest knows of their entries."""
    own = cluster_rows(spark, d)
    meta = own.select("entry_id", "individual", "assembly_method", "phasing_status").distinct()
    found = peeling.pooled(own.select("entry_id", "label", "total_copy_number"), meta, 910.0)
    return found.select("cluster_uid", "entry_id", "individual", "assembly_method", "total_copy_number")


def family_names(spark, d) -> DataFrame:
    return Q.names(spark, d)


@query("")
def family_summary(spark, d):
    rows = families.summary(family_names(spark, d), cluster_rows(spark, d))
    return rows.select(
        "cluster_uid", "final_name", "motif_length", "is_representative", "within_entry_consolidated_into", "source_entry_id", "source_cluster_label", "source_individual", "source_copy_number",
        "source_gc_content", "n_entries_found", "entries_found", "individuals_found", "methods_found",
    )


@query("")
def family_library(spark, d):
    """Headers and sequences of the library, as the search would be given them."""
    found = families.library(family_names(spark, d), cluster_rows(spark, d))
    return found.select("header", "consensus").join(screen.screen_queries(found).withColumnRenamed("label", "final_name").withColumn("header", F.concat("final_name", F.lit("#Satellite"))), "header")


@query("")
def recurrence_points(spark, d):
    return charts.recurrence_points(families.summary(family_names(spark, d), cluster_rows(spark, d)))


_LIBRARY = """lib AS (SELECT 'SAT' || p_size || '_' || p_partkey || '#Satellite' AS header, translate(md5(p_name), '0123456789abcdef', 'ACGTACGTACGTACGT') AS consensus FROM part)"""


def library(spark, d) -> DataFrame:
    name = F.concat(F.lit("SAT"), F.col("p_size").cast("string"), F.lit("_"), F.col("p_partkey").cast("string"), F.lit("#Satellite"))
    return table(spark, d, "part").select(name.alias("header"), F.translate(F.md5("p_name"), "0123456789abcdef", "ACGTACGTACGTACGT").alias("consensus"))


@query(f"WITH {_LIBRARY} SELECT split_part(header, '#', 1) AS label, consensus || consensus AS seq FROM lib")
def screen_queries(spark, d):
    return screen.screen_queries(library(spark, d))


@query(f"""WITH {_LIBRARY}, c AS (SELECT c_custkey, consensus FROM customer JOIN lib ON split_part(split_part(header, '_', 2), '#', 1) = CAST(c_custkey AS VARCHAR))
 SELECT DISTINCT 'g' || c_custkey AS seqname, split_part(header, '#', 1) AS name, CASE WHEN c_custkey % 2 = 1 THEN '-' ELSE '+' END AS strand, true AS inside FROM c JOIN lib USING (consensus)""")
def genome_search(spark, d):
    """Which units of the library lie in sequences made of customers, each with one planted array on either strand, and whether they lie there alone."""
    own = library(spark, d)
    at = F.substring_index(F.substring_index("header", "#", 1), "_", -1).cast("long")
    units = own.select(X.before_hash(F.col("header")).alias("label"), F.col("consensus").alias("seq"), at.alias("key"))
    # Keys are small to the genomes that are made of them: dealt first, into parts of their own number, and stored, for the search reads pieces three times.
    parts = 8 * spark.sparkContext.defaultParallelism
    who = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").alias("key")).repartition(parts, "key")
    spacer = lambda tag: F.translate(F.concat(*(F.md5(F.concat_ws(":", F.lit(tag), F.col("c_custkey").cast("string"), F.lit(i))) for i in range(4))), "0123456789abcdef", "ACGTACGTACGTACGT")
    array = F.repeat(F.when(F.col("c_custkey") % 2 == 1, X.revcomp(F.col("seq"))).otherwise(F.col("seq")), F.lit(8))
    genomes = who.join(units.repartition(parts, "key").hint("merge"), "key").select(F.concat(F.lit("g"), F.col("c_custkey").cast("string")).alias("seqname"), F.lit(0).cast("long").alias("start"), F.concat(spacer("a"), array, spacer("b")).alias("seq"))
    alike, labels = search.labelled(units.select("label", "seq"))
    # The array lies at 128 to 384; borders are those of tiles.
    found = search.unit_hits(alike, checkpointed(genomes)).groupBy("seqname", "unit", "strand").agg(F.bool_and((F.col("start0") >= 0) & (F.col("end0") <= 480) & (F.col("end0") > 300)).alias("inside"))
    return search.spread(found, labels).select("seqname", F.col("label").alias("name"), "strand", "inside")


@query(f"WITH {_LIBRARY} SELECT sha256(string_agg(sha256(header || chr(10) || consensus), '' ORDER BY header)) AS lib_sha256 FROM lib")
def library_digest(spark, d):
    return screen.library_digest(library(spark, d))


@query("""SELECT 's' || c_custkey AS sample, c_custkey % 4 <> 0 AS first_run, false AS second_run, true AS other_library FROM customer""")
def screens_to_do(spark, d):
    """Which samples a screen has to do: with a quarter of them done before, once all are done, and once the library is another."""
    at, own = f"{folder(spark)}/screens", table(spark, d, "customer").select(F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("sample"), "c_custkey")
    digest = screen.snapshot(library(spark, d), at)
    screen.complete(own.where("c_custkey % 4 = 0"), digest, at)
    found = []
    for name, lib in (("first_run", digest), ("second_run", digest), ("other_library", "another")):
        left = screen.pending(own.select("sample"), screen.completed(spark, at), lib)
        found.append(left.select("sample", F.lit(True).alias(name)))
        if name == "first_run":
            found[-1] = checkpointed(found[-1])
            screen.complete(left, lib, at)
    rows = own.select("sample")
    for name, df in zip(("first_run", "second_run", "other_library"), found, strict=True):
        rows = rows.join(df, "sample", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return rows


@query(f"""WITH {ctes("loci")}, m AS (SELECT entry_id, period, start_pos % 3 + 1 AS round, count(*) AS n, sum(copy_number_c) AS cn, sum(percent_match * copy_number_c) AS pm, sum(entropy_c * copy_number_c) AS en
  FROM loci WHERE start_pos % 7 <> 0 GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY entry_id, period ORDER BY n DESC, round) AS rank FROM m), b AS (SELECT entry_id, period, count(*) AS n_bin FROM loci GROUP BY ALL)
 SELECT entry_id, 'cand' || period AS motif, CAST(rank AS INT) AS rank, 'cand' || period || '_rank' || lpad(CAST(rank AS VARCHAR), 2, '0') || '_n' || n AS label, n AS n_input_sequences,
  CAST(printf('%.2f', CAST(100 * n AS DOUBLE) / n_bin) AS DOUBLE) AS pct_of_bin, CAST(printf('%.1f', CAST(cn AS DOUBLE)) AS DOUBLE) AS total_copy_number,
  CAST(printf('%.2f', coalesce(CAST(pm AS DOUBLE) / nullif(cn, 0), 0)) AS DOUBLE) AS mean_percent_match, CAST(printf('%.4f', coalesce(CAST(en AS DOUBLE) / nullif(cn, 0), 0)) AS DOUBLE) AS mean_entropy
 FROM r JOIN b USING (entry_id, period) WHERE rank <> 2""")
def cluster_ranks(spark, d):
    """Ranks, labels and figures of given clusters (rounds by start position); the second of each bin lacks a consensus, and keeps its rank."""
    own = Q.loci(spark, d).select(
        "entry_id", F.concat(F.lit("cand"), "period").alias("motif"), F.col("period").alias("target_period"), F.lit(5).alias("window"), "start_pos", "end_pos", "source_seq", "consensus", F.col("copy_number_c").cast("double").alias("copy_number"), "percent_match", "entropy",
    )
    order = ("start_pos", "end_pos", "source_seq", "consensus", "copy_number", "percent_match", "entropy")
    own = own.withColumn("row_id", F.row_number().over(Window.partitionBy("entry_id", "motif").orderBy(*order))).drop("consensus")
    members = own.where("start_pos % 7 <> 0").select("entry_id", "motif", (F.col("start_pos") % 3 + 1).cast("int").alias("round"), "row_id")
    size = members.groupBy("entry_id", "motif", "round").count()
    place = F.row_number().over(Window.partitionBy("entry_id", "motif").orderBy(F.desc("count"), "round"))
    found = size.select("entry_id", "motif", "round", F.when(place == 2, "").otherwise("ACGT").alias("consensus"))
    rows = peeling.summarised(members, own, found)
    return rows.select("entry_id", "motif", "rank", "label", "n_input_sequences", "pct_of_bin", "total_copy_number", "mean_percent_match", "mean_entropy")


@query("SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderpriority LIKE '1%') AS urgent, min(o_orderkey) AS least FROM orders")
def counted_rows(spark, d):
    """Counts that are taken along with another step."""
    rows, seen = counters.counted(table(spark, d, "orders"), "orders", urgent=F.count_if(F.col("o_orderpriority").startswith("1")), least=F.min("o_orderkey"))
    rows.where("o_orderkey < 0").write.format("noop").mode("overwrite").save()
    got = seen.get
    return spark.createDataFrame([(got["rows"], got["urgent"], got["least"])], "rows long, urgent long, least long")


@query("""WITH c AS (SELECT total_copy_number_d < 12000 AS b FROM clusters) SELECT count(*) AS n, count(*) FILTER (WHERE b) AS n_below FROM c""")
def clusters_below(spark, d):
    return charts.below(cluster_rows(spark, d), 1200.0)


@query(f"""WITH {ctes("clusters")} SELECT entry_id, split_part(cluster_uid, '__', 2) AS label, CAST(total_copy_number_d AS DOUBLE) / 10 AS total_copy_number, total_copy_number_d >= 12000 AS passes FROM clusters""")
def quality_points(spark, d):
    rows = cluster_rows(spark, d).withColumns({"mean_percent_match": F.lit(0.0), "mean_entropy": F.lit(0.0)})
    return charts.quality_points(rows, 1200.0).select("entry_id", "label", "total_copy_number", "passes")


@query("""WITH x AS (SELECT log10(CAST(o_totalprice AS DOUBLE)) AS x, o_orderstatus = 'F' AS covered FROM orders), e AS (SELECT min(x) AS low, max(x) AS high FROM x)
 SELECT CAST(least(29, floor((x - low) / ((high - low) / 30))) AS INT) AS bin, covered, count(*) AS n FROM x, e GROUP BY ALL""")
def stacked_histogram(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_totalprice").cast("double").alias("v"), (F.col("o_orderstatus") == "F").alias("covered"))
    return charts.log_histogram(rows, "v", 30, "covered").select("bin", "covered", "n")


@query("")
def hits_by_score(spark, d):
    found = screen.ranked_hits(screen.known_hits(Q.labels(spark, d), Q.hit_rows(spark, d)))
    return found.where("has_known_hit").select("label", "repeat_name", "sw_score", "place")


def _with_families() -> None:
    from satloom.plans import oracles as O

    more = """, x AS (SELECT c.*, split_part(cluster_uid, '__', 2) AS label, CAST(split_part(cluster_uid, '_p', 2) AS INT) AS k FROM clusters c),
 e AS (SELECT DISTINCT final_name, c.entry_id, c.individual, c.assembly_method FROM named JOIN clusters c ON c.cluster_uid = named.entry_representative),
 i AS (SELECT final_name, individual, min(entry_id) AS f FROM e GROUP BY ALL), m AS (SELECT final_name, assembly_method, min(entry_id) AS f FROM e GROUP BY ALL),
 ee AS (SELECT final_name, CAST(count(*) AS INT) AS n_entries_found, string_agg(entry_id, ';' ORDER BY entry_id) AS entries_found FROM e GROUP BY final_name),
 ii AS (SELECT final_name, CAST(count(*) AS INT) AS n_individuals_present, string_agg(individual, ';' ORDER BY f) AS individuals_found FROM i GROUP BY final_name),
 mm AS (SELECT final_name, string_agg(assembly_method, ';' ORDER BY f) AS methods_found FROM m GROUP BY final_name),
 s AS (SELECT n.cluster_uid, n.final_name, w.consensus_length AS motif_length, is_representative, CASE WHEN n.cluster_uid <> entry_representative THEN kp.label END AS within_entry_consolidated_into,
  x.entry_id AS source_entry_id, x.label AS source_cluster_label, x.individual AS source_individual, CAST(x.total_copy_number_d AS DOUBLE) / 10 AS source_copy_number, CAST(x.k % 100 AS DOUBLE) / 100 AS source_gc_content,
  n_entries_found, entries_found, n_individuals_present, individuals_found, methods_found
  FROM named n JOIN x ON x.cluster_uid = n.cluster_uid JOIN x w ON w.cluster_uid = n.winner JOIN x kp ON kp.cluster_uid = n.entry_representative JOIN ee USING (final_name) JOIN ii USING (final_name) JOIN mm USING (final_name))"""
    head = f"{O._fam}{more}"
    ORACLES["family_summary"] = f"""{head} SELECT cluster_uid, final_name, motif_length, is_representative, within_entry_consolidated_into, source_entry_id, source_cluster_label, source_individual, source_copy_number,
 source_gc_content, n_entries_found, entries_found, individuals_found, methods_found FROM s"""
    ORACLES["recurrence_points"] = f"{head} SELECT final_name, motif_length, source_copy_number, n_individuals_present, n_entries_found FROM s WHERE is_representative"
    ORACLES["family_library"] = f"""{head}, l AS (SELECT final_name, translate(md5(x.cluster_uid), '0123456789abcdef', 'ACGTACGTACGTACGT') AS consensus FROM named n JOIN x ON x.cluster_uid = n.winner WHERE is_representative AND x.k % 13 <> 0)
 SELECT final_name || '#Satellite' AS header, consensus, final_name, consensus || consensus AS seq FROM l"""
    ORACLES["clusters_below"] = f"WITH {ctes('clusters')}, c AS (SELECT total_copy_number_d < 12000 AS b FROM clusters) SELECT count(*) AS n, count(*) FILTER (WHERE b) AS n_below FROM c"
    ORACLES["scan_table"] = f"""{O._loci} SELECT row_number() OVER (ORDER BY entry_id, period) AS line_no, concat_ws('\t', entry_id, period, n_blocks, max_copy_number, CASE WHEN passes_filters THEN 'True' ELSE 'False' END) AS line FROM ranked
 UNION ALL SELECT 0, concat_ws('\t', 'entry_id', 'period', 'n_blocks', 'max_copy_number', 'passes_filters')"""
    ORACLES["hits_by_score"] = f"""{O._hits} SELECT query_label AS label, repeat_name, sw_score, CAST(row_number() OVER (PARTITION BY query_label ORDER BY sw_score DESC, repeat_name) AS INT) AS place
 FROM best WHERE z = 1 AND query_label IN (SELECT 'SAT' || c_custkey FROM customer)"""


_with_families()

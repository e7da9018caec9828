"""Repeat-finder tables, FASTA, hit tables, BED and manifests, from lines that any number of tasks read (see lines)."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from satloom.functions import exprs as X
from satloom.shared import kept
from satloom.sources import lines as L
from satloom.sources.lines import counted, numbered_lines

__all__ = ["counted", "numbered_lines"]


def carried(lines: DataFrame, header: Column, keys: Sequence[str] = ("file_idx",), order: str = "line_no") -> DataFrame:
    """``lines`` with ``header`` (null on lines that are none) of the last header line at or above each."""
    above = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("header", F.last(header, ignorenulls=True).over(above))


def _headed(lines: DataFrame, default: str | None) -> DataFrame:
    line = F.col("line")
    header = F.when(line.startswith("Sequence:"), F.trim(F.substring(line, 10, 1 << 30))).when(
        line.startswith("@"), F.substring_index(F.trim(F.substring(line, 2, 1 << 30)), " ", 1)
    )
    return L.headed(lines, header).withColumn("header", F.coalesce("header", F.lit(default))).withColumn("f", X.fields(line))


def trf_loci(lines: DataFrame, default_seqname: str | None = "unknown") -> DataFrame:
    """Loci (schemas.LOCI) of repeat-finder output, strict: 15 fields or more, the first two whole numbers.

    The sequence is all that stands after ``Sequence:``, or the first word after ``@``; files without either have
    ``default_seqname``. Periods are rounded to whole numbers, halves to even. Lines that cannot be read are passed over.
    """
    f = F.col("f")
    data = _headed(lines, default_seqname).where((F.size(f) >= 15) & X.is_whole(f[0]) & X.is_whole(f[1]))
    number = lambda i, kind: F.get(f, i).try_cast(kind)
    rows = data.select(
        "file_idx", "line_no", F.col("header").alias("source_seq"), number(0, "long").alias("start_pos"), number(1, "long").alias("end_pos"),
        F.rint(number(2, "double")).cast("int").alias("period"), number(3, "double").alias("copy_number"), number(4, "int").alias("consensus_size"),
        number(5, "double").alias("percent_match"), number(12, "double").alias("entropy"), F.get(f, 13).alias("consensus"),
    )
    return rows.where("period IS NOT NULL AND copy_number IS NOT NULL AND percent_match IS NOT NULL AND entropy IS NOT NULL")


def trf_spans(lines: DataFrame, default_seqname: str = "") -> DataFrame:
    """source_seq, start_pos, end_pos, period and copy_number, lenient: 4 fields or more, the first a whole number.

    The sequence is the first word of its header. A data line without a sequence, or with fields that are no numbers, is an error.
    """
    f = F.col("f")
    data = _headed(lines, default_seqname or None).where((F.size(f) >= 4) & X.is_whole(f[0]) & ~F.col("line").startswith("@"))
    name = F.coalesce(F.substring_index("header", " ", 1), F.raise_error(F.concat(F.lit("no sequence above line "), F.col("line_no").cast("string"))))
    return data.select(
        "file_idx", "line_no", name.alias("source_seq"), f[0].cast("long").alias("start_pos"), f[1].cast("long").alias("end_pos"),
        f[2].cast("int").alias("period"), f[3].cast("double").alias("copy_number"),
    )


def _recorded(lines: DataFrame) -> DataFrame:
    """Lines of FASTA records, with rec_no, the line_no of their header; lines above the first header are left out."""
    head = F.when(F.col("line").startswith(">"), F.col("line_no"))
    return L.headed(lines, head).where("header IS NOT NULL").withColumn("rec_no", F.col("header").cast("long")).drop("header")


def _header(line: Column) -> Column:
    return F.trim(F.substring(line, 2, 1 << 30))


def fasta_heads(lines: DataFrame, through: bool = False) -> DataFrame:
    """file_idx, rec_no, header, label and place of each record: its number, from 1 on, in its file or (``through``) in all files."""
    heads = L.ordinals(lines, F.col("line").startswith(">"), "place", through)
    head = _header(F.col("line"))
    return heads.select("file_idx", F.col("line_no").alias("rec_no"), head.alias("header"), F.regexp_extract(head, r"^\S*", 0).alias("label"), "place")


def fasta_records(lines: DataFrame) -> DataFrame:
    """file_idx, rec_no, header (all after ``>``), label (its first word) and seq of each record, repeated ones included.

    A record is a row here, as libraries of consensus sequences are read; for genomes there is fasta_chunks.
    """
    body = F.struct("line_no", F.trim("line").alias("line"))
    rows = _recorded(lines).groupBy("file_idx", "rec_no").agg(F.array_sort(F.collect_list(body)).alias("lines"))
    head = _header(F.col("lines")[0]["line"])
    text = F.array_join(F.transform(F.slice("lines", 2, F.greatest(F.size("lines"), F.lit(1))), lambda x: x["line"]), "")
    return rows.select("file_idx", "rec_no", head.alias("header"), F.regexp_extract(head, r"^\S*", 0).alias("label"), text.alias("seq"))


def fasta_chunks(lines: DataFrame, letters: int = 1 << 16) -> DataFrame:
    """file_idx, rec_no, start (from 0, in the record) and seq: the sequences in pieces of about ``letters`` letters, one row each.

    A piece ends with the line that passes a multiple of ``letters`` in the file's letters, so that each line is dealt by the sum of those before it and no
    row, group or task holds a chromosome. Records without letters have no piece.
    """
    head = F.col("line").startswith(">")
    sized = L.running(_recorded(lines).withColumn("line", F.when(head, ">").otherwise(F.trim("line"))), F.when(head, 0).otherwise(F.length("line")), "at")
    own = sized.where((F.col("line") != "") & ~head)
    pieces = own.groupBy("file_idx", "rec_no", F.floor(F.col("at") / letters).alias("piece")).agg(F.array_sort(F.collect_list(F.struct("at", "line"))).alias("lines"))
    first, n = kept(sized.where(head).select("file_idx", "rec_no", F.col("at").alias("first")))
    pieces = pieces.join(F.broadcast(first) if n <= L.MAX_SENT else first, ["file_idx", "rec_no"])
    seq = F.array_join(F.transform("lines", lambda x: x["line"]), "")
    return pieces.select("file_idx", "rec_no", (F.col("lines")[0]["at"] - F.col("first")).alias("start"), seq.alias("seq"))


def fasta_pool(records: DataFrame) -> DataFrame:
    """Records as the comparison takes them: upper case, none that is empty."""
    return records.where("seq <> ''").withColumn("seq", F.upper("seq"))


def fasta_by_label(records: DataFrame) -> DataFrame:
    """label and seq, of repeated labels the last record."""
    return records.groupBy("label").agg(F.max_by("seq", F.struct("file_idx", "rec_no")).alias("seq"))


def fasta_lengths(lines: DataFrame) -> DataFrame:
    """file_idx, rec_no, label and length of each record of FASTA ``lines``; no sequence is put together for it."""
    head = F.col("line").startswith(">")
    label = F.max(F.when(head, F.regexp_extract(_header(F.col("line")), r"^\S*", 0)))
    size = F.sum(F.when(head, 0).otherwise(F.length(F.trim("line"))))
    return _recorded(lines).groupBy("file_idx", "rec_no").agg(label.alias("label"), size.cast("int").alias("length"))


def hit_lines(lines: DataFrame) -> DataFrame:
    """Lines of hit tables: the first field a whole number, 11 fields or more."""
    return lines.withColumn("f", X.fields(F.col("line"))).where((F.size("f") >= 11) & X.is_whole(F.col("f")[0]))


def rm_hits(lines: DataFrame) -> DataFrame:
    """Hits (schemas.RM_OUT) with 14 fields or more; on the complement strand the last three coordinates stand reversed."""
    f = F.col("f")
    back = f[8] == "C"
    rows = hit_lines(lines).where(F.size(f) >= 14)
    long = lambda c: c.try_cast("long")
    left = F.when(back, F.get(f, 11)).otherwise(F.get(f, 13))
    rows = rows.select(
        "file_idx", "line_no", f[0].try_cast("int").alias("sw_score"), f[1].alias("pct_divergence"), f[2].alias("pct_deleted"), f[3].alias("pct_inserted"),
        f[4].alias("query_label"), long(f[5]).alias("query_start"), long(f[6]).alias("query_end"), X.hit_strand(f[8]).alias("strand"),
        f[9].alias("repeat_name"), f[10].alias("repeat_class_family"),
        long(F.when(back, F.get(f, 13)).otherwise(F.get(f, 11))).alias("repeat_begin"), long(F.get(f, 12)).alias("repeat_end"),
        long(F.regexp_replace(left, "^[()]+|[()]+$", "")).alias("repeat_left"),
    )
    whole = ("sw_score", "query_start", "query_end", "repeat_begin", "repeat_end", "repeat_left")
    return rows.where(" AND ".join(f"{c} IS NOT NULL" for c in whole))


def hit_bed(lines: DataFrame) -> DataFrame:
    """Hits as BED rows: half-open from 0, named ``repeat#family``."""
    f = F.col("f")
    return hit_lines(lines).select(
        f[4].alias("seqname"), (f[5].cast("long") - 1).alias("start0"), f[6].cast("long").alias("end0"),
        F.concat(f[9], F.lit("#"), f[10]).alias("name"), f[0].alias("score"), X.bed_strand(f[8]).alias("strand"),
    )


def existing(paths: Sequence[str]) -> list[str]:
    """Those of ``paths`` that are there: a screen without hits may leave no file."""
    return [p for p in paths if "://" in p or os.path.exists(p)]


def bed(spark: SparkSession, paths: Sequence[str], family: str | None = None) -> DataFrame:
    """BED rows with three columns or more, of one family (what stands after the last ``#`` of a name) if one is given."""
    f = F.split("line", "\t")
    rows = numbered_lines(spark, paths).where((F.size(f) >= 3) & ~F.col("line").startswith("#"))
    rows = rows.select(
        F.get(f, 0).alias("seqname"), F.get(f, 1).cast("long").alias("start0"), F.get(f, 2).cast("long").alias("end0"),
        F.get(f, 3).alias("name"), F.get(f, 4).alias("score"), F.get(f, 5).alias("strand"),
    )
    return rows if family is None else rows.where(X.after_last_hash(F.col("name")) == family)


def tsv(spark: SparkSession, paths: Sequence[str] | str, schema: str) -> DataFrame:
    """Tables with a header line, ``NA`` for null. Each of ``paths`` is a table: a file, or the folder of an export, of whose parts the first alone has a header."""
    own = numbered_lines(spark, [paths] if isinstance(paths, str) else paths).where("trim(line) <> ''")
    heads, n = kept(own.groupBy("file_idx").agg(F.min("line_no").alias("head")))
    rows = own.join(F.broadcast(heads) if n <= L.MAX_SENT else heads, "file_idx").where(F.col("line_no") > F.col("head"))
    return rows.select(F.from_csv("line", schema, {"sep": "\t", "nullValue": "NA"}).alias("r")).select("r.*")


class ManifestError(ValueError):
    """A manifest that cannot be used, with the reason."""


def manifest_rows(spark: SparkSession, path: str) -> DataFrame:
    """line_no and fields of the rows of a manifest: lines that are not blank, are no comments and stand below the first such line, the header."""
    own = numbered_lines(spark, [path]).where("trim(line) <> ''").select("line_no", "line")
    head = own.agg(F.min("line_no")).first()[0]
    below = own.where(F.col("line_no") > F.lit(head).cast("long")) if head is not None else own
    return below.where(~F.col("line").startswith("#")).select("line_no", F.split("line", "\t").alias("f"))


def violations(rows: DataFrame) -> DataFrame:
    """line_no and rule of all that is wrong with manifest_rows; an empty manifest is wrong in line 0."""
    f, own = F.col("f"), rows.where(F.size("f") == 6)
    word = lambda i: F.trim(F.get(f, i))
    paths = lambda i: F.size(F.filter(F.split(F.get(f, i), ";"), lambda p: F.trim(p) != ""))
    wanted = F.when(word(3) == "phased_pooled", 2).otherwise(1)
    known = word(3).isin("phased_pooled", "unphased")
    twice = own.groupBy(word(0).alias("entry")).agg(F.min("line_no").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = own.withColumn("entry", word(0)).join(twice, "entry").where(F.col("line_no") > F.col("first"))
    found = [
        rows.where(F.size("f") != 6).select("line_no", F.concat(F.size("f").cast("string"), F.lit(" fields, not 6")).alias("rule")),
        again.select("line_no", F.concat(F.lit("entry "), "entry", F.lit(" again")).alias("rule")),
        own.where(~known).select("line_no", F.concat(F.lit("phasing_status "), word(3)).alias("rule")),
        own.where(known & ((paths(4) != wanted) | (paths(5) != wanted))).select("line_no", F.concat(word(3), F.lit(" takes "), wanted.cast("string"), F.lit(" path(s) in each column")).alias("rule")),
        rows.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit(0).cast("long").alias("line_no"), F.lit("no entries").alias("rule")),
    ]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The entries (schemas.ENTRIES) of a manifest, after its checks: a ManifestError tells of the first line that breaks a rule. Of any number of lines, none
    but that one comes to the driver."""
    rows = manifest_rows(spark, path)
    wrong = violations(rows).orderBy("line_no", "rule").first()
    if wrong is not None:
        raise ManifestError(f"line at {wrong['line_no']}: {wrong['rule']}")
    f = F.col("f")
    names = ("entry_id", "individual", "assembly_method", "phasing_status")
    paths = lambda i: F.filter(F.transform(F.split(F.get(f, i), ";"), lambda p: F.trim(p)), lambda p: p != "")
    return rows.select(*(F.trim(F.get(f, i)).alias(n) for i, n in enumerate(names)), paths(4).alias("fasta_paths"), paths(5).alias("trf_dat_paths"))


def samples(entries: DataFrame) -> DataFrame:
    """A row for each haplotype of each entry: sample, entry_id, fasta and dat. Two paths of one haplotype are an error."""
    both = entries.select("entry_id", "phasing_status", F.posexplode(F.arrays_zip("fasta_paths", "trf_dat_paths")).alias("i", "p"))
    hap = X.haplotype(F.col("p.fasta_paths"))
    sample = F.when(F.col("phasing_status") == "unphased", F.col("entry_id")).otherwise(F.concat_ws("_", "entry_id", hap))
    rows = both.select(sample.alias("sample"), "entry_id", F.col("p.fasta_paths").alias("fasta"), F.col("p.trf_dat_paths").alias("dat"))
    same = Window.partitionBy("sample")
    alone = F.count(F.lit(1)).over(same) == 1
    return rows.withColumn("sample", F.when(alone, F.col("sample")).otherwise(F.raise_error(F.concat(F.lit("two genomes for sample "), F.col("sample")))))

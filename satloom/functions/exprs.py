"""Scalar functions as column expressions; all of them stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC letters and their complements; fixed values.
IUPAC = "ACGTRYSWKMBDHVN"
COMPLEMENT = "TGCAYRSWMKVHDBN"


def revcomp(seq: Column) -> Column:
    """Reverse complement; case is kept and letters outside IUPAC stay."""
    return F.translate(F.reverse(seq), IUPAC + IUPAC.lower(), COMPLEMENT + COMPLEMENT.lower())


def doubled(seq: Column) -> Column:
    return F.concat(seq, seq)


def rotated(seq: Column, hit: Column, offset: Column) -> Column:
    """``seq`` as a ring, turned so that what is at ``hit`` comes to ``offset``; an empty one stays empty."""
    n = F.length(seq)
    return F.when(n > 0, F.substr(doubled(seq), F.pmod(hit - offset, n) + 1, n)).otherwise(seq)


def gc_content(seq: Column) -> Column:
    """Share of upper-case G and C; null for an empty sequence."""
    return F.try_divide(F.length(F.regexp_replace(seq, "[^GC]", "")), F.length(seq))


def nearest_int(x: Column) -> Column:
    """The nearest whole number, halves to even."""
    return F.rint(x.cast("double")).cast("int")


def fixed(x: Column, places: int) -> Column:
    """``x`` rounded as decimal text would round it (the exact binary value, halves to even), as a double."""
    return F.call_function("format_number", x, F.lit("0." + "0" * places if places else "0")).cast("double")


def locus_id(haplotype: Column, seq: Column, start: Column, end: Column) -> Column:
    """``seq:start-end``, with ``hN:`` before it where a haplotype number is given."""
    return F.concat(F.when(haplotype.isNotNull(), F.concat(F.lit("h"), haplotype.cast("string"), F.lit(":"))).otherwise(""), seq, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"))


def cluster_label(motif: Column, rank: Column, size: Column) -> Column:
    return F.concat(motif, F.lit("_rank"), F.lpad(rank.cast("string"), 2, "0"), F.lit("_n"), size.cast("string"))


def cluster_uid(entry: Column, label: Column) -> Column:
    return F.concat(entry, F.lit("__"), label)


def letters(index: Column) -> Column:
    """0, 1 ... 25, 26 ... as a, b ... z, aa ...: digits of base 26 without a zero, up to four letters."""
    starts = [0, 26, 26 + 26**2, 26 + 26**2 + 26**3, 26 + 26**2 + 26**3 + 26**4]
    index = index.cast("long")

    def digit(rest: Column, place: int) -> Column:
        return F.char(F.lit(97) + F.pmod(F.floor(rest / 26**place), F.lit(26)))

    out = F.raise_error(F.lit("more than four letters"))
    for n in range(4, 0, -1):
        rest = index - starts[n - 1]
        out = F.when(index < starts[n], F.concat(*(digit(rest, p) for p in range(n - 1, -1, -1)))).otherwise(out)
    return out


def family_name(length: Column, index: Column) -> Column:
    return F.concat(F.lit("SAT"), length.cast("string"), F.lit("_"), letters(index))


def before_hash(header: Column) -> Column:
    return F.trim(F.substring_index(header, "#", 1))


def after_last_hash(name: Column) -> Column:
    return F.element_at(F.split(name, "#"), -1)


def hit_strand(field: Column) -> Column:
    """C is the complement; anything else stays what it is."""
    return F.when(field == "C", "-").otherwise(field)


def bed_strand(field: Column) -> Column:
    return F.when(field == "C", "-").otherwise("+")


def pair_seed(seed: int, a: Column, b: Column) -> Column:
    """The first eight bytes of SHA-256 over seed, a and b (zero bytes between), big endian, as decimal text."""
    zero = F.char(F.lit(0))
    return F.conv(F.substring(F.sha2(F.concat(F.lit(str(seed)), zero, a, zero, b), 256), 1, 16), 16, 10)


def haplotype(path: Column) -> Column:
    """hap1 or hap2 from a path's last part; anything else is an error."""
    found = F.regexp_extract(F.element_at(F.split(path, "/"), -1), "(hap[12])", 1)
    return F.when(found != "", found).otherwise(F.raise_error(F.concat(F.lit("neither hap1 nor hap2 in "), path)))


def fields(line: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(line, r"\s+", " ")), " ")


def is_whole(text: Column) -> Column:
    return text.rlike("^[0-9]+$")


def shard_index(position: Column, shards: int) -> Column:
    """Of the records numbered from 1 on, dealt forth and back over ``shards``."""
    r = F.pmod(position - 1, F.lit(2 * shards))
    return F.when(r < shards, r).otherwise(2 * shards - 1 - r).cast("int")

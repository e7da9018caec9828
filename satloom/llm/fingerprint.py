"""Document fingerprints: invertible Bloom lookup sketches of a text's paragraphs.

A paragraph is a line, or a few sentences of a longer line; its digest is a whole number of 60 bits. A sketch is a row of cells in three thirds, and a
digest is added to one cell of each: a cell counts its digests and XORs them and their check numbers. Two sketches are subtracted cell by cell, which
leaves the digests that only one text has. A cell that holds one digest alone shows it by its check number: that digest is taken out of its
other cells, and so on until all are empty (the differing digests are recovered) or no cell shows one (the sketch is too small).

Cells are rows, and a round of peeling is an aggregation by cell: what is subtracted is added with the sign turned. All cells of a pair of texts lie in
one partition, so that the rounds follow one another without a shuffle, and a long text is no more than more rows. A round looks at one third,
in which each digest has one cell, so that none is taken out twice. Pairs that a fingerprint's own cells are too few for are tried again with sketches as
large as the two texts could differ, and then with twice as many cells until none is left; so the recovered differences are always whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from satloom.llm import common as C

#: A line, or in a longer one what goes on from its start, or from the end of the last paragraph, to the first end of a sentence after LEAST letters.
LEAST = 128
PARAGRAPH = rf"[^\n]{{{LEAST},}}?[.!?]+|[^\n]+"
BITS = 60
#: Primes of the check numbers.
P1, P2 = 2147483647, 2147483629


#: Sketches have three thirds; the digest's sixteen bits for each third say which of its cells it is in.
THIRDS = (0, 1, 2)


@dataclass(frozen=True)
class Sketching:
    """third: cells in each third of a fingerprint; share and least: cells in each third of a larger sketch, as a share of the digests that it may have to hold,
    and besides; sweeps: over the thirds of a larger sketch before it is given up. (Empty cells are no rows, so that a roomy sketch costs little.)"""

    third: int = 6
    share: float = 1.2
    least: int = 20
    sweeps: int = 3


def digests(text: Column) -> Column:
    """The digests of the paragraphs of ``text``, each once, ascending."""
    found = F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0))
    return F.sort_array(F.array_distinct(F.transform(found, lambda p: F.conv(F.substring(F.md5(p.cast("binary")), 1, BITS // 4), 16, 10).cast("long"))))


def check(digest: Column) -> Column:
    """The check number of a digest; products stay below 2^62."""
    return (digest % P1) * (F.shiftright(digest, 29) + 1) % P2


def _place(digest: Column, j: int, third: Column) -> Column:
    """The number of a digest's cell in third ``j`` of a sketch with ``third`` cells in each."""
    return F.shiftright(digest, 16 * j) % third + third * j


def sketch(digests_: Column, third: int) -> Column:
    """The cells (c, k, x) of a set of digests as an array."""
    zero = F.lit(0).cast("long")

    def filled(own: Column) -> Column:
        xor = lambda of: F.aggregate(own, zero, lambda a, d: a.bitwiseXOR(of(d)))
        return F.struct(F.size(own).cast("long").alias("c"), xor(lambda d: d).alias("k"), xor(check).alias("x"))

    def cells(j: int) -> Column:
        own = lambda r: F.filter(digests_, lambda d: _place(d, j, F.lit(third)) == r)
        return F.transform(F.transform(F.sequence(F.lit(third * j), F.lit(third * (j + 1) - 1)), own), filled)

    return F.concat(*(cells(j) for j in THIRDS))


CELL = ("key", "third", "cell", "found")
#: Rows that are no cells: recovered digests of the first and the second set, and one row for each pair.
GONE, NEW, PAIR = -1, -2, -3


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*CELL).agg(F.sum("c").alias("c"), F.bit_xor("k").alias("k"), F.bit_xor("x").alias("x"))


def _row(cell: Column, c: Column, k: Column, x: Column, found: Column) -> Column:
    return F.struct(cell.cast("long").alias("cell"), found.cast("long").alias("found"), c.cast("long").alias("c"), k.alias("k"), x.alias("x"))


def _peeled(cells: DataFrame, j: int, listed: bool) -> DataFrame:
    """``cells`` with the digests that third ``j`` shows taken out of all thirds and noted; cells that are empty go."""
    c, k, x, cell, third, none = (*(F.col(n) for n in ("c", "k", "x", "cell", "third")), F.lit(0).cast("long"))
    pure = (cell >= third * j) & (cell < third * (j + 1)) & (F.abs(c) == 1) & (check(k) == x)
    noted = _row(F.when(c > 0, GONE).otherwise(NEW), F.lit(1), none, none, k if listed else none)
    others = (_row(_place(k, i, third), -c, k, x, none) for i in THIRDS if i != j)
    kept = _row(cell, c, k, x, F.col("found"))
    full = (cell < 0) | (c != 0) | (k != 0) | (x != 0)
    return _summed(cells.select("key", "third", F.inline(F.when(pure, F.array(noted, *others)).when(full, F.array(kept)))))


def _swept(cells: DataFrame, listed: bool) -> DataFrame:
    """A round of peeling for each third."""
    for j in THIRDS:
        cells = _peeled(cells, j, listed)
    return cells


def _sketched(sets: DataFrame, third: Column) -> DataFrame:
    """The difference of the sketches of a and b, for each row of ``sets`` (key, a, b), as rows of cells; the cells of a key are in one partition."""
    zero = F.lit(0).cast("long")
    signed = lambda side, sign: F.transform(side, lambda d: F.struct(d.alias("d"), F.lit(sign).alias("s")))
    pair = F.array(F.struct(zero.alias("d"), F.lit(0).alias("s")))
    rows = sets.select("key", "a", "b", third.cast("long").alias("third")).repartition("key")
    rows = rows.select("key", "third", F.inline(F.concat(pair, signed(F.col("a"), 1), signed(F.col("b"), -1))))
    d, s = F.col("d"), F.col("s")
    placed = F.array(*(_row(_place(d, j, F.col("third")), s, d, check(d), zero) for j in THIRDS))
    return _summed(rows.select("key", "third", F.inline(F.when(s == 0, F.array(_row(F.lit(PAIR), zero, zero, zero, zero))).otherwise(placed))))


FULL = "cell >= 0 AND (c <> 0 OR k <> 0 OR x <> 0)"


def attempted(sets: DataFrame, third: Column, sweeps: int, listed: bool, at: str) -> DataFrame:
    """key, gone and new (how many digests only a or only b has) and whole (whether all were recovered) for ``sets`` (key, a, b); with ``listed`` the digests too,
    as gone_digests and new_digests. After each sweep what is left is stored in the folder ``at``, and only that goes on."""
    cells = C.stored(_swept(_sketched(sets, third), listed), f"{at}/0")
    rows = [cells.where("cell < 0")]
    for i in range(1, sweeps):
        left = cells.where(FULL)
        if left.isEmpty():
            break
        cells = C.stored(_swept(left.repartition("key"), listed), f"{at}/{i}")
        rows.append(cells.where("cell < 0"))
    every = reduce(DataFrame.unionByName, [*rows, cells.where(FULL)])
    cell = F.col("cell")
    counts = [F.coalesce(F.sum(F.when(cell == kind, F.col("c"))), F.lit(0).cast("long")).alias(name) for kind, name in ((GONE, "gone"), (NEW, "new"))]
    lists = [F.collect_list(F.when(cell == kind, F.col("found"))).alias(f"{name}_digests") for kind, name in ((GONE, "gone"), (NEW, "new"))]
    return every.groupBy("key").agg(*counts, (F.count_if(cell >= 0) == 0).alias("whole"), *(lists if listed else []))


def differences(sets: DataFrame, how: Sketching = Sketching(), listed: bool = False) -> DataFrame:
    """key, gone and new for each row of ``sets`` (key, unique; a and b, sorted digests): how many digests only a or only b has; with ``listed`` also
    which (gone_digests and new_digests). The result is stored.

    Fingerprints are tried first, then larger sketches, of pairs that failed only.
    """
    at, more, done = C.shared_dir(sets.sparkSession), 0, []
    third = F.lit(how.third)
    while True:
        found = C.stored(attempted(sets, third, how.sweeps if more else 1, listed, f"{at}/{more}"), f"{at}/{more}/pairs")
        done.append(found.where("whole").drop("whole"))
        if found.where("NOT whole").isEmpty():
            return reduce(DataFrame.unionByName, done)
        sets = sets.join(found.where("NOT whole").select("key"), "key", "left_semi")
        third = F.ceil((F.size("a") + F.size("b")) * (how.share * 2**more)) + how.least * 2**more
        more += 1


def shown(cells: Column) -> Column:
    """A sketch as text: count, digests and checks of each cell."""
    return F.array_join(F.transform(cells, lambda x: F.concat_ws(":", x["c"].cast("string"), F.lower(F.hex(x["k"])), F.lower(F.hex(x["x"])))), " ")


def likeness(size: Column, gone: Column, new: Column) -> Column:
    """The share of the paragraphs of two texts that both have, of which the first has ``size``; 1 for two texts without any."""
    return F.when(size + new > 0, (size - gone) / (size + new)).otherwise(1.0)


def beside(docs: DataFrame, number: str = "doc_id") -> DataFrame:
    """doc_id, text, paras (its digests), next_text and next_paras: each document with the one of the next smaller doc_id, the last with the first.

    A missing doc_id ranks as the smallest, -2^63; documents of one doc_id are ordered by a hash of their texts. Documents are dealt into as many blocks of the
    order as shuffles have partitions, whose borders are found on ids and hashes alone; whole texts are shuffled once. The first document of a block is also
    sent to the block before it.
    """
    spark = docs.sparkSession
    C.whole_number(docs, number)
    own = C.pick(docs, number, "text").select(F.col(number).cast("long").alias("doc_id"), C.whole().alias("text"))
    # ~n falls as n rises, without overflow.
    own = own.withColumns({"rank": F.bitwise_not(F.coalesce("doc_id", F.lit(-(1 << 63)))), "tie": F.xxhash64("text")})
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = own.select("rank", "tie").repartitionByRange(blocks, "rank", "tie").groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("rank", "tie")).alias("b"))
    borders = sorted((r["b"]["rank"], r["b"]["tie"]) for r in parts.collect())
    numbers = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")
    ranks, ties, n = numbers([b[0] for b in borders] or [0]), numbers([b[1] for b in borders] or [0]), max(1, len(borders))

    def halved(s: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        r, t = F.get(ranks, middle), F.get(ties, middle)
        upto = (r < F.col("rank")) | ((r == F.col("rank")) & (t <= F.col("tie")))
        return F.when(s["lo"] >= s["hi"], s).when(upto, F.struct((middle + 1).alias("lo"), s["hi"].alias("hi"))).otherwise(F.struct(s["lo"].alias("lo"), middle.alias("hi")))

    block = F.aggregate(F.sequence(F.lit(0), F.lit(n.bit_length())), F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi")), lambda s, _: halved(s))["lo"] - 1
    rows = own.withColumn("block", block)
    first = (F.get(ranks, F.col("block")) == F.col("rank")) & (F.get(ties, F.col("block")) == F.col("tie"))
    here = F.struct(F.col("block").alias("block"), F.lit(False).alias("tail"))
    before = F.struct(F.pmod(F.col("block") - 1, F.lit(n)).alias("block"), F.lit(True).alias("tail"))
    rows = rows.withColumn("at", F.explode(F.when(first, F.array(here, before)).otherwise(F.array(here)))).select("doc_id", "text", "rank", "tie", "at.*")
    rows = rows.repartition("block").withColumn("paras", digests(F.col("text")))
    following = Window.partitionBy("block").orderBy("tail", "rank", "tie")
    rows = rows.withColumns({"next_text": F.lead("text").over(following), "next_paras": F.lead("paras").over(following)})
    return rows.where("NOT tail").select("doc_id", "text", "paras", "next_text", "next_paras")


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last half (rounded down) replaced by as many of the first letters of ``following``, or all of it."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - half), F.substr(following, F.lit(1), half))


def fingerprints(docs: DataFrame, how: Sketching = Sketching()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, paras and edited_paras (the paragraphs' digests), fingerprint, edited_fingerprint and the
    likenesses near_edited (to the edited text) and near_next (to the next document).

    Null texts count as empty. Order and ties: see beside; in a table of one row the next document is that row itself. Texts that differ in the order or number of
    the same paragraphs alone have equal fingerprints. doc_id must be of an integer type (else TypeError); other columns are not looked at. An empty table
    gives an empty result.
    """
    rows = beside(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "paras", digests(F.col("edited")).alias("edited_paras"), "next_paras",
    )
    rows = C.checkpointed(rows)
    # The two comparisons of a row have the keys 2 rid and 2 rid + 1.
    both = F.explode(F.array(F.struct(F.lit(0).alias("i"), F.col("edited_paras").alias("b")), F.struct(F.lit(1).alias("i"), F.col("next_paras").alias("b"))))
    found = differences(rows.select("rid", F.col("paras").alias("a"), both.alias("p")).select((F.col("rid") * 2 + F.col("p.i")).alias("key"), "a", "p.b"), how)
    one = lambda i, c: F.max(F.when(F.col("key") % 2 == i, F.col(c)))
    found = found.groupBy(F.shiftright("key", 1).alias("rid")).agg(*(one(i, c).alias(f"{c}{i}") for i in (0, 1) for c in ("gone", "new")))
    size, sketched = F.size("paras"), lambda c: shown(sketch(F.col(c), how.third))
    return rows.join(found, "rid").select(
        "doc_id", "n_chars", "edited_sha256", "paras", "edited_paras", sketched("paras").alias("fingerprint"), sketched("edited_paras").alias("edited_fingerprint"),
        likeness(size, F.col("gone0"), F.col("new0")).alias("near_edited"), likeness(size, F.col("gone1"), F.col("new1")).alias("near_next"),
    )


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints(C.documents(spark, sf_dir))
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


OP12_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
 n AS (SELECT row_number() OVER w AS id, doc_id, text, coalesce(lead(text) OVER w, first_value(text) OVER w) AS following FROM t WINDOW w AS (ORDER BY doc_id DESC NULLS LAST)),
 e AS (SELECT *, substr(text, 1, length(text) - length(text) // 2) || substr(following, 1, length(text) // 2) AS edited FROM n),
 v AS (SELECT id, doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, list_transform([text, edited, following], lambda s: list_distinct(list_transform(
   regexp_extract_all(s, '{PARAGRAPH}'), lambda p: CAST(CAST('0x' || substr(md5(p), 1, 15) AS UBIGINT) AS BIGINT)))) AS d FROM e),
 x AS (SELECT id, i, unnest(d[i]) AS k FROM v, (VALUES (1), (2)) AS s(i)),
 c AS (SELECT id, i, (k >> (16 * j)) % 6 + 6 * j AS cell, count(*) AS c, bit_xor(k) AS k, bit_xor((k % {P1}) * ((k >> 29) + 1) % {P2}) AS x FROM x, (VALUES (0), (1), (2)) AS t(j) GROUP BY ALL),
 f AS (SELECT v.id, s.i, string_agg(coalesce(c.c, 0) || ':' || lower(to_hex(coalesce(c.k, 0))) || ':' || lower(to_hex(coalesce(c.x, 0))), ' ' ORDER BY g.cell) AS f
  FROM v CROSS JOIN (VALUES (1), (2)) AS s(i) CROSS JOIN (SELECT unnest(range(18)) AS cell) g LEFT JOIN c ON c.id = v.id AND c.i = s.i AND c.cell = g.cell GROUP BY v.id, s.i),
 l AS (SELECT *, len(d[1]) AS n, len(list_intersect(d[1], d[2])) AS m2, len(list_intersect(d[1], d[3])) AS m3 FROM v)
SELECT doc_id, n_chars, edited_sha256, a.f AS fingerprint, b.f AS edited_fingerprint,
 CASE WHEN n + len(d[2]) = 0 THEN 1.0 ELSE CAST(m2 AS DOUBLE) / (n + len(d[2]) - m2) END AS near_edited, CASE WHEN n + len(d[3]) = 0 THEN 1.0 ELSE CAST(m3 AS DOUBLE) / (n + len(d[3]) - m3) END AS near_next
FROM l JOIN f a ON a.id = l.id AND a.i = 1 JOIN f b ON b.id = l.id AND b.i = 2
"""

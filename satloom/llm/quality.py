"""Quality rules: a few counts of words and lines, and a likelihood ratio of hashed n-grams.

Single words and pairs of words are hashed into a fixed number of buckets. Two multinomials over the buckets, of trusted
documents and of all documents, give each bucket the logarithm of its probabilities' ratio; a document's score is the
mean over its n-grams. Scores are sums of whole millionths, so that they are the same however the data lie.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satloom.llm import common as C

SYMBOL = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rules:
    """min_words and max_repeat_pct: what fails a text outright; window: words of a repeated passage.

    buckets bounds the model, which is sent to every task (16 bytes a bucket). trusted: at most so many labelled rows, those of
    lowest hash, stand for the target. prior: pseudo-counts a bucket, dealt as the whole corpus is. least: a mean that is always
    kept; lower ones are down to the quantile ``lost`` of the means that clean texts have.
    """

    min_words: int = 20
    max_repeat_pct: int = 30
    window: int = 8
    buckets: int = 1 << 16
    trusted: int = 20_000
    prior: float = 1.0
    least: float = -0.1
    lost: float = 0.02
    seed: int = 17


def _repeat_words(hashes: Column, window: int) -> Column:
    """Words in windows whose content (told by a 64-bit hash of the words' hashes) occurs twice or more."""

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(starts, i + 1) - x, F.lit(window))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(own: Column) -> Column:
        ordered = F.array_sort(F.transform(own, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = lambda s: F.filter(
            F.transform(
                s,
                lambda x, j: F.when((F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]), x["i"]),
            ),
            lambda i: i.isNotNull(),
        )
        return C.let(F.array_sort(C.let(ordered, twice)), covered)

    def counted(w: Column) -> Column:
        own = F.slice(w, 1, F.size(hashes) - (window - 1))
        return C.let(own, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(repeated(w)))

    def widened(held: Column, span: int) -> Column:
        """Hashes of ``window`` words from hashes of ``span``: each joined to the one so far after it that they meet or overlap."""
        if span == window:
            return counted(held)
        shift = min(span, window - span)
        return C.let(F.transform(held, lambda h, i: F.xxhash64(h, F.get(held, i + shift))), lambda w: widened(w, span + shift))

    found = widened(hashes, 1)
    return F.when(F.size(hashes) > window, found).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame, rules: Rules = Rules(), rid: str | None = None) -> DataFrame:
    """rid, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and the words."""
    rows = C.keyed(docs, "doc_id", "text", rid=rid).withColumn("text", C.whole())
    rows = rows.select("rid", "doc_id", "text", C.words_of(F.col("text")).alias("words"))
    rows = rows.select(
        "rid",
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        C.let(
            F.filter(F.split("text", "\n"), lambda line: line.rlike(C.WORD)), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))
        ).cast("long").alias("n_dup_lines"),
        C.let(F.transform("words", lambda w: F.xxhash64(w)), lambda h: _repeat_words(h, rules.window)).alias("n_repeat_words"),
        "words",
    )
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def grams(rows: DataFrame, rules: Rules) -> DataFrame:
    """A row for each word of ``words``: ``one``, the bucket of the word, and ``two``, that of it and the next (null at the end).

    A text without words gives one row without buckets. The words are exploded, not transformed: that is generated code. Each goes with the
    word after it, so that no row carries the whole text's.
    """
    place = lambda h: F.pmod(h, F.lit(rules.buckets)).cast("int")
    each = rows.withColumn("after", F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))))
    each = each.select(*(c for c in rows.columns if c != "words"), F.explode_outer(F.arrays_zip("words", "after")).alias("at"))
    word, after = F.col("at.words"), F.col("at.after")
    one, two = F.when(word.isNotNull(), place(F.xxhash64(word))), F.when(after.isNotNull(), place(F.xxhash64(word, after)))
    return each.withColumns({"one": one, "two": two}).drop("at")


def trusted_ids(labels: DataFrame, rules: Rules) -> DataFrame:
    """At most ``rules.trusted`` doc_ids of labelled good documents."""
    good = C.pick(labels, "doc_id", "quality").where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64(F.lit(rules.seed), "doc_id"), "doc_id").limit(rules.trusted)


def clean_means(docs: DataFrame, trusted: DataFrame, counts: DataFrame, n: int, g: int, rules: Rules) -> DataFrame:
    """mean_ratio of each trusted row that does not fail outright, as it would be if that row alone were not trusted.

    A trusted text's own n-grams lift its mean, the more so the fewer there are; without them it scores as a clean text does
    that has no label.
    """
    own = measured(docs.join(F.broadcast(trusted), "doc_id", "left_semi"), rules).where(~F.col("base_failed")).select("rid", "words")
    own = grams(own, rules).select("rid", F.explode(F.array("one", "two")).alias("bucket")).where("bucket IS NOT NULL")
    own = own.groupBy("rid", "bucket").agg(F.count(F.lit(1)).alias("k")).join(F.broadcast(counts), "bucket")
    weight = _weight(F.col("g") - F.col("k"), F.col("n"), n, g, rules)
    return own.groupBy("rid").agg((F.sum(weight * F.col("k")) / F.sum("k") / 1_000_000).alias("mean_ratio"))


def _weight(good: Column, every: Column, n: int, g: int, rules: Rules) -> Column:
    prior = rules.prior * rules.buckets
    target = (good + prior * every / n) / (g + prior)
    return F.round(F.log(target / (every / n)) * 1_000_000).cast("long")


def model(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> tuple[DataFrame, float]:
    """(bucket, weight): the log ratio in millionths, from n-gram counts over all of ``docs`` and over the trusted ones; and the
    lowest mean that is kept."""
    docs = C.pick(docs, "doc_id", "text")
    rows = docs.select("doc_id", C.words_of(C.whole()).alias("words"))
    # Bounded by rules.trusted rows, and so sent whole to each task.
    trusted = C.checkpointed(trusted_ids(labels, rules))
    rows = rows.join(F.broadcast(trusted.withColumn("good", F.lit(1))), "doc_id", "left")
    each = grams(rows.select(F.coalesce("good", F.lit(0)).alias("good"), "words"), rules)
    counts = each.select("good", F.explode(F.array("one", "two")).alias("bucket")).where("bucket IS NOT NULL")
    counts = counts.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("g"))
    counts = C.checkpointed(counts)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("g"), F.lit(0))).first()
    n, g = int(total[0]), int(total[1])
    if not g:  # nothing is trusted: no n-gram speaks for or against a text
        return counts.select("bucket", F.lit(0).cast("long").alias("weight")), rules.least
    low = clean_means(docs, trusted, counts, n, g, rules).agg(F.percentile("mean_ratio", F.lit(rules.lost))).first()[0]
    # Where no clean text tells how such score, none is held against its mean.
    least = -math.inf if low is None else min(rules.least, low)
    return counts.select("bucket", _weight(F.col("g"), F.col("n"), n, g, rules).alias("weight")), least


def judged(docs: DataFrame, labels: DataFrame, rules: Rules = Rules(), rid: str | None = None) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, the counts, base_failed, mean_ratio and kept.

    Null and empty texts have no words: all counts are 0, base_failed holds, mean_ratio is null and kept is false. Repeated rows
    are judged each for itself, and alike. Without labelled good documents all that does not fail is kept. rid: see common.keyed.
    """
    weights, least = model(docs, labels, rules)
    weights = F.broadcast(weights)  # rules.buckets rows at most
    rows = measured(docs, rules, rid)
    counts = [c for c in rows.columns if c not in ("rid", "words")]
    each = grams(rows, rules).join(weights.toDF("one", "w1"), "one", "left").join(weights.toDF("two", "w2"), "two", "left")
    weight = F.coalesce("w1", F.lit(0)) + F.coalesce("w2", F.lit(0))
    own = each.groupBy("rid").agg(
        *(F.first(c).alias(c) for c in counts), F.sum(weight).alias("total"), (F.count("one") + F.count("two")).alias("n_grams")
    )
    mean = F.when(F.col("n_grams") > 0, F.col("total") / F.col("n_grams") / 1_000_000)
    kept = ~F.col("base_failed") & F.coalesce(mean >= least, F.lit(False))
    return own.select("rid", *counts, mean.alias("mean_ratio"), kept.alias("kept"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(C.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("rid")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    rows = C.numbered(docs)
    found = judged(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"), rid=C.ROW)
    return C.only(rows, found.where("kept"))

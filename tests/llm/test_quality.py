import math
from collections import Counter, defaultdict

import xxhash
from conftest import WORD  # type: ignore[import-not-found]

from pyspark.sql import functions as F

from satloom.llm import common as C
from satloom.llm import quality as Q

AT = "/root/testdata/sf0.01"


def base(text):
    text = text or ""
    words = WORD.findall(text)
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i : i + 8])].append(i)
    covered = {i + j for own in at.values() if len(own) > 1 for i in own for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def brute_grams(text, buckets):
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    words = [w.encode() for w in WORD.findall(text or "")]
    ones = [xxhash.xxh64_intdigest(w, 42) for w in words]
    pairs = [xxhash.xxh64_intdigest(b, a) for a, b in zip(ones, words[1:])]
    return [signed(x) % buckets for x in ones + pairs]


def test_all_documents_against_brute_force(spark):
    docs, rules = C.documents(spark, AT), Q.Rules()
    labels = spark.read.parquet(f"{AT}/labels.parquet")
    got = {r["doc_id"]: r for r in Q.op3(spark, AT).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert got.keys() == texts.keys()
    trusted = {r["doc_id"] for r in Q.trusted_ids(labels, rules).collect()}
    assert trusted == {r["doc_id"] for r in labels.where("quality = 1").collect()}
    grams = {d: brute_grams(t, rules.buckets) for d, t in texts.items()}
    every, good = Counter(), Counter()
    for d, own in grams.items():
        every.update(own)
        if d in trusted:
            good.update(own)
    n, g, prior = every.total(), good.total(), rules.prior * rules.buckets
    weight = {b: round(math.log((good[b] + prior * k / n) / (g + prior) / (k / n)) * 1e6) for b, k in every.items()}
    least = rules.least - rules.buckets / (g + prior)
    for d, r in got.items():
        want = base(texts[d])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want
        mean = sum(weight[b] for b in grams[d]) / len(grams[d]) / 1e6
        assert abs(r["mean_ratio"] - mean) < 1e-5
        assert r["kept"] == (not want[-1] and r["mean_ratio"] >= least)


def test_repeats_in_windows_of_any_width(spark):
    texts = ["a b c a b c a b", "x y x y x", "a a a a a a", "a b c d e", "", "a"]
    docs = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.transform(C.words_of(F.col("t")), lambda w: F.xxhash64(w)).alias("h"))
    for window in (1, 2, 3, 5):
        for r in docs.select("t", Q._repeat_words(F.col("h"), window).alias("n")).collect():
            words = r["t"].split()
            at = defaultdict(list)
            for i in range(len(words) - window + 1):
                at[tuple(words[i : i + window])].append(i)
            assert r["n"] == len({i + j for own in at.values() if len(own) > 1 for i in own for j in range(window)}), (r["t"], window)


def test_clean_documents_stay_and_symbol_ridden_ones_go(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{AT}/labels.parquet").collect()}
    rows = [r for r in Q.op3(spark, AT).collect() if r["doc_id"] in labels and not r["base_failed"]]
    assert all(r["kept"] for r in rows if labels[r["doc_id"]] == 1)
    bad = [r["kept"] for r in rows if labels[r["doc_id"]] == 0]
    assert sum(bad) <= 0.1 * len(bad)


def test_odd_and_empty_tables(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1), (None, 1), (99, 1), (8, 0)], "doc_id long, quality int")
    rows = Q.judged(odd, labels).collect()
    assert len(rows) == odd.count() and Q.judged(empty, labels).count() == 0
    for r, text in zip(sorted(rows, key=lambda r: r["rid"]), [x["text"] for x in odd.collect()], strict=True):
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base(text)
        assert (r["mean_ratio"] is None) == (r["n_words"] == 0)
    nothing = Q.judged(odd, labels.where("false")).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in nothing)


def test_few_labels_reject_bad_rows_of_a_large_table(spark):
    at = "/root/testdata/sf0.1"
    docs, labels = C.documents(spark, at), spark.read.parquet(f"{at}/labels.parquet")
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    for n in (60, 150, 300):
        few = Q.trusted_ids(labels, Q.Rules(trusted=n)).withColumn("quality", F.lit(1))
        trusted = {r["doc_id"] for r in few.collect()}
        assert len(trusted) == n
        rows = [r for r in Q.judged(docs, few).where("NOT base_failed").select("doc_id", "kept").collect() if r["doc_id"] in quality]
        bad = [r["kept"] for r in rows if quality[r["doc_id"]] == 0]
        good = [r["kept"] for r in rows if quality[r["doc_id"]] == 1 and r["doc_id"] not in trusted]
        assert len(bad) > 200 and sum(bad) <= 0.15 * len(bad), n
        assert sum(good) >= 0.95 * len(good), n


def test_one_trusted_text_rejects_nothing(spark):
    docs = C.documents(spark, AT)
    one = docs.where("n_chars > 500").orderBy("doc_id").limit(1).select("doc_id", F.lit(1).alias("quality"))
    assert Q.judged(docs, one).where("NOT base_failed AND NOT kept").count() == 0

import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls, empty and blank texts, repeated rows, ties, one long text, copies that differ in case.
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n\r\x0b\x0c ", "en", "a", 7),
    (4, "One two three four five six seven", "en", "b", 33),
    (4, "One two three four five six seven", "en", "b", 33),
    (5, "one TWO three four five six seven", "en", "b", 33),
    (6, "É accents Ünd ß stay É", "fr", None, 22),
    (7, "é accents ünd ß stay é", "fr", None, 22),
    (None, "no id at all here", "en", "b", 17),
    (None, "no id at all here", "en", "b", 17),
    (8, "word " * 30_000, "en", "c", 150_000),
    (9, "x" * 50_000, "en", "c", 50_000),
    (10, "line one\nline one\n\nline two\n line one", "en", "c", 37),
]


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """The odd rows as a stored table, with columns whose names clash with those of operators."""
    at = str(tmp_path_factory.mktemp("odd"))
    made = spark.createDataFrame(ODD, DOCUMENTS).selectExpr("*", "'x' AS kept", "1 AS rid", "2 AS size", "3 AS fp", "4 AS n_words")
    made.coalesce(1).write.mode("overwrite").parquet(at)
    return spark.read.parquet(at)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], DOCUMENTS).write.mode("overwrite").parquet(at)
    return spark.read.parquet(at)


def spark_hash(*values):
    """XXH64 as Spark chains it over a row: (number, bytes) pairs for whole numbers, str for text, None for null; as a signed long."""
    import xxhash

    h = 42
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else v[0].to_bytes(v[1], "little", signed=True)
            h = xxhash.xxh64_intdigest(data, h)
    return h - (1 << 64) if h >> 63 else h


def int_(n):
    return (n, 4)


def long_(n):
    return None if n is None else (n, 8)

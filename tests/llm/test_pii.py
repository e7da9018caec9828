import hashlib
import re

from satloom.llm import common as C
from satloom.llm import pii as P

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if holds(k, m[0])]


def line(spans):
    return ",".join(f"{k}:{a}:{z}" for k, a, z in spans)


CASES = [
    "mail a.b+c@x-y.example.com_d@e.f, again @no.where x@y",
    "a@b.c.d@e.f a@b.c_d@e.f %@a.b",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.001.1.1 1.2.3 9.9.9.99999999999999999999 7.7.7.7",
    "é 4539 1488 0343 6467, 4539148803436467 79927398713 4539-1488-0343-6467 12- 3",
    "+1 (017) 555-7713 4539148803436467 +12 +1 2 3 4 5 6 7 8 9 +49.(89).1234-5678) +1---",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 and DE88370400440532013000",
    "ssn 123-45-6789 but 123-45-6789 in order no 123-45-6789",
    "1.1.1.1 " * 3000,
    "5" * 40_000 + "@" + "a.b" * 20_000,
    "x" * 100_000,
]


def test_cases(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(CASES)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in P.personal(docs).collect():
        got = [(s["kind"], s["start"], s["end"]) for k in P.BASE for s in r[k]]
        assert got == base(CASES[r["doc_id"]]), r["doc_id"]
        if r["doc_id"] == 5:
            assert [CASES[5][s["start"] : s["end"]] for s in r["iban"]] == ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]
        if r["doc_id"] == 6:
            assert [s["start"] for s in r["ssn"]] == [4]
    text = {r["doc_id"]: r["text"] for r in P.redacted(docs).collect()}
    assert text[6].startswith("ssn [ssn] but 123-45-6789")
    assert text[7] == "[ip] " * 3000


def test_query_on_all_documents(spark):
    at = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in C.documents(spark, at).select("doc_id", "text").collect()}
    rows = P.op1(spark, at).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(line(want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in P.BASE] == [sum(x[0] == k for x in want) for k in P.BASE]


def test_odd_and_empty_tables(odd, empty):
    assert P.personal(odd).count() == odd.count() and P.personal(empty).count() == 0
    assert all(not r[k] for r in P.personal(odd).collect() for k in P.KINDS)

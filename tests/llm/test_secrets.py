import hashlib
import random
import re

import numpy as np

from satloom.llm import automaton as A
from satloom.llm import common as C
from satloom.llm import secrets as S

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    text = text or ""
    found = [("assign", m) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    rank = {"assign": 0, "access": 1, "hex": 2}
    found.sort(key=lambda x: (x[1].start(), rank[x[0]]))
    return [(k, m.start(), m.end()) for k, m in found]


#: What the rules mean: pattern, and what a match must satisfy besides.
MEANT = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= 12),
    "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
    "github": (re.compile("gh[pousr]_[A-Za-z0-9]{36,}"), lambda m: True),
    "slack": (re.compile("xox[abprs]-[0-9]{10,}(?:-[A-Za-z0-9]+)*"), lambda m: True),
    "stripe": (re.compile("[sr]k_live_[A-Za-z0-9]{16,}"), lambda m: True),
    "private_key": (re.compile(r"-----BEGIN\x20[A-Z]*\x20?PRIVATE\x20KEY-----"), lambda m: True),
}


def meant(text):
    found = [(m.start(), i, m.end(), k) for i, (k, (p, holds)) in enumerate(MEANT.items()) for m in p.finditer(text) if holds(m)]
    return [(k, a, z) for a, _, z, k in sorted(found)]


BITS = ["token", "Api_Key", "=", ":", " ", '"', "AKIA", "ABCDEF1234567890", "0123456789abcdef", "ghp_", "é", "x" * 40, "token=abcdefghijkl", "secret: ",
        "sk_live_", "xoxb-1234567890", "-----BEGIN RSA PRIVATE KEY-----", "password", "a", "\n", "F00", "\r\n", "\u2028", "-", "_", ",", "AKI", "A" * 9, "b" * 11]


def test_spans_of_all_rules_on_random_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choices(BITS, k=rng.randint(0, 15))) for _ in range(6000)] + ["deadbeef" * 5000, "z" * 30_000, "ghp_" * 5000, "", "é"]
    assert S.scan(S.compiled(), [t.encode() for t in texts]) == [meant(t) for t in texts]
    scanner = S.compiled()
    assert [S.scan(scanner, [t.encode()])[0] for t in texts[:500]] == [meant(t) for t in texts[:500]]


def test_backward_automaton_tells_where_matches_begin():
    rules = {"a": ("(a|b)c{2,3}", False), "b": ("[x-z]+1?", True), "c": ("cc", False)}
    dfa, rng = A.compiled(rules, backward=True), random.Random(2)
    for _ in range(300):
        text = "".join(rng.choices("abcxyZ1\n-", k=rng.randint(0, 60)))
        where, bits = A.starts(dfa, text.encode())
        want = [(i, sum(1 << b for b, (p, fold) in enumerate(rules.values()) if re.compile(p, re.I if fold else 0).match(text, i))) for i in range(len(text))]
        assert list(zip(where.tolist(), bits.tolist(), strict=True)) == [(i, m) for i, m in want if m], text


def test_pieces_that_begin_in_a_wrong_state_are_read_again(monkeypatch):
    """Blanks after ':' or '=' are remembered however many there are, so that no few bytes tell the state."""
    rng, scanner = random.Random(5), S.compiled()
    parts = [" " * 7, " " * 300, "token", "passwd", ":", "=", "abcdefghijkl", "0123456789abcdef" * 9, "f" * 500, "7" * 99, "AKIA" + "Q" * 70, '"', "z", "\n", "é"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(400)] + ["secret:" + " " * 5000 + "abcdefghijklm", " " * 5000, "token" + " " * 9000 + "=abcdefghijkl"]
    want = [meant(t) for t in texts]
    for long, warm, few, loop in ((2048, 64, 24, 32), (16, 4, 0, 2), (16, 16, 1000, 1), (50, 1, 3, 3), (7, 7, 24, 32)):
        for name, value in (("LONG", long), ("WARM", warm), ("FEW", few), ("LOOP", loop)):
            monkeypatch.setattr(A, name, value)
        assert S.scan(scanner, [t.encode() for t in texts]) == want


def test_minimal_automaton_has_no_equal_states():
    for backward in (False, True):
        dfa = A.compiled({"a": ("(a|b)c{2,3}", False), "b": ("[x-z]+1?", True)}, backward)
        table, accept = A.minimised(dfa.table, dfa.accept)
        assert len(table) == len(dfa.table) and np.array_equal(np.sort(accept), np.sort(dfa.accept))


def test_query_on_all_documents(spark):
    at = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in C.documents(spark, at).select("doc_id", "text").collect()}
    rows = S.op9(spark, at).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r["doc_id"]])
        line = ",".join(f"{k}:{a}:{z}" for k, a, z in want)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in S.BASE] == [sum(x[0] == k for x in want) for k in S.BASE]
        assert set(line.split(",")) <= set(r["spans"].split(","))


def test_odd_and_empty_tables(odd, empty):
    assert S.secrets(odd).count() == odd.count() and S.secrets(empty).count() == 0
    assert all(not r["secrets"] for r in S.secrets(odd).collect())


def test_positions_and_dropped_matches(spark):
    cases = ["é token: 'abcdefghijkl'", "token=token:abcdefghijklmnop", "secret=token=abcdefghijklmnop", "AKIA" + "B" * 13, "AKIA" + "B" * 14,
             "0123456789abcde", "0123456789abcdef0", "PASSWORD = aaaaaaaaaaaa", "aİpi_key=abcdefghijkl", "ghp_" + "a" * 36]
    dfa = S.compiled()
    for text, found in zip(cases, S.scan(dfa, [c.encode() for c in cases]), strict=True):
        assert [x for x in found if x[0] in S.BASE] == base(text)
    assert S.scan(dfa, [("ghp_" + "a" * 36).encode()])[0][0] == ("github", 0, 40)

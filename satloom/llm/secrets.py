"""Secret scans: all rules compiled into one minimal automaton, which reads each byte of the texts once.

It reads backward and so tells where each rule's matches begin. From a beginning on, a second automaton of the same rules reads
forward and tells where the match ends, and whether it is long enough. Spans are leftmost and do not overlap within a rule.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satloom.llm import automaton as A
from satloom.llm import common as C

BASE = ("assign", "access", "hex")


@dataclass(frozen=True)
class Rule:
    """A secret is ``head`` and then ``tail`` as often as it goes, ``least`` times or more.

    drops: a match with fewer tails is no secret and yet uses up its text; else the search goes on within it. scan: tails that the pass over
    all bytes counts; the others are counted on the way forward. (Counting several overlapping classes at once multiplies states.)
    """

    head: str
    tail: str = ""
    least: int = 0
    ignore_case: bool = False
    drops: bool = False
    scan: int = 1

    def pattern(self, least: int) -> str:
        return f"{self.head}{self.tail}{{{least},}}" if self.tail else self.head


RULES: dict[str, Rule] = {
    "assign": Rule(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?", "[A-Za-z0-9+/_.=-]", 12, ignore_case=True, drops=True),
    "access": Rule("AKIA", "[A-Z0-9]", 14, drops=True),
    "hex": Rule("", "[0-9a-f]", 16, scan=16),
    "github": Rule("gh[pousr]_", "[A-Za-z0-9]", 36),
    "slack": Rule("xox[abprs]-[0-9]{10,}", "(?:-[A-Za-z0-9]+)", scan=0),
    "stripe": Rule("[sr]k_live_", "[A-Za-z0-9]", 16),
    "private_key": Rule(r"-----BEGIN\x20[A-Z]*\x20?PRIVATE\x20KEY-----"),
}

SPANS = "array<struct<kind:string,start:long,end:long>>"
#: Bytes of text that are scanned together.
SLICE = 4 << 20


@dataclass(frozen=True)
class Scanner:
    """backward: where matches with ``scan`` tails begin; forward: by rule, a bit for those and one for matches with ``least``."""

    backward: A.Dfa
    forward: A.Dfa


def compiled(rules: dict[str, Rule] = RULES) -> Scanner:
    scan = {n: (r.pattern(r.scan), r.ignore_case) for n, r in rules.items()}
    least = {f"{n}!": (r.pattern(r.least), r.ignore_case) for n, r in rules.items()}
    return Scanner(A.compiled(scan, backward=True), A.compiled(scan | least))


def _spans(walker: A.Walker, data: bytes, begins: np.ndarray, bit: int, whole: int, drops: bool) -> list[tuple[int, int]]:
    """Of the matches that begin at ``begins``, those that hold: leftmost, none before the end of the last."""
    found, at, i = [], 0, 0
    while i < len(begins):
        start = int(begins[i])
        loose, full = walker.ends(data, start, bit, whole)
        if full >= 0 and (full == loose or not drops):
            found.append((start, full))
        at = loose if drops else max(full, start + 1)
        i = int(np.searchsorted(begins, at))
    return found


def scan(scanner: Scanner, texts: list[bytes]) -> list[list[tuple[str, int, int]]]:
    """The secrets in each text (kind, start, end in code points), sorted by start and kind. No rule crosses a line end."""
    data = b"\n".join(texts)
    where, bits = A.starts(scanner.backward, data)
    found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    if not len(where):
        return found
    walker = A.Walker(scanner.forward)
    lengths = np.array([len(t) + 1 for t in texts])
    begin = np.cumsum(lengths) - lengths
    spans = []
    for rank, (kind, rule) in enumerate(RULES.items()):
        own = _spans(walker, data, where[bits >> rank & 1 == 1], 1 << rank, 1 << (rank + len(RULES)), rule.drops)
        spans += [(a, rank, kind, z) for a, z in own]
    spans.sort()
    owner = np.searchsorted(begin, [a for a, *_ in spans], side="right") - 1
    cut = np.flatnonzero(np.diff(owner, prepend=-1)).tolist() + [len(spans)]
    for low, high in itertools.pairwise(cut):
        i = int(owner[low])
        raw, first = np.frombuffer(texts[i], np.uint8), int(begin[i])
        # A code point starts at every byte that does not carry one on.
        points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        found[i] = [(kind, int(points[a - first]), int(points[z - first])) for a, _, kind, z in spans[low:high]]
    return found


def _scanner(scanner: Scanner):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, found, i = batch.column("text").cast(pa.binary()), [], 0
            while i < len(text):
                some: list[bytes] = []
                size = 0
                while i < len(text) and (not some or size + len(text[i].as_py()) <= SLICE):
                    some.append(text[i].as_py())
                    size += len(some[-1])
                    i += 1
                found += scan(scanner, some)
            rows = [[{"kind": k, "start": a, "end": z} for k, a, z in own] for own in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "secrets"])

    return scanned


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id and ``secrets`` (kind, start and end in code points, by start and then kind as in RULES) of each row.

    Null and empty texts have none. Repeated rows each give a row, an empty table none; other columns are not looked at.
    """
    rows = C.pick(docs, "doc_id", "text").select("doc_id", C.whole().alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_scanner(compiled()), f"doc_id {id_type}, secrets {SPANS}")


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(C.documents(spark, sf_dir))
    of = lambda *kinds: F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(listed(of(*BASE)).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


#: Text between matches and the matches in turn give each match its place.
OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
 k(rank, kind, pattern) AS (VALUES (0, 'assign', '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  (1, 'access', 'AKIA[A-Z0-9]+'), (2, 'hex', '[0-9a-f]+'), (3, 'github', 'gh[pousr]_[A-Za-z0-9]{36,}'), (4, 'slack', 'xox[abprs]-[0-9]{10,}(?:-[A-Za-z0-9]+)*'),
  (5, 'stripe', '[sr]k_live_[A-Za-z0-9]{16,}'), (6, 'private_key', '-----BEGIN\x20[A-Z]*\x20?PRIVATE\x20KEY-----')),
 m AS (SELECT r, rank, kind, pattern, regexp_extract_all(t, pattern) AS hits, string_split_regex(t, pattern) AS gaps FROM d, k),
 s AS (SELECT r, rank, kind, pattern, generate_subscripts(hits, 1) AS i, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap FROM m WHERE len(hits) > 0),
 p AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY r, rank ORDER BY i) AS e FROM s),
 f AS (SELECT r, rank, kind, CAST(e - length(hit) AS BIGINT) AS a, CAST(e AS BIGINT) AS z FROM p WHERE CASE kind WHEN 'assign' THEN length(regexp_extract(hit, pattern, 1)) >= 12
  WHEN 'access' THEN length(hit) >= 18 WHEN 'hex' THEN length(hit) >= 16 ELSE true END),
 g AS (SELECT r, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access, count(*) FILTER (WHERE rank = 2) AS n_hex,
  string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, rank, z) FILTER (WHERE rank < 3) AS base, string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, rank, z) AS spans FROM f GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
 coalesce(spans, '') AS spans FROM d LEFT JOIN g ON g.r = d.r
"""

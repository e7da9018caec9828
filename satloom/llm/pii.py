"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their scores.

All of it is column expressions. Where a pattern matches is told from the pieces between its matches: a span starts at the
summed lengths of what stands before it. Those sums are folded in blocks, so that a text with very many matches stays
affordable. Quantifiers are possessive and starts are anchored at runs, so that no text makes a pattern backtrack
over it again and again; what matches is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satloom.llm import common as C

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")

PATTERN = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9_])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}

#: What a text must hold for the pattern to be tried at all.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}", "ssn": r"[0-9]-[0-9]"}

#: A span's score before its surroundings count, what words before it add, and those words.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT = 0.35
NEAR = {
    "email": r"(?i)e-?mail|contact|mailto",
    "ip": r"(?i)\bip\b|address|host|server",
    "card": r"(?i)card|visa|mastercard|amex|credit|payment",
    "phone": r"(?i)phone|call|tel\b|mobile|fax",
    "iban": r"(?i)iban|bank|account|konto",
    "ssn": r"(?i)\bssn\b|social security",
}
#: Words that speak against a span, whatever its kind.
AGAINST = r"(?i)version|invoice|order no|example|sample|serial"
WINDOW = 40
KEEP = 0.6
BLOCK = 256

_SPAN = "struct<kind:string,start:int,end:int,score:double>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _mod97(match: Column) -> Column:
    """Whether the letters-as-numbers form, its first four characters moved to the end, leaves 1."""
    bare = F.regexp_replace(match, r"\x20", "")
    chars = F.split(F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4)), "")
    value = lambda c: F.when(c.rlike("[0-9]"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(
        F.filter(chars, lambda c: c != ""), F.lit(0), lambda a, c: ((a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97).cast("int")
    )
    return rest == 1


def _holds(kind: str, match: Column) -> Column:
    if kind == "ip":
        # Longer parts than three digits count by their value, whatever zeros lead.
        return F.forall(F.split(match, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+(?=.)", "")) <= 3) & F.forall(
            F.split(match, r"\."), lambda p: F.coalesce(p.try_cast("long") <= 255, F.lit(False))
        )
    if kind == "card":
        return F.length(_digits(match)).between(13, 19) & F.call_function("luhn_check", _digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        return _mod97(match)
    if kind == "ssn":
        return ~match.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _score(kind: str, match: Column, before: Column) -> Column:
    near = F.right(before, F.lit(WINDOW))
    score = F.lit(PRIOR[kind]) + F.when(near.rlike(NEAR[kind]), CONTEXT).otherwise(0.0) - F.when(near.rlike(AGAINST), CONTEXT).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def _located(kind: str, text: Column) -> Column:
    """Spans of ``kind`` that hold, in order."""
    none = F.array().cast(f"array<{_SPAN}>")

    def piece(before: Column, match: Column) -> Column:
        return F.struct(
            F.length(before).alias("gap"),
            F.length(match).alias("len"),
            F.when(F.coalesce(_holds(kind, match), F.lit(False)), _score(kind, match, before)).alias("score"),
        )

    pieces = F.filter(
        F.zip_with(F.split(text, PATTERN[kind], -1), F.regexp_extract_all(text, F.lit(PATTERN[kind]), F.lit(0)), piece),
        lambda p: p["len"].isNotNull(),
    )

    def folded(at: Column, block: Column) -> Column:
        """Where the block ends, and the spans in it that hold."""
        return F.aggregate(
            block,
            F.struct(at.alias("at"), none.alias("out")),
            lambda a, p: F.struct(
                (a["at"] + p["gap"] + p["len"]).alias("at"),
                F.when(p["score"].isNull(), a["out"])
                .otherwise(
                    F.concat(
                        a["out"],
                        F.array(
                            F.struct(
                                F.lit(kind).alias("kind"), (a["at"] + p["gap"]).alias("start"),
                                (a["at"] + p["gap"] + p["len"]).alias("end"), p["score"].alias("score"),
                            )
                        ),
                    )
                )
                .alias("out"),
            ),
        )

    def spans(p: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / BLOCK).cast("int")), lambda b: F.slice(p, b * BLOCK + 1, BLOCK))
        whole = F.aggregate(
            blocks,
            F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{_SPAN}>>").alias("out")),
            lambda a, block: C.let(folded(a["at"], block), lambda f: F.struct(f["at"].alias("at"), F.concat(a["out"], F.array(f["out"])).alias("out"))),
            lambda a: F.flatten(a["out"]),
        )
        return F.when(F.size(p) > 0, whole).otherwise(none)

    return F.when(text.rlike(NEEDS[kind]), C.let(pieces, spans)).otherwise(none)


def personal(docs: DataFrame) -> DataFrame:
    """doc_id, text and a column of spans for each kind (kind, start, end in code points, score), by start.

    Base kinds (email, ip, card, phone) keep every span that holds, whatever its score. Kinds that the method adds (iban by its
    mod-97 checksum, ssn by words nearby) need a score of KEEP. Null and empty texts have none; repeated rows each give a
    row; an empty table gives none; other columns of ``docs`` are not looked at.
    """
    rows = C.pick(docs, "doc_id", "text").withColumn("text", C.whole())
    found = rows.select("doc_id", "text", *(_located(k, F.col("text")).alias(k) for k in KINDS))
    sure = {k: F.filter(k, lambda s: s["score"] >= KEEP) for k in KINDS if k not in BASE}
    return found.select("doc_id", "text", *BASE, *(c.alias(k) for k, c in sure.items()))


def redacted(docs: DataFrame) -> DataFrame:
    """doc_id and the text with each span replaced by its kind in brackets; of spans that overlap the earliest, then longest, goes."""
    found = personal(docs)
    spans = F.sort_array(F.transform(F.concat(*KINDS), lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["kind"].alias("kind"))))
    out = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda a, s: F.when(s["start"] < a["at"], a).otherwise(
            F.struct(
                (-s["minus_end"]).alias("at"),
                F.concat(a["out"], F.array(F.substr("text", a["at"] + 1, s["start"] - a["at"]), F.concat(F.lit("["), s["kind"], F.lit("]")))).alias("out"),
            )
        ),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substr("text", a["at"] + 1, F.length("text"))),
    )
    return found.select("doc_id", out.alias("text"))


def listed(*kinds: str) -> Column:
    return F.array_join(F.transform(F.concat(*kinds), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal(C.documents(spark, sf_dir))
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(listed(*BASE).cast("binary"), 256).alias("base_sha256"),
        listed(*KINDS).alias("spans"),
    )


#: Text between matches and the matches in turn give each match its place.
OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
 k(rank, kind, pattern) AS (VALUES (0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'), (1, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
  (2, 'card', '[0-9]([\x20-]?[0-9])+'), (3, 'phone', '\+[0-9][\x20().0-9-]+[0-9]'),
  (4, 'iban', '\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b'), (5, 'ssn', '[0-9]{3}-[0-9]{2}-[0-9]{4}')),
 m AS (SELECT r, rank, kind, t, regexp_extract_all(t, pattern) AS hits, string_split_regex(t, pattern) AS gaps FROM d, k),
 s AS (SELECT r, rank, kind, t, generate_subscripts(hits, 1) AS i, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap FROM m WHERE len(hits) > 0),
 p AS (SELECT *, regexp_replace(hit, '[^0-9]', '', 'g') AS digits, sum(length(gap) + length(hit)) OVER (PARTITION BY r, rank ORDER BY i) AS e FROM s),
 q AS (SELECT r, rank, kind, hit, digits, CAST(e - length(hit) AS BIGINT) AS a, CAST(e AS BIGINT) AS z, substr(t, CAST(e - length(hit) AS BIGINT), 1) AS before,
   substr(t, CAST(e + 1 AS BIGINT), 1) AS after, gap[-40:] AS near,
   list_sum(list_transform(range(length(digits)), lambda j: CASE WHEN j % 2 = 0 THEN CAST(substr(digits, length(digits) - j, 1) AS INT)
    ELSE CAST(substr(digits, length(digits) - j, 1) AS INT) * 2 - CASE WHEN substr(digits, length(digits) - j, 1) >= '5' THEN 9 ELSE 0 END END)) AS luhn FROM p),
 f AS (SELECT * FROM q WHERE CASE kind WHEN 'ip' THEN len(list_filter(string_split(hit, '.'), lambda x: length(ltrim(x, '0')) > 3 OR CAST('0' || right(ltrim(x, '0'), 3) AS INT) > 255)) = 0
   WHEN 'card' THEN length(digits) BETWEEN 13 AND 19 AND luhn % 10 = 0 WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
   WHEN 'iban' THEN 0.9 - CASE WHEN regexp_matches(near, '(?i)version|invoice|order no|example|sample|serial') THEN 0.35 ELSE 0 END
     + CASE WHEN regexp_matches(near, '(?i)iban|bank|account|konto') THEN 0.35 ELSE 0 END >= 0.6 AND
    list_reduce(list_prepend(0, list_transform(string_split(array_to_string(list_transform(string_split(substr(replace(hit, ' ', ''), 5) || substr(replace(hit, ' ', ''), 1, 4), ''),
     lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE CAST(ascii(c) - 55 AS VARCHAR) END), ''), ''), lambda c: CAST(c AS INT))), lambda x, y: (x * 10 + y) % 97) = 1
   WHEN 'ssn' THEN NOT regexp_matches(before, '[0-9-]') AND NOT regexp_matches(after, '[0-9-]') AND NOT regexp_matches(hit, '^(?:000|666|9)|-00-|-0000$')
    AND regexp_matches(near, '(?i)\bssn\b|social security') AND NOT regexp_matches(near, '(?i)version|invoice|order no|example|sample|serial') ELSE true END),
 g AS (SELECT r, count(*) FILTER (WHERE rank = 0) AS n_email, count(*) FILTER (WHERE rank = 1) AS n_ip, count(*) FILTER (WHERE rank = 2) AS n_card, count(*) FILTER (WHERE rank = 3) AS n_phone,
  string_agg(kind || ':' || a || ':' || z, ',' ORDER BY rank, a) FILTER (WHERE rank < 4) AS base, string_agg(kind || ':' || a || ':' || z, ',' ORDER BY rank, a) AS spans FROM f GROUP BY r)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256,
 coalesce(spans, '') AS spans FROM d LEFT JOIN g ON g.r = d.r
"""

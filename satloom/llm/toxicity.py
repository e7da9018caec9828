"""Toxicity by a weighted finite-state grammar of clauses.

Five transducers are composed. Two, for insults and threats, read words along the paths of learned phrases and write a cue where a
phrase ends, or else the word's class. Three mark the cues: as negated by a word shortly before, as reported by a word anywhere in the
clause, as aimed at a target nearby; the latter two in a pass from each end of the clause. What comes out of a clause, the set of
its marked cues, has a weight: the joint trust in its phrases times the factor of its kind (which cues with which marks). The
clauses of a document add up as independent causes do, and a monotone curve turns the sum into a score. Phrases, factors and
curve are learned from labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satloom.llm import common as C

#: Word classes; OTHER is any word without a class.
OTHER, TARGET, NEGATION, REPORT, INSULT, THREAT = range(6)
#: Marks of a cue, as bits.
NEGATED, REPORTED, AIMED = 1, 2, 4

#: Cues that are sent to every task at most; more of them are joined by a shuffle.
MAX_SENT = 200_000

#: Where learning starts from; fixed values.
SEEDS: dict[int, str] = {
    TARGET: "you your yours yourself u ur he she they them him her people du dich dir ihr euch tu te toi vous él ella tú ti usted ustedes",
    NEGATION: "not never no isn aren wasn don doesn didn cannot nor without nicht kein keine nie pas jamais aucun nunca jamás ningún",
    REPORT: "said says saying wrote writes reported quoted quote called alleged claims sagte schrieb zitiert dit écrit dijo escribió",
    INSULT: "idiot moron stupid loser scum pathetic worthless disgusting idiota imbécile connard arschloch dummkopf estúpido imbécil",
    THREAT: "kill hurt destroy shoot stab beat töten verletzen tuer frapper matar golpear",
}
#: Words, and what ends a clause; the JVM and Python read it alike.
TOKENS = r"\p{L}+|[.!?;:\n]"
TOKEN = regex.compile(TOKENS)
ENDS = set(".!?;:\n")


@dataclass(frozen=True)
class Learning:
    """rows: labelled rows that are learned from at most, those of lowest hash; support: toxic rows, and distinct surroundings (the
    words before and after) in them, that a phrase needs; precision: share of a phrase's rows that are toxic. Words come first; then
    stems (word beginnings of these lengths) and pairs of words, of words that are no cues by themselves.
    """

    rows: int = 20_000
    support: int = 6
    precision: float = 0.9
    stems: tuple[int, ...] = (4, 5, 6, 7)
    seed: int = 41


class Phrases:
    """A transducer from words to cues: the paths of ``trusts`` (phrases, words with spaces between; a stem ends in ``~``).

    A state is the longest end of the words read that begins a phrase. ``step`` gives the next one and, where phrases end, the
    longest of them with its trust.
    """

    def __init__(self, trusts: dict[str, float], stems: tuple[int, ...] = ()) -> None:
        self.stems = tuple(sorted(stems, reverse=True))
        self.trusts = trusts
        paths = [tuple(p.split(" ")) for p in trusts]
        self.begun = {p[:n] for p in paths for n in range(len(p) + 1)}
        self.known: dict[tuple[tuple[str, ...], str], tuple[tuple[str, ...], str | None]] = {}
        #: Words without which no phrase ends, and stems likewise.
        self.last = {p[-1] for p in paths if not p[-1].endswith("~")}
        self.stemmed = {p[0] for p in paths if p[-1].endswith("~")}

    def step(self, state: tuple[str, ...], word: str) -> tuple[tuple[str, ...], str | None]:
        move = self.known.get((state, word))
        if move is None:
            read = (*state, word)
            cue = next((" ".join(read[i:]) for i in range(len(read)) if " ".join(read[i:]) in self.trusts), None)
            if cue is None:
                cue = next((word[:n] + "~" for n in self.stems if len(word) >= n and word[:n] + "~" in self.trusts), None)
            rest = next(read[i:] for i in range(len(read) + 1) if read[i:] in self.begun)
            move = rest, cue
            # Only moves along paths are kept: their number is that of the phrases' words.
            if rest or cue:
                self.known[state, word] = move
        return move


@dataclass(frozen=True)
class Transducer:
    """next[state][symbol] and out[state][symbol], for symbols that are (class, marks) in one number; it starts in state 0."""

    next: list[list[int]]
    out: list[list[int]]


def symbol(cls: int, marks: int = 0) -> int:
    return cls * 8 + marks


SYMBOLS = 6 * 8


def marking(trigger: int, mark: int, reach: int | None) -> Transducer:
    """Marks cues after a word of class ``trigger``, within ``reach`` words or (None) to the clause's end."""
    states = 2 if reach is None else reach + 1
    nxt, out = [], []
    for s in range(states):
        to, put = [], []
        for x in range(SYMBOLS):
            cls, marks = divmod(x, 8)
            on = s > 0
            put.append(symbol(cls, marks | mark) if on and cls in (INSULT, THREAT) else x)
            to.append(states - 1 if cls == trigger else s if reach is None else max(0, s - 1))
        nxt.append(to)
        out.append(put)
    return Transducer(nxt, out)


def composed(a: Transducer, b: Transducer) -> Transducer:
    """What ``b`` makes of the output of ``a``, as one transducer over pairs of states that can be reached."""
    number, pairs = {(0, 0): 0}, [(0, 0)]
    nxt, out = [], []
    for p, q in pairs:
        to, put = [], []
        for x in range(SYMBOLS):
            y = a.out[p][x]
            pair = (a.next[p][x], b.next[q][y])
            if pair not in number:
                number[pair] = len(pairs)
                pairs.append(pair)
            to.append(number[pair])
            put.append(b.out[q][y])
        nxt.append(to)
        out.append(put)
    return Transducer(nxt, out)


def onward() -> Transducer:
    """Marks by what stands before a cue."""
    return composed(composed(marking(NEGATION, NEGATED, 3), marking(REPORT, REPORTED, None)), marking(TARGET, AIMED, 4))


def backward() -> Transducer:
    """Marks by what stands behind a cue, for a clause read from its end."""
    return composed(marking(REPORT, REPORTED, None), marking(TARGET, AIMED, 4))


def run(machine: Transducer, symbols: Iterable[int]) -> list[int]:
    state, out = 0, []
    for x in symbols:
        out.append(machine.out[state][x])
        state = machine.next[state][x]
    return out


#: A marked cue: phrase, trust, symbol.
Cue = tuple[str, float, int]


#: Width and number of the steps of evidence that the curve is learned on.
STEP, STEPS = 0.5, 24


@dataclass(frozen=True)
class Model:
    """cues: trust in each insult, a word, a phrase or a stem written with ``~`` behind it; threats: likewise; marks: factor by class and
    marks; curve: the score at evidence 0 and in the middle of each step after it, rising; kinds: factor by the kind of a clause, where one
    is learned."""

    cues: dict[str, float]
    marks: dict[int, float]
    curve: list[float]
    stems: tuple[int, ...] = Learning.stems
    threats: dict[str, float] = field(default_factory=lambda: dict.fromkeys(SEEDS[THREAT].split(), 1.0))
    kinds: dict[tuple[int, ...], float] = field(default_factory=dict)
    classes: dict[str, int] = field(default_factory=lambda: {w: c for c, ws in SEEDS.items() for w in ws.split() if c < INSULT})

    def __post_init__(self) -> None:
        for name, value in (("insult", Phrases(self.cues, self.stems)), ("threat", Phrases(self.threats)), ("onward", onward()), ("backward", backward())):
            object.__setattr__(self, name, value)

    def clause(self, words: list[str]) -> list[Cue]:
        """The marked cues of a clause, in order."""
        insult, threat, symbols, cues = (), (), [], []
        for w in words:
            insult, cue = self.insult.step(insult, w)
            threat, other = self.threat.step(threat, w)
            cls = INSULT if cue else THREAT if other else self.classes.get(w, OTHER)
            symbols.append(symbol(cls))
            cues.append((cue, self.cues[cue]) if cue else (other, self.threats[other]) if other else None)
        marked = run(self.backward, reversed(run(self.onward, symbols)))[::-1]
        return [(*cue, y) for cue, y in zip(cues, marked, strict=True) if cue]

    def clauses(self, text: str) -> Iterator[list[Cue]]:
        """The clauses of ``text`` (lower case) that hold a cue; others are passed over by a look at their words."""
        words: list[str] = []
        hit = False
        for w in TOKEN.findall(text):
            if w in ENDS:
                if hit and (found := self.clause(words)):
                    yield found
                words, hit = [], False
            else:
                words.append(w)
                hit = hit or self.may_end(w)
        if hit and (found := self.clause(words)):
            yield found

    def may_end(self, word: str) -> bool:
        return word in self.insult.last or word in self.threat.last or any(word[:n] + "~" in self.insult.stemmed for n in self.stems)

    def found(self, text: str) -> list[Cue]:
        """The marked cues of ``text``, clause by clause."""
        return [cue for own in self.clauses(text.lower()) for cue in own]

    def said(self, text: str) -> list[tuple[tuple[int, ...], float]]:
        """Of each clause of ``text`` (lower case) that holds a cue its kind, and the joint trust in its phrases (what it repeats counts
        once); of clauses that say the same the first."""
        own = {frozenset((cue, y) for cue, _, y in c): c for c in self.clauses(text)}
        joint = lambda c: 1.0 - math.prod(1.0 - min(0.999, t) for t in {cue: t for cue, t, _ in c}.values())
        return [(tuple(sorted({y for _, _, y in c})), joint(c)) for c in own.values()]

    def factor(self, kind: tuple[int, ...]) -> float:
        return self.kinds.get(kind, max(self.marks.get(y, 0.5) for y in kind))

    def total(self, said: list[tuple[tuple[int, ...], float]]) -> float:
        """The evidence of clauses; 0 if there is none."""
        return -math.fsum(math.log(1.0 - min(0.9999, trust * self.factor(kind))) for kind, trust in said)

    def evidence(self, text: str) -> float:
        return self.total(self.said(text))

    def score(self, text: str) -> float:
        return self.at(self.evidence(text.lower()))

    def at(self, e: float) -> float:
        """The curve at evidence ``e``."""
        if e <= 0:
            return self.curve[0]
        at = min(max(e / STEP + 0.5, 0.0), STEPS)
        low = int(at)
        high = min(low + 1, STEPS)
        return self.curve[low] + (self.curve[high] - self.curve[low]) * (at - low)


def step_of(evidence: float) -> int:
    return 0 if evidence <= 0 else min(STEPS, int(evidence / STEP) + 1)


def rising(pairs: list[tuple[float, float]]) -> list[float]:
    """The rising curve nearest to values with weights: neighbours that fall are pooled."""
    pools: list[list[float]] = []
    for value, weight in pairs:
        pools.append([value, weight, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v, w, k = pools.pop()
            last = pools[-1]
            pools[-1] = [(last[0] * last[1] + v * w) / (last[1] + w), last[1] + w, last[2] + k]
    return [v for v, _, k in pools for _ in range(int(k))]


def curve(counts: dict[int, tuple[int, int]]) -> list[float]:
    """From rows and toxic rows by step; a step without rows goes by the rule for independent causes."""
    pairs = []
    for i in range(STEPS + 1):
        n, t = counts.get(i, (0, 0))
        guess = 0.02 if i == 0 else 1 - math.exp(-STEP * (i - 0.5))
        pairs.append(((t + 2 * guess) / (n + 2), n + 2.0))
    return rising(pairs)


def default_marks() -> dict[int, float]:
    """Before anything is learned: an insult counts, less so negated or reported; a threat counts if aimed."""
    marks = {}
    for m in range(8):
        less = (0.5 if m & NEGATED else 1.0) * (0.6 if m & REPORTED else 1.0)
        marks[symbol(INSULT, m)] = less
        marks[symbol(THREAT, m)] = less * (0.6 if m & AIMED else 0.1)
    return marks


def tokens(lowered: Column) -> Column:
    return F.regexp_extract_all(lowered, F.lit(TOKENS), F.lit(0))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text divides by 5; a missing id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training(docs: DataFrame, labels: DataFrame, how: Learning) -> DataFrame:
    """(text in lower case, toxic) of at most ``how.rows`` labelled rows outside the held-out fifth."""
    known = C.pick(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64(F.lit(how.seed), "doc_id"), "doc_id").limit(how.rows)
    # Bounded by how.rows, and so sent whole to each task.
    return C.pick(docs, "doc_id", "text").select("doc_id", C.whole().alias("text")).join(F.broadcast(chosen), "doc_id").select(F.lower("text").alias("text"), "toxic")


def _supported(seen: DataFrame, clean: DataFrame, how: Learning) -> DataFrame:
    """cue and trust of the supported cues of ``seen`` (row, cue, around); what one text repeats counts once, and what copies of a text
    share too. ``clean``: (row, cue) of the cues in clean texts."""
    toxic = seen.groupBy("cue").agg(F.least(F.countDistinct("row"), F.countDistinct("around")).alias("t")).where(F.col("t") >= how.support)
    toxic = C.checkpointed(toxic)
    wanted = F.broadcast(toxic.select("cue")) if toxic.count() <= MAX_SENT else toxic.select("cue")
    against = clean.join(wanted, "cue", "left_semi").distinct().groupBy("cue").agg(F.count(F.lit(1)).alias("c"))
    ratio = F.col("t") / (F.col("t") + F.coalesce("c", F.lit(0)) + 0.05)
    return toxic.join(against, "cue", "left").select("cue", ratio.alias("trust"))


def _phrases(rows: DataFrame, how: Learning) -> tuple[dict[str, float], set[str]]:
    """Trust in the phrases that ``rows`` (text, toxic) support, and those seeds among all words that they refute.

    All of it is bounded by the number of rows and the support.
    """
    shifted = lambda by: F.slice("w", by + 1, F.greatest(F.size("w"), F.lit(1)))
    words = rows.select(F.monotonically_increasing_id().alias("row"), "toxic", tokens(F.col("text")).alias("w"))
    words = words.withColumns({"before": F.concat(F.array(F.lit(None).cast("string")), "w"), "after": shifted(1), "then": shifted(2)})
    words = words.select("row", "toxic", F.explode(F.arrays_zip("w", "before", "after", "then")).alias("x")).select("row", "toxic", "x.*")
    words = C.stored(words.where(~F.col("w").isin(*ENDS)), f"{C.shared_dir(rows.sparkSession)}/words")

    def trusted(seen: DataFrame, *found: tuple[Column, Column]) -> DataFrame:
        both = F.explode(F.array(*(F.struct(cue.alias("cue"), around.alias("around")) for cue, around in found)))
        own = seen.select("row", "toxic", both.alias("x")).select("row", "toxic", "x.*").where("cue IS NOT NULL")
        return _supported(own.where("toxic = 1"), own.where("toxic = 0").select("row", "cue"), how)

    near = F.xxhash64("before", "after")
    whole = C.checkpointed(trusted(words, (F.col("w"), near)))
    sure = F.col("trust") >= how.precision
    alone = whole.where(sure).select("cue")
    alone = F.broadcast(alone) if alone.count() <= MAX_SENT else alone
    rest = words.join(alone, F.col("w") == F.col("cue"), "left_anti")
    # A pair whose second word is a cue by itself says no more than that.
    known = alone.select(F.col("cue").alias("known"))
    rest = rest.join(known, F.col("after") == F.col("known"), "left")
    second = F.when(F.col("known").isNull() & F.col("after").isNotNull() & ~F.col("after").isin(*ENDS), F.concat_ws(" ", "w", "after"))
    begun = [F.when(F.length("w") >= n, F.concat(F.substring("w", 1, n), F.lit("~"))) for n in how.stems]
    more = trusted(rest, *((stem, near) for stem in begun), (second, F.xxhash64("before", "then")))
    kept = whole.unionByName(more).where(sure).collect()
    refuted = whole.where(F.col("cue").isin(*SEEDS[INSULT].split()) & ~sure).collect()
    return {r["cue"]: float(r["trust"]) for r in kept}, {r["cue"] for r in refuted}


def learned(docs: DataFrame, labels: DataFrame, how: Learning = Learning()) -> Model:
    """The model that the labelled rows of ``docs`` give; without any, the seeds with their default weights."""
    rows = C.stored(training(docs, labels, how), f"{C.shared_dir(docs.sparkSession)}/training")
    phrases, refuted = _phrases(rows, how)
    threatening = set(SEEDS[THREAT].split())
    # A pair with a threat in it is a path of the threats.
    threats = dict.fromkeys(sorted(threatening), 1.0) | {p: t for p, t in sorted(phrases.items()) if " " in p and threatening & set(p.split(" "))}
    cues = dict.fromkeys(sorted(set(SEEDS[INSULT].split()) - refuted), 0.6) | {p: t for p, t in sorted(phrases.items()) if p not in threats}
    model = Model(cues, default_marks(), curve({}), how.stems, threats)

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own in batches:
            found = [[(" ".join(map(str, kind)), trust) for kind, trust in model.said(t)] for t in own["text"]]
            yield pd.DataFrame({"kinds": [[k for k, _ in x] for x in found], "trusts": [[t for _, t in x] for x in found], "toxic": own["toxic"]})

    # At most how.rows rows.
    seen = rows.mapInPandas(read, "kinds array<string>, trusts array<double>, toxic int").collect()
    said = [([(tuple(map(int, k.split())), t) for k, t in zip(r["kinds"], r["trusts"], strict=True)], int(r["toxic"])) for r in seen]
    # Rows with clauses of one kind tell what that is worth.
    one = [(own[0][0], toxic) for own, toxic in said if len({k for k, _ in own}) == 1]
    factors = {}
    for kind in {k for k, _ in one}:
        mine = [toxic for k, toxic in one if k == kind]
        factors[kind] = (sum(mine) + 4 * max(model.marks[y] for y in kind)) / (len(mine) + 4)
    weighed = Model(cues, model.marks, model.curve, how.stems, threats, factors)
    counts: dict[int, tuple[int, int]] = {}
    for own, toxic in said:
        step = step_of(weighed.total(own))
        n, t = counts.get(step, (0, 0))
        counts[step] = (n + 1, t + toxic)
    return Model(cues, model.marks, curve(counts), how.stems, threats, factors)


def may_hold(lowered: Column, model: Model) -> Column:
    """Whether a text (lower case) holds a word without which no clause of it can hold a cue."""
    words = tokens(lowered)
    found = F.arrays_overlap(words, F.lit(sorted(model.insult.last | model.threat.last)))
    if model.insult.stemmed:
        begun = lambda w: F.coalesce(F.arrays_overlap(F.array(*(F.concat(F.substring(w, 1, n), F.lit("~")) for n in model.stems)), F.lit(sorted(model.insult.stemmed))), F.lit(False))
        found = found | F.exists(words, begun)
    return found


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted (score of 0.5 or more) of each row; null and empty texts score as texts without cues.

    Repeated rows each give a row, an empty table none; of ``docs`` only text enters the score. Only texts that hold a word of some phrase
    are read in Python; the others have no evidence.
    """
    rows = C.pick(docs, "doc_id", "text").select("doc_id", F.lower(C.whole()).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select("doc_id", F.when(may_hold(F.col("text"), model), F.col("text")).otherwise("").alias("text"))

    def scores(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own in batches:
            yield pd.DataFrame({"doc_id": own["doc_id"], "score": [model.at(model.evidence(t)) if t else model.curve[0] for t in own["text"]]})

    # A missing doc_id must not turn the others into floats on the way.
    out = rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(scores, "doc_id string, score double")
    return out.select(F.col("doc_id").cast(id_type).alias("doc_id"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir)
    found = scored(docs, learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

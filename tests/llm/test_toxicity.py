import random
import re
import zlib

from satloom.llm import common as C
from satloom.llm import toxicity as T

AT = "/root/testdata/sf0.1"


def model(**cues):
    return T.Model({"idiot": 0.9, "trash": 0.9, "lowei~": 0.9, **cues}, T.default_marks(), T.curve({}))


def marks(text):
    return [(w, y % 8, y // 8) for w, _, y in model().found(text)]


def test_composed_transducers_mark_cues():
    assert marks("What an idiot.") == [("idiot", 0, T.INSULT)]
    assert marks("you are not an idiot") == [("idiot", T.NEGATED | T.AIMED, T.INSULT)]
    assert marks("not a b c idiot") == [("idiot", 0, T.INSULT)]
    assert marks("She said a b c d e f idiot. Then trash!") == [("idiot", T.REPORTED, T.INSULT), ("trash", 0, T.INSULT)]
    assert marks("I will kill you; they kill time") == [("kill", T.AIMED, T.THREAT), ("kill", T.AIMED, T.THREAT)]
    assert marks('"idiot", he said. An idiot a b c d you') == [("idiot", T.REPORTED | T.AIMED, T.INSULT), ("idiot", 0, T.INSULT)]
    assert marks("LOWEIschaft a,idiot") == [("lowei~", 0, T.INSULT), ("idiot", 0, T.INSULT)]


def test_scores_follow_the_clause():
    m = model()
    assert m.score("you idiot") > m.score("you are no idiot") > m.score("a calm text") == m.score("")
    assert m.score("they said he is an idiot") < m.score("he is an idiot")
    assert 0 <= m.score("idiot trash " * 1000) <= 1 and m.score("idiot trash") > m.score("idiot")
    assert m.score("idiot " * 50) == m.score("idiot")


WORDS = ["you", "not", "said", "idiot", "trash", "kill", "waste", "of", "space", "loweia", "a", "b", "c", ".", "\n", "time"]


def brute(model, text):
    """The grammar said outright: phrases that end at a word, longest first; marks by words near, or in the clause."""
    out = []
    for part in re.split(r"[.!?;:\n]", text):
        words = re.findall(r"[a-z]+", part)
        cls, cue = [], []
        for i in range(len(words)):
            ends = [" ".join(words[j : i + 1]) for j in range(i + 1)]
            insult = next((e for e in ends if e in model.cues), None) or next((words[i][:n] + "~" for n in (7, 6, 5, 4) if words[i][:n] + "~" in model.cues), None)
            threat = next((e for e in ends if e in model.threats), None)
            cls.append(T.INSULT if insult else T.THREAT if threat else model.classes.get(words[i], T.OTHER))
            cue.append(insult or threat)
        for i, c in enumerate(cls):
            if c >= T.INSULT:
                near = lambda kind, a, z: kind in cls[max(0, i - a) : i] + cls[i + 1 : i + 1 + z]  # noqa: B023, E731
                m = T.NEGATED * near(T.NEGATION, 3, 0) + T.REPORTED * near(T.REPORT, 99, 99) + T.AIMED * near(T.TARGET, 4, 4)
                out.append((cue[i], T.symbol(c, m)))
    return out


def test_grammar_against_its_definition():
    rng = random.Random(6)
    m = T.Model({"idiot": 0.9, "trash": 0.8, "waste of space": 0.9, "space trash": 0.7, "lowei~": 0.9}, T.default_marks(), T.curve({}), threats={"kill": 1.0, "kill time": 0.5, "of a": 0.5})
    for _ in range(4000):
        text = " ".join(rng.choices(WORDS, k=rng.randint(0, 14)))
        assert [(c, y) for c, _, y in m.found(text)] == brute(m, text), text


def test_texts_that_are_not_read_hold_no_cue(spark):
    rng = random.Random(7)
    m = T.Model({"idiot": 0.9, "waste of space": 0.9, "lowei~": 0.9}, T.default_marks(), T.curve({}), threats={"kill time": 0.5})
    texts = [" ".join(rng.choices([*WORDS, "Idiot", "LOWEIé", "Éa²idiot"], k=rng.randint(0, 5))) for _ in range(500)]
    rows = T.scored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), m).collect()
    assert {r["doc_id"]: r["score"] for r in rows} == {i: m.score(t) for i, t in enumerate(texts)}


def test_pairs_of_words_are_learned(spark):
    fill = "alpha beta gamma delta epsilon zeta eta theta".split()
    rows = [(i, f"{fill[i % 8]} dirty swine {fill[i * 3 % 7]} word", 1) for i in range(30)] + [(i, f"dirty {fill[i % 8]} and swine", 0) for i in range(30, 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    m = T.learned(docs.drop("toxic"), docs.drop("text"))
    assert "dirty swine" in m.cues and not {"dirty", "swine"} & set(m.cues)
    assert m.score("you dirty swine") > 0.5 > m.score("a dirty and a swine")


def test_rising_curve():
    assert T.rising([(0.1, 1), (0.5, 1), (0.3, 1), (0.9, 2)]) == [0.1, 0.4, 0.4, 0.9]
    assert T.curve({}) == sorted(T.curve({}))


def test_held_out_accuracy(spark):
    rows = T.op4(spark, AT).collect()
    assert len(rows) == C.documents(spark, AT).count()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{AT}/labels.parquet").collect()}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    hit = sum(a and b for a, b in held)
    assert hit / sum(a for a, _ in held) > 0.85 and hit / sum(b for _, b in held) > 0.95


def test_odd_and_empty_tables(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    seeds = T.learned(odd, none)
    rows = T.scored(odd, seeds).collect()
    assert len(rows) == odd.count() and not any(r["predicted"] for r in rows)
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in odd.collect()}
    assert T.scored(empty, T.learned(empty, none)).count() == 0
    few = spark.createDataFrame([(4, 1), (4, None), (None, 1), (77, 1)], "doc_id long, toxic int")
    assert T.scored(odd, T.learned(odd, few)).count() == odd.count()

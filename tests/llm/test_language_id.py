import random
import re

import pytest
from pyspark.sql import functions as F

from recordweave.llm import language_id as lang

SAMPLE = lang.Sample(("en", "fr"), ("the cat sat on the mat and the hat", "le chat est sur le tapis et la natte"))


def parse(text, labelled):
    clean = lambda t: re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in t.lower()))
    text, labelled, phrases = clean(text).lstrip(" "), clean(labelled).lstrip(" "), 0
    for at in range(0, len(text), lang.PIECE):
        phrase, phrases = "", phrases + 1
        for c in text[at : at + lang.PIECE]:
            if phrase + c in labelled:
                phrase += c
            else:
                phrases, phrase = phrases + 1, c if c in labelled else ""
    return phrases


def test_phrases_equal_brute_force():
    random.seed(3)
    model = lang.Model(SAMPLE)
    texts = ["".join(random.choice("thecasonlip tè.Q") for _ in range(n)) for n in [0, 1, 5, 40, 700, 1500] * 20]
    found, _, _ = model.phrases(texts)
    assert found.tolist() == [[parse(t, s) for s in SAMPLE.texts] for t in texts]


def test_automaton_knows_exactly_the_substrings():
    word = "abcbcabccab"
    moves = lang.suffix_automaton([ord(c) for c in word])

    def known(part):
        state = 0
        for c in part:
            if ord(c) not in moves[state]:
                return False
            state = moves[state][ord(c)]
        return True

    random.seed(1)
    for _ in range(500):
        part = "".join(random.choice("abc") for _ in range(random.randint(1, 6)))
        assert known(part) == (part in word)


def many_letters(rng, n):
    """Text of a language with about 3,000 letters, in words of one to three."""
    words = ["".join(chr(0x4E00 + int(3000 * rng.random() ** 2)) for _ in range(rng.randint(1, 3))) for _ in range(4000)]

    def text(size):
        out = ""
        while len(out) < size:
            out += words[int(len(words) * rng.random() ** 2)]
        return out[:size]

    return [text(n_) for n_ in n]


def test_phrases_of_letters_without_a_column_equal_brute_force(monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(lang, "COLUMNS", 5)
    model = lang.Model(SAMPLE)
    texts = ["".join(rng.choice("thecasonlip tè.Q") for _ in range(n)) for n in [0, 1, 5, 40, 700, 1500] * 5]
    assert model.phrases(texts)[0].tolist() == [[parse(t, s) for s in SAMPLE.texts] for t in texts]
    monkeypatch.undo()
    known, *texts = many_letters(rng, [3000, 10, 200, 900])
    assert len(set(known)) > 400
    sample = lang.Sample(("en", "zh"), (SAMPLE.texts[0], known))
    assert lang.Model(sample).phrases(texts)[0].tolist() == [[parse(t, s) for s in sample.texts] for t in texts]


def test_a_language_of_thousands_of_letters_is_kept_and_its_gibberish_is_not():
    rng = random.Random(5)
    known, *texts = many_letters(rng, [32000] + [300] * 60)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 8))) for _ in range(500)]
    latin = " ".join(rng.choice(words) for _ in range(6000))[:32000]
    limits = (lang._limit(latin, []), lang._limit(known, texts[:30]))
    model = lang.Model(lang.Sample(("en", "zh"), (latin, known), limits))
    names, _, _, rejected = lang.predict(model, texts[30:])
    assert set(names) == {"zh"} and not any(rejected)
    strange = "".join(rng.choice("qxzjkvwy") for _ in range(500)), "".join(chr(0x4E00 + rng.randrange(20000)) for _ in range(500))
    assert lang.predict(model, list(strange))[3] == [True, True]
    assert limits[0] == lang.MAX_BITS < limits[1] < 15


def test_edge_texts():
    names, scores, _, rejected = lang.predict(lang.Model(SAMPLE), ["", "12 34 ###", "the hat", "中文", "the cat " * 5000])
    assert names[:3] == ["und", "und", "en"] and names[4] == "en"
    assert rejected[:2] == [True, True] and not rejected[2] and not rejected[4]
    assert all(0 <= s <= 1 for s in scores) and scores[0] == 0


def test_long_gibberish_is_rejected():
    random.seed(2)
    text = "".join(random.choice("qxzjkvwy") for _ in range(500))
    assert lang.predict(lang.Model(SAMPLE), [text])[3] == [True]


def test_nothing_learned(edge):
    found = lang.identify(edge, lang.Sample((), ())).collect()
    assert {r.lang_pred for r in found} == {"und"} and len(found) == 10


def test_rows(edge, docs_of):
    found = lang.identify(edge, SAMPLE).collect()
    assert len(found) == 10
    assert {r.lang_pred for r in found if r.doc_id in (3, 4, 5, 9)} == {"und"}
    kept = lang.keep_identified(edge, SAMPLE)
    assert kept.columns == edge.columns
    assert {3, 4, 5, 9}.isdisjoint({r.doc_id for r in kept.collect()})
    assert lang.identify(docs_of([]), SAMPLE).count() == 0
    assert lang.learn(docs_of([]), F.lit(True)) == lang.Sample((), ())


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(documents):
    sample = lang.learn(documents, ~lang.held_out())
    known = documents.where(lang.held_out()).select("doc_id", "lang")
    scored = lang.identify(documents, sample).join(known, "doc_id").where("lang_pred <> 'und'")
    assert scored.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_held_out_rows_have_no_part_in_learning(documents):
    changed = documents.withColumn("lang", F.when(lang.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert lang.learn(changed, ~lang.held_out()) == lang.learn(documents, ~lang.held_out())


def test_every_label_is_learned_however_many_there_are(spark):
    rng = random.Random(4)
    words = [["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(10)] for _ in range(300)]
    made = [(10 * i + j, " ".join(rng.choices(words[i], k=40)), f"l{i:03d}") for i in range(300) for j in range(4)]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string")
    sample = lang.learn(docs, F.col("doc_id") % 10 < 3)
    assert sample.names == tuple(f"l{i:03d}" for i in range(300))
    rest = docs.where("doc_id % 10 = 3")
    got = {r.doc_id: r.lang_pred for r in lang.identify(rest, sample).collect()}
    assert got == {10 * i + 3: f"l{i:03d}" for i in range(300)}

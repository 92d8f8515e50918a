import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordweave.llm import robust_outliers as robust
from tests.llm.conftest import EDGE

WORD = re.compile("[^\x20\x09-\x0d]+")


def counts(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {j for places in windows.values() if len(places) > 1 for i in places for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(spark):
    random.seed(1)
    letters = ["a", "b", "c", " ", "  ", "\n", "\t", "\x0b", "#", "$", "é", "😀", "\x1c", "\x85", "　", "\r", "\\", "|"]
    texts = [None, "", " ", "a", "a a a", "a a a a", "a b c a b c"]
    texts += ["".join(random.choice(letters) for _ in range(random.randint(0, 60))) for _ in range(300)]
    texts += [" ".join(random.choice("abcd") for _ in range(random.randint(0, 40))) for _ in range(200)]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    made = frame.select("n", *[c.alias(n) for n, c in robust.text_counts(F.col("text")).items()]).collect()
    for r in made:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(texts[r.n])


def test_chi_square():
    assert robust.chi_square_quantile(0.95, 1) == pytest.approx(3.841459, abs=1e-5)
    assert robust.chi_square_quantile(0.975, 4) == pytest.approx(11.143287, abs=1e-5)
    assert robust.chi_square_below(2 * np.log(2), 2) == pytest.approx(0.5)


def vectors_of(spark, rows):
    names = ", ".join(f"{s} bigint" for s in robust.STATISTICS)
    return spark.createDataFrame([(g, "s", *map(int, r)) for g, r in rows], f"lang string, source string, {names}")


def test_estimate_resists_a_quarter_of_outliers(spark):
    rng = np.random.default_rng(2)
    shape = np.array([[60, 0, 0, 0], [30, 90, 0, 0], [0, 20, 80, 0], [10, 0, 0, 70]])
    good = 400 + rng.normal(size=(3000, 4)) @ shape.T
    bad = 4000 + rng.normal(size=(900, 4)) * 20
    frame = vectors_of(spark, [("en", r) for r in np.concatenate([good, bad])])
    row = robust.estimates(frame).where("level = 2").first()
    mean = np.array([row[f"m{i}"] for i in range(4)]) * robust.UNIT
    factor = np.array([[row[f"l{i}{j}"] if j <= i else 0 for j in range(4)] for i in range(4)])
    covariance = factor @ factor.T * robust.UNIT**2
    assert np.abs(mean - good.mean(axis=0)).max() < 12
    floors = np.diag(np.square(robust.FLOORS)) * robust.UNIT**2
    assert np.allclose(covariance - floors, np.cov(good.T), rtol=0.25, atol=900)


def test_equals_concentration_steps_in_numpy(spark):
    """The support holds the nearest rows of a fixed point: one more exact step leaves the determinant nearly unchanged."""
    rng = np.random.default_rng(3)
    points = np.round(np.concatenate([rng.normal(300, 60, (2000, 4)), rng.normal(1500, 30, (300, 4))]))
    frame = vectors_of(spark, [("en", r) for r in points])
    row = robust.estimates(frame).where("level = 2").first()
    x = points / robust.UNIT
    mean, floors = np.median(x, axis=0), np.diag(np.square(robust.FLOORS))
    covariance = np.diag((1.4826 * np.median(np.abs(x - mean), axis=0)) ** 2) + floors
    for _ in range(30):
        far = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(covariance), x - mean)
        near = x[np.argsort(far)[: int(np.ceil(robust.SUPPORT * len(x)))]]
        mean, covariance = near.mean(axis=0), np.cov(near.T, bias=True) + floors
    inside = robust.chi_square_quantile(robust.SUPPORT, 4)
    scale = robust.SUPPORT / robust.chi_square_below(inside, 6)
    far = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(covariance), x - mean)
    kept = x[far <= robust.chi_square_quantile(0.975, 4) * scale]
    assert np.allclose([row[f"m{i}"] for i in range(4)], kept.mean(axis=0), atol=0.01)


def test_symbol_texts_are_rejected_and_prose_is_kept(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    prose = [" ".join(rng.choice(words) for _ in range(rng.randint(60, 200))) for _ in range(400)]
    junk = [" ".join(rng.choice(words) + "$$$###" for _ in range(80)) for _ in range(20)]
    rows = [(i, t, "en", "web") for i, t in enumerate(prose + junk)]
    found = {r.doc_id: r for r in robust.quality(spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")).collect()}
    assert all(found[i].kept for i in range(400))
    assert not any(found[i].kept for i in range(400, 420))
    assert {r.level for r in found.values()} == {2}


def test_each_statistic_rejects_alone(spark):
    """Texts that stand out in symbols, repeated lines or repeated words only, with words of usual length."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(3000)]

    def lines(n):
        return [" ".join(rng.sample(words, 2)) for _ in range(n)]

    prose = ["\n".join(lines(rng.randint(30, 100))) for _ in range(400)]
    symbols = ["".join(rng.choice("#$|") if c.isalpha() and rng.random() < 0.15 else c for c in "\n".join(lines(60))) for _ in range(10)]
    repeated_lines = []
    for _ in range(10):
        some = lines(40)
        some += some[:25]
        rng.shuffle(some)
        repeated_lines.append("\n".join(some))
    repeats = []
    for _ in range(10):
        phrase = " ".join(rng.sample(words, 12))
        repeats.append(f"{phrase} " + " ".join(rng.sample(words, 40)) + f" {phrase} " + " ".join(rng.sample(words, 40)) + f" {phrase}")
    texts = prose + symbols + repeated_lines + repeats
    frame = spark.createDataFrame([(i, t, "en", "web") for i, t in enumerate(texts)], "doc_id int, text string, lang string, source string")
    found = {r.doc_id: r for r in robust.quality(frame).collect()}
    assert sum(found[i].kept for i in range(400)) >= 398
    assert not any(r.base_failed for r in found.values())
    assert [i for i in range(400, 430) if found[i].kept] == []


def test_edge_rows(edge, docs_of):
    rows = robust.quality(edge).collect()
    assert len(rows) == 10 and all(r.base_failed and not r.kept and r.level is None for r in rows)
    texts = dict(EDGE[2:])
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(texts[r.doc_id])
    assert robust.quality(docs_of([])).count() == 0


def test_null_groups_and_lost_estimates(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"{text} {i}", None, None) for i in range(250)] + [(999, text, "xx", "small")]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    found = {r.doc_id: r for r in robust.quality(frame).collect()}
    assert found[0].level == 2 and found[999].level == 0 and found[999].kept


def test_no_python_in_the_plan(edge, capsys):
    robust.quality(edge).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)

import random
import re
from collections import Counter

import pytest

from recordweave.llm import chunks, collocations
from tests.llm.conftest import EDGE


def brute(rows, least, most=5, top=2000):
    """Rows of (text, lang) counted phrase by phrase."""
    counts, spoken = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            spoken[lang] += len(words)
            for size in range(1, most + 1):
                for i in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        chosen = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in chosen.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: B023, E731
            if any(len(q) > len(p) and b >= a and inside(q) for q, b in chosen.items()):
                continue
            cuts = [(1000 * a * spoken[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, cut, left, right = min(cuts)
            found.append((score, a, " ".join(p), left, right, cut))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i, p, a, left, right, spoken[lang], s, cut) for i, (s, a, p, left, right, cut) in enumerate(found[:top], 1)]
    return sorted(out)


def corpus(seed, size):
    rng = random.Random(seed)
    fixed = [["New", "york", "City"], ["a", "a", "a"], ["ça", "va", "bien", "merci", "Élan"], ["x", "y"], ["one", "two", "three", "four", "five", "six"]]
    texts = []
    for i in range(size):
        words = []
        while len(words) < rng.randrange(0, 60):
            words += rng.choice(fixed) if rng.random() < 0.4 else [rng.choice("abcdefghij") * rng.randrange(1, 3)]
            if rng.random() < 0.15:
                words[-1] += rng.choice([".", ",", ";", ":", "!", "?", "\n", "\r\n", "\x0b", "\x0c", " .", "...", "\t"])
        texts.append((rng.choice([" ", "  ", "\t"]).join(words) if rng.random() > 0.03 else None, rng.choice(["en", "en", "en", "de", None])))
    return texts


@pytest.fixture
def frame(spark):
    def make(rows):
        return spark.createDataFrame([(t, la, "x", 1, "p", 2) for t, la in rows], "text string, lang string, prefix string, total int, word string, n int")

    return make


@pytest.mark.parametrize(("seed", "least", "top", "most"), [(1, 20, 2000, 5), (2, 5, 2000, 5), (3, 3, 17, 4), (4, 1, 2000, 2), (5, 2, 30, 3)])
def test_phrases_equal_brute_force(frame, monkeypatch, seed, least, top, most):
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(chunks, "BUCKET_GRAMS", 300)
    rows = corpus(seed, 150)
    found = collocations.collocations(frame(rows), least=least, top=top, most=most)
    assert sorted(map(tuple, found.collect())) == brute(rows, least, most, top)


def test_stripes_add_up(frame):
    rows = corpus(6, 100)
    held = collocations.stripe_elements(frame(rows), "text", "lang", 5, 5).collect()
    assert len({(r.lang, r.prefix, r.word) for r in held}) == len(held)
    sums, own = Counter(), {}
    for r in held:
        sums[r.lang, r.prefix] += r.times
        own[r.lang, f"{r.prefix} {r.word}".strip()] = r.times
    assert all(sums[key] <= own[key] for key in sums if key[1])
    spoken = {(r[0], r[6]) for r in brute(rows, 5)}
    assert spoken == {(lang, sums[lang, ""]) for lang, _ in spoken}


def test_scores_beyond_64_bits(spark, monkeypatch):
    """Counts of a very large corpus, put in place of merged stripes."""
    a, left, right, n = 3 * 10**11, 4 * 10**11, 5 * 10**11, 9 * 10**13
    rows = [("en", "", "p", left), ("en", "", "q", right), ("en", "", "", n - left - right), ("en", "p", "q", a)]
    table = spark.createDataFrame(rows, "lang string, prefix string, word string, times bigint")
    monkeypatch.setattr(collocations, "stripe_elements", lambda *_: table)
    found = collocations.collocations(spark.createDataFrame([], "text string, lang string")).collect()
    assert [tuple(r) for r in found] == [("en", 1, "p q", a, left, right, n, 1000 * a * n // (left * right), 1)]


def test_edge_rows(edge):
    rows = [(t, "en") for _, t in EDGE]
    assert sorted(map(tuple, collocations.collocations(edge, least=2).collect())) == brute(rows, 2)


def test_empty_table(docs_of):
    assert collocations.collocations(docs_of([])).count() == 0


def test_phrases_of_one_word_are_refused(docs_of):
    with pytest.raises(ValueError):
        collocations.collocations(docs_of([]), most=1)

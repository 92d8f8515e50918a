import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from recordweave.llm import periodic_runs as runs
from tests.llm.conftest import EDGE


def brute(words):
    """Every maximal stretch of a period, with the smallest period of those ends."""
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                best.setdefault((start, i + q), q)
    return sorted((s, e, q) for (s, e), q in best.items())


def row(doc_id, text, plant):
    words = [w for w in (text or b"").split()]
    n = len(words)
    if plant and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    top = max(found, key=lambda r: (Fraction(r[1] - r[0], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, e, q in found for i in range(s + q, e)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in found).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    first = (None,) * 4 if top is None else (top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2])
    return (doc_id, len(found), *first, sha(listed), sha(kept))


def sequence(rng, size, letters):
    """Random words with nested and neighbouring repeats in them."""
    out = []
    while len(out) < size:
        part = [rng.randrange(letters) for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 13, 30]))]
        if rng.random() < 0.5:
            part = (part * rng.randrange(2, 9))[: rng.randrange(1, 200)]
        if rng.random() < 0.3:
            part = part * rng.randrange(3, 7)
        if out and rng.random() < 0.2:
            part = out[-rng.randrange(1, 40) :] * rng.randrange(1, 5)
        out += part
    return out[:size]


@pytest.mark.parametrize("letters", [1, 2, 3, 10, 1000])
def test_runs_equal_brute_force(letters):
    rng = random.Random(letters)
    for _ in range(250):
        words = sequence(rng, rng.choice([0, 1, 5, 6, 7, 9, 20, 64, 100, 333]), letters)
        found = runs.find_runs(np.array(words, np.int64) + 1)
        assert [tuple(r) for r in found.tolist()] == brute(words)


def test_a_large_bound_takes_more_primes():
    rng = random.Random(3)
    names = [rng.randrange(1, 1 << 40) for _ in range(30)]
    words = [names[w] for w in sequence(rng, 500, 30)]
    assert [tuple(r) for r in runs.find_runs(np.array(words, np.int64)).tolist()] == brute(words)


@pytest.mark.parametrize("size", [1, 2, 8, 64])
def test_transform_equals_its_definition(size):
    rng = np.random.default_rng(size)
    for prime, root in runs.PRIMES:
        a, b = rng.integers(0, prime, (2, 3, size), dtype=np.uint64)
        want = [[sum(int(x[j]) * int(y[(j + d) % size]) for j in range(size)) % prime for d in range(size)] for x, y in zip(a, b)]
        assert runs.correlations(a, b, prime, root).tolist() == want


def test_rows_equal_brute_force():
    rng = random.Random(5)
    ids, texts = [None, 7, 8], [b"a a a a a a a", None, b" "]
    for doc_id in range(400):
        ids.append(doc_id)
        texts.append(" ".join(f"w{w}" for w in sequence(rng, rng.randrange(0, 120), 40)).encode())
    for plant in (False, True):
        assert runs.summaries(ids, texts, plant) == [row(i, t, plant) for i, t in zip(ids, texts, strict=True)]


def test_long_repetitive_text_is_not_quadratic():
    words = np.ones(300_000, np.int64)
    assert runs.find_runs(words).tolist() == [[0, 300_000, 1]]
    words = np.tile(np.arange(1, 50_001), 6)
    assert runs.find_runs(words).tolist() == [[0, 300_000, 50_000]]


def test_edge_rows(edge):
    got = [tuple(r) for r in runs.periodic_runs(edge, plant=True).collect()]
    want = [row(i, None if t is None else t.encode(), True) for i, t in EDGE]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(docs_of):
    assert runs.periodic_runs(docs_of([])).count() == 0

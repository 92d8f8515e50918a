import random
from collections import Counter

import numpy as np
import pytest

from recordweave.llm import decontaminate as dec


def similarity(a, b):
    k = min(5, len(a), len(b))
    grams = [Counter(tuple(x[i : i + k]) for i in range(len(x) - k + 1)) for x in (a, b)]
    return (grams[0] & grams[1]).total() / (grams[0] | grams[1]).total()


def brute(text, items):
    """Best similarity over all windows of an item's size, for every item."""
    words, found = dec.words_of(text), {}
    for item, said in items:
        wanted = dec.words_of(said)
        if not wanted or not words:
            continue
        size = min(len(wanted), len(words))
        windows = [words[i : i + size] for i in range(len(words) - size + 1)]
        if size < min(5, len(wanted)):
            continue
        best = max(similarity(w, wanted) for w in windows)
        if best >= 0.8:
            found[item] = best
    return found


def sentence(rng, size):
    return " ".join(rng.choice(VOCABULARY) for _ in range(size))


VOCABULARY = [f"w{i}" for i in range(40)]


def test_planted_windows_equal_brute_force():
    rng = random.Random(4)
    items = tuple((i, sentence(rng, rng.randint(3, 40))) for i in range(30))
    index = dec.Index(items)
    near = 0
    for _ in range(150):
        words = sentence(rng, rng.randint(0, 60)).split()
        _, said = rng.choice(items)
        passage = said.split()
        for _ in range(rng.randint(0, 2)):
            edit = rng.randrange(len(passage)) if rng.random() < 0.5 else rng.choice([0, len(passage) - 1])
            passage[edit] = rng.choice(VOCABULARY)
        at = rng.randint(0, len(words))
        text = " ".join(words[:at] + passage + words[at:]).upper()
        found = {item: sim for item, _, _, _, sim in index.search(text)}
        wanted = brute(text, items)
        assert found == pytest.approx(wanted)
        near += sum(s < 1 for s in wanted.values())
    assert near > 5


def test_lookup_misses_nothing_within_the_radius():
    rng = np.random.default_rng(5)
    items = tuple((i, sentence(random.Random(i), 12)) for i in range(50))
    index = dec.Index(items)
    for _ in range(300):
        fp = int(index.fps[rng.integers(50)])
        for bit in rng.choice(64, rng.integers(0, dec.RADIUS + 1), replace=False):
            fp ^= 1 << int(bit)
        near = np.flatnonzero(np.bitwise_count(index.fps ^ np.uint64(fp)) <= dec.RADIUS)
        assert set(near) == set(index.candidates(12, fp).tolist())


def test_window_fingerprints_equal_their_definition():
    hashes = np.random.default_rng(6).integers(0, 1 << 63, 300, dtype=np.uint64)
    for size in (1, 2, 7, 50):
        starts = np.arange(0, 300 - size + 1, 3)
        for start, fp in zip(starts, dec.window_fingerprints(hashes, starts, size), strict=True):
            part = hashes[start : start + size].tolist()
            assert int(fp) == sum((2 * sum(h >> b & 1 for h in part) > size) << b for b in range(64))


def test_edge_rows(spark, edge, docs_of):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (None, "é" * 5000), (3, "a b")], "item_id bigint, text string")
    found = dec.contaminated(edge, bench).collect()
    assert sorted((str(r.doc_id), str(r.item_id)) for r in found) == [
        ("6", "3"), ("6", "3"), ("7", "3"), ("8", "None"), ("None", "3")
    ]
    kept = dec.drop_contaminated(edge, bench)
    assert kept.columns == edge.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "5", "9", "None"]
    assert dec.contaminated(docs_of([]), bench).count() == 0
    assert dec.contaminated(edge, bench.limit(0)).count() == 0
    assert dec.drop_contaminated(edge, bench.limit(0)).count() == edge.count()


def test_benchmark_in_blocks(spark, docs_of, monkeypatch):
    monkeypatch.setattr(dec, "BLOCK_BYTES", 100)
    rng = random.Random(7)
    items = [(i, sentence(rng, 20)) for i in range(9)]
    docs = docs_of([(i, f"before it {text} after it") for i, text in items])
    found = dec.contaminated(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(i, i) for i in range(9)} <= {(r.doc_id, r.item_id) for r in found}

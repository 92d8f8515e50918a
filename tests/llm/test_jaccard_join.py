import random

import numpy as np
import pytest

from recordweave.llm import chunks, jaccard_join
from tests.llm.conftest import EDGE


def shingles(text, width=4):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width=4, share=85):
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= share * (len(a) + len(sets[j]) - both):
                root[top(i)] = top(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(doc_id)
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[i][0], len(s), least[top(i)]) for i, s in enumerate(sets)), key=str)


def corpus(seed, size, vocabulary, edits):
    """Texts of their own, copies with a few changed words, and texts put together from common passages."""
    rng = random.Random(seed)
    word = lambda: f"W{rng.randrange(vocabulary)}"
    passages = [[word() for _ in range(rng.randrange(5, 40))] for _ in range(6)]
    texts = []
    while len(texts) < size:
        kind = rng.random()
        if kind < 0.25 or not texts:
            words = [word() for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 20, 60, 150]))]
        elif kind < 0.45:
            words = sum(rng.sample(passages, rng.randrange(1, 5)), [])
        else:
            words = list(rng.choice(texts))
            for _ in range(rng.randrange(0, edits)):
                if words:
                    words[rng.randrange(len(words))] = word()
            if rng.random() < 0.3:
                words = words[rng.randrange(0, 3) :]
        texts.append(words)
    rows = [(rng.choice([None, i, i, i, i, i, i, i]), " ".join(t) if rng.random() < 0.8 else " \n".join(t).lower()) for i, t in enumerate(texts)]
    return rows


@pytest.mark.parametrize(
    ("seed", "vocabulary", "edits", "share", "few"),
    [(1, 5000, 6, 85, 4), (2, 30, 3, 85, 0), (3, 5000, 12, 85, 0), (4, 500, 4, 60, 0), (5, 5000, 4, 100, 4)],
)
def test_groups_equal_brute_force(docs_of, monkeypatch, seed, vocabulary, edits, share, few):
    monkeypatch.setattr(jaccard_join, "FEW_PAIRS", few)
    rows = corpus(seed, 350, vocabulary, edits)
    found = jaccard_join.jaccard_groups(docs_of(rows), share=share).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, share=share)


def test_a_chain_of_links_is_one_group(docs_of):
    words = [f"w{i}" for i in range(140)]
    rows = [(100 - i, " ".join(words[2 * i : 2 * i + 60])) for i in range(30)]
    found = jaccard_join.jaccard_groups(docs_of(rows)).collect()
    assert {r.component_id for r in found} == {71}


def test_small_chunks_and_buckets_change_nothing(docs_of, monkeypatch):
    rows = corpus(9, 200, 4000, 5)
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(chunks, "BUCKET_GRAMS", 50)
    found = jaccard_join.jaccard_groups(docs_of(rows)).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_prefix_lengths():
    for share in (50, 85, 100):
        for n in range(1, 200):
            assert 1 <= jaccard_join.index_prefix(n, share) <= n - jaccard_join.least_overlap(n, share) + 1
            # The two sizes that leave most room: as large, and as small as can link.
            assert 2 * jaccard_join.least_overlap(n, share) >= n * 2 * share // 100


def test_totals_find_what_is_frequent():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 64, 500, dtype=np.uint64)
    for bits in (0, 3):
        parts = [np.unique(rng.choice(hashes, 200)) for _ in range(4)]
        sent = chunks.pa.concat_tables([chunks.request(i, p, np.ones(len(p), int), bits) for i, p in enumerate(parts)])
        replies = []
        for bucket in set(sent.column("bucket").to_pylist()):
            replies.append(chunks._tallied(sent.filter(chunks.pa.compute.equal(sent.column("bucket"), bucket)), 2))
        replies = chunks.pa.concat_tables(replies)
        for i, p in enumerate(parts):
            told = chunks.Totals(replies.filter(chunks.pa.compute.equal(replies.column("chunk"), i)), bits)
            want = np.array([sum(int(h in q) for q in parts) for h in p])
            assert told.of(p).tolist() == np.where(want >= 2, want, 0).tolist()


def test_edge_rows(edge):
    found = [tuple(r) for r in jaccard_join.jaccard_groups(edge).collect()]
    assert sorted(found, key=str) == brute(EDGE)


def test_empty_table(docs_of):
    assert jaccard_join.jaccard_groups(docs_of([])).count() == 0


def test_a_share_outside_its_range_is_refused(docs_of):
    with pytest.raises(ValueError):
        jaccard_join.jaccard_groups(docs_of([]), share=0)

import random
import re

import numpy as np
import pytest
import xxhash

from recordweave.llm import simhash_gray as gray
from recordweave.llm.components import local_components, star_components
from tests.llm.conftest import EDGE


def fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def components(fps, limit):
    label = np.arange(len(fps))
    for i in range(len(fps)):
        near = np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= limit) + i + 1
        label = local_components(len(fps), np.full(len(near), i), near, label)
    return label


def gray_sorted(fps):
    rank = fps.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return fps[np.argsort(rank)]


def around(rng, size, flips):
    fps = np.full(size, rng.integers(0, 1 << 63, dtype=np.uint64))
    for _ in range(flips):
        fps ^= np.uint64(1) << rng.integers(0, 64, size).astype(np.uint64)
    return np.unique(fps)


def test_simhash_equals_its_definition():
    random.seed(1)
    letters = ["a", "B", "é", "É", " ", "\n", "\x0b", "\x1c", "word ", "K"]
    for size in (0, 1, 3, 10, 50, 3000):
        text = "".join(random.choice(letters) for _ in range(size))
        assert gray.simhash(text.encode()) == fingerprint(text)


@pytest.mark.parametrize(("size", "flips", "limit"), [(2000, 3, 4), (1500, 8, 4), (1500, 30, 4), (500, 6, 2), (40, 64, 6)])
def test_a_run_finds_every_component(size, flips, limit):
    fps = gray_sorted(around(np.random.default_rng(size), size, flips))
    member, root = gray.search_run(fps, limit)
    assert (local_components(len(fps), member, root) == components(fps, limit)).all()


def test_upper_nodes_hold_every_link():
    rng = np.random.default_rng(2)
    masks = gray.upper_masks(4)
    for _ in range(500):
        flips = rng.choice(64, 4, replace=False)
        change = sum(1 << int(b) for b in flips)
        assert any(change & m == 0 for m in masks)
        inner = next(m for m in masks if change & m == 0)
        assert any(change & m == 0 for m in gray.upper_masks(4, inner))


@pytest.mark.parametrize("max_run", [gray.MAX_RUN, 40])
def test_components_equal_brute_force(spark, max_run):
    rng = np.random.default_rng(3)
    fps = np.unique(np.concatenate([around(rng, 300, 3), around(rng, 300, 9), around(rng, 300, 40)]))
    frame = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint")
    stars = {r.node: r.root for r in star_components(gray.near_links(frame, 4, max_run)).collect()}
    signed = fps.view(np.int64).tolist()
    found = [stars.get(x, x) for x in signed]
    label = components(fps, 4)
    groups = {}
    for at, x in zip(label.tolist(), found, strict=True):
        groups.setdefault(at, set()).add(x)
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(found))


def test_long_chain(spark):
    edges = spark.range(400).selectExpr("id as a", "id + 1 as b")
    assert {r.root for r in star_components(edges).collect()} == {0}


def test_no_edges(spark):
    assert star_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_edge_rows(edge):
    rows = gray.simhash_groups(edge).collect()
    assert len(rows) == len(EDGE)
    texts = dict(EDGE[2:])
    for row in rows:
        if row.doc_id is not None:
            assert row.fingerprint == f"{fingerprint(texts[row.doc_id]):016x}"
    by_id = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert by_id[3] == by_id[4] == by_id[5] == 3  # no words: fingerprint zero, linked
    assert by_id[6] == by_id[7] == 6
    assert sorted(str(r.component_id) for r in rows if r.doc_id is None) == ["3", "6"]


def test_one_of_each_group_stays_with_all_columns(edge):
    kept = gray.keep_one(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 6, 8, 9]


def test_rows_without_any_id(docs_of):
    kept = gray.keep_one(docs_of([(None, "one two three"), (None, "one two three"), (None, "other words here now")])).collect()
    assert sorted(r.text for r in kept) == ["one two three", "other words here now"]


def test_empty_table(docs_of):
    assert gray.simhash_groups(docs_of([])).count() == 0
    assert gray.keep_one(docs_of([])).count() == 0

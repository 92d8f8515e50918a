import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from recordweave.llm import packing
from recordweave.llm.tokens import encoder


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_tokenizer(name):
    made, whole = encoder(name), Tokenizer.from_file(public_tokenizers.path(name))
    random.seed(1)
    parts = [*"abÉß.,  \n\t's123!<ªµ", "　", "\x1c", "\x85", "<|endoftext|>", "<|startoftext|>", " ", "  ", "́", "Σ", "İ", "'ll", "中文",
             "​", " ", "﻿", "Word ", "\n\n", "wörter. "]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 14))) for _ in range(6000)]
    assert made.encode(texts) == [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_knapsack_equals_brute_force():
    random.seed(2)
    for _ in range(30):
        lengths = np.array(sorted(random.sample(range(1, 15), 4)))
        prices = np.array([random.random() for _ in lengths])
        best, pick = packing.knapsack(lengths, prices, 20)
        used = packing.configuration(lengths, pick, 20)
        wanted = max(
            sum(n * p for n, p in zip(c, prices, strict=True))
            for c in itertools.product(*[range(20 // n + 1) for n in lengths.tolist()])
            if sum(n * x for n, x in zip(c, lengths.tolist(), strict=True)) <= 20
        )
        assert best[20] == pytest.approx(wanted) == sum(prices[i] * n for i, n in used.items())
        assert sum(int(lengths[i]) * n for i, n in used.items()) <= 20


HISTOGRAMS = {
    "one length": {1500: 10},
    "full": {4096: 3},
    "halves and thirds": {1366: 1000, 1365: 1000, 700: 500, 2049: 300},
    "hot": {4096: 10_000_000, 1: 5, 2000: 7},
    "uniform": {i: 3 for i in range(300, 4097, 7)},
    "all lengths": dict(Counter(np.random.default_rng(1).integers(1, 4097, 50000).tolist())),
    "over half with smaller": dict(Counter([
        *np.random.default_rng(2).integers(2050, 2401, 20000).tolist(), *np.random.default_rng(3).integers(600, 1101, 40000).tolist()
    ])),
    "middle": dict(Counter(np.random.default_rng(0).normal(1400, 150, 20000).astype(int).tolist())),
}


@pytest.mark.parametrize("name", sorted(HISTOGRAMS))
def test_plan_holds_every_piece_once(name):
    histogram = HISTOGRAMS[name]
    made = packing.plan(histogram)
    held = Counter()
    for config, times in made.configurations:
        assert sum(config) <= packing.CAPACITY
        for length in config:
            held[length] += times
    assert held == histogram
    assert made.lower_bound - 1e-6 <= made.sequences
    plain = sum(times for _, times in packing._best_fit(list(histogram), list(histogram.values()), {}, packing.CAPACITY))
    assert made.sequences <= plain


def test_empty_plan():
    assert packing.plan({}).sequences == 0


def check(rows, whole, docs):
    for doc, text in docs:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        mine = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.piece)
        times = sum(d == doc for d, _ in docs)
        cut = [ids[i : i + 64] for i in range(0, len(ids), 64)]
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in mine[::times]] == [
            (k, 64 * k, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(cut)
        ]
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in group:
            assert r.offset == at
            at += r.length
        assert at <= 64


def test_pieces_and_places(docs_of):
    random.seed(3)
    docs = [(i, " ".join(random.choice(["the", "wörter", "x1", "."]) for _ in range(random.randint(0, 150)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "twice"), (102, "twice")]
    packed = packing.pack(docs_of(docs), capacity=64, keep_ids=True)
    rows = packed.collect()
    check(rows, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), docs)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in rows:
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)


def test_edge_rows(edge, docs_of, monkeypatch):
    monkeypatch.setattr(packing, "NUMBERED", 2)
    rows = packing.pack(edge).collect()
    assert len(rows) == 11 and sum(r.doc_id is None for r in rows) == 2  # the long text takes two pieces
    assert len({(r.sequence_id, r.offset) for r in rows}) == 11
    assert packing.pack(docs_of([])).count() == 0

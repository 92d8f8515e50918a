import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from recordweave.llm import mixing_coder as coder
from recordweave.llm.tokens import encoder
from recordweave.storage import new_folder


def streams(size):
    rng = np.random.default_rng(size)
    return {
        "any": rng.integers(0, 50257, size),
        "one": np.full(size, 7),
        "skewed": np.minimum(50256, rng.geometric(0.01, size)),
        "loop": np.resize(rng.integers(0, 300, 17), size),
    }


@pytest.mark.parametrize("size", [0, 1, 2, 5, 255, 256, 257, 5000])
def test_segments_round_trip(size):
    for ids in streams(size).values():
        raw = coder.encode_segment(ids, 256)
        back, end = coder.decode_segment(raw)
        assert (back == ids).all() and end == len(raw)


def test_blocks_stand_alone():
    ids = streams(3000)["skewed"]
    raw = coder.encode_segment(ids, 256)
    back, _ = coder.decode_segment(raw, 0, np.array([3, 1]))
    assert (back == np.concatenate([ids[768:1024], ids[256:512]])).all()


def test_context_beats_the_frequencies_alone():
    rng = np.random.default_rng(1)
    follows = rng.integers(0, 30, (900, 3))
    ids = [1, 2]
    for _ in range(8000):
        ids.append(int(follows[ids[-1] * 30 + ids[-2], rng.choice(3, p=[0.8, 0.15, 0.05])]))
    size = len(coder.encode_segment(np.array(ids), 8002)) * 8
    share = np.bincount(ids) / len(ids)
    entropy = -sum(len(ids) * p * np.log2(p) for p in share if p)
    assert size < 0.75 * entropy


def test_damage_is_noticed():
    raw = bytearray(coder.encode_segment(streams(2000)["any"], 256))
    random.seed(1)
    for _ in range(40):
        place = random.randrange(4, len(raw) - 8)
        hurt = bytearray(raw)
        hurt[place] ^= 0x40
        try:
            back, _ = coder.decode_segment(bytes(hurt))
        except (ValueError, IndexError):
            continue
        assert (back == streams(2000)["any"]).all()  # a bit behind the last id of a block


def test_files_over_several_segments():
    rng = np.random.default_rng(2)
    docs = [(int(i) if i % 7 else None, rng.integers(0, 50257, rng.integers(0, 90)).astype("<u4").tobytes()) for i in range(300)]
    batches = (([d for d, _ in docs[i : i + 13]], [b for _, b in docs[i : i + 13]]) for i in range(0, 300, 13))
    raw = b"".join(coder.encode_file(batches, block=64, lanes=8))
    back = list(coder.decode_file(raw))
    assert [(d, b) for d, _, b in back] == docs
    assert [n for _, n, _ in back] == [sum(len(b) // 4 for _, b in docs[:i]) for i in range(300)]
    with pytest.raises(ValueError):
        list(coder.decode_file(raw[:-1]))


def test_written_and_read_back(spark, docs_of):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    random.seed(3)
    docs = [(random.randint(-9, 10**12), "".join(random.choice("ab é\n") for _ in range(random.randint(0, 200)))) for _ in range(120)]
    docs += [(None, "null id"), (10**13, None), (10**13 + 1, ""), (10**13 + 2, "twice"), (10**13 + 2, "twice")]
    folder = new_folder(spark, "ids-test")
    rows = coder.read_ids(spark, folder, coder.write_ids(docs_of(docs).repartition(5), folder), keep_ids=True).collect()
    start = 0
    for doc, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert any((r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (doc, start, len(ids) // 4, zlib.crc32(ids), ids) for r in rows)
        start += len(ids) // 4
    assert len(rows) == len(docs)


def test_edge_and_empty_tables(spark, edge, docs_of):
    for frame, size in ((edge, 10), (docs_of([]), 0)):
        folder = new_folder(spark, "ids-test")
        assert coder.read_ids(spark, folder, coder.write_ids(frame, folder)).count() == size


def test_few_ids_over_make_no_segment_of_their_own():
    rng = np.random.default_rng(4)
    for size, segments in ((64 * 8 + 10, 1), (64 * 12 + 10, 2), (64 * 40, 5)):
        ids = rng.integers(0, 50257, size).astype("<u4")
        raw = b"".join(coder.encode_file(iter([([1], [ids.tobytes()])]), block=64, lanes=8))
        at, blocks = 0, []
        while raw[at : at + 4] == raw[:4]:
            part, at = coder.decode_segment(raw, at)
            blocks.append(-(-len(part) // 64))
        assert len(blocks) == segments and max(blocks) <= 13 and min(blocks) >= 4
        assert [b for _, _, b in coder.decode_file(raw)] == [ids.tobytes()]


def test_blocks_of_any_number_and_length():
    rng = np.random.default_rng(5)
    for size in (2047, 2048, 2049, 3 * 2048 + 1, 70 * 300):
        for block in (64, 300, 2048):
            ids = np.minimum(rng.geometric(0.002, size), (1 << 20) - 1)
            ids[rng.integers(0, size, 20)] = (1 << 20) - 1
            back, _ = coder.decode_segment(coder.encode_segment(ids, block))
            assert (back == ids).all()


def test_pieces_of_many_texts_at_once():
    random.seed(6)
    texts = ["", " ", "a", " a", "a ", "a\nB", "a - b", "don't", "x  y", "<|endoftext|>", "a\xa0b", "日本 x", "ª º", "×÷", "...", "1a 2"]
    texts += ["".join(random.choice("ab É÷ª.-1\n7,Z") for _ in range(random.randint(0, 40))) for _ in range(3000)]
    random.shuffle(texts)
    whole = Tokenizer.from_file(public_tokenizers.path(coder.TOKENIZER))
    made = encoder(public_tokenizers.path(coder.TOKENIZER), 1000)
    expected = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert made.encode_many(texts) == expected and made.encode_many(texts[::-1]) == expected[::-1]
    assert made.encode_many([]) == [] and made.encode(texts) == expected
    other = encoder("word_bpe_49k.json")
    assert other.encode_many(texts) == other.encode(texts)

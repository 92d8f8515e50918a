"""Benchmark passages in documents, found by SimHash over windows of an item's size.

For an item of n words, every window of n words of a text is fingerprinted: the majority of
the hash bits of its word shingles, read from running sums so that the next window costs one
step.  Fingerprints are looked up in a multi-index over the items of that size: the 64
bits are cut into ``BLOCKS`` blocks, and if two fingerprints differ in at most ``RADIUS`` bits, then some
block differs in at most ``RADIUS // BLOCKS`` bits.  All block values that near are listed beforehand, so
the lookup misses no fingerprint within the radius.  A candidate counts once the weighted
similarity of the shingles, computed exactly (sum of the smaller over sum of the larger
multiplicities), reaches ``SIMILARITY``.

A window that shares no shingle with an item has similarity zero.  So only windows around a
shingle of some item, and only of the sizes of the items that have it, are fingerprinted; the
rest of a text costs a look at its words.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordweave.llm.common import materialize, ship_package, slices, without

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Differing bits at which a window is still a candidate.  Shingle sets of similarity 0.8 differ in 10 of 64 bits on average, with a deviation of 3.
RADIUS = 23
BLOCKS = 8
#: Text bytes of the benchmark items handled in one pass over the documents.
BLOCK_BYTES = 8 << 20
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters and digits, in lower case."""
    return _WORD.findall(text.lower())


def _mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of MurmurHash3)."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def _next(total: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Shingle hashes with one more word."""
    return _mix(total + hashes + np.uint64(0x9E3779B97F4A7C15))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` word hashes."""
    count = len(hashes) - size + 1
    total = np.zeros(max(0, count), np.uint64)
    for i in range(size):
        total = _next(total, hashes[i : i + count])
    return total


def window_fingerprints(shingles: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the ``size`` shingles from each start: bits set in over half of them."""
    out = np.empty(len(starts), np.uint64)
    step = max(1, (1 << 16) // size)
    for at in range(0, len(starts), step):
        part = starts[at : at + step]
        first, last = part.min(), part.max() + size
        bits = np.unpackbits(shingles[first:last].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.zeros((len(bits) + 1, 64), np.int32)
        np.cumsum(bits, axis=0, out=sums[1:])
        ones = sums[part - first + size] - sums[part - first]
        out[at : at + step] = np.packbits(2 * ones > size, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


class Index:
    """A block of benchmark items, ready to be searched for."""

    def __init__(self, items: tuple[tuple[int, str], ...], radius: int = RADIUS, similarity: float = SIMILARITY) -> None:
        self.radius, self.similarity = radius, similarity
        self.ids, sizes, self.bags, fps = [], [], [], []
        self.words: dict[str, int] = {}
        self.holders: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            k = min(SHINGLE_WORDS, len(words))
            hashes = self._hashes(words)
            self.words.update(zip(words, hashes.tolist(), strict=True))
            grams = shingle_hashes(hashes, k)
            self.ids.append(item_id)
            sizes.append(len(words))
            self.bags.append(Counter(grams.tolist()))
            fps.append(window_fingerprints(grams, np.array([0]), len(grams))[0])
            for g in self.bags[-1]:
                self.holders[k][g].add(len(words))
        self.sizes, self.fps = np.array(sizes, np.int64), np.array(fps, np.uint64)
        self.known = {k: np.array(sorted(held), np.uint64) for k, held in self.holders.items()}
        self.members = {int(n): np.flatnonzero(self.sizes == n) for n in set(sizes)}
        self.near = {n: self._near(self.fps[m]) for n, m in self.members.items()}

    @staticmethod
    def _hashes(words: list[str]) -> np.ndarray:
        return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))

    def _near(self, fps: np.ndarray) -> list[list[np.ndarray]]:
        """For every block and value of it: the items whose block is within the block's share of the radius."""
        width = 64 // BLOCKS
        flips = [0] + [
            sum(1 << b for b in bits) for r in range(1, self.radius // BLOCKS + 1) for bits in combinations(range(width), r)
        ]
        tables = []
        for block in range(BLOCKS):
            lists: list[list[int]] = [[] for _ in range(1 << width)]
            for i, value in enumerate(((fps >> np.uint64(block * width)) & np.uint64((1 << width) - 1)).tolist()):
                for flip in flips:
                    lists[value ^ flip].append(i)
            tables.append([np.array(x, np.int64) for x in lists])
        return tables

    def candidates(self, size: int, fp: int) -> np.ndarray:
        """Items of ``size`` words whose fingerprint is within the radius, by the multi-index."""
        width, members = 64 // BLOCKS, self.members[size]
        tables = self.near[size]
        hit = np.unique(np.concatenate([tables[b][fp >> (b * width) & ((1 << width) - 1)] for b in range(BLOCKS)]))
        hit = hit[np.bitwise_count(self.fps[members[hit]] ^ np.uint64(fp)) <= self.radius]
        return members[hit]

    def search(self, text: str) -> list[tuple[int, int, int, int, float]]:
        """(item, first word, words, differing bits, similarity) of the best window for every item found."""
        words = words_of(text)
        if not words or not self.ids:
            return []
        hashes = np.fromiter(map(self.words.get, words, repeat(0)), np.uint64, len(words))
        best: dict[int, tuple[float, int, int, int]] = {}
        run = np.concatenate([[0], np.cumsum(hashes != 0)])
        for k, known in self.known.items():
            if len(words) < k:
                continue
            full = np.flatnonzero(run[k:] - run[:-k] == k)  # a shingle of an item has no other words
            grams = np.zeros(len(full), np.uint64)
            for i in range(k):
                grams = _next(grams, hashes[full + i])
            there = np.flatnonzero(known[np.minimum(np.searchsorted(known, grams), len(known) - 1)] == grams)
            anchors: dict[int, list[int]] = defaultdict(list)
            for place, gram in zip(full[there].tolist(), grams[there].tolist(), strict=True):
                for size in self.holders[k][gram]:
                    anchors[size].append(place)
            for size, places in anchors.items():
                self._windows(words, size, k, np.array(places), best)
        return [(item, first, size, bits, sim) for item, (sim, first, bits, size) in sorted(best.items())]

    def _windows(self, words: list[str], size: int, k: int, places: np.ndarray, best: dict) -> None:
        """Fingerprint the windows of ``size`` words around shingles at ``places`` and verify the candidates."""
        length = min(size, len(words))
        count = length - k + 1
        low, high = np.maximum(0, places - (length - k)), np.minimum(places, len(words) - length)
        marks = np.zeros(len(words) + 1, np.int32)
        np.add.at(marks, low, 1)
        np.add.at(marks, high + 1, -1)
        starts = np.flatnonzero(np.cumsum(marks)[:-1] > 0)
        for group in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
            if not len(group):
                continue
            base = group[0]
            grams = shingle_hashes(self._hashes(words[base : group[-1] + length]), k)
            fps = window_fingerprints(grams, group - base, count)
            for start, fp in zip(group.tolist(), fps.tolist(), strict=True):
                bag = None
                for i in self.candidates(size, fp):
                    bag = bag or Counter(grams[start - base : start - base + count].tolist())
                    other = self.bags[i]
                    common = sum(min(n, other[g]) for g, n in bag.items() if g in other)
                    sim = common / (count + other.total() - common)
                    if sim >= self.similarity:
                        bits = int(np.bitwise_count(self.fps[i] ^ np.uint64(fp)))
                        found = (sim, start, bits, length)
                        old = best.get(self.ids[i])
                        if old is None or (-sim, start) < (-old[0], old[1]):
                            best[self.ids[i]] = found


@lru_cache(maxsize=2)
def _index_of(items: tuple[tuple[int, str], ...], radius: int, similarity: float) -> Index:
    return Index(items, radius, similarity)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[tuple[int, str], ...]]:
    """The items in blocks of at most ``BLOCK_BYTES`` of text (one item may be longer), read one block at a time."""
    rows = benchmark.select(F.col(f"`{item_col}`").cast("bigint"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    block, held = [], 0
    for item, text in rows.distinct().toLocalIterator():
        if block and held + len(text) * 4 > BLOCK_BYTES:
            yield tuple(sorted(block, key=str))
            block, held = [], 0
        block.append((item, text))
        held += len(text) * 4
    if block:
        yield tuple(sorted(block, key=str))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    radius: int = RADIUS,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """One row per row of ``docs`` and benchmark item found in it.

    ``doc_id``, ``item_id``, ``first_word`` (from 0) and ``n_words`` of the best window, ``bits`` that differ,
    ``similarity``, and ``text_hash``.  On a tie the first window counts.  Null and empty texts and items
    contain nothing and are found nowhere.  An item of fewer than five words is one shingle.  A text
    shorter than an item is compared as a whole.  Repeated rows are answered each; an empty benchmark
    or table gives no rows.  Other columns are not read.  The benchmark is the query set: it
    is sent to the tasks in blocks of ``BLOCK_BYTES``, each searched for in all documents.
    """
    spark = docs.sparkSession
    ship_package(spark)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    chosen = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    schema = "doc_id bigint, text_hash bigint, item_id bigint, first_word int, n_words int, bits int, similarity double"
    found = spark.createDataFrame([], schema)
    for items in _blocks(benchmark, item_col, item_text_col):
        sent = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = _index_of(sent.value, radius, similarity)
            for batch in slices(batches, "text"):
                rows = [
                    (d.as_py(), h.as_py(), *hit)
                    for d, h, t in zip(batch.column("doc_id"), batch.column("hash"), batch.column("text"), strict=True)
                    for hit in index.search(t.as_py())
                ]
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "item_id", "first_word", "n_words", "bits", "similarity"])

        found = found.unionByName(chosen.mapInArrow(run, schema))
    return found.select("doc_id", "item_id", "first_word", "n_words", "bits", "similarity", "text_hash")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` without any benchmark item, all columns kept, compared by id and text hash."""
    hits = contaminated(docs, benchmark, id_col, text_col, **settings)
    gone = materialize(hits.select("doc_id", "text_hash").distinct(), "contaminated")
    return without(docs, gone, id_col, text_col)

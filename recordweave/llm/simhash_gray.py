"""SimHash near-duplicates by a Gray-order hierarchical index.

The index is a tree of masked bit patterns.  A node stands for a set of fingerprints
and keeps the bits all of them share, without those its parent already has.  A
search adds up the differing bits on its way down and leaves a node, with its whole group, once
the sum exceeds the limit.

* Upper nodes.  The 64 bits are cut into ``max_bits + 2`` blocks.  Two fingerprints that
  differ in at most ``max_bits`` bits agree in two whole blocks, so for every pair of blocks there is
  one node per pattern of these blocks, and each link lies inside some upper node.  Spark deals
  the fingerprints out by upper node.
* Lower nodes.  Inside an upper node the fingerprints are sorted by Gray rank, which puts
  those that share bits side by side; runs of them form leaves, runs of leaves their parents.

Fingerprints that are equal enter the index once.  An upper node of more than
``MAX_RUN`` fingerprints is not searched as it is: its free bits are cut into blocks again, which
gives upper nodes one level deeper.  So no task holds more than ``MAX_RUN`` of a node,
and no link is lost.  A task returns a spanning forest of the links it found instead
of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordweave.llm.common import fresh, keyed, materialize, ship_package, slices, text_key, without
from recordweave.llm.components import local_components, star_components
from recordweave.operators.lookup import broadcast_if_small

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
#: Most fingerprints of one upper node that a task searches; beyond it the node is divided.
MAX_RUN = 1 << 17
#: Fingerprints in a leaf of the tree, and children of an upper node.
LEAF, FAN = 16, 8
#: Runs up to this size are one leaf.
SMALL_RUN = 32
_ALL = (1 << 64) - 1


def simhash(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Fingerprint of UTF-8 text: A-Z lower-cased, words, shingles with repeats, majority of each hash bit."""
    words = text.lower().split()
    if not words:
        return 0
    count = max(1, len(words) - shingle_words + 1)
    parts = zip(*(words[i:] for i in range(shingle_words)), strict=False) if count > 1 else [words]
    digest = partial(xxhash.xxh64_intdigest, seed=HASH_SEED)
    hashes = np.fromiter(map(digest, map(b" ".join, parts)), np.uint64, count)
    ones = np.empty((8, 8), np.int64)
    starts = np.arange(0, count, 255)
    for bit in range(8):
        lanes = (hashes >> np.uint64(bit)) & np.uint64(0x0101010101010101)  # one byte per eighth bit, at most 255 a sum
        ones[:, bit] = np.add.reduceat(lanes, starts).view(np.uint8).reshape(-1, 8).sum(axis=0)
    return int(np.packbits(2 * ones.reshape(64) > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp`` (the 64 bits as a bigint) for every row."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.array([simhash(t, shingle_words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(found.view(np.int64))], ["doc_id", "text_hash", "fp"]
            )

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    chosen = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text")
    )
    return chosen.mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


def upper_masks(max_bits: int, within: int = 0) -> list[int]:
    """Masks of the upper nodes: ``within``, and every pair of blocks of the bits outside it."""
    free = [b for b in range(64) if not within >> b & 1]
    blocks = [sum(1 << int(b) for b in part) for part in np.array_split(free, max_bits + 2) if len(part)]
    return [within | a | b for a, b in combinations(blocks, 2)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _gray_order(fp: Column) -> Column:
    """Place of the bits in Gray-code order, as a bigint that sorts the same way."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def search_run(run: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest member by place) that join the Gray-ordered fingerprints of one upper node.

    Queries go down the tree in groups.  A node whose members all belong to the
    component the query already has is left out: it can't join anything new.
    """
    size = len(run)
    shared, value, start = [], [], []
    low, high, at = run, run, np.arange(size)
    for step in [LEAF] + [FAN] * 64:
        cuts = np.arange(0, len(low), step)
        low, high, at = np.bitwise_and.reduceat(low, cuts), np.bitwise_or.reduceat(high, cuts), at[cuts]
        shared.append(~(low ^ high))
        value.append(low)
        start.append(at)
        if len(low) == 1:
            break
    own = [m if k + 1 == len(shared) else m & ~np.repeat(shared[k + 1], FAN)[: len(m)] for k, m in enumerate(shared)]
    ends = [np.append(s[1:], size) for s in start]
    label, done, width = np.arange(size), 0, LEAF
    while done < size:
        query = np.arange(done, min(size, done + width))
        done += len(query)
        lone = [(np.minimum.reduceat(label, s), np.maximum.reduceat(label, s)) for s in start]
        q, node, cost = query, np.zeros(len(query), np.int64), np.zeros(len(query), np.int64)
        for level in range(len(shared) - 1, -1, -1):
            cost = cost + np.bitwise_count((run[q] ^ value[level][node]) & own[level][node])
            least, most = lone[level][0][node], lone[level][1][node]
            keep = (cost <= max_bits) & (ends[level][node] > q) & ~((least == most) & (least == label[q]))
            q, node, cost = q[keep], node[keep], cost[keep]
            fan, below = (LEAF, size) if level == 0 else (FAN, len(shared[level - 1]))
            leaf = node
            q, node, cost = np.repeat(q, fan), (node[:, None] * fan + np.arange(fan)).ravel(), np.repeat(cost, fan)
            leaf, inside = np.repeat(leaf, fan), node < below
            q, node, cost, leaf = q[inside], node[inside], cost[inside], leaf[inside]
        near = (node > q) & (cost + np.bitwise_count((run[q] ^ run[node]) & ~shared[0][leaf]) <= max_bits)
        label = local_components(size, q[near], node[near], label)
        width = int(np.clip(width * (1 << 19) / max(1, len(q)), LEAF, min(2 * width, 1 << 13)))
    member = np.flatnonzero(label != np.arange(size))
    return member, label[member]


class _Forest:
    """Spanning forest of links, kept short while links arrive."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.held = 0

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        if len(left):
            self.parts.append(np.stack([left, right]))
            self.held += len(left)
            if self.held > 1 << 20:
                self.parts = [self.links()]
                self.held = self.parts[0].shape[1] // 2

    def links(self) -> np.ndarray:
        if not self.parts:
            return np.empty((2, 0), np.int64)
        ends = np.concatenate(self.parts, axis=1)
        names, place = np.unique(ends, return_inverse=True)
        place = place.reshape(ends.shape)
        label = local_components(len(names), place[0], place[1])
        member = np.flatnonzero(label != np.arange(len(names)))
        return np.stack([names[member], names[label[member]]])


def search_sorted(batches: Iterator[pa.RecordBatch], max_bits: int, max_run: int) -> Iterator[pa.RecordBatch]:
    """Links inside the upper nodes of a partition sorted by (mask, pattern, Gray order).

    Yields kind 0 rows (a, b): a link of the forest; kind 1 rows (a, b): mask and
    pattern of a node with more than ``max_run`` fingerprints.
    """
    forest, large, held, skip = _Forest(), [], np.empty((3, 0), np.int64), None

    def pairs(rows: np.ndarray) -> None:
        cut = np.flatnonzero((rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])) + 1
        starts = np.concatenate([[0], cut])
        sizes = np.diff(np.append(starts, rows.shape[1]))
        fps = rows[2]
        alike = np.repeat(sizes <= SMALL_RUN, sizes)
        run = np.repeat(np.arange(len(starts)), sizes)
        for gap in range(1, min(SMALL_RUN, rows.shape[1])):
            near = alike[gap:] & (run[gap:] == run[:-gap])
            if not near.any():
                break
            at = np.flatnonzero(near)
            at = at[np.bitwise_count((fps[at] ^ fps[at + gap]).view(np.uint64)) <= max_bits]
            forest.add(fps[at], fps[at + gap])
        for i in np.flatnonzero(sizes > SMALL_RUN):
            part = fps[starts[i] : starts[i] + sizes[i]]
            if len(part) > max_run:
                large.append((rows[0, starts[i]], rows[1, starts[i]]))
            else:
                member, root = search_run(part.view(np.uint64), max_bits)
                forest.add(part[member], part[root])

    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
        if skip is not None:
            rows = rows[:, np.cumsum((rows[0] != skip[0]) | (rows[1] != skip[1])) > 0]
        rows = np.concatenate([held, rows], axis=1)
        if not rows.shape[1]:
            continue
        skip = None
        other = np.flatnonzero((rows[0] != rows[0, -1]) | (rows[1] != rows[1, -1]))
        last = other[-1] + 1 if len(other) else 0
        if last:
            pairs(rows[:, :last])
        held = rows[:, last:]
        if held.shape[1] > max_run:
            skip = (held[0, 0], held[1, 0])
            large.append(skip)
            held = held[:, :0]
    if held.shape[1]:
        pairs(held)
    links, nodes = forest.links(), np.array(sorted(set(large)), np.int64).reshape(-1, 2).T
    for kind, ends in ((0, links), (1, nodes)):
        for at in range(0, ends.shape[1], 1 << 16):
            part = ends[:, at : at + (1 << 16)]
            kinds = pa.array(np.full(part.shape[1], kind, np.int32))
            yield pa.RecordBatch.from_arrays([kinds, pa.array(part[0]), pa.array(part[1])], ["kind", "a", "b"])


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, max_run: int = MAX_RUN) -> DataFrame:
    """A spanning set of links (a, b) of the distinct fingerprints in column ``fp``.

    A node that is too large comes back and its fingerprints are dealt to the nodes one level
    deeper.  Such nodes are few (each has more than ``max_run`` members), and their list is
    broadcast only under a measured size.
    """
    ship_package(fps.sparkSession)
    found, masks, dealt = None, {0: upper_masks(max_bits)}, fps.select("fp", F.lit(0).cast("bigint").alias("within"))
    while True:
        per_mask = F.create_map(*[
            x for within, below in masks.items() for x in (F.lit(_signed(within)), F.array(*[F.lit(_signed(m)) for m in below]))
        ])
        nodes = dealt.select("fp", F.explode(per_mask[F.col("within")]).alias("mask")).select(
            "mask", F.col("mask").bitwiseAND(F.col("fp")).alias("pattern"), "fp"
        )
        placed = nodes.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern", _gray_order(F.col("fp")))
        table = materialize(placed.mapInArrow(partial(search_sorted, max_bits=max_bits, max_run=max_run), "kind int, a bigint, b bigint"), "links")
        links = table.where("kind = 0").select("a", "b")
        found = links if found is None else found.unionByName(links)
        large = table.where("kind = 1").select(F.col("a").alias("mask"), F.col("b").alias("pattern")).distinct()
        within = [r[0] & _ALL for r in large.select("mask").distinct().collect()]
        if not within:
            return found
        masks = {m: upper_masks(max_bits, m) for m in within}
        fits = F.array(*[F.lit(_signed(m)) for m in within])
        dealt = (
            fps.select("fp", F.explode(fits).alias("mask"))
            .withColumn("pattern", F.col("mask").bitwiseAND(F.col("fp")))
            .join(broadcast_if_small(large), ["mask", "pattern"])
            .select("fp", F.col("mask").alias("within"))
        )


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    max_run: int = MAX_RUN,
) -> DataFrame:
    """Near-duplicate groups: ``doc_id``, ``fingerprint``, ``component_id``, and ``text_hash``, ``root`` for joining back.

    One row per input row.  ``component_id`` is the smallest id reached over links of at most
    ``max_bits`` differing bits; ids that are null have no part in that minimum, and it is null in a
    group of such rows only.  Null and empty texts and texts without words have
    fingerprint zero and are linked like any other.  Repeated rows share their fingerprint and group.
    Other columns of ``docs`` are not touched.  ``max_run`` bounds a task's memory, not the result.
    """
    known = materialize(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    distinct = materialize(known.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    stars = star_components(near_links(distinct.select("fp"), max_bits, max_run))
    rooted = distinct.join(stars, distinct.fp == stars.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    rooted = materialize(rooted, "roots")
    least = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "components")
    grouped = materialize(rooted.select("fp", "root").join(least, "root"), "grouped")
    return known.join(grouped, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "text_hash", "root"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` with one row left of every near-duplicate group, all columns kept.

    The row with the smallest id stays (among rows without any id, that with the smallest text hash); of
    repeated rows of that id and text, one.
    """
    groups = simhash_groups(docs, id_col, text_col, **settings)
    pairs = materialize(
        groups.groupBy("doc_id", "text_hash").agg(F.min("root").alias("root"), F.count(F.lit(1)).alias("times")), "pairs"
    )
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = pairs.groupBy("root").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("members")).where("members > 1")
    first = materialize(first.select("root", F.col("first.doc_id").alias("first_doc"), F.col("first.text_hash").alias("first_hash")), "firsts")
    stays = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("text_hash") == F.col("first_hash"))
    gone = pairs.join(broadcast_if_small(first), "root").where(~stays).select("doc_id", "text_hash")
    kept = without(docs, materialize(gone, "gone"), id_col, text_col)
    again = materialize(without(pairs.where("times > 1"), gone, "doc_id", None, "text_hash").select("doc_id", "text_hash"), "repeated")
    if again.isEmpty():
        return kept
    name = fresh(docs, "_key")
    keys = again.select(text_key(F.col("doc_id"), F.col("text_hash")).alias(name))
    once = keyed(kept, id_col, text_col, name).join(broadcast_if_small(keys), name, "left_semi").dropDuplicates([name])
    return without(kept, again, id_col, text_col).unionByName(once.select(*[F.col(f"`{c}`") for c in docs.columns]))

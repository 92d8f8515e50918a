"""N-gram Jaccard join: rare-first prefixes with length, positional and suffix filters.

A text's set is its distinct word shingles.  Texts link when 100 * |intersection| >= ``share`` * |union|.

* Rare first.  In how many texts each shingle occurs is counted over all texts (``chunks``: lists of hashes go to
  buckets and come back as counts).  Every set is sorted by that count, then by hash.
* Prefix.  Sets that link share a shingle within their prefixes, which hold one shingle more than a set may miss.  Shingles of one
  text only fill prefix places but join with nothing; a text whose prefix holds only such shingles links with no other.
* Joined on prefix shingles.  Of two sets the smaller needs only its shorter index prefix.  A pair goes on if its sizes
  are near enough (length), the shingles left behind the common one suffice (positional), and so do the sizes of the
  parts into which the hash space cuts both sets (suffix: parts that differ in size bound the overlap).
* Verified once.  Every pair that is left is compared by its texts' shingles themselves, not by hashes, and a pair is never compared again.

Texts with the same set are one class, and only classes are joined.  What is asked for is the groups that links reach, so a pair whose ends
are connected already is not compared.  In rounds, each shingle's most typical member (that with the fewest shingles
of its own) is compared with one member of each other group around that shingle, which joins near-copies of one
text without looking at all pairs of them; then all remaining pairs between different groups are compared.  No shingle, however
frequent, is left out, and nothing is gathered for one shingle: adaptive execution splits its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordweave.llm import chunks as ch
from recordweave.llm.common import materialize, ship_package
from recordweave.llm.components import star_components
from recordweave.operators.lookup import broadcast_if_small
from recordweave.operators.numbering import number_rows

SHINGLE_WORDS = 4
#: Least similarity, in hundredths.
SHARE = 85
#: Parts of the hash space for the suffix filter, as bits.
PART_BITS = 4
#: Pairs for each row of a round up to which all are compared at once, without rounds of typical members.
FEW_PAIRS = 4

SETS = (
    "doc_id bigint, set_key binary, n bigint, own bigint, shingles array<bigint>, places array<bigint>, "
    "parts array<bigint>, text binary"
)


def least_overlap(n: int, share: int) -> int:
    """Shingles that a set of ``n`` shares with any set it links with."""
    return -(-share * n // 100)


def index_prefix(n: int, share: int) -> int:
    """Prefix a set needs toward sets of its own size or more."""
    return n + 1 + (-2 * share * n // (100 + share))


# --- sets --------------------------------------------------------------------------------


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def hashed_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    words = [words_of(t) for t in texts]
    numbers, names, ends = ch.numbered(words)
    hashes = ch.word_hashes(names)[numbers] if len(names) else np.empty(0, np.uint64)
    out = []
    for i, own in enumerate(words):
        part = hashes[ends[i] : ends[i + 1]]
        out.append(np.unique(ch.gram_hashes(part, min(width, len(own)))) if own else part)
    return out


def exact_set(text: bytes, width: int) -> set:
    """The shingles themselves."""
    words = words_of(text)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(width)), strict=False))


def _binary_texts(table: pa.Table) -> list[bytes | None]:
    return table.column("text").to_pylist()


def _requests(rows: pa.Table, chunk: int, width: int, bits: int) -> pa.Table:
    sets = hashed_sets(_binary_texts(rows), width)
    return ch.request(chunk, *ch.counted(np.concatenate(sets) if sets else np.empty(0, np.uint64)), bits)


def _described(rows: pa.Table, chunk: int, told: ch.Totals, width: int, share: int) -> pa.Table:
    """One row of ``SETS`` for every text; those that may link also hold their prefix and text."""
    texts = _binary_texts(rows)
    sets = hashed_sets(texts, width)
    ends = np.cumsum([0, *map(len, sets)])
    totals = told.of(np.concatenate(sets) if sets else np.empty(0, np.uint64))
    pack, out = zstandard.ZstdCompressor(level=1).compress, []
    for i, (doc_id, text, own) in enumerate(zip(rows.column("doc_id").to_pylist(), texts, sets, strict=True)):
        n, times = len(own), totals[ends[i] : ends[i + 1]]
        if not n:
            out.append((doc_id, None, 0, 0, None, None, None, None))
            continue
        key = xxhash.xxh3_128_digest(own.tobytes())
        prefix, alone = n - least_overlap(n, share) + 1, int((times == 0).sum())
        if alone >= prefix:
            out.append((doc_id, key, n, alone, None, None, None, None))
            continue
        order = np.lexsort((own, times))
        front = own[order[alone:prefix]].view(np.int64)
        parts = np.bincount((own >> np.uint64(64 - PART_BITS)).astype(np.int64), minlength=1 << PART_BITS)
        out.append((doc_id, key, n, alone, front, np.arange(alone, prefix), parts, pack(text)))
    columns = list(zip(*out, strict=True)) if out else [[]] * 8
    numbers, whole = pa.list_(pa.int64()), pa.int64()
    kinds = [whole, pa.binary(), whole, whole, numbers, numbers, numbers, pa.binary()]
    names = ["doc_id", "set_key", "n", "own", "shingles", "places", "parts", "text"]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, width: int, share: int) -> DataFrame:
    """``SETS`` and a row number ``row`` for every row, as a table."""
    chosen = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    chunks = ch.chunked(chosen, "text", "jaccard-chunks")
    bits = ch.bucket_bits(chunks)
    requests = ch.each_chunk(chunks, partial(_requests, width=width, bits=bits), ch.REQUESTS)
    described = ch.with_totals(chunks, ch.tally(requests, 2), bits, partial(_described, width=width, share=share), SETS)
    return materialize(described.withColumn("row", F.monotonically_increasing_id()), "jaccard-sets")


# --- pairs -------------------------------------------------------------------------------


def may_link(a: str, b: str, share: int) -> Column:
    """The length, positional and suffix filters for two prefix rows with the same shingle."""
    cell = lambda side, name: F.col(f"{side}.{name}")
    na, nb = cell(a, "n"), cell(b, "n")
    needed = F.expr(f"({share} * ({a}.n + {b}.n) + {99 + share}) div {100 + share}")
    length = 100 * F.least(na, nb) >= share * F.greatest(na, nb)
    short = lambda side: cell(side, "place") < F.expr(f"{side}.n + 1 - ({2 * share} * {side}.n + {99 + share}) div {100 + share}")
    prefix = (short(a) | (na > nb)) & (short(b) | (nb > na))
    positional = F.least(na - cell(a, "place"), nb - cell(b, "place")) >= needed
    apart = F.aggregate(F.zip_with(cell(a, "parts"), cell(b, "parts"), lambda x, y: F.abs(x - y)), F.lit(0).cast("bigint"), lambda s, x: s + x)
    return length & prefix & positional & (na + nb - apart >= 2 * needed)


def _compared(batches: Iterator[pa.RecordBatch], width: int, share: int) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        known: dict[int, set] = {}
        links, a, b = [], batch.column("a").to_pylist(), batch.column("b").to_pylist()
        for i, (x, y) in enumerate(zip(a, b, strict=True)):
            if len(known) > 256:
                known.clear()
            for node, column in ((x, "left"), (y, "right")):
                if node not in known:
                    known[node] = exact_set(unpack(batch.column(column)[i].as_py()), width)
            common = len(known[x] & known[y])
            links.append(100 * common >= share * (len(known[x]) + len(known[y]) - common))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(links, pa.bool_())], ["a", "b", "linked"])


def _verified(pairs: DataFrame, sets: DataFrame, width: int, share: int) -> DataFrame:
    """``a``, ``b``, ``linked`` for each pair, as a table."""
    side = lambda node, name: sets.select(F.col("node").alias(node), F.col("text").alias(name))
    held = pairs.join(side("b", "right"), "b").join(side("a", "left"), "a").select("a", "b", "left", "right")
    return materialize(held.mapInArrow(partial(_compared, width=width, share=share), "a bigint, b bigint, linked boolean"), "jaccard-pairs")


def linked_groups(sets: DataFrame, width: int, share: int) -> DataFrame:
    """``node``, ``root`` for the sets in column ``node``: ``root`` is the smallest node that links reach."""
    places = F.arrays_zip("shingles", "places")
    prefixes = sets.select("node", "n", "parts", F.explode(places).alias("p")).select(
        F.col("p.shingles").alias("shingle"), F.col("p.places").alias("place"), "node", "n", "parts"
    )
    alone = sets.select("node", F.col("node").alias("root"))
    roots, tried, rounds = alone, None, True
    while True:
        placed = prefixes.join(roots, "node")
        # Shingles with more than one group around them, and what comparing all their pairs would take.
        wide = placed.groupBy("shingle").agg(F.count(F.lit(1)).alias("m"), F.min("root").alias("low"), F.max("root").alias("high"))
        wide = wide.where("low < high").select("shingle", "m")
        rows = materialize(placed.join(wide, "shingle"), "jaccard-open")
        if rounds:
            pairs, size = rows.agg(F.sum("m"), F.count(F.lit(1))).first()
            rounds = (pairs or 0) > FEW_PAIRS * size
        if rounds:
            heads = rows.groupBy("shingle", "root").agg(F.min("node").alias("node"))
            top = heads.groupBy("shingle").agg(F.min("node").alias("node"))
            x, y = rows.join(heads.select("shingle", "node"), ["shingle", "node"]), rows.join(top, ["shingle", "node"])
        else:
            x, y = rows, rows.select("*")
        keys = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.root") != F.col("y.root")) & may_link("x", "y", share)
        if not rounds:
            keys = keys & (F.col("x.node") < F.col("y.node"))
        pairs = x.alias("x").join(y.alias("y"), keys).select(
            F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
        ).distinct()
        if tried is not None:
            pairs = pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti")
        found = _verified(pairs, sets, width, share)
        new = found.where("linked").limit(1).count()
        tried = found if tried is None else tried.unionByName(found)
        if new:
            stars = star_components(tried.where("linked").select("a", "b"))
            roots = materialize(alone.select("node").join(stars, "node", "left").select("node", F.coalesce("root", "node").alias("root")), "jaccard-roots")
        if not rounds:
            return roots
        rounds = bool(new)


def jaccard_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS, share: int = SHARE
) -> DataFrame:
    """``doc_id``, ``n_shingles`` (size of the set) and ``component_id`` (smallest id reachable by links, its own included) for every row.

    Words stand between white space, A-Z in lower case; a text with fewer words than a shingle is one shingle.
    Null, empty and blank texts have no shingles and link with nothing, not even with each other.  Null ids have no part in the smallest
    id; ``component_id`` is null in a group of such rows only.  Repeated rows share their group.  Other columns are not
    touched.  The text of a class is compared from its words; equal sets are told by 128 bits over 64-bit hashes of their shingles.
    """
    if not 0 < share <= 100:
        raise ValueError("share is a percentage above 0")
    ship_package(docs.sparkSession)
    known = shingle_sets(docs, id_col, text_col, width, share)
    classes = known.where("n > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("members"), F.min(F.when(F.col("text").isNotNull(), F.col("row"))).alias("row")
    )
    classes = materialize(classes, "jaccard-classes")
    first = classes.where("row is not null").select("row")
    sets = known.where("text is not null").join(broadcast_if_small(first), "row", "left_semi")
    # The most typical set, with the fewest shingles of its own, gets the smallest number.
    sets = number_rows(sets, [F.col("own") / F.col("n"), "set_key"], "node")
    roots = linked_groups(sets, width, share)
    rooted = sets.select("set_key", "node").join(roots, "node").select("set_key", "root")
    placed = materialize(classes.join(rooted, "set_key", "left"), "jaccard-rooted")
    least = placed.where("root is not null").groupBy("root").agg(F.min("low").alias("group_low"))
    grouped = placed.join(least, "root", "left").select(
        "set_key", "members", "low", F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("group_low")).alias("component_id")
    )
    # Only classes of several rows, or whose group has a smaller id, tell their rows something new.
    told = grouped.where((F.col("members") > 1) | ~F.col("component_id").eqNullSafe(F.col("low"))).select(
        "set_key", "component_id", F.lit(True).alias("told")
    )
    told = materialize(told, "jaccard-told")
    return known.join(broadcast_if_small(told), "set_key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("told"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )

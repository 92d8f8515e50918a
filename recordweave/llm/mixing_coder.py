"""Token-id files packed by an adaptive context-mixing range coder.

Ids are cut into blocks.  Every block starts from the same state, has a checksum and can be read
without the others.  Within a block three predictions of the next id are mixed into one distribution:

* order 2: the id that last followed the two ids before, with a confidence from its hits;
* order 1: the id that last followed the id before, likewise;
* order 0: the ids of the segment by frequency.

An interval is divided into "as order 2 says", "as order 1 says" and "neither"; the shares
adapt, and are kept for each combination of the two confidences and whether both predict the same.
The part "neither" is divided among all ids by their order-0 frequency.  Both totals are powers of two, so the intervals
are coded by the range variant of asymmetric numeral systems (rANS): writing goes from the last id to the first,
reading needs no division, and a state gives off or takes in one word an id at most.

A model that adapts id by id can't be run over a block at once, but many blocks can be run side
by side: one step codes the k-th id of every block of a segment, as NumPy operations over the blocks.
What needs no earlier step (the places in the tables, the shares to write) is done for many steps at once.

File: segments, each with header, order-0 table, a directory (ids, words, checksum) and the words of its
blocks; then the documents (id, number of ids); at the end the place of the documents and a mark.
All numbers are little-endian.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordweave.llm.common import materialize, ship_package, slices
from recordweave.llm.files import listed, make_folder, partition_number, write_file
from recordweave.llm.tokens import encoder

TOKENIZER, END_ID = "byte_bpe_50k.json", 2
#: Pieces of text whose ids a worker remembers, some 200 bytes each.
PIECES = 1_000_000
#: Rows, and bytes of text, whose pieces are looked up together.
ROWS, BYTES = 1 << 14, 8 << 20
#: Ids in a block, and blocks in a segment, which run side by side.  A file's last segment has up to half as many more, since few blocks take
#: nearly as long as many.
BLOCK, LANES = 2048, 2048
#: Bits of the order-1 and order-2 table of a block.
_HASH_1, _HASH_2 = 10, 11
#: The shares of the predictions, and the order-0 frequencies of a segment, sum to two to these powers.
_MIX_BITS, _SHARE_BITS = 12, 18
#: States lie between these powers of two; a word is 32 bits.
_LEAST, _MOST, _WORD = 31, 63, np.uint64(32)
#: An entry is an id above seven bits; order 1 has its confidence in the bits from the first on, order 2 from the fourth.
_ID, _STEP = 7, np.array([[1 << 1], [1 << 4]], np.uint32)
_SURE, _TRUSTED, _PLAIN = 7 * _STEP, 6 * _STEP, ~(7 * _STEP)
_CONTEXTS = 1 << _ID
#: Two shares of 16 bits in one number, order 2 below order 1: they lose a part of this power, and the one that was right gains this.
_RATE, _GAIN = 5, (1 << 11) - 32
_KEPT = np.uint32((0xFFFF >> _RATE) * 0x10001)
_GAINS = np.array([_GAIN, _GAIN << 16, 0], np.uint32)
#: Steps for which an array is made at once.
_STEPS = 16
_SEGMENT, _FILE = b"RWS2", b"RWF1"


def _first_shares() -> np.ndarray:
    """The shares a block begins with: more for a prediction with more hits, none for order 1 where it says the same as order 2."""
    context = np.arange(_CONTEXTS)
    hits_2, hits_1, same = context >> 4, context >> 1 & 7, context & 1
    by_2 = hits_2 / (hits_2 + 3)
    by_1 = (1 - by_2) * hits_1 / (hits_1 + 6) * (1 - same)
    return ((by_2 * 64000).astype(np.uint32) | (by_1 * 64000).astype(np.uint32) << 16).astype(np.uint32)


class Predictions:
    """The order-1 and order-2 tables of all blocks, and the shares that mix them."""

    def __init__(self, lanes: int) -> None:
        at = np.arange(lanes)
        # both tables in one array, order 1 before order 2
        self.entries = np.zeros((lanes << _HASH_1) + (lanes << _HASH_2), np.uint32)
        self.entry_at = np.stack([at << _HASH_1, (lanes << _HASH_1) + (at << _HASH_2)])
        self.share_at = at * _CONTEXTS
        self.shares = np.tile(_first_shares(), lanes)

    def places(self, last: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Where the entries for the two ids before are, for order 1 and order 2; the last axis is the first blocks."""
        k = last.shape[-1]
        out = np.empty((*last.shape[:-1], 2, k), np.int64)
        out[..., 0, :] = last & ((1 << _HASH_1) - 1)
        out[..., 1, :] = (last * 30011 + before) & ((1 << _HASH_2) - 1)
        out += self.entry_at[:, :k]
        return out

    def predict(self, places: np.ndarray) -> np.ndarray:
        """Look up what the first blocks expect, and return the two shares of their contexts."""
        # all places are inside the tables; NumPy is faster when told not to raise
        self.at = places
        self.found = self.entries.take(places, mode="clip")
        first, second = self.found
        same = ((first ^ second) < _CONTEXTS).astype(np.uint32)
        self.context = ((first | second) & (_CONTEXTS - 2) | same).astype(np.int64)
        self.context += self.share_at[: len(first)]
        self.row = self.shares.take(self.context, mode="clip")
        return self.row

    def learn(self, ids: np.ndarray) -> np.ndarray:
        """Take in the ids that came (shifted), and return which prediction they were (0: order 2, 1: order 1, 2: neither).

        An entry that was right grows in confidence; one that was wrong is replaced, but loses its trust first if it has earned some.
        """
        found = self.found
        hit = (found ^ ids) < _CONTEXTS
        by_1, by_2 = hit.view(np.uint8)
        choice = (2 - by_1) * (1 - by_2)
        self.shares[self.context] = self.row - (self.row >> _RATE & _KEPT) + _GAINS.take(choice, mode="clip")
        missed = np.where(found & _TRUSTED, found & _PLAIN, ids) | _STEP
        self.entries[self.at] = np.where(hit, np.minimum(found + _STEP, found | _SURE), missed)
        return choice


def _edges(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where order 1 and "neither" begin in two to the power of ``_MIX_BITS``, from the two shares."""
    least = ((row & 0xFFFF) >> 16 - _MIX_BITS) + 1
    return least, least + ((row >> 32 - _MIX_BITS) + 1)


def _interval(least: np.ndarray, edge: np.ndarray, not_2: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the interval of what came begins, and its size; sums that wrap around take half the time of a choice by ``where``."""
    not_2, rest, middle = not_2.astype(np.uint32), rest.astype(np.uint32), edge - least
    return not_2 * least + rest * middle, least + not_2 * (middle - least) + rest * ((1 << _MIX_BITS) - edge - middle)


def _order_0(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids that occur, and frequencies of at least one that sum to the total."""
    times = np.bincount(ids)
    found = np.flatnonzero(times)
    times = times[found]
    share = np.maximum(1, times * ((1 << _SHARE_BITS) - len(found)) // times.sum())
    share[share.argmax()] += (1 << _SHARE_BITS) - share.sum()
    return found, share


def _blocks(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks by falling length, and for each step how many blocks still run."""
    order = np.argsort(-lengths, kind="stable")
    return order, np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), side="left")


def _turn(rows: np.ndarray, out: np.ndarray) -> None:
    """Write the columns of ``rows`` as the rows of ``out``, by squares that stay in the cache."""
    for i in range(0, rows.shape[0], 64):
        for j in range(0, rows.shape[1], 64):
            out[j : j + 64, i : i + 64] = rows[i : i + 64, j : j + 64].T


def encode_segment(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A segment with all ``ids``, which are below 2^20."""
    ids = np.ascontiguousarray(ids, np.uint32)
    count = -(-len(ids) // block)
    longest = min(block, len(ids))
    lengths = np.minimum(block, len(ids) - np.arange(count) * block)  # only the last may be shorter, so they fall
    running = _blocks(lengths)[1].tolist()
    known, share = _order_0(ids) if len(ids) else (np.empty(0, np.int64), np.empty(0, np.int64))
    share_of = np.zeros(int(known[-1]) + 1 if len(known) else 1, np.uint32)
    below_of = share_of.copy()
    share_of[known], below_of[known] = share, np.cumsum(share) - share
    # a row for each step, after two of zeros
    steps = np.zeros((longest + 2, count), np.uint32)
    whole = len(ids) // max(1, longest)
    _turn(ids[: whole * longest].reshape(whole, longest), steps[2:, :whole])
    if whole < count:
        steps[2 : 2 + lengths[-1], whole] = ids[whole * longest :]

    model = Predictions(count)
    rows, choices = np.zeros((longest, count), np.uint32), np.zeros((longest, count), np.uint8)
    for start in range(0, longest, _STEPS):
        end = min(longest, start + _STEPS)
        places = model.places(steps[start + 1 : end + 1], steps[start:end])
        shifted = steps[start + 2 : end + 2] << _ID
        for step, k in enumerate(running[start:end]):
            rows[start + step, :k] = model.predict(places[step, :, :k])
            choices[start + step, :k] = model.learn(shifted[step, :k])

    room = longest + 2
    words, at = np.zeros(count * room, np.uint32), np.arange(1, count + 1) * room
    state = np.full(count, 1 << _LEAST, np.uint64)
    for start in reversed(range(0, longest, _STEPS)):
        end = min(longest, start + _STEPS)
        rest = choices[start:end] == 2
        low, size = _interval(*_edges(rows[start:end]), choices[start:end] > 0, rest)
        low, size = low.astype(np.uint64), size.astype(np.uint64)
        now = steps[start + 2 : end + 2]
        size_0 = np.where(rest, share_of.take(now, mode="clip"), np.uint32(1 << _SHARE_BITS)).astype(np.uint64)
        low_0 = np.where(rest, below_of.take(now, mode="clip"), np.uint32(0)).astype(np.uint64)
        limit = size * size_0 << np.uint64(_MOST - _MIX_BITS - _SHARE_BITS)
        more, more_0 = np.uint64(1 << _MIX_BITS) - size, np.uint64(1 << _SHARE_BITS) - size_0
        for step in reversed(range(end - start)):
            k = running[start + step]
            x = state[:k]
            who = np.flatnonzero(x >= limit[step, :k])
            if len(who):
                full, spots = x[who], at[who] - 1
                words[spots], at[who], x[who] = full & np.uint64(0xFFFFFFFF), spots, full >> _WORD
            x += x // size_0[step, :k] * more_0[step, :k] + low_0[step, :k]
            x += x // size[step, :k] * more[step, :k] + low[step, :k]
    for part in (state >> _WORD, state & np.uint64(0xFFFFFFFF)):
        at -= 1
        words[at] = part
    ends = np.arange(1, count + 1) * room
    parts = [words[i:j].astype("<u4", copy=False).tobytes() for i, j in zip(at.tolist(), ends.tolist(), strict=True)]
    raw = ids.astype("<u4", copy=False).tobytes()
    sums = [zlib.crc32(raw[4 * s : 4 * (s + block)]) for s in range(0, len(ids), block)]
    table = np.stack([known, share]).astype("<u4").tobytes()
    directory = np.stack([lengths, ends - at, np.array(sums, np.int64)]).astype("<u4").tobytes()
    head = struct.pack("<IIII", block, count, len(known), zlib.crc32(table + directory))
    return _SEGMENT + head + table + directory + b"".join(parts)


def decode_segment(data: bytes, at: int = 0, only: np.ndarray | None = None) -> tuple[np.ndarray, int]:
    """The ids of the segment that begins at ``at``, and where it ends.  ``only`` picks blocks by number."""
    if data[at : at + 4] != _SEGMENT:
        raise ValueError("no segment here")
    _, count, size, check = struct.unpack_from("<IIII", data, at + 4)
    at += 20
    if zlib.crc32(data[at : at + 8 * size + 12 * count]) != check:
        raise ValueError("segment header is damaged")
    known, share = np.frombuffer(data, "<u4", 2 * size, at).reshape(2, size).astype(np.uint32)
    at += 8 * size
    lengths, words, sums = np.frombuffer(data, "<u4", 3 * count, at).reshape(3, count).astype(np.int64)
    at += 12 * count
    end = at + 4 * int(words.sum())
    stream = np.frombuffer(data, "<u4", int(words.sum()), at).astype(np.uint64)
    starts = np.cumsum(words) - words
    if only is not None:
        lengths, starts, sums = lengths[only], starts[only], sums[only]
    order, running = _blocks(lengths)
    # number, size and begin of the id's part in one, and the id's place in that table for every value below the order-0 total
    begin = np.cumsum(share, dtype=np.uint64) - share
    table = known.astype(np.uint64) << np.uint64(2 * _SHARE_BITS) | share.astype(np.uint64) - np.uint64(1) << np.uint64(_SHARE_BITS) | begin
    place_at = np.repeat(np.arange(size, dtype=np.uint16 if size <= 1 << 16 else np.uint32), share)
    below = np.uint64((1 << _SHARE_BITS) - 1)
    steps = np.zeros((len(running) + 2, len(order)), np.uint32)
    model, at = Predictions(len(order)), starts[order] + 2
    state = stream[at - 2] | stream[at - 1] << _WORD
    for step, k in enumerate(running.tolist()):
        least, edge = _edges(model.predict(model.places(steps[step + 1, :k], steps[step, :k])))
        x = state[:k]
        value = x.astype(np.uint32) & ((1 << _MIX_BITS) - 1)
        not_2, rest = value >= least, value >= edge
        low, parts = _interval(least, edge, not_2, rest)
        x >>= np.uint64(_MIX_BITS)
        x *= parts
        x += value - low
        now = np.where(not_2, model.found[0], model.found[1]) >> _ID
        who = np.flatnonzero(rest)
        if len(who):
            own = x[who]
            spot = own & below
            found = table.take(place_at.take(spot.astype(np.int64), mode="clip"), mode="clip")
            now[who] = found >> np.uint64(2 * _SHARE_BITS)
            x[who] = ((found >> np.uint64(_SHARE_BITS) & below) + np.uint64(1)) * (own >> np.uint64(_SHARE_BITS)) + (spot - (found & below))
        who = np.flatnonzero(x < np.uint64(1 << _LEAST))
        if len(who):
            spots = at[who]
            x[who] = x[who] << _WORD | stream[spots]
            at[who] = spots + 1
        steps[step + 2, :k] = now
        model.learn(now << _ID)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    streams = np.empty((len(order), len(running)), np.uint32)
    _turn(steps[2:], streams)
    blocks = [streams[i, :n] for i, n in zip(back.tolist(), lengths.tolist(), strict=True)]
    ids = np.concatenate(blocks) if blocks else np.empty(0, np.uint32)
    raw, place = memoryview(ids.astype("<u4", copy=False)).cast("B"), 0
    for n, c in zip(lengths.tolist(), sums.tolist(), strict=True):
        if zlib.crc32(raw[place : place + 4 * n]) != c:
            raise ValueError("block is damaged")
        place += 4 * n
    return ids, end


def encode_file(batches: Iterator[tuple[list[int | None], list[bytes]]], block: int = BLOCK, lanes: int = LANES) -> Iterator[bytes]:
    """The bytes of a file from documents' ids (unsigned 32-bit) in their order, one segment after the other."""
    held, size, place = [], 0, 0
    docs, counts = [], []
    for names, texts in batches:
        docs += names
        for raw in texts:
            counts.append(len(raw) // 4)
            held.append(raw)
            size += len(raw) // 4
        while 2 * size >= 3 * block * lanes:
            ids = np.frombuffer(b"".join(held), "<u4")
            part = encode_segment(ids[: block * lanes], block)
            held, size = [ids[block * lanes :].tobytes()], size - block * lanes
            place += len(part)
            yield part
    if size:
        part = encode_segment(np.frombuffer(b"".join(held), "<u4"), block)
        place += len(part)
        yield part
    known = np.array([d is not None for d in docs], np.uint8)
    numbers = np.array([d or 0 for d in docs], "<i8")
    table = zlib.compress(known.tobytes() + numbers.tobytes() + np.array(counts, "<u4").tobytes(), 1)
    yield table + struct.pack("<QIII", place, len(docs), len(table), zlib.crc32(table)) + _FILE


def decode_file(data: bytes) -> Iterator[tuple[int | None, int, bytes]]:
    """(id, ids of the file's documents before it, its ids) of every document, in order; one segment is unpacked at a time."""
    if data[-4:] != _FILE:
        raise ValueError("no end of file")
    place, count, size, check = struct.unpack_from("<QIII", data, len(data) - 24)
    packed = data[place : place + size]
    if zlib.crc32(packed) != check:
        raise ValueError("document table is damaged")
    table = zlib.decompress(packed)
    known = np.frombuffer(table, np.uint8, count)
    numbers = np.frombuffer(table, "<i8", count, count)
    counts = np.frombuffer(table, "<u4", count, 9 * count)
    at, held, used, before = 0, memoryview(b""), 0, 0
    for is_known, number, need in zip(known.tolist(), numbers.tolist(), counts.tolist(), strict=True):
        parts, missing = [], 4 * need
        while missing > len(held) - used:
            parts.append(held[used:])
            missing -= len(held) - used
            ids, at = decode_segment(data, at)
            held, used = memoryview(ids.astype("<u4").tobytes()), 0
        parts.append(held[used : used + missing])
        used += missing
        yield (number if is_known else None), before, b"".join(parts)
        before += need


def write_ids(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, end_id: int = END_ID
) -> DataFrame:
    """Write the ids of all rows into ``folder`` in ascending order of their id, one file for each range; ``file``, ``n_ids``, ``bytes``.

    Null ids come first; rows with one id are in the order of their text's hash.  Null and empty texts are the end id alone.
    Repeated rows are written each.  An empty table writes no file.  Other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    make_folder(folder)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, total = encoder(tokenizer, PIECES), 0

        def documents() -> Iterator[tuple[list[int | None], list[bytes]]]:
            nonlocal total
            for batch in slices(batches, "text", ROWS, BYTES):
                ids = [raw + last for raw in made.encode_many(batch.column("text").to_pylist())]
                total += sum(map(len, ids)) // 4
                yield batch.column("doc_id").to_pylist(), ids

        feed = documents()
        head = next(feed, None)
        if head is None:
            return

        def chained() -> Iterator[tuple[list[int | None], list[bytes]]]:
            yield head
            yield from feed

        name, size = write_file(folder, f"part-{partition_number():06d}", ".ids", encode_file(chained()))
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([total]), pa.array([size])], ["file", "n_ids", "bytes"])

    return materialize(ranged.mapInArrow(run, "file string, n_ids bigint, bytes bigint"), "id-files")


def read_ids(spark: SparkSession, folder: str, files: DataFrame, keep_ids: bool = False) -> DataFrame:
    """Read the files back: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``, and ``ids`` if asked for.

    ``files`` is what ``write_ids`` returned.  Damage is an error, as every block and table has its checksum.
    """
    ship_package(spark)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder).select("path", "content")
    found = listed(found, files)
    names = ["file", "doc_id", "local", "n_tokens", "ids_crc32"] + ["ids"] * keep_ids
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for i in range(len(batch)):
                name, rows, held = batch.column(0)[i].as_py().rsplit("/", 1)[1], [], 0
                for doc, before, raw in decode_file(batch.column(1)[i].as_py()):
                    rows.append((name, doc, before, len(raw) // 4, zlib.crc32(raw), *[raw] * keep_ids))
                    held += len(raw) * keep_ids
                    if len(rows) >= 8192 or held > 4 << 20:
                        yield packed(rows)
                        rows, held = [], 0
                if rows:
                    yield packed(rows)

    schema = "file string, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    read = found.mapInArrow(run, schema)
    # one row for each file, so the running sum over all of them is short
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("offset"))
    placed = read.join(F.broadcast(offsets), "file")
    return placed.select(
        "doc_id", (F.col("offset") + F.col("local")).cast("bigint").alias("start"), "n_tokens", "ids_crc32", *["ids"] * keep_ids
    )

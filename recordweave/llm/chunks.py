"""Texts in chunks, hashes of their word n-grams, and counts of such hashes over all chunks.

A chunk is a few MB of neighbouring rows, packed once into a table.  To learn how often its n-grams
occur everywhere, it sends their hashes out, one packed list to each bucket of the hash space; a bucket adds up
the lists of all chunks and answers each chunk with the hashes that are frequent enough.  An n-gram that occurs in very many
texts is thus sent once by each chunk, not once by each text, and no list of n-grams is held by the driver or
by all executors.  Buckets grow in number with the data, and with them the bits of a hash that tell n-grams apart.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordweave.llm.common import materialize, ship_package, slices
from recordweave.llm.files import partition_number

#: Bytes of text in a chunk, unless one text has more.
CHUNK_BYTES = 4 << 20
#: Hashes a bucket is meant to hold, at one for every ``BYTES_A_GRAM`` bytes of text.
BUCKET_GRAMS, BYTES_A_GRAM = 1 << 21, 6

CHUNKS = "chunk bigint, bytes bigint, payload binary"
REQUESTS = "bucket bigint, chunk bigint, grams binary, times binary"
REPLIES = "chunk bigint, bucket bigint, grams binary, totals binary"

Function = Callable[[pa.Table, "Totals"], pa.Table]


# --- chunks --------------------------------------------------------------------------------


def _packed(batches: Iterator[pa.RecordBatch], sized: str) -> Iterator[pa.RecordBatch]:
    held, size, number = [], 0, partition_number() << 32

    def chunk() -> pa.RecordBatch:
        out = pa.BufferOutputStream()
        table = pa.Table.from_batches(held)
        with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table)
        row = [[number], [size], [out.getvalue().to_pybytes()]]
        return pa.RecordBatch.from_arrays([pa.array(row[0], pa.int64()), pa.array(row[1], pa.int64()), pa.array(row[2], pa.binary())], ["chunk", "bytes", "payload"])

    for batch in slices(batches, sized):
        held.append(batch)
        size += batch.column(sized).nbytes
        if size >= CHUNK_BYTES:
            yield chunk()
            held, size, number = [], 0, number + 1
    if held:
        yield chunk()


def chunked(frame: DataFrame, sized: str, label: str) -> DataFrame:
    """The rows of ``frame`` as a table of chunks, which is written once so that a chunk keeps its number."""
    ship_package(frame.sparkSession)
    return materialize(frame.mapInArrow(partial(_packed, sized=sized), CHUNKS), label)


def unpacked(payload: pa.Scalar) -> pa.Table:
    with pa.ipc.open_stream(payload.as_buffer()) as reader:
        return reader.read_all()


def bucket_bits(chunks: DataFrame, lists: int = 1) -> int:
    """The logarithm of the number of buckets, for ``lists`` hashes at each place of the texts."""
    size = chunks.agg(F.sum("bytes")).first()[0] or 0
    return max(0, min(31, math.ceil(math.log2(max(1, lists * size / BYTES_A_GRAM / BUCKET_GRAMS)))))


# --- hashes of n-grams ----------------------------------------------------------------------


def numbered(texts: Sequence[Sequence[bytes]]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Words of all texts as numbers, end to end; the words by number; the starts of the texts and the end of the last."""
    number = defaultdict(count().__next__)
    parts = [np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for words in texts]
    ends = np.cumsum([0, *map(len, parts)])
    return np.concatenate(parts) if parts else np.empty(0, np.int64), list(number), ends


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, words: int, seed: int = 0) -> np.ndarray:
    """The hash of the ``words`` words from each place on, as far as there are so many."""
    size = max(0, len(hashes) - words + 1)
    out = np.full(size, seed * 64 + words, np.uint64)
    for k in range(words):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + size])
    return out


# --- counts over all chunks -----------------------------------------------------------------


class Totals:
    """What a chunk has been told about its n-grams."""

    def __init__(self, replies: pa.Table, bits: int) -> None:
        self.shift = np.uint64(32 - bits)
        keys = [np.empty(0, np.uint64)]
        totals = [np.empty(0, np.uint32)]
        for bucket, grams, times in zip(*(replies.column(c).to_pylist() for c in ("bucket", "grams", "totals")), strict=True):
            keys.append((np.uint64(bucket) << np.uint64(32)) | np.frombuffer(grams, np.uint32))
            totals.append(np.frombuffer(times, np.uint32))
        known = np.concatenate(keys)
        order = np.argsort(known, kind="stable")
        self.keys, self.totals = known[order], np.concatenate(totals)[order]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """How often each n-gram occurs, 0 where it is below the least count."""
        if not len(self.keys):
            return np.zeros(len(hashes), np.uint32)
        keys = hashes >> self.shift
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.totals[at], np.uint32(0))


def request(chunk: int, hashes: np.ndarray, times: np.ndarray, bits: int) -> pa.Table:
    """Rows of ``REQUESTS`` for the n-grams of a chunk, each given once, in ascending order."""
    bucket = hashes >> np.uint64(64 - bits) if bits else np.zeros(len(hashes), np.uint64)
    grams = (hashes >> np.uint64(32 - bits)).astype(np.uint32)
    cuts = np.r_[0, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket)] if len(bucket) else np.array([0])
    pairs = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
    times = times.astype(np.uint32)
    return pa.table({
        "bucket": pa.array([int(bucket[a]) for a, _ in pairs], pa.int64()),
        "chunk": pa.array([chunk] * len(pairs), pa.int64()),
        "grams": pa.array([grams[a:b].tobytes() for a, b in pairs], pa.binary()),
        "times": pa.array([times[a:b].tobytes() for a, b in pairs], pa.binary()),
    })


def counted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(hashes, return_counts=True)


def _tallied(table: pa.Table, least: int) -> pa.Table:
    chunk, bucket = table.column("chunk").to_pylist(), table.column("bucket")[0].as_py()
    grams = [np.frombuffer(g, np.uint32) for g in table.column("grams").to_pylist()]
    times = np.concatenate([np.frombuffer(t, np.uint32) for t in table.column("times").to_pylist()])
    known, place = np.unique(np.concatenate(grams), return_inverse=True)
    totals = np.bincount(place, weights=times)[place]
    ends = np.cumsum([0, *map(len, grams)])
    rows = []
    for i, own in enumerate(grams):
        total = totals[ends[i] : ends[i + 1]]
        kept = total >= least
        if kept.any():
            rows.append((chunk[i], bucket, own[kept].tobytes(), np.minimum(total[kept], 0xFFFFFFFF).astype(np.uint32).tobytes()))
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["chunk", "bucket", "grams", "totals"])


def tally(requests: DataFrame, least: int) -> DataFrame:
    """For each chunk its n-grams that occur ``least`` times or more in all chunks together, with that number.

    N-grams whose hashes agree in the bits told apart are counted as one, so a number may be too high, never too low, and is the same for every chunk.
    """

    def add_up(bucket: pa.Table) -> pa.Table:
        return _tallied(bucket, least)

    return requests.groupBy("bucket").applyInArrow(add_up, REPLIES)


def with_totals(chunks: DataFrame, replies: DataFrame, bits: int, function: Function, schema: str) -> DataFrame:
    """``function(rows of the chunk, number of the chunk, its totals)`` for every chunk."""

    def run(chunk: pa.Table, told: pa.Table) -> pa.Table:
        totals = Totals(told, bits)
        tables = [function(unpacked(p), c.as_py(), totals) for c, p in zip(chunk.column("chunk"), chunk.column("payload"), strict=True)]
        return pa.concat_tables(tables)

    # A chunk without a reply is still a group; one without rows does not exist.
    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(run, schema)


def each_chunk(chunks: DataFrame, function: Callable[[pa.Table, int], pa.Table], schema: str) -> DataFrame:
    """``function(rows of the chunk, number of the chunk)`` for every chunk, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, payload in zip(batch.column("chunk"), batch.column("payload"), strict=True):
                yield from function(unpacked(payload), chunk.as_py()).to_batches()

    return chunks.mapInArrow(run, schema)

"""Best-fit packing of token sequences by a configuration linear program.

The pieces of all documents form a histogram of lengths, at most ``capacity`` counts whatever the input.  A configuration is
a multiset of lengths that fits one sequence.  The linear program asks for the fewest
configurations that cover the histogram:

* Multiplicative weights.  Every length has a price.  The best configuration at these prices comes from a
  knapsack, solved by dynamic programming over the capacity.  It is taken as often as its
  scarcest length allows, and the prices of the lengths it holds fall by a factor.  The
  picks, scaled until all lengths are covered, are a fractional solution; the prices bound the optimum from below.
* Rounding.  Configurations are taken a whole number of times, as long as the pieces last; what remains is packed
  by best fit, longest first, into the rest of the sequences, on the histogram as well.

The plan is a list of configurations with their multiplicities.  Spark then numbers the pieces within
each length and deals number k the k-th place that the plan has for that length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordweave.llm.common import materialize, number_within, ship_package, slices
from recordweave.llm.tokens import encoder

CAPACITY = 4096
TOKENIZER, END_ID = "word_bpe_49k.json", 1
#: Rounds of the multiplicative weights, and the factor of a price for one full use.
ROUNDS, STEP = 120, 0.5
#: Lengths that take a configuration in a round.
PER_ROUND = 64
#: Parts of the fractional solution that are tried as whole configurations before the best fit; the best one counts.
#: The last is best fit alone, so a plan never takes more sequences than that.
SHARES = (1.0, 0.5, 0.2, 0.0)
#: Pieces of one length that one task numbers, about.
NUMBERED = 1 << 20


@dataclass(frozen=True)
class Plan:
    """Sequences by configuration: lengths (longest first) and how often, and a lower bound on their number."""

    configurations: tuple[tuple[tuple[int, ...], int], ...]
    lower_bound: float

    @property
    def sequences(self) -> int:
        return sum(times for _, times in self.configurations)


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every room: the worth of the dearest multiset of lengths that fits, and the length it ends with (-1: none)."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    stop = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(int(lengths[0]), capacity + 1):
        worth = best[room - lengths[: stop[room]]] + prices[: stop[room]]
        at = int(worth.argmax())
        if worth[at] > best[room - 1]:
            best[room], pick[room] = worth[at], at
        else:
            best[room] = best[room - 1]
    return best, pick


def configuration(lengths: np.ndarray, pick: np.ndarray, room: int, first: int | None = None) -> dict[int, int]:
    """Times each length (by place) is used in the dearest multiset for a room, or in the dearest that holds ``first``."""
    used: dict[int, int] = {}
    at = first
    while room > 0:
        if at is None:
            at = int(pick[room])
        if at < 0:
            room, at = room - 1, None
            continue
        used[at] = used.get(at, 0) + 1
        room, at = room - int(lengths[at]), None
    return used


Solution = dict[tuple[tuple[int, int], ...], float]


def fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[Solution, float]:
    """Configurations, as (place of a length, times) pairs, with multiplicities that cover all counts; and a lower bound of their sum.

    One knapsack a round prices the best configuration overall, which gives the bound, and the
    best one for each length.  The lengths covered least in proportion to their count take theirs.
    """
    prices = lengths / capacity
    picks: Solution = {}
    covered = np.zeros(len(lengths))
    bound = float(lengths @ counts) / capacity
    for _ in range(rounds):
        best, pick = knapsack(lengths, prices, capacity)
        bound = max(bound, float(prices @ counts) / best[capacity])  # at prices where no configuration is worth more than one
        share = np.zeros(len(lengths))
        for first in np.lexsort((-lengths, np.round(covered, 3)))[:PER_ROUND].tolist():
            if share[first] >= 1:
                continue
            used = configuration(lengths, pick, capacity, first)
            times = min(counts[i] / n for i, n in used.items())
            key = tuple(sorted(used.items()))
            picks[key] = picks.get(key, 0.0) + times
            for i, n in used.items():
                share[i] += n * times / counts[i]
        covered += share
        prices = prices * np.exp(-STEP * share)
        prices /= prices.max()
    scale = covered.min()
    if scale <= 0:  # fewer rounds than it takes to reach every length: these are left to the best fit
        scale = np.median(covered[covered > 0])
    return {key: times / scale for key, times in picks.items()}, bound


def _best_fit(lengths: list[int], counts: list[int], rooms: dict[int, list[list]], capacity: int) -> list[list]:
    """Pack what remains, longest first, each into the sequence with the least room that suffices.

    ``rooms`` maps free room to [configuration, times] entries, which are split as they fill.  Equal
    steps are made at once, so the work depends on the kinds of sequences and not on their number.
    """
    free = sorted(rooms)
    for length, count in sorted(zip(lengths, counts, strict=True), reverse=True):
        while count:
            at = bisect_left(free, length)
            if at == len(free):
                each = capacity // length
                times, rest = divmod(count, each)
                for size, many in ((each, times), (rest, 1)):
                    if size and many:
                        room = capacity - size * length
                        rooms.setdefault(room, []).append([(length,) * size, many])
                        if room not in free:
                            free.insert(bisect_left(free, room), room)
                count = 0
                break
            room = free[at]
            held, times = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                free.pop(at)
            many = min(times, count)
            if times > many:
                rooms.setdefault(room, []).append([held, times - many])
                if room not in free:
                    free.insert(bisect_left(free, room), room)
            left = room - length
            rooms.setdefault(left, []).append([held + (length,), many])
            if left not in free:
                free.insert(bisect_left(free, left), left)
            count -= many
    return [entry for entries in rooms.values() for entry in entries]


def _rounded(solved: Solution, lengths: np.ndarray, histogram: dict[int, int], capacity: int, share: float) -> list[list]:
    """Whole numbers of configurations: ``share`` of the fractional solution, the most used first; the rest by best fit."""
    remaining = [histogram[int(x)] for x in lengths]
    rooms: dict[int, list[list]] = {}
    for used, times in sorted(solved.items(), key=lambda s: (-s[1], s[0])):
        many = min(int(np.ceil(share * times)), *(remaining[i] // n for i, n in used))
        if many > 0:
            for i, n in used:
                remaining[i] -= n * many
            config = tuple(int(lengths[i]) for i, n in reversed(used) for _ in range(n))
            rooms.setdefault(capacity - sum(config), []).append([config, many])
    return _best_fit(lengths.tolist(), remaining, rooms, capacity)


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    """Configurations that hold every piece of the histogram once; lengths from 1 to ``capacity``."""
    if not histogram:
        return Plan((), 0.0)
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[int(x)] for x in lengths], np.float64)
    solved, bound = fractional(lengths, counts, capacity, rounds)
    rounded = [_rounded(solved, lengths, histogram, capacity, share) for share in SHARES]
    first = min(rounded, key=lambda entries: sum(times for _, times in entries))
    merged: dict[tuple[int, ...], int] = {}
    for config, times in first:
        key = tuple(sorted(config, reverse=True))
        merged[key] = merged.get(key, 0) + times
    return Plan(tuple(sorted(merged.items(), reverse=True)), max(bound, 0.0))


@dataclass(frozen=True)
class Places:
    """For one length: where the numbered pieces go.  Entry i takes the numbers from ``first[i]`` on."""

    first: np.ndarray
    sequence: np.ndarray  # of the first of them
    each: np.ndarray  # places of this length in one sequence
    offset: np.ndarray  # of the first place


def places(made: Plan) -> dict[int, Places]:
    entries: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for config, times in made.configurations:
        offset = 0
        for length in sorted(set(config), reverse=True):
            each = config.count(length)
            start = taken.get(length, 0)
            entries.setdefault(length, []).append((start, sequence, each, offset))
            taken[length] = start + each * times
            offset += each * length
        sequence += times
    return {length: Places(*np.array(rows, np.int64).T) for length, rows in entries.items()}


def pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, tokenizer: str, end_id: int, keep_ids: bool) -> DataFrame:
    """The token pieces of every row: at most ``capacity`` tokens each, cut only where a document is longer."""
    ship_package(docs.sparkSession)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * keep_ids
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(tokenizer)
        for batch in slices(batches, "text"):
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), made.encode(batch.column("text").to_pylist()), strict=True):
                ids += last
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part), *[part] * keep_ids))
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    chosen = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text"))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    return chosen.mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``, and ``ids`` if asked for.

    Null and empty texts are the end id alone.  A document of more than ``capacity`` tokens is cut into
    full pieces and a last one; no other is cut.  Repeated rows and null ids are packed each.  An empty table
    gives no rows.  Places of one sequence are filled from 0 without a gap.  Other columns are not read.
    The driver sees the histogram (``capacity`` numbers) and the plan, never pieces.
    """
    spark = docs.sparkSession
    table = materialize(pieces(docs, id_col, text_col, capacity, tokenizer, end_id, keep_ids), "pieces")
    histogram = {r.length: r.n for r in table.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    where = spark.sparkContext.broadcast(places(plan(histogram, capacity)))
    buckets = max(1, -(-max(histogram.values(), default=1) // NUMBERED))
    names = table.columns
    numbered = number_within(
        table.withColumn("_length", F.col("length")), ["_length"],
        F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)), ["doc_id", "piece", "ids_crc32"], "number",
    ).drop("_length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = where.value
        for batch in batches:
            number, length = (batch.column(c).to_numpy() for c in ("number", "length"))
            sequence, offset = np.empty(len(batch), np.int64), np.empty(len(batch), np.int64)
            for size in np.unique(length):
                rows, at = np.flatnonzero(length == size), known[int(size)]
                entry = np.searchsorted(at.first, number[rows], side="right") - 1
                turn, spot = np.divmod(number[rows] - at.first[entry], at.each[entry])
                sequence[rows] = at.sequence[entry] + turn
                offset[rows] = at.offset[entry] + spot * size
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
    placed = numbered.mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint")
    order = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return placed.select(*order, *["ids"] * keep_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, ``ids`` (32-bit little-endian) of whole sequences, from ``pack(..., keep_ids=True)``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda done, part: F.concat(done, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))

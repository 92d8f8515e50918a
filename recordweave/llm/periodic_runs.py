"""Periodic runs of words by block convolution.

A run is a maximal stretch of words that repeats with its smallest period ``q`` at least ``EXPONENT`` times.
The texts of a batch are laid end to end as one sequence of word numbers, with a number of its own
between two texts, so that nothing matches across them.

* Scale ``L`` = 1, 2, 4, ... looks for periods from ``L`` to ``2 L - 1``.  The sequence is cut into blocks of ``L``
  words.  A run with such a period holds two or more neighbouring blocks that come again one period later.
* A block's sum of squared differences to each place of the window behind it is a correlation, computed by number-theoretic
  transforms modulo primes.  The sum is zero only where all words agree; it is taken modulo as many primes as make
  their product larger than any possible sum, so the test is exact.
* A block that holds a word which does not come again within ``2 L`` words can't match and is not convolved; nor is a block that
  lies, with its window, inside a run already found: it matches only at multiples of that run's period.
* Distances that neighbouring blocks share seed a stretch, which is extended word by word by less than a block
  at each end.

Stretches at multiples of a smaller period have the ends of the run with that period, which was found at a smaller scale; the
smallest period for given ends counts.  A scale costs O(n log n), and nothing is quadratic in long or
highly repetitive texts.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache, partial
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordweave.llm.common import ship_package, slices

MIN_WORDS, EXPONENT = 6, 4
#: Numbers a transform holds at once.
TRANSFORM_CELLS = 1 << 18
# Primes below 2^31 with 2^24 or more as the power of two in p - 1, each with a primitive root.
PRIMES = ((2013265921, 31), (469762049, 3), (754974721, 11), (167772161, 3))

SCHEMA = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


# --- number-theoretic transforms ---------------------------------------------------------


@cache
def _powers(size: int, prime: int, root: int) -> np.ndarray:
    """The first ``size / 2`` powers of a root of unity of order ``size``."""
    step = pow(root, (prime - 1) // size, prime)
    out = np.ones(max(1, size // 2), np.uint64)
    done = 1
    while done < len(out):
        out[done : 2 * done] = out[:done] * np.uint64(pow(step, done, prime)) % np.uint64(prime)
        done *= 2
    return out


def transform(rows: np.ndarray, prime: int, root: int) -> np.ndarray:
    """The transform of every row (length a power of two) modulo ``prime``, in natural order.

    Each step halves the part of the index that is still in place and doubles the part that is transformed.
    """
    p, size = np.uint64(prime), rows.shape[1]
    done, left = 1, size
    values = rows.reshape(len(rows), 1, size)
    while left > 1:
        half = left // 2
        even, odd = values[:, :, :half], values[:, :, half:]
        total = even + odd
        total -= p * (total >= p)
        apart = even + (p - odd)
        apart -= p * (apart >= p)
        apart = apart * _powers(left, prime, root)[None, None, :half] % p
        values = np.stack([total, apart], axis=2)  # (rows, done, 2, half): the new bit of the result's index
        # The bit found now is the next higher one of the result.
        values = values.transpose(0, 2, 1, 3).reshape(len(rows), 2 * done, half)
        done, left = 2 * done, half
    return values.reshape(len(rows), size)


def correlations(blocks: np.ndarray, windows: np.ndarray, prime: int, root: int) -> np.ndarray:
    """Cyclic correlation of each block (padded with zeros) with its window, modulo ``prime``."""
    p, size = np.uint64(prime), blocks.shape[1]
    a, b = transform(blocks, prime, root), transform(windows, prime, root)
    back = np.r_[0, np.arange(size - 1, 0, -1)]
    product = transform(a[:, back] * b % p, prime, root)[:, back]
    return product * np.uint64(pow(size, -1, prime)) % p


def zero_mismatches(words: np.ndarray, starts: np.ndarray, scale: int, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) of every place ``scale`` to ``2 scale - 1`` words on where a block comes again.

    ``words`` are numbers from 1 to ``bound``, followed by zeros to fill the last windows.
    """
    size, place = 2 * scale, np.arange(2 * scale)
    own = words[starts[:, None] + place[:scale]].astype(np.uint64)
    later = words[starts[:, None] + scale + place].astype(np.uint64)
    later[:, -1] = 0
    row, at = np.arange(len(starts)), None
    limit, reached = scale * bound * bound, 1
    for prime, root in PRIMES:
        p = np.uint64(prime)
        block = np.zeros((len(row), size), np.uint64)
        block[:, :scale] = own[row] % p
        window = later[row] % p
        squares = np.zeros((len(row), size + 1), np.uint64)
        np.cumsum(window * window % p, axis=1, out=squares[:, 1:])
        fixed = (block * block % p).sum(axis=1, keepdims=True)
        there = squares[:, scale : 2 * scale] - squares[:, :scale]
        twice = 2 * correlations(block, window, prime, root)[:, :scale] % p
        zero = ((fixed + there + (p - twice)) % p) == 0
        at = zero if at is None else at & zero
        kept = at.any(axis=1)
        row, at, reached = row[kept], at[kept], reached * prime
        if reached > limit or not len(row):
            break
    else:
        raise ValueError("too many different words for the primes")
    i, shift = np.nonzero(at)
    return starts[row[i]], shift + scale


# --- runs --------------------------------------------------------------------------------


def next_distance(words: np.ndarray) -> np.ndarray:
    """How many words on the same word comes again; beyond the end where it does not."""
    order = np.argsort(words, kind="stable")
    same = words[order[1:]] == words[order[:-1]]
    out = np.full(len(words), len(words) + 1, np.int64)
    out[order[:-1][same]] = np.diff(order)[same]
    return out


def _inside(found: np.ndarray, low: np.ndarray, high: np.ndarray, distance: np.ndarray | None = None) -> np.ndarray:
    """Whether [low, high) lies in a found run, one whose period divides ``distance`` if that is given."""
    if not len(found):
        return np.zeros(len(low), bool)
    found = found[np.argsort(found[:, 0], kind="stable")]
    # Two runs that both hold a stretch as long as their periods together are one, so the one that reaches furthest decides.
    far = np.maximum.accumulate(found[:, 1])
    furthest = np.maximum.accumulate(np.where(found[:, 1] == far, np.arange(len(found)), 0))
    at = np.searchsorted(found[:, 0], low, side="right") - 1
    run = found[furthest[np.maximum(at, 0)]]
    held = (at >= 0) & (run[:, 1] >= high)
    return held if distance is None else held & (distance % run[:, 2] == 0)


def _extend(words: np.ndarray, first: np.ndarray, last: np.ndarray, distance: np.ndarray, scale: int, size: int) -> np.ndarray:
    """(start, end, period) of the stretches around the chains of blocks, with at most ``scale`` words looked at on each side."""
    out = np.empty((len(first), 3), np.int64)
    place = np.arange(scale)
    for low in range(0, len(first), max(1, TRANSFORM_CELLS // scale)):
        part = slice(low, low + max(1, TRANSFORM_CELLS // scale))
        d = distance[part, None]
        left, right = first[part, None] - 1 - place, last[part, None] + scale + place
        fits = left >= 0
        same = fits & (words[np.where(fits, left, 0)] == words[np.where(fits, left + d, 1)])
        before = np.where(same.all(axis=1), scale, same.argmin(axis=1))
        fits = right + d < size
        same = fits & (words[np.where(fits, right, 0)] == words[np.where(fits, right + d, 1)])
        after = np.where(same.all(axis=1), scale, same.argmin(axis=1))
        out[part, 0] = first[part] - before
        out[part, 1] = last[part] + scale + after + distance[part]
        out[part, 2] = distance[part]
    return out


def find_runs(words: np.ndarray, min_words: int = MIN_WORDS, exponent: int = EXPONENT) -> np.ndarray:
    """(start, end, period) of every run in a sequence of numbers from 1 on, by start, then period.

    ``exponent`` is 4 or more: shorter repeats need not hold two whole blocks.
    """
    if exponent < 4 or min_words < 6:
        raise ValueError("runs must hold four periods and six words at least")
    size = len(words)
    found = np.empty((0, 3), np.int64)
    if size < min_words:
        return found
    bound = int(words.max())
    ahead = next_distance(words)
    filled = np.concatenate([words, np.zeros(3 * size, words.dtype)[: 3 * (1 << max(0, (size // exponent)).bit_length())]])
    scale = 1
    while scale * exponent <= size:
        whole = size // scale
        furthest = ahead[: whole * scale].reshape(whole, scale).max(axis=1)
        may = furthest < 2 * scale
        # A chain has two blocks or more.
        may &= np.r_[may[1:], False] | np.r_[False, may[:-1]]
        starts = np.flatnonzero(may) * scale
        starts = starts[~_inside(found, starts, np.minimum(starts + 3 * scale, size))]
        blocks, distances, step = [], [], max(1, TRANSFORM_CELLS // (2 * scale))
        for low in range(0, len(starts), step):
            block, distance = zero_mismatches(filled, starts[low : low + step], scale, bound)
            blocks.append(block)
            distances.append(distance)
        if blocks:
            found = _with_chains(found, words, np.concatenate(blocks), np.concatenate(distances), scale, min_words, exponent)
        scale *= 2
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _with_chains(
    found: np.ndarray, words: np.ndarray, block: np.ndarray, distance: np.ndarray, scale: int, min_words: int, exponent: int
) -> np.ndarray:
    """The runs found so far and those that the matches of one scale seed."""
    order = np.lexsort((block, distance))
    block, distance = block[order], distance[order]
    opens = np.ones(len(block), bool)
    opens[1:] = (distance[1:] != distance[:-1]) | (block[1:] != block[:-1] + scale)
    at = np.flatnonzero(opens)
    first, d = block[at], distance[at]
    last = block[np.r_[at[1:], len(block)] - 1] if len(at) else first
    wanted = (last > first) & ~_inside(found, first, last + scale + d, d)
    first, last, d = first[wanted], last[wanted], d[wanted]
    if not len(first):
        return found
    new = _extend(words, first, last, d, scale, len(words))
    length = new[:, 1] - new[:, 0]
    new = new[length >= np.maximum(min_words, exponent * new[:, 2])]
    both = np.concatenate([found, new])
    both = both[np.lexsort((both[:, 2], both[:, 1], both[:, 0]))]
    fresh = np.ones(len(both), bool)
    fresh[1:] = (both[1:, :2] != both[:-1, :2]).any(axis=1)
    return both[fresh]


# --- documents -----------------------------------------------------------------------------


def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """Places of the original words that a text of ``n`` words is made of, where its id asks for a planted repeat."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


def _summary(doc_id: int | None, words: list[bytes], runs: np.ndarray) -> tuple:
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs.tolist())
    kept = words
    if len(runs):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 1], -1)
        kept = [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()]
    best = (None, None, None)
    for s, e, q in runs.tolist():  # by start, then period, so that the first of equal ones stays
        if best[0] is None or (e - s) * best[2] > best[1] * q:
            best = (s, e - s, q)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    sha = lambda data: hashlib.sha256(data).hexdigest()
    return (doc_id, len(runs), *best, milli, sha(listed.encode()), sha(b" ".join(kept)))


def summaries(ids: list[int | None], texts: list[bytes | None], plant: bool = False) -> list[tuple]:
    """One row of ``SCHEMA`` for each text; ``plant`` lays the planted repeats into the texts first."""
    number, all_words = defaultdict(count(1).__next__), []
    parts, starts, size = [], [], 0
    for doc_id, text in zip(ids, texts, strict=True):
        words = (text or b"").split()
        numbers = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        place = planted(len(words), doc_id) if plant else None
        if place is not None:
            words, numbers = [words[i] for i in place.tolist()], numbers[place]
        all_words.append(words)
        starts.append(size)
        parts += [numbers, np.array([number[len(parts)]])]  # a separator: no word is a number
        size += len(words) + 1
    runs = find_runs(np.concatenate(parts)) if parts else np.empty((0, 3), np.int64)
    cuts = np.searchsorted(runs[:, 0], [*starts, size])
    return [
        _summary(doc_id, words, runs[cuts[i] : cuts[i + 1]] - np.array([starts[i], starts[i], 0]))
        for i, (doc_id, words) in enumerate(zip(ids, all_words, strict=True))
    ]


def _summarised(batches: Iterator[pa.RecordBatch], plant: bool) -> Iterator[pa.RecordBatch]:
    names = [part.strip().split(" ")[0] for part in SCHEMA.split(",")]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    for batch in slices(batches, "text"):
        rows = summaries(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), plant)
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """The runs of every text: their number, the greatest one, and digests of all runs and of the text without repeats.

    One row per input row, in no order; no shuffle.  Words stand between white space.  A run of period ``q`` has
    max(6, 4 q) words or more.  The greatest is that with the largest length / period, of equal ones the first;
    texts without any have nulls there.  Null, empty and blank texts have no runs.  Repeated rows give repeated results.  Rows without an id get
    no planted repeat.  Very long texts are one sequence in one task, whose memory grows with the text alone.
    Other columns of ``docs`` are not touched.
    """
    ship_package(docs.sparkSession)
    chosen = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return chosen.mapInArrow(partial(_summarised, plant=plant), SCHEMA)

"""A filter of the keys a table holds, kept over loads: which incoming keys may be there already.

The filter is a Bloom filter in words of 64 bits: a key falls into one word of its bucket and sets four of its bits.  It is a table of
(cell, bits), in buckets of the key (``buckets``) like the table it belongs to, with some 4 keys a word when it is fitted.  A batch is
added by a bitwise or, so adding it twice changes nothing, and a filter that knows too many keys asks for more joins but never loses a row.
Buckets that have filled up beyond ``FULL`` are fitted anew from their keys.

Insert if absent then joins only incoming keys that the filter may hold: the keys of the table itself are scanned, but not shuffled, where
those are few enough to be broadcast (their size is measured).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordweave.operators.dedupe import keep_one
from recordweave.operators.lookup import BROADCAST_BYTES, broadcast_if_small
from recordweave.plans.buckets import BUCKET, bucket_of, present, read_buckets, touched, write_buckets
from recordweave.storage import materialize

KEYS_PER_WORD = 4
BITS_PER_KEY = 4
#: Share of set bits from which a bucket is fitted anew; right after that it is some 0.22.
FULL = 0.4
#: Bytes of an entry of the filter in a broadcast hash table: two longs, a pointer and the row around them, rounded up.
CELL_BYTES = 64

_WORD, _BITS, _WORDS, _CELL = "_word", "_bits", "_words", "_cell"


@dataclass(frozen=True)
class KeyFilter:
    """The filter of one table under ``folder``.  ``key`` must have the same types in all rows that are given."""

    spark: SparkSession
    folder: str
    key: tuple[str, ...]
    buckets: int = 16

    @property
    def _table(self) -> str:
        return f"{self.folder.rstrip('/')}/words"

    _schema = f"{_WORD} long, {_BITS} long, {_WORDS} long"

    def _bucket(self) -> Column:
        return bucket_of(self.key, self.buckets)

    def _hash(self, seed: int) -> Column:
        return F.xxhash64(F.lit(seed), *self.key)

    def _mask(self) -> Column:
        """Four bits of a word, six bits of a hash each."""
        picks = self._hash(2)
        bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(picks, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        mask = bit(0)
        for i in range(1, BITS_PER_KEY):
            mask = mask.bitwiseOR(bit(i))
        return mask

    def _marked(self, rows: DataFrame, sizes: dict[int, int]) -> DataFrame:
        """Rows with their bucket and their word; NULL where a bucket has no words."""
        listed = F.array(*[F.lit(sizes.get(b)).cast("bigint") for b in range(self.buckets)])
        placed = rows.withColumn(BUCKET, self._bucket())
        words = F.element_at(listed, F.col(BUCKET) + 1)
        return placed.withColumn(_WORDS, words).withColumn(_WORD, F.pmod(self._hash(1), F.col(_WORDS)))

    def _words(self, rows: DataFrame, sizes: dict[int, int]) -> DataFrame:
        marked = self._marked(rows.select(*self.key), sizes)
        return marked.groupBy(BUCKET, _WORD, _WORDS).agg(F.bit_or(self._mask()).alias(_BITS)).select(_WORD, _BITS, _WORDS, BUCKET)

    def _held(self, only: Sequence[int] | None = None) -> DataFrame:
        return read_buckets(self.spark, self._table, self._schema, only)

    def sizes(self, only: Sequence[int] | None = None) -> dict[int, tuple[int, float]]:
        """Words of every bucket that has a filter, and the share of its bits that are set; one entry per bucket at most."""
        known = present(self.spark, self._table)
        chosen = known if only is None else sorted(set(known) & set(only))
        if not chosen:
            return {}
        full = (F.sum(F.bit_count(_BITS)) / (64 * F.max(_WORDS))).alias("full")
        return {r[BUCKET]: (r["words"], r["full"]) for r in self._held(chosen).groupBy(BUCKET).agg(F.max(_WORDS).alias("words"), full).collect()}

    def fit(self, table: DataFrame, only: Sequence[int] | None = None) -> list[int]:
        """Make the filter of some buckets (all, if none are named) anew from the rows of a table; the buckets it wrote."""
        keys = table.select(*self.key)
        if only is not None:
            keys = keys.filter(self._bucket().isin(*only)) if only else keys.limit(0)
        counts = {r[0]: r[1] for r in keys.groupBy(self._bucket()).agg(F.count(F.lit(1))).collect()}
        if counts:
            sizes = {b: max(1, -(-n // KEYS_PER_WORD)) for b, n in counts.items()}
            write_buckets(self._words(keys, sizes), self._table, f"{self.folder}/fits/{uuid.uuid4().hex}", sorted(counts))
        return sorted(counts)

    def add(self, rows: DataFrame, table: DataFrame | None = None) -> list[int]:
        """Add the keys of rows that are about to be inserted; the buckets that were fitted anew.

        To be called before the rows are inserted, so that the filter is never behind its table.  Buckets that have no filter yet or are
        full are fitted from ``rows`` and ``table``, the rows that are there; without ``table`` full ones are left as they are.
        """
        wanted = touched(rows, self.key, self.buckets)
        sizes = self.sizes(wanted)
        anew = [b for b in wanted if b not in sizes or (table is not None and sizes[b][1] > FULL)]
        kept = {b: words for b, (words, _) in sizes.items() if b not in anew}
        if kept:
            both = self._words(rows.filter(self._bucket().isin(*kept)), kept).unionByName(self._held(sorted(kept)))
            merged = both.groupBy(BUCKET, _WORD, _WORDS).agg(F.bit_or(_BITS).alias(_BITS)).select(_WORD, _BITS, _WORDS, BUCKET)
            write_buckets(merged, self._table, f"{self.folder}/adds/{uuid.uuid4().hex}", sorted(kept))
        if anew:
            keys = rows.select(*self.key)
            self.fit(keys if table is None else keys.unionByName(table.select(*self.key)), anew)
        return anew

    def may_hold(self, rows: DataFrame) -> DataFrame:
        """The rows whose key the filter may hold.  Keys that were added are all among these; of others, about one in a hundred."""
        wanted = touched(rows, self.key, self.buckets)
        sizes = {b: words for b, (words, _) in self.sizes(wanted).items()}
        if not sizes:
            return rows.limit(0)
        # Buckets and words in one number, so that the broadcast table is one of longs.
        cell = (F.col(_WORD) * self.buckets + F.col(BUCKET)).alias(_CELL)
        words = self._held(sorted(sizes)).select(cell, _BITS)
        # Fitting sets the number of words, so this bounds the rows without reading them.
        words = F.broadcast(words) if sum(sizes.values()) * CELL_BYTES <= BROADCAST_BYTES else words
        marked = self._marked(rows, sizes).select(*rows.columns, cell, self._mask().alias("_mask"))
        found = F.col("_mask").bitwiseAND(F.col(_BITS)) == F.col("_mask")
        return marked.join(words, _CELL).filter(found).select(*rows.columns)

    def absent_rows(self, existing: DataFrame, incoming: DataFrame, order_by: Sequence[str]) -> DataFrame:
        """What ``operators.writes.absent_rows`` gives, for an ``existing`` table whose keys were all added.

        Incoming rows are reduced to one per key and written once.  Keys that may be there are looked for in the table; those that are leave the
        rows again.  A key with a NULL is never there, as in the plain join.
        """
        _same_types(existing, incoming, self.key)
        new = materialize(keep_one(incoming, list(self.key), order_by), "incoming")
        maybe = materialize(self.may_hold(new.select(*self.key)), "may-hold")
        there = existing.select(*self.key).join(broadcast_if_small(maybe), list(self.key), "left_semi")
        there = materialize(there, "held")
        return new.join(broadcast_if_small(there), list(self.key), "left_anti")


def _same_types(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> None:
    """A number hashes to another value as another type."""
    ours, theirs = dict(existing.dtypes), dict(incoming.dtypes)
    if other := [k for k in key if ours[k] != theirs[k]]:
        raise TypeError(f"key columns of two types: {', '.join(other)}")

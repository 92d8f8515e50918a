"""Counts by key that are kept over loads: duplicate and coverage reports, and references.

The state is a table with one row for each key and its number of rows in several frames, in buckets of the key (``buckets``).  A batch is
counted by key and added to the buckets its keys fall into, so it costs its own rows and those buckets.  What is
asked follows from the state alone and equals what all rows of all batches would give.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordweave.operators.profile import report_of_counts
from recordweave.plans.buckets import BUCKET, Buckets, Written, read_buckets, touched, write_buckets
from recordweave.sources.contracts import KEY
from recordweave.storage import folder_exists, materialize, temporary_tables

_KEY, _BATCH, _NEW = "_key", "_batch", "_new"

#: Rows and the column that holds their key.
Keys = tuple[DataFrame, str]


@dataclass(frozen=True)
class KeyCounts:
    """Rows per key of some frames under ``folder``.  Keys are text; NULL is kept as a key of its own."""

    spark: SparkSession
    folder: str
    names: Sequence[str]
    buckets: int = 16

    @property
    def _schema(self) -> str:
        return f"{_KEY} string, " + "".join(f"_n{i} long, " for i in range(len(self.names))) + f"{_BATCH} long"

    @property
    def _table(self) -> str:
        return f"{self.folder.rstrip('/')}/counts"

    def change(
        self, batch: int, added: Mapping[str, Keys], removed: Mapping[str, Keys] | None = None, batches: int = 1
    ) -> Written:
        """Add the keys of the rows that came with a batch, numbered from 1 on, and take off those of the rows that went.

        A batch that was cut is given again under its number: buckets with a commit record are left, and keys that have it already do not
        count it twice.  Batches come one after the other.
        """
        removed = removed or {}
        if unknown := {*added, *removed} - set(self.names):
            raise ValueError(f"unknown frames: {', '.join(sorted(unknown))}")
        tagged = [
            df.select(F.col(f"`{key}`").cast("string").alias(_KEY), F.lit(self.names.index(name)).alias("_frame"), F.lit(sign).alias("_sign"))
            for sign, frames in ((1, added), (-1, removed)) for name, (df, key) in frames.items()
        ]
        ours = [f"_n{i}" for i in range(len(self.names))]
        with temporary_tables(self.spark):
            signs = [F.coalesce(F.sum(F.when(F.col("_frame") == i, F.col("_sign"))), F.lit(0)).cast("bigint").alias(n) for i, n in enumerate(ours)]
            delta = materialize(reduce(DataFrame.union, tagged).groupBy(_KEY).agg(*signs), "batch-counts")
            cut = Buckets((_KEY,), self.buckets, batches)
            wanted = touched(delta, cut.key, cut.count)
            given = delta.select(cut.of().alias(BUCKET), _KEY, *ours, F.lit(batch).cast("bigint").alias(_BATCH), F.lit(True).alias(_NEW))
            started = folder_exists(self.spark, self._table)
            old = read_buckets(self.spark, self._table, self._schema, wanted) if started else given.limit(0).drop(_NEW)
            both = old.withColumn(_NEW, F.lit(False)).unionByName(given)
            counted = F.max(F.when(~F.col(_NEW), F.col(_BATCH))).eqNullSafe(F.lit(batch))
            part = lambda n, new: F.coalesce(F.sum(F.when(F.col(_NEW) == new, F.col(n))), F.lit(0))
            sums = [(part(n, False) + F.when(counted, 0).otherwise(part(n, True))).alias(n) for n in ours]
            whole = both.groupBy(BUCKET, _KEY).agg(*sums, F.max(_BATCH).alias(_BATCH))
            return write_buckets(whole.select(_KEY, *ours, _BATCH, BUCKET), self._table, f"{self.folder}/batches/{batch}", wanted, batches)

    def counts(self, only: Sequence[int] | None = None) -> DataFrame:
        """Rows per key and frame (columns ``_key``, ``_n0``, ``_n1``, ...), of all buckets or some."""
        return read_buckets(self.spark, self._table, self._schema, only).drop(BUCKET, _BATCH)


@dataclass(frozen=True)
class ProfileStore(KeyCounts):
    """A duplicate and coverage report over sources."""

    def add(self, batch: int, frames: Mapping[str, DataFrame], key: str = KEY, batches: int = 1) -> Written:
        """Add the rows of a batch; all sources have the same key column."""
        return self.change(batch, {name: (df, key) for name, df in frames.items()}, batches=batches)

    def report(self) -> DataFrame:
        """(position, section, metric, value) as ``duplicate_report`` gives it for the sources."""
        return report_of_counts(self.counts(), self.names, len(self.names))[0]


@dataclass(frozen=True)
class ReferenceCounts(KeyCounts):
    """How many rows of each child table refer to a parent key.  NULL refers to nothing."""

    def _long(self, counts: DataFrame) -> DataFrame:
        sums = [F.coalesce(F.sum(f"_n{i}"), F.lit(0)).cast("bigint").alias(f"s{i}") for i in range(len(self.names))]
        entries = [F.struct(F.lit(name).alias("table"), F.col(f"s{i}").alias("rows")) for i, name in enumerate(self.names)]
        return counts.agg(*sums).select(F.inline(F.array(*entries)))

    def orphans(self, parents: DataFrame, key: str) -> DataFrame:
        """(table, rows): rows of each child whose parent is not there.  Reads the counts and the parents' keys, no child."""
        known = parents.select(F.col(f"`{key}`").cast("string").alias(_KEY))
        return self._long(self.counts().filter(F.col(_KEY).isNotNull()).join(known, _KEY, "left_anti"))

    def referring(self, parents: DataFrame, key: str) -> DataFrame:
        """(table, rows): rows of each child that refer to some parents, such as those to be deleted: what a cascade takes along, or
        what a plain delete would leave without a parent.  Reads the buckets these keys fall into."""
        chosen = parents.select(F.col(f"`{key}`").cast("string").alias(_KEY)).filter(F.col(_KEY).isNotNull()).distinct()
        return self._long(self.counts(touched(chosen, (_KEY,), self.buckets)).join(chosen, _KEY, "left_semi"))

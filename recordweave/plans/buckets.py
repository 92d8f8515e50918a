"""Tables in a fixed number of buckets of their key, as Parquet folders that are replaced bucket by bucket.

A bucketed table is an ordinary Parquet table with one partition folder for each bucket, a hash of the key.  A change rewrites the
buckets its keys fall into, by dynamic partition overwrite, and leaves the files of all others alone; who reads only some keys
reads only their buckets.  Writing goes batch by batch, and every finished bucket leaves a commit record (an empty file named after it), so
that a cut write goes on with the buckets that have none.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recordweave.storage import child_names, delete_folder, make_folder, touch

BUCKET = "_bucket"


@dataclass(frozen=True)
class Buckets:
    """How a table is cut: by a hash of ``key`` into ``count`` folders, written in ``batches`` jobs."""

    key: tuple[str, ...]
    count: int
    batches: int = 1

    def of(self) -> Column:
        return bucket_of(self.key, self.count)


@dataclass(frozen=True)
class Written:
    """What a write did: buckets written now, buckets that had been committed before, and counters of all of them."""

    written: tuple[int, ...]
    reused: tuple[int, ...]
    counts: Mapping[str, int]


def bucket_of(key: Sequence[str | Column], count: int) -> Column:
    """Bucket of a key; a NULL has one too."""
    return F.pmod(F.xxhash64(*key), F.lit(count)).cast("int")


def touched(df: DataFrame, key: Sequence[str | Column], count: int) -> list[int]:
    """The buckets that the keys of some rows fall into: a list no longer than ``count``."""
    return sorted(r[0] for r in df.select(bucket_of(key, count).alias(BUCKET)).distinct().collect())


def present(spark: SparkSession, path: str) -> list[int]:
    """The buckets of a table that have rows."""
    return sorted(int(name.partition("=")[2]) for name in child_names(spark, path) if name.startswith(f"{BUCKET}="))


def committed(spark: SparkSession, log: str) -> set[int]:
    """The buckets with a commit record."""
    return {int(name) for name in child_names(spark, log)}


def read_buckets(spark: SparkSession, path: str, schema: str, only: Collection[int] | None = None) -> DataFrame:
    """The table with its bucket column, or only some buckets of it; others are not scanned."""
    table = spark.read.schema(f"{schema}, {BUCKET} int").parquet(path)
    return table if only is None else table.filter(F.col(BUCKET).isin(*only))


def write_buckets(
    df: DataFrame, path: str, log: str, wanted: Sequence[int], batches: int = 1, counters: Mapping[str, Column] | None = None
) -> Written:
    """Replace the ``wanted`` buckets of the table at ``path`` by the rows of ``df`` that lie in them (column ``_bucket``).

    Buckets with a record in ``log`` are left as they are.  ``df`` may read the table itself: the files of a bucket are
    swapped after the whole batch was written.  Rows are dealt by bucket before they are written, and adaptive execution
    splits a large bucket over several files.  ``counters`` are observed under the write; where buckets were there
    already or batches are many, they are read from the written buckets instead.
    """
    spark = df.sparkSession
    counters = counters or {"rows": F.count(F.lit(1))}
    measures = [c.alias(n) for n, c in counters.items()]
    done = committed(spark, log) & set(wanted)
    todo = [b for b in wanted if b not in done]
    counts, size = None, max(1, -(-len(wanted) // batches))
    make_folder(spark, path)
    for start in range(0, len(todo), size):
        batch = todo[start : start + size]
        part = df if len(batch) == len(wanted) else df.filter(F.col(BUCKET).isin(*batch))
        seen = Observation()
        dealt = part.observe(seen, *measures)
        dealt = dealt if len(wanted) == 1 else dealt.hint("rebalance", BUCKET)
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BUCKET).parquet(path)
        counts = seen.get if len(batch) == len(wanted) else None
        for bucket in batch:
            touch(spark, f"{log}/{bucket}")
    if counts is None:
        table = spark.read.schema(df.schema).parquet(path).filter(F.col(BUCKET).isin(*wanted))
        counts = table.agg(*measures).first().asDict()
    return Written(tuple(todo), tuple(sorted(done)), {n: int(v or 0) for n, v in counts.items()})


def forget(spark: SparkSession, path: str, log: str) -> None:
    """Remove a table that was cut short, its records first."""
    delete_folder(spark, log)
    delete_folder(spark, path)


def laid_over(old: DataFrame, delta: DataFrame, key: Sequence[str]) -> DataFrame:
    """``old`` with the rows of ``delta`` in place of those of the same key.  Laying the same rows over twice changes nothing."""
    kept = old.join(delta.select(*key), list(key), "left_anti")
    return kept.select(*delta.columns).unionByName(delta)

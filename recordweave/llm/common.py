"""Helpers the operators of this package share."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordweave.llm.files import write_file
from recordweave.operators.lookup import broadcast_if_small
from recordweave.storage import materialize, new_folder

#: Words are what stands between these characters (space and the ASCII controls tab to carriage return).
WORD_BREAK = r"[\x20\x09-\x0D]+"
#: Rows a task handles at once inside an Arrow batch, so that long texts do not pile up as Python objects.
SLICE_ROWS = 128
SLICE_BYTES = 2 << 20

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors, once for each application, by way of the shared folder."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for top, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(top, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    folder = new_folder(spark, "source")
    name, _ = write_file(folder, f"recordweave-{application}", ".zip", [packed.getvalue()])
    spark.sparkContext.addPyFile(f"{folder}/{name}")
    _shipped.add(application)


def slices(batches: Iterator[pa.RecordBatch], sized: str, rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the column ``sized`` of one slice stays near ``size`` bytes, and its rows within ``rows``."""
    for batch in batches:
        column = batch.column(sized)
        width = max(1, column.nbytes // max(1, len(batch)))
        step = max(1, min(rows, size // width))
        for start in range(0, len(batch), step):
            yield batch.slice(start, step)


def number_within(
    df: DataFrame, keys: Sequence[str], bucket: Column, order_by: Sequence[str | Column], name: str
) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... within each combination of ``keys``, without one task per key.

    Rows of a key are dealt by ``bucket`` and numbered inside (key, bucket); the
    rows of the key's smaller buckets are added on top.  A key that holds a third of all
    rows is thus numbered by as many tasks as there are buckets.  ``bucket`` must depend on
    the row alone.  The order is bucket first, then ``order_by``.
    """
    dealt = df.withColumn("_bucket", bucket)
    parts = [*keys, "_bucket"]
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        dealt.groupBy(*parts)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*parts, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    local = F.row_number().over(Window.partitionBy(*parts).orderBy(*order_by))
    numbered = dealt.withColumn("_local", local).alias("l")
    joined = numbered.join(
        sizes.alias("r"), [F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in parts]
    )
    return joined.select(
        *[F.col(f"l.`{c}`") for c in df.columns],
        (F.col("_before") + F.col("_local") - 1).cast("bigint").alias(name),
    )


def fresh(frame: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``frame`` has it."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_key(number: Column, hashed: Column) -> Column:
    """A row's id and the hash of its text, as a struct that can be compared even where the id is null."""
    number = number.cast("bigint")
    return F.struct(number.isNull().alias("none"), F.coalesce(number, F.lit(0)).alias("id"), hashed.alias("hash"))


def keyed(docs: DataFrame, id_col: str, text_col: str | None, name: str, hash_col: str | None = None) -> DataFrame:
    """``docs`` with the key of every row in column ``name``, from its text or from a hash it has."""
    hashed = F.col(hash_col) if hash_col else F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    return docs.withColumn(name, text_key(F.col(f"`{id_col}`"), hashed))


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str | None, hash_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` whose id and text hash are not in ``gone`` (columns ``doc_id``, ``text_hash``), all columns kept.

    The list is broadcast if it is small; otherwise both sides are shuffled by id and hash.
    """
    name = fresh(docs, "_key")
    keys = gone.select(text_key(F.col("doc_id"), F.col("text_hash")).alias(name)).distinct()
    return keyed(docs, id_col, text_col, name, hash_col).join(broadcast_if_small(keys), name, "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


__all__ = ["SLICE_ROWS", "WORD_BREAK", "fresh", "keyed", "materialize", "number_within", "ship_package", "slices", "text_key", "without"]

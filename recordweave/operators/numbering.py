"""Consecutive numbers over a total order, without a one-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordweave.storage import materialize

_PART, _SPOT, _OFFSET = "_part", "_spot", "_offset"
_SPOT_MASK = (1 << 33) - 1


def number_rows(
    df: DataFrame, order_by: Sequence[str | Column], name: str = "id", after: int = 0
) -> DataFrame:
    """Add ``name``: after+1, after+2, ... in the given order.

    Rows are sorted by range and written once with their place inside the
    partition; the number is that place plus the size of the partitions before
    it.  The offsets hold one row per range partition, so they are bounded by the
    shuffle partition count and safe to broadcast.  Writing in between matters:
    a second evaluation might cut the ranges elsewhere.
    """
    placed = df.orderBy(*order_by).select(
        "*",
        F.spark_partition_id().alias(_PART),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_SPOT_MASK)).alias(_SPOT),
    )
    table = materialize(placed, "numbering")
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        table.groupBy(_PART)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(_PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(_OFFSET))
    )
    number = F.col(_OFFSET) + F.col(_SPOT) + F.lit(after + 1)
    return table.join(F.broadcast(offsets), _PART).select(
        *[F.col(f"`{c}`") for c in df.columns], number.cast("bigint").alias(name)
    )


def highest_id(df: DataFrame, name: str = "id") -> int:
    """Largest id in use, 0 for an empty table."""
    return df.agg(F.max(name)).first()[0] or 0


def assign_ids(
    new_rows: DataFrame, existing: DataFrame, order_by: Sequence[str], name: str = "id"
) -> DataFrame:
    """Ids for new rows, above those of the existing table."""
    return number_rows(new_rows, order_by, name, after=highest_id(existing, name))

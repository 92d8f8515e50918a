"""One row per key: the first, or the latest by a date; and the rows dropped for it.

Order is always explicit: ``order_by`` lists columns, ascending, the last of
them unique, so the surviving row is the same on every run.

A key may hold a large share of all rows, so no operator here brings all rows of
a key together:

* survivors alone use a ranked window cut at one, which Spark prunes to one row
  per key in every task before the shuffle;
* when the dropped rows are wanted too, only the keys and order columns are
  aggregated, with partial results before the shuffle, to the repeated keys and
  the row that survives for each.  Full rows are then matched with that list.
  Under a measured size it is broadcast, and full rows are not shuffled at all;
  above it they are shuffled once, and adaptive execution splits a hot key.

NULL in an order column sorts first everywhere.  Rows of one key that tie in all order
columns can't be told apart: ``keep_one`` takes any one of them, the others mark all of them as
kept, and the consolidation refuses the source.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordweave.operators.lookup import broadcast_if_small
from recordweave.storage import materialize

KEPT = "_kept"
_RANK, _ROWS, _WINNER, _SPREAD = "_rank", "_rows", "_winner", "_spread"


def keep_one(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], latest_by: str | None = None
) -> DataFrame:
    """The surviving row of every key. NULL keys count as one key.

    Without its date column the latest row is not known and the first is kept.
    """
    order = [F.col(latest_by).desc_nulls_last()] if latest_by in df.columns else []
    window = Window.partitionBy(*keys).orderBy(*order, *[F.col(c).asc() for c in order_by])
    return (
        df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)
    )


def repeated_keys(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], latest_by: str | None = None
) -> DataFrame:
    """Keys with more than one row, their row count and the order columns of the surviving row.

    The order columns are compared as one struct, NULL first, just as ``keep_one`` sorts them.
    """
    place = _place(df, order_by, latest_by)
    return (
        df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys])
        .agg(F.count(F.lit(1)).alias(_ROWS), F.min(place).alias(_WINNER))
        .filter(F.col(_ROWS) > 1)
    )


def _place(df: DataFrame, order_by: Sequence[str], latest_by: str | None) -> Column:
    latest = _latest_first(df, latest_by) if latest_by in df.columns else []
    return F.struct(*[c.alias(f"_o{i}") for i, c in enumerate([*latest, *map(F.col, order_by)])])


def mark_kept(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    latest_by: str | None = None,
    eligible: Column | None = None,
) -> DataFrame:
    """Every row, with a flag telling whether it survives; only ``eligible`` rows compete.

    The flag means nothing on rows that are not eligible.
    """
    joined = _with_winners(df, keys, order_by, latest_by, eligible, "left")
    kept = F.col(_ROWS).isNull() | (F.col(_WINNER) == _place(df, order_by, latest_by))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], kept.alias(KEPT))


def discarded(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], latest_by: str | None = None
) -> DataFrame:
    """The rows that :func:`keep_one` drops; none when there is no key column to compare."""
    if not set(keys).issubset(df.columns):
        return df.limit(0)
    joined = _with_winners(df, keys, order_by, latest_by, None, "inner")
    return joined.filter(F.col(_WINNER) != _place(df, order_by, latest_by)).select(
        *[F.col(f"`{c}`") for c in df.columns]
    )


def _with_winners(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    latest_by: str | None,
    eligible: Column | None,
    how: str,
) -> DataFrame:
    competing = df if eligible is None else df.filter(eligible)
    repeated = materialize(repeated_keys(competing, keys, order_by, latest_by), "repeated").withColumn(_SPREAD, F.lit(0))
    same_key = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    if eligible is not None:
        # Rows that do not compete often share a NULL key: a number from the whole row spreads them, and matches none.
        numbered = 1 + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(1 << 16))
        same_key.append(F.when(eligible, F.lit(0)).otherwise(numbered.cast("int")) == F.col(_SPREAD))
    return df.join(broadcast_if_small(repeated), reduce(lambda a, b: a & b, same_key), how)


def _latest_first(df: DataFrame, column: str) -> list[Column]:
    """Ascending sort values that put the latest first and NULL last."""
    kind = dict(df.dtypes)[column]
    c = F.col(column)
    if kind == "date":
        value = F.unix_date(c)
    elif kind.startswith("timestamp"):
        value = F.unix_micros(c.cast("timestamp"))
    else:
        raise TypeError(f"{column}: latest-by needs a date or timestamp, not {kind}")
    return [c.isNull(), -value]

"""Write semantics as pure functions ``(existing, incoming) -> new table``.

The caller writes the result to a new path. Keys are unique in ``existing``; a
key repeated in ``incoming`` is first reduced to one row, before any join, so a
hot key cannot swell one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordweave.operators.dedupe import keep_one

_PLACE = "_place"


def full_refresh(incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Forget the existing table; the first incoming row of each key."""
    return keep_one(incoming, keys, order_by)


def absent_rows(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """The first incoming row of every key the existing table lacks."""
    return keep_one(incoming, keys, order_by).join(existing.select(*keys), list(keys), "left_anti")


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """First write wins, against the existing table and inside the batch."""
    new = absent_rows(existing, incoming, keys, order_by)
    return existing.unionByName(new.select(*existing.columns))


def last_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of every key in the given order."""
    place = F.struct(*order_by)
    return keep_one(df.withColumn(_PLACE, place), keys, [], latest_by=_PLACE).drop(_PLACE)


Number = Callable[[DataFrame], DataFrame]


def replaced_rows(
    incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str], number: Number | None = None
) -> DataFrame:
    """The rows that replace those of their keys: the last incoming row of each.

    ``number`` adds what inserted rows need, such as their ids.
    """
    new = last_rows(incoming, keys, order_by)
    return number(new) if number else new


def replace_by_key(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    number: Number | None = None,
) -> DataFrame:
    """Delete the keys that come in, then insert the last incoming row of each."""
    new = replaced_rows(incoming, keys, order_by, number)
    kept = existing.join(new.select(*keys), list(keys), "left_anti")
    return kept.select(*existing.columns).unionByName(new.select(*existing.columns))


def upserted_rows(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    order_by: Sequence[str],
    number: Number | None = None,
) -> DataFrame:
    """The rows an upsert changes or adds: ``values`` from the last incoming row of each key.

    All other columns of a row that exists are kept, NULL too.  Columns that incoming rows lack are NULL in
    inserted rows unless ``number`` adds them.
    """
    new = last_rows(incoming, keys, order_by)
    fresh = new.select(*keys, *[F.col(f"`{v}`").alias(f"_new_{v}") for v in values])
    updated = existing.join(fresh, list(keys)).select(
        *[F.col(f"_new_{c}").alias(c) if c in values else F.col(f"`{c}`") for c in existing.columns]
    )
    absent = new.join(existing.select(*keys), list(keys), "left_anti")
    added = number(absent) if number else absent
    kinds = {f.name: f.dataType for f in existing.schema}
    cells = [F.col(f"`{c}`") if c in added.columns else F.lit(None).cast(kinds[c]).alias(c) for c in existing.columns]
    return updated.unionByName(added.select(*cells))


def upsert_latest(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    order_by: Sequence[str],
    number: Number | None = None,
) -> DataFrame:
    """Update ``values`` where the key exists, insert otherwise; the last incoming row wins."""
    touched = upserted_rows(existing, incoming, keys, values, order_by, number)
    kept = existing.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.select(*existing.columns).unionByName(touched)


def cascade_delete(child: DataFrame, removed: DataFrame, reference: str, id_col: str = "id") -> DataFrame:
    """Child rows that do not belong to a removed parent."""
    # Not made distinct: a plain shuffled side lets adaptive execution split a hot parent.
    gone = removed.select(F.col(id_col).alias(reference))
    return child.join(gone, reference, "left_anti").select(*child.columns)

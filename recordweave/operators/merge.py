"""Cell-by-cell merge of keyed sources in priority order, and unions of audit frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordweave.sources.contracts import KEY, consolidated_order

_SOURCE = "_source"


class DuplicateKeyError(ValueError):
    """A source handed to the merge has more than one row for a key."""


def require_unique_keys(sources: Sequence[DataFrame], key: str = KEY) -> None:
    """Raise, naming a few keys, unless every source has each key at most once."""
    tagged = [s.select(F.lit(i).alias(_SOURCE), F.col(key)) for i, s in enumerate(sources)]
    repeated = (
        reduce(DataFrame.union, tagged)
        .groupBy(_SOURCE, key)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .take(5)
    )
    if repeated:
        shown = ", ".join(f"source {r[_SOURCE]}: {r[key]!r}" for r in repeated)
        raise DuplicateKeyError(f"duplicate keys before merge ({shown})")


def refuse_repeats(most: int) -> None:
    """Raise if a source had ``most`` > 1 rows for a key."""
    if most > 1:
        raise DuplicateKeyError(f"duplicate keys before merge (a source has {most} rows for one key)")


def merge_by_priority(
    sources: Sequence[DataFrame], key: str = KEY, check_unique: bool = True, most_as: str | None = None
) -> DataFrame:
    """One row per key of any source; each cell is the first non-NULL by source order.

    ``most_as`` adds the largest number of rows any source has for the key, counted in the
    same shuffle, for a check that needs no job of its own (see ``refuse_repeats``).

    The rows of each source travel as one struct, stacked and shuffled once by
    key for any number of sources, and the cells are picked from the structs side
    by side.  Keys are unique per source, so rows cannot be combined before the
    shuffle and no group holds more rows than there are sources; spreading them
    by key first saves a sort of every source ahead of it.
    """
    if check_unique:
        require_unique_keys(sources, key)
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            s.select(F.col(key), F.struct(*_quoted(c for c in s.columns if c != key)).alias(_row(i)))
            for i, s in enumerate(sources)
        ],
    )
    found = [F.first(_row(i), ignorenulls=True).alias(_row(i)) for i in range(len(sources))]
    if most_as:
        counts = [F.count(_row(i)) for i in range(len(sources))]
        found.append((F.greatest(*counts) if len(counts) > 1 else counts[0]).alias(most_as))
    grouped = stacked.repartition(F.col(key)).groupBy(key).agg(*found)
    return _first_given(grouped, sources, key, "{row}.`{column}`", [most_as] if most_as else [])


def merge_settled(
    settled: DataFrame, sources: Mapping[str, DataFrame], source_col: str, key: str = KEY, most_as: str | None = None
) -> DataFrame:
    """The same result from one table that holds the rows of all sources, told apart by ``source_col``.

    ``sources`` are its rows by source, in priority order, with the columns each has.  A table in buckets of the key is grouped where it lies.
    """
    names = list(sources)
    own = [F.col(source_col) == name for name in names]
    cells = [F.struct(*_quoted(c for c in df.columns if c != key)) for df in sources.values()]
    found = [F.first(F.when(o, c), ignorenulls=True).alias(_row(i)) for i, (o, c) in enumerate(zip(own, cells, strict=True))]
    if most_as:
        counts = [F.count_if(o) for o in own]
        found.append((F.greatest(*counts) if len(counts) > 1 else counts[0]).alias(most_as))
    grouped = settled.groupBy(key).agg(*found)
    return _first_given(grouped, list(sources.values()), key, "{row}.`{column}`", [most_as] if most_as else [])


def merge_by_joins(
    sources: Sequence[DataFrame], key: str = KEY, check_unique: bool = True
) -> DataFrame:
    """The same result from full outer joins: two shuffles per joined source."""
    if check_unique:
        require_unique_keys(sources, key)
    renamed = [
        s.select(F.col(key), *[F.col(f"`{c}`").alias(f"{_row(i)}_{c}") for c in s.columns if c != key])
        for i, s in enumerate(sources)
    ]
    joined = reduce(lambda a, b: a.join(b, key, "full_outer"), renamed)
    return _first_given(joined, sources, key, "`{row}_{column}`")


def _row(source: int) -> str:
    return f"_row{source}"


def _first_given(
    side_by_side: DataFrame, sources: Sequence[DataFrame], key: str, cell: str, further: Sequence[str] = ()
) -> DataFrame:
    """Per column, the first non-NULL of the sources that have it, in canonical order."""

    def pick(column: str):
        if column == key:
            return F.col(key)
        cells = [
            F.col(cell.format(row=_row(i), column=column))
            for i, s in enumerate(sources)
            if column in s.columns
        ]
        return F.coalesce(*cells).alias(column)

    columns = {c for s in sources for c in s.columns}
    return side_by_side.select(*[pick(c) for c in consolidated_order(columns)], *further)


def union_audit(frames: Sequence[DataFrame]) -> DataFrame:
    """Audit frames of several sources in one; columns a source lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _quoted(columns: Iterable[str]) -> list[str]:
    return [f"`{c}`" for c in columns]

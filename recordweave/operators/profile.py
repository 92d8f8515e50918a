"""Duplicate and coverage profiles, assembled into one long report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordweave.sources.contracts import KEY

REPORT_COLUMNS = ("position", "section", "metric", "value")


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key; only the key columns are read."""
    return df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def duplicate_profile(df: DataFrame, key: str = KEY) -> DataFrame:
    """One row: rows, distinct keys, rows with a repeated key, excess rows, later repeats.

    NULL is not a distinct key, but several NULLs repeat each other.
    """
    n = F.col("_n")
    total = F.coalesce(F.sum(n), F.lit(0)).cast("bigint")
    return key_counts(df, [key]).agg(
        total.alias("rows"),
        F.count(F.col(key)).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).cast("bigint").alias("repeated_key_rows"),
        (total - F.count(F.col(key))).alias("excess_rows"),
        (total - F.count(F.lit(1))).alias("later_repeats"),
    )


def source_coverage(sources: Mapping[str, DataFrame], key: str = KEY) -> DataFrame:
    """One row: keys in any source, and for each source the keys found in it alone."""
    names = list(sources)
    tagged = [
        df.select(
            F.col(key).alias("_key"), *[F.lit(other == name).alias(other) for other in names]
        )
        for name, df in sources.items()
    ]
    flags = (
        reduce(DataFrame.union, tagged)
        .filter(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(*[F.bool_or(name).alias(name) for name in names])
    )

    def alone(name: str):
        others = [~F.col(o) for o in names if o != name]
        return reduce(lambda a, b: a & b, others, F.col(name))

    return flags.agg(
        F.count(F.lit(1)).alias("any_source"),
        *[F.count_if(alone(name)).alias(f"only_{name}") for name in names],
    )


def to_long(wide: DataFrame, section: str, position: int) -> DataFrame:
    """Columns of a one-row frame as (position, section, metric, value) rows."""
    entries = [
        F.struct(
            F.lit(position + i).alias("position"),
            F.lit(section).alias("section"),
            F.lit(name).alias("metric"),
            F.col(f"`{name}`").cast("bigint").alias("value"),
        )
        for i, name in enumerate(wide.columns)
    ]
    return wide.select(F.inline(F.array(*entries)))


def duplicate_report(
    sources: Mapping[str, DataFrame],
    before: Mapping[str, DataFrame] | None = None,
    consolidated: DataFrame | None = None,
    key: str = KEY,
) -> DataFrame:
    """Profiles of every source, before and after dedupe, coverage and the result.

    The keys of all frames are stacked and counted per frame in one shuffle; every section but that of the
    result follows from these counts.
    """
    frames = [*sources.items(), *[(f"{name}_before_dedupe", df) for name, df in (before or {}).items()]]
    stacked = reduce(
        DataFrame.union, [df.select(F.lit(i).alias("_frame"), F.col(key).alias("_key")) for i, (_, df) in enumerate(frames)]
    )
    counted = stacked.groupBy("_key").agg(*[F.count_if(F.col("_frame") == i).alias(f"_n{i}") for i in range(len(frames))])
    report, positions = report_of_counts(counted, [name for name, _ in frames], len(sources))
    if consolidated is None:
        return report
    return report.union(to_long(duplicate_profile(consolidated, key), "consolidated", positions))


def settled_counts(settled: DataFrame, source_col: str, names: Sequence[str], key: str = KEY) -> DataFrame:
    """Rows per key of every source (``_key``, ``_n0``, ``_n1``, ...) from one table of all sources; no shuffle if it is in buckets of the key."""
    counts = [F.count_if(F.col(source_col) == name).alias(f"_n{i}") for i, name in enumerate(names)]
    return settled.groupBy(key).agg(*counts).withColumnRenamed(key, "_key")


def report_with_discarded(
    settled: DataFrame, source_col: str, names: Sequence[str], dropped: DataFrame, dropped_from: str, consolidated: DataFrame, key: str = KEY
) -> DataFrame:
    """The duplicate report from the kept rows of all sources in one table, and the rows dropped for them.

    A dropped row's key is also kept in its source.  Dropped keys are counted by task before they are shuffled, so
    that one repeated any number of times is one row for each task; the kept ones stay in their buckets.
    """
    kept = settled_counts(settled, source_col, names, key)
    lost = [F.count_if(F.col(dropped_from) == name).alias(f"_d{i}") for i, name in enumerate(names)]
    joined = kept.join(dropped.groupBy(F.col(key).alias("_key")).agg(*lost), "_key", "left")
    before = [(F.col(f"_n{i}") + F.coalesce(f"_d{i}", F.lit(0))).alias(f"_n{len(names) + i}") for i in range(len(names))]
    counted = joined.select("_key", *[f"_n{i}" for i in range(len(names))], *before)
    report, position = report_of_counts(counted, [*names, *[f"{name}_before_dedupe" for name in names]], len(names))
    return report.union(to_long(duplicate_profile(consolidated, key), "consolidated", position))


def report_of_counts(counted: DataFrame, names: Sequence[str], sources: int) -> tuple[DataFrame, int]:
    """The report from rows per key (columns ``_key``, ``_n0``, ``_n1``, ...) of frames, and the first position after it.

    The first ``sources`` frames are those whose coverage is told.
    """
    known = F.col("_key").isNotNull()
    sections: list[tuple[str, dict[str, Column]]] = []
    for i, name in enumerate(names):
        n = F.col(f"_n{i}")
        total = F.coalesce(F.sum(n), F.lit(0)).cast("bigint")
        distinct = F.count_if(known & (n > 0))
        sections.append((name, {
            "rows": total,
            "distinct_keys": distinct,
            "repeated_key_rows": F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).cast("bigint"),
            "excess_rows": total - distinct,
            "later_repeats": total - F.count_if(n > 0),
        }))
    held = [F.col(f"_n{i}") > 0 for i in range(sources)]
    alone = [
        reduce(lambda a, b: a & b, [~other for j, other in enumerate(held) if j != i], known & own) for i, own in enumerate(held)
    ]
    sections.append(("coverage", {
        "any_source": F.count_if(known & reduce(lambda a, b: a | b, held)),
        **{f"only_{name}": F.count_if(own) for name, own in zip(names[:sources], alone, strict=True)},
    }))
    wide = counted.agg(*[c.alias(f"{name}.{metric}") for name, metrics in sections for metric, c in metrics.items()])
    entries = [
        F.struct(
            F.lit(100 * (i + 1) + j).alias("position"), F.lit(name).alias("section"), F.lit(metric).alias("metric"),
            F.col(f"`{name}.{metric}`").cast("bigint").alias("value"),
        )
        for i, (name, metrics) in enumerate(sections)
        for j, metric in enumerate(metrics)
    ]
    return wide.select(F.inline(F.array(*entries))), 100 * (len(sections) + 1)


def require_unique(profile: DataFrame, what: str) -> None:
    """Raise when a duplicate profile shows repeats."""
    repeats = profile.first()["later_repeats"]
    if repeats:
        raise ValueError(f"{what}: {repeats} rows repeat an earlier key")

"""First rows, samples of related rows, and proportional samples."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import count

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructField, StructType

from recordweave.operators.lookup import broadcast_if_small
from recordweave.operators.numbering import number_rows
from recordweave.storage import materialize

#: Rows sampled to bracket the bound, rows of a bracket that are ranked at once, and the place up to which no bracket is needed.
SAMPLE_ROWS, RANKED_ROWS, FEW_ROWS = 1 << 12, 1 << 14, 1 << 10
_SPOT = "_reached"


@dataclass(frozen=True)
class _Bound:
    """The order columns of the n-th row, the rows before it and the rows equal to it in all of them."""

    table: DataFrame
    before: int
    equal: int


def _one_row(spots: DataFrame, *rows: Row | None) -> DataFrame:
    """Values of the order columns as a table of one row: v0, v1, ..."""
    kind = spots.schema[_SPOT].dataType
    schema = StructType([StructField(f"v{i}", kind) for i in range(len(rows))])
    return spots.sparkSession.createDataFrame([tuple(rows)], schema)


def _nth(spots: DataFrame, n: int) -> _Bound | None:
    """Where the ``n``-th of the values in column ``_reached`` lies, or None if there are fewer.

    Selection without a sort: a sample of bounded size brackets the place, exact counts over one scan say in which part it lies, and so on
    inside that part, until a bracket is small enough to be ranked.  The rows of a bracket shrink by some hundred each time.
    """
    spot = F.col(_SPOT)
    low, high, skipped, inside = None, None, 0, spots.count()
    if n > inside:
        return None
    for turn in count():
        # The bracket holds the values above ``low`` and below ``high``.
        held, place = spots, n - skipped
        ends = _one_row(spots, low, high)
        if low is not None:
            held = held.filter(spot > ends.select("v0").scalar())
        if high is not None:
            held = held.filter(spot < ends.select("v1").scalar())
        if inside <= max(RANKED_ROWS, SAMPLE_ROWS) or place <= FEW_ROWS:
            found = held.orderBy(_SPOT).offset(place - 1).limit(1).first()[0]
            bound = _one_row(spots, found)
            here = bound.select("v0").scalar()
            before, equal = held.agg(F.count_if(spot < here), F.count_if(spot == here)).first()
            return _Bound(bound, skipped + before, equal)
        sample = [r[0] for r in held.orderBy(F.xxhash64(F.lit(turn), spot), spot).limit(SAMPLE_ROWS).orderBy(_SPOT).collect()]
        at = place * len(sample) / inside
        margin = 4 + 4 * math.sqrt(max(1.0, at * (1 - at / len(sample))))
        left, right = max(0, math.floor(at - margin)), min(len(sample) - 1, math.ceil(at + margin))
        cuts = _one_row(spots, sample[left], sample[right])
        least, most = cuts.select("v0").scalar(), cuts.select("v1").scalar()
        under, upto, below, reached = held.agg(
            F.count_if(spot < least), F.count_if(spot <= least), F.count_if(spot < most), F.count_if(spot <= most)
        ).first()
        for cut, first, last in (("v0", under, upto), ("v1", below, reached)):
            if first < place <= last:
                return _Bound(cuts.select(F.col(cut).alias("v0")), skipped + first, last - first)
        # Each part leaves out the rows at a cut at least, so the bracket shrinks.
        if place <= under:
            high, inside = sample[left], under
        elif place <= below:
            low, high, inside, skipped = sample[left], sample[right], below - upto, skipped + upto
        else:
            low, inside, skipped = sample[right], inside - reached, skipped + reached


def head_n(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in the given order, found the same way for every ``n``.

    The n-th row is found by selection on the order columns (``_nth``): nothing is sorted as a whole and nothing is written.  Rows up to
    it are taken where they are; no task collects the rows, and full rows are not shuffled.  Rows that tie in all order
    columns come in the order of a hash of the whole row; of equal rows at the bound as many are taken as fit.
    """
    if n <= 0:
        return df.limit(0)
    hashable = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, MapType)]
    order = [*[F.col(c) for c in order_by], F.xxhash64(*hashable)]
    placed = df.withColumn(_SPOT, F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)]))
    bound = _nth(placed.select(_SPOT), n)
    if bound is None:  # fewer rows than asked for
        return df
    last, wanted = bound.table.select("v0"), n - bound.before
    if wanted == bound.equal:
        return placed.filter(F.col(_SPOT) <= last.scalar()).select(*df.columns)
    whole = placed.filter(F.col(_SPOT) < last.scalar())
    equal = number_rows(placed.filter(F.col(_SPOT) == last.scalar()), [F.rand(0)], "_turn").filter(F.col("_turn") <= wanted)
    return whole.select(*df.columns).unionByName(equal.select(*df.columns))


def restrict_to_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is among ``keys``."""
    return df.join(keys.select(on), on, "left_semi").select(*df.columns)


def proportional_quotas(df: DataFrame, group: str, n: int) -> DataFrame:
    """Rows to take from every group so that they sum to ``n``: largest remainder.

    Exact integer arithmetic; ties go to the smaller group value; groups with no
    share are left out; ``n`` at or above the row count takes everything.
    """
    if n <= 0:
        raise ValueError("n must be positive")
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("rows"))
    return _quotas(materialize(counts, "counts"), group, n)


def _quotas(counts: DataFrame, group: str, n: int) -> DataFrame:
    """Quotas from a table of (group, rows)."""
    total = counts.agg(F.sum("rows")).first()[0] or 0
    if n >= total:
        return counts.withColumn("quota", F.col("rows"))
    scaled = F.col("rows").cast("decimal(19,0)") * F.lit(n).cast("decimal(19,0)")
    rest = (scaled % F.lit(total).cast("decimal(38,0)")).cast("bigint")
    shares = counts.withColumn("_rest", rest).withColumn(
        "_floor",
        ((scaled - F.col("_rest")) / F.lit(total).cast("decimal(19,0)")).cast("bigint"),
    )
    ranked = number_rows(shares, [F.col("_rest").desc(), F.col(group).asc()], "_rank")
    left_over = n - ranked.agg(F.sum("_floor")).first()[0]
    quota = F.col("_floor") + (F.col("_rank") <= left_over).cast("bigint")
    return ranked.select(group, "rows", quota.alias("quota")).filter("quota > 0")


def stratified_sample(
    df: DataFrame, group: str, row_id: str, n: int, seed: str = ""
) -> DataFrame:
    """``n`` rows with every group in proportion, taken in the order of a hash of the row id.

    A group may hold a large share of all rows, so it is never sorted as a whole:
    counts per leading hash digits give the bucket in which the quota of a group
    runs out; buckets before it are taken entirely, and only rows of that one
    bucket (about 1/65536 of the group) are ranked.
    """
    if n <= 0:
        raise ValueError("n must be positive")
    hashed = df.withColumn(
        "_hash", F.md5(F.concat(F.lit(seed), F.col(row_id).cast("string")).cast("binary"))
    ).withColumn("_bucket", F.left("_hash", F.lit(4)))
    sizes = materialize(
        hashed.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n")), "sizes"
    )
    counts = materialize(sizes.groupBy(group).agg(F.sum("_n").alias("rows")), "counts")
    quotas = _quotas(counts, group, n).select(F.col(group).alias("_g"), "quota")
    upto = Window.partitionBy(group).orderBy("_bucket")
    reached = sizes.withColumn("_upto", F.sum("_n").over(upto))
    limits = (
        reached.join(quotas, reached[group].eqNullSafe(quotas["_g"]))
        .filter((F.col("_upto") >= F.col("quota")) & (F.col("_upto") - F.col("_n") < F.col("quota")))
        .select(
            "_g",
            F.col("_bucket").alias("_last"),
            (F.col("quota") - F.col("_upto") + F.col("_n")).alias("_open"),
        )
    )
    small = broadcast_if_small(materialize(limits, "limits"))
    limited = hashed.join(small, hashed[group].eqNullSafe(F.col("_g")))
    # Rows of earlier buckets are ranked too, which costs little: they are part of the sample, and no bucket is large.
    place = Window.partitionBy(group, "_bucket").orderBy("_hash", row_id)
    ranked = limited.filter(F.col("_bucket") <= F.col("_last")).withColumn("_place", F.row_number().over(place))
    chosen = ranked.filter((F.col("_bucket") < F.col("_last")) | (F.col("_place") <= F.col("_open")))
    return chosen.select(*df.columns)

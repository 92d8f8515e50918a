"""Quality rules with robust multivariate outliers, in DataFrame operations only.

Every text gives a few counts.  Texts that fail the base rules are set aside.  The others give a
vector of transformed statistics, and for each language and source the minimum covariance determinant
(MCD) estimates where the bulk of these vectors lies: the mean and covariance of the part of
``SUPPORT`` of the rows whose covariance has the smallest determinant.  A text is rejected if its Mahalanobis
distance from that estimate exceeds a quantile of the chi-square distribution.

MCD is found by concentration steps from two starts, medians with median deviations and plain
means with covariances: compute all distances under the current estimate, keep the nearest rows, estimate anew.
A step never raises the determinant.  Each step is one aggregation over all rows.  Distances are
grouped into bins of a fixed relative width, sums are kept per group and bin, and a running sum over the
bins of a group finds the bin up to which rows are kept.  So a group of any size costs each task at
most one row per bin, and no row is ranked.  Statistics are whole multiples of 1 / ``UNIT``, so sums
are exact and the result does not depend on how rows are partitioned.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordweave.llm.common import WORD_BREAK, materialize
from recordweave.operators.lookup import broadcast_if_small

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Base rule: at most so many hundredths of the words in repeated windows.
MAX_REPEAT = 50
WINDOW_WORDS = 3
#: Part of a group's rows that the estimate rests on.
SUPPORT = 0.75
STEPS = 6
#: Groups of fewer rows use the estimate of their language, languages of fewer rows that of all rows.
MIN_ROWS = 200
#: Statistics are kept in multiples of 1 / UNIT.
UNIT = 256
#: Bins for each doubling of the squared distance.
BINS = 16
#: Chance that a regular vector is rejected, by the chi-square distribution.
REJECT = 1e-3
#: Smallest standard deviation of each statistic, so that a statistic that hardly varies does not reject small differences.
#: With other statistics as usual, one that hardly varies rejects from 4.3 floors on: shares of symbols above 5 %, and
#: of repeated lines or words above 19 %.
STATISTICS = ("word_length", "symbols", "dup_lines", "repeats")
FLOORS = (0.05, 0.05, 0.10, 0.10)
_D = len(STATISTICS)


def chi_square_below(x: float, degrees: int) -> float:
    """Distribution function of chi-square with whole degrees, by the series of the incomplete gamma function."""
    a, half = degrees / 2, x / 2
    if half <= 0:
        return 0.0
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= half / n
        total += term
    return min(1.0, total * math.exp(a * math.log(half) - half - math.lgamma(a)))


def chi_square_quantile(chance: float, degrees: int) -> float:
    low, high = 0.0, 1.0
    while chi_square_below(high, degrees) < chance:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_below(middle, degrees) < chance else (low, middle)
    return high


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """Words in windows of three that occur twice or more, each word counted once.

    Windows are sorted as one number, a hash above the place, so that windows that may be equal stand side by
    side.  Only those with an equal hash are compared as text.
    """
    k, place_bits = WINDOW_WORDS, 30  # an array has fewer than 2^30 words, as a text has less than 2^31 bytes
    low = F.lit((1 << place_bits) - 1)

    def window(text: Column, i: Column) -> Column:
        return F.concat_ws(" ", *[text[i + j] for j in range(k)])

    def of(text: Column) -> Column:
        last = F.size(text) - k
        keyed = F.sort_array(
            F.transform(
                F.sequence(F.lit(0), last),
                lambda i: F.shiftleft(F.xxhash64(*[text[i + j] for j in range(k)]), place_bits).bitwiseOR(i.cast("bigint")),
            )
        )

        def hash_of(x: Column) -> Column:
            return F.shiftright(x, place_bits)

        def suspects(keys: Column) -> Column:
            return F.filter(
                keys,
                lambda x, i: ((i > 0) & (hash_of(x) == hash_of(keys[F.greatest(i - 1, F.lit(0))])))
                | ((i < last) & (hash_of(x) == hash_of(keys[F.least(i + 1, last)]))),
            )

        def exact(found: Column) -> Column:
            texts = F.array_sort(
                F.transform(
                    found,
                    lambda x: F.struct(window(text, x.bitwiseAND(low).cast("int")).alias("w"), x.bitwiseAND(low).cast("int").alias("i")),
                )
            )

            def twice(pairs: Column) -> Column:
                end = F.size(pairs) - 1
                same = F.filter(
                    pairs,
                    lambda p, i: ((i > 0) & (p["w"] == pairs[F.greatest(i - 1, F.lit(0))]["w"]))
                    | ((i < end) & (p["w"] == pairs[F.least(i + 1, end)]["w"])),
                )
                return F.sort_array(F.transform(same, lambda p: p["i"]))

            # each place covers k words, less what the one before has covered
            return F.aggregate(
                _let(texts, twice),
                F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-k).alias("last")),
                lambda done, i: F.struct(
                    (done["n"] + F.least(F.lit(k), i - done["last"])).alias("n"), i.alias("last")
                ),
                lambda done: done["n"],
            )

        return _let(_let(keyed, suspects), lambda found: F.when(F.size(found) == 0, F.lit(0).cast("bigint")).otherwise(exact(found)))

    return _let(words, lambda text: F.when(F.size(text) < k + 1, F.lit(0).cast("bigint")).otherwise(of(text)))


def text_counts(text: Column) -> dict[str, Column]:
    """The base counts of a text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, WORD_BREAK), "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_lines": F.size(lines).cast("bigint"),
        "n_repeat_words": repeated_words(words),
    }


def _statistics() -> list[Column]:
    """The vector of a text in whole units: logarithm of the word length, square roots of shares."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    values = (
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        F.sqrt(F.least(F.lit(1.0), F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)))),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        F.sqrt(F.least(F.lit(1.0), F.col("n_repeat_words") / words)),
    )
    return [F.round(v * UNIT).cast("bigint").alias(name) for v, name in zip(values, STATISTICS, strict=True)]


_PAIRS = [(i, j) for i in range(_D) for j in range(i + 1)]
_ESTIMATE = [f"m{i}" for i in range(_D)] + [f"l{i}{j}" for i, j in _PAIRS] + ["logdet"]


_SUMS = ["n"] + [f"s{i}" for i in range(_D)] + [f"q{i}{j}" for i, j in _PAIRS]


def _estimate(sums: DataFrame, keep: Sequence[str], widen: float = 1.0) -> DataFrame:
    """Mean, Cholesky factor of the covariance and log determinant from sums; ``widen`` multiplies the covariance."""
    n = F.col("n")
    frame = sums.select(
        *keep,
        *[(F.col(f"s{i}") / n / UNIT).alias(f"m{i}") for i in range(_D)],
        *[
            (
                (F.col(f"q{i}{j}") / n - (F.col(f"s{i}") / n) * (F.col(f"s{j}") / n)) * (widen / UNIT**2)
                + (FLOORS[i] ** 2 if i == j else 0.0)
            ).alias(f"c{i}{j}")
            for i, j in _PAIRS
        ],
    )
    return _factor(frame, keep)


def _factor(frame: DataFrame, keep: Sequence[str]) -> DataFrame:
    for j in range(_D):
        square = reduce(lambda a, k: a - F.col(f"l{j}{k}") * F.col(f"l{j}{k}"), range(j), F.col(f"c{j}{j}"))
        frame = frame.withColumn(f"l{j}{j}", F.sqrt(F.greatest(square, F.lit(1e-12))))
        for i in range(j + 1, _D):
            rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), F.col(f"c{i}{j}"))
            frame = frame.withColumn(f"l{i}{j}", rest / F.col(f"l{j}{j}"))
    logdet = reduce(lambda a, i: a + F.log(F.col(f"l{i}{i}")), range(_D), F.lit(0.0)) * 2
    return frame.withColumn("logdet", logdet).select(*keep, *_ESTIMATE)


def _distance() -> Column:
    """Squared Mahalanobis distance of a row from the estimate beside it, by forward substitution."""
    steps: list[Column] = []
    for i in range(_D):
        value = F.col(STATISTICS[i]) / UNIT - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * steps[k]
        steps.append(value / F.col(f"l{i}{i}"))
    return reduce(lambda a, z: a + z * z, steps, F.lit(0.0))


_GROUP = ["lang_key", "source_key", "level"]


def _match(left: str, right: str, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in names])


def _beside(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Rows with the estimates of their group, one for every start."""
    names = [c for c in estimates.columns if c not in _GROUP]
    return rows.alias("r").join(broadcast_if_small(estimates).alias("e"), _match("r", "e", _GROUP)).select(
        "r.*", *[F.col(f"e.{c}") for c in names]
    )


def _levels(vectors: DataFrame) -> DataFrame:
    """The vectors once for their language and source, once for their language, once for all."""
    none = F.lit(None).cast("string")
    level = F.explode(F.array(
        F.struct(F.col("lang").alias("lang_key"), F.col("source").alias("source_key"), F.lit(2).alias("level")),
        F.struct(F.col("lang").alias("lang_key"), none.alias("source_key"), F.lit(1).alias("level")),
        F.struct(none.alias("lang_key"), none.alias("source_key"), F.lit(0).alias("level")),
    )).alias("g")
    return vectors.select(level, *STATISTICS).select("g.*", *STATISTICS)


def estimates(vectors: DataFrame, support: float = SUPPORT, steps: int = STEPS) -> DataFrame:
    """The MCD estimate of every group of at least ``MIN_ROWS`` rows: ``lang_key``, ``source_key``, ``level`` and the estimate.

    ``vectors`` has ``lang``, ``source`` and the statistics.  Equal vectors of a group are
    counted once with their number, which leaves few rows whatever the input: statistics are whole units.
    """
    spread = _levels(vectors).groupBy(*_GROUP, *STATISTICS).agg(F.count(F.lit(1)).alias("times"))
    rows = materialize(spread, "vectors")
    weighted = [F.sum("times").alias("n")]
    x = [F.col(s) for s in STATISTICS]
    weighted += [F.sum(x[i] * F.col("times")).alias(f"s{i}") for i in range(_D)]
    weighted += [F.sum(x[i] * x[j] * F.col("times")).alias(f"q{i}{j}") for i, j in _PAIRS]
    sums = materialize(rows.groupBy(*_GROUP).agg(*weighted).where(F.col("n") >= MIN_ROWS), "sums")
    sizes = sums.select(*_GROUP, F.col("n").alias("rows"))
    classical = _estimate(sums, _GROUP).withColumn("start", F.lit("means"))
    middle = rows.groupBy(*_GROUP).agg(*[F.percentile(s, 0.5, F.col("times")).alias(f"m{i}") for i, s in enumerate(STATISTICS)])
    off = rows.alias("r").join(broadcast_if_small(middle).alias("e"), _match("r", "e", _GROUP))
    off = off.groupBy(*[F.col(f"r.{c}") for c in _GROUP]).agg(
        *[F.percentile(F.abs(F.col(s) - F.col(f"m{i}")), 0.5, F.col("times")).alias(f"d{i}") for i, s in enumerate(STATISTICS)]
    )
    medians = middle.alias("r").join(off.alias("e"), _match("r", "e", _GROUP)).join(
        sizes.alias("z"), _match("r", "z", _GROUP), "left_semi"
    ).select(
        *[F.col(f"r.{c}") for c in _GROUP],
        *[(F.col(f"m{i}") / UNIT).alias(f"m{i}") for i in range(_D)],
        *[
            (F.pow(F.col(f"d{i}") * (1.4826 / UNIT), 2) + FLOORS[i] ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}")
            for i, j in _PAIRS
        ],
    )
    medians = _factor(medians, _GROUP).withColumn("start", F.lit("medians"))
    current = materialize(classical.unionByName(medians), "estimates")
    starts = [*_GROUP, "start"]
    edge = Window.partitionBy(*starts).orderBy("bin")
    running = edge.rowsBetween(Window.unboundedPreceding, 0)
    for _ in range(steps):
        placed = _beside(rows, current).withColumn("bin", F.floor(F.log2(_distance() + 1e-9) * BINS).cast("int"))
        per_bin = placed.groupBy(*starts, "bin").agg(*weighted)
        upto = per_bin.select(*starts, "bin", *[F.sum(c).over(running).alias(c) for c in _SUMS])
        wanted = upto.alias("r").join(broadcast_if_small(sizes).alias("z"), _match("r", "z", _GROUP)).where(
            F.col("n") >= F.col("rows") * support
        ).select("r.*")
        first = wanted.withColumn("turn", F.row_number().over(edge)).where("turn = 1")
        current = materialize(_estimate(first, starts), "estimates")
    best = Window.partitionBy(*_GROUP).orderBy("logdet", "start")
    mcd = current.withColumn("turn", F.row_number().over(best)).where("turn = 1").drop("turn", "start")
    # consistency: the covariance of the nearest part of normal rows is too small by a known factor
    inside = chi_square_quantile(support, _D)
    factor = support / chi_square_below(inside, _D + 2)
    near = chi_square_quantile(0.975, _D)
    kept = _beside(rows, materialize(mcd, "estimates")).where(_distance() <= near * factor)
    again = kept.groupBy(*_GROUP).agg(*weighted)
    widen = 0.975 / chi_square_below(near, _D + 2)
    return materialize(_estimate(again, _GROUP, widen), "estimates")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: the base counts, ``base_failed``, ``kept``, and ``distance`` with the ``level`` it comes from.

    ``level`` is 2 for the estimate of language and source, 1 of the language, 0 of all rows; without any
    estimate (fewer than ``MIN_ROWS`` rows pass the base rules) both are null and the base rules decide alone.
    Null and empty texts have counts of zero and fail.  A null language or source is a group of its own.
    Equal rows get equal verdicts.  An empty table gives no rows; other columns are not read.
    """
    counts = text_counts(F.col(f"`{text_col}`"))
    counted = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        *[c.alias(name) for name, c in counts.items()],
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    known = materialize(counted.select("*", failed.alias("base_failed"), *_statistics()), "counts")
    found = broadcast_if_small(estimates(known.where(~F.col("base_failed"))))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = known.select(*columns, *STATISTICS, "lang", "source")
    limit = chi_square_quantile(1 - REJECT, _D)

    def joined(rows: DataFrame, level: int) -> DataFrame:
        side = found.where(F.col("level") == level).select("lang_key", "source_key", F.struct(*_ESTIMATE).alias(f"e{level}"))
        on = F.lit(True)
        if level > 0:
            on = F.col("lang").eqNullSafe(F.col("lang_key"))
        if level > 1:
            on = on & F.col("source").eqNullSafe(F.col("source_key"))
        if level == 0:  # a single row, read as one value
            return rows.withColumn("e0", _only(side, "e0"))
        return rows.join(broadcast_if_small(side), on, "left").drop("lang_key", "source_key")

    for level in (2, 1, 0):
        rows = joined(rows, level)
    chosen = rows.withColumn("e", F.coalesce("e2", "e1", "e0")).withColumn(
        "level", F.when(F.col("e2").isNotNull(), 2).when(F.col("e1").isNotNull(), 1).when(F.col("e0").isNotNull(), 0)
    )
    flat = chosen.select(*columns, "level", *STATISTICS, *[F.col(f"e.{c}").alias(c) for c in _ESTIMATE])
    measured = flat.select(*columns, "level", _distance().alias("distance"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True))
    return measured.select(*columns, kept.alias("kept"), "distance", "level")


def _only(side: DataFrame, name: str) -> Column:
    """The single value of a table of at most one row, as a literal struct; null if there is none."""
    row = side.select(f"{name}.*").first()
    if row is None:
        return F.lit(None).cast(side.schema[name].dataType)
    return F.struct(*[F.lit(float(row[c])).alias(c) for c in _ESTIMATE])

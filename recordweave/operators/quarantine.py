"""Split off rows whose key cannot be used, with the reason."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from recordweave.functions.keys import (
    KEY_BAD_CHECK_DIGITS,
    has_valid_check_digits,
    is_usable_key,
    rejection_reason,
)
from recordweave.operators.standardise import SOURCE
from recordweave.sources.contracts import KEY

REJECT_REASON = "motivo_rejeicao"


class Split(NamedTuple):
    valid: DataFrame
    rejected: DataFrame


def with_reason(
    df: DataFrame, key: str = KEY, reason_on: str | None = None, check_digits: bool = False
) -> DataFrame:
    """Add the rejection reason, NULL for usable keys.

    ``reason_on`` names the column the reason is read from; without it the key
    itself is, and after normalisation that only ever says "absent".
    """
    reason = rejection_reason(F.col(key), F.col(reason_on) if reason_on else None)
    if check_digits:
        reason = F.coalesce(
            reason, F.when(~has_valid_check_digits(F.col(key)), F.lit(KEY_BAD_CHECK_DIGITS))
        )
    return df.withColumn(REJECT_REASON, reason)


def split_rejected(marked: DataFrame, source: str) -> Split:
    """Valid and rejected halves of a frame that carries the reason."""
    reason = F.col(REJECT_REASON)
    return Split(
        marked.filter(reason.isNull()).drop(REJECT_REASON),
        marked.filter(reason.isNotNull()).select(
            *[F.col(f"`{c}`") for c in marked.columns if c != REJECT_REASON],
            F.lit(source).alias(SOURCE),
            reason,
        ),
    )


def quarantine(
    df: DataFrame,
    source: str,
    key: str = KEY,
    reason_on: str | None = None,
    check_digits: bool = False,
) -> Split:
    return split_rejected(with_reason(df, key, reason_on, check_digits), source)


def drop_unusable(df: DataFrame, key: str = KEY) -> tuple[DataFrame, Observation]:
    """The rows with a usable key, and an observation of how many others there were (``dropped``).

    The rows are counted as they pass, so the number is there once the frame has been written or read.
    """
    usable = F.coalesce(is_usable_key(F.col(key)), F.lit(False))
    seen = Observation()
    return df.observe(seen, F.count_if(~usable).alias("dropped")).filter(usable), seen

"""Per-source format standardisation and audit annotation: one projection each."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from recordweave.functions.dates import parse_date, unreadable
from recordweave.functions.keys import normalize_key
from recordweave.functions.numbers import category_code, decimal_comma, unreadable_number
from recordweave.functions.text import blank_to_null
from recordweave.sources.contracts import KEY, ContractError, SourceSpec

ORIGINAL_KEY = "cpf_original"
SOURCE = "fonte"
DUPLICATE_REASON = "motivo_duplicidade"
UNREADABLE_DATES, UNREADABLE_NUMBERS = "_unreadable_dates", "_unreadable_numbers"


def standardise(df: DataFrame, spec: SourceSpec, carried: Sequence[str] = ()) -> DataFrame:
    """Key, dates, numbers, codes and blanks of one source, and its key as given.

    Also adds how many date cells and how many number cells of the row held text
    that no pattern reads, so a stage can report them.
    """
    if KEY not in df.columns:
        raise ContractError(f"{spec.name}: no {KEY} column")
    text = {f.name for f in df.schema if isinstance(f.dataType, StringType)}

    def cell(name: str) -> Column:
        c = F.col(f"`{name}`")
        if name in carried or name not in text:
            return c
        if name == KEY:
            return normalize_key(c).alias(name)
        if name in spec.date_columns:
            return parse_date(c).alias(name)
        if name in spec.number_columns:
            return decimal_comma(c).alias(name)
        if name in spec.code_columns:
            return category_code(c).alias(name)
        return blank_to_null(c).alias(name)

    dates = [c for c in spec.date_columns if c in text]
    numbers = [c for c in spec.number_columns if c in text]
    given = {c: f"_given_{c}" for c in [*dates, *numbers]}
    typed = df.select(
        *[cell(c) for c in df.columns],
        F.col(KEY).alias(ORIGINAL_KEY),
        *[F.col(f"`{c}`").alias(kept) for c, kept in given.items()],
    )
    unread = [unreadable(F.col(given[c]), F.col(f"`{c}`")).cast("int") for c in dates]
    no_number = [unreadable_number(F.col(given[c]), F.col(f"`{c}`")).cast("int") for c in numbers]
    return typed.select(
        *[F.col(f"`{c}`") for c in df.columns],
        ORIGINAL_KEY,
        reduce(add, unread, F.lit(0)).alias(UNREADABLE_DATES),
        reduce(add, no_number, F.lit(0)).alias(UNREADABLE_NUMBERS),
    )


def annotate_duplicates(df: DataFrame, source: str, reason: str) -> DataFrame:
    """Source and reason in front of the discarded rows."""
    return df.select(F.lit(source).alias(SOURCE), F.lit(reason).alias(DUPLICATE_REASON), "*")

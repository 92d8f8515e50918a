"""Numeric text: decimal comma, bounded decimals, category codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordweave.functions.text import blank_to_null, is_missing, strip

# Plain decimal or scientific notation. Guards the cast, which alone would also
# read Java literals such as '1d' and the words for NaN and infinity.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _plain_double(text: Column) -> Column:
    # Other text never reaches the cast, which would raise and catch an exception for it.
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def decimal_comma(c: Column) -> Column:
    """Double from text with a decimal point or comma; NULL when it is not a finite number."""
    number = _plain_double(strip(F.replace(c, F.lit(","), F.lit("."))))
    return F.when(F.abs(number) != float("inf"), number)


def _readable(c: Column) -> Column:
    text = strip(c.cast("string"))
    return text.rlike(NUMBER_PATTERN) | text.isin("Infinity", "-Infinity")


def load_decimal(c: Column, precision: int, scale: int) -> Column:
    """Target-typed decimal from a number or its text, rounded to its scale; NULL when it is not a number or too large."""
    return F.when(_readable(c), c.try_cast(f"decimal({precision},{scale})"))


def exceeds_decimal(c: Column, precision: int, scale: int) -> Column:
    """Whether a readable number is too large for the target type; such a row must not lose it unrecorded."""
    return F.coalesce(_readable(c), F.lit(False)) & c.try_cast(f"decimal({precision},{scale})").isNull()


def unreadable_number(given: Column, parsed: Column) -> Column:
    """Text that was given but is no finite number."""
    return ~is_missing(given) & parsed.isNull()


def category_code(c: Column) -> Column:
    """Integer part for numeric text, trimmed text otherwise, NULL for blank."""
    t = strip(c)
    whole = _plain_double(t).try_cast("bigint").cast("string")
    return F.coalesce(whole, blank_to_null(t))


def rounded(c: Column, places: int) -> Column:
    return F.round(c, places)

"""Missing-value and bounded-text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of "missing" in the delimited sources.
MISSING_SPELLINGS = (
    "", "NA", "N/A", "n/a", "NULL", "null", "None", "NaN", "nan", "-NaN", "-nan", "<NA>",
    "#N/A", "#N/A N/A", "#NA", "1.#IND", "-1.#IND", "1.#QNAN", "-1.#QNAN",
)

# Fixed value: name given to a person without one.
DEFAULT_NAME = "NOME NÃO INFORMADO"

# Whitespace removed at both ends of a cell before it is parsed.
WHITESPACE = " \t\n\r\x0b\x0c "


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def missing_to_null(c: Column) -> Column:
    """NULL for any of the missing spellings; other text is kept as it is."""
    return F.when(~c.isin(*MISSING_SPELLINGS), c)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def is_missing(c: Column) -> Column:
    """True for NULL or empty text; never NULL itself."""
    return F.coalesce(c.cast("string") == "", F.lit(True))


def bounded(c: Column, length: int) -> Column:
    """At most ``length`` characters; missing text becomes NULL."""
    return F.left(blank_to_null(c), F.lit(length))


def name_or_default(c: Column, length: int = 512) -> Column:
    return F.coalesce(bounded(c, length), F.lit(DEFAULT_NAME))

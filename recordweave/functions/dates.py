"""Date parsing. Everything that is not recognised becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordweave.functions.text import strip

# The usual form, which needs no rewriting.
PLAIN_ISO = r"^\d{4}-\d{2}-\d{2}$"

# Shapes read as a date: ISO with anything after it, day-first with one separator, compact.
SHAPES = r"^(?:\d{4}-\d{2}-\d{2}.*|\d{1,2}([/.-])\d{1,2}\1\d{4}|\d{8})$"
LOAD_SHAPES = r"^(?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}([/-])\d{1,2}\1\d{4})$"
MONTH_NAME_SHAPE = r"^\d{1,2} [A-Za-z]{3} \d{4}$"

_DAY_FIRST = r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})$"


def _year_first(text: Column, shapes: str) -> Column:
    """Text of one of the shapes with its year in front, empty for any other text.

    Patterns decide the shape and a cast reads the result.  Trying one date
    format after the other instead would raise and catch an exception for each
    format that does not fit, many times the cost of the rest.
    """
    known = F.regexp_extract(text, shapes, 0)
    return F.regexp_replace(known, _DAY_FIRST, "$3-$2-$1")


def parse_date(c: Column) -> Column:
    """Date from mixed text: ISO date or timestamp, or day first in one of the closed forms."""
    t = strip(c)
    plain = t.rlike(PLAIN_ISO)
    dashed = F.regexp_replace(_year_first(t, SHAPES), _COMPACT, "$1-$2-$3")
    # Through a timestamp, since a cast straight to date would accept trailing junk.
    numeric = dashed.try_cast("timestamp_ntz").cast("date")
    named = F.when(t.rlike(MONTH_NAME_SHAPE), F.try_to_date(t, "d MMM yyyy"))
    return F.when(plain, t.try_cast("date")).otherwise(F.coalesce(numeric, named))


def parse_load_date(c: Column) -> Column:
    """Date from the first ten characters: year first, or day first with slash or hyphen."""
    return _year_first(F.left(strip(c), F.lit(10)), LOAD_SHAPES).try_cast("date")


def unreadable(raw: Column, parsed: Column) -> Column:
    """True where text was given but no date came out of it."""
    t = strip(raw)
    return F.coalesce(parsed.isNull() & (t != "") & (t != "nan"), F.lit(False))

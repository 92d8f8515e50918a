"""Delimited text in and out.

Every column is scanned as text; types are given by the standardise step.  Row
order inside the files is kept as three columns, because "first row wins" needs
it and a DataFrame has none: file, block within the file, running number.  The
running number alone is unique but does not follow the files, since splits are
packed largest first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from recordweave.functions.keys import key_text
from recordweave.functions.text import missing_to_null

FILE_ORDER = ("_file", "_block", "_row")

# Quotes are doubled inside quoted cells, not escaped with a backslash.
_FORMAT = {"header": True, "escape": '"', "encoding": "UTF-8"}


def clean_cells(df: DataFrame, key: str | None = "cpf") -> list[Column]:
    """The text columns of a scan: missing spellings to NULL, the key repaired."""

    def cell(name: str) -> Column:
        c = missing_to_null(df[f"`{name}`"])
        return (key_text(c) if name == key else c).alias(name)

    return [cell(f.name) for f in df.schema if isinstance(f.dataType, StringType)]


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    key: str | None = "cpf",
    multi_line: bool = False,
    mode: str = "FAILFAST",
    keep_order: bool = True,
) -> DataFrame:
    """Scan headed UTF-8 text, one string column per header name.

    A file whose header differs from the first one's fails the read, and so does
    a row with the wrong number of cells; ``mode="PERMISSIVE"`` pads short rows
    with NULL instead.  Cells with line breaks need ``multi_line=True``, which
    reads each file in one task.
    """
    options = {**_FORMAT, "multiLine": multi_line}
    schema = spark.read.options(**options).csv(path).schema
    raw = spark.read.schema(schema).options(**options, enforceSchema=False, mode=mode).csv(path)
    columns = clean_cells(raw, key)
    if not keep_order:
        return raw.select(*columns)
    return raw.select(
        *columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def write_delimited(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headed UTF-8 text; dates as ISO text, NULL and empty text both as nothing."""
    df.write.mode(mode).options(**_FORMAT, emptyValue="").csv(path)

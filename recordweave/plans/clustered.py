"""Stage tables in Spark's own buckets, so that what follows groups and joins by key without a shuffle.

Such a table is Parquet whose files hold one hash of the key each, sorted by it, and an entry in the session's catalog that says
so; Spark reads buckets only through the catalog.  The entry is made again whenever a table is taken from disk, under a name
that follows from the folder, so that a resumed run in another session finds it.  Rows are dealt once, when they are written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from recordweave.storage import delete_folder


@dataclass(frozen=True)
class Clustered:
    """How a table is cut: by Spark's hash of ``key`` into ``count`` buckets."""

    key: str
    count: int

    def deal(self, df: DataFrame, wanted: Column) -> DataFrame:
        """``df`` with its ``wanted`` rows dealt by key, a bucket to a task, and the others by a hash of the whole row.

        The others may share a key (or lack one) in any number; they are spread over all tasks.
        """
        whole = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("string")
        return df.repartition(self.count, F.when(wanted, F.col(self.key).cast("string")).otherwise(whole))


def _entry(path: str) -> str:
    return f"recordweave_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def write_clustered(df: DataFrame, path: str, layout: Clustered, split_by: str | None = None) -> None:
    """Write rows that were dealt by key before; the folder is emptied first."""
    spark, entry = df.sparkSession, _entry(path)
    spark.sql(f"DROP TABLE IF EXISTS {entry}")
    delete_folder(spark, path)
    writer = df.write.format("parquet").bucketBy(layout.count, layout.key).sortBy(layout.key).option("path", path)
    if split_by:
        writer = writer.partitionBy(split_by)
    writer.saveAsTable(entry)
    spark.sql(f"DROP TABLE {entry}")  # an external table: its files stay


def clustered_table(
    spark: SparkSession, path: str, columns: Mapping[str, DataType], layout: Clustered, split_by: Sequence[str] = ()
) -> DataFrame:
    """The table at ``path``; ``split_by`` are the columns that its folders are named after."""
    entry, place = _entry(path), path.replace("\\", "\\\\").replace("'", "\\'")
    shown = ", ".join(f"`{name}` {kind.simpleString()}" for name, kind in columns.items())
    folders = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in split_by)})" if split_by else ""
    spark.sql(f"DROP TABLE IF EXISTS {entry}")
    spark.sql(
        f"CREATE TABLE {entry} ({shown}) USING parquet {folders} "
        f"CLUSTERED BY (`{layout.key}`) SORTED BY (`{layout.key}`) INTO {layout.count} BUCKETS LOCATION '{place}'"
    )
    if split_by:
        spark.sql(f"ALTER TABLE {entry} RECOVER PARTITIONS")
    return spark.table(entry)


def common_columns(frames: Sequence[DataFrame]) -> dict[str, DataType]:
    """All columns of some frames; a name with two types can't be one column of a table."""
    columns: dict[str, DataType] = {}
    for df in frames:
        for field in df.schema:
            if columns.setdefault(field.name, field.dataType) != field.dataType:
                raise ValueError(
                    f"column {field.name} is {columns[field.name].simpleString()} in one source and "
                    f"{field.dataType.simpleString()} in another; buckets need one type"
                )
    return columns

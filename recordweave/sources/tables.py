"""Entity and audit tables: Parquet, with an optional JDBC sink."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recordweave.storage import folder_exists


def empty_table(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """No rows of a schema, known to be empty at planning time, so joins with it vanish."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    cells = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    return spark.range(1).select(*cells).limit(0)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The table at ``path``; with a ``schema``, an absent table is an empty one."""
    if schema is None:
        return spark.read.parquet(path)
    if not folder_exists(spark, path):
        return empty_table(spark, schema)
    return spark.read.schema(schema).parquet(path)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write a new table; the schema survives even when there are no rows."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_record(spark: SparkSession, path: str) -> Row | None:
    """The one-row JSON document at ``path``, or None when it is absent or unfinished."""
    if not folder_exists(spark, f"{path}/_SUCCESS"):
        return None
    return spark.read.json(path).first()


def write_record(spark: SparkSession, path: str, record: Mapping[str, object], schema: str) -> None:
    """One row as a JSON document: run manifests, metrics and stage markers."""
    parsed = F.from_json(F.lit(json.dumps(record, ensure_ascii=False)), schema)
    row = spark.range(1, numPartitions=1).select(parsed.alias("r")).select("r.*")
    row.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    batch_rows: int = 500,
    connections: int = 8,
) -> None:
    """Append to a database table, with a bounded number of parallel connections."""
    # A shuffle, so that only the writing tasks are few and not the stage before them.
    (
        df.repartition(connections)
        .write.mode("append")
        .option("batchsize", batch_rows)
        .jdbc(url, table, properties=dict(properties or {}))
    )


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    split_by: str = "id",
    bounds: tuple[int, int] | None = None,
    connections: int = 8,
) -> DataFrame:
    """A catalog or key map of the target database; with ``bounds`` of a number column, over several connections."""
    given = dict(properties or {})
    if bounds is None:
        return spark.read.jdbc(url, table, properties=given)
    low, high = bounds
    return spark.read.jdbc(
        url, table, column=split_by, lowerBound=low, upperBound=high, numPartitions=connections, properties=given
    )

"""From documents to packed training sequences: the stages of the corpus pipeline.

Each stage takes (spark, docs, sf_dir), works on all rows the stage before has kept, and returns a frame that
is written as Parquet and read again.  All but the last return the columns of ``documents``.

1. language: rows whose text is in none of the languages go.
2. near_duplicates: of every group of near-duplicates the row with the smallest id stays.
3. decontamination: rows that hold a benchmark item go.
4. secrets: what the scan finds is replaced in the text; ``n_chars`` follows.
5. packing: the texts become token pieces placed in sequences.

Null ids and texts, empty texts, repeated rows, empty tables and further columns are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordweave.llm import decontaminate, language_id, packing, secret_scan, simhash_gray
from recordweave.storage import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.learn(docs, F.lit(True)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_gray.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact_secrets(docs, length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", pack),
]

#: No stage can be said in SQL; tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}

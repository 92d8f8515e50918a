"""Shards by jump consistent hashing, in DataFrame operations only.

A key alone, with the number of shards, decides its shard; there is no table of ring positions.  Counting up
the number of shards, a key moves only ever into the shard that was just added, and it does so with
the chance that keeps all shards equal.  The function jumps from one move to the next:
a linear congruential step gives a random number, which tells at which number of shards the key moves again.

Numbers are unsigned 64-bit.  Spark's bigint would overflow in the product, so the step is
done on decimals of 38 digits, which hold it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordweave.llm.common import number_within

SHARDS = 16
#: Parts in which the rows of one shard are numbered side by side.
SLOT_PARTS = 256
_MULTIPLIER = 2862933555777941757
_TWO_64 = 1 << 64
_WIDE = "decimal(38,0)"


def _wide(value: int) -> Column:
    return F.lit(str(value)).cast(_WIDE)


def unsigned(key: Column) -> Column:
    """A bigint as a decimal from 0 to 2^64 - 1; null counts as 0."""
    wide = F.coalesce(key.cast("bigint"), F.lit(0)).cast(_WIDE)
    return F.when(wide < 0, wide + _wide(_TWO_64)).otherwise(wide).cast("decimal(20,0)")


def next_state(state: Column) -> Column:
    """One step of the generator, modulo 2^64."""
    product = state * F.lit(str(_MULTIPLIER)).cast("decimal(19,0)")
    return ((product.cast(_WIDE) + F.lit(1).cast(_WIDE)) % _wide(_TWO_64)).cast("decimal(20,0)")


def jump_shard(key: Column, shards: int) -> Column:
    """The shard of a key, from 0 to ``shards`` - 1."""

    def step(s: Column, _: Column) -> Column:
        state = next_state(s["state"])
        # the high 31 bits, plus one, of the generator give a number between 0 and 1
        draw = F.floor(state / _wide(1 << 33)).cast("double") + 1.0
        following = F.floor((s["following"] + 1).cast("double") * (F.lit(float(1 << 31)) / draw)).cast("bigint")
        moved = F.struct(state.alias("state"), s["following"].alias("bucket"), following.alias("following"))
        return F.when(s["following"] < shards, moved).otherwise(s)

    start = F.struct(
        unsigned(key).alias("state"), F.lit(-1).cast("bigint").alias("bucket"), F.lit(0).cast("bigint").alias("following")
    )
    # each jump goes up by one at least, so there are at most as many as shards
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["bucket"].cast("int"))


def slot_part(key: Column, size: Column, checksum: Column) -> Column:
    """The part in which a row is numbered: the top eight bits of the generator's number for the id plus its text's size and checksum.

    The shard follows from the id alone, the part does not, so a shard whose rows have one id is numbered by many tasks too.
    """
    mixed = (unsigned(key).cast(_WIDE) + checksum.cast(_WIDE) * _wide(1 << 32) + size.cast(_WIDE)) % _wide(_TWO_64)
    return F.floor(next_state(mixed.cast("decimal(20,0)")) / _wide(_TWO_64 // SLOT_PARTS)).cast("int")


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    The law is ``key``: the id and the number of shards decide, so equal texts with different ids may lie in different
    shards and rows with one id lie in one.  ``slot`` counts a shard's rows from 0 in the order
    of the part, the id, the size and the checksum.  ``grown_shard`` is the shard with one shard more: the
    same, or the new one.  A null id counts as key 0 and stays null.  Null and empty texts have size 1 and checksum 0.
    Repeated rows get a slot each.  An empty table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = F.col("doc_id")
    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = rows.select(
        "*", F.lit("key").alias("law"), jump_shard(key, shards).alias("shard"), jump_shard(key, shards + 1).alias("grown_shard")
    )
    order = [F.col("doc_id").asc_nulls_first(), "size", "text_crc32"]
    numbered = number_within(placed, ["shard"], slot_part(key, F.col("size"), F.col("text_crc32")), order, "slot")
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", shards: int = SHARDS) -> None:
    """Write all columns of ``docs`` as Parquet in one folder ``shard=k`` for each shard.

    Rows are dealt by shard and a hash of the row, so several tasks write one shard, also where its rows have one id.
    """
    key = F.col(f"`{id_col}`").cast("bigint")
    placed = docs.withColumn("shard", jump_shard(key, shards))
    cells = [F.col(f"`{name}`") for name, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    placed.repartition("shard", F.pmod(F.xxhash64(*cells), F.lit(8))).write.partitionBy("shard").parquet(path)


#: The same result in DuckDB; HUGEINT holds the products, and the checksum is taken byte by byte from a table of its 256 steps.
ORACLE_SQL = f"""
WITH RECURSIVE
steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab
),
texts AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS digits,
         ((CAST(coalesce(doc_id, 0) AS HUGEINT) % {_TWO_64}::HUGEINT) + {_TWO_64}::HUGEINT) % {_TWO_64}::HUGEINT AS base
  FROM documents
),
sums AS (
  SELECT r, doc_id, base, length(digits) // 2 + 1 AS size,
         xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(length(digits) // 2), lambda i: CAST('0x' || substr(digits, 2 * i + 1, 2) AS BIGINT))),
           lambda crc, b: xor(tab[xor(crc & 255, b) + 1], crc >> 8))) AS text_crc32
  FROM texts, steps
),
jumps AS (
  SELECT r, base AS state, CAST(-1 AS BIGINT) AS bucket, CAST(0 AS BIGINT) AS following FROM texts
  UNION ALL
  SELECT r, next_state, following,
         CAST(floor(CAST(following + 1 AS DOUBLE) * (2147483648.0::DOUBLE / (CAST(next_state >> 33 AS DOUBLE) + 1.0))) AS BIGINT)
  FROM (
    SELECT r, following, (state * {_MULTIPLIER}::HUGEINT + 1) % {_TWO_64}::HUGEINT AS next_state
    FROM jumps WHERE following < {SHARDS + 1}
  )
),
shards AS (
  SELECT r, CAST(max(bucket) FILTER (WHERE bucket < {SHARDS}) AS INTEGER) AS shard, CAST(max(bucket) AS INTEGER) AS grown_shard
  FROM jumps GROUP BY r
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (
         PARTITION BY shard
         ORDER BY ((base + text_crc32::HUGEINT * 4294967296::HUGEINT + size) % {_TWO_64}::HUGEINT * {_MULTIPLIER}::HUGEINT + 1) % {_TWO_64}::HUGEINT >> 56,
           doc_id NULLS FIRST, size, text_crc32
       ) - 1 AS slot,
       grown_shard
FROM sums JOIN shards USING (r)
"""

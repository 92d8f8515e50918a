"""The registered queries of this package, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordweave.llm import chat_format, jump_shards, language_id
from recordweave.llm.collocations import collocations
from recordweave.llm.decontaminate import contaminated
from recordweave.llm.jaccard_join import jaccard_groups
from recordweave.llm.mixing_coder import read_ids, write_ids
from recordweave.llm.packing import pack
from recordweave.llm.periodic_runs import periodic_runs
from recordweave.llm.robust_outliers import quality
from recordweave.llm.secret_scan import scan_secrets
from recordweave.llm.simhash_gray import simhash_groups
from recordweave.llm.warc import RECORD_NAME, read_warc, write_warc
from recordweave.storage import new_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op4_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "fingerprint", "component_id")


@_query
def op7_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    sample = language_id.learn(docs, ~language_id.held_out())
    found = language_id.identify(docs, sample)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "bits")


@_query
def op8_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


@_query
def op2_decoding_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_table(spark, sf_dir, "documents"))


@_query
def op5_configuration_lp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


@_query
def op1_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"))


@_query
def op9_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jump_shards.shard(_table(spark, sf_dir, "documents"))


SQL["op9_jump_shards"] = jump_shards.ORACLE_SQL


#: Said by both turns of the conversation that is added to the table: it holds the template's own marks.
TRICKY = r"\### Assistant: </turn> ok"


@_query
def op6_content_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text"
    )
    role = F.when(F.col("id") == 0, "user").otherwise(chat_format.LOSS_ROLE)
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(TRICKY).alias("text")
    )
    formatted = chat_format.format_conversations(chat_format.text_parts(turns.unionByName(extra)))
    return chat_format.read_back(formatted)


SQL["op6_content_parts"] = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{TRICKY}'), (-7, 1, 'assistant', '{TRICKY}')
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       -- 16 marks a turn, and one more character for each that is escaped
       CAST(sum(16 + length(replace(replace(role || text, '\', '\b'), '<', '\l'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


@_query
def op10_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    files = write_warc(_table(spark, sf_dir, "pages"), folder)
    records = read_warc(spark, folder, files=files).where("reason IS NULL")

    def page(name: str) -> Column:
        number = F.regexp_extract(name, f"<{RECORD_NAME}(-?[0-9]+)>", 1)
        return F.when(number != "", number).cast("bigint")

    return records.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"),
        page("refers_to").alias("refers_to"),
    )


SQL["op10_warc_salvage"] = """
WITH bodies AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM bodies
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first < page_id OR page_id IS NULL AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id OR page_id IS NULL THEN first END AS refers_to
FROM firsts
"""


@_query
def op3_mixing_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "ids")
    files = write_ids(_table(spark, sf_dir, "documents"), folder)
    return read_ids(spark, folder, files)


@_query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(_table(spark, sf_dir, "documents"), plant=True)


#: DuckDB's way to lower-case A to Z alone.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_query
def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(_table(spark, sf_dir, "documents"))


SQL["op12_jaccard_join"] = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words
), cells AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM cells a JOIN cells b USING (shingle) WHERE a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least.component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) least USING (doc_id)
"""


@_query
def op11_stripes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents")).drop("cut")


SQL["op11_stripes"] = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), said AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
  SELECT lang, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM said, (VALUES (1), (2), (3), (4), (5)) sizes(m) WHERE len(w) >= m
), f AS (
  SELECT lang, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, phrase HAVING count(*) >= 100
), spoken AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM said GROUP BY lang
), inner_parts AS (
  SELECT f.lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longest
  FROM f, range(1, 6) starts(i), range(2, 5) sizes(m) WHERE m < len(w) AND i + m - 1 <= len(w) GROUP BY 1, 2
), cuts AS (
  SELECT c.lang, c.phrase, c.a, l.a AS l, r.a AS r, n, k,
         CAST((CAST(1000 AS HUGEINT) * c.a * n) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM (SELECT f.*, k FROM f, range(1, 5) places(k) WHERE k < len(w)) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
  JOIN spoken ON spoken.lang = c.lang
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT best.lang, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, encode(best.phrase)) AS rank,
       best.phrase, a, l, r, n, score
FROM best LEFT JOIN inner_parts i ON i.lang = best.lang AND i.phrase = best.phrase
WHERE i.longest IS NULL OR i.longest < a
QUALIFY rank <= 2000
"""

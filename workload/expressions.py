"""Scalar functions over whole tables."""

from pyspark.sql import functions as F

from recordweave.functions.dates import parse_date, parse_load_date, unreadable
from recordweave.functions.keys import key_text, mask_key, normalize_key
from recordweave.functions.numbers import category_code, decimal_comma, exceeds_decimal, load_decimal, rounded
from recordweave.functions.text import (
    blank_to_null,
    bounded,
    is_missing,
    missing_to_null,
    name_or_default,
)
from recordweave.operators.standardise import standardise
from recordweave.sources.contracts import GESTAO, consolidated_order, to_canonical
from workload.registry import query, table
from workload.sqltext import (
    NUMBER,
    GESTAO_TYPED,
    sql_category_code,
    sql_decimal_comma,
    sql_key_text,
    sql_normalize_key,
    sql_parse_date,
    sql_parse_load_date,
)
from workload.standins import (
    CUSTOMER_KEY,
    EVENT_SPELLING,
    ORDER_DATE,
    ORDER_PRICE,
    PART_CODE,
    derive,
    gestao,
    padded,
)

# --- queries ---------------------------------------------------------------------------


@query(
    "key_normalize",
    f"""SELECT c_custkey, {sql_key_text('raw')} AS key_text,
      {sql_normalize_key(sql_key_text('raw'))} AS cpf
    FROM (SELECT c_custkey, {CUSTOMER_KEY} AS raw FROM customer)""",
)
def key_normalize(spark, sf_dir):
    raw = derive(spark, sf_dir, "customer", f"c_custkey, {CUSTOMER_KEY} AS raw")
    text = key_text(F.col("raw"))
    return raw.select("c_custkey", text.alias("key_text"), normalize_key(text).alias("cpf"))


@query(
    "key_mask",
    f"""SELECT c_custkey, regexp_replace({padded('c_custkey')},
      '^(\\d{{3}})(\\d{{3}})(\\d{{3}})(\\d{{2}})$', '\\1.\\2.\\3-\\4') AS masked FROM customer""",
)
def key_mask(spark, sf_dir):
    keys = derive(spark, sf_dir, "customer", f"c_custkey, {padded('c_custkey')} AS cpf")
    return keys.select("c_custkey", mask_key(F.col("cpf")).alias("masked"))


@query(
    "date_parse",
    f"""SELECT o_orderkey, {sql_parse_date('raw')} AS parsed,
      coalesce({sql_parse_date('raw')} IS NULL AND trim(raw) NOT IN ('', 'nan'), false) AS unreadable
    FROM (SELECT o_orderkey, {ORDER_DATE} AS raw FROM orders)""",
)
def date_parse(spark, sf_dir):
    raw = derive(spark, sf_dir, "orders", f"o_orderkey, {ORDER_DATE} AS raw")
    parsed = parse_date(F.col("raw"))
    return raw.select(
        "o_orderkey", parsed.alias("parsed"), unreadable(F.col("raw"), parsed).alias("unreadable")
    )


@query(
    "date_parse_load",
    f"""SELECT o_orderkey, {sql_parse_load_date('raw')} AS parsed
    FROM (SELECT o_orderkey, {ORDER_DATE} AS raw FROM orders)""",
)
def date_parse_load(spark, sf_dir):
    raw = derive(spark, sf_dir, "orders", f"o_orderkey, {ORDER_DATE} AS raw")
    return raw.select("o_orderkey", parse_load_date(F.col("raw")).alias("parsed"))


@query(
    "decimal_comma",
    f"""SELECT o_orderkey, {sql_decimal_comma('raw')} AS number,
      round({sql_decimal_comma('raw')}, 1) AS rounded
    FROM (SELECT o_orderkey, {ORDER_PRICE} AS raw FROM orders)""",
)
def decimal_comma_query(spark, sf_dir):
    raw = derive(spark, sf_dir, "orders", f"o_orderkey, {ORDER_PRICE} AS raw")
    number = decimal_comma(F.col("raw"))
    return raw.select("o_orderkey", number.alias("number"), rounded(number, 1).alias("rounded"))


@query(
    "load_decimal",
    "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(14,2)) AS amount, "
    "CAST(o_totalprice / 1000 AS DECIMAL(4,1)) AS score FROM orders",
)
def load_decimal_query(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        load_decimal(F.col("o_totalprice"), 14, 2).alias("amount"),
        load_decimal(F.col("o_totalprice") / 1000, 4, 1).alias("score"),
    )


@query(
    "load_decimal_text",
    f"""SELECT o_orderkey, CASE WHEN readable THEN try_cast(value AS DECIMAL(7,2)) END AS amount,
      readable AND try_cast(value AS DECIMAL(7,2)) IS NULL AS too_large
    FROM (SELECT o_orderkey, coalesce(regexp_matches(trim(raw), '{NUMBER}'), false) AS readable,
        try_cast(trim(raw) AS DOUBLE) AS value
      FROM (SELECT o_orderkey, {ORDER_PRICE} AS raw FROM orders))""",
)
def load_decimal_text(spark, sf_dir):
    raw = derive(spark, sf_dir, "orders", f"o_orderkey, {ORDER_PRICE} AS raw")
    return raw.select(
        "o_orderkey",
        load_decimal(F.col("raw"), 7, 2).alias("amount"),
        exceeds_decimal(F.col("raw"), 7, 2).alias("too_large"),
    )


@query(
    "category_code",
    f"""SELECT p_partkey, {sql_category_code('raw')} AS code
    FROM (SELECT p_partkey, {PART_CODE} AS raw FROM part)""",
)
def category_code_query(spark, sf_dir):
    raw = derive(spark, sf_dir, "part", f"p_partkey, {PART_CODE} AS raw")
    return raw.select("p_partkey", category_code(F.col("raw")).alias("code"))


@query(
    "null_sentinels",
    f"""SELECT event_id, CASE WHEN raw NOT IN ('', 'NA', 'N/A', 'n/a', 'NULL', 'null', 'None',
      'NaN', 'nan', '-NaN', '-nan', '<NA>', '#N/A', '#N/A N/A', '#NA', '1.#IND', '-1.#IND',
      '1.#QNAN', '-1.#QNAN') THEN raw END AS value
    FROM (SELECT event_id, {EVENT_SPELLING} AS raw FROM events)""",
)
def null_sentinels(spark, sf_dir):
    raw = derive(spark, sf_dir, "events", f"event_id, {EVENT_SPELLING} AS raw")
    return raw.select("event_id", missing_to_null(F.col("raw")).alias("value"))


@query(
    "blank_to_null",
    f"""SELECT event_id, nullif(raw, '') AS value, coalesce(raw = '', true) AS missing
    FROM (SELECT event_id, {EVENT_SPELLING} AS raw FROM events)""",
)
def blank_to_null_query(spark, sf_dir):
    raw = derive(spark, sf_dir, "events", f"event_id, {EVENT_SPELLING} AS raw")
    c = F.col("raw")
    return raw.select(
        "event_id", blank_to_null(c).alias("value"), is_missing(c).alias("missing")
    )


_NAME = "CASE lang WHEN 'fr' THEN NULL WHEN 'de' THEN '' ELSE text END"


@query(
    "bounded_text_default",
    f"""SELECT doc_id, coalesce(left(nullif({_NAME}, ''), 512), 'NOME NÃO INFORMADO') AS nome,
      left(nullif(source, ''), 4) AS short FROM documents""",
)
def bounded_text_default(spark, sf_dir):
    raw = derive(spark, sf_dir, "documents", f"doc_id, source, {_NAME} AS nome")
    return raw.select(
        "doc_id",
        name_or_default(F.col("nome")).alias("nome"),
        bounded(F.col("source"), 4).alias("short"),
    )


@query("rename_canonical", f"SELECT * EXCLUDE (raw_key) FROM ({GESTAO_TYPED})")
def rename_canonical(spark, sf_dir):
    canonical = to_canonical(gestao(spark, sf_dir), GESTAO, carried=["_order"])
    typed = standardise(canonical, GESTAO, carried=["_order"])
    names = [c for c in consolidated_order(canonical.columns) if c != "_order"]
    return typed.select(*names, "_order")

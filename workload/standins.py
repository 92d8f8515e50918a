"""Raw source text derived from the test tables.

The tables are clean, so the defects a source has (masks, lost digits, missing
spellings, mixed date styles, repeated keys) are spelled out from their own
columns.  Each derivation is one SQL text that Spark and the checking engine
both read, so both start from the same rows.  All rows of the tables are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordweave.sources.delimited import clean_cells
from workload.registry import table


def padded(column: str) -> str:
    return f"lpad(CAST({column} AS STRING), 11, '0')"


def masked(column: str) -> str:
    p = padded(column)
    return (
        f"(substr({p}, 1, 3) || '.' || substr({p}, 4, 3) || '.' || substr({p}, 7, 3) "
        f"|| '-' || substr({p}, 10, 2))"
    )


CUSTOMER_KEY = f"""CASE c_nationkey
  WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'sem cpf'
  WHEN 3 THEN substr({padded('c_custkey')}, 2) WHEN 4 THEN {padded('c_custkey')} || '7'
  WHEN 5 THEN {padded('c_custkey')} || '.0' WHEN 6 THEN '  ' || {padded('c_custkey')} || ' '
  WHEN 7 THEN 'nan' WHEN 8 THEN {padded('c_custkey')}
  WHEN 9 THEN {masked('c_custkey - 1')}
  ELSE {masked('c_custkey')} END"""

_YEAR = "CAST(year(o_orderdate) AS STRING)"
_M, _D = "CAST(month(o_orderdate) AS STRING)", "CAST(day(o_orderdate) AS STRING)"
_MM, _DD = f"lpad({_M}, 2, '0')", f"lpad({_D}, 2, '0')"
_ISO = f"{_YEAR} || '-' || {_MM} || '-' || {_DD}"

ORDER_DATE = f"""CASE o_orderstatus || substr(o_orderpriority, 1, 1)
  WHEN 'F1' THEN {_ISO} || ' 10:11:12' WHEN 'O1' THEN {_ISO} || 'T23:30:00Z'
  WHEN 'P1' THEN {_ISO} || ' junk'
  WHEN 'F2' THEN {_DD} || '/' || {_MM} || '/' || {_YEAR}
  WHEN 'O2' THEN {_D} || '/' || {_M} || '/' || {_YEAR}
  WHEN 'P2' THEN '31/02/' || {_YEAR}
  WHEN 'F3' THEN {_DD} || '-' || {_MM} || '-' || {_YEAR}
  WHEN 'O3' THEN {_D} || '.' || {_M} || '.' || {_YEAR}
  WHEN 'P3' THEN {_YEAR} || {_MM} || {_DD}
  WHEN 'F4' THEN '' WHEN 'O4' THEN NULL WHEN 'P4' THEN ' nan '
  WHEN 'F5' THEN {_YEAR} || '/' || {_MM} || '/' || {_DD}
  WHEN 'O5' THEN {_YEAR} || '-13-45'
  ELSE '  ' || {_ISO} || ' ' END"""

_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING)"

ORDER_PRICE = f"""CASE o_orderstatus || substr(o_orderpriority, 1, 1)
  WHEN 'F1' THEN {_PRICE} WHEN 'O1' THEN replace({_PRICE}, '.', ',')
  WHEN 'P1' THEN '1.' || replace({_PRICE}, '.', ',')
  WHEN 'F2' THEN ' ' || {_PRICE} || ' ' WHEN 'O2' THEN '-' || {_PRICE}
  WHEN 'P2' THEN {_PRICE} || 'd'
  WHEN 'F3' THEN '1e3' WHEN 'O3' THEN 'inf' WHEN 'P3' THEN 'nan'
  WHEN 'F4' THEN '' WHEN 'O4' THEN NULL WHEN 'P4' THEN '1_000'
  WHEN 'F5' THEN '0x10' WHEN 'O5' THEN '1e999'
  ELSE '+' || replace({_PRICE}, '.', ',') END"""

_SIZE = "CAST(p_size AS STRING)"

PART_CODE = f"""CASE p_type
  WHEN 'STANDARD' THEN {_SIZE} WHEN 'ECONOMY' THEN {_SIZE} || '.0'
  WHEN 'MEDIUM' THEN '0' || {_SIZE} WHEN 'PROMO' THEN ' ' || p_brand || ' '
  WHEN 'LARGE' THEN CASE WHEN p_size > 20 THEN '1e30' ELSE '-' || {_SIZE} || '.9' END
  ELSE CASE WHEN p_size > 20 THEN '' ELSE '  ' END END"""

EVENT_SPELLING = """CASE hour(ts)
  WHEN 0 THEN '' WHEN 1 THEN 'NA' WHEN 2 THEN 'N/A' WHEN 3 THEN 'n/a' WHEN 4 THEN 'NULL'
  WHEN 5 THEN 'null' WHEN 6 THEN 'None' WHEN 7 THEN 'NaN' WHEN 8 THEN 'nan' WHEN 9 THEN '-NaN'
  WHEN 10 THEN '-nan' WHEN 11 THEN '<NA>' WHEN 12 THEN '#N/A' WHEN 13 THEN '#N/A N/A'
  WHEN 14 THEN '#NA' WHEN 15 THEN '1.#IND' WHEN 16 THEN '-1.#IND' WHEN 17 THEN '1.#QNAN'
  WHEN 18 THEN '-1.#QNAN' WHEN 19 THEN 'none' WHEN 20 THEN ' NA' WHEN 21 THEN NULL
  ELSE event_type END"""

_BALANCE = "CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS STRING)"

# Contract columns of the three sources, as SELECT lists over one test table each.
RH_SELECT = f"""
  CASE WHEN c_nationkey = 10 THEN '' ELSE c_name END AS nome,
  {CUSTOMER_KEY} AS cpf,
  CAST(DATE '1960-01-01' + c_nationkey * 365 AS STRING) AS data_nascimento,
  'ORG-' || CAST(c_nationkey AS STRING) AS sigla_orgao,
  CASE WHEN c_nationkey = 11 THEN '' ELSE CAST(DATE '2010-01-01' + c_nationkey * 30 AS STRING) END
    AS data_admissao,
  '' AS data_saida,
  CAST('M' || CAST(c_custkey AS STRING) AS STRING) AS matricula,
  c_mktsegment AS cargo,
  CASE WHEN c_nationkey < 15 THEN 'efetivo' WHEN c_nationkey < 20 THEN 'comissionado'
    ELSE 'cedido' END AS tipo_vinculo,
  replace({_BALANCE}, '.', ',') AS salario_base,
  'Lotacao ' || CAST(c_nationkey AS STRING) AS lotacao,
  CASE WHEN c_nationkey < 18 THEN 'ativo' WHEN c_nationkey < 22 THEN 'afastado'
    ELSE 'exonerado' END AS status_servidor,
  c_custkey AS _order"""

ESOCIAL_SELECT = f"""
  'Cliente ' || CAST(o_custkey AS STRING) AS nome,
  {padded('o_custkey')} AS cpf,
  '' AS data_nascimento,
  'ORG-' || CAST(year(o_orderdate) AS STRING) AS sigla_orgao,
  CAST(o_orderkey AS STRING) AS id_evento,
  CASE o_orderstatus WHEN 'F' THEN 'admissao' WHEN 'O' THEN 'afastamento'
    ELSE 'desligamento' END AS tipo_evento,
  {ORDER_DATE} AS data_evento,
  substr(o_orderpriority, 1, 1) || '01.0' AS codigo_categoria,
  'original' AS indicador_retificacao,
  'REC-' || CAST(o_orderkey AS STRING) AS numero_recibo,
  o_orderkey AS _order"""

GESTAO_SELECT = f"""
  p_name AS nome,
  CASE WHEN p_type = 'PROMO' THEN {padded('p_partkey - 1')} ELSE {padded('p_partkey')} END AS cpf,
  lpad(CAST(1 + p_size % 28 AS STRING), 2, '0') || '/03/1980' AS "dataNascimento",
  p_brand AS orgao,
  '01/02/2015' AS "dataEntrada",
  '' AS "dataSaida",
  'G' || CAST(p_partkey AS STRING) AS matricula,
  p_type AS cargo,
  'efetivo' AS "tipoVinculo",
  CAST(CAST(p_retailprice AS DECIMAL(15,2)) AS STRING) AS salario,
  'Setor ' || CAST(p_size AS STRING) AS "unidadeLotacao",
  'ativo' AS status,
  CASE WHEN p_size > 20 THEN 'M' ELSE 'F' END AS sexo,
  '' AS "estadoCivil",
  'parda' AS cor,
  'Brasileira' AS nacionalidade,
  'p' || CAST(p_partkey AS STRING) || '@example.org' AS email,
  CAST(p_size AS STRING) AS telefone,
  CASE WHEN p_size > 35 THEN '' ELSE '4,' || CAST(p_size % 10 AS STRING) END AS "avaliacaoDesempenho",
  CASE WHEN p_size < 5 THEN '' ELSE '2023' END AS "cicloAvaliacao",
  p_partkey AS _order"""


def derive(spark: SparkSession, sf_dir: str, name: str, select: str) -> DataFrame:
    """Rows of ``name`` under a SELECT list written for both engines."""
    source = table(spark, sf_dir, name)
    return spark.sql(f"SELECT {select.replace(chr(34), chr(96))} FROM {{t}}", t=source)


def scanned(df: DataFrame) -> DataFrame:
    """Text cells as a delimited scan would hand them over."""
    return df.select(*clean_cells(df), "_order")


def rh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(derive(spark, sf_dir, "customer", RH_SELECT))


def esocial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(derive(spark, sf_dir, "orders", ESOCIAL_SELECT))


def gestao(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(derive(spark, sf_dir, "part", GESTAO_SELECT))

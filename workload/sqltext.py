"""SQL the checking engine runs: expressions as functions of a column, and whole sources."""

from workload.standins import ESOCIAL_SELECT, GESTAO_SELECT, RH_SELECT

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def sql_key_text(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL OR trim({c}) IN ('nan', '<NA>') THEN '' "
        f"ELSE regexp_replace(trim({c}), '^([0-9]+)\\.0+$', '\\1') END"
    )


def sql_normalize_key(c: str) -> str:
    d = f"regexp_replace({c}, '[^0-9]', '', 'g')"
    return f"CASE WHEN length({d}) = 11 THEN {d} END"


def sql_parse_date(c: str) -> str:
    t = f"trim({c})"
    tries = ", ".join(
        f"try_strptime({t}, '{p}')" for p in ("%d-%m-%Y", "%d.%m.%Y", "%Y%m%d", "%d %b %Y")
    )
    return (
        f"CASE WHEN regexp_matches({t}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') "
        f"THEN CAST(try_cast({t} AS TIMESTAMP) AS DATE) "
        f"WHEN regexp_matches({t}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') "
        f"THEN CAST(try_strptime({t}, '%d/%m/%Y') AS DATE) "
        f"ELSE CAST(coalesce({tries}) AS DATE) END"
    )


def sql_parse_load_date(c: str) -> str:
    h = f"left(trim({c}), 10)"
    tries = ", ".join(f"try_strptime({h}, '{p}')" for p in ("%Y-%m-%d", "%d/%m/%Y", "%d-%m-%Y"))
    return f"CAST(coalesce({tries}) AS DATE)"


def sql_decimal_comma(c: str) -> str:
    n = f"trim(replace({c}, ',', '.'))"
    value = f"try_cast({n} AS DOUBLE)"
    return (
        f"CASE WHEN regexp_matches({n}, '{NUMBER}') AND NOT isinf({value}) THEN {value} END"
    )


def sql_category_code(c: str) -> str:
    t = f"trim({c})"
    whole = f"try_cast(trunc(try_cast({t} AS DOUBLE)) AS BIGINT)"
    return (
        f"CASE WHEN {t} = '' THEN NULL WHEN regexp_matches({t}, '{NUMBER}') "
        f"THEN coalesce(CAST({whole} AS VARCHAR), {t}) ELSE {t} END"
    )


def sql_reason(key_text: str) -> str:
    """Why a key text is rejected, NULL when it is usable."""
    d = f"regexp_replace({key_text}, '[^0-9]', '', 'g')"
    return (
        f"CASE WHEN length({d}) = 11 THEN NULL WHEN {d} = '' THEN 'cpf_ausente' "
        f"ELSE 'cpf_quantidade_digitos_invalida' END"
    )


def _text(*names: str) -> str:
    return ", ".join(f"nullif({n}, '') AS {n}" for n in names)


def _renamed(**names: str) -> str:
    return ", ".join(f"nullif(\"{raw}\", '') AS {name}" for name, raw in names.items())


# Each source with typed canonical columns, the key text as scanned, and the row order.
RH_TYPED = f"""
  SELECT {sql_normalize_key(sql_key_text('cpf'))} AS cpf, {sql_key_text('cpf')} AS raw_key,
    {_text('nome', 'sigla_orgao', 'matricula', 'cargo', 'tipo_vinculo', 'lotacao', 'status_servidor')},
    {sql_parse_date('data_nascimento')} AS data_nascimento,
    {sql_parse_date('data_admissao')} AS data_admissao,
    {sql_parse_date('data_saida')} AS data_saida,
    {sql_decimal_comma('salario_base')} AS salario_base, _order
  FROM (SELECT {RH_SELECT} FROM customer)"""

ESOCIAL_TYPED = f"""
  SELECT {sql_normalize_key(sql_key_text('cpf'))} AS cpf, {sql_key_text('cpf')} AS raw_key,
    {_text('nome', 'sigla_orgao', 'id_evento', 'tipo_evento', 'indicador_retificacao', 'numero_recibo')},
    {sql_parse_date('data_nascimento')} AS data_nascimento,
    {sql_parse_date('data_evento')} AS data_evento,
    {sql_category_code('codigo_categoria')} AS codigo_categoria, _order
  FROM (SELECT {ESOCIAL_SELECT} FROM orders)"""

GESTAO_TYPED = f"""
  SELECT {sql_normalize_key(sql_key_text('cpf'))} AS cpf, {sql_key_text('cpf')} AS raw_key,
    {_text('nome', 'matricula', 'cargo', 'sexo', 'cor', 'nacionalidade', 'email', 'telefone')},
    {_renamed(sigla_orgao='orgao', tipo_vinculo='tipoVinculo', lotacao='unidadeLotacao',
              status_servidor='status', estado_civil='estadoCivil', ciclo_avaliacao='cicloAvaliacao')},
    {sql_parse_date('"dataNascimento"')} AS data_nascimento,
    {sql_parse_date('"dataEntrada"')} AS data_admissao,
    {sql_parse_date('"dataSaida"')} AS data_saida,
    {sql_decimal_comma('salario')} AS salario_base,
    {sql_decimal_comma('"avaliacaoDesempenho"')} AS avaliacao_desempenho, _order
  FROM (SELECT {GESTAO_SELECT} FROM part)"""


def _ranked(source: str, order: str) -> str:
    """Typed rows with reject reason and place among the usable rows of their key."""
    return f"""{source}_ranked AS (
      SELECT *, {sql_reason('raw_key')} AS reason,
        row_number() OVER (PARTITION BY cpf ORDER BY {order}) AS place FROM {source}_typed)"""


# CTEs from the test tables to one row per key and source.
SOURCE_CTES = f"""
  rh_typed AS ({RH_TYPED}), esocial_typed AS ({ESOCIAL_TYPED}), gestao_typed AS ({GESTAO_TYPED}),
  {_ranked('rh', '_order')},
  {_ranked('esocial', 'data_evento DESC NULLS LAST, _order')},
  {_ranked('gestao', '_order')},
  rh_kept AS (SELECT * FROM rh_ranked WHERE reason IS NULL AND place = 1),
  esocial_kept AS (SELECT * FROM esocial_ranked WHERE reason IS NULL AND place = 1),
  gestao_kept AS (SELECT * FROM gestao_ranked WHERE reason IS NULL AND place = 1)"""

_COLUMNS = {
    "r": "nome data_nascimento sigla_orgao data_admissao data_saida matricula cargo tipo_vinculo "
    "salario_base lotacao status_servidor",
    "e": "nome data_nascimento sigla_orgao id_evento tipo_evento data_evento codigo_categoria "
    "indicador_retificacao numero_recibo",
    "g": "nome data_nascimento sigla_orgao data_admissao data_saida matricula cargo tipo_vinculo "
    "salario_base lotacao status_servidor sexo estado_civil cor nacionalidade email telefone "
    "avaliacao_desempenho ciclo_avaliacao",
}


def _merged_cells() -> str:
    names = dict.fromkeys(n for text in _COLUMNS.values() for n in text.split())
    cells = []
    for name in names:
        sides = [f"{s}.{name}" for s, text in _COLUMNS.items() if name in text.split()]
        cells.append(f"coalesce({', '.join(sides)}) AS {name}" if len(sides) > 1 else sides[0])
    return ", ".join(cells)


CONSOLIDATED_CTES = f"""{SOURCE_CTES},
  consolidated AS (
    SELECT coalesce(r.cpf, e.cpf, g.cpf) AS cpf, {_merged_cells()}
    FROM rh_kept r FULL OUTER JOIN esocial_kept e ON r.cpf = e.cpf
    FULL OUTER JOIN gestao_kept g ON coalesce(r.cpf, e.cpf) = g.cpf)"""

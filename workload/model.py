"""Samples, numbering, lookups, write semantics, audits and the relational model."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordweave.operators.integrity import MaxLength, NotNull, Reference, Unique, audit
from recordweave.operators.lookup import (
    SKIP_REASON,
    VIOLATION,
    Catalog,
    attach_ids,
    check_domains,
    resolve_events,
)
from recordweave.operators.numbering import assign_ids, number_rows
from recordweave.operators.sampling import (
    head_n,
    proportional_quotas,
    restrict_to_keys,
    stratified_sample,
)
from recordweave.operators.writes import (
    cascade_delete,
    full_refresh,
    insert_if_absent,
    replace_by_key,
    upsert_latest,
)
from recordweave.plans.key_filter import KeyFilter
from recordweave.plans.profiles import ProfileStore, ReferenceCounts
from recordweave.plans.relational import event_rows, fixed_catalog, load_model, new_codes
from recordweave.sources.tables import empty_table
from recordweave.storage import child_names, delete_folder, materialize, new_folder
from workload.cleaning import consolidated
from workload.registry import query, table
from workload.sqltext import CONSOLIDATED_CTES, sql_parse_load_date
from workload.standins import derive, padded

# --- samples ---------------------------------------------------------------------------

ROW_LIMIT = 500


@query("head_n", f"SELECT * FROM customer ORDER BY c_custkey LIMIT {ROW_LIMIT}")
def head_n_query(spark, sf_dir):
    return head_n(table(spark, sf_dir, "customer"), ["c_custkey"], ROW_LIMIT)


@query(
    "sample_semi",
    f"""SELECT * FROM orders WHERE o_custkey IN
      (SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT {ROW_LIMIT})""",
)
def sample_semi(spark, sf_dir):
    people = head_n_query(spark, sf_dir).select(F.col("c_custkey").alias("o_custkey"))
    return restrict_to_keys(table(spark, sf_dir, "orders"), people, "o_custkey")


SAMPLE_ROWS = 1000

_QUOTA_CTES = f"""
  counts AS (SELECT o_orderpriority, count(*) AS rows FROM orders GROUP BY 1),
  shares AS (SELECT *, rows * {SAMPLE_ROWS} AS scaled, (SELECT count(*) FROM orders) AS total FROM counts),
  floors AS (SELECT o_orderpriority, rows, scaled // total AS fl,
    row_number() OVER (ORDER BY scaled % total DESC, o_orderpriority) AS place FROM shares),
  quotas AS (SELECT o_orderpriority, rows, CAST(fl + CASE WHEN place <= {SAMPLE_ROWS} -
    (SELECT sum(fl) FROM floors) THEN 1 ELSE 0 END AS BIGINT) AS quota FROM floors)"""


@query("stratified_quota", f"WITH {_QUOTA_CTES} SELECT * FROM quotas WHERE quota > 0")
def stratified_quota(spark, sf_dir):
    return proportional_quotas(table(spark, sf_dir, "orders"), "o_orderpriority", SAMPLE_ROWS)


@query(
    "stratified_sample",
    f"""WITH {_QUOTA_CTES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority
      ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS place FROM orders)
    SELECT o.* EXCLUDE (place) FROM ranked o JOIN quotas q
      ON o.o_orderpriority = q.o_orderpriority AND o.place <= q.quota""",
)
def stratified_sample_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return stratified_sample(orders, "o_orderpriority", "o_orderkey", SAMPLE_ROWS)


# --- catalogs and numbering ------------------------------------------------------------

_CODE = "p_type || ' ' || p_brand"


@query(
    "catalog_build",
    f"""WITH old AS (SELECT codigo, row_number() OVER (ORDER BY codigo) AS id
        FROM (SELECT DISTINCT {_CODE} AS codigo FROM part WHERE p_retailprice < 905))
    SELECT id, codigo FROM old UNION ALL
    SELECT (SELECT count(*) FROM old) + row_number() OVER (ORDER BY codigo) AS id, codigo
    FROM (SELECT DISTINCT {_CODE} AS codigo FROM part
          WHERE {_CODE} NOT IN (SELECT codigo FROM old))""",
)
def catalog_build(spark, sf_dir):
    parts = derive(spark, sf_dir, "part", f"{_CODE} AS codigo, p_retailprice")
    empty = empty_table(spark, "id long, codigo string")
    first = new_codes(parts.filter("p_retailprice < 905"), "codigo", empty, "codigo")
    old = materialize(assign_ids(first, empty, ["codigo"]).select("id", "codigo"), "catalog")
    added = assign_ids(new_codes(parts, "codigo", old, "codigo"), old, ["codigo"])
    return old.unionByName(added)


@query(
    "surrogate_keys",
    """SELECT (SELECT max(c_custkey) FROM customer) +
        row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id, o_orderkey, o_custkey
    FROM orders""",
)
def surrogate_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey", "o_custkey")
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return assign_ids(orders, people, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


# --- lookups ---------------------------------------------------------------------------


def _catalog(df: DataFrame, column: str) -> DataFrame:
    codes = df.select(F.col(column).alias("codigo")).distinct()
    return materialize(number_rows(codes, ["codigo"]), "catalog")


def _catalog_sql(column: str, where: str = "") -> str:
    return (
        f"(SELECT codigo, row_number() OVER (ORDER BY codigo) AS id "
        f"FROM (SELECT DISTINCT {column} AS codigo FROM part {where}))"
    )


@query(
    "dimension_lookup",
    f"""SELECT p.p_partkey, p.p_brand, p.p_type, b.id AS brand_id, t.id AS type_id
    FROM part p LEFT JOIN {_catalog_sql('p_brand', "WHERE p_brand <> 'Brand#7'")} b
      ON p.p_brand = b.codigo LEFT JOIN {_catalog_sql('p_type')} t ON p.p_type = t.codigo""",
)
def dimension_lookup(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    brands = _catalog(parts.filter("p_brand <> 'Brand#7'"), "p_brand")
    return attach_ids(
        parts,
        [
            Catalog(brands, "codigo", "p_brand", "brand_id"),
            Catalog(_catalog(parts, "p_type"), "codigo", "p_type", "type_id"),
        ],
    )


_BRANDS = "SELECT DISTINCT p_brand FROM part WHERE p_brand <> 'Brand#7'"
_TYPES = "SELECT DISTINCT p_type FROM part WHERE p_type <> 'PROMO'"


@query(
    "domain_violations",
    f"""SELECT p_partkey, p_brand, p_type,
      CASE WHEN p_brand NOT IN ({_BRANDS}) THEN 'p_brand' ELSE 'p_type' END AS violacao
    FROM part WHERE p_brand NOT IN ({_BRANDS}) OR p_type NOT IN ({_TYPES})""",
)
def domain_violations(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    brands = _catalog(parts.filter("p_brand <> 'Brand#7'"), "p_brand")
    types = _catalog(parts.filter("p_type <> 'PROMO'"), "p_type")
    checked = check_domains(
        parts,
        [
            Catalog(brands, "codigo", "p_brand", "brand_id"),
            Catalog(types, "codigo", "p_type", "type_id"),
        ],
    )
    return checked.violations.select("p_partkey", "p_brand", "p_type", VIOLATION)


# --- events ----------------------------------------------------------------------------

# Persons are the suppliers, so that events of higher user ids belong to nobody.
_PEOPLE = f"s_suppkey + 1 AS id, {padded('s_suppkey')} AS cpf"
_EVENT = f"""
  CASE hour(ts) WHEN 0 THEN 'abc' ELSE {padded('user_id')} END AS cpf,
  CASE event_type WHEN 'view' THEN 'admissao' WHEN 'click' THEN 'afastamento'
    WHEN 'purchase' THEN 'desligamento' WHEN 'signup' THEN 'admissao' ELSE 'outro' END AS tipo_evento,
  CASE hour(ts) WHEN 1 THEN '' WHEN 2 THEN NULL
    ELSE CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) END AS id_evento,
  CASE hour(ts) WHEN 3 THEN '' WHEN 4 THEN '2024.01.31' WHEN 5 THEN '31/01/2024'
    ELSE CAST(CAST(ts AS DATE) AS STRING) || ' 00:00' END AS data_evento,
  event_type AS codigo_categoria,
  props AS indicador_retificacao,
  CAST(event_id AS STRING) AS numero_recibo,
  event_id"""
_EVENT_CTES = f"""
  people AS (SELECT {_PEOPLE} FROM supplier),
  types AS (SELECT * FROM (VALUES (1, 'admissao'), (2, 'afastamento'), (3, 'desligamento')) v(id, codigo)),
  given AS (SELECT {_EVENT} FROM events),
  resolved AS (SELECT g.*, p.id AS pessoa_id, CAST(t.id AS BIGINT) AS tipo_evento_id,
      {sql_parse_load_date('g.data_evento')} AS parsed,
      CASE WHEN length(regexp_replace(g.cpf, '[^0-9]', '', 'g')) <> 11 THEN 'chave_invalida'
        WHEN p.id IS NULL THEN 'pessoa_desconhecida'
        WHEN t.id IS NULL THEN 'tipo_evento_desconhecido'
        WHEN coalesce(g.id_evento, '') = '' THEN 'id_evento_ausente'
        WHEN g.data_evento = '' THEN 'data_evento_ausente'
        WHEN {sql_parse_load_date('g.data_evento')} IS NULL THEN 'data_evento_invalida'
      END AS motivo_descarte
    FROM given g LEFT JOIN people p ON g.cpf = p.cpf LEFT JOIN types t ON g.tipo_evento = t.codigo)"""
_LOADED = f"""SELECT pessoa_id, left(id_evento, 128) AS id_evento_origem, tipo_evento_id,
  parsed AS data_evento, left(codigo_categoria, 32) AS codigo_categoria,
  left(indicador_retificacao, 32) AS indicador_retificacao, left(numero_recibo, 128) AS numero_recibo,
  row_number() OVER (PARTITION BY id_evento ORDER BY event_id) AS place, event_id
  FROM resolved WHERE motivo_descarte IS NULL"""


def _resolved(spark, sf_dir) -> DataFrame:
    events = derive(spark, sf_dir, "events", _EVENT)
    people = derive(spark, sf_dir, "supplier", _PEOPLE)
    ordered = events.withColumn("_event_order", F.col("event_id"))
    return resolve_events(ordered, people, fixed_catalog(spark, "tipo_evento"))


_EVENT_LOAD = f"""WITH {_EVENT_CTES}, loadable AS ({_LOADED}),
      old AS (SELECT * FROM loadable WHERE data_evento < DATE '2024-01-11' AND place = 1)
    SELECT * EXCLUDE (place, event_id) FROM old UNION ALL
    SELECT * EXCLUDE (place, event_id) FROM loadable WHERE place = 1
      AND id_evento_origem NOT IN (SELECT id_evento_origem FROM old)"""


@query("event_load", _EVENT_LOAD)
def event_load(spark, sf_dir):
    loadable = materialize(event_rows(_resolved(spark, sf_dir)), "events")
    key, order = ["id_evento_origem"], ["_event_order"]
    old = full_refresh(loadable, key, order).filter("data_evento < date '2024-01-11'")
    old = materialize(old, "old_events")
    return insert_if_absent(old, loadable, key, order).drop("_event_order")


@query("event_load_filtered", _EVENT_LOAD)
def event_load_filtered(spark, sf_dir):
    """The same load by a filter of the ids that are there, which two batches had been added to."""
    loadable = materialize(event_rows(_resolved(spark, sf_dir)), "events")
    key, order = ["id_evento_origem"], ["_event_order"]
    old = full_refresh(loadable, key, order).filter("data_evento < date '2024-01-11'")
    old = materialize(old, "old_events")
    held = KeyFilter(spark, new_folder(spark, "event-filter"), tuple(key))
    for batch in ("data_evento < date '2024-01-06'", "data_evento >= date '2024-01-06'"):
        held.add(old.filter(batch), old)
    return old.unionByName(held.absent_rows(old, loadable, order)).drop("_event_order")


@query(
    "event_rejects",
    f"""WITH {_EVENT_CTES} SELECT event_id, cpf, tipo_evento, id_evento, data_evento, motivo_descarte
    FROM resolved WHERE motivo_descarte IS NOT NULL""",
)
def event_rejects(spark, sf_dir):
    resolved = _resolved(spark, sf_dir).filter(F.col(SKIP_REASON).isNotNull())
    return resolved.select(
        "event_id", "cpf", "tipo_evento", "id_evento", "data_evento", SKIP_REASON
    )


# --- write semantics: one order per customer, orders before and after a day ------------

_DAY = "1998-01-01"
_ORDER = ["o_orderdate", "o_orderkey"]
_BEFORE, _AFTER = f"o_orderdate < TIMESTAMP '{_DAY}'", f"o_orderdate >= TIMESTAMP '{_DAY}'"


def _first_sql(where: str, keys: str = "o_custkey", direction: str = "ASC") -> str:
    return f"""SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY {keys}
      ORDER BY o_orderdate {direction}, o_orderkey {direction}) AS place
      FROM orders WHERE {where}) WHERE place = 1"""


def _old_and_new(spark, sf_dir, keys=("o_custkey",)) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    return full_refresh(orders.filter(_BEFORE), keys, _ORDER), orders.filter(_AFTER)


@query("full_refresh", _first_sql("true"))
def full_refresh_query(spark, sf_dir):
    return full_refresh(table(spark, sf_dir, "orders"), ["o_custkey"], _ORDER)


@query(
    "insert_if_absent",
    f"""WITH old AS ({_first_sql(_BEFORE)}), new AS ({_first_sql(_AFTER)})
    SELECT * FROM old UNION ALL
    SELECT * FROM new WHERE o_custkey NOT IN (SELECT o_custkey FROM old)""",
)
def insert_if_absent_query(spark, sf_dir):
    old, new = _old_and_new(spark, sf_dir)
    return insert_if_absent(old, new, ["o_custkey"], _ORDER)


@query(
    "replace_by_key",
    f"""WITH old AS ({_first_sql(_BEFORE)}), new AS ({_first_sql(_AFTER, direction='DESC')})
    SELECT * FROM new UNION ALL
    SELECT * FROM old WHERE o_custkey NOT IN (SELECT o_custkey FROM new)""",
)
def replace_by_key_query(spark, sf_dir):
    old, new = _old_and_new(spark, sf_dir)
    return replace_by_key(old, new, ["o_custkey"], _ORDER)


_PAIR = "o_custkey, o_orderpriority"
_NOTE = "CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END AS note"


@query(
    "upsert_latest",
    f"""WITH old AS ({_first_sql(_BEFORE, _PAIR)}), new AS ({_first_sql(_AFTER, _PAIR, 'DESC')})
    SELECT o_custkey, o_orderpriority, CASE WHEN o.found THEN o.note ELSE n.note END AS note,
      CASE WHEN n.found THEN n.o_totalprice ELSE o.o_totalprice END AS o_totalprice
    FROM (SELECT *, {_NOTE}, true AS found FROM old) o
    FULL OUTER JOIN (SELECT *, {_NOTE}, true AS found FROM new) n USING (o_custkey, o_orderpriority)""",
)
def upsert_latest_query(spark, sf_dir):
    """Prices are updated; the note of a row that exists is kept, also where it is NULL."""
    key = ["o_custkey", "o_orderpriority"]
    old, new = (df.selectExpr("*", _NOTE) for df in _old_and_new(spark, sf_dir, key))
    columns = [*key, "note", "o_totalprice"]
    return upsert_latest(old.select(*columns), new.select(*columns, *_ORDER), key, ["o_totalprice"], _ORDER)


@query(
    "cascade_delete",
    """SELECT * FROM orders WHERE o_custkey NOT IN
      (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def cascade_delete_query(spark, sf_dir):
    removed = table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    return cascade_delete(table(spark, sf_dir, "orders"), removed, "o_custkey", "c_custkey")


# --- a report kept over loads ------------------------------------------------------------

_KEPT = {"customer": ("c_custkey", "c_acctbal < 0"), "orders": ("o_custkey", _BEFORE), "events": ("user_id", "event_type = 'view'")}


def _kept_sql() -> str:
    rows = " UNION ALL ".join(f"SELECT '{n}' AS s, CAST({k} AS VARCHAR) AS k FROM {n}" for n, (k, _) in _KEPT.items())
    counts = ", ".join(f"count(*) FILTER (WHERE s = '{n}') AS n_{n}" for n in _KEPT)
    parts = []
    for i, name in enumerate(_KEPT):
        n = f"n_{name}"
        distinct = f"count(*) FILTER (WHERE k IS NOT NULL AND {n} > 0)"
        metrics = {
            "rows": f"sum({n})", "distinct_keys": distinct, "repeated_key_rows": f"coalesce(sum({n}) FILTER (WHERE {n} > 1), 0)",
            "excess_rows": f"sum({n}) - {distinct}", "later_repeats": f"sum({n}) - count(*) FILTER (WHERE {n} > 0)",
        }
        parts += [(100 * (i + 1) + j, name, m, e) for j, (m, e) in enumerate(metrics.items())]
    alone = {
        f"only_{name}": " AND ".join(["k IS NOT NULL", f"n_{name} > 0", *[f"n_{o} = 0" for o in _KEPT if o != name]]) for name in _KEPT
    }
    shown = {"any_source": "k IS NOT NULL", **alone}
    parts += [(100 * (len(_KEPT) + 1) + j, "coverage", m, f"count(*) FILTER (WHERE {e})") for j, (m, e) in enumerate(shown.items())]
    selects = [f"SELECT {p} AS position, '{s}' AS section, '{m}' AS metric, CAST({e} AS BIGINT) AS value FROM counts" for p, s, m, e in parts]
    return f"WITH counts AS (SELECT k, {counts} FROM ({rows}) GROUP BY k) " + " UNION ALL ".join(selects)


@query("profile_kept", _kept_sql())
def profile_kept(spark, sf_dir):
    """A report over three sources that came in two batches, the second of which was added again."""
    store = ProfileStore(spark, new_folder(spark, "profile"), list(_KEPT))
    given = {name: table(spark, sf_dir, name).withColumn("k", F.col(key)) for name, (key, _) in _KEPT.items()}
    first = {name: df.filter(_KEPT[name][1]) for name, df in given.items()}
    rest = {name: df.filter(f"NOT coalesce({_KEPT[name][1]}, false)") for name, df in given.items()}
    store.add(1, first, "k")
    for _ in range(2):
        store.add(2, rest, "k")
    return store.report()


_GONE = "c_acctbal < 0"
_DROPPED = "o_totalprice < 20000"
_REFERENCES = {"orders": f"(SELECT o_custkey AS k FROM orders WHERE NOT ({_DROPPED}))", "events": "(SELECT user_id AS k FROM events)"}


@query(
    "reference_counts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", 'referring' AS finding, count(*) AS rows FROM {rows} "
        f"WHERE k IN (SELECT c_custkey FROM customer WHERE {_GONE}) UNION ALL "
        f"SELECT '{name}', 'orphans', count(*) FROM {rows} WHERE k NOT IN (SELECT c_custkey FROM customer WHERE NOT ({_GONE}))"
        for name, rows in _REFERENCES.items()
    ),
)
def reference_counts(spark, sf_dir):
    """Children come in two batches and some go with a third; then parents are deleted."""
    orders, events, parents = (table(spark, sf_dir, n) for n in ("orders", "events", "customer"))
    store = ReferenceCounts(spark, new_folder(spark, "references"), list(_REFERENCES))
    store.change(1, {"orders": (orders.filter(_BEFORE), "o_custkey")})
    store.change(2, {"orders": (orders.filter(_AFTER), "o_custkey"), "events": (events, "user_id")})
    store.change(3, {}, {"orders": (orders.filter(_DROPPED), "o_custkey")})
    referring = store.referring(parents.filter(_GONE), "c_custkey").withColumn("finding", F.lit("referring"))
    orphans = store.orphans(parents.filter(f"NOT ({_GONE})"), "c_custkey").withColumn("finding", F.lit("orphans"))
    return referring.unionByName(orphans).select("table", "finding", "rows")


# --- integrity -------------------------------------------------------------------------

_RULES = (
    Unique("customer", ("c_custkey",)),
    Unique("lineitem", ("l_orderkey", "l_linenumber")),
    NotNull("orders", ("o_orderkey", "o_custkey", "o_orderdate")),
    Reference("orders", "o_custkey", "customer", "c_custkey"),
    Reference("lineitem", "l_orderkey", "orders", "o_orderkey"),
    Reference("events", "user_id", "supplier", "s_suppkey"),
    MaxLength("documents", {"text": 4000, "lang": 2}),
)


def _finding_sql(name: str, rule: str, count: str) -> str:
    return (
        f"SELECT '{name}' AS \"table\", '{rule}' AS rule, "
        f"CAST(coalesce(({count}), 0) AS BIGINT) AS violations"
    )


def _orphans(child: str, column: str, parent: str, key: str) -> str:
    return f"SELECT count(*) FROM {child} WHERE {column} NOT IN (SELECT {key} FROM {parent})"


def _extra(name: str, keys: str) -> str:
    return f"SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM {name} GROUP BY {keys})"


@query(
    "integrity_audit",
    " UNION ALL ".join(
        [
            _finding_sql("customer", "unique(c_custkey)", _extra("customer", "c_custkey")),
            _finding_sql(
                "lineitem", "unique(l_orderkey,l_linenumber)", _extra("lineitem", "l_orderkey, l_linenumber")
            ),
            *[
                _finding_sql("orders", f"not_null({c})", f"SELECT count(*) FROM orders WHERE {c} IS NULL")
                for c in ("o_orderkey", "o_custkey", "o_orderdate")
            ],
            _finding_sql("orders", "o_custkey->customer", _orphans("orders", "o_custkey", "customer", "c_custkey")),
            _finding_sql("lineitem", "l_orderkey->orders", _orphans("lineitem", "l_orderkey", "orders", "o_orderkey")),
            _finding_sql("events", "user_id->supplier", _orphans("events", "user_id", "supplier", "s_suppkey")),
            _finding_sql("documents", "length(text)<=4000", "SELECT count(*) FROM documents WHERE length(text) > 4000"),
            _finding_sql("documents", "length(lang)<=2", "SELECT count(*) FROM documents WHERE length(lang) > 2"),
        ]
    ),
)
def integrity_audit(spark, sf_dir):
    names = {rule.table for rule in _RULES} | {"supplier"}
    return audit(_RULES, {name: table(spark, sf_dir, name) for name in names})


# --- the relational model --------------------------------------------------------------

_LOADABLE = f"""{CONSOLIDATED_CTES},
  loadable AS (SELECT * FROM consolidated WHERE sigla_orgao IS NOT NULL AND cargo IS NOT NULL
    AND tipo_vinculo IS NOT NULL AND status_servidor IS NOT NULL),
  pessoa AS (SELECT row_number() OVER (ORDER BY cpf) AS id, * FROM loadable),
  orgao AS (SELECT sigla, row_number() OVER (ORDER BY sigla) AS id
    FROM (SELECT DISTINCT sigla_orgao AS sigla FROM consolidated WHERE sigla_orgao IS NOT NULL)),
  cargos AS (SELECT nome, row_number() OVER (ORDER BY nome) AS id
    FROM (SELECT DISTINCT cargo AS nome FROM consolidated WHERE cargo IS NOT NULL))"""


def _loaded(spark, sf_dir):
    run = consolidated(spark, sf_dir)
    return load_model(
        spark,
        run.consolidated,
        run.accepted["esocial"],
        new_folder(spark, "model"),
        on_violation="quarantine",
    )


@query(
    "relational_model",
    f"""WITH {_LOADABLE}
    SELECT p.id AS pessoa_id, p.cpf, coalesce(p.nome, 'NOME NÃO INFORMADO') AS nome,
      p.data_nascimento, p.sexo, p.cor AS cor_raca, p.id AS vinculo_id, o.id AS orgao_id,
      c.id AS cargo_id, p.tipo_vinculo, p.status_servidor, p.matricula,
      CAST(p.salario_base AS DECIMAL(14,2)) AS salario_base, p.lotacao, p.data_admissao,
      p.data_saida, CASE WHEN p.avaliacao_desempenho IS NOT NULL THEN p.ciclo_avaliacao END
        AS ciclo_avaliacao,
      CASE WHEN p.ciclo_avaliacao IS NOT NULL
        THEN CAST(p.avaliacao_desempenho AS DECIMAL(4,1)) END AS nota
    FROM pessoa p JOIN orgao o ON p.sigla_orgao = o.sigla JOIN cargos c ON p.cargo = c.nome""",
)
def relational_model(spark, sf_dir):
    t = _loaded(spark, sf_dir).tables
    person = t["pessoa"].select(
        F.col("id").alias("pessoa_id"), "cpf", "nome", "data_nascimento", "sexo", "cor_raca"
    )
    job = t["vinculo"].withColumnRenamed("id", "vinculo_id")
    for name in ("tipo_vinculo", "status_servidor"):
        codes = t[name].select(F.col("id").alias(f"{name}_id"), F.col("codigo").alias(name))
        job = job.join(F.broadcast(codes), f"{name}_id").drop(f"{name}_id")
    scores = t["avaliacao_desempenho"].drop("id")
    return person.join(job, "pessoa_id").join(scores, "pessoa_id", "left")


@query(
    "resume_load",
    f"""WITH {_LOADABLE}
    SELECT p.id, p.cpf, coalesce(p.nome, 'NOME NÃO INFORMADO') AS nome, o.id AS orgao_id,
      CAST(p.salario_base AS DECIMAL(14,2)) AS salario_base
    FROM pessoa p JOIN orgao o ON p.sigla_orgao = o.sigla""",
)
def resume_load(spark, sf_dir):
    """A load that was cut while it wrote three tables, each in some of its buckets, and goes on from there."""
    t = _cut_and_resumed(spark, sf_dir).tables
    jobs = t["vinculo"].select(F.col("pessoa_id").alias("id"), "orgao_id", "salario_base")
    return t["pessoa"].select("id", "cpf", "nome").join(jobs, "id")


_CUT = {"pessoa": range(0, 16, 2), "vinculo": range(5), "evento": range(15, 16)}


def _cut_and_resumed(spark, sf_dir):
    run = consolidated(spark, sf_dir)
    target = new_folder(spark, "model")
    given = (spark, run.consolidated, run.accepted["esocial"], target)
    load_model(*given, on_violation="quarantine", buckets=16)
    delete_folder(spark, f"{target}/current")
    for name, lost in _CUT.items():
        delete_folder(spark, f"{target}/v1/markers/{name}")
        (log,) = child_names(spark, f"{target}/v1/commits/{name}")
        for bucket in lost:
            delete_folder(spark, f"{target}/v1/commits/{name}/{log}/{bucket}")
            delete_folder(spark, f"{target}/v1/stages/{name}/_bucket={bucket}")
    return load_model(*given, on_violation="quarantine", buckets=16, resume=True, batches=3)


@query(
    "resume_buckets",
    f"""WITH {_LOADABLE}, eventos AS (
      SELECT e.id_evento FROM esocial_kept e JOIN pessoa p ON e.cpf = p.cpf WHERE e.data_evento IS NOT NULL)
    SELECT 'pessoa' AS entity, count(*) AS rows, CAST(8 AS BIGINT) AS buckets_reused FROM pessoa
    UNION ALL SELECT 'vinculo', count(*), 11 FROM pessoa
    UNION ALL SELECT 'evento', count(*), 15 FROM eventos""",
)
def resume_buckets(spark, sf_dir):
    """What the resumed load found of the three tables that had been cut."""
    load = _cut_and_resumed(spark, sf_dir)
    counts = [
        load.tables[name].agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("entity"), "rows", F.lit(load.counts[name]["buckets_reused"]).cast("bigint").alias("buckets_reused")
        )
        for name in _CUT
    ]
    return reduce(DataFrame.union, counts)


# The first load has half of the persons; the second all of them, with other names, salaries, scores and receipts.
_HALF = "right(cpf, 1) < '5'"


@query(
    "incremental_values",
    f"""WITH {_LOADABLE}, eventos AS (SELECT cpf, numero_recibo FROM esocial_kept WHERE data_evento IS NOT NULL)
    SELECT p.cpf, coalesce(CASE WHEN {_HALF.replace('cpf', 'p.cpf')} THEN p.nome ELSE p.nome || ' X' END, 'NOME NÃO INFORMADO') AS nome,
      CAST(p.salario_base + 1 AS DECIMAL(14,2)) AS salario_base,
      CASE WHEN p.avaliacao_desempenho IS NOT NULL AND p.ciclo_avaliacao IS NOT NULL
        THEN CAST(1.5 AS DECIMAL(4,1)) END AS nota,
      CASE WHEN {_HALF.replace('cpf', 'p.cpf')} THEN e.numero_recibo ELSE e.numero_recibo || '-2' END AS numero_recibo
    FROM pessoa p LEFT JOIN eventos e ON p.cpf = e.cpf""",
)
def incremental_values(spark, sf_dir):
    """Persons and events keep what came first; employments and scores have what came last."""
    run = consolidated(spark, sf_dir)
    target = new_folder(spark, "model")
    people, events = run.consolidated, run.accepted["esocial"]
    load_model(spark, people.filter(_HALF), events, target, on_violation="quarantine")
    changed = people.withColumns({
        "nome": F.concat("nome", F.lit(" X")),
        "salario_base": F.col("salario_base") + 1,
        "avaliacao_desempenho": F.when(F.col("avaliacao_desempenho").isNotNull(), 1.5),
    })
    receipts = events.withColumn("numero_recibo", F.concat("numero_recibo", F.lit("-2")))
    t = load_model(spark, changed, receipts, target, incremental=True, on_violation="quarantine").tables
    person = t["pessoa"].select(F.col("id").alias("pessoa_id"), "cpf", "nome")
    return (
        person.join(t["vinculo"].select("pessoa_id", "salario_base"), "pessoa_id")
        .join(t["avaliacao_desempenho"].select("pessoa_id", "nota"), "pessoa_id", "left")
        .join(t["evento"].select("pessoa_id", "numero_recibo"), "pessoa_id", "left")
        .drop("pessoa_id")
    )


# Values the target can't hold: a salary and a score that are too large, a cycle and an event id that are too long.
_REJECT_ROWS = f"""{padded('c_custkey')} AS cpf, c_name AS nome, c_mktsegment AS cargo, 'ORG' AS sigla_orgao,
  'efetivo' AS tipo_vinculo, 'ativo' AS status_servidor,
  c_acctbal * CASE WHEN c_nationkey = 3 THEN 1e12 ELSE 1 END AS salario_base,
  CASE WHEN c_nationkey = 4 THEN 1234.5 WHEN c_nationkey = 6 THEN NULL ELSE 4.5 END AS avaliacao_desempenho,
  CASE WHEN c_nationkey IN (5, 6) THEN repeat('2', 17) WHEN c_nationkey = 7 THEN NULL ELSE '2023' END AS ciclo_avaliacao"""
_REJECT_EVENTS = f"""{padded('user_id')} AS cpf, 'admissao' AS tipo_evento,
  CASE WHEN hour(ts) = 0 THEN repeat('x', 128) || CAST(event_id AS STRING) ELSE 'e' || CAST(event_id AS STRING) END AS id_evento,
  CAST(CAST(ts AS DATE) AS STRING) AS data_evento, event_type AS codigo_categoria, 'original' AS indicador_retificacao,
  CAST(event_id AS STRING) AS numero_recibo"""


@query(
    "load_rejects",
    f"""WITH given AS (SELECT {_REJECT_ROWS} FROM customer), marked AS (
      SELECT *, CASE WHEN abs(salario_base) >= 999999999999.995 THEN 'salario_base'
        WHEN avaliacao_desempenho > 999.9 AND ciclo_avaliacao IS NOT NULL THEN 'avaliacao_desempenho'
        WHEN avaliacao_desempenho IS NOT NULL AND length(ciclo_avaliacao) > 16 THEN 'ciclo_avaliacao' END AS reason
      FROM given), events_given AS (SELECT {_REJECT_EVENTS} FROM events)
    SELECT 'row' AS kind, cpf AS ref, reason FROM marked WHERE reason IS NOT NULL
    UNION ALL
    SELECT 'event', numero_recibo, CASE WHEN p.cpf IS NULL THEN 'pessoa_desconhecida' ELSE 'id_evento_longo' END
    FROM events_given e LEFT JOIN (SELECT cpf FROM marked WHERE reason IS NULL) p ON e.cpf = p.cpf
    WHERE p.cpf IS NULL OR length(id_evento) > 128""",
)
def load_rejects(spark, sf_dir):
    people = derive(spark, sf_dir, "customer", _REJECT_ROWS)
    events = derive(spark, sf_dir, "events", _REJECT_EVENTS)
    load = load_model(
        spark, people, events, new_folder(spark, "model"), on_violation="quarantine", event_order=("numero_recibo",)
    )
    rows = load.violations.select(F.lit("row").alias("kind"), F.col("cpf").alias("ref"), F.col(VIOLATION).alias("reason"))
    skipped = load.skipped_events.select(F.lit("event"), "numero_recibo", SKIP_REASON)
    return rows.union(skipped)


@query(
    "relational_events",
    f"""WITH {_LOADABLE}, eventos AS (
      SELECT e.*, p.id AS pessoa_id FROM esocial_kept e JOIN pessoa p ON e.cpf = p.cpf
      WHERE e.data_evento IS NOT NULL)
    SELECT row_number() OVER (ORDER BY id_evento) AS id, pessoa_id, id_evento AS id_evento_origem,
      CAST(CASE tipo_evento WHEN 'admissao' THEN 1 WHEN 'afastamento' THEN 2 ELSE 3 END AS BIGINT)
        AS tipo_evento_id, data_evento, codigo_categoria, indicador_retificacao, numero_recibo
    FROM eventos""",
)
def relational_events(spark, sf_dir):
    return _loaded(spark, sf_dir).tables["evento"]


_COUNTED = {
    "orgao": "orgao", "cargo": "cargos", "pessoa": "pessoa", "vinculo": "pessoa",
    "avaliacao_desempenho": "(SELECT 1 FROM pessoa WHERE avaliacao_desempenho IS NOT NULL "
    "AND ciclo_avaliacao IS NOT NULL)",
    "violacoes": "(SELECT 1 FROM consolidated WHERE cpf NOT IN (SELECT cpf FROM loadable))",
    "tipo_evento": "(VALUES (1), (2), (3)) v(x)",
}


@query(
    "incremental_load",
    f"WITH {_LOADABLE} "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS entity, (SELECT count(*) FROM {s}) AS after_full, "
        f"(SELECT count(*) FROM {s}) AS after_repeat"
        for n, s in _COUNTED.items()
    ),
)
def incremental_load(spark, sf_dir):
    """Row counts after a full load and after loading the same rows on top of it."""
    run = consolidated(spark, sf_dir)
    target = new_folder(spark, "model")
    frames = []
    for again, column in ((False, "after_full"), (True, "after_repeat")):
        load = load_model(
            spark, run.consolidated, run.accepted["esocial"], target, incremental=again, on_violation="quarantine",
        )
        counts = [
            (load.violations if name == "violacoes" else load.tables[name])
            .agg(F.count(F.lit(1)).alias(column))
            .select(F.lit(name).alias("entity"), column)
            for name in _COUNTED
        ]
        # Counted before the next load rewrites the tables.
        frames.append(materialize(reduce(DataFrame.union, counts), "counts"))
    return frames[0].join(frames[1], "entity")



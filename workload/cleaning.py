"""Quarantine, dedupe, merge and profile queries."""

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordweave.operators.dedupe import KEPT, discarded, keep_one, mark_kept
from recordweave.operators.merge import merge_by_joins, merge_by_priority, union_audit
from recordweave.operators.profile import duplicate_profile, duplicate_report, source_coverage
from recordweave.operators.quarantine import drop_unusable, quarantine, split_rejected
from recordweave.operators.standardise import ORIGINAL_KEY, annotate_duplicates, standardise
from recordweave.operators.numbering import number_rows
from recordweave.plans.consolidate import (
    DISCARDED_ROW,
    KEPT_ROW,
    REJECTED_ROW,
    STATUS,
    SourceInput,
    consolidate,
    export,
    transform,
)
from recordweave.plans.stages import side_by_side
from recordweave.sources.contracts import ESOCIAL, GESTAO, RH, SOURCES, to_canonical
from recordweave.sources.delimited import FILE_ORDER, read_delimited, write_delimited
from recordweave.storage import delete_folder, materialize, new_folder
from workload.registry import query, table
from workload.sqltext import CONSOLIDATED_CTES, SOURCE_CTES
from workload.standins import ESOCIAL_SELECT, GESTAO_SELECT, RH_SELECT, derive, esocial, gestao, padded, rh

ORDER = ["_order"]

# --- quarantine ------------------------------------------------------------------------


def _rh_split(spark, sf_dir):
    typed = standardise(materialize(rh(spark, sf_dir), "raw"), RH, carried=ORDER)
    return quarantine(typed, "rh", reason_on=ORIGINAL_KEY)


@query(
    "quarantine_valid",
    f"WITH {SOURCE_CTES} SELECT _order AS c_custkey, cpf, nome FROM rh_ranked WHERE reason IS NULL",
)
def quarantine_valid(spark, sf_dir):
    valid = _rh_split(spark, sf_dir).valid
    return valid.select(F.col("_order").alias("c_custkey"), "cpf", "nome")


@query(
    "quarantine_rejected",
    f"""WITH {SOURCE_CTES} SELECT _order AS c_custkey, cpf, raw_key AS cpf_original, nome,
      'rh' AS fonte, reason AS motivo_rejeicao FROM rh_ranked WHERE reason IS NOT NULL""",
)
def quarantine_rejected(spark, sf_dir):
    rejected = _rh_split(spark, sf_dir).rejected
    return rejected.select(
        F.col("_order").alias("c_custkey"), "cpf", "cpf_original", "nome", "fonte", "motivo_rejeicao"
    )


def _check_digit_sql(key: str, count: int) -> str:
    total = " + ".join(
        f"CAST(substr({key}, {i + 1}, 1) AS INT) * {count + 1 - i}" for i in range(count)
    )
    return f"CASE WHEN ({total}) % 11 < 2 THEN 0 ELSE 11 - ({total}) % 11 END"


# Nine-digit stems from the customer key; the check digits are right for nations below 12.
_STEM = "lpad(CAST(c_custkey * 7919 AS STRING), 9, '0')"
_WITH_FIRST = f"({_STEM} || CAST({_check_digit_sql(_STEM, 9)} AS STRING))"
_CHECKED_KEY = (
    f"CASE WHEN c_nationkey < 12 THEN {_WITH_FIRST} || "
    f"CAST({_check_digit_sql(_WITH_FIRST, 10)} AS STRING) "
    f"WHEN c_nationkey = 24 THEN '' ELSE {_STEM} || '37' END"
)


@query(
    "drop_unusable",
    f"""WITH {SOURCE_CTES} SELECT count(*) FILTER (WHERE reason IS NULL) AS usable,
      count(*) FILTER (WHERE reason IS NOT NULL) AS dropped FROM rh_ranked""",
)
def drop_unusable_query(spark, sf_dir):
    """Rows without a usable key are dropped, and counted as they pass."""
    typed = standardise(rh(spark, sf_dir), RH, carried=ORDER)
    usable, seen = drop_unusable(typed)
    kept = materialize(usable, "usable")
    return kept.agg(F.count(F.lit(1)).alias("usable")).withColumn("dropped", F.lit(seen.get["dropped"]).cast("bigint"))


# Spellings that keep eleven digits but are no key: the number sign, letters, a group too many.
_INVALID_KEY = f"""CASE c_nationkey WHEN 0 THEN '#' || {padded('c_custkey')} WHEN 1 THEN {padded('c_custkey')} || 'x'
  WHEN 2 THEN '12' WHEN 3 THEN '' WHEN 4 THEN NULL ELSE {padded('c_custkey')} END"""


@query(
    "invalid_keys",
    f"""SELECT c_custkey, cpf, 'customer' AS fonte, motivo_rejeicao FROM (
      SELECT c_custkey, cpf, CASE WHEN regexp_full_match(cpf, '[0-9]{{11}}') THEN NULL
        WHEN coalesce(regexp_replace(cpf, '[^0-9]', '', 'g'), '') = '' THEN 'cpf_ausente'
        WHEN length(regexp_replace(cpf, '[^0-9]', '', 'g')) <> 11 THEN 'cpf_quantidade_digitos_invalida'
        ELSE 'cpf_invalido' END AS motivo_rejeicao
      FROM (SELECT c_custkey, {_INVALID_KEY} AS cpf FROM customer)) WHERE motivo_rejeicao IS NOT NULL""",
)
def invalid_keys(spark, sf_dir):
    keys = derive(spark, sf_dir, "customer", f"c_custkey, {_INVALID_KEY} AS cpf")
    return quarantine(keys, "customer").rejected


@query(
    "check_digit_quarantine",
    f"""SELECT c_custkey, cpf, 'customer' AS fonte, motivo_rejeicao FROM (
      SELECT c_custkey, cpf, CASE WHEN cpf = '' THEN 'cpf_ausente'
        WHEN NOT ({_check_digit_sql('cpf', 9)} = CAST(substr(cpf, 10, 1) AS INT)
          AND {_check_digit_sql('cpf', 10)} = CAST(substr(cpf, 11, 1) AS INT))
        THEN 'cpf_digito_verificador_invalido' END AS motivo_rejeicao
      FROM (SELECT c_custkey, {_CHECKED_KEY} AS cpf FROM customer)) WHERE motivo_rejeicao IS NOT NULL""",
)
def check_digit_quarantine(spark, sf_dir):
    # Written first, as any source is: the derivation is long and the check reads it often.
    keys = materialize(derive(spark, sf_dir, "customer", f"c_custkey, {_CHECKED_KEY} AS cpf"), "keys")
    return quarantine(keys, "customer", check_digits=True).rejected


# --- dedupe ----------------------------------------------------------------------------


def _documents(spark, sf_dir):
    """Documents keyed by a digest of the whole text, so that shuffles do not carry it."""
    return table(spark, sf_dir, "documents").withColumn("_digest", F.sha2("text", 256))


_DOCS_RANKED = (
    "(SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS place FROM documents)"
)


@query("dedupe_first", f"SELECT * EXCLUDE (place) FROM {_DOCS_RANKED} WHERE place = 1")
def dedupe_first(spark, sf_dir):
    return keep_one(_documents(spark, sf_dir), ["_digest"], ["doc_id"]).drop("_digest")


@query("dedupe_first_discarded", f"SELECT * EXCLUDE (place) FROM {_DOCS_RANKED} WHERE place > 1")
def dedupe_first_discarded(spark, sf_dir):
    return discarded(_documents(spark, sf_dir), ["_digest"], ["doc_id"]).drop("_digest")


# Whole days, so that several events of a user tie; errors have no date.
_EVENT_SELECT = (
    "event_id, user_id, event_type, value, "
    "CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS DATE) END AS day"
)
_EVENTS_RANKED = f"""(SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY day DESC NULLS LAST, event_id) AS place FROM (SELECT {_EVENT_SELECT} FROM events))"""


@query("dedupe_latest", f"SELECT * EXCLUDE (place) FROM {_EVENTS_RANKED} WHERE place = 1")
def dedupe_latest(spark, sf_dir):
    events = derive(spark, sf_dir, "events", _EVENT_SELECT)
    return keep_one(events, ["user_id"], ["event_id"], latest_by="day")


@query("dedupe_latest_discarded", f"SELECT * EXCLUDE (place) FROM {_EVENTS_RANKED} WHERE place > 1")
def dedupe_latest_discarded(spark, sf_dir):
    events = derive(spark, sf_dir, "events", _EVENT_SELECT)
    return discarded(events, ["user_id"], ["event_id"], latest_by="day")


# Every third event has no place in its order; the others are unique.
_PLACE_SELECT = "event_id, user_id, CASE WHEN event_id % 3 > 0 THEN event_id END AS place"
_FIRST_NULL = """(SELECT user_id, count(*) AS rows, count_if(place IS NULL) AS unplaced
  FROM (SELECT *, CASE WHEN event_id % 3 > 0 THEN event_id END AS place FROM events) GROUP BY user_id)"""


@query(
    "dedupe_partition_check",
    f"""SELECT CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(greatest(unplaced, 1)) AS BIGINT) AS kept,
      CAST(sum(rows - greatest(unplaced, 1)) AS BIGINT) AS discarded, CAST(0 AS BIGINT) AS in_both,
      count(*) AS survivors, CAST(0 AS BIGINT) AS survivors_not_kept FROM {_FIRST_NULL}""",
)
def dedupe_partition_check(spark, sf_dir):
    """An order column with NULLs splits the same way on all three paths; rows that tie at the front are all kept."""
    events = derive(spark, sf_dir, "events", _PLACE_SELECT)
    marked = materialize(mark_kept(events, ["user_id"], ["place"]), "marked")
    kept = marked.filter(F.col(KEPT))
    dropped = discarded(events, ["user_id"], ["place"])
    survivors = keep_one(events, ["user_id"], ["place"])
    counted = {
        "rows": events, "kept": kept, "discarded": dropped,
        "in_both": kept.join(dropped, "event_id", "left_semi"),
        "survivors": survivors,
        "survivors_not_kept": survivors.join(kept, "event_id", "left_anti"),
    }
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in counted.items()]
    return reduce(DataFrame.union, parts).agg(*[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in counted])


# --- merge -----------------------------------------------------------------------------

_MERGE_SELECTS = {
    "customer": f"""{padded('c_custkey')} AS cpf,
      CASE WHEN c_nationkey < 6 THEN NULL ELSE c_name END AS nome,
      CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS balance,
      CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_nationkey END AS nation,
      c_mktsegment AS segment""",
    "supplier": f"""{padded('s_suppkey')} AS cpf, s_name AS nome, s_acctbal AS balance,
      CASE WHEN s_nationkey < 12 THEN NULL ELSE s_nationkey END AS nation""",
    "part": f"""{padded('p_partkey')} AS cpf, p_name AS nome, p_retailprice AS balance,
      p_size AS nation, p_brand AS brand""",
}
_MERGE_SQL = f"""
  SELECT coalesce(c.cpf, s.cpf, p.cpf) AS cpf, coalesce(c.nome, s.nome, p.nome) AS nome,
    coalesce(c.balance, s.balance, p.balance) AS balance,
    coalesce(c.nation, s.nation, p.nation) AS nation, c.segment, p.brand
  FROM (SELECT {_MERGE_SELECTS['customer']} FROM customer) c
  FULL OUTER JOIN (SELECT {_MERGE_SELECTS['supplier']} FROM supplier) s ON c.cpf = s.cpf
  FULL OUTER JOIN (SELECT {_MERGE_SELECTS['part']} FROM part) p ON coalesce(c.cpf, s.cpf) = p.cpf"""


def _merge_sources(spark, sf_dir) -> list[DataFrame]:
    return [derive(spark, sf_dir, name, select) for name, select in _MERGE_SELECTS.items()]


@query("priority_merge", _MERGE_SQL)
def priority_merge(spark, sf_dir):
    return merge_by_priority(_merge_sources(spark, sf_dir))


@query("priority_merge_joins", _MERGE_SQL)
def priority_merge_joins(spark, sf_dir):
    return merge_by_joins(_merge_sources(spark, sf_dir))


# --- profiles --------------------------------------------------------------------------


def _profile_sql(key: str, source: str) -> str:
    return f"""SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS rows, count(k) AS distinct_keys,
      CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS repeated_key_rows,
      CAST(coalesce(sum(n), 0) - count(k) AS BIGINT) AS excess_rows,
      CAST(coalesce(sum(n), 0) - count(*) AS BIGINT) AS later_repeats
      FROM (SELECT {key} AS k, count(*) AS n FROM {source} GROUP BY {key})"""


@query("duplicate_profile", _profile_sql("text", "documents"))
def duplicate_profile_query(spark, sf_dir):
    return duplicate_profile(_documents(spark, sf_dir), "_digest")


def _coverage_sql(sources: dict[str, str], key: str) -> str:
    flags = ", ".join(f"bool_or(s = '{name}') AS in_{name}" for name in sources)
    union = " UNION ALL ".join(
        f"SELECT '{name}' AS s, {key} AS k FROM {source}" for name, source in sources.items()
    )
    alone = ", ".join(
        f"count(*) FILTER (WHERE in_{name} AND "
        + " AND ".join(f"NOT in_{o}" for o in sources if o != name)
        + f") AS only_{name}"
        for name in sources
    )
    return (
        f"SELECT count(*) AS any_source, {alone} FROM "
        f"(SELECT k, {flags} FROM ({union}) WHERE k IS NOT NULL GROUP BY k)"
    )


@query(
    "source_coverage",
    _coverage_sql(
        {n: f"(SELECT {s} FROM {n})" for n, s in _MERGE_SELECTS.items()}, "cpf"
    ),
)
def source_coverage_query(spark, sf_dir):
    sources = _merge_sources(spark, sf_dir)
    return source_coverage(dict(zip(_MERGE_SELECTS, sources, strict=True)))


# --- the three sources after quarantine and dedupe -------------------------------------


RAW = {RH.name: rh, ESOCIAL.name: esocial, GESTAO.name: gestao}


def transformed(spark, sf_dir) -> dict[str, DataFrame]:
    """Every source with its row status, written once because several results read it."""

    def prepare(spec) -> DataFrame:
        raw = materialize(RAW[spec.name](spark, sf_dir), "raw")
        return materialize(transform(to_canonical(raw, spec, ORDER), spec, ORDER, ORDER), "transformed")

    tables = side_by_side(spark, [partial(prepare, spec) for spec in SOURCES])
    return {spec.name: df for spec, df in zip(SOURCES, tables, strict=True)}


def _count_sql(source: str) -> str:
    return f"""SELECT '{source}' AS fonte, count(*) AS read,
      count(*) FILTER (WHERE reason IS NULL AND place = 1) AS accepted,
      count(*) FILTER (WHERE reason IS NULL AND place > 1) AS discarded,
      count(*) FILTER (WHERE reason IS NOT NULL) AS rejected FROM {source}_ranked"""


_NAMES = [s.name for s in SOURCES]


@query("stage_counts", f"WITH {SOURCE_CTES} " + " UNION ALL ".join(map(_count_sql, _NAMES)))
def stage_counts(spark, sf_dir):
    status = F.col(STATUS)
    counted = [
        df.agg(
            F.count(F.lit(1)).alias("read"),
            F.count_if(status == KEPT_ROW).alias("accepted"),
            F.count_if(status == DISCARDED_ROW).alias("discarded"),
            F.count_if(status == REJECTED_ROW).alias("rejected"),
        ).select(F.lit(name).alias("fonte"), "*")
        for name, df in transformed(spark, sf_dir).items()
    ]
    return reduce(DataFrame.union, counted)


_DISCARD_SQL = {s.name: s.discard_reason for s in SOURCES}


@query(
    "audit_union",
    f"WITH {SOURCE_CTES} "
    + " UNION ALL ".join(
        f"""SELECT '{n}' AS fonte, reason AS motivo_rejeicao,
          CASE WHEN reason IS NULL THEN '{_DISCARD_SQL[n]}' END AS motivo_duplicidade,
          cpf, nome, _order,
          {'id_evento' if n == 'esocial' else 'CAST(NULL AS VARCHAR)'} AS id_evento,
          {'email' if n == 'gestao' else 'CAST(NULL AS VARCHAR)'} AS email
        FROM {n}_ranked WHERE reason IS NOT NULL OR place > 1"""
        for n in _NAMES
    ),
)
def audit_union(spark, sf_dir):
    frames = []
    tables = transformed(spark, sf_dir)
    for spec in SOURCES:
        df = tables[spec.name]
        rejected = df.filter(F.col(STATUS) == REJECTED_ROW)
        dropped = df.filter(F.col(STATUS) == DISCARDED_ROW).drop("motivo_rejeicao")
        frames += [
            split_rejected(rejected, spec.name).rejected,
            annotate_duplicates(dropped, spec.name, spec.discard_reason),
        ]
    return union_audit(frames).select(
        "fonte", "motivo_rejeicao", "motivo_duplicidade", "cpf", "nome", "_order", "id_evento", "email"
    )


def _long_sql(section: str, position: int, sql: str, names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({position + i} AS INTEGER) AS position, '{section}' AS section, "
        f"'{n}' AS metric, {n} AS value FROM ({sql})"
        for i, n in enumerate(names)
    )


_PROFILE = ["rows", "distinct_keys", "repeated_key_rows", "excess_rows", "later_repeats"]
_REPORT_SECTIONS = [
    *[(n, _profile_sql("cpf", f"{n}_kept"), _PROFILE) for n in _NAMES],
    *[
        (
            f"{n}_before_dedupe",
            _profile_sql("cpf", f"(SELECT * FROM {n}_ranked WHERE reason IS NULL)"),
            _PROFILE,
        )
        for n in _NAMES
    ],
    (
        "coverage",
        _coverage_sql({n: f"{n}_kept" for n in _NAMES}, "cpf"),
        ["any_source", *[f"only_{n}" for n in _NAMES]],
    ),
    ("consolidated", _profile_sql("cpf", "consolidated"), _PROFILE),
]


_REPORT_SQL = f"WITH {CONSOLIDATED_CTES} " + " UNION ALL ".join(
    _long_sql(name, 100 * (i + 1), sql, metrics)
    for i, (name, sql, metrics) in enumerate(_REPORT_SECTIONS)
)


@query("duplicate_report", _REPORT_SQL)
def duplicate_report_query(spark, sf_dir):
    tables = transformed(spark, sf_dir)
    accepted = {n: _canonical(df.filter(F.col(STATUS) == KEPT_ROW)) for n, df in tables.items()}
    before = {n: df.filter(F.col(STATUS) != REJECTED_ROW) for n, df in tables.items()}
    merged = merge_by_priority(list(accepted.values()), check_unique=False)
    return duplicate_report(accepted, before, merged)


def _canonical(df: DataFrame) -> DataFrame:
    return df.drop("_order", "_unreadable_dates", "_unreadable_numbers", STATUS, ORIGINAL_KEY, "motivo_rejeicao")


# --- the whole job ---------------------------------------------------------------------


def consolidated(spark, sf_dir):
    inputs = {
        "rh": SourceInput(frame=rh(spark, sf_dir), order_by=("_order",)),
        "esocial": SourceInput(frame=esocial(spark, sf_dir), order_by=("_order",)),
        "gestao": SourceInput(frame=gestao(spark, sf_dir), order_by=("_order",)),
    }
    return consolidate(spark, inputs, new_folder(spark, "run"))


@query("consolidate_end_to_end", f"WITH {CONSOLIDATED_CTES} SELECT * FROM consolidated")
def consolidate_end_to_end(spark, sf_dir):
    return consolidated(spark, sf_dir).consolidated


#: Buckets of the key in the queries below.
_BUCKETS = 8


def bucketed(spark, sf_dir):
    inputs = {name: SourceInput(frame=raw(spark, sf_dir), order_by=("_order",)) for name, raw in RAW.items()}
    return consolidate(spark, inputs, new_folder(spark, "run"), buckets=_BUCKETS)


@query("consolidate_bucketed", f"WITH {CONSOLIDATED_CTES} SELECT * FROM consolidated")
def consolidate_bucketed(spark, sf_dir):
    """The job over stage tables in buckets of the key, merged where they lie."""
    return bucketed(spark, sf_dir).consolidated


@query("duplicate_report_bucketed", _REPORT_SQL)
def duplicate_report_bucketed(spark, sf_dir):
    """The report of a run in buckets: kept keys are counted where they lie, only dropped keys are shuffled."""
    return bucketed(spark, sf_dir).report()


@query("changed_source", f"WITH {CONSOLIDATED_CTES} SELECT * FROM consolidated")
def changed_source(spark, sf_dir):
    """A run taken over by one whose third source changed: rows that had won every key are gone, others win instead."""
    inputs = {name: SourceInput(frame=raw(spark, sf_dir), order_by=("_order",)) for name, raw in RAW.items()}
    now = gestao(spark, sf_dir)
    gone = now.withColumn("nome", F.lit("antigo")).withColumn("_order", (-F.col("_order") - 1).cast(now.schema["_order"].dataType))
    folder, place = new_folder(spark, "run"), new_folder(spark, "before")
    now.unionByName(gone).write.parquet(place)
    before = SourceInput(frame=spark.read.parquet(place), order_by=("_order",))
    consolidate(spark, {**inputs, "gestao": before}, folder, buckets=_BUCKETS)
    return consolidate(spark, inputs, folder, only_changed=True, buckets=_BUCKETS).consolidated


@query("resume_consolidation", f"WITH {CONSOLIDATED_CTES} SELECT * FROM consolidated")
def resume_consolidation(spark, sf_dir):
    """A run that was cut before its last two stages and goes on from there."""
    inputs = {name: SourceInput(frame=raw(spark, sf_dir), order_by=("_order",)) for name, raw in RAW.items()}
    folder = new_folder(spark, "run")
    consolidate(spark, inputs, folder)
    for stage in ("merge", "transform_gestao"):
        delete_folder(spark, f"{folder}/markers/{stage}")
    return consolidate(spark, inputs, folder, resume=True).consolidated


# --- delimited files, in and out ---------------------------------------------------------

_SOURCE_TABLES = {RH.name: ("customer", RH_SELECT), ESOCIAL.name: ("orders", ESOCIAL_SELECT), GESTAO.name: ("part", GESTAO_SELECT)}
_FILES = 4


def _from_files(spark, sf_dir):
    """The job over delimited files: each source in several files, whose order and line order decide which row comes first."""
    folder = new_folder(spark, "sources")
    inputs = {}
    for name, (source, select) in _SOURCE_TABLES.items():
        rows = derive(spark, sf_dir, source, select).repartitionByRange(_FILES, "_order").sortWithinPartitions("_order")
        write_delimited(rows.drop("_order"), f"{folder}/{name}")
        inputs[name] = SourceInput(path=f"{folder}/{name}")
    return consolidate(spark, inputs, new_folder(spark, "run"))


@query("delimited_consolidation", f"WITH {CONSOLIDATED_CTES} SELECT * FROM consolidated")
def delimited_consolidation(spark, sf_dir):
    return _from_files(spark, sf_dir).consolidated


@query(
    "delimited_export",
    f"""WITH {CONSOLIDATED_CTES} SELECT row_number() OVER (ORDER BY cpf) AS place, cpf, nome, cargo, sigla_orgao,
      CAST(data_admissao AS VARCHAR) AS data_admissao, id_evento FROM consolidated""",
)
def delimited_export(spark, sf_dir):
    """The sorted export, read back in the order of its files and lines."""
    folder = new_folder(spark, "export")
    export(spark, consolidated(spark, sf_dir), folder, sort_by_key=True)
    back = read_delimited(spark, f"{folder}/pessoas_consolidado")
    chosen = back.select("cpf", "nome", "cargo", "sigla_orgao", "data_admissao", "id_evento", *FILE_ORDER)
    return number_rows(chosen, FILE_ORDER, "place").drop(*FILE_ORDER)


@query(
    "run_outputs",
    f"WITH {CONSOLIDATED_CTES} "
    + " UNION ALL ".join(
        f"SELECT '{metric}' AS metric, '{n}' AS source, (SELECT count(*) FROM {n}_ranked WHERE {where}) AS value"
        for n in _NAMES
        for metric, where in (
            ("rows_read", "true"), ("rows_accepted", "reason IS NULL AND place = 1"),
            ("rows_discarded", "reason IS NULL AND place > 1"), ("rows_rejected", "reason IS NOT NULL"),
        )
    )
    + " UNION ALL SELECT 'rows_consolidated', 'manifest', (SELECT count(*) FROM consolidated)"
    + " UNION ALL SELECT 'rows_rejected_total', 'manifest', ("
    + " + ".join(f"(SELECT count(*) FROM {n}_ranked WHERE reason IS NOT NULL)" for n in _NAMES)
    + ")",
)
def run_outputs(spark, sf_dir):
    """The counts a run observed, as its metrics and manifest on disk state them."""
    folder = new_folder(spark, "export")
    export(spark, consolidated(spark, sf_dir), folder)
    names = ("rows_read", "rows_accepted", "rows_discarded", "rows_rejected")
    schema = ", ".join(f"{n} map<string,bigint>" for n in names)
    metrics = spark.read.json(f"{folder}/metrics").select(F.from_json("metrics", schema).alias("m")).select("m.*")
    long = [metrics.select(F.lit(n).alias("metric"), F.explode(n).alias("source", "value")) for n in names]
    manifest = spark.read.json(f"{folder}/manifest")
    long += [
        manifest.select(F.lit(n).alias("metric"), F.lit("manifest").alias("source"), F.col(n).cast("bigint").alias("value"))
        for n in ("rows_consolidated", "rows_rejected_total")
    ]
    return reduce(DataFrame.union, long)

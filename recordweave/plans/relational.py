"""The normalised relational model: catalogs, person, employment, evaluation and event.

The tables are Parquet, cut into a fixed number of buckets of their key (``buckets``).  A full load writes all of them
into a folder of its own and switches to it at the end, so a failed load leaves the tables as they were.  An incremental load first writes what
comes in: new catalog entries, persons and events, and the employments and scores that replace or update others.  After the audit it
rewrites the buckets these rows fall into, in place; files of other buckets stay.  Both go on where they were cut: stages
that are finished are kept, and of a stage or table that was being written, the buckets that have a commit record.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordweave.functions.dates import parse_load_date
from recordweave.functions.keys import normalize_key
from recordweave.functions.numbers import exceeds_decimal, load_decimal
from recordweave.functions.text import blank_to_null, bounded, is_missing, name_or_default
from recordweave.operators.integrity import (
    MaxLength,
    NotNull,
    Reference,
    Unique,
    audit,
    require_integrity,
)
from recordweave.operators.lookup import (
    EVENT_ID_LENGTH,
    SKIP_REASON,
    Catalog,
    mark_violations,
    require_no_violations,
    resolve_events,
    split_checked,
)
from recordweave.operators.numbering import number_rows
from recordweave.operators.sampling import head_n, restrict_to_keys
from recordweave.operators.writes import (
    absent_rows,
    cascade_delete,
    replaced_rows,
    upserted_rows,
)
from recordweave.plans.buckets import BUCKET, Buckets, laid_over, present, read_buckets, touched, write_buckets
from recordweave.plans.key_filter import KeyFilter
from recordweave.plans.stages import WIDE_ROWS, ResumeError, StageStore, describe_frame, side_by_side, under
from recordweave.sources.tables import empty_table, read_record, write_record
from recordweave.storage import child_names, delete_folder, materialize

# Table columns of the target model.
CODE_SCHEMA = "id long, codigo string"
SCHEMAS: Mapping[str, str] = {
    "tipo_vinculo": CODE_SCHEMA,
    "status_servidor": CODE_SCHEMA,
    "tipo_evento": CODE_SCHEMA,
    "orgao": "id long, sigla string",
    "cargo": "id long, nome string",
    "pessoa": "id long, cpf string, nome string, data_nascimento date, sexo string, "
    "estado_civil string, cor_raca string, nacionalidade string, email string, telefone string",
    "vinculo": "id long, pessoa_id long, orgao_id long, cargo_id long, tipo_vinculo_id long, "
    "status_servidor_id long, matricula string, salario_base decimal(14,2), lotacao string, "
    "data_admissao date, data_saida date",
    "avaliacao_desempenho": "id long, pessoa_id long, ciclo_avaliacao string, nota decimal(4,1)",
    "evento": "id long, pessoa_id long, id_evento_origem string, tipo_evento_id long, "
    "data_evento date, codigo_categoria string, indicador_retificacao string, "
    "numero_recibo string",
}

# Seed rows of the fixed catalogs.
SEEDS: Mapping[str, tuple[str, ...]] = {
    "tipo_vinculo": ("efetivo", "comissionado", "cedido"),
    "status_servidor": ("ativo", "afastado", "exonerado"),
    "tipo_evento": ("admissao", "afastamento", "desligamento"),
}

# Constraints of the target model. Ids are unique by the way they are numbered.
RULES = (
    *[Unique(t, ("codigo",)) for t in SEEDS],
    Unique("orgao", ("sigla",)),
    Unique("cargo", ("nome",)),
    Unique("pessoa", ("cpf",)),
    Unique("vinculo", ("pessoa_id",)),
    Unique("evento", ("id_evento_origem",)),
    Unique("avaliacao_desempenho", ("pessoa_id", "ciclo_avaliacao")),
    *[NotNull(t, ("codigo",)) for t in SEEDS],
    NotNull("orgao", ("sigla",)),
    NotNull("cargo", ("nome",)),
    NotNull("pessoa", ("cpf", "nome")),
    NotNull(
        "vinculo",
        ("pessoa_id", "orgao_id", "cargo_id", "tipo_vinculo_id", "status_servidor_id"),
    ),
    NotNull("evento", ("pessoa_id", "id_evento_origem", "tipo_evento_id", "data_evento")),
    NotNull("avaliacao_desempenho", ("pessoa_id", "ciclo_avaliacao")),
    Reference("vinculo", "pessoa_id", "pessoa"),
    Reference("vinculo", "orgao_id", "orgao"),
    Reference("vinculo", "cargo_id", "cargo"),
    Reference("vinculo", "tipo_vinculo_id", "tipo_vinculo"),
    Reference("vinculo", "status_servidor_id", "status_servidor"),
    Reference("evento", "pessoa_id", "pessoa"),
    Reference("evento", "tipo_evento_id", "tipo_evento"),
    Reference("avaliacao_desempenho", "pessoa_id", "pessoa"),
    MaxLength("orgao", {"sigla": 64}),
    MaxLength("cargo", {"nome": 256}),
)

# Precision and scale of numbers, length of a cycle.
SALARY, SCORE, CYCLE_LENGTH = (14, 2), (4, 1), 16

# Unique key of every loaded table, and the part of it that tells the bucket.
KEYS: Mapping[str, tuple[str, ...]] = {
    "orgao": ("sigla",),
    "cargo": ("nome",),
    "pessoa": ("cpf",),
    "vinculo": ("pessoa_id",),
    "avaliacao_desempenho": ("pessoa_id", "ciclo_avaliacao"),
    "evento": ("id_evento_origem",),
}
BUCKET_KEYS = {name: key[:1] for name, key in KEYS.items()}
CATALOGS = ("orgao", "cargo")
#: Buckets of a model, unless its first load says otherwise.  Enough that one of them is a matter of minutes.
BUCKETS = 16

_STATE = "version long, generation long, buckets int, highest string"

ROW_ORDER, EVENT_ORDER = "_row_order", "_event_order"

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class LoadResult:
    tables: Tables
    violations: DataFrame
    skipped_events: DataFrame
    counts: Mapping[str, Mapping[str, int]]
    seconds: float
    version: int


def fixed_catalog(spark: SparkSession, name: str) -> DataFrame:
    codes = F.array(*[F.lit(code) for code in SEEDS[name]])
    return spark.range(1, numPartitions=1).select(F.posexplode(codes).alias("place", "codigo")).select(
        (F.col("place") + 1).cast("bigint").alias("id"), "codigo"
    )


def empty_model(spark: SparkSession) -> dict[str, DataFrame]:
    """Seeded fixed catalogs and empty tables for everything that is loaded."""
    return {
        name: fixed_catalog(spark, name) if name in SEEDS else empty_table(spark, schema)
        for name, schema in SCHEMAS.items()
    }


# --- rows of each entity, from consolidated columns -------------------------------------


def _cell(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _date(df: DataFrame, name: str) -> Column:
    c = _cell(df, name)
    return c if dict(df.dtypes).get(name) == "date" else parse_load_date(c)


def loadable_people(consolidated: DataFrame) -> DataFrame:
    """Consolidated rows with a usable key, in load form."""
    return consolidated.withColumn("cpf", normalize_key(F.col("cpf"))).filter("cpf is not null")


def person_rows(people: DataFrame) -> DataFrame:
    return people.select(
        "cpf",
        name_or_default(_cell(people, "nome")).alias("nome"),
        _date(people, "data_nascimento").alias("data_nascimento"),
        bounded(_cell(people, "sexo"), 20).alias("sexo"),
        bounded(_cell(people, "estado_civil"), 64).alias("estado_civil"),
        bounded(_cell(people, "cor"), 32).alias("cor_raca"),
        bounded(_cell(people, "nacionalidade"), 64).alias("nacionalidade"),
        bounded(_cell(people, "email"), 256).alias("email"),
        bounded(_cell(people, "telefone"), 64).alias("telefone"),
        ROW_ORDER,
    )


def new_codes(rows: DataFrame, column: str, existing: DataFrame, code: str) -> DataFrame:
    """Distinct codes in use that the catalog lacks."""
    used = rows.select(blank_to_null(F.col(column).cast("string")).alias(code))
    return used.filter(F.col(code).isNotNull()).distinct().join(
        existing.select(code), code, "left_anti"
    )


def value_limits(people: DataFrame) -> dict[str, Column]:
    """Readable values that the target columns can't hold.  Cutting a key or dropping a number would lose rows unrecorded."""
    cycle = _cell(people, "ciclo_avaliacao").cast("string")
    score = _cell(people, "avaliacao_desempenho")
    too_high = exceeds_decimal(score, *SCORE)
    scored = load_decimal(score, *SCORE).isNotNull() | too_high
    limits = {
        "salario_base": exceeds_decimal(_cell(people, "salario_base"), *SALARY),
        "avaliacao_desempenho": ~is_missing(cycle) & too_high,
        "ciclo_avaliacao": scored & (F.length(cycle) > CYCLE_LENGTH),
    }
    return {name: limit for name, limit in limits.items() if name in people.columns}


def employment_rows(checked: DataFrame, people: DataFrame) -> DataFrame:
    return (
        checked.join(people.select("cpf", F.col("id").alias("pessoa_id")), "cpf")
        .select(
            "pessoa_id", "orgao_id", "cargo_id", "tipo_vinculo_id", "status_servidor_id",
            bounded(_cell(checked, "matricula").cast("string"), 128).alias("matricula"),
            load_decimal(_cell(checked, "salario_base"), *SALARY).alias("salario_base"),
            bounded(_cell(checked, "lotacao"), 4000).alias("lotacao"),
            _date(checked, "data_admissao").alias("data_admissao"),
            _date(checked, "data_saida").alias("data_saida"),
            ROW_ORDER,
        )
    )


def evaluation_rows(checked: DataFrame, people: DataFrame) -> DataFrame:
    """Only rows with both a cycle and a score."""
    cycle = _cell(checked, "ciclo_avaliacao").cast("string")
    score = load_decimal(_cell(checked, "avaliacao_desempenho"), *SCORE)
    return (
        checked.filter(~is_missing(cycle) & score.isNotNull())
        .join(people.select("cpf", F.col("id").alias("pessoa_id")), "cpf")
        .select(
            "pessoa_id",
            cycle.alias("ciclo_avaliacao"),
            score.alias("nota"),
            ROW_ORDER,
        )
    )


def event_rows(resolved: DataFrame) -> DataFrame:
    """Loadable events in target form."""
    return resolved.filter(F.col(SKIP_REASON).isNull()).select(
        "pessoa_id",
        bounded(F.col("id_evento").cast("string"), EVENT_ID_LENGTH).alias("id_evento_origem"),
        "tipo_evento_id",
        F.col("_date").alias("data_evento"),
        bounded(_cell(resolved, "codigo_categoria").cast("string"), 32).alias("codigo_categoria"),
        bounded(_cell(resolved, "indicador_retificacao").cast("string"), 32).alias(
            "indicador_retificacao"
        ),
        bounded(_cell(resolved, "numero_recibo").cast("string"), 128).alias("numero_recibo"),
        EVENT_ORDER,
    )


def without_people(tables: Tables, removed: DataFrame) -> dict[str, DataFrame]:
    """The model after deleting persons by id, together with everything that refers to them."""
    people = tables["pessoa"].join(removed.select("id"), "id", "left_anti")
    children = {
        rule.table: cascade_delete(tables[rule.table], removed, rule.column)
        for rule in RULES
        if isinstance(rule, Reference) and rule.parent == "pessoa"
    }
    return {**tables, "pessoa": people.select(*tables["pessoa"].columns), **children}


# --- the load -------------------------------------------------------------------------


@dataclass(frozen=True)
class State:
    """What a model consists of: its last load, the full load whose folder holds the tables, buckets, and the highest ids."""

    version: int = 0
    generation: int = 0
    buckets: int = BUCKETS
    highest: Mapping[str, int] | None = None

    def next_id(self, name: str) -> int:
        return (self.highest or {}).get(name, 0)


def read_state(spark: SparkSession, target: str) -> State:
    record = read_record(spark, f"{target}/current")
    if record is None:
        return State()
    return State(record["version"], record["generation"], record["buckets"], json.loads(record["highest"]))


def current_version(spark: SparkSession, target: str) -> int:
    return read_state(spark, target).version


def table_path(target: str, state: State, name: str) -> str:
    return f"{target}/v{state.generation}/stages/{name}"


def bucket_count(state: State, name: str) -> int:
    """Catalogs are small and kept in one bucket."""
    return 1 if name in CATALOGS else state.buckets


def read_model(spark: SparkSession, target: str, only: Mapping[str, Sequence[int]] | None = None) -> dict[str, DataFrame]:
    """The tables as they are now; seeds and empty tables before any load.

    ``only`` names buckets of tables; their others are not read.
    """
    state = read_state(spark, target)
    if state.version == 0:
        return empty_model(spark)
    tables = {name: fixed_catalog(spark, name) for name in SEEDS}
    for name in KEYS:
        rows = read_buckets(spark, table_path(target, state, name), SCHEMAS[name], (only or {}).get(name))
        tables[name] = rows.drop(BUCKET)
    return {name: tables[name] for name in SCHEMAS}


def drop_versions(spark: SparkSession, target: str) -> list[int]:
    """Delete the folders of loads that the tables no longer lie in; their numbers.  Frames that earlier loads returned are gone with them."""
    state = read_state(spark, target)
    found = sorted(int(name[1:]) for name in child_names(spark, target) if name[:1] == "v" and name[1:].isdigit())
    gone = [v for v in found if v <= state.version and v != state.generation]
    for version in gone:
        delete_folder(spark, f"{target}/v{version}")
    return gone


def filtered_until(spark: SparkSession, target: str, state: State) -> int | None:
    """The last load whose event ids the filter knows."""
    record = read_record(spark, f"{target}/v{state.generation}/filters/record")
    return None if record is None else record["version"]


def _apply(spark: SparkSession, target: str, state: State, version: int, batches: int) -> dict[str, dict[str, int]]:
    """Lay the rows an incremental load has written over the buckets they fall into; what was written and what was there already."""

    def lay_over(name: str) -> dict[str, int]:
        path, delta_path = table_path(target, state, name), f"{target}/v{version}/stages/{name}"
        wanted = present(spark, delta_path)
        if not wanted:
            return {"buckets_written": 0, "buckets_reused": 0}
        delta = read_buckets(spark, delta_path, SCHEMAS[name])
        whole = laid_over(read_buckets(spark, path, SCHEMAS[name], wanted), delta, [BUCKET, *KEYS[name]])
        done = write_buckets(whole, path, f"{target}/v{version}/applied/{name}", wanted, batches)
        return {"buckets_written": len(done.written), "buckets_reused": len(done.reused)}

    return dict(zip(KEYS, side_by_side(spark, [partial(lay_over, name) for name in KEYS]), strict=True))


@under(WIDE_ROWS)
def load_model(
    spark: SparkSession,
    consolidated: DataFrame,
    events: DataFrame | None,
    target: str,
    incremental: bool = False,
    on_violation: Literal["fail", "quarantine"] = "fail",
    row_limit: int | None = None,
    resume: bool = False,
    row_order: Sequence[str] = ("cpf",),
    event_order: Sequence[str] = ("cpf",),
    check: bool = True,
    buckets: int = BUCKETS,
    batches: int = 1,
    event_filter: bool = False,
) -> LoadResult:
    """Load consolidated rows, and optionally events, into the model under ``target``.

    A full load starts from empty tables and keeps only the fixed catalogs; an
    incremental one adds to those that are there.  Codes and persons are inserted if
    absent, employment is replaced per person, scores are updated per person and
    cycle, events are inserted if their id is absent.  Where several rows share
    a person, ``row_order`` tells which comes first (and makes the person) and
    which last (and makes the employment and the score); ``event_order`` does
    the same for events with one id.

    An incremental load reads the buckets that its rows fall into and writes only those; its audit looks at the rows
    that came in, and at the keys of those buckets.  ``buckets`` counts for a full load; an incremental one keeps what there is.  ``batches``
    is the number of jobs that write a table; a load that was cut goes on after the last of them if ``resume`` is set.  Until it does, a model
    whose buckets were being rewritten takes no other load.  ``event_filter`` keeps a filter of the event ids beside the tables (``key_filter``),
    so that an incremental load looks only for ids that may be there; a load without it makes the filter stale, and the next one with it fits it anew.
    """
    started = time.perf_counter()
    target = target.rstrip("/")
    state = read_state(spark, target)
    version = state.version + 1
    whole = not incremental or not state.version
    applying = read_record(spark, f"{target}/applying")
    if applying is not None and applying["version"] == version and not whole and not resume:
        raise ResumeError(f"load {version} was cut while it rewrote buckets of {target}; resume it first")
    if whole:
        state = State(state.version, version, buckets)
    settings = {
        "row_limit": row_limit,
        "incremental": incremental,
        "on_violation": on_violation,
        "base_version": state.version,
        "buckets": state.buckets,
        "row_order": list(row_order),
        "event_order": list(event_order),
        "consolidated": describe_frame(consolidated),
        "events": None if events is None else describe_frame(events),
    }
    store = StageStore(spark, f"{target}/v{version}", settings, resume)
    rows = {"rows": F.count(F.lit(1))}
    empty = empty_model(spark)
    new: dict[str, DataFrame] = {name: empty[name] for name in SEEDS}
    fresh: dict[str, DataFrame] = {}

    def old(name: str, only: Sequence[int] | None = None) -> DataFrame:
        """The table before this load, or some buckets of it."""
        if whole:
            return empty[name]
        return read_buckets(spark, table_path(target, state, name), SCHEMAS[name], only).drop(BUCKET)

    def near(name: str, incoming: DataFrame) -> DataFrame:
        """The part of the table before this load that can share a key with incoming rows."""
        return empty[name] if whole else old(name, touched(incoming, BUCKET_KEYS[name], state.buckets))

    def save(name: str, build: Callable[[], DataFrame], after: Sequence[str] = ()) -> DataFrame:
        """Write the rows of this load."""
        cut = Buckets(BUCKET_KEYS[name], bucket_count(state, name), batches)
        ids = {**rows, "highest": F.max("id")}
        fresh[name] = store.run(name, build, ids, after=after, buckets=cut).table.drop(BUCKET)
        return fresh[name]

    def numbered(name: str, added: DataFrame, order: Sequence[str]) -> DataFrame:
        return number_rows(added, order, "id", after=state.next_id(name)).select(*empty[name].columns)

    held = KeyFilter(spark, f"{target}/v{state.generation}/filters/evento", KEYS["evento"], state.buckets)
    # An empty table needs no filter.
    current = whole or filtered_until(spark, target, state) == state.version
    limited = consolidated if row_limit is None else head_n(consolidated, row_order, row_limit)
    people = loadable_people(limited.withColumn(ROW_ORDER, F.struct(*row_order)))

    def catalog(name: str, column: str, code: str) -> DataFrame:
        added = save(name, lambda: numbered(name, new_codes(people, column, old(name), code), [code]))
        new[name] = laid_over(old(name), added, KEYS[name])
        return new[name]

    side_by_side(
        spark,
        [
            partial(catalog, "orgao", "sigla_orgao", "sigla"),
            partial(catalog, "cargo", "cargo", "nome"),
        ],
    )

    catalogs = [
        Catalog(new["orgao"], "sigla", "sigla_orgao", "orgao_id"),
        Catalog(new["cargo"], "nome", "cargo", "cargo_id"),
        Catalog(new["tipo_vinculo"], "codigo", "tipo_vinculo", "tipo_vinculo_id"),
        Catalog(new["status_servidor"], "codigo", "status_servidor", "status_servidor_id"),
    ]
    codes = ["orgao", "cargo"]
    limits = value_limits(people)
    # Written once: persons, employment, evaluations and the violations all read it.
    marked = store.run("verificados", lambda: mark_violations(people, catalogs, limits), rows, after=codes).table
    ok, bad = split_checked(marked, catalogs)
    violations = bad.drop(ROW_ORDER)
    if on_violation == "fail":
        require_no_violations(violations, "cpf", [*[c.refers for c in catalogs], *limits])

    # Persons that rows or events may belong to: new ones, and those there are in the same buckets.
    known = empty["pessoa"]
    if not whole:
        keys = ok.select("cpf")
        if events is not None:
            keys = keys.unionByName(events.select(normalize_key(F.col("cpf")).alias("cpf")))
        known = near("pessoa", keys)

    def absent_persons() -> DataFrame:
        absent = absent_rows(known, person_rows(ok), KEYS["pessoa"], [ROW_ORDER])
        return numbered("pessoa", absent.drop(ROW_ORDER), KEYS["pessoa"])

    persons = laid_over(known, save("pessoa", absent_persons, after=["verificados"]), KEYS["pessoa"])

    def employment() -> DataFrame:
        number = partial(numbered_rows, "vinculo")
        return replaced_rows(employment_rows(ok, persons), KEYS["vinculo"], [ROW_ORDER], number).select(*empty["vinculo"].columns)

    def numbered_rows(name: str, added: DataFrame) -> DataFrame:
        return number_rows(added, KEYS[name], "id", after=state.next_id(name))

    def evaluations() -> DataFrame:
        name = "avaliacao_desempenho"
        incoming = materialize(evaluation_rows(ok, persons), "evaluations")
        return upserted_rows(near(name, incoming), incoming, KEYS[name], ["nota"], [ROW_ORDER], partial(numbered_rows, name))

    def resolved_events() -> DataFrame:
        chosen = events
        if row_limit is not None:
            keyed = events.withColumn("_key", normalize_key(F.col("cpf")))
            sample = people.select(F.col("cpf").alias("_key"))
            chosen = restrict_to_keys(keyed, sample, "_key").drop("_key")
        ordered = chosen.withColumn(EVENT_ORDER, F.struct(*event_order))
        return resolve_events(ordered, persons, new["tipo_evento"])

    def load_events() -> DataFrame:
        if events is None:
            save("evento", lambda: empty["evento"])
            return empty_table(spark, f"cpf string, {SKIP_REASON} string")
        resolved = store.run("eventos_resolvidos", resolved_events, rows, after=["pessoa"]).table
        key, order = KEYS["evento"], [EVENT_ORDER]

        def absent_events() -> DataFrame:
            incoming = event_rows(resolved)
            there = near("evento", incoming)
            if event_filter and not whole:
                return numbered("evento", held.absent_rows(there, incoming, order).drop(*order), key)
            return numbered("evento", absent_rows(there, incoming, key, order).drop(*order), key)

        if event_filter and not current:
            held.fit(old("evento"))
        added = save("evento", absent_events, after=["eventos_resolvidos"])
        if event_filter:
            # Before the table has them: a filter may know too many keys, never too few.
            held.add(added, near("evento", added))
        return resolved.filter(F.col(SKIP_REASON).isNotNull()).drop(
            "pessoa_id", "tipo_evento_id", "_date", EVENT_ORDER
        )

    _, _, skipped = side_by_side(
        spark,
        [
            partial(save, "vinculo", employment, ["pessoa"]),
            partial(save, "avaliacao_desempenho", evaluations, ["pessoa"]),
            load_events,
        ],
    )

    if whole:
        reached = {**new, **fresh}
    else:
        only = {name: present(spark, store.path(name)) for name in KEYS}
        reached = {**new, "pessoa": persons}
        for name in KEYS.keys() - {"pessoa", *CATALOGS}:
            reached[name] = laid_over(old(name, only[name]), fresh[name], KEYS[name])
    if check:
        require_integrity(audit(RULES, reached, None if whole else {**reached, **fresh}))
    counts = dict(store.counts)
    if not whole:
        write_record(spark, f"{target}/applying", {"version": version}, "version long")
        counts |= {name: {**counts[name], **done} for name, done in _apply(spark, target, state, version, batches).items()}
    highest = {name: max(state.next_id(name), store.counts[name]["highest"]) for name in KEYS}
    record = {"version": version, "generation": state.generation, "buckets": state.buckets, "highest": json.dumps(highest)}
    if event_filter and (current or events is not None):
        write_record(spark, f"{target}/v{state.generation}/filters/record", {"version": version}, "version long")
    write_record(spark, f"{target}/current", record, _STATE)
    return LoadResult(
        read_model(spark, target), violations, skipped, counts, round(time.perf_counter() - started, 3), version
    )

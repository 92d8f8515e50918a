import datetime as dt
import json
import pathlib
from functools import reduce
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from recordweave.operators.integrity import audit
from recordweave.operators.lookup import SKIP_REASON, DomainError
from recordweave.operators.merge import DuplicateKeyError, merge_by_joins, merge_by_priority, merge_settled
from recordweave.operators.profile import duplicate_profile, duplicate_report, settled_counts
from recordweave.plans import relational
from recordweave.plans.buckets import Buckets, present, touched
from recordweave.plans.consolidate import SourceInput, consolidate, export
from recordweave.plans.profiles import ProfileStore, ReferenceCounts
from recordweave.plans.relational import (
    KEYS,
    RULES,
    current_version,
    drop_versions,
    load_model,
    read_model,
    read_state,
    without_people,
)
from recordweave.plans.stages import ResumeError, StageStore
from recordweave.sources.contracts import CONSOLIDATED_COLUMNS, ESOCIAL, GESTAO, RH, SOURCES, SourceSpec
from recordweave.sources.delimited import read_delimited
from recordweave.sources.tables import read_record
from recordweave.storage import checkpoint_root, delete_folder

K1, K2, K3, K4 = (f"{i}" * 11 for i in (1, 2, 3, 4))


def write_csv(path, columns, records):
    lines = [",".join(columns)]
    lines += [",".join(f'"{r.get(c, "")}"' for c in columns) for r in records]
    path.write_bytes(b"\xef\xbb\xbf" + "\n".join(lines).encode() + b"\n")
    return SourceInput(path=str(path))


JOB = {"sigla_orgao": "SEC A", "cargo": "Analista", "tipo_vinculo": "efetivo", "status_servidor": "ativo"}


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    tmp_path = tmp_path_factory.mktemp("sources")
    rh = [
        {"cpf": "111.111.111-11", "nome": "Ana", "data_nascimento": "1980-02-03", "salario_base": "1000,50",
         "matricula": "007", "data_admissao": "2010-01-01", **JOB},
        {"cpf": "222.222.222-22", "nome": "", "data_nascimento": "31/02/2020", **JOB},
        {"cpf": "111.111.111-11", "nome": "Ana de novo", **JOB},
        {"cpf": "123", "nome": "Curto", **JOB},
        {"cpf": "", "nome": "Sem chave", **JOB},
    ]
    esocial = [
        {"cpf": K1, "id_evento": "e1", "tipo_evento": "admissao", "data_evento": "2020-01-01", "codigo_categoria": "301.0"},
        {"cpf": K1, "id_evento": "e2", "tipo_evento": "afastamento", "data_evento": "2021-01-01"},
        {"cpf": K1, "id_evento": "e3", "tipo_evento": "afastamento", "data_evento": "2021-01-01"},
        {"cpf": K2, "nome": "Bia", "id_evento": "e4", "tipo_evento": "outro", "data_evento": ""},
        {"cpf": K3, "nome": "Caio", "id_evento": "e5", "tipo_evento": "admissao", "data_evento": "2019-05-05"},
    ]
    gestao = [
        {"cpf": K4, "nome": "Davi", "dataNascimento": "04/05/1990", "orgao": "SEC B", "cargo": "Chefe",
         "tipoVinculo": "cedido", "status": "afastado", "salario": "2000.00",
         "avaliacaoDesempenho": "4,5", "cicloAvaliacao": "2023", "email": "d@example.org"},
        {"cpf": K1, "nome": "Ana G", "orgao": "SEC Z", "sexo": "F", "avaliacaoDesempenho": "3,0", "cicloAvaliacao": "2023"},
        {"cpf": K1, "nome": "Ana dup", "orgao": "SEC Z"},
    ]
    plain = ["nome", "cpf", "matricula", "cargo", "sexo", "cor", "nacionalidade", "email", "telefone"]
    return {
        "rh": write_csv(tmp_path / "rh.csv", RH.exact_columns, rh),
        "esocial": write_csv(tmp_path / "esocial.csv", ESOCIAL.exact_columns, esocial),
        "gestao": write_csv(tmp_path / "gestao.csv", [*plain, *GESTAO.renames], gestao),
    }


@pytest.fixture(scope="module")
def run(spark, inputs, tmp_path_factory):
    return consolidate(spark, inputs, str(tmp_path_factory.mktemp("run")))


def test_consolidated_rows(run):
    got = {r.cpf: r for r in run.consolidated.collect()}
    assert run.consolidated.columns == list(CONSOLIDATED_COLUMNS)
    assert sorted(got) == [K1, K2, K3, K4]
    ana = got[K1]
    assert (ana.nome, ana.salario_base, ana.matricula, ana.sexo) == ("Ana", 1000.5, "007", "F")
    assert (ana.id_evento, ana.data_evento, ana.sigla_orgao) == ("e2", dt.date(2021, 1, 1), "SEC A")
    assert got[K2].nome == "Bia" and got[K2].data_nascimento is None
    assert got[K4].data_nascimento == dt.date(1990, 5, 4)
    assert got[K4].avaliacao_desempenho == 4.5


def test_audits_account_for_every_row(run, rows):
    assert rows(run.rejected, "cpf_original", "fonte", "motivo_rejeicao") == [
        ("", "rh", "cpf_ausente"), ("123", "rh", "cpf_quantidade_digitos_invalida"),
    ]
    assert rows(run.duplicates, "fonte", "motivo_duplicidade", "nome", "id_evento") == [
        ("esocial", "evento_descartado_mantido_data_evento_mais_recente", None, "e1"),
        ("esocial", "evento_descartado_mantido_data_evento_mais_recente", None, "e3"),
        ("gestao", "cpf_duplicado_mantida_primeira_linha", "Ana dup", None),
        ("rh", "cpf_duplicado_mantida_primeira_linha", "Ana de novo", None),
    ]
    assert run.duplicates.columns[:2] == ["fonte", "motivo_duplicidade"]
    m = run.metrics
    assert m["rows_read"] == {"rh": 5, "esocial": 5, "gestao": 3}
    for name in m["rows_read"]:
        parts = m["rows_accepted"][name] + m["rows_discarded"][name] + m["rows_rejected"][name]
        assert parts == m["rows_read"][name]
        assert run.accepted[name].count() == m["rows_accepted"][name]
    assert m["unreadable_dates"] == {"rh": 1, "esocial": 0, "gestao": 0}
    assert m["rows_consolidated"] == 4 and m["rows_rejected_total"] == 2
    assert duplicate_profile(run.consolidated).first()["later_repeats"] == 0


def test_merge_forms_agree(run):
    other = merge_by_joins(list(run.accepted.values()))
    assert run.consolidated.exceptAll(other).count() == 0
    assert other.exceptAll(run.consolidated).count() == 0


def test_report(run):
    value = {(r.section, r.metric): r.value for r in run.report().collect()}
    assert value["esocial_before_dedupe", "excess_rows"] == 2
    assert value["coverage", "any_source"] == 4
    assert value["coverage", "only_gestao"] == 1


def test_row_limit(spark, inputs, tmp_path):
    limited = consolidate(spark, inputs, str(tmp_path / "run"), row_limit=1)
    assert limited.metrics["rows_read"] == {"rh": 1, "esocial": 1, "gestao": 1}


def test_parity_option_reads_reasons_from_the_normalised_key(spark, inputs, tmp_path, rows):
    result = consolidate(spark, inputs, str(tmp_path / "run"), reason_on_original=False)
    assert rows(result.rejected, "motivo_rejeicao") == [("cpf_ausente",), ("cpf_ausente",)]


def test_check_digit_option(spark, inputs, tmp_path):
    # Eleven equal digits pass the check-digit rule; a changed one does not.
    result = consolidate(spark, inputs, str(tmp_path / "run"), check_digits=True)
    assert result.consolidated.count() == 4


def test_frames_as_sources(spark, inputs, tmp_path):
    frames = {
        name: SourceInput(frame=read_delimited(spark, i.path)) for name, i in inputs.items()
    }
    from_files = consolidate(spark, inputs, str(tmp_path / "a")).consolidated
    from_frames = consolidate(spark, frames, str(tmp_path / "b")).consolidated
    assert from_files.exceptAll(from_frames).count() == 0


def test_resume_reuses_finished_stages(spark, inputs, tmp_path, monkeypatch):
    folder = str(tmp_path / "run")
    first = consolidate(spark, inputs, folder)
    written = []
    original = StageStore._write
    monkeypatch.setattr(
        StageStore, "_write", lambda self, name, *a: written.append(name) or original(self, name, *a)
    )
    again = consolidate(spark, inputs, folder, resume=True)
    assert written == []
    assert again.metrics["rows_accepted"] == first.metrics["rows_accepted"]
    assert again.consolidated.exceptAll(first.consolidated).count() == 0

    # A stage without its marker is run again, and so is what comes after it.
    (tmp_path / "run" / "markers" / "transform_rh" / "_SUCCESS").unlink()
    consolidate(spark, inputs, folder, resume=True)
    assert sorted(written) == ["merge", "transform_rh"]

    with pytest.raises(ResumeError, match="row_limit"):
        consolidate(spark, inputs, folder, resume=True, row_limit=2)
    written.clear()
    consolidate(spark, inputs, folder)
    assert len(written) == 7


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def bucketed(spark, inputs, tmp_path_factory):
    return consolidate(spark, inputs, str(tmp_path_factory.mktemp("bucketed")), buckets=4)


def test_buckets_change_no_result(run, bucketed):
    assert same_rows(bucketed.consolidated, run.consolidated)
    assert bucketed.consolidated.columns == run.consolidated.columns
    for name, accepted in run.accepted.items():
        assert same_rows(bucketed.accepted[name], accepted) and same_rows(bucketed.before_dedupe[name], run.before_dedupe[name])
    assert same_rows(bucketed.rejected, run.rejected) and same_rows(bucketed.duplicates, run.duplicates)
    assert same_rows(bucketed.report(), run.report())
    assert {**bucketed.metrics["rows_accepted"], "all": 4} == {**run.metrics["rows_accepted"], "all": bucketed.metrics["rows_consolidated"]}


def test_bucketed_stages_need_no_exchange_on_the_key(spark, run, bucketed):
    merged = merge_settled(bucketed.settled, bucketed.accepted, "_source", most_as="most")
    assert "Exchange" not in physical(merged) and "Exchange" in physical(merge_by_priority(list(run.accepted.values()), check_unique=False))
    counts = settled_counts(bucketed.settled, "_source", list(bucketed.accepted))
    assert "Exchange" not in physical(counts)
    assert "Exchange hashpartitioning" not in physical(duplicate_profile(bucketed.consolidated))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = bucketed.consolidated.join(bucketed.accepted["esocial"].select("cpf", F.col("id_evento").alias("own")), "cpf", "left")
        assert "Exchange" not in physical(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined.count() == 4


def test_a_bucket_is_one_file(tmp_path, spark, inputs):
    consolidate(spark, inputs, str(tmp_path / "run"), buckets=3)
    for kept in (tmp_path / "run" / "stages" / "transformed").glob("_source=*/_status=kept"):
        buckets = [f.name.split("_")[-1].split(".")[0] for f in kept.glob("*.parquet")]
        assert len(buckets) == len(set(buckets)) <= 3


def test_bucketed_run_is_resumed_without_its_catalog_entries(spark, inputs, tmp_path, monkeypatch):
    folder = str(tmp_path / "run")
    first = [tuple(r) for r in consolidate(spark, inputs, folder, buckets=4).consolidated.orderBy("cpf").collect()]
    for entry in spark.catalog.listTables("default"):
        if entry.name.startswith("recordweave_"):
            spark.sql(f"DROP TABLE {entry.name}")
    written, original = [], StageStore._write
    monkeypatch.setattr(StageStore, "_write", lambda self, name, *a: written.append(name) or original(self, name, *a))
    again = consolidate(spark, inputs, folder, resume=True, buckets=4)
    assert written == [] and [tuple(r) for r in again.consolidated.orderBy("cpf").collect()] == first
    (tmp_path / "run" / "markers" / "transform_gestao" / "_SUCCESS").unlink()
    again = consolidate(spark, inputs, folder, resume=True, buckets=4)
    assert sorted(written) == ["merge", "transform_gestao"]
    assert [tuple(r) for r in again.consolidated.orderBy("cpf").collect()] == first
    with pytest.raises(ResumeError, match="buckets"):
        consolidate(spark, inputs, folder, resume=True, buckets=5)


def test_buckets_take_empty_sources_and_refuse_two_types(spark, inputs, tmp_path):
    empty = {n: SourceInput(frame=read_delimited(spark, i.path).limit(0)) for n, i in inputs.items()}
    got = consolidate(spark, empty, str(tmp_path / "empty"), buckets=2)
    assert got.consolidated.count() == 0 and got.report().filter("metric = 'any_source'").first().value == 0
    frame = spark.createDataFrame([(K1, 7, 1)], "cpf string, nome int, n int")
    specs = [s for s in SOURCES if s.name != "gestao"] + [SourceSpec(name="gestao")]
    with pytest.raises(ValueError, match="nome is"):
        consolidate(spark, {**inputs, "gestao": SourceInput(frame=frame, order_by=("n",))}, str(tmp_path / "types"), specs=specs, buckets=2)


@pytest.mark.parametrize("buckets", [None, 4])
def test_only_changed_sources_are_prepared_again(spark, inputs, tmp_path, monkeypatch, buckets):
    folder = str(tmp_path / "run")
    frame = read_delimited(spark, inputs["gestao"].path)
    parts = [str(tmp_path / "before"), str(tmp_path / "after")]
    # the row of K1 that won goes, a new key comes
    frame.write.parquet(parts[0])
    late = frame.filter(F.col("nome") != "Ana G").unionByName(
        frame.filter(F.col("nome") == "Davi").withColumn("cpf", F.lit("11144477735")).withColumn("_row", F.col("_row") + 100)
    )
    late.write.parquet(parts[1])
    before, after = ({**inputs, "gestao": SourceInput(frame=spark.read.parquet(p))} for p in parts)
    consolidate(spark, before, folder, buckets=buckets)
    written, original = [], StageStore._write
    monkeypatch.setattr(StageStore, "_write", lambda self, name, *a: written.append(name) or original(self, name, *a))
    got = consolidate(spark, after, folder, only_changed=True, buckets=buckets)
    assert sorted(written) == ["extract_gestao", "merge", "transform_gestao"]
    whole = consolidate(spark, after, str(tmp_path / "whole"), buckets=buckets)
    assert same_rows(got.consolidated, whole.consolidated) and same_rows(got.report(), whole.report())
    assert got.consolidated.filter("cpf = '11144477735'").count() == 1
    # a cut change: the markers of what is written again are gone, so neither state is taken for the other
    def cut(self, name, *a):
        if name == "transform_gestao":
            raise RuntimeError("cut")
        return original(self, name, *a)

    monkeypatch.setattr(StageStore, "_write", cut)
    with pytest.raises(RuntimeError, match="cut"):
        consolidate(spark, before, folder, only_changed=True, buckets=buckets)
    monkeypatch.setattr(StageStore, "_write", original)
    back = consolidate(spark, after, folder, only_changed=True, buckets=buckets)
    assert same_rows(back.consolidated, whole.consolidated)


def test_changed_files_are_noticed(spark, inputs, tmp_path):
    copies = {}
    for name, given in inputs.items():
        place = tmp_path / f"{name}.csv"
        place.write_bytes(pathlib.Path(given.path).read_bytes())
        copies[name] = SourceInput(path=str(place))
    consolidate(spark, copies, str(tmp_path / "run"))
    text = (tmp_path / "rh.csv").read_text()
    (tmp_path / "rh.csv").write_text(text.replace("Ana de novo", "Ana outra vez"))
    with pytest.raises(ResumeError):
        consolidate(spark, copies, str(tmp_path / "run"), resume=True)
    got = consolidate(spark, copies, str(tmp_path / "run"), only_changed=True)
    assert got.duplicates.filter("nome = 'Ana outra vez'").count() == 1


def test_intermediate_tables_are_deleted(spark, inputs, tmp_path):
    scratch = pathlib.Path(checkpoint_root(spark).removeprefix("file:"))
    before = set(scratch.iterdir())
    run = consolidate(spark, inputs, str(tmp_path / "run"))
    load(spark, run, str(tmp_path / "model"))
    assert set(scratch.iterdir()) == before


def test_checkpoint_folder_comes_from_the_session():
    class Session:
        def __init__(self, **settings):
            self.conf = {k.replace("_", "."): v for k, v in settings.items()}

    assert checkpoint_root(Session(spark_checkpoint_dir="hdfs://x/y/")) == "hdfs://x/y"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session(spark_master="yarn"))
    local = checkpoint_root(Session(spark_master="local[2]"))
    assert local == checkpoint_root(Session(spark_master="local[2]"))


def test_clear(spark, inputs, tmp_path):
    folder = tmp_path / "run"
    consolidate(spark, inputs, str(folder))
    StageStore(spark, str(folder), {}, resume=True).clear()
    assert not (folder / "stages").exists() and not (folder / "markers").exists()


def test_export(spark, run, tmp_path):
    outputs = export(spark, run, str(tmp_path / "out"), sort_by_key=True)
    in_order = read_delimited(spark, outputs["pessoas_consolidado"]).orderBy("_file", "_block", "_row")
    assert [r.cpf for r in in_order.collect()] == [K1, K2, K3, K4]
    back = read_delimited(spark, outputs["pessoas_consolidado"], keep_order=False)
    assert back.count() == 4 and back.columns == list(CONSOLIDATED_COLUMNS)
    assert read_delimited(spark, outputs["duplicados"], keep_order=False).count() == 4
    manifest = read_record(spark, str(tmp_path / "out" / "manifest"))
    assert manifest.rows_consolidated == 4
    assert set(manifest.outputs.asDict()) == set(outputs)
    metrics = json.loads(read_record(spark, outputs["metrics"]).metrics)
    assert metrics["throughput_rows_per_sec"] > 0
    assert set(metrics["stage_seconds"]) == {
        *(f"{step}_{s}" for step in ("extract", "transform") for s in ("rh", "esocial", "gestao")),
        "merge",
    }


def test_export_without_rejects_keeps_headers(spark, run, tmp_path):
    empty = run.rejected.filter("false")
    from recordweave.sources.delimited import write_delimited

    write_delimited(empty, str(tmp_path / "empty"))
    assert read_delimited(spark, str(tmp_path / "empty"), keep_order=False).count() == 0


# --- relational load -------------------------------------------------------------------


@pytest.fixture
def target(tmp_path):
    return str(tmp_path / "model")


def load(spark, run, target, **options):
    options = {"on_violation": "quarantine", "check": False, **options}
    return load_model(spark, run.consolidated, run.accepted["esocial"], target, **options)


def test_full_load(spark, run, target, rows):
    result = load(spark, run, target, check=True)
    t = result.tables
    assert rows(t["pessoa"], "id", "cpf", "nome") == [(1, K1, "Ana"), (2, K2, "Bia"), (3, K4, "Davi")]
    assert rows(t["orgao"]) == [(1, "SEC A"), (2, "SEC B")]
    assert rows(t["vinculo"].select("pessoa_id", "orgao_id", "cargo_id", "tipo_vinculo_id", F.col("salario_base").cast("string"))) == [
        (1, 1, 1, 1, "1000.50"), (2, 1, 1, 1, None), (3, 2, 2, 3, "2000.00"),
    ]
    assert rows(t["avaliacao_desempenho"].select("pessoa_id", "ciclo_avaliacao", F.col("nota").cast("string"))) == [
        (1, "2023", "3.0"), (3, "2023", "4.5"),
    ]
    assert rows(t["evento"], "pessoa_id", "id_evento_origem", "tipo_evento_id") == [(1, "e2", 2)]
    assert rows(result.violations, "cpf", "violacao") == [(K3, "sigla_orgao")]
    assert rows(result.skipped_events, "cpf", SKIP_REASON) == [
        (K2, "tipo_evento_desconhecido"), (K3, "pessoa_desconhecida"),
    ]
    assert audit(RULES, t).filter("violations > 0").count() == 0
    assert current_version(spark, target) == 1
    rest = without_people(t, t["pessoa"].filter(F.col("cpf") == K1))
    assert rows(rest["pessoa"], "id") == [(2,), (3,)] and rest["evento"].count() == 0
    assert audit(RULES, rest).filter("violations > 0").count() == 0


def test_violations_stop_the_load(spark, run, target):
    with pytest.raises(DomainError, match="sigla_orgao"):
        load(spark, run, target, on_violation="fail")
    assert current_version(spark, target) == 0
    assert read_model(spark, target)["pessoa"].count() == 0


def contents(rows, tables, hidden=()):
    return {name: rows(table.drop(*hidden) if name == "vinculo" else table) for name, table in tables.items()}


def test_loading_twice_changes_nothing_but_employment_ids(spark, run, target, rows):
    first = contents(rows, load(spark, run, target).tables, ["id"])
    second = contents(rows, load(spark, run, target, incremental=True).tables, ["id"])
    assert second == first
    assert current_version(spark, target) == 2


def test_incremental_load_modes(spark, run, target, rows):
    load(spark, run, target)
    changed = (
        run.consolidated.filter(F.col("cpf") == K1)
        .withColumn("nome", F.lit("Outro nome"))
        .withColumn("cargo", F.lit("Diretor"))
        .withColumn("avaliacao_desempenho", F.lit(5.0))
    )
    t = load_model(spark, changed, None, target, incremental=True, check=False).tables
    assert rows(t["pessoa"], "id", "nome") == [(1, "Ana"), (2, "Bia"), (3, "Davi")]
    cargo = {r.nome: r.id for r in t["cargo"].collect()}
    assert cargo["Diretor"] == 3
    jobs = {r.pessoa_id: (r.cargo_id, r.id) for r in t["vinculo"].collect()}
    assert jobs[1] == (3, 4) and jobs[2][0] == 1
    scores = {r.pessoa_id: (r.id, str(r.nota)) for r in t["avaliacao_desempenho"].collect()}
    assert scores == {1: (1, "5.0"), 3: (2, "4.5")}
    assert t["evento"].count() == 1


def test_a_load_by_a_filter_of_event_ids_equals_one_without(spark, run, tmp_path, rows):
    known = [r.cpf for r in run.consolidated.select("cpf").collect()]
    make = lambda a, b: spark.range(a, b).select(
        F.lit(known[0]).alias("cpf"), F.lit("admissao").alias("tipo_evento"), F.format_string("id-%d", "id").alias("id_evento"),
        F.lit("2024-01-02").alias("data_evento"), F.format_string("%04d", "id").alias("numero_recibo"),
    )
    plain, kept = str(tmp_path / "plain"), str(tmp_path / "kept")
    # The third load goes without the filter and the fourth without events; the fifth finds the filter behind the table.
    batches = [(make(0, 60), True), (make(30, 90), True), (make(80, 120), False), (None, True), (make(100, 130), True)]
    for number, (batch, filtered) in enumerate(batches):
        options = {"incremental": number > 0, "on_violation": "quarantine", "check": False, "event_order": ("numero_recibo",), "buckets": 4}
        a = load_model(spark, run.consolidated, batch, plain, **options)
        b = load_model(spark, run.consolidated, batch, kept, event_filter=filtered, **options)
        assert rows(a.tables["evento"]) == rows(b.tables["evento"])
    assert b.tables["evento"].count() == 130


def test_an_incremental_load_writes_what_comes_in(spark, run, target, rows):
    before = {name: table.count() for name, table in load(spark, run, target).tables.items()}
    one = run.consolidated.filter(F.col("cpf") == K4).withColumn("avaliacao_desempenho", F.lit(2.0))
    result = load_model(spark, one, None, target, incremental=True)
    written = {name: result.counts[name]["rows"] for name in ("orgao", "cargo", "pessoa", "vinculo", "avaliacao_desempenho", "evento")}
    assert written == {"orgao": 0, "cargo": 0, "pessoa": 0, "vinculo": 1, "avaliacao_desempenho": 1, "evento": 0}
    assert {n: t.count() for n, t in result.tables.items()} == before
    assert audit(RULES, result.tables).filter("violations > 0").count() == 0
    scores = {r.pessoa_id: str(r.nota) for r in result.tables["avaliacao_desempenho"].collect()}
    assert scores == {1: "3.0", 3: "2.0"}


def files_of(target, name):
    """Data files of a table by bucket, with their times."""
    found = sorted(Path(f"{target}/v1/stages/{name}").glob("_bucket=*/*.parquet"))
    return {(f.parent.name, f.name): f.stat().st_mtime_ns for f in found}


def test_untouched_buckets_keep_their_files(spark, run, target, rows):
    load(spark, run, target, buckets=64)
    before = {name: files_of(target, name) for name in KEYS}
    one = run.consolidated.filter(F.col("cpf") == K4).withColumn("avaliacao_desempenho", F.lit(2.0))
    result = load_model(spark, one, None, target, incremental=True, buckets=7)
    after = {name: files_of(target, name) for name in KEYS}
    changed = {name for name in KEYS if before[name] != after[name]}
    assert changed == {"vinculo", "avaliacao_desempenho"}
    for name in changed:
        other = {b for b, _ in before[name].keys() ^ after[name].keys()}
        assert len(other) == 1 and result.counts[name]["buckets_written"] == 1
    assert read_state(spark, target).buckets == 64  # a model keeps its buckets


def test_a_load_reads_only_the_buckets_it_touches(spark, run, target):
    load(spark, run, target, buckets=64)
    state = read_state(spark, target)
    near = read_model(spark, target, {"pessoa": touched(run.consolidated.filter(F.col("cpf") == K4), ["cpf"], state.buckets)})
    assert [r.cpf for r in near["pessoa"].collect()] == [K4]
    plan = near["pessoa"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [_bucket" in plan


def test_old_folders_are_removed(spark, run, target, rows):
    for again in (False, True, True):
        result = load(spark, run, target, incremental=again)
    before = contents(rows, result.tables)
    assert drop_versions(spark, target) == [2, 3]
    assert drop_versions(spark, target) == []
    assert contents(rows, read_model(spark, target)) == before
    load(spark, run, target)
    assert drop_versions(spark, target) == [1]


def changed_rows(run):
    return run.consolidated.withColumns({"nome": F.concat("nome", F.lit(" X")), "avaliacao_desempenho": F.lit(1.5)})


def test_a_load_cut_while_it_rewrites_buckets_goes_on(spark, run, target, tmp_path, rows, monkeypatch):
    whole, options = str(tmp_path / "whole"), {"on_violation": "quarantine", "incremental": True, "batches": 4}
    for folder in (target, whole):
        load(spark, run, folder, buckets=8)
    events = run.accepted["esocial"]
    want = contents(rows, load_model(spark, changed_rows(run), events, whole, **options).tables)
    original, calls = relational.write_buckets, []

    def broken(df, path, log, wanted, batches):
        calls.append(path)
        if path.endswith("avaliacao_desempenho"):
            raise RuntimeError("lost")
        return original(df, path, log, wanted, batches)

    monkeypatch.setattr(relational, "write_buckets", broken)
    with pytest.raises(RuntimeError, match="lost"):
        load_model(spark, changed_rows(run), events, target, **options)
    monkeypatch.setattr(relational, "write_buckets", original)
    assert current_version(spark, target) == 1
    with pytest.raises(ResumeError, match="resume it first"):
        load_model(spark, changed_rows(run), events, target, **options)
    result = load_model(spark, changed_rows(run), events, target, resume=True, **options)
    assert contents(rows, result.tables) == want
    assert result.counts["vinculo"]["buckets_written"] == 0 < result.counts["vinculo"]["buckets_reused"]
    assert result.counts["avaliacao_desempenho"]["buckets_reused"] == 0
    assert audit(RULES, result.tables).filter("violations > 0").count() == 0


def test_a_stage_goes_on_with_its_missing_buckets(spark, run, target, rows):
    want = contents(rows, load(spark, run, target, buckets=8).tables)
    lost = present(spark, f"{target}/v1/stages/pessoa")[0]
    (log,) = Path(f"{target}/v1/commits/pessoa").iterdir()
    for path in (f"{target}/current", f"{target}/v1/markers/pessoa", f"{log}/{lost}", f"{target}/v1/stages/pessoa/_bucket={lost}"):
        delete_folder(spark, path)
    before = files_of(target, "pessoa")
    result = load(spark, run, target, buckets=8, resume=True)
    assert contents(rows, result.tables) == want
    assert result.counts["pessoa"] == {"rows": 3, "highest": 3, "buckets_reused": 7}
    assert before.items() <= files_of(target, "pessoa").items()


def test_records_of_other_settings_are_not_taken(spark, tmp_path):
    frame = spark.range(100).selectExpr("id", "id % 7 as k")
    for salt, reused in ((1, 0), (2, 0)):
        store = StageStore(spark, str(tmp_path / "s"), {"salt": salt}, resume=True)
        delete_folder(spark, str(tmp_path / "s" / "markers"))
        stage = store.run("t", lambda: frame, {"rows": F.count(F.lit(1))}, buckets=Buckets(("k",), 4, 2))
        assert stage.counts == {"rows": 100, "buckets_reused": reused} and stage.table.count() == 100


def test_full_load_forgets_earlier_rows(spark, run, target, rows):
    load(spark, run, target)
    only = run.consolidated.filter(F.col("cpf") == K4)
    t = load_model(spark, only, None, target, check=False).tables
    assert rows(t["pessoa"], "id", "cpf") == [(1, K4)]
    assert t["evento"].count() == 0 and t["tipo_vinculo"].count() == 3


def test_load_row_limit_restricts_events(spark, run, target):
    result = load(spark, run, target, row_limit=1)
    assert result.tables["pessoa"].count() == 1
    assert result.counts["eventos_resolvidos"]["rows"] == 1


def test_repeated_persons_first_row_makes_the_person_last_the_employment(spark, run, target, rows):
    ana = run.consolidated.filter(F.col("cpf") == K1)
    both = ana.withColumn("n", F.lit(1)).unionByName(
        ana.withColumn("n", F.lit(2)).withColumn("nome", F.lit("B")).withColumn("cargo", F.lit("Z"))
    )
    t = load_model(spark, both, None, target, row_order=("n",), check=False).tables
    assert rows(t["pessoa"], "nome") == [("Ana",)]
    jobs = t["vinculo"].join(t["cargo"].select(F.col("id").alias("cargo_id"), "nome"), "cargo_id")
    assert rows(jobs, "nome") == [("Z",)]


def test_tied_order_is_refused(spark, inputs, tmp_path):
    frame = spark.createDataFrame([(K1, "Ana", 1), (K1, "Bia", 1)], "cpf string, nome string, n int")
    given = {**inputs, "gestao": SourceInput(frame=frame, order_by=("n",))}
    spec = [s for s in SOURCES if s.name != "gestao"] + [SourceSpec(name="gestao")]
    with pytest.raises(DuplicateKeyError):
        consolidate(spark, given, str(tmp_path / "tied"), specs=spec)
    with pytest.raises(DuplicateKeyError):
        consolidate(spark, given, str(tmp_path / "tied"), specs=spec, resume=True)


def test_resume_refuses_other_settings(spark, inputs, tmp_path):
    from dataclasses import replace

    folder = str(tmp_path / "settings")
    consolidate(spark, inputs, folder)
    for change in (
        {"specs": SOURCES[::-1]},
        {"specs": [replace(s, date_columns=()) for s in SOURCES]},
        {"specs": [replace(s, latest_by=None) for s in SOURCES]},
        {"inputs": {**inputs, "rh": replace(inputs["rh"], mode="PERMISSIVE")}},
        {"inputs": {**inputs, "rh": replace(inputs["rh"], multi_line=True)}},
        {"check_digits": True},
        {"row_limit": 1},
    ):
        options = {"inputs": inputs, **change}
        with pytest.raises(ResumeError):
            consolidate(spark, options.pop("inputs"), folder, resume=True, **options)


def test_values_the_target_cannot_hold_are_recorded(spark, run, target, rows):
    wide = run.consolidated.withColumn("salario_base", F.when(F.col("cpf") == K1, 1e13).otherwise(F.col("salario_base")))
    wide = wide.withColumn("avaliacao_desempenho", F.when(F.col("cpf") == K4, 1234.5).otherwise(F.col("avaliacao_desempenho")))
    result = load_model(spark, wide, None, target, on_violation="quarantine", check=False)
    assert rows(result.violations, "cpf", "violacao") == [(K1, "salario_base"), (K3, "sigla_orgao"), (K4, "avaliacao_desempenho")]
    with pytest.raises(DomainError):
        load_model(spark, wide, None, target, check=False)


def test_long_event_ids_are_skipped_with_a_reason(spark, run, target, rows):
    events = run.accepted["esocial"].filter(F.col("cpf") == K1)
    twins = reduce(lambda a, b: a.unionByName(b), [events.withColumn("id_evento", F.lit("x" * 128 + end)) for end in ("a", "b")])
    result = load_model(spark, run.consolidated, twins, target, on_violation="quarantine", check=False, event_order=("id_evento",))
    assert rows(result.skipped_events, SKIP_REASON) == [("id_evento_longo",)] * 2


def test_interrupted_load_resumes(spark, run, target, monkeypatch):
    original = StageStore._write

    def broken(self, name, *rest):
        if name == "evento":
            raise RuntimeError("lost")
        return original(self, name, *rest)

    monkeypatch.setattr(StageStore, "_write", broken)
    with pytest.raises(RuntimeError, match="lost"):
        load(spark, run, target)
    assert current_version(spark, target) == 0
    written = []
    monkeypatch.setattr(
        StageStore, "_write", lambda self, name, *a: written.append(name) or original(self, name, *a)
    )
    result = load(spark, run, target, resume=True)
    assert written == ["evento"]
    assert result.tables["evento"].count() == 1
    assert current_version(spark, target) == 1


# --- a report kept over loads ------------------------------------------------------------


def test_a_kept_report_equals_one_over_all_rows(spark, tmp_path, rows):
    make = lambda keys: spark.createDataFrame([(k,) for k in keys], "k string")
    batches = [
        {"a": make(["1", "1", "2", None]), "b": make(["2", "9"])},
        {"a": make(["1", "7"]), "b": make([None, None])},
        {"b": make(["5"])},
    ]
    store = ProfileStore(spark, str(tmp_path / "kept"), ["a", "b"], buckets=8)
    for number, frames in enumerate(batches, 1):
        store.add(number, frames, "k", batches=2)
    whole = {
        name: reduce(lambda x, y: x.unionByName(y), [b[name] for b in batches if name in b]) for name in ("a", "b")
    }
    want = rows(duplicate_report(whole, key="k"))
    assert rows(store.report()) == want
    # The last batch again: once with its records, once as if it was cut right before they were written.
    assert store.add(3, batches[2], "k").written == ()
    delete_folder(spark, str(tmp_path / "kept" / "batches" / "3"))
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "kept" / "counts").glob("_bucket=*/*.parquet")}
    assert len(store.add(3, batches[2], "k").written) == 1
    assert rows(store.report()) == want
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "kept" / "counts").glob("_bucket=*/*.parquet")}
    assert len({f.parent for f in before.keys() ^ after.keys()}) == 1  # the other buckets keep their files
    with pytest.raises(ValueError, match="unknown frames"):
        store.add(4, {"c": batches[0]["a"]}, "k")


def test_reference_counts_follow_every_change(spark, tmp_path, rows):
    make = lambda keys: spark.createDataFrame([(k,) for k in keys], "k long")
    store = ReferenceCounts(spark, str(tmp_path / "references"), ["job", "event"], buckets=32)
    store.change(1, {"job": (make([1, 2, 2, None]), "k"), "event": (make([1, 1, 5]), "k")})
    parents = make([1, 2])
    assert rows(store.orphans(parents, "k")) == [("event", 1), ("job", 0)]
    assert rows(store.referring(make([2, 2, 7, None]), "k")) == [("event", 0), ("job", 2)]
    store.change(2, {"job": (make([3]), "k")}, {"job": (make([2]), "k"), "event": (make([5]), "k")})
    store.change(2, {"job": (make([3]), "k")}, {"job": (make([2]), "k"), "event": (make([5]), "k")})
    assert rows(store.orphans(parents, "k")) == [("event", 0), ("job", 1)]
    assert rows(store.orphans(make([2]), "k")) == [("event", 2), ("job", 2)]
    near = store.counts(touched(make([2]).select(F.col("k").cast("string")), ["k"], 32))
    assert near.select(F.input_file_name()).distinct().count() == 1 < store.counts().select(F.input_file_name()).distinct().count()
    assert rows(store.referring(make([]), "k")) == [("event", 0), ("job", 0)]


def test_a_stage_table_of_one_task_is_read_by_several(spark, tmp_path, monkeypatch):
    from recordweave.plans import stages

    monkeypatch.setattr(stages, "ROW_GROUP_BYTES", 64 * 1024)
    df = spark.range(40_000, numPartitions=1).select(F.sha2(F.col("id").cast("string"), 256).alias("cpf"))
    StageStore(spark, str(tmp_path), {}).run("wide", lambda: df, {"rows": F.count(F.lit(1))})
    (written,) = (tmp_path / "stages" / "wide").glob("*.parquet")
    assert pq.ParquetFile(written).num_row_groups > 1


def test_wide_rows_are_not_sorted_for_a_join_with_small_partitions(spark, inputs, tmp_path, monkeypatch):
    from recordweave.plans import consolidate as job

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    key, plans = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", []
    before = spark.conf.get(key)

    def watched(frames, **options):
        left, right = (spark.range(500).select(F.col("id").alias("k"), F.lit(i).alias(f"v{i}")) for i in range(2))
        joined = left.join(right, "k")
        assert joined.count() == 500
        joined.collect()
        plans.append(joined._jdf.queryExecution().toString())
        return merge_by_priority(frames, **options)

    monkeypatch.setattr(job, "merge_by_priority", watched)
    try:
        consolidate(spark, inputs, str(tmp_path / "run"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plans[0].partition("Initial Plan")[0]
    assert spark.conf.get(key) == before


def test_settings_of_a_job_end_with_it(spark, tmp_path):
    from recordweave.plans.stages import WIDE_ROWS

    before = {name: spark.conf.get(name) for name in WIDE_ROWS}
    with pytest.raises(KeyError):
        consolidate(spark, {}, str(tmp_path / "run"))
    assert {name: spark.conf.get(name) for name in WIDE_ROWS} == before

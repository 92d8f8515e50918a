"""What each source must look like, and the canonical names and order of its columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

KEY = "cpf"

# Audit reasons for rows dropped by a dedupe.
KEPT_FIRST_ROW = "cpf_duplicado_mantida_primeira_linha"
KEPT_LATEST_EVENT = "evento_descartado_mantido_data_evento_mais_recente"


@dataclass(frozen=True)
class SourceSpec:
    """Contract and treatment of one source; the order of a list of specs is the priority."""

    name: str
    exact_columns: tuple[str, ...] | None = None
    renames: Mapping[str, str] = field(default_factory=dict)
    date_columns: tuple[str, ...] = ()
    number_columns: tuple[str, ...] = ()
    code_columns: tuple[str, ...] = ()
    latest_by: str | None = None

    @property
    def discard_reason(self) -> str:
        return KEPT_LATEST_EVENT if self.latest_by else KEPT_FIRST_ROW


# The three source contracts.
RH = SourceSpec(
    name="rh",
    exact_columns=(
        "nome", "cpf", "data_nascimento", "sigla_orgao", "data_admissao", "data_saida",
        "matricula", "cargo", "tipo_vinculo", "salario_base", "lotacao", "status_servidor",
    ),
    date_columns=("data_nascimento", "data_admissao", "data_saida"),
    number_columns=("salario_base",),
)
ESOCIAL = SourceSpec(
    name="esocial",
    exact_columns=(
        "nome", "cpf", "data_nascimento", "sigla_orgao", "id_evento", "tipo_evento",
        "data_evento", "codigo_categoria", "indicador_retificacao", "numero_recibo",
    ),
    date_columns=("data_nascimento", "data_evento"),
    code_columns=("codigo_categoria",),
    latest_by="data_evento",
)
GESTAO = SourceSpec(
    name="gestao",
    renames={
        "dataNascimento": "data_nascimento",
        "orgao": "sigla_orgao",
        "dataEntrada": "data_admissao",
        "dataSaida": "data_saida",
        "tipoVinculo": "tipo_vinculo",
        "salario": "salario_base",
        "unidadeLotacao": "lotacao",
        "status": "status_servidor",
        "estadoCivil": "estado_civil",
        "avaliacaoDesempenho": "avaliacao_desempenho",
        "cicloAvaliacao": "ciclo_avaliacao",
    },
    date_columns=("data_nascimento", "data_admissao", "data_saida"),
    number_columns=("salario_base", "avaliacao_desempenho"),
)
SOURCES = (RH, ESOCIAL, GESTAO)

# Leading columns of the consolidated table; others follow by name.
CONSOLIDATED_COLUMNS = (
    "cpf", "nome", "data_nascimento", "sigla_orgao", "data_admissao", "data_saida",
    "matricula", "cargo", "tipo_vinculo", "salario_base", "lotacao", "status_servidor",
    "sexo", "estado_civil", "cor", "nacionalidade", "email", "telefone",
    "avaliacao_desempenho", "ciclo_avaliacao", "id_evento", "tipo_evento", "data_evento",
    "codigo_categoria", "indicador_retificacao", "numero_recibo",
)


class ContractError(ValueError):
    """The columns of a source break its contract."""


def check_exact_columns(columns: Iterable[str], expected: Iterable[str], source: str) -> None:
    """Same set of names, in any order."""
    have, want = set(columns), set(expected)
    if have != want:
        raise ContractError(
            f"{source}: missing columns {sorted(want - have)}, extra columns {sorted(have - want)}"
        )


def check_canonical_names(columns: Iterable[str], source: str) -> None:
    """Lower case, no space, no hyphen."""
    bad = [c for c in columns if c != c.lower() or " " in c or "-" in c]
    if bad:
        raise ContractError(f"{source}: not snake_case {bad}")


def to_canonical(df: DataFrame, spec: SourceSpec, carried: Sequence[str] = ()) -> DataFrame:
    """Check the contract and rename to canonical names.

    ``carried`` names bookkeeping columns (row order) that are not part of the
    contract and pass through.  Fails before any job is started.
    """
    given = [c for c in df.columns if c not in carried]
    if spec.exact_columns is not None:
        check_exact_columns(given, spec.exact_columns, spec.name)
    absent = sorted(set(spec.renames) - set(given))
    if absent:
        raise ContractError(f"{spec.name}: missing columns {absent}")
    check_canonical_names([spec.renames.get(c, c) for c in given], spec.name)
    return df.withColumnsRenamed(dict(spec.renames))


def consolidated_order(columns: Iterable[str]) -> list[str]:
    present = set(columns)
    leading = [c for c in CONSOLIDATED_COLUMNS if c in present]
    return leading + sorted(present.difference(leading))

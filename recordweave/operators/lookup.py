"""Catalog lookups, domain checks and event eligibility."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordweave.functions.dates import parse_load_date
from recordweave.functions.keys import normalize_key
from recordweave.functions.text import is_missing

BROADCAST_BYTES = 32 * 1024 * 1024
VIOLATION = "violacao"
SKIP_REASON = "motivo_descarte"


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when the measured size is under ``limit``.

    Counts the rows and the bytes of their text, with room for fixed-width
    columns; binary values count as their bytes, structs, arrays and maps as twice the text they are shown as.  A larger table is returned without a hint: the join then shuffles
    and adaptive execution splits its skewed partitions.
    """
    width = F.lit(16 * len(df.columns))
    for name, kind in df.dtypes:
        value = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(value), F.lit(0))
        elif kind.startswith(("struct", "array", "map")):
            # numbers inside may be wider than their digits
            width = width + 2 * F.coalesce(F.octet_length(value.cast("string")), F.lit(0))
    size = df.agg(F.sum(width.cast("bigint"))).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


@dataclass(frozen=True)
class Catalog:
    """A code table, the column that refers to it and the id column to add."""

    table: DataFrame
    code: str
    refers: str
    id_as: str


def attach_ids(df: DataFrame, catalogs: Sequence[Catalog]) -> DataFrame:
    """Left-join the id of every code; NULL where the catalog lacks it."""
    out = df
    for c in catalogs:
        codes = c.table.select(F.col(c.code).alias(c.refers), F.col("id").alias(c.id_as))
        out = out.join(broadcast_if_small(codes), c.refers, "left")
    return out.select(
        *[F.col(f"`{name}`") for name in df.columns], *[F.col(c.id_as) for c in catalogs]
    )


class Checked(NamedTuple):
    ok: DataFrame
    violations: DataFrame


def mark_violations(df: DataFrame, catalogs: Sequence[Catalog], limits: Mapping[str, Column] | None = None) -> DataFrame:
    """All rows with the ids of their codes and the first bad column, NULL if none is.

    A column is bad if a catalog lacks its code, or if its entry of ``limits`` holds: a value the target can't take.
    """
    bad = [F.when(F.col(c.id_as).isNull(), F.lit(c.refers)) for c in catalogs]
    bad += [F.when(condition, F.lit(column)) for column, condition in (limits or {}).items()]
    return attach_ids(df, catalogs).withColumn(VIOLATION, F.coalesce(*bad))


def split_checked(marked: DataFrame, catalogs: Sequence[Catalog]) -> Checked:
    """The good rows with ids, and the others with the first bad column."""
    ids = [c.id_as for c in catalogs]
    return Checked(
        marked.filter(F.col(VIOLATION).isNull()).drop(VIOLATION),
        marked.filter(F.col(VIOLATION).isNotNull()).drop(*ids),
    )


def check_domains(df: DataFrame, catalogs: Sequence[Catalog], limits: Mapping[str, Column] | None = None) -> Checked:
    """Rows whose codes are all in their catalogs, with ids; the others with the first bad column."""
    return split_checked(mark_violations(df, catalogs, limits), catalogs)


class DomainError(ValueError):
    """Rows refer to codes that no catalog has, or hold values the target can't take."""


def require_no_violations(violations: DataFrame, key: str, refers: Sequence[str]) -> None:
    bad = violations.take(5)
    if bad:
        shown = "; ".join(f"{r[key]}: {r[VIOLATION]}={r[r[VIOLATION]]!r}" for r in bad)
        raise DomainError(f"values outside the catalogs or limits of {list(refers)} ({shown})")


# Reasons an event is not loaded, in the order they are checked.
EVENT_SKIPS: Mapping[str, str] = {
    "key": "chave_invalida",
    "person": "pessoa_desconhecida",
    "type": "tipo_evento_desconhecido",
    "id": "id_evento_ausente",
    "long_id": "id_evento_longo",
    "date": "data_evento_ausente",
    "bad_date": "data_evento_invalida",
}


EVENT_ID_LENGTH = 128


def resolve_events(events: DataFrame, people: DataFrame, types: DataFrame) -> DataFrame:
    """Every event with person id, type id, date, and why it cannot be loaded (NULL if it can).

    ``people`` has (id, cpf), ``types`` (id, codigo).  People are many and one
    person may hold many events, so that join is left to adaptive execution,
    which splits skewed partitions of the event side.
    """
    out = events.columns
    keyed = events.withColumn("_key", normalize_key(F.col("cpf")))
    # Events without a usable key are spread by a text no key equals, instead of all meeting as NULL.
    spread = F.concat(F.lit("?"), F.xxhash64(*[F.col(f"`{c}`") for c in out]).cast("string"))
    keyed = keyed.withColumn("_joined", F.coalesce("_key", spread))
    known = people.select(F.col("cpf").alias("_joined"), F.col("id").alias("pessoa_id"))
    codes = types.select(F.col("codigo").alias("tipo_evento"), F.col("id").alias("tipo_evento_id"))
    given = F.col("data_evento")
    as_text = dict(events.dtypes)["data_evento"] == "string"
    date = parse_load_date(given) if as_text else given.cast("date")
    no_date = is_missing(given) if as_text else given.isNull()
    reason = (
        F.when(F.col("_key").isNull(), F.lit(EVENT_SKIPS["key"]))
        .when(F.col("pessoa_id").isNull(), F.lit(EVENT_SKIPS["person"]))
        .when(F.col("tipo_evento_id").isNull(), F.lit(EVENT_SKIPS["type"]))
        .when(is_missing(F.col("id_evento")), F.lit(EVENT_SKIPS["id"]))
        .when(F.length(F.col("id_evento").cast("string")) > EVENT_ID_LENGTH, F.lit(EVENT_SKIPS["long_id"]))
        .when(no_date, F.lit(EVENT_SKIPS["date"]))
        .when(date.isNull(), F.lit(EVENT_SKIPS["bad_date"]))
    )
    return (
        keyed.join(broadcast_if_small(codes), "tipo_evento", "left")
        .join(known, "_joined", "left")
        .select(
            *[F.col(f"`{c}`") for c in out],
            "pessoa_id",
            "tipo_evento_id",
            date.alias("_date"),
            reason.alias(SKIP_REASON),
        )
    )

"""From raw sources to the consolidated table, with audits, profile and metrics."""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from recordweave.operators.dedupe import KEPT, mark_kept
from recordweave.operators.merge import merge_by_priority, merge_settled, refuse_repeats, union_audit
from recordweave.operators.profile import duplicate_report, report_with_discarded
from recordweave.operators.quarantine import REJECT_REASON, split_rejected, with_reason
from recordweave.operators.sampling import head_n
from recordweave.operators.standardise import (
    ORIGINAL_KEY,
    UNREADABLE_DATES,
    UNREADABLE_NUMBERS,
    annotate_duplicates,
    standardise,
)
from recordweave.plans.clustered import Clustered, clustered_table, common_columns
from recordweave.plans.stages import (
    OPEN_FOLDERS,
    WIDE_ROWS,
    StageStore,
    describe_files,
    describe_frame,
    session_settings,
    side_by_side,
    under,
)
from recordweave.sources.contracts import KEY, SOURCES, SourceSpec, to_canonical
from recordweave.sources.delimited import FILE_ORDER, read_delimited, write_delimited
from recordweave.sources.tables import write_record

STATUS, MOST, FROM = "_status", "_most", "_source"
#: Folder of the transformed sources when they are one table in buckets.
SETTLED = "transformed"
KEPT_ROW, DISCARDED_ROW, REJECTED_ROW = "kept", "discarded", "rejected"


@dataclass(frozen=True)
class SourceInput:
    """Rows of one source: delimited files, or a frame with its row order.

    ``order_by`` ends in a unique column. Columns outside the contract, for open
    contracts those starting with an underscore, are only used for the order.
    """

    path: str | Sequence[str] | None = None
    frame: DataFrame | None = None
    order_by: tuple[str, ...] = FILE_ORDER
    multi_line: bool = False
    mode: str = "FAILFAST"

    def read(self, spark: SparkSession) -> DataFrame:
        if self.frame is not None:
            return self.frame
        return read_delimited(spark, self.path, KEY, self.multi_line, self.mode)

    def describe(self, spark: SparkSession) -> dict[str, object]:
        """Everything about the input that can change a result."""
        given = describe_files(spark, self.path) if self.frame is None else describe_frame(self.frame)
        return {"given": given, "order_by": self.order_by, "multi_line": self.multi_line, "mode": self.mode}


@dataclass(frozen=True)
class Consolidation:
    consolidated: DataFrame
    accepted: Mapping[str, DataFrame]
    before_dedupe: Mapping[str, DataFrame]
    rejected: DataFrame
    duplicates: DataFrame
    metrics: Mapping[str, object]
    #: The accepted rows of all sources as one table in buckets of the key; only of runs in buckets.
    settled: DataFrame | None = None

    def report(self) -> DataFrame:
        """The duplicate report of this run."""
        if self.settled is not None:
            return report_with_discarded(self.settled, FROM, list(self.accepted), self.duplicates, "fonte", self.consolidated, KEY)
        return duplicate_report(self.accepted, self.before_dedupe, self.consolidated)


def extract(
    spark: SparkSession, spec: SourceSpec, given: SourceInput, row_limit: int | None = None
) -> DataFrame:
    """One source under canonical names, optionally only its first rows."""
    raw = given.read(spark)
    carried = _carried(spec, given)
    limited = raw if row_limit is None else head_n(raw, given.order_by, row_limit)
    return to_canonical(limited, spec, carried)


def transform(
    raw: DataFrame,
    spec: SourceSpec,
    order_by: Sequence[str],
    carried: Sequence[str],
    reason_on_original: bool = True,
    check_digits: bool = False,
) -> DataFrame:
    """Standardised rows of one source with reject reason and status: kept, discarded or rejected."""
    reasoned = with_reason(
        standardise(raw, spec, carried),
        KEY,
        ORIGINAL_KEY if reason_on_original else None,
        check_digits,
    )
    # Rejected rows never compete: most share a NULL key.
    marked = mark_kept(
        reasoned, [KEY], order_by, spec.latest_by, eligible=F.col(REJECT_REASON).isNull()
    )
    status = (
        F.when(F.col(REJECT_REASON).isNotNull(), F.lit(REJECTED_ROW))
        .when(F.col(KEPT), F.lit(KEPT_ROW))
        .otherwise(F.lit(DISCARDED_ROW))
    )
    return marked.withColumn(STATUS, status).drop(KEPT)


@under(WIDE_ROWS)
def consolidate(
    spark: SparkSession,
    inputs: Mapping[str, SourceInput],
    run_folder: str,
    specs: Sequence[SourceSpec] = SOURCES,
    row_limit: int | None = None,
    resume: bool = False,
    reason_on_original: bool = True,
    check_digits: bool = False,
    only_changed: bool = False,
    buckets: int | None = None,
) -> Consolidation:
    """Extract, transform and merge all sources; the order of ``specs`` is the priority.

    Every stage is written under ``run_folder`` and can be resumed.  A resumed
    run must use the same settings.  With ``only_changed`` the run takes over an earlier one whose inputs or settings
    may differ: sources that did not change are kept, the others are extracted and transformed again, and all are merged.

    With ``buckets`` the transformed sources are one table, and the result another, in so many buckets of the key.
    Accepted rows are shuffled once, when they are transformed; the merge, the coverage and joins of accepted and consolidated rows by
    key then need no shuffle, nor does a merge after a source changed.  Columns of one name need one type.
    """
    started = time.perf_counter()
    common = {"row_limit": row_limit, "reason_on_original": reason_on_original, "check_digits": check_digits}
    if buckets:
        common["buckets"] = buckets
    described = {s.name: {"spec": asdict(s), "input": inputs[s.name].describe(spark)} for s in specs}
    # a list: the order of the sources is their priority
    settings = {**common, "sources": [described[s.name] for s in specs]}
    store = StageStore(spark, run_folder, settings, resume or only_changed, only_changed)
    rows = F.count(F.lit(1))
    layout = Clustered(KEY, buckets) if buckets else None

    status = F.col(STATUS)

    def prepare(spec: SourceSpec) -> DataFrame:
        given = inputs[spec.name]
        carried = _carried(spec, given)
        own = {**common, "source": described[spec.name]}
        order = [spec.renames.get(c, c) for c in given.order_by]
        raw = store.run(
            f"extract_{spec.name}", lambda: extract(spark, spec, given, row_limit), {"rows": rows}, settings=own,
        ).table

        def transformed() -> DataFrame:
            df = transform(raw, spec, order, carried, reason_on_original, check_digits)
            return layout.deal(df, status == KEPT_ROW) if layout else df

        return store.run(
            f"transform_{spec.name}",
            transformed,
            {
                KEPT_ROW: F.count_if(status == KEPT_ROW),
                DISCARDED_ROW: F.count_if(status == DISCARDED_ROW),
                REJECTED_ROW: F.count_if(status == REJECTED_ROW),
                "unreadable_dates": F.coalesce(F.sum(UNREADABLE_DATES), F.lit(0)),
                "unreadable_numbers": F.coalesce(F.sum(UNREADABLE_NUMBERS), F.lit(0)),
            },
            split_by=STATUS,
            after=[f"extract_{spec.name}"],
            clustered=layout,
            place=f"{SETTLED}/{FROM}={spec.name}" if layout else None,
            settings=own,
        ).table

    with session_settings(spark, OPEN_FOLDERS):
        tables = side_by_side(spark, [partial(prepare, spec) for spec in specs])
    transformed = {spec.name: table for spec, table in zip(specs, tables, strict=True)}

    accepted, before, rejected, duplicates = {}, {}, [], []
    for spec in specs:
        table = transformed[spec.name]
        hidden = [*_carried(spec, inputs[spec.name]), UNREADABLE_DATES, UNREADABLE_NUMBERS, STATUS]
        clean = [*hidden, ORIGINAL_KEY, REJECT_REASON]
        accepted[spec.name] = table.filter(status == KEPT_ROW).drop(*clean)
        before[spec.name] = table.filter(status != REJECTED_ROW).drop(*clean)
        rejected.append(
            split_rejected(table.filter(status == REJECTED_ROW).drop(*hidden), spec.name).rejected
        )
        dropped = table.filter(status == DISCARDED_ROW).drop(*clean)
        duplicates.append(annotate_duplicates(dropped, spec.name, spec.discard_reason))

    settled = None
    if layout:
        columns = {**common_columns(list(accepted.values())), FROM: StringType(), STATUS: StringType()}
        table = clustered_table(spark, store.path(SETTLED), columns, layout, [FROM, STATUS])
        settled = table.filter((status == KEPT_ROW) & F.col(FROM).isin(*accepted)).drop(STATUS)
        accepted = {
            name: settled.filter(F.col(FROM) == name).select(*[F.col(f"`{c}`") for c in df.columns]) for name, df in accepted.items()
        }

    def merge() -> DataFrame:
        if settled is not None:
            return merge_settled(settled, accepted, FROM, most_as=MOST)
        return merge_by_priority(list(accepted.values()), check_unique=False, most_as=MOST)

    merged = store.run(
        "merge",
        merge,
        {"rows": rows, "most": F.max(MOST)},
        after=[f"transform_{spec.name}" for spec in specs],
        hidden=[MOST],
        # Two rows of a key are left only where the order column ties.
        check=lambda counts: refuse_repeats(counts["most"]),
        clustered=layout,
    )
    return Consolidation(
        merged.table,
        accepted,
        before,
        union_audit(rejected),
        union_audit(duplicates),
        _metrics(store, specs, time.perf_counter() - started),
        settled,
    )


def _carried(spec: SourceSpec, given: SourceInput) -> list[str]:
    """Order columns that are not columns of the source itself."""
    if given.frame is None:
        return list(FILE_ORDER)
    contract = spec.exact_columns
    if contract is None:
        return [c for c in given.order_by if c.startswith("_")]
    return [c for c in given.order_by if c not in contract]


def _metrics(store: StageStore, specs: Sequence[SourceSpec], elapsed: float) -> dict[str, object]:
    """Rows per step, seconds per stage and throughput of a run."""
    read = {s.name: store.counts[f"extract_{s.name}"]["rows"] for s in specs}
    of = {s.name: store.counts[f"transform_{s.name}"] for s in specs}
    consolidated = store.counts["merge"]["rows"]
    total = round(elapsed, 3)
    return {
        "rows_read": read,
        "rows_accepted": {name: c[KEPT_ROW] for name, c in of.items()},
        "rows_discarded": {name: c[DISCARDED_ROW] for name, c in of.items()},
        "rows_rejected": {name: c[REJECTED_ROW] for name, c in of.items()},
        "unreadable_dates": {name: c["unreadable_dates"] for name, c in of.items()},
        "unreadable_numbers": {name: c["unreadable_numbers"] for name, c in of.items()},
        "rows_rejected_total": sum(c[REJECTED_ROW] for c in of.values()),
        "rows_consolidated": consolidated,
        "stage_seconds": dict(store.seconds),
        "elapsed_seconds_total": total,
        "throughput_rows_per_sec": round(consolidated / total, 1) if total > 0 else 0.0,
    }


def export(
    spark: SparkSession, result: Consolidation, folder: str, sort_by_key: bool = False
) -> Mapping[str, str]:
    """Write every output as delimited text, plus the report, metrics and a manifest.

    ``sort_by_key`` puts the consolidated rows in key order across its files.
    """
    folder = folder.rstrip("/")
    consolidated = result.consolidated
    frames = {
        **result.accepted,
        "pessoas_consolidado": consolidated.orderBy(KEY) if sort_by_key else consolidated,
        "rejeitados": result.rejected,
        "duplicados": result.duplicates,
        "duplicidade": result.report(),
    }
    outputs = {name: f"{folder}/{name}" for name in frames}
    for name, frame in frames.items():
        write_delimited(frame, outputs[name])
    outputs["metrics"] = f"{folder}/metrics"
    write_record(spark, outputs["metrics"], {"metrics": json.dumps(result.metrics)}, "metrics string")
    manifest = {
        "completed_at": datetime.now(timezone.utc).isoformat(),
        "rows_consolidated": result.metrics["rows_consolidated"],
        "rows_rejected_total": result.metrics["rows_rejected_total"],
        "outputs": outputs,
    }
    write_record(
        spark,
        f"{folder}/manifest",
        manifest,
        "completed_at string, rows_consolidated long, rows_rejected_total long, "
        "outputs map<string,string>",
    )
    return outputs

"""Stage tables with markers, so a job can resume after its last finished stage."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import wraps
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recordweave.plans.buckets import BUCKET, Buckets, committed, forget, write_buckets
from recordweave.plans.clustered import Clustered, clustered_table, write_clustered
from recordweave.sources.tables import read_record, write_record
from recordweave.storage import delete_folder, temporary_tables

T = TypeVar("T")

_MARKER = "stage string, settings string, shown string, seconds double, counts string, schema string"


class ResumeError(ValueError):
    """Stages on disk were written with other settings."""


@dataclass(frozen=True)
class Stage:
    name: str
    table: DataFrame
    counts: Mapping[str, int]
    seconds: float
    reused: bool


# A few output folders open at once save sorting every task by the split column.
OPEN_FOLDERS = {"spark.sql.maxConcurrentOutputFileWriters": "8"}
# Wide sources: a loop too long for the JVM to compile is left to shorter functions (HotSpot's limit), and a join whose
# partitions turn out small on one side (shuffled size) hashes that side instead of sorting the full rows of the other.
WIDE_ROWS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}
# Row groups of stage tables: a table that one task wrote is read by as many as its size is worth.
ROW_GROUP_BYTES = 4 * 1024 * 1024


@contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for the length of a block."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def under(settings: Mapping[str, str]) -> Callable[[Callable[..., T]], Callable[..., T]]:
    """Run a function, whose first argument is the session, under settings of the session."""

    def wrap(function: Callable[..., T]) -> Callable[..., T]:
        @wraps(function)
        def run(spark: SparkSession, *args: object, **options: object) -> T:
            with session_settings(spark, settings):
                return function(spark, *args, **options)

        return run

    return wrap


def side_by_side(spark: SparkSession, tasks: Sequence[Callable[[], T]]) -> list[T]:
    """Run independent stages at once, so that one's last tasks do not idle the cluster."""
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        return [future.result() for future in running]


def describe_frame(df: DataFrame) -> dict[str, str]:
    """What tells one input frame from another for a resumed run: its schema and the files under it."""
    files = hashlib.sha256("\n".join(sorted(df.inputFiles())).encode()).hexdigest()
    return {"schema": df.schema.json(), "files": files}


def describe_files(spark: SparkSession, path: str | Sequence[str]) -> dict[str, object]:
    """What tells one set of files from another: their number and a sum over names, sizes and times; no file is opened."""
    listed = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
    of_file = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    count, total = listed.agg(F.count(F.lit(1)), F.sum(of_file)).first()
    return {"path": path, "files": count, "sum": str(total)}


@dataclass
class StageStore:
    """Runs named stages, each written as one Parquet table plus a marker.

    The marker is written after the table, so a stage cut short is run again.
    It keeps the settings of the run, the observed row counts and the schema.
    A stage is taken from disk only when the stages it comes ``after`` were.
    A stage may have ``settings`` of its own, the ones its result depends on.  With ``rebuild`` a stage whose settings changed is
    built again, with all that comes after it, and others are kept; without, a change is refused.
    A stage in buckets also keeps a record of each finished bucket, and one that was cut goes on with the others.
    """

    spark: SparkSession
    folder: str
    settings: Mapping[str, object]
    resume: bool = False
    rebuild: bool = False
    seconds: dict[str, float] = field(default_factory=dict)
    counts: dict[str, Mapping[str, int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.folder = self.folder.rstrip("/")
        self._reused: set[str] = set()
        if not self.resume:
            self.clear()

    @property
    def fingerprint(self) -> str:
        return _fingerprint(self.settings)

    def path(self, name: str) -> str:
        return f"{self.folder}/stages/{name}"

    def log(self, name: str) -> str:
        """Folder of a stage's commit records; records of other settings are not found."""
        return f"{self.folder}/commits/{name}/{self.fingerprint}"

    def clear(self) -> None:
        """Forget all stages: markers first, so none outlives its table."""
        for part in ("markers", "commits", "stages"):
            delete_folder(self.spark, f"{self.folder}/{part}")

    def _finished(
        self, name: str, settings: Mapping[str, object], place: str, split_by: str | None, clustered: Clustered | None
    ) -> Stage | None:
        marker = read_record(self.spark, f"{self.folder}/markers/{name}")
        if marker is None:
            return None
        if marker["settings"] != _fingerprint(settings):
            if self.rebuild:
                return None
            raise ResumeError(
                f"stage {name} was written with settings {marker['shown']}, "
                f"now {json.dumps(settings, sort_keys=True, default=str)}"
            )
        schema = StructType.fromJson(json.loads(marker["schema"]))
        table = self._read(schema, place, split_by, clustered)
        return Stage(name, table, json.loads(marker["counts"]), marker["seconds"], True)

    def _read(self, schema: StructType, place: str, split_by: str | None, clustered: Clustered | None) -> DataFrame:
        if clustered and not split_by:
            return clustered_table(self.spark, self.path(place), {f.name: f.dataType for f in schema}, clustered)
        return self.spark.read.schema(schema).parquet(self.path(place))

    def run(
        self,
        name: str,
        build: Callable[[], DataFrame],
        counters: Mapping[str, Column],
        split_by: str | None = None,
        after: Sequence[str] = (),
        hidden: Sequence[str] = (),
        check: Callable[[Mapping[str, int]], None] | None = None,
        buckets: Buckets | None = None,
        clustered: Clustered | None = None,
        place: str | None = None,
        settings: Mapping[str, object] | None = None,
    ) -> Stage:
        """The stage's table, from disk when it is finished, otherwise built and written.

        Counters are observed directly under the write, where every partition
        counts exactly once even if executors are lost.  Columns in ``hidden`` are
        for the counters only and not written.  ``check`` sees the counts before the stage counts as finished, and may raise.
        With ``buckets`` the table is cut by its key (see ``buckets``); ``counts`` then has its rows and the buckets that were
        there already.  With ``clustered`` it is in Spark's buckets (see ``clustered``; ``build`` deals the rows), under ``place``
        if its folder is part of a table of several stages.
        """
        settings, place = settings or self.settings, place or name
        may_reuse = self.resume and self._reused.issuperset(after)
        stage = self._finished(name, settings, place, split_by, clustered) if may_reuse else None
        if stage is None and buckets:
            if not (may_reuse and committed(self.spark, self.log(name))):
                forget(self.spark, self.path(name), self.log(name))
            else:
                self._reused.add(name)
            stage = self._write(name, build, counters, split_by, hidden, check, settings, place, buckets)
        elif stage is None:
            stage = self._write(name, build, counters, split_by, hidden, check, settings, place, None, clustered)
        else:
            self._reused.add(name)
        self.seconds[name] = stage.seconds
        self.counts[name] = stage.counts
        return stage

    def _write(
        self,
        name: str,
        build: Callable[[], DataFrame],
        counters: Mapping[str, Column],
        split_by: str | None,
        hidden: Sequence[str],
        check: Callable[[Mapping[str, int]], None] | None,
        settings: Mapping[str, object],
        place: str,
        buckets: Buckets | None = None,
        clustered: Clustered | None = None,
    ) -> Stage:
        started = time.perf_counter()
        # no marker of other settings may outlive the table it stands for
        delete_folder(self.spark, f"{self.folder}/markers/{name}")
        with temporary_tables(self.spark):
            df = build()
            if buckets:
                watched = df.withColumn(BUCKET, buckets.of())
                done = write_buckets(watched, self.path(name), self.log(name), range(buckets.count), buckets.batches, counters)
                counts = {**done.counts, "buckets_reused": len(done.reused)}
            else:
                seen = Observation(name)
                watched = df.observe(seen, *[c.alias(n) for n, c in counters.items()]).drop(*hidden)
                if clustered:
                    write_clustered(watched, self.path(place), clustered, split_by)
                else:
                    writer = watched.write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES)
                    if split_by:
                        writer = writer.partitionBy(split_by)
                    writer.parquet(self.path(place))
                counts = {n: int(v or 0) for n, v in seen.get.items()}
        if check:
            check(counts)
        seconds = round(time.perf_counter() - started, 3)
        marker = {
            "stage": name,
            "settings": _fingerprint(settings),
            "shown": json.dumps(settings, sort_keys=True, default=str),
            "seconds": seconds,
            "counts": json.dumps(counts),
            "schema": watched.schema.json(),
        }
        write_record(self.spark, f"{self.folder}/markers/{name}", marker, _MARKER)
        table = self._read(watched.schema, place, split_by, clustered)
        return Stage(name, table, counts, seconds, False)


def _fingerprint(settings: Mapping[str, object]) -> str:
    text = json.dumps(settings, sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()

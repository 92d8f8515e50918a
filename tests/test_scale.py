"""Plan shapes and hot keys: what must hold when the tables are much larger."""

import hashlib
from random import Random

import pytest
from pyspark.sql import functions as F

from recordweave.operators.dedupe import discarded, keep_one, mark_kept
from recordweave.operators.lookup import resolve_events
from recordweave.operators.merge import merge_by_joins, merge_by_priority
from recordweave.operators.numbering import number_rows
from recordweave.operators.profile import duplicate_profile, source_coverage
from recordweave.operators.sampling import proportional_quotas, stratified_sample
from recordweave.operators.writes import insert_if_absent


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot(spark):
    """A third of all rows under one key, the rest spread."""
    return spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 100).cast("int")).alias("d"),
        F.col("id").alias("i"),
    )


def expected(hot):
    rows = sorted(hot.collect(), key=lambda r: r.i)
    first, latest = {}, {}
    for r in rows:
        first.setdefault(r.k, r.i)
        if r.k not in latest or r.d > latest[r.k][0]:
            latest[r.k] = (r.d, r.i)
    return first, {k: i for k, (_, i) in latest.items()}


def test_dedupe_of_a_hot_key_against_brute_force(spark, hot):
    first, latest = expected(hot)
    for latest_by, want in ((None, first), ("d", latest)):
        kept = {r.k: r.i for r in keep_one(hot, ["k"], ["i"], latest_by).collect()}
        assert kept == want
        marked = mark_kept(hot, ["k"], ["i"], latest_by)
        assert {r.k: r.i for r in marked.filter("_kept").collect()} == want
        assert marked.count() == 60_000
        assert discarded(hot, ["k"], ["i"], latest_by).count() == 60_000 - len(want)


def test_survivors_are_pruned_before_the_shuffle(hot):
    text = plan(keep_one(hot, ["k"], ["i"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_full_rows_are_not_shuffled_to_find_the_dropped_ones(hot):
    for frame in (mark_kept(hot, ["k"], ["i"], "d"), discarded(hot, ["k"], ["i"], "d")):
        text = plan(frame)
        assert "BroadcastHashJoin" in text
        assert "Exchange hashpartitioning" not in text


def test_large_list_of_repeated_keys_is_not_broadcast(hot, monkeypatch):
    from recordweave.operators import dedupe, lookup

    monkeypatch.setattr(
        dedupe, "broadcast_if_small", lambda df: lookup.broadcast_if_small(df, limit=1)
    )
    hot.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = discarded(hot, ["k"], ["i"])
        assert "Broadcast" not in plan(frame)
        assert frame.count() == 60_000 - hot.select("k").distinct().count()
    finally:
        hot.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merge_shuffles_once(spark):
    sources = [
        spark.range(100).select(F.col("id").cast("string").alias("cpf"), F.lit(i).alias(f"c{i}"))
        for i in range(3)
    ]
    one = plan(merge_by_priority(sources, check_unique=False))
    assert one.count("Exchange hashpartitioning") == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(merge_by_joins(sources, check_unique=False)).count("Exchange hashpartitioning") == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_profiles_read_only_the_key_and_combine_before_the_shuffle(spark, hot, tmp_path):
    hot.write.parquet(str(tmp_path / "hot"))
    table = spark.read.parquet(str(tmp_path / "hot"))
    for frame in (duplicate_profile(table, "k"), source_coverage({"a": table, "b": table}, "k")):
        text = plan(frame)
        assert "ReadSchema: struct<k:string>" in text
        assert "partial_" in text
        assert "Window" not in text


def test_numbering_has_no_window_over_the_rows(spark, hot):
    text = plan(number_rows(hot, ["i"]))
    joined = text.index("BroadcastHashJoin")
    assert text.index("Window") > joined
    assert "Exchange SinglePartition" not in text[:joined]


def test_hot_key_in_a_batch_is_reduced_before_the_join(hot):
    old = hot.filter("k <> 'hot'").groupBy("k").agg(F.min("d").alias("d"), F.min("i").alias("i"))
    text = plan(insert_if_absent(old, hot, ["k"], ["i"]))
    assert "WindowGroupLimit" in text


@pytest.mark.parametrize("partitions", ["1", "13"])
def test_results_do_not_depend_on_partitioning(spark, hot, partitions):
    want = {r.k: r.i for r in keep_one(hot, ["k"], ["i"], "d").collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        moved = hot.repartition(int(partitions), "d")
        assert {r.k: r.i for r in keep_one(moved, ["k"], ["i"], "d").collect()} == want
        numbered = number_rows(moved, ["i"], after=0)
        assert numbered.filter("id <> i + 1").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_merge_against_brute_force(spark):
    random = Random(7)
    columns = [["a", "b"], ["b", "c"], ["a", "c", "d"]]
    tables = [
        {
            f"{k:03d}": {c: random.choice([None, f"{i}{c}{k}"]) for c in names}
            for k in random.sample(range(200), 120)
        }
        for i, names in enumerate(columns)
    ]
    frames = [
        spark.createDataFrame(
            [(k, *[row[c] for c in names]) for k, row in table.items()],
            ", ".join(f"{c} string" for c in ["cpf", *names]),
        )
        for table, names in zip(tables, columns, strict=True)
    ]
    want = set()
    for key in set().union(*tables):
        cells = [
            next((t[key][c] for t in tables if key in t and t[key].get(c) is not None), None)
            for c in "abcd"
        ]
        want.add((key, *cells))
    for merge in (merge_by_priority, merge_by_joins):
        assert {tuple(r) for r in merge(frames).collect()} == want


def test_sample_of_a_hot_group_against_brute_force(spark, hot):
    group = F.when(F.col("k") == "hot", "hot").otherwise(F.left("k", F.lit(2)))
    frame = hot.select("i", group.alias("g"))
    sample = {(r.g, r.i) for r in stratified_sample(frame, "g", "i", 9_000).collect()}
    members = {}
    for r in frame.collect():
        members.setdefault(r.g, []).append((hashlib.md5(str(r.i).encode()).hexdigest(), r.i))
    quota = {r.g: r.quota for r in proportional_quotas(frame, "g", 9_000).collect()}
    assert sum(quota.values()) == 9_000 and quota["hot"] == 3_000
    assert sample == {(g, i) for g, ids in members.items() for _, i in sorted(ids)[: quota[g]]}


def test_events_of_a_hot_person_are_split(spark):
    """Adaptive execution splits the event side of the person join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
        events = spark.range(0, 60_000, 1, 8).select(
            F.lpad(key.cast("string"), 11, "0").alias("cpf"),
            F.lit("admissao").alias("tipo_evento"),
            F.col("id").cast("string").alias("id_evento"),
            F.lit("2024-01-31").alias("data_evento"),
        )
        people = spark.range(5000).select(
            F.col("id"), F.lpad(F.col("id").cast("string"), 11, "0").alias("cpf")
        )
        types = spark.range(1).select(F.col("id"), F.lit("admissao").alias("codigo"))
        resolved = resolve_events(events, people, types)
        chosen = resolved.select("pessoa_id", "id_evento")
        collected = chosen.collect()
        assert len(collected) == 60_000
        assert sum(r.pessoa_id == 7 for r in collected) >= 20_000
        assert "skew=true" in plan(chosen)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)

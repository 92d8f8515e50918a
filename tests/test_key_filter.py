"""The kept filter of keys: equal to the anti join, and what of the table is shuffled."""

import pytest
from pyspark.sql import functions as F

from recordweave.operators.writes import absent_rows
from recordweave.plans import key_filter
from recordweave.plans.key_filter import KeyFilter


@pytest.fixture
def numbers(spark):
    return lambda a, b, step=1: spark.range(a, b, step).select(F.format_string("id-%d", "id").alias("k"), F.col("id").alias("n"))


def test_no_key_is_lost_and_few_are_held_wrongly(spark, tmp_path, numbers):
    held = KeyFilter(spark, str(tmp_path / "f"), ("k",), buckets=8)
    assert held.may_hold(numbers(0, 10)).count() == 0
    held.fit(numbers(0, 20000))
    held.add(numbers(20000, 24000))
    assert held.may_hold(numbers(0, 24000)).count() == 24000
    assert held.may_hold(numbers(100_000, 120_000)).count() < 20000 * 0.04
    assert held.may_hold(numbers(0, 0)).count() == 0


def test_absent_rows_equal_the_anti_join(spark, tmp_path, numbers, rows):
    held = KeyFilter(spark, str(tmp_path / "f"), ("k",), buckets=4)
    null = spark.createDataFrame([(None, 1), (None, 2), ("", 3)], "k string, n long")
    old = numbers(0, 3000).unionByName(null.limit(1))
    held.add(old)
    # repeated keys, a hot one, keys that are there, an empty text and NULL
    hot = numbers(0, 500).withColumn("k", F.lit("id-9000"))
    new = numbers(2500, 4000).unionByName(numbers(3500, 3600)).unionByName(null).unionByName(hot)
    assert rows(held.absent_rows(old, new, ["n"])) == rows(absent_rows(old, new, ["k"], ["n"]))
    assert rows(held.absent_rows(old, new.limit(0), ["n"])) == []
    with pytest.raises(TypeError, match="two types"):
        held.absent_rows(old, new.withColumn("k", F.lit(1)), ["n"])


def test_adding_twice_changes_nothing_and_full_buckets_are_fitted_anew(spark, tmp_path, numbers):
    held = KeyFilter(spark, str(tmp_path / "f"), ("k",), buckets=2)
    assert held.add(numbers(0, 100)) == [0, 1]
    small = held.sizes()
    held.add(numbers(0, 100))
    assert held.sizes() == small
    table = numbers(0, 5000)
    assert held.add(numbers(100, 5000), table.limit(0)) == []  # not full before: only merged
    assert all(full > key_filter.FULL for _, full in held.sizes().values())
    assert held.add(numbers(5000, 5100), table) == [0, 1]
    assert all(full < key_filter.FULL for _, full in held.sizes().values())
    assert held.may_hold(numbers(0, 5100)).count() == 5100


def test_untouched_buckets_keep_their_files(spark, tmp_path, numbers):
    held = KeyFilter(spark, str(tmp_path / "f"), ("k",), buckets=16)
    held.fit(numbers(0, 2000))
    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "f" / "words").glob("_bucket=*/*.parquet")}
    before = files()
    held.add(numbers(7000, 7001))
    after = files()
    assert len({f.parent for f in before.keys() ^ after.keys()}) == 1


def test_the_keys_of_the_table_are_not_shuffled(spark, tmp_path, numbers):
    held = KeyFilter(spark, str(tmp_path / "f"), ("k",))
    old = numbers(0, 5000)
    held.fit(old)
    maybe = held.may_hold(numbers(4900, 6000).select("k"))
    plan = maybe._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_a_filter_too_large_to_broadcast_is_joined_by_shuffle(spark, tmp_path, numbers, rows, monkeypatch):
    held = KeyFilter(spark, str(tmp_path / "f"), ("k",))
    held.fit(numbers(0, 5000))
    want = rows(held.may_hold(numbers(4900, 6000)))
    monkeypatch.setattr(key_filter, "BROADCAST_BYTES", 0)
    assert rows(held.may_hold(numbers(4900, 6000))) == want

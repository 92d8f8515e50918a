import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from recordweave.llm import jump_shards as jump


def shard_of(key, shards):
    key, bucket, following = key % (1 << 64), -1, 0
    while following < shards:
        bucket = following
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        following = int((bucket + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return bucket


def test_equals_the_published_function(spark):
    random.seed(1)
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *[random.randint(-(2**63), 2**63 - 1) for _ in range(1000)]]
    frame = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for shards in (1, 2, 16, 17, 100):
        assert all(r.s == shard_of(r.k, shards) for r in frame.select("k", jump.jump_shard(F.col("k"), shards).alias("s")).collect())


def test_one_more_shard_takes_its_part_only(spark):
    rows = jump.shard(spark.range(20000).selectExpr("id as doc_id", "'x' as text")).collect()
    moved = [r for r in rows if r.grown_shard != r.shard]
    assert {r.grown_shard for r in moved} == {16}
    assert abs(len(moved) / len(rows) - 1 / 17) < 0.01
    sizes = [sum(r.shard == k for r in rows) for k in range(16)]
    assert max(sizes) < 1.15 * min(sizes)


def test_edge_rows(edge, docs_of):
    rows = jump.shard(edge).collect()
    texts = {(r.doc_id, r.text or "") for r in edge.collect()}
    assert len(rows) == 10
    for r in rows:
        assert r.shard == shard_of(r.doc_id or 0, 16) and r.law == "key"
        assert (r.size, r.text_crc32) in {(len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in texts if d == r.doc_id}
    for k in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == k)
        assert slots == list(range(len(slots)))
    assert jump.shard(docs_of([])).count() == 0


def test_a_third_of_the_rows_under_a_null_id_are_numbered_in_parts(spark):
    docs = spark.range(6000).selectExpr("if(id % 3 = 0, null, id) as doc_id", "repeat('x', cast(id % 700 as int)) || id as text")
    part = jump.slot_part(F.col("doc_id"), F.col("size"), F.col("text_crc32"))
    rows = jump.shard(docs).withColumn("part", part).collect()
    hot = [r for r in rows if r.doc_id is None]
    assert len(hot) == 2000 and len({r.shard for r in hot}) == 1
    counts = Counter(r.part for r in hot)
    assert len(counts) > 240 and max(counts.values()) < 30
    for k in range(16):
        slots = sorted(r.slot for r in rows if r.shard == k)
        assert slots == list(range(len(slots)))


def test_files(spark, edge, tmp_path):
    jump.write_shards(edge, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 10 and set(back.columns) == {*edge.columns, "shard"}
    assert all(r.shard == shard_of(r.doc_id or 0, 16) for r in back.collect())


def test_no_python_in_the_plan(edge, capsys):
    jump.shard(edge).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)

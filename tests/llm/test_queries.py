import pytest

import corpus_pipeline
from recordweave.llm import decontaminate, language_id, secret_scan, simhash_gray
from recordweave.llm.queries import QUERIES, SQL
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, SF_DIR), connection, SQL[name]) == []


def test_each_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into and comes out of each stage, as lists of rows."""
    docs, seen = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.materialize(stage(spark, docs, SF_DIR), "test-stage")
        seen.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in seen}


def test_columns(spark, stages):
    columns = spark.read.parquet(f"{SF_DIR}/documents.parquet").dtypes
    assert all(after.dtypes == columns for name, (_, after) in stages.items() if name != "packing")


def test_language_rejects_only_texts_of_no_language(stages):
    before, after = stages["language"]
    model = language_id.Model(language_id.learn(before, language_id.F.lit(True)))
    rows = before.collect()
    strange = language_id.predict(model, [r.text or "" for r in rows])[3]
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r, s in zip(rows, strange, strict=True) if not s)


def test_one_document_of_each_group(stages):
    from tests.llm.test_simhash_gray import components, fingerprint

    before, after = stages["near_duplicates"]
    rows = sorted(before.collect(), key=lambda r: r.doc_id)
    label = components(simhash_gray.np.array([fingerprint(r.text) for r in rows], simhash_gray.np.uint64), simhash_gray.MAX_BITS)
    first = {}
    for r, g in zip(rows, label.tolist(), strict=True):
        first.setdefault(g, r)
    assert sorted(map(str, after.collect())) == sorted(map(str, first.values()))


def test_no_benchmark_item_is_left(spark, stages):
    before, after = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    said = [f" {' '.join(decontaminate.words_of(t))} " for _, t in items]
    holds = lambda text: any(s in f" {' '.join(decontaminate.words_of(text))} " for s in said)
    gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
    assert not any(holds(r.text) for r in after.collect())
    assert all(holds(r.text) for r in before.collect() if r.doc_id in gone)


def test_secrets_are_replaced(stages):
    before, after = stages["secrets"]
    old = {r.doc_id: r for r in before.collect()}
    for r in after.collect():
        base, more, _ = secret_scan.find(old[r.doc_id].text)
        assert r.text == secret_scan.redact(old[r.doc_id].text, base + [m[:3] for m in more]) and r.n_chars == len(r.text)
        assert secret_scan.scan(r.text) == []


def test_every_text_is_packed(spark, stages):
    before, after = stages["packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
    assert corpus_pipeline.run(spark, SF_DIR).count() == after.count()

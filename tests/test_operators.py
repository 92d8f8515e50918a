import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recordweave.operators import sampling
from recordweave.operators.dedupe import KEPT, discarded, keep_one, mark_kept
from recordweave.operators.integrity import (
    IntegrityError,
    MaxLength,
    NotNull,
    Reference,
    Unique,
    audit,
    require_integrity,
)
from recordweave.operators.lookup import (
    SKIP_REASON,
    Catalog,
    DomainError,
    attach_ids,
    broadcast_if_small,
    check_domains,
    require_no_violations,
    resolve_events,
)
from recordweave.operators.merge import (
    DuplicateKeyError,
    merge_by_joins,
    merge_by_priority,
    union_audit,
)
from recordweave.operators.numbering import assign_ids, number_rows
from recordweave.operators.profile import (
    duplicate_profile,
    duplicate_report,
    require_unique,
    source_coverage,
)
from recordweave.operators.quarantine import drop_unusable, quarantine
from recordweave.operators.sampling import (
    head_n,
    proportional_quotas,
    restrict_to_keys,
    stratified_sample,
)
from recordweave.operators.standardise import annotate_duplicates, standardise
from recordweave.operators.writes import (
    cascade_delete,
    full_refresh,
    insert_if_absent,
    replace_by_key,
    upsert_latest,
)
from recordweave.sources.contracts import ESOCIAL, ContractError

D1, D2 = dt.date(2020, 1, 1), dt.date(2020, 2, 1)


def test_standardise(spark):
    raw = spark.createDataFrame(
        [("123.456.789-01", "31/01/2020", "12-31-2020", "301.0", "")],
        "cpf string, data_nascimento string, data_evento string, codigo_categoria string, nome string",
    )
    row = standardise(raw, ESOCIAL).first().asDict()
    assert row == {
        "cpf": "12345678901", "data_nascimento": dt.date(2020, 1, 31), "data_evento": None,
        "codigo_categoria": "301", "nome": None, "cpf_original": "123.456.789-01",
        "_unreadable_dates": 1, "_unreadable_numbers": 0,
    }
    with pytest.raises(ContractError):
        standardise(raw.drop("cpf"), ESOCIAL)


def test_quarantine_loses_no_row(spark, rows):
    keys = [("12345678901",), ("1234",), ("",), (None,), ("123.456.789-01",)]
    frame = spark.createDataFrame(keys, "cpf string")
    split = quarantine(frame, "rh")
    assert rows(split.valid) == [("12345678901",)]
    assert rows(split.rejected) == [
        ("", "rh", "cpf_ausente"),
        ("123.456.789-01", "rh", "cpf_invalido"),
        ("1234", "rh", "cpf_quantidade_digitos_invalida"),
        (None, "rh", "cpf_ausente"),
    ]
    assert split.valid.count() + split.rejected.count() == len(keys)
    usable, dropped = drop_unusable(frame)
    assert rows(usable) == [("12345678901",)] and dropped.get["dropped"] == 4


def test_quarantine_of_wrong_check_digits(spark, rows):
    frame = spark.createDataFrame([("52998224725",), ("52998224726",)], "cpf string")
    split = quarantine(frame, "rh", check_digits=True)
    assert rows(split.valid) == [("52998224725",)]
    assert rows(split.rejected, "motivo_rejeicao") == [("cpf_digito_verificador_invalido",)]


@pytest.fixture
def events(spark):
    return spark.createDataFrame(
        [
            ("a", None, 1), ("a", D1, 2), ("a", D1, 3), ("b", None, 4), ("b", None, 5),
            ("c", D1, 6), ("c", D2, 7), (None, D1, 8), (None, D2, 9), ("d", D1, 10),
        ],
        "k string, d date, i int",
    )


def test_keep_first(events, rows):
    assert rows(keep_one(events, ["k"], ["i"]), "i") == [(1,), (10,), (4,), (6,), (8,)]
    assert rows(discarded(events, ["k"], ["i"]), "i") == [(2,), (3,), (5,), (7,), (9,)]


def test_keep_latest_with_ties_and_missing_dates(events, rows):
    kept = keep_one(events, ["k"], ["i"], latest_by="d")
    assert rows(kept, "k", "i") == [("a", 2), ("b", 4), ("c", 7), ("d", 10), (None, 9)]
    dropped = discarded(events, ["k"], ["i"], latest_by="d")
    assert rows(dropped, "i") == [(1,), (3,), (5,), (6,), (8,)]


def test_flag_agrees_with_both_halves(events, rows):
    marked = mark_kept(events, ["k"], ["i"], latest_by="d")
    assert rows(marked.filter(KEPT).drop(KEPT)) == rows(keep_one(events, ["k"], ["i"], "d"))
    assert marked.count() == events.count()
    some = mark_kept(events, ["k"], ["i"], eligible=F.col("i") != 1)
    assert rows(some.filter(F.col(KEPT) & (F.col("k") == "a")).filter("i <> 1"), "i") == [(2,)]


def test_null_in_the_order_column_sorts_first_everywhere(spark, rows):
    frame = spark.createDataFrame([("k", 1, "a"), ("k", None, "b"), ("k", 2, "c"), ("m", None, "d"), (None, 3, "e")], "key string, o int, v string")
    assert rows(keep_one(frame, ["key"], ["o"]), "v") == [("b",), ("d",), ("e",)]
    assert rows(discarded(frame, ["key"], ["o"]), "v") == [("a",), ("c",)]
    assert rows(mark_kept(frame, ["key"], ["o"]).filter("_kept"), "v") == [("b",), ("d",), ("e",)]


def test_order_by_several_columns(spark, rows):
    frame = spark.createDataFrame(
        [("a", "f2", 0, 1), ("a", "f1", 9, 7), ("a", "f1", 2, 8), ("b", "f1", 0, 3)],
        "k string, f string, block int, row int",
    )
    order = ["f", "block", "row"]
    assert rows(keep_one(frame, ["k"], order), "row") == [(3,), (8,)]
    assert rows(discarded(frame, ["k"], order), "row") == [(1,), (7,)]


def test_missing_columns(spark, rows):
    frame = spark.createDataFrame([("a", 1), ("a", 2)], "k string, i int")
    assert rows(keep_one(frame, ["k"], ["i"], latest_by="absent"), "i") == [(1,)]
    assert rows(discarded(frame, ["k"], ["i"], latest_by="absent"), "i") == [(2,)]
    assert rows(discarded(frame, ["absent"], ["i"])) == []


def test_several_key_columns(spark, rows):
    frame = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 1, 3)], "k string, l int, i int")
    assert rows(discarded(frame, ["k", "l"], ["i"]), "i") == [(3,)]


def test_annotate_duplicates(spark):
    frame = annotate_duplicates(spark.createDataFrame([("1",)], "cpf string"), "rh", "why")
    assert frame.columns == ["fonte", "motivo_duplicidade", "cpf"]
    assert tuple(frame.first()) == ("rh", "why", "1")


@pytest.fixture
def sources(spark):
    return [
        spark.createDataFrame([("1", None, 1), ("2", "rh", 2)], "cpf string, nome string, a int"),
        spark.createDataFrame([("1", "x", "e1"), ("3", "y", "e3")], "cpf string, nome string, e string"),
        spark.createDataFrame([("1", "y", "g"), ("4", None, "h")], "cpf string, nome string, z string"),
    ]


@pytest.mark.parametrize("merge", [merge_by_priority, merge_by_joins])
def test_priority_merge(sources, rows, merge):
    merged = merge(sources)
    assert merged.columns == ["cpf", "nome", "a", "e", "z"]
    assert rows(merged) == [
        ("1", "x", 1, "e1", "g"), ("2", "rh", 2, None, None),
        ("3", "y", None, "e3", None), ("4", None, None, None, "h"),
    ]


@pytest.mark.parametrize("merge", [merge_by_priority, merge_by_joins])
def test_merge_refuses_repeated_keys(sources, merge):
    with pytest.raises(DuplicateKeyError, match="source 1: '3'"):
        merge([sources[0], sources[1].unionAll(sources[1].filter("cpf = '3'")), sources[2]])


def test_union_audit(spark, rows):
    a = spark.createDataFrame([("rh", "1")], "fonte string, cpf string")
    b = spark.createDataFrame([("gestao", "x")], "fonte string, email string")
    assert rows(union_audit([a, b])) == [("gestao", None, "x"), ("rh", "1", None)]


def keyed(spark, values):
    return spark.createDataFrame([(v,) for v in values], "cpf string")


def test_duplicate_profile(spark):
    assert tuple(duplicate_profile(keyed(spark, ["a", "a", "b"])).first()) == (3, 2, 2, 1, 1)
    assert tuple(duplicate_profile(keyed(spark, ["a", None, None])).first()) == (3, 1, 2, 2, 1)
    assert tuple(duplicate_profile(keyed(spark, [])).first()) == (0, 0, 0, 0, 0)
    with pytest.raises(ValueError, match="1 rows"):
        require_unique(duplicate_profile(keyed(spark, ["a", "a"])), "consolidated")


def test_coverage(spark):
    sources = {"a": keyed(spark, ["1", "2", "1", None]), "b": keyed(spark, ["2", "3"]), "c": keyed(spark, ["4"])}
    assert tuple(source_coverage(sources).first()) == (4, 1, 1, 1)


def test_duplicate_report(spark):
    sources = {"a": keyed(spark, ["1"]), "b": keyed(spark, ["1", "2"])}
    report = duplicate_report(sources, {"b": keyed(spark, ["1", "2", "2"])}, keyed(spark, ["1", "2"]))
    value = {(r.section, r.metric): r.value for r in report.collect()}
    assert value["b_before_dedupe", "excess_rows"] == 1
    assert value["b", "repeated_key_rows"] == 0
    assert value["coverage", "only_b"] == 1
    assert value["consolidated", "later_repeats"] == 0


def test_numbering(spark, rows):
    frame = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    numbered = number_rows(frame, ["v"], after=5)
    assert rows(numbered.filter("id <> v + 6")) == []
    assert numbered.count() == 1000
    more = assign_ids(spark.createDataFrame([(1,), (2,)], "v int"), numbered, ["v"])
    assert rows(more, "id") == [(1006,), (1007,)]
    assert rows(assign_ids(frame.limit(0), numbered, ["v"])) == []


def test_quotas(spark, rows):
    frame = spark.createDataFrame([(g,) for g in "aaaaabbbcc"], "g string")
    assert rows(proportional_quotas(frame, "g", 4), "g", "quota") == [("a", 2), ("b", 1), ("c", 1)]
    assert rows(proportional_quotas(frame, "g", 1), "g", "quota") == [("a", 1)]
    assert rows(proportional_quotas(frame, "g", 10), "g", "quota") == [("a", 5), ("b", 3), ("c", 2)]
    with pytest.raises(ValueError):
        proportional_quotas(frame, "g", 0)


def test_stratified_sample(spark):
    frame = spark.range(900).select("id", F.when(F.col("id") < 300, "a").when(F.col("id") < 800, "b").alias("g"))
    sample = stratified_sample(frame, "g", "id", 90)
    counts = {r.g: r["count"] for r in sample.groupBy("g").count().collect()}
    assert counts == {"a": 30, "b": 50, None: 10}
    assert sample.join(frame, "id", "left_anti").count() == 0
    again = stratified_sample(frame.repartition(7), "g", "id", 90)
    assert sample.select("id").exceptAll(again.select("id")).count() == 0
    assert stratified_sample(frame, "g", "id", 5000).count() == 900


def test_head_and_semi(spark, rows):
    frame = spark.range(50).select((49 - F.col("id")).alias("v"))
    assert rows(head_n(frame, ["v"], 3)) == [(0,), (1,), (2,)]
    assert head_n(frame, ["v"], 50).count() == head_n(frame, ["v"], 99).count() == 50
    assert head_n(frame.limit(0), ["v"], 3).count() == 0
    tied = spark.createDataFrame([(None, "a"), (1, "b"), (1, "c"), (1, "d"), (1, "d"), (1, "d"), (2, "e")], "v int, c string")
    for n in range(1, 9):
        head = sorted(str(r[0]) for r in head_n(tied, ["v"], n).select("v").collect())
        assert head == sorted(map(str, [None, 1, 1, 1, 1, 1, 2][:n]))
    plan = head_n(frame, ["v"], 3)._jdf.queryExecution().toString()
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan
    child = spark.createDataFrame([(0, "x"), (0, "y"), (9, "z")], "v int, c string")
    assert rows(restrict_to_keys(child, head_n(frame, ["v"], 3), "v"), "c") == [("x",), ("y",)]


@pytest.fixture
def catalog(spark):
    return spark.createDataFrame([(1, "x"), (2, "y")], "id long, codigo string")


def test_lookup_and_domains(spark, rows, catalog):
    frame = spark.createDataFrame([("1", "x"), ("2", "q"), ("3", None)], "cpf string, t string")
    cat = Catalog(catalog, "codigo", "t", "t_id")
    assert rows(attach_ids(frame, [cat])) == [("1", "x", 1), ("2", "q", None), ("3", None, None)]
    checked = check_domains(frame, [cat])
    assert rows(checked.ok) == [("1", "x", 1)]
    assert rows(checked.violations) == [("2", "q", "t"), ("3", None, "t")]
    with pytest.raises(DomainError, match="t='q'"):
        require_no_violations(checked.violations, "cpf", ["t"])
    require_no_violations(checked.violations.limit(0), "cpf", ["t"])


def test_broadcast_only_when_small(catalog):
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    assert hinted(broadcast_if_small(catalog))
    assert not hinted(broadcast_if_small(catalog, limit=10))


def test_event_eligibility(spark):
    people = spark.createDataFrame([(7, "12345678901")], "id long, cpf string")
    types = spark.createDataFrame([(1, "admissao")], "id long, codigo string")
    known = "123.456.789-01"
    given = [
        (known, "admissao", "e1", "2020-01-31", None),
        ("x", "admissao", "e2", "2020-01-31", "chave_invalida"),
        ("00000000001", "admissao", "e3", "2020-01-31", "pessoa_desconhecida"),
        (known, "outro", "e4", "2020-01-31", "tipo_evento_desconhecido"),
        (known, None, "e5", "2020-01-31", "tipo_evento_desconhecido"),
        (known, "admissao", "", "2020-01-31", "id_evento_ausente"),
        (known, "admissao", "e7", "", "data_evento_ausente"),
        (known, "admissao", "e8", "2020.01.31", "data_evento_invalida"),
    ]
    schema = "cpf string, tipo_evento string, id_evento string, data_evento string, want string"
    got = resolve_events(spark.createDataFrame(given, schema), people, types).collect()
    assert len(got) == len(given)
    assert all(r[SKIP_REASON] == r.want for r in got)
    loaded = [r for r in got if r[SKIP_REASON] is None]
    assert [(r.pessoa_id, r.tipo_evento_id, r["_date"]) for r in loaded] == [(7, 1, dt.date(2020, 1, 31))]


def kv(spark, *pairs):
    return spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(pairs)], "k string, v string, i int")


def test_write_semantics(spark, rows):
    old = kv(spark, ("a", "old"), ("z", "old"))
    new = kv(spark, ("a", "new"), ("b", "first"), ("b", "second"))
    pick = ("k", "v")
    assert rows(full_refresh(new, ["k"], ["i"]), *pick) == [("a", "new"), ("b", "first")]
    inserted = insert_if_absent(old, new, ["k"], ["i"])
    assert rows(inserted, *pick) == [("a", "old"), ("b", "first"), ("z", "old")]
    replaced = replace_by_key(old, new, ["k"], ["i"])
    assert rows(replaced, *pick) == [("a", "new"), ("b", "second"), ("z", "old")]
    for write in (insert_if_absent, replace_by_key):
        once = write(old, new, ["k"], ["i"])
        assert rows(write(once, new, ["k"], ["i"])) == rows(once)
    assert rows(insert_if_absent(old, new.limit(0), ["k"], ["i"])) == rows(old)


def test_upsert(spark, rows):
    schema = "p int, cycle string, score double"
    old = spark.createDataFrame([(1, "2023", 3.0), (2, "2023", 5.0)], schema)
    new = spark.createDataFrame(
        [(1, "2023", 1.0, 1), (1, "2023", 4.5, 2), (1, "2024", 4.0, 3)], schema + ", i int"
    )
    key = ["p", "cycle"]
    got = upsert_latest(old, new, key, ["score"], ["i"])
    assert rows(got) == [(1, "2023", 4.5), (1, "2024", 4.0), (2, "2023", 5.0)]
    assert rows(upsert_latest(got, new, key, ["score"], ["i"])) == rows(got)
    noted = spark.createDataFrame([(1, "2023", None, 3.0)], "p int, cycle string, note string, score double")
    fresh = spark.createDataFrame([(1, "2023", "new", 4.0, 1), (2, "2023", "own", 5.0, 1)], "p int, cycle string, note string, score double, i int")
    assert rows(upsert_latest(noted, fresh, key, ["score"], ["i"])) == [(1, "2023", None, 4.0), (2, "2023", "own", 5.0)]


def test_cascade_delete(spark, rows):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "p long, v string")
    gone = spark.createDataFrame([(1,), (1,)], "id long")
    assert rows(cascade_delete(child, gone, "p")) == [(2, "b"), (None, "c")]


def test_integrity(spark):
    tables = {
        "p": spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "id long, code string"),
        "c": spark.createDataFrame([(1,), (1,), (9,), (None,)], "p_id long"),
    }
    rules = [
        Unique("p", ("id",)), Unique("p", ("code",)), NotNull("p", ("id", "code")),
        Reference("c", "p_id", "p"), MaxLength("p", {"code": 0}),
    ]
    got = {(r.table, r.rule): r.violations for r in audit(rules, tables).collect()}
    assert got == {
        ("p", "unique(id)"): 0, ("p", "unique(code)"): 1, ("p", "not_null(id)"): 0,
        ("p", "not_null(code)"): 1, ("c", "p_id->p"): 1, ("p", "length(code)<=0"): 2,
    }
    with pytest.raises(IntegrityError, match="unique\\(code\\): 1"):
        require_integrity(audit(rules, tables))
    require_integrity(audit(rules[:1], tables))


@pytest.mark.parametrize("n", [3, 37, 1234, 1999])
def test_first_rows_by_selection(spark, monkeypatch, n):
    """Brackets of a few rows: nulls, ties over many rows, equal rows, several columns of different types."""
    for name, value in (("SAMPLE_ROWS", 128), ("RANKED_ROWS", 20), ("FEW_ROWS", 5)):
        monkeypatch.setattr(sampling, name, value)
    frame = spark.range(2000).selectExpr(
        "CASE WHEN id % 11 > 0 THEN CASE WHEN id % 3 = 0 THEN 'tie' ELSE substr(md5(CAST(id AS STRING)), 1, 2) END END AS a",
        "CAST(id % 7 AS DECIMAL(9,2)) AS b", "DATE '2020-01-01' + CAST(id % 5 AS INT) AS c", "id % 1000 AS d",
    )
    key = lambda r: [(x is not None, x) for x in r[:3]]
    whole = sorted((tuple(r) for r in frame.collect()), key=key)
    found = [tuple(r) for r in head_n(frame, ["a", "b", "c"], n).collect()]
    assert len(found) == min(n, 2000)
    assert sorted(map(key, found)) == [key(r) for r in whole[:n]]
    # A second run takes the same rows, and more rows hold fewer.
    more = [tuple(r) for r in head_n(frame, ["a", "b", "c"], n + 10).collect()]
    assert not Counter(found) - Counter(more)


def test_first_rows_of_equal_rows(spark, monkeypatch):
    for name, value in (("SAMPLE_ROWS", 64), ("RANKED_ROWS", 20), ("FEW_ROWS", 5)):
        monkeypatch.setattr(sampling, name, value)
    few = spark.range(3000).selectExpr("CASE WHEN id < 100 THEN id ELSE 1000 END AS a")
    assert sorted(r.a for r in head_n(few, ["a"], 80).collect()) == list(range(80))
    frame = spark.range(3000).selectExpr("1 AS a", "'x' AS b")
    assert head_n(frame, ["a"], 1700).count() == 1700
    assert head_n(frame, ["a"], 0).count() == 0


def test_first_rows_are_not_sorted_or_written(spark, monkeypatch):
    monkeypatch.setattr(sampling, "number_rows", None)
    plan = head_n(spark.range(100000).withColumnRenamed("id", "a"), ["a"], 50000)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan

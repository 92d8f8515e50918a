import pytest
from pyspark.sql import functions as F

from recordweave.sources.contracts import (
    ESOCIAL,
    GESTAO,
    RH,
    ContractError,
    check_canonical_names,
    consolidated_order,
    to_canonical,
)
from recordweave.sources.delimited import FILE_ORDER, read_delimited, write_delimited
from recordweave.sources.tables import (
    empty_table,
    read_record,
    read_table,
    write_record,
    write_table,
)


def put(folder, name, text, bom=True):
    path = folder / name
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())
    return str(path)


def test_scan_keeps_text_and_reads_missing_spellings(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'cpf,nome,x\n00123,"a ""b"", c",1.0\n123.0,NA,\n,#N/A,none\n nan ," NA",""\n')
    got = read_delimited(spark, path).orderBy(*FILE_ORDER).select("cpf", "nome", "x").collect()
    assert [tuple(r) for r in got] == [
        ("00123", 'a "b", c', "1.0"), ("123", None, None), ("", None, "none"), ("", " NA", None),
    ]


def test_scan_order_follows_files_and_lines(spark, tmp_path):
    # Later files are larger, so that splits are packed in another order than the files.
    sizes = {"a.csv": 10, "b.csv": 4000, "c.csv": 9000}
    expected = []
    for name, count in sizes.items():
        lines = [f"{name}{i:06d}" for i in range(count)]
        expected += lines
        put(tmp_path, name, "cpf,nome\n" + "".join(f"1,{line}\n" for line in lines), bom=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        frame = read_delimited(spark, str(tmp_path))
        assert frame.rdd.getNumPartitions() > 3
        got = [r.nome for r in frame.orderBy(*FILE_ORDER).select("nome").collect()]
        assert got == expected
        unordered = [r.nome for r in frame.orderBy("_row").select("nome").collect()]
        assert unordered != expected
        assert frame.select("_row").distinct().count() == len(expected)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_scan_rejects_other_headers_and_short_rows(spark, tmp_path):
    put(tmp_path, "a.csv", "cpf,nome\n1,a\n")
    put(tmp_path, "b.csv", "nome,cpf\nb,2\n")
    with pytest.raises(Exception, match="header|CSV"):
        read_delimited(spark, str(tmp_path)).collect()
    other = tmp_path / "short"
    other.mkdir()
    put(other, "a.csv", "cpf,nome,x\n1,a,b\n2\n")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        read_delimited(spark, str(other)).collect()
    padded = read_delimited(spark, str(other), mode="PERMISSIVE").orderBy("cpf")
    assert [tuple(r)[:3] for r in padded.collect()] == [("1", "a", "b"), ("2", None, None)]


def test_scan_with_line_breaks_in_cells(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'cpf,nome\n1,"a\nb"\n2,c\n')
    got = read_delimited(spark, path, multi_line=True, keep_order=False).orderBy("cpf").collect()
    assert [tuple(r) for r in got] == [("1", "a\nb"), ("2", "c")]


def test_sink_round_trip(spark, tmp_path, rows):
    frame = spark.createDataFrame(
        [("1", 'a "b", c', "2020-01-02"), ("2", None, None), ("3", "", None)],
        "cpf string, nome string, d string",
    ).withColumn("d", F.col("d").cast("date"))
    write_delimited(frame, str(tmp_path / "deep" / "out"))
    back = read_delimited(spark, str(tmp_path / "deep" / "out"), keep_order=False)
    assert rows(back) == [("1", 'a "b", c', "2020-01-02"), ("2", None, None), ("3", None, None)]


def test_contracts(spark):
    def frame(columns):
        return spark.range(1).select(*[F.lit("x").alias(c) for c in columns])

    columns = list(RH.exact_columns)
    assert to_canonical(frame(columns[::-1]), RH).columns == columns[::-1]
    assert to_canonical(frame([*columns, "_order"]), RH, carried=["_order"]).columns[-1] == "_order"
    with pytest.raises(ContractError, match="missing columns \\['cargo'\\]"):
        to_canonical(frame([c for c in columns if c != "cargo"]), RH)
    with pytest.raises(ContractError, match="extra columns \\['novo'\\]"):
        to_canonical(frame([*ESOCIAL.exact_columns, "novo"]), ESOCIAL)
    raw = ["nome", "cpf", *GESTAO.renames, "extra"]
    assert to_canonical(frame(raw), GESTAO).columns == [
        "nome", "cpf", *GESTAO.renames.values(), "extra",
    ]
    with pytest.raises(ContractError, match="orgao"):
        to_canonical(frame([c for c in raw if c != "orgao"]), GESTAO)
    with pytest.raises(ContractError, match="snake_case"):
        to_canonical(frame([*raw, "outraColuna"]), GESTAO)


@pytest.mark.parametrize("name", ["dataX", "a b", "a-b"])
def test_name_lint(name):
    with pytest.raises(ContractError):
        check_canonical_names(["ok_name", name], "rh")
    check_canonical_names(["a_b"], "rh")


def test_consolidated_order():
    assert consolidated_order(["z", "nome", "a", "cpf"]) == ["cpf", "nome", "a", "z"]


def test_tables_and_records(spark, tmp_path, rows):
    schema = "fonte string, n long"
    absent = read_table(spark, str(tmp_path / "none"), empty_table(spark, schema).schema)
    assert absent.count() == 0 and absent.columns == ["fonte", "n"]
    empty = write_table(empty_table(spark, schema), str(tmp_path / "empty"))
    assert empty.count() == 0
    assert read_table(spark, str(tmp_path / "empty")).dtypes == [("fonte", "string"), ("n", "bigint")]
    assert read_record(spark, str(tmp_path / "r")) is None
    write_record(spark, str(tmp_path / "r"), {"a": 1, "b": "ç", "c": None}, "a long, b string, c string")
    assert read_record(spark, str(tmp_path / "r")).asDict() == {"a": 1, "b": "ç", "c": None}

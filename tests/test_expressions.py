import datetime as dt

import pytest
from pyspark.sql import functions as F

from recordweave.functions.dates import parse_date, parse_load_date, unreadable
from recordweave.functions.keys import (
    has_valid_check_digits,
    key_text,
    mask_key,
    normalize_key,
    rejection_reason,
)
from recordweave.functions.numbers import category_code, decimal_comma, load_decimal, rounded
from recordweave.functions.text import (
    MISSING_SPELLINGS,
    blank_to_null,
    bounded,
    is_missing,
    missing_to_null,
    name_or_default,
)


def apply(spark, function, values):
    """Results of an expression over text cells, in the order given."""
    frame = spark.createDataFrame(list(enumerate(values)), "i int, c string")
    got = frame.select("i", function(F.col("c")).alias("v")).orderBy("i").collect()
    return [r.v for r in got]


def check(spark, function, cases):
    assert apply(spark, function, [c for c, _ in cases]) == [v for _, v in cases]


def test_key_normalize(spark):
    check(spark, normalize_key, [
        ("123.456.789-01", "12345678901"),
        (" 12345678901 ", "12345678901"),
        ("00012345678", "00012345678"),
        ("1234567890", None), ("123456789012", None), ("abc", None), ("", None), (None, None),
    ])


def test_key_text(spark):
    check(spark, key_text, [
        ("12345678901.0", "12345678901"), ("12345678901.00", "12345678901"),
        (" 123 ", "123"), ("nan", ""), ("<NA>", ""), (None, ""), ("", ""),
        ("123.456.789-01", "123.456.789-01"), ("1.5", "1.5"), ("nana", "nana"),
    ])


def test_key_mask_is_the_inverse_of_normalize(spark):
    check(spark, mask_key, [("12345678901", "123.456.789-01"), ("123", "123"), (None, None)])
    check(spark, lambda c: normalize_key(mask_key(c)), [("00012345678", "00012345678")])


def test_rejection_reason(spark):
    check(spark, rejection_reason, [
        ("12345678901", None), ("", "cpf_ausente"), (None, "cpf_ausente"), ("abc", "cpf_ausente"),
        ("nan", "cpf_ausente"), ("1234", "cpf_quantidade_digitos_invalida"),
        ("123456789012", "cpf_quantidade_digitos_invalida"), ("123.456.789-01", "cpf_invalido"),
    ])


def test_rejection_reason_reads_the_original_when_given(spark):
    check(spark, lambda c: rejection_reason(normalize_key(c), c), [
        ("123.456.789-01", None), ("1234", "cpf_quantidade_digitos_invalida"), ("x", "cpf_ausente"),
    ])
    # Read from the normalised key, every rejected row looks absent.
    check(spark, lambda c: rejection_reason(normalize_key(c)), [("1234", "cpf_ausente")])


def python_check_digits(stem: str) -> str:
    """The rule in plain arithmetic, for comparison."""
    n = [int(x) for x in stem]
    for count in (9, 10):
        rest = sum((count + 1 - i) * n[i] for i in range(count)) % 11
        n.append(0 if rest < 2 else 11 - rest)
    return "".join(map(str, n))


def test_check_digits(spark):
    stems = [f"{(i * 7919 + 13) % 10**9:09d}" for i in range(400)]
    right = [python_check_digits(s) for s in stems]
    wrong = [k[:10] + str((int(k[10]) + 1) % 10) for k in right]
    assert all(apply(spark, has_valid_check_digits, right))
    assert not any(apply(spark, has_valid_check_digits, wrong))
    check(spark, has_valid_check_digits, [("123", False), ("abcdefghijk", False), (None, False)])


def test_dates(spark):
    d = dt.date
    check(spark, parse_date, [
        ("2020-01-31", d(2020, 1, 31)), ("2020-01-31 10:11:12", d(2020, 1, 31)),
        ("31/01/2020", d(2020, 1, 31)), ("1/2/2020", d(2020, 2, 1)),
        ("31-12-2020", d(2020, 12, 31)), ("1.2.2020", d(2020, 2, 1)), ("20200102", d(2020, 1, 2)),
        ("5 Jan 2020", d(2020, 1, 5)), (" 2020-01-31 ", d(2020, 1, 31)),
        ("", None), ("nan", None), (None, None), ("2020-13-45", None), ("2020-01-01 junk", None),
        ("2020-01-01Tjunk", None), ("31-02-2020", None), ("31/02/2020", None),
        ("2020/02/01", None), ("12-31-2020", None), ("10:00", None), ("01/02/99", None),
        ("today", None), ("2020", None), ("2020-01", None), ("2020-1-5", None), ("1/2-2020", None),
        ("1500-01-01", d(1500, 1, 1)), ("2020-01-01T23:30:00Z", d(2020, 1, 1)),
    ])


def test_load_dates(spark):
    d = dt.date
    check(spark, parse_load_date, [
        ("2020-01-31xyz", d(2020, 1, 31)), ("31/01/2020", d(2020, 1, 31)),
        ("31-01-2020", d(2020, 1, 31)), ("2020-1-5", d(2020, 1, 5)), ("2020.01.31", None),
        ("20200131", None), ("2020", None), ("", None), (None, None), ("31/02/2020", None),
    ])


def test_unreadable_counts_only_text_that_was_given(spark):
    check(spark, lambda c: unreadable(c, parse_date(c)), [
        ("2020-01-01", False), ("12-31-2020", True), ("", False), ("nan", False), (None, False),
    ])


def test_decimal_comma(spark):
    check(spark, decimal_comma, [
        ("1234,56", 1234.56), ("1234.5", 1234.5), (" 12 ", 12.0), ("1e3", 1000.0), ("-,5", -0.5),
        ("1.234,56", None), ("1d", None), ("0x10", None), ("1_000", None), ("inf", None),
        ("nan", None), ("1e999", None), ("-1e999", None), ("", None), (None, None),
    ])


def test_load_decimal_and_round(spark):
    got = apply(spark, lambda c: load_decimal(c, 14, 2).cast("string"), ["1.005", "12", "x", None, "1e15"])
    assert got == ["1.01", "12.00", None, None, None]
    check(spark, lambda c: rounded(decimal_comma(c), 1), [("1,25", 1.3), ("2,04", 2.0)])


def test_category_code(spark):
    check(spark, category_code, [
        ("301", "301"), ("301.0", "301"), ("301.9", "301"), ("-0.5", "0"), ("0302", "302"),
        (" A1 ", "A1"), ("", None), ("  ", None), (None, None), ("1e30", "1e30"), ("nan", "nan"),
    ])


def test_missing_spellings(spark):
    assert len(MISSING_SPELLINGS) == 19
    assert apply(spark, missing_to_null, MISSING_SPELLINGS) == [None] * 19
    check(spark, missing_to_null, [("none", "none"), (" NA", " NA"), ("x", "x"), (None, None)])


def test_text(spark):
    check(spark, blank_to_null, [("", None), (" ", " "), ("a", "a"), (None, None)])
    check(spark, is_missing, [("", True), (None, True), (" ", False)])
    check(spark, lambda c: bounded(c, 2), [("ação", "aç"), ("", None), (None, None)])
    check(spark, name_or_default, [("", "NOME NÃO INFORMADO"), (None, "NOME NÃO INFORMADO"), ("x" * 600, "x" * 512)])


@pytest.mark.parametrize("function", [normalize_key, parse_date, decimal_comma, category_code])
def test_expressions_stay_in_the_jvm(spark, function):
    frame = spark.createDataFrame([("x",)], "c string").select(function(F.col("c")))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_the_key_is_matched_by_one_pattern(spark):
    text = spark.range(1).select(normalize_key(F.lit("1").cast("string")).alias("k"))._jdf.queryExecution().logical().toString()
    assert "regexp_extract" not in text

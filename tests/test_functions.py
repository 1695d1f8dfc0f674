"""Literal edge cases for the scalar functions (FIXTURES.md, decisions D1-D24)."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tally.functions import (clean_key, cnpj_is_valid, comma_decimal, digits_key,
                             normalise_header, normalise_header_col, null_tokens,
                             parse_number, quarter_from_text, quarter_start, state_code,
                             year_from_text)
from tally.functions.taxid import WEIGHTS_1, WEIGHTS_2


def cnpj_check_digits_py(base12):
    """The two check digits, restated in plain Python."""
    def one(ds, weights):
        r = 11 - sum(int(c) * w for c, w in zip(ds, weights)) % 11
        return 0 if r >= 10 else r

    d1 = one(base12, WEIGHTS_1)
    return f"{d1}{one(base12 + str(d1), WEIGHTS_2)}"


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v")).alias("o"), "i").orderBy("i").collect()]


def test_parse_number_br(spark):
    texts = ["1.234,56", "1234.56", "10,00", "-5,00", "abc", "12d", "inf", "", None, "1.5f",
             "0x1F", "1_0", " 7,00 ", "1e3"]
    got = col_values(spark, texts, lambda c: parse_number(c, "br"))
    want = ["1234.56", "123456.00", "10.00", "-5.00", "0.00", "0.00", "0.00", "0.00", "0.00",
            "0.00", "0.00", "0.00", "7.00", "1000.00"]
    assert got == [Decimal(w) for w in want]
    # a number beyond the type is NULL (reported by the ledger), never the default
    assert col_values(spark, ["99999999999999,00", "1e400"], lambda c: parse_number(c, "br")) == [None, None]


def test_parse_number_plain(spark):
    got = col_values(spark, ["1234.56", "1,5", "abc", None], lambda c: parse_number(c, "plain"))
    assert got == [Decimal("1234.56"), Decimal("0.00"), Decimal("0.00"), Decimal("0.00")]


def test_comma_decimal_half_up_and_errors(spark):
    got = col_values(spark, ["1234,565", "1234,564", "-0,125", "x", None], comma_decimal)
    assert got == [Decimal("1234.57"), Decimal("1234.56"), Decimal("-0.13"), None, None]
    df = spark.createDataFrame([("x",)], "v string")
    with pytest.raises(Exception):
        df.select(comma_decimal(F.col("v"), strict=True)).collect()


def test_digits_key_and_clean_key(spark):
    got = col_values(spark, ["12.345/0001-81", "ABC", None, " 42 "], digits_key)
    assert got == [12345000181, None, None, 42]
    got = col_values(spark, [" 100004.0 ", "\t12", "12.0", "12.00", "7"], clean_key)
    assert got == ["100004", "12", "12", "12.00", "7"]


def test_state_code_intent(spark):
    got = col_values(spark, ["N/A", "São Paulo", "SP", None, ""], state_code)
    assert got == [None, "Sã", "SP", None, ""]


def test_null_tokens(spark):
    got = col_values(spark, ["NA", "NULL", "None", "", "N/A", "nan", "x"], null_tokens)
    assert got == [None, None, None, None, None, None, "x"]


def test_header_normalisation():
    assert normalise_header("Razão Social") == "RAZAO_SOCIAL"
    assert normalise_header(" Vl. Saldo Final ") == "VL_SALDO_FINAL"
    assert normalise_header("CD_CONTA_CONTÁBIL") == "CD_CONTA_CONTÁBIL"  # only Ç Ã Õ fold


def test_header_normalisation_column(spark):
    got = col_values(spark, ["Razão Social", " Vl. Saldo Final "], normalise_header_col)
    assert got == ["RAZAO_SOCIAL", "VL_SALDO_FINAL"]


def test_cnpj_cases(spark):
    ids = ["11.222.333/0001-81", "11222333000181", "11222333000182", "11222333000171",
           "00000000000000", "1122233300018", "N/A", "", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(ids)], "i int, v string")
    got = [r[0] for r in df.select(cnpj_is_valid("v"), "i").orderBy("i").collect()]
    assert got == [True, True, False, False, False, False, False, False, False]


def _py_valid(s):
    d = "".join(ch for ch in (s or "") if "0" <= ch <= "9")
    if len(d) != 14 or len(set(d)) == 1:
        return False
    return cnpj_check_digits_py(d[:12]) == d[12:]


def test_cnpj_matches_plain_python(spark):
    rnd = random.Random(7)
    ids = []
    for _ in range(400):
        base = f"{rnd.randrange(10**12):012d}"
        good = base + cnpj_check_digits_py(base)
        ids.append(good if rnd.random() < 0.5 else base + f"{rnd.randrange(100):02d}")
    df = spark.createDataFrame([(i, v) for i, v in enumerate(ids)], "i int, v string")
    got = [r[0] for r in df.select(cnpj_is_valid("v"), "i").orderBy("i").collect()]
    assert got == [_py_valid(v) for v in ids]


def test_cnpj_check_stays_native(spark):
    df = spark.createDataFrame([("11222333000181",)], "v string").select(cnpj_is_valid("v"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


def test_periods(spark):
    df = spark.createDataFrame([(2023, 1), (2024, 4)], "y int, q int")
    got = [str(r[0]) for r in df.select(quarter_start(F.col("y"), F.col("q"))).collect()]
    assert got == ["2023-01-01", "2024-10-01"]
    links = ["1T2023.zip", "2t2023/", "2023/", "leia-me.txt"]
    years = col_values(spark, links, year_from_text)
    quarters = col_values(spark, links, quarter_from_text)
    assert years == [2023, 2023, 2023, None]
    assert quarters == [1, 2, None, None]

import pytest
from pyspark.sql import functions as F

from tallylake.functions import masking
from tallylake.functions.presentation import (
    bar_width,
    brl,
    percent,
    severity_colour,
    severity_label,
    thousands,
)


def _apply(spark, fn, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("given", "masked"),
    [
        ("098.765.432-10", "***.***.**-10"),
        ("7", "***.***.**-7"),
        ("", "***.***.**-"),
        (None, None),
    ],
)
def test_tax_id(spark, given, masked):
    assert _apply(spark, masking.mask_tax_id, given) == masked


@pytest.mark.parametrize(
    ("given", "masked"), [("Prado", "P."), ("É", "É."), ("", "."), (None, None)]
)
def test_surname(spark, given, masked):
    assert _apply(spark, masking.mask_surname, given) == masked


def test_first_name_is_kept(spark):
    df = spark.createDataFrame([("Ana", "Prado", "1-44")], "nome string, sobrenome string, cpf string")
    assert tuple(masking.mask_member(df).first()) == ("Ana", "P.", "***.***.**-44")


@pytest.mark.parametrize(
    ("given", "masked"),
    [("4000100020003000", "************3000"), ("1234", "****"), ("", ""), (None, None)],
)
def test_card_number(spark, given, masked):
    assert _apply(spark, masking.mask_card_number, given) == masked


def test_printed_name_and_email(spark):
    assert _apply(spark, masking.mask_printed_name, "ANA  DO PRADO") == "A.  D. P."
    assert _apply(spark, masking.mask_email, "ana@mail.test") == "a***@mail.test"
    assert _apply(spark, masking.mask_email, "a@mail.test") == "***@mail.test"
    for odd in ("@mail.test", "maria", "", "a b@mail.test", "ana@", "ana@x@mail.test"):
        assert _apply(spark, masking.mask_email, odd) == "***"
    assert _apply(spark, masking.mask_email, None) is None


@pytest.mark.parametrize(
    ("share", "label", "colour"),
    [
        (0.0, "OK", "#1F4D3A"),
        (4.99, "OK", "#1F4D3A"),
        (5.0, "ATENÇÃO", "#B8862C"),
        (14.99, "ATENÇÃO", "#B8862C"),
        (15.0, "CRÍTICO", "#B23A2E"),
        (100.0, "CRÍTICO", "#B23A2E"),
    ],
)
def test_severity(spark, share, label, colour):
    assert _apply(spark, severity_label, share, "double") == label
    assert _apply(spark, severity_colour, share, "double") == colour


@pytest.mark.parametrize(
    ("value", "text"),
    [
        (1234.56, "R$ 1.234,56"),
        (0.0, "R$ 0,00"),
        (-1234567.891, "R$ -1.234.567,89"),
        (0.125, "R$ 0,12"),
    ],
)
def test_money(spark, value, text):
    assert _apply(spark, brl, value, "double") == text


def test_numbers(spark):
    assert _apply(spark, thousands, 1234567, "bigint") == "1,234,567"
    assert _apply(spark, bar_width, 10.0, "double") == 40.0
    assert _apply(spark, bar_width, 25.01, "double") == 100.0


def test_percent(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (2, 2)], "a bigint, b bigint")
    got = [r[0] for r in df.select(percent(F.col("a"), F.col("b"))).collect()]
    assert got == [33.33, 0.0, 100.0]


def test_percent_rounds_like_python(spark):
    pairs = [(n, d) for d in (3, 7, 32, 160, 400, 800, 1000, 4000, 20000) for n in range(0, d + 1, max(1, d // 700))]
    df = spark.createDataFrame(pairs, "a long, b long")
    for a, b, got in df.select("a", "b", percent(F.col("a"), F.col("b"))).collect():
        assert got == round(a / b * 100, 2)

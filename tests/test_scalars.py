import math
import unicodedata

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelloom.functions import scalars as S


@pytest.mark.parametrize(
    ("raw", "plain"),
    [("1.0", "1"), ("10", "10"), ("1e2", "100"), ("+1", "1"), ("01", "1"), ("-0", "-0"), ("NaN", "NaN"), ("abc", "abc"), ("", ""), (None, ""), (" 5 ", "5"), ("2.50", "2.5"), ("03", "3")],
)
def test_codes(spark, raw, plain):
    assert S.normal_code(raw) == plain
    df = spark.createDataFrame([(raw,)], "c string")
    assert df.select(S.cluster_code("c")).first()[0] == plain


def test_codes_in_the_jvm_equal_exact_decimals(spark):
    given = [sign + n + e for sign in ("", "+", "-") for n in ("0", "7", "007", "70", "0.5", ".50", "5.", "12.340", "0.0", "1_0", "٣", "٣.٥٠") for e in ("", "e0", "E+2", "e-1", "e-7", "e12")]
    given += ["nan", "-NaN", "sNaN7", "NaN007", "inf", "+Infinity", "-inf", "e5", ".", "+", "-", "1e", "1.2.3", "1 2", "0x1", "12a", "_", "1" * 25 + ".0"]
    df = spark.createDataFrame([(x,) for x in given], "c string").select("c", S.cluster_code("c"))
    assert [(c, got) for c, got in df.collect() if got != S.normal_code(c)] == []
    assert "Python" not in df._jdf.queryExecution().toString()


def test_numbers(spark):
    given = ["1", " 2.5 ", "-3e2", ".5", "5.", "1d", "1f", "1e400", "nan", "inf", "-Infinity", "1_000", "", " 7　", None, "x"]
    df = spark.createDataFrame(list(enumerate(given)), "i int, c string").select("i", S.to_number("c"))
    got = [r[1] for r in sorted(df.collect())]
    assert got == [1.0, 2.5, -300.0, 0.5, 5.0, None, None, None, None, math.inf, -math.inf, None, None, 7.0, None, None]


def test_ids(spark):
    df = spark.createDataFrame([(" Straße\x1c",), (" ABC",), (None,), ("Σς",)], "c string")
    assert [r[0] for r in df.select(S.fold_id("c")).collect()] == ["strasse", "abc", "", "σσ"]
    assert [r[0] for r in df.select(S.text("c")).collect()] == ["Straße", "ABC", "", "Σς"]


def test_case_folding_equals_pythons(spark):
    letters = [chr(i) for i in [*range(1, 0x3000), *range(0xA000, 0xD7FF), *range(0xF900, 0xFFFE), *range(0x10400, 0x10600)] if unicodedata.category(chr(i)) != "Cn"]  # the JVM may know newer letters
    texts = [*letters, "ΟΔΟΣ", "Straße İstanbul ISPARTA ıẞ", "ΣΣς"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in texts], "c string").select(S.casefold(F.col("c"))).collect()]
    assert [(x, y) for x, y in zip(texts, got, strict=True) if x.casefold() != y] == []


def test_first_filled(spark):
    df = spark.createDataFrame([(None, " ", "c"), ("a ", "b", None), (None, None, None)], "x string, y string, z string")
    assert rows(df.select(S.first_filled(["x", "y", "z"]), S.first_filled_source(["x", "y", "z"]))) == [("", ""), ("a", "x"), ("c", "z")]


def test_excel_serial(spark):
    df = spark.createDataFrame([("2026-03-05 12:00:00",), ("2026-1-1 0:00:00",), ("",), (None,)], "c string")
    assert [r[0] for r in df.select(S.excel_serial("c")).collect()] == [46086.5, 46023.0, None, None]


def test_source_place(spark):
    df = spark.createDataFrame([("f", "3"), ("f", None), (None, "3"), ("", "")], "f string, n string")
    assert [r[0] for r in df.select(S.source_place("f", "n")).collect()] == ["f:3", "f", "line 3", "unknown source"]

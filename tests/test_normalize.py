"""Normalisers on literal rows, including the edge cases of SURVEY §8."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidyload.functions import normalize as N


def run(spark, fn, values, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    rows = df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()
    return [r["o"] for r in rows]


def test_normalize_date(spark):
    vals = ["2023-01-05", " 05/01/2023 ", "01-05-2023", "20230105", "25-12-2023", "05-12-2023",
            "2023-02-30", "2024-02-29", "2023-02-29", "0000-01-01", "2023/01/05", "", None, "\t2023-01-05\n",
            "31/04/2023", "2023-1-05"]
    d = dt.date
    assert run(spark, N.normalize_date, vals) == [
        d(2023, 1, 5), d(2023, 1, 5), d(2023, 1, 5), d(2023, 1, 5),
        None,              # dd-MM-yyyy with day > 12 is read as MM-dd: invalid month
        d(2023, 5, 12),    # dd-MM-yyyy with day <= 12 is swapped (reference behaviour)
        None, d(2024, 2, 29), None, None, None, None, None, d(2023, 1, 5), None, None]


def test_status_customer(spark):
    vals = ["1", "0", "A", "I", "active", "inactive", None, " Y ", "yes", "ACTIVE", "x"]
    assert run(spark, N.normalize_status_customer, vals) == [
        "active", "inactive", "active", "inactive", "active", "inactive", "active", "active", "active",
        "active", "inactive"]


def test_status_order(spark):
    vals = ["P", "pend", " pending ", "0", "c", "CONF", "2", "deliv", "X", "9", None, "?", "cancelled"]
    assert run(spark, N.normalize_status_order, vals) == [
        "pending", "pending", "pending", "pending", "confirmed", "confirmed", "shipped", "delivered",
        "cancelled", "cancelled", "pending", "pending", "cancelled"]


def test_bool(spark):
    vals = ["Y", "n", "1", "0", "yes", "no", "true", "A", "active", None, "x", " y "]
    assert run(spark, N.normalize_bool, vals) == [1, 0, 1, 0, 1, 0, 1, 1, 1, 0, 0, 1]


def test_country(spark):
    vals = ["TN", "Tunisia", " tunisie ", "France", "fr", "Allemagne", "USA", "united states", None,
            "Belgique", " be", "Espagne", "turquie"]
    # unknown names keep the first two letters of the UNSTRIPPED upper text
    assert run(spark, N.normalize_country, vals) == [
        "TN", "TN", "TN", "FR", "FR", "DE", "US", "US", "TN", "BE", " B", "ES", "TR"]


def test_currency(spark):
    assert run(spark, N.normalize_currency, ["tnd", " eur ", "USD", None, "euro"]) == [
        "TND", "EUR", "USD", "TND", "EUR"]


def test_phone(spark):
    vals = ["+216 22 333 444", "0021622333444", "22-333-444", "22333444", "21622333444", "2162233",
            "(+216) 22.333.444", None, "123", "0033612345678"]
    assert run(spark, N.normalize_phone, vals) == [
        "+21622333444", "+21622333444", "+21622333444", "+21622333444", "+21622333444", None,
        "+21622333444", None, None, "0033612345678"]


def test_strip_is_python_strip(spark):
    vals = [" a ", "\ta\n", " a　", "a b", None]
    assert run(spark, N.strip, vals) == [v.strip() if v is not None else None for v in vals]


def test_to_number_text(spark):
    vals = ["12", " 12.5 ", "1e3", "12d", "NaN", "inf", "", "-3", ".5", None]
    assert run(spark, lambda c: N.to_number(c, "string"), vals) == [
        12.0, 12.5, 1000.0, None, None, None, None, -3.0, 0.5, None]


def test_to_number_nan_double(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5), (3, None)], "i int, v double")
    out = [r["o"] for r in df.select("i", N.to_number(F.col("v"), "double").alias("o")).orderBy("i").collect()]
    assert out == [None, 1.5, None]


def test_clip_keeps_null(spark):
    assert run(spark, lambda c: N.clip_lower(c, 0), [-1.0, None, 3.0], "double") == [0.0, None, 3.0]
    assert run(spark, lambda c: N.clip(c, 0, 5), [-1.0, None, 7.0, 2.0], "double") == [0.0, None, 5.0, 2.0]


def test_to_int_truncates(spark):
    assert run(spark, N.to_int, [1.9, -1.9, 3.0], "double") == [1, -1, 3]


@pytest.mark.parametrize("fn", [N.normalize_status_customer, N.normalize_status_order, N.normalize_country,
                                N.normalize_currency, N.normalize_phone])
def test_idempotent(spark, fn):
    vals = ["1", "0", "A", " pend ", "Tunisie", "France", "tnd", "+216 22 333 444", "22333444", None, "xyz"]
    once = run(spark, fn, vals)
    twice = run(spark, fn, once)
    assert once == twice

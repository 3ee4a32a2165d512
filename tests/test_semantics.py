"""Cross-cutting rules: London dates and shifts, site labels, NULL handling,
number and date cleaning."""

import datetime as dt

from pyspark.sql import functions as F

from hearth.functions import semantics as S


def _one(spark, expr, value, ddl):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("o")).first()["o"]


def test_business_date_uses_london(spark):
    # 23:30 UTC in July is 00:30 the next day in London (BST)
    ts = dt.datetime(2024, 7, 1, 23, 30)
    assert _one(spark, S.business_date(F.col("t")), ts, "t timestamp") == dt.date(2024, 7, 2)
    # in January London is UTC
    ts = dt.datetime(2024, 1, 1, 23, 30)
    assert _one(spark, S.business_date(F.col("t")), ts, "t timestamp") == dt.date(2024, 1, 1)


def test_shift_bands_and_null(spark):
    rows = [(dt.datetime(2024, 1, 5, 12, 0),), (dt.datetime(2024, 1, 5, 16, 59),), (dt.datetime(2024, 1, 5, 17, 0),),
            (dt.datetime(2024, 1, 5, 21, 59),), (dt.datetime(2024, 1, 5, 22, 0),), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t timestamp").select(S.shift_of("t")).collect()]
    assert got == ["Lunch (12-5)", "Lunch (12-5)", "Dinner (5-10)", "Dinner (5-10)", "Other", "Other"]


def test_shift_falls_back_to_second_time(spark):
    df = spark.createDataFrame([(None, dt.datetime(2024, 1, 5, 13, 0))], "a timestamp, b timestamp")
    assert df.select(S.shift_of("a", "b")).first()[0] == "Lunch (12-5)"


def test_site_label_and_key(spark):
    df = spark.createDataFrame([("Tap Harbour.",), ("Quay",), ("Tap  X..",)], "n string")
    labels = [r[0] for r in df.select(S.clean_site_label("n")).collect()]
    assert labels == ["Harbour", "Quay", " X"]
    keys = [r[0] for r in df.select(S.site_key("n")).collect()]
    assert keys == ["harbour", "quay", "x"]


def test_not_cancelled_treats_null_as_live(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "c boolean")
    assert [r[0] for r in df.select(S.not_cancelled("c")).collect()] == [False, True, True]


def test_clean_num(spark):
    df = spark.createDataFrame([("£1,234.50",), ("12%",), ("abc",), ("-3",), (None,)], "s string")
    got = [r[0] for r in df.select(S.clean_num("s")).collect()]
    assert got == [1234.5, 12.0, None, -3.0, None]
    na = [r[0] for r in spark.createDataFrame([("N/A",), ("-",), ("4.5",)], "s string")
          .select(S.clean_num_na("s")).collect()]
    assert na == [None, None, 4.5]


def test_clean_int_is_half_even(spark):
    df = spark.createDataFrame([("2.5",), ("3.5",)], "s string")
    assert [r[0] for r in df.select(S.clean_int("s")).collect()] == [2, 4]


def test_parse_date_order_matters(spark):
    df = spark.createDataFrame([("3/4/2026",), ("25/12/2025",), ("2026-01-02 10:00",), ("1/2/26",), ("x",)], "s string")
    us_first = [r[0] for r in df.select(S.parse_date("s")).collect()]
    assert us_first == [dt.date(2026, 3, 4), dt.date(2025, 12, 25), dt.date(2026, 1, 2), dt.date(2026, 1, 2), None]
    uk_first = [r[0] for r in df.select(S.parse_date("s", S.DATE_FORMATS_REVIEWS)).collect()]
    assert uk_first[0] == dt.date(2026, 4, 3)


def test_round_div_is_exact_half_up(spark):
    df = spark.createDataFrame([("100130.31", 6), ("1.0", 0)], "n string, d int")
    got = [r[0] for r in df.select(S.round_div(F.col("n").cast("decimal(20,4)"), "d", 2)).collect()]
    assert got == [16688.39, None]

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluice.functions import casts, timez
from sluice.functions.text import parse_codes, split_codes


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("bad", ["abc", "", "225.0"])
def test_int64_is_strict(spark, bad):
    with pytest.raises(Exception, match="cannot cast to INT64"):
        one(spark, casts.to_int64("s"), bad)


def test_null_passes_every_cast(spark):
    assert one(spark, casts.to_int64("s"), None) is None
    assert one(spark, casts.to_numeric("s"), None) is None
    assert one(spark, casts.to_date("s"), None) is None
    assert one(spark, timez.local_to_utc("s", "America/Sao_Paulo"), None) is None


def test_numeric_rounds_half_away_from_zero(spark):
    assert one(spark, casts.to_numeric("s"), "1.0000000005") == Decimal("1.000000001")
    assert one(spark, casts.to_numeric("s"), "-1.0000000005") == Decimal("-1.000000001")
    with pytest.raises(Exception, match="NUMERIC"):
        one(spark, casts.to_numeric("s"), "12,5")


def test_date_of_datetime_text(spark):
    assert one(spark, casts.to_date("s"), "2017-09-19 09:45:35") == dt.date(2017, 9, 19)


def test_local_to_utc_and_back(spark):
    zone = "America/Sao_Paulo"
    # standard time (UTC-3)
    assert one(spark, timez.local_to_utc("s", zone), "2018-06-01 10:00:00") == dt.datetime(2018, 6, 1, 13)
    # a daylight-saving gap moves forward: midnight did not exist that day
    assert one(spark, timez.local_to_utc("s", zone), "2017-10-15 00:30:00") == dt.datetime(2017, 10, 15, 3, 30)
    # 23:30 local is the next day in UTC, but the local date stays
    df = spark.createDataFrame([("2018-07-01 23:30:00",)], "s string")
    r = df.select(timez.local_to_utc("s", zone).alias("u")).select(
        "u", timez.utc_to_local_date("u", zone).alias("local"), timez.utc_date("u").alias("utc")).first()
    assert r["u"] == dt.datetime(2018, 7, 2, 2, 30)
    assert r["local"] == dt.date(2018, 7, 1)
    assert r["utc"] == dt.date(2018, 7, 2)
    with pytest.raises(Exception, match="TIMESTAMP"):
        one(spark, timez.local_to_utc("s", zone), "not a time")


def test_exact_decimal_helpers(spark):
    df = spark.createDataFrame([("0.88", "4.30")], "a string, b string").select(
        casts.to_numeric("a").alias("a"), casts.to_numeric("b").alias("b"))
    r = df.select(casts.exact_ratio("a", "b").alias("q"),
                  F.round(casts.exact_product(F.lit(Decimal("2.345")), F.lit(Decimal("1"))), 2).alias("p"),
                  F.round(casts.exact_product(F.lit(Decimal("-2.345")), F.lit(Decimal("1"))), 2).alias("n"),
                  casts.exact_add("a", "b").alias("s")).first()
    assert r["q"] == Decimal("0.204651163")
    assert r["p"] == Decimal("2.35") and r["n"] == Decimal("-2.35")
    assert r["s"] == Decimal("5.18")
    with pytest.raises(Exception, match="division by zero"):
        df.select(casts.exact_ratio("a", F.lit(Decimal("0"))).alias("q")).collect()


def test_weekday_and_codes(spark):
    assert one(spark, timez.weekday_name(F.to_date("s")), "2024-01-06") == "Saturday"
    assert one(spark, timez.is_weekend(F.to_date("s")), "2024-01-07") is True
    assert one(spark, split_codes("s"), " gbp, brl,, ") == ["GBP", "BRL"]
    assert parse_codes("gbp, brl,,") == ["GBP", "BRL"]
    with pytest.raises(ValueError):
        parse_codes(" , ")


def test_log_helpers(spark):
    from sluice.functions.text import clip_text, path_join

    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 1, 8, 0, 1, 500000),
                                 "x" * 2500, "shop", "orders")],
                               "a timestamp_ntz, b timestamp_ntz, err string, src string, t string")
    r = df.select(timez.seconds_between("a", "b").alias("s"), clip_text("err").alias("e"),
                  path_join("src", "t", F.lit("load_date=2024-01-01")).alias("p")).first()
    assert r["s"] == 1.5 and len(r["e"]) == 2000 and r["p"] == "shop/orders/load_date=2024-01-01"


def test_ambiguous_local_hour_takes_earlier_offset(spark):
    zone = "America/Sao_Paulo"
    df = spark.createDataFrame([("2018-02-17 23:30:00",)], "s string").select(
        timez.local_to_utc("s", zone).alias("u"))
    r = df.select("u", timez.utc_to_local_date("u", zone).alias("d")).first()
    assert r["u"] == dt.datetime(2018, 2, 18, 1, 30)      # daylight time (-02) chosen
    assert r["d"] == dt.date(2018, 2, 17)                 # the local day does not move


@pytest.fixture
def ansi_off(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield
    spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("bad", ["abc", "", "225.0"])
def test_strict_without_ansi(spark, ansi_off, bad):
    with pytest.raises(Exception, match="cannot cast to INT64"):
        one(spark, casts.to_int64("s"), bad)


def test_decimal_operands_too_large_raise_without_ansi(spark, ansi_off):
    big = Decimal("12345678901.5")          # 11 integer digits: does not fit decimal(18,9)
    df = spark.createDataFrame([(big, Decimal("2"))], "a decimal(38,9), b decimal(38,9)")
    with pytest.raises(Exception, match="operand too large"):
        df.select(casts.exact_ratio("a", "b")).collect()
    assert df.select(casts.exact_add("a", "b").alias("s")).first()["s"] == Decimal("12345678903.5")

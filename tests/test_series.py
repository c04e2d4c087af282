import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluice.operators import series
from sluice.plans import fx_daily

from conftest import rows

D = dt.date


def rates(spark, data):
    return spark.createDataFrame(
        [(c, D.fromisoformat(d), Decimal(v)) for c, d, v in data],
        "currency string, rate_date date, rate_per_eur decimal(38,9)")


FIXTURE = [
    # first day: only GBP -> a gap; calendar starts on the first complete day
    ("GBP", "2018-01-01", "0.88"),
    ("GBP", "2018-01-02", "0.88"), ("BRL", "2018-01-02", "4.30"),
    ("GBP", "2018-01-03", "0.89"), ("BRL", "2018-01-03", "4.31"),
    # 2018-01-04: one currency only -> a gap
    ("GBP", "2018-01-04", "0.90"),
    ("GBP", "2018-01-05", "0.90"), ("BRL", "2018-01-05", "4.50"),
    # weekend 06/07 missing, Monday present
    ("GBP", "2018-01-08", "0.91"), ("BRL", "2018-01-08", "4.55"),
    ("USD", "2018-01-09", "1.20"),
]


def test_forward_fill_both_forms_agree(spark):
    stg = rates(spark, FIXTURE)
    dense = fx_daily.rates_daily(stg)
    window = fx_daily.rates_daily_window_form(stg)
    cols = ["rate_date", "gbp_per_brl", "last_ecb_date", "is_forward_filled"]
    assert rows(dense, *cols) == rows(window, *cols)
    got = {r["rate_date"]: r for r in dense.collect()}
    assert min(got) == D(2018, 1, 2) and max(got) == D(2018, 1, 8) and len(got) == 7
    assert got[D(2018, 1, 2)]["gbp_per_brl"] == Decimal("0.204651163")
    assert got[D(2018, 1, 4)]["last_ecb_date"] == D(2018, 1, 3)
    assert got[D(2018, 1, 4)]["is_forward_filled"] is True
    assert got[D(2018, 1, 7)]["last_ecb_date"] == D(2018, 1, 5)
    assert got[D(2018, 1, 8)]["is_forward_filled"] is False


def test_single_day_no_days_and_zero_rate(spark):
    one = rates(spark, [("GBP", "2018-01-02", "0.88"), ("BRL", "2018-01-02", "4.30")])
    assert fx_daily.rates_daily(one).count() == 1
    assert fx_daily.rates_daily_window_form(one).count() == 1
    none = rates(spark, [("GBP", "2018-01-02", "0.88")])
    assert fx_daily.rates_daily(none).count() == 0
    assert fx_daily.rates_daily_window_form(none).count() == 0
    zero = rates(spark, [("GBP", "2018-01-02", "0.88"), ("BRL", "2018-01-02", "0")])
    with pytest.raises(Exception, match="division by zero"):
        fx_daily.rates_daily(zero).collect()


def test_pivot_calendar_and_gaps(spark):
    stg = rates(spark, FIXTURE)
    piv = {r["ecb_date"]: r for r in fx_daily.pivoted_rates(stg).collect()}
    assert D(2018, 1, 9) not in piv                    # USD filtered before the pivot
    assert piv[D(2018, 1, 4)]["brl_per_eur"] is None
    days = fx_daily.cross_rate_days(stg)
    cal = series.calendar(series.date_bounds(days, "ecb_date"), out="rate_date")
    gaps = rows(series.calendar_gaps(cal, days, "rate_date", "ecb_date"))
    assert gaps == [(D(2018, 1, 4),), (D(2018, 1, 6),), (D(2018, 1, 7),)]
    empty = series.calendar(series.date_bounds(days.limit(0), "ecb_date"))
    assert empty.count() == 0


def test_dense_and_window_forward_fill_agree_on_driver_data(spark):
    import os

    from sluice.plans import models

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        return
    stg = models.stg_fx(spark, d)
    cols = ["rate_date", "gbp_per_brl", "last_ecb_date", "is_forward_filled"]
    dense = fx_daily.rates_daily(stg)
    assert rows(dense, *cols) == rows(fx_daily.rates_daily_window_form(stg), *cols)
    assert dense.count() > 2000

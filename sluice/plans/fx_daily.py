"""Daily cross-rate calendar: one row per day from the first to the last day
on which both currencies were quoted, with the rate of the last such day.

    rates (currency, rate_date, rate_per_eur)
      -> pivot to one row per day (membership filter pushed into the scan)
      -> cross rate on days that have both (exact, 9 places)
      -> dense days with forward fill (spans between observation days)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import NUMERIC
from ..functions.timez import weekday_name
from ..operators import series

# The quote currency, the base currency, output names.
QUOTE_CCY = "GBP"
BASE_CCY = "BRL"


def pivoted_rates(stg_fx: DataFrame) -> DataFrame:
    return series.pivot_values(
        stg_fx.withColumnRenamed("rate_date", "ecb_date"), "ecb_date", "currency",
        "rate_per_eur", {"gbp_per_eur": QUOTE_CCY, "brl_per_eur": BASE_CCY})


def cross_rate_days(stg_fx: DataFrame) -> DataFrame:
    """(ecb_date, gbp_per_brl) on complete days only."""
    return series.complete_ratio(pivoted_rates(stg_fx), "ecb_date", "gbp_per_eur",
                                 "brl_per_eur", "gbp_per_brl")


def rates_daily(stg_fx: DataFrame) -> DataFrame:
    """rate_date, gbp_per_brl, last_ecb_date, is_forward_filled."""
    days = cross_rate_days(stg_fx)
    return series.forward_fill_dense(days, "ecb_date", ["gbp_per_brl"], "rate_date",
                                     "last_ecb_date", flag="is_forward_filled")


def rates_daily_window_form(stg_fx: DataFrame) -> DataFrame:
    """Same output by the calendar + last-non-NULL window form."""
    days = cross_rate_days(stg_fx)
    cal = series.calendar(series.date_bounds(days, "ecb_date"), out="rate_date")
    return series.forward_fill_window(cal, days, "rate_date", "ecb_date", ["gbp_per_brl"],
                                      "last_ecb_date", flag="is_forward_filled")


def _fx_year(fx: DataFrame, year: int) -> DataFrame:
    return fx.filter(F.col("rate_date").between(F.lit(f"{year}-01-01").cast("date"),
                                                F.lit(f"{year}-12-31").cast("date")))


def days_rule(fx: DataFrame, year: int) -> DataFrame:
    """Rule 1: a row only when the year does not have 365 days."""
    n = _fx_year(fx, year).agg(F.count(F.lit(1)).alias("n"))
    return n.filter(F.col("n") != 365).select(
        F.lit(f"expected 365 rows for {year}").alias("problem"),
        F.lit(None).cast("date").alias("rate_date"),
        F.col("n").cast(NUMERIC).alias("value"))


def fx_sanity(fx: DataFrame, year: int, low: float, high: float, stale_days: int) -> DataFrame:
    """The four calendar rules, one problem row each."""
    rate = F.col("gbp_per_brl")
    out_of_range = (_fx_year(fx, year).filter(rate.isNull() | ~rate.between(low, high))
                    .select(F.lit(f"gbp_per_brl outside {low}-{high} in {year}").alias("problem"),
                            "rate_date", rate.cast(NUMERIC).alias("value")))
    weekend = (fx.filter(weekday_name("rate_date").isin("Saturday", "Sunday")
                         & (~F.col("is_forward_filled") | (F.col("last_ecb_date") >= F.col("rate_date"))))
               .select(F.lit("weekend not forward-filled").alias("problem"), "rate_date",
                       rate.cast(NUMERIC).alias("value")))
    stale = (fx.filter(F.date_diff("rate_date", "last_ecb_date") > stale_days)
             .select(F.lit(f"rate older than {stale_days} days").alias("problem"), "rate_date",
                     rate.cast(NUMERIC).alias("value")))
    return days_rule(fx, year).union(out_of_range).union(weekend).union(stale)

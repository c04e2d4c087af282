"""Time-series operators: pivot to columns, ratio of two series, dense calendar,
gap detection and forward fill (two forms).

Scale notes
-----------
The dense calendar and the forward fill run over *observation days*, whose
number is bounded by the calendar, not by the data volume.  ``forward_fill_dense``
(the scalable form) never runs a window over the dense side: it finds each
observation's successor with ``next_in_order`` (``lead`` per series and year,
with a one-row-per-year carry across years) and explodes the day range it
covers.  ``forward_fill_window`` keeps the textbook form (calendar left join
observations, last non-NULL value over an unpartitioned running frame) for
comparison and for small inputs.  The running last-non-NULL of groups that may be
hot and the as-of lookup are in ``operators.scan``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casts import exact_ratio


def pivot_values(df: DataFrame, key: str, pivot_col: str, value: str,
                 columns: dict[str, str]) -> DataFrame:
    """One row per ``key``; ``columns`` maps output name -> pivot value.

    Conditional max per value (``max(if(pivot = v, value, NULL))``) with the value
    list given up front, so no extra job discovers the distinct values.  The
    membership filter in front lets Parquet skip the other keys.
    """
    wanted = list(columns.values())
    aggs = [F.max(F.when(F.col(pivot_col) == F.lit(v), F.col(value))).alias(name)
            for name, v in columns.items()]
    return df.filter(F.col(pivot_col).isin(wanted)).groupBy(key).agg(*aggs)


def complete_ratio(df: DataFrame, key: str, num: str, den: str, out: str) -> DataFrame:
    """``num / den`` (exact, 9 places) on rows where both are present."""
    return (df.filter(F.col(num).isNotNull() & F.col(den).isNotNull())
              .select(F.col(key), exact_ratio(num, den).alias(out)))


def date_bounds(df: DataFrame, date_col: str, by: Sequence[str] = (),
                first: str = "first_date", last: str = "last_date") -> DataFrame:
    """min / max date (per series); no rows -> one row of NULLs when unkeyed."""
    aggs = [F.min(date_col).alias(first), F.max(date_col).alias(last)]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def calendar(bounds: DataFrame, out: str = "rate_date", first: str = "first_date",
             last: str = "last_date", by: Sequence[str] = ()) -> DataFrame:
    """Every day from first to last inclusive; NULL bounds give no rows."""
    return bounds.select(*by, F.explode(F.sequence(F.col(first), F.col(last))).alias(out))


def calendar_gaps(days: DataFrame, observed: DataFrame, day_col: str, obs_col: str) -> DataFrame:
    """Calendar days without an observation (calendar left join observed)."""
    joined = days.join(observed.select(F.col(obs_col)), F.col(day_col) == F.col(obs_col), "left")
    return joined.filter(F.col(obs_col).isNull()).select(day_col)


def next_in_order(df: DataFrame, date_col: str, by: Sequence[str] = (), out: str = "_next",
                  bucket: str = "year") -> DataFrame:
    """``lead(date_col)`` per series without a window over the whole series.

    The window runs per (series, bucket); the last row of a bucket takes the
    first date of the next bucket that has rows, from a summary with one row
    per (series, bucket) -- the only unpartitioned window when there is a
    single series, over a handful of rows.
    """
    from .joins import sized_side

    b = df.withColumn("_bkt", F.date_trunc(bucket, F.col(date_col)).cast("date"))
    local = b.withColumn("_local_next", F.lead(date_col).over(
        Window.partitionBy(*by, "_bkt").orderBy(date_col)))
    firsts = b.groupBy(*by, "_bkt").agg(F.min(date_col).alias("_first"))
    w = Window.partitionBy(*by).orderBy("_bkt") if by else Window.orderBy("_bkt")
    carry = firsts.select(*by, "_bkt", F.lead("_first").over(w).alias("_carry"))
    if by:
        carry, small = sized_side(carry)      # series x buckets: counted before broadcast
    else:
        # One row per bucket of a DATE (years 1..9999): a bound that holds by
        # construction, so no counting job is needed.
        small = bucket in ("year", "quarter", "month")
    joined = local.join(F.broadcast(carry) if small else carry, [*by, "_bkt"], "left")
    return (joined.withColumn(out, F.coalesce(F.col("_local_next"), F.col("_carry")))
                  .drop("_bkt", "_local_next", "_carry"))


def forward_fill_dense(obs: DataFrame, date_col: str, values: Sequence[str],
                       out_date: str, last_obs: str, flag: str | None = None,
                       by: Sequence[str] = ()) -> DataFrame:
    """Dense daily series from the first to the last observation, each day
    carrying the values of the last observation on or before it.

    ``obs`` holds one row per (series, observation day) with non-NULL values.
    Each observation's successor comes from ``next_in_order`` (windows per
    series and year); each observation then explodes into the days it covers.
    """
    spans = next_in_order(obs.select(*by, F.col(date_col), *values), date_col, by, "_next")
    until = F.coalesce(F.date_sub(F.col("_next"), 1), F.col(date_col))
    out = spans.select(*by, F.explode(F.sequence(F.col(date_col), until)).alias(out_date),
                       *values, F.col(date_col).alias(last_obs))
    if flag:
        out = out.withColumn(flag, F.col(last_obs) != F.col(out_date))
    return out


def forward_fill_window(days: DataFrame, obs: DataFrame, day_col: str, obs_date: str,
                        values: Sequence[str], last_obs: str, flag: str | None = None) -> DataFrame:
    """Reference form: calendar left join observations, then
    ``last_value(x IGNORE NULLS)`` over rows unbounded preceding .. current row."""
    joined = days.join(obs.select(obs_date, *values), F.col(day_col) == F.col(obs_date), "left")
    w = Window.orderBy(day_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = [F.last(v, ignorenulls=True).over(w).alias(v) for v in values]
    out = joined.select(F.col(day_col), *cols,
                        F.last(obs_date, ignorenulls=True).over(w).alias(last_obs))
    if flag:
        out = out.withColumn(flag, F.col(last_obs) != F.col(day_col))
    return out


def last_non_null(df: DataFrame, value: Column, by: Sequence[str], order: Sequence[Column],
                  out: str) -> DataFrame:
    """Running ``last_value(value IGNORE NULLS)`` per group, rows frame."""
    w = (Window.partitionBy(*by).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))

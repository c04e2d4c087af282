"""Proof queries: one per operator of the inventory, each over the driver's
tables (whole tables; no id subsets or row caps), each with an oracle SQL of
the same name in ``oracle_sql``.  Output columns carry explicit types.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import INT64, NUMERIC, to_numeric
from ..functions.timez import local_to_utc, utc_to_local_date, weekday_name
from ..operators import keyed, quality, runlog, scan, series, zones
from ..operators.joins import join_small
from ..operators.tables import VersionedTable, high_water_mark_frame, with_audit
from ..session import new_work_dir
from . import fx_daily, orders_mart, rate_load, raw_tables
from .models import (fct_orders, fx_rates_daily, stg_customers, stg_fx, stg_items,
                     stg_orders, stg_payments, stg_payments_by_quantity, stg_sellers)
from .staging import BUSINESS_ZONE, products_counted_photos, stage

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def proof(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# Fixed parameters of the proof queries (chosen once, the same at every scale).
CHECK_YEAR = 1998            # year whose calendar must be complete
LEAP_YEAR = 1996             # a year with 366 days: the count rule must fire
RATE_LOW, RATE_HIGH = 0.5, 2.0
STALE_DAYS = 2
PRICE_LOW, PRICE_HIGH = 100000, 400000
FRESHNESS_NOW = dt.datetime(2024, 2, 1)
WARN_DAYS, ERROR_DAYS = 4, 6
AUDIT_URI = "landing/tpch/customers/load_date=2024-01-01/customers.csv"
REQUESTED_CCY = ["GBP", "BRL", "XXX"]


# ---------------------------------------------------------------- staging

@proof
def q_stg_orders(spark, d):
    return stg_orders(spark, d)


def _zone_changes(spark, d):
    """Transitions of the business zone over the span of the orders (two scalars)."""
    lo, hi = raw_tables.table(spark, d, "orders").agg(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    one = dt.timedelta(days=2)
    return zones.transitions(spark, BUSINESS_ZONE, lo - one, hi + one)


@proof
def q_local_times(spark, d):
    """Purchase times with their UTC instant by the rule for repeated times, and both dates."""
    wall = raw_tables.raw_orders(spark, d).select(
        "order_id", F.col("order_purchase_timestamp").cast("timestamp_ntz").alias("wall"))
    changes = _zone_changes(spark, d)
    first = zones.resolve_wall_clock(wall, "wall", BUSINESS_ZONE, changes, "earlier")
    both = zones.resolve_wall_clock(first.withColumnRenamed("wall_kind", "kind"), "wall", BUSINESS_ZONE, changes, "later",
                                    out="at_utc_later")
    return both.select("order_id", "wall", F.col("kind").alias("wall_kind"), "at_utc", "at_utc_later",
                       F.to_date("at_utc").alias("utc_date"), utc_to_local_date("at_utc", BUSINESS_ZONE).alias("local_date"))


@proof
def q_zone_transitions(spark, d):
    """Days of the orders on which the zone skips or repeats wall-clock times."""
    days = raw_tables.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("wall_date")).distinct()
    changes = _zone_changes(spark, d).select(F.to_date("wall_from").alias("wall_date"), "kind", "wall_from")
    return changes.join(days, "wall_date", "left_semi")


@proof
def q_stg_customers(spark, d):
    return stg_customers(spark, d)


@proof
def q_stg_sellers(spark, d):
    return stg_sellers(spark, d)


@proof
def q_stg_reviews(spark, d):
    return stage(raw_tables.raw_order_reviews(spark, d), "order_reviews")


@proof
def q_stg_geolocation(spark, d):
    return stage(raw_tables.raw_geolocation(spark, d), "geolocation")


@proof
def q_stg_translation(spark, d):
    return stage(raw_tables.raw_category_translation(spark, d), "product_category_name_translation")


@proof
def q_stg_order_items(spark, d):
    return stg_items(spark, d)


@proof
def q_stg_payments(spark, d):
    return stg_payments(spark, d)


@proof
def q_stg_fx(spark, d):
    return stg_fx(spark, d)


@proof
def q_filter_in(spark, d):
    fx = stg_fx(spark, d)
    return (fx.filter(F.col("currency").isin("GBP", "USD")
                      & weekday_name("rate_date").isin("Monday", "Friday"))
              .select("currency", "rate_date", "rate_per_eur"))


@proof
def q_range_filter(spark, d):
    fx = stg_fx(spark, d)
    r = F.col("rate_per_eur")
    return (fx.filter(F.col("rate_date").between(F.lit("1997-01-01").cast("date"),
                                                 F.lit("1998-12-31").cast("date"))
                      & (r.isNull() | ~r.between(PRICE_LOW, PRICE_HIGH)))
              .select("currency", "rate_date", "rate_per_eur"))


# ---------------------------------------------------------------- keyed aggregates

@proof
def q_items_by_order(spark, d):
    return orders_mart.items_by_order(stg_items(spark, d))


@proof
def q_left_join_no_fanout(spark, d):
    items = orders_mart.items_by_order(stg_items(spark, d))
    return (stg_orders(spark, d).select("order_id").join(items, "order_id", "left")
            .select("order_id", F.coalesce("item_count", F.lit(0)).cast(INT64).alias("item_count"),
                    "items_value", "freight_value"))


@proof
def q_payments_by_type(spark, d):
    return orders_mart.payments_by_type(stg_payments(spark, d))


@proof
def q_payments_by_order(spark, d):
    return orders_mart.payments_by_order(stg_payments(spark, d))


@proof
def q_row_number(spark, d):
    return (orders_mart.ranked_payment_types(stg_payments_by_quantity(spark, d))
            .select("order_id", "payment_type", "type_amount", "first_sequential",
                    F.col("type_rank").cast(INT64).alias("type_rank")))


@proof
def q_main_payment_type(spark, d):
    return (orders_mart.payments_by_order(stg_payments_by_quantity(spark, d))
            .select("order_id", "main_payment_type"))


# ---------------------------------------------------------------- series

@proof
def q_pivot_rates(spark, d):
    return fx_daily.pivoted_rates(stg_fx(spark, d))


@proof
def q_fx_cross_rate(spark, d):
    return fx_daily.cross_rate_days(stg_fx(spark, d))


@proof
def q_bounds(spark, d):
    return series.date_bounds(fx_daily.cross_rate_days(stg_fx(spark, d)), "ecb_date")


@proof
def q_calendar(spark, d):
    days = fx_daily.cross_rate_days(stg_fx(spark, d))
    return series.calendar(series.date_bounds(days, "ecb_date"), out="rate_date")


@proof
def q_calendar_gaps(spark, d):
    days = fx_daily.cross_rate_days(stg_fx(spark, d))
    cal = series.calendar(series.date_bounds(days, "ecb_date"), out="rate_date")
    return series.calendar_gaps(cal, days, "rate_date", "ecb_date")


@proof
def q_forward_fill(spark, d):
    return fx_rates_daily(spark, d)


def _orders_with_day(spark, d):
    return stg_orders(spark, d).select(
        "order_id", utc_to_local_date("purchased_at", BUSINESS_ZONE).alias("purchase_date"))


@proof
def q_fx_lookup(spark, d):
    fx = fx_rates_daily(spark, d).select(F.col("rate_date").alias("purchase_date"),
                                         "gbp_per_brl", "is_forward_filled")
    return join_small(_orders_with_day(spark, d), fx, "purchase_date", "left")


@proof
def q_asof_rate(spark, d):
    days = fx_daily.cross_rate_days(stg_fx(spark, d))
    return scan.asof_join(_orders_with_day(spark, d), "purchase_date", days, "ecb_date", ["gbp_per_brl"]).select(
        "order_id", "purchase_date", "ecb_date", "gbp_per_brl")


@proof
def q_asof_by_key(spark, d):
    """Every event that is no purchase with its user's last purchase up to then."""
    e = raw_tables.table(spark, d, "events").withColumn("value", F.col("value").cast("decimal(18,2)"))
    bought = e.filter(F.col("event_type") == "purchase").select("user_id", "ts", F.col("value").alias("purchase_value"))
    others = e.filter(F.col("event_type") != "purchase").select("event_id", "user_id", F.col("ts").alias("event_ts"))
    return scan.asof_join(others, "event_ts", bought, "ts", ["purchase_value"], by=["user_id"],
                          out_at="purchase_ts").select("event_id", "user_id", "purchase_ts", "purchase_value")


@proof
def q_last_ignore_nulls(spark, d):
    e = raw_tables.table(spark, d, "events")
    purchase = F.when(F.col("event_type") == "purchase", F.col("value").cast("decimal(18,2)"))
    # per user, in (ts, event_id) order; a user with a large share of the events lies in several parts
    out = scan.running(e, ["user_id"], ["ts", "event_id"], last={"last_purchase_value": purchase})
    return out.select("event_id", "user_id", "last_purchase_value")


@proof
def q_last_n_per_key(spark, d):
    e = raw_tables.table(spark, d, "events")
    out = keyed.last_n_per_key(e, "user_id", [F.col("ts").desc(), F.col("event_id").desc()], 3)
    return out.select("user_id", "event_id", "ts", F.col("recency").cast(INT64).alias("recency"))


# ---------------------------------------------------------------- the order fact

@proof
def q_fct_orders(spark, d):
    return fct_orders(spark, d)


# ---------------------------------------------------------------- aggregates with conditions

@proof
def q_count_if(spark, d):
    pays = stg_payments(spark, d)
    return (pays.agg(F.count_if(F.col("payment_installments") > 1).cast(INT64)
                     .alias("n_with_instalments"))
                .withColumn("fails", F.col("n_with_instalments") == 0))


@proof
def q_count_non_null_grouped(spark, d):
    out = products_counted_photos(raw_tables.raw_products(spark, d))
    return out.drop("_loaded_at")


@proof
def q_having_no_group(spark, d):
    return fx_daily.days_rule(fx_rates_daily(spark, d), LEAP_YEAR)


# ---------------------------------------------------------------- assertions

@proof
def q_assert_fx_sane(spark, d):
    return fx_daily.fx_sanity(fx_rates_daily(spark, d), CHECK_YEAR, RATE_LOW, RATE_HIGH, STALE_DAYS)


def _shipments(spark, d) -> DataFrame:
    items = raw_tables.raw_order_items(spark, d).select(
        "order_id", "order_item_id",
        local_to_utc("shipping_limit_date", BUSINESS_ZONE).alias("shipped_at"))
    orders = stg_orders(spark, d).select("order_id", "order_status", "purchased_at")
    return items.join(orders, "order_id", "inner")


def event_order_faults(spark, d) -> DataFrame:
    return (quality.events_out_of_order(_shipments(spark, d), "purchased_at", "shipped_at")
            .select("order_id", "order_item_id", "order_status", "purchased_at", "shipped_at"))


@proof
def q_assert_event_order(spark, d):
    return event_order_faults(spark, d)


@proof
def q_assert_paid_vs_gross(spark, d):
    return orders_mart.paid_vs_gross(fct_orders(spark, d))


@proof
def q_reconcile_count(spark, d):
    stg = stg_orders(spark, d)
    parts = []
    for variant, how in (("left", "left"), ("inner_mutant", "inner")):
        both = quality.counts_side_by_side(fct_orders(spark, d, items_join=how), stg,
                                           "fct_orders row count differs from stg_orders")
        parts.append(both.select(F.lit(variant).alias("variant"),
                                 F.col("fct_rows").cast(INT64), F.col("stg_rows").cast(INT64),
                                 (F.col("fct_rows") != F.col("stg_rows")).alias("fails")))
    return parts[0].unionByName(parts[1])


@proof
def q_reconcile_total(spark, d):
    raw = raw_tables.raw_order_items(spark, d)
    raw_value = to_numeric("price") + to_numeric("freight_value")
    parts = []
    for variant, how in (("left", "left"), ("inner_mutant", "inner")):
        both = quality.totals_side_by_side(fct_orders(spark, d, items_join=how),
                                           F.col("gross_revenue_brl"), raw, raw_value,
                                           "fct_total", "raw_total")
        parts.append(both.select(F.lit(variant).alias("variant"),
                                 F.col("fct_total").cast(NUMERIC), F.col("raw_total").cast(NUMERIC),
                                 F.col("difference").cast(NUMERIC),
                                 (F.abs(F.col("difference")) > 0.01).alias("fails")))
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------- generic tests

@proof
def q_test_unique(spark, d):
    return quality.test_unique(stg_orders(spark, d), "customer_id")


@proof
def q_test_unique_combo(spark, d):
    return quality.test_unique_combination(stg_items(spark, d), ["order_id", "order_item_id"])


@proof
def q_test_not_null(spark, d):
    return quality.null_counts(fct_orders(spark, d), orders_mart.FCT_COLUMNS)


def _lost_items(items: DataFrame) -> DataFrame:
    # Orphans are planted in the child key: seventh lines refer to orders that do not exist.
    lost = F.when(F.col("order_item_id").cast("int") == 7, F.concat("order_id", F.lit("-lost"))).otherwise(F.col("order_id"))
    return items.withColumn("order_id", lost)


def _relationship_faults(spark, d):
    return quality.test_relationships(_lost_items(stg_items(spark, d)), "order_id", stg_orders(spark, d), "order_id")


@proof
def q_test_relationships(spark, d):
    return _relationship_faults(spark, d).select("order_id", F.col("n_records").cast(INT64))


@proof
def q_test_accepted_values(spark, d):
    return quality.test_accepted_values(stg_orders(spark, d), "order_status", ["F", "O"])


def _range_faults(spark, d):
    return quality.test_accepted_range(stg_payments(spark, d), "payment_installments", 0, 24)


@proof
def q_test_accepted_range(spark, d):
    return _range_faults(spark, d).select("order_id", "payment_sequential", "payment_installments")


@proof
def q_severity(spark, d):
    # The mart is a table: built once, then every test reads the written table.
    mart = VersionedTable(spark, new_work_dir(spark, "mart-fct"))
    mart.replace(fct_orders(spark, d))
    fct, items = mart.read(), stg_items(spark, d)
    sev, model = quality.Severity, quality.Model
    facts = quality.model_facts([
        model("orders", stg_orders(spark, d), "order_id", family="order", parent=True),
        model("items", items, "order_id", "order_item_id"),
        model("items with lost orders", _lost_items(items), "order_id", family="order"),
        model("payments", stg_payments(spark, d), counts={
            "outside": ~F.col("payment_installments").between(0, 24), "instalments": F.col("payment_installments") > 1}),
        model("fct", fct, counts={"unpaid": orders_mart.unpaid()})])
    counts = quality.tests_from_facts(facts, {
        "assert_order_paid_matches_gross_revenue": lambda v: v("fct", "unpaid"),
        "unique_combination_order_items": lambda v: v("items", "duplicates"),
        "accepted_range_payment_installments": lambda v: v("payments", "outside"),
        "relationships_order_items_order_id": lambda v: v("items with lost orders", "orphans"),
        "assert_some_payments_have_instalments": lambda v: (v("payments", "instalments") == 0).cast("int"),
        "assert_fct_orders_has_every_order": lambda v: (v("fct", "rows") != v("orders", "rows")).cast("int")})
    for df, name in ((event_order_faults(spark, d), "assert_no_delivery_before_purchase"),
                     (quality.test_accepted_values(stg_orders(spark, d), "order_status", ["F", "O"]), "accepted_values_order_status")):
        counts = counts.unionByName(quality.failure_count(df, name))
    return quality.grade_counts(counts, {"assert_order_paid_matches_gross_revenue": sev(">0", ">350"),
                                         "accepted_range_payment_installments": sev(severity="warn")})


@proof
def q_freshness(spark, d):
    log = raw_tables.raw_run_log(spark, d)
    return quality.freshness(log, F.col("event_at"), FRESHNESS_NOW, WARN_DAYS, ERROR_DAYS)


# ---------------------------------------------------------------- run log

@proof
def q_dead_runs(spark, d):
    return runlog.dead_runs(raw_tables.raw_run_log(spark, d))


@proof
def q_failed_tables(spark, d):
    return runlog.failed_tables(raw_tables.raw_run_log(spark, d), tiebreak="event_id")


@proof
def q_load_skew(spark, d):
    return runlog.load_skew(raw_tables.raw_run_log(spark, d)).withColumn(
        "days_behind", F.col("days_behind").cast(INT64))


# ---------------------------------------------------------------- incremental load pieces

@proof
def q_high_water_mark(spark, d):
    rates = raw_tables.raw_fx_rates(spark, d)
    # the second mark is over a key with no rows: it falls back to the default start
    return high_water_mark_frame(rates, "TIME_PERIOD", empty_when=F.col("CURRENCY") == "XXX")


@proof
def q_window_extract(spark, d):
    rates = raw_tables.raw_fx_rates(spark, d)
    latest = rates.agg(F.max("TIME_PERIOD")).first()[0]  # one scalar
    end = dt.date.fromisoformat(latest)
    start = end - dt.timedelta(days=7)
    return (rate_load.read_window(rates, ["GBP", "BRL"], start, end)
            .select("KEY", "CURRENCY", "TIME_PERIOD", "OBS_VALUE"))


@proof
def q_missing_keys(spark, d):
    rates = raw_tables.raw_fx_rates(spark, d)
    latest = rates.agg(F.max("TIME_PERIOD")).first()[0]
    end = dt.date.fromisoformat(latest)
    window = rate_load.read_window(rates, REQUESTED_CCY, end - dt.timedelta(days=7), end)
    requested = spark.createDataFrame([(c,) for c in REQUESTED_CCY], "currency string")
    return rate_load.coverage(requested, window, rates)


# ---------------------------------------------------------------- tables and loads (write)

def _typed_supplier(spark, d):
    s = raw_tables.table(spark, d, "supplier")
    return s.select("s_suppkey", "s_name", "s_nationkey",
                    F.col("s_acctbal").cast("decimal(18,2)").alias("s_acctbal"))


def _typed_customer(spark, d):
    c = raw_tables.table(spark, d, "customer")
    return c.select("c_custkey", "c_name", "c_nationkey",
                    F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"), "c_mktsegment")


@proof
def q_audit_columns(spark, d):
    """Audit columns on a raw all-string table (the load time is one value per
    statement and not compared; the source URI is)."""
    raw = raw_tables.raw_customers(spark, d)
    return with_audit(raw, AUDIT_URI).drop("_loaded_at")


@proof
def q_full_replace(spark, d):
    t = VersionedTable(spark, new_work_dir(spark, "full-replace"))
    sup = _typed_supplier(spark, d)
    t.replace(sup)
    t.replace(sup.withColumn("s_acctbal", (F.col("s_acctbal") + 1).cast("decimal(18,2)")))
    return t.read()


@proof
def q_upsert_first_run(spark, d):
    t = VersionedTable(spark, new_work_dir(spark, "upsert-first"))
    t.upsert(with_audit(_typed_customer(spark, d), AUDIT_URI), ["c_custkey"])
    return t.read().drop("_loaded_at")


@proof
def q_upsert_merge(spark, d):
    """Target: every customer outside HOUSEHOLD.  Source: HOUSEHOLD (inserts)
    and AUTOMOBILE (updates) with the balance + 1 and without c_nationkey, so
    matched rows keep their nation and inserted rows get NULL."""
    t = VersionedTable(spark, new_work_dir(spark, "upsert-merge"))
    cust = _typed_customer(spark, d)
    t.upsert(cust.filter(F.col("c_mktsegment") != "HOUSEHOLD"), ["c_custkey"])
    source = (cust.filter(F.col("c_mktsegment").isin("HOUSEHOLD", "AUTOMOBILE"))
                  .withColumn("c_acctbal", (F.col("c_acctbal") + 1).cast("decimal(18,2)"))
                  .drop("c_nationkey"))
    t.upsert(source, ["c_custkey"])
    return t.read()


@proof
def q_log_append(spark, d):
    path = new_work_dir(spark, "runlog")
    events = raw_tables.raw_run_log(spark, d)
    runlog.append_events(events.filter(F.col("status") == "started"), path)
    runlog.append_events(events.filter(F.col("status") != "started"), path)
    log = runlog.read_log(spark, path)
    return log.groupBy("status").agg(F.count(F.lit(1)).cast(INT64).alias("n_events"))


@proof
def q_mart_roundtrip(spark, d):
    t = VersionedTable(spark, new_work_dir(spark, "mart"))
    t.replace(orders_mart.items_by_order(stg_items(spark, d)))
    return t.read()


__all__ = ["REGISTRY", "proof"]


# ---------------------------------------------------------------- load jobs and streams

BULK_TABLES = ["region", "nation", "supplier", "customer", "orders"]
LOAD_DATE = dt.date(2024, 1, 1)


@proof
def q_manifest_load_counts(spark, d):
    """Bulk load of a 5-table manifest; per table, counts as logged."""
    from .bulk_load import bulk_load

    work = new_work_dir(spark, "bulk-load")
    manifest = {}
    for name in BULK_TABLES:
        path = f"{work}/export/{name}"
        raw_tables.table(spark, d, name).write.options(header="true", escape='"').csv(path)
        manifest[name] = path
    log_path = f"{work}/log"
    bulk_load(spark, manifest, f"{work}/landing", f"{work}/warehouse", log_path, "tpch",
              load_date=LOAD_DATE)
    log = runlog.read_log(spark, log_path).filter(F.col("status") == "success")
    return log.select(F.col("table_name"), F.col("source_row_count").alias("source_rows"),
                      F.col("loaded_row_count").alias("loaded_rows"),
                      (F.col("source_row_count") == F.col("loaded_row_count")).alias("matches"))


@proof
def q_landing_partition_prune(spark, d):
    """Orders landed by load_date = order year; one day folder read back."""
    from ..sources.landing import land_frame, read_landed

    root = new_work_dir(spark, "landing")
    raw = raw_tables.raw_orders(spark, d).withColumn(
        "load_date", F.concat(F.substring("order_purchase_timestamp", 1, 4), F.lit("-01-01")))
    land_frame(raw, root, "tpch", "orders", partition_col="load_date")
    back = read_landed(spark, root, "tpch", "orders", load_dates=["1997-01-01"])
    return back.select("order_id", "customer_id", "order_status", "order_purchase_timestamp",
                       "order_approved_at", "load_date")


INCR_DEFAULT_START = "1995-01-01"
INCR_FIRST_TODAY = dt.date(1998, 12, 31)
INCR_SECOND_TODAY = dt.date(2001, 12, 31)


@proof
def q_incremental_load(spark, d):
    """Two runs of the incremental load: the first from the default start to
    1998-12-31, the second from (latest - 7 days) on a revised source (+0.01),
    so the overlap is updated and older rows keep their values."""
    work = new_work_dir(spark, "incremental")
    rates = raw_tables.raw_fx_rates(spark, d)
    revised = rates.withColumn(
        "OBS_VALUE", (to_numeric("OBS_VALUE") + F.lit(0.01)).cast("decimal(18,2)").cast("string"))
    for today, src in ((INCR_FIRST_TODAY, rates), (INCR_SECOND_TODAY, revised)):
        rate_load.incremental_load(spark, src, f"{work}/rates", f"{work}/log", ["GBP", "BRL"],
                                   today, source_uri=f"rates/{today}", default_start=INCR_DEFAULT_START)
    table = VersionedTable(spark, f"{work}/rates", rate_load.RATE_PARTITION).read()
    return table.select("KEY", "CURRENCY", "TIME_PERIOD", "OBS_VALUE", "OBS_STATUS")


REVISED_FROM = "1997-01-01"          # the second landing revises the rates of this day and later


def _streamed_rates(spark, d):
    """Two landings, each consumed by the file stream in several micro-batches: the rates,
    one file per year, then revised values (+0.01) from REVISED_FROM on.  Then the last
    micro-batch is replayed as after a failure between commit and checkpoint.
    (table, log path)"""
    from .. import fs
    from ..sources.landing import land_frame, landing_dir
    from ..streaming.rate_stream import run_rate_stream

    work = new_work_dir(spark, "stream")
    rates = raw_tables.raw_fx_rates(spark, d)
    cols, log = rates.columns, f"{work}/log"
    revised = rates.filter(F.col("TIME_PERIOD") >= REVISED_FROM).withColumn(
        "OBS_VALUE", (to_numeric("OBS_VALUE") + F.lit(0.01)).cast("decimal(18,2)").cast("string"))
    folder = landing_dir(f"{work}/landing", "ecb", "rates")

    def consume():
        return run_rate_stream(spark, folder, cols, f"{work}/rates", f"{work}/checkpoint", max_files_per_trigger=4,
                               log_path=log)

    for landing, day in ((rates, "-12-31"), (revised, "-12-31-revised")):
        by_year = landing.withColumn("load_date", F.concat(F.substring("TIME_PERIOD", 1, 4), F.lit(day)))
        land_frame(by_year.repartition("load_date"), f"{work}/landing", "ecb", "rates", partition_col="load_date")
        table = consume()
    batches = [n for n in fs.list_names(spark, f"{work}/checkpoint/commits") if n.isdigit()]
    last = max(batches, key=int)
    for name in (last, f".{last}.crc"):       # the checkpoint never heard of the last batch
        fs.delete(spark, f"{work}/checkpoint/commits/{name}")
    table = consume()
    assert [n for n in fs.list_names(spark, f"{work}/checkpoint/commits") if n == last]
    return table, log


@proof
def q_stream_upsert(spark, d):
    """The table after two landings (the second revises keys) and a forced replay."""
    table, _ = _streamed_rates(spark, d)
    return table.read().select("KEY", "CURRENCY", "TIME_PERIOD", "OBS_VALUE", "OBS_STATUS")


@proof
def q_stream_log(spark, d):
    """The stream's log after the same: one started and one success per batch, the
    records of all files, one commit per batch, nothing for the replay."""
    table, path = _streamed_rates(spark, d)
    log = runlog.read_log(spark, path)
    return log.groupBy("status").agg(
        F.sum("source_row_count").cast(INT64).alias("source_rows"), F.sum("loaded_row_count").cast(INT64).alias("loaded_rows"),
        (F.count(F.lit(1)) == F.lit(table.version())).alias("one_per_commit"))


@proof
def q_load_outcomes(spark, d):
    """The log of a bulk load in which one table has a ragged record and one no records:
    the latest outcome of each table with its landing folder and the kind of error."""
    from .bulk_load import BulkLoadFailed, bulk_load

    work = new_work_dir(spark, "outcomes")
    line = lambda df: F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns])
    supplier = raw_tables.table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    whole = supplier.agg(F.max("s_suppkey").alias("m"))
    manifest = {}
    for name in ("customer", "part"):
        raw_tables.table(spark, d, name).write.options(header="true", escape='"').csv(f"{work}/export/{name}")
        manifest[name] = f"{work}/export/{name}"
    # A header and its records in one file: Spark writes them as one sorted column of text.
    lines = spark.createDataFrame([(0, "s_suppkey,s_nationkey")], "k long, value string").unionByName(
        supplier.select(F.col("s_suppkey").cast("long").alias("k"), line(supplier).alias("value"))).unionByName(
        whole.select((F.col("m") + 1).cast("long").alias("k"), F.col("m").cast("string").alias("value")))
    lines.repartition(1).sortWithinPartitions("k").select("value").write.text(f"{work}/export/supplier")
    manifest["supplier"] = f"{work}/export/supplier"
    spark.createDataFrame([("r_regionkey,r_name",)], "value string").coalesce(1).write.text(f"{work}/export/region")
    manifest["region"] = f"{work}/export/region"
    try:
        bulk_load(spark, manifest, f"{work}/landing", f"{work}/warehouse", f"{work}/log", "tpch", load_date=LOAD_DATE)
    except BulkLoadFailed:
        pass
    log = runlog.read_log(spark, f"{work}/log").filter(F.col("status") != "started")
    message = F.col("error_message")
    return log.select(
        "table_name", "status", F.col("source_row_count").alias("source_rows"), F.col("loaded_row_count").alias("loaded_rows"),
        F.regexp_extract("landing_uri", "(tpch/.*)$", 1).alias("landing"),
        F.when(message.contains("field count"), F.regexp_extract(message, "line ([0-9]+): '([0-9]+)'", 1))
         .when(message.contains("no data rows"), F.lit("no rows")).alias("error"),
        (F.col("duration_seconds") >= 0).alias("timed"))


def _ragged_source(spark, d) -> str:
    """Suppliers as CSV text in the order of their keys; every tenth record lacks a field,
    every fifteenth has one too many."""
    s = raw_tables.table(spark, d, "supplier")
    record = F.concat_ws(",", F.col("s_suppkey").cast("string"), "s_name", F.col("s_nationkey").cast("string"))
    value = F.when(F.col("s_suppkey") % 10 == 0, F.concat_ws(",", F.col("s_suppkey").cast("string"), "s_name")).when(
        F.col("s_suppkey") % 15 == 0, F.concat(record, F.lit(",x"))).otherwise(record)
    lines = s.select(F.col("s_suppkey").cast("long").alias("k"), value.alias("value")).unionByName(
        spark.createDataFrame([(-1, "id,name,nation")], "k long, value string"))
    path = f"{new_work_dir(spark, 'ragged')}/supplier"
    lines.repartition(1).sortWithinPartitions("k").select("value").write.text(path)
    return path


@proof
def q_ragged_rows(spark, d):
    """Every ragged record of a source with the line it begins on."""
    from ..sources.csv_files import ragged_rows

    return ragged_rows(spark, _ragged_source(spark, d)).select(F.col("line").cast(INT64).alias("line"), "record")


@proof
def q_build_tests(spark, d):
    """The whole build on the stand-in raw tables: staging views, intermediates,
    the fact written once, then every model test and assertion, graded."""
    from .build import build

    raw = {
        "raw_orders": raw_tables.raw_orders(spark, d),
        "raw_customers": raw_tables.raw_customers(spark, d),
        "raw_order_items": raw_tables.raw_order_items(spark, d),
        "raw_order_payments": raw_tables.raw_order_payments(spark, d),
        "raw_products": raw_tables.raw_products(spark, d),
        "raw_sellers": raw_tables.raw_sellers(spark, d),
        "raw_product_category_name_translation": raw_tables.raw_category_translation(spark, d),
        "raw_fx_rates": raw_tables.raw_fx_rates(spark, d),
    }
    return build(spark, raw, new_work_dir(spark, "build-fct"), register_views=False).tests


@proof
def q_csv_split_roundtrip(spark, d):
    """Every document (whole texts, with their newlines and quotes) landed as CSV and
    loaded back, counted against the records of the files."""
    from ..sources.csv_files import read_by_header, total_records
    from ..sources.landing import land_frame

    work = new_work_dir(spark, "csv-split")
    docs = raw_tables.table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "text", "lang", "source")
    folder = land_frame(docs, work, "corpus", "documents", load_date=LOAD_DATE)
    t = VersionedTable(spark, f"{work}/loaded")
    t.replace(read_by_header(spark, folder, "documents"), expected_rows=total_records(spark, folder))
    return t.read()


# ---------------------------------------------------------------- load control

@proof
def q_headers_by_name(spark, d):
    """Rates landed as two kinds of files whose headers order the columns differently,
    read by name, with the columns the load requires."""
    from ..sources.csv_files import read_by_header

    work = new_work_dir(spark, "headers")
    rates = raw_tables.raw_fx_rates(spark, d)
    odd = F.substring("TIME_PERIOD", 4, 1).cast("int") % 2 == 1
    options = {"header": "true", "escape": '"'}
    rates.filter(odd).write.options(**options).csv(f"{work}/rates/odd")
    rates.filter(~odd).select(*reversed(rates.columns)).write.options(**options).csv(f"{work}/rates/even")
    back = read_by_header(spark, f"{work}/rates", "rates", required=rate_load.MERGE_KEYS)
    return back.select("KEY", "CURRENCY", "TIME_PERIOD", "OBS_VALUE", "OBS_STATUS")


@proof
def q_missing_sources(spark, d):
    """A manifest that names one source file per nation, of which those of even keys were
    exported: the check names the others and nothing is loaded."""
    from ..sources.manifest import MissingSourceFiles, check_manifest

    work = new_work_dir(spark, "manifest")
    nations = raw_tables.table(spark, d, "nation").select("n_nationkey", "n_name")
    exported = nations.filter(F.col("n_nationkey") % 2 == 0).withColumn("nation", F.col("n_nationkey"))
    exported.write.partitionBy("nation").csv(f"{work}/export")
    manifest = {r["n_name"]: f"{work}/export/nation={r['n_nationkey']}" for r in nations.collect()}   # one path a table
    try:
        check_manifest(spark, manifest)
        named = ""
    except MissingSourceFiles as exc:
        named = str(exc)
    missing = F.regexp_extract_all(F.lit(named), F.lit("nation=([0-9]+)"), F.lit(1))
    return nations.filter(F.array_contains(missing, F.col("n_nationkey").cast("string"))).select("n_name")


@proof
def q_failed_replace(spark, d):
    """A replace whose count differs from its source commits nothing and leaves no folder."""
    from .. import fs

    t = VersionedTable(spark, new_work_dir(spark, "failed-replace"))
    sup = _typed_supplier(spark, d)
    t.replace(sup)
    try:
        t.replace(sup.filter(F.col("s_suppkey") % 2 == 0), expected_rows=sup.count())
        outcome = "replaced"
    except quality.DataCheckError:
        outcome = "refused"
    return t.read().withColumn("outcome", F.lit(outcome)).withColumn(
        "data_folders", F.lit(len(fs.list_names(spark, f"{t.root}/data"))).cast(INT64))


@proof
def q_empty_window(spark, d):
    """Three runs of the incremental load: an empty window on the first load is refused, the
    next loads all rates, one of a known currency without new rates is a success of none."""
    work = new_work_dir(spark, "empty-window")
    rates = raw_tables.raw_fx_rates(spark, d)
    last = rates.agg(F.max("TIME_PERIOD")).first()[0]       # one scalar
    end = (dt.date.fromisoformat(last) - dt.timedelta(days=60)).isoformat()
    ended = rates.filter((F.col("CURRENCY") != "BRL") | (F.col("TIME_PERIOD") < end))     # no new rates for two months
    for today, codes in (("1990-01-01", ["GBP", "BRL"]), (last, ["GBP", "BRL"]), (last, ["BRL"])):
        try:
            rate_load.incremental_load(spark, ended, f"{work}/rates", f"{work}/log", codes, dt.date.fromisoformat(today),
                                       source_uri="rates", default_start="1990-01-01")
        except quality.DataCheckError:
            pass
    log = runlog.read_log(spark, f"{work}/log").filter(F.col("status") != "started")
    return log.select("status", F.col("source_row_count").alias("source_rows"), F.col("loaded_row_count").alias("loaded_rows"))


@proof
def q_staging_views(spark, d):
    """Staging models registered as views and queried with SQL: nothing is stored."""
    stg_orders(spark, d).createOrReplaceTempView("stg_orders")
    stg_customers(spark, d).createOrReplaceTempView("stg_customers")
    return spark.sql("""
        SELECT c.customer_state_code, o.order_status, count(*) AS n_orders, min(o.purchased_at) AS first_purchase
        FROM stg_orders o JOIN stg_customers c ON c.customer_id = o.customer_id
        GROUP BY c.customer_state_code, o.order_status""")


@proof
def q_text_helpers(spark, d):
    """Codes split from a list, clipped texts and joined paths, over the documents."""
    from ..functions.text import clip_text, path_join, split_codes

    docs = raw_tables.table(spark, d, "documents")
    listed = F.concat_ws(",", F.col("lang"), F.concat(F.lit(" "), F.col("source")), F.lit(""), F.lit("gbp "))
    return docs.select("doc_id", F.array_join(split_codes(listed), "|").alias("codes"), clip_text("text", 2000).alias("clipped"),
                       path_join("source", "lang", F.col("doc_id").cast("string")).alias("path"))


@proof
def q_seconds_between(spark, d):
    """Fractional seconds from each event's user's first event to the event."""
    from ..functions.timez import seconds_between

    e = raw_tables.table(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    first = e.groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    return e.join(first, "user_id").select("event_id", seconds_between("first_ts", "ts").alias("seconds"))

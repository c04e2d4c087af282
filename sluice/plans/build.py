"""Build the order marts from raw tables and run the whole test suite.

    raw (all strings) --stage--> staging views (temp views, nothing stored)
      -> intermediates (daily rates, items / payments per order) written once
      -> fct_orders written once as a versioned table
      -> every test reads the written tables or the staging views

Uniqueness, NULL, range, relationship, count and total tests of all models come from one
tagged aggregate (``quality.model_facts``): one scan per model, one shuffle of keys that
are combined map-side.  The results are graded against their thresholds.  Errors block,
warnings do not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import to_numeric
from ..operators import quality
from ..operators.joins import materialize
from ..operators.quality import Severity
from ..operators.tables import VersionedTable
from . import fx_daily, orders_mart
from .staging import stage

# The order states the fact accepts and the FX sanity bounds.
ORDER_STATES = ["created", "approved", "invoiced", "processing", "shipped", "delivered",
                "unavailable", "canceled"]
FX_CHECK_YEAR = 2018
FX_LOW, FX_HIGH = 0.15, 0.30
FX_MAX_STALE_DAYS = 5
PAID_VS_GROSS = Severity(warn_if=">0", error_if=">350")

STAGING = {  # raw table name -> staging model
    "raw_orders": "orders", "raw_customers": "customers", "raw_order_items": "order_items",
    "raw_order_payments": "order_payments", "raw_order_reviews": "order_reviews",
    "raw_products": "products", "raw_sellers": "sellers", "raw_geolocation": "geolocation",
    "raw_product_category_name_translation": "product_category_name_translation",
    "raw_fx_rates": "fx_rates",
}

#: Tables that a model of the build or one of its tests reads; without one of them the
#: build fails, it does not run fewer tests.
REQUIRED = ("raw_orders", "raw_order_items", "raw_order_payments", "raw_fx_rates", "raw_customers",
            "raw_products", "raw_sellers", "raw_product_category_name_translation")


@dataclass
class BuildResult:
    fct_rows: int
    tests: DataFrame          # test_name, failures, warn_if, error_if, status
    views: dict[str, DataFrame]

    def blocking(self) -> list[str]:
        return [r["test_name"] for r in self.tests.filter(F.col("status") == "error").collect()]


def _nulls(model: str, *cols: str) -> dict:
    return {f"not_null_{model}_{c}": F.col(c).isNull() for c in cols}


def test_suite(stg: dict[str, DataFrame], raw_items: DataFrame, fx: DataFrame,
               items: DataFrame, pays: DataFrame, fct: DataFrame) -> DataFrame:
    """All model tests and singular assertions as one graded table."""
    Model = quality.Model
    instalments = F.col("payment_installments")
    models = [
        Model("stg_orders", stg["orders"], "order_id", family="order", parent=True, counts={
            **_nulls("stg_orders", "order_id"),
            "assert_no_delivery_before_purchase": F.col("delivered_customer_at") < F.col("purchased_at")}),
        Model("stg_order_items", stg["order_items"], "order_id", "order_item_id", family="order",
              counts=_nulls("stg_order_items", "order_id")),
        Model("stg_order_payments", stg["order_payments"], "order_id", "payment_sequential", family="order", counts={
            **_nulls("stg_order_payments", "order_id", "payment_installments"),
            "accepted_range_stg_order_payments_payment_installments": ~instalments.between(0, 24),
            "instalments": instalments > 1}),
        Model("int_order_items_by_order", items, "order_id", counts=_nulls("int_order_items_by_order", "order_id", "item_count")),
        Model("int_order_payments_by_order", pays, "order_id", counts=_nulls(
            "int_order_payments_by_order", "order_id", "total_paid", "payment_count", "main_payment_type")),
        Model("fct_orders", fct, "order_id", sums={"gross": F.col("gross_revenue_brl")}, counts={
            **_nulls("fct_orders", "order_id", "customer_id", "order_status", "purchased_at", "gbp_per_brl", "is_fx_forward_filled"),
            "assert_order_paid_matches_gross_revenue": orders_mart.unpaid()}),
        Model("fct_orders customers", fct, "customer_id", family="customer"),
        Model("stg_customers", stg["customers"], "customer_id", family="customer", parent=True,
              counts=_nulls("stg_customers", "customer_id")),
        Model("stg_fx_rates", stg["fx_rates"], "currency", "rate_date"),
        Model("int_fx_rates_daily", fx, "rate_date", counts=_nulls(
            "int_fx_rates_daily", "rate_date", "gbp_per_brl", "last_ecb_date", "is_forward_filled")),
        Model("raw_order_items", raw_items, sums={"total": to_numeric("price") + to_numeric("freight_value")}),
    ]
    dimensions = (("products", "product_id"), ("sellers", "seller_id"),
                  ("product_category_name_translation", "product_category_name"))
    models += [Model(f"stg_{m}", stg[m], k, counts=_nulls(f"stg_{m}", k)) for m, k in dimensions]

    tests = {name: (lambda v, m=m.name, name=name: v(m, name)) for m in models for name in m.counts if name != "instalments"}
    for m in models:
        if m.line:
            tests[f"unique_combination_{m.name}"] = lambda v, m=m.name: v(m, "duplicates")
        elif m.key and m.name != "fct_orders customers":
            tests[f"unique_{m.name}_{m.key}"] = lambda v, m=m.name: v(m, "duplicates")
    for name, key in (("stg_order_items", "order_id"), ("stg_order_payments", "order_id"), ("fct_orders customers", "customer_id")):
        tests[f"relationships_{name.split()[0]}_{key}"] = lambda v, m=name: v(m, "orphans")
    tests["assert_fct_orders_has_every_order"] = lambda v: (v("fct_orders", "rows") != v("stg_orders", "rows")).cast("int")
    tests["assert_revenue_reconciles_to_raw"] = lambda v: (
        F.abs(v("fct_orders", "gross") - v("raw_order_items", "total")) > 0.01).cast("int")
    tests["assert_some_payments_have_instalments"] = lambda v: (v("stg_order_payments", "instalments") == 0).cast("int")
    counted = quality.tests_from_facts(quality.model_facts(models), tests)
    for df, name in (
            (quality.test_accepted_values(stg["fx_rates"], "obs_status", ["A"]), "accepted_values_stg_fx_rates_obs_status"),
            (quality.test_accepted_values(fct, "order_status", ORDER_STATES), "accepted_values_fct_orders_order_status"),
            (fx_daily.fx_sanity(fx, FX_CHECK_YEAR, FX_LOW, FX_HIGH, FX_MAX_STALE_DAYS), "assert_fx_rates_daily_sane")):
        counted = counted.unionByName(quality.failure_count(df, name))
    return quality.grade_counts(counted, {"assert_order_paid_matches_gross_revenue": PAID_VS_GROSS})


def build(spark: SparkSession, raw: dict[str, DataFrame], mart_root: str,
          register_views: bool = True, materialize_staging: bool = False) -> BuildResult:
    """``raw`` maps raw table names (see STAGING) to all-string DataFrames.

    Staging models are views by default: most tests read only key columns,
    which are plain strings in the raw tables, so a column-pruned re-read is
    cheaper than writing every staged table in full.  ``materialize_staging``
    writes each staging model once as typed Parquet instead (worth it when
    many tests cast the same wide columns); results are the same either way.
    """
    missing = [t for t in REQUIRED if t not in raw]
    if missing:
        raise ValueError(f"build needs raw tables {list(REQUIRED)}; missing: {missing}")
    stg = {STAGING[name]: stage(df, STAGING[name]) for name, df in raw.items() if name in STAGING}
    if materialize_staging:
        for model in list(stg):
            t = VersionedTable(spark, f"{mart_root.rstrip('/')}_staging/{model}")
            t.replace(stg[model])
            stg[model] = t.read()
    if register_views:
        for model, df in stg.items():
            df.createOrReplaceTempView(f"stg_{model}")
    # The intermediates are computed once: the fact and their tests read the written tables.
    fx = materialize(fx_daily.rates_daily(stg["fx_rates"]), "int-fx")
    items = materialize(orders_mart.items_by_order(stg["order_items"]), "int-items")
    pays = materialize(orders_mart.payments_by_order(stg["order_payments"]), "int-payments")
    fct = orders_mart.fact_of(stg["orders"], items, pays, fx)
    mart = VersionedTable(spark, mart_root)
    n = mart.replace(fct)
    tests = test_suite(stg, raw["raw_order_items"], fx, items, pays, mart.read())
    return BuildResult(n, tests, stg)

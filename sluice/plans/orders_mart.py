"""Order models: items and payments per order, and the order fact.

Aggregate before join: items and payments are reduced to one row per order
(map-side partial aggregation), so the left joins from orders cannot fan out
and a hot order costs one row per task.  All three inputs of the fact are
hash-partitioned on order_id, so the two joins share one partitioning; the
daily rate calendar (one row per day) is broadcast after its size is counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import INT64, NUMERIC, exact_add, exact_product, to_int64
from ..functions.timez import utc_to_local_date
from ..operators import keyed
from ..operators.joins import join_small
from .staging import BUSINESS_ZONE

FCT_COLUMNS = [
    "order_id", "customer_id", "order_status", "purchased_at", "items_value_brl",
    "freight_value_brl", "gross_revenue_brl", "paid_brl", "gbp_per_brl",
    "gross_revenue_gbp", "is_fx_forward_filled", "purchase_date", "item_count",
    "payment_count", "main_payment_type",
]


def items_by_order(stg_items: DataFrame) -> DataFrame:
    """order_id, item_count, items_value, freight_value."""
    return keyed.totals_by_key(stg_items, "order_id",
                               {"items_value": "item_price", "freight_value": "freight_value"},
                               count_name="item_count")


def payments_by_type(stg_payments: DataFrame) -> DataFrame:
    """order_id, payment_type, type_amount, type_count, first_sequential.

    The sequence is compared as a number: as text '10' sorts before '2'.
    """
    return (stg_payments.groupBy("order_id", "payment_type")
            .agg(F.sum("payment_amount").alias("type_amount"),
                 F.count(F.lit(1)).alias("type_count"),
                 F.min(to_int64("payment_sequential")).alias("first_sequential")))


def main_type_order():
    """Most money first; tie -> used first; then the type name (deterministic)."""
    return keyed.sort_key(("type_amount", "desc"), ("first_sequential", "asc"),
                          ("payment_type", "asc"))


def payments_by_order(stg_payments: DataFrame) -> DataFrame:
    """order_id, total_paid, payment_count, main_payment_type.

    One aggregate per (order, type), then an arg-max per order (``min_by``): both
    combine map-side, no bound on the number of types, no job while planning.
    Orders with a NULL id are dropped, as an inner join on the id would."""
    return (payments_by_type(stg_payments).groupBy("order_id")
            .agg(F.sum("type_amount").alias("total_paid"),
                 F.sum("type_count").alias("payment_count"),
                 F.min_by("payment_type", main_type_order()).alias("main_payment_type"))
            .filter(F.col("order_id").isNotNull()))


def ranked_payment_types(stg_payments: DataFrame) -> DataFrame:
    """The window form of the same choice: row_number over each order's types."""
    order = [F.col("type_amount").desc_nulls_last(), F.col("first_sequential").asc_nulls_first(),
             F.col("payment_type").asc_nulls_first()]
    return keyed.rank_within(payments_by_type(stg_payments), "order_id", order, out="type_rank")


def order_fact(stg_orders: DataFrame, stg_items: DataFrame, stg_payments: DataFrame,
               fx_daily: DataFrame, items_join: str = "left", zone: str = BUSINESS_ZONE) -> DataFrame:
    """The order fact from the staged tables.  ``items_join='inner'`` is the mutant the
    row-count parity test must catch."""
    return fact_of(stg_orders, items_by_order(stg_items), payments_by_order(stg_payments), fx_daily, items_join, zone)


def fact_of(stg_orders: DataFrame, items: DataFrame, pays: DataFrame, fx_daily: DataFrame,
            items_join: str = "left", zone: str = BUSINESS_ZONE) -> DataFrame:
    """One row per order with BRL amounts and the gross revenue in GBP at the
    rate of the local purchase day, from items and payments per order."""
    orders = stg_orders.select(
        "order_id", "customer_id", "order_status", "purchased_at",
        utc_to_local_date("purchased_at", zone).alias("purchase_date"))
    fx = fx_daily.select("rate_date", "gbp_per_brl", "is_forward_filled")
    joined = (orders.join(items, "order_id", items_join)
                    .join(pays, "order_id", "left"))
    joined = join_small(joined, fx.withColumnRenamed("rate_date", "purchase_date"),
                        "purchase_date", "left")
    gross = exact_add("items_value", "freight_value")
    return joined.select(
        "order_id", "customer_id", "order_status", "purchased_at",
        F.col("items_value").cast(NUMERIC).alias("items_value_brl"),
        F.col("freight_value").cast(NUMERIC).alias("freight_value_brl"),
        gross.alias("gross_revenue_brl"),
        F.col("total_paid").cast(NUMERIC).alias("paid_brl"),
        F.col("gbp_per_brl").cast(NUMERIC).alias("gbp_per_brl"),
        F.round(exact_product(gross, "gbp_per_brl"), 2).cast(NUMERIC).alias("gross_revenue_gbp"),
        F.col("is_forward_filled").alias("is_fx_forward_filled"),
        "purchase_date",
        F.coalesce(F.col("item_count"), F.lit(0)).cast(INT64).alias("item_count"),
        F.coalesce(F.col("payment_count"), F.lit(0)).cast(INT64).alias("payment_count"),
        "main_payment_type")


def unpaid(tolerance: float = 0.01):
    """Whether an order with items and payments was paid another amount than its gross value."""
    return ((F.col("item_count") > 0) & (F.col("payment_count") > 0)
            & (F.abs(F.col("gross_revenue_brl") - F.col("paid_brl")) > tolerance))


def paid_vs_gross(fct: DataFrame, tolerance: float = 0.01) -> DataFrame:
    return (fct.filter(unpaid(tolerance))
               .select("order_id", "order_status", "gross_revenue_brl", "paid_brl",
                       (F.col("paid_brl") - F.col("gross_revenue_brl")).cast(NUMERIC)
                       .alias("difference")))

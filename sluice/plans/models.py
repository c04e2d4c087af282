"""The order-analytics models wired to the driver's tables (via raw_tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import fx_daily, orders_mart, raw_tables
from .staging import stage


def stg_orders(spark: SparkSession, d: str) -> DataFrame:
    return stage(raw_tables.raw_orders(spark, d), "orders")


def stg_items(spark: SparkSession, d: str) -> DataFrame:
    return stage(raw_tables.raw_order_items(spark, d), "order_items")


def stg_payments(spark: SparkSession, d: str) -> DataFrame:
    return stage(raw_tables.raw_order_payments(spark, d), "order_payments")


def stg_payments_by_quantity(spark: SparkSession, d: str) -> DataFrame:
    raw = raw_tables.raw_order_payments(spark, d, amount="l_quantity")
    return stage(raw, "order_payments")


def stg_fx(spark: SparkSession, d: str) -> DataFrame:
    return stage(raw_tables.raw_fx_rates(spark, d), "fx_rates")


def stg_customers(spark: SparkSession, d: str) -> DataFrame:
    return stage(raw_tables.raw_customers(spark, d), "customers")


def stg_sellers(spark: SparkSession, d: str) -> DataFrame:
    return stage(raw_tables.raw_sellers(spark, d), "sellers")


def fx_rates_daily(spark: SparkSession, d: str) -> DataFrame:
    return fx_daily.rates_daily(stg_fx(spark, d))


def fct_orders(spark: SparkSession, d: str, items_join: str = "left") -> DataFrame:
    return orders_mart.order_fact(stg_orders(spark, d), stg_items(spark, d),
                                  stg_payments(spark, d), fx_rates_daily(spark, d),
                                  items_join=items_join)

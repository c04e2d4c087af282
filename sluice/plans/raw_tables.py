"""Raw all-string tables shaped like the order-analytics sources, derived by
Spark from the driver's test tables (their stand-ins):

* orders      <- ``orders``  (purchase = order date and a time of day from the key, local wall clock)
* order_items <- ``lineitem`` (price = extended price, freight = quantity)
* payments    <- ``lineitem`` (type = return flag)
* fx rates    <- ``orders`` on weekdays: status F quotes GBP, O BRL, others USD,
                 the day's rate is the largest total price
* customers, sellers, products <- ``customer``, ``supplier``, ``part``
* run log     <- ``events``: purchase = success, error = failed, others = started

Amounts go through decimal(18,2) first, so no float reaches a sum.
Every table grows with its source; nothing is filtered to make checks cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c):
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _money(c: str):
    return F.col(c).cast("decimal(18,2)").cast("string")


def _ts_text(c: str):
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")


def _clock(seconds):
    """'HH:MM:SS' of seconds since midnight."""
    two = lambda c: F.lpad(c.cast("bigint").cast("string"), 2, "0")
    return F.concat_ws(":", two(F.floor(seconds / 3600)), two(F.floor(seconds % 3600 / 60)), two(seconds % 60))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wall-clock times of day follow from the order key (spread over the whole day, so
    local and UTC dates differ and daylight-saving changes are met).  Approval a day
    later, none for every 11th key; hand-over to the carrier 1 to 7 days and delivery 7
    to 44 days after the purchase for finished orders, every 53rd of them (planted) the
    day before it."""
    o = table(spark, sf_dir, "orders")
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    clock = _clock((key * 7919) % 86400)
    at = lambda days: F.concat(F.date_format(F.date_add(day, days.cast("int")), "yyyy-MM-dd"), F.lit(" "), clock)
    finished = F.col("o_orderstatus") == "F"
    delivery = F.when(key % 53 == 0, F.lit(-1)).otherwise(key % 38 + 7)
    return o.select(
        _s("o_orderkey").alias("order_id"),
        _s("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        at(F.lit(0)).alias("order_purchase_timestamp"),
        F.when(key % 11 != 0, at(F.lit(1))).alias("order_approved_at"),
        F.when(finished, at(key % 7 + 1)).alias("order_delivered_carrier_date"),
        F.when(finished, at(delivery)).alias("order_delivered_customer_date"),
        _ts_text("o_orderdate").alias("order_estimated_delivery_date"))


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        _s("l_orderkey").alias("order_id"),
        _s("l_linenumber").alias("order_item_id"),
        _s("l_partkey").alias("product_id"),
        _s("l_suppkey").alias("seller_id"),
        _ts_text("l_shipdate").alias("shipping_limit_date"),
        _money("l_extendedprice").alias("price"),
        _money("l_quantity").alias("freight_value"))


def raw_order_payments(spark: SparkSession, sf_dir: str, amount: str = "l_extendedprice") -> DataFrame:
    """Payments; ``amount='l_quantity'`` over all lines gives many equal
    amounts, the input that exercises the main-type tie-break."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        _s("l_orderkey").alias("order_id"),
        _s("l_linenumber").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        _money(amount).alias("payment_value"),
        _s(F.col("l_quantity").cast("bigint")).alias("payment_installments"))


# Fixed values of the rate source's CSV layout (key parts of a daily EUR reference rate).
RATE_FREQ = "D"
RATE_DENOM = "EUR"
RATE_TYPE = "SP00"
RATE_SUFFIX = "A"
RATE_STATUS = "A"
STATUS_CURRENCY = {"F": "GBP", "O": "BRL"}     # every other state quotes OTHER_CURRENCY
OTHER_CURRENCY = "USD"


def raw_fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    ccy = F.when(F.col("o_orderstatus") == "F", F.lit(STATUS_CURRENCY["F"])).when(
        F.col("o_orderstatus") == "O", F.lit(STATUS_CURRENCY["O"])).otherwise(F.lit(OTHER_CURRENCY))
    day = F.to_date("o_orderdate")
    daily = (o.select(ccy.alias("currency"), day.alias("rate_date"),
                      F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
              .filter(~F.dayofweek("rate_date").isin(1, 7))
              .groupBy("currency", "rate_date").agg(F.max("price").alias("rate")))
    return daily.select(
        F.concat_ws(".", F.lit(RATE_FREQ), F.col("currency"), F.lit(RATE_DENOM),
                    F.lit(RATE_TYPE), F.lit(RATE_SUFFIX)).alias("KEY"),
        F.lit(RATE_FREQ).alias("FREQ"),
        F.col("currency").alias("CURRENCY"),
        F.lit(RATE_DENOM).alias("CURRENCY_DENOM"),
        F.lit(RATE_TYPE).alias("EXR_TYPE"),
        F.lit(RATE_SUFFIX).alias("EXR_SUFFIX"),
        F.date_format("rate_date", "yyyy-MM-dd").alias("TIME_PERIOD"),
        F.col("rate").cast("string").alias("OBS_VALUE"),
        F.lit(RATE_STATUS).alias("OBS_STATUS"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        _s("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.lpad(_s("c_nationkey"), 5, "0").alias("customer_zip_code_prefix"),
        F.lower("c_mktsegment").alias("customer_city"),
        F.lpad(_s("c_nationkey"), 2, "0").alias("customer_state"))


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        _s("s_suppkey").alias("seller_id"),
        F.lpad(_s("s_nationkey"), 5, "0").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.lpad(_s("s_nationkey"), 2, "0").alias("seller_state"))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    none = F.lit(None).cast("string")
    return p.select(
        _s("p_partkey").alias("product_id"),
        F.lower("p_type").alias("product_category_name"),
        _s(F.length("p_name")).alias("product_name_lenght"),
        _s(F.length("p_brand")).alias("product_description_lenght"),
        _s("p_size").alias("product_weight_g"),
        none.alias("product_length_cm"),
        none.alias("product_height_cm"),
        none.alias("product_width_cm"),
        F.when(F.col("p_type") != "SMALL", _s("p_size")).alias("product_photos_qty"))


def raw_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per category name that products carry."""
    return table(spark, sf_dir, "part").groupBy(F.lower("p_type").alias("product_category_name")).agg(
        F.min("p_type").alias("product_category_name_english"))


def raw_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as review messages: long texts with quotes and line breaks."""
    d = table(spark, sf_dir, "documents")
    day = F.date_add(F.lit("2018-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    return d.select(
        _s("doc_id").alias("review_id"),
        _s(F.col("doc_id") % 1000).alias("order_id"),
        _s(F.col("n_chars") % 5 + 1).alias("review_score"),
        F.col("lang").alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        F.concat(_s(day), F.lit(" 00:00:00")).alias("review_creation_date"),
        F.concat(_s(F.date_add(day, 1)), F.lit(" 17:45:35")).alias("review_answer_timestamp"))


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zip prefixes repeat: the table has no key."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.lpad(_s("c_nationkey"), 5, "0").alias("geolocation_zip_code_prefix"),
        F.concat(F.lit("-"), _s(F.col("c_custkey") % 90), F.lit(".5450")).alias("geolocation_lat"),
        F.concat(F.lit("-"), _s(F.col("c_custkey") % 180), F.lit(".6390")).alias("geolocation_lng"),
        F.lower("c_mktsegment").alias("geolocation_city"),
        F.lpad(_s("c_nationkey"), 2, "0").alias("geolocation_state"))


LOG_STATUS = {"click": "started", "purchase": "success", "error": "failed"}


def raw_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as load-log rows; ``event_id`` is kept to order equal times."""
    e = table(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "click", F.lit("started")).when(
        F.col("event_type") == "purchase", F.lit("success")).when(
        F.col("event_type") == "error", F.lit("failed")).otherwise(F.lit("started"))
    return (e.select(
        F.col("event_id"),
        _s("user_id").alias("run_id"),
        F.lit("events").alias("source"),
        F.get_json_object("props", "$.k").alias("table_name"),
        status.alias("status"),
        F.col("ts").alias("started_at"),
        F.col("ts").alias("event_at")))

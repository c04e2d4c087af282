"""Staging: rename and strictly type raw all-string tables.

Each model is a declarative list of (output, source, kind).  Kinds:

  str         passed through (ids, codes, zip prefixes keep leading zeros)
  numeric     exact decimal(38,9); garbage raises
  int64       bigint; '225.0', '' and 'abc' raise
  date        date of an ISO date / datetime text
  utc         local wall clock in the business zone -> UTC instant (NTZ)
  utc_date    UTC calendar date of that instant

NULL passes every cast.  ``_loaded_at`` is carried when the raw table has it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import to_date, to_int64, to_numeric
from ..functions.timez import local_to_utc, utc_date

# Fixed value: business time zone of the order data.
BUSINESS_ZONE = "America/Sao_Paulo"

SPECS: dict[str, list[tuple[str, str, str]]] = {
    "orders": [
        ("order_id", "order_id", "str"),
        ("customer_id", "customer_id", "str"),
        ("order_status", "order_status", "str"),
        ("purchased_at", "order_purchase_timestamp", "utc"),
        ("approved_at", "order_approved_at", "utc"),
        ("delivered_carrier_at", "order_delivered_carrier_date", "utc"),
        ("delivered_customer_at", "order_delivered_customer_date", "utc"),
        ("estimated_delivery_date", "order_estimated_delivery_date", "utc_date"),
    ],
    "customers": [
        ("customer_id", "customer_id", "str"),
        ("customer_uid", "customer_unique_id", "str"),
        ("customer_zip_code_prefix", "customer_zip_code_prefix", "str"),
        ("customer_city_name", "customer_city", "str"),
        ("customer_state_code", "customer_state", "str"),
    ],
    "order_items": [
        ("order_id", "order_id", "str"),
        ("order_item_id", "order_item_id", "str"),
        ("product_id", "product_id", "str"),
        ("seller_id", "seller_id", "str"),
        ("shipping_limit_date", "shipping_limit_date", "date"),
        ("item_price", "price", "numeric"),
        ("freight_value", "freight_value", "numeric"),
    ],
    "order_payments": [
        ("order_id", "order_id", "str"),
        ("payment_sequential", "payment_sequential", "str"),
        ("payment_type", "payment_type", "str"),
        ("payment_amount", "payment_value", "numeric"),
        ("payment_installments", "payment_installments", "int64"),
    ],
    "order_reviews": [
        ("review_id", "review_id", "str"),
        ("order_id", "order_id", "str"),
        ("review_score", "review_score", "int64"),
        ("review_comment_title", "review_comment_title", "str"),
        ("review_comment_message", "review_comment_message", "str"),
        ("review_creation_date", "review_creation_date", "date"),
        ("review_answer_timestamp", "review_answer_timestamp", "date"),
    ],
    "products": [
        ("product_id", "product_id", "str"),
        ("product_category_name", "product_category_name", "str"),
        ("product_name_length", "product_name_lenght", "str"),
        ("product_description_length", "product_description_lenght", "str"),
        ("product_weight_g", "product_weight_g", "int64"),
        ("product_length_cm", "product_length_cm", "int64"),
        ("product_height_cm", "product_height_cm", "int64"),
        ("product_width_cm", "product_width_cm", "int64"),
        ("product_photos_qty", "product_photos_qty", "int64"),
    ],
    "sellers": [
        ("seller_id", "seller_id", "str"),
        ("seller_zip_code_prefix", "seller_zip_code_prefix", "str"),
        ("seller_city_name", "seller_city", "str"),
        ("seller_state_code", "seller_state", "str"),
    ],
    "geolocation": [
        ("zip_code_prefix", "geolocation_zip_code_prefix", "str"),
        ("state_code", "geolocation_state", "str"),
        ("city_name", "geolocation_city", "str"),
        ("latitude", "geolocation_lat", "str"),
        ("longitude", "geolocation_lng", "str"),
    ],
    "product_category_name_translation": [
        ("product_category_name", "product_category_name", "str"),
        ("product_category_name_en", "product_category_name_english", "str"),
    ],
    "fx_rates": [
        ("currency", "CURRENCY", "str"),
        ("rate_date", "TIME_PERIOD", "date"),
        ("rate_per_eur", "OBS_VALUE", "numeric"),
        ("obs_status", "OBS_STATUS", "str"),
    ],
}


def _typed(src: str, kind: str, zone: str):
    c = F.col(src)
    if kind == "str":
        return c
    if kind == "numeric":
        return to_numeric(c)
    if kind == "int64":
        return to_int64(c)
    if kind == "date":
        return to_date(c)
    if kind == "utc":
        return local_to_utc(c, zone)
    if kind == "utc_date":
        return utc_date(local_to_utc(c, zone))
    raise ValueError(kind)


def stage(raw: DataFrame, model: str, zone: str = BUSINESS_ZONE) -> DataFrame:
    """Typed projection of a raw table by the model's spec."""
    cols = [_typed(src, kind, zone).alias(out) for out, src, kind in SPECS[model]]
    if "_loaded_at" in raw.columns:
        cols.append(F.col("_loaded_at"))
    return raw.select(*cols)


def products_counted_photos(raw: DataFrame) -> DataFrame:
    """The as-written product model: grouped by its first nine columns with
    ``count(cast(photos as int64))`` -- 1 when the value is present, else 0."""
    spec = dict((out, (src, kind)) for out, src, kind in SPECS["products"])
    firsts = ["product_id", "product_category_name", "product_name_length",
              "product_description_length", "product_weight_g", "product_length_cm",
              "product_height_cm", "product_width_cm"]
    cols = [_typed(*spec[o], BUSINESS_ZONE).alias(o) for o in firsts]
    ninth = F.col("_loaded_at") if "_loaded_at" in raw.columns else F.lit(None).cast(
        "timestamp").alias("_loaded_at")
    grouped = raw.select(*cols, ninth.alias("_loaded_at"),
                         to_int64("product_photos_qty").alias("_photos"))
    return (grouped.groupBy(*firsts, "_loaded_at")
                   .agg(F.count("_photos").alias("product_photos_qty")))

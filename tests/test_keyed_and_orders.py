import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from sluice.operators import keyed, quality
from sluice.plans import fx_daily, orders_mart
from sluice.plans.staging import stage

from conftest import rows

PAY = "order_id string, payment_sequential string, payment_type string, payment_value string, payment_installments string"


def pays(spark, data):
    return stage(spark.createDataFrame(data, PAY), "order_payments")


def test_main_payment_type_rules(spark):
    data = [
        # tie on amount: the type used first wins
        ("o1", "2", "voucher", "50", "1"), ("o1", "1", "card", "50", "1"),
        # sequences "10" and "2": compared as numbers, so "2" is first
        ("o2", "10", "card", "20", "1"), ("o2", "2", "boleto", "20", "1"),
        # two small card payments beat one larger voucher
        ("o3", "1", "voucher", "50", "1"), ("o3", "2", "card", "30", "3"), ("o3", "3", "card", "30", "3"),
        # NULL amount never beats a real one
        ("o4", "1", "debit", None, "1"), ("o4", "2", "card", "1", "1"),
    ]
    out = {r["order_id"]: r for r in orders_mart.payments_by_order(pays(spark, data)).collect()}
    assert {k: v["main_payment_type"] for k, v in out.items()} == {
        "o1": "card", "o2": "boleto", "o3": "card", "o4": "card"}
    assert out["o3"]["total_paid"] == Decimal("110") and out["o3"]["payment_count"] == 3
    ranked = orders_mart.ranked_payment_types(pays(spark, data)).filter("type_rank = 1")
    assert {r["order_id"]: r["payment_type"] for r in ranked.collect()} == {
        k: v["main_payment_type"] for k, v in out.items()}


def test_main_type_with_many_types_equals_the_window_form(spark):
    import random

    rnd = random.Random(3)
    types = [f"type{i}" for i in range(100)] + [None]
    data = [(f"o{rnd.randrange(60)}", str(rnd.randrange(1, 12)), rnd.choice(types),
             rnd.choice(["1.00", "2.00", "2.00", None]), "1") for _ in range(3000)]
    p = pays(spark, data)
    out = {r["order_id"]: r["main_payment_type"] for r in orders_mart.payments_by_order(p).collect()}
    ranked = orders_mart.ranked_payment_types(p).filter("type_rank = 1")
    assert out == {r["order_id"]: r["payment_type"] for r in ranked.collect()}


def test_payments_by_order_on_no_payments(spark):
    empty = pays(spark, [])
    out = orders_mart.payments_by_order(empty)
    assert out.columns == ["order_id", "total_paid", "payment_count", "main_payment_type"]
    assert out.count() == 0


def test_last_n_per_key(spark):
    df = spark.createDataFrame([(k, i) for k in ("hot",) * 50 + ("cold",) * 2 for i in range(1)]
                               + [("hot", i) for i in range(1, 40)], "k string, i int")
    out = keyed.last_n_per_key(df, "k", [F.col("i").desc()], 3)
    assert rows(out, "k", "i") == [("cold", 0), ("cold", 0), ("hot", 37), ("hot", 38), ("hot", 39)]


ORD = ("order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
       "order_approved_at string, order_delivered_carrier_date string, "
       "order_delivered_customer_date string, order_estimated_delivery_date string")
ITEMS = ("order_id string, order_item_id string, product_id string, seller_id string, "
         "shipping_limit_date string, price string, freight_value string")


def fixture(spark):
    orders = stage(spark.createDataFrame([
        ("both", "c1", "delivered", "2018-03-05 10:00:00", None, None, None, None),
        ("no_items", "c2", "canceled", "2018-03-05 11:00:00", None, None, None, None),
        ("no_pay", "c3", "created", "2018-03-05 12:00:00", None, None, None, None),
        ("neither", "c4", "unavailable", "2018-03-05 13:00:00", None, None, None, None),
        # 23:30 local on Saturday 10th is Sunday in UTC; the local day's rate applies
        ("late", "c5", "delivered", "2018-03-10 23:30:00", None, None, None, None),
        # outside the calendar -> NULL rate
        ("early", "c6", "delivered", "2017-01-01 10:00:00", None, None, None, None),
    ], ORD), "orders")
    items = stage(spark.createDataFrame([
        ("both", "1", "p", "s", "2018-03-06 00:00:00", "10.00", "2.50"),
        ("both", "2", "p", "s", "2018-03-06 00:00:00", "5.00", "0.00"),
        ("no_pay", "1", "p", "s", "2018-03-06 00:00:00", "7.00", "1.00"),
        ("late", "1", "p", "s", "2018-03-12 00:00:00", "100.00", "0.00"),
        ("early", "1", "p", "s", "2017-01-02 00:00:00", "1.00", "0.00"),
    ], ITEMS), "order_items")
    payments = pays(spark, [
        ("both", "1", "card", "17.50", "2"), ("no_items", "1", "voucher", "3.00", "1"),
        ("late", "1", "card", "100.00", "1"), ("early", "1", "card", "1.00", "1"),
    ])
    fx = fx_daily.rates_daily(spark.createDataFrame([
        ("GBP", dt.date(2018, 3, 5), Decimal("0.88")), ("BRL", dt.date(2018, 3, 5), Decimal("4.30")),
        ("GBP", dt.date(2018, 3, 9), Decimal("0.90")), ("BRL", dt.date(2018, 3, 9), Decimal("4.50")),
        ("GBP", dt.date(2018, 3, 12), Decimal("0.91")), ("BRL", dt.date(2018, 3, 12), Decimal("4.55")),
    ], "currency string, rate_date date, rate_per_eur decimal(38,9)"))
    return orders, items, payments, fx


def test_order_fact(spark):
    orders, items, payments, fx = fixture(spark)
    fct = {r["order_id"]: r for r in orders_mart.order_fact(orders, items, payments, fx).collect()}
    assert len(fct) == 6
    b = fct["both"]
    assert (b["item_count"], b["items_value_brl"], b["freight_value_brl"], b["gross_revenue_brl"]) == (
        2, Decimal("15"), Decimal("2.5"), Decimal("17.5"))
    assert b["gbp_per_brl"] == Decimal("0.204651163")
    assert b["gross_revenue_gbp"] == Decimal("3.58")          # round(17.5 * 0.204651163, 2)
    assert fct["no_items"]["item_count"] == 0 and fct["no_items"]["gross_revenue_brl"] is None
    assert fct["no_items"]["paid_brl"] == Decimal("3")
    assert fct["no_pay"]["payment_count"] == 0 and fct["no_pay"]["main_payment_type"] is None
    assert fct["neither"]["item_count"] == 0 and fct["neither"]["payment_count"] == 0
    late = fct["late"]
    assert late["purchased_at"] == dt.datetime(2018, 3, 11, 2, 30)
    assert late["purchase_date"] == dt.date(2018, 3, 10)
    assert late["is_fx_forward_filled"] is True and late["gbp_per_brl"] == Decimal("0.2")
    assert fct["early"]["gbp_per_brl"] is None and fct["early"]["gross_revenue_gbp"] is None


def test_mutation_inner_join_is_caught_by_row_count_not_revenue(spark):
    orders, items, payments, fx = fixture(spark)
    raw_total = items.select((F.col("item_price") + F.col("freight_value")).alias("v"))
    for how, count_fails in (("left", False), ("inner", True)):
        fct = orders_mart.order_fact(orders, items, payments, fx, items_join=how)
        parity = quality.row_count_parity(fct, orders, "row count")
        recon = quality.totals_reconcile(fct, F.col("gross_revenue_brl"), raw_total, F.col("v"),
                                         "fct_total", "raw_total")
        assert (parity.count() == 1) is count_fails
        assert recon.count() == 0


def test_main_type_equals_row_number_on_driver_data(spark):
    import os

    from sluice.plans import models

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        return
    p = models.stg_payments_by_quantity(spark, d)          # many equal amounts: ties
    main = orders_mart.payments_by_order(p).select("order_id", "main_payment_type")
    ranked = (orders_mart.ranked_payment_types(p).filter("type_rank = 1")
              .select("order_id", F.col("payment_type").alias("main_payment_type")))
    assert rows(main) == rows(ranked)
    assert main.count() > 1000

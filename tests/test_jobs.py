"""End to end through the command-line jobs: bulk load -> rate load -> build."""

import datetime as dt
import os

import pytest

from sluice import jobs

ORDERS = ("order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
          "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
          "o1,c1,delivered,2018-03-05 10:00:00,2018-03-05 10:10:00,2018-03-06 09:00:00,"
          "2018-03-09 15:00:00,2018-03-20 00:00:00\n"
          "o2,c2,shipped,2018-03-10 23:30:00,,,,2018-03-30 00:00:00\n")
CUSTOMERS = ("customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
             "c1,u1,01001,sao paulo,SP\nc2,u2,20000,rio de janeiro,RJ\n")
ITEMS = ("order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
         "o1,1,p1,s1,2018-03-07 00:00:00,10.00,2.50\no1,2,p2,s1,2018-03-07 00:00:00,5.00,0.00\n"
         "o2,1,p1,s1,2018-03-12 00:00:00,100.00,0.00\n")
PAYMENTS = ("order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
            "o1,1,credit_card,3,17.50\no2,1,boleto,1,100.00\n")
PRODUCTS = ("product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,"
            "product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
            "p1,toys,10,20,1,100,10,10,10\np2,toys,11,21,,200,10,10,10\n")
SELLERS = "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01001,sao paulo,SP\n"
TRANSLATION = "product_category_name,product_category_name_english\ntoys,toys\n"
DIMENSIONS = (("products", PRODUCTS), ("sellers", SELLERS), ("product_category_name_translation", TRANSLATION))
RATE_HEADER = "KEY,FREQ,CURRENCY,CURRENCY_DENOM,EXR_TYPE,EXR_SUFFIX,TIME_PERIOD,OBS_VALUE,OBS_STATUS\n"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def rates_csv(path):
    lines = [RATE_HEADER]
    d = dt.date(2017, 12, 1)
    while d <= dt.date(2019, 1, 31):
        if d.weekday() < 5:
            for ccy, v in (("GBP", "0.88"), ("BRL", "4.30")):
                lines.append(f"D.{ccy}.EUR.SP00.A,D,{ccy},EUR,SP00,A,{d},{v},A\n")
        d += dt.timedelta(days=1)
    return write(path, "".join(lines))


def run_flow(spark, root, payments):
    src = {n: write(f"{root}/src/{n}.csv", t) for n, t in
           (("orders", ORDERS), ("customers", CUSTOMERS), ("order_items", ITEMS),
            ("order_payments", payments), *DIMENSIONS)}
    args = ["bulk-load", "--source", "shop", "--landing", f"{root}/landing",
            "--warehouse", f"{root}/wh", "--log", f"{root}/log", "--load-date", "2024-01-01"]
    for name, path in src.items():
        args += ["--table", f"{name}={path}"]
    assert jobs.main(args) == 0
    rates = rates_csv(f"{root}/src/rates.csv")
    assert jobs.main(["rate-load", "--rates", rates, "--table", f"{root}/rates", "--log", f"{root}/log",
                      "--currencies", "gbp, brl", "--today", "2019-02-01"]) == 0
    return jobs.main(["build", "--warehouse", f"{root}/wh", "--source", "shop",
                      "--rates", f"{root}/rates", "--mart", f"{root}/mart"])


def test_clean_flow_passes(spark, tmpdir_path, capsys):
    assert run_flow(spark, tmpdir_path, PAYMENTS) == 0
    out = capsys.readouterr().out
    assert "7 succeeded, 0 failed" in out and "fct_orders: 2 rows; 0 blocking" in out
    rates = f"{tmpdir_path}/rates"
    from sluice.operators.tables import VersionedTable

    uris = {r["_source_uri"] for r in VersionedTable(spark, rates).read().select("_source_uri").collect()}
    assert len(uris) == 1 and uris.pop().endswith("src/rates.csv")      # the file, not a folder
    assert "_file" not in VersionedTable(spark, rates).read().columns
    assert jobs.main(["freshness", "--rates", rates, "--now", "2019-02-03T00:00:00"]) == 0
    assert jobs.main(["freshness", "--rates", rates, "--now", "2019-02-05T00:00:00"]) == 0   # warn
    assert jobs.main(["freshness", "--rates", rates, "--now", "2019-02-08T00:00:00"]) == 1   # error
    out = capsys.readouterr().out
    assert "pass newest=2019-01-31" in out and "warn newest" in out and "error newest" in out
    assert jobs.main(["log-report", "--log", f"{tmpdir_path}/log"]) == 0
    assert "dead runs: 0" in capsys.readouterr().out
    assert jobs.main(["vacuum", "--table", rates, "--keep", "1"]) == 0
    assert "removed 0 data folder(s)" in capsys.readouterr().out      # one version so far


def test_planted_fault_blocks(spark, tmpdir_path, capsys):
    faulty = PAYMENTS + "o1,2,voucher,30,1.00\n"      # 30 instalments and paid != gross
    assert run_flow(spark, tmpdir_path, faulty) == 1
    out = capsys.readouterr().out
    assert "error accepted_range_stg_order_payments_payment_installments (1)" in out
    assert "warn  assert_order_paid_matches_gross_revenue (1)" in out


def test_build_views_and_materialized_staging_agree(spark, tmpdir_path):
    from sluice.operators.tables import VersionedTable
    from sluice.plans.build import build
    from sluice.plans.rate_load import RATE_PARTITION

    root = tmpdir_path
    assert run_flow(spark, root, PAYMENTS + "o1,2,voucher,30,1.00\n") == 1
    raw = {f"raw_{n}": VersionedTable(spark, f"{root}/wh/shop_{n}").read()
           for n in ("orders", "customers", "order_items", "order_payments", *dict(DIMENSIONS))}
    raw["raw_fx_rates"] = VersionedTable(spark, f"{root}/rates", RATE_PARTITION).read()
    a = build(spark, raw, f"{root}/m1", register_views=False, materialize_staging=True).tests
    b = build(spark, raw, f"{root}/m2", register_views=False, materialize_staging=False).tests
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_retry_failed_loads_only_failed_tables(spark, tmpdir_path, capsys):
    root = tmpdir_path
    orders = write(f"{root}/src/orders.csv", ORDERS)
    items = write(f"{root}/src/order_items.csv", ITEMS + "o9,1,p1\n")          # ragged row
    common = ["bulk-load", "--source", "shop", "--landing", f"{root}/landing", "--warehouse",
              f"{root}/wh", "--log", f"{root}/log", "--table", f"orders={orders}",
              "--table", f"order_items={items}"]
    assert jobs.main(common) == 1
    write(items, ITEMS)                                                       # fixed upstream
    assert jobs.main(common + ["--retry-failed"]) == 0
    out = capsys.readouterr().out
    assert "retrying: order_items" in out and "1 succeeded, 0 failed" in out
    assert jobs.main(common + ["--retry-failed"]) == 0
    assert "retrying: nothing" in capsys.readouterr().out
    assert jobs.main(common + ["--only", "orders"]) == 0


def test_rate_stream_job(spark, tmpdir_path, capsys):
    base = f"{tmpdir_path}/landing/ecb/rates"
    write(f"{base}/load_date=2019-01-02/r.csv",
          RATE_HEADER + "D.GBP.EUR.SP00.A,D,GBP,EUR,SP00,A,2019-01-02,0.90,A\n")
    args = ["rate-stream", "--landing", base, "--table", f"{tmpdir_path}/t", "--checkpoint", f"{tmpdir_path}/ck"]
    assert jobs.main(args) == 0
    write(f"{base}/load_date=2019-01-03/r.csv",
          RATE_HEADER + "D.GBP.EUR.SP00.A,D,GBP,EUR,SP00,A,2019-01-03,0.91,A\n")
    assert jobs.main(args) == 0
    out = capsys.readouterr().out
    assert "rates table at version 1" in out and "rates table at version 2" in out


def test_build_with_no_payments(spark, tmpdir_path):
    from sluice.plans.build import build
    from sluice.sources.csv_files import read_raw_csv

    raw = {f"raw_{n}": read_raw_csv(spark, write(f"{tmpdir_path}/{n}.csv", t)) for n, t in
           (("orders", ORDERS), ("customers", CUSTOMERS), ("order_items", ITEMS),
            ("order_payments", PAYMENTS.splitlines()[0] + "\n"), *DIMENSIONS)}
    raw["raw_fx_rates"] = read_raw_csv(spark, rates_csv(f"{tmpdir_path}/rates.csv"))
    result = build(spark, raw, f"{tmpdir_path}/mart", register_views=False)
    status = {r["test_name"]: r["status"] for r in result.tests.collect()}
    for absent in ("raw_fx_rates", "raw_sellers"):           # never fewer tests without a word
        with pytest.raises(ValueError, match=absent):
            build(spark, {k: v for k, v in raw.items() if k != absent}, f"{tmpdir_path}/m2")
    assert result.fct_rows == 2 and len(status) == 48
    assert status["assert_some_payments_have_instalments"] == "error"
    assert status["not_null_int_order_payments_by_order_order_id"] == "pass"

import datetime as dt

import pytest

from sluice.plans.staging import SPECS, products_counted_photos, stage


def raw(spark, model, values):
    cols = [src for _, src, _ in SPECS[model]]
    return spark.createDataFrame([values], ", ".join(f"{c} string" for c in cols))


def test_reviews_geolocation_translation(spark):
    r = stage(raw(spark, "order_reviews", ["r1", "o1", "5", "t", "line\nbreak", "2018-01-18 00:00:00",
                                           "2018-01-21 13:59:00"]), "order_reviews").first()
    assert r["review_score"] == 5 and r["review_answer_timestamp"] == dt.date(2018, 1, 21)
    with pytest.raises(Exception, match="INT64"):
        stage(raw(spark, "order_reviews", ["r", "o", "five", None, None, None, None]),
              "order_reviews").collect()
    g = stage(raw(spark, "geolocation", ["01037", "SP", "sao paulo", "-23.54", "-46.63"]),
              "geolocation").first()
    assert g.asDict() == {"zip_code_prefix": "01037", "state_code": "SP", "city_name": "sao paulo",
                          "latitude": "-23.54", "longitude": "-46.63"}
    t = stage(raw(spark, "product_category_name_translation", ["beleza_saude", "health_beauty"]),
              "product_category_name_translation").first()
    assert t["product_category_name_en"] == "health_beauty"


def test_products_cast_and_counted_form(spark):
    vals = ["p1", "cat", "40", "287", "225", "16", "10", "14", "3"]
    p = stage(raw(spark, "products", vals), "products").first()
    assert p["product_photos_qty"] == 3 and p["product_name_length"] == "40"
    counted = products_counted_photos(raw(spark, "products", vals)).first()
    assert counted["product_photos_qty"] == 1          # the as-written count
    none = products_counted_photos(raw(spark, "products", vals[:8] + [None])).first()
    assert none["product_photos_qty"] == 0
    with pytest.raises(Exception, match="INT64"):
        stage(raw(spark, "products", vals[:4] + ["225.0"] + vals[5:]), "products").collect()


def test_orders_model_all_times_and_audit_passthrough(spark):
    from pyspark.sql import functions as F

    vals = ["o1", "c1", "delivered", "2018-03-05 10:00:00", "2018-03-05 10:10:00",
            "2018-03-06 09:00:00", "2018-03-09 15:00:00", "2018-03-20 00:00:00"]
    df = raw(spark, "orders", vals).withColumn("_loaded_at", F.lit(dt.datetime(2024, 1, 1)))
    r = stage(df, "orders").first()
    assert r["purchased_at"] == dt.datetime(2018, 3, 5, 13, 0)
    assert r["approved_at"] == dt.datetime(2018, 3, 5, 13, 10)
    assert r["delivered_carrier_at"] == dt.datetime(2018, 3, 6, 12, 0)
    assert r["delivered_customer_at"] == dt.datetime(2018, 3, 9, 18, 0)
    assert r["estimated_delivery_date"] == dt.date(2018, 3, 20)
    assert r["_loaded_at"] is not None and "_loaded_at" in stage(df, "orders").columns


def test_zone_transitions_and_rules(spark):
    import datetime as dt

    import pytest

    from sluice.operators import zones

    T = dt.datetime
    changes = zones.transitions(spark, "America/Sao_Paulo", dt.date(2017, 6, 1), dt.date(2018, 6, 1))
    got = [(r["kind"], r["at_utc"], r["wall_from"], r["wall_to"]) for r in changes.orderBy("at_utc").collect()]
    assert got == [("gap", T(2017, 10, 15, 3), T(2017, 10, 15, 0), T(2017, 10, 15, 1)),
                   ("overlap", T(2018, 2, 18, 2), T(2018, 2, 17, 23), T(2018, 2, 18, 0))]
    odd = zones.transitions(spark, "Australia/Lord_Howe", dt.date(2019, 1, 1), dt.date(2020, 1, 1)).collect()
    assert sorted(abs(r["after_s"] - r["before_s"]) for r in odd) == [1800, 1800]       # half an hour
    walls = [T(2017, 10, 14, 23, 59, 59), T(2017, 10, 15), T(2017, 10, 15, 0, 30), T(2017, 10, 15, 1),
             T(2018, 2, 17, 22, 59), T(2018, 2, 17, 23), T(2018, 2, 17, 23, 59, 59), T(2018, 2, 18), None]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(walls)], "i int, w timestamp_ntz")
    res = {rule: {r["i"]: (r["wall_kind"], r["at_utc"]) for r in zones.resolve_wall_clock(
        df, "w", "America/Sao_Paulo", changes, rule).collect()} for rule in ("earlier", "later")}
    assert [res["earlier"][i][0] for i in range(9)] == [None, "gap", "gap", None, None, "overlap", "overlap", None, None]
    assert res["earlier"][2] == ("gap", T(2017, 10, 15, 3, 30)) == res["later"][2]
    assert res["earlier"][5][1] == T(2018, 2, 18, 1) and res["later"][5][1] == T(2018, 2, 18, 2)
    assert res["earlier"][4][1] == T(2018, 2, 18, 0, 59) and res["earlier"][7][1] == T(2018, 2, 18, 3)
    with pytest.raises(Exception, match="no single instant"):
        zones.resolve_wall_clock(df, "w", "America/Sao_Paulo", changes, "fail").collect()
    assert zones.resolve_wall_clock(df.where("i in (0, 3, 4, 7)"), "w", "America/Sao_Paulo", changes, "fail").count() == 4


def test_utc_date_instead_of_the_local_one_is_caught(spark):
    """The fact joins rates by the local purchase day; with the UTC day it differs."""
    from sluice.functions.timez import utc_date, utc_to_local_date
    from sluice.plans import models

    o = models.stg_orders(spark, "/root/testdata/sf0.001").select(
        "order_id", utc_date("purchased_at").alias("u"), utc_to_local_date("purchased_at", "America/Sao_Paulo").alias("l"))
    n = o.count()
    assert 0.05 * n < o.where("u <> l").count() < 0.2 * n      # purchases after 21 or 22 o'clock

"""Distributed prefix scan and the as-of join on it, against plain Python."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sluice.operators import scan, series

D = dt.date


def events(seed, n=2000):
    """A third of all events belong to one user, within one hour."""
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        hot = i % 3 == 0
        user = "hot" if hot else rnd.choice([f"u{i % 17}", None])
        minutes = rnd.randrange(60) if hot else rnd.randrange(60 * 24 * 20)
        ts = None if i % 97 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)
        data.append((i, user, ts, rnd.choice([None, None, None, Decimal(rnd.randrange(1, 100))])))
    return data


@pytest.mark.parametrize("seed, parts", [(1, None), (2, 1), (3, 40)])
def test_running_equals_the_window_form(spark, seed, parts):
    df = spark.createDataFrame(events(seed), "id int, user string, ts timestamp_ntz, v decimal(18,2)")
    got = scan.running(df, ["user"], ["ts", "id"], last={"l": F.col("v")}, total={"s": F.col("v")}, parts=parts)
    want = series.last_non_null(df, F.col("v"), ["user"], [F.col("ts"), F.col("id")], "l")
    assert rows(got, "id", "l") == rows(want, "id", "l")
    sums, so_far = {}, {}
    for i, user, ts, v in sorted(events(seed), key=lambda r: (r[2] is not None, r[2] or dt.datetime.min, r[0])):
        if v is not None:
            so_far[user] = so_far.get(user, 0) + v
        sums[i] = so_far.get(user)
    assert {r["id"]: r["s"] for r in got.collect()} == sums
    assert got.filter("l IS NOT NULL").count() > 500


def test_running_spreads_a_hot_group_of_one_hour(spark, monkeypatch):
    kept = []
    real = scan.materialize
    monkeypatch.setattr(scan, "materialize", lambda df, label: kept.append(real(df, label)) or kept[-1])
    df = spark.createDataFrame(events(5, 6000), "id int, user string, ts timestamp_ntz, v decimal(18,2)")
    got = scan.running(df, ["user"], ["ts", "id"], last={"l": F.col("v")}, parts=24)
    assert got.count() == 6000
    hot = kept[0].where("user = 'hot'").groupBy("_part").count().collect()
    assert len(hot) >= 6 and max(r["count"] for r in hot) < 1000     # 2,000 rows of one user and hour


def test_running_of_the_whole_table_and_of_none(spark):
    df = spark.createDataFrame([(i, i % 7 or None) for i in range(500)], "id int, v int").repartition(5)
    got = scan.running(df, [], ["id"], last={"l": F.col("v")}, total={"s": F.col("v")}, parts=9)
    last, total, want = None, None, []
    for i in range(500):
        if i % 7:
            last, total = i % 7, (total or 0) + i % 7
        want.append((i, last, total))
    assert rows(got, "id", "l", "s") == sorted(want, key=repr)
    assert scan.running(df.limit(0), [], ["id"], last={"l": F.col("v")}).collect() == []


def test_asof_join_matches_brute_force(spark):
    obs = spark.createDataFrame(
        [(D(2018, 1, 5), 1), (D(2018, 2, 20), 2), (D(2018, 2, 21), 3), (D(2018, 5, 1), 4), (None, 9)], "d date, v int")
    days = [D(2018, 1, 1) + dt.timedelta(days=i) for i in range(0, 200, 3)]
    left = spark.createDataFrame([(i, d) for i, d in enumerate(days)] + [(999, None)], "id int, day date")
    got = {r["id"]: (r["d"], r["v"]) for r in scan.asof_join(left, "day", obs, "d", ["v"], parts=7).collect()}
    known = sorted((r["d"], r["v"]) for r in obs.collect() if r["d"])
    for i, day in enumerate(days):
        before = [o for o in known if o[0] <= day]
        assert got[i] == (before[-1] if before else (None, None)), day
    assert got[999] == (None, None) and len(got) == len(days) + 1


def test_asof_join_per_series_and_hot_time(spark):
    obs = spark.createDataFrame(
        [("x", D(2018, 1, 5), 1), ("x", D(2018, 3, 1), 2), ("x", D(2018, 3, 1), 1), ("y", D(2018, 2, 1), 7), (None, D(2018, 1, 1), 5)],
        "s string, d date, v int")
    cases = [(1, "x", D(2018, 1, 4)), (2, "x", D(2018, 2, 28)), (3, "x", D(2019, 1, 1)), (4, "y", D(2018, 1, 31)),
             (5, "y", D(2018, 12, 1)), (6, "z", D(2018, 6, 1)), (7, None, D(2018, 6, 1))]
    many = [(i, "x", D(2018, 3, 1)) for i in range(100, 1100)]        # one key and one day
    left = spark.createDataFrame(cases + many, "id int, s string, day date")
    got = {r["id"]: r["v"] for r in scan.asof_join(left, "day", obs, "d", ["v"], by=["s"], parts=12).collect()}
    assert {i: got[i] for i in range(1, 8)} == {1: None, 2: 1, 3: 2, 4: None, 5: 7, 6: None, 7: 5}
    assert all(got[i] == 2 for i in range(100, 1100)) and len(got) == 1007


def test_asof_join_with_no_observations(spark):
    obs = spark.createDataFrame([], "d date, v int")
    left = spark.createDataFrame([(1, D(2018, 1, 4))], "id int, day date")
    assert [(r["id"], r["v"]) for r in scan.asof_join(left, "day", obs, "d", ["v"]).collect()] == [(1, None)]

"""One key holding about a third of all rows: results stay exact and whole."""

from decimal import Decimal

from pyspark.sql import functions as F

from sluice.operators import keyed, quality
from sluice.plans import orders_mart
from sluice.plans.staging import stage
from sluice.session import scale_conf

N = 3000


def skewed_payments(spark):
    rows = []
    for i in range(N):
        order = "hot" if i % 3 == 0 else f"o{i}"
        rows.append((order, str(i), "card" if i % 2 else "voucher", "1.00", "1"))
    return stage(spark.createDataFrame(
        rows, "order_id string, payment_sequential string, payment_type string, "
              "payment_value string, payment_installments string").repartition(8), "order_payments")


def test_hot_order_through_keyed_operators(spark):
    pays = skewed_payments(spark)
    out = {r["order_id"]: r for r in orders_mart.payments_by_order(pays).collect()}
    hot = out["hot"]
    assert hot["payment_count"] == N // 3 and hot["total_paid"] == Decimal(N // 3)
    assert hot["main_payment_type"] == "voucher"           # 500 x 1.00 each: tie -> used first (seq 0)
    assert len(out) == 1 + N - N // 3
    dups = quality.test_unique(pays, "order_id").collect()
    assert [(r["order_id"], r["n_records"]) for r in dups] == [("hot", N // 3)]
    parent = pays.select("order_id").filter(F.col("order_id") != "hot").distinct()
    orphans = quality.test_relationships(pays, "order_id", parent, "order_id").collect()
    assert [(r["order_id"], r["n_records"]) for r in orphans] == [("hot", N // 3)]
    last = keyed.last_n_per_key(pays, "order_id", [F.col("payment_sequential").cast("int").desc()], 2)
    assert sorted(r["payment_sequential"] for r in last.filter("order_id = 'hot'").collect()) == ["2994", "2997"]


def test_scale_conf_sizes_partitions():
    assert scale_conf(100 * 2**40)["spark.sql.shuffle.partitions"] == "409600"   # 100 TiB / 256 MiB
    assert scale_conf(2**40)["spark.sql.shuffle.partitions"] == "4096"            # 1 TiB / 256 MiB
    assert int(scale_conf(10 * 2**30)["spark.sql.shuffle.partitions"]) == 200   # floor for small inputs


def test_row_level_join_splits_a_hot_key(spark):
    """Items (a third on one order) joined to orders: AQE splits the skewed
    partition instead of sending the hot order to one task."""
    keys = ["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.coalescePartitions.enabled"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in zip(keys, ["1KB", "2", "1KB", "-1", "-1", "false"]):
        spark.conf.set(k, v)
    try:
        n = 30000
        items = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("o"), F.col("id").cast("string")))
            .alias("order_id"), F.col("id").alias("line")).repartition(8)
        orders = (spark.range(n).select(F.concat(F.lit("o"), F.col("id").cast("string")).alias("order_id"))
                  .union(spark.createDataFrame([("hot",)], "order_id string")))
        joined = items.join(orders, "order_id")
        assert len(joined.collect()) == n            # runs this DataFrame's own (adaptive) plan
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluice.operators.quality import DataCheckError
from sluice.operators.tables import (VersionedTable, high_water_mark_frame, load_window,
                                     merge_by_keys, with_audit)

from conftest import rows

SCHEMA = "k string, t string, v int, note string"


def test_replace_is_atomic_and_counted(spark, tmpdir_path):
    t = VersionedTable(spark, os.path.join(tmpdir_path, "tbl"))
    assert not t.exists()
    a = spark.createDataFrame([("a", "1", 1, "x"), ("b", "1", 2, "y")], SCHEMA)
    assert t.replace(a, expected_rows=2) == 2
    v1 = t.current_path()
    b = spark.createDataFrame([("c", "1", 3, "z")], SCHEMA)
    with pytest.raises(DataCheckError, match="mismatch"):
        t.replace(b, expected_rows=5)              # count check fails: nothing committed
    assert t.current_path() == v1 and rows(t.read(), "k") == [("a",), ("b",)]
    assert len(os.listdir(os.path.join(tmpdir_path, "tbl", "data"))) == 1   # staged folder removed
    with pytest.raises(DataCheckError, match="no data rows"):
        t.replace(b.limit(0), expected_rows=0)
    t.replace(b)
    assert t.version() == 2 and rows(t.read(), "k") == [("c",)]


def test_merge_semantics(spark):
    target = spark.createDataFrame([
        ("a", "1", 1, "keep-me"),      # matched, changed
        ("b", "1", 2, "same"),         # matched, unchanged
        ("c", "1", 3, "target only"),  # not in source: stays
        (None, "1", 4, "null key"),    # NULL key never matches: stays
    ], SCHEMA)
    source = spark.createDataFrame([
        ("a", "1", 10), ("b", "1", 2), ("d", "1", 5), (None, "1", 6),
    ], "k string, t string, v int")   # no 'note' column
    out = merge_by_keys(target, source, ["k", "t"])
    assert rows(out) == sorted([
        ("a", "1", 10, "keep-me"), ("b", "1", 2, "same"), ("c", "1", 3, "target only"),
        (None, "1", 4, "null key"), ("d", "1", 5, None), (None, "1", 6, None),
    ], key=repr)
    extra = source.withColumn("new_col", F.lit(1))
    with pytest.raises(ValueError, match="new_col"):
        merge_by_keys(target, extra, ["k", "t"])


def test_upsert_first_run_then_merge_and_duplicates(spark, tmpdir_path):
    t = VersionedTable(spark, os.path.join(tmpdir_path, "u"))
    first = spark.createDataFrame([("a", "1", 1, "x")], SCHEMA)
    t.upsert(with_audit(first, "uri-1"), ["k", "t"])
    second = spark.createDataFrame([("a", "1", 2, "y"), ("b", "1", 3, "z")], SCHEMA)
    t.upsert(with_audit(second, "uri-2"), ["k", "t"])
    got = rows(t.read(), "k", "v", "_source_uri")
    assert got == [("a", 2, "uri-2"), ("b", 3, "uri-2")]  # audit columns refreshed on match
    dup = spark.createDataFrame([("a", "1", 1, "x"), ("a", "1", 2, "y")], SCHEMA)
    with pytest.raises(DataCheckError, match="duplicate"):
        t.upsert(dup, ["k", "t"])
    assert t.version() == 2


def test_high_water_mark(spark, tmpdir_path):
    df = spark.createDataFrame([("2018-01-10",), ("2018-01-02",)], "TIME_PERIOD string")
    r = high_water_mark_frame(df, "TIME_PERIOD").first()
    assert r["latest"] == "2018-01-10" and r["start_date"] == dt.date(2018, 1, 3)
    empty = high_water_mark_frame(df.limit(0), "TIME_PERIOD").first()
    assert empty["latest"] is None and empty["start_date"] == dt.date(2016, 1, 1)
    bad = spark.createDataFrame([("2018-13-45",)], "TIME_PERIOD string")
    with pytest.raises(Exception, match="DATE"):
        high_water_mark_frame(bad, "TIME_PERIOD").collect()

    t = VersionedTable(spark, os.path.join(tmpdir_path, "fx"))
    today = dt.date(2024, 1, 31)
    assert load_window(t, "TIME_PERIOD", today) == (dt.date(2016, 1, 1), today)
    t.replace(df)
    assert load_window(t, "TIME_PERIOD", today) == (dt.date(2018, 1, 3), today)
    assert load_window(t, "TIME_PERIOD", today, force_default=True)[0] == dt.date(2016, 1, 1)


def test_partitioned_upsert_rewrites_only_touched_partitions(spark, tmpdir_path):
    data = [(f"D.{c}", c, f"{y}-0{m}-01", f"{y}.{m}") for c in ("GBP", "BRL")
            for y in (2016, 2017, 2018) for m in (1, 2)]
    schema = "KEY string, CURRENCY string, TIME_PERIOD string, OBS_VALUE string"
    t = VersionedTable(spark, os.path.join(tmpdir_path, "p"), partition_expr="substring(TIME_PERIOD, 1, 4)")
    t.upsert(spark.createDataFrame(data, schema), ["KEY", "TIME_PERIOD"])
    before = t.partitions()
    assert sorted(before) == ["2016", "2017", "2018"]
    batch = spark.createDataFrame([("D.GBP", "GBP", "2018-02-01", "9.9"), ("D.GBP", "GBP", "2018-03-01", "8.8")],
                                  schema)
    written = t.upsert(batch, ["KEY", "TIME_PERIOD"])
    after = t.partitions()
    assert written == 5                                        # only 2018 was rewritten
    assert after["2016"] == before["2016"] and after["2017"] == before["2017"]
    assert after["2018"] != before["2018"]
    flat = VersionedTable(spark, os.path.join(tmpdir_path, "flat"))
    flat.upsert(spark.createDataFrame(data, schema), ["KEY", "TIME_PERIOD"])
    flat.upsert(batch, ["KEY", "TIME_PERIOD"])
    assert rows(t.read()) == rows(flat.read())
    assert rows(t.read(partitions=["2018"]), "TIME_PERIOD", "OBS_VALUE")[-2:] == [
        ("2018-02-01", "9.9"), ("2018-03-01", "8.8")]
    assert t.read(partitions=["1999"]).count() == 0


def test_concurrent_commit_is_refused(spark, tmpdir_path):
    from sluice.operators.tables import ConcurrentCommitError

    t = VersionedTable(spark, os.path.join(tmpdir_path, "c"))
    t.replace(spark.createDataFrame([("a", "1", 1, "x")], SCHEMA))
    base = t.version()
    other = VersionedTable(spark, t.root)
    other.replace(spark.createDataFrame([("b", "1", 2, "y")], SCHEMA))       # commits version 2
    with pytest.raises(ConcurrentCommitError):
        t._write_and_commit(spark.createDataFrame([("c", "1", 3, "z")], SCHEMA), None, (), {}, base)
    assert rows(t.read(), "k") == [("b",)]
    assert len(os.listdir(os.path.join(tmpdir_path, "c", "data"))) == 2      # loser's folder removed


def test_vacuum_keeps_what_recent_versions_use(spark, tmpdir_path):
    schema = "KEY string, CURRENCY string, TIME_PERIOD string, OBS_VALUE string"
    t = VersionedTable(spark, os.path.join(tmpdir_path, "v"), partition_expr="substring(TIME_PERIOD, 1, 4)")
    t.upsert(spark.createDataFrame([("K", "GBP", "2016-01-01", "1"), ("K", "GBP", "2017-01-01", "2")],
                                   schema), ["KEY", "TIME_PERIOD"])
    first_2016 = t.partitions()["2016"]
    for i in range(3):                        # three upserts touching 2017 only
        t.upsert(spark.createDataFrame([("K", "GBP", "2017-01-01", str(10 + i))], schema),
                 ["KEY", "TIME_PERIOD"])
    removed = t.vacuum(keep_versions=1)
    assert len(removed) == 2                  # the two intermediate 2017 rewrites
    assert t.partitions()["2016"] == first_2016    # still referenced, kept
    assert rows(t.read(), "TIME_PERIOD", "OBS_VALUE") == [("2016-01-01", "1"), ("2017-01-01", "12")]
    left = [n for n in os.listdir(os.path.join(tmpdir_path, "v", "_commits")) if not n.endswith(".crc")]
    assert left == [f"{4:020d}"]
    assert t.version() == 4


def test_partitioned_upsert_with_null_and_empty_partition_values(spark, tmpdir_path):
    schema = "KEY string, CURRENCY string, TIME_PERIOD string, OBS_VALUE string"
    t = VersionedTable(spark, os.path.join(tmpdir_path, "n"), partition_expr="substring(TIME_PERIOD, 1, 4)")
    t.upsert(spark.createDataFrame([("A", "GBP", None, "1"), ("B", "GBP", "", "2"),
                                    ("C", "GBP", "2018-01-01", "3")], schema), ["KEY"])
    t.upsert(spark.createDataFrame([("B", "GBP", "", "9")], schema), ["KEY"])
    assert rows(t.read(), "KEY", "OBS_VALUE") == [("A", "1"), ("B", "9"), ("C", "3")]

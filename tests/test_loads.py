import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from sluice.operators import runlog
from sluice.operators.quality import DataCheckError
from sluice.operators.tables import VersionedTable
from sluice.plans import rate_load
from sluice.plans.bulk_load import BulkLoadFailed, bulk_load
from sluice.sources.manifest import MissingSourceFiles
from sluice.streaming.rate_stream import run_rate_stream

from conftest import rows


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def test_bulk_load(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    good = write(f"{src}/orders.csv", 'id,note\n1,"multi\nline"\n2,x\n')
    ragged = write(f"{src}/items.csv", "id,v\n1,2\n3\n")
    empty = write(f"{src}/reviews.csv", "id,v\n")
    roots = [f"{tmpdir_path}/{n}" for n in ("landing", "wh", "log")]
    with pytest.raises(MissingSourceFiles):
        bulk_load(spark, {"orders": good, "x": f"{src}/missing.csv"}, *roots, "shop")
    assert not os.path.exists(roots[2])                      # nothing loaded, nothing logged
    with pytest.raises(BulkLoadFailed) as err:
        bulk_load(spark, {"orders": good, "items": ragged, "reviews": empty}, *roots, "shop",
                  load_date=dt.date(2024, 1, 1), run_id="run1")
    report = err.value.report
    assert report.failures == ["items", "reviews"]
    assert "items.csv line 3: '3'" in report.results["items"].error
    assert (report.results["orders"].source_rows, report.results["orders"].loaded_rows) == (2, 2)
    t = VersionedTable(spark, f"{roots[1]}/shop_orders").read()
    assert rows(t, "id", "note") == [("1", "multi\nline"), ("2", "x")]
    assert t.first()["_source_uri"].endswith("shop/orders/load_date=2024-01-01")
    log = runlog.read_log(spark, roots[2])
    assert rows(log.groupBy("status").count()) == [("failed", 2), ("started", 3), ("success", 1)]
    groups = {r["table_name"]: r["job_group"] for r in log.filter("status = 'success'").collect()}
    assert groups == {"orders": "sluice:run1:orders"}
    assert log.filter("spark_app_id IS NULL").count() == 0
    assert not VersionedTable(spark, f"{roots[1]}/shop_items").exists()
    # a field with a line break under quoted_newlines=False fails, it does not change
    split_roots = [f"{tmpdir_path}/split-{n}" for n in ("landing", "wh", "log")]
    with pytest.raises(BulkLoadFailed):
        bulk_load(spark, {"orders": good}, *split_roots, "shop", quoted_newlines={"orders": False})


def test_bulk_load_same_day_again_nested_and_by_name(spark, tmpdir_path):
    src = f"{tmpdir_path}/src/orders"
    roots = [f"{tmpdir_path}/{n}" for n in ("landing", "wh", "log")]
    day = dt.date(2024, 1, 1)

    def load(**kw):
        bulk_load(spark, {"orders": src}, *roots, "shop", load_date=day, **kw)
        return rows(VersionedTable(spark, f"{roots[1]}/shop_orders").read(), "id", "v")

    write(f"{src}/a.csv", "id,v\n1,x\n")
    write(f"{src}/sub dir/b.csv", "v,id\ny,2\n")            # nested, other column order
    write(f"{src}/_SUCCESS", "")
    assert load() == [("1", "x"), ("2", "y")]
    assert load(quoted_newlines={"orders": False}) == [("1", "x"), ("2", "y")]
    os.rename(f"{src}/a.csv", f"{src}/c.csv")                # the same export under another part name
    assert load() == [("1", "x"), ("2", "y")]
    write(f"{src}/_r.csv", "id,v\n3,z\n")                   # readers would skip it: refused
    with pytest.raises(BulkLoadFailed) as err:
        load()
    assert "_r.csv" in err.value.report.results["orders"].error
    os.rename(f"{src}/_r.csv", f"{src}/r.csv")
    write(f"{src}/r.csv", "id,w\n3,z\n")
    with pytest.raises(BulkLoadFailed, match="orders") as err:
        load()
    assert "other columns" in err.value.report.results["orders"].error


@pytest.mark.parametrize("text", ['id,v\n1,"a\rb"\n2,c\n', '\nid,v\n1,b\n2,c\n', 'id,v\r\n1,b\r\n2,c\r\n'])
def test_one_parse_whatever_the_size(spark, tmpdir_path, text):
    src = write(f"{tmpdir_path}/src/t.csv", text)
    bulk_load(spark, {"t": src}, *[f"{tmpdir_path}/{n}" for n in ("l", "w", "g")], "s")
    got = rows(VersionedTable(spark, f"{tmpdir_path}/w/s_t").read(), "id", "v")
    assert got == [("1", "a\rb" if "a" in text else "b"), ("2", "c")]


def test_rate_landings_by_name(spark, tmpdir_path):
    base = f"{tmpdir_path}/landing/ecb/rates"
    write(f"{base}/load_date=2024-01-05/a.csv", "KEY,TIME_PERIOD,OBS_VALUE\nk,2024-01-02,0.86\n")
    write(f"{base}/load_date=2024-01-09/b.csv", "OBS_VALUE,KEY,TIME_PERIOD\n0.88,k,2024-01-03\n")
    got = rows(rate_load.validate_rate_source(spark, base), "KEY", "TIME_PERIOD", "OBS_VALUE")
    assert got == [("k", "2024-01-02", "0.86"), ("k", "2024-01-03", "0.88")]


RATES = "KEY string, CURRENCY string, TIME_PERIOD string, OBS_VALUE string, OBS_STATUS string"


def rate_rows(spark, data):
    return spark.createDataFrame([(f"D.{c}.EUR.SP00.A", c, d, v, "A") for c, d, v in data], RATES)


def test_incremental_load(spark, tmpdir_path):
    table, log = f"{tmpdir_path}/rates", f"{tmpdir_path}/log"
    src = rate_rows(spark, [("GBP", "2016-01-04", "0.73"), ("BRL", "2016-01-04", "4.31"),
                            ("GBP", "2016-03-01", "0.78"), ("USD", "2016-03-01", "1.09")])
    with pytest.raises(DataCheckError, match="first load"):
        rate_load.incremental_load(spark, src, table, log, ["GBP"], dt.date(2015, 12, 31), "u0")
    with pytest.raises(DataCheckError, match="unknown currency code"):
        rate_load.incremental_load(spark, src, table, log, ["GBP", "XYZ"], dt.date(2016, 3, 1), "u0")
    r1 = rate_load.incremental_load(spark, src, table, log, ["GBP", "BRL"], dt.date(2016, 1, 31), "u1")
    assert r1["rows"] == 2 and r1["start"] == dt.date(2016, 1, 1)
    # next run starts 7 days before the latest loaded day; a revised value is merged
    src2 = src.union(rate_rows(spark, [("GBP", "2016-01-04", "0.74")])).filter(
        ~((F.col("CURRENCY") == "GBP") & (F.col("TIME_PERIOD") == "2016-01-04") & (F.col("OBS_VALUE") == "0.73")))
    r2 = rate_load.incremental_load(spark, src2, table, log, ["GBP", "BRL"], dt.date(2016, 3, 31), "u2")
    assert r2["start"] == dt.date(2015, 12, 28) and r2["rows"] == 3
    got = rows(VersionedTable(spark, table, rate_load.RATE_PARTITION).read(),
               "CURRENCY", "TIME_PERIOD", "OBS_VALUE")
    assert got == [("BRL", "2016-01-04", "4.31"), ("GBP", "2016-01-04", "0.74"), ("GBP", "2016-03-01", "0.78")]
    # BRL absent from the new window but known: fine; nothing new -> success with 0 rows
    r3 = rate_load.incremental_load(spark, src2, table, log, ["BRL"], dt.date(2016, 3, 31), "u3")
    assert r3["rows"] == 0 and r3["absent"] == ["BRL"]
    statuses = rows(runlog.read_log(spark, log).groupBy("status").count())
    assert statuses == [("failed", 2), ("started", 5), ("success", 3)]


def test_stream_equals_batch_upsert(spark, tmpdir_path):
    landing = f"{tmpdir_path}/landing/ecb/rates"
    write(f"{landing}/load_date=2024-01-01/a.csv",
          "KEY,CURRENCY,TIME_PERIOD,OBS_VALUE,OBS_STATUS\nD.GBP.EUR.SP00.A,GBP,2024-01-01,0.86,A\n"
          "D.BRL.EUR.SP00.A,BRL,2024-01-01,5.40,A\n")
    write(f"{landing}/load_date=2024-01-02/b.csv",
          "KEY,CURRENCY,TIME_PERIOD,OBS_VALUE,OBS_STATUS\nD.GBP.EUR.SP00.A,GBP,2024-01-01,0.87,A\n"
          "D.GBP.EUR.SP00.A,GBP,2024-01-02,0.88,A\n")
    # files are consumed oldest first: the second landing day is the newer file
    os.utime(f"{landing}/load_date=2024-01-01/a.csv", (1_700_000_000, 1_700_000_000))
    os.utime(f"{landing}/load_date=2024-01-02/b.csv", (1_700_086_400, 1_700_086_400))
    cols = ["KEY", "CURRENCY", "TIME_PERIOD", "OBS_VALUE", "OBS_STATUS"]
    t = run_rate_stream(spark, landing, cols, f"{tmpdir_path}/t", f"{tmpdir_path}/ckpt",
                        max_files_per_trigger=1)
    got = rows(t.read(), "CURRENCY", "TIME_PERIOD", "OBS_VALUE")
    assert got == [("BRL", "2024-01-01", "5.40"), ("GBP", "2024-01-01", "0.87"), ("GBP", "2024-01-02", "0.88")]
    assert t.version() == 2                                   # one commit per micro-batch
    # a restart with nothing new lands no new version (the checkpoint holds the position)
    t2 = run_rate_stream(spark, landing, cols, f"{tmpdir_path}/t", f"{tmpdir_path}/ckpt")
    assert t2.version() == 2


def test_validate_rate_source(spark, tmpdir_path):
    head = "KEY,CURRENCY,TIME_PERIOD,OBS_VALUE\n"
    ok = write(f"{tmpdir_path}/ok.csv", head + "D.GBP,GBP,2024-01-02,0.86\nD.BRL,BRL,2024-01-02,5.4\n")
    assert rate_load.validate_rate_source(spark, ok).count() == 2
    ragged = write(f"{tmpdir_path}/r.csv", head + "D.GBP,GBP,2024-01-02,0.86\nD.BRL,BRL,2024-01-02\n")
    with pytest.raises(DataCheckError, match="line 3"):
        rate_load.validate_rate_source(spark, ragged)
    dup = write(f"{tmpdir_path}/d.csv", head + "D.GBP,GBP,2024-01-02,0.86\nD.GBP,GBP,2024-01-02,0.87\n")
    with pytest.raises(DataCheckError, match="duplicate"):
        rate_load.validate_rate_source(spark, dup)
    header_only = write(f"{tmpdir_path}/h.csv", head)
    with pytest.raises(DataCheckError, match="no data rows"):
        rate_load.validate_rate_source(spark, header_only)
    nokey = write(f"{tmpdir_path}/k.csv", "CURRENCY,OBS_VALUE\nGBP,1\n")
    with pytest.raises(DataCheckError, match="KEY, TIME_PERIOD"):
        rate_load.validate_rate_source(spark, nokey)


def test_overlapping_landings_latest_wins(spark, tmpdir_path):
    head = "KEY,CURRENCY,TIME_PERIOD,OBS_VALUE\n"
    base = f"{tmpdir_path}/landing/ecb/rates"
    write(f"{base}/load_date=2024-01-05/a.csv", head + "D.GBP,GBP,2024-01-02,0.86\nD.GBP,GBP,2024-01-03,0.87\n")
    write(f"{base}/load_date=2024-01-09/b.csv", head + "D.GBP,GBP,2024-01-03,0.88\nD.GBP,GBP,2024-01-08,0.89\n")
    validated = rate_load.validate_rate_source(spark, base)
    got = rows(validated, "TIME_PERIOD", "OBS_VALUE")
    assert got == [("2024-01-02", "0.86"), ("2024-01-03", "0.88"), ("2024-01-08", "0.89")]
    files = {r["TIME_PERIOD"]: r["_file"].rsplit("/", 2)[-2] for r in validated.collect()}
    assert files["2024-01-03"] == "load_date=2024-01-09"
    # the stream, all files in one micro-batch, gives the same table
    cols = ["KEY", "CURRENCY", "TIME_PERIOD", "OBS_VALUE"]
    t = run_rate_stream(spark, base, cols, f"{tmpdir_path}/t", f"{tmpdir_path}/ck")
    assert rows(t.read(), "TIME_PERIOD", "OBS_VALUE") == got
    write(f"{base}/load_date=2024-01-10/c.csv", head + "D.GBP,GBP,2024-01-09,1\nD.GBP,GBP,2024-01-09,2\n")
    with pytest.raises(DataCheckError, match="duplicate"):
        rate_load.validate_rate_source(spark, base)


def test_interrupted_load_is_logged_as_failed(spark, tmpdir_path, monkeypatch):
    from sluice.plans import bulk_load as bl

    src = write(f"{tmpdir_path}/src/orders.csv", "id\n1\n")

    def interrupt(*a, **k):
        raise KeyboardInterrupt

    monkeypatch.setattr(bl, "load_table", interrupt)
    with pytest.raises(KeyboardInterrupt):
        bl.bulk_load(spark, {"orders": src}, f"{tmpdir_path}/l", f"{tmpdir_path}/w", f"{tmpdir_path}/log",
                     "shop", parallel_tables=1)
    log = runlog.read_log(spark, f"{tmpdir_path}/log")
    assert rows(log, "status") == [("failed",), ("started",)]
    assert runlog.dead_runs(log).count() == 0


def test_stream_ledger_skips_a_replayed_batch_and_logs_each_batch(spark, tmpdir_path):
    from sluice.streaming.rate_stream import batch_loader

    head = "KEY,CURRENCY,TIME_PERIOD,OBS_VALUE\n"
    base, log = f"{tmpdir_path}/landing/ecb/rates", f"{tmpdir_path}/log"
    cols = ["KEY", "CURRENCY", "TIME_PERIOD", "OBS_VALUE"]
    args = (spark, base, cols, f"{tmpdir_path}/t", f"{tmpdir_path}/ck")
    write(f"{base}/load_date=2024-01-01/a.csv", head)
    with pytest.raises(Exception, match="hold no rates"):         # nothing but a header, and no table yet
        run_rate_stream(*args, log_path=log)
    write(f"{base}/load_date=2024-01-02/b.csv", head + "k,GBP,2024-01-01,0.86\nk,GBP,2024-01-02,0.87\n")
    t = run_rate_stream(spark, base, cols, f"{tmpdir_path}/t", f"{tmpdir_path}/ck2", log_path=log)
    assert t.version() == 1
    stream = next(iter(t._manifest()["applied"]))
    load = batch_loader(t, stream, log_path=log)
    again = spark.createDataFrame([("k", "GBP", "2024-01-01", "9", "x")], "KEY string, CURRENCY string, TIME_PERIOD string, "
                                  "OBS_VALUE string, _source_uri string")
    load(again, t.applied_batch(stream))                           # a replay: nothing changes, nothing is logged
    assert t.version() == 1 and rows(t.read(), "OBS_VALUE") == [("0.86",), ("0.87",)]
    write(f"{base}/load_date=2024-01-03/c.csv", head + "k,GBP,2024-01-02,0.88\nk,GBP\n")
    with pytest.raises(Exception, match="line 3"):
        run_rate_stream(spark, base, cols, f"{tmpdir_path}/t", f"{tmpdir_path}/ck2", log_path=log)
    got = runlog.read_log(spark, log)
    assert rows(got.groupBy("status").count()) == [("failed", 2), ("started", 3), ("success", 1)]
    assert rows(got.filter("status = 'success'"), "source_row_count", "loaded_row_count") == [(2, 2)]
    # a batch load on the same table keeps the ledger
    t.upsert(t.read().filter("TIME_PERIOD = '2024-01-01'"), ["KEY", "TIME_PERIOD"])
    assert t.version() == 2 and t.holds_batch(stream, 0)


def test_bad_rate_source_is_logged_and_early_landings_stay_closed(spark, tmpdir_path):
    head = "KEY,CURRENCY,TIME_PERIOD,OBS_VALUE\n"
    base, log, table = f"{tmpdir_path}/landing", f"{tmpdir_path}/log", f"{tmpdir_path}/t"
    write(f"{base}/load_date=2024-01-05/a.csv", head + "k,GBP,2024-01-02,0.86\nk,GBP,2024-01-04,0.87\n")

    def load(today):
        return rate_load.incremental_load(spark, lambda since: rate_load.validate_rate_source(spark, base, since=since),
                                          table, log, ["GBP"], today, base, default_start="2024-01-01")

    assert load(dt.date(2024, 1, 5))["rows"] == 2
    write(f"{base}/load_date=2023-01-05/old.csv", "not,a,rate\n1\n")            # an early folder, never opened again
    write(f"{base}/load_date=2024-01-20/b.csv", head + "k,GBP,2024-01-19,0.88\n")
    assert load(dt.date(2024, 1, 20))["rows"] == 3
    assert [p.rsplit("=")[-1] for p in rate_load.landings_since(spark, base, dt.date(2024, 1, 12))] == ["2024-01-20"]
    write(f"{base}/load_date=2024-01-21/c.csv", head + "k,GBP,2024-01-20\n")
    with pytest.raises(DataCheckError, match="c.csv line 2"):
        load(dt.date(2024, 1, 21))
    got = runlog.read_log(spark, log)
    assert rows(got.groupBy("status").count()) == [("failed", 1), ("started", 3), ("success", 2)]
    assert runlog.dead_runs(got).count() == 0

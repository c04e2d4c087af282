import os

import pytest
from pyspark.sql import functions as F

from sluice.sources.csv_files import count_records, ragged_rows, read_header, read_raw_csv, total_records
from sluice.sources.landing import land_file, land_files, read_landed
from sluice.sources.manifest import MissingSourceFiles, check_manifest

TRICKY = ('\ufeffid,zip,comment,note\r\n'
          '1,01234,"line one\nline two ""quoted""",\r\n'
          '\r\n'
          '2,00042,"",x\r\n'
          '3,,plain,"a,b"\r\n')


def write(path, text):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def test_raw_scan_keeps_strings_quotes_and_empties(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "t.csv"), TRICKY)
    assert read_header(spark, p) == ["id", "zip", "comment", "note"]
    df = read_raw_csv(spark, p)
    got = {r["id"]: r.asDict() for r in df.collect()}
    assert set(got) == {"1", "2", "3"}                       # blank line skipped
    assert got["1"]["zip"] == "01234"                         # leading zero kept
    assert got["1"]["comment"] == 'line one\nline two "quoted"'
    assert got["1"]["note"] is None                          # nothing -> NULL
    assert got["2"]["comment"] == ""                          # "" -> empty string
    assert got["3"]["zip"] is None and got["3"]["note"] == "a,b"
    assert total_records(spark, p) == 3


def test_record_count_across_splits(spark, tmpdir_path):
    # many quoted newlines and blank lines; small splits force several blocks per file
    lines = ["id,text"]
    for i in range(3000):
        lines.append(f'{i},"multi\nline ""{i}""\n\nend"' if i % 7 == 0 else f"{i},plain {i}")
        if i % 11 == 0:
            lines.append("")
    p = write(os.path.join(tmpdir_path, "big.csv"), "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        per_block = count_records(spark, p)
        assert total_records(spark, p) == 3000
        assert read_raw_csv(spark, p).count() == 3000
        n_blocks = spark.read.text(p).select(F.col("_metadata.file_block_start")).distinct().count()
        assert n_blocks > 5
        assert per_block.count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_ragged_rows_fail_and_are_listed(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "r.csv"), "a,b,c\n1,2,3\n4,5\n6,7,8,9\n")
    with pytest.raises(Exception):
        read_raw_csv(spark, p).collect()
    bad = sorted((r["line"], r["record"]) for r in ragged_rows(spark, p).collect())
    assert bad == [(3, "4,5"), (4, "6,7,8,9")]
    p = write(os.path.join(tmpdir_path, "m.csv"), 'a,b,c\n1,2,3\n"x\ny",5\n6,7,8,9\n\n1,2,3\n')
    assert sorted((r["line"], r["record"]) for r in ragged_rows(spark, p).collect()) == [(3, '"x\ny",5'), (5, "6,7,8,9")]
    long = write(os.path.join(tmpdir_path, "s.csv"), "a,b\n" + "".join(f"{i},x\n" if i % 50 else f"{i}\n" for i in range(1, 400)))
    _tiny_splits(spark)
    try:
        got = sorted((r["line"], r["record"]) for r in ragged_rows(spark, long).collect())
    finally:
        _reset(spark)
    assert got == [(i + 1, str(i)) for i in range(50, 400, 50)]


def test_header_only_and_empty_file(spark, tmpdir_path):
    h = write(os.path.join(tmpdir_path, "h.csv"), "a,b\n")
    assert total_records(spark, h) == 0
    assert read_raw_csv(spark, h).count() == 0
    e = write(os.path.join(tmpdir_path, "e.csv"), "")
    with pytest.raises(Exception, match="no header"):
        read_raw_csv(spark, e)


def test_required_columns(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "k.csv"), "KEY,VALUE\nA,1\n")
    with pytest.raises(Exception, match="TIME_PERIOD"):
        read_raw_csv(spark, p, required=["KEY", "TIME_PERIOD"])


def test_landing_and_manifest(spark, tmpdir_path):
    src = write(os.path.join(tmpdir_path, "orders.csv"), "id,v\n1,a\n2,b\n")
    root = os.path.join(tmpdir_path, "landing")
    uri = land_file(spark, src, root, "shop", "orders", "2024-01-01")
    land_file(spark, src, root, "shop", "orders", "2024-01-02")
    land_file(spark, src, root, "shop", "orders", "2024-01-02")   # same-day re-run overwrites
    assert uri.endswith("shop/orders/load_date=2024-01-01/orders.csv")
    with open(uri.replace("file:", ""), encoding="utf-8") as f:
        assert f.read() == "id,v\n1,a\n2,b\n"                 # bytes untouched
    one_day = read_landed(spark, root, "shop", "orders", load_dates=["2024-01-02"])
    assert one_day.count() == 2
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan
    with pytest.raises(MissingSourceFiles, match="nope.csv"):
        check_manifest(spark, {"orders": src, "x": os.path.join(tmpdir_path, "nope.csv")})


def test_distributed_landing(spark, tmpdir_path):
    srcs = [write(os.path.join(tmpdir_path, f"part-{i}.csv"), f"id\n{i}\n") for i in range(5)]
    root = os.path.join(tmpdir_path, "landing")
    uris = land_files(spark, srcs, root, "shop", "items", "2024-02-01")
    assert len(uris) == 5 and all("load_date=2024-02-01" in u for u in uris)
    assert sorted(r["id"] for r in read_landed(spark, root, "shop", "items").collect()) == list("01234")
    assert land_files(spark, srcs[:1], root, "shop", "items", "2024-02-01") == uris[:1]  # re-run overwrites


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


def _csv_field(value):
    if value is None:
        return ""
    if value == "" or any(ch in value for ch in ',"\n'):
        return '"' + value.replace('"', '""') + '"'
    return value


def _tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


def _reset(spark):
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.just(""), st.lists(
           st.one_of(st.none(), st.text(alphabet='xy,"\n', max_size=12)), min_size=1, max_size=3)),
       min_size=0, max_size=60))
def test_record_count_property(spark, tmp_path_factory, rows_):
    """The split-parallel count equals Python's csv reader (blank rows skipped)."""
    import csv
    import io

    d = tmp_path_factory.mktemp("cnt")
    body = "".join("\n" if r == "" else ",".join(_csv_field(v) for v in r) + "\n" for r in rows_)
    text = "\ufeffh1,h2,h3\n" + body
    p = write(str(d / "c.csv"), text)
    expect = sum(1 for r in csv.reader(io.StringIO(text[1:], newline="")) if r) - 1
    _tiny_splits(spark)
    try:
        assert total_records(spark, p) == expect
    finally:
        _reset(spark)


def test_land_frame_replaces_only_the_days_it_writes(spark, tmpdir_path):
    from sluice.sources.landing import land_frame

    root = os.path.join(tmpdir_path, "landing")
    df = spark.createDataFrame([("1", "2024-01-01"), ("2", "2024-01-02")], "id string, load_date string")
    land_frame(df, root, "shop", "orders", partition_col="load_date")
    land_frame(spark.createDataFrame([("3", "2024-01-02")], "id string, load_date string"),
               root, "shop", "orders", partition_col="load_date")
    got = sorted((r["id"], r["load_date"]) for r in read_landed(spark, root, "shop", "orders").collect())
    assert got == [("1", "2024-01-01"), ("3", "2024-01-02")]


def test_other_quote_character(spark, tmpdir_path):
    text = "id,note\n1,'it''s\nmulti'\n2,'a \"b\" c'\n"
    p = write(os.path.join(tmpdir_path, "q.csv"), text)
    assert total_records(spark, p, quote="'") == 2


def test_gzip_source(spark, tmpdir_path):
    import gzip

    p = os.path.join(tmpdir_path, "t.csv.gz")
    with gzip.open(p, "wt", encoding="utf-8", newline="") as f:
        f.write(TRICKY)
    assert total_records(spark, p) == 3
    assert read_raw_csv(spark, p).count() == 3

import datetime as dt

from pyspark.sql import functions as F

from sluice.operators import quality, runlog

from conftest import rows


def test_generic_tests_clean_and_faulty(spark):
    clean = spark.createDataFrame([(1, "a", 5), (2, "b", 0), (3, None, 24)], "id int, s string, n int")
    faulty = spark.createDataFrame([(1, "a", 5), (1, "z", 25), (None, None, -1), (None, "a", 3)],
                                   "id int, s string, n int")
    assert quality.test_unique(clean, "id").count() == 0
    assert rows(quality.test_unique(faulty, "id")) == [(1, 2)]          # NULLs ignored
    assert quality.test_unique_combination(clean, ["id", "s"]).count() == 0
    dup = faulty.union(faulty.limit(1))
    assert rows(quality.test_unique_combination(dup, ["id", "s"])) == [(1, "a", 2)]
    assert rows(quality.test_not_null(clean, ["id", "s"])) == [("s", 1)]
    assert rows(quality.null_counts(faulty, ["id", "s", "n"])) == [("id", 2), ("n", 0), ("s", 1)]
    assert quality.test_accepted_values(clean, "s", ["a", "b"]).count() == 0   # NULL passes
    assert rows(quality.test_accepted_values(faulty, "s", ["a"])) == [("z", 1)]
    assert quality.test_accepted_range(clean, "n", 0, 24).count() == 0
    assert rows(quality.test_accepted_range(faulty, "n", 0, 24), "n") == [(-1,), (25,)]
    parent = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert quality.test_relationships(clean, "id", parent, "id").count() == 0
    orphans = spark.createDataFrame([(7,), (7,), (1,), (None,)], "id int")
    assert rows(quality.test_relationships(orphans, "id", parent, "id")) == [(7, 2)]


def test_column_checks_one_pass(spark):
    df = spark.createDataFrame([(1, 5), (None, 25), (3, None), (4, -1)], "id int, n int")
    got = dict((r["test_name"], r["failures"]) for r in
               quality.column_checks(df, "m", ["id", "n"], {"n": (0, 24)}).collect())
    assert got == {"not_null_m_id": 1, "not_null_m_n": 1, "accepted_range_m_n": 2}


def test_assertions_and_grading(spark):
    a = spark.range(5)
    assert quality.row_count_parity(a, spark.range(5), "p").count() == 0
    assert rows(quality.row_count_parity(a, spark.range(4), "p"), "fct_rows", "stg_rows") == [(5, 4)]
    assert quality.liveness(spark.range(3).withColumn("x", F.lit(1)), F.col("x") > 1).count() == 1
    events = spark.createDataFrame([(dt.datetime(2018, 1, 2), dt.datetime(2018, 1, 1)),
                                    (dt.datetime(2018, 1, 2), None)], "bought timestamp, got timestamp")
    assert quality.events_out_of_order(events, "bought", "got").count() == 1
    sev = quality.Severity(">0", ">350")
    graded = quality.grade_tests({
        "few": (spark.range(303), sev, None), "many": (spark.range(351), sev, None),
        "none": (spark.range(0), sev, None), "default": (spark.range(1), quality.Severity(), None),
        "soft": (spark.range(9), quality.Severity(severity="warn"), None),
    })
    assert {r["test_name"]: r["status"] for r in graded.collect()} == {
        "few": "warn", "many": "error", "none": "pass", "default": "error", "soft": "warn"}


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 10),)], "ts timestamp_ntz")
    now = dt.datetime(2024, 1, 15)
    r = quality.freshness(df, F.col("ts"), now, 4, 6).first()
    assert r["age_seconds"] == 5 * 86400 and r["status"] == "warn"
    assert quality.freshness(df, F.col("ts"), dt.datetime(2024, 1, 12), 4, 6).first()["status"] == "pass"
    assert quality.freshness(df, F.col("ts"), dt.datetime(2024, 1, 17), 4, 6).first()["status"] == "error"
    assert quality.freshness(df.limit(0), F.col("ts"), now, 4, 6).first()["status"] == "error"


def test_run_log(spark, tmpdir_path):
    path = f"{tmpdir_path}/log"
    t0 = dt.datetime(2024, 1, 1, 8)
    ev = lambda run, table, status, minutes, err=None: runlog.log_event(
        spark, path, run, "src", table, status, t0, now=t0 + dt.timedelta(minutes=minutes), error=err)
    ev("r1", "only_started", "started", 0)
    ev("r1", "ok", "started", 0); ev("r1", "ok", "success", 1)
    ev("r1", "bad", "started", 0); ev("r1", "bad", "failed", 2, err="x" * 5000)
    ev("r1", "retried", "failed", 1); ev("r2", "retried", "started", 3); ev("r2", "retried", "success", 4)
    runlog.log_event(spark, path, "r3", "src", "old", "success", t0 - dt.timedelta(days=3),
                     now=t0 - dt.timedelta(days=3))
    log = runlog.read_log(spark, path)
    assert rows(runlog.dead_runs(log), "run_id", "table_name") == [("r1", "only_started")]
    assert rows(runlog.failed_tables(log), "table_name") == [("bad",)]
    assert rows(runlog.load_skew(log), "table_name", "days_behind") == [("old", 3)]
    errs = [r["error_message"] for r in log.filter("status = 'failed'").collect()]
    assert max(len(e) for e in errs if e) == 2000
    assert log.filter("status = 'started'").agg(F.count("duration_seconds")).first()[0] == 0
    assert runlog.read_log(spark, path, event_date="2023-12-29").count() == 1   # day partition


def test_concurrent_log_appends_lose_nothing(spark, tmpdir_path):
    from concurrent.futures import ThreadPoolExecutor

    path = f"{tmpdir_path}/log"
    t0 = dt.datetime(2024, 1, 1, 8)

    def write(i):
        runlog.log_event(spark, path, f"r{i}", "src", f"t{i}", "started", t0,
                         now=t0 + dt.timedelta(days=i % 3))

    with ThreadPoolExecutor(max_workers=6) as pool:
        list(pool.map(write, range(12)))
    log = runlog.read_log(spark, path)
    assert log.count() == 12 and log.select("run_id").distinct().count() == 12


def test_model_facts_equal_the_single_tests(spark):
    import random

    rnd = random.Random(4)
    parents = spark.createDataFrame([(str(i),) for i in [*range(20), 3, 3, 7]] + [(None,)] * 2, "k string")
    lines = spark.createDataFrame(
        [(rnd.choice([None, *map(str, range(25))]), rnd.choice([None, "1", "2"]), rnd.randint(-3, 30)) for _ in range(300)],
        "k string, l string, n int")
    models = [quality.Model("p", parents, "k", family="f", parent=True, counts={"nulls": F.col("k").isNull()}),
              quality.Model("c", lines, "k", "l", family="f", counts={"outside": ~F.col("n").between(0, 24)},
                            sums={"total": F.col("n").cast("decimal(18,2)")}),
              quality.Model("empty", lines.limit(0), "k", counts={"none": F.col("n") > 0}), quality.Model("rows", lines)]
    facts = quality.model_facts(models)
    got = {(r["model"], r["measure"]): int(r["value"]) for r in facts.collect()}
    assert got["p", "rows"] == 25 and got["p", "nulls"] == 2 and got["rows", "rows"] == 300
    assert got["p", "duplicates"] == quality.test_unique(parents, "k").count() == 2
    assert got["c", "duplicates"] == quality.test_unique_combination(lines, ["k", "l"]).count() > 10
    assert got["c", "orphans"] == quality.test_relationships(lines, "k", parents, "k").agg(F.sum("n_records")).first()[0] > 0
    assert got["c", "outside"] == quality.test_accepted_range(lines, "n", 0, 24).count()
    assert got["c", "total"] == lines.agg(F.sum("n")).first()[0]
    tests = quality.tests_from_facts(facts, {"a": lambda v: v("c", "orphans"), "b": lambda v: v("empty", "none") + v("empty", "rows"),
                                             "c": lambda v: (v("p", "rows") != v("rows", "rows")).cast("int")})
    graded = {r["test_name"]: (r["failures"], r["status"]) for r in quality.grade_counts(
        tests, {"a": quality.Severity(">0", ">100000")}).collect()}
    assert graded == {"a": (got["c", "orphans"], "warn"), "b": (0, "pass"), "c": (1, "error")}

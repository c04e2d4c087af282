"""Bulk load job: every table of a manifest, one after another.

Per table (tables run as concurrent Spark jobs): log 'started' -> land the source files byte for byte under
``landing/<source>/<table>/load_date=<D>/`` (replacing an earlier landing of the
day) -> count the records of the source itself, independently of the parse ->
read the landed files all-string, columns by header name, with audit columns -> write a
new version, counting rows as they are written, check that count against the source's,
commit -> log 'success' (or 'failed' with the error and the landing folder).  A failed table does not stop
the others; the job raises at the end if any failed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from ..operators import runlog
from ..operators.quality import require_rows
from ..operators.tables import VersionedTable, with_audit
from ..sources.csv_files import name_ragged, read_by_header, total_records
from ..sources.landing import land_files, landing_dir
from ..sources.manifest import check_manifest, source_files


@dataclass
class LoadResult:
    table: str
    status: str
    source_rows: int | None = None
    loaded_rows: int | None = None
    uri: str | None = None
    error: str | None = None


@dataclass
class BulkLoadReport:
    run_id: str
    results: dict[str, LoadResult] = field(default_factory=dict)

    @property
    def failures(self) -> list[str]:
        return [t for t, r in self.results.items() if r.status != "success"]

    def summary(self) -> str:
        ok = len(self.results) - len(self.failures)
        return f"{ok} succeeded, {len(self.failures)} failed"


class BulkLoadFailed(RuntimeError):
    def __init__(self, report: BulkLoadReport):
        super().__init__(f"{report.summary()}: {', '.join(report.failures)}")
        self.report = report


def load_table(spark: SparkSession, table: str, src: str, landing_root: str,
               warehouse_root: str, source: str, load_date: dt.date,
               quoted_newlines: bool = True) -> LoadResult:
    """``quoted_newlines``: fields may hold line breaks (a file is then one task);
    False lets Spark split files by block.  The same values either way."""
    day_dir = landing_dir(landing_root, source, table, load_date)
    land_files(spark, source_files(spark, src), landing_root, source, table, load_date, base=src)
    src_rows = total_records(spark, src)
    require_rows(src_rows, table)
    df = with_audit(read_by_header(spark, day_dir, table, quoted_newlines=quoted_newlines), day_dir)
    target = VersionedTable(spark, f"{warehouse_root}/{source}_{table}")
    try:
        loaded = target.replace(df, expected_rows=src_rows)
    except Exception:
        name_ragged(spark, day_dir, table)       # a better error, if ragged records are the reason
        raise
    return LoadResult(table, "success", src_rows, loaded, day_dir)


def _load_logged(spark: SparkSession, table: str, src: str, landing_root: str,
                 warehouse_root: str, log_path: str, source: str, load_date: dt.date,
                 run_id: str, quoted_newlines: Mapping[str, bool]) -> LoadResult:
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    uri = landing_dir(landing_root, source, table, load_date)
    sc = spark.sparkContext
    sc.setJobGroup(f"sluice:{run_id}:{table}", f"load {source}.{table}")   # thread-local

    def log(status: str, **facts) -> None:
        runlog.log_event(spark, log_path, run_id, source, table, status, started, **facts)

    log("started")
    try:
        res = load_table(spark, table, src, landing_root, warehouse_root, source, load_date,
                         quoted_newlines.get(table, True))
        log("success", uri=res.uri, source_rows=res.source_rows, loaded_rows=res.loaded_rows)
    except Exception as exc:  # noqa: BLE001 - one table's failure must not stop the rest
        res = LoadResult(table, "failed", uri=uri, error=f"{type(exc).__name__}: {exc}")
        log("failed", uri=uri, error=res.error)
    except BaseException as exc:
        # an interrupted load is logged as failed instead of leaving a dead run
        log("failed", uri=uri, error=f"{type(exc).__name__}: load interrupted")
        raise
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return res


def bulk_load(spark: SparkSession, manifest: dict[str, str], landing_root: str,
              warehouse_root: str, log_path: str, source: str,
              load_date: dt.date | None = None, run_id: str | None = None,
              raise_on_failure: bool = True,
              quoted_newlines: Mapping[str, bool] | None = None,
              parallel_tables: int = 4) -> BulkLoadReport:
    """Load every table of the manifest.  Tables load as concurrent Spark jobs
    (``parallel_tables`` at a time; 1 loads them one after another).
    ``quoted_newlines`` says per table whether fields may hold line breaks (default
    True); False for large files without them, which Spark then splits."""
    check_manifest(spark, manifest)
    load_date = load_date or dt.date.today()
    report = BulkLoadReport(run_id or uuid.uuid4().hex)
    args = (landing_root, warehouse_root, log_path, source, load_date, report.run_id,
            quoted_newlines or {})
    if parallel_tables <= 1:
        results = [_load_logged(spark, t, src, *args) for t, src in manifest.items()]
    else:
        with ThreadPoolExecutor(max_workers=parallel_tables) as pool:
            futures = [pool.submit(_load_logged, spark, t, src, *args) for t, src in manifest.items()]
            results = [f.result() for f in futures]
    for res in results:
        report.results[res.table] = res
    if raise_on_failure and report.failures:
        raise BulkLoadFailed(report)
    return report

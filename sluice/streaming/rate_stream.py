"""The incremental rate load as a file stream over the landing folder.

Every new landed CSV file is read once (the stream's checkpoint replaces the
high-water mark).  ``availableNow`` processes what has landed and stops, so the job
runs on a schedule like the batch load.  Each micro-batch is a load of its own:

    log 'started' -> parse the files once into a staged table, counting the rows by
    that write -> compare with the records of the files, counted from their text ->
    refuse a key repeated inside one file -> upsert, the batch's number in the commit
    -> log 'success' with both counts (or 'failed' with the error)

The commit manifest is the ledger: it holds the last batch of the stream, so a batch
that Spark replays after a failure between the commit and the checkpoint changes
nothing and logs nothing.  A batch without rows (files with a header only) is refused,
as by the batch load.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fs
from ..operators import runlog
from ..operators.keyed import latest_per_key
from ..operators.quality import DataCheckError, require_equal_counts, require_unique_keys
from ..operators.tables import VersionedTable, write_counted
from ..session import new_work_dir
from ..sources.csv_files import CSV_OPTIONS, name_ragged, string_schema, total_records
from ..sources.landing import landing_order

KEYS = ("KEY", "TIME_PERIOD")


def _load(batch: DataFrame, staged: str, keys: Sequence[str], what: str, number: tuple[str, int],
          target: VersionedTable, landing: str | None) -> tuple[int, int]:
    """(records in the files, rows upserted) of one micro-batch."""
    spark = batch.sparkSession
    try:
        parsed = write_counted(batch, staged)
    except Exception:
        if landing:
            name_ragged(spark, landing, what)
        raise
    if parsed == 0:
        raise DataCheckError(f"{what}: the landed files hold no rates")
    rows = spark.read.schema(batch.schema).parquet(staged)
    files = [unquote(r[0]) for r in rows.select("_source_uri").distinct().collect()]     # the files of one micro-batch
    in_files = total_records(spark, sorted(files))
    require_equal_counts(in_files, parsed, what)
    # a key twice in one file is an error; across files the latest landing wins
    require_unique_keys(rows, [*keys, "_source_uri"], what)
    latest = latest_per_key(rows, list(keys), landing_order("_source_uri"))
    # audit: one load time per batch, the landed file each row came from
    target.upsert(latest.withColumn("_loaded_at", F.current_timestamp()), list(keys), batch=number)
    return in_files, latest.count()


def batch_loader(target: VersionedTable, stream: str, keys: Sequence[str] = KEYS, log_path: str | None = None,
                 source: str = "ecb_fx", table_name: str = "rates", uri: str | None = None
                 ) -> Callable[[DataFrame, int], None]:
    """The function that loads a micro-batch; a batch that the table already holds is left alone."""

    def load(batch: DataFrame, batch_id: int) -> None:
        if target.holds_batch(stream, batch_id):
            return
        spark = batch.sparkSession
        started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

        def log(status: str, **facts) -> None:
            if log_path:
                runlog.log_event(spark, log_path, f"{stream}#{batch_id}", source, table_name, status, started, uri=uri, **facts)

        log("started")
        staged = new_work_dir(spark, "rate-batch")
        try:
            in_files, loaded = _load(batch, staged, keys, f"{target.root} batch {batch_id}", (stream, batch_id), target, uri)
            log("success", source_rows=in_files, loaded_rows=loaded)
        except BaseException as exc:
            log("failed", error=f"{type(exc).__name__}: {exc}")
            raise
        finally:
            fs.delete(spark, staged)

    return load


def start_rate_stream(spark: SparkSession, landing_table_dir: str, columns: Sequence[str],
                      table_root: str, checkpoint: str, keys: Sequence[str] = KEYS,
                      max_files_per_trigger: int | None = None,
                      partition_expr: str | None = "substring(TIME_PERIOD, 1, 4)", log_path: str | None = None):
    schema = string_schema(list(columns))
    reader = (spark.readStream.schema(schema)
              .options(**{k: v for k, v in CSV_OPTIONS.items() if k != "inferSchema"}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = (reader.option("recursiveFileLookup", "true").csv(landing_table_dir)
              .withColumn("_source_uri", F.col("_metadata.file_path")))
    # A stream is named by its checkpoint: with a new one all files are new batches again.
    load = batch_loader(VersionedTable(spark, table_root, partition_expr), fs.qualify(spark, checkpoint), keys, log_path,
                        uri=landing_table_dir)
    return (stream.writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def run_rate_stream(spark: SparkSession, landing_table_dir: str, columns: Sequence[str],
                    table_root: str, checkpoint: str, **kw) -> VersionedTable:
    q = start_rate_stream(spark, landing_table_dir, columns, table_root, checkpoint, **kw)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return VersionedTable(spark, table_root, kw.get("partition_expr", "substring(TIME_PERIOD, 1, 4)"))

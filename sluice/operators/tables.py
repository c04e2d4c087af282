"""Table operators: audit columns, atomic whole-table replace, keyed upsert and
the high-water mark of an incremental load.

Storage layout of a ``VersionedTable`` at ``root``::

    root/data/<version-id>/part-*.parquet     one folder per committed write
    root/_commits/<00000000000000000001>      text: the data folder of version 1

A partitioned table writes ``root/data/<version-id>/slc_part=<value>/`` folders
and its commit file is a JSON manifest {partition value: folder, schema}.

A write goes to a fresh data folder and is counted while it is written (one pass);
only then is the next commit file moved into place, unless it exists.  On file systems
whose rename refuses an existing target (HDFS, local) two writers cannot both commit a
version; a store without such a rename needs one writer at a time.  Readers take the
highest commit.  A failed write leaves the previous version in place and its staged
folder is removed.

A commit may name the stream batch it holds (``batch``); the manifest carries the last
batch of every stream on, so a replayed batch is recognised.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fs
from .quality import require_equal_counts, require_unique_keys

_COMMITS = "_commits"
_DATA = "data"


def with_audit(df: DataFrame, source_uri: str | Column,
               loaded_at: Column | None = None) -> DataFrame:
    """Append ``_loaded_at`` (one timestamp per statement) and ``_source_uri``."""
    uri = F.lit(source_uri) if isinstance(source_uri, str) else source_uri
    ts = loaded_at if loaded_at is not None else F.current_timestamp()
    return df.withColumn("_loaded_at", ts).withColumn("_source_uri", uri)


class VersionedTable:
    """Whole-table versions with atomic commits; optionally partitioned.

    With ``partition_expr`` (a SQL expression over the key columns, e.g.
    ``substring(TIME_PERIOD, 1, 4)``) each version is a set of partition
    folders listed in the commit manifest.  An upsert then reads and rewrites
    only the partitions its batch touches; the new manifest keeps pointing at
    the untouched folders of the previous version.
    """

    def __init__(self, spark: SparkSession, root: str, partition_expr: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_expr = partition_expr

    # ------------------------------------------------------------ reading
    def _commits(self) -> list[str]:
        return [n for n in fs.list_names(self.spark, f"{self.root}/{_COMMITS}") if n.isdigit()]

    def version(self) -> int:
        commits = self._commits()
        return int(commits[-1]) if commits else 0

    def exists(self) -> bool:
        return self.version() > 0

    def _manifest(self) -> dict | None:
        for commit in reversed(self._commits()):
            text = fs.read_text(self.spark, f"{self.root}/{_COMMITS}/{commit}").strip()
            if text:      # a commit without content never happened
                return json.loads(text) if text.startswith("{") else {"path": text}
        return None

    def current_path(self) -> str | None:
        m = self._manifest()
        return f"{self.root}/{_DATA}/{m['path']}" if m and "path" in m else None

    def partitions(self) -> dict[str, str]:
        """Partition value -> data folder of the current version."""
        m = self._manifest()
        return {k: f"{self.root}/{_DATA}/{v}" for k, v in (m or {}).get("parts", {}).items()}

    def read(self, partitions: Sequence | None = None) -> DataFrame:
        """Current version; for a partitioned table optionally only the listed
        partition values (the other folders are never opened)."""
        m = self._manifest()
        if m is None:
            raise FileNotFoundError(f"table at {self.root} has no committed version")
        if "path" in m:
            return self.spark.read.parquet(f"{self.root}/{_DATA}/{m['path']}")
        schema = T.StructType.fromJson(json.loads(m["schema"]))
        parts = m["parts"]
        wanted = parts if partitions is None else [_part_key(p) for p in partitions]
        paths = [f"{self.root}/{_DATA}/{parts[k]}" for k in wanted if k in parts]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def applied_batch(self, stream: str) -> int | None:
        """The last batch of ``stream`` that a commit holds."""
        return ((self._manifest() or {}).get("applied") or {}).get(stream)

    def holds_batch(self, stream: str, number: int) -> bool:
        last = self.applied_batch(stream)
        return last is not None and last >= number

    # ------------------------------------------------------------ writing
    def _write(self, df: DataFrame, name: str, staged: str, partition_by: Sequence[str] = ()) -> tuple[dict, int]:
        """(partition folders, rows), counted by the write itself."""
        if self.partition_expr:
            # rows of a partition value meet before the write: few files per value
            out = df.withColumn(_PART, F.expr(self.partition_expr).cast("string")).hint("rebalance", _PART)
            rows = write_counted(out, staged, [_PART])
            parts = {}
            for folder in fs.list_names(self.spark, staged):
                if folder.startswith(_PART + "="):
                    parts[unquote(folder[len(_PART) + 1:])] = f"{name}/{folder}"
            return parts, rows
        return {}, write_counted(df, staged, partition_by)

    def replace(self, df: DataFrame, expected_rows: int | None = None,
                partition_by: Sequence[str] = ()) -> int:
        """Write ``df`` as the new whole content; returns the rows written.

        With ``expected_rows`` the written count must match (and be non-zero),
        else nothing is committed.
        """
        return self._write_and_commit(df, expected_rows, partition_by, keep={},
                                      base=self.version())

    def _write_and_commit(self, df: DataFrame, expected_rows, partition_by, keep: dict,
                          base: int, batch: tuple[str, int] | None = None) -> int:
        name = uuid.uuid4().hex
        staged = f"{self.root}/{_DATA}/{name}"
        committed = False
        try:
            parts, written = self._write(df, name, staged, partition_by)
            if expected_rows is not None:
                require_equal_counts(expected_rows, written, self.root)
            applied = dict((self._manifest() or {}).get("applied") or {})
            if batch is not None:
                applied[batch[0]] = batch[1]
            facts = {"applied": applied} if applied else {}
            if self.partition_expr:
                body = json.dumps({"parts": {**keep, **parts}, "schema": df.schema.json(),
                                   "partition_expr": self.partition_expr, **facts}, sort_keys=True)
            else:
                body = json.dumps({"path": name, **facts}) if facts else name
            self._commit(body, base)
            committed = True
            return written
        finally:
            if not committed:
                fs.delete(self.spark, staged)  # staging area removed, also on error

    def _commit(self, body: str, base: int) -> None:
        """Commit as version ``base + 1`` (optimistic concurrency): the file is
        written whole under another name, then moved into place unless the version
        exists, so readers never see half a commit; if another writer committed
        after we read version ``base``, this commit fails instead of losing theirs."""
        final = f"{self.root}/{_COMMITS}/{base + 1:020d}"
        draft = f"{self.root}/{_COMMITS}/.draft-{uuid.uuid4().hex}"
        fs.write_text(self.spark, draft, body)
        try:
            taken = fs.exists(self.spark, final)
            if not taken:
                try:
                    fs.rename(self.spark, draft, final)
                except OSError:
                    taken = fs.exists(self.spark, final)
                    if not taken:
                        raise
            if taken:
                raise ConcurrentCommitError(
                    f"{self.root}: another writer has committed version {base + 1}")
        finally:
            fs.delete(self.spark, draft)

    def vacuum(self, keep_versions: int = 2, orphan_hours: float = 168) -> list[str]:
        """Delete data folders that only versions older than the last
        ``keep_versions`` refer to, and those commit files.  A folder that no commit
        names may belong to a running writer: it goes only once it is older than
        ``orphan_hours``.  Readers of a removed version fail, so keep enough
        versions for running jobs."""
        v = self.version()
        if v == 0:
            return []
        commits = f"{self.root}/{_COMMITS}"
        keep = range(max(1, v - keep_versions + 1), v + 1)
        referenced: set[str] = set()
        outdated: set[str] = set()
        for commit in self._commits():
            folders = _manifest_folders(fs.read_text(self.spark, f"{commits}/{commit}").strip())
            if int(commit) in keep:
                referenced |= folders
            else:
                outdated |= folders
        removed = []
        for name in fs.list_names(self.spark, f"{self.root}/{_DATA}"):
            old = name in outdated or fs.age_hours(self.spark, f"{self.root}/{_DATA}/{name}") > orphan_hours
            if name not in referenced and old:
                fs.delete(self.spark, f"{self.root}/{_DATA}/{name}")
                removed.append(name)
        for name in fs.list_names(self.spark, commits):
            num = name[1:-4] if name.startswith(".") and name.endswith(".crc") else name
            if num.isdigit() and int(num) < keep[0]:
                fs.delete(self.spark, f"{commits}/{name}")   # commit file (and its checksum)
        return removed

    def upsert(self, source: DataFrame, keys: Sequence[str], expected_rows: int | None = None,
               batch: tuple[str, int] | None = None) -> int:
        """Create on first write, keyed MERGE afterwards; returns rows written
        (for a partitioned table: rows of the rewritten partitions).  With
        ``expected_rows`` the batch must hold that many (pass a written batch: it is
        read more than once).  ``batch`` (stream, number) is recorded with the commit; a
        batch that a commit already holds is left alone.  Without ``partition_expr`` a
        merge rewrites the whole table; give one for anything large."""
        if batch is not None and self.holds_batch(*batch):
            return 0
        require_unique_keys(source, keys, self.root)
        if expected_rows is not None:
            require_equal_counts(expected_rows, source.count(), self.root)
        base = self.version()
        if base == 0:
            return self._write_and_commit(source, None, (), keep={}, base=0, batch=batch)
        if not self.partition_expr:
            merged = merge_by_keys(self.read(), source, keys)
            return self._write_and_commit(merged, None, (), keep={}, base=base, batch=batch)
        touched = [_part_key(r[0]) for r in  # distinct partition values: bounded, small
                   source.select(F.expr(self.partition_expr).cast("string")).distinct().collect()]
        current = self._manifest()["parts"]
        merged = merge_by_keys(self.read(partitions=touched), source, keys)
        keep = {k: v for k, v in current.items() if k not in set(touched)}
        return self._write_and_commit(merged, None, (), keep=keep, base=base, batch=batch)


def write_counted(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Write ``df`` as Parquet; the rows are counted in the same pass."""
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(path)
    return int(seen.get.get("rows") or 0)


def _manifest_folders(body: str) -> set[str]:
    """Top-level data folders a commit file refers to."""
    if body.startswith("{"):
        facts = json.loads(body)
        return {facts["path"]} if "path" in facts else {rel.split("/", 1)[0] for rel in facts["parts"].values()}
    return {body}


class ConcurrentCommitError(RuntimeError):
    """Another writer committed first; re-read and retry."""


_PART = "slc_part"
_NULL_PART = "__HIVE_DEFAULT_PARTITION__"


def _part_key(value) -> str:
    # Spark writes NULL and '' partition values to the same default folder
    return _NULL_PART if value is None or value == "" else str(value)


def merge_by_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keyed upsert of ``source`` into ``target``.

    Matched rows take every non-key column from the source; unmatched source
    rows are inserted; target rows without a match stay.  Keys match with
    ``=``, so a NULL key never matches (such source rows are inserted, such
    target rows kept).  A target column missing from the source keeps its old
    value on matched rows and is NULL on inserted ones; a source column the
    target lacks is an error.
    """
    extra = [c for c in source.columns if c not in target.columns]
    if extra:
        raise ValueError(f"source has columns the target lacks: {extra}")
    keys = list(keys)
    missing = [c for c in target.columns if c not in source.columns]
    kept = target.join(source.select(*keys), keys, "left_anti")
    if missing:
        old = target.select(*keys, *missing)
        updated = source.join(old, keys, "left")
    else:
        updated = source
    return kept.unionByName(updated.select(*target.columns))


def high_water_mark_frame(df: DataFrame, col: str, lookback_days: int = 7,
                          default_start: str = "2016-01-01",
                          empty_when: Column | None = None) -> DataFrame:
    """One row: latest (text), start_date = latest - lookback, or the default
    start when there is nothing to anchor on.  A malformed latest value fails.

    ``empty_when`` adds ``empty_start_date``: the same mark over the rows that
    satisfy it, computed in the same single aggregation.
    """
    from ..functions.casts import to_date

    def start_of(latest):
        return F.coalesce(F.date_sub(to_date(latest), lookback_days),
                          F.lit(default_start).cast("date"))

    aggs = [F.max(col).alias("latest")]
    if empty_when is not None:
        aggs.append(F.max(F.when(empty_when, F.col(col))).alias("_sub_latest"))
    out = df.agg(*aggs).withColumn("start_date", start_of(F.col("latest")))
    if empty_when is not None:
        out = out.withColumn("empty_start_date", start_of(F.col("_sub_latest"))).drop("_sub_latest")
    return out


def load_window(target: VersionedTable | None, col: str, today: dt.date,
                lookback_days: int = 7, default_start: str = "2016-01-01",
                force_default: bool = False) -> tuple[dt.date, dt.date]:
    """(start, end) of the next incremental read; only a scalar reaches the driver."""
    default = dt.date.fromisoformat(default_start)
    if force_default or target is None or not target.exists():
        return default, today
    latest = target.read().agg(F.max(col)).first()[0]
    if latest is None:
        return default, today
    return dt.date.fromisoformat(str(latest)) - dt.timedelta(days=lookback_days), today

"""Landing area: source files kept byte for byte under
``root/<source>/<table>/load_date=<D>/<file>``; a re-run of the same day replaces
the whole day folder.  Reads prune on ``load_date``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fs
from .csv_files import CSV_OPTIONS, read_header, read_raw_csv


def landing_dir(root: str, source: str, table: str, load_date: dt.date | str | None = None) -> str:
    base = f"{root.rstrip('/')}/{source}/{table}"
    return base if load_date is None else f"{base}/load_date={load_date}"


def land_file(spark: SparkSession, src: str, root: str, source: str, table: str,
              load_date: dt.date | str) -> str:
    """Copy one (small) file into the landing layout through the driver;
    returns its URI.  Loads land their files with ``land_files``, which copies
    on the executors."""
    name = src.rstrip("/").rsplit("/", 1)[-1]
    dst = f"{landing_dir(root, source, table, load_date)}/{name}"
    fs.copy(spark, src, dst, overwrite=True)
    return fs.qualify(spark, dst)


def _arrow_path(uri: str):
    """(pyarrow FileSystem, path) for a Hadoop-style URI or an absolute path."""
    import pyarrow.fs as pafs

    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    scheme, rest = uri.split("://", 1)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    if scheme not in ("s3", "gs", "hdfs", "viewfs"):
        raise ValueError(f"cannot land {scheme}:// files; known: file, s3, s3a, gs, hdfs, viewfs")
    host, _, path = rest.partition("/")
    where, root = pafs.FileSystem.from_uri(f"{scheme}://{host}/")
    return where, f"{root.rstrip('/')}/{path}"


def _copy_batch(batches):
    import shutil
    import uuid

    import pandas as pd

    for pdf in batches:
        sizes = []
        for src, dst in zip(pdf["src"], pdf["dst"]):
            sfs, spath = _arrow_path(src)
            dfs, dpath = _arrow_path(dst)
            dfs.create_dir(dpath.rsplit("/", 1)[0], recursive=True)
            # A failed or repeated task leaves a hidden file, never part of an object.
            folder, name = dpath.rsplit("/", 1)
            part = f"{folder}/.{uuid.uuid4().hex[:12]}.{name}"
            with sfs.open_input_stream(spath) as fin, dfs.open_output_stream(part) as fout:
                shutil.copyfileobj(fin, fout, 8 << 20)
            dfs.move(part, dpath)
            sizes.append(sfs.get_file_info(spath).size)
        yield pd.DataFrame({"dst": list(pdf["dst"]), "bytes": sizes})


def land_files(spark: SparkSession, files: list[str], root: str, source: str, table: str,
               load_date: dt.date | str, base: str | None = None) -> list[str]:
    """Copy many files into one landing day folder as a Spark job: one row per
    file, files spread over tasks, bytes streamed by the executors (never via
    the driver).  Below ``base`` (the source folder) nested paths are kept.  Files
    of an earlier landing of the day that are not among these are removed, so a
    day folder holds exactly the last landing.  Returns the URIs."""
    if not files:
        return []
    day = fs.qualify(spark, landing_dir(root, source, table, load_date))
    top = fs.qualify(spark, base).rstrip("/") + "/" if base else None
    pairs = []
    for f in files:
        uri = fs.qualify(spark, f)
        inside = top is not None and uri.startswith(top)
        pairs.append((uri, f"{day}/{uri.removeprefix(top) if inside else uri.rsplit('/', 1)[-1]}"))
    if len({dst for _, dst in pairs}) < len(pairs):
        raise ValueError(f"{source}.{table}: several source files land under one name")
    jobs = spark.createDataFrame(pairs, "src string, dst string").repartition(
        min(len(pairs), 4 * spark.sparkContext.defaultParallelism))
    done = sorted(r["dst"] for r in jobs.mapInPandas(_copy_batch, "dst string, bytes long").collect())  # one row per file
    kept = set(done)
    for old in fs.walk_files(spark, day):
        if old not in kept:
            fs.delete(spark, old)
    return done


def land_frame(df: DataFrame, root: str, source: str, table: str,
               load_date: dt.date | str | None = None, partition_col: str | None = None) -> str:
    """Write a DataFrame as CSV files into the landing layout (one day folder,
    or one per value of ``partition_col`` named ``load_date``)."""
    writer = df.write.mode("overwrite").options(
        header="true", quote='"', escape='"', nullValue="", emptyValue='""')
    if partition_col:
        target = landing_dir(root, source, table)
        # dynamic overwrite: re-landing some days replaces those days only
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).csv(target)
    else:
        target = landing_dir(root, source, table, load_date)
        writer.csv(target)
    return target


def landing_order(file_col: str = "_source_uri"):
    """Sort key of a landed file: its load_date folder, then its path, so a
    later landing of the same record wins."""
    path = F.col(file_col)
    return F.struct(F.regexp_extract(path, r"load_date=([^/]+)", 1).alias("load_date"),
                    path.alias("path"))


def read_landed(spark: SparkSession, root: str, source: str, table: str,
                load_dates: list | None = None) -> DataFrame:
    """All-string scan of a landed table with ``load_date`` as a partition
    column; a ``load_dates`` filter prunes whole folders before any file is
    opened."""
    base = landing_dir(root, source, table)
    first = next((n for n in fs.list_names(spark, base) if n.startswith("load_date=")), None)
    if first is None:
        raise FileNotFoundError(base)
    cols = read_header(spark, f"{base}/{first}")
    df = read_raw_csv(spark, base, columns=cols + ["load_date"],
                      extra_options={"basePath": base})
    if load_dates is not None:
        df = df.filter(F.col("load_date").isin([str(d) for d in load_dates]))
    return df


__all__ = ["landing_dir", "land_file", "land_files", "land_frame", "read_landed", "landing_order",
           "CSV_OPTIONS"]

"""Thin helpers over the Hadoop FileSystem API, so every path works on the
cluster's file system (HDFS, object stores, local) exactly as Spark sees it."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _jvm(spark: SparkSession):
    return spark.sparkContext._jvm


def _path(spark: SparkSession, path: str):
    jvm = _jvm(spark)
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p))


def list_files(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Data files directly under ``path`` (hidden and marker files skipped)."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isFile() and not name.startswith(("_", ".")) and name.endswith(suffix):
            out.append(st.getPath().toString())
    return sorted(out)


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _path(spark, path)
    return bool(fs.delete(p, recursive))


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.mkdirs(p)


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Create a small file; with ``overwrite=False`` an existing file is an error,
    which makes the write usable as an atomic claim of a name."""
    fs, p = _path(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    jvm = _jvm(spark)
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        data = jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode("utf-8")


def copy(spark: SparkSession, src: str, dst: str, overwrite: bool = True) -> None:
    """Byte-for-byte copy between any two Hadoop paths."""
    jvm = _jvm(spark)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    sfs, sp = _path(spark, src)
    dfs, dp = _path(spark, dst)
    ok = jvm.org.apache.hadoop.fs.FileUtil.copy(sfs, sp, dfs, dp, False, overwrite, conf)
    if not ok:
        raise OSError(f"copy failed: {src} -> {dst}")


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified URI of a path (scheme included)."""
    fs, p = _path(spark, path)
    return fs.makeQualified(p).toString()


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Atomic move of one file (on HDFS / local); the target folder is created."""
    sfs, sp = _path(spark, src)
    dfs, dp = _path(spark, dst)
    dfs.mkdirs(dp.getParent())
    if not sfs.rename(sp, dp):
        raise OSError(f"rename failed: {src} -> {dst}")


def age_hours(spark: SparkSession, path: str) -> float:
    """Hours since a file or folder was last changed."""
    import time

    fs, p = _path(spark, path)
    return (time.time() - fs.getFileStatus(p).getModificationTime() / 1000) / 3600


def list_tree(spark: SparkSession, path: str) -> list[str]:
    """All data files under ``path`` (recursively), as full paths."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    out = []
    it = fs.listFiles(p, True)
    while it.hasNext():
        st = it.next()
        if not st.getPath().getName().startswith(("_", ".")):
            out.append(st.getPath().toString())
    return sorted(out)


def walk_files(spark: SparkSession, path: str) -> list[str]:
    """Every file under ``path`` (or the file itself), hidden ones included."""
    fs, p = _path(spark, path)
    it, out = fs.listFiles(p, True), []
    while it.hasNext():
        out.append(it.next().getPath().toString())
    return sorted(out)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    fs, p = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes stored under ``path`` (file-system metadata only)."""
    fs, p = _path(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0

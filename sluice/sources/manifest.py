"""Manifests: the files a bulk load expects, checked before anything loads."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .. import fs
from ..operators.quality import DataCheckError


class MissingSourceFiles(FileNotFoundError):
    pass


def check_manifest(spark: SparkSession, manifest: dict[str, str]) -> None:
    """Stop before any load when a source is missing, naming all of them."""
    missing = [path for path in manifest.values() if not fs.exists(spark, path)]
    if missing:
        raise MissingSourceFiles(f"missing required files: {', '.join(missing)}")


#: Files that Spark and Hadoop writers leave beside the data.
MARKERS = ("_SUCCESS",)


def source_files(spark: SparkSession, path: str) -> list[str]:
    """A source is one file or a folder of part files, nested folders included.
    Names that readers would skip (leading ``_`` or ``.``) are refused, so a load
    is never short of a file without saying so; writers' markers are no data."""
    base = fs.qualify(spark, path).rstrip("/") + "/"
    files, hidden = [], []
    for full in fs.walk_files(spark, path):
        parts = full.removeprefix(base).split("/")
        if full + "/" == base:
            files.append(full)
        elif parts[-1] in MARKERS or (parts[-1].startswith(".") and parts[-1].endswith(".crc")):
            continue
        else:
            (hidden if any(p.startswith(("_", ".")) for p in parts) else files).append(full)
    if hidden:
        raise DataCheckError(f"{path}: {len(hidden)} file(s) that readers skip, e.g. {hidden[0]}")
    if not files:
        raise DataCheckError(f"{path}: folder without files")
    return files

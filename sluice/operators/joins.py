"""Join helpers with an explicit size check before any broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only if its counted rows and its stored bytes stay under
# these bounds.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def _write(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    from ..session import new_work_dir

    spark = df.sparkSession
    path = new_work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path), path


def materialize(df: DataFrame, label: str = "small-side") -> DataFrame:
    """Cut lineage by writing ``df`` as a table in the shared checkpoint folder
    and reading it back: computed once, survives lost executors, and its row
    count comes from the Parquet footers."""
    return _write(df, label)[0]


def sized_side(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
               max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Materialize a candidate small side once, then say whether it may be
    broadcast: its row count (Parquet footers) and stored size (file-system
    metadata) must both be under their bounds.  Beyond them the caller keeps
    a shuffled join."""
    from .. import fs

    solid, path = _write(df, "small-side")
    return solid, fs.total_bytes(df.sparkSession, path) <= max_bytes and solid.count() <= max_rows


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               max_rows: int = DEFAULT_BROADCAST_ROWS,
               max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``big`` join ``small``: broadcast ``small`` when its measured size allows,
    otherwise fall back to the shuffled join Catalyst picks."""
    solid, ok = sized_side(small, max_rows, max_bytes)
    return big.join(F.broadcast(solid) if ok else solid, on, how)

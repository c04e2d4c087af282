"""Per-key aggregates, arg-max with tie-breaks, ranks and last-N per key.

All of these rely on hash aggregation with a map-side partial step, so a key
holding a large share of the rows is pre-combined in every task before the
shuffle and never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def totals_by_key(df: DataFrame, key: str | Sequence[str], sums: dict[str, str],
                  count_name: str = "n_rows") -> DataFrame:
    """count(*) plus sum(col) per key; sums over all-NULL or nothing are NULL."""
    keys = [key] if isinstance(key, str) else list(key)
    aggs = [F.count(F.lit(1)).alias(count_name)]
    aggs += [F.sum(F.col(src)).alias(out) for out, src in sums.items()]
    return df.groupBy(*keys).agg(*aggs)


def sort_key(*parts: tuple[Column | str, str]) -> Column:
    """Struct that orders like ``ORDER BY``: each part is (column, 'desc'|'asc').

    NULLs follow the SQL default: first for ascending, last for descending.
    Numeric descending parts are negated; use the result with ``min_by``
    (the row that sorts first wins, with map-side partial aggregation).
    """
    fields = []
    for i, (col, direction) in enumerate(parts):
        col = _c(col)
        if direction == "desc":
            fields.append(col.isNull().alias(f"n{i}"))
            fields.append((-col).alias(f"v{i}"))
        elif direction == "asc":
            fields.append(col.alias(f"v{i}"))
        else:
            raise ValueError(direction)
    return F.struct(*fields)


def rank_within(df: DataFrame, key: str | Sequence[str], order: Sequence[Column],
                out: str = "rank") -> DataFrame:
    """row_number() over (partition by key order by ...)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def last_n_per_key(df: DataFrame, key: str, order: Sequence[Column], n: int,
                   out: str = "recency") -> DataFrame:
    """The last ``n`` rows per key by ``order`` (given newest-first).

    A top-k, so the limit is the feature.  Catalyst plans a partial
    WindowGroupLimit before the shuffle: every task forwards at most ``n`` rows
    per key, so a hot key never reaches one task whole.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= n)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """One row per key: the row with the greatest ``order`` (e.g. the latest
    landing of a revised record).  ``max_by`` aggregates map-side first, so a
    key repeated in many files is reduced in every task before the shuffle."""
    others = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_row"))
    return picked.select(*keys, *[F.col("_row").getField(c).alias(c) for c in others]).select(
        *df.columns)

"""Running values per group by a distributed prefix scan.

Rows are range-partitioned on (group, order), so a group of any size lies in
consecutive parts and a hot one fills several of them.  Each part is scanned on its
own; only the groups at its two edges can go on in another part, so one row per edge
(at most two per part) carries the value from part to part.  The parts are written
first: their bounds come from a sample and must not change between the scan and the
carry.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import materialize


def _group(by: Sequence[str]) -> Column:
    return F.struct(*by) if by else F.lit(0)


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], last: Mapping[str, Column] | None = None,
            total: Mapping[str, Column] | None = None, spread: Sequence[Column] = (),
            parts: int | None = None) -> DataFrame:
    """``df`` with, per group and in ``order`` (ascending, NULL first), columns of

    * ``last``: the last non-NULL value up to and with the row,
    * ``total``: the sum of the values so far (NULL before the first one).

    ``order`` should name each row of a group; rows equal in it may take each other's
    value.  ``spread`` are further sort keys for the parts only: they deal rows that are
    equal in ``order`` to several parts (their values must then not depend on each
    other).  ``parts`` defaults to the session's shuffle partitions."""
    specs = [(out, "last", c) for out, c in (last or {}).items()] + [(out, "total", c) for out, c in (total or {}).items()]
    by, names = list(by), df.columns
    keys = [F.col(c) for c in [*by, *order]] + list(spread)
    marked = df.select("*", *[c.alias(f"_v{i}") for i, (_, _, c) in enumerate(specs)])
    dealt = marked.repartitionByRange(parts, *keys) if parts else marked.repartitionByRange(*keys)
    table = materialize(dealt.withColumn("_part", F.spark_partition_id()), "scan-parts")

    def combine(i: int, kind: str, value: str, window) -> Column:
        c = F.col(f"{value}{i}")
        return (F.last(c, ignorenulls=True) if kind == "last" else F.sum(c)).over(window)

    upto = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = table.select(*names, "_part", *[combine(i, kind, "_v", upto).alias(f"_l{i}")
                                            for i, (_, kind, _) in enumerate(specs)])
    # One row per part: small by construction, so broadcast without a count.
    edges = table.groupBy("_part").agg(F.min(_group(by)).alias("_lo"), F.max(_group(by)).alias("_hi"))
    here = table.withColumn("_g", _group(by)).join(F.broadcast(edges), "_part").where(
        F.col("_g").eqNullSafe(F.col("_lo")) | F.col("_g").eqNullSafe(F.col("_hi")))
    value = lambda i: F.col(f"_v{i}")
    pieces = here.groupBy("_part", *by).agg(*[
        (F.max_by(value(i), F.when(value(i).isNotNull(), F.struct(*order))) if kind == "last" else F.sum(value(i))).alias(f"_p{i}")
        for i, (_, kind, _) in enumerate(specs)])
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select("_part", *[F.col(c).alias(f"_by{n}") for n, c in enumerate(by)],
                            *[combine(i, kind, "_p", before).alias(f"_c{i}") for i, (_, kind, _) in enumerate(specs)])
    # At most two rows per part.
    carried = F.broadcast(carried.withColumnRenamed("_part", "_of"))
    on = [F.col("_part") == F.col("_of")] + [F.col(c).eqNullSafe(F.col(f"_by{n}")) for n, c in enumerate(by)]
    joined = local.join(carried, on, "left")
    out = []
    for i, (name, kind, _) in enumerate(specs):
        mine, prior = F.col(f"_l{i}"), F.col(f"_c{i}")
        out.append((F.coalesce(mine, prior) if kind == "last" else F.coalesce(mine + prior, mine, prior)).alias(name))
    return joined.select(*names, *out)


def asof_join(left: DataFrame, left_at: str, observations: DataFrame, observed_at: str, values: Sequence[str],
              by: Sequence[str] = (), out_at: str | None = None, parts: int | None = None) -> DataFrame:
    """Each left row with the ``values`` of the last observation of its group at or before
    ``left_at`` (NULL if there is none, or if ``left_at`` is NULL) and, as ``out_at``, its
    time.  A sort-merge join: both sides go into one range shuffle on (group, time) and
    the last observation is carried along; no side is broadcast, no interval is copied
    into buckets.  Of observations at one time the largest by ``values`` counts.  Left
    rows of one time are spread over parts by their content."""
    by, names = list(by), left.columns
    seen = observations.where(F.col(observed_at).isNotNull()).select(
        *by, F.col(observed_at).alias("_at"), F.lit(0).alias("_side"), F.struct(F.col(observed_at).alias("_when"), *values).alias("_obs"))
    asked = left.select(*by, F.col(left_at).alias("_at"), F.lit(1).alias("_side"), F.struct(*names).alias("_row"))
    both = seen.unionByName(asked, allowMissingColumns=True)
    found = running(both, by, ["_at", "_side", "_obs"], last={"_found": F.col("_obs")},
                    spread=[F.xxhash64("_row")], parts=parts).where("_side = 1")
    out_at = out_at or observed_at
    return found.select(*[F.col(f"_row.{c}").alias(c) for c in names], F.col("_found._when").alias(out_at),
                        *[F.col(f"_found.{c}").alias(c) for c in values])

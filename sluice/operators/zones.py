"""Wall-clock times that a zone's transitions skip or repeat.

``transitions`` tabulates the zone's offset changes from the zone rules themselves, as
a DataFrame: every hour whose offset differs from that of the hour before it is cut
into seconds.  ``resolve_wall_clock`` marks wall-clock times that fall into a gap or an
overlap and applies a stated rule.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import join_small

RULES = ("earlier", "later", "fail")


def _offset(seconds: Column, zone: str) -> Column:
    """Offset of the zone, in seconds, at a UTC instant given as seconds since 1970."""
    at = F.convert_timezone(F.lit("UTC"), F.lit("UTC"), F.timestamp_seconds(seconds).cast("timestamp_ntz"))
    return F.timestamp_diff("SECOND", at, F.convert_timezone(F.lit("UTC"), F.lit(zone), at))


def transitions(spark: SparkSession, zone: str, first: dt.date = dt.date(1970, 1, 1),
                last: dt.date = dt.date(2038, 1, 1)) -> DataFrame:
    """at_utc, kind ('gap' or 'overlap'), before_s and after_s (offsets), wall_from and
    wall_to (the wall-clock times skipped or repeated, end exclusive) of every change of
    the zone's offset between two days.  Needs the session time zone UTC."""
    hour = lambda day: (day - dt.date(1970, 1, 1)).days * 24
    hours = spark.range(hour(first), hour(last)).select((F.col("id") * 3600).alias("s"))
    changed = hours.where(_offset(F.col("s"), zone) != _offset(F.col("s") + 3600, zone))
    seconds = changed.select(F.explode(F.sequence(F.col("s") + 1, F.col("s") + 3600)).alias("s")).select(
        "s", _offset(F.col("s") - 1, zone).alias("before_s"), _offset(F.col("s"), zone).alias("after_s")).where(
        "before_s <> after_s")
    wall = lambda c: F.timestamp_seconds(F.col("s") + c).cast("timestamp_ntz")
    return seconds.select(
        F.timestamp_seconds("s").cast("timestamp_ntz").alias("at_utc"),
        F.when(F.col("after_s") > F.col("before_s"), F.lit("gap")).otherwise(F.lit("overlap")).alias("kind"),
        "before_s", "after_s", wall(F.least("before_s", "after_s")).alias("wall_from"),
        wall(F.greatest("before_s", "after_s")).alias("wall_to"))


def resolve_wall_clock(df: DataFrame, wall: str, zone: str, changes: DataFrame, rule: str = "earlier",
                       out: str = "at_utc", kind: str = "wall_kind") -> DataFrame:
    """``df`` with the UTC instant of the wall-clock time (timestamp_ntz) in ``wall`` and
    its kind: NULL (one instant), 'gap' or 'overlap'.

    A time in a gap moves forward by the gap.  Of the two instants of a repeated time
    ``rule`` takes the earlier or the later one; ``fail`` raises on both kinds.  The
    transitions meet their days by an equi-join; they are few (counted before they are
    broadcast)."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    names = df.columns
    days = changes.withColumn("_day", F.explode(F.sequence(
        F.to_date("wall_from"), F.to_date(F.col("wall_to") - F.expr("INTERVAL 1 SECOND"))))).select(
        "_day", F.struct("kind", "before_s", "after_s", "wall_from", "wall_to").alias("_change"))
    # A day with several changes (never seen in practice) keeps them all.
    days = days.groupBy("_day").agg(F.sort_array(F.collect_list("_change")).alias("_changes"))
    joined = join_small(df.withColumn("_day", F.to_date(wall)), days, "_day", "left")
    inside = F.filter("_changes", lambda c: (c["wall_from"] <= F.col(wall)) & (F.col(wall) < c["wall_to"]))
    hit = joined.withColumn("_hit", F.get(inside, 0))
    shifted = lambda offset: F.timestamp_seconds(
        F.unix_seconds(F.col(wall).cast("timestamp")) - offset).cast("timestamp_ntz")
    single = F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col(wall))
    of = F.col("_hit.kind")
    if rule == "fail":
        refused = F.raise_error(F.concat(F.lit(f"no single instant in {zone}: "), F.col(wall).cast("string")))
        at = F.when(of.isNotNull(), refused.cast("timestamp_ntz")).otherwise(single)
    else:
        repeated = shifted(F.col("_hit.before_s") if rule == "earlier" else F.col("_hit.after_s"))
        at = F.when(of == "gap", shifted(F.col("_hit.before_s"))).when(of == "overlap", repeated).otherwise(single)
    return hit.select(*names, at.alias(out), of.alias(kind))

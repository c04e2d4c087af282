"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words (``source_targets``).  A source whose
target is r times its size takes each of its documents floor(r) whole times for
certain; the remaining words come from one Pareto order sample without
replacement: documents are ranked by

    (u / (1 - u)) / (p / (1 - p)),    u: random per document, p: its inclusion probability

and taken from the smallest rank on until the words of the sample come nearest
to what remains (the fixed size is counted in words, in whole documents).  p is
unequal: the remaining fraction of the source times the document's weight,
normalised so that the expected words meet the remainder; p >= 1 is certain.
The weight of a document of s words is s / (s + SHORT), so fragments are less
likely; documents without words have p = 0 and are taken 0 times.

A hot source is never gathered in one task: ranks are counted per (source,
bucket of the rank), the bucket in which the cut falls is found from those sums,
and only that bucket is ordered row by row.

Null source: a source of its own, last.  Null text: size 0.  Null doc_id and
repeated rows are documents of their own (rows with equal doc_id, text and source tie
in rank and are cut arbitrarily among equals).  Empty table: empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import salted_left_join, word_count, written

WEIGHTS = (5, 2, 1)
CAP = 3
SHORT = 64
SEED = 20240607
BUCKETS = 1 << 16
COARSE = 1 << 8      # buckets are first summed by so many: no window sees more than 256 rows of a source


def source_targets(sizes: DataFrame, share: float = 1.0, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, n_words) -> the same with ``target``.

    Sources in code point order, null last, take the weights in turn and divide
    ``share`` of all words by them; a target stops at ``cap`` times the source's
    words and the excess is dealt again by weight among the others until none is above.

    One row per source; the rank comes from a range sort with per-partition
    offsets, the dealing is a short loop of one-row aggregates (each round caps
    at least one more source), so the list of sources is never in one place."""
    spark = sizes.sparkSession
    ordered = sizes.select("source", "n_words").repartitionByRange(
        F.col("source").isNull(), F.col("source")).sortWithinPartitions(
        F.col("source").isNull(), "source").withColumn("_row", F.monotonically_increasing_id())
    ordered = written(ordered, "mix-sources")
    part = (F.col("_row") / F.lit(1 << 33)).cast("long")
    counts = {r[0]: r[1] for r in ordered.groupBy(part.alias("p")).count().collect()}   # one per partition
    first, at = [], 0
    for p in sorted(counts):
        first.append((p, at))
        at += counts[p]
    offsets = spark.createDataFrame(first or [(0, 0)], "_part long, _first long")
    turn = (F.col("_first") + F.col("_row") - F.col("_part") * F.lit(1 << 33)) % len(weights)
    ranked = ordered.withColumn("_part", part).join(F.broadcast(offsets), "_part").select(
        "source", "n_words", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).alias("w"))
    total = share * float(ranked.agg(F.sum("n_words")).first()[0] or 0)
    # level: words per unit of weight for sources below their cap.
    level = 0.0
    while True:
        capped = F.col("n_words") * cap <= F.col("w") * F.lit(level)
        fixed, open_w = ranked.agg(F.sum(F.when(capped, F.col("n_words") * cap)),
                                   F.sum(F.when(~capped, F.col("w")))).first()
        if not open_w:
            break
        new = (total - float(fixed or 0)) / float(open_w)
        if new <= level:
            break
        level = new
    return ranked.select("source", "n_words", F.least(
        (F.col("n_words") * cap).cast("double"), F.col("w") * F.lit(level)).alias("target"))


def _crossing(buckets: DataFrame) -> DataFrame:
    """(_k, _at, _words, _rest, _before) -> the bucket of each source in which the
    running words, from _before on, reach _rest; _below: the words before it."""
    upto = Window.partitionBy("_k").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return buckets.withColumn("_through", F.col("_before") + F.sum("_words").over(upto)).withColumn(
        "_below", F.col("_through") - F.col("_words")).where("_below < _rest AND _through >= _rest")


def mix_documents(docs: DataFrame, share: float = 1.0, weights=WEIGHTS, cap: int = CAP,
                  seed: int = SEED, key: str = "doc_id", text: str = "text",
                  source: str = "source") -> DataFrame:
    """Per row of ``docs``: key, ``size``, ``source_size``, ``target`` and ``copies``
    (whole copies of the document that the mix takes)."""
    sized = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"),
                        word_count(F.col(text)).alias("size"), F.xxhash64(F.col(text)).alias("_h"))
    sized = written(sized, "mix-sizes")
    totals = sized.groupBy("source").agg(
        F.sum("size").alias("n_words"),
        F.sum(F.col("size") * F.col("size") / (F.col("size") + F.lit(SHORT))).alias("_mass"))
    totals = written(totals, "mix-totals")
    targets = source_targets(totals.select("source", "n_words"), share, weights, cap)
    per_source = totals.withColumnRenamed("source", "_s").join(
        targets.select(F.col("source").alias("_t"), "target"), F.col("_s").eqNullSafe(F.col("_t"))).drop("_t")
    ratio = F.when(F.col("n_words") > 0, F.col("target") / F.col("n_words")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + F.lit(1e-9)).cast("long")
    per_source = written(per_source.withColumn("_whole", whole).withColumn(
        "_rest", F.greatest(F.lit(0.0), F.col("target") - F.col("_whole") * F.col("n_words"))), "mix-per-source")

    # Null-safe key without a null-safe join: a flag and the value.
    keyed = per_source.select(F.coalesce(F.concat(F.lit("s"), "_s"), F.lit("n")).alias("_k"),
                              "n_words", "target", "_mass", "_whole", "_rest")
    rows = salted_left_join(
        sized.withColumn("_k", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))), keyed, "_k", "doc_id")
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("_h")), 11).cast("double")
         + 0.5) / F.lit(float(1 << 53))
    p = F.when(F.col("_mass") > 0, F.col("_rest") / F.col("_mass")
               * F.col("size") / (F.col("size") + F.lit(SHORT))).otherwise(F.lit(0.0))
    # q / (1 + q), monotone in the rank q: 0 for certain documents, 1 for impossible ones.
    odds = (F.col("_u") / (1 - F.col("_u"))) * (1 - F.col("_p")) / F.col("_p")
    rank = F.when(F.col("_p") >= 1, F.col("_u") * 1e-9).when(F.col("_p") <= 0, F.lit(1.0)).otherwise(odds / (1 + odds))
    rows = rows.withColumn("_u", u).withColumn("_p", p).withColumn("_q", rank).withColumn(
        "_b", F.least(F.lit(BUCKETS - 1), F.floor(F.col("_q") * BUCKETS)).cast("int"))
    rows = written(rows.drop("_u", "_h", "_mass"), "mix-ranked")

    # The bucket of each source in which the running words pass what remains.
    buckets = rows.where("size > 0 AND _rest > 0").groupBy("_k", "_b").agg(
        F.sum("size").alias("_words"), F.max("_rest").alias("_rest"))
    buckets = buckets.withColumn("_coarse", F.floor(F.col("_b") / COARSE).cast("int"))
    coarse = buckets.groupBy("_k", F.col("_coarse").alias("_at")).agg(
        F.sum("_words").alias("_words"), F.max("_rest").alias("_rest")).withColumn("_before", F.lit(0))
    found = _crossing(coarse).select("_k", F.col("_at").alias("_coarse"), F.col("_below").alias("_before"))
    cut = _crossing(buckets.withColumnRenamed("_b", "_at").join(found, ["_k", "_coarse"])).select(
        "_k", F.col("_at").alias("_cut"), "_below")
    cut = written(cut, "mix-cut")
    rows = salted_left_join(rows, cut, "_k", "doc_id")
    edge = rows.where("_b = _cut AND size > 0")
    in_order = Window.partitionBy("_k").orderBy("_q", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("_end", F.col("_below") + F.sum("size").over(in_order))
    # Whole documents: the one that crosses the line is taken if that ends nearer to it.
    edge = edge.withColumn("_more", (F.col("_end") - F.col("size") / 2 <= F.col("_rest")).cast("long"))
    sure = rows.where("NOT (size > 0 AND _cut IS NOT NULL AND _b = _cut)").withColumn(
        "_more", F.when((F.col("size") > 0) & (F.col("_rest") > 0)
                        & (F.col("_cut").isNull() | (F.col("_b") < F.col("_cut"))), F.lit(1))
        .otherwise(F.lit(0)).cast("long"))
    out = edge.drop("_end").unionByName(sure)
    return out.select("doc_id", "size", F.col("n_words").alias("source_size"), "target",
                      F.when(F.col("size") > 0, F.col("_whole") + F.col("_more"))
                      .otherwise(F.lit(0)).cast("long").alias("copies"))


def mix_query(docs: DataFrame) -> DataFrame:
    """Digest of the mix: doc_id, size, source_size, target, taken."""
    return mix_documents(docs).select("doc_id", "size", "source_size", "target",
                                      (F.col("copies") * F.col("size")).alias("taken"), "copies")

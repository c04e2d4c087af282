"""Pipeline over documents: quality rules, near duplicates, secrets, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet to the shared work folder and hands the reread table to the next one.
A stage's result must be written before the next stage is called: that one removes the
scratch tables of the stage before it.
All stages but the last return the columns of ``documents``.  None can be stated in
SQL as a whole (suffix arrays, shingle components, Markov scores, random order
sampling), so ``ORACLE_SQL`` is None and the tests hold each stage against its
operator and brute force.
"""

from __future__ import annotations

import functools
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sluice.llm import bpe_duckdb, parity_join, pareto_mix, repetition, secret_markov  # noqa: E402
from sluice.llm.common import discard, kept, may_be_in, prepare, salted_left_join, sweep, table, written  # noqa: E402
from sluice.llm.queries import tokenizer  # noqa: E402

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key from doc_id and text, so that decisions reach rows whose doc_id
    is null or repeats; rows equal in both share a key."""
    return docs.select(*COLUMNS).withColumn("_row", F.xxhash64("doc_id", "text"))


#: Scratch tables of the last stage.  Its result has been written when the next one begins.
_scratch: list[str] = []


def _stage(fn):
    """A stage that first removes what the one before it left in the work folder."""

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        sweep(spark, _scratch)
        before = set(kept())
        out = fn(spark, docs, sf_dir)
        _scratch[:] = [f for f in kept() if f not in before]
        return out

    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the repetition rules reject."""
    return repetition.keep_documents(docs.select(*COLUMNS))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of near duplicates (5-word shingles,
    Jaccard 0.8): the one with the smallest doc_id (null last, then the smaller
    key).  Documents without words stay; of rows equal in doc_id and text one stays."""
    rows = _keyed(docs)
    groups = written(parity_join.link_components(rows, 5, 80, key="_row").select(
        F.col("doc_id").alias("_row"), F.col("component_id").alias("_group")), "near-groups")
    # Only rows of a group of several can go: the texts of the others are not shuffled.
    several = groups.groupBy("_group").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    shared = written(salted_left_join(groups, several, "_group", "_row").where("_rows > 1").select(
        "_row", "_group").distinct(), "near-shared")
    ids = may_be_in(rows.select("_row", "doc_id"), shared, "_row").where("_maybe").select("_row", "doc_id").distinct()
    stay = shared.join(ids, "_row").groupBy("_group").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("n"), "doc_id", "_row")).alias("o")).select(F.col("o._row").alias("_row"))
    gone = written(shared.join(stay, "_row", "left_anti").select("_row"), "near-gone")
    flagged = may_be_in(rows, shared, "_row")
    return flagged.where("NOT _maybe").select(*COLUMNS).unionByName(flagged.where("_maybe").join(
        gone, "_row", "left_anti").dropDuplicates(["_row"]).select(*COLUMNS))


@_stage
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a placeholder; n_chars follows the text."""
    return secret_markov.redact(docs.select(*COLUMNS)).withColumn(
        "n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it (rows equal in doc_id and
    text share out what the mix takes of them together)."""
    rows = _keyed(docs)
    copies = pareto_mix.mix_documents(rows, key="_row").where("copies > 0").groupBy(
        F.col("doc_id").alias("_row")).agg(F.sum("copies").alias("copies"))
    return rows.dropDuplicates(["_row"]).join(copies, "_row").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*COLUMNS)


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and whether decoding gives the text back."""
    got = bpe_duckdb.encode(docs, tokenizer("byte_bpe_50k.tiktoken"))
    return got.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                      F.octet_length("decoded").cast("long").alias("decoded_bytes"))


STAGES = [("quality rules", quality), ("near duplicates", near_duplicates), ("secret scans", secrets),
          ("mixing sources", mix), ("byte-level BPE", encode)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
        if before is not None:
            discard(before)
        before = docs
    return docs

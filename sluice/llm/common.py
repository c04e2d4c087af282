"""Helpers shared by the operators of this subpackage.

Texts reach Python as Arrow batches; the helpers walk them in slices of bounded
bytes, so the memory of a task does not depend on how many rows a batch holds.
A null text counts as an empty one unless an operator states otherwise.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fs
from ..session import ensure_checkpoint_dir, new_work_dir, ship_package

#: A word: a run of characters other than the ASCII white space.
WORD_RE = "[^\\x20\\x09-\\x0D]+"
SLICE_BYTES = 1 << 20

#: glibc's malloc_trim, which hands freed memory back; None with another C library.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

#: What one operator keeps in a Python worker between its tasks.
_STATE: dict[object, object] = {}


def worker_state(key: object, make):
    """State that later tasks of an operator find again in the same worker."""
    if key not in _STATE:
        release_state()
        _STATE[key] = make()
    return _STATE[key]


def release_state() -> None:
    """For the tasks of other operators: Spark hands them the same workers, whose memory
    would still hold the word caches and tables of the operator before, and what the C
    library keeps of memory that was freed."""
    _STATE.clear()
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on; workers can import the package.

    Arrow batches are kept small: a batch may hold very long texts."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write to a fresh folder of the shared work root and read it back: cuts
    lineage, survives lost executors, and several readers share one computation."""
    spark = df.sparkSession
    path = new_work_dir(spark, label)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.folder = path
    _KEPT.append(path)
    return out


#: Folders of tables written by this process and not removed yet.
_KEPT: list[str] = []


def kept() -> list[str]:
    return list(_KEPT)


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``written`` once their last reader has been written."""
    if tables:
        sweep(tables[0].sparkSession, [df.folder for df in tables])


def sweep(spark: SparkSession, folders: list[str]) -> None:
    """Remove folders of ``kept``, and let Spark drop the shuffle files of frames that
    nothing refers to any more (it does so after a collection of the driver's heap)."""
    for folder in folders:
        fs.delete(spark, folder)
        if folder in _KEPT:
            _KEPT.remove(folder)
    spark.sparkContext._jvm.java.lang.System.gc()


#: Words of 64 bits in a key filter: its broadcast side never has more rows of 16 bytes.
FILTER_WORDS = 1 << 20


def _filter_place(keys: tuple[str, ...]) -> tuple[Column, Column]:
    h = F.xxhash64(F.lit("filter"), *keys)
    return (F.pmod(F.shiftright(h, 6), F.lit(FILTER_WORDS)).alias("_word"),
            F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int")).alias("_bit"))


def may_be_in(rows: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with a boolean ``_maybe``: false only where the keys surely are not in
    ``wanted`` (null keys hash like values).  A bitmap of the wanted keys' hashes, at most
    ``FILTER_WORDS`` rows whatever the size of either side, is broadcast, so wide rows
    that are not wanted need no shuffle; an exact join decides about the others."""
    word, bit = _filter_place(keys)
    bits = wanted.select(word, bit).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    word, bit = _filter_place(keys)
    return rows.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(bits), "_word", "left").withColumn(
        "_maybe", F.coalesce(F.col("_bits").bitwiseAND(F.col("_bit")) != 0, F.lit(False))).drop("_word", "_bit", "_bits")


def word_count(text: Column) -> Column:
    """Number of words, JVM-side: gaps between words collapse to one blank."""
    blank = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " "))
    return F.when(blank == "", F.lit(0)).otherwise(
        F.length(blank) - F.length(F.translate(blank, " ", "")) + 1).cast("long")


def salted_left_join(big: DataFrame, small: DataFrame, key: str, by: str, salts: int = 16) -> DataFrame:
    """Left join on ``key`` where one key may hold a large share of ``big``.

    Each row of ``big`` takes a salt from column ``by`` (a hash, so a task that
    runs again deals the same rows out alike), ``small`` (unique by ``key``) is
    repeated per salt, so a hot key spreads over ``salts`` tasks."""
    salted = big.withColumn("_salt", F.pmod(F.hash(F.lit("salt"), by), F.lit(salts)))
    many = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(many, [key, "_salt"], "left").drop("_salt")


def strings(column) -> pa.Array:
    """A column of a batch as a plain string array without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def text_slices(column, limit: int = SLICE_BYTES):
    """Yield (first row, end row, bytes, offsets) of slices of about ``limit``
    bytes (a longer text makes a slice of its own); offsets start at 0."""
    arr = strings(column)
    n = len(arr)
    if n == 0:
        return
    offs = np.frombuffer(arr.buffers()[1], dtype=np.int32)[arr.offset:arr.offset + n + 1].astype(np.int64)
    body = arr.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def word_bounds(data: np.ndarray, offs: np.ndarray):
    """(start, end) byte positions of all words of a slice and, per text, the
    index of its first word (one more entry than texts)."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs), np.int64)
    word = ~IS_SPACE[data]
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    edges = offs[(offs > 0) & (offs < len(data))]
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (wraps around)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n - 1).bit_length())
    for known, both in _POWERS.items():
        if known >= size:
            return both
    up = np.full(size, _BASE, np.uint64)
    down = np.full(size, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    both = np.multiply.accumulate(up), np.multiply.accumulate(down)
    if size <= 4 * SLICE_BYTES:
        _POWERS.clear()
        _POWERS[size] = both
    return both


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for each span: a polynomial over random byte
    values from prefix sums, so all spans of a slice cost one pass."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))

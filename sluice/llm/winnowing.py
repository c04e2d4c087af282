"""Document fingerprints by winnowing.

Every run of ``k`` code points has a rolling hash; of each ``window`` consecutive
hashes the minimum is marked, of equal ones the rightmost.  Marks keep their
positions.  A shared passage of at least k + window - 1 code points therefore
has at least one common mark, wherever it lies (``guarantee``).  A text of
fewer than k code points has one mark, of the whole text; an empty one has none.

Hashes come from prefix sums of a polynomial over the code points, the sliding
minimum from doubling steps, all vectorised over one text at a time; longer
texts are walked in blocks that overlap by the window, so memory is bounded.

The likeness of two fingerprints is the Jaccard coefficient of their distinct
hashes (1 for two empty ones).

Null text: empty.  Rows with null doc_id come last in the order of documents,
rows with equal doc_id are ordered by text.  One row: it is its own next
document.  Empty table: no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BASE, _INVERSE, mix

K = 12
WINDOW = 13
BLOCK = 1 << 18
_LOW = np.uint64((1 << 24) - 1)


def guarantee(k: int = K, window: int = WINDOW) -> int:
    """Length from which a shared passage is certain to share a mark."""
    return k + window - 1


_UP = np.full(BLOCK + 4096, _BASE, np.uint64)
_UP[0] = 1
_UP = np.multiply.accumulate(_UP)
_DOWN = np.full(BLOCK + 4096, _INVERSE, np.uint64)
_DOWN[0] = 1
_DOWN = np.multiply.accumulate(_DOWN)


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of codes[i:i + k] for every i (at most BLOCK + 4096 codes)."""
    n = len(codes)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95) * _UP[:n], out=prefix[1:])
    return mix((prefix[k:] - prefix[:n - k + 1]) * _DOWN[:n - k + 1])


def marks(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the marked k-grams, by position; 40-bit hashes."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n <= k:
        return gram_hashes(codes, n) >> np.uint64(24), np.zeros(1, np.int64)
    got = []
    grams = n - k + 1
    lo = 0
    while True:
        hi = min(grams, lo + BLOCK)
        h = gram_hashes(codes[lo:hi + k - 1], k)
        # Smallest hash first, of equal hashes the rightmost.
        low = (h & ~_LOW) | (_LOW - np.arange(len(h), dtype=np.uint64))
        wide = min(window, len(low))
        span = 1
        while 2 * span <= wide:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < wide:
            low = np.minimum(low[:len(low) - (wide - span)], low[wide - span:])
        best = low[np.append(True, low[1:] != low[:-1])]
        at = (_LOW - (best & _LOW)).astype(np.int64)
        got.append((best >> np.uint64(24), at + lo))
        if hi == grams:
            break
        lo = hi - window + 1
    hashes = np.concatenate([x[0] for x in got])
    at = np.concatenate([x[1] for x in got])
    at, first = np.unique(at, return_index=True)
    return hashes[first], at


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    a, b = np.unique(a), np.unique(b)
    if len(a) == 0 and len(b) == 0:
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def as_text(hashes: np.ndarray) -> str:
    """Marked hashes in the order of the text, 10 hexadecimal digits each."""
    return "".join(f"{x:010x}" for x in hashes.tolist())


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, marks array<struct<hash long, pos long>> of every text."""
    def run(batches):
        kind = pa.struct([("hash", pa.int64()), ("pos", pa.int64())])
        for batch in batches:
            for i in range(batch.num_rows):
                h, at = marks(batch.column(1)[i].as_py() or "", k, window)
                row = pa.StructArray.from_arrays([pa.array(h.astype(np.int64)), pa.array(at)], ["hash", "pos"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.ListArray.from_arrays(pa.array([0, len(h)], pa.int32()), row.cast(kind))],
                    ["doc_id", "marks"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, marks array<struct<hash: bigint, pos: bigint>>")


def in_order(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """bucket, doc_id, text, carried: partitions sorted by bucket and doc_id, where
    the last row of a bucket (``carried``) repeats the first document of the next
    bucket, so that every document meets its next one in one task.

    Buckets are ranges of doc_id that begin at documents of the table (quantiles,
    one per shuffle partition); the texts are shuffled once."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(n)], 100 * n).alias("q"),
                    F.min("doc_id").alias("lo")).first()
    firsts = sorted({*(cuts["q"] or []), *([cuts["lo"]] if cuts["lo"] is not None else [])})
    if not firsts:   # no row, or no row with a doc_id
        firsts = [0]
    # Two-step search: among every step-th beginning, then among those up to the next.
    step = max(1, int(len(firsts) ** 0.5))
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    below = lambda xs: F.size(F.filter(xs, lambda b: b <= F.col("doc_id")))
    base = (F.greatest(F.lit(1), below(longs(firsts[::step]))) - 1) * step
    last = len(firsts) - 1
    bucket = F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise(
        F.greatest(F.lit(0), base + below(F.slice(longs(firsts), base + 1, F.lit(step))) - 1)).cast("int")
    own = rows.withColumn("bucket", bucket).withColumn("carried", F.lit(False))
    # First document of each bucket, again at the end of the bucket before it; the
    # very first after the last.  One row per bucket.
    heads = own.where(F.col("doc_id").isin(firsts) | (F.lit(cuts["lo"] is None))).groupBy("bucket").agg(
        F.min(F.struct("doc_id", "text")).alias("h"))
    carried = heads.select(F.col("h.doc_id").alias("doc_id"), F.col("h.text").alias("text"),
                           F.pmod(F.col("bucket") - 1, F.lit(len(firsts))).cast("int").alias("bucket"),
                           F.lit(True).alias("carried"))
    return own.unionByName(carried).repartition("bucket").sortWithinPartitions(
        "bucket", "carried", F.col("doc_id").asc_nulls_last(), "text")


def _against_next(k: int, window: int):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_marks"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names)

    def run(batches):
        held, rows, size = None, [], 0
        for batch in batches:
            at = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                bucket, doc_id, text, carried = (at[c][i].as_py() for c in ("bucket", "doc_id", "text", "carried"))
                own = marks(text, k, window)[0]
                if held is not None and held[0] == bucket:
                    _, before, body, print_ = held
                    half = len(body) // 2
                    edited = body[:len(body) - half] + text[:half]
                    other = marks(edited, k, window)[0]
                    rows.append((before, len(body), hashlib.sha256(edited.encode()).hexdigest(), as_text(print_), as_text(other),
                                 likeness(print_, other), likeness(print_, own), len(print_)))
                    size += 20 * (len(print_) + len(other)) + 200
                    if size > 1 << 21:
                        yield batch_of(rows)
                        rows, size = [], 0
                held = None if carried else (bucket, doc_id, text, own)
        if rows:
            yield batch_of(rows)

    return run


def winnow_query(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness."""
    return in_order(docs).mapInArrow(
        _against_next(k, window),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_marks long")

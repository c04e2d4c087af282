"""Token counts by heap-and-linked-list byte-pair merging.

Counts the tokens a sentencepiece BPE model gives a text, without making the
identifiers.  A chunk (blanks and the characters up to the next blank; no piece
of the vocabulary goes on past that) is a linked list of characters; a heap holds
its adjacent pairs that together are a piece, by rank (negated score, leftmost
first).  The lowest is popped and merged until none is left:

    tokens = initial symbols - merges

where a character outside the vocabulary stands for its UTF-8 bytes from the
start (byte fallback).  Blanks are the model's ▁; a text begins with one more.

Counts of chunks are kept in a bounded two-generation cache of the worker.

Null and empty text: 0 tokens.  Null doc_id and repeated rows: a row each.
Empty table: no rows.
"""

from __future__ import annotations

import functools
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_spans, strings, text_slices

LIMIT = 4096
CACHE_CHUNKS = 1_200_000
BLANK = "▁"


def count_tokens(chunk: str, rank: dict[str, float], symbols_of) -> int:
    """Tokens of one chunk: symbols minus merges."""
    sym = list(chunk)
    n = len(sym)
    count = sum(map(symbols_of, sym))
    if n == 1:
        return count
    heap = [(r, i, p) for i, p in enumerate(map(str.__add__, sym, sym[1:])) if (r := rank.get(p)) is not None]
    if not heap:
        return count
    heapify(heap)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    while heap:
        _, i, piece = heappop(heap)
        left = sym[i]
        if left is None:
            continue
        j = after[i]
        if j >= n or len(left) + len(sym[j]) != len(piece):
            continue
        sym[i], sym[j] = piece, None        # one merge
        count -= 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := rank.get(p := piece + sym[k])) is not None:
                heappush(heap, (r, i, p))
        h = before[i]
        if h >= 0 and (r := rank.get(p := sym[h] + piece)) is not None:
            heappush(heap, (r, h, p))
    return count


class Counter:
    def __init__(self, path: str, cache_chunks: int = CACHE_CHUNKS):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in range(model.get_piece_size())
                     if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        if any(BLANK in p.lstrip(BLANK) for p in self.rank):
            raise ValueError("a piece goes on past a blank; chunks cannot be cut there")
        self.limit = cache_chunks // 2
        self.young: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}

    def symbols_of(self, char: str) -> int:
        return 1 if char in self.rank else len(char.encode())

    def count(self, chunk: bytes) -> int:
        n = self.young.get(chunk) or self.old.get(chunk)
        if n is None:
            n = count_tokens(chunk.decode().replace(" ", BLANK), self.rank, self.symbols_of)
            if len(chunk) <= 256:
                if len(self.young) >= self.limit:
                    self.old, self.young = self.young, {}
                self.young[chunk] = n
        return n


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(path)


def _count_batches(path: str):
    def run(batches):
        counter = _counter(path)
        for batch in batches:
            keys, texts = batch.column(0), strings(batch.column(1))
            for lo, hi, body, offs in text_slices(texts):
                lens = offs[1:] - offs[:-1]
                # Every text begins with one more blank.
                data = np.insert(body, offs[:-1], 32)
                offs = offs + np.arange(len(offs))
                blank = data == 32
                cut = blank.copy()
                cut[1:] &= ~blank[:-1]
                literal = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)) + 3
                cut[literal[literal < len(data)]] = False
                cut[offs[:-1]] = True
                starts = np.flatnonzero(cut)
                ends = np.append(starts[1:], len(data))
                _, first, which = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
                raw = data.tobytes()
                counts = np.array([counter.count(raw[a:b]) for a, b in
                                   zip(starts[first].tolist(), ends[first].tolist(), strict=True)], np.int64)
                upto = np.append(0, np.cumsum(counts[which]))[np.searchsorted(starts, offs)]
                n = np.where(lens == 0, 0, upto[1:] - upto[:-1])
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(lo, hi - lo), pa.array(lens, pa.int64()), pa.array(n, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit)."""
    got = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        _count_batches(path), "doc_id long, n_bytes long, n_tokens long")
    return got.withColumn("over_limit", F.col("n_tokens") > limit)

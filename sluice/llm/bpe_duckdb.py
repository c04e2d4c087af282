"""Byte-level BPE encoding and decoding by recursive queries.

A text is cut into the matches of the tokenizer's split pattern; each match is
encoded on its own.  Per partition the distinct matches become token-position
rows of an in-process DuckDB: every step of a recursive query joins adjacent
tokens with the merge table (all pairs whose bytes together are a token) and
contracts each word's leftmost pair of minimum rank, until no word has a pair.
Decoding joins the token rows with the vocabulary and puts their bytes together
by an ordered aggregation.

Long runs without a cut use a second form of the step that contracts all
occurrences of the pair of minimum rank at once where that is provably the same:
a merge is ``calm`` if every pair with the merged token has a higher rank, so
the next minimum is again the same pair (of overlapping occurrences every other
one is taken, from the left).  The recursion runs ``STEPS`` steps at a time, so
rows held are bounded by ``STEPS`` times the bytes of a batch.

A recursion takes a step per merge, or per distinct pair, of its longest word, and holds
the rows of all its steps.  Matches above ``RECURSIVE_BYTES`` (thousands of letters without
a blank) would so need hours and gigabytes; they are contracted by a heap of adjacent
pairs over a linked list instead, with the same result and memory in proportion.

Words already encoded are kept in a bounded two-generation cache of the worker; the cache,
the merge table and the vocabulary go when the worker gets another operator's task.

Null text: encoded as empty (no tokens).  Null doc_id and repeated rows: a row
each.  Empty table: no rows.  Special-token strings in a text are ordinary text.  Very
long texts are a slice of their own.  Other columns are not read, so their names do not
matter.
"""

from __future__ import annotations

import base64
import functools
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_spans, strings, text_slices, worker_state

STEPS = 24
BATCH_BYTES = 160 << 10
LONG_WORD = 64
RECURSIVE_BYTES = 2048
CACHE_WORDS = 250_000

#: One step contracts the leftmost minimum-rank pair of every word: the pair's right row
#: becomes the merged token, its left row goes.  Places are below 2^12 (``RECURSIVE_BYTES``),
#: so rank and places of the pair are one number; every word has one row at place 0.
_ONE = """
WITH RECURSIVE state AS (
  SELECT 0 AS step, wid, pos, tok, nxt, npos, m.rank
  FROM start LEFT JOIN merges m ON m.pair = (tok::BIGINT << 32 | nxt::BIGINT)
  UNION ALL
  SELECT n.step, n.wid, n.pos, n.tok, n.nxt, n.npos, m.rank FROM (
    SELECT s.step + 1 AS step, s.wid,
      CASE WHEN s.pos = b.npos THEN b.pos ELSE s.pos END AS pos,
      CASE WHEN s.pos = b.npos THEN b.rank ELSE s.tok END AS tok,
      CASE WHEN s.npos = b.pos THEN b.rank ELSE s.nxt END AS nxt, s.npos
    FROM state s JOIN (
      SELECT wid, (p >> 24)::INT AS rank, ((p >> 12) & 4095)::INT AS pos, (p & 4095)::INT AS npos FROM (
        SELECT wid, min((rank::BIGINT << 24) | (pos << 12) | npos) AS p
        FROM state WHERE rank IS NOT NULL AND step < $steps GROUP BY wid)) b ON s.wid = b.wid
    WHERE s.pos <> b.pos) n
  LEFT JOIN merges m ON m.pair = (n.tok::BIGINT << 32 | n.nxt::BIGINT)
), last AS (SELECT wid, max(step) AS step FROM state WHERE pos = 0 GROUP BY wid)
SELECT wid, pos, tok, nxt, npos, rank FROM state JOIN last USING (wid, step)
"""

#: One step contracts all occurrences of the minimum-rank pair if it is calm.
_ALL = """
WITH RECURSIVE state AS (
  SELECT 0 AS step, wid, pos, tok, npos, m.rank, m.calm
  FROM start LEFT JOIN merges m ON m.pair = (tok::BIGINT << 32 | nxt::BIGINT)
  UNION ALL
  SELECT n.step, n.wid, n.pos, n.tok, n.npos, m.rank, m.calm FROM (
    WITH best AS (SELECT wid, min(rank) AS rank FROM state WHERE rank IS NOT NULL AND step < $steps GROUP BY wid),
    found AS (
      SELECT s.wid, s.pos, s.npos, s.rank, s.calm, lag(s.npos) OVER w AS left_end, lag(s.pos) OVER w AS left_pos
      FROM state s JOIN best b ON s.wid = b.wid AND s.rank = b.rank WINDOW w AS (PARTITION BY s.wid ORDER BY s.pos)),
    chained AS (
      SELECT *, sum(CASE WHEN left_end = pos THEN 0 ELSE 1 END) OVER (PARTITION BY wid ORDER BY pos) AS chain FROM found),
    hits AS (
      SELECT wid, pos, npos, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY wid, chain ORDER BY pos) AS j FROM chained)
      WHERE left_pos IS NULL OR (calm AND j % 2 = 1)),
    grown AS (
      SELECT s.step + 1 AS step, s.wid, s.pos, coalesce(h.rank, s.tok) AS tok, coalesce(h.after_pos, s.npos) AS npos
      FROM state s JOIN best ON s.wid = best.wid
      LEFT JOIN (SELECT hits.wid, hits.pos, hits.rank, x.npos AS after_pos
                 FROM hits JOIN state x ON x.wid = hits.wid AND x.pos = hits.npos) h
        ON h.wid = s.wid AND h.pos = s.pos
      WHERE NOT EXISTS (SELECT 1 FROM hits g WHERE g.wid = s.wid AND g.npos = s.pos))
    SELECT a.step, a.wid, a.pos, a.tok, a.npos, b.tok AS nxt
    FROM grown a LEFT JOIN grown b ON b.wid = a.wid AND b.pos = a.npos) n
  LEFT JOIN merges m ON m.pair = (n.tok::BIGINT << 32 | n.nxt::BIGINT)
), last AS (SELECT wid, max(step) AS step FROM state GROUP BY wid)
SELECT wid, pos, tok, lead(tok) OVER (PARTITION BY wid ORDER BY pos) AS nxt, npos, rank
FROM state JOIN last USING (wid, step)
"""

#: Decoding: the bytes of the tokens of all words in order.
_WORDS = """
SELECT list(tok ORDER BY wid, pos) AS ids, string_agg(v.hex, '' ORDER BY wid, pos) AS hex
FROM final JOIN vocabulary v ON v.id = tok
"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Encoder:
    """Merge table and vocabulary in an in-process DuckDB; one per worker."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        import duckdb

        ranks = load_ranks(path)
        pairs, left, right, lowest = [], [], [], {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    pairs.append(rank)
                    lowest[a] = min(lowest.get(a, rank), rank)
                    lowest[b] = min(lowest.get(b, rank), rank)
        rank = np.array(pairs, np.int64)
        merges = pa.table({  # noqa: F841 - read by the query below
            "pair": np.array(left, np.int64) << 32 | np.array(right, np.int64), "rank": rank.astype(np.int32),
            "calm": np.array([lowest.get(r, r + 1) > r for r in pairs], bool)})
        words = pa.table({"id": pa.array(list(ranks.values()), pa.int32()),  # noqa: F841
                          "hex": pa.array([t.hex() for t in ranks])})
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "500MB", "temp_directory": ""})
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merges")
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM words")
        self.byte_rank = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.ranks, self.limit = ranks, cache_words // 2
        self.token = {rank: token for token, rank in ranks.items()}
        self.token_bytes = np.zeros(max(self.token) + 1, np.int64)
        self.token_bytes[list(self.token)] = [len(t) for t in self.token.values()]
        self.young: dict[bytes, tuple] = {}
        self.old: dict[bytes, tuple] = {}

    def lookup(self, words: list[bytes]) -> list[tuple]:
        """(ids as the bytes of 32-bit numbers, decoded bytes) of each word."""
        found, missing = [*map(self.young.get, words)], []
        for i in [i for i, f in enumerate(found) if f is None]:
            found[i] = self.old.get(words[i])
            if found[i] is None:
                missing.append(i)
            else:
                self.young[words[i]] = found[i]      # words met again outlive the next change of generations
        if missing:
            self._encode([words[i] for i in missing])
            for i in missing:
                found[i] = self.young[words[i]]
        return found

    def _encode(self, words: list[bytes]) -> None:
        if len(self.young) + len(words) > self.limit:
            self.old, self.young = self.young, {}
        short = [w for w in words if len(w) <= LONG_WORD]
        long = [w for w in words if LONG_WORD < len(w) <= RECURSIVE_BYTES]
        for word in words:
            if len(word) > RECURSIVE_BYTES:
                ids = self.contract(word)
                body = b"".join([self.token[i] for i in ids])
                self.young[word] = (np.array(ids, np.int32).tobytes(), word if body == word else body)
        for group, query in ((short, _ONE), (long, _ALL)):
            batch, size = [], 0
            for w in group:
                if batch and size + len(w) > BATCH_BYTES:
                    self._run(batch, query)
                    batch, size = [], 0
                batch.append(w)
                size += len(w)
            if batch:
                self._run(batch, query)

    def contract(self, word: bytes) -> list[int]:
        """Ids of a word: the leftmost pair of minimum rank merges until there is none."""
        token, ranks = self.token, self.ranks
        ids = [int(self.byte_rank[b]) for b in word]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        last = len(ids)

        def rank(i):
            j = after[i]
            return None if j >= last else ranks.get(token[ids[i]] + token[ids[j]])

        heap = [(r, i) for i in range(last) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank(i) != r:       # one side has merged since
                continue
            gone = after[i]
            ids[i], ids[gone], after[i] = r, -1, after[gone]
            if after[i] < last:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (new := rank(k)) is not None:
                    heapq.heappush(heap, (new, k))
        return [x for x in ids if x >= 0]

    def _run(self, batch: list[bytes], query: str) -> None:
        data = np.frombuffer(b"".join(batch), np.uint8)
        lens = np.array([len(w) for w in batch], np.int64)
        ends = np.cumsum(lens)
        tok = self.byte_rank[data]
        nxt = np.append(tok[1:], np.int32(-1))
        nxt[ends - 1] = -1
        pos = (np.arange(len(data)) - np.repeat(ends - lens, lens)).astype(np.int32)
        start = pa.table({"wid": np.repeat(np.arange(len(batch), dtype=np.int32), lens), "pos": pos, "tok": tok,
                          "nxt": pa.array(nxt, mask=nxt < 0), "npos": pos + np.int32(1)})
        done = []
        while start.num_rows:
            self.con.register("start", start)
            state = self.con.sql(query, params={"steps": STEPS}).to_arrow_table()
            self.con.unregister("start")
            if state.column("rank").null_count == state.num_rows:
                done.append(state.select(["wid", "pos", "tok"]))
                break
            self.con.register("state_now", state)
            open_words = "SELECT DISTINCT wid FROM state_now WHERE rank IS NOT NULL"
            done.append(self.con.sql(
                f"SELECT wid, pos, tok FROM state_now WHERE wid NOT IN ({open_words})").to_arrow_table())
            start = self.con.sql(
                f"SELECT wid, pos, tok, nxt, npos FROM state_now WHERE wid IN ({open_words})").to_arrow_table()
            self.con.unregister("state_now")
        final = pa.concat_tables(done)
        self.con.register("final", final)
        words = self.con.sql(_WORDS).to_arrow_table()
        self.con.unregister("final")
        ids = words.column("ids").combine_chunks().values.to_numpy().astype(np.int32)
        decoded = bytes.fromhex(words.column("hex")[0].as_py())
        upto = np.cumsum(np.bincount(final.column("wid").to_numpy(), minlength=len(batch)))
        sizes = np.append(0, np.cumsum(self.token_bytes[ids]))[upto].tolist()
        flat, i, j = ids.tobytes(), 0, 0
        for word, n, size in zip(batch, (upto * 4).tolist(), sizes, strict=True):
            body = decoded[j:size]
            self.young[word] = (flat[i:n], word if body == word else body)
            i, j = n, size


def _encoder(path: str) -> Encoder:
    return worker_state(("bpe_duckdb", path), lambda: Encoder(path))


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point for the split pattern: 1 letter, 2 number, 3 white space, 0 other."""
    import regex

    out = np.zeros(0x110000, np.uint8)
    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\x00" for c in range(0x110000))
    for kind, prop in ((1, r"\p{L}"), (2, r"\p{N}"), (3, r"\p{White_Space}")):
        for m in regex.finditer(prop + "+", every):
            out[m.start():m.end()] = kind
    return out


_SHORT = np.frombuffer(b"stmd", np.uint8).astype(np.uint32)
_LONG = ((ord("r"), ord("e")), (ord("v"), ord("e")), (ord("l"), ord("l")))


def split_starts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Byte positions at which the matches of the split pattern begin, for all
    texts of a slice at once.

    The pattern is 's|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?other+|space+(?!nonspace)|space+:
    runs of one class, a blank joined to the run after it, the last white space
    of a longer run cut off before a run, and contractions after an apostrophe."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    if len(at) == 0:
        return at
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(codes)
    kind = _classes()[codes]
    edge = np.zeros(n + 1, bool)
    edge[np.searchsorted(at, offs)] = True
    edge[n] = True
    start = np.empty(n, bool)
    start[0] = True
    start[1:] = kind[1:] != kind[:-1]
    start |= edge[:n]
    firsts = np.flatnonzero(start)
    lasts = np.append(firsts[1:], n) - 1
    white = (kind[firsts] == 3) & ~edge[lasts + 1]
    last = lasts[white]
    start[last] = True
    start[last[codes[last] == 32] + 1] = False
    quote = np.flatnonzero((codes == 39) & start)
    quote = quote[quote + 1 < n]
    quote = quote[~edge[quote + 1]]
    if len(quote):
        one = codes[quote + 1]
        two = np.where((quote + 2 < n) & ~edge[np.minimum(quote + 2, n)], codes[np.minimum(quote + 2, n - 1)], 0)
        length = np.where(np.isin(one, _SHORT), 1, 0)
        for a, b in _LONG:
            length[(one == a) & (two == b)] = 2
        quote, length = quote[length > 0], length[length > 0]
        start[quote + 1] = False
        after = quote + 1 + length
        start[after[after < n]] = True
    return at[start]


def _pieces(column, encoder: Encoder):
    """Per slice: (first row, end row, list of (ids, decoded) of the distinct
    matches, index of each match among them, first match of each text)."""
    for lo, hi, data, offs in text_slices(column):
        starts = split_starts(data, offs)
        ends = np.append(starts[1:], len(data))
        _, first, which = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        yield lo, hi, encoder.lookup(words), which, np.searchsorted(starts, offs)


def _gather(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Concatenate flat[begin[w]:begin[w] + size[w]] for w in which."""
    lens = size[which]
    total = np.cumsum(lens)
    if len(total) == 0:
        return flat[:0]
    return flat[np.arange(total[-1]) + np.repeat(begin[which] - (total - lens), lens)]


def _encode_batches(path: str, key_type: pa.DataType):
    def run(batches):
        encoder = _encoder(path)
        for batch in batches:
            keys, texts = batch.column(0), strings(batch.column(1))
            for lo, hi, pieces, which, first in _pieces(texts, encoder):
                sizes = np.array([len(p[0]) // 4 for p in pieces], np.int64)
                ids = np.frombuffer(b"".join([p[0] for p in pieces]), np.int32)
                values = _gather(ids, np.cumsum(sizes) - sizes, sizes, which)
                upto = np.append(0, np.cumsum(sizes[which]))[first]
                sizes = np.array([len(p[1]) for p in pieces], np.int64)
                ends = np.append(0, np.cumsum(sizes[which]))[first].astype(np.int32)
                body = pa.array([p[1] for p in pieces], pa.binary()).take(pa.array(which)).buffers()[2]
                bodies = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(ends), body or pa.py_buffer(b"")])
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(lo, hi - lo).cast(key_type),
                     pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(values, pa.int32())),
                     bodies], ["doc_id", "ids", "decoded"])

    return run


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids array<int>, decoded binary (the bytes that the ids stand for)."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        _encode_batches(path, pa.int64()), "doc_id long, ids array<int>, decoded binary")


def _decode_batches(path: str):
    def run(batches):
        encoder = _encoder(path)
        con = encoder.con
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = pa.table({"row": pa.array(range(lo, min(lo + 64, batch.num_rows)), pa.int64()),
                                 "ids": batch.column(1).slice(lo, 64)})
                con.register("part", part)
                got = dict(con.execute(
                    "SELECT row, string_agg(v.hex, '' ORDER BY pos) FROM (SELECT row, unnest(ids) AS id,"
                    " generate_subscripts(ids, 1) AS pos FROM part) JOIN vocabulary v USING (id) GROUP BY row").fetchall())
                con.unregister("part")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, 64),
                     pa.array([bytes.fromhex(got.get(i, "")) for i in range(lo, min(lo + 64, batch.num_rows))], pa.binary())],
                    ["doc_id", "decoded"])

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, decoded binary of a table of doc_id, ids: token rows joined with
    the vocabulary, put together in order.  A null list decodes to no bytes."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode_batches(path), "doc_id long, decoded binary")


def bpe_query(docs: DataFrame, path: str) -> DataFrame:
    """Digest of encoding and decoding: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encode(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))

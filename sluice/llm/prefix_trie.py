"""Conversation prefix trie from sorted sequences and range minima of their common prefixes.

Each conversation is the sequence of its turns.  Sequences are range-partitioned and
sorted; in a chunk, ``lcp[i]`` is the common prefix of neighbours i - 1 and i, and every
distinct prefix of the chunk is a candidate (i, d) with lcp[i] < d <= length of i.  A
sparse table of range minima over lcp lets all candidates binary-search their extents at
once and independently of each other, without a stack: to the right as long as the
minimum is d or more (the members), to the left for d - 1 (the parent).  Candidates in
order of (i, d) are the trie in preorder, so subtree sums are differences of prefix sums.

Chunks are bounded (``CHUNK_TURNS``).  A node that reaches a chunk's edge may go on in
the next one: such pieces (two paths per chunk) are merged by their prefix hash, and
their subtrees summed by a running sum over their global preorder; what hangs below a
piece and is whole goes to it as one sum.  So a prefix of very many conversations is
spread over the chunks that hold them.  Members that end at a node are digested in a
stream, sorted, by a task per sequence (one number per conversation).

Turns are compared by 64-bit hashes of (role, text).  A conversation is one row of 16
bytes a turn.

Null role or text: empty.  Null turn: first.  Ties of turn: by the turn's hash.  Null
conv_id: such rows belong to no conversation and are left out.  Repeated rows: turns of
their own.  Empty table: no rows (not even a root).  Very long texts are hashed in the
scan and not moved.  Other columns are not read, so their names do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _powers, discard, mix, salted_left_join, written

CHUNK_TURNS = 1 << 19
GROUP = 5                # conversations that share the turns of their first one
SHARED = 9               # shared turns: crc32 of the decimal id modulo this
NO_ENDS = hashlib.sha256(b"").hexdigest()

_FIELDS = [("open", pa.bool_()), ("depth", pa.int64()), ("h", pa.int64()), ("parent_h", pa.int64()), ("first_h", pa.int64()),
           ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
           ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("n_bytes", pa.int64()), ("sid", pa.int64()),
           ("begin", pa.int64()), ("stop", pa.int64())]
_SCHEMA = ", ".join(f"{name} {'boolean' if kind == pa.bool_() else 'long'}" for name, kind in _FIELDS)


def _minima(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: level j holds the minimum of 2^j values from each place."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half, last = 1 << (len(table) - 1), table[-1]
        table.append(np.minimum(last[:-half], last[half:]))
    return table


def _range_min(table: list[np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of values lo..hi of each pair."""
    out = np.empty(len(lo), table[0].dtype)
    level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
    for j in np.unique(level):
        at = level == j
        out[at] = np.minimum(table[j][lo[at]], table[j][hi[at] - (1 << j) + 1])
    return out


def extents(lcp_table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last sequence that shares ``depth`` turns with sequence ``at``."""
    n = len(lcp_table[0])
    left, right = at.copy(), at.copy()
    for j in range(len(lcp_table) - 1, -1, -1):
        step, low = 1 << j, lcp_table[j]
        go = np.flatnonzero(right + step < n)
        go = go[low[right[go] + 1] >= depth[go]]
        right[go] += step
        go = np.flatnonzero(left >= step)
        go = go[low[left[go] - step + 1] >= depth[go]]
        left[go] -= step
    return left, right


def _prefix_hashes(turns: np.ndarray, row: np.ndarray, place: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Hash of the sequence up to and with each turn."""
    power = _powers(int(place.max()) + 2 if len(place) else 1)[0]
    total = np.append(np.uint64(0), np.cumsum(mix(turns + np.uint64(1)) * power[place]))
    return mix(total[1:] - total[offs[row]] + mix(place.astype(np.uint64) + np.uint64(1)))


def trie_chunk(turns: np.ndarray, sizes: np.ndarray, offs: np.ndarray, conv: np.ndarray, sid: np.ndarray, place0: int):
    """Nodes of a chunk of sorted sequences (flat turns, offsets): a dict of columns."""
    n, lens = len(conv), np.diff(offs)
    row = np.repeat(np.arange(n), lens)
    k = np.arange(len(turns)) - offs[row]
    same = np.zeros(len(turns), bool)
    may = np.flatnonzero((row > 0) & (k < lens[row - 1]))
    same[may] = turns[may] == turns[offs[row[may] - 1] + k[may]]
    lcp = lens.copy()
    off = np.flatnonzero(~same)[::-1]
    lcp[row[off]] = k[off]               # the first difference of a row is assigned last
    lcp[0] = 0
    hashes = _prefix_hashes(turns, row, k, offs)
    fresh = k >= lcp[row]
    number = np.cumsum(fresh) - 1
    flat = np.flatnonzero(fresh)
    i, d = row[flat], k[flat] + 1
    table = _minima(lcp)
    _, right = extents(table, i, d)
    parent_left, _ = extents(table, i, d - 1)
    inner = d > 1
    parent = np.full(len(flat), -1)
    parent[inner] = number[offs[parent_left[inner]] + d[inner] - 2]
    members = right - i + 1
    least = _range_min(_minima(conv), i, right) if len(flat) else conv[:0]
    is_open = (i == 0) | (right == n - 1)
    own = (members - 1) * sizes[flat]
    children = np.bincount(parent[inner], minlength=len(flat))
    leaf = (children == 0).astype(np.int64)
    last = np.searchsorted(i, right, side="right")
    upto = np.append(0, np.cumsum(own)), np.append(0, np.cumsum(leaf))
    saved, leaves = (t[last] - t[:-1] for t in upto)
    hung = np.flatnonzero(inner & ~is_open)
    hung = hung[is_open[parent[hung]]]   # whole subtrees below a piece
    for out, weights in ((saved, saved[hung]), (leaves, leaves[hung])):
        below = np.zeros(len(flat), np.int64)
        np.add.at(below, parent[hung], weights)
        out[is_open] = below[is_open]
    children = np.where(is_open, np.bincount(parent[hung], minlength=len(flat)), children)
    up = np.where(inner, hashes[np.maximum(flat - 1, 0)].view(np.int64), 0)
    known = inner & ~is_open & ~is_open[parent]
    ends = lens[i] == d
    return {"open": is_open, "depth": d, "h": hashes[flat].view(np.int64), "parent_h": up,
            "first_h": hashes[offs[i]].view(np.int64) if len(flat) else up, "conv_id": least,
            "parent_conv_id": pa.array(least[parent], pa.int64(), mask=~known), "n_convs": members, "n_children": children,
            "n_leaves": leaves, "saved_tokens": saved, "n_bytes": sizes[flat], "sid": pa.array(sid[i], pa.int64(), mask=~ends),
            "begin": place0 + i, "stop": place0 + right}


def _chunks(batches):
    from pyspark import TaskContext

    place = TaskContext.get().partitionId() << 40
    held, n_turns = [], 0

    def out():
        lists = pa.concat_arrays([b.column(1) for b in held])
        offs = lists.offsets.to_numpy().astype(np.int64)
        conv = np.concatenate([b.column(0).to_numpy() for b in held])
        got = trie_chunk(lists.values.to_numpy()[offs[0]:offs[-1]].view(np.uint64),
                         pa.concat_arrays([b.column(2) for b in held]).flatten().to_numpy(), offs - offs[0], conv,
                         np.concatenate([b.column(3).to_numpy() for b in held]), place)
        return pa.RecordBatch.from_arrays([pa.array(got[name], kind) for name, kind in _FIELDS], [f[0] for f in _FIELDS]), len(conv)

    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        n_turns += len(batch.column(1).flatten())
        if n_turns >= CHUNK_TURNS:
            nodes, rows = out()
            yield nodes
            place, held, n_turns = place + rows, [], 0
    if held:
        yield out()[0]


def _digest(batches):
    """(sid, conv_id) in order -> sid, ends_sha256."""
    now, digest, rows = None, None, []

    def out():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string()), strict=True)],
                                          ["sid", "ends_sha256"])

    for batch in batches:
        for sid, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if sid == now:
                digest.update(f",{conv}".encode())
                continue
            if now is not None:
                rows.append((now, digest.hexdigest()))
                if len(rows) >= 10000:
                    yield out()
                    rows = []
            now, digest = sid, hashlib.sha256(str(conv).encode())
    if now is not None:
        rows.append((now, digest.hexdigest()))
        yield out()


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, turns array<long> (hashes), sizes array<long> (bytes of the texts): the
    first h turns of conversation c - c mod GROUP, then the own ones after the first h."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turn = F.struct("turn", F.xxhash64(F.coalesce(F.col("role").cast("string"), F.lit("")), text).alias("t"),
                    F.octet_length(text).cast("long").alias("b"))
    own = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("x"))
    own = written(own.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("own")), "trie-turns")
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(GROUP))
    heads = own.where(base == F.col("conv_id")).select(F.col("conv_id").alias("base"),
                                                       F.slice("own", 1, SHARED - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).cast("int")
    both = own.withColumn("base", base).withColumn("h", h).join(heads, "base", "left")
    rest = F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0)))
    whole = F.when(F.col("head").isNull(), rest).otherwise(F.concat(F.slice("head", F.lit(1), F.col("h")), rest))
    out = both.select("conv_id", whole.alias("x")).select(
        "conv_id", F.transform("x", lambda x: x["t"]).alias("turns"), F.transform("x", lambda x: x["b"]).alias("sizes"))
    done = written(out, "trie-sequences")
    discard(own)
    return done


def _merged(pieces: DataFrame) -> DataFrame:
    """Pieces of nodes at chunk edges -> whole nodes with subtree sums."""
    nodes = pieces.groupBy("depth", "h", "parent_h", "first_h").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("n_bytes").alias("n_bytes"),
        F.max("sid").alias("sid"), F.min("begin").alias("begin"), F.max("stop").alias("stop"))
    nodes = written(nodes, "trie-pieces")
    children = nodes.groupBy(F.col("parent_h").alias("h")).agg(F.count(F.lit(1)).alias("more"))
    nodes = nodes.join(children, "h", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more").withColumn(
        "leaf", F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).withColumn(
        "own", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("n_bytes"))
    # Subtree of a node: the nodes from its first member's place, in preorder, to its last one's.
    zero = F.lit(0).cast("long")
    last = F.lit((1 << 62) - 1).cast("long")
    events = nodes.select("first_h", "h", F.col("begin").alias("at"), "depth", "leaf", "own", F.lit(0).alias("end")).unionByName(
        nodes.select("first_h", "h", F.col("stop").alias("at"), last.alias("depth"), zero.alias("leaf"), zero.alias("own"),
                     F.lit(1).alias("end")))
    order = Window.partitionBy("first_h").orderBy("at", "depth", "h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = events.select("h", "end", "leaf", "own", F.sum("leaf").over(order).alias("l"), F.sum("own").over(order).alias("s"))
    change = lambda c, own: F.sum(F.when(F.col("end") == 1, F.col(c)).otherwise(F.col(own) - F.col(c)))
    sums = sums.groupBy("h").agg(change("l", "leaf").alias("n_leaves"), change("s", "own").alias("saved_tokens"))
    up = nodes.select(F.col("h").alias("parent_h"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.drop("n_leaves", "saved_tokens").join(sums, "h").join(up, "parent_h", "left")


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256 of every node of the trie of a written table of conv_id (unique), turns, sizes."""
    rows = sequences.select("conv_id", "turns", "sizes", F.xxhash64("turns").alias("sid"))
    ordered = rows.repartitionByRange("turns", "conv_id").sortWithinPartitions("turns", "conv_id")
    nodes = written(ordered.mapInArrow(_chunks, _SCHEMA), "trie-nodes")
    merged = written(_merged(nodes.where("open")), "trie-merged")
    whole = nodes.where("NOT open")
    known = whole.where("parent_conv_id IS NOT NULL OR depth = 1")
    above = merged.select(F.col("h").alias("parent_h"), F.col("conv_id").alias("above"))
    hung = salted_left_join(whole.where("parent_conv_id IS NULL AND depth > 1"), above, "parent_h", "h").withColumn(
        "parent_conv_id", F.col("above"))
    names = [*COLUMNS, "sid"]
    every = known.select(*names).unionByName(hung.select(*names)).unionByName(merged.select(*names))
    every = written(every, "trie-all")
    size = sequences.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")).first()
    root = every.where("depth = 1").agg(
        F.count(F.lit(1)).alias("n_children"), F.greatest(F.coalesce(F.sum("n_leaves"), F.lit(0)), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved_tokens")).select(
        F.lit(size["least"]).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"), F.lit(size["n"]).cast("long").alias("n_convs"), "n_children",
        "n_leaves", "saved_tokens", F.xxhash64(F.array().cast("array<bigint>")).alias("sid"))
    if size["n"] == 0:
        root = root.limit(0)
    every = every.withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(size["least"]).cast("long")).otherwise(
        F.col("parent_conv_id"))).unionByName(root)
    ends = rows.select("sid", "conv_id").repartition("sid").sortWithinPartitions("sid", "conv_id").mapInArrow(
        _digest, "sid long, ends_sha256 string")
    none = F.lit(NO_ENDS)
    with_ends = every.where("sid IS NOT NULL").join(ends, "sid", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
    out = every.where("sid IS NULL").withColumn("ends_sha256", none).select(*COLUMNS, "ends_sha256").unionByName(
        with_ends.select(*COLUMNS, "ends_sha256"))
    discard(nodes, merged)
    return out


def trie_query(conversations: DataFrame) -> DataFrame:
    return prefix_trie(rebuilt(conversations.select("conv_id", "turn", "role", "text")))

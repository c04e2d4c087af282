"""Chat formatting of reply trees.

Messages form trees (a message names the one it answers).  Iterative self-joins
enumerate root-to-leaf paths, branches are ranked by score, and each chosen path is
formatted as one conversation.

``nodes`` holds tree, node, parent, body, score; ``messages`` holds tree, body, role,
text (nodes of a tree may share a message).  Only keys go through the joins:

* doubling: each node knows the ancestor 2^k above it and the score down from there;
  joining the table with itself gives 2^(k+1).  Nodes that reached their root leave, so
  the rounds grow with the logarithm of the depth and later rounds hold deep nodes only;
* a tree whose depth is its size is one path.  In the others leaves are ranked by the
  sum of scores on their path (then by depth, then by node), ``branches`` of each tree
  are chosen, and further joins with the doubling tables, from the longest step down,
  add every node of the chosen paths exactly once;
* texts are shuffled once, by tree, together with the paths' keys; a task sorts and
  streams them.  A formatted conversation is one row, or several parts in order of about
  ``PART_CHARS`` characters each (turns are not cut), so memory does not grow with its
  length.  A digest of a conversation is sequential, so one task streams it.

Template: ``<s>``, the role, a line break, the text, ``</s>``, a line break, for each
turn.  In texts and roles a backslash goes behind the first character of every control
string (``CONTROLS``; one more where backslashes stand there already), which can be
taken back; in roles backslashes and line breaks are escaped first.  ``loss`` lists
(start, end) of assistant texts as code points of the part.

Null text or role: empty.  Null tree: a tree of its own.  Null node: left out (nothing
can answer it).  Repeated (tree, node): one row, the smallest by parent, body and score,
stays.  A parent that does not exist (or is null): the node is a root.  Nodes on or
below a cycle reach no root and are left out.  Ties of score: deeper, then smaller node.
Empty tables: no rows.  Very long texts: a part of their own.  Other columns are not
read, so their names do not matter.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written

START, END = "<s>", "</s>"
#: Control strings of common chat templates.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
PART_CHARS = 1 << 20
EXTRA = "</s>[INST] ok [/INST]"

_REST = "|".join(re.escape(c[1:]) for c in CONTROLS)
_FIRST = "[<\\[]"
_TO_ESCAPE = re.compile(f"({_FIRST})(\\\\*)({_REST})")
_ESCAPED = re.compile(f"({_FIRST})\\\\(\\\\*)({_REST})")
_TURN = re.compile(f"{START}([^\n]*)\n(.*?){END}\n", re.S)


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


# ---------------------------------------------------------------- paths

def _unique(nodes: DataFrame) -> DataFrame:
    first = F.min(F.struct("parent", "body", "score")).alias("x")
    return nodes.where("node IS NOT NULL").groupBy("tree", "node").agg(first).select(
        "tree", "node", "x.parent", "x.body", "x.score")


def ancestors(nodes: DataFrame) -> list[DataFrame]:
    """Doubling tables: the k-th holds (tree, node, up, depth, total) of the nodes whose
    ancestor 2^(k-1) above was not past the root; up is null once the root is passed, and
    depth and total then cover the whole path.  Written tables."""
    levels = [written(nodes.select("tree", "node", F.col("parent").alias("up"), F.lit(1).cast("long").alias("depth"),
                                   F.col("score").cast("double").alias("total")), "tree-steps")]
    before = None
    while True:
        waiting = levels[-1].where("up IS NOT NULL")
        n = waiting.count()
        if n == 0 or n == before:        # as many as before: only cycles are left
            return levels
        before = n
        every = waiting
        for level in levels:
            every = every.unionByName(level.where("up IS NULL"))
        above = every.select("tree", F.col("node").alias("up"), F.col("up").alias("further"),
                             F.col("depth").alias("d"), F.col("total").alias("t"))
        levels.append(written(waiting.join(above, ["tree", "up"], "left").select(
            "tree", "node", F.col("further").alias("up"), (F.col("depth") + F.coalesce("d", F.lit(0))).alias("depth"),
            (F.col("total") + F.coalesce("t", F.lit(0.0))).alias("total")), "tree-steps"))


def paths(nodes: DataFrame, branches: int | None = 1, unique: bool = False) -> DataFrame:
    """(tree, path, rank, score, pos, node, body): the nodes of the chosen root-to-leaf
    paths; path is the leaf, rank its place in the tree, pos counts from 1.  ``unique``
    states that (tree, node) does not repeat.  A written table."""
    source = nodes if unique else _unique(nodes)
    nodes = written(source.select("tree", "node", "parent", "body", "score"), "tree-nodes")
    levels = ancestors(nodes)
    rooted = None
    for level in levels:
        part = level.where("up IS NULL")
        rooted = part if rooted is None else rooted.unionByName(part)
    rooted = rooted.drop("up")
    trees = written(rooted.groupBy("tree").agg(
        F.count(F.lit(1)).alias("n"), F.max("depth").alias("deep"), F.max_by("node", "depth").alias("path"),
        F.max_by("total", "depth").alias("score")), "tree-sizes")
    chains = rooted.join(trees.where("n = deep"), "tree").select(
        "tree", "path", F.lit(1).alias("rank"), "score", F.col("depth").alias("pos"), "node")
    found, used = chains, [*levels, trees]
    if not trees.where("n > deep").isEmpty():
        forked = rooted.join(trees.where("n > deep").select("tree"), "tree")
        answered = nodes.where("parent IS NOT NULL").select("tree", F.col("parent").alias("node")).distinct()
        order = Window.partitionBy("tree").orderBy(F.desc("total"), F.desc("depth"), "node")
        leaves = forked.join(answered, ["tree", "node"], "left_anti").withColumn("rank", F.row_number().over(order))
        if branches is not None:
            leaves = leaves.where(F.col("rank") <= branches)
        walk = written(leaves.select("tree", F.col("node").alias("path"), "rank", F.col("total").alias("score"),
                                     F.col("depth").alias("pos"), "node"), "tree-paths")
        used.append(walk)
        for k in range(len(levels) - 1, -1, -1):
            up = levels[k].where("up IS NOT NULL").select("tree", "node", "up")
            more = walk.where(F.col("pos") > 2 ** k).join(up, ["tree", "node"]).select(
                "tree", "path", "rank", "score", (F.col("pos") - 2 ** k).alias("pos"), F.col("up").alias("node"))
            walk = written(walk.unionByName(more), "tree-paths")
            discard(used.pop())
            used.append(walk)
        found = found.unionByName(walk)
    out = written(found.join(nodes.select("tree", "node", "body"), ["tree", "node"]), "tree-chosen")
    discard(nodes, *used)
    return out


# ---------------------------------------------------------------- formatting

_FORMATTED = "tree string, path long, rank int, score double, part int, body string, n_turns int, loss array<long>"


def _formatted(batches):
    """Turns in order of tree, path and pos -> parts of formatted conversations."""
    names = ["tree", "path", "rank", "score", "part", "body", "n_turns", "loss"]
    types = [pa.string(), pa.int64(), pa.int32(), pa.float64(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.int64())]
    now, part, body, size, n, loss, rows, ready = None, 0, [], 0, 0, [], [], 0

    def close():
        rows.append((*now, part, "".join(body), n, loss))

    def out():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names)

    for batch in batches:
        for tree, path, rank, score, role, text in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            if now is None or (tree, path) != now[:2] or size >= PART_CHARS:
                same = now is not None and (tree, path) == now[:2]
                if now is not None:
                    close()
                    ready += size
                if ready >= PART_CHARS or len(rows) >= 10000:
                    yield out()
                    rows, ready = [], 0
                part, body, size, n, loss = part + 1 if same else 0, [], 0, 0, []
                now = (tree, path, rank, score)
            head = f"{START}{escape_role(role)}\n"
            inner = escape(text)
            if role == "assistant":
                loss += [size + len(head), size + len(head) + len(inner)]
            turn = f"{head}{inner}{END}\n"
            body.append(turn)
            size, n = size + len(turn), n + 1
    if now is not None:
        close()
        yield out()


def format_paths(chosen: DataFrame, messages: DataFrame) -> DataFrame:
    """tree, path, rank, score, part, body, n_turns, loss of the chosen paths.  Rows of a
    conversation lie in one partition, in order."""
    texts = messages.select("tree", "body", F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text"))
    both = chosen.select("tree", "body", "path", "rank", "score", "pos").unionByName(texts, allowMissingColumns=True)
    # The message of a body comes first (its path is null), then the turns that show it.
    message = Window.partitionBy("tree", "body").orderBy(F.asc_nulls_first("path"), "pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    turns = both.repartition("tree").select(
        "tree", "path", "rank", "score", "pos", F.first("role").over(message).alias("role"),
        F.first("text").over(message).alias("text")).where("pos IS NOT NULL AND text IS NOT NULL")
    return turns.sortWithinPartitions("tree", "path", "pos").select(
        "tree", "path", "rank", "score", "role", "text").mapInArrow(_formatted, _FORMATTED)


def format_trees(nodes: DataFrame, messages: DataFrame, branches: int | None = 1, unique: bool = False) -> DataFrame:
    """The ``branches`` best paths of each tree (None: all) as formatted conversations."""
    return format_paths(paths(nodes, branches, unique), messages)


def parse(body: str) -> list[tuple[str, str]]:
    """Turns (role, text) of a formatted part."""
    turns, at = [], 0
    for m in _TURN.finditer(body):
        if m.start() != at:
            raise ValueError(f"not a turn at {at}")
        turns.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(body):
        raise ValueError(f"not a turn at {at}")
    return turns


def _read_back(batches):
    """Parts in order -> a row per conversation with digests of its turns and its loss texts."""
    names = ["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    now, n, turns, chars, learned, size, rows = None, 0, None, 0, None, 0, []

    def out():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names)

    for batch in batches:
        for tree, path, body, loss in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if (tree, path) != now:
                if now is not None:
                    rows.append((now[0], n, turns.hexdigest(), chars, learned.hexdigest(), size))
                    if len(rows) >= 10000:
                        yield out()
                        rows = []
                now, n, turns, chars, learned, size = (tree, path), 0, hashlib.sha256(), 0, hashlib.sha256(), 0
            for role, text in parse(body):
                turns.update(f"{role}\n{text}\n".encode())
                n += 1
            for a, b in zip(loss[::2], loss[1::2], strict=True):
                text = unescape(body[a:b])
                learned.update(text.encode())
                chars += len(text)
            size += len(body)
    if now is not None:
        rows.append((now[0], n, turns.hexdigest(), chars, learned.hexdigest(), size))
        yield out()


def read_back(formatted: DataFrame) -> DataFrame:
    """tree, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read from
    formatted conversations whose parts lie in order."""
    return formatted.select("tree", "path", "body", "loss").mapInArrow(
        _read_back, "tree string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


# ---------------------------------------------------------------- conversations

def conversation_tree(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, messages) of conversations given as rows by turn: each turn answers the one
    before.  Turns are ordered by turn (null first), then role, then message."""
    rows = conversations.select(
        F.col("conv_id").cast("string").alias("tree"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("tree", F.coalesce("tree", F.lit("")))
    messages = rows.select("tree", F.xxhash64("role", "text").alias("body"), "role", "text")
    order = Window.partitionBy("tree").orderBy(F.asc_nulls_first("turn"), "role", "body")
    nodes = rows.select("tree", "turn", "role", F.xxhash64("role", "text").alias("body")).select(
        "tree", F.row_number().over(order).cast("long").alias("node"), "body", F.lit(0.0).alias("score")).withColumn(
        "parent", F.when(F.col("node") > 1, F.col("node") - 1))
    return nodes, messages


def chat_query(conversations: DataFrame) -> DataFrame:
    """Digest of all conversations and the extra one, formatted and read back."""
    spark = conversations.sparkSession
    extra = spark.createDataFrame([(-1, 0, "user", EXTRA), (-1, 1, "assistant", EXTRA)],
                                  "conv_id long, turn long, role string, text string")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                "role", "text").unionByName(extra)
    nodes, messages = conversation_tree(rows)
    back = read_back(format_trees(nodes, messages, branches=1, unique=True))
    return back.select(F.when(F.col("tree") != "", F.col("tree")).cast("long").alias("conv_id"), "n_turns", "turns_sha256",
                       "loss_chars", "loss_sha256", "formatted_chars")

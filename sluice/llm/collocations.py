"""Phrase collocations by broadcast double-array tries.

Texts are lower-cased (A-Z only), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and the
pieces into words ``[^\\x20\\x09]+``.  Everything is counted per language (null: ``und``).
A phrase of two or three words that occurs ``min_count`` times or more is a candidate;
its score is the least, over its cuts into two parts, of floor(10^6 a^2 / (l r)).

Counting goes level by level, Apriori-safe: a phrase can only be frequent if its parts
are.  Words are counted first; the frequent ones get numbers, and texts are written once
as number sequences (-1 between pieces and for other words).  For each longer length:

* a filter finds the candidates: tasks send the distinct phrases of their chunk, which
  start with a frequent phrase, with occurrences that saturate at ``min_count`` (one
  byte), packed by bucket; phrases whose sum reaches ``min_count`` are candidates;
* candidates are dealt by hash into shards of ``TRIE_PHRASES`` on average; a shard
  becomes a double-array trie over the bytes of the word numbers, broadcast;
* a pass over the sequences starts one state at every position and advances all states
  of a chunk together, level by level (``state = base[state] + byte``, alive while
  ``check`` names the parent); accepting states are counted per task and the tasks'
  counts summed.

What is broadcast is bounded: ``VOCABULARY`` hashes (numbering goes over the texts once
per shard of the vocabulary) and ``TRIE_PHRASES`` phrases a trie.  Work grows with the
occurrences; no pair of all words is formed.

Null text: no words.  Null lang counts as ``und``.  doc_id is not read; repeated rows
count each time.  Empty table or no candidates: no rows.  Very long texts make a slice
of their own; a text may be one word or one piece of any length.  Ties of score, then of
a, go by phrase.  Other columns are not read, so their names do not matter.  Words are
told apart by 64-bit hashes while they are numbered.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, discard, hash_spans, mix, text_slices, written

MIN_COUNT = 10
TOP = 2000
COVER_PERCENT = 50           # a longer candidate with this share of the occurrences covers a phrase
VOCABULARY = 8_000_000       # words numbered in one pass (64 MB of hashes)
TRIE_PHRASES = 1_000_000     # phrases of one trie, on average
CHUNK = 2 << 20              # phrases a task combines at a time
HELD_WORDS = 1 << 18         # distinct words a task combines at a time
BUCKETS = 8                  # buckets of the candidate filter per shuffle partition
BLOCK = 1 << 16              # phrases of a trie whose counts meet in one row

_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2


def words_of(data: np.ndarray, offs: np.ndarray):
    """(starts, ends, text of each word, whether the word goes on a piece begun before)."""
    none = np.zeros(0, np.int64)
    if len(data) == 0:
        return none, none, none, none.astype(bool)
    kind = _KIND[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    word = kind == 0
    first = word & edge[:-1]
    first[1:] |= word[1:] & ~word[:-1]
    last = word & edge[1:]
    last[:-1] |= word[:-1] & ~word[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(offs, starts, side="right") - 1
    breaks = np.append(0, np.cumsum(kind == 2))
    joined = np.zeros(len(starts), bool)
    joined[1:] = (breaks[starts[1:]] == breaks[ends[:-1]]) & (text[1:] == text[:-1])
    return starts, ends, text, joined


def _lang_hash(lang: str) -> int:
    body = np.frombuffer(lang.encode(), np.uint8)
    return int(mix(hash_spans(body, np.array([0]), np.array([len(body)])) + np.uint64(77))[0])


def _word_slices(batch, known: dict):
    """Per slice of a batch of (lang, text): lower-cased bytes, word bounds, languages
    (names of the slice, index of each word's) and a hash of (lang, word)."""
    langs = batch.column(0).to_pylist()
    for lo, hi, data, offs in text_slices(batch.column(1)):
        data = LOWER[data]
        starts, ends, text, joined = words_of(data, offs)
        names = ["und" if x is None else x for x in langs[lo:hi]]
        for x in names:
            if x not in known:
                known[x] = _lang_hash(x)
        salt = np.array([known[x] for x in names], np.uint64)
        hashes = mix(hash_spans(data, starts, ends) ^ salt[text])
        yield data, starts, ends, names, text, joined, hashes


def _count_words(batches):
    """(lang, word, h, n) of the words of a task, combined in parts of HELD_WORDS."""
    known, held = {}, {}
    names = ["lang", "word", "h", "n"]

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([v[0] for v in held.values()]), pa.array([v[1] for v in held.values()]),
             pa.array(np.fromiter(held, np.uint64, len(held)).view(np.int64)),
             pa.array([v[2] for v in held.values()], pa.int64())], names)

    for batch in batches:
        for data, starts, ends, langs, text, _, hashes in _word_slices(batch, known):
            keys, first, n = np.unique(hashes, return_index=True, return_counts=True)
            raw = data.tobytes()
            for key, i, c in zip(keys.tolist(), first.tolist(), n.tolist(), strict=True):
                entry = held.get(key)
                if entry is None:
                    held[key] = [langs[text[i]], raw[starts[i]:ends[i]].decode(), c]
                else:
                    entry[2] += c
            if len(held) >= HELD_WORDS:
                yield out()
                held.clear()
    if held:
        yield out()


def count_words(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, word, h (hash of both), n occurrences."""
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_count_words, "lang string, word string, h long, n long").groupBy("lang", "word", "h").agg(
        F.sum("n").alias("n"))


def _number(shard, offset: int, n_shards: int, index: int, carry: bool):
    """Texts -> number sequences; words of other shards keep what they have."""

    def run(batches):
        known, vocabulary = {}, shard.value
        for batch in batches:
            before = batch.column(2).to_pylist() if n_shards > 1 else None
            row = 0
            for data, starts, _, langs, text, joined, hashes in _word_slices(batch, known):
                at = np.minimum(np.searchsorted(vocabulary, hashes), max(len(vocabulary) - 1, 0))
                found = vocabulary[at] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
                ids = np.where(found, at + offset, -1).astype(np.int32)
                if n_shards > 1:
                    old = [np.frombuffer(b, np.int32) for b in before[row:row + len(langs)]]
                    old = np.concatenate(old) if old else ids
                    ids = np.where(hashes.view(np.int64) % n_shards == index, ids, old if len(old) else ids)
                    row += len(langs)
                if carry:
                    cut = np.searchsorted(text, np.arange(len(langs) + 1))
                    done = row - len(langs)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(done, len(langs)), batch.column(1).slice(done, len(langs)),
                         pa.array([ids[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())],
                        ["lang", "text", "ids"])
                else:
                    # -1 before a word that begins a piece; runs of -1 shrink to one.
                    flat = np.insert(ids, np.flatnonzero(~joined), -1)
                    keep = np.ones(len(flat), bool)
                    keep[1:] = (flat[1:] >= 0) | (flat[:-1] >= 0)
                    yield pa.RecordBatch.from_arrays([pa.array([flat[keep].tobytes()], pa.binary())], ["ids"])

    return run


def sequences(docs: DataFrame, shards: Sequence[np.ndarray], lang: str = "lang", text: str = "text") -> DataFrame:
    """Texts as number sequences (one binary of 32-bit numbers per slice of texts).
    Shard i holds the sorted hashes with ``hash mod number of shards = i`` (as signed numbers)."""
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    if len(shards) > 1:
        empty = lambda batches: (pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([b""] * b.num_rows, pa.binary())], ["lang", "text", "ids"]) for b in batches)
        rows = rows.mapInArrow(empty, "lang string, text string, ids binary")
    offset, old = 0, None
    for i, hashes in enumerate(shards):
        carry = i + 1 < len(shards)
        run = _number(context.broadcast(hashes), offset, len(shards), i, carry)
        rows = written(rows.mapInArrow(run, "lang string, text string, ids binary" if carry else "ids binary"),
                       "phrase-sequences")
        if old is not None:
            discard(old)
        old, offset = rows, offset + len(hashes)
    return rows


def _packed(keys: np.ndarray, n_buckets: int, least: int):
    """(kind 1, bucket, body) rows of distinct phrase keys and their saturated occurrences."""
    keys, times = np.unique(keys, return_counts=True)
    times = np.minimum(times, least).astype(np.uint8)
    bucket = (mix(keys) % np.uint64(n_buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    keys, times, bucket = keys[order], times[order], bucket[order]
    heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    tails = np.append(heads, len(keys))[1:]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ones(len(heads), np.int32)), pa.array(bucket[heads]),
         pa.array([keys[a:b].tobytes() + times[a:b].tobytes() for a, b in zip(heads, tails, strict=True)], pa.binary())],
        ["kind", "bucket", "body"])


class _Filter:
    """Collects phrase keys of a task and hands them out packed."""

    def __init__(self, n_buckets: int, least: int):
        self.n_buckets, self.least, self.keys, self.held = n_buckets, least, [], 0

    def add(self, keys: np.ndarray):
        self.keys.append(keys)
        self.held += len(keys)
        return self.held >= CHUNK

    def out(self):
        keys = np.concatenate(self.keys) if self.keys else np.zeros(0, np.uint64)
        self.keys, self.held = [], 0
        return _packed(keys, self.n_buckets, self.least)


def _pair_filter(n_buckets: int, least: int):
    def run(batches):
        held = _Filter(n_buckets, least)
        for batch in batches:
            for body in batch.column(0).to_pylist():
                ids = np.frombuffer(body, np.int32)
                a, b = ids[:-1], ids[1:]
                both = (a >= 0) & (b >= 0)
                if held.add(a[both].astype(np.uint64) << np.uint64(32) | b[both].astype(np.uint64)):
                    yield held.out()
        yield held.out()

    return run


def _sum_filter(least: int):
    """Rows in order of bucket -> keys whose occurrences reach ``least``; one bucket at a time."""

    def heads(bodies):
        n = [len(b) // 9 for b in bodies]
        keys = np.concatenate([np.frombuffer(b, np.uint64, k) for b, k in zip(bodies, n, strict=True)])
        times = np.concatenate([np.frombuffer(b, np.uint8, k, 8 * k) for b, k in zip(bodies, n, strict=True)])
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order].astype(np.int64)
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        total = np.add.reduceat(times, first) if len(first) else times
        return pa.RecordBatch.from_arrays([pa.array(keys[first][total >= least].view(np.int64))], ["key"])

    def run(batches):
        held, now = [], None
        for batch in batches:
            for bucket, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket != now and held:
                    yield heads(held)
                    held = []
                now = bucket
                held.append(body)
        if held:
            yield heads(held)

    return run


def _candidates(packed: DataFrame, parts: int, least: int) -> DataFrame:
    rows = packed.where("kind = 1").select("bucket", "body")
    return rows.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_sum_filter(least), "key long")


class Trie:
    """Double-array trie of phrases of equal length, as byte strings of their numbers.

    Accepting states have no children, so their ``base`` holds the phrase's place among
    the sorted ``phrases`` (which are not sent with the trie).  Nodes of many children get a window
    of their own, others are tried at random places in rounds, the only children fill
    the holes."""

    ROOT = 0

    def __init__(self, phrases: np.ndarray, width: int):
        self.width, self.words = width, phrases.shape[1]
        phrases = phrases[np.lexsort(phrases.T[::-1])]
        self.phrases = phrases.astype(np.int32)
        shifts = [8 * (width - 1 - b) for b in range(width)]
        digits = np.stack([(phrases[:, w] >> s) & 255 for w in range(self.words) for s in shifts], axis=1).astype(np.int64)
        m, depth = digits.shape
        differs = digits[1:] != digits[:-1]
        branch = np.append(0, np.where(differs.any(axis=1), differs.argmax(axis=1), depth)) if m else np.zeros(0, np.int64)
        self.base, self.check = np.zeros(1024, np.int32), np.full(1024, -1, np.int32)
        self.used, self.end = np.zeros(1024, bool), 1
        self.used[0] = True
        self.random = np.random.default_rng(7)
        state = np.zeros(m, np.int64)
        for level in range(depth):
            heads = np.flatnonzero(branch <= level)
            if len(heads) == 0:
                break
            parent, symbol = state[heads], digits[heads, level]
            group = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
            cells = self._place(symbol, group, np.diff(np.append(group, len(heads)))) + symbol
            self.base[parent] = cells - symbol
            self.check[cells] = parent
            state = np.repeat(cells, np.diff(np.append(heads, m)))
        size = self.end + 256
        self._grow(size)
        self.base, self.check = self.base[:size].copy(), self.check[:size].copy()
        self.base[state] = np.arange(m)
        del self.used, self.random

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "phrases"} | {"n": len(self.phrases)}

    def _grow(self, size: int) -> None:
        if size > len(self.used):
            more = max(size, 2 * len(self.used)) - len(self.used)
            self.base = np.append(self.base, np.zeros(more, np.int32))
            self.check = np.append(self.check, np.full(more, -1, np.int32))
            self.used = np.append(self.used, np.zeros(more, bool))

    def _place(self, symbol: np.ndarray, group: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Base of each child's parent, such that all children lie on free cells."""
        base = np.zeros(len(group), np.int64)
        wide = np.flatnonzero(size >= 32)
        base[wide] = self.end + 256 * np.arange(len(wide))
        self._grow(self.end + 256 * (len(wide) + 2))
        self.end += 256 * len(wide)
        which = np.repeat(np.arange(len(group)), size)
        mine = np.isin(which, wide) if len(wide) else np.zeros(len(which), bool)
        self.used[base[which[mine]] + symbol[mine]] = True
        for low, high, room in ((8, 32, 8), (2, 8, 3)):
            todo = np.flatnonzero((size >= low) & (size < high))
            todo = todo[np.argsort(-size[todo], kind="stable")]
            floor = self.end if low == 8 else 1
            tries = 0
            while len(todo):
                if tries % 8 == 0:
                    self.end += int(room * size[todo].sum()) + 256
                    self._grow(self.end + 512)
                tries += 1
                spot = self.random.integers(floor, self.end, len(todo))
                index = np.repeat(group[todo], size[todo]) + (
                    np.arange(size[todo].sum()) - np.repeat(np.cumsum(size[todo]) - size[todo], size[todo]))
                cells = np.repeat(spot, size[todo]) + symbol[index]
                # Of several nodes that want a cell the first one in this order may have it.
                _, first = np.unique(cells, return_index=True)
                good = np.zeros(len(cells), bool)
                good[first] = True
                good &= ~self.used[cells]
                starts = np.cumsum(size[todo]) - size[todo]
                fits = np.logical_and.reduceat(good, starts)
                self.used[cells[np.repeat(fits, size[todo])]] = True
                base[todo[fits]] = spot[fits]
                todo = todo[~fits]
            self.end += 256          # the last children may lie beyond the places tried
            self._grow(self.end + 512)
        only = np.flatnonzero(size == 1)
        if len(only):
            free = np.flatnonzero(~self.used[256:self.end + 256])[:len(only)] + 256
            if len(free) < len(only):
                more = np.arange(self.end + 256, self.end + 256 + len(only) - len(free))
                free = np.append(free, more)
            self._grow(int(free[-1]) + 512)
            self.used[free] = True
            base[only] = free - symbol[group[only]]
            self.end = max(self.end, int(free[-1]) + 1)
        return base[which]

    def walk(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, places in ``phrases``) of all phrases that begin at a position of the sequence."""
        k = self.words
        if len(ids) < k:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        alive = ids[:len(ids) - k + 1] >= 0
        for w in range(1, k):
            alive &= ids[w:len(ids) - k + 1 + w] >= 0
        at = np.flatnonzero(alive)
        state = np.zeros(len(at), np.int32)
        for w in range(k):
            word = ids[at + w]
            for b in range(self.width):
                step = self.base[state] + ((word >> (8 * (self.width - 1 - b))) & 255)
                ok = self.check[step] == state
                at, state, word = at[ok], step[ok], word[ok]
        return at, self.base[state]


def _count_pass(trie_of, first_no: int, extend: bool, n_buckets: int, least: int):
    """Counts of the phrases of one trie as (kind 0, block, body) rows; with ``extend``
    also the phrases one word longer that begin with one of them, as filter rows."""

    def run(batches):
        trie: Trie = trie_of.value
        n = np.zeros(trie.n, np.int64)
        held = _Filter(n_buckets, least)
        for batch in batches:
            for body in batch.column(0).to_pylist():
                ids = np.frombuffer(body, np.int32)
                at, found = trie.walk(ids)
                n += np.bincount(found, minlength=len(n))
                if extend:
                    after = at + trie.words
                    go = after < len(ids)
                    go[go] = ids[after[go]] >= 0
                    keys = (found[go].astype(np.int64) + first_no).astype(np.uint64) << np.uint64(32)
                    if held.add(keys | ids[after[go]].astype(np.uint64)):
                        yield held.out()
        if extend:
            yield held.out()
        rows = [(0, i // BLOCK, n[i:i + BLOCK].tobytes()) for i in range(0, len(n), BLOCK) if n[i:i + BLOCK].any()]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary()), strict=True)],
                ["kind", "bucket", "body"])

    return run


def _sum_counts(phrases_of, first_no: int):
    """Blocks in order -> (no, w1.., n): the tasks' counts of each phrase summed."""

    def out(block, total):
        phrases = phrases_of.value[block * BLOCK:block * BLOCK + len(total)]
        number = first_no + block * BLOCK + np.arange(len(total))
        columns = [phrases[:, i] for i in range(phrases.shape[1])]
        return pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), *[pa.array(c, pa.int32()) for c in columns],
                                           pa.array(total)], ["no", *[f"w{i + 1}" for i in range(len(columns))], "n"])

    def run(batches):
        now, total = None, None
        for batch in batches:
            for block, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if block != now:
                    if now is not None:
                        yield out(now, total)
                    now, total = block, np.zeros(len(body) // 8, np.int64)
                total += np.frombuffer(body, np.int64)
        if now is not None:
            yield out(now, total)

    return run


def count_phrases(texts: DataFrame, candidates: DataFrame, words: int, width: int, extend: bool, n_buckets: int,
                  least: int, phrases: int = TRIE_PHRASES):
    """Counted candidates (no, w1.., n) and, with ``extend``, the filter rows of longer ones.
    ``candidates`` (w1..) is a written table; one trie and one pass over the texts per shard."""
    spark = texts.sparkSession
    names = [f"w{i + 1}" for i in range(words)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_shards = -(-candidates.count() // phrases)
    counted, longer, first_no, raw = [], [], 0, []
    for shard in range(n_shards):
        mine = candidates.where(F.pmod(F.xxhash64(*names), F.lit(n_shards)) == shard).select(*names).toArrow()
        keys = np.stack([mine.column(c).to_numpy().astype(np.int64) for c in names], axis=1)
        if len(keys) == 0:
            continue
        trie = Trie(keys, width)
        trie_of, phrases_of = spark.sparkContext.broadcast(trie), spark.sparkContext.broadcast(trie.phrases)
        passed = written(texts.mapInArrow(_count_pass(trie_of, first_no, extend, n_buckets, least),
                                          "kind int, bucket int, body binary"), "phrase-pass")
        raw.append(passed)
        sums = passed.where("kind = 0").select("bucket", "body").repartition(parts, "bucket").sortWithinPartitions(
            "bucket").mapInArrow(_sum_counts(phrases_of, first_no), "no long, " + ", ".join(f"{c} int" for c in names) + ", n long")
        counted.append(written(sums, "phrase-counts"))
        longer.append(passed)
        first_no += len(keys)
        trie_of.unpersist()
        phrases_of.unpersist()
    return _union(counted), _union(longer), raw


def _union(frames):
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


def _word_numbers(shard, offset: int):
    def run(batches):
        hashes = shard.value
        for batch in batches:
            ids = np.searchsorted(hashes, batch.column(2).to_numpy().view(np.uint64)) + offset
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids.astype(np.int32)),
                                              batch.column(3)], ["lang", "word", "id", "n"])

    return run


#: Exact for counts below 10^13: ``div`` of decimals without places is an integral division.
_WIDE = "cast({} as decimal(13, 0))"
_SCORE = ("cast(cast(1000000 as decimal(7, 0)) * (" + _WIDE.format("{a}") + " * " + _WIDE.format("{a}") + ") div ("
          + _WIDE.format("{l}") + " * " + _WIDE.format("{r}") + ") as bigint)")


def score(a: str, left: str, right: str):
    return F.expr(_SCORE.format(a=a, l=left, r=right))


def _scored(words: DataFrame, pairs: DataFrame, triples: DataFrame | None, cover_percent: int) -> DataFrame:
    """lang, phrase, a, l, r, score of the candidates that no longer one covers."""
    word = lambda i: words.select(F.col("id").alias(f"w{i}"), F.col("word").alias(f"t{i}"),
                                  F.col("n").alias(f"n{i}"), *([F.col("lang")] if i == 1 else []))
    two = pairs.select("w1", "w2", F.col("n").alias("a"))
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    if triples is not None:
        three = triples.select("w1", "w2", "w3", F.col("n").alias("a"))
        covers = three.select("w1", "w2", "a").unionByName(three.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
        two = two.join(covers.groupBy("w1", "w2").agg(F.max("a").alias("longer")), ["w1", "w2"], "left").where(
            F.coalesce(100 * F.col("longer") < cover_percent * F.col("a"), F.lit(True)))
    out = two.join(word(1), "w1").join(word(2), "w2").select(
        "lang", F.concat_ws(" ", "t1", "t2").alias("phrase"), "a", F.col("n1").alias("l"), F.col("n2").alias("r"),
        score("a", "n1", "n2").alias("score"))
    if triples is None:
        return out.select(*columns)
    both = three.join(pairs.select("w1", "w2", F.col("n").alias("n12")), ["w1", "w2"]).join(
        pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("n23")), ["w2", "w3"])
    both = both.join(word(1), "w1").join(word(2), "w2").join(word(3), "w3").withColumn(
        "s1", score("a", "n1", "n23")).withColumn("s2", score("a", "n12", "n3"))
    first = F.col("s1") <= F.col("s2")       # ties go to the cut after fewer words
    return out.select(*columns).unionByName(both.select(
        "lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), "a", F.when(first, F.col("n1")).otherwise(F.col("n12")).alias("l"),
        F.when(first, F.col("n23")).otherwise(F.col("n3")).alias("r"), F.least("s1", "s2").alias("score")))


def mine_phrases(docs: DataFrame, min_count: int = MIN_COUNT, cover_percent: int = COVER_PERCENT, lang: str = "lang",
                 text: str = "text", vocabulary: int = VOCABULARY, trie_phrases: int = TRIE_PHRASES
                 ) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, a, l, r, score of every candidate that stays; lang, n words).  1 <= min_count <= 255."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = written(count_words(docs, lang, text), "phrase-words")
    totals = written(counted.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    frequent = counted.where(F.col("n") >= min_count).select("lang", "word", "h", "n")
    n_shards = max(1, -(-frequent.count() // vocabulary))
    shards, words, offset = [], [], 0
    for i in range(n_shards):
        mine = frequent.where(F.pmod("h", F.lit(n_shards)) == i)
        hashes = np.sort(mine.select("h").toArrow().column("h").to_numpy().astype(np.int64).view(np.uint64))
        shards.append(hashes)
        words.append(mine.mapInArrow(_word_numbers(spark.sparkContext.broadcast(hashes), offset),
                                     "lang string, word string, id int, n long"))
        offset += len(hashes)
    words = written(_union(words), "phrase-vocabulary")
    occurrences = totals.agg(F.sum("n")).first()[0] or 0
    discard(counted)
    width = 3 if offset <= 1 << 24 else 4
    n_buckets = max(BUCKETS * parts, occurrences // (1 << 21))
    texts = sequences(docs, shards, lang, text)

    packed = written(texts.mapInArrow(_pair_filter(n_buckets, min_count), "kind int, bucket int, body binary"), "phrase-filter")
    low = (1 << 32) - 1
    found = written(_candidates(packed, parts, min_count).select(
        F.shiftright("key", 32).cast("int").alias("w1"), F.col("key").bitwiseAND(F.lit(low)).cast("int").alias("w2")),
        "phrase-candidates")
    discard(packed)
    pairs, longer, passes = count_phrases(texts, found, 2, width, True, n_buckets, min_count, trie_phrases)
    triples = None
    if pairs is not None:
        after = _candidates(longer, parts, min_count).select(
            F.shiftright("key", 32).alias("no"), F.col("key").bitwiseAND(F.lit(low)).cast("int").alias("w3"))
        more = written(after.join(pairs.select("no", "w1", "w2"), "no").select("w1", "w2", "w3"), "phrase-candidates")
        discard(found, *passes)
        triples, _, passes = count_phrases(texts, more, 3, width, False, n_buckets, min_count, trie_phrases)
        discard(more, *passes)
    discard(texts)
    if pairs is None:
        return spark.createDataFrame([], "lang string, phrase string, a long, l long, r long, score long"), totals
    scored = written(_scored(words, pairs, triples, cover_percent), "phrase-scores")
    discard(words)
    return scored, totals


def phrase_query(docs: DataFrame, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` candidates."""
    scored, totals = mine_phrases(docs)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""Near-duplicate join on word shingles by parity sketches.

Two texts link when the Jaccard coefficient of their sets of distinct word
shingles is at least ``percent`` / 100.  Sketching XORs token hashes: a token that
both sets hold cancels out, so the sketch of A XOR the sketch of B is the sketch
of their symmetric difference, and

* the number of differing bits of a one-bit-per-token sketch (``signature``), and
* the number of differing blocks when tokens are dealt to blocks by their hash
  and each block keeps the XOR of its tokens' 64-bit hashes

are both lower bounds of |A xor B|.  For linked sets |A xor B| is at most
d = (1 - j) / (1 + j) * (|A| + |B|).  Sizes fall into bands of ratio 1 / j, so
linked sets lie in the same or in neighbouring bands.  Per band sets are cut into
d + 2 + spare blocks, with the largest d of the band and the one above it: linked sets
agree in at least 2 + spare blocks (pigeonhole).  Empty blocks say nothing and are left
out when at most ``spare`` of a set's blocks are empty, else they are kept; so linked sets
share two block values (``key``) or more.  Pairs that do are candidates; the signatures'
Hamming distance drops most of them, exact set intersection decides.

Skew and growth.  Equal sets are one class from the start.  Within a key classes are
not paired with each other: first each meets one of four representatives of the key
(linear in the rows); pairs that met in two keys or more are verified and components
built.  (Of two linked sets that met in fewer, another common key holds three classes or
more and is looked at below.)  A key that then still holds several components and three classes
or more is looked at again, exactly: a task goes over its members' pairs with
``signature``, a parity sketch as long as the set is (so the bound is as sharp for large
sets as for small ones), but emits at most one pair per member, its closest partner in
another component.  Verified pairs join components, refuted ones are remembered; rounds
repeat, for the members of the pairs that a key emitted, until none has one left that may
link.  So no link between components is lost, rows stay linear in the members (per pair of
chunks, for keys beyond ``CHUNK_MEMBERS``), and links inside a component cannot change the result.  Tables are
removed as soon as their last reader is written.

Contracts: null or wordless text: empty set, linked with nothing.  Fewer words
than a shingle: the whole sequence is one token.  Null doc_id: such a row has its
class and component, but never names one (component_id is null if all of it
are null).  Rows that repeat a doc_id with other texts are nodes of their own.
Tokens are compared by 64-bit hashes, classes by a 64-bit hash of the set.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (LOWER, discard, hash_spans, may_be_in, mix, release_state, salted_left_join, strings, sweep, text_slices,
                     word_bounds, written)
from .graph import components

SPARE = 2
CHUNK_KEYS = 1 << 19      # keys a task combines at a time
BUCKETS = 16              # buckets of keys per shuffle partition
CHUNK_MEMBERS = 4000      # members of a key that meet in one task; of larger keys pairs of such chunks
PAIR_WORDS = 1 << 18      # signature words that a task compares at a time


@functools.lru_cache(maxsize=8)
def bands(percent: int) -> np.ndarray:
    """Smallest set size of each band; linked sizes differ by one band at most."""
    low = [1]
    while low[-1] < 1 << 40:
        low.append(max(low[-1] + 1, -(-low[-1] * 100 // percent)))
    return np.array(low, np.int64)


def max_difference(a, b, percent: int):
    """Largest |A xor B| of linked sets of sizes a and b."""
    return (100 - percent) * (a + b) // (100 + percent)


def spare(need: int) -> int:
    """Blocks beyond the d + 2 of the pigeonhole: more than a set's empty blocks, which
    are a few hundredths of all where a block holds three tokens on average."""
    return SPARE + need // 8


def blocks_of_band(band: int, percent: int) -> tuple[int, int]:
    """(blocks, spare ones among them)."""
    low = bands(percent)
    # A pair that only meets here has one set in this band and one in it or the next.
    last = len(low) - 1
    top = int(low[min(band + 1, last)]) - 1 + int(low[min(band + 2, last)]) - 1
    need = int(max_difference(top, 0, percent)) + 2
    return need + spare(need), spare(need)


def shingle_hashes(data: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the lower-cased texts of a slice and, per text,
    the index of its first one."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offs)
    n_words = first[1:] - first[:-1]
    words = hash_spans(data, starts, ends)
    count = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    begin = np.append(0, np.cumsum(count))
    out = np.zeros(begin[-1], np.uint64)
    head = np.arange(begin[-1]) - np.repeat(begin[:-1], count) + np.repeat(first[:-1], count)
    length = np.repeat(np.minimum(n_words, size), count)
    for i in range(size):
        use = i < length
        out[use] = mix(out[use] * np.uint64(0x9E3779B97F4A7C15) + words[head[use] + i] + np.uint64(1))
    return mix(out + length.astype(np.uint64)), begin


def block_keys(tokens: np.ndarray, band: int, percent: int) -> np.ndarray:
    """Keys of the blocks of a set in one band: hash of (band, block, XOR of the block)."""
    n, free = blocks_of_band(band, percent)
    block = (tokens % np.uint64(n)).astype(np.int64)
    value = np.zeros(n, np.uint64)
    order = np.argsort(block, kind="stable")
    at = block[order]
    heads = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    value[at[heads]] = np.bitwise_xor.reduceat(mix(tokens[order] + np.uint64(band + 1)), heads)
    full = np.zeros(n, bool)
    full[at[heads]] = True
    use = np.flatnonzero(full) if n - len(heads) <= free else np.arange(n)
    return mix(value[use] + mix((use + (band << 24)).astype(np.uint64)))


def signature(tokens: np.ndarray) -> bytes:
    """Parity of the tokens per bit, four bits or more a token (a power of two of bits)."""
    bits = 1 << max(8, (4 * len(tokens) - 1).bit_length())
    return np.packbits((np.bincount(((tokens >> np.uint64(20)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
                        ).astype(np.uint8)).tobytes()


def folded(sign: bytes, size: int) -> np.ndarray:
    """A signature cut to ``size`` bytes: halves XORed, as if it had had fewer bits."""
    out = np.frombuffer(sign, np.uint8)
    while len(out) > size:
        out = out[:len(out) // 2] ^ out[len(out) // 2:]
    return out


def class_of(tokens: np.ndarray) -> int | None:
    """Hash of a set (sorted distinct tokens); None if empty."""
    if len(tokens) == 0:
        return None
    total = mix(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(mix(np.array([total])).view(np.int64)[0])


def _sketch(size: int):
    names = ["doc_id", "text_hash", "n_shingles", "cls", "signature"]

    def run(batches):
        release_state()
        for batch in batches:
            ids, hashed, texts = batch.column(0), batch.column(1), strings(batch.column(2))
            for lo, hi, data, offs in text_slices(texts):
                hashes, begin = shingle_hashes(data, offs, size)
                counts, classes, signs = [], [], []
                for i in range(hi - lo):
                    tokens = np.unique(hashes[begin[i]:begin[i + 1]])
                    n = len(tokens)
                    counts.append(n)
                    classes.append(class_of(tokens))
                    signs.append(signature(tokens) if n else None)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), hashed.slice(lo, hi - lo), pa.array(counts, pa.int64()),
                     pa.array(classes, pa.int64()), pa.array(signs, pa.binary())], names)

    return run


def sketches(docs: DataFrame, shingle: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, cls (hash of the set; null if empty), signature."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(text).cast("string")).alias("text_hash"),
                       F.col(text).cast("string").alias("text")).mapInArrow(
        _sketch(shingle), "doc_id long, text_hash long, n_shingles long, cls long, signature binary")


_LOW = np.uint64((1 << 48) - 1)


def _blobs(size: int, percent: int, n_buckets: int):
    """Block keys of the texts, combined per chunk and packed for the shuffle.

    Of each key of a chunk the first class goes on to the key's bucket (6 bytes of
    key, 8 of class); further classes of the chunk are members already and go, with
    that first class as their representative, to any bucket.  A key of very many
    classes so sends one row per chunk to its bucket."""
    names = ["bucket", "dup", "body"]

    def out(keys, cls):
        keys, cls = np.concatenate(keys), np.concatenate(cls)
        order = np.lexsort((cls, keys))
        keys, cls = keys[order], cls[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (cls[1:] != cls[:-1])
        keys, cls = keys[fresh], cls[fresh]
        head = np.ones(len(keys), bool)
        head[1:] = keys[1:] != keys[:-1]
        at = np.maximum.accumulate(np.where(head, np.arange(len(keys)), 0))
        member = ~head
        member[at[~head]] = True      # a first class with further ones is a member, too
        bucket = ((keys >> np.uint64(48)) % np.uint64(n_buckets)).astype(np.int64)
        rows = []
        own, order = bucket[head], np.argsort(bucket[head], kind="stable")
        k, c, own = keys[head][order], cls[head][order], own[order]
        edges = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        low = np.ascontiguousarray(k.view(np.uint8).reshape(-1, 8)[:, :6])
        for i, j in zip(edges.tolist(), [*edges[1:].tolist(), len(k)], strict=True):
            rows.append((int(own[i]), False, low[i:j].tobytes() + c[i:j].tobytes()))
        if member.any():
            key = (keys & _LOW) | (bucket.astype(np.uint64) << np.uint64(48))
            rows.append((int(keys[0] % np.uint64(n_buckets)), True,
                         key[member].tobytes() + cls[member].tobytes() + cls[at][member].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
            zip(*rows), (pa.int32(), pa.bool_(), pa.binary()), strict=True)], names)

    def run(batches):
        release_state()
        low = bands(percent)
        keys, cls, held = [], [], 0
        for batch in batches:
            for lo, hi, data, offs in text_slices(strings(batch.column(0))):
                hashes, begin = shingle_hashes(data, offs, size)
                for i in range(hi - lo):
                    tokens = np.unique(hashes[begin[i]:begin[i + 1]])
                    if len(tokens) == 0:
                        continue
                    band = int(np.searchsorted(low, len(tokens), side="right")) - 1
                    for b in (band - 1, band) if band else (band,):
                        keys.append(block_keys(tokens, b, percent))
                        cls.append(np.full(len(keys[-1]), class_of(tokens), np.int64))
                        held += len(keys[-1])
                if held >= CHUNK_KEYS:
                    yield out(keys, cls)
                    keys, cls, held = [], [], 0
        if held:
            yield out(keys, cls)

    return run


def _meet(batches):
    """Buckets in order -> members (key, cls, rep) of the keys of two classes or more.
    Holds one bucket at a time; rep is one of four of the key's classes."""
    names = ["key", "cls", "rep"]

    def heads(bucket, bodies):
        n = [len(b) // 14 for b in bodies]
        low = np.zeros((sum(n), 8), np.uint8)
        low[:, :6] = np.concatenate([np.frombuffer(b, np.uint8, 6 * k).reshape(-1, 6) for b, k in zip(bodies, n, strict=True)])
        key = low.view(np.uint64).ravel()
        cls = np.concatenate([np.frombuffer(b, np.int64, k, 6 * k) for b, k in zip(bodies, n, strict=True)])
        rank = mix(cls.view(np.uint64) ^ mix(key & np.uint64(3)))
        order = np.lexsort((rank, key))
        key, cls = key[order], cls[order]
        first = np.append(True, key[1:] != key[:-1])
        at = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
        other = ~first & (cls != cls[at])
        use = np.zeros(len(key), bool)
        use[at[other]] = True
        use |= other
        full = key | (np.uint64(bucket) << np.uint64(48))
        return pa.RecordBatch.from_arrays([pa.array(full[use].view(np.int64)), pa.array(cls[use]), pa.array(cls[at][use])], names)

    release_state()
    held, now = [], None
    for batch in batches:
        for bucket, dup, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if bucket != now:
                if held:
                    yield heads(now, held)
                held, now = [], bucket
            if dup:
                three = np.frombuffer(body, np.int64).reshape(3, -1)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in three], names)
            else:
                held.append(body)
    if held:
        yield heads(now, held)


def _sets(size: int):
    def run(batches):
        release_state()
        for batch in batches:
            for lo, hi, data, offs in text_slices(strings(batch.column(1))):
                hashes, begin = shingle_hashes(data, offs, size)
                sets = [np.unique(hashes[begin[i]:begin[i + 1]]) for i in range(hi - lo)]
                ends = np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int32)
                # A doc_id may stand for several texts: only the text of the class counts.
                own = pa.array([class_of(s) for s in sets], pa.int64())
                got = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))], ["cls", "tokens"])
                yield got.filter(pc.equal(got.column(0), own))

    return run


def _verify(percent: int):
    def run(batches):
        release_state()
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            keep = []
            for i in range(batch.num_rows):
                x, y = a[i].values.to_numpy().view(np.uint64), b[i].values.to_numpy().view(np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link, by exact intersection.  A class of very many
    pairs is split by AQE's skew join (its side of ``sets`` is one row)."""
    left = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(_verify(percent), "a long, b long")


def _near(percent: int):
    """(a, b, size and signature of each) -> the pairs whose sizes and signatures allow a link."""

    def run(batches):
        release_state()
        for batch in batches:
            a, b, n, m, x, y = (c.to_pylist() for c in batch.columns)
            keep = []
            for i in range(batch.num_rows):
                size = min(len(x[i]), len(y[i]))
                far = int(np.bitwise_count(folded(x[i], size).view(np.uint64) ^ folded(y[i], size).view(np.uint64)).sum())
                keep.append(100 * min(n[i], m[i]) >= percent * max(n[i], m[i])
                            and (100 + percent) * far <= (100 - percent) * (n[i] + m[i]))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return run


def _closest(percent: int):
    """Members in order of (key, i, j) -> (key, a, b): each member with its closest one of
    another component of the group, of the pairs that may link and are not refuted.  So
    the members of the pairs are all that can link with another component."""

    def pairs(rows):
        label = np.array([r[2] for r in rows])
        if (label == label[0]).all():
            return set()
        cls, n = np.array([r[1] for r in rows]), np.array([r[3] for r in rows])
        size = min(len(r[4]) for r in rows)
        signs = np.stack([folded(r[4], size) for r in rows]).view(np.uint64)
        chunk, (i, j) = np.array([r[6] for r in rows]), rows[0][7:]
        left, right = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        place = {c: k for k, c in enumerate(cls[right].tolist())}
        found = set()

        def closest(mine, others, pick, best):
            for k in np.flatnonzero(best >= 0).tolist():
                x, y = int(cls[mine[k]]), int(cls[others[pick[k]]])
                found.add((min(x, y), max(x, y)))

        # The closest of a left member is known with its slice, that of a right one after all slices.
        over_pick, over_best = np.zeros(len(right), np.int64), np.full(len(right), -1)
        step = max(1, PAIR_WORDS // max(1, len(right) * signs.shape[1]))
        for lo in range(0, len(left) if len(right) else 0, step):
            at = left[lo:lo + step]
            far = np.bitwise_count(signs[at][:, None, :] ^ signs[right][None, :, :]).sum(axis=2, dtype=np.int64)
            a, b = n[at][:, None], n[right][None, :]
            room = (100 - percent) * (a + b) - (100 + percent) * far
            room[(label[at][:, None] == label[right][None, :]) | (100 * np.minimum(a, b) < percent * np.maximum(a, b))] = -1
            for k, x in enumerate(at.tolist()):
                for other in rows[x][5] or ():
                    if other in place:
                        room[k, place[other]] = -1
            closest(at, right, room.argmax(axis=1), room.max(axis=1))
            pick, best = room.argmax(axis=0), room.max(axis=0)
            better = best > over_best
            over_pick[better], over_best[better] = lo + pick[better], best[better]
        closest(right, left, over_pick, over_best)
        return found

    def run(batches):
        release_state()
        held, now = [], None

        def out(rows):
            found = sorted(pairs(rows))
            return pa.RecordBatch.from_arrays([pa.array([rows[0][0]] * len(found), pa.int64()),
                                               *[pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)]], ["key", "a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                group = (row[0], *row[7:])
                if group != now:
                    if held:
                        yield out(held)
                    held, now = [], group
                held.append(row)
        if held:
            yield out(held)

    return run


def _sets_of(pairs: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int, key: str, text: str) -> DataFrame:
    """(cls, tokens) of the classes in the pairs, from one text of each.

    A text is found by doc_id (null: 0) and the hash of the text; equal rows are
    dropped again.  Texts that a filter of the wanted ones excludes are not shuffled."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct().join(
        classes.select("cls", "body.id", "body.text_hash"), "cls")
    body = F.col(text).cast("string")
    bodies = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("id"), F.xxhash64(body).alias("text_hash"),
                         body.alias("text"))
    wanted = written(wanted, "parity-wanted")
    bodies = may_be_in(bodies, wanted, "id", "text_hash").where("_maybe").drop("_maybe")
    found = bodies.join(wanted, ["id", "text_hash"]).select("cls", "text").mapInArrow(
        _sets(shingle), "cls long, tokens array<long>")
    out = written(found.dropDuplicates(["cls"]), "parity-sets")
    discard(wanted)
    return out


def _links(pairs: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int, percent: int, key: str, text: str) -> DataFrame:
    """The pairs whose sets link, as a written table."""
    sets = _sets_of(pairs, classes, docs, shingle, key, text)
    out = written(verified(pairs, sets, percent), "parity-links")
    discard(sets)
    return out


def link_components(docs: DataFrame, shingle: int = 3, percent: int = 90, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), class_id
    (smallest doc_id with an equal set)."""
    rows = written(sketches(docs, shingle, key, text), "parity-sketches")
    sets_of = rows.where("cls IS NOT NULL")
    classes = written(sets_of.groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.min(F.struct(F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash")).alias("body"),
        F.min("n_shingles").alias("n"), F.count(F.lit(1)).alias("copies"), F.min("signature").alias("signature")), "parity-classes")
    whole, rows = rows, written(rows.select("doc_id", "n_shingles", "cls"), "parity-rows")
    discard(whole)

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(
        _blobs(shingle, percent, BUCKETS * parts), "bucket int, dup boolean, body binary").repartition(
        parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_meet, "key long, cls long, rep long")
    members = written(members, "parity-members")
    sweep(docs.sparkSession, [])      # the keys' shuffle files go before the texts are read again

    pair = (F.least("cls", "rep").alias("a"), F.greatest("cls", "rep").alias("b"))
    star = members.where("cls <> rep").groupBy(*pair).agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo <> hi")
    of_a = classes.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa"))
    of_b = classes.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb"))
    star = star.join(of_a, "a").join(of_b, "b").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(
        _near(percent), "a long, b long")
    star = written(star, "parity-star")
    edges = _links(star, classes, docs, shingle, percent, key, text)
    labels = components(edges)
    discard(star)

    # Keys of three classes or more that hold several components.
    label = lambda t: t.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "label", F.coalesce("label", "cls"))
    of = members.select("key", "cls").distinct()
    sizes = label(of).groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("size"))
    chunks = F.ceil(F.col("size") / CHUNK_MEMBERS).cast("int")
    again = of.join(sizes.where("lo <> hi AND size > 2").select("key", chunks.alias("chunks")), "key").withColumn(
        "chunk", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int"))
    # Pairs (i, j) of chunks, i <= j, that a member belongs to; one for all but the largest keys.
    again = written(again.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "key", "cls", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j")).join(
        classes.select("cls", "n", "signature"), "cls"), "parity-open")
    discard(members)
    refuted, hits = None, None
    while True:
        # Who had no partner finds none later: components only grow, and so do the refuted pairs.
        now = label(again if hits is None else again.join(hits.select("key", F.explode(F.array("a", "b")).alias("cls")).distinct(),
                                                          ["key", "cls"], "left_semi"))
        if refuted is None:
            now = now.withColumn("refuted", F.lit(None).cast("array<long>"))
        else:
            both = refuted.unionByName(refuted.select(F.col("b").alias("a"), F.col("a").alias("b")))
            now = now.join(both.groupBy(F.col("a").alias("cls")).agg(F.collect_set("b").alias("refuted")), "cls", "left")
        found = written(now.select("key", "cls", "label", "n", "signature", "refuted", "chunk", "i", "j").repartition(
            "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_closest(percent), "key long, a long, b long"),
            "parity-near")
        if hits is not None:
            discard(hits)
        hits = found
        near = written(hits.select("a", "b").distinct(), "parity-pairs")
        if near.isEmpty():
            break
        late = _links(near, classes, docs, shingle, percent, key, text)
        wrong = near.join(late, ["a", "b"], "left_anti")
        refuted = written(wrong if refuted is None else refuted.unionByName(wrong), "parity-refuted")
        discard(near)
        if not late.isEmpty():
            edges = edges.unionByName(late)
            labels = components(edges)
    discard(near, hits, again)

    # Component names: the smallest doc_id of its classes.  Only classes with copies or
    # links need a look-up; the others are their own component.
    named = classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "label", F.coalesce("label", "cls"))
    names = named.groupBy("label").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("_classes"))
    lookup = written(named.join(names, "label").where("copies > 1 OR _classes > 1").select(
        "cls", "component_id", F.col("rep").alias("class_id")), "parity-names")
    discard(classes)
    out = salted_left_join(rows.select("doc_id", "n_shingles", "cls"), lookup, "cls", "doc_id")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                      F.coalesce("class_id", "doc_id").alias("class_id"))


def join_query(docs: DataFrame) -> DataFrame:
    return link_components(docs, shingle=3, percent=90)

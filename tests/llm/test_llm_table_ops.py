"""Operators over whole tables (joins, WARC, mixing, pipeline) against brute force."""

import base64
import hashlib
import io
import os
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import corpus_pipeline  # noqa: E402
import oracle_check  # noqa: E402

from sluice.llm import graph, parity_join, pareto_mix, queries, warc_chunks  # noqa: E402
from sluice.llm import common  # noqa: E402
from sluice.llm.common import may_be_in, prepare, written  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCUMENTS)


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def slow_components(rows, size, percent):
    """{row number: smallest doc_id} by comparing all pairs."""
    sets = [shingles(t, size) for _, t, _ in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(i)
    return {i: min((rows[k][0] for k in m if rows[k][0] is not None), default=None) for m in members.values() for i in m}, sets


def variants(n_words, copies, step, seed):
    """Near copies: copy k has every (step + k)-th word changed."""
    base = [f"w{(i * 7919 + seed) % 997}x{i}" for i in range(n_words)]
    return [" ".join(w if (i + 1) % (step + k) else f"c{k}" for i, w in enumerate(base)) for k in range(copies)]


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80), (3, 50)])
def test_link_components_equal_brute_force(spark, size, percent):
    texts = [None, "", "  ", "a", "A", "a b", "b a", "a b c", "a b c d"]
    for seed, n in ((1, 12), (2, 40), (3, 150), (4, 400)):
        texts += variants(n, 9, max(3, n // 8), seed)
    texts += [" ".join(f"t{i}" for i in range(k)) for k in range(1, 45)] + texts[5:20]
    rows = [((i * 13) % 501 if i % 11 else None, t, "s") for i, t in enumerate(texts)]
    wanted, sets = slow_components(rows, size, percent)
    got = parity_join.link_components(docs_of(spark, rows), size, percent).collect()
    key = lambda *x: tuple((v is None, v if v is not None else 0) for v in x)
    assert sorted(key(r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(
        key(rows[i][0], len(sets[i]), wanted[i] if wanted[i] is not None else rows[i][0]) for i in range(len(rows)))


def test_link_components_real_and_empty(spark):
    prepare(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    wanted, sets = slow_components(rows, 3, 90)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in parity_join.join_query(docs).collect()}
    assert got == {rows[i][0]: (len(sets[i]), wanted[i]) for i in range(len(rows))}
    assert parity_join.join_query(docs.where("false")).count() == 0


def test_large_group_is_dealt_in_chunks(spark, monkeypatch):
    """Chunk pairs of a key lose no link: the same result with tiny chunks."""
    monkeypatch.setattr(parity_join, "CHUNK_MEMBERS", 3)
    rows = [(i, t, "s") for i, t in enumerate(variants(120, 30, 14, 5) + variants(120, 30, 11, 5))]
    wanted, _ = slow_components(rows, 3, 90)
    got = {r.doc_id: r.component_id for r in parity_join.join_query(docs_of(spark, rows)).collect()}
    assert got == {rows[i][0]: c for i, c in wanted.items()}


def closest_group(n, rng):
    """Members of one key, in many components: sets that differ in a few tokens of 200."""
    base = rng.integers(0, 1 << 62, 200, dtype=np.uint64)
    rows = []
    for i in range(n):
        own = base.copy()
        at = rng.choice(200, int(rng.integers(0, 14)), replace=False)
        own[at] = rng.integers(0, 1 << 62, len(at), dtype=np.uint64)
        refuted = [i + 5] if i % 4 == 0 else [i - 5] if i % 4 == 1 else None
        rows.append((7, i, i // 3 * 3, 200, parity_join.signature(own), refuted, 0, 0, 0))
    return rows


def test_closest_pairs_stay_linear_in_a_large_group(monkeypatch):
    """However the comparisons are sliced: each member that may link emits its closest
    partner only, and so all such members are in the pairs."""
    rows = closest_group(120, np.random.default_rng(3))
    names = ["key", "cls", "label", "n", "signature", "refuted", "chunk", "i", "j"]

    def emitted(rows):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.list_(pa.int64()) if k == 5 else None) for k, c in
                                               enumerate(zip(*rows[lo:lo + 50], strict=True))], names) for lo in (0, 50, 100)]
        return [tuple(p.values())[1:] for b in parity_join._closest(80)(iter(batches)) for p in b.to_pylist()]

    def may(x, y):
        far = int(np.bitwise_count(np.frombuffer(x[4], np.uint64) ^ np.frombuffer(y[4], np.uint64)).sum())
        return x[2] != y[2] and 180 * far <= 20 * 400 and y[1] not in (x[5] or ())

    every = {(x[1], y[1]) for i, x in enumerate(rows) for y in rows[i + 1:] if may(x, y)}
    crossed = [(*r[:6], r[1] % 2, 0, 1) for r in rows]      # two chunks that meet
    across = {p for p in every if p[0] % 2 != p[1] % 2}
    whole = emitted(rows), emitted(crossed)
    monkeypatch.setattr(parity_join, "PAIR_WORDS", 1)      # one member at a time
    assert (emitted(rows), emitted(crossed)) == whole
    for got, pairs in zip(whole, (every, across), strict=True):
        assert len(pairs) > 1000 and set(got) <= pairs and len(got) <= len(rows)
        assert {c for p in got for c in p} == {c for p in pairs for c in p}


def test_bands_cover_all_linked_sizes():
    for percent in (50, 80, 90):
        low = parity_join.bands(percent)
        band = lambda n: int((low <= n).sum()) - 1
        for a in range(1, 400):
            for b in range(a, a * 100 // percent + 1):
                assert band(b) - band(a) <= 1
                joined = band(b) - 1 if band(b) > band(a) else band(a)
                assert parity_join.blocks_of_band(joined, percent)[0] - parity_join.blocks_of_band(joined, percent)[1] > (100 - percent) * (a + b) // (100 + percent)


def test_components(spark):
    prepare(spark)
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, 9), (9, 7), (7, 5), (3, 3), (200, 1)] + [(50, k) for k in range(300, 330)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 100 for i in range(100, 141)) and all(got[i] == 5 for i in (5, 7, 9))
    assert got[200] == got[1] == 1 and all(got[k] == 50 for k in range(300, 330)) and 3 not in got
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def pages_of(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(*r, "more") for r in rows], "page_id long, url string, html string, archive string")


def test_warc_round_trip(spark):
    rows = [(5, "http://a/\r\nb", "same"), (3, None, "same"), (9, "u", "same"), (1, "u", None), (2, "u", ""),
            (7, "u", "é漢🙂\r\n\r\nWARC/1.1\r\n" * 9000), (None, "u", "same"), (None, "v", "alone"), (8, "u", "x" * 70000),
            (11, "w", "twice"), (11, "w", "twice")]
    got = warc_chunks.warc_query(pages_of(spark, rows)).collect()
    assert len(got) == len(rows) and all(r.intact for r in got)
    firsts = {}
    for i, _, html in rows:
        if i is not None:
            firsts[html or ""] = min(i, firsts.get(html or "", i))
    wanted = Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        first = firsts.get(html or "")
        again = first is not None and i != first
        wanted[(i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                "revisit" if again else "response", first if again else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == wanted
    assert max(r.n_chunks for r in got) > 3
    assert warc_chunks.warc_query(pages_of(spark, rows).where("false")).count() == 0


def test_warc_least_payload_and_chunks(spark):
    rows = [(1, "u", "tiny"), (2, "u", "tiny"), (3, "u", "long enough"), (4, "u", "long enough")]
    archives = warc_chunks.write_archives(pages_of(spark, rows), min_payload=5)
    chunks = warc_chunks.read_archives(archives, chunk_bytes=4)
    got = {r.record_id: r.record_type for r in warc_chunks.records(chunks).collect()}
    assert [got[f"urn:page:{i}"] for i in (1, 2, 3, 4)] == ["response", "response", "response", "revisit"]
    parts = sorted((r.chunk_no, bytes(r.data), r.digest_so_far, r.is_last) for r in chunks.where("record_id = 'urn:page:3'").collect())
    body, sha = b"", hashlib.sha1()
    for no, (chunk_no, data, digest, last) in enumerate(parts):
        sha.update(data)
        body += data
        assert chunk_no == no and len(data) <= 4 and digest == base64.b32encode(sha.digest()).decode()
        assert last == (no == len(parts) - 1)
    assert body == b"long enough"


def test_warc_reads_plain_archives_and_reports_cut_ones():
    record = (b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n")
    rows = list(warc_chunks.record_chunks(io.BytesIO(record * 2), 2))
    assert [r[8] for r in rows] == [b"he", b"ll", b"o"] * 2 and [r[0] for r in rows] == [0] * 3 + [1] * 3
    with pytest.raises(ValueError):
        list(warc_chunks.record_chunks(io.BytesIO(record[:-7]), 2))


def test_warc_oracle(spark):
    con = oracle_check.duck(SF)
    assert oracle_check.compare(spark, con, "op8_warc_chunks", queries.REGISTRY["op8_warc_chunks"],
                                queries.SQL["op8_warc_chunks"], SF)


def slow_targets(sizes, weights=(5, 2, 1), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        over = {s for s in free if left * w[s] / sum(w[x] for x in free) > cap * sizes[s] + 1e-9} if free else set()
        if not over:
            break
        capped |= over
    whole = sum(w[x] for x in order if x not in capped)
    return {s: cap * sizes[s] if s in capped else left * w[s] / whole for s in order}


def test_targets(spark):
    prepare(spark)
    for sizes in ({"a": 10, "b": 1000, "c": 500, None: 40, "é": 3, "Z": 7000, "z": 0}, {"only": 12}, {"x": 0}):
        frame = spark.createDataFrame(list(sizes.items()), "source string, n_words long")
        got = {r.source: r.target for r in pareto_mix.source_targets(frame).collect()}
        wanted = slow_targets(sizes)
        assert got.keys() == wanted.keys() and all(abs(got[s] - wanted[s]) < 1e-6 for s in got)
    none = spark.createDataFrame([], "source string, n_words long")
    assert pareto_mix.source_targets(none).count() == 0


def test_mix(spark):
    rows = [(i if i % 50 else None, " ".join(["w"] * ((i * 37) % 80 + 3 * (i % 3))), ("s%d" % (i % 3)) if i % 10 else None) for i in range(1500)]
    rows += [(7, "w w w", "s1")] * 5 + [(2000, None, "s2"), (2001, "", None)]
    docs = docs_of(spark, rows)
    first, again = (sorted(map(tuple, pareto_mix.mix_query(d).collect()), key=repr)
                    for d in (docs, docs.repartition(5)))
    assert first == again and len(first) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    wanted = slow_targets(sizes)
    taken = defaultdict(int)
    target = {}
    by_size = {v: s for s, v in sizes.items()}
    for _, size, source_size, t, got, copies in first:
        assert got == size * copies <= 3 * size
        taken[by_size[source_size]] += got
        target[by_size[source_size]] = t
    for s in sizes:
        assert abs(target[s] - wanted[s]) < 1e-6 and abs(taken[s] - wanted[s]) <= 90
    assert pareto_mix.mix_query(docs.where("false")).count() == 0


def test_inclusion_is_unequal_but_fixed_in_size(spark):
    """Over seeds: words stay fixed, long documents are taken more often than fragments."""
    rows = [(i, " ".join(["w"] * (8 if i % 2 else 200)), "s0" if i < 300 else "s1") for i in range(600)]
    docs = docs_of(spark, rows)
    often = Counter()
    for seed in range(4):
        got = pareto_mix.mix_documents(docs, weights=(1, 3), seed=seed).where("target < source_size").collect()
        assert abs(sum(r.copies * r.size for r in got) - got[0].target) <= 100
        often.update(r.size for r in got if r.copies)
    assert often[200] > 2 * often[8] > 0


def test_pipeline_stages(spark):
    prepare(spark)
    notes = "password=hunter2secret"
    base = " ".join(f"v{(i * 31) % 211}" for i in range(120))
    rows = [(3, base, "a"), (1, base + " tail", "b"), (2, base + " tail", "b"), (9, "short", "a"), (None, None, None),
            (8, " ".join(f"u{i}" for i in range(80)) + " " + notes, None), (10, "again and again " * 60, "a"),
            (11, " ".join(f"y{i}" for i in range(300)), "c")]
    docs = docs_of(spark, rows)
    kept = written(corpus_pipeline.quality(spark, docs, SF), "test-stage")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 8, 11]
    alone = written(corpus_pipeline.near_duplicates(spark, kept, SF), "test-stage")
    assert alone.columns == docs.columns and sorted(r.doc_id for r in alone.collect()) == [1, 8, 11]
    clean = written(corpus_pipeline.secrets(spark, alone, SF), "test-stage")
    assert clean.columns == docs.columns
    texts = {r.doc_id: r for r in clean.collect()}
    assert "hunter2" not in texts[8].text and texts[8].n_chars == len(texts[8].text) and texts[1].text == base + " tail"
    mixed = written(corpus_pipeline.mix(spark, clean, SF), "test-stage")
    assert mixed.columns == docs.columns and set(r.doc_id for r in mixed.collect()) <= {1, 8, 11}
    encoded = corpus_pipeline.encode(spark, mixed, SF)
    assert all(r.decoded_bytes == len(texts[r.doc_id].text.encode()) for r in encoded.collect())
    nothing = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        nothing = written(stage(spark, nothing, SF), "test-stage")
    assert nothing.count() == 0


@pytest.mark.parametrize("words", [common.FILTER_WORDS, 2])
def test_key_filter_never_loses_a_wanted_row(spark, monkeypatch, words):
    """A full filter (two words of 64 bits) lets others through, but never drops a wanted key."""
    monkeypatch.setattr(common, "FILTER_WORDS", words)
    rows = spark.createDataFrame([(i if i % 7 else None, f"t{i % 50}") for i in range(600)], "id long, h string")
    wanted = rows.where("id % 3 = 0 OR id IS NULL").select("id", "h")
    got = [(r.id, r.h, r._maybe) for r in may_be_in(rows, wanted, "id", "h").collect()]
    assert sorted(map(str, [g[:2] for g in got])) == sorted(str(tuple(r)) for r in rows.collect())
    assert all(maybe for i, _, maybe in got if i is None or i % 3 == 0)
    assert not any(r._maybe for r in may_be_in(rows, wanted.where("false"), "id", "h").collect())
    assert words == 2 or not all(g[2] for g in got)


@pytest.mark.parametrize("words", [common.FILTER_WORDS, 1])
def test_near_duplicates_stage_equals_brute_force(spark, monkeypatch, words):
    """All documents of the small table, rows that repeat, null doc_ids and null texts."""
    monkeypatch.setattr(common, "FILTER_WORDS", words)
    prepare(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    rows = [tuple(r) for r in docs.collect()]
    rows += rows[:20] + [(None, *r[1:]) for r in rows[10:30]] + [(r[0] + 9000, None, *r[2:]) for r in rows[:3]]
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, docs.schema), SF)
    distinct = sorted({r[:2] for r in rows}, key=str)
    sets = [shingles(t, 5) for _, t in distinct]
    group = list(range(len(distinct)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                group[root(i)] = root(j)
    members = defaultdict(list)
    for i in range(len(sets)):
        members[root(i)].append(distinct[i])
    least = {k: min((d is None, d or 0) for d, _ in m) for k, m in members.items()}
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert len(kept) == len(set(kept)) == len(members)
    where = {d: root(i) for i, d in enumerate(distinct)}
    assert sorted((k[0] is None, k[0] or 0) for k in kept) == sorted(least.values())
    assert sorted(where[k] for k in kept) == sorted(members)


def test_pipeline_runs_on_documents(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 0 and [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules"

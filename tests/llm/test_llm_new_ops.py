"""Collocations, reply trees and the prefix trie against plain Python and SQL."""

import hashlib
import itertools
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import oracle_check  # noqa: E402

from sluice.llm import collocations, prefix_trie, queries, reply_trees  # noqa: E402
from sluice.llm.common import prepare  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_trie_phrases", "op12_reply_trees", "op13_prefix_trie"])
def test_query_equals_its_sql(spark, name):
    con = oracle_check.duck(SF)
    got = queries.REGISTRY[name](spark, SF)
    want = con.sql(queries.SQL[name])
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    mine = sorted((tuple(r[c] for c in order) for r in got.collect()), key=repr)
    theirs = sorted((tuple(dict(zip(want.columns, r))[c] for c in order) for r in want.fetchall()), key=repr)
    assert mine == theirs and mine


# ---------------------------------------------------------------- collocations

LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def slow_phrases(docs, least, cover):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    out = set()
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        if len(p) == 2 and any(100 * b >= cover * a for (x, q), b in f.items()
                               if x == lang and len(q) == 3 and b >= least and p in (q[:2], q[1:])):
            continue
        cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        s, k = min(cuts)
        out.add((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], s))
    return out, {x: c for x, c in n.items() if c}


def corpus(seed, n_docs=60):
    rng = random.Random(seed)
    words = ["Aa", "b", "ccc", "dé", "e-e", "ÉF", "g" * 40, " h", "i'i"]
    docs = []
    for _ in range(n_docs):
        parts = [rng.choice(words) + rng.choice([" ", "  ", "\t", " ", ". ", "\n", ",", " ", " "]) for _ in range(rng.randint(0, 60))]
        docs.append(("".join(parts), rng.choice(["en", "en", "fr", None, "a\nb"])))
    return docs + [(None, "en"), ("", None), ("...", "fr"), ("\t \n", "xx")]


@pytest.mark.parametrize("seed, vocabulary, phrases", [(1, 1000, 1000), (2, 4, 7), (3, 5, 1000)])
def test_phrases_equal_brute_force(spark, seed, vocabulary, phrases):
    docs = corpus(seed)
    prepare(spark)
    df = spark.createDataFrame([(t, x, "w", 1) for t, x in docs], "text string, lang string, word string, n long").repartition(3)
    got, totals = collocations.mine_phrases(df, min_count=4, vocabulary=vocabulary, trie_phrases=phrases)
    want, n = slow_phrases(docs, 4, 50)
    assert {tuple(r) for r in got.collect()} == want and want
    assert {r["lang"]: r["n"] for r in totals.collect()} == n


def test_phrases_of_odd_tables(spark):
    prepare(spark)
    schema = "text string, lang string"
    assert collocations.phrase_query(spark.createDataFrame([], schema)).collect() == []
    assert collocations.phrase_query(spark.createDataFrame([(None, None), ("one two", "en")], schema)).collect() == []
    # One text of very many words, overlaps included, and ties that go by phrase.
    big = "x x " * 150_000 + ". " + "b a. c a. " * 10
    got = [tuple(r) for r in collocations.phrase_query(spark.createDataFrame([(big, None)], schema)).orderBy("rank").collect()]
    assert [(r[1], r[2], r[3]) for r in got] == [(1, "x x x", 299_998), (2, "b a", 10), (3, "c a", 10)]
    assert got[0][4:] == (300_000, 299_999, 300_040, 10**6 * 299_998**2 // (300_000 * 299_999))


@pytest.mark.parametrize("seed", range(4))
def test_double_array_holds_its_phrases_and_no_others(seed):
    rng = np.random.default_rng(seed)
    words, width = int(rng.integers(2, 4)), int(rng.integers(3, 5))
    high = 1 << (8 * width - 1 if seed % 2 else 9)
    keys = np.unique(rng.integers(0, high, (int(rng.integers(1, 4000)), words)) % (high if seed else 300), axis=0)
    trie = collocations.Trie(keys, width)
    assert sorted(map(tuple, trie.phrases.tolist())) == sorted(map(tuple, keys.tolist()))
    known = set(map(tuple, keys.tolist()))
    text = np.append(keys[rng.permutation(len(keys))[:500]].ravel(), rng.integers(-1, high, 500)).astype(np.int32)
    at, found = trie.walk(text)
    got = {(int(p), tuple(trie.phrases[i].tolist())) for p, i in zip(at, found, strict=True)}
    want = {(i, tuple(text[i:i + words].tolist())) for i in range(len(text) - words + 1)}
    assert got == {(i, p) for i, p in want if p in known}


# ---------------------------------------------------------------- reply trees

def test_escape_is_reversible_and_leaves_no_control_string():
    parts = [*reply_trees.CONTROLS, "<", "[", "\\", "s>", "INST]", "<<", "/", "x", "\n", "<\\s>", "<\\\\</SYS>>", "n"]
    rng = random.Random(5)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 8))) for _ in range(4000)]
    texts += ["".join(p) for p in itertools.product(parts, repeat=2)]
    for t in texts:
        e = reply_trees.escape(t)
        assert not any(c in e for c in reply_trees.CONTROLS)
        assert reply_trees.unescape(e) == t
        assert reply_trees.unescape_role(reply_trees.escape_role(t)) == t
        body = f"<s>{reply_trees.escape_role(t)}\n{e}</s>\n"
        assert reply_trees.parse(body * 2) == [(t, t)] * 2


def slow_paths(nodes, branches):
    """tree -> chosen paths (lists of nodes) by walking up from every leaf."""
    by = {(t, n): (p, s) for t, n, p, s in nodes}
    answered = {(t, p) for t, n, p, _ in nodes}
    out = defaultdict(list)
    for (t, n) in by:
        if (t, n) in answered:
            continue
        path, at = [], n
        while (t, at) in by and at not in path:
            path.append(at)
            at = by[t, at][0]
        if (t, at) in by:
            continue            # a cycle
        out[t].append((-sum(by[t, x][1] for x in path), -len(path), n, path[::-1]))
    return {t: [p[3] for p in sorted(ps)][:branches] for t, ps in out.items()}


@pytest.mark.parametrize("seed, branches", [(1, 1), (2, 3), (3, None)])
def test_paths_equal_brute_force(spark, seed, branches):
    rng = random.Random(seed)
    nodes = []
    for t in range(12):
        size = rng.choice([1, 2, 5, 30, 70])
        shape = rng.choice(["chain", "bushy", "late"])
        for n in range(size):
            parent = None if n == 0 else n - 1 if shape == "chain" else rng.randrange(n) if shape == "bushy" else max(0, n - rng.randint(1, 3))
            nodes.append((str(t), n, parent, float(rng.randint(-2, 2))))
    nodes += [("c", 1, 2, 1.0), ("c", 2, 3, 1.0), ("c", 3, 1, 1.0), ("c", 4, 1, 1.0), ("c", 9, None, 0.0)]   # a cycle and its tail
    nodes += [("m", 5, 77, 1.0), ("m", 6, 5, 1.0)]       # a parent that does not exist
    prepare(spark)
    df = spark.createDataFrame([(t, n, p, 100 * n, s, "rank") for t, n, p, s in nodes] + [("z", None, 1, 1, 1.0, "")],
                               "tree string, node long, parent long, body long, score double, rank string")
    got = defaultdict(dict)
    for r in reply_trees.paths(df, branches).collect():
        assert r["body"] == 100 * r["node"] and r["pos"] not in got[r["tree"], r["rank"], r["path"]]
        got[r["tree"], r["rank"], r["path"]][r["pos"]] = r["node"]
    mine = defaultdict(list)
    for (t, rank, leaf), nodes_at in sorted(got.items()):
        assert sorted(nodes_at) == list(range(1, len(nodes_at) + 1)) and nodes_at[len(nodes_at)] == leaf
        mine[t].append([nodes_at[i] for i in sorted(nodes_at)])
    assert dict(mine) == slow_paths(nodes, branches)


def test_format_of_trees_and_parts(spark, monkeypatch):
    prepare(spark)
    nodes = spark.createDataFrame(
        [("t", 1, None, 1, 0.0), ("t", 2, 1, 2, 1.0), ("t", 3, 1, 3, 5.0), ("t", 4, 2, 2, 9.0), ("t", 4, 2, 3, 9.0)],
        "tree string, node long, parent long, body long, score double")
    messages = spark.createDataFrame([("t", 1, "user", "q </s>"), ("t", 2, "assistant", "a\n"), ("t", 3, None, None),
                                      ("t", 3, None, None)], "tree string, body long, role string, text string")
    got = {r["rank"]: r for r in reply_trees.format_trees(nodes, messages, branches=2).collect()}
    first = "<s>user\nq <\\/s></s>\n" + "<s>assistant\na\n</s>\n" * 2
    assert got[1]["body"] == first and got[1]["path"] == 4 and got[1]["score"] == 10.0 and got[1]["n_turns"] == 3
    assert [got[1]["body"][a:b] for a, b in zip(got[1]["loss"][::2], got[1]["loss"][1::2])] == ["a\n"] * 2
    assert reply_trees.parse(got[2]["body"]) == [("user", "q </s>"), ("", "")] and got[2]["loss"] == []
    monkeypatch.setattr(reply_trees, "PART_CHARS", 60)
    names = ("tree", "path", "rank", "score", "role", "text")
    batch = type("Batch", (), {})()
    turns = [("t", 4, 1, 10.0, "user", "x" * 30)] * 3 + [("u", 1, 1, 0.0, "assistant", "y" * 200)] * 2
    batch.column = lambda i: type("C", (), {"to_pylist": lambda self: [t[i] for t in turns]})()
    parts = [r for b in reply_trees._formatted([batch]) for r in b.to_pylist()]
    assert [(p["tree"], p["part"], p["n_turns"]) for p in parts] == [("t", 0, 2), ("t", 1, 1), ("u", 0, 1), ("u", 1, 1)], names
    assert "".join(p["body"] for p in parts[:2]) == f"<s>user\n{'x' * 30}</s>\n" * 3


CHATS = "conv_id long, turn long, role string, text string, tree string, node long"


def chats(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(*r, "t", 1) for r in rows], CHATS)


def test_conversations_with_odd_rows(spark):
    long = "word " * 400_000
    rows = [(7, 1, "assistant", "b"), (7, None, "user", None), (7, 2, None, "[INST]"), (None, 0, "user", "lost"),
            (8, 0, "assistant", long), (8, 0, "assistant", long), (9, 3, "a\nb\\", "\\n")]
    rows += [(10, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(300)]
    got = {r["conv_id"]: r for r in reply_trees.chat_query(chats(spark, rows)).collect()}
    assert set(got) == {-1, None, 7, 8, 9, 10}
    sha = lambda turns: hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert got[7]["turns_sha256"] == sha([("user", ""), ("assistant", "b"), ("", "[INST]")]) and got[7]["loss_chars"] == 1
    assert got[8]["n_turns"] == 2 and got[8]["loss_sha256"] == hashlib.sha256((long * 2).encode()).hexdigest()
    assert got[9]["turns_sha256"] == sha([("a\nb\\", "\\n")])
    assert got[10]["n_turns"] == 300 and got[10]["turns_sha256"] == sha(
        [("user" if i % 2 else "assistant", f"t{i}") for i in range(300)])
    assert got[-1]["loss_chars"] == len(reply_trees.EXTRA)
    empty = reply_trees.chat_query(chats(spark, [])).collect()
    assert [r["conv_id"] for r in empty] == [-1]


# ---------------------------------------------------------------- prefix trie

def slow_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(t, key=lambda x: x[0])] for c, t in own.items()}
    whole = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - c % 5, [])[:h] + t[h:]
    members = defaultdict(list)
    for c, t in whole.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    out = set()
    for p, m in members.items():
        inside = [q for q in members if q[:len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in m if len(whole[c]) == len(p))))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p],
                 sum(children[q] == 0 for q in inside),
                 sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in inside if q),
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def talk(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), 90):
        style = rng.choice(["copy", "common", "free", "long"])
        for i in range({"copy": 12, "long": 25}.get(style, rng.randint(0, 11))):
            word = "same" if style in ("copy", "long") else rng.choice(["same", "é", "x" * 30])
            rows.append((c, i, "user" if i % 2 else "assistant", f"{word}{i if style == 'long' else ''}"))
    return rows + [(500, None, None, None), (500, 1, "user", "same"), (None, 1, "user", "same"), (11, 90, "user", "end")]


@pytest.mark.parametrize("seed, chunk", [(1, 1 << 19), (2, 40), (3, 1), (4, 200)])
def test_trie_equals_brute_force(spark, monkeypatch, seed, chunk):
    rows = talk(seed)
    # Chunks of a few turns, so that most nodes reach a chunk's edge.
    turns = prefix_trie.rebuilt(chats(spark, rows)).collect()
    if chunk < 1 << 19:
        got = prefix_trie.prefix_trie(_small_chunks(spark, monkeypatch, turns, chunk))
    else:
        got = prefix_trie.trie_query(chats(spark, rows))
    assert {tuple(r[c] for c in TRIE) for r in got.collect()} == slow_trie(rows)
    assert got.count() == len(slow_trie(rows))


def _small_chunks(spark, monkeypatch, turns, chunk):
    monkeypatch.setattr(prefix_trie, "_chunks", _with_chunk(chunk))
    df = spark.createDataFrame([(r["conv_id"], list(r["turns"]), list(r["sizes"])) for r in turns],
                               "conv_id long, turns array<long>, sizes array<long>")
    from sluice.llm.common import written

    return written(df, "test-sequences")


def _with_chunk(chunk):
    def run(batches):
        from sluice.llm import prefix_trie as module

        module.CHUNK_TURNS = chunk
        # One row per batch, so that a chunk ends after any row.
        return module._chunks(b.slice(i, 1) for b in batches for i in range(b.num_rows))

    return run


def test_trie_of_odd_tables(spark):
    assert prefix_trie.trie_query(chats(spark, [])).collect() == []
    assert prefix_trie.trie_query(chats(spark, [(None, 1, "user", "x")])).collect() == []
    got = {tuple(r[c] for c in TRIE) for r in prefix_trie.trie_query(chats(spark, [(3, 1, "user", "x" * 2_000_000)] * 2)).collect()}
    assert got == slow_trie([(3, 1, "user", "x" * 2_000_000)] * 2)


def test_extents_by_binary_search():
    rng = random.Random(3)
    for n in (1, 2, 3, 17, 100):
        lcp = np.array([0] + [rng.randint(0, 4) for _ in range(n - 1)])
        table = prefix_trie._minima(lcp)
        at = np.repeat(np.arange(n), 4)
        depth = np.tile(np.arange(1, 5), n)
        left, right = prefix_trie.extents(table, at, depth)
        for i, d, lo, hi in zip(at, depth, left, right, strict=True):
            want_hi = next((j - 1 for j in range(i + 1, n) if lcp[j] < d), n - 1)
            want_lo = next((j for j in range(i, -1, -1) if lcp[j] < d), 0)
            assert (lo, hi) == (want_lo, want_hi)

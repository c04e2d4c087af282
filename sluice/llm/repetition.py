"""Quality rules on repetition, from word-level suffix arrays.

For each text the suffixes of its word sequence are sorted (prefix doubling on
all texts of a slice at once; only suffixes that are still tied are sorted
again).  Neighbours in that order have a longest common prefix; the LCP intervals
of at least ``MIN_WORDS`` words are the maximal repeated substrings.  A suffix
lies in the interval of its larger neighbouring LCP, so the union of
[i, i + lcp) over all suffixes is the union of the spans of all occurrences of all
maximal repeats.  A text is kept if the repeated share of its word characters and
its longest repeat stay within the limits, and the base rules hold:

    base_failed = n_words < 50 or 100 * n_repeat_words > 50 * n_words

Null text: no words (fails the base rule).  Null doc_id and repeated rows: a row
each.  Empty table: no rows.  Lines are cut at \\n only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, hash_spans, mix, release_state, strings, text_slices, word_bounds

MIN_WORDS = 10
#: Limits below what the base rules imply (half of the words): just above the largest covered share of a labelled
#: clean document of the test tables (0.4252, a sentence of 13 words twice in 62), and far above their longest repeat (13).
MAX_COVERED = 0.43
MAX_LONGEST = 100
LEAST_WORDS = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "covered_chars long, covered double, longest_repeat long, repeats array<struct<start: bigint, end: bigint>>")


def _tied(rank_sorted: np.ndarray) -> np.ndarray:
    """Which entries of a sorted array are equal to a neighbour."""
    same = rank_sorted[1:] == rank_sorted[:-1]
    out = np.zeros(len(rank_sorted), bool)
    out[1:] |= same
    out[:-1] |= same
    return out


def suffix_order(words: np.ndarray, text_of: np.ndarray, end_of: np.ndarray):
    """(suffix array, ranks by the first 1, 2, 4, ... words) of the word
    sequences of several texts.

    ``words``: hash of each word; ``text_of``: index of its text; ``end_of``: one
    past the last word of its text.  Suffixes compare within a text only; a text's
    end is below every word.  Ranks are equal if and only if so many words are."""
    n = len(words)
    order = np.lexsort((words, text_of))
    new = np.ones(n, bool)
    new[1:] = (words[order[1:]] != words[order[:-1]]) | (text_of[order[1:]] != text_of[order[:-1]])
    at = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, at, 0))
    levels, step = [rank], 1
    active = order[_tied(rank[order])]
    while len(active):
        after = active + step
        second = np.where(after < end_of[active], rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.lexsort((second, rank[active]))
        active, second = active[by], second[by]
        first = rank[active]
        fresh = np.ones(len(active), bool)
        fresh[1:] = first[1:] != first[:-1]
        sub = fresh.copy()
        sub[1:] |= second[1:] != second[:-1]
        i = np.arange(len(active))
        rank = rank.copy()
        rank[active] = first + np.maximum.accumulate(np.where(sub, i, 0)) - np.maximum.accumulate(np.where(fresh, i, 0))
        levels.append(rank)
        step *= 2
        active = active[_tied(rank[active])]
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = at
    return suffixes, levels


def neighbour_lcp(suffixes: np.ndarray, levels: list[np.ndarray], end_of: np.ndarray) -> np.ndarray:
    """Words that suffixes[i] and suffixes[i + 1] have in common (one entry less than suffixes)."""
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    lcp = np.zeros(len(a), np.int64)
    ends_a, ends_b = end_of[a], end_of[b]
    live = np.flatnonzero(levels[0][a] == levels[0][b])
    for depth in range(len(levels) - 1, -1, -1):
        x, y = a[live], b[live]
        inside = (x < ends_a[live]) & (y < ends_b[live])
        rank = levels[depth]
        hit = inside & (rank[np.minimum(x, len(rank) - 1)] == rank[np.minimum(y, len(rank) - 1)])
        grow = live[hit]
        a[grow] += 1 << depth
        b[grow] += 1 << depth
        lcp[grow] += 1 << depth
    return lcp


def longest_matches(words: np.ndarray, text_of: np.ndarray, end_of: np.ndarray) -> np.ndarray:
    """Per word: length in words of the longest repeat of its text that begins there."""
    n = len(words)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    suffixes, levels = suffix_order(words, text_of, end_of)
    lcp = neighbour_lcp(suffixes, levels, end_of)
    best[suffixes[1:]] = lcp
    best[suffixes[:-1]] = np.maximum(best[suffixes[:-1]], lcp)
    return best


def _marked(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in the union of [start, start + length)."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:n]) > 0


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeats_in_group(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which keys occur at least twice within their group."""
    order = np.lexsort((key, group))
    k, g = key[order], group[order]
    same = (k[1:] == k[:-1]) & (g[1:] == g[:-1])
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def slice_statistics(data: np.ndarray, offs: np.ndarray, min_words: int = MIN_WORDS) -> dict:
    """All statistics of the texts of a slice, as arrays; ``repeats``: list of
    (start, end) code points of the merged repeated spans per text."""
    n_texts = len(offs) - 1
    starts, ends, first = word_bounds(data, offs)
    n = len(starts)
    lead = (data & 0xC0) != 0x80
    points = np.append(0, np.cumsum(lead, dtype=np.int64))
    chars = points[ends] - points[starts]
    n_words = first[1:] - first[:-1]
    text_of = np.repeat(np.arange(n_texts), n_words)
    end_of = np.repeat(first[1:], n_words)
    words = hash_spans(data, starts, ends)

    # Words in 3-word windows that occur twice or more.
    window = np.flatnonzero(np.arange(n) + 3 <= end_of) if n else np.zeros(0, np.int64)
    triple = mix(words[window] * np.uint64(3) + mix(words[np.minimum(window + 1, max(n - 1, 0))] * np.uint64(5)
                 + mix(words[np.minimum(window + 2, max(n - 1, 0))])))
    again = window[_repeats_in_group(text_of[window], triple)] if len(window) else window
    repeat_words = _marked(again, np.full(len(again), 3), n)

    # Lines (between \n) that hold a word and equal an earlier line of the text.
    cut = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([offs[:-1][offs[:-1] < offs[1:]], cut + 1]))
    line_start = line_start[line_start < len(data)]
    line_end = np.minimum(np.append(line_start[1:], len(data)), len(data))
    if len(line_start):
        line_text = np.searchsorted(offs, line_start, side="right") - 1
        closed = data[line_end - 1] == 10
        line_end = line_end - closed
        has_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
        ls, le, lt = line_start[has_word], line_end[has_word], line_text[has_word]
        h = hash_spans(data, ls, le)
        order = np.lexsort((h, lt))
        dup = (h[order[1:]] == h[order[:-1]]) & (lt[order[1:]] == lt[order[:-1]])
        n_dup = np.bincount(lt[order[1:]][dup], minlength=n_texts)
    else:
        n_dup = np.zeros(n_texts, np.int64)

    longest = longest_matches(words, text_of, end_of)
    long = np.flatnonzero(longest >= min_words)
    covered = _marked(long, longest[long], n)
    top = np.zeros(n_texts, np.int64)
    np.maximum.at(top, text_of[long], longest[long])
    opens = np.zeros(n + 1, bool)      # first words of texts
    opens[first[:-1]] = True
    begin = np.flatnonzero(covered & (opens[:n] | ~np.append(False, covered[:-1])[:n]))
    stop = np.flatnonzero(covered & (opens[1:] | ~np.append(covered[1:], False)[:n])) + 1
    repeats = [[] for _ in range(n_texts)]
    for t, b, e in zip(text_of[begin].tolist(), begin.tolist(), stop.tolist(), strict=True):
        base = points[offs[t]]
        repeats[t].append((int(points[starts[b]] - base), int(points[ends[e - 1]] - base)))
    space_free = lead & ~IS_SPACE[data]
    return {"n_words": n_words, "word_chars": _per_text(space_free, offs), "n_symbols": _per_text(_SYMBOL[data], offs),
            "n_dup_lines": n_dup, "n_repeat_words": _per_text(repeat_words, first),
            "covered_chars": _per_text(np.where(covered, chars, 0), first), "longest_repeat": top, "repeats": repeats}


def _measure(min_words: int):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_chars",
             "covered", "longest_repeat", "repeats"]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        release_state()
        for batch in batches:
            keys, texts = batch.column(0), strings(batch.column(1))
            for lo, hi, data, offs in text_slices(texts):
                s = slice_statistics(data, offs, min_words)
                share = s["covered_chars"] / np.maximum(1, s["word_chars"])
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(lo, hi - lo),
                     *[pa.array(s[c], pa.int64()) for c in names[1:7]], pa.array(share, pa.float64()),
                     pa.array(s["longest_repeat"], pa.int64()),
                     pa.array([[{"start": a, "end": b} for a, b in r] for r in s["repeats"]], span)], names)

    return run


def repetition_statistics(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Base counts, share of characters in maximal repeats, longest repeat (words)
    and the merged repeated spans (code points) of every text."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        _measure(min_words), SCHEMA)


def quality_rules(docs: DataFrame, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST,
                  min_words: int = MIN_WORDS) -> DataFrame:
    """``repetition_statistics`` with base_failed and kept."""
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return repetition_statistics(docs, min_words).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("covered") <= max_covered) & (F.col("longest_repeat") <= max_longest))


def keep_documents(docs: DataFrame, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST,
                   min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, decided in the scan: no join, no shuffle."""
    at = docs.columns.index("text")

    def run(batches):
        release_state()
        for batch in batches:
            for lo, hi, data, offs in text_slices(strings(batch.column(at))):
                s = slice_statistics(data, offs, min_words)
                share = s["covered_chars"] / np.maximum(1, s["word_chars"])
                keep = ((s["n_words"] >= LEAST_WORDS) & (100 * s["n_repeat_words"] <= 50 * s["n_words"])
                        & (share <= max_covered) & (s["longest_repeat"] <= max_longest))
                yield batch.slice(lo, hi - lo).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def quality_query(docs: DataFrame) -> DataFrame:
    return quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "covered", "longest_repeat", F.size("repeats").cast("long").alias("n_repeats"))

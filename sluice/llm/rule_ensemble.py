"""Quality classifier: a sparse rule ensemble over text statistics.

1. Statistics of every whole text (``text_statistics``), vectorised per slice.
2. Small boosted trees on a bounded sample of labelled rows (``MAX_LABELLED``, the
   rows with the smallest hash of doc_id); every path from a root to a node is a
   conjunctive rule, e.g. ``top_share > 0.2 AND n_words <= 310``.
3. Lasso logistic regression over the rules (proximal gradient); most weights are 0.
4. The rules with weight compile into one Spark column: a sum of weights of the
   conjunctions that hold, through the logistic function.

Scores of all documents are then a projection over the statistics.

Labels of rows with crc32(doc_id as text) mod 5 = 0 are never used (``held_out``);
the label, language, source and doc_id of a row are no input of its score.

Null text: an empty text (it has a score like any other).  Null doc_id: not held
out, never a training row.  Labels that repeat a doc_id count once (the smaller);
null labels are no labels.  No labels at all, or labels of one kind: no rules, the
score is the smoothed share of label 1.  Empty table: no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, discard, hash_spans, strings, text_slices, word_bounds, written

STATISTICS = ("n_words", "n_chars", "mean_word", "longest_word", "distinct_share", "top_share", "stutter_share",
              "repeat3_share", "symbol_share", "digit_share", "upper_share", "stop_share", "words_per_line",
              "dup_line_share", "short_share", "nonascii_share", "end_share")
MAX_LABELLED = 10_000
TREES, DEPTH, SHRINK, LEAF, BINS = 24, 3, 0.3, 20, 32
PENALTY = 4e-4
THRESHOLD = 0.3

_KIND = {name: np.zeros(256, bool) for name in ("symbol", "digit", "upper", "end")}
_KIND["symbol"][np.frombuffer(b"#*$%&|<>{}[]\\^~_=+@/", np.uint8)] = True
_KIND["digit"][48:58] = True
_KIND["upper"][65:91] = True
_KIND["end"][np.frombuffer(b".!?", np.uint8)] = True


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values, dtype=np.float64))
    return total[bounds[1:]] - total[bounds[:-1]]


def statistics(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of STATISTICS per text of a slice."""
    n_texts = len(offs) - 1
    starts, ends, first = word_bounds(data, offs)
    n = len(starts)
    n_words = (first[1:] - first[:-1]).astype(np.float64)
    text_of = np.repeat(np.arange(n_texts), first[1:] - first[:-1])
    some = np.maximum(n_words, 1)
    length = (ends - starts).astype(np.float64)
    words = hash_spans(data, starts, ends)
    lead = (data & 0xC0) != 0x80
    chars = _sums(lead & ~IS_SPACE[data], offs)
    a_char = np.maximum(chars, 1)
    longest = np.zeros(n_texts)
    np.maximum.at(longest, text_of, length)
    # Counts of equal words within a text, by one sort.
    order = np.lexsort((words, text_of))
    new = np.ones(n, bool)
    if n:
        new[1:] = (words[order[1:]] != words[order[:-1]]) | (text_of[order[1:]] != text_of[order[:-1]])
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, n))
    distinct = np.bincount(text_of[order[head]], minlength=n_texts) if n else np.zeros(n_texts)
    top = np.zeros(n_texts)
    np.maximum.at(top, text_of[order[head]], size)
    stutter = np.zeros(n, bool)
    stutter[1:] = (words[1:] == words[:-1]) & (text_of[1:] == text_of[:-1]) if n > 1 else False
    three = np.flatnonzero((text_of[2:] == text_of[:-2])) if n > 2 else np.zeros(0, np.int64)
    triple = words[three] * np.uint64(3) + words[three + 1] * np.uint64(5) + words[three + 2] if len(three) else words[:0]
    by = np.lexsort((triple, text_of[three])) if len(three) else three
    same = (triple[by[1:]] == triple[by[:-1]]) & (text_of[three[by[1:]]] == text_of[three[by[:-1]]])
    repeat3 = np.bincount(text_of[three[by[1:]][same]], minlength=n_texts) if len(three) else np.zeros(n_texts)
    # Lines.
    cut = np.flatnonzero(data == 10)
    ls = np.unique(np.concatenate([offs[:-1][offs[:-1] < offs[1:]], cut + 1]))
    ls = ls[ls < len(data)]
    le = np.append(ls[1:], len(data))[:len(ls)]
    lt = np.searchsorted(offs, ls, side="right") - 1
    le = np.minimum(le, offs[lt + 1]) if len(ls) else le
    le = le - (data[le - 1] == 10) if len(ls) else le
    has = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    ls, le, lt = ls[has], le[has], lt[has]
    n_lines = np.bincount(lt, minlength=n_texts).astype(np.float64)
    h = hash_spans(data, ls, le)
    lo = np.lexsort((h, lt))
    dup = (h[lo[1:]] == h[lo[:-1]]) & (lt[lo[1:]] == lt[lo[:-1]])
    n_dup = np.bincount(lt[lo[1:]][dup], minlength=n_texts)
    share = lambda kind: _sums(_KIND[kind][data], offs) / a_char
    ends_sentence = _KIND["end"][data[ends - 1]] if n else np.zeros(0, bool)
    columns = (n_words, chars, _sums(length, first) / some, longest, distinct / some, top / some, _sums(stutter, first) / some,
               repeat3 / some, share("symbol"), share("digit"), share("upper"), _sums(length <= 3, first) / some,
               n_words / np.maximum(n_lines, 1), n_dup / np.maximum(n_lines, 1), _sums(length == 1, first) / some,
               _sums(lead & (data >= 128), offs) / a_char, _sums(ends_sentence, first) / some)
    return np.column_stack(columns)


def text_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and STATISTICS of every whole text."""
    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in text_slices(strings(batch.column(1))):
                got = statistics(data, offs)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *[pa.array(got[:, i]) for i in range(got.shape[1])]],
                    ["doc_id", *STATISTICS])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


#: A rule: (statistic number, upper: at most or else above, threshold), ...
Rule = tuple[tuple[int, bool, float], ...]


def _tree(x: np.ndarray, edges: list[np.ndarray], bins: np.ndarray, gradient: np.ndarray, hessian: np.ndarray):
    """Rules (paths to every node) and leaf values of one regression tree on the gradients."""
    rules: list[Rule] = []
    update = np.zeros(len(gradient))

    def grow(rows: np.ndarray, path: Rule, depth: int) -> None:
        g, h = gradient[rows].sum(), hessian[rows].sum()
        best = None
        if depth < DEPTH and len(rows) >= 2 * LEAF:
            for j, cut in enumerate(edges):
                if not len(cut):
                    continue
                b = bins[rows, j]
                gs = np.cumsum(np.bincount(b, gradient[rows], len(cut) + 1))[:-1]
                hs = np.cumsum(np.bincount(b, hessian[rows], len(cut) + 1))[:-1]
                ns = np.cumsum(np.bincount(b, minlength=len(cut) + 1))[:-1]
                gain = gs ** 2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g ** 2 / (h + 1)
                gain[(ns < LEAF) | (len(rows) - ns < LEAF)] = 0
                k = int(np.argmax(gain))
                if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                    best = gain[k], j, k
        if best is None:
            update[rows] = SHRINK * g / (h + 1)
            return
        _, j, k = best
        under = bins[rows, j] <= k
        for side, upper in ((under, True), (~under, False)):
            step = (*path, (j, upper, float(edges[j][k])))
            rules.append(step)
            grow(rows[side], step, depth + 1)

    grow(np.arange(len(gradient)), (), 0)
    return rules, update


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, upper, cut in rule:
        out &= (x[:, j] <= cut) if upper else (x[:, j] > cut)
    return out


def extract_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Paths of boosted trees, without repeats of the same set of training rows."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    margin = np.full(len(y), math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    rules: dict[bytes, Rule] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        new, update = _tree(x, edges, bins, y - p, p * (1 - p))
        margin += update
        for rule in new:
            on = holds(rule, x)
            if LEAF <= on.sum() <= len(y) - LEAF:
                rules.setdefault(np.packbits(on).tobytes(), rule)
    return list(rules.values())


def lasso_logistic(on: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 400) -> tuple[float, np.ndarray]:
    """(intercept, weights) by accelerated proximal gradient; the intercept is not penalised."""
    n, k = on.shape
    x = np.column_stack([np.ones(n), on]).astype(np.float64)
    step = 4 / max(1e-9, np.linalg.norm(x.T @ x / n, 2))
    w = np.zeros(k + 1)
    w[0] = math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        new = ahead - step * (x.T @ (p - y) / n)
        new[1:] = np.sign(new[1:]) * np.maximum(0, np.abs(new[1:]) - step * penalty)
        t, before = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        ahead = new + (before - 1) / t * (new - w)
        w = new
    return float(w[0]), w[1:]


class Model:
    """Intercept and weighted rules; ``score`` is a Spark column over STATISTICS."""

    def __init__(self, intercept: float, rules: list[tuple[float, Rule]]):
        self.intercept, self.rules = intercept, rules

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for weight, rule in self.rules:
            test = F.lit(True)
            for j, upper, cut in rule:
                test = test & ((F.col(STATISTICS[j]) <= cut) if upper else (F.col(STATISTICS[j]) > cut))
            total = total + F.when(test, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def explain(self) -> list[str]:
        return [f"{weight:+.3f}  " + " AND ".join(f"{STATISTICS[j]} {'<=' if u else '>'} {c:.6g}" for j, u, c in rule)
                for weight, rule in sorted(self.rules, key=lambda r: -abs(r[0]))]


def fit(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> Model:
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(math.log(share / (1 - share)), [])
    rules = extract_rules(x, y)
    if not rules:
        return Model(math.log(y.mean() / (1 - y.mean())), [])
    intercept, weights = lasso_logistic(np.column_stack([holds(r, x) for r in rules]), y, penalty)
    return Model(intercept, [(float(w), r) for w, r in zip(weights, rules, strict=True) if w != 0.0])


def train(stats: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = MAX_LABELLED) -> Model:
    """Fit on at most ``max_labelled`` labelled rows that are not held out: those of the
    smallest hashes of doc_id.  A bound on the hash, from their number, keeps the others
    on the executors.  Of a repeated doc_id the smallest statistics count."""
    marks = written(labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(label).cast("double").alias("_label")).where(~held_out()).withColumn(
        "_share", F.xxhash64("doc_id") / F.lit(float(1 << 64)) + 0.5), "rule-labels")
    n = marks.count()
    rows, share = [], 1.5 * max_labelled / max(1, n)
    while True:
        some = marks.where(F.col("_share") < share) if share < 1 else marks
        rows = stats.join(some, "doc_id").groupBy("doc_id", "_label").agg(
            F.min(F.struct(*STATISTICS)).alias("s")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).select(
            "_label", "s.*").collect()
        if len(rows) >= max_labelled or share >= 1:
            break
        share *= 4        # labels without a document, or an unlucky bound
    discard(marks)
    got = np.array([tuple(r) for r in rows], np.float64).reshape(-1, len(STATISTICS) + 1)
    return fit(got[:, 1:], got[:, 0])


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    stats = written(text_statistics(docs), "rule-statistics")
    model = train(stats, labels)
    return stats.select("doc_id", held_out().alias("held_out"), model.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))

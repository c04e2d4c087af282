"""Secret scans: base patterns and character Markov models, in DataFrame functions only.

Base spans are the leftmost non-overlapping matches of three patterns (``BASE``).
Further candidates are runs of token characters; two first-order character models,
one of random strings and one of ordinary identifiers, are compared by the
log-likelihood ratio of the run's transitions.  A run above ``MIN_RATIO`` that
overlaps no base span is a span of kind ``markov``.

Training: ordinary are all runs of token characters of all documents outside base
spans, as they are, in capitals, and joined to others by / _ - = or + (paths,
constants and rules, which prose lacks), and decimal numbers; random are base64 and
hexadecimal digests, both numbers and digests uniform over their alphabets by
construction.  Transition counts are a grouped aggregate; only the alphabet's
square of counts reaches the driver.  Each row of probabilities is mixed with a
uniform one (``UNIFORM``), so a transition unseen in ordinary runs counts at most
-log(UNIFORM) and a bit, however large the corpus is.  The model is compiled into
a literal array, scored by an aggregate over a run's characters.

Positions: a text splits at the same matches that are extracted, so the start of
a match is the length of the pieces and matches before it (code points).  Arrays are
bound once per text (``let``), running sums and maxima go by blocks (``running``), runs
are split into characters once, and texts are cut by blocks of spans, so a text of very
many matches or one very long run costs little more than in proportion.

Null text: empty, no spans.  Null doc_id and repeated rows: a row each.  Empty
table: no rows (and a model that knows only numbers as ordinary).  Very long texts and
runs are scanned whole.  ``find_secrets`` adds ``base_spans`` and ``spans``; other columns
stay, whatever their names, and columns of these two names are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = ("(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
#: kind, pattern, group and least length of that group.  Runs of a class are whole runs, so their least length
#: is part of the pattern; an assignment consumes its match before the length counts.
BASE = (("assign", ASSIGN, 2, 6), ("access", "AKIA[A-Z0-9]{16,}", 0, 20), ("hex", "[0-9a-f]{24,}", 0, 24))
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = "[A-Za-z0-9+/_=-]{20,}"
ORDINARY = "[A-Za-z0-9+/_=-]{4,}"
JOINTS = ("//", "__", "--", "==", "++")   # twice, so that rules such as ----- are ordinary
MADE = 4000        # digests and numbers in the samples made by construction
MIN_RATIO = 12.0
UNIFORM = 0.1      # share of the uniform distribution in each row of a model
PLACEHOLDER = "[secret]"


BLOCK = 128


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once (a lambda variable)."""
    return F.get(F.transform(F.array(value), use), 0)


def running(values: Column, combine, zero) -> Column:
    """Per element the combination of the elements before it, by blocks: those of whole
    blocks first, then those of its own block."""
    merge = lambda part: F.aggregate(part, F.lit(zero).cast("long"), combine)
    starts = lambda n: F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(n / BLOCK).cast("int") - 1))
    blocks = lambda v: F.transform(starts(F.size(v)), lambda b: merge(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))
    before = lambda bs: F.transform(bs, lambda _, i: merge(F.slice(bs, F.lit(1), i)))
    place = lambda i: F.floor(i / BLOCK).cast("int")
    each = lambda v, done: F.transform(v, lambda _, i: combine(
        F.get(done, place(i)), merge(F.slice(v, place(i) * BLOCK + 1, i % BLOCK))))
    return let(values, lambda v: let(blocks(v), lambda bs: let(before(bs), lambda done: each(v, done))))


def spans_of(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """array<struct<start, kind_no, end, kind, value>> of the matches of one kind."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    zipped = F.arrays_zip(matches.alias("m"), values.alias("v"), F.slice(
        F.split(text, pattern, -1), F.lit(1), F.size(matches)).alias("p"))
    length = lambda c: F.length(c).cast("long")

    def place(found):
        steps = F.transform(found, lambda x: length(x["p"]) + length(x["m"]))
        at = lambda x, i, before: F.get(before, i) + length(x["p"])
        return let(running(steps, lambda a, x: a + x, 0), lambda before: F.transform(found, lambda x, i: F.struct(
            at(x, i, before).alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"),
            (at(x, i, before) + length(x["m"])).alias("end"), F.lit(kind).alias("kind"), x["v"].alias("value"))))

    spans = F.filter(let(zipped, place), lambda s: F.length(s["value"]) >= least)
    return F.when(text.rlike(pattern), spans).otherwise(
        F.array().cast("array<struct<start: bigint, kind_no: int, end: bigint, kind: string, value: string>>"))


def _bare(spans: Column) -> Column:
    return F.transform(spans, lambda s: s.dropFields("value"))


def _transitions(words: DataFrame) -> DataFrame:
    """(word, n) -> (pair of characters, n)."""
    pairs = let(F.split("word", ""), lambda c: F.transform(
        F.sequence(F.lit(0), F.size(c) - 2), lambda i: F.concat(F.get(c, i), F.get(c, i + 1))))
    return words.where(F.length("word") >= 2).select(F.explode(pairs).alias("pair"), "n").groupBy("pair").agg(
        F.sum("n").alias("n"))


def train(docs: DataFrame) -> list[float]:
    """Log-likelihood ratios (random over ordinary) of all transitions, row by row."""
    rest = F.col("text")
    for _, pattern, _, _ in BASE:
        rest = F.regexp_replace(rest, F.lit(pattern), F.lit(" "))
    found = docs.select(F.explode(F.regexp_extract_all(rest, F.lit(ORDINARY), F.lit(0))).alias("word")).groupBy(
        "word").agg(F.count(F.lit(1)).alias("n"))
    joined = [F.concat(F.lit(c), "word", F.lit(c)) for c in JOINTS]
    made = docs.sparkSession.range(MADE)
    number = F.concat(*[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(10**9)).cast("string") for i in range(3)])
    ordinary = found.select(F.explode(F.array("word", F.upper("word"), *joined)).alias("word"), "n").unionByName(
        made.select(number.alias("word"), F.lit(1).cast("long").alias("n")))
    digest = F.sha2(F.concat(F.lit("random:"), F.col("id").cast("string")), 256)
    random = made.select(F.explode(F.array(
        F.base64(F.unhex(digest)), F.base64(F.unhex(F.sha2(digest, 384))), digest)).alias("word")).withColumn("n", F.lit(1))
    both = _transitions(ordinary).withColumn("random", F.lit(0)).unionByName(
        _transitions(random).withColumn("random", F.lit(1)))
    size = len(ALPHABET)
    place = {c: i for i, c in enumerate(ALPHABET)}
    counts = [[[0] * size for _ in range(size)] for _ in range(2)]
    for row in both.collect():          # at most twice the alphabet's square
        a, b = row["pair"]
        if a in place and b in place:
            counts[row["random"]][place[a]][place[b]] += row["n"]
    out = []
    for i in range(size):
        whole = [sum(counts[k][i]) for k in (0, 1)]
        mixed = lambda k, j: (1 - UNIFORM) * counts[k][i][j] / whole[k] + UNIFORM / size if whole[k] else 1 / size
        out += [math.log(mixed(1, j)) - math.log(mixed(0, j)) for j in range(size)]
    return out


def log_ratio(run: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a run of the alphabet's characters."""
    table = F.array(*[F.lit(round(x, 6)) for x in model])
    places = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return let(places, lambda p: F.aggregate(
        F.sequence(F.lit(0), F.size(p) - 2), F.lit(0.0),
        lambda a, i: a + F.get(table, F.get(p, i) * len(ALPHABET) + F.get(p, i + 1))))


def _spans(text: Column, model: list[float], min_ratio: float) -> Column:
    """struct<base, spans>: base spans and all spans, sorted by start and kind."""
    base = F.array_sort(F.concat(*[_bare(spans_of(text, *kind)) for kind in BASE]))

    meets = lambda s: lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])

    def block(base):
        bounds = lambda part: F.struct(F.get(part, 0)["start"].alias("start"), F.array_max(
            F.transform(part, lambda b: b["end"])).alias("end"), part.alias("part"))
        return lambda b: let(F.slice(base, b * BLOCK + 1, F.lit(BLOCK)), bounds)

    def both(base):
        # Sorted by start: a run is held against the blocks whose bounds it meets.
        blocks = F.when(F.size(base) > 0, F.transform(F.sequence(
            F.lit(0), F.ceil(F.size(base) / BLOCK).cast("int") - 1), block(base)))
        free = lambda bs: F.filter(spans_of(text, "markov", RUN, 0, 20), lambda s: ~F.coalesce(F.exists(
            bs, lambda b: meets(s)(b) & F.exists(b["part"], meets(s))), F.lit(False)) & (log_ratio(s["value"], model) >= min_ratio))
        return let(blocks, lambda bs: F.struct(base.alias("base"), F.array_sort(F.concat(base, _bare(free(bs)))).alias("spans")))

    return let(base, both)


def find_secrets(docs: DataFrame, model: list[float] | None = None, min_ratio: float = MIN_RATIO) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans`` (base and Markov), sorted by start and kind."""
    model = train(docs) if model is None else model
    names = [c for c in docs.columns if c not in ("base_spans", "spans")]
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                        _spans(F.coalesce(F.col("text"), F.lit("")), model, min_ratio).alias("found"))
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in names], F.col("found.base").alias("base_spans"),
                        F.col("found.spans").alias("spans"))


def _cut(text: Column, spans: Column) -> Column:
    """Text with every span (overlapping ones merged) replaced by ``PLACEHOLDER``."""
    part = lambda t, a, n: F.substring(t, (a + 1).cast("int"), n.cast("int"))

    def whole(spans, before):
        # A block of spans: the text from the end of the spans before it on, cut once.
        def block(b):
            first, size = b * BLOCK, F.least(F.lit(BLOCK), F.size(spans) - b * BLOCK)
            origin = F.get(before, first)
            end = F.greatest(F.get(spans, first + size - 1)["start"], origin)
            return let(part(text, origin, end - origin), lambda t: F.array_join(F.transform(
                F.sequence(first, first + size - 1), lambda i: F.when(
                    F.get(spans, i)["start"] >= F.get(before, i), F.concat(part(
                        t, F.get(before, i) - origin, F.get(spans, i)["start"] - F.get(before, i)), F.lit(PLACEHOLDER))
                ).otherwise(F.lit(""))), ""))

        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(spans) / BLOCK).cast("int") - 1), block)
        last = F.size(spans) - 1
        rest = F.greatest(F.get(before, last), F.get(spans, last)["end"])
        return F.concat(F.array_join(blocks, ""), part(text, rest, F.length(text)))

    return let(spans, lambda s: let(running(F.transform(s, lambda x: x["end"]), lambda a, x: F.greatest(a, x), 0),
                                    lambda before: whole(s, before)))


def redact(docs: DataFrame, model: list[float] | None = None, min_ratio: float = MIN_RATIO) -> DataFrame:
    """``docs`` with every span replaced by ``PLACEHOLDER``; other texts, nulls included,
    and other columns, whatever their names, stay as they are."""
    model = train(docs) if model is None else model
    spans = _spans(F.coalesce(F.col("text"), F.lit("")), model, min_ratio)["spans"]
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), spans.alias("spans"))
    text = F.when(F.size("spans") > 0, _cut(F.col("row.text"), F.col("spans"))).otherwise(F.col("row.text"))
    return found.select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_query(docs: DataFrame) -> DataFrame:
    """Digest: counts of the base kinds, hash of the base spans, all spans."""
    found = find_secrets(docs.select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(_joined("base_spans"), 256).alias("base_sha256"),
                        _joined("spans").alias("spans"))

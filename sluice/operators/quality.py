"""Data-quality operators.

A test is a DataFrame of offending rows: no rows means it passes.  Generic
tests follow the usual semantics of the unique / not_null / relationships /
accepted_values / accepted_range / unique-combination tests; singular
assertions are plain DataFrame queries built from these pieces.  Counting and
grading (warn / error thresholds, freshness) turn tests into one result table.

Every test aggregates before it shuffles: keys are pre-combined per task, so a
key that holds a large share of the rows costs one row per task in the shuffle.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- generic tests

def test_unique(df: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` seen more than once (NULLs ignored)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


def test_unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Combinations of ``cols`` seen more than once (NULL is a value here)."""
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL count of every column in one pass: (column_name, null_count)."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols])
    return one.unpivot([], list(cols), "column_name", "null_count")


def test_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns that hold NULLs, with how many (one scan for all columns)."""
    return null_counts(df, cols).filter(F.col("null_count") > 0)


def column_checks(df: DataFrame, model: str, not_null: Sequence[str] = (),
                  accepted_range: dict[str, tuple] | None = None) -> DataFrame:
    """Several column-level tests of one model in a single scan and one
    aggregate: (test_name, failures) per check.  NULL passes a range check."""
    aggs = [F.count_if(F.col(c).isNull()).cast("bigint").alias(f"not_null_{model}_{c}")
            for c in not_null]
    for c, (lo, hi) in (accepted_range or {}).items():
        outside = ~((F.col(c) >= F.lit(lo)) & (F.col(c) <= F.lit(hi)))
        aggs.append(F.count_if(outside).cast("bigint").alias(f"accepted_range_{model}_{c}"))
    one = df.agg(*aggs)
    return one.unpivot([], one.columns, "test_name", "failures")


def test_relationships(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-NULL child keys without a parent row: (key, n_records).

    Child keys are reduced to distinct values (map-side partial aggregation)
    before the anti-join, so a hot child key is one row in the join.
    """
    keys = (child.filter(F.col(col).isNotNull()).groupBy(col)
                 .agg(F.count(F.lit(1)).alias("n_records")))
    parents = parent.select(F.col(field).alias("_parent_key")).distinct()
    return keys.join(parents, F.col(col) == F.col("_parent_key"), "left_anti")


def test_accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their counts (NULL passes)."""
    return (df.filter(~F.col(col).isin(list(values))).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records")))


def test_accepted_range(df: DataFrame, col: str, min_value=None, max_value=None,
                        inclusive: bool = True) -> DataFrame:
    """Rows whose value is outside [min, max] (NULL passes)."""
    c = F.col(col)
    conds = []
    if min_value is not None:
        conds.append(c >= F.lit(min_value) if inclusive else c > F.lit(min_value))
    if max_value is not None:
        conds.append(c <= F.lit(max_value) if inclusive else c < F.lit(max_value))
    ok = conds[0]
    for extra in conds[1:]:
        ok = ok & extra
    return df.filter(~ok)


# ---------------------------------------------------------------- many tests in one pass

@dataclass(frozen=True)
class Model:
    """A model under test.  ``key`` (with ``line``: the pair) is what must be unique; models
    of one ``family`` share their key, and its ``parent`` must hold every key of the
    others.  ``counts`` names predicates whose rows are counted, ``sums`` exact amounts.
    Without ``key`` only rows, counts and sums are taken."""

    name: str
    df: DataFrame
    key: str | None = None
    line: str | None = None
    family: str | None = None
    parent: bool = False
    counts: Mapping[str, Column] = field(default_factory=dict)
    sums: Mapping[str, Column] = field(default_factory=dict)


def model_facts(models: Sequence[Model]) -> DataFrame:
    """(model, measure, value) from one scan of every model: 'rows'; 'duplicates' (keys seen
    more than once, NULL keys ignored; pairs with NULL as a value); 'orphans' (rows whose
    key the family's parent lacks); every named count and sum.

    The models meet in one tagged aggregate by (model, key, line), combined map-side, which
    is written; a second aggregate by model and one by (family, key) read that table."""
    from ..functions.casts import NUMERIC
    from .joins import materialize

    n_counts = max((len(m.counts) for m in models), default=0)
    n_sums = max((len(m.sums) for m in models), default=0)
    tagged = None
    for i, m in enumerate(models):
        text = lambda c: (F.col(c) if c else F.lit(None)).cast("string")
        counts = [F.when(p, 1).cast("bigint") for p in m.counts.values()]
        sums = [c.cast(NUMERIC) for c in m.sums.values()]
        part = m.df.select(
            F.lit(i).alias("m"), text(m.key).alias("key"), text(m.line).alias("line"),
            *[(counts[j] if j < len(counts) else F.lit(None).cast("bigint")).alias(f"c{j}") for j in range(n_counts)],
            *[(sums[j] if j < len(sums) else F.lit(None).cast(NUMERIC)).alias(f"s{j}") for j in range(n_sums)])
        tagged = part if tagged is None else tagged.unionByName(part)
    totals = [F.sum(f"c{j}").alias(f"c{j}") for j in range(n_counts)] + [F.sum(f"s{j}").alias(f"s{j}") for j in range(n_sums)]
    keys = materialize(tagged.groupBy("m", "key", "line").agg(F.count(F.lit(1)).alias("n"), *totals), "model-keys")

    paired = F.col("m").isin([i for i, m in enumerate(models) if m.line])
    keyed = F.col("m").isin([i for i, m in enumerate(models) if m.key])
    per_model = keys.groupBy("m").agg(
        F.sum("n").alias("rows"), F.count_if(keyed & (F.col("n") > 1) & (paired | F.col("key").isNotNull())).alias("duplicates"), *totals)
    number = lambda c: F.col(c).cast(NUMERIC)
    measures = []
    for i, m in enumerate(models):
        named = {"rows": "rows", **({"duplicates": "duplicates"} if m.key else {}),
                 **{name: f"c{j}" for j, name in enumerate(m.counts)}, **{name: f"s{j}" for j, name in enumerate(m.sums)}}
        measures += [F.when(F.col("m") == i, F.struct(F.lit(m.name).alias("model"), F.lit(k).alias("measure"),
                                                      F.coalesce(number(c), F.lit(0).cast(NUMERIC)).alias("value")))
                     for k, c in named.items()]
    out = per_model.select(F.explode(F.array_compact(F.array(*measures))).alias("x")).select("x.*")

    families = sorted({m.family for m in models if m.family})
    if families:
        family = F.lit(None).cast("int")
        parent = F.lit(False)
        for i, m in enumerate(models):
            if m.family:
                family = F.when(F.col("m") == i, families.index(m.family)).otherwise(family)
                parent = F.when(F.col("m") == i, m.parent).otherwise(parent)
        by_key = keys.where(F.col("key").isNotNull()).withColumn("f", family).where("f IS NOT NULL").withColumn("p", parent)
        children = [i for i, m in enumerate(models) if m.family and not m.parent]
        known = by_key.groupBy("f", "key").agg(F.max("p").alias("p"), *[
            F.sum(F.when(F.col("m") == i, F.col("n"))).alias(f"n{i}") for i in children]).where("NOT p")
        lost = known.agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in children])
        out = out.unionByName(lost.select(F.explode(F.array(*[F.struct(
            F.lit(models[i].name).alias("model"), F.lit("orphans").alias("measure"),
            F.coalesce(number(f"n{i}"), F.lit(0).cast(NUMERIC)).alias("value")) for i in children])).alias("x")).select("x.*"))
    return out


def tests_from_facts(facts: DataFrame, tests: Mapping[str, Callable[[Callable[[str, str], Column]], Column]]) -> DataFrame:
    """(test_name, failures): every test is an expression over facts, given as a function of
    ``value(model, measure)``.  The facts (a few per model) become one row."""
    used: dict[tuple[str, str], str] = {}

    def value(model: str, measure: str) -> Column:
        name = used.setdefault((model, measure), f"v{len(used)}")
        return F.col(name)

    parts = [F.struct(F.lit(name).alias("test_name"), expr(value).cast("bigint").alias("failures")) for name, expr in tests.items()]
    one = facts.agg(*[F.coalesce(F.max(F.when((F.col("model") == m) & (F.col("measure") == k), F.col("value"))),
                                 F.lit(0)).alias(c) for (m, k), c in used.items()])
    return one.select(F.explode(F.array(*parts)).alias("x")).select("x.*")


# ---------------------------------------------------------------- assertions

def row_count_parity(a: DataFrame, b: DataFrame, problem: str,
                     a_name: str = "fct_rows", b_name: str = "stg_rows") -> DataFrame:
    """One row when the two row counts differ, else none."""
    return counts_side_by_side(a, b, problem, a_name, b_name).filter(
        F.col(a_name) != F.col(b_name))


def counts_side_by_side(a: DataFrame, b: DataFrame, problem: str,
                        a_name: str = "fct_rows", b_name: str = "stg_rows") -> DataFrame:
    """Both row counts in one row: one aggregation over the tagged union of the
    two inputs (no join, no cross product; partial counts per task)."""
    tagged = (a.select(F.lit(True).alias("_is_a"))
               .unionByName(b.select(F.lit(False).alias("_is_a"))))
    return tagged.agg(F.count_if(F.col("_is_a")).alias(a_name),
                      F.count_if(~F.col("_is_a")).alias(b_name)).select(
        F.lit(problem).alias("problem"), F.col(a_name), F.col(b_name))


def totals_side_by_side(a: DataFrame, a_value: Column, b: DataFrame, b_value: Column,
                        a_name: str, b_name: str) -> DataFrame:
    """coalesce(sum(a_value), 0) next to coalesce(sum(b_value), 0) and the
    difference, from one aggregation over the tagged union of both inputs."""
    from ..functions.casts import NUMERIC

    tagged = (a.select(F.lit(True).alias("_is_a"), a_value.cast(NUMERIC).alias("_v"))
               .unionByName(b.select(F.lit(False).alias("_is_a"), b_value.cast(NUMERIC).alias("_v"))))
    sums = tagged.agg(
        F.coalesce(F.sum(F.when(F.col("_is_a"), F.col("_v"))), F.lit(0)).alias(a_name),
        F.coalesce(F.sum(F.when(~F.col("_is_a"), F.col("_v"))), F.lit(0)).alias(b_name))
    return sums.select(a_name, b_name, (F.col(a_name) - F.col(b_name)).alias("difference"))


def totals_reconcile(a: DataFrame, a_value: Column, b: DataFrame, b_value: Column,
                     a_name: str, b_name: str, tolerance: float = 0.01) -> DataFrame:
    """One row when the two totals differ by more than ``tolerance``."""
    both = totals_side_by_side(a, a_value, b, b_value, a_name, b_name)
    return both.filter(F.abs(F.col("difference")) > F.lit(tolerance))


def events_out_of_order(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """Rows where ``later`` is present and before ``earlier``."""
    return df.filter(F.col(later).isNotNull() & (F.col(later) < F.col(earlier)))


def liveness(df: DataFrame, cond: Column, name: str = "n") -> DataFrame:
    """One row when no row satisfies ``cond`` (a column gone constant)."""
    return df.agg(F.count_if(cond).cast("bigint").alias(name)).filter(F.col(name) == 0)


# ---------------------------------------------------------------- grading

_CMP = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
        "=": operator.eq, "==": operator.eq, "!=": operator.ne, "<>": operator.ne}


def threshold(rule: str, n: Column) -> Column:
    """'>350', '!=0', '>=1' ... applied to a count column."""
    m = re.fullmatch(r"\s*(>=|<=|!=|<>|==|=|>|<)\s*(\d+)\s*", rule)
    if not m:
        raise ValueError(f"bad threshold {rule!r}")
    return _CMP[m.group(1)](n, F.lit(int(m.group(2))))


@dataclass(frozen=True)
class Severity:
    """Test config: the test errors when ``error_if`` holds for its failure
    count, else warns when ``warn_if`` holds, else passes.  With
    ``severity='warn'`` an error is downgraded to a warning."""

    warn_if: str = "!=0"
    error_if: str = "!=0"
    severity: str = "error"


def grade(n: Column, sev: Severity) -> Column:
    err = threshold(sev.error_if, n)
    warn = threshold(sev.warn_if, n)
    if sev.severity == "warn":
        return F.when(err | warn, F.lit("warn")).otherwise(F.lit("pass"))
    return (F.when(err, F.lit("error")).when(warn, F.lit("warn")).otherwise(F.lit("pass")))


def failure_count(test: DataFrame, name: str, weight: str | None = None) -> DataFrame:
    """One row (test_name, failures) for a test's offending rows.  ``weight``
    names a count column when the test returns grouped rows."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return test.agg(F.coalesce(n, F.lit(0)).cast("bigint").alias("failures")).select(
        F.lit(name).alias("test_name"), "failures")


def grade_tests(tests: dict[str, tuple[DataFrame, Severity, str | None]]) -> DataFrame:
    """All tests in one result table: test_name, failures, warn_if, error_if, status."""
    parts = []
    for name, (df, sev, weight) in tests.items():
        cnt = failure_count(df, name, weight)
        parts.append(cnt.select("test_name", "failures",
                                F.lit(sev.warn_if).alias("warn_if"),
                                F.lit(sev.error_if).alias("error_if"),
                                grade(F.col("failures"), sev).alias("status")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def grade_counts(counts: DataFrame, severities: Mapping[str, Severity] | None = None) -> DataFrame:
    """(test_name, failures) graded: the named severities, the default for all others."""
    special = dict(severities or {})
    default = Severity()
    of = {name: (sev.warn_if, sev.error_if, grade(F.col("failures"), sev)) for name, sev in special.items()}
    picked = []
    for i, otherwise in enumerate((F.lit(default.warn_if), F.lit(default.error_if), grade(F.col("failures"), default))):
        col = otherwise
        for name, facts in of.items():
            col = F.when(F.col("test_name") == name, facts[i] if isinstance(facts[i], Column) else F.lit(facts[i])).otherwise(col)
        picked.append(col)
    return counts.select("test_name", F.col("failures").cast("bigint").alias("failures"), picked[0].alias("warn_if"),
                         picked[1].alias("error_if"), picked[2].alias("status"))


def freshness(df: DataFrame, field: Column, now, warn_after_days: int,
              error_after_days: int) -> DataFrame:
    """Age of the newest ``field`` value at ``now``: pass / warn / error.

    ``now`` is a parameter (a datetime or a Column), never read from the clock
    inside the query, so the result is reproducible.
    """
    now_col = now if isinstance(now, Column) else F.lit(now).cast("timestamp_ntz")
    newest = df.agg(F.max(field).cast("timestamp_ntz").alias("max_loaded_at"))
    # whole seconds between two time-zone-free values: no session zone involved
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now_col.cast("timestamp_ntz"))
    out = (newest.withColumn("age_seconds", age.cast("bigint"))
                 .withColumn("age_days", F.floor(F.col("age_seconds") / 86400).cast("bigint")))
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
               .when(F.col("age_seconds") > error_after_days * 86400, F.lit("error"))
               .when(F.col("age_seconds") > warn_after_days * 86400, F.lit("warn"))
               .otherwise(F.lit("pass")))
    return out.withColumn("status", status)


# ---------------------------------------------------------------- load-time checks

class DataCheckError(ValueError):
    """A load-time check refused the data."""


def require_rows(n: int, what: str) -> None:
    if n == 0:
        raise DataCheckError(f"{what}: no data rows in the source; the table stays as it is")


def require_equal_counts(source_rows: int, loaded_rows: int, what: str) -> None:
    require_rows(source_rows, what)
    if source_rows != loaded_rows:
        raise DataCheckError(
            f"{what}: {loaded_rows} rows loaded of {source_rows} in the source (count mismatch)")


def require_unique_keys(df: DataFrame, keys: Sequence[str], what: str) -> None:
    dups = test_unique_combination(df, keys)
    sample = dups.limit(1).collect()  # existence probe: at most one row comes back
    if sample:
        raise DataCheckError(f"{what}: duplicate {tuple(keys)} in batch, e.g. {sample[0].asDict()}")


def require_columns(columns: Sequence[str], required: Sequence[str], what: str) -> None:
    if not columns:
        raise DataCheckError(f"{what}: no header row")
    missing = [c for c in required if c not in columns]
    if missing:
        raise DataCheckError(f"{what}: missing required column(s): {', '.join(missing)}")

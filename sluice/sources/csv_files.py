"""Raw CSV scans: every column a string, names from the header.

* ``read_raw_csv`` parses with quoted newlines and doubled quotes, keeps a
  quoted empty field as '' and an empty field as NULL, and fails on a malformed
  record instead of skipping it.
* ``count_records`` counts records independently of that parse, from the text
  lines: a record starts on a non-blank line reached with an even number of
  quote characters before it.  Quote counts per line are computed JVM-side;
  each input split is summarised in its own task (mapInPandas over the split's
  (quotes, blank) pairs, in order); only one small row per split is shuffled,
  and the quote parity is carried from split to split per file.
* ``ragged_rows`` lists records whose field count differs from the header, with lines.
* ``read_by_header`` reads many files whose headers may order the columns
  differently: columns are matched by name, never by position.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import DataCheckError, require_columns

# A text no real field holds: only an unquoted empty field becomes NULL.
NULL_SENTINEL = "\u0000sluice-null\u0000"

CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "inferSchema": "false",
    "encoding": "UTF-8",
    "nullValue": NULL_SENTINEL,
    "emptyValue": "",
    "mode": "FAILFAST",
    "enforceSchema": "false",       # a file whose header is another one fails, it is not read by position
}


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_header(spark: SparkSession, path: str, quote: str = '"') -> list[str]:
    """Column names from the header line; an empty source has none.  Folder
    names such as ``load_date=...`` are not columns of the file."""
    opts = {**CSV_OPTIONS, "mode": "PERMISSIVE", "quote": quote, "escape": quote,
            "recursiveFileLookup": "true"}
    return list(spark.read.options(**opts).csv(path).columns)


def read_raw_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                 required: Sequence[str] = (), mode: str = "FAILFAST",
                 extra_options: dict | None = None, quoted_newlines: bool = True) -> DataFrame:
    """All-string scan; ``columns`` defaults to the file's header.

    ``quoted_newlines=False`` states that no field holds a line break: Spark then
    splits files by block.  A field that does hold one fails the load (malformed
    record or count check); it never changes a value."""
    cols = list(columns) if columns is not None else read_header(spark, path)
    require_columns(cols, required, path)
    if not cols:
        raise DataCheckError(f"{path}: no header row")
    opts = {**CSV_OPTIONS, "mode": mode, "multiLine": str(quoted_newlines).lower(), **(extra_options or {})}
    return spark.read.options(**opts).schema(string_schema(cols)).csv(path)


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _header_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, line): the first non-blank line of every file."""
    lines = spark.read.option("recursiveFileLookup", "true").text(_paths(path)).where(
        (F.col("_metadata.file_block_start") == 0) & (F.length("value") > 0)).select(
        F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("at"))
    return lines.groupBy("file").agg(F.min_by("value", "at").alias("line"))


def header_groups(spark: SparkSession, path: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Header -> what to read with it: the given paths where all files share a header, else
    its files.  One row per distinct header line reaches the driver; file names only where
    headers differ.  Files without a line are left out."""
    first = _header_lines(spark, path)
    found = first.groupBy("line").agg(F.min("file").alias("file"), F.count(F.lit(1)).alias("n")).collect()
    names = {}
    for r in found:
        line = r["line"].removeprefix("\ufeff")
        whole = line.count('"') % 2 == 0            # else a name goes on past the line
        names[r["line"]] = tuple(next(csv.reader([line])) if whole else read_header(spark, unquote(r["file"])))
    if len(set(names.values())) <= 1:
        return {header: _paths(path) for header in names.values()}
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in first.collect():
        groups.setdefault(names[r["line"]], []).append(unquote(r["file"]))
    return {h: sorted(groups[h]) for h in sorted(groups)}


def read_by_header(spark: SparkSession, path: str | Sequence[str], what: str, extra_options: dict | None = None,
                   quoted_newlines: bool = True, may_lack_columns: bool = False, required: Sequence[str] = (),
                   file_column: str | None = None) -> DataFrame:
    """All-string scan of files or folders, each file by its own header; columns meet by
    name.  Files that lack a column of the others are refused, or give NULL there.
    ``file_column`` names a column for the path of each row's file."""
    groups = header_groups(spark, path)
    if not groups:
        raise DataCheckError(f"{what}: no header row")
    if len({frozenset(h) for h in groups}) > 1 and not may_lack_columns:
        raise DataCheckError(f"{what}: files with other columns: " + "; ".join(
            f"{', '.join(h)} ({len(of)} file(s), e.g. {of[0].rsplit('/', 1)[-1]})" for h, of in groups.items()))
    out = None
    options = {"recursiveFileLookup": "true", **(extra_options or {})}
    for header, of in groups.items():
        part = read_raw_csv(spark, of, header, required, extra_options=options, quoted_newlines=quoted_newlines)
        if file_column:
            part = part.withColumn(file_column, F.col("_metadata.file_path"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=may_lack_columns)
    return out


def ragged_rows(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """(file, line, record): records whose field count is not the header's, as raw text,
    with the line they begin on.

    The records come from Spark's corrupt-record column; their lines from a scan of the
    text, numbered per split with the lines of the splits before it added.  Of equal
    first lines in a file the first one is named."""
    cols = list(columns) if columns is not None else read_header(spark, path)
    schema = string_schema(cols).add("_corrupt_record", T.StringType())
    opts = {**CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record",
            "recursiveFileLookup": "true",
            "enforceSchema": "true"}      # the schema has one column more than the header
    df = spark.read.options(**opts).schema(schema).csv(_paths(path))
    # referencing the data columns too keeps the full parse (Spark refuses a
    # query on the corrupt-record column alone)
    touches_all = F.length(F.concat_ws("\u0001", *[F.col(c) for c in cols])) >= 0
    found = df.filter(F.col("_corrupt_record").isNotNull() & touches_all).select(
        F.col("_metadata.file_path").alias("file"), F.rtrim(F.col("_corrupt_record")).alias("record")).withColumn(
        "value", F.regexp_extract("record", "^[^\\r\\n]*", 0)).distinct()
    lines = spark.read.option("recursiveFileLookup", "true").text(_paths(path)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.rtrim("value").alias("value"), F.monotonically_increasing_id().alias("at"))
    splits = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    hits = lines.join(found, ["file", "value"]).join(splits, ["file", "block"])
    return hits.groupBy("file", "record").agg(F.min(F.col("at") - F.col("first") + F.col("before") + 1).alias("line"))


def name_ragged(spark: SparkSession, path: str | Sequence[str], what: str, most: int = 5) -> None:
    """After a failed read: raise an error that names ragged records, if there are any."""
    for header, of in header_groups(spark, path).items():
        bad = ragged_rows(spark, of, header).orderBy("file", "line").limit(most).collect()
        if bad:
            raise DataCheckError(f"{what}: records with a field count other than the header's: " + "; ".join(
                f"{unquote(r['file']).rsplit('/', 1)[-1]} line {r['line']}: {r['record'][:80]!r}" for r in bad))


_SUMMARY = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("parity", T.IntegerType()),
    T.StructField("starts_even", T.LongType()),
    T.StructField("starts_odd", T.LongType()),
    T.StructField("lines", T.LongType()),
])


def line_facts(spark: SparkSession, path: str | Sequence[str], quote: str = '"') -> DataFrame:
    """One row per text line, in split order: (file, block, quotes, blank).

    Quote counts and blank flags are computed JVM-side (codegen); only these
    two small numbers per line cross into Python.  A byte-order mark at the
    start of a file is ignored.
    """
    value = F.when(F.col("_metadata.file_block_start") == 0,
                   F.regexp_replace("value", "^\\ufeff", "")).otherwise(F.col("value"))
    return spark.read.option("recursiveFileLookup", "true").text(_paths(path)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        (F.length(value) - F.length(F.replace(value, F.lit(quote), F.lit(""))))
        .cast("int").alias("quotes"),
        (F.length(value) == 0).alias("blank"))


def _summarise_splits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per input split, in line order: quote parity of the whole split and the
    number of record starts if the split begins outside / inside quotes."""
    state: dict[tuple[str, int], list[int]] = {}
    order: list[tuple[str, int]] = []
    for pdf in batches:
        if pdf.empty:
            continue
        quotes = pdf["quotes"].to_numpy(dtype=np.int64)
        blank = pdf["blank"].to_numpy(dtype=bool)
        files = pdf["file"].to_numpy()
        blocks = pdf["block"].to_numpy(dtype=np.int64)
        # boundaries of consecutive runs of the same split inside this batch
        change = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        bounds = np.concatenate(([0], change, [len(pdf)]))
        for a, b in zip(bounds[:-1], bounds[1:]):
            k = (files[a], int(blocks[a]))
            st = state.get(k)
            if st is None:
                st = state[k] = [0, 0, 0, 0]
                order.append(k)
            st[3] += int(b - a)
            q = quotes[a:b]
            before = (st[0] + np.cumsum(q) - q) % 2
            live = ~blank[a:b]
            st[1] += int(np.count_nonzero(live & (before == 0)))
            st[2] += int(np.count_nonzero(live & (before == 1)))
            st[0] = int((st[0] + q.sum()) % 2)
    if order:
        yield pd.DataFrame({
            "file": [k[0] for k in order], "block": [k[1] for k in order],
            "parity": [state[k][0] for k in order],
            "starts_even": [state[k][1] for k in order],
            "starts_odd": [state[k][2] for k in order],
            "lines": [state[k][3] for k in order]})


def count_records(spark: SparkSession, path: str | Sequence[str], has_header: bool = True,
                  quote: str = '"') -> DataFrame:
    """(file, records): data records per file, blank lines not counted.
    ``quote`` is the quote character (doubled inside quoted fields)."""
    splits = line_facts(spark, path, quote).mapInPandas(_summarise_splits, _SUMMARY)
    w = (Window.partitionBy("file").orderBy("block")
         .rowsBetween(Window.unboundedPreceding, -1))
    offset = F.coalesce(F.sum("parity").over(w), F.lit(0)) % 2
    per_split = splits.withColumn(
        "records", F.when(offset == 0, F.col("starts_even")).otherwise(F.col("starts_odd")))
    per_file = per_split.groupBy("file").agg(F.sum("records").alias("records"))
    if has_header:
        per_file = per_file.withColumn("records", F.greatest(F.col("records") - 1, F.lit(0)))
    return per_file.withColumn("records", F.col("records").cast("bigint"))


def total_records(spark: SparkSession, path: str | Sequence[str], has_header: bool = True,
                  quote: str = '"') -> int:
    row = count_records(spark, path, has_header, quote).agg(F.sum("records")).first()
    return int(row[0] or 0)

"""Value histograms and the simple column aggregates.

``value_histogram`` is the shared intermediate of profiling: one scan and one shuffle of
``(column, value)`` pairs that map tasks have already counted, instead of several scans per
column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyscout.functions.text import as_text, col, normalize, not_blank
from keyscout.sources.tables import Tables, scan_by_dates, usable_columns

FIELD = ["sys_code", "table_code", "col_code"]


def long_values(tables: Tables, columns: Mapping | None = None) -> DataFrame:
    """``(sys_code, table_code, col_code, value)`` of all tables, values right-trimmed.

    ``columns`` restricts a table to some columns, so the scan reads only those.
    """
    parts = []
    for (sys_code, table_code), df in tables.items():
        names = usable_columns(df) if columns is None else list(columns.get((sys_code, table_code), ()))
        if not names:
            continue
        wide = df.select([normalize(c).alias(c) for c in names])
        parts.append(
            wide.unpivot([], [col(c) for c in names], "col_code", "value").select(
                F.lit(sys_code).alias("sys_code"),
                F.lit(table_code).alias("table_code"),
                "col_code",
                "value",
            )
        )
    if not parts:
        raise ValueError("no columns to read")
    return reduce(DataFrame.unionByName, parts)


def value_histogram(df: DataFrame) -> DataFrame:
    """``(col_code, value, n)``: how often each right-trimmed value occurs per column."""
    values = long_values({("", ""): df})
    return values.groupBy("col_code", "value").agg(F.count(F.lit(1)).alias("n"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("records"))


def row_count_by_dates(df: DataFrame, dates: str | Sequence[str], date_col: str) -> DataFrame:
    return row_count(scan_by_dates(df, dates, date_col))


def distinct_count(df: DataFrame) -> DataFrame:
    """Distinct right-trimmed values per column; blank counts as one value."""
    return value_histogram(df).groupBy("col_code").agg(F.count(F.lit(1)).alias("distinct"))


def default_value(df: DataFrame) -> DataFrame:
    """Whether a column holds one and the same value in all non-blank rows."""
    filled = F.count_if(F.col("value") != "")
    return value_histogram(df).groupBy("col_code").agg((filled == 1).alias("default_value"))


def distinct_tuples(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of distinct tuples; tuples with a NULL part are not counted."""
    whole = reduce(lambda a, b: a & b, [col(c).isNotNull() for c in columns])
    tuples = df.where(whole).select([col(c).cast("string").alias(c) for c in columns]).distinct()
    return tuples.agg(F.count(F.lit(1)).alias("tuples"))


def length_range(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Least and greatest length of the non-blank right-trimmed values; 0 when there are none.

    One wide aggregate over one scan, so nothing but one row per task is shuffled.
    """
    names = list(columns) if columns is not None else usable_columns(df)
    sizes = df.select([F.when(not_blank(c), F.length(normalize(c))).alias(c) for c in names])
    bounds = sizes.agg(
        *[F.struct(F.min(col(c)).alias("lo"), F.max(col(c)).alias("hi")).alias(c) for c in names]
    )
    return bounds.unpivot([], [col(c) for c in names], "col_code", "bounds").select(
        "col_code",
        F.coalesce("bounds.lo", F.lit(0)).alias("min_len"),
        F.coalesce("bounds.hi", F.lit(0)).alias("max_len"),
    )


def _compare_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], equal, counted) -> DataFrame:
    """One row per pair: agreeing and disagreeing rows, all in one wide aggregate per chunk."""
    outputs = []
    for start in range(0, len(pairs), PAIRS_PER_PASS):
        chunk = pairs[start : start + PAIRS_PER_PASS]
        sums = df.agg(
            *[
                F.struct(
                    F.lit(a).alias("left_col"),
                    F.lit(b).alias("right_col"),
                    F.count_if(counted(a, b) & equal(a, b)).alias("agree"),
                    F.count_if(counted(a, b) & ~equal(a, b)).alias("differ"),
                ).alias(f"p{i}")
                for i, (a, b) in enumerate(chunk)
            ]
        )
        outputs.append(sums.select(F.inline(F.array(*[f"p{i}" for i in range(len(chunk))]))))
    return reduce(DataFrame.unionByName, outputs)


PAIRS_PER_PASS = 200  # keeps one aggregate's generated code within the JVM's limits


def columns_same(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pairs of columns that agree in more than one row and differ in none, blanks aside."""

    def equal(a: str, b: str) -> Column:
        return normalize(a) == normalize(b)

    def filled(a: str, b: str) -> Column:
        return (normalize(a) != "") & (normalize(b) != "")

    verdict = (F.col("agree") > 1) & (F.col("differ") == 0)
    return _compare_pairs(df, pairs, equal, filled).select(
        "left_col", "right_col", verdict.alias("same")
    )


def columns_equal(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """As ``columns_same`` over all rows, a blank being a value like any other."""

    def equal(a: str, b: str) -> Column:
        return normalize(a) == normalize(b)

    verdict = (F.col("agree") > 1) & (F.col("differ") == 0)
    return _compare_pairs(df, pairs, equal, lambda a, b: F.lit(True)).select(
        "left_col", "right_col", verdict.alias("equals")
    )


def key_cooccurrence(keyed: DataFrame) -> DataFrame:
    """Which key columns share values: ``(key_words, values)``, most values first.

    Input rows are ``(key_word, pk_value)``. The set per value holds each key column at most
    once, and repeats are combined in the map tasks.
    """
    sets = keyed.groupBy("pk_value").agg(
        F.array_sort(F.collect_set("key_word")).alias("words")
    )
    shared = sets.where(F.size("words") > 1)
    return (
        shared.groupBy(F.array_join("words", ",").alias("key_words"))
        .agg(F.count(F.lit(1)).alias("n_values"))
        .orderBy(F.desc("n_values"), "key_words")
    )

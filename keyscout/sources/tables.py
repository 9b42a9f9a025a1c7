"""Scans of source tables: column choice, load dates, load modes, projections, samples."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyscout import defaults
from keyscout.functions.text import as_text, col, normalize, not_blank
from keyscout.operators.consolidate import latest_per_key
from keyscout.session import written

TableKey = tuple[str, str]
Tables = Mapping[TableKey, DataFrame]

_SKIPPED_TYPES = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)


def usable_columns(
    df: DataFrame, ignored: Iterable[str] = defaults.IGNORED_COLUMN_FRAGMENTS
) -> list[str]:
    """Columns that can be analysed: not technical, not nested, not binary."""
    ignored = tuple(ignored)
    return [
        f.name
        for f in df.schema.fields
        if not isinstance(f.dataType, _SKIPPED_TYPES) and not any(i in f.name for i in ignored)
    ]


def blank_nulls(df: DataFrame) -> DataFrame:
    """All usable columns as text with NULL as blank, untrimmed."""
    return df.select([as_text(c).alias(c) for c in usable_columns(df)])


def normalized(df: DataFrame) -> DataFrame:
    """All usable columns as right-trimmed text with NULL as blank."""
    return df.select([normalize(c).alias(c) for c in usable_columns(df)])


def list_tables(spark: SparkSession, schema: str, prefix: str = "") -> list[str]:
    """Names of a schema's tables with a prefix, without retired copies."""
    names = (t.name for t in spark.catalog.listTables(schema))
    # Name parts of retired copies.
    return sorted(
        f"{schema.lower()}.{n}"
        for n in names
        if n.startswith(prefix) and "old" not in n and "bak" not in n
    )


# ---- load dates -------------------------------------------------------------------------

def date_window(start: str, offset: int) -> list[str]:
    """``abs(offset)`` days from ``start`` on, backwards if negative, as sorted yyyyMMdd."""
    first = datetime.strptime(start, "%Y%m%d")
    step = -1 if offset < 0 else 1
    return sorted((first + timedelta(days=step * i)).strftime("%Y%m%d") for i in range(abs(offset)))


def date_window_column(start: Column, offset: int) -> Column:
    """The same as an array column, for a start date that is data."""
    days = abs(offset)
    day = F.to_date(start, "yyyyMMdd")
    low = F.date_sub(day, days - 1) if offset < 0 else day
    high = day if offset < 0 else F.date_add(day, days - 1)
    listed = F.transform(F.sequence(low, high), lambda d: F.date_format(d, "yyyyMMdd"))
    return listed if days else F.array().cast("array<string>")


def scan_by_dates(
    df: DataFrame, dates: str | Sequence[str], date_col: str = defaults.LOAD_DATE
) -> DataFrame:
    """Rows of some load dates. A plain ``IN`` filter, so partitions are pruned."""
    wanted = [dates] if isinstance(dates, str) else list(dates)
    return df.where(col(date_col).isin(wanted))


def load_mode(
    df: DataFrame,
    mode: str,
    dates: Sequence[str],
    date_col: str = defaults.LOAD_DATE,
    key: Sequence[str] = (),
) -> DataFrame:
    """Rows to analyse: F5 the last full snapshot, I all increments, IU the newest row per key."""
    dates = sorted(dates)
    if mode == "F5":
        return scan_by_dates(df, dates[-1], date_col)
    if mode == "I":
        return scan_by_dates(df, dates, date_col)
    if mode == "IU":
        return latest_per_key(df, key, date_col, dates[0], dates[-1])
    raise ValueError(f"unknown load mode {mode!r}")


def save_by_date(df: DataFrame, folder: str, date_col: str = defaults.LOAD_DATE) -> None:
    """Write rows to one folder per load date.

    The dates that ``df`` has are replaced whole and other dates stay, so that a repeated load changes nothing.
    ``df`` may be derived from the folder. Rows are gathered by date before, and a date with many rows is split.
    """
    gathered = df.hint("rebalance", col(date_col))
    gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(folder)


def read_by_date(spark: SparkSession, folder: str, date_col: str = defaults.LOAD_DATE) -> DataFrame:
    """What ``save_by_date`` wrote, with the load date as text; filters on it choose folders."""
    inferred = spark.read.parquet(folder).schema
    fields = [f if f.name != date_col else T.StructField(date_col, T.StringType()) for f in inferred.fields]
    return spark.read.schema(T.StructType(fields)).parquet(folder)


# ---- projections ------------------------------------------------------------------------

def column_values(df: DataFrame, column: str, distinct: bool = False) -> DataFrame:
    values = df.select(col(column).cast("string").alias(column))
    return values.distinct() if distinct else values


def key_tuples(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> DataFrame:
    """Right-trimmed tuples; NULL stays NULL."""
    tuples = df.select([F.rtrim(col(c).cast("string")).alias(c) for c in columns])
    return tuples if limit is None else tuples.limit(limit)


def key_tuples_nonblank(
    df: DataFrame, columns: Sequence[str], limit: int | None = None
) -> DataFrame:
    """Tuples in which every part has content."""
    present = reduce(lambda a, b: a & b, [not_blank(c) for c in columns])
    return key_tuples(df.where(present), columns, limit)


def distinct_projection(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Distinct rows over some columns, renamed ``{column: alias}``."""
    return df.select([col(c).cast("string").alias(a) for c, a in columns.items()]).distinct()


def sample_rows(df: DataFrame, limit: int | str = "all", seed: int | None = None) -> DataFrame:
    """``limit`` random rows of the usable columns with NULL as blank, or all rows."""
    rows = blank_nulls(df)
    return rows if limit == "all" else exact_sample(rows, int(limit), seed)


#: Bits of a random key, bits by which a prefix of it grows, and rows of one prefix that are few enough to sort.
KEY_BITS = 52
PREFIX_BITS = 12
PREFIX_ROWS = 10_000


def exact_sample(rows: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """``n`` random rows, all rows if there are not more.

    Every row gets a random key and the rows with the ``n`` smallest keys are the sample. A bound on the keys that
    leaves a little more than ``n`` rows is known beforehand; only these are written. Histograms of key prefixes, of
    at most 4096 counts each, then find the key up to which rows are taken, so that only the rows of one short
    prefix are ever sorted.
    """
    if n <= 0:
        return rows.limit(0)
    total = rows.count()
    if n >= total:
        return rows
    keyed = rows.withColumn("_key", F.floor(F.rand(seed) * F.lit(float(1 << KEY_BITS))).cast("long"))
    share = min(1.0, (n + 8 * n**0.5 + 64) / total)
    drawn = written(keyed.where(F.col("_key") < F.lit(int(share * (1 << KEY_BITS)))))
    if drawn.count() < n:  # by chance, less than once in 10^12 samples
        drawn = written(keyed)
    taken, prefix, bits, size = 0, 0, 0, PREFIX_ROWS + 1
    while size > PREFIX_ROWS and bits < KEY_BITS:
        low = prefix << (KEY_BITS - bits)
        here = drawn.where(F.col("_key").between(low, low + (1 << (KEY_BITS - bits)) - 1))
        bits = min(bits + PREFIX_BITS, KEY_BITS)
        counts = here.groupBy(F.shiftright("_key", KEY_BITS - bits).alias("prefix")).count()
        for prefix, size in sorted((r["prefix"], r["count"]) for r in counts.collect()):
            if taken + size >= n:
                break
            taken += size
    shift = KEY_BITS - bits
    below = drawn.where(F.col("_key") < F.lit(prefix << shift))
    last = drawn.where(F.shiftright("_key", shift) == F.lit(prefix)).orderBy("_key").limit(n - taken)
    return below.unionByName(last).drop("_key")


def keyed_values(keys: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``(key_word, pk_value)`` rows of many key columns: ``{key_word: (df, column)}``."""
    parts = [
        df.select(F.lit(word).alias("key_word"), col(c).cast("string").alias("pk_value"))
        for word, (df, c) in keys.items()
    ]
    return reduce(DataFrame.unionByName, parts)


SPREAD_BYTES = 1 << 18


def spread(df: DataFrame) -> DataFrame:
    """Split an input that has fewer scan tasks than the session has cores.

    Only files that cannot be split, which are small, end up here; large inputs already have
    more scan tasks than cores and are returned as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution()
    if int(plan.optimizedPlan().stats().sizeInBytes()) < SPREAD_BYTES:
        return df
    if plan.toRdd().getNumPartitions() * 2 > cores:
        return df
    return df.repartition(cores)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a folder of tables."""
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))

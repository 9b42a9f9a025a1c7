"""Consolidation of insert/update feeds: the newest row of every key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyscout import defaults
from keyscout.functions.text import col


def consolidation_end(start: str, offset: int) -> str:
    """Last load date of a consolidation run: start + offset days, inclusive."""
    return (datetime.strptime(start, "%Y%m%d") + timedelta(days=offset)).strftime("%Y%m%d")


def latest_per_key(
    df: DataFrame,
    key: Sequence[str],
    order_col: str = defaults.LOAD_DATE,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """The newest row per key among rows with ``start <= order_col <= end``.

    An aggregate rather than ``row_number``: map tasks reduce a hot key to one row before the
    shuffle, so no task holds all versions of a key; the aggregates sort, since their buffer is a whole
    row. Equal newest rows are decided by the other columns, which makes the result repeatable.
    """
    rows = df
    if start is not None:
        rows = rows.where(col(order_col) >= F.lit(start))
    if end is not None:
        rows = rows.where(col(order_col) <= F.lit(end))
    rest = [c for c in df.columns if c not in key and c != order_col]
    unorderable = (T.MapType, T.VariantType)
    ranked = [c for c in rest if not isinstance(df.schema[c].dataType, unorderable)]
    rank = F.struct(*[col(c) for c in [order_col, *ranked]])
    payload = F.struct(*[col(c) for c in df.columns if c not in key])
    newest = rows.groupBy(*[col(c) for c in key]).agg(F.max_by(payload, rank).alias("_row"))
    return newest.select(
        *[
            (col(c) if c in key else F.col("_row").getField(c)).alias(c)
            for c in df.columns
        ]
    )

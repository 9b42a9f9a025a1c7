"""Row numbers over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyscout.session import written


def numbered(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """``df`` with the numbers 1, 2, ... in the order of ``order`` as the column ``name``.

    Rows are dealt to ranges of the order and counted there; a range's numbers start behind the rows of the earlier
    ranges, so no task holds all rows. Rows equal in ``order`` are numbered in any order, and a random last part of
    the order splits many of them over several ranges. The ranges are written once, since another evaluation might
    number differently.
    """
    salted = df.withColumn("_salt", F.rand(0))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = salted.repartitionByRange(ranges, *order, "_salt").sortWithinPartitions(*order, "_salt")
    rows = written(dealt.drop("_salt").withColumn("_place", F.monotonically_increasing_id()))
    # The place holds the number of the range above 33 bits for the row's place in it.
    of_range = F.shiftright("_place", 33)
    counts = rows.groupBy(of_range.alias("_range")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = counts.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    within = F.col("_place") - F.shiftleft(F.col("_range"), 33)
    joined = rows.withColumn("_range", of_range).join(starts, "_range")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_start") + within + 1).alias(name))

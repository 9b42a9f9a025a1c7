"""Text form of FDs, one determinant per line: ``[a,b]:c,d``, and ``[]:x`` for constants.

Separators within names are escaped when texts are written, and restored when they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscout.functions.text import escaped, unescaped
from keyscout.operators.fd import TABLE


def parse_fd_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``(lhs, rhs, fd_level)`` from text lines, one row per right-hand side."""
    clean = F.regexp_replace(F.col(value), r"[\x00\n]", "")
    body = F.regexp_replace(F.split(clean, ":")[0], r"[\[\]]", "")
    lhs: Column = F.when(body == "", F.array().cast("array<string>")).otherwise(
        F.array_sort(F.transform(F.split(body, ","), unescaped))
    )
    listed = lines.where(F.length(clean) > 0).select(
        lhs.alias("lhs"), F.explode(F.transform(F.split(F.split(clean, ":")[1], ","), unescaped)).alias("rhs")
    )
    return listed.withColumn("fd_level", F.size("lhs"))


def read_fd_text(spark: SparkSession, path: str) -> DataFrame:
    return parse_fd_lines(spark.read.text(path))


def fd_lines(fds: DataFrame) -> DataFrame:
    """``(sys_code, table_code, value)``: the lines of each table's FDs."""
    grouped = fds.groupBy(*TABLE, "lhs").agg(F.array_sort(F.collect_set("rhs")).alias("_rhs"))
    text = F.concat(
        F.lit("["), F.array_join(F.transform("lhs", escaped), ","), F.lit("]:"), F.array_join(F.transform("_rhs", escaped), ",")
    )
    return grouped.select(*TABLE, text.alias("value"))


def stored_fds(fds: DataFrame) -> DataFrame:
    """FDs in the flat stored form: ``lhs`` as comma-separated text."""
    return fds.select(*TABLE, F.array_join(F.transform("lhs", escaped), ",").alias("lhs"), "rhs", F.size("lhs").alias("fd_level"))


def load_stored_fds(stored: DataFrame) -> DataFrame:
    lhs = F.when(F.col("lhs") == "", F.array().cast("array<string>")).otherwise(
        F.array_sort(F.transform(F.split("lhs", ","), unescaped))
    )
    return stored.select(*TABLE, lhs.alias("lhs"), "rhs", F.col("fd_level").cast("int").alias("fd_level"))

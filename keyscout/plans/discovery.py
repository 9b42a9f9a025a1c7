"""Whole analyses composed from the operators: tables in, schema knowledge out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscout import defaults
from keyscout.operators.dimension import dim_division, relation_edges
from keyscout.operators.fd import FD_SCHEMA, discover_fds
from keyscout.operators.fk import discover_fk, discover_joint_fk, fk_tables
from keyscout.operators.keys import (
    candidate_keys, candidate_keys_sql, choose_keys, joint_key_rows, verify_joint_keys, verify_single_keys, whole_row_keys,
)
from keyscout.operators.profile import profile_tables
from keyscout.operators.same import field_clusters, same_fields
from keyscout.session import cut_lineage, settled, written
from keyscout.sources.tables import TableKey, Tables, load_mode, usable_columns


CONCURRENT_TABLES = 4


def column_rows(spark: SparkSession, tables: Tables) -> DataFrame:
    """``(sys_code, table_code, col_code)`` of all usable columns."""
    rows = [(*key, c) for key, df in sorted(tables.items(), key=lambda item: item[0]) for c in usable_columns(df)]
    return spark.createDataFrame(rows, "sys_code string, table_code string, col_code string")


def fds_of_tables(spark: SparkSession, tables: Tables, max_lhs: int = defaults.MAX_LHS) -> DataFrame:
    """Minimal FDs of all tables; their number depends on the schema, not on the data."""

    def mine(item) -> DataFrame:
        (sys_code, table_code), df = item
        return discover_fds(df, max_lhs, sys_code, table_code)

    # Each table is a chain of short jobs; several chains at once keep the executors busy.
    with ThreadPoolExecutor(CONCURRENT_TABLES) as pool:
        parts = list(pool.map(mine, sorted(tables.items(), key=lambda item: item[0])))
    return reduce(DataFrame.unionAll, parts, spark.createDataFrame([], FD_SCHEMA))


def discover_pk(
    spark: SparkSession,
    tables: Tables,
    profile: DataFrame | None = None,
    fds: DataFrame | None = None,
    max_lhs: int = defaults.MAX_LHS,
    one_step: bool = False,
    threshold: int | None = None,
    tolerance: int = 5,
    max_fds: int | None = None,
) -> DataFrame:
    """Primary keys of all tables: FDs, candidates, verification on the data, choice.

    ``one_step`` takes candidates from single FD steps instead of the closure search. A table that
    has a profile and no FD has its whole row as a candidate. ``threshold``, ``tolerance`` and
    ``max_fds`` relax the tests as described at the operators; they are off by default.
    """
    profile = settled(profile_tables(tables) if profile is None else profile)
    fds = settled(fds_of_tables(spark, tables, max_lhs) if fds is None else fds)
    columns = column_rows(spark, tables)
    found = candidate_keys_sql(fds, columns) if one_step else candidate_keys(fds, columns, max_fds=max_fds)
    candidates = cut_lineage(found.unionByName(whole_row_keys(fds, columns, profile)))
    single = verify_single_keys(candidates, profile, threshold, tolerance)
    joint = verify_joint_keys(candidates, profile, tables, threshold, tolerance)
    return choose_keys(single, joint)


@dataclass(frozen=True)
class Load:
    """Which rows of a table with load dates are analysed: ``mode`` and its parameters as in ``load_mode``."""

    mode: str
    dates: Sequence[str]
    date_col: str = defaults.LOAD_DATE
    key: Sequence[str] = ()


def loaded(tables: Tables, loads: Mapping[TableKey, Load]) -> Tables:
    """``tables`` with the rows that ``loads`` names, without their load dates; other tables as they are.

    The newest rows per key are written once, since every stage reads its tables several times.
    """

    def load(df: DataFrame, how: Load) -> DataFrame:
        rows = load_mode(df, how.mode, how.dates, how.date_col, how.key).drop(how.date_col)
        return written(rows) if how.mode == "IU" else rows

    return {key: load(df, loads[key]) if key in loads else df for key, df in tables.items()}


def discover_schema(
    spark: SparkSession,
    tables: Tables,
    max_lhs: int = defaults.MAX_LHS,
    systems: Sequence[str] | None = None,
    skip_autoincrement: bool = True,
    min_avg_len: float = defaults.FK_MIN_AVG_LEN,
    loads: Mapping[TableKey, Load] | None = None,
    one_step: bool = False,
    key_threshold: int | None = None,
    key_tolerance: int = 5,
    max_fds: int | None = None,
    fk_threshold: float = defaults.FK_RATIO,
    small: int = 0,
    small_threshold: float = 1.0,
    max_misses: int | None = None,
    with_fd: bool = True,
) -> dict[str, DataFrame]:
    """All stages in order; every result is cut from its lineage before the next stage.

    ``loads`` chooses rows by load date. The other options are those of ``discover_pk`` (``threshold`` and ``tolerance``
    with ``key_`` before them), ``discover_fk``, ``discover_joint_fk`` and ``same_fields``.
    """
    tables = loaded(tables, loads or {})
    profile = cut_lineage(profile_tables(tables))
    fds = settled(fds_of_tables(spark, tables, max_lhs))
    keys = cut_lineage(
        discover_pk(spark, tables, profile, fds, max_lhs, one_step, key_threshold, key_tolerance, max_fds)
    )
    single = keys.where(F.col("kind") == "single").select(
        "sys_code", "table_code", F.element_at("cols", 1).alias("col_code")
    )
    ratios = (fk_threshold, small, small_threshold)
    fks = cut_lineage(discover_fk(tables, single, profile, systems, skip_autoincrement, min_avg_len, *ratios))
    joint_fks = cut_lineage(
        discover_joint_fk(tables, joint_key_rows(keys), profile, systems, min_avg_len, *ratios, max_misses)
    )
    detail = same_fields(tables, fks, fds, profile, joint_fks, fk_tables(fks, joint_fks), with_fd=with_fd)
    return {
        "profile": profile,
        "fds": fds,
        "keys": keys,
        "fks": fks,
        "joint_fks": joint_fks,
        "same_detail": detail,
        "same_cluster": field_clusters(detail, profile),
        "dim_result": dim_division(relation_edges(fds, fks)),
    }

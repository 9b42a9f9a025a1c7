"""Which tables are due for which stage: predicates over configuration and status rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyscout import defaults
from keyscout.operators.consolidate import latest_per_key
from keyscout.operators.fd import TABLE


def latest_status(log: DataFrame) -> DataFrame:
    """The current status per table and stage from the append-only status log.

    Log rows are ``(sys_code, table_code, stage, code, started, ended)``.
    """
    return latest_per_key(log, [*TABLE, "stage"], "ended")


def status_columns(latest: DataFrame, stages: tuple[str, ...]) -> DataFrame:
    """One row per table with a ``<stage>_sche`` column for each stage; '0' where none is known."""
    codes = [
        F.coalesce(F.max(F.when(F.col("stage") == s, F.col("code"))), F.lit("0")).alias(f"{s}_sche")
        for s in stages
    ]
    return latest.groupBy(*TABLE).agg(*codes)


STAGES = ("feature", "fd", "pk", "fk", "fd_check", "joint_fk")


def worklist(
    conf: DataFrame,
    status: DataFrame,
    records: DataFrame,
    fd_counts: DataFrame,
    full_rows: int | None = None,
    sample_rows: int = 200_000,
) -> DataFrame:
    """``(sys_code, table_code, stage, variant)``: every table due for a stage.

    ``conf`` has ``<stage>_flag`` columns and the two foreign key modes, ``status`` the
    ``<stage>_sche`` codes, ``records`` the row counts and ``fd_counts`` the FDs per table.
    ``variant`` says how: full or sampled data, SQL or search for keys, or the systems to
    look at. Two-level FDs use all data; only with ``full_rows`` do tables from that size on
    use a sample of ``sample_rows``.
    """
    joined = (
        conf.join(status, TABLE)
        .join(records.select(*TABLE, "records"), TABLE, "left")
        .join(fd_counts.select(*TABLE, "n_fds"), TABLE, "left")
    )

    def on(flag: str) -> Column:
        return F.col(flag) == "1"

    def at(sche: str, *codes: str) -> Column:
        return F.col(sche).isin(*codes)

    checking = on("fd_check_flag") & at("fd_check_sche", "0") & at("fd_sche", "2")
    volume = F.lit("all")
    if full_rows is not None:
        volume = F.when(F.col("records") < full_rows, "all").otherwise(str(sample_rows))
    few_fds = F.col("n_fds").between(1, defaults.ONE_STEP_FDS)
    due = [
        ("feature", on("feature_flag") & at("feature_sche", "0"), F.lit("")),
        ("fd_full", on("fd_flag") & at("fd_sche", "0", "2"), F.lit("")),
        (
            "fd_level2",
            on("fd_flag") & at("fd_sche", "3", "4") & at("feature_sche", "1") & F.col("records").isNotNull(),
            volume,
        ),
        ("fd_merge", checking, F.lit("")),
        ("fd_check", checking, F.lit("")),
        (
            "pk",
            on("pk_flag") & ~at("fd_sche", "0", "2", "3", "4") & at("pk_sche", "0"),
            F.when(few_fds, "sql").otherwise("search"),
        ),
        ("fk", on("fk_flag") & at("fk_sche", "0") & at("pk_sche", "1"), F.col("fk_ana_mode")),
        (
            "joint_fk",
            on("joint_fk_flag") & at("pk_sche", "1") & at("joint_fk_sche", "0"),
            F.col("joint_fk_ana_mode"),
        ),
    ]
    entries = [
        F.when(condition, F.struct(F.lit(stage).alias("stage"), variant.alias("variant")))
        for stage, condition, variant in due
    ]
    listed = F.array_compact(F.array(*entries))
    return joined.select(*TABLE, F.inline(listed))


def fk_systems(conf: DataFrame, mode: str = "all") -> DataFrame:
    """Systems whose tables are searched for foreign keys: all configured, or those listed."""
    systems = conf.select("sys_code").distinct()
    if mode == "all":
        return systems
    return systems.where(F.col("sys_code").isin(mode.split(",")))


def load_settings(conf: DataFrame, default_mode: str = "F5") -> DataFrame:
    """Load mode, dates and consolidated table per table; the mode defaults to full snapshots."""
    return conf.select(
        *TABLE,
        F.coalesce("ana_alg", F.lit(default_mode)).alias("load_mode"),
        "etl_date",
        "date_offset",
        "trans_table_code",
    )

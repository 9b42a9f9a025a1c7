"""Candidate keys from FDs, and their verification on the data."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyscout import defaults
from keyscout.functions.text import col, counted_as, is_minus_zero
from keyscout.operators.covers import extended
from keyscout.operators.fd import TABLE, applicable, fd_degrees
from keyscout.session import written
from keyscout.sources.tables import TableKey, Tables


def _none() -> Column:
    return F.array().cast("array<string>")


def _constants(rules: DataFrame) -> DataFrame:
    """``(sys_code, table_code, constants)`` of the tables with constant columns."""
    return rules.where(F.size("lhs") == 0).groupBy(*TABLE).agg(F.collect_set("rhs").alias("constants"))


def _fire(sets: DataFrame, fds: DataFrame) -> DataFrame:
    """One round: every set gains the right-hand sides of the FDs it satisfies.

    The gains come from the FDs of the set's own table and are collected per set, so they
    are bounded by the number of columns.
    """
    gains = (
        applicable(sets, "attrs", fds)
        .where(~F.array_contains("attrs", F.col("rhs")))
        .groupBy(*TABLE, "start")
        .agg(F.collect_set("rhs").alias("gain"))
    )
    joined = sets.join(gains, [*TABLE, "start"], "left")
    grown = F.array_sort(F.array_union("attrs", F.coalesce("gain", _none())))
    return joined.select(*TABLE, "start", grown.alias("attrs"), F.col("gain").isNotNull().alias("grew"))


def fd_closure(fds: DataFrame, starts: DataFrame) -> DataFrame:
    """Attribute closure of each ``(sys_code, table_code, start)`` set: adds ``closure``.

    Constant columns belong to every closure. Sets that stop growing leave the loop, which
    ends after at most as many rounds as there are columns.
    """
    rules = written(fds.select(*TABLE, "lhs", "rhs").distinct())
    start = F.array_sort(F.array_distinct("start"))
    constants = _constants(rules)
    active = (
        starts.select(*TABLE, start.alias("start"))
        .distinct()
        .join(constants, TABLE, "left")
        .select(*TABLE, "start", F.array_union("start", F.coalesce("constants", _none())).alias("attrs"))
    )
    finished = []
    while True:
        round_ = written(_fire(active, rules))
        finished.append(round_.where(~F.col("grew")).drop("grew"))
        active = round_.where("grew").drop("grew")
        if active.isEmpty():
            break
    return reduce(DataFrame.unionByName, finished).withColumnRenamed("attrs", "closure")


def _column_roles(fds: DataFrame, columns: DataFrame) -> DataFrame:
    """Role of every column in the key search: L, N, LR or R.

    If a table has no L column, an LR column counts as L when each single column that
    determines it is determined by it in turn.
    """
    degrees = fd_degrees(fds).select(*TABLE, "col_code", "side")
    every = columns.select(*TABLE, "col_code").distinct()
    sided = every.join(degrees, [*TABLE, "col_code"], "full").withColumn(
        "side", F.coalesce("side", F.lit("N"))
    )
    single = fds.where(F.size("lhs") == 1).select(
        *TABLE, F.element_at("lhs", 1).alias("a"), F.col("rhs").alias("b")
    )
    back = single.select(*TABLE, F.col("b").alias("a"), F.col("a").alias("b"))
    one_way = (
        single.join(back, [*TABLE, "a", "b"], "left_anti")
        .select(*TABLE, F.col("b").alias("col_code"), F.lit(True).alias("one_way"))
        .distinct()
    )
    has_l = F.max(F.col("side") == "L").over(Window.partitionBy(*TABLE))
    promoted = (F.col("side") == "LR") & ~has_l & F.col("one_way").isNull()
    return sided.join(one_way, [*TABLE, "col_code"], "left").select(
        *TABLE, "col_code", F.when(promoted, "L").otherwise(F.col("side")).alias("side")
    )


def _left_out(rules: DataFrame, every: DataFrame) -> DataFrame:
    """``(sys_code, table_code, family)``: sets of columns that each key must have one of.

    For each column, what the closure of all columns but it and those that help determine it in one step leaves out. A
    column that nothing determines gives the set of itself.
    """
    helpers = (
        rules.select(*TABLE, F.col("rhs").alias("col_code"), F.explode("lhs").alias("helper"))
        .groupBy(*TABLE, "col_code")
        .agg(F.collect_set("helper").alias("helpers"))
    )
    own = every.select(*TABLE, "every", F.explode("every").alias("col_code")).join(helpers, [*TABLE, "col_code"], "left")
    near = F.array_append(F.coalesce("helpers", _none()), F.col("col_code"))
    closed = fd_closure(rules, own.select(*TABLE, F.array_except("every", near).alias("start")))
    member = F.array_sort(F.array_except("every", "closure"))
    members = closed.join(every, TABLE).select(*TABLE, member.alias("member")).where(F.size("member") > 0)
    sized = F.array_sort(F.collect_set(F.struct(F.size("member").alias("n"), "member")))
    return members.groupBy(*TABLE).agg(F.transform(sized, lambda s: s["member"]).alias("family"))


def candidate_keys(
    fds: DataFrame,
    columns: DataFrame,
    limit: int = defaults.JOINT_KEY_LIMIT,
    max_fds: int | None = None,
) -> DataFrame:
    """Candidate keys ``(sys_code, table_code, key)`` of every table with FDs.

    ``columns`` lists ``(sys_code, table_code, col_code)``. Columns never determined by others
    (N) are in every key. Sets of determining columns (L) are tried by growing size, then L
    and N together with sets of LR columns; a table stops at the first size that yields keys
    and returns all keys of that size. With ``max_fds``, tables with more FDs use only determinants of one to
    three columns, which may miss keys.

    Sets grow as covers: a key has to hit whatever the closure of any set that is no key leaves out. So only sets that
    may still become keys are closed, and they grow only by columns beyond their closure.
    """
    rules = fds.select(*TABLE, "lhs", "rhs").distinct()
    if max_fds is not None:
        per_table = F.count(F.lit(1)).over(Window.partitionBy(*TABLE))
        usable = (F.col("_n") <= max_fds) | F.size("lhs").between(1, 3)
        rules = rules.withColumn("_n", per_table).where(usable).drop("_n")
    rules = written(rules)
    roles = _column_roles(rules, columns).join(rules.select(*TABLE).distinct(), TABLE, "left_semi")

    def role_set(side: str) -> Column:
        return F.array_sort(F.collect_set(F.when(F.col("side") == side, F.col("col_code"))))

    frames = written(
        roles.groupBy(*TABLE).agg(
            role_set("L").alias("l"), role_set("N").alias("n"), role_set("LR").alias("lr"), F.collect_set("col_code").alias("every")
        )
    )
    families = written(frames.join(_left_out(rules, frames.select(*TABLE, "every")), TABLE, "left"))
    found = []
    pending = frames.select(*TABLE)
    for pool, base in (("l", F.col("n")), ("lr", F.array_union("l", "n"))):
        missed = F.filter(F.coalesce("family", F.array().cast("array<array<string>>")), lambda member: ~F.arrays_overlap(member, F.col("base")))
        phase = families.withColumn("base", base).select(*TABLE, "base", "every", missed.alias("family"), F.col(pool).alias("usable"))
        partials = pending.select(*TABLE, _none().alias("chosen"), F.lit(None).cast("array<string>").alias("within"))
        for size in range(1, limit + 1):
            room = phase.where(size + F.size("base") <= limit)
            sets = written(extended(partials, room, TABLE))
            if sets.isEmpty():
                break
            partials = sets.select(*TABLE, "chosen", F.lit(None).cast("array<string>").alias("within"))
            tried = sets.where("covers").join(room, TABLE).select(*TABLE, "chosen", "every", F.array_sort(F.array_union("chosen", "base")).alias("start"))
            tried = written(tried)
            if tried.isEmpty():
                continue
            closed = fd_closure(rules, tried).join(tried, [*TABLE, "start"])
            closed = written(closed.select(*TABLE, "chosen", F.col("start").alias("key"), F.array_except("every", "closure").alias("within")))
            keys = closed.where(F.size("within") == 0).select(*TABLE, "key")
            found.append(keys)
            done = keys.select(*TABLE).distinct()
            pending = written(pending.join(done, TABLE, "left_anti"))
            partials = (
                partials.drop("within")
                .join(pending, TABLE, "left_semi")
                .join(closed.select(*TABLE, "chosen", "within"), [*TABLE, "chosen"], "left")
            )
    if not found:
        return frames.where(F.lit(False)).select(*TABLE, F.col("l").alias("key"))
    return reduce(DataFrame.unionByName, found)


def candidate_keys_sql(fds: DataFrame, columns: DataFrame) -> DataFrame:
    """Candidate keys by one step of FDs: determinants that reach the whole table.

    Of each table's determinants the ones reaching most columns count, and of these the
    shortest; they are keys if they reach every column.
    """
    rules = fds.select(*TABLE, F.array_sort("lhs").alias("lhs"), "rhs").distinct()
    left = rules.where(F.size("lhs") > 0).select(*TABLE, F.col("lhs").alias("key")).distinct()
    gained = applicable(left, "key", rules).where(~F.array_contains("key", F.col("rhs")))
    reached = (
        gained.groupBy(*TABLE, "key")
        .agg(F.collect_set("rhs").alias("gain"))
        .join(_constants(rules), TABLE, "left")
        .withColumn("gain", F.array_union("gain", F.array_except(F.coalesce("constants", _none()), "key")))
        .select(*TABLE, "key", (F.size("gain") + F.size("key")).alias("reach"))
    )
    n_cols = columns.groupBy(*TABLE).agg(F.count_distinct("col_code").alias("n_cols"))
    per_table = Window.partitionBy(*TABLE)
    best = reached.withColumn("_best", F.max("reach").over(per_table)).where(F.col("reach") == F.col("_best"))
    shortest = best.withColumn("_size", F.min(F.size("key")).over(per_table)).where(
        F.size("key") == F.col("_size")
    )
    return shortest.join(n_cols, TABLE).where(F.col("reach") == F.col("n_cols")).select(*TABLE, "key")


# ---- verification on data ---------------------------------------------------------------

def _enough_distinct(records: Column, distinct: Column, threshold: int | None, tolerance: int) -> Column:
    """All values distinct; with a threshold, tables from that size on may miss it by less than ``tolerance``."""
    if threshold is None:
        return records == distinct
    return (records == distinct) | ((records >= threshold) & (records - distinct < tolerance))


def verify_single_keys(
    keys: DataFrame, profile: DataFrame, threshold: int | None = None, tolerance: int = 5
) -> DataFrame:
    """One-column candidates that are unique, hold no Chinese, and are no measure or date.

    Where ``threshold`` is given, columns of tables with at least so many rows may have fewer than
    ``tolerance`` duplicates.
    """
    single = keys.where(F.size("key") == 1).select(*TABLE, F.element_at("key", 1).alias("col_code"))
    good = (
        ~F.col("has_chinese")
        & ~F.col("col_type").isin("DOUBLE", "TIMESTAMP", "TIME", "DATE")
        & _enough_distinct(F.col("records"), F.col("distinct"), threshold, tolerance)
    )
    return single.join(profile, [*TABLE, "col_code"]).where(good).select(*TABLE, "col_code")


def _text_keys(df: DataFrame, name: str) -> list[Column]:
    """Columns that are equal exactly if the texts of a column are."""
    c, kind = col(name), counted_as(df.schema[name].dataType)
    return [c, is_minus_zero(c)] if kind == "double" else [c.cast(kind)]


def count_key_tuples(tables: Tables, keys: Mapping[TableKey, list[list[str]]]) -> DataFrame:
    """``(sys_code, table_code, key, records, tuples)`` of joint candidates.

    Every candidate is counted by a scan of its own columns and one shuffle of tuples, in which numbers, dates and
    timestamps are as they are, not text. Tuples with a NULL part count as rows but not as tuples.
    """
    parts = []
    for (sys_code, table_code), candidates in sorted(keys.items()):
        df = tables[(sys_code, table_code)]
        for key in candidates:
            exact = [c for name in key for c in _text_keys(df, name)]
            names = [f"k{i}" for i in range(len(exact))]
            counted = df.select([c.alias(n) for c, n in zip(exact, names)]).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
            whole = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
            sums = counted.agg(F.sum("n").alias("records"), F.count_if(whole).alias("tuples")).where(F.col("records") > 0)
            parts.append(
                sums.select(
                    F.lit(sys_code).alias("sys_code"),
                    F.lit(table_code).alias("table_code"),
                    F.array(*[F.lit(c) for c in key]).alias("key"),
                    "records",
                    "tuples",
                )
            )
    return reduce(DataFrame.unionByName, parts)


def verify_joint_keys(
    keys: DataFrame, profile: DataFrame, tables: Tables, threshold: int | None = None, tolerance: int = 5
) -> DataFrame:
    """Candidates of several columns, none of them nullable or Chinese, that are unique."""
    joint = keys.where(F.size("key") > 1).select(*TABLE, F.array_sort("key").alias("key")).distinct()
    fit = (
        joint.select(*TABLE, "key", F.explode("key").alias("col_code"))
        .join(profile, [*TABLE, "col_code"])
        .groupBy(*TABLE, "key")
        .agg((~F.bool_or(F.col("has_chinese") | F.col("nullable"))).alias("fit"))
        .where("fit")
        .select(*TABLE, "key")
    )
    # One row per candidate key: bounded by the schema.
    wanted: dict[TableKey, list[list[str]]] = {}
    for r in fit.collect():
        wanted.setdefault((r["sys_code"], r["table_code"]), []).append(list(r["key"]))
    if not wanted:
        return joint.where(F.lit(False))
    counts = count_key_tuples(tables, {k: sorted(v) for k, v in wanted.items()})
    unique = _enough_distinct(F.col("records"), F.col("tuples"), threshold, tolerance)
    return counts.where(unique).select(*TABLE, "key")


def whole_row_keys(
    fds: DataFrame, columns: DataFrame, mined: DataFrame, limit: int = defaults.JOINT_KEY_LIMIT
) -> DataFrame:
    """All columns of each table that was mined without finding an FD and has few columns, as candidates."""
    return (
        columns.groupBy(*TABLE)
        .agg(F.array_sort(F.collect_set("col_code")).alias("key"))
        .where(F.size("key") <= limit)
        .join(mined.select(*TABLE).distinct(), TABLE, "left_semi")
        .join(fds.select(*TABLE).distinct(), TABLE, "left_anti")
    )


def choose_keys(single: DataFrame, joint: DataFrame) -> DataFrame:
    """Primary keys ``(sys_code, table_code, kind, group_code, cols)``.

    Single keys win over joint keys. Joint keys of a table are numbered from 0.
    """
    ones = single.select(*TABLE, F.lit("single").alias("kind"), F.array("col_code").alias("cols"))
    many = (
        joint.select(*TABLE, F.array_sort("key").alias("cols"))
        .join(single.select(*TABLE).distinct(), TABLE, "left_anti")
        .distinct()
        .select(*TABLE, F.lit("joint").alias("kind"), "cols")
    )
    number = F.row_number().over(Window.partitionBy(*TABLE, "kind").orderBy("cols")) - 1
    return ones.unionByName(many).select(*TABLE, "kind", number.alias("group_code"), "cols")


def mark_keys(profile: DataFrame, keys: DataFrame) -> DataFrame:
    """The profile with ``col_pk`` set for single primary keys."""
    single = keys.where(F.col("kind") == "single").select(
        *TABLE, F.element_at("cols", 1).alias("col_code"), F.lit(True).alias("_pk")
    )
    names = profile.columns
    marked = profile.drop("col_pk").join(single, [*TABLE, "col_code"], "left")
    return marked.withColumn("col_pk", F.coalesce("_pk", F.lit(False))).select(*names)


def joint_key_rows(keys: DataFrame) -> DataFrame:
    """``(sys_code, table_code, group_code, cols)`` of the joint primary keys."""
    return keys.where(F.col("kind") == "joint").select(*TABLE, "group_code", "cols")


__all__ = [
    "candidate_keys", "candidate_keys_sql", "choose_keys", "count_key_tuples", "fd_closure",
    "joint_key_rows", "mark_keys", "verify_joint_keys", "verify_single_keys", "whole_row_keys",
]

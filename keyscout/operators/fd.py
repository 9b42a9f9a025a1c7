"""Functional dependencies: mining, checking, merging, and statistics over mined FDs.

An FD is a row ``(sys_code, table_code, lhs, rhs, fd_level)``: ``lhs`` is a sorted array of
columns, empty for a constant column, and ``fd_level`` its size. Values are compared untrimmed
with NULL as blank.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyscout import defaults
from keyscout.functions.text import as_text, col
from keyscout.operators.covers import difference_sets, extended, without_implied
from keyscout.session import kept_if_small
from keyscout.sources.tables import usable_columns

FD_SCHEMA = T.StructType(
    [
        T.StructField("sys_code", T.StringType()),
        T.StructField("table_code", T.StringType()),
        T.StructField("lhs", T.ArrayType(T.StringType())),
        T.StructField("rhs", T.StringType()),
        T.StructField("fd_level", T.IntegerType()),
    ]
)
TABLE = ["sys_code", "table_code"]

BRANCHES_PER_JOB = 24   # determinants of a large table tested by one job
KEYS_PER_ROW = 64       # determinants of a small table tested by one job
PROBE_ROWS = 100_000    # rows of the refutation probe
GROUP_SHARE = 32        # of the groups of a large table, one in so many is looked at before all are
PAIRED_ROWS = 5_000     # rows whose pairs give difference sets, fewer for wide tables
PAIRED_CELLS = 5_000_000
PAIRED_SETS = 4_000     # difference sets kept, and how many of these for one column
FAMILY_SETS = 128

Fd = tuple[frozenset, str]
Plan = dict[tuple[str, ...], list[str]]
Verdicts = dict[tuple[str, ...], tuple[int, int, set[str]]]


def fd_rows(spark: SparkSession, fds: Iterable[Fd], sys_code: str, table_code: str) -> DataFrame:
    rows = sorted((sys_code, table_code, sorted(lhs), rhs, len(lhs)) for lhs, rhs in fds)
    return spark.createDataFrame(rows, FD_SCHEMA)


# ---- the kernel -------------------------------------------------------------------------

_NATIVE = (T.IntegralType, T.FractionalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def comparable(df: DataFrame) -> DataFrame:
    """Columns in a form whose equality is that of their text.

    Numbers and times keep their type: they are smaller, and aggregates over them run in
    generated hash aggregation. The two zeros become one, so that typed and text keys agree on
    them. Everything else becomes text with NULL as blank.
    """

    def form(c: str) -> Column:
        kind = df.schema[c].dataType
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return F.when(col(c) == 0, F.lit(0).cast(kind)).otherwise(col(c))
        return col(c) if isinstance(kind, _NATIVE) else as_text(c)

    return df.select([form(c).alias(c) for c in usable_columns(df)])


def _single_valued(rows: DataFrame, c: str) -> Column:
    """Aggregate: all rows of the group hold the same value of ``c``, NULL being a value.

    Texts are compared by hash, which keeps the aggregation hash based; equal hashes prove nothing, so ``_run_tests`` looks
    at texts again.
    """
    if isinstance(rows.schema[c].dataType, T.StringType):
        hashed = F.xxhash64(col(c))
        return F.min(hashed) == F.max(hashed)
    same = F.min(col(c)).eqNullSafe(F.max(col(c)))
    return same & ((F.count(col(c)) == 0) | (F.count(col(c)) == F.count(F.lit(1))))


def _test(rows: DataFrame, lhs: tuple[str, ...], rhs: Sequence[str]) -> DataFrame:
    """One row: distinct ``lhs`` tuples, the largest group, and which ``rhs`` hold, texts by hash.

    One shuffle on ``lhs`` tests every right-hand side. Map tasks reduce each group to its
    extremes first, so a hot key never meets in one place.
    """
    groups = rows.groupBy(*[col(c) for c in lhs]).agg(
        F.count(F.lit(1)).alias("_n"),
        *[_single_valued(rows, c).alias(f"_h{i}") for i, c in enumerate(rhs)],
    )
    verdicts = [F.when(F.bool_and(f"_h{i}"), F.lit(c)) for i, c in enumerate(rhs)]
    held = F.array_compact(F.array(*verdicts)) if rhs else F.array().cast("array<string>")
    return groups.agg(
        F.array(*[F.lit(c) for c in lhs]).alias("lhs"),
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.max("_n"), F.lit(0)).alias("largest"),
        held.alias("held"),
    )


def _in_batches(plan: Plan, test) -> Verdicts:
    """Verdicts for a few determinants of a large table, one aggregate ``test(lhs, rhs)`` each.

    Every branch reads only its own columns. What comes to the driver is one row per
    determinant, bounded by the schema, not by the data.
    """
    verdicts = {}
    todo = sorted(plan.items())
    for start in range(0, len(todo), BRANCHES_PER_JOB):
        batch = [test(lhs, rhs) for lhs, rhs in todo[start : start + BRANCHES_PER_JOB]]
        for r in reduce(DataFrame.unionAll, batch).collect():
            verdicts[tuple(r["lhs"])] = (r["groups"], r["largest"], set(r["held"] or ()))
    return verdicts


def _tuple_hash(lhs: Sequence[str]) -> Column:
    """Equal for equal tuples; equal hashes prove nothing."""
    return F.xxhash64(*[col(c) for c in lhs])


def _test_unique(rows: DataFrame, lhs: tuple[str, ...], rhs: Sequence[str]) -> DataFrame:
    """As ``_test`` where no two rows share a hash of ``lhs``, all ``rhs`` held then; otherwise ``largest`` is over 1 and counts for nothing.

    Only the hashes are shuffled.
    """
    counted = rows.groupBy(_tuple_hash(lhs).alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    return counted.agg(
        F.array(*[F.lit(c) for c in lhs]).alias("lhs"),
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.max("_n"), F.lit(0)).alias("largest"),
        F.array(*[F.lit(c) for c in rhs]).alias("held"),
    )


def _run_branches(rows: DataFrame, plan: Plan) -> Verdicts:
    """Verdicts for a few determinants of a large table. Those without right-hand sides and those not unique by hash are grouped."""
    by_hash = _in_batches({lhs: rhs for lhs, rhs in plan.items() if rhs}, lambda lhs, rhs: _test_unique(rows, lhs, rhs))
    unique = {lhs: verdict for lhs, verdict in by_hash.items() if verdict[1] == 1}
    return unique | _in_batches({lhs: rhs for lhs, rhs in plan.items() if lhs not in unique}, lambda lhs, rhs: _test(rows, lhs, rhs))


def _left_by_some_groups(rows: DataFrame, plan: Plan) -> Plan:
    """Candidates that no whole group out of a ``GROUP_SHARE``-th of the groups refutes.

    Rows of a group are rarely together in a sample of rows; here all rows of a tuple are taken or none. Only refutes.
    """
    some = lambda lhs: rows.where(F.pmod(_tuple_hash(lhs), F.lit(GROUP_SHARE)) == 0)
    return _not_refuted(plan, _in_batches(plan, lambda lhs, rhs: _test(some(lhs), lhs, rhs)))


def _not_refuted(plan: Plan, seen: Verdicts) -> Plan:
    """Candidates that hold in the rows behind ``seen``, or met none of them."""
    plan = {lhs: [r for r in rhs if lhs not in seen or not seen[lhs][0] or r in seen[lhs][2]] for lhs, rhs in plan.items()}
    return {lhs: rhs for lhs, rhs in plan.items() if rhs}


def _run_exploded(rows: DataFrame, plan: Plan) -> Verdicts:
    """Verdicts for many determinants of a small table in one aggregate.

    Each row is repeated per determinant with that determinant's key.
    """
    verdicts = {}
    todo = sorted(plan.items())
    for start in range(0, len(todo), KEYS_PER_ROW):
        batch = todo[start : start + KEYS_PER_ROW]
        rhs = sorted({c for _, wanted in batch for c in wanted})
        parts = sorted({c for lhs, _ in batch for c in lhs})
        texts = {c: i for i, c in enumerate(parts)}
        source = rows.select(
            *[col(c).cast("string").alias(f"_t{i}") for c, i in texts.items()],
            *[col(c).alias(f"_r{i}") for i, c in enumerate(rhs)],
        )
        keys = [
            F.struct(F.lit(k).alias("id"), F.array(*[F.col(f"_t{texts[c]}") for c in lhs]).alias("key"))
            for k, (lhs, _) in enumerate(batch)
        ]
        repeated = source.select(
            F.inline(F.array(*keys)), *[F.col(f"_r{i}") for i in range(len(rhs))]
        )
        groups = repeated.groupBy("id", "key").agg(
            F.count(F.lit(1)).alias("_n"),
            *[_single_valued(repeated, f"_r{i}").alias(f"_h{i}") for i in range(len(rhs))],
        )
        result = groups.groupBy("id").agg(
            F.count(F.lit(1)).alias("groups"),
            F.max("_n").alias("largest"),
            F.array(*[F.bool_and(f"_h{i}") for i in range(len(rhs))]).alias("held"),
        )
        for r in result.collect():
            lhs, wanted = batch[r["id"]]
            held = {c for i, c in enumerate(rhs) if c in wanted and r["held"][i]}
            verdicts[lhs] = (r["groups"], r["largest"], held)
    return verdicts


def _tuple_counts(rows: DataFrame, tuples: Sequence[tuple[str, ...]], large: bool) -> dict[tuple[str, ...], int]:
    """Distinct tuples of some columns, NULL being a value; grouping only, so no text is ever in an aggregation buffer."""
    counts: dict[tuple[str, ...], int] = {}
    todo = sorted(set(tuples))
    step = BRANCHES_PER_JOB if large else KEYS_PER_ROW
    for start in range(0, len(todo), step):
        batch = todo[start : start + step]
        if large:
            distinct = [rows.select(*[col(c) for c in t]).distinct().agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("id"), "n") for k, t in enumerate(batch)]
            counted = reduce(DataFrame.unionAll, distinct)
        else:
            keys = [F.struct(F.lit(k).alias("id"), F.array(*[col(c).cast("string") for c in t]).alias("key")) for k, t in enumerate(batch)]
            counted = rows.select(F.inline(F.array(*keys))).distinct().groupBy("id").agg(F.count(F.lit(1)).alias("n"))
        counts |= {batch[r["id"]]: r["n"] for r in counted.collect()}
    return counts


def _run_tests(rows: DataFrame, plan: Plan, large: bool = False) -> Verdicts:
    """Exact verdicts ``{lhs: (distinct tuples, largest group, right-hand sides that hold)}``.

    Right-hand texts that hold by hash are tested once more: they hold if adding them gives no more distinct tuples.
    A unique determinant determines them whatever their hashes are.
    """
    verdicts = _run_branches(rows, plan) if large else _run_exploded(rows, plan)
    text = {f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)}
    again = [(lhs, c) for lhs, (_, largest, held) in verdicts.items() if largest > 1 for c in held & text]
    counts = _tuple_counts(rows, [(*lhs, c) for lhs, c in again], large)
    for lhs, c in again:
        if counts[(*lhs, c)] != verdicts[lhs][0]:
            verdicts[lhs][2].discard(c)
    return verdicts


# ---- mining -----------------------------------------------------------------------------

def mine_fds(
    df: DataFrame,
    max_lhs: int = defaults.MAX_LHS,
    min_records: int = defaults.MIN_RECORDS,
    probe_rows: int = PROBE_ROWS,
) -> list[Fd]:
    """All minimal FDs with at most ``max_lhs`` determining columns, level by level.

    Candidates are dropped before they cost a pass over the data, always by exact arguments:
    a unique column determines everything; two rows that differ in a column and in no
    determining one refute a determinant; a violation found in a few rows is a violation;
    an FD cannot have more right-hand values than determinant values; a determinant that
    determines one of its own columns is never minimal.
    """
    rows = comparable(df)
    if not rows.columns:
        return []
    with kept_if_small(rows) as kept:
        return _mine(kept, max_lhs, min_records, probe_rows)


def _mine(rows: DataFrame, max_lhs: int, min_records: int, probe_rows: int) -> list[Fd]:
    names = rows.columns
    first = rows.agg(
        F.count(F.lit(1)).alias("_n"),
        *[_single_valued(rows, c).alias(f"_c{i}") for i, c in enumerate(names)],
        *[F.approx_count_distinct(col(c)).alias(f"_d{i}") for i, c in enumerate(names)],
    ).collect()[0]
    n_rows = first["_n"]
    if n_rows < min_records:
        return []
    constants = [c for i, c in enumerate(names) if first[f"_c{i}"]]
    varying = [c for c in names if c not in constants]
    fds: list[Fd] = [(frozenset(), c) for c in constants]
    if max_lhs < 1 or len(varying) < 2:
        return fds

    near_unique = [
        c for i, c in enumerate(names) if c in varying and first[f"_d{i}"] >= 0.9 * n_rows
    ]
    large = n_rows > 10 * probe_rows
    uniqueness = _run_tests(rows, {(c,): [] for c in near_unique}, large)
    unique = {lhs[0] for lhs, (_, largest, _) in uniqueness.items() if largest == 1}
    fds += [(frozenset([c]), r) for c in unique for r in varying if r != c]
    distinct = {frozenset([c]): n_rows for c in unique}

    probe = None
    if large:
        probe = rows.sample(probe_rows / n_rows, seed=1).persist()  # from all partitions; it only refutes
    try:
        fds += _minimal_covers(rows, probe, names, varying, unique, distinct, n_rows, max_lhs)
    finally:
        if probe is not None:
            probe.unpersist()
    return fds


def _minimal_covers(
    rows: DataFrame, probe: DataFrame | None, names: list[str], varying: list[str], unique: set[str],
    distinct: dict[frozenset, int], n_rows: int, max_lhs: int,
) -> list[Fd]:
    """FDs between columns that are neither constant nor unique on the left, by growing covers of difference sets.

    A set that misses a difference set is refuted by the two rows behind it. Only sets that hit all are tested on the data;
    what fails there grows by any column. Sets live in DataFrames; the driver sees those to be tested.
    """
    spark = rows.sparkSession
    number = {c: i for i, c in enumerate(names)}
    usable = sorted(number[c] for c in varying if c not in unique)
    if not usable:
        return []
    paired = max(100, min(PAIRED_ROWS, PAIRED_CELLS // len(names) ** 2))
    source = rows if n_rows <= paired else (probe or rows).sample(min(1.0, paired / (probe.count() if probe else n_rows)), seed=2)
    missed = difference_sets(source, names, PAIRED_SETS, FAMILY_SETS)
    targets = spark.createDataFrame([(number[c],) for c in varying], "target int")
    others = F.array_except(F.array(*[F.lit(i) for i in usable]), F.array("target"))
    none = F.array().cast("array<array<int>>")
    families = targets.join(missed, "target", "left").select("target", F.coalesce("family", none).alias("family"), others.alias("usable")).persist()
    partials = targets.select("target", F.array().cast("array<int>").alias("chosen"))
    found: list[tuple[list[int], int]] = []
    levels = [families]
    try:
        for level in range(1, max_lhs + 1):
            sets = extended(partials, families, ["target"])
            if found:
                rules = spark.createDataFrame(found, "lhs array<int>, rhs int")
                sets = without_implied(sets, rules, "target", level)
            sets = sets.persist()
            levels.append(sets)
            plan: Plan = {}
            for r in sets.where("covers").collect():
                plan.setdefault(tuple(sorted(names[i] for i in r["chosen"])), []).append(names[r["target"]])
            plan = {lhs: sorted(rhs) for lhs, rhs in _within_counts(plan, distinct).items()}
            if probe is not None and plan:
                plan = _left_by_some_groups(rows, _not_refuted(plan, _run_tests(probe, plan)))
            fresh = []
            for lhs, (groups, _, held) in _run_tests(rows, plan, probe is not None).items():
                distinct[frozenset(lhs)] = groups
                fresh += [(sorted(number[c] for c in lhs), number[r]) for r in held]
            found += fresh
            partials = sets.select("target", "chosen")
            if fresh:
                done = spark.createDataFrame(fresh, "chosen array<int>, target int")
                partials = partials.join(done, ["target", "chosen"], "left_anti")
    finally:
        for frame in levels:
            frame.unpersist()
    return [(frozenset(names[i] for i in lhs), names[rhs]) for lhs, rhs in found]


def _within_counts(plan: Plan, distinct: dict[frozenset, int]) -> Plan:
    """Candidates left by counts: a determinant has at least as many values as what it determines."""
    kept: Plan = {}
    for lhs, rhs in plan.items():
        most = 1
        for c in lhs:
            most *= distinct.get(frozenset([c]), float("inf"))
        open_rhs = [r for r in rhs if distinct.get(frozenset([r]), 0) <= most]
        if open_rhs:
            kept[lhs] = open_rhs
    return kept


def discover_fds(
    df: DataFrame,
    max_lhs: int = defaults.MAX_LHS,
    sys_code: str = "",
    table_code: str = "",
    min_records: int = defaults.MIN_RECORDS,
    probe_rows: int = PROBE_ROWS,
) -> DataFrame:
    """Minimal FDs of a table as rows. Full data by default; sample first to analyse a sample."""
    fds = mine_fds(df, max_lhs, min_records, probe_rows)
    return fd_rows(df.sparkSession, fds, sys_code, table_code)


def check_fd(df: DataFrame, lhs: Sequence[str], rhs: Sequence[str]) -> DataFrame:
    """Whether ``lhs`` determines all of ``rhs`` in the data: one row."""
    open_rhs = sorted({c for c in rhs if c not in lhs})
    checked = check_fds(df, [(lhs, c) for c in open_rhs or lhs[:1]])
    return checked.agg(
        F.lit(",".join(sorted(lhs))).alias("lhs"), F.lit(",".join(open_rhs)).alias("rhs"), F.bool_and("holds").alias("holds")
    )


def check_fds(df: DataFrame, fds: Sequence[tuple[Sequence[str], str]]) -> DataFrame:
    """``(lhs, rhs, holds)`` for many FDs of one table.

    An FD holds if its columns have as many distinct tuples as its determinant alone. Tuples are grouped only, so that
    texts stay out of aggregation buffers; a determinant is counted once for all its FDs.
    """
    rows = comparable(df)
    wanted = sorted({(tuple(sorted(lhs)), r) for lhs, r in fds})
    asked = sorted({lhs for lhs, _ in wanted} | {(*lhs, r) for lhs, r in wanted if r not in lhs})
    place = {t: i for i, t in enumerate(asked)}

    def counted(columns: tuple[str, ...]) -> DataFrame:
        distinct = rows.select(*[col(c) for c in columns]).distinct() if columns else rows.limit(1)
        return distinct.agg(F.count(F.lit(1)).alias("n")).select(F.lit(place[columns]).alias("place"), "n")

    counts = reduce(DataFrame.unionAll, [counted(t) for t in asked])
    by_place = counts.agg(F.map_from_entries(F.collect_list(F.struct("place", "n"))).alias("n"))
    n = lambda columns: F.col("n")[F.lit(place[columns])]
    verdicts = [
        F.struct(
            F.lit(",".join(lhs)).alias("lhs"), F.lit(r).alias("rhs"),
            (F.lit(True) if r in lhs else n(lhs) == n((*lhs, r))).alias("holds"),
        )
        for lhs, r in wanted
    ]
    return by_place.select(F.inline(F.array(*verdicts)))


def find_pair_fds(
    df: DataFrame, pairs: Sequence[tuple[str, str]], large: bool = False
) -> list[tuple[str, str, str]]:
    """Dependencies between paired columns: ``(left, right, 'bfd')`` or ``(from, to, 'fd')``."""
    plan: dict[tuple[str, ...], list[str]] = {}
    for a, b in pairs:
        plan.setdefault((a,), []).append(b)
        plan.setdefault((b,), []).append(a)
    verdicts = _run_tests(comparable(df), {k: sorted(set(v)) for k, v in plan.items()}, large)
    found = []
    for a, b in sorted(set(pairs)):
        groups, _, forward = verdicts[(a,)]
        backward = verdicts[(b,)][2]
        if groups == 0:
            continue
        if b in forward and a in backward:
            found.append((a, b, "bfd"))
        elif b in forward:
            found.append((a, b, "fd"))
        elif a in backward:
            found.append((b, a, "fd"))
    return found


def pair_fd(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``find_pair_fds`` as rows ``(left_col, right_col, rel_type)``."""
    found = find_pair_fds(df, pairs)
    schema = "left_col string, right_col string, rel_type string"
    return df.sparkSession.createDataFrame(found, schema)


# ---- operators over mined FDs -----------------------------------------------------------

def is_subset(small: str | Column, large: str | Column) -> Column:
    return F.size(F.array_except(small, large)) == 0


def applicable(sets: DataFrame, attrs: str, rules: DataFrame, key: Sequence[str] = TABLE) -> DataFrame:
    """Every set with each rule whose non-empty ``lhs`` it contains.

    A rule meets only the sets that hold its first column, on an equality join, instead of
    every set of its table. Columns of ``rules`` beyond the key must have other names.
    """
    held = sets.withColumn("_first", F.explode(attrs))
    first = rules.where(F.size("lhs") > 0).withColumn("_first", F.element_at("lhs", 1))
    return held.join(first, [*key, "_first"]).where(is_subset("lhs", attrs)).drop("_first")


def merge_fds(batch1: DataFrame, batch2: DataFrame, require_overlap: bool = True) -> DataFrame:
    """FDs that hold in both batches.

    Per right-hand side: determinants found in both, and the unions of a determinant found
    only in the first with one found only in the second, if they share a column; of these the
    minimal ones.
    """
    key = [*TABLE, "rhs", "lhs"]
    one = batch1.select(*TABLE, "rhs", F.array_sort("lhs").alias("lhs")).distinct()
    two = batch2.select(*TABLE, "rhs", F.array_sort("lhs").alias("lhs")).distinct()
    both = one.join(two, key)
    only_one = one.join(two, key, "left_anti")
    only_two = two.join(one, key, "left_anti").withColumnRenamed("lhs", "lhs2")
    if require_overlap:
        # Meet on a shared column, so that only overlapping determinants are paired.
        shared = [*TABLE, "rhs", "_shared"]
        pairs = only_one.withColumn("_shared", F.explode("lhs")).join(
            only_two.withColumn("_shared", F.explode("lhs2")), shared
        )
    else:
        pairs = only_one.join(only_two, [*TABLE, "rhs"])
    united = pairs.select(*TABLE, "rhs", F.array_sort(F.array_union("lhs", "lhs2")).alias("lhs"))
    every = both.unionByName(united).distinct()
    larger = every.select(*TABLE, "rhs", F.col("lhs").alias("whole"))
    redundant = (
        applicable(larger, "whole", every, [*TABLE, "rhs"])
        .where(F.size("lhs") < F.size("whole"))
        .select(*TABLE, "rhs", F.col("whole").alias("lhs"))
    )
    constant = every.where(F.size("lhs") == 0).select(*TABLE, "rhs").distinct()
    minimal = (
        every.join(redundant, key, "left_anti")
        .join(constant.withColumn("_constant", F.lit(True)), [*TABLE, "rhs"], "left")
        .where(F.col("_constant").isNull() | (F.size("lhs") == 0))
    )
    return minimal.select(*TABLE, "lhs", "rhs", F.size("lhs").alias("fd_level"))


def delete_fds(fds: DataFrame, tables: DataFrame) -> DataFrame:
    """FDs without those of the given ``(sys_code, table_code)`` rows."""
    return fds.join(tables.select(*TABLE).distinct(), TABLE, "left_anti")


def tables_with_wrong_fds(status: DataFrame) -> DataFrame:
    """Tables whose FDs are to be deleted: mined or skipped, but the check is still open."""
    return (
        status.where((F.col("fd_check_sche") == "0") & F.col("fd_sche").isin("1", "2"))
        .select(*TABLE)
        .distinct()
    )


def fds_by_level(fds: DataFrame, low: int = 1, high: int = 3) -> DataFrame:
    return fds.where(F.col("fd_level").between(low, high))


def fd_count_filter(fds: DataFrame, limit: int = defaults.ONE_STEP_FDS) -> DataFrame:
    """Tables with at most ``limit`` FDs."""
    counts = fds.groupBy(*TABLE).agg(F.count(F.lit(1)).alias("n_fds"))
    return counts.where(F.col("n_fds") <= limit)


def fd_degrees(fds: DataFrame) -> DataFrame:
    """Per column: FDs it helps determine (out), FDs that determine it (in), and its class.

    L only determines, R is only determined, LR both; columns in no FD do not appear.
    """
    out = fds.select(*TABLE, F.explode("lhs").alias("col_code"), F.lit(1).alias("o"), F.lit(0).alias("i"))
    into = fds.select(*TABLE, F.col("rhs").alias("col_code"), F.lit(0).alias("o"), F.lit(1).alias("i"))
    side = (
        F.when(F.col("in_degree") == 0, "L").when(F.col("out_degree") == 0, "R").otherwise("LR")
    )
    return (
        out.unionByName(into)
        .groupBy(*TABLE, "col_code")
        .agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))
        .withColumn("side", side)
    )

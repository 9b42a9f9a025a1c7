"""Fields that carry the same data: compared after joining tables on a foreign key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from contextlib import ExitStack
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyscout.functions.text import as_text, node_id, node_text, normalize
from keyscout.operators.fd import TABLE, fds_by_level, find_pair_fds
from keyscout.operators.graph import components
from keyscout.operators.keys import fd_closure
from keyscout.operators.numbering import numbered
from keyscout.operators.profile import informative_columns
from keyscout.session import kept_table, settled
from keyscout.sources.tables import TableKey, Tables, distinct_projection

DETAIL_SCHEMA = "left_node string, right_node string, fk_id string, fk_type string, rel_type string"
LARGE_ROWS = 1_000_000
#: Longer texts are compared by digests.
LONG_TEXT = 64


@dataclass(frozen=True)
class Reference:
    """One single ('0') or joint ('1') foreign key."""

    fk_id: str
    fk_type: str
    parent: TableKey
    child: TableKey
    pairs: tuple[tuple[str, str], ...]


def trimmed_key_join(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]]
) -> DataFrame:
    """Inner join of two projections on right-trimmed keys; the column names must differ."""
    conditions = [F.rtrim(left[a]) == F.rtrim(right[b]) for a, b in on]
    return left.join(right, conditions, "inner")


def references(
    fks: DataFrame,
    joint_fks: DataFrame | None = None,
    scope: DataFrame | None = None,
    known_ids: Iterable[str] = (),
) -> list[Reference]:
    """Foreign keys to analyse: both tables in ``scope``, not yet analysed. Schema-sized."""
    single = fks.select(
        F.col("id").alias("fk_id"), F.lit("0").alias("fk_type"),
        "parent_sys", "parent_table", "child_sys", "child_table",
        F.array(F.struct("parent_col", "child_col")).alias("pairs"),
    )
    every = single
    if joint_fks is not None:
        every = every.unionByName(
            joint_fks.select(
                F.col("group_id").alias("fk_id"), F.lit("1").alias("fk_type"),
                "parent_sys", "parent_table", "child_sys", "child_table", "pairs",
            )
        )
    if scope is not None:
        for side in ("parent", "child"):
            tables = scope.select(
                F.col("sys_code").alias(f"{side}_sys"), F.col("table_code").alias(f"{side}_table")
            ).distinct()
            every = every.join(tables, [f"{side}_sys", f"{side}_table"], "left_semi")
    known = set(known_ids)
    return [
        Reference(
            r["fk_id"], r["fk_type"],
            (r["parent_sys"], r["parent_table"]), (r["child_sys"], r["child_table"]),
            tuple((p["parent_col"], p["child_col"]) for p in r["pairs"]),
        )
        for r in every.orderBy("fk_id").collect()
        if r["fk_id"] not in known
    ]


def _cells(names: Sequence[str]) -> Column:
    """The numbered values of some columns: right-trimmed, long texts as digests, with their lengths."""

    def cell(i: int, c: str) -> Column:
        text = normalize(c)
        short = F.when(F.length(text) > LONG_TEXT, F.sha2(text, 256)).otherwise(text)
        return F.struct(F.lit(i).alias("no"), short.alias("text"), F.length(text).alias("size"))

    return F.array(*[cell(i, c) for i, c in enumerate(names)])


def counter_matrix(joined: DataFrame, lefts: Sequence[str], rights: Sequence[str]) -> DataFrame:
    """Per pair of a left and a right column: rows, and ``rel_type`` if the columns carry the same data.

    ``same`` needs two equal filled rows, no different ones, and lengths on the right within those on the left;
    ``equals`` needs equal values in all rows as well. Each row gives its pairs to one aggregate of counters, which
    are few and of fixed size, so the join is read once for any number of columns and nothing is sorted.
    """
    halves = joined.select(F.explode(_cells(lefts)).alias("a"), _cells(rights).alias("rights"))
    pairs = halves.select("a", F.explode("rights").alias("b"))
    a, b = F.col("a"), F.col("b")
    full_a, full_b = a["size"] > 0, b["size"] > 0
    equal = (a["size"] == b["size"]) & (a["text"] == b["text"])
    counted = pairs.groupBy(a["no"].alias("left_no"), b["no"].alias("right_no")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(full_a & full_b & equal).alias("same"),
        F.count_if(full_a & full_b & ~equal).alias("other"),
        F.count_if(equal).alias("equal"),
        F.min(F.when(full_a, a["size"])).alias("least_a"), F.max(F.when(full_a, a["size"])).alias("most_a"),
        F.min(F.when(full_b, b["size"])).alias("least_b"), F.max(F.when(full_b, b["size"])).alias("most_b"),
    )
    within = (F.col("most_b") <= F.col("most_a")) & (F.col("least_b") >= F.col("least_a"))
    everywhere = (F.col("equal") == F.col("rows")) & (F.col("rows") > 1)
    kind = F.when(
        within & (F.col("same") > 1) & (F.col("other") == 0), F.when(everywhere, "equals").otherwise("same")
    )
    return counted.select("left_no", "right_no", "rows", kind.alias("rel_type"))


def same_fields(
    tables: Tables,
    fks: DataFrame,
    fds: DataFrame,
    profile: DataFrame,
    joint_fks: DataFrame | None = None,
    scope: DataFrame | None = None,
    known_ids: Iterable[str] = (),
    with_fd: bool = True,
) -> DataFrame:
    """Relations between fields of tables linked by foreign keys.

    Every foreign key gives its own column pairs as ``fk``. If both tables have FDs and the
    child's key columns determine more informative columns, both sides are projected, joined
    on the key, and each pair of other columns is compared: ``same`` if equal wherever both
    are filled, ``equals`` if equal in all rows, else ``fd`` or ``bfd`` if one determines the
    other. Every foreign key is analysed on its own; those of the same two tables share one matrix of
    counters. A join is written once, read for the matrix and the FDs, and deleted.
    """
    spark = profile.sparkSession
    profile, fds = settled(profile), settled(fds)
    refs = references(fks, joint_fks, scope, known_ids)
    rows = [
        (_node(ref.parent, p), _node(ref.child, c), ref.fk_id, ref.fk_type, "fk")
        for ref in refs
        for p, c in ref.pairs
    ]
    usable = fds_by_level(fds)
    has_fds = {tuple(r) for r in usable.select(*TABLE).distinct().collect()}
    fields: dict[TableKey, list[str]] = {}
    for r in profile.select(*TABLE, "col_code").orderBy("col_num").collect():
        fields.setdefault((r[0], r[1]), []).append(r[2])
    telling = {tuple(r) for r in informative_columns(profile).select(*TABLE, "col_code").collect()}
    linked = [ref for ref in refs if ref.parent in has_fds and ref.child in has_fds]
    if linked:
        starts = spark.createDataFrame(
            [(*ref.child, sorted(c for _, c in ref.pairs)) for ref in linked],
            "sys_code string, table_code string, start array<string>",
        )
        closures = {
            (r["sys_code"], r["table_code"], tuple(r["start"])): r["closure"]
            for r in fd_closure(usable, starts).collect()
        }

    def informative(table: TableKey, c: str) -> bool:
        return (*table, c) in telling or c not in fields.get(table, ())

    def sides(ref: Reference) -> tuple[list[str], list[str]]:
        """The columns of parent and child to compare."""
        pkeys, ckeys = [p for p, _ in ref.pairs], sorted(c for _, c in ref.pairs)
        reach = closures[(*ref.child, tuple(ckeys))]
        return (
            [c for c in fields.get(ref.parent, []) if c not in pkeys and informative(ref.parent, c)],
            [c for c in sorted(reach) if c not in ckeys and informative(ref.child, c)],
        )

    compared = [(ref, *sides(ref)) for ref in sorted(linked, key=lambda r: (r.parent, r.child, r.fk_id))]
    compared = [c for c in compared if c[1] and c[2]]
    for _, group in groupby(compared, key=lambda c: (c[0].parent, c[0].child)):
        with ExitStack() as stack:
            joins = []
            for ref, lefts, rights in group:
                lname = {c: f"l{i}" for i, c in enumerate([*lefts, *(p for p, _ in ref.pairs)])}
                rname = {c: f"r{i}" for i, c in enumerate([*rights, *dict.fromkeys(c for _, c in ref.pairs)])}
                joined = trimmed_key_join(
                    distinct_projection(tables[ref.parent], lname),
                    distinct_projection(tables[ref.child], rname),
                    [(lname[p], rname[c]) for p, c in ref.pairs],
                )
                lnames, rnames = [lname[c] for c in lefts], [rname[c] for c in rights]
                kept = stack.enter_context(kept_table(joined.select(*lnames, *rnames)))
                joins.append((ref, lefts, rights, kept, lnames, rnames))
            matrices = [counter_matrix(j[3], j[4], j[5]).withColumn("fk", F.lit(i)) for i, j in enumerate(joins)]
            matrix = reduce(DataFrame.unionByName, matrices).collect()
            for i, (ref, lefts, rights, kept, lnames, rnames) in enumerate(joins):
                cells = [r for r in matrix if r["fk"] == i]
                found = [(lnames[r["left_no"]], rnames[r["right_no"]], r["rel_type"]) for r in cells if r["rel_type"]]
                others = [(lnames[r["left_no"]], rnames[r["right_no"]]) for r in cells if not r["rel_type"]]
                n_rows = max((r["rows"] for r in cells), default=0)
                if with_fd and n_rows > 3 and others:
                    texts = kept.select([as_text(c).alias(c) for c in [*lnames, *rnames]])
                    found += find_pair_fds(texts, others, large=n_rows > LARGE_ROWS)
                origin = {n: _node(ref.parent, c) for n, c in zip(lnames, lefts)}
                origin |= {n: _node(ref.child, c) for n, c in zip(rnames, rights)}
                rows += [(origin[x], origin[y], ref.fk_id, ref.fk_type, kind) for x, y, kind in found]
    return spark.createDataFrame(rows, DETAIL_SCHEMA)


def _node(table: TableKey, column: str) -> str:
    return node_text(*table, column)


def field_clusters(detail: DataFrame, profile: DataFrame) -> DataFrame:
    """Clusters of fields with the same data, numbered by their least node.

    ``dim_order`` ranks the fields of a cluster by distinct values, most first.
    """
    edges = detail.where(F.col("rel_type").isin("fk", "same", "equals")).select(
        F.col("left_node").alias("left"), F.col("right_node").alias("right")
    )
    labels = components(edges)
    sizes = profile.select(
        node_id("sys_code", "table_code", "col_code").alias("node"), F.col("distinct").alias("_distinct")
    )
    sized = labels.join(sizes, "node", "left").withColumn("_distinct", F.coalesce("_distinct", F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("component").orderBy(F.desc("_distinct"), "node"))
    numbers = numbered(labels.select("component").distinct(), ["component"], "category_same")
    return sized.withColumn("dim_order", rank).join(numbers, "component").select(
        F.col("category_same").cast("int").alias("category_same"), "node", F.lit(1).alias("diff_flg"), "dim_order"
    )

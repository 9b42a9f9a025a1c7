"""Dimension division: which fields are attributes or subsets of which dimension.

Input edges are ``(left, right, kind)`` with kind ``FD`` (one column determines another) or
``FK`` (key to referencing field). Nodes are ids by ``node_id``, in which separators within names are escaped, so
names of any form can be joined and taken apart. A dimension's root is a field with outgoing foreign keys
only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyscout.functions.text import node_id, node_part
from keyscout.operators.graph import components, merge_nodes, mutual_groups, reached_by, root_nodes
from keyscout.session import cut_lineage


def relation_edges(fds: DataFrame, fks: DataFrame) -> DataFrame:
    """Graph edges from mined one-column FDs and single foreign keys."""
    determined = fds.where(F.col("fd_level") == 1).select(
        node_id("sys_code", "table_code", F.element_at("lhs", 1)).alias("left"),
        node_id("sys_code", "table_code", "rhs").alias("right"),
        F.lit("FD").alias("kind"),
    )
    referenced = fks.select(
        node_id("parent_sys", "parent_table", "parent_col").alias("left"),
        node_id("child_sys", "child_table", "child_col").alias("right"),
        F.lit("FK").alias("kind"),
    )
    return determined.unionByName(referenced).distinct()


def merged_relations(edges: DataFrame) -> DataFrame:
    """Edges over merged nodes: fields that reference each other become one node."""
    references = edges.where(F.col("kind") == "FK")
    groups = mutual_groups(references)
    return cut_lineage(merge_nodes(edges, groups))


def dim_roots(edges: DataFrame) -> DataFrame:
    return root_nodes(edges.where(F.col("kind") == "FK"))


def dim_members(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """``(root, node, member)`` with member ``attr`` or ``subset``.

    References of a subset are subsets; everything a subset determines, and everything an
    attribute determines or is referenced by, is an attribute. A field that is both is an
    attribute. The root is listed as its own attribute.
    """
    # A state is a field with the way it is held; the roots that hold it are bits.
    way = lambda member, node: F.struct(F.lit(member).alias("member"), F.col(node).alias("node"))
    as_attr = edges.select(way("attr", "left").alias("state"), way("attr", "right").alias("next"))
    as_subset = edges.select(
        way("subset", "left").alias("state"), F.when(F.col("kind") == "FK", way("subset", "right")).otherwise(way("attr", "right")).alias("next")
    )
    start = roots.select(F.col("node").alias("root"), way("subset", "node").alias("state"))
    known = cut_lineage(reached_by(start, as_attr.unionByName(as_subset)).select("root", "state.node", "state.member"))
    state = ["root", "node", "member"]
    attributes = known.where(F.col("member") == "attr").select("root", "node")
    subsets = known.where(F.col("member") == "subset").join(attributes, ["root", "node"], "left_anti")
    own = roots.select(F.col("node").alias("root"), "node")
    return (
        attributes.unionByName(own)
        .distinct()
        .withColumn("member", F.lit("attr"))
        .unionByName(subsets.select(*state))
    )


def dim_groups(roots: DataFrame) -> DataFrame:
    """``(node, dim_group)``: roots that share a table, also through merged roots.

    Only the table name counts. A group is named by its least root.
    """
    in_table = roots.select(
        "node", F.explode(F.split("node", "/")).alias("part")
    ).select("node", F.concat(F.lit("\x1ftable "), node_part("part", 1)).alias("table"))
    linked = components(in_table.select(F.col("node").alias("left"), F.col("table").alias("right")))
    labelled = roots.join(linked, "node")
    least = labelled.groupBy("component").agg(F.min("node").alias("dim_group"))
    return labelled.join(least, "component").select("node", "dim_group")


def main_dimensions(
    roots: DataFrame, members: DataFrame, groups: DataFrame, literal: bool = False
) -> DataFrame:
    """``(node, is_main, dim)``: the dimension each root stands for.

    A root that is no attribute of another group's root is main. Of the others, one that is an
    attribute of main roots of several groups, or of none, is main too; with exactly one such
    group it belongs to that dimension. Main roots of one group form one dimension, named by
    all roots of the group. ``literal`` makes every root main, which is what following the
    belongs-to relation to its end amounts to when its ends count as true.
    """
    group_of = groups.select(F.col("node").alias("root"), F.col("dim_group").alias("root_group"))
    held = (
        members.where(F.col("member") == "attr")
        .join(roots, "node", "left_semi")
        .join(groups, "node")
        .join(group_of, "root")
    )
    foreign = held.where(F.col("dim_group") != F.col("root_group"))
    first = roots.join(foreign.select("node").distinct(), "node", "left_anti")
    owners = (
        held.where(F.col("root") != F.col("node"))
        .join(first.select(F.col("node").alias("root")), "root", "left_semi")
        .groupBy("node")
        .agg(
            F.count_distinct("root_group").alias("n_groups"),
            F.min("root").alias("owner"),
        )
    )
    is_first = first.withColumn("_first", F.lit(True))
    names = groups.groupBy("dim_group").agg(
        F.array_join(F.array_sort(F.collect_set("node")), "/").alias("group_dim")
    )
    judged = (
        roots.join(is_first, "node", "left")
        .join(owners, "node", "left")
        .join(groups, "node")
        .join(names, "dim_group")
    )
    belongs = F.col("_first").isNull() & (F.coalesce(F.col("n_groups"), F.lit(0)) == 1)
    if literal:
        belongs = F.lit(False)
    verdict = judged.select(
        "node", "dim_group", "group_dim", "owner", (~belongs).alias("is_main")
    )
    # The owner is a main root, so its own group's name is the dimension.
    owner_dim = groups.join(names, "dim_group").select(
        F.col("node").alias("owner"), F.col("group_dim").alias("owner_dim")
    )
    return verdict.join(owner_dim, "owner", "left").select(
        "node",
        "is_main",
        F.when(F.col("is_main"), F.col("group_dim")).otherwise(F.col("owner_dim")).alias("dim"),
    )


def dim_result(roots: DataFrame, members: DataFrame, mains: DataFrame) -> DataFrame:
    """One row per field and dimension, merged nodes taken apart.

    A field that is an attribute and, through another root, a subset of the same dimension
    keeps only the attribute row, with ``del_flag`` '0'.
    """
    placed = members.join(mains.select(F.col("node").alias("root"), "dim"), "root").select(
        "node", "dim", "member"
    ).distinct()
    kinds = placed.groupBy("node", "dim").agg(
        F.bool_or(F.col("member") == "attr").alias("attr"),
        F.bool_or(F.col("member") == "subset").alias("subset"),
    )
    fields = kinds.select("dim", "attr", "subset", F.explode(F.split("node", "/")).alias("field"))
    return fields.select(
        node_part("field", 0).alias("sys_code"),
        node_part("field", 1).alias("table_code"),
        node_part("field", 2).alias("col_code"),
        F.col("dim").alias("dim_node"),
        F.col("dim").alias("origin_dim"),
        F.when(F.col("attr"), "attr").otherwise("subset").alias("relation_type"),
        F.when(F.col("attr") & F.col("subset"), "0").otherwise("1").alias("del_flag"),
    ).distinct()


def dim_division(edges: DataFrame, literal: bool = False) -> DataFrame:
    """Dimension of every field, from FD and FK edges between fields."""
    relations = merged_relations(edges)
    roots = cut_lineage(dim_roots(relations))
    members = cut_lineage(dim_members(relations, roots))
    groups = cut_lineage(dim_groups(roots))
    return dim_result(roots, members, main_dimensions(roots, members, groups, literal))

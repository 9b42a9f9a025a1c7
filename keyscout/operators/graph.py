"""Loops over edge DataFrames: closure, mutual groups, components, roots, reachability.

Nodes are fields, edges are ``(left, right)``. Every round is written to the shared folder
and read back, so plans stay short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyscout.session import written


def closure(edges: DataFrame) -> DataFrame:
    """Transitive closure: every ``(left, right)`` with a path of one or more edges."""
    steps = written(edges.select("left", "right").distinct())
    known = steps
    fresh = steps
    hops = steps.select(F.col("left").alias("right"), F.col("right").alias("next"))
    while not fresh.isEmpty():
        reached = fresh.join(hops, "right").select("left", F.col("next").alias("right")).distinct()
        fresh = written(reached.join(known, ["left", "right"], "left_anti"))
        known = known.unionByName(fresh)
    return known


def _without_bypassed(live: DataFrame, round_no: int) -> tuple[DataFrame, DataFrame]:
    """Edges after some nodes with one edge in and one out are passed over, and those ``(node, before, after)``.

    Of neighbours that both qualify, the one with the smaller digest goes, so a third of a long chain or ring goes a round.
    """
    ends = live.select(F.col("left").alias("node"), F.col("right").alias("after"), F.lit(None).cast("string").alias("before")).unionByName(
        live.select(F.col("right").alias("node"), F.lit(None).cast("string").alias("after"), F.col("left").alias("before"))
    )
    degrees = ends.groupBy("node").agg(
        F.count("after").alias("outs"), F.count("before").alias("ins"), F.min("after").alias("after"), F.min("before").alias("before")
    )
    through = written(degrees.where("outs = 1 AND ins = 1").select("node", "before", "after", F.xxhash64("node", F.lit(round_no)).alias("rank")))

    def rank_of(side: str) -> DataFrame:
        return through.select(F.col("node").alias(side), F.struct("rank", "node").alias(f"{side}_rank"))

    own = F.struct("rank", "node")
    near = through.join(rank_of("before"), "before", "left").join(rank_of("after"), "after", "left")
    first = F.coalesce(own < F.col("before_rank"), F.lit(True)) & F.coalesce(own < F.col("after_rank"), F.lit(True))
    gone = written(near.where(first).select("node", "before", "after"))
    kept = live.join(gone.select(F.col("node").alias("left")), "left", "left_anti").join(gone.select(F.col("node").alias("right")), "right", "left_anti")
    bridges = gone.where(F.col("before") != F.col("after")).select(F.col("before").alias("left"), F.col("after").alias("right"))
    return written(kept.select("left", "right").union(bridges).distinct()), gone


def _least_ancestor(live: DataFrame) -> DataFrame:
    """``(node, label)``: the least node among a node and all that reach it."""
    nodes = live.select(F.col("left").alias("node")).union(live.select("right")).distinct()
    labels = written(nodes.withColumn("label", F.col("node")))
    while True:
        heard = live.join(labels.withColumnRenamed("node", "left"), "left").select(F.col("right").alias("node"), "label")
        lowest = labels.unionByName(heard).groupBy("node").agg(F.min("label").alias("label"))
        ahead = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        # What reaches the label reaches the node, too.
        jumped = lowest.join(ahead, "label").select("node", F.least("label", "further").alias("label"))
        jumped = written(jumped.join(labels.withColumnRenamed("label", "old"), "node"))
        if jumped.where("label <> old").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")


def strong_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of all nodes that lie on a cycle with another node; a component is named by one of its nodes.

    Rows grow with nodes and edges, never with pairs that reach each other. Nodes without an edge in or out are
    trimmed and nodes with one of each passed over, which takes long chains and rings apart in a logarithmic number
    of rounds. What is left is labelled forward by the least node that reaches each node; within a label, the nodes
    that reach that node are a component, and edges between labels go.
    """
    live = written(edges.select("left", "right").where(F.col("left") != F.col("right")).distinct())
    size, passed, round_no = live.count(), [], 0
    found = live.select(F.col("left").alias("node"), F.col("left").alias("component")).limit(0)
    while size:
        trimmed = live.join(live.select(F.col("right").alias("left")).distinct(), "left", "left_semi")
        trimmed = written(trimmed.join(live.select(F.col("left").alias("right")).distinct(), "right", "left_semi").select("left", "right"))
        if trimmed.isEmpty():
            break
        live, gone = _without_bypassed(trimmed, round_no)
        passed.append(gone)
        round_no += 1
        before, size = size, live.count()
        if not size or size < before:
            continue
        labels = _least_ancestor(live)
        left, right = labels.toDF("left", "label"), labels.toDF("right", "right_label")
        inner = live.join(left, "left").join(right, "right").where("label = right_label").select("left", "right", "label")
        inner = written(inner)
        marked = written(labels.where("node = label"))
        fresh = marked
        while not fresh.isEmpty():
            heard = inner.join(fresh.select(F.col("node").alias("right")), "right").select(F.col("left").alias("node"), "label").distinct()
            fresh = written(heard.join(marked, ["node", "label"], "left_anti"))
            marked = marked.unionByName(fresh)
        marked = written(marked)
        found = found.unionByName(marked.select("node", F.col("label").alias("component")))
        outside = inner.join(marked.select(F.col("node").alias("left")), "left", "left_anti")
        live = written(outside.join(marked.select(F.col("node").alias("right")), "right", "left_anti").select("left", "right"))
        size = live.count()
    # A node passed over belongs to its neighbours' component if they share one.
    labels = written(found)
    for gone in reversed(passed):
        if gone.isEmpty():
            continue
        sides = gone.join(labels.toDF("before", "b"), "before", "left").join(labels.toDF("after", "a"), "after", "left")
        component = F.coalesce("b", "before")
        joined = sides.where(component == F.coalesce("a", "after")).select("node", component.alias("component"))
        labels = written(labels.unionByName(joined))
    members = labels.unionByName(labels.select(F.col("component").alias("node"), "component")).distinct()
    large = members.groupBy("component").count().where("count > 1").select("component")
    return members.join(large, "component", "left_semi").select("node", "component")


def mutual_groups(edges: DataFrame) -> DataFrame:
    """``(node, merged)`` for nodes that reach each other: the group's sorted nodes, ``/``-joined."""
    placed = written(strong_components(edges))
    texts = placed.groupBy("component").agg(F.array_join(F.array_sort(F.collect_list("node")), "/").alias("merged"))
    return placed.join(texts, "component").select("node", "merged")


def merge_nodes(edges: DataFrame, groups: DataFrame) -> DataFrame:
    """Edges with mutually reachable nodes replaced by their group, self-loops removed."""
    names = edges.columns
    left = groups.select(F.col("node").alias("left"), F.col("merged").alias("_left"))
    right = groups.select(F.col("node").alias("right"), F.col("merged").alias("_right"))
    renamed = (
        edges.join(left, "left", "left")
        .join(right, "right", "left")
        .withColumn("left", F.coalesce("_left", "left"))
        .withColumn("right", F.coalesce("_right", "right"))
    )
    return renamed.where(F.col("left") != F.col("right")).select(*names).distinct()


def root_nodes(edges: DataFrame) -> DataFrame:
    """Nodes with outgoing edges only."""
    targets = edges.select(F.col("right").alias("node")).distinct()
    return edges.select(F.col("left").alias("node")).distinct().join(targets, "node", "left_anti")


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)``: connected components, named by their least node.

    Each round every node takes the least label among itself and its neighbours and then the
    label of that label, which shortens long chains. The minimum per node is combined before
    the shuffle, so a node with a third of all edges is not collected anywhere.
    """
    both = edges.select("left", "right").unionByName(
        edges.select(F.col("right").alias("left"), F.col("left").alias("right"))
    )
    links = written(both.distinct())
    labels = written(
        links.groupBy(F.col("left").alias("node")).agg(F.least(F.min("right"), F.min("left")).alias("component"))
    )
    while True:
        heard = links.join(labels, F.col("right") == F.col("node")).select(
            F.col("left").alias("node"), "component"
        )
        lowest = labels.unionByName(heard).groupBy("node").agg(F.min("component").alias("component"))
        ahead = lowest.select(F.col("node").alias("component"), F.col("component").alias("further"))
        jumped = written(
            lowest.join(ahead, "component", "left").select(
                "node", F.least("component", F.coalesce("further", "component")).alias("component")
            )
        )
        old = labels.select("node", F.col("component").alias("old"))
        if jumped.join(old, "node").where(F.col("component") != F.col("old")).isEmpty():
            return jumped
        labels = jumped


WORD = 63  # roots per word of bits; the sign bit stays unused


def reached_by(start: DataFrame, steps: DataFrame) -> DataFrame:
    """``(root, state)``: every state that can be reached from each root.

    ``start`` holds ``(root, state)``, ``steps`` ``(state, next)``; a state is any orderable value. Roots are bits: a row
    holds the roots of one word that reach one state, so there are as many rows as states, not as root and state
    pairs, until the result is read off. Each round hands on only the bits that are new.
    """
    ordered = Window.orderBy("root")  # roots are metadata, one row each
    numbers = start.select("root").distinct().withColumn("_n", F.row_number().over(ordered) - 1)
    numbers = written(numbers.select("root", F.floor(F.col("_n") / WORD).alias("word"), (F.col("_n") % WORD).cast("int").alias("bit")))
    own = start.join(numbers, "root").select("state", "word", F.expr("shiftleft(1L, bit)").alias("bits"))
    known = written(own.groupBy("state", "word").agg(F.bit_or("bits").alias("bits")))
    fresh = known
    steps = written(steps.distinct())
    while True:
        handed = fresh.join(steps, "state").groupBy(F.col("next").alias("state"), "word").agg(F.bit_or("bits").alias("_new"))
        both = known.join(handed, ["state", "word"], "full").withColumn("bits", F.coalesce("bits", F.lit(0).cast("long")))
        both = both.withColumn("_new", F.coalesce("_new", F.lit(0).cast("long")).bitwiseAND(F.bitwise_not("bits")))
        both = written(both)
        fresh = both.where("_new <> 0").select("state", "word", F.col("_new").alias("bits"))
        known = both.select("state", "word", F.col("bits").bitwiseOR(F.col("_new")).alias("bits"))
        if fresh.isEmpty():
            break
    places = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.getbit("bits", i) == 1)
    return known.select("state", "word", F.explode(places).alias("bit")).join(numbers, ["word", "bit"]).select("root", "state")

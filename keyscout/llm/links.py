"""Comparing the members of buckets in bounded blocks, and connected components of the links found."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyscout.llm.common import stored


def in_blocks(postings: DataFrame, key: str, member: str, block_rows: int = 4000) -> DataFrame:
    """Postings dealt out so that each two members of a bucket meet in exactly one block pair.

    A bucket of up to ``block_rows`` members is the one pair (0, 0). A larger one is split by a hash
    of the member into k blocks, and a member goes to the k pairs that contain its block, so no task
    gets more than two blocks of a bucket and all pairs are still compared. Adds ``block_i``,
    ``block_j`` and ``block``; rows come sorted by key and block pair.
    """
    sizes = postings.groupBy(key).agg(F.count("*").alias("bucket_rows")).where(F.col("bucket_rows") > 1)
    sizes = sizes.select(key, F.ceil(F.col("bucket_rows") / block_rows).cast("int").alias("blocks"))
    met = postings.join(sizes, key).withColumn("block", F.pmod(F.xxhash64(member), F.col("blocks")).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda x: F.struct(F.least(x, F.col("block")).alias("block_i"), F.greatest(x, F.col("block")).alias("block_j")),
    )
    dealt = met.withColumn("pair", F.explode(pairs)).select(*postings.columns, "block", "pair.block_i", "pair.block_j")
    return dealt.repartition(key, "block_i", "block_j").sortWithinPartitions(key, "block_i", "block_j")


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Batches sorted by key and block pair, cut anew so that no block pair is split between two tables."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        ids = [table.column(c).to_numpy() for c in (key, "block_i", "block_j")]
        other = np.flatnonzero(np.logical_or.reduce([x != x[-1] for x in ids]))
        if len(other):
            cut = int(other[-1]) + 1
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
        else:
            held = table.to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def star_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest node of its component; as many as there are nodes, less one each."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b): a row (node, component) for each node, component its smallest node.

    Alternates between hanging larger neighbours and smaller neighbours on the smallest one until
    nothing changes; every step is an aggregate and a join of edges, written to the shared folder.
    Links of a node with itself and repeated links are allowed; null ends are ignored.
    """
    larger = F.greatest("a", "b").alias("u")
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(larger, F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = hung.groupBy("u").agg(F.min("v").alias("m"))
        small = hung.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = stored(small.distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

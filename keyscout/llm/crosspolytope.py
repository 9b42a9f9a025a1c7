"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

A hash is the largest coordinate, with its sign, of a vector after three rounds of random signs and a Hadamard
transform. A table joins several hashes to a bucket, as many as keep buckets small at the number of vectors there are.
A vector lies in one bucket of each table and also looks into the buckets next in line, where one hash takes its
second-best coordinate (multiprobe). In a bucket, members are compared by cosine in double precision; a pair counts at
the first place at which it meets, which both sides can tell from their hashes, so no pair is listed or made distinct.
Large buckets are dealt out in block pairs. What leaves a bucket is a number of links per vector and a forest.

Equal vectors form a class first and are hashed once. Vectors that are null, empty, zero or hold null or non-finite
components link with nothing and are their own component; vectors of different lengths never link. Rows with a null id
are compared like all others but never name a component unless it has no id. Repeated rows are vectors of their own.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyscout.llm.common import stored
from keyscout.llm.links import components, in_blocks, star_forest, whole_groups

COSINE = 0.95
TABLES = 8
PROBES = 3
#: Vectors that a bucket holds on average at most, for vectors without near copies.
BUCKET_ROWS = 32


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row; the row length is a power of two."""
    n, step = x.shape[1], 1
    while step < n:
        x = x.reshape(len(x), -1, 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(-1, n)
        step *= 2
    return x / math.sqrt(n)


def rotated(vectors: np.ndarray, seed: int) -> np.ndarray:
    """Vectors, padded to a power of two, after three rounds of random signs and transform."""
    size = 1 << max(1, (vectors.shape[1] - 1).bit_length())
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (3, size))
    x = np.zeros((len(vectors), size))
    x[:, : vectors.shape[1]] = vectors
    for s in signs:
        x = hadamard(x * s)
    return x


def buckets(vectors: np.ndarray, tables: int, hashes: int, probes: int) -> np.ndarray:
    """Bucket numbers [vector, table, 1 + probes]; the first is the vector's own."""
    out = np.zeros((len(vectors), tables, 1 + probes), np.int64)
    for t in range(tables):
        ranked, losses = [], []
        for k in range(hashes):
            x = rotated(vectors, t * 64 + k)
            size = x.shape[1]
            two = np.argpartition(-np.abs(x), 1, axis=1)[:, :2] if size > 2 else np.tile([0, 1], (len(x), 1))
            height = np.take_along_axis(x, two, 1)
            order = np.argsort(-np.abs(height), axis=1, kind="stable")
            two, height = np.take_along_axis(two, order, 1), np.take_along_axis(height, order, 1)
            ranked.append(2 * two + (height < 0))
            losses.append(np.abs(height[:, 0]) - np.abs(height[:, 1]))
        base = 2 * size
        swaps = [s for n in range(1, hashes + 1) for s in combinations(range(hashes), n)]
        cost = np.stack([sum(losses[k] for k in s) for s in swaps], 1)
        best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        own = np.zeros(len(vectors), np.int64)
        for k in range(hashes):
            own = own * base + ranked[k][:, 0]
        out[:, t, 0] = own
        moved = np.zeros((len(vectors), len(swaps)), np.int64)
        for i, swap in enumerate(swaps):
            for k in range(hashes):
                moved[:, i] = moved[:, i] * base + ranked[k][:, int(k in swap)]
        picked = np.take_along_axis(moved, best, 1)
        out[:, t, 1 : 1 + picked.shape[1]] = picked
        out[:, t, 1 + picked.shape[1] :] = own[:, None]
    return out


def usable(vector: Column) -> Column:
    """Whether a vector may link with others."""
    plain = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(plain & F.exists(vector, lambda x: x != 0), F.lit(False))


def _postings(classes: DataFrame, tables: int, hashes: int, probes: int) -> DataFrame:
    """(key, cid, main, n, vector, codes): a row per bucket that a class lies in or looks into."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                column = part.column("vector")
                sizes = np.diff(column.offsets.to_numpy())
                for size in np.unique(sizes):
                    rows = np.flatnonzero(sizes == size)
                    own = part.take(pa.array(rows))
                    vectors = own.column("vector").flatten().to_numpy().reshape(-1, size).astype(np.float64)
                    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
                    found = buckets(vectors / np.linalg.norm(vectors, axis=1, keepdims=True), tables, hashes, probes)
                    keys = _keys(found, int(size)).reshape(len(rows), -1)
                    width = keys.shape[1]
                    copies = np.repeat(np.arange(len(rows)), width)
                    main = np.tile(np.arange(width) % (1 + probes) == 0, len(rows))
                    first = np.ones(len(copies), bool)
                    for p in range(1, 1 + probes):  # a probe that repeats the own bucket is no posting
                        first[p :: 1 + probes] = keys.reshape(-1)[p :: 1 + probes] != keys.reshape(-1)[0 :: 1 + probes]
                    copies, main, flat = copies[first], main[first], keys.reshape(-1)[first]
                    codes = pa.array(list(keys), pa.list_(pa.int64())).take(pa.array(copies))
                    picked = own.take(pa.array(copies))
                    yield pa.RecordBatch.from_arrays([pa.array(flat), picked.column("cid"), pa.array(main), picked.column("n"), picked.column("vector"), codes], ["key", "cid", "main", "n", "vector", "codes"])

    vector = classes.schema["vector"].dataType.simpleString()
    return classes.mapInArrow(compute, f"key long, cid long, main boolean, n long, vector {vector}, codes array<long>")


def _keys(found: np.ndarray, size: int) -> np.ndarray:
    """One number for table, vector length and bucket."""
    table = np.arange(found.shape[1], dtype=np.uint64)[None, :, None]
    mixed = (found.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (table * np.uint64(0xD6E8FEB86659FD93)) ^ np.uint64(size << 1)
    mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def _meetings(a: np.ndarray, b: np.ndarray, probes: int) -> np.ndarray:
    """The first key at which two classes meet, from their keys [pair, table * (1 + probes)]."""
    a, b = (x.reshape(len(x), -1, 1 + probes) for x in (a, b))
    met = np.concatenate([a[:, :, :1] == b, b[:, :, 1:] == a[:, :, :1]], axis=2)
    place = np.concatenate([b, b[:, :, 1:]], axis=2).reshape(len(a), -1)
    first = met.reshape(len(a), -1).argmax(axis=1)
    return place[np.arange(len(a)), first]


def _counted(cosine: float, probes: int):
    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "key"):
            key, i, j = (table.column(c).to_numpy() for c in ("key", "block_i", "block_j"))
            cut = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]), [True]]))
            links, forest = [], []
            cid, main, block, n = (table.column(c).to_numpy() for c in ("cid", "main", "block", "n"))
            column, codes = table.column("vector").combine_chunks(), table.column("codes").combine_chunks()
            offsets, width = column.offsets.to_numpy(), len(codes.values) // max(1, len(codes))
            flat = column.values.to_numpy(zero_copy_only=False)
            codes = codes.flatten().to_numpy().reshape(-1, width)
            for a, b in zip(cut[:-1], cut[1:]):
                if b - a < 2 or not main[a:b].any():
                    continue
                size = offsets[a + 1] - offsets[a]
                x = flat[offsets[a] : offsets[b]].reshape(b - a, size).astype(np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                for at in range(0, b - a, 1000):
                    near = x[at : at + 1000] @ x.T >= cosine
                    left, right = np.nonzero(near)
                    left += at
                    ok = (left < right) & (main[a + left] | main[a + right])
                    if i[a] != j[a]:
                        ok &= block[a + left] != block[a + right]
                    left, right = left[ok] + a, right[ok] + a
                    ok = cid[left] != cid[right]
                    left, right = left[ok], right[ok]
                    for s in range(0, len(left), 50_000):
                        u, v = left[s : s + 50_000], right[s : s + 50_000]
                        own = _meetings(codes[u], codes[v], probes) == key[a]
                        u, v = u[own], v[own]
                        links += [(cid[u], n[v]), (cid[v], n[u])]
                        if len(u):
                            forest.append(star_forest(cid[u], cid[v]))
            if links:
                who, much = (np.concatenate(c) for c in zip(*links))
                who, place = np.unique(who, return_inverse=True)
                much = np.bincount(place, much, len(who)).astype(np.int64)
                a, b = star_forest(*map(np.concatenate, zip(*forest))) if forest else (who[:0], who[:0])
                cid_ = np.concatenate([who, a])
                yield pa.RecordBatch.from_arrays([pa.array(cid_), pa.array(np.concatenate([much, np.zeros(len(a), np.int64)])), pa.array(np.concatenate([who, b]))], ["a", "links", "b"])

    return compute


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES, hashes: int | None = None, block_rows: int = 1000) -> DataFrame:
    """(id_col, n_links, component_id, kept) of each row."""
    held = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    good = held.where(usable(F.col("vector")))
    classes = good.groupBy("vector").agg(F.min("id").alias("first_id"), F.count("*").alias("n")).withColumn("cid", F.monotonically_increasing_id())
    classes = stored(classes, "vectors")
    count, size = classes.agg(F.count("*"), F.max(F.size("vector"))).first()
    if hashes is None:
        hashes = max(1, math.ceil(math.log(max(1, count / BUCKET_ROWS)) / math.log(2 << max(1, ((size or 2) - 1).bit_length()))))
    postings = _postings(classes.select("cid", "n", "vector"), tables, hashes, probes)
    counted = in_blocks(postings, "key", "cid", block_rows).mapInArrow(_counted(cosine, probes), "a long, links long, b long")
    counted = stored(counted, "links")
    totals = counted.groupBy("a").agg(F.sum("links").alias("others")).withColumnRenamed("a", "cid")
    reached = components(counted.select("a", "b")).withColumnRenamed("node", "cid")
    joined = classes.join(reached, "cid", "left").join(totals, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    smallest = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = joined.join(smallest, "component").select("vector", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    linked = good.join(known, "vector").select("id", "n_links", "component_id")
    alone = held.where(~usable(F.col("vector"))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    both = linked.unionByName(alone)
    return both.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))

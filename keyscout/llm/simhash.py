"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most 4 bits agree in at least 4 of their 8 bytes. An index
by single bytes would have lists that hold a 256th of the corpus, so lists are keyed by three bytes at
three positions. Twenty triples are enough for any four positions to contain one of them, hence each
linked pair meets in a list. In the lists, the shared positional bytes of a pair are tallied, pairs
that reach the guaranteed minimum stay, and their differing bits are counted.

Nulls and empty texts have fingerprint zero and are linked like any other. Rows with a null id get the
component of their fingerprint; they never name a component unless it has no other id, which then is
null. Repeated rows are kept as rows. Other columns of the input are not read, so their names are free.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyscout.llm.common import slices, stored, texts_of
from keyscout.llm.links import components, in_blocks, star_forest, whole_groups

MAX_BITS = 4
MIN_BYTES = 8 - MAX_BITS


def _triples() -> list[tuple[int, int, int]]:
    """Twenty triples of the 8 byte positions such that any four positions contain one.

    The positions form three classes of 3, 3 and 2; taken are the triples inside a class and those
    with two positions in a class and one in the next.
    """
    classes = {p: p // 3 for p in range(8)}
    chosen = []
    for triple in combinations(range(8), 3):
        kinds = sorted(classes[p] for p in triple)
        twice = next((k for k in range(3) if kinds.count(k) >= 2), None)
        if twice is not None and all(k in (twice, (twice + 1) % 3) for k in kinds):
            chosen.append(triple)
    return chosen


TRIPLES = _triples()


def fingerprint(words: list[bytes], shingle: int = 4, seed: int = 42) -> int:
    """SimHash of one text's words."""
    return int(_fingerprints([words], shingle, seed)[0])


def _fingerprints(docs: list[list[bytes]], shingle: int, seed: int) -> np.ndarray:
    """SimHash of each text's words, as unsigned 64-bit numbers."""
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = np.zeros(len(docs), np.int64)
    for i, words in enumerate(docs):
        n = len(words)
        if not n:
            continue
        joined = b" ".join(words)
        if n <= shingle:
            hashes.append(digest(joined, seed))
            counts[i] = 1
            continue
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate([[0], ends[: n - shingle] + 1]).tolist()
        hashes.extend([digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist())])
        counts[i] = n - shingle + 1
    out = np.zeros(len(docs), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        firsts = np.cumsum(counts[full]) - counts[full]
        set_in = np.add.reduceat(bits, firsts, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * set_in > counts[full][:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """(id, fp) of each row; fp holds the 64 bits as a long."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            found = [np.zeros(0, np.uint64)]
            for a, b in slices(map(len, texts), 1_500_000):
                found.append(_fingerprints([t.lower().split() for t in texts[a:b]], shingle, seed))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.concatenate(found).view(np.int64))], ["id", "fp"])

    return rows.mapInArrow(compute, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def _linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside each block pair, thinned to a forest that keeps its components."""
    for table in whole_groups(batches, "key"):
        ids = [table.column(c).to_numpy() for c in ("key", "block_i", "block_j")]
        fp, block = table.column("fp").to_numpy(), table.column("block").to_numpy()
        group = np.cumsum(np.concatenate([[False], np.logical_or.reduce([x[1:] != x[:-1] for x in ids])]))
        inside = ids[1] == ids[2]
        at, step, edges = np.arange(len(fp)), 1, []
        while True:
            at = at[at + step < len(fp)]
            at = at[group[at] == group[at + step]]
            if not len(at):
                break
            differ = fp[at] ^ fp[at + step]
            shared = np.count_nonzero(differ.view(np.uint8).reshape(-1, 8) == 0, axis=1)
            near = (shared >= MIN_BYTES) & (inside[at] | (block[at] != block[at + step]))
            near[near] = np.bitwise_count(differ[near].view(np.uint64)) <= MAX_BITS
            edges.append((fp[at[near]], fp[at[near] + step]))
            if sum(len(a) for a, _ in edges) > 2_000_000:
                edges = [star_forest(*map(np.concatenate, zip(*edges)))]
            step += 1
        if edges:
            a, b = star_forest(*map(np.concatenate, zip(*edges)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def near_links(prints: DataFrame, block_rows: int = 4000) -> DataFrame:
    """Links (a, b) between distinct fingerprints of column ``fp`` that keep the components of all links."""
    byte = [F.shiftrightunsigned(F.col("fp"), 8 * p).bitwiseAND(F.lit(255)) for p in range(8)]
    keys = [F.lit(i << 24) + byte[p] * F.lit(1 << 16) + byte[q] * F.lit(1 << 8) + byte[r] for i, (p, q, r) in enumerate(TRIPLES)]
    postings = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    return in_blocks(postings, "key", "fp", block_rows).mapInArrow(_linked, "a long, b long")


def _rooted(prints: DataFrame) -> DataFrame:
    """(fp, first_id, component): each distinct fingerprint, its smallest id, and the smallest fingerprint reachable over links."""
    classes = stored(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "classes")
    reached = components(near_links(classes.select("fp")))
    return classes.join(reached.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """(id_col, fp, component_id): each row's fingerprint and the smallest id reachable over links."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    rooted = _rooted(prints)
    smallest = rooted.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(smallest, "component").select("fp", "component_id")
    return prints.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of ``docs``: the one with the smallest id, null ids last, then the smallest hash.

    Rows are told apart by a key of their own, so ids may be null or repeated and components may share them.
    """
    held = stored(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("key")), "rows")
    own = F.col("row")[id_col]
    order = F.struct(own.isNull().alias("no_id"), own.alias("own"), F.xxhash64("row").alias("hash"), "key")
    prints = stored(fingerprints(held.select(order.alias("at"), F.col("row")[text_col].alias("text")), "at", "text"), "fingerprints")
    first = _rooted(prints).groupBy("component").agg(F.min("first_id").alias("at"))
    return held.join(first.select("at.key"), "key", "left_semi").select("row.*")

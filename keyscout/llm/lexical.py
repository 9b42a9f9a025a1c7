"""Ranked lexical search over an inverted index whose posting lists are blocked by document similarity.

Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z lower-cased. A document's score
for an item adds, over the item's terms, the term's weight times a saturating, length-normed count, in whole numbers.

The index is built in Spark: documents become sparse vectors of term counts, are sorted by the signs of a random
projection, and are cut into shards of similar documents. In a shard each term has its posting list; a long list is
clustered around some of its own documents by the cosine of their projections, and each cluster is cut into blocks. A block
keeps the greatest contribution of every coordinate (of the block's own term and of more frequent ones). A document
is due in the block of its rarest asked term, and there the sum of the asked maxima is at least its score; a block is
skipped only where that exact bound is below what the search already holds. Documents of other blocks are scored
from their whole vectors, so that the result equals a search of all documents.

Items are searched in batches of about ``BATCH_BYTES`` of text (or one longer item); only terms of the batch are
indexed, which bounds what goes to the tasks. Each task passes on its best documents of each item. Shards are cut by
size, so copies and frequent terms are spread over many; nothing is dropped.

Null and empty texts hold no terms: such documents are never found and count nowhere, such items find nothing. Repeated
rows of documents are documents each; equal scores are ordered by id, null ids last, then by their place in the input.
Repeated items are searched once, different texts of one item each. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyscout.llm.common import slices, stored

BATCH_BYTES = 4_000_000
SHARD_DOCS, SHARD_COUNTS = 4096, 1 << 19
BLOCK_DOCS = 64
PROJECTION, PLACE_BITS = 32, 16
SHARED_COORDINATES = 50_000_000   # up to so many pairs of terms, blocks keep only coordinates asked together
TOP = 50

VECTORS = "row long, doc_id long, n long, terms array<int>, counts array<int>"
PLACED = "place int, row long, doc_id long, n long, terms array<int>, counts array<int>"
_PARTS = {
    "ids": np.int64, "nulls": np.uint8, "rows": np.int64, "lengths": np.int64, "starts": np.int64, "terms": np.int32, "counts": np.int32,
    "block_terms": np.int32, "block_starts": np.int64, "block_docs": np.int32, "peak_starts": np.int64, "peak_terms": np.int32, "peaks": np.int64,
}
INDEX = ", ".join(f"{c} binary" for c in _PARTS)

# Bytes as the tokeniser sees them: A-Z in lower case, ASCII other than letters and digits as spaces.
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[:128] = [ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)]


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The terms of texts as codes, how many each text has, and the term of each code. A null text has none."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(_BYTES[data].tobytes()))
    split = pc.ascii_split_whitespace(plain)
    words = split.flatten()
    full = pc.binary_length(words).to_numpy() > 0
    upto = np.concatenate([[0], np.cumsum(full)])[split.offsets.to_numpy() - split.offsets[0].as_py()]
    coded = words.filter(pa.array(full)).dictionary_encode()
    return coded.indices.to_numpy(), np.diff(upto), coded.dictionary


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, pa.int32()))


def _vectors(terms: list[str]) -> Callable:
    """Documents as sorted term numbers and counts of the given terms, and the number of all their terms."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(terms, pa.large_string())
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), 8_000_000):
                codes, sizes, words = terms_of(texts.slice(a, b - a))
                number = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64) if len(words) else np.zeros(0, np.int64)
                number = number[codes]
                text = np.repeat(np.arange(b - a), sizes)
                key, times = np.unique((text * len(terms) + number)[number >= 0], return_counts=True)
                starts = np.searchsorted(key, np.arange(b - a + 1) * len(terms))
                own = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [own.column("row"), own.column("doc_id"), pa.array(sizes.astype(np.int64)), _lists(key % max(1, len(terms)), starts), _lists(times, starts)],
                    ["row", "doc_id", "n", "terms", "counts"],
                )

    return count


# ---- weights ----------------------------------------------------------------------------

@dataclass
class Weights:
    """Weight of each term, and the corpus figures of the length norm. Terms are renumbered from rare to frequent."""

    weight: np.ndarray
    number: np.ndarray    # new number of each term
    documents: int
    tokens: int

    @classmethod
    def of(cls, frequencies: np.ndarray, documents: int, tokens: int) -> "Weights":
        order = np.lexsort((np.arange(len(frequencies)), frequencies))
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(f) + 1))) for f in frequencies[order]]
        return cls(np.array(weight, np.int64), number, documents, tokens)

    def contributions(self, terms: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What each count adds to a score; ``lengths`` are those of the documents."""
        norm = 100 - 50 + (50 * lengths * self.documents) // self.tokens
        counts = counts.astype(np.int64)
        return self.weight[terms] * ((1_000_000_000 * counts) // (1000 * counts + 20 * norm))


def _projection(n_terms: int) -> np.ndarray:
    return np.random.default_rng(5).choice(np.array([-1, 1], np.float32), (n_terms, PROJECTION))


def project(directions: np.ndarray, terms: np.ndarray, shares: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Unit projections of documents (each with a term) given by their terms and contributions."""
    out = np.empty((len(starts) - 1, PROJECTION), np.float32)
    for a in range(0, len(out), 512):
        b = min(a + 512, len(out))
        own = slice(starts[a], starts[b])
        out[a:b] = np.add.reduceat(directions[terms[own]] * shares[own, None].astype(np.float32), starts[a:b] - starts[a])
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lists = batch.column("terms")
    starts = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy(), starts - starts[0]


def _placed(weights: Weights) -> Callable:
    """Renumbers terms and adds the place of the document's projection: its signs, in an order that changes one at a time."""

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = _projection(len(weights.weight))
        for batch in batches:
            if not batch.num_rows:
                continue
            terms, counts, starts = _flat(batch)
            terms = weights.number[terms]
            row = np.repeat(np.arange(batch.num_rows), np.diff(starts))
            order = np.lexsort((terms, row))
            terms, counts = terms[order], counts[order]
            shares = weights.contributions(terms, counts, batch.column("n").to_numpy()[row])
            signs = project(directions, terms, shares, starts)[:, :PLACE_BITS] > 0
            bits = np.bitwise_xor.accumulate(signs.astype(np.int32), axis=1)
            places = bits @ (1 << np.arange(PLACE_BITS - 1, -1, -1, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int32()), batch.column("row"), batch.column("doc_id"), batch.column("n"), _lists(terms, starts), _lists(counts, starts)],
                ["place", "row", "doc_id", "n", "terms", "counts"],
            )

    return place


# ---- shards -----------------------------------------------------------------------------

def _entries(starts: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of some documents, and where each document's entries start."""
    sizes = starts[docs + 1] - starts[docs]
    first = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(first[-1]) + np.repeat(starts[docs] - first[:-1], sizes), first[:-1]


def blocked(near: np.ndarray, block_docs: int = BLOCK_DOCS) -> list[np.ndarray]:
    """Blocks of one posting list, given the unit projections of its documents."""
    if len(near) <= block_docs:
        return [np.arange(len(near))]
    centres = near[np.linspace(0, len(near) - 1, -(-len(near) // block_docs)).astype(int)]
    cluster = (near @ centres.T).argmax(axis=1)
    order = np.argsort(cluster, kind="stable")
    edges = np.flatnonzero(np.diff(cluster[order])) + 1
    return [part[i : i + 2 * block_docs] for part in np.split(order, edges) for i in range(0, len(part), 2 * block_docs)]


def asked_together(asked: list[np.ndarray]) -> Callable[[int], np.ndarray | None]:
    """For a term, the terms from it on (the more frequent ones) that some item asks with it; None means all."""
    if sum(len(q) ** 2 for q in asked) > SHARED_COORDINATES:
        return lambda term: None
    together: dict[int, list[np.ndarray]] = {}
    for q in asked:
        for i, term in enumerate(q):
            together.setdefault(int(term), []).append(q[i:])
    united = {t: np.unique(np.concatenate(tails)) for t, tails in together.items()}
    return lambda term: united.get(term, np.zeros(0, np.int64))


def build_shard(ids, nulls, rows, lengths, starts, terms, counts, weights: Weights, directions: np.ndarray, together: Callable, block_docs: int = BLOCK_DOCS) -> dict[str, np.ndarray]:
    """A shard's documents, blocks and summaries as flat arrays."""
    shares = weights.contributions(terms, counts, np.repeat(lengths, np.diff(starts)))
    near = project(directions, terms, shares, starts)
    by_term = np.argsort(terms, kind="stable")
    holder = np.repeat(np.arange(len(ids)), np.diff(starts))[by_term]
    edges = np.flatnonzero(np.diff(terms[by_term])) + 1
    block_terms, blocks, sizes, peak_terms, peaks, peak_sizes = [], [], [], [], [], []
    wanted = np.zeros(len(weights.weight), bool)
    for list_docs, term in zip(np.split(holder, edges), terms[by_term][np.concatenate([[0], edges])]):
        own = together(int(term))
        if own is not None:
            wanted[own] = True
        for part in blocked(near[list_docs], block_docs):
            docs = list_docs[part]
            at, _ = _entries(starts, docs)
            kept = at[wanted[terms[at]]] if own is not None else at[terms[at] >= term]
            order = np.argsort(terms[kept], kind="stable")
            kept = kept[order]
            first = np.flatnonzero(np.concatenate([[True], terms[kept][1:] != terms[kept][:-1]])) if len(kept) else np.zeros(0, np.int64)
            block_terms.append(term)
            blocks.append(docs)
            sizes.append(len(docs))
            peak_terms.append(terms[kept][first])
            peaks.append(np.maximum.reduceat(shares[kept], first) if len(kept) else np.zeros(0, np.int64))
            peak_sizes.append(len(first))
        if own is not None:
            wanted[own] = False
    upto = lambda x: np.concatenate([[0], np.cumsum(x)])
    parts = (ids, nulls, rows, lengths, starts, terms, counts, block_terms, upto(sizes), np.concatenate(blocks), upto(peak_sizes), np.concatenate(peak_terms), np.concatenate(peaks))
    return {c: np.asarray(x, kind) for (c, kind), x in zip(_PARTS.items(), parts)}


def _indexed(weights: Weights, asked: list[np.ndarray], shard_docs: int, block_docs: int) -> Callable:
    """Cuts the sorted documents of a partition into shards; a row of ``INDEX`` for each."""

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions, together = _projection(len(weights.weight)), asked_together(asked)
        held: list[tuple] = []
        docs = counts = 0

        def shard() -> pa.RecordBatch:
            ids, nulls, rows, lengths, sizes, terms, times = map(np.concatenate, zip(*held))
            made = build_shard(ids, nulls, rows, lengths, np.concatenate([[0], np.cumsum(sizes)]), terms, times, weights, directions, together, block_docs)
            return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in made.values()], list(made))

        for batch in batches:
            step = min(256, shard_docs)
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                terms, times, starts = _flat(part)
                ids = part.column("doc_id")
                held.append((pc.fill_null(ids, 0).to_numpy(), pc.is_null(ids).to_numpy(zero_copy_only=False), part.column("row").to_numpy(), part.column("n").to_numpy(), np.diff(starts), terms, times))
                docs, counts = docs + part.num_rows, counts + len(terms)
                if docs >= shard_docs or counts >= SHARD_COUNTS:
                    yield shard()
                    held, docs, counts = [], 0, 0
        if held:
            yield shard()

    return build


# ---- search -----------------------------------------------------------------------------

@dataclass
class Best:
    """The best documents of one item so far: (score, null id, id, row), best first."""

    top: int
    scores: np.ndarray
    found: np.ndarray

    @classmethod
    def none(cls, top: int) -> "Best":
        return cls(top, np.zeros(0, np.int64), np.zeros((0, 3), np.int64))

    def least(self) -> int:
        """The smallest score that can still count."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, found: np.ndarray) -> None:
        good = scores >= self.least()
        scores, found = np.concatenate([self.scores, scores[good]]), np.concatenate([self.found, found[good]])
        order = np.lexsort((found[:, 2], found[:, 1], found[:, 0], -scores))[: self.top]
        self.scores, self.found = scores[order], found[order]


@dataclass
class Counts:
    """Blocks of the asked terms, and how many of them were opened."""

    blocks: int = 0
    opened: int = 0


def search_shard(shard: dict[str, np.ndarray], shares: np.ndarray, asked: list[np.ndarray], best: list[Best], n_terms: int, counts: Counts | None = None) -> None:
    """Adds a shard's documents to the best of each item."""
    counts = counts or Counts()
    is_asked = np.zeros(n_terms, bool)
    found = np.stack([shard["nulls"].astype(np.int64), shard["ids"], shard["rows"]], 1)
    for query, own in zip(asked, best):
        is_asked[query] = True
        low, high = (np.searchsorted(shard["block_terms"], query, side) for side in ("left", "right"))
        blocks = np.arange((high - low).sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(high - low)[:-1]]), high - low)
        if len(blocks):
            at, first = _entries(shard["peak_starts"], blocks)
            bound = np.add.reduceat(np.where(is_asked[shard["peak_terms"][at]], shard["peaks"][at], 0), first)
            order = np.argsort(-bound, kind="stable")
            blocks, bound = blocks[order], bound[order]
            counts.blocks += len(blocks)
            seen = np.zeros(len(found), bool)
            start, width = 0, 4
            while start < len(blocks) and bound[start] >= own.least():
                some = blocks[start : start + width][bound[start : start + width] >= own.least()]
                counts.opened += len(some)
                docs = np.unique(shard["block_docs"][_entries(shard["block_starts"], some)[0]])
                docs = docs[~seen[docs]]
                seen[docs] = True
                if len(docs):
                    at, first = _entries(shard["starts"], docs)
                    own.add(np.add.reduceat(np.where(is_asked[shard["terms"][at]], shares[at], 0), first), found[docs])
                start, width = start + width, 2 * width
        is_asked[query] = False


def _searched(weights: Weights, asked: list[np.ndarray], top: int) -> Callable:
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best.none(top) for _ in asked]
        for batch in batches:
            for r in range(batch.num_rows):
                shard = {c: np.frombuffer(batch.column(c)[r].as_buffer(), kind) for c, kind in _PARTS.items()}
                shares = weights.contributions(shard["terms"], shard["counts"], np.repeat(shard["lengths"], np.diff(shard["starts"])))
                search_shard(shard, shares, asked, best, len(weights.weight))
        item = np.repeat(np.arange(len(best)), [len(b.scores) for b in best])
        found = np.concatenate([b.found for b in best]) if best else np.zeros((0, 3), np.int64)
        scores = np.concatenate([b.scores for b in best]) if best else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(found[:, 1], pa.int64(), mask=found[:, 0] == 1), pa.array(found[:, 2]), pa.array(scores)], ["item", "doc_id", "row", "score"]
        )

    return search


def _search_batch(docs: DataFrame, items: list[tuple], top: int, shard_docs: int, block_docs: int) -> DataFrame | None:
    """Results of a few items, given as (id, text); None where there is nothing to find."""
    codes, sizes, words = terms_of(pa.array([t for _, t in items], pa.string()))
    if not len(words):
        return None
    own = [np.unique(x) for x in np.split(codes, np.cumsum(sizes)[:-1])]
    vectors = stored(docs.mapInArrow(_vectors(words.to_pylist()), VECTORS), "vectors")
    documents, tokens = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not documents:
        return None
    frequencies = np.zeros(len(words), np.int64)
    for term, n in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequencies[term] = n
    weights = Weights.of(frequencies, documents, tokens)
    asked = [np.sort(weights.number[q]) for q in own]
    placed = vectors.where(F.size("terms") > 0).mapInArrow(_placed(weights), PLACED)
    index = placed.repartitionByRange("place", "row").sortWithinPartitions("place", "row").mapInArrow(_indexed(weights, asked, shard_docs, block_docs), INDEX)
    found = stored(index, "lexical-index").mapInArrow(_searched(weights, asked, top), "item int, doc_id long, row long, score long")
    names = docs.sparkSession.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item int, item_id long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, batch_bytes: int = BATCH_BYTES, shard_docs: int = SHARD_DOCS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents (doc_id, text) of each item (item_id, text)."""
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL").distinct()
    parts = math.ceil((items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / batch_bytes)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, parts)))
    found = (_search_batch(docs, [tuple(r) for r in items.where(part == p).orderBy("item_id", "text").collect()], top, shard_docs, block_docs) for p in range(parts))
    found = [f for f in found if f is not None]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")

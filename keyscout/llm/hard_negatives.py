"""Hard negatives by windows of scores, read from Parquet blocks along a Hilbert curve.

Rows are an id, a label and a vector of whole numbers; a score is the inner product of two vectors. All rows are sorted
by width, label and place on a Hilbert curve over the dimensions that vary most, and written as Parquet files whose row
groups are the blocks. Each block, and each file, has a zone map: the least and greatest value of every dimension. For an
anchor, interval arithmetic turns a zone map into bounds of the scores that the block can hold. A block is read only
where these bounds reach into what the anchor still looks for: its best rows of the same label, and then, for each of
these positives, the best rows of other labels with ``low * positive <= 100 * score <= high * positive``. Bounds and
scores are exact whole numbers, so that no row is missed.

A task handles a bounded number of anchors of one label, holds one block at a time and depends on nothing but its anchors
and the files; a lost task is run again. Blocks are cut by size, so a label, a vector or a place on the curve that a
third of the rows share is spread over many of them. Zone maps of files are read in batches.

Rows with a null id, label, vector or component, with an empty vector, or with a component of ``LARGEST`` or beyond (where
64 bits might not hold every score of up to 4096 dimensions, in hundredths) take no part. Rows are compared with rows of their width only. Rows that are
equal in id, label and vector count once; different rows with one id are candidates each, and anchors each, but never
positives or negatives of that id. Ties go to the smaller id. Other columns are not read. No rows give no result.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyscout.llm.common import new_path
from keyscout.llm.files import opened, write_whole

LARGEST = 1 << 21
CURVE_DIMENSIONS, CURVE_BITS = 16, 3
BLOCK_VALUES = 1 << 17      # values of a block; its rows are this over the width
BLOCKS_PER_FILE = 64
ANCHORS_PER_GROUP = 256
FILES_PER_BATCH = 1024      # zone maps of files held at once
NOTHING = np.iinfo(np.int64).min

ROWS = "width int, label long, key long, id long, vector array<int>"
ZONES = "path string, width int, label long, rows long, lows array<int>, highs array<int>"
FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


# ---- the curve --------------------------------------------------------------------------

def hilbert_places(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of points given by their cells, 0 to ``2 ** bits - 1`` in each dimension."""
    x = [c.astype(np.int64) for c in cells.T]
    for level in range(bits - 1, 0, -1):
        below = (1 << level) - 1
        for i in range(len(x)):
            upper = (x[i] >> level) & 1 == 1
            swapped = np.where(upper, 0, (x[0] ^ x[i]) & below)
            x[0] = x[0] ^ np.where(upper, below, swapped)
            x[i] = x[i] ^ swapped if i else x[0]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turned = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        turned ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    place = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for c in x:
            place = place << 1 | ((c ^ turned) >> level) & 1
    return place


def _matrix(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _placed(scales: dict[int, list[tuple[int, int, int]]]) -> Callable:
    """Adds the place on the curve; ``scales`` holds (dimension, low, high) of the chosen dimensions by width."""

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            key = np.zeros(len(widths), np.int64)
            for width in np.unique(widths):
                own = np.flatnonzero(widths == width)
                x = _matrix(batch.take(pa.array(own)), "vector", int(width))
                cells = [np.clip(((x[:, d].astype(np.int64) - low) << CURVE_BITS) // (high - low + 1), 0, (1 << CURVE_BITS) - 1) for d, low, high in scales[int(width)]]
                key[own] = hilbert_places(np.stack(cells, 1), CURVE_BITS)
            yield pa.RecordBatch.from_arrays([batch.column("width"), batch.column("label"), pa.array(key), batch.column("id"), batch.column("vector")], ["width", "label", "key", "id", "vector"])

    return place


def _scales(rows: DataFrame) -> dict[int, list[tuple[int, int, int]]]:
    """The dimensions of each width that vary most, with their extremes: ``CURVE_DIMENSIONS`` rows for each width."""
    values = rows.select("width", F.posexplode("vector").alias("d", "x"))
    spread = F.coalesce(F.var_pop("x"), F.lit(0.0))
    stats = values.groupBy("width", "d").agg(spread.alias("spread"), F.min("x").alias("low"), F.max("x").alias("high"))
    rank = F.row_number().over(Window.partitionBy("width").orderBy(F.desc("spread"), "d"))
    scales: dict[int, list[tuple[int, int, int]]] = {}
    for r in stats.withColumn("rank", rank).where(F.col("rank") <= CURVE_DIMENSIONS).orderBy("width", "rank").collect():
        scales.setdefault(r["width"], []).append((r["d"], r["low"], r["high"]))
    return scales


# ---- blocks -----------------------------------------------------------------------------

def _runs(batches: Iterable[pa.RecordBatch], most: Callable[[int], int]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(width, label, ids, vectors) of sorted rows, cut where width or label change or ``most(width)`` rows are held; repeated rows once."""
    now, ids, vectors, held, last = None, [], [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        width, label, own = (batch.column(c).to_numpy() for c in ("width", "label", "id"))
        edges = np.flatnonzero((np.diff(width) != 0) | (np.diff(label) != 0)) + 1
        for a, b in zip([0, *edges], [*edges, len(width)]):
            group = (int(width[a]), int(label[a]))
            if group != now:
                if held:
                    yield *now, np.concatenate(ids), np.concatenate(vectors)
                now, ids, vectors, held, last = group, [], [], 0, None
            i, x = own[a:b], _matrix(batch.slice(a, b - a), "vector", now[0]).astype(np.int32)
            new = np.concatenate([[last is None or last[0] != i[0] or (last[1] != x[0]).any()], (i[1:] != i[:-1]) | (x[1:] != x[:-1]).any(axis=1)])
            last = i[-1], x[-1]
            i, x = i[new], x[new]
            while len(i):
                take = most(now[0]) - held
                ids.append(i[:take])
                vectors.append(x[:take])
                held += len(ids[-1])
                i, x = i[take:], x[take:]
                if held == most(now[0]):
                    yield *now, np.concatenate(ids), np.concatenate(vectors)
                    ids, vectors, held = [], [], 0
    if held:
        yield *now, np.concatenate(ids), np.concatenate(vectors)


def _text(values: np.ndarray) -> str:
    return base64.b64encode(np.ascontiguousarray(values, np.int32).tobytes()).decode()


def _written(folder: str, block_values: int) -> Callable:
    """Writes the sorted rows of a partition as files of blocks; one row with the zone map of each file."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, group, done = [], None, []

        def flush() -> None:
            if not blocks:
                return
            width = group[0]
            schema = pa.schema([("id", pa.int64()), ("vector", pa.binary(4 * width))])
            sink = pa.BufferOutputStream()
            lows, highs = np.stack([v.min(axis=0) for _, v in blocks]), np.stack([v.max(axis=0) for _, v in blocks])
            with pq.ParquetWriter(sink, schema, compression="zstd", use_dictionary=False, write_statistics=False) as writer:
                for i, v in blocks:
                    packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * width), len(v), [None, pa.py_buffer(np.ascontiguousarray(v).tobytes())])
                    writer.write_table(pa.table([pa.array(i), packed], schema=schema), row_group_size=len(i))
                writer.add_key_value_metadata({"lows": _text(lows), "highs": _text(highs)})
            path = f"{folder}/{uuid.uuid4().hex}.parquet"
            write_whole(path, sink.getvalue().to_pybytes())
            done.append((path, *group, sum(len(i) for i, _ in blocks), lows.min(axis=0).tolist(), highs.max(axis=0).tolist()))
            blocks.clear()

        for width, label, ids, vectors in _runs(batches, lambda w: max(1, block_values // w)):
            if (width, label) != group or len(blocks) >= BLOCKS_PER_FILE:
                flush()
            group = (width, label)
            blocks.append((ids, vectors))
        flush()
        columns = list(zip(*done)) if done else [()] * 6
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "width", "label", "rows", "lows", "highs"])

    return write


# ---- scores and what has been found -----------------------------------------------------

def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of whole numbers, exact; by floating point where that holds every sum."""
    bound = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < 1 << 53:
        kind = np.float32 if bound < 1 << 24 else np.float64
        return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def bounds(a: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that rows of each zone can have with each anchor."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return product(up, lows) + product(down, highs), product(up, highs) + product(down, lows)


class Best:
    """The ``k`` highest scores of each of ``n`` searches, ties by the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), NOTHING)
        self.ids = np.zeros((n, k), np.int64)
        self.filled = np.zeros(n, np.int64)

    def least(self) -> np.ndarray:
        """The score below which nothing more counts."""
        return np.where(self.filled == self.k, self.scores[:, -1], NOTHING)

    def add(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray, wanted: np.ndarray) -> None:
        """Rows of a block for the searches ``which``: a score for each search and row, and whether it is wanted."""
        if not wanted.any():
            return
        if scores.shape[1] > self.k:
            known = np.where(wanted, scores, NOTHING)
            wanted = wanted & (scores >= np.partition(known, -self.k, axis=1)[:, -self.k, None])
        at, row = np.nonzero(wanted)
        slots = np.unique(which[at])
        old = np.repeat(slots, self.filled[slots])
        place = np.arange(len(old)) - np.repeat(np.cumsum(self.filled[slots]) - self.filled[slots], self.filled[slots])
        slot = np.concatenate([old, which[at]])
        score = np.concatenate([self.scores[old, place], scores[at, row]])
        found = np.concatenate([self.ids[old, place], ids[row]])
        order = np.lexsort((found, -score, slot))
        slot, score, found = slot[order], score[order], found[order]
        first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        rank = np.arange(len(slot)) - np.repeat(first, np.diff([*first, len(slot)]))
        kept = rank < self.k
        self.scores[slot[kept], rank[kept]], self.ids[slot[kept], rank[kept]] = score[kept], found[kept]
        self.filled[slots] = np.minimum(np.bincount(np.searchsorted(slots, slot), minlength=len(slots)), self.k)


@dataclass
class Counts:
    """How many blocks there were to choose from, and how many were read."""

    blocks: int = 0
    read: int = 0


def _search(anchors: np.ndarray, batches: Iterable[pa.Table], open_window: Callable, take: Callable, counts: Counts) -> None:
    """Reads every block whose bounds reach into an open window, the most promising ones first.

    ``open_window(least, greatest)`` tells from the bounds which anchors need which zones, and ``take(ids, scores)`` gets
    the scores of all anchors with a block's rows; what it finds may close windows.
    """
    width = anchors.shape[1]
    for files in batches:
        lows, highs = (files.column(c).combine_chunks().flatten().to_numpy().reshape(-1, width) for c in ("lows", "highs"))
        least, greatest = bounds(anchors, lows, highs)
        for f in np.argsort(-greatest.max(axis=0), kind="stable"):
            if not open_window(least[:, f : f + 1], greatest[:, f : f + 1]).any():
                continue
            system, name = opened(files.column("path")[int(f)].as_py())
            with system.open_input_file(name) as source:
                file = pq.ParquetFile(source)
                zones = [np.frombuffer(base64.b64decode(file.metadata.metadata[k]), np.int32).reshape(-1, width) for k in (b"lows", b"highs")]
                low, high = bounds(anchors, *zones)
                counts.blocks += low.shape[1]
                for b in np.argsort(-high.max(axis=0), kind="stable"):
                    if open_window(low[:, b : b + 1], high[:, b : b + 1]).any():
                        table = file.read_row_group(int(b)).combine_chunks()
                        ids = table.column("id").to_numpy()
                        packed = table.column("vector").chunk(0)
                        vectors = np.frombuffer(packed.buffers()[1], np.int32, len(ids) * width, packed.offset * 4 * width).reshape(-1, width)
                        take(ids, product(anchors, vectors))
                        counts.read += 1


def mine_group(ids: np.ndarray, anchors: np.ndarray, same: Iterable[pa.Table], other: Iterable[pa.Table], positives: int, negatives: int, low: int, high: int, counts: Counts | None = None) -> list[tuple]:
    """Rows of ``FOUND`` for some anchors of one label, from the files of that label and of the others."""
    counts = counts or Counts()
    best = Best(len(ids), positives)
    every = np.arange(len(ids))

    def take_positive(own: np.ndarray, scores: np.ndarray) -> None:
        best.add(every, scores, own, (own[None, :] != ids[:, None]) & (scores >= best.least()[:, None]))

    _search(anchors, same, lambda _, most: most >= best.least()[:, None], take_positive, counts)
    owner, place = np.nonzero(np.arange(positives)[None, :] < best.filled[:, None])
    score = best.scores[owner, place]
    floor, ceiling = -(-low * score // 100), high * score // 100
    worst = Best(len(owner), negatives)
    useful = floor <= ceiling

    def opened_windows(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        return useful[:, None] & (least[owner] <= ceiling[:, None]) & (most[owner] >= np.maximum(floor, worst.least())[:, None])

    def take_negative(own: np.ndarray, scores: np.ndarray) -> None:
        from_ = np.maximum(floor, worst.least())
        for start in range(0, len(owner), ANCHORS_PER_GROUP):
            part = np.arange(start, min(start + ANCHORS_PER_GROUP, len(owner)))
            mine = scores[owner[part]]
            wanted = (mine >= from_[part, None]) & (mine <= ceiling[part, None]) & (own[None, :] != ids[owner[part], None])
            worst.add(part, mine, own, wanted)

    if useful.any():
        _search(anchors, other, opened_windows, take_negative, counts)
    return [
        (int(ids[a]), int(best.ids[a, p]), rank + 1, int(worst.ids[slot, rank]), int(score[slot]), int(worst.scores[slot, rank]))
        for slot, (a, p) in enumerate(zip(owner, place))
        for rank in range(worst.filled[slot])
    ]


def _mined(zones: str, group_rows: int, positives: int, negatives: int, low: int, high: int) -> Callable:
    def mine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, name = opened(zones)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        for width, label, ids, vectors in _runs(batches, lambda w: group_rows):
            files = ds.dataset(name, filesystem=system, format="parquet")

            def read(of_label: bool) -> Iterator[pa.Table]:
                own = ds.field("label") == label
                for batch in files.to_batches(filter=(ds.field("width") == width) & (own if of_label else ~own), batch_size=FILES_PER_BATCH):
                    if batch.num_rows:
                        yield pa.Table.from_batches([batch])

            found = mine_group(ids, vectors, read(True), read(False), positives, negatives, low, high)
            columns = list(zip(*found)) if found else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return mine


def whole_numbers(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component, in doubles; null for a vector with a null or non-finite component."""
    x = F.transform(vector, lambda v: v.cast("double"))
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(good, F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v)))


def hard_negatives(
    rows: DataFrame, anchor: Column, id_col: str = "id", label_col: str = "label", vector_col: str = "vector",
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, block_values: int = BLOCK_VALUES, group_rows: int = ANCHORS_PER_GROUP,
) -> DataFrame:
    """Rows of ``FOUND``: for each row where ``anchor`` holds, and each of its best rows of the same label, the best rows
    of other labels with a score from ``low`` to ``high`` per cent of the positive one.

    ``anchor`` is a condition on ``rows``. Vectors are arrays of whole numbers.
    """
    spark = rows.sparkSession
    fit = F.forall(F.col(vector_col), lambda x: x.isNotNull() & x.between(1 - LARGEST, LARGEST - 1)) & (F.size(vector_col) > 0)
    held = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.when(fit, F.col(vector_col)).try_cast("array<int>").alias("vector"), anchor.alias("anchor"))
    held = held.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").withColumn("width", F.size("vector"))
    scales = _scales(held)
    if not scales:
        return spark.createDataFrame([], FOUND)
    order = ["width", "label", "key", "id"]
    place = _placed(scales)
    folder = new_path(spark, "vector-blocks")
    laid = held.drop("anchor").mapInArrow(place, ROWS).repartitionByRange(*order).sortWithinPartitions(*order, "vector")
    zones = new_path(spark, "vector-zones")
    laid.mapInArrow(_written(folder, block_values), ZONES).write.parquet(zones)
    own = held.where("anchor").drop("anchor")
    count = own.count()
    tasks = max(1, min(2 * spark.sparkContext.defaultParallelism, count // 16), -(-count // group_rows))
    dealt = own.mapInArrow(place, ROWS).repartitionByRange(tasks, *order).sortWithinPartitions(*order, "vector")
    return dealt.mapInArrow(_mined(zones, group_rows, positives, negatives, low, high), FOUND)

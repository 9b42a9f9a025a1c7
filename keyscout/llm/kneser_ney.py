"""An interpolated modified Kneser-Ney model of word pairs, counted in Spark and mapped into memory by workers.

Words get the rank of their 64-bit hash among the hashes of the training words, so a pair of words is one number of
2b bits. It is scrambled by an invertible mix, and pairs are dealt to shards by ranges of the mixed number: shards are
even however common a word is, and a shard's numbers are a sorted hash array. Tasks count the pairs of many texts at a
time and send sorted runs (differences and counts) per shard; a shard is merged, written, and summed up to the context
statistics of its words (followers seen once, twice, more often; distinct predecessors), which are merged by ranges of
word ids. Workers map the arrays they touch and look up each distinct pair of a slice of texts once.

The order is 2: the arrays of an order of 3 would not fit the limits on disk that the pair arrays of this corpus fit.

Texts are lower-cased in A-Z and each ends with one end token. A null or empty text is the end token alone. Rows with
null ids are trained on as if their id were the empty text. Repeated rows count as often as they occur. Other columns
are not read. An empty training table gives a model without words, in which every token has probability 1 / (V + 1) = 1.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyscout.llm.common import new_path, slices, word_codes
from keyscout.llm.files import mapped, write_whole

#: Text bytes per shard of the words and of the pairs, and tokens that a task counts at once.
WORD_SHARD_BYTES = 64 << 20
PAIR_SHARD_BYTES = 24 << 20
TOKENS_AT_ONCE = 3_000_000
#: Stands for the end of a text; no word holds a space.
END = xxhash.xxh64_intdigest(b" ")
_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_FULL = 255


def _mix(x: np.ndarray, bits: int) -> np.ndarray:
    mask, half = np.uint64((1 << bits) - 1), np.uint64((bits + 1) // 2)
    for odd in _ODD:
        x = (x * np.uint64(odd)) & mask
        x = x ^ (x >> half)
    return x


def _unmix(x: np.ndarray, bits: int) -> np.ndarray:
    mask, half = np.uint64((1 << bits) - 1), np.uint64((bits + 1) // 2)
    for odd in reversed(_ODD):
        x = x ^ (x >> half)
        x = (x * np.uint64(pow(odd, -1, 1 << 64))) & mask
    return x


def _shard(x: np.ndarray, bits: int, shards: int) -> np.ndarray:
    """Range of equal width that holds a number of ``bits`` bits."""
    used = min(bits, 24)
    return ((x >> np.uint64(bits - used)) * np.uint64(shards)) >> np.uint64(used)


def _runs(keys: np.ndarray, counts: np.ndarray, bits: int, shards: int) -> Iterator[tuple[int, bytes, bytes, int]]:
    """Sorted keys as (shard, differences, counts, bytes per difference)."""
    cuts = np.searchsorted(_shard(keys, bits, shards), np.arange(shards + 1))
    for shard in np.flatnonzero(np.diff(cuts)):
        own = keys[cuts[shard] : cuts[shard + 1]]
        steps = np.diff(own, prepend=np.uint64(0))
        wide = 4 if len(own) > 1 and steps[1:].max() < 1 << 32 else 8
        yield int(shard), own[:1].tobytes() + steps[1:].astype(f"<u{wide}").tobytes(), counts[cuts[shard] : cuts[shard + 1]].astype("<u4").tobytes(), wide


_RUN_SCHEMA = "shard int, steps binary, counts binary, wide int"


def _run_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["shard", "steps", "counts", "wide"])


def _merged(runs: list[tuple[bytes, bytes, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and summed counts of a shard's runs."""
    keys = []
    for steps, _, wide in runs:
        own = np.concatenate([np.frombuffer(steps[:8], "<u8"), np.frombuffer(steps[8:], f"<u{wide}").astype(np.uint64)])
        keys.append(np.cumsum(own, dtype=np.uint64))
    keys, counts = np.concatenate(keys), np.concatenate([np.frombuffer(c, "<u4") for _, c, _ in runs])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[firsts], np.add.reduceat(counts, firsts, dtype=np.int64)


def _by_shard(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of batches sorted by ``column``, one list per value, without that column."""
    now, rows = None, []
    for batch in batches:
        at = batch.schema.names.index(column)
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and row[at] != now:
                yield now, rows
                rows = []
            now = row[at]
            rows.append(row[:at] + row[at + 1 :])
    if rows:
        yield now, rows


_MAPPED: dict[str, np.ndarray] = {}


def _array(path: str, dtype: str) -> np.ndarray:
    if path not in _MAPPED:
        if len(_MAPPED) > 4096:
            _MAPPED.clear()
        _MAPPED[path] = mapped(path, dtype)
    return _MAPPED[path]


@dataclass
class Discounts:
    """What is taken off counts of 1, 2 and more, and from how many counts of each."""

    of: tuple[float, float, float]

    @classmethod
    def from_counts(cls, n: np.ndarray) -> Discounts:
        """From how many counts are 1, 2, 3 and 4; fixed ones where the estimate does not exist."""
        n1, n2, n3, n4 = (float(x) for x in n)
        if not all((n1, n2, n3, n4)):
            return cls((0.5, 1.0, 1.5))
        y = n1 / (n1 + 2 * n2)
        return cls(tuple(min(max(k - (k + 1) * y * b / a, 0.0), float(k)) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))))

    def off(self, counts: np.ndarray) -> np.ndarray:
        return np.array([0.0, *self.of])[np.minimum(counts, 3)]


@dataclass
class Model:
    """Where the arrays are and the totals; small enough to go to every task."""

    folder: str
    texts: int = 0
    tokens: int = 0
    word_sizes: list[int] = field(default_factory=list)
    pair_shards: int = 1
    pair_sizes: dict[int, tuple[int, int]] = field(default_factory=dict)
    pairs: Discounts | None = None
    words: Discounts | None = None
    #: Distinct pairs, and how many words have 1, 2 and more distinct predecessors.
    types: int = 0
    left: tuple[int, int, int] = (0, 0, 0)
    #: Distinct first words that were seen once, twice and more often.
    started: tuple[int, int, int] = (0, 0, 0)

    @property
    def vocabulary(self) -> int:
        return sum(self.word_sizes)

    @property
    def bits(self) -> int:
        """Bits of a word id; the id after the last word stands for the start of a text."""
        return max(2, self.vocabulary.bit_length())

    @property
    def bases(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.word_sizes)]).astype(np.int64)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of word hashes, -1 for unknown ones."""
        order = np.argsort(hashes)
        keys = hashes[order]
        cuts = np.searchsorted(_shard(keys, 64, len(self.word_sizes) or 1), np.arange(len(self.word_sizes) + 1))
        out = np.full(len(keys), -1, np.int64)
        for shard, base in enumerate(self.bases[:-1]):
            a, b = cuts[shard], cuts[shard + 1]
            if a < b and self.word_sizes[shard]:
                known = _array(f"{self.folder}/words-{shard}.hash", "<u8")
                at = np.searchsorted(known, keys[a:b])
                hit = known[np.minimum(at, len(known) - 1)] == keys[a:b]
                out[a:b] = np.where(hit, base + at, -1)
        back = np.empty_like(out)
        back[order] = out
        return back

    def of_words(self, name: str, dtype: str, ids: np.ndarray, columns: int = 1) -> np.ndarray:
        """Values of an array that has ``columns`` numbers per word, for known ids."""
        out = np.zeros((len(ids), columns), np.int64)
        part = np.searchsorted(self.bases, ids, side="right") - 1
        for shard in np.unique(part):
            at = np.flatnonzero(part == shard)
            out[at] = _array(f"{self.folder}/words-{shard}.{name}", dtype).reshape(-1, columns)[ids[at] - self.bases[shard]]
        return out

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted mixed pairs."""
        out = np.zeros(len(keys), np.int64)
        cuts = np.searchsorted(_shard(keys, 2 * self.bits, self.pair_shards), np.arange(self.pair_shards + 1))
        for shard, (size, more) in self.pair_sizes.items():
            a, b = cuts[shard], cuts[shard + 1]
            if a == b or not size:
                continue
            known = _array(f"{self.folder}/pairs-{shard}.key", "<u8")
            at = np.minimum(np.searchsorted(known, keys[a:b]), size - 1)
            found = np.where(known[at] == keys[a:b], _array(f"{self.folder}/pairs-{shard}.count", "u1")[at], 0).astype(np.int64)
            if more and len(full := np.flatnonzero(found == _FULL)):
                large = _array(f"{self.folder}/pairs-{shard}.large", "<u8").reshape(2, more)
                found[full] = large[1][np.searchsorted(large[0], keys[a:b][full])]
            out[a:b] = found
        return out


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _sequences(codes: np.ndarray, counts: np.ndarray, end: int) -> np.ndarray:
    """The codes with ``end`` after each text."""
    return np.insert(codes.astype(np.int64), np.cumsum(counts), end)


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """The model of all texts of ``docs``."""
    spark = docs.sparkSession
    model = Model(new_path(spark, "kneser-ney"))
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    model.texts, size = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    if not model.texts:
        return model
    word_shards, model.pair_shards = -(-(size + 1) // WORD_SHARD_BYTES), -(-(size + 1) // PAIR_SHARD_BYTES)
    folder = model.folder

    def count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for codes, counts, words in _coded(batches):
            held.append((np.append(_hashes(words), np.uint64(END)), np.append(np.bincount(codes, minlength=len(words)), len(counts))))
            if sum(len(k) for k, _ in held) > TOKENS_AT_ONCE // 2:
                yield _run_batch(list(_runs(*_summed(held), 64, word_shards)))
                held = []
        if held:
            yield _run_batch(list(_runs(*_summed(held), 64, word_shards)))

    def merge_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, runs in _by_shard(batches, "shard"):
            keys, counts = _merged(runs)
            write_whole(f"{folder}/words-{shard}.hash", keys.tobytes())
            write_whole(f"{folder}/words-{shard}.total", counts.astype("<u8").tobytes())
            yield pa.RecordBatch.from_pydict({"shard": [shard], "words": [len(keys)], "tokens": [int(counts.sum())]}, schema=pa.schema([("shard", pa.int32()), ("words", pa.int64()), ("tokens", pa.int64())]))

    runs = texts.mapInArrow(count_words, _RUN_SCHEMA).repartitionById(word_shards, F.col("shard")).sortWithinPartitions("shard")
    sizes = {r["shard"]: r for r in runs.mapInArrow(merge_words, "shard int, words long, tokens long").collect()}
    model.word_sizes = [sizes[i]["words"] if i in sizes else 0 for i in range(word_shards)]
    model.tokens = sum(r["tokens"] for r in sizes.values())
    _train_pairs(model, texts)
    return model


def _coded(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    for batch in batches:
        texts = batch.column("text")
        for a, b in slices(pc.binary_length(texts).to_numpy(), 4_000_000):
            yield word_codes(texts.slice(a, b - a), lower=True)


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[firsts], np.add.reduceat(counts, firsts)


def _train_pairs(model: Model, texts: DataFrame) -> None:
    bits, shards, folder, bases = model.bits, model.pair_shards, model.folder, model.bases
    start, parts = model.vocabulary, len(model.word_sizes)

    def count_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = model.ids(np.array([END], np.uint64))
        held: list[np.ndarray] = []
        for codes, counts, words in _coded(batches):
            ids = np.append(model.ids(_hashes(words)), end)
            second = ids[_sequences(codes, counts, len(words))]
            held.append(_mix(_before(second, counts + 1, start) << np.uint64(bits) | second.astype(np.uint64), 2 * bits))
            if sum(map(len, held)) > TOKENS_AT_ONCE:
                yield _run_batch(list(_runs(*np.unique(np.concatenate(held), return_counts=True), 2 * bits, shards)))
                held = []
        if held:
            yield _run_batch(list(_runs(*np.unique(np.concatenate(held), return_counts=True), 2 * bits, shards)))

    def statistics(ids: np.ndarray, values: np.ndarray, kind: int) -> Iterator[tuple]:
        """Sorted ids with rows of values, per range of ids; rows of small values take a byte per value."""
        small = (values <= 255).all(axis=1)
        for chosen, wide in ((small, 1), (~small, 4)):
            own, rows = ids[chosen], values[chosen]
            cuts = np.searchsorted(own, bases)
            for part in np.flatnonzero(np.diff(cuts)):
                a, b = cuts[part], cuts[part + 1]
                yield kind, int(part), (own[a:b] - bases[part]).astype("<u4").tobytes(), rows[a:b].astype(f"<u{wide}").tobytes(), wide

    def merge_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, runs in _by_shard(batches, "shard"):
            keys, counts = _merged(runs)
            large = counts >= _FULL
            write_whole(f"{folder}/pairs-{shard}.key", keys.tobytes())
            write_whole(f"{folder}/pairs-{shard}.count", np.minimum(counts, _FULL).astype("u1").tobytes())
            if large.any():
                write_whole(f"{folder}/pairs-{shard}.large", keys[large].tobytes() + counts[large].astype("<u8").tobytes())
            pair = _unmix(keys, 2 * bits)
            first, second = (pair >> np.uint64(bits)).astype(np.int64), (pair & np.uint64((1 << bits) - 1)).astype(np.int64)
            kinds = np.minimum(counts, 3)
            rows = [(0, shard, np.array([len(keys), large.sum(), *np.bincount(np.minimum(counts, 5), minlength=6)[1:5], *np.bincount(kinds[first == start], minlength=4)[1:4]], "<i8").tobytes(), b"", 0)]
            code, n = np.unique(first[first != start] << 2 | kinds[first != start], return_counts=True)
            owner, at = np.unique(code >> 2, return_inverse=True)
            followers = np.zeros((len(owner), 3), np.int64)
            followers[at, (code & 3) - 1] = n
            rows += statistics(owner, followers, 1)
            owner, n = np.unique(second, return_counts=True)
            rows += statistics(owner, n[:, None], 2)
            yield _stat_batch(rows)

    def merge_statistics(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _by_shard(batches, "part"):
            told = [(0, part, ids, b"", 0) for kind, ids, *_ in rows if kind == 0]
            table = np.zeros((int(bases[part + 1] - bases[part]) if part < parts else 0, 4), np.int64)
            for kind, ids, values, wide in rows:
                if kind:
                    columns = slice(0, 3) if kind == 1 else slice(3, 4)
                    table[np.frombuffer(ids, "<u4"), columns] += np.frombuffer(values, f"<u{wide}").reshape(-1, 3 if kind == 1 else 1)
            if part < parts:
                write_whole(f"{folder}/words-{part}.near", table.astype("<u4").tobytes())
                told.append((1, part, np.bincount(np.minimum(table[:, 3], 5), minlength=6).astype("<i8").tobytes(), b"", 0))
            yield _stat_batch(told)

    runs = texts.mapInArrow(count_pairs, _RUN_SCHEMA).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard")
    schema = "kind int, part int, ids binary, rows binary, wide int"
    stats = runs.mapInArrow(merge_pairs, schema).repartitionById(max(parts, 1), F.col("part")).sortWithinPartitions("part")
    told = stats.mapInArrow(merge_statistics, schema).collect()
    sizes, left = np.zeros(6, np.int64), np.zeros(6, np.int64)
    started = np.zeros(3, np.int64)
    for r in told:
        values = np.frombuffer(r["ids"], "<i8")
        if r["kind"] == 0:
            model.pair_sizes[r["part"]] = (int(values[0]), int(values[1]))
            sizes += values[:6]
            started += values[6:9]
        else:
            left += values
    model.types, model.pairs, model.words = int(sizes[0]), Discounts.from_counts(sizes[2:6]), Discounts.from_counts(left[1:5])
    model.left = (int(left[1]), int(left[2]), int(left[3:].sum()))
    model.started = tuple(int(x) for x in started)


def _stat_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["kind", "part", "ids", "rows", "wide"])


def _before(ids: np.ndarray, counts: np.ndarray, start: int) -> np.ndarray:
    """For each token the id of the one before it in its text, ``start`` at the beginning."""
    out = np.empty(len(ids), np.int64)
    out[1:] = ids[:-1]
    out[np.cumsum(counts) - counts] = start
    return out.astype(np.uint64)


def _log_scores(model: Model, codes: np.ndarray, counts: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Known tokens, base score and model score of each text."""
    V, N = model.vocabulary, model.tokens
    hashes = np.append(_hashes(words), np.uint64(END))
    ids = model.ids(hashes)
    known = ids >= 0
    total, near = np.zeros(len(ids), np.int64), np.zeros((len(ids), 4), np.int64)
    if known.any():
        total[known] = model.of_words("total", "<u8", ids[known])[:, 0]
        near[known] = model.of_words("near", "<u4", ids[known], 4)
    tokens = _sequences(codes, counts, len(words))
    own = np.repeat(np.arange(len(counts)), counts + 1)
    base = np.bincount(own, np.log10((total[tokens] + 1) / (N + V + 1)), len(counts))
    n_known = np.bincount(own, known[tokens], len(counts)).astype(np.int64)
    if not model.types:
        return n_known, base, np.zeros(len(counts)) - np.log10(V + 1) * (counts + 1)
    off = np.array(model.words.of)
    spare = float(off @ np.array(model.left))
    lower = (np.maximum(near[:, 3] - model.words.off(near[:, 3]), 0) + spare / (V + 1)) / model.types
    first = _before(tokens, counts + 1, len(ids)).astype(np.int64)
    firsts = np.append(ids, V)
    context = np.append(total, model.texts)
    spread = np.concatenate([near[:, :3], [model.started]]) @ np.array(model.pairs.of)
    pair = np.zeros(len(tokens), np.int64)
    both = (firsts[first] >= 0) & known[tokens]
    keys = _mix(firsts[first[both]].astype(np.uint64) << np.uint64(model.bits) | ids[tokens[both]].astype(np.uint64), 2 * model.bits)
    keys, places = np.unique(keys, return_inverse=True)
    pair[both] = model.pair_counts(keys)[places]
    seen = context[first]
    with np.errstate(divide="ignore", invalid="ignore"):
        upper = (np.maximum(pair - model.pairs.off(pair), 0) + spread[first] * lower[tokens]) / seen
    score = np.bincount(own, np.log10(np.where(seen > 0, upper, lower[tokens])), len(counts))
    return n_known, base, score


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, n_known, base_score, score) of each row."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(pc.binary_length(texts).to_numpy(), 4_000_000):
                codes, counts, words = word_codes(texts.slice(a, b - a), lower=True)
                scores = _log_scores(model, codes, counts, words)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), pa.array(counts + 1), *map(pa.array, scores)], ["id", "n_tokens", "n_known", "base_score", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(compute, f"id {kind}, n_tokens long, n_known long, base_score double, score double").withColumnRenamed("id", id_col)


def held_out(id_: Column, parts: int = 7, part: int = 2) -> Column:
    """Whether the CRC-32 of an id as text leaves ``part``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % parts == part


def perplexity(score: Column, n_tokens: Column) -> Column:
    return F.pow(F.lit(10.0), -score / n_tokens)


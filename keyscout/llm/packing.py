"""Packing documents into sequences by best-two-fit.

A bin is filled greedily with the longest unpacked pieces that fit. Then its smallest piece is replaced by
two unpacked pieces if a pair of them fills the expanded gap more tightly. Only lengths matter for that, and
there are at most ``capacity`` of them, so the plan is made from the count of pieces of each length: a bin's
pattern is repeated for as long as the counts last, which gives what packing the bins one by one would give.
The plan's size depends on the capacity, not on the corpus. Spark counts the lengths, ranks the pieces of a
length (inside bounded blocks, so a common length is not one task), and looks their places up in the plan.

A null text is an empty one: it has the end id alone. Documents longer than the capacity are cut into pieces
of the capacity; nothing else is cut. Rows with null or repeated ids are packed like all others. Other
columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyscout.llm.common import slices, stored

CAPACITY = 2048
END_ID = 0
ROWS_PER_BLOCK = 100_000
#: Pieces of words whose ids a worker remembers.
REMEMBERED = 300_000

_ENCODERS: dict[str, _Encoder] = {}


class _Encoder:
    """Token ids of many texts; the ids of pieces of words are remembered.

    The tokenizer's pieces never contain white space, so the ids of a text are those of its parts between
    spaces and line ends, one after the other, and equal parts have equal ids. Parts in plain Latin letters,
    digits and signs are lower-cased and cut at the tokenizer's own pattern first, since their pieces recur
    more often than they do; any other part goes through the whole tokenizer.
    """

    #: A character that the tokenizer's Unicode normalisation may treat otherwise than by lower-casing, or a special token.
    ODD = r"[^\n!-~\u00a1-\u00ac\u00ae-\u012f\u0131-\u024f]|<\|"

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole, self.part = Tokenizer.from_file(path), Tokenizer.from_file(path)
        rules = json.loads(self.whole.to_str())
        steps = [k.get("type") for k in (rules.get("normalizer") or {}).get("normalizers", [])]
        splits = (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if steps != ["NFC", "Replace", "Lowercase"] or [k["type"] for k in splits] != ["Split", "ByteLevel"]:
            raise ValueError("the tokenizer must lower-case, drop white space and split words by a pattern")
        self.pieces = regex.compile("\n|" + splits[0]["pattern"]["Regex"])
        self.odd = regex.compile(self.ODD)
        self.part.normalizer = normalizers.Sequence([])
        self.part.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of distinct parts, one part after the other, and how many each has."""
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(parts)], pa.int32()), parts), "\n")[0].as_py()
        ends = np.cumsum(pc.utf8_length(parts).to_numpy() + 1)
        odd = np.unique(np.searchsorted(ends, [m.start() for m in self.odd.finditer(joined)], side="right"))
        if len(odd):
            words = joined.split("\n")
            odd_ids = self._ids(self.whole, [words[i] for i in odd])
            for i in odd:
                words[i] = ""
            joined = "\n".join(words)
        found = self.pieces.findall(joined.lower())
        known = self.known
        new = list(set(found) - known.keys())
        once = dict(zip(new, self._ids(self.part, new)))
        once["\n"] = b"\xff\xff\xff\xff"
        if len(known) + len(once) <= REMEMBERED:
            known.update(once)
        else:
            known = known | once
        ids = np.frombuffer(b"".join([known[x] for x in found]), "<u4")
        cuts = np.flatnonzero(ids == 0xFFFFFFFF)
        counts = np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
        ids = np.delete(ids, cuts)
        if len(odd):
            at = np.cumsum(counts) - counts
            extra = [np.frombuffer(x, "<u4") for x in odd_ids]
            ids = np.insert(ids, np.repeat(at[odd], [len(x) for x in extra]), np.concatenate(extra))
            counts[odd] = [len(x) for x in extra]
        return ids, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text after the other, and how many each has."""
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        ids, counts = self._parts(coded.dictionary)
        begins = np.cumsum(counts) - counts
        code = coded.indices.to_numpy()
        times = counts[code]
        ends = np.cumsum(times)
        if not len(ends) or not ends[-1]:
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        out = ids[np.repeat(begins[code] - (ends - times), times) + np.arange(ends[-1])]
        upto = np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return out, np.diff(upto)


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of all pieces of all rows."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(tokenizer) or _ENCODERS.setdefault(tokenizer, _Encoder(tokenizer))
        for batch in batches:
            texts = batch.column("text")
            row, piece, start, length, crc = [], [], [], [], []
            for a, b in slices(pc.binary_length(texts).to_numpy(), 6_000_000):
                ids, counts = encoder.encode(texts.slice(a, b - a))
                at = 0
                for i, count in enumerate(counts.tolist(), a):
                    own = ids[at : at + count].tobytes() + end
                    at += count
                    for k, begin in enumerate(range(0, count + 1, capacity)):
                        part = own[4 * begin : 4 * (begin + capacity)]
                        row.append(i)
                        piece.append(k)
                        start.append(begin)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (piece, start, length, crc))], ["id", "piece", "start", "length", "ids_crc32"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(compute, f"id {kind}, piece long, start long, length long, ids_crc32 long").withColumn("piece", F.col("piece").cast("int"))


@dataclass
class Plan:
    """Places by (length, rank): entry k covers ranks from ``first[k]`` of pieces with ``length[k]``.

    ``uses[k]`` consecutive ranks go to one sequence, at ``offsets[k]``; sequences count up from ``sequence[k]``.
    """

    length: np.ndarray
    first: np.ndarray
    uses: np.ndarray
    sequence: np.ndarray
    offsets: list[list[int]]
    sequences: int


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan for ``counts`` pieces of each length from 1 to ``capacity``."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    taken = np.zeros(capacity + 1, np.int64)
    entries, sequence = [], 0
    while True:
        available = np.flatnonzero(left)
        if not len(available):
            break
        bin_: list[int] = []
        gap, free = capacity, left.copy()
        while True:
            fits = available[(available <= gap) & (free[available] > 0)]
            if not len(fits):
                break
            longest = int(fits[-1])
            times = min(gap // longest, int(free[longest]))
            bin_ += [longest] * times
            free[longest] -= times
            gap -= longest * times
        pair = _tightest_pair(free, bin_[-1], gap + bin_[-1])
        if pair:
            bin_[-1:] = pair
        lengths, uses = np.unique(bin_, return_counts=True)
        times = int((left[lengths] // uses).min())
        at = 0
        for length, n in zip(lengths[::-1].tolist(), uses[::-1].tolist()):
            entries.append((length, int(taken[length]), n, sequence, [at + length * k for k in range(n)]))
            at += length * n
            taken[length] += n * times
            left[length] -= n * times
        sequence += times
    entries.sort(key=lambda e: e[:2])
    columns = list(zip(*entries)) or [(), (), (), (), ()]
    return Plan(*(np.array(c, np.int64) for c in columns[:4]), list(columns[4]), sequence)


def _tightest_pair(free: np.ndarray, smallest: int, room: int) -> list[int]:
    """Two unpacked lengths with the largest sum in (smallest, room], the longer one first; empty if there are none."""
    lengths = np.flatnonzero(free[: room + 1])
    if not len(lengths):
        return []
    longer = lengths[lengths < room]
    at = np.searchsorted(lengths, np.minimum(room - longer, longer), side="right") - 1
    longer, at = longer[at >= 0], at[at >= 0]
    at = at - ((lengths[at] == longer) & (free[longer] < 2))
    longer, at = longer[at >= 0], at[at >= 0]
    if not len(longer):
        return []
    sums = longer + lengths[at]
    best = len(sums) - 1 - int(np.argmax(sums[::-1]))
    return [int(longer[best]), int(lengths[at[best]])] if sums[best] > smallest else []


def pack(pieces: DataFrame, capacity: int = CAPACITY, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``pieces`` (from ``token_pieces``) with ``sequence_id`` and ``offset``."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = best_two_fit(counts, capacity)
    blocks = max(1, -(-sum(counts.values()) // rows_per_block))
    parted = pieces.withColumn("part", F.pmod(F.xxhash64("id", "piece"), F.lit(blocks)))
    sizes = parted.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("length", "part", F.coalesce(before, F.lit(0)).alias("first"))
    nth = F.row_number().over(Window.partitionBy("length", "part").orderBy("id", "piece", "ids_crc32"))
    ranked = parted.withColumn("nth", nth).join(starts, ["length", "part"])
    ranked = ranked.select("id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth") - 1).alias("rank"))
    keys = plan.length << 40 | plan.first

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets = [np.array(x, np.int64) for x in plan.offsets]
        flat, begins = (np.concatenate(offsets), np.cumsum([0, *map(len, offsets)])) if offsets else (keys, keys)
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            entry = np.searchsorted(keys, length << 40 | rank, side="right") - 1
            turn, slot = np.divmod(rank - plan.first[entry], plan.uses[entry])
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(plan.sequence[entry] + turn), pa.array(flat[begins[entry] + slot])], [*batch.schema.names[:5], "sequence_id", "offset"])

    kind = pieces.schema["id"].dataType.simpleString()
    return ranked.mapInArrow(place, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def packed_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of each document with its place in a sequence of at most ``capacity`` tokens."""
    pieces = stored(token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id), "pieces")
    return pack(pieces, capacity).withColumnRenamed("id", id_col)

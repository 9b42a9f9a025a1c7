"""A quality classifier: a linear support vector machine over n-gram indicators scaled by log-count ratios.

Tokens are lower-cased words, and their shapes (runs of capitals, small letters, digits and signs) with a mark where a
word repeats the one before it. Features are the words and the shapes' n-grams up to three, hashed to a fixed number of
buckets. Each feature that a text has counts once, scaled by the log ratio of its smoothed frequencies in good and bad
texts; the machine is fitted by dual coordinate descent on the squared hinge loss. A logistic curve, fitted on texts that the
machine of a first round has not seen, maps margins to scores.

The model is fitted on at most ``most_examples`` labelled rows (those with the smallest digests of their ids), and goes
to the tasks as one array of ``BUCKETS`` weights. Every row is scored over its whole text. Null and empty texts have no
features and get the score of the intercept. Rows with null or repeated ids are scored like all others; labels with null
ids or values are ignored and an id with several labels is good if most of them are. Without labels of both kinds every
score is the share of good labels, or 0.5. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyscout.llm.common import slices, stored, word_codes

BUCKETS = 1 << 18
MOST_EXAMPLES = 8000
COST = 1.0
ROUNDS = 12
CUT = 0.7

_RUNS = re.compile(rb"([A-Z])[A-Z]*|([a-z\x80-\xff])[a-z\x80-\xff]*|([0-9])[0-9]*|(.)\4*", re.S)


def word_shape(word: bytes) -> bytes:
    """Runs of capitals, small (or other) letters, digits and equal signs as one character each."""
    return _RUNS.sub(lambda m: b"A" if m[1] else b"a" if m[2] else b"0" if m[3] else m[4], word)


def _bucket(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(46)).astype(np.int64)


def text_features(codes: np.ndarray, counts: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of each distinct feature of each text, sorted."""
    hashed = lambda xs, seed: np.fromiter((xxhash.xxh64_intdigest(x, seed) for x in xs), np.uint64, len(xs))
    word = hashed([w.lower() for w in words], 1)[codes]
    shapes = hashed([word_shape(w) for w in words], 2)[codes]
    text = np.repeat(np.arange(len(counts)), counts)
    same_text = np.concatenate([[False], text[1:] == text[:-1]])[: len(text)]
    repeated = same_text & np.concatenate([[False], word[1:] == word[:-1]])[: len(text)]
    shapes = shapes + repeated.astype(np.uint64)
    features = [(text, word), (text, shapes)]
    for n in (2, 3):
        if len(text) >= n:
            gram = shapes[: len(text) - n + 1].copy()
            for k in range(1, n):
                gram = gram * np.uint64(0xD6E8FEB86659FD93) + shapes[k : len(text) - n + 1 + k]
            inside = text[: len(text) - n + 1] == text[n - 1 :]
            features.append((text[: len(text) - n + 1][inside], gram[inside]))
    key = np.unique(np.concatenate([t * BUCKETS + _bucket(x) for t, x in features]))
    return key // BUCKETS, key % BUCKETS


@dataclass
class Classifier:
    """Weight per bucket, intercept, and the curve from margins to scores."""

    weights: np.ndarray
    intercept: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * (margins + self.intercept) + self.shift, -30, 30)))


def log_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed shares of good and bad texts that have each feature."""
    shares = []
    for kind in (good, ~good):
        own = [rows[i] for i in np.flatnonzero(kind)]
        count = 1.0 + np.bincount(np.concatenate(own) if own else np.zeros(0, np.int64), minlength=BUCKETS)
        shares.append(count / count.sum())
    return np.log(shares[0] / shares[1])


def dual_descent(rows: list[np.ndarray], good: np.ndarray, ratios: np.ndarray, cost: float = COST, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights per feature value and intercept of a squared-hinge machine, by coordinate descent on its dual."""
    values = [ratios[r] / max(1e-9, float(np.linalg.norm(ratios[r]))) for r in rows]
    sign = np.where(good, 1.0, -1.0)
    balance = np.where(good, 0.5 / max(1, good.sum()), 0.5 / max(1, (~good).sum())) * len(good) * cost
    w, bias, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(rows))
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            row, x, y, d = rows[i], values[i], sign[i], 0.5 / balance[i]
            step = (y * (w[row] @ x + bias) - 1 + d * alpha[i]) / (2.0 + d)
            new = max(alpha[i] - step, 0.0)
            if new != alpha[i]:
                w[row] += (new - alpha[i]) * y * x
                bias += (new - alpha[i]) * y
                alpha[i] = new
    return w, bias


def _margins(rows: list[np.ndarray], w: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    return np.array([(w[r] @ ratios[r]) / max(1e-9, float(np.linalg.norm(ratios[r]))) for r in rows])


def _curve(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton's method on smoothed targets."""
    p, n = good.sum(), (~good).sum()
    target = np.where(good, (p + 1) / (p + 2), 1 / (n + 2))
    beta = np.array([1.0, 0.0])
    x = np.stack([margins, np.ones(len(margins))], 1)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (q - target) + 1e-3 * beta
        beta -= np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2), gradient)
    return float(beta[0]), float(beta[1])


def fit(rows: list[np.ndarray], good: np.ndarray) -> tuple[Classifier, np.ndarray]:
    """The classifier of texts given by their buckets, and the log ratios that it scales by."""
    if not len(rows) or good.all() or not good.any():
        share = float(good.mean()) if len(rows) else 0.5
        share = min(max(share, 1e-9), 1 - 1e-9)
        return Classifier(np.zeros(BUCKETS), shift=float(np.log(share / (1 - share)))), np.zeros(BUCKETS)
    seen = np.arange(len(rows)) % 5 != 0
    slope, shift = 4.0, 0.0
    if good[seen].any() and not good[seen].all() and good[~seen].any() and not good[~seen].all():
        part = [r for r, s in zip(rows, seen) if s]
        ratios = log_ratios(part, good[seen])
        w, bias = dual_descent(part, good[seen], ratios)
        slope, shift = _curve(_margins([r for r, s in zip(rows, seen) if not s], w, ratios) + bias, good[~seen])
    ratios = log_ratios(rows, good)
    w, bias = dual_descent(rows, good, ratios)
    return Classifier(w, bias, slope, shift), ratios


def held_out(id_: Column) -> Column:
    """Whether the CRC-32 of an id as text leaves 2 by 4; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_examples: int = MOST_EXAMPLES) -> tuple[Classifier, np.ndarray]:
    """The classifier from at most ``most_examples`` labelled rows that are not held out."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    marks = marks.where(~held_out(F.col("id"))).groupBy("id").agg((F.avg("label") >= 0.5).alias("good"))
    chosen = stored(marks.orderBy(F.xxhash64("id"), "id").limit(most_examples), "examples")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "id")  # at most most_examples rows

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()):
                text, bucket = text_features(*word_codes(batch.column("text").slice(a, b - a)))
                cuts = np.searchsorted(text, np.arange(b - a + 1))
                rows = [bucket[x:y].astype("<i4").tobytes() for x, y in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), batch.column("good").slice(a, b - a), pa.array(rows, pa.binary())], ["id", "good", "features"])

    kind = texts.schema["id"].dataType.simpleString()
    found = texts.mapInArrow(compute, f"id {kind}, good boolean, features binary").orderBy(F.xxhash64("id"), F.xxhash64("features")).limit(most_examples).collect()
    rows = [np.frombuffer(r["features"], "<i4").astype(np.int64) for r in found]
    return fit(rows, np.array([r["good"] for r in found], bool))


def score(docs: DataFrame, model: Classifier, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """(id_col, held_out, score, predicted) of each row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    scaled, squared = (model.weights * ratios).astype(np.float32), (ratios**2).astype(np.float32)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()):
                text, bucket = text_features(*word_codes(batch.column("text").slice(a, b - a)))
                total = np.bincount(text, scaled[bucket], b - a)
                norm = np.sqrt(np.bincount(text, squared[bucket], b - a))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), pa.array(model.scores(total / np.maximum(norm, 1e-9)))], ["id", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(compute, f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))

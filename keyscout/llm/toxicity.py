"""Toxicity by a weighted grammar of finite-state transducers over clauses.

A clause ends at a full stop, an exclamation or question mark, a semicolon or a line end. Its words become symbols: insult
(strong or weak), threat, target, negation and reporting verb, and whether quotation marks are open. Four transducers are
composed into one table: the first marks hits within ``SCOPE`` words of a negation, the second those after a reporting
verb or inside quotation marks, the third notes whether the clause has a target, and the last keeps the clause's most
serious kind of hit and how many there are. So a clause has a kind, a mode (plain, reported, negated), a number of hits
and is directed or not. The clauses of one kind and mode in a document make a pattern: whether any is directed, how many hits
they have (up to ``MOST_HITS``), and whether these are dense (one in ``SPARSE`` words or more). A document's score is the weight of
its most serious pattern; isolated words have no weight but through their clause.

The insult words are learned: prefixes of ``PREFIXES`` letters and whole words that labelled toxic documents hold and clean
ones do not. Each counts by the different words that stand before it, so that a thousand copies of a passage count
once; a log likelihood ratio decides, and of nested prefixes the most telling one stays. The weight of a pattern is
the share of toxic documents among those that hold it, drawn towards the values of ``PRIOR`` where there are few. Both
are learned from at most ``MOST_EXAMPLES`` labelled ids of each kind (those with the smallest digests); the sample is
stored once, all counting on it is done in Spark, and the grammar that goes to the tasks has at most ``MOST_ENTRIES`` entries.

Every row is scored over its whole text. Null and empty texts, like all without a matched clause, get the share of toxic
documents among such texts. Rows with null or repeated ids are scored like all others; labels with null ids or values
are ignored, and an id with several labels is toxic if any says so. Without labels of both kinds every score is the
share of toxic labels, or 0.5. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyscout.llm.common import slices, stored

MOST_EXAMPLES = 20_000
MOST_ENTRIES = 2000
PREFIXES = range(3, 9)
LEAST_DOCS, LEAST_RATIO, LEAST_EVIDENCE = 3, 3.0, 20.0
STRONG, WEAK = 0.98, 0.75
MOST_HITS, SPARSE = 5, 200
SCOPE = 3
PRIOR_COUNT = 5.0
CUT = 0.5

# Words of the grammar in English, German, French and Spanish.
THREATS = "kill hurt destroy shoot burn stab hang strangle töten umbringen erschießen verbrennen schlagen tuer frapper détruire brûler matar golpear destruir quemar".split()
TARGETS = "you your yours you're yourself u du dich dir dein deine euch tu toi te vous votre tú ti tus usted ustedes vosotros".split()
NEGATIONS = "not no never nor without isn't aren't wasn't don't doesn't didn't won't can't cannot nicht kein keine keinen keiner nie niemals ohne ne pas jamais aucun aucune sans nunca jamás ni sin".split()
REPORTS = "said says say told tells claimed claims called calls wrote writes reported reports quoted sagte sagt nannte nennt behauptet behauptete schrieb schreibt dit disait appelle appelé écrit prétend dijo dice decía llama llamó escribió".split()

INSULT, FAINT, THREAT, TARGET, NEGATION, REPORT, QUOTED = (1 << i for i in range(7))
NEGATED, REPORTED = 1 << 7, 1 << 8
HIT = INSULT | FAINT | THREAT
KINDS = {INSULT: 3, FAINT: 2, THREAT: 1}
PLAIN, TOLD, DENIED = 2, 1, 0

Pattern = tuple[int, int, int, int, int]   # kind, mode, directed, hits, dense

# Weight of a single dense hit before any document has been seen, by kind, mode and direction.
PRIOR = {
    3: ((0.25, 0.3), (0.4, 0.5), (0.8, 0.9)),
    2: ((0.05, 0.1), (0.1, 0.15), (0.15, 0.2)),
    1: ((0.02, 0.1), (0.05, 0.2), (0.1, 0.7)),
}


def prior(pattern: Pattern) -> float:
    """Weight of a pattern before any document has been seen: each further hit doubles the odds, thin ones halve them."""
    kind, mode, directed, hits, dense = pattern
    share = PRIOR[kind][mode][directed]
    odds = share / (1 - share) * 2 ** (hits - 1) * (1 if dense else 0.5)
    return odds / (1 + odds)


# ---- transducers ------------------------------------------------------------------------

@dataclass
class Transducer:
    """A deterministic transducer: ``step(state, symbol)`` gives the next state and the symbol written."""

    start: object
    step: Callable[[object, int], tuple[object, int]]


def negation(scope: int = SCOPE) -> Transducer:
    """Marks hits within ``scope`` words after a negation."""
    return Transducer(0, lambda left, s: (scope if s & NEGATION else max(0, left - 1), s | NEGATED if left and s & HIT else s))


def reporting() -> Transducer:
    """Marks hits after a reporting verb, or inside quotation marks."""
    return Transducer(0, lambda told, s: (1 if s & REPORT else told, s | REPORTED if (told or s & QUOTED) and s & HIT else s))


def target() -> Transducer:
    """Remembers in its state whether a target was named; symbols pass unchanged."""
    return Transducer(0, lambda seen, s: (1 if s & TARGET else seen, s))


def gravest() -> Transducer:
    """Keeps the most serious kind of hit as (mode, kind, hits); zeros before any."""

    def step(held: tuple[int, int, int], s: int) -> tuple[tuple[int, int, int], int]:
        if not s & HIT:
            return held, s
        mode = DENIED if s & NEGATED else TOLD if s & REPORTED else PLAIN
        kind = next(k for bit, k in KINDS.items() if s & bit)
        if held[1] and (mode, kind) < held[:2]:
            return held, s
        return (mode, kind, min(MOST_HITS, held[2] + 1) if (mode, kind) == held[:2] else 1), s

    return Transducer((0, 0, 0), step)


@dataclass
class Composed:
    """A cascade of transducers as one table of states, built as far as symbols lead."""

    machines: list[Transducer]
    table: list[dict[int, int]] = field(default_factory=list)
    states: list[tuple] = field(default_factory=list)
    numbers: dict[tuple, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self._number(tuple(m.start for m in self.machines))

    def _number(self, state: tuple) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.table.append({})
        return self.numbers[state]

    def run(self, symbols: Iterable[int]) -> tuple:
        """The states of all machines after a clause."""
        at = 0
        for s in symbols:
            to = self.table[at].get(s)
            if to is None:
                state, symbol = [], s
                for machine, own in zip(self.machines, self.states[at]):
                    own, symbol = machine.step(own, symbol)
                    state.append(own)
                to = self.table[at][s] = self._number(tuple(state))
            at = to
        return self.states[at]


def grammar() -> Composed:
    return Composed([negation(), reporting(), target(), gravest()])


# ---- words and clauses ------------------------------------------------------------------

_WORD = np.array([chr(b).isalpha() or b == 39 if b < 128 else True for b in range(256)])
_KEPT = np.where(_WORD, np.arange(256), 32).astype(np.uint8)
_END = np.isin(np.arange(256), list(b".!?;\n\r"))
_QUOTE = np.arange(256) == 34


@dataclass
class Words:
    """The words of some texts in order: code, text, clause and whether a quotation is open; and the word of each code."""

    codes: np.ndarray
    text: np.ndarray
    clause: np.ndarray
    quoted: np.ndarray
    words: pa.Array


def words_of(texts: pa.Array) -> Words:
    """Lower-cased runs of letters and apostrophes. A null text has none."""
    texts = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(_KEPT[data].tobytes()))
    split = pc.ascii_split_whitespace(plain).flatten()
    coded = split.filter(pc.greater(pc.binary_length(split), 0)).dictionary_encode()
    inside = _WORD[data]
    before = np.concatenate([[False], inside[:-1]])[: len(inside)]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    text = np.searchsorted(offsets, starts, "right") - 1
    ends, quotes = (np.concatenate([[0], np.cumsum(kind[data])]) for kind in (_END, _QUOTE))
    return Words(coded.indices.to_numpy(), text, ends[starts] + text, (quotes[starts] - quotes[offsets[text]]) % 2 == 1, coded.dictionary)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, Words]]:
    texts = batch.column("text")
    for a, b in slices(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), 4_000_000):
        yield batch.slice(a, b - a), words_of(texts.slice(a, b - a))


def _features(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, list[str]]]:
    """Whole words and prefixes: which words have one, its code, and the feature of each code; prefixes end in ``*``."""
    yield np.arange(len(words)), np.arange(len(words)), words.to_pylist()
    size = pc.utf8_length(words).to_numpy()
    for k in PREFIXES:
        long = np.flatnonzero(size >= k)
        coded = pc.utf8_slice_codeunits(words.take(pa.array(long)), 0, k).dictionary_encode()
        yield long, coded.indices.to_numpy(), [p + "*" for p in coded.dictionary.to_pylist()]


def _held(batches: Iterable[pa.RecordBatch], only: pa.Array | None = None) -> Iterator[tuple[np.ndarray, Words, np.ndarray, np.ndarray, list[str]]]:
    """(toxic flags, words, places of the words that have a feature, its codes, features), whole words and each length of prefix in turn."""
    for batch in batches:
        for part, found in _parts(batch):
            toxic = part.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            for own, codes, names in _features(found.words):
                of_word = np.full(len(found.words), -1)
                of_word[own] = codes
                if only is not None and len(names):
                    known = pc.is_in(pa.array(names, pa.string()), value_set=only).to_numpy(zero_copy_only=False)
                    of_word = np.where((of_word >= 0) & known[of_word], of_word, -1)
                at = of_word[found.codes]
                place = np.flatnonzero(at >= 0)
                yield toxic, found, place, at[place], names


def _doc_counts(only: list[str] | None) -> Callable:
    """Toxic and clean documents that hold each feature, summed over a partition."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if only is None else pa.array(only, pa.string())
        total: dict[str, list[int]] = {}
        for toxic, found, place, codes, names in _held(batches, known):
            pairs = np.unique(found.text[place] * max(1, len(names)) + codes)
            doc, code = pairs // max(1, len(names)), pairs % max(1, len(names))
            bad, good = (np.bincount(code[toxic[doc] == kind], minlength=len(names)) for kind in (True, False))
            for i in np.flatnonzero(bad + good):
                counts = total.setdefault(names[i], [0, 0])
                counts[0] += int(bad[i])
                counts[1] += int(good[i])
        bad, good = zip(*total.values()) if total else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(bad, pa.int64()), pa.array(good, pa.int64())], ["feature", "bad", "good"])

    return count


def _contexts(only: list[str]) -> Callable:
    """(feature, toxic, digest of the word before it), each once for a partition."""

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, bool, int]] = set()
        for toxic, found, place, codes, names in _held(batches, pa.array(only, pa.string())):
            digest = np.array([xxhash.xxh64_intdigest(w) >> 1 for w in found.words.to_pylist()] + [0], np.int64)
            first = (place == 0) | (found.text[np.maximum(place - 1, 0)] != found.text[place])
            before = digest[np.where(first, -1, found.codes[np.maximum(place - 1, 0)])]
            seen.update((names[c], bool(t), int(b)) for c, t, b in zip(codes, toxic[found.text[place]], before))
        columns = list(zip(*sorted(seen))) if seen else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.bool_(), pa.int64()))], ["feature", "toxic", "before"])

    return look


# ---- learning ---------------------------------------------------------------------------

def evidence(bad: float, good: float, share: float) -> float:
    """Log likelihood ratio of ``bad`` toxic and ``good`` clean sightings, where ``share`` of all words are in toxic texts; 0 if not raised."""
    total = bad + good
    if not bad or bad <= share * total or not 0 < share < 1:
        return 0.0
    return bad * math.log(bad / (share * total)) + (good * math.log(good / ((1 - share) * total)) if good else 0.0)


def nested(chosen: list[tuple[float, str, int]]) -> dict[str, int]:
    """Of features (evidence, feature, kind), the most telling of those that lie in each other: feature to kind."""
    kept: dict[str, int] = {}
    for _, name, kind in sorted(chosen, key=lambda x: (-x[0], -len(x[1]), x[1])):
        stem = name.removesuffix("*")
        shorter = any(stem[:k] + "*" in kept for k in PREFIXES if k <= len(stem))
        longer = name.endswith("*") and any(other.startswith(stem) for other in kept)
        if not shorter and not longer:
            kept[name] = kind
    return kept


@dataclass
class Model:
    """Learned insults (``*`` ends a prefix) with their symbols, the weight of each pattern seen, and that of no pattern."""

    insults: dict[str, int] = field(default_factory=dict)
    weights: dict[Pattern, float] = field(default_factory=dict)
    nothing: float = 0.5

    def symbols(self, words: pa.Array) -> np.ndarray:
        """The symbol of each word."""
        out = np.zeros(len(words), np.int64)
        for listed, bit in ((THREATS, THREAT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT)):
            out[pc.is_in(words, value_set=pa.array(listed, words.type)).to_numpy(zero_copy_only=False)] |= bit
        for k in (0, *PREFIXES):
            own = {n.removesuffix("*"): s for n, s in self.insults.items() if (len(n) - 1 == k if n.endswith("*") else k == 0)}
            if own:
                keys = words if k == 0 else pc.utf8_slice_codeunits(words, 0, k)
                at = pc.index_in(keys, value_set=pa.array(list(own), words.type))
                found = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
                out[found] |= np.array(list(own.values()))[at.take(pa.array(found)).to_numpy()]
        return out

    def clauses(self, found: Words, composed: Composed) -> list[tuple[int, int, int, int, int]]:
        """(text, kind, mode, directed, hits) of each clause with a hit."""
        symbol = self.symbols(found.words)[found.codes]
        hot = np.unique(found.clause[symbol & HIT != 0])
        start, end = np.searchsorted(found.clause, hot), np.searchsorted(found.clause, hot, "right")
        out = []
        for a, b in zip(start, end):
            symbols = symbol[a:b] | np.where(found.quoted[a:b], QUOTED, 0)
            marked = np.flatnonzero(symbol[a:b])
            gaps = np.minimum(np.diff(marked, prepend=-1) - 1, SCOPE)  # a longer gap changes no state further
            line = [s for gap, s in zip(gaps.tolist(), symbols[marked].tolist()) for s in (*[0] * gap, s)]
            _, _, directed, (mode, kind, hits) = composed.run(line)
            out.append((int(found.text[a]), kind, mode, directed, hits))
        return out

    def patterns(self, found: Words, composed: Composed) -> dict[int, list[Pattern]]:
        """The patterns of each text that has any."""
        sizes: dict[tuple[int, int, int], list[int]] = {}
        for text, kind, mode, directed, hits in self.clauses(found, composed):
            total = sizes.setdefault((text, kind, mode), [0, 0])
            total[0] |= directed
            total[1] += hits
        words = np.bincount(found.text) if sizes else None
        out: dict[int, list[Pattern]] = {}
        for (text, kind, mode), (directed, hits) in sizes.items():
            out.setdefault(text, []).append((kind, mode, directed, min(hits, MOST_HITS), int(SPARSE * hits >= words[text])))
        return out

    def score(self, patterns: list[Pattern]) -> float:
        """Score of a document from its patterns."""
        return max([self.nothing, *(self.weights.get(p, prior(p)) for p in patterns)])


def _pattern_counts(model: Model) -> Callable:
    """Toxic and clean documents with each pattern, once each; kind 0 counts those without any."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        composed, total = grammar(), {}
        for batch in batches:
            for part, found in _parts(batch):
                patterns = model.patterns(found, composed)
                for doc, toxic in enumerate(part.column("toxic").to_pylist()):
                    for pattern in patterns.get(doc, [(0, 0, 0, 0, 0)]):
                        total.setdefault(pattern, [0, 0])[0 if toxic else 1] += 1
        rows = [(*p, *n) for p, n in total.items()]
        columns = list(zip(*rows)) if rows else [()] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["kind", "mode", "directed", "hits", "dense", "bad", "good"])

    return count


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_EXAMPLES) -> Model:
    """The model of ``labels`` (doc_id, toxic), from the documents (doc_id, text) that they mark."""
    spark = docs.sparkSession
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    marked = stored(marked, "toxic-labels")
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Model(nothing=1.0 if True in sizes else 0.0 if sizes else 0.5)
    digest = F.xxhash64(F.lit("toxic"), "doc_id")
    chosen = [marked.where(F.col("toxic") == kind).orderBy(digest).limit(most) for kind in (True, False)]
    chosen = stored(chosen[0].unionByName(chosen[1]), "toxic-chosen")  # at most twice ``most`` rows, so it may be broadcast
    sample = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "toxic-sample")
    bad, good = (F.coalesce(F.sum(F.when(F.col("toxic") == kind, F.length("text"))), F.lit(0)) for kind in (True, False))
    n_bad, n_good, chars_bad, chars_good = sample.agg(F.count_if("toxic"), F.count_if(~F.col("toxic")), bad, good).first()
    if not n_bad or not n_good:
        return Model(nothing=sizes[True] / (sizes[True] + sizes[False]))
    share = chars_bad / max(1, chars_bad + chars_good)

    def counted(rows: DataFrame, only: list[str] | None) -> DataFrame:
        found = rows.mapInArrow(_doc_counts(only), "feature string, bad long, good long")
        return found.groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))

    # Features of toxic documents come first, so that the words of clean ones are only counted where they matter.
    often = counted(sample.where("toxic"), None).where(F.col("bad") >= LEAST_DOCS)
    often = [r["feature"] for r in often.orderBy(F.desc("bad"), "feature").limit(100 * MOST_ENTRIES).collect()]
    raised = counted(sample, often).where(F.col("bad") / n_bad >= LEAST_RATIO * (F.col("good") + 0.5) / (n_good + 1))
    docs_of = {r["feature"]: (r["bad"], r["good"]) for r in raised.orderBy(F.desc("bad"), "feature").limit(10 * MOST_ENTRIES).collect()}
    before = sample.mapInArrow(_contexts(list(docs_of)), "feature string, toxic boolean, before long").distinct()
    seen = before.groupBy("feature").agg(F.count_if("toxic").alias("bad"), F.count_if(~F.col("toxic")).alias("good"))
    chosen_features = []
    for r in seen.collect():
        own_bad, own_good = docs_of[r["feature"]]
        sure = (own_bad + 0.5) / n_bad / ((own_bad + 0.5) / n_bad + (own_good + 0.5) / n_good)
        told = evidence(r["bad"], r["good"], share)
        if told >= LEAST_EVIDENCE and sure >= WEAK:
            chosen_features.append((told, r["feature"], INSULT if sure >= STRONG else FAINT))
    insults = nested(sorted(chosen_features, reverse=True)[:MOST_ENTRIES])
    model = Model(insults)
    key = ["kind", "mode", "directed", "hits", "dense"]
    patterns = sample.mapInArrow(_pattern_counts(model), "kind long, mode long, directed long, hits long, dense long, bad long, good long")
    rows = patterns.groupBy(*key).agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect()
    weight_bad, weight_good = sizes[True] / n_bad, sizes[False] / n_good  # the sample is drawn by kind
    weigh = min(weight_bad, weight_good)
    for r in rows:
        own_bad, own_good = r["bad"] * weight_bad / weigh, r["good"] * weight_good / weigh
        if r["kind"] == 0:
            model.nothing = (own_bad + 0.5) / (own_bad + own_good + 1)
        else:
            pattern = tuple(r[c] for c in key)
            model.weights[pattern] = (own_bad + PRIOR_COUNT * prior(pattern)) / (own_bad + own_good + PRIOR_COUNT)
    if not any(r["kind"] == 0 for r in rows):
        model.nothing = sizes[True] / (sizes[True] + sizes[False])
    return model


def _scored(model: Model) -> Callable:
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        composed = grammar()
        for batch in batches:
            for part, found in _parts(batch):
                scores = np.full(part.num_rows, model.nothing)
                for doc, own in model.patterns(found, composed).items():
                    scores[doc] = model.score(own)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores), pa.array((scores >= CUT).astype(np.int32))], ["doc_id", "score", "predicted"])

    return score


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of each row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scored(model), "doc_id long, score double, predicted int")

"""Secret scans: base patterns, and a format model learned from the credentials that they label.

The base patterns mark assignments, access keys and hexadecimal runs, and so label credentials of these kinds.
A bounded sample of the distinct ones (``MOST_EXAMPLES`` per kind, those with the smallest digests) is put into
a prefix tree per kind over character classes. Statistically compatible states are merged (red states are kept,
blue ones join the first red state whose stop and branch frequencies differ by less than a Hoeffding bound, all the
way down) into a probabilistic automaton. Every other run of credential characters is a candidate for a kind unless it
is shorter than all labelled credentials of that kind (and than ``LONG``), or has no digit where all of these have one;
both are learned from all labelled rows. It becomes a span of kind ``format`` if the best automaton gives it a
likelihood that exceeds that of ordinary runs by a margin, both per character. Spans of base patterns always stay.

Each text is read whole, however long: for labels, for ordinary runs, and for spans. Null and empty texts have no spans. Rows with null or repeated ids
are scanned like all others. Other columns are not read. An empty table gives no rows and learns no format.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyscout.llm.common import slices, stored

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORD = re.compile(r"password|passwd|secret|token|api_?key")
#: Kinds in the order in which spans with equal starts are listed.
KINDS = ("assign", "access", "hex", "format")
MOST_EXAMPLES = 1000
#: Runs of this length are candidates even where all labelled credentials are longer.
LONG = 16
#: Verdicts remembered, by shape.
MOST_SHAPES = 200_000
#: Log10 likelihood per character by which a candidate must look more like a credential than like an ordinary run.
MARGIN = 0.15
CONFIDENCE = 0.05

_CLASSES = {c: k for k, letters in (("0", "0123456789"), ("a", "abcdef"), ("g", "ghijklmnopqrstuvwxyz"), ("A", "ABCDEF"), ("G", "GHIJKLMNOPQRSTUVWXYZ")) for c in letters}
_SHAPE = str.maketrans(_CLASSES)
_SIZES = {"0": 10, "a": 6, "g": 20, "A": 6, "G": 20}


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, credential) of all base spans, by start, then kind as listed."""
    found = []
    if KEYWORD.search(text.lower()):
        found += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidate_pattern(least: int, digit: bool) -> re.Pattern[str]:
    """Whole runs of at least ``least`` credential characters, only those that hold a digit if ``digit``."""
    return re.compile(r"(?<![A-Za-z0-9+/_.=-])" + (r"(?=[A-Za-z+/_.=-]*[0-9])" if digit else "") + rf"[A-Za-z0-9+/_.=-]{{{least},}}")


def candidates(text: str, spans: list[tuple[str, int, int, str]], pattern: re.Pattern[str]) -> list[tuple[int, str]]:
    """(start, run) of the runs that match ``pattern`` and touch no span."""
    found, at = [], 0
    ends = list(accumulate((b for _, _, b, _ in spans), max))
    for m in pattern.finditer(text):
        a, b = m.span()
        while at < len(spans) and ends[at] <= a:
            at += 1
        if at == len(spans) or spans[at][1] >= b:
            found.append((a, m[0]))
    return found


class Automaton:
    """A probabilistic automaton over the shapes of strings."""

    def __init__(self, shapes: Counter[str], confidence: float = CONFIDENCE):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[Counter] = [Counter()]
        for shape, n in sorted(shapes.items()):
            state = 0
            for c in shape:
                self.count[state][c] += n
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.next.append({})
                    self.count.append(Counter())
                state = self.next[state][c]
            self.count[state][""] += n
        self.bound = math.sqrt(0.5 * math.log(2 / confidence))
        self._merge()
        self.log = [{c: math.log10(n / sum(k.values())) for c, n in k.items()} for k in self.count]

    def _alike(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            ka, kb = self.count[a], self.count[b]
            na, nb = sum(ka.values()), sum(kb.values())
            if not na or not nb:
                continue
            most = self.bound * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
            if any(abs(ka[c] / na - kb[c] / nb) > most for c in ka.keys() | kb.keys()):
                return False
            todo += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys()]
        return True

    def _fold(self, red: int, blue: int) -> None:
        """Adds the tree below ``blue`` to the states from ``red`` on."""
        todo = [(red, blue)]
        while todo:
            a, b = todo.pop()
            self.count[a].update(self.count[b])
            for c, child in self.next[b].items():
                if c in self.next[a]:
                    todo.append((self.next[a][c], child))
                else:
                    self.next[a][c] = child

    def _merge(self) -> None:
        red, at = [0], 0
        while True:
            kept = set(red)
            edge = next(((s, c) for s in red[at:] for c in sorted(self.next[s]) if self.next[s][c] not in kept), None)
            if edge is None:
                return
            while all(t in kept for t in self.next[red[at]].values()):
                at += 1
            state, c = edge
            blue = self.next[state][c]
            twin = next((r for r in red if self._alike(r, blue)), None)
            if twin is None:
                red.append(blue)
            else:
                self.next[state][c] = twin
                self._fold(twin, blue)
                at = 0

    def score(self, shape: str, unseen: float = -4.0) -> float:
        """Log10 likelihood of a shape; a step that the automaton lacks costs ``unseen`` and starts anew."""
        state, total = 0, 0.0
        for c in shape:
            total += self.log[state].get(c, unseen)
            state = self.next[state].get(c, 0)
        return total + self.log[state].get("", unseen)


class Formats:
    """Automata per kind, and a pair model of ordinary runs to compare with.

    ``limits`` holds the least length of a kind's candidates and whether they need a digit, ``ordinary`` the number
    of each pair of neighbours in the framed shapes of all candidates.
    """

    def __init__(self, examples: dict[str, Iterable[str]], limits: dict[str, tuple[int, bool]], ordinary: Iterable[tuple[str, int]]):
        self.automata = {k: Automaton(Counter(shape(x) for x in xs)) for k, xs in examples.items() if xs}
        self.limits = limits
        self.pattern = all_candidates(limits)
        pairs: dict[str, Counter] = {}
        for (a, b), n in ordinary:
            pairs.setdefault(a, Counter())[b] += n
        self.pairs = {a: {b: math.log10((n + 0.5) / (sum(k.values()) + 6)) for b, n in k.items()} for a, k in pairs.items()}
        self.known: dict[str, float] = {}

    def gain(self, run: str) -> float:
        """How much likelier, in log10 per character, the run is as a credential than as an ordinary run."""
        s = shape(run)
        found = self.known.get(s)
        if found is None:
            if len(self.known) >= MOST_SHAPES:
                self.known.clear()
            found = self.known[s] = self._gain(s)
        return found

    def _gain(self, s: str) -> float:
        fitting = [a for k, a in self.automata.items() if len(s) >= self.limits[k][0] and ("0" in s or not self.limits[k][1])]
        if not fitting:
            return -math.inf
        framed = "^" + s + "$"
        plain = sum(self.pairs.get(a, {}).get(b, math.log10(0.5 / 6)) for a, b in zip(framed, framed[1:]))
        return (max(a.score(s) for a in fitting) - plain) / (len(s) + 1)

    def runs(self, text: str, spans: list[tuple[str, int, int, str]]) -> list[tuple[int, int]]:
        """(start, end) of the candidates that look like credentials."""
        return [(a, a + len(r)) for a, r in candidates(text, spans, self.pattern) if self.gain(r) > MARGIN]


def all_candidates(limits: dict[str, tuple[int, bool]]) -> re.Pattern[str]:
    """The pattern of the runs that are candidates for some kind."""
    return candidate_pattern(min((n for n, _ in limits.values()), default=LONG), all(d for _, d in limits.values()))


def shape(text: str) -> str:
    """Character classes of a string: digits, letters of hexadecimal numbers, other letters by case; signs stay."""
    return text.translate(_SHAPE)


def labelled(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(kind, value) of each base span."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in parts(batch):
                spans = [s for t in texts for s in base_spans(t)]
                yield pa.RecordBatch.from_arrays([pa.array([s[i] for s in spans], pa.string()) for i in (0, 3)], ["kind", "value"])

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(compute, "kind string, value string")


def parts(batch: pa.RecordBatch) -> Iterator[list[str]]:
    """The texts of a batch, null as empty, a bounded number of bytes at a time."""
    texts = batch.column("text")
    for a, b in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        yield [x or "" for x in texts.slice(a, b - a).to_pylist()]


def ordinary_pairs(docs: DataFrame, limits: dict[str, tuple[int, bool]], text_col: str = "text") -> DataFrame:
    """(pair, n) of the neighbours in the framed shapes of all candidates, each run as often as it occurs."""
    pattern = all_candidates(limits)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in parts(batch):
                pairs: Counter[str] = Counter()
                for s, n in Counter(shape(r) for t in texts for _, r in candidates(t, base_spans(t), pattern)).items():
                    framed = "^" + s + "$"
                    for a, b in zip(framed, framed[1:]):
                        pairs[a + b] += n
                yield pa.RecordBatch.from_arrays([pa.array(pairs.keys(), pa.string()), pa.array(pairs.values(), pa.int64())], ["pair", "n"])

    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(compute, "pair string, n long")
    return found.groupBy("pair").agg(F.sum("n").alias("n"))


def learn_formats(docs: DataFrame, text_col: str = "text", most_examples: int = MOST_EXAMPLES) -> Formats:
    """The format model of ``docs``; automata from at most ``most_examples`` distinct strings of each kind, ordinary pairs from all runs."""
    labels = stored(labelled(docs, text_col), "labels")
    limits = {
        r["kind"]: (min(r["least"], LONG), r["digit"])
        for r in labels.groupBy("kind").agg(F.min(F.length("value")).alias("least"), F.min(F.col("value").rlike("[0-9]")).alias("digit")).collect()
    }
    examples = {}
    for kind in KINDS[:3]:
        values = labels.where(F.col("kind") == kind).select("value").distinct()
        examples[kind] = [r[0] for r in values.orderBy(F.xxhash64("value"), "value").limit(most_examples).collect()]
    return Formats(examples, limits, [tuple(r) for r in ordinary_pairs(docs, limits, text_col).collect()] if limits else [])


def found_spans(docs: DataFrame, formats: Formats, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_spans, spans); spans as arrays of structs (kind, start, end) in order."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, full = [], []
            for texts in parts(batch):
                for text in texts:
                    spans = base_spans(text)
                    own = [dict(kind=k, start=a, end=b) for k, a, b, _ in spans]
                    more = [dict(kind="format", start=a, end=b) for a, b in formats.runs(text, spans)]
                    base.append(own)
                    full.append(sorted(own + more, key=lambda s: (s["start"], KINDS.index(s["kind"]))))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(base, pa.list_(span)), pa.array(full, pa.list_(span))], ["id", "base_spans", "spans"])

    kind = rows.schema["id"].dataType.simpleString()
    spans = "array<struct<kind:string,start:long,end:long>>"
    found = rows.mapInArrow(compute, f"id {kind}, base_spans {spans}, spans {spans}")
    return found.select("id", *(_of_kind(k).alias(f"n_{k}") for k in KINDS[:3]), "base_spans", "spans")


def _of_kind(kind: str) -> Column:
    return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_assign, n_access, n_hex, base_spans, spans) of every row of ``docs``."""
    return found_spans(docs, learn_formats(docs, text_col), id_col, text_col).withColumnRenamed("id", id_col)


def redacted(docs: DataFrame, text_col: str = "text", mark: str = "<SECRET>") -> DataFrame:
    """``docs`` with each found span replaced by ``mark``; spans that overlap are replaced together."""
    formats = learn_formats(docs, text_col)

    def clean(text: str) -> str:
        spans = base_spans(text)
        cuts = [(a, b) for _, a, b, _ in spans] + formats.runs(text, spans)
        kept, at = [], 0
        for a, b in sorted(cuts):
            if a >= at:
                kept += [text[at:a], mark]
            at = max(at, b)
        return "".join([*kept, text[at:]])

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index("text")
            texts = pa.array([None if (t := x.as_py()) is None else clean(t) for x in batch.column("text")], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], texts, *batch.columns[at + 1 :]], batch.schema.names)

    held = docs.select(F.struct(*(c for c in docs.columns if c != text_col)).alias("row"), F.col(text_col).cast("string").alias("text"))
    done = held.mapInArrow(compute, held.schema)
    return done.select(*(F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))


def joined(spans: list[dict]) -> str:
    """kind:start:end of each span, joined with commas."""
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


def digest(spans: list[dict]) -> str:
    """Lower-case hex SHA-256 of the joined spans."""
    return hashlib.sha256(joined(spans).encode()).hexdigest()

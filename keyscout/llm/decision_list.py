"""Quality rules: a decision list learned by sequential covering, emitted as Spark conditions.

Statistics of each text are plain column expressions. Labelled rows are cut at quantiles of each statistic. A rule
grows one threshold at a time by the gain in labelled bad rows against good ones; what a threshold would cover comes
from one histogram per step (statistic, bin, label, fold), so a step is an aggregate over narrow rows and a few
hundred counts on the driver. A grown rule is pruned back to the prefix that does best on the rows held out from
growing, kept if it is precise enough there, and the rows that it covers leave both folds. The rules come out as an
ordered list of conjunctions.

Main path: DataFrame expressions only. Null and empty texts have no words and all statistics 0; they fail the base
rule. Rows with null or repeated ids are judged like all others. Labels that are null are ignored; a row with several
labels counts with each. Without labels of both kinds the list is empty, and only the base rule rejects.
Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyscout.llm.common import SPACE, stored, word_list

LEAST_WORDS = 50
MOST_REPEATED = 50
BINS = 32
MOST_RULES = 8
MOST_CONDITIONS = 3
LEAST_PRECISION = 0.95
FEW_WINDOWS = 48
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_digits) of each row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = docs.select(F.col(id_col).alias("id"), text.alias("text")).select("id", "text", word_list(F.col("text")).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(f"[^{SPACE}]")))
    spaces = " \t\n\x0b\x0c\r"

    def count(characters: str) -> Column:
        return (F.length("text") - F.length(F.translate("text", characters, ""))).cast("long")

    last = F.size("words")
    windows = F.transform(
        F.slice("words", 1, F.greatest(last - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
    )
    with_windows = words.select(
        "id", F.size("words").cast("long").alias("n_words"), windows.alias("windows"), lines.alias("lines"),
        (F.length("text") - count(spaces)).cast("long").alias("word_chars"),
        *(count(c).alias(n) for n, c in (("n_symbols", SYMBOLS), ("n_upper", UPPER), ("n_digits", DIGITS))),
    )
    counted = with_windows.select(
        "id", "n_words", "word_chars", "n_symbols", "n_upper", "n_digits", "windows",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array("windows").alias("sorted"),
    )
    again = F.array_distinct(F.filter("sorted", lambda w, i: F.coalesce(w == F.get("sorted", i - 1), F.lit(False))))
    with_again = counted.select("*", again.alias("again")).drop("sorted")
    # Either way the same places: few repeated windows are looked up for each place, many are found by sorting.
    few = F.size("again") <= FEW_WINDOWS
    places = F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    sorted_ = with_again.withColumn("places", F.when(~few, places))
    equal = lambda x, i: F.coalesce(x["w"] == F.get("places", i)["w"], F.lit(False))
    looked_up = F.filter(F.transform("windows", lambda w, i: F.when(F.array_contains("again", w), i)), lambda i: i.isNotNull())
    by_sorting = F.transform(F.filter("places", lambda x, i: equal(x, i - 1) | equal(x, i + 1)), lambda x: x["i"])
    marked = sorted_.withColumn("twice", F.when(F.size("again") == 0, F.array().cast("array<int>")).when(few, looked_up).otherwise(by_sorting))
    covered = F.array_distinct(F.flatten(F.transform("twice", lambda i: F.array(i, i + 1, i + 2))))
    repeated = F.size(covered).cast("long")
    found = F.struct("n_words", "word_chars", "n_symbols", "n_dup_lines", repeated.alias("n_repeat_words"), "n_upper", "n_digits")
    # A generator of one row keeps filters on the statistics from being pushed below, where each array would be made anew for each of its elements.
    return marked.select("id", F.inline(F.array(found)))


def base_failed() -> Column:
    """The base rule over the columns of ``text_statistics``."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def features() -> dict[str, Column]:
    """Statistics that rules may test, in proportion to the text's size."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "chars_per_word": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_lines_per_word": F.col("n_dup_lines") / words,
        "repeat_share": F.col("n_repeat_words") / words,
        "upper_share": F.col("n_upper") / chars,
        "digit_share": F.col("n_digits") / chars,
    }


@dataclass(frozen=True)
class Condition:
    """``feature > cut`` or ``feature <= cut``; ``bin`` is the number of cuts up to and with this one."""

    feature: int
    name: str
    above: bool
    bin: int
    cut: float

    def on_bins(self) -> Column:
        at = F.col("bins")[self.feature]
        return at >= self.bin if self.above else at < self.bin

    def column(self) -> Column:
        value = F.col("features")[self.name]
        return value > self.cut if self.above else value <= self.cut


@dataclass
class DecisionList:
    """Rules that reject, in order; rows under none of them are kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def kept(self) -> Column:
        """The list as one conditional expression over the struct column ``features``."""
        verdict = None
        for rule in self.rules:
            verdict = (F if verdict is None else verdict).when(_all(c.column() for c in rule), F.lit(False))
        return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(f"{c.name} {'>' if c.above else '<='} {c.cut:g}" for c in rule) for rule in self.rules)


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many cuts are below a value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda x: x < value)) if cuts else F.lit(0)


def learn(labelled: DataFrame, most_rules: int = MOST_RULES, most_conditions: int = MOST_CONDITIONS, least_precision: float = LEAST_PRECISION, bins: int = BINS) -> DecisionList:
    """A decision list from rows (features struct<double...>, bad boolean, grow boolean)."""
    names = labelled.schema["features"].dataType.fieldNames()
    parts = [i / bins for i in range(1, bins)]
    quantiles = labelled.agg(*(F.percentile_approx(F.col("features")[n], parts, 10_000).alias(n) for n in names)).first()
    cuts = [sorted(set(quantiles[n] or [])) for n in names]
    bin_of = [_bin(F.col("features")[n], c) for n, c in zip(names, cuts)]
    rows = stored(labelled.select("bad", "grow", F.array(*bin_of).alias("bins")).groupBy("bad", "grow", "bins").agg(F.count("*").alias("rows")), "rule-rows")
    out = DecisionList()
    uncovered = F.lit(True)
    for _ in range(most_rules):
        rule: list[Condition] = []
        while len(rule) < most_conditions:
            here = rows.where(uncovered & _all(c.on_bins() for c in rule) & F.col("grow"))
            counts = here.select("bad", "rows", F.posexplode("bins").alias("feature", "bin")).groupBy("bad", "feature", "bin").agg(F.sum("rows").alias("n")).collect()
            best = _best_condition(counts, names, cuts)
            if best is None:
                break
            rule.append(best)
        if not rule:
            break
        prefixes = [F.sum(F.when(_all(c.on_bins() for c in rule[: k + 1]) & (F.col("bad") == bad), F.col("rows")).otherwise(0)) for k in range(len(rule)) for bad in (True, False)]
        held = rows.where(uncovered & ~F.col("grow")).agg(*(c.alias(f"c{i}") for i, c in enumerate(prefixes))).first()
        bad, good = [(x or 0) for x in held[0::2]], [(x or 0) for x in held[1::2]]
        keep = max(range(len(rule)), key=lambda k: ((bad[k] + 1) / (bad[k] + good[k] + 2), bad[k], -k))
        if bad[keep] < least_precision * (bad[keep] + good[keep]) or not bad[keep]:
            break
        rule = rule[: keep + 1]
        out.rules.append(rule)
        uncovered = uncovered & ~_all(c.on_bins() for c in rule)
    return out


def _best_condition(counts, names: list[str], cuts: list[list[float]]) -> Condition | None:
    """The threshold with the largest gain, if one has any."""
    table: dict[tuple[int, int], list[int]] = {}
    for r in counts:
        table.setdefault((r["feature"], r["bin"]), [0, 0])[not r["bad"]] += r["n"]
    best, chosen = 1e-9, None
    for f, name in enumerate(names):
        all_bad = sum(n[0] for (g, _), n in table.items() if g == f)
        all_good = sum(n[1] for (g, _), n in table.items() if g == f)
        if not all_bad or not all_good:
            continue
        before = log2(all_bad / (all_bad + all_good))
        for k, cut in enumerate(cuts[f], 1):
            bad = sum(n[0] for (g, b), n in table.items() if g == f and b >= k)
            good = sum(n[1] for (g, b), n in table.items() if g == f and b >= k)
            for above, p, n in ((True, bad, good), (False, all_bad - bad, all_good - good)):
                gain = p * (log2(p / (p + n)) - before) if p else 0.0
                if gain > best:
                    best, chosen = gain, Condition(f, name, above, k, cut)
    return chosen


def labelled_rows(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(features, bad, grow) of the statistics that have a label; a third of the ids is held out from growing."""
    marks = labels.select(F.col(id_col).alias("id"), (F.col(label_col) == 0).alias("bad")).where("id IS NOT NULL AND bad IS NOT NULL")
    named = stats.select("id", F.struct(*(c.alias(n) for n, c in features().items())).alias("features"))
    return named.join(marks, "id").select("features", "bad", (F.crc32(F.col("id").cast("string").cast("binary")) % 3 != 0).alias("grow"))


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[DataFrame, DecisionList]:
    """Statistics of each row with ``base_failed`` and ``kept``, and the list that was learned.

    All rows that pass the base rule and have a label teach the list.
    """
    stats = stored(text_statistics(docs, id_col, text_col), "statistics")
    rules = learn(labelled_rows(stats.where(~base_failed()), labels, id_col, label_col))
    with_features = stats.withColumn("base_failed", base_failed()).withColumn("features", F.struct(*(c.alias(n) for n, c in features().items())))
    return with_features.withColumn("kept", ~F.col("base_failed") & rules.kept()).drop("features").withColumnRenamed("id", id_col), rules


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` that are kept."""
    held = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    stats = stored(text_statistics(held, "row", "text"), "statistics").withColumnRenamed("id", "row")
    rules = learn(labelled_rows(stats.where(~base_failed()).withColumn("id", F.col("row")[id_col]), labels, id_col, label_col))
    judged_ = stats.withColumn("features", F.struct(*(c.alias(n) for n, c in features().items())))
    return judged_.where(~base_failed() & rules.kept()).select("row.*")

"""Foreign keys as inclusion dependencies, for single and joint keys.

Edges run from the key side (``parent``) to the referencing side (``child``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyscout import defaults
from keyscout.functions import words
from keyscout.functions.text import col, counted_as, normalize, not_blank
from keyscout.operators.histogram import FIELD
from keyscout.operators.profile import effective_type
from keyscout.operators.numbering import numbered
from keyscout.session import settled
from keyscout.sources.tables import TableKey, Tables

PARENT = ["parent_sys", "parent_table", "parent_col"]
CHILD = ["child_sys", "child_table", "child_col"]
EDGE = PARENT + CHILD

_INTEGERS = ("INTEGER", "SMALLINT", "BIGINT")


# ---- candidates from metadata -----------------------------------------------------------

def fk_candidates(
    parents: DataFrame,
    profile: DataFrame,
    systems: Sequence[str] | None = None,
    distinct_limit: bool = True,
    nullable: bool = True,
    min_avg_len: float = defaults.FK_MIN_AVG_LEN,
) -> DataFrame:
    """Column pairs whose profiles allow the child's values to lie within the parent's.

    ``parents`` holds ``(sys_code, table_code, col_code)``. Types must belong together, the
    child's lengths must lie within the parent's, it must not have more distinct values and
    its values must not be too short. Both sides are metadata, one row per column; they meet
    on the type family, not as a cross product.
    """
    typed = effective_type(profile)
    kind = F.col("effective_type")
    # A VARCHAR parent also accepts CHARACTER children.
    family = F.when(kind.isin(*_INTEGERS), F.array(F.lit("INTEGERS"))).otherwise(F.array(kind))
    accepted = F.when(kind == "VARCHAR", F.array(F.lit("CHARACTER"), F.lit("VARCHAR"))).otherwise(family)
    key_side = (
        typed.join(parents.select(*FIELD).distinct(), FIELD, "left_semi")
        .select(
            F.col("sys_code").alias("parent_sys"),
            F.col("table_code").alias("parent_table"),
            F.col("col_code").alias("parent_col"),
            F.explode(accepted).alias("family"),
            F.col("max_len").alias("p_max"),
            F.col("min_len").alias("p_min"),
            F.col("distinct").alias("p_distinct"),
        )
    )
    children = typed if systems is None else typed.where(F.col("sys_code").isin(list(systems)))
    if not nullable:
        children = children.where(~F.col("nullable"))
    child_side = children.where(F.col("avg_len") >= min_avg_len).select(
        F.col("sys_code").alias("child_sys"),
        F.col("table_code").alias("child_table"),
        F.col("col_code").alias("child_col"),
        F.explode(family).alias("family"),
        "max_len",
        "min_len",
        "distinct",
    )
    fits = (F.col("min_len") >= F.col("p_min")) & (F.col("max_len") <= F.col("p_max"))
    if distinct_limit:
        fits = fits & (F.col("distinct") <= F.col("p_distinct"))
    return key_side.join(child_side, "family").where(fits).select(*EDGE)


# ---- single-column inclusion ------------------------------------------------------------

WORD = 63  # columns per bit word; the sign bit stays unused


def _membership_counts(tables: Tables, fields: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``(w0, w1, ..., blank, n)``: for every set of fields, how many values lie in exactly them.

    Each field's distinct values come from a scan of its own column and meet in one shuffle. A field is a bit, so a
    value that occurs in many fields, or in a third of all rows, is one small row per map task.
    """
    names = [f"w{w}" for w in range((len(fields) + WORD - 1) // WORD)]
    parts = []
    for i, (sys_code, table_code, name) in enumerate(fields):
        bits = [F.lit(1 << i % WORD if i // WORD == w else 0).cast("long").alias(c) for w, c in enumerate(names)]
        values = tables[(sys_code, table_code)].select(normalize(name).alias("value")).distinct()
        parts.append(values.select("value", *bits))
    by_value = reduce(DataFrame.unionByName, parts).groupBy("value").agg(*[F.bit_or(w).alias(w) for w in names])
    return by_value.groupBy(*names, (F.col("value") == "").alias("blank")).agg(F.count(F.lit(1)).alias("n"))


def _shared_texts(tables: Tables, fields: Sequence[tuple[str, str, str]], wanted: DataFrame) -> DataFrame:
    """``(p, c, every, filled)``: values that both numbered fields of a wanted pair hold, with and without blanks.

    Every set of fields that holds some value is taken apart into its members, and a member meets only its own pairs,
    so the work follows the sets and pairs that occur.
    """
    counts = _membership_counts(tables, fields)
    names = [c for c in counts.columns if c not in ("blank", "n")]
    places = F.flatten(F.array(*[_bits_of(w, i * WORD) for i, w in enumerate(names)]))
    members = counts.select(F.explode(places).alias("c"), F.array(*names).alias("words"), "blank", "n")
    shared = members.join(wanted, "c").where(F.expr(f"getbit(words[int(p div {WORD})], p % {WORD}) = 1"))
    return shared.groupBy("p", "c").agg(
        F.sum("n").alias("every"), F.coalesce(F.sum(F.when(~F.col("blank"), F.col("n"))), F.lit(0)).alias("filled")
    )


def _shared_integers(tables: Tables, fields: Sequence[tuple[str, str, str]], wanted: DataFrame) -> DataFrame:
    """``_shared_texts`` of fields that hold typed integers, which are compared as bits of words.

    A word meets with one entry per field at most. The blank is the one value of the word NULL.
    """
    parts = []
    for i, (sys_code, table_code, name) in enumerate(fields):
        ints = tables[(sys_code, table_code)].select(col(name).cast("bigint").alias("v"))
        held = F.coalesce(words.bits(), F.lit(1).cast("long"))
        parts.append(ints.groupBy(words.word().alias("word")).agg(held.alias("bits")).select("word", F.lit(i).alias("no"), "bits"))
    by_word = reduce(DataFrame.unionByName, parts).groupBy("word").agg(F.collect_list(F.struct("no", "bits")).alias("members"))
    each = by_word.select("word", "members", F.inline("members")).withColumnsRenamed({"no": "c", "bits": "own"})
    other = F.filter("members", lambda m: m["no"] == F.col("p"))
    met = each.join(wanted, "c").select("word", "p", "c", "own", F.get(other, 0)["bits"].alias("held"))
    n = F.bit_count(F.col("own").bitwiseAND(F.col("held"))).cast("long")
    filled = F.coalesce(F.sum(F.when(F.col("word").isNotNull(), n)), F.lit(0))
    return met.where(F.col("held").isNotNull()).groupBy("p", "c").agg(F.sum(n).alias("every"), filled.alias("filled"))


def _bits_of(word: str, first: int) -> Column:
    """Numbers of the bits that are set in a word whose lowest bit is number ``first``."""
    places = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda k: F.getbit(word, k) == 1)
    return F.transform(places, lambda k: k + first)


def inclusion_unary(tables: Tables, pairs: DataFrame | Sequence[tuple]) -> DataFrame:
    """Share of the child's distinct values found in the parent, for many column pairs at once.

    ``pairs`` are ``(parent_sys, parent_table, parent_col, child_sys, child_table, child_col)``, as rows or as a
    DataFrame. A blank in the child counts as a value that is never found. Pairs of typed integers are compared as bits,
    others as text. Only the names of the fields come to the driver, since a scan has to name its columns.
    """
    spark = next(iter(tables.values())).sparkSession
    if not isinstance(pairs, DataFrame):
        pairs = spark.createDataFrame(sorted(set(map(tuple, pairs))), ", ".join(f"{c} string" for c in EDGE))
    pairs = settled(pairs.select(*EDGE).distinct())
    sides = pairs.select(*PARENT).union(pairs.select(*CHILD))
    fields = sorted(tuple(r) for r in sides.distinct().collect())
    sizes = ["parent_size", "child_distinct", "child_filled", "contained"]
    if not fields:
        return pairs.select(*EDGE, *[F.lit(0).cast("long").alias(c) for c in sizes], F.lit(0.0).alias("ratio"))
    typed = [(*f, counted_as(tables[f[:2]].schema[f[2]].dataType) == "bigint") for f in fields]
    kinds = spark.createDataFrame(typed, "sys_code string, table_code string, col_code string, whole boolean")

    def with_kind(df: DataFrame, side: Sequence[str], name: str) -> DataFrame:
        return df.join(kinds.select(F.col("whole").alias(name), *[F.col(f).alias(c) for f, c in zip(FIELD, side)]), side)

    integers = F.col("p_whole") & F.col("c_whole")
    marked = settled(with_kind(with_kind(pairs, PARENT, "p_whole"), CHILD, "c_whole").select(*EDGE, integers.alias("integers")))
    parts = []
    for whole in (True, False):
        part = marked.where(F.col("integers") == whole).select(*EDGE)
        sides = part.select(*PARENT).union(part.select(*CHILD))
        if members := sorted(tuple(r) for r in sides.distinct().collect()):
            parts.append(_contained(tables, part, members, whole))
    found = reduce(DataFrame.unionByName, parts)
    ratio = F.when(F.col("child_distinct") > 0, F.col("contained") / F.col("child_distinct")).otherwise(0.0)
    return found.withColumn("ratio", ratio)


def _contained(tables: Tables, pairs: DataFrame, fields: Sequence[tuple[str, str, str]], integers: bool) -> DataFrame:
    """``(*EDGE, parent_size, child_distinct, child_filled, contained)`` of pairs among ``fields``."""
    numbers = pairs.sparkSession.createDataFrame([(i, *f) for i, f in enumerate(fields)], "no int, sys_code string, table_code string, col_code string")

    def numbered(side: Sequence[str], name: str) -> DataFrame:
        return numbers.select(F.col("no").alias(name), *[F.col(f).alias(c) for f, c in zip(FIELD, side)])

    known = pairs.join(numbered(PARENT, "p"), PARENT).join(numbered(CHILD, "c"), CHILD)
    # A pair of a field with itself gives the field's own sizes.
    wanted = known.select("p", "c").union(numbers.select(F.col("no").alias("p"), F.col("no").alias("c"))).distinct()
    met = (_shared_integers if integers else _shared_texts)(tables, fields, wanted)
    met = settled(met)  # one row per pair
    own = met.where("p = c")
    parent_sizes = own.select("p", F.col("filled").alias("parent_size"))
    child_sizes = own.select("c", F.col("every").alias("child_distinct"), F.col("filled").alias("child_filled"))
    both = met.select("p", "c", F.col("filled").alias("contained"))
    sized = known.join(both, ["p", "c"], "left").join(parent_sizes, "p", "left").join(child_sizes, "c", "left")
    sizes = ["parent_size", "child_distinct", "child_filled", "contained"]
    return sized.select(*EDGE, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in sizes])


def passes_threshold(
    ratio: Column,
    parent_size: Column,
    threshold: float = defaults.FK_RATIO,
    small: int = 0,
    small_threshold: float = 1.0,
) -> Column:
    """Whether a ratio is enough; parents with fewer than ``small`` values need ``small_threshold``."""
    if not small:
        return ratio >= threshold
    return ratio >= F.when(parent_size < small, small_threshold).otherwise(threshold)


def fk_violations(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Distinct non-blank child values that the parent does not have."""
    values = child.where(not_blank(child_col)).select(normalize(child_col).alias("value")).distinct()
    keys = parent.where(not_blank(parent_col)).select(normalize(parent_col).alias("value")).distinct()
    return values.join(keys, "value", "left_anti")


def discover_fk(
    tables: Tables,
    keys: DataFrame,
    profile: DataFrame,
    systems: Sequence[str] | None = None,
    skip_autoincrement: bool = True,
    min_avg_len: float = defaults.FK_MIN_AVG_LEN,
    threshold: float = defaults.FK_RATIO,
    small: int = 0,
    small_threshold: float = 1.0,
) -> DataFrame:
    """Foreign keys of single primary keys.

    ``keys`` are ``(sys_code, table_code, col_code)``. Keys that are sequences or too short
    are no targets; children are other tables' fields with at least three values. First
    profiles are matched, then one job tests all remaining pairs on the full data.
    """
    profile = settled(profile)
    eligible = F.col("avg_len") >= min_avg_len
    if skip_autoincrement:
        eligible = eligible & ~F.col("autoincrement")
    parents = profile.where(eligible).join(keys.select(*FIELD).distinct(), FIELD, "left_semi")
    candidates = fk_candidates(parents, profile, systems, min_avg_len=min_avg_len).where(
        F.col("parent_table") != F.col("child_table")
    )
    found = inclusion_unary(tables, candidates).where(
        (F.col("child_filled") >= defaults.FK_MIN_DISTINCT)
        & passes_threshold(F.col("ratio"), F.col("parent_size"), threshold, small, small_threshold)
    )
    return named_fks(found)


def named_fks(edges: DataFrame) -> DataFrame:
    """Edges with a readable name and a repeatable id."""
    name = F.concat_ws("_", "parent_table", "parent_col", "child_table", "child_col")
    identity = F.sha2(F.concat_ws("\x1f", *EDGE), 256)
    return edges.select(
        *EDGE, name.alias("fk_name"), "ratio", "parent_size", identity.alias("id")
    )


def fk_diagram_nodes(fks: DataFrame) -> DataFrame:
    """Four diagram rows per foreign key within one system, numbered in the order of names.

    Foreign keys without an order among them, which have equal columns, are numbered in any order.
    """
    counted = numbered(fks.where(F.col("parent_sys") == F.col("child_sys")), EDGE, "ref")
    ref, text = F.concat(F.lit("Ref_o"), F.col("ref")), F.col("ref").cast("string")

    def row(code: Column, name: Column, kind: str, owner: str) -> Column:
        return F.struct(
            code.alias("node_code"),
            name.alias("node_name"),
            F.lit(kind).alias("node_type"),
            F.lit(owner).alias("parent_node_code"),
            F.col("child_sys").alias("sys_code"),
        )

    # The node types and owners of the diagram format.
    return counted.select(
        F.inline(
            F.array(
                row(ref, F.col("fk_name"), "o:Reference", "Reference"),
                row(ref, text, "c:Object", "Diagram 1"),
                row(F.col("child_table"), text, "c:SourceSymbol", "Diagram 1"),
                row(F.col("parent_table"), text, "c:DestinationSymbol", "Diagram 1"),
            )
        )
    )


def fk_tables(fks: DataFrame, joint_fks: DataFrame) -> DataFrame:
    """All tables that take part in a single or joint foreign key."""
    sides = []
    for edges in (fks, joint_fks):
        for side in ("parent", "child"):
            sides.append(
                edges.select(
                    F.col(f"{side}_sys").alias("sys_code"), F.col(f"{side}_table").alias("table_code")
                )
            )
    return reduce(DataFrame.unionByName, sides).distinct()


# ---- joint keys -------------------------------------------------------------------------

GROUP = ["parent_sys", "parent_table", "group_code"]
TARGET = [*GROUP, "child_sys", "child_table"]


def joint_fk_candidates(
    joint_keys: DataFrame,
    profile: DataFrame,
    systems: Sequence[str] | None = None,
    limit: int = defaults.JOINT_KEY_LIMIT,
    min_avg_len: float = defaults.FK_MIN_AVG_LEN,
) -> DataFrame:
    """Child columns that may stand for each column of a joint key.

    ``joint_keys`` holds ``(sys_code, table_code, group_code, cols)``. Keys with a measure or a
    date in them and keys of more than ``limit`` columns are left out.
    """
    keys = joint_keys.where(F.size("cols").between(2, limit)).select(
        "sys_code", "table_code", "group_code", F.size("cols").alias("key_size"), F.explode("cols").alias("col_code")
    )
    typed = effective_type(profile).select(*FIELD, "effective_type")
    measures = (
        keys.join(typed, FIELD)
        .where(F.col("effective_type").isin("DOUBLE", "TIMESTAMP", "DATE", "TIME"))
        .select("sys_code", "table_code", "group_code")
        .distinct()
    )
    usable = keys.join(measures, ["sys_code", "table_code", "group_code"], "left_anti")
    parts = usable.select(
        F.col("sys_code").alias("parent_sys"),
        F.col("table_code").alias("parent_table"),
        F.col("col_code").alias("parent_col"),
        "group_code",
        "key_size",
    )
    pairs = fk_candidates(usable, profile, systems, nullable=False, min_avg_len=min_avg_len)
    other = (F.col("parent_sys") != F.col("child_sys")) | (F.col("parent_table") != F.col("child_table"))
    return parts.join(pairs.where(other), PARENT)


def joint_fk_tables(candidates: DataFrame) -> DataFrame:
    """Child tables with a candidate for every column of a joint key."""
    return (
        candidates.groupBy(*TARGET, "key_size")
        .agg(F.count_distinct("parent_col").alias("covered"))
        .where(F.col("covered") == F.col("key_size"))
        .select(*TARGET, "key_size")
    )


Prune = Callable[[DataFrame], DataFrame]


def joint_fk_assignments(
    candidates: DataFrame, limit: int = defaults.JOINT_KEY_LIMIT, prune: Prune | None = None
) -> DataFrame:
    """Ways to assign different child columns to the columns of a joint key.

    ``pairs`` lists ``(parent_col, child_col)`` by parent column. Built column by column with joins on the child
    table, so only complete tables meet. ``prune`` gets every incomplete level of two columns or more and keeps
    what may still become a foreign key; without it all assignments are built.
    """
    whole = candidates.join(joint_fk_tables(candidates), [*TARGET, "key_size"])
    rank = F.dense_rank().over(Window.partitionBy(*GROUP).orderBy("parent_col"))
    ranked = whole.select(
        *TARGET,
        "key_size",
        rank.alias("pos"),
        F.struct("parent_col", "child_col").alias("pair"),
    )
    grown = ranked.where(F.col("pos") == 1).select(*TARGET, "key_size", F.array("pair").alias("pairs"))
    complete = [grown.where(F.col("key_size") == 1)]
    for pos in range(2, limit + 1):
        step = ranked.where(F.col("pos") == pos).select(*TARGET, F.col("pair").alias("next"))
        grown = (
            grown.join(step, TARGET)
            .where(~F.array_contains(F.transform("pairs", lambda p: p["child_col"]), F.col("next.child_col")))
            .select(*TARGET, "key_size", F.array_append("pairs", F.col("next")).alias("pairs"))
        )
        complete.append(grown.where(F.col("key_size") == pos))
        if prune is not None and pos < limit:
            grown = prune(grown.where(F.col("key_size") > pos))
    return reduce(DataFrame.unionByName, complete).select(*TARGET, "pairs")


def single_column_rows(tables: Tables, candidates: DataFrame) -> DataFrame:
    """Per column pair of ``candidates`` ``(*EDGE, records, filled, contained)``, counted in rows of the child.

    ``contained`` counts rows whose value the parent column has. Values are counted before they are shuffled, and a
    value meets the set of parent columns that hold it as bits, not as rows.
    """
    spark = next(iter(tables.values())).sparkSession
    pairs = settled(candidates.select(*EDGE).distinct())
    parents = sorted(tuple(r) for r in pairs.select(*PARENT).distinct().collect())
    children = sorted(tuple(r) for r in pairs.select(*CHILD).distinct().collect())
    parts = []
    for side, fields in (("p", parents), ("c", children)):
        of_table: dict[TableKey, list] = {}
        for i, (sys_code, table_code, name) in enumerate(fields):
            of_table.setdefault((sys_code, table_code), []).append((i, name))
        for table, columns in of_table.items():
            cells = [F.struct(F.lit(i).alias("no"), normalize(c).alias("value")) for i, c in columns]
            parts.append(tables[table].select(F.inline(F.array(*cells))).withColumn("side", F.lit(side)))
    if not parts:
        return pairs.select(*EDGE, *[F.lit(0).cast("long").alias(c) for c in ("records", "filled", "contained")])
    counted = reduce(DataFrame.unionByName, parts).groupBy("value", "side", "no").agg(F.count(F.lit(1)).alias("n"))
    words = [f"w{i}" for i in range((len(parents) + WORD - 1) // WORD)]
    bit = F.expr(f"CASE WHEN side = 'p' THEN shiftleft(1L, no % {WORD}) END")
    holders = [
        F.coalesce(F.bit_or(F.when(F.expr(f"no div {WORD}") == i, bit)), F.lit(0).cast("long")).alias(w) for i, w in enumerate(words)
    ]
    # At most one entry per child column; blanks are no values of a parent.
    uses = F.collect_list(F.when(F.col("side") == "c", F.struct(F.col("no").alias("c"), "n"))).alias("uses")
    by_value = counted.groupBy("value").agg(*holders, uses)
    blank = (F.col("value") == "").alias("blank")
    sets = by_value.select(*words, blank, F.inline("uses")).groupBy("c", "blank", *words).agg(F.sum("n").alias("n"))

    def numbered(side: Sequence[str], fields: Sequence[tuple], name: str) -> DataFrame:
        return spark.createDataFrame([(i, *f) for i, f in enumerate(fields)], ", ".join([f"{name} int", *[f"{c} string" for c in side]]))

    known = pairs.join(numbered(PARENT, parents, "p"), PARENT).join(numbered(CHILD, children, "c"), CHILD)
    holds = F.expr(f"getbit(words[int(p div {WORD})], p % {WORD}) = 1") & ~F.col("blank")
    n = F.coalesce("n", F.lit(0))
    return (
        known.join(sets.select("c", "blank", "n", F.array(*words).alias("words")), "c", "left")
        .groupBy(*EDGE)
        .agg(
            F.sum(n).alias("records"),
            F.sum(F.when(~F.col("blank"), n).otherwise(0)).alias("filled"),
            F.sum(F.when(holds, n).otherwise(0)).alias("contained"),
        )
    )


def _may_pass(contained: Column, least_rows: Column, threshold: float, max_misses: int | None) -> Column:
    """Whether tuples of at least ``least_rows`` complete rows, of which at most ``contained`` are found, may reach the ratio."""
    enough = contained + 1e-6 >= threshold * least_rows
    return enough if max_misses is None or threshold <= 0 else enough & (least_rows - contained <= max_misses)


def bounded_candidates(
    tables: Tables, candidates: DataFrame, threshold: float, max_misses: int | None = None
) -> DataFrame:
    """Candidates of joint keys whose single columns allow the tuple to reach ``threshold``.

    A row whose tuple is found has every single value found, so a column's found rows bound the tuple's. Rows with
    a blank in the tuple do not count: there are no more of them than blanks in this column and, for each further
    column of the key, in the candidate of the same tables with most blanks.
    """
    rows = single_column_rows(tables, candidates)
    counted = candidates.join(rows, EDGE).withColumn("blanks", F.col("records") - F.col("filled"))
    most = F.max("blanks").over(Window.partitionBy(*TARGET))
    least = F.greatest(F.lit(0), F.col("filled") - (F.col("key_size") - 1) * most)
    kept = counted.withColumn("least", least).where(_may_pass(F.col("contained"), F.col("least"), threshold, max_misses))
    return kept.select(*candidates.columns, "records", "filled")


def _tuples(df: DataFrame, choices: Sequence[tuple[int, Sequence[str]]]) -> DataFrame:
    """``(choice, tuple, n)``: right-trimmed tuples without blanks, counted per choice."""
    repeated = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("choice"),
                        F.when(
                            reduce(lambda a, b: a & b, [not_blank(c) for c in cols]),
                            F.array(*[normalize(c) for c in cols]),
                        ).alias("tuple"),
                    )
                    for i, cols in choices
                ]
            )
        )
    )
    return repeated.where(F.col("tuple").isNotNull()).groupBy("choice", "tuple").agg(
        F.count(F.lit(1)).alias("n")
    )


def inclusion_nary(tables: Tables, assignments: Sequence[tuple], max_misses: int | None = None) -> DataFrame:
    """Row share of child tuples found among the parent's, for many assignments at once.

    An assignment is ``(parent table key, parent columns, child table key, child columns)``.
    Tuples are counted before they are shuffled, and both sides meet in one aggregation on
    the tuple: a tuple that fills a third of all rows is one row per map task. With ``max_misses``,
    more missing rows than that make the ratio 0.
    """
    assignments = list(assignments)
    keys = sorted({(a[0], tuple(a[1])) for a in assignments})
    key_no = {k: i for i, k in enumerate(keys)}
    parts = []
    parents: dict[TableKey, list] = {}
    children: dict[TableKey, list] = {}
    for i, (parent, pcols, child, ccols) in enumerate(assignments):
        children.setdefault(child, []).append((i, tuple(ccols)))
    for (parent, pcols), k in key_no.items():
        parents.setdefault(parent, []).append((k, pcols))
    for table, choices in parents.items():
        parts.append(
            _tuples(tables[table], choices).select(
                F.col("choice").alias("key_no"), "tuple", F.lit(None).cast("int").alias("choice"), "n"
            )
        )
    of_key = F.create_map(
        *[F.lit(x) for i, a in enumerate(assignments) for x in (i, key_no[(a[0], tuple(a[1]))])]
    )
    for table, choices in children.items():
        parts.append(
            _tuples(tables[table], choices).select(
                of_key[F.col("choice")].alias("key_no"), "tuple", "choice", "n"
            )
        )
    # Per tuple of a key: is it in the parent, and how many rows of each assignment carry it.
    # The list holds at most one entry per assignment. Entry -1 counts the parent's tuples.
    met = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("key_no", "tuple")
        .agg(
            F.bool_or(F.col("choice").isNull()).alias("in_parent"),
            F.collect_list(F.when(F.col("choice").isNotNull(), F.struct("choice", "n"))).alias("uses"),
        )
    )
    own = F.struct(F.lit(-1).alias("choice"), F.col("in_parent").cast("bigint").alias("n"))
    counted = (
        met.select("key_no", "in_parent", F.inline(F.array_append("uses", own)))
        .groupBy("key_no", "choice")
        .agg(
            F.sum("n").alias("rows"),
            F.sum(F.when(F.col("in_parent"), F.col("n")).otherwise(0)).alias("contained"),
        )
    )
    size = F.max(F.when(F.col("choice") == -1, F.col("rows"))).over(Window.partitionBy("key_no"))
    used = counted.withColumn("parent_size", size).where(F.col("choice") >= 0)
    names = {}
    for i, a in enumerate(assignments):
        names[i] = F.struct(
            F.lit(a[0][0]).alias("parent_sys"), F.lit(a[0][1]).alias("parent_table"),
            F.lit(a[2][0]).alias("child_sys"), F.lit(a[2][1]).alias("child_table"),
            F.array(
                *[
                    F.struct(F.lit(p).alias("parent_col"), F.lit(c).alias("child_col"))
                    for p, c in zip(a[1], a[3])
                ]
            ).alias("pairs"),
        )
    described = F.create_map(*[x for i, s in names.items() for x in (F.lit(i), s)])
    ratio = F.col("contained") / F.col("rows")
    if max_misses is not None:
        ratio = F.when(F.col("rows") - F.col("contained") > max_misses, 0.0).otherwise(ratio)
    return (
        used.withColumn("d", described[F.col("choice")])
        .select(
            "d.parent_sys", "d.parent_table", "d.child_sys", "d.child_table", "d.pairs",
            "parent_size",
            "rows",
            "contained",
            ratio.alias("ratio"),
        )
    )


JOINT_FK_SCHEMA = (
    "group_id string, parent_sys string, parent_table string, child_sys string, child_table string, "
    "pairs array<struct<parent_col: string, child_col: string>>, ratio double, parent_size long"
)


def joint_group_id() -> Column:
    """A repeatable id of a joint foreign key, from its tables and column pairs."""
    text = F.transform(F.array_sort("pairs"), lambda p: F.concat_ws("\x1e", p["parent_col"], p["child_col"]))
    return F.sha2(
        F.concat_ws("\x1f", "parent_sys", "parent_table", "child_sys", "child_table", F.array_join(text, "\x1f")),
        256,
    )


def _assignments(rows: DataFrame) -> list[tuple]:
    """Assignments for ``inclusion_nary``; their number is that of tuples of columns that are still possible."""
    return [
        (
            (r["parent_sys"], r["parent_table"]),
            [p["parent_col"] for p in r["pairs"]],
            (r["child_sys"], r["child_table"]),
            [p["child_col"] for p in r["pairs"]],
        )
        for r in rows.select("parent_sys", "parent_table", "child_sys", "child_table", "pairs").distinct().collect()
    ]


def discover_joint_fk(
    tables: Tables,
    joint_keys: DataFrame,
    profile: DataFrame,
    systems: Sequence[str] | None = None,
    min_avg_len: float = defaults.FK_MIN_AVG_LEN,
    threshold: float = defaults.FK_RATIO,
    small: int = 0,
    small_threshold: float = 1.0,
    max_misses: int | None = None,
) -> DataFrame:
    """Foreign keys of joint primary keys of two or three columns.

    Level by level: single columns bound pairs and pairs bound triples, all counted in rows, so that only tuples
    whose parts may reach the threshold are built. The bounds are exact; no foreign key is lost.
    """
    candidates = settled(joint_fk_candidates(joint_keys, settled(profile), systems, min_avg_len=min_avg_len))
    least = min(threshold, small_threshold) if small else threshold
    bounded = settled(bounded_candidates(tables, candidates, least, max_misses))
    kept = bounded.select(*candidates.columns)
    blanks = bounded.select(*CHILD, (F.col("records") - F.col("filled")).alias("blanks")).distinct()
    most = blanks.groupBy("child_sys", "child_table").agg(F.max("blanks").alias("most"))

    def prune(level: DataFrame) -> DataFrame:
        level = settled(level)
        tested = inclusion_nary(tables, _assignments(level), None) if not level.isEmpty() else None
        if tested is None:
            return level
        tables_of = ["parent_sys", "parent_table", "child_sys", "child_table"]
        further = F.col("key_size") - F.size("pairs")
        # An assignment without a complete row has no row in ``tested`` and no complete tuple of more columns either.
        return settled(
            level.join(tested.select(*tables_of, "pairs", "rows", "contained"), [*tables_of, "pairs"])
            .join(most, ["child_sys", "child_table"])
            .where(_may_pass(F.col("contained"), F.greatest(F.lit(0), F.col("rows") - further * F.col("most")), least, max_misses))
            .select(*level.columns)
        )

    assignments = _assignments(joint_fk_assignments(kept, prune=prune))
    if not assignments:
        return profile.sparkSession.createDataFrame([], JOINT_FK_SCHEMA)
    tested = inclusion_nary(tables, assignments, max_misses)
    return tested.where(passes_threshold(F.col("ratio"), F.col("parent_size"), threshold, small, small_threshold)).select(
        joint_group_id().alias("group_id"),
        "parent_sys", "parent_table", "child_sys", "child_table", "pairs", "ratio", "parent_size",
    )


def joint_fk_groups(rows: DataFrame) -> DataFrame:
    """Joint foreign keys from stored rows, one per column pair: pairs gathered per group."""
    return rows.groupBy("group_id", "parent_sys", "parent_table", "child_sys", "child_table").agg(
        F.array_sort(F.collect_set(F.struct("parent_col", "child_col"))).alias("pairs")
    )


def joint_fk_rows(joint_fks: DataFrame) -> DataFrame:
    """The stored form of joint foreign keys: one row per column pair."""
    return joint_fks.select(
        "group_id", "parent_sys", "parent_table", "child_sys", "child_table", F.inline("pairs")
    )

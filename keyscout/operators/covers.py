"""Covers: sets that hit every member of a family of sets, grown level by level as DataFrames.

Both minimal determinants and candidate keys are covers. A determinant of a column has to differ wherever the column
does, so it hits every set of columns in which two rows with different values differ. A key has to reach every
column, so it hits whatever the closure of a smaller set leaves out. A set that misses a member can only become a cover
by one of the member's own elements, so no step looks at combinations of all columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyscout.functions.text import col


def first_missed(family: str | Column, chosen: str | Column) -> Column:
    """The first member of ``family`` that ``chosen`` does not hit; null if it hits all."""
    of = F.col(chosen) if isinstance(chosen, str) else chosen
    return F.get(F.filter(family, lambda member: ~F.arrays_overlap(member, of)), 0)


def extended(partials: DataFrame, families: DataFrame, key: Sequence[str]) -> DataFrame:
    """The next larger sets, each once: ``(key, chosen, covers)``.

    ``partials`` holds ``(key, chosen)``, sets that are no solutions, and maybe ``within``, elements one of which each
    solution around the set has; ``families`` holds ``(key, family, usable)``. A set that misses a member grows by that
    member's usable elements, and one that hits all by those within, or by any usable element. ``covers`` tells which of
    the new sets hit all members.
    """
    key = list(key)
    joined = partials.join(families, key)
    else_ = ["within", "usable"] if "within" in partials.columns else ["usable"]
    choices = F.array_except(F.array_intersect(F.coalesce(first_missed("family", "chosen"), *else_), "usable"), "chosen")
    grown = joined.select(*key, "chosen", F.explode(choices).alias("_next"))
    sets = grown.select(*key, F.array_sort(F.array_append("chosen", F.col("_next"))).alias("chosen")).distinct()
    return sets.join(families, key).select(*key, "chosen", first_missed("family", "chosen").isNull().alias("covers"))


def _parts(chosen: str, size: int) -> Column:
    """All proper, non-empty subsets of an array of ``size`` elements."""
    masks = F.sequence(F.lit(1), F.lit((1 << size) - 2))
    held = lambda mask: F.filter(chosen, lambda _, i: F.floor(mask / F.pow(F.lit(2), i)) % 2 == 1)
    return F.transform(masks, held)


def without_implied(sets: DataFrame, rules: DataFrame, target: str, size: int) -> DataFrame:
    """Sets of ``size`` elements of which no proper part determines ``target`` or another of their elements.

    ``rules`` holds ``(lhs, rhs)`` with ``lhs`` sorted. Every part of a set meets the rules on equality.
    """
    if size < 2:
        return sets
    parts = sets.select("chosen", target, F.explode(_parts("chosen", size)).alias("lhs"))
    reached = F.explode(F.array_append(F.array_except("chosen", "lhs"), F.col(target)))
    hit = parts.withColumn("rhs", reached).join(rules, ["lhs", "rhs"], "left_semi").select(target, "chosen").distinct()
    return sets.join(hit, [target, "chosen"], "left_anti")


def all_columns(names: Sequence[str]) -> Column:
    """A row's values as one array of texts, NULL kept apart from all of them."""
    return F.array(*[F.coalesce(F.concat(F.lit("="), col(c).cast("string")), F.lit("")) for c in names])


def difference_sets(rows: DataFrame, names: Sequence[str], pairs: int, most: int) -> DataFrame:
    """``(target, family)``: for each column, sets of other columns in which two rows differ that differ in it.

    Pairs are neighbours among the rows that agree in some column, ordered by the columns after it, since these differ
    in few others. Of all sets the ``pairs`` smallest are used, and of each target's the ``most`` smallest, so the result
    is bounded by the schema. Columns are numbered as in ``names``.
    """
    values = rows.select(all_columns(names).alias("v"))
    places = values.select("v", F.posexplode("v").alias("c", "x"))
    later = F.slice("v", F.col("c") + 2, F.lit(len(names)))
    before = F.lag("v").over(Window.partitionBy("c", "x").orderBy(later, "v"))
    met = places.select("v", before.alias("w")).where("w IS NOT NULL AND v <> w").select(F.zip_with("v", "w", lambda a, b: a != b).alias("u")).distinct()
    numbers = F.sequence(F.lit(0), F.lit(len(names) - 1))
    differ = met.select(F.filter(numbers, lambda i: F.get("u", i)).alias("d")).orderBy(F.size("d"), "d").limit(pairs)
    by_target = differ.select(F.explode("d").alias("target"), "d").select("target", F.array_except("d", F.array("target")).alias("member"))
    sized = F.array_sort(F.collect_list(F.struct(F.size("member").alias("n"), "member")))
    return by_target.groupBy("target").agg(F.slice(F.transform(sized, lambda s: s["member"]), 1, most).alias("family"))

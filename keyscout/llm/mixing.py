"""Mixing sources to target weights by systematic sampling.

Each document of a source is expected as often as target / size of the source. The expected copies are
summed up within the source in an order by size, one random offset per source is added, and a document
comes out once for each integer its sum crosses. As the order is by size, the words taken come near the
target, too. The running sum needs no window over a whole source: documents are ranked inside bounded
blocks of a source (by size class and a digest of the id), and a small table holds where each block starts.

Null sources form a source of their own, which comes last. Null texts have size 0. Nothing is dropped:
a document that is not taken has 0 copies. Repeated rows are documents of their own. A source without
words has the target 0. Other columns are carried along untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyscout.llm.common import word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
ROWS_PER_BLOCK = 100_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in order of code points, null last, have the weights in turn. Together they get ``share``
    times all words; none gets over ``most`` times its own, and what that leaves goes to the others by
    weight. The level at which all fit is read off a running sum over the sources in the order in which
    they reach their limit. One row per source goes through the windows.
    """
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (order % len(weights) + 1).cast("int"))
    weighed = sizes.withColumn("weight", weight).withColumn("most", most * F.col("source_size"))
    by_limit = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy(F.lit(1))
    summed = weighed.select(
        "*",
        F.sum("most").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)).alias("full"),
        F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)).alias("open_weight"),
        F.sum("source_size").over(all_rows).alias("words"),
    )
    level = (F.lit(share) * F.col("words") - F.coalesce("full", F.lit(0))) / F.col("open_weight")
    levels = summed.withColumn("level", level).withColumn("fits", F.col("most") > F.col("weight") * level)
    found = F.min(F.when(F.col("fits"), F.struct(F.col("most") / F.col("weight"), F.col("level").alias("level")))).over(all_rows)["level"]
    target = F.when(F.col("fits"), F.col("weight") * found).otherwise(F.col("most").cast("double"))
    return levels.select("source", "source_size", target.alias("target"))


def _digest_part(text: Column) -> Column:
    """32 bits of a text's MD5, as a long."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def sampled_copies(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size: Column | None = None, seed: str = "mix", rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """(row, id, source, size, source_size, target, copies); ``row`` is a struct of all columns of ``docs``."""
    size = word_count(F.col("text")) if size is None else size
    source = F.col(source_col)
    # A struct is not null where its field is, so a null source is a key like any other.
    held = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), source.alias("source"), F.struct(source.alias("source")).alias("key"), size.alias("size"))
    rows = held.select("id", "source", "size")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    blocks = max(1, -(-(per_source.agg(F.sum("source_rows")).first()[0] or 0) // rows_per_block))
    targets = source_targets(per_source.select("source", "source_size"))
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = _digest_part(F.concat(F.lit(seed), F.when(F.col("source").isNull(), ":null").otherwise(F.concat(F.lit(":="), F.col("source"))))) / F.lit(2.0**32)
    targets = targets.select("source", "source_size", "target", step.alias("step"), offset.alias("offset"))
    keys = [F.floor(F.sqrt("size")).alias("size_class"), (_digest_part(F.coalesce(F.col("id").cast("string"), F.lit(""))) % blocks).alias("part")]
    counted = rows.select("source", *keys).groupBy("source", "size_class", "part").count()
    before = F.sum("count").over(Window.partitionBy("source").orderBy("size_class", "part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counted.select("source", "size_class", "part", F.coalesce(before, F.lit(0)).alias("start"))
    starts = starts.join(targets, starts["source"].eqNullSafe(targets["source"])).select(F.struct(starts["source"]).alias("key"), "size_class", "part", "start", "source_size", "target", "step", "offset")
    # Ranks and starts meet on the columns that rows are dealt by for their ranks, so whole rows are dealt only once.
    block = ["key", "size_class", "part"]
    ranked = held.select("*", *keys).withColumn("rank", F.row_number().over(Window.partitionBy(*block).orderBy("size", "id")))
    joined = ranked.join(starts, block).withColumn("rank", F.col("start") + F.col("rank"))
    crossed = F.floor(F.col("offset") + F.col("step") * F.col("rank")) - F.floor(F.col("offset") + F.col("step") * (F.col("rank") - 1))
    return joined.select("row", "id", "source", "size", "source_size", "target", crossed.cast("long").alias("copies"))


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size: Column | None = None, seed: str = "mix") -> DataFrame:
    """The rows of ``docs``, each as often as it is taken."""
    taken = sampled_copies(docs, id_col, source_col, size, seed).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")

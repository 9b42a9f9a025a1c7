"""Preference formatting: the common turns of a chosen and a rejected conversation once as prompt, then both completions.

Both conversations are tables of turns. Turns are matched by place; the prompt is the longest run of first turns that
are equal in role and text, and everything after it is a completion. The output has one row per rendered turn, with
its place in the token-free character stream of prompt + completion and a mask: 1 for turns that are learned from
(assistant turns of a completion), 0 for all others. Rows stay as small as a turn, and places are running sums over
bounded blocks of a conversation, so a conversation that holds a third of all turns is neither one row nor one task.

DataFrame expressions only. A null role renders and compares as an empty one, so does a null text. Turns are ordered
by turn, null last, then role and text; repeated turns keep their places one after the other. Rows with a null
conversation id belong to the conversation null. A conversation without its counterpart has no prompt and one
completion; if both are equal, all turns are prompt and there is no completion. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyscout.llm.common import stored

TURNS_PER_BLOCK = 256


def placed_turns(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(pair_id, place, role, text): places count from 0 in each conversation."""
    block = F.floor(F.col("turn") / TURNS_PER_BLOCK)
    rows = turns.select(
        F.col(id_col).alias("pair_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("block", block)
    before = _before(rows, F.count("*"), ["pair_id"], "block", "first")
    nth = F.row_number().over(Window.partitionBy("pair_id", "block").orderBy(F.col("turn").asc_nulls_last(), "role", "text"))
    placed = rows.withColumn("nth", nth)
    same = placed["pair_id"].eqNullSafe(before["pair_id"]) & placed["block"].eqNullSafe(before["block"])
    return placed.join(before, same).select(placed["pair_id"], (F.col("first") + F.col("nth") - 1).alias("place"), "role", "text")


def _before(rows: DataFrame, total: Column, keys: list[str], block: str, name: str) -> DataFrame:
    """(keys, block, name): the total over all earlier blocks of the keys."""
    sums = rows.groupBy(*keys, block).agg(total.alias("block_total"))
    earlier = Window.partitionBy(*keys).orderBy(F.col(block).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*keys, block, F.coalesce(F.sum("block_total").over(earlier), F.lit(0)).alias(name))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def format_preferences(chosen: DataFrame, rejected: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(pair_id, part, place, role, rendered, start, mask); part is prompt, chosen or rejected.

    ``start`` is the number of characters before the turn in prompt + completion.
    """
    names = (id_col, turn_col, role_col, text_col)
    left = placed_turns(chosen, *names).withColumn("chosen", F.lit(True))
    right = placed_turns(rejected, *names).withColumn("chosen", F.lit(False))
    both = stored(left.unionByName(right), "turns")
    matched = both.groupBy("pair_id", "place").agg(
        F.count("*").alias("sides"), F.min("role").alias("low_role"), F.max("role").alias("high_role"),
        F.min(F.sha2("text", 256)).alias("low_text"), F.max(F.sha2("text", 256)).alias("high_text"),
    )
    differ = (F.col("sides") < 2) | (F.col("low_role") != F.col("high_role")) | (F.col("low_text") != F.col("high_text"))
    prompt = matched.groupBy("pair_id").agg(F.min(F.when(differ, F.col("place"))).alias("prompt_turns"))
    split = both.join(prompt, both["pair_id"].eqNullSafe(prompt["pair_id"])).drop(prompt["pair_id"])
    common = F.col("prompt_turns").isNull() | (F.col("place") < F.col("prompt_turns"))
    part = F.when(common, "prompt").when(F.col("chosen"), "chosen").otherwise("rejected")
    rows = split.where(F.col("chosen") | ~common).select("pair_id", part.alias("part"), "place", "role", rendered(F.col("role"), F.col("text")).alias("rendered"))
    rows = rows.withColumn("block", F.floor(F.col("place") / TURNS_PER_BLOCK)).withColumn("size", F.length("rendered").cast("long"))
    in_part = _before(rows, F.sum("size"), ["pair_id", "part"], "block", "earlier")
    prompt_size = rows.where("part = 'prompt'").groupBy("pair_id").agg(F.sum("size").alias("prompt_size"))
    starts = in_part.join(prompt_size, in_part["pair_id"].eqNullSafe(prompt_size["pair_id"]), "left").select(
        in_part["pair_id"], "part", "block", (F.col("earlier") + F.when(F.col("part") == "prompt", 0).otherwise(F.coalesce("prompt_size", F.lit(0)))).alias("first")
    )
    own = Window.partitionBy("pair_id", "part", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("own", F.coalesce(F.sum("size").over(own), F.lit(0)))
    same = summed["pair_id"].eqNullSafe(starts["pair_id"]) & (summed["part"] == starts["part"]) & (summed["block"] == starts["block"])
    mask = F.when((summed["part"] != "prompt") & (F.col("role") == "assistant"), 1).otherwise(0)
    return summed.join(starts, same).select(summed["pair_id"], summed["part"], "place", "role", "rendered", (F.col("first") + F.col("own")).alias("start"), mask.alias("mask"))


def stale_answers(turns: DataFrame) -> DataFrame:
    """A rejected counterpart of each conversation: its last assistant turn repeats the one before it.

    Where a conversation has a single assistant turn, the answer echoes the user's last turn; where it has none, it
    stays as it is. Takes and returns (conv_id, turn, role, text).
    """
    of_role = lambda r: F.when(F.col("role") == r, F.struct("turn", "text"))
    last = turns.groupBy("conv_id").agg(F.max(of_role("assistant")).alias("answer"), F.max(of_role("user")).alias("question"))
    asked = turns.join(last, turns["conv_id"].eqNullSafe(last["conv_id"])).drop(last["conv_id"])
    older = asked.groupBy("conv_id").agg(F.max(F.when((F.col("role") == "assistant") & (F.col("turn") < F.col("answer")["turn"]), F.struct("turn", "text"))).alias("older"))
    known = asked.join(older, asked["conv_id"].eqNullSafe(older["conv_id"])).drop(older["conv_id"])
    stale = F.coalesce(F.col("older")["text"], F.col("question")["text"], F.col("text"))
    is_last = F.coalesce((F.col("role") == "assistant") & (F.col("turn") == F.col("answer")["turn"]), F.lit(False))
    return known.select("conv_id", "turn", "role", F.when(is_last, stale).otherwise(F.col("text")).alias("text"))

"""Preference formatting: the longest common turn prefix of two conversations once as prompt, then paired masked completions.

Two tables of turns (pair, turn, role, text) give the chosen and the rejected conversation of each pair. Turns stand in the order
of their numbers; rows of one number stand by role and text. The prompt ends before the first number at which the two
conversations differ in role, text or number of rows, found by an aggregate over two 64-bit hashes of each row (128 bits; texts that differ and
agree in both would be taken as equal). Only hashes travel for that. The texts are shuffled once, by pair and block of BLOCK turn numbers, to where
each block's split is joined to them, so no conversation is ever gathered, however long.

Result: one row per pair and block, with the prompt and both completions side by side; the blocks in order make each text. A pair
of ordinary length has one row. `chosen` and `rejected` are rendered turns, `chosen_mask` and `rejected_mask` their learned spans (start:end in
characters, end exclusive, comma-joined): text and end mark of assistant turns. Nothing in a prompt is learned. `n_turns` counts the rows rendered,
`prompt_turns` those of the pair's whole prompt. A text without turns is empty: conversations that are equal have empty completions, a pair with
one conversation only has an empty prompt and one empty completion. A null role or text is empty, a null turn stands last, rows without a pair id belong
to no pair and are left out; repeated rows are rendered as often as they stand; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 64
LAST = (1 << 62) - 1


def _side(turns: DataFrame, name: str, id_col: str) -> DataFrame:
    return turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("pair_id"),
        F.lit(name).alias("side"),
        F.coalesce(F.col("turn").cast("long"), F.lit(LAST)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def _same(side: str) -> list[Column]:
    """Number of rows and the sum of two 64-bit hashes of a turn's rows."""
    own = F.col("side") == side
    first, second = F.xxhash64("role", "text"), F.xxhash64("text", F.lit("turn"), "role")
    return [F.count(F.when(own, 1)), *(F.coalesce(F.sum(F.when(own, x.cast("decimal(20,0)"))), F.lit(0)) for x in (first, second))]


def preference_rows(chosen: DataFrame, rejected: DataFrame, id_col: str = "conv_id", learned: str = "assistant") -> DataFrame:
    """pair_id, block, prompt, chosen, chosen_mask, rejected, rejected_mask, n_turns, prompt_turns; see the module."""
    rows = _side(chosen, "chosen", id_col).union(_side(rejected, "rejected", id_col)).withColumn("block", F.floor(F.col("turn") / BLOCK))
    turns = rows.groupBy("pair_id", "turn", "block").agg(F.struct(*_same("chosen")).alias("c"), F.struct(*_same("rejected")).alias("r"))
    turns = turns.select("pair_id", "turn", "block", F.col("c.col1").alias("n"), (F.col("c") == F.col("r")).alias("alike"))
    split = turns.groupBy("pair_id").agg(F.coalesce(F.min(F.when(~F.col("alike"), F.col("turn"))), F.lit(LAST + 1)).alias("split"))
    placed = turns.join(split, "pair_id")
    before = placed.groupBy("pair_id").agg(F.min("split").alias("split"), F.coalesce(F.sum(F.when(F.col("turn") < F.col("split"), F.col("n"))), F.lit(0)).cast("long").alias("prompt_turns"))
    blocks = turns.select("pair_id", "block").distinct().join(before, "pair_id")
    own = rows.join(blocks, ["pair_id", "block"]).where("side = 'chosen' or turn >= split")
    part = F.when(F.col("turn") < F.col("split"), "prompt").otherwise(F.col("side"))
    head = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"))
    own = own.select("pair_id", "block", "prompt_turns", part.alias("part"), "turn", "role", "text", F.concat(head, "text", F.lit("<|end|>\n")).alias("whole"), F.length(head).alias("head"))
    order = Window.partitionBy("pair_id", "block", "part").orderBy("turn", "role", "text")
    own = own.withColumn("end", F.sum(F.length("whole")).over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("at", F.row_number().over(order))
    start = F.col("end") - F.length("whole") + F.col("head")
    span = F.when((F.col("part") != "prompt") & (F.col("role") == learned), F.concat(start.cast("string"), F.lit(":"), F.col("end").cast("string")))
    each = F.array_sort(F.collect_list(F.struct("at", "part", "whole", span.alias("span"))))
    done = own.groupBy("pair_id", "block").agg(F.min("prompt_turns").alias("prompt_turns"), each.alias("all"), F.count("*").alias("n_turns"))
    of = lambda name: F.filter("all", lambda x: x.part == name)
    text = lambda name: F.array_join(F.transform(of(name), lambda x: x.whole), "")
    mask = lambda name: F.array_join(F.filter(F.transform(of(name), lambda x: x.span), lambda x: x.isNotNull()), ",")
    return done.select("pair_id", "block", text("prompt").alias("prompt"), text("chosen").alias("chosen"), mask("chosen").alias("chosen_mask"), text("rejected").alias("rejected"), mask("rejected").alias("rejected_mask"), "n_turns", "prompt_turns")


def with_other_answers(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """A rejected conversation for each: its own turns, but the last number's with the text of the last turn of conversation id xor 1, or
    without it where there is none. Ties at the last number: the least text is handed on, all get the other's."""
    last = turns.where(F.col(id_col).isNotNull() & F.col("turn").isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max("turn").alias("_turn"), F.min(F.struct(-F.col("turn"), "text")).getField("text").alias("_text"))
    other = last.select(F.col("_id").bitwiseXOR(F.lit(1)).alias("_id"), F.col("_text").alias("_other"))
    last = last.select("_id", "_turn").join(other, "_id", "left")
    both = turns.select(F.col(id_col).alias("_own"), "turn", "role", "text").join(last, F.col("_own") == F.col("_id"), "left")
    ends = F.coalesce(F.col("turn") == F.col("_turn"), F.lit(False))
    return both.where(~ends | F.col("_other").isNotNull()).select(F.col("_own").alias(id_col), "turn", "role", F.when(ends, F.col("_other")).otherwise(F.col("text")).alias("text"))

"""Turns of conversations: their order, and a number for each distinct one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.line_dedup import half_digest

WORD = r"[^\x20\x09-\x0D]+"


def with_ties(turns: DataFrame) -> DataFrame:
    """Adds ``tie``: the place of a row among those of its conversation with the same turn.

    Such rows follow each other by role, then by text.  Only they meet in one task, so a
    conversation of very many turns is spread.  With ``turn_key`` the order is complete.
    """
    same_turn = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    return turns.withColumn("tie", F.row_number().over(same_turn))


def turn_key() -> Column:
    """Sorts the rows of a conversation: null turns first, then by turn, then by tie."""
    return F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)), F.col("tie"))


def turn_digest() -> Column:
    """128 bits that stand for a role and a text; the length keeps the two apart."""
    return F.unhex(half_digest(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")

"""Preference formatting: a shared prompt and two masked completions from a chosen and a rejected conversation.

The longest run of first turns that both conversations have alike (role and text) is rendered once as the prompt. What
follows in each is its completion, with the character ranges that a loss may count: the texts of assistant turns.
A turn is shuffled once to its pair; all else are array functions inside the pair's row.

Defined results: turns without a conversation id belong to none and are left out; turns of one conversation are ordered
by turn number (null first), then role and text, so repeated rows stay and ties have one order; a null role or text
renders as empty and equals only null; a pair whose conversations are equal, or one the beginning of the other, has an
empty completion; a pair one of whose conversations has no turns gives that side no turns; extra columns are ignored;
empty tables give an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Written before the role, between role and text, and after the text of a turn.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def swapped_answers(turns: DataFrame, trained: str = "assistant", conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations with a worse twin each: the same turns, but the last ``trained`` turn says what the neighbour's last one says.

    Each conversation keeps its turns as conversation 2 * id; its twin is 2 * id + 1 and takes the text from the one of the two
    conversations 2k and 2k + 1 that it is not. Without such a turn on both sides there is no twin. Pair them by
    ``twin_pairs``. Returns the columns ``conv_col, turn_col, role_col, text_col``.
    """
    said = turns.select(F.col(conv_col).cast("long").alias("_c"), F.col(turn_col).alias("_n"), F.col(role_col).cast("string").alias("_r"), F.col(text_col).cast("string").alias("_t")).where("_c is not null")
    final = said.where(F.col("_r") == trained).groupBy("_c").agg(F.max(F.struct("_n", "_r", "_t")).alias("_last"))
    # the neighbour of 2k is 2k + 1 and the other way round
    other = final.select(F.expr("_c + 1 - 2 * pmod(_c, 2)").alias("_o"), F.col("_last._t").alias("_answer"))
    told = final.join(other, F.col("_c") == F.col("_o")).select(F.col("_c").alias("_k"), "_last", "_answer")
    twins = said.join(told, F.col("_c") == F.col("_k")).withColumn("_t", F.when(F.struct("_n", "_r", "_t").eqNullSafe(F.col("_last")), F.col("_answer")).otherwise(F.col("_t")))
    rows = said.select((F.col("_c") * 2).alias("_c"), "_n", "_r", "_t").unionByName(twins.select((F.col("_c") * 2 + 1).alias("_c"), "_n", "_r", "_t"))
    return rows.select(F.col("_c").alias(conv_col), F.col("_n").alias(turn_col), F.col("_r").alias(role_col), F.col("_t").alias(text_col))


def twin_pairs(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``pair_id, chosen_id, rejected_id``: each even conversation is preferred to the odd one that follows it, if there is one."""
    ids = turns.select(F.col(conv_col).alias("id")).where("pmod(id, 2) = 1").select(F.expr("cast(floor(id / 2) as bigint)").alias("pair_id")).distinct()
    return ids.select("pair_id", (F.col("pair_id") * 2).alias("chosen_id"), (F.col("pair_id") * 2 + 1).alias("rejected_id"))


def neighbour_pairs(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``pair_id, chosen_id, rejected_id``: each even conversation is preferred to the odd one that follows it."""
    ids = turns.select(F.col(conv_col).alias("id")).where("id is not null").select(F.expr("cast(floor(id / 2) as bigint)").alias("pair_id")).distinct()
    return ids.select("pair_id", (F.col("pair_id") * 2).alias("chosen_id"), (F.col("pair_id") * 2 + 1).alias("rejected_id"))


def _let(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def _text(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def _rendered(turns: Column) -> Column:
    made = F.transform(turns, lambda t: F.concat(F.lit(OPEN), _text(t["role"]), F.lit(MIDDLE), _text(t["text"]), F.lit(CLOSE)))
    return F.array_join(made, "")


def _mask(turns: Column, trained: str) -> Column:
    """Begin and end of the text of each trained turn in the rendered string."""
    none = F.array().cast("array<struct<begin:int,end:int>>")

    def add(acc: Column, t: Column) -> Column:
        begin = acc["at"] + len(OPEN) + F.length(_text(t["role"])) + len(MIDDLE)
        end = begin + F.length(_text(t["text"]))
        spans = F.when(t["role"] == trained, F.concat(acc["spans"], F.array(F.struct(begin.alias("begin"), end.alias("end"))))).otherwise(acc["spans"])
        return F.struct((end + len(CLOSE)).cast("int").alias("at"), spans.cast("array<struct<begin:int,end:int>>").alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda acc: acc["spans"])


def preferences(turns: DataFrame, pairs: DataFrame, trained: str = "assistant", conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``pair_id, chosen_id, rejected_id, n_prompt_turns, n_chosen_turns, n_rejected_turns, prompt, chosen, rejected, chosen_mask, rejected_mask``."""
    sides = pairs.select("pair_id", "chosen_id", "rejected_id", F.explode(F.array(F.struct(F.lit(True).alias("good"), F.col("chosen_id").alias("id")), F.struct(F.lit(False).alias("good"), F.col("rejected_id").alias("id")))).alias("s"))
    sides = sides.select("pair_id", "chosen_id", "rejected_id", "s.good", "s.id")
    said = turns.select(F.col(conv_col).alias("conv"), F.struct(F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")).alias("t")).where("conv is not null")
    joined = sides.join(said, F.col("id") == F.col("conv"), "left")
    of = lambda good: F.array_sort(F.collect_list(F.when(F.col("good") if good else ~F.col("good"), F.col("t"))))
    whole = joined.groupBy("pair_id", "chosen_id", "rejected_id").agg(of(True).alias("a"), of(False).alias("b"))
    shared = F.least(F.size("a"), F.size("b"))
    alike = F.zip_with(F.slice("a", 1, shared), F.slice("b", 1, shared), lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))
    prefix = _let(alike, lambda same: F.when(F.array_contains(same, False), F.array_position(same, F.lit(False)) - 1).otherwise(F.size(same)).cast("int"))
    cut = whole.withColumn("n", prefix)
    rest = lambda c: F.slice(c, F.col("n") + 1, F.size(c))
    parts = cut.select("pair_id", "chosen_id", "rejected_id", F.col("n").alias("n_prompt_turns"), F.slice("a", 1, F.col("n")).alias("p"), rest("a").alias("a"), rest("b").alias("b"))
    return parts.select(
        "pair_id", "chosen_id", "rejected_id", "n_prompt_turns", F.size("a").alias("n_chosen_turns"), F.size("b").alias("n_rejected_turns"),
        _rendered(F.col("p")).alias("prompt"), _rendered(F.col("a")).alias("chosen"), _rendered(F.col("b")).alias("rejected"),
        _mask(F.col("a"), trained).alias("chosen_mask"), _mask(F.col("b"), trained).alias("rejected_mask"))


def mask_text(mask: Column) -> Column:
    """A mask as text, ``begin-end`` joined by commas."""
    return F.array_join(F.transform(mask, lambda s: F.concat(s["begin"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",")

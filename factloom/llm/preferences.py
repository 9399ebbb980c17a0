"""Preference pairs as training text: one prompt, two completions, and what of them is trained on.

Everything runs as DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation as an array of (role, text), in order.

    Order is by turn, then role and text, so ties have one order; a NULL turn comes first.
    NULL role or text is empty. Rows without conv_id belong to no conversation. A conversation
    is one row of the result, so its turns meet in one place; nothing else does.
    """
    turn = F.struct(
        turns["turn"].alias("turn"),
        F.coalesce(turns["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(turns["text"].cast("string"), F.lit("")).alias("text"),
    )
    rows = turns.filter(turns["conv_id"].isNotNull()).select(turns["conv_id"].alias("conv_id"), turn.alias("t"))
    ordered = F.array_sort(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    )


def common_prefix(a: Column, b: Column) -> Column:
    """How many leading turns are equal in role and text."""
    differ = F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y))  # the shorter side is filled up with NULL
    first = F.array_position(differ, True)
    return F.when(first == 0, F.size(a)).otherwise(first - 1).cast("int")


def rendered(turns: Column) -> Column:
    one = F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(END)))
    return F.array_join(one, "")


def trained_spans(turns: Column) -> Column:
    """[begin, end) in characters of the rendered turns: texts of trained turns with their end mark."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin: int, end: int>>").alias("spans"))

    def step(s: Column, t: Column) -> Column:
        begin = s["at"] + F.length(t["role"]) + len(OPEN) + len(CLOSE)
        end = begin + F.length(t["text"]) + len(END)
        span = F.array(F.struct(begin.alias("begin"), end.alias("end")))
        return F.struct(
            end.alias("at"),
            F.when(t["role"] == TRAINED, F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"),
        )

    return F.aggregate(turns, start, step)["spans"]


def format_pairs(pairs: DataFrame) -> DataFrame:
    """(pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans, tied).

    ``pairs`` has (pair_id, chosen_turns, rejected_turns), arrays of (role, text). The longest
    common prefix of turns is rendered once as the prompt; what follows on either side is its
    completion. Spans say which characters of a completion are trained on: the assistant's
    texts and their end marks; the rest is masked. Equal conversations are tied: the prompt is
    all of them and both completions are empty. NULL turns count as no turns; other columns
    are not read.
    """
    none = F.array().cast("array<struct<role: string, text: string>>")
    split = (
        pairs.select(
            "pair_id",
            F.coalesce("chosen_turns", none).alias("a"),
            F.coalesce("rejected_turns", none).alias("b"),
        )
        .withColumn("n", common_prefix(F.col("a"), F.col("b")))
        .select(
            "pair_id",
            "n",
            F.slice("a", F.lit(1), F.col("n")).alias("prompt_turns"),
            F.slice("a", F.col("n") + 1, F.size("a")).alias("a_rest"),
            F.slice("b", F.col("n") + 1, F.size("b")).alias("b_rest"),
        )
    )
    return split.select(
        "pair_id",
        F.col("n").alias("n_prompt_turns"),
        rendered(F.col("prompt_turns")).alias("prompt"),
        rendered(F.col("a_rest")).alias("chosen"),
        rendered(F.col("b_rest")).alias("rejected"),
        trained_spans(F.col("a_rest")).alias("chosen_spans"),
        trained_spans(F.col("b_rest")).alias("rejected_spans"),
        ((F.size("a_rest") == 0) & (F.size("b_rest") == 0)).alias("tied"),
    )


def answered_elsewhere(turns: DataFrame) -> DataFrame:
    """Pairs for ``format_pairs`` from conversations alone, one per conversation.

    Chosen is the conversation as it is. Rejected has, in place of its last assistant turn,
    the last assistant turn of the conversation with the next id, an answer to something else
    (none, if there is no such conversation or it has no answer); what followed stays. A
    conversation without an assistant turn is its own rejected one, and so tied.
    """
    whole = conversations(turns)
    held = whole.withColumn("answer", F.array_max(F.transform("turns", lambda t, k: F.when(t["role"] == TRAINED, k))))
    lent = held.select((F.col("conv_id") - 1).alias("lent_to"), F.slice("turns", F.col("answer") + 1, F.lit(1)).alias("lent"))
    joined = held.join(lent, F.col("conv_id") == F.col("lent_to"), "left")
    none = F.array().cast("array<struct<role: string, text: string>>")
    other = F.concat(
        F.slice("turns", F.lit(1), F.col("answer")),
        F.coalesce("lent", none),
        F.slice("turns", F.col("answer") + 2, F.size("turns")),
    )
    return joined.select(
        F.col("conv_id").alias("pair_id"),
        F.col("turns").alias("chosen_turns"),
        F.when(F.col("answer").isNull(), F.col("turns")).otherwise(other).alias("rejected_turns"),
    )

"""Preference formatting of conversation pairs, with DataFrame functions only.

Conversations ``2k`` (chosen) and ``2k + 1`` (rejected) make pair ``k``. The longest common prefix of their turns, equal
in role and text, is rendered once as the prompt; the turns after it are each side's completion, with
the character spans of its assistant turns as training mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed markers of the rendered form.
HEAD, MIDDLE, END = "<|", "|>\n", "<|end|>\n"


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(HEAD), t["role"], F.lit(MIDDLE), t["text"], F.lit(END))), "")


def _mask(turns: Column) -> Column:
    """Spans start:end of what the assistant says (text and end marker), in code points, comma-joined."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        begin = state["at"] + F.length(t["role"]) + len(HEAD) + len(MIDDLE)
        end = begin + F.length(t["text"]) + len(END)
        span = F.concat_ws(":", begin.cast("string"), end.cast("string"))
        spans = F.when(t["role"] == "assistant", F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.cast("long").alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda s: F.array_join(s["spans"], ","))


def format_preferences(conversations: DataFrame) -> DataFrame:
    """One row for each pair with at least one turn, from ``conv_id``, ``turn``, ``role``, ``text`` (others are ignored).

    ``n_chosen`` and ``n_rejected`` count all turns of a side; a missing side has 0, an empty completion and so no
    common prefix. Null roles and texts are empty strings, repeated turns are kept (ordered by turn, role and
    text; a null turn comes first), and rows without conv_id belong to no conversation. A conversation
    becomes one row, as in any chat format, so it must fit in a task.
    """
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.expr("(conv_id - pmod(conv_id, 2)) div 2").alias("pair_id"),
        F.struct(F.expr("pmod(conv_id, 2)").alias("side"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"),
    )
    grouped = turns.groupBy("pair_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    sides = grouped.select("pair_id", F.filter("ts", lambda t: t["side"] == 0).alias("c"), F.filter("ts", lambda t: t["side"] == 1).alias("r"))
    same = F.zip_with("c", "r", lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))
    found = sides.withColumn("differ", F.array_position(same, False).cast("int"))
    lcp = F.when(F.col("differ") > 0, F.col("differ") - 1).otherwise(F.least(F.size("c"), F.size("r")))
    cut = found.withColumn("n_prompt", lcp).select(
        "pair_id",
        F.size("c").cast("long").alias("n_chosen"),
        F.size("r").cast("long").alias("n_rejected"),
        F.col("n_prompt").cast("long"),
        F.slice("c", F.lit(1), F.col("n_prompt")).alias("p"),
        F.slice("c", F.col("n_prompt") + 1, F.size("c")).alias("c"),
        F.slice("r", F.col("n_prompt") + 1, F.size("r")).alias("r"),
    )
    return cut.select("pair_id", "n_chosen", "n_rejected", "n_prompt", _render(F.col("p")).alias("prompt"), _render(F.col("c")).alias("chosen"), _mask(F.col("c")).alias("chosen_mask"), _render(F.col("r")).alias("rejected"), _mask(F.col("r")).alias("rejected_mask"))

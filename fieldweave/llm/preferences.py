"""Pairs of conversations as prompt and masked completions, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldweave.operators.joins import split_join

OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def _clean(text: Column) -> Column:
    """Text that cannot be taken for a mark."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _rendered(turns: Column) -> Column:
    """Segments of the turns: the heading of a turn, never trained, and its text, trained if the role is."""
    return F.flatten(F.transform(turns, lambda t: F.array(
        F.struct(F.concat(F.lit(OPEN), _clean(t.role), F.lit(MIDDLE)).alias("text"), F.lit(False).alias("train")),
        F.struct(F.concat(_clean(t.text), F.lit(CLOSE)).alias("text"), (F.coalesce(t.role, F.lit("")) == TRAINED_ROLE).alias("train")))))


def _text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s.text), "")


def mask(segments: Column) -> Column:
    """Lengths in characters of the segments of a completion, each with 1 if it is trained: ``23:0 40:1``."""
    return F.array_join(F.transform(segments, lambda s: F.concat_ws(":", F.length(s.text), s.train.cast("int"))), " ")


def format_pairs(turns: DataFrame) -> DataFrame:
    """One row per pair of ``turns`` (``pair_id, chosen, turn, role, text``; ``chosen`` says which of the two it is).

    Returns ``pair_id, n_prompt_turns, n_chosen_turns, n_rejected_turns, prompt, chosen, rejected``. The longest common
    prefix of turns, equal in role and text, is rendered once as ``prompt``. ``chosen`` and ``rejected`` are the segments
    (text, train) of the remaining turns; only the texts of assistants, with their end mark, are trained.

    One shuffle brings the turns of a pair together; they end up in one row anyway. Turns are ordered by number, those of
    equal number by role and text, and repeated rows count once. A NULL role or text is rendered as empty and equals
    only NULL in the comparison. Rows without a pair or a side are left out, as they name no conversation. If one
    conversation begins with all of the other, the other's completion is empty; if one is missing, the prompt is empty and its
    completion too. Marks inside a text are broken up. Other columns are not read.
    """
    turn = F.struct("turn", "role", "text")
    pairs = turns.filter("pair_id is not null and chosen is not null").groupBy("pair_id").agg(
        F.sort_array(F.collect_set(F.when(F.col("chosen"), turn))).alias("a"),
        F.sort_array(F.collect_set(F.when(~F.col("chosen"), turn))).alias("b"))
    shorter = F.least(F.size("a"), F.size("b"))
    same = F.zip_with("a", "b", lambda x, y: x.role.eqNullSafe(y.role) & x.text.eqNullSafe(y.text))
    differs = F.array_position(same, False)
    pairs = pairs.withColumn("n", F.when(differs == 0, shorter).otherwise(F.least(shorter, differs - 1)).cast("int"))
    rest = lambda side: F.slice(side, F.col("n") + 1, F.greatest(F.size(side) - F.col("n"), F.lit(0)))
    return pairs.select(
        "pair_id", F.col("n").cast("long").alias("n_prompt_turns"),
        (F.size("a") - F.col("n")).cast("long").alias("n_chosen_turns"), (F.size("b") - F.col("n")).cast("long").alias("n_rejected_turns"),
        _text(_rendered(F.slice("a", F.lit(1), F.col("n")))).alias("prompt"),
        _rendered(rest(F.col("a"))).alias("chosen"), _rendered(rest(F.col("b"))).alias("rejected"))


def retold(conversations: DataFrame) -> DataFrame:
    """Turns for ``format_pairs``: each conversation as it is (chosen) and with another answer (rejected); ``pair_id`` is its id.

    The rejected one goes up to one of the assistant's turns, which a hash of conversation and turn picks, and has in its
    place the answer that was picked in the same way from conversation 2k for 2k + 1, and the other way round: the first
    by text if there are several at that turn. If the other one has no answer, the rejected one ends before that turn, and
    so the chosen one begins with all of it. Without a turn of the assistant there is no rejected one. Rows without a
    conversation are left out; a turn without a number is never picked and stays out of the rejected one.
    """
    turns = conversations.select(F.col("conv_id").cast("long").alias("pair_id"), "turn", "role", "text").filter("pair_id is not null")
    answers = turns.filter((F.col("role") == TRAINED_ROLE) & F.col("turn").isNotNull())
    place = F.md5(F.concat_ws(":", F.col("pair_id").cast("string"), F.col("turn").cast("string")).cast("binary"))
    cut = answers.groupBy("pair_id").agg(F.min_by("turn", place).alias("at"))
    picked = split_join(answers.withColumnRenamed("turn", "at"), cut.withColumnRenamed("at", "own"), ["pair_id"], "inner").filter("at = own")
    answer = picked.groupBy(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id")).agg(F.min("text").alias("text"))
    other = answer.join(cut, "pair_id").select(
        "pair_id", F.lit(False).alias("chosen"), F.col("at").alias("turn"), F.lit(TRAINED_ROLE).alias("role"), "text")
    before = split_join(turns, cut, ["pair_id"], "inner").filter("turn < at").select("pair_id", F.lit(False).alias("chosen"), "turn", "role", "text")
    return turns.select("pair_id", F.lit(True).alias("chosen"), "turn", "role", "text").unionByName(before).unionByName(other)


def neighbours(conversations: DataFrame) -> DataFrame:
    """Turns for ``format_pairs``: conversations 2k (chosen) and 2k + 1 (rejected) are pair k."""
    conv = F.col("conv_id").cast("long")
    return conversations.select(F.shiftright(conv, 1).alias("pair_id"), (conv.bitwiseAND(F.lit(1)) == 0).alias("chosen"), "turn", "role", "text")

"""Preference formatting: the common turns of a chosen and a rejected conversation
once as prompt, the rest as a pair of completions with a training mask.

:func:`preference_turns` gives rows of turns, so a conversation of any length is never
gathered: sorted by (pair_id, side, turn, role, text), the ``rendered``
pieces of a side follow one another. Turns of a pair are matched by one
aggregation on their content; the first turn that is not on both sides
ends the prompt. ``train`` marks assistant turns of the completions, all
else is masked. :func:`preference_pairs` puts them into one row per pair: prompt, both
completions, and the places in them that are trained; a row is as long as its
conversation.

The table has single conversations, so :func:`answered_otherwise` makes the pairs: chosen
is the conversation up to its last assistant turn, rejected the same one with that turn
taken from a donor, the next conversation in the order of a hash.

Defined cases: rows without conv_id are dropped; repeated rows count once; a
null turn comes before all others (-1), a null role is "unknown", a null
text empty; several rows with one turn number (ties) belong to one turn and match
as a set, in order of role and text; of several last assistant texts of a donor the smallest
is taken; equal conversations are all prompt and no pair; a conversation without a
partner (no assistant turn, or no other conversation with one) gives no pair; empty and
very long texts are rendered whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logpulse.operators import number_rows
from logpulse.session import shared_dir

from .common import read_table

#: A turn is written <|role|>, line feed, text, <|end|>, line feed.
TRAINED_ROLE = "assistant"


def preference_turns(turns: DataFrame) -> DataFrame:
    """(pair_id, is_chosen, turn, role, text) -> (pair_id, side, turn, role, rendered, train)."""
    matched = turns.groupBy("pair_id", "turn", "role", "text").agg(
        F.max("is_chosen").alias("in_chosen"), F.max(~F.col("is_chosen")).alias("in_rejected"))
    differs = matched.groupBy("pair_id").agg(
        F.min(F.when(~(F.col("in_chosen") & F.col("in_rejected")), F.col("turn"))).alias("first_diff"))
    told = matched.join(differs, "pair_id")
    prompt = F.col("first_diff").isNull() | (F.col("turn") < F.col("first_diff"))
    sides = F.when(prompt, F.array(F.lit("prompt"))).otherwise(F.filter(F.array(
        F.when(F.col("in_chosen"), F.lit("chosen")), F.when(F.col("in_rejected"), F.lit("rejected"))),
        lambda s: s.isNotNull()))
    return told.select(
        "pair_id", F.explode(sides).alias("side"), "turn", "role",
        F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("<|end|>\n")).alias("rendered")).withColumn(
        "train", (F.col("side") != "prompt") & (F.col("role") == TRAINED_ROLE))


def neighbour_pairs(conversations: DataFrame) -> DataFrame:
    """Conversations 2k (chosen) and 2k + 1 (rejected) are pair k."""
    return _turns(conversations).select(
        F.floor(F.col("conv_id") / 2).alias("pair_id"), (F.pmod("conv_id", F.lit(2)) == 0).alias("is_chosen"),
        "turn", "role", "text")


def _turns(conversations: DataFrame) -> DataFrame:
    c = conversations.select(*[conversations[n].alias(n) for n in ("conv_id", "turn", "role", "text")])
    return c.where("conv_id is not null").select(
        "conv_id", F.coalesce("turn", F.lit(-1)).cast("long").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def answered_otherwise(conversations: DataFrame) -> DataFrame:
    """(pair_id, is_chosen, turn, role, text): each conversation up to its last assistant turn, and the same with
    that turn from a donor. ``pair_id`` is the conversation's id."""
    turns = _turns(conversations)
    answer = F.col("role") == TRAINED_ROLE
    last = turns.where(answer).groupBy("conv_id").agg(F.max("turn").alias("last"))
    answers = (turns.where(answer).join(last, "conv_id").where("turn = last")
               .groupBy("conv_id", "last").agg(F.min("text").alias("answer")))
    # a place in the order of a hash; the next one is the donor, the first that of the last
    ring = number_rows(answers.withColumn("key", F.sha2(F.col("conv_id").cast("string"), 256)), "key", "conv_id", name="place",
                       path=shared_dir(conversations.sparkSession, "llm", "preference_ring"))
    n = ring.agg(F.max("place")).first()[0] or 0
    donors = ring.select((F.pmod(F.col("place") - 2, F.lit(n)) + 1 if n else F.col("place")).alias("place"),
                         F.col("conv_id").alias("donor_id"), F.col("answer").alias("other"))
    given = ring.join(donors, "place").where("donor_id <> conv_id").select("conv_id", "last", "other")
    own = turns.join(given, "conv_id").where((F.col("turn") < F.col("last")) | ((F.col("turn") == F.col("last")) & answer))
    chosen = own.select(F.col("conv_id").alias("pair_id"), F.lit(True).alias("is_chosen"), "turn", "role", "text")
    before = own.where("turn < last").select(F.col("conv_id").alias("pair_id"), F.lit(False).alias("is_chosen"), "turn", "role", "text")
    instead = given.select(F.col("conv_id").alias("pair_id"), F.lit(False).alias("is_chosen"), F.col("last").alias("turn"),
                           F.lit(TRAINED_ROLE).alias("role"), F.col("other").alias("text"))
    return chosen.unionByName(before).unionByName(instead)


def preference_pairs(turns: DataFrame) -> DataFrame:
    """(pair_id, is_chosen, turn, role, text) -> (pair_id, prompt, chosen, rejected, chosen_train, rejected_train).

    The last two list the trained stretches of the completions, start:end in code points, end
    exclusive: the assistant's texts with their end marks. Pairs that do not differ give no row."""
    rows = preference_turns(turns)
    along = Window.partitionBy("pair_id", "side").orderBy("turn", "role", "rendered")
    placed = rows.withColumn("end", F.sum(F.length("rendered")).over(along))
    start = F.col("end") - F.length("rendered") + F.length("role") + 5  # behind <|role|> and its line feed
    placed = placed.withColumn("stretch", F.when(F.col("train"), F.concat_ws(":", start, "end")))
    order = F.struct("end", "rendered", "stretch")
    pairs = placed.groupBy("pair_id").agg(*[
        F.array_sort(F.collect_list(F.when(F.col("side") == s, order))).alias(s) for s in ("prompt", "chosen", "rejected")])
    text = lambda s: F.array_join(F.transform(s, lambda x: x["rendered"]), "")
    marks = lambda s: F.array_join(F.transform(s, lambda x: x["stretch"]), ",")
    return pairs.where("size(chosen) + size(rejected) > 0").select(
        "pair_id", *[text(s).alias(s) for s in ("prompt", "chosen", "rejected")],
        *[marks(s).alias(f"{s}_train") for s in ("chosen", "rejected")])


def op8_preference_pairs(spark, sf_dir: str) -> DataFrame:
    return preference_pairs(answered_otherwise(read_table(spark, sf_dir, "conversations")))

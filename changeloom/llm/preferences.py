"""Preference formatting of chat conversations (operator 6).

A pair names a chosen and a rejected conversation. The turns that both have in common from the start are rendered
once, as the prompt; what follows is rendered per side, as completions. Each turn is one rendered segment, with
its place in its part and the span on which a model is trained: the content of assistant turns in
completions. Everything else (prompt, other roles, headers) is masked.

Turns are aligned by their number in an equality join of the two sides; the first number at which they differ
is a minimum per pair, made in part before the shuffle. A conversation is never collected: one with a large
part of all turns stays spread over tasks, and places come from running sums in two steps, within and
across blocks of ``BLOCK`` turns.

Texts are moved twice: to drop repeated turns, and to their places at the end. In between a turn is its lengths and
a SHA-256 of its content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changeloom.llm.common import stored

TRAINED_ROLE = "assistant"
BLOCK = 1024


def header(role: Column) -> Column:
    # A role can neither begin nor end a header.
    return F.concat(F.lit("<|"), F.replace(plain(role), F.lit("|>"), F.lit("| >")), F.lit("|>\n"))


def plain(text: Column) -> Column:
    """A text in which nothing can be taken for a header."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def distinct_turns(turns: DataFrame) -> DataFrame:
    """``(conv, turn, role, text)`` without NULLs; of rows with the same number in a conversation the least."""
    content = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    known = turns.where("conv_id IS NOT NULL AND turn IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), content.alias("content")
    )
    return known.groupBy("conv", "turn").agg(F.min("content").alias("content")).select("conv", "turn", "content.*")


def aligned(known: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(pair_id, turn, chosen, rejected)``, a side being ``(conv, head, body, answer, content)``: lengths of header and text, whether
    the role is the trained one, and a digest of both; NULL where it has no such turn."""
    # The length keeps roles and texts apart.
    content = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    turn = F.struct(
        "conv", F.length(header(F.col("role"))).alias("head"), F.length(plain(F.col("text"))).alias("body"),
        (F.col("role") == TRAINED_ROLE).alias("answer"), F.unhex(F.sha2(content, 256)).alias("content"),
    )
    named = pairs.where("pair_id IS NOT NULL AND chosen IS NOT NULL AND rejected IS NOT NULL")
    named = named.groupBy("pair_id").agg(F.min(F.struct("chosen", "rejected")).alias("ids"))
    sides = F.array(
        *[F.struct(F.lit(side).alias("side"), F.col(f"ids.{side}").cast("long").alias("conv")) for side in ("chosen", "rejected")]
    )
    rows = known.select("conv", "turn", turn.alias("figures")).join(named.select("pair_id", F.inline(sides)), "conv")

    def of(side: str) -> Column:
        return F.min(F.when(F.col("side") == side, F.col("figures"))).alias(side)

    return rows.groupBy("pair_id", "turn").agg(of("chosen"), of("rejected"))


def format_preferences(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(pair_id, part, turn, role, segment, start, end, loss_start, loss_end)``, a row per rendered turn.

    ``turns`` has ``conv_id, turn, role, text``; ``pairs`` has ``pair_id, chosen, rejected``. ``part`` is ``prompt``, ``chosen`` or
    ``rejected``; ``start`` and ``end`` place the segment in its part, ``loss_start`` and ``loss_end`` the trained span in it,
    all in code points, equal when nothing is trained. Rows without a conversation or turn number and
    pairs without an id or a side are left out. NULL roles and texts are empty ones. Of rows with the same
    number in a conversation, and of pairs with the same id, the least counts. If both sides are equal, all is prompt;
    if one has no turns, the other is all completion. Empty tables give an empty result; other
    columns are not read.
    """
    known = stored(distinct_turns(turns), "turns", free=True)
    rows = stored(aligned(known, pairs), "aligned", free=True)
    same = F.col("chosen.content").eqNullSafe(F.col("rejected.content"))
    splits = rows.groupBy("pair_id").agg(F.min(F.when(~same, F.col("turn"))).alias("split"))
    rows = rows.join(splits, "pair_id")
    shared = F.col("split").isNull() | (F.col("turn") < F.col("split"))

    def part(name: str, side: str) -> Column:
        return F.struct(F.lit(name).alias("part"), *[F.col(f"{side}.{c}").alias(c) for c in ("conv", "head", "body", "answer")])

    completions = F.array_compact(
        F.array(*[F.when(F.col(side).isNotNull(), part(side, side)) for side in ("chosen", "rejected")])
    )
    parts = F.when(shared, F.array(part("prompt", "chosen"))).otherwise(completions)
    rows = rows.select("pair_id", "turn", F.inline(parts))
    # A line feed ends each segment.
    rows = rows.withColumns({
        "size": (F.col("head") + F.col("body") + 1).cast("long"), "block": F.floor(F.col("turn") / BLOCK),
    })

    # Places within a block, then the lengths of the blocks before.
    in_block = Window.partitionBy("pair_id", "part", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("reach", F.sum("size").over(in_block))
    before = Window.partitionBy("pair_id", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("pair_id", "part", "block").agg(F.max("reach").alias("length"))
    blocks = blocks.select("pair_id", "part", "block", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))
    rows = rows.join(blocks, ["pair_id", "part", "block"])
    end = F.col("offset") + F.col("reach")
    trained = (F.col("part") != "prompt") & F.col("answer")
    loss_end = end - 1
    places = rows.select(
        "pair_id", "part", "conv", "turn", (end - F.col("size")).alias("start"), end.alias("end"),
        F.when(trained, end - F.col("size") + F.col("head")).otherwise(loss_end).alias("loss_start"), loss_end.alias("loss_end"),
    )
    segment = F.concat(header(F.col("role")), plain(F.col("text")), F.lit("\n")).alias("segment")
    return known.join(places, ["conv", "turn"]).select(
        "pair_id", "part", "turn", "role", segment, "start", "end", "loss_start", "loss_end"
    )


def neighbouring_pairs(turns: DataFrame) -> DataFrame:
    """Pairs from a table without preferences: conversation ``2 i`` is the chosen one, ``2 i + 1`` the rejected one."""
    pair = F.floor(F.col("conv_id") / 2).alias("pair_id")
    ids = turns.where("conv_id IS NOT NULL").select(pair).distinct()
    return ids.select("pair_id", (F.col("pair_id") * 2).alias("chosen"), (F.col("pair_id") * 2 + 1).alias("rejected"))


def with_swapped_answers(turns: DataFrame) -> DataFrame:
    """Chosen and rejected conversations from a table without preferences, as conversations ``2 i`` and ``2 i + 1``.

    The chosen one is conversation ``i``. The rejected one has the same turns, but its last assistant turn has the text of
    the last one of conversation ``i + 1``, or ``i - 1`` where that has none, and is missing if neither has one. Without
    an assistant turn both are the same. Rows without a conversation or turn number are left out. A swapped turn is one row,
    even if the last turn is there more than once.
    """
    known = turns.where("conv_id IS NOT NULL AND turn IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    said = known.where(F.col("role") == TRAINED_ROLE)
    lasts = said.groupBy("conv_id").agg(F.max("turn").alias("turn"))
    beside = {name: lasts.select((F.col("conv_id") - step).alias("conv_id"), F.col("conv_id").alias(name)) for name, step in (("after", 1), ("before", -1))}
    swaps = lasts.join(beside["after"], "conv_id", "left").join(beside["before"], "conv_id", "left")
    swaps = swaps.select("conv_id", "turn", F.coalesce("after", "before").alias("source"))
    # Texts are looked up for the last turns alone; all others stay as they are.
    answers = said.join(lasts, ["conv_id", "turn"]).groupBy("conv_id").agg(F.max(F.coalesce("text", F.lit(""))).alias("text"))
    swapped = swaps.join(answers.withColumnRenamed("conv_id", "source"), "source").select(
        (F.col("conv_id") * 2 + 1).alias("conv_id"), "turn", F.lit(TRAINED_ROLE).alias("role"), "text"
    )
    rows = known.join(lasts.withColumn("last", F.lit(True)), ["conv_id", "turn"], "left")
    is_last = F.coalesce(F.col("last") & (F.col("role") == TRAINED_ROLE), F.lit(False))
    sides = F.array_compact(F.array(F.col("conv_id") * 2, F.when(~is_last, F.col("conv_id") * 2 + 1)))
    kept = rows.select(F.explode(sides).alias("conv_id"), "turn", "role", "text")
    return kept.union(swapped)

"""Chat logs to training text: snapshots that a longer log continues are collapsed, the others rendered.

Loggers write a conversation anew after each turn. A hash rolls along the turns of each: sums of turn hashes, which can
be taken in parts. A conversation whose hash over all its turns is the hash of a proper prefix of another one is
dropped by an anti-join; of equal ones the least conv_id stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import stage, whole_text

PART_TURNS = 256  # turns of a conversation rendered in a row
BORDER_CHARACTERS = 64
HASHES = ("h0", "h1", "h2", "h3")


def turn_hashes() -> list[Column]:
    """Four 32-bit numbers for a turn, from its number, role and text; null and empty differ."""
    fields = ("turn", "role", "text")
    parts = [x for c in fields for x in (F.col(c), F.col(c).isNull())]
    one, two = F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)
    low = F.lit(0xFFFFFFFF)
    return [
        part.alias(name)
        for name, part in zip(
            HASHES, (one.bitwiseAND(low), F.shiftrightunsigned(one, 32), two.bitwiseAND(low), F.shiftrightunsigned(two, 32))
        )
    ]


def prefixes(turns: DataFrame) -> DataFrame:
    """The turns with n (turns up to here) and the sums of the hashes of the prefix that ends with each.

    Turns are range-sorted by conversation, number, role and text, nulls last. Running sums within a conversation's share
    of a partition and the sums of its shares before give the prefix, so a conversation with a third of all turns is many
    tasks' work.
    """
    numbered = [F.asc_nulls_last("turn"), F.asc_nulls_last("role")]
    hashed = turns.select("conv_id", "turn", "role", "text", *turn_hashes())
    # borders of partitions need no more of a text than this; turns that agree in it stay together
    start = F.substring("text", 1, BORDER_CHARACTERS)
    ranged = hashed.repartitionByRange("conv_id", *numbered, start.asc_nulls_last())
    order = [*numbered, F.asc_nulls_last("text")]
    ranged = stage(ranged.select("*", F.spark_partition_id().alias("part")), "turns")
    sums = [F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(h) for h in HASHES]]
    shares = ranged.groupBy("conv_id", "part").agg(*sums)
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        shares.select(
            F.col("conv_id").alias("of"),
            F.col("part").alias("of_part"),
            *[F.sum(c).over(earlier).alias(f"{c}_before") for c in ("n", *HASHES)],
        )
        .where("n_before is not null")  # one row for each border of partitions that cuts a conversation
    )
    within = Window.partitionBy("conv_id", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select(
        "conv_id", "part", "turn", "role", "text",
        F.count(F.lit(1)).over(within).alias("n"), *[F.sum(h).over(within).alias(h) for h in HASHES],
    )
    on = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part"))
    return local.join(before, on, "left").select(
        "conv_id", "turn", "role", "text",
        *[(F.col(c) + F.coalesce(f"{c}_before", F.lit(0))).alias(c) for c in ("n", *HASHES)],
    )


def maximal(rolled: DataFrame) -> DataFrame:
    """conv_id and snapshots (logs collapsed into it, itself included where equal) of the conversations that stay."""
    key = ["n", *HASHES]
    lengths = rolled.groupBy("conv_id").agg(F.max(F.struct(*key)).alias("whole"))
    whole = lengths.select(F.col("conv_id"), "whole.*")
    distinct = whole.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    ends = whole.select(F.col("conv_id").alias("of"), F.col("n").alias("last"))
    inner = rolled.join(ends, F.col("conv_id").eqNullSafe(F.col("of"))).where("n < last").select(*key).distinct()
    return distinct.join(inner, key, "left_anti").select("conv_id", "copies", F.col("n").alias("turns"))


def format_chats(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Rows of conv_id, part (from 0), turns (of the conversation), copies (equal logs), text, for maximal conversations.

    A conversation is rendered in parts of ``part_turns`` turns, so that a very long one is many rows. Turns are in the
    order of their number, then role, then text, nulls last. A null role is "unknown", a null text empty. A null conv_id is
    one conversation. Repeated rows are turns like any other. No rows give no rows.
    """
    rolled = stage(prefixes(turns), "rolled")
    stay = stage(maximal(rolled), "maximal")
    role = F.coalesce("role", F.lit("unknown"))
    text = F.concat(F.lit("<|"), role, F.lit("|>\n"), whole_text(), F.lit("\n"))
    stay = stay.withColumnRenamed("conv_id", "of")
    return (
        rolled.join(stay, F.col("conv_id").eqNullSafe(F.col("of")))
        .select("conv_id", "turns", "copies", "n", F.floor((F.col("n") - 1) / part_turns).cast("int").alias("part"), text.alias("text"))
        .groupBy("conv_id", "part", "turns", "copies")
        .agg(F.sort_array(F.collect_list(F.struct("n", "text"))).alias("said"))
        .select("conv_id", "part", "turns", "copies", F.array_join(F.col("said.text"), "").alias("text"))
    )

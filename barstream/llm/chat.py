"""Chat formatting after collapsing cumulative snapshots of a conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barstream.session import staged

#: Turns that are numbered, hashed and rendered together.
PART = 256


def _turn_hash(salt: str) -> Column:
    """Hash of a turn at its place; the places make an XOR of them order-dependent."""
    return F.xxhash64(F.lit(salt), F.col("place"), F.col("role"), F.col("text"))


def _placed(turns: DataFrame) -> DataFrame:
    """Each conversation's turns at places 1, 2, ... with rolling prefix hashes.

    Turns are taken ``PART`` turn numbers at a time: each block is numbered and hashed
    in a window of its own, and one row per block carries the totals of the blocks
    before it, so a conversation that holds much of the data is split.
    """
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()
    rows = rows.withColumn("block", F.floor(F.col("turn") / PART))
    order = [F.col("turn").asc_nulls_last(), F.col("role"), F.col("text")]
    inside = Window.partitionBy("conv_id", "block")
    local = staged(
        rows.withColumn("nth", F.row_number().over(inside.orderBy(*order))), "chat-turns"
    )
    before = (
        Window.partitionBy("conv_id")
        .orderBy(F.col("block").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    sizes = local.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select(
        F.col("conv_id").alias("c"),
        F.col("block").alias("k"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("k"))
    placed = local.join(starts, same).withColumn("place", F.col("start") + F.col("nth"))
    placed = placed.select(
        "conv_id", "block", "place", "role", "text",
        _turn_hash("one").alias("h1"), _turn_hash("two").alias("h2"),
    )
    placed = staged(placed, "chat-places")
    totals = placed.groupBy("conv_id", "block").agg(
        F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")
    )
    carried = totals.select(
        F.col("conv_id").alias("c"),
        F.col("block").alias("k"),
        F.coalesce(F.bit_xor("h1").over(before), F.lit(0)).alias("c1"),
        F.coalesce(F.bit_xor("h2").over(before), F.lit(0)).alias("c2"),
    )
    upto = inside.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rolled = placed.select(
        "conv_id", "block", "place",
        F.bit_xor("h1").over(upto).alias("r1"), F.bit_xor("h2").over(upto).alias("r2"),
    )
    hashed = rolled.join(carried, same).select(
        "conv_id",
        "place",
        F.col("r1").bitwiseXOR(F.col("c1")).alias("p1"),
        F.col("r2").bitwiseXOR(F.col("c2")).alias("p2"),
    )
    return placed, staged(hashed, "chat-prefixes")


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, part, turns, copies, rendered``: the maximal conversations, rendered.

    A conversation whose turns are the first turns of a longer one is a snapshot of it
    and goes; of equal conversations the one with the smallest id stays and ``copies``
    counts them.  Both are found by 128-bit rolling hashes of roles and texts.

    A row holds up to 256 turns; longer conversations go on in further parts.  Null
    roles and texts count as empty, null turns come last, rows of a null ``conv_id``
    are one conversation, and rows repeated in every column count once.  Turns that
    share a number follow each other by role and text.
    """
    placed, prefixes = _placed(turns)
    lengths = placed.groupBy(F.col("conv_id").alias("c")).agg(F.max("place").alias("turns"))
    sized = prefixes.join(lengths, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    whole = sized.where("place = turns")
    kept = whole.groupBy("p1", "p2", "turns").agg(
        F.min("conv_id").alias("keep"), F.count(F.lit(1)).alias("copies")
    )
    proper = sized.where("place < turns").select("p1", "p2", F.col("place").alias("turns"))
    maximal = staged(
        kept.join(proper.distinct(), ["p1", "p2", "turns"], "left_anti"), "chat-maximal"
    ).select("keep", "turns", "copies")
    said = F.concat(
        F.lit("<|im_start|>"), F.col("role"), F.lit("\n"), F.col("text"), F.lit("<|im_end|>\n")
    )
    lines = placed.join(maximal, F.col("conv_id").eqNullSafe(F.col("keep")))
    part = F.floor((F.col("place") - 1) / PART)
    return (
        lines.groupBy("conv_id", part.alias("part"), "turns", "copies")
        .agg(F.array_sort(F.collect_list(F.struct("place", said.alias("line")))).alias("lines"))
        .select(
            "conv_id",
            "part",
            "turns",
            "copies",
            F.array_join(F.col("lines.line"), "").alias("rendered"),
        )
    )

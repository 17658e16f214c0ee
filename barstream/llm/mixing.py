"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barstream.llm.common import NON_BLANKS, text_of
from barstream.session import staged

#: Hex digits of the hash that each histogram resolves, and how often it is refined.
DIGITS = 3
LEVELS = 3


def _cell():
    """The hash that orders a source's documents: its first 36 bits as hex."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.substring(F.md5(text.cast("binary")), 1, DIGITS * LEVELS)


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2
) -> DataFrame:
    """``source, source_size, target, whole, budget``: one row per source.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share``
    of all words.  In order of ``most * size / weight`` the sources that stop at
    ``most`` times their size come first, so running sums give the common level of
    the rest without iterating.  The windows see one row per source, never documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    )
    turn = (F.col("rank") - 1) % len(weights) + 1
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn))
    ranked = ranked.withColumn("cap", most * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, everywhere = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    spare = F.sum("source_size").over(everywhere) * F.lit(share) - F.coalesce(
        F.sum("cap").over(before), F.lit(0)
    )
    weight_left = F.sum("weight").over(everywhere) - F.coalesce(
        F.sum("weight").over(before), F.lit(0)
    )
    levelled = ranked.withColumn("level", spare / weight_left)
    capped = F.col("cap") <= F.col("weight") * F.col("level")
    levelled = levelled.withColumn("capped", capped)
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(everywhere)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        F.col("weight") * level
    )
    whole = (
        F.when(F.col("source_size") == 0, 1)
        .when(F.col("target") >= 2 * F.col("source_size"), 2)
        .when(F.col("target") >= F.col("source_size"), 1)
        .otherwise(0)
    )
    return (
        levelled.withColumn("target", target)
        .withColumn("whole", whole)
        .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
        .select("source", "source_size", "target", "whole", "budget")
    )


def mix_thresholds(docs: DataFrame, text_col: str = "text", source_col: str = "source", **how):
    """(sizes, thresholds): a row per document without its text, and one per source.

    A source takes each document ``whole`` times and once more where its hash lies
    below ``edge``.  A histogram of words by leading hash digits finds the bucket in
    which the budget is reached, and only that bucket is refined, three digits at a
    time; 36 bits leave about one document at the edge, which is taken if that comes
    nearer to the target.  Nothing is sorted, and a hot source is summed up in the
    map tasks like any other.
    """
    size = F.regexp_count(text_of(text_col), F.lit(NON_BLANKS)).cast("long")
    sizes = staged(
        docs.select("doc_id", F.col(source_col).alias("source"), size.alias("size")).withColumn(
            "cell", _cell()
        ),
        "mix-sizes",
    )
    targets = staged(source_targets(sizes, **how), "mix-targets")
    bounds = targets.where("budget > 0").select(
        "source", F.lit("").alias("edge"), F.col("budget").alias("rest")
    )
    for level in range(LEVELS):
        inside = sizes.alias("s").join(
            bounds.alias("b"),
            F.col("s.source").eqNullSafe(F.col("b.source"))
            & (F.substring("s.cell", 1, level * DIGITS) == F.col("b.edge")),
        )
        histogram = inside.groupBy(
            F.col("b.source").alias("source"),
            F.substring("s.cell", 1, (level + 1) * DIGITS).alias("edge"),
            F.col("b.rest").alias("rest"),
        ).agg(F.sum("s.size").alias("n"))
        running = F.sum("n").over(Window.partitionBy("source").orderBy("edge"))
        crossed = histogram.withColumn("upto", running).where(
            "upto >= rest and upto - n < rest"
        )
        over = F.col("upto") - F.col("rest")
        left = F.col("rest") - (F.col("upto") - F.col("n"))
        bounds = staged(
            crossed.select(
                "source", "edge", left.alias("rest"), (over <= left).alias("with_edge")
            ),
            "mix-bounds",
        )
    edges = bounds.select(F.col("source").alias("of"), "edge", "with_edge")
    thresholds = targets.join(edges, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    return sizes, staged(thresholds, "mix-thresholds")


def _copies():
    """How often a row with ``cell`` is taken, given its source's threshold."""
    below = (F.col("cell") < F.col("edge")) | ((F.col("cell") == F.col("edge")) & F.col("with_edge"))
    return F.col("whole") + F.when(below, 1).otherwise(0)


def mix_sizes(docs: DataFrame, **how) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` per input row.

    Null and blank texts have size 0; a source without words is taken once as it is.
    Rows that share an id share a hash and hence a fate.  Null sources form one source.
    """
    sizes, thresholds = mix_thresholds(docs, **how)
    edges = thresholds.withColumnRenamed("source", "of")
    joined = sizes.join(edges, F.col("source").eqNullSafe(F.col("of")))
    return joined.withColumn("copies", _copies()).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mix_documents(docs: DataFrame, **how) -> DataFrame:
    """The mixed documents themselves, each repeated as often as it is taken."""
    _, thresholds = mix_thresholds(docs, **how)
    edge_of = {c: f"__mix_{c}" for c in ("source", "whole", "edge", "with_edge")}
    edges = thresholds.select(*[F.col(c).alias(n) for c, n in edge_of.items()])
    below = (_cell() < F.col("__mix_edge")) | (
        (_cell() == F.col("__mix_edge")) & F.col("__mix_with_edge")
    )
    copies = F.col("__mix_whole") + F.when(below, 1).otherwise(0)
    joined = docs.join(edges, docs["source"].eqNullSafe(F.col("__mix_source")))
    repeated = joined.where(copies > 0).withColumn(
        "__mix_copy", F.explode(F.sequence(F.lit(1), copies))
    )
    return repeated.select(*[docs[c] for c in docs.columns])

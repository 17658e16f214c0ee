"""Exact dedup: 128-bit content hash, smallest id, bytes compared inside groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.llm.common import BLANKS, digest_of, text_of
from barstream.session import staged


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after each run of blanks became one space.  Rows
    are aggregated by (hash, text), so copies collapse before the shuffle and the
    bytes themselves decide: a hash shared by different texts yields several groups,
    and its rows are matched by text as well.  All other rows find their group by
    hash alone, which keeps texts out of the second shuffle.

    Null texts count as empty.  The smallest non-null id stays; where all ids of a
    group are null, so is ``keep_id``, and all its rows stay.  Rows that repeat the
    smallest id are the same document and all stay.  Other columns are not read.
    """
    body = F.regexp_replace(text_of(text_col), BLANKS, " ")
    rows = docs.select(F.col(id_col).alias("doc_id"), body.alias("body"))
    rows = rows.withColumn("digest", digest_of(F.col("body")))
    by_text = rows.groupBy("digest", "body").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    by_digest = staged(
        by_text.groupBy("digest").agg(
            F.count(F.lit(1)).alias("texts"),
            F.min("keep_id").alias("keep_id"),
            F.min("group_size").alias("group_size"),
        ),
        "exact-groups",
    )
    sole = by_digest.where("texts = 1").select("digest", "keep_id", "group_size")
    found = rows.select("doc_id", "digest", F.sha2("body", 256).alias("text_sha256")).join(
        sole, "digest"
    )
    clashes = by_digest.where("texts > 1").select("digest")
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    found = found.select(*columns)
    if not clashes.isEmpty():
        clashing = rows.join(clashes, "digest", "left_semi")
        classes = clashing.groupBy("digest", "body").agg(
            F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
        found = found.unionByName(
            clashing.withColumn("text_sha256", F.sha2("body", 256))
            .join(classes, ["digest", "body"])
            .select(*columns)
        )
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )

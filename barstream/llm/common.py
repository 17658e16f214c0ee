"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six blanks that separate words: space, tab, LF, VT, FF and CR.
BLANKS = r"[\x20\x09-\x0D]+"
NON_BLANKS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, a null one read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def digest_of(text: Column) -> Column:
    """128-bit content hash as 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def words_of(text: Column) -> Column:
    """The words between blanks, as an array without empty strings."""
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def id_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus

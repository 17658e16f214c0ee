"""Exact row numbers in a given order without a single-task window.

A plain ``row_number()`` sorts each window partition in one task, so one hot
bucket (or no bucket at all) puts most of the table on one executor.  Here the
rows are range-partitioned by bucket and order, which splits a hot bucket over as
many tasks as it needs; each task numbers its own rows, and only one small row
per (task, bucket) is summed up to shift those numbers into place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import staged

_AT = "_at"  # position: task number in the upper bits, row in task in the lower 33
_TASK = "_task"
_TASK_BITS = 33
_ROW_TAG = "_row_tag"


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    within: Sequence[str] = (),
    name: str = "row_index",
    unique: bool = True,
) -> DataFrame:
    """Add ``name``: the 0-based position of the row in its ``within`` bucket.

    Runs one job at once, as the placed rows are written to the shared folder:
    the counts and the numbers must come from the same placement, which sampled
    range bounds do not promise across two runs.

    ``within`` + ``order_by`` should identify a row.  If it does not, say
    ``unique=False``: the rows are then tagged and written first, so that any
    number of equal rows can still be split over tasks.
    """
    order = [*within, *order_by]
    if not unique:
        df = staged(df.withColumn(_ROW_TAG, F.monotonically_increasing_id()), "tagged")
        order.append(_ROW_TAG)
    placed = staged(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_AT, F.monotonically_increasing_id()),
        "placed",
    ).withColumn(_TASK, F.shiftright(_AT, _TASK_BITS))

    # One row per task and bucket: at most (tasks + buckets) rows in all.
    spans = placed.groupBy(_TASK, *within).agg(
        F.min(_AT).alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.partitionBy(*within).orderBy(_TASK).rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = spans.select(
        F.col(_TASK).alias("_span_task"),
        *[F.col(c).alias(f"_span_{c}") for c in within],
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    # Stored, so that its size is known when the join is planned: Spark broadcasts it
    # below its threshold, which spares the rows another shuffle, and shuffles beyond.
    shifts = staged(shifts, "shifts")
    same = F.col(_TASK) == F.col("_span_task")
    for c in within:
        same &= F.col(c).eqNullSafe(F.col(f"_span_{c}"))
    return (
        placed.join(shifts, same)
        .withColumn(name, F.col(_AT) + F.col("_shift"))
        .select(*[c for c in df.columns if c != _ROW_TAG], name)
    )


def with_batch_id(
    df: DataFrame,
    size: int = 100,
    order_by: Sequence[str] = (),
    within: Sequence[str] = (),
    dense_id: str | None = None,
    start: int = 0,
    unique: bool = True,
) -> DataFrame:
    """Add ``batch_id``: which group of ``size`` consecutive rows the row is in.

    Where ``dense_id`` names a gap-free number from 0 the batch is a division and
    needs no shuffle; otherwise the rows are numbered in ``order_by`` order.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    if dense_id is None:
        if not order_by:
            raise ValueError("give order_by or dense_id")
        df = number_rows(df, order_by, within, "_row_index", unique)
    batch = F.expr(f"`{dense_id or '_row_index'}` div {size}")
    return df.withColumn("batch_id", batch + F.lit(start)).drop("_row_index")

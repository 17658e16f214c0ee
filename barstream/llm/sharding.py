"""Sharding by Karmarkar-Karp differencing of indivisible groups."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barstream.llm.common import digest_of, text_of
from barstream.session import staged

#: Groups differenced in one task, partial partitions combined in one task, and
#: rows numbered in one window; each bounds a task, none changes what is sharded.
GROUPS_PER_TASK = 20_000
PARTS_PER_TASK = 4_096
ROWS_PER_WINDOW = 20_000


def differencing(sums: np.ndarray) -> np.ndarray:
    """Combine partial partitions: the final lane of each lane of each row.

    ``sums`` holds one partial partition per row, a total per lane.  The two rows
    with the largest spread are joined, the heavy lanes of one with the light lanes
    of the other, until one is left.  Lane maps are then resolved from the top.
    """
    n, k = sums.shape
    order = np.argsort(sums, axis=1, kind="stable")
    state = list(np.take_along_axis(sums, order, 1))
    heap = [(int(row[0] - row[-1]), i) for i, row in enumerate(state)]
    heapq.heapify(heap)
    merges = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        joined = state[a] + state[b][::-1]
        turn = np.argsort(joined, kind="stable")
        place = np.empty(k, np.int16)
        place[turn] = np.arange(k)
        merges.append((a, b, place))
        merged = joined[turn]
        state[a] = state[b] = None
        state.append(merged)
        heapq.heappush(heap, (int(merged[0] - merged[-1]), len(state) - 1))
    lanes: list = [None] * len(state)
    if state:
        lanes[-1] = np.arange(k, dtype=np.int16)
    for node in range(len(state) - 1, n - 1, -1):
        a, b, place = merges[node - n]
        lanes[a] = lanes[node][place]
        lanes[b] = lanes[node][place[::-1]]
        lanes[node] = None
    final = np.empty((n, k), np.int16)
    for i in range(n):
        final[i, order[i]] = lanes[i]
    return final


def _deal_groups(k: int):
    def deal(groups: pd.DataFrame) -> pd.DataFrame:
        groups = groups.sort_values("key").reset_index(drop=True)
        sums = np.zeros((len(groups), k), np.int64)
        sums[:, -1] = groups["weight"]
        groups["lane"] = differencing(sums)[:, -1].astype(np.int32)
        return groups

    return deal


def _deal_parts(parts: pd.DataFrame) -> pd.DataFrame:
    parts = parts.sort_values("node").reset_index(drop=True)
    sums = np.array(parts["sums"].tolist(), np.int64)
    lanes = differencing(sums)
    total = np.zeros(sums.shape[1], np.int64)
    np.add.at(total, lanes.ravel(), sums.ravel())
    parts["lanes"] = [x.astype(np.int32) for x in lanes]
    parts["total"] = [total if i == 0 else None for i in range(len(parts))]
    return parts[["node", "parent", "lanes", "total"]]


def _shard_of_lane(groups: DataFrame, chunks: int, k: int) -> DataFrame:
    """``chunk, lanes``: the shard of each lane of each chunk, level by level."""
    per_lane = [F.sum(F.when(F.col("lane") == i, F.col("weight")).otherwise(0)) for i in range(k)]
    nodes = groups.groupBy(F.col("chunk").alias("node")).agg(F.array(*per_lane).alias("sums"))
    steps = []
    while True:
        chunks = -(-chunks // PARTS_PER_TASK)
        step = staged(
            nodes.withColumn("parent", F.floor(F.col("node") / PARTS_PER_TASK))
            .groupBy("parent")
            .applyInPandas(
                _deal_parts, "node long, parent long, lanes array<int>, total array<long>"
            ),
            "shard-step",
        )
        steps.append(step)
        if chunks <= 1:
            break
        nodes = step.where("total is not null").select(
            F.col("parent").alias("node"), F.col("total").alias("sums")
        )
    found = steps.pop().select("node", "lanes")
    while steps:
        upper = found.select(F.col("node").alias("parent"), F.col("lanes").alias("upper"))
        found = steps.pop().join(upper, "parent").select(
            "node", F.transform("lanes", lambda x: F.get("upper", x)).alias("lanes")
        )
    return found.withColumnRenamed("node", "chunk")


def shard_documents(
    docs: DataFrame, shards: int = 24, overhead: int = 8, id_col="doc_id", text_col="text"
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per input row.

    Law ``bytes``: shards get near equal sizes (UTF-8 bytes of the text and
    ``overhead``), and rows of equal text, null counting as empty, stay together.
    The groups are dealt out in tasks of about ``GROUPS_PER_TASK`` by differencing;
    what each task has made is a partial partition in turn, and these are differenced
    over as many levels as it takes, so nothing is gathered whole.  A group larger
    than an equal share gets a shard that is larger by as much.

    Slots count from 0 in each shard.  Rows are numbered within small windows, and
    one row per window shifts the numbers into place, however hot a shard is.
    """
    body = text_of(text_col).cast("binary")
    rows = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            digest_of(text_of(text_col)).alias("key"),
            (F.octet_length(body) + overhead).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
        ),
        "shard-rows",
    )
    groups = staged(rows.groupBy("key").agg(F.sum("size").alias("weight")), "shard-groups")
    chunks = max(1, -(-groups.count() // GROUPS_PER_TASK))
    dealt = staged(
        groups.withColumn("chunk", F.pmod(F.xxhash64("key"), F.lit(chunks)))
        .groupBy("chunk")
        .applyInPandas(
            _deal_groups(shards), "key binary, weight long, chunk long, lane int"
        ),
        "shard-dealt",
    )
    lanes = _shard_of_lane(dealt, chunks, shards)
    shard_of = staged(
        dealt.join(lanes, "chunk").select("key", F.get("lanes", F.col("lane")).alias("shard")),
        "shard-of",
    )
    windows = max(1, -(-rows.count() // (shards * ROWS_PER_WINDOW)))
    part = F.pmod(F.xxhash64("doc_id", "key", F.lit("slot")), F.lit(windows))
    placed = staged(rows.join(shard_of, "key").withColumn("part", part), "shard-placed")
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(
        counts.select(
            "shard", "part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("start")
        ),
        "shard-starts",
    )
    local = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "key"))
    return (
        placed.withColumn("nth", local - 1)
        .join(starts, ["shard", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("start") + F.col("nth")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )

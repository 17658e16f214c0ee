"""Ranked lexical search by scanning documents with an Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barstream.llm.common import text_of
from barstream.session import staged

#: Bytes of item text whose terms share one automaton; more items take more passes.
PART_BYTES = 4 << 20
#: Cells of a scored block (documents times items).
CELLS = 1 << 20
#: Lanes in which the best of the tasks are first compared.
LANES = 256

#: Delimiters become spaces and A-Z small; bytes of other characters stay.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)

COUNTS = "doc_id long, n long, terms array<int>, tfs array<long>"
BEST = "item int, doc_id long, score long, lane int"


def folded(text: str | bytes) -> bytes:
    """The text with a space for every delimiter, lower-cased in A-Z."""
    raw = text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")
    return raw.translate(_FOLD)


def terms_of(text: str | None) -> list[bytes]:
    """The maximal runs of ASCII letters, digits and non-ASCII characters, in order."""
    return folded(text or "").split()


def automaton(terms: list[bytes]) -> ahocorasick.Automaton:
    """Finds whole terms: each is guarded by a space on both sides, which neighbours share."""
    built = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        built.add_word(f" {term.decode('utf-8', 'replace')} ", number)
    built.make_automaton()
    return built


def _scan(terms: list[bytes]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(terms) if terms else None
        for batch in batches:
            lengths, sizes, held, counts = [], [], [], []
            for value in batch.column("text"):
                text = folded(value.as_buffer().to_pybytes())
                lengths.append(len(text.split()))
                hits = np.zeros(0, np.int64)
                if found is not None and lengths[-1]:
                    text = f" {text.decode('utf-8', 'replace')} "
                    hits = np.fromiter((number for _, number in found.iter(text)), np.int64)
                numbers, tf = np.unique(hits, return_counts=True)
                sizes.append(len(numbers))
                held.append(numbers)
                counts.append(tf)
            bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            flat = lambda parts, kind: pa.array(np.concatenate([*parts, np.zeros(0, np.int64)]), kind)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(bounds, flat(held, pa.int32())),
                    pa.ListArray.from_arrays(bounds, flat(counts, pa.int64())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return run


class _Best:
    """The ``k`` best (score, then smaller id, null last) of each item seen so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.floor = np.ones(items, np.int64)
        self.kept = np.zeros((4, 0), np.int64)  # item, -score, id is null, id

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.floor)
        new = np.stack([item, -scores[doc, item], null[doc], ids[doc]])
        all_ = np.concatenate([self.kept, new], axis=1)
        all_ = all_[:, np.lexsort(all_[::-1])]
        counts = np.bincount(all_[0], minlength=len(self.floor))
        rank = np.arange(all_.shape[1]) - np.repeat(np.cumsum(counts) - counts, counts)
        full = all_[:, rank == self.k - 1]
        self.floor[full[0]] = -full[1]
        self.kept = all_[:, rank < self.k]


def _score(weights: np.ndarray, owners: list[np.ndarray], repeats: list[np.ndarray], items: int,
           total: int, tokens: int, k: int):
    """Per task the ``k`` best documents of each item.

    ``owners`` and ``repeats`` have, for each term, the items that hold it and how
    often; a document's terms spread over them, so nothing is done for items that
    share no term with it.
    """
    sizes = np.array([len(o) for o in owners], np.int64)
    starts = np.cumsum(sizes) - sizes
    owner, repeat = np.concatenate(owners), np.concatenate(repeats)
    at_once = max(1, CELLS // items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(items, k)
        for whole in batches:
            for first in range(0, whole.num_rows, at_once):
                batch = whole.slice(first, at_once)
                ids = batch.column("doc_id")
                terms = batch.column("terms")
                doc = np.repeat(np.arange(batch.num_rows), np.asarray(terms.value_lengths(), np.int64))
                term = np.asarray(terms.flatten(), np.int64)
                tf = np.asarray(batch.column("tfs").flatten(), np.int64)
                m = 25 + 75 * np.asarray(batch.column("n"), np.int64) * total // max(tokens, 1)
                value = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
                spread = sizes[term]
                ends = np.cumsum(spread)
                spots = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[term] - ends + spread, spread)
                sums = np.zeros(batch.num_rows * items, np.int64)
                np.add.at(
                    sums, np.repeat(doc, spread) * items + owner[spots], np.repeat(value, spread) * repeat[spots]
                )
                best.add(
                    sums.reshape(-1, items),
                    np.asarray(ids.fill_null(0), np.int64),
                    np.asarray(ids.is_null()).astype(np.int64),
                )
        item, score, null, doc_id = best.kept
        context = TaskContext.get()
        lane = (context.partitionId() if context else 0) % LANES
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(item, pa.int32()),
                pa.array(doc_id, pa.int64(), mask=null.astype(bool)),
                pa.array(-score, pa.int64()),
                pa.array(np.full(len(item), lane), pa.int32()),
            ],
            ["item", "doc_id", "score", "lane"],
        )

    return run


def _ranked(best: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each item: first within each lane of tasks, then over the lanes."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    laned = best.withColumn("rank", F.row_number().over(Window.partitionBy("item", "lane").orderBy(*order)))
    laned = laned.where(F.col("rank") <= k).drop("rank")
    ranked = laned.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def _search_part(texts: DataFrame, items: list, k: int) -> DataFrame | None:
    """The search for one part of the items, whose text fits ``PART_BYTES`` about."""
    postings: dict[bytes, dict[int, int]] = {}
    for number, item in enumerate(items):
        for text in sorted(item["texts"]):
            for term in terms_of(text):
                held = postings.setdefault(term, {})
                held[number] = held.get(number, 0) + 1
    if not postings:
        return None
    terms = sorted(postings)
    counted = staged(texts.mapInArrow(_scan(terms), COUNTS), "term-counts")
    total, tokens = counted.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2.0 * total + 2.0) / (2.0 * F.col("df") + 1.0)))
    weights = np.zeros(len(terms), np.int64)
    for row in df.select("term", weight.cast("long").alias("w")).collect():
        weights[row["term"]] = row["w"]
    owners = [np.array(list(postings[t]), np.int64) for t in terms]
    repeats = [np.array(list(postings[t].values()), np.int64) for t in terms]
    score = _score(weights, owners, repeats, len(items), total, tokens or 0, k)
    best = _ranked(counted.mapInArrow(score, BEST), k)
    spark = texts.sparkSession
    named = spark.createDataFrame(
        [(number, item["item_id"]) for number, item in enumerate(items)], "item int, item_id long"
    )
    return best.join(named, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item, by integer BM25.

    No index of the documents is made: one automaton of all item terms runs over the
    texts and leaves a list of term counts for each document.  Document frequencies
    and lengths are summed from those, and each task keeps the ``k`` best of each item,
    so a ranking moves ``k`` rows an item and task.  Items whose text exceeds
    ``PART_BYTES`` in all are dealt into parts by hash, each with its own automaton and
    pass, so what is sent to the tasks stays bounded; scores do not depend on parts.

    Only scores above 0 are ranked; equal ones by ascending id, null ids last.  Null and
    empty texts match nothing and are not counted.  Document rows that repeat an id
    are documents of their own.  Item rows with one id make one item, equal rows once.
    Items without a term, or tables without rows, give no row.  Extra columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").cast("binary").alias("text"))
    wanted = staged(
        items.select("item_id", text_of("text").alias("text"))
        .groupBy(F.col("item_id").cast("long").alias("item_id"))
        .agg(F.collect_set("text").alias("texts")),
        "search-items",
    )
    size = wanted.agg(F.sum(F.aggregate("texts", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t)))).first()[0]
    parts = 1 + (size or 0) // PART_BYTES
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for part in range(parts):
        own = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).orderBy("item_id").collect()
        found = _search_part(texts, own, k)
        out = out if found is None else found if parts == 1 else out.unionByName(found)
    return out

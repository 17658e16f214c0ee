"""Toxicity by nearest labelled examples: exact cosine of weighted TF-IDF, block-max index."""

from __future__ import annotations

import hashlib
import math
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstream.llm.common import text_of
from barstream.llm.quality import label_counts, labelled_sample

#: Labelled rows per class; they bound all that is fitted.
EXAMPLES = 4_000
BLOCK = 64
#: A term in more than one of so many examples is common; sums in short numbers are
#: within half of ``SHORT`` of the exact ones; so many queries go at once.
COMMON = 16
SHORT = 1e-4
AT_ONCE = 64
NEIGHBOURS = 15
EVIDENCE = 3
#: Texts whose result a task remembers; short ones and copies come again.
MEMORY = 1 << 16

_BLANK = bytes(
    b if chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" or b >= 128 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Words of letters and digits, lower-cased in A-Z."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_BLANK).split()


class BlockMaxIndex:
    """Inverted index over unit vectors with the largest weight of each block."""

    def __init__(self, vectors: Iterable[dict[bytes, float]]):
        self.terms: dict[bytes, int] = {}
        terms, docs, weights = array("l"), array("l"), array("d")
        self.size = 0
        for vector in vectors:
            for term, weight in vector.items():
                terms.append(self.terms.setdefault(term, len(self.terms)))
                docs.append(self.size)
                weights.append(weight)
            self.size += 1
        at = np.frombuffer(terms, np.int64) if terms else np.zeros(0, np.int64)
        order = np.argsort(at, kind="stable")
        self.docs = np.array(docs, np.int64)[order]
        self.weights = np.array(weights, np.float64)[order]
        self.counts = np.bincount(at, minlength=len(self.terms))
        self.starts = np.cumsum(self.counts) - self.counts
        self.blocks = -(-self.size // BLOCK)
        # Terms of many examples as dense columns, also in short numbers.
        common = np.flatnonzero(self.counts * COMMON > self.size)
        self.column = np.full(len(self.terms), -1, np.int64)
        self.column[common] = np.arange(len(common))
        self.dense = np.zeros((self.blocks * BLOCK, len(common)))
        for i, t in enumerate(common):
            held = slice(self.starts[t], self.starts[t] + self.counts[t])
            self.dense[self.docs[held], i] = self.weights[held]
        self.short = self.dense.T.astype(np.float32)

    def nearest(self, query: dict[bytes, float], k: int) -> list[tuple[float, int]]:
        """The ``k`` largest positive cosines as (cosine, position), ties by position."""
        return self.nearest_of([query], k)[0]

    def nearest_of(self, queries: list[dict[bytes, float]], k: int) -> list[list[tuple[float, int]]]:
        """``nearest`` of each query."""
        found = [[(self.terms[t], w) for t, w in query.items() if t in self.terms] for query in queries]
        return self.nearest_to([(np.array([t for t, _ in f], np.int64), np.array([w for _, w in f])) for f in found], k)

    def nearest_to(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list[tuple[float, int]]]:
        """``nearest`` of each query, given by the numbers of its terms in the index and their weights.

        The common terms are added in short numbers, all queries at once.  A block is
        opened only where its largest sum, and an example is only added up exactly
        where its own sum, reaches the ``k``-th largest within ``SHORT``.
        """
        padded = self.blocks * BLOCK
        if not self.size:
            return [[] for _ in queries]
        heavy = np.zeros((len(queries), self.dense.shape[1]))
        rare = np.zeros((len(queries), padded))
        for i, (at, weight) in enumerate(queries):
            column = self.column[at]
            common = column >= 0
            heavy[i, column[common]] = weight[common]
            at, weight = at[~common], weight[~common]
            counts = self.counts[at]
            ends = np.cumsum(counts)
            spots = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at] - ends + counts, counts)
            added = self.weights[spots] * np.repeat(weight, counts)
            rare[i] = np.bincount(self.docs[spots], weights=added, minlength=padded)
        sums = heavy.astype(np.float32) @ self.short
        sums += rare
        tops = sums.reshape(len(queries), self.blocks, BLOCK).max(2)
        out = []
        for i in range(len(queries)):
            least = np.partition(tops[i], self.blocks - k)[self.blocks - k] if k < self.blocks else 0.0
            opened = np.flatnonzero(tops[i] >= least - SHORT)
            left = (opened[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            if k < len(left):
                least = np.partition(sums[i, left], len(left) - k)[len(left) - k]
                left = left[sums[i, left] >= least - SHORT]
            left = left[sums[i, left] > 0]
            columns = np.flatnonzero(heavy[i])
            exact = rare[i, left] + (self.dense[left[:, None], columns] * heavy[i, columns]).sum(1)
            exact = np.round(exact, 12)
            left, exact = left[exact > 0], exact[exact > 0]
            best = np.lexsort((left, -exact))[:k]
            out.append([(float(exact[j]), int(left[j])) for j in best])
        return out


def relevance(examples) -> dict[bytes, float]:
    """One and chi-square of each term's presence and the label.

    It weighs terms and drops none: by TF-IDF alone the many words that say nothing
    about the label decide which example is near.
    """
    held, n = (Counter(), Counter()), [0, 0]
    for _, label, tf in examples:
        held[label].update(tf.keys())
        n[label] += 1
    weights, total = {}, sum(n)
    for term in held[0].keys() | held[1].keys():
        a, b = held[1][term], held[0][term]
        below = (a + b) * (total - a - b) * n[0] * n[1]
        cross = a * (n[0] - b) - b * (n[1] - a)
        weights[term] = 1 + (total * cross * cross / below if below else 0.0)
    return weights


class Examples:
    """``(doc_id, label, terms and their counts)`` in order, unpacked one at a time."""

    def __init__(self, rows: list[tuple[int, int, bytes, bytes]]):
        self.rows = rows

    def __iter__(self) -> Iterator[tuple[int, int, dict[bytes, int]]]:
        for doc_id, label, terms, counts in self.rows:
            yield doc_id, label, dict(zip(terms.split(), np.frombuffer(counts, np.int64).tolist()))


class ToxicityModel:
    """Examples with their labels and index, term weights, and the base rates."""

    def __init__(self, examples, idf: dict[bytes, float], counts: tuple[int, int]):
        sample = Counter(label for _, label, _ in examples)
        self.stands = [counts[v] / max(1, sample[v]) for v in (0, 1)]
        self.prior = (counts[1] + 0.5) / (sum(counts) + 1)
        self.ids, self.labels, blank = [], [], [0.0, 0.0]

        def vectors() -> Iterator[dict[bytes, float]]:
            for doc_id, label, tf in examples:
                weights = {t: (1 + math.log(n)) * idf[t] for t, n in tf.items() if t in idf}
                norm = math.sqrt(sum(w * w for w in weights.values()))
                if norm:
                    self.ids.append(doc_id)
                    self.labels.append(label)
                    yield {t: w / norm for t, w in weights.items()}
                else:
                    blank[label] += self.stands[label]

        self.index = BlockMaxIndex(vectors())
        self.idf = np.fromiter((idf[t] for t in self.index.terms), np.float64, len(self.index.terms))
        self.blank = (blank[1] + self.prior) / (sum(blank) + 1)

    def vectors(self, texts: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The numbers and weights of the known terms of each text; each term is looked up once."""
        number, tfs = self.index.terms.get, [Counter(words) for words in texts]
        sizes = [len(tf) for tf in tfs]
        at = np.fromiter((number(t, -1) for tf in tfs for t in tf), np.int64, sum(sizes))
        times = np.fromiter((n for tf in tfs for n in tf.values()), np.int64, sum(sizes))
        known = at >= 0
        weights = (1 + np.log(times)) * np.where(known, self.idf[at], 0.0) if len(self.idf) else np.zeros(len(at))
        out, end = [], 0
        for size in sizes:
            part = slice(end, end + size)
            end += size
            held = known[part]
            weight = weights[part][held]
            out.append((at[part][held], weight / math.sqrt(weight @ weight) if len(weight) else weight))
        return out

    def score_of(self, texts: list[list[bytes]]) -> list[tuple[float, list[tuple[int, float, int]]]]:
        """By the terms of each text: the share of toxic votes, weighted by squared cosine, and the nearest examples."""
        near = []
        for i in range(0, len(texts), AT_ONCE):
            near += self.index.nearest_to(self.vectors(texts[i : i + AT_ONCE]), NEIGHBOURS)
        return [self.vote(n) for n in near]

    def vote(self, near: list[tuple[float, int]]) -> tuple[float, list[tuple[int, float, int]]]:
        if not near:
            return self.blank, []
        votes = [self.prior, 1.0]
        for cosine, at in near:
            weight = cosine * cosine * self.stands[self.labels[at]]
            votes[0] += weight * self.labels[at]
            votes[1] += weight
        evidence = [(self.ids[at], cosine, self.labels[at]) for cosine, at in near[:EVIDENCE]]
        return votes[0] / votes[1], evidence


def _document_frequencies(docs: DataFrame, terms: set[bytes]) -> tuple[int, dict[bytes, int]]:
    """How many of all documents hold each term; one small row per term and task moves."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = Counter(), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(terms.intersection(terms_of(text)))
                total += 1
        found = {b" ": total, **found}
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array(list(found), pa.binary()), "n": pa.array(list(found.values()), pa.int64())}
        )

    rows = docs.select("text").mapInArrow(count, "term binary, n long")
    rows = rows.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    found = dict(zip(*(c.to_pylist() for c in rows.columns)))
    return found.pop(b" ", 0), found


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, allowed: Column, examples: int = EXAMPLES
) -> ToxicityModel:
    """Fit on at most ``examples`` labelled documents per class for which ``allowed`` holds.

    The vocabulary are all terms of the examples; their document frequencies are those
    of the whole corpus.  Both are bounded by the examples and go to the tasks.
    """
    sample = labelled_sample(labels, "toxic", allowed, examples)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels_, texts = (c.to_pylist() for c in batch.columns)
            tfs = [Counter(terms_of(text)) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(labels_, pa.int32()),
                    pa.array([b" ".join(tf) for tf in tfs], pa.binary()),
                    pa.array([np.array(list(tf.values()), np.int64).tobytes() for tf in tfs], pa.binary()),
                ],
                names=["doc_id", "label", "terms", "counts"],
            )

    rows = texts.join(sample, "doc_id").select("doc_id", "label", "text")
    rows = rows.mapInArrow(count, "doc_id long, label int, terms binary, counts binary")
    rows = rows.orderBy("doc_id").limit(4 * examples).toArrow()
    found = Examples(list(zip(*(c.to_pylist() for c in rows.columns))))
    weights = relevance(found)
    if not weights:
        return ToxicityModel([], {}, label_counts(labels, "toxic", allowed))
    total_docs, held = _document_frequencies(docs, set(weights))
    idf = {t: w * (1 + math.log((1 + total_docs) / (1 + held.get(t, 0)))) for t, w in weights.items()}
    return ToxicityModel(found, idf, label_counts(labels, "toxic", allowed))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score, predicted, evidence`` for every input row.

    ``evidence`` lists the nearest examples: their id, cosine and label.  Null texts
    count as empty; a text without any known term gets the rate of such examples.
    """
    schema = "doc_id long, score double, evidence array<struct<doc_id:long,cosine:double,toxic:int>>"
    kind = pa.list_(
        pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())])
    )
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[bytes, tuple] = {}
        for batch in batches:
            ids, texts = batch.columns
            scores, evidence, texts = [], [], texts.to_pylist()
            for i in range(0, len(texts), AT_ONCE):
                part = texts[i : i + AT_ONCE]
                keys = [hashlib.md5((t or "").encode("utf-8", "surrogatepass")).digest() for t in part]
                if len(memory) >= MEMORY:
                    memory.clear()
                new = {key: text for key, text in zip(keys, part) if key not in memory}
                memory.update(zip(new, model.score_of([terms_of(t) for t in new.values()])))
                for rate, near in map(memory.get, keys):
                    scores.append(rate)
                    evidence.append([{"doc_id": d, "cosine": c, "toxic": v} for d, c, v in near])
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(scores, pa.float64()), pa.array(evidence, kind)],
                names=["doc_id", "score", "evidence"],
            )

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, schema)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

"""Quality classifier: Bradley-Terry scores learnt from preference pairs."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstream.operators.numbering import number_rows
from barstream.session import staged

ACCEPT = 0.7
#: Half the labelled rows of a block, and pairs drawn in it: bounds of a task, not of the fit.
EXAMPLES = 4_000
PAIRS = 40_000

_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LOWER = np.zeros(256, bool)
_LOWER[ord("a") : ord("z") + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[33:48] = _SYMBOL[58:65] = _SYMBOL[91:97] = _SYMBOL[123:127] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:'\"-()"]] = True


def features(text: str | None) -> list[float]:
    """What a whole text looks like: shares of kinds of characters, words and lines."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = max(1, len(raw))
    words = raw.split()
    n = max(1, len(words))
    odd = int(counts[_SYMBOL & ~_STOP].sum())
    upper, lower = int(counts[_UPPER].sum()), int(counts[_LOWER].sum())
    kinds = Counter(words)
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [
        upper / max(1, upper + lower),
        np.sqrt(upper / max(1, upper + lower)),
        odd / n,
        np.sqrt(odd / n),
        kinds.get(b"|", 0) / n,
        np.sqrt(kinds.get(b"|", 0) / n),
        raw.count(b"!!") / n,
        repeats / n,
        np.sqrt(repeats / n),
        (kinds.most_common(1)[0][1] if kinds else 0) / n,
        len(kinds) / n,
        np.log1p(len(words)),
        min(30.0, len(raw) / n),
        int(counts[_DIGIT].sum()) / size,
        int(counts[_STOP].sum()) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(n / max(1, len(lines))),
        float(not words),
    ]


@dataclass(frozen=True)
class Ranking:
    """Weights of standardised features, and the score at the accepted quantile."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -10, 10)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.standard(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; exactly at the threshold it is ``ACCEPT``."""
        z = self.raw(x) - self.threshold + np.log(ACCEPT / (1 - ACCEPT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

    def score_of(self, text: Column) -> Column:
        @F.pandas_udf("double")
        def of(texts: pd.Series) -> pd.Series:
            if not len(texts):
                return pd.Series([], dtype="float64")
            return pd.Series(self.score(np.array([features(t) for t in texts])))

        return of(text)


def _blocks(rows: DataFrame, sizes: tuple[int, int], count: int) -> DataFrame:
    """``block, x, y``: the rows dealt to ``count`` blocks, each of which has both labels.

    A label with fewer rows than blocks is there in every block, its rows in turn.
    """
    placed = number_rows(rows, ["doc_id"], ["label"], name="place", unique=False)
    held = F.when(F.col("label") == 1, sizes[1]).otherwise(sizes[0]).cast("long")
    turns = F.sequence("place", F.lit(count - 1).cast("long"), held)
    block = F.when(held >= count, F.array(F.col("place") % count)).otherwise(turns)

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "place"])
        x, y = np.array(rows["x"].tolist(), float), rows["label"].to_numpy(np.int64)
        return pd.DataFrame({"block": rows["block"].iloc[:1], "x": [x.tobytes()], "y": [y.tobytes()]})

    dealt = placed.withColumn("block", F.explode(block)).repartition(count, "block")
    return dealt.groupBy("block").applyInPandas(packed, "block long, x binary, y binary")


def _newton_sums(blocks: DataFrame, ranking: Ranking, pairs: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Pairs, gradient and Hessian of their logistic loss, summed over all blocks."""
    k = len(ranking.weights)

    def add(batches):
        total, gradient, hessian = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for block, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                y = np.frombuffer(y, np.int64)
                z = ranking.standard(np.frombuffer(x, np.float64).reshape(len(y), k))
                rng = np.random.default_rng(7 + block)
                good, bad = (rng.choice(np.flatnonzero(y == v), pairs) for v in (1, 0))
                d = z[good] - z[bad]
                p = 1 / (1 + np.exp(np.clip(d @ ranking.weights, -500, 500)))
                total += pairs
                gradient -= d.T @ p
                hessian += (d * (p * (1 - p))[:, None]).T @ d
        sums = np.concatenate([[total], gradient, hessian.ravel()])
        yield pa.RecordBatch.from_pydict({"sums": pa.array([sums.tolist()], pa.list_(pa.float64()))})

    sums = sum(np.array(r.sums) for r in blocks.mapInArrow(add, "sums array<double>").collect())
    return int(sums[0]), sums[1 : k + 1], sums[k + 1 :].reshape(k, k)


def fit_pairs(rows: DataFrame, examples: int = EXAMPLES, ridge: float = 1e-2) -> Ranking:
    """Fit on all ``rows``: ``doc_id, label, x``.

    They are dealt to blocks of about ``2 * examples``; in each, ``PAIRS`` pairs of a
    label-1 and a label-0 row are drawn with a fixed seed, and Newton steps minimise the
    logistic loss on the feature differences of all blocks' pairs.  So the pairs grow
    with the rows; means, spreads and the threshold are exact over all rows.  The
    threshold is the quantile of scores that matches the share of label 0, in the
    middle of the gap there.  Without both labels nothing is preferred and every text
    scores ``ACCEPT``.
    """
    k = len(features(""))
    found = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    sizes = found.get(0, 0), found.get(1, 0)
    if not all(sizes):
        return Ranking(np.zeros(k), np.ones(k), np.zeros(k), 0.0)
    moments = [f(F.col("x")[i]) for f in (F.avg, F.stddev_pop) for i in range(k)]
    mean, spread = np.array(rows.agg(*moments).first(), float).reshape(2, k)
    scale = np.where(spread > 1e-9, spread, 1.0)
    blocks = staged(_blocks(rows, sizes, -(-sum(sizes) // (2 * examples))), "pair-blocks")
    ranking = Ranking(mean, scale, np.zeros(k), 0.0)
    for _ in range(30):
        pairs, gradient, hessian = _newton_sums(blocks, ranking, PAIRS)
        w = ranking.weights
        step = np.linalg.solve(hessian / pairs + ridge * np.eye(k), gradient / pairs + ridge * w)
        ranking = Ranking(mean, scale, w - step, 0.0)
        if np.abs(step).max() < 1e-6:
            break

    @F.pandas_udf("double")
    def raw_of(x: pd.Series) -> pd.Series:
        return pd.Series(ranking.raw(np.array(x.tolist(), float).reshape(len(x), k)))

    ranks = number_rows(rows.select(raw_of("x").alias("raw")), ["raw"], name="rank", unique=False)
    middle = ranks.where(F.col("rank").isin(sizes[0] - 1, sizes[0])).agg(F.avg("raw")).first()[0]
    return Ranking(mean, scale, ranking.weights, float(middle))


def labelled_rows(labels: DataFrame, label: str, allowed: Column) -> DataFrame:
    """``doc_id, label`` of all allowed documents that have a label, 0 or 1.

    A doc that is labelled more than once counts as 1 if any label is 1; null ids and
    labels are no examples.
    """
    rows = labels.where(allowed & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    return rows.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label")).where("label IN (0, 1)")


def labelled_sample(labels: DataFrame, label: str, allowed: Column, examples: int) -> DataFrame:
    """``doc_id, label``: per class the ``examples`` allowed ids of the smallest hash."""
    one = labelled_rows(labels, label, allowed).withColumn("turn", F.xxhash64("doc_id"))
    picked = [
        one.where(F.col("label") == value).orderBy("turn", "doc_id").limit(examples)
        for value in (0, 1)
    ]
    return staged(picked[0].unionByName(picked[1]).select("doc_id", "label"), "labelled")


def label_counts(labels: DataFrame, label: str, allowed: Column) -> tuple[int, int]:
    """How many documents of label 0 and 1 the sample stands for."""
    one = labelled_rows(labels, label, allowed)
    found = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    return found.get(0, 0), found.get(1, 0)


def fit_quality(
    docs: DataFrame, labels: DataFrame, allowed: Column, examples: int = EXAMPLES
) -> Ranking:
    """Fit on every labelled document for which ``allowed`` holds.

    The features are taken before the join, so that no text is shuffled.
    """

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    described = docs.where(allowed).select("doc_id", of("text").alias("x"))
    rows = described.join(labelled_rows(labels, "quality", allowed), "doc_id")
    return fit_pairs(staged(rows, "labelled-features"), examples)


def score_quality(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """``doc_id, score, predicted`` for every input row; null texts count as empty."""
    scored = docs.select("doc_id", ranking.score_of(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def keep_quality(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """The documents that score ``ACCEPT`` or more; all columns as they came."""
    return docs.where(ranking.score_of(docs["text"]) >= ACCEPT)

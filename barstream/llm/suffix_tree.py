"""Language-model scoring with a probabilistic suffix tree over words."""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstream.session import staged

#: Text put into one block, and entries summed up in one bucket: they bound the
#: memory of tasks and have no influence on counts.
BLOCK_BYTES = 4 << 20
ENTRIES_PER_BUCKET = 500_000

#: The tree: a context is examined if it holds this share of all training tokens, so
#: there are at most ``1 / SHARE`` of each length; it is retained if it predicts by so
#: many nats better; and it is at most so many words long.
SHARE = 2e-4
GAIN = 10.0
DEPTH = 2
DISCOUNT = 0.8

#: A token that no word can be; it ends every text.
END = b"\n"
_MIX = np.uint64(0x9E3779B97F4A7C15)

BLOCKS = "block string, doc_ids binary, known_ids binary, held binary, lengths binary, codes binary, hashes binary, different long"
PARTS = "bucket long, block string, ctx binary, hashes binary, n binary"
RESULTS = "kind string, block string, bucket long, ctx binary, hashes binary, n binary, gains binary, kinds binary"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(", "))])


@dataclass(frozen=True)
class Level:
    """The contexts of one length, by index: the context and word they consist of
    (``prior``, ``hashes``), their suffix one word shorter (``parent``), and their
    totals, numbers of different next words and whether they are retained."""

    prior: np.ndarray
    hashes: np.ndarray
    parent: np.ndarray
    total: np.ndarray
    kinds: np.ndarray
    kept: np.ndarray


def tokens_of(text: str | None) -> list[bytes]:
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def _key(ctx: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return hashes ^ (ctx.astype(np.uint64) * _MIX)


def encode(docs: DataFrame, held_out: Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of texts as codes into the block's own list of word hashes (64 bits)."""
    schema = _schema(BLOCKS)

    def pack(rows) -> pa.RecordBatch:
        codes: dict[bytes, int] = {}
        coded = [np.array([codes.setdefault(w, len(codes)) for w in words], np.int32) for _, _, words in rows]
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in codes), np.uint64, len(codes))
        row = {
            "block": uuid.uuid4().hex,
            "doc_ids": np.array([r[0] or 0 for r in rows], np.int64).tobytes(),
            "known_ids": np.array([r[0] is not None for r in rows]).tobytes(),
            "held": np.array([r[1] for r in rows], bool).tobytes(),
            "lengths": np.array([len(x) for x in coded], np.int32).tobytes(),
            "codes": zlib.compress(np.concatenate(coded).tobytes(), 1),
            "hashes": hashes.tobytes(),
            "different": len(codes),
        }
        return pa.RecordBatch.from_pylist([row], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            ids, helds, texts = batch.columns
            for doc_id, held, text in zip(ids.to_pylist(), helds.to_pylist(), texts):
                text = text.as_py()
                rows.append((doc_id, held, tokens_of(text)))
                size += len(text or "")
                if size >= block_bytes:
                    yield pack(rows)
                    rows, size = [], 0
        if rows:
            yield pack(rows)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held"), "text")
    return staged(rows.mapInArrow(run, BLOCKS), "lm-blocks")


class _Block:
    """A block opened: its tokens, whose they are, and the context of each by length."""

    def __init__(self, row: dict, levels: list[Level]):
        self.hashes = np.frombuffer(row["hashes"], np.uint64)
        self.codes = np.frombuffer(zlib.decompress(row["codes"]), np.int32)
        self.lengths = np.frombuffer(row["lengths"], np.int32).astype(np.int64)
        self.held = np.frombuffer(row["held"], bool)
        self.trains = np.repeat(~self.held, self.lengths)
        starts = np.cumsum(self.lengths) - self.lengths
        first = np.zeros(len(self.codes), bool)
        first[starts[self.lengths > 0]] = True
        self.contexts = [np.zeros(len(self.codes), np.int32)]
        order = np.argsort(self.hashes)
        width = len(self.hashes)
        for level in levels:
            at = np.searchsorted(self.hashes, level.hashes, sorter=order)
            code = order[np.minimum(at, width - 1)] if width else at
            here = np.flatnonzero(self.hashes[code] == level.hashes) if width else at[:0]
            wanted = level.prior[here] * width + code[here]
            turn = np.argsort(wanted)
            wanted, index = wanted[turn], here[turn]
            before = self.contexts[-1][:-1].astype(np.int64)
            asked = np.full(len(first), -1, np.int64)
            asked[1:] = before * width + self.codes[:-1]
            asked[1:][before < 0] = -1
            asked[first] = -1
            found = np.full(len(asked), -1, np.int32)
            if len(wanted):
                spot = np.minimum(np.searchsorted(wanted, asked), len(wanted) - 1)
                hit = wanted[spot] == asked
                found[hit] = index[spot[hit]]
            self.contexts.append(found)

    def grams(self, length: int):
        """(positions, inverse, ctx, hashes, training counts) of the block's different grams."""
        ctx = self.contexts[length]
        where = np.flatnonzero(ctx >= 0)
        grams = ctx[where].astype(np.int64) * len(self.hashes) + self.codes[where]
        keys, inverse = np.unique(grams, return_inverse=True)
        n = np.bincount(inverse, weights=self.trains[where], minlength=len(keys)).astype(np.int64)
        width = max(1, len(self.hashes))
        return where, inverse, keys // width, self.hashes[keys % width], n


def _buckets(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def _send(blocks: DataFrame, levels: list[Level], length: int, buckets: int) -> DataFrame:
    """The different grams of every block, cut by the bucket of their last word."""
    schema = _schema(PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, _, ctx, hashes, n = _Block(row, levels).grams(length)
                bucket = _buckets(hashes, buckets)
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) > 0]) if len(order) else []
                rows = []
                for a, b in zip(cuts, [*cuts[1:], len(order)]):
                    part = order[a:b]
                    rows.append(
                        {
                            "bucket": int(bucket[part[0]]),
                            "block": row["block"],
                            "ctx": ctx[part].astype(np.int32).tobytes(),
                            "hashes": hashes[part].tobytes(),
                            "n": n[part].astype(np.int32).tobytes(),
                        }
                    )
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return blocks.select("block", "held", "lengths", "codes", "hashes").mapInArrow(run, PARTS)


@dataclass(frozen=True)
class Base:
    """Training tokens and different ones: the add-one model at the root."""

    total: int
    kinds: int

    def p(self, c: np.ndarray) -> np.ndarray:
        return (c + 1) / (self.total + self.kinds + 1)


def smoothed(level: Level, ctx: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """P(word | context): counts less a discount, which goes to the shorter context's ``p``."""
    total, kinds = level.total[ctx], level.kinds[ctx]
    own = (np.maximum(n - DISCOUNT, 0) + np.minimum(DISCOUNT * kinds, total) * p) / np.maximum(total, 1)
    return np.where(level.kept[ctx], own, p)


def _look_up(table, ctx: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    keys, n = table
    if not len(keys):
        return np.zeros(len(ctx), np.int64)
    asked = _key(ctx, hashes)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, n[at], 0)


def _shorter_p(tables, levels: list[Level], base: Base, ctx: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """P(word | suffix of the context that is one word shorter), within one bucket."""
    chain = [ctx]
    for level in reversed(levels):
        chain.insert(0, level.parent[chain[0]])
    p = base.p(_look_up(tables[0], chain[0], hashes))
    for level, table, at in zip(levels[:-1], tables[1:], chain[1:-1]):
        p = smoothed(level, at, _look_up(table, at, hashes), p)
    return p


def _sum_up(parts: DataFrame, tables: list[DataFrame], levels: list[Level], base: Base | None) -> DataFrame:
    """Per bucket: the total of every gram, sent back to the blocks that asked for it
    (``answer``), as a table of the bucket (``table``), and by context (``sums``)."""
    schema = _schema(RESULTS)
    known = [
        t.where("kind = 'table'").select(
            F.col("bucket").alias("of"), F.lit(i).cast("long").alias("level"), "ctx", "hashes", "n"
        )
        for i, t in enumerate(tables)
    ]

    def run(left: pa.Table, right: pa.Table | None) -> pa.Table:
        rows = left.to_pylist()
        if not rows:
            return schema.empty_table()
        join = lambda name, kind: np.concatenate([np.frombuffer(r[name], kind) for r in rows])
        ctx, hashes, n = join("ctx", np.int32).astype(np.int64), join("hashes", np.uint64), join("n", np.int32)
        keys, first, inverse = np.unique(_key(ctx, hashes), return_index=True, return_inverse=True)
        total = np.bincount(inverse, weights=n, minlength=len(keys)).astype(np.int64)
        answers, cut = total[inverse], 0
        bucket, out = rows[0]["bucket"], []
        for r in rows:
            size = len(r["ctx"]) // 4
            out.append({"kind": "answer", "block": r["block"], "bucket": bucket, "n": answers[cut : cut + size].tobytes()})
            cut += size
        seen = np.flatnonzero(total > 0)
        c, h, m = ctx[first[seen]], hashes[first[seen]], total[seen]
        out.append({"kind": "table", "bucket": bucket, "ctx": c.astype(np.int32).tobytes(), "hashes": h.tobytes(), "n": m.tobytes()})
        if base is None:
            gains = np.zeros(len(m))
        else:
            stored = {}
            for r in right.to_pylist():
                k = _key(np.frombuffer(r["ctx"], np.int32).astype(np.int64), np.frombuffer(r["hashes"], np.uint64))
                order = np.argsort(k)
                stored[r["level"]] = k[order], np.frombuffer(r["n"], np.int64)[order]
            none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            p = _shorter_p([stored.get(i, none) for i in range(len(levels))], levels, base, c, h)
            gains = m * np.log(m / p)
        which, at = np.unique(c, return_inverse=True)
        add = lambda w: np.bincount(at, weights=w, minlength=len(which))
        out.append(
            {
                "kind": "sums",
                "bucket": bucket,
                "ctx": which.astype(np.int32).tobytes(),
                "n": add(m).astype(np.int64).tobytes(),
                "gains": add(gains).tobytes(),
                "kinds": add(np.ones(len(m))).astype(np.int64).tobytes(),
            }
        )
        return pa.Table.from_pylist(out, schema=schema)

    grouped = parts.groupBy("bucket")
    if not known:
        return staged(grouped.applyInArrow(lambda t: run(t, None), RESULTS), "lm-level")
    tables_of = known[0]
    for t in known[1:]:
        tables_of = tables_of.unionByName(t)
    return staged(grouped.cogroup(tables_of.groupBy("of")).applyInArrow(run, RESULTS), "lm-level")


def _context_sums(results: DataFrame) -> dict[int, tuple[int, float, int]]:
    """ctx -> (total, gain sum, kinds).  One row per context examined, so bounded."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(r["ctx"], np.int32).astype(np.int64)),
                        pa.array(np.frombuffer(r["n"], np.int64)),
                        pa.array(np.frombuffer(r["gains"], np.float64)),
                        pa.array(np.frombuffer(r["kinds"], np.int64)),
                    ],
                    names=["ctx", "n", "gain", "kinds"],
                )

    sums = results.where("kind = 'sums'").select("ctx", "n", "gains", "kinds")
    rows = sums.mapInArrow(unpack, "ctx long, n long, gain double, kinds long")
    rows = rows.groupBy("ctx").agg(F.sum("n"), F.sum("gain"), F.sum("kinds")).collect()
    return {r[0]: (r[1], r[2], r[3]) for r in rows}


def _frequent(results: DataFrame, least: float) -> list[tuple[int, int]]:
    """(ctx, word hash as signed) of the grams with ``least`` occurrences or more.

    There are at most ``1 / SHARE`` of them.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                often = np.frombuffer(r["n"], np.int64) >= max(least, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(r["ctx"], np.int32).astype(np.int64)[often]),
                        pa.array(np.frombuffer(r["hashes"], np.int64)[often]),
                    ],
                    names=["ctx", "hash"],
                )

    tables = results.where("kind = 'table'").select("ctx", "hashes", "n")
    rows = tables.mapInArrow(unpack, "ctx long, hash long").orderBy("ctx", "hash").collect()
    end = int(np.array([xxhash.xxh64_intdigest(END)], np.uint64).view(np.int64)[0])
    return [(r["ctx"], r["hash"]) for r in rows if r["hash"] != end]


def _grow(results: DataFrame, levels: list[Level], base: Base, share: float) -> Level:
    """The contexts one word longer than the last: frequent grams, with their suffixes."""
    grams = _frequent(results, share * base.total)
    prior = np.array([c for c, _ in grams], np.int64)
    hashes = np.array([h for _, h in grams], np.int64).view(np.uint64)
    if levels:
        last = levels[-1]
        index = {(int(p), int(h)): i for i, (p, h) in enumerate(zip(last.prior, last.hashes))}
        suffix = last.parent[prior]
        parent = np.array([index[int(s), int(h)] for s, h in zip(suffix, hashes)], np.int64)
    else:
        parent = np.zeros(len(grams), np.int64)
    none = np.zeros(len(grams), np.int64)
    return Level(prior, hashes, parent, none, none, none > 0)


def score_texts(
    docs: DataFrame,
    held_out: Column,
    share: float = SHARE,
    gain: float = GAIN,
    depth: int = DEPTH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row.

    Learns from the rows for which ``held_out`` is false.  A text is its words,
    lower-cased in A-Z, and an end.  The root of the tree is the add-one model over
    words.  Contexts grow from it a word at a time: those that hold ``share`` of the
    training tokens are examined, and one is retained if its next-word distribution
    predicts the training text by ``gain`` nats more than its suffix does.  A word is
    scored in the longest retained suffix of what precedes it in the text, smoothed
    by absolute discounting towards the shorter ones.

    Each block of texts sends a gram once, however often it occurs there; grams are
    summed up in buckets by their last word, and the sums return to the blocks that
    asked.  Only the contexts, bounded by ``1 / share`` a length, pass the driver.  All
    texts are counted whole.  Null texts count as empty.
    """
    blocks = encode(docs, held_out, block_bytes)
    entries = blocks.agg(F.sum("different")).first()[0] or 0
    buckets = max(8, -(-entries // ENTRIES_PER_BUCKET))
    results = [_sum_up(_send(blocks, [], 0, buckets), [], [], None)]
    total, _, kinds = _context_sums(results[0]).get(0, (0, 0.0, 0))
    base, levels = Base(total, kinds), []
    for length in range(1, depth + 1):
        level = _grow(results[-1], levels, base, share)
        if not len(level.prior):
            break
        parts = _send(blocks, [*levels, level], length, buckets)
        results.append(_sum_up(parts, results, [*levels, level], base))
        sums = _context_sums(results[-1])
        n, k, kept = (np.zeros(len(level.prior), t) for t in (np.int64, np.int64, bool))
        for ctx, (count, against, different) in sums.items():
            n[ctx], k[ctx] = count, different
            kept[ctx] = count > 0 and against - count * math.log(count) >= gain
        levels.append(Level(level.prior, level.hashes, level.parent, n, k, kept))
    return _apply(blocks, results, levels, base, buckets)


def _apply(blocks: DataFrame, results: list[DataFrame], levels: list[Level], base: Base, buckets: int):
    answers = None
    for i, result in enumerate(results):
        own = result.where("kind = 'answer'").select(
            F.col("block").alias("of"), F.lit(i).cast("long").alias("level"), "bucket", "n"
        )
        answers = own if answers is None else answers.unionByName(own)
    out_ddl = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    schema = _schema(out_ddl)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        told: dict[tuple[int, int], bytes] = {
            (r["level"], r["bucket"]): r["n"] for r in right.to_pylist()
        }
        tables = []
        for row in left.to_pylist():
            block = _Block(row, levels)
            p = counts = unigram = None
            for length in range(len(levels) + 1):
                where, inverse, ctx, hashes, _ = block.grams(length)
                bucket = _buckets(hashes, buckets)
                order = np.argsort(bucket, kind="stable")
                n = np.empty(len(order), np.int64)
                pieces = [np.frombuffer(told[length, int(b)], np.int64) for b in np.unique(bucket)]
                n[order] = np.concatenate(pieces) if pieces else 0
                n = n[inverse]
                if length == 0:
                    counts, p = n, base.p(n)
                    unigram = p
                    p = p.copy()
                else:
                    p[where] = smoothed(levels[length - 1], ctx[inverse], n, p[where])
            ends = np.cumsum(block.lengths)
            spans = lambda x: np.diff(np.r_[0.0, np.cumsum(x)][np.r_[0, ends]])
            ids = np.frombuffer(row["doc_ids"], np.int64)
            known = np.frombuffer(row["known_ids"], bool)
            tables.append(
                pa.table(
                    [
                        pa.array(ids, mask=~known),
                        pa.array(block.held),
                        pa.array(block.lengths),
                        pa.array(spans(counts > 0).round().astype(np.int64)),
                        pa.array(np.full(len(ids), base.total, np.int64)),
                        pa.array(spans(np.log10(unigram))),
                        pa.array(spans(np.log10(p))),
                    ],
                    schema=schema,
                )
            )
        return pa.concat_tables(tables) if tables else schema.empty_table()

    rows = blocks.drop("different")
    return rows.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(run, out_ddl)

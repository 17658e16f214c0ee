"""Token counts, lexical search and whitening against brute force and odd input."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from barstream.llm import lexical_search, token_counts, whitening
from barstream.llm.queries import ORACLES, QUERIES
from tests.parity import compare, database

DOCS = "doc_id long, text string, size long, digest string, term string, n_tokens string"


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, blanks, long texts, ties, repeated rows and ids, clashing columns."""
    texts = [None, "", " \t\n", "Tree", "tree, TREE!", "été tree\x00x", "no hit", "tree " * 30_000, "a b é漢字", "<s> </s>"]
    rows = [(i, t, i, "x", "y", "z") for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (3, "other tree", 1, "x", "y", "z"), (None, "tree", 1, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def piece_model():
    return token_counts.Tokenizer.read(public_tokenizers.path("piece_bpe_32k.model"))


def test_token_counts_of_whole_texts(spark, sf_dir):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = {r.doc_id: r for r in QUERIES["op11_token_counts"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        n = len(model.encode(d.text or ""))
        assert tuple(rows[d.doc_id]) == (d.doc_id, len((d.text or "").encode()), n, n > 4096)


@pytest.mark.parametrize("many", [True, False])
def test_token_counts_of_odd_texts(spark, odd, many, monkeypatch):
    if many:
        monkeypatch.setattr(token_counts, "BROADCAST_ROWS", 0)
    tokenizer = piece_model()
    count = tokenizer.counter()
    got = token_counts.count_tokens(odd, tokenizer, limit=10)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    wanted = []
    for r in odd.collect():
        n = count([r.text or ""])[0]
        wanted.append((r.doc_id, len((r.text or "").encode()), n, n > 10))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(wanted, key=key)
    assert token_counts.count_tokens(odd.limit(0), tokenizer).count() == 0


def test_only_misses_are_encoded_and_appended(spark, odd, tmp_path, monkeypatch):
    tokenizer = piece_model()
    cache = token_counts.TokenCache(spark, str(tmp_path / "cache"))
    encoded, real = [], token_counts.missing_counts

    def counted(texts, missing, used):
        encoded.append(missing.count())
        return real(texts, missing, used)

    monkeypatch.setattr(token_counts, "missing_counts", counted)
    texts = {r.text or "" for r in odd.collect()}
    half = odd.where("doc_id < 5")
    token_counts.count_tokens(half, tokenizer, cache).collect()
    token_counts.count_tokens(odd, tokenizer, cache).collect()
    again = token_counts.count_tokens(odd, tokenizer, cache)
    known = {r.text or "" for r in half.collect()}
    assert encoded == [len(known), len(texts - known)]
    assert again.count() == odd.count() and cache.read(tokenizer.version).count() == len(texts)
    # Stored counts are taken as they are, and only for their own tokenizer version.
    cache.append("other", spark.createDataFrame([(b"x", 7)], token_counts.COUNTS))
    cache.append(tokenizer.version, cache.read(tokenizer.version).limit(2))
    assert cache.read(tokenizer.version).count() == len(texts) and cache.read("other").count() == 1


def test_other_tokenizer_files(spark):
    import tiktoken  # noqa: F401
    from tokenizers import Tokenizer

    texts = ["Hello  world", "", "a <|endoftext|> b", "été 漢字"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    json = token_counts.Tokenizer.read(public_tokenizers.path("byte_bpe_50k.json"))
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, json).collect()}
    assert got == {i: len(plain.encode(t, add_special_tokens=False)) for i, t in enumerate(texts)}
    ranks = token_counts.Tokenizer.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, ranks).collect()}
    assert got[0] == 3 and got[1] == 0 and got[2] > 3
    assert len({json.version, ranks.version, piece_model().version}) == 3


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_search(docs, items, k):
    """The ranking by the contract's words; ``docs`` and ``items`` are (id, text) rows."""
    said = [(i, Counter(TERM.findall((t or "").translate(SMALL)))) for i, t in docs]
    said = [(i, c) for i, c in said if c]
    n_docs, tokens = len(said), sum(sum(c.values()) for _, c in said)
    df = Counter(t for _, c in said for t in c)
    out = []
    for item in {i for i, _ in items}:
        terms = [t for text in {t for i, t in items if i == item} for t in TERM.findall((text or "").translate(SMALL))]
        found = []
        for doc, c in said:
            m = 25 + 75 * sum(c.values()) * n_docs // tokens
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms
            )
            if score > 0:
                found.append((-score, doc is None, doc))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "The tree, the Tree"), (1, "The tree, the Tree"), (1, "été"), (2, None), (3, "..."), (None, "no tree"), (5, "hit other x y"), (6, "absent")]


@pytest.mark.parametrize("part_bytes", [lexical_search.PART_BYTES, 8])
def test_search_is_the_brute_force_ranking(spark, odd, part_bytes, monkeypatch):
    monkeypatch.setattr(lexical_search, "PART_BYTES", part_bytes)
    monkeypatch.setattr(lexical_search, "CELLS", 16)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    for k in (2, 10):
        got = lexical_search.search(odd.repartition(5), items, k).collect()
        assert sorted(map(tuple, got), key=repr) == brute_search(docs, ITEMS, k)


def test_search_over_nothing(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.search(odd.limit(0), items).count() == 0
    assert lexical_search.search(odd, items.limit(0)).count() == 0
    assert lexical_search.search(odd, items.where("item_id in (2, 3)")).count() == 0


def test_guarded_terms_are_found_whole():
    found = lexical_search.automaton([b"a", b"ab", b"b"])
    assert [n for _, n in found.iter(" a a ab abc b ")] == [0, 0, 1, 2]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_search_sql(spark, sf):
    where = f"/root/testdata/{sf}"
    built = QUERIES["op12_lexical_search"](spark, where)
    assert compare(built, ORACLES["op12_lexical_search"], database(where)) == []


def brute_whitening(vectors, components):
    x = np.floor(64 * np.array(vectors, np.float64)) + 1_000_000
    c = x - x.mean(0)
    v = c.T @ c / len(c)
    values, u = np.linalg.eigh(v)
    values, u = values[::-1][:components], u[:, ::-1][:, :components]
    n, s = len(x), [int(t) for t in x.sum(0)]
    deviation = [sum((n * int(a) - b) ** 2 for a, b in zip(row, s)) for row in x]
    return c @ u / np.sqrt(values), values / np.trace(v), deviation


def held_against(rows, vectors, components):
    z, explained, deviation = brute_whitening(vectors, components)
    got = np.zeros_like(z)
    for r in rows:
        got[r.vec_id, r.component - 1] = r.whitened
        assert r.n == len(vectors) and r.deviation == deviation[r.vec_id]
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-10
        assert r.identity_error < 1e-10
    signs = np.sign((got * z).sum(0))
    assert len(rows) == z.size and np.abs(got * signs - z).max() < 1e-8


def test_whitening_query(spark, sf_dir):
    vectors = [r.embedding for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()]
    held_against(QUERIES["op13_whitening"](spark, sf_dir).collect(), vectors, 32)


def test_whitening_by_lanes_beyond_the_block(spark, monkeypatch):
    """150 dimensions and a block of 8: filters, probes and the tree of sums all take part."""
    monkeypatch.setattr(whitening, "LANES", 2)
    monkeypatch.setattr(whitening, "GUARDS", 4)
    monkeypatch.setattr(whitening, "PACKED", 1500)
    random = np.random.default_rng(5)
    vectors = (random.standard_normal((400, 150)) * np.geomspace(9, 1, 150)).tolist()
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    held_against(whitening.whiten(frame.repartition(20), 4).collect(), vectors, 4)


def test_a_missed_direction_is_found_by_the_probe(spark, monkeypatch):
    """The block starts orthogonal to the largest direction; only a probe can bring it in."""
    random = np.random.default_rng(7)
    vectors = np.concatenate([10 * random.standard_normal((60, 1)), random.standard_normal((60, 11)) * np.geomspace(5, 1, 11)], 1)
    rows = np.floor(64 * vectors).astype(np.int64)
    rows[:, 1:] = np.concatenate([rows[:30, 1:], rows[:30, 1:]])
    rows[:, 0] = np.concatenate([np.abs(rows[:30, 0]), -np.abs(rows[:30, 0])])
    rows[:, 1:] -= np.round(rows[:, 1:].mean(0)).astype(np.int64)
    class Blind:
        """Starts without the first coordinate, then draws freely."""

        def __init__(self, _):
            self.real, self.drawn = np.random.Generator(np.random.PCG64(1)), 0

        def standard_normal(self, shape):
            out = self.real.standard_normal(shape)
            self.drawn += 1
            if self.drawn == 1:
                out[0] = 0
            return out

    monkeypatch.setattr(whitening, "GUARDS", 1)
    monkeypatch.setattr(whitening.np.random, "default_rng", Blind)
    frame = spark.createDataFrame([(i, r) for i, r in enumerate((rows / 64).tolist())], "vec_id long, embedding array<double>")
    held_against(whitening.whiten(frame, 2).collect(), rows / 64, 2)


def test_whitening_of_odd_vectors(spark):
    good = [[float(i), float(i * i % 7), 1.0] for i in range(9)]
    rows = [(i, v, "a") for i, v in enumerate(good)]
    bad = [None, [], [1.0, None, 2.0], [math.nan, 1.0, 2.0], [math.inf, 1.0, 2.0], [1.0, 2.0]]
    rows += [(100 + i, v, "b") for i, v in enumerate(bad)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string")
    got = whitening.whiten(frame).collect()
    # The third entry never varies, so two components are left.
    held_against([r for r in got], np.array(good), 2)
    again = frame.unionByName(frame.where("vec_id = 3")).unionByName(frame.where("vec_id = 4").withColumn("vec_id", F.lit(None).cast("long")))
    ids = Counter(r.vec_id for r in whitening.whiten(again).collect())
    assert ids[3] == 4 and ids[None] == 2 and ids[1] == 2
    for empty in (frame.limit(0), frame.where("vec_id >= 100 and vec_id < 105"), frame.where("vec_id = 2")):
        assert whitening.whiten(empty).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<double>")
    assert whitening.whiten(same).count() == 0


def test_deviations_beyond_a_number_are_an_error():
    y = np.array([[1 << 40], [0]], np.int64)
    assert whitening._deviations(np.array([[3], [1]]), 2, np.array([4])).tolist() == [4, 4]
    assert whitening._deviations(y, 2, np.array([1 << 40])).tolist() == [1 << 80, 1 << 80]

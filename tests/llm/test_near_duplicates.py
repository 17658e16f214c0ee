"""The near-duplicate stage against brute force over all pairs."""

from __future__ import annotations

from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from barstream.llm import simhash_dedup


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def copies(count=60, length=300):
    """Texts and near copies with replaced words: scattered (0.80 to 0.97) or neighbouring (0.89 to 0.96)."""
    rng = np.random.default_rng(11)
    out = []
    for i in range(count):
        base = [f"w{n}" for n in rng.zipf(1.15, length * 3) if n < 50_000][:length]
        out.append(" ".join(base))
        for _ in range(2):
            changed = list(base)
            n = int(rng.integers(1, 7))
            for at in rng.choice(len(base), n, False) if i % 2 else range(n * 2):
                changed[int(at)] = f"x{rng.integers(0, 10**6)}"
            out.append(" ".join(changed))
    return out


def roots(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    real = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    return real + copies() + [None, "", " \n", "\t"]


def groups_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = simhash_dedup.near_duplicates(docs)
    joined = docs.join(groups, simhash_dedup._identity(F.col("text")) == F.col("digest"))
    return {r.doc_id: r.component_id for r in joined.collect()}


def test_groups_are_those_of_all_pairs(spark, texts):
    sets = [shingles(t) for t in texts]
    true = {(a, b): s for a, b in combinations(range(len(texts)), 2) if (s := similarity(sets[a], sets[b])) >= 0.8}
    got = groups_of(spark, texts)
    assert len(got) == len(texts)
    whole = roots(len(texts), true)
    # No text joins a group without a chain of similar pairs, and each group is led by its smallest id.
    assert all(whole[i] == whole[lead] and lead <= i for i, lead in got.items())
    band = defaultdict(list)
    for (a, b), s in true.items():
        band[min(int(s * 20), 19)].append(got[a] == got[b])
    assert len(band[16]) >= 15 and len(band[17]) >= 15 and len(band[18]) >= 15
    for at, found in band.items():
        assert np.mean(found) >= 0.9, (at / 20, len(found), np.mean(found))
    lost = sum(not x for found in band.values() for x in found)
    assert lost <= 0.05 * len(true)


def test_pairs_that_fail_do_not_multiply_and_hide_none(spark):
    """One set of words in many orders: all in the same buckets, few similar to the first of them."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(12):
        order = [words[i] for i in rng.permutation(120)]
        texts += [" ".join(order), " ".join(order[1:] + order[:1])]
    got = groups_of(spark, texts)
    assert [got[i] for i in range(24)] == [i - i % 2 for i in range(24)]


def test_buckets_give_each_near_pair_at_most_once_a_segment(spark):
    rng = np.random.default_rng(4)
    base = int(rng.integers(0, 1 << 62))
    prints = [base, base, base ^ 1, base ^ (1 << 40) ^ (1 << 50), base ^ (1 << 3) ^ (1 << 9) ^ (1 << 33) ^ (1 << 60), 5]
    nodes = spark.createDataFrame([(i, [f]) for i, f in enumerate(prints)], "node long, fps array<long>")
    members = simhash_dedup.bucket_members(nodes, 1).withColumn("root", F.col("node"))
    members = members.withColumn("prefix", F.array(F.lit(1).cast("short")))
    near = lambda x, y: min(((x ^ y) & 0xFFFFFFFF).bit_count(), ((x ^ y) >> 32).bit_count()) <= 1
    true = {(a, b) for a, b in combinations(range(6), 2) if near(prints[a], prints[b])}
    assert {tuple(r) for r in simhash_dedup._across(members).collect()} == true and (0, 4) not in true
    assert all(r.least == 0 for r in members.collect())


def test_large_groups_give_one_row_a_segment_and_all_their_pairs(spark):
    """Two groups of copies that differ by one bit, and a third: no row for each of 32 bits."""
    base = 0x0123456789ABCDEF
    prints = [base] * 30 + [base ^ 1] * 20 + [base ^ 1 ^ (1 << 33) ^ (1 << 34)] * 5 + [7 << 20]
    nodes = spark.createDataFrame([(i, [f]) for i, f in enumerate(prints)], "node long, fps array<long>")
    members = simhash_dedup.bucket_members(nodes, 1).withColumn("prefix", F.array(F.lit(1).cast("short")))
    assert members.count() == 2 * 55
    links = spark.createDataFrame([(i, i + 1) for i in range(28)] + [(30, i) for i in range(31, 50)], "a long, b long")
    left = simhash_dedup._open_members(members, links, "test")
    root = {i: 0 if i < 29 else 30 if 30 <= i < 50 else i for i in range(56)}
    assert {r.node: r.root for r in left.collect()} == {i: root[i] for i in range(55)}
    near = lambda x, y: min(((x ^ y) & 0xFFFFFFFF).bit_count(), ((x ^ y) >> 32).bit_count()) <= 1
    true = {(a, b) if root[a] < root[b] else (b, a) for a, b in combinations(range(56), 2) if near(prints[a], prints[b])}
    assert {tuple(r) for r in simhash_dedup._across(left).collect()} == {(a, b) for a, b in true if root[a] != root[b]}
    # Once all are of one root nothing is left open.
    links = spark.createDataFrame([(i, i + 1) for i in range(54)], "a long, b long")
    assert simhash_dedup._open_members(left, links, "test").count() == 0


def test_prefixes_of_similar_sets_meet(spark, texts):
    sets = [np.unique([hash(s) for s in shingles(t)]).astype(np.int64) for t in texts[-150:]]
    frame = spark.createDataFrame([(i, s.tolist()) for i, s in enumerate(sets)], "node long, set array<long>")
    prefix = {r.node: set(r.prefix) for r in simhash_dedup._prefixes(frame, 0.8).collect()}
    held = [frozenset(s.tolist()) for s in sets]
    true = [(a, b) for a, b in combinations(range(len(held)), 2) if held[a] and similarity(held[a], held[b]) >= 0.8]
    assert len(true) > 50 and all(prefix[a] & prefix[b] for a, b in true)
    met = sum(bool(prefix.get(a, set()) & prefix.get(b, set())) for a, b in combinations(range(len(held)), 2))
    assert met < 0.1 * len(held) * len(held) / 2


def test_sketches_pass_all_similar_sets_and_few_others(spark, texts):
    rng = np.random.default_rng(5)
    sets = [np.unique([hash(s) for s in shingles(t)]).astype(np.int64) for t in texts[-90:]]
    for n in (0, 1, 60, 64, 65, 128, 130, 1000, 5000):  # about where the sketch's length doubles
        base = rng.integers(-(1 << 62), 1 << 62, n)
        sets += [np.unique(base), np.unique(np.append(base, rng.integers(0, 1 << 62, n // 5)))]
        sets.append(np.unique(np.append(base[: n * 2 // 3], rng.integers(0, 1 << 62, n // 3))))
    frame = spark.createDataFrame([(i, s.tolist()) for i, s in enumerate(sets)], "node long, set array<long>")
    marks = frame.select("node", F.size("set").alias("n"), simhash_dedup.sketch_of(F.col("set")).alias("sketch"))
    p, q = marks.alias("p"), marks.alias("q")
    pairs = p.join(q, (F.col("p.node") < F.col("q.node")) & simhash_dedup._may_pass("p", "q", 0.8))
    got = {tuple(r) for r in pairs.select("p.node", "q.node").collect()}
    held = [frozenset(s.tolist()) for s in sets]
    true = {(a, b) for a, b in combinations(range(len(held)), 2) if similarity(held[a], held[b]) >= 0.8}
    assert len(true) > 30 and true <= got and len(got - true) < 0.2 * len(true)


def test_a_group_of_near_copies_gives_no_pairs_in_its_square(spark, monkeypatch):
    """Texts of the same words that share some shingles, but too few: no pair comes out of the last join."""
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(40):
        order = list(words)
        for at in rng.choice(55, 4, False):
            order[at], order[at + 5] = order[at + 5], order[at]
        texts.append(" ".join(order))
    real, found = simhash_dedup._across, []

    def counted(*args):
        pairs = real(*args)
        found.append(pairs.count())
        return pairs

    monkeypatch.setattr(simhash_dedup, "_across", counted)
    groups_of(spark, texts)
    assert found[0] <= len(texts)


def test_large_wanted_sets_go_by_shuffle(spark, texts, monkeypatch):
    small = texts[-60:]
    few = groups_of(spark, small)
    monkeypatch.setattr(simhash_dedup, "BROADCAST_ROWS", 0)
    assert groups_of(spark, small) == few


def test_all_rows_of_an_id_stay_or_go_and_columns_are_kept(spark):
    rows = [(1, "a b c d e f", 7), (1, "a b c d e f", 8), (2, "A b c d e f", 9), (None, "other", 1), (3, None, 2), (4, "  ", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node long")
    kept = simhash_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.node for r in kept.collect()) == [1, 2, 7, 8]
    assert simhash_dedup.drop_near_duplicates(docs.limit(0)).count() == 0

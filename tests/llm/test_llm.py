"""The training-data operators against brute force, SQL, round trips and odd input."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from barstream.llm import chat, decontaminate, exact_dedup, mixing, quality, sharding
from barstream.llm import simhash_dedup, suffix_tree, toxicity, warc
from barstream.llm.queries import ORACLES
from tests.parity import compare, database

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, digest string, key string"


def words(n, start=0):
    return " ".join(f"w{i}" for i in range(start, start + n))


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, texts and sources, empty and long texts, repeated rows, clashing columns."""
    texts = [None, "", " \t\n", "one", "One", "one  two", "one two", words(60), words(60), words(30_000), "é ß 漢"]
    rows = [(i, t, "en", "s" if i % 3 else None, 1, -1, "x", "y") for i, t in enumerate(texts)]
    rows += [rows[7], (None, "one", None, "s", None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_gives_the_same_rows(spark, sf_dir, name):
    built = contract.queries()[name](spark, sf_dir)
    assert compare(built, ORACLES[name], database(sf_dir)) == []


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op3_source_mix"])
def test_sql_gives_the_same_rows_for_odd_documents(spark, odd, name, tmp_path):
    plain = odd.select("doc_id", "text", "source")
    plain.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    connection = database("/nowhere")
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(contract.queries()[name](spark, str(tmp_path)), ORACLES[name], connection) == []


def test_every_operator_takes_odd_and_empty_documents(spark, odd, none):
    labels = spark.createDataFrame(
        [(0, 1, 0), (3, 0, 1), (3, 0, 1), (None, 1, 1), (7, None, None)],
        "doc_id long, quality int, toxic int",
    )
    items = spark.createDataFrame(
        [(1, words(20, 100)), (2, None), (3, ""), (None, "one two")], "item_id long, text string"
    )
    for docs in (odd, none):
        n = docs.count()
        always = F.lit(True)
        ranking = quality.fit_quality(docs, labels, always)
        scored = quality.score_quality(docs, ranking)
        assert scored.count() == n and scored.where("score between 0 and 1").count() == n
        assert quality.keep_quality(docs, ranking).columns == docs.columns
        assert exact_dedup.exact_groups(docs).count() == n
        assert mixing.mix_sizes(docs).count() == n
        assert mixing.mix_documents(docs).columns == docs.columns
        assert sharding.shard_documents(docs).count() == n
        model = toxicity.fit_toxicity(docs, labels, always)
        assert toxicity.score_toxicity(docs, model).where("score between 0 and 1").count() == n
        assert decontaminate.find_leaks(docs, items).count() == n
        assert decontaminate.drop_leaks(docs, items).columns == docs.columns
        assert simhash_dedup.fingerprint_components(docs).count() == n
        assert simhash_dedup.drop_near_duplicates(docs).columns == docs.columns
        assert suffix_tree.score_texts(docs, F.lit(False)).where("score <= 0").count() == n


def test_colliding_hashes_are_told_apart_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "digest_of", lambda text: F.unhex(F.lit("00")))
    docs = spark.createDataFrame([(3, "a"), (1, "b"), (2, "a"), (5, "c")], "doc_id long, text string")
    rows = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs).collect()}
    assert rows == {3: (2, 2, False), 2: (2, 2, True), 1: (1, 1, True), 5: (5, 1, True)}


def test_differencing_balances_and_keeps_lanes():
    sizes = np.random.default_rng(1).integers(1, 1000, 500)
    sums = np.zeros((500, 4), np.int64)
    sums[:, -1] = sizes
    lanes = sharding.differencing(sums)
    assert all(sorted(row) == [0, 1, 2, 3] for row in lanes.tolist())
    totals = np.bincount(lanes[:, -1], weights=sizes)
    assert totals.max() - totals.min() <= 2


def test_shards_over_several_levels(spark, sf_dir, monkeypatch):
    for name, value in (("GROUPS_PER_TASK", 20), ("PARTS_PER_TASK", 3), ("ROWS_PER_WINDOW", 2)):
        monkeypatch.setattr(sharding, name, value)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    rows = sharding.shard_documents(docs, 4).join(docs, "doc_id").collect()
    shards, slots, texts = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        assert r["size"] == len(r.text.encode()) + 8
        assert r.text_crc32 == zlib.crc32(r.text.encode())
        shards[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        texts[r.text].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in texts.values())
    assert max(shards.values()) - min(shards.values()) < 0.02 * sum(shards.values())


def test_archives_round_trip(spark, tmp_path):
    pages = [(1, "http://a b\r\n", "x" * 100_000), (2, None, None), (3, "u", ""), (4, "v", "é"), (5, "v", "é"), (None, "n", "é"), (5, "v", "é")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    index = warc.write_warc(df, str(tmp_path / "warc"))
    rows = warc.read_warc(index, str(tmp_path / "warc")).collect()
    got = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in rows)
    assert got == [
        (0, "response", None, 2), (1, "response", None, 100_000), (2, "revisit", 3, 0),
        (3, "response", None, 0), (4, "revisit", 5, 2), (5, "response", None, 2), (5, "response", None, 2),
    ]
    body = {p: (h or "").encode() for p, _, h in pages}
    assert all(r.payload_digest == warc.sha1_of(body[r.page_id]) for r in rows)
    some = warc.read_warc(index.where("page_id = 1"), str(tmp_path / "warc")).collect()
    assert [bytes(r.payload) for r in some] == [b"x" * 100_000]
    assert warc.archive_and_read(df.limit(0)).count() == 0


def _brute_components(texts):
    prints = [simhash_dedup.fingerprint(t, 3) & (2**64 - 1) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(f"{p:016x}", find(i)) for i, p in enumerate(prints)]


def test_components_match_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = ["", None, "a", "A b"]
    for _ in range(4):
        base = [f"t{x}" for x in rng.integers(0, 500, 120)]
        for _ in range(25):
            copy = list(base)
            copy[rng.integers(0, 120)] = f"n{rng.integers(0, 9)}"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = simhash_dedup.fingerprint_components(docs).orderBy("doc_id").collect()
    assert [(r.fingerprint, r.component_id) for r in rows] == _brute_components(texts)
    h = xxhash.xxh64_intdigest(b"a b", 42)
    assert rows[3].fingerprint == f"{h:016x}"


def test_near_copies_go_and_others_stay(spark):
    base = [f"b{i}" for i in range(400)]
    near = [*base[:200], "other", *base[201:]]
    half = [*base[:200], *(f"c{i}" for i in range(200))]
    rows = [(5, base), (2, near), (3, half), (4, base)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    assert {r.doc_id for r in simhash_dedup.drop_near_duplicates(docs).collect()} == {2, 3}


def _alike(a, b):
    cut = lambda w: Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))
    x, y = cut(a), cut(b)
    return sum((x & y).values()) / sum((x | y).values())


def test_leaks_match_brute_force(spark):
    items = [[f"i{k}_{j}" for j in range(15 + 7 * k)] for k in range(5)]
    items.append(["of", "the"] * 12)
    filler = [f"f{i}" for i in range(40)]
    texts = [filler + items[0] + filler, items[1], filler + items[2][:-1] + ["z"] + filler,
             filler + items[3][: len(items[3]) // 2] + filler, filler, [], items[4][2:], items[5] * 4,
             filler + items[4][20:] + items[4][:20] + filler, filler + items[3][9:] + items[3][:9] + filler,
             filler + items[4][:22] + ["x", "y"] + items[4][22:] + filler, items[3][18:] + items[3][:18],
             filler + items[2][12:] + filler + items[2][:12], filler + items[4][1:], items[2][1:] + items[4] + items[2]]
    texts += [texts[8], texts[8]]
    docs = spark.createDataFrame([(i, "  ".join(t).upper()) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    rows = decontaminate.find_leaks(docs, bench).orderBy("doc_id").collect()
    for r, text in zip(rows, texts):
        best = max(
            (_alike(text[s : s + len(w)], w), -k)
            for k, w in enumerate(items)
            for s in range(max(1, len(text) - len(w) + 1))
        ) if text else (0, 0)
        assert r.contaminated == (best[0] >= 0.8)
        if r.contaminated:
            assert (r.similarity, r.item_id) == (pytest.approx(best[0]), -best[1])


def test_edge_trimmed_passages_are_found(spark):
    rng = np.random.default_rng(3)
    items = [[f"i{k}_{j}" for j in range(36 + k)] for k in range(4)]
    passages = []
    for i in range(120):
        w, cut = items[i % 4], 3
        other = [f"o{x}" for x in rng.integers(0, 10**6, cut)]
        passages.append((i % 4, (w[:-cut] + other, other + w[cut:], other[:2] + w[2:-1] + other[2:])[i % 3]))
    near = [i for i, (k, p) in enumerate(passages) if _alike(p, items[k]) >= 0.8]
    docs = spark.createDataFrame([(i, " ".join(p)) for i, (_, p) in enumerate(passages)], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    rows = decontaminate.find_leaks(docs, bench).where("contaminated").collect()
    assert len(near) > 60
    assert {r.doc_id: r.item_id for r in rows} == {i: passages[i][0] for i in near}


def test_counts_of_grams_may_pass_two_to_the_31(spark):
    most = 2**31 - 1
    rows = [
        (0, block, np.array([0, 0], np.int32).tobytes(), np.array([7, 9], np.uint64).tobytes(),
         np.array([most, i], np.int32).tobytes())
        for i, block in enumerate(["a", "b", "c"])
    ]
    parts = spark.createDataFrame([(b, k, bytearray(c), bytearray(h), bytearray(n)) for b, k, c, h, n in rows], suffix_tree.PARTS)
    summed = suffix_tree._sum_up(parts, [], [], None)
    answers = summed.where("kind = 'answer'").collect()
    assert sorted(r.block for r in answers) == ["a", "b", "c"]
    assert all(np.frombuffer(r.n, np.int64).tolist() == [3 * most, 3] for r in answers)
    assert suffix_tree._context_sums(summed)[0][0] == 3 * most + 3


def test_snapshots_collapse(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART", 3)
    said = [("user", f"t{i}") for i in range(8)]
    convs = {1: said[:2], 2: said, 3: said[:5], 4: said, 5: said[1:3], 6: [("user", "t0"), ("user", "other")]}
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    rows += [rows[0], (None, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(df).collect()
    assert sorted((r.conv_id or 0, r.part, r.turns, r.copies) for r in out) == [
        (0, 0, 1, 1), (2, 0, 8, 2), (2, 1, 8, 2), (2, 2, 8, 2), (5, 0, 2, 1), (6, 0, 2, 1),
    ]
    assert [r.rendered for r in out if r.conv_id == 6] == [
        "<|im_start|>user\nt0<|im_end|>\n<|im_start|>user\nother<|im_end|>\n"
    ]
    assert chat.format_chats(df.limit(0)).count() == 0


def test_suffix_tree_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = []
    for i in range(60):
        line = []
        for _ in range(40):
            line += ["a", "b"] if rng.random() < 0.4 else [f"w{rng.integers(0, 20)}"]
        texts.append(" ".join(line))
    texts.append(None)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = F.col("doc_id") % 7 == 2
    out = suffix_tree.score_texts(docs, held, share=0.01, block_bytes=500).orderBy("doc_id").collect()
    lines = [suffix_tree.tokens_of(t) for t in texts]
    train = [x for i, x in enumerate(lines) if i % 7 != 2]
    c = Counter(w for x in train for w in x)
    total, kinds = sum(c.values()), len(c)
    grams = [defaultdict(Counter) for _ in range(3)]
    for x in train:
        for j, w in enumerate(x):
            for k in range(min(j, 2) + 1):
                grams[k][tuple(x[j - k : j])][w] += 1
    p0 = lambda w: (c[w] + 1) / (total + kinds + 1)
    kept = {}

    def p(ctx, w):
        if not ctx:
            return p0(w)
        short = p(ctx[1:], w)
        if ctx not in kept:
            return short
        n = grams[len(ctx)][ctx]
        size = sum(n.values())
        return (max(n[w] - 0.8, 0) + min(0.8 * len(n), size) * short) / size

    for k in (1, 2):
        for ctx, n in grams[k].items():
            whole = grams[k - 1][ctx[:-1]][ctx[-1]]
            if whole >= 0.01 * total and suffix_tree.END not in ctx:
                size = sum(n.values())
                if sum(m * math.log(m / size / p(ctx[1:], w)) for w, m in n.items()) >= suffix_tree.GAIN:
                    kept[ctx] = True
    assert (b"a",) in kept and out[0].train_tokens == total
    for r, x in zip(out, lines):
        base = sum(math.log10(p0(w)) for w in x)
        score = sum(
            math.log10(p(next((tuple(x[j - k : j]) for k in (2, 1) if j >= k), ()), w))
            for j, w in enumerate(x)
        )
        assert (r.n_tokens, r.n_known) == (len(x), sum(c[w] > 0 for w in x))
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(2)
    unit = lambda v: {t: w / math.sqrt(sum(x * x for x in v.values())) for t, w in v.items()}
    vectors = [unit({b"t%d" % t: rng.random() for t in rng.choice(40, 5, False)}) for _ in range(500)]
    index = toxicity.BlockMaxIndex(vectors)
    for query in vectors[:20]:
        brute = sorted(
            ((round(sum(w * v.get(t, 0) for t, w in query.items()), 12), -i) for i, v in enumerate(vectors)),
            reverse=True,
        )[:7]
        assert [at for _, at in index.nearest(query, 7)] == [-i for _, i in brute]


def test_toxicity_rows_match_brute_force_over_whole_texts(spark):
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(["w%d" % w for w in rng.zipf(1.3, 40) if w < 500] + ["scum"] * (i % 5 == 0))) for i in range(160)]
    marks = {i: int(i % 5 == 0) for i in range(120)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, v) for i, v in marks.items()], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels, F.lit(True))
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}

    tfs = {i: Counter(t.split()) for i, t in rows}
    n, n1 = len(marks), sum(marks.values())
    weight = {}
    for term in {t for i in marks for t in tfs[i]}:
        a, b = (sum(term in tfs[i] for i in marks if marks[i] == v) for v in (1, 0))
        odds = (a + b) * (n - a - b) * n1 * (n - n1)
        chi = n * (a * (n - n1 - b) - b * (n1 - a)) ** 2 / odds if odds else 0
        weight[term] = (1 + math.log((1 + len(rows)) / (1 + sum(term in tf for tf in tfs.values())))) * (1 + chi)

    def unit(tf):
        v = {t: (1 + math.log(m)) * weight[t] for t, m in tf.items() if t in weight}
        return {t: w / math.sqrt(sum(x * x for x in v.values())) for t, w in v.items()}

    units, prior = {i: unit(tf) for i, tf in tfs.items()}, (n1 + 0.5) / (n + 1)
    for i, v in units.items():
        near = sorted((-round(sum(w * units[j].get(t, 0) for t, w in v.items()), 12), j) for j in marks)
        near = [(-c, j) for c, j in near if c < 0][: toxicity.NEIGHBOURS]
        score = (prior + sum(c * c * marks[j] for c, j in near)) / (1 + sum(c * c for c, _ in near))
        assert got[i].score == pytest.approx(score) and got[i].predicted == (score >= 0.5)
        assert [(e.doc_id, e.toxic) for e in got[i].evidence] == [(j, marks[j]) for _, j in near[:3]]


def test_toxicity_looks_each_term_up_once():
    """One lookup for a different term of a text, whatever it weighs; weights and neighbours as by plain Python."""
    rng = np.random.default_rng(8)
    tfs = [Counter(b"w%d" % w for w in rng.zipf(1.3, 30) if w < 200) for _ in range(300)]
    idf = {t: 1 + rng.random() for tf in tfs for t in tf}
    model = toxicity.ToxicityModel([(i, i % 2, tf) for i, tf in enumerate(tfs)], idf, (150, 150))
    assert not any(isinstance(held, dict) for held in vars(model).values())

    class Counted(dict):
        asked = 0

        def get(self, *args):
            Counted.asked += 1
            return super().get(*args)

        __getitem__ = __contains__ = None

    def unit(tf):
        v = {t: (1 + math.log(n)) * idf[t] for t, n in tf.items() if t in idf}
        return {t: w / math.sqrt(sum(x * x for x in v.values())) for t, w in v.items()}

    units, texts = [unit(tf) for tf in tfs], [list(tf.elements()) + [b"unknown"] for tf in tfs[:100]] + [[], [b"unknown"]]
    model.index.terms = Counted(model.index.terms)
    scored = model.score_of(texts)
    assert Counted.asked == sum(len(set(words)) for words in texts)
    assert scored[100:] == [(model.blank, []), (model.blank, [])]
    for words, (score, evidence) in zip(texts[:100], scored):
        v = unit(Counter(words))
        near = sorted((-round(sum(w * u.get(t, 0) for t, w in v.items()), 12), j) for j, u in enumerate(units))
        near = [(-c, j) for c, j in near if c < 0][: toxicity.NEIGHBOURS]
        assert [j for j, _, _ in evidence] == [j for _, j in near[:3]]
        votes = sum(c * c * (j % 2) for c, j in near), sum(c * c for c, j in near)
        assert score == pytest.approx((model.prior + votes[0]) / (1 + votes[1]))


@pytest.mark.parametrize("name, label", [("op1_quality_classifier", "quality"), ("op7_toxicity", "toxic")])
def test_held_out_accuracy(spark, name, label):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = contract.queries()[name](spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and sum(r.predicted == r[label] for r in rows) / len(rows) > 0.95


def test_pipeline_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == columns
        if name != "source_mix":
            assert out.join(docs, "doc_id", "left_anti").count() == 0
        docs = out
    n = docs.count()
    shards = corpus_pipeline.run(spark, sf_dir)
    assert 0 < shards.count() == n

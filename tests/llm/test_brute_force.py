"""The ranking, the sharding and every pipeline stage against plain Python, or SQL, row by row."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from barstream.llm import quality, sharding
from barstream.llm.queries import ORACLES, QUERIES
from tests.llm.test_near_duplicates import roots, shingles, similarity

SF = "/root/testdata/sf0.001"
STOPS = set(b".,;:'\"-()")


def described(text):
    """The features of a text, counted one by one."""
    raw = (text or "").encode()
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n = max(1, len(words))
    upper = sum(65 <= c <= 90 for c in raw)
    lower = sum(97 <= c <= 122 for c in raw)
    marks = [c for c in raw if 33 <= c < 127 and not chr(c).isalnum()]
    case = upper / max(1, upper + lower)
    odd = sum(c not in STOPS for c in marks) / n
    bars = sum(w == b"|" for w in words) / n
    repeats = sum(words[i] == words[i - 1] for i in range(1, len(words))) / n
    most = max((words.count(w) for w in set(words)), default=0) / n
    return [
        case, math.sqrt(case), odd, math.sqrt(odd), bars, math.sqrt(bars), raw.count(b"!!") / n,
        repeats, math.sqrt(repeats), most, len(set(words)) / n, math.log(1 + len(words)),
        min(30.0, len(raw) / n), sum(48 <= c <= 57 for c in raw) / max(1, len(raw)),
        sum(c in STOPS for c in raw) / n, 1 - len(set(lines)) / max(1, len(lines)),
        math.log(1 + n / max(1, len(lines))), float(not words),
    ]


def solved(matrix, right):
    """The solution of a linear system by elimination."""
    rows = [[*row, r] for row, r in zip(matrix, right)]
    k = len(rows)
    for i in range(k):
        top = max(range(i, k), key=lambda j: abs(rows[j][i]))
        rows[i], rows[top] = rows[top], rows[i]
        for j in range(k):
            if j != i:
                f = rows[j][i] / rows[i][i]
                rows[j] = [a - f * b for a, b in zip(rows[j], rows[i])]
    return [rows[i][k] / rows[i][i] for i in range(k)]


def ranked(examples, texts, pairs, ridge=1e-2):
    """Scores of ``texts`` by a ranking of ``examples`` (text, label), in id order."""
    x, y = [described(t) for t, _ in examples], [label for _, label in examples]
    k, n = len(x[0]), len(x)
    mean = [sum(r[j] for r in x) / n for j in range(k)]
    scale = [math.sqrt(sum((r[j] - mean[j]) ** 2 for r in x) / n) for j in range(k)]
    scale = [s if s > 1e-9 else 1.0 for s in scale]

    def standard(row):
        return [max(-10.0, min(10.0, (v - m) / s)) for v, m, s in zip(row, mean, scale)]

    z = [standard(r) for r in x]
    rng = np.random.default_rng(7)
    good = rng.choice([i for i in range(n) if y[i] == 1], pairs)
    bad = rng.choice([i for i in range(n) if y[i] == 0], pairs)
    d = [[a - b for a, b in zip(z[g], z[h])] for g, h in zip(good, bad)]
    w = [0.0] * k
    for _ in range(30):
        gradient = [ridge * v for v in w]
        hessian = [[ridge * (i == j) for j in range(k)] for i in range(k)]
        for row in d:
            p = 1 / (1 + math.exp(sum(a * b for a, b in zip(row, w))))
            for i in range(k):
                gradient[i] -= row[i] * p / pairs
                for j in range(k):
                    hessian[i][j] += row[i] * row[j] * p * (1 - p) / pairs
        step = solved(hessian, gradient)
        w = [a - b for a, b in zip(w, step)]
        if max(map(abs, step)) < 1e-6:
            break

    def raw(row):
        return sum(a * b for a, b in zip(row, w))

    # Every labelled row is an example here, so each stands for itself.
    order = sorted(map(raw, z))
    at = y.count(0) - 1
    threshold = (order[at] + order[at + 1]) / 2
    shift = math.log(0.7 / 0.3) - threshold
    return [1 / (1 + math.exp(-(raw(standard(described(t))) + shift))) for t in texts]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()


@pytest.fixture(scope="module")
def few_pairs():
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quality, "PAIRS", 250)
        yield 250


@pytest.fixture(scope="module")
def scores(spark, documents, few_pairs):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    examples = [(d.text, labels[d.doc_id]) for d in documents if d.doc_id in labels and not held_out(d.doc_id)]
    assert {label for _, label in examples} == {0, 1}
    found = ranked(examples, [d.text for d in documents], few_pairs)
    return {d.doc_id: s for d, s in zip(documents, found)}


def test_ranking_equals_plain_python(spark, documents, scores):
    rows = QUERIES["op1_quality_classifier"](spark, SF).collect()
    assert len(rows) == len(documents)
    for r in rows:
        assert r.score == pytest.approx(scores[r.doc_id], abs=1e-6)
        assert r.held_out == held_out(r.doc_id)
        assert r.predicted == (r.score >= 0.7)


def test_ranking_is_fitted_on_all_labelled_rows(spark):
    """Rows beyond ``examples`` count too: in the moments, in the pairs and in the threshold."""
    from pyspark.sql import functions as F

    docs = [(i, "plain words " * (i % 7 + 2) + "!! SHOUT | " * (i % 3 == 0)) for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i, _ in docs], "doc_id long, quality int")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    ranking = quality.fit_quality(frame, labels, F.lit(True), 4)
    x = np.array([described(t) for _, t in docs])
    assert ranking.mean == pytest.approx(x.mean(0)) and ranking.scale == pytest.approx(
        np.where(x.std(0) > 1e-9, x.std(0), 1.0)
    )
    raw = np.sort(ranking.raw(x))
    assert ranking.threshold == pytest.approx((raw[29] + raw[30]) / 2)
    rows = frame.join(labels, "doc_id").selectExpr("doc_id", "quality AS label", "array(doc_id * 1D) AS x")
    for sizes, count in (((30, 60), 12), ((30, 60), 40)):
        blocks = [
            (np.frombuffer(r.x).astype(int).tolist(), np.frombuffer(r.y, np.int64).tolist())
            for r in quality._blocks(rows, sizes, count).collect()
        ]
        assert len(blocks) == count and all(set(y) == {0, 1} for _, y in blocks)
        assert {i for x, _ in blocks for i in x} == set(range(90))


def dealt(rows, k):
    """The expected (doc_id, size, crc, shard, slot) of rows (doc_id, text), by differencing lists."""
    groups: dict[bytes, int] = Counter()
    bodies = [(i, (t or "").encode()) for i, t in rows]
    for _, body in bodies:
        groups[hashlib.md5(body).digest()] += len(body) + 8
    # A partial partition: its lanes in ascending order, each a total and its groups.
    parts = [[(0, [])] * (k - 1) + [(groups[key], [key])] for key in sorted(groups)]
    alive = set(range(len(parts)))
    while len(alive) > 1:
        a, b = sorted(alive, key=lambda i: (parts[i][0][0] - parts[i][-1][0], i))[:2]
        joined = [(x + y, g + h) for (x, g), (y, h) in zip(parts[a], reversed(parts[b]))]
        parts.append(sorted(joined, key=lambda lane: lane[0]))
        alive = alive - {a, b} | {len(parts) - 1}
    shard_of = {key: s for s, (_, keys) in enumerate(parts[-1]) for key in keys} if parts else {}
    slots: Counter = Counter()
    out = []
    for doc_id, body in sorted(bodies, key=lambda r: (r[0], hashlib.md5(r[1]).digest())):
        shard = shard_of[hashlib.md5(body).digest()]
        out.append((doc_id, len(body) + 8, zlib.crc32(body), shard, slots[shard]))
        slots[shard] += 1
    return sorted(out)


def shard_rows(df):
    found = df.collect()
    assert all(r.law == "bytes" and r.grown_shard is None for r in found)
    return sorted((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in found)


@pytest.mark.parametrize("k", [1, 3, 24])
def test_shards_equal_plain_python(spark, k):
    rng = np.random.default_rng(k)
    texts = ["x" * int(n) for n in rng.zipf(1.4, 150).clip(max=3_000)] + [None, "", "é漢", "b" * 20_000]
    rows = list(enumerate(texts)) + [(3, texts[3]), (500, "b" * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert shard_rows(sharding.shard_documents(docs, k)) == dealt(rows, k)


def test_shards_of_documents_equal_plain_python(spark, documents):
    expected = dealt([(d.doc_id, d.text) for d in documents], 24)
    assert shard_rows(QUERIES["op4_balanced_shards"](spark, SF)) == expected
    none = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard_documents(none).count() == 0


def said(sql, rows, columns):
    """What a SQL text says with ``rows`` as the documents."""
    connection = duckdb.connect()
    connection.execute(f"CREATE TABLE documents AS SELECT {columns} FROM '{SF}/documents.parquet' LIMIT 0")
    connection.executemany(f"INSERT INTO documents VALUES ({', '.join('?' * len(rows[0]))})", [tuple(r) for r in rows])
    connection.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    return [dict(zip(names, r)) for r in result.fetchall()]


def test_every_pipeline_stage_equals_plain_python(spark, documents, scores):
    columns = ", ".join(documents[0].asDict())
    stages = dict(corpus_pipeline.STAGES)

    def after(name, rows):
        docs = spark.createDataFrame(rows, schema)
        return sorted(map(tuple, stages[name](spark, docs, SF).collect()))

    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    kept = [d for d in documents if scores[d.doc_id] >= 0.7]
    assert 0 < len(kept) < len(documents)
    assert after("quality_classifier", documents) == sorted(map(tuple, kept))

    sets = [shingles(d.text) for d in kept]
    links = [(i, j) for i, j in combinations(range(len(kept)), 2) if similarity(sets[i], sets[j]) >= 0.8]
    leads = roots(len(kept), links)
    single = [d for i, d in enumerate(kept) if leads[i] == i]
    assert len(single) < len(kept)
    assert after("simhash_near_dedup", kept) == sorted(map(tuple, single))

    leaks = {r["doc_id"] for r in said(ORACLES["op8_decontamination"], single, columns) if r["contaminated"]}
    clean = [d for d in single if d.doc_id not in leaks]
    assert leaks
    assert after("benchmark_decontamination", single) == sorted(map(tuple, clean))

    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in said(ORACLES["op3_source_mix"], clean, columns)}
    mixed = [d for d in clean for _ in range(taken[d.doc_id][0] // max(1, taken[d.doc_id][1]))]
    sized = {d.doc_id for d in clean if taken[d.doc_id][1]}
    found = [r for r in after("source_mix", clean) if r[0] in sized]
    assert found == sorted(map(tuple, mixed))

    expected = dealt([(d.doc_id, d.text) for d in mixed], 24)
    docs = spark.createDataFrame(mixed, schema)
    assert shard_rows(stages["sharding"](spark, docs, SF)) == expected
    assert sized == {d.doc_id for d in clean}
    assert shard_rows(corpus_pipeline.run(spark, SF)) == expected

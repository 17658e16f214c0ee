"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barstream.llm import chat, decontaminate, exact_dedup, lexical_search, mixing, quality
from barstream.llm import sharding, simhash_dedup, suffix_tree, token_counts, toxicity, warc
from barstream.llm import whitening
from barstream.llm.common import id_bucket, table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = id_bucket(F.col("doc_id"), 4) == 2
    ranking = quality.fit_quality(docs, labels, ~held_out)
    return quality.score_quality(docs, ranking).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted"
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sizes(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=24)


def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_and_read(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_texts(
        table(spark, sf_dir, "documents"), id_bucket(F.col("doc_id"), 7) == 2
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = id_bucket(F.col("doc_id"), 5) == 0
    model = toxicity.fit_toxicity(docs, labels, ~held_out)
    scored = toxicity.score_toxicity(docs, model)
    near = F.transform("evidence", lambda e: e["doc_id"])
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", "predicted", near.alias("neighbours")
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.find_leaks(docs, benchmark)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.fingerprint_components(table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokenizer = token_counts.Tokenizer.read(public_tokenizers.path("piece_bpe_32k.model"))
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return lexical_search.search(docs, benchmark)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_exact_dedup,
        op3_source_mix,
        op4_balanced_shards,
        op5_warc_archive,
        op6_suffix_tree_scores,
        op7_toxicity,
        op8_decontamination,
        op9_chat_format,
        op10_simhash_dedup,
        op11_token_counts,
        op12_lexical_search,
        op13_whitening,
    )
}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
            FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER w AS keep_id,
               count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept,
               sha256(body) AS text_sha256
        FROM d
        WINDOW w AS (PARTITION BY body)
    """,
    "op3_source_mix": r"""
        WITH d AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 9) AS cell
            FROM documents
        ), s AS (
            SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
        ), r AS (
            SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS rank FROM s
        ), w AS (
            SELECT *, [5, 2, 1][(rank - 1) % 3 + 1] AS weight, 2 * source_size AS cap FROM r
        ), l AS (
            SELECT *,
                (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER o, 0))
                / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
            FROM w
            WINDOW o AS (ORDER BY cap::DOUBLE / weight, rank
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), c AS (
            SELECT *, cap <= weight * level AS capped FROM l
        ), t AS (
            SELECT source, source_size,
                   CASE WHEN capped THEN cap::DOUBLE
                        ELSE weight * max(CASE WHEN NOT capped THEN level END) OVER () END AS target
            FROM c
        ), b AS (
            SELECT *, CASE WHEN source_size = 0 THEN 1 WHEN target >= 2 * source_size THEN 2
                           WHEN target >= source_size THEN 1 ELSE 0 END AS whole
            FROM t
        ), u AS (
            SELECT d.*, b.source_size, b.target, b.whole,
                   b.target - b.whole * b.source_size AS budget,
                   sum(size) OVER (PARTITION BY d.source ORDER BY cell
                                   RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
                   sum(size) OVER (PARTITION BY d.source, cell) AS here
            FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
        )
        SELECT doc_id, size, source_size, target,
               (size * (whole + CASE WHEN budget > 0 AND (upto < budget
                    OR upto - here < budget AND upto - budget <= budget - (upto - here))
                    THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM u
    """,
    "op5_warc_archive": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body FROM pages
        ), h AS (
            SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS hex,
                   max(page_id) OVER (PARTITION BY body) AS leader
            FROM p
        ), n AS (
            SELECT *, list_transform(range(8), lambda g:
                ('0x' || substr(hex, 5 * g + 1, 5))::BIGINT) AS parts
            FROM h
        )
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(32), lambda i:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                          ((parts[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '')
                   AS payload_digest,
               CASE WHEN leader > page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN leader > page_id THEN leader END AS refers_to
        FROM n
    """,
    # Every window that shares a shingle with the item it is held against; others have none in common.
    "op8_decontamination": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), shingled AS (
            SELECT doc_id, len(w) AS n, unnest(range(greatest(len(w) - 4, 1)::BIGINT)) AS pos, w FROM words WHERE len(w) > 0
        ), shingles AS (
            SELECT doc_id, n, pos, array_to_string(w[pos + 1 : pos + 5], ' ') AS shingle FROM shingled
        ), items AS (
            SELECT min(item_id) AS item_id, w, len(w) AS length FROM (
                SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w
                FROM benchmark)
            WHERE len(w) > 0 GROUP BY w
        ), item_shingles AS (
            SELECT item_id, length, array_to_string(w[pos + 1 : pos + 5], ' ') AS shingle, count(*) AS m
            FROM (SELECT *, unnest(range(greatest(length - 4, 1)::BIGINT)) AS pos FROM items) GROUP BY ALL
        ), hits AS (
            SELECT doc_id, n, pos, shingle, item_id, length, m FROM shingles JOIN item_shingles USING (shingle)
        ), starts AS (
            SELECT DISTINCT doc_id, item_id, start FROM (
                SELECT doc_id, item_id, n, length, unnest(range(greatest(0, pos - length + 5)::BIGINT, pos + 1)) AS start FROM hits)
            WHERE start <= greatest(n - length, 0)
        ), shared AS (
            SELECT doc_id, item_id, start, shingle, n, length, least(count(*), any_value(m)) AS common
            FROM starts JOIN hits USING (doc_id, item_id)
            WHERE pos BETWEEN start AND start + greatest(least(n, length) - 4, 1) - 1
            GROUP BY ALL
        ), windows AS (
            SELECT doc_id, item_id, sum(common)::BIGINT AS common,
                greatest(least(any_value(n), any_value(length)) - 4, 1) + greatest(any_value(length) - 4, 1) AS both_sizes
            FROM shared GROUP BY doc_id, item_id, start
        ), found AS (
            SELECT doc_id, item_id, max(common / (both_sizes - common)) AS similarity
            FROM windows WHERE common / (both_sizes - common) >= 0.8::DOUBLE GROUP BY ALL
        ), leaks AS (
            SELECT doc_id, first(item_id ORDER BY similarity DESC, item_id) AS item_id, max(similarity) AS similarity,
                count(*) AS leaks
            FROM found GROUP BY doc_id
        )
        SELECT d.doc_id, leaks IS NOT NULL AS contaminated, item_id, similarity, coalesce(leaks, 0) AS leaks
        FROM documents d LEFT JOIN leaks l ON d.doc_id = l.doc_id
    """,
    "op9_chat_format": r"""
        WITH t AS (
            SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
        ), p AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST,
                                         encode(role), encode(text)) AS place
            FROM t
        ), c AS (
            SELECT conv_id, count(*) AS turns, list((role, text) ORDER BY place) AS said
            FROM p GROUP BY conv_id
        ), k AS (
            SELECT min(conv_id) AS conv_id, turns, count(*) AS copies, said
            FROM c GROUP BY said, turns
        ), prefixes AS (
            SELECT DISTINCT said[:n] AS said
            FROM (SELECT said, unnest(range(1, turns)) AS n FROM k)
        ), m AS (
            SELECT * FROM k ANTI JOIN prefixes USING (said)
        )
        SELECT m.conv_id, ((place - 1) // 256)::BIGINT AS part, m.turns, m.copies,
               string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10),
                          '' ORDER BY place) AS rendered
        FROM m JOIN p ON p.conv_id IS NOT DISTINCT FROM m.conv_id
        GROUP BY m.conv_id, part, m.turns, m.copies
    """,
    "op12_lexical_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS place, doc_id,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), l AS (
            SELECT place, doc_id, len(terms)::BIGINT AS n, terms FROM d WHERE len(terms) > 0
        ), g AS (
            SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS tokens FROM l
        ), b AS (
            SELECT item_id, unnest(regexp_extract_all(translate(text,
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM (SELECT DISTINCT item_id, text FROM benchmark)
        ), i AS (
            SELECT item_id, term, count(*)::BIGINT AS repeats FROM b GROUP BY item_id, term
        ), h AS (
            SELECT place, term, count(*)::BIGINT AS tf
            FROM (SELECT place, unnest(terms) AS term FROM l)
            WHERE term IN (SELECT term FROM i)
            GROUP BY place, term
        ), w AS (
            SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
            FROM h, g GROUP BY term, docs
        ), s AS (
            SELECT i.item_id, l.place, l.doc_id,
                   sum(i.repeats * w.w * ((1000000000 * h.tf)
                       // (1000 * h.tf + 8 * (25 + (75 * l.n * g.docs) // g.tokens))))::BIGINT AS score
            FROM i JOIN w USING (term) JOIN h USING (term) JOIN l USING (place), g
            GROUP BY i.item_id, l.place, l.doc_id
        ), r AS (
            SELECT item_id, doc_id, score, row_number() OVER (
                PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, place)::INTEGER AS rank
            FROM s WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
    """,
}

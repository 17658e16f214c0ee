"""Benchmark decontamination: SimHash windows, Hamming blocks, exact verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstream.llm.common import digest_of, text_of, words_of
from barstream.session import staged

SHINGLE = 5
#: With 12 blocks, fingerprints within 23 bits agree in one block but for one bit.
#: Edge-trimmed passages of a similarity of 0.8 were up to 20 bits from their item.
RADIUS = 23


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, not once per use."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _words(text: str | Column) -> Column:
    return words_of(F.lower(text_of(text)))


def _shingle_hashes(words: Column) -> Column:
    """Hash of each five-word shingle in order; of the whole text if it is shorter.

    Words are hashed once; a shingle's hash is that of its word hashes (nulls past the
    end of a short text do not enter it).
    """

    def of(hashes):
        starts = F.sequence(F.lit(0), F.greatest(F.size(hashes) - SHINGLE, F.lit(0)))
        return F.transform(starts, lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(SHINGLE))))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), of)


def _shingles(words: Column) -> Column:
    """The number of shingles of so many words."""
    return F.greatest(words - (SHINGLE - 1), F.lit(1))


def _least_hits(similarity: float) -> Column:
    """The shingles that a window and an item of ``length`` words share at least."""
    both = _shingles(F.least("n", "length")) + _shingles(F.col("length"))
    least = F.ceil(both * F.lit(similarity / (1 + similarity)) - F.lit(1e-6)).cast("int")
    return F.greatest(least, F.lit(1))


def _window_starts(similarity: float) -> Column:
    """Starts of the windows of ``length`` words that may reach the similarity.

    ``hits`` are the sorted positions, in a text of ``n`` words, of shingles that occur
    in items of that length.  Moving any window right to its next hit, or to the end of
    the text, loses nothing it shares with an item, so it can start at a hit, or is the
    last one.  It shares at most as many shingles as it holds hits.
    """
    have = _shingles(F.least("n", "length"))
    last = F.greatest(F.col("n") - F.col("length"), F.lit(0))

    def of(need):
        first = F.sequence(F.lit(0), F.greatest(F.size("hits") - need, F.lit(0)))
        enough = F.filter(
            first, lambda k: F.get("hits", k + need - 1) < F.get("hits", k) + have
        )
        return F.array_distinct(F.transform(enough, lambda k: F.least(F.get("hits", k), last)))

    return _let(_least_hits(similarity), of)


def _blocks() -> list[tuple[int, int]]:
    count = (RADIUS + 1) // 2
    cuts = [64 * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _simhash(rows: DataFrame, *keys: str) -> DataFrame:
    """``keys, fp``: SimHash over the word occurrences in column ``word``."""
    hashed = rows.select(*keys, F.xxhash64("word").alias("h"))
    ones = [F.sum(F.shiftrightunsigned("h", b).bitwiseAND(F.lit(1))).alias(f"b{b}") for b in range(64)]
    counted = hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *ones)
    fp = F.lit(0).cast("long")
    for b in range(64):
        bit = (1 << b) if b < 63 else -(1 << 63)
        fp = fp.bitwiseOR(F.when(F.col(f"b{b}") * 2 > F.col("n"), F.lit(bit)).otherwise(F.lit(0)))
    return counted.select(*keys, fp.alias("fp"))


def _block_rows(fps: DataFrame, *keys: str, variants: bool) -> DataFrame:
    """A row per block of a fingerprint; with ``variants`` also all one-bit changes of it."""
    rows = []
    for number, (first, width) in enumerate(_blocks()):
        block = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))
        changes = [0] + [1 << b for b in range(width)] if variants else [0]
        rows += [
            F.struct(F.lit(number).alias("block"), block.bitwiseXOR(F.lit(c).cast("long")).alias("bits"))
            for c in changes
        ]
    return fps.select(*keys, "fp", F.inline(F.array(*rows)))


def _counted(rows: DataFrame, *keys: str) -> DataFrame:
    """``keys, shingle, n``: a text's shingles (column ``words``) and how often each occurs."""
    return (
        rows.select(*keys, F.explode(_shingle_hashes(F.col("words"))).alias("shingle"))
        .groupBy(*keys, "shingle")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def leaked_texts(
    docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, text_col: str = "text"
) -> DataFrame:
    """``digest, item_id, similarity, leaks``: texts that hold a benchmark passage.

    All windows of a text of the length of some item count, the whole text where it is
    shorter.  Those that could reach ``similarity`` are told by the shingles they share
    with items of their length (``_window_starts``).  Each gets a SimHash of its words.  Items
    are indexed by length and blocks of their SimHash with every one-bit change, windows
    look up their blocks, which finds every item within ``RADIUS`` bits, and the weighted
    Jaccard similarity of the five-word shingles, weighted by occurrences, decides.

    Words are lower-cased and separated by blanks.  Items without words match nothing,
    items of fewer than five words only texts of just these words.  Items of the same
    words are one item under their smallest id.  Copies of a text are one text here,
    so a passage or text however frequent is examined once.  Without documents or items
    there are no rows; other columns of both tables are not looked at.
    """
    items = benchmark.select("item_id", _words("text").alias("words")).where(F.size("words") > 0)
    items = staged(
        items.groupBy("words")
        .agg(F.min("item_id").alias("item_id"))
        .select(
            "item_id",
            "words",
            F.xxhash64("words").alias("item"),
            F.size("words").alias("length"),
        ),
        "leak-items",
    )
    sought = staged(
        items.select("length", F.explode(_shingle_hashes(F.col("words"))).alias("shingle")).distinct(),
        "leak-shingles",
    )
    texts = docs.select(F.col(text_col).alias("text")).where("text is not null")
    texts = texts.select(digest_of(F.col("text")).alias("digest"), "text")
    hashed = texts.select("digest", _shingle_hashes(_words("text")).alias("shingles"))
    shingled = hashed.select("digest", F.posexplode("shingles"))
    hits = shingled.toDF("digest", "pos", "shingle").join(sought, "shingle")
    # One row a text and length: no longer than the text itself, and copies add nothing.
    hits = staged(
        hits.groupBy("digest", "length").agg(F.sort_array(F.collect_set("pos")).alias("hits")),
        "leak-hits",
    )
    suspects = staged(hits.select("digest").distinct(), "leak-suspects")
    bodies = texts.join(suspects, "digest").groupBy("digest").agg(F.min("text").alias("text"))
    bodies = staged(bodies.select("digest", _words("text").alias("words")), "leak-bodies")
    sized = hits.join(bodies.select("digest", F.size("words").alias("n")), "digest")
    starts = sized.where(F.size("hits") >= _least_hits(similarity)).select(
        "digest", "length", F.explode(_window_starts(similarity)).alias("start")
    )
    cut = staged(
        staged(starts, "leak-starts")
        .join(bodies, "digest")
        .select(
            "digest",
            "length",
            "start",
            F.slice("words", F.col("start") + 1, F.col("length")).alias("words"),
        ),
        "leak-cut",
    )
    window = ["digest", "length", "start"]
    window_fps = _simhash(cut.select(*window, F.explode("words").alias("word")), *window)
    item_fps = _simhash(items.select("item", "length", F.explode("words").alias("word")), "item", "length")
    index = _block_rows(item_fps, "item", "length", variants=True).withColumnRenamed("fp", "item_fp")
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS
    pairs = staged(
        _block_rows(window_fps, *window, variants=False)
        .join(staged(index, "leak-index"), ["length", "block", "bits"])
        .where(close)
        .select(*window, "item")
        .distinct(),
        "leak-pairs",
    )
    in_items = _counted(items.select("item", "words"), "item").withColumnRenamed("n", "m")
    in_windows = _counted(cut.join(pairs.select(*window).distinct(), window), *window)
    shared = (
        pairs.join(in_windows, window)
        .join(in_items, ["item", "shingle"])
        .groupBy(*window, "item")
        .agg(F.sum(F.least("n", "m")).alias("common"))
    )
    sizes = cut.select(*window, _shingles(F.size("words")).alias("have"))
    wanted = items.select("item", "item_id", _shingles(F.col("length")).alias("want"))
    rated = shared.join(sizes, window).join(wanted, "item")
    alike = F.col("common") / (F.col("have") + F.col("want") - F.col("common"))
    found = rated.withColumn("similarity", alike).where(F.col("similarity") >= similarity)
    by_item = found.groupBy("digest", "item", "item_id").agg(F.max("similarity").alias("similarity"))
    best = F.max_by("item_id", F.struct("similarity", -F.coalesce("item_id", F.lit(0))))
    return staged(
        by_item.groupBy("digest").agg(
            best.alias("item_id"),
            F.max("similarity").alias("similarity"),
            F.count(F.lit(1)).alias("leaks"),
        ),
        "leaked-texts",
    )


def find_leaks(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``doc_id, contaminated, item_id, similarity, leaks`` for every input row.

    ``item_id`` is the most similar item, of equals the smallest; ``leaks`` counts the
    items found.  Null and blank texts are clean.
    """
    leaked = leaked_texts(docs, benchmark, **how)
    rows = docs.select("doc_id", digest_of(text_of("text")).alias("digest"))
    return rows.join(leaked, "digest", "left").select(
        "doc_id",
        F.col("leaks").isNotNull().alias("contaminated"),
        "item_id",
        "similarity",
        F.coalesce("leaks", F.lit(0)).cast("long").alias("leaks"),
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents without a benchmark passage; all columns as they came."""
    leaked = leaked_texts(docs, benchmark, **how).select(F.col("digest").alias("__leak_digest"))
    return docs.join(
        leaked, digest_of(text_of(docs["text"])) == F.col("__leak_digest"), "left_anti"
    )

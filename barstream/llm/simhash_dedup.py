"""SimHash near-dedup by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barstream.llm.common import NON_BLANKS, digest_of, text_of
from barstream.llm.components import components
from barstream.session import staged

SEED = 42
#: Shingles whose bits are counted at once: bounds the memory of a very long text.
SLICE = 1 << 16
#: Nodes whose 64 signatures one task writes.
NODES_PER_TASK = 10_000


def _hashes(words: list[bytes], size: int) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    last = max(1, len(words) - size + 1)
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(b" ".join(words[i : i + size]), SEED) for i in range(last)), np.uint64, last
    )


def majority(hashes: np.ndarray) -> int:
    """The signed 64-bit number whose bits are set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SLICE):
        piece = hashes[at : at + SLICE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(piece, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint(text: str | None, size: int, distinct: bool = False) -> int:
    """SimHash of the word shingles of a text, lower-cased in A-Z; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    hashes = _hashes(words, size)
    return majority(np.unique(hashes) if distinct else hashes)


def fingerprint_of(text: Column, size: int, distinct: bool = False) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, size, distinct) for t in texts], dtype="int64")

    return of(text)


def shingles_of(text: Column, size: int) -> Column:
    """The distinct hashes of a text's word shingles, as an array."""

    @F.pandas_udf("array<long>")
    def of(texts: pd.Series) -> pd.Series:
        words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
        return pd.Series([np.unique(_hashes(w, size)).view(np.int64) for w in words])

    return of(text)


def segments(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of the fewest segments of which one differs by one bit at most."""
    count = max(1, (radius + 2) // 2)
    cuts = [64 * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _signed(number: int) -> int:
    """The 64-bit two's complement value."""
    return (number + (1 << 63)) % (1 << 64) - (1 << 63)


def signatures(nodes: DataFrame, radius: int) -> DataFrame:
    """64 rows per node: each segment with each of its bits in turn made a wildcard."""
    variants = []
    for first, width in segments(radius):
        segment = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit(_signed((1 << width) - 1)))
        for bit in range(width):
            variants.append(
                F.struct(
                    F.lit(first + bit).cast("byte").alias("slot"),
                    segment.bitwiseAND(F.lit(_signed(~(1 << bit)))).alias("rest"),
                )
            )
    return nodes.select("node", "fp", F.explode(F.array(*variants)).alias("s")).select(
        "node", "fp", "s.slot", "s.rest"
    )


def near_links(
    nodes: DataFrame, radius: int, verify: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Links ``a, b`` that connect what lies within ``radius`` bits, without all pairs.

    ``nodes`` has one row per different content: ``node``, ``fp``.  By the pigeonhole
    principle two nodes within the radius share a bucket, that is a segment with one
    bit deleted.  The members of a bucket pass one window in order, of which a task
    holds one row at a time.  First every node is linked to the smallest node of each of its
    buckets, if that is within the radius and ``verify`` accepts it.  Then only buckets
    that still hold several components are joined with themselves, and only pairs of
    different components come out.  Every pair within the radius ends up verified or
    already connected, so no component is lost, and a group of copies gives links in
    proportion to its size.
    """
    verify = verify or (lambda pairs: pairs)
    close = F.bit_count(F.col("p.fp").bitwiseXOR(F.col("q.fp"))) <= radius
    tasks = max(1, -(-nodes.count() // NODES_PER_TASK))
    bucket = Window.partitionBy("slot", "rest").orderBy("node")
    upto = bucket.rowsBetween(Window.unboundedPreceding, 0)
    members = staged(
        signatures(nodes.repartition(tasks, "node"), radius)
        .withColumn("least", F.first(F.struct("node", "fp")).over(upto))
        .withColumn("next", F.lead("node").over(bucket))
        .where((F.col("least.node") != F.col("node")) | F.col("next").isNotNull())
        .drop("next"),
        "bucket-members",
    )
    stars = members.select(
        F.col("least.node").alias("a"),
        F.col("node").alias("b"),
        F.bit_count(F.col("fp").bitwiseXOR(F.col("least.fp"))).alias("bits"),
    )
    stars = stars.where((F.col("bits") <= radius) & (F.col("a") != F.col("b")))
    links = staged(verify(stars.select("a", "b").distinct()), "star-links")
    roots = staged(components(links), "star-roots")
    known = members.select("slot", "rest", "node", "fp").join(roots, "node", "left")
    known = known.withColumn("root", F.coalesce("root", "node"))
    open_ = staged(
        known.groupBy("slot", "rest")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low <> high")
        .select("slot", "rest"),
        "open-buckets",
    )
    left = staged(known.join(open_, ["slot", "rest"]), "open-members")
    across = (
        left.alias("p")
        .join(
            left.alias("q"),
            (F.col("p.slot") == F.col("q.slot"))
            & (F.col("p.rest") == F.col("q.rest"))
            & (F.col("p.root") < F.col("q.root"))
            & close,
        )
        .select(F.col("p.node").alias("a"), F.col("q.node").alias("b"))
        .distinct()
    )
    return links.unionByName(staged(verify(across), "cross-links"))


def _lead(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node, component_id``: the smallest id among the documents of a component."""
    roots = staged(components(links), "roots")
    rooted = staged(
        nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")),
        "rooted",
    )
    leads = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return staged(rooted.join(leads, "root").select("node", "component_id"), "components")


def fingerprint_components(
    docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every input row.

    Fingerprints within ``radius`` bits are linked; ``component_id`` is the smallest
    document id that is reachable.  Null texts count as empty, texts without words get
    fingerprint zero and are linked like any other.  Null ids never lead a component
    unless all of it has none.  Rows that repeat an id each get their own row.
    """
    rows = staged(
        docs.select(
            F.col(id_col).alias("doc_id"), fingerprint_of(F.col(text_col), shingle).alias("fp")
        ),
        "fingerprints",
    )
    nodes = staged(
        rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")).withColumn("node", F.col("fp")),
        "nodes",
    )
    found = _lead(nodes, near_links(nodes, radius))
    return rows.join(found.withColumnRenamed("node", "fp"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


#: Independently mixed fingerprints of a text; one within reach of another's is enough.
FINGERPRINTS = 6
#: Up to so many wanted digests go to every task that reads texts; beyond, texts are shuffled.
BROADCAST_ROWS = 200_000


def _mixed(hashes: np.ndarray, number: int) -> np.ndarray:
    """The hashes behind another 64-bit mixing, as if of another seed."""
    h = hashes + np.uint64((0x9E3779B97F4A7C15 * (number + 1)) % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fingerprints_of(text: Column, count: int) -> Column:
    """SimHashes of the different words of a text, lower-cased in A-Z, as an array."""

    @F.pandas_udf("array<long>")
    def of(texts: pd.Series) -> pd.Series:
        words = ((t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts)
        hashes = (np.unique(_hashes(w, 1)) for w in words)
        return pd.Series([[majority(_mixed(h, i)) for i in range(count)] for h in hashes])

    return of(text)


def _identity(text: Column) -> Column:
    """The digest of a text; those without words share that of the empty text."""
    text = text_of(text)
    return digest_of(F.when(text.rlike(NON_BLANKS), text).otherwise(""))


def bucket_members(nodes: DataFrame, count: int, tasks: int = 1) -> DataFrame:
    """``key, node, near, least``: who shares a segment or one that differs by one bit.

    Each of the ``count`` fingerprints (``fps``) has two segments of 32 bits; ``key`` is one
    such segment.  Two nodes within 3 bits in some fingerprint have a segment in common or
    two that differ by one bit, as do others.  Nodes of one segment are a group, and only
    the groups are brought together with each bit made a wildcard, so a group
    of copies is not repeated for each bit.  ``near`` are the adjacent groups: of two, the
    one with fewer nodes names the other.  ``least`` is the smallest node of the group and
    all adjacent ones.  Nodes alone in a group without adjacent ones are left out.
    """
    word = (1 << 32) - 1
    pieces = []
    for number in range(count):
        for slot, (first, _) in enumerate(segments(3)):
            segment = F.shiftrightunsigned(F.col("fps")[number], first).bitwiseAND(F.lit(word))
            pieces.append(segment.bitwiseOR(F.lit((number * 2 + slot) << 32)))
    rows = nodes.select("node", F.explode(F.array(*pieces)).alias("key"))
    groups = rows.repartition(tasks, "key").groupBy("key").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n"))
    groups = staged(groups, "segment-groups")
    bits = F.explode(F.array(*[F.lit(b) for b in range(32)])).alias("bit")
    wild = groups.repartition(tasks, "key").select("*", bits).withColumn("one", F.expr("shiftleft(1L, bit)"))
    rest = F.col("key").bitwiseAND(F.bitwise_not("one"))
    wild = wild.select(
        rest.bitwiseOR(F.shiftleft(F.col("bit").cast("long"), 56)).alias("bucket"), "key", "least", "n"
    )
    bucket = Window.partitionBy("bucket").orderBy("key")
    pairs = wild.withColumn("other", F.lead(F.struct("key", "least", "n")).over(bucket)).where("other IS NOT NULL")
    pairs = staged(pairs.select("key", "least", "n", "other"), "adjacent-groups")
    here = F.when(F.col("n") <= F.col("other.n"), F.col("other.key"))
    there = F.when(F.col("n") > F.col("other.n"), F.col("key"))
    around = pairs.select("key", F.col("other.least").alias("beyond"), here.alias("name"))
    around = around.unionByName(pairs.select(F.col("other.key").alias("key"), F.col("least").alias("beyond"), there.alias("name")))
    around = around.groupBy("key").agg(F.min("beyond").alias("beyond"), F.collect_list("name").alias("near"))
    kept = groups.join(around, "key", "left").where("n > 1 OR near IS NOT NULL")
    kept = kept.select(
        "key", F.least("least", "beyond").alias("least"), F.coalesce("near", F.array().cast("array<bigint>")).alias("near")
    )
    return rows.join(kept, "key").select("key", "node", "near", "least")


def _wanted_texts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``digest, text`` once for each digest of ``wanted``."""
    once = F.first("text").alias("text")
    if wanted.count() <= BROADCAST_ROWS:
        return texts.join(F.broadcast(wanted), "digest", "left_semi").groupBy("digest").agg(once)
    return texts.groupBy("digest").agg(once).join(wanted, "digest", "left_semi")


def sketch_of(set_: Column) -> Column:
    """Which of the buckets of a set hold an odd number of its hashes, as 64-bit words.

    There are 64 buckets for every started 64 hashes, rounded up to a power of two.
    """

    @F.pandas_udf("array<long>")
    def of(sets: pd.Series) -> pd.Series:
        out = []
        for s in sets:
            s = np.asarray(s, np.int64).view(np.uint64)
            bits = 64 << max(0, (len(s) - 1) // 64).bit_length()
            odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
            out.append(np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8"))
        return pd.Series(out)

    return of(set_)


def _may_pass(p: str, q: str, similarity: float) -> Column:
    """Whether two sets, by their sizes ``n`` and sketches, can be so similar; none that is fails.

    A bucket that is odd in one set alone holds a hash of that set alone or the other, so
    such buckets are at most as many as the hashes that the sets do not share.  The longer
    of two sketches is folded to the length of the other.
    """
    x, y, n, m = f"{p}.sketch", f"{q}.sketch", F.col(f"{p}.n"), F.col(f"{q}.n")

    def folded(s: str) -> str:
        half = f"size({s}) div 2"
        return f"zip_with(slice({s}, 1, int({half})), slice({s}, int({half}) + 1, int({half})), (a, b) -> a ^ b)"

    def odd(s: str, t: str) -> str:
        return f"aggregate(zip_with({s}, {t}, (a, b) -> bit_count(a ^ b)), 0, (sum, v) -> sum + v)"

    apart = F.expr(
        f"""CASE WHEN size({x}) = size({y}) THEN {odd(x, y)}
                 WHEN size({x}) = 2 * size({y}) THEN {odd(folded(x), y)}
                 WHEN 2 * size({x}) = size({y}) THEN {odd(x, folded(y))} ELSE 0 END"""
    )
    near = F.least(n, m) >= similarity * F.greatest(n, m)
    return near & (apart * (1 + similarity) <= (n + m) * (1 - similarity) + 1e-6)


def _verified(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose shingle sets are at least so similar.

    Sets are only moved for pairs that their sketches let through.
    """
    near = pairs.join(sketches.alias("p"), F.col("a") == F.col("p.node"))
    near = near.join(sketches.alias("q"), F.col("b") == F.col("q.node"))
    near = staged(near.where(_may_pass("p", "q", similarity)).select("a", "b"), "near-pairs")

    def side(end: str) -> DataFrame:
        own = near.select(F.col(end).alias("node")).distinct()
        return sets.join(own, "node", "left_semi").select(F.col("node").alias(end), F.col("set").alias(f"s{end}"))

    sided = near.join(side("b"), "b").join(side("a"), "a")
    both = F.size(F.array_intersect("sa", "sb"))
    either = F.size("sa") + F.size("sb") - both
    return sided.where((either == 0) | (both >= similarity * either)).select("a", "b")


def _open_members(members: DataFrame, links: DataFrame, purpose: str) -> DataFrame:
    """The members, with their ``root`` by ``links``, of groups that meet another root.

    That is in the group itself or in an adjacent one; ``near`` keeps the adjacent groups of that kind.
    """
    roots = staged(components(links), f"{purpose}-roots")
    rooted = members.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = staged(rooted, f"{purpose}-rooted")
    spans = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.first("near").alias("near"))
    spans = staged(spans, f"{purpose}-spans")
    far = spans.select(F.col("key").alias("other"), F.col("low").alias("far_low"), F.col("high").alias("far_high"))
    edges = spans.select("key", "low", "high", F.explode("near").alias("other")).join(far, "other")
    edges = edges.where(F.least("low", "far_low") != F.greatest("high", "far_high")).select("key", "other")
    open_ = spans.where("low <> high").select("key", F.lit(None).cast("long").alias("other"))
    open_ = open_.unionByName(edges).unionByName(edges.select(F.col("other").alias("key"), F.lit(None).cast("long").alias("other")))
    open_ = open_.groupBy("key").agg(F.collect_list("other").alias("near"))
    return staged(rooted.drop("near").join(open_, "key"), f"{purpose}-open")


def _stars(members: DataFrame) -> DataFrame:
    """Pairs ``a, b``: each node with the smallest around it, of its group and of the adjacent ones that it names.

    Only of different roots; at most two for each member and one for each adjacent group.
    """
    heads = members.groupBy("key").agg(F.min(F.struct("node", "root")).alias("head"))
    heads = heads.select(F.col("key").alias("at"), F.col("head.node").alias("a"), F.col("head.root").alias("led"))
    around = members.select("node", "root", F.explode(F.concat(F.array("key"), "near")).alias("at"))
    inner = around.join(heads, "at").where("root <> led").select("a", F.col("node").alias("b")).distinct()
    led = members.select(F.col("node").alias("a"), F.col("root").alias("led")).distinct()
    outer = members.where("least <> node").select(F.col("least").alias("a"), F.col("node").alias("b"), "root").distinct()
    outer = outer.join(led, "a").where("root <> led").select("a", "b")
    return inner.unionByName(outer).distinct()


def _prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """``node, prefix``: a set's first ``n - ceil(similarity n) + 1`` shingles.

    All sets are in one order, that of the hashes, so two that are so similar share one
    of these.  Each is shortened to 16 bits, which only lets more pairs through.
    """
    n = F.size("set")
    first = F.slice("set", 1, (n - F.ceil(similarity * n - 1e-9) + 1).cast("int"))
    short = F.transform(first, lambda s: (s.bitwiseAND(F.lit(65_535)) - 32_768).cast("short"))
    return sets.select("node", short.alias("prefix"))


def _across(members: DataFrame, similarity: float | None = None) -> DataFrame:
    """All pairs ``a, b`` of different roots in one group or two adjacent ones that share a shingle of their ``prefix``.

    With ``similarity`` only those whose sizes ``n`` and ``sketch`` let them be so similar.
    A pair comes at most once a segment.
    """
    meet = F.arrays_overlap("p.prefix", "q.prefix")
    meet = meet if similarity is None else _may_pass("p", "q", similarity) & meet
    several = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    inside = members.join(several.select("key"), "key", "left_semi")
    inside = inside.alias("p").join(
        inside.alias("q"), (F.col("p.key") == F.col("q.key")) & (F.col("p.root") < F.col("q.root")) & meet
    )
    beside = members.withColumn("other", F.explode("near")).alias("p")
    beside = beside.join(
        members.alias("q"), (F.col("p.other") == F.col("q.key")) & (F.col("p.root") != F.col("q.root")) & meet
    )
    ahead = F.col("p.root") < F.col("q.root")
    p, q = F.col("p.node"), F.col("q.node")
    beside = beside.select(F.when(ahead, p).otherwise(q).alias("a"), F.when(ahead, q).otherwise(p).alias("b"))
    return inside.select(p.alias("a"), q.alias("b")).unionByName(beside).distinct()


def near_duplicates(
    docs: DataFrame,
    fingerprints: int = FINGERPRINTS,
    shingle: int = 5,
    similarity: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``digest, component_id``: the near-duplicate group of every different text.

    Candidates come from SimHashes over the different words of a text: a few replaced
    words move them by few bits, while they move a fingerprint of five-word shingles (by
    9 bits in the middle, at a similarity of 0.8) out of any radius that can be
    searched.  Texts are candidates where some segment of some fingerprint differs by
    one bit at most, which takes in all that lie within 3 bits.  First every text is
    held against the smallest it shares a bucket with, then against the smallest around
    each of its segments that still meets several components, and in the end the members of
    such segments against those of other components, where the first shingles
    and the sketches of their sets allow it; so no candidate pair is left out but those that are
    connected already or cannot pass.  Links are verified by the exact Jaccard
    similarity of the five-word shingles, at least ``similarity``.  Texts without
    words are copies of each other.  An empty table has no group.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    texts = texts.withColumn("digest", _identity(F.col("text")))
    nodes = staged(
        texts.select("digest", "doc_id", fingerprints_of(F.col("text"), fingerprints).alias("fps"))
        .groupBy("digest")
        .agg(F.min("doc_id").alias("least_id"), F.first("fps").alias("fps"))
        .withColumn("node", F.monotonically_increasing_id()),
        "text-nodes",
    )
    tasks = max(1, -(-nodes.count() // NODES_PER_TASK))
    members = staged(bucket_members(nodes.select("node", "fps"), fingerprints, tasks), "bucket-members")
    held = nodes.select("node", "digest").join(members.select("node").distinct(), "node", "left_semi")
    held = staged(held, "candidate-texts")
    body = _wanted_texts(texts.select("digest", "text"), held.select("digest"))
    sets = body.select("digest", shingles_of(F.col("text"), shingle).alias("set")).join(held, "digest")
    sets = staged(sets.select("node", "set"), "shingle-sets")
    sketches = staged(sets.select("node", F.size("set").alias("n"), sketch_of(F.col("set")).alias("sketch")), "sketches")
    stars = members.groupBy(F.col("node").alias("b")).agg(F.min("least").alias("a")).where("a <> b")
    links = staged(_verified(stars, sketches, sets, similarity), "star-links")
    left = _open_members(members, links, "star")
    stars = _stars(left)
    links = links.unionByName(staged(_verified(stars, sketches, sets, similarity), "bucket-links"))
    left = _open_members(left, links, "bucket")
    marks = _prefixes(sets, similarity).join(sketches, "node")
    across = staged(_across(left.join(marks, "node"), similarity), "cross-pairs")
    links = links.unionByName(staged(_verified(across, sketches, sets, similarity), "cross-links"))
    return _lead(nodes, links).join(nodes.select("node", "digest"), "node").select("digest", "component_id")


def drop_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """The documents that lead their group; all columns as they came.

    Rows that share an id are one document and stay or go together.
    """
    groups = near_duplicates(docs, **how).select(
        F.col("digest").alias("__near_digest"), F.col("component_id").alias("__near_lead")
    )
    joined = docs.join(groups, _identity(docs["text"]) == F.col("__near_digest"))
    kept = joined.where(docs["doc_id"].eqNullSafe(F.col("__near_lead")))
    return kept.select(*[docs[c] for c in docs.columns])

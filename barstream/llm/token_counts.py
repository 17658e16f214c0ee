"""Token counts of whole texts, kept in a cache by content and tokenizer digest."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from importlib import metadata
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barstream.llm.common import text_of
from barstream.session import scratch, staged

#: Up to so many missing digests go to every task; beyond, texts and digests are shuffled.
BROADCAST_ROWS = 200_000
#: Characters that go to the tokenizer in one call.
AT_ONCE = 1 << 20
COUNTS = "digest binary, n_tokens long"
LIBRARIES = {"json": "tokenizers", "model": "sentencepiece", "tiktoken": "tiktoken"}


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer file by content; ``version`` tells file, library and its release apart."""

    kind: str
    content: bytes
    pattern: str = ""

    @classmethod
    def read(cls, path: str, pattern: str = "") -> Tokenizer:
        """A ``.json``, ``.model`` or ``.tiktoken`` file, the last with its splitting pattern."""
        return cls(Path(path).suffix[1:], Path(path).read_bytes(), pattern)

    @property
    def version(self) -> str:
        library = LIBRARIES[self.kind]
        named = f"{library} {metadata.version(library)} {self.pattern}\n"
        return hashlib.sha256(named.encode() + self.content).hexdigest()

    def counter(self) -> Callable[[list[str]], list[int]]:
        """Counts of a list of texts, without added special tokens, uncut and unpadded."""
        if self.kind == "model":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=self.content)
            return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        if self.kind == "json":
            from tokenizers import Tokenizer as Json

            loaded = Json.from_str(self.content.decode())
            loaded.no_truncation()
            loaded.no_padding()
            return lambda texts: [len(e) for e in loaded.encode_batch(texts, add_special_tokens=False)]
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.content.splitlines())}
        loaded = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [len(loaded.encode_ordinary(t)) for t in texts]


def _text(value: pa.Scalar) -> str:
    return value.as_buffer().to_pybytes().decode("utf-8", "replace") if value.is_valid else ""


def _encode(tokenizer: Tokenizer) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in batches:
            count = count or tokenizer.counter()
            counts, waiting, size = [], [], 0
            for value in batch.column("text"):
                waiting.append(_text(value))
                size += len(waiting[-1])
                if size >= AT_ONCE:
                    counts += count(waiting)
                    waiting, size = [], 0
            counts += count(waiting)
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"]
            )

    return run


class TokenCache:
    """Stored counts: a Parquet dataset with a folder for each tokenizer version.

    Files are only added, each by a job that commits whole.  Two jobs that count
    the same text at once store its row twice; ``read`` returns it once.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, version: str) -> str:
        return f"{self.path}/version={version}"

    def read(self, version: str) -> DataFrame:
        """``digest, n_tokens`` of one tokenizer version; no row where nothing is stored."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder(version))
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], COUNTS)
        stored = self.spark.read.schema(COUNTS).parquet(self._folder(version))
        return stored.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))

    def append(self, version: str, counts: DataFrame) -> None:
        counts.write.mode("append").parquet(self._folder(version))


def content_digest(text: Column) -> Column:
    """SHA-256 of a text's UTF-8 bytes, null as empty.

    This is all that can be normalised: any other folding changes the tokens of some text.
    """
    return F.unhex(F.sha2(text.cast("binary"), 256))


def missing_counts(texts: DataFrame, missing: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``digest, n_tokens`` of the texts (``digest, text``) whose digest is in ``missing``.

    Every different text is encoded once.  A few missing digests are sent to the
    texts, so that only texts to encode move; many are met by the texts after
    copies have been collapsed where they lie.
    """
    once = F.first("text").alias("text")
    if missing.count() <= BROADCAST_ROWS:
        picked = texts.join(F.broadcast(missing), "digest", "left_semi").groupBy("digest").agg(once)
    else:
        picked = texts.groupBy("digest").agg(once).join(missing, "digest", "left_semi")
    return picked.mapInArrow(_encode(tokenizer), COUNTS)


def count_tokens(
    docs: DataFrame,
    tokenizer: Tokenizer,
    cache: TokenCache | None = None,
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every input row.

    Digests of the texts meet the stored counts of this tokenizer version; only
    different texts without one are encoded, and their counts are appended.  Without
    ``cache`` an empty one is used.  Null texts count as empty and have no token.
    Rows that repeat an id or a text each get their own row; null ids stay null; an
    empty table gives no row; other columns are not read, whatever their names.
    Invalid UTF-8 is read with replacement characters.
    """
    spark = docs.sparkSession
    cache = cache or TokenCache(spark, scratch(spark, "token-cache"))
    version = tokenizer.version
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = staged(
        texts.select(
            "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
            content_digest(F.col("text")).alias("digest"),
        ),
        "text-digests",
    )
    wanted = staged(
        rows.select("digest").distinct().join(cache.read(version), "digest", "left"), "cache-lookup"
    )
    missing = wanted.where("n_tokens IS NULL").select("digest")
    if not missing.isEmpty():
        keyed = texts.select(content_digest(F.col("text")).alias("digest"), "text")
        cache.append(version, missing_counts(keyed, missing, tokenizer))
        wanted = staged(
            wanted.select("digest").join(cache.read(version), "digest", "left"), "token-counts"
        )
    return rows.join(wanted, "digest", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )

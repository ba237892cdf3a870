"""Token counts through a cache keyed by content and tokenizer digests."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.sources.staging import stage

CACHE_SCHEMA = "tokenizer string, digest string, n_tokens long"
#: Most distinct pieces whose counts a Python worker remembers.
MEMO = 1_000_000
#: Most missing digests that are broadcast, some 30 MB.
FEW = 200_000

_workers: dict[str, tuple[object, dict[bytes, int]]] = {}


@dataclass(frozen=True)
class Vocabulary:
    """A vocabulary file's bytes, as they are sent to executors, and their SHA-256: another file is another version."""

    raw: bytes
    version: str

    @staticmethod
    def read(path: str) -> Vocabulary:
        raw = Path(path).read_bytes()
        return Vocabulary(raw, hashlib.sha256(raw).hexdigest())


def collapse_white_space(text: Column) -> Column:
    """Runs of ASCII white space as one blank: the same tokens for a tokenizer that drops white space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def _encoder(vocabulary: Vocabulary) -> tuple[object, dict[bytes, int]]:
    """This worker's tokenizer, made once of bytes that have the digest under which counts are stored."""
    if vocabulary.version not in _workers:
        import os

        if hashlib.sha256(vocabulary.raw).hexdigest() != vocabulary.version:
            raise ValueError("the vocabulary's bytes are not those of its digest")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        _workers[vocabulary.version] = (Tokenizer.from_buffer(vocabulary.raw), {})
    return _workers[vocabulary.version]


def count_pieces(texts: list[str], vocabulary: Vocabulary) -> list[int]:
    """Tokens of each text, for a tokenizer none of whose tokens spans ASCII white space.

    A text's count is then the sum over its pieces, and each distinct piece goes through
    the tokenizer once; no text is cut short.
    """
    tokenizer, memo = _encoder(vocabulary)
    pieces = [t.encode().split() for t in texts]
    new = list(set().union(*pieces).difference(memo)) if pieces else []
    if len(memo) + len(new) > MEMO:
        memo.clear()
        new = list(set().union(*pieces))
    for k in range(0, len(new), 20_000):
        part = new[k : k + 20_000]
        memo.update(zip(part, map(len, tokenizer.encode_batch_fast([p.decode() for p in part], add_special_tokens=False)), strict=True))
    return [sum(map(memo.__getitem__, p)) for p in pieces]


def count_texts(texts: list[str], vocabulary: Vocabulary) -> list[int]:
    """Tokens of each whole text, for any tokenizer."""
    tokenizer, _ = _encoder(vocabulary)
    return list(map(len, tokenizer.encode_batch_fast(texts, add_special_tokens=False)))


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    normalize: Callable[[Column], Column] = lambda text: text,
    count: Callable[[list[str], Vocabulary], list[int]] = count_texts,
) -> DataFrame:
    """Tokens of every whole text of ``docs`` (doc_id, text).

    Each normalised text's SHA-256 and the tokenizer's are looked up in the cache, a
    Parquet table that grows by appending; of the missing digests one text each is
    encoded, and the counts are appended before the answer is read from the cache. Digests
    are staged and meet the cache before any text moves: without a miss no text does, with
    up to FEW misses they are broadcast and only their texts move, with more every distinct
    text moves once. A lost executor costs only its tasks; a failed append leaves nothing
    behind, and rows that two jobs append twice are the same, so the reader drops the repeats.

    ``normalize`` must not change any count, ``count`` must agree with the library. The
    driver reads the vocabulary and sends its bytes, so executors need no file.
    Returns doc_id, n_bytes, n_tokens, one row for each input row. A null text counts as
    empty; other columns are ignored.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary.read(tokenizer_path)
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.sha2(normalize(text).cast("binary"), 256)
    if not _exists(spark, cache_path):
        spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_path)

    def known() -> DataFrame:
        return spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer") == vocabulary.version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))

    sized = stage(docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), digest.alias("digest")), "digests")
    missing = stage(sized.select("digest").distinct().join(known(), "digest", "left_anti"), "missing")
    misses = missing.count()
    if misses:
        shared, version = spark.sparkContext.broadcast(vocabulary), vocabulary.version

        def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    yield pd.DataFrame({"tokenizer": version, "digest": b["digest"], "n_tokens": count(list(b["text"]), shared.value)})

        texts = docs.select(digest.alias("digest"), text.alias("text"))
        if misses <= FEW:
            texts = texts.join(F.broadcast(missing), "digest", "left_semi")  # 64 bytes a miss
        # copies meet in the map-side half of the aggregation, so a hot text sends one row a task
        distinct = texts.groupBy("digest").agg(F.first("text").alias("text"))
        if misses > FEW:
            distinct = distinct.join(missing, "digest", "left_semi")
        distinct.mapInPandas(encode, CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    return sized.join(known(), "digest").select("doc_id", "n_bytes", "n_tokens")


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)

"""Contiguous shards of nearly equal bytes, by global prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.rows import numbered_rows
from pulseframe.llm.text import byte_count
from pulseframe.operators.ordering import prefix_sums
from pulseframe.sources.staging import stage


def shard_documents(docs: DataFrame, shards: int, overhead: int = 16, carry: Sequence[str] = ()) -> DataFrame:
    """Deal every row of ``docs`` (doc_id, text) into ``shards`` contiguous shards.

    Rows are ordered by the text's CRC-32 (nulls first), a 64-bit hash of it, then doc_id: a
    shard is a random sample, yet copies of a text lie side by side. A row's size is its
    UTF-8 bytes plus ``overhead``; its shard is the one in whose equal share of all bytes
    its middle lies, so a shard's bytes miss the target by less than one row. Texts are
    read once, for their size and hashes; the rest works on these.

    Returns one row for each input row: doc_id, size, text_crc32 (null for a null text),
    shard, slot (0, 1, ... within the shard), and the columns named in ``carry``, which
    decide between rows of one doc_id and text. Repeated rows each get a slot of their own;
    other columns of ``docs`` are ignored; an empty table gives no rows.
    """
    sized = stage(
        docs.select(
            "doc_id",
            (byte_count(F.col("text")) + overhead).alias("size"),
            F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
            F.xxhash64("text").alias("_hash"),
            *carry,
            # repeated rows can be told apart, so no range has to hold them all
            F.monotonically_increasing_id().alias("_n"),
        ),
        "shard-sizes",
    )
    placed = prefix_sums(sized, [F.col(c) for c in ("text_crc32", "_hash", "doc_id", "size", *carry, "_n")], "size", "shard-order")
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(1)).alias("_total"))
    placed = placed.crossJoin(F.broadcast(total)).withColumn(  # one row
        "shard", F.least(F.expr(f"((2 * before + size) * {shards}) div (2 * _total)"), F.lit(shards - 1)).cast("int")
    )
    firsts = placed.groupBy("shard").agg(F.min("position").alias("_first"))  # at most `shards` rows
    return placed.join(F.broadcast(firsts), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("position") - F.col("_first")).alias("slot"), *carry)


def sharded_documents(docs: DataFrame, shards: int, overhead: int = 16, stored: bool = False) -> DataFrame:
    """The rows of ``docs`` whole, with size, text_crc32, shard and slot: what a writer of shard files needs.

    Shard and slot name a row, also where the same document occurs several times. Columns
    of ``docs`` with these four names are replaced. See ``numbered_rows`` for ``stored``.
    """
    added = ("size", "text_crc32", "shard", "slot")
    numbered, row = numbered_rows(docs, "shard-documents", stored)
    plain = numbered.select(*[F.col(f"`{c}`") for c in numbered.columns if c.lower() not in added])
    placed = shard_documents(numbered.select("doc_id", "text", F.col(row).alias("_row")), shards, overhead, ("_row",))
    # places grow with the documents, so they are never broadcast
    return plain.join(placed.select(F.col("_row").alias(row), *added).hint("merge"), row).drop(row)

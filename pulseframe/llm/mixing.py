"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.llm.rows import numbered_rows
from pulseframe.llm.text import free_names, word_count
from pulseframe.operators.ordering import prefix_sums
from pulseframe.sources.staging import scratch, stage


def source_targets(sized: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Each source's share of all words.

    Sources by code point (null last) take ``weights`` in turn. A target stops at ``most``
    times its source's words and what is over goes to the others by weight, until none is
    above. Sorted by cap over weight the stopped sources come first, so running sums find
    them in one pass. Works on one row a source, in one task: millions of sources, not a
    source for each document. Returns source, source_size, target, source_start
    (words of the sources before it).
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("_level", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.select(
        "source",
        "source_size",
        F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1).alias("_weight"),
        F.coalesce(F.sum("source_size").over(by_name.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("source_start"),
        (F.col("source_size") * most).alias("_cap"),
    ).withColumn("_level", F.col("_cap") / F.col("_weight"))
    sources = sources.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(by_level), F.lit(0))).alias("_left"),
        (F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(by_level), F.lit(0))).alias("_share"),
    ).withColumn("_full", F.col("_level") < F.col("_left") / F.col("_share"))
    # the level of all others is that of the first that isn't full
    level = F.min(F.when(~F.col("_full"), F.struct("_level", F.struct(F.col("source").isNull().alias("n"), "source").alias("s"), (F.col("_left") / F.col("_share")).alias("at")))).over(everything)
    return sources.select("source", "source_size", "source_start", F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(F.col("_weight") * level["at"]).alias("target"))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: str = "mix", carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Draw documents (doc_id, source, text) so that each source's words come near its target.

    Within its source a document's place is fixed by a digest of ``seed`` and doc_id; a
    source short of its target starts over, at most ``most`` times. A copy's virtual finish
    time is the words its source has given out by its end, over the source's target, so
    every source is served in proportion and the mix has spent its budget at time 1: copies
    are sorted by finish time over all sources and cut there, at the total budget. Whole
    documents only; a source misses its target by less than one document.

    Returns two tables. Rows, one for each input row: row (its number), doc_id, source,
    text_key (a digest of the text), size, source_size, target. Draws, one for each copy:
    row, doc_id, source, text_key, size, copy, finish, position (its place in the mix),
    before (words before it). Columns named in ``carry`` come along in both and decide
    between rows that are equal otherwise; other columns are ignored. A null text has size
    0; documents without words are never drawn; a null source is a source of its own;
    repeated rows are drawn each by itself.
    """
    sized = stage(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            F.xxhash64("text").alias("text_key"),
            F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 15), 16, 10).cast("long").alias("_place"),
            *carry,
            # rows equal in all else can be told apart, so no range has to hold them all
            F.monotonically_increasing_id().alias("_n"),
        ),
        "mix-sizes",
    )
    order = [F.col("source").asc_nulls_last(), *[F.col(c) for c in ("_place", "doc_id", "size", "text_key", *carry, "_n")]]
    placed = prefix_sums(sized, order, "size", "mix-sources")
    targets = stage(source_targets(sized, weights, most), "mix-targets").withColumnRenamed("source", "_source")
    rows = stage(
        placed.join(targets, F.col("source").eqNullSafe(F.col("_source"))).select(
            F.col("position").alias("row"), "doc_id", "source", "text_key", *carry, "size", "source_size", "target", (F.col("before") + F.col("size") - F.col("source_start")).alias("_end")
        ),
        "mix-rows",
    )
    served = F.col("copy") * F.col("source_size") + F.col("_end")
    draws = (
        rows.where("size > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
        .where(served <= F.col("target"))
        .select("row", "doc_id", "source", "text_key", *carry, "size", "copy", (served / F.col("target")).alias("finish"))
    )
    mixed = prefix_sums(draws, [F.col("finish"), F.col("row"), F.col("copy")], "size", "mix-draws")
    budget = targets.agg(F.sum("source_size").alias("_budget"))  # one row
    mixed = mixed.crossJoin(F.broadcast(budget)).where(F.col("before") + F.col("size") <= F.col("_budget")).drop("_budget")
    return rows.drop("_end"), mixed


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: str = "mix", stored: bool = False) -> DataFrame:
    """``docs`` (doc_id, source, text and any others) with every row as often as the mix draws it, none that it doesn't.

    Rows are numbered (see ``numbered_rows`` for ``stored``), so whole texts are moved once,
    to the counts of their own draws. Rows equal in doc_id, source and text are told apart
    by a hash of all columns, so a rerun draws the same ones. Columns come out unchanged,
    whatever their names.
    """
    numbered, row = numbered_rows(docs, "mix-documents", stored)
    (count,) = free_names(numbered, "_count")
    with scratch(docs.sparkSession) as keep:
        maps = [c for c, kind in docs.dtypes if "map<" in kind]
        hashed = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) if c in maps else F.col(f"`{c}`") for c in docs.columns if c != "text"])
        _, draws = mix_sources(numbered.select("doc_id", "source", "text", hashed.alias("_all"), F.col(row).alias("_row")), weights, most, seed, ("_all", "_row"))
        times = keep(draws.groupBy(F.col("_row").alias(row)).agg(F.count(F.lit(1)).cast("int").alias(count)), "mix-times")
    # counts grow with the documents, so they are never broadcast
    drawn = numbered.join(times.hint("merge"), row)
    return drawn.withColumn(row, F.explode(F.sequence(F.lit(1), F.col(count)))).select(*[F.col(f"`{c}`") for c in docs.columns])

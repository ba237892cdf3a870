"""Chat rendering of logged conversations, one for each growing log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.sources.staging import stage


def prefix_digests(turns: DataFrame) -> DataFrame:
    """Number each conversation's turns from 1 (``k``) and digest every prefix.

    A prefix's digest is the running XOR of two 64-bit hashes of (k, role, text): each
    turn enters with its place, so equal digests mean equal turns in equal order, and the
    window needs one running value instead of the prefix itself. Turns are laid out by
    range and numbered and digested within each; what a conversation has in earlier ranges
    (one row a range) is added, so a long conversation is spread over tasks. A row without
    conv_id is a conversation of its own, known by ``alone``, a digest of the row.
    """
    conversation, said = ["conv_id", "alone"], ["turn", "role", "text"]
    digest = F.md5(F.to_json(F.struct(*said)))
    distinct = turns.select("conv_id", *said).distinct().withColumn("alone", F.when(F.col("conv_id").isNull(), digest))
    laid = stage(distinct.repartitionByRange(*conversation, *said).withColumn("_range", F.spark_partition_id()), "chat-turns")
    piece = ["_range", *conversation]
    within = Window.partitionBy(*piece).orderBy(*said)
    earlier = Window.partitionBy(*conversation).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)

    def with_pieces(rows: DataFrame, pieces: DataFrame) -> DataFrame:
        pieces = pieces.withColumnsRenamed({"_range": "_r", "conv_id": "_c", "alone": "_a"})
        same = (F.col("_range") == F.col("_r")) & F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("alone").eqNullSafe(F.col("_a"))
        return rows.join(pieces, same).drop("_r", "_c", "_a")

    sizes = laid.groupBy(*piece).agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select(*piece, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"), F.sum("n").over(Window.partitionBy(*conversation)).alias("n_turns"))
    numbered = with_pieces(laid, sizes).withColumn("k", (F.col("n0") + F.row_number().over(within)).cast("int")).drop("n0")
    parts = ["k", F.col("role").isNull(), "role", F.col("text").isNull(), "text"]
    hashed = stage(numbered.withColumns({"a": F.xxhash64(*parts), "b": F.xxhash64(F.lit("second"), *parts)}), "chat-numbered")
    before = hashed.groupBy(*piece).agg(F.bit_xor("a").alias("a0"), F.bit_xor("b").alias("b0"))
    before = before.select(*piece, *[F.coalesce(F.bit_xor(x).over(earlier), F.lit(0)).alias(x) for x in ("a0", "b0")])
    run = within.rowsBetween(Window.unboundedPreceding, 0)
    chained = {x: F.bit_xor(x).over(run).bitwiseXOR(F.col(f"{x}0")) for x in ("a", "b")}
    return with_pieces(hashed, before).withColumns(chained).select(*conversation, *said, "k", "a", "b", F.col("n_turns").cast("int").alias("n_turns"))


def render_conversations(turns: DataFrame, opening: str = "<|{role}|>\n", closing: str = "\n") -> DataFrame:
    """Collapse snapshots of growing conversations, then render what is left.

    ``turns`` has conv_id, turn, role, text. A conversation whose turns (role and text) are
    a proper prefix of another's goes; of equal ones the smallest conv_id stays (a null one
    only if all are). Returns conv_id, n_turns, n_copies (conversations equal to it, itself
    included), rendered: for each turn ``opening`` with the role, the text, ``closing``.

    Turns are ordered by turn, then role, then text, nulls first; repeated rows count once;
    each row without conv_id is a conversation of one turn, so such rows form no group; a
    null role renders as ``unknown`` and a null text as nothing. Other columns are ignored.
    Any number of conversations may share turns: equal prefixes and equal wholes meet in
    map-side aggregates, never in one group. A conversation is one value of the result, so
    Spark's 2 GB for a value is its bound.
    """
    prefixes = stage(prefix_digests(turns), "chat-prefixes")
    name = F.min(F.struct(F.col("conv_id").isNull().alias("n"), "conv_id", "alone")).alias("m")
    wholes = prefixes.where("k = n_turns").groupBy("k", "a", "b").agg(name, F.count(F.lit(1)).alias("n_copies"))
    shorter = prefixes.where("k < n_turns").select("k", "a", "b").distinct()
    kept = wholes.join(shorter, ["k", "a", "b"], "left_anti").select(F.col("m.conv_id").alias("_kept"), F.col("m.alone").alias("_alone"), F.col("k").cast("long").alias("n_turns"), "n_copies")
    before, after = opening.split("{role}")
    line = F.concat(F.lit(before), F.coalesce("role", F.lit("unknown")), F.lit(after), F.coalesce("text", F.lit("")), F.lit(closing))
    return (
        prefixes.select("conv_id", "alone", "k", line.alias("line"))
        .join(kept, F.col("conv_id").eqNullSafe(F.col("_kept")) & F.col("alone").eqNullSafe(F.col("_alone")))
        .groupBy("conv_id", "alone", "n_turns", "n_copies")
        # a conversation is one row of the result, so its turns have to meet
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda x: x["line"]), "").alias("rendered"))
        .drop("alone")
    )

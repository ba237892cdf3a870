"""How far the sources of a language diverge in their words, from sorted term pointers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.sources.staging import scratch, stage

#: Bytes of text whose term pointers are sorted together.
SLICE = 1 << 24
#: Sources in a block and terms in a slice of the comparison of sources.
SOURCES, TERMS = 256, 4096
SCALE, PRIOR = 1_000_000_000, 5
#: Letters as they count: A-Z as a-z, bytes from 80 hexadecimal on as they are, all else ends a term.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256))
_LOW = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
_ROW = pa.schema([("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])


def _pointers(letters: np.ndarray, borders: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Where the terms of a buffer start, and their lengths; a term ends at a border too."""
    outside = letters == 0
    before, after = np.concatenate([[True], outside]), np.append(outside, True)
    edge = before != after
    if borders is not None:
        edge[borders] = True
    starts, stops = np.flatnonzero(edge & ~after), np.flatnonzero(edge & ~before)
    return starts, stops - starts


def sort_pointers(letters: bytes, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pointers' order by term, equal terms as they came, and which of them begin a new term.

    A multikey sort, eight bytes a key: runs that tie and whose terms go on are sorted by
    their next eight bytes, all such runs at once.
    """
    padded = np.frombuffer(letters + bytes(8), dtype=np.uint8)
    eight = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))

    def key(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        return eight[at] & _LOW[np.minimum(left, 8)]

    words = key(starts, lengths)
    order = np.argsort(words, kind="stable")
    words = words[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = words[1:] != words[:-1]
    depth = 8
    while True:
        single = fresh & np.append(fresh[1:], True)
        tied = np.flatnonzero((lengths[order] >= depth) & ~single)
        if not len(tied):
            return order, fresh
        run = np.cumsum(fresh)[tied]
        rows = order[tied]
        words = key(starts[rows] + depth, lengths[rows] - depth)
        inner = np.lexsort((words, run))
        order[tied], words = rows[inner], words[inner]
        fresh[tied[1:]] |= words[1:] != words[:-1]
        depth += 8


def _sums(flags: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(flags.astype(np.int64), firsts) if len(firsts) else np.zeros(0, np.int64)


def _gather(letters: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Offsets and bytes of the terms at ``starts``, one after the other."""
    ends = np.cumsum(lengths)
    place = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lengths, lengths)
    return np.concatenate([[0], ends]), letters[np.repeat(starts, lengths) + place].tobytes()


def _condensed(text: memoryview, size: int) -> tuple[bytes, np.ndarray]:
    """A long text's distinct terms, and how often each occurs; the text is taken in pieces cut between terms."""
    kept, weights, at = b"", np.zeros(0, np.int64), 0
    while at < len(text):
        end = min(at + size, len(text))
        piece = bytes(text[at:end]).translate(_LETTERS)
        if end < len(text) and text[end] and _LETTERS[text[end]]:
            piece = piece[: piece.rfind(b"\0") + 1] or _whole_term(text, at, end)
        at += len(piece)
        letters = kept + piece + b"\0"
        raw = np.frombuffer(letters, dtype=np.uint8)
        starts, lengths = _pointers(raw)
        counts = np.concatenate([weights, np.ones(len(starts) - len(weights), np.int64)])
        order, fresh = sort_pointers(letters, starts, lengths)
        firsts = np.flatnonzero(fresh)
        weights = np.add.reduceat(counts[order], firsts) if len(firsts) else counts
        # terms with a separator after each
        ends, joined = _gather(raw, starts[order][firsts], lengths[order][firsts] + 1)
        kept = joined
    return kept, weights


def _whole_term(text: memoryview, at: int, end: int) -> bytes:
    """A term longer than a piece."""
    while end < len(text) and _LETTERS[text[end]]:
        end += 1
    return bytes(text[at:end]).translate(_LETTERS)


def _rows(table: pa.Table, letters: bytes, starts: np.ndarray, lengths: np.ndarray, docs: np.ndarray, weights: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """A row for each language and term: its documents, and how often each source has it. ``table`` is in order of lang and source."""
    lang, source = table["lang"].combine_chunks(), table["source"].combine_chunks()
    changed = lambda a: pc.fill_null(pc.not_equal(a[1:], a[:-1]), True).to_numpy(zero_copy_only=False)
    new_lang = np.concatenate([[True], changed(lang)])
    new_group = new_lang | np.concatenate([[True], changed(source)])
    langs, groups = np.cumsum(new_lang) - 1, np.cumsum(new_group) - 1
    # the groups themselves, under the empty term
    firsts = np.flatnonzero(new_group)
    heads = np.flatnonzero(new_lang[firsts])
    names = source.take(pa.array(firsts))
    yield _batch(lang.take(pa.array(firsts[heads])), pa.array([""] * len(heads)), np.zeros(len(heads), np.int64), np.append(heads, len(firsts)), names, np.zeros(len(firsts), np.int64))
    if not len(starts):
        return
    order, fresh = sort_pointers(letters, starts, lengths)
    d = docs[order]
    g, la = groups[d], langs[d]
    step = lambda x: np.concatenate([[True], x[1:] != x[:-1]])
    run, cell, doc = fresh | step(la), fresh | step(g), fresh | step(d)
    runs, cells = np.flatnonzero(run), np.flatnonzero(cell)
    counts = np.diff(np.append(cells, len(order))) if weights is None else np.add.reduceat(weights[order], cells)
    ends, data = _gather(np.frombuffer(letters, dtype=np.uint8), starts[order][runs], lengths[order][runs])
    terms = pa.Array.from_buffers(pa.large_string(), len(runs), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
    within = np.append(np.searchsorted(cells, runs), len(cells))
    yield _batch(lang.take(pa.array(d[runs])), terms.cast(pa.string()), _sums(doc, runs), within, names.take(pa.array(g[cells])), counts)


def _batch(lang: pa.Array, term: pa.Array, docs: np.ndarray, within: np.ndarray, sources: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    at = pa.array(within.astype(np.int32))
    return pa.RecordBatch.from_arrays([lang, term, pa.array(docs), pa.ListArray.from_arrays(at, sources), pa.ListArray.from_arrays(at, pa.array(counts))], schema=_ROW)


def _slice(table: pa.Table, size: int) -> Iterator[pa.RecordBatch]:
    table = table.take(pc.sort_indices(table, sort_keys=[("lang", "ascending"), ("source", "ascending")]))
    text = table["text"].combine_chunks().cast(pa.large_binary())
    ends = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
    raw = memoryview(text.buffers()[2] or b"")
    if len(table) == 1 and ends[-1] - ends[0] > size:
        letters, weights = _condensed(raw[ends[0] : ends[-1]], size)
        starts, lengths = _pointers(np.frombuffer(letters, dtype=np.uint8))
        yield from _rows(table, letters, starts, lengths, np.zeros(len(starts), np.int64), weights)
        return
    letters = bytes(raw[ends[0] : ends[-1]]).translate(_LETTERS)
    ends = ends - ends[0]
    starts, lengths = _pointers(np.frombuffer(letters, dtype=np.uint8), ends)
    docs = np.searchsorted(ends, starts, side="right") - 1
    yield from _rows(table, letters, starts, lengths, docs, None)


def term_rows(docs: DataFrame, size: int = SLICE) -> DataFrame:
    """lang, term, docs, sources, counts of each slice of about ``size`` bytes of text.

    ``docs`` has lang, source and text, none of them null. Slices never cut a document; one
    that is longer than a slice is one of its own, condensed piece by piece. Every group of
    a slice also stands under the empty term, with counts of 0.
    """

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        have = rows = 0
        for batch in batches:
            whole = pa.Table.from_batches([batch])
            sizes = pc.binary_length(whole["text"]).to_numpy()
            first = 0
            for k, n in enumerate(sizes):
                if rows and have + n > size:
                    held.append(whole.slice(first, k - first))
                    yield from _slice(pa.concat_tables(held), size)
                    held, have, rows, first = [], 0, 0, k
                have, rows = have + int(n), rows + 1
            held.append(whole.slice(first))
        if rows:
            yield from _slice(pa.concat_tables(held), size)

    return docs.select("lang", "source", "text").mapInArrow(slices, "lang string, term string, docs long, sources array<string>, counts array<long>")


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), exactly; null without terms."""
    wide = lambda c, p: c.cast(f"decimal({p},0)")
    above = F.lit(SCALE).cast("decimal(10,0)") * (wide(count, 19) + F.lit(PRIOR).cast("decimal(1,0)"))
    below = wide(total, 19) + F.lit(PRIOR).cast("decimal(1,0)") * wide(terms, 12)
    return F.when(terms > 0, F.call_function("div", above, below) + 1)


def _partial_distances(cells: DataFrame, size: int = SOURCES) -> DataFrame:
    """For each pair of sources of a block pair and slice: the sum over its terms of |p - q| less what sources without them give."""

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        blank = rows["term"].isna()
        base = rows[blank].drop_duplicates("number").set_index("number")["p"].sort_index()
        found = rows[~blank]
        codes, terms = pd.factorize(found["term"])
        none = base.to_numpy()
        shares = np.repeat(none[:, None], len(terms), axis=1)
        shares[base.index.get_indexer(found["number"]), codes] = found["p"].to_numpy()
        numbers = base.index.to_numpy()
        left = numbers[numbers // size == key[1]]
        out = []
        for number in left:
            a = int(np.searchsorted(numbers, number))
            others = np.flatnonzero((numbers > number) & (numbers // size == key[2]))
            apart = np.abs(shares[others] - shares[a]).sum(axis=1) - len(terms) * np.abs(none[others] - none[a])
            out.append(pd.DataFrame({"lang": key[0], "a": number, "b": numbers[others], "apart": apart}))
        return pd.concat(out) if out else pd.DataFrame({"lang": [], "a": [], "b": [], "apart": []})

    return cells.groupBy("lang", "low", "high", "slice").applyInPandas(compare, "lang string, a int, b int, apart long")


def _ranked(rows: DataFrame, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked if most is None else ranked.where(F.col("rank") <= most)


def source_divergence(docs: DataFrame, least_docs: int = 30, top: int = 50, slice_bytes: int = SLICE) -> DataFrame:
    """How the sources of each language differ in their words: lang, source, part, item, value, rank.

    Terms are runs of letters, A-Z in lower case; a byte outside ASCII is a letter. A
    language keeps the terms that at least ``least_docs`` of its documents have. A kept
    term's share in a group is 1 + floor(10^9 (count + 5) / (N + 5 V)), N the group's kept
    occurrences, V the language's kept terms. Part ``pair`` gives each group's distance to
    every other source of its language, summed over all kept terms; part ``term`` the
    ``top`` terms that it has and uses more than its language does, by how much.

    Term pointers over Arrow buffers are sorted in slices; a slice's runs of equal terms
    give one row for each language and term, so a frequent term or a hot source comes as one
    row a slice, and terms are dealt out by hash. Sources are compared block by block over
    slices of terms; only pairs of sources of one language are ever made, as they are the result.

    Null text, lang and source count as empty; a row is a document, repeated rows count
    each. A language without kept terms has pairs of value 0; a source alone in its
    language has no pairs. An empty table gives no rows; other columns are ignored. Ranks
    of equal values go by the item's UTF-8 bytes.
    """
    spark = docs.sparkSession
    named = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    with scratch(spark) as keep:
        by_term = Window.partitionBy("lang", "term")
        spread = term_rows(named, slice_bytes).repartition("lang", "term").withColumn("_docs", F.sum("docs").over(by_term))
        spread = spread.where((F.col("_docs") >= least_docs) | (F.col("term") == ""))
        each = spread.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
        counts = stage(each.groupBy("lang", "term", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("n")), "term-counts")
        kept = counts.where("term <> ''")
        terms = kept.groupBy("lang", "term").agg(F.sum("n").alias("of_lang"))
        langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("of_lang").alias("total"))
        sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
        # one row for each source of a language
        groups = sums.join(langs.select("lang", "v"), "lang", "left").select("lang", "source", "total", F.coalesce("v", F.lit(0)).cast("long").alias("v"), number.alias("number"))
        groups = stage(groups.withColumn("blank", _share(F.lit(0), F.col("total"), F.col("v"))).withColumn("blocks", F.count(F.lit(1)).over(Window.partitionBy("lang")).cast("int")), "groups")
        groups = groups.withColumn("blocks", F.expr(f"(blocks + {SOURCES - 1}) div {SOURCES}"))

        of_group = kept.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("v")))
        slices = F.expr(f"cast(v div {TERMS} + 1 as int)")
        mine = F.expr(f"number div {SOURCES}")
        other = F.explode(F.expr("sequence(0, cast(blocks - 1 as int))")).alias("other")
        cells = of_group.select("lang", "number", "term", "p", mine.alias("mine"), F.pmod(F.xxhash64("term"), slices).cast("int").alias("slice"), other)
        blanks = groups.where("v > 0").select("lang", "number", F.col("blank").alias("p"), mine.alias("mine"), "blocks", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"))
        blanks = blanks.select("lang", "number", F.lit(None).cast("string").alias("term"), "p", "mine", "slice", other)
        cells = cells.unionByName(blanks).select("lang", "number", "term", "p", "slice", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"))
        apart = _partial_distances(cells).groupBy("lang", "a", "b").agg(F.sum("apart").alias("apart"))

        one = groups.select("lang", F.col("source").alias("one"), F.col("number").alias("a"), F.col("blank").alias("blank_a"), "v")
        two = groups.select("lang", F.col("source").alias("two"), F.col("number").alias("b"), F.col("blank").alias("blank_b"))
        pairs = one.join(two, "lang").where("a < b").join(apart, ["lang", "a", "b"], "left")
        value = F.coalesce(F.col("v") * F.abs(F.col("blank_a") - F.col("blank_b")), F.lit(0)) + F.coalesce("apart", F.lit(0))
        both = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item")), F.struct(F.col("two").alias("source"), F.col("one").alias("item")))).alias("x")
        pairs = _ranked(pairs.select("lang", value.cast("long").alias("value"), both).select("lang", "x.source", "x.item", "value"))

        usual = terms.join(langs, "lang").select("lang", "term", _share(F.col("of_lang"), F.col("total"), F.col("v")).alias("q"))
        more = of_group.where("n > 0").select("lang", "source", "term", "p").join(usual, ["lang", "term"]).where("p > q")
        more = _ranked(more.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).cast("long").alias("value")), top)
        parts = [x.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for name, x in (("pair", pairs), ("term", more))]
        return keep(parts[0].unionByName(parts[1]), "divergence")

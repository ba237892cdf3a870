"""WARC archives: written with revisit records for repeated payloads, read back along verified chains of records."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseframe.sources.staging import scratch, stage

MAGIC = "WARC/1.1\r\n"
BLANK = "\r\n\r\n"
#: Payloads from this size on are stored once.
LEAST = 1000
#: Bytes of a file that one piece of a scattered record may come from at once.
_REACH = 1 << 27
_WITHOUT = object()


class DamagedArchiveError(ValueError):
    """The records of a file don't lead from its start to its end."""


def mark_revisits(captures: DataFrame, row: str, least: int = LEAST) -> DataFrame:
    """``captures`` (id, payload as binary) with payload_bytes, payload_digest, record_id, record_type and refers_to.

    Of rows with equal payloads of at least ``least`` bytes, the one with the largest id (of
    several, the largest ``row``, which tells rows apart) is the response; all others are
    revisits and refer to its record. Smaller payloads are all responses, a null payload is
    an empty one, and a null id is smaller than any. Payloads count as equal by SHA-1,
    another 64-bit hash and length. Only payloads that occur several times
    are joined back, a row each, so copies of one payload in any number meet it as Spark
    finds best, and a payload moves only where that table is too large to broadcast.
    """
    known = captures.withColumn("payload", F.coalesce("payload", F.lit(b""))).withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload"), "_hash": F.xxhash64("payload")})
    same = ["payload_digest", "_hash", "payload_bytes"]
    first = F.max(F.struct("id", F.col(row).alias("row"))).alias("first")
    repeated = known.where(F.col("payload_bytes") >= least).groupBy(*same).agg(first, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    marked = known.join(stage(repeated, "repeated-payloads"), same, "left")
    revisit = F.col("first").isNotNull() & (F.col("first.row") != F.col(row))
    refers = F.when(revisit, record_id(F.col("first.id"), F.col("first.row")))
    return marked.withColumns({"record_id": record_id(F.col("id"), F.col(row)), "record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": refers}).drop("first", "_hash")


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def _clean(text: Column) -> Column:
    """What may break a header line is escaped as in URLs."""
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def record_id(id: Column, row: Column) -> Column:
    return F.concat(F.lit("<urn:capture:"), F.coalesce(id.cast("string"), F.lit("")), F.lit(":"), row.cast("string"), F.lit(">"))


def captured_id(record: Column) -> Column:
    """The id that a record's id was made of."""
    return F.regexp_extract(record, "^<urn:capture:(-?[0-9]+):", 1).try_cast("bigint")


def write_archives(captures: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """WARC 1.1 files of marked captures (id, url, payload, and what ``mark_revisits`` adds), one record a row.

    A response holds HTTP headers and the payload; a revisit the headers only, with the
    digest and length of the payload and the id of the record that has it. Spark's text writer stores
    the files, uncompressed and one a task, so any store will do and a lost task leaves
    nothing behind. Without a date of capture in the table all records carry ``date``. A
    null url is an empty one; line ends in a url are escaped.
    """
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(BLANK))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    size = F.octet_length(http) + F.octet_length(body)
    profile = F.when(revisit, _field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))
    head = F.concat_ws(
        "\r\n",
        _field("WARC-Type", F.col("record_type")), _field("WARC-Record-ID", F.col("record_id")), _field("WARC-Date", F.lit(date)), _field("WARC-Target-URI", _clean(F.col("url"))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))), _field("Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(revisit, _field("WARC-Refers-To", F.col("refers_to"))), profile, _field("Content-Type", F.lit("application/http; msgtype=response")), _field("Content-Length", size.cast("string")),
    )
    # the writer ends each row with the last byte of the record
    record = F.concat(F.lit(MAGIC), head, F.lit(BLANK), http, body, F.lit(BLANK[:-1]))
    captures.select(record.alias("value")).write.option("lineSep", "\n").text(folder)


def header(name: str, head: Column | None = None) -> Column:
    """A field of a record's header; null where it is missing."""
    found = F.regexp_extract(F.col("head") if head is None else head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def _parsed(rows: DataFrame, derive: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """``rows`` (value: the bytes after a magic) with head, span, whole and the columns derived from the payload.

    ``span`` is the number of bytes from this magic to the next record's if this is a record
    (of less than 2 GB), else null; ``whole`` tells whether the value has all of it.
    """
    head = F.substring_index("value", BLANK, 1)
    rows = rows.withColumns({"head": F.when(F.octet_length(head) < F.octet_length("value"), head)})
    length = header("Content-Length").try_cast("int")
    rows = rows.withColumns({"_block": F.when(length >= 0, length), "_raw": F.col("value").cast("binary")})
    rows = rows.withColumn("_at", F.octet_length("head") + len(BLANK))
    block = F.expr("substring(_raw, _at + 1, _block)")
    http = F.octet_length(F.substring_index(block.cast("string"), BLANK, 1)) + len(BLANK)
    is_http = F.startswith(F.lower(header("Content-Type")), F.lit("application/http"))
    payload = F.when(is_http, F.expr("substring(_raw, _at + 1 + _http, _block - _http)")).otherwise(block)
    end = F.col("_at") + F.col("_block").cast("long") + len(BLANK)
    sized = rows.withColumns({"span": end + len(MAGIC), "whole": F.octet_length("_raw") >= end})
    sized = sized.withColumn("_http", F.when(F.col("whole") & is_http, http))
    return sized.select(*rows.columns[: rows.columns.index("head")], "head", "span", "whole", *[F.when(F.col("whole"), f(payload)).alias(c) for c, f in derive.items()])


def _chained(rows: DataFrame) -> DataFrame:
    """Candidates of every part of a file with their chains inside it, and a row without ``at`` for the part's bytes.

    A task reads the parts of its files in order, so the bytes of the rows before tell each
    candidate's place. A candidate whose successor lies in the same part passes its exit
    on; one that leads to no candidate has none. ``low`` and ``reach`` number the chains:
    a candidate is on the chain from x if low <= x's low < low + reach.
    """
    others = [c for c in rows.columns if c not in ("file", "part", "size")]

    def part(table: pa.Table) -> pa.RecordBatch:
        size = table["size"].to_numpy()
        at, total = np.cumsum(size) - size, int(size.sum())
        span = table["span"].to_numpy(zero_copy_only=False).astype(np.float64)
        found = np.flatnonzero(~np.isnan(span))
        at, ends = at[found], at[found] + span[found].astype(np.int64)
        after = np.searchsorted(at, ends)
        inside = (after < len(at)) & (at[np.minimum(after, len(at) - 1)] == ends) if len(at) else np.zeros(0, bool)
        leads = np.where(inside, after, -1).tolist()
        stops = np.where(ends >= total, ends, -1)
        low, reach, room = np.zeros(len(at), np.int64), [1] * len(at), [0] * len(at)
        for k, to in enumerate(leads):
            if to >= 0:
                reach[to] += reach[k]
        free = 0
        for k in range(len(at) - 1, -1, -1):
            if (to := leads[k]) >= 0:
                low[k], room[to] = room[to], room[to] + reach[k]
                stops[k] = stops[to]
            else:
                low[k], free = free, free + reach[k]
            room[k] = int(low[k]) + 1
        kept = table.take(pa.array(found))
        for name, values in (("at", at), ("stop", pa.array(stops, pa.int64(), mask=stops < 0)), ("low", low), ("reach", reach)):
            kept = kept.append_column(name, pa.array(values, pa.int64()))
        schema = pa.schema([pa.field(f.name, f.type) for f in kept.schema])
        whole = {"file": [table["file"][0].as_py()], "part": [table["part"][0].as_py()], "size": [total]}
        summary = pa.table({f.name: pa.array(whole.get(f.name, [None]), f.type) for f in schema}, schema=schema)
        return pa.concat_tables([summary, kept.cast(schema)]).combine_chunks().to_batches()[0]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        now: object = _WITHOUT
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            files, places = rows["file"].to_pylist(), rows["part"].to_pylist()
            first = 0
            for k, key in enumerate(zip(files, places, strict=True)):
                if key != now:
                    held.append(rows.slice(first, k - first))
                    if now is not _WITHOUT:
                        yield part(pa.concat_tables(held))
                    held, now, first = [], key, k
            held.append(rows.slice(first))
        if now is not _WITHOUT:
            yield part(pa.concat_tables(held))

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select("file", "part", "size", *others).schema], "at long, stop long, low long, reach long"])
    return rows.select("file", "part", "size", *others).mapInArrow(parts, schema)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """The bytes between one magic and the next as Spark reads the files, cut where it likes."""
    lines = spark.read.option("lineSep", MAGIC).text(folder)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), (F.octet_length("value") + len(MAGIC)).cast("long").alias("size"), "value")


def _bases(chained: DataFrame) -> DataFrame:
    """Where each part begins in its file, and the file's bytes: a row a part."""
    parts = chained.where("at is null").select("file", "part", F.col("size").alias("bytes"))
    earlier = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumns({"base": F.coalesce(F.sum("bytes").over(earlier), F.lit(0)), "bytes": F.sum("bytes").over(Window.partitionBy("file"))})


def _reached(links: DataFrame) -> DataFrame:
    """Candidates (file, start) that the chain from a file's start enters a part by, by pointer jumping over ``links`` (file, start, stop)."""
    jumps = links.join(links.select("file", F.col("stop").alias("start")).distinct(), ["file", "start"], "left_semi")
    jumps = stage(jumps.unionByName(links.where(F.col("start") == len(MAGIC))).distinct(), "jumps")
    reached = stage(jumps.where(F.col("start") == len(MAGIC)).select("file", "start"), "reached")
    while not jumps.isEmpty():
        ahead = reached.join(jumps, ["file", "start"]).select("file", F.col("stop").alias("start"))
        reached = stage(reached.unionByName(ahead).distinct(), "reached")
        twice = jumps.select("file", F.col("start").alias("from"), F.col("stop").alias("start")).join(jumps, ["file", "start"])
        jumps = stage(twice.select("file", F.col("from").alias("start"), "stop"), "jumps")
    return reached


def _scattered(spark: SparkSession, folder: str, records: DataFrame, derive: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Records whose payloads hold a magic, put together from the pieces between."""
    rows = _chained(_lines(spark, folder).withColumn("span", F.lit(0).cast("long")))
    pieces = rows.where("at is not null").join(_bases(rows), ["file", "part"]).select("file", (F.col("base") + F.col("at")).alias("at"), "value")
    wanted = records.select("file", F.col("start"), (F.col("start") + F.col("span")).alias("end"))
    wanted = wanted.withColumn("bucket", F.explode(F.expr(f"sequence(start div {_REACH}, (end - 1) div {_REACH})")))
    pieces = pieces.withColumn("bucket", F.expr(f"at div {_REACH}")).join(wanted, ["file", "bucket"]).where("start <= at and at < end")
    whole = pieces.groupBy("file", "start").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("p"))
    values = whole.select("file", "start", F.array_join(F.transform("p", lambda x: x["value"]), MAGIC).alias("value"))
    return _parsed(values, derive)


def read_archives(spark: SparkSession, folder: str, derive: Mapping[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Every record of a folder of uncompressed WARC files: file, offset, head, and columns derived from the payload.

    ``derive`` gives the columns by name, each a function of the payload (binary); without
    it there is ``payload`` itself. They are computed where the file is read, so payloads
    move only if a column holds them. Of a record of HTTP the payload is what follows its headers.

    Files are cut anywhere. Every magic is a candidate, and its header tells where its
    successor would begin; a task joins these pointers inside its parts of files, and
    pointer jumping from the start of each file over what is left finds the parts' entries.
    Only candidates on that chain are records, so a magic inside a payload is none. A
    record with such a payload is read once more, to be put together. A file whose chain
    doesn't lead to its end raises ``DamagedArchiveError``; an empty folder gives no rows.
    """
    wanted = {"payload": lambda p: p} if derive is None else derive
    if taken := {c.lower() for c in wanted} & {"file", "offset", "head"}:
        raise ValueError(f"the result has columns {sorted(taken)} of its own")
    # any names will do for the result, so inside the columns have others
    derive = {f"_derived{k}": f for k, f in enumerate(wanted.values())}
    named = [F.col(mine).alias(name) for mine, name in zip(derive, wanted, strict=True)]
    with scratch(spark) as keep:
        found = stage(_chained(_parsed(_lines(spark, folder), derive).drop("value")), "candidates")
        bases = stage(_bases(found), "parts")
        placed = found.where("at is not null").join(bases, ["file", "part"]).withColumn("start", F.col("base") + F.col("at"))
        links = placed.where("stop is not null").select("file", "start", (F.col("base") + F.col("stop")).alias("stop"))
        reached = _reached(links)
        whole = bases.select("file", F.col("bytes").alias("stop")).distinct()
        damaged = whole.join(links.join(reached, ["file", "start"]), ["file", "stop"], "left_anti")
        if names := [r["file"] for r in damaged.limit(5).collect()]:
            raise DamagedArchiveError(f"records don't lead to the end of {names}")
        entries = placed.join(reached, ["file", "start"], "left_semi").select("file", "part", F.col("low").alias("entry"))  # at most one a part
        records = placed.join(entries, ["file", "part"]).where("low <= entry and entry < low + reach")
        records = stage(records.select("file", "start", "span", "whole", "head", *derive), "records")
        scattered = records.where("not whole")
        done = records.where("whole").select("file", "start", "head", *derive)
        if not scattered.isEmpty():
            done = done.unionByName(_scattered(spark, folder, scattered, derive).select("file", "start", "head", *derive))
        return keep(done.select("file", (F.col("start") - len(MAGIC)).alias("offset"), "head", *named), "archive-records")

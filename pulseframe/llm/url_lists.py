"""URL filter lists as of the time of each fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
FIRST_FOLDER = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]+)"


def url_host(url: Column) -> Column:
    """Lower-case host; empty if there is none, null for null."""
    return F.lower(F.regexp_extract(url, HOST, 1))


def url_patterns(url: Column) -> Column:
    """What a list entry may name for this URL: host, each parent domain, host with first folder."""
    host, folder = url_host(url), F.regexp_extract(url, FIRST_FOLDER, 1)
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(F.length(host) > 0, F.concat(suffixes, F.when(F.length(folder) > 0, F.array(F.concat(host, folder))).otherwise(F.array().cast("array<string>"))))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """Entries (list_name, pattern, dated, action) as intervals [valid_from, valid_to).

    An entry holds until the list's next entry on the same pattern; a ``remove`` ends one
    and starts none. Of entries of one day ``block`` wins over ``allow`` over ``remove``.
    Entries without pattern, date or action never hold.
    """
    known = entries.where("pattern is not null and dated is not null and action is not null")
    daily = known.groupBy("list_name", "pattern", "dated").agg(F.max(F.struct(F.expr("case action when 'block' then 2 when 'allow' then 1 else 0 end").alias("rank"), "action")).alias("e"))
    following = Window.partitionBy("list_name", "pattern").orderBy("dated")
    spans = daily.select("list_name", "pattern", F.col("dated").alias("valid_from"), F.lead("dated").over(following).alias("valid_to"), F.col("e.action").alias("action"))
    return spans.where(F.col("action").isin("block", "allow"))


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Judge each capture (page_id, url, fetched_on) by the entries active on its day.

    Entries become validity intervals; each is spread over the months it covers within the
    captures' span, so the as-of join is an equi-join on pattern and month with a residual
    range, and a pattern that most captures share is dealt out by month (and split further
    by Spark's skew join). Of the active entries the longest pattern decides, of equal ones
    ``block`` before ``allow``.

    Returns page_id, url, fetched_on, verdict (``block``, ``allow``, or ``none`` where no
    entry is active), pattern and valid_from of the deciding entry (else null). One row for
    each input row, repeated rows included; a null url, a url without host or a null date
    gets ``none``; other columns are ignored.
    """
    key = ["page_id", "url", "fetched_on"]
    distinct = captures.select(*key).groupBy(*key).agg(F.count(F.lit(1)).cast("int").alias("_copies"))
    span = captures.agg(F.min("fetched_on").alias("_first"), F.max("fetched_on").alias("_last"))  # one row
    month = lambda d: F.trunc(d, "month")
    spread = (
        validity_intervals(entries)
        .crossJoin(F.broadcast(span))
        .withColumn("_from", F.greatest("valid_from", "_first"))
        .withColumn("_to", F.least(F.coalesce(F.date_sub("valid_to", 1), F.col("_last")), F.col("_last")))
        .where("_from <= _to")
        .withColumn("_month", F.explode(F.sequence(month(F.col("_from")), month(F.col("_to")), F.expr("interval 1 month"))))
        .select("pattern", "_month", "valid_from", "valid_to", "action")
    )
    asked = distinct.select("*", F.explode_outer(url_patterns(F.col("url"))).alias("_pattern")).withColumn("_on", month(F.col("fetched_on")))
    active = (F.col("_pattern") == F.col("pattern")) & (F.col("_on") == F.col("_month")) & (F.col("valid_from") <= F.col("fetched_on")) & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to")))
    best = F.max(F.when(F.col("pattern").isNotNull(), F.struct(F.length("pattern").alias("n"), (F.col("action") == "block").alias("b"), "pattern", "valid_from", "action"))).alias("e")
    return (
        asked.join(spread, active, "left")
        .groupBy(*key, "_copies")
        .agg(best)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(*key, F.coalesce("e.action", F.lit("none")).alias("verdict"), F.col("e.pattern").alias("pattern"), F.col("e.valid_from").alias("valid_from"))
    )

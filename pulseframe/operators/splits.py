"""Train, validation and test by predicates over the event number and truth columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.keys import event_number
from pulseframe.functions.naming import free_names, q
from pulseframe.operators.ordering import ranked

#: The shipped configuration's predicates.
PREDICATES = {"train": "Event % 5 > 1", "validation": "Event % 5 = 0", "test": "Event % 5 = 1"}


def checked(predicates: Mapping[str, str]) -> Mapping[str, str]:
    """The predicates, if none is empty."""
    empty = [k for k, v in predicates.items() if not v or not v.strip()]
    if empty or not predicates:
        raise ValueError(f"no selection for {empty or 'any split'}")
    return predicates


def _numbered(truth: DataFrame, anchored: bool) -> tuple[DataFrame, str]:
    """``truth`` with the event number as ``Event``, and the name that a column called so has meanwhile."""
    (aside,) = free_names(truth, "_event")
    # names count without case, as Spark compares them
    renamed = truth.select(*[q(c).alias(aside if c.lower() == "event" else c) for c in truth.columns])
    return renamed.withColumn("Event", event_number(F.col("event_id"), anchored)), aside


def _restored(df: DataFrame, truth: DataFrame, aside: str, *added: str) -> DataFrame:
    return df.select(*[(F.col(aside) if c.lower() == "event" else q(c)).alias(c) for c in truth.columns], *added)


def select_split(truth: DataFrame, predicate: str, anchored: bool = True) -> DataFrame:
    """Rows of ``truth`` whose event number and columns meet a Spark SQL predicate.

    ``Event`` in the predicate is the number from event_id, whatever column has that name;
    a row without one never matches; null is not true. Columns stay as they are.
    """
    checked({"split": predicate})
    numbered, aside = _numbered(truth, anchored)
    return _restored(numbered.where(F.col("Event").isNotNull()).where(F.expr(predicate)), truth, aside)


def with_matches(truth: DataFrame, predicates: Mapping[str, str] = PREDICATES, anchored: bool = True) -> DataFrame:
    """``truth`` with ``matched``: the names of all splits a row belongs to, none for many; a column called so is an error."""
    if "matched" in {c.lower() for c in truth.columns}:
        raise ValueError("truth has a column called matched")
    numbered, aside = _numbered(truth, anchored)
    named = [F.when(F.col("Event").isNotNull() & F.expr(p), F.lit(name)) for name, p in checked(predicates).items()]
    return _restored(numbered.withColumn("matched", F.filter(F.array(*named), lambda s: s.isNotNull())), truth, aside, "matched")


def split_all(truth: DataFrame, predicates: Mapping[str, str] = PREDICATES) -> DataFrame:
    """A row for each split a truth row belongs to, from one scan."""
    # a plain explode makes Spark filter by "matched" first, which works it out twice and the event number seven times
    return with_matches(truth, predicates).withColumn("split", F.explode_outer("matched")).where(F.col("split").isNotNull()).drop("matched")


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def split_audit(truth: DataFrame, predicates: Mapping[str, str] = PREDICATES) -> DataFrame:
    """How many rows are in no split, in one, in several."""
    return with_matches(truth, predicates).groupBy(F.size("matched").alias("n_splits")).agg(F.count(F.lit(1)).alias("n"))


def sample_index(split: DataFrame) -> DataFrame:
    """``idx``: each row's rank in its split by ``_ord``, then event_id; a column called so is replaced, all others stay.

    One global order, so a split that holds most rows isn't one task. The order lays the
    splits one after the other; a row's place in its file and the counts of the files
    before give its rank, so rows are exchanged once and the predicates evaluated once.
    """
    return ranked(split, "split", [F.col("_ord"), F.col("event_id")], "idx", "sample-index")

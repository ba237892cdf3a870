"""Language identification by sparse logistic regression on character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNDETERMINED = "und"
#: Hashed n-gram features, and the characters of a long text that are hashed at a time.
DIM, CHUNK = 1 << 16, 1 << 20
_MIX = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def ngram_ids(text: str) -> Iterator[np.ndarray]:
    """Feature numbers of all 1- to 3-grams of a whole text, in pieces that overlap by two characters.

    Letters count in lower case, every run of other ASCII characters as one blank.
    """
    text = f" {text.lower()} "
    for k in range(0, max(len(text) - 2, 1), CHUNK):
        c = np.frombuffer(text[k : k + CHUNK + 2].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        c = np.where((c < 128) & ((c < 97) | (c > 122)), np.uint32(32), c)
        blank = c == 32
        c = c[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]
        two = c[:-1] * np.uint32(0x01000193) + c[1:]
        three = two[:-1] * np.uint32(0x01000193) + c[2:]
        yield np.concatenate([(g ^ np.uint32(n)) * m >> np.uint32(16) for n, (g, m) in enumerate(zip((c, two, three), _MIX, strict=True))]).astype(np.int32)


def feature_counts(text: str) -> np.ndarray:
    return sum(np.bincount(ids, minlength=DIM) for ids in ngram_ids(text))


@dataclass(frozen=True)
class Model:
    """languages, bias, and weights of features (idf included) over 1 / temperature."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def probabilities(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for ids in ngram_ids(text):
            total += self.weights[ids].sum(axis=0, dtype=np.float64) if len(ids) < DIM else np.bincount(ids, minlength=DIM) @ self.weights.astype(np.float64)
            n += len(ids)
        return softmax(total / max(n, 1) + self.bias)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 4, alpha: float = 0.5, beta: float = 0.1, l1: float = 0.02, l2: float = 0.01) -> tuple[np.ndarray, np.ndarray]:
    """Follow the regularised leader with elastic-net penalties: weights (DIM x classes) and bias.

    ``rows`` are (feature numbers, values, class); feature DIM is the bias.
    """
    z, n = np.zeros((DIM + 1, classes)), np.zeros((DIM + 1, classes))

    def leader(i: np.ndarray | slice) -> np.ndarray:
        return np.where(np.abs(z[i]) <= l1, 0.0, -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for ids, x, y in rows:
            w = leader(ids)
            off = softmax(x @ w)
            off[y] -= 1.0
            g = np.outer(x, off)
            z[ids] += g - (np.sqrt(n[ids] + g * g) - np.sqrt(n[ids])) / alpha * w
            n[ids] += g * g
    w = leader(slice(None))
    return w[:DIM], w[DIM]


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits that makes held-back labels likeliest, by a fine grid."""
    grid = np.geomspace(0.5, 20, 241)
    loss = [-np.mean(np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12)) for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(docs: DataFrame, max_rows: int = 4000, scale: float = 30.0) -> Model | None:
    """Learn from the rows of ``docs`` (doc_id, text, lang) whose lang isn't null.

    Class sizes and inverse document frequencies come from all of these rows. The
    classifier itself is fitted on a bounded sample: about ``max_rows`` rows, as many of
    each language as far as it has them and one on average at least, chosen by a digest of doc_id and text, repeated
    rows counting once there, so the bound holds whatever repeats; a fifth of them is held
    back for the temperature. A null text has no features. None if no row is labelled.
    """
    labelled = docs.where("lang is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    if not sizes:
        return None
    languages, total = sorted(sizes), sum(sizes.values())

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(DIM, np.int64)
        for b in batches:
            for text in b["text"]:
                mark = np.zeros(DIM, bool)
                for ids in ngram_ids(text or ""):
                    mark[ids] = True
                seen += mark
        used = np.flatnonzero(seen)
        yield pd.DataFrame({"feature": used.astype(np.int32), "n": seen[used]})

    found = labelled.select("text").mapInPandas(frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()  # DIM rows at most
    df = np.zeros(DIM)
    df[found["feature"]] = found["n"]
    idf = np.log((1 + total) / (1 + df)) + 1

    share = max(1, max_rows // len(languages))
    rate = F.create_map(*[x for lang in languages for x in (F.lit(lang), F.lit(min(1.0, share / sizes[lang])))])[F.col("lang")]
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1_000_000)) / 1_000_000

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text in b["text"]:
                counts = feature_counts(text or "")
                used = np.flatnonzero(counts)
                out.append((used.astype(np.int32).tobytes(), counts[used].astype(np.int32).tobytes()))
            yield pd.DataFrame({"lang": b["lang"], "place": b["place"], "ids": [x for x, _ in out], "counts": [x for _, x in out]})

    sample = labelled.where(draw < rate).withColumn("place", F.xxhash64(F.lit("order"), "doc_id", "text")).select("text", "lang", "place").dropDuplicates(["lang", "place"])
    taken = sample.mapInPandas(features, "lang string, place long, ids binary, counts binary").toPandas()
    taken = taken.sort_values(["place", "lang"], kind="stable")
    number = {lang: k for k, lang in enumerate(languages)}
    rows = []
    for lang, ids, counts in zip(taken["lang"], taken["ids"], taken["counts"], strict=True):
        i, c = np.frombuffer(ids, np.int32), np.frombuffer(counts, np.int32)
        rows.append((np.append(i, DIM), np.append(scale * idf[i] * c / max(c.sum(), 1), 1.0), number[lang]))
    held, train = rows[::5], [r for k, r in enumerate(rows) if k % 5]
    weights, bias = ftrl(train or held, len(languages))
    t = temperature(np.array([x[:-1] @ weights[i[:-1]] + bias for i, x, _ in held]), np.array([y for _, _, y in held])) if held else 1.0
    return Model(languages, (scale * idf[:, None] * weights / t).astype(np.float32), bias / t)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with lang_pred and score (the calibrated probability) from the whole text alone.

    ``und`` and 0 where the text is null or has no letter, or nothing was learned. Of
    equally likely languages the first by code point is predicted; rows with equal texts,
    repeated ones too, get equal predictions, each its own row. All columns of ``docs`` come
    along; columns named lang_pred or score, in whatever case, are replaced.
    """
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")])
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    # DIM x languages floats, and no more however large the corpus
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores = [], []
            for text in b.column("text").to_pylist():
                lang, score = UNDETERMINED, 0.0
                if text and shared.value is not None and has_letter(text):
                    p = shared.value.probabilities(text)
                    best = int(p.argmax())
                    lang, score = shared.value.languages[best], float(p[best])
                langs.append(lang)
                scores.append(score)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[f.name for f in schema])

    return kept.mapInArrow(judge, schema)


def keep_identified(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """The rows of ``docs`` whose language is recognised, unchanged.

    The model is learned from the labelled rows of ``docs``. Rows without letters go (null
    and empty texts too), as do those whose best language has a calibrated probability under
    ``least``; without labelled rows nothing is recognised. Repeated rows share their fate.
    """
    judged = predict(docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns])).select("text", "_row"), fit(docs))
    return judged.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).select("_row.*")

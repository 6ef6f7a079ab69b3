"""Naive Bayes over hashed word n-grams: trained by grouped counts, applied in Arrow batches.

Words are hashed inside Spark, so training is one aggregation and only bucket numbers
cross to Python when texts are scored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import infer_batches

#: most labels a model may have
LABELS = 1000


@dataclass(frozen=True)
class TextModel:
    """``weights[i, b]`` is the log probability of bucket b under ``labels[i]``, 0 for a bucket never seen."""

    labels: tuple
    log_prior: np.ndarray
    weights: np.ndarray
    n: int


def words_of(text: Column) -> Column:
    """Runs of letters and digits of a whole text, lower-cased; NULL counts as empty."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def word_grams(words: Column, n: int, buckets: int) -> Column:
    """Distinct buckets of the runs of 1 to ``n`` words.

    ``words`` must be a column, not an expression, which would be computed for each run.
    """

    def runs(k: int) -> Column:
        starts = F.when(F.size(words) >= k, F.sequence(F.lit(1), F.size(words) - (k - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat_ws(" ", F.slice(words, i, k)))

    every = F.concat(words, *[runs(k) for k in range(2, n + 1)])
    return F.array_distinct(F.transform(every, lambda g: F.pmod(F.xxhash64(g), F.lit(buckets)).cast("int")))


def train(df: DataFrame, text: str, label: str, n: int = 2, buckets: int = 1 << 18, alpha: float = 0.5) -> TextModel:
    """Learn from all rows with a label.

    A bucket's probability under a label is its share of the label's buckets, each text
    counting a bucket once, with ``alpha`` added to every bucket seen under any label.
    The driver gets one row per label and bucket: ``buckets`` and the number of labels,
    at most 1000, bound it whatever the number of texts.
    """
    rows = df.filter(F.col(label).isNotNull())
    sizes = rows.groupBy(F.col(label).alias("label")).count().limit(LABELS + 1).collect()
    if not sizes or len(sizes) > LABELS:
        raise ValueError(f"a model needs 1 to {LABELS} labels")
    labels = tuple(sorted(r["label"] for r in sizes))
    prior = {r["label"]: r["count"] for r in sizes}
    place = {v: i for i, v in enumerate(labels)}
    split = rows.select(F.col(label).alias("label"), words_of(F.col(text)).alias("__words"))
    grams = split.select("label", F.explode(word_grams(F.col("__words"), n, buckets)).alias("bucket"))
    found = grams.groupBy("label", "bucket").agg(F.count("*").alias("n")).toArrow()
    counts = np.zeros((len(labels), buckets))
    at = np.array([place[v] for v in found["label"].to_pylist()], dtype="int64")
    counts[at, np.array(found["bucket"], dtype="int64")] = np.array(found["n"])
    seen = counts.sum(0) > 0
    shares = np.log(counts + alpha) - np.log(counts.sum(1) + alpha * max(1, int(seen.sum())))[:, None]
    total = sum(prior.values())
    return TextModel(labels, np.array([math.log(prior[v] / total) for v in labels]), np.where(seen, shares, 0.0), n)


def classify(df: DataFrame, key: Sequence[str], text: str, model: TextModel, label_type: str, out: str = "label") -> DataFrame:
    """(key, label, probability) of every row; of equally likely labels the smaller one.

    The weights are sent to each executor once; their size is labels times buckets.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def score(batch: pd.DataFrame) -> pd.DataFrame:
        m = sent.value
        lengths = batch["__grams"].map(len).to_numpy()
        flat = np.concatenate([np.empty(0, "int64"), *batch["__grams"]]).astype("int64")
        row = np.repeat(np.arange(len(batch)), lengths)
        logs = [p + np.bincount(row, w[flat], minlength=len(batch)) for p, w in zip(m.log_prior, m.weights)]
        logs = np.array(logs).reshape(len(m.labels), len(batch))
        likely = np.exp(logs - logs.max(0))
        best = logs.argmax(0)
        chosen = batch[list(key)].copy()
        chosen[out] = [m.labels[i] for i in best]
        chosen["probability"] = likely[best, np.arange(len(batch))] / likely.sum(0)
        return chosen

    split = df.select(*key, words_of(F.col(text)).alias("__words"))
    hashed = split.select(*key, word_grams(F.col("__words"), model.n, model.weights.shape[1]).alias("__grams"))
    types = dict(df.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in key), f"`{out}` {label_type}", "probability double"])
    return infer_batches(hashed, score, schema, [*key, "__grams"])

"""Deduplication of an event stream that keeps the rows it turns away.

A sifted table is a directory.  ``rows/batch=…/fate=…`` holds every row of every
micro-batch, once, below its fate:

* ``kept``: the first row of its key,
* ``duplicate``: its key was kept before and is still remembered,
* ``late``: its event time is not after the watermark,
* ``undated``: it has no event time.

The watermark of a batch is the latest event time of the batches before it, in whole
milliseconds, less the delay.  A key is remembered until the watermark passes its event
time by the delay.  ``marks/batch=…`` holds what the next batch has to know (the latest
event time, the batches with keys that are still remembered, the counts so far), so the
work of a batch does not grow with the number of batches before it.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..sources.paths import load_text, remove, save_text
from .ingest import run_batches

FATES = ("kept", "duplicate", "late", "undated")
AT, ROW = "__at", "__row"


def sift_stream(
    df: DataFrame, target: str, keys: Sequence[str], ts: str, checkpoint: str, delay: dt.timedelta = dt.timedelta(minutes=10)
) -> StreamingQuery:
    """Take what is new in a stream into a sifted table and stop.

    Of the rows of one key in one batch the earliest is kept, ties by a hash of the other
    columns.  NULL is a key like any other.  A repeated batch replaces its own rows.  The
    counts of all batches so far are ``counts`` of the returned query.
    """
    spark = df.sparkSession

    def take(batch: DataFrame, batch_id: int) -> None:
        _sift(batch, batch_id, target, list(keys), ts, delay // dt.timedelta(microseconds=1))

    query = run_batches(df, checkpoint, take)
    query.counts = sift_counts(spark, target, max((p["batchId"] for p in query.progress), default=None))
    return query


def _sift(batch: DataFrame, batch_id: int, target: str, keys: list[str], ts: str, delay: int) -> None:
    spark = batch.sparkSession
    last = _mark(spark, target, batch_id - 1) if batch_id else {"latest": None, "live": [], "counts": dict.fromkeys(FATES, 0)}
    mark = None if last["latest"] is None else last["latest"] // 1000 * 1000 - delay
    staged_at = f"{target}/staged/batch={batch_id}"
    timed = batch.withColumns({AT: F.unix_micros(F.col(ts).cast("timestamp")), ROW: F.monotonically_increasing_id()})
    timed.write.mode("overwrite").parquet(staged_at)  # row numbers must not change between the two uses below
    staged = spark.read.schema(timed.schema).parquet(staged_at)

    late = F.lit(False) if mark is None else F.col(AT) <= mark
    # first row of each key: one narrow row per key and task is shuffled, however often a key occurs
    tied = [f.name for f in batch.schema if not isinstance(f.dataType, T.MapType)]
    on_time = staged.filter(F.col(AT).isNotNull() & ~late)
    order = F.struct(F.col(AT), F.xxhash64(*tied).alias("tie"), F.col(ROW))
    first = on_time.groupBy(*keys).agg(F.min(order).alias("first"))
    live = [(b, newest) for b, newest in last["live"] if newest > mark - delay]
    if live:
        kept = [f"{target}/rows/batch={b}/fate=kept" for b, _ in live]
        known = spark.read.schema(timed.drop(ROW).schema).parquet(*kept).filter(F.col(AT) > mark - delay).select(*keys)
        same = reduce(lambda a, b: a & b, [F.col(f"new.{k}").eqNullSafe(F.col(f"old.{k}")) for k in keys])
        first = first.alias("new").join(known.alias("old"), same, "left_anti")
    winners = first.select(F.col(f"first.{ROW}").alias(ROW), F.lit(True).alias("__won"))

    fate = F.when(F.col(AT).isNull(), "undated").when(late, "late").when(F.col("__won"), "kept").otherwise("duplicate")
    sifted = staged.join(winners, ROW, "left").withColumn("fate", fate).drop(ROW, "__won")
    seen = Observation()
    counts = [F.count_if(F.col("fate") == name).alias(name) for name in FATES]
    newest = F.max(F.when(F.col("fate") == "kept", F.col(AT)))
    sifted.observe(seen, *counts, F.max(AT).alias("latest"), newest.alias("newest")).write.mode("overwrite").partitionBy(
        "fate"
    ).parquet(f"{target}/rows/batch={batch_id}")

    found = seen.get
    latest = [t for t in (last["latest"], found["latest"]) if t is not None]
    if found["newest"] is not None:
        live.append((batch_id, found["newest"]))
    done = {
        "latest": max(latest, default=None),
        "live": live,
        "counts": {name: last["counts"][name] + found[name] for name in FATES},
    }
    save_text(spark, json.dumps(done), f"{target}/marks/batch={batch_id}")
    remove(spark, staged_at)


def _mark(spark: SparkSession, target: str, batch_id: int) -> dict:
    line = load_text(spark, f"{target}/marks/batch={batch_id}")
    if line is None:
        raise ValueError(f"{target} has no mark of batch {batch_id}; the checkpoint belongs to another table")
    return json.loads(line)


def sift_counts(spark: SparkSession, target: str, batch_id: int | None) -> dict[str, int]:
    """Rows of each fate in all batches up to this one; None where the run had no batch."""
    if batch_id is None:
        return dict.fromkeys(FATES, 0)
    return _mark(spark, target, batch_id)["counts"]


def read_sifted(spark: SparkSession, target: str, *fates: str) -> DataFrame:
    """The rows of these fates, of all fates if none is named, with their ``fate``."""
    unknown = set(fates) - set(FATES)
    if unknown:
        raise ValueError(f"unknown fates {sorted(unknown)}")
    rows = spark.read.parquet(f"{target}/rows").drop("batch", AT)
    return rows.filter(F.col("fate").isin(*fates)) if fates else rows

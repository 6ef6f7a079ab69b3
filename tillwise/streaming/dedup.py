"""Deduplication of event streams under a watermark, and the count of late rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def with_event_time(df: DataFrame, ts: str, delay: str = "10 minutes") -> DataFrame:
    """Cast the event time to a zoned timestamp and set the watermark on it."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def dedup_stream(
    df: DataFrame, keys: Sequence[str], ts: str, delay: str = "10 minutes", mode: str = "bounded"
) -> DataFrame:
    """First row per key; rows older than the watermark are dropped.

    ``bounded`` forgets a key once the watermark has passed it, so the state stays
    small and a key used again much later counts as new.  ``forever`` remembers every
    key, at the price of state that only grows.
    """
    marked = with_event_time(df, ts, delay)
    if mode == "bounded":
        return marked.dropDuplicatesWithinWatermark(list(keys))
    if mode == "forever":
        return marked.dropDuplicates(list(keys))
    raise ValueError(f"unknown mode {mode}")


def dedup_events(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The batch counterpart: earliest row per key, ties settled by the other columns."""
    from ..operators.windows import first_row

    rest = [c for c in df.columns if c not in keys and c != ts]
    return first_row(df, keys, [F.col(ts).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]])


def late_rows(query: StreamingQuery) -> int:
    """Rows that stateful operators dropped as later than the watermark, over all batches.

    For queries run by :mod:`tillwise.streaming.ingest`, which keeps every progress.
    """
    return sum(m["late_rows"] for m in progress_metrics(query))


def progress_metrics(query: StreamingQuery) -> list[dict]:
    """Per micro-batch: rows read, rows dropped as late, keys held in state."""
    out = []
    for p in query.progress:
        ops = p["stateOperators"]
        out.append(
            {
                "batch": p["batchId"],
                "input_rows": p["numInputRows"],
                "late_rows": sum(o.get("numRowsDroppedByWatermark", 0) for o in ops),
                "state_rows": sum(o.get("numRowsTotal", 0) for o in ops),
            }
        )
    return out


def observed(query: StreamingQuery, name: str) -> dict[str, int]:
    """Sums of the metrics that ``DataFrame.observe(name, …)`` took, over all batches."""
    out: dict[str, int] = {}
    for p in query.progress:
        row = p["observedMetrics"].get(name)
        for key, value in (row.asDict() if row is not None else {}).items():
            out[key] = out.get(key, 0) + (value or 0)
    return out

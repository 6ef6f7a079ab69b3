"""Token counts by heap-and-linked-list byte-pair merging, without making identifiers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import text_or_empty


def count_tokens(
    docs: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens, over_limit (more than ``limit``).

    A word counts as its initial symbols less the merges they go through.  Special
    strings inside a text count as one token, as the library has it by default.  The job
    is one pass without a shuffle; a task keeps the counts of recent chunks, at most a
    fixed number.  A NULL or empty text has 0 bytes and 0 tokens and is within the
    limit; texts of any length are counted whole.  A NULL id stays, repeated rows are
    counted each, other columns are ignored, an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = bpe.counter(vocabulary)
        for batch in batches:
            tokens = pa.array([count(t) for t in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), tokens], names=["id", "b", "n"])

    text = text_or_empty(text_col)
    read = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("b"), text.alias("text"))
    out = read.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, b long, n long")
    return out.select(
        F.col("id").alias(id_col), F.col("b").alias("n_bytes"), F.col("n").alias("n_tokens"), (F.col("n") > limit).alias("over_limit")
    )

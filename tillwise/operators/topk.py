"""Rankings and top-k selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import first_row, first_rows


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows of the whole table (a heap per task, no global sort)."""
    return df.orderBy(*order).limit(k)


def top_bottom(df: DataFrame, by: str, tie: str, k: int = 10) -> DataFrame:
    """The k best and the k worst rows with their position in either list.

    With fewer than ``2 * k`` rows both lists share rows.
    """
    def side(name: str, order: Sequence[Column]) -> DataFrame:
        picked = df.withColumn("ranking", F.lit(name))
        return first_rows(picked.orderBy(*order).limit(k), ["ranking"], order, k, rank="position")

    best = side("top", [F.col(by).desc_nulls_last(), F.col(tie).asc()])
    worst = side("bottom", [F.col(by).asc_nulls_first(), F.col(tie).desc()])
    return best.unionByName(worst)


def topk_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    return first_rows(df, keys, order, k, rank=rank)


def first_match(df: DataFrame, keys: Sequence[str], pred: Column, order: Sequence[Column]) -> DataFrame:
    """First row per key, in order, that satisfies the predicate."""
    return first_row(df.filter(pred), keys, order)

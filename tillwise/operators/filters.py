"""Row selection from optional conditions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import conjunction
from .skew import skew_safe_join


def apply_filters(
    df: DataFrame,
    one_of: Mapping[str, Sequence[Any] | None] | None = None,
    between: Mapping[str, tuple[Any, Any]] | None = None,
    equals: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Conjunction of the conditions that are set; an absent one does not filter.

    ``one_of`` is a multi-select, ``between`` a closed range whose ends may be
    ``None``, ``equals`` a single choice.
    """
    preds: list[Column] = []
    for name, values in (one_of or {}).items():
        if values:
            preds.append(F.col(name).isin(list(values)))
    for name, (low, high) in (between or {}).items():
        if low is not None:
            preds.append(F.col(name) >= F.lit(low))
        if high is not None:
            preds.append(F.col(name) <= F.lit(high))
    for name, value in (equals or {}).items():
        if value is not None:
            preds.append(F.col(name) == F.lit(value))
    return df.filter(conjunction(preds)) if preds else df


def having_entity(df: DataFrame, entity: str, condition: Column, aggregates: Mapping[str, Column]) -> DataFrame:
    """Rows of the entities whose aggregates satisfy the condition.

    The aggregates are reduced to one row per entity before the semi join.
    """
    chosen = df.groupBy(entity).agg(*[c.alias(n) for n, c in aggregates.items()]).filter(condition)
    return skew_safe_join(df, chosen.select(entity), [entity], "left_semi")


def flag(pred: Column) -> Column:
    """1 where the predicate holds, otherwise 0 (also for NULL)."""
    return F.when(pred, F.lit(1)).otherwise(F.lit(0))

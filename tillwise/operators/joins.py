"""Joins.  Strategy is left to Catalyst: it broadcasts a side only below the
session's size threshold and AQE splits skewed partitions of the larger side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import same_bucket, skew_safe_join
from .windows import first_row


def enrich(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str] | str,
    cols: Sequence[str],
    prefix: str = "",
    matched: str | None = None,
    key_type: str | None = None,
) -> DataFrame:
    """Left join that adds ``cols`` of a dimension to a fact.

    ``on`` maps fact key to dimension key.  ``matched`` names a boolean column that
    tells whether the key was found; ``key_type`` casts both keys first, and a key
    that does not convert finds nothing.  Hot fact keys stay splittable, also when the
    dimension was just grouped by the key.
    """
    pairs = {on: on} if isinstance(on, str) else dict(on)
    tmp = {f: f"__key_{i}" for i, f in enumerate(pairs)}
    right = dim.select(
        *[(F.col(d).try_cast(key_type) if key_type else F.col(d)).alias(tmp[f]) for f, d in pairs.items()],
        *[F.col(c).alias(prefix + c) for c in cols],
    )
    if matched:
        right = right.withColumn(matched, F.lit(True))
    left_keys = [F.col(f).try_cast(key_type) if key_type else F.col(f) for f in pairs]
    cond = same_bucket(*left_keys) == same_bucket(*tmp.values())
    for key, name in zip(left_keys, tmp.values()):
        cond = cond & (key == F.col(name))
    out = fact.join(right, cond, "left").drop(*tmp.values())
    if matched:
        out = out.withColumn(matched, F.coalesce(F.col(matched), F.lit(False)))
    return out


def join_first(
    left: DataFrame, right: DataFrame, on: str, order: Sequence[Column], cols: Sequence[str]
) -> DataFrame:
    """Left join with only the first right-hand row per key, so rows never multiply."""
    first = first_row(right, [on], order).select(on, *cols)
    return skew_safe_join(left, first, [on], "left")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent; a NULL key has none."""
    keys = parent.select(F.col(parent_key).alias("__parent"))
    return child.join(keys, F.col(child_key) == F.col("__parent"), "left_anti")


def vs_group(per_entity: DataFrame, on: Sequence[str], value: str, reference: DataFrame, ref_value: str) -> DataFrame:
    """Value of every entity next to a reference value: absolute and relative gap."""
    out = skew_safe_join(per_entity, reference, on, "inner")
    gap = F.col(value) - F.col(ref_value)
    return out.withColumns({"gap": gap, "gap_ratio": F.try_divide(gap, F.col(ref_value))})

"""Joins on keys that a few hot values dominate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_bucket(*keys: Column | str) -> Column:
    """A constant, computed from the keys so that Spark treats it as a join column."""
    return F.pmod(F.xxhash64(*keys), F.lit(1))


def skew_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", null_safe: bool = False
) -> DataFrame:
    """Join whose sides are both shuffled for this join, so that AQE can split hot keys.

    A right side that was grouped or ranked by the same key arrives partitioned by it.
    Spark then shuffles only the left side, and AQE, which splits pairs of shuffles,
    leaves the hot partition whole.  One more join column, a function of the key, asks
    for a partitioning the right side does not have yet; its few rows move once more.
    With ``null_safe`` a NULL key finds the NULL key.
    """
    names = [f"__right_{k}" for k in keys]
    other = right.withColumnsRenamed(dict(zip(keys, names)))
    cond = same_bucket(*keys) == same_bucket(*names)
    for k, n in zip(keys, names):
        cond = cond & (F.col(k).eqNullSafe(F.col(n)) if null_safe else F.col(k) == F.col(n))
    return left.join(other, cond, how).drop(*names)


def hot_keys(df: DataFrame, key: str, share: int = 1000) -> DataFrame:
    """Keys holding more than one ``share``-th of the rows.

    At most ``share`` keys can qualify, whatever the size of the data, which makes
    this set safe to broadcast.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("__n"))
    total = df.agg(F.count("*")).scalar()
    return counts.filter(F.col("__n") * F.lit(share) > total).select(F.col(key).alias("__hot"))


def salted_join(
    fact: DataFrame, dim: DataFrame, key: str, row_id: Sequence[str], salts: int = 64, share: int = 1000
) -> DataFrame:
    """Left join on a key that a few hot values dominate.

    Fact rows of a hot key are spread over ``salts`` buckets by a hash of the row
    identity and the matching dimension rows repeated once per bucket; every other
    key keeps bucket zero.  AQE does the like at run time; this form also holds when
    the join result must stay partitioned by the key.
    """
    hot = F.broadcast(hot_keys(fact, key, share))
    spread = F.pmod(F.xxhash64(*row_id), F.lit(salts)).cast("int")
    left = (
        fact.join(hot, F.col(key) == F.col("__hot"), "left")
        .withColumn("__salt", F.when(F.col("__hot").isNotNull(), spread).otherwise(F.lit(0)))
        .drop("__hot")
    )
    copies = F.when(F.col("__hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = (
        dim.join(hot, F.col(key) == F.col("__hot"), "left")
        .withColumn("__salt", F.explode(copies))
        .drop("__hot")
    )
    return left.join(right, [key, "__salt"], "left").drop("__salt")

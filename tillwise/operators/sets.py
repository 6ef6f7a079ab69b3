"""Unions, key differences and reproducible samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def union_tagged(branches: Mapping[str, DataFrame], tag: str = "type") -> DataFrame:
    """UNION ALL of the branches, each row labelled with its branch name."""
    out: DataFrame | None = None
    for name, df in branches.items():
        part = df.withColumn(tag, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("nothing to union")
    return out


def union_flows(flows: Sequence[DataFrame]) -> DataFrame:
    """Several sources into one target; a column a source lacks is NULL there.

    Works on streams as well, where it makes one query with one sink.
    """
    out = flows[0]
    for df in flows[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def key_difference(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Distinct keys of the left table that the right table lacks.

    The left keys are made distinct first, so a hot key reaches the join once.
    """
    return left.select(left_key).distinct().subtract(right.select(F.col(right_key).alias(left_key)))


#: leading hex digits of the hash that form a bucket of :func:`sample_exact`
SAMPLE_BUCKET_DIGITS = 4


def sample_exact(df: DataFrame, n: int, key: Sequence[str], seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows, the same ones on every run: those with the smallest key hash.

    The hash is the MD5 of the seed and the key values as text, joined by colons, so any
    other system finds the same rows.  ``key`` must identify a row.  Hash buckets are counted first (65,536 at most); all
    buckets below the cut are taken whole where they are, and only the bucket at the
    cut is sorted.
    """
    cols = [F.col(c) for c in key]
    text = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *text))
    bucket = F.substring(h, 1, SAMPLE_BUCKET_DIGITS)
    sizes = df.groupBy(bucket.alias("b")).agg(F.count("*").alias("c"))
    upto = sizes.withColumn("upto", F.sum("c").over(W.orderBy("b")))
    cut = upto.filter(F.col("upto") >= n).orderBy("b").limit(1).first()
    if cut is None:
        return df  # fewer rows than asked for
    below = df.filter(bucket < cut["b"])
    rest = n - (cut["upto"] - cut["c"])
    return below.unionByName(df.filter(bucket == cut["b"]).orderBy(h, *cols).limit(rest))

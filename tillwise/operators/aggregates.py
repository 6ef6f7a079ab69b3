"""Grouped measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import rate
from .filters import flag


def rates(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column], total: str = "total") -> DataFrame:
    """Per key: row count, and for each name the share of rows where its predicate holds."""
    out = df.groupBy(*keys).agg(
        F.count("*").alias(total), *[F.sum(flag(p)).alias(f"__{n}") for n, p in flags.items()]
    )
    return out.select(*keys, total, *[rate(f"__{n}", total).alias(n) for n in flags])


def pivot_sums(value: str, by: str, wanted: Mapping[str, Sequence[str]], other: str | None = None) -> list[Column]:
    """Conditional sums: one column per named list of codes, and one for all others.

    A NULL code is in no list and not among the others.
    """
    cols = [
        F.sum(F.when(F.col(by).isin(list(codes)), F.col(value)).otherwise(F.lit(0))).alias(name)
        for name, codes in wanted.items()
    ]
    if other:
        every = [c for codes in wanted.values() for c in codes]
        cols.append(
            F.sum(F.when(~F.col(by).isin(every), F.col(value)).otherwise(F.lit(0))).alias(other)
        )
    return cols


def flag_rate(pred: Column, digits: int = 4) -> Column:
    """Share of rows where the predicate holds, rounded."""
    return F.round(F.avg(F.when(pred, F.lit(1.0)).otherwise(F.lit(0.0)).cast("double")), digits)


def ever(pred: Column) -> Column:
    """1 when the predicate holds for some row of the group."""
    return F.max(flag(pred))


def mean(value: str) -> Column:
    """Average of an exactly summed amount, as double."""
    return F.sum(value).cast("double") / F.count(value)


def first_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Mapping[str, str], ignore_nulls: bool = False
) -> DataFrame:
    """First value per key in an explicit order.

    ``cols`` maps source column to result name.  With ``ignore_nulls`` each column
    takes its own first value that is present.
    """
    position = F.struct(*order)
    picks = []
    for source, name in cols.items():
        at = F.when(F.col(source).isNotNull(), position) if ignore_nulls else position
        # the value is wrapped so that a NULL in the first row is kept as such
        picks.append(F.min_by(F.struct(F.col(source).alias("v")), at).alias(f"__{name}"))
    out = df.groupBy(*keys).agg(*picks)
    return out.select(*keys, *[F.col(f"__{n}.v").alias(n) for n in cols.values()])


def with_share(df: DataFrame, by: Sequence[str], digits: int | None = 1, count: str = "cnt", pct: str = "pct") -> DataFrame:
    """Row count per group and its percentage of all rows.

    The total comes from a scalar subquery; no window gathers the groups in one task.
    """
    groups = df.groupBy(*by).agg(F.count("*").alias(count))
    total = groups.agg(F.sum(count)).scalar()
    value = F.col(count) * F.lit(100.0) / total
    return groups.withColumn(pct, F.round(value, digits) if digits is not None else value)


def index_to_mean(periods: DataFrame, value: str, out: str = "index") -> DataFrame:
    """Value of each period relative to the mean over all periods."""
    base = periods.agg(F.sum(value).cast("double") / F.count(value)).scalar()
    return periods.withColumn(out, F.try_divide(F.col(value).cast("double"), base))


def counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table, one row per name."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dict_agg(df: DataFrame, keys: Sequence[str], spec: Mapping[str, str], names: Mapping[str, str]) -> DataFrame:
    """``{column: function}`` aggregation with result names per source column."""
    out = df.groupBy(*keys).agg(dict(spec))
    for col, fn in spec.items():
        out = out.withColumnRenamed(f"{fn}({col})", names[col])
    return out


def distinct_sketches(df: DataFrame, by: Sequence[str | Column], col: str, lg_k: int = 12, out: str = "sketch") -> DataFrame:
    """Per group a sketch of the distinct values of a column, to be stored and united later.

    A sketch has at most 2^lg_k registers whatever the group's size.  Its relative
    standard error is about 1.04 / sqrt(2^lg_k), 1.6 % by default.  NULL is not counted.
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(col, lg_k).alias(out))


def unite_sketches(sketches: DataFrame, by: Sequence[str | Column], out: str = "distinct", sketch: str = "sketch") -> DataFrame:
    """Estimated distinct values per coarser group, from stored sketches alone.

    Counts of parts can't be added, as values repeat; sketches can be united in any order.
    """
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(out))

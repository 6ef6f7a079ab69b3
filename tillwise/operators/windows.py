"""First rows, sequences, modes and shares per group.

``row_number() <= k`` plans a group limit before the shuffle: every task sends at
most ``k`` rows per key, so a hot key costs ``k`` rows per task and no more.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import Col, _c
from .skew import skew_safe_join


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows per key in the given order; ``rank`` keeps the position."""
    name = rank or "__rn"
    w = W.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)
    return out if rank else out.drop(name)


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return first_rows(df, keys, order, 1)


def dedup_latest(df: DataFrame, keys: Sequence[str], latest: Sequence[str]) -> DataFrame:
    """One row per key: the latest by ``latest``, then by every other column.

    The remaining columns break ties, so rows that still tie are equal.
    """
    rest = [c for c in df.columns if c not in keys and c not in latest]
    order = [F.col(c).desc_nulls_last() for c in latest] + [F.col(c).asc_nulls_last() for c in rest]
    return first_row(df, keys, order)


def dedup_repeated(df: DataFrame, keys: Sequence[str], latest: Sequence[str]) -> DataFrame:
    """:func:`dedup_latest` for keys that are nearly unique.

    Keys are counted first; rows whose key stands alone pass without being sorted, and
    only the others are ranked.  A NULL key is a key.
    """
    repeated = df.groupBy(*keys).agg(F.count("*").alias("__n")).filter("__n > 1")
    marked = skew_safe_join(df, repeated, keys, "left", null_safe=True)
    alone = marked.filter("__n IS NULL").drop("__n")
    return alone.unionByName(dedup_latest(marked.filter("__n IS NOT NULL").drop("__n"), keys, latest))


def dedup_report(before: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before and after dropping duplicate keys, without building the result."""
    per_key = before.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.sum("n").alias("rows_before"),
        F.count("*").alias("rows_after"),
        (F.sum("n") - F.count("*")).alias("rows_removed"),
    )


UNITS = ("month", "day", "hour", "minute")

#: Most parts a crowded bucket is split into, and sampled rows per part.
PARTS, DRAWN = 256, 32


def _bucket_unit(df: DataFrame, entity: str, ts: str, most: int) -> str:
    """The coarsest unit in which no entity has more than ``most`` rows, else the minute; one job counts them all."""
    fine = df.groupBy(F.col(entity).alias("e"), F.date_trunc("minute", F.col(ts)).alias("t")).agg(F.count("*").alias("n"))
    grains = F.explode(F.array(*[F.struct(F.lit(u).alias("unit"), F.date_trunc(u, F.col("t")).alias("at")) for u in UNITS]))
    sizes = fine.select("e", "n", grains.alias("g")).groupBy("e", "g").agg(F.sum("n").alias("n"))
    largest = {r["unit"]: r["n"] for r in sizes.groupBy("g.unit").agg(F.max("n").alias("n")).collect()}
    return next((u for u in UNITS if largest.get(u, 0) <= most), "minute")


def split_crowded(df: DataFrame, entity: str, bucket: str, order: Sequence[str], most: int, out: str) -> DataFrame:
    """Number the parts that crowded (entity, bucket) pairs are cut into, 0 for all others.

    A pair with more than ``most`` rows is cut by splitters, values of ``order`` drawn
    from its rows by hash; a part has about half of ``most`` rows, or a 256th of the pair
    where that is more.  Rows equal in all of ``order`` share a part.  Parts follow the
    order, so positions within them add up.
    """
    at = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    pair = [F.col(entity).alias("__ce"), F.col(bucket).alias("__cb")]
    crowded = df.groupBy(*pair).agg(F.count("*").alias("__cn")).filter(F.col("__cn") > most)
    parts = F.least(F.ceil(F.col("__cn") * 2 / most), F.lit(PARTS))
    same = F.col(entity).eqNullSafe(F.col("__ce")) & F.col(bucket).eqNullSafe(F.col("__cb"))
    drawn = df.join(crowded, same).filter(F.pmod(F.xxhash64(entity, *order), F.col("__cn")) < DRAWN * parts)
    cuts = drawn.groupBy("__ce", "__cb").agg(F.array_sort(F.collect_list(at)).alias("__cuts"))
    cuts = cuts.select("__ce", "__cb", F.filter("__cuts", lambda x, i: i % DRAWN == DRAWN - 1).alias("__cuts"))
    part = F.coalesce(F.size(F.filter("__cuts", lambda x: x < at)), F.lit(0))
    return df.join(cuts, same, "left").withColumn(out, F.when(F.col("__cuts").isNull(), 0).otherwise(part)).drop("__ce", "__cb", "__cuts")


def event_sequence(
    df: DataFrame, entity: str, ts: str, tie: Sequence[str], out: str = "seq", bucket: Column | None = None,
    bucket_rows: int = 1_000_000,
) -> DataFrame:
    """Position 1, 2, 3 … of every event of an entity.

    The rows of one entity are never gathered in one task: they are numbered within
    (entity, time bucket, part) and shifted by the count of the earlier ones.  ``bucket``
    must grow with ``ts``; by default it is the coarsest calendar unit in which no entity
    has more than ``bucket_rows`` rows, the minute at the finest.  A minute with more rows
    is cut into parts by time and ``tie``; a bucket the caller chose is taken as it is.
    """
    order = [ts, *tie]
    if bucket is not None:
        bucketed = df.withColumns({"__b": bucket, "__s": F.lit(0)})
    else:
        unit = _bucket_unit(df, entity, ts, bucket_rows)
        bucketed = df.withColumn("__b", F.date_trunc(unit, F.col(ts)))
        if unit == "minute":
            bucketed = split_crowded(bucketed, entity, "__b", order, bucket_rows, "__s")
        else:
            bucketed = bucketed.withColumn("__s", F.lit(0))
    sizes = bucketed.groupBy(entity, "__b", "__s").agg(F.count("*").alias("__n"))
    earlier = W.partitionBy(entity).orderBy("__b", "__s").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(entity).alias("__e"),
        F.col("__b").alias("__ob"),
        F.col("__s").alias("__os"),
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
    )
    within = W.partitionBy(entity, "__b", "__s").orderBy(*[F.col(c) for c in order])
    numbered = bucketed.withColumn("__pos", F.row_number().over(within))
    return (
        numbered.join(
            offsets,
            F.col(entity).eqNullSafe(F.col("__e"))
            & F.col("__b").eqNullSafe(F.col("__ob"))
            & (F.col("__s") == F.col("__os")),
        )
        .withColumn(out, F.col("__before") + F.col("__pos"))
        .drop("__b", "__ob", "__s", "__os", "__e", "__n", "__pos", "__before")
    )


def first_event_flag(
    events: DataFrame,
    entities: DataFrame,
    entity: str,
    event_id: str,
    ts: str,
    since: str,
    days: int = 30,
) -> DataFrame:
    """(event id, is_first_order): the entity's first event, at most ``days`` days
    after the entity's ``since`` date.

    The first event is found by aggregation (one row per entity); it is matched back
    by event id, which has no hot value.
    """
    first = (
        events.groupBy(entity)
        .agg(F.min(F.struct(F.col(ts), F.col(event_id))).alias("__first"))
        .select(entity, F.col(f"__first.{event_id}").alias("__id"), F.col(f"__first.{ts}").alias("__ts"))
    )
    flagged = (
        first.join(entities.select(entity, since), entity, "left")
        .filter(F.datediff(F.to_date("__ts"), F.col(since)) <= days)
        .select("__id")
    )
    return (
        events.select(event_id)
        .join(flagged.withColumn("__hit", F.lit(True)), F.col(event_id) == F.col("__id"), "left")
        .select(event_id, F.coalesce(F.col("__hit"), F.lit(False)).alias("is_first_order"))
    )


def modes(df: DataFrame, key: str, values: Mapping[str, str]) -> DataFrame:
    """Most frequent value per key of several text columns; the smaller value wins a tie.

    ``values`` maps source column to result name.  Values are counted per key in one
    hash aggregation, so no map of them travels.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(c).alias("value")) for c, n in values.items())))
    counts = df.select(key, pairs.alias("x")).filter("x.value IS NOT NULL").groupBy(key, "x.name", "x.value").agg(F.count("*").alias("n"))
    # the largest count, and among equals the smallest value
    per_name = counts.groupBy(key, "name").agg(F.max("n").alias("most")).withColumnsRenamed({key: "__key", "name": "__name"})
    best = counts.join(per_name, F.col(key).eqNullSafe(F.col("__key")) & (F.col("name") == F.col("__name")) & (F.col("n") == F.col("most")))
    return best.groupBy(key).agg(*(F.min(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in values.values()))


def mode_by(df: DataFrame, keys: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """Most frequent value per key; the smaller value wins a tie."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("__n"))
    top = first_row(counts, keys, [F.col("__n").desc(), F.col(value).asc_nulls_last()])
    return top.select(*keys, F.col(value).alias(out or value))


def share_within(df: DataFrame, keys: Sequence[str], value: Col, out: str) -> DataFrame:
    """Value as a fraction of the sum over its group.

    The sums are aggregated (with partial sums per task) and joined back; the rows of
    a large group are never gathered in one task as a window would.
    """
    valued = df.withColumn("__v", _c(value).cast("double"))
    sums = valued.groupBy(*keys).agg(F.sum("__v").alias("__sum"))
    return (
        skew_safe_join(valued, sums, keys, "inner", null_safe=True)
        .withColumn(out, F.try_divide(F.col("__v"), F.col("__sum")))
        .drop("__v", "__sum")
    )


def first_last_growth(periods: DataFrame, period: str, value: str) -> DataFrame:
    """Value of the first and of the last period, and last / first."""
    return periods.agg(
        F.min(period).alias("first_period"),
        F.max(period).alias("last_period"),
        F.min_by(value, period).alias("first_value"),
        F.max_by(value, period).alias("last_value"),
    ).withColumn(
        "growth", F.try_divide(F.col("last_value").cast("double"), F.col("first_value").cast("double"))
    )


def same_period_last_year(month_index: str, value: str, keys: Sequence[str]) -> Column:
    """Value twelve months earlier, by month number; NULL when that month is missing."""
    w = W.partitionBy(*keys).orderBy(month_index).rangeBetween(-12, -12)
    return F.first(value).over(w)

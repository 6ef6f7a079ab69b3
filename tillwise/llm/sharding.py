"""Shards of near equal size, cut from runs along a Hilbert curve through the metadata."""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType
from pyspark.sql.window import Window

from tillwise.operators.skew import skew_safe_join

from .common import stored, text_or_empty

#: Bits of a position behind those of the curve: a hash of the text, then one of the id.
SUB_BITS = 10

#: Rows that one task numbers.
BLOCK_ROWS = 50_000

#: Most distinct values of a text dimension whose frequencies the driver sees, and how
#: many characters of a value count for its order.
NAMES, PREFIX = 10_000, 256


def curve_index(levels: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of points with ``levels`` (dimensions, points) below 2^bits.

    Turns and flips every octant so that it begins where the one before ends, then takes
    the Gray code and interleaves the bits (Skilling's transposed form).
    """
    x = levels.astype("int64").copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(flip, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            index = index << 1 | (x[i] >> bit & 1)
    return index


def dimension_value(df: DataFrame, name: str) -> Column:
    """What a dimension is ordered by: a number, else the first characters of the value as text.

    ``size`` is the size computed here, also where the caller has a column of that name.
    """
    if name == "size":
        return F.col("__size").cast("double")
    if name not in df.columns:
        raise ValueError(f"there is no column {name} to order by")
    if isinstance(df.schema[name].dataType, NumericType):
        return F.coalesce(F.col(name).cast("double"), F.lit(float("-inf")))
    return F.left(F.coalesce(F.col(name).cast("string"), F.lit("")), F.lit(PREFIX))


def quantised(base: DataFrame, names: list[str], shares: list[float]) -> list[Column]:
    """For each column the number of its quantiles that a value lies above.

    A text column with at most ``NAMES`` distinct values has exact quantiles, from their
    frequencies.  One with more is ordered by the seven bytes that follow what its
    smallest and its largest value begin with alike.  Other quantiles are approximate.
    """
    cuts: dict[str, list] = {}
    values = {n: F.col(n) for n in names}
    for n in names:
        if isinstance(base.schema[n].dataType, NumericType):
            continue
        counts = base.groupBy(n).count()
        found = sorted(((r[0].encode(), r["count"], r[0]) for r in counts.limit(NAMES + 1).collect()))
        if len(found) <= NAMES:
            cuts[n] = _weighted_cuts([(text, count) for _, count, text in found], shares)
            continue
        ends = [x.encode() for x in base.agg(F.min(n), F.max(n)).first()]
        alike = len(os.path.commonprefix(ends))
        start = F.hex(F.substring(F.col(n).cast("binary"), F.lit(alike + 1), F.lit(7)))
        values[n] = F.conv(F.rpad(start, 14, "0"), 16, 10).cast("double")
    asked = [n for n in names if n not in cuts]
    if asked:
        cuts.update(base.agg(*(F.percentile_approx(values[n], shares, 10000).alias(n) for n in asked)).first().asDict())
    return [_below(list(dict.fromkeys(cuts[n] or ())), values[n]) for n in names]


def _weighted_cuts(counted: list[tuple[str, int]], shares: list[float]) -> list[str]:
    """The values at which these shares of all rows are reached, from (value, rows) in order."""
    total, seen, out = sum(n for _, n in counted), 0, []
    for value, n in counted:
        seen += n
        while len(out) < len(shares) and seen >= shares[len(out)] * total:
            out.append(value)
    return out


def _below(cuts: list, value: Column) -> Column:
    """How many of the cuts are smaller."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < value)) if cuts else F.lit(0)


def _cuts(rows: DataFrame, shards: int, curve_bits: int, slack: float) -> list[int]:
    """Positions at which shards 1, 2, ... begin.

    Bytes are summed by cell of the curve, then only in the cells a cut falls into by the
    hash of the text, then only in the buckets that are still too large by that of the
    id.  Each sum has a fixed number of rows, whatever the data.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    goals = [total * k // shards for k in range(1, shards)]
    low_bits = 2 * SUB_BITS
    found: dict[int, int] = {}
    # goal -> start and end of the range of positions that it falls into, bytes before it
    spans = {g: (0, 1 << (curve_bits + low_bits), 0) for g in goals}
    for width in (low_bits, SUB_BITS, 0):
        left = [g for g in goals if g not in found]
        if not left:
            break
        inside = F.lit(False)
        for start, end in {spans[g][:2] for g in left}:
            inside |= (F.col("position") >= start) & (F.col("position") < end)
        sums = rows.filter(inside).groupBy(F.shiftright("position", width).alias("bucket")).agg(F.sum("size").alias("size"))
        table = sorted((r.bucket << width, r.size) for r in sums.collect())
        for g in left:
            start, end, before = spans[g]
            for at, size in (t for t in table if start <= t[0] < end):
                if before + size >= g:
                    break
                before += size
            else:
                found[g] = end
                continue
            near = min((g - before, at), (before + size - g, at + (1 << width)))
            if near[0] <= slack * total / shards or not width:
                found[g] = near[1]
            spans[g] = (at, at + (1 << width), before)
    return [found[g] for g in goals]


def shard_by_curve(
    docs: DataFrame,
    shards: int = 8,
    dimensions: tuple[str, ...] = ("source", "lang", "size"),
    bits: int = 4,
    slack: float = 0.005,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, curve, law, shard, slot, grown_shard.

    Every dimension (a column, or ``size``, always the bytes of the text plus 1) is quantised
    into 2^bits levels of about equal frequency that keep its order; a dimension that
    ``docs`` lacks raises ValueError.  The levels' place on a Hilbert curve is the row's
    cell, of copies of a text the first of theirs.  Rows are ordered by cell, then by
    hashes of the text and of the id, and cut into ``shards`` runs of equal bytes (law ``bytes``).  A cut
    lies at the border of a cell or between texts, so equal texts stay together, unless
    that is more than ``slack`` of a shard off; then it lies between ids.  A run covers
    few levels of every dimension, so files written by shard and slot can be pruned.

    Texts are read once; what is shuffled afterwards are numbers.  Rows are numbered in
    blocks of about ``BLOCK_ROWS``, whose counts are summed up, so neither a shard nor a
    hot text is numbered in one task.

    A NULL text has size 1 and the checksum of the empty text.  NULL dimensions come
    first.  Rows that repeat an id and its text lie next to each other and get a slot
    each.  Other columns are ignored, an empty table gives an empty result.  With more
    shards rows move anew, so grown_shard is NULL.
    """
    text = text_or_empty(text_col)
    sized = docs.withColumn("__size", (F.octet_length(text) + 1).cast("long"))
    numbers = [dimension_value(docs, d) for d in dimensions]
    low = 1 << SUB_BITS
    base = sized.select(
        F.col(id_col).alias("id"),
        F.col("__size").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64(text).alias("text"),
        *(n.alias(f"d{i}") for i, n in enumerate(numbers)),
    )
    base = stored(base, "shard-rows")
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    levels = quantised(base, [f"d{i}" for i in range(len(numbers))], shares)

    @F.pandas_udf("long")
    def curve(*series: pd.Series) -> pd.Series:
        return pd.Series(curve_index(np.stack([s.to_numpy("int64") for s in series]), bits))

    rows = base.withColumn("own", curve(*levels)).select("id", "size", "crc", "text", "own")
    copies = ["text", "crc", "size"]
    rows = skew_safe_join(rows, rows.groupBy(*copies).agg(F.min("own").alias("curve")), copies, "inner")
    by_text, by_id = F.pmod("text", F.lit(low)), F.pmod(F.xxhash64("id"), F.lit(low))
    rows = rows.withColumn("position", (F.col("curve") * low + by_text) * low + by_id)
    rows = stored(rows.select("id", "size", "crc", "curve", "position"), "shard-positions")
    cuts = _cuts(rows, shards, bits * len(numbers), slack)
    rows = rows.withColumn("shard", _below(cuts, F.col("position") + 1)).withColumn("block", F.shiftright("position", SUB_BITS + 4))

    crowded = rows.groupBy("shard", "block").count().filter(F.col("count") > BLOCK_ROWS)
    crowded = crowded.select("shard", "block", F.ceil(F.col("count") / BLOCK_ROWS).alias("parts"))
    rows = skew_safe_join(rows, crowded, ["shard", "block"], "left")
    rows = rows.withColumn("part", F.coalesce(F.pmod(F.xxhash64("id", "crc"), "parts"), F.lit(0)).cast("long")).drop("parts")
    keys = ["shard", "block", "part"]
    counts = rows.groupBy(*keys).count()
    earlier = Window.partitionBy("shard").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("start"))
    out = skew_safe_join(rows, starts, keys, "left")
    within = Window.partitionBy(*keys).orderBy("position", "crc", "id")
    return out.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        "curve",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("start") + F.row_number().over(within) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write each shard as files ordered by slot; ids are unique.

    Columns ``shard`` and ``slot`` of ``docs`` give way to those of ``placed``.
    """
    rows = docs.drop("shard", "slot").join(placed.select(id_col, "shard", "slot"), id_col)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

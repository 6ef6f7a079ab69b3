"""Column helpers, stored intermediate tables and key filters shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bits of one piece of a key bitmap, as Spark's bitmap functions cut them (4 KB).
PIECE_BITS = 32768


def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_az(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    only_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def stored(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write a table to the shared scratch folder and read it back.

    Cuts the lineage at files that outlive any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_bitmap(keys: DataFrame, key: Column, count: int, max_bits: int = 1 << 27) -> tuple[DataFrame, int]:
    """A bitmap of hashed keys: rows (piece, bits) and its length in bits.

    Sixteen bits a key up to ``max_bits`` (16 MB), which bounds its size whatever the
    number of keys; beyond that it lets more keys through, never fewer.
    """
    bits = PIECE_BITS
    while bits < min(16 * count, max_bits):
        bits *= 2
    pos = F.pmod(F.xxhash64(key), F.lit(bits))
    pieces = keys.groupBy(F.bitmap_bucket_number(pos).alias("__piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(pos)).alias("__bits")
    )
    return pieces, bits


def flag_members(df: DataFrame, key: Column, bitmap: tuple[DataFrame, int], flag: str) -> DataFrame:
    """Add a boolean that is true for every row whose key is in the bitmap.

    It may be true for a few others.  The bitmap is broadcast; ``key_bitmap`` bounds it.
    """
    pieces, bits = bitmap
    pos = F.pmod(F.xxhash64(key), F.lit(bits))
    probe = df.withColumns({"__at": F.bitmap_bucket_number(pos), "__bit": F.bitmap_bit_position(pos)})
    out = probe.join(F.broadcast(pieces), F.col("__at") == F.col("__piece"), "left")
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.col("__bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.expr("shiftleft(1, cast(__bit % 8 as int))")) != 0
    return out.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("__at", "__bit", "__piece", "__bits")


def without(df: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is not among ``dropped``; a NULL key is never dropped.

    Only rows that a bitmap of the dropped keys lets through are shuffled, so the bulk
    of the texts stays where it is.  ``dropped`` should be a stored table.
    """
    bitmap = key_bitmap(dropped, F.col(key), dropped.count())
    flagged = flag_members(df, F.col(key), bitmap, "__maybe")
    kept = flagged.filter(~F.col("__maybe"))
    asked = flagged.filter(F.col("__maybe")).join(dropped.select(key), key, "left_anti")
    return kept.unionByName(asked.select(kept.columns)).select(df.columns)


#: Column that names a row where decisions are taken by row.
ROW = "__row"


def named(docs: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with the column ``ROW``, and rows (ROW, id) of those whose name is not their id.

    A row whose id no other row has is named by it.  Rows that share an id, or have none,
    are named by a 64-bit hash of all their columns, so only rows equal in every column
    share a name.  Where there are no such rows, the second result is None.
    """
    kind = docs.schema[id_col].dataType
    if not isinstance(kind, (T.IntegralType, T.StringType)):
        raise TypeError(f"{id_col} is neither a whole number nor text")
    key = F.col(id_col)
    counts = docs.groupBy(key.alias("__id")).agg(F.count("*").alias("__n"))
    odd = stored(counts.filter("__n > 1 OR __id IS NULL").select("__id", F.lit(True).alias("__odd")), "odd-ids")
    n = odd.count()
    if not n:
        return docs.withColumn(ROW, key), None
    flagged = flag_members(docs, key, key_bitmap(odd, F.col("__id"), n), "__maybe")
    sure = flagged.filter(~F.col("__maybe") & key.isNotNull()).withColumn(ROW, key.cast("long") if isinstance(kind, T.IntegralType) else key)
    asked = flagged.filter(F.col("__maybe") | key.isNull()).join(odd, key.eqNullSafe(F.col("__id")), "left")
    digest = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    digest = digest if isinstance(kind, T.IntegralType) else F.concat(F.lit("\0"), digest.cast("string"))
    asked = asked.withColumn(ROW, F.when(F.col("__odd"), digest).otherwise(key))
    rows = sure.unionByName(asked.drop("__id", "__odd")).drop("__maybe")
    return rows, stored(asked.filter("__odd").select(ROW, key.alias("__id")), "odd-rows")


def losers(groups: DataFrame, odd: DataFrame | None, keep: str = "smallest") -> DataFrame:
    """Of rows (ROW, group) those that don't stay: in each group the row with the smallest or largest id does.

    A NULL id never wins against another; equal ids go by name.
    """
    rows = groups.withColumn("__id", F.col(ROW))
    if odd is not None:
        named_apart = odd.distinct().select(ROW, F.struct("__id").alias("__own"))
        rows = groups.join(named_apart, ROW, "left").withColumn("__id", F.when(F.col("__own").isNull(), F.col(ROW)).otherwise(F.col("__own.__id")))
    null = F.col("__id").isNull()
    order = F.struct(null if keep == "smallest" else ~null, "__id", ROW)
    best = rows.groupBy("group").agg((F.min if keep == "smallest" else F.max)(order).alias("__best"))
    return rows.join(best, "group").filter(F.col("__best")[ROW] != F.col(ROW)).select(ROW).distinct()


def kept_rows(rows: DataFrame, dropped: DataFrame, once: DataFrame | None = None) -> DataFrame:
    """``named`` rows less those whose name is ``dropped``; of rows named in ``once``, one each."""
    out = without(rows, dropped, ROW)
    if once is not None and (n := once.count()):
        flagged = flag_members(out, F.col(ROW), key_bitmap(once, F.col(ROW), n), "__maybe")
        asked = flagged.filter("__maybe")
        single = asked.join(once, ROW, "left_semi").dropDuplicates([ROW]).select(flagged.columns)
        out = flagged.filter("NOT __maybe").unionByName(single).unionByName(asked.join(once, ROW, "left_anti").select(flagged.columns))
        out = out.drop("__maybe")
    return out.drop(ROW)


def repeated(odd: DataFrame | None) -> DataFrame | None:
    """Names that several rows share."""
    return None if odd is None else stored(odd.groupBy(ROW).agg(F.count("*").alias("n")).filter("n > 1").select(ROW), "odd-repeats")

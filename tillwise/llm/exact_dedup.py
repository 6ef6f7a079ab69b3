"""Exact duplicates by a 128-bit hash of the content, confirmed on the bytes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.operators.skew import skew_safe_join

from .common import ROW, flag_members, kept_rows, key_bitmap, losers, lower_az, named, repeated, stored, text_or_empty


def content_hash(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(text))


def mark_exact(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    fold_case: bool = True,
    hash_fn: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are, after lower-casing A-Z if ``fold_case``.  The
    row with the ``smallest`` or ``largest`` id stays.

    Hashes are grouped with partial counts, so copies meet as one row per task.  Only
    texts whose hash occurs twice move, chosen by a bitmap of bounded size, and they are
    grouped by hash and whole text: rows with one hash and other bytes form groups of
    their own.  Every other row passes with its hashes only.  The SHA-256 tells such
    groups apart when the result is put together.

    A NULL text is the empty text; empty texts are equal.  A NULL id never wins against
    another; where all ids of a group are NULL, keep_id is NULL and all rows are kept.
    Rows that repeat an id and its text are marked alike.  Other columns are ignored.
    An empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is {keep!r}")
    best = F.min if keep == "smallest" else F.max
    norm = text_or_empty(text_col)
    norm = lower_az(norm) if fold_case else norm
    read = docs.select(F.col(id_col).alias("__id"), norm.alias("__norm"))
    hashed = stored(
        read.select("__id", hash_fn(F.col("__norm")).alias("__hash"), F.unhex(F.sha2("__norm", 256)).alias("__sha")),
        "exact-hashes",
    )
    shared = stored(hashed.groupBy("__hash").agg(F.count("*").alias("__n")).filter("__n > 1"), "exact-shared")
    bitmap = key_bitmap(shared, F.col("__hash"), shared.count())
    suspects = flag_members(read.withColumn("__hash", hash_fn(F.col("__norm"))), F.col("__hash"), bitmap, "__maybe")
    classes = (
        suspects.filter("__maybe")
        .groupBy("__hash", "__norm")
        .agg(F.count("*").alias("__size"), best("__id").alias("__keep"))
        .filter("__size > 1")
        .select("__hash", F.unhex(F.sha2("__norm", 256)).alias("__sha"), "__size", "__keep")
    )
    out = skew_safe_join(hashed, stored(classes, "exact-classes"), ["__hash", "__sha"], "left")
    keep_id = F.when(F.col("__size").isNull(), F.col("__id")).otherwise(F.col("__keep"))
    return out.select(
        F.col("__id").alias(id_col),
        keep_id.alias("keep_id"),
        F.coalesce("__size", F.lit(1)).cast("long").alias("group_size"),
        F.col("__id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("__sha")).alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the smallest or largest id.

    Rows are dropped, not ids: where rows share an id or have none, each is judged by its
    own text.  A NULL id never wins against another; of rows equal in every column one stays.
    """
    rows, odd = named(docs, id_col)
    marks = mark_exact(rows, ROW, text_col, keep)
    if odd is None:
        dropped = marks.filter(~F.col("kept")).select(ROW)
    else:
        dropped = losers(marks.filter("group_size > 1").select(ROW, F.col("keep_id").alias("group")), odd, keep)
    return kept_rows(rows, stored(dropped, "exact-dropped"), repeated(odd)).select(docs.columns)

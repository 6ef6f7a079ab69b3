"""Batch readers for landed files and tables."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .paths import first_line

RESCUED = "_rescued_data"
CORRUPT = "_corrupt_record"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a Parquet path when the name has a slash."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_csv_raw(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column as text."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = True) -> DataFrame:
    """CSV with a header and a fixed schema.

    A row that does not fit keeps its text in ``_corrupt_record`` instead of failing
    the job.  Columns go by position, so every file must have the schema's order.
    """
    if not keep_corrupt:
        return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(full)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line, fixed schema."""
    return spark.read.schema(schema).option("multiLine", False).json(path)


def csv_headers(spark: SparkSession, path: str | Sequence[str], threads: int = 32) -> dict[str, list[str]]:
    """Files below ``path`` by their first line that is not blank; a file without one is left out.

    Each file is opened once, compressed ones too, and read to that line, so it costs a
    block and not its length.  A Spark task would read its whole split.  The names are
    those that Spark's own listing of the folder holds on the driver.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    files = [r["path"] for r in listed.collect()]
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(threads) as pool:
        for file, header in zip(files, pool.map(lambda f: first_line(spark, f), files)):
            if header is not None:
                groups.setdefault(header, []).append(file)
    return groups


def header_names(header: str) -> tuple[str, ...]:
    return tuple(n.strip() for n in next(csv.reader([header])))


def read_csv_by_name(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """CSV files with differing headers, matched by column name, all text.

    Each group of files with one header is read with that header; a column a group
    lacks is NULL for it.  Headers come from the first lines, so the rows are read once,
    when the result is used.  ``_source_file`` holds each row's file and ``_corrupt_record``
    the whole line where it has more or fewer fields than the header.  ``columns`` fixes
    the result's columns and their order, those two after them.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for header, found in csv_headers(spark, path).items():
        groups.setdefault(header_names(header), []).extend(found)
    out: DataFrame | None = None
    for names, found in sorted(groups.items()):
        files = found if len(groups) > 1 else path
        part = csv_text(spark.read, names).option("recursiveFileLookup", True).csv(files)
        part = part.withColumn("_source_file", F.col("_metadata.file_path"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no CSV files below {path}")
    if columns:
        cols = [F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in columns]
        out = out.select(*cols, CORRUPT, "_source_file")
    return out


def csv_text(reader, names: Sequence[str]):
    """A batch or stream reader of CSV with this header as text; ragged lines are kept whole."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    return (
        reader.schema(schema).option("header", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    )


#: types tried for a text column, narrowest first, with the shape their text must have
#: (a cast alone would take a time stamp for a date and "y" for a boolean)
INFERRED_TYPES = {
    "int": r"^[+-]?[0-9]+$",
    "bigint": r"^[+-]?[0-9]+$",
    "double": r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$",
    "boolean": r"^(?i:true|false)$",
    "date": r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T][0-9].*$",
}


def narrowest_types(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    """Narrowest type that every non-blank value of a text column converts to; None without a value.

    One aggregation over all columns and candidate types.
    """
    tests = []
    for c in cols:
        text = F.nullif(F.trim(F.col(c)), F.lit(""))
        tests.append(F.count(text).alias(f"{c}|n"))
        for t, shape in INFERRED_TYPES.items():
            misfit = ~text.rlike(shape) | text.try_cast(t).isNull()
            tests.append(F.count_if(text.isNotNull() & misfit).alias(f"{c}|{t}"))
    row = df.agg(*tests).first()
    out: dict[str, str | None] = {}
    for c in cols:
        fits = [t for t in INFERRED_TYPES if row[f"{c}|{t}"] == 0]
        out[c] = None if row[f"{c}|n"] == 0 else fits[0] if fits else "string"
    return out


def infer_types(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, str]:
    """The narrowest types of text columns; a column without a value is text."""
    return {c: t or "string" for c, t in narrowest_types(df, list(cols or df.columns)).items()}


def fitting(text: Column, dtype: str) -> Column:
    """The value of a text in a type, NULL unless it has the shape that types are inferred by.

    A date fits a time stamp; a time stamp does not fit a date, which would lose the time.
    """
    shapes = [INFERRED_TYPES[t] for t in (dtype, *(["date"] if dtype == "timestamp" else [])) if t in INFERRED_TYPES]
    if not shapes:
        return text.try_cast(dtype)
    return F.when(F.trim(text).rlike("|".join(shapes)), F.trim(text).try_cast(dtype))


def rescue(df: DataFrame, schema: T.StructType, rescued_col: str = RESCUED, inferred: bool = False) -> DataFrame:
    """Cast text columns to a target schema; keep what does not fit.

    Types that were ``inferred`` take only texts they would be inferred from
    (:func:`fitting`); those the caller chose take all that Spark casts.

    A value that fails its cast, a column the schema does not know and the line of a
    ragged row go, as text, into one JSON object in ``rescued_col``; it is NULL when
    nothing was left over.
    """
    known = {f.name: f.dataType for f in schema.fields}
    typed, lost = [], []
    for name, dtype in known.items():
        if name not in df.columns:
            typed.append(F.lit(None).cast(dtype).alias(name))
            continue
        cast = fitting(F.col(name), dtype.simpleString()) if inferred else F.col(name).try_cast(dtype)
        typed.append(cast.alias(name))
        if not isinstance(dtype, T.StringType):
            present = F.length(F.trim(F.col(name))) > 0
            lost.append(F.when(present & cast.isNull(), F.col(name)).alias(name))
    for name in df.columns:
        if name not in known and (name == CORRUPT or not name.startswith("_")):
            lost.append(F.col(name).cast("string").alias(name))
    passed = [F.col(c) for c in df.columns if c not in known and c.startswith("_") and c != CORRUPT]
    if not lost:
        return df.select(*typed, *passed, F.lit(None).cast("string").alias(rescued_col))
    # to_json leaves NULL fields out, so an object without fields means nothing was lost
    left = F.nullif(F.to_json(F.struct(*lost)), F.lit("{}"))
    return df.select(*typed, *passed, left.alias(rescued_col))


def read_files_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV files by name with inferred types; ragged lines in ``_rescued_data``."""
    raw = read_csv_by_name(spark, path).drop("_source_file")
    types = infer_types(raw, [c for c in raw.columns if c != CORRUPT])
    schema = T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in types.items()))
    return rescue(raw, schema)


def with_audit(df: DataFrame, source: str | None = None) -> DataFrame:
    """Add load time and origin; without ``source`` the file each row came from."""
    origin = F.lit(source) if source is not None else F.col("_metadata.file_path")
    return df.withColumns({"_ingested_at": F.current_timestamp(), "_source_file": origin})


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet whose files were written with differing columns."""
    return spark.read.option("mergeSchema", True).parquet(path)

"""Writing, replacing, describing and dropping tables; file export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path
from ..sources.paths import remove


def overwrite(df: DataFrame, target: str, partition_by: Sequence[str] = (), **options: str) -> None:
    """Replace a table (or a Parquet path, when the name has a slash), schema included."""
    writer = df.write.mode("overwrite").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)


def replace_table(spark: SparkSession, name: str, df: DataFrame) -> None:
    """Create or replace a table from a query that may read the same table.

    The rows are written to a staging table first; until that is complete readers see
    the old rows.  Then the old table steps aside and the staging table takes the name;
    if that fails, the old table gets its name back.  Between the two renames there is
    no table of that name.
    """
    staging, aside = f"{name}__staging", f"{name}__old"
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    df.write.format("parquet").saveAsTable(staging)
    if not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
        return
    spark.sql(f"DROP TABLE IF EXISTS {aside}")
    spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE {aside}")


def append_merged(df: DataFrame, path: str) -> None:
    """Append rows whose columns may differ from the earlier ones; read them back with
    :func:`tillwise.sources.files.read_merged`."""
    df.write.mode("append").parquet(path)


def refresh(df: DataFrame, path: str, strategy: str = "full", partition_by: Sequence[str] = (), **options: str) -> None:
    """Refresh a stored view.

    ``full`` rewrites everything.  ``partition_overwrite`` replaces only the partitions
    that occur in ``df``, which must then hold those partitions completely.
    """
    if strategy == "full":
        overwrite(df, path, partition_by, **options)
        return
    if strategy != "partition_overwrite" or not partition_by:
        raise ValueError("partition_overwrite needs partition columns")
    (
        df.write.mode("overwrite")
        .options(**options)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def reset_layer(spark: SparkSession, database: str, prefix: str) -> list[str]:
    """Drop the tables of a database whose names start with ``prefix``."""
    if not prefix:
        raise ValueError("a layer prefix is needed")
    found = [
        r["tableName"]
        for r in spark.sql(f"SHOW TABLES IN {database}").collect()
        if r["tableName"].startswith(prefix) and not r["isTemporary"]
    ]
    for t in found:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{t}")
    return found


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def describe(spark: SparkSession, name: str, table_comment: str | None, columns: Mapping[str, str]) -> None:
    """Set the table comment and the comments of the named columns."""
    if table_comment is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(table_comment)}")
    for col, text in columns.items():
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{col}` COMMENT {_quoted(text)}")


def export(df: DataFrame, path: str, fmt: str, rows_per_file: int) -> None:
    """Write CSV (with header) or JSON lines in files of at most ``rows_per_file`` rows."""
    if fmt not in ("csv", "json"):
        raise ValueError(f"unknown format {fmt}")
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.option("ignoreNullFields", False).json(path)


def export_exact(df: DataFrame, path: str, fmt: str, rows_per_file: int, most_tasks: int = 10_000) -> int:
    """Write CSV or JSON lines in files of exactly ``rows_per_file`` rows, the last one excepted; returns their number.

    The rows are stored once.  A row's number is its place in its stored file plus the
    rows of the files before it, so no task sees more than its share; one row per stored
    file is summed up in order.  Rows are dealt by number, whole output files to a task.
    An empty table gives no file of rows.
    """
    spark = df.sparkSession
    kept = scratch_path(spark, "export")
    df.write.parquet(kept)
    rows = spark.read.schema(df.schema).parquet(kept)
    rows = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    sizes = rows.groupBy("__file").agg(F.count("*").alias("n"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    files = -(-sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // rows_per_file)
    tasks = max(1, min(files, most_tasks))
    per_task = rows_per_file * max(1, -(-files // tasks))
    numbered = rows.join(starts, "__file").withColumn("__no", F.col("__start") + F.col("__at"))
    dealt = numbered.repartitionById(tasks, F.floor(F.col("__no") / per_task).cast("int"))
    export(dealt.sortWithinPartitions("__no").select(*df.columns), path, fmt, rows_per_file)
    remove(spark, kept)
    return files


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Give an intermediate result a session-wide name for SQL."""
    df.createOrReplaceTempView(name)
    return df

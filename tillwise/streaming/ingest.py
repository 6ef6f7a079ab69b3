"""Incremental file ingest with Structured Streaming.

Every run takes what is new and stops (``availableNow``).  The checkpoint remembers
the files already read, so a second run over the same folder adds nothing.
"""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from ..sources.files import CORRUPT, RESCUED, csv_headers, csv_text, header_names, infer_types, read_csv_by_name, rescue
from ..sources.paths import load_schema, save_schema
from .widening import note_misfits

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def stream_csv_fixed(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Stream of CSV files with a header and a fixed schema, in the schema's order.

    A file whose header has another order fails the stream; :func:`stream_csv_named`
    takes files in any order.  Misfits and ragged lines are in ``_rescued_data``.
    """
    reader = csv_text(spark.readStream, schema.fieldNames()).option("enforceSchema", False)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return rescue(reader.csv(path), schema)


def stream_csv_named(
    spark: SparkSession, path: str, schema: T.StructType, target: str, checkpoint: str, flow: str = "main",
    rescued_col: str = RESCUED,
) -> DataFrame:
    """Stream of CSV files matched to a fixed schema by header name.

    New files are first loaded into ``target``, once each; the stream reads that.
    Columns the schema does not know, misfits and ragged lines are in ``rescued_col``.
    """
    ingest_files(spark, path, target, checkpoint, flow, schema, rescued_col=rescued_col)
    full = T.StructType([*schema.fields, T.StructField(rescued_col, T.StringType())])
    return stream_table(spark, f"{target}/flow={flow}", full).drop("batch")


def stream_csv(spark: SparkSession, path: str, schema_dir: str, max_files: int | None = None) -> DataFrame:
    """Stream of CSV files of one layout, types inferred once and kept in ``schema_dir``.

    Folders whose files differ in layout go through :func:`ingest_files`.
    """
    schema = load_schema(spark, schema_dir)
    if schema is None:
        if len({header_names(h) for h in csv_headers(spark, path)}) != 1:
            raise ValueError(f"{path} holds files of more than one layout")
        raw = read_csv_by_name(spark, path).drop("_source_file", CORRUPT)
        schema = _ddl_schema(infer_types(raw))
        save_schema(spark, schema, schema_dir)
    return stream_csv_fixed(spark, path, schema, max_files)


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, max_files: int | None = None
) -> DataFrame:
    """Stream of the rows appended to a Parquet directory."""
    schema = schema or spark.read.option("mergeSchema", True).parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def append_flow(df: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet directory, exactly once, and wait until it has
    caught up."""
    return run_to_end(
        df.sparkSession,
        df.writeStream.format("parquet").outputMode("append").option("path", target).option("checkpointLocation", checkpoint),
    )


def run_batches(df: DataFrame, checkpoint: str, fn: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Hand every micro-batch to ``fn`` and wait until the stream has caught up."""
    return run_to_end(df.sparkSession, df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint))


class ProgressLog(StreamingQueryListener):
    """Progress of every batch of the queries that run while it listens, by run."""

    def __init__(self) -> None:
        self.batches: dict[str, list] = defaultdict(list)
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.batches[str(event.progress.runId)].append(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()


def run_to_end(spark: SparkSession, writer: DataStreamWriter, patience: float = 120) -> StreamingQuery:
    """Start a query on all there is now, wait for its end and keep the progress of all its batches in ``progress``.

    Spark itself remembers the last ones only (100 by default); a listener gets each.
    Events come in order, so the end of the query is the last one; it is awaited for at
    most ``patience`` seconds after the query itself has ended.
    """
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        run = str(query.runId)
        if not log.ended[run].wait(patience):
            raise TimeoutError("the rows are written, but Spark did not report the end of the query")
    finally:
        spark.streams.removeListener(log)
    query.progress = log.batches[run]
    return query


def _ddl_schema(types: dict[str, str]) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in types.items()))


def widen(
    spark: SparkSession, raw: DataFrame, src: str, schema_dir: str, infer: bool, add_columns: bool
) -> T.StructType:
    """The stored schema, extended by the columns it does not know yet.

    Types come from all files that lie in ``src`` when a column first shows, so they do
    not depend on how the files fall into batches.  A known column is stored in its first
    type: later values that do not fit are rescued, and taken back in by
    :func:`tillwise.streaming.widening.read_widened`.
    """
    stored = load_schema(spark, schema_dir)
    known = [] if stored is None else stored.fieldNames()
    new = [c for c in raw.columns if c not in known and not c.startswith("_")]
    if stored is not None and (not new or not add_columns):
        return stored
    whole = read_csv_by_name(spark, src)
    new = sorted({c for c in whole.columns if c not in known and not c.startswith("_")}, key=whole.columns.index)
    types = infer_types(whole, new) if infer else {c: "string" for c in new}
    schema = T.StructType([*(stored.fields if stored else []), *_ddl_schema(types).fields])
    save_schema(spark, schema, schema_dir)
    return schema


def ingest_files(
    spark: SparkSession,
    src: str,
    target: str,
    checkpoint: str,
    flow: str = "main",
    schema: T.StructType | None = None,
    infer: bool = True,
    add_columns: bool = True,
    rescued_col: str = RESCUED,
    audit: bool = False,
    max_files: int = 10_000,
) -> int:
    """Load the CSV files of ``src`` that were not loaded before; returns the rows added.

    The stream tracks only which files are new.  Each micro-batch reads its files by
    header name, casts them to the stored schema and writes ``target/flow=…/batch=…``;
    a repeated batch replaces its own directory.  Several flows may share a target.
    ``max_files`` sets how many file names a micro-batch handles; all files are taken in
    as many batches as it needs, with the same rows and types.  With ``add_columns`` a new
    header column widens the schema, otherwise its values are rescued; with a ``schema``
    they always are.  Misfits and ragged lines are rescued too, so nothing is lost.
    ``infer=False`` keeps every column as text.  Where types are inferred, the types of
    rescued values are noted, and ``read_widened`` reads the table in types that take them.
    """
    new_files = (
        spark.readStream.schema(FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .format("binaryFile")
        .load(src)
        .select("path")
    )
    added: list[int] = []

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        files = [r["path"] for r in batch.collect()]  # file names only
        if not files:
            return
        raw = read_csv_by_name(session, files)
        to = schema or widen(session, raw, src, f"{checkpoint}/schema", infer, add_columns)
        rows = rescue(raw, to, RESCUED, inferred=schema is None and infer)
        rows = rows.withColumnRenamed(RESCUED, rescued_col)
        if audit:
            rows = rows.withColumn("_ingested_at", F.current_timestamp())
        else:
            rows = rows.drop("_source_file")
        seen = Observation()
        written = f"{target}/flow={flow}/batch={batch_id}"
        rows.observe(seen, F.count("*").alias("n"), F.count(rescued_col).alias("lost")).write.mode("overwrite").parquet(written)
        if seen.get["lost"] and schema is None and infer:
            note_misfits(session.read.parquet(written), to, checkpoint, batch_id, rescued_col)
        added.append(seen.get["n"])

    run_batches(new_files, f"{checkpoint}/files", load)
    return sum(added)


def ingest_new_files(
    spark: SparkSession, src: str, target: str, checkpoint: str, schema: T.StructType | None = None
) -> int:
    """Once-only load of raw CSV: text columns unless a schema is given, with load time
    and source file; new columns are merged in, what does not fit is rescued."""
    return ingest_files(spark, src, target, checkpoint, schema=schema, infer=False, audit=True)

"""Column types that widen as later files bring values the first ones did not have.

The files of an ingested table keep the types of its first files; a value that does not
fit is rescued as text.  Beside them the ingest notes the narrowest type of the rescued
values of a batch.  A column's type is the join of all these notes, and joining is
associative, commutative and idempotent, so neither the order of the batches nor a repeated one matters.
Reading casts the stored values to that type and takes the rescued ones back in, so no
old file is ever rewritten.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import RESCUED, fitting, narrowest_types
from ..sources.paths import exists, load_schema, save_text

#: types that widen into the next one; any other two types meet in text
LADDERS = (("int", "bigint", "double"), ("date", "timestamp"))


def join_types(a: str, b: str) -> str:
    """The narrowest type that takes the values of both."""
    for ladder in LADDERS:
        if a in ladder and b in ladder:
            return max(a, b, key=ladder.index)
    return a if a == b else "string"


def note_misfits(rows: DataFrame, schema: T.StructType, checkpoint: str, batch_id: int, rescued_col: str = RESCUED) -> None:
    """Note the types of the values of known columns that this batch had to rescue.

    Nothing is written where the notes so far cover them.
    """
    spark = rows.sparkSession
    typed = [f.name for f in schema if not isinstance(f.dataType, T.StringType)]
    if not typed:
        return
    lost = rows.filter(F.col(rescued_col).isNotNull()).select(_fields(rescued_col).alias("m"))
    found = narrowest_types(lost.select(*[F.col("m")[c].alias(c) for c in typed]), typed)
    before = column_types(spark, schema, checkpoint)
    new = {c: t for c, t in found.items() if t is not None and join_types(before[c], t) != before[c]}
    if new:
        save_text(spark, json.dumps(new), f"{checkpoint}/types/batch={batch_id}")


def column_types(spark: SparkSession, schema: T.StructType, checkpoint: str) -> dict[str, str]:
    """Type of every column: the stored one joined with all notes.

    A note is written only where it widens a column, so there are at most a few per column.
    """
    types = {f.name: f.dataType.simpleString() for f in schema}
    if exists(spark, f"{checkpoint}/types"):
        for note in spark.read.text(f"{checkpoint}/types").select("value").collect():
            for name, found in json.loads(note["value"]).items():
                types[name] = join_types(types[name], found)
    return types


def read_widened(spark: SparkSession, target: str, checkpoint: str, flow: str = "main", rescued_col: str = RESCUED) -> DataFrame:
    """The rows of one flow of :func:`tillwise.streaming.ingest.ingest_files`, in the types of all its batches.

    A rescued value that fits the wider type is back in its column and gone from
    ``rescued_col``.  A whole number beyond 2^53 is rounded where its column became a
    double.  Where a column became text, values stored before in a narrower type are shown
    as that type prints them.  Columns that were text from the start stay text.
    """
    schema = load_schema(spark, f"{checkpoint}/schema")
    if schema is None:
        raise ValueError(f"{checkpoint} holds no schema yet")
    full = T.StructType([*schema.fields, T.StructField(rescued_col, T.StringType())])
    rows = spark.read.schema(full).parquet(f"{target}/flow={flow}").drop("batch")
    stored = {f.name: f.dataType.simpleString() for f in schema}
    wider = {c: t for c, t in column_types(spark, schema, checkpoint).items() if t != stored[c]}
    return replay(rows, wider, rescued_col)


def replay(rows: DataFrame, wider: Mapping[str, str], rescued_col: str = RESCUED) -> DataFrame:
    """Cast columns to wider types and take back the rescued values that fit them."""
    if not wider:
        return rows
    fields = _fields(rescued_col)
    out = {c: F.coalesce(F.col(f"`{c}`").cast(t), fitting(fields[c], t)) for c, t in wider.items()}

    def unfit(name, value):
        return ~reduce(or_, [(name == c) & fitting(value, t).isNotNull() for c, t in wider.items()])

    out[rescued_col] = F.nullif(F.to_json(F.map_filter(fields, unfit)), F.lit("{}"))
    return rows.withColumns(out)


def _fields(rescued_col: str):
    return F.from_json(F.col(rescued_col), "map<string,string>")

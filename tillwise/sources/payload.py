"""Tabular JSON payloads: column names in one place, rows of text in another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAYLOAD_SCHEMA = """statement_response struct<
  manifest: struct<schema: struct<columns: array<struct<name: string>>>>,
  result: struct<data_array: array<array<string>>>>"""


def payload_to_rows(df: DataFrame, json_col: str, strict: bool = True) -> DataFrame:
    """(payload columns…, row, values): one row per entry of ``data_array`` with a
    map from column name to text.

    With ``strict`` a payload without columns or rows raises, otherwise it gives none.
    """
    body = F.from_json(F.col(json_col), PAYLOAD_SCHEMA)["statement_response"]
    names = body["manifest"]["schema"]["columns"]["name"]
    rows = body["result"]["data_array"]
    keep = [c for c in df.columns if c != json_col]
    parsed = df.select(*keep, names.alias("__names"), rows.alias("__rows"))
    empty = (F.coalesce(F.size("__names"), F.lit(0)) < 1) | (F.coalesce(F.size("__rows"), F.lit(0)) < 1)
    missing = F.raise_error(F.lit("payload has no columns or no rows")) if strict else F.lit(None)
    parsed = parsed.withColumn("__rows", F.when(empty, missing).otherwise(F.col("__rows")))
    return parsed.select(*keep, "__names", F.posexplode("__rows").alias("row", "__row")).select(
        *keep, "row", F.map_from_arrays("__names", "__row").alias("values")
    )


def payload_frame(df: DataFrame, json_col: str, columns: list[str]) -> DataFrame:
    """The payload as a table of the named text columns, in payload order of rows."""
    rows = payload_to_rows(df, json_col)
    return rows.select(*[F.try_element_at("values", F.lit(c)).alias(c) for c in columns])

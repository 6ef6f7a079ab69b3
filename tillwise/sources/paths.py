"""Small helpers on the session's file system."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, in order; none where it does not exist."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not exists(spark, path):
        return []
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return sorted(f.getPath().getName() for f in found if f.isDirectory())


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, compressed or not, that holds more than blanks; no byte order mark."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(conf).open(p)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
    if codec is not None:
        stream = codec.createInputStream(stream)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        while (line := reader.readLine()) is not None:
            line = line.lstrip("\ufeff")
            if line.strip(" "):
                return line
        return None
    finally:
        reader.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and what it holds."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def replace_folders(spark: SparkSession, source: str, target: str, depth: int) -> None:
    """Move each folder ``depth`` levels below ``source`` to its place below ``target``, where it replaces what is there."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    fs = make(target).getFileSystem(spark._jsc.hadoopConfiguration())
    found = [""]
    for _level in range(depth):
        found = [f"{f}/{n}" for f in found for n in children(spark, f"{source}{f}") if not n.startswith(("_", "."))]
    for folder in found:
        place = make(f"{target}{folder}")
        fs.mkdirs(place.getParent())
        fs.delete(place, True)
        if not fs.rename(make(f"{source}{folder}"), place):
            raise OSError(f"{source}{folder} could not be moved to {target}{folder}")
    spark.catalog.refreshByPath(target)


def save_text(spark: SparkSession, line: str, path: str) -> None:
    """Keep one line of text."""
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_text(spark: SparkSession, path: str) -> str | None:
    return spark.read.text(path).first()["value"] if exists(spark, path) else None


def save_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """Keep a schema as one line of JSON."""
    save_text(spark, schema.json(), path)


def load_schema(spark: SparkSession, path: str) -> T.StructType | None:
    line = load_text(spark, path)
    return None if line is None else T.StructType.fromJson(json.loads(line))

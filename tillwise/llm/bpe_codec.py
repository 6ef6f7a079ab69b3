"""Byte-pair encoding with a queue of merge ranks, and decoding by vocabulary strings."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import text_or_empty


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ids (array<long>), the tokens of the whole text.

    Special strings inside a text become their special id.  A NULL or empty text has no
    ids.  A NULL id stays, repeated rows are encoded each, other columns are ignored, an
    empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = bpe.id_encoder(vocabulary)
        for batch in batches:
            # a few texts at a time, so long ones don't fill memory with their ids
            for part in _slices(batch):
                ids = [np.frombuffer(of(t), "<u4").astype("int64") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(ids)], names=["id", "ids"])

    read = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    out = read.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, ids array<long>")
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row: id, text, the vocabulary strings of the ids put together.

    Bytes that are no UTF-8 become U+FFFD.  NULL or no ids give the empty text; an id
    outside the vocabulary is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = bpe.load(vocabulary).pieces
        for batch in batches:
            texts = [_text(pieces, ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    read = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<long>").alias("ids"))
    out = read.mapInArrow(run, f"id {encoded.schema[id_col].dataType.simpleString()}, text string")
    return out.withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each whole text and decode its ids: id, n_tokens, ids_sha256, decoded_sha256.

    The digests are of the ids as little-endian unsigned 32-bit integers and of the
    decoded text in UTF-8.  Encoding, decoding and hashing happen in one pass, text by
    text, without a shuffle.  NULLs, empty texts and repeated rows as in ``encode``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, pieces = bpe.id_encoder(vocabulary), bpe.load(vocabulary).pieces
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(1).to_pylist():
                ids = of(text)
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                decoded = _text(pieces, np.frombuffer(ids, "<u4").tolist())
                text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    read = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = read.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)


def _text(pieces: dict[int, bytes], ids) -> str:
    return b"".join(map(pieces.__getitem__, ids)).decode("utf-8", "replace")


def _slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate(arrays) if arrays else np.empty(0, "int64")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))

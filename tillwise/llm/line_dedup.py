"""Lines repeated across documents, found with two Bloom filters and confirmed exactly."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.operators.skew import skew_safe_join

from .common import flag_members, key_bitmap, stored, text_or_empty

BLANKS = b" \t\n\x0b\x0c\r"

#: Stands for a NULL id, after every other.
LAST = (1 << 63) - 1

#: A filter moves in chunks of so many bits (256 KB).
CHUNK = 1 << 21


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The stripped line with A-Z lower-cased; None when it is too short to count."""
    key = line.strip(BLANKS).lower()
    long_enough = len(key) >= 4 * min_chars or len(key) >= min_chars and len(key.decode()) >= min_chars
    return key if long_enough else None


def line_keys(text: str, min_chars: int) -> set[bytes]:
    keys = {line_key(line, min_chars) for line in set(text.encode().split(b"\n"))}
    keys.discard(None)
    return keys


class BloomPair:
    """Hashes seen in one document at least, and in two at least; two probes each."""

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - bits.bit_length() + 1)
        self.mask = np.uint64(bits - 1)
        self.once, self.twice = np.zeros(bits // 8, "uint8"), np.zeros(bits // 8, "uint8")

    def probes(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (hashes & self.mask).astype("int64"), (hashes >> self.shift).astype("int64")

    @staticmethod
    def get(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
        return bits[at >> 3] >> (at & 7).astype("uint8") & 1

    @staticmethod
    def put(bits: np.ndarray, at: np.ndarray) -> None:
        np.bitwise_or.at(bits, at >> 3, np.left_shift(1, at & 7).astype("uint8"))

    def add(self, hashes: np.ndarray) -> None:
        """Hashes of several documents, each at most once per document."""
        kinds, counts = np.unique(hashes, return_counts=True)
        a, b = self.probes(kinds)
        seen = (counts > 1) | (self.get(self.once, a) & self.get(self.once, b)).astype(bool)
        for at in (a, b):
            self.put(self.twice, at[seen])
            self.put(self.once, at)


def _hashes(keys) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), "uint64")


def twice_seen(docs: DataFrame, text: str, bits: int, min_chars: int) -> np.ndarray:
    """The filter of line hashes that two documents may share, over the whole table.

    Every task makes its own pair of filters.  Two pairs are merged by OR, and what both
    have seen once joins the twice-seen side; no true repeat is lost, whatever the order.
    The pairs are cut into chunks, so merging is spread over tasks and each holds a few
    chunks only.  The result has ``bits`` bits.
    """
    size = min(bits, CHUNK) // 8

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = BloomPair(bits)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                texts = batch.column(0).slice(at, 512).to_pylist()
                pair.add(_hashes(k for t in texts for k in line_keys(t, min_chars)))
        for n in range(0, bits // 8, size):
            once, twice = pair.once[n : n + size], pair.twice[n : n + size]
            if once.any():
                blob = zlib.compress(once.tobytes() + twice.tobytes(), 1)
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([n // size], pa.int32()), "pair": pa.array([blob], pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[int, np.ndarray] = {}
        for batch in batches:
            for n, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                once, twice = np.frombuffer(zlib.decompress(blob.as_py()), "uint8").reshape(2, -1)
                if n not in chunks:
                    chunks[n] = np.zeros((2, size), "uint8")
                chunks[n][1] |= twice | (chunks[n][0] & once)
                chunks[n][0] |= once
        for n, (_, twice) in chunks.items():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([n], pa.int32()), "pair": pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())})

    parts = docs.select(text).mapInArrow(build, "chunk int, pair binary").repartition("chunk")
    found = np.zeros(bits // 8, "uint8")
    for row in parts.mapInArrow(merge, "chunk int, pair binary").collect():  # bits / 8 bytes in all
        found[row.chunk * size : (row.chunk + 1) * size] = np.frombuffer(zlib.decompress(row.pair), "uint8")
    return found


def drop_repeated_lines(
    docs: DataFrame, min_chars: int = 10, filter_bits: int = 1 << 27, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, n_lines, n_dropped, text (the lines that stay).

    Lines end at newlines.  A line whose key (blanks stripped, A-Z lower-cased) has
    ``min_chars`` code points and occurs in two documents stays only in the one with the
    smallest id, there as often as it stands.

    A first pass makes the Bloom filters; a second tests every line and lets only
    suspected repeats, one row per key and document, go into the shuffle that confirms
    them by the whole key.  ``filter_bits`` (16 MB by default) bounds what is broadcast.
    A fuller filter suspects more lines; the result is the same.  Partial minima keep a
    line that all documents share from meeting in one task, and the join back is split
    where it is skewed.  Documents without a dropped line are not shuffled.

    A NULL or empty text is one empty line.  Rows with one id are one document; a NULL
    id counts as the largest, and all such rows as one document.  Other columns are
    ignored, an empty table gives an empty result.
    """
    spark = docs.sparkSession
    read = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"), text_or_empty(text_col).alias("text"))
    seen = spark.sparkContext.broadcast(twice_seen(read, "text", filter_bits, min_chars))

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = BloomPair(8)
        probe.shift, probe.mask = np.uint64(64 - filter_bits.bit_length() + 1), np.uint64(filter_bits - 1)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [sorted(line_keys(t, min_chars)) for t in part.column(1).to_pylist()]
                keys = [k for ks in found for k in ks]
                ids = np.repeat(np.array(part.column(0), "int64"), np.array([len(ks) for ks in found], "int64"))
                a, b = probe.probes(_hashes(keys))
                hit = (probe.get(seen.value, a) & probe.get(seen.value, b)).astype(bool)
                yield pa.RecordBatch.from_pydict(
                    {"id": pa.array(ids[hit]), "key": pa.array([keys[i] for i in np.flatnonzero(hit)], pa.binary())}
                )

    suspects = stored(read.mapInArrow(suspect, "id long, key binary"), "line-suspects")
    span = suspects.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    later = skew_safe_join(suspects, span.select("key", "first"), ["key"], "inner").filter("id > first")
    drops = stored(later.groupBy("id").agg(F.collect_set("key").alias("keys")), "line-drops")
    flagged = flag_members(read, F.col("id"), key_bitmap(drops, F.col("id"), drops.count()), "__maybe")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, dropped, kept = [], [], []
            for text, keys in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                gone, lines = set(keys), text.encode().split(b"\n")
                stay = [x for x in lines if line_key(x, min_chars) not in gone]
                n.append(len(lines))
                dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay).decode())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_lines", "n_dropped", "text"])

    schema = "id long, n_lines long, n_dropped long, text string"
    none = F.array().cast("array<binary>").alias("keys")
    hit = flagged.filter("__maybe").join(drops, "id", "left")
    touched = hit.select("id", "text", F.coalesce("keys", none).alias("keys")).mapInArrow(cut, schema)
    whole = flagged.filter("not __maybe").select(
        "id",
        (F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_dropped"),
        "text",
    )
    out = whole.unionByName(touched)
    return out.withColumn("id", F.when(F.col("id") != LAST, F.col("id"))).withColumnRenamed("id", id_col)

"""Alignment of two tokenizers: groups between shared cuts, links by overlap, counts over the corpus."""

from __future__ import annotations

import functools
import hashlib
import os
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import bpe, piece_codec
from .common import stored, text_or_empty

COUNTS = "n_a long, n_b long, n_groups long, n_links long"


def groups(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Last A token and last B token of every group, in order.

    ``a`` and ``b`` are the byte offsets at which the tokens end, rising, the last one
    shared.  An interval is cut at the common end next to its middle A token, found by
    bisecting the B ends, and both halves go on; an interval without a common end inside
    is a group.  The search goes outward from the middle, so a stretch without cuts is
    looked at three times at most: when each of its ends is found, and when none is left.
    """
    last_a, last_b, todo = [], [], []
    if not a:
        return last_a, last_b
    i, j, p, q = 0, len(a) - 1, 0, len(b) - 1  # tokens i to j and p to q
    while True:
        if i < j and p < q:
            m = (i + j) >> 1
            at = bisect_left(b, a[m], p, q)
            if b[at] != a[m]:
                m, at = near_cut(a, b, i, j, p, q, m, at)
            if m >= 0:
                if m == i or at == p:  # the left half is a group
                    last_a.append(m)
                    last_b.append(at)
                    i, p = m + 1, at + 1
                else:
                    todo.append((j, q))  # the right half begins where the left one will have ended
                    j, q = m, at
                continue
        last_a.append(j)
        last_b.append(q)
        if not todo:
            return last_a, last_b
        i, p = j + 1, q + 1
        j, q = todo.pop()


def near_cut(a: list[int], b: list[int], i: int, j: int, p: int, q: int, m: int, at: int) -> tuple[int, int]:
    """The common end nearest to token ``m`` of i to j - 1, as a token of A and of B; -1 where there is none.

    ``at`` is the first B token from p to q that ends at or after the end of ``m``.
    """
    low, high, lower, upper = m - 1, m + 1, at, at
    while low >= i or high < j:
        if high < j:
            upper = bisect_left(b, a[high], upper, q)
            if b[upper] == a[high]:
                return high, upper
            high += 1
        if low >= i:
            lower = bisect_left(b, a[low], p, lower)
            if b[lower] == a[low]:
                return low, lower
            low -= 1
    return -1, -1


def links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A token and B token of every pair whose byte ranges overlap."""
    starts = np.concatenate([[0], a[:-1]])
    first = np.searchsorted(b, starts, "right")
    many = np.searchsorted(b, a, "left") - first + 1
    left = np.repeat(np.arange(len(a)), many)
    return left, np.arange(len(left)) + np.repeat(first - np.cumsum(many) + many, many)


class Aligner:
    """Texts to the codes of both tokenizers' tokens, with those of frequent chunks kept.

    Both begin a token at a single space between two characters that are no white space,
    so a text has a common end before it.  It is cut there first, and the libraries and
    :func:`groups` see each chunk once.  A code is twice the id, plus one where the token
    is the last of its side in a group.
    """

    def __init__(self, vocabulary_a: str, vocabulary_b: str, remembered: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(vocabulary_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.a.model._resize_cache(0)  # chunks are kept here
        self.b = sentencepiece.SentencePieceProcessor(model_file=vocabulary_b)
        pieces = bpe.load(vocabulary_a).pieces
        if bpe.load(vocabulary_a).lower or not piece_codec.load(vocabulary_b).words:
            raise ValueError(f"{vocabulary_a} or {vocabulary_b} is of another kind")
        texts = [pieces.get(i, b"") for i in range(max(pieces) + 1)], piece_codec.load(vocabulary_b).text
        self.size_a, self.size_b = (np.array([len(t) for t in side], "int64") for side in texts)
        # every token with what follows it in a group: "," and "|" for A, "," and ";" for B
        follow = (b",", b"|"), (b",", b";")
        shown = np.array([b"%d%s" % (i, c) for side, marks in zip(texts, follow) for i in range(len(side)) for c in marks])
        self.shown = shown.view("u1").reshape(len(shown), -1)
        self.lone = bpe.Recent(lambda chunk: self.encode([" " + chunk])[0], limit=remembered)
        self.known = bpe.Recent(lambda chunk: self.encode([chunk])[0], limit=remembered // 8)

    def encode(self, chunks: list[str]) -> list[tuple[bytes, bytes]]:
        """Codes of chunks that each begin with a space, which the library of B adds itself.

        Where the sides of a chunk have different lengths, all tokens of A and none of B are
        marked, so a text has as many marks of A as of B only if no such chunk is in it.
        """
        left = [e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        right = self.b.encode([c[1:] for c in chunks], num_threads=1)
        flat, upto, spans = [], [], []
        for ids, size in ((left, self.size_a), (right, self.size_b)):
            upto.append(np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype="int64")]))
            flat.append(np.fromiter(chain.from_iterable(ids), "int64", int(upto[-1][-1])))
            spans.append(np.diff(np.concatenate([[0], np.cumsum(size[flat[-1]])])[upto[-1]]))
        even = spans[0] == spans[1]
        # chunks one after another are cut like one text, as each ends where both sides end
        kept = [np.repeat(even, np.diff(u)) for u in upto]
        ends = [np.cumsum(size[x[k]]).tolist() for size, x, k in zip((self.size_a, self.size_b), flat, kept)]
        packed = []
        for side, (x, k, last) in enumerate(zip(flat, kept, groups(*ends))):
            inside = np.zeros(int(k.sum()), "int64")
            inside[last] = 1
            marks = np.full(len(x), 1 - side)
            marks[k] = inside
            packed.append((2 * x + marks).astype("<u4").tobytes())
        cuts = [(4 * u).tolist() for u in upto]
        return [
            (packed[0][a:b], packed[1][c:d]) for a, b, c, d in zip(cuts[0], cuts[0][1:], cuts[1], cuts[1][1:])
        ]

    def __call__(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Codes of A and of B of every text."""
        cut = [t.split(" ") if t else [] for t in texts]
        every, bound, new = list(set().union(*cut)), set(), []
        found = list(map(self.lone.get, every))
        for at in [at for at, ids in enumerate(found) if ids is None]:
            chunk = every[at]
            if chunk in self.lone.older:
                found[at] = self.lone[chunk]
            elif not chunk or chunk[0].isspace() or chunk[-1].isspace():
                bound.add(chunk)  # can't be looked at alone
                found[at] = b"", b""
            else:
                new.append(at)
        for at, ids in zip(new, self.encode([" " + every[at] for at in new]) if new else ()):
            found[at] = self.lone.put(every[at], ids)
        # a chunk is joined into its texts by its place among those of all texts at hand
        place, sides = dict(zip(every, range(len(every)))), [bpe.Lists(list(side)) for side in zip(*found)]
        for text, chunks in zip(texts, cut):
            if not chunks:
                yield np.empty(0, "int64"), np.empty(0, "int64")
            elif bound.isdisjoint(chunks):
                rows = np.fromiter(map(place.__getitem__, chunks), "int64", len(chunks))
                yield tuple(side.joined(rows) for side in sides)
            else:
                ids = map(b"".join, zip(*(self.known[" " + c] for c in bpe.INNER_SPACE.split(text))))
                yield tuple(np.frombuffer(x, "<u4").astype("int64") for x in ids)

    def ends(self, text: str, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Byte offsets at which the tokens end; None where there are none or they don't spell a space and the text.

        Both vocabularies have every byte and replace nothing but the mark, so only a mark
        in the text, or another number of bytes, can make them differ.
        """
        if not text or piece_codec.MARK in text:
            return None
        a, b, size = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), 1 + len(text.encode())
        return (a, b) if a[-1] == b[-1] == size else None

    def grouped(self, codes: np.ndarray, other: np.ndarray, ends: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Last A token and last B token of every group of a text."""
        last = np.flatnonzero(codes & 1), np.flatnonzero(other & 1)
        if len(last[0]) == len(last[1]):
            return last
        return tuple(map(np.array, groups(ends[0].tolist(), ends[1].tolist())))

    def spelled(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> bytes:
        """Groups as text: ids of a side by ``,``, the sides by ``|``, groups by ``;``."""
        ends_a, ends_b = np.zeros(len(a), "int64"), np.zeros(len(b), "int64")
        ends_a[last_a] = ends_b[last_b] = 1
        # a token stands after the tokens of its side and those of the other side's finished groups
        codes = np.empty(len(a) + len(b), "int64")
        before_a = np.concatenate([[0], last_b + 1])[np.cumsum(ends_a) - ends_a]
        before_b = (last_a + 1)[np.cumsum(ends_b) - ends_b]
        codes[np.arange(len(a)) + before_a] = 2 * a + ends_a
        codes[np.arange(len(b)) + before_b] = 2 * (len(self.size_a) + b) + ends_b
        shown = self.shown[codes].ravel()
        return shown[shown != 0].tobytes()[:-1]


@functools.lru_cache(maxsize=2)
def aligner(vocabulary_a: str, vocabulary_b: str, remembered: int) -> Aligner:
    """One for all tasks that a Python worker runs."""
    return Aligner(vocabulary_a, vocabulary_b, remembered)


class Block:
    """Documents of one block and the id pairs linked in each; a pair is kept once for the block."""

    def __init__(self, number: int):
        self.number, self.rows, self.keys, self.times, self.size = number, [], [], [], 0

    def add(self, row: tuple, keys: np.ndarray, times: np.ndarray) -> None:
        self.rows.append(row)
        self.keys.append(keys)
        self.times.append(times.astype("<u4").tobytes())
        self.size += len(keys)

    def batches(self, id_type: pa.DataType, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The documents, with the place of each pair in the block's list, then that list."""
        pairs, place, docs = np.unique(np.concatenate(self.keys), return_inverse=True, return_counts=True)
        place = place.astype("<u4")
        ends = np.cumsum([len(k) for k in self.keys])
        columns = [list(c) for c in zip(*self.rows)]
        at = [place[e - len(k) : e].tobytes() for e, k in zip(ends, self.keys)]
        none = [None] * len(at)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([self.number] * len(at), pa.int64()),
                pa.array(columns[0], id_type),
                *(pa.array(c, pa.int64()) for c in columns[1:5]),
                pa.array(columns[5], pa.string()),
                pa.array(at, pa.binary()),
                pa.array(self.times, pa.binary()),
                *(pa.array(none, schema.field(i).type) for i in range(9, 13)),
            ],
            schema=schema,
        )
        for k in range(0, len(pairs), 1 << 16):
            some, part = pairs[k : k + (1 << 16)], docs[k : k + (1 << 16)]
            lists = [np.arange(k, k + len(some)), some >> 32, some & 0xFFFFFFFF, part]
            empty = [pa.array([None], schema.field(i).type) for i in range(1, 9)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.number], pa.int64()), *empty, *(pa.array([x], pa.list_(pa.int32())) for x in lists)], schema=schema
            )


def align(
    docs: DataFrame,
    vocabulary_a: str,
    vocabulary_b: str,
    block_pairs: int = 1 << 20,
    block_rows: int = 8192,
    remembered: int = 400_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is a byte-level vocabulary on a space and the text, B a SentencePiece one on the
    text; strings of special tokens are plain text.  The offsets at which tokens of both
    end cut the text into groups (``groups``).  Links are the pairs of tokens whose bytes
    overlap; a pair of ids counts in as many documents as hold it linked.  ``n_best`` is
    the number of links whose count is the highest of their A id, ``count_sum`` the sum
    of counts over all links, ``groups_sha256`` the digest of the groups as text.

    The first pass encodes, cuts and links.  It puts documents into blocks of about
    ``block_pairs`` distinct pairs per document, at most ``block_rows`` documents, and
    writes each pair once for a block, so what is counted and joined by pair grows with
    the blocks, not with the links; a document refers to the pairs of its block by place.
    Counts go back to their blocks, and each block meets its documents.  A block is
    bounded by its limits and the longest document; a pair that every block holds is
    added up before the shuffle and has one row a block in the join.

    A text that is NULL, empty, or that one side's tokens don't spell has no tokens:
    zeros and the empty string.  A NULL id stays, repeated rows count as documents each,
    other columns are ignored, an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"block long, id {kind}, {COUNTS}, groups_sha256 string, at binary, times binary, "
        "place array<int>, a array<int>, b array<int>, docs array<int>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, base = aligner(vocabulary_a, vocabulary_b, remembered), TaskContext.get().partitionId() << 32
        block, number, kinds, id_type = Block(base), 0, None, None
        for batch in batches:
            id_type = batch.column(0).type
            if kinds is None:
                wide = [pa.int64(), id_type, *[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary(), *[pa.list_(pa.int32())] * 4]
                kinds = pa.schema([pa.field(c.split()[0], t) for c, t in zip(schema.split(", "), wide)])
            for part in bpe.some(batch):
                texts = part.column(1).to_pylist()
                for name, text, codes in zip(part.column(0).to_pylist(), texts, of(texts)):
                    a, b = codes[0] >> 1, codes[1] >> 1
                    ends = of.ends(text, a, b)
                    if ends is None:
                        none = np.empty(0, "int64")
                        block.add((name, 0, 0, 0, 0, ""), none, none)
                    else:
                        last_a, last_b = of.grouped(*codes, ends)
                        left, right = links(*ends)
                        sha = hashlib.sha256(of.spelled(a, b, last_a, last_b)).hexdigest()
                        keys, times = np.unique(a[left] << 32 | b[right], return_counts=True)
                        block.add((name, len(a), len(b), len(last_a), len(left), sha), keys, times)
                    if block.size >= block_pairs or len(block.rows) >= block_rows:
                        yield from block.batches(id_type, kinds)
                        number += 1
                        block = Block(base + number)
        if block.rows:
            yield from block.batches(id_type, kinds)

    read = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    rows = stored(read.mapInArrow(run, schema), "alignment-blocks")
    pairs = rows.filter(F.col("place").isNotNull()).select(F.col("block").alias("home"), F.inline(F.arrays_zip("place", "a", "b", "docs")))
    counted = pairs.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    highest = Window.partitionBy("a")  # at most the vocabulary of B
    counted = counted.withColumn("best", F.col("count") == F.max("count").over(highest))
    found = pairs.select("home", "place", "a", "b").join(counted, ["a", "b"]).select("home", "place", "count", "best")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        place = np.array(right["place"])
        count, best = np.zeros(len(place), "int64"), np.zeros(len(place), "int64")
        count[place], best[place] = np.array(right["count"]), np.array(right["best"])
        n_best, total = [], []
        for at, times in zip(left["at"].to_pylist(), left["times"].to_pylist()):
            at, times = np.frombuffer(at, "<u4"), np.frombuffer(times, "<u4").astype("int64")
            n_best.append(int(best[at] @ times))
            total.append(int(count[at] @ times))
        out = left.drop_columns(["block", "at", "times"])
        return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))

    known = rows.filter(F.col("place").isNull()).drop("place", "a", "b", "docs")
    out = known.groupBy("block").cogroup(found.groupBy("home"))
    out = out.applyInArrow(meet, f"id {kind}, {COUNTS}, groups_sha256 string, n_best long, count_sum long")
    return out.withColumnRenamed("id", id_col)

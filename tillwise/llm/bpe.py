"""Byte-pair merging for the JSON vocabularies of the ``tokenizers`` library.

Per-row helpers used inside Arrow batches.  The files are read where they lie, on every
executor; their path is a parameter.
"""

from __future__ import annotations

import functools
import heapq
import json
import struct
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: White space as the library's patterns see it (the Unicode property).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: The word patterns of the two supported kinds of vocabulary.
BYTE_WORDS = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
LOWER_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")

#: A space between two characters that are no white space: a new word always starts there.
INNER_SPACE = regex.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a vocabulary file."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in set(printable) else chr(next(others)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    first: list[int]  # id of a byte inside a word
    last: list[int]  # id of a byte at the end of a word
    ranks: dict[int, int]  # left id and right id of a pair -> its rank
    whole: list[int]  # rank -> id of the merged pair
    pieces: dict[int, bytes]  # id -> its bytes
    special: dict[str, int]
    lower: bool  # NFC, lower case, white space dropped


@functools.lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, ids = spec["model"], spec["model"]["vocab"]
    suffix = model["end_of_word_suffix"] or ""
    steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    if model["type"] != "BPE" or steps not in ([], ["NFC", "Replace", "Lowercase"]) or model["ignore_merges"]:
        raise ValueError(f"{path} is of another kind")
    letters = byte_letters()
    byte_of = {c: b for b, c in enumerate(letters)}
    ranks = {ids[a] << 32 | ids[b]: rank for rank, (a, b) in enumerate(model["merges"])}
    whole = [ids[a + b] for a, b in model["merges"]]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    pieces = {i: c.encode() for c, i in special.items()}
    for token, i in ids.items():
        if i not in pieces:
            word = token[: -len(suffix)] + " " if suffix and token.endswith(suffix) else token
            pieces[i] = bytes(byte_of.get(c, 32) for c in word)
    return Vocabulary([ids[c] for c in letters], [ids[c + suffix] for c in letters], ranks, whole, pieces, special, bool(steps))


def merge(symbols: list[int], ranks: dict[int, int], whole: list[int]) -> int:
    """Merge adjacent pairs in place, lowest rank first and leftmost among equals.

    A heap holds the known pairs as rank and position in one integer, a doubly linked
    list the living symbols.  An entry is stale when the pair at its position has
    another rank by now; it is skipped when popped.  A symbol merged into its left
    neighbour becomes -1.  Returns the number of merges.
    """
    n, rank_of, push, pop = len(symbols), ranks.get, heapq.heappush, heapq.heappop
    heap = []
    left = symbols[0]
    for i in range(1, n):
        right = symbols[i]
        rank = rank_of(left << 32 | right)
        if rank is not None:
            heap.append(rank << 32 | i - 1)
        left = right
    if not heap:
        return 0
    heapq.heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    merges = 0
    while heap:
        entry = pop(heap)
        i = entry & 0xFFFFFFFF
        j = after[i]
        if j >= n or rank_of(symbols[i] << 32 | symbols[j]) != entry >> 32:
            continue
        merges += 1
        both = symbols[i] = whole[entry >> 32]
        symbols[j] = -1
        j = after[i] = after[j]
        if j < n:
            before[j] = i
            rank = rank_of(both << 32 | symbols[j])
            if rank is not None:
                push(heap, rank << 32 | i)
        j = before[i]
        if j >= 0:
            rank = rank_of(symbols[j] << 32 | both)
            if rank is not None:
                push(heap, rank << 32 | j)
    return merges


class Recent(dict):
    """Results by key, computed when missing; holds at most twice ``limit`` of them."""

    def __init__(self, compute: Callable, limit: int = 500_000):
        super().__init__()
        self.compute, self.limit, self.older = compute, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        return self.put(key, value)

    def put(self, key, value):
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def some(batch: pa.RecordBatch, rows: int = 512, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows or, where one text is not longer, ``size`` bytes of text (column 1)."""
    ends, at = np.array(pc.cumulative_sum(pc.binary_length(batch.column(1)).cast(pa.int64()))), 0
    while at < batch.num_rows:
        past = ends[at - 1] if at else 0
        upto = min(at + rows, max(at + 1, int(np.searchsorted(ends, past + size, "right"))))
        yield batch.slice(at, upto - at)
        at = upto


class Lists:
    """Packed ids of many chunks, one after another."""

    def __init__(self, packed: list[bytes]):
        self.values = np.frombuffer(b"".join(packed), "<u4").astype("int64")
        self.sizes = np.array([len(p) // 4 for p in packed], "int64")
        self.starts = np.cumsum(self.sizes) - self.sizes

    def joined(self, rows: np.ndarray) -> np.ndarray:
        """The ids of the chunks at ``rows``, in that order."""
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        return self.values[np.repeat(self.starts[rows] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class LooseSpace(Exception):
    """A chunk begins or ends with white space, so it can't be looked at alone."""


class Encoder:
    """Maps texts to one value a word, with results of frequent chunks kept.

    ``of_word`` gives the value of a list of initial symbols, ``of_special`` that of a
    special token, ``add`` adds up an iterable of values.  A text is cut at spaces that
    surely separate words, so a chunk has the same words wherever it stands.
    """

    def __init__(self, vocabulary: Vocabulary, of_word: Callable, of_special: Callable, add: Callable):
        self.v, self.of_word, self.of_special, self.add = vocabulary, of_word, of_special, add
        self.words = Recent(self._word)
        self.lead = Recent(self._lead)
        self.inner = Recent(self._lower if vocabulary.lower else self._inner)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")")

    def _word(self, word: str):
        data = word.encode()
        return self.of_word([*map(self.v.first.__getitem__, data[:-1]), self.v.last[data[-1]]])

    def _lower(self, chunk: str):
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        return self.add(map(self.words.__getitem__, LOWER_WORDS.findall(chunk.lower())))

    def _bytes(self, chunk: str):
        return self.add(map(self.words.__getitem__, BYTE_WORDS.findall(chunk)))

    def _lead(self, chunk: str):
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise LooseSpace
        return self._bytes(chunk)

    def _inner(self, chunk: str):
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise LooseSpace
        return self._bytes(" " + chunk)

    def _plain(self, text: str) -> Iterator:
        if not text:
            return iter(())
        if self.v.lower:
            return map(self.inner.__getitem__, text.replace("\n", " ").split(" "))
        chunks = text.split(" ")
        try:
            return iter([self.lead[chunks[0]], *map(self.inner.__getitem__, chunks[1:])])
        except LooseSpace:
            chunks = INNER_SPACE.split(text)
            return iter([self._bytes(chunks[0]), *(self._bytes(" " + c) for c in chunks[1:])])

    def __call__(self, text: str):
        if "<|" not in text:
            return self.add(self._plain(text))
        values = []
        for part in self.specials.split(text):
            if part in self.v.special:
                values.append(self.of_special(self.v.special[part]))
            else:
                values.extend(self._plain(part))
        return self.add(values)


def pack_ids(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


@functools.lru_cache(maxsize=4)
def id_encoder(path: str) -> Encoder:
    """Text to packed ids."""
    v = load(path)

    def of_word(symbols: list[int]) -> bytes:
        merge(symbols, v.ranks, v.whole)
        return pack_ids([s for s in symbols if s >= 0])

    return Encoder(v, of_word, lambda i: pack_ids([i]), b"".join)


@functools.lru_cache(maxsize=4)
def counter(path: str) -> Encoder:
    """Text to its number of tokens: initial symbols less merges; no ids are made."""
    v = load(path)
    return Encoder(v, lambda symbols: len(symbols) - merge(symbols, v.ranks, v.whole), lambda _: 1, sum)

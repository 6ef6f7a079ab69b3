"""SentencePiece encoding by a score-ordered agenda of adjacent pairs, and decoding by vocabulary strings."""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Recent, pack_ids
from .common import text_or_empty

#: The letter that stands for a space in a vocabulary.
MARK = "▁"


@dataclass(frozen=True)
class Pieces:
    symbol: dict[str, int]  # a single character -> its symbol
    pairs: dict[int, int]  # left and right symbol -> rank << 32 | merged symbol
    size: int  # symbols from here on are characters without an id of their own
    letters: list[str]  # those characters
    bytes_of: list[int]  # byte -> id of the piece that stands for it
    text: list[bytes]  # id -> its bytes when decoded
    silent: frozenset[int]  # control ids, which decode to nothing
    plain: frozenset[int]  # ids of ordinary pieces
    begin: int
    end: int
    words: bool  # no piece crosses from another letter to the mark or holds a line break


@functools.lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    """A merge-type vocabulary with byte fallback and no normalisation but the mark.

    Equal scores share a rank, since the agenda then goes by position alone.
    """
    from sentencepiece import sentencepiece_model_pb2 as model

    spec = model.ModelProto()
    with open(path, "rb") as f:
        spec.ParseFromString(f.read())
    kinds, norm = model.ModelProto.SentencePiece, spec.normalizer_spec
    allowed = {kinds.NORMAL, kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE}
    if (
        spec.trainer_spec.model_type != model.TrainerSpec.BPE
        or not spec.trainer_spec.byte_fallback
        or spec.trainer_spec.treat_whitespace_as_suffix
        or norm.precompiled_charsmap
        or not (norm.add_dummy_prefix and norm.escape_whitespaces)
        or norm.remove_extra_whitespaces
        or not {p.type for p in spec.pieces} <= allowed
    ):
        raise ValueError(f"{path} is of another kind")
    ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == kinds.NORMAL}
    score = {p.piece: p.score for p in spec.pieces if p.type == kinds.NORMAL}
    rank = {s: r for r, s in enumerate(sorted({score[p] for p in ids if len(p) > 1}, reverse=True))}
    loose = sorted({c for p in ids for c in p if len(p) > 1} - set(ids))
    symbol = {**{p: i for p, i in ids.items() if len(p) == 1}, **{c: len(spec.pieces) + k for k, c in enumerate(loose)}}
    known = {**ids, **symbol}
    pairs = {}
    for piece in ids:
        for cut in range(1, len(piece)):
            left, right = known.get(piece[:cut]), known.get(piece[cut:])
            if left is not None and right is not None:
                pairs[left << 32 | right] = rank[score[piece]] << 32 | ids[piece]
    by_byte = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == kinds.BYTE}
    text = []
    for p in spec.pieces:
        if p.type == kinds.BYTE:
            text.append(bytes([int(p.piece[3:5], 16)]))
        elif p.type == kinds.UNKNOWN:
            text.append(spec.trainer_spec.unk_surface.encode())
        else:
            text.append(b"" if p.type == kinds.CONTROL else p.piece.replace(MARK, " ").encode())
    return Pieces(
        symbol,
        pairs,
        len(spec.pieces),
        loose,
        [by_byte[b] for b in range(256)],
        text,
        frozenset(i for i, p in enumerate(spec.pieces) if p.type == kinds.CONTROL),
        frozenset(ids.values()),
        spec.trainer_spec.bos_id,
        spec.trainer_spec.eos_id,
        not any(re.search(rf"[^{MARK}]{MARK}", p) or "\n" in p for p in ids if len(p) > 1),
    )


def agenda(symbols: list[int], pairs: dict[int, int]) -> None:
    """Merge adjacent symbols in place, highest score first and leftmost among equals.

    The agenda holds the known pairs as rank and position; two lists link the living
    symbols.  An entry whose position holds another pair by now, or a symbol that was
    merged into its left neighbour (-1), is skipped when its turn comes.
    """
    n, pair_of = len(symbols), pairs.get
    todo = []
    for i in range(n - 1):
        known = pair_of(symbols[i] << 32 | symbols[i + 1])
        if known is not None:
            todo.append(known >> 32 << 32 | i)
    if not todo:
        return
    heapq.heapify(todo)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while todo:
        entry = heapq.heappop(todo)
        i = entry & 0xFFFFFFFF
        j = after[i]
        if j >= n:
            continue
        known = pair_of(symbols[i] << 32 | symbols[j])
        if known is None or known >> 32 != entry >> 32:
            continue
        both = symbols[i] = known & 0xFFFFFFFF
        symbols[j] = -1
        j = after[i] = after[j]
        if j < n:
            before[j] = i
            known = pair_of(both << 32 | symbols[j])
            if known is not None:
                heapq.heappush(todo, known >> 32 << 32 | i)
        j = before[i]
        if j >= 0:
            known = pair_of(symbols[j] << 32 | both)
            if known is not None:
                heapq.heappush(todo, known >> 32 << 32 | j)


class PieceEncoder:
    """Texts to packed ids; the ids of frequent chunks are kept.

    Where no piece can reach over them, a text is cut at line breaks and where a run of
    spaces begins, so a chunk has the same pieces wherever it stands.  ``checked`` has
    every chunk that is encoded anew encoded by the library as well, many at a time.
    """

    def __init__(self, path: str, checked: bool, remembered: int):
        self.v, self.path = load(path), path
        self.chunks = re.compile(r" *[^ \n]+| +|\n" if self.v.words else r"(?s).+")
        self.known = Recent(self._chunk, limit=remembered)
        self.fresh: list[str] = []
        self.library = None
        if checked:
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_file=path)

    def _chunk(self, chunk: str) -> bytes:
        v = self.v
        symbols = [v.symbol.get(c, -2 - ord(c)) for c in chunk.replace(" ", MARK)]
        agenda(symbols, v.pairs)
        if self.library:
            self.fresh.append(chunk)
        if min(symbols) >= -1 and max(symbols) < v.size:
            return pack_ids([s for s in symbols if s >= 0])
        ids: list[int] = []
        for s in symbols:
            if 0 <= s < v.size:
                ids.append(s)
            elif s != -1:  # a character that is no piece goes by its bytes
                letter = v.letters[s - v.size] if s >= 0 else chr(-2 - s)
                ids.extend(map(v.bytes_of.__getitem__, letter.encode()))
        return pack_ids(ids)

    def __call__(self, text: str) -> bytes:
        """Ids of a text, without begin and end."""
        if not text:
            return b""
        return b"".join(map(self.known.__getitem__, self.chunks.findall(" " + text.replace(MARK, " "))))

    def check(self, at_once: int = 64) -> None:
        """Compare what was encoded anew since the last call with the library; a difference is an error."""
        fresh, self.fresh = self.fresh, []
        if not fresh:
            return
        if not self.v.words:
            asked, heads = [c[1:] for c in fresh], [b""] * len(fresh)
            want = [self.known[c] for c in fresh]
        else:
            # a line break before every chunk: its own bytes, and no piece reaches over it
            line = pack_ids([self.v.bytes_of[10]])
            groups = [fresh[k : k + at_once] for k in range(0, len(fresh), at_once)]
            asked = ["\n" + "\n".join(g) for g in groups]
            heads = [self.known[" "] + line] * len(groups)
            want = [line.join(map(self.known.__getitem__, g)) for g in groups]
            self.fresh = []  # a single space may have been new
        for text, head, ids, library in zip(asked, heads, want, self.library.encode(asked, num_threads=1)):
            if head + ids != pack_ids(library):
                raise ValueError(f"{self.path}: other ids than the library's in {text[:200]!r}")


@functools.lru_cache(maxsize=4)
def encoder(path: str, checked: bool = True, remembered: int = 500_000) -> PieceEncoder:
    """One for all tasks that a Python worker runs."""
    return PieceEncoder(path, checked, remembered)


def decode_ids(v: Pieces, ids: Iterable[int]) -> str:
    """The text of ids, as the library has it.

    Control ids are silent, the first mark of the first piece is the space that encoding
    put there, and every byte of a run of byte pieces that is no UTF-8 becomes U+FFFD.
    """
    ids = list(ids)
    first = next((i for i in ids if i not in v.silent), None)
    if first is None:
        return ""
    strip = first in v.plain and v.text[first].startswith(b" ")
    # control ids end a run of byte pieces; at the ends of a text there is none to end
    inner = ids[ids[0] in v.silent : len(ids) - (ids[-1] in v.silent)]
    if v.silent.isdisjoint(inner):
        try:
            return b"".join(map(v.text.__getitem__, inner))[strip:].decode()
        except UnicodeDecodeError:
            pass
    out, run = [], b""
    for i in [*ids, None]:
        if i is not None and i not in v.plain and i not in v.silent and len(v.text[i]) == 1:
            run += v.text[i]
            continue
        while run:
            size = next((k for k in (1, 2, 3, 4) if _valid(run[:k])), 0)
            out.append(run[:size].decode() if size else "\ufffd")
            run = run[size or 1 :]
        if i is not None:
            out.append(v.text[i].decode())
    return "".join(out)[strip:]


def _valid(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


def _slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def encode(
    docs: DataFrame, vocabulary: str, ends: bool = True, checked: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, ids (array<int>), the pieces of the whole text.

    ``ends`` puts the begin and end ids around them.  ``checked`` compares every chunk
    that a task sees for the first time with the library's ids and fails where they
    differ.  A NULL or empty text has no pieces of its own.  A NULL id stays, repeated
    rows are encoded each, other columns are ignored, an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(vocabulary, checked)
        begin, end = ([of.v.begin], [of.v.end]) if ends else ([], [])
        for batch in batches:
            for part in _slices(batch):
                ids = [[*begin, *np.frombuffer(of(t), "<u4").tolist(), *end] for t in part.column(1).to_pylist()]
                of.check()
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    read = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    out = read.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, ids array<int>")
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row: id, text, the vocabulary strings of the ids put together (``decode_ids``).

    NULL or no ids give the empty text; an id outside the vocabulary is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load(vocabulary)
        for batch in batches:
            texts = [decode_ids(v, ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    read = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    out = read.mapInArrow(run, f"id {encoded.schema[id_col].dataType.simpleString()}, text string")
    return out.withColumnRenamed("id", id_col)


def round_trip(
    docs: DataFrame, vocabulary: str, checked: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode each whole text with begin and end ids and decode them: id, n_tokens, ids_sha256, decoded_sha256.

    The digests are of the ids as little-endian unsigned 32-bit integers and of the
    decoded text in UTF-8.  One pass, text by text, without a shuffle; a worker keeps the
    ids of a bounded number of recent chunks.  ``checked``, NULLs, empty texts and
    repeated rows as in ``encode``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(vocabulary, checked)
        begin, end = pack_ids([of.v.begin]), pack_ids([of.v.end])
        for batch in batches:
            for part in _slices(batch):
                n, ids_sha, text_sha = [], [], []
                for text in part.column(1).to_pylist():
                    ids = begin + of(text) + end
                    n.append(len(ids) // 4)
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    decoded = decode_ids(of.v, np.frombuffer(ids, "<u4").tolist())
                    text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                of.check()
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    read = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = read.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)

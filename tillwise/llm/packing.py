"""Packing by lexical retrieval: a seed document's window is filled with its BM25 neighbours."""

from __future__ import annotations

import bisect
import functools
import math
import os
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import LOWER_WORDS, Lists, Recent, byte_letters, some
from .common import stored, text_or_empty

#: BM25's usual constants.
K1, B = 1.2, 0.75

#: Terms in a lexical key, documents sampled for each partition, and most partitions:
#: at most 524,288 keys of 52 bytes reach the driver, whatever the corpus.
KEY_TERMS, SAMPLED, PARTS = 8, 32, 1 << 14

#: Chunks between spaces that are looked up together, and whose ids are joined together.
CHUNKS, JOINED = 1 << 20, 1 << 16

#: Signs that end a word and begin the next one.
SIGNS = ".,;:!?\"()"

#: First character after the Latin blocks.
LATIN = "\u0250"

LETTERS = byte_letters()

PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def plain(word: str) -> str:
    """NFC in lower case."""
    return word.lower() if word.isascii() else unicodedata.normalize("NFC", word).lower()


class LibraryEncoder:
    """Texts to ids by the ``tokenizers`` library, which sees every word once.

    For vocabularies that drop white space: chunks between spaces are independent.
    """

    def __init__(self, path: str, remembered: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        if [s.content for s in self.library.get_added_tokens_decoder().values() if " " in s.content]:
            raise ValueError(f"{path} has added tokens with spaces")
        if self.library.encode("a b \n c", add_special_tokens=False).tokens != [
            t for c in "abc" for t in self.library.encode(c, add_special_tokens=False).tokens
        ]:
            raise ValueError(f"{path} keeps white space")
        probe = "don't 'll 120ab,;'s!?a (x)"
        if [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(probe)] != LOWER_WORDS.findall(probe):
            raise ValueError(f"{path} has other word patterns")
        self.model = self.library.model
        self.model._resize_cache(0)  # words are kept here
        self.known = Recent(self.word, limit=remembered)

    def word(self, word: str) -> bytes:
        """Packed ids of a word of the library's patterns, or of a chunk they must be applied to."""
        if word.isascii() and word.isalpha() and word.islower():
            letters = word
        elif word and "<|" not in word and max(word) < LATIN and plain(word) == word and (word.isalpha() or LOWER_WORDS.fullmatch(word)):
            letters = "".join(map(LETTERS.__getitem__, word.encode()))
        else:
            return array("I", self.library.encode(word, add_special_tokens=False).ids).tobytes()
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def chunk(self, chunk: str) -> bytes:
        """Packed ids of what stands between two spaces.

        Latin letters, digits and signs are cut into words here as the library's patterns do,
        so only words in lower case are kept, each of which goes to its model once.
        """
        if not (chunk.isascii() and chunk.isalpha() and chunk.islower()):
            word = chunk.rstrip(SIGNS)
            low = plain(word)
            if low.isalpha() and (low.isascii() or max(low) < LATIN):
                return self.known[low] + self.known[chunk[len(word) :]] if word != chunk else self.known[low]
            low = plain(chunk)
            if chunk and max(low) < LATIN and "<|" not in chunk:
                return b"".join(map(self.known.__getitem__, LOWER_WORDS.findall(low)))
        return self.known[chunk]

    def every(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; of ``CHUNKS`` chunks, those that are equal are looked up once."""
        simple = pc.and_(pc.string_is_ascii(texts), pc.invert(pc.match_substring(texts, "<|")))
        texts = pc.if_else(simple, pc.ascii_lower(texts), texts)
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        chunks, ids, sizes, known = split.flatten(), [], [[0]], self.known.get
        for at in range(0, len(chunks), CHUNKS):
            some = chunks.slice(at, CHUNKS).dictionary_encode()
            lists = Lists([known(c) or self.chunk(c) for c in some.dictionary.to_numpy(zero_copy_only=False)])
            rows = some.indices.to_numpy()
            sizes.append(lists.sizes[rows])
            ids += [lists.joined(rows[at : at + JOINED]).astype("<u4") for at in range(0, len(rows), JOINED)]
        passed = np.cumsum(np.concatenate(sizes))  # ids before each chunk
        first = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
        return np.split(np.concatenate(ids), passed[first[1:-1]]) if len(texts) else []

    def __call__(self, text: str) -> np.ndarray:
        """Ids of a text."""
        return self.every(pa.array([text]))[0]


@functools.lru_cache(maxsize=2)
def encoder(path: str, remembered: int) -> LibraryEncoder:
    """One for all tasks that a Python worker runs, so they share what it knows."""
    return LibraryEncoder(path, remembered)


def counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terms of a document, rising, and how often each stands in it."""
    if not len(ids):
        return ids, np.empty(0, "int64")
    ids = np.sort(ids, kind="stable")
    at = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1, [len(ids)]])
    return ids[at[:-1]], np.diff(at)


class Statistics:
    """What BM25 needs to know of all documents: their number, mean length and each term's df."""

    def __init__(self, docs: int, tokens: int, df: np.ndarray):
        self.mean, self.df = max(tokens / max(docs, 1), 1.0), df
        self.idf = np.log1p((docs - df + 0.5) / (df + 0.5))

    def weights(self, terms: np.ndarray, tf: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return self.idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / self.mean))


class Index:
    """The inverted index of one shard: postings (document, BM25 weight) by term.

    A term that a quarter of the shard holds has its postings as a dense row, the others
    as lists; a seed touches the rows and lists of its own terms and nothing else.  Used
    documents leave both once a good part of those listed is used.  ``statistics`` are
    those of all documents; without them, of the shard.
    """

    def __init__(self, docs: list[np.ndarray], statistics: Statistics | None = None):
        self._build([counted(d) for d in docs], np.array([len(d) for d in docs], "int64"), statistics)

    @classmethod
    def of_terms(cls, uniq: list[tuple], lengths: np.ndarray, statistics: Statistics) -> Index:
        """From each document's terms with their counts, and its length."""
        index = cls.__new__(cls)
        index._build(uniq, lengths, statistics)
        return index

    def _build(self, uniq: list[tuple], lengths: np.ndarray, statistics: Statistics | None) -> None:
        sizes = np.array([len(u) for u, _ in uniq], "int64")
        self.term = np.concatenate([u for u, _ in uniq]).astype("int64")
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        if statistics is None:
            statistics = Statistics(len(uniq), int(lengths.sum()), np.bincount(self.term))
        tf = np.concatenate([c for _, c in uniq]).astype("float64")
        weight = statistics.weights(self.term, tf, np.repeat(lengths, sizes))
        self.terms, self.local = np.unique(self.term, return_inverse=True)
        held = np.bincount(self.local, minlength=len(self.terms))
        self.row = np.where(4 * held >= len(uniq), 0, -1)
        self.row[self.row == 0] = np.arange((self.row == 0).sum())
        self.found = np.arange(len(uniq))  # the documents that can still be found
        doc = np.repeat(self.found, sizes)
        dense = self.row[self.local] >= 0
        self.dense = np.zeros((int(self.row.max(initial=-1)) + 1, len(uniq)))
        self.dense[self.row[self.local[dense]], doc[dense]] = weight[dense]
        order = np.flatnonzero(~dense)[np.argsort(self.local[~dense], kind="stable")]
        self.doc, self.weight = doc[order], weight[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.local[order], minlength=len(self.terms)))])

    def forget(self, unused: np.ndarray) -> None:
        """Search only ``unused`` documents from now on, once a good part of the others is used."""
        keep = unused[self.found]
        if keep.sum() < 0.85 * len(keep):
            moved = np.cumsum(keep) - 1
            self.found, self.dense = self.found[keep], np.ascontiguousarray(self.dense[:, keep])
            left = keep[self.doc]
            self.first = np.concatenate([[0], np.cumsum(left)])[self.first]
            self.doc, self.weight = moved[self.doc[left]], self.weight[left]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document of ``found`` for the terms of ``seed``; 0 where none is shared."""
        mine = self.local[self.at[seed] : self.at[seed + 1]]
        out = self.dense[self.row[mine][self.row[mine] >= 0]].sum(0)
        begin, size = self.first[mine], self.first[mine + 1] - self.first[mine]
        ends = np.cumsum(size)
        if len(ends) and ends[-1]:
            posts = np.repeat(begin - ends + size, size) + np.arange(ends[-1])
            out = out + np.bincount(self.doc[posts], self.weight[posts], minlength=len(self.found))
        return out

    def neighbours(self, seed: int, unused: np.ndarray, room: int | None = None, left: np.ndarray | None = None) -> np.ndarray:
        """Unused documents sharing one of the seed's terms, best first.

        With ``room``, those of at most ``room`` tokens ``left``, and of the others the best
        one, as no other can be placed or cut.
        """
        score = self.scores(seed) * unused[self.found]
        hits = np.flatnonzero(score)
        if room is not None and len(hits):
            fit = left[self.found[hits]] <= room
            long = hits[~fit]
            hits = np.sort(np.append(hits[fit], long[score[long].argmax(keepdims=True)])) if len(long) else hits
        return self.found[hits[np.argsort(-score[hits], kind="stable")]]


class Packer:
    """Fills windows from one shard after another; the open window stays open between shards."""

    def __init__(self, window: int, sequence: int, statistics: Statistics):
        self.window, self.sequence, self.statistics = window, sequence, statistics
        self.open: list[tuple] = []  # (doc id, ids, start, length)
        self.room = window
        self.out: list[tuple] = []

    def place(self, doc_id, ids: bytes, start: int) -> int:
        """Put as much as fits from ``start`` into the open window; the new start."""
        length = min(self.room, len(ids) // 4 - start)
        self.open.append((doc_id, ids, start, length))
        self.room -= length
        if not self.room:
            self.close()
        return start + length

    def close(self) -> None:
        offset = 0
        for doc_id, ids, start, length in self.open:
            crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
            self.out.append((doc_id, start, length, crc, len(ids) // 4, self.sequence, offset))
            offset += length
        self.open, self.room, self.sequence = [], self.window, self.sequence + 1

    def shard(self, names: list, docs: list[bytes], terms: list[tuple]) -> None:
        if not docs:
            return
        left = np.array([len(d) // 4 for d in docs])
        index = Index.of_terms(terms, left - 1, self.statistics)
        unused = np.ones(len(docs), bool)
        seed, first = -1, 0
        while True:
            if seed < 0:
                while first < len(docs) and not unused[first]:
                    first += 1
                if first == len(docs):
                    return
                seed, start = first, 0
            unused[seed] = False
            sequence = self.sequence
            start = self.place(names[seed], docs[seed], start)
            if start < len(docs[seed]) // 4:
                continue  # the window is full; the rest of this document begins the next one
            best, seed_was, seed = None, seed, -1
            if self.sequence != sequence:
                continue
            index.forget(unused)
            near = index.neighbours(seed_was, unused, self.room, left)
            while len(near) and self.sequence == sequence:
                fits = np.flatnonzero(left[near] <= self.room)
                at = int(fits[0]) if len(fits) else len(near)
                if at and best is None:
                    best = near[0]
                if at < len(near):
                    unused[near[at]] = False
                    self.place(names[near[at]], docs[near[at]], 0)
                near = near[at + 1 :]
            if self.sequence == sequence and best is not None:  # cut the best neighbour that is too long
                seed, start = int(best), 0

    def finish(self) -> None:
        """Cut what is left into sequences whose lengths are powers of two, which need no padding."""
        rest, self.open = self.open, []
        total = sum(length for *_, length in rest)
        while total:
            self.room = 1 << (total.bit_length() - 1)
            total -= self.room
            sequence = self.sequence
            while self.sequence == sequence:
                doc_id, ids, start, length = rest.pop(0)
                take = min(length, self.room)
                if take < length:
                    rest.insert(0, (doc_id, ids, start + take, length - take))
                self.open.append((doc_id, ids, start, take))
                self.room -= take
                if not self.room:
                    self.close()


def packed(values: np.ndarray) -> bytes:
    """Numbers in two or four bytes each."""
    return values.astype("<u2" if values.max(initial=0) < 1 << 16 else "<u4").tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of ``packed``."""
    return np.frombuffer(data, f"<u{len(data) // n}") if n else np.empty(0, "<u2")


def encoded(docs: DataFrame, vocabulary: str, end_id: int, remembered: int) -> DataFrame:
    """``docs`` (id, text) as (id, ids, n, bag, k), stored: the ids, and the ``k`` terms followed by their counts.

    Beside them, in rows of their own, (term, df): the documents of a task by term, so
    that nothing looks at the ids again to count.
    """
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, df, schema = encoder(vocabulary, remembered), np.zeros(1 << 16, "int64"), None
        for batch in batches:
            if schema is None:
                kinds = [batch.column(0).type, pa.binary(), pa.int64(), pa.binary(), pa.int64(), *[pa.list_(pa.int64())] * 2]
                schema = pa.schema(list(zip(["id", "ids", "n", "bag", "k", "term", "df"], kinds)))
            for part in some(batch, 2048):
                rows = []
                for ids in encode.every(part.column(1)):
                    ids = ids.astype("<u2") if ids.max(initial=0) < 1 << 16 else ids
                    terms, tf = counted(ids)
                    if len(terms) and terms[-1] >= len(df):
                        df = np.concatenate([df, np.zeros(int(terms[-1]) + 1, "int64")])
                    df[terms] += 1
                    rows.append((packed(np.append(ids, end_id)), len(ids) + 1, packed(np.concatenate([terms, tf])), len(terms), None, None))
                columns = [part.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[1:]))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
        if schema is not None:
            seen = np.flatnonzero(df)
            row = [*[None] * 5, seen, df[seen]]
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(row, schema)], schema=schema)

    columns = "ids binary, n long, bag binary, k long, term array<long>, df array<long>"
    return stored(docs.mapInArrow(run, f"id {kind}, {columns}"), "packing-ids")


def statistics(rows: DataFrame) -> Statistics:
    """Document frequencies and mean length over all ``encoded`` documents.

    What comes back has one row a term, so it is bounded by the vocabulary.
    """
    counted = rows.filter("term IS NOT NULL").select(F.inline(F.arrays_zip("term", "df"))).groupBy("term").agg(F.sum("df").alias("df")).collect()
    size = rows.agg(F.count("n").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    df = np.zeros(max((r.term for r in counted), default=0) + 1, "int64")
    for r in counted:
        df[r.term] = r.df
    return Statistics(size.docs, size.tokens - size.docs, df)


def bag_of(bag: bytes, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Terms and counts of a stored bag."""
    both = unpacked(bag, 2 * k)
    return both[:k], both[k:].astype("int64")


def lexical_key(terms: np.ndarray, tf: np.ndarray, length: int, known: Statistics, common: np.ndarray) -> bytes:
    """A document's heaviest ``common`` terms, heaviest first, then its heaviest others; sorts as bytes."""
    weight = known.weights(terms, tf, length)
    weight += common[terms] * 1e6
    if len(terms) > KEY_TERMS:  # with all that weigh as much as the last one of the key
        heavy = np.flatnonzero(weight >= np.partition(weight, -KEY_TERMS)[-KEY_TERMS])
        terms, weight = terms[heavy], weight[heavy]
    order = np.lexsort((terms, -weight))
    return terms[order[:KEY_TERMS]].astype(">u4").tobytes().ljust(4 * KEY_TERMS, b"\0")


def placed(rows: DataFrame, known: Statistics, shard_tokens: int) -> DataFrame:
    """``encoded`` rows sorted by lexical key, in partitions of about two shards.

    The partitions' bounds come from the keys of a sample.  There are at most ``PARTS``
    partitions, so the sample that reaches the driver and the bounds in each task stay
    below a fixed size; beyond that a partition holds more shards.  Whatever shares a key
    is cut by the text's CRC, the id and the row's number, so no key is too large for one
    task.
    """
    kind = rows.schema["id"].dataType.simpleString()
    common = known.df * known.mean >= shard_tokens

    def run(batches: Iterator[pa.RecordBatch], bounds: list[bytes], whole: bool) -> Iterator[pa.RecordBatch]:
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys = []
            for name, ids, n, bag, k in zip(*(c.to_pylist() for c in batch.columns)):
                key = lexical_key(*bag_of(bag, k), n - 1, known, common) + zlib.crc32(ids).to_bytes(4)
                keys.append(key + zlib.crc32(repr(name).encode()).to_bytes(4) + task.to_bytes(4) + row.to_bytes(8))
                row += 1
            part = [bisect.bisect_right(bounds, k) for k in keys]
            taken = [*batch.columns, pa.array(part, pa.int32())] if whole else [batch.column(2)]
            names = ["id", "ids", "n", "bag", "k", "part", "key"] if whole else ["n", "key"]
            yield pa.RecordBatch.from_arrays([*taken, pa.array(keys, pa.binary())], names=names)

    size = rows.agg(F.count("n").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    parts = min(PARTS, max(1, math.ceil(size.tokens / (2 * shard_tokens))))
    bounds: list[bytes] = []
    if parts > 1:
        seen = rows.sample(min(1.0, SAMPLED * parts / size.docs), 7) if SAMPLED * parts < size.docs else rows
        taken = sorted((r.key, r.n) for r in seen.mapInArrow(lambda b: run(b, [], False), "n long, key binary").collect())
        passed = np.cumsum([n for _, n in taken])
        cuts = np.searchsorted(passed, passed[-1] * np.arange(1, parts) / parts) if len(taken) else []
        bounds = [bytes(taken[c][0]) for c in cuts]
    keyed = rows.mapInArrow(lambda b: run(b, bounds, True), f"id {kind}, ids binary, n long, bag binary, k long, part int, key binary")
    return keyed.repartitionById(parts, "part").sortWithinPartitions("key")


def pack(
    docs: DataFrame,
    vocabulary: str,
    window: int = 4096,
    end_id: int = 2,
    shard_tokens: int = 1 << 21,
    remembered: int = 700_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of token sequences: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids by the library followed by ``end_id``.  The ids are stored once;
    BM25's document frequencies and mean length are those of all documents.  Documents are
    sorted by a lexical key, their heaviest terms among those frequent enough to fill a
    shard, then their heaviest others, and cut into shards of about ``shard_tokens``
    tokens (a longer document is a shard of its own).  Each shard has an inverted index in
    memory, of which a seed reads the postings of its own terms.
    The first unused document is the seed of a window; its unused neighbours, those that
    share one of its terms, follow by falling BM25 score as far as they fit, and the best
    one that does not fit is cut to fill the rest and is the next seed.  A window that
    stays open takes the next seed.  Every token lies in one piece; only the last window of a
    partition is short, and it is cut into sequences whose lengths are powers of two, so
    nothing is padded.

    A seed's candidates are the documents of its shard, that is those nearest to it in key
    order; a document whose heaviest terms are others lies in another shard and is not one.

    One shuffle, of the ids; memory is bounded by the shard, the longest document, the
    vocabulary and the ids of at most twice ``remembered`` chunks that a worker keeps.
    ``sequence_id`` is unique, with the partition in its upper bits.  Documents with one
    key are ordered by text and id, not by where they arrived; only equal rows, and the
    bounds of the shards through a sample, depend on that.  A NULL or empty text is
    ``end_id`` alone.  A NULL id stays, repeated rows are packed each, other columns are
    ignored, an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = encoded(docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")), vocabulary, end_id, remembered)
    known = statistics(rows)
    rows = rows.filter("term IS NULL").drop("term", "df")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, TaskContext.get().partitionId() << 40, known)
        names, held, terms, size, id_type = [], [], [], 0, pa.null()

        def emit() -> pa.RecordBatch:
            rows, packer.out = packer.out, []
            columns = [list(c) for c in zip(*rows)] or [[] for _ in range(7)]
            arrays = [pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])]
            return pa.RecordBatch.from_arrays(arrays, names=["id", *(c.split()[0] for c in PIECE.split(", "))])

        for batch in batches:
            id_type = batch.column(0).type
            for name, ids, n, bag, k in zip(*(c.to_pylist() for c in batch.columns)):
                names.append(name)
                held.append(unpacked(ids, n).astype("<u4").tobytes())
                terms.append(bag_of(bag, k))
                size += n
                if size >= shard_tokens:
                    packer.shard(names, held, terms)
                    names, held, terms, size = [], [], [], 0
                    yield emit()
        packer.shard(names, held, terms)
        packer.finish()
        if packer.out:
            yield emit()

    ordered = placed(rows, known, shard_tokens).select("id", "ids", "n", "bag", "k")
    return ordered.mapInArrow(run, f"id {kind}, {PIECE}").withColumnRenamed("id", id_col)

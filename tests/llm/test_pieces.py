"""SentencePiece codec and alignment of two tokenizers against the libraries and plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from public_tokenizers import path
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tillwise.llm import alignment, bpe, piece_codec

PIECES, BYTES = path("piece_bpe_32k.model"), path("byte_bpe_50k.json")

EDGE = [None, "", " ", "   ", "\n", "a", "A  b\n\n c\t", "<|endoftext|>", "x <s> y</s> <unk> <0x41>", "été ÉTÉ é ΣΑΣ", "漢字 12½ don't we'LL",
        "\x1c\x85\xa0 z", "end ", " start", "  two", "😀 </w>\x00", "mark ▁ x", "▁", "word " * 3000, "q" * 5000, "        " * 40 + "x"]
LETTERS = list("aab  \n\tcdE'sTll've12½ßéÉΣİ漢́\x1c\x85\xa0!%_-<|>▁\x00") + ["<s>", "</s>", "<|endoftext|>", "the ", "    ", "😀", "�"]


def random_texts(n, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choices(LETTERS, k=rng.randint(0, 40))) for _ in range(n)]


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PIECES)


def test_same_ids_and_text_as_the_library(library):
    of = piece_codec.encoder(PIECES)
    for text in [t for t in EDGE if t is not None] + random_texts(4000):
        ids = np.frombuffer(of(text), "<u4").tolist()
        assert ids == library.encode(text), text
        assert piece_codec.decode_ids(of.v, [1, *ids, 2]) == library.decode([1, *ids, 2]), text
    of.check()
    rng = random.Random(3)
    for _ in range(4000):
        ids = [rng.randrange(300 if rng.random() < 0.7 else 32000) for _ in range(rng.randint(0, 8))]
        assert piece_codec.decode_ids(of.v, ids) == library.decode(ids), ids


def test_agenda_goes_by_score_then_position():
    pairs = {1 << 32 | 1: 0 << 32 | 2, 2 << 32 | 1: 1 << 32 | 3, 2 << 32 | 2: 0 << 32 | 4}
    symbols = [1] * 5
    piece_codec.agenda(symbols, pairs)
    assert [s for s in symbols if s >= 0] == [4, 1]


def test_a_wrong_chunk_is_found():
    of = piece_codec.PieceEncoder(PIECES, True, 100)
    of("good text")
    of.check()
    of("more")
    of.known.put(" more", bpe.pack_ids([5]))
    with pytest.raises(ValueError, match="library"):
        of.check()


def test_piece_round_trip(make, library):
    docs = make(list(enumerate(EDGE)) + [(None, "a b"), (5, "a")])
    rows = piece_codec.round_trip(docs, PIECES).collect()
    assert len(rows) == len(EDGE) + 2
    for r in rows:
        text = "a b" if r.doc_id is None else EDGE[r.doc_id] or ""
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == sha(np.array(ids, "<u4").tobytes())
        assert r.decoded_sha256 == sha(library.decode(ids).encode())
    decoded = piece_codec.decode(piece_codec.encode(docs, PIECES), PIECES)
    assert {r.doc_id: r.text for r in decoded.collect()} == {**{i: (t or "").replace("▁", " ") for i, t in enumerate(EDGE)}, None: "a b"}
    assert piece_codec.round_trip(make([]), PIECES).collect() == []


def brute_groups(a, b):
    shared = sorted(set(a) & set(b))
    return [a.index(s) for s in shared], [b.index(s) for s in shared]


def test_groups_are_cut_at_every_shared_end():
    rng = random.Random(11)
    for _ in range(3000):
        n = rng.randint(1, 40)
        a = sorted(rng.sample(range(1, n), rng.randint(0, n - 1))) + [n]
        b = sorted(rng.sample(range(1, n), rng.randint(0, n - 1))) + [n]
        last_a, last_b = alignment.groups(a, b)
        assert (last_a, last_b) == brute_groups(a, b)
        left, right = alignment.links(np.array(a), np.array(b))
        starts_a, starts_b = [0, *a], [0, *b]
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts_a[i] < b[j] and starts_b[j] < a[i]]
        assert list(zip(left.tolist(), right.tolist())) == want
    assert alignment.groups([], []) == ([], [])


def test_cutless_stretch_is_not_searched_over_and_over(monkeypatch):
    asked = []
    monkeypatch.setattr(alignment, "bisect_left", lambda *x: asked.append(1) or __import__("bisect").bisect_left(*x))
    n = 20_000
    head = list(range(1, 50))
    alignment.groups(head + list(range(100, 2 * n, 2)) + [2 * n], head + list(range(101, 2 * n, 2)) + [2 * n])
    assert len(asked) < 4 * n


def brute_align(rows):
    """The contract, token by token."""
    a_lib, b_lib = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES)
    a_lib.encode_special_tokens = True
    pieces, texts_b = bpe.load(BYTES).pieces, piece_codec.load(PIECES).text
    done, holders = [], Counter()
    for name, text in rows:
        a = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        data = (" " + text).encode() if text else b""
        if not text or b"".join(pieces[i] for i in a) != data or b"".join(texts_b[i] for i in b) != data:
            done.append((name, [], [], [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(pieces[i]) for i in a]).tolist(), np.cumsum([len(texts_b[i]) for i in b]).tolist()
        linked, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            linked.append((a[i], b[j]))
            end_a, end_b = ends_a[i], ends_b[j]
            i, j = i + (end_a <= end_b), j + (end_b <= end_a)
        shown, i, j = [], 0, 0
        for x, y in zip(*brute_groups(ends_a, ends_b)):
            shown.append(",".join(map(str, a[i : x + 1])) + "|" + ",".join(map(str, b[j : y + 1])))
            i, j = x + 1, y + 1
        holders.update(set(linked))
        done.append((name, a, b, linked, ";".join(shown)))
    top = Counter()
    for (x, _), n in holders.items():
        top[x] = max(top[x], n)
    return [
        (name, len(a), len(b), s.count(";") + 1 if s else 0, len(linked), sum(holders[p] == top[p[0]] for p in linked),
         sum(holders[p] for p in linked), sha(s.encode()) if s else "")
        for name, a, b, linked, s in done
    ]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("limits", [{}, {"block_pairs": 300, "block_rows": 40}])
def test_alignment(make, limits):
    rows = list(enumerate(EDGE + random_texts(300, 5))) + [(None, "a b"), (5, "a"), (5, "other words"), (1000, "a")]
    got = alignment.align(make(rows), BYTES, PIECES, **limits).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_align(rows), key=str)


def test_alignment_of_nothing(make):
    assert alignment.align(make([]), BYTES, PIECES).collect() == []
    got = alignment.align(make([(1, None), (2, ""), (3, "▁")]), BYTES, PIECES).select(*COLUMNS).collect()
    assert sorted(map(tuple, got)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]

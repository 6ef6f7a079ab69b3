"""Token counts, encoding, lines, exact copies: edge rows against plain Python."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tillwise.llm import bpe, bpe_codec, exact_dedup, line_dedup, token_count

WORDS, BYTES = "/opt/tokenizers/word_bpe_49k.json", "/opt/tokenizers/byte_bpe_50k.json"

EDGE = [None, "", " ", "\n", "a", "A  b\n\n c\t", "<|endoftext|>", "x <|endoftext|> y<|startoftext|>", "été ÉTÉ é ΣΑΣ",
        "漢字 12½ don't we'LL", "\x1c\x85\xa0 z", "end ", " start", "😀 </w>", "word " * 3000, "q" * 5000]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_same_ids_as_the_library(path):
    library, encode, count = Tokenizer.from_file(path), bpe.id_encoder(path), bpe.counter(path)
    rng = random.Random(7)
    letters = list("aab  \n\tcdE'sTll've12½ßéÉΣİ漢́\x1c\x85\xa0!%_-<|>") + ["<|endoftext|>", "<|startoftext|>", "'re", "😀"]
    for text in [t for t in EDGE if t is not None] + ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(3000)]:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "<u4").tolist() == want, text
        assert count(text) == len(want), text


def test_merge_skips_stale_pairs():
    ranks, whole = {1 << 32 | 2: 0, 2 << 32 | 1: 1, 9 << 32 | 9: 2}, [9, 8, 7]
    symbols = [1, 2, 1, 2, 1]
    assert bpe.merge(symbols, ranks, whole) == 3
    assert [s for s in symbols if s >= 0] == [7, 1]


def test_recent_keeps_a_bounded_number():
    seen = []
    kept = bpe.Recent(lambda k: seen.append(k) or -k, limit=3)
    assert [kept[i] for i in [1, 2, 3, 4, 1, 5, 6, 7]] == [-1, -2, -3, -4, -1, -5, -6, -7]
    assert len(kept) <= 3 and len(kept.older) <= 3 and seen.count(1) == 1


def test_counts(make):
    library = Tokenizer.from_file(WORDS)
    rows = token_count.count_tokens(make(list(enumerate(EDGE)) + [(None, "a b"), (0, None)]), WORDS, limit=2).collect()
    assert len(rows) == len(EDGE) + 2
    for r in rows:
        text = "a b" if r.doc_id is None else EDGE[r.doc_id] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 2)
    assert token_count.count_tokens(make([]), WORDS).collect() == []


def test_encode_and_decode(make):
    docs = make(list(enumerate(EDGE)) + [(None, "a b"), (4, "a")])
    encoded = bpe_codec.encode(docs, BYTES)
    decoded = {r.doc_id: r.text for r in bpe_codec.decode(encoded, BYTES).collect()}
    assert decoded == {**{i: t or "" for i, t in enumerate(EDGE)}, None: "a b"}
    library = Tokenizer.from_file(BYTES)
    for r in bpe_codec.round_trip(docs, BYTES).collect():
        text = "a b" if r.doc_id is None else EDGE[r.doc_id] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe_codec.round_trip(make([]), BYTES).collect() == []


def brute_lines(rows, least=10):
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line.encode().strip(b" \t\n\x0b\x0c\r").lower()
            if len(key.decode()) >= least:
                holders.setdefault(key, set()).add(float("inf") if doc is None else doc)
    out = []
    for doc, text in rows:
        lines, me = (text or "").split("\n"), float("inf") if doc is None else doc
        stay = []
        for line in lines:
            who = holders.get(line.encode().strip(b" \t\n\x0b\x0c\r").lower(), {me})
            if min(who) == me:
                stay.append(line)
        out.append((doc, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [64, 1 << 22])
def test_lines(make, bits):
    rows = [(3, "Shared line one\nown text here 3"), (1, " shared LINE one\t\nown text here 1\nshared line one"), (2, None), (4, ""),
            (5, "shared line one"), (6, "short\nshort"), (7, "short"), (8, "ÄÖÜ äöü äöü\nx"), (9, "ÄÖÜ äöü äöü"), (10, "äöü äöü äöü"),
            (11, "\xa0shared line one"), (None, "shared line one\nonly without id"), (None, "only without id"), (12, "y" * 30000),
            (13, "z\n" + "y" * 30000), (12, "y" * 30000), (14, "twice in one\ntwice in one")]
    got = line_dedup.drop_repeated_lines(make(rows), filter_bits=bits).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got), key=str) == brute_lines(rows)


def test_no_lines(make):
    assert line_dedup.drop_repeated_lines(make([]), filter_bits=64).collect() == []


def brute_exact(rows, keep):
    groups = {}
    for doc, text in rows:
        groups.setdefault((text or "").encode().lower(), []).append(doc)
    out = []
    for doc, text in rows:
        key = (text or "").encode().lower()
        ids = [d for d in groups[key] if d is not None]
        best = (min if keep == "smallest" else max)(ids) if ids else None
        out.append((doc, best, len(groups[key]), doc == best, hashlib.sha256(key).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact(make, keep, weak):
    from pyspark.sql import functions as F

    rows = [(1, "Same"), (2, "sAME"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "x" * 50000), (8, "X" * 50000), (2, "same"), (None, "same"),
            (None, "alone"), (9, "İ"), (10, "same ")]
    hash_fn = (lambda t: F.unhex(F.lpad(F.hex(F.length(t) % 2), 2, "0"))) if weak else exact_dedup.content_hash
    got = exact_dedup.mark_exact(make(rows), keep=keep, hash_fn=hash_fn).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_exact(rows, keep)


def test_exact_drops_and_keeps_columns(make):
    docs = make([(1, "a"), (2, "A"), (3, "b"), (None, "c"), (None, "c")])
    got = exact_dedup.drop_exact(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == [(1, "a"), (3, "b"), (None, "c")]
    assert exact_dedup.mark_exact(make([])).collect() == []

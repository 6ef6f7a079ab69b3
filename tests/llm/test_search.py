"""Pages, packing, shards, top-k, near duplicates and quality: edge rows against brute force."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillwise.llm import html_text, near_dup, packing, quality, sharding, topk
from tillwise.llm.components import components

WORDS = "/opt/tokenizers/word_bpe_49k.json"

PAGE = (
    '<html><head><title>no</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><ul><li><a href="/">menu one</a></li></ul></nav>'
    '<!-- note --><div class="ad">buy this now</div><article><header><h1>The Head&amp;line</h1></header><p>First <b>bo</b>ld\n word<br>break.'
    '<div class="cookie-notice">we use cookies</div><p>Second &eacute;.<form>mail <input></form></p></article>'
    '<section id="comments"><article class="comment">nice post</article></section><footer>&copy; me</footer></body></html>'
)


def test_main_text(make, spark):
    pages = [(1, PAGE), (2, None), (3, ""), (4, "just words &lt; more"), (5, "<nav>only a menu</nav>"), (6, "<script>never closed"),
             (7, "<p>a < b</p><p>c"), (8, "<div class='ad'>open <article><p>good text</p></article>"), (9, "<p>" + "long words " * 20000 + "</p>"),
             (1, PAGE), (None, "<p>no id</p>"), (10, '<main><p title="a > b">x y</p></main><p>beside</p>'), (11, "<p>cut <a hr")]
    got = html_text.extract_text(make(pages, "page_id", "string", "html"), html_col="html")
    texts = defaultdict(list)
    for r in got.collect():
        texts[r.page_id].append(r.text)
    assert texts[1] == ["The Head&line First bold word break. Second é."] * 2
    assert texts[2] == texts[3] == texts[5] == texts[6] == [""]
    assert texts[4] == ["just words < more"] and texts[7] == ["a < b c"] and texts[8] == ["good text"]
    assert texts[9] == ["long words " * 19999 + "long words"] and texts[None] == ["no id"]
    assert texts[10] == ["x y"] and texts[11] == ["cut"]
    assert html_text.extract_text(make([], "page_id", "string", "html")).collect() == []


def test_region_has_the_largest_sum():
    weights = {"word": 1.0, "tag p": -0.1, "tag div": -3.0}
    assert html_text.main_text("<p>x</p><div>a</div><div>b</div><p>one two three four</p><p>five</p><div>c</div>", weights) == "one two three four five"


def test_mark_is_a_label_only(make):
    body = "<p>one two three four</p><p>five six seven eight nine</p>"
    marked = [(i, f"<div><ul><li><a href='/'>menu</a></li></ul></div><article>{body}</article><div>end of page</div>") for i in range(20)]
    weights = html_text.learn(make(marked, "page_id", "string", "html"))
    assert not any("inside" in k or "outside" in k for k in weights)
    hidden = marked[0][1].replace("article>", "section>")
    assert html_text.main_text(hidden, weights) == html_text.main_text(marked[0][1], weights) == "one two three four five six seven eight nine"
    teaser = f"<section>{body * 9}</section><article><p>a teaser</p></article>"
    assert html_text.main_text(teaser, weights).startswith("one two three four five six seven eight nine one")


@pytest.mark.parametrize(
    "page, want",
    [
        ("<div class='entry-content no-sidebar'><p>real text</p></div>", "real text"),
        ("<article><p>real text</p><section class='related-work'><p>more of it</p></section></article>", "real text more of it"),
        ("<article class='post comments-open'><p>real text</p></article>", "real text"),
        ("<article><p class='promo'>ad<p>real text<p>more of it</article>", "real text more of it"),
        ("<article><ul><li class='ad'>ad<li>real text</ul><p>more of it</p></article>", "real text more of it"),
        ("<article><table><tr><td class='ad'>ad<td>real text<tr class='promo'><td>ad<tr><td>more</table><p>of it</p></article>", "real text more of it"),
        ("<div><p class='ad'>ad</div><p>real text</p>", "real text"),
        ("<article><p>real text</p><div class='cookie-notice site-footer'>we use cookies</div><p>more of it</p></article>", "real text more of it"),
        ("<article><p>real text</p><div class='promo'><p>" + "whole sentence " * 9 + "</p></div></article>", "real text"),
        ("<article><p>real text</p><p hidden>not shown<p>more of it</article>", "real text more of it"),
    ],
)
def test_article_text_is_kept(page, want):
    weights = {"word": 1.0, "tag": -0.05, **{f"tag {t}": -0.05 for t in ("other", *html_text.NAMES)}}
    assert html_text.main_text(page, weights) == want


@pytest.mark.parametrize("shard", [30, 1 << 20])
def test_packing(make, shard):
    rows = [(1, "alpha beta gamma " * 9), (2, None), (3, ""), (4, "beta gamma delta " * 30), (5, "alpha beta"), (None, "words without id"),
            (6, "é" * 300), (7, "alpha beta gamma"), (7, "alpha beta gamma"), (8, "<|endoftext|> x")]
    got = packing.pack(make(rows).coalesce(1), WORDS, window=16, shard_tokens=shard).collect()
    library = Tokenizer.from_file(WORDS)
    want = sorted(tuple(library.encode(t or "", add_special_tokens=False).ids + [2]) for _, t in rows)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    by_id = defaultdict(list)
    for i, t in rows:
        by_id[i].append(library.encode(t or "", add_special_tokens=False).ids + [2])
    for i, docs in by_id.items():
        starts = sorted((p.start, p.length) for p in pieces[i])
        assert sum(n for _, n in starts) == sum(map(len, docs))
        for p in pieces[i]:
            part = np.array(docs[0][p.start : p.start + p.length], "<u4").tobytes()
            assert p.doc_tokens == len(docs[0]) and zlib.crc32(part) == p.ids_crc32
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 16 or at & (at - 1) == 0
    assert sum(p.length for p in got) == sum(map(len, want))
    assert packing.pack(make([]), WORDS).collect() == []


def test_seed_meets_its_neighbours():
    docs = [np.array(d) for d in ([1, 2, 3, 3], [7, 8, 9], [3, 3, 1], [1, 5], [7, 7])]
    index = packing.Index(docs)
    unused = np.array([False, True, True, True, True])
    assert index.neighbours(0, unused).tolist() == [2, 3]
    assert index.neighbours(1, unused & [True, False, True, True, True]).tolist() == [4]


def test_packing_meets_neighbours_of_other_partitions(make):
    rng = np.random.default_rng(5)
    topics = [[f"{a}{b}" for b in ("bar", "con", "dis", "ful", "ger", "hal", "ing", "lor")] for a in "kmptvwxz"]
    rows = [(i, " ".join(rng.choice(topics[i % 8], 40))) for i in range(160)]
    got = packing.pack(make(rows).repartition(4), WORDS, window=512, shard_tokens=4096).collect()
    together = defaultdict(set)
    for r in got:
        together[r.sequence_id].add(r.doc_id % 8)
    assert len({r.doc_id for r in got}) == 160
    # a window whose topic has run out takes the next; by arrival most hold several
    assert np.mean([len(t) for t in together.values()]) <= 2.5


def test_packing_knows_all_documents(make):
    rows = [(i, f"alpha beta {'gamma' if i % 3 else 'delta'}") for i in range(20)] + [(20, None), (21, "alpha alpha")]
    stored = packing.encoded(make(rows).selectExpr("doc_id id", "coalesce(text, '') text").repartition(3), WORDS, 2, 100)
    known = packing.statistics(stored)
    ids = [Tokenizer.from_file(WORDS).encode(t or "", add_special_tokens=False).ids for _, t in rows]
    want = np.bincount(np.concatenate([np.unique(d) for d in ids]).astype(int))
    assert known.df.tolist() == want.tolist() and known.mean == sum(map(len, ids)) / 22


def test_seed_asks_for_all_its_terms():
    docs = [np.arange(30).repeat(np.arange(30) + 1), np.array([0, 40]), np.arange(1, 30)]
    unused = np.array([False, True, True])
    assert packing.Index(docs).neighbours(0, unused).tolist() == [2, 1]


def brute_bm25(docs, seed, known):
    """BM25 of every document, by its formula."""
    asked, out = set(docs[seed].tolist()), []
    for d in docs:
        words, score = d.tolist(), 0.0
        for t in asked & set(words):
            tf, idf = words.count(t), np.log(1 + (known[0] - known[2][t] + 0.5) / (known[2][t] + 0.5))
            score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / known[1]))
        out.append(score)
    return np.array(out)


@pytest.mark.parametrize("shape", [(40, 30, 1.2), (60, 400, 1.0), (30, 8, 2.0)])
def test_index_scores_as_brute_force(shape):
    n, words, slope = shape
    rng = np.random.default_rng(n)
    chance = 1 / np.arange(1, words + 1) ** slope
    docs = [rng.choice(words, rng.integers(0, 80), p=chance / chance.sum()) for _ in range(n)] + [np.empty(0, "int64")]
    df = 3 + np.bincount(np.concatenate([np.unique(d) for d in docs]).astype(int), minlength=words)
    index = packing.Index(docs, packing.Statistics(500, 20_000, df))
    unused = np.ones(len(docs), bool)
    for seed in rng.permutation(len(docs)):
        unused[seed] = False
        want = brute_bm25(docs, seed, (500, 40.0, df))
        index.forget(unused)
        assert np.allclose(index.scores(seed) * unused[index.found], (want * unused)[index.found])
        assert not unused[np.setdiff1d(np.arange(len(docs)), index.found)].any()
        near = index.neighbours(seed, unused)
        assert set(near) == set(np.flatnonzero(want * unused)) and (np.diff(want[near]) <= 1e-9).all()


def test_seed_reads_only_its_own_postings():
    rng = np.random.default_rng(1)
    docs = [np.array([7])] + [rng.integers(10, 3000, 200) for _ in range(400)] + [np.array([7, 8])] * 3
    index = packing.Index(docs)
    index.weight = index.weight.view(Counted)
    Counted.asked = 0
    assert index.neighbours(0, np.ones(len(docs), bool)).tolist() == [0, 401, 402, 403]
    assert Counted.asked == 4 < len(index.weight) // 1000


class Counted(np.ndarray):
    """Counts the entries that are picked."""

    asked = 0

    def __getitem__(self, at):
        Counted.asked += len(at)
        return np.asarray(self)[at]


def test_library_ids_of_chunks():
    library, of = Tokenizer.from_file(WORDS), packing.encoder(WORDS, 50)
    rng = random.Random(3)
    signs = list("aäB1 .,;:!?\"()'\n") + ["don't", "it's.", "...", "É́", "<|endoftext|>", "ⅷ", "Ⓐ", "ª", "漢字,", "İ!"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(2000)]
    for text in texts:
        ids = of(text)
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("chunks", [7, 1 << 20])
def test_library_ids_of_many_texts(chunks, monkeypatch):
    monkeypatch.setattr(packing, "CHUNKS", chunks)
    library, of = Tokenizer.from_file(WORDS), packing.LibraryEncoder(WORDS, 50)
    rng = random.Random(4)
    signs = list("aäBJ1 .,;:!?\"()'\n") + ["é ", "Sol", "don't ", "\u030c", "<|endoftext|>", "<|ENDOFTEXT|>", "İ", "ǅ", "漢 "]
    texts = ["", " ", *("".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(300)), ""]
    got = of.every(pa.array(["skipped", *texts]).slice(1))
    assert [g.tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert of.every(pa.array([], pa.string())) == []
    with pytest.raises(ValueError):
        packing.LibraryEncoder("/opt/tokenizers/byte_bpe_50k.json")


class Asked:
    """A model that keeps what it is asked for."""

    def __init__(self, model):
        self.model, self.words = model, []

    def tokenize(self, word):
        self.words.append(word)
        return self.model.tokenize(word)


def test_library_sees_a_word_once():
    of, asked = packing.LibraryEncoder(WORDS), []
    of.model = Asked(of.library.model)
    of.known.compute = lambda word: asked.append(word) or of.word(word)
    texts = ["Marina marina, (marina MARINA. marina!\nmarina", "Ñu ñu, marina. Marina ÑU; ñu"]
    ids = of.every(pa.array(texts))
    library = Tokenizer.from_file(WORDS)
    assert [i.tolist() for i in ids] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(of.model.words) == sorted(["marina", "Ã±u", "(", ",", ".", ";", "!"]) and len(asked) == len(set(asked))


def test_curve_steps_to_a_neighbour():
    for dims, bits in ((1, 3), (2, 3), (3, 3), (4, 2)):
        grid = np.array(list(itertools.product(range(1 << bits), repeat=dims))).T
        index = sharding.curve_index(grid, bits)
        assert sorted(index) == list(range(1 << bits * dims))
        assert (np.abs(np.diff(grid[:, np.argsort(index)], axis=1)).sum(0) == 1).all()


@pytest.mark.parametrize("block", [7, 50_000])
def test_shards(make, block, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    rows = [(i, "x" * int(rng.integers(0, 200)), f"s{i % 3 * (i % 7)}", None if i % 5 else "en") for i in range(300)]
    rows += [(1000 + i, "hot text", "s0", "en") for i in range(200)] + [(None, None), (5, "y"), (5, "y"), (2000, "z" * 3000)]
    got = sharding.shard_by_curve(make(rows).drop("size"), shards=4).collect()
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, len(t or "") + 1) for i, t, *_ in rows)
    sizes, slots, of = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        of[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(sizes.values()) / 4
    assert all(abs(sizes[s] - mean) <= 3000 for s in range(4))
    assert sum(len(s) > 1 for s in of.values()) <= 3
    assert sharding.shard_by_curve(make([]).drop("size")).collect() == []


def test_clashing_columns_of_shards(make, spark, tmp_path):
    """Columns named size, shard and slot change neither the dimensions nor the files."""
    rows = [(i, "x" * (i * 37 % 500), f"s{i % 5}", "en") for i in range(200)]
    plain = make(rows).drop("size", "shard", "slot")
    clash = plain.withColumns({"size": F.lit("x"), "shard": F.lit("y"), "slot": F.lit(3)})
    placed = sharding.shard_by_curve(clash, shards=3)
    key = lambda r: (r.doc_id, r.slot)
    assert sorted(placed.collect(), key=key) == sorted(sharding.shard_by_curve(plain, shards=3).collect(), key=key)
    sharding.write_shards(clash, placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.columns) == sorted([*plain.columns, "size", "shard", "slot"])
    want = sorted((r.doc_id, r.shard, r.slot) for r in placed.collect())
    assert sorted((r.doc_id, r.shard, r.slot) for r in back.collect()) == want
    with pytest.raises(ValueError):
        sharding.shard_by_curve(plain.drop("source"))


@pytest.mark.parametrize("names", [10_000, 3])
def test_long_names_get_levels_of_their_own(make, names, monkeypatch):
    """Names that begin alike are told apart, and their levels keep their order."""
    monkeypatch.setattr(sharding, "NAMES", names)
    sites = sorted(f"https://www.{c * 3}.example/path" for c in "abcdefgh")
    rows = [(i, "same size", sites[i % 8], "en") for i in range(400)] + [(1000, "same size", None, "en")]
    base = make(rows).select(sharding.dimension_value(make(rows), "source").alias("d0"), "source")
    (level,) = sharding.quantised(base, ["d0"], [i / 16 for i in range(1, 16)])
    got = base.select("source", level.alias("level")).distinct().orderBy("source").collect()
    levels = [r.level for r in got]
    if names > 8:
        assert len(got) == 9 and levels == sorted(levels) and len(set(levels)) >= 8
    assert levels == sorted(levels)
    without = make(rows[:-1]).select(sharding.dimension_value(make(rows), "source").alias("d0"))
    (level,) = sharding.quantised(without, ["d0"], [i / 16 for i in range(1, 16)])
    assert without.select(level.alias("level")).distinct().count() == 8


def test_levels_by_frequency():
    assert sharding._weighted_cuts([("a", 1), ("b", 8), ("c", 1)], [0.25, 0.5, 0.75]) == ["b", "b", "b"]
    assert sharding._weighted_cuts([("a", 2), ("b", 2), ("c", 2), ("d", 2)], [0.25, 0.5, 0.75]) == ["a", "b", "c"]
    assert sharding._weighted_cuts([], [0.5]) == []


def test_written_shards(make, spark, tmp_path):
    docs = make([(i, "t" * i) for i in range(50)]).drop("shard", "size")
    sharding.write_shards(docs, sharding.shard_by_curve(docs, shards=3), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and back.select("shard").distinct().count() == 3


def brute_top(rows, k, every):
    def whole(v):
        return [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]

    ok = [(i, whole(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in sorted({i: min(w for j, w in ok if j == i) for i, _ in ok}.items()):
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


@pytest.mark.parametrize("big", [1.0, 2e5])
def test_top_k(spark, big):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * big * (1 + i % 3)]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(40)] + [(300, None), (350, [1.0, None]), (400, [float("nan")] * 6), (450, [float("inf")] * 6)]
    rows += [(500, []), (550, [0.5, -0.5]), (None, [1.0] * 6), (7, rows[7][1]), (50, rows[8][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(1)).withColumn("chunk", F.lit("x"))
    got = [tuple(r) for r in topk.top_k(df, k=5, chunk=16).orderBy("query_id", "rank").collect()]
    assert got == brute_top(rows, 5, 50)
    assert topk.top_k(df.filter("vec_id = 0"), chunk=16).collect() == []
    assert topk.top_k(df.filter("vec_id < 0")).collect() == []
    assert topk.top_k(df.filter("vec_id = 500 or vec_id = 550")).count() == 2


def test_top_k_prunes_by_length_before_the_shuffle(spark, monkeypatch):
    """With spread lengths a query meets few chunks; results stay those of brute force."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=4) * 1.02 ** (i % 400)]) for i in range(1200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    plain = topk.reach
    copies = {}

    def counted(known):
        def stored(frame, label):
            kept = keep(frame, label)
            if label == "topk-asked":
                copies[known] = sum(r.band + 1 for r in kept.select("band").collect()), kept.count()
            return kept

        return stored

    keep = topk.stored
    results = []
    for name, fn in (("pruned", plain), ("all", lambda cuts: F.lit(len(cuts)))):
        monkeypatch.setattr(topk, "reach", fn)
        monkeypatch.setattr(topk, "stored", counted(name))
        results.append([tuple(r) for r in topk.top_k(df, k=5, every=10, chunk=30).orderBy("query_id", "rank").collect()])
    assert results[0] == results[1] == brute_top(rows, 5, 10)
    assert copies["all"][0] == 120 * 40 and copies["pruned"][0] < copies["all"][0] / 2


def test_query_parts():
    rng = np.random.default_rng(2)
    for _ in range(200):
        bands, chunk = int(rng.integers(1, 30)), int(rng.integers(1, 50))
        sizes = {int(b): int(rng.integers(1, 90)) for b in rng.integers(0, bands, size=bands)}
        firsts, own = topk.query_parts(sizes, bands, chunk)
        assert len(firsts) == bands + 1 and firsts == sorted(firsts)
        for band, n in sizes.items():
            start, parts = own[band]
            assert start + parts <= firsts[-1] and n <= parts * chunk
            # every query that reaches a band lies in a part that the band's vectors go to
            assert all(firsts[b] <= start for b in range(band + 1))
        assert firsts[-1] <= 2 * sum(sizes.values()) / chunk + 2


def shingle_sets(rows, size):
    sets = defaultdict(set)
    for i, t in rows:
        words = (t or "").encode().lower().split()
        k = min(size, len(words))
        sets[i] |= {tuple(words[a : a + k]) for a in range(len(words) - k + 1)} if words else set()
    return sets


def brute_near(rows, size, percent):
    sets = shingle_sets(rows, size)
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(sorted(i for i in sets if i is not None), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            up[max(top(a), top(b))] = min(top(a), top(b))
    return {i: top(i) for i in sets if i is not None}


def near_rows():
    rng = np.random.default_rng(11)
    word = lambda: f"w{int(rng.integers(0, 4000))}"
    rows, n = [], 0
    for base in range(6):
        text = [word() for _ in range(120)]
        for copy in range([70, 12, 3, 2, 1, 40][base]):
            edited = list(text)
            for _ in range(int(rng.integers(0, 3))):
                edited[int(rng.integers(0, 120))] = word()
            rows.append((n, " ".join(edited)))
            n += 1
    chain = [word() for _ in range(200)]
    for step in range(15):  # each like the next, the ends unlike
        rows.append((n, " ".join(chain)))
        n += 1
        chain = chain[8:] + [word() for _ in range(8)]
    passage = " ".join(word() for _ in range(60))
    for _ in range(90):  # one passage in many documents
        rows.append((n, passage + " " + " ".join(word() for _ in range(30))))
        n += 1
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "one"), (n + 4, "ONE"), (n + 5, "two words"), (n + 6, "\xa0"), (n + 7, "é É"), (n + 8, "É é")]


@pytest.mark.parametrize("leaf,depth", [(64, 4), (4, 1), (8, 2)])
def test_near(make, leaf, depth):
    rows = near_rows()
    want = brute_near(rows, 3, 85)
    extra = [(None, rows[0][1]), (0, rows[0][1])]
    got = near_dup.mark_near(make(rows + extra), size=3, percent=85, leaf=leaf, depth=depth).collect()
    assert len(got) == len(rows) + 2
    sets = shingle_sets(rows, 3)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept, r.n_shingles) == (want[r.doc_id], want[r.doc_id] == r.doc_id, len(sets[r.doc_id]))


def test_near_drops_and_keeps_columns(make):
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    docs = make([(1, text), (2, text.upper()), (3, text + " end"), (4, None), (5, None), (6, "other")])
    got = near_dup.drop_near(docs)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [1, 4, 5, 6]
    assert near_dup.mark_near(make([])).collect() == []


def test_components(spark):
    rng = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(100 + i, 101 + i) for i in range(30)] + [(7, 7)]
    up = {i: i for i in range(200)}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        up[max(top(a), top(b))] = min(top(a), top(b))
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: top(i) for a, b in links if a != b for i in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_quality(make, spark):
    rng = np.random.default_rng(2)
    good = lambda: " ".join(f"word{int(x)}" for x in rng.integers(0, 900, 40)) + "."
    poor = lambda: " ".join(f"W{int(x)}%%%" for x in rng.integers(0, 900, 40))
    rows = [(i, good() if i % 4 else poor(), f"s{i % 3}", "en" if i % 2 else None) for i in range(240)]
    rows += [(300, None), (301, ""), (None, good()), (None, poor(), "lonely"), (5, rows[5][1]), (302, "x" * 60000)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(0, 240, 2)] + [(1, None), (999, 1)], "doc_id long, quality int")
    got = quality.score(make(rows), labels).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id: r.kept for r in got if r.doc_id is not None}
    assert [kept[i] for i in range(1, 240, 2)] == [True] * 120
    assert all(kept[i] == (i % 4 > 0) for i in range(240))
    assert sorted(r.kept for r in got if r.doc_id is None) == [False, True]
    rates = {r.host_rate for r in got}
    assert len(rates) >= 2 and all(0 < r < 10000 for r in rates)
    out = quality.drop_poor(make(rows), labels)
    assert out.columns == make(rows).columns and {r.doc_id for r in out.collect()} == {i for i, k in kept.items() if k} | {None}
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.evidence for r in quality.score(make(rows), none).collect()} == {0}
    assert quality.score(make([]), labels).collect() == []


def test_sparse_sites_are_drawn_to_the_prior(spark):
    hosts = [("a", 900_000, 1000), ("b", 100_000, 1000), ("c", 0, 1)]
    groups = spark.createDataFrame(hosts, "host string, s long, n long")
    m = quality.strength(groups, F.lit(0.5), 1, 1000)
    assert 1 <= m < 100
    alike = spark.createDataFrame([("a", 500_000, 1000), ("b", 500_000, 1000)], "host string, s long, n long")
    assert quality.strength(alike, F.lit(0.5), 1, 1000) == 1000

"""Stages drop rows, not ids: edge rows through each drop and through the whole pipeline."""

from collections import defaultdict

import pytest

import corpus_pipeline
from tillwise.llm import common, exact_dedup, near_dup, quality

A, B, C = "one text that occurs again", "another text that occurs again", "a text that occurs once"
LONG = " ".join(f"word{i}" for i in range(60))
NEAR = LONG + " end"

ROWS = [
    (1, A), (1, A), (None, B), (None, B), (5, A), (5, C), (6, None), (7, ""), (7, ""), (8, LONG), (8, NEAR), (9, LONG.upper()), (9, "short own text here"),
    (None, LONG), (None, "no id and a text of its own"), (None, None), (10, "x" * 5000), (10, "x" * 5000), (11, NEAR + " "), (12, "   "),
]


def least(rows):
    return min(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def brute_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups["".join(c.lower() if c.isascii() else c for c in r[1] or "")].append(r)
    return {least(g)[0]: 1 for g in groups.values()}, sorted((least(g)[0] is None, least(g)[0] or 0, k) for k, g in groups.items())


def folded(rows):
    return sorted((r[0] is None, r[0] or 0, (r[1] or "").lower()) for r in rows)


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} if words else set()


def brute_near(rows):
    """One row of each component of distinct rows; rows without words stay."""
    worded, out = sorted({r for r in rows if shingles(r[1])}, key=str), [r for r in rows if not shingles(r[1])]
    sets, group = [shingles(r[1]) for r in worded], list(range(len(worded)))
    for i in range(len(worded)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[i] if g == group[j] else g for g in group]
    parts = defaultdict(list)
    for r, g in zip(worded, group):
        parts[g].append(r)
    return out, [[r for r in p if (r[0] is None, r[0]) == min((x[0] is None, x[0] or 0) for x in p) or r[0] is None] for p in parts.values()]


def taken(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def check_near(got, rows):
    stay, parts = brute_near(rows)
    got = list(got)
    for r in stay:
        got.remove(r)
    for p in parts:
        held = [r for r in got if r in p]
        assert len(held) == 1, p
        got.remove(held[0])
    assert not got


@pytest.mark.parametrize("rows", [ROWS, ROWS[::-1], ROWS[:6], [(None, A)] * 3, [(1, A), (2, A)], []])
def test_exact_rows(make, rows):
    got = exact_dedup.drop_exact(make(rows))
    assert got.columns == make(rows).columns
    assert folded(taken(got)) == sorted((n, i, t.lower()) for n, i, t in brute_exact(rows)[1])


def test_exact_rows_with_text_ids(spark):
    df = spark.createDataFrame([("b", A), ("b", C), ("a", A), (None, A), ("c", B)], "doc_id string, text string")
    assert sorted(taken(exact_dedup.drop_exact(df))) == [("a", A), ("b", C), ("c", B)]
    with pytest.raises(TypeError):
        exact_dedup.drop_exact(df.selectExpr("1.5 AS doc_id", "text"))


@pytest.mark.parametrize("rows", [ROWS, ROWS[:6], [(None, A)] * 3, [(3, "")] * 2, []])
def test_near_rows(make, rows):
    check_near(taken(near_dup.drop_near(make(rows))), rows)


def test_poor_rows(make, spark):
    good = " ".join(["plain words make up a sentence of usual length and sense"] * 3)
    rows = [(i, good + f" {i}") for i in range(40)] + [(100 + i, "$$$ %% 11 ## @@ " * 9 + str(i)) for i in range(40)]
    rows += [(500, good), (500, "$$$ %% 11 ## @@ " * 9), (None, good), (None, "$$$ %% 11 ## @@ " * 9), (501, good), (501, good)]
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(30)], "doc_id long, quality int")
    got = taken(quality.drop_poor(make(rows), labels))
    assert sorted(got, key=str) == sorted([r for r in rows if not r[1].startswith("$")], key=str)


def test_edge_rows_through_all_stages(make, spark, tmp_path):
    make(ROWS).select("doc_id", "text", "lang", "source").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = taken(docs)
        docs = common.stored(stage(spark, docs, str(tmp_path)), name)
        if name == "quality":
            assert sorted(taken(docs), key=str) == sorted(before, key=str)
        elif name == "exact_dedup":
            assert folded(taken(docs)) == sorted((n, i, t.lower()) for n, i, t in brute_exact(before)[1])
        else:
            check_near(taken(docs), before)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sum(p.start == 0 for p in pieces) == docs.count()
    assert sorted(map(str, {p.doc_id for p in pieces})) == sorted(map(str, {i for i, _ in taken(docs)}))


def test_no_rows_through_all_stages(make, spark, tmp_path):
    make([]).select("doc_id", "text", "lang", "source").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []

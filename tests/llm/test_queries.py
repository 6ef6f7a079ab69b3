"""The registered queries against their SQL, and the pipeline against brute force."""

import os
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_search import WORDS, brute_near, brute_top
from tests.llm.test_texts import brute_exact
from tests.oracle import compare, connect
from tillwise.llm import queries
from tillwise.llm.common import stored

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {"pipeline", *queries.QUERIES} <= set(entry.queries())
    assert set(queries.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.SQL[name]) is None


def test_exact_plan_has_no_python(spark):
    plan = queries.QUERIES["op10_exact_dedup"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_top_k_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = queries.QUERIES["op9_exact_top_k"](spark, SF).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == brute_top(rows, 5, 50)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, columns, kept = [], docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, kept[-1], SF), "test")
        assert out.columns == columns
        names.append(name)
        kept.append(out)
    assert names == ["quality", "exact_dedup", "near_dedup"]
    rows = [sorted((r.doc_id, r.text) for r in k.collect()) for k in kept]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = {i for i, _ in rows[0] if labels.get(i) == 1}
    assert len(good - {i for i, _ in rows[1]}) <= 0.02 * len(good)
    assert [i for i, _ in rows[2]] == sorted(r[0] for r in brute_exact(rows[1], "smallest") if r[3])
    near = brute_near(rows[2], 5, 80)
    assert [i for i, _ in rows[3]] == sorted(i for i in near if near[i] == i)
    library, tokens, packed = Tokenizer.from_file(WORDS), {}, defaultdict(int)
    for i, text in rows[3]:
        tokens[i] = len(library.encode(text or "", add_special_tokens=False).ids) + 1
    pieces = corpus_pipeline.run(spark, SF).collect()
    for p in pieces:
        assert p.doc_tokens == tokens[p.doc_id]
        packed[p.doc_id] += p.length
    assert packed == tokens and np.all([p.offset + p.length <= 4096 for p in pieces])
